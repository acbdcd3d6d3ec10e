"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The candidate merges of pre-tokens wait in one bucket per merge rank; a bucket holds
positions in a linked list of parts. Three levels of 64-bit words mark the buckets that
are not empty, so three find-first-set steps give the next rank. Entries that a merge has
made stale are skipped when they come up.

The distinct pre-tokens of a batch share one queue: what waits in the bucket of a rank
is merged at once, in each pre-token the leftmost pair first. A very long pre-token has a
queue of its own, whose buckets are heaps of positions: its cost is n log n.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, slices, text_of, tidy

#: Bytes from which a pre-token has a queue of its own, bytes of pre-tokens that share one,
#: and bytes of texts that are taken together: memory bounds of a task.
LONG, SHARED, TOGETHER = 200, 1 << 20, 16 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines "base64-of-bytes rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Encodes pre-tokens; between two of them all its words and buckets are empty."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        words = (max(ranks.values(), default=0) >> 6) + 1
        self.low = [0] * words                 # a bit per rank: its bucket is not empty
        self.mid = [0] * ((words >> 6) + 1)    # a bit per word of `low` that is not 0
        self.buckets: dict[int, list[int]] = {}

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank merges first, leftmost first.

        Pushing and popping stand in the loop itself: Python calls would cost more than
        the work."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        low, mid, buckets, get, top = self.low, self.mid, self.buckets, ranks.get, 0
        n = len(piece)
        end = list(range(1, n + 1))     # end of the part that starts here
        start = list(range(-1, n))      # start of the part before the one that starts here
        waiting = [-1] * (n + 1)        # rank of the pair that starts here; other entries are stale
        for i in range(n - 1):
            rank = get(piece[i:i + 2])
            if rank is not None:
                waiting[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)  # in order: a heap
                else:
                    buckets[rank] = [i]
                    a = rank >> 6
                    word = low[a]
                    low[a] = word | 1 << (rank & 63)
                    if not word:
                        b = a >> 6
                        mid[b] |= 1 << (a & 63)
                        top |= 1 << b
        while top:
            # find-first-set on each level gives the lowest rank, its heap the leftmost place
            b = (top & -top).bit_length() - 1
            word = mid[b]
            a = b << 6 | (word & -word).bit_length() - 1
            word = low[a]
            rank = a << 6 | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket) if len(bucket) > 1 else bucket.pop()
            if not bucket:
                del buckets[rank]
                word &= word - 1
                low[a] = word
                if not word:
                    word = mid[b] & ~(1 << (a & 63))
                    mid[b] = word
                    if not word:
                        top &= ~(1 << b)
            if waiting[i] != rank:
                continue
            j = end[i]
            k = end[j]
            end[i] = k
            waiting[j] = waiting[i] = -1
            fresh = []
            if k < n:
                start[k] = i
                rank = get(piece[i:end[k]])
                if rank is not None:
                    waiting[i] = rank
                    fresh.append((rank, i))
            h = start[i]
            if h >= 0:
                rank = get(piece[h:k])
                if rank is None:
                    waiting[h] = -1
                elif waiting[h] != rank:
                    waiting[h] = rank
                    fresh.append((rank, h))
            for rank, at in fresh:
                if rank in buckets:
                    heappush(buckets[rank], at)
                    continue
                buckets[rank] = [at]
                a = rank >> 6
                word = low[a]
                low[a] = word | 1 << (rank & 63)
                if not word:
                    b = a >> 6
                    mid[b] |= 1 << (a & 63)
                    top |= 1 << b
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out


class SharedQueue:
    """One rank queue for many pre-tokens; ids of tokens are their ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        found = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        pairs = np.array(sorted(found) or [(-1, -1)], dtype=np.int64)
        self.pairs, self.merged = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        self.words = (max(ranks.values(), default=0) >> 6) + 1

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of two tokens; -1 where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], -1)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens, end to end; number of ids of each)."""
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        token = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        n = len(token)
        piece = np.repeat(np.arange(len(pieces)), size)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[np.cumsum(size) - 1] = -1
        before[np.cumsum(size) - size] = -1
        waiting = np.full(n, -1, dtype=np.int64)  # rank of the pair that starts here; other entries are stale
        first = np.flatnonzero(after >= 0)
        waiting[first] = self.merge_ranks(token[first], token[first + 1])
        alive = np.ones(n, dtype=bool)
        low, mid, top = [0] * self.words, [0] * ((self.words >> 6) + 1), 0
        buckets: dict[int, list[np.ndarray]] = {}
        starts = first[waiting[first] >= 0]
        ranks = waiting[starts]
        while True:
            # push: positions with the same rank go into its bucket together
            order = np.argsort(ranks, kind="stable")
            ranks, starts = ranks[order], starts[order]
            edge = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])[:len(ranks)])
            stop = np.append(edge[1:], len(ranks)).tolist()
            for rank, at, end in zip(ranks[edge].tolist(), edge.tolist(), stop):
                if rank in buckets:
                    buckets[rank].append(starts[at:end])
                    continue
                buckets[rank] = [starts[at:end]]
                a = rank >> 6
                word = low[a]
                low[a] = word | 1 << (rank & 63)
                if not word:
                    mid[a >> 6] |= 1 << (a & 63)
                    top |= 1 << (a >> 6)
            if not top:
                return token[alive], np.bincount(piece[alive], minlength=len(pieces))
            # pop: find-first-set on each level gives the lowest rank
            b = (top & -top).bit_length() - 1
            word = mid[b]
            a = b << 6 | (word & -word).bit_length() - 1
            word = low[a]
            rank = a << 6 | (word & -word).bit_length() - 1
            low[a] = word & (word - 1)
            if not low[a]:
                mid[b] &= mid[b] - 1
                if not mid[b]:
                    top &= top - 1
            bucket = buckets.pop(rank)
            there = np.concatenate(bucket) if len(bucket) > 1 else bucket[0]
            there = there[waiting[there] == rank]
            later = there[:0]
            if len(there) > 1:
                there = np.unique(there)
                own = piece[there]
                leftmost = np.concatenate([[True], own[1:] != own[:-1]])
                # the others of a pre-token wait: a lower rank may come up before them
                later, there = there[~leftmost], there[leftmost]
            gone = after[there]
            then, ahead = after[gone], before[there]
            token[there] = rank
            alive[gone] = False
            waiting[gone] = waiting[there] = -1
            after[there] = then
            some = then >= 0
            then, left = then[some], there[some]
            before[then] = left
            some = ahead >= 0
            ahead, right = ahead[some], there[some]
            starts = np.concatenate([left, ahead])
            ranks = self.merge_ranks(np.concatenate([token[left], token[ahead]]),
                                     np.concatenate([token[then], token[right]]))
            changed = waiting[starts] != ranks
            waiting[starts] = ranks
            changed &= ranks >= 0
            ranks = np.concatenate([ranks[changed], np.full(len(later), rank)])
            starts = np.concatenate([starts[changed], later])


class _Numbers(dict):
    """Key -> its number, in the order of first appearance."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.one, self.many = ranks, RankQueue(ranks), SharedQueue(ranks)
        self.pieces = regex.compile(pattern).findall

    def table(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids) of distinct pre-tokens."""
        whole = [self.ranks.get(p, -1) for p in pieces]
        counts = np.ones(len(pieces), dtype=np.int64)
        found = []  # (numbers of pre-tokens, their ids end to end)
        some = [i for i, r in enumerate(whole) if r >= 0]
        found.append((np.array(some, dtype=np.int64), np.array([whole[i] for i in some], dtype=np.int32)))
        held, size = [], 0
        for i, r in enumerate(whole):
            if r >= 0:
                continue
            if len(pieces[i]) >= LONG:
                ids = self.one.encode(pieces[i])
                counts[i] = len(ids)
                found.append((np.array([i]), np.array(ids, dtype=np.int32)))
                continue
            held.append(i)
            size += len(pieces[i])
            if size >= SHARED:
                found.append(self._shared(pieces, held, counts))
                held, size = [], 0
        if held:
            found.append(self._shared(pieces, held, counts))
        start = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), dtype=np.int32)
        for which, ids in found:
            size = counts[which]
            out[np.repeat(start[which] - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
        return out, counts

    def _shared(self, pieces, which, counts):
        ids, n = self.many.encode([pieces[i] for i in which])
        which = np.array(which)
        counts[which] = n
        return which, ids.astype(np.int32)

    def encode_all(self, texts) -> list[np.ndarray]:
        """Ids of each text (an iterable)."""
        numbers = _Numbers()
        numbered_texts = [np.fromiter(map(numbers.__getitem__, self.pieces(t)), dtype=np.int32) for t in texts]
        ids, counts = self.table([p.encode() for p in numbers])
        start = np.cumsum(counts) - counts

        def of(which: np.ndarray) -> np.ndarray:
            size = counts[which]
            shift = start[which] - (np.cumsum(size) - size)
            return ids[np.repeat(shift, size) + np.arange(int(size.sum()))]

        return [of(x) for x in numbered_texts]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    """One encoder for the tasks that a worker runs one after the other."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """row, id and ids (array of ints) of every text.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null and
    empty texts have no ids; repeated rows and null ids are rows like any other; an
    empty table gives no rows; other columns are ignored. ``ranks_path`` is read on
    the executors, where the vocabulary must be installed.
    """
    return _encoded(docs, ranks_path, pattern, id_col, text_col, False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass of one worker: row, id, ids and bytes, the
    latter made from the ids."""
    return _encoded(docs, ranks_path, pattern, id_col, text_col, True)


def _encoded(docs, ranks_path, pattern, id_col, text_col, decoded: bool) -> DataFrame:
    rows = numbered(docs, id=col(id_col), text=text_of(text_col))

    def run(batches):
        encoder = _encoder(ranks_path, pattern)
        bytes_of = _decoder(encoder.ranks) if decoded else None
        for batch in batches:
            texts = batch.column("text")
            for at, end in slices(texts, TOGETHER):
                found = encoder.encode_all(texts.slice(at, end - at).to_pylist())
                for k in range(0, end - at, 256):
                    some = found[k:k + 256]
                    n = len(some)
                    offsets = np.fromiter(accumulate(map(len, some), initial=0), dtype=np.int32, count=n + 1)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(some)))
                    out = [batch.column("row").slice(at + k, n), batch.column("id").slice(at + k, n), ids]
                    if decoded:
                        out.append(pa.array([bytes_of(x) for x in some], pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, names=["row", "id", "ids", "bytes"][:len(out)])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"row long, id {kind}, ids array<int>" + ", bytes binary" * decoded)


def _decoder(ranks: dict[bytes, int]):
    """A function from an array of ids to the bytes that they stand for."""
    vocabulary = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        vocabulary[rank] = piece
    part = vocabulary.__getitem__
    return lambda ids: b"".join(map(part, ids.tolist()))


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """``tokens`` (row, id, ids) with the bytes that the ids stand for (``bytes``)."""
    names = ["row", "id", "ids"]

    def run(batches):
        bytes_of = _decoder(read_ranks(ranks_path))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [bytes_of(np.asarray(x.values)) for x in some.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [some.column(c) for c in names] + [pa.array(found, pa.binary())], names=[*names, "bytes"])

    kind = tokens.schema["id"].dataType.simpleString()
    return tokens.select(*names).mapInArrow(run, f"row long, id {kind}, ids array<int>, bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    """id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 per document of ``decode`` or ``round_trip``."""
    return decoded.select(
        "id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
