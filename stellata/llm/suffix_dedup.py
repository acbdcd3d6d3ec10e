"""Removal of repeated byte strings by suffix arrays built with a difference cover.

Suffixes are dealt to parts by the content of their first 50 bytes, so that all
suffixes that begin with the same 50 bytes meet in one part. There the difference-cover
algorithm sorts them: triples at two thirds of the positions are sorted and named,
the string of names is sorted recursively, the remaining suffixes are merged in, and
neighbours in the order are compared by their first 50 bytes.

How suffixes are dealt: a 50-byte string has 35 substrings of 16 bytes; the least of
their hashes is its key, equal for equal strings. In larger tables more substrings of 16 bytes are
in two documents by chance, which would send and sort ever more of the text: there the substrings
are longer, by a byte for each time that the text doubles. Neighbouring suffixes mostly
share their key, so they travel as one piece of text with 49 more bytes. A key that
only one document has cannot belong to a repeated string: those suffixes stay home.
Documents travel in chunks, and a chunk sends equal pieces once.

What a chunk learns of its keys is their last 32 bits: a key that is taken for a shared
one by them sends a piece too many, which changes no result. Pieces travel packed.

A key whose pieces are all equal needs no sort: its strings occur in copies of that piece
only. The suffixes of all other pieces are sorted.

A short string with many different neighbours is the key of very many different
pieces. The bytes of the different pieces of each key are counted before anything is sent
(equal ones once, however many chunks hold them); the suffixes of a key above what one
task should sort are dealt by the hash of their whole 50 bytes instead: equal strings
still meet, and those that only one document has stay home. There is at most one such key
for each ``HOT_BYTES`` of pieces; all tasks are told them, so that the documents need not be
dealt out once more to find them.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, stored, text_of, with_row

WINDOW, GRAM = 50, 16
#: Text bytes of a chunk on average and its rows at most, text bytes per part of the keys and of the pieces
#: at least, and at most where there would be more than ``FEW`` parts.
CHUNK_BYTES, CHUNK_ROWS, KEY_BYTES, PIECE_BYTES, PART_BYTES, FEW = 4 << 20, 4096, 8 << 20, 2 << 20, 16 << 20, 256
#: Text bytes above which keys have a byte more for each time that the text doubles.
_PLAIN = 4 << 20
#: Positions whose keys are computed together, and suffixes of one piece at most.
_SPAN, _LONGEST = 1 << 16, 4096
#: Bytes of pieces of a part that are sorted together.
_SORTED = 1 << 20
_NO_ID = np.iinfo(np.int64).max
#: Bytes of different pieces of one key that one task sorts at most.
HOT_BYTES = 2 << 20
#: The pieces of a key in a chunk are told by 32 bits: their bytes in units, and a hash.
_UNIT, _TAG = 16, 12
#: An odd base of the hash of pieces, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


# --- the difference-cover algorithm --------------------------------------------------

def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``s`` (integers from 1) in their order."""
    n = len(s)
    if n < 6:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    p = np.concatenate([s, np.zeros(3, dtype=s.dtype)]).astype(np.int64)
    base = int(p.max()) + 1
    extra = n + (n % 3 == 1)  # one triple more keeps the two halves of names apart
    first, second = np.arange(1, extra, 3), np.arange(2, extra, 3)
    sample = np.concatenate([first, second])
    size = len(sample) + 1
    pairs = p[:-1] * base + p[1:]
    if base * base * max(base, size) >= 2 ** 63:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    # sort the sampled triples and name them
    key = np.concatenate([pairs[k:extra:3] * base + p[k + 2:extra + 2:3] for k in (1, 2)])
    if base ** 3 <= 1 << 25:  # of bytes: a counting sort
        there = np.zeros(base ** 3, dtype=bool)
        there[key] = True
        named = (np.cumsum(there, dtype=np.int32) - 1)[key]
        names = int(np.count_nonzero(there))
    else:
        by = np.argsort(key)
        fresh = np.concatenate([[0], (key[by[1:]] != key[by[:-1]]).astype(np.int64)])
        named = np.empty(len(key), dtype=np.int64)
        named[by] = np.cumsum(fresh)
        names = int(named[by[-1]]) + 1
    # recurse on the names while some are equal
    if names < len(sample):
        order = suffix_array(named.astype(np.int64) + 1)
    else:
        order = np.argsort(named)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    rank[n:] = 0
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < n]
    # the remaining suffixes: by their first symbol and the rank of what follows
    one, two = p[:n] * size + rank[1:n + 1], pairs[:n] * size + rank[2:n + 2]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(one[::3])]
    # merge: against the first half one symbol decides, against the second two
    nth = sorted_sample % 3
    before = np.searchsorted(one[sorted_sample[nth == 1]], one[rest])
    before += np.searchsorted(two[sorted_sample[nth == 2]], two[rest])
    out = np.empty(n, dtype=np.int64)
    at = np.arange(len(rest)) + before
    taken = np.zeros(n, dtype=bool)
    taken[at] = True
    out[at] = rest
    out[~taken] = sorted_sample
    return out


def least_ids(data: bytes, lengths: np.ndarray, ids: np.ndarray, window: int = WINDOW):
    """For the windows of each piece, one after the other, the least id of the pieces that hold the
    window; and where those of each piece begin. ``data``: the pieces, each with a zero byte behind it."""
    data = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    begin = np.cumsum(lengths + 1) - lengths - 1
    symbols = data[:-8].astype(np.int64) + 2
    symbols[begin + lengths] = 1
    # only symbols that occur: triples are named by counting
    symbols = np.cumsum(np.bincount(symbols) > 0)[symbols[:-1]]
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), counts)
    offset = np.cumsum(counts) - counts
    starts = np.arange(len(owner)) + (begin - offset)[owner]
    slot = np.full(len(symbols), -1, dtype=np.int32)
    slot[starts] = np.arange(len(starts), dtype=np.int32)
    order = suffix_array(symbols)
    slots = slot[order]
    valid = slots >= 0
    order, slots = order[valid], slots[valid]
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view(np.uint64).ravel()
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for o in [*range(0, window - 7, 8), window - 8]:  # compare adjacent prefixes
        at = words[order + o]
        same &= at[1:] == at[:-1]
    groups = np.concatenate([[True], ~same])
    least = np.minimum.reduceat(ids[owner[slots]], np.flatnonzero(groups))
    out = np.empty(len(starts), dtype=np.int64)
    out[slots] = least[np.cumsum(groups) - 1]
    return out, offset


# --- keys and runs -------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def _keys(data: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Least hash of the grams of each window of ``data``."""
    h = data.astype(np.uint64) + np.uint64(1)
    have, factor = 1, 0x100000001B3
    while have < gram:  # hash of `have` + `more` bytes from two shorter ones
        more = min(have, gram - have)
        n = len(h) - more
        h = h[:n] * np.uint64(pow(factor, more, 1 << 64)) + h[more:] if more == have else (
            h[:n] * np.uint64(pow(factor, have, 1 << 64)) + h[more:])
        have += more
    h = _mixed(h)
    h ^= h >> np.uint64(32)
    have, width = 1, window - gram + 1
    while have < width:
        more = min(have, width - have)
        h = np.minimum(h[:len(h) - more], h[more:])
        have += more
    return h


@functools.lru_cache(maxsize=8)
def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _powers(base: int, n: int) -> np.ndarray:
    return _power_table(base, 1 << n.bit_length())[:n]


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range: differences of prefix sums, shifted back."""
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(
        _mixed(np.arange(1, 257, dtype=np.uint64))[data] * _powers(_BASE, len(data)))])
    return _mixed((sums[end] - sums[begin]) * _powers(_BACK, len(data) + 1)[begin] + (end - begin).astype(np.uint64))


def _runs(texts: list[bytes], window: int, gram: int, hashed: bool = False):
    """(text, start, windows, key) arrays of the runs of windows with equal keys, and
    if asked for a hash of the bytes of each.

    Longer runs are cut; every window of every text is in exactly one run."""
    def pieces():
        held, size = [], 0
        for k, text in enumerate(texts):
            n = len(text) - window + 1
            for at in range(0, max(0, n), _SPAN):
                piece = text[at:at + _SPAN + window - 1]
                held.append((k, at, piece))
                size += len(piece)
                if size >= _SPAN:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    found = []
    for held in pieces():
        data = np.frombuffer(b"".join(x for _, _, x in held), dtype=np.uint8)
        sizes = np.fromiter((len(x) for _, _, x in held), dtype=np.int64, count=len(held))
        begin = np.cumsum(sizes) - sizes
        keys = _keys(data, window, gram)
        n = len(keys)
        cut = np.ones(n, dtype=bool)
        cut[1:] = keys[1:] != keys[:-1]
        valid = np.ones(n + 1, dtype=bool)
        stop = begin + sizes - window + 1  # windows from here would run into the next text
        for b in stop[:-1].tolist():
            valid[b:b + window - 1] = False
        valid = valid[:n]
        cut[begin] = True
        cut &= valid
        at = np.flatnonzero(cut)
        which = np.searchsorted(begin, at, side="right") - 1
        length = np.minimum(np.append(at[1:], n), stop[which]) - at
        if length.max() > _LONGEST:
            parts = -(-length // _LONGEST)
            of = np.repeat(np.arange(len(at)), parts)
            nth = np.arange(len(of)) - (np.cumsum(parts) - parts)[of]
            at, which = at[of] + nth * _LONGEST, which[of]
            length = np.minimum(length[of] - nth * _LONGEST, _LONGEST)
        number = np.array([k for k, _, _ in held], dtype=np.int64)
        shift = np.array([a for _, a, _ in held], dtype=np.int64)
        found.append((number[which], at - begin[which] + shift[which], length, keys[at],
                      *([_hashes(data, at, at + length + window - 1)] if hashed else [])))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, *[none.astype(np.uint64)] * (1 + hashed)
    return tuple(np.concatenate(x) for x in zip(*found))


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((_mixed(keys) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _chunk_of(table):
    """(rows, ids, texts) of a chunk, in the order of the rows."""
    rows = np.asarray(table.column("row"))
    ids = np.array([_NO_ID if x is None else x for x in table.column("id").to_pylist()], dtype=np.int64)
    texts = [b"" if x is None else x for x in table.column("text").to_pylist()]
    order = np.argsort(rows, kind="stable")
    return rows[order], ids[order], [texts[i] for i in order.tolist()]


def _blobs(which: np.ndarray, parts: int, *columns):
    """(part, columns of that part) for the parts that occur."""
    order = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[order], np.arange(parts + 1))
    for k in range(parts):
        if edges[k] < edges[k + 1]:
            at = order[edges[k]:edges[k + 1]]
            yield k, at, [c[at] for c in columns]


def key_length(size: int, window: int = WINDOW) -> int:
    """Bytes of the substrings that decide where the windows of a text of ``size`` bytes go: in a larger text longer
    ones are in two documents by chance."""
    return max(GRAM, min(window * 2 // 3, GRAM + (size // _PLAIN).bit_length()))


def part_bytes(size: int, least: int) -> int:
    """Text bytes per part: with few parts ``least``. Each chunk sends a row to each part, so more parts become larger
    instead, up to ``PART_BYTES``."""
    return min(PART_BYTES, max(least, size // FEW))


# --- the steps -----------------------------------------------------------------------

def _pieces_of_keys(size: np.ndarray, tags: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """What a chunk says about the pieces of each of its keys (``edge``: where a key begins): the
    bytes of the different ones in units and a hash of them all, in 32 bits."""
    n = np.diff(np.append(edge, len(size)))
    several = np.flatnonzero(np.repeat(n > 1, n))
    if len(several):  # equal pieces count once
        of = np.repeat(np.arange(len(n)), n)[several]
        order = np.lexsort((tags[several], of))
        at = several[order]
        again = at[1:][(of[order][1:] == of[order][:-1]) & (tags[at[1:]] == tags[at[:-1]])]
        size, tags = size.copy(), tags.copy()
        size[again], tags[again] = 0, 0
    units = np.minimum(-(-np.add.reduceat(size, edge) // _UNIT), (1 << 32 - _TAG) - 1).astype(np.uint32)
    return units << np.uint32(_TAG) | (np.add.reduceat(tags, edge) >> np.uint64(64 - _TAG)).astype(np.uint32)


def _key_rows(parts: int, chunk: int, keys: np.ndarray, ids: np.ndarray, weigh):
    """(part, chunk, keys, several, pieces) rows of a chunk; ``ids``: whose each key is."""
    order = np.argsort(keys)
    keys, of = keys[order], ids[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    several = np.minimum.reduceat(of, edge) != np.maximum.reduceat(of, edge)
    keys = keys[edge]
    return [(k, chunk, x.tobytes(), f.tobytes(), w.tobytes())
            for k, _, (x, f, w) in _blobs(_part(keys, parts), parts, keys, several, weigh(order, edge))]


_KEY_NAMES = ["part", "chunk", "keys", "several", "pieces"]
_KEY_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_KEY_SCHEMA = "part int, chunk long, keys binary, several binary, pieces binary"


def _of_chunks(key_rows):
    """A step over batches of documents; ``key_rows`` makes the rows of a chunk, or of what a batch has of it."""
    def run(batches):
        for batch in batches:
            chunks = np.asarray(batch.column("chunk"))
            out = []
            for chunk in np.unique(chunks).tolist():
                _, ids, texts = _chunk_of(pa.table(batch.filter(pa.array(chunks == chunk))))
                out += key_rows(chunk, ids, texts)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), _KEY_TYPES)], names=_KEY_NAMES)
    return run


def _send_keys(parts: int, window: int, gram: int):
    def key_rows(chunk, ids, texts):
        text, _, length, keys, tags = _runs(texts, window, gram, hashed=True)
        if not len(keys):
            return []
        return _key_rows(parts, chunk, keys, ids[text], lambda order, edge: _pieces_of_keys(
            (length + window - 1)[order], tags[order], edge))

    return _of_chunks(key_rows)


def _short(keys: np.ndarray) -> np.ndarray:
    """The bits of keys by which a chunk is told which of its own are meant."""
    return keys.astype(np.uint32)


def _numbers(table, name: str, kind=np.uint64) -> np.ndarray:
    """All numbers of a column of blobs, each once."""
    return np.unique(np.concatenate([np.zeros(0, dtype=kind)] + [
        np.frombuffer(x.as_py(), dtype=kind) for x in table.column(name)]))


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where ``keys`` have one of ``wanted``: a table of bits first, the exact test for what it lets through."""
    wide = np.uint64((1 << max(16, len(wanted).bit_length() + 3)) - 1)
    there = np.zeros(int(wide) + 1, dtype=bool)
    there[wanted & wide] = True
    at = np.flatnonzero(there[keys & wide])
    return at[np.isin(keys[at], wanted)]


def _firsts(data: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each range of bytes the number of the first one equal to it."""
    index: dict[bytes, int] = {}
    return np.array([index.setdefault(data[a:b], k) for k, (a, b) in enumerate(
        zip(begin.tolist(), (begin + size).tolist()))], dtype=np.int64)


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin there and have so many."""
    return np.arange(int(n.sum())) + np.repeat(begin - np.cumsum(n) + n, n)


def _joined(texts: list[bytes]):
    """All texts as one, and where each begins."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return b"".join(texts), np.cumsum(sizes) - sizes


def _windows_of(texts, text, start, length, window: int):
    """(text, start, hash of the whole window) of each window of the given runs."""
    of = np.repeat(np.arange(len(text)), length)
    first = np.cumsum(length) - length
    at = start[of] + np.arange(len(of)) - first[of]
    pieces = [_keys(np.frombuffer(texts[t], dtype=np.uint8)[s:s + n + window - 1], window, window)
              for t, s, n in zip(text.tolist(), start.tolist(), length.tolist())]
    return text[of], at, np.concatenate([np.zeros(0, dtype=np.uint64)] + pieces)


def _send_windows(parts: int, window: int, gram: int, hot: np.ndarray):
    """The keys of the second deal: hashes of the windows whose first key is hot."""
    def key_rows(chunk, ids, texts):
        text, start, length, keys = _runs(texts, window, gram)
        at = np.flatnonzero(np.isin(keys, hot))
        if not len(at):
            return []
        text, _, keys = _windows_of(texts, text[at], start[at], length[at], window)
        return _key_rows(parts, chunk, keys, ids[text], lambda order, edge: np.zeros(len(edge), dtype=np.uint32))

    return _of_chunks(key_rows)


def _shared_keys(bound: int, short=_short):
    """For each chunk of a part, which of its keys another document has too: those whose
    different pieces have at most ``bound`` bytes (in short) and the hot ones. Beside the
    first chunk, all hot ones of the part."""
    def run(table):
        keys = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("keys")]
        several = np.concatenate([np.frombuffer(x.as_py(), dtype=bool) for x in table.column("several")])
        pieces = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint32) for x in table.column("pieces")])
        values, at, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = (n > 1) | np.bincount(at, several, minlength=len(values)).astype(bool)
        told = shared[at]
        told = np.unique(at[told] << 32 | pieces[told])
        heavy = np.bincount(told >> 32, ((told & 0xFFFFFFFF) >> _TAG) * _UNIT, minlength=len(values)) > bound
        edges = np.cumsum([len(k) for k in keys])[:-1]
        mine, hot = (np.split(x[at], edges) for x in (shared & ~heavy, shared & heavy))
        every = [values[shared & heavy].tobytes()] + [b""] * (len(keys) - 1)
        return pa.table({"chunk": table.column("chunk"),
                         "keys": pa.array([short(k[m]).tobytes() for k, m in zip(keys, mine)], pa.binary()),
                         "hot": pa.array([k[m].tobytes() for k, m in zip(keys, hot)], pa.binary()),
                         "every_hot": pa.array(every, pa.binary())})

    return run


def _packed(blobs: list[bytes]) -> tuple[int, bytes]:
    """The length of all blobs together, and them as one Zstandard frame."""
    data = b"".join(blobs)
    return len(data), pa.compress(data, codec="zstd", asbytes=True)


#: What is sent of a piece before its bytes: text, start, size, and the least and greatest id that have it.
_PIECE = [np.int32] * 3 + [np.int64] * 2


def _unpacked(n: int, size: int, packed: bytes):
    """(text, start, size, least, most, bytes) of ``n`` pieces."""
    data = pa.decompress(packed, size, codec="zstd", asbytes=True)
    out, at = [], 0
    for kind in _PIECE:
        out.append(np.frombuffer(data, dtype=kind, count=n, offset=at).copy())  # else it would keep all of ``data``
        at += out[-1].nbytes
    return *out, data[at:]


def _send_pieces(parts: int, window: int, gram: int):
    names = ["part", "chunk", "n", "size", "bytes"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(docs, shared):
        out = []
        if docs.num_rows and shared.num_rows:
            _, ids, texts = _chunk_of(docs)
            text, start, length, keys = _runs(texts, window, gram)
            at = _among(keys, _numbers(shared, "hot"))
            hot = [x[at] for x in (text, start, length)]
            at = _among(_short(keys), _numbers(shared, "keys", np.uint32))
            text, start, length, keys, place = text[at], start[at], length[at], keys[at], start[at]
            data, begin = _joined(texts)
            size = length + window - 1
            first = _firsts(data, begin[text] + start, size)
            if len(hot[0]):  # windows by themselves, told from runs by a start below zero
                t, s, h = _windows_of(texts, *hot, window)
                both = _among(h, _numbers(shared, "windows"))
                t, s, h = t[both], s[both], h[both]
                n = np.full(len(t), window, dtype=np.int64)
                first = np.concatenate([first, len(first) + _firsts(data, begin[t] + s, n)])
                text, start, size, keys, place = (np.concatenate(x) for x in (
                    (text, t), (start, s), (size, n), (keys, h), (place, -1 - s)))
            if len(first):
                least, most = ids[text], ids[text]
                np.minimum.at(least, first, ids[text])
                np.maximum.at(most, first, ids[text])
                kept = np.flatnonzero(first == np.arange(len(first)))
                place, where = place[kept], (begin[text] + start)[kept]
                columns = [x.astype(kind) for kind, x in zip(
                    _PIECE, (text[kept], place, size[kept], least[kept], most[kept]))]
                for part, _, (*cols, where) in _blobs(_part(keys[kept], parts), parts, *columns, where):
                    out.append((part, int(docs.column("chunk")[0].as_py()), len(where), *_packed(
                        [c.tobytes() for c in cols] + [data[a:b] for a, b in zip(
                            where.tolist(), (where + cols[2]).tolist())])))
        cols = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return run, "part int, chunk long, n int, size int, bytes binary"


def _sort_pieces(window: int, gram: int):
    """One part: sort its suffixes, give each chunk the least ids of its pieces (one id and a
    size below zero where all windows of a piece have the same)."""
    names = ["chunk", "text", "start", "size", "least"]

    def keys_of(data, begin):
        """The key of each piece is that of its first window."""
        held = [_keys(data[begin[k:k + _SPAN // window, None] + np.arange(window)].ravel(), window, gram)[::window]
                for k in range(0, len(begin), _SPAN // window)]
        return np.concatenate([np.zeros(0, dtype=np.uint64), *held])

    def run(table):
        rows = [_unpacked(*(x.as_py() for x in r)) for r in zip(*(table.column(c) for c in ("n", "size", "bytes")))]
        text, start, size, low, high = (np.concatenate(x) for x in list(zip(*rows))[:5])
        edges = np.cumsum([0] + [len(r[0]) for r in rows])
        data = b"".join([r[5] for r in rows])
        del rows
        begin = np.cumsum(size, dtype=np.int64) - size
        keys = keys_of(np.frombuffer(data, dtype=np.uint8), begin)
        # for each piece: the least id of it, or of its windows if they differ (where they are among ``windows``)
        bottom, at, differ = low.copy(), np.zeros(len(low), dtype=np.int64), np.zeros(len(low), dtype=bool)
        windows, done = [], 0
        units = max(1, len(data) // _SORTED)
        for _, mine, _ in _blobs(_part(_mixed(keys), units), units):
            first = _firsts(data, begin[mine], size[mine])
            least = low[mine]
            np.minimum.at(least, first, low[mine])
            kept = np.flatnonzero(first == np.arange(len(first)))
            # a piece that has its key alone is not sorted
            _, of, n = np.unique(keys[mine[kept]], return_inverse=True, return_counts=True)
            some = kept[n[of] > 1]
            lowest, place, several = least.copy(), np.zeros(len(mine), dtype=np.int64), np.zeros(len(mine), dtype=bool)
            if len(some):
                a, n = begin[mine[some]], size[mine[some]].astype(np.int64)
                found, offset = least_ids(b"\0".join([data[x:y] for x, y in zip(
                    a.tolist(), (a + n).tolist())]) + b"\0", n, least[some], window)
                lowest[some] = np.minimum.reduceat(found, offset)
                several[some] = lowest[some] != np.maximum.reduceat(found, offset)
                some, offset, n = some[several[some]], offset[several[some]], (n - window + 1)[several[some]]
                place[some] = done + np.cumsum(n) - n
                windows.append(found[_ranges(offset, n)])
                done += len(windows[-1])
            bottom[mine], at[mine], differ[mine] = lowest[first], place[first], several[first]
        windows = np.concatenate([np.zeros(0, dtype=np.int64), *windows])
        out = []
        for chunk, a, b in zip(table.column("chunk").to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
            keep = a + np.flatnonzero(bottom[a:b] < high[a:b])
            if len(keep):
                mixed = differ[keep]
                given = np.where(mixed, size[keep] - window + 1, 1)
                least = np.repeat(bottom[keep], given)
                least[np.repeat(mixed, given)] = windows[_ranges(at[keep[mixed]], given[mixed])]
                out.append((chunk, text[keep].tobytes(), start[keep].tobytes(),
                            np.where(mixed, size[keep], -size[keep]).tobytes(), least.tobytes()))
        cols = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.int64()] + [pa.binary()] * 4)], names=names)

    return run, "chunk long, " + ", ".join(f"`{n}` binary" for n in names[1:])


def _remove(window: int, gram: int, id_type: str):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(docs, found):
        if not docs.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "id": docs.column("id"),
                             "spans": pa.array([], span), "kept": pa.array([], pa.binary())})
        rows, ids, texts = _chunk_of(docs)
        data, begin = _joined(texts)
        flags = np.zeros(len(data), dtype=bool)  # windows that go
        if found.num_rows:
            which, start, size, least = (np.frombuffer(b"".join([x.as_py() for x in found.column(c)]), dtype=kind)
                                         for c, kind in zip(("text", "start", "size", "least"), [np.int32] * 3 + [np.int64]))
            given = np.where(size < 0, 1, size - window + 1)
            at = np.cumsum(given) - given
            n = np.abs(size).astype(np.int64)
            one = start < 0  # windows of hot keys
            place = np.where(one, -1 - start, start).astype(np.int64)
            where = begin[which] + place
            text, first, length, keys = _runs(texts, window, gram)
            starts = begin[text] + first  # runs are in order
            told = np.flatnonzero(~one)
            if len(told):
                index = {data[a:b]: k for k, a, b in zip(
                    told.tolist(), where[told].tolist(), (where + n)[told].tolist())}
                own = _among(keys, np.unique(keys[np.searchsorted(starts, where[told])]))
                answer = np.array([index.get(data[a:b], -1) for a, b in zip(
                    starts[own].tolist(), (starts + length + window - 1)[own].tolist())], dtype=np.int64)
                own, answer = own[answer >= 0], answer[answer >= 0]
                runs = length[own]
                nth = _ranges(np.zeros(len(own), dtype=np.int64), runs)
                of = np.repeat(answer, runs)
                flags[np.repeat(starts[own], runs) + nth] = (
                    least[at[of] + np.where(size[of] < 0, 0, nth)] < np.repeat(ids[text[own]], runs))
            told = np.flatnonzero(one)
            if len(told):
                index = {data[a:a + window]: k for k, a in zip(told.tolist(), where[told].tolist())}
                of = np.searchsorted(starts, where[told], side="right") - 1
                own = _among(keys, np.unique(keys[of]))
                t, s, hashes = _windows_of(texts, text[own], first[own], length[own], window)
                known = np.unique(np.concatenate([_keys(np.frombuffer(x, dtype=np.uint8), window, window)
                                                  for x in index]))
                own = _among(hashes, known)
                t, s = t[own], begin[t[own]] + s[own]
                answer = np.array([index.get(data[a:a + window], -1) for a in s.tolist()], dtype=np.int64)
                t, s, answer = t[answer >= 0], s[answer >= 0], answer[answer >= 0]
                flags[s] = least[at[answer]] < ids[t]
        total = np.concatenate([np.zeros(window, dtype=np.int32), np.cumsum(flags, dtype=np.int32)])
        covered = np.zeros(len(data) + 1, dtype=bool)
        covered[:-1] = total[window:] > total[:-window]
        edge = np.zeros(len(data) + 1, dtype=bool)  # where a text begins
        edge[begin] = True
        before = np.concatenate([[False], covered[:-1]])
        a, b = np.flatnonzero(covered & (~before | edge)), np.flatnonzero(before & (~covered | edge))
        sizes = np.diff(np.append(begin, len(data)))
        nth = np.searchsorted(begin + sizes, a, side="right")  # whose each span is
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(nth, np.arange(len(texts) + 1)).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(a - begin[nth]), pa.array(b - begin[nth])], ["start", "end"]))
        gone = np.bincount(nth, b - a, minlength=len(texts)).astype(np.int64)
        left = np.frombuffer(data, dtype=np.uint8)[~covered[:-1]].tobytes()
        kept = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(
            np.concatenate([[0], np.cumsum(sizes - gone)]).astype(np.int32).tobytes()), pa.py_buffer(left)])
        order = np.argsort(np.asarray(docs.column("row")), kind="stable")
        return pa.table({"row": pa.array(rows), "id": docs.column("id").take(pa.array(order)),
                         "spans": spans.cast(span), "kept": kept})

    return run, f"row long, id {id_type}, spans array<struct<start:long,end:long>>, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int | None = None, chunk_rows: int | None = None, key_bytes: int | None = None,
                   piece_bytes: int | None = None, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """One row per document: row, id, spans (removed ranges of bytes) and kept (the
    other bytes, joined).

    Texts are UTF-8 bytes. A byte goes if a string of ``window`` bytes that covers it
    also starts in a document with a smaller id; strings are judged on the input, and
    matches never cross documents. Null counts as empty; texts shorter than the window
    keep all bytes. Ids are integers; rows that repeat an id are one document here, so
    they do not remove from each other; null ids come after all others and do not remove
    from each other either. An empty table gives no rows; other columns are ignored.

    Memory: a chunk of ``chunk_rows`` documents (by themselves, as many as have about
    ``CHUNK_BYTES`` of text, a power of two), or one part (by itself, see ``part_bytes``).
    A repeated string reaches its part once per chunk that holds it. No result depends on
    ``gram`` (by itself, see ``key_length``) or the bytes of parts. Suffixes of a key with more than
    ``hot_bytes`` of different pieces are dealt by all their bytes; the driver gathers
    these keys, 8 bytes each.
    """
    docs, row = with_row(docs)
    size, n = docs.agg(F.sum(F.octet_length(text_of(text_col))), F.count("*")).first()
    size = size or 0
    if chunk_rows is None:
        fit = min(CHUNK_ROWS, max(1, CHUNK_BYTES * n // max(size, 1)))
        chunk_rows = 1 << fit.bit_length() - 1
    rows = (numbered(docs, row, id=col(id_col), text=text_of(text_col))
            .select(F.floor(F.col("row") / chunk_rows).alias("chunk"), "row", "id",
                    F.encode("text", "UTF-8").alias("text")))
    if gram is None:
        gram = key_length(size, window)
    key_bytes, piece_bytes = key_bytes or part_bytes(size, KEY_BYTES), piece_bytes or part_bytes(size, PIECE_BYTES)
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_parts, piece_parts = max(least, size // key_bytes), max(least, size // piece_bytes)
    keys = rows.mapInArrow(_send_keys(key_parts, window, gram), _KEY_SCHEMA)
    answer = "chunk long, keys binary, hot binary, every_hot binary"
    shared = stored(keys.groupBy("part").applyInArrow(_shared_keys(hot_bytes), answer).where(
        "octet_length(keys) > 0 OR octet_length(hot) > 0 OR octet_length(every_hot) > 0"), "shared_keys")
    hot = np.frombuffer(b"".join([x[0] for x in shared.where("octet_length(every_hot) > 0").select(
        "every_hot").collect()]), dtype=np.uint64)
    nothing = F.lit(b"")
    shared = shared.select("chunk", "keys", "hot", nothing.alias("windows"))
    if len(hot):
        again = rows.mapInArrow(_send_windows(key_parts, window, gram, hot), _KEY_SCHEMA)
        # of equal windows there is nothing to deal out further
        windows = stored(again.groupBy("part").applyInArrow(
            _shared_keys(np.iinfo(np.int64).max, short=lambda keys: keys), answer)
            .where("octet_length(keys) > 0").select("chunk", F.col("keys").alias("windows")), "shared_windows")
        shared = shared.unionByName(
            windows.select("chunk", nothing.alias("keys"), nothing.alias("hot"), "windows"))
    send, schema = _send_pieces(piece_parts, window, gram)
    pieces = rows.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(send, schema)
    sort, schema = _sort_pieces(window, gram)
    found = stored(pieces.groupBy("part").applyInArrow(sort, schema), "repeats")
    remove, schema = _remove(window, gram, rows.schema["id"].dataType.simpleString())
    return rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(remove, schema)


def report(removed: DataFrame) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 from ``remove_repeats``."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return removed.select("id", (F.octet_length("kept").cast("long") + gone).alias("n_bytes"),
                          gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
