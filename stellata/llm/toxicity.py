"""Toxicity by a linear-chain conditional random field over words.

Labelled tokens are derived from labelled documents: a word of a toxic document is
tagged if one of its features (the word, its first four, five or six letters) marks
toxic documents. A two-state chain is trained on the tagged tokens; forward-backward
marginals give the offending spans and, summed up, the score of a document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellata.llm.common import col, numbered, ship_code, slices, text_of, tidy

#: Bounds of the training sample: toxic documents (twice as many others), code points of
#: all their texts together, and documents of each label on which the chain is fitted.
SAMPLE, SAMPLE_POINTS, CHAINS = 1500, 12_000_000, 350
#: A feature marks toxic documents if a document with it is toxic with at least this
#: (smoothed) probability in a balanced sample, and if chance alone is expected to give
#: at most this many such features among all that were looked at.
PURE, CHANCE = 0.9, 0.05
#: Clean texts joined to one, in the fit of the score: what long clean texts look like.
JOINED = (8, 64)
_WORD = re.compile(r"[^\W\d_]+")
#: Words whose features a worker keeps, about (a memory bound).
_KEPT = 200_000


def features(word: str) -> list[str]:
    w = word.lower()
    return ["=" + w] + [w[:n] for n in (4, 5, 6) if len(w) >= n]


# --- the chain -------------------------------------------------------------------

def _scan(a, b, c, d, first: np.ndarray, at_first, block: int = 256) -> np.ndarray:
    """All values of r = (a * r + b) / (c * r + d), one step per element.

    Where ``first`` holds, the step is ``at_first`` / 1, whatever came before. Steps are
    2x2 matrices: blocks of them are multiplied side by side, then r runs over the
    blocks, then through all blocks at once.
    """
    n = len(first)
    rows = -(-n // block)

    def laid(x, start, pad):
        full = np.full(rows * block, pad, dtype=np.float64)
        full[:n] = x
        full[:n][first] = start[first] if isinstance(start, np.ndarray) else start
        return np.ascontiguousarray(full.reshape(rows, block).T)

    a, b, c, d = laid(a, 0.0, 1.0), laid(b, at_first, 0.0), laid(c, 0.0, 0.0), laid(d, 1.0, 1.0)
    A, B, C, D = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(block):
        A, C = a[t] * A + b[t] * C, c[t] * A + d[t] * C
        B, D = a[t] * B + b[t] * D, c[t] * B + d[t] * D
        if t % 8 == 7:  # eight potentials of at most exp(30) stay far from overflow
            scale = 1.0 / np.maximum(A + B, C + D)
            A, B, C, D = A * scale, B * scale, C * scale, D * scale
    into, r = np.empty(rows), 1.0
    for k, (x, y, z, w) in enumerate(zip(A.tolist(), B.tolist(), C.tolist(), D.tolist())):
        into[k] = r
        r = (x * r + y) / (z * r + w)
    out, r = np.empty((block, rows)), into
    for t in range(block):
        r = (a[t] * r + b[t]) / (c[t] * r + d[t])
        out[t] = r
    return out.T.reshape(-1)[:n]


def _shares(odds: np.ndarray) -> np.ndarray:
    return odds / (1.0 + odds)


def forward_backward(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float):
    """(marginals of state 1, expected transitions 2x2, log of the normaliser) of chains
    laid end to end. ``emit``: log potentials of state 1; ``first``: where chains begin;
    ``trans`` and ``start``: potentials of transitions, and of state 1 at the beginning."""
    n = len(emit)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    phi = np.exp(np.clip(emit, -30, 30))
    ahead = _scan(trans[1, 1] * phi, trans[0, 1] * phi, trans[1, 0], trans[0, 0], first, start * phi)
    # what follows a word, from the end of the chain: odds 1, then from the odds b of
    # the next word (t10 + phi * b * t11) / (t00 + phi * b * t01), phi of the next word
    last = np.concatenate([first[1:], [True]])[::-1]
    after = np.concatenate([phi[1:], [1.0]])[::-1]
    back = _scan(trans[1, 1] * after, trans[1, 0], trans[0, 1] * after, trans[0, 0], last, 1.0)[::-1]
    joint = ahead * back
    marginal = _shares(joint)
    # pairs of neighbours inside a chain
    left, right = ahead[:-1], back[1:]
    inner = ~first[1:]
    p0, p1 = 1.0 / (1.0 + left), left / (1.0 + left)
    to1 = phi[1:] * right
    w = np.stack([p0 * trans[0, 0], p0 * trans[0, 1] * to1, p1 * trans[1, 0], p1 * trans[1, 1] * to1])
    pairs = (w / w.sum(axis=0))[:, inner].sum(axis=1).reshape(2, 2)
    step = p0 * (trans[0, 0] + phi[1:] * trans[0, 1]) + p1 * (trans[1, 0] + phi[1:] * trans[1, 1])
    log_z = float(np.log(step[inner]).sum() + np.log1p(start * phi[first]).sum())
    return marginal, pairs, log_z


# --- training ----------------------------------------------------------------------

@dataclass
class Model:
    """Weights of features, of state 1 in general, of transitions and of the score."""
    weights: dict[str, float]
    bias: float
    trans: np.ndarray
    start: float
    score: np.ndarray
    noise: tuple[float, float] = (0.0, 0.0)  # per word of a clean text: marginal, chance of a tag

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum([get(f, 0.0) for f in features(word)])


def _signature(words: list[str]) -> tuple[int, ...]:
    """Equal for copies and most near copies: the lowest hashes of the set of word triples."""
    triples = {" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))}
    return tuple(sorted({zlib.crc32(t.encode()) for t in triples})[:3])


def _totals(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(strongest marginal, sum of the marginals, words) of each chain."""
    at = np.flatnonzero(first)
    return np.stack([np.maximum.reduceat(marginal, at), np.add.reduceat(marginal, at),
                     np.diff(np.append(at, len(marginal)))], axis=1)


def _inputs(totals: np.ndarray, noise: tuple[float, float]) -> np.ndarray:
    """What the logistic sees of each text: 1, its strongest word and its sum of marginals,
    both against what a clean text of as many words has by chance. A longer text has a
    stronger strongest word and a larger sum; neither says more about it for that."""
    strongest, total, words = np.maximum(totals, 0.0).T
    strongest = np.clip(strongest, 1e-9, 1 - 1e-9)
    level, chance = noise
    odds = np.log(strongest / (1 - strongest)) - np.log1p(chance * words)
    excess = (total - level * words) / np.sqrt(1.0 + level * words)
    return np.stack([np.ones(len(words)), odds / 4, np.log1p(np.maximum(excess, 0.0))], axis=1)


def _chains(texts: list[list[str]]) -> tuple[list[str], np.ndarray]:
    words = [w for t in texts for w in t]
    first = np.zeros(len(words), dtype=bool)
    first[np.cumsum([0] + [len(t) for t in texts])[:-1]] = True
    return words, first


def train(sample: list[tuple[str, int]], steps: int = 60, rate: float = 0.4, ridge: float = 1e-3,
          chains: int = CHAINS) -> Model:
    """A model from (text, label) pairs; copies of a text count once. Two thirds of them
    say which features mark toxic documents, and ``chains`` of these for each label train
    the chain; the score is fitted on the other third."""
    seen, toxic, fair = set(), [], []
    for text, label in sample:
        words = [w.lower() for w in _WORD.findall(text)]
        key = (_signature(words), label)
        if words and key not in seen:
            seen.add(key)
            (toxic if label else fair).append(words)
    if not toxic or not fair:
        # nothing to tell apart: the share of the only label there is
        p = math.log(9.0) * (1 if toxic else -1)
        return Model({}, -10.0, np.ones((2, 2)), 1.0, np.array([p, 0.0, 0.0]))
    part = lambda docs: (docs[: max(1, 2 * len(docs) // 3)], docs[2 * len(docs) // 3:] or docs)
    (toxic, toxic2), (fair, fair2) = part(toxic), part(fair)
    in_toxic = Counter(f for t in toxic for f in {x for w in set(t) for x in features(w)})
    in_fair = Counter(f for t in fair for f in {x for w in set(t) for x in features(w)})
    share = len(toxic) / (len(toxic) + len(fair))

    def evidence(n, other):  # log likelihood ratio of the feature's own share of toxic texts
        own = n / (n + other)
        return n * math.log(own / share) + (other * math.log((1 - own) / (1 - share)) if other else 0.0)

    needed = math.log(len(in_toxic) / CHANCE)
    marks = sorted(f for f, n in in_toxic.items()
                   if (n / len(toxic)) / (n / len(toxic) + (in_fair[f] + 0.5) / len(fair)) >= PURE
                   and evidence(n, in_fair[f]) >= needed)
    number = {f: i + 1 for i, f in enumerate(marks)}
    words, first = _chains(toxic[:chains] + fair[:chains])
    n_toxic = sum(map(len, toxic[:chains]))
    index: dict[str, int] = {}
    at = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
    table = np.zeros((len(index), 4), dtype=np.int64)
    for w, i in index.items():
        found = [number[f] for f in features(w) if f in number]
        table[i, :len(found)] = found
    tag = ((table[at] > 0).any(axis=1) & (np.arange(len(words)) < n_toxic)).astype(float)
    inner = ~first[1:]
    pair_counts = np.array([[((tag[:-1] == i) & (tag[1:] == j) & inner).sum() for j in (0, 1)] for i in (0, 1)])
    # parameters: features, bias, log transitions (0 -> 1, 1 -> 0, 1 -> 1), log start
    k = len(marks) + 1
    theta = np.zeros(k + 5)
    theta[k] = -3.0
    m, v, n = np.zeros_like(theta), np.zeros_like(theta), len(words)
    for step in range(1, steps + 1):
        weights = theta[:k].copy()
        weights[0] = 0.0
        trans = np.exp(np.array([[0.0, theta[k + 1]], [theta[k + 2], theta[k + 3]]]))
        emit = weights[table].sum(axis=1)[at] + theta[k]
        p, pairs, _ = forward_backward(emit, first, trans, math.exp(theta[k + 4]))
        rest = tag - p
        grad = np.zeros_like(theta)
        per_word = np.bincount(at, rest, minlength=len(index))
        grad[:k] = np.bincount(table.ravel(), np.repeat(per_word, 4), minlength=k)
        grad[0] = 0.0
        grad[k] = rest.sum()
        more = pair_counts - pairs
        grad[k + 1], grad[k + 2], grad[k + 3] = more[0, 1], more[1, 0], more[1, 1]
        grad[k + 4] = rest[first].sum()
        grad = grad / n * 100 - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        theta = np.clip(theta, -12, 12)
    trans = np.exp(np.array([[0.0, theta[k + 1]], [theta[k + 2], theta[k + 3]]]))
    model = Model({f: float(theta[i]) for f, i in number.items()}, float(theta[k]), trans,
                  math.exp(theta[k + 4]), np.zeros(3))
    words, first = _chains(toxic2 + fair2)
    emit = np.array([model.emission(w) for w in words])
    marginal = forward_backward(emit, first, model.trans, model.start)[0]
    totals = _totals(marginal, first)
    clean = totals[len(toxic2):]
    n = clean[:, 2].sum()
    tagged = (marginal[int(totals[:len(toxic2), 2].sum()):] >= 0.5).sum()
    model.noise = (float(clean[:, 1].sum() / n), float((tagged + 1) / n))
    groups, weights = [totals[:len(toxic2)], clean], [0.5, 0.4]
    for size in JOINED:
        at = np.arange(0, len(clean), size)
        groups.append(np.stack([np.maximum.reduceat(clean[:, 0], at), np.add.reduceat(clean[:, 1], at),
                                np.add.reduceat(clean[:, 2], at)], axis=1))
        weights.append(0.1 / len(JOINED))
    x = _inputs(np.concatenate(groups), model.noise)
    y = np.repeat([1.0, 0.0], [len(toxic2), len(x) - len(toxic2)])
    balance = np.concatenate([np.full(len(g), w / len(g)) for g, w in zip(groups, weights)])
    theta = np.zeros(3)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (balance * (y - p)) - 1e-3 * theta
        hess = (x * (balance * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3)
        theta = theta + np.linalg.solve(hess, grad)
    model.score = theta
    return model


def held_out(id_col: str):
    """Rows that are never learned from: crc32 of the id as text divisible by 5; rows
    without an id too."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE, points: int = SAMPLE_POINTS) -> Model:
    """Train on at most ``sample`` toxic and twice as many other labelled documents, of
    at most ``points`` code points together (the documented bound of what reaches the driver).

    Texts of any length are taken, whole, in the order of a hash of their ids; one that does
    not fit into what is left of its label's half of ``points`` is passed over. Only rows that are
    not held out are read; labels other than 0 and 1 and labels without a document are
    passed over, and rows that repeat an id count once, as the smallest of their texts. Without
    usable labels every score is the same.
    """
    known = (labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("label"),
                           held_out(id_col).alias("out"))
             .where("NOT out AND label IN (0, 1)").drop("out").distinct())
    chosen = None
    wanted = {0: 2 * sample, 1: sample}
    for label, n in wanted.items():  # twice as many as needed: some have no document
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(2 * n)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    # at most 6 * sample ids, and a row with two numbers for each of them on the driver
    sizes = (texts.select("id", F.length("text").alias("n")).join(F.broadcast(chosen), "id")
             .groupBy("id", "label").agg(F.max("n").alias("n"), F.xxhash64("id").alias("h")).collect())
    taken, left, room = [], dict(wanted), {0: points // 2, 1: points // 2}
    for r in sorted(sizes, key=lambda r: (r["h"], r["id"])):
        if left[r["label"]] and r["n"] <= room[r["label"]]:
            left[r["label"]] -= 1
            room[r["label"]] -= r["n"]
            taken.append((r["id"], r["label"]))
    if not taken:
        return train([])
    ids = docs.sparkSession.createDataFrame(taken, chosen.select("id", "label").schema)
    rows = (texts.join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
            .orderBy("label", F.xxhash64("id"), "id"))
    return train([(r["text"], r["label"]) for r in rows.select("text", "label").collect()])


# --- scoring -----------------------------------------------------------------------

class _Emissions(dict):
    """Word -> emission, found when first asked."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= _KEPT:
            self.clear()
        value = self[word] = self.model.emission(word)
        return value


class _Scorer:
    """Scores and spans of texts; keeps the emissions of words it has met."""

    def __init__(self, model: Model):
        self.model, self.emissions = model, _Emissions(model)

    def marginals(self, texts: list[str]):
        emission = self.emissions.__getitem__
        values, sizes = [], []
        for text in texts:
            words = _WORD.findall(text)
            values.append(np.fromiter(map(emission, words), dtype=np.float64, count=len(words)))
            sizes.append(len(words))
        sizes = np.array(sizes, dtype=np.int64)
        emit = np.concatenate(values) if values else np.zeros(0)
        first = np.zeros(len(emit) + 1, dtype=bool)
        first[np.cumsum(sizes) - sizes] = True
        first = first[:-1]
        return forward_backward(emit, first, self.model.trans, self.model.start)[0], first, sizes

    def scores(self, texts: list[str]):
        """(scores, marginals, words per text)."""
        marginal, first, sizes = self.marginals(texts)
        totals = np.zeros((len(texts), 3))  # no words at all
        if len(marginal):
            totals[sizes > 0] = _totals(marginal, first)
        x = _inputs(totals, self.model.noise)
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.model.score, -30, 30))), marginal, sizes


#: Bytes of the texts that one call of the chain takes, about.
_TOGETHER = 2_000_000


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, id, score (0 to 1) and spans (array of start, end: code points of the words
    whose marginal is at least one half, end exclusive) per document.

    The score depends on the text alone. Null and empty texts, and texts without words,
    get the score of a text in which nothing is tagged. Repeated rows and null ids are
    rows like any other; an empty table gives no rows; other columns are ignored.
    """
    rows = numbered(docs, id=col(id_col), text=text_of(text_col))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scorer = _Scorer(model)
        for batch in batches:
            column = batch.column("text")
            for begin, stop in slices(column, _TOGETHER):
                texts = column.slice(begin, stop - begin).to_pylist()
                found, marginal, sizes = scorer.scores(texts)
                spans, at = [], 0
                for text, n in zip(texts, sizes.tolist()):
                    tagged = np.flatnonzero(marginal[at:at + n] >= 0.5).tolist()
                    at += n
                    if tagged:
                        words = list(_WORD.finditer(text))
                        spans.append([{"start": words[i].start(), "end": words[i].end()} for i in tagged])
                    else:
                        spans.append([])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(begin, stop - begin) for c in ("row", "id")]
                    + [pa.array(found), pa.array(spans, span)], names=["row", "id", "score", "spans"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        tidy(run), f"row long, id {kind}, score double, spans array<struct<start:int,end:int>>")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all their columns, whose score is below ``threshold``.

    One pass, no shuffle: the rows that fail are left out of each slice of a batch."""
    at = docs.columns.index(text_col)
    ship_code(docs.sparkSession)

    def run(batches):
        scorer = _Scorer(model)
        for batch in batches:
            column = batch.column(at)
            for begin, stop in slices(column, _TOGETHER):
                texts = [x or "" for x in column.slice(begin, stop - begin).to_pylist()]
                keep = scorer.scores(texts)[0] < threshold
                yield batch.slice(begin, stop - begin).filter(pa.array(keep))

    # by place, not by name: a name may hold dots
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(tidy(run), plain.schema).toDF(*names)
