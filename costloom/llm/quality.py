"""Quality scores by a generalised additive model with pairwise interactions.

Features are counts and shares of whole texts. Cyclic boosting goes round the features; in each turn a tree of at most four
leaves over one feature's bins is fitted to the residual's gradient, and its leaf values are added to the feature's lookup
table. Then the pairs of features that explain most of what is left, by the best cut of both, are boosted the same way into
tables over two features' bins. A score is the sigmoid of a sum of table entries, looked up for whole batches.

Learning uses at most ``SAMPLE_ROWS`` labelled rows, picked by a hash of the id; every document is scored.

Null texts count as empty; empty texts have features of zero and a score like any other. Very long texts are read whole, in pieces of
a million characters. Rows with null ids are never learned from and not held out. Null labels are ignored, repeated labels
count repeatedly. Without labels every score is one half. Ties between cuts go to the first. Repeated rows get equal
scores, empty tables give empty results, other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import checkpointed, map_texts

FEATURES = ("log_words", "word_length", "letters", "digits", "capitals", "spaces", "stops", "symbols", "distinct_words", "top_word",
            "repeated_neighbours", "marked_ends", "short_words", "long_words", "lines", "repeated_lines", "capital_words", "entropy",
            "distinct_pairs")
BINS = 32
PAIR_BINS = 8
ROUNDS = 60
PAIRS = 6
RATE = 0.2
SAMPLE_ROWS = 20_000
PIECE = 1 << 20
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Kind of every code point: 0 small letter, 1 capital, 2 digit, 3 white space, 4 stop, 5 other."""
    if not _KINDS:
        kind = np.full(0x110000, 5, np.uint8)
        for c in range(0x30000):
            s = chr(c)
            if s.isalpha():
                kind[c] = 1 if s.isupper() else 0
            elif s.isdigit():
                kind[c] = 2
            elif s.isspace():
                kind[c] = 3
        kind[[ord(x) for x in ".,;:!?'\"()-"]] = 4
        _KINDS.append(kind)
    return _KINDS[0]


def features(text: str | None) -> np.ndarray:
    """The values of ``FEATURES``."""
    text, out = text or "", np.zeros(len(FEATURES))
    if not text:
        return out
    kinds, chars, words, pairs, lines = np.zeros(6, np.int64), Counter(), Counter(), Counter(), Counter()
    total = length = same = marked = short = long_ = capital = 0
    last = None
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and end < at + 2 * PIECE and not text[end].isspace():
            end += 1
        piece, at = text[at:end], end
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kinds()[code]
        kinds += np.bincount(kind, minlength=6)
        chars.update(dict(zip(*(x.tolist() for x in np.unique(code, return_counts=True)))))
        here = piece.split()
        sizes = np.fromiter(map(len, here), np.int64, len(here))
        total += len(here)
        length += int(sizes.sum())
        short += int((sizes <= 3).sum())
        long_ += int((sizes >= 12).sum())
        marked += sum(not (w[-1].isalnum() or w[-1] in ".,;:!?") for w in here)
        capital += sum(w[:1].isupper() for w in here)
        lower = piece.lower().split()
        words.update(lower)
        line = [last, *lower]
        pair = [x for x in zip(line, lower) if x[0] is not None]
        same += sum(a == b for a, b in pair)
        pairs.update(pair)
        last = lower[-1] if lower else last
        lines.update(x for x in piece.split("\n") if x.strip())
    n, letters = kinds.sum(), kinds[0] + kinds[1]
    p = np.fromiter(chars.values(), float) / sum(chars.values())
    n_lines, n_pairs = sum(lines.values()), sum(pairs.values())
    return np.array([
        np.log1p(total), length / max(total, 1), letters / n, kinds[2] / n, kinds[1] / max(letters, 1), kinds[3] / n, kinds[4] / n, kinds[5] / n,
        len(words) / max(total, 1), max(words.values(), default=0) / max(total, 1), same / max(n_pairs, 1), marked / max(total, 1),
        short / max(total, 1), long_ / max(total, 1), n_lines / max(total, 1), 1 - len(lines) / max(n_lines, 1), capital / max(total, 1),
        float(-(p * np.log(p)).sum()), len(pairs) / max(n_pairs, 1)])


@dataclass
class Model:
    """``edges``: bin edges by feature; ``tables``: a score per bin; ``pairs``: (i, j, score per pair of coarse bins)."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    intercept: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for i, j, table in self.pairs:
            total += table[bins[:, i] * PAIR_BINS // BINS, bins[:, j] * PAIR_BINS // BINS]
        return 1 / (1 + np.exp(-total))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int = 4, ridge: float = 1.0) -> np.ndarray:
    """Leaf value of every bin, of the tree that cuts the range greedily where the gain is largest."""
    g, h = np.r_[0, np.cumsum(grad)], np.r_[0, np.cumsum(hess)]
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    cuts = [0, len(grad)]
    while len(cuts) <= leaves:
        best, where = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            m = np.arange(a + 1, b)
            if len(m):
                gain = worth(a, m) + worth(m, b) - worth(a, b)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, where = gain[k], int(m[k])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    value = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        value[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return value


def _cut_both(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts both axes once."""
    def quarters(x):
        c = np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        a, row, col, every = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return np.stack([a, row - a, col - a, every - row - col + a])

    g, h = quarters(grad), quarters(hess)
    gain = (g**2 / (h + ridge)).sum(axis=0)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = g[:, i, j] / (h[:, i, j] + ridge)
    value = np.empty(grad.shape)
    value[: i + 1, : j + 1], value[: i + 1, j + 1:], value[i + 1:, : j + 1], value[i + 1:, j + 1:] = leaf
    return float(gain[i, j]), value


def train(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, rate: float = RATE) -> Model:
    if not len(y):
        return Model([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [], 0.0)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(edges, [np.zeros(BINS) for _ in edges], [], float(np.log(share / (1 - share))))
    bins = model.bins(x)
    total = np.full(len(y), model.intercept)

    def residual():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k in range(len(edges)):
            g, h = residual()
            step = rate * _tree(np.bincount(bins[:, k], g, BINS), np.bincount(bins[:, k], h, BINS))
            model.tables[k] += step
            total += step[bins[:, k]]
    coarse = bins * PAIR_BINS // BINS
    size = PAIR_BINS * PAIR_BINS
    both = lambda i, j, v: np.bincount(coarse[:, i] * PAIR_BINS + coarse[:, j], v, size).reshape(PAIR_BINS, PAIR_BINS)
    g, h = residual()
    gains = sorted(((-_cut_both(both(i, j, g), both(i, j, h))[0], i, j) for i in range(len(edges)) for j in range(i)))
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in gains[:pairs]]
    for _ in range(rounds):
        for i, j, table in model.pairs:
            g, h = residual()
            step = rate * _cut_both(both(i, j, g), both(i, j, h))[1]
            table += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def with_features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, features)``"""
    def run(texts):
        import pyarrow as pa

        return [pa.array([features(t) for t in texts], pa.list_(pa.float64()))]

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    return map_texts(rows, "__text", [T.StructField("features", T.ArrayType(T.DoubleType()))], run, ("__text",))


def learn(rows: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS, **options) -> Model:
    """A model from ``(doc_id, features)`` and the labels of rows that are not held out, at most ``sample_rows`` of them."""
    usable = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("y")).filter(
        F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    count = usable.count()
    luck = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = usable.filter(luck < min(1.0, sample_rows / max(count, 1)))
    joined = rows.join(picked, "doc_id").orderBy(luck, "doc_id", "y", F.xxhash64("features")).limit(sample_rows).select("features", "y").toArrow()
    if not joined.num_rows:
        return train(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = np.array(joined["features"].to_pylist())
    return train(x, (joined["y"].to_numpy() > 0).astype(float), **options)


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", **options) -> DataFrame:
    """Per document: held_out, score, predicted."""
    rows = checkpointed(with_features(docs, text, doc_id))
    model = learn(rows, labels, label, **options)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.predict(x))], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
