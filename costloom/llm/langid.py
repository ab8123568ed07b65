"""Language ID: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

A text is the mean of the embeddings of its subwords: letters, and letter runs of two to four within a word
whose ends are marked. Training is plain stochastic gradient descent in numpy on a bounded sample of labelled
rows (``sample_rows`` in all, in equal shares for every language, picked by a hash of the id). Embeddings times
softmax weights give one score per bucket and language, so a prediction is a mean over a small table. A fifth of
the sample fits the temperature of the softmax and the rejection threshold: at most ``alpha`` of texts like the
labelled ones score under it, and it is never above the middle between chance and one half.

Null texts and texts without a letter are ``und`` with score 0 and are rejected; so is everything if no language
could be learned. Empty texts have no letter. Very long texts are read whole, a million characters at a time.
Ties go to the language that sorts first. Null ids never take part in the learning and are not held out.
Repeated rows get equal predictions, other columns are carried along, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import fresh, map_texts

UNDETERMINED = "und"
BITS = 15
SAMPLE_ROWS = 2000
ALPHA = 0.0005
CHUNK = 1 << 20
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once in each process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def subwords(text: str, bits: int = BITS):
    """Bucket numbers of all subwords of a text, one array per chunk."""
    letter = _letters()
    shift, at = np.uint64(64 - bits), 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and end < at + 2 * CHUNK and text[end].isalpha():
            end += 1
        code = np.frombuffer(text[at:end].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        at = end
        inside = letter[code]
        if not inside.any():
            continue
        code = np.where(inside, code, 32)
        keep = np.ones(len(code), bool)
        keep[1:] = inside[1:] | inside[:-1]
        code = np.concatenate([[32], code[keep], [32]]).astype(np.uint64)
        inside = code != 32
        found = [code[inside] * np.uint64(0x9E3779B97F4A7C15)]
        run, clear = code, np.ones(len(code), bool)
        for n in range(2, 5):
            run = run[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
            clear = clear[:-1] & inside[n - 2:-1] if n > 2 else (inside[:-1] | inside[1:])
            found.append((run[clear] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15))
        yield (np.concatenate(found) >> shift).astype(np.int64)


@dataclass
class Model:
    """``table``: score per bucket and language."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    bits: int = BITS

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        total, n = np.zeros(len(self.languages)), 0
        for found in subwords(text or "", self.bits):
            for k in range(len(self.languages)):
                total[k] += self.table[k, found].sum(dtype=np.float64)
            n += len(found)
        if not n or not self.languages:
            return UNDETERMINED, 0.0, True
        logits = (total / n + self.bias) / self.temperature
        logits = np.exp(logits - logits.max())
        best = int(logits.argmax())
        score = float(logits[best] / logits.sum())
        return self.languages[best], score, score < self.threshold


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], bits: int = BITS, dim: int = 8, epochs: int = 10,
          rate: float = 8.0, batch: int = 8, alpha: float = ALPHA, seed: int = 7) -> Model:
    """``rows``: language, bucket numbers and their counts of each text."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((0, 1 << bits), np.float32), np.zeros(0), 1.0, 0.0, bits)
    rng = np.random.default_rng(seed)
    number = {x: k for k, x in enumerate(languages)}
    labels = np.array([number[r[0]] for r in rows])
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5]
    fit = order[len(rows) // 5:]
    emb = rng.normal(0, 1 / dim, (1 << bits, dim))
    weight, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    seen = np.zeros(1 << bits, bool)

    def forward(picked):
        ids = np.concatenate([rows[i][1] for i in picked])
        share = np.concatenate([rows[i][2] / rows[i][2].sum(dtype=np.float64) for i in picked])
        starts = np.cumsum([0, *(len(rows[i][1]) for i in picked[:-1])])
        mean = np.add.reduceat(emb[ids] * share[:, None], starts)
        logits = mean @ weight + bias
        return ids, share, starts, mean, logits

    def softmax(x):
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    steps, done = epochs * max(1, -(-len(fit) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for k in range(0, len(fit), batch):
            picked = fit[k:k + batch]
            ids, share, starts, mean, logits = forward(picked)
            seen[ids] = True
            err = softmax(logits)
            err[np.arange(len(picked)), labels[picked]] -= 1
            err /= len(picked)
            pace = rate * (1 - done / steps)
            back = np.repeat(err @ weight.T, np.diff([*starts, len(ids)]), axis=0) * share[:, None]
            weight -= pace * mean.T @ err
            bias -= 0.01 * pace * err.sum(axis=0)
            np.subtract.at(emb, ids, pace * back)
            done += 1
    emb[~seen] = 0
    logits = np.concatenate([forward(held[k:k + 64])[4] for k in range(0, len(held), 64)]) if len(held) else np.zeros((0, len(languages)))
    temperature, threshold = 1.0, 0.0
    if len(held):
        loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(held)), labels[held]], 1e-12)).mean()
        temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
        best = np.sort(softmax(logits / temperature).max(axis=1))
        rank = int(alpha * (len(best) + 1))
        threshold = min(float(best[max(0, rank - 1)]), (1 / len(languages) + 0.5) / 2)
    return Model(languages, np.ascontiguousarray((emb @ weight).T.astype(np.float32)), bias, temperature, threshold, bits)


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS, **options) -> Model:
    """A model from the rows with a language that are not held out.

    Counting the languages gives each one's sampling rate; the sampled rows reach the driver as bucket counts,
    at most ``sample_rows`` of them with at most 2^BITS entries each.
    """
    bits = options.get("bits", BITS)
    usable = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("id")).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return train([], **options)
    each = sample_rows / len(sizes)
    rate = F.create_map(*(F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, each / n))))
    luck = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = usable.filter(luck < F.element_at(rate, F.col("lang"))).withColumn("luck", luck)

    def counts(texts):
        import pyarrow as pa

        ids, numbers = [], []
        for t in texts:
            total = np.zeros(1 << bits, np.int64)
            for found in subwords(t or "", bits):
                total += np.bincount(found, minlength=1 << bits)
            ids.append(np.flatnonzero(total).astype(np.int32))
            numbers.append(total[ids[-1]].astype(np.int32))
        return [pa.array(ids, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))]

    numbers = T.ArrayType(T.IntegerType())
    sample = map_texts(picked, "text", [T.StructField("ids", numbers), T.StructField("counts", numbers)], counts, drop=["text"])
    sample = sample.filter(F.size("ids") > 0).orderBy("luck", "id", F.xxhash64("ids")).limit(sample_rows).select("lang", "ids", "counts").toArrow()
    rows = [(lang, np.asarray(i.values), np.asarray(c.values))  # as they arrived, without a copy
            for lang, i, c in zip(sample["lang"].to_pylist(), sample["ids"], sample["counts"])]
    return train(rows, **options)


def predict(docs: DataFrame, model: Model, text: str = "text", drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """``docs`` with the predicted language, its score and whether it is rejected; and those columns' names."""
    names = [fresh(c, docs.columns) for c in ("lang_pred", "score", "rejected")]

    def run(texts):
        import pyarrow as pa

        made = [model.predict(t) for t in texts]
        return [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]

    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    return map_texts(docs, text, [T.StructField(n, k) for n, k in zip(names, kinds)], run, drop), names


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: held_out, lang_pred, score, rejected."""
    model = learn(docs, text, lang, doc_id, **options)
    found, (best, score, rejected) = predict(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")), model, "__text", ("__text",))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(best).alias("lang_pred"),
                        F.col(score).alias("score"), F.col(rejected).alias("rejected"))


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that the model rejects."""
    found, (_, _, rejected) = predict(docs, learn(docs, text, lang, doc_id, **options), text)
    return found.filter(~F.col(rejected)).select(*(F.col(f"`{c}`") for c in docs.columns))
