"""Importance resampling towards a target distribution, over hashed word runs.

A document's features are all runs of one to three words; a feature's bucket is its CRC-32 modulo ``BUCKETS``. Counts of the
corpus and of the target give each bucket a gain, the logarithm of the target's share over the corpus's share; the gains of a
document's features, summed up by array lookups, are its weight. Weight plus a Gumbel number drawn from a hash of the document's
id is its score, and the highest scores are a sample without replacement in proportion to the weights' exponentials.
Ranks come from a distributed radix sort (``radix``).

Words are found, hashed and counted in arrays over the bytes of many texts together: CRC-32 is linear, so a run's value comes from
its words' values, each shifted by the bytes behind it. Each task sums its counts and sends one row per bucket.

Null texts have no words; a text without words has weight 0. Very long texts are read whole, in pieces of ``PIECE`` bytes,
with the last two words carried over. A null id is hashed as the empty text and comes last among equals. Ties go to the smaller
id; rows that are equal in both are each a document and come in the order in which they were read. Empty tables give empty results: an empty target counts as no features.
Other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from .common import checkpointed, fresh, row_hash
from .radix import ranked

BUCKETS = 10_000
SEED = 42
MIN_WORDS = 20
DRAWN_PERCENT = 5
PIECE = 1 << 21
LONGEST = 64  # bytes of a word hashed with the others; longer ones are hashed by themselves
_POLYNOMIAL = 0xEDB88320
_TABLES: list = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folding of bytes (lower case; 0 between words), CRC of each byte, its shift by 0 to LONGEST + 1 bytes, and the CRC of a
    space shifted alike."""
    if not _TABLES:
        fold = np.zeros(256, np.uint8)
        for low, high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
            fold[low:high] = np.arange(low, high)
        fold[0x41:0x5B] = np.arange(0x61, 0x7B)
        crc = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(_POLYNOMIAL), crc >> 1)
        shift = np.empty((LONGEST + 2, 4, 256), np.uint32)
        shift[0] = np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]
        for n in range(1, LONGEST + 2):
            shift[n] = crc[shift[n - 1] & 255] ^ (shift[n - 1] >> 8)
        space = np.uint32(zlib.crc32(b" "))
        spaces = shift[:, 0, space & 255] ^ shift[:, 1, space >> 8 & 255] ^ shift[:, 2, space >> 16 & 255] ^ shift[:, 3, space >> 24]
        _TABLES.extend((fold, crc, shift, spaces))
    return tuple(_TABLES)


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs followed by n bytes, still to be combined with those bytes' own CRC."""
    _, _, shift, _ = _tables()
    flat, at = shift.reshape(-1), n.astype(np.int64) * 1024
    return flat[at + (crc & 255)] ^ flat[at + 256 + (crc >> 8 & 255)] ^ flat[at + 512 + (crc >> 16 & 255)] ^ flat[at + 768 + (crc >> 24)]


def _word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    _, table, _, _ = _tables()
    order = np.argsort(-np.minimum(sizes, LONGEST + 1), kind="stable")
    by_size, at = sizes[order], starts[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long_ = int(np.searchsorted(-by_size, -LONGEST, "left"))
    for k in range(int(by_size[long_]) if long_ < len(by_size) else 0):
        n = int(np.searchsorted(-by_size, -k, "left"))  # words of more than k bytes
        part = state[long_:n]
        state[long_:n] = table[(part ^ data[at[long_:n] + k]) & 255] ^ (part >> 8)
    state = ~state
    for k in range(long_):
        state[k] = zlib.crc32(data[at[k]:at[k] + by_size[k]].tobytes())
    out = np.empty(len(order), np.uint32)
    out[order] = state
    return out


def features(data: np.ndarray, docs: np.ndarray, carried: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Features of a piece of text.

    ``data``: bytes of texts one behind the other, ``docs``: ends of the texts in it. ``carried``: the last two words before the
    first text, which goes on. Returns the documents of the words, the features' CRCs, the features' documents, and the last
    text's last two words.
    """
    fold, _, _, spaces = _tables()
    folded = np.concatenate([*(np.frombuffer(w + b" ", np.uint8) for w in carried), data]) if carried else data
    lead = len(folded) - len(data)
    folded, docs = fold[folded], docs + lead
    word = folded != 0
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inner = docs[:-1][(docs[:-1] > 0) & (docs[:-1] < len(folded))]
    cut = np.unique(inner[word[inner] & word[inner - 1]])  # a text ends where the next one starts with a word
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    sizes, owner = ends - starts, np.searchsorted(docs, starts, "right")
    crc = _word_crcs(folded, starts, sizes)
    held, n = len(carried), len(crc)
    tail = [folded[a:b].tobytes() for a, b in zip(starts[-2:], ends[-2:])]
    if n:
        tail = tail[-int((owner[-2:] == len(docs) - 1).sum()):] if owner[-1] == len(docs) - 1 else []
    short = np.minimum(sizes, LONGEST)
    own = crc ^ spaces[short]
    two, three = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    if n > 1:
        two[1:] = _shifted(crc[:-1], short[1:] + 1) ^ own[1:]
    if n > 2:
        three[2:] = _shifted(two[1:-1], short[2:] + 1) ^ own[2:]
    for k in np.flatnonzero(sizes > LONGEST).tolist():  # runs that a long word ends in or goes through
        text = [folded[starts[i]:ends[i]].tobytes() for i in range(max(k - 2, 0), min(k + 2, n))]
        low = max(k - 2, 0)
        for i in range(k, min(k + 2, n)):
            if i >= 1:
                two[i] = zlib.crc32(b" ".join(text[i - 1 - low:i + 1 - low]))
            if i >= 2:
                three[i] = zlib.crc32(b" ".join(text[i - 2 - low:i + 1 - low]))
        if k + 2 < n:
            three[k + 2] = zlib.crc32(b" ".join([*text[k - low:], folded[starts[k + 2]:ends[k + 2]].tobytes()]))
    same1, same2 = np.zeros(n, bool), np.zeros(n, bool)
    same1[1:] = owner[1:] == owner[:-1]
    same2[2:] = owner[2:] == owner[:-2]
    new = np.arange(n) >= held
    one, same1, same2 = new, same1 & new, same2 & new
    return owner[new], np.concatenate([crc[one], two[same1], three[same2]]), np.concatenate([owner[one], owner[same1], owner[same2]]), tail


def _text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column, and their ends; nulls are empty."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends[1:] - ends[0]


def _pieces(data: np.ndarray, ends: np.ndarray):
    """(first text, bytes, ends, whether the last text goes on) of groups of texts of about PIECE bytes; a longer text is cut
    between words."""
    k, begin = 0, 0
    fold = _tables()[0]
    while k < len(ends):
        last = max(int(np.searchsorted(ends, begin + PIECE, "right")), k + 1)
        if last == k + 1 and ends[k] - begin > PIECE:
            end, cut = int(ends[k]), begin + PIECE
            while cut < end:
                gap = np.flatnonzero(fold[data[cut:min(cut + PIECE, end)]] == 0)
                if len(gap):
                    cut += int(gap[0])
                    break
                cut = min(cut + PIECE, end)
            if cut < end:
                yield k, data[begin:cut], np.array([cut - begin]), True
                begin = cut
                continue
        yield k, data[begin:ends[last - 1]], ends[k:last] - begin, False
        k, begin = last, int(ends[last - 1])


def _batch(column):
    """(first text, number of texts, words' texts, features' buckets, features' texts) of the pieces of an Arrow column."""
    data, ends = _text_bytes(column)
    carried: list[bytes] = []
    for k, piece, piece_ends, goes_on in _pieces(data, ends):
        owner, crc, of, carried = features(piece, piece_ends, carried)
        carried = carried if goes_on else []
        yield k, len(piece_ends), owner, (crc % np.uint32(BUCKETS)).astype(np.int64), of


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(bucket, n)``: features per bucket over all texts; buckets without features are missing."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, buckets, _ in _batch(batch.column(0)):
                total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text") -> np.ndarray:
    """The gain of every bucket, in thousandths. Only the buckets' counts, a fixed number, come to the driver."""
    counts = np.zeros((2, BUCKETS), np.int64)
    both = bucket_counts(corpus, text).withColumn("side", F.lit(0)).unionByName(bucket_counts(target, target_text).withColumn("side", F.lit(1)))
    for r in both.collect():
        counts[r.side, r.bucket] = r.n
    (s_all, t_all), out = counts.sum(axis=1).tolist(), np.empty(BUCKETS, np.int64)
    for k, (s, t) in enumerate(counts.T.tolist()):
        out[k] = math.floor(1000 * math.log(float(t + 1) * float(s_all + BUCKETS) / (float(s + 1) * float(t_all + BUCKETS))))
    return out


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, n_features and weight."""
    kept = [c for c in docs.columns if c != text]
    names = [fresh(c, kept) for c in ("n_words", "n_features", "weight")]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = np.zeros((3, batch.num_rows), np.int64)
            for k, n, owner, buckets, of in _batch(batch.column(text)):
                order = np.argsort(of, kind="stable")
                sums, of = np.r_[0, np.cumsum(gain[buckets[order]])], np.bincount(of, minlength=n)
                ends = np.cumsum(of)
                made[0, k:k + n] += np.bincount(owner, minlength=n)
                made[1, k:k + n] += of
                made[2, k:k + n] += sums[ends] - sums[ends - of]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, made)], names=[*kept, *names])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(c, T.LongType(), False) for c in names)]))


def _scored(narrow: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """``(doc_id, text, ...)`` to the same rows with n_words, n_features, weight and score in place of the text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return weighted(narrow, gain).withColumn("score", F.col("weight") + gumbel)


def _ranks(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """The rows of at least ``min_words`` words get ranks; of these ranks the first ``percent`` hundredths stay."""
    scored = checkpointed(scored)
    fit = F.col("n_words") >= min_words
    all_ranked = ranked(scored.filter(fit), ["score", "doc_id"], ("score",))
    drawn = percent * scored.filter(fit).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return all_ranked.withColumn("rank", rank).unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
             percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank (null where not drawn). Ids are integers."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = _scored(narrow, gains(docs, target, text, target_text), seed)
    return _ranks(scored, percent, min_words).select("doc_id", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
         percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents themselves, whole, with ``draw_rank`` and ``draw_weight``.

    Drawn rows are told apart by id and content. Only documents that are drawn are shuffled with their texts; of
    equal rows, drawn in part, the first ranks go to any of them.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), row_hash(docs).alias("row"))
    scored = _scored(narrow, gains(docs, target, text, target_text), seed)
    taken = _ranks(scored, percent, min_words).filter("rank is not null")
    key = ["doc_id", "row"]
    numbered = taken.select(*(F.col(c).alias(f"__{c}") for c in key), F.col("rank").alias("__rank"), F.col("weight").alias("__weight"),
                            F.row_number().over(W.partitionBy(*key).orderBy("rank")).alias("__nth"))
    whole = docs.select(F.col(doc_id).cast("long").alias("__doc_id"), row_hash(docs).alias("__row"), F.struct("*").alias("__doc"))
    same = lambda a, b: F.col(f"{a}.__doc_id").eqNullSafe(F.col(f"{b}.__doc_id")) & (F.col(f"{a}.__row") == F.col(f"{b}.__row"))
    some = whole.alias("d").join(numbered.alias("t"), same("d", "t"), "left_semi").withColumn(
        "__nth", F.row_number().over(W.partitionBy("__doc_id", "__row").orderBy(F.lit(0))))
    names = {c: fresh(f"draw_{c}", docs.columns) for c in ("rank", "weight")}
    return some.alias("d").join(numbered.alias("t"), same("d", "t") & (F.col("d.__nth") == F.col("t.__nth"))).select(
        "d.__doc.*", *(F.col(f"t.__{c}").alias(n) for c, n in names.items()))
