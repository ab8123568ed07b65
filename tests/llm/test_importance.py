import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from costloom.llm import importance, radix

from .data import collected, documents, prose, with_clashes


def runs(text):
    """Number of words, and the buckets of all runs of one to three words."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(rows, target):
    docs = [(i, *runs(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for x in target for b in runs(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))
    out = []
    for i, n, f in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(fit[:5 * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


ALPHABET = "abcXYZ09 é日 .-\n\t中😂"


@pytest.mark.parametrize("piece", [importance.PIECE, 60, 9])
def test_features_equal_plain_hashing(piece, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", piece)
    r = random.Random(piece)
    some = lambda n: "".join(r.choice(ALPHABET) for _ in range(n))
    for _ in range(60):
        texts = [r.choice([None, "", some(r.randint(0, 40)), some(r.randint(0, 400)), f"{'x' * r.randint(60, 300)} {some(20)}{'y' * r.randint(60, 70)} a b"])
                 for _ in range(r.randint(0, 9))]
        words, found = [0] * len(texts), [[] for _ in texts]
        for k, _, owner, buckets, of in importance._batch(pa.array(texts, pa.string())):
            for o in owner:
                words[k + o] += 1
            for b, o in zip(buckets.tolist(), of):
                found[k + o].append(b)
        assert [(n, sorted(f)) for n, f in zip(words, found)] == [(n, sorted(f)) for n, f in map(runs, texts)]


def test_equals_brute_force(spark):
    rows = [(k, prose(k % 211, 5 + k * 7 % 60)) for k in range(700)] + [(None, prose(5, 40)), (None, ""), (3, None), (800, "A. b-C"), (801, prose(1, 9000))]
    target = [prose(k, 30) for k in range(0, 20)] + [None, ""]
    docs = with_clashes(documents(spark, rows)).repartition(6)
    out = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in out.dtypes} == {"bigint"}
    assert collected(out) == brute(rows, target)


def test_a_given_table(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in bench.collect()])
    assert collected(importance.resample(docs, bench)) == want and sum(r[4] is not None for r in want) > 20


def test_ties_and_repeated_rows(spark):
    text = prose(1, 40)
    rows = [(7, text)] * 50 + [(6, text)] * 50
    target = spark.createDataFrame([("x",)], "text string")
    got = importance.resample(documents(spark, rows), target).filter("rank is not null").orderBy("rank").collect()
    want = brute(rows, ["x"])
    assert [(r.doc_id, r.rank) for r in got] == sorted(((r[0], r[4]) for r in want if r[4]), key=lambda x: x[1])


def test_empty_tables(spark):
    docs, target = documents(spark, [(1, prose(1))]), spark.createDataFrame([], "text string")
    assert collected(importance.resample(docs, target)) == brute([(1, prose(1))], [])
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.draw(docs.limit(0), target).count() == 0


def test_drawn_documents_are_whole(spark):
    rows = [(k // 2, prose(k // 3, 25)) for k in range(400)]
    docs, target = with_clashes(documents(spark, rows)), spark.createDataFrame([(prose(3),)], "text string")
    out = importance.draw(docs, target).collect()
    ranks = importance.resample(docs, target).filter("rank is not null").collect()
    assert sorted((r.doc_id, r.draw_rank, r.draw_weight) for r in out) == sorted((r.doc_id, r.rank, r.weight) for r in ranks)
    assert {(r.doc_id, r.text) for r in out} <= set(rows) and "mix_pass" in out[0]


def test_a_long_text(spark):
    text = prose(4, 2000) + " " + "ab" * 3_000_000 + " " + prose(5, 400_000)
    got = importance.resample(documents(spark, [(1, text)]), spark.createDataFrame([(prose(4),)], "text string")).first()
    assert (got.n_features, got.weight) == brute([(1, text)], [prose(4)])[0][1:3]


@pytest.mark.parametrize("block,bits", [(4, 16), (1 << 16, 13)])
def test_ranks_by_composite_keys(spark, block, bits):
    r = random.Random(block)
    edge = [-(1 << 63), (1 << 63) - 1, 0, -1, None]
    rows = [(r.choice([*edge, r.randint(-50, 50)]), r.choice([None, r.randint(0, 9)]), k) for k in range(300)]
    rows += [(5, 5, k) for k in range(300, 600)]
    df = spark.createDataFrame(rows, "a long, b long, rank long")
    out = radix.ranked(df.repartition(5), ["a", "b"], ("b",), block=block, bits=bits).collect()
    out.sort(key=lambda x: x.rank_)
    assert [x.rank_ for x in out] == list(range(1, 601)) and sorted(x["rank"] for x in out) == list(range(600))
    key = lambda x: (x.a is None, x.a or 0, x.b is None, -(x.b or 0))
    assert [key(x) for x in out] == sorted(map(key, out))


def test_ranks_are_stable_and_blocks_bounded(spark):
    df = spark.range(0, 5000, 1, 3).selectExpr("id", "id % 2 a")
    out = sorted(radix.ranked(df, ["a"], block=256).collect(), key=lambda x: x["rank"])
    assert [x.id for x in out] == [*range(0, 5000, 2), *range(1, 5000, 2)]
    assert [x["rank"] for x in radix.ranked(df.limit(3).selectExpr("cast(null as long) a"), ["a"]).collect()] == [1, 2, 3]
