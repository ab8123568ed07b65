import re

import pytest
from pyspark.sql import functions as F

from costloom.llm import mixing

from .data import collected, documents, prose, with_clashes

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a\x0bb\x1cc  d"), (None, "x y"), (5, "one two", "en", None), (6, "q", "en", "t"), (6, "q", "en", "t")]


def sized(rows):
    return [(i, t, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), (r + ["en", "s"][len(r):])[1]) for i, t, *r in ((x[0], x[1], *x[2:]) for x in rows)]


def water(sizes, weights, total):
    """Targets by resharing what lies above a limit until none does."""
    target, open_ = {}, set(sizes)
    while open_:
        share = (total - sum(target.values())) / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] > 2 * sizes[s]}
        if not over:
            target |= {s: share * weights[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    return target


def test_targets_equal_repeated_resharing(spark):
    rows = [(k, " ".join(["w"] * n), "en", s) for k, (s, n) in enumerate([("a", 5), ("b", 400), ("c", 70), ("d", 90), ("Z", 33), (None, 12)] * 3)]
    sizes = {}
    for _, _, n, s in ((i, t, len(t.split()), s) for i, t, _, s in rows):
        sizes[s] = sizes.get(s, 0) + n
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = water(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()))
    got = {r.source: r.target for r in mixing.source_targets(documents(spark, rows).select(
        "source", mixing.words(F.col("text")).alias("size"))).collect()}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_takes_meet_their_targets(spark):
    rows = [(k, prose(k, 1 + k % 50), "en", f"s{k % 4 if k % 3 else 0}") for k in range(400)]
    out = mixing.targets(documents(spark, rows)).collect()
    assert len(out) == 400 and all(0 <= r.taken <= 2 * r.size for r in out)
    for size in {r.source_size for r in out}:
        part = [r for r in out if r.source_size == size]
        assert sum(r.taken for r in part) == int(part[0].target + 0.5)


def test_odd_rows(spark):
    out = mixing.targets(documents(spark, ODD))
    assert sorted((r.size for r in out.collect())) == sorted(n for _, _, n, _ in sized(ODD))
    assert collected(out) == collected(mixing.targets(documents(spark, ODD[::-1]).repartition(5)))
    assert mixing.targets(documents(spark, ODD).limit(0)).count() == 0
    assert all(r.taken == 0 for r in mixing.targets(documents(spark, [(1, None), (2, "")])).collect())


@pytest.mark.parametrize("knots", [[1.0, 1.0], [1.5, 0.5], [0.0, 2.0], [2.0, 0.0], [1.0, 0.0, 3.0], [0.2, 0.9, 0.1, 0.4]])
def test_position_inverts_the_integral(spark, knots):
    def integral(x):
        n, area = len(knots) - 1, 0.0
        for i in range(n):
            h = min(max(x * n - i, 0), 1)
            area += (knots[i] * h + (knots[i + 1] - knots[i]) * h * h / 2) / n
        return area

    shares = spark.range(21).select((F.col("id") / 20).alias("f"))
    for r in shares.select("f", mixing.position(F.col("f"), F.array(*map(F.lit, knots))).alias("x")).collect():
        assert integral(r.x) == pytest.approx(r.f * integral(1.0), abs=1e-9)


def test_curriculum_is_sorted_and_whole(spark):
    rows = [(k, prose(k, 5 + k % 9), "en", f"s{k % 3}") for k in range(90)] + ODD
    docs = with_clashes(documents(spark, rows))
    out = mixing.curriculum(docs)
    taken = out.collect()
    assert out.columns[:len(docs.columns)] == docs.columns and out.columns[-3:] == ["mix_pass_", "mix_words", "mix_position"]
    assert [r.mix_position for r in taken] == sorted(r.mix_position for r in taken)
    assert sum(r.mix_words for r in taken) == sum(r.taken for r in mixing.targets(docs).collect())
    for r in taken:
        assert r.mix_words <= len(re.findall(r"[^\x20\x09-\x0D]+", r.text))


def test_early_sources_come_early(spark):
    rows = [(k, "w " * 10, "en", f"s{k % 3}") for k in range(600)]
    mean = {r.source: r.m for r in mixing.curriculum(documents(spark, rows)).groupBy("source").agg(F.avg("mix_position").alias("m")).collect()}
    assert mean["s0"] < mean["s1"] < mean["s2"]
