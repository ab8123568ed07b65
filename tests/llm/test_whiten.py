import math
import random
from decimal import Decimal

import numpy as np
import pytest

from costloom.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, dims, seed=1):
    r = np.random.default_rng(seed)
    mixing = r.normal(size=(dims, dims)) / dims
    return (r.normal(size=(n, dims)) @ mixing).astype(np.float32).tolist()


def frame(spark, given):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(given)], SCHEMA)


def integers(given):
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in given]


def exact(x):
    """n, sums and centred products (over n * n the covariance), by plain whole numbers."""
    n, dims = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(dims)]
    return n, sums, [[n * sum(row[a] * row[b] for row in x) - sums[a] * sums[b] for b in range(dims)] for a in range(dims)]


def check(out, given, ids, components):
    x = integers(given)
    n, sums, centred = exact(x)
    cov = np.array([[v / n**2 for v in row] for row in centred])
    values = np.linalg.eigvalsh(cov)[::-1]
    rows = {(r.vec_id, r.component): r for r in out}
    assert len(rows) == len(out) == len(ids) * components
    table = np.array([[rows[i, c + 1].whitened for c in range(components)] for i in ids])
    for i, row in zip(ids, x):
        assert {rows[i, c + 1].deviation for c in range(components)} == {sum((n * v - s) ** 2 for v, s in zip(row, sums))}
    for c in range(components):
        r = rows[ids[0], c + 1]
        assert r.n == n and r.explained == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    measured = np.abs(np.cov(table.T, bias=True) - np.eye(components)).max()
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-9 and measured < 1e-9
    # Up to its sign each component is an eigenvector: x - mean is projected on it.
    mean = np.array([s / n for s in sums])
    full = (np.array(x, float) - mean) @ np.linalg.eigh(cov)[1][:, ::-1] / np.sqrt(np.maximum(values, 1e-300))
    for c in range(components):
        assert min(np.abs(full[:, c] - table[:, c]).max(), np.abs(full[:, c] + table[:, c]).max()) < 1e-6


def test_equals_plain_whole_numbers(spark):
    given = vectors(300, 12)
    check(whiten.whiten(frame(spark, given).repartition(5)).collect(), given, list(range(300)), 12)


def test_no_more_components_than_asked_for(spark):
    given = vectors(120, 40, 5)
    check(whiten.whiten(frame(spark, given)).collect(), given, list(range(120)), 32)


@pytest.mark.parametrize("spread", [1, 50, 3_000_000, 1 << 40, 1 << 61])
def test_scatter_is_exact(spread):
    r = random.Random(spread)
    x = [[r.randint(-spread, spread) for _ in range(5)] + [7] for _ in range(333)]
    total = whiten.Scatter(6)
    for at in (0, 64, 65, 200):
        ends = {0: 64, 64: 65, 65: 200, 200: 333}
        total.add(np.array(x[at:ends[at]], np.int64))
    assert total.n == 333 and total.sums.tolist() == [sum(row[d] for row in x) for d in range(6)]
    assert total.products.tolist() == [[sum(row[a] * row[b] for row in x) for b in range(6)] for a in range(6)]
    assert all(-(1 << 63) <= low < 1 << 63 for _, _, _, low in total.rows())


def test_odd_vectors(spark):
    given = vectors(50, 4, 3)
    odd = [None, [], [None, 1.0, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [1.0] * 9]
    out = whiten.whiten(frame(spark, [*odd, *given, given[0], given[0]])).collect()
    assert len({r.vec_id for r in out}) == 52
    check(out, [*given, given[0], given[0]], list(range(len(odd), len(odd) + 52)), 4)


def test_null_ids_and_empty_tables(spark):
    given = vectors(10, 3, 4)
    out = whiten.whiten(spark.createDataFrame([(None, v, None) for v in given], SCHEMA)).collect()
    assert len(out) == 30 and {r.vec_id for r in out} == {None}
    for none in ([], [None, None], [[], [float("nan")]]):
        assert whiten.whiten(frame(spark, none)).count() == 0
    assert whiten.whiten(frame(spark, none)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_components_without_variance(spark):
    given = [[v[0], 0.25, v[0], 2 * v[0] + 1] for v in vectors(20, 4, 6)]
    x = [[round(v[0] * 64) / 64, 0.25, round(v[0] * 64) / 64, 1.0] for v in given]
    out = whiten.whiten(frame(spark, x)).collect()
    assert len(out) == 80 and all((r.whitened is None) == (r.component > 1) == (r.explained == 0) for r in out)
    one = whiten.whiten(frame(spark, [[1.0, 2.0]])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, 0.0)] * 2


def test_large_entries_and_long_deviations(spark):
    given = [[3e30, 1.0], [0.0, 2.0], [-3e30, 0.5], [5.0, 0.25]]
    df = frame(spark, given)
    out = whiten.transform(df, whiten.fit(df)).collect()
    assert all(isinstance(r.deviation, Decimal) or r.deviation is None for r in out)
    assert all(r.deviation is None for r in whiten.whiten(df).collect() if r.vec_id in (0, 2))
    wide = [[1e9 * k, -1e9 * k * k % 7e8] for k in range(30)]
    df = frame(spark, wide)
    wide = [r.embedding for r in df.collect()]
    n, sums, _ = exact(integers(wide))
    got = {r.vec_id: r.deviation for r in whiten.transform(df, whiten.fit(df)).collect()}
    assert got == {i: Decimal(sum((n * v - s) ** 2 for v, s in zip(row, sums))) for i, row in enumerate(integers(wide))}


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(v, "w", 1) for v in vectors(9, 3)], "embedding array<float>, whitened string, deviation int")
    out = whiten.transform(df, whiten.fit(df))
    assert out.columns == ["embedding", "whitened", "deviation", "whitened_", "deviation_"]
    assert {(r.whitened, r.deviation, len(r.whitened_)) for r in out.collect()} == {("w", 1, 3)}
