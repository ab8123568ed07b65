import numpy as np
import pytest

from costloom.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int, row string, cell string"


def vectors(seed=1, dim=64, groups=12, size=15, others=300):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    near = [c + rng.normal(size=dim) * 0.03 * np.linalg.norm(c) / np.sqrt(dim) * rng.uniform(1, 14) for c in centre for _ in range(size)]
    x = np.array([*near, *rng.normal(size=(others, dim))], np.float32)
    return [(k, v.tolist(), k % 3, "r", "c") for k, v in enumerate(x)]


def brute(rows, cosine=0.9):
    good = [k for k, r in enumerate(rows) if r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    linked, label = [set() for _ in rows], list(range(len(rows)))
    for dim in {len(rows[k][1]) for k in good}:
        part = [k for k in good if len(rows[k][1]) == dim]
        x = np.array([rows[k][1] for k in part], np.float32).astype(float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(x @ x.T >= cosine)):
            if a != b:
                linked[part[a]].add(part[b])
    for k in range(len(rows)):
        todo, seen = [k], {k}
        while todo:
            for n in linked[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        label[k] = min(rows[n][0] for n in seen)
    return linked, label


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 8)) * 2
    point = lattice.nearest(x)
    assert len(lattice.neighbours()) == 240 and np.allclose((lattice.neighbours() ** 2).sum(axis=1), 2)
    away = ((x - point) ** 2).sum(axis=1)
    other = ((x[:, None] - point[:, None] - lattice.neighbours()[None]) ** 2).sum(axis=2).min(axis=1)
    assert (away <= other + 1e-9).all() and (away <= 1 + 1e-9).all()
    doubled = 2 * point
    assert np.allclose(doubled, np.rint(doubled)) and (np.rint(point.sum(axis=1)) % 2 == 0).all()


@pytest.mark.parametrize("hot", [lattice.HOT, 8])
def test_links_equal_brute_force(spark, hot):
    rows = vectors()
    out = {r.vec_id: r for r in lattice.deduplicate(spark.createDataFrame(rows, SCHEMA), recall=0.99999, hot=hot).collect()}
    linked, label = brute(rows)
    assert len(out) == len(rows)
    assert [out[k].n_links for k in range(len(rows))] == [len(x) for x in linked]
    assert [out[k].component_id for k in range(len(rows))] == label
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    a, w = rng.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    w -= (w * a).sum(axis=1)[:, None] * a
    w /= np.linalg.norm(w, axis=1)[:, None]
    b = 0.9005 * a + np.sqrt(1 - 0.9005**2) * w
    rows = [(k, v.tolist(), 0, "r", "c") for k, v in enumerate(np.concatenate([a, b]))]
    found = sum(r.n_links > 0 for r in lattice.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect())
    assert 0.93 * 3000 <= found <= 3000


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    odd = [(1, v), (2, v), (2, v), (3, [2 * x for x in v]), (4, None), (5, []), (6, [0.0] * 4), (7, [None, 1.0, 1.0, 1.0]), (8, [float("nan")] * 4),
           (9, [float("inf"), 1.0, 1.0, 1.0]), (10, v[:3]), (11, [x * 1e-44 for x in v]), (12, [-x for x in v]), (None, [9.0, -9.0, 1.0, 0.0]), (13, [1.0]), (14, [5.0])]
    rows = [(i, x, 0, "r", "c") for i, x in odd]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in lattice.deduplicate(spark.createDataFrame(rows, SCHEMA), recall=0.999).collect()), key=repr)
    linked, label = brute([(-1 if r[0] is None else r[0], *r[1:]) for r in rows])
    want = sorted(((i, len(n), None if c == -1 else c) for (i, _), n, c in zip(odd, linked, label)), key=repr)
    assert got == want


def test_empty_table(spark):
    assert lattice.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0
