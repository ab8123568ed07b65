import re

import numpy as np
import pytest
import xxhash

from costloom.llm import simhash
from costloom.llm.components import components

from .data import collected, documents, prose, with_clashes


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_groups(prints):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def corpus():
    base = [prose(k, 120) for k in range(12)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, t + " extra") for k, t in enumerate(base[:6])] + [(200 + k, base[0]) for k in range(30)]
    rows += [(300 + k, base[1].replace(" ", "\n", k) + " tail" * (k % 3)) for k in range(12)]
    rows += [(400, None), (401, ""), (402, " \t"), (403, "one two"), (404, "ONE two"), (405, "one two three four"), (None, base[2]), (5, base[5]), (5, base[5]),
             (406, "É Ä ß 𝒳 é")]
    return rows


@pytest.mark.parametrize("text", [None, "", " ", "a", "A b", "a b c", "a b c d", "a b c d e", "É\x1cB\x0bc d e f g", prose(1, 500)])
def test_fingerprint_equals_the_plain_definition(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = prose(4, 1000)
    monkeypatch.setattr(simhash, "_LONG", 10)
    for piece in (1, 2, 3, 7, 999, 1000):
        monkeypatch.setattr(simhash, "_PIECE", piece)
        assert simhash.fingerprint(text) == brute_print(text)
        assert simhash.fingerprint("a b") == brute_print("a b")


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False))) for s in seeds for _ in range(12)]
    points = np.unique(np.array([*seeds, *near, *rng.integers(0, 2**63, 300, dtype=np.uint64)], np.uint64))
    got, want = simhash.links(points), brute_groups([int(p) for p in points])
    assert len(set(zip(got.tolist(), want))) == len(set(got.tolist())) == len(set(want))


def test_tables_cover_every_pair():
    rng = np.random.default_rng(5)
    for count in (100, 10**9, 10**11):
        masks = [m & (1 << 64) - 1 for m in simhash.block_masks(count)]
        for _ in range(300):
            diff = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not diff & m for m in masks)


def template_points():
    """Fingerprints with 40 bits in common, some of them within the radius."""
    rng = np.random.default_rng(8)
    free = rng.permutation(64)[:24]
    spread = lambda x: sum(1 << int(b) for k, b in enumerate(free) if x >> k & 1)
    base = 0x5A5A5A5A5A5A5A5A & ~sum(1 << int(b) for b in free)
    points = {base | spread(int(x)) for x in rng.integers(0, 1 << 24, 400)}
    points |= {p ^ sum(1 << int(b) for b in rng.choice(free, rng.integers(1, 6), replace=False)) for p in sorted(points)[:100]}
    return sorted(points)


def test_finer_masks_cover_every_pair():
    rng = np.random.default_rng(6)
    for mask in simhash.block_masks(100):
        for m in (mask, *simhash.finer_masks(mask)):
            left = [b for b in range(64) if not m >> b & 1]
            finer = [f & (1 << 64) - 1 for f in simhash.finer_masks(m)]
            assert all(m & (1 << 64) - 1 & ~f == 0 for f in finer)
            for _ in range(100):
                diff = sum(1 << int(b) for b in rng.choice(left, 4, replace=False))
                assert any(not diff & f for f in finer)


def test_large_shards_are_cut_and_lose_no_link(spark):
    points = template_points()
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    distinct = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    sizes = simhash.dealt_shards(distinct, simhash.block_masks(len(points)), largest=40).groupBy("table", "key").count()
    assert max(r["count"] for r in sizes.collect()) <= 40
    found = dict(collected(components(simhash.shard_edges(distinct, len(points), largest=40))))
    got, want = [found.get(p, p) for p in signed], brute_groups(points)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) < len(points)


def test_components_equal_brute_force(spark):
    rows = corpus()
    out = simhash.deduplicate(documents(spark, rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    label = brute_groups(prints)
    least = {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted(((i, format(p, "016x"), least[g]) for (i, _), p, g in zip(rows, prints, label)), key=repr)
    assert sorted(map(tuple, out), key=repr) == want


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = with_clashes(documents(spark, rows))
    out = simhash.keep_one(docs)
    label = brute_groups([brute_print(t) for _, t in rows])
    least = {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(least.values())


def test_empty_table(spark):
    empty = documents(spark, corpus()).limit(0)
    assert simhash.deduplicate(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (5000, 5001), (5001, 5000), (None, 3)]
    got = dict(collected(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{k: 0 for k in range(41)}, **{k: 1000 for k in range(1000, 1100)}, 5000: 5000, 5001: 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
