import random

from costloom.llm import decontaminate as dc

from .data import collected, documents, prose, with_clashes, words


def edit(a, b):
    """Least edit distance of ``a`` to any stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def items(spark, extra=()):
    rows = [(k, " ".join(words(900 + k, 14 + 3 * k))) for k in range(8)] + list(extra)
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def changed(text, n, seed):
    r, w = random.Random(seed), text.split()
    for k in r.sample(range(len(w)), n):
        w[k] = r.choice(["", "zzz", w[k] + " yyy"])
    return " ".join(w)


def corpus(rows):
    docs = [(k, prose(k, 200)) for k in range(20)]
    docs += [(100 + i, f"{prose(i, 50)} {t.upper()}! {prose(i + 1, 60)}") for i, t in rows if t]
    docs += [(200 + i, f"{prose(i, 30)} {changed(t, max(1, len(t.split()) // 10), i)} {prose(i, 9)}") for i, t in rows if t]
    return docs + [(300, None), (301, ""), (302, "..."), (None, rows[0][1]), (303, rows[1][1]), (303, rows[1][1])]


def brute(docs, rows, rate=dc.MAX_EDITS):
    out = []
    for d, text in docs:
        for i, t in dict.fromkeys(rows):
            w = dc.WORDS.findall((t or "").lower())
            if text is not None and w:
                e = edit(w, dc.WORDS.findall(text.lower()))
                if e <= int(rate * len(w)):
                    out.append((d, i, e))
    return sorted(out, key=repr)


def test_infix_distance_equals_the_table():
    r = random.Random(1)
    for _ in range(500):
        a = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        b = "".join(r.choice("abc") for _ in range(r.randint(0, 14)))
        assert dc.infix_distance(a, b, len(a))[0] == edit(a, b)


def test_found_items_equal_brute_force(spark):
    bench, rows = items(spark, [(50, None), (51, ""), (52, "too few words"), (3, " ".join(words(903, 23)))])
    docs = corpus(rows[:8])
    got = collected(dc.contaminated(documents(spark, docs), bench), "doc_id", "item_id", "edits")
    assert got == brute(docs, rows)


def test_blocks_of_items_give_the_same_rows(spark):
    bench, rows = items(spark)
    docs = documents(spark, corpus(rows))
    assert collected(dc.contaminated(docs, bench, block_bytes=300)) == collected(dc.contaminated(docs, bench))


def test_recall_at_the_edit_rate():
    rows = [(k, " ".join(words(k, 40))) for k in range(300)]
    index = dc.Index.build(rows)
    found = index.find([f"{prose(k, 80)} {changed(t, 4, k)} {prose(k + 1, 80)}" for k, t in rows])
    assert sum(k in [h[0] for h in hits] for k, hits in enumerate(found)) >= 297


def test_every_item_is_found_at_the_full_limit():
    r = random.Random(4)
    rows = [(n * 100 + k, " ".join(words(n * 100 + k, n))) for n in (*range(5, 31), 45, 60) for k in range(40)]
    index = dc.Index.build(rows)
    docs = []
    for i, t in rows:
        w = t.split()
        for k in r.sample(range(len(w)), len(w) // 5):
            w[k] = r.choice(["", "zzz", f"{w[k]} yyy", f"yyy {w[k]}"])
        docs.append(f"{prose(i + 1, 40)} {' '.join(w)} {prose(i + 2, 40)}")
    for (i, t), text, hits in zip(rows, docs, index.find(docs)):
        want = edit(dc.WORDS.findall(t), dc.WORDS.findall(text))
        assert (i, want) in [h[:2] for h in hits], (i, t, text)


def test_recall_at_the_full_limit_by_length():
    """More edits of every kind, all that each item may have."""
    r = random.Random(12)
    for sizes in ((5, 9), (10, 14), (15, 24), (25, 39), (40, 59)):
        rows = [(k, " ".join(words(5000 + 100 * sizes[0] + k, r.randint(*sizes)))) for k in range(150)]
        index, found, n = dc.Index.build(rows), 0, 0
        for i, t in rows:
            w = t.split()
            for k in r.sample(range(len(w)), len(w) // 5):
                w[k] = r.choice(["", "zzz", f"{w[k]} yyy", f"yyy {w[k]}", "xxx"])
            found += i in [h[0] for h in index.find([f"{prose(i, 30)} {' '.join(w)} {prose(i + 7, 30)}"])[0]]
            n += 1
        assert found >= 0.99 * n, sizes


def test_windows_cover_the_items_and_repetitions_grow_with_edits():
    walks = dc.repetitions((30, 34), 0.2, 3, 11)
    assert all(w.size + w.offset == 30 and w.size >= 30 - 6 - dc.ANCHORS and len(w.rows) == 3 * w.size for w in walks)
    assert {w.offset for w in walks} == set(range(6 + dc.ANCHORS)) and {w.steps[0] for w in walks} == {0}
    assert len({tuple(w.steps) for w in walks}) > len(walks) // 2
    assert len(dc.repetitions((30, 34), 0.05, 3, 11)) < len(walks)
    assert len(dc.repetitions((4, 4), 0.2, 3, 11)) == 1


def test_many_items_get_more_samples(monkeypatch):
    monkeypatch.setattr(dc, "BUCKET_ITEMS", 4)
    rows = [(k, " ".join(words(k, 20))) for k in range(40)]
    index = dc.Index.build(rows, 0.1)
    assert all(len(w.steps) >= 4 for w in index.walks)
    assert all([h[:2] for h in index.find([t])[0]] == [(i, 0)] for i, t in rows)


def test_short_items_are_found_without_their_first_word():
    rows = [(n, " ".join(words(n, n))) for n in range(5, 11)]
    index = dc.Index.build(rows)
    for i, t in rows:
        rest = t.split(" ", 1)[1]
        for text in (f"{prose(1)} qqq {rest} {prose(2)}", f"{prose(1)} {rest} {prose(2)}", rest):
            assert i in [h[0] for h in index.find([text])[0]]


def test_scripts_without_spaces_are_read_letter_by_letter():
    rows = [(1, "光合作用把二氧化碳和水转化为有机物并释放氧气"), (2, "東京タワーは高さ三百三十三メートルの電波塔です"),
            (3, "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"), (4, "模型GPT有多少个参数"), (5, "水は百度で沸く")]
    index = dc.Index.build(rows)
    around = "我们昨天去了公园。{}，然后回家吃饭。"
    for i, t in rows:
        for k in (0, len(t) // 2, len(t) - 1):
            for text in (around.format(t), f"{prose(1)} {t} {prose(2)}", around.format(t[:k] + "犬" + t[k + 1:])):
                assert [h[0] for h in index.find([text])[0]] == [i]
    assert index.find([around.format("光合作用"), prose(5), "ประเทศไทย"]) == [[], [], []]
    assert dc.split_words("Ab 我们x_1 ที่!") == ["ab", "我", "们", "x_1", "ท", "ี", "่"]


def test_short_items_are_found_word_for_word(spark):
    rows = [(1, "Zürich"), (2, "born in Ulm"), (3, "one two three four"), (4, "沸点"), (5, "?!"), (6, "")]
    docs = [(1, f"{prose(1)} zürich."), (2, "He was born -- in Ulm!"), (3, "born at Ulm, in Ulm"), (4, "one two three three four"),
            (5, "zero one two three four"), (6, "水的沸点是"), (7, "沸腾点"), (8, None), (9, "born in"), (10, "")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    got = collected(dc.contaminated(documents(spark, docs), bench), "doc_id", "item_id", "edits")
    assert got == [(1, 1, 0), (2, 2, 0), (5, 3, 0), (6, 4, 0)]


def test_long_documents_are_cut_with_overlap(monkeypatch):
    rows = [(1, " ".join(words(77, 30)))]
    index = dc.Index.build(rows)
    monkeypatch.setattr(dc, "BATCH_WORDS", 50)
    for n in range(0, 200, 7):
        hit = index.find([f"{' '.join(words(5, n))} {rows[0][1]} {prose(6, 150)}"])[0]
        assert [(h[0], h[1], h[2]) for h in hit] == [(1, 0, n)]


def test_stage_keeps_clean_documents(spark):
    bench, rows = items(spark)
    docs = with_clashes(documents(spark, corpus(rows)))
    out = dc.clean(docs, bench)
    bad = {d for d, *_ in brute(corpus(rows), rows)}
    assert out.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(repr(d) for d, _ in corpus(rows) if d not in bad)


def test_empty_tables(spark):
    bench, rows = items(spark)
    docs = documents(spark, corpus(rows))
    assert dc.clean(docs, bench.limit(0)).count() == docs.count() and dc.contaminated(docs, bench.limit(0)).count() == 0
    assert dc.clean(docs.limit(0), bench).count() == 0 and dc.contaminated(docs.limit(0), bench).count() == 0
