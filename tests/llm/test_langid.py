import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from costloom.llm import langid

from .data import collected, documents, with_clashes

SOUNDS = {"aa": "the and ing tion er".split(), "bb": "sch ung der ein ich".split(), "cc": "eau que les ment ou".split()}


def text(lang, seed, n=30):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SOUNDS[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def corpus(spark):
    rows = [(k, text(lang, k, 5 + k % 40), lang) for k, lang in enumerate(sorted(SOUNDS) * 80)]
    rows += [(1001, None, "aa"), (1002, "", "aa"), (1003, "123 !? 😀", "aa"), (1004, text("bb", 1, 4000), None), (None, text("cc", 2), "cc"),
             (1007, text("aa", 7), "bb"), (1007, text("aa", 7), "bb"), (1005, "пёс и кот", None)]
    return documents(spark, rows)


def test_held_out_accuracy_and_odd_rows(spark):
    got = langid.identify(corpus(spark)).collect()
    assert len(got) == 248 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (1001, 1002, 1003))
    assert by[1004].lang_pred == "bb" and by[None].lang_pred == "cc" and not by[None].held_out and by[1005].lang_pred in SOUNDS
    held = [r for r in got if r.held_out and r.doc_id < 240]
    assert [r.held_out for r in got if r.doc_id is not None] == [zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got if r.doc_id is not None]
    assert np.mean([r.lang_pred == sorted(SOUNDS)[r.doc_id % 3] for r in held]) > 0.95
    assert [(r.lang_pred, r.score) for r in got if r.doc_id == 1007] == [("aa", by[1007].score)] * 2


def test_stage_keeps_documents_of_known_languages(spark):
    docs = with_clashes(corpus(spark))
    out = langid.keep_identified(docs)
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert out.columns == docs.columns and set(range(240)) <= ids and not ids & {1001, 1002, 1003}


def test_held_out_languages_are_not_learned(spark):
    docs = corpus(spark)
    lied = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert collected(langid.identify(docs)) == collected(langid.identify(lied))


def test_no_labels_and_empty_table(spark):
    docs = documents(spark, [(1, "some text", None)])
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)]
    assert langid.identify(corpus(spark).limit(0)).count() == 0


def test_pieces_of_long_texts_add_up(monkeypatch):
    t = text("aa", 3, 500)
    whole = np.sort(np.concatenate(list(langid.subwords(t))))
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert (np.sort(np.concatenate(list(langid.subwords(t)))) == whole).all()
    assert sum(map(len, langid.subwords("x" * 1000))) > 1000
