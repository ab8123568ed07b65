import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from costloom.llm import bpe

from .data import collected, documents, prose, with_clashes

PATH = bpe.default_vocabulary()
MODEL = bpe.model(open(PATH, "rb").read())
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["hello", "a", "aaaa", " ", "\t\n", "\x1c", "\x85", "the", "ing", "tion", "é", "é", "İ", "Σς", "'s", "'LL", "don't", "12", "½", "!!", "…", "日本", "한국",
         "😂", "🇺🇸", "<|endoftext|>", "<|startoftext|>", "<|end", "Ᲊ", "՘", "\u0000", "</w>", "hahaha", "ǆ", "ﬁ", "́"]
TABLES = ("/root/testdata/sf0.001/documents.parquet", "/root/testdata/sf0.01/documents.parquet")


def ids(text):
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=8)), max_size=30))
def test_texts_are_encoded_and_decoded_as_by_the_library(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    got = MODEL.encode([text])[0]
    assert got == ids(text)
    assert MODEL.decode(got) == LIBRARY.decode(np.frombuffer(got, "<u4").tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeinorsth", min_size=1, max_size=40))
def test_words_that_the_guess_gets_wrong(word):
    assert MODEL.encode([word])[0] == ids(word)


def test_every_code_point():
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["x".join(["", *points[k:k + 64], ""]) + " ".join(points[k:k + 64]) for k in range(0, len(points), 64)]
    wrong = [hex(64 * k) for k, (a, t) in enumerate(zip(MODEL.encode(texts), texts)) if a != ids(t)]
    assert not wrong


def test_pairs_are_compatible_when_merging_keeps_them():
    r = random.Random(8)
    inner = [i for i, t in enumerate(MODEL.names[:-2]) if not t.endswith("</w>")]
    short = sorted(inner, key=lambda i: len(MODEL.names[i]))[:2500]
    left = np.array([r.choice(short) for _ in range(6000)])
    right = np.array([r.choice(short if k % 3 else range(MODEL.size - 2)) for k in range(6000)])
    want = [MODEL.merge(MODEL.symbols(int(a)) + MODEL.symbols(int(b))) == [a, b] for a, b in zip(left, right)]
    assert MODEL.compatible(left, right).tolist() == want and 500 < sum(want) < 5900


@pytest.mark.parametrize("letters", ["a", "ab", "ha", "aeiouthnrsdlc", "😂", "日本語", "é"])
@pytest.mark.parametrize("length", [bpe.LONG - 1, bpe.LONG + 1, 5000])
def test_long_words(letters, length):
    r = random.Random(length)
    word = "".join(r.choice(letters) for _ in range(length))
    assert MODEL.encode([word])[0] == ids(word)


def test_texts_longer_than_a_piece(monkeypatch):
    text = " ".join([prose(1, 4000), "é" * 3000, "  a  ", "<|endoftext|> ", "<|endoftext|>" * 40, "x" * 5000, prose(2, 4000)])
    for piece in (10, 1000, 1 << 20):
        monkeypatch.setattr(bpe, "PIECE", piece)
        assert MODEL.encode([text, "", None, text]) == [ids(text), b"", b"", ids(text)]


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    monkeypatch.setattr(bpe, "PIECE", 50)
    texts = [prose(k, 20) for k in range(40)]
    assert MODEL.encode(texts) == [ids(t) for t in texts]


@pytest.mark.parametrize("path", TABLES)
def test_whole_tables(spark, path):
    docs = spark.read.parquet(path)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        want = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        back = LIBRARY.decode(want, skip_special_tokens=False)
        assert got[r.doc_id] == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "one two"), (4, "Same words"), (4, "Same words"), (5, "x" * 100_000), (6, prose(3, 30_000))]
    docs = with_clashes(documents(spark, rows))
    out = bpe.round_trip(docs)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = [len(ids(t or "")) // 4 for _, t in rows]
    assert sorted(r.n_tokens for r in out.collect()) == sorted(want)
    assert collected(out) == collected(bpe.round_trip(docs.repartition(3)))
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_clashing_names_stay(spark):
    docs = spark.createDataFrame([("hello world", 5, 6, None)], "text string, ids int, decoded int, ids_ string")
    out = bpe.decode(bpe.encode(docs), "ids__")
    assert out.columns == ["text", "ids", "decoded", "ids_", "ids__", "decoded_"]
    assert tuple(out.first())[1:4] == (5, 6, None) and out.first().decoded_ == "hello</w> world</w>"


def test_another_vocabulary_of_the_form_and_of_no_such_form(spark, tmp_path):
    spec = json.load(open(PATH))
    spec["model"]["merges"] = spec["model"]["merges"][:500]
    kept = {i for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]) for i in (a + b,)}
    base = {t: i for t, i in spec["model"]["vocab"].items() if i < 512 or t in kept}
    spec["model"]["vocab"] = base
    (tmp_path / "v.json").write_text(json.dumps(spec))
    small = Tokenizer.from_file(str(tmp_path / "v.json"))
    text = prose(9, 200)
    got = bpe.encode(documents(spark, [(1, text)]), vocabulary=str(tmp_path / "v.json")).first().ids
    assert np.frombuffer(got, "<u4").tolist() == small.encode(text, add_special_tokens=False).ids
    spec["model"]["end_of_word_suffix"] = None
    (tmp_path / "w.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.encode(documents(spark, [(1, text)]), vocabulary=str(tmp_path / "w.json"))
