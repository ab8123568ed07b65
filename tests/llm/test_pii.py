import re

import pytest

from costloom.llm import pii

from .data import documents, prose, with_clashes

KEY = b"test"
CARD, OTHER = "4111111111111111", "5500005555555559"
ROWS = [
    (1, "Write to Jo.Doe1@mail.example.com or jo.doe1@mail.example.com, call +1 (017) 555-7713 now."),
    (2, f"card {CARD} and 4111-1111-1111-1111 and {OTHER}; order 9807915762804490; v 4.0.2"),
    (3, "from 10.0.0.1 to 192.168.17.4, not 300.1.1.1; ssn 078-05-1120; DE89 3704 0044 0532 0130 00"),
    (4, "Mrs Vogel met Anna Vogel and Mr. John Smith. Господин Иванов. Κυρία Παππά."),
    (5, None), (6, ""), (7, prose(3)), (None, "mail jo.doe1@mail.example.com"), (8, "x@y @ a@b a@b.c"), (1, prose(4) + " 10.0.0.1"),
]
LEAKS = ["doe1", "555-7713", CARD, "1111-1111", OTHER, "10.0.0.1", "192.168.17.4", "078-05-1120", "3704 0044", "Vogel", "Smith", "Иванов", "Παππά"]


@pytest.fixture(scope="module")
def made(spark):
    docs = with_clashes(documents(spark, ROWS))
    out, log = pii.pseudonymize(docs, KEY)
    return docs, log, out.collect()


def test_nothing_leaks_and_the_rest_stays(made):
    docs, log, rows = made
    whole = "\n".join(r.text or "" for r in rows)
    assert not [x for x in LEAKS if x in whole]
    assert "order 9807915762804490; v 4.0.2" in whole and "300.1.1.1" in whole and prose(3) in whole
    by = {r.doc_id: r.text for r in rows if r.doc_id != 1}
    assert by[5] is None and by[6] == "" and by[8] == "x@y @ a@b a@b.c" and log == "replacements_"
    assert rows[0].asDict().keys() == {*docs.columns, log} and len(rows) == len(ROWS)


def test_formats_are_kept(made):
    flat = "\n".join(r.text or "" for r in made[2])
    a, b = re.search(r"Write to (\S+) or (\S+), call (.*) now", flat).group(1, 2)
    assert a.lower() == b and a[0].isupper() and re.fullmatch(r"[a-z]{2}\.[a-z]{3}\d@[a-z]{4}\.[a-z]{7}\.com", b)
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", flat)
    plain, dashed, other = re.search(r"card (\d{16}) and (\d{4}-\d{4}-\d{4}-\d{4}) and (\d{16});", flat).groups()
    assert dashed.replace("-", "") == plain != other and plain[0] == "4" and other[0] == "5"
    assert all(pii.luhn(x[:-1]) == int(x[-1]) for x in (plain, other))
    assert re.search(r"Mrs (\w+) met (\w+) \1 and Mr\. \w+ \w+\. Господин [А-Я][а-я]+\. Κυρία [Α-Ω]\w+\.", flat)
    iban = re.search(r"DE(\d\d (?:\d{4} ){4}\d\d)", flat).group(1).replace(" ", "")
    assert int(iban[2:] + "1314" + iban[:2]) % 97 == 1


def test_mentions_share_and_entities_differ(made):
    pairs = {(x.kind.split("-")[0], x.entity, x.surrogate) for r in made[2] for x in r[made[1]]}
    assert len({p[:2] for p in pairs}) == len(pairs) == len({(k, s) for k, _, s in pairs})
    assert not {(k, e) for k, e, _ in pairs} & {(k, s) for k, _, s in pairs}


def test_colliding_names_are_drawn_again(spark):
    names = [f"Mr {x.capitalize()}" for x in (a + b + c for a in "abcdefgh" for b in "aeiou" for c in ("rn", "lt", "nd"))]
    names += [f"Mr {a}{b}".replace("Mr ", "Mr ") for a in ("Bar", "Den", "Fer") for b in pii.SYLLABLES["latin"]]
    docs = documents(spark, [(k, n) for k, n in enumerate(names)])
    out, log = pii.pseudonymize(docs, KEY)
    pairs = {(x.entity, x.surrogate) for r in out.collect() for x in r[log]}
    assert len(pairs) == len({e for e, _ in pairs}) == len({s for _, s in pairs}) == len(names)
    assert not {e for e, _ in pairs} & {s for _, s in pairs}


def test_full_shapes_end(spark):
    docs = documents(spark, [(k, f"a@{chr(97 + k % 26)}.co {chr(97 + k // 26)}@{chr(97 + k % 26)}.co") for k in range(676)])
    out, log = pii.pseudonymize(docs, KEY)
    pairs = {(x.entity, x.surrogate) for r in out.collect() for x in r[log]}
    assert len(pairs) == 676 == len({s for _, s in pairs})


@pytest.mark.parametrize("size", [1, 2, 3, 10, 255, 256, 257, 1000])
def test_permutation(size):
    assert sorted(pii.permute(k, size, KEY, "t") for k in range(size)) == list(range(size))


def test_keys_matter_and_runs_agree(spark):
    docs = documents(spark, ROWS)
    one, two, again = (sorted(map(repr, pii.surrogates(docs, k).collect())) for k in (KEY, b"other", KEY))
    assert one == again != two
    assert pii.surrogates(docs.limit(0), KEY).count() == 0
