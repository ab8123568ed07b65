"""PII surrogates: keyed, type-consistent replacements that keep distinct entities distinct.

Detected are e-mail addresses, phone numbers, card numbers (13 to 19 digits, a card's first digit, valid check digit), IPv4 addresses,
IBANs, social security numbers, and people named with a title or by a listed first name. Every entity is replaced by a keyed permutation
of the strings of its own shape: digits become digits, small letters small letters, capitals capitals, and separators stay. A
permutation can't map two entities of one shape to the same surrogate, and a function of key and entity maps all mentions
alike, so distinctness and coreference hold across the corpus without a shared table. Cards get a new valid check digit and keep their
first digit, phones keep a country code, addresses of hosts stay addresses, mail domains keep their last part.

Names have no shape to permute. A first name becomes one of the same gender and script, a surname one of the same script, both chosen
by a keyed hash; parts are mapped on their own, so that "Mrs Vogel" and "Anna Vogel" still share a surname. Here collisions are possible.

*Collision check.* All distinct entities of the corpus are listed with their surrogates. Where two entities have one surrogate, or a surrogate
is itself an entity of the corpus, the entity is keyed again with a higher attempt, until none collides. The attempts, few as they
are, are joined back to the documents that hold such an entity; all other documents pass without a join.

Null texts stay null, empty texts empty. Very long texts are scanned whole. Ties between overlapping entities go to the kind listed first.
Repeated rows get equal results, null ids are carried along, empty tables give empty results. Other columns are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.spread import grouped_for_join
from .common import checkpointed, fresh, map_texts, row_hash

KEY = b"change this key"
MOST_REAL = 16

_EMAIL_LEFT = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}$")
_EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,24}")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_CARD = re.compile(r"(?<![\w.+-])[2-6]\d{3}(?:[ -]?\d){9,15}(?![\w])")
_SSN = re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w.+-])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{2,5})(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w]|-\d)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
# Titles by gender, and first names by script and gender, from which surrogates are drawn.
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f",
          "Señora": "f", "Señorita": "f", "Dr": "n", "Prof": "n", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
FIRST_NAMES = {
    ("latin", "m"): "James John Robert Michael William David Richard Joseph Thomas Daniel Pierre Jean Carlos José Hans Peter".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Sarah Karen Anna Marie Sophie Carmen Lucía Ursula Petra".split(),
    ("cyrillic", "m"): "Александр Дмитрий Иван Сергей Николай Павел Михаил Виктор".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παύλος".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Δέσποινα".split(),
}
SYLLABLES = {"latin": "bar den fer gal hol kam lin mor nel pas rud sel tor ven wil".split(),
             "cyrillic": "бар вел гор дан зим кор лев мар нов пет род сим тор".split(),
             "greek": "βαρ γελ δαμ καλ λεν μαρ νικ παπ ροδ σταμ τρι φιλ".split()}
_FIRST = {n: key for key, names in FIRST_NAMES.items() for n in names}
_NAME = r"[^\W\d_]+(?:[-'][^\W\d_]+)?"
_PERSON = re.compile(rf"(?<!\w)(?:(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?[ ](?P<a>{_NAME})(?:[ ](?P<b>{_NAME}))?"
                     rf"|(?P<first>{'|'.join(sorted(_FIRST, key=len, reverse=True))})[ ](?P<last>{_NAME}))(?!\w)")


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` and it a valid number."""
    doubled = [sum(divmod(2 * int(c), 10)) for c in digits[::-1][::2]]
    return -(sum(doubled) + sum(map(int, digits[::-1][1::2]))) % 10


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def script(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        left, right = _EMAIL_LEFT.search(text[max(0, at - 64):at]), _EMAIL_RIGHT.match(text, at)
        if left and right:
            yield at - len(left.group()), right.end()
        at = text.find("@", at + 1)


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) in order, without overlaps; the entity is what all its mentions share."""
    found: list[tuple[int, int, str, str]] = []

    def add(parts: Iterable[tuple[int, int, str, str]]) -> None:
        held = sorted((a, b) for a, b, _, _ in found)
        for part in parts:
            k = bisect_left(held, (part[1],))
            if not k or held[k - 1][1] <= part[0]:
                found.append(part)

    add(((a, b, "email", text[a:b].lower()) for a, b in _emails(text)))
    if any(c.isdigit() for c in text):
        add(((m.start(), m.end(), "ip", m.group()) for m in _IP.finditer(text)))
        cards = ((m, _digits(m.group())) for m in _CARD.finditer(text))
        add(((m.start(), m.end(), "card", d) for m, d in cards if 13 <= len(d) <= 19 and luhn(d[:-1]) == int(d[-1])))
        add(((m.start(), m.end(), "ssn", _digits(m.group())) for m in _SSN.finditer(text)))
        phones = ((m, _digits(m.group())) for m in _PHONE.finditer(text))
        add(((m.start(), m.end(), "phone", ("+" if m.group()[0] == "+" else "") + d) for m, d in phones if 7 <= len(d) <= 15))
        add(((m.start(), m.end(), "iban", m.group().replace(" ", "")) for m in _IBAN.finditer(text)
                     if int("".join(str(int(c, 36)) for c in (lambda s: s[4:] + s[:4])(m.group().replace(" ", "")))) % 97 == 1))
    people: list[tuple[int, int, str, str]] = []
    for m in _PERSON.finditer(text):
        if m["title"]:
            gender = TITLES[m["title"]]
            first, last = (m.span("a"), m.span("b")) if m["b"] and m["b"][0].isupper() else (None, m.span("a"))
            if not text[m.start("a")].isupper():
                continue
        else:
            gender, first, last = _FIRST[m["first"]][1], m.span("first"), m.span("last")
            if not text[last[0]].isupper():
                continue
        if first:
            name = text[slice(*first)]
            gender = _FIRST.get(name, (None, gender))[1]
            people.append((*first, f"first-{gender}", name))
        people.append((*last, "last", text[slice(*last)]))
    add(people)
    return sorted(found)


def _prf(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), "big")


def permute(number: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1: a balanced network over the bits, walked until it is back in range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = number >> half, number & mask
        for r in range(6):
            left, right = right, left ^ (_prf(key, tweak, size, r, right) & mask)
        number = left << half | right
        if number < size:
            return number


def _alphabet(c: str) -> str | None:
    if c.isascii():
        return ("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else None)
    return None


def reshape(text: str, key: bytes, tweak: str) -> str:
    """Another string of the same shape, by a permutation of all strings of that shape."""
    sets = [_alphabet(c) for c in text]
    number, size = 0, 1
    for c, s in zip(text, sets):
        if s:
            number, size = number * len(s) + s.index(c), size * len(s)
    if size == 1:
        return text
    shape = "".join("9" if s and s[0] == "0" else "a" if s and s[0] == "a" else "A" if s else c for c, s in zip(text, sets))
    number, out = permute(number, size, key, f"{tweak}\x1f{shape}"), []
    for c, s in zip(reversed(text), reversed(sets)):
        if s:
            number, k = divmod(number, len(s))
            out.append(s[k])
        else:
            out.append(c)
    return "".join(reversed(out))


def _invented(kind: str, name: str, key: bytes, attempt: int) -> str:
    """A name of the same script and gender; higher attempts draw from ever larger sets."""
    where = script(name)
    draw = _prf(key, kind, name, attempt)
    parts = SYLLABLES[where]
    syllables = []
    for _ in range(attempt + (kind == "last") * 2):
        draw, k = divmod(draw, len(parts))
        syllables.append(parts[k])
    if kind == "last":
        made = "".join(syllables).capitalize()
    else:
        gender = kind[-1] if kind[-1] in "mf" else "mf"[_prf(key, "gender", name) % 2]
        listed = FIRST_NAMES[where, gender]
        made = listed[draw % len(listed)] + ("-" + "".join(syllables).capitalize() if syllables else "")
    return made.upper() if name.isupper() and len(name) > 1 else made


def surrogate(kind: str, entity: str, key: bytes = KEY, attempt: int = 0) -> str:
    """The replacement of an entity, in its plain form."""
    tweak = f"{kind}\x1f{attempt}"
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        host, _, last = domain.rpartition(".")
        return reshape(f"{local}@{host}", key, tweak + "\x1f" + last) + "." + last
    if kind == "card":
        body = entity[0] + reshape(entity[1:-1], key, tweak + entity[0])
        return body + str(luhn(body))
    if kind == "ip":
        number = 0
        for part in entity.split("."):
            number = number << 8 | int(part)
        number = permute(number, 1 << 32, key, tweak)
        return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))
    if kind == "phone":
        keep = 2 if entity[0] == "+" else 0
        return entity[:keep] + reshape(entity[keep:], key, tweak + entity[:keep])
    if kind == "iban":
        body = reshape(entity[4:], key, tweak + entity[:2])
        rest = int("".join(str(int(c, 36)) for c in body + entity[:2] + "00")) % 97
        return f"{entity[:2]}{98 - rest:02d}{body}"
    if kind == "ssn":
        return reshape(entity, key, tweak)
    return _invented(kind, entity, key, attempt)


def dressed(kind: str, mention: str, made: str) -> str:
    """A surrogate in the format of the mention it stands for."""
    if kind in ("card", "phone", "ssn", "iban"):
        signs = iter(made.lstrip("+"))
        return "".join(next(signs) if c.isalnum() else c for c in mention)
    if kind == "email" and len(mention) == len(made):
        return "".join(m.upper() if c.isupper() else m for c, m in zip(mention, made))
    return made


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, entity, surrogate) of every mention in order."""
    out, at, log = [], 0, []
    for start, end, kind, entity in entities(text):
        made = surrogate(kind, entity, key, attempts.get((kind, entity), 0))
        out += [text[at:start], dressed(kind, text[start:end], made)]
        log.append((kind, entity, made))
        at = end
    return "".join([*out, text[at:]]), log


_ENTITY = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("entity", T.StringType())]))


def _arrow(pairs: list[str]):
    import pyarrow as pa

    return pa.list_(pa.struct([(n, pa.string()) for n in pairs]))


def _keyed(entities_: DataFrame, key: bytes) -> DataFrame:
    """``(kind, entity, attempt)`` with the surrogate."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            kind, entity, attempt = (batch.column(c).to_pylist() for c in ("kind", "entity", "attempt"))
            made = [surrogate(*x[:2], key, x[2]) for x in zip(kind, entity, attempt)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "entity", "attempt", "made"])

    return entities_.mapInArrow(run, "kind string, entity string, attempt int, made string")


def attempts(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, entity)`` to the entities whose surrogate had to be drawn again, with the attempt that holds.

    A kind here is what must stay distinct: first names of either gender count as one.
    """
    family = F.when(F.col("kind").startswith("first"), F.lit("first")).otherwise(F.col("kind"))
    known = checkpointed(found.select("kind", "entity").distinct())
    real = known.select(family.alias("family"), F.col("entity").alias("made")).distinct().withColumn("is_real", F.lit(True))
    state = checkpointed(_keyed(known.withColumn("attempt", F.lit(0)), key))
    while True:
        claims = state.withColumn("family", family)
        # The entity that sorts first keeps a surrogate that several drew.
        first = grouped_for_join(claims, ["family", "made"], F.min(F.struct("entity", "kind")).alias("owner"), F.count("*").alias("n"))
        clash = claims.join(first.filter("n > 1"), ["family", "made"], "left").join(real, ["family", "made"], "left")
        # A shape so short that the corpus holds all its strings leaves no other surrogates.
        again = (F.col("is_real").isNotNull() & (F.col("attempt") < MOST_REAL)) | (F.col("n").isNotNull() & (F.struct("entity", "kind") != F.col("owner")))
        marked = checkpointed(clash.select("kind", "entity", "attempt", "made", again.alias("again")))
        if marked.filter("again").isEmpty():
            return state.filter("attempt > 0").select("kind", "entity", "attempt")
        redrawn = _keyed(marked.filter("again").select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), key)
        state = checkpointed(marked.filter("not again").drop("again").unionByName(redrawn))


def pseudonymize(docs: DataFrame, key: bytes = KEY, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, str]:
    """``docs`` with surrogates in ``text`` and the list of replacements (kind, entity, surrogate); and that column's name.

    The list is for audits; drop it before the documents leave.
    """
    import pyarrow as pa

    def detect(texts):
        return [pa.array([[{"kind": k, "entity": e} for k, e in dict.fromkeys((x[2], x[3]) for x in entities(t))] if t else [] for t in texts],
                         _arrow(["kind", "entity"]))]

    narrow = docs.select(F.col(doc_id).alias("id"), row_hash(docs).alias("row"), F.col(text).alias("__text"))
    scanned = checkpointed(map_texts(narrow, "__text", [T.StructField("found", _ENTITY)], detect, ("__text",)).filter(F.size("found") > 0))
    each = scanned.select("id", "row", F.explode("found").alias("e")).select("id", "row", "e.kind", "e.entity")
    redrawn = checkpointed(attempts(each, key))
    name, log = fresh("replacements", docs.columns), T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "entity", "surrogate")]))
    special, rows = "__attempts", docs
    if redrawn.isEmpty():
        rows = rows.withColumn(special, F.lit(None).cast("string"))
    else:
        per = each.join(redrawn, ["kind", "entity"]).groupBy("id", "row").agg(
            F.to_json(F.collect_set(F.struct("kind", "entity", "attempt"))).alias(special)).select(
            F.col("id").alias("__id"), F.col("row").alias("__row"), special)
        rows = rows.withColumn("__h", row_hash(docs)).join(
            per, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__row")), "left").drop("__h", "__id", "__row")
    kept = docs.columns

    def run(batches):
        import json

        for batch in batches:
            texts, logs = [], []
            for t, raw in zip(batch.column(text).to_pylist(), batch.column(special).to_pylist()):
                held = {(x["kind"], x["entity"]): x["attempt"] for x in json.loads(raw)} if raw else {}
                made, said = replaced(t, key, held) if t else (t, [])
                texts.append(made)
                logs.append([dict(zip(("kind", "entity", "surrogate"), x)) for x in said])
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(logs, _arrow(["kind", "entity", "surrogate"]))], names=[*kept, name])

    return rows.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, log)])), name


def surrogates(docs: DataFrame, key: bytes = KEY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, the text with surrogates, and how many mentions of how many entities were replaced."""
    made, log = pseudonymize(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), key)
    return made.select("doc_id", "text", F.size(log).cast("long").alias("n_mentions"),
                       F.size(F.array_distinct(F.transform(log, lambda x: F.struct(x["kind"], x["entity"])))).cast("long").alias("n_entities"))
