"""Secret scan with corpus-wide ownership frequency. DataFrame functions only.

Candidates are found by pattern. Their hashes are then counted over the whole corpus: a value that
turns up under many owners or in many repositories is a copied example, one that stays with an owner or two
and in few repositories is that owner's own and may be live. Documents are the repositories; those of one text are copies and count once. High-entropy strings without a keyword are too noisy to report by pattern alone;
the frequency decides about them.

Null texts count as empty, null owners as one owner of their own.
Repeated rows give repeated results. Empty tables give empty results, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.spread import grouped_for_join
from .common import checkpointed, fresh, let, row_hash

# Kinds in the order in which they are listed, their patterns, the group that holds the
# value, and its least length.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ENTROPY = r"[A-Za-z0-9+/_-]{24,}"
BASE = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))

BLOCK = 256
MAX_OWNERS = 2
MAX_REPOSITORIES = 10

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _starts(steps: Column) -> Column:
    """Sum of the elements before each one, in blocks, so that a text with very many matches stays cheap."""

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, _total)
        return let(totals, lambda t: F.flatten(F.transform(
            blocks, lambda block, b: let(_total(F.slice(t, 1, b)), lambda base: F.transform(
                block, lambda _, i: base + _total(F.slice(block, 1, i)))))))

    numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    return let(F.transform(numbers, lambda b: F.slice(steps, b * BLOCK + 1, BLOCK)), of_blocks)


def spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, value), in code points, end exclusive.

    The pieces between the matches and the matches themselves give the positions.
    """

    def positions(found: Column) -> Column:
        steps = F.transform(found["whole"], lambda w, i: F.get(found["gaps"], i) + F.length(w))
        every = let(_starts(steps), lambda before: F.transform(found["whole"], lambda w, i: F.struct(
            (F.get(before, i) + F.get(found["gaps"], i)).cast("int").alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            (F.get(before, i) + F.get(found["gaps"], i) + F.length(w)).cast("int").alias("end"),
            F.get(found["value"], i).alias("value"))))
        return F.filter(every, lambda s: F.length(s["value"]) >= least)

    found = F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    return F.when(text.rlike(pattern), let(found, positions)).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def base_spans(text: Column) -> Column:
    """Spans of the base patterns by start, then kind."""
    return F.array_sort(F.concat(*(spans(text, *kind) for kind in BASE)))


def entropy_spans(text: Column) -> Column:
    """Long strings that mix digits, capitals and small letters."""
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]")
    return F.filter(spans(text, "entropy", ENTROPY), mixed)


def written(found: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """``(value, owner, repository)`` to ``(value, owners, repositories)``, both counted distinct.

    Distinct rows are found first and counted on the map side, so a value held by a
    third of all documents is never gathered in one task.
    """
    holder = lambda is_owner, name: F.struct(F.lit(is_owner).alias("is_owner"), F.col(name).cast("string").alias("who"))
    holders = candidates.select("value", F.explode(F.array(holder(True, "owner"), holder(False, "repository"))).alias("h")).distinct()
    return grouped_for_join(holders, ["value"], F.count_if("h.is_owner").alias("owners"), F.count_if(~F.col("h.is_owner")).alias("repositories"))


def classified(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source",
               max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per document: ``id``, ``row`` (hash of the row), ``base`` spans and ``found``, all spans with ``live``.

    ``live`` says that at most ``max_owners`` owners and ``max_repositories`` documents of different text hold the value. Entropy spans appear only if live and
    clear of the base spans.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    clear = lambda base: lambda e: ~F.exists(base, lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"]))
    scanned = checkpointed(
        docs.select(F.col(doc_id).alias("id"), F.col(owner).alias("owner"), row_hash(docs).alias("row"), F.xxhash64(body).alias("repository"),
                    base_spans(body).alias("base"), entropy_spans(body).alias("extra"))
        .withColumn("extra", F.filter("extra", clear(F.col("base")))))
    any_span = F.size("base") + F.size("extra") > 0
    each = scanned.filter(any_span).select(
        "id", "row", "owner", "repository", F.explode(F.concat("base", "extra")).alias("s"))
    each = each.select("id", "row", "owner", "repository", F.sha2("s.value", 256).alias("value"),
                       F.struct("s.start", "s.kind", "s.end").alias("s")).distinct()
    counts = ownership(each)
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    seen = each.join(counts, "value").groupBy("id", "row").agg(F.array_sort(F.collect_list(F.struct(
        "s.start", "s.kind", "s.end", live.alias("live"), "owners", "repositories"))).alias("found"))
    kept = F.filter("found", lambda s: (s["kind"] < len(BASE)) | s["live"])
    left = scanned.filter(any_span).select("id", "row", "base")
    with_spans = left.alias("l").join(
        seen.alias("r"), F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.row") == F.col("r.row")), "left"
    ).select("l.id", "l.row", "l.base", kept.alias("found"))
    none = F.array().cast(with_spans.schema["found"].dataType)
    return with_spans.unionByName(scanned.filter(~any_span).select("id", "row", "base", none.alias("found")))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source",
         max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, how many are live or examples, and ``held_by``:
    ``owners:repositories`` of each span's value, in the order of the spans."""
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    alive = F.size(F.filter("found", lambda s: s["live"])).cast("long")
    held_by = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["owners"].cast("string"), s["repositories"].cast("string"))), ",")
    return classified(docs, text, doc_id, owner, max_owners, max_repositories).select(
        F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
        alive.alias("n_live"), (F.size("found").cast("long") - alive).alias("n_examples"), held_by.alias("held_by"))


def redact(docs: DataFrame, mark: str = "<SECRET>", text: str = "text", doc_id: str = "doc_id", owner: str = "source",
           max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``docs`` with every live span replaced by ``mark``; other rows and columns stay as they are.

    Only documents with a live span are joined; all others pass by.
    """
    live = lambda s: s["live"]
    hit = classified(docs, text, doc_id, owner, max_owners, max_repositories).filter(F.exists("found", live)).select(
        F.col("id").alias("__hit_id"), F.col("row").alias("__hit_row"), F.filter("found", live).alias("__hit")).dropDuplicates(
        ["__hit_id", "__hit_row"])

    def cut(text_: Column, found: Column) -> Column:
        start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

        def add(state: Column, s: Column) -> Column:
            gap = F.concat(F.substring(text_, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
            return F.struct(
                F.when(s["start"] >= state["at"], F.concat(state["done"], gap)).otherwise(state["done"]).alias("done"),
                F.greatest(state["at"], s["end"]).alias("at"))

        return F.aggregate(found, start, add, lambda s: F.concat(s["done"], F.substring(text_, s["at"] + 1, F.length(text_))))

    row = fresh("__row", docs.columns)
    joined = docs.withColumn(row, row_hash(docs)).join(
        hit, F.col(f"`{doc_id}`").eqNullSafe(F.col("__hit_id")) & (F.col(row) == F.col("__hit_row")), "left")
    made = joined.withColumn("__new", F.when(F.col("__hit").isNotNull(), cut(F.col(f"`{text}`"), F.col("__hit"))))
    counted = F.coalesce(F.length("__new").cast(docs.schema["n_chars"].dataType), F.col("n_chars")) if "n_chars" in docs.columns else None
    put = {text: F.coalesce("__new", F.col(f"`{text}`")), "n_chars": counted}
    return made.select(*(put.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
