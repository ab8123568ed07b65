"""The registered queries of this package and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, importance, langid, lattice, mixing, pii, quality, secrets, simhash, warc, whiten
from .common import shared_folder, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_langid")
def op1_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


_MIX = r"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '')) as h
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as n from d group by source),
w as (select *, case (n - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight from s),
l as (
  select *, cast(3 * sum(source_size) over () - 2 * coalesce(sum(2 * source_size) over b, 0) as double)
         / cast(2 * (sum(weight) over () - coalesce(sum(weight) over b, 0)) as double) as level
  from w window b as (order by cast(source_size as double) / weight, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, weight, least(2.0::double * source_size, max(level) over () * weight) as target from l),
p as (
  select d.doc_id, d.size, t.source_size, t.weight, t.target, floor(t.target + 0.5) as wanted,
         coalesce(sum(d.size) over (partition by d.source order by d.h, d.doc_id rows between unbounded preceding and 1 preceding), 0) as begun
  from d join t on d.source is not distinct from t.source),
k as (
  select *, greatest(least(wanted - begun, size), 0) as first_words, greatest(least(wanted - source_size - begun, size), 0) as second_words,
         case weight when 5 then 1.5 when 2 then 1.0 else 0.5 end::double as a, case weight when 5 then 0.5 when 2 then 1.0 else 1.5 end::double as b
  from p),
r as (select *, (begun + first_words / 2.0::double) / wanted * ((a + b) / 2) as area from k)
select doc_id, size, source_size, target, cast(first_words + second_words as bigint) as taken,
       case when first_words > 0 then round(least(2 * area / (a + sqrt(a * a + 2 * (b - a) * area)), 1.0::double), 9) end as first_position
from r
"""


@query("op2_mixing", _MIX)
def op2_mixing(spark, sf_dir):
    return mixing.targets(table(spark, sf_dir, "documents"))


@query("op3_decontaminate")
def op3_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WARC = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha256(html) as payload_digest, min(page_id) over (partition by html) as first from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id is distinct from first then first end as refers_to
from d
"""


@query("op4_warc", _WARC)
def op4_warc(spark, sf_dir):
    path = shared_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.listing(warc.read_warc(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_secrets")
def op5_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op6_pii")
def op6_pii(spark, sf_dir):
    return pii.surrogates(table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7_simhash(spark, sf_dir):
    return simhash.deduplicate(table(spark, sf_dir, "documents"))


@query("op8_lattice")
def op8_lattice(spark, sf_dir):
    return lattice.deduplicate(table(spark, sf_dir, "embeddings"))


_CHAT = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select *, length(regexp_replace(replace(text, '\', '\\'), '([\[<])(/?INST\]|/?s>|<SYS>>|</SYS>>|\|role\|>|\|text\|>|\|end\|>)', '\1\\\2', 'g'))
         + case role when 'user' then 15 when 'assistant' then 5 when 'system' then 17 end as chars
  from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(3 + sum(chars) as bigint) as formatted_chars
from e group by conv_id
"""


@query("op9_chat", _CHAT)
def op9_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(chat.format_chats(given.unionByName(probe)))


@query("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_whiten")
def op11_whiten(spark, sf_dir):
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_bpe")
def op12_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query("op13_importance")
def op13_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
