"""Small fixtures: documents with every odd case, and a text maker."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that the operators use for themselves, as columns of the input.
CLASHING = ["row", "size", "score", "fingerprint", "hits", "mix_pass", "found", "label", "rejected", "replacements"]


def words(seed, n, syllables="ba den fi gol mur sta ter von wil zon".split()):
    r = random.Random(seed)
    return ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(n)]


def prose(seed, n=60):
    return " ".join(words(seed, n))


def documents(spark, rows, schema=SCHEMA):
    full = [(i, t, "en" if len(r) < 1 else r[0], "s" if len(r) < 2 else r[1], None if t is None else len(t)) for i, t, *r in rows]
    return spark.createDataFrame(full, schema)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(c).alias(c) for c in CLASHING if c not in df.columns))


def collected(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
