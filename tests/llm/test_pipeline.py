import os

import pytest

import corpus_pipeline
from costloom.llm import queries, simhash
from costloom.llm.common import shared_folder

from .data import documents, prose, words

SF = "/root/testdata/sf0.001"


def folder(spark, rows):
    out = shared_folder(spark, "pipeline-test")
    documents(spark, rows).write.parquet(f"{out}/documents.parquet")
    items = [(k, " ".join(words(900 + k, 20))) for k in range(4)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, items


def test_each_stage_works_on_what_the_last_one_kept(spark):
    rows = [(k, prose(k, 80), "en", f"s{k % 3}") for k in range(60)]
    item = " ".join(words(902, 20))
    rows += [(100, prose(1, 80)), (101, None), (102, "12 34 !"), (103, f"{prose(70, 50)} {item} {prose(71, 50)}"),
             (104, f"{prose(80, 50)} password = onlyMine123 {prose(81, 20)}"), (None, prose(90, 50)), (5, prose(5, 80), "en", "s2")]
    path, _ = folder(spark, rows)
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = shared_folder(spark, "stage")
        stage(spark, docs, path).write.parquet(out)
        kept = spark.read.parquet(out)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert kept.columns == docs.columns, name
        docs, seen[name] = kept, [(r.doc_id, r.text) for r in kept.collect()]
    ids = {n: sorted((i for i, _ in v), key=repr) for n, v in seen.items()}
    assert ids["language"] == sorted([*range(60), 5, 100, 103, 104, None], key=repr)
    assert ids["near_duplicates"] == sorted([*range(60), 103, 104, None], key=repr)
    assert ids["decontamination"] == ids["secrets"] == sorted([*range(60), 104, None], key=repr)
    assert dict(seen["secrets"])[104] == f"{prose(80, 50)} <SECRET> {prose(81, 20)}"
    assert {t for _, t in seen["mixing"]} <= {t for _, t in seen["secrets"]}
    whole = sorted(((r.doc_id, r.mix_pass, r.mix_words, r.mix_position) for r in corpus_pipeline.run(spark, path).collect()), key=repr)
    assert whole == sorted(((r.doc_id, r.mix_pass, r.mix_words, r.mix_position) for r in docs.collect()), key=repr)


def test_empty_tables(spark):
    out = shared_folder(spark, "pipeline-test")
    documents(spark, [(1, "x")]).limit(0).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    assert corpus_pipeline.run(spark, out).count() == 0


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and simhash.RADIUS == 4


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    from checks import compare as c

    line = c.compare(spark, c.connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert line.startswith("ok"), line


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", ["op2_mixing", "op5_secrets"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
