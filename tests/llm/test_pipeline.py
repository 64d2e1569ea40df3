import os
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexiforge.llm import decontaminate, jaccard, registry
from lexiforge.llm.common import SHUFFLE_CLEANUP, documents, materialize, scratch_root

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_stages(spark):
    docs = documents(spark, SF)
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns and 0 < docs.count() <= rows
        rows = docs.count()
    whole = {r["doc_id"]: r["doc_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(whole) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert docs.filter("text rlike '[a-z]@[a-z]' or text like '%token = \"_______________%'").count() == 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op6_suffix_dedup", "op7_jaccard_join", "op8_decontamination"])
def test_like_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    assert sorted(tuple(map(str, r)) for r in df.select(*cols).collect()) == sorted(tuple(map(str, r)) for r in rel.select(*cols).fetchall())


def test_rows_by_content(spark):
    """Null and repeated ids, and columns with the names of helpers: only the rows at fault go."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _gone int, _rejected int, _c0 int"
    prose = " ".join(f"river{k} stone" for k in range(40))
    item = " ".join(f"question{k}" for k in range(20))
    rows = [(None, item), (7, item), (7, prose), (None, prose), (None, prose), (3, prose + " end"), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3) for i, t in rows], schema)
    bench = spark.createDataFrame([(1, item, 5)], "item_id long, text string, n int")
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(str, rows[2:]))
    left = jaccard.deduplicate(docs)
    assert left.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert got == sorted([(7, item), (3, prose + " end"), (8, None)], key=str)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3) for i, t in [(7, prose), (7, "1 2 3"), (None, "4 5"), (None, prose)]], schema)
    left = corpus_pipeline.language_id(spark, docs, SF)
    assert left.columns == docs.columns and {r["text"] for r in left.collect()} <= {prose}


def test_names():
    assert [n.split("_")[0] for n in registry.queries() if n.startswith("op")] == [f"op{k}" for k in range(1, 14)]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_scratch_leaves_no_shuffle_files(spark):
    spark.conf.unset(SHUFFLE_CLEANUP)
    before = shuffle_files(spark)
    rows = materialize(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count(), "swept")
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and rows.count() == 10
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_pipeline_removes_tables_of_finished_stages(spark, monkeypatch):
    step = lambda spark, docs, sf_dir: materialize(docs.withColumn("n_chars", F.col("n_chars") + 1), "swept-step")
    last = lambda spark, docs, sf_dir: docs.agg(F.count("*").alias("n"), F.sum("n_chars").alias("s"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("swept-a", step), ("swept-b", step), ("swept-c", last)])
    found = corpus_pipeline.run(spark, SF)
    left = [f.rsplit("-", 1)[0] for f in os.listdir(f"{scratch_root(spark).removeprefix('file://')}/lexiforge") if "swept-step" in f or "pipeline-swept" in f]
    assert left == ["pipeline-swept-b"]
    docs = documents(spark, SF)
    assert found.first() == docs.agg(F.count("*"), F.sum(F.col("n_chars") + 2)).first()
