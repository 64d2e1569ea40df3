"""What operators must not do on large tables, read from their plans."""

import re

import pytest
from pyspark.sql import functions as F

from lexiforge.operators import events as ev
from lexiforge.operators import render, resolve, reviewed
from lexiforge.plans import normal
from lexiforge.plans import spans as span_plans

SPANS = "form_id long, line_ord int, line_id string, span_ord int, style string, clean_text string, x0 double, x1 double, join_next boolean"


@pytest.fixture
def large(spark):
    """Joins are planned as for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def spans(spark, texts):
    rows = [(0, 0, "a", i, s, x, 0.0, 1.0, False) for i, (s, x) in enumerate(texts)]
    return spark.createDataFrame(rows, SPANS)


def test_resolution_broadcasts_nothing(spark):
    groups = spark.range(1).selectExpr("id as sequence", "array('rumah') as spellings")  # of known, small size
    found = resolve.resolve(spark.range(1).selectExpr("id as ref_id", "'rumah' as text"), resolve.spellings_index(groups))
    assert "Broadcast" not in plan(found)[1] and [r["query"] for r in found.collect()] == ["rumah"]


def test_headwords_gather_no_line(large):
    words = spans(large, [("roman", " "), ("roman", " ab"), ("roman", ""), ("roman", "c de"), ("roman", "f")]).withColumn("raw_text", F.col("clean_text"))
    found = reviewed.repair_headwords(words, large.createDataFrame([("a", "abc d", ["v"])], "line_id string, headword string, variants array<string>"))
    assert "collect_list(clean_text" not in plan(found)[0]
    assert [r["clean_text"] for r in found.orderBy("span_ord").collect() if r["style"] == "bold"] == ["ab", "c d"]


def items(spark):
    rows = [(1, 0, "roman", "x ("), (1, 1, "label", "id"), (1, 2, "label", "en"), (1, 3, "roman", ") y"), (1, 4, "see", "z"), (1, 5, "see", " II "), (1, 6, "see", "4")]
    return spark.createDataFrame(rows, "form_id long, item_ord long, type string, value string")


def test_label_wrappers_look_back_only(large):
    found = render.strip_label_wrappers(items(large))
    assert "unboundedfollowing" not in plan(found)[0].lower()
    assert [r["value"] for r in found.orderBy("item_ord").collect()][:4] == ["x", "id", "en", "y"]


def test_reference_suffixes_move_once(large):
    found = render.collapse_reference_suffixes(items(large))
    assert plan(found)[1].count("Exchange hashpartitioning") == 1
    assert [r["value"] for r in found.orderBy("item_ord").collect()][4:] == ["z II 4"]


def test_labels_move_once(large):
    chain = [("italic", "A"), ("roman", "."), ("roman", " "), ("italic", "S"), ("roman", ". of "), ("italic", "B"), ("roman", "."), ("italic", "C"), ("roman", "x"), ("italic", "D"), ("roman", "."), ("italic", "E"), ("roman", ". ")]
    found = ev.protect_labels(ev.merge_initials(spans(large, chain)))
    assert plan(found)[1].count("Exchange hashpartitioning") == 1
    assert [r["clean_text"] for r in found.orderBy("span_ord").collect()] == ["A. S.", " of ", "B", ".", "C", "x", "D.E.", " "]


def test_aliases_gather_no_line(large):
    line = [("bold", "oco"), ("roman", " ("), ("bold", "mongo/"), ("roman", "ab/ prose"), ("bold", "later")]
    found = ev.header_aliases(ev.mark_zones(spans(large, line)))
    assert "collect_list" not in plan(found)[0] and [r["alias"] for r in found.collect()] == ["mongo"]


def above(text, node):
    """For each ``node`` of a plan the names of what stands above it, nearest first."""
    path = []
    for line in text.splitlines():
        at = re.search(r"\w", line.replace("+-", "  ").replace(":-", "  "))
        if at:
            path = [p for p in path if p[0] < at.start()] + [(at.start(), line[at.start() :])]
            if path[-1][1].startswith(node):
                yield [p[1] for p in path[-2::-1]]


@pytest.mark.parametrize("name", ["content_events", "label_protection", "leading_zone"])
def test_words_stay_where_they_are(large, tmp_path, name):
    texts = [(1, "ab c\nthe 12 end of it"), (2, None), (3, ""), (4, "x " * 9000)]
    large.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = getattr(span_plans, name)(large, str(tmp_path))
    paths = list(above(plan(found)[1], "Generate posexplode(split(line#"))
    moved = [next((p for p in path if "Exchange" in p or "Aggregate" in p), "") for path in paths]
    assert paths and not [m for m in moved if "Exchange" in m]  # only what is one row a line or a form moves
    assert {r["form_id"] for r in found.collect()} <= {1, 3, 4}


def test_facts_of_lines_reach_their_spans(large):
    rows = [(7, 0, "a", 0, "roman", "x-", 0.0, 1.0, False), (7, 1, "b", 0, "bold", "y.", 0.0, 1.0, False), (7, 1, "b", 1, "roman", "4", 1.5, 2.0, True), (7, 2, "c", 0, "roman", "z", 0.0, 1.0, False), (7, 4, "d", 0, "roman", "w", 0.0, 1.0, False)]
    acts = large.createDataFrame([(7, 0, "remove_hyphen"), (7, 3, "preserve_hyphen"), (8, 0, "remove_hyphen")], "form_id long, line_ord int, action string")
    lines = large.createDataFrame([("b",), ("b",), ("none",)], "line_id string")
    found = ev.content_events(large.createDataFrame(rows, SPANS), F.array(F.lit("K")), acts, lines).orderBy("ord").collect()
    # a line without spans (3) has no end that could be tight
    assert [(r["value"], r["boundary"]) for r in found] == [("x", ""), ("y.", ""), ("4", ev.JOINED), ("z", ""), ("w", " ")]


def test_headwords_find_words_where_they_are(large, tmp_path):
    texts = [(2, "ab cde f"), (4, None), (6, "ab\ncde"), (7, "x " * 9000)]
    large.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = normal.headword_repairs(large, str(tmp_path))
    paths = list(above(plan(found)[1], "Generate posexplode(w#"))
    moved = [next((p for p in path if "Exchange" in p or "Aggregate" in p), "") for path in paths]
    assert paths and not [m for m in moved if "Exchange" in m]
    assert {r["doc_id"]: r["bold"] for r in found.collect()} == {2: "ab cd", 6: "ab cd", 7: ""}
