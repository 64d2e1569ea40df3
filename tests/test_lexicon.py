import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lexiforge.operators import ingest, linewrap, pack, rewrite, sinks, validate
from lexiforge.operators.ordered import number_rows, running_sum
from lexiforge.plans.build import build
from lexiforge.sources import markers, tables

TEXT = """[Entry] batu
[Homograph] I
[Variant] bat(o)e
[Roman] stone
[Label] J/Jv
[Sense] 1
[Italic] ~ besar
[Roman] big stone
[Sense] 2
[See] KAYU 2, TIDAK ADA
[Subentry] membatu
[Roman] to harden (
[Label] J
[Roman] ) like –
[Italic] bata

[Entry] batu
[Homograph] II
[Roman] battery
[NoSpace]
[Symbol] -x

[Entry] kayu
[SeeBare] BATOE
[InlineSubentry] kayu-kayuan
[Roman] all kinds of wood
[Entry] çafé
"""


def flat(node):
    if isinstance(node, str):
        return node
    if isinstance(node, list):
        return "".join(map(flat, node))
    return flat(node.get("content", ""))


@pytest.fixture(scope="module")
def tags(spark):
    return spark.createDataFrame([("J", "Java", "#111111"), ("Jv", "Javanese", "#222222")], "tag string, tag_rename string, color string")


def test_archive_end_to_end(spark, tags, tmp_path):
    (tmp_path / "m.txt").write_text(TEXT)
    summary = build(spark, str(tmp_path / "m.txt"), tags, str(tmp_path / "a"), "mini", 6000)
    assert summary["resolved"] == 2 and summary["unresolved"] == 1 and summary["terms"] == 8
    with zipfile.ZipFile(tmp_path / "a/mini.zip") as z:
        assert z.namelist()[0] == "index.json" and all(len(z.read(n)) < 6000 for n in z.namelist())
        rows = [r for n in z.namelist()[1:] for r in json.loads(z.read(n))]
    assert [len(r) for r in rows] == [8] * 8 and [(r[0], r[1]) for r in rows][:3] == [("batu", ""), ("bate", ""), ("batoe", "")]
    lines = [flat(x) for x in rows[0][5][0]["content"]]
    assert lines[:4] == ["batu I stone Java Javanese", "1.batu besar big stone", "2.→ KAYU 2, TIDAK ADA", "batu II battery-x"]
    harden = next(r for r in rows if r[0] == "membatu")
    assert flat(harden[5][0]["content"][0]) == "membatu to harden Java like batu bata"
    again = build(spark, str(tmp_path / "m.txt"), tags, str(tmp_path / "b"), "mini", 6000)
    assert again == summary and (tmp_path / "a/mini.zip").read_bytes() == (tmp_path / "b/mini.zip").read_bytes()


def test_marker_errors(spark):
    lines = spark.createDataFrame([(1, "[Roman] a"), (2, "[Entry] x"), (3, "[Sense] y"), (4, "[Odd] z"), (5, "no marker"), (6, "  "), (7, "[Definition 2] d")], "line_no long, line string")
    found = markers.marker_errors(markers.markers_of(lines)).orderBy("line_no").collect()
    assert [r["line_no"] for r in found] == [1, 3, 4, 5]
    written = markers.write_lines(markers.markers_of(lines.filter("line_no < 3"))).orderBy("line_no").collect()
    assert [r["line"] for r in written] == ["[Roman] a", "[Entry] x"]


def test_ordered(spark):
    df = spark.range(1, 500).select(F.col("id").alias("i"), (F.col("id") % 7 == 0).alias("s"))
    out = running_sum(df, "i", F.col("s"), "n", chunk=64).collect()
    assert all(r["n"] == r["i"] // 7 for r in out) and len(out) == 499
    shuffled = spark.range(300).select((300 - F.col("id")).alias("v"))
    assert all(r["k"] == r["v"] for r in number_rows(shuffled, ["v"], "k").collect())


def test_pages_and_resolutions(spark, tmp_path):
    assert [r["page"] for r in tables.page_selection(spark, "3-5,1,4,99", 9).collect()] == [1, 3, 4, 5]
    with pytest.raises(ValueError):
        tables.page_selection(spark, "99", 9)
    head = ",".join(tables.RESOLUTION_COLUMNS)
    (tmp_path / "ok.csv").write_text(f"﻿{head}\na|b|le|ft,a,b,le,ft,left,le-ft,remove_hyphen,Approved\nc|d|x|y,c,d,x,y,xy,x-y,remove_hyphen,open\n")
    assert tables.read_resolutions(spark, str(tmp_path / "ok.csv")).count() == 1
    (tmp_path / "bad.csv").write_text(f"{head}\na|b|le|ft,a,b,le,zz,left,le-ft,eat,approved\n")
    with pytest.raises(ValueError, match="key does not match"):
        tables.read_resolutions(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "t.csv").write_text("﻿tag,tag_rename,type,color\nsg,one,x,#1\nSg,two,x,#2\nsg,three,x,#3\n")
    assert {r["tag"]: r["tag_rename"] for r in tables.read_tag_map(spark, str(tmp_path / "t.csv")).collect()} == {"sg": "three", "Sg": "two"}


def test_segments(spark):
    rows = [(1, 10, "continuation"), (2, 10, "root_entry_start"), (3, 10, "subentry_start"), (4, 11, "continuation"), (5, 11, "running_footer"), (6, 11, "root_entry_start"), (7, 20, "subentry_start"), (8, 20, "root_entry_start")]
    lines = spark.createDataFrame(rows, "pos long, page int, line_class string")
    got = ingest.segment(lines, spark.createDataFrame([(10,), (11,), (20,)], "page int")).orderBy("pos").collect()
    assert [r["entry_id"] for r in got] == [1, 2, 2, 2, 3, 4, 5]
    assert [r["entry_type"] for r in got] == ["orphan_fragment"] + ["root"] * 4 + ["orphan_fragment", "root"]
    assert [r["form_type"] for r in got] == ["orphan", "root", "subentry", "subentry", "root", "orphan", "root"]
    assert [r["partial_end"] for r in got] == [False, False, False, False, True, False, True]


def test_line_wraps(spark):
    cols = "form_id long, line_ord int, line_id string, page int, col int, last_text string, last_style string, last_x1 double, first_text string, first_style string, first_x0 double"
    base = lambda o, last, first, page=1: (1, o, f"l{o}", page, 0, last, "roman", 246.0, first, "roman", 54.0)
    lines = spark.createDataFrame([base(0, "so run-", "x"), base(1, "well ki-", "ning on"), base(2, "odd qu-", "ta"), base(3, "far zz-", "ux"), base(4, "end", "yy", 2)], cols)
    words, hyphenated = linewrap.word_evidence(spark.createDataFrame([("running ki-ta",)], "text string"))
    res = spark.createDataFrame([("l2|l3|qu|ux", "quux", "qu-ux", "leave_unchanged")], "resolution_key string, joined_candidate string, hyphenated_candidate string, approved_resolution string")
    got = linewrap.decide(linewrap.candidates(lines), words, hyphenated, res)
    assert {r["joined_candidate"]: r["action"] for r in got.collect()} == {"running": "remove_hyphen", "kita": "preserve_hyphen", "quux": "leave_unchanged"}
    row = linewrap.audit(got, linewrap.unmatched(res, got)).first()
    assert (row["n_candidates"], row["n_applied"], row["n_unmatched"]) == (3, 2, 0)


def events(spark, *rows):
    return spark.createDataFrame([(1, i, k, s, v, "") for i, (k, s, v) in enumerate(rows)], "form_id long, ord long, kind string, style string, value string, boundary string")


def values(df):
    return [(r["kind"], r["style"], r["value"]) for r in df.orderBy("ord").collect()]


def test_arrow_references(spark):
    e = events(spark, ("arrow", None, "→"), ("run", "small_caps", "KAYU"), ("sense", None, "2"), ("run", "roman", ". more"), ("arrow", None, "→"), ("run", "italic", "under "), ("run", "small_caps", "BATU"), ("arrow", None, "→"), ("run", "roman", "no. "), ("run", "small_caps", "X"))
    assert values(rewrite.arrow_references(e)) == [
        ("see", None, "KAYU 2"), ("run", "roman", ". more"), ("run", "symbol", "→"), ("run", "italic", "under "), ("see_bare", None, "BATU"),
        ("run", "symbol", "→"), ("run", "roman", "no. "), ("run", "small_caps", "X"),
    ]


def test_sense_passes(spark):
    e = events(spark, ("run", "roman", "of"), ("run", "small_caps", "KAYU"), ("sense", None, "2"), ("run", "roman", ". end"), ("sense", None, "3"), ("run", "roman", ". text"), ("sense", None, "4"), ("run", "roman", ".."))
    out = rewrite.strip_sense_delimiters(rewrite.demote_reference_senses(e))
    assert values(out)[2] == ("run", "bold", "2") and values(out)[5] == ("run", "roman", "text") and values(out)[7] == ("run", "roman", "..")


def test_operator_passes(spark):
    e = events(spark, ("run", "roman", "see ~ ("), ("run", "italic", "so) far"), ("run", "roman", "–"), ("run", "italic", "kata"), ("run", "roman", "~ after ~"))
    split = values(rewrite.split_parenthesized_operators(e))
    assert split[:3] == [("run", "roman", "see"), ("run", "italic", "~"), ("run", "roman", "(")]
    assert values(rewrite.attach_operators(e)) == [("run", "roman", "see ~ ("), ("run", "italic", "so) far"), ("run", "italic", "– kata ~"), ("run", "roman", "after ~")]
    plain = events(spark, ("run", "roman", "~ (x)"), ("run", "bold", "y"))
    assert values(rewrite.split_parenthesized_operators(plain)) == values(plain)


def test_coalesce(spark):
    e = spark.createDataFrame([(1, 0, "run", "roman", "a", ""), (1, 1, "run", "roman", "b", " "), (1, 2, "run", "italic", " ", ""), (1, 3, "label", None, "J", "")], "form_id long, ord long, kind string, style string, value string, boundary string")
    assert values(rewrite.coalesce_runs(e)) == [("run", "roman", "a b"), ("label", None, "J")]


def lines_of(spark, *rows):
    return spark.createDataFrame([(1, i, m, v) for i, (m, v) in enumerate(rows)], "form_id long, ord long, marker string, value string")


def shown(df):
    return [(r["marker"], r["value"]) for r in df.orderBy("ord").collect()]


def test_sense_boundaries(spark):
    rows = [("Sense", "1"), ("Bold", "inline"), ("Sense", "1"), ("Sense", "2"), ("Sense", "3"), ("Sense", "2"), ("Roman", "x"), ("Sense", "5")]
    assert shown(rewrite.sense_boundaries(lines_of(spark, *rows))) == [("Sense", "1"), ("Bold", "inline"), ("Bold", "1"), ("Bold", "2"), ("Bold", "3"), ("Sense", "2"), ("Roman", "x"), ("Sense", "3")]
    once = rewrite.sense_boundaries(lines_of(spark, ("Sense", "1"), ("Sense", "1"), ("Sense", "4"), ("Sense", "2")))
    assert shown(once) == [("Sense", "1"), ("Sense", "2"), ("Bold", "2")] or shown(once) == [("Sense", "1"), ("Sense", "2")]
    assert shown(rewrite.sense_boundaries(once)) == shown(once)


def test_embedded_and_sequences(spark):
    got = rewrite.promote_embedded_senses(lines_of(spark, ("Bold", "kata 1"), ("Roman", "in 1999"), ("Roman", "(2 two"), ("Sense", "3")))
    assert shown(got) == [("Bold", "kata 1"), ("Roman", "in 1999"), ("Roman", "("), ("Sense", "2"), ("Roman", "two"), ("Sense", "3")]
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate("aababb")], "form_id long, ord long, line string")
    out = rewrite.replace_sequences(lines, [(("a", "b"), ("c",)), (("c", "c"), ("d",))])
    assert [r["line"] for r in out.orderBy("ord").collect()] == ["a", "d", "b"]


def test_packing(spark):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate([10, 10, 50, 40, 3])], "i long, n long")
    got = pack.pack(rows, "i", "n", 60).orderBy("i").collect()
    assert [r["bank"] for r in got] == [1, 1, 2, 3, 3]
    assert validate.oversized(pack.bank_sizes(pack.pack(rows, "i", "n", 60), "n"), 60).count() == 0
    with pytest.raises(Exception, match="exceeds the component limit"):
        pack.pack(rows, "i", "n", 50).collect()


def test_validation(spark):
    tokens = spark.createDataFrame([("a", {"color": "x"}, "?query=x&wildcards=off"), ("b", None, None), ("span", {"fontVariant": "y"}, None), ("a", None, "http://x"), (None, None, None)], "tag string, style map<string,string>, href string")
    assert validate.invalid_tokens(tokens).count() == 3
    links = spark.createDataFrame([("?query=a%20b&wildcards=off",), ("?query=c&wildcards=off",)], "href string")
    lost = validate.dangling(links, spark.createDataFrame([("a b",)], "expression string")).collect()
    assert [(r["query"], r["n"]) for r in lost] == [("c", 1)]


def test_hash(spark):
    df = spark.createDataFrame([("a\r\nb", "a\nb")], "x string, y string")
    r = df.select(sinks.content_hash(F.col("x"), True), sinks.content_hash(F.col("y"))).first()
    assert r[0] == r[1]


def test_first_sense_is_supplied(spark):
    rows = [("Entry", "e"), ("Variant", "v"), ("Homograph", "II"), ("Roman", "x"), ("Sense", "2"), ("Sense", "3")]
    once = rewrite.sense_boundaries(lines_of(spark, *rows))
    assert shown(once) == [*rows[:3], ("Sense", "1"), *rows[3:]]
    assert shown(rewrite.sense_boundaries(once)) == shown(once)


def test_archive_is_read_back(tmp_path):
    import zipfile

    import pytest

    from lexiforge.operators import sinks

    def archive(text):
        with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
            z.writestr("index.json", "{}")
            z.writestr("term_bank_1.json", text)
        return str(tmp_path / "a.zip")

    row = '["a","","","",0,["x"],1,""]'
    assert sinks.check_archive(archive(f"[{row},{row}]"), 1000) == 2
    for bad, limit in (('[["a"]]', 1000), (f"[{row}]", 10), ('{"a":1}', 1000), ("[", 1000)):
        with pytest.raises(ValueError):
            sinks.check_archive(archive(bad), limit)


def test_links_of_json(spark):
    from lexiforge.operators import validate

    rows = spark.createDataFrame([('[{"tag":"a","href":"?query=b%20c&wildcards=off"},{"href":"?query=d&wildcards=off"}]',)], "g string")
    links = validate.hrefs(rows, "g", validate.JSON_HREF)
    assert links.count() == 2
    assert [r["query"] for r in validate.dangling(links, spark.createDataFrame([("d",)], "expression string")).collect()] == ["b c"]
