"""Spans to headers, events and marker text: behaviours on small invented pages."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lexiforge.operators import events as ev
from lexiforge.operators import rewrite
from lexiforge.plans import layer1
from lexiforge.sources import tables

SPANS = "form_id long, line_ord int, line_id string, span_ord int, style string, clean_text string, x0 double, x1 double, join_next boolean"


def spans(spark, *forms):
    """Forms as lists of lines of (style, text) or (style, text, x0, x1); a line ending in '+' goes on without a blank."""
    rows = []
    for f, lines in enumerate(forms):
        for j, line in enumerate(lines):
            tight = line[-1] == "+"
            for i, s in enumerate(x for x in line if x != "+"):
                rows.append((f, j, f"f{f}-l{j}", i, s[0], s[1], *(s[2:] or (0.0, 99.0)), tight))
    return spark.createDataFrame(rows, SPANS).repartition(3)


def parse(spark, forms, known=(), decisions=(), joined=()):
    marked = ev.mark_zones(spans(spark, *forms))
    heads = ev.parse_forms(marked)
    acts = spark.createDataFrame(list(decisions), "form_id long, line_ord int, action string")
    lines = spark.createDataFrame([(j,) for j in joined], "line_id string")
    codes = F.array(*[F.lit(k) for k in known]) if known else F.array().cast("array<string>")
    raw = ev.content_events(marked.filter("zone = 'rest'").drop("zone"), codes, acts, lines, heads)
    content = rewrite.rewrite_events(raw).orderBy("form_id", "ord").collect()
    found = [[(e["kind"], e["style"], e["value"]) for e in content if e["form_id"] == f] for f in range(len(forms))]
    return {h["form_id"]: h for h in heads.collect()}, found, content


def test_aliases_stay_in_the_line(spark):
    forms = [
        [[("bold", "mekarsi"), ("roman", " [and "), ("bold", "ngarsi "), ("roman", "("), ("italic", "J coq"), ("roman", ")] "), ("bold", "1"), ("roman", " to open "), ("bold", "later")]],
        [[("bold", "oco"), ("roman", " ("), ("italic", "Jv"), ("roman", ") "), ("bold", "mongoco"), ("roman", " prose "), ("bold", "not this")]],
        [[("bold", "Bajam I ("), ("roman", "rare) thing.")], [("roman", "more.")]],
        [[("roman", "no header here")]],
        [[("bold", "tempat"), ("roman", " "), ("bold", " II"), ("roman", "-"), ("bold", "air"), ("roman", " pond "), ("bold", "x")]],
    ]
    heads, found, _ = parse(spark, forms, ("J", "coq", "Jv"))
    assert (heads[0]["expression"], heads[0]["variants"]) == ("mekarsi", ["ngarsi"])
    assert [(k, v) for k, _, v in found[0]] == [("run", "[and"), ("run", "ngarsi"), ("run", "("), ("label", "J"), ("label", "coq"), ("run", ")]"), ("sense", "1"), ("run", "to open"), ("run", "later")]
    assert heads[1]["variants"] == ["mongoco"]
    assert (heads[2]["expression"], heads[2]["homograph"], heads[2]["inline_subentry"], heads[2]["opening"]) == ("Bajam", "I", None, "(")
    assert found[2] == [("run", "roman", "(rare) thing. more.")]
    assert (heads[3]["expression"], heads[3]["warning"]) == ("", "no leading bold expression")
    assert heads[4]["expression"] == "tempat II-air" and found[4] == [("run", "roman", "pond"), ("run", "bold", "x")]


def test_initials_and_operands_are_no_labels(spark):
    forms = [
        [[("bold", "dolara"), ("roman", " ("), ("italic", "E"), ("roman", ") money. – "), ("italic", "A"), ("roman", "."), ("italic", "S"), ("roman", ". of there")]],
        [[("bold", "runa"), ("roman", " base. – "), ("italic", "ling-")], [("italic", "kara"), ("roman", " setting.")]],
        [[("bold", "k"), ("roman", " "), ("italic", "A"), ("roman", "."), ("italic", "S"), ("roman", " no end")]],
        [[("bold", "k"), ("roman", " ~ ")], [("italic", "ling"), ("roman", " next "), ("italic", "ling")]],
    ]
    heads, found, _ = parse(spark, forms, ("A", "E", "S", "ling"), [(1, 0, "remove_hyphen")])
    assert ("label", None, "E") in found[0] and [v for k, s, v in found[0] if s == "italic"] == ["– A.S."]
    assert [v for k, s, v in found[1] if s == "italic"] == ["– lingkara"] and not any(k == "label" for k, _, _ in found[1])
    # a chain without its last period is not merged, but its parts are still guarded by the period between
    assert not any(k == "label" for k, _, _ in found[2]) and ("run", "italic", "A") in found[2]
    assert [v for k, _, v in found[3] if k == "label"] == ["ling"]


def test_boundaries(spark):
    forms = [[[("bold", "a"), ("roman", " one-"), "+"], [("roman", "two")], [("roman", "three "), ("italic", "x"), ("roman", "4")]], [[("bold", "b"), ("roman", "5", 0.0, 10.0), ("small_caps", "CAPS", 10.5, 20.0), ("symbol", "→", 20.1, 21.0)]]]
    _, found, raw = parse(spark, forms, joined=["f1-l0"])
    assert found[0] == [("run", "roman", "one-two three"), ("run", "italic", "x"), ("run", "roman", "4")]
    assert [e["boundary"] for e in raw if e["form_id"] == 1] == ["", ev.JOINED, ""]
    marks = layer1.markers_of_events(spark.createDataFrame(raw)).filter("form_id = 1").orderBy("ord")
    assert [(r["marker"], r["value"]) for r in marks.collect()] == [("Roman", "5"), ("NoSpace", ""), ("SmallCaps", "CAPS"), ("Symbol", "→")]


def test_unknown_style_raises(spark):
    with pytest.raises(Exception, match="unknown event"):
        layer1.markers_of_events(spark.createDataFrame([(1, 1, "run", "odd", "x", "")], "form_id long, ord long, kind string, style string, value string, boundary string")).collect()


def page(spark, lines):
    """Span rows of pages: (page, line, x of the line, [(font, text)], ...)."""
    rows = []
    for p, k, x, parts in lines:
        at = x
        for i, (font, text) in enumerate(parts):
            end = 246.0 if i == len(parts) - 1 and text.endswith("-") else at + 5.0 * len(text)
            rows.append((p, f"p{p:04d}-l{k:04d}", k, 0, 60.0 + 10 * k, x, i, font, None, at, 60.0 + 10 * k, end, 69.0 + 10 * k, text, text))
            at = end
    return spark.createDataFrame(rows, tables.SPANS)


B, I, R, S, Y = "Indrev-Bold", "Indrev-Italic", "Indrev-Roman", "Inresc-Roman", "SymbolMT"
PAGES = [
    (21, 0, 42.0, [(B, "abang I "), (B, "1"), (R, " elder brother. "), (B, "2"), (R, " term of re-")]),
    (21, 1, 54.0, [(R, "spect. respect "), (Y, "→"), (S, " UNAKO"), (R, ".")]),
    (21, 2, 48.0, [(B, "mengabang"), (R, " [and "), (B, "ngabang"), (R, "] ("), (I, "coq"), (R, ") to call so.")]),
    (21, 3, 42.0, [(B, "unako"), (R, " small. – "), (I, "coq"), (R, " a name.")]),
    (22, 0, 42.0, [(B, "za"), (R, "man time. "), (Y, "→"), (S, " NOWHERE")]),
    (30, 0, 54.0, [(R, "an orphan.")]),
]
GOLDEN = """[Entry] abang
[Homograph] I
[Sense] 1
[Roman] elder brother.
[Sense] 2
[Roman] term of respect. respect
[See] UNAKO
[Roman] .

[Subentry] mengabang
[Variant] ngabang
[Roman] [and
[Bold] ngabang
[Roman] ] (
[Label] coq
[Roman] ) to call so.

[Entry] unako
[Roman] small.
[Italic] – coq
[Roman] one name.

[Entry] zaman
[Variant] jaman
[Roman] time.
[See] NOWHERE"""


def written(spark, path):
    from pathlib import Path

    return "\n".join(p.read_text().rstrip("\n") for p in sorted(Path(path).glob("part-*")) if p.stat().st_size)


def test_pages_to_marker_text_to_archive(spark, tmp_path):
    from lexiforge import __main__ as cli

    page(spark, PAGES).write.parquet(str(tmp_path / "spans"))
    (tmp_path / "tags.csv").write_text("tag,tag_rename,type,color\ncoq,colloquial,x,red\n")
    (tmp_path / "heads.json").write_text(json.dumps({"line_id": "p0022-l0000", "headword": "zaman", "variants": ["jaman"]}) + "\n")
    (tmp_path / "rules.json").write_text(json.dumps({"run_values": [["a name", "one name"]]}))
    args = ["--headwords", str(tmp_path / "heads.json"), "--rules", str(tmp_path / "rules.json"), "--spans", str(tmp_path / "spans"), "--tag-map", str(tmp_path / "tags.csv"), "--pages", "21-22,30", "--intermediate-dir", str(tmp_path / "i"), "--archive-dir", str(tmp_path / "a"), "--name", "lex"]
    parsed = cli.parser().parse_args(["all", *args])
    summary = cli.run(spark, parsed)
    first, second = summary["layer1"], summary["layer2"]
    assert written(spark, tmp_path / "i/small/markers.txt") == GOLDEN
    assert first["entries"] == 3 and first["wraps"]["n_remove_hyphen"] == 1
    with zipfile.ZipFile(tmp_path / "a/lex.zip") as z:
        rows = [r for name in z.namelist() if name.startswith("term_bank") for r in json.loads(z.read(name))]
    assert {r[0] for r in rows} == {"abang", "mengabang", "ngabang", "unako", "zaman", "jaman"} and second["terms"] == len(rows)
    assert any("query=unako" in json.dumps(r) for r in rows if r[0] == "abang")
    report = json.loads((tmp_path / "a/lex-report.json").read_text())
    assert report["methods"] == {"exact": second["resolved"]} and report["unresolved_targets"] == 1
    lost = [json.loads(x) for p in (tmp_path / "a/lex-unresolved").glob("part-*") for x in p.read_text().splitlines()]
    assert [(r["target"], r["examples"]) for r in lost] == [("NOWHERE", ["zaman"])] and lost[0]["n"] == second["unresolved"]
    assert json.loads((tmp_path / "i/small/manifest.json").read_text())["markers"]["Entry"] == 3


def test_source_checks(spark, tmp_path):
    path = str(tmp_path / "spans")
    page(spark, PAGES).coalesce(1).write.parquet(path)
    pages = tables.page_selection(spark, "21-22", 100)
    pin = tables.source_hash(spark, path)
    assert tables.check_source(spark, path, pages, pin.upper()).count() > 20
    with pytest.raises(ValueError, match="expected the source"):
        tables.check_source(spark, path, pages, "0" * 64)
    with pytest.raises(ValueError, match="no span on the selected pages"):
        tables.check_source(spark, path, tables.page_selection(spark, "90", 100))
    spark.read.parquet(path).drop("x1").write.parquet(str(tmp_path / "less"))
    with pytest.raises(ValueError, match=r"missing columns \['x1'\]"):
        tables.check_source(spark, str(tmp_path / "less"), pages)


def test_sense_numbers_as_printed(spark):
    """Leading zeros stay, and no number is too long to be one."""
    _, found, _ = parse(spark, [[[("bold", "kata"), ("roman", " word "), ("bold", " 007 "), ("roman", " spy "), ("bold", "12345678901234567890123")]]])
    assert [v for k, _, v in found[0] if k == "sense"] == ["007", "12345678901234567890123"]
