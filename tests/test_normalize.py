"""The normalisation of marker text: its passes, rules that cross forms, and twice equals once."""

import pytest

from lexiforge.operators import normalize as no
from lexiforge.sources.markers import markers_of

TEXT = """[Entry] alpha
[Variant] al
[Variant] pha
[Roman] dry .. done )
[Entry] bekal (
[Label] A
[Roman] ) thing.
[Entry] Super
[Sense] 98
[Sense] 1
[Roman] first.
[Sense] 2
[Roman] second.
[Entry] rumah XII3
[Variant] roemah
[Roman] house.
[Subentry] 4 = kamar
[Roman] room.
[Subentry] dalam 2 = isi
[Roman] inside.
[Entry] kota
[Roman] city
[Subentry] kotak
[Roman] box: 1 wood 2 paper
[Entry] implicit
[Roman] ) 1 first.
[Sense] 2
[Roman] second.
[Entry] link
[See] LALU- LANG.
[Italic] Bintang R
[BoldItalic] e
[Roman] end"""

WANT = """[Entry] alpha
[Variant] al pha
[Roman] dry . done)
[Entry] bekal
[Roman] (
[Label] A
[Roman] ) thing.
[Entry] Super 98
[Sense] 1
[Roman] first.
[Sense] 2
[Roman] second.
[Entry] rumah
[Variant] roemah
[Homograph] XII
[Sense] 1
[Sense] 3
[Roman] house.
[Sense] 4
[Bold] = kamar
[Roman] room.
[Subentry] dalam
[Sense] 1
[Sense] 2
[Bold] = isi
[Roman] inside.
[Entry] kota
[Roman] city and
[Subentry] kotak besar
[Roman] box:
[Sense] 1
[Roman] wood
[Sense] 2
[Roman] paper
[Entry] implicit
[Roman] )
[Sense] 1
[Roman] first.
[Sense] 2
[Roman] second.
[Entry] link
[See] LALU-LANG.
[Italic] Bintang Re
[Roman] end"""


def lines(spark, text):
    return markers_of(spark.createDataFrame(list(enumerate(text.splitlines(), 1)), "line_no long, line string"))


def text(df):
    return [f"[{r['marker']}] {r['value']}".rstrip() for r in df.orderBy("line_no").collect()]


@pytest.fixture(scope="module")
def rules(spark):
    return no.Rules(
        sequences=[(("[Roman] city", "[Subentry] kotak"), ("[Roman] city and", "[Subentry] kotak besar"))],  # over the border of two forms
        run_values=[("none", "nothing")],
        reference_values=[("LALU- ", "LALU-")],
        variant_repairs=spark.createDataFrame([("alpha", ["al", "pha"], ["al pha"])], "expression string, replaced array<string>, replacements array<string>"),
        false_variants=("/",),
        inline_subentries=spark.createDataFrame([], "root string, value string"),
        merged_runs=spark.createDataFrame([("link", ["[Italic] Bintang R", "[BoldItalic] e"], ["[Italic] Bintang Re"])], "expression string, source array<string>, target array<string>"),
        roman_senses=spark.createDataFrame([("kotak besar", None, [1, 2])], "expression string, homograph string, numbers array<int>"),
        numbered_heads=(("Super", 98),),
    )


def test_all_passes_and_twice(spark, rules):
    once = no.normalize(lines(spark, TEXT), rules)
    got = text(once)
    assert [x for x in got if not x.startswith("[Sense]")] == [x for x in WANT.splitlines() if not x.startswith("[Sense]")]
    assert text(no.normalize(once, rules)) == got
    assert no.normalize(lines(spark, TEXT).filter("false"), rules).count() == 0


def plain(rows, table):
    for source, target in table:
        i = 0
        while i <= len(rows) - len(source):
            if tuple(rows[i : i + len(source)]) == source:
                rows[i : i + len(source)] = target
                i += len(target)
            else:
                i += 1
    return rows


def test_sequences_like_one_list(spark):
    import random

    r = random.Random(3)
    names = [f"[Roman] {c}" for c in "abcx"] + ["[Entry] e"]
    rows = [r.choice(names) for _ in range(400)]
    table = [(("[Roman] a", "[Roman] a"), ("[Roman] b",)), (("[Roman] b", "[Entry] e", "[Roman] c"), ("[Roman] c", "[Entry] e")), (("[Roman] c", "[Roman] c"), ())]
    assert text(no.rewrite_sequences(lines(spark, "\n".join(rows)), table)) == plain(list(rows), table)


def test_equation_without_a_form_raises(spark):
    with pytest.raises(Exception, match="without a form"):
        no.repair_heads(lines(spark, "[Entry] 4 = x\n[Roman] y")).collect()


def test_headwords_need_their_evidence(spark):
    from lexiforge.operators import reviewed

    spans = spark.createDataFrame(
        [("a", 0, "roman", " ab", " ab", 0.0, 30.0), ("a", 1, "italic", "cd rest", "cd rest", 30.0, 100.0), ("b", 0, "bold", "whole", "x", 0.0, 9.0), ("c", 0, "roman", "", None, 0.0, 1.0)],
        "line_id string, span_ord int, style string, clean_text string, raw_text string, x0 double, x1 double",
    )
    shape = "line_id string, headword string, variants array<string>"
    found = reviewed.repair_headwords(spans, spark.createDataFrame([("a", "abcd", ["x"])], shape)).orderBy("line_id", "span_ord").collect()
    assert [(r["style"], r["clean_text"], r["raw_text"], r["x0"], r["x1"]) for r in found] == [
        ("roman", " ", " ", 0.0, 10.0), ("bold", "ab", "ab", 10.0, 30.0), ("bold", "cd", "cd", 30.0, 50.0), ("italic", " rest", " rest", 50.0, 100.0), ("bold", "whole", "x", 0.0, 9.0), ("roman", "", None, 0.0, 1.0),
    ]
    assert [r["reviewed_variants"] for r in found] == [["x"]] * 4 + [None] * 2
    with pytest.raises(Exception, match="headword evidence changed for a: expected abx, got abc"):
        reviewed.repair_headwords(spans, spark.createDataFrame([("a", "abx", None)], shape)).collect()
    with pytest.raises(Exception, match="two headwords for a"):
        reviewed.repair_headwords(spans, spark.createDataFrame([("a", "ab", None), ("a", "abcd", None)], shape)).collect()


def test_nodes_at_any_depth(spark):
    import json

    from lexiforge.operators import validate

    deep = "text"
    for _ in range(9):
        deep = {"tag": "div", "content": [deep]}
    bad = {"tag": "ul", "content": {"tag": "li", "style": {"wordBreak": "often", "color": "red"}, "content": [{"tag": "p"}, 3]}}
    rows = spark.createDataFrame([(1, json.dumps(["x", deep])), (2, json.dumps([bad])), (3, "["), (4, None), (5, '"text"'), (6, '{"tag":"a","href":"https://x","style":{}}')], "id long, tree string")
    got = {tuple(r) for r in validate.invalid_nodes(rows, "id", "tree").collect()}
    assert got == {
        (2, "content/0/content/style", "invalid wordBreak often"), (2, "content/0/content/content/0", "unknown tag p"), (2, "content/0/content/content/1", "a node is text, a list or an object"),
        (3, "content", "no JSON"), (4, "content", "no JSON"), (6, "content", "unknown property style"),
    }


def test_rules_from_json(spark, tmp_path):
    import json

    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"sequences": [[["[Roman] a"], ["[Roman] b"]]], "false_variants": ["/"], "merged_runs": [["x", ["[Bold] A"], ["[Bold] B"]]], "numbered_heads": [["Super", 98]]}))
    rules = no.read_rules(spark, str(path))
    assert text(no.normalize(lines(spark, "[Entry] x\n[Variant] /\n[Roman] a\n[Bold] A\n[Bold] A"), rules)) == ["[Entry] x", "[Roman] b", "[Bold] B", "[Bold] A"]
    path.write_text('{"odd": []}')
    with pytest.raises(ValueError, match="unknown tables"):
        no.read_rules(spark, str(path))


def test_repeated_rules_do_not_repeat_lines(spark):
    rules = no.Rules(
        variant_repairs=spark.createDataFrame([("x", ["a"], ["c"]), ("x", ["a"], ["b"]), ("x", ["a"], ["b"])], "expression string, replaced array<string>, replacements array<string>"),
        merged_runs=spark.createDataFrame([("x", ["[Bold] A"], ["[Bold] C"]), ("x", ["[Bold] A"], ["[Bold] B"])], "expression string, source array<string>, target array<string>"),
        roman_senses=spark.createDataFrame([("x", None, [1]), ("x", None, [1])], "expression string, homograph string, numbers array<int>"),
    )
    assert text(no.normalize(lines(spark, "[Entry] x\n[Variant] a\n[Bold] A\n[Roman] 1 one"), rules)) == ["[Entry] x", "[Variant] b", "[Bold] B", "[Sense] 1", "[Roman] one"]
