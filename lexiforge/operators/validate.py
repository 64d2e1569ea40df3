"""Checks: each returns the offending rows, so an empty result means valid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.functions.text import href_query
from lexiforge.sources.scratch import cut

# Properties that the archive's schema allows in a style.
STYLE_PROPERTIES = (
    "fontStyle", "fontWeight", "fontSize", "color", "background", "backgroundColor", "textDecorationLine", "textDecorationStyle",
    "textDecorationColor", "borderColor", "borderStyle", "borderRadius", "borderWidth", "clipPath", "verticalAlign", "textAlign",
    "textEmphasis", "textShadow", "margin", "marginTop", "marginLeft", "marginRight", "marginBottom", "padding", "paddingTop",
    "paddingLeft", "paddingRight", "paddingBottom", "wordBreak", "whiteSpace", "cursor", "listStyleType",
)
TAGS = ("a", "span", "div", "ul", "li")
TERM_COLUMNS = ("expression", "reading", "definition_tags", "rules", "score", "glossary", "sequence", "term_tags")


def invalid_tokens(tokens: DataFrame) -> DataFrame:
    """(… tag, style map, href) rows with an unknown tag, property or target form."""
    bad = F.exists(F.map_keys(F.coalesce("style", F.create_map().cast("map<string,string>"))), lambda k: ~k.isin(*STYLE_PROPERTIES))
    tag = F.coalesce(~F.col("tag").isin(*TAGS), F.lit(False))
    href = F.coalesce(~F.col("href").rlike(r"^\?query=[^&]+&wildcards=off$"), F.lit(False))
    return tokens.filter(bad | tag | href | (F.col("href").isNotNull() & F.coalesce(F.col("tag") != "a", F.lit(True))))


#: Tags with the properties they may have, and style values that are enumerated.
PROPERTIES = {tag: ("tag", "content", "data", "style", "title", "lang") for tag in ("span", "div", "ul", "li")} | {"a": ("tag", "content", "href", "lang")}
STYLE_VALUES = {"fontStyle": ("normal", "italic"), "fontWeight": ("normal", "bold"), "wordBreak": ("normal", "break-all", "keep-all")}
DEEPEST = 200


def _parts(nodes: DataFrame, column: str, *kept: str) -> DataFrame:
    """The elements of lists and the fields of objects: pos, name (null in a list), item."""
    each = nodes.sparkSession.tvf.variant_explode(F.col(column).outer())
    return nodes.lateralJoin(each).select("_id", "path", *kept, "pos", F.col("key").alias("name"), F.col("value").alias("item"))


def invalid_nodes(rows: DataFrame, key: str, column: str, root: str = "$") -> DataFrame:
    """(key, path, problem) of all nodes of the JSON trees in ``column`` (of what stands at ``root``), however deep.

    Trees are variants taken apart level by level: a level's lists and contents are the next level's nodes, so no tree is
    walked in one row.  Text is valid anywhere; other scalars are not; what is no JSON is one problem; deeper than
    ``DEEPEST`` levels raises.
    """
    tree = F.try_parse_json(F.col(column))
    level = rows.select(F.col(key).alias("_id"), F.lit("content").alias("path"), F.try_variant_get(tree, root, "variant").alias("v"))
    problem = lambda found, text: found.select(F.col("_id").alias("key"), "path", text.alias("problem"))
    bad = [problem(level.filter(F.col("v").isNull()), F.lit("no JSON" if root == "$" else f"nothing at {root}"))]
    level = level.filter(F.col("v").isNotNull())
    for depth in range(DEEPEST + 1):
        level = cut(level.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)), "nodes")
        if level.isEmpty():
            break
        if depth == DEEPEST:
            raise ValueError(f"nodes are nested deeper than {DEEPEST} levels")
        bad.append(problem(level.filter(~F.col("kind").isin("STRING", "ARRAY", "OBJECT")), F.lit("a node is text, a list or an object")))
        lists = _parts(level.filter("kind = 'ARRAY'"), "v")
        inner = lists.select("_id", F.concat_ws("/", "path", F.col("pos").cast("string")).alias("path"), F.col("item").alias("v"))
        nodes = level.filter("kind = 'OBJECT'").withColumn("tag", F.try_variant_get("v", "$.tag", "string")).withColumn("href", F.try_variant_get("v", "$.href", "string"))
        known = F.coalesce(F.col("tag").isin(*PROPERTIES), F.lit(False))
        bad.append(problem(nodes.filter(~known), F.concat(F.lit("unknown tag "), F.coalesce("tag", F.lit("null")))))
        bad.append(problem(nodes.filter((F.col("tag") == "a") & ~F.coalesce(F.col("href").rlike(r"^(?:https?:|\?)"), F.lit(False))), F.concat(F.lit("invalid href "), F.coalesce("href", F.lit("null")))))
        fields = _parts(nodes.filter(known), "v", "tag")
        allowed = F.lit(False)
        for tag, names in PROPERTIES.items():
            allowed = allowed | ((F.col("tag") == tag) & F.col("name").isin(*names))
        bad.append(problem(fields.filter(~allowed), F.concat(F.lit("unknown property "), "name")))
        styles = fields.filter("name = 'style'").withColumn("kind", F.regexp_extract(F.schema_of_variant("item"), "^[A-Z]+", 0))
        bad.append(problem(styles.filter(~F.col("kind").isin("OBJECT", "VOID")), F.lit("style is no object")))
        values = _parts(styles.filter("kind = 'OBJECT'").withColumn("path", F.concat("path", F.lit("/style"))).select("_id", "path", F.col("item").alias("v")), "v")
        bad.append(problem(values.filter(~F.col("name").isin(*STYLE_PROPERTIES)), F.concat(F.lit("unknown style "), "name")))
        text = F.coalesce(F.try_variant_get("item", "$", "string"), F.lit("null"))
        for name, choice in STYLE_VALUES.items():
            wrong = values.filter((F.col("name") == name) & ~F.col("item").cast("string").isin(*choice))
            bad.append(problem(wrong, F.concat(F.lit(f"invalid {name} "), text)))
        contents = fields.filter("name = 'content'").select("_id", F.concat_ws("/", "path", F.lit("content")).alias("path"), F.col("item").alias("v"))
        level = inner.unionByName(contents)
    out = bad[0]
    for more in bad[1:]:
        out = out.unionByName(more)
    return out


def invalid_terms(terms: DataFrame) -> DataFrame:
    """Term rows with a missing expression, glossary or sequence."""
    if tuple(terms.columns) != TERM_COLUMNS:
        raise ValueError(f"term rows have the columns {TERM_COLUMNS}")
    ok = (F.col("expression") != "") & (F.col("sequence") >= 1) & F.col("glossary").rlike(r"(?s)^\[.+\]$") & F.col("reading").isNotNull()
    return terms.filter(~F.coalesce(ok, F.lit(False)))


#: A link as compact JSON and as HTML have it.
JSON_HREF = r"\"href\":\"((?:[^\"\\\\]|\\\\.)*)\""
HTML_HREF = r"href=\"([^\"]*)\""


def hrefs(texts: DataFrame, column: str, pattern: str = HTML_HREF) -> DataFrame:
    rest = [c for c in texts.columns if c != column]
    return texts.select(*rest, F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern))).alias("href"))


def dangling(links: DataFrame, expressions: DataFrame) -> DataFrame:
    """(query, n) of links (href) whose query is no expression: most first, then by name."""
    wanted = links.select(href_query(F.col("href")).alias("query"))
    lost = wanted.join(expressions.select(F.col("expression").alias("query")).distinct(), "query", "left_anti")
    return lost.groupBy("query").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "query")


def oversized(sizes: DataFrame, limit: int) -> DataFrame:
    return sizes.filter(F.col("n_bytes") >= limit)
