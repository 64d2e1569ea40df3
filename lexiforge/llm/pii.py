"""Personal data: fixed forms plus bootstrapped contextual extraction, natively.

The base finds e-mail addresses, IP addresses, card and phone numbers.  The
method goes on from these seeds: all tokens of all texts, with the separators
inside them, are the instances of a graph whose other nodes are lexical patterns
(shape, left and right context, and pairs of these).  Tokens that a base span
overlaps are seeds, and so are identifier-like values assigned to a key of
``SEED_KEYS``.  Patterns are scored by the instances they extract and instances by
the patterns that extract them, in a few rounds of grouped aggregation.  A token
where a confident pattern extracts it becomes a span of kind ``id``; so does an
identifier-like value, if extracted once, wherever it stands.

A pattern below ``min_support * min_confidence`` scored instances can't become
confident, nor one with far more instances than scored ones.  A sketch of distinct
instances tells most of these before any are shuffled, from one text in
``BOUND_TEXTS`` (by hash): what is too many there is too many in all; the others are
counted in full.  A pass over the texts only gathers
instances of the other patterns, and passes after the first are made only if a
round scored new instances (dropped patterns are then tried again).  Everything
is a built-in expression.

Edge cases: a null text is empty; rows without an id are treated as one more id; matches of different kinds may overlap and are
all reported; repeated rows of one document get the same spans; a text with
megabytes of one run of characters is scanned once (no quantifier can backtrack
over a run twice); an empty table gives an empty result; extra columns are
ignored by :func:`find` and pass through :func:`redact`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_names, let, materialize

#: A match begins where its run begins, or where the match before ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: ASCII letters and digits and all that is not ASCII; one negated class of single characters is the fastest.
_WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]++"
#: Numbers that begin with + or in brackets, groups of digits, and words with what joins them.
_TOKEN = rf"(?:\+[0-9]++|\([0-9]++\))(?:[\x20().-]{{1,2}}[0-9]++)*+|[0-9]{{2,}}+(?:\x20[0-9]{{2,}}+){{2,}}+(?![A-Za-z])|{_WORD}(?:[._@+/%~-]++{_WORD})*+"
#: Eight letters, digits or joining characters with four digits or more.
_IDENTIFIER = r"^(?=.{8})(?:[^0-9]*+[0-9]){4}"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone", "id")
#: Rows of (pattern, number) that a broadcast may have.
BROADCAST_ROWS = 1_000_000
#: One text in so many bounds a pattern's instances from below, which drops most hopeless ones; no result depends on it.
BOUND_TEXTS = 8
_SPANS = "array<struct<s:int,e:int,m:string>>"
#: Keys whose assigned identifier-like value seeds the bootstrapping besides the base spans.
SEED_KEYS = ("password", "passwd", "pwd", "token", "secret", "api_key", "api-key", "apikey", "access_token", "auth_token", "secret_key", "access_key", "client_secret", "private_key")
_KEYS = "(?i)(?:" + "|".join(SEED_KEYS) + r")[\x22']?\s*+[=:]"
#: Parts of the keys, for a quick look before that pattern is tried.
_KEY_PARTS = ("passw", "pwd", "token", "secret", "key")
_ASSIGNS = r"^[\x22']?\s*[=:]\s*[\x22']?$"


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of an array, by doubling: no array is rebuilt for each element."""

    def double(acc: Column, k: Column) -> Column:
        d = F.call_function("shiftleft", F.lit(1), k.cast("int"))
        before = F.concat(F.array_repeat(F.lit(0), d), F.slice(acc, F.lit(1), F.size(acc) - d))
        return F.zip_with(acc, before, join)

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int") - 1)
    return F.when(F.size(values) > 1, F.aggregate(rounds, values, double)).otherwise(values)


def _matches(text: Column, pattern: str) -> Column:
    """Start, end and string of every match."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def place(z: Column) -> Column:
        ends = _running(F.transform(z, lambda x: F.length(x["g"]) + F.coalesce(F.length(x["m"]), F.lit(0))), lambda x, y: x + y)
        each = F.zip_with(ends, z, lambda e, x: F.struct((e - F.length(x["m"])).alias("s"), e.alias("e"), x["m"].alias("m")))
        return F.filter(each, lambda x: x["m"].isNotNull())

    return let(zipped, place).cast(_SPANS)


def _luhn(digits: Column) -> Column:
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        d = F.ascii(c) - 48
        doubled = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return F.struct((acc["i"] + 1).alias("i"), (acc["sum"] + F.when(acc["i"] % 2 == 1, doubled).otherwise(d)).alias("sum"))

    return F.aggregate(F.split(F.reverse(digits), ""), zero, step, lambda acc: acc["sum"] % 10 == 0)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """The base matches of a text, ordered: array of struct(s, k, e), k the kind's index."""
    none = F.array().cast(_SPANS)
    digit = text.rlike("[0-9]")
    raw = {
        "email": F.when(text.contains("@"), _matches(text, _EMAIL)).otherwise(none),
        "ip": F.when(digit & text.rlike(r"[0-9]\.[0-9]"), F.filter(_matches(text, _IP), lambda x: x["m"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))).otherwise(none),
        "card": F.when(
            digit,
            F.filter(_matches(text, _CARD), lambda x: F.length(_digits(x["m"])).between(12, 19) & _luhn(_digits(x["m"]))),
        ).otherwise(none),
        "phone": F.when(text.contains("+") & digit, F.filter(_matches(text, _PHONE), lambda x: F.length(_digits(x["m"])).between(9, 15))).otherwise(none),
    }

    def tagged(spans: Column, k: int) -> Column:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))

    return F.sort_array(F.concat(*[tagged(spans, k) for k, spans in enumerate(raw.values())]))


def _shape(value: Column) -> Column:
    size = F.length(value).cast("string")
    return (
        F.when(value.rlike("^[a-z]+$"), F.lit("a"))
        .when(value.rlike("^[0-9]+$"), F.concat(F.lit("digits"), size))
        .when((F.length(value) >= 16) & value.rlike("^[0-9a-f]+$"), F.lit("hex"))
        .when((F.length(value) >= 16) & value.rlike("^[0-9A-F]+$"), F.lit("HEX"))
        .otherwise(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[a-z]+", "a"), "[A-Z]+", "A"))
    )


def _tokens(texts: DataFrame) -> DataFrame:
    """All tokens of (doc_id, _key, _t): place, value, its hash ``v``, what stands around it."""
    marked = F.regexp_replace(F.replace("_t", F.lit("\x00"), F.lit("\x01")), F.lit(_TOKEN), F.lit("\x00$0\x00"))
    parts = texts.select("doc_id", "_key", F.split(marked, "\x00", -1).alias("w"))  # gap, token, gap, ..., gap
    before = lambda n: F.concat(F.array_repeat(F.lit(""), n), "w")
    after = lambda n: F.slice("w", F.lit(n + 1), F.size("w"))
    zipped = F.arrays_zip(F.col("w").alias("value"), before(1).alias("before"), before(2).alias("prev"), after(1).alias("after"), after(2).alias("next"))
    rows = parts.select("doc_id", "_key", F.posexplode(zipped).alias("at", "x")).filter("at % 2 = 1 and x.value is not null").select("doc_id", "_key", "at", "x.*")
    return rows.withColumn("v", F.xxhash64("value"))


def _small(keys: DataFrame) -> DataFrame:
    """``keys`` to be broadcast up to ``BROADCAST_ROWS`` (of two longs); beyond that the join shuffles."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _of_value(v: Column) -> Column:
    return F.xxhash64(F.lit("value"), v)


def _with_patterns(tokens: DataFrame, *keep: str, values: bool = False) -> DataFrame:
    """A row for each pattern (its hash ``p``) of each token; with ``values`` an identifier-like token is one more."""
    left = F.xxhash64(F.lower("prev"), "before")
    right = F.xxhash64("after", F.lower(F.coalesce("next", F.lit(""))))
    own = [F.when(F.col("value").rlike(_IDENTIFIER), _of_value(F.col("v"))).alias("_v")] if values else []
    t = tokens.select(*keep, left.alias("_l"), right.alias("_r"), F.xxhash64(_shape(F.col("value"))).alias("_s"), *own)
    kinds = [("_s",), ("_l",), ("_r",), ("_l", "_s"), ("_s", "_r"), ("_l", "_r")]
    keys = [F.xxhash64(F.lit(k), *cols) for k, cols in enumerate(kinds)] + [F.col("_v")] * values
    return t.select(*keep, F.explode(F.array(*keys)).alias("p"))


def _placed(texts: DataFrame) -> DataFrame:
    """Tokens with ``s`` and ``e``; for the few texts where places matter."""
    once = texts.dropDuplicates(["doc_id", "_key"])
    end = F.sum(F.length("before") + F.length("value")).over(Window.partitionBy("doc_id", "_key").orderBy("at"))
    return _tokens(once).withColumn("e", end.cast("int")).withColumn("s", F.col("e") - F.length("value"))


def _covered(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """``tokens`` with ``covered``: whether one of ``spans`` (doc_id, _key, s, e) of the text overlaps them; one sorted pass."""
    both = tokens.withColumn("_b", F.lit(False)).unionByName(spans.withColumn("_b", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy("doc_id", "_key").rowsBetween(Window.unboundedPreceding, 0)  # both ways: a frame that ends unbounded is quadratic
    reach = F.max(F.when(F.col("_b"), F.col("e"))).over(w.orderBy("s", F.desc("_b")))
    ahead = F.min(F.when(F.col("_b"), F.col("s"))).over(w.orderBy(F.desc("s"), F.desc("_b")))
    marked = both.withColumn("covered", F.coalesce(reach > F.col("s"), F.lit(False)) | F.coalesce(ahead < F.col("e"), F.lit(False)))
    return marked.filter(~F.col("_b")).drop("_b")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: key, base spans, and the text where it may hold seeds."""
    found = _texts(docs, id_col, text_col).select("doc_id", "_key", "_t", base_spans(F.col("_t")).alias("base"))
    lower = F.lower("_t")
    keyed = reduce(or_, [lower.contains(k) for k in _KEY_PARTS]) & F.col("_t").rlike(_KEYS)
    return found.select("doc_id", "_key", "base", F.when((F.size("base") > 0) | keyed, F.col("_t")).alias("_t"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_key"), text.alias("_t"))


def _same(rows: DataFrame, texts: DataFrame, *more: str) -> DataFrame:
    """The rows of ``texts`` whose doc_id, _key (and ``more``) are in ``rows``."""
    rows = _small(rows.select(F.col("doc_id").alias("_i"), F.col("_key").alias("_k"), *[F.col(c).alias(f"_{c}_") for c in more]))
    on = F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k"))
    for c in more:
        on = on & (F.col(c) == F.col(f"_{c}_"))
    return texts.join(rows, on, "left_semi")


def _hopeful(min_confidence: float) -> Column:
    return F.col("all") <= 2 * F.col("n") / min_confidence


def bootstrap(texts: DataFrame, seeds: DataFrame, rounds: int = 3, min_support: int = 5, min_confidence: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (p) and scored values (v), from seeds (p, v).

    Each round: a pattern's confidence is the mean score of its distinct
    instances, damped for few of them, and an instance's score the largest
    confidence of its patterns; seeds keep score 1.
    """
    links, edges, sizes, known, fresh = seeds, None, None, None, None
    given = materialize(seeds.select("v").distinct().withColumn("score", F.lit(1.0)), "pii-seeds")
    scores = given
    for i in range(rounds):
        if i:
            fresh = scores.join(known, "v", "left_anti").select("v")
            fresh = fresh if fresh.head(1) else None
            if fresh is not None:
                links = links.unionByName(_with_patterns(_tokens(texts).join(_small(fresh), "v", "left_semi"), "v").select("p", "v").distinct())
                links = materialize(links, "pii-links")
        if not i or fresh is not None:
            able = links.groupBy("p").agg(F.count("*").alias("n")).filter(F.col("n") > min_support * min_confidence)
            able = materialize(able if edges is None else able.join(edges.select("p").distinct(), "p", "left_anti"), "pii-able")
            # with n scored instances of N, confidence is at most n / (N + 1); N in some of the texts is less than in all, and its estimate, made once, may be off by half
            if sizes is not None:
                new = able.join(sizes, "p", "left_anti")
                able = able.join(sizes, "p").filter(_hopeful(min_confidence)).select("p", "n")
            else:
                new, able = able, None
            if new.head(1):
                some = _with_patterns(_tokens(texts.filter(F.pmod("_key", F.lit(BOUND_TEXTS)) == 0)), "v")
                seen = some.join(_small(new.select("p")), "p", "left_semi").groupBy("p").agg(F.approx_count_distinct("v", 0.1).alias("all"))
                seen = materialize(new.select("p").join(seen, "p", "left").select("p", F.coalesce("all", F.lit(0)).alias("all")), "pii-sizes")
                new = new.join(seen, "p").filter(_hopeful(min_confidence)).select("p", "n")
                sizes = seen if sizes is None else sizes.unionByName(seen)
            able = new if able is None else able.unionByName(new)
            able = materialize(able.select("p"), "pii-able")
        if not i or (fresh is not None and able.head(1)):
            more = _with_patterns(_tokens(texts), "v").join(_small(able), "p", "left_semi").select("p", "v").distinct()
            edges = materialize(more if edges is None else edges.unionByName(more), "pii-graph")
        known = scores
        support = F.count("*")
        patterns = (
            edges.join(scores, "v", "left")
            .groupBy("p")
            .agg((F.coalesce(F.sum("score"), F.lit(0.0)) / (support + 1)).alias("conf"), support.alias("n"))
            .filter((F.col("n") >= min_support) & (F.col("conf") >= min_confidence))
            .select("p", "conf")
        )
        patterns = materialize(patterns, "pii-patterns")
        scores = materialize(edges.join(patterns, "p").select("v", F.col("conf").alias("score")).unionByName(given).groupBy("v").agg(F.max("score").alias("score")), "pii-scores")
    return patterns.select("p"), scores.select("v")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, _key (hash of the text), base and spans: ordered arrays of struct(s, k, e)."""
    found = materialize(scan(docs, id_col, text_col), "pii-scan")
    texts = _texts(docs, id_col, text_col)
    based = found.filter(F.size("base") > 0).dropDuplicates(["doc_id", "_key"]).select("doc_id", "_key", F.explode("base").alias("b")).select("doc_id", "_key", "b.s", "b.e")
    sown = _covered(_placed(found.filter("_t is not null").select("doc_id", "_key", "_t")), based)
    assigned = F.lower("prev").isin(*SEED_KEYS) & F.col("before").rlike(_ASSIGNS) & F.col("value").rlike(_IDENTIFIER)
    seeds = materialize(_with_patterns(sown.filter(F.col("covered") | assigned), "v").select("p", "v").distinct(), "pii-sown")
    patterns, values = bootstrap(texts, seeds)
    # where a confident pattern extracts a token, or an identifier-like value was extracted
    wanted = materialize(patterns.unionByName(values.select(_of_value(F.col("v")).alias("p"))).distinct(), "pii-wanted")
    hits = _with_patterns(_tokens(texts), "doc_id", "_key", "at", values=True).join(_small(wanted), "p", "left_semi")
    hits = materialize(hits.select("doc_id", "_key", "at").distinct(), "pii-hits")
    placed = _same(hits, _placed(_same(hits.select("doc_id", "_key").distinct(), texts)), "at")
    free = _covered(placed.select("doc_id", "_key", "s", "e"), based).filter(~F.col("covered"))
    added = free.groupBy(F.col("doc_id").alias("_i"), F.col("_key").alias("_k")).agg(F.collect_set(F.struct(F.col("s"), F.lit(len(KINDS) - 1).alias("k"), F.col("e"))).alias("added"))
    joined = found.select("doc_id", "_key", "base").join(added, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")), "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.select("doc_id", "_key", "base", spans.alias("spans"))


def _digest(spans: Column) -> Column:
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _redacted(text: Column, spans: Column, kinds: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by the kind of its first; linear in text and spans."""
    chunk = 256

    def cut(c: Column, a: Column, b: Column) -> Column:
        i = F.floor(a / chunk).cast("int")
        near = F.array_join(F.slice(c, i + 1, F.floor(b / chunk).cast("int") - i + 1), "")
        return F.substring(near, a - i * chunk + 1, b - a)

    def put(p: Column) -> Column:
        reach = p["reach"]
        before = F.concat(F.array(F.lit(0)), reach)
        each = F.arrays_zip(p["spans"].alias("x"), before.alias("from"))
        marks = F.filter(each, lambda m: m["x"].isNotNull() & (m["x"]["s"] >= m["from"]))
        pieces = F.transform(marks, lambda m: F.concat(cut(p["c"], m["from"], m["x"]["s"]), F.get(kinds, m["x"]["k"])))
        return F.concat(F.array_join(pieces, ""), cut(p["c"], F.element_at(reach, -1), p["n"]))

    ends = _running(F.transform(spans, lambda x: x["e"]), lambda x, y: F.greatest(x, y))
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    return let(F.struct(spans.alias("spans"), ends.alias("reach"), parts.alias("c"), F.length(text).alias("n")), put)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets."""
    i, k, own, added = fresh_names(docs, 4)
    spans = find(docs, id_col, text_col).filter(F.size("spans") > 0).select(F.col("doc_id").alias(i), F.col("_key").alias(k), F.col("spans").alias(added)).dropDuplicates([i, k])
    kinds = F.lit([f"<{k.upper()}>" for k in KINDS])
    text = F.col(text_col)
    held = docs.withColumn(own, F.xxhash64(F.coalesce(text, F.lit(""))))
    held = held.join(spans, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(own) == F.col(k)), "left")
    changed = F.when(F.col(added).isNull(), text).otherwise(_redacted(text, F.col(added), kinds))
    return held.select(*[changed.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op9_pii(docs: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return find(docs).select(
        "doc_id", *[count(k) for k in range(4)], F.sha2(_digest(F.col("base")), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans")
    )


__all__ = ["KINDS", "base_spans", "bootstrap", "find", "op9_pii", "redact", "scan"]
