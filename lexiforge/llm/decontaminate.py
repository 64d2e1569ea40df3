"""Benchmark decontamination with SimHash windows and multi-index Hamming search.

Texts are normalised (lower case, letters and digits only) and cut into words.
Windows of an item's size are laid wherever so many of their shingles are the
item's that the similarity can reach the threshold: at every start, and at the end of
a text also where a window is cut short and a shingle stands at its place in the item
(a text shorter than the item is one window).  No other window can pass.  Every
window gets a 64-bit SimHash of its words.  The items' fingerprints are indexed
by size, block and every block value within ``radius // BLOCKS`` bits; windows
join on their own block values, so all fingerprints within the radius meet and the
others mostly do not.  Whole fingerprints are compared next, then the exact weighted
(multiset) Jaccard similarity of the shingles, by joins on shingle counts.

Of worst-case windows (similarity just 0.8, the words changed at the ends), about one in
10,000 is further away than the radius (a test measures it).  Shingles have five
words; an item of fewer words is one shingle, so it is matched whole.

The benchmark's shingle hashes (28 bytes each) are broadcast only up to
``broadcast_rows``, and so are the hashes of the texts with windows; beyond, the
joins shuffle both sides.  The positions that one
item's shingles have in one text are one array; very long texts cost time in
proportion to their words.  Edge cases: null and empty texts have no windows, nor
have items without words; the best window of a document and item is the most
similar, then the first (equal texts of items are items of their own); repeated
rows give one result row per document id; rows without an id count as one document;
empty tables give an empty result; extra columns are ignored by :func:`leaks` and
pass through :func:`decontaminate`, which drops just the rows whose own text holds an
item, whatever their id.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, let, materialize, words_of

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 19
BLOCKS = 5


def normal_words(text: Column) -> Column:
    return words_of(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]+", ""))


def _hashes(words: Column, k: int = SHINGLE) -> Column:
    """Hash of each shingle of ``k`` words."""
    at = lambda i, j: F.get(words, i + j)
    every = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(F.lit(k), *[at(i, j) for j in range(k)]))
    return F.when(F.size(words) >= k, every)


def _shingles(words: Column) -> Column:
    """All shingles; fewer words than a shingle has are one."""
    every = F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))
    return F.when(F.size(words) >= SHINGLE, every).otherwise(F.array(F.array_join(words, " ")))


def simhash(words: Column) -> Column:
    """64-bit SimHash over the words, each weighted by its number of occurrences."""
    n = F.size(words)

    def bit(hashes: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > n, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    every, zero = F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long")
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hs: F.aggregate(every, zero, lambda acc, b: acc.bitwiseOR(bit(hs, b))))


def _block(fp: Column, b: int) -> tuple[Column, int]:
    """Value and width of block ``b`` of a fingerprint."""
    cuts = [i * 64 // BLOCKS for i in range(BLOCKS + 1)]
    width = cuts[b + 1] - cuts[b]
    return F.shiftrightunsigned(fp, cuts[b]).bitwiseAND(F.lit((1 << width) - 1)), width


def _masks(width: int, reach: int) -> list[int]:
    """All numbers of ``width`` bits with ``reach`` ones at most."""
    return [sum(1 << i for i in bits) for k in range(reach + 1) for bits in itertools.combinations(range(width), k)]


def near_fingerprints(left: DataFrame, right: DataFrame, radius: int) -> DataFrame:
    """(n, fp, item_fp): all pairs of ``left`` (n, fp) and ``right`` (n, item_fp) of one size within ``radius`` bits."""
    cells = []
    for b in range(BLOCKS):
        value, width = _block(F.col("item_fp"), b)
        masks = F.explode(F.lit(_masks(width, radius // BLOCKS))).alias("mask")
        cell = right.distinct().select("n", "item_fp", value.alias("value"), masks)
        cells.append(cell.select("n", "item_fp", F.lit(b).alias("block"), F.col("value").bitwiseXOR(F.col("mask").cast("long")).alias("value")))
    index = cells[0]
    for more in cells[1:]:
        index = index.union(more)
    index = materialize(index, "bench-index")  # its size on disk decides whether it is broadcast
    own = F.array(*[F.struct(F.lit(b).alias("block"), _block(F.col("fp"), b)[0].alias("value")) for b in range(BLOCKS)])
    keys = left.distinct().select("n", "fp", F.inline(own))
    met = keys.join(index, ["n", "block", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    return met.select("n", "fp", "item_fp").distinct()


def _starts(need: Column, reach: Column) -> Column:
    """Starts of whole windows that hold ``need`` of the sorted positions ``ps``, by the first position held."""
    ps, last = F.col("ps"), F.greatest(F.col("len") - F.col("n"), F.lit(0))

    def held(j: Column) -> Column:
        before = F.when(j > 0, F.get(ps, j - 1) + 1).otherwise(F.lit(0))
        bounds = F.struct(F.greatest(before, F.get(ps, j + need - 1) - reach).alias("lo"), F.least(F.get(ps, j), last).alias("hi"))
        return let(bounds, lambda x: F.when(x["lo"] <= x["hi"], F.sequence(x["lo"], x["hi"])).otherwise(F.array().cast("array<int>")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(ps) - need), held))


def _windows(docs: DataFrame, items: DataFrame, threshold: float, broadcast_rows: int) -> DataFrame:
    """(doc_id, key, start, n, w): the windows that may reach the threshold; ``docs`` has doc_id, key and text."""
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect()) or [SHINGLE]  # SHINGLE values at most
    own = F.when(F.col("n") >= SHINGLE, _hashes(F.col("item_words")))
    for k in range(1, SHINGLE):
        own = own.when(F.col("n") == k, _hashes(F.col("item_words"), k))
    anchors = items.select("ik", "n", F.posexplode(own).alias("at", "h"))
    anchors = materialize(anchors.distinct(), "bench-anchors")
    small = anchors.count() <= broadcast_rows
    words = docs.select("doc_id", "key", normal_words(F.col("text")).alias("words"))

    def shingled(words: Column) -> Column:
        hashes = [_hashes(words, k) for k in sizes]
        return F.concat(*[F.coalesce(F.transform(h, lambda x, i: F.struct(i.alias("pos"), x.alias("h"))), F.array().cast("array<struct<pos:int,h:bigint>>")) for h in hashes])

    # outer explodes: no filter is inferred that would compute the shingles twice; the joins drop nulls
    hashed = words.select("doc_id", "key", F.size("words").alias("len"), (_hashes(F.col("words"), sizes[0]) if len(sizes) == 1 else shingled(F.col("words"))).alias("hs"))
    if len(sizes) == 1:
        flat = hashed.select("doc_id", "key", "len", F.posexplode_outer("hs").alias("pos", "h"))
    else:
        flat = hashed.select("doc_id", "key", "len", F.explode_outer("hs").alias("x")).select("doc_id", "key", "len", "x.pos", "x.h")
    hit = flat.join(F.broadcast(anchors) if small else anchors, "h")
    aligned = F.when(F.col("pos") - F.col("at") > F.col("len") - F.col("n"), F.greatest(F.col("pos") - F.col("at"), F.lit(0)))
    found = hit.groupBy("doc_id", "key", "len", "ik", "n").agg(F.sort_array(F.collect_set("pos")).alias("ps"), F.collect_set(aligned).alias("cut"))
    reach = F.col("n") - F.least("n", F.lit(SHINGLE))
    found = found.withColumn("need", F.ceil(F.lit(threshold) * (reach + 1) - F.lit(1e-9)).cast("int")).filter((F.size("ps") >= F.col("need")) & (F.col("need") > 0))
    late = F.filter("cut", lambda s: F.size(F.filter("ps", lambda x: x >= s)) >= F.col("need"))
    found = found.select("doc_id", "key", "n", F.explode(F.concat(_starts(F.col("need"), reach), late)).alias("start")).distinct()
    found = found.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "n")).alias("at"))
    # only texts with such windows are read again; only these meet the lists of starts
    found = materialize(found, "bench-starts").withColumnsRenamed({"doc_id": "d", "key": "t"})
    if found.count() <= broadcast_rows:  # 8 bytes each
        docs = docs.join(F.broadcast(found.select("t")), F.col("key") == F.col("t"), "left_semi")
    placed = docs.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t"))).dropDuplicates(["doc_id", "key"])
    placed = placed.select("doc_id", "key", normal_words(F.col("text")).alias("words"), "at")
    cut = F.transform("at", lambda x: F.struct(x["start"].alias("start"), x["n"].alias("n"), F.array_join(F.slice("words", x["start"] + 1, x["n"]), " ").alias("w")))
    return materialize(placed.select("doc_id", "key", F.inline(cut)), "bench-windows")


def _counted(rows: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, g, c): the shingles of each row and how often it has them."""
    return rows.select(key, F.explode(_shingles(words)).alias("g")).groupBy(key, "g").agg(F.count("*").alias("c"))


def _leaks(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, threshold: float, radius: int, broadcast_rows: int) -> DataFrame:
    """doc_id, key, item_id, start, n_words, hamming, similarity: the best window of each text and item."""
    named = benchmark.select(F.col(item_col).alias("item_id"), normal_words(F.col(item_text_col)).alias("item_words")).filter(F.size("item_words") > 0)
    named = materialize(named.select("item_id", F.array_join("item_words", " ").alias("ik"), "item_words").distinct(), "bench-items")
    # an item is known by its words; equal texts of items are searched once
    items = named.select(F.md5("ik").alias("ik"), "item_words", F.size("item_words").alias("n"), F.least(F.size("item_words"), F.lit(SHINGLE)).alias("k"), simhash(F.col("item_words")).alias("item_fp")).distinct()
    items = materialize(items, "bench-texts")
    windows = _windows(docs, items.withColumn("ik", F.xxhash64("ik")), threshold, broadcast_rows)
    # equal windows share one fingerprint, and one verification for each item
    texts = windows.select("w", "n").distinct().select(F.md5("w").alias("wk"), "n", F.split("w", " ").alias("words"))
    texts = materialize(texts.select("wk", "n", "words", simhash(F.col("words")).alias("fp")), "bench-fingerprints")
    near = near_fingerprints(texts.select("n", "fp"), items.select("n", "item_fp"), radius)
    pairs = texts.select("wk", "n", "fp").join(near, ["n", "fp"]).join(items.select("ik", "n", "item_fp"), ["n", "item_fp"])
    pairs = materialize(pairs.select("wk", "ik", "n", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("hamming")), "bench-pairs")
    left = _counted(texts.select("wk", "words").dropDuplicates(["wk"]), "wk", F.col("words"))
    right = _counted(items, "ik", F.col("item_words")).withColumnRenamed("c", "e")
    common = pairs.select("wk", "ik").distinct().join(left, "wk").join(right, ["ik", "g"]).groupBy("wk", "ik").agg(F.sum(F.least("c", "e")).alias("lo"))
    sizes = texts.select("wk", F.size(_shingles(F.col("words"))).alias("a")).distinct(), items.select("ik", F.size(_shingles(F.col("item_words"))).alias("b"))
    judged = pairs.join(common, ["wk", "ik"]).join(sizes[0], "wk").join(sizes[1], "ik")
    judged = judged.withColumn("similarity", F.col("lo") / (F.col("a") + F.col("b") - F.col("lo"))).filter(F.col("similarity") >= threshold)
    judged = judged.join(named.select("item_id", F.md5("ik").alias("ik")), "ik").select("wk", "n", "item_id", "similarity", "hamming")
    judged = materialize(judged, "bench-judged")
    best = F.max_by(F.struct("start", F.col("n").alias("n_words"), "hamming", "similarity"), F.struct("similarity", -F.col("start")))
    found = windows.withColumn("wk", F.md5("w")).join(judged, ["wk", "n"])
    return found.groupBy("doc_id", "key", "item_id").agg(best.alias("b")).select("doc_id", "key", "item_id", "b.*")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """doc_id, item_id, start, n_words, hamming, similarity: the best window of each pair."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and up to 1")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text_col).alias("key"), F.col(text_col).alias("text"))
    found = _leaks(slim, benchmark, item_col, item_text_col, threshold, radius, broadcast_rows)
    best = F.max_by(F.struct("start", "n_words", "hamming", "similarity"), F.struct("similarity", -F.col("start")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, radius: int = RADIUS, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, also such without an id or with a clean row's id."""
    i, k, own = fresh_names(docs, 3)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text_col).alias("key"), F.col(text_col).alias("text"))
    found = _leaks(slim, benchmark, item_col, item_text_col, threshold, radius, broadcast_rows)
    found = materialize(found.select(F.col("doc_id").alias(i), F.col("key").alias(k)).distinct(), "leaks")
    keyed = docs.withColumn(own, _key(text_col))
    return keyed.join(found, F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.col(own) == F.col(k)), "left_anti").drop(own)


def op8_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = leaks(docs, benchmark)
    return found.select("doc_id", "item_id", F.col("start").cast("long"), F.col("n_words").cast("long"), F.round("similarity", 6).alias("similarity"))
