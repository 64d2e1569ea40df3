"""Language identification by Bayesian evidence fusion.

Three kinds of evidence meet in one posterior: the text's likelihood under
per-language byte-trigram models, the language that the markup or metadata
declares, and a host prior that is smoothed hierarchically (all rows, address
suffix, host).  Models, reliabilities of the declarations and priors are counts
over all rows from grouped aggregation; what reaches the driver has one cell per
language and trigram bucket, and languages are codes of two or three letters.  Every
declared language has a model, however rare; one more class, in which all trigrams
are as likely, stands for the languages that no row declares.

Edge cases: a declaration that is no such code is none; a text in no known language is rejected (``lang`` null); a null, blank or letterless text is rejected (``lang`` null,
confidence 0); a missing declaration, host or suffix is no evidence; ties go to
the alphabetically first language; repeated rows are judged each; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy

BUCKETS = 1 << 14
#: What counts as a declared language: two or three letters before any region, so there are at most 26**2 + 26**3.
CODE = r"^\s*([a-z]{2,3})(?:[^a-z].*)?$"
UNKNOWN = "unknown"
#: Trigrams of a text are far from independent; their log-likelihood is tempered.
TEMPER = 0.2
SMOOTH = 50.0
MIN_CONFIDENCE = 0.5
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LETTER = np.array([97 <= b <= 122 or 65 <= b <= 90 or b >= 128 for b in range(256)])


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each byte trigram, first trigram of each text, letters of each text."""
    raw = [b"  " + (t or "").encode("utf-8", "replace").translate(_LOWER) + b"  " for t in texts]
    b = np.frombuffer(b"".join(raw), np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(r) for r in raw])[:-1])).astype("i8") if raw else np.zeros(0, "i8")
    letters = np.add.reduceat(_LETTER[b], starts, dtype="i8") if raw else np.zeros(0, "i8")
    c = b.astype("u4")
    ids = np.zeros(len(b), "i4")
    ids[:-2] = ((c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA6B) ^ c[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(18)).astype("i4")
    return ids, starts, letters


def _chunks(batch: pa.RecordBatch, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of a few MB of text each (a longer text stands alone)."""
    sizes = np.array([len(t) if t else 0 for t in batch.column(1).to_pylist()], "i8")
    at, used = 0, 0
    for i, n in enumerate(sizes):
        if used and used + n > most:
            yield batch.slice(at, i - at)
            at, used = i, 0
        used += n
    if at < batch.num_rows:
        yield batch.slice(at)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, the unknown one last, and log-probabilities [language, bucket], from all labelled rows."""
    langs = sorted(r[0] for r in docs.filter("declared is not null").select("declared").distinct().collect())
    index = {v: i for i, v in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # of the languages that this task meets
        for batch in (c for b in batches for c in _chunks(b)):
            of = np.array([index.get(v, -1) for v in batch.column(0).to_pylist()], "i8")
            ids, starts, _ = _trigrams(batch.column(1).to_pylist())
            row = np.repeat(of, np.diff(np.append(starts, len(ids))))
            for k in np.unique(of[of >= 0]).tolist():
                total[k] = total.get(k, 0) + np.bincount(ids[row == k], minlength=BUCKETS)
        for k, n in total.items():
            b = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), k, "i4")), pa.array(b.astype("i4")), pa.array(n[b])], ["k", "b", "n"])
        tidy()

    counts = np.full((max(len(langs), 1), BUCKETS), 0.5)
    found = docs.filter("declared is not null").select("declared", "text").mapInArrow(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n"))
    for r in found.toLocalIterator():
        counts[r["k"], r["b"]] += r["n"]
    if not langs:
        return [], np.zeros((0, BUCKETS))
    # a text that no model makes likelier than chance is in none of the languages
    flat = np.full((1, BUCKETS), -np.log(BUCKETS))
    return [*langs, UNKNOWN], np.concatenate((np.log(counts / counts.sum(1, keepdims=True)), flat))


def text_likelihoods(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """docs (doc_id, declared, host, suffix) with ``ll`` (a log-likelihood per language) and ``letters``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype("f4"))  # langs x BUCKETS cells

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in (c for b in batches for c in _chunks(b)):
            ids, starts, letters = _trigrams(batch.column(1).to_pylist())
            ll = np.stack([np.add.reduceat(w[ids], starts, dtype="f8") for w in weights], 1)
            offsets = pa.array(np.arange(0, ll.size + 1, ll.shape[1], dtype="i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.ListArray.from_arrays(offsets, pa.array(ll.ravel())), pa.array(letters)],
                ["doc_id", "declared", "host", "suffix", "ll", "letters"],
            )
        tidy()

    return docs.select("doc_id", "text", "declared", "host", "suffix").mapInArrow(
        score, "doc_id long, declared string, host string, suffix string, ll array<double>, letters long"
    )


def _evidence(docs: DataFrame, id_col: str, text_col: str, declared: Column | None, host: Column | None, suffix: Column | None) -> DataFrame:
    none = F.lit(None).cast("string")
    pick = lambda c: none if c is None else c.cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.nullif(F.regexp_extract(F.lower(pick(declared)), CODE, 1), F.lit("")).alias("declared"),
        pick(host).alias("host"),
        pick(suffix).alias("suffix"),
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """Text, declared markup language, host and address suffix of raw web pages."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1))
    return pages.select(
        F.col("page_id").alias("doc_id"),
        text.alias("text"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"),
    )


def identify(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    model: tuple[list[str], np.ndarray] | None = None,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """doc_id, lang, confidence, text_lang (by text alone), kept."""
    rows = _evidence(docs, id_col, text_col, declared, host, suffix)
    langs, weights = model or train(rows)
    if not langs:
        return rows.select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in (("lang", "string"), ("text_lang", "string"))], F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    n = len(langs)
    names = F.lit(langs)
    best = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    scored = text_likelihoods(rows, langs, weights).withColumn("text_lang", F.when(F.col("letters") > 0, best(F.col("ll"))))
    scored = materialize(scored, "langid")

    # reliabilities of declarations, and priors of host within suffix within all
    tally = scored.filter("text_lang is not null").groupBy("suffix", "host", "declared", "text_lang").agg(F.count("*").alias("n"))
    tally = materialize(tally, "langid-tally")
    sure = {(r["d"], r["t"]): r["n"] for r in tally.filter(F.col("declared").isin(langs)).groupBy(F.col("declared").alias("d"), F.col("text_lang").alias("t")).agg(F.sum("n").alias("n")).collect()}
    seen = {t: sum(sure.get((d, t), 0) for d in langs) for t in langs}
    trust = [(d, [float(np.log((sure.get((d, t), 0) + 1) / (seen[t] + n))) for t in langs]) for d in langs]
    trust = docs.sparkSession.createDataFrame(trust, "_d string, _dl array<double>")  # one row per language
    total = {r["text_lang"]: r["n"] for r in tally.groupBy("text_lang").agg(F.sum("n").alias("n")).collect()}
    prior = [(total.get(t, 0) + 1) / (sum(total.values()) + n) for t in langs]

    def level(keys: list[str]) -> DataFrame:
        sums = [F.sum(F.when(F.col("text_lang") == t, F.col("n")).otherwise(0)).cast("double") for t in langs]
        return tally.filter(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(F.array(*sums).alias("c"))

    def smooth(counts: Column, parent: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, parent, lambda c, p: (c + SMOOTH * p) / (size + SMOOTH))

    top = F.lit(prior)
    by_suffix = level(["suffix"]).select(F.col("suffix").alias("_s"), smooth(F.col("c"), top).alias("_ps"))
    hosts = level(["suffix", "host"]).join(by_suffix, F.col("suffix") == F.col("_s"), "left")
    hosts = hosts.select(F.col("suffix").alias("_hs"), F.col("host").alias("_h"), smooth(F.col("c"), F.coalesce("_ps", top)).alias("_ph"))
    joined = scored.join(hosts, (F.col("host") == F.col("_h")) & F.col("suffix").eqNullSafe(F.col("_hs")), "left").join(by_suffix, F.col("suffix") == F.col("_s"), "left")
    joined = joined.join(F.broadcast(trust), F.col("declared") == F.col("_d"), "left")
    flat = F.array_repeat(F.lit(0.0), n)
    logs = F.zip_with(F.col("ll"), F.transform(F.coalesce("_ph", "_ps", top), lambda p: F.log(p)), lambda a, b: TEMPER * a + b)
    logs = F.zip_with(logs, F.coalesce("_dl", flat), lambda a, b: a + b)
    joined = joined.select("doc_id", "letters", "text_lang", logs.alias("lp"))
    weight = F.aggregate(F.transform("lp", lambda x: F.exp(x - F.array_max("lp"))), F.lit(0.0), lambda a, x: a + x)
    lettered = F.col("letters") > 0
    return joined.select(
        "doc_id",
        F.nullif(F.when(lettered, best(F.col("lp"))), F.lit(UNKNOWN)).alias("lang"),
        F.nullif(F.col("text_lang"), F.lit(UNKNOWN)).alias("text_lang"),
        F.when(lettered, 1 / weight).otherwise(0.0).alias("confidence"),
        (lettered & (best(F.col("lp")) != UNKNOWN) & (1 / weight >= min_confidence)).alias("kept"),
    )


def op10_language_id(docs: DataFrame) -> DataFrame:
    """All documents: text, the declared ``lang`` and the prior of the ``source``."""
    found = identify(docs, declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", "lang", "text_lang", F.round("confidence", 6).alias("confidence"), "kept")


def language_of_pages(pages: DataFrame) -> DataFrame:
    """All pages: text, the language their markup declares, host and address suffix."""
    rows = page_evidence(pages)
    found = identify(rows, declared=F.col("declared"), host=F.col("host"), suffix=F.col("suffix"))
    return found.select(F.col("doc_id").alias("page_id"), "lang", "text_lang", F.round("confidence", 6).alias("confidence"), "kept")
