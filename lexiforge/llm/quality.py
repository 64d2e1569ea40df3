"""Quality rules: a threshold table compiled into native column expressions.

The rule table names a feature, a direction and a threshold.  Compilation turns
it into one projection over features that are themselves built-in expressions,
so the plan is a scan and projections: no shuffle, no user functions.

Edge cases: a null or blank text has no words, all counts zero and fails the
base rule; ties and repeated rows are judged independently; an empty table gives
an empty result; extra input columns are ignored by :func:`quality_features`
(they never clash, only ``id_col`` and ``text_col`` are read).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, let, words_of

#: Frequent function words of the languages served; a real text has many of them.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on are this at from "
    "de la le et les des en un du que est pour qui dans par au sur il pas plus "
    "der die und das von zu mit den ist im ein nicht auf für sich dem "
    "el los se del las por con para una su al lo como es y"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject a text when ``feature`` is below ``low`` or above ``high``."""

    feature: str
    low: float | None = None
    high: float | None = None


#: Production thresholds.
RULES = (
    Rule("n_words", low=10, high=1_000_000),
    Rule("mean_word_chars", low=2, high=12),
    Rule("symbol_ratio", high=0.25),
    Rule("stop_ratio", low=0.01),
    Rule("upper_ratio", high=0.30),
    Rule("bang_ratio", high=0.20),
    Rule("dup_line_ratio", high=0.60),
    Rule("bullet_line_ratio", high=0.90),
    Rule("ellipsis_line_ratio", high=0.30),
)


def _repeated_words(words: Column, hashes: Column, size: int) -> Column:
    """Words inside windows that occur twice or more.

    Equal windows hash alike, so distinct hashes clear a text at once.  In the
    others, windows are ordered by hash and neighbours compared word by word.
    """

    def window(e: Column) -> Column:
        return F.slice(words, e["i"] + 1, size)

    def positions(ordered: Column) -> Column:
        def same(e: Column, k: Column) -> Column:
            other = F.get(ordered, k)
            return F.coalesce((e["h"] == other["h"]) & (window(e) == window(other)), F.lit(False))

        repeated = F.filter(ordered, lambda e, k: same(e, k - 1) | same(e, k + 1))
        return F.sort_array(F.transform(repeated, lambda e: e["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(-size).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        let(pairs, positions),
        start,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(size), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when((F.size(words) < size) | unique, F.lit(0).cast("long")).otherwise(covered)


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 5) -> DataFrame:
    """One row of counts and ratios per document, from native expressions only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("_text"), words_of(F.col(text_col)).alias("_words"))
    words = F.col("_words")
    at = lambda i, k: F.get(words, i + k)
    hashes = F.when(
        F.size(words) >= window,
        F.transform(F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[at(i, k) for k in range(window)])),
    )
    forms = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda s: s.rlike(WORD_CLASS))
    staged = base.select(
        id_col,
        "_words",
        hashes.alias("_hashes"),
        lines.alias("_lines"),
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size(F.filter(words, lambda w: w.isin(forms))).cast("long").alias("n_stop"),
        F.regexp_count("_text", F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_upper"),
        F.regexp_count("_text", F.lit("!!")).cast("long").alias("n_bang"),
    )
    rows = F.col("_lines")
    counted = staged.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
        _repeated_words(words, F.col("_hashes"), window).alias("n_repeat_words"),
        "n_stop",
        "n_upper",
        "n_bang",
        F.size(rows).cast("long").alias("n_lines"),
        F.size(F.filter(rows, lambda s: s.rlike(r"^[\x20\x09]*[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(rows, lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09\r]*$"))).cast("long").alias("n_ellipsis_lines"),
    )
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return counted.withColumns(
        {
            "mean_word_chars": per("word_chars", "n_words"),
            "symbol_ratio": per("n_symbols", "n_words"),
            "stop_ratio": per("n_stop", "n_words"),
            "upper_ratio": per("n_upper", "n_words"),
            "bang_ratio": per("n_bang", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "bullet_line_ratio": per("n_bullet_lines", "n_lines"),
            "ellipsis_line_ratio": per("n_ellipsis_lines", "n_lines"),
        }
    )


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one column: the names of the rules that a row breaks."""
    broken = []
    for rule in rules:
        value, tests = F.col(rule.feature), []
        if rule.low is not None:
            tests.append(value < F.lit(rule.low))
        if rule.high is not None:
            tests.append(value > F.lit(rule.high))
        test = tests[0] if len(tests) == 1 else tests[0] | tests[1]
        broken.append(F.when(test, F.lit(rule.feature)))
    return F.array_compact(F.array(*broken))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Features of every document, the rules it breaks, and the verdict ``kept``."""
    feats = quality_features(docs, id_col, text_col)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = feats.withColumn("base_failed", failed).withColumn("broken", compile_rules(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


__all__ = ["RULES", "Rule", "STOP_WORDS", "compile_rules", "quality_features", "quality_rules"]
