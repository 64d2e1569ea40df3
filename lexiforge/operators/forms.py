"""Entries, forms and content items from marker lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.sources.markers import FORM_KINDS, HEADERS, ITEM_TYPES

from .ordered import running_sum


def assign_forms(markers: DataFrame) -> DataFrame:
    """``markers`` with dense entry_id and form_id (from 1; 0: before the first entry)."""
    with_entry = running_sum(markers, "line_no", F.col("marker") == "Entry", "entry_id")
    return running_sum(with_entry, "line_no", F.col("marker").isin(*FORM_KINDS), "form_id")


def forms(assigned: DataFrame) -> DataFrame:
    """One row per form: kind, expression, homograph, variants in order."""
    kinds = F.create_map(*[F.lit(x) for kv in FORM_KINDS.items() for x in kv])
    header = F.col("marker").isin(*FORM_KINDS)
    variants = F.transform(F.array_sort(F.collect_list(F.when(F.col("marker") == "Variant", F.struct("line_no", "value")))), lambda v: v["value"])
    return (
        assigned.filter(F.col("marker").isin(*FORM_KINDS, *HEADERS))
        .groupBy("entry_id", "form_id")
        .agg(
            F.max(F.when(header, F.element_at(kinds, F.col("marker")))).alias("kind"),
            F.max(F.when(header, F.col("value"))).alias("expression"),
            F.max_by(F.when(F.col("marker") == "Homograph", F.col("value")), F.when(F.col("marker") == "Homograph", F.col("line_no"))).alias("homograph"),
            variants.alias("variants"),
        )
    )


def content(assigned: DataFrame) -> DataFrame:
    """Content items: (entry_id, form_id, item_ord, type, value)."""
    types = F.create_map(*[F.lit(x) for kv in ITEM_TYPES.items() for x in kv])
    numbered = F.col("marker").startswith("Definition ")
    item = lambda k, t, v: F.struct(F.lit(k).alias("k"), t.alias("type"), v.alias("value"))
    one = F.array(item(0, F.try_element_at(types, F.col("marker")), F.when(F.col("marker") == "NoSpace", "").otherwise(F.col("value"))))
    two = F.array(item(0, F.lit("sense"), F.substring("marker", 12, 20)), item(1, F.lit("roman"), F.col("value")))
    rows = assigned.filter(~F.col("marker").isin(*FORM_KINDS, *HEADERS)).withColumn("i", F.explode(F.when(numbered, two).otherwise(one)))
    return rows.select("entry_id", "form_id", (F.col("line_no") * 2 + F.col("i.k")).alias("item_ord"), "i.type", "i.value")
