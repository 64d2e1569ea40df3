"""Homograph grouping, subentry merging, row groups with their relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.sources.scratch import cut

from .ordered import running_sum

Normalizer = Callable[[Column], Column]


def same(c: Column) -> Column:
    """For text that is composed already; else pass ``lexiforge.functions.unicode.nfc``."""
    return c


def entry_groups(roots: DataFrame, norm: Normalizer = same) -> DataFrame:
    """Adds group_ord to (entry_id dense from 1, expression, homograph).

    A row joins the one before it iff both have a homograph number and one key.
    The neighbour comes by an equi-join on the dense id, so no global sort is made.
    """
    keyed = roots.withColumn("_key", norm(F.col("expression"))).withColumn("_hom", F.coalesce(F.col("homograph") != "", F.lit(False)))
    before = keyed.select((F.col("entry_id") + 1).alias("_id"), F.col("_key").alias("_pk"), F.col("_hom").alias("_ph"))
    joined = keyed.join(before, F.col("entry_id") == F.col("_id"), "left")
    continues = F.coalesce((F.col("_key") == F.col("_pk")) & F.col("_hom") & F.col("_ph"), F.lit(False))
    return running_sum(joined.withColumn("_new", ~continues), "entry_id", F.col("_new"), "group_ord").drop("_id", "_pk", "_ph", "_new", "_key", "_hom")


def subentry_groups(forms: DataFrame, norm: Normalizer = same) -> DataFrame:
    """(group_ord, sub_key, first_form, expression, form_ids, parents) of derived forms.

    Numbered homographs of one spelling merge inside a group; others never do.
    ``forms``: group_ord, form_id, expression, homograph, root_expression, root_homograph.
    """
    numbered = F.coalesce(F.col("homograph") != "", F.lit(False))
    key = F.when(numbered, F.concat(F.lit("h:"), norm(F.col("expression")))).otherwise(F.concat(F.lit("f:"), F.col("form_id").cast("string")))
    parent = F.when(F.coalesce(F.col("root_homograph"), F.lit("")) != "", F.concat_ws(" ", "root_expression", "root_homograph")).otherwise(F.col("root_expression"))
    each = F.array_sort(F.collect_list(F.struct("form_id", parent.alias("parent"))))
    return (
        forms.withColumn("sub_key", key)
        .groupBy("group_ord", "sub_key")
        .agg(F.min("form_id").alias("first_form"), F.min_by("expression", "form_id").alias("expression"), each.alias("_e"))
        .select(
            "group_ord", "sub_key", "first_form", "expression",
            F.transform("_e", lambda x: x["form_id"]).alias("form_ids"),
            F.array_distinct(F.transform("_e", lambda x: x["parent"])).alias("parents"),
        )
    )


def children(subs: DataFrame) -> DataFrame:
    """(group_ord, children): distinct names of a group's derived forms in order."""
    names = F.transform(F.array_sort(F.collect_list(F.struct("first_form", "expression"))), lambda x: x["expression"])
    return subs.groupBy("group_ord").agg(F.array_distinct(names).alias("children"))


def row_groups(all_forms: DataFrame, norm: Normalizer = same) -> DataFrame:
    """Lookup row groups: sequence from 1, roots before their derived groups.

    Columns: sequence, kind, group_ord, root_expression, form_ids, display_ids,
    parents, children, related.  ``all_forms``: entry_id, form_id, kind,
    expression, homograph, has_content.
    """
    roots = entry_groups(all_forms.filter("kind = 'entry'").select("entry_id", "form_id", "expression", "homograph", "has_content"), norm)
    roots = cut(roots, "roots")
    derived = all_forms.filter("kind <> 'entry'").join(
        roots.select("entry_id", "group_ord", F.col("expression").alias("root_expression"), F.col("homograph").alias("root_homograph"), F.col("has_content").alias("root_full")), "entry_id"
    )
    subs = cut(subentry_groups(derived, norm), "subentries")
    kids = children(subs)
    first = roots.groupBy("group_ord").agg(F.min_by("expression", "entry_id").alias("root_expression"), F.sort_array(F.collect_list("form_id")).alias("form_ids"))
    # an empty root shows its derived forms
    shown = roots.select("group_ord", "form_id").union(derived.filter(~F.col("root_full")).select("group_ord", "form_id"))
    shown = shown.groupBy("group_ord").agg(F.sort_array(F.collect_list("form_id")).alias("display_ids"))
    none = F.array().cast("array<string>")
    root_rows = first.join(shown, "group_ord").join(kids, "group_ord", "left").select(
        "group_ord", F.lit(0).alias("rank"), F.lit("root").alias("kind"), "root_expression", "form_ids", "display_ids",
        none.alias("parents"), F.coalesce("children", none).alias("children"), none.alias("related"),
    )
    w = Window.partitionBy("group_ord").orderBy("first_form")
    sub_rows = subs.withColumn("rank", F.row_number().over(w)).join(kids, "group_ord").join(first.select("group_ord", "root_expression"), "group_ord")
    sub_rows = sub_rows.withColumn("_own", norm(F.col("expression"))).select(
        "group_ord", "rank", F.lit("subentry").alias("kind"), "root_expression", "form_ids", F.col("form_ids").alias("display_ids"),
        "parents", none.alias("children"), F.filter("children", lambda c: c != F.col("expression")).alias("related"),
    )
    rows = root_rows.unionByName(sub_rows)
    sizes = running_sum(rows.groupBy("group_ord").agg(F.count("*").alias("_n")), "group_ord", F.col("_n"), "_upto")
    starts = sizes.select(F.col("group_ord").alias("_g"), (F.col("_upto") - F.col("_n")).alias("_start"))
    return rows.join(starts, F.col("group_ord") == F.col("_g")).select((F.col("_start") + F.col("rank") + 1).alias("sequence"), *[c for c in rows.columns if c != "rank"])
