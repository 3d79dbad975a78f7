"""Edits laid over rows, renumbering, and references that follow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def overlaid(rows: DataFrame, edits: DataFrame, key: list[str], text: str) -> DataFrame:
    """``rows`` without those an edit drops, with the edited text, and reviewed (is there an edit?).

    ``edits`` has key, correct (null leaves the text) and fix_type ('drop' takes the row out); one per key.
    """
    e = edits.select(*key, F.col("correct").alias("__c"), F.col("fix_type").alias("__f"), F.lit(True).alias("__r"))
    met = rows.join(e, key, "left").where(~F.col("__f").eqNullSafe("drop"))
    return met.withColumn(text, F.coalesce("__c", F.col(text))).withColumn("reviewed", F.coalesce("__r", F.lit(False))).drop("__c", "__f", "__r")


def with_inserted(rows: DataFrame, inserted: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of both with new ordinals: an inserted row stands behind the row of its key with the same ordinal.

    The result has old_ordinal (null for inserted rows).
    """
    both = rows.withColumns({"__new": F.lit(0), "old_ordinal": F.col(order)}).unionByName(
        inserted.withColumns({"__new": F.lit(1), "old_ordinal": F.lit(None).cast(rows.schema[order].dataType)}), allowMissingColumns=True
    )
    return both.withColumn(order, F.row_number().over(W.partitionBy(*key).orderBy(order, "__new"))).drop("__new")


def remapped(refs: DataFrame, row_key: list[str], scope: list[str], ids: str, mapping: DataFrame) -> DataFrame:
    """``refs`` with the ids of an array column replaced by ``mapping`` (``scope`` columns, old_id, new_id), the rest kept, in order.

    ``row_key`` names a row of ``refs``; a null array stays null.
    """
    each = refs.select(*dict.fromkeys([*row_key, *scope]), F.posexplode(ids).alias("__k", "old_id"))
    met = each.join(mapping.select(*scope, "old_id", "new_id"), [*scope, "old_id"], "left")
    new = met.groupBy(*row_key).agg(F.sort_array(F.collect_list(F.struct("__k", F.coalesce("new_id", "old_id").alias("i"))))["i"].alias("__ids"))
    empty = F.when(F.col(ids).isNotNull(), F.array().cast(refs.schema[ids].dataType))
    return refs.join(new, row_key, "left").withColumn(ids, F.coalesce("__ids", empty)).drop("__ids")


def with_id_added(ids: Column, added: Column) -> Column:
    """An id set with one more, sorted; a null set is empty, a null id adds nothing."""
    none = F.array().cast("array<string>")
    return F.sort_array(F.array_union(F.coalesce(ids, none), F.coalesce(F.when(added.isNotNull(), F.array(added)), none)))


def replaced_once(rows: DataFrame, edits: DataFrame, key: list[str], text: str) -> DataFrame:
    """``rows`` with the edits (key, old, new) made. An edit whose ``old`` does not stand exactly once in its text is an error when the row is read."""
    met = rows.join(edits.select(*key, F.col("old").alias("__old"), F.col("new").alias("__new")), key, "left")
    times = (F.length(text) - F.length(F.replace(text, "__old", F.lit("")))) / F.length("__old")
    stated = F.when(F.col("__old").isNull(), F.col(text)).when(times == 1, F.replace(text, "__old", "__new")).otherwise(
        F.raise_error(F.concat(F.lit("not exactly once: "), F.coalesce("__old", F.lit("null")))).cast("string")
    )
    return met.withColumn(text, stated).drop("__old", "__new")


#: Views of an edited table: what a reviewer may ask for.
VIEWS = ("all", "flagged", "unreviewed", "edited", "dropped")


def view(rows: DataFrame, edits: DataFrame, flags: DataFrame, key: list[str], text: str, name: str) -> DataFrame:
    """``rows`` of a view. ``edits`` has key, correct, reviewed, fix_type; ``flags`` the keys with a remark (may repeat)."""
    if name not in VIEWS:
        raise ValueError(name)
    if name == "all":
        return rows
    if name == "flagged":
        return rows.join(flags.select(*key).distinct(), key, "left_semi")
    e = edits.select(*key, F.col("correct").alias("__c"), F.coalesce("reviewed", F.lit(False)).alias("__r"), F.col("fix_type").eqNullSafe("drop").alias("__d"))
    met = rows.join(e, key, "left")
    kept = {
        "unreviewed": ~F.coalesce("__r", F.lit(False)) & ~F.coalesce("__d", F.lit(False)),
        "dropped": F.coalesce("__d", F.lit(False)),
        "edited": F.col("__c").isNotNull() & ~F.col("__c").eqNullSafe(F.col(text)),
    }[name]
    return met.where(kept).select(*rows.columns)


def review_progress(rows: DataFrame, edits: DataFrame, flags: DataFrame, key: list[str], text: str, group: list[str]) -> DataFrame:
    """``group``, total, done (reviewed or dropped), edited, flagged."""
    e = edits.select(*key, F.col("correct").alias("__c"), (F.coalesce("reviewed", F.lit(False)) | F.col("fix_type").eqNullSafe("drop")).alias("__done"))
    f = flags.select(*key).distinct().withColumn("__flag", F.lit(True))
    met = rows.select(*dict.fromkeys([*key, *group, text])).join(e, key, "left").join(f, key, "left")
    return met.groupBy(*group).agg(
        F.count("*").alias("total"), F.count_if("__done").alias("done"),
        F.count_if(F.col("__c").isNotNull() & ~F.col("__c").eqNullSafe(F.col(text))).alias("edited"), F.count_if("__flag").alias("flagged"),
    )


def gathered_flags(sentences: DataFrame, key: list[str], box_ids: str, review: DataFrame, scope: list[str]) -> DataFrame:
    """key, remarks: the review entries (``scope``, id, level) of the boxes of each sentence, in order of its boxes. Sentences without any are left out."""
    each = sentences.select(*dict.fromkeys([*key, *scope]), F.posexplode(box_ids).alias("__k", "__box"))
    met = each.join(review.select(*scope, F.col("id").alias("__box"), "level"), [*scope, "__box"])
    listed = met.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("__k", "__box", "level"))).alias("x"))
    return listed.select(*key, F.transform("x", lambda x: F.struct(x["__box"].alias("id"), x["level"].alias("level"))).alias("remarks"))


def recased(match: str, correct: str) -> str:
    """``correct`` in the case of what it replaces: all capitals, capital first, or as it is."""
    return correct.upper() if match.isupper() else correct[:1].upper() + correct[1:] if match[:1].isupper() else correct


def phrases_corrected(df: DataFrame, text: str, rules: list[tuple[str, str]]) -> DataFrame:
    """``df`` with whole phrases replaced, whatever their case or hyphens, keeping the case of the match. Null stays null."""
    import re

    letter = "0-9A-Za-zÀ-ỹĐđ"
    compiled = [(re.compile(rf"(?<![{letter}])" + r"[\s\-]+".join(map(re.escape, re.split(r"[\s\-]+", a))) + rf"(?![{letter}])", re.I), b) for a, b in rules if a and b]

    @F.pandas_udf("string")
    def fix(s: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            for pattern, correct in compiled if isinstance(t, str) else []:
                t = pattern.sub(lambda m: recased(m.group(), correct), t)
            return t

        return s.map(one)

    return df.withColumn(text, fix(text))
