"""Rows of a chapter as one stream of characters: offsets, as-of lookup, interval overlap, cutting at marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions.text import cjk_chars, sentence_spans


def with_offsets(rows: DataFrame, key: list[str], order: list[str], length: Column, separator: int = 1) -> DataFrame:
    """``rows`` with start_at and end_at (exclusive) in the stream of their key; ``separator`` characters stand between rows."""
    before = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(length + separator).over(before), F.lit(0)).cast("bigint")
    return rows.withColumn("start_at", start).withColumn("end_at", F.col("start_at") + length)


def as_of(left: DataFrame, right: DataFrame, key: list[str], at: str, since: str, value: str) -> DataFrame:
    """``left`` with the ``value`` of the last ``right`` row of its key that has since <= at; null if there is none.

    One pass over the union of both sides in order of time: no pair of rows is ever built. Of right rows with
    the same ``since`` the greatest value counts.
    """
    r = right.groupBy(*key, F.col(since).alias("__t")).agg(F.max(value).alias("__v")).withColumns({"__side": F.lit(0), "__row": F.lit(None).cast(left_struct(left))})
    l = left.select(*key, F.col(at).alias("__t"), F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"))
    w = W.partitionBy(*key).orderBy("__t", "__side").rowsBetween(W.unboundedPreceding, 0)
    both = r.select(*l.columns).unionByName(l).withColumn("__found", F.last("__v", ignorenulls=True).over(w))
    return both.where("__side = 1").select("__row.*", F.col("__found").alias(value))


def left_struct(df: DataFrame) -> str:
    return df.select(F.struct(*df.columns).alias("x")).schema["x"].dataType.simpleString()


def overlaps(left: DataFrame, right: DataFrame, key: list[str], l_start: str, l_end: str, r_start: str, r_end: str, bucket: int = 64) -> DataFrame:
    """Pairs of rows of one key whose half-open intervals overlap, each once. Empty intervals overlap nothing.

    Both sides are laid into buckets of ``bucket`` positions, so the join is on equality and a long key is
    spread over its buckets. A pair that shares several buckets is kept in the first of them only.
    """
    lay = lambda df, s, e: df.where(F.col(s) < F.col(e)).withColumn(
        "__b", F.explode(F.sequence(F.floor(F.col(s) / bucket), F.floor((F.col(e) - 1) / bucket)))
    )
    met = lay(left, l_start, l_end).join(lay(right, r_start, r_end), [*key, "__b"])
    first = F.floor(F.greatest(F.col(l_start), F.col(r_start)) / bucket)
    return met.where((F.col(l_start) < F.col(r_end)) & (F.col(l_end) > F.col(r_start)) & (F.col("__b") == first)).drop("__b")


def resegmented(rows: DataFrame, key: list[str], order: list[str], text: str, source_id: str, final_marks: str, all_marks: str) -> DataFrame:
    """key, seg_no, segment, source_ids: the stream of each key cut behind final marks, without marks, with the rows it came from.

    Characters are dealt out by their place in the stream, so a segment may span rows. A trailing run
    without a final mark is kept. Segments without characters are left out before numbering.
    """
    chars = rows.select(*key, *order, F.col(source_id).alias("__id"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "")).alias("__k", "__c")).where("__c <> ''")
    at = W.partitionBy(*key).orderBy(*order, "__k")
    cut = F.coalesce(F.sum(F.lit(final_marks).contains(F.col("__c")).cast("int")).over(at.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    marked = chars.withColumns({"__seg": cut, "__n": F.row_number().over(at)}).where(~F.lit(all_marks).contains(F.col("__c")))
    gathered = marked.groupBy(*key, "__seg").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("__n", "__c")))["__c"], "").alias("segment"),
        F.array_distinct(F.sort_array(F.collect_list(F.struct("__n", "__id")))["__id"]).alias("source_ids"),
        F.min("__n").alias("__first"),
    )
    return gathered.withColumn("seg_no", F.row_number().over(W.partitionBy(*key).orderBy("__first"))).select(*key, "seg_no", "segment", "source_ids")


def stream_characters(rows: DataFrame, key: list[str], order: list[str], text: str) -> DataFrame:
    """``key``, row_no (place of the row in its key, from 1), id, page, pos (place in the stream, from 0), c: the rows' characters as one stream."""
    laid = with_offsets(rows, key, order, F.length(F.coalesce(text, F.lit(""))), separator=0)
    chars = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?s)."), F.lit(0))
    each = laid.select(*key, "row_no", "id", "page", "start_at", F.posexplode(chars).alias("k", "c"))
    return each.select(*key, "row_no", "id", "page", (F.col("start_at") + F.col("k")).alias("pos"), "c")


def rebuilt_sentences(boxes: DataFrame, marks: DataFrame, key: list[str], order: list[str], text: str, final_marks: str) -> DataFrame:
    """key, page, sent_idx, segment, box_ids, is_dbl: the rows of each key cut at marks that a model has set.

    ``marks`` has key, pos, mark: the mark behind a character of the stream of all rows that are not double
    (``is_dbl``), in order; marks beyond the stream say nothing. A sentence may span rows and pages; it
    belongs to the page of its first row, and box_ids are its rows in order. A double row is a sentence of its
    own. Both stand in the order of their first rows; sent_idx counts per page from 1. Empty rows give none.
    """
    placed = boxes.withColumn("row_no", F.row_number().over(W.partitionBy(*key).orderBy(*order)))
    double = F.coalesce("is_dbl", F.lit(False))
    chars = stream_characters(placed.where(~double), key, order, text)
    final = marks.where(F.lit(final_marks).contains(F.col("mark")) & (F.col("mark") != "")).select(*key, "pos", F.lit(1).alias("__final")).distinct()
    marked = chars.join(final, [*key, "pos"], "left")
    earlier = W.partitionBy(*key).orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    cut = marked.withColumn("__seg", F.coalesce(F.sum("__final").over(earlier), F.lit(0)))
    main = cut.groupBy(*key, "__seg").agg(F.sort_array(F.collect_list(F.struct("pos", "c", "row_no", "id", "page"))).alias("x")).select(
        *key, F.col("x")[0]["row_no"].alias("row_no"), F.col("x")[0]["pos"].alias("pos"), F.col("x")[0]["page"].alias("page"),
        F.array_join("x.c", "").alias("segment"), F.array_distinct("x.id").alias("box_ids"), F.lit(False).alias("is_dbl"),
    )
    own = placed.where(double & (F.coalesce(text, F.lit("")) != "")).select(
        *key, "row_no", F.lit(-1).cast("bigint").alias("pos"), "page", F.col(text).alias("segment"), F.array("id").alias("box_ids"), F.lit(True).alias("is_dbl")
    )
    place = F.row_number().over(W.partitionBy(*key, "page").orderBy("row_no", "pos"))
    return main.unionByName(own).select(*key, "page", place.alias("sent_idx"), "segment", "box_ids", "is_dbl")


def page_sentences(boxes: DataFrame, page: list[str], order: list[str], text: str, all_marks: str, final_marks: str, least: float = 0.01) -> DataFrame:
    """page, sent_no, segment, box_ids, is_dbl: the sentences of every page.

    Where the marks are at least ``least`` of the ideographs, the page's text is cut behind final marks (a
    sentence may span boxes, and is double if any of them is); else every box is a sentence.
    """
    t = F.coalesce(text, F.lit(""))
    share = F.sum(F.length(t) - F.length(F.translate(t, final_marks, ""))) / F.nullif(F.sum(F.size(cjk_chars(t))), F.lit(0))
    by_marks = boxes.groupBy(*page).agg(F.coalesce(share >= least, F.lit(False)).alias("__cut"))
    placed = boxes.withColumn("row_no", F.row_number().over(W.partitionBy(*page).orderBy(*order))).join(by_marks, page)
    dbl = F.coalesce("is_dbl", F.lit(False)).alias("is_dbl")
    chars = placed.where("__cut").select(*page, "row_no", "id", dbl, F.posexplode(F.regexp_extract_all(t, F.lit("(?s)."), F.lit(0))).alias("k", "c"))
    at = W.partitionBy(*page).orderBy("row_no", "k")
    cut = chars.withColumn("__seg", F.coalesce(F.sum(F.lit(final_marks).contains(F.col("c")).cast("int")).over(at.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    spans = cut.groupBy(*page, "__seg").agg(F.sort_array(F.collect_list(F.struct("row_no", "k", "c", "id"))).alias("x"), F.bool_or("is_dbl").alias("is_dbl")).select(
        *page, F.col("__seg").cast("bigint").alias("at"), F.array_join("x.c", "").alias("segment"), F.array_distinct("x.id").alias("box_ids"), "is_dbl"
    )
    whole = placed.where("NOT __cut").select(*page, F.col("row_no").cast("bigint").alias("at"), t.alias("segment"), F.array("id").alias("box_ids"), dbl)
    number = F.row_number().over(W.partitionBy(*page).orderBy("at"))
    return spans.unionByName(whole).select(*page, number.alias("sent_no"), "segment", "box_ids", "is_dbl")


def restreamed(rows: DataFrame, key: list[str], order: list[str], text: str, separator: str = " ") -> DataFrame:
    """key, sent_no, sentence, start_at, end_at, page, ids: the rows of a key joined to one text and cut into plain sentences.

    A sentence may span rows: page is that of the row in which it begins (the separator belongs to the row before
    it), ids are the rows that it touches, in order. Null texts take no part; empty ones leave a separator.
    """
    have = rows.where(F.col(text).isNotNull())
    laid = with_offsets(have, key, order, F.length(text), separator=len(separator))
    joined = have.groupBy(*key).agg(F.array_join(F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("__t"))))["__t"], separator).alias("__all"))
    spans = joined.select(*key, F.posexplode(sentence_spans(F.col("__all"))).alias("k", "x"))
    spans = spans.select(*key, (F.col("k") + 1).alias("sent_no"), "x.sentence", F.col("x.start_at").cast("bigint").alias("start_at"), F.col("x.end_at").cast("bigint").alias("end_at"))
    placed = as_of(spans, laid.select(*key, "start_at", "page"), key, "start_at", "start_at", "page")
    bounds = laid.select(*key, "id", F.col("start_at").alias("r0"), F.col("end_at").alias("r1"))
    met = overlaps(spans.select(*key, "sent_no", "start_at", "end_at"), bounds, key, "start_at", "end_at", "r0", "r1", bucket=256)
    ids = met.groupBy(*key, "sent_no").agg(F.sort_array(F.collect_list(F.struct("r0", "id")))["id"].alias("ids"))
    return placed.join(ids, [*key, "sent_no"], "left").select(*key, "sent_no", "sentence", "start_at", "end_at", "page", "ids")
