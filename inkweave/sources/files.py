"""File formats of a corpus: records as JSON lines, dictionaries, readings, rules, page images; and their sinks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkweave.functions.text import from_code_point, normal_tone

_PLACE = [("vol", "string"), ("id", "string"), ("chapter", "int"), ("page", "int")]
_FIELDS = {
    "vi_boxes": [*_PLACE, ("box_idx", "int"), ("bbox", "array<int>"), ("text", "string")],
    "vi_sentences": [*_PLACE, ("sent_idx", "int"), ("text", "string"), ("raw_text", "string"), ("n_tokens", "int"), ("oov_rate", "double"), ("box_ids", "array<string>")],
    "han_boxes": [*_PLACE, ("box_idx", "int"), ("bbox", "array<int>"), ("sinonom", "string"), ("am_han_viet", "string"), ("conf", "double"), ("is_dbl", "boolean")],
    "han_sentences": [*_PLACE, ("sent_idx", "int"), ("sinonom", "string"), ("am_han_viet", "string"), ("box_ids", "array<string>"), ("is_dbl", "boolean")],
    "alignment": [("vol", "string"), ("pair_idx", "int"), ("han_ids", "array<string>"), ("vie_ids", "array<string>"), ("sinonom", "string"), ("am_han_viet", "string"),
                  ("vietnamese", "string"), ("similarity", "double"), ("lexical", "double"), ("bge_sparse", "double"), ("suspect", "boolean"), ("suspect_bge", "boolean")],
    "oov_vocab": [("vol", "string"), ("chapter", "int"), ("token", "string"), ("count", "int"), ("example_id", "string")],
    "hanviet": [("sinonom_char", "string"), ("am_han_viet", "string"), ("all_readings", "string")],
}
#: The record schemas, by table, as DDL.
SCHEMAS = {name: ", ".join(f"`{f}` {t}" for f, t in fields) for name, fields in _FIELDS.items()}


def _missing(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)


def records(spark: SparkSession, path: str, table: str, optional: bool = False) -> DataFrame:
    """JSON lines with the fixed schema of ``table``: missing fields are null, blank lines left out, unknown fields dropped.

    An optional path that is missing gives an empty table.
    """
    if optional and _missing(spark, path):
        return spark.createDataFrame([], SCHEMAS[table])
    return spark.read.schema(SCHEMAS[table]).json(path)


def document(spark: SparkSession, path: str) -> DataFrame:
    """A whole-file JSON document as one row."""
    return spark.read.option("multiLine", True).json(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, line (an order of the lines within a file) of every line. A large file is read in splits, each in order."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", at.alias("line"))


def dictionary(spark: SparkSession, path: str, lower_keys: bool = False) -> DataFrame:
    """key, values of lines 'key:v1 v2 ...'. Blank lines, comments and lines without a colon are skipped; of a key
    given twice the last line counts; values keep their order."""
    kept = _lines(spark, path).where("trim(value) <> '' AND NOT startswith(ltrim(value), '#') AND contains(value, ':')")
    parts = F.split("value", ":", 2)
    key = F.trim(F.lower(parts[0]) if lower_keys else parts[0])
    values = F.filter(F.split(F.trim(parts[1]), r"\s+"), lambda v: v != "")
    return kept.select(key.alias("key"), values.alias("values"), "line").groupBy("key").agg(F.max_by("values", "line").alias("values"))


def unihan_readings(spark: SparkSession, path: str, field: str = "kVietnamese") -> DataFrame:
    """char, readings of a tab-separated code point file: one field, tones placed alike, in order and distinct."""
    rows = _lines(spark, path).where("NOT startswith(value, '#')").select(F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    rows = rows.where(F.col("f")[1] == field)
    return rows.select(from_code_point(F.col("f")[0]).alias("char"), F.array_distinct(F.transform(F.split(F.trim(F.col("f")[2]), r"\s+"), lambda r: normal_tone(r))).alias("readings"))


def unihan_variants(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """char, variants: the variants of all given fields without their provenance, sorted and distinct."""
    rows = _lines(spark, path).where("NOT startswith(value, '#')").select(F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    each = rows.where(F.col("f")[1].isin(*fields)).select(from_code_point(F.col("f")[0]).alias("char"), F.explode(F.split(F.trim(F.col("f")[2]), r"\s+")).alias("v"))
    named = each.select("char", from_code_point(F.regexp_replace("v", "<.*$", "")).alias("v")).where("v <> char")
    return named.groupBy("char").agg(F.sort_array(F.collect_set("v")).alias("variants"))


def kanji_readings(spark: SparkSession, path: str) -> DataFrame:
    """char, readings of a JSON array of [char, onyomi, kunyomi, ...]: the second field, else the third; tones placed
    alike, in order and distinct. The first entry of a character that has any counts."""
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("k", "r"))
    field = lambda k: F.nullif(F.try_element_at("r", F.lit(k)), F.lit(""))
    said = F.split(F.trim(F.coalesce(field(2), field(3), F.lit(""))), r"\s+")
    listed = F.array_distinct(F.filter(F.transform(said, lambda x: normal_tone(x)), lambda x: x != ""))
    named = rows.select(F.col("r")[0].alias("char"), listed.alias("readings"), "k").where(F.size("readings") > 0)
    return named.groupBy("char").agg(F.min_by("readings", "k").alias("readings"))


def listed_readings(spark: SparkSession, path: str) -> DataFrame:
    """key, values of a CSV with a header whose second field lists readings (['a', 'b']): each reading in lower case
    with its characters, sorted. Rows without a character or readings are skipped."""
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    char, said = (F.trim(F.col(f"`{c}`")) for c in rows.columns[:2])
    each = rows.where((char != "") & (said != "")).select(char.alias("v"), F.explode(F.split(F.regexp_replace(said, r"^\[|\]$", ""), ",")).alias("r"))
    word = F.lower(F.trim(F.regexp_replace("r", "^[\\s'\"]+|[\\s'\"]+$", "")))
    return each.select("v", word.alias("key")).where("key <> ''").groupBy("key").agg(F.sort_array(F.collect_set("v")).alias("values"))


def reading_table(spark: SparkSession, path: str) -> DataFrame:
    """The reading table from CSV with a header. A missing file gives an empty table."""
    if _missing(spark, path):
        return spark.createDataFrame([], SCHEMAS["hanviet"])
    return spark.read.option("header", True).schema(SCHEMAS["hanviet"]).csv(path)


def phrase_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(wrong, correct) of a rule file in its order; comments, the header and incomplete rows are skipped.

    Such files are written by hand, so they are gathered. A missing file has no rules.
    """
    if _missing(spark, path):
        return []
    kept = _lines(spark, path).where("trim(value) <> '' AND NOT startswith(ltrim(value), '#')")
    parsed = kept.select(F.from_csv("value", "wrong string, correct string").alias("r"), "line").select(F.trim("r.wrong").alias("wrong"), F.trim("r.correct").alias("correct"), "line")
    rows = parsed.where("wrong <> '' AND lower(wrong) <> 'wrong' AND correct IS NOT NULL").orderBy("line").collect()
    return [(r.wrong, r.correct) for r in rows]


def rule_table(spark: SparkSession, path: str, columns: list[str], last_wins: bool = True) -> DataFrame:
    """Comma-separated rules: comments, a header and rows with fewer than two fields are skipped; one row per first field."""
    kept = _lines(spark, path).where("trim(value) <> '' AND NOT startswith(ltrim(value), '#')")
    parsed = kept.select(F.from_csv("value", ", ".join(f"`{c}` string" for c in columns)).alias("r"), "line").select("r.*", "line")
    a, b = columns[:2]
    parsed = parsed.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.trim(a) != F.lit(a)))
    pick = F.max_by if last_wins else F.min_by
    rest = [pick(F.trim(c), "line").alias(c) for c in columns[1:]]
    return parsed.groupBy(F.trim(a).alias(a)).agg(*rest)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """token: trimmed lines in lower case, distinct. A missing file gives an empty table."""
    if _missing(spark, path):
        return spark.createDataFrame([], "token string")
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("token")).where("token <> ''").distinct()


def page_images(spark: SparkSession, path: str) -> DataFrame:
    """path, page (the first number of the file's name), content of image files."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.regexp_extract(name, r"([0-9]+)", 1).try_cast("int").alias("page"), "content")


def ink_share(content: Column) -> Column:
    """Share of bytes below 128 of raw gray bytes; an empty content has none."""

    @F.pandas_udf("double")
    def share(s: pd.Series) -> pd.Series:
        return s.map(lambda b: float((np.frombuffer(b, np.uint8) < 128).mean()) if b else 0.0)

    return share(content)


# ---------------------------------------------------------------- sinks


def write_records(df: DataFrame, path: str) -> int:
    """JSON lines, one folder per volume where there is one; returns the number of rows written, counted on the way."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    (writer.partitionBy("vol") if "vol" in df.columns else writer).json(path)
    return int(seen.get["n"])


def write_dictionary(df: DataFrame, path: str, joiner: str = " ") -> None:
    """Lines 'key:values' of (key, values), in code point order of the keys."""
    df.select("key", F.concat_ws(":", "key", F.array_join("values", joiner)).alias("value")).orderBy("key").select("value").write.mode("overwrite").text(path)


def write_readings(df: DataFrame, path: str) -> None:
    """The reading table as CSV with a header, by character."""
    df.select("sinonom_char", "am_han_viet", "all_readings").orderBy("sinonom_char").write.mode("overwrite").option("header", True).csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """One JSON document per row, as a line of text; meant for a report of one row."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
