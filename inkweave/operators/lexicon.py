"""Reading lexicons: lookup, inversion, merging by priority, and the check of a character against a reading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions.text import CJK, cjk_chars, normal_tone

def transliterated(df: DataFrame, key: list[str], text: str, lexicon: DataFrame, char: str, reading: str, default: str = "?", ranges: str = CJK) -> DataFrame:
    """key, readings: the reading of every ideograph of a text in order, joined by spaces.

    A character without a reading gives ``default``; texts without ideographs an empty string; null
    texts too. ``key`` must be unique. Duplicate characters in the lexicon: the smallest reading counts.
    """
    first = lexicon.where(F.col(reading).isNotNull() & F.col(char).isNotNull()).groupBy(F.col(char).alias("__c")).agg(F.min(reading).alias("__r"))
    chars = df.select(*key, F.posexplode_outer(cjk_chars(F.col(text), ranges)).alias("__pos", "__c"))
    met = chars.join(first, "__c", "left")
    word = F.when(F.col("__c").isNotNull(), F.coalesce("__r", F.lit(default)))
    listed = met.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(word.isNotNull(), F.struct("__pos", word.alias("w"))))).alias("x"))
    return listed.select(*key, F.array_join("x.w", " ").alias("readings"))


def inverted(lexicon: DataFrame, key: str, values: str, out_key: str = "value", out_values: str = "keys") -> DataFrame:
    """Multimap the other way round: each value with its keys, sorted and distinct. Null keys and values are left out."""
    each = lexicon.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.explode(values).alias(out_key)).where(F.col(out_key).isNotNull())
    return each.groupBy(out_key).agg(F.sort_array(F.collect_set("k")).alias(out_values))


def merged_by_priority(sources: list[tuple[str, DataFrame]], key: str, value: str) -> DataFrame:
    """key, value, source, all_values: the value of the first source that has one, and all of them in that order, distinct."""
    tagged = [df.select(F.col(key).alias("key"), F.col(value).alias("value")).where("key is not null and value is not null and value <> ''")
              .withColumns({"rank": F.lit(k), "source": F.lit(name)}) for k, (name, df) in enumerate(sources)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    every = every.distinct()
    one = every.groupBy("key").agg(
        F.min(F.struct("rank", "value", "source")).alias("top"), F.array_sort(F.collect_set(F.struct("rank", "value"))).alias("x")
    )
    return one.select("key", F.col("top.value").alias("value"), F.col("top.source").alias("source"), F.array_distinct("x.value").alias("all_values"))


def inverted_in_order(lexicon: DataFrame, key: str, values: str, order: str, out_key: str = "value", out_values: str = "keys") -> DataFrame:
    """Multimap the other way round, the keys of a value in the order of their rows and distinct. Nulls are left out."""
    each = lexicon.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(order).alias("o"), F.posexplode(values).alias("p", out_key)).where(F.col(out_key).isNotNull())
    listed = each.groupBy(out_key).agg(F.array_sort(F.collect_list(F.struct("o", "p", "k"))).alias("x"))
    return listed.select(out_key, F.array_distinct("x.k").alias(out_values))


def variant_reading(variants: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """char, reading: of the first variant in code point order that any source reads; of its sources the first.

    ``variants`` has char, variants (an array); each source char, readings (an array, its first counts).
    """
    each = variants.select("char", F.explode("variants").alias("v"))
    said = None
    for k, source in enumerate(sources):
        one = source.where(F.size("readings") > 0).select(F.col("char").alias("v"), F.col("readings")[0].alias("reading"), F.lit(k).alias("rank"))
        said = one if said is None else said.unionByName(one)
    return each.join(said, "v").groupBy("char").agg(F.min_by("reading", F.struct("v", "rank")).alias("reading"))


def built_readings(readings: DataFrame, kanji: DataFrame, supplement: DataFrame, taught: DataFrame, variants: DataFrame) -> DataFrame:
    """char, reading, all_readings, source of every ideograph that any source reads.

    ``readings``, ``kanji`` and ``taught`` have char, readings; ``supplement`` char, reading; ``variants`` char,
    variants. The primary reading is that of the first source in this order: readings, kanji, supplement,
    taught, a variant's. all_readings has the primary and those of readings, kanji and taught, in order, distinct.
    """
    borrowed = variant_reading(variants, [readings, kanji])
    tagged = [
        readings.select("char", F.lit("readings").alias("source"), F.lit(0).alias("rank"), "readings"),
        kanji.select("char", F.lit("kanji").alias("source"), F.lit(1).alias("rank"), "readings"),
        supplement.select("char", F.lit("supplement").alias("source"), F.lit(2).alias("rank"), F.array(normal_tone(F.col("reading"))).alias("readings")),
        taught.select("char", F.lit("taught").alias("source"), F.lit(3).alias("rank"), "readings"),
        borrowed.select("char", F.lit("variant").alias("source"), F.lit(4).alias("rank"), F.array("reading").alias("readings")),
    ]
    every = reduce(DataFrame.unionByName, tagged).where((F.size("readings") > 0) & F.col("char").rlike(f"^{CJK}$"))
    listed = every.groupBy("char").agg(F.array_sort(F.collect_list(F.struct("rank", "source", "readings"))).alias("s"))
    first = F.col("s")[0]
    primary = first["readings"][0]
    shown = F.flatten(F.transform(F.filter("s", lambda x: x["rank"].isin(0, 1, 3)), lambda x: x["readings"]))
    every_one = F.array_distinct(F.filter(F.concat(F.array(primary), shown), lambda r: r != ""))
    return listed.select("char", primary.alias("reading"), every_one.alias("all_readings"), first["source"].alias("source"))


def built_words(readings: DataFrame, sample: DataFrame) -> DataFrame:
    """key, values: every reading with its characters, merged with a sample (key, values); sorted and distinct."""
    turned = readings.select(F.explode("all_readings").alias("key"), F.col("char").alias("v"))
    given = sample.select("key", F.explode("values").alias("v"))
    return turned.union(given).groupBy("key").agg(F.sort_array(F.collect_set("v")).alias("values"))


def built_similar(sample: DataFrame, variants: DataFrame) -> DataFrame:
    """key, values: look-alikes of a character: the curated ones in their order, then its variants, last itself; distinct."""
    met = sample.select(F.col("key").alias("char"), F.col("values").alias("c")).join(variants, "char", "full")
    none = F.array().cast("array<string>")
    values = F.array_distinct(F.concat(F.coalesce("c", none), F.sort_array(F.coalesce("variants", none)), F.array("char")))
    return met.select(F.col("char").alias("key"), values.alias("values"))


def validated_pairs(pairs: DataFrame, similar: DataFrame, readings: DataFrame) -> DataFrame:
    """``pairs`` (sn, qn, others kept) with status and corrected.

    BLACK: the character is among those of the reading. GREEN: one of its look-alikes (``similar``: key,
    values, best first) is; the first such corrects it. RED: neither. A character without look-alikes has itself.
    """
    s2 = readings.select(F.lower(F.trim("key")).alias("__q"), F.col("values").alias("__s2")).groupBy("__q").agg(F.flatten(F.collect_list("__s2")).alias("__s2"))
    s1 = similar.select(F.col("key").alias("sn"), F.col("values").alias("__s1"))
    met = pairs.withColumn("__q", F.lower(F.trim("qn"))).join(s2, "__q", "left").join(s1, "sn", "left")
    have = F.coalesce("__s2", F.array().cast("array<string>"))
    alike = F.coalesce("__s1", F.array("sn"))
    first = F.try_element_at(F.filter(alike, lambda c: F.array_contains(have, c)), F.lit(1))
    status = F.when(F.array_contains(have, F.col("sn")), "BLACK").when(first.isNotNull(), "GREEN").otherwise("RED")
    return met.withColumn("status", status).withColumn("corrected", F.when(F.col("status") == "GREEN", first)).drop("__q", "__s1", "__s2")


def oov_vocabulary(rows: DataFrame, tokens: Column, vocabulary: DataFrame, id_column: str = "id") -> DataFrame:
    """token, count, example_id: tokens outside the vocabulary (column token), in how many rows, and the least such id."""
    each = rows.select(F.col(id_column).alias("id"), F.explode(F.array_distinct(tokens)).alias("token"))
    # Counting first leaves one row per distinct token for the anti-join.
    counted = each.groupBy("token").agg(F.count("*").alias("count"), F.min("id").alias("example_id"))
    return counted.join(vocabulary.select("token").distinct(), "token", "left_anti").select("token", "count", "example_id")


def oov_rates(rows: DataFrame, key: list[str], tokens: Column, vocabulary: DataFrame) -> DataFrame:
    """key, n_tokens, oov_rate: repeated tokens count each time; no tokens: 0.0."""
    each = rows.select(*key, F.explode_outer(tokens).alias("token"))
    known = vocabulary.select("token").distinct().withColumn("known", F.lit(1))
    met = each.join(known, "token", "left")
    agg = met.groupBy(*key).agg(F.count("token").alias("n"), F.count(F.when(F.col("token").isNotNull() & F.col("known").isNull(), 1)).alias("oov"))
    rate = F.round(F.when(F.col("n") > 0, F.col("oov") / F.col("n")).otherwise(0.0), 3)
    return agg.select(*key, F.col("n").alias("n_tokens"), rate.alias("oov_rate"))


def known_rows(rows: DataFrame, key: list[str], tokens: Column, vocabulary: DataFrame, least: int = 2, ratio: float = 0.5) -> DataFrame:
    """key, n, known: rows of at least ``least`` tokens of which at least ``ratio`` are in the vocabulary.

    An empty vocabulary keeps every row, as nothing can be said about it; known is null then.
    """
    each = rows.select(*key, F.explode_outer(tokens).alias("token"))
    met = each.join(vocabulary.select("token").distinct().withColumn("__hit", F.lit(1)), "token", "left")
    agg = met.groupBy(*key).agg(F.count("token").alias("n"), F.count("__hit").alias("__known"))
    empty = vocabulary.limit(1).agg(F.count("*") == 0).scalar()
    kept = agg.where(empty | ((F.col("n") >= least) & (F.col("__known") >= ratio * F.col("n"))))
    return kept.select(*key, "n", F.round(F.when(~empty, F.col("__known") / F.col("n")), 3).alias("known"))


def unknown_tokens(rows: DataFrame, key: list[str], tokens: Column, vocabulary: DataFrame) -> DataFrame:
    """key, unknown: the tokens of each row outside the vocabulary, each once, in order of appearance. Rows without any are left out."""
    each = rows.select(*key, F.posexplode(F.array_distinct(tokens)).alias("k", "token"))
    out = each.join(vocabulary.select("token").distinct(), "token", "left_anti")
    return out.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("k", "token"))).alias("x")).select(*key, F.col("x.token").alias("unknown"))


def ordered_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
