"""Sequences inside a row: characters against readings, tokens against tokens, text with its provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.text import CLEANING, SPACE_BEFORE_MARK, cjk_chars, cleaned, normal_block
from inkweave.operators.lexicon import validated_pairs


def paired_readings(rows: DataFrame, key: list[str], text: str, reading: str) -> DataFrame:
    """key, pos, sn, qn: each ideograph with the syllable that stands for it.

    Characters and syllables share no elements, so an alignment of unequal lengths puts its gaps in front:
    both are laid against their ends. A character without a syllable has a null qn. Null texts give no row.
    """
    chars, said = cjk_chars(F.col(text)), F.filter(F.split(F.lower(F.trim(F.coalesce(F.col(reading), F.lit("")))), r"\s+"), lambda s: s != "")
    shift = F.size("__q") - F.size("__c")
    each = rows.select(*key, chars.alias("__c"), said.alias("__q")).where(F.size("__c") > 0).withColumn("__d", shift)
    pairs = F.transform("__c", lambda c, k: F.struct((k + 1).alias("pos"), c.alias("sn"), F.when(k + F.col("__d") >= 0, F.try_element_at("__q", k + F.col("__d") + 1)).alias("qn")))
    return each.select(*key, F.explode(pairs).alias("x")).select(*key, "x.pos", "x.sn", "x.qn")


def sequence_accuracy(rows: DataFrame, key: list[str], text: str, reading: str, similar: DataFrame, readings: DataFrame) -> DataFrame:
    """key, n, black, green, red, accuracy: how the characters of each row go with its reading.

    Distinct pairs are checked once, however often they occur.
    """
    pairs = paired_readings(rows, key, text, reading)
    status = validated_pairs(pairs.select("sn", "qn").distinct(), similar, readings).select(F.col("sn").alias("__s"), F.col("qn").alias("__q"), "status")
    met = pairs.join(status, (F.col("sn") == F.col("__s")) & F.col("qn").eqNullSafe(F.col("__q")))
    count = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    agg = met.groupBy(*key).agg(F.count("*").alias("n"), count("BLACK"), count("GREEN"), count("RED"))
    return agg.withColumn("accuracy", F.round((F.col("black") + F.col("green")) / F.col("n"), 4))


def token_similarity(a: Column, b: Column) -> Column:
    """1 - distance / length of the longer token list; null lists are empty; two empty lists are alike.

    Each distinct token of the two lists stands for one character, so the distance is that of two strings.
    """
    none = F.array().cast("array<string>")
    x, y = F.coalesce(a, none), F.coalesce(b, none)
    both = F.array_union(x, y)
    coded = lambda tokens: F.array_join(F.transform(tokens, lambda t: _letter(F.array_position(both, t).cast("int"))), "")
    longest = F.greatest(F.size(x), F.size(y), F.lit(1))
    return F.when(x == y, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(coded(x), coded(y)) / longest)


_LETTERS = "".join(map(chr, range(0xE000, 0xF900)))


def _letter(number: Column) -> Column:
    """A character of its own for every number from 1: of the private use area, beyond it of the planes behind."""
    beyond = F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint") + 0xF0000), 8, "0")), "UTF-32")
    return F.when(number <= len(_LETTERS), F.substring(F.lit(_LETTERS), number, F.lit(1))).otherwise(beyond)


# ---------------------------------------------------------------- provenance

_STEPS = [(r"-\s*\n\s*", ""), (r"\s*\n\s*", " "), (r"[ \t]{2,}", " "), (r"^ +| +$", ""), *((p, t) for _, p, t in CLEANING), (r"\s{2,}", " "), (SPACE_BEFORE_MARK, "$1"), (r"^ +| +$", "")]


def _pieces(text: Column, pattern: str) -> Column:
    """A text as an array in which stretches that match and those between them take turns, beginning with one between.

    The bounds are set as control characters, which a page's text does not hold.
    """
    return F.split(F.regexp_replace(text, f"({pattern})", "\x02$1\x03"), "[\x02\x03]")


def _replayed(state: Column, pattern: str, to: str) -> Column:
    """One replacement on (text, places): kept characters keep their places; new ones take that of the match's first."""
    parts = F.transform(_pieces(state["text"], pattern), lambda p, k: F.struct(p.alias("p"), (k % 2 == 1).alias("hit")))
    new = lambda p: F.regexp_replace(p, pattern, to) if to == "$1" else F.lit(to)
    start = F.struct(F.lit("").alias("text"), F.array().cast("array<int>").alias("places"), F.lit(0).alias("at"))

    def step(a: Column, x: Column) -> Column:
        n = F.length(x["p"])
        here = F.slice(state["places"], a["at"] + 1, n)
        made = new(x["p"])
        # A kept last group ends the match, so its places are the last ones.
        moved = F.slice(here, n - F.length(made) + 1, F.length(made)) if to == "$1" else F.transform(F.slice(here, F.lit(1), F.least(n, F.lit(len(to)))), lambda v: v)
        text = F.concat(a["text"], F.when(x["hit"], made).otherwise(x["p"]))
        places = F.concat(a["places"], F.when(x["hit"], moved).otherwise(here))
        return F.struct(text.alias("text"), places.alias("places"), (a["at"] + n).alias("at"))

    return F.aggregate(parts, start, step, lambda a: F.struct(a["text"].alias("text"), a["places"].alias("places")))


def with_provenance(df: DataFrame, text: str) -> DataFrame:
    """``df`` with clean and places: the text after joining lines and cleaning, and for each of its characters
    the place (from 0) in the original. Places are null where the replay differs from the plain cleaner.

    Every rule is a step of its own, taken only by texts that it changes; the rest passes untouched.
    """
    t = F.coalesce(text, F.lit(""))
    begin = F.struct(t.alias("text"), F.when(F.length(t) > 0, F.sequence(F.lit(0), F.greatest(F.length(t) - 1, F.lit(0)))).otherwise(F.array().cast("array<int>")).alias("places"))
    made = df.withColumn("__s", begin)
    for pattern, to in _STEPS:
        made = made.withColumn("__s", F.when(F.col("__s.text").rlike(pattern), _replayed(F.col("__s"), pattern, to)).otherwise(F.col("__s")))
    made = made.withColumn("clean", cleaned(normal_block(F.col(text)))[0])
    return made.withColumn("places", F.when(F.col("__s.text") == F.col("clean"), F.col("__s.places"))).drop("__s")


def mapped_characters(text: Column, pairs: str) -> tuple[Column, Column]:
    """(text with each first character of ``pairs`` ('aA bB ...') replaced by the second, how many were)."""
    a, b = ("".join(p[k] for p in pairs.split()) for k in (0, 1))
    return F.translate(text, a, b), F.length(text) - F.length(F.translate(text, a, ""))
