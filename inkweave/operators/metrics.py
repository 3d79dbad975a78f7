"""Quality figures: histograms, ranks, conditional counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The edges of the histograms of confidence and similarity.
CONF_EDGES = [0.0, 0.3, 0.5, 0.7, 0.8, 0.9, 1.0001]
SIM_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 1.0001]


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """bin, lo, hi, n: [lo, hi) each, the last closed; values outside and nulls are left out; empty bins have 0."""
    spark, last = df.sparkSession, len(edges) - 2
    bins = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(zip(edges, edges[1:]))], "bin int, lo double, hi double")
    v, which = F.col(value), F.lit(None).cast("int")
    for k, (a, b) in reversed(list(enumerate(zip(edges, edges[1:])))):
        which = F.when((v >= a) & ((v <= b) if k == last else (v < b)), k).otherwise(which)
    counted = df.select(which.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    return F.broadcast(bins).join(counted, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def rank_value(df: DataFrame, key: list[str], value: str, fraction: float) -> DataFrame:
    """key, n, ranked: the value at rank min(n - 1, floor(fraction * n)), from 0, in ascending order; nulls are left out.

    Values are counted first, so the window runs over distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*key, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(W.partitionBy(*key).orderBy("v"))
    total = F.sum("c").over(W.partitionBy(*key))
    # Decimal arithmetic, as 0.95 * 20 in doubles may fall below 19.
    at = F.least(total - 1, F.floor(F.lit(str(fraction)).cast("decimal(10,6)") * total.cast("decimal(18,0)")).cast("bigint"))
    hit = counts.withColumns({"upto": upto, "n": total, "at": at}).where((F.col("upto") > F.col("at")) & (F.col("upto") - F.col("c") <= F.col("at")))
    return hit.select(*key, "n", F.col("v").alias("ranked"))


def rule_hits(df: DataFrame, fired: str) -> DataFrame:
    """rule, n: in how many rows each rule fired."""
    return df.select(F.explode(fired).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.greatest(whole, F.lit(1)), 2)
