"""Parquet tables of a corpus directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """``<directory>/<name>.parquet``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a scan of fewer partitions than there are cores is small, so it is dealt out anew.

    A larger one is left as it is; its rows never travel.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` over the session's shuffle partitions, for costly operators per row.

    Being asked for by number, they are not joined into fewer afterwards because their bytes are few.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def corpus_rows(spark: SparkSession, directory: str, name: str, *columns: str, where: Column | str | None = None, costly: bool = False) -> DataFrame:
    """Each (vol, id) of a row table once, with the given columns only.

    A repeated delivery has the same content, so ``where`` may look at any column but loaded_at and filters the
    scan; what passes is dealt out by its key, and rows equal in all selected columns become one without a
    sort. Rows whose key holds a null are one per content. An empty table stays empty. ``costly`` keeps the
    partitions as they are dealt (see ``dealt``), else few bytes are joined into few partitions.
    """
    df = table(spark, directory, name)
    if where is not None:
        df = df.where(where)
    picked = df.select(*dict.fromkeys(("vol", "id", *columns)))
    return (dealt(picked, "vol", "id") if costly else picked.repartition("vol", "id")).distinct()
