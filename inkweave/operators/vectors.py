"""Sentence vectors: sums over neighbours, similarity, order-preserving m:n alignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions.text import lexical_similarity

# Modes of the alignment, in the order in which they are tried, the least similarity that costs
# nothing, and below what similarity and lexical agreement a pair is suspect.
MODES = [(1, 1), (1, 2), (1, 3), (2, 1), (3, 1), (1, 0), (0, 1), (2, 2)]
FREE = 0.50
SUSPECT_SIMILARITY, SUSPECT_LEXICAL = 0.45, 0.05


def unit(vector: Column) -> Column:
    """A vector of length 1; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return F.transform(vector, lambda x: x.cast("double") / F.when(norm > 0, norm).otherwise(1.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def neighbour_units(rows: DataFrame, key: list[str], order: list[str], vector: str, k: int) -> DataFrame:
    """``rows`` with group_unit: the sum of a row's vector and the next k - 1 of its key, at length 1.

    Null where fewer than k rows are left.
    """
    w = W.partitionBy(*key).orderBy(*order).rowsBetween(0, k - 1)
    gathered = F.collect_list(F.col(vector)).over(w)
    total = F.aggregate(
        F.slice(gathered, 2, k), F.transform(gathered[0], lambda x: x.cast("double")), lambda a, v: F.zip_with(a, v, lambda x, y: x + y.cast("double"))
    )
    return rows.withColumn("group_unit", F.when(F.size(gathered) == k, unit(total)))


def merged_weights(rows: DataFrame, key: list[str], weights: str) -> DataFrame:
    """key, weights: token weights of several rows added up."""
    each = rows.select(*key, F.explode(weights).alias("t", "w")).groupBy(*key, "t").agg(F.sum("w").alias("w"))
    return each.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("t", "w")))).alias(weights))


def aligned(h: np.ndarray, v: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(i, j, di, dj, similarity) along the best path through both sequences of vectors.

    The gain of a step is its similarity s if that is at least FREE, else s - 1; of a skip -1. Of equal
    sums the path found first counts. One sweep over anti-diagonals, each as a whole.
    """
    n, m = len(h), len(v)
    if not n or not m:
        return []

    def sums(x: np.ndarray, k: int) -> np.ndarray:
        c = np.vstack([np.zeros(x.shape[1]), np.cumsum(x, axis=0)])
        s = c[k:] - c[:-k]
        norm = np.linalg.norm(s, axis=1, keepdims=True)
        return s / np.where(norm > 0, norm, 1)

    hs, vs = {k: sums(h, k) for k in (1, 2, 3) if k <= n}, {k: sums(v, k) for k in (1, 2, 3) if k <= m}
    best = np.full((n + 1, m + 1), -np.inf)
    mode = np.full((n + 1, m + 1), -1, np.int8)
    sim: dict[int, np.ndarray] = {}
    for k, (a, b) in enumerate(MODES):
        if a and b and a in hs and b in vs:
            sim[k] = hs[a] @ vs[b].T
    best[0, 0] = 0.0
    # A cell is reached from cells before it in row-major order, so candidates are compared in that order.
    order = sorted(range(len(MODES)), key=lambda k: (-MODES[k][0], -MODES[k][1]))
    for d in range(1, n + m + 1):
        i = np.arange(max(0, d - m), min(n, d) + 1)
        j = d - i
        top, how = np.full(len(i), -np.inf), np.full(len(i), -1, np.int8)
        for k in order:
            a, b = MODES[k]
            pi, pj = i - a, j - b
            ok = (pi >= 0) & (pj >= 0)
            if a and b and k not in sim:
                continue
            got = np.full(len(i), -np.inf)
            s = sim[k][pi[ok], pj[ok]] if a and b else np.zeros(ok.sum())
            got[ok] = best[pi[ok], pj[ok]] + np.where(s >= FREE, s, s - 1)
            better = got > top
            top, how = np.where(better, got, top), np.where(better, np.int8(k), how)
        best[i, j], mode[i, j] = top, how
    out, i, j = [], n, m
    while i or j:
        a, b = MODES[mode[i, j]]
        i, j = i - a, j - b
        out.append((i, j, a, b, round(float(sim[int(mode[i + a, j + b])][i, j]), 3) if a and b else 0.0))
    return out[::-1]


def aligned_vectors(rows: DataFrame, key: list[str], side: str, order: str, vector: str) -> DataFrame:
    """key, pair_no, left, right, similarity: each group's two sides ('l' and 'r') in order, aligned m:n.

    left and right hold the ``order`` values of the step. A group with one side only gives no pair. One task
    per group, which holds a table of its two lengths; a group is one chapter or volume.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        l, r = pdf[pdf[side] == "l"], pdf[pdf[side] == "r"]
        if not len(l) or not len(r):
            return pd.DataFrame(columns=[*key, "pair_no", "left", "right", "similarity"])
        steps = aligned(np.stack(l[vector].to_list()).astype(float), np.stack(r[vector].to_list()).astype(float))
        lo, ro = l[order].tolist(), r[order].tolist()
        made = {k: [pdf[k].iloc[0]] * len(steps) for k in key}
        return pd.DataFrame({**made, "pair_no": range(1, len(steps) + 1), "left": [lo[i : i + a] for i, _, a, _, _ in steps],
                             "right": [ro[j : j + b] for _, j, _, b, _ in steps], "similarity": [s for *_, s in steps]})

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    fields = ", ".join(f"`{k}` {kinds[k]}" for k in key)
    picked = rows.select(*key, side, order, vector).where(F.col(vector).isNotNull())
    return picked.groupBy(*key).applyInPandas(run, f"{fields}, pair_no int, left array<{kinds[order]}>, right array<{kinds[order]}>, similarity double")


def sparse_product(a: Column, b: Column) -> Column:
    """Sum of the products of the weights that two maps share; 0.0 if they share none."""
    shared = F.array_intersect(F.map_keys(a), F.map_keys(b))
    return F.coalesce(F.aggregate(shared, F.lit(0.0), lambda s, k: s + F.try_element_at(a, k) * F.try_element_at(b, k)), F.lit(0.0))


def pair_texts(pairs: DataFrame, left: DataFrame, right: DataFrame, key: list[str], order: str) -> DataFrame:
    """``pairs`` (key, pair_no, left, right, similarity) with ids, texts and scores of both sides.

    ``left`` has key, ``order``, id, text, reading, weights (map<string,double>), ``right`` key, ``order``, id,
    text, weights. Texts of the left are joined without a space, readings and the right's with one; weights of
    several rows are added up. lexical is the agreement of reading and right text, sparse the product of the
    weights (0 for a skip).
    """
    def side(rows: DataFrame, which: str, glue: str, extra: list[str]) -> DataFrame:
        each = pairs.select(*key, "pair_no", F.posexplode(which).alias("__k", order))
        met = each.join(rows.select(*key, order, "id", "text", "weights", *extra), [*key, order])
        added = met.select(*key, "pair_no", F.explode("weights").alias("t", "w")).groupBy(*key, "pair_no", "t").agg(F.sum("w").alias("w"))
        added = added.groupBy(*key, "pair_no").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("t", "w")))).alias(f"{which}_weights"))
        listed = met.groupBy(*key, "pair_no").agg(F.sort_array(F.collect_list(F.struct("__k", "id", "text", *extra))).alias("x"))
        told = [F.array_join(f"x.{e}", " ").alias(f"{which}_{e}") for e in extra]
        return listed.select(*key, "pair_no", F.col("x.id").alias(f"{which}_ids"), F.array_join("x.text", glue).alias(f"{which}_text"), *told).join(added, [*key, "pair_no"], "left")

    at = [*key, "pair_no"]
    met = pairs.join(side(left, "left", "", ["reading"]), at, "left").join(side(right, "right", " ", []), at, "left")
    none, text = F.array().cast("array<string>"), lambda c: F.coalesce(c, F.lit(""))
    return met.select(
        *at, F.coalesce("left_ids", none).alias("left_ids"), F.coalesce("right_ids", none).alias("right_ids"), text("left_text").alias("left_text"),
        text("left_reading").alias("left_reading"), text("right_text").alias("right_text"), "similarity",
        lexical_similarity(text("left_reading"), text("right_text")).alias("lexical"),
        F.round(F.coalesce(sparse_product(F.col("left_weights"), F.col("right_weights")), F.lit(0.0)), 3).alias("sparse"),
    )


def suspects_flagged(pairs: DataFrame, scope: list[str], similarity: str, lexical: str, sparse: str, text: str) -> DataFrame:
    """``pairs`` with suspect and suspect_sparse.

    Both need a low similarity; the first a low lexical score, the second a sparse score below the tenth
    percentile (interpolated, 3 places; 0 without any) of the ``scope``'s pairs with text and a sparse score.
    """
    counts = (F.coalesce(text, F.lit("")) != "") & (F.col(sparse) > 0)
    limit = pairs.groupBy(*scope).agg(F.coalesce(F.round(F.percentile(F.when(counts, F.col(sparse)), 0.1), 3), F.lit(0.0)).alias("__p10"))
    low = F.col(similarity) < SUSPECT_SIMILARITY
    flag = lambda c: F.coalesce(c, F.lit(False))
    return pairs.join(limit, scope).withColumns({"suspect": flag(low & (F.col(lexical) < SUSPECT_LEXICAL)), "suspect_sparse": flag(low & (F.col(sparse) < F.col("__p10")))}).drop("__p10")


def suspect_counts(flagged: DataFrame, scope: list[str]) -> DataFrame:
    """``scope``, pairs, suspects, suspects_sparse."""
    return flagged.groupBy(*scope).agg(F.count("*").alias("pairs"), F.count_if("suspect").alias("suspects"), F.count_if("suspect_sparse").alias("suspects_sparse"))
