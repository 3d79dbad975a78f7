"""Where sentences end in Chinese text without marks (problem 3): every gap scored by its surroundings.

A gap between two characters has seven grams: the one, two and three characters before it, those behind
it, and the two that it parts. Numerals count as one. Their weights are fitted (logistic regression) on
punctuated rows with the marks taken away: a sentence's end is a case, any other gap is none. Applied, the
grams of every gap meet the weights in broadcast joins, so scoring stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.text import let

#: Bounds of the labelled sample: rows, and characters of a row. They bound the weights that are broadcast.
LABELLED, LONGEST = 5000, 2000
#: A gram that occurs less often in the sample says nothing.
LEAST = 3
NUMERALS = "元正〇一二三四五六七八九十百千萬"
KINDS = ("l1", "l2", "l3", "r1", "r2", "r3", "x")
_BEFORE, _BEHIND, _NUMBER = "^", "$", "#"


class Gaps:
    """The weights of the grams, by kind, and of the gap itself."""

    def __init__(self, weights: dict[str, dict[str, float]], base: float) -> None:
        self.weights, self.base = weights, base

    @classmethod
    def fit(cls, marked: list[str | None], boundary: str) -> Gaps:
        """From texts with a boundary character behind every sentence but the last; what is no letter or digit is skipped."""
        codes, ends = [], []
        for t in marked:
            letters: list[str] = []
            last: list[bool] = []
            for c in t or "":
                if c == boundary:
                    if last:
                        last[-1] = True
                elif c.isalnum():
                    letters.append(_NUMBER if c in NUMERALS else c)
                    last.append(False)
            if len(letters) > 1:
                codes += map(ord, [*_BEFORE * 3, *letters, *_BEHIND * 3])
                ends += [-1, -1, -1, *(int(x) for x in last[:-1]), -1, -1, -1, -1]  # no gap behind the last letter
        c, y = np.array(codes, np.int64), np.array(ends, int)
        at = np.flatnonzero(y >= 0)
        if not len(at):
            return cls({k: {} for k in KINDS}, -1.0)
        left = [c[at - k] for k in range(3)]
        right = [c[at + 1 + k] for k in range(3)]
        keys = [left[0], left[1] << 21 | left[0], left[2] << 42 | left[1] << 21 | left[0], right[0], right[0] << 21 | right[1], right[0] << 42 | right[1] << 21 | right[2], left[0] << 21 | right[0]]
        columns, names, n = [], [], 1  # 0 stands for a gram without weight
        for key in keys:
            value, where, times = np.unique(key, return_inverse=True, return_counts=True)
            number = np.zeros(len(value), int)
            kept = np.flatnonzero(times >= LEAST)
            number[kept] = np.arange(n, n + len(kept))
            n += len(kept)
            columns.append(number[where])
            names.append(value[kept])
        w, base = _logistic(np.stack(columns, 1), y[at].astype(float), n)
        out, n = {}, 1
        for kind, value in zip(KINDS, names):
            part, n = w[n : n + len(value)], n + len(value)
            out[kind] = {_gram(int(v), kind): round(float(x), 4) for v, x in zip(value, part) if abs(x) >= 0.01}
        return cls(out, round(base, 4))


def _gram(key: int, kind: str) -> str:
    chars = []
    while key:
        chars.append(chr(key & 0x1FFFFF))
        key >>= 21
    return ("|" if kind == "x" else "").join(reversed(chars))


def _logistic(x: np.ndarray, y: np.ndarray, size: int, rounds: int = 6, rate: float = 0.3, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights of indicator features (columns hold numbers of weights, 0 has none) by steps scaled to their own history."""
    w, seen, base, order = np.zeros(size), np.full(size, 1e-2), 0.0, np.random.default_rng(0)
    for _ in range(rounds):
        rows = order.permutation(len(y))
        for part in _batches(rows, 512):
            f = x[part]
            off = 1 / (1 + np.exp(-(w[f].sum(1) + base))) - y[part]
            step = np.bincount(f.ravel(), np.repeat(off, f.shape[1]), size) + ridge * w
            step[0] = 0.0
            seen += step * step
            w -= rate * step / np.sqrt(seen)
            base -= 0.001 * off.sum()
    return w, float(base)


def _batches(rows: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for k in range(0, len(rows), size):
        yield rows[k : k + size]


def _letters(plain: Column) -> Column:
    """Every letter or digit with what stands behind it."""
    return F.regexp_extract_all(plain, F.lit(r"[\p{L}\p{N}][^\p{L}\p{N}]*+"), F.lit(0))


def _gaps(plain: Column) -> Column:
    """An entry 0 for the text itself, and one for the gap behind each letter but the last with its grams."""
    one = lambda t: F.translate(F.substring(t, 1, 1), NUMERALS, _NUMBER * len(NUMERALS))
    edge = lambda c: F.array(*[F.lit(c)] * 3)
    none = F.struct(F.lit(0).alias("k"), *(F.lit(None).cast("string").alias(kind) for kind in KINDS))

    def each(p: Column) -> Column:
        at = lambda k: F.element_at(p, k)
        grams = lambda k: F.struct(
            k.alias("k"), at(k + 3).alias("l1"), F.concat(at(k + 2), at(k + 3)).alias("l2"), F.concat(at(k + 1), at(k + 2), at(k + 3)).alias("l3"),
            at(k + 4).alias("r1"), F.concat(at(k + 4), at(k + 5)).alias("r2"), F.concat(at(k + 4), at(k + 5), at(k + 6)).alias("r3"), F.concat_ws("|", at(k + 3), at(k + 4)).alias("x"),
        )
        n = F.size(p) - 6
        return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), grams)).otherwise(F.array())

    return F.concat(F.array(none), let(F.concat(edge(_BEFORE), F.transform(_letters(plain), one), edge(_BEHIND)), each))


def cut_bare(rows: DataFrame, keep: tuple[str, ...], raw: str, plain: str, model: Gaps) -> DataFrame:
    """``keep`` columns, ``raw``, __cuts: behind which letters (from 1) of the plain text a sentence ends, in order.

    Only an entry per text and its boundaries are grouped, by the key that the rows are dealt out by already.
    """
    spark = rows.sparkSession
    each = rows.select(*keep, F.col(raw).alias("__r"), F.xxhash64(raw).alias("__h"), F.explode(_gaps(F.col(plain))).alias("__g"))
    each = each.select(*keep, "__h", F.when(F.col("__g.k") == 0, F.col("__r")).alias("__r"), F.col("__g.k").alias("__k"), *(F.col(f"__g.{kind}").alias(f"__{kind}") for kind in KINDS))
    score = F.lit(model.base)
    for kind in KINDS:
        known = spark.createDataFrame(list(model.weights[kind].items()), f"__{kind} string, __w_{kind} double")
        each = each.join(F.broadcast(known), f"__{kind}", "left").drop(f"__{kind}")
        score = score + F.coalesce(f"__w_{kind}", F.lit(0.0))
    kept = each.where((F.col("__k") == 0) | (score > 0)).select(*keep, "__h", "__r", "__k")
    texts = kept.groupBy(*keep, "__h").agg(
        F.max("__r").alias(raw), F.count_if(F.col("__k") == 0).alias("__n"), F.sort_array(F.collect_set(F.when(F.col("__k") > 0, F.col("__k")))).alias("__cuts")
    )
    # A repeated row gives its boundaries again.
    return texts.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).drop("__n", "__h")


def with_breaks(plain: Column, cuts: Column, boundary: str) -> Column:
    """The text with the boundary character behind the letters that end a sentence."""
    head = F.regexp_extract(plain, r"^[^\p{L}\p{N}]*", 0)
    body = F.transform(_letters(plain), lambda t, k: F.when(F.array_contains(cuts, k + 1), F.concat(t, F.lit(boundary))).otherwise(t))
    return F.concat(head, F.array_join(body, ""))
