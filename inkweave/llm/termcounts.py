"""Frequency of every distinct term (problem 4): suffix-sorted n-gram counting.

Every record gives, for each of its terms, the suffix that begins there, truncated to ``longest``
terms. Equal suffixes are added up before anything is shuffled; the sums are routed by their first
term (and, for n-grams, a salt from the second, so that a hot term is spread), sorted in reverse
lexicographic order, and one pass with a stack then gives the count and the number of records of
every prefix.

Record sets stay additive: within a record the suffixes are sorted, and each carries how many
leading terms it shares with the one before it (``known``). A prefix no longer than that has been
seen in this record already, so a suffix counts its record only for its prefixes longer than
``known``. No list of record ids is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfc, trim_space

COUNTS = "ngram array<string>, n bigint, records bigint"


def letter_runs(text: Column) -> Column:
    """The maximal runs of letters of a composed text in lower case; null gives an empty list."""
    return F.coalesce(F.regexp_extract_all(F.lower(nfc(text)), F.lit(r"\p{L}+"), F.lit(0)), F.array())


def stack_pass(rows: Iterator[tuple[list[str], int, int]]) -> Iterator[tuple[list[str], int, int]]:
    """(suffix, known, n) in reverse lexicographic order -> (prefix, count, records)."""
    terms: list[str] = []
    counts: list[int] = []
    records: list[int] = []

    def pop(to: int) -> Iterator[tuple[list[str], int, int]]:
        while len(terms) > to:
            n, r = counts.pop(), records.pop()
            yield terms[:], n, r
            terms.pop()
            if counts:
                counts[-1] += n

    for suffix, known, n in rows:
        shared = 0
        for a, b in zip(terms, suffix):
            if a != b:
                break
            shared += 1
        yield from pop(shared)
        for term in suffix[shared:]:
            terms.append(term)
            counts.append(0)
            records.append(0)
        counts[-1] += n
        for k in range(known, len(suffix)):
            records[k] += n
    yield from pop(0)


def _stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[list[str], int, int]]:
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("suffix", "known", "n")))

    schema = pa.schema([("ngram", pa.list_(pa.string())), ("n", pa.int64()), ("records", pa.int64())])
    out: list[tuple[list[str], int, int]] = []
    for row in stack_pass(rows()):
        out.append(row)
        if len(out) == 10_000:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out = []
    if out:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def count_ngrams(records: DataFrame, terms: str, longest: int = 1, salts: int = 16) -> DataFrame:
    """ngram, n, records: how often each n-gram of 1 to ``longest`` terms occurs, and in how many rows.

    ``records`` has one row per record and an array<string> column ``terms``; other columns, whatever
    their names, are not read. A null or empty list gives nothing; null terms in a list are left out;
    a repeated row is another record; an empty table gives no row.
    """
    if longest < 1 or salts < 1:
        raise ValueError("longest and salts must be at least 1")
    own = F.filter(F.col(terms), lambda t: t.isNotNull())
    listed = records.select(own.alias("terms")).where(F.size("terms") > 0)
    if longest == 1:
        suffixes = F.transform("terms", lambda t: F.array(t))
    else:
        suffixes = F.transform(F.sequence(F.lit(1), F.size("terms")), lambda i: F.slice("terms", i, longest))
    at = F.col("sorted")

    def known(suffix: Column, i: Column) -> Column:
        before = F.try_element_at(at, F.when(i > 0, i))
        if longest == 1:
            return F.when(before == suffix, 1).otherwise(0)
        to = F.when(i > 0, F.least(F.size(before), F.size(suffix))).otherwise(0)
        return F.when(to < 1, 0).otherwise(
            F.size(F.filter(F.sequence(F.lit(1), F.greatest(to, F.lit(1))), lambda k: F.slice(before, 1, k) == F.slice(suffix, 1, k)))
        )

    each = (
        listed.select(F.array_sort(suffixes).alias("sorted"))
        .select(F.explode(F.transform(at, lambda s, i: F.struct(s.alias("suffix"), known(s, i).cast("int").alias("known")))).alias("x"))
        .select("x.suffix", "x.known")
    )
    summed = each.groupBy("suffix", "known").agg(F.count("*").alias("n"))
    route = [F.col("suffix")[0]]
    if longest > 1 and salts > 1:
        route.append(F.pmod(F.xxhash64(F.try_element_at("suffix", F.lit(2))), F.lit(salts)))
    counted = (
        summed.repartition(*route)
        .sortWithinPartitions(F.col("suffix").desc(), "known")
        .mapInArrow(_stack, COUNTS)
    )
    if len(route) == 1:
        return counted
    # Only the one-term prefixes can lie in several salts; the rest is complete.
    whole = counted.where(F.size("ngram") > 1)
    parts = counted.where(F.size("ngram") == 1).groupBy("ngram").agg(F.sum("n").alias("n"), F.sum("records").alias("records"))
    return whole.unionByName(parts)


def term_marks(records: DataFrame, terms: str, rare: int, common: float) -> DataFrame:
    """term, n, records, mark: the one-term counts, marked 'rare' (at most ``rare`` records),
    'common' (more than the share ``common`` of all rows, null and empty ones included) or null.

    A term that is both is 'rare'. An empty table gives no row.
    """
    total = records.agg(F.count("*").alias("rows")).scalar()
    counted = count_ngrams(records, terms).select(F.col("ngram")[0].alias("term"), "n", "records")
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") > F.lit(common) * total, "common")
    return counted.withColumn("mark", mark)


def value_terms(value: Column) -> Column:
    """A whole value as a list of one term: composed, trimmed, in lower case; null or blank gives none."""
    term = F.lower(trim_space(nfc(value)))
    return F.when(F.length(term) > 0, F.array(term)).otherwise(F.array().cast("array<string>"))
