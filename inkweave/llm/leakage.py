"""Evaluation passages inside training text (problem 8).

Both sides are brought to units: NFKC, lower case, no invisible characters; a unit is one ideograph
or a maximal run of other letters and digits. The test side's windows of ``window`` units form a hash
set that is broadcast (its size is checked first). Training documents are scanned window by window:
units become numbers, windows rolling hashes, hits of the hash are verified on the units themselves.
Where the test side is too large to broadcast, its windows are joined by a shuffle instead.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfkc, strip_ignorable

#: Most characters of test texts whose windows are broadcast.
MOST_CHARS = 20_000_000
UNIT = r"\p{IsIdeographic}|[\p{L}\p{N}&&[^\p{IsIdeographic}]]+"
_UNITS = regex.compile(r"(?V1)\p{Ideographic}|[\p{L}\p{N}--\p{Ideographic}]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def folded(text: Column) -> Column:
    """What does not matter taken out: invisible characters, compatibility forms, letter case."""
    return F.lower(nfkc(strip_ignorable(text)))


def units(text: Column) -> Column:
    """The units of a text as an array; null gives an empty one."""
    return F.coalesce(F.regexp_extract_all(folded(text), F.lit(UNIT), F.lit(0)), F.array())


class Windows:
    """The windows of the test items."""

    def __init__(self, items: list[tuple[int, str]], window: int) -> None:
        self.window = window
        self.number: dict[str, int] = {}
        self.items: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            ids = [self.number.setdefault(u, len(self.number) + 1) for u in _UNITS.findall(text)]
            for k in range(len(ids) - window + 1):
                self.items[tuple(ids[k : k + window])].add(item)
        grams = np.array(list(self.items), np.uint64).reshape(-1, window)
        self.hashes = np.unique(self.hash(grams)) if len(grams) else np.zeros(0, np.uint64)

    def hash(self, grams: np.ndarray) -> np.ndarray:
        """By columns, so that no copy of all windows is made."""
        h = np.zeros(len(grams), np.uint64)
        for k in range(self.window):
            h = (h ^ grams[:, k]) * _FACTOR
            h ^= h >> np.uint64(29)
        return h

    def numbers(self, text: str) -> np.ndarray:
        get = self.number.get
        return np.array([get(u, 0) for u in _UNITS.findall(text)], np.uint64)

    def hits(self, ids: np.ndarray) -> list[tuple[int, set[int]]]:
        """(place of the window, items) of each window that is in a test item."""
        w = self.window
        if len(ids) < w or not len(self.hashes):
            return []
        # A window with an unknown unit can't hit: go on only where w known units follow each other.
        run = np.concatenate([[0], np.cumsum(ids == 0)])
        at = np.flatnonzero(run[w:] == run[:-w])
        if not len(at):
            return []
        grams = np.lib.stride_tricks.sliding_window_view(ids, w)
        h = self.hash(grams[at])
        spot = np.searchsorted(self.hashes, h)
        at = at[self.hashes[np.minimum(spot, len(self.hashes) - 1)] == h]
        found = ((int(k), self.items.get(tuple(map(int, grams[k])))) for k in at)
        return [(k, x) for k, x in found if x]


@lru_cache(maxsize=4)
def _windows(items: tuple[tuple[int, str], ...], window: int) -> Windows:
    return Windows(list(items), window)


def _sides(documents: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    docs = documents.select(F.col(doc_id).alias("doc_id"), folded(F.col(text)).alias("folded")).where("folded is not null")
    return docs, items.select(F.col(item_id).alias("item_id"), folded(F.col(text)).alias("folded")).where("folded is not null")


def _shared(held: DataFrame, most_chars: int):
    """The test side as a broadcast, if its size allows, else nothing."""
    if (held.agg(F.sum(F.length("folded")).alias("n")).first().n or 0) > most_chars:
        return None
    return held.sparkSession.sparkContext.broadcast(tuple(sorted((r.item_id, r.folded) for r in held.collect())))


def leaked_items(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    window: int = 12, most_chars: int = MOST_CHARS,
) -> DataFrame:
    """doc_id, item_id: each document that shares ``window`` consecutive units with a test item, and that item.

    Null and short texts match nothing; an item that repeats a passage of another is reported as well;
    a repeated document row is reported again only under another id; empty tables give no row.
    """
    docs, held = _sides(documents, items, doc_id, item_id, text)
    shared = _shared(held, most_chars)
    if shared is None:
        return _joined(docs, held, window).select("doc_id", "item_id").distinct()
    kinds = [d.schema[0].dataType.simpleString() for d in (docs, held)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(shared.value, window)
        for b in batches:
            at, found = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                for item in sorted(set().union(*(x for _, x in windows.hits(windows.numbers(t))))):
                    at.append(k)
                    found.append(item)
            ids = b.column(0).take(pa.array(at, pa.int32()))
            yield pa.record_batch([ids, pa.array(found, pa.int64() if kinds[1] == "bigint" else None)], names=["doc_id", "item_id"])

    return docs.mapInArrow(scan, f"doc_id {kinds[0]}, item_id {kinds[1]}")


#: A window that many documents hold is dealt out over so many tasks.
SALTS = 16


def _grams(df: DataFrame, key: str, window: int) -> DataFrame:
    """key, units, grams: structs of place (from 0) and the hash of every window."""
    listed = df.select(key, F.regexp_extract_all("folded", F.lit(UNIT), F.lit(0)).alias("units")).where(F.size("units") >= window)
    each = F.transform(F.sequence(F.lit(0), F.greatest(F.size("units") - window, F.lit(0))), lambda k: F.struct(k.alias("place"), F.xxhash64(F.concat_ws(" ", F.slice("units", k + 1, window))).alias("hash")))
    return listed.select(key, "units", each.alias("grams"))


def _joined(docs: DataFrame, held: DataFrame, window: int) -> DataFrame:
    """doc_id, place, item_id without a broadcast: hashes of the windows meet in a shuffle, hits are verified on the units."""
    said = lambda units, place: F.concat_ws(" ", F.slice(units, place + 1, window))
    tests = _grams(held, "item_id", window).select("item_id", "units", F.explode("grams").alias("g"))
    tests = tests.groupBy(F.col("g.hash").alias("hash"), said(F.col("units"), F.col("g.place")).alias("gram")).agg(F.collect_set("item_id").alias("items"))
    salted = tests.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = _grams(docs, "doc_id", window)
    places = mine.select("doc_id", F.explode("grams").alias("g")).select("doc_id", "g.*", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    met = places.join(salted, ["hash", "salt"]).groupBy("doc_id").agg(F.collect_list(F.struct("place", "gram", "items")).alias("met"))
    both = mine.select("doc_id", "units").join(met, "doc_id")
    hits = both.select("doc_id", F.explode(F.filter("met", lambda m: said(F.col("units"), m["place"]) == m["gram"])).alias("m"))
    return hits.select("doc_id", "m.place", F.explode("m.items").alias("item_id")).distinct()


def leaked_places(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    window: int = 12, most_chars: int = MOST_CHARS,
) -> DataFrame:
    """doc_id, place, item_id: every window of a document (by its first unit, from 0) that a test item holds, and that item."""
    docs, held = _sides(documents, items, doc_id, item_id, text)
    shared = _shared(held, most_chars)
    if shared is None:
        return _joined(docs, held, window)
    kinds = [d.schema[0].dataType.simpleString() for d in (docs, held)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(shared.value, window)
        for b in batches:
            at, place, found = [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                for p, hit in windows.hits(windows.numbers(t)):
                    for item in sorted(hit):
                        at.append(k), place.append(p), found.append(item)
            ids = b.column(0).take(pa.array(at, pa.int32()))
            yield pa.record_batch([ids, pa.array(place, pa.int32()), pa.array(found, pa.int64() if kinds[1] == "bigint" else None)], names=["doc_id", "place", "item_id"])

    return docs.mapInArrow(scan, f"doc_id {kinds[0]}, place int, item_id {kinds[1]}")


def leaked_spans(documents: DataFrame, items: DataFrame, window: int = 12, most_chars: int = MOST_CHARS) -> DataFrame:
    """doc_id, first_unit, units, item_ids: the maximal stretches of each document covered by hit windows, in units from 0,
    with the test items that they hold, in order. Repeated rows of one doc_id count once."""
    hits = leaked_places(documents, items, window=window, most_chars=most_chars)
    by_place = hits.groupBy("doc_id", "place").agg(F.collect_set("item_id").alias("items")).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "items"))).alias("p"))
    item = hits.schema["item_id"].dataType.simpleString()
    start = F.array().cast(f"array<struct<first:int,last:int,items:array<{item}>>>")

    def step(a: Column, x: Column) -> Column:
        end, top = x["place"] + window, F.try_element_at(a, F.lit(-1))
        new = F.array(F.struct(x["place"].alias("first"), end.alias("last"), x["items"].alias("items")))
        wider = F.array(F.struct(top["first"].alias("first"), end.alias("last"), F.array_union(top["items"], x["items"]).alias("items")))
        return F.when(top.isNotNull() & (x["place"] <= top["last"]), F.concat(F.slice(a, F.lit(1), F.size(a) - 1), wider)).otherwise(F.concat(a, new))

    spans = by_place.select("doc_id", F.explode(F.aggregate("p", start, step)).alias("s"))
    return spans.select("doc_id", F.col("s.first").alias("first_unit"), (F.col("s.last") - F.col("s.first")).alias("units"), F.sort_array("s.items").alias("item_ids"))


_INVISIBLE = regex.compile(r"(?V1)[\p{Cf}\u034F\u115F\u1160\u17B4\u17B5\u180B-\u180F\u3164\uFE00-\uFE0F\uFFA0\U000E0100-\U000E01EF]")
_PARTS = (regex.compile(r"(?s)\X"), regex.compile(r"(?s)\S+|\s+"))


def _unit_places(text: str, units: list[str]) -> list[tuple[int, int]] | None:
    """Where each unit stands in the text as it is: folded grapheme by grapheme, or word by word where that gives other units."""
    for part in _PARTS:
        folded_text, owner = [], []
        for m in part.finditer(text):
            f = unicodedata.normalize("NFKC", _INVISIBLE.sub("", m[0])).lower()
            folded_text.append(f)
            owner += [m.span()] * len(f)
        found = list(_UNITS.finditer("".join(folded_text)))
        if [m[0] for m in found] == units:
            return [(owner[m.start()][0], owner[m.end() - 1][1]) for m in found]
    return None


def without_spans(text: str, units: list[str], spans: list[tuple[int, int]]) -> str:
    """The text without the stretches (first unit, units). Where its units cannot be found in it, nothing is left."""
    places = _unit_places(text, units)
    if places is None:
        return ""
    out, at = [], 0
    for first, n in spans:
        out.append(text[at : places[first][0]])
        at = places[first + n - 1][1]
    return "".join(out) + text[at:]


def cleaned_documents(documents: DataFrame, items: DataFrame, window: int = 12, most_chars: int = MOST_CHARS) -> DataFrame:
    """doc_id, text: every document that holds test passages, without them. Other documents stay as they are and are not given."""
    spans = leaked_spans(documents, items, window, most_chars)
    listed = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("first_unit", "units"))).alias("spans"))
    held = documents.select("doc_id", "text").join(listed, "doc_id").withColumn("said", units(F.col("text")))

    @F.pandas_udf("string")
    def cut(text: pd.Series, said: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([without_spans(t, list(u), [(s["first_unit"], s["units"]) for s in p]) for t, u, p in zip(text, said, spans)], dtype=object)

    return held.select("doc_id", cut("text", "said", "spans").alias("text"))
