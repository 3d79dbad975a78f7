"""Every corpus query against its SQL on the smallest tables, and the driver contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from inkweave.plans import registry as queries

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the test tables")


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, (list, tuple)) else repr(v)


def compared(spark, query, sql):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DIR}/{f}'")
    df, rel = query(spark, DIR), con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    table = lambda rows, cols: sorted("|".join(plain(r[cols.index(c)]) for c in sorted(cols)) for r in rows)
    assert table([tuple(r) for r in df.collect()], df.columns) == table(rel.fetchall(), rel.columns)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    compared(spark, queries.QUERIES[name], queries.ORACLES[name])


def _table(name):
    duckdb = pytest.importorskip("duckdb")
    return duckdb.sql(f"SELECT DISTINCT ON (vol, id) * FROM '{DIR}/{name}.parquet'").df()


def test_queries_without_sql():
    assert set(queries.QUERIES) - set(queries.ORACLES) == {"column_consensus", "text_provenance", "chapter_pairs", "vector_alignment"}


def test_column_consensus(spark):
    rows = {(r.vol, r.id): r.sinonom for r in _table("han_boxes").itertuples() if r.sinonom is not None}
    got = queries.QUERIES["column_consensus"](spark, DIR).collect()
    assert {(r.vol, r.id) for r in got} == set(rows)
    for r in got:  # every reviewed place holds the other's character, every other one the first reading's
        changed = dict((int(x.split(":")[0]), x.split(":")[2]) for x in r.review.split())
        base = rows[r.vol, r.id]
        assert len(r.reading) == len(base) and all(r.reading[k] == changed.get(k, c) for k, c in enumerate(base))


def test_text_provenance(spark):
    rows = {(r.vol, r.id): r.text for r in _table("vi_sentences").itertuples() if r.text is not None}
    got = queries.QUERIES["text_provenance"](spark, DIR).collect()
    assert len(got) == len(rows) and sum(r.places is not None for r in got) >= 0.99 * len(got)
    for r in got:
        places = [int(p) for p in (r.places or "").split()]
        assert r.places is None or len(places) == len(r.clean) and all(c == rows[r.vol, r.id][k] for c, k in zip(r.clean, places) if c != " ")


def test_alignments_cover_both_sides_in_order(spark):
    for name, key, left, right in (("chapter_pairs", ("vol", "chapter"), "left_ids", "right_ids"), ("vector_alignment", ("label", "run"), "left", "right")):
        by = {}
        for r in queries.QUERIES[name](spark, DIR).orderBy("pair_no").collect():
            by.setdefault(tuple(r[k] for k in key), []).append(r)
        assert by
        for rows in by.values():
            for side in (left, right):
                ids = [i for r in rows for i in r[side]]
                assert len(ids) == len(set(ids)) and (name == "chapter_pairs" or ids == sorted(ids))
            assert all((len(r[left]), len(r[right])) in {(1, 1), (1, 2), (1, 3), (2, 1), (3, 1), (1, 0), (0, 1), (2, 2)} for r in rows)


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries.QUERIES) <= set(entry.queries())
