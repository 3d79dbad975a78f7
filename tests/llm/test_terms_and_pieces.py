"""Term counting (p4) and splitting (p6) against brute force."""

from __future__ import annotations

import random
import unicodedata
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkweave.llm import splitting, termcounts


def _brute_ngrams(rows, longest):
    n, records = Counter(), Counter()
    for r in rows:
        terms = [t for t in r or [] if t is not None]
        grams = [tuple(terms[k : k + m]) for m in range(1, longest + 1) for k in range(len(terms) - m + 1)]
        n.update(grams)
        records.update(set(grams))
    return {g: (n[g], records[g]) for g in n}


@pytest.mark.parametrize("longest,salts", [(1, 1), (3, 1), (3, 4)])
def test_ngrams(spark, longest, salts):
    r = random.Random(longest)
    rows = [None, [], [None, "a"], ["a"] * 40] + [[r.choice("aab c dd é".split()) for _ in range(r.randint(0, 12))] for _ in range(120)]
    df = spark.createDataFrame([(x, 1, 2) for x in rows], "terms array<string>, n int, records int")  # clashing names
    got = {tuple(x.ngram): (x.n, x.records) for x in termcounts.count_ngrams(df, "terms", longest, salts).collect()}
    assert got == _brute_ngrams(rows, longest)
    assert termcounts.count_ngrams(df.limit(0), "terms", longest, salts).count() == 0


def test_stack_counts_a_record_once():
    rows = [(["b"], 0, 1), (["a", "c"], 1, 1), (["a", "b"], 0, 1), (["a"], 1, 1)]
    assert {tuple(g): (n, r) for g, n, r in termcounts.stack_pass(iter(rows))} == {("b",): (1, 1), ("a", "c"): (1, 1), ("a", "b"): (1, 1), ("a",): (3, 1)}


def test_marks(spark):
    texts = ["Ba ba Mẹ", "ba ơi", None, "", "mẹ 12 ơi!", "ba"] + ["x"] * 30
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(termcounts.letter_runs(F.col("text")).alias("terms"))
    got = {r.term: (r.n, r.records, r.mark) for r in termcounts.term_marks(df, "terms", rare=2, common=0.1).collect()}
    assert got == {"ba": (4, 3, None), "mẹ": (2, 2, "rare"), "ơi": (2, 2, "rare"), "x": (30, 30, "common")}
    values = spark.createDataFrame([(" Ba ",), ("ba",), ("BA ",), (unicodedata.normalize("NFD", "Mẹ"),), (None,), ("  ",)], "token string").select(termcounts.value_terms(F.col("token")).alias("terms"))
    assert {r.term: r.mark for r in termcounts.term_marks(values, "terms", rare=1, common=0.4).collect()} == {"ba": "common", "mẹ": "rare"}


def _greedy(t, limit, least, overlap):
    out, s = [], 0
    while len(t) - s > limit:
        w, e = t[s : s + limit], None
        for marks in (splitting.STRONG, splitting.WEAK):
            at = [k for k in range(least, limit) if w[k] in marks]
            if at:
                e = at[-1] + 1
                while e < limit and w[e] in splitting.CLOSERS:
                    e += 1
                break
        e = s + (e or limit)
        out.append((len(out) + 1, s, e))
        s = e - overlap
    return [*out, (len(out) + 1, s, len(t))] if len(t) > limit else []


@settings(max_examples=300, deadline=None)
@given(st.text("甲乙。，」』：、！", max_size=400), st.sampled_from([(120, 60, 15), (20, 10, 3), (9, 5, 0)]))
def test_pieces_equal_the_rule(text, sizes):
    assert splitting.pieces(text, *sizes) == _greedy(text, *sizes)


def test_split_rows(spark):
    long = "甲" * 250 + "。" + "乙" * 40
    df = spark.createDataFrame([("v", "a", long, 1), ("v", "a", long, 1), ("v", "b", None, 2), ("v", "c", "", 3), ("v", "d", "甲" * 120, 4)], "vol string, id string, t string, piece_no int")
    got = sorted(tuple(r) for r in splitting.split_oversized(df, "t", "vol", "id").collect())
    assert got == sorted([("v", "a", *p) for p in _greedy(long, 120, 60, 15)] * 2)
    assert all(e - s <= 120 for *_, s, e in got)
    assert splitting.split_oversized(df.limit(0), "t", "vol", "id").count() == 0
    huge = "甲乙。" * 40_000
    assert splitting.pieces(huge)[-1][2] == len(huge)
    with pytest.raises(ValueError):
        splitting.split_oversized(df, "t", "id", overlap=90)


def _merged_brute(ends, strength, room):
    """Merges the weakest pair that fits (smallest, then first) until none does, looking at all pairs each time."""
    cuts = list(zip(ends, strength))
    while True:
        begins = [0, *(e for e, _ in cuts)]
        pairs = [(s, cuts[k + 1][0] - begins[k], k) for k, (_, s) in enumerate(cuts[:-1]) if cuts[k + 1][0] - begins[k] <= room]
        if not pairs:
            return [e for e, _ in cuts]
        del cuts[min(pairs)[2]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 3)), min_size=1, max_size=25), st.integers(5, 30))
def test_merging_against_brute_force(atoms, room):
    ends = [sum(n for n, _ in atoms[: k + 1]) for k in range(len(atoms))]
    strength = [(s,) for _, s in atoms]
    got = splitting.merge_weakest(ends, strength, lambda begin, _, end: end - begin <= room)
    assert got == _merged_brute(ends, strength, room)


def test_weak_boundaries_are_merged_first():
    """Taking segments from the left, or without regard to strength, would cut inside the second sentence."""
    text = "甲" * 50 + "。" + "乙" * 40 + "，" + "丙" * 40 + "。"
    assert splitting.merged_pieces(text, 100, 10) == [(1, 0, 51), (2, 41, 133)]
    assert [text[s:e] for _, s, e in splitting.pieces(text, 100, 40, 10)][0].endswith("。")
    assert splitting.merge_weakest([50, 60, 70], [(3,), (1,), (4,)], lambda b, m, e: e - b <= 60) == [50, 70]


@settings(max_examples=100, deadline=None)
@given(st.text("甲乙。，」", max_size=400), st.integers(2, 40).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n - 1))))
def test_merged_pieces_fit_and_cover(text, sizes):
    limit, overlap = sizes
    made = splitting.merged_pieces(text, limit, overlap)
    assert bool(made) == (len(text) > limit)
    at = 0
    for k, (no, s, e) in enumerate(made):
        assert no == k + 1 and s <= at < e and e - s <= limit
        at = e
    assert not made or at == len(text)


def test_merged_rows(spark):
    df = spark.createDataFrame([("v", "a", "甲乙。" * 100), ("v", "b", None), ("v", "c", ""), ("v", "d", "短")], "vol string, id string, t string")
    got = [tuple(r) for r in splitting.split_merged(df, "t", "vol", "id").orderBy("piece_no").collect()]
    assert got == [("v", "a", *p) for p in splitting.merged_pieces("甲乙。" * 100)]
    assert splitting.split_merged(df.limit(0), "t", "vol", "id").count() == 0
    with pytest.raises(ValueError):
        splitting.split_merged(df, "t", "id", limit=10, overlap=10)
