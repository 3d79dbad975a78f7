"""Tokenizer (p7) against the library, leakage (p8) against brute force."""

from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkweave.llm import bpe, leakage
from inkweave.llm.queries import TOKENIZERS

FILE = f"{TOKENIZERS}/byte_bpe_50k.json"
needs_file = pytest.mark.skipif(not os.path.exists(FILE), reason="needs the public tokenizer")


@pytest.fixture(scope="module")
def models():
    tokenizers = pytest.importorskip("tokenizers")
    theirs = tokenizers.Tokenizer.from_file(FILE)
    theirs.encode_special_tokens = True
    return bpe.ByteBPE(open(FILE, "rb").read()), theirs


@needs_file
@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_same_ids_as_the_library(models, text):
    ours, theirs = models
    ids = ours.encode(text)
    assert ids == theirs.encode(text, add_special_tokens=False).ids
    assert ours.decode(ids) == text


@needs_file
def test_odd_texts(models):
    ours, theirs = models
    for text in ["<|endoftext|> it's we'll  \r\n\t x​ ①②", "a" * 3000, "的" * 2000, " " * 50 + "x", "Nước là 𠀧𢆥", "😀😀 aA12"]:
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


@needs_file
def test_rows(spark):
    df = spark.createDataFrame([(1, "Xin chào", 9), (2, None, 9), (3, "", 9), (1, "Xin chào", 9)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, list(r.ids)) for r in bpe.encode_texts(df, "doc_id", "text", FILE).collect())
    assert got[2:] == [(2, []), (3, [])] and got[0] == got[1] and got[0][1]
    back = bpe.decode_ids(bpe.encode_texts(df, "doc_id", "text", FILE), "doc_id", "ids", FILE)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(1, "Xin chào")] * 2 + [(2, ""), (3, "")]
    assert bpe.encode_texts(df.limit(0), "doc_id", "text", FILE).count() == 0


def _units(text):
    import unicodedata

    return leakage._UNITS.findall(unicodedata.normalize("NFKC", text.replace("​", "")).lower())


def _brute(docs, items, w):
    grams = {}
    for i, t in items:
        u = _units(t or "")
        for k in range(len(u) - w + 1):
            grams.setdefault(tuple(u[k : k + w]), set()).add(i)
    out = set()
    for d, t in docs:
        u = _units(t or "")
        for k in range(len(u) - w + 1):
            out |= {(d, i) for i in grams.get(tuple(u[k : k + w]), ())}
    return out


@pytest.mark.parametrize("most", [leakage.MOST_CHARS, 0])  # the broadcast and the join
def test_leaks(spark, most):
    r = random.Random(7)
    words = "ba mẹ 水 火 Ａ１ trời-đất 〇 nước".split()
    text = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "\n", "​ "]) for _ in range(n))
    items = [(k, text(r.randint(0, 40))) for k in range(12)] + [(50, None), (51, "")]
    docs = [(k, text(r.randint(0, 20)) + (items[k % 12][1][5:90].upper() if k % 3 else "") + text(3)) for k in range(60)] + [(900, None), (901, ""), (902, items[3][1] * 50)]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, text string, item_id int")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(x.doc_id, x.item_id) for x in leakage.leaked_items(d, i, window=5, most_chars=most).collect()}
    assert got == _brute(docs, items, 5) and got
    assert leakage.leaked_items(d.limit(0), i, most_chars=most).count() == 0
    assert leakage.leaked_items(d, i.limit(0), most_chars=most).count() == 0


@pytest.mark.parametrize("most", [leakage.MOST_CHARS, 0])
def test_spans_and_cleaned_documents(spark, most):
    item, other = "một hai ba bốn năm", "ba bốn năm sáu bảy"
    texts = [f"x y {item} z w {item}", "khác", None, f"Trước. MỘT HAI, ba\nbo\u0302\u0301n na\u0306m\u200b sáu bảy! Sau.", "水Ａ火 một-hai ba bốn năm 土", f"{item} " * 3000]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts, 1)], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, item), (8, other)], "item_id bigint, text string")
    got = sorted((r.doc_id, r.first_unit, r.units, r.item_ids) for r in leakage.leaked_spans(d, i, window=5, most_chars=most).collect())
    assert got[:4] == [(1, 2, 5, [7]), (1, 9, 5, [7]), (4, 1, 7, [7, 8]), (5, 3, 5, [7])]
    cleaned = {r.doc_id: r.text for r in leakage.cleaned_documents(d, i, 5, most).collect()}
    assert set(cleaned) == {1, 4, 5, 6} and cleaned[1] == "x y  z w " and cleaned[4] == "Trước. ! Sau." and cleaned[5] == "水Ａ火  土"
    assert leakage.leaked_items(spark.createDataFrame([(k, t) for k, t in cleaned.items()], d.schema), i, window=5).count() == 0
    assert leakage.cleaned_documents(d.limit(0), i, 5, most).count() == 0 and leakage.leaked_spans(d, i.limit(0), 5, most).count() == 0
