"""Operators against brute force, with nulls, ties, repeated rows and empty tables."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from inkweave.operators import consensus, furniture, layout, lexicon, metrics, pages, patching, stream, vectors
from inkweave.sources.tables import corpus_rows


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_once_and_filtered_at_the_scan(spark, tmp_path):
    rows = [("a", 1, "x", 1), ("a", 1, "x", 2), ("a", 2, "y", 1), (None, 1, "z", 1), (None, 1, "z", 3), ("b", 1, None, 1)]
    spark.createDataFrame(rows, "vol string, id int, t string, loaded_at int").write.parquet(str(tmp_path / "han_boxes.parquet"))
    got = corpus_rows(spark, str(tmp_path), "han_boxes", "t")
    assert _rows(got) == sorted([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), ("b", 1, None)], key=str)
    some = corpus_rows(spark, str(tmp_path), "han_boxes", where="t = 'x'")
    assert _rows(some) == [("a", 1)]
    assert "PushedFilters: [IsNotNull(t), EqualTo(t,x)]" in some._jdf.queryExecution().toString()


def test_han_starts_against_scan(spark):
    r, rows, want = random.Random(4), [], {}
    for v in range(60):
        labels = [r.choice(["VI", "HAN", "HAN", "HAN", "BLANK"]) for _ in range(r.randint(0, 14))]
        rows += [(v, p, x) for p, x in enumerate(labels)]
        start = None
        for p, x in enumerate(labels):
            if x == "HAN" and start is None:
                n = 0
                for y in labels[p:]:
                    if y == "VI":
                        break
                    n += y == "HAN"
                if n > 3:
                    start = p
        last = max([p for p, x in enumerate(labels) if x == "VI" and start is not None and p < start], default=None)
        if labels:
            want[v] = (start, len(labels) if start is None else start if last is None else last + 1)
    got = {x.v: (x.han_start, x.boundary) for x in pages.han_starts(spark.createDataFrame(rows, "v int, p int, label string"), ["v"], "p", "label").collect()}
    assert got == want


def test_as_of_and_overlaps(spark):
    r = random.Random(1)
    marks = [(r.randint(0, 2), r.randint(0, 50), k) for k in range(80)]
    since = [(r.randint(0, 2), r.randint(0, 50), r.randint(0, 9)) for _ in range(30)]
    got = stream.as_of(spark.createDataFrame(marks, "g int, at int, k int"), spark.createDataFrame(since, "g int, s int, value int"), ["g"], "at", "s", "value")
    best = lambda g, at: max(((s, v) for h, s, v in since if h == g and s <= at), default=(None, None))[1]
    assert {x.k: x.value for x in got.collect()} == {k: best(g, at) for g, at, k in marks}

    a = [(r.randint(0, 1), k, s := r.randint(0, 300), s + r.randint(0, 90)) for k in range(60)]
    b = [(r.randint(0, 1), k, s := r.randint(0, 300), s + r.randint(0, 90)) for k in range(60)]
    met = stream.overlaps(spark.createDataFrame(a, "g int, i int, a0 int, a1 int"), spark.createDataFrame(b, "g int, j int, b0 int, b1 int"), ["g"], "a0", "a1", "b0", "b1", bucket=16)
    want = sorted((i, j) for g, i, s, e in a for h, j, t, f in b if g == h and s < f and t < e and s < e and t < f)
    assert sorted((x.i, x.j) for x in met.collect()) == want


def test_resegmented(spark):
    rows = [("a", 1, "x", "甲乙。丙"), ("a", 2, "y", "丁，戊！"), ("a", 3, "z", "己"), ("b", 1, "w", None), ("b", 2, "u", "")]
    got = stream.resegmented(spark.createDataFrame(rows, "g string, k int, id string, t string"), ["g"], ["k"], "t", "id", "。！？；", "。！？；，、：")
    assert [tuple(r) for r in got.orderBy("seg_no").collect()] == [("a", 1, "甲乙", ["x"]), ("a", 2, "丙丁戊", ["x", "y"]), ("a", 3, "己", ["z"])]


def test_rank_and_histogram(spark):
    for n in (1, 5, 20, 40, 99, 100):
        values = [random.Random(n).randint(0, 30) for _ in range(n)]
        df = spark.createDataFrame([("v", x) for x in values] + [("v", None)], "g string, x int")
        assert metrics.rank_value(df, ["g"], "x", 0.95).first().ranked == sorted(values)[min(n - 1, n * 95 // 100)]
    h = metrics.histogram(spark.createDataFrame([(0.0,), (0.3,), (1.0001,), (2.0,), (None,)], "x double"), "x", metrics.CONF_EDGES)
    assert [r.n for r in h.orderBy("bin").collect()] == [1, 1, 0, 0, 0, 1]


def test_lexicons(spark):
    hv = spark.createDataFrame([("百", "bách"), ("千", None), ("百", "bá"), (None, "x")], "c string, r string")
    rows = spark.createDataFrame([(1, "百,千𤾓"), (2, None), (3, "abc")], "k int, t string")
    assert _rows(lexicon.transliterated(rows, ["k"], "t", hv, "c", "r")) == [(1, "bá ? ?"), (2, ""), (3, "")]
    merged = lexicon.merged_by_priority([("a", hv), ("b", spark.createDataFrame([("百", "trăm"), ("萬", "vạn"), ("萬", "")], "c string, r string"))], "c", "r")
    assert _rows(merged) == sorted([("百", "bá", "a", ["bá", "bách", "trăm"]), ("萬", "vạn", "b", ["vạn"])], key=str)
    pairs = spark.createDataFrame([("百", " Trăm"), ("白", "trăm"), ("X", "trăm"), ("X", None)], "sn string, qn string")
    s1 = spark.createDataFrame([("白", ["自", "百"])], "key string, values array<string>")
    s2 = spark.createDataFrame([("trăm", ["百"])], "key string, values array<string>")
    got = {(r.sn, r.qn): (r.status, r.corrected) for r in lexicon.validated_pairs(pairs, s1, s2).collect()}
    assert got == {("百", " Trăm"): ("BLACK", None), ("白", "trăm"): ("GREEN", "百"), ("X", "trăm"): ("RED", None), ("X", None): ("RED", None)}


def test_layout(spark):
    boxes = [("p", "a", [100, 0, 140, 90], "甲", 0.9), ("p", "b", [102, 100, 142, 190], "乙", 0.5), ("p", "c", [40, 0, 80, 90], "丙", None), ("p", "d", None, "丁", 0.1)]
    df = spark.createDataFrame(boxes, "page string, id string, bbox array<int>, sinonom string, conf double")
    width = F.lit(1000)
    got = [tuple(r)[1:] for r in layout.columns_of_pages(df, ["page"], F.max(width)).orderBy("column_no").collect()]
    assert got == [(1, 2, 100, 0, 142, 190, "甲乙", 0.5, False), (2, 1, 40, 0, 80, 90, "丙", None, False)]
    assert [(r.id, r.row_no) for r in layout.reading_order(df, ["page"]).orderBy("place").collect()] == [("c", 1), ("a", 1), ("b", 2)]
    assert layout.reading_order(df.limit(0), ["page"]).count() == 0
    assert layout.columns_of_pages(df.limit(0), ["page"], F.max(width)).count() == 0
    assert [r.id for r in layout.tall_enough(df).orderBy("id").collect()] == ["a", "b", "c"]


def test_double_columns_heads_and_tiny_boxes(spark):
    half = [("p", k, [x, y, x + 30, y + 90], t, 0.9) for k, x, y, t in (("a", 520, 0, "a"), ("b", 520, 100, "b"), ("c", 506, 0, "c"), ("d", 506, 100, "d"))]
    plain = [("p", f"k{k}", [300 - 60 * k, 0, 340 - 60 * k, 300], "文", 0.8) for k in range(4)]
    head = [("p", "h", [950, 0, 970, 300], "標", 0.9), ("p", "t", [500, 300, 504, 304], "點", 0.9), ("p", "u", [420, 0, 460, 300], "政要卷之一", 0.9)]
    df = spark.createDataFrame(half + plain + head, "page string, id string, bbox array<int>, sinonom string, conf double")
    got = layout.columns_of_pages(df, ["page"], F.max(F.lit(1000)), ("政要卷之",)).orderBy("column_no").collect()
    assert [(r.text, r.is_double) for r in got] == [("abcd", True), *[("文", False)] * 4]


def test_furniture(spark):
    rows = [("v", "a", [950, 0, 1000, 9], "百", 0.9)] * 1 + [("v", f"k{k}", [500, 0, 1000, 9], "文", 0.9) for k in range(20)]
    rows += [("v", "t", [100, 0, 140, 9], "政要卷", 0.99), ("v", "e", [990, 0, 1000, 9], "瑞康四年", 0.2), ("v", "x", None, "政要", 0.1), ("v", "n", [980, 0, 1000, 9], None, 0.1)]
    df = spark.createDataFrame(rows, "vol string, id string, bbox array<int>, sinonom string, conf double")
    assert {r.id for r in furniture.edge_boxes(df, "vol", "政要卷之第", "政要卷之第百").where("dropped").collect()} == {"t"}


def test_consensus(spark):
    cases = [("甲乙丙", "甲丁丙"), ("数則", "數則"), ("甲乙", ""), (None, None), ("萬節龍養天", "节龙养天"), ("甲乙丙", "甲丙"), ("甲", None)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a string, b string")
    folds = "數数 節节 龍龙 養养"
    review = lambda r: [(x.pos, x.base, x.other) for x in r.review]
    got = consensus.consensus(df, "a", "b", folds=folds).orderBy("k").collect()
    assert [r.reading for r in got] == ["甲丁丙", "数則", "甲乙", "", "萬節龍養天", "甲乙丙", "甲"]
    assert review(got[0]) == [(1, "乙", "丁")] and not any(r.review for r in got[1:])
    strict = consensus.consensus(df, "a", "b", "majority", folds).orderBy("k").collect()
    assert [r.reading for r in strict] == ["甲乙丙", "数則", "甲乙", "", "萬節龍養天", "甲乙丙", "甲"]
    assert review(strict[2]) == [(0, "甲", None), (1, "乙", None)] and review(strict[5]) == [(1, "乙", None)] and review(strict[1]) == []
    figures = consensus.consensus_figures(consensus.consensus(df.withColumn("v", F.lit("v")), "a", "b", folds=folds), ["v"], "a").first()
    assert (figures.cols, figures.chars, figures.review_cols, figures.review_chars, figures.corrected_cols) == (7, 16, 1, 1, 1)


def _align_brute(h, v):
    unit = lambda x: x / (np.linalg.norm(x) or 1)
    best, back = {(0, 0): 0.0}, {}
    for i in range(len(h) + 1):
        for j in range(len(v) + 1):
            if (i, j) not in best:
                continue
            for a, b in vectors.MODES:
                if i + a > len(h) or j + b > len(v):
                    continue
                s = float(unit(h[i : i + a].sum(0)) @ unit(v[j : j + b].sum(0))) if a and b else 0.0
                g = best[i, j] + (s if s >= vectors.FREE else s - 1)
                if g > best.get((i + a, j + b), -np.inf):
                    best[i + a, j + b], back[i + a, j + b] = g, (i, j)
    return best[len(h), len(v)]


def test_vector_alignment_reaches_the_best_sum():
    r = np.random.default_rng(3)
    for _ in range(25):
        h, v = r.normal(size=(r.integers(1, 9), 5)), r.normal(size=(r.integers(1, 9), 5))
        steps = vectors.aligned(h, v)
        assert steps[0][:2] == (0, 0) and sum(s[2] for s in steps) == len(h) and sum(s[3] for s in steps) == len(v)
        got = sum((s if a and b and s >= vectors.FREE - 5e-4 else s - 1) for *_, a, b, s in steps)
        assert abs(got - _align_brute(h, v)) < 0.01 * len(steps)
    assert vectors.aligned(np.zeros((0, 3)), np.ones((2, 3))) == []


def test_patching(spark):
    rows = spark.createDataFrame([("v", "a", 1, "x"), ("v", "b", 2, "y"), ("v", "c", 3, None)], "vol string, id string, k int, t string")
    edits = spark.createDataFrame([("v", "a", "X", "edit"), ("v", "b", None, "drop")], "vol string, id string, correct string, fix_type string")
    assert _rows(patching.overlaid(rows, edits, ["vol", "id"], "t")) == sorted([("v", "a", 1, "X", True), ("v", "c", 3, None, False)], key=str)
    new = patching.with_inserted(rows, spark.createDataFrame([("v", "n", 1, "new")], "vol string, id string, k int, t string"), ["vol"], "k")
    assert [r.id for r in new.orderBy("k").collect()] == ["a", "n", "b", "c"]
    refs = spark.createDataFrame([(1, "v", ["a", "z"]), (2, "v", None), (3, "v", [])], "k int, vol string, ids array<string>")
    mapped = patching.remapped(refs, ["k"], ["vol"], "ids", spark.createDataFrame([("v", "a", "A")], "vol string, old_id string, new_id string"))
    assert sorted((r.ids for r in mapped.collect()), key=str) == sorted([["A", "z"], None, []], key=str)
    fixed = patching.phrases_corrected(spark.createDataFrame([("Triệu-trị và TRIỆU TRỊ",), (None,)], "t string"), "t", [("triệu trị", "Thiệu Trị")])
    assert [r.t for r in fixed.collect()] == ["Thiệu Trị và THIỆU TRỊ", None]


def test_weights_and_windows(spark):
    df = spark.createDataFrame([(1, {"a": 1.0, "b": 2.0}), (1, {"a": 0.5}), (2, None)], "k int, w map<string,double>")
    assert vectors.merged_weights(df, ["k"], "w").first().w == {"a": 1.5, "b": 2.0}
    win = pages.windows_of(spark.createDataFrame([(1, 1000), (2, 10), (3, 0)], "k int, n int"), F.col("n"))
    assert [(r.k, r.win_start, r.win_end, r.trusted_from) for r in win.orderBy("k", "win_no").collect()] == [(1, 0, 460, 0), (1, 428, 888, 460), (1, 856, 1000, 888), (2, 0, 10, 0)]


def test_geometry(spark):
    df = spark.createDataFrame([([(1, 5), (9, 2), (4, 8)], [10, 20, 30, 50])], "p array<struct<x:int,y:int>>, b array<int>")
    points = F.transform("p", lambda q: F.array(q["x"], q["y"]))
    r = df.select(layout.polygon_box(points).alias("box"), layout.unrotated_box(F.col("b"), F.lit(100)).alias("back")).first()
    assert r.box == [1, 2, 9, 8] and r.back == [49, 10, 79, 30]
    crop = df.select(layout.crop_window(F.col("b"), F.lit(25), F.lit(60), pad=5, scale=2).alias("c")).first().c
    assert crop == [10, 30, 50, 110]


def test_built_lexicon(spark):
    many = lambda rows: spark.createDataFrame(rows, "char string, readings array<string>")
    variants = spark.createDataFrame([("兴", ["興", "與"]), ("学", ["學"]), ("無", ["无"])], "char string, variants array<string>")
    readings, kanji = many([("百", ["bách", "bá"]), ("與", ["dữ"])]), many([("百", ["bách", "mạch"]), ("興", ["hưng"]), ("千", ["thiên"])])
    supplement = spark.createDataFrame([("萬", " Hoà"), ("千", "x")], "char string, reading string")
    got = {r.char: (r.reading, r.all_readings, r.source) for r in lexicon.built_readings(readings, kanji, supplement, many([("百", ["trăm"]), ("十", ["mười"])]), variants).collect()}
    assert got == {
        "百": ("bách", ["bách", "bá", "mạch", "trăm"], "readings"), "與": ("dữ", ["dữ"], "readings"), "興": ("hưng", ["hưng"], "kanji"), "千": ("thiên", ["thiên"], "kanji"),
        "萬": ("hòa", ["hòa"], "supplement"), "十": ("mười", ["mười"], "taught"), "兴": ("dữ", ["dữ"], "variant"),
    }
    alike = lexicon.built_similar(spark.createDataFrame([("百", ["自", "白", "自"])], "key string, values array<string>"), variants)
    assert {r.key: r["values"] for r in alike.collect()} == {"百": ["自", "白", "百"], "兴": ["與", "興", "兴"], "学": ["學", "学"], "無": ["无", "無"]}


def test_rows_of_an_empty_vocabulary_are_kept(spark):
    rows = spark.createDataFrame([(1, "một hai ba"), (2, "x"), (3, None), (4, "một zz")], "k int, t string")
    tokens = F.split(F.col("t"), " ")
    some = spark.createDataFrame([("một",)], "token string")
    assert {r.k for r in lexicon.known_rows(rows, ["k"], tokens, some).collect()} == {4}
    assert {r.k for r in lexicon.known_rows(rows, ["k"], tokens, some.limit(0)).collect()} == {1, 2, 3, 4}


def test_running_count_over_blocks(spark):
    r = random.Random(2)
    rows = [(k % 2, k, r.random() < 0.3) for k in range(300)]
    got = pages.running_count(spark.createDataFrame(rows, "g int, p int, f boolean"), ["g"], "p", F.col("f"), "n", block=16).collect()
    assert all(x.n == sum(f for g, p, f in rows if g == x.g and p <= x.p) for x in got) and len(got) == 300


def test_split_volumes(spark):
    vi = "[1a] " + "một trăm hai mươi chữ viết đầy đủ dấu ở đây " * 14
    prose = "\n".join(["một dòng chữ dài có đủ dấu tiếng việt"] * 11)
    han = "abc def ghi jkl mno pqr stu vwx yza bcd efg hij"
    texts = ["bản dịch của người này ở đây viết mười chữ có đủ dấu", vi, prose, "chữ viết đầy đủ dấu ở đây thật là nhiều lắm\nBẢNG TRA", "", han, han, "", han, han]
    df = spark.createDataFrame([("v", k, t, 0.5 if k == 7 else 0.0) for k, t in enumerate(texts)], "vol string, page int, text string, ink double")
    got = [(r.page, r.label, r.half, r.part) for r in pages.split_volumes(df, ["vol"], "page", "text", "ink").orderBy("page").collect()]
    assert got == [
        (0, "VI", "vi", "front"), (1, "VI", "vi", "body"), (2, "VI", "vi", "body"), (3, "VI", "vi", "back"), (4, "BLANK", None, None),
        (5, "HAN", "han", "body"), (6, "HAN", "han", "body"), (7, "PLATE", "han", "body"), (8, "HAN", "han", "body"), (9, "HAN", "han", "body"),
    ]
    m = pages.volume_manifest(pages.split_volumes(df, ["vol"], "page", "text", "ink"), ["vol"], "page").first()
    assert (m.num_pages, m.vi_pages, m.front, m.back, m.han_pages, m.vi_first, m.vi_last, m.han_first) == (10, 2, 1, 1, 5, 1, 2, 5)


def test_rebuilt_sentences(spark):
    rows = [("v", 1, 1, "a", "甲乙", False), ("v", 1, 2, "b", "夾", True), ("v", 1, 3, "c", "丙丁", False), ("v", 2, 1, "d", "戊", False), ("v", 2, 2, "e", None, False)]
    boxes = spark.createDataFrame(rows, "vol string, page int, box_idx int, id string, sinonom string, is_dbl boolean")
    marks = spark.createDataFrame([("v", 2, "。"), ("v", 0, "，"), ("v", 99, "。")], "vol string, pos long, mark string")
    got = stream.rebuilt_sentences(boxes, marks, ["vol"], ["page", "box_idx", "id"], "sinonom", "。！？；")
    assert [(r.page, r.sent_idx, r.segment, r.box_ids, r.is_dbl) for r in got.orderBy("page", "sent_idx").collect()] == [
        (1, 1, "甲乙丙", ["a", "c"], False), (1, 2, "夾", ["b"], True), (1, 3, "丁戊", ["c", "d"], False),
    ]


def test_edits_must_match_once(spark):
    import pytest

    rows = spark.createDataFrame([(1, "甲乙甲"), (2, "甲乙"), (3, None)], "k int, t string")
    fine = spark.createDataFrame([(2, "甲", "丙"), (1, "乙", "丁")], "k int, old string, new string")
    assert _rows(patching.replaced_once(rows, fine, ["k"], "t")) == [(1, "甲丁甲"), (2, "丙乙"), (3, None)]
    with pytest.raises(Exception, match="not exactly once"):
        patching.replaced_once(rows, spark.createDataFrame([(1, "甲", "丙")], "k int, old string, new string"), ["k"], "t").collect()


def test_header_crop(spark):
    def page(k, bands):
        return [(k, y, 50.0, 1000, 200) for a, b in bands for y in range(a, b + 1)]

    rows = page(1, [(150, 189), (300, 339), (360, 399), (420, 459)]) + page(2, [(300, 339), (360, 399), (420, 459)]) + page(3, [(10, 40)]) + [(4, 5, 0.0, 1000, 200)]
    got = layout.header_crop(spark.createDataFrame(rows, "page int, y int, ink double, height int, width int"), ["page"], "height", "width")
    assert sorted(map(tuple, got.collect())) == [(1, 292), (2, 0), (3, 0), (4, 0)]


def test_sequences(spark):
    from inkweave.operators import sequences

    rows = spark.createDataFrame([(1, "百千，萬", "bách thiên vạn"), (2, "百千", "thiên"), (3, None, "x"), (4, "百", None)], "k int, t string, r string")
    got = sorted((x.k, x.pos, x.sn, x.qn) for x in sequences.paired_readings(rows, ["k"], "t", "r").collect())
    assert got == [(1, 1, "百", "bách"), (1, 2, "千", "thiên"), (1, 3, "萬", "vạn"), (2, 1, "百", None), (2, 2, "千", "thiên"), (4, 1, "百", None)]
    lists = [("a b c", "a x c d"), ("a", "a"), ("", ""), (None, "a b"), ("a a b", "b a a")]
    told = spark.createDataFrame(lists, "a string, b string").select(sequences.token_similarity(*(F.filter(F.split(c, " "), lambda t: t != "") for c in "ab")).alias("s"))
    assert [round(r.s, 4) for r in told.collect()] == [0.5, 1.0, 1.0, 0.0, round(1 / 3, 4)]
    texts = ["Một hai-\nba \\bf{x}  bốn , năm", " 12 Sáu\n bảy [3 a] tám!", None, "", "thường", "a * * b • c"]
    df = sequences.with_provenance(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    for r in df.collect():
        if r.t is not None:
            assert r.places is not None and len(r.places) == len(r.clean) and r.places == sorted(r.places)
            assert all(c == r.t[k] for c, k in zip(r.clean, r.places) if c != " ")


def test_restreamed_rows(spark):
    rows = [("v", 1, 1, "a", "Một hai. Ba"), ("v", 1, 2, "b", "bốn."), ("v", 2, 1, "c", None), ("v", 2, 2, "d", ""), ("v", 3, 1, "e", "Năm! Sáu")]
    df = spark.createDataFrame(rows, "vol string, page int, k int, id string, t string")
    got = stream.restreamed(df, ["vol"], ["page", "k", "id"], "t").orderBy("sent_no").collect()
    assert [(r.sentence, r.start_at, r.end_at, r.page, r.ids) for r in got] == [
        ("Một hai.", 0, 8, 1, ["a"]), ("Ba bốn.", 9, 16, 1, ["a", "b"]), ("Năm!", 18, 22, 3, ["e"]), ("Sáu", 23, 26, 3, ["e"]),
    ]
    assert stream.restreamed(df.limit(0), ["vol"], ["page", "k", "id"], "t").count() == 0


def test_page_sentences(spark):
    rows = [("v", 1, 1, "a", "甲乙。丙", False), ("v", 1, 2, "b", "丁！", True), ("v", 2, 1, "c", "戊己", False), ("v", 2, 2, "d", "庚", None)]
    df = spark.createDataFrame(rows, "vol string, page int, k int, id string, t string, is_dbl boolean")
    got = stream.page_sentences(df, ["vol", "page"], ["k", "id"], "t", "。！，", "。！").orderBy("page", "sent_no").collect()
    assert [(r.page, r.segment, r.box_ids, r.is_dbl) for r in got] == [
        (1, "甲乙。", ["a"], False), (1, "丙丁！", ["a", "b"], True), (2, "戊己", ["c"], False), (2, "庚", ["d"], False),
    ]


def test_views_progress_and_remarks(spark):
    rows = spark.createDataFrame([("v", "a", "x"), ("v", "b", "y"), ("v", "c", "z"), ("v", "d", None)], "vol string, id string, t string")
    edits = spark.createDataFrame([("v", "a", "X", True, "edit"), ("v", "b", None, None, "drop"), ("v", "c", "z", False, "edit")], "vol string, id string, correct string, reviewed boolean, fix_type string")
    flags = spark.createDataFrame([("v", "c"), ("v", "c"), ("v", "d")], "vol string, id string")
    ids = lambda name: sorted(r.id for r in patching.view(rows, edits, flags, ["vol", "id"], "t", name).collect())
    assert {n: ids(n) for n in patching.VIEWS} == {"all": list("abcd"), "flagged": ["c", "d"], "unreviewed": ["c", "d"], "edited": ["a"], "dropped": ["b"]}
    assert tuple(patching.review_progress(rows, edits, flags, ["vol", "id"], "t", ["vol"]).first()) == ("v", 4, 2, 1, 2)
    sentences = spark.createDataFrame([("v", "s", ["c", "a"]), ("v", "t", None), ("v", "u", [])], "vol string, id string, boxes array<string>")
    remarks = spark.createDataFrame([("v", "a", "char"), ("v", "c", "box"), ("w", "a", "no")], "vol string, id string, level string")
    got = patching.gathered_flags(sentences, ["vol", "id"], "boxes", remarks, ["vol"]).collect()
    assert [(r.id, [tuple(x) for x in r.remarks]) for r in got] == [("s", [("c", "box"), ("a", "char")])]
    made = spark.createDataFrame([(["b", "a"], "c"), (None, "x"), (["a"], None)], "ids array<string>, new string").select(patching.with_id_added(F.col("ids"), F.col("new")).alias("x"))
    assert [r.x for r in made.collect()] == [["a", "b", "c"], ["x"], ["a"]]
