"""Sentence alignment (p2): kernels against brute force, held-out pairs of made-up chapters."""

from __future__ import annotations

import random

import pytest

from inkweave.llm import alignment as A


@pytest.mark.parametrize("text,n", [("二十四", 24), ("五萬五千二百五十", 55250), ("一百一十", 110), ("十", 10), ("元", 1), ("三百二", 302), ("二萬", 20000), ("十二", 12)])
def test_numbers(text, n):
    assert A.han_number(text) == n


def test_heaviest_chain_against_brute_force():
    r = random.Random(5)
    for _ in range(200):
        pts = [(r.randint(0, 6), r.randint(0, 6), r.choice([1.0, 2.0, 3.5])) for _ in range(r.randint(0, 8))]
        best = 0.0
        for mask in range(1 << len(pts)):
            s = sorted(p for k, p in enumerate(pts) if mask >> k & 1)
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(s, s[1:])):
                best = max(best, sum(p[2] for p in s))
        got = [pts[k] for k in A.heaviest_chain(pts)]
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
        assert sum(p[2] for p in got) == pytest.approx(best)


def _chapters(n, seed):
    r = random.Random(seed)
    chars = {c: s for c, s in zip("柳桂江泉沙松霜溪湖石桑竹孝忠信仁義禮智清明光", "liễu quế giang tuyền sa tùng sương khê hồ thạch tang trúc hiếu trung tín nhân nghĩa lễ trí thanh minh quang".split())}
    han, vi, truth = [], [], set()
    for ch in range(n):
        pairs = []
        for k in range(12):
            name = r.sample(sorted(chars), 3)
            m = r.randint(100, 900)
            digits = "〇一二三四五六七八九"
            number = f"{digits[m // 100]}百" + (f"{digits[m // 10 % 10]}十" if m // 10 % 10 else "") + (digits[m % 10] if m % 10 else "")
            pairs.append((f"賜{''.join(name)}馬{number}匹以設學有功矣。", f"Ban cho {' '.join(chars[c].title() for c in name)} {m} con ngựa vì có công lập trường học."))
        order = list(range(12))
        order[3], order[9] = order[9], order[3]  # a moved passage
        dropped = r.randrange(12)
        for k, (h, _) in enumerate(pairs):
            han.append(("v", ch, 1, k, f"h{ch}.{k:02d}", h, False))
        for at, k in enumerate(order):
            if k != dropped:
                vi.append(("v", ch, 2, at, f"x{ch}.{at:02d}", pairs[k][1]))
                truth.add((f"h{ch}.{k:02d}", f"x{ch}.{at:02d}"))
    han.append(("v", 0, 1, 99, "dbl", han[0][5], True))
    return han, vi, truth, chars


def test_rows_of_made_up_chapters(spark):
    han, vi, truth, chars = _chapters(8, 2)
    h = spark.createDataFrame([(*x, "e") for x in han], "vol string, chapter int, page int, sent_idx int, id string, sinonom string, is_dbl boolean, side string")
    v = spark.createDataFrame([*vi, ("v", 0, 2, 50, "null", None), ("v", None, 2, 51, "nowhere", vi[0][5]), ("v", 77, 1, 1, "alone", vi[0][5])], "vol string, chapter int, page int, sent_idx int, id string, text string")
    hv = spark.createDataFrame([(c, s, None) for c, s in chars.items()] + [("無", None, None)], "sinonom_char string, am_han_viet string, all_readings string")
    s2 = spark.createDataFrame([("ngựa", ["馬"]), (None, ["x"])], "key string, values array<string>")
    got = {(r.han_id, r.vie_id) for r in A.aligned_rows(h, v, hv, s2).collect()}
    assert len(got & truth) >= 0.97 * len(truth) and len(got & truth) >= 0.97 * len(got)
    # The same links where the lexicon goes by chapters.
    assert {(r.han_id, r.vie_id) for r in A.aligned_sentences(h, v, hv, s2, most=0).collect()} == got
    assert A.aligned_rows(h.limit(0), v.limit(0), hv, s2).count() == 0


def _chapter(han, vi, least=1.0):
    chapter = A.Chapter([set(x.split()) for x in han], [set(x.split()) for x in vi], least)
    for i, j in sorted(chapter.score):
        chapter.of[i].append(j)
    return chapter


def test_local_programme_keeps_order():
    c = _chapter(["b1 b2", "a1 a2", "c1 c2"], ["a1 a2", "b1 b2", "c1 c2"])
    assert sorted(A._local(c, [0, 1, 2], [0, 1, 2], 1.0)) in ([(0, 1), (2, 2)], [(1, 0), (2, 2)])
    assert A._local(c, [], [0], 1.0) == []


def test_one_sentence_against_two():
    """A sentence whose rendering is in two neighbours is linked to both, not to one that says nothing new."""
    c = _chapter(["a1 a2 a3 b1 b2 b3", "c1 c2"], ["a1 a2 a3", "b1 b2 b3", "c1 c2"])
    assert A._local(c, [0, 1], [0, 1, 2], 1.0) == [(0, 0), (0, 1), (1, 2)]
    c = _chapter(["a1 a2 a3", "b1 b2 b3"], ["a1 a2 a3 b1 b2 b3"])
    assert A._local(c, [0, 1], [0], 1.0) == [(0, 0), (1, 0)]
    c = _chapter(["a1 a2 a3"], ["a1 a2 a3", "a1 a2"])
    assert A._local(c, [0], [0, 1], 1.0) == [(0, 0)]


def test_local_programme_against_brute_force():
    r = random.Random(3)
    for _ in range(60):
        words = [f"w{k}" for k in range(9)]
        han, vi = ([" ".join(r.sample(words, r.randint(0, 4))) for _ in range(r.randint(1, 5))] for _ in range(2))
        c = _chapter(han, vi, 0.4)
        steps = A._steps(c, list(range(len(han))), list(range(len(vi))), 0.4)

        def best(i, j):
            return max([0.0, *(g + best(a[-1] + 1, b[-1] + 1) for a, b, g in steps if a[0] >= i and b[0] >= j)])

        got = A._best_steps(c, list(range(len(han))), list(range(len(vi))), 0.4)
        assert all(x[0][-1] < y[0][0] and x[1][-1] < y[1][0] for x, y in zip(got, got[1:]))
        assert abs(sum(g for *_, g in got) - best(0, 0)) < 1e-6


def test_no_candidate_is_lost_to_anchors_that_stand_everywhere():
    """Every pair whose common weight reaches the least score is a candidate, however often its anchors stand."""
    r = random.Random(5)
    for _ in range(40):
        words = [f"w{k}" for k in range(6)]
        han, vi = ([set(r.sample(words, r.randint(0, 6))) for _ in range(30)] for _ in range(2))
        c = A.Chapter(han, vi, 0.9)
        want = {(i, j) for i in range(30) for j in range(30) if sum(c.weight[a] for a in han[i] & vi[j]) >= 0.9}
        assert set(c.score) == want


def test_long_gap(spark):
    """A gap of a thousand by a thousand sentences, over any former bound of cells."""
    c = _chapter([f"a{k} b{k}" for k in range(1000)], [f"a{k} b{k}" for k in range(1000)])
    assert A._local(c, list(range(1000)), list(range(1000)), 1.0) == [(k, k) for k in range(1000)]


def test_lexicon_is_learnt_from_all_chapters(spark):
    """Words of nine chapters each among 900; the last chapter of each topic has no other evidence."""
    topics, each, names = 30, 9, {"柳": "liễu", "桂": "quế", "江": "giang"}
    syllables = [f"{a}{b}" for a in ("b", "d", "g", "h", "k", "l", "m", "n", "ph", "r", "s", "t", "v", "x", "ch", "th") for b in ("an", "em", "in", "ong", "ut", "yn", "ac", "oi", "au", "ep", "it", "oc", "un", "am", "iu")]
    han, vi = [], []
    for ch in range(900):
        topic, k = divmod(ch, each + 1)
        words = "".join(chr(0x5000 + 8 * topic + j) for j in range(8)) if topic < topics else ""
        said = " ".join(syllables[8 * topic : 8 * topic + 8]) if topic < topics else ""
        anchored = k < each or topic >= topics
        han.append(("v", ch, 1, 0, f"h{ch}", ("柳桂江" if anchored else "") + words + "。", False))
        vi.append(("v", ch, 1, 0, f"x{ch}", ("Liễu Quế Giang " if anchored else "") + said + "."))
    h = spark.createDataFrame(han, "vol string, chapter int, page int, sent_idx int, id string, sinonom string, is_dbl boolean")
    v = spark.createDataFrame(vi, "vol string, chapter int, page int, sent_idx int, id string, text string")
    hv = spark.createDataFrame([(c, s, None) for c, s in names.items()], "sinonom_char string, am_han_viet string, all_readings string")
    s2 = spark.createDataFrame([("ngựa", ["馬"])], "key string, values array<string>")
    got = {r.han_id for r in A.aligned_rows(h, v, hv, s2).collect()}
    assert {f"h{t * (each + 1) + each}" for t in range(topics)} <= got


def test_learnt_pairs_against_brute_force(spark):
    r = random.Random(7)
    rows = [(r.sample("abcdefgh", r.randint(0, 5)), r.sample("stuvwxyz", r.randint(0, 5))) for _ in range(60)]
    rows += [(["q"], ["r"])] * 8 + [(["o"], ["p"])] * 7
    want: dict[str, set[str]] = {}
    for a in "abcdefghqo":
        for b in "stuvwxyzrp":
            n, na, nb = sum(a in h and b in v for h, v in rows), sum(a in h for h, _ in rows), sum(b in v for _, v in rows)
            if n >= 8 and 2 * n >= 0.5 * (na + nb):
                want.setdefault(a, set()).add(b)
    df = spark.createDataFrame(rows, "h array<string>, v array<string>")
    assert {(r.h, r.v) for r in A.learn_pairs(df).collect()} == {(h, v) for h, vs in want.items() for v in vs} and want["q"] == {"r"} and "o" not in want
    assert A.learn_pairs(df.limit(0)).count() == 0
