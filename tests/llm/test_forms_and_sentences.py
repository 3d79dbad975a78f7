"""Look-alikes (p5) and sentence boundaries (p3)."""

from __future__ import annotations

import itertools
import os
import re
import unicodedata

import pytest

from inkweave.llm import lookalikes, sentences


def test_classes_hold_at_most_one_ideograph():
    for c in lookalikes.CLASSES:
        assert sum("㐀" <= x <= "鿿" for x in c) <= 1
    assert len("".join(lookalikes.CLASSES)) == len(set("".join(lookalikes.CLASSES)))


def test_pairs_against_brute_force(spark):
    same = ["瑞康二十年求賢", "瑞康ニ十年求賢", "瑞康⼆十年求賢", "瑞​康二十年求賢", "瑞康二十年求賢　", "瑞康二⼗年求賢︀"]
    other = ["瑞康 二十年求賢", "瑞康三十年求賢", "瑞康二十年求賢士"]
    noted = ["臣(tường)光敬書", "臣（ｔường）光敬書", "臣(" + unicodedata.normalize("NFD", "tường") + ")光敬書", "臣(tườпg)光敬書"]
    rows = [("v", 1, f"a{k}", t) for k, t in enumerate(same + other + noted)] + [("v", 1, "dup", same[0]), ("v", 2, "far", same[1])]
    rows += [("v", 1, "null", None), ("v", 1, "short1", "二三"), ("v", 1, "short2", "ニ三"), ("v", 1, "empty", ""), (None, None, "n1", same[0]), (None, None, "n2", same[1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vol string, chapter int, id string, t string, form string")
    got = {(r.id_a, r.id_b) for r in lookalikes.read_alike_pairs(df, ["vol", "chapter"], "id", "t").collect()}
    groups = [[f"a{k}" for k in range(6)] + ["dup"], ["a9", "a10", "a11"]]
    text = {r[2]: r[3] for r in rows}
    want = {tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2) if text[p[0]] != text[p[1]]}
    assert got == want
    assert lookalikes.read_alike_pairs(df.limit(0), ["vol"], "id", "t").count() == 0


def test_forms(spark):
    df = spark.createDataFrame([("ニ月",), ("カ行",), ("カタカナ",), (None,), ("",), ("x" * 5000 + "二",)] + [("十二月力行",)] * 4, "t string")
    got = [r.form for r in lookalikes.consistent_form(df, "t").collect()]
    assert got[0] == "二月" and got[1] == "力行" and got[3] is None and got[4] == "" and len(got[5]) == 5001
    with pytest.raises(ValueError):
        lookalikes.consistent_form(df.withColumnRenamed("t", "form"), "form")


def test_the_scores_decide_the_form():
    """A word of letters that two scripts share is written in the script that the corpus uses; a ring is what its place holds."""
    latin = lookalikes.Scores([(c, "behind", "latin", 50) for c in "aceopxyHATMl"])
    russian = lookalikes.Scores([(c, "behind", "cyrillic", 50) for c in "асеорхуНАТМ"])
    assert lookalikes.plain_form("сосо xyz", latin) == "coco xyz" and lookalikes.plain_form("coco жук", russian) == "сосо жук"
    small, capital = (lookalikes.Scores([(c, "behind", s, 90) for s in ("latin", "space", "edge")]) for c in "lI")
    assert lookalikes.plain_form("aӏb", small) == "alb" and lookalikes.plain_form("aӏb", capital) == "aIb"
    assert lookalikes.plain_form("二○三", lookalikes.Scores([])) == "二〇三" and lookalikes.plain_form("B○B", lookalikes.Scores([])) == "BOB"


def test_the_scores_decide_who_reads_alike(spark):
    """With a corpus of small l the sign is one, with a corpus of capital i it is that; so the pairs differ."""
    rows = [("p", "aӏbert aӏbert"), ("q", "albert albert"), ("r", "aIbert aIbert")]

    def pairs(usual):
        made = rows + [(f"x{k}", f"{usual * (k + 1)}") for k in range(20)]
        df = spark.createDataFrame([("v", *r) for r in made], "vol string, id string, t string")
        return {(r.id_a, r.id_b) for r in lookalikes.read_alike_pairs(df, ["vol"], "id", "t").collect()}

    assert pairs("alal ") == {("p", "q")} and pairs("aIaI ") == {("p", "r")}


def _letters(s):
    return sum(unicodedata.category(c)[0] in "LN" for c in s)


VI = [
    "Năm ấy, dài 720,7 dặm, cao 1.100 trượng.‖ Bấy giờ đi.",
    'Lại nữa, "Nuôi... nông." là lời cụ Ng. V. Hồ (NXB. sông Bạch, t. 9) để lại?‖ Ban cho TS. Sa.',
    "Nhà vua dụ rằng: «Việc ở kính trời, như rồng!»‖ Bấy giờ «Đi. Về!», Hà nghe vậy.",
    "cá, vàng hơn 900 cân, v.v.‖ Ban cho (xem t. 4, tr. 279).‖ xong...‖năm sau; rồi thôi",
    "Xem https://a.vn/x.y?z=1 nhé.‖Rồi thôi!‖ ",
    "một câu", "", "...",
]
HAN = [
    "是歲，柳武永曰：「𡗶高堂遠，𠀧𢆥法祖」‖是歲，「養老。重農。」泉花景之言焉。‖瑞康十年賜桂青新馬四萬兩，以免稅有功；‖既而",
    "又孝樂縣之民以金二十七艘從溪思敬減刑耳‖蓋賜溪安安木一萬二千五百兩以修堤有功‖是歲以樂青縣天旱命醫官掘井矣‖開渠敬天鐵白平之言焉",
    "儉德也者治國之本龍在雲‖瑞康二十年冬十月上問泉精輝曰免稅焉能不愛民",
    "無", "",
]


@pytest.fixture(scope="module")
def model(spark):
    rows = "/root/testdata/sf0.1/han_sentences.parquet"
    if not os.path.exists(rows):
        pytest.skip("needs the test tables")
    return sentences.learn_boundaries(spark.read.parquet(rows), "sinonom")


@pytest.mark.parametrize("script,texts", [("vi", VI), ("han", HAN)])
def test_boundaries(spark, script, texts, model):
    raw = [(k, t.replace("‖", "")) for k, t in enumerate(texts)] + [(90, None)]
    df = spark.createDataFrame(raw, "k int, t string")
    got: dict[int, list[int]] = {}
    for r in sentences.sentence_boundaries(df, "t", script, "k", model=model).collect():
        got.setdefault(r.k, []).append(r.boundary_at)
    for k, t in enumerate(texts):
        parts = t.split("‖")
        want = [_letters("".join(parts[: j + 1])) for j in range(len(parts) - 1) if _letters("".join(parts[j + 1 :]))]
        assert sorted(got.get(k, [])) == want, t
    units = sentences.sentence_units(df, "t", script, "k", model=model).collect()
    for k, t in enumerate(texts):
        n = len([p for p in t.split("‖") if re.search(r"\w", p)])
        assert len([u for u in units if u.k == k]) == n
    assert sentences.sentence_boundaries(df.limit(0), "t", script, "k").count() == 0
    with pytest.raises(ValueError):
        sentences.sentence_units(df, "t", "en", "k")


def test_radical_signs_are_no_letters(spark):
    df = spark.createDataFrame([(1, "是⽉⼆人行。又")], "k int, t string")
    assert [r.boundary_at for r in sentences.sentence_boundaries(df, "t", "han", "k").collect()] == [3]


# Classical passages of another kind than the labelled rows.
FOREIGN = [
    "賢哉回也。一簞食，一瓢飲，在陋巷，人不堪其憂，回也不改其樂。賢哉回也。", "知者樂水，仁者樂山。知者動，仁者靜。知者樂，仁者壽。",
    "三人行，必有我師焉。擇其善者而從之，其不善者而改之。", "歲寒，然後知松柏之後彫也。知者不惑，仁者不憂，勇者不懼。", "逝者如斯夫！不舍晝夜。吾未見好德如好色者也。",
    "君子坦蕩蕩，小人長戚戚。士不可以不弘毅，任重而道遠。仁以為己任，不亦重乎？死而後已，不亦遠乎？", "魚，我所欲也。熊掌，亦我所欲也。二者不可得兼，舍魚而取熊掌者也。",
    "民為貴，社稷次之，君為輕。是故得乎丘民而為天子，得乎天子為諸侯，得乎諸侯為大夫。", "子在川上曰。不義而富且貴，於我如浮雲。發憤忘食，樂以忘憂，不知老之將至也。我非生而知之者也。",
]


def _bare(text):
    ends, n = set(), 0
    for c in text:
        n += c.isalnum()
        if c in "。！？；":
            ends.add(n)
    return re.sub(r"\W", "", text), ends - {n}


def test_bare_text_of_other_kinds(spark, model):
    """Passages of another kind than the labelled rows: 8 of 17 ends were found, and 8 of 17 places given were one."""
    bare = [_bare(t) for t in FOREIGN]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(bare)], "k int, t string")
    got = {(r.k, r.boundary_at) for r in sentences.sentence_boundaries(df, "t", "han", "k", model=model).collect()}
    want = {(k, n) for k, (_, ends) in enumerate(bare) for n in ends}
    assert len(got & want) >= 0.3 * len(want) and len(got & want) >= 0.3 * len(got)


def test_bare_text_is_cut_by_what_was_learnt(spark):
    """The same bare row is cut elsewhere after other labelled rows; what was held out of them is still found."""
    a = [("甲乙丙丁。戊己庚辛。",), ("壬癸丙丁。戊己子丑。",), ("寅卯丙丁。戊己辰巳。",)] * 4
    b = [("甲乙。丙丁戊己。庚辛。",), ("壬癸。丙丁戊己。子丑。",), ("寅卯。丙丁戊己。辰巳。",)] * 4
    bare = spark.createDataFrame([(1, "午未丙丁戊己申酉")], "k int, t string")
    cut = lambda rows: [r.boundary_at for r in sentences.sentence_boundaries(bare, "t", "han", "k", model=sentences.learn_boundaries(spark.createDataFrame(rows, "t string"), "t")).collect()]
    assert sorted(cut(a)) == [4] and sorted(cut(b)) == [2, 6]


def test_held_out_statements_of_the_corpus(spark):
    """Statements of a kind that no labelled row holds are still told apart from their neighbours."""
    rows = "/root/testdata/sf0.1/han_sentences.parquet"
    if not os.path.exists(rows):
        pytest.skip("needs the test tables")
    df = spark.read.parquet(rows).select("vol", "id", "sinonom").distinct()
    for word in ("築", "收"):
        model = sentences.learn_boundaries(df.where(~df.sinonom.contains(word)), "sinonom")
        marked = [r.sinonom for r in df.where(df.sinonom.contains(word) & df.sinonom.rlike("。") & ~df.sinonom.rlike("[「『（(]")).orderBy("vol", "id").limit(60).collect()]
        bare = [_bare(unicodedata.normalize("NFKC", t).replace("!", "！").replace("?", "？").replace(";", "；")) for t in marked]
        made = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(bare)], "k int, t string")
        got = {(r.k, r.boundary_at) for r in sentences.sentence_boundaries(made, "t", "han", "k", model=model).collect()}
        want = {(k, n) for k, (_, ends) in enumerate(bare) for n in ends}
        assert len(want) > 5 and len(got & want) >= 0.8 * len(want) and len(got & want) >= 0.9 * len(got), (word, len(want), len(got), len(got & want))


def test_clashing_names_and_repeated_bare_rows(spark):
    df = spark.createDataFrame([(1, 2, "甲乙矣丙丁", "z")] * 2, "k int, x int, t string, __extra string")
    units = sentences.sentence_units(df, "t", "han", "k", "x").collect()
    assert len(units) % 2 == 0 and {r.k for r in units} == {1}


def test_long_quotations_and_links(spark):
    link = "https://a.vn/" + "x" * 300 + ".html?q=1"
    vi = [f"Dụ: «{'Đi mau. ' * 900}Về!», Hà nghe.‖ Xong.", f'Hà nói "{"Đi mau. " * 900}Về" rồi thôi.‖ Xong.', f"Xem {link} nhé.‖ Xong.", f"{'Đi mau. ' * 3}‖«mở".replace(". Đ", ".‖ Đ").replace(". ‖", ".‖ ")]
    han = [f"是歲，柳曰：「{'養老。' * 900}」‖是歲，重農。‖既而"]
    for script, texts in (("vi", vi), ("han", han)):
        df = spark.createDataFrame([(str(k), t.replace("‖", "")) for k, t in enumerate(texts)], "id string, t string")
        got = {(r.id, r.boundary_at) for r in sentences.sentence_boundaries(df, "t", script, "id").collect()}
        want = {(str(k), _letters("".join(t.split("‖")[: j + 1]))) for k, t in enumerate(texts) for j in range(t.count("‖"))}
        assert got == want
