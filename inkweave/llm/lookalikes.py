"""One form for texts that look the same (problem 5): a look-alike lattice searched by Viterbi.

Ignorable characters are deleted, compatibility forms decomposed, every kind of space made U+0020
and the ends trimmed, all in the JVM. What is left may still hold letters that look like another
(a katakana for an ideograph, a Cyrillic for a Latin letter, a radical for its ideograph). Every such
character opens its candidates as states of a lattice; the path with the best script-consistent
n-gram score is the consistent form.

Two kinds of characters open candidates. Characters drawn exactly alike open their whole class, so
texts that differ in them only have one lattice and one form; the scores decide which member is
written (a word of letters that three scripts share is written in the script of its surroundings and of
the corpus). Characters that look like several others (``SEVERAL``) open the classes of all of them; there
the scores decide what is read, and so which texts read alike.

The scores come from all rows: how often each candidate stands behind a character of each script and
before one. That table has at most (candidates x scripts x 2) rows, so it is broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfc, nfkd, strip_ignorable
from inkweave.session import cut_lineage

# Look-alikes, first the plain character, then others drawn the same way. Two unified
# ideographs never share a class: those differ on paper.
KANA = "二ニ 八ハ 力カ 工エ 口ロ 夕タ 一ーㄧ 丿ノ 厶ㄙ 丫ㄚ"
RADICALS = (
    "厂⺁ㄏ 几⺇ 卜⺊ト 尢⺐ 巳⺒ 幺⺓ㄠ 彑⺔ 彐⺕ 忄⺖ 扌⺘ 攵⺙ 旡⺛ 日⺜ 月⺝ 歺⺞ 母⺟ 民⺠ 氵⺡ 氺⺢ 灬⺣ 爫⺤ 丬⺦ 犭⺨ 王⺩ 疋⺪ "
    "目⺫ 示⺬ 礻⺭ 糹⺯ 纟⺰ 罓⺱ 罒⺲ 网⺳ 冈⺴ 羊⺶ 耂⺹ 肀⺺ 聿⺻ 肉⺼ 臼⺽ 艹⺾ 虎⻁ 衤⻂ 覀⻃ 西⻄ 见⻅ 角⻆ 讠⻈ 贝⻉ 足⻊ 车⻋ "
    "辶⻌ 阝⻏ 钅⻐ 長⻑ 镸⻒ 长⻓ 门⻔ 雨⻗ 青⻘ 韦⻙ 页⻚ 风⻛ 飞⻜ 食⻝ 飠⻞ 饣⻠ 马⻢ 骨⻣ 鬼⻤ 鱼⻥ 鸟⻦ 卤⻧ 麦⻨ 黄⻩ 黾⻪ 斉⻫ 齐⻬ "
    "歯⻭ 齿⻮ 竜⻯ 龙⻰ 龜⻱ 亀⻲ 龟⻳"
)
LETTERS = (
    "aаɑα bЬ cсϲ dԁ eе gɡ hһ iі jј kκк mм nո oоοօ pрρ qԛ sѕ uս vνѵ wԝ xхχ yуγ "
    "AАΑ BВΒ CСϹ EЕΕ HНΗ IІΙ JЈ KКΚ MМΜ NΝ OОΟ PРΡ SЅ TТΤ XХΧ YҮΥ ZΖ"
)
# Signs drawn like several others: a palochka or a bar-like click as a small l or a capital i, rings
# as the ideographic zero or a letter.
SEVERAL = {"ӏ": "lI", "Ӏ": "lI", "ǀ": "lI", "○": "〇O", "◯": "〇O"}
CLASSES = [c for part in (KANA, RADICALS, LETTERS) for c in part.split()]
CLASS_OF = {x: c for c in CLASSES for x in c}
#: What each character may be: the states that it opens.
STATES = CLASS_OF | {x: "".join(CLASS_OF.get(o, o) for o in seen) for x, seen in SEVERAL.items()}
#: All states, whose neighbours are counted.
MEMBERS = sorted(set("".join(STATES.values())))
SCRIPTS = [
    ("han", "⺀-⿟〇㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"), ("kana", "぀-ヿㇰ-ㇿ"),
    ("bopomofo", "㄀-ㄯ"), ("latin", "A-Za-zÀ-ɏɐ-ʯḀ-ỿ\u0300-\u036f"), ("greek", "Ͱ-Ͽ"),
    ("cyrillic", "Ѐ-ԯ"), ("armenian", "԰-֏"), ("digit", "0-9"), ("space", " "),
]
_SCRIPT = [(s, re.compile(f"[{c}]")) for s, c in SCRIPTS]
OTHER, EDGE = "other", "edge"


@lru_cache(maxsize=65_536)
def script_of(ch: str) -> str:
    return next((s for s, p in _SCRIPT if p.match(ch)), OTHER)


def skeleton(text: Column) -> Column:
    """Without ignorable characters, compatibility-decomposed, one kind of space, ends trimmed."""
    spaced = F.regexp_replace(nfkd(strip_ignorable(text)), r"(?U)[\s\x{2800}]", " ")
    return F.trim(F.regexp_replace(spaced, r"[\p{Cc}]", ""))


class Scores:
    """How usual a candidate is behind and before a script, as smoothed log-probabilities."""

    def __init__(self, counts: list[tuple[str, str, str, int]]) -> None:
        self.n: dict[tuple[str, str, str], int] = {}
        for ch, side, script, n in counts:
            self.n[ch, side, script] = self.n.get((ch, side, script), 0) + n
        self.all = sum(self.n.values()) + 1
        self.memo: dict[tuple[str, str, str], str] = {}

    def beside(self, ch: str, side: str, script: str) -> float:
        return math.log((self.n.get((ch, side, script), 0) + 0.5) / self.all)

    def step(self, before: str, ch: str | None, script: str) -> float:
        """From a script to a candidate (none: one without look-alikes), with a bonus for staying in the script."""
        bonus = 2.0 if before == script else 0.0
        return bonus if ch is None else bonus + self.beside(ch, "behind", before)

    def run(self, left: str, run: str, right: str) -> str:
        """The best path through a run of ambiguous characters between two scripts; ties go to the plainer one."""
        if (out := self.memo.get((left, run, right))) is not None:
            return out
        best: dict[str, tuple[float, list[str]]] = {left: (0.0, [])}  # by the script of the last character
        for k, ch in enumerate(run):
            to: dict[str, tuple[float, list[str]]] = {}
            for o in STATES[ch]:
                script = script_of(o)
                score, path = max(((s + self.step(b, o, script), p) for b, (s, p) in best.items()), key=lambda x: x[0])
                if k == len(run) - 1:
                    score += self.beside(o, "before", right)
                if script not in to or score > to[script][0]:
                    to[script] = (score, [*path, o])
            best = to
        out = "".join(max(((s + self.step(b, None, right), p) for b, (s, p) in best.items()), key=lambda x: x[0])[1])
        if len(run) <= 16 and len(self.memo) < 100_000:
            self.memo[left, run, right] = out
        return out


_RUN = re.compile(f"[{''.join(STATES)}]+")


def plain_form(text: str, scores: Scores) -> str:
    """The Viterbi path of a skeleton. Characters without look-alikes are single states, so the lattice
    falls apart into the runs between them, each solved once per pair of neighbouring scripts."""

    def best(m: re.Match) -> str:
        left = script_of(text[m.start() - 1]) if m.start() else EDGE
        right = script_of(text[m.end()]) if m.end() < len(text) else EDGE
        return scores.run(left, m.group(), right)

    return _RUN.sub(best, text)


def neighbour_counts(texts: DataFrame, skeleton_col: str = "skeleton") -> DataFrame:
    """member, side, script, n: how often each candidate stands behind and before a character of each script, over all rows."""
    chars = F.split(F.col(skeleton_col), "")
    beside = lambda c, side, k: F.struct(c.alias("member"), F.lit(side).alias("side"), F.try_element_at("chars", k).alias("other"))
    both = lambda c, k: F.array(beside(c, "behind", F.when(k > 0, k)), beside(c, "before", F.when(k + 1 < F.size("chars"), k + 2)))
    held = texts.where(F.col(skeleton_col).rlike(f"[{''.join(MEMBERS)}]")).select(chars.alias("chars"))
    pairs = held.select(F.explode(F.filter(F.flatten(F.transform("chars", both)), lambda x: x["member"].isin(*MEMBERS))).alias("x")).select("x.*")
    script = F.lit(OTHER)
    for name, part in reversed(SCRIPTS):
        script = F.when(F.col("other").rlike(f"[{part}]"), name).otherwise(script)
    counted = pairs.groupBy("other", "side", "member").agg(F.count("*").alias("n"))
    named = counted.select("member", "side", F.when(F.col("other").isNull(), EDGE).otherwise(script).alias("script"), "n")
    return named.groupBy("member", "side", "script").agg(F.sum("n").alias("n"))


def consistent_form(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """``df`` with the consistent form of ``text`` as column ``out``; null stays null, an empty text empty.

    Rows that read the same on paper get the same form. Counts are taken over all rows of ``df``.
    Repeated rows get the same form; an empty table stays empty; other columns are kept as they are.
    """
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    counts = neighbour_counts(df.select(skeleton(F.col(text)).alias("skeleton"))).collect()  # at most candidates x scripts x 2
    shared = df.sparkSession.sparkContext.broadcast(sorted((r.member, r.side, r.script, r.n) for r in counts))

    @F.pandas_udf("string")
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores = Scores(shared.value)
        for s in texts:
            yield pd.Series([None if t is None else plain_form(t, scores) for t in s], dtype=object)

    return df.withColumn(out, F.trim(nfc(search(skeleton(F.col(text))))))


def read_alike_pairs(rows: DataFrame, group: list[str], key: str, text: str, least: int = 6) -> DataFrame:
    """``group`` columns, id_a, id_b: rows of a group that read the same but are not equal character by character.

    Only texts of at least ``least`` visible characters count. Equal texts are never paired: different
    spellings of one form are paired first, then the rows that have them, so a group in which most rows
    are copies costs no more than the pairs it really has. Null keys and texts give no pair.
    """
    have = [F.col(g).alias(f"g{k}") for k, g in enumerate(group)]
    named = rows.select(*have, F.col(key).alias("id"), F.col(text).alias("raw")).where("raw is not null and id is not null")
    by = [f"g{k}" for k in range(len(group))] + ["form"]
    formed = consistent_form(named, "raw").where(F.length(F.replace("form", F.lit(" "))) >= least)
    formed = cut_lineage(formed.repartition(*by))
    several = formed.groupBy(*by).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select(*by)
    mine = formed.join(several, by, "left_semi")
    spelt = mine.select(*by, "raw").distinct()
    pairs = spelt.withColumnRenamed("raw", "raw_1").join(spelt.withColumnRenamed("raw", "raw_2"), by).where("raw_1 < raw_2")
    one = pairs.join(mine.select(*by, F.col("raw").alias("raw_1"), F.col("id").alias("id_1")), [*by, "raw_1"])
    two = one.join(mine.select(*by, F.col("raw").alias("raw_2"), F.col("id").alias("id_2")), [*by, "raw_2"])
    return two.select(
        *(F.col(f"g{k}").alias(g) for k, g in enumerate(group)), F.least("id_1", "id_2").alias("id_a"), F.greatest("id_1", "id_2").alias("id_b")
    )
