"""Sentence alignment of the two languages of a chapter (problem 2).

Both sides are split into sentences. Shared anchors link them: Sino-Vietnamese readings of neighbouring
characters that stand side by side on the other side (names, places, cognates), numbers however
written, and known word pairs. Sentences that are each other's best partner by anchors are chained by a
heaviest increasing subsequence, which gives the run of the chapter; strong partners off the chain stay
linked too (moved passages). The gaps between chained pairs are aligned by a local dynamic programme
(pairs, and one sentence against two or three) over what is left, with weaker evidence: a lexicon learnt from all anchored pairs of the corpus, so a
statement without any name finds its rendering as well. Linked sentences give linked rows.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfc
from inkweave.llm.boundaries import Gaps
from inkweave.llm.sentences import sentence_units
from inkweave.session import cut_lineage
from inkweave.sources.tables import dealt

#: Largest lexicon (characters with readings, word pairs, learnt pairs) that is broadcast, in rows.
MOST_LEXICON = 500_000

_DIGITS = {c: k for k, c in enumerate("〇一二三四五六七八九")} | {"元": 1, "正": 1}
_SCALE = {"十": 10, "百": 100, "千": 1000, "萬": 10_000}
# Vietnamese number words, with the names of the first and the last month.
_WORDS = {
    "một": 1, "hai": 2, "ba": 3, "bốn": 4, "tư": 4, "năm": 5, "sáu": 6, "bảy": 7, "tám": 8, "chín": 9, "mười": 10,
    "giêng": 1, "chạp": 12, "nhất": 1, "nhì": 2,
}
_HAN_NUMBER = re.compile("[元正〇一二三四五六七八九十百千萬]+")
_VI_NUMBER = re.compile(r"(?<![\d.,])\d{1,3}(?:\.\d{3})+(?!\d)|\d+")


_BROKEN = re.compile(r"(?<![^\W\d_])([bcdđghklmnpqrstvx]{1,3})[-‐–¬]\s*\n\s*", re.I)
_SYLLABLES = re.compile(r"[^\W\d_]+")


def han_number(s: str) -> int:
    total = part = digit = 0
    for c in s:
        if c in _DIGITS:
            digit = digit * 10 + _DIGITS[c] if digit and "十" not in s else _DIGITS[c]
        elif c == "萬":
            total, part, digit = (total + part + digit or 1) * 10_000, 0, 0
        else:
            part, digit = part + (digit or 1) * _SCALE[c], 0
    return total + part + digit


def han_anchors(unit: str, readings: dict[str, set[str]], pairs: set[str]) -> set[str]:
    """Anchors of a Chinese sentence: 'r1 r2' by readings, '#n' numbers, '=words' known words."""
    text = re.sub(r"[^\w]", "", unit)
    out = set()
    for a, b in zip(text, text[1:]):
        if a in readings and b in readings:
            out.update([f"{x} {y}" for x in readings[a] for y in readings[b]])
        if a + b in pairs:
            out.add(f"={a}{b}")
    out.update([f"#{han_number(m)}" for m in _HAN_NUMBER.findall(text)])
    return out


def vi_syllables(unit: str) -> list[str]:
    """Lower-case syllables; one that was cut by a line end is joined, a compound is not."""
    t = unicodedata.normalize("NFC", unit)
    if "\n" in t:
        t = _BROKEN.sub(r"\1", t)
    return _SYLLABLES.findall(t.lower())


def vi_anchors(unit: str, words: dict[str, set[str]], heads: set[str] | None = None) -> set[str]:
    """Anchors of a Vietnamese sentence, of the same kinds. ``heads``: the first syllables of the words, to look up only what may be one."""
    s = vi_syllables(unit)
    out = {f"{a} {b}" for a, b in zip(s, s[1:])}
    for k, first in enumerate(s):
        if heads is None or first in heads:
            for n in range(1, min(4, len(s) - k) + 1):
                if (word := " ".join(s[k : k + n])) in words:
                    out.update([f"={h}" for h in words[word] if len(h) > 1])
    for m in _VI_NUMBER.findall(unit):
        out.add(f"#{int(m.replace('.', ''))}")
    for k, w in enumerate(s):
        if w in _WORDS:
            nxt = s[k + 1] if k + 1 < len(s) else ""
            out.add(f"#{10 + _WORDS[nxt]}" if w == "mười" and 0 < _WORDS.get(nxt, 0) < 10 else f"#{_WORDS[w]}")
    return out


def weight(anchor: str) -> float:
    if anchor[0] == "#":
        n = int(anchor[1:])
        return 0.2 if n < 13 else 0.6 if n < 32 else 1.5
    return 0.7 if anchor[0] in "=~" else 1.0


def heaviest_chain(points: list[tuple[int, int, float]]) -> list[int]:
    """Indexes of the heaviest subsequence of (i, j, weight) that increases strictly in both i and j."""
    order = sorted(range(len(points)), key=lambda k: (points[k][0], -points[k][1]))
    js: list[int] = []  # staircase: j ascending with total ascending
    top: list[tuple[float, int]] = []
    back: dict[int, int] = {}
    for k in order:
        _, j, w = points[k]
        at = bisect.bisect_left(js, j)
        total = w + (top[at - 1][0] if at else 0.0)
        back[k] = top[at - 1][1] if at else -1
        while at < len(js) and top[at][0] <= total:
            js.pop(at), top.pop(at)
        if not at or top[at - 1][0] < total:
            js.insert(at, j)
            top.insert(at, (total, k))
    out, k = [], top[-1][1] if top else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


class Chapter:
    """Candidates between the sentences of a chapter's two sides, in reading order, with a score of at least ``least``.

    A sentence may leave out the anchors that make the most pairs as long as their weights together stay below
    ``least``: a pair that shares nothing else cannot reach it. So no candidate is lost, and anchors that stand
    everywhere make pairs only where they could matter.
    """

    def __init__(self, han: list[set[str]], vi: list[set[str]], least: float) -> None:
        self.n, self.m, self.han, self.vi = len(han), len(vi), han, vi
        where: dict[str, list[int]] = defaultdict(list)
        for j, anchors in enumerate(vi):
            for a in anchors:
                where[a].append(j)
        times: dict[str, int] = defaultdict(int)
        for anchors in han:
            for a in anchors:
                if a in where:
                    times[a] += 1
        self.weight = {a: weight(a) / (n * len(where[a])) ** 0.25 for a, n in times.items()}
        self.score: dict[tuple[int, int], float] = {}
        self.of: dict[int, list[int]] = defaultdict(list)  # the partners left of each sentence, once the best are taken
        for i, anchors in enumerate(han):
            mine = sorted((a for a in anchors if a in self.weight), key=lambda a: (-len(where[a]), a))
            left = 0.0
            for k, a in enumerate(mine):
                left += self.weight[a]
                if left >= least - 1e-9:
                    mine = mine[k:]
                    break
            else:
                continue
            for j in {j for a in mine for j in where[a]}:
                s = self.shared(i, j)
                if s >= least - 1e-9:
                    self.score[i, j] = s

    def shared(self, i: int, *js: int) -> float:
        """The weight of the anchors that sentence i has in common with any of js."""
        common = self.han[i] & (self.vi[js[0]] if len(js) == 1 else set().union(*(self.vi[j] for j in js)))
        return math.fsum(self.weight[a] for a in common)

    def shared_by(self, j: int, *ks: int) -> float:
        """The weight of the anchors that sentence j of the right side has in common with any of ks of the left."""
        return math.fsum(self.weight[a] for a in self.vi[j] & set().union(*(self.han[i] for i in ks)))

    def partners(self, least: float) -> list[tuple[int, int, float]]:
        """Pairs that are best for each other; of equal ones the one nearest to the diagonal."""
        slope = self.m / max(self.n, 1)
        rank = lambda ij, s: (round(s, 6), -abs(ij[1] - ij[0] * slope))
        best_i: dict[int, tuple] = {}
        best_j: dict[int, tuple] = {}
        for ij, s in self.score.items():
            if s >= least:
                r = (rank(ij, s), ij)
                best_i[ij[0]] = max(best_i.get(ij[0], r), r)
                best_j[ij[1]] = max(best_j.get(ij[1], r), r)
        return sorted((*r[1], self.score[r[1]]) for r in best_i.values() if best_j[r[1][1]] == r)


#: Least scores of a link: best partners and pairs within a gap; without a learnt lexicon scores are lower.
STRONG, WEAK, UNLEARNT = 2.4, 2.2, (1.2, 0.9)


class Lexicon:
    """What the alignment knows: readings, known word pairs, and pairs learnt from anchored sentences."""

    def __init__(self, readings: dict[str, set[str]], words: dict[str, set[str]], learnt: dict[str, set[str]] | None = None) -> None:
        self.readings, self.words, self.learnt = readings, words, learnt or {}
        self.pairs = {h for hs in words.values() for h in hs if len(h) > 1}
        self.right = {v for vs in self.learnt.values() for v in vs}
        self.heads = {w.split(" ")[0] for w in words}

    def han(self, unit: str) -> set[str]:
        out = han_anchors(unit, self.readings, self.pairs)
        if self.learnt:
            text = re.sub(r"[^\w]", "", unit)
            out.update(f"~{v}" for a, b in zip(text, text[1:]) for v in self.learnt.get(a + b, ()))
        return out

    def vi(self, unit: str) -> set[str]:
        out = vi_anchors(unit, self.words, self.heads)
        if self.right:
            s = vi_syllables(unit)
            out.update(f"~{a} {b}" for a, b in zip(s, s[1:]) if f"{a} {b}" in self.right)
        return out


def gram_sets(han: str, vi: str) -> tuple[list[str], list[str]]:
    """The character pairs of a Chinese sentence and the syllable pairs of a Vietnamese one, each once."""
    text, s = re.sub(r"[^\w]", "", han), vi_syllables(vi)
    return sorted({a + b for a, b in zip(text, text[1:])}), sorted({f"{a} {b}" for a, b in zip(s, s[1:])})


def learn_pairs(linked: DataFrame, least: int = 8, dice: float = 0.5) -> DataFrame:
    """h, v: character pairs and the syllable pairs that go with them in at least ``least`` of the linked sentences.

    ``linked`` has a row per pair of sentences with their ``gram_sets`` as h and v; all rows count.
    """
    linked = cut_lineage(linked.withColumn("k", F.monotonically_increasing_id()))
    usual, coded = {}, {}
    for side in "hv":
        gram = linked.select("k", F.explode(side).alias(side))
        counted = gram.groupBy(side).agg(F.count("*").alias(f"n{side}")).where(F.col(f"n{side}") >= least)
        usual[side] = known = cut_lineage(counted.withColumn(f"{side}_no", F.monotonically_increasing_id()))
        coded[side] = gram.join(known, side).groupBy("k").agg(F.collect_list(F.struct(f"{side}_no", f"n{side}")).alias(side))
    # They meet at most as often as the rarer one occurs, so pairs too unlike in number need no count.
    each = coded["h"].join(coded["v"], "k").select(F.explode("h").alias("h"), "v").select("h.*", F.explode("v").alias("v")).select("h_no", "nh", "v.*")
    likely = each.where(2 * F.least("nh", "nv") >= dice * (F.col("nh") + F.col("nv")))
    met = likely.groupBy("h_no", "v_no").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    found = met.join(usual["h"], "h_no").join(usual["v"], "v_no").where(2 * F.col("n") >= dice * (F.col("nh") + F.col("nv")))
    return cut_lineage(found.select("h", "v"))


def _steps(chapter: Chapter, hs: list[int], vs: list[int], least: float) -> list[tuple[tuple[int, ...], tuple[int, ...], float]]:
    """The steps of a gap: pairs, and one sentence against two or three neighbours, with their gains.

    A merged step must gain at least ``least`` by every sentence that it has more: what that one shares has to be
    something that the others do not.
    """
    inside = set(vs)
    right: dict[int, list[int]] = defaultdict(list)
    left: dict[int, list[int]] = defaultdict(list)
    for i in hs:
        for j in chapter.of[i]:
            if j in inside:
                right[i].append(j)
                left[j].append(i)
    out = [((i,), (j,), chapter.score[i, j]) for i, js in right.items() for j in js if chapter.score[i, j] >= least]
    for own, others, gain, one in ((right, vs, chapter.shared, True), (left, hs, chapter.shared_by, False)):
        place = {x: k for k, x in enumerate(others)}
        for x, ys in own.items():
            have = set(ys)
            for y in sorted(ys):
                run, total = [y], gain(x, y)
                while len(run) < 3 and place[run[-1]] + 1 < len(others) and (nxt := others[place[run[-1]] + 1]) in have:
                    more = gain(x, *run, nxt)
                    if total < least or more - total < least or more - gain(x, *run[1:], nxt) < least:
                        break
                    run, total = [*run, nxt], more
                    out.append(((x,), tuple(run), total) if one else (tuple(run), (x,), total))
    return out


def _local(chapter: Chapter, hs: list[int], vs: list[int], least: float) -> list[tuple[int, int]]:
    """The pairs of a gap along its best steps, in order."""
    return sorted((i, j) for a, b, _ in _best_steps(chapter, hs, vs, least) for i in a for j in b)


def _best_steps(chapter: Chapter, hs: list[int], vs: list[int], least: float) -> list[tuple[tuple[int, ...], tuple[int, ...], float]]:
    """The order-preserving steps of a gap with the greatest sum of gains.

    A dynamic programme over the steps there are, not over all cells: in order of their beginnings, each is put
    behind the best chain that ends before it on both sides.
    """
    if not hs or not vs:
        return []
    steps = sorted(_steps(chapter, hs, vs, least), key=lambda x: (x[0][0], x[1][0], len(x[0]), len(x[1])))
    pending: list[tuple[int, int, float, int]] = []  # chains by the left end, not yet before any beginning
    js: list[int] = []  # staircase: right ends ascending with totals ascending
    top: list[tuple[float, int]] = []
    back, best = [-1] * len(steps), (0.0, -1)
    for k, (a, b, gain) in enumerate(steps):
        while pending and pending[0][0] < a[0]:
            _, j, total, at = heapq.heappop(pending)
            spot = bisect.bisect_left(js, j)
            if spot and top[spot - 1][0] >= total:
                continue
            while spot < len(js) and top[spot][0] <= total:
                js.pop(spot), top.pop(spot)
            js.insert(spot, j)
            top.insert(spot, (total, at))
        spot = bisect.bisect_left(js, b[0])
        total = gain + (top[spot - 1][0] if spot else 0.0)
        back[k] = top[spot - 1][1] if spot else -1
        heapq.heappush(pending, (a[-1], b[-1], total, k))
        if total > best[0] + 1e-12:
            best = (total, k)
    out, k = [], best[1]
    while k >= 0:
        out.append(steps[k])
        k = back[k]
    return out[::-1]


def link_sentences(han: list[str], vi: list[str], lexicon: Lexicon, strong: float = STRONG, weak: float = WEAK) -> list[tuple[int, int, float]]:
    """(i, j, score) of the linked sentences of one chapter, both sides in reading order."""
    chapter = Chapter([lexicon.han(u) for u in han], [lexicon.vi(u) for u in vi], weak)
    links: dict[tuple[int, int], float] = {}
    for _ in range(2):  # what the best partners leave over may be each other's best
        for i, j, s in chapter.partners(strong):
            links[i, j] = s
        done_i, done_j = {i for i, _ in links}, {j for _, j in links}
        chapter.score = {(i, j): s for (i, j), s in chapter.score.items() if i not in done_i and j not in done_j}
    chapter.of = defaultdict(list)
    for i, j in sorted(chapter.score):
        chapter.of[i].append(j)
    points = sorted((i, j, s) for (i, j), s in links.items())
    chain = [points[k] for k in heaviest_chain(points)]
    ends = [(-1, -1), *((i, j) for i, j, _ in chain), (len(han), len(vi))]
    for (i0, j0), (i1, j1) in zip(ends, ends[1:]):
        hs, vs = [i for i in range(i0 + 1, i1) if i not in done_i], [j for j in range(j0 + 1, j1) if j not in done_j]
        for i, j in _local(chapter, hs, vs, weak):
            links[i, j] = chapter.score[i, j]
    return sorted((i, j, s) for (i, j), s in links.items())


def lexicon_rows(hanviet: DataFrame, s2: DataFrame) -> DataFrame:
    """kind, h, v of the reading table (sinonom_char, am_han_viet, all_readings) and the word table (key, values): kind 'r' a
    character with a reading, 'w' a Chinese word with a Vietnamese one."""
    plain = lambda c: F.lower(F.trim(nfc(c)))
    said = hanviet.where("sinonom_char is not null").select(F.col("sinonom_char").alias("h"), F.explode(F.split(F.coalesce("all_readings", "am_han_viet", F.lit("")), r"\s+")).alias("v"))
    words = s2.where("key is not null").select(F.explode("values").alias("h"), plain(F.col("key")).alias("v")).where("h <> ''")
    single = words.where((F.length("h") == 1) & ~F.col("v").contains(" "))
    made = [said.select(F.lit("r").alias("kind"), "h", plain(F.col("v")).alias("v")), single.select(F.lit("r").alias("kind"), "h", "v"), words.select(F.lit("w").alias("kind"), "h", "v")]
    return made[0].unionByName(made[1]).unionByName(made[2]).where("v <> ''").distinct()


def lexicon_of(rows: list[tuple[str, str, str]]) -> Lexicon:
    """From (kind, h, v): 'r' readings, 'w' words, 'l' learnt pairs."""
    by: dict[str, dict[str, set[str]]] = {k: defaultdict(set) for k in "rwl"}
    for kind, h, v in rows:
        by[kind][v if kind == "w" else h].add(h if kind == "w" else v)
    return Lexicon(dict(by["r"]), dict(by["w"]), dict(by["l"]))


def chapter_lexicon(units: DataFrame, rows: DataFrame) -> DataFrame:
    """vol, chapter, kind, h, v: of each chapter the lexicon rows whose Chinese side stands in it. The way for a lexicon that is too large to send to every task."""
    text = F.regexp_replace("unit", r"[^\p{L}\p{N}]", "")
    stretch = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda k: F.substring(text, k, F.lit(n)))
    every = F.array_distinct(F.concat(*(stretch(n) for n in (1, 2, 3, 4))))
    grams = units.where("side = 'h'").select("vol", "chapter", F.explode(every).alias("h")).distinct()
    return grams.join(rows, "h").select("vol", "chapter", "kind", "h", "v")


_ORDER = ["page", "sent_idx", "id", "unit_no"]


def _units(han_rows: DataFrame, vi_rows: DataFrame, model: Gaps | None = None) -> DataFrame:
    keep = ["vol", "chapter", "page", "sent_idx", "id"]
    han = han_rows.where("NOT coalesce(is_dbl, false)")
    both = sentence_units(han, "sinonom", "han", *keep, model=model).withColumn("side", F.lit("h")).unionByName(
        sentence_units(vi_rows, "text", "vi", *keep).withColumn("side", F.lit("v"))
    )
    return both.where("vol is not null and chapter is not null and id is not null")


def aligned_sentences(han_rows: DataFrame, vi_rows: DataFrame, hanviet: DataFrame, s2: DataFrame, most: int = MOST_LEXICON, model: Gaps | None = None) -> DataFrame:
    """vol, chapter, han_id, han_unit, vie_id, vie_unit, score: the linked sentences of every chapter.

    Rows need vol, chapter, page, sent_idx, id and sinonom (with is_dbl) or text; each key once. Null and
    blank texts, rows with is_dbl and rows without a chapter take no part; a sentence that occurs twice is
    linked by its place; empty tables give no row. A chapter is held by one task while it is read; its memory grows
    with its own sentences and the pairs that score. A lexicon of up to ``most`` rows goes to every task, a larger
    one is joined to the chapters; ``model`` cuts bare rows (see ``sentence_units``).
    """
    units = cut_lineage(_units(han_rows, vi_rows, model))  # read twice: to learn and to link
    known = lexicon_rows(hanviet, s2)
    linked = _linked(units, known, UNLEARNT, "h array<string>, v array<string>", most)
    learnt = learn_pairs(linked).select(F.lit("l").alias("kind"), "h", "v")
    schema = "vol string, chapter int, han_id string, han_unit int, vie_id string, vie_unit int, score double"
    return _linked(units, known.unionByName(learnt), (STRONG, WEAK), schema, most)


def _linked(units: DataFrame, rows: DataFrame, least: tuple[float, float], schema: str, most: int) -> DataFrame:
    """The linked sentences of every chapter, or their grams. A lexicon of up to ``most`` rows goes to every task, a larger one by chapters."""
    grams = schema.startswith("h array")

    def align(h: list[tuple], v: list[tuple], lexicon: Lexicon) -> list[tuple]:
        """Rows of the result from both sides of a chapter in order: (id, unit_no, unit) each."""
        links = link_sentences([x[2] for x in h], [x[2] for x in v], lexicon, *least) if h and v else []
        if grams:
            return [gram_sets(h[i][2], v[j][2]) for i, j, _ in links]
        return [(h[i][0], h[i][1], v[j][0], v[j][1], round(s, 4)) for i, j, s in links]

    def framed(made: list[tuple], vol: str, chapter: int) -> pd.DataFrame:
        if grams:
            return pd.DataFrame({"h": [x for x, _ in made], "v": [y for _, y in made]}, dtype=object)
        out = pd.DataFrame(made, columns=["han_id", "han_unit", "vie_id", "vie_unit", "score"])
        out.insert(0, "vol", vol), out.insert(1, "chapter", chapter)
        return out

    given = rows.limit(most + 1).collect()
    if len(given) <= most:
        # One form of the lexicon per worker: the same object serves all its chapters.
        shared = units.sparkSession.sparkContext.broadcast(lexicon_of([tuple(r) for r in given]))

        def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """Chapter after chapter, each held only while it is read."""
            now, sides = None, {"h": [], "v": []}
            for b in batches:
                for vol, chapter, side, *x in zip(b.vol, b.chapter, b.side, b.id, b.unit_no, b.unit):
                    if (vol, chapter) != now:
                        if now is not None and (made := align(sides["h"], sides["v"], shared.value)):
                            yield framed(made, *now)
                        now, sides = (vol, chapter), {"h": [], "v": []}
                    sides[side].append(tuple(x))
            if now is not None and (made := align(sides["h"], sides["v"], shared.value)):
                yield framed(made, *now)

        ordered = dealt(units, "vol", "chapter").sortWithinPartitions("vol", "chapter", *_ORDER)
        return ordered.mapInPandas(stream, schema)
    own = chapter_lexicon(units, rows).select(*(F.col(c).alias(f"l_{c}") for c in ("vol", "chapter", "kind", "h", "v")))

    def both(pdf: pd.DataFrame, lex: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(_ORDER, kind="stable")
        h, v = ([*zip(x.id, x.unit_no, x.unit)] for x in (pdf[pdf.side == "h"], pdf[pdf.side == "v"]))
        made = align(h, v, lexicon_of(list(zip(lex.l_kind, lex.l_h, lex.l_v))))
        return framed(made, *(pdf[c].iloc[0] if len(pdf) else None for c in ("vol", "chapter")))

    return units.groupBy("vol", "chapter").cogroup(own.groupBy("l_vol", "l_chapter")).applyInPandas(both, schema)


def aligned_rows(*tables: DataFrame, model: Gaps | None = None) -> DataFrame:
    """vol, han_id, vie_id: the rows of which at least one sentence is linked."""
    return aligned_sentences(*tables, model=model).select("vol", "han_id", "vie_id").distinct()
