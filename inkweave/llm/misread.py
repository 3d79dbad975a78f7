"""Misrecognised characters and the whole repair of scanned text (problem 1).

Vietnamese: words that are rare beside a similar usual word get candidates through an inverted join on
character q-grams of their letters without diacritics; a boosted ranking scores each candidate by its edit
distance, by how well known confusions of recognition explain the difference (which is also the condition to be
ranked) and by how well it fits between its neighbours;
the best one replaces the word if it is more likely than not. Words with characters that no Vietnamese
word has are misread whatever the ranking finds.

Chinese columns: the same with the character between its neighbours as q-gram: usual characters of the
same place are the candidates. Recognition debris, and simplified forms, are known by the character.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfkd
from inkweave.llm.boosting import Boosted
from inkweave.llm.pagenoise import HYPHENS, PageNoise, fold, is_syllable
from inkweave.llm.sentences import han_plain
from inkweave.session import cut_lineage

#: Bound of the labelled samples.
SAMPLE_ROWS = 3000
#: A candidate is at least this many times as frequent as the word it may replace.
TIMES = 10

# What recognition confuses, as read -> as printed, without diacritics.
CONFUSIONS = [
    ("rn", "m"), ("ri", "n"), ("li", "h"), ("ii", "u"), ("cl", "d"), ("l", "i"), ("i", "l"), ("1", "l"), ("1", "i"), ("0", "o"),
    ("6", "o"), ("9", "g"), ("@", "a"), ("+", "t"), ("5", "s"), ("8", "b"), ("vv", "w"), ("c", "e"), ("e", "c"), ("nn", "m"),
    ("u'", "u"), ("o'", "o"), ("ll", "u"), ("q", "o"),
]
_WORD_SEPARATORS = r"[\s«»\"“”().,:;!?…\[\]\-–—]+"
_VIETNAMESE = re.compile(r"[a-zđ0-9]*", re.I)


def foreign(word: str) -> bool:
    """Has it characters that no Vietnamese word or number has?"""
    plain = "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
    return not _VIETNAMESE.fullmatch(plain) or bool(re.search(r"\d", plain) and re.search(r"[^\W\d]", plain))


def letters_of(word: Column) -> Column:
    """Lower-case letters and digits without diacritics, in the JVM."""
    return F.translate(F.regexp_replace(nfkd(word), r"[^\p{L}\p{N}@+]+", ""), "đĐıſ", "dD")


def edit_cost(read: str, printed: str) -> float:
    """Edit distance in which a known confusion costs 0.3 and a character of no word 0.2."""
    n, m = len(read), len(printed)
    cost = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if not i and not j:
                continue
            best = 9e9
            if i:
                best = min(best, cost[i - 1][j] + (1.0 if read[i - 1].isalnum() and read[i - 1] not in "ıſ" else 0.2))
            if j:
                best = min(best, cost[i][j - 1] + 1.0)
            if i and j:
                best = min(best, cost[i - 1][j - 1] + (read[i - 1] != printed[j - 1]))
            for a, b in CONFUSIONS:
                if i >= len(a) and j >= len(b) and read.startswith(a, i - len(a)) and printed.startswith(b, j - len(b)):
                    best = min(best, cost[i - len(a)][j - len(b)] + 0.3)
            cost[i][j] = best
    return cost[n][m]


def plain_distance(a: str, b: str) -> int:
    """Edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


#: Features of a pair of words, and those of its place besides.
PAIR, PLACE = 10, 6


def pair_features(word: str, candidate: str) -> list[float]:
    """Of a word as read and a usual word, without their places."""
    a, b = fold(word), fold(candidate)
    tones = lambda s: [c for c in unicodedata.normalize("NFD", s) if unicodedata.combining(c)]
    ta, tb = Counter(tones(word)), Counter(tones(candidate))
    cost, marks = edit_cost(a, b), float(sum(((ta - tb) + (tb - ta)).values()))
    odd = foreign(word)
    return [
        cost,
        marks,
        float(not ta and bool(tb)),
        float(a == b),
        len(word),
        abs(len(a) - len(b)),
        float(is_syllable(word)),
        float(odd),
        float(plain_distance(a, b)),
        # Known confusions explain it: recognition loses all marks of a word, but does not swap them.
        float(cost < 1.0 and (marks == 0 or (not ta and bool(tb)) or odd)),
    ]


def _plausible(made: list[float]) -> bool:
    """Is it worth ranking? What known confusions explain; ranking every word one edit away mostly found rare but right words."""
    return made[9] == 1


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _WORD_SEPARATORS), lambda w: w != "")


def word_rows(examined: DataFrame) -> DataFrame:
    """vol, id, pos, raw, word, before, after of every word of the column ``clean``."""
    raw = F.col("raw")
    listed = examined.select("vol", "id", _words(F.col("clean")).alias("raws")).withColumn("ws", F.transform("raws", F.lower))
    at = lambda k: F.coalesce(F.try_element_at("ws", F.when((k > 0) & (k <= F.size("ws")), k)), F.lit(""))
    each = F.transform("raws", lambda r, k: F.struct((k + 1).cast("int").alias("pos"), r.alias("raw"), at(k + 1).alias("word"), at(k).alias("before"), at(k + 2).alias("after")))
    return listed.select("vol", "id", F.explode(each).alias("x")).select("vol", "id", "x.*").where(raw.isNotNull())


_ANY = "abcdeghiklmnopqrstuvxyfjwz0123456789"


def _ranking(texts: list[str], seed: int = 3) -> Boosted:
    """Fits the ranking on words of a bounded sample, spoilt by known confusions and by any others, and on rare words made of usual parts."""
    r = random.Random(seed)
    rows = [[w for w in re.split(_WORD_SEPARATORS, t) if w] for t in texts]
    n: Counter = Counter(w.lower() for ws in rows for w in ws)
    two: Counter = Counter((a.lower(), b.lower()) for ws in rows for a, b in zip(ws, ws[1:]))
    whole = max(sum(n.values()), 1)
    usual = [w for w, k in n.items() if k >= 8 and not foreign(w) and w.isalpha()]
    if len(usual) < 20:
        return Boosted().fit(np.zeros((0, PAIR + PLACE)), np.zeros(0))
    by_gram: dict[str, set[str]] = defaultdict(set)
    for w in usual:
        f = f"^{fold(w)}$"
        for k in range(len(f) - 1):
            by_gram[f[k : k + 2]].add(w)
    onset = lambda w: re.match(r"[^aeiouy]*", fold(w)).end()
    places = [(a.lower(), b, c.lower()) for ws in rows for a, b, c in zip(["", *ws], ws, [*ws[1:], ""]) if b.lower() in n and b.isalpha()]
    x, y = [], []
    for before, w, after in r.sample(places, min(5000, len(places))):
        low, kind = w.lower(), r.random()
        if kind < 0.55:  # spoilt
            if n[low] < 8:
                continue
            f = low
            if r.random() < 0.25:
                f = "".join(c for c in unicodedata.normalize("NFD", low) if not unicodedata.combining(c)).replace("đ", "d")
            else:
                fits = [(a, b) for a, b in CONFUSIONS if b in f.replace("đ", "d")]
                if r.random() < 0.3:  # any letter for any other, lost or too many
                    k = r.randrange(len(f))
                    f = f[:k] + r.choice(["", r.choice(_ANY), f[k] + r.choice(_ANY)]) + f[k + 1 :]
                elif not fits or r.random() < 0.15:
                    k = r.randrange(1, len(f) + 1)
                    f = f[:k] + r.choice("~|^`$") + f[k:]
                else:
                    a, b = r.choice(fits)
                    f = f.replace(b, a, 1) if b != "d" else f.replace("đ", "d").replace(b, a, 1)
            if f == low or f in n and n[f] >= 8:
                continue
            right, mine = low, r.choice((0.0, r.uniform(0, 0.02)))  # the same misreading may recur
        elif kind < 0.8:  # a rare but right word, in the place of a name
            if not w[0].isupper():
                continue
            u = r.choice(usual)
            f, right, mine = low[: onset(low)] + u[onset(u) :], "", r.choice((0.0, r.uniform(0, 0.02)))
            if n[f] >= 8 or not f:
                continue
        else:  # a usual word where it is right
            f, right, mine = low, "", two[before, low] / max(n[before], 1)
        g = f"^{fold(f)}$"
        near: Counter = Counter(c for k in range(len(g) - 1) for c in by_gram.get(g[k : k + 2], ()))
        others = [c for c in near if c not in (right, f) and near[c] >= max(len(fold(c)), len(g) - 2) - 3 and (right or kind < 0.8 or n[c] >= TIMES * n[f])]
        for c in [right] * (right in near and right != f) + r.sample(others, min(15, len(others))):
            made = pair_features(f, c)
            if not _plausible(made):
                continue
            own = float(c == right)  # the spoilt place itself is no evidence
            x.append([*made, (two[before, c] - own) / max(n[before], 1), (two[c, after] - own) / max(n[after], 1), mine,
                      two[f, after] / max(n[after], 1) if kind >= 0.8 else mine / 2, float(w[0].isupper() and bool(before)), np.log(n[c] / whole)])
            y.append(c == right)
    return Boosted(rounds=60).fit(np.array(x, float).reshape(len(y), PAIR + PLACE), np.array(y, float))


def misread_words(examined: DataFrame, texts: list[str]) -> DataFrame:
    """vol, id, pos, raw, better: the misread words of the column ``clean`` with their replacement (null if none is known).

    ``texts`` is a bounded sample of the column, for the ranking. All counts cover all rows. Null and empty
    texts have no words; an empty table gives no row.
    """
    words = word_rows(examined)
    # Small against the words themselves, and each is read several times below.
    types = cut_lineage(words.groupBy("word").agg(F.count("*").alias("n")))
    named = types.select("word", "n", F.lower(letters_of(F.col("word"))).alias("letters"))
    alphabet = unicodedata.normalize("NFC", "".join(
        b + t for b in ("a", "ă", "â", "e", "ê", "i", "o", "ô", "ơ", "u", "ư", "y") for t in ("", "̀", "́", "̃", "̉", "̣")
    ))
    odd = ~F.col("word").rlike(rf"^(?:[a-zđ{alphabet}]+|[0-9]+)$")
    gram = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("padded") - 1), lambda k: F.substring("padded", k, F.lit(2)))))
    padded = named.withColumn("padded", F.concat(F.lit("^"), "letters", F.lit("$"))).where("length(letters) > 0")
    asked = padded.where(~F.col("word").rlike("^[0-9]+$")).select(F.col("word").alias("read"), F.col("n").alias("read_n"), F.length("letters").alias("read_len"), gram.alias("gram"))
    usual = padded.where(~odd & ~F.col("word").rlike("[0-9]") & (F.col("n") >= 8)).select(
        F.col("word").alias("better"), F.col("n").alias("better_n"), F.length("letters").alias("better_len"), gram.alias("gram")
    )
    met = asked.join(usual, "gram").where(
        (F.col("better_n") >= TIMES * F.col("read_n")) & (F.abs(F.col("read_len") - F.col("better_len")) <= 2) & (F.col("read") != F.col("better"))
    )
    near = met.groupBy("read", "better", "read_n", "better_n", "read_len", "better_len").agg(F.count("*").alias("shared"))
    near = near.where(F.col("shared") >= F.greatest("read_len", "better_len") - 3)

    def paired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [pair_features(u, v) for u, v in zip(b["read"], b["better"])]
            keep = [_plausible(f) for f in made]
            b = b.assign(f=made)[keep]
            yield b[["read", "better", "better_n", "f"]]

    candidates = near.select("read", "better", "better_n").mapInPandas(paired, "read string, better string, better_n bigint, f array<double>")
    whole = types.agg(F.sum("n")).scalar()
    two = words.groupBy("before", "word").agg(F.count("*").alias("n"))
    total = types.select(F.col("word").alias("w"), F.col("n").alias("all"))
    capital = F.col("raw").rlike(r"^\p{Lu}") & (F.col("before") != "")
    # Only the words that have a candidate, and each place of a word once.
    places = words.join(candidates.select("read").distinct(), F.col("word") == F.col("read"), "left_semi")
    places = places.groupBy("before", "word", "after", capital.alias("capital")).agg(F.count("*").alias("times"))
    asked_at = places.join(candidates, F.col("word") == F.col("read")).drop("read", "times")
    left = two.select(F.col("before").alias("b1"), F.col("word").alias("w1"), F.col("n").alias("n1"))
    share = lambda df, b, w, of, name: (
        df.join(left, (F.col(b) == F.col("b1")) & (F.col(w) == F.col("w1")), "left")
        .join(total, F.col(of) == F.col("w"), "left")
        .withColumn(name, F.coalesce(F.col("n1") / F.col("all"), F.lit(0.0)))
        .drop("b1", "w1", "n1", "w", "all")
    )
    scored = share(asked_at.withColumn("whole", whole), "before", "better", "before", "p1")
    scored = share(scored, "better", "after", "after", "p2")
    scored = share(scored, "before", "word", "before", "p3")
    scored = share(scored, "word", "after", "after", "p4")
    model = examined.sparkSession.sparkContext.broadcast(_ranking(texts))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            own = b.word.map(foreign).to_numpy()
            x = np.column_stack([np.array(b.f.tolist(), float), b.p1, b.p2, np.where(own, 0, b.p3), np.where(own, 0, b.p4), b.capital.astype(float), np.log(b.better_n / b.whole)])
            yield b[["before", "word", "after", "capital", "better"]].assign(score=model.value.probability(x))

    ranked = scored.mapInPandas(rank, "before string, word string, after string, capital boolean, better string, score double")
    best = ranked.groupBy("before", "word", "after", "capital").agg(F.max(F.struct("score", "better")).alias("top"))
    best = best.select("before", "word", "after", "capital", F.col("top.better").alias("better")).where("top.score >= 0.5")
    marked = words.withColumn("capital", capital).join(best, ["before", "word", "after", "capital"], "left")
    return marked.where(odd & ~F.col("word").rlike("^[0-9]+$") | F.col("better").isNotNull()).select("vol", "id", "pos", "raw", "better")


# ---------------------------------------------------------------- Chinese columns

# Simplified forms that an old character set holds too, and strokes read for a lost character.
_SIMPLIFIED_TOO, _STROKES = "万与丰听", "丨丶丿乀乁亅乂"
# Ideographs that recognition takes for one another.
CONFUSABLE = (
    "己已巳 土士 人入 大太犬 日目曰 末未 干千于 王玉壬 天夫 刀力 貝見 鳥烏 戊戌戍 田由甲申 木本 免兔 今令 問間 理埋 "
    "水永氷 牛午 九丸 白自 名各 石右 古占 失矢 史吏 住往 待侍 徒徙 栗粟 綱網 治冶 折拆 侯候 博傅 爪瓜 北比 又叉 千干 毋母"
).split()
LIKE = {a: [b for c in CONFUSABLE if a in c for b in c if b != a] for c in CONFUSABLE for a in c}


def _encodes(c: str, codec: str) -> bool:
    try:
        c.encode(codec)
    except UnicodeEncodeError:
        return False
    return True


#: Characters of the simplified character set that the traditional one lacks.
SIMPLIFIED = "".join(c for c in map(chr, range(0x4E00, 0xA000)) if _encodes(c, "gb2312") and not _encodes(c, "big5")) + _SIMPLIFIED_TOO


def column_text(text: Column) -> Column:
    """A column's characters: plain forms, without notes in brackets and spaces."""
    return F.regexp_replace(han_plain(text), r"[(（〔\[][^)）〕\]]*[)）〕\]]", "")


def _has_any(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")) < F.length(text)


_IDEOGRAPH = r"[\x{3400}-\x{9FFF}\x{3007}\x{20000}-\x{3FFFF}]"


def is_ideograph(c: Column) -> Column:
    """One ideograph that is no lone stroke."""
    return c.rlike(rf"^{_IDEOGRAPH}$") & ~_has_any(c, _STROKES)


#: A character of at most this share of all may be another's misreading.
RARE_SHARE = 1 / 1500


def place_features(explained: float, better_all: float, own_all: float, m: float, n: float, here: float) -> list[float]:
    """Of a rare character in a place: the share of its places in which ``better`` is usual, and the counts of both."""
    return [explained, np.log(better_all / own_all), m / here, n / here]


def _place_model(columns: list[str], seed: int = 9) -> Boosted:
    """Fits, on columns of a bounded sample, whether a rare character is another one misread.

    In the sample some usual characters are misread now and then as a character made up for each; the
    rare characters that are there anyway are the other class.
    """
    r = random.Random(seed)
    n: Counter = Counter(c for t in columns for c in t)
    usual = [c for c, k in n.most_common() if k >= 40]
    made = {c: chr(0xE100 + k) for k, c in enumerate(r.sample(usual, min(60, len(usual) // 2)))}
    spoilt = ["".join(made[c] if c in made and r.random() < 0.04 else c for c in t) for t in columns]
    three: Counter = Counter(f"^{t}$"[k : k + 3] for t in spoilt for k in range(len(t)))
    one: Counter = Counter(c for t in spoilt for c in t)
    by_place: dict[tuple[str, str], Counter] = defaultdict(Counter)
    for k, c in three.items():
        by_place[k[0], k[2]][k[1]] += c
    rare = {c for c, k in one.items() if k <= max(sum(one.values()) * RARE_SHARE, 6)}
    explained: Counter = Counter()
    rows = []
    for place in by_place.values():
        here = sum(place.values())
        for c in rare & place.keys():
            for o, m in place.items():
                if m >= TIMES * place[c]:
                    explained[c, o] += place[c]
                    rows.append((c, o, m, place[c], here))
    x = [place_features(explained[c, o] / one[c], one[o], one[c], m, k, here) for c, o, m, k, here in rows]
    return Boosted(rounds=40, depth=2).fit(np.array(x, float).reshape(len(rows), 4), np.array([made.get(o) == c for c, o, *_ in rows], float))


def misread_columns(columns: DataFrame, sample: list[str]) -> DataFrame:
    """vol, id, pos, raw, better: the misread characters of the column ``chars`` (see ``column_text``).

    ``sample`` is a bounded sample of it, for the model; all counts cover all rows. A character is misread
    if it is no ideograph, a lone stroke or a simplified form, or if it is rare and in its places another
    character is far more usual, also with a second neighbour on either side. Null and empty: none.
    """
    chars = F.split("chars", "")
    at = lambda k: F.when(k < 1, "^").when(k > F.size(chars), "$").otherwise(F.try_element_at(chars, F.greatest(k, F.lit(1))))
    each = F.transform(chars, lambda c, k: F.struct((k + 1).cast("int").alias("pos"), c.alias("raw"), at(k).alias("before"), at(k + 2).alias("after"), at(k - 1).alias("before2"), at(k + 3).alias("after2")))
    places = columns.where(F.length("chars") > 0).select("vol", "id", F.explode(each).alias("x")).select("vol", "id", "x.*")
    debris = ~F.col("raw").rlike(r"^[\x{3400}-\x{9FFF}\x{3007}\x{20000}-\x{3FFFF}。，、：；！？,:;!?「」『』…]$") | _has_any(F.col("raw"), _STROKES)
    known = debris | _has_any(F.col("raw"), SIMPLIFIED)
    three = cut_lineage(places.groupBy("before", "raw", "after").agg(F.count("*").alias("n")))
    one = three.groupBy("raw").agg(F.sum("n").alias("all"))
    whole = one.agg(F.sum("all")).scalar()
    rare = one.where((F.col("all") <= whole * RARE_SHARE) & ~known).select("raw", F.col("all").alias("own_all"))
    place = three.groupBy("before", "after").agg(F.sum("n").alias("here"))
    asked = three.join(rare, "raw").join(place, ["before", "after"])
    others = three.select("before", "after", F.col("raw").alias("better"), F.col("n").alias("m"))
    # Every usual character of the place is a candidate, whether it looks alike or not.
    met = asked.join(others, ["before", "after"]).where((F.col("m") >= TIMES * F.col("n")) & F.col("better").rlike(rf"^{_IDEOGRAPH}$"))
    explained = met.groupBy("raw", "better").agg(F.sum("n").alias("explained"))
    both = met.join(explained, ["raw", "better"]).join(one.select(F.col("raw").alias("better"), F.col("all").alias("better_all")), "better")
    model = columns.sparkSession.sparkContext.broadcast(_place_model(sample))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.array([place_features(e / o, a, o, m, n, h) for e, a, o, m, n, h in zip(b.explained, b.better_all, b.own_all, b.m, b.n, b.here)])
                yield b[["before", "raw", "after", "better"]].assign(score=model.value.probability(x))

    scored = cut_lineage(both.mapInPandas(rank, "before string, raw string, after string, better string, score double").where("score >= 0.5"))
    # One neighbour on each side also fits another saying: with a second one, on either side, the candidate must still be the more usual. The edge of a column is no neighbour.
    here = places.where("before2 <> '^' AND after2 <> '$'").join(scored.select("before", "after").distinct(), ["before", "after"])
    wide = here.select("before2", "before", "raw", "after", "after2").distinct().join(scored, ["before", "raw", "after"])
    for far, n in (("before2", "l"), ("after2", "r")):
        counted = here.groupBy(far, "before", "raw", "after").agg(F.count("*").alias(n))
        wide = wide.join(counted.withColumnRenamed(n, f"{n}_own"), [far, "before", "raw", "after"]).join(counted.withColumnRenamed("raw", "better"), [far, "before", "better", "after"])
    alike = columns.sparkSession.createDataFrame([(a, b, 1) for a, bs in LIKE.items() for b in dict.fromkeys(bs)], "raw string, better string, alike int")
    wide = wide.where("l > l_own AND r > r_own").join(F.broadcast(alike), ["raw", "better"], "left")
    place = ["before2", "before", "raw", "after", "after2"]
    top = F.max(F.struct("score", F.coalesce("alike", F.lit(0)).alias("alike"), "better")).alias("top")  # looking alike only decides between equal scores
    wrong = wide.groupBy(*place).agg(top).select(*place, F.col("top.better").alias("better"))
    marked = places.join(wrong, place, "left")
    return marked.where(known | F.col("better").isNotNull()).select("vol", "id", "pos", "raw", "better")
