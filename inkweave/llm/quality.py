"""Per-document text quality statistics, and the documents that are no natural prose (problem 9).

A document is judged line by line. Each non-blank line gets a few features, all SQL expressions; an
ordered rule list says whether it is prose; the document is a case if more than half of its lines are
not. The rules are induced (incremental reduced-error pruning) on labelled documents and exported to
one SQL CASE expression, so applying them needs neither Python nor a shuffle.

Labelled documents come from rows known to be prose: they are used as they are, wrapped, bare of
marks or in capitals; and their phrases are set as lists, tables and enumerations, or spoilt into
junk. The sample is bounded (``LABELLED`` rows of each text), the features and the decision cover all.
"""

from __future__ import annotations

import base64
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfc, strip_ignorable
from inkweave.llm import rules

#: Bound of the labelled sample: rows of each prose text it is made from.
LABELLED = 700
#: Words, and ideographs, in at least this share of all rows of a text count as common. So there are at most as many
#: of them as a row holds different ones in the mean, over this share.
COMMON, COMMON_HAN = 0.02, 0.1
_HAN_PY = "[\u3400-\u9fff\u3007\uf900-\ufaff\U00020000-\U0003ffff]"

#: Kept short: a class of few ranges is quick to match.
_HAN = r"[\x{3400}-\x{9FFF}\x{3007}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
#: Stand for a run of ideographs and for a run of other letters once a line is reduced to its outline.
_H, _L = "\ue001", "\ue000"
_ENDS = r"[.!?…。！？；」』»”\"][)）]?$"
_MARKER = r"^(?:[-•*+·–‣▪○●◦] |[0-9]{1,3}[.)] |[a-z][.)] |\([0-9a-z]{1,3}\) |[一二三四五六七八九十]{1,3}[、．.])"
#: Not symbols: digits, spaces and the marks of ordinary prose, in an outline.
_PLAIN = r"""[\ue000\ue001\p{N}\s\x{3000}.,;:!?…"'()«»“”‘’/\-–—。，、：；！？「」『』（）《》〈〉]+"""
FEATURES = [
    "chars", "letters", "symbols", "words", "mean_word", "distinct", "common", "ends", "marker",
    "cells", "items", "stretch", "longest", "han", "pairs",
]


def readable(text: Column) -> Column:
    """Composed, without invisible characters and with plain spaces; null becomes empty."""
    spaced = F.regexp_replace(strip_ignorable(text), r"[\p{Zs}&&[^ \x{3000}]]", " ")
    return F.coalesce(nfc(spaced), F.lit(""))


def _times(text: Column, ch: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(ch)))).cast("double")


def _parsed(line: Column) -> Column:
    """A line, and the line with each run of ideographs reduced to one mark."""
    return F.struct(line.alias("line"), F.regexp_replace(line, f"{_HAN}+", _H).alias("rest"))


def _outlined(x: Column) -> Column:
    """The same with each run of other letters reduced to one mark too, and the counts that follow."""
    line, rest = x["line"], x["rest"]
    han = (F.length(line) - F.length(rest)).cast("double") + _times(rest, _H)
    return F.struct(
        line.alias("line"),
        rest.alias("rest"),
        F.regexp_replace(rest, r"[\p{L}\p{M}]+", _L).alias("outline"),
        F.greatest(F.length(line), F.lit(1)).cast("double").alias("n"),
        han.alias("han"),
        F.when(han * 2 > F.length(line), F.split(line, "")).otherwise(F.split(line, " ")).alias("units"),
    )


def _features(x: Column, common: list[str], names: list[str]) -> Column:
    line, rest, outline, n = x["line"], x["rest"], x["outline"], x["n"]
    count = lambda p: F.regexp_count(outline, F.lit(p)).cast("double")
    runs = _times(outline, _L)
    letters = F.length(rest) - F.length(outline) + runs + x["han"]
    words = F.greatest(runs + x["han"], F.lit(1.0))
    plain = [c for c in common if not re.match(_HAN_PY, c)]
    han = "".join(c for c in common if re.match(_HAN_PY, c))
    known = F.lit(0)
    if plain:
        known = known + F.size(F.filter(F.split(F.lower(rest), r"[\s.,;:!?\"«»()\ue001]+"), lambda w: w.isin(*plain)))
    if han:
        known = known + F.when(x["han"] > 0, F.length(F.regexp_replace(line, f"[^{han}]+", ""))).otherwise(0)
    values = {
        "chars": n,
        "letters": letters / n,
        "symbols": F.length(F.regexp_replace(outline, _PLAIN, "")) / n,
        "words": runs + x["han"],
        "mean_word": letters / words,
        # By logarithms, as the plain share of distinct words falls with the length of any text.
        "distinct": F.log1p(F.size(F.array_distinct(x["units"])).cast("double")) / F.log1p(F.greatest(F.size(x["units"]), F.lit(1)).cast("double")),
        "common": known / words,
        "ends": F.right(line, F.lit(2)).rlike(_ENDS).cast("double"),
        "marker": F.substring(line, 1, 6).rlike(_MARKER).cast("double"),
        "cells": count(r"\t|\||  +|\x{3000}|[\"'][;,]|[;,][\"']|(?<=[0-9]);(?=[0-9])"),
        "items": count(r"[;、]|,(?![0-9])") / words,
        "stretch": F.array_max(F.transform(F.split(line, r"[,;:.!?…、，。；：！？「」　\t|]+"), lambda p: F.length(p))),
        "longest": F.when(x["han"] > 0, 0.0).otherwise(F.coalesce(F.array_max(F.transform(x["units"], F.length)), F.lit(0)).cast("double")),
        "han": x["han"] / n,
        "pairs": count(r": *[0-9]"),
    }
    return F.struct(*(values[f].cast("double").alias(f) for f in names))


def line_features(lines: Column, common: list[str], names: list[str] = FEATURES) -> Column:
    """The named features of each line of an array, as structs of doubles."""
    return F.transform(F.transform(F.transform(lines, _parsed), _outlined), lambda x: _features(x, common, names))


def prose_lines(text: Column) -> Column:
    """The non-blank lines of a text, trimmed."""
    split = F.split(text, r"\r\n|[\r\n\x{2028}\x{2029}]")
    return F.filter(F.transform(split, lambda x: F.btrim(x, F.lit(" \t\f\v\u3000\x85"))), lambda x: x != "")


# ---------------------------------------------------------------- labelled documents


def _phrases(texts: list[str]) -> list[str]:
    """Short stretches between marks and spaces, as items of lists are."""
    out: list[str] = []
    for t in texts:
        if re.search(r"[一-鿿]", t):
            out += [x[k : k + n] for x in re.split(r"[，。、：；！？「」]", t) for k, n in ((0, 2), (0, 3), (3, 4)) if len(x) >= k + n]
        else:
            for x in re.split(r"[.,;:!?«»\"()\n]+", t):
                w = x.split()
                out += [" ".join(w[k : k + n]) for k, n in ((0, 2), (1, 3), (2, 4), (4, 2)) if len(w) >= k + n]
    return out


def _wrap(t: str, width: int) -> list[str]:
    if " " not in t.strip():
        return [t[k : k + width] for k in range(0, len(t), width)]
    lines, now = [], ""
    for w in t.split():
        if now and len(now) + len(w) >= width:
            lines.append(now)
            now = w
        else:
            now = f"{now} {w}".strip()
    return [*lines, now]


def _prose(texts: list[str], r: random.Random) -> list[str]:
    some = [r.choice(texts) for _ in range(r.randint(1, 4) if r.random() < 0.9 else r.randint(10, 60))]
    t = (" " if " " in texts[0] else "").join(some)
    t = re.sub(r"\s+", " ", t)
    kind = r.random()
    if kind < 0.1:
        t = t.upper()
    elif kind < 0.3:
        t = re.sub(r"[^\w\s]", "", t)
    elif kind < 0.36:
        t = "— " + t
    width = r.choice([14, 16, 18, 20, 24, 30]) if " " not in t.strip() else r.choice([38, 46, 54, 62, 70, 80])
    return _wrap(t, width) if r.random() < 0.6 else [t]


def _number(r: random.Random, han: bool) -> str:
    if han:
        return "".join(r.choices("一二三四五六七八九百千十", k=r.randint(1, 6)))
    return r.choice([str(r.randint(1, 9999)), f"{r.randint(1, 99)}.{r.randint(100, 999)}"])


def _enumeration(items: list[str], r: random.Random, han: bool) -> str:
    return r.choice(["　", "、"] if han else ["; ", ", ", ", "]).join(r.choice(items) for _ in range(r.randint(5, 40)))


def _listing(items: list[str], r: random.Random, han: bool) -> list[str]:
    n = r.randint(4, 20)
    some = [r.choice(items) for _ in range(n)]
    kind = r.randrange(11)
    if kind == 0:
        sep = r.choice(["{}. ", "{}) "])
        return [sep.format(k + 1) + x for k, x in enumerate(some)]
    if kind == 1:
        mark = r.choice("-•*+·–")
        return [f"{mark} {x}" for x in some]
    if kind == 2:
        return [f"{chr(97 + k % 26)}) {x}" for k, x in enumerate(some)]
    if kind == 3:
        return [f"{x} {'.' * r.randint(5, 40)} {r.randint(1, 400)}" for x in some]
    if kind == 4:
        return [f"{x}: {_number(r, han)} {r.choice(items)[:8]}" for x in some]
    if kind == 5:
        return some
    if kind == 6:
        return [_enumeration(items, r, han)]
    columns = r.randint(2, 5)
    cell = lambda: _number(r, han) if r.random() < 0.8 else f"{_number(r, han)} {r.choice(items)}"
    if kind == 7:
        return ["| " + " | ".join([x, *(cell() for _ in range(columns))]) + " |" for x in some]
    if kind == 8:
        return [r.choice(["\t", "　"]).join([x, *(cell() for _ in range(columns))]) if not han else "　".join([x, *(cell() for _ in range(columns))]) for x in some]
    if kind == 9:
        return ["".join(y.ljust(18) for y in [x, *(cell() for _ in range(columns))]) for x in some]
    sep = r.choice([";", ","])
    return [sep.join(f'"{y}"' if " " in y else y for y in [x, *(cell() for _ in range(columns))]) for x in some]


def _junk(texts: list[str], items: list[str], r: random.Random) -> list[str]:
    kind = r.randrange(8)
    if kind == 7:
        return [r.choice(texts)[:300].encode().decode("cp1252", "replace")]
    if kind == 0:
        t, rate = r.choice(texts)[:400], r.uniform(0.2, 0.6)
        return ["".join(r.choice("#$%&*@\\^_{|}~¬¸") if r.random() < rate else c for c in t)]
    if kind == 1:
        return [base64.b64encode(r.randbytes(r.randint(60, 400))).decode()]
    if kind == 2:
        return [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789|~^", k=r.randint(1, 12))) for _ in range(r.randint(20, 80)))]
    if kind == 3:
        return [" ".join([r.choice(items)] * r.randint(10, 60))] if r.random() < 0.7 else [r.choice(items) * r.randint(8, 40)]
    if kind == 4:
        bits = ["\\bullet", "\\mathbf{q}", "x_{1}", "\\*", "..", "||", "··", "[1.", "7", "\\cdot", "\\bf(z)"]
        return [" ".join(r.choices(bits, k=r.randint(15, 90)))]
    if kind == 5:
        return [r.choice("■□�*_~#.=-") * r.randint(10, 80) for _ in range(r.randint(2, 9))]
    return [" ".join([r.choice(["□□", "��", "■", "??", r.choice(items)[0]])] * r.randint(10, 60))]


def labelled_lines(prose: dict[str, list[str]], seed: int = 11) -> list[tuple[str, bool]]:
    """(line, is it no prose) from prose rows, by kind of text; half of the documents are prose."""
    r, out = random.Random(seed), []
    for texts in prose.values():
        texts = [t for t in texts if len(t) >= 12]
        items = _phrases(texts)
        if not texts or not items:
            continue
        han = bool(re.search(r"[一-鿿]", texts[0]))
        for _ in range(2 * len(texts)):
            out += [(x, False) for x in _prose(texts, r)[:8]]
            # Lists and tables give several lines each, enumerations and junk one: so there are more of those.
            kind = r.random()
            lines = _listing(items, r, han)[:4] if kind < 0.5 else [_enumeration(items, r, han)] if kind < 0.65 else _junk(texts, items, r)[:2]
            out += [(x, True) for x in lines]
    return [(x, y) for x, y in out if x.strip()]


def common_words(texts: dict[str, DataFrame]) -> list[str]:
    """The words in at least ``COMMON`` of all rows of a text (one column t each), and the ideographs in at least ``COMMON_HAN``.

    Counted in Spark over every row, each row once per delivery; only what is common is gathered.
    """
    out: set[str] = set()
    for df in texts.values():
        words = F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(rf"{_HAN}|[\p{{L}}\p{{M}}&&[^{_HAN[1:-1]}]]+"), F.lit(0)))
        counted = df.where("t is not null").select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
        rows = df.where("t is not null").agg(F.count("*").alias("n")).scalar()
        share = F.when(F.col("w").rlike(_HAN), COMMON_HAN).otherwise(COMMON)
        out |= {r.w for r in counted.where(F.col("n") >= share * rows).select("w").collect()}
    return sorted(out)


class ProseJudge:
    """The learnt rules and common words."""

    def __init__(self, common: list[str], rule_list: list[list[rules.Condition]]) -> None:
        self.common, self.rules = common, rule_list

    @classmethod
    def fit(cls, spark, texts: dict[str, DataFrame]) -> ProseJudge:
        """Learn from rows of prose (columns o, an order by hash, and t): the common words from all, the rules from a
        bounded sample. Without any, there are no rules and nothing is a case."""
        common, lines = common_words(texts), labelled_lines({k: sample_rows(df) for k, df in texts.items()})
        if not lines:
            return cls([], [])
        made = spark.createDataFrame(lines, "line string, other boolean").coalesce(4)
        rows = made.select(line_features(F.array(F.trim("line")), common)[0].alias("f"), "other").select("f.*", "other").collect()
        x = np.array([r[:-1] for r in rows], float)
        return cls(common, rules.induce(x, np.array([r[-1] for r in rows], bool)))

    def used(self) -> list[str]:
        """The features that the rules look at."""
        at = {f for rule in self.rules for f, _, _ in rule}
        return [name for k, name in enumerate(FEATURES) if k in at] or FEATURES[:1]

    def no_prose(self, features: str) -> str:
        return rules.to_sql(self.rules, FEATURES, features)


def sample_rows(df: DataFrame, most: int = LABELLED) -> list[str]:
    """At most ``most`` texts, the first by ``o``: the same whatever the order of rows. A repeated row counts once."""
    rows = df.where(F.length("t") >= 12).orderBy("o", "t").limit(2 * most).collect()
    return [t for _, t in dict.fromkeys((r.o, r.t) for r in rows)][:most]


def _lines(documents: DataFrame, judge: ProseJudge, doc_id: str, text: str, names: list[str]) -> DataFrame:
    picked = documents.select(F.col(doc_id).alias("doc_id"), readable(F.col(text)).alias("__t"))
    return picked.select("doc_id", line_features(prose_lines(F.col("__t")), judge.common, names).alias("f"))


def text_statistics(documents: DataFrame, judge: ProseJudge, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lines, words, mean_word_length, symbol_share, ended_share, common_share, other_lines, no_prose.

    ``other_lines`` counts the non-blank lines that are no prose; ``no_prose`` says whether they are more
    than half. Null, empty and blank texts have 0 lines and are never ``no_prose``. Repeated rows are
    judged alike; an empty table gives no row; other columns are not read.
    """
    total = lambda g: F.aggregate("f", F.lit(0.0), lambda a, x: a + g(x))
    share = lambda g, of: F.round(F.when(of > 0, g / of).otherwise(0.0), 4)
    words, chars = total(lambda x: x["words"]), total(lambda x: x["chars"])
    other = F.expr(f"size(filter(f, x -> {judge.no_prose('x')}))")
    return _lines(documents, judge, doc_id, text, FEATURES).select(
        "doc_id",
        F.size("f").alias("lines"),
        words.cast("bigint").alias("words"),
        share(total(lambda x: x["words"] * x["mean_word"]), words).alias("mean_word_length"),
        share(total(lambda x: x["chars"] * x["symbols"]), chars).alias("symbol_share"),
        F.round(total(lambda x: x["ends"]) / F.greatest(F.size("f"), F.lit(1)), 4).alias("ended_share"),
        share(total(lambda x: x["words"] * x["common"]), words).alias("common_share"),
        other.alias("other_lines"),
        (other * 2 > F.size("f")).alias("no_prose"),
    )


def no_prose_documents(documents: DataFrame, judge: ProseJudge, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id of each document of which more than half of the non-blank lines are no prose.

    The lines are looked at once: each counts 1 or -1, and a case has more of the former.
    """
    surplus = F.expr(f"aggregate(f, 0, (a, x) -> a + CASE WHEN {judge.no_prose('x')} THEN 1 ELSE -1 END)")
    return _lines(documents, judge, doc_id, text, judge.used()).where(surplus > 0).select("doc_id")
