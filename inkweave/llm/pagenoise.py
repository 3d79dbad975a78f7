"""Traces of the scanned page inside a Vietnamese row: furniture and broken syllables (problem 1).

A row is cut into segments: its lines, and inside a line what stands out as a page head or a leaf
number. Each segment is judged together with its neighbours (pairs of lines) by two boosted
classifiers, one for heads and one for numbers; each line end with a hyphen by a third, which tells a
syllable cut in two from a compound. The classifiers are fitted on clean lines of a bounded sample into
which generic heads, numbers and cuts are set.
"""

from __future__ import annotations

import random
import re
import unicodedata
from dataclasses import dataclass

import numpy as np

from inkweave.llm.boosting import Boosted

HYPHENS = "-‐‑–¬­"
_UP = "A-ZĐÀ-ÖØ-ÝĂĨŨƠƯẠẢẤẦẨẪẬẮẰẲẴẶẸẺẼẾỀỂỄỆỈỊỌỎỐỒỔỖỘỚỜỞỠỢỤỦỨỪỬỮỰỲỴỶỸ"
_CAPS = rf"[{_UP}][{_UP}l.]+"
_TITLE = rf"[{_UP}][^\W\d_]+"
_SEP = r"(?:[ \t]*[-—–][ \t]*|[ \t]+)"
#: What may be a head or a number inside a line.
_INSIDE = re.compile(
    rf"(?:\d{{1,4}}{_SEP})?(?:{_CAPS}{_SEP}){{1,5}}{_CAPS}(?:{_SEP}\d{{1,4}}(?![.,]?\d))?(?=[\s]|$)"
    rf"|(?:\d{{1,4}}{_SEP})?{_TITLE}(?:{_SEP}{_TITLE}){{3,8}}(?:{_SEP}\d{{1,4}}(?![.,]?\d))?(?=[\s]|$)"
    r"|(?:(?<=\s)|^)[\[(]\s?\d{1,3}\s?[-.]?\s?[abAB]?\s?[\])](?=[\s.,;:!?»\"]|$)"
    r"|(?:(?<=\s)|^)[.\-—–]\s?\d{1,4}\s?[.\-—–](?=\s|$)"
)
_VOWEL = "aeiouy"
_SYLLABLE = re.compile(
    r"(?:ngh?|nh|gh?|gi|kh|ch|th|tr|ph|qu|[bcdđhklmnpqrstvx])?[aeiouy]{1,3}(?:ch|nh|ng|[cmnpt])?"
)


def fold(s: str) -> str:
    """Lower case without diacritics, đ as d."""
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c)).replace("đ", "d")


def is_syllable(s: str) -> bool:
    """Could it be one Vietnamese syllable, by its letters?"""
    return bool(_SYLLABLE.fullmatch(f := fold(s))) and not re.search("aa|ee|ii|yy", f)


def grams(s: str, q: int = 2) -> set[str]:
    s = f"^{s}$"
    return {s[k : k + q] for k in range(len(s) - q + 1)}


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


#: A run of capitals as a head may have it, for SQL too; and the least share of rows in which a form recurs.
HEAD_RUN = rf"(?:{_CAPS}{_SEP})+{_CAPS}"
RECURRING = 1e-4


class Context:
    """Recurring heads, by q-grams."""

    def __init__(self, heads: list[str]) -> None:
        self.heads = [grams(h) for h in heads]

    def likeness(self, s: str) -> float:
        g = grams(fold(re.sub(r"[\d\W_]+", " ", s)).strip())
        return max((dice(g, h) for h in self.heads), default=0.0)

    def narrowed(self, text: str, start: int, end: int) -> tuple[int, int]:
        """Of a run of capitalised words, the part most like a known head, with the number beside it."""
        words = [(m.start() + start, m.end() + start) for m in re.finditer(r"[^\W\d_]+", text[start:end])]
        if len(words) < 4 or text[start:end].isupper() or not self.heads:
            return start, end
        spans = [(words[i][0], words[j][1]) for i in range(len(words)) for j in range(i + 2, min(i + 5, len(words)))]
        best = max(spans, key=lambda x: (round(self.likeness(text[x[0] : x[1]]), 3), x[0] - x[1]))
        if self.likeness(text[best[0] : best[1]]) < 0.7:
            return start, end
        left = re.search(r"\d{1,4}[ —–-]+$", text[start : best[0]])
        right = re.match(r"[ —–-]+\d{1,4}(?![.,]?\d)", text[best[1] : end])
        return best[0] - (len(left[0]) if left else 0), best[1] + (len(right[0]) if right else 0)


@dataclass
class Segment:
    start: int
    end: int
    whole_line: bool


def segments(text: str, context: Context) -> list[Segment]:
    """The lines of a text and, within them, what stands out."""
    out, at = [], 0
    for line in text.split("\n"):
        a, b = at + len(line) - len(line.lstrip()), at + len(line.rstrip())
        if a < b:
            out.append(Segment(a, b, True))
            for m in _INSIDE.finditer(text, a, b):
                s, e = context.narrowed(text, m.start(), m.end())
                if (s, e) != (a, b):
                    out.append(Segment(s, e, False))
        at += len(line) + 1
    return out


def features(text: str, seg: Segment, context: Context) -> list[float]:
    """Of a segment and of the lines before and after it."""
    s = text[seg.start : seg.end]
    before, after = text[: seg.start].rstrip(" \t"), text[seg.end :].lstrip(" \t")
    letters = sum(c.isalpha() for c in s) or 0
    words = re.findall(r"[^\W\d_]+", s)
    capital = sum(w[0].isupper() for w in words)
    return [
        float(seg.whole_line),
        len(s),
        letters / len(s),
        sum(c.isdigit() for c in s) / len(s),
        sum(c.isupper() for c in s) / max(letters, 1),
        len(words),
        capital / max(len(words), 1),
        context.likeness(s) if words else 0.0,
        float(bool(re.search(r"^\D{0,6}\d{1,4}\D{0,3}$", s)) and letters <= 5),
        float(bool(re.fullmatch(r"[ivxlc]{1,8}", s)) and seg.whole_line),
        float(s.count(")") != s.count("(") or s.count("]") != s.count("[")),
        float(bool(re.match(r"\d", s)) or bool(re.search(r"\d$", s))),
        float(bool(re.fullmatch(r"[\[(].*[\])]|[.\-—–].*[.\-—–]", s))),
        float(bool(re.fullmatch(r"[\[(]\s?\d{1,3}\s?[-.]?\s?[abAB]\s?[\])]", s))),
        float(bool(re.search(r"\b[IVXLC]{2,}\b", s)) and letters < 24),
        float(not before or before[-1] in "\n"),
        float(not after or after[0] in "\n"),
        float(bool(before.rstrip()) and before.rstrip()[-1] in ".!?…»\""),
        float(bool(after.lstrip()) and after.lstrip()[0].islower()),
        float(bool(re.search(r"[.,;:!?»\"]$", s))),
        float(bool(re.match(r"(?i)(?:trang|tr\.|p\.|page)\s*\d+$", s))),
    ]


def join_features(left: str, right: str, hyphen: str, known: set[str]) -> list[float]:
    """Of a line end with a hyphen: the letters before it and after it."""
    l, r, both = fold(left), fold(right), (left + right).lower()
    return [
        float(any(c in _VOWEL for c in l)),
        len(left),
        len(right),
        float(left[:1].isupper()),
        float(right[:1].islower()),
        float(r[:1] in tuple(_VOWEL)),
        float(is_syllable(left)),
        float(is_syllable(right)),
        float(is_syllable(left + right)),
        float(both in known),
        float(left.lower() in known),
        float(right.lower() in known),
        float(hyphen == "-"),
    ]


#: A hyphen before a line end, or before the space that has replaced it.
_CUT = re.compile(rf"([^\W\d_]+)([{HYPHENS}])\s+([^\W\d_]+)")


class PageNoise:
    """The three classifiers with what they know."""

    def __init__(self, context: Context, known: set[str], head: Boosted, number: Boosted, broken: Boosted) -> None:
        self.context, self.known, self.head, self.number, self.broken = context, known, head, number, broken

    @classmethod
    def fit(cls, texts: list[str], known: set[str], heads: list[str], seed: int = 5) -> PageNoise:
        """From rows of a bounded sample, and the usual words and recurring heads of the whole corpus."""
        r, context = random.Random(seed), Context(heads)
        clean = [t for t in texts if not re.search(rf"[^\w\s.,;:!?…«»\"()\-]|(?:{_CAPS}{_SEP})+{_CAPS}|^\W*\d+\W*$", t, re.M) and len(t) > 40]
        x, head, number, joins, cut = [], [], [], [], []
        forms = [h.upper() for h in heads]
        for t in clean * 3:
            words = t.split()
            kind = r.randrange(6)
            k = r.randrange(1, max(2, len(words)))
            own = ""
            if kind == 0:  # a head
                base = r.choice(forms) if forms and r.random() < 0.6 else " ".join(w.upper() for w in r.sample(words, min(r.randint(3, 5), len(words))) if w.isalpha())
                base = "".join(r.choice("IlEKNY") if c.isalpha() and r.random() < 0.06 else c for c in base)
                base = base.title() if forms and r.random() < 0.4 else base
                if r.random() < 0.25 and base.count(" ") >= 2:
                    base = " - ".join(base.rsplit(" ", 2)[:1] + [" ".join(base.rsplit(" ", 2)[1:])])
                own = r.choice(["{n} {h}", "{h}", "{h} {n}", "{n} — {h}", "QUYỂN {r}"]).format(
                    n=r.randint(1, 499), h=base, r=r.choice(["II", "III", "IV", "VI", "VII", "IX", "XIV", "THỦ", "THỨ NHẤT", "THỨ CHÍN", "THU"]))
            elif kind == 1:  # a number
                n = r.randint(1, 499)
                own = r.choice([f"{n}", f"- {n} -", f"— {n} —", f". {n} .", f"Trang {n}", f"tr. {n}", f"[{n % 99 + 1}-a]", f"({n % 99 + 1}-b)", f"[{n % 99 + 1} b]",
                                r.choice(["xiv", "xlviii", "iii", "xvi", "xxx", "lv", "x", "l", "i", "v"])])
            leaf = bool(re.match(r"[\[(]", own))
            alone = bool(own) and not leaf and (r.random() < 0.6 or bool(re.fullmatch(r"\d+|[ivxl]+|t?[rR].*", own)))
            glue = "\n" if alone else " "
            made = t if not own else glue.join([" ".join(words[:k]), own, " ".join(words[k:])]) if k < len(words) and r.random() < 0.8 or leaf else f"{own}{glue}{t}"
            if not own and r.random() < 0.6:
                at = sorted(r.sample(range(1, len(words)), min(len(words) - 1, r.randint(1, 3)))) if len(words) > 3 else []
                made = " ".join(w + ("\n" if j in at else "") for j, w in enumerate(words)).replace("\n ", "\n")
            for seg in segments(made, context):
                s = made[seg.start : seg.end]
                x.append(features(made, seg, context))
                head.append(kind == 0 and bool(own) and s == own)
                number.append(kind == 1 and bool(own) and s == own)
            for w in r.sample(words, min(4, len(words))):
                if not w.isalpha() or len(w) < 2:
                    continue
                j = r.randint(1, len(w) - 1)
                joins.append(join_features(w[:j], w[j:], r.choice(HYPHENS), known))
                cut.append(True)
                u = r.choice(words)
                if u.isalpha():
                    a, b = (w.title(), u.lower()) if r.random() < 0.8 else (w, u)
                    joins.append(join_features(a, b, "-", known))
                    cut.append(False)
        fit = lambda a, b: Boosted().fit(np.array(a, float).reshape(len(b), -1), np.array(b, float))
        return cls(context, known, fit(x, head), fit(x, number), fit(joins, cut))

    def examine(self, raws: list[str | None]) -> list[tuple[list[str], str]]:
        """(kinds, text without them) of each row: 'running_head', 'page_number', 'broken_word'; null and empty have none."""
        texts = [re.sub(r"\r\n?", "\n", unicodedata.normalize("NFC", t or "")) for t in raws]
        segs = [(k, s) for k, t in enumerate(texts) for s in segments(t, self.context)]
        kinds: list[set[str]] = [set() for _ in texts]
        drop: list[list[tuple[int, int]]] = [[] for _ in texts]
        if segs:
            x = np.array([features(texts[k], s, self.context) for k, s in segs])
            for (k, seg), p, q in zip(segs, self.head.probability(x), self.number.probability(x)):
                if max(p, q) < 0.5:
                    continue
                s = texts[k][seg.start : seg.end]
                drop[k].append((seg.start, seg.end))
                if p >= q:
                    kinds[k].add("running_head")
                    if re.match(r"\d{1,4}\b", s) or re.search(r"\b\d{1,4}$", s):
                        kinds[k].add("page_number")
                else:
                    kinds[k].add("page_number")
        for k, spans in enumerate(drop):
            text = texts[k]
            for a, b in sorted(spans, reverse=True):
                if text[a:b].strip() and not any(c < a and b <= d or c <= a and b < d for c, d in spans):  # not inside another
                    text = f"{text[:a].rstrip(' ')} {text[b:].lstrip(' ')}"
            texts[k] = re.sub(r"[ \t]*\n(?:[ \t]*\n)+", "\n", re.sub(r"\n[ \t]+\n", "\n", text)).strip()
        cuts = [(k, m) for k, t in enumerate(texts) for m in _CUT.finditer(t)]
        # finditer skips a hyphen whose right part is itself cut: look at those from the right part on.
        cuts += [(k, n) for k, m in cuts if (n := _CUT.match(texts[k], m.start(3)))]
        broken: list[dict[int, tuple[int, str, bool]]] = [{} for _ in texts]
        if cuts:
            p = self.broken.probability(np.array([join_features(m[1], m[3], m[2], self.known) for _, m in cuts]))
            for (k, m), yes in zip(cuts, p >= 0.5):
                if yes or m[2] == "-" and "\n" in m[0]:  # a compound keeps its hyphen; anything else stays as it is
                    broken[k][m.end(1)] = (m.start(3), "" if yes else "-", bool(yes))
        out = []
        for k, text in enumerate(texts):
            for a, (b, glue, yes) in sorted(broken[k].items(), reverse=True):
                text = text[:a] + glue + text[b:]
                if yes:
                    kinds[k].add("broken_word")
            out.append((sorted(kinds[k]), re.sub(r"\s*\n\s*", " ", text)))
        return out
