"""Splitting oversized texts at natural boundaries (problem 6): agglomerative merging.

A text is cut into atoms: every pause mark with its closing quotes ends one, and so does the reach of a
piece. Adjacent atoms are held in a heap by the strength of the boundary between them; the weakest boundary
is merged first, if what it joins still fits, and the merged segment meets its new neighbours (pairs that
are gone are skipped when they come up). Boundaries that never fit are where the pieces end.

``merged_pieces`` merges over the whole text: two segments fit if together with the overlap they stay
within the limit. ``pieces`` gives the cut that the problem states, where every piece ends at the strongest
boundary of its reach: there the atoms are those of one reach and of what follows it, and a merge fits as
long as the piece itself, the segment at the start, does not grow beyond the limit.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRONG, WEAK, CLOSERS = "。！？；", "，、：", "」』"
PIECES = "array<struct<piece_no:int,start_pos:int,end_pos:int>>"
_ATOM = re.compile(f"[{STRONG}{WEAK}][{CLOSERS}]*")


def merge_weakest(ends: list[int], strength: list[tuple], fits: Callable[[int, int, int], bool], start: int = 0) -> list[int]:
    """The ends of the segments left when atoms have been merged over their weakest boundaries.

    Atom k reaches from the end before it (``start`` for the first) to ``ends[k]``; ``strength[k]`` is that of
    the boundary behind it. Of equally weak boundaries the one whose sides are smallest together goes first.
    ``fits(begin, middle, end)`` says whether the segments on both sides of ``middle`` may be one; segments only
    grow, so a pair that does not fit is not asked again.
    """
    n = len(ends)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # the boundaries that are left, linked
    begin = lambda k: ends[before[k]] if before[k] >= 0 else start
    gone = [False] * n
    heap = [(strength[k], ends[k + 1] - begin(k), k) for k in range(n - 1)]  # the segments that meet at boundary k
    heapq.heapify(heap)
    while heap:
        _, size, k = heapq.heappop(heap)
        right = after[k]
        if gone[k] or ends[right] - begin(k) != size:
            continue  # stale: a side has grown since, and the pair is in the heap anew
        if not fits(begin(k), ends[k], ends[right]):
            continue
        gone[k], left = True, before[k]
        before[right] = left
        if left >= 0:
            after[left] = right
            heapq.heappush(heap, (strength[left], ends[right] - begin(left), left))
        if after[right] < n:
            heapq.heappush(heap, (strength[right], ends[after[right]] - begin(right), right))
    return [e for e, g in zip(ends, gone) if not g]


def _atoms(text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """(end, strength of its mark) of every marked stretch."""
    for m in _ATOM.finditer(text, start, stop):
        yield m.end(), 3 if text[m.start()] in STRONG else 2


def _end_of_piece(text: str, start: int, limit: int, least: int) -> int:
    """Where the piece from ``start`` ends, given that more than ``limit`` characters follow.

    A boundary too near the start is weaker than any other, as is one without a mark; of equal ones the later is stronger.
    """
    stop = start + limit
    ends: list[int] = []
    strength: list[tuple] = []
    for m in _ATOM.finditer(text, start, stop):
        if m.end() >= stop and m.start() < start + least:
            break
        ends.append(m.end())
        strength.append((0 if m.start() - start < least else 3 if text[m.start()] in STRONG else 2, m.end()))
    if not ends or ends[-1] < stop:
        ends.append(stop)
        strength.append((1, stop))  # a cut behind the limit: better than one too near the start
    ends.append(stop + 1)  # what follows
    strength.append((4, 0))
    return merge_weakest(ends, strength, lambda begin, _, end: begin > start or end <= stop, start)[0]


def merged_pieces(text: str | None, limit: int = 120, overlap: int = 15) -> list[tuple[int, int, int]]:
    """(piece_no, start_pos, end_pos) of a text longer than ``limit`` characters, else nothing, by merging over the whole text.

    Atoms are the marked stretches; longer ones are cut into runs that fit. A segment takes its neighbour over the
    weakest boundary (no mark, a weak mark, a strong one; of equal ones where it gets smallest) while both and the
    overlap fit. Every
    piece but the first then begins ``overlap`` characters early, or less where the piece before is shorter.
    """
    if text is None or len(text) <= limit:
        return []
    room, ends, strength, at = limit - overlap, [], [], 0
    for end, kind in [*_atoms(text, 0, len(text)), (len(text), 4)]:
        while end - at > room:
            at += room
            ends.append(at)
            strength.append((1,))
        if end > at:
            ends.append(end)
            strength.append((kind,))
            at = end
    cuts = merge_weakest(ends, strength, lambda begin, _, end: end - begin + overlap <= limit)
    starts = [0, *cuts[:-1]]
    return [(k + 1, s if not k else max(s - overlap, starts[k - 1]), e) for k, (s, e) in enumerate(zip(starts, cuts))]


def pieces(text: str | None, limit: int = 120, least: int = 60, overlap: int = 15) -> list[tuple[int, int, int]]:
    """(piece_no, start_pos, end_pos) of a text longer than ``limit`` characters, else nothing."""
    if text is None or len(text) <= limit:
        return []
    out, start = [], 0
    while len(text) - start > limit:
        end = _end_of_piece(text, start, limit, least)
        out.append((len(out) + 1, start, end))
        start = end - overlap
    out.append((len(out) + 1, start, len(text)))
    return out


def split_oversized(df: DataFrame, text: str, *keep: str, limit: int = 120, least: int = 60, overlap: int = 15) -> DataFrame:
    """``keep`` columns, piece_no, start_pos, end_pos: the pieces of each text of more than ``limit`` characters.

    A piece ends behind a mark among its characters ``least`` + 1 to ``limit``, with the closing quotes
    directly behind that mark as far as ``limit`` reaches; where there is none, behind ``limit``.
    Null, empty and shorter texts give no row; a repeated row gives its pieces again; an empty table
    none. Columns other than ``keep`` and ``text`` are not read, so their names can't clash.
    """
    if not 0 <= overlap < least < limit:
        raise ValueError("needs 0 <= overlap < least < limit")

    return _split(df, text, keep, limit, lambda t: pieces(t, limit, least, overlap))


def split_merged(df: DataFrame, text: str, *keep: str, limit: int = 120, overlap: int = 15) -> DataFrame:
    """The same columns with the pieces of ``merged_pieces``: cut where the whole text pauses most, none longer than ``limit``."""
    if not 0 <= overlap < limit:
        raise ValueError("needs 0 <= overlap < limit")
    return _split(df, text, keep, limit, lambda t: merged_pieces(t, limit, overlap))


def _split(df: DataFrame, text: str, keep: tuple[str, ...], limit: int, of: Callable[[str], list]) -> DataFrame:
    @F.pandas_udf(PIECES)
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([[dict(zip(("piece_no", "start_pos", "end_pos"), p)) for p in of(t)] for t in s])

    long = df.select(*keep, F.col(text).alias("__text")).where(F.length("__text") > limit)
    return long.select(*keep, F.explode(cut("__text")).alias("__p")).select(*keep, "__p.piece_no", "__p.start_pos", "__p.end_pos")
