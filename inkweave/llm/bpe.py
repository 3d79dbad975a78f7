"""Encoding by a public byte-level BPE tokenizer, and back (problem 7).

A text is cut into pieces by the tokenizer's own pattern. Within a piece the byte symbols form a
doubly linked list; a priority queue holds the merges of neighbouring symbols by rank, then place.
The best is taken out, skipped if one of its symbols has been merged meanwhile (a stale entry), else
carried out, and the new neighbours are pushed. Decoding concatenates the vocabulary strings.

Two exact shortcuts keep this off the hot path: a merge can never span two bytes that stand side by
side in no vocabulary string, so a piece is cut there first (between most ideographs); and what has
been encoded is remembered in a table of bounded size.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pattern of the byte-level tokenizer file (fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Largest tokenizer file that is broadcast, in bytes; the public ones have under 2 MB.
MOST_BYTES = 64 << 20
#: Most entries of a worker's table of encoded chunks, and the longest chunk in it.
REMEMBERED, REMEMBERED_BYTES = 400_000, 256


def byte_names() -> list[str]:
    """The printable character by which the file writes each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + k)
    return [names[b] for b in range(256)]


class _Known(dict):
    """Pieces with their ids; a piece that is not there is encoded."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        return self.encode(piece)


class ByteBPE:
    """The model of a byte-level tokenizer file, given as its bytes."""

    def __init__(self, content: bytes) -> None:
        model = json.loads(content)["model"]
        vocab: dict[str, int] = model["vocab"]
        names = byte_names()
        value = {c: b for b, c in enumerate(names)}
        self.bytes_of = {i: bytes(value[c] for c in t) for t, i in vocab.items() if all(c in value for c in t)}
        self.first = [vocab[c] for c in names]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.together = {(t[k] << 8) | t[k + 1] for t in self.bytes_of.values() for k in range(len(t) - 1)}
        self.find = regex.compile(PATTERN).findall
        self.known = _Known(self.piece)
        self.ends: dict[str, tuple[int, int]] = {}  # first and last byte of a character

    def merge(self, data: bytes) -> list[int]:
        """The symbols of one chunk after all merges."""
        sym = [self.first[b] for b in data]
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges, heap = self.merges, []
        for k in range(n - 1):
            if (m := merges.get((sym[k], sym[k + 1]))) is not None:
                heap.append((m[0], k, sym[k], sym[k + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            j = after[k] if sym[k] == a else n
            if j >= n or sym[j] != b:
                continue  # stale
            sym[k], sym[j] = new, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (m := merges.get((new, sym[after[k]]))) is not None:
                    heapq.heappush(heap, (m[0], k, new, sym[after[k]], m[1]))
            if (p := before[k]) >= 0 and (m := merges.get((sym[p], new))) is not None:
                heapq.heappush(heap, (m[0], p, sym[p], new, m[1]))
        return [s for s in sym if s >= 0]

    def remember(self, text: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(text) <= REMEMBERED_BYTES // 4:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = ids
        return ids

    def piece(self, text: str) -> tuple[int, ...]:
        """The ids of one piece; it is cut where no merge can pass."""
        known, together = self.known, self.together
        if len(text) == 1 or text.isascii():
            return self.remember(text, tuple(self.merge(text.encode())))
        ends = self.ends
        out: list[int] = []
        at, last = 0, -1
        for k, c in enumerate(text):
            if (e := ends.get(c)) is None:
                data = c.encode()
                e = ends[c] = (data[0], data[-1])
            if k and (last << 8 | e[0]) not in together:
                chunk = text[at:k]
                out += known.get(chunk) or self.remember(chunk, tuple(self.merge(chunk.encode())))
                at = k
            last = e[1]
        chunk = text[at:]
        out += known.get(chunk) or self.remember(chunk, tuple(self.merge(chunk.encode())))
        return self.remember(text, tuple(out))

    def encode(self, text: str) -> list[int]:
        """All ids of a text; special tokens are ordinary text."""
        return list(chain.from_iterable(map(self.known.__getitem__, self.find(text))))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def model_of(content: bytes) -> ByteBPE:
    return ByteBPE(content)


def _shared(df: DataFrame, path: str):
    content = open(path, "rb").read(MOST_BYTES + 1)
    if len(content) > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes and is not broadcast")
    return df.sparkSession.sparkContext.broadcast(content)


def encode_texts(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key``, ids array<int>: every row's text as token ids, without special tokens.

    A null and an empty text both give an empty list; every input row gives one row, repeated rows
    too; an empty table gives none. ``path`` is the tokenizer file, read on the driver. The whole text
    is encoded, however long. Columns other than ``key`` and ``text`` are not read.
    """
    shared = _shared(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model_of(shared.value).encode
        for b in batches:
            texts = b.column(1)
            ends, ids = np.zeros(len(b) + 1, np.int32), []
            parts = []
            for k in range(len(b)):
                t = texts[k].as_py()
                if t:
                    ids += encode(t)
                    if len(ids) > 1_000_000:
                        parts.append(np.array(ids, np.int32))
                        ids = []
                ends[k + 1] = len(ids) + sum(map(len, parts))
            parts.append(np.array(ids, np.int32))
            flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))
            yield pa.record_batch([b.column(0), flat], names=[key, "ids"])

    picked = df.select(F.col(key), F.col(text).alias("__text"))
    kind = picked.schema[0].dataType.simpleString()
    return picked.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode_ids(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """``key``, text: the vocabulary strings of the ids, joined. Null gives null, an empty list an empty text."""
    shared = _shared(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = model_of(shared.value).decode
        for b in batches:
            texts = [None if x is None else decode(x) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    picked = df.select(F.col(key), F.col(ids).alias("__ids"))
    kind = picked.schema[0].dataType.simpleString()
    return picked.mapInArrow(run, f"`{key}` {kind}, text string")
