"""Sentence boundaries in Vietnamese and in Chinese with or without marks (problem 3).

Everything is SQL expressions. What only looks like a stop (decimals, links, initials, abbreviations,
stops inside a quotation, numbers of a page) is masked by private-use characters; the terminators of the
script are then found by regular expressions and a boundary character is set behind each; at last the
masks are turned back. Chinese rows without any mark have no terminators: there every gap between two
characters is scored by what stands before and behind it, with weights learnt from the rows that are
punctuated (see ``boundaries``), and a boundary is set where the score is above zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfc, nfkc, strip_ignorable
from inkweave.llm import boundaries
from inkweave.llm.lookalikes import KANA, RADICALS

#: The boundary, and the masks of . ! ? … and of the Chinese stops.
BREAK = ""
_STOPS, _MASKS = ".!?…。;,", ""
_MASK = dict(zip(_STOPS, _MASKS))

# Abbreviations before a name, a number or at the end of an enumeration.
ABBREVIATIONS = "Ng NXB TS Ph PGS GS ThS BS KS Th Tr TP Tx ô Ô t q tr Tr vd VD x cf"


def _masked(text: Column) -> Column:
    return F.translate(text, _STOPS.replace(",", ""), "".join(m for stop, m in _MASK.items() if stop != ","))


def _mask_quoted(text: Column, opening: str, closing: str) -> Column:
    """Masks the stops whose next quotation mark closes, however far it is; every stretch is read once."""
    marks = opening + closing
    pieces = F.regexp_extract_all(text, F.lit(f"[^{marks}]*+[{marks}]|[^{marks}]++"), F.lit(0))
    masked = F.array_join(F.transform(pieces, lambda x: F.when(F.right(x, F.lit(1)).isin(*closing), _masked(x)).otherwise(x)), "")
    return F.when(text.rlike(f"[{closing}]"), masked).otherwise(text)


_LINK = r"(?:https?://|www\.)"


def _mask_links(text: Column) -> Column:
    """Masks the stops of links of any length; one at the end of a link is none of its own."""
    pieces = F.split(F.regexp_replace(text, rf"({_LINK}[^\s«»\"]*+)", f"{BREAK}$1{BREAK}"), BREAK)
    inner = lambda x: F.concat(_masked(F.substring(x, F.lit(1), F.length(x) - 1)), F.right(x, F.lit(1)))
    linked = F.array_join(F.transform(pieces, lambda x: F.when(x.rlike(f"^{_LINK}"), inner(x)).otherwise(x)), "")
    return F.when(text.contains("://") | text.contains("www."), F.regexp_replace(linked, r"(?<=www)\.", _MASK["."])).otherwise(text)


def vi_marked(text: Column) -> Column:
    """A Vietnamese text with a boundary character behind every sentence but the last; null stays null."""
    t = nfc(strip_ignorable(text))
    t = _mask_links(t)
    t = F.regexp_replace(t, r'"([^"«»]*+)"', "«$1»")
    dot = _MASK["."]
    # A page number that stands on a line of its own between stops.
    t = F.regexp_replace(t, r"(?m)^[ \t]*\.[ \t]*([0-9]{1,4})[ \t]*\.[ \t]*$", f"{dot}$1{dot}")
    t = F.regexp_replace(t, r"(?<=[0-9])\.(?=[0-9])", dot)
    t = F.regexp_replace(t, r"(?<![\p{L}\p{M}])(v)\.\s?(v)\.(?=\s*[\p{Ll},;:)])", f"$1{dot}$2{dot}")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{M}])(v)\.(?=\s?v(?!\p{L}))", f"$1{dot}")
    t = F.regexp_replace(t, rf"(?<![\p{{L}}\p{{M}}])({'|'.join(sorted(set(ABBREVIATIONS.split())))})\.(?!\.)", f"$1{dot}")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{M}\p{N}])(\p{Lu})\.(?!\.)", f"$1{dot}")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{M}])(\p{L})\.(?=\p{L}\.)", f"$1{dot}")
    t = _mask_quoted(t, "«", "»")
    t = F.regexp_replace(t, r"([.!?…]+[)\]”’]*)(?=\s*[^\s.!?…,;:)\]”’»])", f"$1{BREAK}")
    # A quotation introduced by a colon ends its sentence.
    return F.regexp_replace(t, rf"(:\s*«[^«»]*»)(?=\s*[^\s.!?…,;:)\]»{BREAK}])", f"$1{BREAK}")


_PLAIN = "".join(c[0] * (len(c) - 1) for c in f"{KANA} {RADICALS} 〇○◯".split())
_ALIKE = "".join(c[1:] for c in f"{KANA} {RADICALS} 〇○◯".split())


def han_plain(text: Column) -> Column:
    """Plain ideographs and marks, without spaces; each letter or digit stays one character."""
    return F.translate(F.regexp_replace(nfkc(strip_ignorable(text)), r"(?U)\s+", ""), _ALIKE, _PLAIN)


#: A Chinese row with any of these is punctuated.
PUNCTUATED = "[。!?;…,，.]"


def han_marked(plain: Column) -> Column:
    """A plain punctuated Chinese text with a boundary character behind every sentence but the last; null stays null."""
    t = _mask_quoted(F.regexp_replace(plain, r"\.", "。"), "「『", "」』")
    t = F.regexp_replace(t, r"([。!?;…]+[」』]*)(?=[^。!?;…」』])", f"$1{BREAK}")
    return F.regexp_replace(t, rf"(:「[^「」]*」)(?=[^。!?;…」』,{BREAK}])", f"$1{BREAK}")


def unmasked(marked: Column) -> Column:
    return F.translate(marked, _MASKS, _STOPS)


def boundary_counts(marked: Column) -> Column:
    """For each boundary, how many letters and digits stand before it."""
    chars = F.split(F.regexp_replace(marked, rf"[^\p{{L}}\p{{N}}{BREAK}]+", ""), "")
    places = F.filter(F.transform(chars, lambda c, k: F.when(c == BREAK, k).otherwise(-1)), lambda k: k >= 0)
    return F.transform(places, lambda k, before: k - before)


def _as_written(counts: Column, raw: Column) -> Column:
    """Counts over plain text as counts over the row as it stands, where a radical sign is no letter."""
    signs = F.regexp_extract_all(raw, F.lit(r"[\p{L}\p{N}\x{2E80}-\x{2FDF}]"), F.lit(0))
    flags = F.transform(signs, lambda c: c.rlike(r"[\x{2E80}-\x{2FDF}]").cast("int"))
    fewer = F.transform(counts, lambda k: k - F.aggregate(F.slice(flags, F.lit(1), k), F.lit(0), lambda a, x: a + x))
    return F.when(raw.rlike(r"[\x{2E80}-\x{2FDF}]"), fewer).otherwise(counts)


def _checked(script: str) -> None:
    if script not in ("vi", "han"):
        raise ValueError(f"no terminators for script {script}")


def _cut(df: DataFrame, text: str, script: str, keep: tuple[str, ...], model: boundaries.Gaps | None) -> DataFrame:
    """``keep`` columns, __raw, and either __marked, a marked text, or __cuts, the letters of a bare one behind which a sentence ends."""
    _checked(script)
    picked = df.select(*keep, F.col(text).alias("__raw")).where("__raw is not null")
    none = F.lit(None).cast("array<int>").alias("__cuts")
    if script == "vi":
        return picked.select(*keep, "__raw", vi_marked(F.col("__raw")).alias("__marked"), none)
    plain = picked.withColumn("__plain", han_plain(F.col("__raw")))
    marked = plain.where(F.col("__plain").rlike(PUNCTUATED)).select(*keep, "__raw", han_marked(F.col("__plain")).alias("__marked"), none)
    bare = plain.where(~F.col("__plain").rlike(PUNCTUATED))
    scored = boundaries.cut_bare(bare, keep, "__raw", "__plain", model or learn_boundaries(df, text))
    return marked.unionByName(scored.select(*keep, "__raw", F.lit(None).cast("string").alias("__marked"), "__cuts"))


def learn_boundaries(df: DataFrame, text: str, most: int = boundaries.LABELLED) -> boundaries.Gaps:
    """Weights for bare Chinese text from the punctuated rows of ``df``: at most ``most`` labelled rows, chosen by a hash of
    the text whatever the order of rows. Without any, no bare text is cut."""
    raw = F.col(text)
    some = df.where(raw.rlike("[。！？；｡!?;]") & (F.length(raw) <= boundaries.LONGEST)).select(F.xxhash64(raw).alias("o"), raw.alias("t")).orderBy("o", "t").limit(most)
    rows = some.select(han_marked(han_plain(F.col("t"))).alias("m")).collect()
    return boundaries.Gaps.fit([r.m for r in rows], BREAK)


def sentence_boundaries(df: DataFrame, text: str, script: str, *keep: str, model: boundaries.Gaps | None = None) -> DataFrame:
    """``keep`` columns, boundary_at: a row per place inside a text where one sentence ends and the next begins.

    ``boundary_at`` counts the letters and digits of the text as it stands before that place. Null, empty
    and one-sentence texts give no row; the text's own start and end are no boundaries; repeated rows give
    theirs again; an empty table none. ``script`` is 'vi' or 'han'; for 'han', ``model`` cuts rows without
    marks and is learnt from the punctuated rows of ``df`` where it is not given.
    """
    found = _cut(df, text, script, keep, model).where(F.col("__marked").contains(BREAK) | (F.size("__cuts") > 0))
    counts = F.coalesce("__cuts", boundary_counts(F.col("__marked")))
    if script == "han":
        counts = _as_written(counts, F.col("__raw"))
    all_of_it = F.length(F.regexp_replace(F.col("__raw"), r"[^\p{L}\p{N}]+", ""))
    each = found.select(*keep, all_of_it.alias("__all"), F.explode(F.array_distinct(counts)).alias("boundary_at"))
    return each.where("boundary_at > 0 AND boundary_at < __all").drop("__all")


def sentence_units(df: DataFrame, text: str, script: str, *keep: str, model: boundaries.Gaps | None = None) -> DataFrame:
    """``keep`` columns, unit_no (from 1), unit: every sentence of every text, trimmed, none of them blank.

    Null and blank texts give no row. Units are composed, without invisible characters; Chinese ones are
    plain forms without spaces. ``model`` as in ``sentence_boundaries``.
    """
    broken = boundaries.with_breaks(han_plain(F.col("__raw")), F.col("__cuts"), BREAK)
    pieces = F.transform(F.split(F.when(F.col("__marked").isNotNull(), unmasked(F.col("__marked"))).otherwise(broken), BREAK), lambda x: F.btrim(x, F.lit(" \t\r\n 　")))
    each = _cut(df, text, script, keep, model).select(*keep, F.posexplode(F.filter(pieces, lambda x: x.rlike(r"[\p{L}\p{N}]"))).alias("unit_no", "unit"))
    return each.withColumn("unit_no", F.col("unit_no") + 1)
