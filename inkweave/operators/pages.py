"""Page classes of a volume and the bounds of its parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions.text import VI_MARKED, share, vi_tokens

# The least tokens of a text page, ink of a plate, diacritics of a Vietnamese page, and the Chinese pages of a run that is sure.
MIN_TOKENS, PLATE_INK, VI_RATIO, CONFIRM_RUN = 10, 0.02, 0.65, 3


def page_label(tokens: Column, ratio: Column, ink: Column) -> Column:
    """Few tokens: PLATE with ink, else BLANK; many: VI if enough of them carry diacritics, else HAN."""
    few = F.when(F.coalesce(ink, F.lit(0.0)) >= PLATE_INK, "PLATE").otherwise("BLANK")
    return F.when(tokens < MIN_TOKENS, few).otherwise(F.when(ratio >= VI_RATIO, "VI").otherwise("HAN"))


def classified_pages(pages: DataFrame, text: str, ink: str) -> DataFrame:
    """``pages`` with tokens, diac_ratio and label. A null text has no tokens."""
    listed = pages.withColumn("__t", vi_tokens(F.col(text)))
    marked = F.filter("__t", lambda t: t.rlike(f"[{VI_MARKED}]"))
    measured = listed.withColumns({"tokens": F.size("__t"), "diac_ratio": share(F.size(marked), F.size("__t"))}).drop("__t")
    return measured.withColumn("label", page_label(F.col("tokens"), F.col("diac_ratio"), F.col(ink)))


def running_count(rows: DataFrame, key: list[str], order: str, flag: Column, name: str, block: int = 4096) -> DataFrame:
    """``rows`` with how many rows of their key up to and with them have ``flag``; ``order`` is a whole number, unique in its key.

    Counted in two levels, within blocks of ``block`` numbers and over the blocks, so a key of many rows is
    spread over as many tasks as it has blocks.
    """
    laid = rows.withColumns({"__block": F.floor(F.col(order) / block), "__flag": flag.cast("int")})
    totals = laid.groupBy(*key, "__block").agg(F.sum("__flag").alias("__n"))
    earlier = W.partitionBy(*key).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(*key, "__block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = W.partitionBy(*key, "__block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    counted = laid.withColumn("__in", F.sum("__flag").over(within)).join(before, [*key, "__block"])
    return counted.withColumn(name, F.col("__before") + F.col("__in")).drop("__block", "__flag", "__in", "__before")


def han_starts(pages: DataFrame, key: list[str], page: str, label: str, confirm: int = CONFIRM_RUN) -> DataFrame:
    """key, han_start, boundary: the first HAN page of the first run without VI pages that has more than
    ``confirm`` HAN pages, and the page behind the last VI page before it (the start itself if there is none).
    Without such a run the start is null and the boundary lies behind the last page.
    """
    han = F.when(F.col(label) == "HAN", F.col(page))
    runs = running_count(pages.select(*key, page, label), key, page, F.col(label) == "VI", "__island").groupBy(*key, "__island").agg(
        F.count(han).alias("n"), F.min(han).alias("first"), F.max(page).alias("last"), F.max(F.when(F.col(label) == "VI", F.col(page))).alias("vi")
    )
    # The VI page that opens a run's island is the last one before the run.
    found = runs.groupBy(*key).agg(F.min(F.when(F.col("n") > confirm, F.struct("first", "vi"))).alias("s"), (F.max("last") + 1).alias("end"))
    start = F.col("s.first")
    return found.select(*key, start.alias("han_start"), F.when(start.isNull(), F.col("end")).otherwise(F.coalesce(F.col("s.vi") + 1, start)).alias("boundary"))


# What tells body pages and back matter by their text; _SOLO is a sign that is no part of a word.
_SOLO = r"(?:^|[^\p{L}\p{N}_])"
LEAF = r"[\[\(]\s*(?:t[ờo]\s*)?[0-9]{1,3}\s*[-–\s]*[abAB]?\s*[\]\)]"
BODY_WORD, HALF_TITLE = r"QUY[ỂỀE]N|M[ỆE]NH", r"d[ịi][cz]h\s+c[ủuú]a"
INDEX_LINE, CONTENTS = r"[^\s:：]+\s*[:：]\s*[0-9]", r"m[ụu]c\s*[-\s]*l[ụu]c"
BACK_MATTER = (
    r"TH[ƯU]\s*[-–]?\s*M[ỤU]C|NGUYÊN[-\s]*TÁC|T[ỦU][-\s]*SÁCH|B[ẢA]N\s*D[ỊI]CH\s*C[ỦU]A|BI[ỂẾEỀ]U\s*K[ÊẾE]|B[ẢA]NG\s*TRA|H[ẾEỀ]T\s*T[ẬAẤ]P"
    rf"|{_SOLO}[0-9]{{1,2}}\s*[.,]?\s*[a-z]?\s*/\s*[A-Z]{{2}}(?:[^\p{{L}}\p{{N}}_]|$)"
)
DENSE, CONTENTS_TOKENS, INDEX_SHARE, FEW_INDEX, SHORT_TOKENS, SHORT_SHARE, BODY_LINES = 120, 3, 0.5, 0.2, 4, 0.35, 10
_ANY_CASE = "(?iu)"


def spaced_tokens(text: Column) -> Column:
    """How many stretches without white space."""
    return F.size(F.filter(F.split(text, r"[\s\p{Z}]+"), lambda t: t != ""))


def page_signals(pages: DataFrame, text: str) -> DataFrame:
    """``pages`` with n_tokens, is_leaf, is_half_title, is_anchor, is_body: what a page's text says about its part.

    A leaf page has a leaf number and is dense or names a chapter; a half title is short and names a translator.
    An anchor is an index, a table of contents or another sign of back matter; a body page has a leaf number, or
    enough lines of which few are short or index-like and is no anchor. A null text has none.
    """
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, r"\r\n|\n|\r"), lambda x: ~x.rlike(r"^[\s\p{Z}]*$"))
    laid = pages.withColumns({"__l": lines, "n_tokens": spaced_tokens(t)})
    n = F.greatest(F.size("__l"), F.lit(1))
    part = lambda f: F.size(F.filter("__l", f)) / n
    laid = laid.withColumns({"__index": part(lambda x: x.rlike(INDEX_LINE)), "__short": part(lambda x: spaced_tokens(x) <= SHORT_TOKENS)})
    contents = F.exists("__l", lambda x: x.rlike(_ANY_CASE + CONTENTS) & (spaced_tokens(x) <= CONTENTS_TOKENS))
    laid = laid.withColumn("is_anchor", (F.col("__index") >= INDEX_SHARE) | t.rlike(_ANY_CASE + BACK_MATTER) | contents)
    leaf, dense = t.rlike(LEAF), F.col("n_tokens") >= DENSE
    running = (F.size("__l") >= BODY_LINES) & (F.col("__short") < SHORT_SHARE) & (F.col("__index") < FEW_INDEX) & ~F.col("is_anchor")
    return laid.withColumns({
        "is_leaf": leaf & (dense | t.rlike(_ANY_CASE + BODY_WORD)), "is_half_title": t.rlike(_ANY_CASE + HALF_TITLE) & ~dense, "is_body": leaf | running,
    }).drop("__l", "__index", "__short")


def body_starts(signals: DataFrame, key: list[str], page: str) -> DataFrame:
    """key, body_start: the first leaf page, else the first dense page behind the last half title, else null. ``signals``: pages of the half, see ``page_signals``."""
    p = F.col(page)
    agg = signals.groupBy(*key).agg(F.min(F.when(F.col("is_leaf"), p)).alias("leaf"), F.max(F.when(F.col("is_half_title"), p)).alias("half"))
    after = signals.where(F.col("n_tokens") >= DENSE).select(*key, p.alias("__p")).join(agg.select(*key, "half"), key).where("__p > half")
    return agg.join(after.groupBy(*key).agg(F.min("__p").alias("behind")), key, "left").select(*key, F.coalesce("leaf", "behind").alias("body_start"))


def body_ends(signals: DataFrame, key: list[str], page: str) -> DataFrame:
    """key, body_end: the last body page if an anchor follows it, else null (nothing to trim)."""
    p = F.col(page)
    agg = signals.groupBy(*key).agg(
        F.max(F.when(F.col("is_body"), p)).alias("body"), F.max(p).alias("last"), F.max(F.when(F.col("is_anchor"), p)).alias("anchor"),
    )
    return agg.select(*key, F.when((F.col("body") < F.col("last")) & (F.col("anchor") > F.col("body")), F.col("body")).alias("body_end"))


def split_volumes(pages: DataFrame, key: list[str], page: str, text: str, ink: str, confirm: int = CONFIRM_RUN) -> DataFrame:
    """key, page, tokens, diac_ratio, label, half, part: every page of every volume with the half and part it belongs to.

    The Vietnamese half has the VI pages before the boundary, the Chinese one the HAN and PLATE pages from there
    on; other pages belong to none (null). part of a Vietnamese page: 'front' before the body, 'body', 'back'
    behind it; a half without a sign of either bound is all body. Chinese pages are body.
    """
    labelled = classified_pages(pages, text, ink)
    bounds = han_starts(labelled, key, page, "label", confirm)
    half = F.when((F.col("label") == "VI") & (F.col(page) < F.col("boundary")), "vi").when(F.col("label").isin("HAN", "PLATE") & (F.col(page) >= F.col("boundary")), "han")
    placed = labelled.join(bounds.select(*key, "boundary"), key).withColumn("half", half)
    vi = page_signals(placed.where("half = 'vi'").select(*key, page, text), text).drop(text)
    starts = body_starts(vi, key, page)
    kept = vi.join(starts, key).where(F.col("body_start").isNull() | (F.col(page) >= F.col("body_start")))
    limits = starts.join(body_ends(kept, key, page), key, "left")
    part = F.when(F.col("half") == "han", "body").when(F.col("half") == "vi", F.when(F.col(page) < F.col("body_start"), "front").when(F.col(page) > F.col("body_end"), "back").otherwise("body"))
    return placed.join(limits, key, "left").select(*key, page, "tokens", "diac_ratio", "label", "half", part.alias("part"))


def volume_manifest(split: DataFrame, key: list[str], page: str) -> DataFrame:
    """key, num_pages, vi_pages, front, back, han_pages, blank, vi_first, vi_last, han_first: what ``split_volumes`` made of each volume."""
    p, vi = F.col(page), (F.col("half") == "vi") & (F.col("part") == "body")
    return split.groupBy(*key).agg(
        F.count("*").alias("num_pages"), F.count_if(vi).alias("vi_pages"), F.count_if(F.col("part") == "front").alias("front"), F.count_if(F.col("part") == "back").alias("back"),
        F.count_if(F.col("half") == "han").alias("han_pages"), F.count_if(F.col("label") == "BLANK").alias("blank"),
        F.min(F.when(vi, p)).alias("vi_first"), F.max(F.when(vi, p)).alias("vi_last"), F.min(F.when(F.col("half") == "han", p)).alias("han_first"),
    )


def numbered(rows: DataFrame, key: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """``rows`` with their place within the key, from 1."""
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*key).orderBy(*order)))


def windows_of(rows: DataFrame, length: Column, size: int = 460, overlap: int = 32) -> DataFrame:
    """``rows`` times their windows: win_no from 0, win_start, win_end, trusted_from (behind the overlap)."""
    step = size - overlap
    n = F.greatest(F.ceil((length - overlap) / step), F.lit(1)).cast("int")
    each = rows.where(length > 0).withColumn("win_no", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("win_no") * step
    return each.withColumns({
        "win_start": start, "win_end": F.least(start + size, length), "trusted_from": F.when(F.col("win_no") == 0, 0).otherwise(start + overlap),
    })
