"""Noise of scanned pages over whole tables (problem 1): what each row holds, and the repaired text.

Vietnamese rows go through ``pagenoise`` (heads, numbers, broken syllables) and ``misread``; the boxes of
a Chinese page through a boosted classifier of neighbouring boxes (heads, numbers) and ``misread``.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions.unicode import nfc, nfd
from inkweave.llm.boosting import Boosted
from inkweave.llm.misread import SAMPLE_ROWS, column_text, is_ideograph, misread_columns, misread_words
from inkweave.llm.pagenoise import HEAD_RUN, RECURRING, PageNoise
from inkweave.session import cut_lineage


def bounded_sample(df: DataFrame, text: str, most: int = SAMPLE_ROWS) -> list[str]:
    """At most ``most`` non-empty texts, chosen by a hash of key and text: the same whatever the order of rows."""
    rows = df.where(F.length(text) > 0).select(F.xxhash64("vol", "id", text).alias("o"), F.col(text).alias("t"))
    return [r.t for r in rows.orderBy("o", "t").limit(most).collect()]


def usual_words(df: DataFrame, text: str) -> set[str]:
    """The words that occur at least once in 300 rows: so at most 300 times as many as a row holds in the mean."""
    words = F.regexp_extract_all(F.lower(nfc(F.col(text))), F.lit(r"\p{L}+"), F.lit(0))
    counted = df.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    rows = df.agg(F.count("*").alias("rows")).scalar()
    return {r.w for r in counted.where(F.col("n") * 300 >= rows).select("w").collect()}


def head_forms(df: DataFrame, text: str) -> list[str]:
    """Recurring runs of words in capitals, folded, the most frequent first: what heads of this corpus look like.

    Counted over all rows; a form recurs if it stands in ``RECURRING`` of them and at least twice, so there are at
    most as many as a row holds runs in the mean, over that share.
    """
    runs = F.regexp_extract_all(nfc(F.col(text)), F.lit(HEAD_RUN), F.lit(0))
    plain = F.translate(F.regexp_replace(nfd(F.lower("run")), r"\p{Mn}+", ""), "đ", "d")
    form = F.trim(F.regexp_replace(plain, r"[\p{N}\W_&&[^\p{L}]]+", " "))
    counted = df.select(F.explode(runs).alias("run")).groupBy(form.alias("form")).agg(F.count("*").alias("n"))
    rows = df.agg(F.count("*").alias("rows")).scalar()
    kept = counted.where((F.col("n") >= 2) & (F.col("n") >= F.lit(RECURRING) * rows) & (F.length("form") >= 6))
    return [r.form for r in kept.orderBy(F.desc("n"), "form").collect()]


def examine_vi(rows: DataFrame, text: str = "text") -> DataFrame:
    """vol, id, kinds, clean: furniture and broken syllables of each row, and its text without them."""
    shared = rows.sparkSession.sparkContext.broadcast(PageNoise.fit(bounded_sample(rows, text), usual_words(rows, text), head_forms(rows, text)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), 2000):
                part = b.iloc[k : k + 2000]
                found = shared.value.examine([t if isinstance(t, str) else None for t in part.t])
                yield pd.DataFrame({"vol": part.vol, "id": part.id, "kinds": [f[0] for f in found], "clean": [f[1] for f in found]})

    picked = rows.select("vol", "id", F.col(text).alias("t"))
    return picked.mapInPandas(run, "vol string, id string, kinds array<string>, clean string")


def _kinds(examined: DataFrame, misread: DataFrame) -> DataFrame:
    known = examined.select("vol", "id", F.explode("kinds").alias("kind"))
    return known.unionByName(misread.select("vol", "id").distinct().withColumn("kind", F.lit("misread")))


def vi_noise(rows: DataFrame) -> DataFrame:
    """vol, id, kind: the kinds of scan noise each Vietnamese row holds.

    Null, empty and clean rows give none; each kind once a row; an empty table no row. Keys must be unique.
    """
    examined = cut_lineage(examine_vi(cut_lineage(rows)))  # read four times before: for the sample, the words, the heads and the pass
    return _kinds(examined, misread_words(examined, bounded_sample(examined, "clean")))


def repaired_vi(rows: DataFrame) -> DataFrame:
    """vol, id, clean, repaired: the text without furniture and breaks, and with misread words replaced."""
    examined = cut_lineage(examine_vi(cut_lineage(rows)))
    wrong = misread_words(examined, bounded_sample(examined, "clean")).where("raw <> ''")
    fixes = wrong.groupBy("vol", "id").agg(F.sort_array(F.collect_list(F.struct("pos", "raw", F.coalesce("better", F.lit("")).alias("better")))).alias("fixes"))

    def fit_case(raw: str, better: str) -> str:
        return better.upper() if len(raw) > 1 and raw.isupper() else better[:1].upper() + better[1:] if raw[:1].isupper() else better

    @F.pandas_udf("string")
    def apply(clean: pd.Series, fixes: pd.Series) -> pd.Series:
        out = []
        for text, fs in zip(clean, fixes):
            done, at = [], 0
            for f in fs if fs is not None else []:
                k = text.find(f["raw"], at)
                if k < 0:
                    continue
                better = fit_case(f["raw"], f["better"]) if f["better"] else re.sub(r"\\\S*|\S*[{}_]\S*", "", re.sub(r"[^\w\\{}_]", "", f["raw"]))
                done.append(text[at:k] + better)
                at = k + len(f["raw"])
            done.append(text[at:] if isinstance(text, str) else "")
            out.append(re.sub(r" {2,}", " ", "".join(done)).strip())
        return pd.Series(out)

    return examined.join(fixes, ["vol", "id"], "left").select("vol", "id", "clean", apply("clean", "fixes").alias("repaired"))


# ---------------------------------------------------------------- boxes of a Chinese page

_NUMERALS = "〇一二三四五六七八九十百"


def box_features(b: pd.DataFrame) -> np.ndarray:
    """Of a box, its page and the box before it."""
    text = b["text"].fillna("")
    numerals = text.map(lambda s: sum(c in _NUMERALS or c.isdigit() or c in "第葉-ab" for c in s) / max(len(s), 1))
    return np.column_stack([
        (b.y0 - b.page_y0) / 50.0, (b.y1 - b.page_y0) / 50.0, (b.w - b.page_w) / 10.0, (b.w > b.h).astype(float), text.map(len), numerals,
        (b.y0 - b.before_y0.fillna(b.page_y0)) / 50.0, (b.w - b.before_w.fillna(b.page_w)) / 10.0,
    ]).astype(float)


def _box_models(seed: int = 2) -> tuple[Boosted, Boosted]:
    """Head and number classifiers, fitted on made-up pages: columns hang from one line, heads and numbers do not."""
    r, rows, kinds = random.Random(seed), [], []
    for _ in range(600):
        top, width, before = r.randint(60, 400), r.randint(20, 80), (None, None)
        for k in range(r.randint(6, 16)):
            kind = "column" if r.random() < 0.8 else r.choice(["head", "number"])
            n = r.randint(1, 20)
            text = "".join(r.choice("明清山水人天地永安孝義信") if r.random() < 0.85 else r.choice(_NUMERALS) for _ in range(n))
            y0, w = top + r.randint(-2, 2), width + r.randint(-2, 2)
            h = n * max(width - 4, 12) + r.randint(0, 60)
            if kind == "head":
                y0, w, text = top - r.randint(6, 40), int(width * r.uniform(0.4, 0.85)), text[:9] + r.choice(["", "第" + r.choice(_NUMERALS), "三十葉"])
            elif kind == "number":
                y0, w, h = top + r.randint(900, 2200), width + r.randint(-10, 30), r.randint(20, 60)
                text = r.choice([str(r.randint(1, 300)), f"{r.randint(1, 99)}-{r.choice('ab')}", "第" + "".join(r.choices(_NUMERALS, k=2)) + "葉", "".join(r.choices(_NUMERALS, k=3))])
            rows.append((text, y0, y0 + h, w, h, top, width, *before))
            kinds.append(kind)
            before = (y0, w)
    x = box_features(pd.DataFrame(rows, columns=["text", "y0", "y1", "w", "h", "page_y0", "page_w", "before_y0", "before_w"]))
    y = np.array(kinds)
    return Boosted(rounds=30).fit(x, y == "head"), Boosted(rounds=30).fit(x, y == "number")


def examine_boxes(boxes: DataFrame) -> DataFrame:
    """vol, id, kinds, chars: heads and numbers among the boxes of each page, and a column's characters.

    Boxes need vol, id, chapter, page, box_idx, bbox and sinonom. Boxes without text or without a whole
    bbox are columns. ``chars`` is null for heads and numbers.
    """
    corner = lambda k: F.when(F.size("bbox") == 4, F.col("bbox")[k]).cast("double")
    shaped = boxes.select(
        "vol", "id", "chapter", "page", "box_idx", F.col("sinonom").alias("text"), corner(1).alias("y0"), corner(3).alias("y1"),
        (corner(2) - corner(0)).alias("w"), (corner(3) - corner(1)).alias("h"),
    )
    # Most boxes of a page are columns, so the median tells where columns hang and how wide they are.
    page = shaped.groupBy("vol", "chapter", "page").agg(F.percentile_approx("y0", 0.5).alias("page_y0"), F.percentile_approx("w", 0.5).alias("page_w"))
    before = W.partitionBy("vol", "chapter", "page").orderBy("box_idx", "id")
    paired = shaped.withColumns({"before_y0": F.lag("y0").over(before), "before_w": F.lag("w").over(before)}).join(page, ["vol", "chapter", "page"])
    models = boxes.sparkSession.sparkContext.broadcast(_box_models())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            head, number = (m.probability(np.nan_to_num(box_features(b))) for m in models.value)
            kinds = []
            for t, p, q, whole in zip(b["text"], head, number, b.y0.notna() & b.y1.notna()):
                own = []
                if isinstance(t, str) and t.strip() and whole and max(p, q) >= 0.5:
                    own = ["running_head"] if p >= q else ["page_number"]
                    if p >= q and re.search(rf"[{_NUMERALS}]葉\s*$|\d\s*$", t):
                        own.append("page_number")
                kinds.append(own)
            yield pd.DataFrame({"vol": b.vol, "id": b.id, "kinds": kinds, "text": b["text"]})

    found = paired.mapInPandas(run, "vol string, id string, kinds array<string>, text string")
    return found.select("vol", "id", "kinds", F.when(F.size("kinds") == 0, column_text(F.col("text"))).alias("chars"))


def box_noise(boxes: DataFrame) -> DataFrame:
    """vol, id, kind: the kinds of scan noise each box holds. Null and empty boxes hold none."""
    examined = cut_lineage(examine_boxes(boxes))
    return _kinds(examined, misread_columns(examined.where("chars is not null"), bounded_sample(examined, "chars")))


def repaired_boxes(boxes: DataFrame) -> DataFrame:
    """vol, id, repaired: the characters of each column with misread ones replaced; null for heads and numbers.

    Where nothing better is known, an ideograph stays as it was read and debris, which is none, is left out.
    """
    examined = cut_lineage(examine_boxes(boxes))
    wrong = misread_columns(examined.where("chars is not null"), bounded_sample(examined, "chars"))
    fixes = wrong.groupBy("vol", "id").agg(F.map_from_entries(F.collect_list(F.struct("pos", F.coalesce("better", F.when(is_ideograph(F.col("raw")), F.col("raw")), F.lit("")).alias("to")))).alias("fixes"))
    mended = F.array_join(F.transform(F.split("chars", ""), lambda c, k: F.coalesce(F.try_element_at("fixes", (k + 1).cast("int")), c)), "")
    joined = examined.join(fixes, ["vol", "id"], "left")
    return joined.select("vol", "id", F.when(F.col("fixes").isNull(), F.col("chars")).otherwise(mended).alias("repaired"))


# How a statement that begins anew opens: a date, or a word of time.
OPENINGS = {
    "vi": r"^[«\"“]?(?:Năm|Tháng|Ngày|Mùa|Bấy giờ|Sau đó|Về sau|Trước đó|Khi ấy|Lúc ấy)(?!\p{L})",
    "han": r"^(?:於是|先是|是歲|是月|是日|是時|既而|初|\p{L}{2}[元一二三四五六七八九十百]{1,4}年)",
}
_ENDED = r"[.!?…。！？；!?;][»”\"」』)）]*$"


def paragraphs(rows: DataFrame, script: str = "vi", place: str = "sent_idx", glue: str = " ") -> DataFrame:
    """vol, chapter, paragraph_no, paragraph: each chapter as continuous paragraphs.

    ``rows`` has vol, chapter, page, the column ``place``, id and repaired; ``glue`` stands between two rows. A row
    begins a paragraph if it opens a new statement (a date or a word of time) and the row before has ended its
    sentence; where rows carry no marks at all, the opening alone decides. Rows without text leave no gap. A chapter
    is numbered by a window; only the rows of one paragraph are gathered.
    """
    kept = rows.where("length(repaired) > 0")
    order = W.partitionBy("vol", "chapter").orderBy("page", place, "id")
    before = F.lag("repaired").over(order)
    marked = kept.withColumns({"__k": F.row_number().over(order), "__before": before, "__open": F.col("repaired").rlike(OPENINGS[script])})
    new = F.col("__before").isNull() | (F.col("__open") & (F.col("__before").rlike(_ENDED) | ~F.col("__before").rlike(r"[.,;:!?…。，、；：！？]")))
    numbered = marked.withColumn("__new", new.cast("int")).withColumn("paragraph_no", F.sum("__new").over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
    gathered = numbered.groupBy("vol", "chapter", "paragraph_no").agg(F.sort_array(F.collect_list(F.struct("__k", "repaired"))).alias("x"))
    return gathered.select("vol", "chapter", "paragraph_no", F.array_join("x.repaired", glue).alias("paragraph"))
