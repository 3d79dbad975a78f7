"""Layout of a page's boxes: geometry, columns from the right, rows from the top."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Shares of the page's median width (of its median area for tiny boxes, of its width for the
# margin), the boxes that make a column double, pixels between rows, the least height of a line; and the head's zone,
# its tallest line and the least gap below it, in middle values.
COLUMN_GAP, NARROW, TINY_AREA, SPLIT_SPAN, HEAD_MARGIN, HEAD_NARROW = 0.55, 0.62, 0.06, 0.28, 0.16, 0.72
DOUBLE, ROW_TOLERANCE, LINE_HEIGHT = 4, 12, 8
HEAD_ZONE, HEAD_LINES, HEAD_GAP = 0.18, 1.8, 1.4


def geometry(bbox: Column) -> dict[str, Column]:
    """Centre, width, height and area of (x0, y0, x1, y1); null where the box is not whole."""
    x0, y0, x1, y1 = (F.when(F.size(bbox) == 4, F.try_element_at(bbox, F.lit(k + 1))) for k in range(4))
    w, h = x1 - x0, y1 - y0
    return {"cx": (x0 + x1) / 2, "cy": (y0 + y1) / 2, "bw": w, "bh": h, "area": w.cast("bigint") * h}


def polygon_box(points: Column) -> Column:
    """The bounding box of an array of (x, y) pairs."""
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y))


def unrotated_box(box: Column, width: Column) -> Column:
    """A box read on the page turned by 90 degrees, back on the page of the given width; rounded half to even."""
    turned = F.array(width - 1 - box[3], box[0], width - 1 - box[1], box[2])
    return F.transform(turned, lambda v: F.bround(v, 0).cast("int"))


def without_tiny(boxes: DataFrame, page: list[str], share: float = TINY_AREA) -> DataFrame:
    """Boxes of at least ``share`` of the median area of their page. Boxes that are not whole are kept."""
    sized = boxes.withColumn("__area", geometry(F.col("bbox"))["area"])
    medians = sized.groupBy(*page).agg(F.median("__area").alias("__median"))
    return sized.join(medians, page).where(F.col("__area").isNull() | (F.col("__area") >= F.lit(share) * F.col("__median"))).drop("__area", "__median")


def clustered(centres: Column, limit: Column) -> Column:
    """For values in the order of an array: the cluster of each (from 0), joining the present one if no farther than
    ``limit`` from its running mean. The array is of structs with field v; the result of ints."""
    start = F.struct(F.lit(0).alias("c"), F.lit(0).alias("n"), F.lit(0.0).alias("s"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        same = (a["n"] == 0) | (F.abs(x["v"] - a["s"] / F.greatest(a["n"], F.lit(1))) <= limit)
        c = F.when(same, a["c"]).otherwise(a["c"] + 1)
        return F.struct(c.alias("c"), F.when(same, a["n"] + 1).otherwise(1).alias("n"),
                        F.when(same, a["s"] + x["v"]).otherwise(x["v"]).alias("s"), F.concat(a["out"], F.array(c)).alias("out"))

    return F.aggregate(centres, start, step, lambda a: a["out"])


def tall_enough(boxes: DataFrame, least: int = LINE_HEIGHT) -> DataFrame:
    """Lines of at least ``least`` pixels. Boxes that are not whole are left out."""
    return boxes.where(geometry(F.col("bbox"))["bh"] >= least)


def crop_window(bbox: Column, width: Column, height: Column, pad: int = 0, scale: int = 1) -> Column:
    """(x0, y0, x1, y1) of a box widened by ``pad`` pixels (narrowed if negative), kept on the page, times ``scale``."""
    low = lambda v: F.greatest(v - pad, F.lit(0)) * scale
    high = lambda v, most: F.least(v + pad, most) * scale
    return F.when(F.size(bbox) == 4, F.array(low(bbox[0]), low(bbox[1]), high(bbox[2], width), high(bbox[3], height)))


def columns_of_pages(boxes: DataFrame, page: list[str], page_width: Column, head_phrases: tuple[str, ...] = (), gap: float = COLUMN_GAP) -> DataFrame:
    """page, column_no (from the right, 1), n, x0, y0, x1, y1, text, conf, is_double: the boxes of a page merged into columns.

    Tiny boxes are left out. Boxes are taken from the right; one joins the column whose running mean of centres
    is at most ``gap`` of the page's median width away. The first and the last column are running heads if they
    lie within the margin and are narrow, any column if its text holds a head phrase. A column is double
    (interlinear) with four boxes, or with three of which one is narrow and whose centres lie apart; its right
    half is read before its left one, each from the top. conf is the least. A page is a bounded group (what fits
    on one sheet). Boxes that are not whole are left out; a null text is empty. ``page_width`` is an aggregate.
    """
    g = geometry(F.col("bbox"))
    sized = boxes.select(*page, "id", "bbox", F.coalesce("sinonom", F.lit("")).alias("t"), "conf", *(g[k].alias(k) for k in ("cx", "cy", "bw", "area"))).where("cx is not null")
    some = lambda c: F.coalesce(F.nullif(F.median(c), F.lit(0.0)), F.lit(1.0))
    pages = sized.groupBy(*page).agg(
        some("bw").alias("w"), some("area").alias("a"), page_width.alias("page_w"),
        F.sort_array(F.collect_list(F.struct((-F.col("cx")).alias("m"), "id", F.col("cx").alias("v"), "cy", "bw", "area", "bbox", "t", "conf"))).alias("b"),
    )
    kept = pages.withColumn("b", F.filter("b", lambda x: x["area"] >= F.lit(TINY_AREA) * F.col("a"))).where(F.size("b") > 0)
    named = kept.withColumn("c", clustered(F.col("b"), F.lit(gap) * F.col("w"))).withColumn("last", F.element_at("c", -1))
    each = named.select(*page, "w", "page_w", "last", F.posexplode(F.arrays_zip("b", "c")).alias("k", "z")).select(*page, "w", "page_w", "last", "k", F.col("z.c").alias("c"), "z.b.*")
    whole = each.groupBy(*page, "c", "w", "page_w", "last").agg(
        F.sort_array(F.collect_list(F.struct("k", "v", "cy", "bw", "bbox", "t"))).alias("b"), F.avg("v").alias("mean_x"), F.avg("bw").alias("mean_w"),
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.round(F.min("conf"), 3).alias("conf"),
    )
    margin = F.lit(HEAD_MARGIN) * F.col("page_w")
    strip = F.col("c").isin(0) | (F.col("c") == F.col("last"))
    strip = strip & ((F.col("mean_x") < margin) | (F.col("mean_x") > F.col("page_w") - margin)) & (F.col("mean_w") < F.lit(HEAD_NARROW) * F.col("w"))
    read = F.array_join("b.t", "")
    for phrase in head_phrases:
        strip = strip | read.contains(phrase)
    body = whole.where(~strip)
    n, narrow = F.size("b"), F.exists("b", lambda x: x["bw"] < F.lit(NARROW) * F.col("w"))
    double = (n >= DOUBLE) | ((n >= 3) & narrow & (F.col("hi") - F.col("lo") > F.lit(SPLIT_SPAN) * F.col("w")))
    placed = body.withColumn("is_double", double).withColumn(
        "b", F.array_sort(F.transform("b", lambda x: F.struct((F.col("is_double") & (x["v"] < (F.col("hi") + F.col("lo")) / 2)).alias("left"), x["cy"].alias("cy"), x["k"].alias("k"), x["bbox"].alias("bbox"), x["t"].alias("t"))))
    )
    side = lambda k: F.transform("b", lambda x: x["bbox"][k])
    return placed.select(
        *page, F.row_number().over(W.partitionBy(*page).orderBy("c")).alias("column_no"), F.size("b").cast("bigint").alias("n"), F.array_min(side(0)).alias("x0"), F.array_min(side(1)).alias("y0"),
        F.array_max(side(2)).alias("x1"), F.array_max(side(3)).alias("y1"), F.array_join("b.t", "").alias("text"), "conf", "is_double",
    )


def reading_order(boxes: DataFrame, page: list[str], tolerance: int = ROW_TOLERANCE) -> DataFrame:
    """``page`` columns, id, row_no, place: rows from the top, each from the left.

    A box belongs to the row whose first box lies at most ``tolerance`` higher; both numbers are from 1.
    Boxes that are not whole are left out. A page is a bounded group.
    """
    whole = boxes.where(F.size("bbox") == 4).select(*page, F.struct(F.col("bbox")[1].alias("y"), F.col("bbox")[0].alias("x"), "id").alias("b"))
    start = F.struct(F.lit(0).alias("row"), F.lit(None).cast("int").alias("top"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, b: Column) -> Column:
        new = a["top"].isNull() | (b["y"] - a["top"] > tolerance)
        row = F.when(new, a["row"] + 1).otherwise(a["row"])
        return F.struct(row.alias("row"), F.when(new, b["y"]).otherwise(a["top"]).alias("top"), F.concat(a["out"], F.array(row)).alias("out"))

    pages = whole.groupBy(*page).agg(F.sort_array(F.collect_list("b")).alias("b"))
    numbered = pages.withColumn("row_no", F.aggregate("b", start, step, lambda a: a["out"]))
    each = numbered.select(*page, F.explode(F.arrays_zip("b", "row_no")).alias("z")).select(*page, "z.b.*", "z.row_no")
    place = F.row_number().over(W.partitionBy(*page).orderBy("row_no", "x", "y", "id"))
    return each.withColumn("place", place).select(*page, "id", "row_no", "place")


def header_crop(profile: DataFrame, page: list[str], height: str, width: str) -> DataFrame:
    """page, crop_y: where the head of a page ends, from its rows of pixels (page, y, ink, height, width).

    Rows with ink over 1.2 % of the width form bands; bands whose rows lie at most max(4, 0.4 % of the height)
    apart are one. If the first band begins in the head's zone, is no taller than HEAD_LINES middle bands and
    the way to the second is at least HEAD_GAP middle ways and over half a middle band, the crop is 0.4 middle
    ways above the second band, else 0. A way is the difference of the rows beside it; middle values are the
    upper ones of an even number. Pages with one band or none give no crop.
    """
    every = profile.groupBy(*page).agg(F.max(height).alias("__h"))
    inked = profile.where(F.col("ink") > F.col(width) * 0.012)
    w = W.partitionBy(*page).orderBy("y")
    least = F.greatest(F.lit(4), F.floor(F.col(height) * 0.004))
    new = F.coalesce((F.col("y") - F.lag("y").over(w) > least).cast("int"), F.lit(1))
    bands = inked.withColumn("new", new).withColumn("band", F.sum("new").over(w)).groupBy(*page, "band").agg(F.min("y").alias("y0"), F.max("y").alias("y1"))
    gathered = bands.groupBy(*page).agg(F.sort_array(F.collect_list(F.struct("y0", "y1"))).alias("b")).where(F.size("b") >= 2)
    middle = lambda a: F.element_at(F.sort_array(a), (F.floor(F.size(a) / 2) + 1).cast("int"))
    heights = F.transform("b", lambda x: x["y1"] - x["y0"] + 1)
    ways = F.transform(F.sequence(F.lit(1), F.size("b") - 1), lambda k: F.element_at("b", k + 1)["y0"] - F.element_at("b", k)["y1"])
    first, second = F.col("b")[0], F.col("b")[1]
    head = (first["y0"] < F.col("__h") * HEAD_ZONE) & (heights[0] <= middle(heights) * HEAD_LINES) & (ways[0] >= middle(ways) * HEAD_GAP) & (ways[0] > middle(heights) * 0.5)
    crop = F.greatest(second["y0"] - F.floor(middle(ways) * 0.4), F.lit(0))
    cut = every.join(gathered, page, "left")
    return cut.select(*page, F.when(head, crop).otherwise(0).cast("int").alias("crop_y"))
