"""Boxes of the fold and the running title at the edges of a page, by place, wording and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweave.operators.metrics import rank_value

# Fixed values of the decision.
LEFT, LEFT_SINGLE, RIGHT, SOFT_RIGHT, MOST_CHARS, RATIO, CONFIDENCE = 0.15, 0.10, 0.97, 0.90, 12, 0.6, 0.75
#: A line that is nothing but a year of an era, whatever its name of two characters.
ERA_YEAR = r"^[\x{4E00}-\x{9FFF}]{2}[〇一二三四五六七八九十百元]{0,4}年$"


def _share_of(text: Column, chars: str) -> Column:
    return F.when(F.length(text) > 0, (F.length(text) - F.length(F.translate(text, chars, ""))) / F.length(text)).otherwise(0.0)


def edge_boxes(boxes: DataFrame, volume: str, title: str, fold: str) -> DataFrame:
    """``boxes`` with dropped (boolean) and the volume's edge: two outputs are this filter and its negation.

    The edge is the 95th-percentile right side of the volume's boxes. Empty, long and era-year texts are kept;
    a missing confidence counts as 1.0. Boxes that are not whole are kept.
    """
    right = boxes.select(volume, F.when(F.size("bbox") == 4, F.try_element_at("bbox", F.lit(3))).alias("__x1"))
    edge = rank_value(right, [volume], "__x1", 0.95).select(volume, F.col("ranked").alias("edge"))
    text, conf = F.coalesce("sinonom", F.lit("")), F.coalesce("conf", F.lit(1.0))
    x, w = F.when(F.size("bbox") == 4, F.try_element_at("bbox", F.lit(1))), F.col("edge")
    left = x <= w * F.when(F.length(text) == 1, LEFT_SINGLE).otherwise(LEFT)
    folds = _share_of(text, fold) >= RATIO
    hit = (left & (_share_of(text, title) >= RATIO)) | ((x >= w * RIGHT) & (folds | (conf < CONFIDENCE))) | ((x >= w * SOFT_RIGHT) & folds & (conf < CONFIDENCE))
    kept = (F.length(text) == 0) | (F.length(text) > MOST_CHARS) | text.rlike(ERA_YEAR)
    return boxes.join(edge, volume, "left").withColumn("dropped", F.coalesce(~kept & hit, F.lit(False)))
