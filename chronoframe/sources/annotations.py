"""Box annotations (S09, X19): text lines ``class xc yc w h`` relative to the image, joined to the image
sizes, become absolute boxes and 4-corner polygons; images with a bad line or no size go to a fail table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_box_lines(lines: DataFrame, stem: str = "stem", line: str = "line") -> DataFrame:
    """Split each line into ``class_id, xc, yc, w, h`` (``try_cast``; ``_ok`` = five valid numbers)."""
    t = F.split(F.trim(F.col(line)), r"\s+")
    vals = [F.try_element_at(t, F.lit(i + 1)) for i in range(5)]
    out = lines.select(stem, "line_no" if "line_no" in lines.columns else F.lit(None).alias("line_no"),
                       vals[0].try_cast("int").alias("class_id"),
                       *[v.try_cast("double").alias(n) for v, n in zip(vals[1:], ("xc", "yc", "w", "h"))],
                       F.size(t).alias("_nt"))
    ok = (F.col("_nt") == 5) & F.col("class_id").isNotNull() & F.col("xc").isNotNull() & F.col("yc").isNotNull() \
        & F.col("w").isNotNull() & F.col("h").isNotNull()
    return out.withColumn("_ok", ok).drop("_nt")


def yolo_to_abs(lines: DataFrame, images: DataFrame, stem: str = "stem") -> tuple[DataFrame, DataFrame]:
    """S09 + X19: absolute boxes ``(stem, class_id, xmin, ymin, xmax, ymax, poly)`` and failed images.

    ``w = int(w_rel·W)``, ``h = int(h_rel·H)``, ``xmin = int(xc·W − w/2)``, ``ymin = int(yc·H − h/2)``,
    ``xmax = xmin + w``, ``ymax = ymin + h`` (int truncates toward zero); the polygon is the four corners
    clockwise from the top left.  An image fails as a whole when any of its lines is bad or its size is
    unknown (as the reference skips the whole record).
    """
    p = parse_box_lines(lines, stem).join(images.select(stem, "height", "width"), stem, "left")
    p = p.withColumn("_ok", F.col("_ok") & F.col("width").isNotNull() & F.col("height").isNotNull())
    bad = p.groupBy(stem).agg(F.bool_and("_ok").alias("_all_ok")).where(~F.col("_all_ok")).select(stem)
    good = p.join(bad, stem, "left_anti")
    w = (F.col("w") * F.col("width")).cast("int")
    h = (F.col("h") * F.col("height")).cast("int")
    xmin = (F.col("xc") * F.col("width") - w / 2).cast("int")
    ymin = (F.col("yc") * F.col("height") - h / 2).cast("int")
    boxes = good.select(stem, "line_no", "class_id", xmin.alias("xmin"), ymin.alias("ymin"),
                        (xmin + w).alias("xmax"), (ymin + h).alias("ymax"))
    boxes = boxes.withColumn("poly", F.array("xmin", "ymin", "xmax", "ymin", "xmax", "ymax", "xmin", "ymax"))
    return boxes, bad


def annotation_records(boxes: DataFrame, images: DataFrame, stem: str = "stem") -> DataFrame:
    """The nested record per image: ``file, height, width, annotations ARRAY<STRUCT<bbox, segmentation,
    category_id, iscrowd>>`` – one image's boxes per group, bounded by the image's annotation file."""
    ann = F.struct(F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"), F.array("poly").alias("segmentation"),
                   F.col("class_id").alias("category_id"), F.lit(0).alias("iscrowd"))
    per = boxes.groupBy(stem).agg(F.collect_list(ann).alias("annotations"))
    return images.join(per, stem)
