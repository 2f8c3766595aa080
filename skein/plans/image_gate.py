"""The image gate: quality rules, then near-duplicates among what passed, in input order."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.images import METRICS, average_hash, gate_log, person_metrics, pixel_metrics, quality
from skein.operators.near_duplicates import gate
from skein.sources import files, sinks
from skein.sources.stage import staged


def gate_images(measured: DataFrame, distance: int = 4, pos: str = "pos") -> DataFrame:
    """Quality results of measured images, with image_hash and duplicate_of (an Image_ID). measured: pos (input order), Image_ID, the columns of `quality`, and gray8."""
    judged = staged(quality(measured).withColumn("image_hash", F.when(F.col("passed"), average_hash(F.col("gray8")))), "judged")
    passing = judged.filter("passed").select(pos, "image_hash")
    marks = gate(passing, distance, pos, "image_hash").filter("NOT accepted").select(F.col(pos).alias("dup"), "duplicate_of")
    names = judged.select(F.col(pos).alias("anchor"), F.col("Image_ID").alias("anchor_id"))
    found = marks.join(names, marks["duplicate_of"] == names["anchor"]).select("dup", "anchor_id")
    joined = judged.join(found, judged[pos] == found["dup"], "left")
    is_dup = F.col("dup").isNotNull()
    return joined.withColumns(
        {
            "passed": F.col("passed") & ~is_dup, "image_type": F.when(is_dup, "duplicate").otherwise(F.col("image_type")), "reject_reason": F.when(is_dup, "near_duplicate_image").otherwise(F.col("reject_reason")),
            "confidence": F.when(is_dup, 0.0).otherwise(F.col("confidence")), "duplicate_of": F.coalesce("anchor_id", F.lit("")),
        }
    ).drop("dup", "anchor_id")


def measure(records: DataFrame, files: DataFrame, decode: Callable[[bytes], np.ndarray], boxes: DataFrame | None = None) -> DataFrame:
    """Image records with what the rules need. files: image_path, content. boxes: image_path and the detector's boxes; without it there is no detector.

    Only files that records name are decoded, and missing files are known without decoding anything.
    """
    named = files.join(records.select("image_path").distinct(), "image_path", "left_semi")
    pixels = pixel_metrics(named.select("image_path", "content"), decode).drop("content").withColumn("file_exists", F.lit(True))
    joined = records.join(pixels, "image_path", "left")
    if boxes is not None:
        seen = boxes.groupBy("image_path").agg(F.flatten(F.collect_list("boxes")).alias("boxes"))
        joined = joined.join(seen, "image_path", "left").withColumn("boxes", F.coalesce("boxes", F.array().cast(seen.schema["boxes"].dataType)))
        people = person_metrics(F.col("boxes"), F.col("width") * F.col("height"))
    else:
        people = F.struct(F.lit(-1).alias("person_count"), *[F.lit(-1.0).alias(n) for n in METRICS[5:]])
    with_people = joined.withColumn("_p", people)
    return with_people.withColumns({"file_exists": F.coalesce("file_exists", F.lit(False)), "decodable": F.coalesce("decodable", F.lit(False)), **{n: F.col(f"_p.{n}") for n in METRICS[4:]}}).drop("_p", "boxes")


def write(results: DataFrame, path: str) -> None:
    sinks.write_csv(results, f"{path}/quality_filtered_images", sinks.QUALITY, mark=files.reachable(path))
    sinks.write_json_row(gate_log(results), f"{path}/quality_filter_log.json")
