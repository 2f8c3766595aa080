"""Image quality rules on metric columns, hashes of pixels, and Arrow functions for what needs the pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the quality and landscape rules.
MIN_SIDE = 300
MAX_ASPECT, MIN_ASPECT = 3.5, 0.25
NATURE, BLUE, GREEN, MIXED_GREEN, MIXED_BLUE, FOREGROUND = 0.82, 0.62, 0.62, 0.50, 0.25, 0.08
PERSON_KEEP, TOTAL_PERSON_KEEP, GROUP_KEEP = 0.12, 0.12, 3
SMALL_PERSON, NO_PERSON_NATURE, SMALL_PERSON_NATURE = 0.055, 0.35, 0.35
ANALYSIS_SIZE = 96


def average_hash(pixels: Column) -> Column:
    """64 bits of an 8 by 8 gray picture, row by row: set where a pixel is at least the mean, first pixel highest."""
    mean = F.aggregate(pixels, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(pixels)
    return F.aggregate(F.transform(pixels, lambda x: (x.cast("double") >= mean).cast("long")), F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


METRICS = ("nature", "green", "blue", "foreground", "person_count", "total_person", "max_person", "max_conf")


def landscape(nature: Column, green: Column, blue: Column, foreground: Column, person_count: Column, total_person: Column, max_person: Column) -> Column:
    """struct<is_landscape, rule>: the first of eight rules that fits. A detector that is switched off gives -1 for the persons."""
    dominant = (blue >= BLUE) | (green >= GREEN) | ((green >= MIXED_GREEN) & (blue >= MIXED_BLUE))

    def is_(yes: bool, rule: str) -> Column:
        return F.struct(F.lit(yes).alias("is_landscape"), F.lit(rule).alias("rule"))

    return (
        F.when(max_person >= PERSON_KEEP, is_(False, "not_landscape_person_subject_large_enough"))
        .when((person_count >= GROUP_KEEP) | (total_person >= TOTAL_PERSON_KEEP), is_(False, "not_landscape_people_present_as_scene_subject"))
        .when(foreground >= FOREGROUND, is_(False, "not_landscape_has_large_foreground_subject"))
        .when((person_count == 0) & (nature >= NO_PERSON_NATURE), is_(True, "landscape_no_person_nature_dominant"))
        .when((person_count > 0) & (max_person < SMALL_PERSON) & (nature >= SMALL_PERSON_NATURE), is_(True, "landscape_person_too_small_nature_dominant"))
        .when(nature < NATURE, is_(False, "not_landscape_by_color_and_subject"))
        .when(dominant, is_(True, "high_confidence_landscape_by_nature_color"))
        .otherwise(is_(False, "not_landscape_by_color_mix"))
    )


def landscape_reason(rule: Column) -> Column:
    """The rule with the metrics it was judged by."""
    return F.format_string(
        "%s: nature=%.3f, green=%.3f, blue=%.3f, foreground=%.3f, persons=%d, total_person=%.3f, max_person=%.3f, max_conf=%.3f",
        rule, *[F.col(m).cast("long") if m == "person_count" else F.col(m) for m in METRICS],
    )


def quality(with_metrics: DataFrame) -> DataFrame:
    """Adds passed, image_type, reject_reason, aspect_ratio, confidence. Columns: file_exists, decodable, width, height and METRICS."""
    w, h = F.col("width"), F.col("height")
    ratio = F.when((w > 0) & (h > 0), w / h)
    verdict = landscape(*[F.col(m) for m in METRICS[:-1]])

    def out(kind: str, reason: Column | str | None) -> Column:
        why = F.lit(None).cast("string") if reason is None else reason if isinstance(reason, Column) else F.lit(reason)
        return F.struct(F.lit(kind).alias("image_type"), why.alias("reject_reason"))

    rule = (
        F.when(~F.col("file_exists"), out("missing_file", "image_file_not_found"))
        .when(~F.col("decodable"), out("corrupted_image", "cannot_open_image"))
        .when((w <= 0) | (h <= 0), out("corrupted_image", "invalid_image_size"))
        .when((w < MIN_SIDE) | (h < MIN_SIDE), out("too_small", "image_too_small"))
        .when((ratio > MAX_ASPECT) | (ratio < MIN_ASPECT), out("bad_aspect_ratio", "abnormal_aspect_ratio"))
        .when(verdict["is_landscape"], out("landscape", landscape_reason(verdict["rule"])))
        .otherwise(out("candidate_outfit", None))
    )
    judged = with_metrics.withColumn("_rule", rule)
    passed = F.col("_rule.image_type") == "candidate_outfit"
    return judged.withColumns(
        {"passed": passed, "image_type": F.col("_rule.image_type"), "reject_reason": F.col("_rule.reject_reason"), "aspect_ratio": F.when(F.col("file_exists") & F.col("decodable"), F.round(ratio, 4)), "confidence": F.when(passed, 1.0).otherwise(0.0)}
    ).drop("_rule")


def gate_log(results: DataFrame) -> DataFrame:
    """One row: totals, counts by image type, and by reject reason, both as it stands and up to its colon."""
    def counts(rows: DataFrame, key: Column, name: str) -> DataFrame:
        return rows.groupBy(key.alias("k")).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(name))

    rejected = results.filter("NOT passed AND reject_reason IS NOT NULL AND reject_reason != ''")
    totals = results.agg(F.count("*").alias("total_images"), F.count_if(F.col("passed")).alias("passed"), F.count_if(~F.col("passed")).alias("rejected"))
    one_row = totals.crossJoin(counts(results, F.col("image_type"), "image_type_breakdown"))  # one row by one row
    one_row = one_row.crossJoin(counts(rejected, F.col("reject_reason"), "rejection_breakdown"))
    return one_row.crossJoin(counts(rejected, F.split_part("reject_reason", F.lit(":"), F.lit(1)), "rejection_kinds"))


def color_ratios(rgb: np.ndarray) -> tuple[float, float, float, float]:
    """Nature, green, blue and largest foreground component of a picture of shape (size, size, 3), values 0 to 255."""
    x = rgb.astype(float) / 255
    high, low = x.max(axis=2), x.min(axis=2)
    spread = high - low
    safe = np.where(spread == 0, 1, spread)
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    turn = np.where(high == r, ((g - b) / safe) % 6, np.where(high == g, (b - r) / safe + 2, (r - g) / safe + 4))
    hue = np.where(spread == 0, 0, turn / 6) * 179
    saturation = np.where(high == 0, 0, spread / np.where(high == 0, 1, high)) * 255
    value = high * 255
    lively = (saturation >= 40) & (value >= 40)
    green = (hue >= 35) & (hue <= 85) & lively
    blue = (hue >= 90) & (hue <= 130) & lively & ~green
    foreground = (saturation >= 50) & (value >= 35) & ~green & ~blue
    return float(green.mean() + blue.mean()), float(green.mean()), float(blue.mean()), largest_component(foreground)


def largest_component(mask: np.ndarray) -> float:
    """Share of the picture that its largest 4-connected set of true cells covers. Labels spread as minima until they rest."""
    labels = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    big = mask.size + 1
    while True:
        padded = np.pad(np.where(mask, labels, big), 1, constant_values=big)
        least = np.minimum.reduce([padded[1:-1, 1:-1], padded[:-2, 1:-1], padded[2:, 1:-1], padded[1:-1, :-2], padded[1:-1, 2:]])
        new = np.where(mask, least, 0)
        # a label is the number of a cell, whose own label may be smaller by now
        flat = np.concatenate([[0], new.ravel()])
        new = np.where(mask, flat[new], 0)
        if (new == labels).all():
            break
        labels = new
    counts = np.bincount(labels.ravel())[1:]
    return float(counts.max() / mask.size) if counts.size and mask.any() else 0.0


def pixel_metrics(images: DataFrame, decode: Callable[[bytes], np.ndarray], content_col: str = "content") -> DataFrame:
    """images with decodable, width, height, the four colour metrics and `gray8` (8 by 8 averages) from their bytes.

    `decode` gives an array (height, width, 3); what it can't read is not decodable. Pictures are shrunk by averaging cells.
    """
    schema = "decodable boolean, width int, height int, nature double, green double, blue double, foreground double, gray8 array<double>"

    def shrink(x: np.ndarray, size: int) -> np.ndarray:
        rows, columns = (np.linspace(0, n, size + 1).astype(int) for n in x.shape[:2])
        return np.stack([[x[a : max(b, a + 1), c : max(d, c + 1)].mean(axis=(0, 1)) for c, d in zip(columns[:-1], columns[1:], strict=True)] for a, b in zip(rows[:-1], rows[1:], strict=True)])

    @F.pandas_udf(schema)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [p.split(" ")[0] for p in schema.split(", ")]
        for batch in batches:
            rows = []
            for raw in batch:
                try:
                    x = decode(bytes(raw))
                    gray = shrink(x, 8) @ np.array([0.299, 0.587, 0.114])
                    rows.append((True, x.shape[1], x.shape[0], *color_ratios(shrink(x, ANALYSIS_SIZE)), gray.ravel().tolist()))
                except Exception:  # noqa: BLE001  a picture that can't be read is a result
                    rows.append((False, None, None, None, None, None, None, None))
            yield pd.DataFrame(rows, columns=names)

    return images.withColumn("_m", measure(content_col)).select(*images.columns, "_m.*")


def person_metrics(boxes: Column, image_area: Column, least: float = 0.25) -> Column:
    """struct<person_count, total_person, max_person, max_conf> of a detector's array<struct<x1, y1, x2, y2, confidence>>; null boxes mean no detector: all -1."""
    kept = F.filter(boxes, lambda b: b["confidence"] >= least)
    areas = F.transform(kept, lambda b: F.greatest(F.lit(0.0), b["x2"] - b["x1"]) * F.greatest(F.lit(0.0), b["y2"] - b["y1"]) / image_area)
    off = F.struct(F.lit(-1).alias("person_count"), *[F.lit(-1.0).alias(n) for n in METRICS[5:]])
    found = F.struct(
        F.size(kept).alias("person_count"), F.least(F.lit(1.0), F.aggregate(areas, F.lit(0.0), lambda a, x: a + x)).alias("total_person"),
        F.least(F.lit(1.0), F.coalesce(F.array_max(areas), F.lit(0.0))).alias("max_person"), F.coalesce(F.array_max(F.transform(kept, lambda b: b["confidence"])), F.lit(0.0)).alias("max_conf"),
    )
    return F.when(boxes.isNull(), off).otherwise(found)


def base64_text(content: Column) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(content), r"[\r\n]", "")
