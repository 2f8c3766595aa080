"""Normalizing what a vision model says about an image, and keeping the books of an annotation run.

The raw label is a VARIANT (parse_json of the model's text), so that any type may stand in any field.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import computed, strip
from skein.sources.readers import exists
from skein.sources.stage import discard, fresh_path, staged

# The allowed values of each enumerated field, and its default.
ENUMS: dict[str, tuple[tuple[str, ...], str]] = {
    "Curation_Status": (("use", "reject", "review"), "review"),
    "Image_Category": (("full_body_outfit", "half_body_outfit", "detail_closeup", "multi_panel_outfit", "text_overlay_outfit", "product_marketing", "landscape", "text_screenshot", "unrelated", "unclear"), "unclear"),
    "Reject_Reason": (("none", "no_visible_outfit", "pure_landscape", "text_dominant", "product_only", "unrelated", "too_unclear"), "none"),
    "Body_Coverage": (("full_body", "upper_body", "lower_body", "partial_detail", "multiple", "none", "unclear"), "unclear"),
    "Text_Overlay_Level": (("none", "low", "medium", "high"), "none"),
    "Main_Subject_Visibility": (("clear", "partial", "small", "unclear", "none"), "unclear"),
    "Zipper_Type": (("Sealed", "Exposed", "None", "Unclear"), "Unclear"),
    "Fit": (("Loose", "Regular", "Tight", "Oversized", "Cropped", "Unclear"), "Unclear"),
    "Scenario": (("Urban_Commute", "Outdoor", "Office", "Fashion_Street", "Sports", "Unclear"), "Unclear"),
    "Visual_Weight": (("lightweight", "medium", "heavyweight", "unclear"), "unclear"),
}
TRUE_WORDS = ("true", "yes", "1", "visible")
RELEVANCE = "Gorpcore_Relevance"
MOST_CLUES = 4
SKIPPED, MISSING = "skipped_existing", "missing_file"
#: Images that are asked for between two commits of the answer log.
WAVE_ROWS = 10_000
ANSWER = "Image_ID string, attempt int, raw_model_output string, error_type string, error_message string"


def normalize_enum(value: Column, allowed: Sequence[str], default: Column | str) -> Column:
    """The stripped value if it is one of those allowed, case counts, else the default."""
    return _allowed(strip(value), allowed, default)


def _allowed(v: Column, allowed: Sequence[str], default: Column | str) -> Column:
    return F.when(v.isin(*allowed), v).otherwise(default if isinstance(default, Column) else F.lit(default))


def normalize_bool(value: Column) -> Column:
    return F.coalesce(F.lower(strip(value)).isin(*TRUE_WORDS), F.lit(False))


def normalize_int(value: Column, default: int = 0, minimum: int = 0) -> Column:
    """Whole numbers from text, fractions of JSON numbers cut off, not below the minimum."""
    return F.greatest(F.lit(minimum).cast("long"), F.coalesce(strip(value).try_cast("long"), F.lit(default).cast("long")))


def clamp(value: Column, default: float = 0.0) -> Column:
    """A number between 0 and 1. NaN passes."""
    n = F.coalesce(strip(value).try_cast("double"), F.lit(default))
    return F.when(F.isnan(n), n).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), n)))


def normalize_clues(clue: Column) -> Column:
    """Up to four stripped, non-blank strings of a list, or a single string, given as a variant; ["unclear"] if there are none."""
    listed = F.try_variant_get(clue, "$", "array<string>")
    single = F.when(F.schema_of_variant(clue) == "STRING", F.array(clue.cast("string")))
    cleaned = F.filter(F.transform(F.coalesce(listed, single, F.array().cast("array<string>")), lambda x: strip(F.coalesce(x, F.lit("None")))), lambda x: x != "")
    return F.when(F.size(cleaned) > 0, F.slice(cleaned, 1, MOST_CLUES)).otherwise(F.array(F.lit("unclear")))


def normalize_labels(labels: DataFrame, raw_col: str = "raw_model_output", keep: Sequence[str] = ("Image_ID", "note_id", "image_path"), relevance: str = RELEVANCE) -> DataFrame:
    """The kept columns and every normalized field. raw_col is JSON text; text that is no JSON object counts as one without fields.

    A missing zipper type becomes "None", one of its allowed values, as text made of nothing reads so; a null color takes the
    default. A rejected image without a reason is too unclear.
    """
    texts = (*ENUMS, "Outfit_Count", "Pockets", "Reflective", "Primary_Color", "Secondary_Color", relevance, "Confidence")
    parsed = computed(labels, _raw=F.try_parse_json(raw_col))
    read = {"_said": F.try_variant_get("_raw", "$", f"struct<{', '.join(f'`{c}`: string' for c in texts)}>"), "_clue": F.try_variant_get("_raw", "$.Material_Clue", "variant")}
    parsed = computed(parsed, **read, **{f"_{c}": F.try_variant_get("_raw", f"$.{c}", "long") for c in ("Outfit_Count", "Pockets")})

    # Each text is stripped once.
    stripped = (*ENUMS, "Primary_Color", "Secondary_Color")
    parsed = computed(parsed, _bare=F.struct(*[strip(F.col("_said")[c]).alias(c) for c in stripped]))

    def text(name: str) -> Column:
        return F.col("_bare" if name in stripped else "_said")[name]

    status = _allowed(text("Curation_Status"), *ENUMS["Curation_Status"])
    reason = _allowed(text("Reject_Reason"), ENUMS["Reject_Reason"][0], F.when(status == "use", "none").otherwise("too_unclear"))
    plain = {c: _allowed(text(c), *ENUMS[c]).alias(c) for c in ENUMS}
    plain["Zipper_Type"] = _allowed(F.coalesce(text("Zipper_Type"), F.lit("None")), *ENUMS["Zipper_Type"]).alias("Zipper_Type")

    def color(name: str, default: str) -> Column:
        return F.coalesce(F.nullif(text(name), F.lit("")), F.lit(default)).alias(name)

    def whole(name: str) -> Column:
        return normalize_int(F.coalesce(F.col(f"_{name}").cast("string"), text(name))).alias(name)

    return parsed.select(
        *keep, status.alias("Curation_Status"), plain["Image_Category"], F.when((status == "reject") & (reason == "none"), "too_unclear").otherwise(reason).alias("Reject_Reason"),
        plain["Body_Coverage"], plain["Text_Overlay_Level"], whole("Outfit_Count"), plain["Main_Subject_Visibility"], whole("Pockets"), plain["Zipper_Type"], plain["Fit"],
        normalize_bool(text("Reflective")).alias("Reflective"), color("Primary_Color", "unclear"), color("Secondary_Color", "none"), normalize_clues(F.col("_clue")).alias("Material_Clue"),
        plain["Scenario"], plain["Visual_Weight"], clamp(text(relevance)).alias(relevance), clamp(text("Confidence")).alias("Confidence"), F.col(raw_col),
    )


def pending(images: DataFrame, labels: DataFrame, key: str = "Image_ID", limit: int | None = None) -> DataFrame:
    """The first `limit` images (all if None) that have no label yet."""
    first = images if limit is None else images.orderBy(key).limit(limit)
    return first.join(labels.select(key).distinct(), key, "left_anti")


def skipped(images: DataFrame, labels: DataFrame, key: str = "Image_ID") -> DataFrame:
    """Images that have a label."""
    return images.join(labels.select(key).distinct(), key, "left_semi")


CURATION_FIELDS = ("Curation_Status", "Image_Category", "Reject_Reason", "Body_Coverage", "Text_Overlay_Level", "Outfit_Count", "Main_Subject_Visibility")


def curation_log(runs: DataFrame, labels: DataFrame, key: str = "Image_ID", fields: Sequence[str] = (*CURATION_FIELDS, RELEVANCE, "Confidence")) -> DataFrame:
    """One row per image of the run: its keys, run_status, and the label's fields as text, blank where there is no label."""
    found = labels.select(F.col(key).alias("_key"), *[F.col(f).cast("string").alias(f"_{f}") for f in fields])
    joined = runs.join(found, F.col(key) == F.col("_key"), "left")
    return joined.select(*runs.columns, *[F.coalesce(F.col(f"_{f}"), F.lit("")).alias(f) for f in fields])


def breakdown(rows: DataFrame, column: str, default: str = "unknown") -> DataFrame:
    """Rows for each value, blanks counted under the default."""
    return rows.groupBy(F.coalesce(F.nullif(strip(F.col(column).cast("string")), F.lit("")), F.lit(default)).alias("value")).agg(F.count("*").alias("n"))


def annotation_log(log: DataFrame) -> DataFrame:
    """One row: totals by run status and the three breakdowns as maps. Reject reasons count for rejected images only."""
    totals = log.agg(F.count("*").alias("total_candidates"), *[F.count_if(F.col("run_status").isin(*s)).alias(n) for s, n in ((("annotated",), "annotated_count"), ((SKIPPED, "skipped"), "skipped_existing"), (("error", MISSING), "error_count"))])
    for name, column, rows in (("curation_status_breakdown", "Curation_Status", log), ("image_category_breakdown", "Image_Category", log), ("reject_reason_breakdown", "Reject_Reason", log.filter("Curation_Status = 'reject'"))):
        totals = totals.crossJoin(breakdown(rows, column).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias(name)))  # one row by one row
    return totals


def annotate(images: DataFrame, client: Callable[[], Callable[[str], str]], path_col: str = "image_path") -> DataFrame:
    """images with raw_model_output, error_type and error_message. `client` makes, once per task, the function from an image's path to the model's JSON text.

    One image's failure is that row's error and never the job's. Text that is no JSON object is an error too.
    """
    kept = images.columns
    at = kept.index(path_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        ask = client()
        for batch in batches:
            out = []
            for path in batch.column(at).to_pylist():
                try:
                    raw = ask(path)
                    if not isinstance(json.loads(raw), dict):
                        raise ValueError("the model's answer is no JSON object")
                    out.append((raw, None, None))
                except Exception as e:  # noqa: BLE001  whatever a client raises belongs to its row
                    out.append((None, type(e).__name__, str(e)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[k] for r in out], pa.string()) for k in range(3))], [*kept, "raw_model_output", "error_type", "error_message"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema.fields)
    return images.mapInArrow(run, f"{ddl}, raw_model_output string, error_type string, error_message string")


def read_answers(spark: SparkSession, log: str) -> DataFrame:
    """Every answer of the log, in any order; none where there is no log yet."""
    return spark.read.schema(ANSWER).parquet(log) if exists(spark, log) else spark.createDataFrame([], ANSWER)


def latest_answers(answers: DataFrame) -> DataFrame:
    """One row per image: its first good answer, else its last error. A repeated row of the log counts once."""
    best = F.struct(F.col("error_type").isNull().alias("good"), F.when(F.col("error_type").isNull(), -F.col("attempt")).otherwise(F.col("attempt")).alias("turn"), "attempt", "raw_model_output", "error_type", "error_message")
    return answers.groupBy("Image_ID").agg(F.max(best).alias("b")).select("Image_ID", "b.attempt", "b.raw_model_output", "b.error_type", "b.error_message")


def ask_once(images: DataFrame, log: str, client: Callable[[], Callable[[str], str]], path_col: str = "image_path", wave_rows: int = WAVE_ROWS) -> DataFrame:
    """Asks for each image without a good answer in the log, once, and appends what comes; returns the log's answers.

    Images are claimed in waves of about wave_rows, by a hash of their ids, and a wave's answers enter the log in one commit. A run that is killed loses no wave that was committed:
    the next one asks only for images that still have no good answer, as their next attempt. A task that Spark tries again asks
    again for its own images, as any answer that wasn't committed is unknown. Images with the same id are asked for once, with the smallest path;
    those without an id are left out.
    """
    spark = images.sparkSession
    answers = latest_answers(read_answers(spark, log)).select(F.col("Image_ID").alias("_id"), "attempt", (F.col("error_type").isNull()).alias("good"))
    one = images.filter("Image_ID IS NOT NULL").groupBy("Image_ID").agg(F.min(path_col).alias("image_path"))
    claims = one.join(answers, F.col("Image_ID") == F.col("_id"), "left").filter("NOT coalesce(good, false)").select("Image_ID", "image_path", (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"))
    waves = max(1, math.ceil(claims.count() / wave_rows))
    path = fresh_path(spark, "claims")
    claims.withColumn("wave", F.pmod(F.xxhash64("Image_ID"), F.lit(waves))).write.partitionBy("wave").parquet(path)
    claimed = spark.read.schema("Image_ID string, image_path string, attempt int, wave long").parquet(path)
    for wave in range(waves):
        asked = annotate(claimed.filter(F.col("wave") == wave).select("Image_ID", "image_path", "attempt"), client)
        asked.select("Image_ID", "attempt", "raw_model_output", "error_type", "error_message").write.mode("append").parquet(log)
    discard(spark, path)
    return read_answers(spark, log)


def run_annotator(
    images: DataFrame, labels: DataFrame, files: DataFrame, client: Callable[[], Callable[[str], str]], limit: int | None = None, log: str | None = None, order: Column | str | None = None, wave_rows: int = WAVE_ROWS,
) -> Mapping[str, DataFrame]:
    """Frames of one run: labels (new ones), errors, runs (image keys and run_status). `files` lists existing paths in column image_path.

    The run takes the first `limit` images by `order`, or in the order in which they are read. Images with a label are skipped, and those whose file is missing aren't asked
    for. Every other image is asked for once: answers stand in the log, from which all frames are read. log names a folder that outlives
    the run, so that a later run goes on where this one ended; without it the answers live as long as the shared folder.
    """
    spark = images.sparkSession
    keys = ("Image_ID", "note_id", "image_path")
    first = images if limit is None else images.withColumn("_at", F.monotonically_increasing_id() if order is None else F.col(order) if isinstance(order, str) else order).orderBy("_at").limit(limit).drop("_at")
    first = staged(first.select(*keys), "annotation-run")
    done = labels.select("Image_ID").distinct()
    known, todo = first.join(done, "Image_ID", "left_semi"), first.join(done, "Image_ID", "left_anti")
    paths = files.select("image_path").distinct()
    missing, there = todo.join(paths, "image_path", "left_anti"), todo.join(paths, "image_path", "left_semi")
    answers = latest_answers(ask_once(there, log or fresh_path(spark, "answers"), client, wave_rows=wave_rows))
    answered = there.join(answers, "Image_ID").select(*keys, "raw_model_output", "error_type", "error_message")
    bad, good = answered.filter("error_type IS NOT NULL"), answered.filter("error_type IS NULL")
    errors = bad.select("Image_ID", "image_path", "error_type", "error_message").unionByName(missing.select("Image_ID", "image_path", F.lit(MISSING).alias("error_type"), F.lit("image file not found").alias("error_message")))
    runs = [rows.select(*keys, F.lit(status).alias("run_status")) for rows, status in ((known, SKIPPED), (good, "annotated"), (bad, "error"), (missing, MISSING))]
    return {"labels": normalize_labels(good), "errors": errors, "runs": functools.reduce(DataFrame.unionByName, runs)}
