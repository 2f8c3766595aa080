"""Readers for note, review, video and master files, danmaku XML, images and labels, with fixed schemas."""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.text import first_nonblank, first_truthy, safe_text, strip
from skein.functions.urls import normalize_path
from skein.sources.json_arrays import array_elements

NOTE = (
    "keyword string, note_id string, note_url string, share_url string, xsec_token string, can_open_in_web boolean, title_text string, raw_text string, text_source string, "
    "image_urls array<string>, downloaded_image_paths array<string>, publish_timestamp string, publish_time_text string, publish_time_resolved string"
)
_REVIEW = "platform: string, query: string, product_id: string, product_name: string, score: string, content: string, creation_time: string, product_color: string, product_size: string"
REVIEW_FILE = f"summary struct<total_reviews: bigint, by_brand: map<string, bigint>>, reviews array<struct<{_REVIEW}>>"
_MARK = "keyword: string, bvid: string, video_title: string, text: string, is_pain_point: boolean"
VIDEO_FILE = (
    "summary struct<total_danmaku: bigint, pain_point_danmaku: bigint, total_comments: bigint, pain_point_comments: bigint>, pain_point_keywords array<string>, "
    f"all_danmaku array<struct<{_MARK}>>, pain_point_danmaku array<struct<{_MARK}>>, all_comments array<struct<{_MARK}, like_count: bigint>>, high_like_pain_comments array<struct<{_MARK}, like_count: bigint>>"
)
LABEL = (
    "Image_ID string, note_id string, image_path string, Curation_Status string, Image_Category string, Reject_Reason string, Body_Coverage string, Text_Overlay_Level string, Outfit_Count bigint, "
    "Main_Subject_Visibility string, Pockets bigint, Zipper_Type string, Fit string, Reflective boolean, Primary_Color string, Secondary_Color string, Material_Clue array<string>, Scenario string, Visual_Weight string, "
    "Gorpcore_Relevance double, Confidence double, raw_model_output string"
)
#: Names under which a master table may carry each field, best first.
MASTER = {
    "Source_ID": ("source_id", "id", "record_id"), "Platform": ("platform",), "Raw_Text": ("raw_text", "text", "content", "body"),
    "Timestamp": ("timestamp", "time", "publish_time", "creation_time"), "Data_Type": ("data_type", "type"),
}
UNIFIED = ("Source_ID", "Platform", "Raw_Text", "Timestamp", "Data_Type")
PREFIX = "GRP"
#: Bytes of a JSON file from which on it is cut by several tasks.
LARGE_FILE = 64 << 20


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(", ".join(paths))


def _files(spark: SparkSession, path: str) -> list:
    """The files at a path, in a folder, or that a pattern matches, but for hidden ones. A missing one raises FileNotFoundError."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(fs.globStatus(p) or [])
    if not found:
        raise FileNotFoundError(path)
    each = [x for f in found for x in (fs.listStatus(f.getPath()) if f.isDirectory() else [f])]
    return [f for f in each if not f.isDirectory() and f.getPath().getName()[0] not in "._"]


def _expect(spark: SparkSession, path: str, first: str, what: str) -> bool:
    """Whether a file is so large that it is read by ranges. A missing file raises FileNotFoundError, one that begins with another character ValueError.

    Of each file the first bytes are read; that a large one begins rightly is found where it is cut.
    """
    files = _files(spark, path)
    if any(f.getLen() > LARGE_FILE for f in files):
        return True
    for f in files:
        stream = f.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).open(f.getPath())
        try:
            c = stream.read()
            while c in (0x20, 0x09, 0x0A, 0x0D, 0xEF, 0xBB, 0xBF):
                c = stream.read()
        finally:
            stream.close()
        if c >= 0 and chr(c) != first:
            raise ValueError(f"{f.getPath().toString()}: {what} is expected")
    return False


def _elements(spark: SparkSession, path: str, schema: str, key: str | None = None, strict: bool = True) -> DataFrame:
    """file, pos and the fields of each element of the files' arrays."""
    return array_elements(spark, path, key, strict).select("file", F.col("pos").cast("int").alias("pos"), F.from_json("value", schema).alias("r")).select("file", "pos", "r.*")


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of notes, a row each. A missing file raises FileNotFoundError, a file whose top level is no array ValueError.

    Files of over LARGE_FILE bytes are cut into their elements by many tasks, others are read by one task each.
    """
    if _expect(spark, path, "[", "an array of notes"):
        return _elements(spark, path, NOTE).drop("file", "pos")
    return spark.read.schema(NOTE).option("multiLine", True).json(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """file, pos (from 0) and the fields of each review; a file that is no object has none."""
    if any(f.getLen() > LARGE_FILE for f in _files(spark, path)):
        return _elements(spark, path, f"struct<{_REVIEW}>", "reviews", strict=False)
    return spark.read.schema(REVIEW_FILE).option("multiLine", True).json(path).select(F.input_file_name().alias("file"), F.posexplode("reviews").alias("pos", "r")).select("file", "pos", "r.*")


def read_videos(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(danmaku, comments), each with file and pos. A missing file raises FileNotFoundError, a file whose top level is no object ValueError."""
    if _expect(spark, path, "{", "an object with the lists of a video file"):
        return _elements(spark, path, f"struct<{_MARK}>", "all_danmaku"), _elements(spark, path, f"struct<{_MARK}, like_count: bigint>", "all_comments")
    files = spark.read.schema(VIDEO_FILE).option("multiLine", True).json(path).withColumn("file", F.input_file_name())
    return tuple(files.select("file", F.posexplode(c).alias("pos", "r")).select("file", "pos", "r.*") for c in ("all_danmaku", "all_comments"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with header, quotes doubled inside quotes, line ends inside quotes, all columns text. A byte order mark is skipped."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def column_key(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def pick(df: DataFrame, names: Sequence[str], default: Column | str = "") -> Column:
    """The first non-blank of the columns whose normalized names are given."""
    by_key = {column_key(c): c for c in reversed(df.columns)}
    found = [F.nullif(strip(F.col(f"`{by_key[n]}`").cast("string")), F.lit("")) for n in names if n in by_key]
    return F.coalesce(*found, default if isinstance(default, Column) else F.lit(default))


def unify_master(df: DataFrame, pos: Column, prefix: str = PREFIX) -> DataFrame:
    """Unified records of a master table; pos counts its rows from 0, blank ones too."""
    fallback = F.format_string(f"{prefix}-MASTER-%06d", pos + 1)
    fields = {k: pick(df, names, fallback if k == "Source_ID" else "") for k, names in MASTER.items()}
    fields["Platform"] = pick(df, MASTER["Platform"], "unknown")
    fields["Data_Type"] = pick(df, MASTER["Data_Type"], "text")
    return df.select(*[c.alias(k) for k, c in fields.items()]).filter("Raw_Text != ''")


def unify_notes(notes: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Title and body in one text, unless the body repeats the title. Null titles are empty."""
    title, body = safe_text(F.col("title_text")), safe_text(F.col("raw_text"))
    text = F.concat_ws("\n", F.nullif(title, F.lit("")), F.when((body != "") & (body != title), body))
    key = first_nonblank(F.col("note_id"), F.lit("unknown_note"))
    time = first_truthy(F.col("publish_time_resolved"), F.col("publish_time_text"), F.col("publish_timestamp"))
    return notes.select(F.concat(F.lit(f"{prefix}-XHS-"), key).alias("Source_ID"), F.lit("xiaohongshu").alias("Platform"), text.alias("Raw_Text"), time.alias("Timestamp"), F.lit("note").alias("Data_Type")).filter("Raw_Text != ''")


def unify_reviews(reviews: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Reviews with text; ids count all reviews of a file, so that blank ones leave gaps."""
    key = first_nonblank(F.col("product_id"), F.lit("unknown_product"))
    return reviews.select(F.format_string(f"{prefix}-TB-%s-%04d", key, F.col("pos") + 1).alias("Source_ID"), F.lit("taobao").alias("Platform"), safe_text(F.col("content")).alias("Raw_Text"), safe_text(F.col("creation_time")).alias("Timestamp"), F.lit("review").alias("Data_Type")).filter("Raw_Text != ''")


def unify_videos(danmaku: DataFrame, comments: DataFrame, prefix: str = PREFIX) -> DataFrame:
    def part(rows: DataFrame, mark: str, kind: str) -> DataFrame:
        key = first_nonblank(F.col("bvid"), F.lit("unknown_bvid"))
        return rows.select(F.format_string(f"{prefix}-BILI-{mark}-%s-%06d", key, F.col("pos") + 1).alias("Source_ID"), F.lit("bilibili").alias("Platform"), safe_text(F.col("text")).alias("Raw_Text"), F.lit("").alias("Timestamp"), F.lit(kind).alias("Data_Type")).filter("Raw_Text != ''")

    return part(danmaku, "DM", "danmaku").unionByName(part(comments, "CM", "comment"))


def unified_records(spark: SparkSession, paths: Mapping[str, str], prefix: str = PREFIX) -> DataFrame:
    """The master table alone if it exists, else all of notes, reviews and videos that exist; nothing is an error. Adds src_ord, the place in that order."""
    if paths.get("master") and exists(spark, paths["master"]):
        rows = read_csv(spark, paths["master"]).withColumn("_pos", F.monotonically_increasing_id())  # a column of its own, so that every row counts
        return unify_master(rows, F.col("_pos"), prefix).withColumn("src_ord", F.lit(0))
    found = []
    for k, name in enumerate(("notes", "reviews", "videos")):
        if paths.get(name) and exists(spark, paths[name]):
            part = unify_notes(read_notes(spark, paths[name]), prefix) if name == "notes" else unify_reviews(read_reviews(spark, paths[name]), prefix) if name == "reviews" else unify_videos(*read_videos(spark, paths[name]), prefix)
            found.append(part.withColumn("src_ord", F.lit(k)))
    if not found:
        raise FileNotFoundError("no source of texts exists")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def image_records(notes: DataFrame, base: str, prefix: str = PREFIX) -> DataFrame:
    """A row for each downloaded image of each note. The image's number counts blank paths too; notes without a list give none."""
    key = first_nonblank(F.col("note_id"), F.lit("unknown_note"))
    each = notes.select("*", F.posexplode("downloaded_image_paths").alias("pos", "path")).filter(F.coalesce(F.col("path"), F.lit("")) != "")
    text = {c: safe_text(F.col(c)) for c in ("keyword", "note_url", "title_text", "raw_text", "text_source", "publish_timestamp", "publish_time_text", "publish_time_resolved")}
    return each.select(F.format_string(f"{prefix}-XHS-%s-%02d", key, F.col("pos") + 1).alias("Image_ID"), key.alias("note_id"), *[c.alias(n) for n, c in text.items()], F.regexp_replace(strip(F.col("path")), r"\\", "/").alias("relative_image_path"), normalize_path(base, F.col("path")).alias("image_path"))


def passed_images(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a written quality result whose passed says true in any case."""
    return read_csv(spark, path).filter(F.lower(F.trim("passed")) == "true")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Stored labels of any version, fields they lack as null; files that are no JSON give no row."""
    return spark.read.schema(LABEL).option("multiLine", True).option("mode", "PERMISSIVE").json(path).filter("Image_ID IS NOT NULL")


def image_files(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """image_path (without a file: scheme) and length of the files under path, and their bytes if asked for."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.regexp_replace("path", "^file:/*", "/").alias("image_path"), "length", *(["content"] if content else []))


def danmaku_texts(xml: Column) -> Column:
    """The stripped texts of the direct children d of the root, empty ones left out; null where the text is no XML."""
    safe = F.regexp_replace(xml, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    return F.filter(F.transform(F.xpath(safe, F.lit("/*/d/text()")), lambda t: strip(t)), lambda t: t != "")


def read_danmaku(files: DataFrame, content_col: str = "content", keep: Sequence[str] = ("path",)) -> DataFrame:
    """(kept columns, pos, text) of danmaku XML in bytes, gzipped or not. Bytes that are no XML give no rows."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        from xml.etree import ElementTree

        for batch in batches:
            for row, raw in enumerate(batch.column(len(names)).to_pylist()):
                try:
                    data = gzip.decompress(raw) if (raw or b"")[:2] == b"\x1f\x8b" else raw or b""
                    root = ElementTree.fromstring(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", data.decode("utf-8", "ignore")))
                    texts = [t.strip() for d in root.findall("d") if (t := d.text)]
                except (ElementTree.ParseError, OSError, EOFError):
                    continue
                own = batch.slice(row, 1).select(range(len(names))).take(pa.array([0] * len(texts), pa.int64()))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(range(len(texts)), pa.int32()), pa.array(texts, pa.string())], [*names, "pos", "text"])

    read = files.select(*names, content_col)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(run, f"{ddl}, pos int, text string")
