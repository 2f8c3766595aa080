"""Writers for tables as CSV or JSON, in Spark's directories or, for small results, as one file with a byte order mark."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.sources import files
from skein.sources.stage import discard

# Column orders of the written tables.
IMAGE_INDEX = ("Image_ID", "note_id", "keyword", "note_url", "title_text", "raw_text", "text_source", "publish_time_resolved", "relative_image_path", "image_path")
QUALITY = ("Image_ID", "note_id", "image_path", "passed", "image_type", "reject_reason", "confidence", "width", "height", "aspect_ratio", "duplicate_of")
ERRORS = ("Image_ID", "image_path", "error_type", "error_message")
CLEANED = ("Source_ID", "Platform", "Raw_Text", "Cleaned_Text", "Timestamp", "Data_Type")
TOKENIZED = ("Source_ID", "Platform", "Cleaned_Text", "Tokens")
SENTIMENT = ("Source_ID", "Sentiment", "Sentiment_Score", "Reason")
#: Rows that the one-file writer takes at most; larger tables are written by the executors.
SMALL_ROWS = 100_000


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mark: bool = False) -> None:
    """A directory of CSV parts with header, quotes doubled; an empty table still has its header. With `mark` each part begins with a byte order mark.

    Parts with marks are written by a data source of this library, where tasks can reach the path by themselves, and replace what is at the path.
    """
    if mark:
        discard(df.sparkSession, path)
        files.write_csv_parts(df.select(*(columns or df.columns)), path)
        return
    df.select(*(columns or df.columns)).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).json(path)


def put(spark, path: str, data: bytes) -> None:
    """Writes bytes to a file of any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_csv_file(df: DataFrame, path: str, columns: Sequence[str] | None = None, mark: bool = True, most: int = SMALL_ROWS) -> None:
    """One CSV file, with a byte order mark if asked for, of a table of at most `most` rows; a larger one is an error."""
    names = list(columns or df.columns)
    rows = df.select(*names).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows: use write_csv")
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n")
    writer.writerow(names)
    writer.writerows([["" if v is None else v for v in r] for r in rows])
    put(df.sparkSession, path, (b"\xef\xbb\xbf" if mark else b"") + text.getvalue().encode())


def write_json_row(df: DataFrame, path: str) -> None:
    """The single row of a table as one JSON file."""
    row = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).first()[0]
    put(df.sparkSession, path, json.dumps(json.loads(row), ensure_ascii=False, indent=2).encode())


def write_image_index(index: DataFrame, path: str) -> None:
    """The image index as CSV parts in its column order; an index without images is an error."""
    if index.isEmpty():
        raise ValueError("the image index is empty")
    write_csv(index, path, IMAGE_INDEX)


def write_label_files(labels: DataFrame, path: str, key: str = "Image_ID") -> int:
    """One JSON file per label, named by its key, for people and tools that want files. Returns their number.

    The executors write them, and they come into place together. Only where tasks can't reach the path by themselves rows pass the driver, one partition at a
    time. Tables of labels that jobs read again are better written with write_json.
    """
    if files.reachable(path):
        return files.write_row_files(labels, path, key)
    n = 0
    for row in labels.select(F.col(key).cast("string"), F.to_json(F.struct(*labels.columns), {"ignoreNullFields": "false"})).toLocalIterator():
        put(labels.sparkSession, f"{path}/{row[0]}.json", json.dumps(json.loads(row[1]), ensure_ascii=False, indent=2).encode())
        n += 1
    return n
