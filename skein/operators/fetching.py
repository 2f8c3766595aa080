"""Fetching with functions that the caller gives: pages until an empty one, and images to files. Nothing here opens a connection."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.urls import EXTENSIONS, MEDIA_EXTENSIONS, sanitize_filename

# Parts of messages after which another try may help, and where responses carry their comments, best first.
RETRYABLE_PAGE = ("Timeout", "net::", "Navigation failed", "Target closed", "Execution context was destroyed")
RETRYABLE_RESPONSE = ("COLLECT FAILED", "RATE", "TIMEOUT")
NESTED_COMMENTS = ("$.model.commentList", "$.model.comments", "$.model.reviews", "$.model.list", "$.comments", "$.list", "$")
PLAIN_COMMENTS = ("$", "$.comments", "$.list")
TRIES = 3


def is_retryable(message: Column, marks: Sequence[str] = RETRYABLE_PAGE, ignore_case: bool = False) -> Column:
    """Whether an error's message has a mark of those after which another try may help. Null has none."""
    said = F.coalesce(F.upper(message) if ignore_case else message, F.lit(""))
    found = F.lit(False)
    for mark in marks:
        found = found | F.contains(said, F.lit(mark.upper() if ignore_case else mark))
    return found


def _first_list(payload: str, paths: Sequence[str]) -> list:
    """The first of the paths, such as $.a.b, at which a JSON text has a list that is not empty."""
    root = json.loads(payload)
    for path in paths:
        value = root
        for name in path.split(".")[1:]:
            value = value.get(name) if isinstance(value, dict) else None
        if isinstance(value, list) and value:
            return value
    return []


def tried(operation: Callable[[], object], tries: int, wait: float, again: Callable[[Exception], bool], sleep: Callable[[float], None] = time.sleep) -> object:
    """The operation's result, tried again after errors that `again` allows; waits grow with each try. The last error is raised."""
    for attempt in range(1, tries + 1):
        try:
            return operation()
        except Exception as e:
            if attempt == tries or not again(e):
                raise
            sleep(wait * attempt)
    raise ValueError("tries")


def fetch_pages(
    items: DataFrame, client: Callable[[], Callable[[str, int], str]], key: str = "item_id", first: int = 1, most: int = 10, paths: Sequence[str] = NESTED_COMMENTS, tries: int = TRIES, wait: float = 1.5, marks: Sequence[str] = RETRYABLE_RESPONSE
) -> DataFrame:
    """(key, page, payload, error_message): the pages of each item from `first` on, at most `most`, up to one without a list or an error.

    `client` makes, once per task, the function from an item and a page number to the response's JSON text; it raises where the service fails. Any
    error is tried again if its message has one of the marks, in any case. An item's failure is its last row, with a message and
    without a payload, and never the job's. Items are fetched side by side, pages of an item one after another. Feed the rows to pages.item_rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = client()
        for batch in batches:
            for item in batch.column(0).to_pylist():
                rows: list[tuple[str, int, str | None, str | None]] = []
                for page in range(first, first + most):
                    try:
                        payload = tried(lambda item=item, page=page: ask(item, page), tries, wait, lambda e: any(m in str(e).upper() for m in marks))
                        if not _first_list(payload, paths):
                            break
                        rows.append((item, page, payload, None))
                    except Exception as e:  # noqa: BLE001  whatever a client raises belongs to its item
                        rows.append((item, page, None, f"{type(e).__name__}: {e}"))
                        break
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], [key, "page", "payload", "error_message"])

    read = items.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct()
    return read.mapInArrow(run, f"`{key}` string, page int, payload string, error_message string")


def image_targets(notes: DataFrame, base: str, most: int) -> DataFrame:
    """note_id, number from 1, url and stem, the path without suffix, of the first `most` images of each note: base/keyword/note/image_01."""
    keyword = sanitize_filename(F.coalesce(F.nullif(F.regexp_replace(F.coalesce("keyword", F.lit("")), "^#+", ""), F.lit("")), F.lit("keyword")))
    name = sanitize_filename(F.coalesce(F.nullif("note_id", F.lit("")), F.nullif("title_text", F.lit("")), F.lit("note")))
    each = notes.select("note_id", keyword.alias("k"), name.alias("n"), F.posexplode(F.slice("image_urls", 1, most)).alias("pos", "url"))
    return each.select("note_id", (F.col("pos") + 1).alias("number"), "url", F.concat(F.lit(f"{base.rstrip('/')}/"), "k", F.lit("/"), "n", F.lit("/"), F.format_string("image_%02d", F.col("pos") + 1)).alias("stem"))


def download_images(targets: DataFrame, fetch: Callable[[], Callable[[str], tuple[bytes, str | None]]], save: Callable[[], Callable[[str, bytes], None]], tries: int = TRIES, wait: float = 1.0) -> DataFrame:
    """targets with `path`, where the image was saved, null where it could not be fetched or saved.

    `fetch` and `save` make, once per task, the functions from an address to bytes and media type, and from a path and bytes to nothing. The suffix
    comes from the address, else from the media type. Saving the same path again must be harmless, as tasks may run twice.
    """
    kept = targets.columns
    at = kept.index("url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, put = fetch(), save()

        def one(url: str, stem: str) -> str | None:
            try:
                content, kind = tried(lambda: get(url), tries, wait, lambda e: True)
                path = stem + suffix(url, kind)
                put(path, content)
            except Exception:  # noqa: BLE001  an image that can't be had is a row without path
                return None
            return path

        for batch in batches:
            paths = [one(url, stem) for url, stem in zip(batch.column(at).to_pylist(), batch.column(kept.index("stem")).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.string())], [*kept, "path"])

    def suffix(url: str, kind: str | None) -> str:
        return next((e for e in EXTENSIONS if e in url.lower()), MEDIA_EXTENSIONS.get((kind or "").split(";")[0].strip(), ".jpg"))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in targets.schema.fields)
    return targets.mapInArrow(run, f"{ddl}, path string")


def downloaded_paths(notes: DataFrame, downloads: DataFrame) -> DataFrame:
    """notes with downloaded_image_paths: the paths of what was saved, in order."""
    got = downloads.filter("path IS NOT NULL").groupBy(F.col("note_id").alias("of")).agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "path"))), lambda x: x["path"]).alias("paths"))
    joined = notes.join(got, F.col("note_id") == F.col("of"), "left")
    return joined.select(*[F.coalesce("paths", F.array().cast("array<string>")).alias(c) if c == "downloaded_image_paths" else F.col(c) for c in notes.columns])
