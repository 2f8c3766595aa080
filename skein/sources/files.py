"""Files written by the executors and moved into place when all of them are complete: one per row, or CSV parts with a byte order mark.

A Python data source: tasks write into a folder of the job's own beside the target, which the commit renames, or whose files it moves if the
target is there already. A job that fails removes its folder and leaves the target as it was; a task that is tried again writes the same names again.
No row passes the driver.
"""

from __future__ import annotations

import csv
import io
import itertools
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    files: int


def reachable(path: str) -> bool:
    """Whether tasks can write to a path by themselves: a local or shared folder, or a store that pyarrow knows."""
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.options, self.job = options["path"].rstrip("/"), dict(options), uuid.uuid4().hex
        system, _, held = self._places()
        system.create_dir(held, recursive=True)  # by the driver alone: a task that outlives its job finds no place to write

    def _places(self) -> tuple[fs.FileSystem, str, str]:
        system, root = fs.FileSystem.from_uri(self.path)
        return system, root, f"{root}.__{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _, held = self._places()
        return Written(self._files(system, held, iterator))

    def commit(self, messages: list[Written | None]) -> None:
        system, root, held = self._places()
        if system.get_file_info(root).type == fs.FileType.NotFound:
            system.move(held, root)
            return
        for f in system.get_file_info(fs.FileSelector(held)):
            system.move(f.path, f"{root}/{f.base_name}")
        system.delete_dir(held)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, held = self._places()
        for wait in range(5):  # other tasks may be writing yet
            time.sleep(0.2 * wait)
            try:
                if system.get_file_info(held).type == fs.FileType.NotFound:
                    return
                system.delete_dir(held)
            except OSError:
                continue


class _RowFiles(_Writer):
    def _files(self, system: fs.FileSystem, held: str, iterator: Iterator[pa.RecordBatch]) -> int:
        n = 0
        for batch in iterator:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not name or "/" in name or "\\" in name or name in (".", ".."):
                    raise ValueError(f"no file name: {name!r}")
                with system.open_output_stream(f"{held}/{name}.json") as out:
                    out.write(json.dumps(json.loads(text), ensure_ascii=False, indent=2).encode())
                n += 1
        return n


class _CsvParts(_Writer):
    def _head(self) -> bytes:
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerow(json.loads(self.options["columns"]))
        return (b"\xef\xbb\xbf" if self.options["mark"] == "true" else b"") + text.getvalue().encode()

    def _files(self, system: fs.FileSystem, held: str, iterator: Iterator[pa.RecordBatch]) -> int:
        batches = (b for b in iterator if b.num_rows)
        if (first := next(batches, None)) is None:
            return 0
        with system.open_output_stream(f"{held}/part-{TaskContext.get().partitionId():05d}.csv") as out:
            out.write(self._head())
            for batch in itertools.chain([first], batches):
                text = io.StringIO()
                csv.writer(text, lineterminator="\n").writerows([["" if v is None else v for v in row] for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)])
                out.write(text.getvalue().encode())
        return 1

    def commit(self, messages: list[Written | None]) -> None:
        if not any(m and m.files for m in messages):  # an empty table has its header
            system, _, held = self._places()
            with system.open_output_stream(f"{held}/part-00000.csv") as out:
                out.write(self._head())
        super().commit(messages)


class RowFiles(DataSource):
    """Columns name and text (JSON): a file name.json for each row."""

    @classmethod
    def name(cls) -> str:
        return "row_files"

    def writer(self, schema, overwrite: bool) -> _RowFiles:
        return _RowFiles(self.options)


class CsvParts(DataSource):
    """A CSV part for each partition, with header and byte order mark."""

    @classmethod
    def name(cls) -> str:
        return "csv_parts"

    def writer(self, schema, overwrite: bool) -> _CsvParts:
        return _CsvParts(self.options)


def write_row_files(rows: DataFrame, path: str, key: str) -> int:
    """A JSON file {key}.json with all columns for each row; returns their number. A key that is null or no file name is an error, of repeated keys one file stays."""
    spark = rows.sparkSession
    spark.dataSource.register(RowFiles)
    seen = Observation()
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    rows.select(F.col(key).cast("string").alias("name"), text.alias("text")).observe(seen, F.count("*").alias("n")).write.format("row_files").mode("append").option("path", path).save()
    return seen.get["n"]


def write_csv_parts(rows: DataFrame, path: str, mark: bool = True) -> None:
    """CSV parts with header in a folder, quotes doubled, each with a byte order mark if asked for. Values are written as Spark's casts to text have them."""
    spark = rows.sparkSession
    spark.dataSource.register(CsvParts)
    rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns]).write.format("csv_parts").mode("append").option("path", path).option("mark", str(mark).lower()).option("columns", json.dumps(rows.columns)).save()
