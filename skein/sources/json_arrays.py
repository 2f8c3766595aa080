"""Elements of large JSON arrays, read by many tasks: an array that is a file's top level, or under one key of a top-level object.

Spark's text source splits a file at byte ranges if its records end at a fixed byte, here at `}`. Whether a range begins inside a string, and how
deep in brackets, is known only from all ranges before it. So each range is scanned once under both assumptions, which gives its effect on
quotes and depth; the effects of a file's ranges, a row each, are composed in order; then each range is cut into elements from its known start.
Elements that cross ranges come as fragments, two a range at most, and only these are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.sources.stage import staged

_QUOTE, _SLASH, _COMMA, _OPEN, _CLOSE, _BRACE, _UNBRACE = (ord(c) for c in '"\\,[]{}')
_STEP = np.zeros(256, np.int64)
_STEP[[_OPEN, _BRACE]], _STEP[[_CLOSE, _UNBRACE]] = 1, -1
#: Bytes that are scanned at once.
BLOCK = 4 << 20


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, start of the byte range, and text up to the next closing brace, which is left out, in order within a range."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray, tuple]]:
    """(file, start, bytes, further columns of the first row) of rows of one range that follow one another, braces put back."""
    for batch in batches:
        files, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        values, a = batch.column(2), 0
        while a < len(files):
            b, size = a, 0
            while b < len(files) and (files[b], starts[b]) == (files[a], starts[a]) and size < BLOCK:
                size += len(values[b].as_buffer())
                b += 1
            more = tuple(batch.column(k)[a].as_py() for k in range(3, batch.num_columns))
            yield files[a], starts[a], np.frombuffer("}".join([*values.slice(a, b - a).to_pylist(), ""]).encode(), np.uint8), more
            a = b


def _outside(data: np.ndarray, quoted: int) -> tuple[np.ndarray, int]:
    """Which bytes stand outside strings, quotes aside, and whether the end lies in a string. A backslash never precedes data."""
    at = np.arange(len(data))
    plain = np.maximum.accumulate(np.where(data != _SLASH, at, -1))
    before = np.concatenate([[-1], plain[:-1]])
    quotes = (data == _QUOTE) & ((at - 1 - before) % 2 == 0)
    parity = (np.cumsum(quotes) + quoted) % 2
    return (parity == 0) & ~quotes, int(parity[-1]) if len(data) else quoted


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range, and for a start outside and inside a string: whether its end is inside one, and its change of depth; and its first character."""
    held: dict[tuple[str, int], list] = {}
    for file, start, data, _ in _blobs(batches):
        state = held.setdefault((file, start), [0, 0, 1, 0, None])
        if state[4] is None and (text := data.tobytes().lstrip(b" \t\r\n\xef\xbb\xbf")):
            state[4] = chr(text[0])
        for k in (0, 2):
            outside, state[k] = _outside(data, state[k])
            state[k + 1] += int(_STEP[data[outside]].sum())
    rows = [(f, s, *v) for (f, s), v in held.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 7
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "end0", "depth0", "end1", "depth1", "head"])


def _starts(effects: DataFrame) -> DataFrame:
    """file, start, quoted, depth at the start of each range: the effects before it composed in order, a row a range."""
    zero = F.struct(F.lit(0).cast("long").alias("quoted"), F.lit(0).cast("long").alias("depth"))

    def after(state, e):
        return F.struct(F.when(state["quoted"] == 0, e["end0"]).otherwise(e["end1"]).alias("quoted"), (state["depth"] + F.when(state["quoted"] == 0, e["depth0"]).otherwise(e["depth1"])).alias("depth"))

    before = F.collect_list(F.struct("start", "end0", "depth0", "end1", "depth1")).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return effects.select("file", "start", F.aggregate(before, zero, after).alias("s")).select("file", "start", "s.quoted", "s.depth")


def _key_before(data: np.ndarray, at: int) -> str | None:
    """The key of the value that begins at `at`, read backwards."""
    import json

    text = data[max(0, at - 4096) : at].tobytes().rstrip(b" \t\r\n")
    if not text.endswith(b":"):
        return None
    text = text[:-1].rstrip(b" \t\r\n")
    begin = text.rfind(b'"', 0, len(text) - 1)
    while begin > 0 and text[begin - 1 : begin] == b"\\":
        begin = text.rfind(b'"', 0, begin)
    try:
        return json.loads(text[begin:])
    except ValueError:
        return None


def _cutter(level: int):
    """Rows (file, start, seq, part, array, text) of ranges from their known starts.

    part: 0 an element, 1 the end of one that began before, 2 the beginning of one that goes on, 3 a range amid one. array: the key of the array in
    which a row lies, "" at the top level and for objects, null if it began in a range before; a range's last array comes as part 4.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now, state = None, None

        def ended() -> None:
            file, start = now
            quoted, depth, open_, seq, array, text = state
            if depth >= level:
                rows.append((file, start, seq, 2 if open_ else 3, array, text))
            if array is not None:
                rows.append((file, start, seq, 4, array, ""))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "start", "seq", "part", "array", "text"])
            rows.clear()
            return out

        for file, start, data, (quoted, depth) in _blobs(batches):
            if now != (file, start):
                if now:
                    ended()
                now, state = (file, start), [quoted, depth, depth < level, 0, None, ""]
            quoted, depth, open_, seq, array, held = state
            outside, quoted = _outside(data, quoted)
            step = np.where(outside, _STEP[data], 0)
            depths = depth + np.cumsum(step)
            borders = np.flatnonzero(outside & ((data == _COMMA) & (depths == level) | (step == 1) & (depths == level) | (step == -1) & (depths == level - 1)))
            at = 0
            for b in borders.tolist():
                if step[b] == 1:  # an array or object begins
                    array = (_key_before(data, b) or "" if level > 1 else "") if data[b] == _OPEN else "{"
                    open_, held, at = True, "", b + 1
                    continue
                text = held + data[at:b].tobytes().decode("utf-8", "replace")
                rows.append((file, start, seq, 0 if open_ else 1, array, text))
                seq += open_
                open_, held, at = True, "", b + 1
                if step[b] == -1:
                    open_ = False
            depth = int(depths[-1])
            if depth >= level:
                held += data[at:].tobytes().decode("utf-8", "replace")
            else:
                held = ""
            state = [quoted, depth, open_, seq, array, held]
            if sum(len(r[5]) for r in rows) > BLOCK:
                yield batch_of()
        if now:
            ended()
        yield batch_of()

    return cut


def array_elements(spark: SparkSession, path: str, key: str | None = None, strict: bool = True) -> DataFrame:
    """file, pos (from 0, in the array's order) and value, the JSON text of each element of the files' arrays.

    Without a key a file is one array; with it, an object with an array under that key, or without it, which gives no rows. A file that begins otherwise raises ValueError, or gives
    no rows if strict is false.
    Strings may hold any character; what follows the end of the top level is ignored. Files must be in UTF-8; a compressed one
    is a single range. To the driver and into a broadcast goes a row of some 50 bytes for each range that Spark makes.
    """
    pieces = _pieces(spark, path)
    effects = staged(pieces.mapInArrow(_effects, "file string, start long, end0 long, depth0 long, end1 long, depth1 long, head string"), "range-effects")
    wrong = strict and effects.filter((F.col("start") == 0) & (F.col("head") != ("[" if key is None else "{"))).select("file").first()
    if wrong:
        raise ValueError(f"{wrong.file}: {'an array' if key is None else 'an object'} is expected")
    # A broadcast join, which leaves the pieces of a range in order.
    placed = pieces.join(F.broadcast(_starts(effects)), ["file", "start"]).select("file", "start", "value", "quoted", "depth")
    rows = staged(placed.mapInArrow(_cutter(1 if key is None else 2), "file string, start long, seq long, part int, array string, text string"), "elements")
    if key is not None:
        # A range begins in the array that was the last to begin before.
        order = Window.partitionBy("file").orderBy("start")
        last = effects.select("file", "start").join(rows.filter("part = 4").select("file", "start", "array"), ["file", "start"], "left")
        came = last.select("file", "start", F.last("array", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("came"))
        rows = rows.join(F.broadcast(came), ["file", "start"]).filter(F.coalesce("array", "came") == key)
    group = F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("start", "part"))
    pieced = rows.filter("part IN (1, 2, 3)").withColumn("group", group).groupBy("file", "group").agg(
        F.min("start").alias("start"), F.max(F.when(F.col("part") == 2, F.col("seq"))).alias("seq"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part", "text"))), lambda x: x["text"]), "").alias("text")
    )
    found = rows.filter("part = 0").select("file", "start", "seq", "text").unionByName(pieced.select("file", "start", "seq", "text")).withColumn("value", F.btrim("text", F.lit(" \t\r\n"))).filter("value <> ''")
    counts = found.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = counts.select("file", "start", "first", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return found.join(F.broadcast(before), ["file", "start"]).select("file", (F.col("before") + F.col("seq") - F.col("first")).alias("pos"), "value")
