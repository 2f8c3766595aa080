"""Reassembling interleaved transactions from one log, and the shared store after every epoch of commits.

The log is range-partitioned by its order into blocks of about BLOCK_ROWS records, in the shared folder. All that a record must know of
others is a window inside its block, completed by a carry from the blocks before it or behind it: how often its stream has ended a
transaction (its transaction's number), how many savepoints are open (its level), the next rollback that takes its level
back, and its transaction's end. Carries come from summaries of a row per stream and block, combined by `exclusive_scan`,
a parallel prefix with a fan-out of FAN_OUT: no window ever holds more than a block or FAN_OUT summaries, however long one stream,
one transaction or one key is.

Survivors are reduced to the last writer of a key in an epoch, then to last-writer-wins maps per block of EPOCHS epochs. A parallel prefix over
these maps gives the state at each block's start of every key that the block writes, the block's checkpoint; from there all blocks are
replayed concurrently, and a prefix over the epochs sums their differences.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.storage import staged

#: Records of a block of the log, on average; epochs of a block of the replay; summaries that one window combines.
BLOCK_ROWS, EPOCHS, FAN_OUT = 100_000, 256, 256

COMMIT, ABORT, SAVEPOINT, ROLLBACK, CHANGE = "commit", "abort", "savepoint", "rollback", "change"

_FOLDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


@dataclass(frozen=True)
class Resolved:
    """The changes of a log and what became of them, and how many commits the log has."""

    changes: DataFrame
    commits: int


def exclusive_scan(df: DataFrame, keys: Sequence[str], index: str, folds: Mapping[str, tuple[str, str]], size: int, later: bool = False, fan_out: int = FAN_OUT) -> DataFrame:
    """df with a column for each of folds, {name: (column, sum, min or max)}: the fold over the rows of the same keys with a smaller index.

    Nulls don't count, and a fold over nothing is null. The index is a long from 0 below `size`; keys and index name at most one row, and
    keys are never null. later: over larger indexes instead. Where size is above fan_out, fan_out indexes form a group,
    groups are scanned in the same way, and each row adds its group's result: windows of at most fan_out rows.
    """
    order = F.desc(index) if later else F.asc(index)

    def over(*by: str | Column) -> dict[str, Column]:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return {name: _FOLDS[how][0](F.col(column)).over(window) for name, (column, how) in folds.items()}

    if size <= fan_out:
        return df.withColumns(over(*(keys or [F.lit(0)])))
    group = f"{index}_group"
    grouped = staged(df, "summaries").withColumn(group, F.floor(F.col(index) / fan_out))
    whole = grouped.groupBy(*keys, group).agg(*[_FOLDS[how][0](F.col(column)).alias(f"scan_{name}") for name, (column, how) in folds.items()])
    before = exclusive_scan(whole, keys, group, {f"scan_before_{name}": (f"scan_{name}", how) for name, (_, how) in folds.items()}, math.ceil(size / fan_out), later, fan_out)
    joined = grouped.withColumns(over(*keys, group)).join(before, [*keys, group])
    done = joined.withColumns({name: _FOLDS[how][1](F.col(f"scan_before_{name}"), F.col(name)) for name, (_, how) in folds.items()})
    return done.select(*df.columns, *folds)


def _blocks(log: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """The records with pos, their place, and block, and the number of blocks."""
    n = max(1, math.ceil(log.count() / block_rows))
    ties = log.withColumn("tie", F.xxhash64("stream", "kind", "key", "deleted", "value"))
    ranged = ties.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select(*log.columns, F.monotonically_increasing_id().alias("pos"))
    table = staged(ranged, "log").withColumn("block", F.shiftright("pos", 33))
    return table, (table.agg(F.max("block")).first()[0] or 0) + 1


def resolve(
    log: DataFrame, id_col: str = "id", stream_col: str = "stream", kind_col: str = "kind", key_col: str = "key", value_col: str = "value", deleted_col: str | None = None, block_rows: int = BLOCK_ROWS, fan_out: int = FAN_OUT,
) -> Resolved:
    """What became of each change of a log: id, pos, stream, key, value, deleted, fate, by, commit, staged in the shared folder; and the number of commits.

    A record's kind is commit, abort, savepoint, rollback or, with any other text or none, change. Each stream, null being one like any other, runs successive
    transactions, ended by a commit, an abort or the log's end. A rollback undoes its transaction's remaining changes since
    the latest savepoint, or all of them if none is open, and removes that savepoint. fate is commit, rollback or abort; by
    is the id of the record that decided, null for the log's end, which aborts; commit is the commit's number in the whole log, from 1.

    The log's order is by id; records of one id follow in order of a hash of what they hold, equal ones by chance. Records
    without an id have no place in the log and take no part. A change without a value, or with deleted_col true, deletes its key. An
    empty log gives no rows; other columns are not read. Records of one id and equal content come into one block, however many.
    """
    gone = F.coalesce(F.col(deleted_col).cast("boolean"), F.lit(False)) if deleted_col else F.lit(False)
    kind = F.when(F.col(kind_col).isin(COMMIT, ABORT, SAVEPOINT, ROLLBACK), F.col(kind_col)).otherwise(CHANGE)
    stream = F.concat(F.lit("="), F.col(stream_col).cast("string"))
    records = log.select(F.col(id_col).alias("id"), F.coalesce(stream, F.lit("")).alias("stream"), kind.alias("kind"), F.col(key_col).alias("key"), F.col(value_col).alias("value"), (gone | F.col(value_col).isNull()).alias("deleted"))
    table, n_blocks = _blocks(records.filter("id IS NOT NULL"), block_rows)

    # Commits are numbered over the whole log.
    in_block = Window.partitionBy("block").orderBy("pos")
    is_commit, is_end = F.col("kind") == COMMIT, F.col("kind").isin(COMMIT, ABORT)
    earlier = exclusive_scan(table.groupBy("block").agg(F.count_if(is_commit).alias("commits")), [], "block", {"commits_before": ("commits", "sum")}, n_blocks, fan_out=fan_out)
    numbered = table.withColumn("commit", F.count_if(is_commit).over(in_block)).join(earlier.select("block", "commits_before"), "block").withColumn("commit", F.col("commit") + F.coalesce("commits_before", F.lit(0)))

    # A record's transaction is the number of ends before it in its stream; the transaction's end is the next one.
    end = F.when(is_end, F.struct("pos", "id", "kind", "commit"))
    pieces = numbered.groupBy("stream", "block").agg(F.count_if(is_end).alias("ends"), F.min(end).alias("first_end"))
    pieces = exclusive_scan(pieces, ["stream"], "block", {"first": ("ends", "sum")}, n_blocks, fan_out=fan_out)
    pieces = exclusive_scan(pieces, ["stream"], "block", {"later_end": ("first_end", "min")}, n_blocks, later=True, fan_out=fan_out)
    pieces = pieces.select("stream", "block", F.coalesce("first", F.lit(0)).alias("first"), "ends", "later_end")
    own = Window.partitionBy("stream", "block")
    up, down = own.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1), own.orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = numbered.join(pieces, ["stream", "block"]).withColumns({"transaction": F.col("first") + F.count_if(is_end).over(up), "last": F.col("first") + F.col("ends"), "end": F.coalesce(F.min(end).over(down), "later_end")})
    placed = staged(placed.drop("commits_before", "ends", "later_end", "commit"), "transactions")

    # The level of a record: savepoints open before it. s sums steps, m is the least s so far, and each fall below 0 found no savepoint.
    step = F.when(F.col("kind") == SAVEPOINT, 1).when(F.col("kind") == ROLLBACK, -1).otherwise(0).cast("long")
    piece = Window.partitionBy("stream", "block", "transaction").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    walked = placed.withColumn("step", step).withColumn("s", F.coalesce(F.sum("step").over(piece), F.lit(0)))
    walked = walked.withColumn("m", F.min(F.col("s") + F.col("step")).over(piece.rowsBetween(Window.unboundedPreceding, -1)))
    after = F.when(is_end, F.struct(F.lit(0).cast("long").alias("s"), F.lit(None).cast("long").alias("m"))).otherwise(F.struct((F.col("s") + F.col("step")).alias("s"), F.least("m", F.col("s") + F.col("step")).alias("m")))
    tails = walked.groupBy("stream", "block").agg(F.min("first").alias("first"), F.min("last").alias("last"), F.max(F.struct("pos", after.alias("after"))).alias("tail"))
    tails = tails.select("stream", "block", "first", "last", F.col("tail.after.s").alias("s"), F.col("tail.after.m").alias("m"))
    begun = tails.filter("first < last").select("stream", "block", F.col("first").alias("transaction"), F.lit(0).cast("long").alias("s"), F.lit(None).cast("long").alias("m"), F.lit(True).alias("continues"))
    open_ = tails.select("stream", "block", F.col("last").alias("transaction"), "s", "m", (F.col("first") == F.col("last")).alias("continues"))
    carried = exclusive_scan(open_.unionByName(begun), ["stream", "transaction"], "block", {"s_before": ("s", "sum")}, n_blocks, fan_out=fan_out)
    carried = carried.withColumn("least", F.coalesce("s_before", F.lit(0)) + F.col("m"))
    carried = exclusive_scan(carried, ["stream", "transaction"], "block", {"m_before": ("least", "min")}, n_blocks, fan_out=fan_out).filter("continues").select("stream", "block", "s_before", "m_before")
    continues = F.col("transaction") == F.col("first")
    s_before = F.when(continues, F.col("s_before")).otherwise(None)
    levels = walked.join(carried, ["stream", "block"], "left").withColumn("s_before", F.coalesce(s_before, F.lit(0)))
    level = F.col("s_before") + F.col("s") - F.least(F.lit(0), F.col("s_before") + F.col("m"), F.when(continues, F.col("m_before")))
    levels = staged(levels.select("id", "pos", "block", "stream", "kind", "key", "value", "deleted", "transaction", "first", "last", "end", level.alias("level")), "levels")
    continues = F.col("transaction") == F.col("first")

    # A change is taken back by its transaction's next rollback that finds as many savepoints open as the change did.
    back = F.when(F.col("kind") == ROLLBACK, F.struct("pos", "id"))
    same = ["stream", "transaction", "level"]
    inside = Window.partitionBy("stream", "block", "transaction", "level").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    undone = levels.withColumn("undo", F.min(back).over(inside))
    crossing = levels.filter((continues | (F.col("transaction") == F.col("last"))) & F.col("kind").isin(ROLLBACK, CHANGE))
    firsts = crossing.groupBy(*same, "block").agg(F.min(back).alias("first_undo"))
    later = exclusive_scan(firsts, same, "block", {"later_undo": ("first_undo", "min")}, n_blocks, later=True, fan_out=fan_out).filter("later_undo IS NOT NULL")
    changes = undone.filter(F.col("kind") == CHANGE).join(later.select(*same, "block", "later_undo"), [*same, "block"], "left").withColumn("undo", F.coalesce("undo", "later_undo"))

    fate = F.when(F.col("undo").isNotNull(), ROLLBACK).when(F.col("end.kind") == COMMIT, COMMIT).otherwise(ABORT)
    name = F.when(F.col("stream") != "", F.substr("stream", F.lit(2)))
    found = changes.select("id", "pos", name.alias("stream"), "key", "value", "deleted", fate.alias("fate"), F.coalesce("undo.id", "end.id").alias("by"), F.when(fate == COMMIT, F.col("end.commit")).alias("commit"))
    return Resolved(staged(found, "resolved"), table.filter(is_commit).count())


def _last_writers(resolved: Resolved, per_epoch: int) -> DataFrame:
    """epoch, name, key, write: the last write of each key in each epoch; name tells keys apart, null being one."""
    name = F.coalesce(F.concat(F.lit("="), F.col("key").cast("string")), F.lit(""))
    applied = resolved.changes.filter(F.col("fate") == COMMIT).select((F.floor((F.col("commit") - 1) / per_epoch) + 1).alias("epoch"), name.alias("name"), "key", F.struct("commit", "pos", "deleted", "value").alias("write"))
    return applied.groupBy("epoch", "name").agg(F.max("write").alias("write"), F.first("key").alias("key"))


def replay(resolved: Resolved, per_epoch: int = 4, epochs: int = EPOCHS, fan_out: int = FAN_OUT) -> DataFrame:
    """epoch, n_keys, total per epoch: how many keys the shared store holds after it, and the sum of their values.

    Each commit applies its transaction's remaining changes in log order; `per_epoch` commits, empty ones too, make an epoch, and the
    last epoch is what remains. Values are summed as long. A log without commits has no epochs.
    """
    n_epochs = math.ceil(resolved.commits / per_epoch)
    spark = resolved.changes.sparkSession
    if not n_epochs:
        return spark.createDataFrame([], "epoch long, n_keys long, total long")
    n_blocks = math.ceil(n_epochs / epochs)
    writes = _last_writers(resolved, per_epoch).withColumn("block", F.floor((F.col("epoch") - 1) / epochs))
    maps = writes.groupBy("name", "block").agg(F.max("write").alias("write"))
    checkpoints = exclusive_scan(maps, ["name"], "block", {"start": ("write", "max")}, n_blocks, fan_out=fan_out).select("name", "block", "start")
    told = writes.join(checkpoints, ["name", "block"]).withColumn("before", F.coalesce(F.lag("write").over(Window.partitionBy("name", "block").orderBy("epoch")), "start"))

    def count(write: str) -> Column:
        return F.when(~F.col(f"{write}.deleted"), 1).otherwise(0)

    def value(write: str) -> Column:
        return F.when(~F.col(f"{write}.deleted"), F.col(f"{write}.value").cast("long")).otherwise(0)

    steps = told.groupBy("epoch").agg(F.sum(count("write") - count("before")).alias("keys"), F.sum(value("write") - value("before")).alias("sum"))
    every = spark.range(1, n_epochs + 1).join(steps.withColumnRenamed("epoch", "id"), "id", "left").select((F.col("id") - 1).alias("index"), F.coalesce("keys", F.lit(0)).alias("keys"), F.coalesce("sum", F.lit(0)).alias("sum"))
    summed = exclusive_scan(every, [], "index", {"keys_before": ("keys", "sum"), "sum_before": ("sum", "sum")}, n_epochs, fan_out=fan_out)
    return summed.select((F.col("index") + 1).alias("epoch"), (F.coalesce("keys_before", F.lit(0)) + F.col("keys")).alias("n_keys"), (F.coalesce("sum_before", F.lit(0)) + F.col("sum")).alias("total"))


def store_after(resolved: Resolved, epoch: int, per_epoch: int = 4) -> DataFrame:
    """key, value: the whole shared store after the given epoch, from 1; after 0 it is empty, and after the last epoch it stays."""
    latest = _last_writers(resolved, per_epoch).filter(F.col("epoch") <= epoch).groupBy("name").agg(F.max("write").alias("write"), F.first("key").alias("key"))
    return latest.filter("NOT write.deleted").select("key", "write.value")
