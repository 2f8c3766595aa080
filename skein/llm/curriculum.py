"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Each source has a weight schedule over training time 0..1, linear between knots. Its integral up to a time is the
source's cumulative token demand; inverting that demand at a document's place in its source's stream gives the
document's training position, and a range sort by position gives the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.storage import staged

WORD = r"[^\x20\x09-\x0D]+"
#: (time, weight) from 0 to 1, linear between.
type Schedule = Sequence[tuple[float, float]]


def source_targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: int = 3, budget: int | None = None) -> DataFrame:
    """Adds rank, weight and target to a table of (source, source_size).

    Sources in code point order, null last, take the weights in turn. They share the budget (all sizes if None) by
    weight; no target passes cap times its source's size, and what lies above is shared anew by weight among the rest.
    The sources that end at their cap are those whose cap-to-weight ratio is lowest, so one sort by that ratio and
    running sums find the level. The table has a row per source, never per document.
    """
    n = len(weights)
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % n + 1).cast("int")))
    by_ratio = Window.orderBy(cap * F.col("source_size") / F.col("weight"), "rank")
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) if budget is None else F.least(F.lit(budget), cap * F.sum("source_size").over(everything))
    level = (total - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after)
    at = ranked.withColumn("level", level)
    free = F.col("level") * F.col("weight") <= cap * F.col("source_size")
    found = at.withColumn("share", F.min(F.when(free, F.struct(cap * F.col("source_size") / F.col("weight"), "rank", "level"))).over(everything)["level"])
    share = F.col("share") * F.col("weight")
    capped = (cap * F.col("source_size")).cast("double")
    return found.withColumn("target", F.when(F.col("share").isNull() | (share > capped), capped).otherwise(share)).drop("level", "share")


def demand_inverse(fraction: Column, schedule: Schedule) -> Column:
    """The time at which a schedule has used up the given fraction of its whole integral."""
    pieces = []
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))
    if total <= 0 or any(w < 0 for _, w in schedule):
        raise ValueError("a schedule needs weights of 0 or more, not all 0")
    used = 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        if area <= 0:
            continue
        slope, need = (w1 - w0) / (t1 - t0), fraction * total - used
        # 2 * need / (w0 + sqrt(w0^2 + 2 * slope * need)) solves w0 * x + slope * x^2 / 2 = need without cancellation
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * need))
        time = F.lit(t0) + F.when(need <= 0, F.lit(0.0)).otherwise(2 * need / (F.lit(w0) + root))
        pieces.append((used + area, F.least(time, F.lit(t1))))
        used += area
    out = pieces[-1][1]
    for upto, time in reversed(pieces[:-1]):
        out = F.when(fraction * total < upto, time).otherwise(out)
    return out


#: One weight all the time.
STEADY: Schedule = ((0.0, 1.0), (1.0, 1.0))


def turn(doc_id: Column, text: Column) -> Column:
    """The key that orders a source's stream; rows without an id are spread over it by their text."""
    return F.coalesce(F.md5(doc_id.cast("string").cast("binary")), F.md5(F.concat(F.lit("null:"), F.coalesce(text, F.lit(""))).cast("binary")))


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def _bucket(key: Column, buckets: int) -> Column:
    """Buckets follow the stream's order, so they are cut from the leading hex digits of its key."""
    return F.floor(F.conv(F.substring(key, 1, 6), 16, 10).cast("long") * buckets / (1 << 24)).cast("int")


def _lookup(sized: DataFrame, weights: Sequence[float], cap: int) -> DataFrame:
    """A row per source and bucket: own_key, bucket, part_start (words of the source before the bucket), source_size, target, rank."""
    parts = sized.groupBy("source", "source_key", "bucket").agg(F.sum("size").alias("part_size"))
    in_source = Window.partitionBy("source_key").orderBy("bucket")
    whole_source = in_source.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.withColumn("part_start", F.sum("part_size").over(in_source) - F.col("part_size")).withColumn("source_size", F.sum("part_size").over(whole_source))
    targets = source_targets(parts.groupBy("source", "source_key").agg(F.max("source_size").alias("source_size")), weights, cap)
    right = targets.select(F.col("source_key").alias("own_key"), "source_size", "target", "rank")
    return parts.drop("source_size").join(right, F.col("source_key") == F.col("own_key")).select("own_key", F.col("bucket").alias("own_bucket"), "part_start", "source_size", "target", "rank")


def _planned(rows: DataFrame, lookup: DataFrame, whole: bool) -> DataFrame:
    """rows (source_key, bucket, turn, size, tie, ...) with source_size, target, rank, place, taken and passes. What a window and a join need is dealt out once, by source and bucket."""
    in_part = Window.partitionBy("source_key", "bucket").orderBy("turn", "size", "tie")
    placed = rows.withColumn("within", F.sum("size").over(in_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    joined = placed.join(lookup, (F.col("source_key") == F.col("own_key")) & (F.col("bucket") == F.col("own_bucket")))
    wanted = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    place = F.col("part_start") + F.col("within")
    rest = F.least(F.greatest(wanted - full * F.col("source_size") - place, F.lit(0)), F.col("size"))
    if whole:
        rest = F.when(2 * rest >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    taken = (full * F.col("size") + rest).cast("long")
    passes = F.when(taken > 0, full + (rest > 0).cast("long")).otherwise(F.lit(0)).cast("int")
    return joined.withColumns({"place": place, "taken": taken, "passes": passes}).drop("own_key", "own_bucket", "within", "part_start")


def _position(schedules: Sequence[Schedule], place: Column) -> Column:
    """Training position of a place in a source's stream."""
    fraction, position = F.least(place / F.col("target"), F.lit(1.0)), F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        position = F.when(F.col("rank") % len(schedules) == i, demand_inverse(fraction, schedule)).otherwise(position)
    return position


def _with_keys(docs: DataFrame, buckets: int | None, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """The columns that place a document in its source's stream."""
    buckets = buckets or max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    key = turn(F.col(id_col), text)
    return {"size": word_count(text), "source_key": F.coalesce(F.concat(F.lit("="), source), F.lit("")), "turn": key, "bucket": _bucket(key, buckets), "tie": F.xxhash64(text)}


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    schedules: Sequence[Schedule] = (STEADY,),
    whole: bool = False,
    buckets: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size (words), source, source_size, target, taken (words), passes, position.

    A source's documents form a stream in the order of a hash of the id. The mix reads the stream from its start, again
    when it ends, until it has the source's target. `taken` counts the words it takes of a document, repeats included;
    the last document is cut at the target or, with whole=True, taken as a whole if at least half of it is wanted.
    `passes` counts the readings that take something; `position` is the training position in 0..1 of the first one,
    null where nothing is taken. `schedules` are dealt to the sources in turn, like the weights.
    A null text has size 0; a null source is a source of its own, last in order. Rows without an id are placed by a hash of
    their text, rows of one id ordered by size and text. Other columns are not read, and an empty table gives an empty plan.
    A source may hold most of the rows: its running sums are made in `buckets` parts of each source (four for each
    shuffle partition, if None), and added up.
    """
    keys = _with_keys(docs, buckets, id_col, text_col, source_col)
    sized = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), *[c.alias(n) for n, c in keys.items()]), "mix-sizes")
    planned = _planned(sized, _lookup(sized, weights, cap), whole)
    position = F.when(F.col("taken") > 0, _position(schedules, F.col("place")))
    return planned.select("doc_id", "size", "source", "source_size", "target", "taken", "passes", position.alias("position"), "place", "rank", "turn")


def training_order(plan: DataFrame, schedules: Sequence[Schedule] = (STEADY,)) -> DataFrame:
    """A row for each reading of a document (column `reading`, from 0), range-sorted by its own training position."""
    each = plan.filter("passes > 0").withColumn("reading", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    position = _position(schedules, F.col("place") + F.col("reading") * F.col("source_size"))
    return each.withColumn("position", position).orderBy("position", "rank", "doc_id")


def mix_documents(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: int = 3, schedules: Sequence[Schedule] = (STEADY,), buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix reads it, range-sorted by training position: whole documents up to the targets of their sources.

    Texts are dealt out twice, by source and part of its stream for their places, and by position. Of repeated rows each
    is read by its own place. Rows without words are in no mix. Null texts, sources and ids are treated as in plan_mix.
    """
    keys = _with_keys(docs, buckets, id_col, text_col, source_col)
    narrow = staged(docs.select(F.col(source_col).cast("string").alias("source"), *[keys[n].alias(n) for n in ("size", "source_key", "bucket")]), "mix-sizes")
    lookup = staged(_lookup(narrow, weights, cap), "mix-parts")
    whole = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("row"), *[c.alias(n) for n, c in keys.items()])
    read = _planned(whole.filter("size > 0"), lookup, True).filter("passes > 0").withColumn("reading", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    order = _position(schedules, F.col("place") + F.col("reading") * F.col("source_size"))
    placed = read.select("row", order.alias("position"), "rank", "turn", "tie")
    dealt = placed.repartitionByRange("position", "rank", "turn").sortWithinPartitions("position", "rank", "turn", "tie")
    return dealt.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
