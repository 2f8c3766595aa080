"""Hard negatives of anchor vectors, by an orthogonal PCA rotation that lets most pairs go after a few components.

Vectors are quantized to integers and packed into blocks of a batch each in the shared folder; anchors are packed likewise, in groups. Every
group of anchors meets every block of rows once, in tiles that are dealt out by (group, salt): a task holds one group
of anchors and a few blocks of rows. In a tile both sides are rotated by the principal axes of a sample of vectors. The products of the leading
components are accumulated; what the others can add is bounded by the residual norms (Cauchy-Schwarz) plus a slack for rounding
and for the rotation's own deviation from orthogonality. Pairs whose bounds can't reach the anchor's current threshold go, in some steps, and only
survivors are multiplied out in integers, so that results are exact whatever the rotation is.

Two passes: the positives of each anchor, then per positive the best rows of another label whose score lies in its band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.storage import small_batches, staged

#: Anchors that meet a tile's rows together, about.
BLOCK_ANCHORS = 1_024
#: Row blocks, of an Arrow batch each, that meet one group of anchors in a task, about.
TILE_BLOCKS = 16
#: Vectors that the axes are fitted on, and numbers in them at most. The axes decide about speed alone.
SAMPLE_ROWS, SAMPLE_NUMBERS = 4_096, 1 << 20
#: Rows that are bounded at once, and pairs that are multiplied at once.
STEP_ROWS, STEP_PAIRS = 512, 65_536
#: Squared integer norm from which on a product need not fit into a long.
NORM_LIMIT = 1 << 62

_PACKED = "block long, n int, dims int, ids binary, labels binary, numbers binary, width string"
_BLOCKS = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("numbers", pa.binary()), ("width", pa.string())])
_FOUND = pa.schema([("block", pa.int64()), ("anchor", pa.int64()), ("anchor_id", pa.int64()), ("band", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def quantized(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can be used, and their integers floor(scale * x), with zeros behind shorter vectors."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(column)), lengths)
    finite = np.isfinite(flat)
    with np.errstate(over="ignore"):
        whole = np.floor(scale * np.where(finite, flat, 0))
        usable = np.bincount(row, whole**2, len(column)) < NORM_LIMIT
    usable &= column.is_valid().to_numpy(zero_copy_only=False)
    usable[row[~finite]] = False
    some = usable[row]
    place = (np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[some]
    numbers = np.zeros((int(usable.sum()), int(lengths[usable].max(initial=0))), np.int64)
    numbers[(np.cumsum(usable) - 1)[row[some]], place] = whole[some].astype(np.int64)
    return usable, numbers


def _packed(vectors: DataFrame, scale: float) -> DataFrame:
    """id, label, vector as a block of each Arrow batch. A block's number holds its partition's in the upper 32 bits."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            usable, numbers = quantized(batch.column(2), scale)
            if not usable.any():
                continue
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False)[usable].astype("<i8").tobytes() for i in (0, 1))
            most = int(np.abs(numbers).max(initial=0))
            width = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
            yield pa.RecordBatch.from_pylist([{"block": block, "n": len(numbers), "dims": numbers.shape[1], "ids": ids, "labels": labels, "numbers": numbers.astype(width).tobytes(), "width": width}], schema=_BLOCKS)
            block += 1

    return vectors.mapInArrow(pack, _PACKED)


class _Side:
    """The unpacked rows of some blocks: block and place in it, ids, labels, integers, rotated components, and norms of what follows each cut."""

    def __init__(self, records: list[dict], axes: np.ndarray, cuts: list[int]) -> None:
        dims = len(axes)
        self.block = np.concatenate([np.full(r["n"], r["block"]) for r in records])
        self.place = np.concatenate([np.arange(r["n"]) for r in records])
        self.ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in records])
        self.labels = np.concatenate([np.frombuffer(r["labels"], "<i8") for r in records])
        self.numbers = np.zeros((len(self.ids), dims), np.int64)
        at = 0
        for r in records:
            self.numbers[at : at + r["n"], : r["dims"]] = np.frombuffer(r["numbers"], r["width"]).reshape(r["n"], r["dims"])
            at += r["n"]
        self.turned = self.numbers.astype(np.float64) @ axes
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.rest = {c: np.sqrt(squares[:, c]) if c < dims else np.zeros(len(self.ids)) for c in cuts}
        self.norm = np.sqrt(squares[:, 0]) if dims else np.zeros(len(self.ids))


def _first(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, groups))
    ordered = groups[order]
    start = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, int)
    rank = np.arange(len(ordered)) - np.repeat(start, np.diff(np.append(start, len(ordered))))
    return order[rank < k]


def _products(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows of a with rows of b, some pairs at a time."""
    parts = [np.einsum("ij,ij->i", a[left[i : i + STEP_PAIRS]], b[right[i : i + STEP_PAIRS]]) for i in range(0, len(left), STEP_PAIRS)]
    return np.concatenate(parts) if parts else np.empty(0, a.dtype)


def _best(anchors: _Side, rows: _Side, cuts: list[int], slack: float, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """For every anchor and each of its bands low..high: the first k rows with a score in the band, of the anchor's label or of others.

    low and high are integers, a column a band; a band without any score has low above high. Gives anchor, band, row and score.
    """
    n, bands = low.shape
    reach, floor = high.max(axis=1, initial=-NORM_LIMIT), low.copy()
    found = tuple(np.empty(0, np.int64) for _ in range(3))  # anchor * bands + band, row, score
    for start in range(0, len(rows.ids), STEP_ROWS):
        part = slice(start, start + STEP_ROWS)
        open_ = floor.min(axis=1, initial=NORM_LIMIT).astype(np.float64)
        allowed = ((anchors.labels[:, None] == rows.labels[None, part]) == same) & (anchors.ids[:, None] != rows.ids[None, part])
        product = anchors.turned[:, : cuts[0]] @ rows.turned[part, : cuts[0]].T
        room = anchors.rest[cuts[0]][:, None] * rows.rest[cuts[0]][None, part] + slack * anchors.norm[:, None] * rows.norm[None, part] + 0.5
        left, right = np.nonzero(allowed & (product + room >= open_[:, None]) & (product - room <= reach.astype(np.float64)[:, None]))
        sums, right = product[left, right], right + start
        for a, b in zip(cuts, cuts[1:], strict=False):
            sums = sums + _products(anchors.turned[:, a:b], rows.turned[:, a:b], left, right)
            room = anchors.rest[b][left] * rows.rest[b][right] + slack * anchors.norm[left] * rows.norm[right] + 0.5
            stays = (sums + room >= open_[left]) & (sums - room <= reach[left])
            left, right, sums = left[stays], right[stays], sums[stays]
        scores = _products(anchors.numbers, rows.numbers, left, right)
        fits = (scores[:, None] >= floor[left]) & (scores[:, None] <= high[left])
        pair, band = np.nonzero(fits)
        if not len(pair):
            continue
        found = tuple(np.concatenate(x) for x in zip(found, (left[pair] * bands + band, right[pair], scores[pair]), strict=True))
        best = _first(found[0], found[2], rows.ids[found[1]], k)
        found = tuple(x[best] for x in found)
        full = np.bincount(found[0], minlength=n * bands) >= k
        worst = np.full(n * bands, NORM_LIMIT, np.int64)
        np.minimum.at(worst, found[0], found[2])
        floor = np.where(full, worst, low.ravel()).reshape(n, bands)
    return found[0] // bands, found[0] % bands, found[1], found[2]


def _axes(blocks: DataFrame) -> tuple[np.ndarray, float]:
    """The principal axes of a bounded sample as columns, strongest first, for the largest number of dimensions; and how far they are from orthogonal."""
    dims = int(blocks.agg(F.coalesce(F.max("dims"), F.lit(0))).first()[0])
    per_block = max(1, min(64, SAMPLE_NUMBERS // (max(dims, 1) * 64)))
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // max(dims, 1)) // per_block)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                m = np.frombuffer(r["numbers"], r["width"]).reshape(r["n"], r["dims"])
                for row in m[:: max(1, len(m) // per_block)][:per_block]:
                    yield pa.RecordBatch.from_pydict({"x": [row.astype(np.float64).tolist()]})

    chosen = blocks.orderBy(F.xxhash64("block"), "block").limit(wanted)
    sample = chosen.mapInArrow(some, "x array<double>").collect()
    x = np.zeros((len(sample), dims))
    for i, r in enumerate(sample):
        x[i, : len(r.x)] = r.x
    values, vectors = np.linalg.eigh(x.T @ x) if dims else (np.empty(0), np.empty((0, 0)))
    axes = np.ascontiguousarray(vectors[:, np.argsort(-values, kind="stable")])
    return axes, float(np.abs(axes.T @ axes - np.eye(dims)).sum(axis=1).max(initial=0))


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: tuple[int, int] = (4, 5), scale: float = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor and positive its hard negatives, best first.

    Vectors become integers, floor(scale * x); a score is an integer inner product. Higher scores come first, then smaller ids. The
    positives of an anchor are its first `positives` other rows of the same label; the negatives of a positive its first
    `negatives` rows of another label with a score of at most the positive's and of at least least[0] / least[1] of it. A negative positive score has
    none, as its band is empty.

    Rows with a null id, label or vector, or with a component that is null, infinite or not a number take no part; nor do vectors whose
    squared integer norm is 2^62 or more, as their scores need not fit into a long. Vectors of different lengths are compared as if the shorter one ended in
    zeros. Rows with an anchor's own id are neither its positives nor its negatives; a repeated row counts as often as it is there, equal rows
    in any order. An empty table gives none. Labels are whole numbers; other columns are read by is_anchor alone.
    """
    spark = small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    blocks = staged(_packed(rows.select("id", "label", "vector"), scale), "vector-blocks")
    chosen = rows.filter("anchor").select("id", "label", "vector")
    groups = max(1, math.ceil(chosen.count() / BLOCK_ANCHORS))
    anchors = staged(_packed(chosen.repartition(groups), scale), "anchor-blocks")

    axes, deviation = _axes(blocks)
    dims = len(axes)
    cuts = sorted({min(c, dims) for c in (8, 24, dims)})
    slack = deviation + 64 * max(dims, 1) * float(np.finfo(float).eps)
    n_blocks = blocks.count()
    salts = max(1, min(n_blocks, max(math.ceil(n_blocks / TILE_BLOCKS), 2 * spark.sparkContext.defaultParallelism)))
    # Each block of rows goes to every group of anchors, each group to every salt: a task's tile is a group and a salt's rows.
    dealt = blocks.withColumns({"salt": F.pmod(F.xxhash64("block"), F.lit(salts)), "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>"))})

    def tiles(sides: DataFrame, same: bool, k: int) -> DataFrame:
        """The best of each tile: the anchor's block, its place there and its id, the band, the row's id and the score."""

        def tile(left: pa.Table, right: pa.Table) -> pa.Table:
            a, b = left.to_pylist(), right.to_pylist()
            if not a or not b:
                return _FOUND.empty_table()
            one, many = _Side(a, axes, cuts), _Side(b, axes, cuts)
            if same:
                low, high = np.full((len(one.ids), 1), -NORM_LIMIT, np.int64), np.full((len(one.ids), 1), NORM_LIMIT, np.int64)
            else:
                low, high = (np.concatenate([np.frombuffer(r[x], "<i8") for r in a]).reshape(len(one.ids), -1) for x in ("low", "high"))
            anchor, band, row, score = _best(one, many, cuts, slack, same, low, high, k)
            return pa.table([one.block[anchor], one.place[anchor], one.ids[anchor], band, many.ids[row], score], schema=_FOUND)

        left = sides.withColumns({"group": F.shiftright("block", 32), "salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>"))})
        return left.groupBy("group", "salt").cogroup(dealt.groupBy("group", "salt")).applyInArrow(tile, "block long, anchor long, anchor_id long, band long, id long, score long")

    def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    best = staged(ranked(tiles(anchors, True, positives), ["block", "anchor"], positives).select("block", "anchor", "anchor_id", (F.col("rank") - 1).cast("long").alias("band"), "id", "score"), "positives")

    def bands(block: pa.Table, scores: pa.Table) -> pa.Table:
        """The anchors of a block with the band of each of their positives."""
        shape = (block["n"][0].as_py(), positives)
        low, high = np.full(shape, NORM_LIMIT), np.full(shape, -NORM_LIMIT)
        for place, band, score in zip(*(scores[c].to_pylist() for c in ("anchor", "band", "score")), strict=True):
            if score >= 0:
                low[place, band], high[place, band] = -(-score * least[0] // least[1]), score
        return block.append_column("low", pa.array([low.tobytes()])).append_column("high", pa.array([high.tobytes()]))

    banded = staged(anchors.groupBy("block").cogroup(best.groupBy("block")).applyInArrow(bands, f"{_PACKED}, low binary, high binary"), "anchor-bands")
    hard = ranked(tiles(banded, False, negatives), ["block", "anchor", "band"], negatives)
    named = best.select("block", "anchor", "band", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(named, ["block", "anchor", "band"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
