"""Near-duplicates of 64-bit hashes as a scan in input order would find them.

An item is accepted unless an accepted item before it lies within the distance, and a duplicate names the first such. That is
the first maximal independent set in order of position, found in rounds: who has an accepted earlier neighbour is a duplicate,
whose earlier neighbours are all duplicates is accepted.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.images import hamming
from skein.sources.stage import staged

#: Hashes in a block, at most, where all have to be compared with all; fewer hashes are in up to FEW_BLOCKS blocks of FEW_ROWS, to be compared side by side.
BLOCK_ROWS, FEW_BLOCKS, FEW_ROWS = 5_000, 8, 500
#: Pairs of hashes that are compared at once.
STEP_PAIRS = 1 << 21
#: Forms of a band that a hash is looked up under, at most, and bits that a band has, at least.
MOST_FORMS, MIN_BAND = 100, 12


def band_plan(distance: int) -> tuple[int, int] | None:
    """(bands, flips): hashes within the distance differ in at most `flips` bits of some band. None where no plan selects.

    A band of few bits selects little, and looking up all forms with a few bits flipped costs rows; the plan has the widest bands
    whose forms are few.
    """
    for n in range(1, distance + 2):
        bits, flips = 64 // n, distance // n
        if sum(math.comb(-(-64 // n), k) for k in range(flips + 1)) <= MOST_FORMS:
            return (n, flips) if bits >= MIN_BAND else None
    return None


def _edges(n: int) -> list[tuple[int, int]]:
    return [(64 * i // n, 64 * (i + 1) // n) for i in range(n)]


def _low_bits(n: int) -> int:
    """The mask of n low bits, as a signed number."""
    return -1 if n == 64 else (1 << n) - 1


def _band(h: Column, a: int, b: int) -> Column:
    return F.shiftrightunsigned(h, a).bitwiseAND(F.lit(_low_bits(b - a)))


def bands(h: Column, n: int, flips: int = 0) -> Column:
    """Array of (band, value): the hash in n bands of bits, and each with up to `flips` bits changed."""

    def forms(i: int, a: int, b: int) -> Column:
        masks = [sum(1 << k for k in changed) for size in range(flips + 1) for changed in itertools.combinations(range(b - a), size)]
        signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks])
        return F.transform(signed, lambda m: F.struct(F.lit(i).alias("band"), _band(h, a, b).bitwiseXOR(m).alias("value")))

    return F.concat(*[forms(i, a, b) for i, (a, b) in enumerate(_edges(n))])


def _near(distance: int):
    """(a, b, distance) of the near pairs of two blocks, or of one block, which has no other side."""

    def side(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, h = (block.column(k).to_numpy() for k in (2, 3))
        ones = np.bitwise_count(h.view(np.uint64)).astype(np.int64)
        order = np.argsort(ones, kind="stable")
        return p[order], h.view(np.uint64)[order], ones[order]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        same = bool(left.num_rows) and left["i"][0].as_py() == left["j"][0].as_py()
        if not left.num_rows or not same and not right.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32())], ["a", "b", "distance"])
        p, h, ones = side(left)
        q, g, twos = (p, h, ones) if same else side(right)
        found = []
        step = max(1, STEP_PAIRS // max(1, len(q)))
        for at in range(0, len(p), step):
            part = slice(at, at + step)
            low, high = np.searchsorted(twos, ones[part][0] - distance, "left"), np.searchsorted(twos, ones[part][-1] + distance, "right")
            away = np.bitwise_count(h[part, None] ^ g[None, low:high])
            i, j = np.nonzero(away <= distance)
            found.append(np.stack([p[part][i], q[low:high][j], away[i, j].astype(np.int64)]))
        a, b, d = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
        keep = a < b if same else np.ones(len(a), bool)
        a, b = np.minimum(a, b)[keep], np.maximum(a, b)[keep]
        return pa.table({"a": a, "b": b, "distance": d[keep].astype(np.int32)})

    return compare


def _far_pairs(x: DataFrame, k: int, distance: int) -> DataFrame:
    """Near pairs of (p, h) in k blocks, compared as arrays."""
    own, every = F.pmod(F.xxhash64("p"), F.lit(k)), F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))
    placed = x.filter("h IS NOT NULL").select("p", "h", own.alias("own"), F.explode(every).alias("other"))
    # Each two blocks meet once, and each block itself.
    sides = placed.select("p", "h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"))
    left = sides.filter("first").select("i", "j", "p", "h")
    # Columns of its own: of two sides with the same ones the optimizer would drop what the function alone reads.
    right = sides.filter("NOT first").select(*[F.col(c).alias(f"{c}2") for c in ("i", "j", "p", "h")])
    return left.groupBy("i", "j").cogroup(right.groupBy("i2", "j2")).applyInArrow(_near(distance), "a long, b long, distance int")


def near_pairs(items: DataFrame, distance: int, pos: str = "pos", hash_col: str = "hash") -> DataFrame:
    """(a, b, distance) of all pairs of positions a < b within the distance.

    Meant for distinct hashes: of equal ones every pair is a row. By the pigeonhole principle a pair within the distance nearly agrees
    in some band of bits; one side is looked up under all nearly equal forms of its bands, an equi-join that Spark splits where a
    band is hot (distance 4: 3 bands of 21 bits and more, 69 forms). A pair found in several bands counts in the first. Distances over
    14 leave bands that don't select: there up to BLOCK_ROWS hashes are joined, and more meet in pairs of blocks of that size, a pair a task, and are compared as arrays, in steps of
    STEP_PAIRS pairs. Hashes whose numbers of set bits differ by more than the distance can't be near, so each hash of a block meets a run of the other, sorted
    by that number. The cost still grows with the square, at some nanoseconds a pair; only near pairs become rows.
    """
    x = items.select(F.col(pos).cast("long").alias("p"), F.col(hash_col).cast("long").alias("h"))
    plan = band_plan(distance)
    if plan:
        n, flips = plan
        left = x.select(F.col("p").alias("a"), F.col("h").alias("ha"), F.inline(bands(F.col("h"), n, flips)))
        right = x.select(F.col("p").alias("b"), F.col("h").alias("hb"), F.inline(bands(F.col("h"), n)))
        differ = F.col("ha").bitwiseXOR(F.col("hb"))
        first = F.coalesce(*[F.when(F.bit_count(_band(differ, a, b)) <= flips, F.lit(i)) for i, (a, b) in enumerate(_edges(n))])
        found = left.join(right, ["band", "value"]).filter((F.col("a") < F.col("b")) & (hamming(F.col("ha"), F.col("hb")) <= distance) & (first == F.col("band")))
    else:
        rows = x.count()
        if rows > BLOCK_ROWS:
            return _far_pairs(x, -(-rows // BLOCK_ROWS), distance)
        # So few that rows of pairs cost less than starting Python.
        k = max(1, min(FEW_BLOCKS, rows // FEW_ROWS))
        own, other = F.pmod(F.xxhash64("p"), F.lit(k)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
        left = x.select(F.col("p").alias("a"), F.col("h").alias("ha"), own.alias("i"), other.alias("j"))
        right = x.select(F.col("p").alias("b"), F.col("h").alias("hb"), own.alias("j"), other.alias("i"))
        found = left.hint("merge").join(right, ["i", "j"]).filter((F.col("a") < F.col("b")) & (hamming(F.col("ha"), F.col("hb")) <= distance))
    return found.select("a", "b", hamming(F.col("ha"), F.col("hb")).alias("distance"))


def gate(items: DataFrame, distance: int = 4, pos: str = "pos", hash_col: str = "hash") -> DataFrame:
    """items with `accepted` and `duplicate_of` (a position, null if accepted). Items without a hash are accepted."""
    # Equal hashes share a verdict: the first of them stands for all, and where it is accepted the others are its duplicates.
    firsts = staged(items.filter(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.min(pos).alias("first")), "distinct")
    links = staged(near_pairs(firsts, distance, "first", hash_col).select("a", "b"), "links")
    state = staged(links.select(F.col("b").alias("p")).distinct().withColumn("accepted", F.lit(None).cast("boolean")), "state")
    # Items without an earlier neighbour are accepted from the start and are not in `state`.
    while not state.filter("accepted IS NULL").isEmpty():
        earlier = state.select(F.col("p").alias("q"), "accepted")
        seen = links.join(earlier, links["a"] == earlier["q"], "left").withColumn("yes", F.col("q").isNull() | F.coalesce("accepted", F.lit(False))).withColumn("no", F.col("q").isNotNull() & ~F.coalesce("accepted", F.lit(True)))
        verdict = seen.groupBy("b").agg(F.bool_or("yes").alias("hit"), F.bool_and("no").alias("clear"))
        state = staged(state.join(verdict, state["p"] == verdict["b"]).select("p", F.coalesce("accepted", F.when(F.col("hit"), False).when(F.col("clear"), True)).alias("accepted")), "state")
    duplicates = state.filter("NOT accepted").select(F.col("p").alias("dup"))
    anchors = links.join(duplicates, links["a"] == duplicates["dup"], "left_anti").groupBy("b").agg(F.min("a").alias("duplicate_of"))
    found = duplicates.join(anchors, duplicates["dup"] == anchors["b"]).select("dup", "duplicate_of")
    judged = firsts.join(found, firsts["first"] == found["dup"], "left").select(F.col(hash_col).alias("of_hash"), "first", "duplicate_of")
    joined = items.join(judged, items[hash_col] == judged["of_hash"], "left")
    accepted = F.col("duplicate_of").isNull() & F.coalesce(F.col("first") == F.col(pos), F.lit(True))
    return joined.withColumn("accepted", accepted).withColumn("duplicate_of", F.when(~accepted, F.coalesce("duplicate_of", "first"))).drop("of_hash", "first")
