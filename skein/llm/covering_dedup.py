"""SimHash near-duplicates found by covering locality-sensitive hashing.

Every bit position of a fingerprint is given a non-zero vector of radius + 1 bits; the mask of a vector v holds the
positions whose own vector has an odd product with v. Up to `radius` differing positions span too small a space to
meet all masks, so some mask holds none of them: every pair within the radius falls into one bucket in some of the
2^(radius + 1) - 1 tables. A bucket is searched breadth first and gives a spanning forest of its links, never all
its pairs; a bucket too large for one task is dealt out again by finer masks of the same kind over its free bits,
which loses no pair and ends, as a bucket of distinct fingerprints that agree in all but f bits has 2^f at most.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.components import connected_components
from skein.llm.storage import staged
from skein.llm.words import SPACED, blocks, mix, span_hashes, window_hashes

RADIUS = 3
#: Distinct fingerprints of a bucket that one task searches; larger buckets are dealt out by finer masks.
BUCKET_ROWS = 20_000
#: Groups of minima over a text's shingles, and the differing minima of a group that its covering masks allow: a pair of similarity 0.8 shares no masked group with a chance of 4 in a million.
GROUPS, GROUP_RADIUS = 6, 2
#: Members of a bucket that is too large for one task which are tried as its star.
STARS = 8
#: Shingles up to which a text may be such a star while shorter ones are there.
STAR_VALUES = 100_000
#: Shingles of a group of candidates that one task compares.
SET_VALUES = 4_000_000
#: Similarities are compared with this allowance for rounding.
SLACK = 1e-9
#: 64-bit parts of the fingerprint of five-word shingles by which likeness is judged.
SKETCH_PARTS = 8

_ODD = np.random.default_rng(8).integers(0, 1 << 64, (GROUPS, (2 << GROUP_RADIUS) - 1), dtype=np.uint64) | np.uint64(1)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").astype(np.int64)


def simhash(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprints of rows whose hashes are first[i]:first[i + 1]: bits set in over half of them; of none, zero."""
    n, counts = len(first) - 1, np.diff(first)
    doc = np.repeat(np.arange(n) * 256, counts)
    out = np.zeros((n, 8), np.uint8)
    for lane in range(8):
        byte = ((hashes >> np.uint64(8 * lane)) & np.uint64(255)).astype(np.int64)
        ones = np.bincount(doc + byte, minlength=n * 256).reshape(n, 256) @ _BITS
        out[:, lane] = np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little")[:, 0]
    return out.view(np.uint64)[:, 0]


def shingle_simhash(texts: pa.Array, words: int = 3) -> np.ndarray:
    """Per text: SimHash over XXH64 (seed 42) of its shingles of lower-cased words joined by spaces."""
    digest, parts = xxhash.xxh64_intdigest, [np.empty(0, np.uint64)]
    for block in blocks(texts, SPACED, lower=True):
        hashes: list[int] = []
        first = [0]
        lengths = (block.ends - block.starts).tolist()
        for i in range(len(block)):
            a, b = int(block.first[i]), int(block.first[i + 1])
            if b > a:
                line, at, edges = block.joined(i), 0, []
                for n in lengths[a:b]:
                    edges.append((at, at + n))
                    at += n + 1
                k = min(words, b - a)
                hashes.extend([digest(line[s[0] : e[1]], 42) for s, e in zip(edges, edges[k - 1 :], strict=False)])
            first.append(len(hashes))
        parts.append(simhash(np.array(hashes, np.uint64), np.array(first)))
    return np.concatenate(parts)


def covering_masks(free: int, radius: int = RADIUS) -> list[int]:
    """The masks over the set bits of `free`."""
    size = (1 << (radius + 1)) - 1
    positions = [i for i in range(64) if free >> i & 1]
    # Single bits come first: from radius + 1 positions on, they alone leave no mask empty.
    vectors = sorted(range(1, size + 1), key=lambda v: (v.bit_count(), v))
    vector = {p: vectors[i % size] for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2) for v in range(1, size + 1)]


def _mask_of(path: int, radius: int) -> int:
    """The bits that rows of a bucket share: path holds the number of the mask on each level, and the fingerprint's on top."""
    base, steps = (1 << (radius + 1)), []
    while path >= base:
        steps.append(path % base)
        path //= base
    mask = 0
    for step in reversed(steps):
        if step:
            mask |= covering_masks(~mask & (1 << 64) - 1, radius)[step - 1]
    return mask


def _forest(ids: np.ndarray, sketch: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Links that connect all rows which links of at most `most` differing bits connect."""
    rest = np.arange(1, len(ids))
    queue = [0]
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
            continue
        at = queue.pop()
        near = np.bitwise_count(sketch[rest] ^ sketch[at]).sum(axis=1) <= most
        for found in rest[near].tolist():
            yield int(ids[at]), int(ids[found])
            queue.append(found)
        rest = rest[~near]


def _bucket_links(bucket: np.ndarray, ids: np.ndarray, sketch: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Links of rows sorted by bucket, as (n, 2) arrays."""
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    sizes = np.diff(edges)
    for step in range(1, 8):  # the many small buckets, all at once
        a = np.flatnonzero(bucket[:-step] == bucket[step:]) if len(bucket) > step else np.empty(0, int)
        small = sizes[np.searchsorted(edges, a, "right") - 1] <= 8
        a = a[small]
        a = a[np.bitwise_count(sketch[a] ^ sketch[a + step]).sum(axis=1) <= most]
        yield np.stack([ids[a], ids[a + step]], axis=1)
    for k in np.flatnonzero(sizes > 8).tolist():
        a, b = edges[k], edges[k + 1]
        own, at = np.unique(ids[a:b], return_index=True)
        yield np.array(list(_forest(own, sketch[a:b][at], most)), np.int64).reshape(-1, 2)


def _shared(bucket_rows: int):
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of buckets with more than one row, sorted input; `large` if the bucket has over bucket_rows."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        spilling: int | None = None

        def out(bucket, path, ids, large) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(path), pa.array(ids), pa.array(np.full(len(ids), large))], ["bucket", "path", "id", "large"])

        def release(bucket, path, ids) -> Iterator[pa.RecordBatch]:
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            sizes = np.repeat(np.diff(edges), np.diff(edges))
            for large in (False, True):
                keep = (sizes > bucket_rows) if large else (sizes > 1) & (sizes <= bucket_rows)
                if keep.any():
                    yield out(bucket[keep], path[keep], ids[keep], large)

        for batch in batches:
            bucket, path, ids = (batch.column(i).to_numpy() for i in range(3))
            if spilling is not None:
                same = int(np.searchsorted(bucket != spilling, True)) if len(bucket) and bucket[0] == spilling else 0
                if same:
                    yield out(bucket[:same], path[:same], ids[:same], True)
                bucket, path, ids = bucket[same:], path[same:], ids[same:]
                if len(bucket):
                    spilling = None
            if not len(bucket):
                continue
            held.append((bucket, path, ids))
            n += len(ids)
            bucket, path, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(bucket, bucket[-1]))
            if last:
                yield from release(bucket[:last], path[:last], ids[:last])
            held = [(bucket[last:], path[last:], ids[last:])]
            if len(ids) - last > bucket_rows:
                yield out(*held[0], True)
                spilling, held = int(bucket[-1]), []
        if held:
            yield from release(*held[0])

    return shared


def _search(most: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(bucket, ids, sketch) -> Iterator[pa.RecordBatch]:
            for pairs in _bucket_links(bucket, ids, sketch, most):
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sketch = np.stack(batch.column(2).to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)
            held.append((bucket, ids, sketch))
            bucket, ids, sketch = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(bucket, bucket[-1]))
            if last:
                yield from links(bucket[:last], ids[:last], sketch[:last])
            held = [(bucket[last:], ids[last:], sketch[last:])]
        if held:
            yield from links(*held[0])

    return search


def covering_links(items: DataFrame, most: int, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect whatever pairs connect which share a covering bucket and differ in at most `most` bits of their sketches.

    items: id long (distinct), fps array<long> (every fingerprint has tables of its own, and its values are distinct: a large bucket
    of equal ones never splits, see banded_links), sketch array<long>. Where the
    sketch is the only fingerprint and most = radius, the links connect exactly the pairs within the radius.
    """
    bucket_rows = max(bucket_rows, 1 << (radius + 1))  # smaller buckets have at most radius + 1 free bits

    def level_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [0, *covering_masks((1 << 64) - 1, radius)]
        base = 1 << (radius + 1)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            fps = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)
            for i in range(fps.shape[1]):
                for v in range(1, base):
                    yield rows((1 + i) * base + v, masks[v], ids, fps[:, i])

    def rows(path: int, mask: int, ids: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        key = mix(mix(fps & np.uint64(mask)) ^ mix(np.array([path], np.uint64)))
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(ids), path, np.int64)), pa.array(ids)], ["bucket", "path", "id"])

    def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 1 << (radius + 1)
        for batch in batches:
            paths, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(ids):
                continue
            fps = np.stack(batch.column(2).to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64)
            for path in np.unique(paths).tolist():
                at, top = paths == path, path
                while top >= base * base:
                    top //= base
                own = fps[at][:, top // base - 1]
                mask = _mask_of(path, radius)
                for v, more in enumerate(covering_masks(~mask & (1 << 64) - 1, radius), 1):
                    yield rows(path * base + v, mask | more, ids[at], own)

    found: list[DataFrame] = []
    placed = items.select("id", "fps").mapInArrow(level_one, "bucket long, path long, id long")
    while True:
        together = staged(placed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared(bucket_rows), "bucket long, path long, id long, large boolean"), "buckets")
        sketches = items.select(F.col("id").alias("of"), "sketch")
        ready = together.filter("not large").join(sketches, F.col("id") == F.col("of")).select("bucket", "id", "sketch")
        found.append(ready.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_search(most), "a long, b long"))
        large = together.filter("large")
        if large.isEmpty():
            break
        fps = items.select(F.col("id").alias("of"), "fps")
        placed = large.join(fps, F.col("id") == F.col("of")).select("path", "id", "fps").mapInArrow(deeper, "bucket long, path long, id long")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def _bits_apart(a, b):
    """Differing bits of two sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _sets_apart(a, b):
    """Jaccard distance of two sets, 0 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(0.0)).otherwise(1 - common / union)


def _stars(members: DataFrame, apart, most: float, values: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Takes members (bucket, id, sketch) of large buckets apart: links, smaller buckets to search, and buckets that are dealt anew, both (bucket, id, sketch).

    `apart` is a metric of sketches, and buckets are measured by the values in their sketches, of which a task may hold `values`.
    The best of STARS members is linked with all that lie within `most` of it. Of the others, only those within 2 * most of the
    star can lie within `most` of one of its neighbours, so just these meet the neighbours, in blocks; and the others
    are a bucket of their own, smaller by the neighbours. Where no tried member has a quarter of its bucket for
    neighbours, all blocks of the bucket meet in pairs. No pair within `most` is lost, and each round leaves 3/4 at most.
    Members meet stars by plain joins, which Spark broadcasts where the stars are few and splits where a bucket is hot.
    """
    half = max(1, values // 2)
    lot = F.pmod(F.xxhash64("id"), F.lit(STARS))
    star = F.min(F.struct((F.size("sketch") > STAR_VALUES).alias("long"), "id", "sketch"))  # a long text is no star if others are there
    tried = members.groupBy("bucket", lot.alias("lot")).agg(star.alias("star"))
    tried = staged(tried.select(F.col("bucket").alias("of"), F.col("star.id").alias("star"), F.col("star.sketch").alias("middle")), "stars")
    d, weight = apart(F.col("sketch"), F.col("middle")), F.greatest(F.size("sketch"), F.lit(1)).cast("long")
    met = members.join(tried, F.col("bucket") == F.col("of")).select("of", "star", d.alias("d"), weight.alias("w"))
    near, far = F.sum(F.when(F.col("d") <= most, F.col("w")).otherwise(0)), F.sum(F.when((F.col("d") > most) & (F.col("d") <= 2 * most), F.col("w")).otherwise(0))
    counts = met.groupBy("of", "star").agg(near.alias("near"), far.alias("fringe"), F.sum("w").alias("n"))
    best = counts.groupBy(F.col("of").alias("b")).agg(F.max(F.struct("near", "star", "fringe", "n")).alias("best")).select("b", "best.*").withColumnRenamed("star", "s")
    best = staged(best.join(tried, (F.col("b") == F.col("of")) & (F.col("s") == F.col("star"))).select("of", "star", "middle", "near", "fringe", "n"), "best-stars")
    placed = staged(members.join(best, F.col("bucket") == F.col("of")).select("bucket", "id", "sketch", "star", "near", "fringe", "n", d.alias("d")), "placed")

    def block(count):
        return F.pmod(F.xxhash64("id", F.lit(1)), count)

    def every(count):
        return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))

    crowd, k, m = F.col("near") * 4 >= F.col("n"), F.ceil(F.col("fringe") / half), F.ceil(F.col("near") / half)
    star = placed.filter(crowd)
    links = star.filter((F.col("d") <= most) & (F.col("id") != F.col("star"))).select(F.col("star").alias("a"), F.col("id").alias("b"))
    rest = star.filter(F.col("d") > most).select(F.xxhash64("bucket", F.lit("rest")).alias("bucket"), "id", "sketch")
    inner = star.filter((F.col("d") <= most) & (F.col("fringe") > 0)).select("bucket", "id", "sketch", every(k).alias("i"), block(m).alias("j"))
    outer = star.filter((F.col("d") > most) & (F.col("d") <= 2 * most)).select("bucket", "id", "sketch", block(k).alias("i"), every(m).alias("j"))
    parts = F.ceil(F.col("n") / half)
    loose = placed.filter(~crowd).select("bucket", "id", "sketch", block(parts).alias("own"), every(parts).alias("other")).filter("own != other")
    loose = loose.select("bucket", "id", "sketch", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    pairs = inner.union(outer).union(loose).select(F.xxhash64("bucket", "i", "j").alias("bucket"), "id", "sketch")
    return links, pairs, rest


def _grouped_links(members: DataFrame, apart, most: float, search, values: int) -> DataFrame:
    """Links (a, b) that connect whatever pairs connect which share a bucket and lie within `most`. members: bucket long, id long, sketch array<long>."""

    def searched(some: DataFrame) -> DataFrame:
        return some.select("bucket", "id", "sketch").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(search, "a long, b long")

    found: list[DataFrame] = []
    while True:
        sizes = members.groupBy(F.col("bucket").alias("of")).agg(F.sum(F.greatest(F.size("sketch"), F.lit(1))).alias("n"))
        large = staged(sizes.filter(F.col("n") > values).select("of"), "large")
        if large.isEmpty():
            return functools.reduce(DataFrame.union, found, searched(members))
        found.append(searched(members.join(large, F.col("bucket") == F.col("of"), "left_anti")))
        held = staged(members.join(large, F.col("bucket") == F.col("of"), "left_semi"), "large-buckets")
        links, pairs, rest = _stars(held, apart, most, values)
        found += [links, searched(pairs)]
        members = staged(rest, "rest")


def banded_links(items: DataFrame, most: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect whatever pairs connect which share a band and differ in at most `most` bits of their sketches.

    items: id long (distinct), bands array<long> (equal values meet), sketch array<long>. Buckets of over bucket_rows are
    taken apart by _stars, however many items have equal bands.
    """
    bucket_rows = max(bucket_rows, 2)
    sketches = items.select(F.col("id").alias("of"), "sketch")
    placed = items.select(F.explode("bands").alias("bucket"), F.lit(0).cast("long").alias("path"), "id")
    together = staged(placed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared(bucket_rows), "bucket long, path long, id long, large boolean"), "buckets")
    joined = together.join(sketches, F.col("id") == F.col("of")).select("bucket", "id", "sketch", "large")
    small = joined.filter("not large").drop("large").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_search(most), "a long, b long")
    if together.filter("large").isEmpty():
        return small
    held = staged(joined.filter("large").drop("large"), "large-buckets")
    return small.union(_grouped_links(held, _bits_apart, most, _search(most), bucket_rows * SKETCH_PARTS))


def _set_forest(ids: np.ndarray, values: np.ndarray, first: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Links that connect all rows which a Jaccard similarity of at least that much connects; row i's set is values[first[i]:first[i + 1]].

    Breadth first, over an index of the sets' rarest values: of two similar sets the larger has a common value among its rarest `probe` ones that is among
    the smaller one's rarest `index` ones. So sets that merely share frequent values, as filled-in templates do, never meet. A row leaves the
    lists of the index when it is found.
    """
    sizes, base = np.diff(first), first - first[0]
    n = len(sizes)
    empty = np.flatnonzero(sizes == 0)
    yield from ((int(ids[empty[0]]), int(ids[k])) for k in empty[1:])
    of = np.repeat(np.arange(n), sizes)
    _, value, count = np.unique(values[first[0] : first[-1]], return_inverse=True, return_counts=True)
    rarity = np.argsort(np.argsort(count, kind="stable"), kind="stable")
    count = np.sort(count, kind="stable")  # by rarity
    value = rarity[value]
    value = value[np.lexsort((value, of))]
    place = np.arange(len(value)) - base[of]
    probe = (sizes - np.ceil(similarity * sizes - SLACK) + 1).astype(np.int64)
    index = (sizes - np.ceil(2 * similarity / (1 + similarity) * sizes - SLACK) + 1).astype(np.int64)
    lists: list[dict[int, np.ndarray]] = []
    for prefix in (probe, index):
        some = (place < prefix[of]) & (count[value] > 1)
        by = np.argsort(value[some], kind="stable")
        key, row = value[some][by], of[some][by]
        edges = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        lists.append(dict(zip(key[edges].tolist(), np.split(row, edges[1:]), strict=False)))
    left = np.ones(n, bool)
    left[empty] = False

    def sharing(held: dict[int, np.ndarray], wanted: np.ndarray) -> list[np.ndarray]:
        found = []
        for v in wanted.tolist():
            if (rows := held.get(v)) is not None:
                held[v] = rows = rows[left[rows]]
                found.append(rows)
        return found

    for start in np.flatnonzero(sizes):
        if not left[start]:
            continue
        left[start] = False
        queue = [int(start)]
        while queue:
            at = queue.pop()
            own = value[base[at] : base[at + 1]]
            met = sharing(lists[1], own[: probe[at]]) + sharing(lists[0], own[: index[at]])
            others = np.unique(np.concatenate(met)) if met else np.empty(0, np.int64)
            # Sets of too different sizes can't be that similar.
            others = others[np.minimum(sizes[others], len(own)) >= similarity * np.maximum(sizes[others], len(own)) - SLACK]
            if not len(others):
                continue
            ends = np.cumsum(sizes[others])
            all_values = value[np.arange(ends[-1]) + np.repeat(base[others] - ends + sizes[others], sizes[others])]
            same = own[np.minimum(np.searchsorted(own, all_values), len(own) - 1)] == all_values
            common = np.add.reduceat(same.astype(np.int64), ends - sizes[others])
            for other in others[common >= similarity * (len(own) + sizes[others] - common) - SLACK].tolist():
                yield int(ids[at]), int(ids[other])
                left[other] = False
                queue.append(other)


def _search_sets(similarity: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of rows (bucket, id, sorted set), sorted by bucket."""
        held: list[tuple[np.ndarray, ...]] = []

        def links(bucket, ids, sizes, values) -> Iterator[pa.RecordBatch]:
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            first = np.concatenate([[0], np.cumsum(sizes)])
            pairs: list[tuple[int, int]] = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a > 1:
                    pairs.extend(_set_forest(ids[a:b], values, first[a : b + 1], similarity))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), sizes, lists.flatten().to_numpy()))
            if held[0][0][0] == held[-1][0][-1]:
                continue  # all of one bucket so far
            bucket, ids, sizes, values = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1
            cut = int(sizes[:last].sum())
            yield from links(bucket[:last], ids[:last], sizes[:last], values[:cut])
            held = [(bucket[last:], ids[last:], sizes[last:], values[cut:])]
        if held:
            yield from links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return search


def _rooted(members: DataFrame, items: DataFrame, links: DataFrame) -> DataFrame:
    """members (key, ...) with component_id: the smallest doc_id over all items of the component. items: id, doc_id."""
    roots = connected_components(links)
    linked = items.join(roots, items["id"] == roots["node"], "left").select("id", "doc_id", F.coalesce("root", "id").alias("root"))
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "of_root")
    known = linked.join(least, F.col("root") == F.col("of_root")).select(F.col("id").alias("of"), "component_id")
    return members.join(known, F.col("id") == F.col("of")).drop("of")


def fingerprint_components(docs: DataFrame, words: int = 3, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp (signed 64-bit fingerprint), component_id per row: components of fingerprints within `radius` bits.

    A null text has no words; texts without words have fingerprint zero, which is linked like any other. Rows with one
    fingerprint are one node. Repeated rows and repeated ids each keep their row. A null doc_id never names a component
    unless the component has no other. An empty table gives an empty one. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = shingle_simhash(batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "id"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    members = staged(read.mapInArrow(run, "doc_id long, id long"), "fingerprints")
    items = staged(members.groupBy("id").agg(F.min("doc_id").alias("doc_id")), "distinct-fingerprints")
    links = covering_links(items.select("id", F.array("id").alias("fps"), F.array("id").alias("sketch")), radius, radius, bucket_rows)
    return _rooted(members, items, links).select("doc_id", F.col("id").alias("fp"), "component_id")


def likeness_bits(similarity: float, parts: int = SKETCH_PARTS, deviations: float = 3.3) -> int:
    """Differing bits of shingle sketches up to which texts of at least this Jaccard similarity stay, with a margin of that many standard deviations."""
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    n = 64 * parts
    return int(np.floor(n * p + deviations * np.sqrt(n * p * (1 - p))))


def covering_keys(fps: np.ndarray, shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(n, keys) of rows with SimHashes fps and sets shingles[first[i]:first[i + 1]]; of empty sets, equal ones.

    A key for each covering mask of the SimHash at RADIUS, and, as a similarity of 0.8 lies beyond that, for each covering mask of GROUPS groups of minima
    at GROUP_RADIUS: the places of a group are masked as the bits of a fingerprint are, and rows that differ in up to GROUP_RADIUS minima of a group share a key for certain.
    """
    out = [mix(mix(fps & np.uint64(mask)) ^ mix(np.array([-1 - v], np.int64).view(np.uint64))) for v, mask in enumerate(covering_masks((1 << 64) - 1))]
    some = np.flatnonzero(np.diff(first))
    places = _ODD.shape[1]
    masks = covering_masks((1 << places) - 1, GROUP_RADIUS)
    for i, odds in enumerate(_ODD):
        least = [mix(np.minimum.reduceat(shingles * odd, first[some])) for odd in odds] if len(some) else []
        for v, mask in enumerate(masks):
            key = np.full(len(some), 1 + i * len(masks) + v, np.uint64)
            for p in range(places):
                if len(some) and mask >> p & 1:
                    key = mix(key ^ least[p])
            out.append(np.zeros(len(first) - 1, np.uint64))
            out[-1][some] = key
    return np.stack(out, axis=1)


def _shingles(block, words: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """The distinct shingles of a block's rows, sorted in each row, where each row's begin, and two hashes of each word sequence."""
    h, first = block.hashes(), block.first
    doc = block.doc_of()
    whole = span_hashes(h, first[:-1], first[1:]), span_hashes(mix(h), first[:-1], first[1:])
    grams = window_hashes(h, words)
    own = doc[: len(grams)] == doc[words - 1 :] if len(grams) else np.empty(0, bool)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < words))
    shingles = np.concatenate([grams[own], whole[0][short]])
    of = np.concatenate([doc[: len(grams)][own], short])
    order = np.lexsort((shingles, of))
    shingles, of = shingles[order], of[order]
    fresh = np.ones(len(of), bool)  # a shingle counts once
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
    return shingles[fresh], np.searchsorted(of[fresh], np.arange(len(block) + 1)), whole


def near_duplicate_sketches(texts: pa.Array, words: int = 5, parts: int = SKETCH_PARTS) -> Iterator[tuple[np.ndarray, ...]]:
    """By block: two hashes of the word sequence, (n, keys) covering keys of its set of shingles, (n, parts) fingerprints of it."""
    for block in blocks(texts, SPACED, lower=True):
        shingles, first, whole = _shingles(block, words)
        sketch = np.stack([simhash(mix(shingles ^ mix(np.array([s + 101], np.uint64))), first) for s in range(parts)], axis=1)
        yield *whole, covering_keys(sketch[:, 0], shingles, first), sketch


def shingle_sets(texts: pa.Array, words: int = 5) -> Iterator[pa.Array]:
    """By block: the sorted set of shingle hashes of each text, signed."""
    for block in blocks(texts, SPACED, lower=True):
        shingles, first, _ = _shingles(block, words)
        signed = shingles.view(np.int64)
        order = np.lexsort((signed, np.repeat(np.arange(len(block)), np.diff(first))))
        yield pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(signed[order]))


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS, values: int = SET_VALUES) -> DataFrame:
    """The rows of docs, all columns, of which one stays for each group of near copies: the one with the smallest id.

    Candidates are texts that share a bucket of the covering masks of their SimHash or of their minima (see covering_keys), which misses four in a million
    pairs at a similarity of 0.8 and fewer above, wherever the texts differ, and whose SimHashes are as close as those of texts of the
    given similarity (see likeness_bits). Texts that candidates connect are then compared by their whole sets of shingles:
    a link needs that Jaccard similarity exactly, and groups are the components of links. Texts with the same words are
    one node; texts without words, null among them, are copies of one another. A row with a null id stays only
    if its group has no other. Different texts under one id are rows of their own; of rows equal in id and text one stays.
    An empty table stays empty.
    """
    names = {c.lower() for c in docs.columns}
    key, mark, mark_id = (next(f"{c}_{i}" for i in range(len(names) + 1) if f"{c}_{i}" not in names) for c in ("near_key", "near_mark", "near_id"))
    text_key = F.xxhash64(F.col(text_col).cast("string"))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key.alias("key"), F.col(text_col).cast("string").alias("text"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for h1, h2, bands, sketch in near_duplicate_sketches(batch.column(2), words):
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in (bands, sketch)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(h1)), batch.column(1).slice(at, len(h1)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *lists], ["doc_id", "key", "h1", "h2", "bands", "sketch"])
                at += len(h1)

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for sets in shingle_sets(batch.column(2), words):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), batch.column(1).slice(at, len(sets)), sets], ["bucket", "id", "sketch"])
                at += len(sets)

    members = staged(read.mapInArrow(sketched, "doc_id long, key long, h1 long, h2 long, bands array<long>, sketch array<long>"), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    copies = members.groupBy("h1", "h2").agg(first, F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    items = staged(copies.select(F.monotonically_increasing_id().alias("id"), "first", "bands", "sketch"), "distinct-texts")
    rough = connected_components(banded_links(items.select("id", "bands", "sketch"), likeness_bits(similarity), bucket_rows))
    # Each text that has candidates travels once, to the others that they connect it with.
    named = rough.join(items.select("id", "first"), F.col("node") == F.col("id")).select(F.col("root").alias("bucket"), "id", F.col("first.doc_id").alias("of"), F.col("first.key").alias("of_key"))
    texts = read.join(named, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))).select("bucket", "id", "text")
    sets = staged(texts.mapInArrow(shingled, "bucket long, id long, sketch array<long>"), "shingle-sets")
    links = _grouped_links(sets, _sets_apart, 1 - similarity + SLACK, _search_sets(similarity), values)
    rooted = staged(connected_components(links).join(items.select("id", "first"), F.col("node") == F.col("id")).select("id", "root", "first"), "rooted")
    best = rooted.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("best"))
    gone = rooted.join(best, F.col("root") == F.col("of")).filter("first != best").select(F.col("id").alias("gone"))
    stay = staged(items.select("id", "first").join(gone, F.col("id") == F.col("gone"), "left_anti").select(F.col("first.doc_id").alias(mark_id), F.col("first.key").alias(mark)), "stay")
    # Always by shuffle: what stays is most of the rows and never a small side.
    kept = docs.withColumn(key, text_key).join(stay.hint("merge"), F.col(id_col).cast("long").eqNullSafe(F.col(mark_id)) & (F.col(key) == F.col(mark)), "left_semi")
    repeated = not members.groupBy("doc_id", "key").count().filter("count > 1").isEmpty()
    return (kept.dropDuplicates([id_col, key]) if repeated else kept).drop(key)
