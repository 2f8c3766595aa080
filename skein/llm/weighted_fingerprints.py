"""Document fingerprints by consistent weighted sampling.

The terms of a text are its runs of five words (the whole of a shorter text), weighted by how often they occur. Sample
k of a term of weight S draws r and c from gamma distributions of shape 2 and b from the unit interval, all keyed by
term and k, takes t = floor(ln S / r + b), y = exp(r * (t - b)), a = c / (y * exp(r)), and the text's sample is the (term, t)
of the least a. Two texts' samples agree with the probability of their generalised Jaccard similarity.

The draws are made from three uniform numbers u1, u2, u3: a1 = -ln u1 and b1 = -ln u2 give c = a1 + b1; r is the sum of
ln(c / a1) and -ln u3, and b the latter's part of r. All have the distributions asked for, and for S = 1, that is for most
terms, a is a1 itself, so that the largest u1 wins and nothing else needs to be drawn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.words import SPACED, blocks, mix, span_hashes, window_hashes

SAMPLES = 128
WORDS = 5
#: Bytes of text in a range of ids, on average, at most.
RANGE_BYTES = 128_000_000
#: Ids sampled for each range, to balance the ranges.
RANGE_SAMPLE = 20
#: The least id, which stands for null.
NO_ID = -(1 << 63)

_rng = np.random.default_rng(97)
_FACTORS = _rng.integers(0, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 64, 1024, dtype=np.uint64)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def weighted_samples(u1: np.ndarray, u2: np.ndarray, u3: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a and t of terms of the given weights."""
    a1, b1 = -np.log(u1), -np.log(u2)
    c = a1 + b1
    whole, part = np.log(c / a1), -np.log(u3)
    r = whole + part
    b = part / r
    t = np.floor(np.log(weight) / r + b)
    return c * np.exp(-r * (t - b) - r), t.astype(np.int64)


def signatures(texts: pa.Array, samples: int = SAMPLES, words: int = WORDS) -> np.ndarray:
    """(n, samples) 16-bit samples and, in a last column, 1 for texts that have words."""
    found = [np.empty((0, samples + 1), np.uint16)]
    for block in blocks(texts, SPACED):
        h, doc, n = block.hashes(), block.doc_of(), len(block)
        grams = window_hashes(h, words)
        own = doc[: len(grams)] == doc[words - 1 :] if len(grams) else np.empty(0, bool)
        counts = np.diff(block.first)
        short = np.flatnonzero((counts > 0) & (counts < words))
        terms = np.concatenate([grams[own], span_hashes(h, block.first[short], block.first[short + 1])])
        of = np.concatenate([doc[: len(grams)][own], short])
        _, at, weight = np.unique(mix(terms ^ mix(of.astype(np.uint64))), return_index=True, return_counts=True)
        order = np.argsort(of[at], kind="stable")
        terms, of, weight = terms[at[order]], of[at[order]], weight[order]
        out = np.zeros((n, samples + 1), np.uint16)
        out[counts > 0, samples] = 1
        light, heavy = weight == 1, weight > 1
        x, of_x = terms[light], of[light]
        z, of_z, w = terms[heavy], of[heavy], weight[heavy].astype(float)
        rows_x, first_x = np.unique(of_x, return_index=True)
        rows_z, first_z = np.unique(of_z, return_index=True)
        for k in range(samples):
            factor, shift = _FACTORS[k], _SHIFTS[k]
            winner, best, step = np.zeros(n, np.uint64), np.full(n, np.inf), np.zeros(n, np.int64)
            if len(rows_x):
                top = np.maximum.reduceat(x * factor + shift, first_x)
                winner[rows_x], best[rows_x] = top, -np.log(_uniform(top))
            if len(rows_z):
                u1 = z * factor + shift
                a, t = weighted_samples(_uniform(u1), _uniform(mix(u1 ^ _FACTORS[k + 512])), _uniform(mix(u1 ^ _SHIFTS[k + 512])), w)
                least = np.minimum.reduceat(a, first_z)
                at_least = np.flatnonzero(a == np.repeat(least, np.diff(np.append(first_z, len(z)))))
                row, pick = np.unique(of_z[at_least], return_index=True)
                better = least < best[rows_z]
                winner[row[better]], step[row[better]] = u1[at_least[pick]][better], t[at_least[pick]][better]
            # A sample's value stands for its term, as both u1 and mix are one-to-one.
            out[:, k] = (mix(winner ^ mix(step.astype(np.uint64) + np.uint64(k))) & np.uint64(0xFFFF)).astype(np.uint16)
        out[counts == 0] = 0
        found.append(out)
    return np.concatenate(found)


def written(signature: np.ndarray) -> list[str]:
    """Signatures as strings of hex digits, four a sample; a text without words has the empty string."""
    return [row[:-1].astype(">u2").tobytes().hex() if row[-1] else "" for row in signature]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row: 1 for two texts without words, 0 if one of them has none."""
    same = (a[:, :-1] == b[:, :-1]).mean(axis=1)
    return np.where((a[:, -1] == 1) & (b[:, -1] == 1), same, (a[:, -1] == b[:, -1]).astype(float))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """doc_id and fingerprint of every row; a null text is an empty one, whose fingerprint is the empty string. Nothing is shuffled."""
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(written(signatures(batch.column(1), samples)), pa.string())], ["doc_id", "fingerprint"])

    return read.mapInArrow(run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _cuts(keys: DataFrame, rows: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, g) that cut keys into about so many ranges. g matters for ids alone that would fill more than one range."""
    share = min(1.0, RANGE_SAMPLE * ranges / max(1, rows))

    def sampled(some: DataFrame, *columns: str) -> list[np.ndarray]:
        table = some.select(*columns).sample(share, seed=5).toArrow()
        return [table.column(c).to_numpy() for c in columns]

    (ids,) = sampled(keys, "i")
    step = max(1, len(ids) // ranges)
    at, often = np.unique(np.sort(ids)[step - 1 :: step], return_counts=True)
    hot = at[often > 1]
    if not len(hot):
        return at, np.full(len(at), NO_ID)
    i, g = sampled(keys.filter(F.col("i").isin(hot.tolist())), "i", "g")
    order = np.lexsort((g, i))
    i, g = i[order][::step], g[order][::step]
    i, g = np.concatenate([at[often == 1], i]), np.concatenate([np.full(int((often == 1).sum()), NO_ID), g])
    order = np.lexsort((g, i))
    return i[order], g[order]


def _range_of(cut_i: np.ndarray, cut_g: np.ndarray, i: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Number of cuts at or below each (i, g)."""
    low, high = np.searchsorted(cut_i, i, "left"), np.searchsorted(cut_i, i, "right")
    out = low.copy()
    for k in np.unique(low[low < high]).tolist():
        at = (low == k) & (high > k)
        out[at] = k + np.searchsorted(cut_g[k : int(high[at][0])], g[at], "right")
    return out.astype(np.int64)


def _own_partitions(spark, n: int) -> np.ndarray:
    """For each of n partitions a number that Spark's hash puts there."""
    tried = spark.range(20 * n + 200).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("at")).groupBy("at").agg(F.min("id").alias("id")).toArrow()
    out = np.arange(n) - n  # numbers for what no tried one met
    out[tried.column("at").to_numpy()] = tried.column("id").to_numpy()
    return out


def compare_with_next(docs: DataFrame, part: float = 3, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row: fingerprints of its text and of an edited text, and likenesses to the edited and to the next text.

    The next text is that of the next smaller id, after the smallest that of the largest; rows of one id follow one another
    by a hash of the text, null ids come last. The edited text has its last floor(n / part) code points replaced by the
    first as many of the next text. Null texts are empty. A table of one row has itself as next; an empty table gives none.

    Ids are cut into ranges of at most RANGE_BYTES, and an id that fills several by the hash of its texts, at values sampled for balance
    alone; only rows equal in id and text can't be parted. One shuffle brings each range into a partition of its own, with the
    first row of the range after it sent along; no row waits for more than its successor.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("i"), F.bitwise_not(F.xxhash64(text)).alias("g"), text.alias("text"))
    stats = keys.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_ranges = ranges or max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(stats.bytes or 0) // RANGE_BYTES))
    cut_i, cut_g = _cuts(keys, stats.n, n_ranges) if stats.n else (np.empty(0, np.int64), np.empty(0, np.int64))
    split = bool((cut_g != NO_ID).any())
    place = _own_partitions(spark, len(cut_i) + 1)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, g = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_range_of(cut_i, cut_g, i, g)), *batch.columns], ["p", "i", "g"])

    top = (
        keys.select("i", "g" if split else F.lit(0).cast("long").alias("g")).mapInArrow(numbered, "p long, i long, g long")
        .groupBy("p").agg(F.max(F.struct("i", "g")).alias("top")).orderBy(F.desc("p")).collect()
    )  # a row for each range
    # Of each range's first row, the range above, and for the highest the lowest.
    heads = {(r.top.i, r.top.g): top[k - 1].p for k, r in enumerate(top)}
    head_ids = np.array(sorted({i for i, _ in heads}), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, g = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            p = _range_of(cut_i, cut_g, i, g)
            yield pa.RecordBatch.from_arrays([pa.array(place[p]), pa.array(p), pa.array(np.zeros(len(p), bool)), *batch.columns], ["at", "p", "head", "i", "g", "text"])
            to = [(k, heads[key]) for k in np.flatnonzero(np.isin(i, head_ids)).tolist() if (key := (int(i[k]), int(g[k]) if split else 0)) in heads]
            if to:
                above = np.array([x for _, x in to], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(place[above]), pa.array(above), pa.array([True] * len(to)), *batch.take(pa.array([k for k, _ in to])).columns], ["at", "p", "head", "i", "g", "text"])

    dealt = keys.mapInArrow(deal, "at long, p long, head boolean, i long, g long, text string")
    ordered = dealt.repartition(len(place), "at").sortWithinPartitions("p", "head", F.desc("i"), F.desc("g")).select("p", "head", "i", "text")

    def compare(rows: list[tuple[int, bool, int, str]]) -> pa.RecordBatch:
        """Of each row but the last, if the one after it is of its range."""
        texts = [r[3] for r in rows]
        use = [k for k in range(len(rows) - 1) if rows[k][0] == rows[k + 1][0] and not rows[k][1]]
        edited = [texts[k][: len(texts[k]) - int(len(texts[k]) // part)] + texts[k + 1][: int(len(texts[k]) // part)] for k in use]
        sig, sig_edited = signatures(pa.array(texts, pa.string())), signatures(pa.array(edited, pa.string()))
        own, after = sig[use], sig[[k + 1 for k in use]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None if rows[k][2] == NO_ID else rows[k][2] for k in use], pa.int64()), pa.array([len(texts[k]) for k in use], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array(written(own), pa.string()), pa.array(written(sig_edited), pa.string()), pa.array(likeness(own, sig_edited)), pa.array(likeness(own, after)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bool, int, str]] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[3])
                if size > 1_000_000 and len(held) > 1:
                    yield compare(held)
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield compare(held)

    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
