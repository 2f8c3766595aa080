"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over whole training texts."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.storage import staged
from skein.llm.words import ALNUM, blocks, window_hashes

#: Words of benchmark items in one broadcast; a larger benchmark is scanned in several passes.
BROADCAST_WORDS = 100_000
WINDOW = 13


class GramSet:
    """The windows of some items, by length: sorted hashes, their words for verification, and the items that hold them."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        found: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
        for i, (_, words) in enumerate(items):
            k = min(window, len(words))
            for at in range(len(words) - k + 1 if k else 0):
                found.setdefault(k, {}).setdefault(tuple(words[at : at + k]), set()).add(i)
        self.by_length = {}
        for k, grams in found.items():
            keys = list(grams)
            text = b" ".join(w for g in keys for w in g)
            block = next(blocks(pa.array([text.decode("utf-8", "surrogatepass")]), ALNUM, most=len(text) + 1))
            hashes = window_hashes(block.hashes(), k)[::k]
            order = np.argsort(hashes, kind="stable")
            self.by_length[k] = (hashes[order], [keys[j] for j in order.tolist()], [sorted(grams[keys[j]]) for j in order.tolist()])

    def hits(self, hashes: np.ndarray, words_of) -> Iterator[tuple[int, int, list[int]]]:
        """Place, length and item numbers of every window that occurs among hashed words; words_of(place, k) gives the words to verify."""
        for k, (keys, grams, holders) in self.by_length.items():
            seen = window_hashes(hashes, k)
            for at in np.flatnonzero(np.isin(seen, keys)).tolist():
                j = int(np.searchsorted(keys, seen[at]))
                words = None
                while j < len(keys) and keys[j] == seen[at]:
                    words = words_of(at, k) if words is None else words
                    if words == grams[j]:
                        yield at, k, holders[j]
                    j += 1


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", most_words: int = BROADCAST_WORDS, window: int = WINDOW) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in parts of at most most_words words, one part at a time. Of a longer item each part has a piece; pieces overlap, so that no window is cut."""
    part: list[tuple[str | None, list[bytes]]] = []
    n, step = 0, max(most_words, 2 * window)
    for row in benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).filter("t is not null").toLocalIterator():
        block = next(blocks(pa.array([row.t]), ALNUM, lower=True, most=1 << 40))
        words = [block.data[s:e].tobytes() for s, e in zip(block.starts.tolist(), block.ends.tolist(), strict=True)]
        for a in range(0, max(1, len(words) - window + 1), step - window + 1) if words else ():
            piece = words[a : a + step]
            if part and n + len(piece) > most_words:
                yield part
                part, n = [], 0
            part.append((row.i, piece))
            n += len(piece)
    if part:
        yield part


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans merged where they touch or overlap, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(texts: pa.Array, grams: GramSet) -> Iterator[tuple[int, int, list[tuple[int, int]], list[str]]]:
    """For each text: its row, number of words, merged word spans that are hit, names of items whose windows occur."""
    for block in blocks(texts, ALNUM, lower=True):
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[int]] = {}
        doc = block.doc_of()

        def words_of(at: int, k: int, block=block) -> tuple[bytes, ...]:
            return tuple(block.data[s:e].tobytes() for s, e in zip(block.starts[at : at + k].tolist(), block.ends[at : at + k].tolist(), strict=True))

        for at, k, holders in grams.hits(block.hashes(), words_of):
            if doc[at] == doc[at + k - 1]:
                row, first = int(doc[at]), int(block.first[doc[at]])
                spans.setdefault(row, []).append((at - first, at - first + k))
                items.setdefault(row, set()).update(holders)
        counts = np.diff(block.first).tolist()
        for row, n in enumerate(counts):
            yield block.row + row, n, covered(spans.get(row, [])), [grams.names[i] for i in items.get(row, ()) if grams.names[i] is not None]


RESULT = "n_words long, hit_spans array<struct<start:int,end:int>>, items array<string>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per document: doc_id, the carried columns as they are, n_words, hit_spans (merged word spans inside an occurrence of a benchmark window), items (ids of the items whose windows occur, sorted).

    Words are runs of digits, ASCII letters and non-ASCII bytes, A-Z lower-cased. An item with fewer words than a window
    is one window. Hash hits are verified on the words. A null or empty text has no words and no hits; items without words
    are passed over; the words that an item without an id hits count, but it has no name among the items; repeated rows are judged
    alike, and so are items that share an id. Only the named columns are read.
    Up to BROADCAST_WORDS benchmark words travel as one broadcast; beyond it, one pass over the documents is made and
    written for each part and the parts' hits are merged by row, so that neither the driver nor a worker holds more than one part.
    """
    spark: SparkSession = docs.sparkSession
    parts = benchmark_items(benchmark, item_col, "text", window=window)
    first, second = next(parts, []), next(parts, None)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"c_{i}") for i, c in enumerate(carry) if c != text_col])
    if second:
        chosen = staged(chosen.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    keep = [f for f in chosen.schema.fields if f.name != "text" or text_col in carry]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [RESULT])

    def one_pass(shared) -> DataFrame:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            for batch in (b.slice(a, 1000) for b in batches for a in range(0, len(b), 1000)):
                found = list(scan(batch.column("text"), grams))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f.name) for f in keep), pa.array([n for _, n, _, _ in found], pa.int64()), pa.array([[{"start": a, "end": b} for a, b in s] for _, _, s, _ in found], spans_type), pa.array([sorted(set(i)) for _, _, _, i in found], pa.list_(pa.string()))],
                    [*(f.name for f in keep), "n_words", "hit_spans", "items"],
                )

        return chosen.mapInArrow(run, ddl)

    def written(part: list[tuple[str | None, list[bytes]]], hits_only: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(GramSet(part, window))
        found = one_pass(shared)
        out = staged(found.filter("size(hit_spans) > 0").select("row", "hit_spans", "items") if hits_only else found, "contamination")
        shared.destroy()
        return out

    if second:
        done = written(first, False)
        more = [written(part, True) for part in itertools.chain([second], parts)]
        hits = functools.reduce(DataFrame.union, more).groupBy(F.col("row").alias("r")).agg(F.flatten(F.collect_list("hit_spans")).alias("s"), F.flatten(F.collect_list("items")).alias("i"))
        done = done.join(hits, done["row"] == hits["r"], "left")
        spans = "array<struct<start:int,end:int>>"
        merged = F.aggregate(
            F.array_sort(F.concat("hit_spans", F.coalesce("s", F.array().cast(spans)))),
            F.array().cast(spans),
            lambda acc, x: F.when((F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["end"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x))),
        )
        done = done.withColumn("hit_spans", merged).withColumn("items", F.array_sort(F.array_union("items", F.coalesce("i", F.array().cast("array<string>"))))).drop("r", "s", "i")
    else:
        done = one_pass(spark.sparkContext.broadcast(GramSet(first, window)))
    own = {c: "text" if c == text_col else f"c_{i}" for i, c in enumerate(carry)}
    return done.select("doc_id", *[F.col(n).alias(c) for c, n in own.items()], "n_words", "hit_spans", "items")


def n_hit():
    """Number of hit words, as an expression over hit_spans."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]).cast("long"))


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the given word spans (and what stands between them)."""
    block = next(blocks(pa.array([text]), ALNUM, lower=True, most=1 << 40))
    raw, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(raw[at : block.starts[a]])
        at = int(block.ends[b - 1])
    return (b"".join([*out, raw[at:]])).decode()


def contaminated(share: int = 20):
    """Whether at least one word in `share` is hit, as an expression over hit_spans and n_words."""
    return (n_hit() > 0) & (share * n_hit() >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of docs, all columns, that are not contaminated."""
    names = [f"k{i}" for i in range(len(docs.columns))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    low = [c.lower() for c in docs.columns]
    found = find_contamination(renamed, benchmark, window, names[low.index(id_col.lower())], names[low.index(text_col.lower())], item_col, tuple(names))
    return found.filter(~contaminated()).select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
