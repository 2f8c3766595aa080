"""Removing passages that occur earlier in the corpus, by suffix automata.

Two forms. `remove_reference_passages` takes a bounded reference text: its shards' suffix automata are broadcast and every
document streams past each of them, which gives the length of the longest match that ends at each word; where that is
at least the threshold, the matched words go.

`remove_earlier_passages` takes the corpus itself as the reference. Broadcasting an automaton of every shard to every
document would cost shards times documents, so here the fragments travel to the shards instead. Each window
of `window` words belongs to one anchor, the least hash among the runs of ANCHOR_WORDS words in it: equal windows have equal
anchors. The windows of one document that share an anchor form a fragment; fragments meet by anchor, in order of document and
place, and stream past the suffix automaton of the fragments before them, whose symbols are the windows. Matched spans are
removed, unmatched ones are added. Anchors with too many fragments for one task are found beforehand, and their windows never come together:
they are judged one by one, against pre-aggregated minima. So is, from its stream, an anchor whose fragments lie too thinly to be found so.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.storage import staged
from skein.llm.words import SPACED, Block, blocks, mix, span_hashes, window_hashes

ANCHOR_WORDS = 10
#: Fragments of one anchor that one task streams; anchors with more are judged window by window.
SHARD_FRAGMENTS = 20_000
#: Fragments of an anchor in one task's rows from which on it is counted; anchors with over SHARD_FRAGMENTS in all, the most frequent
#: HOT_ANCHORS of them, never come together in one task.
HOT_IN_TASK, HOT_ANCHORS = 8, 100_000
#: Words of reference text in one broadcast automaton.
SHARD_WORDS = 200_000


class SuffixAutomaton:
    """Accepts every run of symbols of the sequences added so far. A sequence never continues another."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, symbols: Sequence) -> None:
        last = 0
        for symbol in symbols:
            last = self._extend(last, symbol)

    def _extend(self, last: int, symbol) -> int:
        follow, link, length = self.next, self.link, self.length
        if (q := follow[last].get(symbol)) is not None:
            return q if length[q] == length[last] + 1 else self._split(last, symbol, q)
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in follow[p]:
            follow[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = follow[p][symbol]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
        return new

    def _split(self, p: int, symbol, q: int) -> int:
        follow, link, length = self.next, self.link, self.length
        copy = len(follow)
        follow.append(dict(follow[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and follow[p].get(symbol) == q:
            follow[p][symbol] = copy
            p = link[p]
        return copy

    def matching_statistics(self, symbols: Sequence) -> list[int]:
        """For each place, the length of the longest run ending there that was added before."""
        state, size, out = 0, 0, []
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state, size = self.next[state][symbol], size + 1
            else:
                size = 0
            out.append(size)
        return out


def matched_spans(statistics: Sequence[int], least: int) -> list[tuple[int, int]]:
    """Maximal spans covered by matches of at least `least` symbols."""
    out: list[tuple[int, int]] = []
    for end, size in enumerate(statistics, 1):
        if size >= least:
            start = end - size
            while out and start <= out[-1][1]:
                start = min(start, out.pop()[0])
            out.append((start, end))
    return out


def _kept(block: Block, row: int, spans: Sequence[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Words, removed words, and the kept words joined by a space."""
    a, b = int(block.first[row]), int(block.first[row + 1])
    keep = np.ones(b - a, bool)
    for s, e in spans:
        keep[s:e] = False
    at = np.flatnonzero(keep) + a
    whole, base = block.data[block.offsets[row] : block.offsets[row + 1]].tobytes(), int(block.offsets[row])
    text = b" ".join([whole[s:e] for s, e in zip((block.starts[at] - base).tolist(), (block.ends[at] - base).tolist(), strict=True)])
    return b - a, b - a - len(at), text


def remove_reference_passages(docs: DataFrame, references: Iterable[str | None], window: int = 50, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: texts without words that lie in a match of `window` or more words with a reference text.

    References are cut into shards of at most shard_words words (or one text). One shard's automaton is broadcast at a time, with a pass
    over the documents that writes the spans it matches. A null or empty text has no words and is kept as "". Other columns are not read.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = _shards(references, shard_words)
    first, second = next(shards, []), next(shards, None)
    if second is None:
        shared = spark.sparkContext.broadcast(_automaton(first))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                yield _without(batch, (matched_spans(automaton.matching_statistics(words), window) for words in _words_of(batch.column(1))))

        return read.mapInArrow(cut, KEPT)
    rows = staged(read.withColumn("row", F.monotonically_increasing_id()), "reference-rows")

    def spans_of(shard: list[list[bytes]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(_automaton(shard))

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                found = [(r, a, b) for r, words in zip(batch.column(0).to_pylist(), _words_of(batch.column(1)), strict=True) for a, b in matched_spans(automaton.matching_statistics(words), window)]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["of", "start", "end"])

        out = staged(rows.select("row", "text").mapInArrow(match, "of long, start int, end int"), "reference-spans")
        shared.destroy()  # one automaton at a time
        return out

    spans = functools.reduce(DataFrame.union, [spans_of(shard) for shard in itertools.chain([first, second], shards)])
    by_row = spans.groupBy("of").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _without(batch, ([(s["start"], s["end"]) for s in own or ()] for own in batch.column(2).to_pylist()))

    return rows.join(by_row, F.col("row") == F.col("of"), "left").select("doc_id", "text", "spans").mapInArrow(apply, KEPT)


KEPT = "doc_id long, n_words long, n_removed long, kept_text string"


def _shards(references: Iterable[str | None], shard_words: int) -> Iterator[list[list[bytes]]]:
    """The words of the references in parts of at most shard_words words, or one text."""
    shard: list[list[bytes]] = []
    n = 0
    for text in references:
        words = [w.encode() for w in _split(text or "")]
        if shard and n + len(words) > shard_words:
            yield shard
            shard, n = [], 0
        if words:
            shard.append(words)
            n += len(words)
    if shard:
        yield shard


def _automaton(shard: list[list[bytes]]) -> SuffixAutomaton:
    automaton = SuffixAutomaton()
    for words in shard:
        automaton.add(words)
    return automaton


def _words_of(texts: pa.Array) -> Iterator[list[bytes]]:
    for block in blocks(texts, SPACED):
        for i in range(len(block)):
            yield block.joined(i).split(b" ") if block.first[i + 1] > block.first[i] else []


def _without(batch: pa.RecordBatch, spans: Iterable[list[tuple[int, int]]]) -> pa.RecordBatch:
    """doc_id and text of each row, without its spans of words."""
    rows, each = [], iter(spans)
    for block in blocks(batch.column(1), SPACED):
        for i in range(len(block)):
            n, removed, text = _kept(block, i, next(each))
            rows.append((n, removed, text.decode()))
    return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_words", "n_removed", "kept_text"])


def _split(text: str) -> list[str]:
    return [w for w in text.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]


def fragments(block: Block, window: int) -> tuple[np.ndarray, ...]:
    """Of each fragment: row, anchor hash, place of its first window in the row, bounds in the last array: the 64-bit hash of each window."""
    h, doc = block.hashes(), block.doc_of()
    grams = window_hashes(h, min(ANCHOR_WORDS, window))
    whole = window_hashes(h, window)
    n, choices = len(whole), len(grams) - len(whole) + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, np.zeros(1, np.int64), none
    offset = np.lib.stride_tricks.sliding_window_view(grams, choices).argmin(axis=1)
    at = np.flatnonzero(doc[:n] == doc[window - 1 :])
    anchor = at + offset[at]
    symbols = whole[at].view(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)])) if len(at) else np.empty(0, np.int64)
    row = doc[at[starts]]
    return row, grams[anchor[starts]].view(np.int64), at[starts] - block.first[row], np.append(starts, len(at)), symbols


def remove_earlier_passages(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", shard_fragments: int = SHARD_FRAGMENTS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text per row: texts without the words of windows that start earlier too.

    Earlier is a smaller id, or the same id and an earlier start. Windows are judged on the input. Null texts are empty.
    Rows that share an id, and null ids (first of all), are put in order by a hash of the text, and equal texts by chance:
    all but one of several equal rows lose their windows. An empty table gives none. Other columns are not read.
    """
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    repeats = read.select("doc_id").groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1")
    if repeats.isEmpty():
        rows = read.withColumn("rid", F.col("doc_id"))
    else:
        ordered = read.withColumn("tie", F.xxhash64("text")).repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        rows = staged(ordered.select("doc_id", "text", F.monotonically_increasing_id().alias("rid")), "numbered")

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        """By block: row id, anchor, start and bounds of the fragments, symbols, and which fragment is the block's first of its kind."""
        rid = batch.column(0).to_numpy()
        for block in blocks(batch.column(1), SPACED):
            row, anchor, start, bounds, symbols = fragments(block, window)
            if len(row):
                # Equal fragments of one block: all but the first go at once, so that a frequent passage costs a row a block.
                same = mix(span_hashes(mix(symbols.view(np.uint64)), bounds[:-1], bounds[1:]) ^ anchor.view(np.uint64))
                own = rid[block.row + row]
                order = np.lexsort((start, own, same))
                first = np.ones(len(row), bool)
                first[order[1:]] = same[order[1:]] != same[order[:-1]]
                yield own, anchor, start, bounds, symbols, first

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors of several fragments of a task's rows, and how many these are."""
        anchors, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[np.ndarray] = []

        def counted() -> tuple[np.ndarray, np.ndarray]:
            values, of = np.unique(np.concatenate([anchors, *held]), return_inverse=True)
            return values, np.bincount(of, np.concatenate([counts, np.ones(len(of) - len(counts), np.int64)]), len(values)).astype(np.int64)

        for batch in batches:
            held += [anchor[first] for _, anchor, _, _, _, first in parts(batch)]
            if sum(map(len, held)) > 2_000_000:
                anchors, counts = counted()
                held = []
                anchors, counts = anchors[counts > 1], counts[counts > 1]
        anchors, counts = counted()
        some = counts >= HOT_IN_TASK
        yield pa.RecordBatch.from_arrays([pa.array(anchors[some]), pa.array(counts[some])], ["anchor", "n"])

    texts = rows.select("rid", "text")
    totals = texts.mapInArrow(often, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") > shard_fragments)
    hot = np.array(sorted(r.anchor for r in totals.orderBy(F.desc("n"), "anchor").limit(HOT_ANCHORS).collect()), np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, anchor, start, bounds, symbols, first in parts(batch):
                # 8 bytes a window: in an anchor of many fragments only they tell windows apart
                sizes = np.diff(bounds)
                stays = ~first | ~np.isin(anchor, hot)
                packed = symbols.astype("<i8")[np.repeat(first & stays, sizes)]
                at = np.concatenate([[0], np.cumsum(8 * np.where(first, sizes, 0)[stays])]).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), int(stays.sum()), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(packed.tobytes())])
                key = np.where(first, anchor, mix(own.view(np.uint64)).view(np.int64))
                end = pa.array((start + sizes).astype(np.int32)[stays], mask=first[stays])
                yield pa.RecordBatch.from_arrays([pa.array(key[stays]), pa.array(own[stays]), pa.array(start.astype(np.int32)[stays]), end, blob], ["anchor", "rid", "start", "end", "windows"])

    def loose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of hot anchors, one by one."""
        for batch in batches:
            for own, anchor, start, bounds, symbols, first in parts(batch):
                sizes = np.diff(bounds)
                some = first & np.isin(anchor, hot)
                each, of = np.repeat(some, sizes), np.repeat(np.arange(len(sizes)), sizes)
                place = (start[of] + np.arange(len(of)) - bounds[of])[each]
                yield pa.RecordBatch.from_arrays([pa.array(anchor[of][each]), pa.array(own[of][each]), pa.array(place.astype(np.int32)), pa.array(symbols[each])], ["anchor", "rid", "start", "symbol"])

    def unpack(blob: bytes) -> list[int]:
        return np.frombuffer(blob, "<i8").tolist()

    schema = "rid long, start int, end int, anchor long, windows binary"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input sorted by anchor, rid, start. Gives (rid, start, end) of removed windows; those given already pass, and distinct fragments of large anchors go on as they are."""
        arrow = pa.schema([("rid", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("anchor", pa.int64()), ("windows", pa.binary())])
        out: list[tuple] = []
        group: list[tuple[int, int, bytes]] = []
        current, large, seen = None, False, set()

        def stream(group) -> Iterator[tuple]:
            automaton, known = SuffixAutomaton(), set()
            for rid, start, blob in group:
                if blob in known:
                    yield rid, start, start + len(blob) // 8, None, None
                    continue
                known.add(blob)
                symbols = unpack(blob)
                spans = matched_spans(automaton.matching_statistics(symbols), 1)
                for a, b in spans:
                    yield rid, start + a, start + b, None, None
                if spans != [(0, len(symbols))]:
                    automaton.add(symbols)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in out], arrow)
            out.clear()
            return batch

        for batch in batches:
            done = batch.column(3).is_valid()
            if done.true_count:
                gone = batch.filter(done)
                yield pa.RecordBatch.from_arrays([gone.column(1), gone.column(2), gone.column(3), pa.nulls(len(gone), pa.int64()), pa.nulls(len(gone), pa.binary())], schema=arrow)
                batch = batch.filter(batch.column(3).is_null())
            anchors = batch.column(0).to_numpy()
            if not len(anchors):
                continue
            # Most anchors stand alone in the batch: only their runs are looked at, and the first and last of the batch.
            edges = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1], [True]]))
            sizes = np.diff(edges)
            look = np.flatnonzero(sizes > 1)
            look = np.unique(np.concatenate([[0], look, [len(sizes) - 1]]))
            rid, start, blobs = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(4)
            for k in look.tolist():
                a, b = int(edges[k]), int(edges[k + 1])
                if anchors[a] != current:
                    if len(group) > 1:
                        out.extend(stream(group))
                    group, current, large, seen = [], anchors[a], False, set()
                rows = list(zip(rid[a:b].tolist(), start[a:b].tolist(), blobs.slice(a, b - a).to_pylist(), strict=True))
                group.extend(rows)
                if large or len(group) > shard_fragments:
                    large = True
                    for r, s, w in group:
                        if w in seen:  # an equal fragment came before
                            out.append((r, s, s + len(w) // 8, None, None))
                            continue
                        if len(seen) < shard_fragments:
                            seen.add(w)
                        out.append((r, s, None, int(current), w))
                    group = []
                if len(out) > 20_000:
                    yield flush()
        if len(group) > 1:
            out.extend(stream(group))
        yield flush()

    pieces = texts.mapInArrow(cut, "anchor long, rid long, start int, end int, windows binary")
    judged = staged(pieces.repartition("anchor").sortWithinPartitions("anchor", "rid", "start").mapInArrow(judge, schema), "repeated")
    removed = judged.filter("end IS NOT NULL").select("rid", "start", "end")
    large = judged.filter("end IS NULL")

    def later(single: DataFrame) -> DataFrame:
        """Windows (anchor, rid, start, symbol) that are not the first of their kind; minima are pre-aggregated."""
        earliest = single.groupBy("anchor", "symbol").agg(F.min(F.struct("rid", "start")).alias("least")).withColumnsRenamed({"anchor": "a", "symbol": "s"})
        met = single.join(earliest, (F.col("anchor") == F.col("a")) & (F.col("symbol") == F.col("s")))
        return met.filter(F.struct("rid", "start") > F.col("least")).selectExpr("rid", "start", "start + 1 AS end")

    if len(hot):
        removed = removed.union(later(staged(texts.mapInArrow(loose, "anchor long, rid long, start int, symbol long"), "hot-windows")))
    if not large.isEmpty():
        each = large.selectExpr("rid", "anchor", "start AS first", "explode(sequence(0, CAST(length(windows) / 8 AS INT) - 1)) AS k", "windows")
        removed = removed.union(later(each.selectExpr("anchor", "rid", "first + k AS start", "substring(windows, 8 * k + 1, 8) AS symbol")))
    spans = removed.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans")).withColumnRenamed("rid", "of")
    joined = rows.join(spans, rows["rid"] == spans["of"], "left").select("doc_id", "text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            for block in blocks(batch.column(1), SPACED):
                done = []
                for i in range(len(block)):
                    own = spans[block.row + i].as_py() or ()
                    done.append(_kept(block, i, [(s["start"], s["end"] + window - 1) for s in own]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.row, len(block)), *(pa.array([r[k] for r in done], t) for k, t in enumerate((pa.int64(), pa.int64()))), pa.array([r[2].decode() for r in done], pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_text string")

