"""Many terms found in one pass over each text, by an Aho-Corasick automaton as arrays.

The automaton is built once on the driver from a lexicon of bounded size and travels with the tasks. In a task the texts of an Arrow batch
are cut into lanes of LANE bytes, which overlap by the longest term less one byte, and all lanes take a step together: a step
is one look-up in the table of transitions. So long and short texts take equal time a byte, whatever the number of terms.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import matched

#: Bytes of a lane, and lanes that step together.
LANE, LANES = 512, 8_192
#: Terms up to which a test a term, in the plan itself, is as fast.
FEW_TERMS = 64
#: Transitions of one automaton, 4 bytes each; a larger lexicon is dealt to several automata.
MOST_TRANSITIONS = 1 << 24


class Automaton:
    """Which of the terms occur in byte strings. Terms are told by their place in the given order; an empty term is in every text."""

    def __init__(self, terms: Sequence[str]) -> None:
        coded = [t.encode() for t in terms]
        self.n = len(coded)
        self.longest = max(map(len, coded), default=0)
        self.empty = [i for i, t in enumerate(coded) if not t]
        used = sorted({b for t in coded for b in t})
        self.classes = np.zeros(256, np.int32)  # class 0: bytes in no term
        self.classes[used] = np.arange(1, len(used) + 1)
        children: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for i, term in enumerate(coded):
            state = 0
            for c in self.classes[list(term)].tolist():
                if c not in children[state]:
                    children[state][c] = len(children)
                    children.append({})
                    ends.append([])
                state = children[state][c]
            if term:
                ends[state].append(i)
        self.table = np.zeros((len(children), len(used) + 1), np.int32)
        fail, waiting = [0] * len(children), deque([0])
        while waiting:
            state = waiting.popleft()
            if state:
                self.table[state] = self.table[fail[state]]
            for c, child in children[state].items():
                fail[child] = int(self.table[state, c]) if state else 0
                self.table[state, c] = child
                waiting.append(child)
                ends[child] += ends[fail[child]]  # a shorter state, so complete already
        self.first = np.concatenate([[0], np.cumsum([len(e) for e in ends])])
        self.found = np.array([i for e in ends for i in e], np.int64)
        self.reports = np.diff(self.first) > 0

    def rows_and_terms(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, term) pairs, sorted, of rows of bytes data[offsets[i]:offsets[i + 1]]."""
        sizes = np.diff(offsets)
        lanes = np.maximum(1, -(-sizes // LANE))
        row = np.repeat(np.arange(len(sizes)), lanes)
        start = offsets[row] + LANE * (np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        end = np.minimum(start + LANE + self.longest - 1, offsets[row + 1])
        codes = self.classes[data]
        rows, states = [], []
        order = np.argsort(start - end, kind="stable")  # longest lanes first: those that still run are a prefix
        for k in range(0, len(order), LANES):
            part = order[k : k + LANES]
            at, left, state = start[part], (end - start)[part], np.zeros(len(part), np.int32)
            for step in range(int(left[0]) if len(part) else 0):
                n = int(np.searchsorted(-left, -step, "left"))
                state = self.table[state[:n], codes[at[:n] + step]]
                hit = np.flatnonzero(self.reports[state])
                if len(hit):
                    rows.append(row[part[hit]])
                    states.append(state[hit])
        seen = np.unique(np.concatenate([r * len(self.table) + x for r, x in zip(rows, states, strict=True)])) if rows else np.empty(0, np.int64)
        each, state = np.divmod(seen, len(self.table))
        count = self.first[state + 1] - self.first[state]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[state], count)
        keys = [np.repeat(each, count) * self.n + self.found[place], *(np.arange(len(sizes)) * self.n + i for i in self.empty)]
        return np.divmod(np.unique(np.concatenate(keys)), max(1, self.n))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)), at - at[0]


def _automata(terms: Sequence[str]) -> list[tuple[int, Automaton]]:
    """Automata of consecutive terms, each within the bound on transitions, and the place of its first term."""
    width = 1 + len({b for t in terms for b in t.encode()})
    made, start, size = [], 0, 1
    for i, term in enumerate(terms):
        more = len(term.encode())
        if i > start and (size + more) * width > MOST_TRANSITIONS:
            made.append((start, Automaton(terms[start:i])))
            start, size = i, 1
        size += more
    return [*made, (start, Automaton(terms[start:]))]


def find_terms(texts: DataFrame, lists: Mapping[str, Sequence[str]], text_col: str = "Cleaned_Text", lower: bool = False, few: int = FEW_TERMS) -> DataFrame:
    """texts with an array column for each list of terms: those that occur in the text or, with `lower`, in its lower-case form too, in the list's order.

    Up to `few` terms are tested one by one in the plan; more go through automata, in one pass over each text. Null texts and empty lists give empty arrays, a term given twice is
    found twice. Other columns stay; one of a list's name is replaced.
    """
    terms = list(dict.fromkeys(t for words in lists.values() for t in words))
    if len(terms) <= few:
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        return texts.withColumns({name: matched(text, tuple(words), F.lower(text) if lower else None) if words else F.array().cast("array<string>") for name, words in lists.items()})
    place = {t: i for i, t in enumerate(terms)}
    wanted = {name: np.array([place[t] for t in words], np.int64) for name, words in lists.items()}
    automata = _automata(terms)
    names = np.array(terms, object)
    kept = [c for c in texts.columns if c not in lists]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            pairs = [(rows, found + start) for column in batch.columns[len(kept) :] for start, automaton in automata for rows, found in [automaton.rows_and_terms(*_bytes(column))]]
            rows, found = np.divmod(np.unique(np.concatenate([r * len(terms) + t for r, t in pairs])), len(terms))
            columns = []
            for places in wanted.values():
                order = np.argsort(places, kind="stable")
                low, high = np.searchsorted(places[order], found, "left"), np.searchsorted(places[order], found, "right")
                count = high - low
                which = order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
                of = np.repeat(rows, count)
                sort = np.lexsort((which, of))
                columns.append(pa.ListArray.from_arrays(np.searchsorted(of[sort], np.arange(n + 1)).astype(np.int32), pa.array(names[places[which[sort]]], pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], [*kept, *lists])

    text = F.col(text_col).cast("string")
    read = texts.select(*[f"`{c}`" for c in kept], text.alias("terms_text"), *([F.lower(text).alias("terms_lower")] if lower else []))
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[: len(kept)]), *(f"`{name}` array<string>" for name in lists)])
    return read.mapInArrow(run, ddl)
