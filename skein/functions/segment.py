"""A segmenter for Chinese text: the likeliest cut by a dictionary of words with counts, and a hidden Markov model for what is in no word."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.lexicon import DEFAULT, Lexicon

_RUNS = re.compile(r"[\u4e00-\u9fff]+|[A-Za-z0-9]+(?:[.%_+#&-][A-Za-z0-9]+)*|\s+|.", re.S)


#: Begin, middle and end of a word, and a word of one character; which state may follow which.
STATES = "BMES"
FOLLOW = {"B": "ME", "M": "ME", "E": "BS", "S": "BS"}


@dataclass(frozen=True)
class HiddenWords:
    """A hidden Markov model over the places of characters in words. Costs are negative logarithms of probabilities.

    start and move have a cost for each state and each pair of states that may follow one another; emit one for each state and character, and
    unseen one for each state and any other character.
    """

    start: Mapping[str, float]
    move: Mapping[str, float]
    emit: Mapping[str, float]
    unseen: Mapping[str, float]

    @classmethod
    def of_counts(cls, start: Mapping[str, int], move: Mapping[str, int], emit: Mapping[str, int], smooth: float = 1.0) -> "HiddenWords":
        """From counts by state, pair of states, and state and character; `smooth` is added to each count, so that nothing is impossible."""
        letters = len({k[1:] for k in emit}) + 1

        def cost(n: float, total: float) -> float:
            return math.log(total / n)

        def emitted(state: str) -> float:
            return sum(n for k, n in emit.items() if k[0] == state) + smooth * letters

        firsts = sum(start.get(s, 0) + smooth for s in "BS")
        totals = {s: emitted(s) for s in STATES}
        return cls(
            {s: cost(start.get(s, 0) + smooth, firsts) for s in "BS"},
            {a + b: cost(move.get(a + b, 0) + smooth, sum(move.get(a + x, 0) + smooth for x in FOLLOW[a])) for a in STATES for b in FOLLOW[a]},
            {k: cost(n + smooth, totals[k[0]]) for k, n in emit.items()},
            {s: cost(smooth, totals[s]) for s in STATES},
        )

    def cost(self, run: str, states: str) -> float:
        """The cost of a run of characters with their states; infinite if the states can't follow one another or don't end a word."""
        if states[-1] not in "ES":
            return math.inf
        total = self.start.get(states[0], math.inf)
        for a, b in zip(states, states[1:], strict=False):
            total += self.move.get(a + b, math.inf)
        return total + sum(self.emit.get(s + c, self.unseen[s]) for s, c in zip(states, run, strict=True))

    def cut(self, run: str) -> list[str]:
        """The words of least cost (Viterbi); among equals the earlier state in BMES goes first."""
        if not run:
            return []
        best = {s: self.start.get(s, math.inf) + self.emit.get(s + run[0], self.unseen[s]) for s in STATES}
        back: list[dict[str, str]] = []
        for c in run[1:]:
            came = {s: min((p for p in STATES if s in FOLLOW[p]), key=lambda p: best[p] + self.move[p + s]) for s in STATES}
            best = {s: best[p] + self.move[p + s] + self.emit.get(s + c, self.unseen[s]) for s, p in came.items()}
            back.append(came)
        state = min("ES", key=best.__getitem__)
        words, end = [], len(run)
        for i in range(len(run) - 1, -1, -1):
            if state in "BS":
                words.append(run[i:end])
                end = i
            if i:
                state = back[i - 1][state]
        return words[::-1]


HAN = r"[\x{4E00}-\x{9FFF}]+"
#: Bytes of words that are counted at once.
PIECE_BYTES = 1_000_000


def _place_counts(words: pa.Array, row: np.ndarray, letters: str) -> pa.RecordBatch:
    """kind, key, n of words, each with its text's number."""
    some = pc.fill_null(pc.greater(pc.binary_length(words), 0), False)
    row, coded = row[some.to_numpy(zero_copy_only=False)], words.filter(some).dictionary_encode()
    # Each distinct word is matched once.
    spelt = pc.match_substring_regex(coded.dictionary, f"^(?:{letters})$").to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
    at = np.flatnonzero(spelt)
    words = coded.dictionary.take(coded.indices.filter(pa.array(spelt)))
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(sizes)
    first = ends - sizes
    state = np.ones(len(chars), np.int64)  # places in STATES
    state[first], state[ends - 1] = 0, 2
    state[first[sizes == 1]] = 3
    before = np.concatenate([[4], state])[: len(state)]
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) != 1) | (np.diff(row[at]) != 0)
    before[first[begins]] = 4
    emits, moves = np.bincount(chars * 4 + state), np.bincount(before * 4 + state)
    rows = [("emit", STATES[k % 4] + chr(k // 4), int(emits[k])) for k in np.flatnonzero(emits).tolist()]
    rows += [("start", STATES[k % 4], int(moves[k])) if k >= 16 else ("move", STATES[k // 4] + STATES[k % 4], int(moves[k])) for k in np.flatnonzero(moves).tolist()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((), (), ()), (pa.string(), pa.string(), pa.int64()), strict=True)], ["kind", "key", "n"])


def hidden_counts(tokens: DataFrame, tokens_col: str = "Tokens", letters: str = HAN) -> DataFrame:
    """kind, key, n: what a table of texts cut into words says about places in words, with partial sums before the shuffle.

    start counts the states that runs begin with, move pairs of states, emit states with their character. A word of other characters than
    `letters`, a regular expression without look-around, ends a run, as do both ends of a text; null and empty words don't count. Texts are counted as arrays, some at a time, so that
    no row is made for a letter.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            counts, words = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), lists.flatten()
            first = np.concatenate([[0], np.cumsum(counts)])
            size = np.concatenate([[0], np.cumsum(pc.binary_length(words).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)])[first]
            start = 0
            while start < len(counts):
                end = max(start + 1, int(np.searchsorted(size, size[start] + PIECE_BYTES, "right")) - 1)
                yield _place_counts(words.slice(first[start], first[end] - first[start]), np.repeat(np.arange(start, end), counts[start:end]), letters)
                start = end

    return tokens.select(F.col(tokens_col).cast("array<string>")).mapInArrow(counted, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def fit_hidden_words(tokens: DataFrame, tokens_col: str = "Tokens", smooth: float = 1.0, letters: str = HAN) -> HiddenWords:
    """The model of a table of texts that are cut into words. Only the counts come to the driver, which the alphabet bounds."""
    counts: dict[str, dict[str, int]] = {"start": {}, "move": {}, "emit": {}}
    for r in hidden_counts(tokens, tokens_col, letters).collect():
        counts[r.kind][r.key] = r.n
    return HiddenWords.of_counts(**counts, smooth=smooth)


class DictionaryCutter:
    """Cuts text into words, a function of text to be given as `cut`. It's small and travels with the tasks.

    Runs of Chinese characters are cut into the words of greatest probability, that is of the largest product of relative counts; a character that
    is in no word counts as seen once. With `hidden`, neighbouring characters that stay single, and together are no word, are cut again by that
    model, which finds words outside the list. Runs of letters and digits are one word, white space and other characters stand alone.
    """

    def __init__(self, words: Mapping[str, int] | Iterable[str], hidden: HiddenWords | None = None):
        counts = dict(words) if isinstance(words, Mapping) else dict.fromkeys(words, 100)
        self.counts = {w: n for w, n in counts.items() if w and n > 0}
        self.hidden = hidden

    @classmethod
    def of_lexicon(cls, lexicon: Lexicon = DEFAULT, more: Mapping[str, int] | Iterable[str] = (), hidden: HiddenWords | None = None) -> "DictionaryCutter":
        """With every term of a lexicon, and more words."""
        lists = (lexicon.color, lexicon.material, lexicon.fit, lexicon.function, lexicon.scenario, lexicon.general, lexicon.positive, lexicon.negative, lexicon.negative_single, lexicon.weight_negative, lexicon.weight_negative_single, *(words for _, words in lexicon.pain_rules))
        own = {w: 100 for terms in lists for w in terms}
        return cls(own | (dict(more) if isinstance(more, Mapping) else dict.fromkeys(more, 100)), hidden)

    @cached_property
    def _costs(self) -> dict[str, float]:
        total = sum(self.counts.values()) or 1
        return {w: math.log(total / n) for w, n in self.counts.items()}

    @cached_property
    def _trie(self) -> dict:
        """A node for each beginning of a word; a node's cost under the empty string, where a word ends."""
        root: dict = {}
        for word, cost in self._costs.items():
            node = root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = cost
        return root

    @cached_property
    def _unknown(self) -> float:
        return math.log(max(2, sum(self.counts.values()) + 1))

    def _cut(self, run: str) -> list[str]:
        n = len(run)
        best: list[tuple[float, int]] = [(0.0, n)] * (n + 1)  # least cost of each end of the run, and where its first word ends
        for start in range(n - 1, -1, -1):
            node, end = self._trie.get(run[start]), start + 1
            found = [((node or {}).get("", self._unknown) + best[end][0], -end)]
            while node and end < n and (node := node.get(run[end])):
                end += 1
                if "" in node:
                    found.append((node[""] + best[end][0], -end))
            cost, end = min(found)
            best[start] = (cost, -end)
        words, start = [], 0
        while start < n:
            words.append(run[start : best[start][1]])
            start = best[start][1]
        return words

    def _again(self, words: list[str]) -> Iterable[str]:
        """The words, with rows of single characters that are no word together cut by the hidden model."""
        singles: list[str] = []
        for word in [*words, None]:
            if word is not None and len(word) == 1:
                singles.append(word)
                continue
            run = "".join(singles)
            yield from self.hidden.cut(run) if len(run) > 1 and run not in self.counts else singles
            singles = []
            if word is not None:
                yield word

    def _words(self, run: str) -> Iterable[str]:
        return self._cut(run) if self.hidden is None else self._again(self._cut(run))

    def __call__(self, text: str) -> list[str]:
        return [w for run in _RUNS.findall(text) for w in (self._words(run) if "\u4e00" <= run[0] <= "\u9fff" else [run])]
