"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed runs of 1 to ORDERS letters, word edges included; everything that is no letter counts as one edge.
A document's weights are relative frequencies times inverse document frequencies, the latter from all labelled training
documents. The model is fitted by follow-the-regularised-leader with an elastic net on a bounded sample of them, and a
temperature, found on a part of the sample that the fit did not see, calibrates its probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.words import mix, row_blocks, text_bytes

ORDERS = 3
BITS = 15
#: Labelled documents of each language that the model is fitted on, at most. Document frequencies use all.
FIT_ROWS = 600
#: Languages that are learned, at most; a table with more is an error.
MOST_LANGUAGES = 400
UNDETERMINED = "und"
#: Relative frequencies are small numbers; scaling them lets one set of learning rates serve.
SCALE = 40.0

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point its lower-case letter, or 32."""
    if not _LETTERS:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(table)
    return _LETTERS[0]


def features(texts: pa.Array, most: int = 300_000) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By block of rows: first row, hashed features one after another, their rows, and whether a row has a letter."""
    data, offsets = text_bytes(texts)
    for a, b in row_blocks(offsets, most):
        raw, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        starts = lead[at]
        points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        c = letters()[np.minimum(points, 0x10FFFF)]
        row = np.repeat(np.arange(b - a), np.diff(starts))
        # Each row gets an edge before and after it; runs of edges become one.
        spot = np.arange(len(c)) + 2 * row + 1
        line = np.full(len(c) + 2 * (b - a), 32, np.uint64)
        line[spot] = c
        of = np.repeat(np.arange(b - a), np.diff(starts) + 2)
        fresh = np.ones(len(line), bool)
        fresh[1:] = (line[1:] != 32) | (line[:-1] != 32) | (of[1:] != of[:-1])
        line, of = line[fresh], of[fresh]
        found, rows = [], []
        for n in range(1, ORDERS + 1):
            if len(line) < n:
                continue
            key = np.full(len(line) - n + 1, n, np.uint64)
            for k in range(n):
                key = key * np.uint64(0x9E3779B97F4A7C15) + line[k : len(line) - n + 1 + k]
            own = of[: len(key)] == of[n - 1 :]
            own &= (line[: len(key)] != 32) if n == 1 else True
            found.append((mix(key[own]) >> np.uint64(64 - BITS)).astype(np.int64))
            rows.append(of[: len(key)][own])
        feats, of = np.concatenate(found), np.concatenate(rows)
        order = np.argsort(of, kind="stable")
        yield a, feats[order], of[order], np.bincount(row[c != 32], minlength=b - a) > 0


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (features, labels), times inverse document frequencies
    bias: np.ndarray
    temperature: float

    def probabilities(self, feats: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        counts = np.bincount(of, minlength=n)
        sums = np.zeros((n, len(self.labels)))
        if len(feats):
            has = np.flatnonzero(counts)
            sums[has] = np.add.reduceat(self.weights[feats], (np.cumsum(counts) - counts)[has], axis=0, dtype=np.float64)
        return softmax((SCALE * sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)

    def predict(self, texts: pa.Array) -> Iterator[tuple[list[str], np.ndarray]]:
        for _, feats, of, lettered in features(texts, max(20_000, 2_400_000 // max(8, len(self.labels)))):
            p = self.probabilities(feats, of, len(lettered)) if self.labels else np.zeros((len(lettered), 1))
            best = p.argmax(axis=1)
            known = lettered & bool(self.labels)
            yield [self.labels[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, p.max(axis=1), 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_labels: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after some passes of FTRL-proximal over (feature ids, values, label). l1 and l2 form the elastic net; the bias goes without."""
    z, n = np.zeros((n_features, n_labels)), np.zeros((n_features, n_labels))
    zb, nb = np.zeros(n_labels), np.zeros(n_labels)
    rng = np.random.default_rng(11)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for k in rng.permutation(len(rows)).tolist():
            at, x, label = rows[k]
            w = weights(z[at], n[at])
            wb = -zb / ((beta + np.sqrt(nb)) / alpha)
            error = softmax(x @ w + wb)
            error[label] -= 1
            g = x[:, None] * error
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
            zb += error - (np.sqrt(nb + error * error) - np.sqrt(nb)) / alpha * wb
            nb += error * error
    return weights(z, n), -zb / ((beta + np.sqrt(nb)) / alpha)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, between 0.05 and 20. Without rows, 1."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Learns from rows with text and lang; others are passed over. With no such rows the model knows no language.

    Counts of documents and document frequencies are taken over all rows. The fit uses at most about fit_rows rows a
    language, those whose hash of the text is lowest against the language's share, and copies once, so that reruns agree. Up to
    MOST_LANGUAGES languages are learned; more are an error.
    """
    rows = labelled.select(F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    names = sorted(counts)
    if not names:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 1.0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for _, feats, of, _ in features(batch.column(0)):
                pairs = np.unique(of << BITS | feats)
                seen += np.bincount(pairs & (1 << BITS) - 1, minlength=1 << BITS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["feature", "df"])

    df = np.zeros(1 << BITS)
    for r in rows.select("text").mapInArrow(frequencies, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df")).collect():  # at most 2 ** BITS rows
        df[r.feature] = r.df
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 1

    share = F.lit(0.0)
    for lang in names:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, fit_rows / counts[lang]))).otherwise(share)
    # Copies of a text share its hash; they count once, so that a text that is everywhere neither fills the sample nor decides who is in it.
    chosen = rows.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).groupBy("h", "lang").agg(F.min("text").alias("text")).select("text", "lang", "h")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, feats, of, lettered in features(batch.column(0)):
                ids, values = [], []
                for i in range(len(lettered)):
                    at, n = np.unique(feats[np.searchsorted(of, i) : np.searchsorted(of, i, "right")], return_counts=True)
                    ids.append(at.astype(np.uint16).tobytes())
                    values.append((n / max(1, n.sum())).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, len(lettered)), batch.column(2).slice(a, len(lettered)), pa.array(ids, pa.binary()), pa.array(values, pa.binary())], ["lang", "h", "ids", "tf"])

    index = {lang: k for k, lang in enumerate(names)}
    fit, check = [], []
    bound = 2 * fit_rows * len(names) + 100
    got = chosen.mapInArrow(vectors, "lang string, h long, ids binary, tf binary").orderBy("h", "lang").limit(bound).collect()
    sampled = Counter(r.lang for r in got)
    for r in got:
        at = np.frombuffer(r.ids, np.uint16).astype(np.int64)
        if len(at):
            row = at, SCALE * np.frombuffer(r.tf, np.float32) * idf[at], index[r.lang]
            (check if (r.h >> 32) % 5 == 0 and sampled[r.lang] >= 20 else fit).append(row)
    weights, bias = fit_ftrl(fit, 1 << BITS, len(names))
    logits = np.array([x @ weights[at] + bias for at, x, _ in check]).reshape(-1, len(names))
    return Model(names, (weights * idf[:, None]).astype(np.float32), bias, fit_temperature(logits, np.array([k for *_, k in check], int)))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with two more columns: the language and its calibrated probability.

    A text that is null, empty or without a letter, or a model without languages, gives `und` and 0. Whole texts are
    read, and no other column. Output names that docs has already are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in (lang_out.lower(), score_out.lower())]
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for lang, score in shared.value.predict(batch.column(at).cast(pa.string())):
                part = batch.slice(done, len(lang))
                done += len(lang)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score)], [*part.schema.names, "l", "s"])

    read = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    ddl = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(read.schema.fields))
    out = read.mapInArrow(run, f"{ddl}, l string, s double")
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns) if c in kept], F.col("l").alias(lang_out), F.col("s").alias(score_out))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 4, is 2. A null id is not kept."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, with its columns alone, whose language is determined with at least the given probability."""
    names = {c.lower() for c in docs.columns}
    lang, score = (next(f"{w}_{i}" for i in range(len(names) + 1) if f"{w}_{i}" not in names) for w in ("lang", "score"))
    found = predict(docs, model, text_col, lang, score)
    return found.filter((F.col(lang) != UNDETERMINED) & (F.col(score) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
