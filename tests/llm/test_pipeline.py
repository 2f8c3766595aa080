"""The pipeline, stage by stage, against brute force."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from skein.llm import storage
from tests.llm.test_operators import SPACED, brute_contamination


def shingles(text):
    w = SPACED.findall(text.lower())
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = storage.staged(stage(spark, docs, sf), name)
        seen.append(docs)
    languages, unique, clean, mixed, records = seen
    assert all(x.columns == ["doc_id", "text", "lang", "source", "n_chars"] for x in seen[:-1])
    assert {r.doc_id for r in languages.collect()} == set(before)  # every document is in a language
    kept = {r.doc_id for r in unique.collect()}
    sets = {i: shingles(r.text) for i, r in before.items()}
    want = {i: i for i in before}
    for i in before:
        for j in before:
            if j < i and want[i] != want[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((want[i], want[j]))
                want = {k: low if w == high else w for k, w in want.items()}
    assert kept == set(want.values()) and len(kept) < len(before)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, n, h, _ in brute_contamination([(i, before[i].text) for i in kept], items) if h and 20 * h >= n}
    assert {r.doc_id for r in clean.collect()} == kept - bad and bad
    rows = sorted(r.doc_id for r in mixed.collect())
    assert set(rows) <= kept - bad and max(rows.count(i) for i in set(rows)) <= 3
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for i, r in zip(rows, records.orderBy("start").collect(), strict=True):
        ids = [*tokenizer.encode(before[i].text, add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_empty_and_registered(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = storage.staged(stage(spark, docs, sf), name)
    assert docs.count() == 0
    names = entry.queries()
    assert "pipeline" in names and [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)] == [1] * 13


def test_stages_on_odd_rows(spark, sf):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns named like those that stages make."""
    real = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    long = " ".join(f"word{i % 977} and" for i in range(20_000))
    rows = [(None, None, None, None, None), (900, None, "en", "a", 0), (901, "", None, None, None), (902, " \t", "fr", "b", 2), (None, "no id here at all, but some words", None, None, 3), (903, long, "en", "a", 9), (904, "two words", "en", "b", 9), (904, "two words", "en", "b", 9), (904, "quite another text under the same id", None, "b", 9), (-1, "a text of the least id that is legal", "en", "é", 1)]
    docs = real.unionByName(spark.createDataFrame(rows, real.schema))
    for name in ("size", "source_key", "turn", "bucket", "tie", "row", "position", "score", "lang_pred", "near_key_0", "sketch", "id", "key", "passes", "rank", "words", "items", "hit_spans"):
        docs = docs.withColumn(name, F.lit("x"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = storage.staged(stage(spark, docs, sf), name)
        assert name == "token_records" or docs.columns == columns
        assert docs.count() > 30
