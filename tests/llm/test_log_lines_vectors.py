"""Transaction logs, shared lines and hard negatives against brute force, and their queries against SQL or brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import line_dedup, negative_mining, queries, transaction_log

LOG = "id long, stream string, kind string, key long, value long, deleted boolean, pos long, block string, level int"


def replayed(log, per_epoch=4):
    """Undone changes, states and the last store of (id, stream, kind, key, value, deleted) records, one after another."""
    open_, store, undone, states, commits = {}, {}, [], [], 0
    for i, stream, kind, key, value, deleted in log:
        stack = open_.setdefault(stream, [])
        if kind == "savepoint":
            stack.append(None)
        elif kind == "rollback":
            while stack and (x := stack.pop()):
                undone.append(("rollback", x[0], i, x[1]))
        elif kind in ("commit", "abort"):
            left, open_[stream] = [x for x in stack if x], []
            if kind == "abort":
                undone += [("abort", x[0], i, x[1]) for x in left]
                continue
            for _, k, v, gone in left:
                store.pop(k, None)
                if v is not None and not gone:
                    store[k] = v
            commits += 1
            if commits % per_epoch == 0:
                states.append((len(states) + 1, len(store), sum(store.values())))
        else:
            stack.append((i, key, value, deleted))
    undone += [("abort", x[0], None, x[1]) for stack in open_.values() for x in stack if x]
    if commits % per_epoch:
        states.append((len(states) + 1, len(store), sum(store.values())))
    return sorted(undone, key=str), states, store


def compared(spark, log, **sizes):
    rows = [(*r, 7, "x", 1) for r in log]
    random.Random(1).shuffle(rows)
    resolved = transaction_log.resolve(spark.createDataFrame(rows, LOG), deleted_col="deleted", **sizes)
    undone, states, store = replayed(log)
    got = resolved.changes.filter("fate <> 'commit'").select("fate", "id", "by", "key").collect()
    assert sorted(map(tuple, got), key=str) == undone
    assert sorted(map(tuple, transaction_log.replay(resolved, 4, epochs=3, fan_out=sizes.get("fan_out", 1000)).collect())) == states
    assert {tuple(r) for r in transaction_log.store_after(resolved, len(states)).collect()} == set(store.items())


@pytest.mark.parametrize("seed", [0, 1])
def test_log_equals_a_replay_record_by_record(spark, seed):
    """Interleaved streams with a hot one, in blocks so small that transactions and savepoints span many, and prefixes of two levels."""
    draw = random.Random(seed)
    kinds = [["commit", "abort"] + ["savepoint"] * 4 + ["rollback"] * 4 + ["change"] * 14, ["savepoint"] * 20 + ["rollback"] * 21 + ["change"] * 40 + ["commit"]][seed]
    log = [(3 * i, draw.choice([None, "", "a", "a", "a", "b"]), draw.choice(kinds), draw.choice([None, 0, 0, 1, draw.randrange(50)]), draw.choice([None] + [draw.randrange(1000)] * 9), draw.random() < 0.1) for i in range(600)]
    compared(spark, log, block_rows=60, fan_out=[1000, 4][seed])


def test_log_without_commits_empty_log_and_odd_rows(spark):
    empty = transaction_log.resolve(spark.createDataFrame([], LOG), deleted_col="deleted")
    assert empty.changes.count() == 0 and empty.commits == 0 and transaction_log.replay(empty).count() == 0
    # an unknown kind is a change, a record without an id has no place, only empty commits make epochs too
    rows = [(1, "a", None, 5, 10, None), (None, "a", "commit", None, None, None), (2, "a", "odd", 6, 11, None), (3, None, "commit", None, None, None), (4, None, "rollback", None, None, None)]
    resolved = transaction_log.resolve(spark.createDataFrame([(*r, 1, "x", 1) for r in rows], LOG), deleted_col="deleted")
    assert {(r.id, r.fate, r.by) for r in resolved.changes.collect()} == {(1, "abort", None), (2, "abort", None)}
    assert list(map(tuple, transaction_log.replay(resolved).collect())) == [(1, 0, 0)]


def test_one_transaction_holds_the_log(spark):
    log = [(i, "a", "savepoint" if i == 400 else "change", 0, i, False) for i in range(800)] + [(900, "a", "rollback", None, None, False), (901, "a", "commit", None, None, False)]
    compared(spark, log, block_rows=50, fan_out=4)


def test_op11_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 1").collect()}
    log = []
    for r in docs:
        h = zlib.crc32(str(r.doc_id).encode())
        kind = ["commit", "commit", "abort", "savepoint", "savepoint", "rollback", "rollback"][h % 23] if h % 23 < 7 else "change"
        key = h // 100 % 300
        log.append((r.doc_id, r.source, kind, key, None if r.text is None else zlib.crc32(f"{key}:{r.text}".encode()), r.doc_id in toxic))
    undone, states, _ = replayed(log)
    got = sorted(map(tuple, queries.op11_transaction_log(spark, sf).collect()), key=str)
    assert got == sorted(undone + [("state", *s) for s in states], key=str)


def kept_lines(texts, documents, chars):
    lines = [(t or "").split("\n") for t in texts]
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    count = {}
    for doc in lines:
        for k in {key(x) for x in doc}:
            count[k] = count.get(k, 0) + 1
    gone = lambda x: len(key(x)) >= chars and count[key(x)] >= documents
    return [(len(doc), sum(map(gone, doc)), "\n".join(x for x in doc if not gone(x))) for doc in lines]


@pytest.mark.parametrize(("documents", "chars", "hot"), [(2, 1, 1), (3, 0, 10_000), (1, 3, 2)])
def test_lines_equal_brute_force(spark, documents, chars, hot):
    texts = [None, "", "\n", "a\nB\n a \nc", "A\t\nb", "x\n\n\ny\n", "É\né\na", "only", "only", " ", "\x0bA\x0c\r", "b ", "long\n" * 3000 + "a", "K\nk", None]
    rows = [(i // 2 if i % 5 else None, t, "h", 1, "p") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h1 string, at int, places string")
    got = line_dedup.drop_common_lines(df, documents, chars, hot_keys=hot).collect()
    want = [(r[0], *k) for r, k in zip(rows, kept_lines(texts, documents, chars), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert line_dedup.drop_common_lines(df.limit(0)).count() == 0


def test_op13_is_native(spark, sf):
    plan = queries.op13_line_dedup(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def mined(rows, every, positives, negatives, least, scale=256):
    """Hard negatives by all products, of (id, label, vector) rows."""
    usable = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in rows if None not in (i, label, v) and all(x is not None and math.isfinite(scale * x) for x in v)]
    usable = [r for r in usable if sum(x * x for x in r[2]) < 1 << 62]
    out = []
    for i, label, v in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in usable if j != i)
        for p, pid, _ in [x for x in scored if x[2] == label][:positives]:
            band = [(s, j) for s, j, other in scored if other != label and -s <= -p and -s * least[1] >= -p * least[0]][:negatives]
            out += [(i, pid, rank, j, -p, -s) for rank, (s, j) in enumerate(band, 1)]
    return sorted(out)


def test_negatives_equal_brute_force(spark, monkeypatch):
    """Tied scores, odd and ragged vectors, labels of both signs, components near the limits of a double."""
    monkeypatch.setattr(negative_mining, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(negative_mining, "STEP_ROWS", 16)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(4, 12))
    rows = [(int(i), int(draw.integers(0, 3)), (centres[i % 4] + 0.3 * draw.normal(size=12)).tolist()) for i in range(240)]
    rows += [(1000 + i, i % 2, centres[0].tolist()) for i in range(40)]  # equal vectors
    rows += [(5000 + 10 * i, -1, (10.0**i * centres[1]).tolist()) for i in range(6)] + [(5300, -1, [1e30] * 12), (5310, 1, [1.7e308] * 12)]
    odd = [None, [], [1.0], [0.5, None] * 6, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [0.0] * 12, [1.0] * 14]
    rows += [(6000 + 10 * i, 1, v) for i, v in enumerate(odd)] + [(None, 1, [1.0] * 12), (6200, None, [1.0] * 12)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, score int, anchor string").repartition(3)
    for least, k in (((4, 5), 5), ((1, 3), 2)):
        got = negative_mining.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, positives=k, negatives=k, least=least)
        assert sorted(map(tuple, got.collect())) == mined(rows, 10, k, k, least)
    assert negative_mining.mine_hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_pairs_are_discarded_early():
    """Of clustered vectors, few pairs are multiplied out, and the result doesn't depend on the axes."""
    draw = np.random.default_rng(5)
    numbers = np.floor(256 * (draw.normal(size=(30, 32))[np.arange(600) % 30] + 0.05 * draw.normal(size=(600, 32)))).astype(np.int64)
    record = {"block": 0, "n": 600, "dims": 32, "ids": np.arange(600).astype("<i8").tobytes(), "labels": (np.arange(600) % 2).astype("<i8").tobytes(), "numbers": numbers.astype("<i2").tobytes(), "width": "<i2"}
    counted, plain = [], negative_mining._products
    results = []
    for axes in (np.eye(32), np.linalg.eigh((numbers.T @ numbers).astype(float))[1][:, ::-1]):
        side = negative_mining._Side([record], np.ascontiguousarray(axes), [8, 24, 32])
        limit = np.full((600, 1), negative_mining.NORM_LIMIT)
        negative_mining._products = lambda a, b, left, right: (counted.append(len(left)) if a.dtype == np.int64 else None, plain(a, b, left, right))[1]
        try:
            found = negative_mining._best(side, side, [8, 24, 32], 1e-9, True, -limit, limit, 3)
        finally:
            negative_mining._products = plain
        results.append(sorted(zip(*(x.tolist() for x in found), strict=True)))
    assert results[0] == results[1] and counted[-1] < 600 * 88
    assert hashlib.sha256(str(results[0]).encode()).digest() == hashlib.sha256(str(results[1]).encode()).digest()
