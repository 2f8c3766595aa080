"""Elements of JSON arrays, cut from many byte ranges, against Spark's own reader of whole files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skein.sources import readers
from skein.sources.json_arrays import array_elements

TRICKY = ["plain", "", "}", "{", "]", "[", '"', '\\', '\\"', "},{", '"},{"note_id":"x"}', "é中😀", "a\nb\tc", "\\\\}", "],[", " : ", '"reviews": [{}]', " ", "x" * 300]


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes: every file is cut into many."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def of(size):
        for n, v in zip(names, (str(size), "0", "1"), strict=True):
            spark.conf.set(n, v)

    yield of
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def written(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")
    return f"file://{path}"


def found(spark, path, key=None):
    rows = array_elements(spark, path, key).select(F.regexp_extract("file", "([^/]+)$", 1).alias("file"), "pos", "value").collect()
    return sorted((r.file, r.pos, json.loads(r.value)) for r in rows)


@pytest.mark.parametrize("size", [100])
def test_arrays_equal_their_elements(spark, tmp_path, small_ranges, size):
    draw = random.Random(size)
    values = [{"id": i, "text": draw.choice(TRICKY), "deep": {"a": [draw.choice(TRICKY), {"b": []}], "c": {}}} for i in range(10)] + ["a string with } and ]", 5, None, True, [1, [2, {"x": "}"}]], {}]
    draw.shuffle(values)
    written(tmp_path / "in/one.json", json.dumps(values, ensure_ascii=False))
    written(tmp_path / "in/two.json", "\n " + json.dumps(values[:5], indent=2))
    written(tmp_path / "in/none.json", " [ ] ")
    small_ranges(size)
    assert found(spark, f"file://{tmp_path}/in") == sorted([("one.json", i, v) for i, v in enumerate(values)] + [("two.json", i, v) for i, v in enumerate(values[:5])], key=lambda x: x[:2])


@pytest.mark.parametrize("size", [220])
def test_arrays_under_a_key(spark, tmp_path, small_ranges, size):
    draw = random.Random(size)
    reviews = [{"content": draw.choice(TRICKY), "score": i, "tags": [{"reviews": [1, "}"]}]} for i in range(14)]
    whole = {"summary": {"n": 3, "by": {"x": [1, 2, {"reviews": [9]}]}}, "note": "\"reviews\": [1, 2]}", "other": [{"content": "no"}, {"content": "}"}] * 4, "reviews": reviews, "after": ["reviews", {"q": "]"}], "empty": []}
    path = written(tmp_path / "r.json", json.dumps(whole, ensure_ascii=False, indent=1))
    small_ranges(size)
    assert found(spark, path, "reviews") == [("r.json", i, v) for i, v in enumerate(reviews)]
    assert found(spark, path, "other") == [("r.json", i, v) for i, v in enumerate(whole["other"])]
    assert found(spark, path, "after") == [("r.json", 0, "reviews"), ("r.json", 1, {"q": "]"})]
    assert found(spark, path, "empty") == found(spark, path, "missing") == []


def test_other_files_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="an array is expected"):
        array_elements(spark, written(tmp_path / "o.json", ' {"a": [1]}'))
    with pytest.raises(ValueError, match="an object is expected"):
        array_elements(spark, written(tmp_path / "a.json", "[1]"), "reviews")


def test_large_files_read_like_small_ones(spark, tmp_path, small_ranges, monkeypatch):
    """Notes, reviews and videos by ranges equal those read file by file."""
    draw = random.Random(4)
    notes = [{"note_id": f"n{i}", "raw_text": draw.choice(TRICKY), "can_open_in_web": i % 2 == 0, "image_urls": ["a}", "b"], "publish_timestamp": [i, str(i), None][i % 3], "more": {"x": 1}} for i in range(50)]
    reviews = {"summary": {"total_reviews": 2}, "reviews": [{"product_id": str(i), "content": draw.choice(TRICKY), "score": i % 5} for i in range(50)]}
    marks = [{"bvid": f"B{i}", "text": draw.choice(TRICKY), "is_pain_point": False} for i in range(14)]
    video = {"summary": {"total_danmaku": 40}, "pain_point_keywords": ["}", "x"], "all_danmaku": marks, "pain_point_danmaku": [], "all_comments": [m | {"like_count": 3} for m in marks[:7]], "high_like_pain_comments": []}
    paths = [written(tmp_path / f"{n}.json", json.dumps(v, ensure_ascii=False)) for n, v in (("notes", notes), ("reviews", reviews), ("videos", video))]

    def everything():
        frames = [readers.read_notes(spark, paths[0]), readers.read_reviews(spark, paths[1]), *readers.read_videos(spark, paths[2])]
        return [sorted(map(str, f.select(*[c for c in f.columns if c != "file"]).collect())) for f in frames]

    plain = everything()
    assert [len(x) for x in plain] == [50, 50, 14, 7]
    monkeypatch.setattr(readers, "LARGE_FILE", 0)
    small_ranges(700)
    assert everything() == plain
    assert readers.read_reviews(spark, paths[0]).count() == 0
    with pytest.raises(ValueError):
        readers.read_notes(spark, paths[1])
    with pytest.raises(ValueError):
        readers.read_videos(spark, paths[0])
