"""Readers, unified ids, writers, and danmaku XML."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from skein.sources import files, readers, sinks

NOTES = [
    {"note_id": "n1", "title_text": "T", "raw_text": "T", "downloaded_image_paths": ["a\\b.jpg", "", None, "c.png"], "publish_time_text": "3天前", "publish_timestamp": 17},
    {"note_id": None, "title_text": None, "raw_text": " body ", "publish_timestamp": "18"},
    {"note_id": "n3", "title_text": "A", "raw_text": "B", "downloaded_image_paths": None, "publish_time_resolved": "2024-01-01"},
    {"note_id": "n4", "title_text": "", "raw_text": ""},
]


def put(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False))
    return f"file://{path}"


def test_notes(spark, tmp_path):
    notes = readers.read_notes(spark, put(tmp_path / "n.json", NOTES))
    got = [tuple(r) for r in readers.unify_notes(notes).collect()]
    assert got == [("GRP-XHS-n1", "xiaohongshu", "T", "3天前", "note"), ("GRP-XHS-unknown_note", "xiaohongshu", "body", "18", "note"), ("GRP-XHS-n3", "xiaohongshu", "A\nB", "2024-01-01", "note")]
    images = readers.image_records(notes, "/base").select("Image_ID", "relative_image_path", "image_path").collect()
    assert [tuple(r) for r in images] == [("GRP-XHS-n1-01", "a/b.jpg", "/base/a/b.jpg"), ("GRP-XHS-n1-04", "c.png", "/base/c.png")]
    with pytest.raises(ValueError):
        readers.read_notes(spark, put(tmp_path / "o.json", {"a": 1}))
    with pytest.raises(FileNotFoundError):
        readers.read_notes(spark, f"file://{tmp_path}/none.json")


def test_reviews_and_videos_leave_gaps_in_ids(spark, tmp_path):
    path = put(tmp_path / "r.json", {"summary": {"total_reviews": 3, "by_brand": {"x": 3}}, "reviews": [{"product_id": "p", "content": "a", "score": 1}, {"product_id": "p", "content": " "}, {"content": "b"}]})
    assert [r.Source_ID for r in readers.unify_reviews(readers.read_reviews(spark, path)).collect()] == ["GRP-TB-p-0001", "GRP-TB-unknown_product-0003"]
    assert readers.read_reviews(spark, put(tmp_path / "e.json", {"summary": {"total_reviews": 0, "by_brand": {}}, "reviews": []})).count() == 0
    path = put(tmp_path / "v.json", {"all_danmaku": [{"bvid": "v", "text": ""}, {"bvid": "v", "text": "x"}], "all_comments": [{"text": "y", "like_count": 3}]})
    assert [(r.Source_ID, r.Data_Type) for r in readers.unify_videos(*readers.read_videos(spark, path)).collect()] == [("GRP-BILI-DM-v-000002", "danmaku"), ("GRP-BILI-CM-unknown_bvid-000001", "comment")]


def test_a_video_file_is_an_object(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_videos(spark, put(tmp_path / "l.json", [{"all_danmaku": []}]))
    with pytest.raises(FileNotFoundError):
        readers.read_videos(spark, f"file://{tmp_path}/none.json")


def test_master_comes_first_and_names_vary(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes('﻿ID,Text ,Platform\n7,"a ""q"", b\nc",web\n,second,\n8, ,web\n'.encode())
    notes = put(tmp_path / "n.json", NOTES)
    got = readers.unified_records(spark, {"master": f"file://{tmp_path}/m.csv", "notes": notes}).collect()
    assert [(r.Source_ID, r.Platform, r.Raw_Text, r.Data_Type) for r in got] == [("7", "web", 'a "q", b\nc', "text"), ("GRP-MASTER-000002", "unknown", "second", "text")]
    assert readers.unified_records(spark, {"master": f"file://{tmp_path}/no.csv", "notes": notes}).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.unified_records(spark, {})


def test_danmaku(spark):
    xml = b'<i><d p="1"> hi\x08 </d><d p="2"></d><x><d>deep</d></x><d>&lt;b&gt;</d></i>'
    rows = [("a", xml), ("b", gzip.compress(xml)), ("c", b"<i><d>"), ("d", b""), ("e", None)]
    got = readers.read_danmaku(spark.createDataFrame(rows, "path string, content binary")).orderBy("path", "pos").collect()
    assert [(r.path, r.pos, r.text) for r in got] == [("a", 0, "hi"), ("a", 1, "<b>"), ("b", 0, "hi"), ("b", 1, "<b>")]
    text = spark.createDataFrame([(xml.decode(),)], "x string").select(readers.danmaku_texts(F.col("x")).alias("t")).first().t
    assert text == ["hi", "<b>"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "x", y', None)], "Image_ID string, b string, c string")
    sinks.write_csv(df, f"file://{tmp_path}/out")
    assert [tuple(r) for r in readers.read_csv(spark, f"file://{tmp_path}/out").collect()] == [("a", 'say "x", y', None)]
    sinks.write_csv(df.limit(0), f"file://{tmp_path}/none")
    assert readers.read_csv(spark, f"file://{tmp_path}/none").columns == ["Image_ID", "b", "c"]
    sinks.write_csv_file(df, f"file://{tmp_path}/one.csv")
    assert (tmp_path / "one.csv").read_bytes() == b'\xef\xbb\xbfImage_ID,b,c\na,"say ""x"", y",\n'
    with pytest.raises(ValueError):
        sinks.write_csv_file(spark.range(5), f"file://{tmp_path}/two.csv", most=4)
    sinks.write_json_row(spark.sql("SELECT 1 AS a, map('k', 2) AS m"), f"file://{tmp_path}/row.json")
    assert json.loads((tmp_path / "row.json").read_text()) == {"a": 1, "m": {"k": 2}}
    assert sinks.write_label_files(df.union(df.select(F.lit("b"), "b", "c")), f"file://{tmp_path}/labels") == 2
    assert json.loads((tmp_path / "labels/b.json").read_text()) == {"Image_ID": "b", "b": 'say "x", y', "c": None}
    index = spark.createDataFrame([tuple("abcdefghij")], ", ".join(f"{c} string" for c in sinks.IMAGE_INDEX))
    sinks.write_image_index(index, f"file://{tmp_path}/index")
    assert readers.read_csv(spark, f"file://{tmp_path}/index").columns == list(sinks.IMAGE_INDEX)
    with pytest.raises(ValueError):
        sinks.write_image_index(index.limit(0), f"file://{tmp_path}/index")


def test_passed_images_and_labels(spark, tmp_path):
    (tmp_path / "q.csv").write_text("Image_ID,passed\na,True\nb,false\nc, TRUE\n")
    assert [r.Image_ID for r in readers.passed_images(spark, f"file://{tmp_path}/q.csv").collect()] == ["a", "c"]
    put(tmp_path / "l1.json", {"Image_ID": "a", "Confidence": 0.5})
    (tmp_path / "l2.json").write_text("no json")
    labels = readers.read_labels(spark, f"file://{tmp_path}/l*.json").collect()
    assert [(r.Image_ID, r.Curation_Status, r.Confidence) for r in labels] == [("a", None, 0.5)]
    assert {r.image_path for r in readers.image_files(spark, f"file://{tmp_path}").collect()} >= {f"{tmp_path}/q.csv"}


def test_executors_write_label_files(spark, tmp_path):
    """4,000 files of one job; a second job adds to them; a job whose task fails, after others have written, leaves nothing."""
    rows = spark.range(0, 4_000, 1, 8).select(F.format_string("i%05d", "id").alias("Image_ID"), F.col("id").alias("n"), F.lit('é "x"').alias("t"))
    path = tmp_path / "labels"
    assert sinks.write_label_files(rows, f"file://{path}") == 4_000
    assert len(list(path.iterdir())) == 4_000 and json.loads((path / "i00007.json").read_text()) == {"Image_ID": "i00007", "n": 7, "t": 'é "x"'}
    assert sinks.write_label_files(rows.limit(1).withColumn("Image_ID", F.lit("more")), f"file://{path}") == 1
    assert len(list(path.iterdir())) == 4_001
    bad = rows.filter("n % 500 < 20").withColumn("Image_ID", F.when(F.col("n") == 3_510, "a/b").otherwise(F.concat(F.lit("z"), "n")))
    for target in (path, tmp_path / "fresh"):
        with pytest.raises(Exception, match="no file name"):
            sinks.write_label_files(bad, f"file://{target}")
    assert len(list(path.iterdir())) == 4_001 and sorted(p.name for p in tmp_path.iterdir()) == ["labels"]


def test_marked_csv_parts(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'say "x",\n y', None, True), ("b", "é", "", False), ("c", None, "z", None)], "Image_ID string, b string, `odd c` string, passed boolean").repartition(2)
    sinks.write_csv(rows, f"file://{tmp_path}/q", mark=True)
    parts = list((tmp_path / "q").iterdir())
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbfImage_ID,b,odd c,passed\n") for p in parts)
    assert sorted(map(tuple, readers.read_csv(spark, f"file://{tmp_path}/q").collect())) == [("a", 'say "x",\n y', None, "true"), ("b", "é", None, "false"), ("c", None, "z", None)]
    sinks.write_csv(rows.limit(0), f"file://{tmp_path}/q", mark=True)
    assert [p.read_bytes() for p in (tmp_path / "q").iterdir()] == [b"\xef\xbb\xbfImage_ID,b,odd c,passed\n"]
    assert not files.reachable("viewfs://store/x") and files.reachable(f"file://{tmp_path}")
