"""Reviews, addresses, times and payloads."""

import json

import pytest
from pyspark.sql import functions as F

from skein.functions import times, urls
from skein.operators import fetching, pages, payloads, reviews

SITE = "https://www.example.org"


def column(spark, expression, *values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r.x for r in df.select(expression(F.col("c")).alias("x")).collect()]


def test_scores(spark):
    rows = [("1", "a"), ("2", "b"), ("3", "c"), ("0", "d"), (None, "e"), ("x", "f"), ("1", " "), ("1", None)]
    df = spark.createDataFrame(rows, "score string, content string")
    assert sorted(r.content for r in reviews.low_reviews(df).collect()) == ["a", "b", "d", "e", "f"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        reviews.low_reviews(df, strict=True).collect()


def test_brands_and_composition(spark):
    df = spark.createDataFrame([("Acme jacket x", "默认好评"), ("Acme  y", "short"), (" Bolt z", "long enough to be genuine")], "query string, content string")
    assert {r.brand: r.n for r in reviews.brand_counts(df).collect()} == {"Acme": 2, "Bolt": 1}
    got = {r.kind: r for r in reviews.composition(df).collect()}
    assert set(got) == {"default", "noise", "genuine"} and got["noise"].max_length == 5 and got["genuine"].percent == pytest.approx(100 / 3)


def test_video_counts(spark):
    comments = reviews.flag_pain(spark.createDataFrame([(1, "太重了", 5), (2, "好", 9), (3, "贵", 5), (4, "闷热", 7)], "pos int, text string, like_count long"))
    assert [r.pos for r in reviews.top_liked_pain(comments, ("pos",)).collect()] == [4, 1, 3]
    assert tuple(reviews.video_summary(comments.limit(0), comments).first()) == (0, 0, 4, 3)


def test_urls(spark):
    assert column(spark, lambda c: urls.normalize_url(c, SITE), " //h/a.jpg?x=1", "/p?q", "data:image/png;x", "http://h/x?y#z", None, "") == ["https://h/a.jpg", SITE + "/p", "", "http://h/x", "", ""]
    assert column(spark, urls.sanitize_filename, 'a/b:*c?"<>|', "  ", "x" * 100) == ["a_b_c_", "untitled", "x" * 80]
    assert column(spark, urls.infer_extension, "http://h/A.PNG!x", "http://h/x", "a.webp.jpg") == [".png", ".jpg", ".jpg"]
    assert column(spark, lambda c: urls.infer_extension(F.lit("u"), c), "image/webp; q=1", "text/odd") == [".webp", ".jpg"]
    assert column(spark, urls.mime_type, "/a.PNG", "b", "c.webp", "d.x/e") == ["image/png", "image/jpeg", "image/webp", "image/jpeg"]
    assert column(spark, lambda c: urls.share_url(c, F.lit("t=/"), SITE), "n", "", None) == [f"{SITE}/explore/n?xsec_token=t%3D%2F&xsec_source=pc_search", None, None]
    assert column(spark, lambda c: urls.note_url(c, F.lit("7"), SITE), f"{SITE}/explore/9?x", "other") == [f"{SITE}/explore/9", f"{SITE}/explore/7"]
    assert column(spark, lambda c: urls.normalize_path("/b/", c), "x\\y", "/abs", " ", "./z") == ["/b/x/y", "/abs", None, "/b/z"]


def test_times(spark):
    now = F.lit("2024-03-01 12:30:00").cast("timestamp")
    said = ["2024-02-29", "02-29", "03-02", "03-03", "2天前", "3小时前", "45分钟前", "刚刚", "soon", "02-30", " ", None]
    df = spark.createDataFrame([(s,) for s in said], "c string").withColumn("e", times.publish_epoch(F.col("c"), now))
    got = df.select("e", times.publish_resolved(F.col("c"), F.col("e")).alias("r")).collect()
    assert [r.r for r in got] == ["2024-02-29", "2024-02-29", "2024-03-02", "2023-03-03", "2024-02-28", "2024-03-01 09:00", "2024-03-01 11:45", "2024-03-01 12:30", "soon", "02-30", None, None]
    assert got[7].e == 1709296200 and got[8].e is None and got[9].e is None
    assert column(spark, times.normalize_timestamp, " 0017 ", "12.9", "abc ", None) == ["17", "12", "abc", None]


PAYLOAD = {
    "items": [
        {"id": "n1", "xsec_token": "tok", "note_card": {"display_title": " Title ", "desc": "Body of it", "cover": {"url_default": "http://h/c.jpg?1", "url": "http://h/avatar.jpg"}, "image_list": [{"info_list": [{"image_scene": "WB_PRV", "url": "http://h/1_prv.jpg"}, {"image_scene": "X", "url": "http://h/1a.jpg"}, {"image_scene": "WB_DFT", "url": "http://h/1b.jpg"}]}, {"info_list": [{"url": "http://h/c.jpg"}]}], "corner_tag_info": [{"type": "x", "text": "no"}, {"type": "publish_time", "text": "02-01"}]}},
        {"note_id": "n2", "title": "还没有简介", "time": 1700000000, "images": [{"u": "//h/z.png?x"}, "http://h/page.html"]},
        {"id": "n1", "title": "later", "desc": "later body"},
        {"id": "nothing"},
        {"title": "no id"},
    ]
}


def test_walk_and_records(spark):
    walked = payloads.deep_walk(spark.createDataFrame([(1, json.dumps(PAYLOAD, ensure_ascii=False)), (2, "no json"), (3, None)], "k int, payload string"), keep=("k",))
    kinds = [r.kind for r in walked.filter("pos < 4").orderBy("pos").collect()]
    assert kinds == ["object", "array", "object", "string"] and walked.agg(F.max("depth")).first()[0] >= 6 and walked.filter("k > 1").count() == 0
    now = F.lit("2024-03-01 12:00:00").cast("timestamp")
    records = payloads.note_records(walked.filter("kind = 'object'"), SITE, now, order=("k", "pos")).orderBy("pos").collect()
    assert [r.note_id for r in records] == ["n1", "n2", "n1"]
    a, b, _ = records
    assert (a.title_text, a.raw_text, a.text_source, a.can_open_in_web, a.publish_time_resolved) == ("Title", "Body of it", "search_body", True, "2024-02-01")
    assert a.image_urls == ["http://h/c.jpg", "http://h/1b.jpg"] and a.note_url == a.share_url == f"{SITE}/explore/n1?xsec_token=tok&xsec_source=pc_search"
    assert (b.raw_text, b.image_urls, b.publish_timestamp, b.text_source, b.note_url) == ("", ["https://h/z.png"], "1700000000", "search_title", f"{SITE}/explore/n2")
    detail = payloads.first_detail(walked, SITE, ("k",)).first()
    assert detail.raw_text == "" and detail.image_urls[0] == "http://h/c.jpg"
    assert column(spark, payloads.script_json, 'x = {"a": [1]}; y', "none") == ['{"a": [1]}', None]


def test_merging(spark):
    rows = [("a", 1, "", None, []), ("a", 2, "x", "t1", ["i"]), ("a", 3, "y", "t2", ["j"]), ("b", 4, None, None, None)]
    df = spark.createDataFrame(rows, "note_id string, pos int, raw_text string, publish_timestamp string, image_urls array<string>")
    got = {r.note_id: tuple(r) for r in payloads.first_per_key(df, "note_id", ("pos",), ("raw_text", "publish_timestamp", "image_urls")).collect()}
    assert got == {"a": ("a", 1, "x", "t1", ["i"]), "b": ("b", 4, None, None, None)}
    base = spark.createDataFrame([("a", "u", None, "", "search_title", False, [])], "note_id string, note_url string, share_url string, raw_text string, text_source string, can_open_in_web boolean, image_urls array<string>")
    patch = spark.createDataFrame([("a", "v", "s", "body", "detail_page", True, ["i"])], base.schema)
    assert tuple(payloads.merge_patch(base, patch).first()) == ("a", "s", "s", "body", "detail_page", True, ["i"])
    assert tuple(payloads.merge_patch(base, patch.limit(0)).first()) == ("a", "u", None, "", "search_title", False, [])


def test_lookup_and_back_fill(spark):
    records = spark.createDataFrame([(1, "a", f"{SITE}/explore/a"), (2, "b", "other"), (3, "c", "c")], "pos int, note_id string, note_url string")
    links = spark.createDataFrame([(f"{SITE}/explore/a",), (f"{SITE}/explore/b?x",), (f"{SITE}/explore/z",)], "page_url string")
    got = {r.page_url[-1]: r for r in payloads.lookup_pages(links, records).collect()}
    assert got["a"].record.note_id == "a" and got["x"].record.note_id == "b" and got["z"].record is None and got["z"].page_note_id == "z"
    filled = payloads.back_fill(records.limit(1), records, 2)
    assert sorted(r.note_id for r in filled.collect()) == ["a", "b"]
    want = spark.createDataFrame([("T", "T", "s", True), ("T", "x" * 30, "s", True), ("T", "", "s", True), ("T", "", None, True)], "t string, r string, s string, o boolean")
    assert [r.w for r in want.select(payloads.wants_detail(F.col("t"), F.col("r"), F.col("s"), F.col("o")).alias("w")).collect()] == [True, False, True, False]
    notes = spark.createDataFrame([("x", ["i"], "1"), ("", ["i"], "1"), ("x", [], "1")], "raw_text string, image_urls array<string>, publish_timestamp string")
    assert payloads.complete_count(notes).first().complete == 1


def reply(rpid, text, like=None):
    return {"rpid": rpid, "content": {"message": text}} | ({} if like is None else {"like": like})


def test_comments_of_pages(spark):
    heat = {"data": {"top_replies": [reply(1, "top", 9)], "hots": [reply(2, ""), reply(3, "hot")], "replies": [reply(1, "again"), reply(4, "plain", 2)]}}
    walk = {"data": {"top_replies": [reply(8, "not here")], "replies": [reply(4, "plain"), reply(2, "now said", 1)]}}
    rows = [("v", 0, json.dumps(heat)), ("v", 1, json.dumps(walk)), ("w", 1, json.dumps({"data": {"replies": [reply(1, "other video")]}})), ("x", 0, "no json"), ("y", 0, None)]
    got = pages.comment_rows(spark.createDataFrame(rows, "bvid string, page int, payload string")).orderBy("bvid", "page", "pos").collect()
    assert [(r.bvid, r.rpid, r.text, r.like_count) for r in got] == [("v", "1", "top", 9), ("v", "3", "hot", 0), ("v", "4", "plain", 2), ("v", "2", "now said", 1), ("w", "1", "other video", 0)]


def test_items_videos_and_keywords(spark):
    rows = [(1, '{"model": {"itemList": [], "items": [{"a": 1}, {"a": 2}, {"a": 3}]}}'), (2, '{"items": [{"b": 1}]}'), (3, '[{"c": 1}]'), (4, '{"model": null}'), (5, "x"), (6, None)]
    df = spark.createDataFrame(rows, "k int, payload string")
    assert [tuple(r) for r in pages.item_rows(df, keep=("k",), most=2).orderBy("k", "pos").collect()] == [(1, 0, '{"a":1}'), (1, 1, '{"a":2}'), (2, 0, '{"b":1}'), (3, 0, '{"c":1}')]
    links = spark.createDataFrame([("q", 0, "https://v/video/BV1abc?x", " one "), ("q", 1, "//v/video/BV1abc", "again"), ("q", 2, "/video/BV2defg/", None), ("q", 3, "/video/BV1", "short"), ("p", 0, "/video/BV1abc", "x" * 99)], "keyword string, pos int, href string, title string")
    assert [tuple(r) for r in pages.unique_videos(links).orderBy("keyword", "pos").collect()] == [("p", 0, "BV1abc", "x" * 80), ("q", 0, "BV1abc", "one"), ("q", 2, "BV2defg", "")]
    assert pages.unique_videos(links, most=1).count() == 2
    info = spark.createDataFrame([("a", '{"data": {"aid": 5, "pages": [{"cid": 7}, {"cid": 8}]}}'), ("b", '{"data": {"aid": 5, "pages": []}}'), ("c", "{}"), ("d", None)], "bvid string, payload string")
    assert [tuple(r) for r in pages.video_ids(info).collect()] == [("a", 5, 7)]
    both = pages.union_keywords([("x", spark.createDataFrame([(1,)], "a int")), ("y", spark.createDataFrame([(2,)], "a int"))])
    assert [tuple(r) for r in both.orderBy("kw_ord").collect()] == [("x", 0, 1), ("y", 1, 2)]
    with pytest.raises(ValueError):
        pages.union_keywords([])
    assert column(spark, lambda c: urls.is_search_response(c, "h.com"), "https://www.H.com/api/SNS/web/v1/x", "https://h.com/about", "https://o.com/search", None) == [True, False, False, None]


def test_pages_are_fetched_until_an_empty_one(spark):
    def client():
        seen = {}

        def ask(item, page):
            seen[item, page] = seen.get((item, page), 0) + 1
            if item == "flaky" and page == 1 and seen[item, page] < 3:
                raise OSError("Rate limit")
            if item == "broken" and page == 2:
                raise ValueError("no such page")
            last = {"a": 2, "flaky": 1, "broken": 9, "none": 0}[item]
            return json.dumps({"model": {"comments": [{"n": page}] if page <= last else []}})

        return ask

    items = spark.createDataFrame([("a",), ("a",), ("flaky",), ("broken",), ("none",), (None,)], "item_id string")
    got = fetching.fetch_pages(items, client, most=5, wait=0).orderBy("item_id", "page").collect()
    assert [(r.item_id, r.page, r.error_message) for r in got] == [("a", 1, None), ("a", 2, None), ("broken", 1, None), ("broken", 2, "ValueError: no such page"), ("flaky", 1, None)]
    rows = pages.item_rows(spark.createDataFrame(got), keep=("item_id", "page"), paths=fetching.NESTED_COMMENTS).orderBy("item_id", "page").collect()
    assert [(r.item_id, r.item) for r in rows] == [("a", '{"n":1}'), ("a", '{"n":2}'), ("broken", '{"n":1}'), ("flaky", '{"n":1}')]
    assert column(spark, fetching.is_retryable, "Timeout 30000ms", "net::ERR", "other", None) == [True, True, False, False]


def test_images_are_saved_under_their_notes(spark, tmp_path):
    schema = "note_id string, keyword string, title_text string, image_urls array<string>, downloaded_image_paths array<string>"
    notes = spark.createDataFrame([("n/1", "#city", "t", ["http://h/a.png", "http://h/gone", "http://h/c"], []), ("", None, "title", ["http://h/d"], None), ("n3", "", "t", [], ["old"])], schema)
    targets = fetching.image_targets(notes, "/base/", 3)
    assert sorted(r.stem for r in targets.collect()) == ["/base/city/n_1/image_01", "/base/city/n_1/image_02", "/base/city/n_1/image_03", "/base/keyword/title/image_01"]
    root = str(tmp_path)

    def fetch():
        def get(url):
            if "gone" in url:
                raise OSError("404")
            return url.encode(), "image/webp; q=1" if url.endswith("/c") else None

        return get

    def save():
        import os

        def put(path, content):
            os.makedirs(os.path.dirname(root + path), exist_ok=True)
            with open(root + path, "wb") as f:
                f.write(content)

        return put

    done = fetching.downloaded_paths(notes, fetching.download_images(targets, fetch, save, wait=0))
    assert {r.note_id: r.downloaded_image_paths for r in done.collect()} == {"n/1": ["/base/city/n_1/image_01.png", "/base/city/n_1/image_03.webp"], "": ["/base/keyword/title/image_01.jpg"], "n3": []}
    assert (tmp_path / "base/city/n_1/image_03.webp").read_bytes() == b"http://h/c"
