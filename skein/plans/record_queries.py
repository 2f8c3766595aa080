"""Registered queries of the record, payload and run operators, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import times, urls
from skein.functions.lexicon import LATIN
from skein.functions.text import first_present
from skein.operators import images, labels, pages, payloads, reviews
from skein.plans import text_analysis
from skein.sources import readers
from skein.sources.stage import spread

SITE = "https://www.example.org"
#: Tables of whole texts, on which much is done a row.
TEXTS = ("documents", "pages", "conversations")
STRIP_SQL = r"regexp_replace({}, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(read) if name in TEXTS else read


# --- pages of responses -----------------------------------------------------------------------------------------------


def comment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as one page by heat each: pinned, hot and plain comments by turn."""
    talk = table(spark, sf_dir, "conversations")

    def turns(k: int):
        own = F.when(F.col("turn") % 3 == k, F.struct("turn", (F.col("turn") % 4).alias("rpid"), F.length("text").alias("like"), F.struct(F.col("text").alias("message")).alias("content")))
        return F.transform(F.array_sort(F.collect_list(own)), lambda x: F.struct(x["rpid"].alias("rpid"), x["like"].alias("like"), x["content"].alias("content")))

    data = F.struct(turns(0).alias("top_replies"), turns(1).alias("hots"), turns(2).alias("replies"))
    payload = talk.groupBy(F.col("conv_id").cast("string").alias("bvid")).agg(F.to_json(F.struct(data.alias("data"))).alias("payload"))
    return pages.comment_rows(payload.withColumn("page", F.lit(0))).drop("page")


COMMENTS_SQL = """
WITH r AS (SELECT CAST(conv_id AS VARCHAR) AS bvid, turn, CAST(turn % 4 AS VARCHAR) AS rpid, text, CAST(length(text) AS BIGINT) AS like_count,
           CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn % 3, turn) - 1 AS INTEGER) AS pos FROM conversations)
SELECT bvid, pos, rpid, text, like_count FROM r WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY bvid, rpid ORDER BY pos) = 1
"""


def item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three items a page, under each of the names that responses use; the first two are taken."""
    k = F.col("page_id")
    items = F.array(*[F.struct((k + i).alias("k")) for i in range(3)])
    payload = F.when(k % 3 == 0, F.to_json(F.struct(F.struct(items.alias("itemList"), F.array().cast("array<int>").alias("items")).alias("model")))).when(k % 3 == 1, F.to_json(F.struct(items.alias("items")))).otherwise(F.to_json(items))
    return pages.item_rows(table(spark, sf_dir, "pages").select("page_id", payload.alias("payload")), keep=("page_id",), most=2)


def unique_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    links = e.select(F.col("event_type").alias("keyword"), F.col("event_id").alias("pos"), F.concat(F.lit("https://v.example.org/video/BV"), F.col("user_id") % 97, F.lit("x"), F.col("user_id") % 13, F.lit("00?t=1")).alias("href"), F.concat(F.lit(" "), F.col("props"), F.lit(" ")).alias("title"))
    return pages.unique_videos(links, most=40)


VIDEOS_SQL = """
WITH v AS (SELECT event_type AS keyword, event_id AS pos, 'BV' || user_id % 97 || 'x' || user_id % 13 || '00' AS bvid, substring(trim(props), 1, 80) AS title FROM events),
f AS (SELECT * FROM v WHERE length(bvid) >= 6 QUALIFY row_number() OVER (PARTITION BY keyword, bvid ORDER BY pos) = 1)
SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY pos) <= 40
"""


def note_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    u = table(spark, sf_dir, "pages").select("page_id", F.when(k % 4 == 0, F.concat(F.lit(SITE), F.lit("/explore/"), k, F.lit("?a=1"))).when(k % 4 == 1, F.concat("url", F.lit("/WEB/v1/Search"))).when(k % 4 == 2, F.concat("url", F.lit("/a_PRV.jpg"))).otherwise(F.col("url")).alias("u"), F.when(k % 2 == 0, (k * 7).cast("string")).alias("token"))
    key = k.cast("string")
    share = urls.share_url(key, F.col("token"), SITE)
    note = urls.note_url(F.col("u"), key, SITE)
    return u.select("page_id", urls.is_note_url(F.col("u")).alias("is_note"), urls.is_search_response(F.col("u"), "example").alias("is_search"), urls.is_preview_image(F.col("u")).alias("is_preview"), urls.looks_like_image(F.col("u")).alias("is_image"), note.alias("note_url"), urls.accessible_url(note, share).alias("open_url"))


ADDRESSES_SQL = f"""
WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '{SITE}/explore/' || page_id || '?a=1' WHEN 1 THEN url || '/WEB/v1/Search' WHEN 2 THEN url || '/a_PRV.jpg' ELSE url END AS u, CASE WHEN page_id % 2 = 0 THEN CAST(page_id * 7 AS VARCHAR) END AS token FROM pages),
n AS (SELECT *, contains(u, '/explore/') OR contains(u, '/discovery/item/') AS is_note FROM u),
a AS (SELECT *, CASE WHEN is_note THEN regexp_replace(u, '\\?.*$', '') ELSE '{SITE}/explore/' || page_id END AS note_url FROM n)
SELECT page_id, is_note, contains(lower(u), 'example') AND (contains(lower(u), 'search') OR contains(lower(u), 'homefeed') OR contains(lower(u), 'notefeed') OR contains(lower(u), 'web/v1/')) AS is_search, contains(lower(u), '_prv') AS is_preview,
       (contains(lower(u), '.jpg') OR contains(lower(u), '.jpeg') OR contains(lower(u), '.png') OR contains(lower(u), '.webp') OR contains(lower(u), '.heic') OR contains(lower(u), 'imageview2') OR contains(lower(u), '!nc_n_')) AND NOT contains(lower(u), 'avatar') AS is_image,
       note_url, CASE WHEN token IS NOT NULL THEN '{SITE}/explore/' || page_id || '?xsec_token=' || token || '&xsec_source=pc_search' ELSE note_url END AS open_url
FROM a
"""

# --- records ----------------------------------------------------------------------------------------------------------


def _notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    return d.select(
        k.cast("string").alias("note_id"), F.concat(F.lit("https://n.example/explore/"), k).alias("note_url"), F.when(k % 5 == 0, F.concat(F.lit("https://s.example/"), k)).otherwise("").alias("share_url"), (k % 7 == 0).alias("can_open_in_web"),
        F.col("source").alias("title_text"), F.when(k % 3 == 0, "").otherwise(F.col("lang")).alias("raw_text"), F.lit("search_title").alias("text_source"), F.when(k % 4 == 0, F.array(F.col("lang"))).otherwise(F.array().cast("array<string>")).alias("image_urls"), F.when(k % 2 == 0, k.cast("string")).alias("publish_timestamp"), k.alias("pos"),
    )


_NOTES_SQL = """notes AS (SELECT CAST(doc_id AS VARCHAR) AS note_id, 'https://n.example/explore/' || doc_id AS note_url, CASE WHEN doc_id % 5 = 0 THEN 'https://s.example/' || doc_id ELSE '' END AS share_url, doc_id % 7 = 0 AS can_open_in_web,
  source AS title_text, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS raw_text, 'search_title' AS text_source, CASE WHEN doc_id % 4 = 0 THEN [lang] ELSE []::VARCHAR[] END AS image_urls, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) END AS publish_timestamp, doc_id AS pos FROM documents)"""


def merged_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with what a detail page says, for every other one."""
    patch = table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("note_id"), F.concat(F.lit("https://p.example/"), "doc_id").alias("share_url"), F.lit(True).alias("can_open_in_web"), F.lit("patched").alias("raw_text"), F.lit("detail_page").alias("text_source"), F.array(F.lit("i1"), F.lit("i2")).alias("image_urls"), F.lit("17").alias("publish_timestamp"))
    merged = payloads.merge_patch(_notes(spark, sf_dir), patch)
    return merged.select("note_id", "note_url", "share_url", "can_open_in_web", "raw_text", "text_source", F.concat_ws(",", "image_urls").alias("images"), F.coalesce("publish_timestamp", F.lit("-")).alias("at"))


MERGED_SQL = f"""
WITH {_NOTES_SQL}, m AS (SELECT *, pos % 2 = 0 AS p FROM notes),
s AS (SELECT *, CASE WHEN share_url = '' AND p THEN 'https://p.example/' || note_id ELSE share_url END AS share FROM m)
SELECT note_id, CASE WHEN share <> '' THEN share ELSE note_url END AS note_url, share AS share_url, can_open_in_web OR p AS can_open_in_web, CASE WHEN raw_text = '' AND p THEN 'patched' ELSE raw_text END AS raw_text,
       CASE WHEN p THEN 'detail_page' ELSE text_source END AS text_source, CASE WHEN len(image_urls) = 0 AND p THEN 'i1,i2' ELSE array_to_string(image_urls, ',') END AS images, coalesce(publish_timestamp, CASE WHEN p THEN '17' END, '-') AS at
FROM s
"""


def filled_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third note, and others in order up to 500 in all."""
    notes = _notes(spark, sf_dir).select("note_id", "note_url", "pos")
    return payloads.back_fill(notes.filter("pos % 3 = 0"), notes, 500)


FILLED_SQL = f"""
WITH {_NOTES_SQL}, r AS (SELECT note_id, note_url, pos FROM notes WHERE pos % 3 = 0),
c AS (SELECT note_id, note_url, pos FROM notes WHERE pos % 3 <> 0 QUALIFY row_number() OVER (ORDER BY pos) <= greatest(0, 500 - (SELECT count(*) FROM r)))
SELECT * FROM r UNION ALL SELECT * FROM c
"""


def looked_up_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links by address, by the id in the address, or to nothing."""
    k = F.col("event_id")
    links = table(spark, sf_dir, "events").select(k, F.when(k % 3 == 0, F.concat(F.lit("https://n.example/explore/"), F.col("user_id"))).when(k % 3 == 1, F.concat(F.lit("https://other.example/explore/"), F.col("user_id"), F.lit("?x=1"))).otherwise("https://none.example/").alias("page_url"))
    records = _notes(spark, sf_dir).select("note_id", "note_url", "title_text", "pos")
    return payloads.lookup_pages(links, records).select("event_id", "page_note_id", F.coalesce("record.note_id", F.lit("-")).alias("found"))


LOOKED_UP_SQL = """
WITH l AS (SELECT event_id, event_id % 3 AS kind, user_id FROM events)
SELECT event_id, CASE WHEN kind < 2 THEN CAST(user_id AS VARCHAR) ELSE '' END AS page_note_id, CASE WHEN kind < 2 AND d.doc_id IS NOT NULL THEN CAST(d.doc_id AS VARCHAR) ELSE '-' END AS found
FROM l LEFT JOIN (SELECT DISTINCT doc_id FROM documents) d ON d.doc_id = l.user_id
"""


def note_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes out of payloads made of documents: walked, recognized, and their fields taken."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    info = F.array(F.struct(F.lit("WB_PRV").alias("image_scene"), F.lit("https://img.example/p.jpg").alias("url")), F.struct(F.lit("WB_DFT").alias("image_scene"), F.concat(F.lit("https://img.example/f"), k, F.lit(".jpg")).alias("url")))
    item = F.struct(
        F.concat(F.lit("n"), k).alias("note_id"), F.when(k % 3 == 0, F.concat(F.lit("t"), k)).alias("xsec_token"), F.col("source").alias("display_title"), F.when(k % 4 == 0, payloads.EMPTY_BODY).when(k % 4 == 1, "").otherwise(F.col("lang")).alias("desc"),
        F.when(k % 5 != 0, k * 1000).alias("time"), F.struct(F.concat(F.lit("//img.example/c"), k, F.lit(".jpg?x=1")).alias("url_default")).alias("cover"), F.array(F.struct(info.alias("info_list"))).alias("image_list"),
        F.when(k % 2 == 0, F.array(F.struct(F.lit("publish_time").alias("type"), F.lit("2024-01-02").alias("text")))).alias("corner_tag_info"),
    )
    walked = payloads.deep_walk(d.select("doc_id", F.to_json(F.struct(F.array(item).alias("items"))).alias("payload")), keep=("doc_id",))
    found = payloads.note_records(walked.filter("kind = 'object'"), SITE, F.lit("2024-06-15 12:00:00").cast("timestamp"), order=("doc_id", "pos"))
    return found.select("doc_id", "note_id", "note_url", "can_open_in_web", "title_text", "raw_text", "text_source", F.concat_ws(",", "image_urls").alias("images"), *[F.coalesce(c, F.lit("-")).alias(c) for c in ("publish_timestamp", "publish_time_text", "publish_time_resolved")])


RECORDS_SQL = f"""
WITH d AS (SELECT doc_id AS k, doc_id % 3 = 0 AS open, source, {STRIP_SQL.format("CASE doc_id % 4 WHEN 0 THEN '还没有简介' WHEN 1 THEN '' ELSE coalesce(lang, '') END")} AS body FROM documents),
r AS (SELECT *, CASE WHEN body = '还没有简介' THEN '' WHEN body <> '' THEN body ELSE coalesce(source, '') END AS raw_text, CASE WHEN k % 2 = 0 THEN '2024-01-02' ELSE '-' END AS said FROM d)
SELECT k AS doc_id, 'n' || k AS note_id, '{SITE}/explore/n' || k || CASE WHEN open THEN '?xsec_token=t' || k || '&xsec_source=pc_search' ELSE '' END AS note_url, open AS can_open_in_web, source AS title_text, raw_text,
       CASE WHEN raw_text <> '' AND raw_text <> coalesce(source, '') THEN 'search_body' ELSE 'search_title' END AS text_source, 'https://img.example/c' || k || '.jpg,https://img.example/f' || k || '.jpg' AS images,
       CASE WHEN k % 5 <> 0 THEN CAST(k * 1000 AS VARCHAR) WHEN k % 2 = 0 THEN '1704153600' ELSE '-' END AS publish_timestamp, said AS publish_time_text, said AS publish_time_resolved
FROM r
"""


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.complete_count(_notes(spark, sf_dir))


def detail_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes(spark, sf_dir).filter(payloads.wants_detail(F.col("title_text"), F.col("raw_text"), F.col("share_url"), F.col("can_open_in_web"))).select("note_id")


def master_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under the names that a master table may have."""
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("ID"), F.col("source").alias("Platform "), F.when(F.col("doc_id") % 11 != 0, F.col("text")).otherwise(" ").alias("Content"), F.lit(" ").alias("time"), F.col("lang").alias("creation_time"), "doc_id")
    return readers.unify_master(rows, F.col("doc_id"))


MASTER_SQL = f"""
SELECT CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id AS VARCHAR) ELSE 'GRP-MASTER-' || lpad(CAST(doc_id + 1 AS VARCHAR), 6, '0') END AS "Source_ID", coalesce(nullif({STRIP_SQL.format('source')}, ''), 'unknown') AS "Platform",
       {STRIP_SQL.format('text')} AS "Raw_Text", coalesce(lang, '') AS "Timestamp", 'text' AS "Data_Type"
FROM documents WHERE doc_id % 11 <> 0 AND {STRIP_SQL.format('text')} <> ''
"""


def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    said = F.when(k % 4 == 0, F.concat(F.lit(" 00"), k)).when(k % 4 == 1, F.concat(k, F.lit(".75"))).when(k % 4 == 2, " soon ").otherwise(None)
    return table(spark, sf_dir, "events").select(k, F.coalesce(times.normalize_timestamp(said), F.lit("-")).alias("at"), first_present(F.when(k % 3 == 0, " "), F.when(k % 3 != 1, F.col("event_type"))).alias("kind"))


TIMESTAMPS_SQL = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN 'soon' ELSE '-' END AS at, CASE event_id % 3 WHEN 0 THEN '' WHEN 2 THEN event_type ELSE '' END AS kind FROM events
"""

# --- pictures ---------------------------------------------------------------------------------------------------------


def media_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types by file name, and suffixes by address, else by the type that a response names."""
    k = F.col("page_id")
    said = F.when(k % 3 == 0, " image/png; q=1").when(k % 3 == 1, "image/webp").otherwise("text/html")
    name = F.concat(F.lit("/d.x/f"), k, F.element_at(F.array(*[F.lit(e) for e in (".png", ".JPEG", ".gif", ".bmp", ".webp", ".txt", "")]), (k % 7 + 1).cast("int")))
    return table(spark, sf_dir, "pages").select("page_id", urls.mime_type(name).alias("by_name"), urls.infer_extension(F.concat("url", F.when(k % 5 == 0, "/P.HEIC?w=1").otherwise("")), said).alias("suffix"))


MEDIA_SQL = """
WITH p AS (SELECT page_id AS k, url || CASE WHEN page_id % 5 = 0 THEN '/P.HEIC?w=1' ELSE '' END AS u, CASE page_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.webp' ELSE '.jpg' END AS said FROM pages)
SELECT k AS page_id, ['image/png', 'image/jpeg', 'image/gif', 'image/bmp', 'image/webp', 'image/jpeg', 'image/jpeg'][CAST(k % 7 AS INTEGER) + 1] AS by_name,
       CASE WHEN contains(lower(u), '.jpg') THEN '.jpg' WHEN contains(lower(u), '.jpeg') THEN '.jpeg' WHEN contains(lower(u), '.png') THEN '.png' WHEN contains(lower(u), '.webp') THEN '.webp' WHEN contains(lower(u), '.heic') THEN '.heic' WHEN contains(lower(u), '.gif') THEN '.gif' ELSE said END AS suffix
FROM p
"""


def person_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of pictures by a detector's boxes, made of orders' lines; every fifth picture has no detector."""
    li = table(spark, sf_dir, "lineitem")
    x, side = F.col("l_linenumber") * 10.0, F.col("l_quantity")
    box = F.struct(x.alias("x1"), F.lit(0.0).alias("y1"), (x + side - 3).alias("x2"), side.alias("y2"), (F.col("l_discount") * 5).alias("confidence"))
    each = li.groupBy("l_orderkey").agg(F.collect_list(box).alias("boxes"))
    found = each.select("l_orderkey", images.person_metrics(F.when(F.col("l_orderkey") % 5 != 0, F.col("boxes")), F.lit(4000)).alias("p"))
    return found.select("l_orderkey", "p.person_count", *[F.round(f"p.{c}", 6).alias(c) for c in images.METRICS[5:]])


PERSON_SQL = """
WITH b AS (SELECT l_orderkey, l_discount * 5 AS c, greatest(0, l_quantity - 3) * greatest(0, l_quantity) / 4000 AS area FROM lineitem),
p AS (SELECT l_orderkey, count(*) FILTER (c >= 0.25::DOUBLE) AS n, sum(area) FILTER (c >= 0.25::DOUBLE) AS total, max(area) FILTER (c >= 0.25::DOUBLE) AS top, max(c) FILTER (c >= 0.25::DOUBLE) AS conf FROM b GROUP BY 1)
SELECT l_orderkey, CAST(CASE WHEN l_orderkey % 5 = 0 THEN -1 ELSE n END AS INTEGER) AS person_count, round(CASE WHEN l_orderkey % 5 = 0 THEN -1 ELSE least(1, coalesce(total, 0)) END, 6) AS total_person,
       round(CASE WHEN l_orderkey % 5 = 0 THEN -1 ELSE least(1, coalesce(top, 0)) END, 6) AS max_person, round(CASE WHEN l_orderkey % 5 = 0 THEN -1 ELSE coalesce(conf, 0) END, 6) AS max_conf
FROM p
"""


def base64_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(images.base64_text(F.col("html").cast("binary"))).alias("md5"))


def detail_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first usable detail in payloads made of documents."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    detail = F.struct(F.when(k % 3 != 0, F.col("source")).alias("desc"), F.when(k % 4 == 0, k * 10).alias("time"), F.array(F.struct(F.concat(F.lit("//img.example/d"), k, F.when(k % 2 == 0, ".jpg").otherwise("_avatar.jpg")).alias("url"))).alias("image_list"))
    payload = F.to_json(F.struct(F.struct(k.alias("x")).alias("a"), detail.alias("detail"), F.struct(F.lit("later").alias("title")).alias("z")))
    walked = payloads.deep_walk(d.select("doc_id", payload.alias("payload")), keep=("doc_id",))
    return payloads.first_detail(walked, SITE, ("doc_id",)).select("doc_id", "raw_text", F.concat_ws(",", "image_urls").alias("images"), F.coalesce("publish_timestamp", F.lit("-")).alias("at"))


DETAIL_SQL = """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN coalesce(trim(source), '') ELSE '' END AS t, CASE WHEN doc_id % 2 = 0 THEN 'https://img.example/d' || doc_id || '.jpg' ELSE '' END AS i, CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id * 10 AS VARCHAR) END AS said FROM documents)
SELECT doc_id, CASE WHEN t <> '' OR i <> '' OR said IS NOT NULL THEN t ELSE 'later' END AS raw_text, i AS images, coalesce(said, '-') AS at FROM d
"""

# --- runs -------------------------------------------------------------------------------------------------------------


def annotation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    log = table(spark, sf_dir, "events").select(F.when(k % 5 == 0, "error").when(k % 5 == 1, "skipped").otherwise("annotated").alias("run_status"), F.when(k % 3 == 0, "use").when(k % 3 == 1, "reject").otherwise("").alias("Curation_Status"), F.col("event_type").alias("Image_Category"), F.when(k % 2 == 0, "none").otherwise(" ").alias("Reject_Reason"))
    names = ("curation_status_breakdown", "image_category_breakdown", "reject_reason_breakdown")
    said = [F.concat_ws(",", F.transform(F.map_entries(n), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias(n) for n in names]
    return labels.annotation_log(log).select("total_candidates", "annotated_count", "skipped_existing", "error_count", *said)


_BREAKDOWN = "(SELECT string_agg(v || '=' || n, ',' ORDER BY v) FROM (SELECT coalesce(nullif(trim({c}), ''), 'unknown') AS v, count(*) AS n FROM log {w} GROUP BY 1)) AS {n}"
ANNOTATION_SQL = f"""
WITH log AS (SELECT CASE event_id % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'skipped' ELSE 'annotated' END AS run_status, CASE event_id % 3 WHEN 0 THEN 'use' WHEN 1 THEN 'reject' ELSE '' END AS status, event_type AS category, CASE WHEN event_id % 2 = 0 THEN 'none' ELSE ' ' END AS reason FROM events)
SELECT count(*) AS total_candidates, count(*) FILTER (run_status = 'annotated') AS annotated_count, count(*) FILTER (run_status = 'skipped') AS skipped_existing, count(*) FILTER (run_status = 'error') AS error_count,
  {_BREAKDOWN.format(c='status', w='', n='curation_status_breakdown')}, {_BREAKDOWN.format(c='category', w='', n='image_category_breakdown')}, {_BREAKDOWN.format(c='reason', w="WHERE status = 'reject'", n='reject_reason_breakdown')}
FROM log
"""


def video_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = reviews.flag_pain(table(spark, sf_dir, "conversations"), words=("the", "que"))
    return reviews.video_summary(talk.filter("role = 'user'"), talk.filter("role != 'user'"))


VIDEO_SQL = """
WITH t AS (SELECT role, contains(coalesce(text, ''), 'the') OR contains(coalesce(text, ''), 'que') AS p FROM conversations)
SELECT count(*) FILTER (role = 'user') AS total_danmaku, count(*) FILTER (role = 'user' AND p) AS pain_point_danmaku, count(*) FILTER (role <> 'user') AS total_comments, count(*) FILTER (role <> 'user' AND p) AS pain_point_comments FROM t
"""


def _analysis(spark: SparkSession, sf_dir: str) -> text_analysis.TextAnalysis:
    from skein.plans.queries import unify_records

    return text_analysis.TextAnalysis.of(unify_records(spark, sf_dir), LATIN)


def analysis_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of the whole text analysis, over records of all platforms."""
    features = _analysis(spark, sf_dir).feature_vectors
    return features.select("Source_ID", "Platform", F.md5("Cleaned_Text").alias("text_md5"), "Keywords", "Pain_Points", "Sentiment", "Sentiment_Score", "Reason", "Design_Implications")


def analysis_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _analysis(spark, sf_dir).report()
    return report.select("section", F.col("rank").cast("int").alias("rank"), "key", F.col("value").cast("long").alias("n"), F.round(F.coalesce("percent", F.lit(-1.0)), 6).alias("percent"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        comment_pages, item_pages, unique_videos, note_addresses, merged_notes, filled_results, looked_up_pages, completeness, detail_wanted, master_records, timestamps, annotation_log, video_summary,
        analysis_features, analysis_report, note_records, media_types, person_boxes, base64_texts, detail_fields,
    )
    return {f.__name__: f for f in found}


ORACLE: dict[str, str] = {
    "comment_pages": COMMENTS_SQL,
    "item_pages": "SELECT page_id, CAST(i AS INTEGER) AS pos, '{\"k\":' || (page_id + i) || '}' AS item FROM pages, (VALUES (0), (1)) AS v(i)",
    "unique_videos": VIDEOS_SQL,
    "note_addresses": ADDRESSES_SQL,
    "merged_notes": MERGED_SQL,
    "filled_results": FILLED_SQL,
    "looked_up_pages": LOOKED_UP_SQL,
    "media_types": MEDIA_SQL,
    "person_boxes": PERSON_SQL,
    "base64_texts": "SELECT page_id, md5(base64(encode(html))) AS md5 FROM pages",
    "detail_fields": DETAIL_SQL,
    "note_records": RECORDS_SQL,
    "completeness": "SELECT count(*) AS complete FROM documents WHERE doc_id % 3 <> 0 AND coalesce(lang, '') <> '' AND doc_id % 4 = 0",
    "detail_wanted": "SELECT CAST(doc_id AS VARCHAR) AS note_id FROM documents WHERE doc_id % 7 = 0 AND doc_id % 5 = 0",
    "master_records": MASTER_SQL,
    "timestamps": TIMESTAMPS_SQL,
    "annotation_log": ANNOTATION_SQL,
    "video_summary": VIDEO_SQL,
}
