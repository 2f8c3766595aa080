"""Rows out of response pages: comments, item lists, video links and video ids. Fetching is the caller's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Where responses carry their lists, best first, and what a video's address looks like.
NESTED_ITEMS = ("$.model.itemList", "$.model.items", "$.model.itemsArray", "$.items", "$")
PLAIN_ITEMS = ("$", "$.items")
VIDEO_ID = r"/video/(BV\w+)"
SHORTEST_ID, TITLE_LENGTH = 6, 80

_REPLY = "array<struct<rpid:string,like:bigint,content:struct<message:string>>>"
_COMMENTS = f"struct<data:struct<top_replies:{_REPLY},hots:{_REPLY},replies:{_REPLY}>>"


def comment_rows(pages: DataFrame, json_col: str = "payload", key: str = "bvid", page_col: str = "page") -> DataFrame:
    """(key, page, pos, rpid, text, like_count): the comments of each video's pages, in order, each rpid once per video.

    Page 0 is the one by heat: its pinned and hot comments come before its replies. Of the others only replies count. Comments without text
    are passed over before repeats are; a missing like is 0, a missing rpid empty. Text that is no JSON gives no rows.
    """
    data = F.from_json(F.col(json_col), _COMMENTS)["data"]
    none = F.array().cast(_REPLY)
    heat = F.when(F.col(page_col) == 0, F.concat(F.coalesce(data["top_replies"], none), F.coalesce(data["hots"], none))).otherwise(none)
    each = pages.select(key, page_col, F.posexplode(F.concat(heat, F.coalesce(data["replies"], none))).alias("pos", "r"))
    rows = each.select(key, page_col, "pos", F.coalesce("r.rpid", F.lit("")).alias("rpid"), F.col("r.content.message").alias("text"), F.coalesce("r.like", F.lit(0)).alias("like_count")).filter("text != ''")
    return rows.groupBy(key, "rpid").agg(F.min(F.struct(page_col, "pos", "text", "like_count")).alias("first")).select(key, f"first.{page_col}", "first.pos", "rpid", "first.text", "first.like_count")


def item_rows(pages: DataFrame, json_col: str = "payload", keep: Sequence[str] = (), paths: Sequence[str] = NESTED_ITEMS, most: int | None = None) -> DataFrame:
    """Kept columns, pos and the JSON text of each item of the first list that is there and not empty; the first `most` items of a page, all if None."""
    parsed = F.try_parse_json(json_col)
    lists = [F.try_variant_get(F.col("_parsed"), p, "array<variant>") for p in paths]
    chosen = F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])
    items = F.transform(chosen, lambda v: F.to_json(v))
    each = pages.select(*keep, parsed.alias("_parsed")).select(*keep, F.posexplode(items if most is None else F.slice(items, 1, most)).alias("pos", "item"))
    return each.filter("item IS NOT NULL")


def unique_videos(links: DataFrame, href_col: str = "href", title_col: str = "title", key: str = "keyword", pos_col: str = "pos", most: int | None = None) -> DataFrame:
    """(key, pos, bvid, title): each video once per key, by its first link, and the first `most` of a key, all if None. Titles are trimmed and cut."""
    found = links.select(key, pos_col, F.regexp_extract(href_col, VIDEO_ID, 1).alias("bvid"), F.substring(F.trim(F.coalesce(F.col(title_col), F.lit(""))), 1, TITLE_LENGTH).alias("title")).filter(F.length("bvid") >= SHORTEST_ID)
    first = found.groupBy(key, "bvid").agg(F.min(F.struct(pos_col, "title")).alias("first")).select(key, f"first.{pos_col}", "bvid", "first.title")
    if most is None:
        return first
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(pos_col))).filter(F.col("_n") <= most).drop("_n")


def video_ids(pages: DataFrame, json_col: str = "payload", keep: Sequence[str] = ("bvid",)) -> DataFrame:
    """Kept columns, aid and the cid of the first part; videos that lack either have no row."""
    data = F.from_json(F.col(json_col), "struct<data:struct<aid:bigint,pages:array<struct<cid:bigint>>>>")["data"]
    return pages.select(*keep, data["aid"].alias("aid"), F.get(data["pages"], F.lit(0))["cid"].alias("cid")).filter("aid != 0 AND cid != 0")


def union_keywords(results: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The rows of all keywords, in the order given: keyword and kw_ord before the columns of the first."""
    if not results:
        raise ValueError("no results")
    parts = [df.select(F.lit(keyword).alias("keyword"), F.lit(k).alias("kw_ord"), *[c for c in df.columns if c not in ("keyword", "kw_ord")]) for k, (keyword, df) in enumerate(results)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
