"""Notes out of crawled JSON payloads: the walk through all nested values, note records, and their merging."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import computed, first_nonblank
from skein.functions.times import normalize_timestamp, publish_epoch, publish_resolved
from skein.functions.urls import accessible_url, is_note_url, is_preview_image, looks_like_image, normalize_url, note_url, share_url

# Names under which payloads carry each thing, best first.
ID_KEYS = ("note_id", "id", "item_id")
URL_KEYS = ("note_url", "url", "share_url")
TITLE_KEYS = ("display_title", "title")
BODY_KEYS = ("desc", "content", "note_content")
TIME_KEYS = ("publish_time", "time", "timestamp", "last_update_time", "create_time")
TIME_TEXT_KEYS = ("publish_time_text", "time_text", "publish_date", "date")
MEDIA_KEYS = ("images", "images_list", "imageList", "img_list", "media", "cover_info")
DETAIL_MEDIA_KEYS = ("image_list", "images", "imageList", "note_card", "media")
EMPTY_BODY = "还没有简介"
FULL_SCENE = "WB_DFT"
SHORT_TEXT = 24


def deep_walk(payloads: DataFrame, json_col: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Every value of each JSON text in pre-order: kept columns, pos, depth, kind (object, array, string, number, boolean, null) and its JSON text.

    Depth is unbounded and the walk holds one payload at a time. Text that is no JSON gives no rows.
    """
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        kinds = {dict: "object", list: "array", str: "string", int: "number", float: "number", bool: "boolean", type(None): "null"}
        for batch in batches:
            for row, text in enumerate(batch.column(len(names)).to_pylist()):
                try:
                    root = json.loads(text) if text is not None else None
                except ValueError:
                    continue
                if text is None:
                    continue
                found, stack = [], [(root, 0)]
                while stack:
                    value, depth = stack.pop()
                    found.append((len(found), depth, kinds[type(value)], json.dumps(value, ensure_ascii=False)))
                    below = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
                    stack.extend((v, depth + 1) for v in reversed(list(below)))
                own = batch.slice(row, 1).select(range(len(names))).take(pa.array([0] * len(found))) if names else None
                columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*(own.columns if own is not None else ()), *columns], [*names, "pos", "depth", "kind", "value"])

    read = payloads.select(*names, F.col(json_col).cast("string").alias("_json"))
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in read.schema.fields[:-1])
    return read.mapInArrow(run, f"{ddl}pos int, depth int, kind string, value string")


def script_json(c: Column) -> Column:
    """The widest {...} or [...] of a script's text."""
    return F.nullif(F.regexp_extract(c, r"(?s)\{.*\}|\[.*\]", 0), F.lit(""))


def _fields(item: Column, path: str = "$") -> Column:
    """The fields of a JSON object by name; null for anything else."""
    return F.try_variant_get(item, path, "map<string,variant>")


def _string(fields: Column, names: Sequence[str]) -> Column:
    """The first field that is a string with more than white space."""
    found = [F.try_element_at(fields, F.lit(n)) for n in names]
    return first_nonblank(*[F.when(F.schema_of_variant(x) == "STRING", x.cast("string")) for x in found])


def _value(fields: Column, names: Sequence[str]) -> Column:
    """The first field that is neither null nor an empty string, as text; null without one."""
    return F.coalesce(*[F.nullif(F.try_variant_get(F.try_element_at(fields, F.lit(n)), "$", "string"), F.lit("")) for n in names])


INFO = "array<struct<info_list:array<struct<url:string,image_scene:string>>>>"


def note_images(item: Column, site: str, under: str = "$", hosts: tuple[str, ...] = ()) -> Column:
    """Distinct image addresses: cover, then one of each listed image (the full scene, else the first), then those found in media fields. Avatars and previews are left out."""

    def good(urls: Column) -> Column:
        return F.filter(urls, lambda u: (u != "") & ~F.contains(F.lower(u), F.lit("avatar")) & ~is_preview_image(u))

    def clean(urls: Column) -> Column:
        return F.transform(urls, lambda u: normalize_url(u, site))

    none = F.array().cast("array<string>")
    cover = good(clean(F.array(*[F.coalesce(F.try_variant_get(item, f"{under}.cover.{k}", "string"), F.lit("")) for k in ("url_default", "url")])))
    listed = F.coalesce(F.try_variant_get(item, f"{under}.image_list", INFO), F.array().cast(INFO))

    def pick(image: Column) -> Column:
        infos = F.coalesce(image["info_list"], F.array().cast("array<struct<url:string,image_scene:string>>"))
        full = good(clean(F.transform(F.filter(infos, lambda i: i["image_scene"] == FULL_SCENE), lambda i: F.coalesce(i["url"], F.lit("")))))
        any_ = good(clean(F.transform(infos, lambda i: F.coalesce(i["url"], F.lit("")))))
        return F.slice(F.concat(full, any_), 1, 1)

    deep = none
    for k in MEDIA_KEYS:
        text = F.coalesce(F.to_json(F.try_variant_get(item, f"{under}.{k}", "variant")), F.lit(""))
        urls = F.transform(F.regexp_extract_all(text, F.lit(r'"((?:https?:)?//[^"\\]*(?:\\.[^"\\]*)*)"'), 1), lambda u: F.regexp_replace(u, r"\\/", "/"))
        deep = F.concat(deep, F.filter(good(clean(urls)), lambda u: looks_like_image(u, hosts)))
    return F.array_distinct(F.concat(cover, F.flatten(F.transform(listed, pick)), deep))


def note_records(items: DataFrame, site: str, now: Column, value_col: str = "value", keyword: Column | None = None, order: Sequence[str] = ("pos",), hosts: tuple[str, ...] = ()) -> DataFrame:
    """Note records of the walked objects that look like notes; value_col is the objects' JSON text.

    A note needs an id and an address, and a text, an image or a time. A body equal to the placeholder is empty. The text is
    the body, else the title, and text_source says which.
    """
    parsed = computed(items, _v=F.try_parse_json(value_col)).filter(F.col("_v").isNotNull())
    looked = computed(parsed, _own=_fields(F.col("_v")), _in_card=_fields(F.col("_v"), "$.note_card"))
    v, own, card, has_card = F.col("_v"), F.col("_own"), F.col("_in_card"), F.col("_in_card").isNotNull()

    def of(get, names: Sequence[str]) -> Column:
        return get(F.when(has_card, card).otherwise(own), names)

    def tag(path: str) -> Column:
        tags = F.try_variant_get(v, f"{path}.corner_tag_info", "array<struct<type:string,text:string>>")
        return F.filter(tags, lambda t: (t["type"] == "publish_time") & (F.trim(t["text"]) != ""))[0]["text"]

    fields = computed(
        looked,
        _id=_string(own, ID_KEYS), _card_id=_string(card, ID_KEYS), _direct=_string(own, URL_KEYS), _direct_card=_string(card, URL_KEYS),
        xsec_token=F.nullif(first_nonblank(_string(own, ("xsec_token",)), _string(card, ("xsec_token",))), F.lit("")),
        title_text=F.nullif(of(_string, TITLE_KEYS), F.lit("")), _body=of(_string, BODY_KEYS), _time=of(_value, TIME_KEYS), _own_time=_value(own, TIME_KEYS), _own_text=_string(own, (*BODY_KEYS, *TITLE_KEYS)),
        _tag=F.when(has_card, tag("$.note_card")).otherwise(tag("$")), _time_text=of(_string, TIME_TEXT_KEYS), _own_images=note_images(v, site, hosts=hosts), _card_images=note_images(v, site, "$.note_card", hosts), _card=has_card,
    ).withColumn("note_id", first_nonblank(F.col("_id"), F.col("_card_id")))
    likely = (F.col("_id") != "") & ((F.col("_own_text") != "") | F.col("_own_time").isNotNull() | (F.size("_own_images") > 0) | F.col("_card"))
    url = first_nonblank(note_url(F.col("_direct"), F.col("_id"), site), note_url(F.col("_direct_card"), F.col("note_id"), site))
    share = share_url(F.col("note_id"), F.col("xsec_token"), site)
    body = F.when(F.col("_body") != "", F.col("_body")).otherwise(F.coalesce("title_text", F.lit("")))
    built = computed(
        fields.filter(likely),
        share_url=share, _url=url, raw_text=F.when(body == EMPTY_BODY, "").otherwise(body), publish_time_text=F.nullif(first_nonblank(F.col("_tag"), F.col("_time_text")), F.lit("")),
        image_urls=F.when(F.col("_card") & (F.size("_card_images") > 0), F.col("_card_images")).otherwise(F.col("_own_images")),
    )
    timed = computed(built, publish_timestamp=F.coalesce(normalize_timestamp(F.col("_time")), publish_epoch(F.col("publish_time_text"), now).cast("string")))
    timed = timed.withColumn("publish_time_resolved", publish_resolved(F.col("publish_time_text"), F.col("publish_timestamp").try_cast("long")))
    useful = (F.col("note_id") != "") & (F.col("_url") != "") & ((F.col("raw_text") != "") | (F.size("image_urls") > 0) | F.col("publish_timestamp").isNotNull())
    source = F.when((F.col("raw_text") != "") & (F.col("raw_text") != F.coalesce("title_text", F.lit(""))), "search_body").otherwise("search_title")
    return timed.filter(useful).select(
        *order, (F.lit(None).cast("string") if keyword is None else keyword).alias("keyword"), "note_id", accessible_url(F.col("_url"), F.col("share_url")).alias("note_url"), "share_url", "xsec_token",
        F.col("share_url").isNotNull().alias("can_open_in_web"), "title_text", "raw_text", source.alias("text_source"), "image_urls", F.array().cast("array<string>").alias("downloaded_image_paths"), "publish_timestamp", "publish_time_text", "publish_time_resolved",
    )


def first_per_key(rows: DataFrame, key: str, order: Sequence[str], fill: Sequence[str] = (), empty_is_missing: bool = True) -> DataFrame:
    """The first row of each key, in which the fields named in `fill` take their first non-empty value of any row. One aggregation, pre-aggregated before the shuffle."""
    at = F.struct(*[F.col(o) for o in order])

    def missing(c: str) -> Column:
        kind = rows.schema[c].dataType.typeName()
        none = F.col(c).isNull()
        if empty_is_missing and kind == "array":
            none = none | (F.size(c) == 0)
        elif empty_is_missing and kind == "string":
            none = none | (F.col(c) == "")
        return none

    others = [c for c in rows.columns if c != key and c not in fill]
    aggregated = [F.min(F.struct(at.alias("at"), *[F.struct(F.col(c)).alias(c) for c in others])).alias("_first")]
    aggregated += [F.min_by(F.struct(F.col(c)), F.when(~missing(c), at)).alias(f"_{c}") for c in fill]
    aggregated += [F.min_by(F.struct(F.col(c)), at).alias(f"_first_{c}") for c in fill]
    out = rows.groupBy(key).agg(*aggregated)
    return out.select(*[F.col(c) if c == key else F.coalesce(F.col(f"_{c}.{c}"), F.col(f"_first_{c}.{c}")).alias(c) if c in fill else F.col(f"_first.{c}.{c}").alias(c) for c in rows.columns])


def merge_patch(base: DataFrame, patch: DataFrame, key: str = "note_id") -> DataFrame:
    """base with empty fields taken from patch; the share address prevails, and a text source other than the title's."""
    p = patch.select(*[F.col(c).alias(f"p_{c}") for c in patch.columns])
    joined = base.join(p, F.col(key) == F.col(f"p_{key}"), "left")

    def filled(c: str) -> Column:
        kind = base.schema[c].dataType.typeName()
        if f"p_{c}" not in joined.columns or c == key:
            return F.col(c)
        if c == "text_source":
            return F.when((F.col(c) == "search_title") & (F.col(f"p_{c}") != "search_title"), F.col(f"p_{c}")).otherwise(F.col(c))
        if kind == "boolean":
            return F.col(c) | F.coalesce(F.col(f"p_{c}"), F.lit(False))
        if kind == "array":
            return F.when(F.size(F.coalesce(F.col(c), F.array().cast(base.schema[c].dataType))) == 0, F.coalesce(F.col(f"p_{c}"), F.col(c))).otherwise(F.col(c))
        if kind == "string":
            return F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(f"p_{c}"), F.lit("")), F.col(c))
        return F.coalesce(F.col(c), F.col(f"p_{c}"))

    out = {c: filled(c) for c in base.columns}
    if "note_url" in out and "share_url" in out:
        out["note_url"] = accessible_url(F.col("note_url"), out["share_url"])
    return joined.select(*[e.alias(c) for c, e in out.items()])


def lookup_pages(links: DataFrame, records: DataFrame, link_col: str = "page_url", order: Sequence[str] = ("pos",)) -> DataFrame:
    """links with the record of the same address, else of the id in the address, else none. Records are made unique by address and by id first."""
    fields = [c for c in records.columns if c not in order]
    by_url = first_per_key(records, "note_url", order).select(F.struct(*fields).alias("_u"), F.col("note_url").alias("_ukey"))
    by_id = first_per_key(records, "note_id", order).select(F.struct(*fields).alias("_i"), F.col("note_id").alias("_ikey"))
    with_id = links.withColumn("_id", F.regexp_extract(link_col, r"/explore/([^/?]+)", 1))
    found = with_id.join(by_url, F.col(link_col) == F.col("_ukey"), "left").join(by_id, F.col("_id") == F.col("_ikey"), "left")
    return found.select(*links.columns, F.coalesce("_u", "_i").alias("record"), F.col("_id").alias("page_note_id"))


def back_fill(results: DataFrame, candidates: DataFrame, target: int, key: str = "note_url", order: Sequence[str] = ("pos",)) -> DataFrame:
    """results and, up to `target` rows in all, candidates whose key they lack, in order."""
    missing = candidates.join(results.select(key).distinct(), key, "left_anti")
    want = max(0, target - results.count())
    return results.unionByName(first_per_key(missing, key, order).orderBy(*order).limit(want).select(*results.columns))


def complete_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if((F.coalesce("raw_text", F.lit("")) != "") & (F.size("image_urls") > 0) & F.col("publish_timestamp").isNotNull()).alias("complete"))


def wants_detail(title: Column, text: Column, share: Column, can_open: Column) -> Column:
    """Whether a note's text should be fetched in full: accessible, and empty, equal to the title, or short."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.coalesce(can_open, F.lit(False)) & (F.coalesce(share, F.lit("")) != "") & ((t == "") | F.coalesce(t == F.trim(title), F.lit(False)) | (F.length(t) <= SHORT_TEXT))


def first_detail(walked: DataFrame, site: str, key: Sequence[str], hosts: tuple[str, ...] = ()) -> DataFrame:
    """Of the walked objects of each key, the first with a text, a media or a time field that yields any of them."""
    parsed = computed(walked.filter("kind = 'object'"), _v=F.try_parse_json("value"))
    parsed, v = computed(parsed, _own=_fields(F.col("_v"))), F.col("_own")
    urls = F.regexp_extract_all(F.col("value"), F.lit(r'"((?:https?:)?//[^"]*)"'), 1)
    fields = computed(
        parsed.select(*key, "pos", "value", "_own"), raw_text=_string(v, (*BODY_KEYS, *TITLE_KEYS)), image_urls=F.array_distinct(F.filter(F.transform(urls, lambda u: normalize_url(u, site)), lambda u: looks_like_image(u, hosts))),
        publish_timestamp=normalize_timestamp(_value(v, TIME_KEYS)), _any=F.exists(F.json_object_keys("value"), lambda k: k.isin(*BODY_KEYS, *TITLE_KEYS, *DETAIL_MEDIA_KEYS, *TIME_KEYS)),
    ).drop("value", "_own")
    useful = fields.filter(F.col("_any") & ((F.col("raw_text") != "") | (F.size("image_urls") > 0) | F.col("publish_timestamp").isNotNull())).drop("_any")
    at = F.struct("pos", "raw_text", "image_urls", "publish_timestamp")
    return useful.groupBy(*key).agg(F.min_by(at, "pos").alias("d")).select(*key, "d.*")


__all__ = ["back_fill", "complete_count", "deep_walk", "first_detail", "first_per_key", "is_note_url", "lookup_pages", "merge_patch", "note_images", "note_records", "script_json", "wants_detail"]
