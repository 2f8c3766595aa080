"""Column functions for addresses and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import first_nonblank, strip

# Suffixes in the order they are looked for, media types, and marks of images and previews.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".heic", ".gif")
MEDIA_EXTENSIONS = {"image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/heic": ".heic", "image/gif": ".gif", "image/bmp": ".bmp", "image/tiff": ".tiff", "image/svg+xml": ".svg"}
IMAGE_MARKS = (".jpg", ".jpeg", ".png", ".webp", ".heic", "imageview2", "!nc_n_")
SEARCH_MARKS = ("search", "homefeed", "notefeed", "web/v1/", "sns/web/v1/")
NOTE_MARKS = ("/explore/", "/discovery/item/")
MIME_BY_SUFFIX = {".png": "image/png", ".webp": "image/webp", ".gif": "image/gif", ".bmp": "image/bmp", ".jpg": "image/jpeg", ".jpeg": "image/jpeg"}


def normalize_url(c: Column, site: str) -> Column:
    """Stripped, with a scheme, absolute on `site`, without query. Null, blank and inline images become empty."""
    u = F.coalesce(strip(c), F.lit(""))
    full = F.when(u.startswith("data:image/"), "").when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/"), F.concat(F.lit(site.rstrip("/")), u)).otherwise(u)
    return F.regexp_replace(full, r"\?.*$", "")


def sanitize_filename(c: Column) -> Column:
    """Runs of characters that file names may not have become one underscore; 80 characters at most; empty becomes untitled."""
    return F.coalesce(F.nullif(F.substring(strip(F.regexp_replace(c, r'[\\/:*?"<>|]+', "_")), 1, 80), F.lit("")), F.lit("untitled"))


def infer_extension(url: Column, content_type: Column | None = None) -> Column:
    """The first known suffix anywhere in the address, else by media type, else .jpg."""
    low = F.lower(url)
    out = F.lit(".jpg") if content_type is None else F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in MEDIA_EXTENSIONS.items() for x in kv]), strip(F.split_part(content_type, F.lit(";"), F.lit(1)))), F.lit(".jpg"))
    for e in reversed(EXTENSIONS):
        out = F.when(F.contains(low, F.lit(e)), e).otherwise(out)
    return out


def mime_type(path: Column) -> Column:
    """By the suffix of a file name, JPEG if it says nothing."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in MIME_BY_SUFFIX.items() for x in kv]), suffix), F.lit("image/jpeg"))


def is_note_url(c: Column) -> Column:
    return F.contains(c, F.lit(NOTE_MARKS[0])) | F.contains(c, F.lit(NOTE_MARKS[1]))


def is_search_response(c: Column, domain: str) -> Column:
    """Whether an address of the domain answers a search or a feed."""
    low = F.lower(c)
    found = F.lit(False)
    for mark in SEARCH_MARKS:
        found = found | F.contains(low, F.lit(mark))
    return F.contains(low, F.lit(domain.lower())) & found


def is_preview_image(c: Column) -> Column:
    return F.contains(F.lower(c), F.lit("_prv"))


def looks_like_image(c: Column, hosts: tuple[str, ...] = ()) -> Column:
    low = F.lower(c)
    found = F.lit(False)
    for mark in (*IMAGE_MARKS, *hosts):
        found = found | F.contains(low, F.lit(mark))
    return found & ~F.contains(low, F.lit("avatar"))


def note_url(direct: Column, note_id: Column, site: str) -> Column:
    """A direct note address, normalized, else one made of the id, else empty."""
    return F.when(is_note_url(direct), normalize_url(direct, site)).when(note_id != "", F.concat(F.lit(f"{site.rstrip('/')}/explore/"), note_id)).otherwise("")


def share_url(note_id: Column, token: Column, site: str) -> Column:
    """An address that carries an access token; null without either."""
    query = F.concat(F.lit("?xsec_token="), F.url_encode(token), F.lit("&xsec_source=pc_search"))
    return F.when((F.coalesce(note_id, F.lit("")) != "") & (F.coalesce(token, F.lit("")) != ""), F.concat(F.lit(f"{site.rstrip('/')}/explore/"), note_id, query))


def accessible_url(url: Column, share: Column) -> Column:
    return first_nonblank(share, url)


def normalize_path(base: str, c: Column) -> Column:
    """A relative path under base, with forward slashes. Absolute paths stay, blank ones become null."""
    p = F.regexp_replace(strip(c), r"\\", "/")
    return F.when(p == "", None).when(p.startswith("/"), p).otherwise(F.concat_ws("/", F.lit(base.rstrip("/")), F.regexp_replace(p, r"^\./", "")))
