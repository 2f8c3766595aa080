"""Dropping lines that many documents share, with DataFrame functions only.

Lines are exploded with their positions, normalised to keys and hashed; documents are counted per hash with partial sums before the
shuffle. The frequent hashes are written to the shared folder. The HOT_KEYS most frequent of them are broadcast, a table of bounded
size; after them no hash has more than a HOT_KEYS-th of all lines, so that the join with the others has no hot key. Each document's
dropped positions then meet its text once, which is cut between them and put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.storage import staged

#: Most frequent hashes, which are broadcast: 16 bytes each.
HOT_KEYS = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = " \t\n\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    """The keys of a text's lines: without white space at both ends, A-Z lower-cased and no other letter."""
    bare = F.transform(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(_BLANK)))
    # of ASCII alone the built-in lower case is the same, and many times faster
    return F.transform(bare, lambda b: F.when(F.octet_length(b) == F.length(b), F.lower(b)).otherwise(F.translate(b, _UPPER, _LOWER)))


def _hashes(*of: Column) -> list[Column]:
    """Two hashes of different seeds: 128 bits, so that two lines in 10^15 meet with a chance under 10^-8."""
    return [F.xxhash64(*of).alias("h1"), F.xxhash64(F.lit(20240517), *of).alias("h2")]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and text of each row, and r1, r2, which tell rows apart that differ in id or text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    r1, r2 = _hashes(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text"))
    return rows.select("doc_id", "text", r1.alias("r1"), r2.alias("r2"))


def frequent_lines(docs: DataFrame, documents: int = 10, chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """h1, h2, n: hashes of the keys of at least `chars` code points that are found in at least `documents` rows, and in how many."""
    keys = F.filter(line_keys(F.col("text")), lambda k: F.length(k) >= chars)
    each = _rows(docs, id_col, text_col).select(F.explode(F.array_distinct(keys)).alias("key")).select(*_hashes(F.col("key")))
    return each.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= documents)


def drop_common_lines(docs: DataFrame, documents: int = 10, chars: int = 1, id_col: str = "doc_id", text_col: str = "text", hot_keys: int = HOT_KEYS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text per row: texts without the lines whose key is found in at least `documents` rows.

    Lines end at \\n alone; a null or empty text is one empty line. A key is the line without white space (space, \\t, \\n, \\v, \\f,
    \\r) at both ends, A-Z lower-cased; keys of fewer than `chars` code points stay. A row is a document, whatever its id: rows
    that share an id, rows without one and repeated rows count one by one, and each loses its lines. A key repeated in one text counts once.
    A text that loses every line is empty. An empty table gives none. Other columns are not read.
    """
    often = staged(frequent_lines(docs, documents, chars, id_col, text_col), "frequent-lines")
    hot = often.orderBy(F.desc("n"), "h1", "h2").limit(hot_keys).select("h1", "h2", F.lit(True).alias("hot"))
    rest = often.join(F.broadcast(hot), ["h1", "h2"], "left_anti").select(F.col("h1").alias("j1"), F.col("h2").alias("j2"), F.lit(True).alias("found"))

    rows = _rows(docs, id_col, text_col)
    lines = rows.select("r1", "r2", F.posexplode(line_keys(F.col("text"))).alias("at", "key")).filter(F.length("key") >= chars)
    seen = lines.select("r1", "r2", "at", *_hashes(F.col("key"))).join(F.broadcast(hot), ["h1", "h2"], "left")
    # A hot line is decided; it goes through the join spread by its row, and not in one heap.
    sent = seen.select("r1", "r2", "at", "hot", F.when(F.col("hot"), F.col("r1") + F.col("at")).otherwise(F.col("h1")).alias("j1"), F.when(F.col("hot"), F.col("r2")).otherwise(F.col("h2")).alias("j2"))
    drops = sent.join(rest, ["j1", "j2"], "left").filter("hot OR found").groupBy("r1", "r2").agg(F.collect_set("at").alias("places"))

    joined = rows.join(drops.select("r1", "r2", F.array_sort("places").alias("places")), ["r1", "r2"], "left")
    # A generator over one struct: what it makes is computed once a row, and not again inside the functions below.
    split = F.struct(F.split("text", "\n", -1).alias("lines"), F.coalesce("places", F.array().cast("array<int>")).alias("places"))
    cut = joined.select("doc_id", "text", F.inline(F.array(split)))
    ends = F.concat("places", F.array(F.size("lines")))
    starts = F.concat(F.array(F.lit(0)), F.transform("places", lambda p: p + 1))
    gaps = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    kept = F.array_join(F.flatten(F.transform(gaps, lambda g: F.slice("lines", g["a"] + 1, g["b"] - g["a"]))), "\n")
    return cut.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("places").cast("long").alias("n_dropped"), F.when(F.size("places") == 0, F.col("text")).otherwise(kept).alias("kept_text"))
