"""Registered queries of annotation runs, gate totals, many terms, segmenters and large files, with their SQL."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import segment
from skein.functions.terms import find_terms
from skein.functions.text import with_clean_text
from skein.operators import images, labels, pages, payloads
from skein.operators import text_features as X
from skein.functions.lexicon import LATIN
from skein.plans.record_queries import table
from skein.sources import json_arrays
from skein.sources.stage import fresh_path

# --- runs -------------------------------------------------------------------------------------------------------------


def _client() -> Callable[[str], str]:
    """A stand-in for a model: a fixed answer for each path, an error for some, and text that is no object for others."""

    def ask(path: str) -> str:
        k = int(path.rpartition("/")[2])
        if k % 13 == 0:
            raise RuntimeError("down")
        return "[]" if k % 17 == 0 else json.dumps({"Curation_Status": ("use", "reject", "review")[k % 3], "Image_Category": "landscape", "Confidence": (k % 100) / 100})

    return ask


def annotation_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: documents as images, of which some have labels and others no file; every other one is asked for once."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("Image_ID"), F.col("source").alias("note_id"), F.concat(F.lit("/img/"), "doc_id").alias("image_path"))
    known = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").cast("string").alias("Image_ID"))
    run = labels.run_annotator(docs, known, docs.filter("CAST(Image_ID AS BIGINT) % 11 <> 0"), _client)
    said = labels.curation_log(run["runs"], run["labels"])
    errors = run["errors"].select(F.col("Image_ID").alias("_id"), "error_type")
    return said.join(errors, F.col("Image_ID") == F.col("_id"), "left").select("Image_ID", "run_status", F.coalesce("error_type", F.lit("")).alias("error_type"), F.col("Curation_Status").alias("status"), F.col("Image_Category").alias("category"), F.col("Reject_Reason").alias("reason"), F.col("Confidence").alias("confidence"))


ANNOTATION_RUN_SQL = """
WITH k AS (SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'skipped_existing' WHEN doc_id % 11 = 0 THEN 'missing_file' WHEN doc_id % 13 = 0 OR doc_id % 17 = 0 THEN 'error' ELSE 'annotated' END AS s FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS "Image_ID", s AS run_status, CASE s WHEN 'missing_file' THEN s WHEN 'error' THEN CASE WHEN doc_id % 13 = 0 THEN 'RuntimeError' ELSE 'ValueError' END ELSE '' END AS error_type,
  CASE WHEN s = 'annotated' THEN ['use', 'reject', 'review'][doc_id % 3 + 1] ELSE '' END AS status, CASE WHEN s = 'annotated' THEN 'landscape' ELSE '' END AS category,
  CASE WHEN s <> 'annotated' THEN '' WHEN doc_id % 3 = 0 THEN 'none' ELSE 'too_unclear' END AS reason, CASE WHEN s = 'annotated' THEN CAST((doc_id % 100) / 100.0::DOUBLE AS VARCHAR) ELSE '' END AS confidence
FROM k
"""


def gate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's log itself: totals, counts by image type, and by reject reason, in full and up to its colon."""
    from skein.plans.queries import metrics

    log = images.gate_log(images.quality(metrics(spark, sf_dir)))
    said = [F.concat_ws(",", F.transform(F.map_entries(n), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias(n) for n in ("image_type_breakdown", "rejection_kinds")]
    full = F.aggregate(F.map_values("rejection_breakdown"), F.lit(0).cast("long"), lambda a, b: a + b).alias("rejected_with_reason")
    return log.select("total_images", "passed", "rejected", *said, full)


def gate_totals_sql() -> str:
    from skein.plans.queries import METRICS_SQL

    kind = "CASE image_type WHEN 'missing_file' THEN 'image_file_not_found' WHEN 'corrupted_image' THEN 'invalid_image_size' WHEN 'too_small' THEN 'image_too_small' WHEN 'bad_aspect_ratio' THEN 'abnormal_aspect_ratio' ELSE rule END"
    counted = "(SELECT coalesce(string_agg(v || '=' || n, ',' ORDER BY v), '') FROM (SELECT {v} AS v, count(*) AS n FROM judged {w} GROUP BY 1))"
    rejected = "WHERE image_type <> 'candidate_outfit'"
    return f"""WITH {METRICS_SQL}
SELECT count(*) AS total_images, count(*) FILTER (image_type = 'candidate_outfit') AS passed, count(*) FILTER (image_type <> 'candidate_outfit') AS rejected,
  {counted.format(v='image_type', w='')} AS image_type_breakdown, {counted.format(v=kind, w=rejected)} AS rejection_kinds, count(*) FILTER (image_type <> 'candidate_outfit') AS rejected_with_reason
FROM judged"""


# --- words ------------------------------------------------------------------------------------------------------------


def benchmark_terms(spark: SparkSession, sf_dir: str) -> list[str]:
    """A lexicon of many terms: the words of seven letters or more in the benchmark's texts."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{7,}"), 0)).alias("w")).distinct()
    return sorted(r.w for r in words.collect())


def term_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of many terms each document has, in its text or in lower case."""
    found = find_terms(table(spark, sf_dir, "documents").select("doc_id", "text"), {"terms": benchmark_terms(spark, sf_dir)}, "text", lower=True)
    return found.select("doc_id", F.size("terms").cast("long").alias("n_terms"), F.md5(F.concat_ws(",", "terms")).alias("terms_md5"))


TERMS_SQL = """
WITH terms AS (SELECT list(w ORDER BY w) AS ts FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{7,}')) AS w FROM benchmark)),
found AS (SELECT doc_id, list_filter(ts, lambda t: contains(coalesce(text, ''), t) OR contains(lower(coalesce(text, '')), t)) AS f FROM documents, terms)
SELECT doc_id, CAST(len(f) AS BIGINT) AS n_terms, md5(array_to_string(f, ',')) AS terms_md5 FROM found
"""


def cut_word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of texts cut by a dictionary with a model for words outside it."""
    cleaned = with_clean_text(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "t").select("doc_id", "t")
    hidden = segment.HiddenWords.of_counts({"B": 1, "S": 1}, {"BE": 1, "BM": 1, "EB": 1, "SS": 1}, {})
    tokens = X.cut_tokens(cleaned, "t", "tokens", segment.DictionaryCutter.of_lexicon(LATIN, hidden=hidden))
    return X.word_frequency(tokens, "tokens", ("doc_id",)).select(F.col("Word").alias("word"), F.col("Frequency").alias("frequency"))


def cut_word_frequency_sql() -> str:
    from skein.plans.queries import clean_sql

    return f"""WITH clean AS (SELECT {clean_sql('text')} AS t FROM documents)
SELECT word, count(*) AS frequency FROM (SELECT unnest(regexp_extract_all(t, '[A-Za-z0-9]+(?:[.%_+#&-][A-Za-z0-9]+)*')) AS word FROM clean) GROUP BY 1"""


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty most frequent words of a report."""
    from skein.plans.queries import clean

    return X.top_words(clean(spark, sf_dir), 20, "tokens", ("doc_id",)).select(F.col("Word").alias("word"), F.col("Frequency").alias("frequency"))


def top_words_sql() -> str:
    from skein.plans.queries import clean_sql

    return f"""WITH clean AS (SELECT doc_id, {clean_sql('text')} AS t FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[\u4E00-\u9FFF]+|[A-Za-z0-9]+') AS ws FROM clean))
SELECT word, count(*) AS frequency FROM words GROUP BY 1 ORDER BY frequency DESC, min((doc_id, i)) LIMIT 20"""


def hidden_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the words of the documents say about places of letters in words: the counts that the hidden model is fitted on."""
    tokens = table(spark, sf_dir, "documents").select(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[a-z]+|[^\sa-z]+"), 0).alias("Tokens"))
    return segment.hidden_counts(tokens, letters="[a-z]+")


HIDDEN_SQL = r"""
WITH texts AS (SELECT regexp_extract_all(lower(coalesce(text, '')), '[a-z]+|[^\sa-z]+') AS ts FROM documents),
shaped AS (SELECT ts, list_transform(ts, lambda w: CASE WHEN NOT regexp_full_match(w, '[a-z]+') THEN '|' WHEN length(w) = 1 THEN 'S' ELSE 'B' || repeat('M', length(w) - 2) || 'E' END) AS ss FROM texts),
words AS (SELECT unnest(ts) AS w, unnest(ss) AS s FROM shaped),
spelt AS (SELECT w, s, unnest(range(1, length(w) + 1)) AS i FROM words WHERE s <> '|'),
joined AS (SELECT '|' || array_to_string(ss, '') AS s FROM shaped),
pairs AS (SELECT substring(s, i, 2) AS p FROM (SELECT s, unnest(range(1, length(s))) AS i FROM joined))
SELECT 'emit' AS kind, substring(s, i, 1) || substring(w, i, 1) AS key, count(*) AS n FROM spelt GROUP BY 1, 2
UNION ALL SELECT CASE WHEN p LIKE '|%' THEN 'start' ELSE 'move' END, ltrim(p, '|'), count(*) FROM pairs WHERE p NOT LIKE '%|' GROUP BY 1, 2
"""

# --- payloads and files -----------------------------------------------------------------------------------------------


def video_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    payload = F.when(F.col("doc_id") % 5 == 0, "no json").when(F.col("doc_id") % 3 == 0, '{"data": {"aid": 0}}').otherwise(F.concat(F.lit('{"data": {"aid": '), "doc_id", F.lit(', "pages": [{"cid": '), F.col("doc_id") * 10, F.lit('}, {"cid": 1}]}}')))
    return pages.video_ids(docs.select(F.col("doc_id").alias("bvid"), payload.alias("payload")))


VIDEO_PARTS_SQL = "SELECT doc_id AS bvid, doc_id AS aid, doc_id * 10 AS cid FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 3 <> 0 AND doc_id <> 0"


def script_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON in a script's text, behind an assignment and before a semicolon."""
    script = F.when(F.col("doc_id") % 4 == 0, F.lit("no state")).otherwise(F.concat(F.lit("window.state =\n{\"id\": "), "doc_id", F.lit(", \"list\": [1]};")))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(payloads.script_json(script), F.lit("-")).alias("state"))


SCRIPT_SQL = """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '-' ELSE '{"id": ' || doc_id || ', "list": [1]}' END AS state FROM documents"""


def keyword_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each language as the results of one keyword."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    parts = [(lang, docs.filter(F.col("lang") == lang).drop("lang") if lang != "de" else docs.filter("lang = 'de'").select("doc_id")) for lang in ("en", "fr", "de")]
    return pages.union_keywords(parts).select("keyword", F.col("kw_ord").cast("int").alias("kw_ord"), "doc_id", F.coalesce(F.col("n_chars"), F.lit(-1)).cast("long").alias("n_chars"))


KEYWORD_SQL = "SELECT lang AS keyword, CAST(CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS INTEGER) AS kw_ord, doc_id, CASE WHEN lang = 'de' THEN -1 ELSE n_chars END AS n_chars FROM documents WHERE lang IN ('en', 'fr', 'de')"


def json_array_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of one JSON array each, written and read back by ranges of bytes."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            for row in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [f"{mark} {row}"]})
                mark = ","
        yield pa.RecordBatch.from_pydict({"value": ["]" if mark == "," else "[]"]})

    path = fresh_path(spark, "note-arrays")
    docs = table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("note_id"), F.col("text").alias("raw_text"))).alias("j"))
    docs.mapInArrow(arrays, "value string").write.text(path)
    notes = json_arrays.array_elements(spark, path).select(F.from_json("value", "note_id string, raw_text string").alias("n"))
    return notes.select("n.note_id", F.md5("n.raw_text").alias("text_md5"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (annotation_run, gate_totals, term_matches, cut_word_frequency, top_words, hidden_word_counts, video_parts, script_states, keyword_union, json_array_notes)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "annotation_run": ANNOTATION_RUN_SQL,
        "gate_totals": gate_totals_sql(),
        "term_matches": TERMS_SQL,
        "cut_word_frequency": cut_word_frequency_sql(),
        "top_words": top_words_sql(),
        "hidden_word_counts": HIDDEN_SQL,
        "video_parts": VIDEO_PARTS_SQL,
        "script_states": SCRIPT_SQL,
        "keyword_union": KEYWORD_SQL,
        "json_array_notes": "SELECT CAST(doc_id AS VARCHAR) AS note_id, md5(text) AS text_md5 FROM documents",
    }
