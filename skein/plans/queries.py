"""Registered queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import times, urls
from skein.functions.lexicon import DESIGN_MAPPING, LATIN, ONTOLOGY_NAMES, Lexicon
from skein.functions.text import clean_text, with_clean_text
from skein.operators import images, labels, near_duplicates, payloads, reviews
from skein.operators import text_features as X
from skein.plans import curation_queries, image_gate, record_queries
from skein.plans.record_queries import table
from skein.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
L: Lexicon = LATIN
SITE = "https://www.example.org"
#: Vectors have one bit per dimension; within this many bits the synthetic ones have neighbours.
FAR = 16
PHRASES = ("license", "idiot", "%%%")
NOW = "2024-06-15 12:00:00"


# --- SQL pieces -------------------------------------------------------------------------------------------------------


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lst(terms: Sequence[str]) -> str:
    return "[" + ", ".join(q(t) for t in terms) + "]"


WHITE_SQL = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean_sql(c: str) -> str:
    out = f"regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g')"
    out = rf"regexp_replace({out}, '[\x{{1F300}}-\x{{1FAFF}}\x{{2600}}-\x{{27BF}}]+', ' ', 'g')"
    out = rf"regexp_replace({out}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{{fffd}}]', ' ', 'g')"
    out = f"trim(regexp_replace({out}, '{WHITE_SQL}', ' ', 'g'))"
    for mark in "，。！？、；：,.!?;:'\"":
        out = f"regexp_replace({out}, {q('[' + mark + ']{2,}')}, {q(mark)}, 'g')"
    return f"trim({out})"


TEXTS_SQL = f"texts AS (SELECT doc_id, {clean_sql('text')} AS t FROM documents), clean AS (SELECT doc_id, t, regexp_extract_all(t, '[\\x{{4E00}}-\\x{{9FFF}}]+|[A-Za-z0-9]+') AS tokens FROM texts WHERE t <> '')"


def hits_sql(terms: Sequence[str], c: str = "t") -> str:
    return f"list_filter({lst(terms)}, lambda k: contains({c}, k))"


def facet_sql(terms: Sequence[str]) -> str:
    ordered = sorted(terms, key=lambda t: (-len(t), t))
    return hits_sql(ordered)


def signs_sql(long: Sequence[str], single: Sequence[str]) -> str:
    return f"list_sort(list_distinct(list_concat({hits_sql(long)}, list_filter({lst(single)}, lambda k: list_contains(tokens, k)))))"


POS_SQL = signs_sql([w for w in L.positive if len(w) > 1], [w for w in L.positive if len(w) == 1] or ["\x01"])
NEG_SQL = signs_sql((*L.negative, *L.weight_negative), (*L.negative_single, *L.weight_negative_single))
MOOD_SQL = f"""moods AS (SELECT *, {POS_SQL} AS pos, {NEG_SQL} AS neg FROM clean),
scored AS (SELECT *, CASE WHEN len(pos) + len(neg) = 0 THEN 0.0 ELSE CAST(len(pos) - len(neg) AS DOUBLE) / (len(pos) + len(neg)) END AS score FROM moods),
labelled AS (SELECT *, CASE WHEN score > 0.15 THEN 'positive' WHEN score < -0.15 THEN 'negative' ELSE 'neutral' END AS label FROM scored)"""
RULES_SQL = "[" + ", ".join(f"{{'label': {q(label)}, 'words': {lst(words)}}}" for label, words in L.pain_rules) + "]"
PAIN_SQL = f"""matched AS (
  SELECT doc_id, t, r.label AS label, list_filter(r.words, lambda k: contains(t, k) OR contains(lower(t), k)) AS hits
  FROM clean, unnest({RULES_SQL}) AS u(r)),
pains AS (
  SELECT doc_id, label, list_filter(hits, lambda k: length(k) = list_max(list_transform(hits, lambda h: length(h))))[1] AS evidence,
         round(least(0.72::DOUBLE + least(list_max(list_transform(hits, lambda h: length(h))), 6) * 0.03::DOUBLE + (len(hits) - 1) * 0.05::DOUBLE, 0.98::DOUBLE), 2) AS confidence
  FROM matched WHERE len(hits) > 0)"""


# --- text -------------------------------------------------------------------------------------------------------------


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = with_clean_text(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "t").select("doc_id", "t")
    return cleaned.withColumn("tokens", X.regex_tokens(F.col("t")))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select("doc_id", F.col("t").alias("cleaned_text"))


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", clean_text(F.col("html")).alias("cleaned_text"))


def unify_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, talk, pages = (table(spark, sf_dir, n) for n in ("documents", "conversations", "pages"))
    notes = readers.unify_notes(docs.select(F.col("doc_id").cast("string").alias("note_id"), F.col("source").alias("title_text"), F.col("text").alias("raw_text"), F.lit(None).cast("string").alias("publish_time_resolved"), F.col("lang").alias("publish_time_text"), F.lit("0").alias("publish_timestamp")))
    marks = talk.select(F.col("conv_id").cast("string").alias("bvid"), F.col("turn").cast("int").alias("pos"), "text", "role")
    videos = readers.unify_videos(marks.filter("role = 'user'"), marks.filter("role != 'user'"))
    revs = readers.unify_reviews(pages.select(F.col("page_id").cast("string").alias("product_id"), F.lit(0).alias("pos"), F.col("url").alias("content"), F.lit("").alias("creation_time")))
    return notes.unionByName(revs).unionByName(videos)


UNIFY_SQL = r"""
SELECT 'GRP-XHS-' || doc_id AS "Source_ID", 'xiaohongshu' AS "Platform",
       concat_ws(chr(10), nullif(trim(source), ''), CASE WHEN b <> '' AND b <> trim(source) THEN b END) AS "Raw_Text", lang AS "Timestamp", 'note' AS "Data_Type"
FROM (SELECT *, regexp_replace(text, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g') AS b FROM documents)
UNION ALL SELECT 'GRP-TB-' || page_id || '-0001', 'taobao', trim(url), '', 'review' FROM pages WHERE trim(url) <> ''
UNION ALL SELECT 'GRP-BILI-' || CASE WHEN role = 'user' THEN 'DM' ELSE 'CM' END || '-' || conv_id || '-' || lpad(CAST(turn + 1 AS VARCHAR), 6, '0'), 'bilibili', b, '', CASE WHEN role = 'user' THEN 'danmaku' ELSE 'comment' END
FROM (SELECT *, regexp_replace(text, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g') AS b FROM conversations) WHERE b <> ''
"""


def platform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify_records(spark, sf_dir).groupBy("Platform").agg(F.count("*").alias("n"))


def image_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("note_id"), F.col("source").alias("keyword"), *[F.lit("").alias(c) for c in ("note_url", "title_text", "raw_text", "text_source", "publish_timestamp", "publish_time_text", "publish_time_resolved")], F.split("text", "\n").alias("downloaded_image_paths"))
    return readers.image_records(docs, "/data").select("Image_ID", "note_id", "keyword", "relative_image_path", F.length("image_path").alias("path_length"))


IMAGE_SQL = r"""
WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS path, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
named AS (SELECT *, replace(regexp_replace(path, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g'), '\', '/') AS p FROM lines WHERE path <> '')
SELECT 'GRP-XHS-' || doc_id || '-' || CASE WHEN i < 10 THEN '0' || i ELSE CAST(i AS VARCHAR) END AS "Image_ID", CAST(doc_id AS VARCHAR) AS note_id, source AS keyword, p AS relative_image_path,
       CAST(CASE WHEN p = '' THEN NULL WHEN starts_with(p, '/') THEN length(p) ELSE length('/data/' || regexp_replace(p, '^\./', '')) END AS INTEGER) AS path_length
FROM named
"""


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.word_frequency(clean(spark, sf_dir), "tokens", ("doc_id",)).select(F.col("Word").alias("word"), F.col("Frequency").alias("frequency"))


def pain_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.explode_pain_points(clean(spark, sf_dir), "t", L, keep=("doc_id",))
    return rows.select("doc_id", F.col("Pain_Point").alias("pain_point"), F.col("Evidence_Keyword").alias("evidence"), F.col("Confidence").alias("confidence"))


def pain_point_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pain_points(spark, sf_dir).groupBy("pain_point").agg(F.count("*").alias("n"), F.max("confidence").alias("top_confidence"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.feature_columns(clean(spark, sf_dir), L, "t", tokens_col=None)


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", F.col("Sentiment").alias("sentiment"), F.col("Sentiment_Score").alias("score"), F.col("Reason").alias("reason"))


REASON_SQL = "CASE WHEN len(pos) + len(neg) = 0 THEN '未命中正负面词典' ELSE concat_ws('；', CASE WHEN len(pos) > 0 THEN '正面词：' || array_to_string(pos[1:5], ', ') END, CASE WHEN len(neg) > 0 THEN '负面词：' || array_to_string(neg[1:5], ', ') END) END"


def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = scored(spark, sf_dir).groupBy("Sentiment").agg(F.count("*").alias("n"))
    total = one.agg(F.sum("n").alias("total"))
    return one.crossJoin(total).select(F.col("Sentiment").alias("sentiment"), "n", F.round(F.col("n") / F.col("total") * 100, 6).alias("percent"))  # three rows by one


FACETS = {"color": L.color, "material": L.material, "fit": L.fit, "functions": L.function, "scenario": L.scenario}


def term_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean(spark, sf_dir)
    return rows.select("doc_id", *[F.concat_ws(" | ", X.facet(F.col("t"), terms)).alias(name) for name, terms in FACETS.items()])


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", F.concat_ws(" | ", "Keywords").alias("keywords"))


KEYWORDS_SQL = f"array_to_string(list_concat({facet_sql(L.general)}, list_filter(list_concat(list_concat({facet_sql(L.color)}, {facet_sql(L.material)}), list_concat({facet_sql(L.function)}, {facet_sql(L.scenario)})), lambda k: NOT list_contains({facet_sql(L.general)}, k)))[1:12], ' | ')"
_DESIGN = "MAP {" + ", ".join(f"{q(p)}: {q(t)}" for p, t, _ in L.design) + "}"
IMPLIED_SQL = f"""per_doc AS (SELECT doc_id, list(label ORDER BY rule) AS labels FROM (SELECT p.doc_id, p.label, list_position({lst([r for r, _ in L.pain_rules])}, p.label) AS rule FROM pains p) GROUP BY doc_id),
implied AS (
  SELECT m.doc_id, m.t, m.label, m.score, m.pos, m.neg, coalesce(d.labels, []::VARCHAR[]) AS labels, {facet_sql(L.function)} AS functions, {facet_sql(L.scenario)} AS scenarios,
         list_transform(coalesce(d.labels, []::VARCHAR[]), lambda x: {_DESIGN}[x]) AS mapped
  FROM labelled m LEFT JOIN per_doc d USING (doc_id)),
told AS (
  SELECT *, list_concat(list_concat(mapped, CASE WHEN label = 'negative' AND len(mapped) = 0 THEN ['关注用户负面反馈并迭代体验细节'] ELSE []::VARCHAR[] END),
                        list_concat(CASE WHEN label = 'positive' AND len(functions) > 0 THEN ['延续受欢迎功能：' || array_to_string(functions[1:3], '、')] ELSE []::VARCHAR[] END,
                                    CASE WHEN list_contains(scenarios, {q(L.commute_term)}) THEN ['继续强化通勤场景的舒适与外观平衡'] ELSE []::VARCHAR[] END)) AS texts
  FROM implied)"""
TEXTS_OUT_SQL = "CASE WHEN len(texts) = 0 THEN '暂无明显设计启示，建议结合更多样本' ELSE array_to_string(texts, '；') END"


def design_implications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", F.col("Design_Implications").alias("implications"))


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = {"keywords": "Keywords", "pain_points": "Pain_Points", "functions": "Function_Terms", "scenarios": "Scenario_Terms"}
    return scored(spark, sf_dir).select("doc_id", F.col("Sentiment").alias("sentiment"), F.col("Sentiment_Score").alias("score"), *[F.concat_ws(" | ", c).alias(n) for n, c in lists.items()], F.col("Design_Implications").alias("implications"))


def ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.ontology(spark).select("category", F.concat_ws(" | ", "terms").alias("terms"))


def ontology_sql() -> str:
    from skein.functions import lexicon as D

    rows = [(n, sorted(set(t))) for n, t in zip(ONTOLOGY_NAMES, (D.COLOR, D.MATERIAL, D.FIT, D.FUNCTION, D.SCENARIO), strict=False)] + [(ONTOLOGY_NAMES[-1], [r for r, _ in D.PAIN_RULES])]
    return "SELECT * FROM (VALUES " + ", ".join(f"({q(n)}, {q(' | '.join(t))})" for n, t in rows) + ") AS v(category, terms)"


def design_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.design_mapping(spark).toDF("pain_point", "design_implication", "related_elements")


DESIGN_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({q(a)}, {q(b)}, {q(c)})" for a, b, c in DESIGN_MAPPING) + ") AS v(pain_point, design_implication, related_elements)"


# --- images -----------------------------------------------------------------------------------------------------------


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), images.average_hash(F.col("embedding")).alias("hash"))


def average_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed(spark, sf_dir).select(F.col("pos").alias("vec_id"), F.lpad(F.bin("hash"), 64, "0").alias("bits"))


BITS_SQL = "bits AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN CAST(x AS DOUBLE) >= list_aggregate(list_transform(embedding, lambda y: CAST(y AS DOUBLE)), 'avg') THEN '1' ELSE '0' END), '') AS b FROM embeddings)"


def near_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_pairs(hashed(spark, sf_dir), FAR)


def near_duplicate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.gate(hashed(spark, sf_dir), FAR).select(F.col("pos").alias("vec_id"), "accepted", F.coalesce(F.col("duplicate_of"), F.lit(-1)).alias("duplicate_of"))


GATE_SQL = f"""
WITH RECURSIVE {BITS_SQL},
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM bits a JOIN bits b ON a.vec_id < b.vec_id AND hamming(a.b, b.b) <= {FAR}),
touched AS (SELECT row_number() OVER (ORDER BY b) AS step, b AS v, list(a ORDER BY a) AS before FROM links GROUP BY b),
scan(step, duplicates) AS (
  SELECT CAST(0 AS BIGINT), []::BIGINT[]
  UNION ALL
  SELECT t.step, CASE WHEN len(list_filter(t.before, lambda x: NOT list_contains(s.duplicates, x))) > 0 THEN list_append(s.duplicates, t.v) ELSE s.duplicates END
  FROM scan s JOIN touched t ON t.step = s.step + 1),
final AS (SELECT duplicates FROM scan ORDER BY step DESC LIMIT 1)
SELECT b.vec_id, NOT list_contains(f.duplicates, b.vec_id) AS accepted,
       CASE WHEN list_contains(f.duplicates, b.vec_id) THEN list_min(list_filter(t.before, lambda x: NOT list_contains(f.duplicates, x))) ELSE -1 END AS duplicate_of
FROM bits b CROSS JOIN final f LEFT JOIN touched t ON t.v = b.vec_id
"""


def gate_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole image gate over vectors as gray pictures, with sizes and metrics made of their ids."""
    k = F.col("vec_id")
    measured = table(spark, sf_dir, "embeddings").select(
        k.alias("pos"), F.concat(F.lit("i"), k).alias("Image_ID"), F.col("embedding").cast("array<double>").alias("gray8"), (k % 11 != 0).alias("file_exists"), (k % 13 != 0).alias("decodable"), (200 + k % 7 * 100).cast("int").alias("width"), (300 + k % 5 * 300).cast("int").alias("height"),
        (k % 10 / 10).alias("nature"), F.lit(0.1).alias("green"), F.lit(0.1).alias("blue"), F.when(k % 3 == 0, 0.2).otherwise(0.0).alias("foreground"), (k % 2 - 1).cast("int").alias("person_count"), *[F.lit(-1.0).alias(c) for c in images.METRICS[5:]],
    )
    done = image_gate.gate_images(measured, FAR)
    return done.select(F.col("pos").alias("vec_id"), "passed", "image_type", F.split_part(F.coalesce("reject_reason", F.lit("")), F.lit(":"), F.lit(1)).alias("reason"), "duplicate_of", "confidence")


GATE_IMAGES_SQL = f"""
WITH RECURSIVE {BITS_SQL},
m AS (SELECT vec_id, vec_id % 11 <> 0 AS there, vec_id % 13 <> 0 AS opens, 200 + vec_id % 7 * 100 AS w, 300 + vec_id % 5 * 300 AS h, vec_id % 10 / 10 AS nature, vec_id % 3 = 0 AS front, vec_id % 2 = 1 AS empty FROM embeddings),
judged AS (SELECT *, CASE WHEN NOT there THEN 'missing_file' WHEN NOT opens THEN 'corrupted_image' WHEN w < 300 OR h < 300 THEN 'too_small' WHEN CAST(w AS DOUBLE) / h > 3.5 OR CAST(w AS DOUBLE) / h < 0.25 THEN 'bad_aspect_ratio'
  WHEN NOT front AND empty AND nature >= 0.35 THEN 'landscape' ELSE 'candidate_outfit' END AS kind FROM m),
good AS (SELECT vec_id, b FROM bits JOIN judged USING (vec_id) WHERE kind = 'candidate_outfit'),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id < b.vec_id AND hamming(a.b, b.b) <= {FAR}),
touched AS (SELECT row_number() OVER (ORDER BY b) AS step, b AS v, list(a ORDER BY a) AS before FROM links GROUP BY b),
scan(step, duplicates) AS (
  SELECT CAST(0 AS BIGINT), []::BIGINT[]
  UNION ALL
  SELECT t.step, CASE WHEN len(list_filter(t.before, lambda x: NOT list_contains(s.duplicates, x))) > 0 THEN list_append(s.duplicates, t.v) ELSE s.duplicates END
  FROM scan s JOIN touched t ON t.step = s.step + 1),
final AS (SELECT duplicates FROM scan ORDER BY step DESC LIMIT 1),
named AS (SELECT j.*, list_contains(f.duplicates, j.vec_id) AS dup, list_min(list_filter(t.before, lambda x: NOT list_contains(f.duplicates, x))) AS anchor FROM judged j CROSS JOIN final f LEFT JOIN touched t ON t.v = j.vec_id)
SELECT vec_id, kind = 'candidate_outfit' AND NOT dup AS passed, CASE WHEN dup THEN 'duplicate' ELSE kind END AS image_type,
       CASE WHEN dup THEN 'near_duplicate_image' ELSE CASE kind WHEN 'missing_file' THEN 'image_file_not_found' WHEN 'corrupted_image' THEN 'cannot_open_image' WHEN 'too_small' THEN 'image_too_small' WHEN 'bad_aspect_ratio' THEN 'abnormal_aspect_ratio' WHEN 'landscape' THEN 'landscape_no_person_nature_dominant' ELSE '' END END AS reason,
       CASE WHEN dup THEN 'i' || anchor ELSE '' END AS duplicate_of, CASE WHEN kind = 'candidate_outfit' AND NOT dup THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence
FROM named
"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metrics made of lineitem's numbers."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), (F.col("l_quantity") / 50).alias("nature"), (F.col("l_quantity") / 100).alias("green"), (F.col("l_discount") * 8).alias("blue"), F.col("l_tax").alias("foreground"),
        F.pmod(F.col("l_partkey"), F.lit(5)).cast("int").alias("person_count"), (F.col("l_discount") * 1.5).alias("total_person"), F.col("l_discount").alias("max_person"), F.lit(0.5).alias("max_conf"),
        (F.col("l_returnflag") != "A").alias("file_exists"), (F.col("l_linestatus") != "X").alias("decodable"), F.floor(F.col("l_extendedprice") / 20).cast("int").alias("width"), F.floor(F.col("l_quantity") * 40).cast("int").alias("height"),
    )


METRICS_SQL = """m AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity / 50 AS nature, l_quantity / 100 AS green, l_discount * 8 AS blue, l_tax AS foreground, CAST(l_partkey % 5 AS INTEGER) AS persons, l_discount * 1.5::DOUBLE AS total_person, l_discount AS max_person,
  l_returnflag <> 'A' AS there, CAST(floor(l_extendedprice / 20) AS INTEGER) AS width, CAST(floor(l_quantity * 40) AS INTEGER) AS height FROM lineitem),
ruled AS (SELECT *, CASE WHEN max_person >= 0.12::DOUBLE THEN 'not_landscape_person_subject_large_enough' WHEN persons >= 3 OR total_person >= 0.12::DOUBLE THEN 'not_landscape_people_present_as_scene_subject'
  WHEN foreground >= 0.08::DOUBLE THEN 'not_landscape_has_large_foreground_subject' WHEN persons = 0 AND nature >= 0.35::DOUBLE THEN 'landscape_no_person_nature_dominant'
  WHEN persons > 0 AND max_person < 0.055::DOUBLE AND nature >= 0.35::DOUBLE THEN 'landscape_person_too_small_nature_dominant' WHEN nature < 0.82::DOUBLE THEN 'not_landscape_by_color_and_subject'
  WHEN blue >= 0.62::DOUBLE OR green >= 0.62::DOUBLE OR (green >= 0.5 AND blue >= 0.25) THEN 'high_confidence_landscape_by_nature_color' ELSE 'not_landscape_by_color_mix' END AS rule FROM m),
judged AS (SELECT *, CASE WHEN NOT there THEN 'missing_file' WHEN width <= 0 OR height <= 0 THEN 'corrupted_image' WHEN width < 300 OR height < 300 THEN 'too_small' WHEN CAST(width AS DOUBLE) / height > 3.5 OR CAST(width AS DOUBLE) / height < 0.25 THEN 'bad_aspect_ratio'
  WHEN rule LIKE 'landscape%' OR rule LIKE 'high%' THEN 'landscape' ELSE 'candidate_outfit' END AS image_type FROM ruled)"""


def landscape_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics(spark, sf_dir)
    verdict = images.landscape(*[F.col(c) for c in images.METRICS[:-1]])
    return m.select("k", "n", verdict.alias("v")).select("k", "n", "v.is_landscape", "v.rule")


def image_gate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = images.quality(metrics(spark, sf_dir))
    return judged.select("k", "n", "passed", "image_type", F.split_part(F.coalesce("reject_reason", F.lit("")), F.lit(":"), F.lit(1)).alias("reason"), "confidence")


def gate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.quality(metrics(spark, sf_dir)).groupBy("image_type").agg(F.count("*").alias("n"), F.count_if("passed").alias("passed"))


# --- labels and runs --------------------------------------------------------------------------------------------------


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers made of events: some fields of wrong types, some missing."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    field = F.to_json(
        F.struct(
            F.when(k % 3 == 0, "use").when(k % 3 == 1, " reject ").otherwise("maybe").alias("Curation_Status"), F.when(k % 4 == 0, "none").when(k % 4 == 1, "unrelated").alias("Reject_Reason"), F.col("event_type").alias("Image_Category"),
            F.concat(F.lit(" "), (k - 10).cast("string")).alias("Pockets"), F.when(k % 2 == 0, "Yes").otherwise("no").alias("Reflective"), F.when(k % 5 == 0, "Sealed").when(k % 5 == 1, "Open").alias("Zipper_Type"),
            F.when(k % 3 == 0, "").otherwise("red ").alias("Primary_Color"), F.slice(F.array(F.lit(" a"), F.lit(""), F.lit("b"), F.lit("c"), F.lit("d"), F.lit("e")), 1, k % 7 + 1).alias("Material_Clue"),
            (F.col("value") / 50 - 0.5).cast("decimal(10,4)").cast("string").alias("Confidence"),
        )
    )
    return e.select(F.col("event_id").cast("string").alias("Image_ID"), F.lit("n").alias("note_id"), F.lit("p").alias("image_path"), field.alias("raw_model_output"))


def normalize_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = labels.normalize_labels(raw_labels(spark, sf_dir))
    return done.select("Image_ID", "Curation_Status", "Reject_Reason", "Image_Category", "Pockets", "Reflective", "Zipper_Type", "Primary_Color", "Secondary_Color", F.concat_ws("|", "Material_Clue").alias("clues"), "Fit", "Confidence")


LABEL_SQL = """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value, event_type FROM events),
s AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'use' WHEN k % 3 = 1 THEN 'reject' ELSE 'review' END AS status FROM e),
r AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'none' WHEN k % 4 = 1 THEN 'unrelated' WHEN status = 'use' THEN 'none' ELSE 'too_unclear' END AS reason,
             CAST(CAST(value / 50 - 0.5::DOUBLE AS DECIMAL(10,4)) AS DOUBLE) AS conf, list_filter([' a', '', 'b', 'c', 'd', 'e'][1:(k % 7) + 1], lambda x: x <> '') AS clues FROM s)
SELECT CAST(event_id AS VARCHAR) AS "Image_ID", status AS "Curation_Status", CASE WHEN status = 'reject' AND reason = 'none' THEN 'too_unclear' ELSE reason END AS "Reject_Reason",
  'unclear' AS "Image_Category", CAST(greatest(0, k - 10) AS BIGINT) AS "Pockets", k % 2 = 0 AS "Reflective", CASE WHEN k % 5 = 0 THEN 'Sealed' WHEN k % 5 = 1 THEN 'Unclear' ELSE 'None' END AS "Zipper_Type",
  CASE WHEN k % 3 = 0 THEN 'unclear' ELSE 'red' END AS "Primary_Color", 'none' AS "Secondary_Color", array_to_string(list_transform(clues[1:4], lambda x: trim(x)), '|') AS clues, 'Unclear' AS "Fit",
  least(1.0::DOUBLE, greatest(0.0::DOUBLE, conf)) AS "Confidence"
FROM r
"""


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


def resume_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.skipped(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


def runs_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, known = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    runs = docs.select("doc_id", F.when(F.length("text") % 7 == 0, "error").when(F.length("text") % 2 == 0, "annotated").otherwise("skipped").alias("run_status"))
    return labels.curation_log(runs, known, "doc_id", ("quality", "toxic"))


def curation_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.breakdown(runs_with_labels(spark, sf_dir), "quality")


# --- reviews ----------------------------------------------------------------------------------------------------------


def review_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 6 < 5, (F.col("doc_id") % 6).cast("string")).otherwise("x").alias("score"), F.col("text").alias("content"))
    return reviews.low_reviews(docs).select("doc_id", "score")


def brand_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    sold = li.groupBy("l_partkey").agg(F.count("*").alias("c"))  # before the join, so that a row per part travels
    named = sold.join(part.select("p_partkey", reviews.brand(F.col("p_type")).alias("brand")), F.col("l_partkey") == F.col("p_partkey"))
    return named.groupBy("brand").agg(F.sum("c").alias("n"))


def review_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("content", F.coalesce("text", F.lit("")))
    found = reviews.composition(docs, "content", PHRASES, 200)
    return found.select("kind", "n", F.round("percent", 6).alias("percent"), F.round("mean_length", 6).alias("mean_length"), "max_length")


def pain_top_liked(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("text"), F.col("value").alias("like_count"))
    return reviews.top_liked_pain(e, ("event_id",), words=("c", "ew")).select("event_id", "text", "like_count")


# --- payloads ---------------------------------------------------------------------------------------------------------


def first_non_empty_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    return payloads.first_per_key(e, "user_id", ("event_id",), ("kind", "value"))


def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, F.regexp_replace("url", "^https?:", "")).when(F.col("page_id") % 5 == 1, F.regexp_replace("url", "^https?://[^/]*", "")).otherwise(F.col("url")).alias("url"))
    return u.select("page_id", urls.normalize_url(F.col("url"), SITE).alias("url"), urls.infer_extension(F.col("url")).alias("extension"))


URL_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN regexp_replace(url, '^https?:', '') WHEN page_id % 5 = 1 THEN regexp_replace(url, '^https?://[^/]*', '') ELSE url END AS url FROM pages)
SELECT page_id, regexp_replace(CASE WHEN starts_with(url, 'data:image/') THEN '' WHEN starts_with(url, '//') THEN 'https:' || url WHEN starts_with(url, '/') THEN '{SITE}' || url ELSE url END, '\\?.*$', '') AS url,
       CASE WHEN contains(lower(url), '.jpg') THEN '.jpg' WHEN contains(lower(url), '.jpeg') THEN '.jpeg' WHEN contains(lower(url), '.png') THEN '.png' WHEN contains(lower(url), '.webp') THEN '.webp' WHEN contains(lower(url), '.heic') THEN '.heic' WHEN contains(lower(url), '.gif') THEN '.gif' ELSE '.jpg' END AS extension
FROM u
"""


def filename_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.sanitize_filename(F.col("url")).alias("name"))


def said_times(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    e = table(spark, sf_dir, "events")
    n = (F.col("event_id") % 50).cast("string")
    kind = F.col("event_id") % 7
    text = F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd")).when(kind == 1, F.date_format("ts", "MM-dd")).when(kind == 2, F.concat(n, F.lit("天前"))).when(kind == 3, F.concat(n, F.lit("小时前"))).when(kind == 4, F.concat(n, F.lit("分钟前"))).when(kind == 5, "刚刚").otherwise("soon")
    return e.select("event_id", text.alias("said")), F.lit(NOW).cast("timestamp")


def publish_time_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    said, now = said_times(spark, sf_dir)
    dated = said.withColumn("epoch", times.publish_epoch(F.col("said"), now))
    return dated.select("event_id", "said", F.coalesce("epoch", F.lit(-1)).alias("epoch"), times.publish_resolved(F.col("said"), F.col("epoch")).alias("resolved"))


TIME_SQL = f"""
WITH e AS (SELECT event_id, ts, CAST(event_id % 50 AS VARCHAR) AS n, event_id % 7 AS kind FROM events),
s AS (SELECT *, CASE kind WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%m-%d') WHEN 2 THEN n || '天前' WHEN 3 THEN n || '小时前' WHEN 4 THEN n || '分钟前' WHEN 5 THEN '刚刚' ELSE 'soon' END AS said FROM e),
d AS (SELECT *, TIMESTAMP '{NOW}' AS now, CASE WHEN kind = 1 THEN try_strptime('2024-' || said, '%Y-%m-%d') END AS this_year FROM s),
t AS (SELECT *, CASE kind WHEN 0 THEN strptime(said, '%Y-%m-%d') WHEN 1 THEN CASE WHEN this_year > now + INTERVAL 1 DAY THEN try_strptime('2023-' || said, '%Y-%m-%d') ELSE this_year END
  WHEN 2 THEN now - to_days(CAST(n AS INTEGER)) WHEN 3 THEN now - to_hours(CAST(n AS INTEGER)) WHEN 4 THEN now - to_minutes(CAST(n AS INTEGER)) WHEN 5 THEN now END AS moment FROM d)
SELECT event_id, said, coalesce(CAST(epoch(moment) AS BIGINT), -1) AS epoch,
  CASE WHEN kind = 0 OR moment IS NULL THEN said WHEN kind IN (1, 2) THEN strftime(moment, '%Y-%m-%d') WHEN kind = 3 THEN strftime(moment, '%Y-%m-%d %H:00') WHEN kind IN (4, 5) THEN strftime(moment, '%Y-%m-%d %H:%M') ELSE said END AS resolved
FROM t
"""


def deep_json_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.deep_walk(table(spark, sf_dir, "events"), "props", ("event_id",)).select("event_id", "pos", "depth", "kind", F.coalesce(F.col("value").try_cast("long"), F.lit(-1)).alias("number"))


def danmaku_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), "\n"), lambda x: F.concat(F.lit('<d p="0">'), x, F.lit("</d>")))
    xml = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("<i>"), F.concat_ws("", lines), F.lit("</i>")).cast("binary").alias("content"))
    return readers.read_danmaku(xml, "content", ("doc_id",))


_T = f"WITH {TEXTS_SQL}"
_ALL = f"""records AS ({UNIFY_SQL}), texts AS (SELECT "Source_ID" AS doc_id, "Platform" AS platform, {clean_sql('"Raw_Text"')} AS t FROM records),
clean AS (SELECT doc_id, platform, t, regexp_extract_all(t, '[\\x{{4E00}}-\\x{{9FFF}}]+|[A-Za-z0-9]+') AS tokens FROM texts WHERE t <> '')"""
FEATURES_SQL = f"""WITH {_ALL}, {PAIN_SQL}, {MOOD_SQL}, {IMPLIED_SQL}
SELECT doc_id AS "Source_ID", platform AS "Platform", md5(t) AS text_md5, {KEYWORDS_SQL} AS "Keywords", array_to_string(labels, ' | ') AS "Pain_Points", label AS "Sentiment", round(score, 4) AS "Sentiment_Score", {REASON_SQL} AS "Reason", {TEXTS_OUT_SQL} AS "Design_Implications"
FROM told JOIN clean c USING (doc_id, t)"""
_RANKED = "SELECT '{0}' AS section, CAST(row_number() OVER (ORDER BY n DESC, key) AS INTEGER) AS rank, key, n, -1.0::DOUBLE AS percent FROM ({1})"
REPORT_SQL = f"""WITH {_ALL}, {PAIN_SQL}, {MOOD_SQL}
SELECT 'overview' AS section, 1 AS rank, 'input' AS key, (SELECT count(*) FROM records) AS n, -1.0::DOUBLE AS percent
UNION ALL SELECT 'overview', 2, 'processed', (SELECT count(*) FROM clean), -1.0::DOUBLE
UNION ALL {_RANKED.format("platform_input", 'SELECT "Platform" AS key, count(*) AS n FROM records GROUP BY 1')}
UNION ALL {_RANKED.format("platform_processed", 'SELECT platform AS key, count(*) AS n FROM clean GROUP BY 1')}
UNION ALL {_RANKED.format("top_words", "SELECT word AS key, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM clean) GROUP BY 1")} QUALIFY row_number() OVER (ORDER BY n DESC, key) <= 20
UNION ALL {_RANKED.format("pain_points", "SELECT label AS key, count(*) AS n FROM pains GROUP BY 1")}
UNION ALL SELECT 'sentiment', CAST(list_position(['positive', 'neutral', 'negative'], s) AS INTEGER), s, count(*) FILTER (label = s), round(count(*) FILTER (label = s) * 100.0::DOUBLE / count(*), 6) FROM labelled, (VALUES ('positive'), ('neutral'), ('negative')) AS v(s) GROUP BY s"""
ORACLE: dict[str, str] = {
    "clean_documents": f"{_T} SELECT doc_id, t AS cleaned_text FROM clean",
    "clean_pages": f"SELECT page_id, {clean_sql('html')} AS cleaned_text FROM pages",
    "unify_records": UNIFY_SQL,
    "platform_counts": f'SELECT "Platform", count(*) AS n FROM ({UNIFY_SQL}) GROUP BY 1',
    "image_index": IMAGE_SQL,
    "word_frequency": f"{_T} SELECT word, count(*) AS frequency FROM (SELECT unnest(tokens) AS word FROM clean) GROUP BY 1",
    "pain_points": f"{_T}, {PAIN_SQL} SELECT doc_id, label AS pain_point, evidence, confidence FROM pains",
    "pain_point_counts": f"{_T}, {PAIN_SQL} SELECT label AS pain_point, count(*) AS n, max(confidence) AS top_confidence FROM pains GROUP BY 1",
    "sentiment": f"{_T}, {MOOD_SQL} SELECT doc_id, label AS sentiment, round(score, 4) AS score, {REASON_SQL} AS reason FROM labelled",
    "sentiment_distribution": f"{_T}, {MOOD_SQL} SELECT label AS sentiment, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM labelled) * 100, 6) AS percent FROM labelled GROUP BY 1",
    "term_facets": f"{_T} SELECT doc_id, " + ", ".join(f"array_to_string({facet_sql(t)}, ' | ') AS {n}" for n, t in FACETS.items()) + " FROM clean",
    "keywords": f"{_T} SELECT doc_id, {KEYWORDS_SQL} AS keywords FROM clean",
    "design_implications": f"{_T}, {PAIN_SQL}, {MOOD_SQL}, {IMPLIED_SQL} SELECT doc_id, {TEXTS_OUT_SQL} AS implications FROM told",
    "feature_vectors": f"{_T}, {PAIN_SQL}, {MOOD_SQL}, {IMPLIED_SQL} SELECT doc_id, label AS sentiment, round(score, 4) AS score, {KEYWORDS_SQL} AS keywords, array_to_string(labels, ' | ') AS pain_points, array_to_string(functions, ' | ') AS functions, array_to_string(scenarios, ' | ') AS scenarios, {TEXTS_OUT_SQL} AS implications FROM told",
    "ontology": ontology_sql(),
    "design_mapping": DESIGN_SQL,
    "average_hash": f"WITH {BITS_SQL} SELECT vec_id, b AS bits FROM bits",
    "near_duplicate_pairs": f"WITH {BITS_SQL} SELECT a.vec_id AS a, b.vec_id AS b, CAST(hamming(a.b, b.b) AS INTEGER) AS distance FROM bits a JOIN bits b ON a.vec_id < b.vec_id AND hamming(a.b, b.b) <= {FAR}",
    "near_duplicate_gate": GATE_SQL,
    "gate_images": GATE_IMAGES_SQL,
    "landscape_rules": f"WITH {METRICS_SQL} SELECT k, n, rule LIKE 'landscape%' OR rule LIKE 'high%' AS is_landscape, rule FROM ruled",
    "image_gate_rules": f"WITH {METRICS_SQL} SELECT k, n, image_type = 'candidate_outfit' AS passed, image_type, CASE image_type WHEN 'missing_file' THEN 'image_file_not_found' WHEN 'corrupted_image' THEN 'invalid_image_size' WHEN 'too_small' THEN 'image_too_small' WHEN 'bad_aspect_ratio' THEN 'abnormal_aspect_ratio' WHEN 'landscape' THEN rule ELSE '' END AS reason, CASE WHEN image_type = 'candidate_outfit' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM judged",
    "gate_log": f"WITH {METRICS_SQL} SELECT image_type, count(*) AS n, count(*) FILTER (image_type = 'candidate_outfit') AS passed FROM judged GROUP BY 1",
    "normalize_labels": LABEL_SQL,
    "resume_pending": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "resume_skipped": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "curation_log": "SELECT d.doc_id, CASE WHEN length(text) % 7 = 0 THEN 'error' WHEN length(text) % 2 = 0 THEN 'annotated' ELSE 'skipped' END AS run_status, coalesce(CAST(quality AS VARCHAR), '') AS quality, coalesce(CAST(toxic AS VARCHAR), '') AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "curation_breakdown": "SELECT coalesce(CAST(quality AS VARCHAR), 'unknown') AS value, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1",
    "review_filter": "SELECT doc_id, CAST(CASE WHEN doc_id % 6 < 5 THEN doc_id % 6 ELSE 0 END AS INTEGER) AS score FROM documents WHERE trim(text) <> '' AND (doc_id % 6 IN (0, 1, 2, 5))",
    "brand_counts": "SELECT split_part(p_type, ' ', 1) AS brand, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
    "review_composition": rf"WITH c AS (SELECT coalesce(text, '') AS content, length(regexp_replace(coalesce(text, ''), '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g')) AS n FROM documents), k AS (SELECT n, CASE WHEN contains(content, 'license') OR contains(content, 'idiot') OR contains(content, '%%%') THEN 'default' WHEN n < 200 THEN 'noise' ELSE 'genuine' END AS kind FROM c) SELECT kind, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM k) * 100, 6) AS percent, round(avg(n), 6) AS mean_length, CAST(max(n) AS INTEGER) AS max_length FROM k GROUP BY 1",
    "pain_top_liked": "SELECT event_id, event_type AS text, value AS like_count FROM events WHERE contains(event_type, 'c') OR contains(event_type, 'ew') ORDER BY value DESC, event_id LIMIT 50",
    "first_non_empty_merge": "WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS kind, CASE WHEN event_id % 4 <> 0 THEN value END AS value FROM events) SELECT user_id, min(event_id) AS event_id, coalesce(arg_min(kind, event_id) FILTER (kind <> ''), '') AS kind, arg_min(value, event_id) FILTER (value IS NOT NULL) AS value FROM e GROUP BY 1",
    "url_normalize": URL_SQL,
    "filename_sanitize": r"""SELECT page_id, coalesce(nullif(substring(trim(regexp_replace(url, '[\\/:*?"<>|]+', '_', 'g')), 1, 80), ''), 'untitled') AS name FROM pages""",
    "publish_time_resolve": TIME_SQL,
    "danmaku_xml": r"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos, regexp_replace(line, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g') AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE line <> ''",
    "deep_json_walk": "SELECT event_id, CAST(0 AS INTEGER) AS pos, CAST(0 AS INTEGER) AS depth, 'object' AS kind, CAST(-1 AS BIGINT) AS number FROM events UNION ALL SELECT event_id, 1, 1, 'number', CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events",
}


def queries() -> dict[str, Query]:
    found = (
        clean_documents, clean_pages, unify_records, platform_counts, image_index, word_frequency, pain_points, pain_point_counts, sentiment, sentiment_distribution, term_facets, keywords, design_implications, feature_vectors, ontology, design_mapping,
        average_hash, near_duplicate_pairs, near_duplicate_gate, gate_images, landscape_rules, image_gate_rules, gate_log, normalize_labels, resume_pending, resume_skipped, curation_breakdown, review_filter, brand_counts, review_composition, pain_top_liked,
        first_non_empty_merge, url_normalize, filename_sanitize, publish_time_resolve, deep_json_walk, danmaku_xml,
    )
    return {f.__name__: f for f in found} | {"curation_log": runs_with_labels} | record_queries.queries() | curation_queries.queries()


def oracle_sql() -> dict[str, str]:
    return ORACLE | record_queries.ORACLE | curation_queries.oracle_sql() | {"analysis_features": FEATURES_SQL, "analysis_report": REPORT_SQL}
