"""The registered queries over the driver's tables, thin digests of the operators' results, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import covering_dedup, curriculum, decontaminate, html_text, language_id, license_scan, line_dedup, negative_mining, storage, substring_dedup, surrogates, token_records, transaction_log, weighted_fingerprints


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return storage.spread(storage.small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


#: Of the sources in turn: one that grows in weight, one that stays, one that fades.
SCHEDULES: tuple[curriculum.Schedule, ...] = (((0.0, 1.0), (1.0, 3.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 4.0), (0.5, 1.0), (1.0, 1.0)))


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.fresh_path(spark, "token-records")
    token_records.write_records(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_records.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.plan_mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3, schedules=SCHEDULES)
    return plan.orderBy("position", "doc_id").select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def _inverse_sql(schedule: curriculum.Schedule) -> str:
    """The time x at which a schedule's integral reaches the share f of the whole, piece by piece."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False)]
    cases, used = [], 0.0
    for ((t0, w0), (t1, w1)), area in zip(zip(schedule, schedule[1:], strict=False), areas, strict=True):
        a, need = (w1 - w0) / (t1 - t0) / 2, f"(f * {sum(areas)}::DOUBLE - {used}::DOUBLE)"
        solved = f"{need} / {w0}::DOUBLE" if a == 0 else f"(sqrt(greatest(0, {w0 * w0}::DOUBLE + {4 * a}::DOUBLE * {need})) - {w0}::DOUBLE) / {2 * a}::DOUBLE"
        used += area
        cases.append(f"WHEN f * {sum(areas)}::DOUBLE <= {used}::DOUBLE THEN {t0}::DOUBLE + {solved}")
    return f"CASE {' '.join(cases)} ELSE {schedule[-1][0]}::DOUBLE END"


OP2_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(md5(CAST(doc_id AS VARCHAR)), md5('null:' || coalesce(text, ''))) AS turn
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][CAST(rank % 3 AS INTEGER) + 1] AS DOUBLE) AS weight FROM sources),
levels AS (
  SELECT *, 3 * source_size / weight AS ratio,
         (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY 3 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3 * source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
shared AS (
  SELECT *, (SELECT level FROM levels WHERE level * weight <= 3 * source_size ORDER BY ratio, rank LIMIT 1) AS share FROM levels),
targets AS (
  SELECT source, source_size, rank, CASE WHEN share IS NULL OR share * weight > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE share * weight END AS target
  FROM shared),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rank, CAST(round(t.target) AS BIGINT) AS wanted,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(CASE WHEN source_size = 0 THEN 0 ELSE (wanted // source_size) * size + least(greatest(wanted - (wanted // source_size) * source_size - place, 0), size) END AS BIGINT) AS taken,
         least(place / target, 1) AS f
  FROM placed)
SELECT doc_id, size, source_size, target, taken,
       round(CASE WHEN taken > 0 THEN CASE rank % 3 WHEN 0 THEN {_inverse_sql(SCHEDULES[0])} WHEN 1 THEN {_inverse_sql(SCHEDULES[1])} ELSE {_inverse_sql(SCHEDULES[2])} END END, 9) AS position
FROM counted
"""


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints.compare_with_next(_table(spark, sf_dir, "documents"), part=3)


def op6_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covering_dedup.fingerprint_components(_table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_entities(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=b"key of the registered query")
    # What stays in the shared folder names entities by digests only.
    hidden = F.transform("entities", lambda e: F.struct(e["type"].alias("type"), F.sha2(F.when(e["type"] == "secret", e["entity"]).otherwise(F.lower(e["entity"])), 256).alias("entity"), e["surrogate"].alias("surrogate")))
    done = storage.staged(replaced.withColumn("entities", hidden), "surrogates")
    types = F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["type"])))
    columns = ["doc_id", "text", F.size("entities").cast("long").alias("n_entities"), F.concat_ws(",", types).alias("types")]
    broken = storage.staged(surrogates.collisions(done), "collisions")
    if broken.isEmpty():
        return done.select(*columns, F.lit(0).cast("long").alias("n_collisions"))
    # By construction there are none; were there any, the documents that they are in would say so.
    numbered = storage.staged(done.withColumn("row", F.monotonically_increasing_id()), "surrogate-rows")
    each = numbered.select(F.col("row").alias("of"), F.explode("entities").alias("e")).select("of", F.col("e.type").alias("t"), F.when(F.col("e.type") == "secret", F.col("e.surrogate")).otherwise(F.lower("e.surrogate")).alias("s"))
    met = each.join(broken, (F.col("t") == F.col("type")) & (F.col("s") == F.col("surrogate"))).groupBy("of").agg(F.count("*").alias("n"))
    return numbered.join(met, F.col("row") == F.col("of"), "left").select(*columns, F.coalesce("n", F.lit(0)).cast("long").alias("n_collisions"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    counted = found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))
    return counted


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP8_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '{_ALNUM}'), []::VARCHAR[]) AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '{_ALNUM}') AS w FROM benchmark WHERE text IS NOT NULL),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
windows AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM grams) AS lengths WHERE len(w) >= k)),
hits AS (
  SELECT r, i, windows.k, item_id FROM windows JOIN grams ON windows.k = grams.k AND windows.g = grams.g),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
named AS (
  SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered c USING (r) LEFT JOIN named m USING (r)
"""


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select("doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"), F.concat_ws(",", names).alias("licenses"), F.to_json("matches").alias("matches"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_earlier_passages(_table(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
later AS (
  SELECT r, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, r, i) > 1),
removed AS (
  SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM later),
words AS (
  SELECT r, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM docs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words WHERE NOT EXISTS (SELECT 1 FROM removed WHERE removed.r = words.r AND removed.p = words.p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def op11_transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed, key = F.crc32(F.col("doc_id").cast("string")), F.floor(F.col("h") / 100) % 300
    kind = F.expr("CASE WHEN h % 23 < 2 THEN 'commit' WHEN h % 23 = 2 THEN 'abort' WHEN h % 23 < 5 THEN 'savepoint' WHEN h % 23 < 7 THEN 'rollback' ELSE 'change' END")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text", hashed.alias("h")).withColumn("key", key)
    # A value goes as its digest: whole texts are never shuffled.
    records = docs.select("doc_id", "source", kind.alias("kind"), "key", F.crc32(F.concat_ws(":", F.col("key").cast("string"), F.when(kind == "change", F.col("text")))).alias("digest"), F.col("text").isNull().alias("empty"))
    toxic = _table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct().withColumn("toxic", F.lit(True))
    log = records.join(toxic, "doc_id", "left").withColumn("deleted", F.col("empty") | F.coalesce("toxic", F.lit(False)))
    resolved = transaction_log.resolve(log, "doc_id", "source", "kind", "key", "digest", "deleted")
    states = transaction_log.replay(resolved, per_epoch=4).select(F.lit("state").alias("kind"), F.col("epoch").alias("id"), F.col("n_keys").alias("n"), F.col("total").alias("value"))
    undone = resolved.changes.filter("fate <> 'commit'").select(F.col("fate").alias("kind"), F.col("id"), F.col("by").alias("n"), F.col("key").alias("value"))
    return states.union(undone)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negative_mining.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, least=(80, 100), scale=256)


OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(_table(spark, sf_dir, "documents"), documents=10, chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT r, generate_subscripts(l, 1) AS p, unnest(l) AS line FROM docs),
keyed AS (
  SELECT r, p, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
kept AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS text FROM keyed WHERE NOT EXISTS (SELECT 1 FROM often WHERE often.k = keyed.k) GROUP BY r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_records": op1_token_records,
        "op2_curriculum_mix": op2_curriculum_mix,
        "op3_html_text": op3_html_text,
        "op5_language_id": op5_language_id,
        "op4_weighted_fingerprints": op4_weighted_fingerprints,
        "op6_covering_simhash": op6_covering_simhash,
        "op7_surrogates": op7_surrogates,
        "op8_decontaminate": op8_decontaminate,
        "op9_license_scan": op9_license_scan,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_transaction_log": op11_transaction_log,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_curriculum_mix": OP2_SQL, "op8_decontaminate": OP8_SQL, "op10_substring_dedup": OP10_SQL, "op12_hard_negatives": OP12_SQL, "op13_line_dedup": OP13_SQL}
