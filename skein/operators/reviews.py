"""Product reviews and video comments: filters, counts and the composition by usefulness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.lexicon import DEFAULT_REVIEWS, VIDEO_PAIN
from skein.functions.text import contains_any, strip

SHORT = 10


def parse_score(c: Column, strict: bool = False) -> Column:
    """A whole number; what is none counts as 0, or is an error if strict."""
    text = strip(c.cast("string"))
    return F.coalesce(text.cast("int") if strict else text.try_cast("int"), F.lit(0))


def low_reviews(reviews: DataFrame, score_col: str = "score", content_col: str = "content", strict: bool = False) -> DataFrame:
    """Reviews of 1 or 2 points with a text. Those without a score, which counts as 0, stay."""
    scored = reviews.withColumn(score_col, parse_score(F.col(score_col), strict))
    return scored.filter((F.coalesce(strip(F.col(content_col)), F.lit("")) != "") & F.col(score_col).isin(0, 1, 2))


def brand(query: Column) -> Column:
    """The first word."""
    return F.element_at(F.split(strip(query), r"\s+"), 1)


def brand_counts(reviews: DataFrame, query_col: str = "query") -> DataFrame:
    return reviews.groupBy(brand(F.col(query_col)).alias("brand")).agg(F.count("*").alias("n"))


def review_kind(content: Column, phrases: Sequence[str] = DEFAULT_REVIEWS, short: int = SHORT) -> Column:
    """default: a platform's standard phrase; else noise under `short` characters, else genuine."""
    return F.when(contains_any(content, phrases), "default").when(F.length(strip(content)) < short, "noise").otherwise("genuine")


def composition(reviews: DataFrame, content_col: str = "content", phrases: Sequence[str] = DEFAULT_REVIEWS, short: int = SHORT) -> DataFrame:
    """Per kind: n, share of all in percent, mean and greatest stripped length. The total comes from the grouped counts."""
    c = F.col(content_col)
    grouped = reviews.groupBy(review_kind(c, phrases, short).alias("kind")).agg(F.count("*").alias("n"), F.avg(F.length(strip(c))).alias("mean_length"), F.max(F.length(strip(c))).alias("max_length"))
    total = grouped.agg(F.sum("n").alias("total"))
    return grouped.crossJoin(total).select("kind", "n", (F.col("n") / F.col("total") * 100).alias("percent"), "mean_length", "max_length")  # three rows by one


def flag_pain(rows: DataFrame, text_col: str = "text", words: Sequence[str] = VIDEO_PAIN) -> DataFrame:
    return rows.withColumn("is_pain_point", contains_any(F.coalesce(F.col(text_col), F.lit("")), words))


def top_liked_pain(comments: DataFrame, order: Sequence[str], like_col: str = "like_count", n: int = 50, text_col: str = "text", words: Sequence[str] = VIDEO_PAIN) -> DataFrame:
    """The n most liked comments that name a pain point; equals keep the given order."""
    return flag_pain(comments, text_col, words).filter("is_pain_point").orderBy(F.desc(like_col), *order).limit(n)


def video_summary(danmaku: DataFrame, comments: DataFrame) -> DataFrame:
    """One row with the totals of both tables and of their pain points."""
    one = danmaku.agg(F.count("*").alias("total_danmaku"), F.count_if("is_pain_point").alias("pain_point_danmaku"))
    return one.crossJoin(comments.agg(F.count("*").alias("total_comments"), F.count_if("is_pain_point").alias("pain_point_comments")))  # one row by one row
