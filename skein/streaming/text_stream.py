"""The text operators on a stream of unified records: features row by row, word counts as running totals, batches to files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.functions.lexicon import DEFAULT, Lexicon
from skein.operators import text_features as X
from skein.plans.text_analysis import cleaned_records


def features(records: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Feature columns of a batch or a stream; stateless."""
    texts = cleaned_records(records)
    return X.feature_columns(texts.withColumn("Tokens", X.regex_tokens(F.col("Cleaned_Text"))), lexicon, tokens_col=None)


def windowed_words(records: DataFrame, time_col: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Word counts by event-time window; rows later than the watermark are not counted."""
    words = cleaned_records(records).withWatermark(time_col, late).select(F.window(time_col, window).alias("window"), F.explode(X.regex_tokens(F.col("Cleaned_Text"))).alias("Word"))
    return words.groupBy("window", "Word").agg(F.count("*").alias("Frequency"))


def start(records: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, lexicon: Lexicon = DEFAULT) -> StreamingQuery:
    """Feeds feature rows to sink(frame, batch id), once for what is there. A batch id that comes again after a failure has the same rows."""
    rows = X.feature_rows(features(records, lexicon))
    return rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
