"""From unified text records to every table of the text analysis, and its report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.lexicon import DEFAULT, Lexicon
from skein.functions.text import joined, with_clean_text
from skein.operators import text_features as X
from skein.sources import sinks
from skein.sources.readers import unified_records
from skein.sources.stage import staged

SENTIMENTS = ("positive", "neutral", "negative")


def platform_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("Platform").agg(F.count("*").alias("n"))


def cleaned_records(records: DataFrame) -> DataFrame:
    """Records with Cleaned_Text, those without any left out."""
    return with_clean_text(records, "Raw_Text", "Cleaned_Text")


@dataclass
class TextAnalysis:
    """The tables of one analysis. `features` is written once to the shared folder, and all others are read from it."""

    records: DataFrame
    features: DataFrame
    lexicon: Lexicon

    @classmethod
    def of(cls, records: DataFrame, lexicon: Lexicon = DEFAULT, cut: Callable[[str], Sequence[str]] | None = None) -> "TextAnalysis":
        """`cut` segments a text, such as a dictionary cutter; without it tokens are runs of Chinese characters or of letters and digits."""
        texts = cleaned_records(records.withColumn("rec_ord", F.monotonically_increasing_id()))
        tokens = X.cut_tokens(texts, "Cleaned_Text", "Tokens", cut) if cut else texts.withColumn("Tokens", X.regex_tokens(F.col("Cleaned_Text")))
        return cls(records, staged(X.feature_columns(tokens, lexicon), "features"), lexicon)

    @property
    def cleaned(self) -> DataFrame:
        return self.features.select(*sinks.CLEANED)

    @property
    def tokenized(self) -> DataFrame:
        return self.features.select("Source_ID", "Platform", "Cleaned_Text", joined(F.col("Tokens")).alias("Tokens"))

    @property
    def word_frequency(self) -> DataFrame:
        return X.word_frequency(self.features, order=("rec_ord",))

    @property
    def feature_vectors(self) -> DataFrame:
        return X.feature_rows(self.features)

    @property
    def pain_points(self) -> DataFrame:
        return self.features.select("Source_ID", "Platform", "Cleaned_Text", F.inline("pain"))

    @property
    def sentiment_labels(self) -> DataFrame:
        return self.features.select(*sinks.SENTIMENT)

    def report(self) -> DataFrame:
        """(section, rank, key, value, percent): the figures of the report, a few dozen rows. Ranks follow counts, then keys."""

        def ranked(section: str, rows: DataFrame, key: str, n: str, top: int | None = None) -> DataFrame:
            some = rows.select(F.col(key).alias("key"), F.col(n).cast("double").alias("value"))
            best = some.orderBy(F.desc("value"), "key").limit(top) if top else some
            listed = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("o"), "key", "value"))).alias("l"))
            return listed.select(F.lit(section).alias("section"), F.posexplode("l").alias("at", "x")).select("section", (F.col("at") + 1).alias("rank"), "x.key", "x.value", F.lit(None).cast("double").alias("percent"))

        counts = self.features.agg(F.count("*").alias("processed")).crossJoin(self.records.agg(F.count("*").alias("input")))  # one row by one row
        overview = counts.select(F.inline(F.array(*[F.struct(F.lit("overview").alias("section"), F.lit(i).alias("rank"), F.lit(k).alias("key"), F.col(k).cast("double").alias("value"), F.lit(None).cast("double").alias("percent")) for i, k in enumerate(("input", "processed"), 1)])))
        moods = self.features.agg(*[F.count_if(F.col("Sentiment") == s).alias(s) for s in SENTIMENTS], F.count("*").alias("all"))
        mood_rows = moods.select(F.inline(F.array(*[F.struct(F.lit("sentiment").alias("section"), F.lit(i).alias("rank"), F.lit(s).alias("key"), F.col(s).cast("double").alias("value"), (F.col(s) / F.greatest(F.col("all"), F.lit(1)) * 100).alias("percent")) for i, s in enumerate(SENTIMENTS, 1)])))
        pains = self.features.select(F.explode("Pain_Points").alias("p")).groupBy("p").agg(F.count("*").alias("n"))
        words = self.word_frequency.withColumnRenamed("Frequency", "n")
        out = overview.unionByName(ranked("platform_input", platform_counts(self.records), "Platform", "n")).unionByName(ranked("platform_processed", platform_counts(self.features), "Platform", "n"))
        return out.unionByName(ranked("top_words", words, "Word", "n", 20)).unionByName(ranked("pain_points", pains, "p", "n")).unionByName(mood_rows)

    def write(self, path: str) -> dict[str, int]:
        """All tables as CSV directories, ontology and report as files. Returns the counts of the run."""
        spark = self.features.sparkSession
        tables: Mapping[str, DataFrame] = {
            "cleaned_text": self.cleaned, "tokenized_text": self.tokenized, "word_frequency": self.word_frequency, "feature_vectors": self.feature_vectors,
            "pain_point_table": self.pain_points, "sentiment_labels": self.sentiment_labels, "painpoint_design_mapping": X.design_mapping(spark, self.lexicon),
        }
        for name, table in tables.items():
            sinks.write_csv(table, f"{path}/{name}")
        sinks.write_json_row(X.ontology(spark, self.lexicon).agg(F.map_from_entries(F.collect_list(F.struct("category", "terms"))).alias("ontology")), f"{path}/micro_ontology.json")
        rows = self.report().collect()
        sinks.put(spark, f"{path}/text_analysis_report.md", render_report(rows, list(tables)).encode())
        got = {(r.section, r.key): int(r.value) for r in rows}
        return {"input_records": got[("overview", "input")], "processed_records": got[("overview", "processed")], **{s: got[("sentiment", s)] for s in SENTIMENTS}, "pain_points": sum(n for (section, _), n in got.items() if section == "pain_points")}


def render_report(rows: Sequence, files: Sequence[str]) -> str:
    """Markdown of the report's rows."""
    titles = {"overview": "数据概览", "platform_input": "输入阶段", "platform_processed": "有效分析阶段", "top_words": "Top 20 高频词", "pain_points": "各痛点数量", "sentiment": "情感分布"}
    lines = ["# 文本分析报告"]
    for section, title in titles.items():
        lines += ["", f"## {title}", ""]
        own = sorted((r for r in rows if r.section == section), key=lambda r: r.rank)
        lines += [f"- {r.key}: {int(r.value)}" + (f" ({r.percent:.1f}%)" if r.percent is not None else "") for r in own] or ["- （无）"]
    return "\n".join([*lines, "", "## 输出文件列表", "", *[f"- `{f}`" for f in files]]) + "\n"


def run(spark: SparkSession, sources: Mapping[str, str], out: str | None = None, lexicon: Lexicon = DEFAULT, cut: Callable[[str], Sequence[str]] | None = None) -> TextAnalysis:
    """Reads the sources that exist, analyses them, and writes the tables if `out` is given."""
    analysis = TextAnalysis.of(unified_records(spark, sources), lexicon, cut)
    if out:
        analysis.write(out)
    return analysis
