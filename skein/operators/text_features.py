"""Lexicon operators over cleaned text: pain points, sentiment, facets, keywords and design implications, as columns."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import lexicon as L
from skein.functions.lexicon import DEFAULT, Lexicon
from skein.functions.terms import find_terms
from skein.functions.text import by_length, joined, matched

#: Facet terms from which on one automaton looks for all of them, in place of a test a term.
MANY_TERMS = 500
#: Bytes of text that are cut before their tokens are handed on.
CUT_BYTES = 1 << 20
#: A run of characters of one of these classes, Chinese ones or ASCII letters and digits, is a token.
RUNS = (r"[\x{4E00}-\x{9FFF}]", "[A-Za-z0-9]")
TOKEN = "|".join(f"{r}+" for r in RUNS)


def regex_tokens(c: Column) -> Column:
    """Tokens without a dictionary."""
    return F.regexp_extract_all(c, F.lit(TOKEN), 0)


def is_regex_token(c: Column, word: str) -> Column:
    """Whether the word is among the regex_tokens of the text, which is not cut: the word stands somewhere without a neighbour of its own class."""
    run = next((r for r, whole in zip(RUNS, (r"[\u4e00-\u9fff]+", "[A-Za-z0-9]+"), strict=True) if re.fullmatch(whole, word)), None)
    if run is None:
        return F.lit(False)
    return F.contains(c, F.lit(word)) & c.rlike(f"{word}(?!{run})(?<!{run}{word})")


def _pieces(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most CUT_BYTES of text, or of one row: the tokens of a text take many times its size."""
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(size, size[start] + CUT_BYTES, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def cut_tokens(docs: DataFrame, text_col: str, out: str, cut: Callable[[str], Sequence[str]]) -> DataFrame:
    """docs with tokens from a segmenter that the caller gives, such as a dictionary cutter; blanks and lone marks are left out."""
    kept = [c for c in docs.columns if c != out]
    at = kept.index(text_col)

    def lone_mark(word: str) -> bool:
        return len(word) == 1 and not ("一" <= word <= "鿿" or word.isascii() and word.isalnum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in _pieces(whole, at)):
            tokens = [[w for t in cut(x or "") if (w := t.strip()) and not lone_mark(w)] for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.list_(pa.string()))], [*kept, out])

    read = docs.select(*kept)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields)
    return read.mapInArrow(run, f"{ddl}, `{out}` array<string>")


def confidence(hits: Column) -> Column:
    """0.72, 0.03 for each character of the longest hit up to 6, 0.05 for each further hit, at most 0.98."""
    longest = F.array_max(F.transform(hits, lambda k: F.length(k)))
    return F.round(F.least(F.lit(0.72) + F.least(longest, F.lit(6)) * F.lit(0.03) + (F.size(hits) - 1) * F.lit(0.05), F.lit(0.98)), 2)


def pain_points(c: Column, lexicon: Lexicon = DEFAULT) -> Column:
    """array<struct<Pain_Point, Evidence_Keyword, Confidence>> of the rules that match, in rule order. The evidence is the first of the longest keywords."""
    both = F.array(F.struct(c.alias("c"), F.lower(c).alias("low")))  # lower case is made once for all rules

    def rules(text: Column) -> Column:
        return F.array(*[F.struct(F.lit(label).alias("label"), matched(text["c"], words, text["low"]).alias("hits")) for label, words in lexicon.pain_rules])

    def evidence(hits: Column) -> Column:
        longest = F.array_max(F.transform(hits, lambda k: F.length(k)))
        return F.filter(hits, lambda k: F.length(k) == longest)[0]

    return F.transform(F.filter(F.transform(both, rules)[0], lambda r: F.size(r["hits"]) > 0), lambda r: F.struct(r["label"].alias("Pain_Point"), evidence(r["hits"]).alias("Evidence_Keyword"), confidence(r["hits"]).alias("Confidence")))


def explode_pain_points(texts: DataFrame, text_col: str = "Cleaned_Text", lexicon: Lexicon = DEFAULT, keep: Sequence[str] = ("Source_ID", "Platform", "Cleaned_Text")) -> DataFrame:
    """A row for each matched rule of each text."""
    return texts.select(*keep, F.inline(pain_points(F.col(text_col), lexicon)))


def _singles(c: Column, tokens: Column | None, words: Sequence[str]) -> Column:
    if not words:
        return F.array().cast("array<string>")
    if tokens is None:
        return F.array_compact(F.array(*[F.when(is_regex_token(c, w), F.lit(w)) for w in words]))
    # A variable holds the tokens, which would be cut anew for each word.
    return F.transform(F.array(tokens), lambda ts: F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.array_contains(ts, w)))[0]


def positive_hits(c: Column, tokens: Column | None, lexicon: Lexicon = DEFAULT) -> Column:
    """Sorted distinct positive words: of one character as a token only, longer ones anywhere. Without tokens those of regex_tokens count, and no text is cut."""
    long = [w for w in lexicon.positive if len(w) > 1]
    return F.array_sort(F.array_distinct(F.concat(matched(c, long), _singles(c, tokens, [w for w in lexicon.positive if len(w) == 1]))))


def negative_hits(c: Column, tokens: Column | None, lexicon: Lexicon = DEFAULT) -> Column:
    """Sorted distinct negative phrases anywhere, and single words as tokens; without tokens as above."""
    return F.array_sort(F.array_distinct(F.concat(matched(c, (*lexicon.negative, *lexicon.weight_negative)), _singles(c, tokens, (*lexicon.negative_single, *lexicon.weight_negative_single)))))


def sentiment(c: Column, tokens: Column | None, lexicon: Lexicon = DEFAULT) -> Column:
    """struct<Sentiment, Sentiment_Score, Reason>. Negation is not looked at: a word inside its own negation counts."""
    return sentiment_of_hits(positive_hits(c, tokens, lexicon), negative_hits(c, tokens, lexicon))


def sentiment_of_hits(pos: Column, neg: Column) -> Column:
    p, n = F.size(pos), F.size(neg)
    score = F.when(p + n > 0, (p - n) / (p + n)).otherwise(F.lit(0.0))
    label = F.when(score > 0.15, "positive").when(score < -0.15, "negative").otherwise("neutral")
    parts = F.concat_ws("；", F.when(p > 0, F.concat(F.lit(L.POSITIVE_REASON), F.concat_ws(", ", F.slice(pos, 1, 5)))), F.when(n > 0, F.concat(F.lit(L.NEGATIVE_REASON), F.concat_ws(", ", F.slice(neg, 1, 5)))))
    return F.struct(label.alias("Sentiment"), F.round(score, 4).alias("Sentiment_Score"), F.when(p + n > 0, parts).otherwise(F.lit(L.NO_HITS_REASON)).alias("Reason"))


def facet(c: Column, terms: Sequence[str]) -> Column:
    """Terms found in the text, longest first. Case counts."""
    return by_length(matched(c, terms))


def keywords(general: Column, *domains: Column) -> Column:
    """Up to 12 terms: the general ones, then those of the domains that are not among them."""
    return F.slice(F.concat(general, F.filter(F.concat(*domains), lambda t: ~F.array_contains(general, t))), 1, 12)


def implications(pains: Column, label: Column, functions: Column, scenarios: Column, lexicon: Lexicon = DEFAULT) -> Column:
    """Design implications of a text, distinct in order of appearance, or a fixed text if there are none."""
    lookup = F.create_map(*[F.lit(x) for pain, text, _ in lexicon.design for x in (pain, text)])
    mapped = F.filter(F.transform(pains, lambda p: F.try_element_at(lookup, p)), lambda t: t.isNotNull())
    none = F.array().cast("array<string>")
    more = F.concat(
        F.when((label == "negative") & (F.size(mapped) == 0), F.array(F.lit(L.NEGATIVE_IMPLICATION))).otherwise(none),
        F.when((label == "positive") & (F.size(functions) > 0), F.array(F.concat(F.lit(L.FUNCTION_IMPLICATION), F.concat_ws("、", F.slice(functions, 1, 3))))).otherwise(none),
        F.when(F.array_contains(scenarios, lexicon.commute_term), F.array(F.lit(L.COMMUTE_IMPLICATION))).otherwise(none),
    )
    found = F.array_distinct(F.concat(mapped, more))
    return F.when(F.size(found) > 0, F.concat_ws("；", found)).otherwise(F.lit(L.NO_IMPLICATION))


def feature_columns(texts: DataFrame, lexicon: Lexicon = DEFAULT, text_col: str = "Cleaned_Text", tokens_col: str | None = "Tokens") -> DataFrame:
    """texts with one column for each operator's result, arrays kept as arrays. Three projections, as later ones build on earlier ones.

    tokens_col None stands for the regex_tokens of the text, which then need not be cut.
    """
    c, tokens = F.col(text_col), F.col(tokens_col) if tokens_col else None
    names = {"Color_Terms": lexicon.color, "Material_Terms": lexicon.material, "Fit_Terms": lexicon.fit, "Function_Terms": lexicon.function, "Scenario_Terms": lexicon.scenario, "General_Terms": lexicon.general}
    if sum(map(len, names.values())) > MANY_TERMS:
        found = find_terms(texts, names, text_col).withColumns({k: by_length(F.col(k)) for k in names})
    else:
        found = texts.withColumns({k: facet(c, v) for k, v in names.items()})
    hits = found.withColumns({"pain": pain_points(c, lexicon), "pos": positive_hits(c, tokens, lexicon), "neg": negative_hits(c, tokens, lexicon)})
    scored = hits.withColumn("mood", sentiment_of_hits(F.col("pos"), F.col("neg"))).withColumn("Pain_Points", F.transform("pain", lambda p: p["Pain_Point"]))
    return scored.withColumns(
        {
            "Sentiment": F.col("mood.Sentiment"), "Sentiment_Score": F.col("mood.Sentiment_Score"), "Reason": F.col("mood.Reason"),
            "Keywords": keywords(F.col("General_Terms"), F.col("Color_Terms"), F.col("Material_Terms"), F.col("Function_Terms"), F.col("Scenario_Terms")),
            "Design_Implications": implications(F.col("Pain_Points"), F.col("mood.Sentiment"), F.col("Function_Terms"), F.col("Scenario_Terms"), lexicon),
        }
    ).drop("pos", "neg", "mood")


def feature_rows(features: DataFrame) -> DataFrame:
    """The feature table as it is written: arrays joined by ' | '."""
    lists = ("Keywords", "Pain_Points", "Color_Terms", "Material_Terms", "Fit_Terms", "Function_Terms", "Scenario_Terms")
    order = ("Source_ID", "Platform", "Cleaned_Text", "Keywords", "Pain_Points", "Sentiment", "Sentiment_Score", "Reason", "Color_Terms", "Material_Terms", "Fit_Terms", "Function_Terms", "Scenario_Terms", "Design_Implications")
    return features.select(*[joined(F.col(c)).alias(c) if c in lists else F.col(c) for c in order])


def _first_at(order: Sequence[str]) -> Column:
    """The place of a word: its text's, and `pos` in it."""
    return F.struct(*[F.col(c) for c in order], F.col("pos"))


def _counted(each: DataFrame, order: Sequence[str]) -> DataFrame:
    """Word, Frequency and first_at, the first place of each word. each: the columns of order, pos, Word."""
    if len(order) > 1 or each.schema[order[0]].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return each.groupBy("Word").agg(F.count("*").alias("Frequency"), F.min(_first_at(order)).alias("first_at"))
    # One number for text and place: minima of numbers are hashed where those of structs would be sorted. Where both fit into a long, no decimal is made for a word.
    n, pos, bits = F.col(order[0]).cast("long"), F.col("pos").cast("long"), 20

    def wide(n: Column, pos: Column) -> Column:
        return F.coalesce(n.cast("decimal(19,0)"), F.lit(-(1 << 63)).cast("decimal(19,0)")) * F.lit(1 << 31).cast("decimal(10,0)") + pos

    fits = n.isNotNull() & (n >= 0) & (n < 1 << (63 - bits)) & (pos < 1 << bits)
    low, high = F.min(F.when(fits, F.shiftleft(n, bits) + pos)).alias("low"), F.min(F.when(~fits, wide(n, pos))).alias("high")
    found = each.groupBy("Word").agg(F.count("*").alias("Frequency"), low, high)
    packed = wide(F.shiftright("low", bits), F.col("low").bitwiseAND((1 << bits) - 1))
    return found.select("Word", "Frequency", F.least(F.when(F.col("low").isNotNull(), packed), "high").alias("first_at"))


def word_frequency(texts: DataFrame, tokens_col: str = "Tokens", order: Sequence[str] = ("Source_ID",)) -> DataFrame:
    """Word and Frequency, most frequent first; among equals the word that appears first in the given order of texts."""
    # The outer form spares a filter that would build the tokens once more.
    each = texts.select(*order, F.posexplode_outer(tokens_col).alias("pos", "Word")).filter("Word IS NOT NULL")
    return _counted(each, order).orderBy(F.desc("Frequency"), "first_at").drop("first_at")


def top_words(texts: DataFrame, k: int = 20, tokens_col: str = "Tokens", order: Sequence[str] = ("Source_ID",), tracked: int | None = None, most_tracked: int = 1_000_000) -> DataFrame:
    """The first k rows of word_frequency, exactly. All words are counted, in one pass over the texts, unless `tracked` is given.

    Then the vocabulary is not shuffled, at the cost of a second pass: a sketch of frequent items, merged from all tasks, names candidates; a second pass counts only these, a broadcast of at most 50 k words. That no other word
    belongs to the result follows from the sketch's bound: a word it doesn't name has at most the least named estimate, or twice the sketch's error
    of 3.5 / map size of all words. Where the k-th count doesn't exceed that, as when many words are about as frequent, the sketch is
    taken anew, eight times as large, and beyond most_tracked all words are counted.
    """
    if tracked is None:
        return word_frequency(texts, tokens_col, order).limit(k)
    names = max(50 * k, 100)
    words = texts.select(F.explode(tokens_col).alias("Word")).filter("Word IS NOT NULL")
    tracked = max(tracked, names)
    while tracked <= most_tracked:
        sketch = words.agg(F.expr(f"approx_top_k(Word, {names}, {tracked})").alias("top"), F.count("*").alias("n")).first()
        error = math.ceil(3.5 * sketch.n / (1 << (math.ceil(tracked / 0.75) - 1).bit_length()))
        bound = max(2 * error if sketch.n > tracked // 2 else 0, min((t["count"] for t in sketch.top), default=0) if len(sketch.top) == names else 0)
        named = texts.sparkSession.createDataFrame([(t["item"],) for t in sketch.top], "Word string")
        each = texts.select(*order, F.posexplode_outer(tokens_col).alias("pos", "Word")).join(F.broadcast(named), "Word")
        found = _counted(each, order).orderBy(F.desc("Frequency"), "first_at").limit(k)
        rows = found.select("Word", "Frequency").collect()
        if bound == 0 or len(rows) == k and rows[-1].Frequency > bound:
            return texts.sparkSession.createDataFrame(rows, "Word string, Frequency long")
        tracked *= 8
    return word_frequency(texts, tokens_col, order).limit(k)


def ontology(spark, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Category and its sorted terms; the pain points in rule order."""
    lists = (lexicon.color, lexicon.material, lexicon.fit, lexicon.function, lexicon.scenario)
    rows = [(n, sorted(set(t))) for n, t in zip(L.ONTOLOGY_NAMES, lists, strict=False)] + [(L.ONTOLOGY_NAMES[-1], [label for label, _ in lexicon.pain_rules])]
    return spark.createDataFrame(rows, "category string, terms array<string>")


def design_mapping(spark, lexicon: Lexicon = DEFAULT) -> DataFrame:
    return spark.createDataFrame(list(lexicon.design), "Pain_Point string, Design_Implication string, Related_Elements string")
