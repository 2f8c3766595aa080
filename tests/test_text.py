"""Cleaning, coalescing, lexicon operators and the text analysis."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.functions import lexicon as L
from skein.functions import segment
from skein.functions import terms as T
from skein.functions.segment import FOLLOW, STATES, DictionaryCutter, HiddenWords, fit_hidden_words
from skein.functions.text import clean_text, first_nonblank, first_present, first_truthy, safe_text, strip
from skein.operators import text_features as X
from skein.plans import queries, text_analysis
from skein.sources.readers import exists
from skein.sources.stage import clear_staged, spread, staged
from skein.streaming import text_stream


def one(spark, column, *values, names=("c",)):
    types = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([values], types).select(column.alias("x")).first().x


CLEANED = [
    ("a <b>b</b> c", "a b c"), ("好看！！！", "好看！"), ("what!?", "what!?"), ("a....b", "a.b"), ("x　  y", "x y"), ("\U0001f600hi☀", "hi"), ("a\x00�b", "a b"), ("  \t ", ""), (None, ""), ("", ""),
    ("ab‍️​c", "ab‍️​c"), ("''\"\"", "'\""), ("a\x1cb", "a b"),
]


@pytest.mark.parametrize("text,want", CLEANED)
def test_clean(spark, text, want):
    assert one(spark, clean_text(F.col("c")), text) == want
    assert one(spark, clean_text(F.col("c")), want) == want


def test_strip_knows_all_white_space(spark):
    assert one(spark, strip(F.col("c")), "　\t a b \x1c\n") == "a b"
    assert one(spark, safe_text(F.col("c")), None) == ""


def test_three_coalescing_flavours(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, first_truthy(a, b), "", "x", names="ab") == "x" and one(spark, first_truthy(a, b), "0", "x", names="ab") == "x"
    assert one(spark, first_present(a, b), "", "x", names="ab") == "" and one(spark, first_present(a, b), None, " x ", names="ab") == "x"
    assert one(spark, first_nonblank(a, b), " ", "x", names="ab") == "x" and one(spark, first_nonblank(a, b), None, None, names="ab") == ""


def pains(spark, text):
    return [tuple(p) for p in one(spark, X.pain_points(F.col("c")), text)]


def test_pain_points(spark):
    assert pains(spark, "好贵") == [("价格高", "好贵", 0.78)]
    assert pains(spark, "不透气") == [("不透气", "不透气", 0.81)]
    assert pains(spark, "穿不出去") == [("不适合通勤", "穿不出去", 0.84)]
    assert pains(spark, "不适合通勤") == [("不适合通勤", "不适合通勤", 0.87)]
    assert pains(spark, "一点也不闷热") == [("不透气", "闷热", 0.78)]
    assert pains(spark, "又闷热又不透风，拉链坏") == [("不透气", "不透风", 0.86), ("拉链问题", "拉链坏", 0.81)]
    assert pains(spark, "") == []


def mood(spark, text):
    df = spark.createDataFrame([(text,)], "c string").withColumn("t", X.regex_tokens(F.col("c")))
    return tuple(df.select(X.sentiment(F.col("c"), F.col("t")).alias("s")).select("s.*").first())


def test_sentiment_has_no_negation(spark):
    assert mood(spark, "不透气")[:2] == ("neutral", 0.0)
    assert mood(spark, "不适合通勤")[:2] == ("positive", 1.0)
    assert mood(spark, "太重了") == ("negative", -1.0, "负面词：太重, 太重了")
    assert mood(spark, "沉思") == ("neutral", 0.0, L.NO_HITS_REASON)
    assert mood(spark, "很沉 笨重")[1] == -1.0
    assert mood(spark, "贵") == ("negative", -1.0, "负面词：贵")


def test_facets_keywords_and_implications(spark):
    df = spark.createDataFrame([("防水透气的 GORE-TEX 冲锋衣，通勤好看，军绿色",)], "Cleaned_Text string").withColumn("Tokens", X.regex_tokens(F.col("Cleaned_Text")))
    r = X.feature_columns(df).first()
    assert r.Color_Terms == ["军绿"] and r.Material_Terms == ["防水"] and r.Function_Terms == ["透气", "防水"] and r.Scenario_Terms == ["通勤"]
    assert r.Keywords == ["冲锋衣", "军绿", "防水", "透气", "防水", "通勤"]
    assert r.Sentiment == "positive" and r.Design_Implications == "延续受欢迎功能：透气、防水；继续强化通勤场景的舒适与外观平衡"
    none = X.feature_columns(spark.createDataFrame([("垃圾", ["垃圾"]), ("嗯", ["嗯"])], "Cleaned_Text string, Tokens array<string>")).orderBy("Cleaned_Text").collect()
    assert {r.Design_Implications for r in none} == {L.NO_IMPLICATION, L.NEGATIVE_IMPLICATION}


def test_lexicons_have_their_sizes():
    assert [len(x) for x in (L.COLOR, L.MATERIAL, L.FIT, L.FUNCTION, L.SCENARIO, L.GENERAL, L.POSITIVE, L.WEIGHT_NEGATIVE, L.NEGATIVE_SINGLE, L.VIDEO_PAIN, L.DESIGN_MAPPING)] == [19, 18, 13, 16, 15, 15, 29, 13, 9, 18, 8]
    assert sum(len(w) for _, w in L.PAIN_RULES) == 45


def test_word_frequency_keeps_first_among_equals(spark):
    df = spark.createDataFrame([(2, ["b", "a"]), (1, ["c", "a"])], "Source_ID long, Tokens array<string>")
    assert [tuple(r) for r in X.word_frequency(df).collect()] == [("a", 2), ("c", 1), ("b", 1)]


def test_a_given_segmenter_cuts(spark):
    df = spark.createDataFrame([("ab，c 好", 1)], "text string, k int")
    assert X.cut_tokens(df, "text", "t", lambda s: list(s)).first().t == ["a", "b", "c", "好"]


def test_the_dictionary_cutter_takes_the_likeliest_words(spark):
    cut = DictionaryCutter({"冲锋": 5, "冲锋衣": 50, "衣": 20, "不透气": 30, "透气": 30, "很": 90, "太重": 5})
    assert cut("冲锋衣很不透气") == ["冲锋衣", "很", "不透气"] and cut("衣冲锋") == ["衣", "冲锋"] and cut("未知字") == ["未", "知", "字"]
    assert cut("GORE-TEX 3.0，好") == ["GORE-TEX", " ", "3.0", "，", "好"] and cut("") == []

    def cost(words):
        return sum(cut._costs.get(w, cut._unknown) for w in words)

    def cuts(run):
        return [[run[:k], *rest] for k in range(1, len(run) + 1) if k == 1 or run[:k] in cut.counts for rest in (cuts(run[k:]) if run[k:] else [[]])]

    for run in ("冲锋衣不透气", "透气衣冲锋不透气很", "不透不透气"):
        assert cost(cut(run)) == pytest.approx(min(map(cost, cuts(run))))
    own = DictionaryCutter.of_lexicon(more=["阿尔法贝塔"])
    assert own("阿尔法贝塔好") == ["阿尔法贝塔", "好"] and "闷热" in own("一点也不闷热")
    df = spark.createDataFrame([("冲锋衣，很不透气", 1)], "text string, k int")
    assert X.cut_tokens(df, "text", "t", cut).first().t == ["冲锋衣", "很", "不透气"]


def test_cleaning_stands_once_in_plans(spark, sf):
    """Filters and generators above the cleaned text must not copy its expression."""
    for name in ("clean_documents", "word_frequency", "pain_points", "sentiment", "feature_vectors", "term_facets"):
        plan = queries.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == 3 and plan.count("regexp_extract_all(") <= 1, name


def test_staged_tables_are_cleared(spark):
    clear_staged(spark)
    path = staged(spark.range(3).toDF("x"), "a").inputFiles()[0]
    assert exists(spark, path) and clear_staged(spark) == 1 and not exists(spark, path) and clear_staged(spark) == 0


def test_small_tables_are_spread(spark, sf):
    small = spark.read.parquet(f"{sf}/documents.parquet")
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(small).count() == small.count()
    assert "Repartition" not in spread(spark.range(10**9))._jdf.queryExecution().optimizedPlan().toString()


RECORDS = [("1", "p", "不透气！！", "", "review"), ("2", "p", "<br>", "", "review"), ("3", "q", "好看 好看", "t", "note"), ("4", "q", None, "", "note")]


def test_analysis(spark, tmp_path):
    records = spark.createDataFrame(RECORDS, "Source_ID string, Platform string, Raw_Text string, Timestamp string, Data_Type string")
    done = text_analysis.TextAnalysis.of(records)
    assert {r.Source_ID: r.Cleaned_Text for r in done.cleaned.collect()} == {"1": "不透气！", "3": "好看 好看"}
    assert done.word_frequency.first() == ("好看", 2) and done.pain_points.count() == 1
    got = {(r.section, r.key): (r.value, r.percent) for r in done.report().collect()}
    assert got[("overview", "input")][0] == 4 and got[("overview", "processed")][0] == 2 and got[("sentiment", "positive")] == (1, 50.0) and got[("platform_input", "q")][0] == 2
    counts = done.write(f"file://{tmp_path}/out")
    assert counts == {"input_records": 4, "processed_records": 2, "positive": 1, "neutral": 1, "negative": 0, "pain_points": 1}
    assert "好看: 2" in (tmp_path / "out/text_analysis_report.md").read_text() and (tmp_path / "out/micro_ontology.json").exists()
    back = spark.read.option("header", True).csv(f"{tmp_path}/out/feature_vectors")
    assert back.columns[0] == "Source_ID" and back.count() == 2


def test_stream_equals_batch(spark, tmp_path):
    schema = "Source_ID string, Platform string, Raw_Text string, Timestamp string, Data_Type string"
    records = spark.createDataFrame(RECORDS, schema)
    records.write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).json(f"{tmp_path}/in")
    seen = []
    text_stream.start(stream, lambda df, n: seen.extend(df.collect()), f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted(seen) == sorted(X.feature_rows(text_stream.features(records)).collect())


def test_automaton_equals_a_test_a_term():
    draw = random.Random(1)
    for _ in range(60):
        letters = draw.choice(["ab", "aé中", "abcdefgh"])
        terms = list({"".join(draw.choice(letters) for _ in range(draw.randrange(6))) for _ in range(draw.randrange(1, 30))})
        texts = [None if draw.random() < 0.1 else "".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 5, 50, 1500]))) for _ in range(draw.randrange(12))]
        rows, found = T.Automaton(terms).rows_and_terms(*T._bytes(pa.array(texts, pa.string())))
        assert list(zip(rows.tolist(), found.tolist(), strict=True)) == [(i, k) for i, x in enumerate(texts) for k, t in enumerate(terms) if t in (x or "")]


def test_many_terms_equal_few(spark, monkeypatch):
    """Automata, several of a small size too, find what the plan finds, in every list's order; odd rows and clashing names."""
    texts = ["Wind PROOF jacket", "防风 jacket, 防水", "İstanbul", None, "", "windproof" * 300, "a"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "id int, t string, low string, `odd name` int")
    lists = {"low": ["proof", "jacket", "wind", "防风", "水", "jacket"], "odd name": ["PROOF", "a", "", "i̇s"], "none": []}
    for lower in (False, True):
        want = sorted(map(str, T.find_terms(df, lists, "t", lower=lower, few=99).select("id", "t", *[f"`{c}`" for c in lists]).collect()))
        for most in (1 << 24, 40):
            monkeypatch.setattr(T, "MOST_TRANSITIONS", most)
            assert sorted(map(str, T.find_terms(df, lists, "t", lower=lower, few=0).select("id", "t", *[f"`{c}`" for c in lists]).collect())) == want
    assert T.find_terms(df.limit(0), lists, "t", few=0).count() == 0


def test_features_of_a_large_lexicon(spark, monkeypatch):
    df = spark.createDataFrame([(1, "黑色冲锋衣很好看，通勤防水"), (2, "too heavy"), (3, "")], "Source_ID int, Cleaned_Text string").withColumn("Tokens", X.regex_tokens(F.col("Cleaned_Text")))
    want = X.feature_rows(X.feature_columns(df.withColumn("Platform", F.lit("p")))).orderBy("Source_ID").collect()
    monkeypatch.setattr(X, "MANY_TERMS", 0)
    assert X.feature_rows(X.feature_columns(df.withColumn("Platform", F.lit("p")))).orderBy("Source_ID").collect() == want and want[0].Color_Terms


def test_hidden_words_equal_exhaustive_search():
    """A thousand short runs: the states that are found cost no more than the cheapest of all."""
    draw = random.Random(2)
    for _ in range(1000):
        emit = {s + c: draw.randrange(20) for s in STATES for c in "甲乙丙"}
        model = HiddenWords.of_counts({s: draw.randrange(9) for s in "BS"}, {a + b: draw.randrange(9) for a in STATES for b in FOLLOW[a]}, emit, draw.choice([0.1, 1, 2]))
        run = "".join(draw.choice("甲乙丙丁") for _ in range(draw.randrange(1, 7)))
        words = model.cut(run)
        states = "".join("S" if len(w) == 1 else "B" + "M" * (len(w) - 2) + "E" for w in words)
        assert "".join(words) == run and model.cost(run, states) <= min(model.cost(run, "".join(x)) for x in itertools.product(STATES, repeat=len(run))) + 1e-9
    assert model.cut("") == []


def test_words_outside_the_list(spark):
    """A model fitted on a cut table finds its kind of words where the dictionary has none, and leaves listed words alone."""
    table = spark.createDataFrame([(["冲锋", "衣", "，", "很", "好看", None, ""],), (["保暖", "透气", "abc", "防风"],), (["轻便", "好看"],), (None,), ([],)], "Tokens array<string>")
    model = fit_hidden_words(table, smooth=0.01)
    assert model.start["B"] < model.start["S"] and model.emit["B冲"] < model.unseen["B"] and "B," not in model.emit and "Ba" not in model.emit
    plain, hidden = DictionaryCutter({"天气": 5, "好": 9}), DictionaryCutter({"天气": 5, "好": 9}, hidden=model)
    assert plain("今天气好轻便防风 abc-1") == ["今", "天气", "好", "轻", "便", "防", "风", " ", "abc-1"]
    assert hidden("天气轻便防风 abc-1") == ["天气", "轻便", "防风", " ", "abc-1"]
    assert "".join(hidden("任何字都留下，一个不少。")) == "任何字都留下，一个不少。"
    cut = X.cut_tokens(spark.createDataFrame([("轻便防风",)], "t string"), "t", "Tokens", hidden).first().Tokens
    assert cut == ["轻便", "防风"]


@pytest.mark.parametrize(("kind", "tracked"), [("skewed", 1024), ("level", 1024), ("few", 65_536)])
def test_top_words_equal_the_full_count(spark, kind, tracked):
    """With a clear top, with words that are all about as frequent, so that no sketch is enough, and with few words."""
    draw = random.Random(3)
    word = {"skewed": lambda: int(draw.random() ** 4 * 3000), "level": lambda: draw.randrange(3000), "few": lambda: draw.randrange(7)}[kind]
    texts = spark.createDataFrame([(i, [f"w{word()}" for _ in range(50)] if i % 9 else None) for i in range(400)], "Source_ID int, Tokens array<string>").repartition(3)
    want = [tuple(r) for r in X.word_frequency(texts).limit(10).collect()]
    assert [tuple(r) for r in X.top_words(texts, 10, tracked=tracked, most_tracked=10_000).collect()] == want
    assert X.top_words(texts.limit(0), 10).count() == 0


def test_places_in_words_are_counted_without_a_row_a_letter(spark):
    """The counts equal a plain reading, in pieces of any size, and the plan makes no row for a letter or a pair."""
    texts = [["冲锋", "衣", None, "", "x", "不透气"], None, [], ["。"], ["透气", "冲锋衣服"], ["𠀀", "衣"]] * 3
    want: dict = {}
    for words in texts:
        last = "|"
        for w in [w for w in words or [] if w]:
            states = "|" if not all("一" <= c <= "鿿" for c in w) else "S" if len(w) == 1 else "B" + "M" * (len(w) - 2) + "E"
            for s, c in zip(states, w, strict=False):
                for key in ([("emit", s + c)] if s != "|" else []) + ([("start" if last == "|" else "move", last.strip("|") + s)] if s != "|" else []):
                    want[key] = want.get(key, 0) + 1
                last = s
    df = spark.createDataFrame([(t,) for t in texts], "Tokens array<string>").repartition(2)
    counts = segment.hidden_counts(df)
    assert {(r.kind, r.key): r.n for r in counts.collect()} == want
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    lists = pa.array([t for t in texts if t])
    whole = segment._place_counts(lists.flatten(), lists.flatten().is_valid().to_numpy(zero_copy_only=False).cumsum() * 0, "[a-z]+")
    assert whole.to_pylist() == [{"kind": "emit", "key": "Sx", "n": 3}, {"kind": "start", "key": "S", "n": 3}]


def test_tokens_are_cut_once_for_all_single_words(spark, sf):
    for name in ("sentiment", "feature_vectors"):
        assert "array_contains(regexp_extract_all(" not in queries.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString(), name


def test_marks_are_replaced_only_where_one_is_doubled(spark, sf):
    plan = queries.clean_documents(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan and ", !!)" in plan
    assert [one(spark, clean_text(F.col("c")), x) for x in ("。。a", "a!!  ''", "!?", "\x85　a b\x7f", "é\n\nß")] == ["。a", "a! '", "!?", "a b\x7f", "é ß"]


def test_places_of_words_with_ids_of_any_size(spark):
    rows = [(None, ["n"]), (-(1 << 62), ["a"]), (5, ["b", "c"]), ((1 << 43) - 1, ["d"]), (1 << 43, ["e"]), ((1 << 63) - 1, ["f", "b"])]
    got = X.word_frequency(spark.createDataFrame(rows[::-1], "Source_ID long, Tokens array<string>"))
    assert [r.Word for r in got.collect()] == ["b", "n", "a", "c", "d", "e", "f"]
    assert "CASE WHEN" in got._jdf.queryExecution().optimizedPlan().toString()


def test_top_words_take_one_pass(spark):
    texts = spark.createDataFrame([(1, ["a", "b", "a"])], "Source_ID long, Tokens array<string>")
    top = X.top_words(texts, 1)
    assert [tuple(r) for r in top.collect()] == [("a", 2)] and "LocalRelation" not in top._jdf.queryExecution().logical().toString()


def test_texts_are_cut_in_pieces_of_bounded_size():
    batch = pa.RecordBatch.from_pydict({"k": list(range(6)), "t": ["a" * (X.CUT_BYTES // 2), "b" * (X.CUT_BYTES // 2), None, "c", "d" * (2 * X.CUT_BYTES), ""]})
    pieces = list(X._pieces(batch, 1))
    assert pa.Table.from_batches(pieces) == pa.Table.from_batches([batch]) and [p.num_rows for p in pieces] == [3, 1, 1, 1] and not list(X._pieces(batch.slice(0, 0), 1))


def test_words_are_found_as_tokens_without_cutting(spark, sf):
    """As in the tokens, for words and neighbours of both classes and of none; the queries that need no tokens cut none."""
    draw = random.Random(4)
    texts = [None, "", "好", "no", "nono no", "no好no", "好a好好", "noé", "éno", "no_bad", "bad-no1", "\n好\n", "𠀀好𠀀", "1no 2", "NO"] + ["".join(draw.choice("no好沉 -é𠀀1") for _ in range(draw.randrange(12))) for _ in range(300)]
    words = ("no", "n", "o", "1", "NO", "bad", "好", "沉", "好好", "no好", "é", "o-", "", "n o", "no\n", ".", "𠀀")
    df = spark.createDataFrame([(t,) for t in texts], "c string").withColumn("t", X.regex_tokens(F.col("c")))
    for r in df.select("c", "t", F.array(*[F.coalesce(X.is_regex_token(F.col("c"), w), F.lit(False)) for w in words]).alias("found")).collect():
        assert r.found == [w in (r.t or []) for w in words], r.c
    lexicon = L.Lexicon(positive=("n", "好", "no好"), negative_single=("o", "no", "沉", "é"))
    both = df.select(X.sentiment(F.col("c"), F.col("t"), lexicon).alias("cut"), X.sentiment(F.col("c"), None, lexicon).alias("found")).collect()
    assert [r.cut for r in both] == [r.found for r in both] and len({r.cut for r in both}) > 5
    for name in ("sentiment", "sentiment_distribution", "design_implications", "feature_vectors"):
        assert "regexp_extract_all(" not in queries.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString(), name
