import math
from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from tallyloom.functions.stopwords import ENGLISH_STOP_WORDS
from tallyloom.functions.textual import clean_message, clean_title, squeeze_spaces, strip_digits, strip_punctuation, terms, tokens
from tallyloom.operators import text
from tallyloom.operators.coding import dense

EDGES = ["", " ", "  \t ", "a", " a", "a ", " The  cat\nsat ", "I'll go", "x" * 5000 + " y", "Ünï Ärger", "1 2;3", ";", "a - b", "\n\n"]


def _texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def test_stop_words_are_sparks_default_list(spark):
    assert ENGLISH_STOP_WORDS == list(StopWordsRemover.loadDefaultStopWords("english"))


def _agrees_with_stages(spark, values):
    df = _texts(spark, values)
    staged = StopWordsRemover(inputCol="t", outputCol="w").transform(Tokenizer(inputCol="text", outputCol="t").transform(df))
    both = staged.select("text", "t", "w", tokens("text").alias("mine"), terms("t").alias("kept")).collect()
    for row in both:
        assert row.t == row.mine, row.text
        assert row.w == row.kept, row.text


def test_tokens_and_terms_equal_the_ml_stages(spark):
    _agrees_with_stages(spark, EDGES)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ the;9\t\n é-", max_size=30), min_size=20, max_size=20))
def test_tokens_on_random_texts(spark, values):
    _agrees_with_stages(spark, values)


def test_one_pass_cleaning_equals_the_three_steps(spark):
    df = _texts(spark, [*EDGES, "a..b  9  c!?", "(x)_-_ 12 y", "7"])
    same = df.select(clean_message("text").alias("a"), squeeze_spaces(strip_digits(strip_punctuation("text"))).alias("b"))
    assert same.where("a <> b").count() == 0


def test_text_stages_equal_the_column_form(spark):
    df = _texts(spark, EDGES)
    staged = df
    for stage in text.text_stages("text")[:3]:
        staged = stage.transform(staged)
    rows = text.with_terms(staged, "text").select("terms", "text_terms").collect()
    assert all(r.terms == r.text_terms for r in rows)


def test_term_tfidf_by_brute_force_with_a_term_in_every_row(spark):
    docs = [["hot"] * (i % 3 + 1) + [f"w{i % 7}", f"u{i}"] for i in range(300)]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, terms array<string>")
    df_count = Counter(t for d in docs for t in set(d))
    expected = {
        (i, t): (n, df_count[t], n * math.log(301 / (df_count[t] + 1)))
        for i, d in enumerate(docs) for t, n in Counter(d).items()
    }
    found = {(r.id, r.term): (r.tf, r.df, r.tfidf) for r in text.term_tfidf(df, "id").collect()}
    assert found.keys() == expected.keys()
    assert all(f[:2] == e[:2] and math.isclose(f[2], e[2], abs_tol=1e-9) for f, e in ((found[k], expected[k]) for k in expected))


def test_term_counts_within_rows_and_of_repeated_keys(spark):
    rows = [(1, ["b", None, "a", "b", ""]), (2, []), (3, None), (4, [None]), (None, ["a", "ä", "a"])]
    df = spark.createDataFrame(rows, "id int, terms array<string>")
    counted = lambda found: {(r.id, r.term): r.tf for r in found.collect()}
    expected = {(1, "b"): 2, (1, "a"): 1, (1, ""): 1, (None, "a"): 2, (None, "ä"): 1}
    within = text.row_term_counts(df, "id")
    assert counted(within) == counted(text.term_counts(df, "id")) == expected and within.schema["tf"].dataType.typeName() == "long"
    assert "Exchange" not in within._jdf.queryExecution().executedPlan().toString()
    twice = text.term_tfidf(df.unionAll(df), "id")
    assert {(r.id, r.term): (r.tf, r.df) for r in twice.collect()} == {k: (2 * n, 2 if k[1] == "a" else 1) for k, n in expected.items()}


def test_term_tfidf_shuffles_rows_once(spark, mid_dir):
    df = spark.read.parquet(f"{mid_dir}/documents.parquet").select("doc_id", "text")
    plan = text.term_tfidf(text.with_terms(df, "text"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" not in plan


def test_rows_without_words_are_counted_in_m(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "id int, terms array<string>")
    row = text.term_tfidf(df, "id").first()
    assert math.isclose(row.idf, math.log(4 / 2))


def test_hashed_counts_lose_no_term(spark):
    df = text.with_terms(_texts(spark, EDGES), "text")
    hashed = HashingTF(inputCol="terms", outputCol="tf", numFeatures=32).transform(df)
    total = F.aggregate(dense("tf"), F.lit(0.0), lambda a, b: a + b)
    assert hashed.where(total != F.size("terms")).count() == 0


def test_hashed_tfidf_uses_log_smoothing(spark):
    df = _texts(spark, ["cat dog", "cat", "bird"])
    weighed = text.hashed_tfidf(df, "text", 1024).orderBy("id")
    first = [v for v in weighed.select(dense("features").alias("v")).first().v if v > 0]
    assert sorted(round(v, 9) for v in first) == [round(math.log(4 / 3), 9), round(math.log(4 / 2), 9)]


def test_counts_are_shuffled_once(spark, mid_dir):
    df = spark.read.parquet(f"{mid_dir}/documents.parquet").select("doc_id", "text")
    # some terms are frequent: of an empty hot list the final plan would show nothing
    weighed = text.term_tfidf(text.with_terms(df, "text"), "doc_id", rows_per_task=200).agg(F.sum("tfidf"))
    weighed.collect()
    final = weighed._jdf.queryExecution().executedPlan().executedPlan().toString()
    # re-read: the counts for the document counts, and the document counts for the hot list
    assert final.count("ReusedExchange") >= 2


def test_title_stages_equal_the_column_form(spark):
    df = _texts(spark, [*EDGES, "A Tale, of-Two-Cities,", "well-known, 2 -", ",", "-"])
    staged = df
    for stage in text.text_stages("text", buckets=32, rule="title")[:3]:
        staged = stage.transform(staged)
    rows = text.with_terms(staged, "text", clean=clean_title).select("terms", "text_terms").collect()
    assert all(r.terms == r.text_terms for r in rows)


def test_own_columns_stay(spark):
    df = _texts(spark, ["the cat sat"]).selectExpr("*", "1 AS _clean", "2 AS _tokens", "3 AS _Tokens_")
    row = text.with_terms(text.with_tokens(df, "text"), "text").first()
    assert (row._clean, row._tokens, row._Tokens_, row.tokens, row.terms) == (1, 2, 3, ["the", "cat", "sat"], ["cat", "sat"])


def test_hashed_weights_equal_the_stages(spark):
    df = _texts(spark, EDGES)
    got = {(r.id, r.buckets, r.slot): (r.tf, r.weight) for r in text.hashed_weights(df, "id", "text", [8, 32]).collect()}
    want = {}
    for n in (8, 32):
        for r in text.hashed_tfidf(df, "text", n).select("id", "text_hash", "features").collect():
            want.update({(r.id, n, int(i)): (r.text_hash[int(i)], r.features[int(i)]) for i in r.text_hash.indices})
    assert got == want


def test_hashed_plans_have_no_dense_vectors(spark, sf_dir):
    from tallyloom.plans import texts

    for query in (texts.hashed_tfidf, texts.title_tfidf, texts.hashed_term_totals):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "vector_to_array" not in plan and "transform(" not in plan
