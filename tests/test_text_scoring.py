"""Text rules with the original vocabulary, scorer contracts, table DDL and JDBC statement text."""

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from murmur.functions import text as TX
from murmur.operators import features as FT
from murmur.operators import scoring as SC
from murmur.operators import spam as SP
from murmur.schemas import POSTS
from murmur.sinks import jdbc as J
from murmur.sinks import lake as L
from murmur.vocab import FIXTURE, REFERENCE


def test_rule_features_reference_terms(spark):
    rows = [("抽奖抽大奖", 1001, 0, 0), ("关注转发又好又便宜", 0, 1, 2), ("普通内容", None, 1, 1)]
    df = spark.createDataFrame(rows, "text string, reposts_count int, comments_count int, attitudes_count int")
    got = {r.text: r for r in FT.rule_features(df, REFERENCE).collect()}
    a = got["抽奖抽大奖"]
    assert a.spam_keyword_count == 3          # "抽奖" then "抽": two hits -> 3 pieces (抽奖 listed first)
    assert a.is_viral == 1 and a.text_length == 5
    b = got["关注转发又好又便宜"]
    assert b.promotion_count == pytest.approx((9 - 0) / 8)
    assert b.engagement == 3 and b.engagement_ratio == pytest.approx(3 / 10)
    assert got["普通内容"].engagement is None   # NULL counter: NULL feature (the assembler skips the row)


def test_tokens_mixed_scripts(spark):
    df = spark.createDataFrame([("城市交通 traffic a 12 x9 好",), (None,), ("",)], "text string")
    got = [r[0] for r in df.select(TX.tokens(F.col("text"))).collect()]
    assert got == [["traffic", "12", "x9", "城市", "市交", "交通"], [], []]


def test_lexicon_scorers_and_dedup(spark):
    df = spark.createDataFrame([("1", "and and the", "d"), ("2", "and and the", "d"), ("3", "nothing", "d"),
                                ("4", "", "d"), ("5", None, "d")], "id string, text string, dt string")
    s = {r.id: r for r in SC.score_text(df, SC.lexicon_sentiment(FIXTURE)).collect()}
    assert set(s) == {"1", "2", "3"}                      # empty / NULL text is not scored
    assert s["1"].score == pytest.approx(3 / 5) and s["1"].label == FIXTURE.positive and s["1"].label_id == 2
    assert s["3"].label == FIXTURE.neutral and s["3"].confidence == 0.0
    t = {r.id: r for r in SC.score_text(df, SC.lexicon_topic(FIXTURE)).collect()}
    assert t["1"].topic_label == "city" and t["3"].topic_label is None


def test_pandas_and_model_scorers(spark):
    df = spark.createDataFrame([("1", "short"), ("2", "a much longer text here")], "id string, text string")

    def batch(texts):
        return pd.DataFrame({"label": ["long" if len(t) > 10 else "short" for t in texts],
                             "label_id": [int(len(t) > 10) for t in texts],
                             "score": [min(len(t) / 20.0, 1.0) for t in texts],
                             "confidence": [0.9 for _ in texts]})
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("label_id", T.IntegerType()),
                           T.StructField("score", T.DoubleType()), T.StructField("confidence", T.DoubleType())])
    got = {r.id: r.label for r in SC.score_text(df, SC.pandas_scorer(batch, schema)).collect()}
    assert got == {"1": "short", "2": "long"}

    train = spark.createDataFrame([(t, 1, 1, 1, float(i % 2)) for i, t in enumerate(
        ["free token now", "city report", "free free token", "road works", "token win", "city traffic"] * 4)],
        "text string, reposts_count int, comments_count int, attitudes_count int, label double")
    model = SP.train_spam_model(train, FIXTURE, max_iter=20)
    pred = SP.predict_spam(train, model, FIXTURE)
    ev = SP.eval_classifier(pred).first()
    assert ev.total == 24 and 0.0 <= ev.accuracy <= 1.0
    # partition-invariant predictions
    p1 = sorted(tuple(r) for r in pred.select("text", "prediction").collect())
    p2 = sorted(tuple(r) for r in SP.predict_spam(train.repartition(5), model, FIXTURE)
                .select("text", "prediction").collect())
    assert p1 == p2


def test_catalog_table_insert_by_name(spark):
    L.ensure_table(spark, "posts_t", POSTS)
    L.ensure_table(spark, "posts_t", POSTS)                # idempotent
    row = {f.name: None for f in POSTS.fields}
    row.update(id="1", dt="2024-01-01", text="hello world", hour=3)
    df = spark.createDataFrame([row], POSTS).select(*reversed(POSTS.fieldNames()))   # other column order
    L.append_partitioned(df, "posts_t")
    got = spark.table("posts_t").where("dt = '2024-01-01'").first()
    assert got.id == "1" and got.text == "hello world" and got.hour == 3


def test_merge_statement_text():
    sql = J.merge_sql("rec", "rec_stg", ["user_id", "post_id", "score"], ["user_id", "post_id"])
    assert sql.startswith("MERGE INTO rec d USING rec_stg s ON d.user_id = s.user_id AND d.post_id = s.post_id")
    assert "UPDATE SET score = s.score" in sql and "INSERT (user_id, post_id, score)" in sql
    my = J.merge_sql("rec", "rec_stg", ["user_id", "post_id", "score"], ["user_id", "post_id"], "mysql")
    assert my.endswith("ON DUPLICATE KEY UPDATE score = t.score")


def test_topic_terms_and_approx_diversity(spark):
    from murmur.operators import profiles as PR
    from murmur.operators.topics import topic_clusters, topic_terms
    from murmur.sources.posts_view import posts_view, sentiment_table
    from murmur.sources.tables import table
    from conftest import SF0001
    docs = table(spark, SF0001, "documents").select(F.col("doc_id").alias("id"), "text")
    model, assign = topic_clusters(docs, k=3, max_iter=5)
    terms = topic_terms(model, assign, docs, top=5).collect()
    assert terms and all(1 <= r["rank"] <= 5 for r in terms)
    assert {r.cluster for r in terms} <= {0, 1, 2}
    scored = sentiment_table(posts_view(spark, SF0001, vocab=FIXTURE))
    exact = {r.user_id: r.region_diversity_score for r in PR.region_diversity(scored).collect()}
    approx = {r.user_id: r.region_diversity_score for r in PR.region_diversity(scored, approx=True).collect()}
    assert exact == approx                     # HyperLogLog++ is exact at these small cardinalities


def _text_reads(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_columns_are_computed_before_the_posts_are_joined(spark):
    """No post carries a text: the documents' texts end below the join."""
    from murmur.plans import catalog
    from conftest import SF0001
    for name in ("tokenize", "rule_features", "score_topic", "score_sentiment"):
        plan = _text_reads(catalog.queries()[name](spark, SF0001))
        top = plan[:plan.index("Join")]
        assert "text#" not in top and "regexp" not in top, name


def test_keywords_by_texts_equal_those_by_posts(spark, monkeypatch):
    import random
    from murmur.operators import keywords as KW
    rng = random.Random(8)
    voc = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.choice(voc[:1 + rng.randrange(60)]) for _ in range(rng.randrange(30)))) for i in range(80)] + [(80, None), (3, "extra words w1")]
    posts = [(rng.choice(["d1", "d2", "d3", None]), rng.randrange(85)) for _ in range(400)] + [("d4", 80), ("d5", 3)]
    t = spark.createDataFrame(texts, "doc_id long, text string")
    p = spark.createDataFrame(posts, "dt string, doc_id long")
    want = sorted(map(str, KW.hot_keywords(p.join(t, "doc_id", "left"), k=4).collect()))
    kept, sizes = KW.stored, {}
    monkeypatch.setattr(KW, "stored", lambda df, name: sizes.setdefault(name, kept(df, name)))
    monkeypatch.setattr(KW, "FIRST_TERMS", 8)
    assert sorted(map(str, KW.hot_keywords(p, k=4, texts=t).collect())) == want
    sizes.clear()
    busy = p.where("dt IN ('d1', 'd2')")
    want = sorted(map(str, KW.hot_keywords(busy.join(t, "doc_id", "left"), k=4).collect()))
    assert sorted(map(str, KW.hot_keywords(busy, k=4, texts=t).collect())) == want
    assert sizes["candidates"].count() < sizes["totals"].count()


def test_spam_features_are_the_same_in_two_steps(spark):
    from murmur.operators import features as FT, spam as SP
    df = spark.createDataFrame([("free token share", 1, 2, 3), (None, 2000, 1, 1), ("", 0, 0, 0)], "text string, reposts_count int, comments_count int, attitudes_count int")
    two = FT.counter_features(SP.spam_text_features(df))
    one = SP.spam_features(df)
    assert sorted(map(str, two.select(*one.columns).collect())) == sorted(map(str, one.collect()))
    r = FT.rule_features(df).where("text = ''").first()
    assert (r["text_length"], r["engagement"], r["engagement_ratio"]) == (0, 0, 0.0)


def test_spam_vectors_stay_sparse_and_the_model_is_that_of_centred_ones(spark):
    from pyspark.ml.linalg import SparseVector
    rows = [(f"w{i % 7} w{i % 5} x{i} promo", i, i % 3, i % 4, float(i % 3 > 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, reposts_count int, comments_count int, attitudes_count int, label double")
    words = SP.spam_features(df)
    dense = SP.spam_pipeline(max_iter=4).fit(words)
    model = SP.fit_spam_model(words, max_iter=4)
    hashed = SP.hash_words(words)
    assert "words" not in hashed.columns
    again = SP.fit_spam_model(hashed, max_iter=4)
    margin = lambda df: {r["text"]: r["rawPrediction"][1] for r in df.select("text", "rawPrediction").collect()}
    want = margin(dense.transform(words))
    assert len(want) == 60
    for got in (model.transform(words), SP.judge(words, again), SP.judge(hashed, model)):
        assert isinstance(got.first()["scaled_features"], SparseVector)
        assert margin(got) == pytest.approx(want, rel=1e-9, abs=1e-9)
    train, test = SP.train_test_split(df)
    marked = df.withColumn("held", SP.held_out())
    assert {r["text"] for r in marked.where("held").collect()} == {r["text"] for r in test.collect()} and train.count() + test.count() == 60
