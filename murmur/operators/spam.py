"""Spam filter: rule features + TF-IDF tokens -> logistic regression (Spark ML).

The model is fitted once and saved (the original retrains at every start);
``filter_spam`` applies it to batch or streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from murmur.operators.features import RULE_FEATURES, counter_features, text_features, tokenize
from murmur.vocab import REFERENCE, Vocab


def spam_features(df: DataFrame, vocab: Vocab = REFERENCE, dictionary: DataFrame | None = None) -> DataFrame:
    return counter_features(spam_text_features(df, vocab, dictionary))


def spam_text_features(df: DataFrame, vocab: Vocab = REFERENCE, dictionary: DataFrame | None = None) -> DataFrame:
    """The features that depend on the text alone; ``counter_features`` adds the others."""
    return tokenize(text_features(df, vocab), dictionary=dictionary)


def spam_pipeline(num_features: int = 1500, with_mean: bool = True, max_iter: int = 100):
    """HashingTF(1500) -> IDF -> assembler (9 rule features + tf-idf, rows with a
    NULL feature skipped) -> StandardScaler -> LogisticRegression.

    ``with_mean=True`` densifies the 1509-wide vectors as the original does;
    ``False`` keeps them sparse (much less memory per row at scale).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, StandardScaler, VectorAssembler
    return Pipeline(stages=[
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="tfidf_features"),
        VectorAssembler(inputCols=[*RULE_FEATURES, "tfidf_features"], outputCol="final_features",
                        handleInvalid="skip"),
        StandardScaler(inputCol="final_features", outputCol="scaled_features", withMean=with_mean, withStd=True),
        LogisticRegression(labelCol="label", featuresCol="scaled_features", predictionCol="prediction",
                           maxIter=max_iter),
    ])


def training_set(labelled: DataFrame) -> DataFrame:
    """Rows with a label; label as double (0 = spam, 1 = valid)."""
    lab = F.col("label")
    return labelled.where(lab.isNotNull() & (lab.cast("string") != "")).withColumn("label", lab.try_cast("double"))


def train_test_split(df: DataFrame, test_fraction: float = 0.2, key: str = "text", buckets: int = 100):
    """Deterministic split by a hash of ``key`` (equal texts stay on one side),
    independent of partitioning, unlike ``randomSplit``."""
    test = held_out(key, test_fraction, buckets)
    return df.where(~test), df.where(test)


def held_out(key: str = "text", test_fraction: float = 0.2, buckets: int = 100) -> Column:
    """Whether :func:`train_test_split` puts a row on the test side."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)) < int(round(buckets * test_fraction))


def train_spam_model(train: DataFrame, vocab: Vocab = REFERENCE, dictionary: DataFrame | None = None, **kw):
    return fit_spam_model(spam_features(train, vocab, dictionary), **kw)


def hash_words(features: DataFrame, num_features: int = 1500) -> DataFrame:
    """``rawFeatures``, the first stage of :func:`spam_pipeline`, in place of ``words``: hashed once, however many rows follow."""
    return spam_pipeline(num_features).getStages()[0].transform(features).drop("words")


def fit_spam_model(features: DataFrame, **kw):
    """The model of rows that have their features already, with ``words`` or with ``rawFeatures``.

    The vectors stay sparse whatever ``with_mean``: the regression centres in its solver and its intercept takes up the
    means, so margins and predictions are those of centred vectors.
    """
    from pyspark.ml import Pipeline, PipelineModel
    first, *rest = spam_pipeline(**kw | {"with_mean": False}).getStages()
    if "rawFeatures" not in features.columns:
        features = first.transform(features).drop("words")
    return PipelineModel([first, *Pipeline(stages=rest).fit(features).stages])


def judge(features: DataFrame, model) -> DataFrame:
    """Predictions for rows that have their features already, with ``words`` or with ``rawFeatures``."""
    from pyspark.ml import PipelineModel
    return (PipelineModel(model.stages[1:]) if "rawFeatures" in features.columns else model).transform(features)


def predict_spam(df: DataFrame, model, vocab: Vocab = REFERENCE, dictionary: DataFrame | None = None) -> DataFrame:
    return model.transform(spam_features(df, vocab, dictionary))


def filter_spam(df: DataFrame, model, vocab: Vocab = REFERENCE) -> DataFrame:
    """Keep rows predicted valid (1.0), with the original columns only."""
    cols = df.columns
    return predict_spam(df, model, vocab).where(F.col("prediction") == 1.0).select(*cols)


def eval_classifier(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """Confusion counts with total / correct / accuracy on every row (one aggregate)."""
    counts = pred.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    w = Window.partitionBy()   # a handful of (label, prediction) rows
    total = F.sum("n").over(w)
    correct = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).over(w)
    return (counts.withColumn("total", total).withColumn("correct", correct)
            .withColumn("accuracy", F.round(F.col("correct") / F.col("total"), 6)))


def misjudged(pred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid posts predicted spam, and spam predicted valid; all of them (callers that show a few take a limit)."""
    fn = pred.where((F.col("label") == 1.0) & (F.col("prediction") == 0.0)).select("text", "label", "prediction")
    fp = pred.where((F.col("label") == 0.0) & (F.col("prediction") == 1.0)).select("text", "label", "prediction")
    return fn, fp
