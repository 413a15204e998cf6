"""Topic clustering of texts and clustering of wide embedding vectors (Spark ML)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from murmur.functions import text as TX
from murmur.operators.neighbours import stored


def topic_clusters(texts: DataFrame, k: int = 8, num_features: int = 1 << 12, seed: int = 42,
                   max_iter: int = 20, text_col: str = "text", id_col: str = "id"):
    """TF-IDF of the tokens, then k-means (distributed Lloyd iterations).

    Returns (model, assignments[id, cluster]).  Distinct texts should be
    passed (duplicates only reweight the centroids).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    df = stored(texts.select(id_col, TX.tokens(F.col(text_col)).alias("_words")), "tokens")     # read by each stage of the fit
    pipe = Pipeline(stages=[
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_features"),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster"),
    ])
    model = pipe.fit(df)
    return model, model.transform(df).select(id_col, "cluster")


def topic_terms(model, assignments: DataFrame, texts: DataFrame, top: int = 10,
                text_col: str = "text", id_col: str = "id") -> DataFrame:
    """Most frequent terms per cluster (a readable label for each topic)."""
    from pyspark.sql import Window
    t = (texts.select(id_col, F.explode(TX.tokens(F.col(text_col))).alias("term"))
         .join(assignments, id_col)
         .groupBy("cluster", "term").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("cluster").orderBy(F.desc("n"), F.asc("term"))
    return t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def embedding_clusters(emb: DataFrame, k: int = 4, seed: int = 42, method: str = "kmeans",
                       vec_col: str = "embedding", id_col: str = "vec_id", max_iter: int = 50,
                       pca_dims: int = 8) -> DataFrame:
    """Cluster wide float vectors: ``array<float>`` -> ML vector -> k-means or GMM.

    A full-covariance mixture on wide vectors is ill-conditioned unless there
    are many more points than dimensions squared, so ``method="gmm"`` first
    projects to ``pca_dims`` principal components.  Output: id, cluster (and
    membership probabilities for the mixture).
    """
    from pyspark.ml.clustering import GaussianMixture, KMeans
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = emb.select(id_col, array_to_vector(F.col(vec_col)).alias("_features"))
    if method == "gmm":
        v = (PCA(k=pca_dims, inputCol="_features", outputCol="_pca").fit(v).transform(v)
             .select(id_col, F.col("_pca").alias("_features")))
        m = GaussianMixture(k=k, seed=seed, maxIter=max_iter, featuresCol="_features",
                            predictionCol="cluster", probabilityCol="_p").fit(v)
        out = m.transform(v).withColumn("probability", vector_to_array("_p"))
        return out.select(id_col, "cluster", "probability")
    m = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(v)
    return m.transform(v).select(id_col, "cluster")
