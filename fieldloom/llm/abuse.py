"""Scoring documents for abusive, hateful or sexual language (problem 9).

Dense features of each document go into gradient-boosted trees fitted on the labelled documents, with isotonic
calibration on scores from outside the fold. The features: densities of general lexicons in several languages,
their closeness to a second person or to a group of people, densities of words and word pairs whose log-odds are
learnt from the labels outside the document's own fold, capitals, punctuation and obfuscation. The texts of an Arrow
batch are read as one string, and counted with arrays.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F, types as T

from fieldloom.durable import durable
from fieldloom.llm.reader import FEATURES, LEARNT, Reader, features, terms  # noqa: F401

#: Labelled documents used at most to fit the model. Only the model's sample is bounded, every document is scored.
MOST_LABELS = 200_000
#: Words and word pairs that the learnt lexicon holds at most, those of the surest log-odds.
MOST_LEARNT = 50_000
#: Weight of a labelled document taken as if its words were unknown, beside 1 of the document itself.
UNKNOWN_WEIGHT = 0.3
#: Labelled documents for each task of a boosting round.
LABELS_A_TASK = 50_000


def learnt_lexicon(known: DataFrame, text: str, label: str, fold: str, folds: int, most: int = MOST_LEARNT) -> dict[str, list[float]]:
    """Words and word pairs with their log-odds between labelled documents of either kind, nearer to 0 by a standard error: of
    the whole sample, and of the sample without each fold. At most ``most`` come to the driver, those of the largest."""
    words = T.StructType([T.StructField(label, T.DoubleType()), T.StructField(fold, T.IntegerType()), T.StructField("terms", T.ArrayType(T.StringType()))])

    def run(frames):
        for f in frames:
            yield pd.DataFrame({label: f[label], fold: f[fold], "terms": [terms(t) for t in f[text]]})

    each = known.select(text, label, fold).mapInPandas(run, words)
    size = {(r[fold], r[label]): r["count"] for r in known.groupBy(fold, label).count().collect()}
    part = lambda y, k: F.count_if((F.col(label) == y) & (F.col(fold) != k)).cast("double")
    met = each.select(label, fold, F.explode("terms").alias("term")).groupBy("term").agg(*[part(y, k).alias(f"n{int(y)}_{k + 1}") for y in (0.0, 1.0) for k in range(-1, folds)]).filter("n0_0 + n1_0 >= 2")
    weights = []
    for k in range(-1, folds):
        n = {y: float(sum(c for (i, z), c in size.items() if z == y and i != k)) for y in (0.0, 1.0)}
        a, b = F.col(f"n1_{k + 1}"), F.col(f"n0_{k + 1}")
        odds = F.log((a + 0.5) / (n[1.0] - a + 0.5)) - F.log((b + 0.5) / (n[0.0] - b + 0.5))
        weights.append(F.signum(odds) * F.greatest(F.lit(0.0), F.abs(odds) - F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))))
    rows = met.select("term", F.array(*weights).alias("w")).filter(F.exists("w", lambda x: F.abs(x) > 0.1)).orderBy(F.desc(F.abs(F.get("w", F.lit(0)))), "term").limit(most)
    return {r["term"]: list(r["w"]) for r in rows.collect()}


def with_features(df: DataFrame, key: str, text: str, carried: list[str], learnt: dict[str, list[float]] | None = None, folds: int = 0, fold: str | None = None) -> DataFrame:
    """``key``, ``carried`` and ``features`` (array of doubles) of each row; ``fold`` is null or the document's own fold, whose labels its learnt weights leave out."""
    kept = [key, *carried]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("features", T.ArrayType(T.DoubleType()))])
    shared = df.sparkSession.sparkContext.broadcast(learnt or {})  # at most MOST_LEARNT entries

    def run(frames):
        reader = Reader(shared.value, folds)
        for f in frames:
            own = f["__own"].fillna(-1).to_numpy(dtype=int) + 1
            x = reader.features([t if isinstance(t, str) else None for t in f["__text"]], own)
            yield f[kept].assign(features=list(x))

    return df.select(*kept, F.col(text).cast("string").alias("__text"), (F.col(fold) if fold else F.lit(None)).cast("int").alias("__own")).mapInPandas(run, schema)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", label: str = "abusive", threshold: float = 0.5, folds: int = 3, most_labels: int = MOST_LABELS) -> DataFrame:
    """``doc_id``, ``source``, ``score`` (calibrated probability) and ``abusive`` of every document.

    ``labels`` has a 0/1 label a document; unequal labels of one document give the more frequent, of equally frequent
    the larger. Null, empty and blank texts score 0. With labels of fewer than two classes every score is the share of
    positive labels. Texts are read whole. The model is fitted on about ``most_labels`` labelled documents at most, chosen
    by a hash of the id. A labelled document is scored by weights that were learnt without its own fold. Each labelled
    document also takes part as if none of its words were known, so that the general lexicons count where learnt words are
    absent.
    """
    docs = docs.filter(F.col(doc_id).isNotNull()).select(doc_id, F.col(text).alias("__doc"), source)
    y = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(doc_id).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("__label"))
    share = min(1.0, most_labels / max(1, y.count()))
    chosen = F.pmod(F.xxhash64(F.lit(5), doc_id), F.lit(1_000_000)) < share * 1_000_000
    y = durable(y.filter(chosen).withColumn("__fold", F.pmod(F.xxhash64(F.lit(7), doc_id), F.lit(folds)).cast("int")))
    y = F.broadcast(y)  # at most about most_labels rows
    sample = durable(docs.join(y, doc_id).select("__doc", "__label", "__fold"))
    classes = {r["__label"]: r["count"] for r in sample.groupBy("__label").count().collect()}
    if len(classes) < 2:
        rate = next(iter(classes), 0.0)
        return docs.select(doc_id, source, F.lit(float(rate)).alias("score"), F.lit(rate >= threshold).alias("abusive"))
    learnt = learnt_lexicon(sample, "__doc", "__label", "__fold", folds)
    feats = durable(with_features(docs.join(y, doc_id, "left"), doc_id, "__doc", [source, "__label", "__fold"], learnt, folds, "__fold"))
    n = sum(classes.values())
    known = feats.filter("__label IS NOT NULL").select("features", "__label", "__fold", F.lit(True).alias("real"))
    unknown = known.withColumns({"features": F.concat(F.slice("features", 1, len(FEATURES) - len(LEARNT)), F.array_repeat(F.lit(0.0), len(LEARNT))), "real": F.lit(False)})  # they weigh less, as where words are known these decide
    known = known.unionByName(unknown).select(array_to_vector("features").alias("x"), "__label", "__fold", "real", F.when(F.col("real"), 1.0).otherwise(UNKNOWN_WEIGHT).alias("__weight")).repartition(-(-2 * n // LABELS_A_TASK)).persist()
    trees = GBTClassifier(featuresCol="x", labelCol="__label", weightCol="__weight", maxIter=20, maxDepth=4, stepSize=0.25, minInstancesPerNode=3, subsamplingRate=0.8, seed=11, maxBins=64, checkpointInterval=-1)
    raw = lambda m, df: m.transform(df).withColumn("p", vector_to_array("probability")[1])
    seen: dict[int, set] = {}
    for r in known.select("__fold", "__label").distinct().collect():
        for k in range(folds):
            if k != r["__fold"]:
                seen.setdefault(k, set()).add(r["__label"])
    usable = [k for k in range(folds) if len(seen.get(k, ())) == 2]
    # Each boosting round is a few tiny jobs one after another; the independent fits run two at a time, which bounds what the driver holds.
    with ThreadPoolExecutor(2) as pool:
        *fitted, model = pool.map(trees.fit, [*(known.filter(F.col("__fold") != k) for k in usable), known])
    parts = [raw(m, known.filter((F.col("__fold") == k) & F.col("real"))).select("__label", "p") for k, m in zip(usable, fitted)]
    scored = raw(model, feats.withColumn("x", array_to_vector("features")))
    if parts:
        steps = IsotonicRegression(featuresCol="p", labelCol="__label").fit(reduce(DataFrame.unionByName, parts))
        at, to = np.array(steps.boundaries.toArray()), np.array(steps.predictions.toArray())

        @F.pandas_udf(T.DoubleType())
        def calibrated(p: pd.Series) -> pd.Series:
            return pd.Series(np.interp(p, at, to))

        scored = scored.withColumn("p", calibrated("p"))
    known.unpersist()
    empty = F.aggregate("features", F.lit(0.0), lambda a, v: a + F.abs(v)) == 0
    scored = scored.withColumn("score", F.when(empty, F.lit(0.0)).otherwise(F.col("p")))
    return scored.select(doc_id, source, "score", (F.col("score") >= threshold).alias("abusive"))
