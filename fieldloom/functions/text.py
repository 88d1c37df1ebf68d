"""Text cleaning and counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from fieldloom.functions.let import let

# The most common English function words.
STOP_WORDS = "a about after all also an and any are as at be because been before being below between both but by can did do does down during each few for from further had has have he her here him his how i if in into is it its just me more most my no nor not now of off on once only or other our out over own same she so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split()


def without_punctuation(text: Column) -> Column:
    """ASCII punctuation removed."""
    return F.regexp_replace(text, r"[!-/:-@\x5B-\x60\x7B-\x7E]", "")


def tokens(text: Column) -> Column:
    """Words of the cleaned, lower-case text (split at white space), empty for null and blank texts."""
    return F.filter(F.split(without_punctuation(F.lower(F.coalesce(text, F.lit("")))), r"[ \t\n\r\x0b\f]+"), lambda w: w != "")


def without_stop_words(words: Column, stop: list[str] = STOP_WORDS) -> Column:
    bad = F.array(*[F.lit(w) for w in stop])
    return F.filter(words, lambda w: ~F.array_contains(bad, w))


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` words joined by a blank."""
    runs = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))
    return let(words, lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(F.array().cast("array<string>")))


def term_counts(docs: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, term, n) of each term of each document."""
    return docs.select(key, F.explode(words).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(counts: DataFrame, most: int | None) -> DataFrame:
    """Terms with their document frequency ``df`` and total; with ``most`` the most frequent ones (ties by name)."""
    v = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("total"))
    return v if most is None else v.orderBy(F.desc("total"), "term").limit(most)


def tfidf(counts: DataFrame, vocab: DataFrame, documents: int | Column, key: str) -> DataFrame:
    """(key, term, weight): n * (ln((1 + documents) / (1 + df)) + 1), each document to unit length. The length comes from a window
    over the document's terms, of which there are no more than the vocabulary has."""
    w = counts.join(vocab, "term").withColumn("w", F.col("n") * (F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("weight"))
