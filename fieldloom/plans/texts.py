"""Queries of sequences, texts and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldloom.durable import durable
from fieldloom.functions import arrays as ar
from fieldloom.functions import sequence as sq
from fieldloom.functions import text as tx
from fieldloom.plans.views import PURE, SEQ, Register, pure_seq, seq
from fieldloom.sources.tables import table

query = Register()
r6 = lambda c: F.round(c, 6)
_CLEAN = "regexp_replace(lower(coalesce(text, '')), '[!-/:-@\\x5B-\\x60\\x7B-\\x7E]', '', 'g')"
_WORDS = f"w AS (SELECT doc_id, unnest(string_split_regex({_CLEAN}, '[ \\t\\n\\r\\x0b\\f]+')) AS term FROM documents), c AS (SELECT doc_id, term, count(*) AS n FROM w WHERE term <> '' GROUP BY ALL)"
_STOP = "(" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + ")"


@query(f"WITH {SEQ} SELECT event_id, regexp_replace(upper(dna), '[^ATCG]', '', 'g') AS clean, CASE WHEN length(regexp_replace(dna, '[^NYRWS]', '', 'g')) / length(dna) <= 0.2 THEN translate(dna, 'NYRWS', 'ACGAC') END AS resolved FROM seq")
def dna_clean(spark: SparkSession, d: str) -> DataFrame:
    return seq(spark, d).select("event_id", sq.clean_dna(F.col("dna")).alias("clean"), sq.replace_ambiguous(F.col("dna"), 0.2).alias("resolved"))


@query(f"WITH {PURE}, k AS (SELECT event_id, substr(dna, unnest(range(1, 28))::INT, 4) AS kmer FROM pure) SELECT kmer, count(*) AS n, round(count(*) / (SELECT count(*) FROM k), 8) AS share FROM k GROUP BY kmer")
def kmer_freq(spark: SparkSession, d: str) -> DataFrame:
    from fieldloom.operators.aggregates import share_of_total

    x = pure_seq(spark, d).select(F.explode(sq.kmers(F.col("dna"), 4)).alias("kmer"))
    return share_of_total(x, "kmer").withColumn("share", F.round("share", 8))


@query(f"WITH {PURE}, k AS (SELECT event_id, substr(dna, unnest(range(1, 30))::INT, 2) AS kmer FROM pure), n AS (SELECT event_id, kmer, count(*) AS n FROM k GROUP BY ALL), g AS (SELECT a || b AS kmer, row_number() OVER (ORDER BY a || b) AS i FROM (VALUES ('A'), ('C'), ('G'), ('T')) x(a), (VALUES ('A'), ('C'), ('G'), ('T')) y(b)) SELECT e.event_id, string_agg(coalesce(n.n, 0)::INT, ',' ORDER BY i) AS counts FROM pure e CROSS JOIN g LEFT JOIN n ON n.event_id = e.event_id AND n.kmer = g.kmer GROUP BY e.event_id")
def kmer_vector(spark: SparkSession, d: str) -> DataFrame:
    v = sq.kmer_vector(F.col("dna"), 2)
    return pure_seq(spark, d).select("event_id", F.array_join(F.transform(v, lambda x: F.rint(x * 29).cast("int").cast("string")), ",").alias("counts"))


@query(f"WITH {PURE} SELECT event_id, string_agg(CASE WHEN substr(dna, i::INT, 1) = b THEN '1' ELSE '0' END, '' ORDER BY b, i) AS code FROM pure, (VALUES ('A'), ('C'), ('G'), ('T')) x(b), range(1, 33) r(i) GROUP BY event_id")
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    x = sq.one_hot(F.col("dna"), 32)
    return pure_seq(spark, d).select("event_id", F.array_join(F.transform(F.flatten(x), lambda v: v.cast("string")), "").alias("code"))


@query(f"SELECT doc_id, md5({_CLEAN}) AS clean FROM documents")
def text_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(tx.without_punctuation(F.lower(F.coalesce("text", F.lit(""))))).alias("clean"))


@query(f"WITH {_WORDS} SELECT doc_id, sum(n)::BIGINT AS words, sum(n) FILTER (term NOT IN {_STOP})::BIGINT AS content_words FROM c GROUP BY doc_id")
def stop_words(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").withColumn("w", tx.tokens(F.col("text")))
    y = x.select("doc_id", F.size("w").cast("bigint").alias("words"), F.nullif(F.size(tx.without_stop_words(F.col("w"))).cast("bigint"), F.lit(0)).alias("content_words"))
    return y.filter("words > 0")


@query(f"WITH {_WORDS}, v AS (SELECT term FROM c GROUP BY term ORDER BY sum(n) DESC, term LIMIT 1000) SELECT doc_id, term, n FROM c JOIN v USING (term)")
def bag_of_words(spark: SparkSession, d: str) -> DataFrame:
    c = tx.term_counts(table(spark, d, "documents"), "doc_id", tx.tokens(F.col("text")))
    return c.join(tx.vocabulary(c, 1000).select("term"), "term", "left_semi").select("doc_id", "term", "n")


@query(f"WITH {_WORDS}, v AS (SELECT term, count(*) AS df FROM c GROUP BY term ORDER BY sum(n) DESC, term LIMIT 1000), x AS (SELECT doc_id, term, n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS w FROM c JOIN v USING (term)) SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x")
def tfidf(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    c = durable(tx.term_counts(docs, "doc_id", tx.tokens(F.col("text"))))  # read for the vocabulary and for the weights
    return tx.tfidf(c, tx.vocabulary(c, 1000), docs.agg(F.count(F.lit(1))).scalar(), "doc_id").withColumn("weight", r6("weight"))


@query(f"WITH t AS (SELECT doc_id, list_filter(string_split_regex({_CLEAN}, '[ \\t\\n\\r\\x0b\\f]+'), lambda x: x <> '') AS w FROM documents), g AS (SELECT unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM t) SELECT term, count(*) AS n FROM g GROUP BY term")
def ngrams(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select(F.explode(tx.ngrams(tx.tokens(F.col("text")), 2)).alias("term"))
    return x.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT vec_id, len(embedding)::INT AS n, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total, 80 AS padded, round(list_sum(list_transform(embedding[1:10], lambda x: x::DOUBLE)), 4) AS head FROM embeddings")
def vector_pad(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    return e.select("vec_id", F.size("embedding").alias("n"), F.round(ar.total(ar.fit_length(v, 80)), 4).alias("total"), F.size(ar.fit_length(v, 80)).alias("padded"), F.round(ar.total(ar.fit_length(v, 10)), 4).alias("head"))


@query("WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS v FROM embeddings) SELECT vec_id, round(v[1] / list_sum(v), 6) AS first, round(list_max(v) / list_sum(v), 6) AS largest FROM e")
def vector_l1(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "embeddings").select("vec_id", sq.l1_normalised(F.transform("embedding", lambda v: F.abs(v.cast("double")))).alias("v"))
    return x.select("vec_id", r6(F.element_at("v", 1)).alias("first"), r6(F.array_max("v")).alias("largest"))


@query("WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), m AS (SELECT vec_id, list_transform(v, lambda x: x - list_avg(v)) AS v FROM e) SELECT vec_id, round(v[1] / list_max(list_transform(v, lambda x: abs(x))), 5) AS first, round(list_sum(v) / list_max(list_transform(v, lambda x: abs(x))) + 1, 5) AS one FROM m")
def wave_normalise(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "embeddings").select("vec_id", ar.peak_normalised(F.transform("embedding", lambda v: v.cast("double"))).alias("v"))
    return x.select("vec_id", F.round(F.element_at("v", 1), 5).alias("first"), F.round(ar.total(F.col("v")) + 1, 5).alias("one"))


@query("WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings), b AS (SELECT vec_id, least(floor((x + 1) / 0.25)::INT, 7) AS b, count(*) AS n FROM e WHERE x BETWEEN -1 AND 1 GROUP BY ALL) SELECT v.vec_id, string_agg(coalesce(n, 0)::INT, ',' ORDER BY i) AS bins FROM embeddings v CROSS JOIN range(8) r(i) LEFT JOIN b ON b.vec_id = v.vec_id AND b.b = i GROUP BY v.vec_id")
def value_histogram(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "embeddings").select("vec_id", ar.histogram(F.transform("embedding", lambda v: v.cast("double")), 8, -1.0, 1.0).alias("h"))
    return x.select("vec_id", F.array_join(F.transform("h", lambda v: v.cast("string")), ",").alias("bins"))
