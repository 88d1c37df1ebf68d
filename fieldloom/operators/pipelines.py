"""Composed pipelines: DNA, text, waves and images from raw values to features, each one expression or one Arrow function."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldloom.durable import durable
from fieldloom.functions import media
from fieldloom.functions import sequence as sq
from fieldloom.functions import stem
from fieldloom.functions import text as tx


def dna_features(seq: Column, k: int = 4, most_ambiguous: float = 0.1, normalise: bool = True) -> Column:
    """Cleaned, resolved, counted and normalised: relative frequencies of all 4^k k-mers, null where too much is ambiguous, all 0
    for texts shorter than k and for null."""
    upper = F.upper(F.coalesce(seq, F.lit("")))
    resolved = F.when(F.length(upper) == 0, F.lit("")).otherwise(sq.replace_ambiguous(upper, most_ambiguous))
    vector = sq.kmer_vector(F.regexp_replace(resolved, "[^ATCG]", ""), k)
    return F.when(resolved.isNotNull(), sq.l1_normalised(vector) if normalise else vector)


def text_terms(docs: DataFrame, key: str, text: str, stop: list[str] = tx.STOP_WORDS, stems: bool = True) -> DataFrame:
    """(key, term, n): words of the cleaned text without stop words, stemmed. Each distinct word is stemmed once, not each occurrence."""
    c = tx.term_counts(docs.filter(F.col(key).isNotNull()), key, tx.without_stop_words(tx.tokens(F.col(text)), stop))
    if not stems:
        return c
    known = c.select("term").distinct()
    known = known.select("term", F.element_at(stem.stemmed(F.array("term")), 1).alias("__s"))
    return c.join(known, "term").groupBy(key, F.col("__s").alias("term")).agg(F.sum("n").alias("n"))


def augmented_wave(x: np.ndarray, seed: int = 0, noise: float = 0.005, shift: float = 0.1, gain: float = 0.2) -> np.ndarray:
    """A wave shifted in time (around the end), louder or softer, with noise; the same for the same seed."""
    r = np.random.default_rng(seed)
    y = np.roll(x, int(r.uniform(-shift, shift) * len(x))) * (1 + r.uniform(-gain, gain))
    return y + r.normal(0.0, noise, len(x))


def wave_features(wave: Column, rate: int, target: int = 16_000, seconds: float = 1.0, coefficients: int = 13) -> Column:
    """Silence removed, noise gated, resampled, cut or padded, normalised: mean cepstral coefficients. Null stays null, an empty
    wave gives zeros."""

    def run(x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(coefficients)
        x = media.without_silence(x)
        x = media.noise_gated(x) if len(x) >= 512 else x
        x = media.fit(media.resample(x, rate, target) if rate != target else x, int(seconds * target))
        peak = np.abs(x - x.mean()).max()
        return media.mfcc((x - x.mean()) / peak if peak > 0 else x * 0, target, coefficients).mean(1)

    return media.applied(run)(wave)


def denoised(image: np.ndarray, size: int = 3) -> np.ndarray:
    """Median of the ``size`` by ``size`` cells around each, the edges repeated; a third axis is kept."""
    h = size // 2
    p = np.pad(image, [(h, h), (h, h)] + [(0, 0)] * (image.ndim - 2), mode="edge")
    return np.median(np.stack([p[i : i + image.shape[0], j : j + image.shape[1]] for i in range(size) for j in range(size)]), axis=0)


def colour_histogram(image: np.ndarray, bins: int = 8) -> np.ndarray:
    """Shares of the ``bins`` classes of each channel's values 0…256, channel after channel."""
    x = image.reshape(image.shape[0] * image.shape[1], -1)
    return np.concatenate([np.histogram(x[:, c], bins, (0, 256))[0] / max(1, len(x)) for c in range(x.shape[1])])


def augmented_image(image: np.ndarray, seed: int = 0, light: float = 0.2) -> np.ndarray:
    """An image of values 0…255 mirrored or not, turned by quarters, lighter or darker; the same for the same seed."""
    r = np.random.default_rng(seed)
    y = image[:, ::-1] if r.random() < 0.5 else image
    return np.clip(np.rot90(y, int(r.integers(4))) * (1 + r.uniform(-light, light)), 0, 255)


def colour_space(image: np.ndarray, to: str = "hsv") -> np.ndarray:
    """Red, green and blue of 0…255 as grey (one value) or as hue (degrees), saturation and value (0…1)."""
    if to == "grey":
        return media.grey(image)
    x = image / 255.0
    top, low = x.max(-1), x.min(-1)
    d = np.where(top > low, top - low, 1.0)
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    hue = np.where(top == r, (g - b) / d % 6, np.where(top == g, (b - r) / d + 2, (r - g) / d + 4)) * 60
    return np.stack([np.where(top > low, hue, 0.0), np.where(top > 0, (top - low) / np.where(top > 0, top, 1.0), 0.0), top], -1)


def image_pipeline(pixels: Column, height: int, width: int, channels: int = 3, size: int = 32, bins: int = 8) -> Column:
    """struct of ``histogram``, ``hog`` and ``edge`` of row-major pixels 0…255: denoised, resized and cropped to ``size``, blurred for
    the edges. Null and arrays of another length give null."""

    def run(v: np.ndarray):
        if len(v) != height * width * channels:
            return None
        x = media.centre_cropped(media.resized(denoised(v.reshape(height, width, channels)), size, size), size, size)
        g = media.grey(x) if channels == 3 else x[..., 0]
        return {"histogram": colour_histogram(x, bins).tolist(), "hog": np.asarray(media.hog(g)).ravel().tolist(), "edge": float(media.edges(media.blurred(g)).mean())}

    kind = T.StructType([T.StructField("histogram", T.ArrayType(T.DoubleType())), T.StructField("hog", T.ArrayType(T.DoubleType())), T.StructField("edge", T.DoubleType())])

    @F.pandas_udf(T.StringType())
    def as_json(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None or (o := run(np.asarray(v, dtype=float))) is None else json.dumps(o) for v in values], dtype=object)

    return F.from_json(as_json(pixels), kind)


def corrections(words: DataFrame, word: str, count: str, rare: int, common: int, least: int = 4) -> DataFrame:
    """``word`` and ``correction``: words seen fewer than ``rare`` times with the most frequent word seen at least ``common`` times that is
    one letter away (changed, dropped or added; ties by name). Words shorter than ``least`` stay. Each word is joined by itself and
    by what is left without any one letter, so that no pair is compared that isn't close."""
    forms = lambda w: F.array_distinct(F.concat(F.array(w), F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))
    x = durable(words.filter(F.length(word) >= least).select(F.col(word).alias("w"), F.col(count).alias("n")))
    a = x.filter(F.col("n") < rare).select("w", F.explode(forms(F.col("w"))).alias("f"))
    b = x.filter(F.col("n") >= common).select(F.col("w").alias("c"), "n", F.explode(forms(F.col("w"))).alias("f"))
    near = a.join(b, "f").filter((F.col("w") != F.col("c")) & (F.levenshtein("w", "c") == 1))
    best = near.groupBy("w").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("c"))).alias("b"))
    return best.select(F.col("w").alias(word), F.col("b.c").alias("correction"))
