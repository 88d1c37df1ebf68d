"""DNA sequences: cleaning, k-mers and one-hot codes as Column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from fieldloom.functions.let import let


def clean_dna(seq: Column) -> Column:
    """Upper case, only A, T, C and G; null gives the empty text."""
    return F.coalesce(F.regexp_replace(F.upper(seq), "[^ATCG]", ""), F.lit(""))


def replace_ambiguous(seq: Column, most: float = 0.1) -> Column:
    """Ambiguity codes N Y R W S as A C G A C if their share is at most ``most``; else, and for empty texts, null."""
    share = F.length(F.regexp_replace(seq, "[^NYRWS]", "")) / F.length(seq)
    return F.when((F.length(seq) > 0) & (share <= most), F.translate(seq, "NYRWS", "ACGAC"))


def kmers(seq: Column, k: int) -> Column:
    """Array of the overlapping k-mers, empty for shorter texts."""
    return F.when(F.length(seq) >= k, F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), lambda i: F.substring(seq, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def kmer_index(kmer: Column, k: int) -> Column:
    """Place of a k-mer in the order of A, C, G, T, from 0; null if it has another letter."""
    digits = F.translate(kmer, "ACGT", "0123")
    return F.conv(digits, 4, 10).try_cast("int") if k <= 31 else F.lit(None)


def kmer_vector(seq: Column, k: int) -> Column:
    """Relative frequencies of all 4^k k-mers in order; all 0 for null and for texts shorter than k. Counted in Arrow batches, one
    pass over the letters whatever k; k-mers with other letters don't count."""
    digit = np.full(256, -1, dtype=np.int64)
    digit[[ord(c) for c in "ACGT"]] = range(4)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(values: pd.Series) -> pd.Series:
        out = []
        for v in values:
            d = digit[np.frombuffer((v or "").encode("latin-1", "replace"), dtype=np.uint8)]
            n = len(d) - k + 1
            code, good = np.zeros(max(n, 0), dtype=np.int64), np.ones(max(n, 0), dtype=bool)
            for i in range(k if n > 0 else 0):
                code, good = code * 4 + d[i : i + n], good & (d[i : i + n] >= 0)
            out.append(np.bincount(code[good], minlength=4**k) / max(n, 1))
        return pd.Series(out, dtype=object)

    return run(seq)


def l1_normalised(vector: Column) -> Column:
    """Vector over its sum; unchanged if the sum isn't positive."""
    return let(vector, lambda v: let(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), lambda t: F.when(t > 0, F.transform(v, lambda x: x / t)).otherwise(v)))


def one_hot(seq: Column, length: int) -> Column:
    """Four rows (A, C, G, T) of ``length`` 0/1 values; beyond the text 0."""
    return let(seq, lambda s: F.transform(F.array(*[F.lit(b) for b in "ACGT"]), lambda b: F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: (F.substring(s, i, F.lit(1)) == b).cast("int"))))
