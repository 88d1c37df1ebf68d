"""Arrays as base64 text of 32-bit floats, for exchange with files that store them so."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T


@F.pandas_udf(T.StringType())
def to_base64(values: pd.Series) -> pd.Series:
    """Little-endian 32-bit floats in order; null stays null."""
    return values.map(lambda v: None if v is None else base64.b64encode(np.asarray(v, dtype="<f4").tobytes()).decode())


@F.pandas_udf(T.ArrayType(T.FloatType()))
def from_base64(values: pd.Series) -> pd.Series:
    """The floats of a base64 text; null and texts that aren't whole floats give null."""

    def one(v):
        try:
            raw = base64.b64decode(v or "", validate=True)
        except ValueError:
            return None
        return np.frombuffer(raw, dtype="<f4").tolist() if v and len(raw) % 4 == 0 else None

    return values.map(one)


def reduced(df: DataFrame, column: str, k: int, out: str = "reduced") -> DataFrame:
    """``df`` with the first ``k`` principal components of an array column, fitted on all rows (signs are arbitrary)."""
    x = df.withColumn("__v", array_to_vector(F.transform(column, lambda v: v.cast("double"))))
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(x.filter(F.col(column).isNotNull()))
    return model.transform(x).withColumn(out, vector_to_array("__p")).drop("__v", "__p")
