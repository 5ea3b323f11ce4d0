"""What the vector operators share: which vectors take part, and arrays of them in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squared_norm(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def is_usable(key: str, vector: str) -> Column:
    """True if the vector and the id are not null, and the vector is not zero and holds finite numbers only."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    norm = squared_norm(v)
    return F.coalesce(F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & (norm > 0) & (norm < float("inf")), F.lit(False))


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """The rows whose vector is usable and has the commonest length."""
    v, rows = F.col(vector), rows.where(is_usable(key, vector))
    top = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size(v) == F.lit(top["d"] if top else 0))


def matrix(c: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in doubles."""
    flat = c.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(c), -1) if len(c) else flat.reshape(0, 0)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in the same order for equal rows whatever stands around them."""
    return np.einsum("ij,ij->i", a, b)
