"""Exact samples by class."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmill.operators.skew import number_rows
from brookmill.session import materialise

DIGITS = 13  # of the hash, hexadecimal: exact in a double


def _share(digest: Column) -> Column:
    """The first digits of a hexadecimal digest as a number from 0 to 1; it rises with the digest."""
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def balanced_sample(df: DataFrame, label: str, id: str, k: int | None = None, spare: float = 6.0) -> DataFrame:
    """``id, label`` of ``k`` rows of each class, those whose ids have the smallest MD5; by default as many as the smallest class has.

    The same in every run and for every partitioning. A class with fewer rows gives all of them; rows without a label or an id are in no class,
    and ``id`` is a key. A class of any size is cut in the scan to the hashes below a bound that leaves ``spare`` standard deviations more than
    ``k`` rows; only these are ordered, by ranges that split a class. Should a bound leave too few after all, it is dropped.
    """
    digest = F.md5(F.col(id).cast("string"))
    rows = df.where(F.col(label).isNotNull() & F.col(id).isNotNull()).select(id, label, digest.alias("_digest"))
    sizes = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}  # a row per class
    if not sizes:
        return rows.drop("_digest")
    k = min(sizes.values()) if k is None else k
    bounds = {c: (k + spare * sqrt(k) + spare) / n for c, n in sizes.items()}
    near = rows
    tight = {c: b for c, b in bounds.items() if b < 1}
    if tight:
        far = F.lit(False)
        for c, b in tight.items():
            far = far | ((F.col(label) == F.lit(c)) & (_share(F.col("_digest")) >= b))
        near = materialise(rows.where(~far), "near-hashes")
        left = {r[label]: r["count"] for r in near.groupBy(label).count().collect()}
        if any(left.get(c, 0) < min(k, n) for c, n in sizes.items()):
            near = rows
    return number_rows(near, [label], ["_digest", id], "_rank").where(F.col("_rank") <= k).select(id, label)
