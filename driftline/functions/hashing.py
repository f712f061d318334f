"""Hash-based, partition-independent splits, folds and dataset fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets): first 32 bits of md5(key) modulo ``buckets``.

    Unlike ``randomSplit`` the result depends only on the key, not on how the data happens to
    be partitioned, so re-runs, re-partitioning and executor loss give the same split.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def hash_split(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    b = md5_bucket(key)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def hash_split3(df: DataFrame, key: str, pcts: tuple[int, int] = (60, 80)) -> tuple[DataFrame, ...]:
    b = md5_bucket(key)
    return (df.filter(b < pcts[0]), df.filter((b >= pcts[0]) & (b < pcts[1])), df.filter(b >= pcts[1]))


def fold_col(key: str, k: int = 3) -> Column:
    """Stable k-fold id (for ``CrossValidator(foldCol=...)``)."""
    return md5_bucket(key, k).cast("int")


def row_fingerprint(cols: list[str]) -> Column:
    """32-bit md5 prefix of the row's values, each with its length (a null is told from an empty
    text, and values cannot run into each other)."""
    text = [F.col(c).cast("string") for c in cols]
    s = F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-;")) for t in text])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


FINGERPRINT_MOD = 4294967291  # largest prime below 2**32


def dataset_fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-free fingerprint of a dataset: (n_rows, sum of row hashes mod p).

    Equal datasets (as multisets of rows) give equal fingerprints whatever their order or
    partitioning; it is one aggregate with map-side partial sums.
    """
    cols = cols or df.columns
    h = row_fingerprint(cols)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  (F.sum(h.cast("decimal(38,0)")) % FINGERPRINT_MOD).cast("bigint").alias("fingerprint"))


def answer_hash(c: str | Column) -> Column:
    """32-bit md5 prefix of a value's text: the same in every engine."""
    k = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
