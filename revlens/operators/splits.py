"""Reproducible splits by a hash of a stored row key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.fixed_values import CV_FOLDS, SEED, SPLIT_SHARES

BUCKETS = 10_000


def _bucket(key: str, salt: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(buckets))


def with_split(rows: DataFrame, key: str) -> DataFrame:
    """Adds `split`: train, validation or test.

    The hash depends on the key alone, so the split does not change with the
    partitioning and needs neither a sort nor a second pass.
    """
    bucket = _bucket(key, SEED, BUCKETS)
    names = list(SPLIT_SHARES)
    upper, chain = 0.0, None
    for name in names[:-1]:
        upper += SPLIT_SHARES[name]
        rule = bucket < round(upper * BUCKETS)
        chain = F.when(rule, F.lit(name)) if chain is None else chain.when(rule, F.lit(name))
    return rows.withColumn("split", chain.otherwise(F.lit(names[-1])))


def with_fold(rows: DataFrame, key: str, folds: int = CV_FOLDS) -> DataFrame:
    return rows.withColumn("fold", _bucket(key, SEED + 1, folds).cast("int"))
