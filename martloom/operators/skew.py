"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def hot_key_table(df: DataFrame, keys: Sequence[str], share: float = 0.02, tracked: int = 2_000) -> dict[str, list]:
    """For each column the values that hold more than `share` of the rows: at most
    1/share of them.

    One pass over these columns with mergeable sketches, no shuffle of rows.  The
    answer only steers how work is split, so an estimate is enough.  This is an
    action; its result is a plain list, so that both sides of a join use the
    same one also when tasks are retried.
    """
    tops = [F.expr(f"approx_top_k(`{k}`, {int(1 / share)}, {tracked})").alias(k) for k in keys]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *tops).first()
    return {
        k: [r["item"] for r in row[k] if r["item"] is not None and r["count"] > share * row["_n"]] for k in keys
    }


def hot_keys(df: DataFrame, key: str, share: float = 0.02) -> list:
    """Values of one column that hold more than `share` of the rows."""
    return hot_key_table(df, [key], share)[key]


def skew_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    hot: Sequence | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Equi-join of many-rows-per-key `fact` with one-row-per-key `dim`.

    Rows of hot keys are spread over `salts` tasks by a hash of the whole row and
    the few matching rows of `dim` are repeated once per salt; by default as many as a
    shuffle of this session has partitions, and 64 at least, so that a share of a hot key
    is no more than what a task gets anyway.  `how` is inner,
    left, left_semi or left_anti, so each fact row meets exactly one copy.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    hot = hot_keys(fact, key) if hot is None else list(hot)
    if not hot:
        return fact.join(dim, key, how)
    salts = salts or max(64, shuffle_partitions(fact.sparkSession))
    is_hot = F.col(key).isin(hot)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salts)).cast("int")
    fact = fact.withColumn("_salt", F.when(is_hot, spread).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dim = dim.withColumn("_salt", F.explode(copies))
    return fact.join(dim, [key, "_salt"], how).drop("_salt")
