"""Pairs of members that share a group and lie close together.

Close pairs are looked up through grid cells inside each group.  Nothing is capped: a
group or cell with many members is cut into blocks and every pair of it is still found
exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import math

from ..functions.geo import EARTH_KM, haversine, unit_vector
from ..session import checkpointed
from .windows import top_n

BLOCK = 2_000
# So many values and known partners are carried with a member; pairs of members that have more are shuffled.
CARRIED, MET = 100, 1_000
CELL = ("_cx", "_cy", "_cz")


def _join_cells(left: DataFrame, right: DataFrame, cell_keys: Sequence[str], member: str, block: int,
                sparse: bool = False) -> DataFrame:
    """Equi-join on the cell; cells with more than `block` members on the right are
    split by a hash of the member, and the left rows are repeated once per block.  `sparse`
    says that many left rows lie in cells without any; they are left out before that."""
    keys = list(cell_keys)
    cells = right.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    dense, blocks = cells.filter(F.col("_blocks") > 1), F.coalesce(F.col("_blocks"), F.lit(1))
    split_right = right.join(dense, keys, "left").withColumn(
        "_block", F.pmod(F.xxhash64(F.col(member)), blocks).cast("int")
    ).drop("_blocks")
    met = left.join(cells, keys) if sparse else left.join(dense, keys, "left")
    spread_left = met.withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("_blocks")
    return spread_left.alias("l").join(split_right.alias("r"), [*keys, "_block"])


def limit_groups(df: DataFrame, group: str, max_members: int | None) -> DataFrame:
    """Leave out groups with more members than the business rule allows; None keeps
    all of them."""
    if max_members is None:
        return df
    small = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= max_members)
    return df.join(small.select(group), group, "left_semi")


def co_members(df: DataFrame, groups: Sequence[str], member: str, left: str = "left", right: str = "right",
               block: int = BLOCK) -> DataFrame:
    """Distinct pairs left < right that share a group.  A group of more than `block`
    members meets itself in blocks, so no task holds all its pairs."""
    base = df.select(*groups, F.col(member).alias("_m")).distinct()
    pairs = (
        _join_cells(base, base, groups, "_m", block).filter(F.col("l._m") < F.col("r._m"))
        .select(F.col("l._m").alias(left), F.col("r._m").alias(right))
    )
    return once(pairs, left, right)


def once(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """One row per pair.  Few pairs of one task are equal, so they are dealt out first and
    found side by side in sorted order: no task keeps pairs in hash maps."""
    return top_n(pairs.repartition(left, right), [left, right], [left], 1)


def pairs_within(df: DataFrame, groups: Sequence[str], member: str, lat: str, lon: str, km: float,
                 left: str = "user_left", right: str = "user_right", block: int = BLOCK) -> DataFrame:
    """Distinct pairs left < right that share all group columns and are at most
    `km` apart.  Cells are cubes around the unit sphere, so the date line and the
    poles need no special case; group columns are carried into the result."""
    base = checkpointed(  # read by four branches
        df.select(*groups, F.col(member).alias("_m"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    )
    close = _close(base, base, groups, km, block)
    return close.select(F.col("l._m").alias(left), F.col("r._m").alias(right), *groups)


def _close(lefts: DataFrame, rights: DataFrame, groups: Sequence[str], km: float, block: int) -> DataFrame:
    """Rows `l` and `r` of the same groups at most `km` apart, the member of `l` before that of `r`."""
    reach = 2 * math.sin(min(km / (2 * EARTH_KM), math.pi / 2)) * (1 + 1e-9)
    side = 2 * reach
    x, y, z = unit_vector(F.col("_lat"), F.col("_lon"))
    axes = ["_x", "_y", "_z"]

    def touched(axis: str) -> Column:
        low, high = F.floor((F.col(axis) - reach) / side), F.floor((F.col(axis) + reach) / side)
        return F.explode(F.sequence(low, high))

    # Cubes that do not meet the sphere hold nothing.
    low = [F.greatest(F.col(c) * side, -(F.col(c) + 1) * side, F.lit(0.0)) for c in CELL]
    high = [F.greatest(F.abs(F.col(c) * side), F.abs((F.col(c) + 1) * side)) for c in CELL]
    on_sphere = (sum(v * v for v in low) <= 1 + 1e-9) & (sum(v * v for v in high) >= 1 - 1e-9)
    near = lefts.withColumns(dict(zip(axes, (x, y, z))))
    for c, a in zip(CELL, axes):
        near = near.withColumn(c, touched(a))
    near = near.filter(on_sphere).drop(*axes)
    home = rights.withColumns({c: F.floor(v / side) for c, v in zip(CELL, (x, y, z))})
    joined = _join_cells(near, home, [*groups, *CELL], "_m", block, sparse=True)
    distance = haversine(F.col("l._lat"), F.col("l._lon"), F.col("r._lat"), F.col("r._lon"))
    return joined.filter((F.col("l._m") < F.col("r._m")) & (distance <= km))


def unknown_pairs_within(df: DataFrame, shared: str, group: str, member: str, lat: str, lon: str, km: float, known: DataFrame,
                         left: str = "user_left", right: str = "user_right", block: int = BLOCK,
                         carried: int = CARRIED, met_most: int = MET) -> DataFrame:
    """Distinct pairs left < right with their group that share a value of `shared`, are at most `km` apart
    and not in known(left, right).  A member has one group and one place, and neither is null.

    A member's rows carry its values below their own and its known partners of the group, so a
    pair is returned at the smallest value it shares and is never shuffled.  Only pairs of members
    with more than `carried` values or `met_most` partners are dealt out, made distinct and compared with `known`.
    """
    rows = df.select(shared, group, F.col(member).alias("_m"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    mine = Window.partitionBy("_m")
    below = mine.orderBy(shared).rowsBetween(-carried, -1)
    rows = checkpointed(rows.withColumns({"_n": F.count(F.lit(1)).over(mine), "_below": F.collect_list(shared).over(below)}))
    people = rows.select("_m", group).distinct()
    a, b = people.select(F.col("_m").alias("_a"), F.col(group).alias("_g")), people.select(F.col("_m").alias("_b"), F.col(group).alias("_h"))
    met = known.join(a, F.col(left) == F.col("_a")).join(b, (F.col(right) == F.col("_b")) & (F.col("_g") == F.col("_h")))
    met = top_n(met.select("_a", "_b").distinct(), ["_a"], ["_b"], met_most + 1).groupBy("_a").agg(F.collect_list("_b").alias("_met"))
    base = checkpointed(  # read by several branches
        rows.join(met, F.col("_m") == F.col("_a"), "left").withColumn("_met", F.coalesce("_met", F.array()))
        .withColumn("_few", (F.col("_n") <= carried) & (F.size("_met") <= met_most)).drop("_n", "_a")
    )
    few, many = base.filter("_few").drop("_few"), base.filter("not _few").drop("_few", "_below", "_met")
    first = ~F.arrays_overlap("l._below", "r._below") & ~F.array_contains("l._met", F.col("r._m"))

    def named(close: DataFrame) -> DataFrame:
        return close.select(F.col("l._m").alias(left), F.col("r._m").alias(right), group)

    pairs = named(_close(few, few.drop("_met"), [shared, group], km, block).filter(first))
    if many.isEmpty():
        return pairs
    bare = few.drop("_below", "_met")
    rest = named(_close(many, bare.unionByName(many), [shared, group], km, block)).unionByName(
        named(_close(bare, many, [shared, group], km, block)))
    return pairs.unionByName(once(rest, left, right).join(known, [left, right], "left_anti"))
