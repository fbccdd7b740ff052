"""Grid cells that grow smaller where points are dense."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

LEAF_ROWS = 32
FACTOR = 4  # the sides of a cell are so many times those of the cells in it
DEEPEST = 16  # levels; the smallest cells of the unit sphere are far below a millimetre


def side_at(side: float, level: Column) -> Column:
    """Side of the cells of a level; `side` is that of level 0."""
    return F.lit(side) / F.pow(F.lit(float(FACTOR)), level)


def cell_at(axes: Sequence[str], side: float, level: int) -> Column:
    """The cell of a level that a point lies in.  With a power of two as `side` division
    is exact, so each cell lies in one cell of the level above."""
    places = [F.floor(F.col(a) / (side / FACTOR**level)) for a in axes]
    return F.struct(F.lit(level).alias("level"), F.array(*places).alias("at"))


def split_cells(points: DataFrame, axes: Sequence[str], side: float, leaf_rows: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The points with the cell `_cell` that holds at most `leaf_rows` of them, and for each
    level the cells (_parent, _child) into which its dense cells were split.

    Only points of dense cells go on to the next level, so sparse regions cost one pass.
    Points have to differ; those that still share a cell of the deepest level stay there.
    """
    leaf_rows = LEAF_ROWS if leaf_rows is None else leaf_rows
    leaves, splits = [], []
    left = checkpointed(points.withColumn("_cell", cell_at(axes, side, 0)))
    for level in range(DEEPEST):
        dense = checkpointed(
            left.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > leaf_rows).select("_cell"))
        if dense.isEmpty():
            break
        leaves.append(left.join(dense, "_cell", "left_anti"))
        inner = checkpointed(left.join(dense, "_cell", "left_semi").withColumns(
            {"_parent": F.col("_cell"), "_cell": cell_at(axes, side, level + 1)}))
        splits.append(inner.select("_parent", F.col("_cell").alias("_child")).distinct())
        left = inner.drop("_parent")
    return checkpointed(reduce(DataFrame.unionByName, [*leaves, left])), splits


def own_cells(axes: Sequence[str], side: float, splits: Sequence[DataFrame]) -> Column:
    """The cells of all levels that a place lies in; at most one of them is a leaf."""
    return F.explode(F.array(*[cell_at(axes, side, level) for level in range(len(splits) + 1)]))


def not_beyond(distance: Column) -> Column:
    """Whether a distance is within `_bound`, but for rounding."""
    return distance <= F.col("_bound") * (1 + 1e-9) + 1e-9


def descend(found: DataFrame, splits: Sequence[DataFrame], place: Sequence[str],
            reach: Callable[[Column], tuple[Column, Column]]) -> DataFrame:
    """From the coarse cells `_cell` beside each place to the leaves that can hold its nearest point.

    `_bound` is a distance within which the place is known to have a point that counts, infinite if
    none is known.  `reach` gives the least and the greatest distance between the place and the points of a
    cell; the least is NULL for cells that cannot count, the greatest for those that may
    hold no point that counts.  At each level dense cells are replaced by the cells in them, and those that
    begin beyond the bound or farther away than another one ends are left out; the former before
    the cells of a place are brought together.
    """
    same_place = Window.partitionBy(*place)

    def nearest_only(cells: DataFrame) -> DataFrame:
        low, high = reach(F.col("_cell"))
        near = cells.withColumns({"_low": low, "_high": high}).filter(F.col("_low").isNotNull() & not_beyond(F.col("_low")))
        bound = F.least("_bound", F.min("_high").over(same_place))
        return near.withColumn("_bound", bound).filter(not_beyond(F.col("_low"))).drop("_low", "_high")

    found = nearest_only(found)
    for split in splits:
        inner = found.join(split, F.col("_cell") == F.col("_parent"), "left")
        found = nearest_only(inner.withColumn("_cell", F.coalesce("_child", "_cell")).drop("_parent", "_child"))
    return found
