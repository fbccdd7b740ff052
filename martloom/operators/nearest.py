"""Nearest reference point for every row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import CITIES, chord_to_km, unit_vector, within_box
from .cells import cell_at, descend, not_beyond, own_cells, side_at, split_cells
from .windows import top_n

# A reference of up to this many points is written into the expression itself; much
# longer ones would not fit into one compiled method.
MAX_INLINE = 32
TOP_SIDE = 0.25  # of the coarsest cubes, on the unit sphere
# Larger than any squared distance on the unit sphere (at most 4).
_OUTSIDE = 9.0
REF_COLUMNS = ("zone_id", "lat", "lng", "timezone")


def city_rows(cities=CITIES) -> list[tuple[str, float, float, str]]:
    """(zone_id, lat, lng, timezone) of the reference cities, names lower-cased."""
    return [(city.lower().strip(), lat, lng, zone) for _, city, lat, lng, zone in cities]


def inline_reference(ref: DataFrame, limit: int = MAX_INLINE) -> list[tuple] | None:
    """The reference as plain rows, or None when it has more than `limit`.  At most
    limit + 1 rows reach the driver."""
    rows = ref.select(*REF_COLUMNS).distinct().orderBy(*REF_COLUMNS).limit(limit + 1).collect()
    return None if len(rows) > limit else [tuple(r) for r in rows]


def nearest(
    df: DataFrame,
    ref: DataFrame | Sequence[tuple],
    lat: str = "lat",
    lon: str = "lon",
    box_deg: float | None = None,
) -> DataFrame:
    """Adds zone_id, timezone and distance_km of the nearest reference point to every row.

    Rows with a NULL coordinate get NULLs, and repeated rows stay repeated.  With
    box_deg only points less than that many degrees away in both directions count, and
    rows without any, so those with a NULL coordinate, are dropped.  An empty reference is
    no point at all.  A small reference needs no join and no shuffle; for a large one each
    different place is looked up once through grid cells, which are split until few points
    share one, so that dense regions cost no more.  Both ways give the same rows.
    """
    rows = inline_reference(ref) if isinstance(ref, DataFrame) else list(ref)
    if rows:
        return _nearest_inline(df, rows, lat, lon, box_deg)
    if rows is not None:
        none = {"zone_id": F.lit(None).cast("string"), "timezone": F.lit(None).cast("string"),
                "distance_km": F.lit(None).cast("double")}
        return df.withColumns(none) if box_deg is None else df.withColumns(none).limit(0)
    places = df.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).dropna().distinct()
    found = _nearest_by_cells(places, ref) if box_deg is None else _nearest_in_box(places, ref, box_deg)
    same = (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon"))
    return df.join(found, same, "left" if box_deg is None else "inner").drop("_lat", "_lon")


def _chord2(ax: Column, ay: Column, az: Column, bx, by, bz) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by) + (az - bz) * (az - bz)


def _with_vector(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    x, y, z = unit_vector(F.col(lat), F.col(lon))
    return df.withColumns({f"{prefix}x": x, f"{prefix}y": y, f"{prefix}z": z})


def _nearest_inline(df: DataFrame, rows: Sequence[tuple], lat: str, lon: str, box_deg: float | None) -> DataFrame:
    # One SQL text instead of some hundred Column calls; Spark compiles it to plain
    # arithmetic on the row.
    entries = []
    for i, (_, rlat, rlng, _) in enumerate(rows):
        phi, lam = math.radians(rlat), math.radians(rlng)
        bx, by, bz = math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)
        d2 = " + ".join(f"(_{c} - {v!r}D) * (_{c} - {v!r}D)" for c, v in (("x", bx), ("y", by), ("z", bz)))
        if box_deg is not None:
            inside = f"abs(_lat - {rlat!r}D) < {box_deg!r}D AND abs(_lon - {rlng!r}D) < {box_deg!r}D"
            d2 = f"IF({inside}, {d2}, {_OUTSIDE!r}D)"
        entries.append(f"named_struct('d2', {d2}, 'i', {i})")
    best = _with_vector(df.withColumns({"_lat": F.col(lat), "_lon": F.col(lon)}), lat, lon, "_").withColumn(
        "_best", F.expr(f"array_min(array({', '.join(entries)}))")
    )
    if box_deg is not None:
        best = best.filter(F.col("_best")["d2"] < _OUTSIDE)
    names = F.array(*[F.lit(r[0]) for r in rows])
    zones = F.array(*[F.lit(r[3]) for r in rows])
    # get, not element_at: code for a null index into an array of constants does not compile.
    known = F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    at = F.when(known, F.col("_best")["i"])
    return best.withColumns({
        "zone_id": F.get(names, at),
        "timezone": F.get(zones, at),
        "distance_km": F.when(known, chord_to_km(F.col("_best")["d2"])),
    }).drop("_x", "_y", "_z", "_lat", "_lon", "_best")


def _met_points(found: DataFrame, leaves: DataFrame, counts: Column | None, how: str = "inner") -> DataFrame:
    """The places with the points that count in their cells, and the squared distances `_d2`."""
    d2 = _chord2(*[F.col(c) for c in ("_x", "_y", "_z", "_rx", "_ry", "_rz")])
    return found.join(leaves, "_cell", how).withColumn("_d2", d2 if counts is None else F.when(counts, d2))


def _with_bound(places: DataFrame, own: Column, leaves: DataFrame, counts: Column | None = None) -> DataFrame:
    """Adds the vector of each place and `_bound`, the distance to the nearest point that counts in
    the leaf it lies in.  It is close to the final distance, so few other cells are looked at."""
    met = _met_points(_with_vector(places, "_lat", "_lon", "_").withColumn("_cell", own), leaves, counts, "left")
    bound = F.coalesce(F.sqrt(F.min("_d2")), F.lit(float("inf")))
    return _with_vector(met.groupBy("_lat", "_lon").agg(bound.alias("_bound")), "_lat", "_lon", "_")


def _pick_closest(found: DataFrame, leaves: DataFrame, counts: Column | None = None) -> DataFrame:
    near = _met_points(found, leaves, counts).filter(F.col("_d2").isNotNull() & not_beyond(F.sqrt("_d2")))
    best = top_n(near, ["_lat", "_lon"], ["_d2", "zone_id", "_rlat", "_rlon", "timezone"], 1)
    return best.select("_lat", "_lon", "zone_id", "timezone", chord_to_km(F.col("_d2")).alias("distance_km"))


def _reference_vectors(ref: DataFrame) -> DataFrame:
    """Different places of the reference; of points at one place the first by zone_id and timezone."""
    places = ref.groupBy(F.col("lat").alias("_rlat"), F.col("lng").alias("_rlon")).agg(
        F.min(F.struct("zone_id", "timezone")).alias("_first")).filter("_rlat is not null and _rlon is not null")
    return _with_vector(places.select("_rlat", "_rlon", "_first.*"), "_rlat", "_rlon", "_r")


def _centre(cell: Column, axis: int, side: Column) -> Column:
    return (cell["at"][axis] + 0.5) * side


def _nearest_in_box(places: DataFrame, ref: DataFrame, deg: float) -> DataFrame:
    # Cells in degrees.  A cell counts if it meets the box, and bounds the distance if it
    # lies inside; on the sphere no point of it is farther from its centre than half
    # the diagonal in degrees.
    top = 2.0 ** math.ceil(math.log2(max(deg, 1e-6)))
    points = _reference_vectors(ref)
    tops = points.select(cell_at(["_rlat", "_rlon"], top, 0).alias("_cell")).distinct()
    leaves, splits = split_cells(points, ["_rlat", "_rlon"], top)

    def touched(axis: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(axis) - deg) / top), F.floor((F.col(axis) + deg) / top)))

    def reach(cell: Column) -> tuple[Column, Column]:
        side = side_at(top, cell["level"])
        lat, lon = _centre(cell, 0, side), _centre(cell, 1, side)
        away = F.greatest(F.abs(lat - F.col("_lat")), F.abs(lon - F.col("_lon")))
        chord = F.sqrt(_chord2(F.col("_x"), F.col("_y"), F.col("_z"), *unit_vector(lat, lon)))
        half = F.radians(side) * (math.sqrt(2) / 2)
        return (F.when(away <= deg + side / 2 + 1e-9, F.greatest(chord - half, F.lit(0.0))),
                F.when(away + side / 2 < deg - 1e-9, chord + half))

    inside = within_box(F.col("_lat"), F.col("_lon"), F.col("_rlat"), F.col("_rlon"), deg)
    bounded = _with_bound(places, own_cells(["_lat", "_lon"], top, splits), leaves, inside)
    found = (
        bounded.withColumn("_cy", touched("_lat")).withColumn("_cx", touched("_lon"))
        .withColumn("_cell", F.struct(F.lit(0).alias("level"), F.array("_cy", "_cx").alias("at"))).drop("_cy", "_cx")
        .join(tops, "_cell")
    )
    return _pick_closest(descend(found, splits, ["_lat", "_lon"], reach), leaves, inside)


def _nearest_by_cells(places: DataFrame, ref: DataFrame) -> DataFrame:
    # Cubes in space.  The unit sphere meets fewer than 6 * (2 / side)^2 cubes of level 0,
    # whatever the size of the reference, so every place looks at all that hold a point; below
    # them only at the cubes that begin nearer than another one ends.
    points = _reference_vectors(ref)
    tops = points.select(cell_at(["_rx", "_ry", "_rz"], TOP_SIDE, 0).alias("_cell")).agg(F.collect_set("_cell")).scalar()
    leaves, splits = split_cells(points, ["_rx", "_ry", "_rz"], TOP_SIDE)

    def reach(cell: Column) -> tuple[Column, Column]:
        side = side_at(TOP_SIDE, cell["level"])
        chord = F.sqrt(_chord2(F.col("_x"), F.col("_y"), F.col("_z"), *[_centre(cell, i, side) for i in range(3)]))
        half = side * (math.sqrt(3) / 2)
        return F.greatest(chord - half, F.lit(0.0)), chord + half

    found = (
        _with_bound(places, own_cells(["_x", "_y", "_z"], TOP_SIDE, splits), leaves)
        .withColumn("_all", tops)
        .withColumn("_tops", F.transform("_all", lambda c: F.struct(reach(c)[1].alias("high"), reach(c)[0].alias("low"), c.alias("cell"))))
        .withColumn("_bound", F.least("_bound", F.array_min("_tops")["high"]))
        .withColumn("_top", F.explode(F.filter("_tops", lambda t: not_beyond(t["low"]))))
        .withColumn("_cell", F.col("_top")["cell"])
        .drop("_all", "_tops", "_top")
    )
    return _pick_closest(descend(found, splits, ["_lat", "_lon"], reach), leaves)
