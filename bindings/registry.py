"""Registration of queries and the plain column types they are compared in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.geo import CITIES
from martloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF = "2024-01-01"


class Tables:
    """The tables of one scale folder, opened when first named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers as bigint, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(sql: str | None = None, name: str | None = None):
    """Register a function(Tables) -> DataFrame under its own name."""

    def wrap(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(tune(spark), folder)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return wrap


def sql_half_up(numerator: str, denominator: str, scale: int = 1) -> str:
    """numerator / denominator for whole numbers, rounded half away from zero, then
    divided by `scale`, as double."""
    n, d = f"({numerator})", f"({denominator})"
    return f"((sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))::DOUBLE / {scale})"


CITY_VALUES = ", ".join(
    f"({i}, '{name.lower()}', {lat}::DOUBLE, {lng}::DOUBLE, '{zone}')" for i, name, lat, lng, zone in CITIES
)
CITY_CTE = f"cities(id, zone_id, clat, clng, tz) AS (VALUES {CITY_VALUES})"


def sql_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371 * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


# Every event placed on the map by whole-number arithmetic.
PLACED_SQL = """placed AS (
  SELECT *, -(10 + ((event_id * 7919) % 34000) / 1000.0) AS lat, 113 + ((event_id * 104729) % 41000) / 1000.0 AS lon
  FROM events)"""


def placed(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "lat": -(F.lit(10) + (F.col("event_id") * 7919 % 34000) / 1000.0),
        "lon": F.lit(113) + (F.col("event_id") * 104729 % 41000) / 1000.0,
        "event_time": F.col("ts"),
    })


# Nearest city of every placed event.
LOCATED_SQL = f"""{CITY_CTE}, {PLACED_SQL}, located AS (
  SELECT * FROM (
    SELECT p.*, c.zone_id, c.tz, {sql_haversine('p.lat', 'p.lon', 'c.clat', 'c.clng')} AS km,
           row_number() OVER (PARTITION BY p.event_id ORDER BY
             {sql_haversine('p.lat', 'p.lon', 'c.clat', 'c.clng')}, c.id) AS rn
    FROM placed p CROSS JOIN cities c) WHERE rn = 1)"""
