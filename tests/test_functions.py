import datetime as dt
from decimal import Decimal as D

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from martloom.functions import dates, documents, geo, keys, money, text
from tests.helpers import frame, rows


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()[0]


def test_text(spark):
    assert one(spark, text.part_of(F.lit("a b"), " ", 2)) == "b"
    assert one(spark, text.part_of(F.lit("a b"), " ", 3)) == ""
    assert one(spark, text.clean(F.lit("  New York "))) == "new york"
    words = {"бар": "bar", "bar": "bar"}
    assert one(spark, text.normalise(F.lit("Бар"), words, "restaurant")) == "bar"
    assert one(spark, text.normalise(F.lit("club"), words, "restaurant")) == "restaurant"


def test_iso_week_at_the_turn_of_the_year(spark):
    assert one(spark, dates.iso_week(F.lit("2024-12-30").cast("date"))) == 1


def test_age_counts_whole_years(spark):
    def birthday(s):
        return F.lit(s).cast("date")

    assert one(spark, dates.age_years(birthday("2000-06-15"), "2024-06-14")) == 23
    assert one(spark, dates.age_years(birthday("2000-06-15"), "2024-06-15")) == 24
    assert one(spark, dates.age_years(birthday("2000-02-29"), "2023-02-28")) == 22


def test_days_between_open_order_is_null(spark):
    assert one(spark, dates.days_between(F.lit("2024-01-01").cast("date"), F.lit(None).cast("date"))) is None
    assert one(spark, dates.days_between(F.lit("2024-01-31").cast("date"), F.lit("2024-02-02").cast("date"))) == 2


def test_trailing_week_includes_both_ends(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-20')) d").select(
        F.col("d").cast("timestamp_ntz").alias("ts"))
    kept = df.filter(dates.trailing_days(F.col("ts"), "2024-01-15", 7)).agg(F.min("ts"), F.max("ts"), F.count("*")).first()
    assert tuple(kept) == (dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 15), 7)


def test_int_dates_round_trip(spark):
    d = F.lit("2024-03-09").cast("date")
    assert one(spark, dates.date_to_int(d)) == 20240309
    assert one(spark, dates.int_to_date(F.lit(20240309))) == dt.date(2024, 3, 9)


def test_payout_tiers(spark):
    def pay(rate, total):
        return one(spark, money.tiered(F.lit(rate).cast("decimal(3,2)"), F.lit(total).cast("decimal(14,2)")))

    assert pay("3.99", "10000") == D("500")
    assert pay("3.99", "100") == D("100")
    assert pay("4.00", "10000") == D("700")
    assert pay("4.49", "1") == D("150")
    assert pay("4.50", "10000") == D("800")
    assert pay("4.89", "1") == D("175")
    assert pay("4.90", "10000") == D("1000")
    assert pay("4.90", "1") == D("200")
    assert pay(None, "100") is None


def test_prices(spark):
    price, full = F.lit("100").cast("decimal(9,2)"), F.lit("100").cast("decimal(5,2)")
    quarter = F.lit("25").cast("decimal(5,2)")
    assert one(spark, money.price_net(price, quarter)) == D("75")
    assert one(spark, money.price_net(price, F.lit(None).cast("decimal(5,2)"))) == D("100")
    assert one(spark, F.round(money.price_gross(F.lit("75").cast("decimal(9,2)"), quarter), 2)) == D("100")
    assert one(spark, money.price_gross(price, full)) is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.decimals(min_value=-10**10, max_value=10**10, places=2), min_size=1, max_size=30))
def test_sum_money_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(14,2)")
    assert df.agg(money.sum_money(F.col("v"))).first()[0] == sum(values)


def test_mean_rounds_half_up(spark):
    assert one(spark, money.mean_of(F.lit("10.01").cast("decimal(14,2)"), F.lit(2))) == D("5.01")
    assert one(spark, money.mean_of(F.lit("10.01").cast("decimal(14,2)"), F.lit(0))) is None


def test_json(spark):
    menu = F.lit('{"a": 1, "b": 10}')
    assert one(spark, documents.json_get(menu, "$.b", "int")) == 10
    assert one(spark, documents.json_get(F.lit('{"b": "x"}'), "$.b", "int")) is None
    assert one(spark, documents.has_key(menu, "a")) and not one(spark, documents.has_key(menu, "z"))
    assert one(spark, documents.has_key(F.lit("no json"), "a")) is False
    assert one(spark, documents.json_set(menu, "b", lambda v: v * 2, "int")) == '{"a":1,"b":20}'
    assert one(spark, documents.json_set(menu, "z", lambda v: v * 2, "int")) == '{"a": 1, "b": 10}'
    df = frame(spark, "id int, j string", (1, '{"a": 1, "b": 2}'), (2, "{}"))
    assert rows(documents.json_each(df, "j"), "id", "key", "value") == [(1, "a", "1"), (1, "b", "2")]


def test_hash_keys_keep_values_apart(spark):
    df = frame(spark, "a string, b string", ("x|y", "z"), ("x", "y|z"), (None, "x"), ("x", None), ("", "x"))
    assert df.select(keys.hash_key(F.col("a"), F.col("b")).alias("k")).distinct().count() == 5


def test_haversine_and_chord_agree(spark):
    df = frame(spark, "a double, b double, c double, d double",
               (-33.865, 151.2094, -37.8136, 144.9631), (0.0, 0.0, 0.0, 180.0), (10.0, 179.9, 10.0, -179.9))
    ax, ay, az = geo.unit_vector(F.col("a"), F.col("b"))
    bx, by, bz = geo.unit_vector(F.col("c"), F.col("d"))
    chord = geo.chord_to_km(F.pow(ax - bx, 2) + F.pow(ay - by, 2) + F.pow(az - bz, 2))
    gap = df.select(F.abs(chord - geo.haversine(*[F.col(c) for c in "abcd"])).alias("g")).agg(F.max("g")).first()[0]
    assert gap < 1e-3


def test_sum_money_neither_overflows_nor_rounds(spark):
    from decimal import Decimal
    big = Decimal("123456789012345.67")
    df = spark.createDataFrame([(big,)] * 3, "v decimal(17,2)")
    assert df.agg(money.sum_money(F.col("v"))).first()[0] == 3 * big
    many = spark.range(4).select(F.lit(Decimal("999999999999999.9999")).cast("decimal(19,4)").alias("v"))
    assert many.agg(money.sum_money(F.col("v"), 4)).first()[0] == 4 * Decimal("999999999999999.9999")
