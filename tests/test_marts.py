"""Marts on literal frames: the rules that a reader of the reports relies on."""

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martloom.operators.nearest import city_rows
from martloom.plans import conversion, currency, dealership, geography, inventory, ledger, reports, restaurants, sales, star
from tests.helpers import frame, plan, rows

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
FACT = ("order_id int, product_id int, craftsman_id int, customer_id int, order_created_date date, "
        "order_completion_date date, order_status string, load_dttm timestamp_ntz")


def _people(spark, who, *data):
    schema = (f"{who}_id int, {who}_name string, {who}_address string, {who}_birthday date, {who}_email string, "
              "load_dttm timestamp_ntz")
    return frame(spark, schema, *data)


def _market(spark):
    born = dt.date(1980, 5, 1)
    customers = _people(spark, "customer", (1, "Ann", "A", born, "a@x", T0), (2, "Bob", "B", born, "b@x", T0))
    craftsmen = _people(spark, "craftsman", (1, "Cy", "C", born, "c@x", T0), (2, "Di", "D", dt.date(1990, 1, 1), "d@x", T0))
    products = frame(spark, "product_id int, product_name string, product_description string, product_type string, "
                     "product_price int, load_dttm timestamp_ntz",
                     (1, "p", "", "toys", 100, T0), (2, "q", "", "art", 50, T0))
    fact = frame(spark, FACT,
                 (1, 1, 1, 1, dt.date(2024, 1, 5), dt.date(2024, 1, 7), "done", T0),
                 (2, 2, 2, 1, dt.date(2024, 1, 6), None, "in progress", T0),
                 (3, 2, 2, 2, dt.date(2024, 2, 6), dt.date(2024, 2, 9), "done", T0))
    return fact, customers, craftsmen, products


def _changes(spark):
    born = dt.date(1980, 5, 1)
    fact, customers, craftsmen, products = _market(spark)
    more = frame(spark, FACT,
                 (4, 1, 1, 1, dt.date(2024, 3, 1), None, "created", T1),      # known customer, new month
                 (5, 1, 2, 3, dt.date(2024, 3, 2), None, "delivery", T1))     # new customer
    customers = _people(spark, "customer", (1, "Ann", "A", born, "a@x", T0), (2, "Bob", "moved", born, "b@x", T1),
                        (3, "Eve", "E", born, "e@x", T1))                     # a changed address only
    return fact.unionByName(more), customers, craftsmen, products


def test_customer_report_values(spark):
    got = reports.customer_report(*_market(spark), "2024-04-30").filter("customer_id = 1").first()
    assert got["customer_money"] == D("135.00") and got["platform_money"] == D("15.00")
    assert (got["count_order"], got["avg_price_order"], got["avg_age_craftsman"]) == (2, D("75.00"), D("38.50"))
    assert got["median_time_order_completed"] == 2.0
    assert (got["top_product_category"], got["top_craftsman_id"]) == ("art", 1)  # ties: by name, by id
    assert (got["count_order_done"], got["count_order_not_done"], got["count_order_in_progress"]) == (1, 1, 1)


@pytest.mark.parametrize("report,owner", [(reports.customer_report, "customer_id"), (reports.craftsman_report, "craftsman_id")])
def test_increment_equals_rebuild(spark, report, owner):
    mart = report(*_market(spark), "2024-04-30")
    refreshed = reports.refresh_report(mart, report, *_changes(spark), owner, T0, "2024-04-30")
    full = report(*_changes(spark), "2024-04-30")
    assert rows(refreshed.select(*sorted(full.columns))) == rows(full.select(*sorted(full.columns)))
    # A second refresh with the same watermark changes nothing.
    again = reports.refresh_report(refreshed, report, *_changes(spark), owner, T0, "2024-04-30")
    assert rows(again.select(*sorted(full.columns))) == rows(full.select(*sorted(full.columns)))


def test_new_month_of_a_known_customer_appears(spark):
    mart = reports.customer_report(*_market(spark), "2024-04-30")
    refreshed = reports.refresh_report(mart, reports.customer_report, *_changes(spark), "customer_id", T0, "2024-04-30")
    assert rows(refreshed.filter("customer_id = 1"), "report_period") == [("2024-01",), ("2024-03",)]
    assert rows(refreshed.filter("customer_id = 2"), "customer_address") == [("moved",)]


def test_open_orders_have_no_median_and_empty_delta_keeps_the_mark(spark):
    got = reports.customer_report(*_changes(spark), "2024-04-30").filter("customer_id = 3").first()
    assert got["median_time_order_completed"] is None
    assert reports.next_watermark(T1, *_changes(spark)) == T1
    assert reports.next_watermark(None, *_changes(spark)) == T1
    assert reports.changed_owners(*_changes(spark), "customer_id", T1).isEmpty()


def test_dimension_takes_the_newest_address(spark):
    wide = frame(spark, "customer_name string, customer_address string, load_dttm timestamp_ntz",
                 ("Ann", "old", T0), ("Ann", "new", T1), ("Bob", "x", T0))
    empty = star.dimension_rows(wide.limit(0), "customer_id", ["customer_name"], ["customer_address"], "load_dttm")
    dim = star.merge_dimension(empty, wide, "customer_id", ["customer_name"], ["customer_address"])
    assert rows(dim, "customer_name", "customer_address") == [("Ann", "new"), ("Bob", "x")]
    again = star.merge_dimension(dim, wide, "customer_id", ["customer_name"], ["customer_address"])
    assert rows(again) == rows(dim)
    found = star.fact_rows(wide.withColumn("order_id", F.lit(1)), {"customer_id": (dim, ["customer_name"])}, ["order_id"])
    assert found.count() == 3
    both = star.unify_sources([wide, wide.select("customer_name")])
    assert both.count() == 6 and both.filter("customer_address is null").count() == 3


def test_sales_fact_and_retention(spark):
    log = frame(spark, "uniq_id string, date_time timestamp_ntz, city_id int, customer_id int, item_id int, quantity int, "
                "payment_amount double, status string",
                ("a", dt.datetime(2024, 1, 9), 1, 1, 7, 1, 10.0, None), ("b", dt.datetime(2024, 1, 10), 1, 2, 7, 1, 20.0, "shipped"),
                ("c", dt.datetime(2024, 1, 11), 1, 2, 7, 1, 5.0, "shipped"), ("d", dt.datetime(2024, 1, 12), 1, 2, 7, 1, 5.0, "refunded"),
                ("e", dt.datetime(2024, 1, 15), 1, 1, 7, 1, 3.0, "shipped"))
    assert sales.append_increment(log, log).count() == 5
    fact = sales.sales_fact(log)
    assert rows(fact.filter("status = 'refunded'"), "payment_amount") == [(-5.0,)]
    assert rows(sales.sales_fact(log, "2024-01-09"), "status") == [("shipped",)]
    cols = ["period_id", "new_customers_count", "returning_customers_count", "refunded_customer_count", "new_customers_revenue",
            "returning_customers_revenue", "customers_refunded"]
    # Nine to fifteen January touches two ISO weeks: one row each.
    week2, week3 = rows(sales.retention(fact, "2024-01-15"), *cols)
    assert week2 == (2, 1, 1, 1, D("10.00"), D("25.00"), D("-5.00"))
    assert week3 == (3, 1, 0, 0, D("3.00"), D("0.00"), D("0.00"))
    known = frame(spark, "customer_id int", (1,))
    names = log.select("customer_id", F.lit("x").alias("first_name"), F.lit("y").alias("last_name"), "city_id")
    assert rows(sales.new_customers(known, names), "customer_id", "city_id") == [(2, 1)]
    cal = sales.calendar(spark, "2024-02-28", "2024-03-01")
    assert rows(cal, "date_id") == [(20240228,), (20240229,), (20240301,)]


def test_ledger(spark):
    at = dt.datetime(2024, 1, 5)
    deliveries = frame(spark, "delivery_id int, order_id string, courier_id int, order_ts timestamp_ntz, rate int, tip_sum int",
                       (1, "1", 1, at, 5, 10), (2, "2", 1, at, 4, None), (3, "9", 1, at, 4, 10), (4, "3", 2, at, None, None))
    couriers = frame(spark, "courier_id int, courier_name string", (1, "Al"), (2, "Bo"))
    totals = frame(spark, "order_id string, total_sum int", ("1", 1000), ("1", 500), ("2", 100), ("3", 10))
    al, bo = rows(ledger.ledger(deliveries, couriers, totals), "orders_count", "orders_total_sum", "rate_avg",
                  "order_processing_fee", "courier_order_sum", "courier_reward_sum")
    assert (bo[0], bo[2]) == (1, None) or (al[0], al[2]) == (1, None)
    al = al if al[0] == 3 else bo
    assert al == (3, D("1600.00"), D("4.33"), D("400.000"), D("150.0000"), D("169.0000"))
    per_order = ledger.ledger(deliveries, couriers, totals, per_order_floor=True).filter("courier_id = 1").first()
    assert per_order["courier_order_sum"] == D("450")  # three orders, floor 150 each
    fresh = ledger.ledger(deliveries, couriers, totals)
    assert rows(ledger.upsert_ledger(fresh, fresh)) == rows(fresh)


def test_ledger_counts_orders_without_maps_of_them(spark):
    """Repeated orders count once per courier and month, null ones never; no distinct aggregate."""
    at = lambda month: dt.datetime(2024, month, 5)
    deliveries = frame(spark, "delivery_id int, order_id string, courier_id int, order_ts timestamp_ntz, rate int, tip_sum int",
                       (1, "1", 1, at(1), 5, 10), (1, "1", 1, at(1), 5, 10), (2, "1", 1, at(2), 4, 1), (3, "1", 2, at(1), 4, 1),
                       (4, None, 1, at(1), 4, 10), (5, None, 1, at(1), 4, 10), (6, "2", 1, at(1), 3, None), (7, None, 2, at(3), 3, 1))
    couriers = frame(spark, "courier_id int, courier_name string", (1, "Al"), (2, "Bo"))
    totals = frame(spark, "order_id string, total_sum int", ("1", 1000), ("2", 100))
    got = ledger.ledger(deliveries, couriers, totals, per_order_floor=True)
    want = [(1, 1, 2, D("2100.00")), (1, 2, 1, D("1000.00")), (2, 1, 1, D("1000.00")), (2, 3, 0, D("0.00"))]
    assert rows(got, "courier_id", "settlement_month", "orders_count", "orders_total_sum") == want
    assert "distinct" not in plan(got)


def test_ledger_lines_stay_in_the_partitions_of_the_session(spark):
    """Merged partitions would give one task the lines of many; the rows do not depend on their number."""
    deliveries = frame(spark, "order_id string, courier_id int, order_ts timestamp_ntz, rate int, tip_sum int",
                       *[(None if i % 7 == 0 else str(i % 40), i % 3, dt.datetime(2024, 1 + i % 2, 5), i % 5 + 1, i) for i in range(120)])
    couriers = frame(spark, "courier_id int, courier_name string", (0, "Al"), (1, "Bo"), (2, "Cy"))
    totals = frame(spark, "order_id string, total_sum int", *[(str(i), 100 * i) for i in range(30)])
    default, answers = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            got = ledger.ledger(deliveries, couriers, totals, per_order_floor=True)
            assert re.search(rf"hashpartitioning\(order_id#\d+, {n}\), REPARTITION_BY_NUM", plan(got))
            answers.append(rows(got))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", default)
    assert answers[0] == answers[1] and len(answers[0]) == 6


def test_staged_objects_keep_the_first_version(spark):
    schema = "object_id string, object_value string, load_dttm timestamp_ntz"
    first = frame(spark, schema, ("1", '{"_id": "1", "name": "Al"}', T0))
    more = frame(spark, schema, ("1", '{"_id": "1", "name": "Alan"}', T1), ("2", '{"_id": "2", "name": "Bo"}', T1))
    assert rows(ledger.couriers_from(ledger.stage_objects(first, more))) == [("1", "Al"), ("2", "Bo")]
    assert rows(ledger.couriers_from(ledger.stage_objects(first, more, "latest"))) == [("1", "Alan"), ("2", "Bo")]
    delivery = '{"delivery_id": "d", "order_id": "o", "courier_id": "1", "delivery_ts": "2024-01-05 10:00:00", "rate": 5, "tip_sum": "x"}'
    got = ledger.deliveries_from(frame(spark, schema, ("d", delivery, T0))).first()
    assert (got["rate"], got["tip_sum"], got["order_ts"]) == (5, None, dt.datetime(2024, 1, 5, 10))


def test_group_conversion(spark):
    groups = frame(spark, "group_id int, hk_group_id string, registration_dt date",
                   *[(i, f"g{i:02}", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(11)])
    from martloom.functions.keys import hash_key

    groups = groups.withColumn("hk_group_id", hash_key(F.col("group_id")))
    users = spark.range(5).select(F.col("id").alias("user_id"), hash_key(F.col("id")).alias("hk_user_id"))
    log = frame(spark, "group_id int, user_id int, user_id_from int, event string, event_dt timestamp_ntz",
                (0, 1, None, "add", T0), (0, 2, None, "add", T0), (0, 3, None, "create", T0), (1, 1, None, "add", T0),
                (10, 1, None, "add", T0), (0, 99, None, "add", T0))
    load_dt = F.lit(T0)
    links = conversion.activity_links(log, users, groups, None, load_dt)
    assert links.count() == 5  # the unknown user is left out
    assert conversion.activity_links(log, users, groups, links, load_dt).isEmpty()
    history = conversion.auth_history(log, links)
    assert conversion.auth_history(log, links, history).isEmpty()
    added = conversion.added_users(history, links, groups, 10)
    assert sorted(r["cnt_added_users"] for r in added.collect()) == [1, 2]  # the eleventh group is out
    messages = frame(spark, "hk_message_id string, user int, grp int", ("m1", 1, 0), ("m2", 1, 0))
    writing = conversion.writing_users(
        messages.select("hk_message_id", hash_key(F.col("grp")).alias("hk_group_id")),
        messages.select("hk_message_id", hash_key(F.col("user")).alias("hk_user_id")))
    got = {r["cnt_added_users"]: r["group_conversion"] for r in conversion.group_conversion(added, writing).collect()}
    assert got == {2: 0.5, 1: 0.0}


def test_zone_months_add_up_weeks_and_registrations(spark):
    located = frame(spark, "event_id int, user_id int, event_time timestamp_ntz, event_type string, zone_id string",
                    (1, 1, dt.datetime(2024, 1, 2), "message", "a"), (2, 1, dt.datetime(2024, 1, 9), "message", "a"),
                    (3, 2, dt.datetime(2024, 1, 9), "subscription", "a"), (4, 2, dt.datetime(2024, 1, 9), "message", "a"))
    got = rows(geography.zone_activity(located), "week", "week_message", "month_message", "week_user", "month_user")
    assert [r[1:] for r in got] == [(1, 3, 1, 2), (2, 3, 1, 2)]


def test_user_geography(spark):
    sydney, perth = (-33.9, 151.2), (-31.9, 115.8)
    data = [(i, 1, dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=i), *sydney) for i in range(27)]
    data += [(100, 1, dt.datetime(2024, 1, 28, 12), *perth), (101, 1, None, *perth)]
    ev = frame(spark, "event_id int, user_id int, event_time timestamp_ntz, lat double, lon double", *data)
    got = geography.user_geography(ev, city_rows()).first()
    assert (got["current_city"], got["home_city"], got["travel_count"], got["cities_visited"]) == ("perth", "sydney", 1, 2)
    assert got["travel_array"] == ["perth", "sydney"]
    assert str(got["local_time"]) == "2024-01-28 20:00:00"


def test_friends(spark):
    km = 1 / 111.1949  # degrees of latitude
    base = -33.865
    people = {1: base, 2: base + 49 * km, 3: base - 51 * km, 4: base + 1.5, 5: base, 6: base}
    places = frame(spark, "event_id int, user_id int, event_time timestamp_ntz, lat double, lon double",
                   *[(i, u, T0, lat, 151.2094) for i, (u, lat) in enumerate(people.items())],
                   (99, 1, T0 - dt.timedelta(days=1), 0.0, 0.0))
    subs = frame(spark, "user_id int, channel_id int", *[(u, 1) for u in (1, 2, 3, 4, 5)], (6, 2), (1, 2), (1, 1))
    wrote = frame(spark, "a int, b int", (5, 1), (1, None))
    got = geography.friend_recommendations(subs, places, wrote, city_rows(), F.lit(T0))
    # 1-2 are 49 km apart, 1-3 are 51, 1-5 wrote, 4 has no city near, 6 shares channel 2 with 1 only.
    zones = {(r["user_left"], r["user_right"]) for r in got.collect()}
    assert (1, 6) in zones and (1, 3) not in zones and (1, 5) not in zones and not any(4 in z for z in zones)
    capped = geography.friend_recommendations(subs, places, wrote, city_rows(), F.lit(T0), max_channel=2)
    assert {(r["user_left"], r["user_right"]) for r in capped.collect()} == {(1, 6)}


def test_currency(spark):
    day = dt.datetime(2024, 1, 5, 10)
    tx = frame(spark, "transaction_dt timestamp_ntz, account_number_from int, currency_code int, status string, amount int",
               (day, 1, 430, "done", 100), (day, 1, 430, "done", 50), (day, 2, 430, "done", 10), (day, -1, 430, "done", 999),
               (day, 3, 430, "queued", 999), (dt.datetime(2024, 1, 6), 1, 430, "done", 5))
    quotes = frame(spark, "date_update timestamp_ntz, currency_code int, currency_code_with int, currency_with_div double",
                   (day, 430, 420, 1.5), (day, 430, 470, 9.0))
    got = rows(currency.daily_metrics(tx, quotes, 420))
    assert got == [(day.date(), 430, D("240.0000000"), 3, 1.5, 2)]
    assert currency.daily_metrics(tx, quotes, 420, "2024-01-06").isEmpty()
    with pytest.raises(Exception, match="repeated key"):
        currency.daily_metrics(tx, quotes.unionByName(quotes), 420).collect()


def test_dealership(spark):
    raw = frame(spark, "id int, auto string, gasoline_consumption double, price double, date date, person_name string, phone string, "
                "discount int, brand_origin string",
                (1, "Tesla Model 3, red", None, 100.0, dt.date(2022, 1, 1), "Ann", "+1 2", 0, "USA"),
                (2, "Hyundai Elantra, blue", 7.5, 75.0, dt.date(2022, 1, 2), "Bob", "+7 1", 25, "Korea"),
                (3, "Lada Vesta, red", 7.0, 10.0, dt.date(2021, 1, 2), "Ann", "+1 2", 100, None),
                (4, "Hyundai Elantra, red", None, 80.0, dt.date(2022, 2, 2), "Bobby", "+7 1", 20, "Korea"))
    raw = raw.withColumn("price", F.col("price").cast("decimal(9,2)")).withColumn("discount", F.col("discount").cast("decimal(5,2)"))
    e = dealership.normalise_sales(raw)
    assert {k: v.count() for k, v in e.items()} == {"countries": 2, "brands": 3, "models": 3, "colors": 2, "customers": 3, "sales": 4}
    assert rows(e["models"], "model_name", "gasoline_consumption") == [("Elantra", 7.5), ("Model 3", None), ("Vesta", 7.0)]
    assert float(dealership.missing_consumption(e["models"]).first()[0]) == 33.33
    years = rows(dealership.price_by_brand_year(e["sales"], e["models"], e["brands"]))
    assert [(b, y, float(p)) for b, y, p in years] == [("Hyundai", 2022, 60.13), ("Lada", 2021, 0.0), ("Tesla", 2022, 100.0)]
    assert [float(r[2]) for r in rows(dealership.price_by_month(e["sales"], 2022))] == [78.13, 64.0]
    cars = dealership.cars_of_person(e["sales"], e["customers"], e["models"], e["brands"])
    assert rows(cars) == [("Ann", "Lada Vesta, Tesla Model 3"), ("Bob", "Hyundai Elantra"), ("Bobby", "Hyundai Elantra")]
    spread = dealership.price_range_by_country(e["sales"], e["models"], e["brands"], e["countries"])
    assert [(c, float(a), float(b)) for c, a, b in rows(spread)] == [("Korea", 100.0, 100.0), ("USA", 100.0, 100.0)]
    assert dealership.persons_with_prefix(e["customers"]).first()[0] == 1


def test_restaurants(spark):
    raw = frame(spark, "report_date date, cafe_name string, type string, avg_check int, manager string, manager_phone string",
                (dt.date(2021, 1, 1), "Roma", "Пиццерия", 10, "Ann", "1"), (dt.date(2022, 1, 1), "Roma", "Пиццерия", 15, "Bob", "2"),
                (dt.date(2022, 5, 1), "Capo", "pizzeria", 30, "Ann", "1"), (dt.date(2022, 5, 1), "Moka", "кофейня", 5, None, None),
                (dt.date(2023, 5, 1), "Moka", "Кофейня", 7, None, None), (dt.date(2022, 5, 1), "Odd", "club", 1, None, None))
    menus = frame(spark, "cafe_name string, menu string",
                  ("Roma", '{"Пицца": {"A": 5, "B": 7}}'), ("Capo", '{"Пицца": {"C": 9, "D": 9}}'),
                  ("Moka", '{"Кофе": {"Капучино": 100, "Латте": 90}}'))
    places = restaurants.load_restaurants(raw, menus)
    assert rows(places, "name", "type") == [("Capo", "pizzeria"), ("Moka", "coffee_shop"), ("Odd", "restaurant"), ("Roma", "pizzeria")]
    assert rows(places.filter("name = 'Odd'"), "menu") == [("{}",)]
    assert rows(restaurants.largest_pizza_menus(places)) == [("Capo", 2), ("Roma", 2)]
    assert rows(restaurants.priciest_pizza(places)) == [("Capo", "C", 9), ("Roma", "B", 7)]
    dearer = restaurants.raise_price(places)
    prices = rows(dearer.filter("name = 'Moka'"), F.get_json_object("menu", "$.Кофе.Капучино"), F.get_json_object("menu", "$.Кофе.Латте"))
    assert [tuple(map(float, r)) for r in prices] == [(120.0, 90.0)]
    assert rows(dearer.filter("name <> 'Moka'")) == rows(places.filter("name <> 'Moka'"))
    checks = restaurants.load_sales(raw)
    assert [r[0] for r in rows(restaurants.best_by_type(checks, places, 1))] == ["Capo", "Moka", "Odd"]
    roma = rows(restaurants.check_dynamics(checks, places).filter("restaurant_name = 'Roma'"), "year", "change_percent")
    assert [(y, None if c is None else float(c)) for y, c in roma] == [(2021, None), (2022, 50.0)]
    work = restaurants.load_work_dates(raw)
    assert rows(restaurants.most_manager_changes(work, places, 1)) == [("Roma", 1)]
    phones = restaurants.evolve_phones(restaurants.load_managers(raw))
    assert rows(phones, "name", "phone_numbers") == [("Ann", ["8-800-2500-100", "1"]), ("Bob", ["8-800-2500-101", "2"])]


# --- car inventory ------------------------------------------------------------------

@pytest.fixture
def garage(spark):
    stock = {"hatch": ["available"] * 2, "van": ["reserve", "available", "available", "available"], "coupe": ["delivery"],
             "truck": ["available", "sold"]}
    ids = {name: 10 * (k + 1) for k, name in enumerate(stock)}
    cars = frame(spark, "vin string, model int, price int, date_start date, status string",
                 *[(f"{name}-{i}", ids[name], 500 * (i + 1), dt.date(2023, 9, 1 + i), status)
                   for name, all_ in stock.items() for i, status in enumerate(all_)])
    models = frame(spark, "id int, name string, brand string",
                   *[(ids[name], name, "North" if name in ("van", "truck") else "South") for name in stock])
    none = spark.createDataFrame([], "sales_number string, car_vin string, sales_date timestamp_ntz, cost int")
    return cars, models, none


def _sale(spark, *vins):
    return frame(spark, "sales_number string, car_vin string, sales_date timestamp_ntz, cost int",
                 *[(f"n/{v}", v, T0 + dt.timedelta(hours=6 * i), 700 + 5 * i) for i, v in enumerate(vins)])


def test_two_sales_one_taken_back(spark, garage):
    cars, models, sales_ = garage
    after, sold = inventory.sell(cars, sales_, _sale(spark, "van-1", "hatch-0"))
    assert rows(after.filter("status = 'sold'"), "vin") == [("hatch-0",), ("truck-1",), ("van-1",)] and sold.count() == 2
    info = inventory.car_info(after, models, sold)
    assert rows(info.filter("vin in ('van-1', 'van-2')"), "vin", "car_model_name", "sales_cost") == [
        ("van-1", "van", 700), ("van-2", "van", None)]
    back, left = inventory.revert(after, sold, frame(spark, "sales_number string", ("n/van-1",)))
    assert rows(back.filter("vin = 'van-1'"), "status") == [("available",)] and rows(left, "car_vin") == [("hatch-0",)]
    assert [inventory.list_cars(cars, s).count() for s in ("available", "reserve", "delivery", "sold", "lost")] == [6, 1, 1, 1, 0]
    assert inventory.add_cars(cars, cars.limit(2)).count() == 11


@pytest.mark.parametrize("step, message", [("sell", "VIN not found"), ("revert", "sale not found")])
def test_what_is_not_there_fails(spark, garage, step, message):
    cars, _, sales_ = garage
    rows_ = _sale(spark, "bus-0") if step == "sell" else frame(spark, "sales_number string", ("n/bus-0",))
    with pytest.raises(ValueError, match=message):
        getattr(inventory, step)(cars, sales_, rows_)


def test_new_number_follows_into_the_sales(spark, garage):
    cars, models, sales_ = garage
    cars, sales_ = inventory.sell(cars, sales_, _sale(spark, "coupe-0", "truck-0"))
    cars, sales_ = inventory.rename_vin(cars, sales_, frame(spark, "vin string, new_vin string", ("truck-0", "truck-x")))
    info = inventory.car_info(cars, models, sales_)
    assert rows(info.filter("sales_cost is not null"), "vin", "sales_cost") == [("coupe-0", 700), ("truck-x", 705)]
    assert info.filter("vin = 'truck-0'").isEmpty()


def test_models_by_sales_then_by_first_sale(spark, garage):
    cars, models, sales_ = garage
    _, sold = inventory.sell(cars, sales_, _sale(spark, "truck-0", "hatch-1", "van-2", "van-0", "hatch-0", "coupe-0"))
    assert sorted(rows(inventory.top_models(sold, cars, models), "sales_number", "car_model_name"), reverse=True) == [
        (2, "van"), (2, "hatch"), (1, "truck")]
