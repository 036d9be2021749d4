"""Reports from days with sales alone, against the table with every day."""

import datetime
from collections import defaultdict

import pytest

from demandloom.operators import reports
from demandloom.plans.catalog import CATALOG

DAYS = [datetime.date(2021, 1, 1) + datetime.timedelta(d) for d in range(10)]
SOLD = [("A", "x", 0, 5), ("A", "x", 3, 2), ("A", "y", 9, 1), ("B", "x", 3, 7), ("B", "x", 4, 0), ("A", "x", 8, 4)]


@pytest.fixture(scope="module")
def tables(spark):
    observed = spark.createDataFrame([(s, i, DAYS[d], u) for s, i, d, u in SOLD], "store_id string, item_id string, date date, units long")
    calendar = spark.createDataFrame([(d, k // 4, d.year, d.month) for k, d in enumerate(DAYS)], "date date, wm_yr_wk int, year int, month int")
    prices = spark.createDataFrame([("A", "x", 0, 2.0), ("A", "x", 2, 3.0), ("B", "x", 0, 4.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    return observed, calendar, prices


def dense():
    units = {(s, i, d): u for s, i, d, u in SOLD}
    return [(s, i, d, units.get((s, i, d), 0)) for s, i in {(s, i) for s, i, _, _ in SOLD} for d in range(10)]


def test_zeros_are_counted_as_if_every_day_had_a_row(spark, tables):
    observed, calendar, _ = tables
    stores = spark.createDataFrame([("A", "s1"), ("B", "s2")], "store_id string, state_id string")
    found = {r["store_id"]: r for r in reports.sales_by_store(observed, calendar, stores).collect()}
    for store, row in found.items():
        own = [u for s, _, _, u in dense() if s == store]
        assert row["total_units_sold"] == sum(own) and row["zero_sales_records"] == own.count(0)
        assert row["average_units_per_product_day"] == round(sum(own) / len(own), 3)
        assert row["zero_sales_percentage"] == round(100 * own.count(0) / len(own), 2)
    coverage = reports.dataset_coverage(observed, calendar).first()
    assert tuple(coverage) == (2, 2, 10, len(dense()), sum(u for *_, u in dense()))
    month = reports.monthly_demand_trend(observed, calendar).first()
    assert (month["total_units_sold"], month["average_units_per_record"]) == (19, round(19 / 30, 3))


def test_prices_weigh_by_the_days_they_hold(tables):
    observed, calendar, prices = tables
    priced = reports.priced_weeks(observed, calendar, prices)
    price = {(s, i, w): p for s, i, w, p in map(tuple, prices.collect())}
    revenue, units, days = defaultdict(float), defaultdict(int), defaultdict(list)
    for s, i, d, u in dense():
        if (s, i, d // 4) in price:
            revenue[i] += u * price[s, i, d // 4]
            units[i] += u
            days[i].append(price[s, i, d // 4])
    found = reports.top_products_by_revenue(priced).collect()
    assert [tuple(r) for r in found] == [("x", revenue["x"], units["x"], round(sum(days["x"]) / len(days["x"]), 2))]


@pytest.mark.parametrize("name", ["dataset_coverage", "sales_by_store", "revenue_by_store", "top_products_by_demand",
                                  "top_products_by_revenue", "monthly_demand_trend", "demand_by_weekday", "price_data_coverage", "load_summary"])
def test_reports_never_build_the_empty_days(ws, name):
    assert "dense" not in CATALOG[name](ws)._jdf.queryExecution().toString()
