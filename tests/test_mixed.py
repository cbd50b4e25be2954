"""The order-processing reports on tables small enough to work out by hand."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bidlens.plans import ads, mixed
from conftest import rows


def day(n):
    return dt.datetime(2010, 6, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    line = ("ol_o_id int, ol_w_id int, ol_d_id int, ol_number int, ol_i_id int, "
            "ol_supply_w_id int, ol_delivery_d timestamp, ol_quantity int, ol_amount decimal(12,2)")
    lines = [(1, 1, 1, 1, 11, 1, day(5), 2, Decimal("100.00")),
             (1, 1, 1, 2, 12, 1, day(5), 4, Decimal("150.00")),
             (1, 1, 1, 3, 11, 2, day(0), 6, Decimal("1.00")),
             (2, 1, 1, 1, 12, 1, None, 8, Decimal("30.00")),
             (2, 1, 1, 2, 11, 1, day(1), None, Decimal("7.00")),
             (3, 2, 1, 1, 13, 1, day(9), 10, Decimal("500.00"))]
    orders = [(1, 1, 1, 1, 1, 3, day(2)), (2, 1, 1, 1, None, 2, day(0)),
              (3, 2, 1, 1, 9, 1, day(3))]
    customer = [(1, 1, 1, "One", "Rome", "1-555", "CX", Decimal("10.00")),
                (1, 2, 1, "Uno", "Bonn", "2-555", "CY", Decimal("50.00")),
                (2, 1, 1, "Two", "Kyiv", "3-555", "DX", Decimal("90.00")),
                (3, 1, 1, "Tri", "Oslo", "9-555", "DX", Decimal("900.00"))]
    stock = [(w, i, 10 * w + i, w * i) for w in (1, 2) for i in (11, 12, 13)]
    supplier = [(k, f"S{k}", f"addr{k}", 67 if k % 2 else 68, f"tel{k}",
                 "bad" if k == 12 else "ok") for k in (11, 12, 13, 22, 24, 26)]
    return mixed.MixedTables(
        order_line=make(lines, line),
        orders=make(orders, "o_id int, o_w_id int, o_d_id int, o_c_id int, o_carrier_id int, "
                            "o_ol_cnt int, o_entry_d timestamp"),
        new_order=make([(3, 2, 1)], "no_o_id int, no_w_id int, no_d_id int"),
        customer=make(customer, "c_id int, c_w_id int, c_d_id int, c_last string, c_city string, "
                                "c_phone string, c_state string, c_balance decimal(12,2)"),
        stock=make(stock, "s_w_id int, s_i_id int, s_quantity int, s_order_cnt int"),
        item=make([(11, "nut", "PR nutb", 5.0), (12, "bolt", "co boltbb", 60.0),
                   (13, "zip", "zz zipb", 9.0)],
                  "i_id int, i_name string, i_data string, i_price double"),
        supplier=make(supplier, "su_suppkey int, su_name string, su_address string, "
                                "su_nationkey int, su_phone string, su_comment string"),
        nation=make([(67, "Cambodia", 1), (68, "Germany", 2)],
                    "n_nationkey int, n_name string, n_regionkey int"),
        region=make([(1, "Asia"), (2, "Europe")], "r_regionkey int, r_name string"))


def test_the_published_literals_are_the_defaults(tables):
    for number in range(1, 23):
        mixed.ch_query(tables, number).collect()


def test_pricing_skips_undelivered_lines(tables):
    got = mixed.pricing_summary(tables)
    assert rows(got, "ol_number", "sum_qty", "avg_qty", "count_order") == [
        (1, 12, 6.0, 2), (2, 4, 4.0, 2), (3, 6, 6.0, 1)]


def test_late_lines_and_late_orders_differ(tables):
    assert rows(mixed.late_orders(tables)) == [(1, 1), (2, 1), (3, 2)]
    assert rows(mixed.late_orders(tables, "orders")) == [(1, 1), (2, 1), (3, 1)]
    with pytest.raises(ValueError):
        mixed.late_orders(tables, "other")


def test_lowest_stock_is_taken_within_the_region(tables):
    got = mixed.lowest_stock_suppliers(tables, "Europ", "b")
    # Even supplier keys are German: 12 (item 12), 22 and 24 and 26 (warehouse 2).
    assert rows(got, "su_suppkey", "i_id") == [(12, 12), (22, 11), (26, 13)]


def test_missing_carrier_is_neither_high_nor_low(tables):
    assert rows(mixed.priority_lines(tables)) == [(1, 0, 1), (2, 0, 0), (3, 2, 0)]


def test_customers_without_orders_are_counted(tables):
    # By customer id: 1 has one such order (over both districts), 2 and 3 have none.
    assert rows(mixed.order_count_distribution(tables)) == [(0, 2), (1, 1)]


def test_small_orders_ignore_missing_quantities(tables):
    # Item 11: mean of 2 and 6 is 4, below it 100.00. Item 12: mean 6, below it 150.00.
    assert mixed.small_order_loss(tables).first()[0] == 125.0


def test_large_orders(tables):
    assert rows(mixed.large_orders(tables), "o_id", "amount_sum") == [
        (1, Decimal("251.00")), (3, Decimal("500.00"))]


def test_important_stock_forms_agree(tables):
    one = mixed.important_stock(tables, "Germany", "0.4")
    cut = mixed.stock_threshold(tables, "Germany", "0.4").first()[0]
    assert cut == Decimal("33.6")  # (12 + 22 + 24 + 26) * 0.4
    assert rows(one) == rows(mixed.important_stock(tables, "Germany", threshold=cut)) == [(12, 36)]


def test_greatest_revenue_may_be_shared_or_without_supplier(tables):
    assert rows(mixed.top_suppliers(tables), "su_suppkey", "total_revenue") == [
        (13, Decimal("500.00"))]
    without = mixed.MixedTables(**{**tables.__dict__,
                                   "supplier": tables.supplier.where("su_suppkey <> 13")})
    assert rows(mixed.top_suppliers(without)) == []


def test_bad_suppliers_are_left_out(tables):
    # Item 12 has suppliers 12 (bad) and 24; item 13 begins with zz.
    assert rows(mixed.item_supplier_counts(tables), "i_name", "supplier_cnt") == [
        ("bolt", 1), ("nut", 2)]


def test_waiting_suppliers_by_brute_force(tables):
    lines = [r for r in tables.order_line.collect()]
    orders = {(r.o_id, r.o_w_id, r.o_d_id): r for r in tables.orders.collect()}
    nations = {r.su_suppkey: r.su_nationkey for r in tables.supplier.collect()}
    want = {}
    for a in lines:
        key = (a.ol_o_id, a.ol_w_id, a.ol_d_id)
        supplier = (a.ol_w_id * a.ol_i_id) % 10000
        if a.ol_delivery_d is None or not a.ol_delivery_d > orders[key].o_entry_d:
            continue
        later = any(b.ol_delivery_d is not None and b.ol_delivery_d > a.ol_delivery_d
                    for b in lines if (b.ol_o_id, b.ol_w_id, b.ol_d_id) == key)
        if not later and nations.get(supplier) == 68:
            want[f"S{supplier}"] = want.get(f"S{supplier}", 0) + 1
    assert dict(rows(mixed.waiting_suppliers(tables))) == want == {"S12": 1, "S26": 1}


def test_rich_customers_without_orders(tables):
    # Mean of 10, 50 and 90 is 50; the phone of customer 3 begins with 9.
    assert rows(mixed.rich_without_orders(tables)) == [("D", 1, Decimal("90.00"))]
    assert rows(mixed.rich_without_orders(tables, balance_above=5.0)) == [
        ("D", 1, Decimal("90.00"))]


def test_empty_tables_give_nulls_not_errors(tables):
    none = mixed.MixedTables(**{**tables.__dict__, "order_line": tables.order_line.limit(0)})
    assert mixed.promotion_share(none).first()[0] is None
    assert rows(mixed.market_share(none)) == []


@pytest.mark.parametrize("number", [2, 5, 7, 8, 9, 11, 17, 20, 21])
def test_checked_dimensions_change_nothing(data, number):
    literals = {2: dict(region_prefix="EUROP", item_suffix="t"), 5: dict(region="EUROPE"),
                7: dict(first="NATION_1", second="NATION_2"), 9: dict(item_suffix="t"),
                8: dict(nation="NATION_1", region="EUROPE", item_suffix="t"),
                11: dict(nation="NATION_1"), 17: dict(item_suffix="t"),
                20: dict(nation="NATION_1", item_prefix="PR", delivered_after="1996-01-01"),
                21: dict(nation="NATION_1")}[number]
    assert rows(mixed.ch_query(data.mixed(check_dimensions=True), number, **literals)) == rows(
        mixed.ch_query(data.mixed(), number, **literals))


def test_filters_and_columns_reach_the_scan(data):
    plan = mixed.period_revenue(data.mixed(), since="1998-01-02")._jdf.queryExecution()
    scan = [s for s in plan.executedPlan().toString().split("\n")
            if "FileScan" in s and "l_shipdate" in s][0]
    assert "l_shipdate >= 1998-01-02" in scan.replace("#", " ").replace("  ", " ") or (
        "GreaterThanOrEqual(l_shipdate" in scan)
    assert "l_comment" not in scan and "l_tax" not in scan


def test_supplier_revenue_does_not_broadcast_orders(data):
    """Orders and their lines meet inside the view; Spark takes orders for the bytes of a compressed file."""
    plan = mixed.supplier_revenue(data.mixed())._jdf.queryExecution().executedPlan().toString()
    joins = [s for s in plan.split("\n") if "Join [" in s and "o_orderkey#" in s]
    assert joins and all("SortMergeJoin" in s for s in joins)


@pytest.mark.parametrize("number, other", [(5, "ol_i_id"), (7, "ol_i_id"), (8, "ol_i_id"), (9, "ol_i_id"),
                                           (15, "ol_i_id"), (16, "i_id"), (20, "ol_i_id"), (21, "ol_i_id")])
@pytest.mark.parametrize("checked", [False, True])
def test_stock_is_never_broadcast(data, number, other, checked):
    """Stock repeats each part per warehouse, which Spark's size rule does not see."""
    plan = mixed.ch_query(data.mixed(checked), number)._jdf.queryExecution().executedPlan().toString()
    joins = [s for s in plan.split("\n") if "Join [" in s and "s_i_id#" in s and f"{other}#" in s.replace(
        "s_i_id#", "")]
    assert joins and all("SortMergeJoin" in s for s in joins)


@pytest.mark.parametrize("number", [3, 4, 5, 7, 8, 9, 10, 12, 13, 15, 18, 21, 22])
@pytest.mark.parametrize("checked", [False, True])
def test_orders_lines_and_customers_are_never_broadcast(data, number, checked):
    """Spark takes them for the bytes of their compressed files, here far below its limit."""
    plan = mixed.ch_query(data.mixed(checked), number)._jdf.queryExecution().executedPlan().toString()
    keys = r"\b(o_id|ol_o_id|no_o_id|m_o_id|o_c_id|c_id|o_orderkey|l_orderkey)#"
    joins = [s for s in plan.split("\n") if "Join [" in s and re.search(keys, s)]
    assert joins and all("SortMergeJoin" in s for s in joins)


def test_reports_from_the_catalog(spark, tables):
    for name in mixed.TABLE_NAMES:
        getattr(tables, name).createOrReplaceTempView(name)
    assert rows(mixed.ch_query(mixed.MixedTables.from_catalog(spark), 6)) == rows(
        mixed.ch_query(tables, 6))
    for name in mixed.TABLE_NAMES:
        spark.catalog.dropTempView(name)


def test_uniques_overcount_but_people_do_not(spark):
    from bidlens.operators.rollup import PUB_GEO, aggregate_table, partial_state, window_of

    t0 = dt.datetime(2024, 1, 1)
    seen = spark.createDataFrame(
        [(t0 + dt.timedelta(hours=h), "publisher11", "NJ", 1.0, "c1") for h in range(3)],
        "time_stamp timestamp, publisher string, geo string, bid double, cookie string")
    assert rows(ads.uniques_by_geo(aggregate_table(seen, "1 hour"))) == [("NJ", 3)]
    states = partial_state(seen, [window_of("1 hour"), *PUB_GEO])
    assert rows(ads.people_by_geo(states)) == [("NJ", 1)]
    assert ads.count_by_geo(seen.where(F.lit(False))).count() == 0
