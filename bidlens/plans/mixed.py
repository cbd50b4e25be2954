"""The 22 reports on the order-processing tables.

Each report takes the tables and its literals as keyword arguments; the defaults
are the published ones. Four things are done throughout, and none changes a result:

* The key of the supplier behind an order line is a function of the line's own
  warehouse and item, equal to those of the stock row. It is computed on the line, so
  that supplier and nation filters cut the lines before the big stock join.
* Dimensions that only filter are semi joins. Spark then knows that the
  result is no larger than its left side, and can tell when it is small enough to
  broadcast; no side is broadcast by a hint here.
* Tables that grow with the warehouses (order lines, orders, new orders, customers and stock) are
  never broadcast to each other, whatever size Spark takes them for: it goes by the bytes of their
  compressed files and by the columns read, and knows nothing of rows that a view repeats.
* Lines are summed by their join key before they are joined where the report allows
  it, so a key that holds much of the data is reduced inside each task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidlens.functions import mean_of, nation_code, not_in, safe_ratio, supplier_key
from bidlens.operators.sizing import broadcast_within, never_broadcast
from bidlens.sources.workspace import materialize

# ---------------------------------------------------------------------------
# Default literals of the reports.
START = "2007-01-02 00:00:00"
LINES_FROM = "1999-01-01 00:00:00"
OPEN_END = "2020-01-01 00:00:00"
PROMO_END = "2020-01-02 00:00:00"
EXCESS_AFTER = "2010-05-23 12:00:00"
SUPPLIER_MODULUS = 10000
PHONE_DIGITS = ("1", "2", "3", "4", "5", "6", "7")
ITEM_CLASSES = (("a", (1, 2, 3)), ("b", (1, 2, 4)), ("c", (1, 5, 3)))
# ---------------------------------------------------------------------------

ORDER_KEY = {"ol_o_id": "o_id", "ol_w_id": "o_w_id", "ol_d_id": "o_d_id"}
NEW_ORDER_KEY = {"no_o_id": "o_id", "no_w_id": "o_w_id", "no_d_id": "o_d_id"}
CUSTOMER_KEY = {"o_c_id": "c_id", "o_w_id": "c_w_id", "o_d_id": "c_d_id"}


TABLE_NAMES = ("order_line", "orders", "new_order", "customer", "stock", "item",
               "supplier", "nation", "region")


@dataclass(frozen=True)
class MixedTables:
    """The nine tables, the modulus of the supplier key, and how to treat dimensions."""

    order_line: DataFrame
    orders: DataFrame
    new_order: DataFrame
    customer: DataFrame
    stock: DataFrame
    item: DataFrame
    supplier: DataFrame
    nation: DataFrame
    region: DataFrame
    supplier_modulus: int | Column = SUPPLIER_MODULUS
    check_dimensions: bool = False

    @classmethod
    def from_catalog(cls, spark: SparkSession, **settings) -> MixedTables:
        return cls(**{n: spark.table(n) for n in TABLE_NAMES}, **settings)

    def few(self, dimension: DataFrame) -> DataFrame:
        """A filtered dimension that is about to be joined with order lines.

        Spark broadcasts it by itself when its source files are small. Where they are
        not, it cannot know that the filter leaves little, and by the time it does
        the lines are already being shuffled. With ``check_dimensions`` the filtered
        rows are stored and counted first, and broadcast only if they are few.
        """
        if not self.check_dimensions:
            return dimension
        return broadcast_within(materialize(dimension))

    def stock_supplier(self) -> Column:
        return supplier_key("s_w_id", "s_i_id", self.supplier_modulus)

    def line_supplier(self, warehouse: str) -> Column:
        """Supplier key of an order line, served from the given warehouse column."""
        return supplier_key(warehouse, "ol_i_id", self.supplier_modulus)


def _equal(pairs: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in pairs.items()])


def _after(column: str, moment: str) -> Column:
    return F.col(column) > F.lit(moment)


def _since(column: str, moment: str) -> Column:
    return F.col(column) >= F.lit(moment)


def _before(column: str, moment: str) -> Column:
    return F.col(column) < F.lit(moment)


def _region_nations(t: MixedTables, test: Column) -> DataFrame:
    regions = t.region.where(test).select("r_regionkey")
    return t.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")


def _suppliers_of(t: MixedTables, nations: DataFrame) -> DataFrame:
    return t.supplier.join(nations, F.col("su_nationkey") == F.col("n_nationkey"), "left_semi")


def _with_stock(lines: DataFrame, stock: DataFrame, warehouse: str) -> DataFrame:
    """Inner join with stock on the line's item and the given warehouse column."""
    keys = never_broadcast(stock.select("s_w_id", "s_i_id"))
    return lines.join(keys, (F.col(warehouse) == F.col("s_w_id"))
                      & (F.col("ol_i_id") == F.col("s_i_id")))


def _sums_in_stock(lines: DataFrame, stock: DataFrame, warehouse: str, keys: list[Column],
                   **measures: Column) -> DataFrame:
    """Measures of lines in stock, as parts that the report sums up by its keys.

    Lines are first summed by the keys, warehouse and item, so that a hot item brings a few
    rows per task to the join instead of all its lines.
    """
    summed = lines.groupBy(*keys, warehouse, "ol_i_id").agg(
        *[c.alias(name) for name, c in measures.items()])
    return _with_stock(summed, stock, warehouse)


def pricing_summary(t: MixedTables, delivered_after: str = START) -> DataFrame:
    return (t.order_line.where(_after("ol_delivery_d", delivered_after))
            .groupBy("ol_number").agg(
                F.sum("ol_quantity").alias("sum_qty"), F.sum("ol_amount").alias("sum_amount"),
                mean_of("ol_quantity").alias("avg_qty"), mean_of("ol_amount").alias("avg_amount"),
                F.count(F.lit(1)).alias("count_order"))
            .orderBy("ol_number"))


def lowest_stock_suppliers(t: MixedTables, region_prefix: str = "Europ",
                           item_suffix: str = "b") -> DataFrame:
    nations = _region_nations(t, F.col("r_name").startswith(region_prefix))
    suppliers = t.few(t.supplier.join(nations, F.col("su_nationkey") == F.col("n_nationkey")))
    items = t.few(t.item.where(F.col("i_data").endswith(item_suffix)).select("i_id", "i_name"))
    # Only matching items need a minimum, so the filter on items comes first.
    held = (t.stock.select("s_i_id", "s_quantity", t.stock_supplier().alias("s_suppkey"))
            .join(suppliers.select("su_suppkey"), F.col("s_suppkey") == F.col("su_suppkey"),
                  "left_semi")
            .join(items, F.col("s_i_id") == F.col("i_id"), "left_semi"))
    lowest = held.groupBy(F.col("s_i_id").alias("m_i_id")).agg(
        F.min("s_quantity").alias("m_quantity"))
    return (held.join(lowest, (F.col("s_i_id") == F.col("m_i_id"))
                      & (F.col("s_quantity") == F.col("m_quantity")), "left_semi")
            .join(suppliers, F.col("s_suppkey") == F.col("su_suppkey"))
            .join(items, F.col("s_i_id") == F.col("i_id"))
            .select("su_suppkey", "su_name", "n_name", "i_id", "i_name",
                    "su_address", "su_phone", "su_comment")
            .orderBy("n_name", "su_name", "i_id"))


def undelivered_revenue(t: MixedTables, state_prefix: str = "A",
                        entered_after: str = START) -> DataFrame:
    buyers = t.customer.where(F.col("c_state").startswith(state_prefix)).select(
        "c_id", "c_w_id", "c_d_id")
    open_orders = (t.orders.where(_after("o_entry_d", entered_after))
                   .select("o_id", "o_w_id", "o_d_id", "o_c_id", "o_entry_d")
                   .join(never_broadcast(buyers), _equal(CUSTOMER_KEY))
                   .join(never_broadcast(t.new_order), _equal(NEW_ORDER_KEY)))
    per_order = (t.order_line.groupBy("ol_o_id", "ol_w_id", "ol_d_id")
                 .agg(F.sum("ol_amount").alias("amount")))
    return (per_order.join(never_broadcast(open_orders), _equal(ORDER_KEY))
            .groupBy("ol_o_id", "ol_w_id", "ol_d_id", "o_entry_d")
            .agg(F.sum("amount").alias("revenue"))
            .select("ol_o_id", "ol_w_id", "ol_d_id", "revenue", "o_entry_d")
            .orderBy(F.desc("revenue"), "o_entry_d", "ol_o_id", "ol_w_id", "ol_d_id"))


def late_orders(t: MixedTables, form: str = "lines") -> DataFrame:
    """``lines`` counts late order lines; ``orders`` counts orders with a late line.

    An order has a late line if its latest delivery is late, so the second form
    joins one row per order.
    """
    orders = t.orders.select("o_id", "o_w_id", "o_d_id", "o_ol_cnt", "o_entry_d")
    lines = t.order_line.select("ol_o_id", "ol_w_id", "ol_d_id", "ol_delivery_d")
    if form == "orders":
        lines = lines.groupBy("ol_o_id", "ol_w_id", "ol_d_id").agg(
            F.max("ol_delivery_d").alias("ol_delivery_d"))
    elif form != "lines":
        raise ValueError(f"unknown form: {form}")
    late = orders.join(
        never_broadcast(lines), _equal(ORDER_KEY) & (F.col("ol_delivery_d") >= F.col("o_entry_d")))
    return (late.groupBy("o_ol_cnt").agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy("o_ol_cnt"))


def regional_revenue(t: MixedTables, region: str = "Europe",
                     entered_since: str = START) -> DataFrame:
    nations = _region_nations(t, F.col("r_name") == region).select("n_nationkey", "n_name")
    suppliers = t.few(t.supplier.join(
        nations, F.col("su_nationkey") == F.col("n_nationkey")).select(
        "su_suppkey", "su_nationkey", "n_name"))
    buyers = (t.customer.select("c_id", "c_w_id", "c_d_id",
                                nation_code("c_state").alias("c_nation"))
              .join(nations, F.col("c_nation") == F.col("n_nationkey"), "left_semi"))
    orders = (t.orders.where(_since("o_entry_d", entered_since))
              .select("o_id", "o_w_id", "o_d_id", "o_c_id")
              .join(never_broadcast(buyers), _equal(CUSTOMER_KEY)))
    lines = t.order_line.select("ol_o_id", "ol_w_id", "ol_d_id", "ol_i_id", "ol_amount",
                                t.line_supplier("ol_w_id").alias("ol_suppkey"))
    sold = (lines.join(suppliers, F.col("ol_suppkey") == F.col("su_suppkey"))
            .join(never_broadcast(orders), _equal(ORDER_KEY) & (F.col("c_nation") == F.col("su_nationkey"))))
    return (_sums_in_stock(sold, t.stock, "ol_w_id", [F.col("n_name")], amount=F.sum("ol_amount"))
            .groupBy("n_name").agg(F.sum("amount").alias("revenue")).orderBy(F.desc("revenue"), "n_name"))


def period_revenue(t: MixedTables, since: str = LINES_FROM, before: str = OPEN_END,
                   min_quantity: int = 1, max_quantity: int = 100000) -> DataFrame:
    return (t.order_line.where(_since("ol_delivery_d", since) & _before("ol_delivery_d", before)
                               & F.col("ol_quantity").between(min_quantity, max_quantity))
            .agg(F.sum("ol_amount").alias("revenue")))


def nation_pair_revenue(t: MixedTables, first: str = "Germany",
                        second: str = "Cambodia") -> DataFrame:
    pair = t.nation.where(F.col("n_name").isin(first, second))
    n1, n2 = pair.alias("n1"), pair.alias("n2")
    suppliers = t.few(
        t.supplier.join(n1, F.col("su_nationkey") == F.col("n1.n_nationkey")).select(
            "su_suppkey", "su_nationkey", F.col("n1.n_name").alias("supp_name")))
    buyers = (t.customer.select("c_id", "c_w_id", "c_d_id",
                                nation_code("c_state").alias("c_nation"))
              .join(n2, F.col("c_nation") == F.col("n2.n_nationkey"))
              .select("c_id", "c_w_id", "c_d_id", "c_nation",
                      F.col("n2.n_name").alias("cust_name")))
    orders = t.orders.select("o_id", "o_w_id", "o_d_id", "o_c_id", "o_entry_d").join(
        never_broadcast(buyers), _equal(CUSTOMER_KEY))
    lines = t.order_line.select("ol_o_id", "ol_w_id", "ol_d_id", "ol_i_id", "ol_supply_w_id",
                                "ol_amount", t.line_supplier("ol_supply_w_id").alias("ol_suppkey"))
    crossed = (((F.col("supp_name") == first) & (F.col("cust_name") == second))
               | ((F.col("supp_name") == second) & (F.col("cust_name") == first)))
    sold = (lines.join(suppliers, F.col("ol_suppkey") == F.col("su_suppkey"))
            .join(never_broadcast(orders), _equal(ORDER_KEY) & crossed))
    keys = [F.col("su_nationkey").alias("supp_nation"), F.col("c_nation").alias("cust_nation"),
            F.year("o_entry_d").alias("l_year")]
    return (_sums_in_stock(sold, t.stock, "ol_supply_w_id", keys, amount=F.sum("ol_amount"))
            .groupBy("supp_nation", "cust_nation", "l_year").agg(F.sum("amount").alias("revenue"))
            .orderBy("supp_nation", "cust_nation", "l_year"))


def market_share(t: MixedTables, nation: str = "Germany", region: str = "Europe",
                 items_below: int = 1000, item_suffix: str = "b") -> DataFrame:
    home = _region_nations(t, F.col("r_name") == region)
    buyers = (t.customer.select("c_id", "c_w_id", "c_d_id",
                                nation_code("c_state").alias("c_nation"))
              .join(home, F.col("c_nation") == F.col("n_nationkey"))
              .select("c_id", "c_w_id", "c_d_id"))
    orders = t.orders.select("o_id", "o_w_id", "o_d_id", "o_c_id", "o_entry_d").join(
        never_broadcast(buyers), _equal(CUSTOMER_KEY))
    items = t.few(t.item.where((F.col("i_id") < items_below)
                               & F.col("i_data").endswith(item_suffix)).select("i_id"))
    suppliers = t.few(t.supplier.join(
        t.nation, F.col("su_nationkey") == F.col("n_nationkey")).select("su_suppkey", "n_name"))
    lines = (t.order_line.where(F.col("ol_i_id") < items_below)
             .select("ol_o_id", "ol_w_id", "ol_d_id", "ol_i_id", "ol_supply_w_id", "ol_amount",
                     t.line_supplier("ol_supply_w_id").alias("ol_suppkey"))
             .join(items, F.col("ol_i_id") == F.col("i_id"))
             .join(suppliers, F.col("ol_suppkey") == F.col("su_suppkey"))
             .join(never_broadcast(orders), _equal(ORDER_KEY)))
    mine = F.sum(F.when(F.col("n_name") == nation, F.col("ol_amount")).otherwise(F.lit(0)))
    return (_sums_in_stock(lines, t.stock, "ol_supply_w_id", [F.year("o_entry_d").alias("l_year")],
                           mine=mine, amount=F.sum("ol_amount"))
            .groupBy("l_year")
            .agg(safe_ratio(F.sum("mine"), F.sum("amount")).alias("mkt_share")).orderBy("l_year"))


def product_profit(t: MixedTables, item_suffix: str = "bb") -> DataFrame:
    items = t.few(t.item.where(F.col("i_data").endswith(item_suffix)).select("i_id"))
    suppliers = t.few(t.supplier.join(
        t.nation, F.col("su_nationkey") == F.col("n_nationkey")).select("su_suppkey", "n_name"))
    lines = (t.order_line.select(
                "ol_o_id", "ol_w_id", "ol_d_id", "ol_i_id", "ol_supply_w_id", "ol_amount",
                t.line_supplier("ol_supply_w_id").alias("ol_suppkey"))
             .join(items, F.col("ol_i_id") == F.col("i_id"))
             .join(suppliers, F.col("ol_suppkey") == F.col("su_suppkey")))
    orders = never_broadcast(t.orders.select("o_id", "o_w_id", "o_d_id", "o_entry_d"))
    return (_sums_in_stock(lines.join(orders, _equal(ORDER_KEY)), t.stock, "ol_supply_w_id",
                           [F.col("n_name"), F.year("o_entry_d").alias("l_year")],
                           amount=F.sum("ol_amount"))
            .groupBy("n_name", "l_year").agg(F.sum("amount").alias("sum_profit"))
            .orderBy("n_name", F.desc("l_year")))


def customer_revenue(t: MixedTables, entered_since: str = START) -> DataFrame:
    buyers = (t.customer.join(t.nation, nation_code("c_state") == F.col("n_nationkey"))
              .select("c_id", "c_w_id", "c_d_id", "c_last", "c_city", "c_phone", "n_name"))
    orders = t.orders.where(_since("o_entry_d", entered_since)).select(
        "o_id", "o_w_id", "o_d_id", "o_c_id", "o_entry_d")
    lines = t.order_line.where(_since("ol_delivery_d", entered_since)).select(
        "ol_o_id", "ol_w_id", "ol_d_id", "ol_delivery_d", "ol_amount")
    # Sum to one row per customer key before the wide customer columns are joined.
    spent = (lines.join(never_broadcast(orders), _equal(ORDER_KEY)
                        & (F.col("o_entry_d") <= F.col("ol_delivery_d")))
             .groupBy("o_c_id", "o_w_id", "o_d_id").agg(F.sum("ol_amount").alias("spent")))
    return (spent.join(never_broadcast(buyers), _equal(CUSTOMER_KEY))
            .groupBy("c_id", "c_last", "c_city", "c_phone", "n_name")
            .agg(F.sum("spent").alias("revenue"))
            .select("c_id", "c_last", "revenue", "c_city", "c_phone", "n_name")
            .orderBy(F.desc("revenue"), "c_id"))


def _nation_stock(t: MixedTables, nation: str, trimmed: bool = False) -> DataFrame:
    name = F.trim("n_name") if trimmed else F.col("n_name")
    suppliers = t.few(_suppliers_of(t, t.nation.where(name == nation)).select("su_suppkey"))
    return (t.stock.select("s_i_id", "s_order_cnt", t.stock_supplier().alias("s_suppkey"))
            .join(suppliers, F.col("s_suppkey") == F.col("su_suppkey")))


def _fraction_of(column: str, fraction: str) -> Column:
    return F.sum(column).cast("decimal(20,0)") * F.lit(fraction).cast("decimal(10,6)")


def stock_threshold(t: MixedTables, nation: str = "Germany",
                    fraction: str = "0.005") -> DataFrame:
    """The cut-off of ``important_stock`` alone, as one decimal."""
    return _nation_stock(t, nation, trimmed=True).agg(
        _fraction_of("s_order_cnt", fraction).alias("threshold"))


def important_stock(t: MixedTables, nation: str = "Germany", fraction: str = "0.005",
                    threshold: Column | str | None = None) -> DataFrame:
    """Items that carry more than a fraction of the nation's stock orders.

    By default one statement; ``threshold`` supplies the cut-off from outside.
    """
    sums = (_nation_stock(t, nation).groupBy("s_i_id")
            .agg(F.sum("s_order_cnt").alias("ordercount")))
    if threshold is None:
        # The total of the sums, so that both sides share one shuffle.
        limit = sums.agg(_fraction_of("ordercount", fraction)).scalar()
    else:
        limit = F.lit(threshold).cast("decimal(38,6)")
    return (sums.where(F.col("ordercount").cast("decimal(20,0)") > limit)
            .orderBy(F.desc("ordercount"), "s_i_id"))


def priority_lines(t: MixedTables, delivered_before: str = OPEN_END) -> DataFrame:
    carrier = F.col("o_carrier_id")
    high = F.when((carrier == 1) | (carrier == 2), 1).otherwise(0)
    low = F.when((carrier != 1) & (carrier != 2), 1).otherwise(0)
    orders = t.orders.where(_before("o_entry_d", delivered_before)).select(
        "o_id", "o_w_id", "o_d_id", "o_ol_cnt", "o_entry_d", "o_carrier_id")
    lines = t.order_line.where(_before("ol_delivery_d", delivered_before)).select(
        "ol_o_id", "ol_w_id", "ol_d_id", "ol_delivery_d")
    return (lines.join(never_broadcast(orders), _equal(ORDER_KEY)
                       & (F.col("o_entry_d") <= F.col("ol_delivery_d")))
            .groupBy("o_ol_cnt").agg(F.sum(high).alias("high_line_count"),
                                     F.sum(low).alias("low_line_count"))
            .orderBy("o_ol_cnt"))


def order_count_distribution(t: MixedTables, carrier_above: int = 8) -> DataFrame:
    # Orders are counted per customer key first; the outer join then meets one row each.
    counted = (t.orders.where(F.col("o_carrier_id") > carrier_above)
               .groupBy("o_c_id", "o_w_id", "o_d_id").agg(F.count("o_id").alias("n")))
    per_customer = (t.customer.select("c_id", "c_w_id", "c_d_id")
                    .join(never_broadcast(counted), _equal(CUSTOMER_KEY), "left")
                    .groupBy("c_id").agg(F.sum(F.coalesce("n", F.lit(0))).alias("c_count")))
    return (per_customer.groupBy("c_count").agg(F.count(F.lit(1)).alias("custdist"))
            .orderBy(F.desc("custdist"), F.desc("c_count")))


def promotion_share(t: MixedTables, item_prefix: str = "PR", since: str = START,
                    before: str | None = PROMO_END) -> DataFrame:
    lines = t.order_line.where(_since("ol_delivery_d", since))
    if before is not None:
        lines = lines.where(_before("ol_delivery_d", before))
    per_item = lines.groupBy("ol_i_id").agg(F.sum("ol_amount").alias("amount"))
    promo = F.when(F.col("i_data").startswith(item_prefix), F.col("amount")).otherwise(F.lit(0))
    joined = per_item.join(t.item.select("i_id", "i_data"), F.col("ol_i_id") == F.col("i_id"))
    return joined.agg(safe_ratio(100 * F.sum(promo), 1 + F.sum("amount")).alias("promo_revenue"))


def supplier_revenue(t: MixedTables, since: str = START) -> DataFrame:
    """Revenue per supplier key; the view that ``top_suppliers`` reads."""
    per_stock = (t.order_line.where(_since("ol_delivery_d", since))
                 .groupBy("ol_supply_w_id", "ol_i_id").agg(F.sum("ol_amount").alias("amount")))
    return (_with_stock(per_stock, t.stock, "ol_supply_w_id")
            .groupBy(t.stock_supplier().alias("supplier_no"))
            .agg(F.sum("amount").alias("total_revenue")))


def top_suppliers(t: MixedTables, since: str = START,
                  revenue: DataFrame | None = None) -> DataFrame:
    """Suppliers whose revenue is the greatest, compared exactly as decimals.

    Only revenues of real suppliers are shown, but the greatest is over all keys.
    """
    revenue = supplier_revenue(t, since) if revenue is None else revenue
    best = revenue.agg(F.max("total_revenue")).scalar()
    return (revenue.where(F.col("total_revenue") == best)
            .join(t.supplier, F.col("supplier_no") == F.col("su_suppkey"))
            .select("su_suppkey", "su_name", "su_address", "su_phone", "total_revenue")
            .orderBy("su_suppkey"))


def item_supplier_counts(t: MixedTables, not_prefix: str = "zz",
                         bad_word: str = "bad") -> DataFrame:
    items = t.item.where(~F.col("i_data").startswith(not_prefix)).select(
        "i_id", "i_name", F.substring("i_data", 1, 3).alias("brand"), "i_price")
    stock = t.stock.select("s_i_id", t.stock_supplier().alias("s_suppkey"))
    bad = t.supplier.where(F.col("su_comment").contains(bad_word))
    good = not_in(stock, stock["s_suppkey"], bad, "su_suppkey")
    return (never_broadcast(good).join(items, F.col("s_i_id") == F.col("i_id"))
            .groupBy("i_name", "brand", "i_price")
            .agg(F.count_distinct("s_suppkey").alias("supplier_cnt"))
            .orderBy(F.desc("supplier_cnt"), "i_name", "brand", "i_price"))


def small_order_loss(t: MixedTables, item_suffix: str = "b") -> DataFrame:
    """Half the revenue of the lines with less than their item's mean quantity.

    Lines are first summed per item and quantity, in one scan and with a partial sum in
    each task; means and the comparison then work on those few rows.
    """
    items = t.few(t.item.where(F.col("i_data").endswith(item_suffix)).select("i_id"))
    by_quantity = (t.order_line.groupBy("ol_i_id", "ol_quantity")
                   .agg(F.count("ol_quantity").alias("n"), F.sum("ol_amount").alias("amount"))
                   .join(items, F.col("ol_i_id") == F.col("i_id"), "left_semi"))
    item = Window.partitionBy("ol_i_id")
    mean = F.try_divide(
        F.sum(F.col("ol_quantity") * F.col("n")).over(item).cast("double"),
        F.sum("n").over(item).cast("double"))
    small = by_quantity.withColumn("mean_quantity", mean).where(
        F.col("ol_quantity") < F.col("mean_quantity"))
    return small.agg((F.sum("amount").cast("double") / 2.0).alias("avg_yearly"))


def large_orders(t: MixedTables, amount_above: int = 200) -> DataFrame:
    per_order = (t.order_line.groupBy("ol_o_id", "ol_w_id", "ol_d_id")
                 .agg(F.sum("ol_amount").alias("amount")))
    orders = t.orders.select("o_id", "o_w_id", "o_d_id", "o_c_id", "o_entry_d", "o_ol_cnt")
    buyers = t.customer.select("c_id", "c_w_id", "c_d_id", "c_last")
    return (per_order.join(never_broadcast(orders), _equal(ORDER_KEY))
            .join(never_broadcast(buyers), _equal(CUSTOMER_KEY))
            .groupBy("o_id", "o_w_id", "o_d_id", "c_id", "c_last", "o_entry_d", "o_ol_cnt")
            .agg(F.sum("amount").alias("amount_sum"))
            .where(F.col("amount_sum") > amount_above)
            .select("c_last", "c_id", "o_id", "o_entry_d", "o_ol_cnt", "amount_sum")
            .orderBy(F.desc("amount_sum"), "o_entry_d", "o_id"))


def class_revenue(t: MixedTables, classes: tuple = ITEM_CLASSES, min_quantity: int = 1,
                  max_quantity: int = 10, min_price: int = 1,
                  max_price: int = 400000) -> DataFrame:
    """Revenue of lines in any of the (item suffix, warehouses) classes."""
    suffixes = [F.col("i_data").endswith(s) for s, _ in classes]
    warehouses = sorted({w for _, ws in classes for w in ws})
    items = t.item.where(F.col("i_price").between(min_price, max_price)
                         & reduce(lambda a, b: a | b, suffixes)).select("i_id", "i_data")
    sums = (t.order_line.where(F.col("ol_quantity").between(min_quantity, max_quantity)
                               & F.col("ol_w_id").isin(warehouses))
            .groupBy("ol_i_id", "ol_w_id").agg(F.sum("ol_amount").alias("amount")))
    fits = reduce(lambda a, b: a | b, [F.col("i_data").endswith(s) & F.col("ol_w_id").isin(*ws)
                                       for s, ws in classes])
    return (sums.join(items, (F.col("ol_i_id") == F.col("i_id")) & fits)
            .agg(F.sum("amount").alias("revenue")))


def excess_suppliers(t: MixedTables, nation: str = "Germany", item_prefix: str = "co",
                     delivered_after: str = EXCESS_AFTER) -> DataFrame:
    items = t.few(t.item.where(F.col("i_data").startswith(item_prefix)).select("i_id"))
    sold = (t.order_line.where(_after("ol_delivery_d", delivered_after))
            .groupBy("ol_i_id").agg(F.sum("ol_quantity").alias("sold")))
    idle = (never_broadcast(t.stock.join(items, F.col("s_i_id") == F.col("i_id")))
            .join(sold, F.col("s_i_id") == F.col("ol_i_id"))
            .groupBy("s_i_id", "s_w_id", "s_quantity").agg(F.sum("sold").alias("sold"))
            .where(2 * F.col("s_quantity") > F.col("sold"))
            .select(t.stock_supplier().alias("idle_suppkey")))
    local = _suppliers_of(t, t.nation.where(F.col("n_name") == nation))
    return (local.join(idle, F.col("su_suppkey") == F.col("idle_suppkey"), "left_semi")
            .select("su_name", "su_address").orderBy("su_name", "su_address"))


def waiting_suppliers(t: MixedTables, nation: str = "Germany") -> DataFrame:
    """Suppliers whose line was the last of its order to arrive, after entry.

    "No later line in the order" is tested against the order's latest delivery,
    which is one aggregate instead of a self join over all pairs of lines. The test
    is an inequality so that the join is on the order alone: aggregate, join
    and the join with orders then share one partitioning.
    """
    local = t.few(_suppliers_of(t, t.nation.where(F.col("n_name") == nation)).select(
        "su_suppkey", "su_name"))
    lines = t.order_line.select("ol_o_id", "ol_w_id", "ol_d_id", "ol_i_id", "ol_delivery_d",
                                t.line_supplier("ol_w_id").alias("ol_suppkey"))
    ours = lines.join(local, F.col("ol_suppkey") == F.col("su_suppkey"))
    latest = t.order_line.groupBy(
        F.col("ol_o_id").alias("m_o_id"), F.col("ol_w_id").alias("m_w_id"),
        F.col("ol_d_id").alias("m_d_id")).agg(F.max("ol_delivery_d").alias("last_delivery"))
    last = (ours.join(never_broadcast(latest), _equal({"ol_o_id": "m_o_id", "ol_w_id": "m_w_id",
                                                       "ol_d_id": "m_d_id"})
                      & (F.col("ol_delivery_d") >= F.col("last_delivery"))))
    orders = t.orders.select("o_id", "o_w_id", "o_d_id", "o_entry_d")
    waited = last.join(never_broadcast(orders), _equal(ORDER_KEY)
                       & (F.col("ol_delivery_d") > F.col("o_entry_d")))
    return (_sums_in_stock(waited, t.stock, "ol_w_id", [F.col("su_name")], n=F.count(F.lit(1)))
            .groupBy("su_name").agg(F.sum("n").alias("numwait"))
            .orderBy(F.desc("numwait"), "su_name"))


def mean_balance(t: MixedTables, phone_digits: tuple = PHONE_DIGITS) -> DataFrame:
    """Mean positive balance of the customers in question, as one number."""
    return (t.customer.where((F.col("c_balance") > 0)
                             & F.substring("c_phone", 1, 1).isin(*phone_digits))
            .agg(mean_of("c_balance").alias("mean_balance")))


def rich_without_orders(t: MixedTables, phone_digits: tuple = PHONE_DIGITS,
                        orders: DataFrame | None = None,
                        balance_above: float | None = None) -> DataFrame:
    """Customers above the mean balance who have no order, by state letter.

    ``orders`` narrows what counts as an order; ``balance_above`` supplies the
    mean from outside.
    """
    limit = (mean_balance(t, phone_digits).scalar() if balance_above is None
             else F.lit(balance_above))
    placed = (t.orders if orders is None else orders).select("o_c_id", "o_w_id", "o_d_id")
    rich = t.customer.where(F.substring("c_phone", 1, 1).isin(*phone_digits)
                            & (F.col("c_balance").cast("double") > limit))
    return (rich.join(never_broadcast(placed), _equal(CUSTOMER_KEY), "left_anti")
            .groupBy(F.substring("c_state", 1, 1).alias("country"))
            .agg(F.count(F.lit(1)).alias("numcust"), F.sum("c_balance").alias("totacctbal"))
            .orderBy("country"))


REPORTS: dict[int, Callable[..., DataFrame]] = {
    1: pricing_summary, 2: lowest_stock_suppliers, 3: undelivered_revenue, 4: late_orders,
    5: regional_revenue, 6: period_revenue, 7: nation_pair_revenue, 8: market_share,
    9: product_profit, 10: customer_revenue, 11: important_stock, 12: priority_lines,
    13: order_count_distribution, 14: promotion_share, 15: top_suppliers,
    16: item_supplier_counts, 17: small_order_loss, 18: large_orders, 19: class_revenue,
    20: excess_suppliers, 21: waiting_suppliers, 22: rich_without_orders,
}


def ch_query(tables: MixedTables, number: int, **literals) -> DataFrame:
    """Report ``number`` (1 to 22) with the given literals."""
    return REPORTS[number](tables, **literals)
