"""Impressions, clicks and the nine mixed-workload tables from the given test data.

Each view is one SQL text that both Spark and DuckDB run; names in braces are its
inputs. Only the function that repeats a row per warehouse is spelled differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bidlens.operators.sizing import never_broadcast
from bidlens.plans.mixed import TABLE_NAMES, MixedTables
from bidlens.sources.workspace import work_dir

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


VIEWS: dict[str, str] = {
    "impressions": """
        SELECT ts AS time_stamp,
               'publisher' || cast(event_id % 51 AS string) AS publisher,
               'advertiser' || cast(user_id % 31 AS string) AS advertiser,
               'website' || cast(event_id % 1000 AS string) AS website,
               CASE WHEN event_id % 51 = 50 THEN 'un'
                    ELSE 'G' || cast((event_id * 7 + user_id) % 50 AS string) END AS geo,
               cast(value AS decimal(18,2)) AS bid,
               'cookie' || cast(user_id AS string) AS cookie,
               event_id
        FROM {events}""",
    "clicks": """
        SELECT cast(user_id % 10 + 1 AS int) AS cs_c_w_id,
               cast(cast(floor(user_id / 10) AS bigint) % 10 + 1 AS int) AS cs_c_d_id,
               cast(user_id AS int) AS cs_c_id,
               cast(event_id % (SELECT count(*) FROM {part}) AS int) AS cs_i_id,
               cast(event_id % 400 + 100 AS int) AS cs_timespent,
               ts AS cs_click_d
        FROM {events}""",
    "ch_orders": """
        SELECT o_orderkey AS o_id, o_custkey AS o_c_id,
               cast(o_custkey % 10 + 1 AS int) AS o_w_id,
               cast(cast(floor(o_custkey / 10) AS bigint) % 10 + 1 AS int) AS o_d_id,
               o_orderdate AS o_entry_d,
               cast(substr(o_orderpriority, 1, 1) AS int) AS o_carrier_id,
               cast(n_lines AS int) AS o_ol_cnt,
               o_orderstatus
        FROM {orders}
        JOIN (SELECT l_orderkey, count(*) AS n_lines FROM {lineitem} GROUP BY l_orderkey) c
          ON o_orderkey = l_orderkey""",
    "ch_new_order": """
        SELECT o_id AS no_o_id, o_w_id AS no_w_id, o_d_id AS no_d_id
        FROM {ch_orders} WHERE o_orderstatus = 'O'""",
    "ch_order_line": """
        SELECT l_orderkey AS ol_o_id,
               cast(o_custkey % 10 + 1 AS int) AS ol_w_id,
               cast(cast(floor(o_custkey / 10) AS bigint) % 10 + 1 AS int) AS ol_d_id,
               l_linenumber AS ol_number, l_partkey AS ol_i_id,
               cast(l_suppkey % 10 + 1 AS int) AS ol_supply_w_id,
               l_shipdate AS ol_delivery_d, cast(l_quantity AS int) AS ol_quantity,
               cast(l_extendedprice AS decimal(18,2)) AS ol_amount
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "ch_customer": """
        SELECT c_custkey AS c_id,
               cast(c_custkey % 10 + 1 AS int) AS c_w_id,
               cast(cast(floor(c_custkey / 10) AS bigint) % 10 + 1 AS int) AS c_d_id,
               c_name AS c_last, c_mktsegment AS c_city,
               chr(65 + c_nationkey) || 'X' AS c_state,
               cast(c_custkey % 9 + 1 AS string) || '-555' AS c_phone,
               cast(c_acctbal AS decimal(18,2)) AS c_balance
        FROM {customer}""",
    "ch_item": """
        SELECT p_partkey AS i_id, p_name AS i_name, p_type || ' ' || p_name AS i_data,
               cast(p_retailprice AS decimal(18,2)) AS i_price
        FROM {part}""",
    "ch_stock": """
        SELECT s_w_id, s_i_id,
               cast((s_w_id * s_i_id * 7) % 91 + 10 AS int) AS s_quantity,
               cast((s_w_id * 31 + s_i_id * 17) % 50 AS int) AS s_order_cnt
        FROM (SELECT {each_warehouse} AS s_w_id, p_partkey AS s_i_id FROM {part}) p
        WHERE s_w_id IN (SELECT cast(s_suppkey % 10 + 1 AS int) FROM {supplier})""",
    "ch_supplier": """
        SELECT s_suppkey AS su_suppkey, s_name AS su_name, s_nationkey + 65 AS su_nationkey,
               'addr' || cast(s_suppkey AS string) AS su_address,
               cast(s_nationkey AS string) || '-777' AS su_phone,
               CASE WHEN s_suppkey % 7 = 0 THEN 'a bad one' ELSE 'ok' END AS su_comment
        FROM {supplier}""",
    "ch_nation": """
        SELECT n_nationkey + 65 AS n_nationkey, n_name, n_regionkey FROM {nation}""",
    "ch_region": "SELECT r_regionkey, r_name FROM {region}",
}
EACH_WAREHOUSE = {"spark": "explode(sequence(1, 10))", "duckdb": "unnest(range(1, 11))"}


def _inputs(name: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name]))
            if n != "each_warehouse"]


def with_views(body: str, *names: str, extra: str = "") -> str:
    """DuckDB text: the named views, and those they need, before ``body``."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in RAW or name in needed:
            return
        for other in _inputs(name):
            add(other)
        needed.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({VIEWS[n].format_map(_Names())})" for n in needed]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body


class _Names(dict):
    def __missing__(self, key):
        return EACH_WAREHOUSE["duckdb"] if key == "each_warehouse" else key


_schemas: dict[str, StructType] = {}


def read_given(spark: SparkSession, path: str) -> DataFrame:
    """A given table; its schema is taken from the file's footer once per path."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


class Data:
    """The given tables below ``sf_dir`` and the views on them, made on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}
        self._event_files = ""

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                text = VIEWS[name].replace("{each_warehouse}", EACH_WAREHOUSE["spark"])
                # Orders are joined with their lines: two large tables, of which none is broadcast.
                inputs = {n: never_broadcast(self[n]) if n == "orders" else self[n] for n in _inputs(name)}
                self._frames[name] = self.spark.sql(text, **inputs)
            else:
                self._frames[name] = read_given(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    @property
    def impressions(self) -> DataFrame:
        return self["impressions"]

    def event_files(self, parts: int = 5) -> str:
        """The events stored as files in order of time, to be replayed one per trigger."""
        if not self._event_files:
            path, events = work_dir(self.spark, "event-files"), self["events"]
            cuts = events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).agg(
                F.expr("percentile_approx(t, array({}), 10000)".format(
                    ", ".join(str(i / parts) for i in range(1, parts))))).first()[0] or []
            at = F.unix_micros(F.col("ts").cast("timestamp"))
            part = sum(((at >= c).cast("int") for c in sorted(set(cuts))), F.lit(0))
            for n in range(len(set(cuts)) + 1):  # one after another: files are replayed by age
                events.where(part == n).coalesce(1).write.mode("append").parquet(path)
            self._event_files = path
        return self._event_files

    def mixed(self, check_dimensions: bool = False) -> MixedTables:
        return GivenTables(self, check_dimensions)


class GivenTables(MixedTables):
    """The mixed-workload tables as views, each made when a report first asks for it."""

    def __init__(self, data: Data, check_dimensions: bool):
        for name, value in (("_data", data), ("check_dimensions", check_dimensions), (
                "supplier_modulus", data["supplier"].agg(F.count(F.lit(1))).scalar())):
            object.__setattr__(self, name, value)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self._data[f"ch_{name}"]
