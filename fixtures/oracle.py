"""DuckDB texts for the registered queries, in the words of the original predicates.

These are written independently of the library: plain joins in the reported order,
EXISTS and NOT EXISTS as such, and no pre-aggregation.
"""

from __future__ import annotations

import re

from fixtures.views import with_views

SKEY = "((s_w_id * s_i_id) % (SELECT count(*) FROM supplier))"
DAY = "1998-01-02"
LINE_OF_ORDER = "ol_o_id = o_id AND ol_w_id = o_w_id AND ol_d_id = o_d_id"
CUST_OF_ORDER = "c_id = o_c_id AND c_w_id = o_w_id AND c_d_id = o_d_id"
STATE_NATION = "ascii(substr(c_state, 1, 1))"


def _sum(expr: str) -> str:
    return f"cast(sum({expr}) AS double)"


def _mean(expr: str) -> str:
    return f"cast(sum({expr}) AS double) / count({expr})"


def _big(expr: str) -> str:
    return f"cast({expr} AS bigint)"


AGG = """agg AS (
    SELECT time_bucket(INTERVAL 1 HOUR, time_stamp) AS window_start,
           min(time_stamp) AS time_stamp, publisher, geo,
           cast(sum(bid) AS double) / count(bid) AS avg_bid, count(*) AS imps,
           count(DISTINCT cookie) AS uniques
    FROM impressions WHERE geo <> 'un'
    GROUP BY time_bucket(INTERVAL 1 HOUR, time_stamp), publisher, geo)"""


def ad_oracles() -> dict[str, str]:
    imp = lambda body, extra="": with_views(body, "impressions", extra=extra)
    out = {
        "ad_1_count_by_geo": imp(
            "SELECT geo, count(*) AS ad_count FROM impressions GROUP BY geo "
            "ORDER BY ad_count DESC, geo LIMIT 20"),
        "ad_2_bid_by_geo": imp(
            f"SELECT geo, {_sum('bid')} AS sum_bid FROM impressions GROUP BY geo "
            "ORDER BY sum(bid) DESC, geo LIMIT 20"),
        "ad_3_bid_by_publisher": imp(
            f"SELECT publisher, {_sum('bid')} AS sum_bid FROM impressions GROUP BY publisher "
            "ORDER BY sum(bid) DESC, publisher LIMIT 20"),
        "ad_4_count": imp("SELECT count(*) AS row_count FROM impressions"),
        "ad_5_aggregate_by_geo": imp(
            "SELECT geo, count(*) AS ad_count FROM agg GROUP BY geo "
            "ORDER BY ad_count DESC, geo LIMIT 20", AGG),
        "ad_6_uniques_by_geo": imp(
            f"SELECT geo, {_big('sum(uniques)')} AS total_uniques FROM agg "
            "WHERE publisher = 'publisher11' GROUP BY geo "
            "ORDER BY total_uniques DESC, geo LIMIT 20", AGG),
        "ad_6_people_by_geo": imp(
            "SELECT geo, count(DISTINCT cookie) AS people FROM impressions "
            "WHERE publisher = 'publisher11' AND geo <> 'un' GROUP BY geo "
            "ORDER BY people DESC, geo LIMIT 20"),
        "ad_7_advertiser_uniques": imp(
            "SELECT geo, count(DISTINCT cookie) AS uniques FROM impressions "
            "WHERE advertiser = 'advertiser11' GROUP BY geo"),
        "ad_8_impression_trend": imp(
            "SELECT advertiser, date_trunc('day', time_stamp)::timestamp AS period, "
            "count(*) AS imps FROM impressions GROUP BY ALL"),
        "ad_9_top_ads_per_geo": imp(
            "SELECT geo, advertiser, uniques, cast(place AS int) AS place FROM (SELECT *, row_number() OVER ("
            "PARTITION BY geo ORDER BY uniques DESC, advertiser) AS place FROM ("
            "SELECT geo, advertiser, count(DISTINCT cookie) AS uniques FROM impressions "
            "GROUP BY geo, advertiser)) WHERE place <= 3"),
    }
    return out


def window_oracle(hours: str, keys: str, closed: bool = False, slide: str | None = None,
                  instant: bool = False) -> str:
    """Roll-up per window; ``closed`` leaves out windows a stream has not closed."""
    step = slide or hours
    extra = ", time_stamp" if instant else ""
    shown = ", time_stamp AS instant" if instant else ""
    starts = f"time_bucket(INTERVAL {step}, time_stamp)"
    if slide:
        rows = (f"SELECT *, {starts} - k * INTERVAL {step} AS window_start "
                f"FROM impressions, (SELECT unnest(range(0, 2)) AS k)")
    else:
        rows = f"SELECT *, {starts} AS window_start FROM impressions"
    having = (f"HAVING window_start + INTERVAL {hours} <= (SELECT max(time_stamp) "
              "FROM impressions WHERE geo <> 'un')") if closed else ""
    body = (f"SELECT window_start, window_start + INTERVAL {hours} AS window_end, {keys}{shown}, "
            f"min(time_stamp) AS first_seen, {_sum('bid')} AS sum_bids, "
            f"{_mean('bid')} AS avg_bid, count(*) AS imps, "
            f"count(DISTINCT cookie) AS uniques FROM w WHERE geo <> 'un' "
            f"GROUP BY window_start, {keys}{extra} {having}")
    return with_views(body, "impressions", extra=f"w AS ({rows})")


def ch_oracles() -> dict[str, str]:
    ol, o, c = "ch_order_line", "ch_orders", "ch_customer"
    st, it, su, na, re = "ch_stock", "ch_item", "ch_supplier", "ch_nation", "ch_region"
    supplied = f"JOIN {su} ON {SKEY} = su_suppkey"
    q: dict[str, str] = {}
    q["ch_01_pricing_summary"] = with_views(
        f"SELECT ol_number, {_big('sum(ol_quantity)')} AS sum_qty, "
        f"{_sum('ol_amount')} AS sum_amount, {_mean('ol_quantity')} AS avg_qty, "
        f"{_mean('ol_amount')} AS avg_amount, count(*) AS count_order FROM {ol} "
        f"WHERE ol_delivery_d > TIMESTAMP '{DAY}' GROUP BY ol_number", ol)
    q["ch_02_lowest_stock_suppliers"] = with_views(
        f"""SELECT su_suppkey, su_name, n_name, i_id, i_name, su_address, su_phone, su_comment
        FROM {st} JOIN {it} ON i_id = s_i_id {supplied}
        JOIN {na} ON su_nationkey = n_nationkey JOIN {re} ON n_regionkey = r_regionkey
        JOIN (SELECT s_i_id AS m_id, min(s_quantity) AS m_q FROM {st} {supplied}
              JOIN {na} ON su_nationkey = n_nationkey JOIN {re} ON n_regionkey = r_regionkey
              WHERE r_name LIKE 'EUROP%' GROUP BY s_i_id) m ON m_id = i_id AND m_q = s_quantity
        WHERE r_name LIKE 'EUROP%' AND i_data LIKE '%t'""", st, it, su, na, re)
    q["ch_03_undelivered_revenue"] = with_views(
        f"""SELECT ol_o_id, ol_w_id, ol_d_id, {_sum('ol_amount')} AS revenue, o_entry_d
        FROM {c} JOIN {o} ON {CUST_OF_ORDER} JOIN {ol} ON {LINE_OF_ORDER}
        JOIN ch_new_order ON no_o_id = o_id AND no_w_id = o_w_id AND no_d_id = o_d_id
        WHERE c_state LIKE 'A%' AND o_entry_d > TIMESTAMP '{DAY}'
        GROUP BY ol_o_id, ol_w_id, ol_d_id, o_entry_d""", c, o, ol, "ch_new_order")
    q["ch_04_late_lines"] = with_views(
        f"SELECT o_ol_cnt, count(*) AS order_count FROM {o} JOIN {ol} ON {LINE_OF_ORDER} "
        "AND ol_delivery_d >= o_entry_d GROUP BY o_ol_cnt", o, ol)
    q["ch_04_late_orders"] = with_views(
        f"SELECT o_ol_cnt, count(*) AS order_count FROM {o} WHERE EXISTS (SELECT 1 FROM {ol} "
        f"WHERE {LINE_OF_ORDER} AND ol_delivery_d >= o_entry_d) GROUP BY o_ol_cnt", o, ol)
    q["ch_05_regional_revenue"] = with_views(
        f"""SELECT n_name, {_sum('ol_amount')} AS revenue
        FROM {ol} JOIN {o} ON {LINE_OF_ORDER} JOIN {c} ON {CUST_OF_ORDER}
        JOIN {st} ON ol_w_id = s_w_id AND ol_i_id = s_i_id {supplied}
        JOIN {na} ON su_nationkey = n_nationkey JOIN {re} ON n_regionkey = r_regionkey
        WHERE {STATE_NATION} = su_nationkey AND r_name = 'EUROPE'
          AND o_entry_d >= TIMESTAMP '{DAY}' GROUP BY n_name""", ol, o, c, st, su, na, re)
    q["ch_06_period_revenue"] = with_views(
        f"SELECT {_sum('ol_amount')} AS revenue FROM {ol} WHERE ol_delivery_d >= "
        f"TIMESTAMP '{DAY}' AND ol_delivery_d < TIMESTAMP '2001-01-01' "
        "AND ol_quantity BETWEEN 1 AND 25", ol)
    q["ch_07_nation_pair_revenue"] = with_views(
        f"""SELECT su_nationkey AS supp_nation, n2.n_nationkey AS cust_nation,
               year(o_entry_d)::int AS l_year, {_sum('ol_amount')} AS revenue
        FROM {ol} JOIN {o} ON {LINE_OF_ORDER} JOIN {c} ON {CUST_OF_ORDER}
        JOIN {st} ON ol_supply_w_id = s_w_id AND ol_i_id = s_i_id {supplied}
        JOIN {na} n1 ON su_nationkey = n1.n_nationkey
        JOIN {na} n2 ON {STATE_NATION} = n2.n_nationkey
        WHERE (n1.n_name = 'NATION_7' AND n2.n_name = 'NATION_15')
           OR (n1.n_name = 'NATION_15' AND n2.n_name = 'NATION_7')
        GROUP BY ALL""", ol, o, c, st, su, na)
    q["ch_08_market_share"] = with_views(
        f"""SELECT year(o_entry_d)::int AS l_year,
               cast(sum(CASE WHEN n2.n_name = 'NATION_15' THEN ol_amount ELSE 0 END) AS double)
               / cast(sum(ol_amount) AS double) AS mkt_share
        FROM {ol} JOIN {o} ON {LINE_OF_ORDER} JOIN {c} ON {CUST_OF_ORDER}
        JOIN {st} ON ol_supply_w_id = s_w_id AND ol_i_id = s_i_id {supplied}
        JOIN {it} ON i_id = s_i_id
        JOIN {na} n1 ON {STATE_NATION} = n1.n_nationkey
        JOIN {na} n2 ON su_nationkey = n2.n_nationkey
        JOIN {re} ON n1.n_regionkey = r_regionkey
        WHERE ol_i_id < 1000 AND r_name = 'EUROPE' AND i_data LIKE '%t'
        GROUP BY ALL""", ol, o, c, st, su, it, na, re)
    q["ch_09_product_profit"] = with_views(
        f"""SELECT n_name, year(o_entry_d)::int AS l_year, {_sum('ol_amount')} AS sum_profit
        FROM {ol} JOIN {o} ON {LINE_OF_ORDER} JOIN {it} ON ol_i_id = i_id
        JOIN {st} ON ol_supply_w_id = s_w_id AND ol_i_id = s_i_id {supplied}
        JOIN {na} ON su_nationkey = n_nationkey
        WHERE i_data LIKE '%lt' GROUP BY ALL""", ol, o, it, st, su, na)
    q["ch_10_customer_revenue"] = with_views(
        f"""SELECT c_id, c_last, {_sum('ol_amount')} AS revenue, c_city, c_phone, n_name
        FROM {c} JOIN {o} ON {CUST_OF_ORDER} JOIN {ol} ON {LINE_OF_ORDER}
        JOIN {na} ON n_nationkey = {STATE_NATION}
        WHERE o_entry_d >= TIMESTAMP '{DAY}' AND o_entry_d <= ol_delivery_d
        GROUP BY c_id, c_last, c_city, c_phone, n_name""", c, o, ol, na)
    nation_stock = (f"FROM {st} {supplied} JOIN {na} ON su_nationkey = n_nationkey "
                    "WHERE n_name = 'NATION_15'")
    q["ch_11_important_stock"] = with_views(
        f"""SELECT s_i_id, {_big('sum(s_order_cnt)')} AS ordercount {nation_stock}
        GROUP BY s_i_id
        HAVING sum(s_order_cnt) > (SELECT sum(s_order_cnt) * .005 {nation_stock})""",
        st, su, na)
    q["ch_11_parameter_form"] = q["ch_11_important_stock"]
    q["ch_11_threshold"] = with_views(
        f"SELECT cast(sum(s_order_cnt) * .005 AS double) AS threshold {nation_stock}", st, su, na)
    q["ch_12_priority_lines"] = with_views(
        f"""SELECT o_ol_cnt,
               {_big('sum(CASE WHEN o_carrier_id = 1 OR o_carrier_id = 2 THEN 1 ELSE 0 END)')}
                   AS high_line_count,
               {_big('sum(CASE WHEN o_carrier_id <> 1 AND o_carrier_id <> 2 THEN 1 ELSE 0 END)')}
                   AS low_line_count
        FROM {o} JOIN {ol} ON {LINE_OF_ORDER}
        WHERE o_entry_d <= ol_delivery_d AND ol_delivery_d < TIMESTAMP '2001-01-01'
        GROUP BY o_ol_cnt""", o, ol)
    q["ch_13_order_count_distribution"] = with_views(
        f"""SELECT c_count, count(*) AS custdist FROM (
            SELECT c_id, count(o_id) AS c_count FROM {c} LEFT JOIN {o}
            ON {CUST_OF_ORDER} AND o_carrier_id > 4 GROUP BY c_id) GROUP BY c_count""", c, o)
    q["ch_14_promotion_share"] = with_views(
        f"""SELECT cast(100 * sum(CASE WHEN i_data LIKE 'PR%' THEN ol_amount ELSE 0 END) AS double)
               / cast(1 + sum(ol_amount) AS double) AS promo_revenue
        FROM {ol} JOIN {it} ON ol_i_id = i_id
        WHERE ol_delivery_d >= TIMESTAMP '{DAY}' AND ol_delivery_d < TIMESTAMP '2020-01-02 00:00:00'""", ol, it)
    q["ch_15_supplier_revenue"] = with_views(
        f"""SELECT {SKEY} AS supplier_no, {_sum('ol_amount')} AS total_revenue
        FROM {ol} JOIN {st} ON ol_i_id = s_i_id AND ol_supply_w_id = s_w_id
        WHERE ol_delivery_d >= TIMESTAMP '{DAY}' GROUP BY supplier_no""", ol, st)
    q["ch_15_top_suppliers"] = with_views(
        """SELECT su_suppkey, su_name, su_address, su_phone,
               cast(total_revenue AS double) AS total_revenue
        FROM ch_supplier JOIN revenue ON su_suppkey = supplier_no
        WHERE total_revenue = (SELECT max(total_revenue) FROM revenue)""", ol, st, su,
        extra=f"""revenue AS (SELECT {SKEY} AS supplier_no, sum(ol_amount) AS total_revenue
        FROM {ol} JOIN {st} ON ol_i_id = s_i_id AND ol_supply_w_id = s_w_id
        WHERE ol_delivery_d >= TIMESTAMP '{DAY}' GROUP BY supplier_no)""")
    q["ch_16_item_supplier_counts"] = with_views(
        f"""SELECT i_name, substr(i_data, 1, 3) AS brand, cast(i_price AS double) AS i_price,
               count(DISTINCT {SKEY}) AS supplier_cnt
        FROM {st} JOIN {it} ON i_id = s_i_id
        WHERE i_data NOT LIKE 'zz%' AND {SKEY} NOT IN (
            SELECT su_suppkey FROM {su} WHERE su_comment LIKE '%bad%')
        GROUP BY i_name, substr(i_data, 1, 3), i_price""", st, it, su)
    q["ch_17_small_order_loss"] = with_views(
        f"""SELECT cast(sum(ol_amount) AS double) / 2.0 AS avg_yearly
        FROM {ol} JOIN (SELECT i_id, avg(ol_quantity) AS a FROM {it} JOIN {ol} ON ol_i_id = i_id
                        WHERE i_data LIKE '%t' GROUP BY i_id) t ON ol_i_id = t.i_id
        WHERE ol_quantity < t.a""", ol, it)
    q["ch_18_large_orders"] = with_views(
        f"""SELECT c_last, c_id, o_id, o_entry_d, o_ol_cnt, {_sum('ol_amount')} AS amount_sum
        FROM {c} JOIN {o} ON {CUST_OF_ORDER} JOIN {ol} ON {LINE_OF_ORDER}
        GROUP BY o_id, o_w_id, o_d_id, c_id, c_last, o_entry_d, o_ol_cnt
        HAVING sum(ol_amount) > 400000""", c, o, ol)
    fits = " OR ".join(
        f"(i_data LIKE '%{s}' AND ol_w_id IN ({ws}) AND ol_quantity BETWEEN 1 AND 10 "
        "AND i_price BETWEEN 1 AND 400000)"
        for s, ws in (("t", "1, 2, 3"), ("g", "1, 2, 4"), ("e", "1, 5, 3")))
    q["ch_19_class_revenue"] = with_views(
        f"SELECT {_sum('ol_amount')} AS revenue FROM {ol} JOIN {it} ON ol_i_id = i_id "
        f"WHERE {fits}", ol, it)
    q["ch_20_excess_suppliers"] = with_views(
        f"""SELECT su_name, su_address FROM {su} JOIN {na} ON su_nationkey = n_nationkey
        WHERE n_name = 'NATION_15' AND su_suppkey IN (
            SELECT {SKEY} FROM {st} JOIN {it} ON i_id = s_i_id JOIN {ol} ON ol_i_id = s_i_id
            WHERE ol_delivery_d > TIMESTAMP '2001-05-23 12:00:00' AND i_data LIKE 'PR%'
            GROUP BY s_i_id, s_w_id, s_quantity HAVING 2 * s_quantity > sum(ol_quantity))""",
        su, na, st, it, ol)
    q["ch_21_waiting_suppliers"] = with_views(
        f"""SELECT su_name, count(*) AS numwait
        FROM {ol} l1 JOIN {o} ON {LINE_OF_ORDER}
        JOIN {st} ON ol_w_id = s_w_id AND ol_i_id = s_i_id {supplied}
        JOIN {na} ON su_nationkey = n_nationkey
        WHERE l1.ol_delivery_d > o_entry_d AND n_name = 'NATION_15' AND NOT EXISTS (
            SELECT 1 FROM {ol} l2 WHERE l2.ol_o_id = l1.ol_o_id AND l2.ol_w_id = l1.ol_w_id
            AND l2.ol_d_id = l1.ol_d_id AND l2.ol_delivery_d > l1.ol_delivery_d)
        GROUP BY su_name""", ol, o, st, su, na)
    digits = "substr(c_phone, 1, 1) IN ('1', '2', '3', '4', '5', '6', '7')"
    mean = (f"SELECT cast(sum(c_balance) AS double) / count(*) FROM {c} "
            f"WHERE c_balance > 0 AND {digits}")
    rich = f"""SELECT substr(c_state, 1, 1) AS country, count(*) AS numcust,
               {_sum('c_balance')} AS totacctbal
        FROM {c} LEFT JOIN {o} ON {CUST_OF_ORDER}
        WHERE {digits} AND cast(c_balance AS double) > ({mean}) AND o_id IS NULL
        GROUP BY substr(c_state, 1, 1)"""
    q["ch_22_rich_without_orders"] = with_views(rich, c, o)
    q["ch_22_parameter_form"] = q["ch_22_rich_without_orders"]
    q["ch_22_with_new_customers"] = with_views(rich.replace(
        f"FROM {c} LEFT", f"FROM (SELECT * FROM {c} UNION ALL SELECT * REPLACE (c_id + 100000000 AS c_id) "
        f"FROM {c}) LEFT"), c, o)
    q["ch_22_mean_balance"] = with_views(
        mean.replace("count(*) FROM", "count(*) AS mean_balance FROM"), c)
    return q


def click_oracles() -> dict[str, str]:
    items = """SELECT date_trunc('day', cs_click_d)::timestamp AS window_start,
               date_trunc('day', cs_click_d)::timestamp + INTERVAL 1 DAY AS window_end,
               i_id, count(*) AS clicks
        FROM clicks JOIN ch_item ON i_id = cs_i_id WHERE i_price > 950 GROUP BY ALL"""
    return {
        "clk_1_items": with_views(items, "clicks", "ch_item"),
        "clk_1_top_items": with_views(
            f"""SELECT window_start, i_id, clicks, cast(place AS int) AS place FROM (SELECT *, row_number() OVER (
            PARTITION BY window_start ORDER BY clicks DESC, i_id) AS place FROM ({items}))
            WHERE place <= 10""", "clicks", "ch_item"),
        "clk_2_districts": with_views(
            """SELECT date_trunc('day', cs_click_d)::timestamp AS window_start,
               date_trunc('day', cs_click_d)::timestamp + INTERVAL 1 DAY AS window_end,
               cs_c_d_id, cast(sum(cs_timespent) AS double) / count(*) AS avg_timespent
            FROM clicks GROUP BY ALL""", "clicks"),
    }


def sample_ctes(qcs: str, fraction: float, floor: int) -> str:
    """The sample as CTEs: u from md5 of the event id, rates from strata counts."""
    using = ", ".join(c.strip() for c in qcs.split(","))
    return f"""strata AS (SELECT {using}, count(*) AS stratum_rows FROM impressions
                GROUP BY {using}),
        rated AS (SELECT *, least(1.0::double, greatest({fraction}::double,
                {floor}::double / stratum_rows::double)) AS sample_rate FROM strata),
        units AS (SELECT *, ('0x' || substr(md5(cast(event_id AS varchar)), 1, 13))::bigint::double
                / 4503599627370496::double AS sample_u FROM impressions),
        sample AS (SELECT units.*, sample_rate, 1.0::double / sample_rate AS sample_weight
                FROM units JOIN rated USING ({using}) WHERE sample_u < sample_rate)"""


def sample_oracle(body: str, qcs: str = "geo", fraction: float = 0.03, floor: int = 50) -> str:
    return with_views(body, "impressions", extra=sample_ctes(qcs, fraction, floor))


def aggregate_sample_oracle(body: str) -> str:
    """The same over the hourly aggregate, whose key has three columns."""
    key = " || ".join(f"length({c}) || ':' || {c}"
                      for c in ("cast(epoch_us(time_stamp) AS varchar)", "publisher", "geo"))
    ctes = (sample_ctes("geo", 0.03, 50).replace("FROM impressions", "FROM agg")
            .replace("md5(cast(event_id AS varchar))", f"md5({key})"))
    return with_views(body, "impressions", extra=f"{AGG},\n{ctes}")


Z95 = 1.959963984540054


def estimate_oracle(group: str, y: str, name: str, where: str = "") -> str:
    """Weighted total of y, rounded, with its relative error, top 20."""
    keys = f"{group}, " if group else ""
    tail = (f" GROUP BY {group} ORDER BY round(sum(sample_weight * {y}), 6) DESC, {group} "
            "LIMIT 20") if group else ""
    return (f"SELECT {keys}round(sum(sample_weight * {y}), 6) AS {name}, "
            f"round({Z95} * sqrt(sum(sample_weight * (sample_weight - 1) * {y} * {y})) "
            f"/ sum(sample_weight * {y}), 6) AS {name}_error, count(*) AS sample_rows "
            f"FROM sample {where}{tail}")


def share_oracle(part: str, replicates: int) -> str:
    """The share of the bids that a part has, with its relative error from replicates by the bits of a digest."""
    sums = ", ".join(
        f"sum({y} * (sample_weight + sqrt(sample_weight * (sample_weight - 1)) * (1 - 2 * ((w{r // 32} >> {r % 32}) & 1)))) "
        f"AS {name}{r}" for r in range(replicates) for name, y in (("p", "part"), ("a", "bid")))
    apart = " + ".join(f"pow(coalesce(p{r} / nullif(a{r}, 0), 'nan'::double) - share, 2)" for r in range(replicates))
    words = ", ".join(f"('0x' || substr(digest, {1 + 8 * i}, 8))::bigint AS w{i}" for i in range((replicates + 31) // 32))
    return f"""SELECT geo, round(share, 6) AS share, round({Z95} * sqrt(({apart}) / {replicates}) / share, 6) AS share_error,
        sample_rows FROM (SELECT geo, sum(part * sample_weight) / sum(bid * sample_weight) AS share,
        count(*) AS sample_rows, {sums} FROM (SELECT *, {words} FROM (SELECT geo, sample_weight,
        bid::double AS bid, CASE WHEN {part} THEN bid::double ELSE 0 END AS part,
        md5('replicate' || length(event_id::varchar) || ':' || event_id::varchar) AS digest FROM sample))
        GROUP BY geo) WHERE share > 0"""


def stepped_oracle(group: str, y: str, name: str, limit: float, steps: list[tuple], qcs: str) -> str:
    """The estimate of the first of some samples, ``(sample, fraction, minimum)`` each, that is within the limit in
    every group; from all rows if none is. Top 20."""
    ctes, chosen = [], []
    for i, (sample, fraction, floor) in enumerate(steps):
        text = sample_ctes(qcs, fraction, floor)
        for cte in ("strata", "rated", "units", "sample"):
            text = re.sub(rf"\b{cte}\b", f"{cte}{i}", text)
        ctes += [text, f"""e{i} AS (SELECT {group}, sum(sample_weight * {y}) AS total,
            {Z95} * sqrt(sum(sample_weight * (sample_weight - 1) * {y} * {y})) / sum(sample_weight * {y}) AS err,
            count(*) AS sample_rows, '{sample}' AS answered_by FROM sample{i} GROUP BY {group})"""]
        chosen.append(f"WHEN (SELECT max(err) FROM e{i}) <= {limit} THEN {i}")
    n = len(steps)
    ctes.append(f"""e{n} AS (SELECT {group}, sum({y}) AS total, 0.0::double AS err, NULL::bigint AS sample_rows,
        'base' AS answered_by FROM impressions GROUP BY {group})""")
    ctes.append(f"pick AS (SELECT CASE {' '.join(chosen)} ELSE {n} END AS k)")
    every = " UNION ALL ".join(f"SELECT e{i}.* FROM e{i}, pick WHERE k = {i}" for i in range(n + 1))
    return with_views(
        f"SELECT {group}, round(total, 6) AS {name}, round(err, 6) AS {name}_error, sample_rows, answered_by "
        f"FROM ({every}) ORDER BY round(total, 6) DESC, {group} LIMIT 20", "impressions", extra=",\n".join(ctes))
