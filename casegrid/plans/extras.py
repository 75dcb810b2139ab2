"""Plain Spark breadth over the star schema: windows of time, grouping sets, joins of every kind, set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ctc
from .projection import frame


def t(name):
    return lambda s, d: frame(s, d, name)


lineitem, orders, events, customer, nation, part, supplier, region = map(t, ("lineitem", "orders", "events", "customer", "nation", "part", "supplier", "region"))


def stamped(s, d):
    return events(s, d).withColumn("ts", F.col("ts").cast("timestamp"))


def asof(s, d):
    """The latest order of a customer's nation at or before an event of that customer, by one ordered pass over the union."""
    e = events(s, d).select(F.col("user_id").alias("k"), "ts", "event_id", F.lit(None).cast("double").alias("price"), F.lit(1).alias("side"))
    o = orders(s, d).selectExpr("o_custkey as k", "o_orderdate + interval 10 years as ts", "cast(null as bigint) as event_id", "o_totalprice as price", "0 as side")
    both = o.groupBy("k", "ts", "event_id", "side").agg(F.max("price").alias("price")).select("k", "ts", "event_id", "price", "side").unionByName(e)
    w = Window.partitionBy("k").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("price", F.last("price", ignorenulls=True).over(w)).where("side = 1").select("event_id", "price")


def range_join(s, d):
    """How many prices lie in ranges of given bounds: those below the upper bound less those below the lower. A price is
    counted once and not met by each range that holds it: prices are counted by value, buckets are summed one after the
    other, and within a bucket the bounds are merged into the prices in their order."""
    width = 100
    bucket = lambda c: F.floor(F.col(c) / width).alias("b")
    points = part(s, d).where("p_retailprice is not null").groupBy(F.col("p_retailprice").alias("x")).agg(F.count(F.lit(1)).alias("c")).withColumn("b", bucket("x"))
    ranges = part(s, d).where("p_size <= 5 and p_retailprice is not null").selectExpr("p_partkey as k", "p_retailprice as lo", "p_retailprice + 25 as hi")
    ends = ranges.select("lo").union(ranges.select("hi")).distinct().toDF("x").select("x", F.lit(0).cast("long").alias("c"), bucket("x"))
    earlier = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # one row for each bucket
    whole = points.select("b", "c").union(ends.select("b", "c")).groupBy("b").agg(F.sum("c").alias("c")).select("b", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("whole"))
    within = Window.partitionBy("b").orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    merged = points.select("x", "c", "b", F.lit(False).alias("end")).union(ends.select("x", "c", "b", F.lit(True)))
    # what lies at x itself is not below it
    at = Window.partitionBy("b", "x")
    below = merged.withColumn("n", F.sum("c").over(within) - F.sum("c").over(at)).where("end").join(whole, "b").select("x", (F.col("n") + F.col("whole")).alias("below"))
    lower, upper = below.toDF("lo", "less"), below.toDF("hi", "more")
    return ranges.join(lower, "lo").join(upper, "hi").groupBy("k").agg(F.sum(F.col("more") - F.col("less")).alias("n")).where("n > 0")


QUERIES = {
    "x_tumbling": (lambda s, d: stamped(s, d).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n"), "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by all"),
    "x_sliding": (
        lambda s, d: stamped(s, d).groupBy(F.window("ts", "2 hours", "1 hour")).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "n"),
        "select start, count(*) as n from (select unnest([time_bucket(interval '1 hour', ts), time_bucket(interval '1 hour', ts) - interval '1 hour']) as start from events) group by all",
    ),
    "x_session": (
        lambda s, d: stamped(s, d).groupBy("user_id", F.session_window("ts", "3 hours")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n"),
        "with c as (select user_id, ts, case when ts >= lag(ts) over w + interval '3 hours' or lag(ts) over w is null then 1 else 0 end as cut from events window w as (partition by user_id order by ts)), g as (select *, sum(cut) over (partition by user_id order by ts rows unbounded preceding) as k from c) select user_id, min(ts) as start, count(*) as n from g group by user_id, k",
    ),
    "x_pricing_summary": (
        lambda s, d: lineitem(s, d).where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz")).groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n")),
        "select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as avg_disc, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by all",
    ),
    "x_rollup": (lambda s, d: lineitem(s, d).rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")), "select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as qty from lineitem group by rollup (l_returnflag, l_linestatus)"),
    "x_cube": (lambda s, d: lineitem(s, d).cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")), "select l_returnflag, l_linestatus, count(*) as n from lineitem group by cube (l_returnflag, l_linestatus)"),
    "x_grouping_sets": (
        lambda s, d: s.sql("select o_orderstatus, o_orderpriority, cast(grouping_id(o_orderstatus, o_orderpriority) as bigint) as g, count(*) as n from {o} group by grouping sets ((o_orderstatus), (o_orderpriority), ())", o=orders(s, d)),
        "select o_orderstatus, o_orderpriority, cast(grouping_id(o_orderstatus, o_orderpriority) as bigint) as g, count(*) as n from orders group by grouping sets ((o_orderstatus), (o_orderpriority), ())",
    ),
    "x_asof_price": (
        asof,
        "select e.event_id, o.price from events e asof left join (select o_custkey as k, o_orderdate + interval 10 years as ts, max(o_totalprice) as price from orders group by all) o on o.k = e.user_id and o.ts <= e.ts",
    ),
    "x_semi": (lambda s, d: customer(s, d).join(orders(s, d), F.col("c_custkey") == F.col("o_custkey"), "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "select c_mktsegment, count(*) as n from customer where c_custkey in (select o_custkey from orders) group by all"),
    "x_anti": (lambda s, d: customer(s, d).join(orders(s, d).where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey"), "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')"),
    "x_full_outer": (
        lambda s, d: customer(s, d).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers")).join(supplier(s, d).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers")), F.col("c_nationkey") == F.col("s_nationkey"), "full_outer").select(F.coalesce("c_nationkey", "s_nationkey").alias("nation"), "customers", "suppliers"),
        "select coalesce(c_nationkey, s_nationkey) as nation, customers, suppliers from (select c_nationkey, count(*) as customers from customer group by all) full join (select s_nationkey, count(*) as suppliers from supplier group by all) on c_nationkey = s_nationkey",
    ),
    "x_range_join": (range_join, "select r.p_partkey as k, count(*) as n from part r join part p on p.p_retailprice >= r.p_retailprice and p.p_retailprice < r.p_retailprice + 25 where r.p_size <= 5 group by all"),
    "x_region_revenue": (
        lambda s, d: lineitem(s, d).join(orders(s, d), F.col("l_orderkey") == F.col("o_orderkey")).join(customer(s, d), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation(s, d).join(region(s, d), F.col("n_regionkey") == F.col("r_regionkey"))), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue")),
        "select r_name, round(sum(l_extendedprice), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by all",
    ),
    "x_intersect_all": (lambda s, d: customer(s, d).select("c_nationkey").intersectAll(supplier(s, d).select(F.col("s_nationkey").alias("c_nationkey"))), "select c_nationkey from customer intersect all select s_nationkey from supplier"),
    "x_except_all": (lambda s, d: customer(s, d).select(F.col("c_nationkey").alias("k")).exceptAll(supplier(s, d).select(F.col("s_nationkey").alias("k"))), "select c_nationkey as k from customer except all select s_nationkey from supplier"),
    "x_topk_window": (
        lambda s, d: orders(s, d).withColumn("n", F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("n <= 3").select("o_orderpriority", "o_orderkey", "n"),
        "select o_orderpriority, o_orderkey, cast(n as int) as n from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as n from orders) where n <= 3",
    ),
    "x_moving_average": (
        lambda s, d: orders(s, d).groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.sum("o_totalprice").alias("v")).withColumn("avg7", F.round(F.avg("v").over(Window.orderBy("day").rowsBetween(-6, 0)), 4)).select("day", "avg7"),
        "select day, round(avg(v) over (order by day rows between 6 preceding and current row), 4) as avg7 from (select cast(o_orderdate as date) as day, sum(o_totalprice) as v from orders group by all)",
    ),
    "x_percentile": (lambda s, d: lineitem(s, d).groupBy("l_returnflag").agg(F.percentile("l_extendedprice", 0.5).alias("median")), "select l_returnflag, quantile_cont(l_extendedprice, 0.5) as median from lineitem group by all"),
    "x_approx_distinct": (lambda s, d: lineitem(s, d).groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts")), None),
    "x_json_props": (lambda s, d: events(s, d).select(F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")), "select cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as n from events group by all"),
    "x_array_explode": (lambda s, d: part(s, d).select(F.explode(F.split("p_type", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "select word, count(*) as n from (select unnest(string_split(p_type, ' ')) as word from part) group by all"),
    "x_map_agg": (
        lambda s, d: orders(s, d).groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")).groupBy("o_orderstatus").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "n"))).alias("m")).select("o_orderstatus", F.try_element_at("m", F.lit("1-URGENT")).alias("urgent"), F.size("m").alias("kinds")),
        "select o_orderstatus, sum(case when o_orderpriority = '1-URGENT' then n end)::bigint as urgent, cast(count(*) as int) as kinds from (select o_orderstatus, o_orderpriority, count(*) as n from orders group by all) group by all",
    ),
    "x_pivot": (lambda s, d: lineitem(s, d).groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity")), "select l_returnflag, sum(l_quantity) filter (where l_linestatus = 'F') as F, sum(l_quantity) filter (where l_linestatus = 'O') as O from lineitem group by all"),
    "x_scalar_subquery": (
        lambda s, d: s.sql("select c_custkey from {c} where c_acctbal > (select avg(c_acctbal) from {c}) and exists (select 1 from {o} where o_custkey = c_custkey and o_orderstatus = 'F')", c=customer(s, d), o=orders(s, d)),
        "select c_custkey from customer where c_acctbal > (select avg(c_acctbal) from customer) and exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')",
    ),
    "ctc_forward_score": (lambda s, d: frame(s, d, "embeddings").select("vec_id", ctc.score(F.col("embedding"), 8, F.array(F.lit(3), F.lit(5), F.lit(5))).alias("score")), None),
}
