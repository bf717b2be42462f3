"""Reshaping, set, order and SQL-text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import order, reshape
from .registry import Tables, query

_MONTHS = [f"{m:02d}" for m in range(1, 13)]
_LONG = "SELECT l_partkey % 200 AS id, strftime(l_shipdate, '%m') AS label, round(avg(l_discount), 6) AS d, round(median(l_quantity), 4) AS q FROM lineitem WHERE year(l_shipdate) = 1995 GROUP BY ALL"


def monthly(t: Tables) -> DataFrame:
    l = t.lineitem.where(F.year("l_shipdate") == 1995)
    return l.groupBy((F.col("l_partkey") % 200).alias("id"), F.date_format("l_shipdate", "MM").alias("label")).agg(F.round(F.avg("l_discount"), 6).alias("d"), F.round(F.median("l_quantity"), 4).alias("q"))


_WIDE = f"WITH l AS ({_LONG}), w AS (SELECT id, " + ", ".join(f'max(d) FILTER (label = \'{m}\') AS "d__{m}", max(q) FILTER (label = \'{m}\') AS "q__{m}"' for m in _MONTHS) + " FROM l GROUP BY id) "


def wide(t: Tables) -> DataFrame:
    return reshape.widen(monthly(t), ["id"], "label", ["d", "q"], _MONTHS)


@query(_WIDE + "SELECT * FROM w")
def pivot_period_features(t: Tables) -> DataFrame:
    return wide(t)


_LIST = "list_filter([" + ", ".join(f'"q__{m}"' for m in _MONTHS) + "], lambda x: x IS NOT NULL)"


@query(_WIDE + f"SELECT id, round(list_avg(a), 6) AS q_mean, list_min(a) AS q_min, list_max(a) AS q_max, round(list_stddev_pop(a), 6) AS q_std FROM (SELECT id, {_LIST} AS a FROM w)")
def annual_reduce(t: Tables) -> DataFrame:
    return reshape.annual(wide(t), ["id"], [f"q__{m}" for m in _MONTHS], "q").select("id", F.round("q_mean", 6).alias("q_mean"), "q_min", "q_max", F.round("q_std", 6).alias("q_std"))


@query(_WIDE + ", u AS (UNPIVOT (SELECT id % 4 AS class, " + ", ".join(f'"q__{m}"' for m in _MONTHS) + " FROM w WHERE id % 4 <> 3) ON COLUMNS('q__.*') INTO NAME feature VALUE v) SELECT class, substr(feature, 4) AS month, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS q25, round(median(v), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max, count(v) AS n FROM u GROUP BY ALL")
def melt_phenology(t: Tables) -> DataFrame:
    w = wide(t).where("id % 4 <> 3").withColumn("class", F.col("id") % 4)
    m = reshape.melt(w, ["class"], [f"q__{x}" for x in _MONTHS], "feature", "v").where("v is not null")
    p = lambda q: F.round(F.percentile("v", F.lit(q)), 6)
    return m.groupBy("class", F.regexp_extract("feature", r"__(\d+)$", 1).alias("month")).agg(F.min("v").alias("min"), p(0.25).alias("q25"), p(0.5).alias("median"), p(0.75).alias("q75"), F.max("v").alias("max"), F.count("v").alias("n"))


@query(f"WITH l AS ({_LONG}), m AS (SELECT id % 4 AS class, label, median(q) AS v FROM l GROUP BY ALL) SELECT class, arg_max(label, (v, label)) AS peak, arg_min(label, (v, label)) AS low, round(max(v), 6) AS highest, round(min(v), 6) AS lowest FROM m GROUP BY class")
def seasonal_peak(t: Tables) -> DataFrame:
    m = monthly(t).groupBy((F.col("id") % 4).alias("class"), "label").agg(F.median("q").alias("v"))
    return m.groupBy("class").agg(F.max_by("label", F.struct("v", "label")).alias("peak"), F.min_by("label", F.struct("v", "label")).alias("low"), F.round(F.max("v"), 6).alias("highest"), F.round(F.min("v"), 6).alias("lowest"))


@query("SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def contingency_table(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("SELECT s_suppkey AS id, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def union_by_name(t: Tables) -> DataFrame:
    return reshape.align([t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")), t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))])


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_difference(t: Tables) -> DataFrame:
    return t.part.select("p_partkey").subtract(t.lineitem.where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")))


@query("SELECT l_partkey FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size < 10")
def set_intersection(t: Tables) -> DataFrame:
    return t.lineitem.where("l_quantity > 45").select("l_partkey").intersect(t.part.where("p_size < 10").select(F.col("p_partkey").alias("l_partkey")))


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY o_custkey")
def dedup_first(t: Tables) -> DataFrame:
    return reshape.first_of(t.orders.select("o_custkey", F.col("o_orderkey").alias("first_order"), "o_orderdate"), ["o_custkey"], ["o_orderdate", "first_order"]).select("o_custkey", "first_order")


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1 AS is_duplicate FROM orders")
def duplicate_flags(t: Tables) -> DataFrame:
    return reshape.dedup_flags(t.orders, ["o_custkey", "o_orderpriority"]).select("o_orderkey", "is_duplicate")


@query("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def grain_violations(t: Tables) -> DataFrame:
    return reshape.check_grain(t.orders, ["o_custkey", "o_orderpriority"])


@query("WITH g AS (SELECT o_custkey, count(DISTINCT o_orderstatus) AS a, count(DISTINCT o_orderpriority) AS b FROM orders GROUP BY 1) SELECT 'o_orderstatus' AS column_name, count(*) FILTER (a > 1) AS keys_varying FROM g UNION ALL SELECT 'o_orderpriority', count(*) FILTER (b > 1) FROM g")
def static_invariance(t: Tables) -> DataFrame:
    return reshape.varying(t.orders, ["o_custkey"], ["o_orderstatus", "o_orderpriority"])


@query("WITH p AS (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT -1), n AS (SELECT c_custkey, count(*) AS n FROM p GROUP BY 1) SELECT coalesce(n.c_custkey, c.c_custkey) AS c_custkey, CASE WHEN n IS NULL THEN 'missing' WHEN c.c_custkey IS NULL THEN 'unknown' ELSE 'doubled' END AS error FROM n FULL JOIN customer c ON n.c_custkey = c.c_custkey WHERE n IS NULL OR c.c_custkey IS NULL OR n > 1")
def exact_cover_check(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey")
    parts = c.where("c_custkey % 3 <> 0").unionAll(c.where("c_custkey % 5 = 0")).unionAll(t.spark.range(-1, 0).select(F.col("id").alias("c_custkey")))
    return reshape.cover_errors(parts, c, "c_custkey")


_BINS = reshape.periods("1995-01-31", "1995-12-10", "1M")


@query("WITH b(lo, hi) AS (VALUES " + ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in _BINS) + ") SELECT CAST(lo AS VARCHAR) AS period_start, CAST(hi AS VARCHAR) AS period_end, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders JOIN b ON o_orderdate >= lo AND o_orderdate < hi GROUP BY lo, hi")
def temporal_bins(t: Tables) -> DataFrame:
    from ..operators import joins

    b = t.spark.createDataFrame(_BINS, "period_start string, period_end string")
    b = b.withColumn("_lo", F.unix_date(F.col("period_start").cast("date"))).withColumn("_hi", F.unix_date(F.col("period_end").cast("date")))
    o = t.orders.select(F.unix_date(F.col("o_orderdate").cast("date")).alias("_d"), "o_totalprice")
    return joins.interval(o, b, "_d", "_lo", "_hi", 31.0).groupBy("period_start", "period_end").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS m FROM orders), g AS (SELECT o_custkey, count(*) AS n, count(DISTINCT m) AS months, CAST(date_diff('month', min(m), max(m)) + 1 AS BIGINT) AS expected FROM m GROUP BY 1) SELECT * FROM g WHERE n <> months OR months <> expected")
def month_continuity(t: Tables) -> DataFrame:
    return reshape.month_gaps(t.orders, ["o_custkey"], "o_orderdate")


@query("WITH c AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, n_name) AS rk FROM c) SELECT CASE WHEN rk <= 12 THEN n_name ELSE 'Other' END AS n_name, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1")
def category_lumping(t: Tables) -> DataFrame:
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name")
    return order.lump(c, "n_name", 12).groupBy("n_name").agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT p_partkey, p_brand, (rank() OVER (PARTITION BY p_brand ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0) / count(*) OVER (PARTITION BY p_brand) AS pr FROM part) SELECT p_partkey, round(pr, 8) AS pct_rank FROM r")
def percent_rank_pct(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(order.percent_rank_mean(["p_brand"], F.col("p_size")), 8).alias("pct_rank"))


@query("SELECT p_type, p_partkey, p_retailprice, CAST(rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS INT) AS rk FROM part QUALIFY rk <= 3")
def topk_per_group(t: Tables) -> DataFrame:
    w = Window.partitionBy("p_type").orderBy(F.desc("p_retailprice"))
    return t.part.withColumn("rk", F.rank().over(w)).where("rk <= 3").select("p_type", "p_partkey", "p_retailprice", "rk")


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id FROM events ORDER BY event_id DESC LIMIT 200) ORDER BY event_id")
def tail_query(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id").orderBy(F.desc("event_id")).limit(200).orderBy("event_id")


@query("SELECT event_id FROM events WHERE event_id > 500 ORDER BY event_id LIMIT 200")
def cursor_query(t: Tables) -> DataFrame:
    return t.events.where("event_id > 500").select("event_id").orderBy("event_id").limit(200)


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS has_pending FROM customer")
def exists_flag(t: Tables) -> DataFrame:
    live = t.orders.where("o_orderstatus = 'P'").select("o_custkey").distinct().withColumn("_x", F.lit(True))
    return t.customer.join(live, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("_x").isNotNull().alias("has_pending"))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest FROM orders GROUP BY 1")
def latest_per_target(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"))


@query("WITH new AS (SELECT c_custkey, c_acctbal + 1 AS b FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT -c_custkey, 0 FROM customer WHERE c_custkey <= 3) SELECT c_custkey, round(b, 4) AS balance FROM new UNION ALL SELECT c_custkey, round(c_acctbal, 4) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.c_custkey = c.c_custkey)")
def upsert(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", F.col("c_acctbal").alias("b"))
    new = c.where("c_custkey % 4 = 0").withColumn("b", F.col("b") + 1).unionAll(c.where("c_custkey <= 3").select(-F.col("c_custkey"), F.lit(0.0)))
    return new.unionAll(c.join(new, "c_custkey", "left_anti")).select("c_custkey", F.round("b", 4).alias("balance"))


@query("SELECT user_id, CAST(floor(epoch(ts) / 900) AS BIGINT) AS slot, count(*) AS attempts, count(*) > 2 AS blocked FROM events GROUP BY ALL")
def throttle_window(t: Tables) -> DataFrame:
    slot = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 900)
    return t.events.groupBy("user_id", slot.alias("slot")).agg(F.count("*").alias("attempts"), (F.count("*") > 2).alias("blocked"))


@query("SELECT split, o_orderpriority AS model, round(avg(o_totalprice), 4) AS score FROM (SELECT 'train' AS split, * FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT 'test', * FROM orders WHERE o_orderkey % 5 = 0) WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL")
def metrics_union(t: Tables) -> DataFrame:
    o = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    both = o.where("o_orderkey % 5 <> 0").withColumn("split", F.lit("train")).unionByName(o.where("o_orderkey % 5 = 0").withColumn("split", F.lit("test")))
    return both.groupBy("split", F.col("o_orderpriority").alias("model")).agg(F.round(F.avg("o_totalprice"), 4).alias("score"))


@query("WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY (o_orderkey * 7919) % 10007, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) SELECT o_orderkey, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split, CAST((rn - 1) % 5 AS INT) AS fold FROM r")
def stratified_holdout(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_orderpriority")
    r = t.orders.withColumn("rn", F.row_number().over(w.orderBy((F.col("o_orderkey") * 7919) % 10007, "o_orderkey"))).withColumn("n", F.count("*").over(w))
    return r.select("o_orderkey", F.when(F.col("rn") <= F.round(F.col("n") * 0.2), "test").otherwise("train").alias("split"), ((F.col("rn") - 1) % 5).cast("int").alias("fold"))


@query("WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), f AS (SELECT c_nationkey, CAST((row_number() OVER (ORDER BY n DESC, c_nationkey) - 1) % 5 AS INT) AS fold FROM c) SELECT c_custkey, fold FROM customer JOIN f USING (c_nationkey)")
def spatial_folds(t: Tables) -> DataFrame:
    cells = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    f = cells.withColumn("fold", ((F.row_number().over(Window.orderBy(F.desc("n"), "c_nationkey")) - 1) % 5).cast("int")).drop("n")  # a row for each cell
    return t.customer.join(f, "c_nationkey").select("c_custkey", "fold")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events")
def json_flatten(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))
