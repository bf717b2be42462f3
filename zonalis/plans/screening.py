"""Queries of input contracts, masks, labels and report counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import screening
from .registry import Tables, query

_HOLED = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS priority, CAST(NULL AS DOUBLE) AS nothing, o_orderkey % 13 = 0 AS outlier FROM orders"


def _holed(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"), F.when(k % 11 != 0, F.col("o_orderpriority")).alias("priority"), F.lit(None).cast("double").alias("nothing"), (k % 13 == 0).alias("outlier"))


@query("SELECT CASE WHEN x = 0 THEN 'id_not_unique' ELSE 'class_too_small' END AS rule, detail, n FROM (SELECT 0 AS x, '' AS detail, count(*) AS n FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0 UNION ALL SELECT 1, c_mktsegment, count(*) FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 2 HAVING count(*) < (SELECT count(*) / 5 FROM customer) ) ")
def input_contract(t: Tables) -> DataFrame:
    folds = -(-t.customer.count() // 5)
    return screening.contract_violations(screening.require_columns(t.customer, ["c_nationkey", "c_mktsegment"]), "c_nationkey", "c_mktsegment", folds)


@query(f"SELECT o_orderkey, price IS NULL OR priority IS NULL AS has_null, coalesce(outlier, false) AS excluded, priority IS NOT NULL AND NOT coalesce(outlier, false) AS trains FROM ({_HOLED})")
def training_masks(t: Tables) -> DataFrame:
    d = screening.flag_null_rows(_holed(t), ["price", "priority", "nothing"])
    d = screening.flag_outlier_rows(d, "outlier")
    return d.select("o_orderkey", "has_null", "excluded", screening.training_mask("priority", "excluded").alias("trains"))


@query(f"WITH h AS (SELECT *, 1 AS one FROM ({_HOLED})) SELECT * FROM (SELECT 'price' AS column_name, count(price) AS non_null, count(DISTINCT price) AS n_distinct, count(DISTINCT price) > 1 AS active FROM h UNION ALL SELECT 'priority', count(priority), count(DISTINCT priority), count(DISTINCT priority) > 1 FROM h UNION ALL SELECT 'nothing', count(nothing), count(DISTINCT nothing), false FROM h UNION ALL SELECT 'one', count(one), count(DISTINCT one), false FROM h)")
def active_features(t: Tables) -> DataFrame:
    return screening.active_features(_holed(t).withColumn("one", F.lit(1)), ["price", "priority", "nothing", "one"])


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE NOT (p_brand IN ('Brand#11', '7', '7.0') OR p_size IN (7, 12))")
def target_exclusion(t: Tables) -> DataFrame:
    values = ["Brand#11", "7", "12.0"]
    return t.part.where(~screening.excluded_targets("p_brand", values) & ~screening.excluded_targets("p_size", values)).select("p_partkey", "p_brand", "p_size")


_EVIDENCE = "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'kruskal_epsilon_squared' ELSE 'cramers_v' END AS method, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity / 60 END AS effect, l_discount AS q, CASE WHEN l_tax > 0.07 THEN NULL ELSE l_tax * 200 END AS v FROM lineitem"


@query(f"WITH e AS ({_EVIDENCE}), s AS (SELECT *, CASE WHEN effect IS NULL THEN 'unavailable' WHEN method = 'kruskal_epsilon_squared' THEN CASE WHEN effect >= 0.14 THEN 'large' WHEN effect >= 0.06 THEN 'moderate' WHEN effect >= 0.01 THEN 'small' ELSE 'negligible' END WHEN effect >= 0.5 THEN 'strong' WHEN effect >= 0.3 THEN 'moderate' WHEN effect >= 0.1 THEN 'weak' ELSE 'negligible' END AS strength FROM e) SELECT strength, CASE WHEN strength IN ('strong', 'large', 'moderate') AND q <= 0.05 THEN 'priority candidate; validate with cross-validation and redundancy checks' WHEN strength IN ('strong', 'large', 'moderate') THEN 'meaningful effect; statistical evidence is limited' WHEN q <= 0.05 THEN 'statistically detectable but weak univariate effect' ELSE 'limited univariate evidence' END AS note, CASE WHEN v IS NULL THEN 'not_available' WHEN v >= 10 THEN 'high_multicollinearity' WHEN v >= 5 THEN 'moderate_multicollinearity' ELSE 'low_multicollinearity' END AS vif, count(*) AS n FROM s GROUP BY ALL")
def evidence_labels(t: Tables) -> DataFrame:
    l = t.lineitem
    e = l.select(F.when(F.col("l_linenumber") % 2 == 0, "kruskal_epsilon_squared").otherwise("cramers_v").alias("method"), F.when(F.col("l_quantity") <= 45, F.col("l_quantity") / 60).alias("effect"), F.col("l_discount").alias("q"), F.when(F.col("l_tax") <= 0.07, F.col("l_tax") * 200).alias("v"))
    e = e.withColumn("strength", screening.effect_label(F.col("method"), F.col("effect")))
    return e.groupBy("strength", screening.selection_note(F.col("strength"), F.col("q")).alias("note"), screening.vif_label(F.col("v")).alias("vif")).agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus AS status, CASE WHEN count(*) FILTER (o_totalprice > 1e9) = 0 THEN 0.0 ELSE round(100 * count(*) / count(*) FILTER (o_totalprice > 1e9), 4) END AS none, round(100 * count(*) FILTER (o_orderpriority = '1-URGENT') / count(*), 4) AS urgent_pct FROM orders GROUP BY 1")
def safe_percent(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(screening.safe_percent(F.count("*"), F.count_if(F.col("o_totalprice") > 1e9)).alias("none"), screening.safe_percent(F.count_if(F.col("o_orderpriority") == "1-URGENT"), F.count("*")).alias("urgent_pct"))


_VALUES = "SELECT CASE WHEN o_orderkey % 100 < 97 THEN 'a' ELSE 'b' END AS quasi, CASE WHEN o_orderkey % 10 < 7 THEN 'common' ELSE CAST(o_orderkey AS VARCHAR) END AS rare, o_orderpriority AS plain FROM orders"


def _flag_sql(c: str) -> str:
    return f"SELECT '{c}' AS column_name, n, v, sum(n) OVER () AS rows_ FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM x GROUP BY 1)"


@query(f"WITH x AS ({_VALUES}), c AS (" + " UNION ALL ".join(map(_flag_sql, ("quasi", "rare", "plain"))) + "), s AS (SELECT column_name, max(n) / sum(n) AS top, count(*) AS d, count(*) FILTER (n <= greatest(1, floor(0.01 * rows_))) / count(*) AS heavy FROM c WHERE v IS NOT NULL GROUP BY 1) SELECT column_name, 'quasi_constant' AS flag, round(top, 6) AS ratio FROM s WHERE d > 1 AND top >= 0.95 UNION ALL SELECT column_name, 'rare_category_heavy', round(heavy, 6) FROM s WHERE d >= 5 AND heavy >= 0.5")
def value_flags(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    x = t.orders.select(F.when(k % 100 < 97, "a").otherwise("b").alias("quasi"), F.when(k % 10 < 7, "common").otherwise(k.cast("string")).alias("rare"), F.col("o_orderpriority").alias("plain"))
    return screening.value_flags(x, ["quasi", "rare", "plain"]).withColumn("ratio", F.round("ratio", 6))


_SCORES = "SELECT 'm' || (l_suppkey % 6) AS model, l_linenumber AS fold, avg(l_discount) AS score FROM lineitem GROUP BY ALL"


def _scores(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.concat(F.lit("m"), F.col("l_suppkey") % 6).alias("model"), F.col("l_linenumber").alias("fold")).agg(F.avg("l_discount").alias("score"))


@query(f"WITH s AS ({_SCORES}), a AS (SELECT model, avg(score) AS m, stddev_pop(score) AS d FROM s GROUP BY 1) SELECT model, round(m, 8) AS mean_score, round(d, 8) AS std_score, round(m - d, 8) AS ranking, CAST(row_number() OVER (ORDER BY model = 'm3', m - d DESC, m DESC, model) AS INT) AS rank FROM a")
def model_ranking(t: Tables) -> DataFrame:
    return screening.model_ranking(_scores(t), "model", "score", last="m3").select("model", *[F.round(c, 8).alias(c) for c in ("mean_score", "std_score", "ranking")], "rank")


@query(f"WITH s AS ({_SCORES}) SELECT model AS seed, count(*) AS runs, round(avg(score), 8) AS mean, round(stddev_samp(score), 8) AS std, round(min(score), 8) AS least, round(max(score), 8) AS greatest FROM s GROUP BY 1")
def seed_sensitivity(t: Tables) -> DataFrame:
    r = lambda c, a: F.round(c, 8).alias(a)
    return _scores(t).groupBy(F.col("model").alias("seed")).agg(F.count("*").alias("runs"), r(F.avg("score"), "mean"), r(F.stddev_samp("score"), "std"), r(F.min("score"), "least"), r(F.max("score"), "greatest"))


@query("WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem), b AS (SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 20), 19) AS INT) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1) SELECT CAST(g AS INT) AS bin, round(lo + g * (hi - lo) / 20, 4) AS lower, round(lo + (g + 1) * (hi - lo) / 20, 4) AS upper, coalesce(n, 0) AS n FROM range(20) r(g) CROSS JOIN e LEFT JOIN b ON b.bin = g")
def histogram_bins(t: Tables) -> DataFrame:
    return screening.histogram(t.lineitem, "l_extendedprice", 20).select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


@query("WITH q AS (SELECT l_returnflag AS flag, quantile_cont(l_extendedprice, 0.25) AS q1, median(l_extendedprice) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1), m AS (SELECT q.*, l_extendedprice AS x, l_extendedprice BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1) AS inner_ FROM lineitem JOIN q ON l_returnflag = flag) SELECT flag, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3, min(x) FILTER (inner_) AS whisker_low, max(x) FILTER (inner_) AS whisker_high, count(*) FILTER (NOT inner_) AS n_outside FROM m GROUP BY flag")
def box_plots(t: Tables) -> DataFrame:
    b = screening.box_plot(t.lineitem.withColumnRenamed("l_returnflag", "flag"), "flag", "l_extendedprice", 0.5)
    return b.select("flag", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high", "n_outside")


def _top(c: str, i: int) -> str:
    return f"k{i} AS (SELECT v FROM (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) AS k FROM f GROUP BY 1) WHERE k <= 3)"


@query("WITH f AS (SELECT o_orderpriority AS a, o_orderstatus AS b, CAST(month(o_orderdate) AS VARCHAR) AS c, CAST(o_custkey % 7 AS VARCHAR) AS d FROM orders), " + ", ".join(_top(c, i) for i, c in enumerate("abcd")) + ", r AS (SELECT " + ", ".join(f"CASE WHEN {c} IN (SELECT v FROM k{i}) THEN {c} ELSE 'Other' END AS {c}" for i, c in enumerate("abcd")) + " FROM f) SELECT 0 AS step, a AS source, b AS target, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 1, b, c, count(*) FROM r GROUP BY ALL UNION ALL SELECT 2, c, d, count(*) FROM r GROUP BY ALL")
def sankey_flows(t: Tables) -> DataFrame:
    f = t.orders.select(F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("b"), F.month("o_orderdate").cast("string").alias("c"), (F.col("o_custkey") % 7).cast("string").alias("d"))
    return screening.flows(f, ["a", "b", "c", "d"], top=3)


@query("SELECT DISTINCT l_returnflag AS flag, l_quantity AS value, round(cume_dist() OVER (PARTITION BY l_returnflag ORDER BY l_quantity), 8) AS share FROM lineitem")
def ecdf_by_group(t: Tables) -> DataFrame:
    e = screening.ecdf(t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("value")), "flag", "value")
    return e.withColumn("share", F.round("share", 8))


@query("SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS x_bin, CAST(floor(l_discount * 100 / 5) AS BIGINT) AS y_bin, round(avg(l_tax), 8) AS mean_error, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 20")
def binned_error(t: Tables) -> DataFrame:
    d = t.lineitem.select(F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), "l_tax")
    return screening.binned_error(d, "x", "y", "l_tax", 5.0, 20).withColumn("mean_error", F.round("mean_error", 8))


@query("SELECT status, priority, n, round(n / sum(n) OVER (PARTITION BY status), 8) AS share FROM (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL)")
def row_shares(t: Tables) -> DataFrame:
    return screening.shares(t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")), "status", "priority").withColumn("share", F.round("share", 8))


@query("WITH s AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS part, o_orderpriority AS label, count(*) AS n FROM orders GROUP BY ALL), w AS (SELECT *, n / sum(n) OVER (PARTITION BY part) AS share FROM s) SELECT label, round(max(share) FILTER (part = 'train'), 8) AS train, round(max(share) FILTER (part = 'test'), 8) AS test, round(max(share) FILTER (part = 'train') - max(share) FILTER (part = 'test'), 8) AS gap FROM w GROUP BY label")
def split_shares(t: Tables) -> DataFrame:
    s = screening.shares(t.orders.select(F.when(F.col("o_orderkey") % 4 == 0, "test").otherwise("train").alias("part"), F.col("o_orderpriority").alias("label")), "part", "label")
    p = s.groupBy("label").pivot("part", ["train", "test"]).agg(F.max("share"))
    return p.select("label", F.round("train", 8).alias("train"), F.round("test", 8).alias("test"), F.round(F.col("train") - F.col("test"), 8).alias("gap"))


@query("SELECT l_returnflag AS confidence, round(median(l_extendedprice) FILTER (l_linestatus = 'F'), 4) AS \"F\", round(median(l_extendedprice) FILTER (l_linestatus = 'O'), 4) AS \"O\" FROM lineitem GROUP BY 1")
def median_pivot(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_returnflag").alias("confidence")).pivot("l_linestatus", ["F", "O"]).agg(F.round(F.median("l_extendedprice"), 4))


@query("SELECT CAST(ceil(max(sqrt(pow(l_quantity, 2) + pow(l_discount * 100, 2))) * 2.5 / 50) * 50 AS BIGINT) AS buffer FROM lineitem")
def tile_buffer(t: Tables) -> DataFrame:
    return t.lineitem.agg((F.ceil(F.max(F.hypot("l_quantity", F.col("l_discount") * 100)) * 2.5 / 50) * 50).cast("long").alias("buffer"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '5-LOW' END AS filled, o_orderkey % 3 = 0 AS predicted_only, o_totalprice < 150000 AS review FROM orders")
def prediction_frame(t: Tables) -> DataFrame:
    d = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("target"), F.lit("5-LOW").alias("prediction"), F.col("o_totalprice").alias("confidence"))
    return d.select("o_orderkey", F.coalesce("target", "prediction").alias("filled"), F.col("target").isNull().alias("predicted_only"), (F.col("confidence") < 150000).alias("review"))


@query("SELECT grp, label, CAST(rank() OVER (PARTITION BY grp ORDER BY n DESC) AS INT) AS rank, n FROM (SELECT p_type AS grp, p_brand AS label, count(*) AS n FROM part GROUP BY ALL)")
def rank_within(t: Tables) -> DataFrame:
    n = t.part.groupBy(F.col("p_type").alias("grp"), F.col("p_brand").alias("label")).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.rank().over(Window.partitionBy("grp").orderBy(F.desc("n"))))


@query("SELECT user_id, event_id, value FROM (SELECT e.*, c_custkey, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events e JOIN customer ON user_id = c_custkey WHERE ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM events)) WHERE k = 1")
def live_sessions(t: Tables) -> DataFrame:
    """Each known user's latest event that has not expired."""
    last = t.events.agg((F.max("ts") - F.expr("INTERVAL 10 DAY")).alias("since"))
    live = t.events.crossJoin(F.broadcast(last)).where("ts >= since").join(t.customer.select(F.col("c_custkey").alias("user_id")), "user_id")  # one row
    return live.groupBy("user_id").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("e")).select("user_id", "e.event_id", "e.value")


@query("SELECT lower(c_mktsegment) AS name, count(*) AS n, coalesce(max(c_custkey), 0) + 1 AS next_id, min(c_custkey) AS first_id FROM customer GROUP BY 1")
def next_ids(t: Tables) -> DataFrame:
    return t.customer.groupBy(F.lower("c_mktsegment").alias("name")).agg(F.count("*").alias("n"), (F.coalesce(F.max("c_custkey"), F.lit(0)) + 1).alias("next_id"), F.min("c_custkey").alias("first_id"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS done, round(count(*) FILTER (value > 50) / count(*), 8) AS share FROM events GROUP BY 1")
def progress_counts(t: Tables) -> DataFrame:
    done = F.count_if(F.col("value") > 50)
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), done.alias("done"), F.round(done / F.count("*"), 8).alias("share"))
