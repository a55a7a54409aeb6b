"""Plans for aggregation, windows, time series and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.operators import aggregates as A
from dunlin.operators import sampling as Z
from dunlin.operators import timeseries as Y
from dunlin.operators import windows as W
from dunlin.plans.registry import Tables, plan
from dunlin.session import scratch_path
from dunlin.sources.writers import write_table



def rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


# ---------------------------------------------------------------- aggregation


@plan("A01_group_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(rows())


@plan("A02_group_sum_avg_min_max", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc, round(avg(l_discount), 6) AS avg_disc,
           min(l_tax) AS min_tax, max(l_shipdate) AS last_ship, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sum_disc"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_tax").alias("min_tax"),
        F.max("l_shipdate").alias("last_ship"), rows())


@plan("A03_global_range", """
    SELECT min(o_totalprice) AS minimum, max(o_totalprice) AS maximum, round(abs(max(o_totalprice) - min(o_totalprice)), 2) AS range_width,
           round(avg(o_totalprice), 4) AS mean FROM orders""")
def _(t: Tables):
    price = "o_totalprice"
    return t.orders.agg(F.min(price).alias("minimum"), F.max(price).alias("maximum"),
                        F.round(F.abs(F.max(price) - F.min(price)), 2).alias("range_width"),
                        F.round(F.avg(price), 4).alias("mean"))


@plan("A04_distinct_count", """
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def _(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"))


@plan("A05_keyed_typed_aggregate", """
    SELECT event_type AS "E", count(value) AS "A", round(avg(value), 4) AS "B", round(avg(user_id), 4) AS "C",
           round(avg(length(props)), 4) AS "D" FROM events GROUP BY 1""")
def _(t: Tables):
    return t.events.groupBy(F.col("event_type").alias("E")).agg(
        F.count("value").alias("A"), F.round(F.avg("value"), 4).alias("B"),
        F.round(F.avg("user_id"), 4).alias("C"), F.round(F.avg(F.length("props")), 4).alias("D"))


@plan("A06_share_of_total", """
    SELECT c_mktsegment, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS pct FROM customer GROUP BY 1""")
def _(t: Tables):
    return A.share_of_total(t.customer, ["c_mktsegment"])


@plan("A07_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 14")
def _(t: Tables):
    return t.orders.groupBy("o_custkey").agg(rows()).where("n > 14")


@plan("A08_count_of_counts", """
    SELECT size, count(*) AS groups FROM (SELECT count(*) AS size FROM lineitem GROUP BY l_orderkey) GROUP BY 1""")
def _(t: Tables):
    return A.count_of_counts(t.lineitem, ["l_orderkey"])


def _describe_sql(table, columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
        f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM {table}" for c in columns)


@plan("A09_describe", _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]))
def _(t: Tables):
    return A.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])


@plan("A10_variance_stddev", """
    SELECT round(var_samp(l_quantity), 6) AS variance, round(stddev_samp(l_quantity), 6) AS std_dev FROM lineitem""")
def _(t: Tables):
    return t.lineitem.agg(F.round(F.var_samp("l_quantity"), 6).alias("variance"),
                          F.round(F.stddev_samp("l_quantity"), 6).alias("std_dev"))


@plan("A11_skewness_kurtosis", """
    SELECT round(avg(pow(x - mu, 3)) / pow(avg(pow(x - mu, 2)), 1.5), 6) AS skewness,
           round(avg(pow(x - mu, 4)) / pow(avg(pow(x - mu, 2)), 2) - 3, 6) AS kurtosis
    FROM (SELECT l_quantity x, avg(l_quantity) OVER () mu FROM lineitem)""")
def _(t: Tables):
    return t.lineitem.agg(*A.moments("l_quantity"))


@plan("A12_covariance", "SELECT round(covar_samp(l_quantity, l_extendedprice), 4) AS cov FROM lineitem")
def _(t: Tables):
    return t.lineitem.agg(F.round(F.covar_samp("l_quantity", "l_extendedprice"), 4).alias("cov"))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@plan("A13_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:]))
def _(t: Tables):
    return A.correlations(t.lineitem, _CORR)


@plan("A14_crosstab", """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
           count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(t: Tables):
    return A.crosstab(t.orders, "o_orderpriority", "o_orderstatus", limit=100)


@plan("A14_crosstab_long", "SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t: Tables):
    return A.crosstab_long(t.orders, "o_custkey", "o_orderstatus")


@plan("A15_frequent_items", """
    SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 0.3 * (SELECT count(*) FROM lineitem)""")
def _(t: Tables):
    return A.frequent_items(t.lineitem, "l_returnflag", 0.3)


@plan("A16_quantiles_exact", """
    SELECT p::DOUBLE AS probability, CASE p WHEN 0.25 THEN a WHEN 0.5 THEN b WHEN 0.75 THEN c ELSE d END AS value
    FROM (VALUES (0.25), (0.5), (0.75), (0.999)) v(p), (SELECT quantile_disc(o_totalprice, 0.25) a,
      quantile_disc(o_totalprice, 0.5) b, quantile_disc(o_totalprice, 0.75) c, quantile_disc(o_totalprice, 0.999) d FROM orders)""")
def _(t: Tables):
    return A.exact_quantiles(t.orders, "o_totalprice", [0.25, 0.5, 0.75, 0.999])


@plan("A16_quantiles_approximate", """
    SELECT l_returnflag, true AS q1_ok, true AS median_ok, true AS q3_ok FROM lineitem GROUP BY 1""")
def _(t: Tables):
    lines = t.lineitem.select("l_returnflag", "l_extendedprice")
    q = lines.groupBy("l_returnflag").agg(
        F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75], 1000).alias("q"))
    placed = lines.join(q, "l_returnflag").groupBy("l_returnflag").agg(
        *[F.avg((F.col("l_extendedprice") <= F.get("q", F.lit(i))).cast("int")).alias(f"p{i}") for i in range(3)])
    return placed.select("l_returnflag", *[(F.abs(F.col(f"p{i}") - p) < 0.005).alias(n) for i, p, n in
                                           ((0, 0.25, "q1_ok"), (1, 0.5, "median_ok"), (2, 0.75, "q3_ok"))])


@plan("A17_pivot", """
    SELECT n_regionkey, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS "AUTOMOBILE", count(*) FILTER (c_mktsegment = 'BUILDING') AS "BUILDING",
      count(*) FILTER (c_mktsegment = 'FURNITURE') AS "FURNITURE", count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS "HOUSEHOLD",
      count(*) FILTER (c_mktsegment = 'MACHINERY') AS "MACHINERY" FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return A.pivot(joined, ["n_regionkey"], "c_mktsegment", [F.count("c_mktsegment")], limit=100).na.fill(0)


@plan("A18_pivot_listed_values", """
    SELECT o_orderpriority AS "Priority", round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS "F-Tot",
      round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS "F-Avg", round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS "O-Tot",
      round(avg(o_totalprice) FILTER (o_orderstatus = 'O'), 4) AS "O-Avg" FROM orders GROUP BY 1""")
def _(t: Tables):
    table = A.pivot(t.orders, ["o_orderpriority"], "o_orderstatus",
                    [F.round(F.sum("o_totalprice"), 2), F.round(F.avg("o_totalprice"), 4)], ["F", "O"])
    return table.toDF("Priority", "F-Tot", "F-Avg", "O-Tot", "O-Avg")


@plan("A19_pivot_two_keys", """
    SELECT l_returnflag, l_linestatus, round(avg(l_quantity) FILTER (l_linenumber = 1), 4) AS "1",
      round(avg(l_quantity) FILTER (l_linenumber = 2), 4) AS "2" FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    return A.pivot(t.lineitem, ["l_returnflag", "l_linestatus"], "l_linenumber",
                   [F.round(F.avg("l_quantity"), 4)], [1, 2])


_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


@plan("A20_quarter_sums", """
    SELECT o_orderstatus, count(*) FILTER (quarter(o_orderdate) = 1) AS q1, count(*) FILTER (quarter(o_orderdate) = 2) AS q2,
      count(*) FILTER (quarter(o_orderdate) = 3) AS q3, count(*) FILTER (quarter(o_orderdate) = 4) AS q4 FROM orders GROUP BY 1""")
def _(t: Tables):
    monthly = t.orders.select("o_orderstatus", F.lower(F.date_format("o_orderdate", "MMM")).alias("month"))
    wide = A.pivot(monthly, ["o_orderstatus"], "month", [F.count("month")], _MONTHS)
    return A.column_group_sums(wide, ["o_orderstatus"],
                               {f"q{i + 1}": _MONTHS[3 * i:3 * i + 3] for i in range(4)})


@plan("A21_word_count", """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1""")
def _(t: Tables):
    return t.spread("documents").select(F.explode(F.split("text", " ")).alias("word")).groupBy("word").agg(rows())


@plan("A22_count_by_key", """
    SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1""")
def _(t: Tables):
    return t.orders.groupBy("o_custkey").agg(rows())


@plan("A23_histogram", """
    WITH m AS (SELECT min(l_quantity) lo, max(l_quantity) hi FROM lineitem)
    SELECT b AS bin, (SELECT lo + (hi - lo) / 5 * (b + 0.5) FROM m) AS centroid, count(l_quantity) AS n FROM range(5) r(b)
    LEFT JOIN (SELECT least(floor((l_quantity - lo) / ((hi - lo) / 5)), 4)::BIGINT AS k, l_quantity FROM lineitem, m) ON k = b GROUP BY b""")
def _(t: Tables):
    return A.histogram(t.lineitem, "l_quantity", 5)


@plan("A24_bar_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    return t.events.groupBy("event_type").agg(rows())


@plan("A24_stacked_shares", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY l_returnflag), 4) AS share
    FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    return A.shares_within(t.lineitem, "l_returnflag", "l_linestatus")


@plan("A24_frequency_polygon", """
    SELECT l_returnflag, floor(l_quantity / 5.0) * 5.0 AS l_quantity_from, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    return A.fixed_width_bins(t.lineitem, ["l_returnflag"], {"l_quantity": 5})


@plan("A24_box_stats", """
    SELECT l_returnflag, min(l_extendedprice) AS min, max(l_extendedprice) AS max, true AS q1_ok, true AS median_ok, true AS q3_ok FROM lineitem GROUP BY 1""")
def _(t: Tables):
    # The quartiles come from a sketch: their ranks are counted and held against its error bound.
    accuracy = 1000
    box = A.approximate_five_numbers(t.lineitem, ["l_returnflag"], "l_extendedprice", accuracy)
    price, placed = F.col("l_extendedprice"), t.lineitem.select("l_returnflag", "l_extendedprice").join(box, "l_returnflag")
    near = []
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        low, high = F.avg((price < F.col(name)).cast("int")), F.avg((price <= F.col(name)).cast("int"))
        near.append(((low <= p + 1 / accuracy) & (high >= p - 1 / accuracy)).alias(f"{name}_ok"))
    return placed.groupBy("l_returnflag", "min", "max").agg(*near)


@plan("A24_density_grid", """
    SELECT floor(l_quantity / 10.0) * 10.0 AS l_quantity_from, floor(l_extendedprice / 20000.0) * 20000.0 AS l_extendedprice_from,
           count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    return A.fixed_width_bins(t.lineitem, [], {"l_quantity": 10, "l_extendedprice": 20000})


@plan("A25_text_bytes", """
    SELECT CAST(sum(strlen(text)) AS BIGINT) AS bytes, round(ln(sum(strlen(text)) / 1000000.0), 6) AS log_mb FROM documents""")
def _(t: Tables):
    size = F.sum(F.octet_length("text").cast("long"))
    return t.documents.agg(size.alias("bytes"), F.round(F.log(size / 1000000.0), 6).alias("log_mb"))


@plan("A26_monthly_rollup", """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, round(sum(l_quantity), 2) AS qty,
           round(avg(l_tax), 6) AS tax, round(sum(l_extendedprice), 2) AS price, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_tax"), 6).alias("tax"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"), rows())


@plan("A26_daily_rollup", """
    SELECT strftime(l_shipdate, '%d/%m/%Y') AS date, round(sum(l_quantity), 2) AS qty, round(avg(l_tax), 6) AS tax FROM lineitem GROUP BY 1""")
def _(t: Tables):
    return t.lineitem.groupBy(F.date_format("l_shipdate", "dd/MM/yyyy").alias("date")).agg(
        F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_tax"), 6).alias("tax"))


# -------------------------------------------------------------------- windows


@plan("W01_latest_per_key", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders) WHERE rn = 1""")
def _(t: Tables):
    latest = W.first_per_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


@plan("W02_random_k_per_stratum", """
    SELECT event_type, least(count(*), 500) AS n, least(count(*), 500) AS ids FROM events GROUP BY 1""")
def _(t: Tables):
    picked = W.random_per_stratum(t.events.select("event_id", "event_type"), ["event_type"], ["event_id"], 500, seed=3)
    return picked.groupBy("event_type").agg(rows(), F.countDistinct("event_id").alias("ids"))


@plan("W03_train_test_cut", """
    SELECT lang, least(count(*), 100) AS train, greatest(least(count(*), 150) - 100, 0) AS test, 0::BIGINT AS shared
    FROM documents GROUP BY 1""")
def _(t: Tables):
    parts = W.train_test_per_stratum(t.documents.select("doc_id", "lang"), ["lang"], ["doc_id"], 100, 150, seed=5)
    per_doc = parts.groupBy("lang", "doc_id").agg(
        F.max((F.col("part") == "train").cast("int")).alias("a"), F.max((F.col("part") == "test").cast("int")).alias("b"))
    return per_doc.groupBy("lang").agg(
        F.sum("a").cast("long").alias("train"), F.sum("b").cast("long").alias("test"),
        F.sum(F.col("a") * F.col("b")).cast("long").alias("shared"))


@plan("W04_total_over_all_rows", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS pct FROM orders GROUP BY 1, 2""")
def _(t: Tables):
    return A.share_of_total(t.orders, ["o_orderstatus", "o_orderpriority"])


_W05 = """
    WITH g AS (SELECT user_id, event_id AS i, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events), f AS (
      SELECT *, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER p AS i0, last_value(v IGNORE NULLS) OVER p AS v0,
        first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER n AS i1, first_value(v IGNORE NULLS) OVER n AS v1 FROM g
      WINDOW p AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             n AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT user_id, i, round(CASE WHEN v IS NOT NULL THEN v ELSE v0 + (v1 - v0) / (i1 - i0) * (i - i0) END, 3) AS v FROM f"""


@plan("W05_linear_fill", _W05)
def _(t: Tables):
    series = t.events.select("user_id", F.col("event_id").alias("i"),
                             F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    return Y.fill_linear(series, "user_id", "i", "v", span=100_000).select("user_id", "i", F.round("v", 3).alias("v"))


# ---------------------------------------------------------------- time series

_CAL = """cal AS (SELECT d::DATE AS day, (row_number() OVER (ORDER BY d) - 1)::INTEGER AS pos FROM
    (SELECT unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM events) WHERE isodow(d) < 6)"""


def _days(t: Tables) -> tuple[str, str]:
    """First and last day of the events table."""
    row = t.events.agg(F.min(F.to_date("ts")).alias("low"), F.max(F.to_date("ts")).alias("high")).first()
    return str(row["low"]), str(row["high"])


_GRID = f"""{_CAL}, o AS (SELECT user_id, ts::DATE AS day, avg(value) v FROM events GROUP BY 1, 2),
    g AS (SELECT k.user_id, cal.pos, cal.day, o.v FROM (SELECT DISTINCT user_id FROM events) k CROSS JOIN cal
      LEFT JOIN o ON o.user_id = k.user_id AND o.day = cal.day)"""
_FILL = f"""{_GRID}, f AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER p AS i0, last_value(v IGNORE NULLS) OVER p AS v0,
      first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER n AS i1, first_value(v IGNORE NULLS) OVER n AS v1 FROM g
      WINDOW p AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             n AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    z AS (SELECT user_id, day, CASE WHEN v IS NOT NULL THEN v ELSE v0 + (v1 - v0) / (i1 - i0) * (pos - i0) END AS v FROM f)"""


@plan("Y01_business_day_index", f"""WITH {_CAL} SELECT pos, day, (SELECT count(*) FROM events WHERE ts::DATE = day) AS n FROM cal""")
def _(t: Tables):
    seen = t.events.groupBy(F.to_date("ts").alias("day")).agg(rows())
    index = Y.business_day_index(t.spark, *_days(t))
    return index.join(seen, "day", "left").select("pos", "day", F.coalesce("n", F.lit(0)).alias("n"))


@plan("Y02_aligned_series", f"WITH {_GRID} SELECT user_id, pos, day, round(v, 5) AS value FROM g")
def _(t: Tables):
    aligned = Y.align(t.events, "user_id", "ts", "value", *_days(t))
    return aligned.select("user_id", "pos", "day", F.round("value", 5).alias("value"))


@plan("Y03_linear_fill", f"WITH {_FILL} SELECT user_id, day, round(v, 7) AS value FROM z")
def _(t: Tables):
    filled = Y.fill_linear(Y.align(t.events, "user_id", "ts", "value", *_days(t)), "user_id")
    return filled.select("user_id", "day", F.round("value", 7).alias("value"))


@plan("Y04_series_stats", f"""WITH {_FILL} SELECT user_id, count(v) AS n, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS stdev,
    round(max(v), 4) AS max, round(min(v), 4) AS min FROM z GROUP BY 1""")
def _(t: Tables):
    return Y.series_stats(Y.fill_linear(Y.align(t.events, "user_id", "ts", "value", *_days(t)), "user_id"), "user_id")


@plan("Y05_series_from_many_files", """
    SELECT event_type AS ticker, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def _(t: Tables):
    header = "year,month,day,value"
    ts = F.col("ts")
    lines = t.events.select(F.col("event_type").alias("ticker"),
                            F.concat_ws(",", F.year(ts), F.month(ts), F.dayofmonth(ts), F.col("value")).alias("value"))
    heads = t.events.select(F.col("event_type").alias("ticker"), F.lit(header).alias("value")).distinct()
    path = scratch_path(t.spark, "y05")
    write_table(lines.union(heads), path, "text", partition_by=["ticker"], max_records_per_file=5_000_000)
    series = Y.load_series(t.spark, path, header, "ticker=([^/]+)/")
    return series.groupBy("ticker", "ts").agg(rows(), F.round(F.sum("value"), 2).alias("total"))


# ------------------------------------------------------------------- sampling


@plan("Z01_bernoulli_sample", "SELECT true AS size_ok, 0::BIGINT AS strangers, 0::BIGINT AS repeats")
def _(t: Tables):
    orders = t.orders.select("o_orderkey")
    picked = orders.sample(False, 0.1, 11).select("o_orderkey", F.lit(1).alias("hit"))
    seen = orders.select("o_orderkey", F.lit(0).alias("hit")).union(picked).groupBy("o_orderkey").agg(
        F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("all"))
    return seen.agg(
        F.sum("hits").between(0.08 * F.count(F.lit(1)), 0.12 * F.count(F.lit(1))).alias("size_ok"),
        F.count_if(F.col("all") == F.col("hits")).alias("strangers"), F.count_if(F.col("hits") > 1).alias("repeats"))


@plan("Z02_sample_with_replacement", "SELECT true AS size_ok, true AS has_repeats")
def _(t: Tables):
    picked = t.orders.select("o_orderkey").sample(True, 0.5, 5).groupBy("o_orderkey").agg(rows())
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    return picked.agg(F.sum("n").between(0.45 * total, 0.55 * total).alias("size_ok"),
                      (F.max("n") > 1).alias("has_repeats"))


_FRACTIONS = {"F": 0.1, "O": 0.5, "P": 0.25}


@plan("Z03_stratified_sample", "SELECT o_orderstatus, true AS size_ok FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1")
def _(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    picked = orders.sampleBy("o_orderstatus", {"F": 0.1, "P": 0.5}, 36)
    share = {"F": 0.1, "P": 0.5}
    sizes = orders.groupBy("o_orderstatus").agg(rows("size"))
    got = picked.groupBy("o_orderstatus").agg(rows())
    want = F.when(F.col("o_orderstatus") == "F", share["F"]).otherwise(share["P"])
    return got.join(sizes, "o_orderstatus").select(
        "o_orderstatus", (F.abs(F.col("n") / F.col("size") - want) < 0.03).alias("size_ok"))


@plan("Z04_keyed_with_replacement", "SELECT o_orderstatus, true AS size_ok, true AS repeats FROM orders GROUP BY 1")
def _(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    picked = Z.keyed_with_replacement(orders, "o_orderstatus", _FRACTIONS, seed=1)
    per_key = picked.groupBy("o_orderstatus", "o_orderkey").agg(rows())
    got = per_key.groupBy("o_orderstatus").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    sizes = orders.groupBy("o_orderstatus").agg(rows("size"))
    want = F.when(F.col("o_orderstatus") == "F", 0.1).when(F.col("o_orderstatus") == "O", 0.5).otherwise(0.25)
    return got.join(sizes, "o_orderstatus").select(
        "o_orderstatus", (F.abs(F.col("n") / F.col("size") - want) < 0.05).alias("size_ok"),
        (F.col("most") > 1).alias("repeats"))


@plan("Z05_exact_stratified_sample", """
    SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN ceil(0.1 * count(*)) WHEN 'O' THEN ceil(0.5 * count(*))
      ELSE ceil(0.25 * count(*)) END::BIGINT AS n FROM orders GROUP BY 1""")
def _(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return (Z.exact_stratified(orders, "o_orderstatus", _FRACTIONS, ["o_orderkey"], seed=9)
            .groupBy("o_orderstatus").agg(F.countDistinct("o_orderkey").alias("n")))


@plan("Z06_random_split", "SELECT count(*) AS rows, count(*) AS keys, true AS sizes_ok FROM orders")
def _(t: Tables):
    train, test = Z.split_by_weight(t.orders.select("o_orderkey"), [0.7, 0.3], ["o_orderkey"], seed=11)
    both = train.withColumn("train", F.lit(1)).union(test.withColumn("train", F.lit(0)))
    per_key = both.groupBy("o_orderkey").agg(rows(), F.sum("train").alias("train"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       (F.abs(F.sum("train") / F.sum("n") - 0.7) < 0.03).alias("sizes_ok"))


@plan("Z07_holdout_by_difference", """
    SELECT count(*) AS n FROM (SELECT c_nationkey, c_mktsegment FROM customer EXCEPT
      SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0)""")
def _(t: Tables):
    table = t.customer.select("c_nationkey", "c_mktsegment", "c_acctbal")
    sample = table.where("c_acctbal < 0").drop("c_acctbal")
    return Z.holdout(table.drop("c_acctbal"), sample).agg(rows())
