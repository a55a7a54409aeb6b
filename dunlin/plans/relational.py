"""Plans for projections, filters, joins, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dunlin.operators import relational as R
from dunlin.plans.registry import Tables, plan
from dunlin.session import broadcast_if_bounded, materialize_by

# ---------------------------------------------------------------- projections


@plan("P01_select", "SELECT c_custkey, c_name, c_acctbal * 2 AS doubled FROM customer")
def _(t: Tables):
    return t.customer.select("c_custkey", "c_name", (F.col("c_acctbal") * 2).alias("doubled"))


@plan("P02_select_expr", """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, upper(p_name) AS upper_name,
           p_size % 7 AS size_mod FROM part""")
def _(t: Tables):
    return t.part.selectExpr("*", "upper(p_name) AS upper_name", "p_size % 7 AS size_mod")


@plan("P03_add_replace_column", """
    SELECT o_orderkey, round(o_totalprice / 1000, 5) AS o_totalprice,
           upper(o_orderpriority) AS priority FROM orders""")
def _(t: Tables):
    return (t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
            .withColumns({"priority": F.upper("o_orderpriority"),
                          "o_totalprice": F.round(F.col("o_totalprice") / 1000, 5)})
            .drop("o_orderpriority"))


@plan("P04_drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _(t: Tables):
    return t.customer.drop("c_name", "c_acctbal")


@plan("P05_rename_columns", "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def _(t: Tables):
    renamed = R.rename_columns(t.supplier, {"s_suppkey": "id", "s_name": "name"})
    return renamed.toDF("id", "name", "nation", "balance")


@plan("P06_cast", """
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_double, CAST(p_partkey AS VARCHAR) AS key_text,
           TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS brand_no,
           TRY_CAST(p_name AS INTEGER) AS bad FROM part""")
def _(t: Tables):
    return t.part.select(
        "p_partkey",
        F.col("p_size").cast("double").alias("size_double"),
        F.col("p_partkey").cast("string").alias("key_text"),
        F.regexp_extract("p_brand", "[0-9]+", 0).try_cast("int").alias("brand_no"),
        F.col("p_name").try_cast("int").alias("bad"))


@plan("P07_filter_predicates", """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity < 24 AND l_discount >= 0.05 AND l_returnflag != 'N' AND l_linestatus = 'F' AND l_tax > 0.01""")
def _(t: Tables):
    return (t.lineitem
            .filter((F.col("l_quantity") < 24) & (F.col("l_discount") >= 0.05))
            .where("l_returnflag != 'N' AND l_linestatus = 'F'")
            .filter(F.col("l_tax") > 0.01)
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@plan("P08_range_predicate", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_totalprice <= 200000")
def _(t: Tables):
    return (t.orders.filter(R.in_range(F.col("o_totalprice"), 100000.0, 200000.0))
            .select("o_orderkey", "o_totalprice"))


@plan("P09_nested_not_null", """
    SELECT event_id, k FROM (SELECT event_id, CAST(props ->> 'k' AS INTEGER) AS k FROM events) WHERE k IS NOT NULL""")
def _(t: Tables):
    parsed = t.events.select("event_id", F.from_json("props", "k INT").alias("data"))
    return parsed.where(F.col("data.k").isNotNull()).select("event_id", F.col("data.k").alias("k"))


@plan("P10_typed_filter_map", """
    SELECT event_id, user_id, CAST(floor(value) AS BIGINT) AS whole FROM events WHERE event_type = 'purchase'""")
def _(t: Tables):
    return (t.events.filter(F.col("event_type") == "purchase")
            .select("event_id", "user_id", F.floor("value").alias("whole")))


@plan("P11_conditional_value", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_building FROM customer""")
def _(t: Tables):
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high").alias("band"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("is_building"))


@plan("P12_filter_dropped_column", """
    SELECT l_orderkey AS src, l_partkey AS dst FROM lineitem, part
    WHERE l_partkey = p_partkey AND p_retailprice < 950""")
def _(t: Tables):
    edges = R.join_on(t.lineitem.select("l_orderkey", "l_partkey"),
                      t.part.select("p_partkey", "p_retailprice"), {"l_partkey": "p_partkey"})
    return (edges.filter(F.col("p_retailprice") < 950)
            .select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")))


@plan("P13_columns_by_position", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem")
def _(t: Tables):
    return R.columns_at(t.lineitem, [1, 3, 5])


@plan("P14_struct_star", "SELECT c_name, c_mktsegment, c_nationkey FROM customer")
def _(t: Tables):
    packed = t.customer.select(F.struct("c_name", "c_mktsegment", "c_nationkey").alias("data"))
    return packed.select("data.*")


# ---------------------------------------------------------------------- joins


@plan("J01_join_shared_name", """
    SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(t: Tables):
    orders = t.orders.select(F.col("o_custkey").alias("custkey"))
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    return orders.join(customers, "custkey").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@plan("J02_join_differing_names", """
    SELECT p_brand, round(sum(l_quantity), 2) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def _(t: Tables):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "inner")
    return joined.groupBy("p_brand").agg(F.round(F.sum("l_quantity"), 2).alias("qty"))


@plan("J03_comma_join_sql", """
    SELECT n_name, count(*) AS n FROM customer, nation WHERE c_nationkey = n_nationkey GROUP BY n_name""")
def _(t: Tables):
    return t.spark.sql(
        "SELECT n_name, count(*) AS n FROM {customer}, {nation} "
        "WHERE c_nationkey = n_nationkey GROUP BY n_name",
        customer=t.customer, nation=t.nation)


@plan("J04_join_then_where", """
    SELECT s_nationkey, count(*) AS n FROM lineitem, supplier WHERE l_suppkey = s_suppkey GROUP BY 1""")
def _(t: Tables):
    lines, suppliers = t.lineitem, t.supplier
    return (lines.join(suppliers).where(lines["l_suppkey"] == suppliers["s_suppkey"])
            .groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")))


@plan("J05_join_derived_keys", """
    SELECT strftime(d, '%d/%m/%Y') AS day, lines, placed
    FROM (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS lines FROM lineitem GROUP BY 1)
    JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS placed FROM orders GROUP BY 1) USING (d)""")
def _(t: Tables):
    # Both sides are counted per day before the join, so no day multiplies rows.
    shipped = (t.lineitem.groupBy(F.date_format("l_shipdate", "dd/MM/yyyy").alias("day"))
               .agg(F.count(F.lit(1)).alias("lines")))
    placed = (t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"))
              .agg(F.count(F.lit(1)).alias("placed")))
    joined = R.join_on_expression(shipped, placed, F.to_date("day", "dd/MM/yyyy"),
                                  F.to_date("order_day", "yyyy-MM-dd"), "d")
    return joined.select("day", "lines", "placed")


@plan("J06_join_two_keys", """
    SELECT s_nationkey, count(*) AS n, round(sum(c_acctbal + s_acctbal), 2) AS bal
    FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey = s_suppkey GROUP BY 1""")
def _(t: Tables):
    joined = R.join_on(t.supplier, t.customer, {"s_nationkey": "c_nationkey", "s_suppkey": "c_custkey"})
    return joined.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("c_acctbal") + F.col("s_acctbal")), 2).alias("bal"))


@plan("J07_join_duplicate_build_keys", """
    SELECT o_orderpriority, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS line_sum
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def _(t: Tables):
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("line_sum"))


@plan("J08_broadcast_join", """
    SELECT n_name, n_regionkey, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def _(t: Tables):
    joined = t.customer.join(broadcast_if_bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "n_regionkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("avg_bal"))


@plan("J09_left_outer_join", """
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def _(t: Tables):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "o_orderkey")


@plan("J10_left_semi_join", """
    SELECT p_partkey, p_name FROM part WHERE EXISTS
      (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 48)""")
def _(t: Tables):
    returned = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 48))
    return R.join_on(t.part.select("p_partkey", "p_name"), returned, {"p_partkey": "l_partkey"}, "left_semi")


@plan("J11_left_anti_join", """
    SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def _(t: Tables):
    return R.join_on(t.orders.select("o_orderkey"), t.lineitem, {"o_orderkey": "l_orderkey"}, "left_anti")


@plan("J12_merge_join_ordered", """
    SELECT a.o_orderstatus, count(*) AS n, round(sum(b.o_totalprice), 2) AS total
    FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey GROUP BY 1""")
def _(t: Tables):
    # Stored once in the order of the key; the join then reads both sides as they lie.
    orders = materialize_by(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey"], "orders")
    joined = orders.alias("a").join(orders.alias("b").hint("merge"), F.col("a.o_orderkey") == F.col("b.o_orderkey"))
    return joined.groupBy("a.o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("b.o_totalprice"), 2).alias("total"))


@plan("J13_sort_merge_join_scrambled", """
    SELECT l_returnflag, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM lineitem JOIN orders ON (l_orderkey * 7919) % 2305843009213693951 = (o_orderkey * 7919) % 2305843009213693951 GROUP BY 1""")
def _(t: Tables):
    def scrambled(name):
        # Modulo a prime above every key, so that two keys never meet.
        return (F.col(name) * 7919) % ((1 << 61) - 1)

    lines = t.lineitem.select("l_returnflag", scrambled("l_orderkey").alias("k"))
    orders = t.orders.select("o_totalprice", scrambled("o_orderkey").alias("k"))
    joined = lines.join(orders.hint("merge"), "k")
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@plan("J14_segment_revenue", """
    SELECT c_mktsegment, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           count(DISTINCT o_orderkey) AS n_orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment ORDER BY revenue DESC""")
def _(t: Tables):
    # Lines shrink to one row per order before they meet the order table.
    per_order = (t.lineitem.groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")))
    return (R.join_on(per_order, t.orders.select("o_orderkey", "o_custkey"), {"l_orderkey": "o_orderkey"})
            .join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_mktsegment")
            .agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.count(F.lit(1)).alias("n_orders"))
            .orderBy(F.desc("revenue")))


@plan("J14_star_chain", """
    SELECT r_name, n_name, o_orderstatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3""")
def _(t: Tables):
    facts = (t.lineitem.select("l_orderkey", "l_quantity")
             .join(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")))
    named = R.star_lookup(facts, [(t.nation, "c_nationkey", "n_nationkey"),
                                  (t.region, "n_regionkey", "r_regionkey")])
    return named.groupBy("r_name", "n_name", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@plan("J15_drop_duplicate_key", """
    SELECT o_orderkey, o_custkey, o_orderstatus, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t: Tables):
    return R.join_on(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
                     t.customer.select("c_custkey", "c_name", "c_nationkey"), {"o_custkey": "c_custkey"})


@plan("J16_merge_shared_columns", """
    SELECT nationkey, parity, c_custkey, n_name FROM
      (SELECT c_custkey, c_nationkey AS nationkey, c_nationkey % 2 AS parity FROM customer)
      JOIN (SELECT n_name, n_nationkey AS nationkey, n_nationkey % 2 AS parity FROM nation) USING (nationkey, parity)""")
def _(t: Tables):
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey"), (F.col("c_nationkey") % 2).alias("parity"))
    nations = t.nation.select("n_name", F.col("n_nationkey").alias("nationkey"), (F.col("n_nationkey") % 2).alias("parity"))
    return R.merge_tables(customers, nations)


@plan("J16_merge_named_key", """
    SELECT a.nationkey, a.name AS name_x, b.name AS name_y, a.c_custkey
    FROM (SELECT c_custkey, c_nationkey AS nationkey, c_name AS name FROM customer) a
    JOIN (SELECT n_nationkey AS nationkey, n_name AS name FROM nation) b ON a.nationkey = b.nationkey""")
def _(t: Tables):
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"))
    nations = t.nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))
    return R.merge_tables(customers, nations, by=["nationkey"])


@plan("J17_cartesian", "SELECT n_name, r_name FROM nation, region")
def _(t: Tables):
    return R.merge_tables(t.nation.select("n_name"), t.region.select("r_name"), product=True)


@plan("J18_self_join", """
    SELECT a.c_custkey AS id, b.c_custkey AS next_id, b.c_nationkey - a.c_nationkey AS step
    FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 WHERE a.c_mktsegment = b.c_mktsegment""")
def _(t: Tables):
    left, right = t.customer.alias("a"), t.customer.alias("b")
    joined = left.join(right, (F.col("b.c_custkey") == F.col("a.c_custkey") + 1)
                       & (F.col("a.c_mktsegment") == F.col("b.c_mktsegment")))
    return joined.select(F.col("a.c_custkey").alias("id"), F.col("b.c_custkey").alias("next_id"),
                         (F.col("b.c_nationkey") - F.col("a.c_nationkey")).alias("step"))


# ------------------------------------------------------- ordering and dedupe


@plan("O01_order_by", """
    SELECT c_mktsegment, c_nationkey, round(max(c_acctbal), 2) AS top FROM customer GROUP BY 1, 2
    ORDER BY c_mktsegment ASC, top DESC""")
def _(t: Tables):
    return (t.customer.groupBy("c_mktsegment", "c_nationkey")
            .agg(F.round(F.max("c_acctbal"), 2).alias("top"))
            .orderBy(F.asc("c_mktsegment"), F.desc("top")))


@plan("O02_limit", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def _(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@plan("O03_top_groups", """
    SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 5""")
def _(t: Tables):
    return R.top_groups(t.lineitem, ["l_partkey"], 5)


@plan("O04_distinct", "SELECT DISTINCT p_type, p_brand FROM part")
def _(t: Tables):
    return t.part.select("p_type", "p_brand").distinct()


@plan("O05_drop_duplicates", """
    SELECT count(*) AS kept, (SELECT count(*) FROM lineitem) - count(*) AS dropped
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def _(t: Tables):
    # One shuffle: copies are counted per key, then totalled.
    per_key = (t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies")))
    return per_key.agg(F.count(F.lit(1)).alias("kept"), F.sum(F.col("copies") - 1).alias("dropped"))


@plan("O05_drop_duplicate_rows", "SELECT DISTINCT lang, source, text FROM documents")
def _(t: Tables):
    return t.documents.select("lang", "source", "text").dropDuplicates()


# ------------------------------------------------------------- set operations


@plan("U01_union_all", """
    SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier
    UNION ALL SELECT n_nationkey FROM nation) GROUP BY k""")
def _(t: Tables):
    stacked = (t.customer.select(F.col("c_nationkey").alias("k"))
               .union(t.supplier.select("s_nationkey"))
               .union(t.nation.select("n_nationkey")))
    return stacked.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@plan("U01_union_by_name", """
    SELECT c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier""")
def _(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    right = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"))
    return left.unionByName(right)


@plan("U02_intersect", """
    SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity = 50""")
def _(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("k"))
    return returned.intersect(t.lineitem.filter("l_quantity = 50").select("l_partkey"))


@plan("U03_except", """
    SELECT o_custkey AS k FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def _(t: Tables):
    return t.orders.select(F.col("o_custkey").alias("k")).subtract(
        t.orders.filter("o_orderstatus = 'F'").select("o_custkey"))
