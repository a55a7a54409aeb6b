"""Plans for property graphs.

The graph holds all customers; an edge leads from the customer of each order
to the customer of the order with the next number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.graph import algorithms as X
from dunlin.graph import motif as M
from dunlin.graph.model import Graph
from dunlin.plans.registry import Tables, plan
from dunlin.plans.storage import _product_blocks
from dunlin.session import materialize, scratch_path
from dunlin.sources import readers as R
from dunlin.sources import records as B
from dunlin.sources import writers as K


def rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


E = """e AS MATERIALIZED (SELECT DISTINCT a.o_custkey AS src, b.o_custkey AS dst FROM orders a JOIN orders b
    ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey)"""


def raw_edges(t: Tables):
    """One edge per order that has a successor; loops and repeats included."""
    order = t.orders.select("o_orderkey", F.col("o_custkey").alias("src"))
    after = t.orders.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("dst"))
    return order.join(after, "o_orderkey").select("src", "dst")


def customer_graph(t: Tables) -> Graph:
    vertices = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"),
                             F.col("c_nationkey").alias("size"), F.col("c_acctbal").alias("price"))
    return Graph(vertices, raw_edges(t).where("src != dst").distinct())


# --------------------------------------------------------- building, degrees


@plan("G01_build_graph", f"WITH {E} SELECT src AS id FROM e UNION SELECT dst FROM e")
def _(t: Tables):
    return Graph.from_edges(customer_graph(t).edges).vertices


@plan("G02_degrees", f"""WITH {E}, o AS (SELECT src AS id, count(*) AS out_degree FROM e GROUP BY 1), i AS (SELECT dst AS id, count(*) AS in_degree FROM e GROUP BY 1)
    SELECT id, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree FROM o FULL JOIN i USING (id)""")
def _(t: Tables):
    return customer_graph(t).degrees()


@plan("G02_in_degrees", f"WITH {E} SELECT dst AS id, count(*) AS in_degree FROM e GROUP BY 1 HAVING count(*) >= 10")
def _(t: Tables):
    return customer_graph(t).in_degrees().where("in_degree >= 10")


@plan("G03_degree_distribution", f"WITH {E} SELECT d, count(*) AS n FROM (SELECT count(*) AS d FROM e GROUP BY dst) GROUP BY 1")
def _(t: Tables):
    return customer_graph(t).in_degrees().groupBy(F.col("in_degree").alias("d")).agg(rows())


@plan("G04_edge_filter", f"WITH {E} SELECT src, dst FROM e WHERE src < dst")
def _(t: Tables):
    return customer_graph(t).filter_edges("src < dst").edges


# --------------------------------------------------------------------- motifs


@plan("G05_find_two_cycle", f"WITH {E} SELECT x.src AS a, x.dst AS b FROM e x JOIN e y ON x.src = y.dst AND x.dst = y.src")
def _(t: Tables):
    g = customer_graph(t)
    found = M.find(Graph(g.vertices.select("id"), g.edges), "(a)-[e]->(b); (b)-[e2]->(a)")
    return found.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


@plan("G05a_mutual_edges", f"WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.src = y.dst AND x.dst = y.src")
def _(t: Tables):
    return M.mutual_edges(customer_graph(t).edges).agg(rows())


@plan("G05b_fan_out_pairs", f"WITH {E} SELECT x.src AS id, count(*) AS n FROM e x JOIN e y ON x.src = y.src AND x.dst <> y.dst GROUP BY 1")
def _(t: Tables):
    return M.fan_counts(customer_graph(t).edges, "src")


@plan("G05c_mutual_fan_out", f"""WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.src = y.src AND x.dst <> y.dst
    JOIN e z ON z.src = x.dst AND z.dst = x.src""")
def _(t: Tables):
    return M.mutual_fan_out_count(customer_graph(t).edges)


@plan("G05d_fan_in_pairs", f"WITH {E} SELECT x.dst AS id, count(*) AS n FROM e x JOIN e y ON x.dst = y.dst AND x.src <> y.src GROUP BY 1")
def _(t: Tables):
    return M.fan_counts(customer_graph(t).edges, "dst")


@plan("G05e_in_neighbour_of_mutual", f"""WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.dst = y.src JOIN e z ON z.src = y.dst AND z.dst = y.src""")
def _(t: Tables):
    return M.in_neighbour_of_mutual_count(customer_graph(t).edges)


@plan("G05f_zigzag", f"""WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.dst = y.dst AND x.src <> y.src
    JOIN e z ON z.src = y.src AND z.dst <> x.dst AND z.dst <> x.src""")
def _(t: Tables):
    return M.zigzag_count(materialize(customer_graph(t).edges, "edges"))


@plan("G05g_open_two_path", f"""WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.dst = y.src AND x.src <> y.dst
    JOIN customer p ON p.c_custkey = x.src JOIN customer q ON q.c_custkey = y.dst AND p.c_mktsegment = q.c_mktsegment
    WHERE NOT EXISTS (SELECT 1 FROM e z WHERE z.src = x.src AND z.dst = y.dst)""")
def _(t: Tables):
    g = customer_graph(t)
    return M.open_two_path_count(Graph(g.vertices, materialize(g.edges, "edges")), "kind")


@plan("G05g_open_two_path_topology", f"""WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.dst = y.src AND x.src <> y.dst
    WHERE NOT EXISTS (SELECT 1 FROM e z WHERE z.src = x.src AND z.dst = y.dst)""")
def _(t: Tables):
    g = customer_graph(t)
    return M.open_two_path_count(Graph(g.vertices, materialize(g.edges, "edges")))


@plan("G05g_open_two_path_two_attributes", f"""WITH {E} SELECT count(*) AS n FROM e x JOIN e y ON x.dst = y.src AND x.src <> y.dst
    JOIN customer p ON p.c_custkey = x.src JOIN customer q ON q.c_custkey = y.dst AND p.c_mktsegment = q.c_mktsegment AND p.c_nationkey = q.c_nationkey
    WHERE NOT EXISTS (SELECT 1 FROM e z WHERE z.src = x.src AND z.dst = y.dst)""")
def _(t: Tables):
    g = customer_graph(t)
    return M.open_two_path_count(Graph(g.vertices, materialize(g.edges, "edges")), ["kind", "size"])


@plan("G05_find_negated_anonymous", f"""WITH {E}, f AS (SELECT src, dst FROM e WHERE src < dst)
    SELECT x.src AS a, y.dst AS c, count(*) AS n FROM f x JOIN f y ON x.dst = y.src
    WHERE EXISTS (SELECT 1 FROM f o WHERE o.src = y.dst) AND NOT EXISTS (SELECT 1 FROM f z WHERE z.src = x.src AND z.dst = y.dst) GROUP BY 1, 2""")
def _(t: Tables):
    g = customer_graph(t).filter_edges("src < dst")
    found = M.find(Graph(g.vertices.select("id"), g.edges), "(a)-[e]->(b); (b)-[e2]->(c); (c)-[]->(); !(a)-[]->(c)")
    # Anonymous parts are not columns; a match per outgoing edge of c remains.
    return found.select("a", "b", "c").distinct().groupBy(F.col("a.id").alias("a"), F.col("c.id").alias("c")).agg(rows())


@plan("G06_motif_attribute_filter", f"""WITH {E} SELECT src, dst FROM e JOIN customer a ON a.c_custkey = src JOIN customer b ON b.c_custkey = dst
    WHERE a.c_mktsegment = 'BUILDING' AND b.c_mktsegment = 'BUILDING' AND a.c_nationkey < b.c_nationkey""")
def _(t: Tables):
    found = M.find(customer_graph(t), "(a)-[e]->(b)")
    return (found.where("a.kind = 'BUILDING' AND b.kind = 'BUILDING'").where("a.size < b.size").select("e.*"))


@plan("G07_induced_subgraph", f"""WITH {E}, v AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT (SELECT count(*) FROM v) AS n_vertices, count(*) AS n_edges FROM e WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v)""")
def _(t: Tables):
    sub = customer_graph(t).induced("kind = 'BUILDING'")
    return sub.edges.agg(rows("n_edges")).select(sub.vertices.agg(rows()).scalar().alias("n_vertices"), "n_edges")


@plan("G08_multi_relation_edges", f"""WITH {E} SELECT CASE WHEN c_nationkey > 12 AND c_acctbal <= 5000 THEN 'strong' ELSE 'plain' END AS relationship,
    count(*) AS n FROM e JOIN customer ON c_custkey = src GROUP BY 1""")
def _(t: Tables):
    label = F.when((F.col("size") > 12) & (F.col("price") <= 5000), "strong").otherwise("plain")
    return customer_graph(t).labelled("relationship", label).edges.groupBy("relationship").agg(rows())


@plan("G08_relation_subgraph", f"""WITH {E} SELECT src, dst FROM e JOIN customer ON c_custkey = src WHERE c_nationkey > 12 AND c_acctbal <= 5000""")
def _(t: Tables):
    label = F.when((F.col("size") > 12) & (F.col("price") <= 5000), "strong").otherwise("plain")
    high = customer_graph(t).labelled("relationship", label).filter_edges("relationship = 'strong'")
    return high.edges.select("src", "dst")


# ----------------------------------------------------------------- algorithms

_SCC = f"""WITH RECURSIVE {E}, p AS (SELECT src AS id FROM e GROUP BY src ORDER BY count(*) DESC, src LIMIT 1),
    fwd(id) AS (SELECT id FROM p UNION SELECT dst FROM fwd JOIN e ON src = fwd.id),
    bwd(id) AS (SELECT id FROM p UNION SELECT src FROM bwd JOIN e ON dst = bwd.id),
    big AS MATERIALIZED (SELECT id FROM fwd INTERSECT SELECT id FROM bwd),
    r AS MATERIALIZED (SELECT src, dst FROM e WHERE src NOT IN (SELECT id FROM big) AND dst NOT IN (SELECT id FROM big)),
    c(s, t) AS (SELECT src, dst FROM r UNION SELECT c.s, r.dst FROM c JOIN r ON c.t = r.src),
    m AS (SELECT x.s AS id, least(x.s, min(x.t)) AS component FROM c x JOIN c y ON x.s = y.t AND x.t = y.s GROUP BY x.s)
    SELECT c_custkey AS id, CASE WHEN big.id IS NOT NULL THEN (SELECT min(id) FROM big) ELSE coalesce(m.component, c_custkey) END AS component
    FROM customer LEFT JOIN big ON big.id = c_custkey LEFT JOIN m ON m.id = c_custkey"""


@plan("G09_strongly_connected", _SCC)
def _(t: Tables):
    return X.strongly_connected_components(customer_graph(t))


@plan("G10_triangle_count", f"""WITH {E}, u AS MATERIALIZED (SELECT DISTINCT least(src, dst) a, greatest(src, dst) b FROM e),
    t AS (SELECT x.a, x.b, y.b AS c FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b),
    k AS (SELECT v, count(*) AS n FROM (SELECT unnest([a, b, c]) v FROM t) GROUP BY v)
    SELECT c_custkey AS id, coalesce(n, 0) AS n FROM customer LEFT JOIN k ON v = c_custkey""")
def _(t: Tables):
    g = customer_graph(t)
    return M.triangle_counts(Graph(g.vertices, materialize(g.edges, "edges")))


_PR = f"WITH {E}, d AS (SELECT src, count(*) AS o FROM e GROUP BY 1), r0 AS (SELECT c_custkey AS id, 1.0::DOUBLE AS r FROM customer)" + "".join(
    f""", r{i} AS MATERIALIZED (SELECT c_custkey AS id, 0.15 + 0.85 * coalesce(s, 0)::DOUBLE AS r FROM customer LEFT JOIN
      (SELECT dst, sum(r / o) AS s FROM e JOIN d USING (src) JOIN r{i - 1} ON r{i - 1}.id = e.src GROUP BY 1) x ON dst = c_custkey)"""
    for i in range(1, 7)) + " SELECT id, round(r, 6) AS pagerank FROM r6"


@plan("G11_pagerank", _PR)
def _(t: Tables):
    ranks = X.pagerank(customer_graph(t), tolerance=None, iterations=6)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


@plan("G11_pagerank_tolerance", "SELECT count(*) AS n, true AS settled FROM customer")
def _(t: Tables):
    g = customer_graph(t)
    g = Graph(g.vertices, materialize(g.edges, "edges"))
    ranks, again = X.pageranks(g, [0.01, 0.0001], reset=0.15)
    return ranks.join(again.withColumnRenamed("pagerank", "exact"), "id").agg(rows(), (F.max(F.abs(F.col("pagerank") - F.col("exact"))) < 0.1).alias("settled"))


_LPA = f"WITH {E}, b AS MATERIALIZED (SELECT src AS f, dst AS t FROM e UNION ALL SELECT dst, src FROM e), l0 AS (SELECT c_custkey AS id, c_custkey AS label FROM customer)" + "".join(
    f""", l{i} AS MATERIALIZED (SELECT id, coalesce(best, label) AS label FROM l{i - 1} LEFT JOIN (SELECT t, arg_max(label, n * 100000000 - label) AS best
      FROM (SELECT t, label, count(*) AS n FROM b JOIN l{i - 1} ON id = f GROUP BY 1, 2) GROUP BY 1) x ON t = id)""" for i in range(1, 11)) + " SELECT id, label FROM l10"


@plan("G12_label_propagation", _LPA)
def _(t: Tables):
    return X.label_propagation(customer_graph(t), iterations=10)


@plan("G13_shortest_paths", f"""WITH RECURSIVE {E}, r(id, l, h) AS (SELECT l, l, 0 FROM (SELECT unnest([1, 2]::BIGINT[]) AS l) UNION
      SELECT e.src, r.l, r.h + 1 FROM r JOIN e ON e.dst = r.id WHERE r.h < 12),
    d AS (SELECT id, l, min(h)::INTEGER AS h FROM r GROUP BY 1, 2)
    SELECT c_custkey AS id, (SELECT h FROM d WHERE d.id = c_custkey AND l = 1) AS to_1, (SELECT h FROM d WHERE d.id = c_custkey AND l = 2) AS to_2 FROM customer""")
def _(t: Tables):
    paths = X.shortest_paths(customer_graph(t), [1, 2])
    return paths.select("id", *[F.try_element_at("distances", F.lit(k).cast("bigint")).alias(f"to_{k}") for k in (1, 2)])


@plan("G14_bfs", f"""WITH {E}, f AS (SELECT src, dst FROM e WHERE src < dst), s AS (SELECT c_custkey AS id FROM customer WHERE c_nationkey = 1 AND c_mktsegment = 'BUILDING'),
    g AS (SELECT c_custkey AS id FROM customer WHERE c_nationkey = 2 AND c_mktsegment = 'MACHINERY'),
    p1 AS (SELECT src AS a, dst AS z, 1 AS hops FROM f WHERE src IN (SELECT id FROM s) AND dst IN (SELECT id FROM g)),
    p2 AS (SELECT x.src AS a, y.dst AS z, 2 AS hops FROM f x JOIN f y ON x.dst = y.src WHERE x.src IN (SELECT id FROM s) AND y.dst IN (SELECT id FROM g) AND NOT EXISTS (SELECT 1 FROM p1)),
    p3 AS (SELECT x.src AS a, y.dst AS z, 3 AS hops FROM f x JOIN f w ON x.dst = w.src JOIN f y ON w.dst = y.src WHERE x.src IN (SELECT id FROM s)
      AND y.dst IN (SELECT id FROM g) AND NOT EXISTS (SELECT 1 FROM p1) AND NOT EXISTS (SELECT 1 FROM p2))
    SELECT a, z, hops, count(*) AS paths FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3) GROUP BY 1, 2, 3""")
def _(t: Tables):
    counts = X.bfs_path_counts(customer_graph(t), "size = 1 AND kind = 'BUILDING'", "size = 2 AND kind = 'MACHINERY'",
                               edge_filter="src < dst", max_length=3)
    return counts.select(F.col("from").alias("a"), F.col("to").alias("z"), "hops", "paths")


@plan("G15_aggregate_messages", f"""WITH {E} SELECT id, CAST(sum(c_nationkey) AS BIGINT) AS total FROM
    (SELECT src AS id, dst AS other FROM e UNION ALL SELECT dst, src FROM e) JOIN customer ON c_custkey = other GROUP BY 1""")
def _(t: Tables):
    return customer_graph(t).aggregate_messages(
        F.sum("msg").alias("total"), to_src=F.col("dst_attr.size"), to_dst=F.col("src_attr.size"))


@plan("G16_vertex_partitioning", "SELECT count(*) AS n, true AS together, true AS narrowed FROM customer")
def _(t: Tables):
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    vertices = customer_graph(t).vertices.select("id", "kind").na.fill("unknown").repartition(tasks, "kind")
    spread = vertices.groupBy("kind", F.spark_partition_id().alias("p")).agg(rows())
    together = spread.groupBy("kind").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    few = max(1, tasks // 2)
    narrow = vertices.coalesce(few).select(F.spark_partition_id().alias("p")).distinct().agg(rows())
    return together.agg(F.sum("n").alias("n"), (F.max("k") == 1).alias("together"),).select(
        "n", "together", (narrow.scalar() <= few).alias("narrowed"))


@plan("G17_edges_from_nested_json", """
    SELECT concat('C', l_returnflag) AS customer, count(*) AS products, CAST(sum(n) AS BIGINT) AS votes FROM
      (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <> 1 GROUP BY 1, 2) GROUP BY 1""")
def _(t: Tables):
    path = scratch_path(t.spark, "g17")
    K.write_table(B.to_json_lines(B.parse_blocks(_product_blocks(t))), path, "text")
    products = R.read_json(t.spark, path, "ASIN STRING, reviewLines ARRAY<STRUCT<review: STRUCT<customerId: STRING, votes: INT>>>")
    flat = products.select("ASIN", F.explode("reviewLines.review").alias("review"))
    return flat.groupBy(F.col("review.customerId").alias("customer")).agg(rows("products"), F.sum("review.votes").alias("votes"))


@plan("G18_simplify_edges", """
    WITH r AS (SELECT a.o_custkey AS src, b.o_custkey AS dst FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)
    SELECT count(*) AS no_loops, (SELECT count(*) FROM (SELECT DISTINCT src, dst FROM r WHERE src <> dst)) AS simple FROM r WHERE src <> dst""")
def _(t: Tables):
    g = Graph(t.customer.select(F.col("c_custkey").alias("id")), raw_edges(t))
    loose, simple = g.simplified(collapse=False), g.simplified()
    return loose.edges.agg(rows("no_loops")).select("no_loops", simple.edges.agg(rows()).scalar().alias("simple"))


@plan("K10_save_load_graph", f"WITH {E} SELECT (SELECT count(*) FROM customer) AS n_vertices, count(*) AS n_edges FROM e")
def _(t: Tables):
    path = scratch_path(t.spark, "k10")
    customer_graph(t).save(path)
    g = Graph.load(t.spark, path)
    return g.edges.agg(rows("n_edges")).select(g.vertices.agg(rows()).scalar().alias("n_vertices"), "n_edges")
