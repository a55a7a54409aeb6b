import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dunlin.graph import algorithms as X
from dunlin.graph import motif as M
from dunlin.graph.model import Graph
from dunlin.graph.program import StoredArcs
from dunlin.session import materialize
from tests.conftest import values


def random_edges(seed, n=14, m=40, hub=True):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    if hub:
        edges |= {(0, i) for i in range(1, n)} | {(i, 0) for i in range(1, n, 3)}
    return sorted((a, b) for a, b in edges if a != b)


def make(spark, edges, n):
    vertices = spark.createDataFrame([(i, "even" if i % 2 == 0 else "odd", i) for i in range(n)], "id long, kind string, size int")
    return Graph(vertices, spark.createDataFrame(edges, "src long, dst long"))


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    edges = random_edges(request.param)
    return make(spark, edges, 15), edges


def matches(edges, pattern):
    """Brute force over all vertex choices for terms such as ('a', 'b')."""
    have = set(edges)
    names = sorted({v for t in pattern for v in t[-2:]})
    nodes = sorted({v for e in edges for v in e})
    out = []
    for choice in itertools.product(nodes, repeat=len(names)):
        bind = dict(zip(names, choice))
        if all(((bind[t[-2]], bind[t[-1]]) in have) != (t[0] == "!") for t in pattern):
            out.append(bind)
    return out


def test_find_agrees_with_brute_force(case):
    graph, edges = case
    plain = Graph(graph.vertices.select("id"), graph.edges)
    for text, pattern in (
        ("(a)-[e]->(b); (b)-[e2]->(a)", [("a", "b"), ("b", "a")]),
        ("(a)-[]->(b); (a)-[]->(c)", [("a", "b"), ("a", "c")]),
        ("(a)-[]->(b); (a)-[]->(c); (b)-[]->(a)", [("a", "b"), ("a", "c"), ("b", "a")]),
        ("(a)-[]->(b); (c)-[]->(b)", [("a", "b"), ("c", "b")]),
        ("(a)-[]->(b); (b)-[]->(c); (c)-[]->(b)", [("a", "b"), ("b", "c"), ("c", "b")]),
        ("(a)-[]->(b); (b)-[]->(c); !(a)-[]->(c)", [("a", "b"), ("b", "c"), ("!", "a", "c")]),
    ):
        got = M.find(plain, text)
        names = sorted({v for t in pattern for v in t[-2:]})
        want = Counter(tuple(b[n] for n in names) for b in matches(edges, pattern))
        assert Counter(tuple(r[n]["id"] for n in names) for r in got.collect()) == want, text


def test_find_keeps_attributes_and_rejects_bad_patterns(case):
    graph, edges = case
    rows = M.find(graph, "(a)-[e]->(b)").where("a.kind = 'even' AND a.size < b.size").select("e.*").collect()
    assert sorted((r["src"], r["dst"]) for r in rows) == sorted((a, b) for a, b in edges if a % 2 == 0 and a < b)
    for bad in ("(a)->(b)", "!(a)-[]->(b)", "(a)-[]->(b); (c)-[]->(d)", "(a)-[]->(b); !(a)-[]->()"):
        with pytest.raises(ValueError):
            M.find(graph, bad)


def test_counts_without_listing(case):
    graph, edges = case
    e = graph.edges
    two = matches(edges, [("a", "b"), ("a", "c")])
    assert dict(values(M.fan_counts(e, "src"))) == Counter(b["a"] for b in two if b["b"] != b["c"])
    into = matches(edges, [("a", "b"), ("c", "b")])
    assert dict(values(M.fan_counts(e, "dst"))) == Counter(b["b"] for b in into if b["a"] != b["c"])
    mutual = matches(edges, [("a", "b"), ("a", "c"), ("b", "a")])
    assert M.mutual_fan_out_count(e).first()[0] == sum(b["b"] != b["c"] for b in mutual)
    assert M.in_neighbour_of_mutual_count(e).first()[0] == len(matches(edges, [("a", "b"), ("b", "c"), ("c", "b")]))
    zig = matches(edges, [("a", "b"), ("c", "b"), ("c", "d")])
    assert M.zigzag_count(e).first()[0] == sum(b["a"] != b["c"] and b["d"] != b["b"] and b["d"] != b["a"] for b in zig)
    opened = [b for b in matches(edges, [("a", "b"), ("b", "c"), ("!", "a", "c")]) if b["a"] != b["c"]]
    assert M.open_two_path_count(graph).first()[0] == len(opened)
    assert M.open_two_path_count(graph, "kind").first()[0] == sum(b["a"] % 2 == b["c"] % 2 for b in opened)


def test_triangles(case):
    graph, edges = case
    have = {frozenset(e) for e in edges}
    want = Counter()
    for trio in itertools.combinations(range(15), 3):
        if all(frozenset(p) in have for p in itertools.combinations(trio, 2)):
            want.update(trio)
    assert dict(values(M.triangle_counts(graph))) == {i: want[i] for i in range(15)}


def closure(edges, n):
    reach = {i: {i} for i in range(n)}
    for _ in range(n):
        for a, b in edges:
            for i in range(n):
                if a in reach[i]:
                    reach[i].add(b)
    return reach


@pytest.mark.parametrize("edges, n", [
    ([(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (5, 6), (6, 5), (6, 7), (8, 8)], 10),
    (random_edges(9, n=12, m=16, hub=False), 12),
    ([], 3),
])
def test_strong_components(spark, edges, n):
    graph = Graph(spark.range(n), spark.createDataFrame(edges, "src long, dst long"))
    reach = closure(edges, n)
    want = {i: min(j for j in range(n) if j in reach[i] and i in reach[j]) for i in range(n)}
    assert dict(values(X.strongly_connected_components(graph))) == want


def test_pagerank_and_propagation(case):
    graph, edges = case
    out = Counter(a for a, _ in edges)
    ranks = {i: 1.0 for i in range(15)}
    labels = {i: i for i in range(15)}
    for _ in range(4):
        ranks = {i: 0.15 + 0.85 * sum(ranks[a] / out[a] for a, b in edges if b == i) for i in range(15)}
        votes = defaultdict(Counter)
        for a, b in edges:
            votes[b][labels[a]] += 1
            votes[a][labels[b]] += 1
        labels = {i: min(votes[i].items(), key=lambda x: (-x[1], x[0]))[0] if votes[i] else labels[i] for i in range(15)}
    got = dict(values(X.pagerank(graph, tolerance=None, iterations=4)))
    assert got == pytest.approx(ranks)
    scaled = dict(values(X.pagerank(graph, tolerance=None, iterations=4, normalize=True)))
    assert sum(scaled.values()) == pytest.approx(15)
    assert dict(values(X.label_propagation(graph, 4))) == labels


def test_paths(spark):
    edges = [(0, 1), (1, 2), (0, 3), (3, 2), (2, 4), (5, 5), (6, 0)]
    graph = make(spark, edges, 8)
    got = {r["id"]: r["distances"] for r in X.shortest_paths(graph, [2, 4]).collect()}
    assert got == {0: {2: 2, 4: 3}, 1: {2: 1, 4: 2}, 2: {2: 0, 4: 1}, 3: {2: 1, 4: 2}, 4: {4: 0}, 5: {}, 6: {2: 3, 4: 4}, 7: {}}
    found = X.bfs(graph, "id = 0", "id = 4")
    assert found.columns == ["from", "e0", "v1", "e1", "v2", "e2", "to"]
    assert sorted(r["v1"]["id"] for r in found.collect()) == [1, 3]
    assert X.bfs(graph, "id = 0", "id = 4", max_length=2).count() == 0
    assert X.bfs(graph, "id = 0", "id = 4", edge_filter="src != 1").count() == 1
    zero = X.bfs(graph, "id < 3", "id = 2")
    assert zero.columns == ["from", "to"] and [r["to"]["id"] for r in zero.collect()] == [2]


def test_path_counts_are_not_listed(spark):
    """Ten diamonds in a row: 1024 shortest paths, one row."""
    edges, at = [], 0
    for _ in range(10):
        edges += [(at, at + 1), (at, at + 2), (at + 1, at + 3), (at + 2, at + 3)]
        at += 3
    graph = make(spark, edges, at + 1)
    got = X.bfs_path_counts(graph, "id = 0", f"id = {at}", max_length=30)
    assert values(got, "from", "to", "hops", "paths") == [(0, at, 20, 1024)]
    assert X.bfs_path_counts(graph, "id = 0", f"id = {at}", max_length=5).count() == 0
    assert values(X.bfs_path_counts(graph, "id < 3", "id = 2"), "from", "hops", "paths") == [(2, 0, 1)]


def test_pagerank_does_not_stop_unsettled(spark):
    graph = make(spark, [(i, i + 1) for i in range(9)] + [(9, 0), (5, 0)], 10)
    with pytest.raises(RuntimeError):
        X.pagerank(graph, tolerance=1e-6, iterations=3)
    with pytest.raises(ValueError):
        X.pagerank(graph, tolerance=None)
    got = dict(values(X.pagerank(graph, tolerance=1e-6)))
    exact = dict(values(X.pagerank(graph, tolerance=None, iterations=120)))
    assert max(abs(got[k] - exact[k]) for k in exact) < 1e-4


def test_model(spark, tmp_path):
    edges = [(1, 2), (1, 2), (2, 2), (2, 3), (4, 1)]
    graph = Graph.from_edges(spark.createDataFrame(edges, "src long, dst long"))
    assert values(graph.vertices) == [(1,), (2,), (3,), (4,)]
    assert values(graph.degrees()) == [(1, 2, 1), (2, 2, 3), (3, 0, 1), (4, 1, 0)]
    assert graph.simplified(False).edges.count() == 4 and graph.simplified().edges.count() == 3
    assert values(graph.induced("id < 3").edges) == [(1, 2), (1, 2), (2, 2)]
    graph.save(str(tmp_path / "g"))
    assert values(Graph.load(spark, str(tmp_path / "g")).edges) == sorted(edges)
    sent = graph.aggregate_messages(F.sum("msg").alias("s"), to_src=F.col("dst_attr.id"), to_dst=F.col("src_attr.id"))
    assert values(sent) == [(1, 8), (2, 9), (3, 2), (4, 1)]


def jobs(spark, run):
    """Result of ``run`` and the number of Spark jobs that it took."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        got = run()
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_chain_goes_in_few_rounds(spark):
    """A path of 1,000 vertices that ends in a ring of 20 whose ids are not in order, and a tail."""
    ring = [1000 + (7 * i) % 20 for i in range(20)]
    edges = [(i, i + 1) for i in range(999)] + [(999, ring[3])] + list(zip(ring, ring[1:] + ring[:1])) + [(ring[5], 2000), (2000, 2001)]
    graph = make(spark, edges, 2002)
    got, short = jobs(spark, lambda: dict(values(X.strongly_connected_components(graph))))
    assert got == {i: 1000 if 1000 <= i < 1020 else i for i in range(2002)}
    few = make(spark, edges[990:], 2002)
    _, base = jobs(spark, lambda: X.strongly_connected_components(few).count())
    # Pointer jumping doubles its steps: a path a hundred times as long takes a few rounds more.
    assert short - base < 80


@pytest.mark.parametrize("seed", range(4))
def test_components_of_sparse_graphs(spark, seed):
    """Paths, rings, chains from a vertex back to itself and between members of one component."""
    draw = random.Random(seed)
    ids = draw.sample(range(100), 40)
    edges = set()
    for _ in range(6):
        path = draw.sample(ids, draw.randrange(2, 9))
        edges |= set(zip(path, path[1:]))
        if draw.random() < 0.6:
            edges.add((path[-1], path[0]))
    reach = {i: {i} for i in range(100)}
    for _ in range(100):
        for a, b in edges:
            reach[a] |= reach[b]
    want = {i: min(j for j in range(100) if j in reach[i] and i in reach[j]) for i in range(100)}
    assert dict(values(X.strongly_connected_components(make(spark, sorted(edges), 100)))) == want


def test_arcs_are_stored_in_the_order_of_the_join(spark):
    arcs = StoredArcs(spark.createDataFrame([(i % 50, i) for i in range(5000)], "from long, to long"))
    state = materialize(spark.range(50).withColumn("x", F.col("id")), "state")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = arcs.joined(state)._jdf.queryExecution().sparkPlan().toString() + arcs.joined(state)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan[plan.rindex("SortMergeJoin"):]
    side = final[: final.index("FileScan")]
    assert "Exchange" not in side and "Sort " not in side and "Bucketed: true" in final


def test_hub_arcs_are_dealt_out(spark):
    """One vertex sends half of all arcs: no bucket holds them together, and all messages arrive."""
    edges = [(0, i) for i in range(1, 8001)] + [(i, i + 1) for i in range(1, 8001)]
    arcs = StoredArcs(spark.createDataFrame(edges, "from long, to long"))
    assert [r["from"] for r in arcs.hubs.collect()] == [0]
    largest = arcs.table.groupBy("from", "part").count().agg({"count": "max"}).first()[0]
    assert largest < 5000
    sent = arcs.joined(spark.range(8002).withColumn("x", F.lit(1)))
    assert sent.count() == len(edges) and sent.select("from", "to").distinct().count() == len(edges)


def test_later_rounds_send_less(spark):
    """Delta propagation reaches the ranks of the plain loop and vertices at rest send nothing."""
    draw = random.Random(4)
    edges = sorted({(draw.randrange(60), draw.randrange(60)) for _ in range(150)} | {(i, i + 1) for i in range(60, 99)})
    graph = make(spark, edges, 100)
    senders = []
    got = dict(values(X.pagerank(graph, tolerance=0.001, on_round=lambda done, state: senders.append(state.where("active").count()))))
    exact = dict(values(X.pagerank(graph, tolerance=None, iterations=100)))
    assert max(abs(got[k] - exact[k]) for k in exact) < 0.001
    assert senders[0] > 40
    assert senders[-1] < senders[0] / 3


def test_paths_along_a_long_chain_and_over_a_hub(spark):
    edges = [(i, i + 1) for i in range(30)] + [(i, 100) for i in range(101, 400)] + [(100, 0)]
    got = {r["id"]: r["distances"] for r in X.shortest_paths(make(spark, edges, 400), [30, 100]).collect()}
    assert got[0] == {30: 30} and got[100] == {30: 31, 100: 0} and got[399] == {30: 32, 100: 1} and got[31] == {}
    near = {r["id"]: r["distances"] for r in X.shortest_paths(make(spark, edges, 400), [30, 100], max_hops=2).collect()}
    assert near[28] == {30: 2} and near[27] == {} and near[399] == {100: 1}


def test_pagerank_goes_on_to_a_smaller_tolerance(case, monkeypatch):
    graph, _ = case
    built = []

    class Counted(StoredArcs):
        def __init__(self, *args):
            built.append(1)
            super().__init__(*args)

    monkeypatch.setattr(X, "StoredArcs", Counted)
    rough, fine = X.pageranks(graph, [0.01, 1e-6])
    assert len(built) == 1
    exact = dict(values(X.pagerank(graph, tolerance=None, iterations=120)))
    assert dict(values(fine)) == pytest.approx(exact, abs=1e-4) and dict(values(rough)) == pytest.approx(exact, abs=0.1)
    with pytest.raises(ValueError):
        X.pageranks(graph, [0.01, 0.1])


def test_votes_are_shuffled_once(spark, monkeypatch):
    plans = []
    step = X.vertex_program

    def watched(arcs, state, message, combine, *rest):
        return step(arcs, state, message, lambda mail: plans.append(combine(mail)) or plans[-1], *rest)

    monkeypatch.setattr(X, "vertex_program", watched)
    graph = Graph(spark.range(6), spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 0)], "src long, dst long"))
    X.label_propagation(graph, 1)
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert sum("hashpartitioning(to" in line or "hashpartitioning(id" in line for line in text.splitlines() if "Exchange" in line and "Reused" not in line) == 1, text


def test_a_row_of_components_goes_in_few_rounds(spark, monkeypatch):
    n, edges = 24, []
    for k in range(n):
        # A component of four, dense enough to hold no chain, and an arc to the next one.
        edges += [(4 * k + a, 4 * k + b) for a in range(4) for b in range(4) if a != b]
        edges += [(4 * k + 3, 4 * k + 4)] if k < n - 1 else []
    spreads = []
    spread = X._spread_smallest
    monkeypatch.setattr(X, "_spread_smallest", lambda *args: spreads.append(1) or spread(*args))
    got = dict(values(X.strongly_connected_components(make(spark, edges, 4 * n))))
    assert got == {i: i // 4 * 4 for i in range(4 * n)}
    assert len(spreads) <= 20  # two in a round; with ids as colours each round finds a single component
