"""Iterative graph algorithms.

Each round is a join and a map-side combined aggregation.  The new state is
written to the shared folder, which cuts the lineage, and one small aggregate
decides whether to go on; the state itself never reaches the driver.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.graph.model import Graph
from dunlin.graph.program import StoredArcs, vertex_program
from dunlin.session import discard, materialize


def pagerank(
    graph: Graph,
    reset: float = 0.15,
    tolerance: float | None = 0.01,
    iterations: int | None = None,
    normalize: bool = False,
    rounds_per_cut: int = 3,
    on_round: Callable[[int, DataFrame], None] | None = None,
) -> DataFrame:
    """``r = reset + (1 - reset) * sum(r_src / outdegree)``, starting from one.

    With a tolerance the changes of the ranks are propagated: a vertex adds up what has
    changed since it last sent and sends it on once that is ``reset * tolerance`` or more, so vertices
    at rest send nothing and read no arcs. It ends when no vertex has so much left; if ``iterations``
    are stated and end sooner, that is an error. Without a tolerance exactly ``iterations``
    rounds over all arcs are done, several in one job. ``normalize`` scales the ranks so that they sum to
    the number of vertices, which matters when some vertices have no outgoing edge.

    Every vertex also has an arc to itself without weight, which carries the reset share, so
    a round over all arcs reads the ranks once: one join, one aggregation.
    """
    if tolerance is None and iterations is None:
        raise ValueError("state a tolerance or a number of iterations")
    return _pageranks(graph, reset, [tolerance], iterations, normalize, rounds_per_cut, on_round)[0]


def pageranks(graph: Graph, tolerances: Sequence[float], reset: float = 0.15) -> list[DataFrame]:
    """:func:`pagerank` to each of the falling ``tolerances``; each goes on from the state of the one before."""
    if list(tolerances) != sorted(tolerances, reverse=True):
        raise ValueError("state the tolerances from the largest to the smallest")
    return _pageranks(graph, reset, tolerances, None, False, 3, None)


def _pageranks(
    graph: Graph, reset: float, tolerances: Sequence[float | None], iterations: int | None, normalize: bool, rounds_per_cut: int,
    on_round: Callable[[int, DataFrame], None] | None,
) -> list[DataFrame]:
    share = graph.out_degrees().select(F.col("id").alias("src"), ((1 - reset) / F.col("out_degree")).alias("w"))
    own = graph.vertices.select(F.col("id").alias("from"), F.col("id").alias("to"), F.lit(None).cast("double").alias("w"))
    weighted = graph.edges.select("src", "dst").join(share, "src").select(F.col("src").alias("from"), F.col("dst").alias("to"), "w")
    arcs = StoredArcs(weighted.unionByName(own))

    def over_all(ranks: DataFrame) -> DataFrame:
        value = F.when(F.col("w").isNull(), F.lit(reset)).otherwise(F.col("rank") * F.col("w"))
        return arcs.joined(ranks).groupBy(F.col("to").alias("id")).agg(F.sum(value).alias("rank"))

    ranks = graph.vertices.select("id", F.lit(1.0).alias("rank"))
    found = []
    state = None
    for tolerance in tolerances:
        if tolerance is None:
            break
        least = reset * tolerance
        if state is None:
            state = over_all(ranks).select("id", "rank", (F.col("rank") - 1).alias("pending"))
        start = state.select("id", "rank", "pending", (F.abs("pending") >= least).alias("active"))
        seen = F.coalesce("seen", F.lit(0.0))
        pending = F.when(F.col("active"), seen).otherwise(F.col("pending") + seen)
        state = vertex_program(
            arcs, start, {"share": F.col("pending") * F.col("w")}, lambda mail: mail.groupBy("id").agg(F.sum("share").alias("seen")),
            {"rank": F.col("rank") + seen, "pending": pending}, F.abs(pending) >= least, None if iterations is None else iterations - 1, on_round)
        if not state.where("active").isEmpty():
            raise RuntimeError(f"ranks still move after {iterations} rounds")
        found.append(state.select("id", "rank"))
    if not found:
        stored = None
        for done in range(1, iterations + 1):
            ranks = over_all(ranks)
            if done % rounds_per_cut == 0 or done == iterations:
                previous, ranks = stored, materialize(ranks, "ranks")
                stored = ranks
                if previous is not None:
                    discard(previous)
        found.append(ranks)
    arcs.discard()
    results = [ranks.select("id", F.col("rank").alias("pagerank")) for ranks in found]
    if normalize:
        scales = [result.agg(F.count(F.lit(1)) / F.sum("pagerank")).scalar() for result in results]
        results = [result.select("id", (F.col("pagerank") * scale).alias("pagerank")) for result, scale in zip(results, scales)]
    return results


def label_propagation(graph: Graph, iterations: int = 10) -> DataFrame:
    """Synchronous: each vertex takes the label most common among its neighbours.

    Edges count in both directions and a tie goes to the smallest label; vertices without
    neighbours keep theirs. All vertices send in every round, as a vote needs all labels around it.
    """
    both = graph.edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("from"), F.col("dst").alias("to")),
        F.struct(F.col("dst").alias("from"), F.col("src").alias("to")))))
    arcs = StoredArcs(both)
    # A vertex has as many arcs in as out here, so without hubs no receiver is a hot key either.
    even = arcs.hubs.isEmpty()

    def most_common(mail: DataFrame) -> DataFrame:
        # Votes hardly repeat at first: dealt out by receiver once, they are counted and compared without another shuffle.
        votes = (mail.repartition("id") if even else mail).groupBy("id", "sent").agg(F.count(F.lit(1)).alias("n"))
        # The largest count, then the smallest label.
        return votes.groupBy("id").agg(F.max_by("sent", F.struct(F.col("n"), (-F.col("sent")).alias("low"))).alias("best"))

    start = graph.vertices.select("id", F.col("id").alias("label"), F.lit(True).alias("active"))
    state = vertex_program(arcs, start, {"sent": F.col("label")}, most_common, {"label": F.coalesce("best", "label")}, F.lit(True), iterations)
    arcs.discard()
    return state.select("id", "label")


def _spread_smallest(stored: StoredArcs, state: DataFrame) -> DataFrame:
    """Carry the smallest colour of ``state(id, colour)`` along the arcs until nothing changes."""
    better = F.coalesce(F.col("seen") < F.col("colour"), F.lit(False))
    spread = vertex_program(
        stored, state.select("id", "colour", F.lit(True).alias("active")), {"sent": F.col("colour")},
        lambda mail: mail.groupBy("id").agg(F.min("sent").alias("seen")), {"colour": F.when(better, F.col("seen")).otherwise(F.col("colour"))}, better)
    return spread.select("id", "colour")


def _replace(old: DataFrame, new: DataFrame) -> DataFrame:
    """Store the next state of a loop and free the one it was made from."""
    stored = materialize(new, "state")
    discard(old)
    return stored


def _between(arcs: DataFrame, ids: DataFrame) -> DataFrame:
    """Arcs whose ends are both among ``ids``."""
    return (arcs.join(ids, F.col("src") == F.col("id"), "left_semi")
            .join(ids, F.col("dst") == F.col("id"), "left_semi"))


def _ends(arcs: DataFrame) -> DataFrame:
    """Every vertex with an arc: numbers ``o`` and ``i`` of arcs out and in, and one neighbour of each kind."""
    none = F.lit(None).cast(dict(arcs.dtypes)["src"])
    ends = arcs.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i"), F.col("dst").alias("next"), none.alias("last")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i"), none.alias("next"), F.col("src").alias("last")))))
    return materialize(ends.groupBy("id").agg(F.sum("o").alias("o"), F.sum("i").alias("i"), F.max("next").alias("next"), F.max("last").alias("last")), "ends")


def _chains(ends: DataFrame) -> DataFrame | None:
    """Vertices with one incoming and one outgoing arc, with the vertices at both ends of their chain.

    ``before`` and ``after`` are the nearest vertices that are not of this kind, found by
    pointer jumping in about log2 rounds; ``next`` and ``last`` are the neighbours. A closed ring
    has no ends: its vertices keep nulls and the smallest id of the ring in ``low``. None if there is no such vertex.
    """
    chain = materialize(ends.where("o = 1 AND i = 1").select("id", "next", "last"), "chain")
    if chain.isEmpty():
        discard(chain)
        return None
    kind = dict(chain.dtypes)["id"]
    none = F.lit(None).cast(kind)
    member = chain.select(F.col("id").alias("at"))
    # ``on`` and ``back`` still point to chain vertices; once past them the pointer is an end.
    state = materialize(
        chain.join(member.select(F.col("at").alias("next"), F.lit(True).alias("n")), "next", "left")
        .join(member.select(F.col("at").alias("last"), F.lit(True).alias("l")), "last", "left").select(
            "id", F.when(F.col("n"), F.col("next")).alias("on"), F.when(F.col("n").isNull(), F.col("next")).alias("after"),
            F.when(F.col("l"), F.col("last")).alias("back"), F.when(F.col("l").isNull(), F.col("last")).alias("before"),
            F.least("id", "next").alias("low"), "next", "last"), "pointers")
    rounds = max(1, chain.count()).bit_length() + 1
    for _ in range(rounds):
        if state.where("on IS NOT NULL OR back IS NOT NULL").isEmpty():
            break
        ahead = state.select(F.col("id").alias("on"), F.col("on").alias("on2"), F.col("after").alias("after2"), F.col("low").alias("low2"))
        behind = state.select(F.col("id").alias("back"), F.col("back").alias("back2"), F.col("before").alias("before2"))
        state = _replace(state, state.join(ahead, "on", "left").join(behind, "back", "left").select(
            "id", F.col("on2").alias("on"), F.coalesce("after", "after2").alias("after"), F.col("back2").alias("back"),
            F.coalesce("before", "before2").alias("before"), F.least("low", "low2").alias("low"), "next", "last"))
    discard(chain)
    ring = F.col("after").isNull()
    return _replace(state, state.select("id", F.when(ring, none).otherwise(F.col("before")).alias("before"), "after", "low", "next", "last"))


def strongly_connected_components(graph: Graph, max_rounds: int | None = None) -> DataFrame:
    """``(id, component)`` with the smallest vertex id as component.

    Vertices without an incoming or outgoing arc are trimmed, and chains of vertices with
    one of each are replaced by one arc between their ends, so a path or a tree of any length
    goes in about log2 rounds. A ring is a component; the vertices of another chain belong to the
    component of its ends if both ends are in one, which is settled once the ends are. What is left is
    solved in rounds: the smallest colour is spread forward, and a walk backward from
    every colour's root inside its colour meets a component. Arcs between colours are cut, as no component
    crosses them. The ids are scrambled anew for the colours of each round, so a row of components that
    lead one into the next is cut at a chance place and also goes in about log2 rounds.
    Vertices left after ``max_rounds`` keep their own id.
    """
    ids = graph.vertices.select("id")
    arcs = materialize(graph.edges.where("src != dst").select("src", "dst").distinct(), "arcs")
    done: list[DataFrame] = []
    contracted: list[DataFrame] = []
    rounds = 0
    kind = dict(arcs.dtypes)["src"]
    bits, draw = {"bigint": 63, "int": 31, "smallint": 15, "tinyint": 7}.get(kind, 0), random.Random(1)
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        while True:
            ends = _ends(arcs)
            trimmed = not ends.where("o = 0 OR i = 0").isEmpty()
            if trimmed:
                arcs = _replace(arcs, _between(arcs, ends.where("o > 0 AND i > 0").select("id")))
                discard(ends)
                ends = _ends(arcs)
            chains = _chains(ends)
            if chains is None:
                if not trimmed:
                    break
                discard(ends)
                continue
            discard(ends)
            rings = chains.where("after IS NULL")
            done.append(rings.select("id", F.col("low").alias("component")))
            contracted.append(chains.where("after IS NOT NULL").select("id", "before", "after"))
            # The first vertex of each chain, whose neighbour is its end, stands for the whole chain.
            bridges = chains.where("before = last AND before != after").select(F.col("before").alias("src"), F.col("after").alias("dst"))
            plain = arcs.join(chains, F.col("src") == F.col("id"), "left_anti").join(chains, F.col("dst") == F.col("id"), "left_anti")
            arcs = _replace(arcs, plain.unionByName(bridges).distinct())
        if ends.isEmpty():
            discard(ends)
            break
        # Scrambling is its own inverse, so a colour tells its root.
        mask = F.lit(draw.getrandbits(bits)).cast(kind) if bits else None
        scrambled = lambda name: F.col(name) if mask is None else F.col(name).bitwiseXOR(mask)
        forward = StoredArcs(arcs.select(F.col("src").alias("from"), F.col("dst").alias("to")))
        colours = _spread_smallest(forward, ends.select("id", scrambled("id").alias("colour")))
        tinted = (forward.joined(colours.withColumnRenamed("colour", "cs"))
                  .join(colours.select(F.col("id").alias("to"), F.col("colour").alias("cd")), "to"))
        inner = materialize(tinted.where("cs = cd").select(F.col("to").alias("from"), F.col("from").alias("to")), "inner")
        forward.discard()
        # Backward walk inside a colour: the root is the vertex that the colour stands for.
        marks = colours.select("id", F.when(F.col("id") == scrambled("colour"), 0).otherwise(1).alias("colour"))
        backward = StoredArcs(inner)
        reached = _spread_smallest(backward, marks).where("colour = 0").select("id")
        backward.discard()
        found = materialize(colours.join(reached, "id", "left_semi")
                            .select("id", scrambled("colour").alias("component")), "component")
        done.append(found)
        discard(colours)
        left = _replace(ends, ends.select("id").join(found, "id", "left_anti"))
        arcs = _replace(arcs, _between(inner.select(F.col("to").alias("src"), F.col("from").alias("dst")), left))
        discard(inner)
        discard(left)
    discard(arcs)
    if not done and not contracted:
        return ids.select("id", F.col("id").alias("component"))
    label = F.coalesce("component", "id")
    members = ids.withColumn("component", F.col("id")).limit(0)
    for part in done:
        members = members.unionByName(part)
    # Chains that were replaced last are settled first: their ends may lie on those replaced before.
    for chains in reversed(contracted):
        known = materialize(members, "members")
        of = lambda name: known.select(F.col("id").alias(name), F.col("component").alias(f"{name}_in"))
        ends = chains.join(of("before"), "before", "left").join(of("after"), "after", "left")
        first, second = F.coalesce("before_in", "before"), F.coalesce("after_in", "after")
        inside = ends.where(first == second).select("id", first.alias("component"))
        # An end that had no component yet is in one now, with its chain.
        joined = inside.join(known.select(F.col("id").alias("component")), "component", "left_anti").select(F.col("component").alias("id"), "component").distinct()
        members = known.unionByName(inside).unionByName(joined)
    members = members.distinct()
    smallest = members.groupBy("component").agg(F.min("id").alias("low"))
    named = members.join(smallest, "component").select("id", F.col("low").alias("component"))
    return ids.join(named, "id", "left").select("id", label.alias("component"))


def shortest_paths(graph: Graph, landmarks: Sequence, max_hops: int | None = None) -> DataFrame:
    """``(id, distances)``: hops along edges to each reachable landmark, as a map.

    Only vertices whose distances became smaller send again, so a round costs what its frontier does.
    """
    kind = dict(graph.vertices.dtypes)["id"]
    arcs = StoredArcs(graph.edges.select(F.col("dst").alias("from"), F.col("src").alias("to")).distinct())
    empty = F.create_map().cast(f"map<{kind},int>")
    own = F.col("id").isin(list(landmarks))
    start = graph.vertices.select("id", F.when(own, F.create_map("id", F.lit(0))).otherwise(empty).alias("distances"), own.alias("active"))

    def nearest(mail: DataFrame) -> DataFrame:
        hops = mail.select("id", F.explode("sent").alias("landmark", "hops")).groupBy("id", "landmark").agg(F.min("hops").alias("hops"))
        return hops.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("landmark", "hops"))).alias("seen"))

    entries = F.map_entries(F.coalesce("seen", empty))
    nearer = F.filter(entries, lambda e: F.coalesce(e["value"] < F.try_element_at("distances", e["key"]), F.lit(True)))
    others = F.filter(F.map_entries("distances"), lambda e: F.coalesce(e["value"] <= F.try_element_at("seen", e["key"]), F.lit(True)))
    state = vertex_program(
        arcs, start, {"sent": F.transform_values("distances", lambda k, v: v + 1)}, nearest,
        {"distances": F.map_from_entries(F.concat(others, nearer))}, F.size(nearer) > 0, max_hops)
    arcs.discard()
    return state.select("id", "distances")


def _shortest_steps(
    graph: Graph, start: Column | str, goal: Column | str, edge_filter: Column | str | None, max_length: int
) -> tuple[int | None, list[DataFrame], DataFrame]:
    """Length of the shortest path between the two sets, its edges by depth, and the ids that match both sets, or that start such a path."""
    edges = graph.edges.where(edge_filter) if edge_filter is not None else graph.edges
    levels = [materialize(graph.vertices.where(start).select("id"), "level")]
    goals = materialize(graph.vertices.where(goal).select("id"), "goals")
    length = None
    for depth in range(max_length + 1):
        if not levels[depth].join(goals, "id", "left_semi").isEmpty():
            length = depth
            break
        if depth == max_length:
            break
        reached = (edges.join(levels[depth], F.col("src") == F.col("id"), "left_semi")
                   .select(F.col("dst").alias("id")).distinct())
        for level in levels:
            reached = reached.join(level, "id", "left_anti")
        levels.append(materialize(reached, "level"))
        if levels[-1].isEmpty():
            break
    if not length:
        return length, [], levels[0].join(goals, "id", "left_semi")
    # Walk back from the goals so that only edges on a shortest path stay.
    steps, keep = [], levels[length].join(goals, "id", "left_semi")
    for depth in range(length - 1, -1, -1):
        step = materialize(
            edges.join(keep, F.col("dst") == F.col("id"), "left_semi")
            .join(levels[depth], F.col("src") == F.col("id"), "left_semi"), "step")
        steps.insert(0, step)
        keep = step.select(F.col("src").alias("id")).distinct()
    return length, steps, keep


def bfs_path_counts(
    graph: Graph,
    start: Column | str,
    goal: Column | str,
    edge_filter: Column | str | None = None,
    max_length: int = 10,
) -> DataFrame:
    """``(from, to, hops, paths)``: how many shortest paths join each pair, without listing them.

    Counts are carried level by level per start and vertex, so their number is
    bounded by the pairs, not by the paths.
    """
    length, steps, keep = _shortest_steps(graph, start, goal, edge_filter, max_length)
    if length is None:
        keep = keep.limit(0)
    counts = keep.select(F.col("id").alias("from"), F.col("id").alias("to"), F.lit(1).cast("long").alias("paths"))
    for step in steps:
        at = counts.withColumnRenamed("to", "src")
        counts = (step.select("src", "dst").join(at, "src").groupBy("from", F.col("dst").alias("to"))
                  .agg(F.sum("paths").alias("paths")))
    return counts.select("from", "to", F.lit(length or 0).alias("hops"), "paths")


def bfs(
    graph: Graph,
    start: Column | str,
    goal: Column | str,
    edge_filter: Column | str | None = None,
    max_length: int = 10,
) -> DataFrame:
    """All shortest paths from vertices matching ``start`` to ones matching ``goal``.

    Columns are ``from, e0, v1, e1, …, to`` as structs.  A vertex that matches
    both gives a path of length zero.  Distances are found level by level
    first; paths are only put together from vertices that lie on one.
    """
    vertex = F.struct(*graph.vertices.columns)
    length, steps, keep = _shortest_steps(graph, start, goal, edge_filter, max_length)
    if length is None:
        return graph.vertices.limit(0).select(vertex.alias("from"), vertex.alias("to"))
    if length == 0:
        both = graph.vertices.join(keep, "id", "left_semi")
        return both.select(vertex.alias("from"), vertex.alias("to"))
    paths = None
    for depth, step in enumerate(steps):
        arc = step.select(F.col("src").alias(f"#{depth}"), F.col("dst").alias(f"#{depth + 1}"),
                          F.struct(*step.columns).alias(f"e{depth}"))
        paths = arc if paths is None else paths.join(arc, f"#{depth}")
    names = ["from"] + [f"v{i}" for i in range(1, length)] + ["to"]
    for depth, name in enumerate(names):
        paths = paths.join(graph.vertices.select(F.col("id").alias(f"#{depth}"), vertex.alias(name)), f"#{depth}")
    order = ["from"]
    for depth in range(length):
        order += [f"e{depth}", names[depth + 1]]
    return paths.select(*order)
