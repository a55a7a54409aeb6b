"""Structural patterns: a find operator and counts that never list the matches."""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.graph.model import Graph
from dunlin.session import materialize

_TERM = re.compile(r"^(!?)\((\w*)\)-\[(\w*)\]->\((\w*)\)$")


def find(graph: Graph, pattern: str) -> DataFrame:
    """Rows matching a pattern such as ``(a)-[e]->(b); !(b)-[]->(a)``.

    Named vertices and edges become struct columns.  Every term is an equi
    join on the vertices it shares with earlier terms and a negated term is an
    anti join.  Different names may stand for the same vertex.
    """
    terms = []
    for i, text in enumerate(p.strip().replace(" ", "") for p in pattern.split(";") if p.strip()):
        match = _TERM.match(text)
        if not match:
            raise ValueError(f"cannot read pattern term {text!r}")
        negated, src, edge, dst = match.groups()
        if negated and (not src or not dst):
            raise ValueError("a negated term needs named vertices")
        terms.append((bool(negated), src or f"__s{i}", edge, dst or f"__d{i}"))
    found, bound = None, []
    for negated, src, edge, dst in [t for t in terms if not t[0]]:
        columns = [F.col("src").alias(f"#{src}")]
        columns += [F.col("dst").alias(f"#{dst}")] if dst != src else []
        columns += [F.struct(*graph.edges.columns).alias(edge)] if edge else []
        step = (graph.edges if dst != src else graph.edges.where("src = dst")).select(*columns)
        names = [src] if src == dst else [src, dst]
        shared = [f"#{v}" for v in names if v in bound]
        if found is None:
            found = step
        elif shared:
            found = found.join(step, shared)
        else:
            raise ValueError("every term must share a vertex with an earlier one")
        bound += [v for v in names if v not in bound]
    for _, src, _, dst in [t for t in terms if t[0]]:
        if src not in bound or dst not in bound:
            raise ValueError("a negated term may only use vertices bound elsewhere")
        absent = graph.edges.select(F.col("src").alias(f"#{src}"), F.col("dst").alias(f"#{dst}"))
        found = found.join(absent, [f"#{src}", f"#{dst}"], "left_anti")

    plain = graph.vertices.columns == ["id"]
    for name in [v for v in bound if not v.startswith("__")]:
        if plain:
            found = found.withColumn(name, F.struct(F.col(f"#{name}").alias("id")))
        else:
            attributes = graph.vertices.select(
                F.col("id").alias(f"#{name}"), F.struct(*graph.vertices.columns).alias(name))
            found = found.join(attributes, f"#{name}")
    order: Sequence[str] = [n for t in terms if not t[0] for n in (t[1], t[2], t[3])]
    kept = list(dict.fromkeys(n for n in order if n and not n.startswith("__")))
    return found.select(*kept)


# --------------------------------------------------------- counts by algebra
#
# A hub with n neighbours takes part in n*n pairs.  The functions below count
# such pairs from degrees; ``edges`` must hold distinct (src, dst) without
# self loops.


def mutual_edges(edges: DataFrame) -> DataFrame:
    """Edges whose reverse exists as well."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select("src", "dst").join(back, ["src", "dst"], "left_semi")


def fan_counts(edges: DataFrame, end: str) -> DataFrame:
    """Ordered pairs of distinct neighbours per vertex: ``src`` fans out, ``dst`` fans in."""
    degree = edges.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias("d"))
    return degree.select("id", (F.col("d") * (F.col("d") - 1)).alias("n")).where("n > 0")


def mutual_fan_out_count(edges: DataFrame) -> DataFrame:
    """Matches of ``(a)->(b); (a)->(c); (b)->(a)`` with b other than c."""
    both = mutual_edges(edges).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("m"))
    out = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    return both.join(out, "id").agg(F.coalesce(F.sum(F.col("m") * (F.col("d") - 1)), F.lit(0)).alias("n"))


def in_neighbour_of_mutual_count(edges: DataFrame) -> DataFrame:
    """Matches of ``(a)->(b); (b)->(c); (c)->(b)``."""
    both = mutual_edges(edges).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("m"))
    inn = edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    return both.join(inn, "id").agg(F.coalesce(F.sum(F.col("m") * F.col("d")), F.lit(0)).alias("n"))


def _directed_triangles(edges: DataFrame) -> DataFrame:
    """Each undirected triangle ``(u, v, w)`` once, with one flag per direction.

    Every pair of neighbours points from its end of lower degree to the other,
    so even the largest hub starts only about sqrt(2 * edges) of them and the
    pairs that are compared stay within edges ** 1.5.  Flag ``uv`` tells
    whether the edge u→v exists, and so on.
    """
    forward = (F.col("src") < F.col("dst")).cast("int")
    pair = (edges.where("src != dst")
            .groupBy(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y"))
            .agg(F.max(forward).alias("xy"), F.max(1 - forward).alias("yx")))
    ends = pair.select(F.explode(F.array("x", "y")).alias("id"))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("d"))
    ranked = (pair.join(degree.select(F.col("id").alias("x"), F.col("d").alias("dx")), "x")
              .join(degree.select(F.col("id").alias("y"), F.col("d").alias("dy")), "y"))
    up = (F.col("dx") < F.col("dy")) | ((F.col("dx") == F.col("dy")) & (F.col("x") < F.col("y")))

    def arc_of(*names: str):
        return F.struct(*[F.col(c).alias(n) for c, n in zip(names, ("u", "v", "uv", "vu"))])

    towards = F.when(up, arc_of("x", "y", "xy", "yx")).otherwise(arc_of("y", "x", "yx", "xy"))
    arc = materialize(ranked.select(towards.alias("a")).select("a.*"), "arcs")
    other = arc.toDF("u", "w", "uw", "wu")
    wedge = arc.join(other, "u").where("v < w")
    closing = pair.toDF("v", "w", "vw", "wv")
    return wedge.join(closing, ["v", "w"])


def triangles(edges: DataFrame) -> DataFrame:
    """Undirected triangles as ``(u, v, w)``, each one once."""
    return _directed_triangles(edges).select("u", "v", "w")


def triangle_counts(graph: Graph) -> DataFrame:
    """Triangles through each vertex, zero included."""
    corner = triangles(graph.edges).select(F.explode(F.array("u", "v", "w")).alias("id"))
    counts = corner.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return graph.vertices.select("id").join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


def closed_two_paths(edges: DataFrame) -> DataFrame:
    """Rows ``(a, b, c)`` with edges a→b, b→c and a→c, read off the triangles."""
    orders = [F.struct(F.col(i).alias("a"), F.col(j).alias("b"), F.col(k).alias("c"),
                       (F.col(i + j) * F.col(j + k) * F.col(i + k)).alias("ok"))
              for i, j, k in itertools.permutations("uvw")]
    rows = _directed_triangles(edges).select(F.inline(F.array(*orders)))
    return rows.where("ok = 1").drop("ok")


def zigzag_count(edges: DataFrame) -> DataFrame:
    """Matches of ``(a)->(b); (c)->(b); (c)->(d)`` with a≠c, d≠b and d≠a.

    For each middle edge c→b the free ends multiply; matches whose free ends
    meet (a = d) are the closed two-paths and are taken off.
    """
    inn = edges.groupBy(F.col("dst").alias("dst")).agg(F.count(F.lit(1)).alias("i"))
    out = edges.groupBy(F.col("src").alias("src")).agg(F.count(F.lit(1)).alias("o"))
    free = (edges.select("src", "dst").join(inn, "dst").join(out, "src")
            .agg(F.coalesce(F.sum((F.col("i") - 1) * (F.col("o") - 1)), F.lit(0)).alias("n")))
    met = closed_two_paths(edges).agg(F.count(F.lit(1)).alias("n"))
    return free.select((F.col("n") - met.scalar()).alias("n"))


def open_two_path_count(graph: Graph, attribute: str | Sequence[str] | None = None) -> DataFrame:
    """Matches of ``(a)->(b); (b)->(c); !(a)->(c)`` with a≠c.

    With ``attribute`` both ends must agree on that vertex attribute, or on all
    of several, and null agrees with nothing.
    """
    edges = graph.edges.select("src", "dst")
    if attribute is None:
        tagged = edges.select("src", "dst", F.lit(1).alias("ka"), F.lit(1).alias("kb"))
    else:
        named = [attribute] if isinstance(attribute, str) else list(attribute)
        known = graph.vertices.dropna("any", subset=named)
        key = known.select("id", F.struct(*named).alias("k"))
        tagged = (edges.join(key.select(F.col("id").alias("src"), F.col("k").alias("ka")), "src", "left")
                  .join(key.select(F.col("id").alias("dst"), F.col("k").alias("kb")), "dst", "left"))
    into = tagged.where("ka IS NOT NULL").groupBy(F.col("dst").alias("b"), F.col("ka").alias("k")).agg(F.count(F.lit(1)).alias("i"))
    out = tagged.where("kb IS NOT NULL").groupBy(F.col("src").alias("b"), F.col("kb").alias("k")).agg(F.count(F.lit(1)).alias("o"))
    paths = into.join(out, ["b", "k"]).agg(F.coalesce(F.sum(F.col("i") * F.col("o")), F.lit(0)).alias("n"))
    returning = mutual_edges(edges)
    closed = closed_two_paths(edges)
    if attribute is not None:
        returning = returning.join(key, F.col("src") == F.col("id"), "left_semi")
        closed = (closed.join(key.select(F.col("id").alias("a"), F.col("k").alias("ka")), "a")
                  .join(key.select(F.col("id").alias("c"), F.col("k").alias("kc")), "c").where("ka = kc"))
    back = returning.agg(F.count(F.lit(1)).alias("n"))
    shut = closed.agg(F.count(F.lit(1)).alias("n"))
    return paths.select((F.col("n") - back.scalar() - shut.scalar()).alias("n"))
