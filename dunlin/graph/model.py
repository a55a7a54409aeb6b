"""Property graphs held as two tables: ``vertices(id, …)`` and ``edges(src, dst, …)``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.session import materialize


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame

    @staticmethod
    def from_edges(edges: DataFrame) -> "Graph":
        """Vertices are all distinct ends of the edges."""
        ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        return Graph(ids, edges)

    def materialized(self) -> "Graph":
        """Both tables written to the shared folder and read back."""
        return Graph(materialize(self.vertices, "vertices"), materialize(self.edges, "edges"))

    def save(self, path: str) -> None:
        self.vertices.write.mode("overwrite").parquet(f"{path}/vertices")
        self.edges.write.mode("overwrite").parquet(f"{path}/edges")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Graph":
        return Graph(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"))

    # ---------------------------------------------------------------- degrees

    def out_degrees(self) -> DataFrame:
        """Vertices with at least one outgoing edge."""
        return self.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))

    def in_degrees(self) -> DataFrame:
        """Vertices with at least one incoming edge."""
        return self.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))

    def degrees(self) -> DataFrame:
        """Both degrees from one pass over the edges; zero where absent."""
        ends = self.edges.select(F.inline(F.array(
            F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
            F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))))
        return ends.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))

    # ------------------------------------------------------------- sub-graphs

    def filter_edges(self, condition: Column | str) -> "Graph":
        return Graph(self.vertices, self.edges.where(condition))

    def induced(self, condition: Column | str) -> "Graph":
        """Keep matching vertices and the edges with both ends among them."""
        kept = self.vertices.where(condition)
        ids = kept.select("id")
        edges = (self.edges.join(ids, F.col("src") == F.col("id"), "left_semi")
                 .join(ids, F.col("dst") == F.col("id"), "left_semi"))
        return Graph(kept, edges)

    def labelled(self, name: str, label: Column) -> "Graph":
        """Add an edge attribute computed from the attributes of its source."""
        source = self.vertices.withColumnRenamed("id", "src")
        edges = self.edges.join(source, "src").select(*self.edges.columns, label.alias(name))
        return Graph(self.vertices, edges)

    def simplified(self, collapse: bool = True) -> "Graph":
        """Drop self loops and, unless told otherwise, repeated edges."""
        plain = self.edges.where("src != dst")
        return Graph(self.vertices, plain.dropDuplicates(["src", "dst"]) if collapse else plain)

    # --------------------------------------------------------------- messages

    def aggregate_messages(
        self, aggregate: Column, to_src: Column | None = None, to_dst: Column | None = None
    ) -> DataFrame:
        """Send a value along each edge and combine what arrives per vertex.

        ``to_src`` and ``to_dst`` may use ``src_attr.*``, ``dst_attr.*`` and the
        edge columns; ``aggregate`` reads the column ``msg``.
        """
        vertex = F.struct(*self.vertices.columns)
        joined = (self.edges
                  .join(self.vertices.select(F.col("id").alias("src"), vertex.alias("src_attr")), "src")
                  .join(self.vertices.select(F.col("id").alias("dst"), vertex.alias("dst_attr")), "dst"))
        mail = []
        if to_src is not None:
            mail.append(F.struct(F.col("src").alias("id"), to_src.alias("msg")))
        if to_dst is not None:
            mail.append(F.struct(F.col("dst").alias("id"), to_dst.alias("msg")))
        return joined.select(F.inline(F.array(*mail))).groupBy("id").agg(aggregate)
