"""Vertex programs: rounds of messages along arcs that are stored once in the order of their join."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.session import discard, materialize, materialize_by


class StoredArcs:
    """Arcs ``(from, to, …)`` bucketed and sorted by their sender, so that rounds neither shuffle nor sort them.

    A sender with more arcs than an average bucket holds is a hub: its arcs are dealt to
    several parts and its state is sent to each. There can be no more hubs than
    buckets, which bounds the table that is broadcast.
    """

    def __init__(self, arcs: DataFrame, label: str = "arcs"):
        spark = arcs.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        plain = materialize(arcs, label)
        limit = max(1000, plain.count() // buckets)
        busy = plain.groupBy("from").count().where(F.col("count") > limit)
        self.hubs = materialize(busy.select("from", F.ceil(F.col("count") / limit).cast("int").alias("parts")), "hubs")
        dealt = F.pmod(F.hash("to"), F.coalesce("parts", F.lit(1)))
        placed = plain.join(F.broadcast(self.hubs), "from", "left").select(*arcs.columns, dealt.alias("part"))
        self.table = materialize_by(placed, ["from", "part"], label)
        discard(plain)

    def joined(self, state: DataFrame) -> DataFrame:
        """The arcs of all senders in ``state(id, …)`` with the sender's other columns."""
        sender = state.withColumnRenamed("id", "from").join(F.broadcast(self.hubs), "from", "left")
        sent = sender.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        return self.table.join(sent, ["from", "part"])

    def discard(self) -> None:
        discard(self.table)
        discard(self.hubs)


def vertex_program(
    arcs: StoredArcs,
    state: DataFrame,
    message: Mapping[str, Column],
    combine: Callable[[DataFrame], DataFrame],
    update: Mapping[str, Column],
    vote: Column,
    max_rounds: int | None = None,
    on_round: Callable[[int, DataFrame], None] | None = None,
) -> DataFrame:
    """Run rounds until every vertex votes to halt, or for ``max_rounds``, and return the state.

    ``state`` has ``id``, columns of its own and ``active``. In a round only active
    vertices send: ``message`` is worked out from the arc and the sender's columns. ``combine``
    turns all messages ``(id, …)`` into one row per receiver; aggregations in it are combined
    before the shuffle, so a receiver of very many messages is no hot key. ``update`` makes the
    new columns from the old ones and the combined ones (null without a message), and ``vote`` tells
    whether the vertex sends in the next round. The state is written after each round, which
    cuts the lineage; the arcs are read where they lie.
    """
    names = state.columns
    state = materialize(state, "state")
    for done in itertools.count():
        if done == max_rounds or state.where("active").isEmpty():
            return state
        if on_round:
            on_round(done, state)
        mail = arcs.joined(state.where("active").drop("active")).select(F.col("to").alias("id"), *(c.alias(n) for n, c in message.items()))
        # Under other names first: inside a lambda Spark takes a new column for the old one of that name.
        new = {**{n: F.col(n) for n in names}, **update, "active": vote}
        step = state.join(combine(mail), "id", "left").select(*(new[n].alias(f"{n} #") for n in names)).toDF(*names)
        previous, state = state, materialize(step, "state")
        discard(previous)
