"""Connected components of a graph of pairs, by alternating stars (Kiveris et al., 2014): nothing is collected.

Before each round, a task replaces the edges it reads by stars of their own components, a bounded number at a time. This
needs no shuffle, keeps what is connected, and spares rounds. The end is seen by one aggregation, not by a further round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import written

#: Edges that a task contracts at a time.
EDGES = 1 << 19


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stars of the components of some edges: each node but the least of its component, and that least node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        for end in (u, v):
            np.minimum.at(new, root[end], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    apart = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[apart], nodes[root[apart]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def solved(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = contracted(*(np.concatenate([h.column(i).to_numpy(zero_copy_only=False) for h in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

    held = []
    for batch in batches:
        held.append(batch)
        if sum(h.num_rows for h in held) >= EDGES:
            yield solved(held)
            held = []
    if held:
        yield solved(held)


def _least(e: DataFrame) -> DataFrame:
    """Rows a, b of `e` with m, the least b of each a.

    Minima are formed before the shuffle. Small minima are broadcast; else the join deals the edges of one a, at most one
    of each node and task that read it, to one task.
    """
    return e.join(e.groupBy("a").agg(F.min("b").alias("m")), "a")


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood; pairs may repeat."""
    both = _least(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    return both.select("a", "b", F.least("a", "m").alias("m")).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them."""
    near = _least(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    return (
        near.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        .select("e.*").where("a <> b").distinct()
    )


def _only_stars(e: DataFrame) -> bool:
    """Whether no node has two different b, and none is the b of one edge and the a of another."""
    roles = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")), F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("up"))))
    nodes = e.select(roles.alias("r")).select("r.*").groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max(F.col("up").isNull()).alias("is_b"))
    return nodes.where("low <> high or (low is not null and is_b)").isEmpty()


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """Columns a (node) and b (the least node of its component), for all nodes but those least ones.

    `edges` has columns a and b of one whole-number type, without nulls; loops and repeated or reversed pairs do no harm.
    Each round writes its edges to the shared folder, so lineage stays short and lost executors cost one round at most.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    e = written(pairs.mapInArrow(_contract, "a long, b long"), tag)
    while not _only_stars(e):
        rounds = written(_small_star(_large_star(e)), tag)
        e = written(rounds.mapInArrow(_contract, "a long, b long"), tag)
    return e.groupBy("a").agg(F.min("b").alias("b"))  # stars of several tasks may repeat an edge; a join on a needs no further shuffle
