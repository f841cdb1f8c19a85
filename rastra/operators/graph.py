"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.storage import exchanged, settle

#: Links up to which a graph of the raster operators is finished in one task: 4 MB of ids.
SMALL = 1 << 18


def _through(table: DataFrame, col: str, parents: DataFrame) -> DataFrame:
    """Replace ``col`` by its parent where it has one."""
    p = parents.select(F.col("id").alias("_pid"), F.col("parent").alias("_pp"))
    return (
        table.join(exchanged(p), F.col(col) == F.col("_pid"), "left")
        .withColumn(col, F.coalesce("_pp", col))
        .drop("_pid", "_pp")
    )


def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of links that fit in memory, in order, and the smallest id that each reaches."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    parent = np.arange(len(ids))
    while True:
        ends = parent[u], parent[v]
        low, high = np.minimum(*ends), np.maximum(*ends)
        if (low == high).all():
            return ids, ids[parent]
        np.minimum.at(parent, high, low)
        while (parent != parent[parent]).any():
            parent = parent[parent]


def _finish(live: DataFrame) -> DataFrame:
    """``id, parent`` of the nodes of a small edge table that aren't their component's smallest, from one task."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links = list(parts)
        if links:
            whole = pd.concat(links)
            ids, least = smallest_reachable(whole["a"].to_numpy(), whole["b"].to_numpy())
            yield pd.DataFrame({"id": ids, "parent": least})[ids != least]

    return live.select("a", "b").coalesce(1).mapInPandas(run, "id long, parent long")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", small: int = 0) -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    Returns ``id, component``. Each round hooks every node to its smallest
    neighbour, collapses the trees by pointer doubling and contracts the edges,
    so that the edge table at least halves its nodes a round. Every round is
    written to the shared folder, which cuts the lineage and survives the loss
    of executors. Null ends, self loops and repeated edges have no effect; no
    edges give an empty result. Once at most ``small`` edges are left one task
    finishes them, which gives the same result without the small jobs of the last rounds.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    ends = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    nodes = settle(ends.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "cc_links")
    live = nodes.where("a < b")
    roots = settle(nodes.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "cc_nodes")
    found: DataFrame | None = None
    while not live.isEmpty():
        if small and live.limit(small + 1).count() <= small:
            parents = settle(_finish(live), "cc_parents")
            found = parents if found is None else _through(found, "parent", parents).unionByName(parents)
            break
        parents = settle(live.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("parent")), "cc_parents")
        while True:
            p = parents.select(F.col("id").alias("_pid"), F.col("parent").alias("_pp"))
            jumped = settle(
                parents.join(exchanged(p), F.col("parent") == F.col("_pid"), "left").select(
                    "id", F.coalesce("_pp", "parent").alias("parent"), F.col("_pp").isNotNull().alias("moved")
                ),
                "cc_parents",
            )
            parents = jumped.select("id", "parent")
            if jumped.where("moved").isEmpty():
                break
        found = parents if found is None else settle(_through(found, "parent", parents).unionByName(parents), "cc_found")
        live = _through(_through(live, "a", parents), "b", parents)
        live = settle(
            live.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
            "cc_edges",
        )
    if found is None:
        return roots.select("id", F.col("id").alias("component"))
    return roots.join(exchanged(found), "id", "left").select("id", F.coalesce("parent", "id").alias("component"))
