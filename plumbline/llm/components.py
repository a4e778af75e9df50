"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import materialise


def _mapped(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the parents of their ends, once each and without loops."""
    for end in ("a", "b"):
        parent = parents.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_parent"))
        edges = edges.join(parent, end, "left")
    a, b = (F.coalesce(f"{end}_parent", end) for end in ("a", "b"))
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()


def _roots(parents: DataFrame) -> DataFrame:
    """Each node with the root of its chain; a parent is always smaller than its node."""
    while True:
        found = parents
        for _ in range(2):
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            found = found.join(above, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent")
            )
        found = materialise(found, "roots")
        above = found.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        open_chains = found.join(above, "parent").where("above < parent").limit(1).count()
        if not open_chains:
            return found
        parents = found


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Each round hooks every node to its smallest neighbour, follows the chains to their roots and
    contracts the edges. At least one end of every edge is hooked, so the number of nodes that still
    have edges falls by half in a round. Repeated edges, both directions and loops do no harm; edges
    with a null end are left out; no edges give no rows.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    edges = materialise(edges, "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    state = nodes.select("node", F.col("node").alias("component"))
    edges = materialise(edges.where("a < b"), "edges")
    while edges.limit(1).count():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        parents = _roots(materialise(hooks, "hooks"))
        state = materialise(
            state.join(parents.withColumnRenamed("node", "component"), "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            ),
            "components",
        )
        edges = materialise(_mapped(edges, parents), "edges")
    return state
