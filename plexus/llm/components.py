"""Connected components of a link table by alternating large and small stars.

Each round links every node's larger neighbours to its least neighbour, then
its smaller ones; the edges shrink to stars around the least node of each
component in a number of rounds that grows with the logarithm of its size.
Nothing but one count per round reaches the driver.  Links that come later are
taken between the components found so far (``extended``), so that a round only
handles what has come together since."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import stored

FEW = 20_000  # a table of at most so many links is one partition: its rounds need no shuffles


def _pairs(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v): each row's ``pairs`` of columns as rows."""
    return edges.select(F.explode(F.array(*[F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in pairs])).alias("p")).select("p.*")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = _pairs(edges, ("u", "v"), ("v", "u")) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = _pairs(linked, ("v", "m"), ("u", "m"))
    return out.filter("u != v").distinct()


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node either has one edge to its root or is a root."""
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                   F.struct(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = edges.select(F.explode(ends).alias("e")).groupBy("e.x").agg(F.sum("e.out").alias("out"), F.max("e.into").alias("into"))
    return nodes.agg(F.count_if(F.expr("out > 1 or out = 1 and into = 1"))).first()[0] == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` but the roots themselves; the
    root is the least node of the component.  Self links and repeats are
    ignored; no links give no rows."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "component-links")
    parts = (lambda edges: edges.coalesce(1)) if edges.count() <= FEW else (lambda edges: edges)
    while not _stars_only(parts(edges)):
        edges = stored(_star(_star(parts(edges), True), False), "component-links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def between(links: DataFrame, roots: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b): the distinct pairs of components that ``links`` lie between, by their roots."""
    known = roots.select(F.col("node").alias(a), F.col("root").alias("_ra")), roots.select(F.col("node").alias(b), F.col("root").alias("_rb"))
    ends = links.select(a, b).join(known[0], a, "left").join(known[1], b, "left").select(F.coalesce("_ra", a).alias(a), F.coalesce("_rb", b).alias(b))
    return ends.filter(F.col(a) != F.col(b)).distinct()


def extended(roots: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``components`` of the links that gave ``roots`` and of ``links``."""
    more = components(between(links, roots, a, b), a, b)
    moved = more.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return roots.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root")).union(more)
