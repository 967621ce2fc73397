"""Exact top-k inner products by best-first search in M-trees.

Inner products become distances by one more coordinate: with
x' = (x, sqrt(M - |x|^2)) and q' = (q, 0), M the largest |x|^2, the squared
distance is |q|^2 + M - 2 q.x, so the nearest neighbour has the largest
product.  Vectors are dealt into trees of bounded size; a tree's pages (nodes)
are rows of a table: pivots, covering radii, distances to the parent's pivot.
The search opens pages by least possible distance and skips an entry without
computing its distance when the stored parent distance already rules it out
by the triangle inequality.  Components are integers, so scores are exact."""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plexus.llm import common

FANOUT, LEAF, TREE, QUERIES = 32, 128, 16384, 8192
ABSENT = -(2**62)
NODES = "tree int, node int, leaf boolean, ids binary, vectors binary, radii binary, parents binary"


def integer_vectors(table: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): each component floor(scale x).  Vectors that are null, empty
    or hold null or non-finite components, and null ids, are left out."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
    rows = rows.filter(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"))


def build(tree: int, ids: np.ndarray, points: np.ndarray) -> list[tuple]:
    """Pages of one tree over lifted points (rows of float64), root first.  A
    page's entries hold a vector, a covering radius (0 in leaves) and the
    distance to the page's own pivot (the parent)."""
    pages: list[tuple] = []
    rng = np.random.default_rng(len(ids))

    def page(index: np.ndarray, pivot: np.ndarray | None) -> int:
        number = len(pages)
        pages.append(())
        distance = lambda x: np.zeros(len(x)) if pivot is None else np.sqrt(((x - pivot) ** 2).sum(1))
        if len(index) <= LEAF:
            x = points[index]
            pages[number] = (tree, number, True, ids[index].tobytes(), x.tobytes(), np.zeros(len(index)).tobytes(), distance(x).tobytes())
            return number
        fanout = min(FANOUT, max(2, 2 * len(index) // LEAF))  # leaves about half full, not crumbs
        pivots = points[rng.choice(index, fanout, replace=False)]
        x = points[index]
        square = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None, :]
        nearest = square.argmin(1)
        if np.bincount(nearest, minlength=fanout).max() == len(index):  # equal points
            nearest = np.arange(len(index)) % fanout
        children, kept, radii = [], [], []
        for k in range(fanout):
            part = index[nearest == k]
            if len(part):
                kept.append(pivots[k])
                radii.append(np.sqrt(((points[part] - pivots[k]) ** 2).sum(1).max()))
                children.append(page(part, pivots[k]))
        kept = np.array(kept)
        pages[number] = (tree, number, False, np.array(children, np.int64).tobytes(), kept.tobytes(), np.array(radii).tobytes(),
                         distance(kept).tobytes())
        return number

    page(np.arange(len(ids)), None)
    return pages


def search(pages: dict[int, tuple], queries: np.ndarray, own: np.ndarray, k: int, most: float) -> list[tuple[int, int, int]]:
    """(query's row, id, score) of the ``k`` best entries of a tree for each row
    of ``queries`` (lifted), ties to smaller ids, without the id in ``own``;
    ``most`` is M.

    Each query opens pages by least possible distance until no waiting page can
    hold a better entry.  Queries that open the same page in the same step are
    compared with its entries together; an entry that the stored parent
    distance rules out for all of them is not compared at all."""
    n, places = len(queries), np.arange(len(queries))
    square = (queries * queries).sum(1)
    base = square + most
    slack = 1e-9 * (1 + base)  # what rounding may hide, in squared distances
    limit = np.full(n, np.inf)  # squared distance of the k-th best
    low, to_pivot = np.full((n, max(pages.keys()) + 1), np.inf), np.zeros((n, max(pages.keys()) + 1))
    low[:, 0] = 0
    scores, ids = np.full((n, k), ABSENT), np.full((n, k), np.iinfo(np.int64).max)
    while True:
        next_page = low.argmin(1)
        least = low[places, next_page]
        rows = np.flatnonzero(np.isfinite(least) & (least * least <= limit + slack))
        if not len(rows):
            break
        rows = rows[np.argsort(next_page[rows], kind="stable")]
        for g in np.split(rows, np.flatnonzero(np.diff(next_page[rows])) + 1):
            number = int(next_page[g[0]])
            low[g, number] = np.inf
            leaf, entries, vectors, radii, parents = pages[number]
            near = np.ones((len(g), len(entries)), bool)
            if number:
                reach = np.sqrt(limit[g] + slack[g]) + 1e-6 * np.sqrt(1 + base[g])
                near = np.abs(to_pivot[g, number][:, None] - parents) - radii <= reach[:, None]
            some = np.flatnonzero(near.any(0))
            if not len(some):
                continue
            near, entries, x, q = near[:, some], entries[some], vectors[some], queries[g]
            if leaf:
                found = np.rint(q[:, :-1] @ x[:, :-1].T).astype(np.int64)
                found[~near | (entries == own[g][:, None])] = ABSENT
                better = ((found >= scores[g, -1:]) & (found > ABSENT)).any(1)
                g, found = g[better], found[better]
                both = np.hstack([scores[g], found])
                names = np.hstack([ids[g], np.where(found > ABSENT, entries, np.iinfo(np.int64).max)])
                order = np.lexsort((names, -both))[:, :k]
                scores[g], ids[g] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
                limit[g] = np.where(scores[g, -1] > ABSENT, base[g] - 2.0 * scores[g, -1], np.inf)
            else:
                far = np.sqrt(np.maximum(square[g][:, None] + (x * x).sum(1) - 2 * (q @ x.T), 0))
                to_pivot[g[:, None], entries] = far
                low[g[:, None], entries] = np.where(near, np.maximum(far - radii[some], 0), np.inf)
    row, rank = np.nonzero(scores > ABSENT)
    return list(zip(row.tolist(), ids[row, rank].tolist(), scores[row, rank].tolist(), strict=True))


def build_index(vectors: DataFrame, tree_size: int = TREE) -> tuple[DataFrame, int, float]:
    """The table of pages, the number of trees, and M.  Vectors are dealt to
    trees by hash, so a tree holds about ``tree_size`` of them."""
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    facts = vectors.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    trees, most = max(1, -(-facts["n"] // tree_size)), float(facts["m"] or 0)

    def pages(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["vec_id"])
        x = np.array(group["v"].tolist(), float)
        lifted = np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]])
        rows = build(int(group["tree"].iloc[0]), group["vec_id"].to_numpy(np.int64), lifted)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in NODES.split(", ")])

    dealt = vectors.withColumn("tree", F.pmod(F.xxhash64("vec_id", "v"), F.lit(trees)).cast("int"))
    return common.stored(dealt.groupBy("tree").applyInPandas(pages, NODES), "m-tree"), trees, most


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, tree_size: int = TREE, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries (vec_id, v) against all
    ``vectors`` but those with the query's id; fewer than ``k`` if there are no more.

    Every block of queries meets every tree: a tree's pages and a block are
    gathered in one task, both of bounded size.  Vectors of one length are
    expected; an empty table gives no rows."""
    index, trees, most = build_index(vectors, tree_size)
    blocks = max(1, -(-queries.count() // block))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    pages = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(key, asked: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pages) and len(asked):
            width = len(asked["v"].iloc[0]) + 1
            load = lambda b, t: np.frombuffer(b, t)
            held = {r.node: (r.leaf, load(r.ids, np.int64), load(r.vectors, float).reshape(-1, width), load(r.radii, float), load(r.parents, float))
                    for r in pages.itertuples()}
            names = asked["vec_id"].to_numpy(np.int64)
            x = np.array(asked["v"].tolist(), float)
            out = [(names[i], j, s) for i, j, s in search(held, np.hstack([x, np.zeros((len(x), 1))]), names, k, most)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.groupBy("tree", "block").cogroup(pages.groupBy("tree", "block")).applyInPandas(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
