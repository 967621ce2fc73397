"""Product codes of vectors: one codebook per part position, fitted by Lloyd's
rounds that compare a tree of parts with a tree of entries.

Vectors become integers and are cut into equal parts.  The parts of one
position are dealt into blocks of near parts; a block's tree, built once and
stored, has for every node a bounding box, the number of its parts and their
sum.  Each round a block's tree meets the tree over the codebook's entries,
node pair by node pair: an entry node farther from a node of parts than
another one certainly is goes, a node of parts that one entry wins as a whole
is assigned by its cached sum, and only the parts of uncertain leaves are
compared one by one.  All bounds and distances are integers, so ties and
results are exact."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import common

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK, LEAF, PIVOTS = 4096, 32, 16
MOST = 2**26  # of a component's size: squared distances stay far inside 64 bits
LABELS = 100_000  # totals of so many labels at most are broadcast
TREES = "part int, n int, rows binary, points binary, lo binary, hi binary, sums binary, first binary, last binary, left binary, right binary"


def integer_rows(table: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, vec_id, label, v): components floor(scale x), ``row`` a number of
    its own for each row.  Vectors that are null or empty, or hold null or
    non-finite components, are left out."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x"))
    rows = rows.filter("x is not null and size(x) > 0").filter(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    whole = F.transform("x", lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    return common.stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("v")), "integer-rows")


def checked_width(rows: DataFrame, parts: int) -> int:
    """The common length of a part; ValueError for vectors of several lengths,
    a length that ``parts`` doesn't divide, or components of ``MOST`` and more."""
    found = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most"), F.max(F.array_max(F.transform("v", F.abs))).alias("size")).first()
    if found["least"] is None:
        return 0
    if found["least"] != found["most"] or found["most"] % parts or found["size"] >= MOST:
        raise ValueError(f"vectors of {found['least']} to {found['most']} components up to {found['size']}: one length that {parts} divides "
                         f"and components under {MOST} are needed")
    return found["most"] // parts


def split_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """A tree over integer points by halving the widest side of the bounding
    box: the points' order; per node lo, hi, sum, first and last place in that
    order, left and right child (-1 in leaves).  Equal points are one leaf."""
    order = np.arange(len(points))
    lo, hi, sums, first, last, left, right = [], [], [], [], [], [], []

    def node(a: int, b: int) -> int:
        k, own = len(lo), points[order[a:b]]
        lo.append(own.min(0))
        hi.append(own.max(0))
        sums.append(own.sum(0))
        first.append(a)
        last.append(b)
        left.append(-1)
        right.append(-1)
        widest = int((hi[k] - lo[k]).argmax())
        if b - a > leaf and hi[k][widest] > lo[k][widest]:
            order[a:b] = order[a:b][np.argsort(own[:, widest], kind="stable")]
            left[k] = node(a, (a + b) // 2)
            right[k] = node((a + b) // 2, b)
        return k

    node(0, len(points))
    return (order, *(np.array(x, np.int64) for x in (lo, hi, sums, first, last, left, right)))


class Entries:
    """The tree over one codebook; equal entries share a leaf and the lowest
    index stands for them."""

    def __init__(self, book: np.ndarray):
        self.book, index = np.unique(book, axis=0, return_index=True)
        order, self.lo, self.hi, _, first, _, self.left, self.right = split_tree(self.book, 1)
        self.index = np.where(self.left < 0, index[order[first]], -1)  # of leaves: the entry


def assign(entries: Entries, book: np.ndarray, tree: dict[str, np.ndarray], counted: list[int] | None = None) -> tuple[list, np.ndarray, np.ndarray]:
    """Whole nodes as (node, entry), and the places of the remaining parts with
    their entries.  ``counted`` gets the number of single comparisons.

    The frontier is a list of pairs (node of parts, node of entries), sorted by
    the first.  A pair goes if its least possible distance is over the greatest
    possible one of another pair of that node of parts, or if every point of
    the box is nearer to another entry (as near, and that has the lower index)."""
    lo, hi, first, last, left, right = (tree[k] for k in ("lo", "hi", "first", "last", "left", "right"))
    whole, loose = [], []
    d, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(d):
        starts = np.flatnonzero(np.diff(d, prepend=-1))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(d))))
        over, under = entries.lo[e] - hi[d], lo[d] - entries.hi[e]
        least = (np.maximum(np.maximum(over, under), 0) ** 2).sum(1)
        most = (np.maximum(entries.hi[e] - lo[d], hi[d] - entries.lo[e]) ** 2).sum(1)
        keep = least <= np.minimum.reduceat(most, starts)[group]
        single = entries.left[e] < 0
        # One single entry per node of parts, that of the least greatest distance, against all other single ones.
        order = np.lexsort((most, ~single, d))[starts]
        best = order[group]
        rivals = single & single[best] & keep & (np.arange(len(d)) != best)
        if rivals.any():
            r, b = np.flatnonzero(rivals), best[rivals]
            x, y = entries.lo[e[r]], entries.lo[e[b]]
            corner = np.where(x > y, hi[d[r]], lo[d[r]])  # where the rival does best
            gap = ((corner - x) ** 2).sum(1) - ((corner - y) ** 2).sum(1)
            keep[r[(gap > 0) | ((gap == 0) & (entries.index[e[b]] < entries.index[e[r]]))]] = False
        d, e, single, group = d[keep], e[keep], single[keep], group[keep]
        alone = np.bincount(group)[group] == 1
        won = alone & single
        whole += list(zip(d[won].tolist(), entries.index[e[won]].tolist(), strict=True))
        bottom = left[d] < 0
        stuck = ~won & bottom & (np.bincount(group, ~single)[group] == 0)  # a leaf and single entries only
        loose.append((d[stuck], entries.index[e[stuck]]))
        go = ~won & ~stuck
        d, e, single, bottom = d[go], e[go], single[go], bottom[go]
        ds = np.column_stack([np.where(bottom, d, left[d]), np.where(bottom, -1, right[d])])
        es = np.column_stack([np.where(single, e, entries.left[e]), np.where(single, -1, entries.right[e])])
        d, e = np.repeat(ds, 2, axis=1).ravel(), np.tile(es, 2).ravel()
        real = (d >= 0) & (e >= 0)
        d, e = d[real], e[real]
        order = np.lexsort((e, d))
        d, e = d[order], e[order]
    nodes, rivals = (np.concatenate(x) for x in zip(*loose, strict=True))
    order = np.lexsort((rivals, nodes))
    nodes, rivals = nodes[order], rivals[order]
    places, chosen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for own, some in zip(*_groups(nodes, rivals), strict=True):
        points, near = tree["points"][first[own]:last[own]], book[some]
        far = (near * near).sum(1) - 2 * points @ near.T  # but for the part's own square, which is the same for all
        places.append(np.arange(first[own], last[own]))
        chosen.append(some[far.argmin(1)])  # ties: the lowest index
        if counted is not None:
            counted.append(far.size)
    return whole, np.concatenate(places), np.concatenate(chosen)


def _groups(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct sorted keys and the values of each."""
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.split(values, starts[1:]) if len(starts) else []


def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Part position and arrays of the stored trees, one tree at a time; boxes,
    sums and points as rows."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            out = {k: np.frombuffer(row[k], np.int64) for k in ("rows", "first", "last", "left", "right")}
            for k in ("lo", "hi", "sums"):
                out[k] = np.frombuffer(row[k], np.int64).reshape(len(out["first"]), -1)
            out["points"] = np.frombuffer(row["points"], np.int32).reshape(len(out["rows"]), -1).astype(np.int64)
            yield row["part"], out


def part_trees(rows: DataFrame, books: np.ndarray, width: int, block: int = BLOCK) -> DataFrame:
    """The stored trees (``TREES``), of about ``block`` parts each.  Parts are
    dealt by the nearest of ``PIVOTS`` entries, so that a block is a piece of
    space; a pivot with many parts has several blocks, chosen by the row's hash."""
    parts = len(books)
    pivots = [book[np.linspace(0, len(book) - 1, min(PIVOTS, len(book))).astype(int)] for book in books]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, parts, width)
            for k in range(parts):
                points, far = np.ascontiguousarray(x[:, k]), None
                for at, pivot in enumerate(pivots[k]):
                    new = ((points - pivot) ** 2).sum(1)
                    if far is None:
                        far, cell = new, np.zeros(len(new), np.int32)
                    else:
                        cell[new < far] = at
                        far = np.minimum(far, new)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(np.full(len(cell), k, np.int32)), pa.array(cell), pa.array([p.tobytes() for p in points.astype(np.int32)], pa.binary())],
                    names=["row", "part", "cell", "point"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        points = np.frombuffer(b"".join(group["point"]), np.int32).reshape(len(group), width).astype(np.int64)
        order, *nodes = split_tree(points, LEAF)
        stored = [group["row"].to_numpy(np.int64)[order], points[order].astype(np.int32), *nodes]
        return pd.DataFrame([[int(group["part"].iloc[0]), len(group), *(x.tobytes() for x in stored)]], columns=[c.split()[0] for c in TREES.split(", ")])

    dealt = common.stored(rows.select("row", "v").mapInArrow(deal, "row long, part int, cell int, point binary"), "dealt-parts")
    counts = dealt.groupBy("part", "cell").count().collect()  # parts x PIVOTS rows at most
    blocks = F.create_map(*[F.lit(x) for r in counts for x in (r["part"] * PIVOTS + r["cell"], -(-r["count"] // block))])
    salt = F.pmod(F.xxhash64("row"), blocks[F.col("part") * PIVOTS + F.col("cell")])
    trees = dealt.withColumn("salt", salt).groupBy("part", "cell", "salt").applyInPandas(build, TREES)
    return common.stored(trees, "part-trees")


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round.  Tasks send a count and a sum per entry."""
    parts, size, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [Entries(b) for b in books]
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for k, tree in loaded(batches):
            whole, places, chosen = assign(entries[k], books[k], tree)
            for node, entry in whole:
                count[k, entry] += tree["last"][node] - tree["first"][node]
                total[k, entry] += tree["sums"][node]
            np.add.at(count[k], chosen, 1)
            np.add.at(total[k], chosen, tree["points"][places])
        k, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[k, entry]), pa.array(total[k, entry].tolist(), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"])

    sums = trees.mapInArrow(add, "part int, entry int, n long, total array<long>").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(width)])
    new = books.copy()
    for part, entry, n, *total in sums.collect():  # parts x entries rows at most
        new[part, entry] = np.array(total, np.int64) // n
    return new


def codes_of_parts(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(row, part, entry, far) of every part: its entry and squared distance."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [Entries(b) for b in books]
        for k, tree in loaded(batches):
            whole, places, chosen = assign(entries[k], books[k], tree)
            entry = np.full(len(tree["rows"]), -1, np.int32)
            for node, e in whole:
                entry[tree["first"][node]:tree["last"][node]] = e
            entry[places] = chosen
            far = ((tree["points"] - books[k][entry]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(tree["rows"]), pa.array(np.full(len(entry), k, np.int32)), pa.array(entry), pa.array(far)],
                                             names=["row", "part", "entry", "far"])

    return trees.mapInArrow(find, "row long, part int, entry int, far long")


def first_books(rows: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """The parts of the ``entries`` rows with the smallest ids (null ids last,
    rows of one id by their components)."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    return np.array([r["v"] for r in least], np.int64).reshape(len(least), parts, width).swapaxes(0, 1).copy()


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[np.ndarray, DataFrame]:
    """Codebooks (parts x entries x width) after ``rounds`` rounds over the rows
    of ``integer_rows``, and the stored trees of parts.  The driver holds the
    codebooks only.  An entry that no part is nearest to stays as it is; fewer
    rows than ``entries`` make smaller codebooks."""
    width = checked_width(rows, parts)
    books = first_books(rows, parts, entries, width)
    trees = part_trees(rows, books, width, block)
    for _ in range(rounds):
        books = lloyd_round(trees, books)
    return books, trees


def sha256_of(books: np.ndarray) -> str:
    """Of all components in decimal, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, trees: DataFrame) -> DataFrame:
    """Per row of ``integer_rows``: row, vec_id, label, ``code`` (two hex digits
    per part) and ``error`` (squared distances summed over parts)."""
    own = codes_of_parts(trees, books).groupBy("row").agg(
        F.sum("far").alias("error"), *[F.max(F.when(F.col("part") == k, F.col("entry"))).alias(f"e{k}") for k in range(len(books))])
    code = F.lower(F.concat(*[F.lpad(F.hex(F.col(f"e{k}")), 2, "0") for k in range(len(books))]))
    return rows.select("row", "vec_id", "label").join(own, "row").select("row", "vec_id", "label", code.alias("code"), "error")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: errors summed over equal labels, null
    labels together.  Few totals are broadcast; many are joined by label, where
    adaptive execution splits a frequent one."""
    totals = common.stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    if totals.count() <= LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def compressed(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
               id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector.

    Vectors that are null or empty, or hold null or non-finite components, are
    left out; repeated rows and ids are rows of their own, a null id stays null.
    Vectors of several lengths, of a length that ``parts`` doesn't divide or
    with scaled components of 2^26 and more raise ValueError.  Other columns
    don't matter; an empty table gives no rows."""
    rows = integer_rows(table, SCALE, id_col, vector_col, label_col)
    if rows.isEmpty():
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
                           F.lit("").alias("codebooks_sha256"))
    books, trees = fit(rows, parts, entries, rounds, block)
    coded = common.stored(encode(rows, books, trees), "codes")
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(sha256_of(books)).alias("codebooks_sha256"))


