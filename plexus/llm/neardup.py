"""Near-duplicate documents: MinHash bands, sequential Bayesian verification,
exact confirmation.

Documents with equal shingle sets form a class, which is handled once.  Banded
MinHash proposes pairs of classes; each pair's signatures are compared in
batches, and the pair is given up as soon as the posterior probability that
its similarity reaches the threshold falls below a chosen miss probability;
survivors are compared on their full shingle sets.

Pairs within a band bucket are not all formed.  First members are compared with
their buckets' least members, in a few rounds of one pair per class.  What lies
in one component is not compared again.  Buckets that still hold several
components are then cut at random into cells of a few members, anew in each
round, whose members are compared with one of the cell: near copies that are not
all near to the least member come together so.  Members of one bucket that are still in
different components (texts with a common passage, mostly) are compared only
if they share a shingle of their prefixes: a class's shingles are ordered by
how many of these members hold them, rarest first; two sets that reach the
threshold t share t / (1 + t) of their sizes' sum, so the first shingle they
share must leave that many places behind it in both.  A class whose first
places are its own text alone meets nobody."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plexus.llm import common
from plexus.llm.components import components, extended
from plexus.llm.shingles import shingle_sets

ROWS, BANDS, BATCH = 4, 32, 16  # a pair of similarity 0.8 misses all bands with probability 5e-8
HASHES = ROWS * BANDS
MISS = 1e-7
STARS = 5  # rounds of comparisons with a bucket's least member
CELLS, CELL = 4, 4  # rounds of comparisons within cells, and members of a cell on average
PICKS = 4  # pairs of each class in the first round of what is left; each round takes as many times more
SALTS = 32  # tasks that the classes of one large component are spread over


def seeds(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash signatures (rows of uint32) of non-empty sets in a row."""
    a, b = seeds()
    out = np.empty((len(starts) - 1, HASHES), np.uint32)
    first, n = 0, len(starts) - 1
    while first < n:  # a few hundred thousand shingles at once stay in the CPU's cache
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + 65536, side="right")) - 1)
        x, at = sets[starts[first]:starts[last]], starts[first:last] - starts[first]
        for k in range(HASHES):
            out[first:last, k] = np.minimum.reduceat(x * a[k] + b[k], at) >> np.uint64(32)
        first = last
    return out


def document_sets(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, hash of its text, ``n_shingles``, class ``cid`` (64-bit
    hash of the set; null for an empty set), signature."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 2 << 20):
            found, starts = shingle_sets(batch.column("text"), width)
            counts = np.diff(starts)
            full = counts > 0
            sig = signatures(found, np.append(starts[:-1][full], starts[-1])) if full.any() else np.zeros((0, HASHES), np.uint32)
            cid, rows, k = [], [], 0
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                cid.append(xxhash.xxh3_64_intdigest(found[a:b].tobytes()) - 2**63 if b > a else None)
                rows.append(sig[k].tobytes() if b > a else None)
                k += b > a
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("h").cast(pa.int64()), pa.array(counts), pa.array(cid, pa.int64()), pa.array(rows, pa.binary())],
                names=["doc_id", "h", "n_shingles", "cid", "sig"])

    rows = common.id_and_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    return common.stored(rows.mapInArrow(sets, "doc_id long, h long, n_shingles long, cid long, sig binary"), "shingle-sets")


def least_matches(percent: int, miss: float) -> np.ndarray:
    """For 0, BATCH, 2 BATCH ... hashes compared: the fewest matches with which
    P(similarity >= threshold | matches) >= miss under a uniform prior.  The
    posterior is a Beta distribution with integer parameters, so the tail is a
    binomial sum: P(Binomial(n + 1, t) <= m)."""
    t, least = percent / 100, [0]
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        least.append(m)
    return np.array(least)


def bayes_survivors(pairs: DataFrame, classes: DataFrame, percent: int, miss: float = MISS) -> DataFrame:
    """Pairs (a, b) that no batch of hashes rules out."""
    least = least_matches(percent, miss)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = np.arange(batch.num_rows)
            sig = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, HASHES) for k in ("sig_a", "sig_b")]
            matches = np.zeros(len(alive), np.int64)
            for k, at in enumerate(range(0, HASHES, BATCH), 1):
                matches += (sig[0][alive, at:at + BATCH] == sig[1][alive, at:at + BATCH]).sum(1)
                keeps = matches >= least[k]
                alive, matches = alive[keeps], matches[keeps]
            yield batch.take(pa.array(alive)).select(["a", "b"])

    sig = classes.select("cid", "sig")
    both = pairs.join(sig.withColumnsRenamed({"cid": "a", "sig": "sig_a"}), "a").join(
        sig.withColumnsRenamed({"cid": "b", "sig": "sig_b"}), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(keep, "a long, b long")


def class_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, text), the text of one document of each class, stored."""
    wanted = classes.select("cid", "rep", "rep_h")
    texts = docs.withColumn("h", F.xxhash64("text")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("h") == F.col("rep_h")))
    return common.stored(texts.select("cid", "text").dropDuplicates(["cid"]), "class-texts")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold, by the texts of one
    document per class.  The text of b comes first: rows are large and spread
    before they meet at a class that has many pairs, where adaptive execution
    splits them."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text_a", 2 << 20, 1000):
            n, keep = batch.num_rows, []
            distinct = pa.concat_arrays([batch.column(k).cast(pa.large_string()) for k in ("text_a", "text_b")]).dictionary_encode()
            sets, starts = shingle_sets(distinct.dictionary, width)
            at = distinct.indices.to_numpy()
            for i in range(n):
                x, y = (sets[starts[j]:starts[j + 1]] for j in (at[i], at[n + i]))
                common_size = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common_size >= percent * (len(x) + len(y) - common_size))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    some = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "cid", "left_semi")
    both = pairs.join(some.withColumnsRenamed({"cid": "b", "text": "text_b"}), "b").join(
        some.withColumnsRenamed({"cid": "a", "text": "text_a"}), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def shingle_rows(texts: DataFrame, width: int) -> DataFrame:
    """(cid, s): every shingle of every class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 1 << 20):
            sets, starts = shingle_sets(batch.column("text"), width)
            cid = np.repeat(batch.column("cid").to_numpy(), np.diff(starts))
            yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(sets.view(np.int64))], names=["cid", "s"])

    return texts.mapInArrow(rows, "cid long, s long")


def prefix_pairs(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (cid, n, root) in different components that
    share a shingle early enough in both orders: every pair that reaches the
    threshold is among them."""
    shingles = common.stored(shingle_rows(texts.join(members.select("cid"), "cid", "left_semi"), width), "member-shingles")
    counts = common.stored(shingles.groupBy("s").agg(F.count("*").alias("c"), F.max("cid").alias("own")), "shingle-counts")
    alone = counts.filter("c = 1").groupBy(F.col("own").alias("cid")).agg(F.count("*").alias("alone"))
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / 100) + 1
    meet = members.join(alone.withColumn("alone", F.col("alone").cast("long")), "cid", "left").na.fill({"alone": 0}).withColumn("prefix", prefix)
    meet = common.stored(meet.filter("alone < prefix"), "meeting-members")
    shared = shingles.join(meet, "cid").join(counts.filter("c > 1").select("s", "c"), "s")
    rarest = Window.partitionBy("cid").orderBy("c", "s")
    first = shared.withColumn("place", F.col("alone") + F.row_number().over(rarest)).filter("place <= prefix")
    first = common.stored(first.select("cid", "n", "root", "s", (F.col("n") - F.col("place") + 1).alias("left")), "prefixes")
    # From the first common shingle on, both sets must hold all they have in common: t / (1 + t) of both sizes.
    enough = lambda sizes, left: sizes * percent <= left * (100 + percent)
    x, y = first.filter(enough(2 * F.col("n"), F.col("left"))).alias("x"), first.alias("y")  # x is the smaller set
    order = F.struct("x.n", "x.cid") < F.struct("y.n", "y.cid")
    sizes = F.col("x.n") + F.col("y.n")
    met = x.join(y, (F.col("x.s") == F.col("y.s")) & order & (F.col("x.root") != F.col("y.root")) & enough(sizes, F.col("x.left")) & enough(sizes, F.col("y.left")))
    return met.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).distinct()


def close(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``near_duplicate_groups`` without ``h`` and ``root``."""
    return near_duplicate_groups(docs, width, percent, id_col, text_col).drop("h", "root")


def near_duplicate_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id
    reachable over links of at least ``percent`` % similarity), ``kept`` (id =
    component id), ``cid``, hash ``h`` of its text, ``root`` (one number per
    component, whatever its ids; null without words).

    A document without words is alone.  Rows with one id and text are in one
    component and share ``kept``; a null id joins a component but never names
    one unless all its ids are null.  An empty table gives no rows.  Two
    different sets share a 64-bit ``cid`` with a chance of n^2 / 2^65."""
    with common.arrow_batches(docs.sparkSession), common.shuffles_freed(docs.sparkSession):  # all Python work below is done when it ends
        return _groups(docs, width, percent, id_col, text_col)


def _groups(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    source = common.id_and_text(docs, id_col, text_col)
    sets = document_sets(docs, width, id_col, text_col)
    classes = common.stored(sets.filter("cid is not null").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.min_by("h", "doc_id").alias("rep_h"), F.max("h").alias("any_h"),
        F.max("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    classes = classes.withColumn("rep_h", F.coalesce("rep_h", "any_h"))
    band = F.explode(F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 4 * ROWS * k + 1, 4 * ROWS)) for k in range(BANDS)]))
    bands = classes.select(band.alias("band"), "cid", "n")
    hubs = bands.groupBy("band").agg(F.min("cid").alias("hub"), F.min_by("n", "cid").alias("hub_n"), F.count("*").alias("members"))
    hubs = common.stored(hubs.filter("members > 1").drop("members"), "hubs")
    crowds = common.stored(bands.join(hubs, "band"), "crowds")
    texts = class_texts(source, classes.join(crowds.select("cid").distinct(), "cid", "left_semi"))
    stars = common.stored(crowds.filter((F.col("cid") != F.col("hub")) & close(F.col("n"), F.col("hub_n"), percent)).select(
        F.col("hub").alias("a"), F.col("cid").alias("b")).distinct(), "stars")
    roots = _star_roots(stars, classes, texts, width, percent)
    roots = _cell_roots(crowds, roots, classes, texts, width, percent)
    # What is left: members of one bucket in different components.
    members = common.stored(_mixed(crowds, roots).select("cid", "n", "root").distinct(), "mixed-members")
    roots = _pair_roots(common.stored(prefix_pairs(members, texts, width, percent), "prefix-pairs"), roots, classes, texts, width, percent)
    # Components of one class keep their own id; a large one's rows are spread over salts.
    least = roots.join(classes.select(F.col("cid").alias("node"), "rep"), "node").groupBy("root").agg(F.min("rep").alias("least"))
    ids = least.join(classes.select(F.col("cid").alias("root"), "rep"), "root").select("root", F.least("least", "rep").alias("component_id"))
    ids = common.stored(ids, "component-ids")
    salted = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = roots.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"])
    joined = spread.select(F.col("node").alias("cid"), "root", "component_id").union(ids.select("root", "root", "component_id"))
    named = classes.select("cid", "rep").join(joined, "cid", "left").select(
        "cid", F.coalesce("root", "cid").alias("root"), F.coalesce("component_id", "rep").alias("component_id"))
    out = sets.select("doc_id", "n_shingles", "cid", "h").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "cid", "h", "root")


def _star_roots(stars: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The components that links among the pairs (bucket's least member a,
    member b) make.  Each round compares one pair per class whose ends lie in
    different components; what is left then is for ``prefix_pairs``."""
    left, roots = stars, None
    for _ in range(STARS):
        if roots is not None:
            left = _different(left, roots)
        picked = common.stored(left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "star-pairs")
        new = _links(picked, classes, texts, width, percent)
        roots = common.stored(components(new) if roots is None else extended(roots, new), "star-roots")
        left = common.stored(left.join(picked, ["a", "b"], "left_anti"), "star-rest")
        if left.isEmpty():
            break
    return roots


def _mixed(crowds: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, cid, n, root, members) of the buckets that hold several components."""
    crowded = crowds.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("band", "cid", "n", F.coalesce("root", "cid").alias("root"))
    mixed = crowded.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("members")).filter("r0 != r1")
    return crowded.join(mixed.select("band", "members"), "band")


def _cell_roots(crowds: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``roots`` after the links of ``CELLS`` rounds within random cells of the
    mixed buckets.  A round compares at most ``PICKS`` pairs per class; what it
    leaves is for the next rounds and ``prefix_pairs``."""
    for turn in range(CELLS):
        cell = F.pmod(F.xxhash64(F.lit(turn), "cid"), F.ceil(F.col("members") / CELL))
        cells = common.stored(_mixed(crowds, roots).withColumn("cell", cell), "cells")
        if cells.isEmpty():
            break
        least = F.struct(F.xxhash64(F.lit(turn), "band", "cid").alias("by"), F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
        heads = cells.groupBy("band", "cell").agg(F.min(least).alias("head")).select("band", "cell", "head.a", "head.n_a", "head.root_a")
        pairs = cells.join(heads, ["band", "cell"]).filter((F.col("root") != F.col("root_a")) & close(F.col("n"), F.col("n_a"), percent))
        pairs = pairs.select(F.least("a", "cid").alias("a"), F.greatest("a", "cid").alias("b")).distinct()
        few = Window.partitionBy("b").orderBy(F.xxhash64("a", "b"), "a")
        picked = common.stored(pairs.withColumn("k", F.row_number().over(few)).filter(F.col("k") <= PICKS).select("a", "b"), "cell-pairs")
        roots = common.stored(extended(roots, _links(picked, classes, texts, width, percent)), "cell-roots")
    return roots


def _different(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose ends lie in different components."""
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a")), roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return pairs.join(known[0], "a", "left").join(known[1], "b", "left").filter(
        F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _pair_roots(pairs: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``roots`` after the links among the stored ``pairs``, but for pairs whose
    ends earlier links connect.  Each round compares ``PICKS`` times as many
    pairs per class as the one before, chosen by hash, and then leaves out what
    has come together; it ends when no pair is left, so none is dropped."""
    left, picks = pairs, PICKS
    while not left.isEmpty():
        few = Window.partitionBy("b").orderBy(F.xxhash64("a", "b"), "a")
        picked = common.stored(left.withColumn("k", F.row_number().over(few)).filter(F.col("k") <= picks).select("a", "b"), "picked-pairs")
        roots = common.stored(extended(roots, _links(picked, classes, texts, width, percent)), "pair-roots")
        left = common.stored(_different(left.join(picked, ["a", "b"], "left_anti"), roots), "pairs-left")
        picks *= PICKS
    return roots


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    alive = common.stored(bayes_survivors(pairs, classes, percent), "survivors")
    return common.stored(confirmed(alive, texts, width, percent), "links")
