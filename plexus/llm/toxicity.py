"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words sums over their common subsequences of three
characters, each weighted by decay to the power of the stretch it covers in
either word, so letters put in or left out lower the similarity but don't end
it.  Nyström's method turns it into features: kernel values against a few
landmark words, whitened by the landmarks' own kernel matrix.  The machine is
linear in the subsequences, so its landmarks and weights fold into one weight
per subsequence of three characters, and a word is scored by its own
subsequences without a kernel value per landmark.  Training
follows the multiple-instance scheme: sentences carry their document's label,
a sentence is represented by its most suspicious word, and of a toxic document
only the most suspicious sentence counts; machine and choice are refined in
turn.  A document's probability is a logistic function of the margins of its
three most suspicious words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import common

DECAY, SPAN, SHORT, TOP = 0.6, 24, 4, 3
FIRST, LAST = "\x02", "\x03"  # around words of one and two letters, which have no subsequence of three
KEPT, LONGEST_KEPT = 50_000, 32  # words whose margins a worker keeps, and their length: some ten megabytes
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‚‘’…¿¡"
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")


def coded(words: list[str], width: int) -> np.ndarray:
    """Words as rows of code points, padded with 0."""
    return np.array([w.ljust(width, "\0") for w in words], f"<U{width}").view(np.uint32).reshape(len(words), width)


def kernel(words: list[str], marks: list[str], decay: float = DECAY) -> np.ndarray:
    """Gap-weighted kernel of order 3 between words and landmarks, by dynamic
    programming over character positions for all pairs at once; landmarks of
    like length together, so that little of it runs over padding."""
    out = np.zeros((len(words), len(marks)), np.float32)
    if not words or not marks:
        return out
    x = coded(words, max(map(len, words)))
    lengths = np.array([len(m) for m in marks])
    for width in np.unique(-(-lengths // 2)):
        at = np.flatnonzero(-(-lengths // 2) == width)
        y = coded([marks[k] for k in at], int(lengths[at].max()))
        out[:, at] = _subsequences(x[:, None, :], y[None, :, :], decay)
    return out


def own(words: list[str]) -> np.ndarray:
    """Kernel of each word with itself."""
    if not words:
        return np.zeros(0, np.float32)
    x = coded(words, max(map(len, words)))
    return _subsequences(x, x, DECAY)


def _subsequences(x: np.ndarray, y: np.ndarray, decay: float) -> np.ndarray:
    """The recursion over the last axis of ``x`` and ``y`` (0 is padding), for all
    pairs that their other axes form."""
    width, length = x.shape[-1], y.shape[-1]
    shape, d = np.broadcast_shapes(x.shape[:-1], y.shape[:-1]), np.float32(decay)
    total = np.zeros(shape, np.float32)
    one = [np.zeros(shape, np.float32) for _ in range(length)]  # subsequences of one and two characters
    two = [np.zeros(shape, np.float32) for _ in range(length)]  # that end before this position, decayed to it
    for s in range(width):
        same = [((x[..., s] == y[..., t]) & (x[..., s] != 0)).astype(np.float32) * (d * d) for t in range(length)]
        run1, run2, new1, new2 = np.zeros(shape, np.float32), np.zeros(shape, np.float32), [], []
        for t in range(length):
            run2 = run2 * d
            if t:
                total += same[t] * two[t - 1]
                run2 += same[t] * one[t - 1]
            run1 = run1 * d + same[t]
            new1.append(one[t] * d + run1)
            new2.append(two[t] * d + run2)
        one, two = new1, new2
    return total


@lru_cache(maxsize=SPAN + 3)
def triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places i < j < k within a word, and the decay of the stretch they cover."""
    i, j, k = np.array(list(combinations(range(length), 3)), np.int64).reshape(-1, 3).T
    return i, j, k, DECAY ** (k - i + 1.0)


class Machine:
    """Landmarks, weights and calibration; ``margins`` scores words."""

    def __init__(self, marks: list[str]):
        self.marks, self.own_marks = marks, own(marks)
        k = kernel(marks, marks) / np.sqrt(np.outer(self.own_marks, self.own_marks))
        values, vectors = np.linalg.eigh(k.astype(float) + 1e-6 * np.eye(len(marks)))
        self.whiten = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
        self.weights, self.bias, self.curve = np.zeros(len(marks)), 0.0, np.zeros(TOP + 1)
        self.letters = np.unique(np.array(list("".join(marks)), "<U1").view(np.uint32))
        self.fold()

    def fold(self) -> None:
        """One weight per subsequence: ``rows`` gives the row of ``table`` for its
        first two letters, the column is its third; row and column 0 are zero."""
        self.cache: dict[str, float] = {}
        self.chunk_cache: dict[str, float] = {}
        share, size = self.whiten @ self.weights / np.sqrt(self.own_marks), len(self.letters) + 1
        pairs, lasts, values = [], [], []
        for mark, weight in zip(self.marks, share, strict=True):
            x, (i, j, k, decay) = self.indexed([mark])[0], triples(len(mark))
            pairs.append(x[i] * size + x[j])
            lasts.append(x[k])
            values.append(weight * decay)
        used, row = np.unique(np.concatenate(pairs), return_inverse=True)
        self.rows, self.table = np.zeros(size * size, np.int32), np.zeros((len(used) + 1, size))
        self.rows[used] = np.arange(1, len(used) + 1)
        np.add.at(self.table, (row + 1, np.concatenate(lasts)), np.concatenate(values))

    def indexed(self, words: list[str]) -> np.ndarray:
        """Words of one length as rows of letter numbers (0: in no landmark)."""
        x = coded(words, len(words[0]))
        at = np.minimum(np.searchsorted(self.letters, x), len(self.letters) - 1)
        return np.where(self.letters[at] == x, at + 1, 0)

    def features(self, words: list[str], block: int = 512) -> np.ndarray:
        out = np.zeros((len(words), len(self.marks)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))  # equal lengths together
        for k in range(0, len(order), block):
            part = order[k:k + block]
            texts = [words[i] for i in part]
            scale = np.sqrt(np.maximum(own(texts), 1e-12))[:, None] * np.sqrt(self.own_marks)
            out[part] = (kernel(texts, self.marks) / scale) @ self.whiten
        return out

    def values(self, words: list[str], most: int = 1 << 18) -> np.ndarray:
        """Decision values, by the folded weights."""
        out, lengths, size = np.zeros(len(words)), np.array(list(map(len, words))), len(self.letters) + 1
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            i, j, k, decay = triples(int(length))
            block = max(1, most // len(decay))
            for part in np.split(at, range(block, len(at), block)):
                texts = [words[w] for w in part]
                x = self.indexed(texts)
                found = self.table[self.rows[x[:, i] * size + x[:, j]], x[:, k]] @ decay
                out[part] = found / np.sqrt(np.maximum(own(texts), 1e-12)) + self.bias
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> None:
        """Squared-hinge linear machine by Newton steps on the support vectors."""
        x1 = np.hstack([x, np.ones((len(x), 1))])
        sign, w = 2.0 * y - 1, np.zeros(x1.shape[1])
        ridge = np.eye(len(w))
        ridge[-1, -1] = 1e-6
        for _ in range(30):
            active = sign * (x1 @ w) < 1
            a = x1[active] * weight[active, None]
            new = np.linalg.solve(ridge + c * a.T @ x1[active], c * a.T @ sign[active])
            done, w = np.allclose(new, w, atol=1e-7), new
            if done:
                break
        self.weights, self.bias = w[:-1], float(w[-1])
        self.fold()

    def margins(self, words: list[str]) -> np.ndarray:
        """Decision value per word; values of seen words are kept (bounded)."""
        got = list(map(self.cache.get, words))
        new = [k for k, g in enumerate(got) if g is None]
        if new:
            for k, v in zip(new, self.values([words[k] for k in new]).tolist(), strict=True):
                got[k] = v
                if len(self.cache) < KEPT and len(words[k]) <= SPAN:
                    self.cache[words[k]] = v
        return np.array(got, float)

    def chunk_margins(self, chunks: list[str]) -> np.ndarray:
        """Largest decision value among each chunk's words (-inf without any);
        those of seen short chunks are kept (bounded)."""
        got = list(map(self.chunk_cache.get, chunks))
        new = [k for k, g in enumerate(got) if g is None]
        if new:
            parts = [units(chunks[k]) for k in new]
            flat = list(dict.fromkeys(u for p in parts for u in p))
            by_unit = dict(zip(flat, self.margins(flat).tolist(), strict=True))
            for k, p in zip(new, parts, strict=True):
                got[k] = max((by_unit[u] for u in p), default=-np.inf)
                if len(self.chunk_cache) < KEPT and len(chunks[k]) <= LONGEST_KEPT:
                    self.chunk_cache[chunks[k]] = got[k]
        return np.array(got, float)

    def calibrate(self, tops: np.ndarray, y: np.ndarray) -> None:
        """Logistic function from documents' top margins to probabilities."""
        x = np.hstack([tops, np.ones((len(tops), 1))])
        w = np.zeros(x.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + 1e-2 * np.eye(len(w)), x.T @ (p - y) + 1e-2 * w)
            step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.curve = w

    def probability(self, tops: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(tops @ self.curve[:-1] + self.curve[-1], -30, 30)))


def top_margins(margins) -> np.ndarray:
    """The largest margins, in order; absent ones and those below -2 count as -2."""
    out = np.full(TOP, -2.0)
    best = np.sort(np.asarray(margins, float))[::-1][:TOP]
    out[:len(best)] = np.maximum(best, -2.0)
    return out


def units(chunk: str) -> list[str]:
    """What a run of non-space characters contributes: the lower-cased word
    without punctuation around it; a long one in overlapping windows."""
    word = chunk.lower().strip(EDGES)
    if not word.isalpha():  # letters set apart by marks, joined
        joined = "".join(c for c in word if c.isalpha())
        return windows(word) + (windows(joined) if joined != word else [])
    return windows(word)


def windows(word: str) -> list[str]:
    """A word of up to ``SPAN`` letters as it is (one and two letters between
    edge marks); a longer one in overlapping windows of ``SPAN``, and in those
    of ``SHORT`` letters at every place, for insults in unspaced text."""
    if len(word) > SPAN:
        return [word[k:k + SPAN] for k in range(0, len(word) - SPAN // 2, SPAN // 2)] + [word[k:k + SHORT] for k in range(len(word) - SHORT + 1)]
    return [word] if len(word) >= 3 else [FIRST + word + LAST] if word else []


def spelled(words: list[str]) -> list[str]:
    """Words spelled out with spaces: runs of three or more single letters, joined."""
    out, run = [], ""
    for w in [*words, ""]:
        w = w.strip(EDGES)
        if len(w) == 1 and w.isalpha():
            run += w.lower()
            continue
        if len(run) >= 3:
            out += units(run)
        run = ""
    return out


def text_units(text: str) -> list[str]:
    words = text.split()
    return [u for w in words for u in units(w)] + spelled(words)


def landmarks(candidates: list[str], most: int, apart: float = 0.8, block: int = 256) -> list[str]:
    """The first ``most`` candidates that aren't alike (kernel under ``apart``)."""
    marks: list[str] = []
    for at in range(0, len(candidates), block):
        part = candidates[at:at + block]
        near = (kernel(part, marks) / np.sqrt(np.outer(own(part), own(marks)))).max(1) if marks else np.zeros(len(part))
        some = [w for w, x in zip(part, near, strict=True) if x < apart]
        alike = kernel(some, some) / np.sqrt(np.outer(own(some), own(some))) if some else None
        taken: list[int] = []
        for k in range(len(some)):
            if len(marks) + len(taken) < most and (alike[k, taken] < apart).all():
                taken.append(k)
        marks += [some[k] for k in taken]
        if len(marks) >= most:
            break
    return marks


def train(texts: list[str], labels: list[int], suspicious: int = 120, ordinary: int = 40, rounds: int = 2, frequent: int = 2000) -> Machine | None:
    """A machine from labelled texts; None unless both labels occur.  Landmarks:
    the ``suspicious`` words that tell most of toxic texts, and ``ordinary``
    ones spread over the ``frequent`` commonest of the others."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return None
    docs = [[text_units(s) for s in SENTENCE_END.split(t)] for t in texts]
    found: dict[str, list[int]] = {}
    for sentences, label in zip(docs, labels, strict=True):
        for w in {w for s in sentences for w in s}:
            found.setdefault(w, [0, 0])[label] += 1
    p, n = int(y.sum()), int(len(y) - y.sum())
    odds = {w: np.log((b + 0.1) / (p + 0.1)) - np.log((a + 0.1) / (n + 0.1)) for w, (a, b) in found.items()}
    telling = sorted((w for w, (a, b) in found.items() if b and odds[w] > 1), key=lambda w: (-found[w][1] * odds[w], w))
    marks = landmarks(telling, suspicious)
    taken = set(marks)
    plain = sorted((w for w, (a, b) in found.items() if a and odds[w] < 0.3 and w not in taken), key=lambda w: (-found[w][0], w))
    marks += plain[:: max(1, min(len(plain), frequent) // ordinary)][:ordinary]
    if not marks:
        return None
    machine = Machine(marks)
    # A word's first suspicion is its weight of evidence; then the machine's margin.
    suspicion = {w: found[w][1] * odds[w] if odds[w] > 0 else odds[w] for w in found}
    names, seen = list(found), {}
    for _ in range(rounds + 1):
        witness, label = [], []
        for sentences, t in zip(docs, labels, strict=True):
            best = [max(s, key=lambda w: (suspicion[w], w)) for s in sentences if s]
            if t and best:
                best = [max(best, key=lambda w: (suspicion[w], w))]
            witness += best
            label += [t] * len(best)
        distinct: dict[tuple[str, int], float] = {}
        for w, t in zip(witness, label, strict=True):
            distinct[w, t] = distinct.get((w, t), 0) + 1
        for (w, t), times in list(distinct.items()):  # insults with a letter put in are insults, too
            if t:
                for at in range(1, len(w)):
                    distinct.setdefault((w[:at] + "xj1"[at % 3] + w[at:], 1), times / len(w))
        ys = np.array([t for _, t in distinct], float)
        counts = np.sqrt(np.array(list(distinct.values()), float))
        weight = np.where(ys == 1, counts / counts[ys == 1].sum(), 3 * counts / max(1e-9, counts[ys == 0].sum())) * 1000
        new = list(dict.fromkeys(w for w, _ in distinct if w not in seen))
        seen |= dict(zip(new, machine.features(new).astype(np.float32), strict=True))
        machine.fit(np.array([seen[w] for w, _ in distinct], float), ys, weight)
        suspicion = dict(zip(names, machine.values(names).tolist(), strict=True))
    machine.calibrate(_tops(machine, pa.array(texts, pa.large_string()))[0], y.astype(float))
    machine.fold()  # without the words kept on the way
    return machine


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = 1000, most_chars: int = 20_000, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A bounded sample of labelled texts: of each label the ``per_label``
    documents (of at most ``most_chars`` characters) with the least hash.  Only
    labels whose crc32(id as text) mod 4 is not 2 are read; of rows that share
    an id the larger label counts, a repeated row counts once.  The choice is
    made from ids, hashes and lengths; texts of the chosen alone are moved."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "toxic is not null and crc32(cast(doc_id as string)) % 4 != 2").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = common.id_and_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    names = rows.filter(F.length("text").between(1, most_chars)).select("doc_id", "h").join(known, "doc_id").distinct()
    parts = [names.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "h").limit(per_label) for k in (0, 1)]
    chosen = common.stored(parts[0].union(parts[1]), "training-sample")  # 2 x per_label rows at most
    texts = rows.join(F.broadcast(chosen), ["doc_id", "h"]).groupBy("doc_id", "h").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))
    return texts.orderBy("doc_id", "h").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, **options) -> Machine | None:
    """Trained on the driver on the bounded sample of ``training_sample``."""
    rows = training_sample(docs, labels, **options).collect()
    return train([r.text for r in rows], [r.toxic for r in rows])


def _tops(machine: Machine, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Top margins of each text, and whether it has any words."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    chunks = lists.flatten().dictionary_encode()
    names, index = chunks.dictionary.to_pylist(), chunks.indices.to_numpy()
    of_chunk = machine.chunk_margins(names)
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    single = np.array([(len(c) == 1 or not c[:1].isalnum() or not c[-1:].isalnum()) and len(s := c.strip(EDGES)) == 1 and s.isalpha() for c in names],
                      bool)[index] if names else np.zeros(0, bool)
    scores = of_chunk[index] if len(index) else np.zeros(0)
    tops, words = np.full((len(texts), TOP), -2.0), np.zeros(len(texts), bool)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        own_scores = scores[a:b]
        if single[a:b].sum() >= 3:
            own_scores = np.append(own_scores, machine.margins(spelled([names[k] for k in index[a:b]])))
        if len(own_scores) > TOP:
            own_scores = np.partition(own_scores, -TOP)[-TOP:]
        tops[i], words[i] = top_margins(own_scores), (own_scores > -np.inf).any()
    return tops, words


def score(docs: DataFrame, machine: Machine | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), which replaces a column of that name.

    Texts without words score 0, and so do all without a machine; rows are
    scored one by one, each whole, however long.  An empty table stays empty."""
    docs = docs.select(*[c for c in docs.columns if c != "toxicity"])
    if machine is None:
        return docs.withColumn("toxicity", F.lit(0.0))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(machine)  # landmarks and folded weights: a few megabytes
    schema = docs.withColumn("toxicity", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, text_col, 2 << 20, 20000):
            tops, words = _tops(shared.value, batch.column(text_col))
            p = np.where(words, shared.value.probability(tops), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, "toxicity"])

    return docs.mapInArrow(run, schema)


def toxic_documents(docs: DataFrame, labels: DataFrame, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: ``held_out`` (its label may not be learnt), ``score``,
    ``predicted``.  A null id is not held out; an empty table gives no rows."""
    rows = common.id_and_text(docs, id_col, text_col)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scored = score(rows, fit(docs, labels, id_col=id_col, text_col=text_col, **options))
    return scored.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= cut).cast("int").alias("predicted"))
