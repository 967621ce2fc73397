"""Secret scans in DataFrame expressions: patterns, then a randomness battery.

Base spans come from three patterns.  Other long runs of code characters are
tested for randomness under the encoding they could be (hexadecimal, base32,
base64): chi-squared uniformity over the alphabet's characters and over its
quarters (sixteenths of long strings), a runs test and lag-one serial
correlation, combined by the Cauchy rule into one p-value (small: not
random).  Ordinary words and identifiers pile up near 0; random strings are
spread evenly.  So, per encoding and length class, over all documents, the
share of ordinary strings among those with p >= cut is estimated from the
upper half of the p-values, and the least cut that holds this false-discovery
rate is taken: short strings, on which the tests see little, get a stricter
cut than long ones, or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.llm import common

# The base patterns and the least lengths of what they find.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ["assign", "access", "hex", "random"]

RUN = r"[A-Za-z0-9+/_-]{20,}"  # candidates of the battery
# Values of the encodings' characters, in order (fixed values).
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
BINS = 40


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans_of(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, stop, found) of all matches, in code points; ``found`` is
    the given group.  The text between matches (split) gives the starts."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    sizes = let(F.struct(F.split(text, pattern, -1).alias("p"), hits.alias("h"), found.alias("f")), lambda m: F.transform(
        F.arrays_zip(F.slice(m["p"], F.lit(1), F.size(m["h"])).alias("p"), m["h"].alias("h"), m["f"].alias("f")),
        lambda x: F.struct(F.length(x["p"]).cast("long").alias("gap"), F.length(x["h"]).cast("long").alias("n"), x["f"].alias("found"))))
    empty = F.expr("cast(array() as array<struct<start:bigint,stop:bigint,found:string>>)")
    return F.when(text.rlike(pattern), let(sizes, lambda x: _running(x, empty))).otherwise(empty)


def _running(sizes: Column, empty: Column, block: int = 512) -> Column:
    """Positions from gaps and lengths; by blocks, so that the work stays near
    linear in the number of matches."""
    def within(a: Column, before: Column) -> Column:
        start = F.struct(before.alias("at"), empty.alias("out"))
        return F.aggregate(a, start, lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["n"]).alias("at"),
            F.concat(s["out"], F.array(F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["n"]).alias("stop"),
                                                x["found"].alias("found")))).alias("out")), lambda s: s["out"])

    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x["gap"] + x["n"])
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int")),
                         lambda k: F.slice(sizes, k * block + 1, F.lit(block)))
    befores = lambda bl: F.aggregate(F.transform(bl, total), F.expr("cast(array(0) as array<bigint>)"),
                                     lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n)))
    return let(blocks, lambda bl: F.flatten(F.zip_with(bl, F.slice(befores(bl), F.lit(1), F.size(bl)), within)))


def base_spans(text: Column) -> Column:
    """Base spans by start, then kind."""
    def kind(name: str, pattern: str, group: int = 0) -> Column:
        long = F.filter(spans_of(text, pattern, group), lambda x: F.length(x["found"]) >= LEAST[name])
        return F.transform(long, lambda x: F.struct(x["start"], F.lit(KINDS.index(name)).alias("kind"), x["stop"]))

    # Runs are found greedily, so asking for the least length at once finds the
    # same access keys and hex runs; an assignment's failing match must first
    # use up its text.
    return F.array_sort(F.concat(kind("assign", ASSIGN, 2), kind("access", ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4)),
                                 kind("hex", HEX[:-1] + "{%d,}" % LEAST["hex"])))


def _upper_tail(z: Column) -> Column:
    """P(normal > z), to about 1e-4."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def battery(s: Column) -> Column:
    """(encoding, length class, p) of one candidate string."""
    encoding = (F.when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit("hex")).when(s.rlike("^[A-Z2-7]+$"), F.lit("base32")).otherwise(F.lit("base64")))
    named = let(F.struct(encoding.alias("encoding"), s.alias("s")), lambda m: F.struct(
        m["encoding"].alias("encoding"), F.length(m["s"]).cast("double").alias("n"),
        F.when(m["encoding"] == "hex", F.lower(m["s"])).otherwise(F.translate(m["s"], "-_", "+/")).alias("plain")))

    def coded(m: Column, cells: int) -> Column:
        out = F.lit(None).cast("string")
        for name, letters in ALPHABETS.items():
            codes = "".join(f"{k * cells // len(letters):x}" for k in range(len(letters)))
            out = F.when(m["encoding"] == name, F.translate(m["plain"], letters, codes)).otherwise(out)
        return out

    def tests(m: Column) -> Column:
        n, plain, fine = m["n"], m["plain"], m["fine"]
        counted = lambda d, k: (F.length(d) - F.length(F.replace(d, F.lit(k), F.lit("")))).cast("double")

        def chi(squares: Column, cells) -> Column:
            x2, df = squares * cells / n - n, cells - 1.0
            return _upper_tail((F.cbrt(x2 / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))

        def squared(d: Column, letters: Column) -> Column:
            return F.aggregate(letters, F.lit(0.0), lambda a, k: a + counted(d, k) * counted(d, k))

        sixteen = F.array(*[F.lit(f"{k:x}") for k in range(16)])
        distinct = F.array_distinct(F.filter(F.split(plain, ""), lambda c: c != ""))
        letters = F.when(m["encoding"] == "hex", 16.0).when(m["encoding"] == "base32", 32.0).otherwise(64.0)
        ones = counted(m["bits"], F.lit("1"))
        runs = 1 + (counted(m["bits"], F.lit("01")) + counted(m["bits"], F.lit("10"))) / 2

        def p_runs(zeros: Column, ones: Column) -> Column:
            mean = 2 * ones * zeros / n + 1
            return F.when((ones < 2) | (zeros < 2), F.pow(F.lit(2.0), 1 - n)).otherwise(
                2 * _upper_tail(F.abs(runs - mean) / F.sqrt((mean - 1) * (mean - 2) / (n - 1))))

        def p_serial(values: Column) -> Column:
            total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
            variance = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x) - total * total / n
            lagged = F.aggregate(F.zip_with(F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values) - 1),
                                            lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
            return F.when(variance > 0, 2 * _upper_tail(F.abs((lagged - total * total / n) / variance * F.sqrt(n)))).otherwise(F.lit(1e-9))

        values = F.transform(F.filter(F.split(m["quarters"], ""), lambda c: c != ""), lambda c: c.cast("double"))
        return F.array(chi(squared(plain, distinct), letters), chi(squared(m["cells"], sixteen), F.when(fine, 16.0).otherwise(4.0)),
                       let(ones, lambda x: p_runs(n - x, x)), let(values, p_serial))

    shown = let(named, lambda m: F.struct(
        m["encoding"].alias("encoding"), m["n"].alias("n"), m["plain"].alias("plain"), coded(m, 2).alias("bits"), coded(m, 4).alias("quarters"),
        F.when(m["n"] >= 64, coded(m, 16)).otherwise(coded(m, 4)).alias("cells"), (m["n"] >= 64).alias("fine")))
    # One p near 1 can't outweigh one near 0.
    score = lambda ps: F.aggregate(ps, F.lit(0.0), lambda a, p: a + F.tan((0.5 - F.greatest(F.lit(1e-9), F.least(F.lit(0.985), p))) * F.pi())) / 4
    return let(shown, lambda m: F.struct(m["encoding"].alias("encoding"), F.floor(F.log2(m["n"]) * 2).cast("int").alias("size"),
                                         (0.5 - F.atan(score(tests(m))) / F.pi()).alias("p")))


def with_findings(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_base`` (base spans) and ``_runs`` (other candidates with
    their battery), which overlap no base span."""
    text = F.coalesce(text, F.lit(""))
    found = docs.withColumn("_base", base_spans(text)).withColumn("_cand", spans_of(text, RUN))
    free = F.filter("_cand", lambda c: ~F.exists("_base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    runs = F.transform(free, lambda c: F.struct(c["start"], c["stop"], battery(c["found"]).alias("test")))
    return found.withColumn("_runs", runs).drop("_cand")


def cuts(found: DataFrame, rate: float = 0.1) -> dict[tuple[str, int], float]:
    """Least p-value counted as random, per encoding and length class.

    From counts of all candidates in ``BINS`` bins (at most a few thousand
    numbers, whatever the input).  With r = 2 #(p >= 1/2) random strings in a
    class, r (1 - a) of the #(p >= a) are random; the false share is the rest."""
    counts = (found.select(F.explode("_runs.test").alias("t")).select("t.encoding", "t.size", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
              .groupBy("encoding", "size", "bin").count().collect())
    by: dict[tuple[str, int], list[int]] = {}
    for r in counts:
        by.setdefault((r["encoding"], r["size"]), [0] * BINS)[r["bin"]] = r["count"]
    out = {}
    for key, bins in by.items():
        upper = sum(bins[BINS // 2:])
        for k in range(BINS):
            above = sum(bins[k:])
            # one more ordinary string than counted, so that few strings prove nothing
            if above and 1 - min(1.0, 2 * upper * (1 - k / BINS) / (above + 1)) <= rate:
                out[key] = k / BINS
                break
    return out


def all_spans(found: DataFrame, rate: float = 0.1) -> DataFrame:
    """``found`` (a written table) with ``_spans``: base spans and random strings."""
    limits = cuts(found, rate)
    if not limits:
        return found.withColumn("_spans", F.col("_base"))
    table = F.create_map(*[F.lit(x) for (e, s), cut in limits.items() for x in (f"{e}:{s}", cut)])
    random = F.filter("_runs", lambda r: r["test"]["p"] >= F.coalesce(
        F.try_element_at(table, F.concat_ws(":", r["test"]["encoding"], r["test"]["size"])), F.lit(2.0)))
    random = F.transform(random, lambda r: F.struct(r["start"], F.lit(KINDS.index("random")).alias("kind"), r["stop"]))
    return found.withColumn("_spans", F.array_sort(F.concat("_base", random)))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["stop"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.1) -> DataFrame:
    """Per document: counts of base spans, SHA-256 of their list, all spans.

    Null text is empty and has no spans; repeated rows are scanned each; the
    found spans (not the texts) are written once and read for the counts of the
    battery and for the result."""
    found = common.stored(with_findings(common.id_and_text(docs, id_col, text_col), F.col("text")).drop("text"), "secret-spans")
    n = lambda k: F.size(F.filter("_base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return all_spans(found, rate).select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
                                         listed(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]", rate: float = 0.1) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``mark``; overlapping
    spans are replaced together.  All rows and columns stay, whatever the names
    of the others; a null text stays null; an empty table stays empty."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col]
    found = all_spans(common.stored(with_findings(rows, text), "secret-spans"), rate)
    empty = F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")
    joined = F.aggregate("_spans", empty, lambda s, x: F.when(
        (F.size(s) > 0) & (F.element_at(s, -1)["stop"] > x["start"]),
        F.concat(F.slice(s, F.lit(1), F.size(s) - 1), F.array(F.struct(F.element_at(s, -1)["start"].alias("start"),
                                                                        F.greatest(F.element_at(s, -1)["stop"], x["stop"]).alias("stop")))))
        .otherwise(F.concat(s, F.array(F.struct(x["start"].alias("start"), x["stop"].alias("stop"))))))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("_joined", lambda x: x["stop"]))
    stops = F.concat(F.transform("_joined", lambda x: x["start"]), F.array(F.length(text).cast("long")))
    kept = F.zip_with(starts, stops, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")))
    clean = F.when(F.size("_joined") > 0, F.array_join(kept, mark)).otherwise(text)
    return found.withColumn("_joined", joined).select(F.col("row").withField(f"`{text_col}`", clean).alias("row")).select("row.*")
