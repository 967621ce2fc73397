"""Porter (1980) stemmer as column expressions.

No Python per row: the algorithm is a chain of projections, each a SQL
``CASE`` over suffix rules.  The measure m of a stem is read off a
consonant/vowel mask of the word (``C``/``V`` per character): vowels are
a e i o u, and y when it follows a consonant.  Because whether a letter is a
consonant depends only on the letters before it, the mask of a stem is the
same-length prefix of the word's mask.

The same rule table renders in two dialects: Spark SQL (used by the jobs)
and DuckDB (used by the oracle queries), so the two engines run the same
rules, not a shared implementation.

Variant: Porter's published rules plus the two changes that are usual in
the widely used implementations (bli -> ble instead of abli -> able, and
logi -> log); words of one or two characters are left as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the suffix rules of the algorithm, in rule order -----
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
         ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
         ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
         ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
         ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]
# -------------------------------------------------------------------------

M_GT0 = "^C*V+C"
M_GT1 = "^C*V+C+V+C"
M_EQ1 = "^C*V+C+V*$"   # masks hold only C and V, so "$" is safe on them


class _Dialect:
    def __init__(self, name: str):
        self.name = name
        # end of text: Java's "$" also matches before a final newline
        self.end = "\\\\z" if name == "spark" else "\\z"

    def ends(self, x: str, s: str) -> str:
        return f"endswith({x}, '{s}')" if self.name == "spark" else f"suffix({x}, '{s}')"

    def rl(self, x: str, pat: str) -> str:
        return f"({x} RLIKE '{pat}')" if self.name == "spark" else f"regexp_matches({x}, '{pat}')"

    def longest_suffix(self, x: str, sufs) -> str:
        """The longest listed suffix of x, or ''.  A regex finds the leftmost
        match, i.e. the longest suffix, which is the first in rule order
        because no rule suffix is listed after a shorter suffix of itself."""
        pat = "(" + "|".join(sufs) + ")" + self.end
        find = f"regexp_extract({x}, '{pat}', 1)"
        if self.name != "spark":
            return find
        tails = ", ".join(repr(t) for t in sorted({s[-2:] for s in sufs}))  # most words have none: no regex for them
        return f"CASE WHEN right({x}, 2) IN ({tails}) THEN {find} ELSE '' END"

    @staticmethod
    def cut(x: str, n) -> str:
        return x if n == 0 else f"left({x}, length({x}) - {n})"

    def mask(self, x: str) -> str:
        if self.name == "spark":
            by_rule = ("regexp_replace(regexp_replace(regexp_replace("
                       f"{x}, '[aeiou]', 'V'), '([^V])y', '$1V'), '[^V]', 'C')")
            # letters but y have one class each, wherever they stand
            return f"CASE WHEN {x} RLIKE '[^a-xz]' THEN {by_rule} ELSE translate({x}, '{LETTERS}', '{LETTER_MASK}') END"
        return ("regexp_replace(regexp_replace(regexp_replace("
                f"{x}, '[aeiou]', 'V', 'g'), '([^V])y', '\\1V', 'g'), '[^V]', 'C', 'g')")

    # Conditions on a stem s with mask ms.  Words may hold any character on
    # the query side, so tests on the word use right(), not an end anchor.
    @staticmethod
    def last_in(s: str, chars: str) -> str:
        return f"right({s}, 1) IN ({', '.join(repr(c) for c in chars)})"

    def cvc(self, s: str, ms: str) -> str:
        return f"(right({ms}, 3) = 'CVC' AND NOT {self.last_in(s, 'wxy')})"

    @staticmethod
    def doublec(s: str, ms: str) -> str:
        return f"(length({s}) >= 2 AND right({s}, 1) = left(right({s}, 2), 1) AND right({ms}, 1) = 'C')"


LETTERS = "abcdefghijklmnopqrstuvwxyz"
LETTER_MASK = "VCCCVCCCVCCCCCVCCCCCVCCCCC"  # a e i o u -> V; y never occurs in rule text


def _stages(d: _Dialect) -> list[list[tuple[str, str]]]:
    """Projections over (w, m[, x, suf]), each a list of (column, expr).

    The mask m is computed with regexes once; afterwards every stage keeps
    it in step with plain string operations: a stage either truncates w
    (the new mask is a prefix of the old one) or replaces a suffix by rule
    text, whose letters never include y, so their mask is a fixed
    per-letter translation."""
    cut, ends, rl = d.cut, d.ends, d.rl
    w, m = "w", "m"

    def trunc(expr: str, extra=()):
        """Stage that only shortens w: [(w', m, extras)], then m' = prefix."""
        return [[("w", expr), ("m", m), *extra], [("w", w), ("m", f"left({m}, length({w}))"), *[(c, c) for c, _ in extra]]]

    step1a = ("CASE " + f"WHEN {ends(w, 'sses')} THEN {cut(w, 2)} "
              f"WHEN {ends(w, 'ies')} THEN {cut(w, 2)} "
              f"WHEN {ends(w, 'ss')} THEN {w} "
              f"WHEN {ends(w, 's')} THEN {cut(w, 1)} ELSE {w} END")
    ed = f"({ends(w, 'ed')} AND NOT {ends(w, 'eed')} AND {rl(cut(m, 2), 'V')})"
    ing = f"({ends(w, 'ing')} AND {rl(cut(m, 3), 'V')})"
    step1b_strip = ("CASE " + f"WHEN {ends(w, 'eed')} THEN CASE WHEN {rl(cut(m, 3), M_GT0)} "
                    f"THEN {cut(w, 1)} ELSE {w} END "
                    f"WHEN {ed} THEN {cut(w, 2)} WHEN {ing} THEN {cut(w, 3)} ELSE {w} END")
    step1b_fix = ("CASE " + "WHEN NOT x THEN w "
                  f"WHEN {ends(w, 'at')} OR {ends(w, 'bl')} OR {ends(w, 'iz')} THEN {w} || 'e' "
                  f"WHEN {d.doublec(w, m)} THEN CASE WHEN {d.last_in(w, 'lsz')} THEN {w} ELSE {cut(w, 1)} END "
                  f"WHEN {rl(m, M_EQ1)} AND {d.cvc(w, m)} THEN {w} || 'e' ELSE {w} END")
    fix_mask = [("w", "w2"), ("m", f"CASE WHEN length(w2) > length(w) THEN {m} || 'V' ELSE left({m}, length(w2)) END")]
    step1c = f"CASE WHEN {ends(w, 'y')} AND {rl(cut(m, 1), 'V')} THEN {cut(w, 1)} || 'i' ELSE {w} END"
    c_mask = [("w", "w2"), ("m", f"CASE WHEN w2 = w THEN {m} ELSE {cut(m, 1)} || 'V' END")]

    def replace_stage(rules, cond):
        find = [("w", w), ("m", m), ("suf", d.longest_suffix(w, [s for s, _ in rules]))]
        repl = "CASE suf " + " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in rules) + " END"
        n = "length(suf)"
        apply = [("w", w), ("m", m), ("suf", "suf"),
                 ("w2", f"CASE WHEN suf <> '' AND {rl(cut(m, n), cond)} THEN {cut(w, n)} || {repl} ELSE {w} END")]
        new_tail = f"translate(substring(w2, length(w) - {n} + 1), '{LETTERS}', '{LETTER_MASK}')"
        mask = [("w", "w2"), ("m", f"CASE WHEN w2 = w THEN {m} ELSE {cut(m, n)} || {new_tail} END")]
        return [find, apply, mask]

    n = "length(suf)"
    step4_find = [("w", w), ("m", m), ("suf", d.longest_suffix(w, STEP4))]
    step4 = (f"CASE WHEN suf = '' THEN {w} WHEN suf = 'ion' AND NOT {d.last_in(cut(w, n), 'st')} THEN {w} "
             f"WHEN {rl(cut(m, n), M_GT1)} THEN {cut(w, n)} ELSE {w} END")
    s5, ms5 = cut(w, 1), cut(m, 1)
    step5a = (f"CASE WHEN {ends(w, 'e')} AND ({rl(ms5, M_GT1)} OR ({rl(ms5, M_EQ1)} AND NOT {d.cvc(s5, ms5)})) "
              f"THEN {s5} ELSE {w} END")
    step5b = f"CASE WHEN {ends(w, 'll')} AND {rl(m, M_GT1)} THEN {cut(w, 1)} ELSE {w} END"
    return [
        [("w", w), ("m", d.mask(w))],
        *trunc(step1a),
        [("w", step1b_strip), ("m", m), ("x", f"({ed} OR {ing})")],
        [("w", w), ("m", f"left({m}, length({w}))"), ("x", "x")],
        [("w", w), ("m", m), ("w2", step1b_fix)], fix_mask,
        [("w", w), ("m", m), ("w2", step1c)], c_mask,
        *replace_stage(STEP2, M_GT0),
        *replace_stage(STEP3, M_GT0),
        step4_find, [("w", step4), ("m", m)], [("w", w), ("m", f"left({m}, length({w}))")],
        *trunc(step5a),
        [("w", step5b)],
    ]


# The JVM interprets methods of more than 8000 bytes, and Spark makes one of all
# projections in a row.  A lambda, here one that gives back the word, is not
# compiled with its neighbours, so one between every so many stages keeps them short.
COMPILED = 7


def stem_column(df: DataFrame, word_col: str, out_col: str = "stem") -> DataFrame:
    """Add ``out_col`` = Porter stem of lowercase ``word_col``.  Apply it to a
    distinct vocabulary and join back; every step is a JVM expression."""
    keep = [F.col(c) for c in df.columns]
    cur = df.select(*keep, F.col(word_col).alias("w"))
    for i, stage in enumerate(_stages(_Dialect("spark"))):
        if i and i % COMPILED == 0:
            cur = cur.withColumn("w", F.expr("aggregate(array(), w, (a, x) -> a)"))
        cur = cur.select(*keep, *[F.expr(e).alias(c) for c, e in stage])
    return cur.select(*keep, F.when(F.length(word_col) <= 2, F.col(word_col)).otherwise(F.col("w")).alias(out_col))


def stem_sql(source_sql: str, word_col: str = "word") -> str:
    """DuckDB: ``SELECT word, stem`` over a source query with column ``word_col``."""
    q = f"SELECT {word_col} AS word, {word_col} AS w FROM ({source_sql})"
    for stage in _stages(_Dialect("duckdb")):
        cols = ", ".join(f"{e} AS {c}" for c, e in stage)
        q = f"SELECT word, {cols} FROM ({q})"
    return f"SELECT word, CASE WHEN length(word) <= 2 THEN word ELSE w END AS stem FROM ({q})"
