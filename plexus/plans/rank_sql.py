"""DuckDB oracle SQL for the rank family, generated per round count.

The SQL restates the rank rules directly (edges, sinks, back-links,
weights, one CTE per round); it is the independent check of the Spark job.
"""

from __future__ import annotations

from plexus.sources.bindings import with_views

D = 0.15
TIE_PLACES = 10  # ranks are O(1) to O(10^3); sums in another order differ far below this
BY_RANK = f"round(rank, {TIE_PLACES}) DESC, node"


def _prep(back_links: bool) -> str:
    g = ("SELECT src, dst FROM edges UNION ALL "
         "SELECT e.dst AS src, e.src AS dst FROM edges e JOIN sinks s ON e.dst = s.node"
         if back_links else "SELECT src, dst FROM edges")
    return f""",
sinks AS (SELECT DISTINCT dst AS node FROM edges WHERE dst NOT IN (SELECT src FROM edges)),
g AS ({g}),
deg AS (SELECT src, count(*) AS c FROM g GROUP BY src),
w AS (SELECT g.src, g.dst, CAST(1.0 AS DOUBLE) / deg.c AS w FROM g JOIN deg USING (src)),
r0 AS (SELECT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM deg)"""


def _rounds(n: int) -> str:
    out = []
    for i in range(1, n + 1):
        out.append(f""",
r{i} AS MATERIALIZED (SELECT w.dst AS node,
    CAST({D} AS DOUBLE) + CAST({1 - D} AS DOUBLE) * sum(r{i - 1}.rank * w.w) AS rank
  FROM w JOIN r{i - 1} ON w.src = r{i - 1}.node GROUP BY w.dst)""")
    return "".join(out)


def rank_cte(rounds: int, back_links: bool = True) -> str:
    """WITH ... r0 .. r{rounds}; the caller appends the SELECT."""
    return with_views("edges").rstrip() + _prep(back_links) + _rounds(rounds) + "\n"


def fixed_rounds_sql(rounds: int, back_links: bool = True) -> str:
    return rank_cte(rounds, back_links) + f"SELECT node, round(rank, 6) AS rank FROM r{rounds}"


def history_sql(rounds: int, back_links: bool = True) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {i} AS round, node, round(rank, 6) AS rank FROM r{i}" for i in range(1, rounds + 1))
    return rank_cte(rounds, back_links) + parts


def top_sql(rounds: int, k: int, back_links: bool = True) -> str:
    return rank_cte(rounds, back_links) + (
        f"SELECT node, round(rank, 6) AS rank FROM r{rounds} "
        f"ORDER BY {BY_RANK} LIMIT {k}")


def compare_sql(rounds: int, k: int) -> str:
    a = rank_cte(rounds, True)
    # second vector (no back-links) from its own chain over the same edges
    body = f"""{a.rstrip()},
gb AS (SELECT src, dst FROM edges),
degb AS (SELECT src, count(*) AS c FROM gb GROUP BY src),
wb AS (SELECT gb.src, gb.dst, CAST(1.0 AS DOUBLE) / degb.c AS w FROM gb JOIN degb USING (src)),
b0 AS (SELECT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM degb)"""
    for i in range(1, rounds + 1):
        body += f""",
b{i} AS MATERIALIZED (SELECT wb.dst AS node,
    CAST({D} AS DOUBLE) + CAST({1 - D} AS DOUBLE) * sum(b{i - 1}.rank * wb.w) AS rank
  FROM wb JOIN b{i - 1} ON wb.src = b{i - 1}.node GROUP BY wb.dst)"""
    body += f""",
ta AS (SELECT node FROM r{rounds} ORDER BY {BY_RANK} LIMIT {k}),
tb AS (SELECT node FROM b{rounds} ORDER BY {BY_RANK} LIMIT {k})
SELECT coalesce(ta.node, tb.node) AS node,
  CASE WHEN ta.node IS NOT NULL AND tb.node IS NOT NULL THEN 'both'
       WHEN ta.node IS NOT NULL THEN 'only_first' ELSE 'only_second' END AS membership
FROM ta FULL OUTER JOIN tb ON ta.node = tb.node"""
    return body


def converged_sql(max_iters: int, delta: float, back_links: bool = True) -> str:
    """Early stop: first round i whose max change over common nodes is <= delta
    returns r{i-1}; otherwise r{max_iters}."""
    body = rank_cte(max_iters, back_links).rstrip()
    diffs = " UNION ALL ".join(
        f"SELECT {i} AS i, max(abs(a.rank - b.rank)) AS m FROM r{i - 1} a JOIN r{i} b USING (node)"
        for i in range(1, max_iters + 1))
    vecs = " UNION ALL ".join(f"SELECT {i} AS i, node, rank FROM r{i}" for i in range(0, max_iters + 1))
    body += f""",
diffs AS ({diffs}),
stop AS (SELECT coalesce(min(i) - 1, {max_iters}) AS i FROM diffs WHERE m <= {delta!r}),
vecs AS ({vecs})
SELECT node, round(rank, 6) AS rank FROM vecs WHERE i = (SELECT i FROM stop)"""
    return body
