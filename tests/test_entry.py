"""Driver contract: entry() runs, every query has a callable, and the
registered queries run on the smallest tables."""

import __spark_entry__ as E
import pytest

from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and df.columns == ["node", "rank"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["edge_stats", "wall_feed", "search_news", "stream_like_state"])
def test_some_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0
