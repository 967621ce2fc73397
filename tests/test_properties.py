"""Property tests: random inputs, checked against plain Python models.
Each example is one Spark job over a batch of generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plexus.functions.porter import stem_column
from plexus.operators import social as S
from tests.porter_ref import porter_ref

WORDS = st.lists(st.text(alphabet="abceilnorstuyzg", min_size=1, max_size=14), min_size=100, max_size=300)
SUFFIXED = st.lists(st.tuples(st.text(alphabet="bcdlmnrstvy", min_size=1, max_size=6),
                              st.sampled_from(["ational", "ization", "iveness", "ement", "ing", "ed", "ies",
                                               "sses", "ally", "ously", "biliti", "logi", "eed", "yy", "e", "ll"])),
                    min_size=100, max_size=300)
SLOW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(words=WORDS)
def test_stem_random_words(spark, words):
    df = spark.createDataFrame([(w,) for w in set(words)], "word string")
    got = {r.word: r.stem for r in stem_column(df, "word").collect()}
    assert {w: porter_ref(w) for w in got} == got


@SLOW
@given(parts=SUFFIXED)
def test_stem_random_suffixed_words(spark, parts):
    words = {a + b for a, b in parts}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.stem for r in stem_column(df, "word").collect()}
    assert {w: porter_ref(w) for w in got} == got


@SLOW
@given(ops=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.booleans()), min_size=1, max_size=120))
def test_last_writer_wins_random_logs(spark, ops):
    rows = [(i, "put" if put else "delete", p, u) for i, (p, u, put) in enumerate(ops)]
    log = spark.createDataFrame(rows, "seq long, op string, postID long, userID long")
    state = {}
    for _, op, p, u in rows:        # replay in sequence order
        if op == "put":
            state[(p, u)] = True
        else:
            state.pop((p, u), None)
    got = sorted(tuple(r) for r in S.apply_changes(log, ["postID", "userID"], "seq").collect())
    assert got == sorted(state)
    # merging the log in two halves, later half first, gives the same state
    half = len(rows) // 2
    a = S.last_operations(log.where(f"seq >= {half}"), ["postID", "userID"])
    b = S.last_operations(log.where(f"seq < {half}").unionByName(a), ["postID", "userID"])
    merged = sorted((r.postID, r.userID) for r in b.where("op <> 'delete'").collect())
    assert merged == sorted(state)
