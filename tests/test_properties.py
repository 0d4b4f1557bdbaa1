"""Randomised properties of the compaction and the enrichment (Hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from snapkeep.operators.enrich import Lookup, enrich
from snapkeep.operators.latest import latest_per_key

SCHEMA = "key string, offset bigint, partition int, v string"

row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["hot", "hot", "hot", "a", "b", "c.d", "É"])),
    st.one_of(st.none(), st.integers(min_value=0, max_value=6)),
    st.integers(min_value=0, max_value=2),
)
frames = st.lists(row, min_size=0, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame([(k, o, p, f"v{i}") for i, (k, o, p) in enumerate(rows)], SCHEMA)


def _expected(rows):
    best = {}
    for k, o, _ in rows:
        if k is not None and o is not None:
            best[k] = max(best.get(k, o), o)
    return sorted((k, o, p, f"v{i}") for i, (k, o, p) in enumerate(rows) if k in best and best[k] == o)


@SETTINGS
@given(rows=frames)
def test_latest_forms_agree_with_a_plain_reading(spark, rows):
    df = _df(spark, rows)
    want = _expected(rows)
    for method in ("rank", "join"):
        got = sorted(map(tuple, latest_per_key(df, "key", "offset", method=method).collect()))
        assert got == want
    one = latest_per_key(df, "key", "offset", keep_ties=False, tiebreak=["partition", "v"]).collect()
    assert sorted(r["key"] for r in one) == sorted({w[0] for w in want})
    # the pick among ties is the highest (partition, v)
    for r in one:
        ties = [w for w in want if w[0] == r["key"]]
        assert (r["partition"], r["v"]) == max((w[2], w[3]) for w in ties)


@SETTINGS
@given(rows=frames, right_keys=st.lists(st.one_of(st.none(), st.sampled_from(["hot", "a", "x"])), max_size=6))
def test_left_join_keeps_every_left_row(spark, rows, right_keys):
    left = _df(spark, rows)
    right = spark.createDataFrame([(k, f"r{i}") for i, k in enumerate(right_keys)], "id string, r string")
    out = enrich(left, [Lookup(right, key="id", on="key", columns=["r"])])
    matches = {k: right_keys.count(k) for k in right_keys if k is not None}
    assert out.count() == sum(max(1, matches.get(k, 0)) if k is not None else 1 for k, _, _ in rows)
