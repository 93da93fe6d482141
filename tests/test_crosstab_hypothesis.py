"""Two-step crosstab equals the direct rollup on random frames with nulls."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harness import crosstab_direct

from hemotab.operators import crosstab as X

SPEC = X.CrosstabSpec("H", "h", (X.Group("a"), X.Group("b")), (X.Group("c", descending=True),), "b")
label = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
rows = st.lists(st.tuples(label, label, label), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_two_step_equals_direct(spark, data):
    df = spark.createDataFrame(data, "a string, b string, c string")
    two = X.crosstab(X.finest(df, SPEC.keys, SPEC.measure), SPEC)
    one = crosstab_direct(df, SPEC)
    assert sorted(map(tuple, two.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)
    # every cell's count equals a brute-force count of non-null measures
    for r in two.collect():
        want = sum(1 for a, b, c in data
                   if b is not None
                   and (r.g_a == 1 or a == r.a) and (r.g_b == 1 or b == r.b) and (r.g_c == 1 or c == r.c))
        assert r.n == want
