"""Property tests: the entity collapse is independent of row order and
partitioning, and equals a brute-force computation, for random panels."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from tenurekit.operators.panel import build_longitudinal
from tenurekit.operators.rules import rules_frame

from test_rules_and_panel import _tier, brute_longitudinal

LEAGUES = ["LEC", "NA LCS", "Academy", "EU Masters", None]
SPLITS = ["Spring", "Summer", None, "Winter", "Playoffs"]

row = st.tuples(st.sampled_from(["p1", "p2", "p3", "p4"]), st.integers(2016, 2025),
                st.sampled_from(LEAGUES), st.sampled_from(SPLITS))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=25), parts=st.integers(1, 5))
def test_longitudinal_order_and_partition_free(spark, rows, parts):
    rows = [(p, y, l, s, i) for i, (p, y, l, s) in enumerate(rows)]
    rules = rules_frame(spark, [("LEC", "exact", 1, "EU"), ("lcs", "contains", 1, "NA"),
                                ("__DEFAULT__", "default", 2, "Unknown")])
    df = spark.createDataFrame(list(reversed(rows)), "player string, year int, league string, split string, _line long")
    got = {r.player: r.asDict() for r in build_longitudinal(df.repartition(parts), rules, 2025).collect()}
    exp = brute_longitudinal(rows, _tier, 2025)
    assert set(got) == set(exp)
    for p, e in exp.items():
        for k, v in e.items():
            assert got[p][k] == v, (p, k)
