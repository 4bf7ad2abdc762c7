"""Property test: the blocked plan equals a per-key Python scan for random data and block sizes."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.plans import sequence as S

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(-300, 300), st.integers(0, 3)),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, block=st.sampled_from([1, 2, 5, 64]), descending=st.booleans())
def test_blocked_plan_matches_scan(spark, rows, block, descending):
    df = spark.createDataFrame(rows, "k string, o long, v int")
    out = S.segment_ids(
        S.with_previous(S.prefix_sums(df, ["k"], "o", {"rn": "1L", "cs": "v"}, descending=descending, block_size=block),
                        ["k"], "o", ["v"], descending=descending, block_size=block),
        ["k"], "o", "v", "seg", descending=descending, block_size=block)
    got = {(r.k, r.o): (r.rn, r.cs, r.prev_v, r.seg) for r in out.collect()}
    assert len(got) == len(rows)
    by_key = {}
    for k, o, v in sorted(rows, key=lambda r: -r[1] if descending else r[1]):
        by_key.setdefault(k, []).append((o, v))
    for k, seq in by_key.items():
        cs, prev, seg = 0, None, 0
        for i, (o, v) in enumerate(seq, start=1):
            cs += v
            if prev is None or prev != v:
                seg += 1
            assert got[(k, o)] == (i, cs, prev, seg)
            prev = v
