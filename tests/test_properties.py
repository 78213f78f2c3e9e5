"""Property test: any history, any block size, same scores as the brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import brute_scores
from tripwire.operators import detectors as D
from util import scores, txns

row = st.tuples(
    st.sampled_from(["a", "b", "c"]),                      # user
    st.integers(min_value=0, max_value=200),               # time (out of order allowed)
    st.sampled_from([0.0, 0.1, 0.2, 0.3, 1.0, 1.1, 2.5, 3.0, 7.5, 10.0, 30.0, 100.0]),  # amounts with exact 3x ties
    st.sampled_from(["VN", "vn", "US", None]),             # location
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), rpb=st.sampled_from([1, 2, 3, 5, 1000]))
def test_score_all_any_history(spark, rows, rpb):
    data = [(i, u, t, a, loc) for i, (u, t, a, loc) in enumerate(rows)]
    exp = brute_scores([{"seq": s, "user_id": u, "txn_time": t, "amount": a, "location": loc}
                        for s, u, t, a, loc in data])
    assert scores(D.score_all(txns(spark, data), rows_per_block=rpb)) == exp
