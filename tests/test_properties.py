"""Property tests: keep-last and upsert against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators.dedup import keep_last
from stratum.operators.upsert import upsert

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 50), st.text("ab", max_size=2)),
                   max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=rows_st)
def test_keep_last_model(spark, rows):
    # order column made unique so "last" is well defined
    data = [(k, o * 100 + i, v) for i, (k, o, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, o int, v string")
    got = sorted(map(tuple, keep_last(df, ["k"], ["o"]).collect()), key=repr)
    model = {}
    for k, o, v in data:
        if k not in model or o > model[k][1]:
            model[k] = (k, o, v)
    assert got == sorted(model.values(), key=repr)


keyed_st = st.dictionaries(st.integers(0, 9), st.text("xyz", max_size=2), max_size=8)


@SETTINGS
@given(target=keyed_st, source=keyed_st)
def test_upsert_model(spark, target, source):
    t = spark.createDataFrame(list(target.items()), "k int, v string")
    s = spark.createDataFrame(list(source.items()), "k int, v string")
    got = dict(map(tuple, upsert(t, s, ["k"]).collect()))
    assert got == {**target, **source}
    again = dict(map(tuple, upsert(upsert(t, s, ["k"]), s, ["k"]).collect()))
    assert again == got
