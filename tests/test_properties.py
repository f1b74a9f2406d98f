"""Property tests against brute force on small random inputs."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from bazaar.functions import lenient_int
from bazaar.operators.dedup import dedup_batch

SETTINGS = settings(max_examples=25, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), max_size=40)


def _brute_dedup(data):
    best = {}
    for k, a, b in data:
        key = ((a is not None, a if a is not None else 0), (b is not None, b or ""))
        if k not in best or key < best[k][0]:
            best[k] = (key, (k, a, b))
    return sorted(v[1] for v in best.values())


@SETTINGS
@given(rows)
def test_dedup_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, a int, b string")
    got = sorted(tuple(r) for r in dedup_batch(df, ["k"]).collect())
    assert got == _brute_dedup(data)
    again = sorted(tuple(r) for r in dedup_batch(dedup_batch(df, ["k"]), ["k"]).collect())
    assert again == got


texts = st.one_of(st.none(), st.from_regex(r"\A\s?[+-]?\d{1,11}(\.\d{0,3})?\s?\Z"),
                  st.text(alphabet="0123456789.+-eE x\t\n\x85\u00a0", max_size=8))


def _brute_int(t):
    if t is None:
        return None
    m = re.fullmatch(r"([+-]?[0-9]+)(\.[0-9]*)?", t.strip("".join(map(chr, range(33)))))
    if not m:
        return None
    v = int(m.group(1))
    return v if -2**31 <= v < 2**31 else None


@SETTINGS
@given(st.lists(texts, max_size=30))
def test_lenient_int_matches_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(lenient_int("x", T.StringType(), "int")).collect()]
    assert got == [_brute_int(v) for v in values]
