"""Property: rendering typed rows as text and parsing them back is the identity."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loadwright.functions.render import delimited_line, fixed_width_line
from loadwright.sources import textscan as ts

SCHEMA = "k BIGINT, s STRING, d DOUBLE, n INT"
WIDTHS = [20, 12, 25, 11]

text = st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc", "Zl", "Zp"), blacklist_characters="|"),
               min_size=1, max_size=10).filter(lambda t: t.strip() == t and t.strip() != "")
rows = st.lists(st.tuples(st.integers(-2**62, 2**62), st.one_of(st.none(), text),
                          st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
                          st.one_of(st.none(), st.integers(-2**31, 2**31 - 1))),
                min_size=1, max_size=25)


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_delimited_round_trip(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    lines = df.select(delimited_line(df.columns, "|").alias("value"))
    back = ts.good_rows(ts.parse_delimited(lines, SCHEMA, "|"), SCHEMA).collect()
    assert sorted(map(tuple, back), key=_key) == sorted(map(tuple, df.collect()), key=_key)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_fixed_width_round_trip(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    lines = df.select(fixed_width_line(df.columns, WIDTHS).alias("value"))
    parsed = ts.parse_fixed_width(lines, SCHEMA, WIDTHS)
    fits = [r for r in df.collect() if all(len("" if v is None else str(v)) <= w
                                            for v, w in zip(r, WIDTHS))]
    back = ts.good_rows(parsed, SCHEMA).collect()
    # values wider than their field cannot round-trip; all others must
    assert all(tuple(r) in set(map(tuple, back)) for r in fits)
