"""Random tables against plain Python."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import predicates as P
from plumbline.operators import checks as C
from plumbline.operators.checks import Suite
from plumbline.operators.validate import validate

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 12)), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=40)


@QUICK
@given(data=rows, low=st.integers(-2, 3), high=st.integers(4, 10), mostly=st.sampled_from([0.5, 0.9, 1.0]))
def test_checks_against_python(spark, data, low, high, mostly):
    df = spark.createDataFrame(data, "a int, k int")
    dim = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    suite = Suite("s", "t", (C.between("a", low, high, mostly), C.not_null("a", mostly), C.unique("k"),
                             C.compound_unique("a", "k"), C.duplicate_key("k"), C.references("k", "dim", "k")))
    got = {r.check_no: r for r in validate(df, suite, {"dim": dim}).collect()}
    a, k = [x for x, _ in data if x is not None], [y for _, y in data if y is not None]
    pairs = [p for p in data if p != (None, None)]
    expected = {
        1: (len(a), sum(not low <= x <= high for x in a)),
        2: (len(data), len(data) - len(a)),
        3: (len(k), sum(k.count(y) > 1 for y in k)),
        4: (len(pairs), sum(pairs.count(p) > 1 for p in pairs)),
        5: (len({y for _, y in data}), sum([y for _, y in data].count(v) > 1 for v in {y for _, y in data})),
        6: (len(data), sum(y not in (1, 2, 3) for _, y in data)),
    }
    assert {n: (r.evaluated_count, r.unexpected_count) for n, r in got.items()} == expected
    for n in (1, 2):
        evaluated, unexpected = expected[n]
        passes = evaluated - unexpected >= Decimal(str(mostly)) * evaluated
        assert got[n].status == ("PASS" if passes else "FAIL")


@QUICK
@given(pairs=st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 5000)), min_size=1, max_size=30))
def test_percentages_round_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "part int, whole int")
    got = [r.p for r in df.select(P.percent(F.col("part"), F.col("whole")).alias("p")).collect()]
    assert got == [float((Decimal(100 * a) / b).quantize(Decimal("0.01"), ROUND_HALF_UP)) for a, b in pairs]
