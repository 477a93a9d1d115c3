"""Property tests: the cleaning rules against a plain statement of their
meaning, on generated batches (one Spark job per batch)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txlake.functions import city_clean, date_parse, price_clean, surface_clean

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _run(spark, values, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", rule("v")).collect())]


def _with_commas(digits: str) -> str:
    out = []
    for i, ch in enumerate(reversed(digits)):
        if i and i % 3 == 0:
            out.append(",")
        out.append(ch)
    return "".join(reversed(out))


@st.composite
def number_text(draw, max_int_digits=13):
    whole = draw(st.integers(min_value=0, max_value=10**max_int_digits - 1))
    frac = draw(st.text(alphabet="0123456789", min_size=0, max_size=4))
    text = _with_commas(str(whole)) if draw(st.booleans()) else str(whole)
    if frac:
        text += "." + frac
    pad = draw(st.sampled_from(["", " ", "  "]))
    return pad + text + pad, (Decimal(f"{whole}.{frac}") if frac else Decimal(whole))


def _expected_decimal(value: Decimal, precision: int, scale: int):
    q = value.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    return q if q < Decimal(10) ** (precision - scale) else None


@SETTINGS
@given(st.lists(number_text(), min_size=20, max_size=60))
def test_price_rule_property(spark, cases):
    got = _run(spark, [t for t, _ in cases], price_clean)
    assert got == [_expected_decimal(v, 12, 2) for _, v in cases]


@SETTINGS
@given(st.lists(number_text(max_int_digits=11), min_size=20, max_size=60))
def test_surface_rule_property(spark, cases):
    # thousands separators are not part of the surface format: those stay null
    got = _run(spark, [t for t, _ in cases], surface_clean)
    want = [None if "," in t else _expected_decimal(v, 10, 1) for t, v in cases]
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.just(""), st.text(max_size=8)), min_size=20, max_size=60))
def test_city_rule_property(spark, values):
    assert _run(spark, values, city_clean) == [None if v == "" else v for v in values]


@st.composite
def date_text(draw):
    y = draw(st.integers(min_value=1900, max_value=2100))
    m = draw(st.integers(min_value=1, max_value=13))
    d = draw(st.integers(min_value=1, max_value=31))
    text = f"{y:04d}-{m:02d}-{d:02d}"
    try:
        return text, dt.date(y, m, d)
    except ValueError:
        return text, None


@SETTINGS
@given(st.lists(date_text(), min_size=20, max_size=60))
def test_date_rule_property(spark, cases):
    assert _run(spark, [t for t, _ in cases], date_parse) == [v for _, v in cases]


def _min_row_reference(rows):
    """Per key (None is one key), the smallest (a, b) with nulls last."""
    def order(v):
        return (1, "") if v is None else (0, v)

    best = {}
    for k, a, b in rows:
        cand = (order(a), order(b), a, b)
        if k not in best or cand[:2] < best[k][:2]:
            best[k] = cand
    return sorted(((k, c[2], c[3]) for k, c in best.items()), key=lambda r: (order(r[0]), order(r[1]), order(r[2])))


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "k1", "k2", "k3"]),
            st.sampled_from([None, "", "a", "b", "B"]),
            st.sampled_from([None, "x", "y"]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_dedup_min_equals_brute_force(spark, rows):
    from txlake.operators import dedup_by_key

    def order(v):
        return (1, "") if v is None else (0, v)

    df = spark.createDataFrame(rows, "k string, a string, b string").repartition(3)
    want = _min_row_reference(rows)
    for strategy in ("shuffle", "split"):
        got = sorted(map(tuple, dedup_by_key(df, ["k"], strategy=strategy).collect()), key=lambda r: tuple(order(v) for v in r))
        assert got == want, strategy
