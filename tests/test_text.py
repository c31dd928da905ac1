"""String rules against Python's own behaviour."""

import string
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.fixed_values import WHITESPACE
from tallyloom.functions.specs import parse_board_spec, parse_glue_spec
from tallyloom.functions.text import is_blank, title_py, trim_py

QUIET = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
LETTERS = string.ascii_letters + string.digits + " '-_.éÉüÜñß中"


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@QUIET
@given(st.lists(st.text(alphabet=WHITESPACE + "ab*"), min_size=1, max_size=200))
def test_strip(spark, values):
    assert column(spark, values, trim_py) == [v.strip() for v in values]
    assert column(spark, values, is_blank) == [not v.strip() for v in values]


@QUIET
@given(st.lists(st.text(alphabet=LETTERS), min_size=1, max_size=200))
def test_title(spark, values):
    assert column(spark, values, title_py) == [v.title() for v in values]


def test_title_of_names(spark):
    values = ["glue", "glue-a 25kg o'neil", "GLUE B", "a1b"]
    assert column(spark, values, title_py) == ["Glue", "Glue-A 25Kg O'Neil", "Glue B", "A1B"]


number = st.decimals(min_value=0, max_value=9999, places=3).map(str)
board = st.lists(st.one_of(number, st.sampled_from(["", "a", " 7 ", "1e2"])), min_size=1, max_size=4).map("*".join)


@QUIET
@given(st.lists(board, min_size=1, max_size=100))
def test_board_spec(spark, values):
    for raw, got in zip(values, column(spark, values, parse_board_spec)):
        parts = raw.split("*")
        if len(parts) != 3:
            assert got.error == f"Expected 3 segments separated by '*', got {len(parts)}: '{raw}'"
            assert got.thickness is None
            continue
        try:
            expected = [Decimal(p.strip()) for p in parts]
        except ArithmeticError:
            assert got.error == f"Non-numeric segment in '{raw}'"
            continue
        assert got.error is None
        assert [got.thickness, got.width, got.length] == expected


def test_board_spec_overflow_and_rounding(spark):
    big, small = column(spark, ["1*2*123456789012", "0.00005*2*3"], parse_board_spec)
    assert big.error is None and big.overflow and big.length is None
    assert small.thickness == Decimal("0.0001") and not small.overflow


def test_glue_spec(spark):
    values = ["25kg/1bag", "2.5KG/10BAG ", "25 kg/1bag", "kg/1bag", "25kg/1.5bag"]
    a, b, *bad = column(spark, values, parse_glue_spec)
    assert (a.weight_per_bag_kg, a.bags_per_unit, a.error) == (25, 1, None)
    assert (b.weight_per_bag_kg, b.bags_per_unit, b.error) == (Decimal("2.5"), 10, None)
    assert [r.error for r in bad] == [
        f"Unrecognised format '{v}' — expected e.g. '25kg/1bag'" for v in values[2:]
    ]
