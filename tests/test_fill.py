"""Zero fill: numeric NULL/NaN -> 0, other types untouched."""

from daybook.operators.pit import fill_zero


def test_fill_zero_numeric_only(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), None, None, None), (5, 1.5, "x", True, 2.0)],
        "k bigint, d double, s string, b boolean, e double",
    )
    rows = sorted(fill_zero(df).collect(), key=lambda r: r.k)
    assert tuple(rows[0]) == (0, 0.0, None, None, 0.0)
    assert tuple(rows[1]) == (5, 1.5, "x", True, 2.0)
    assert dict(fill_zero(df).dtypes) == dict(df.dtypes)
