"""Day table explode (R5-R10) edge cases."""

import pytest

from sweepframe.functions.daytable import LONG_VALUE_COLUMNS, explode_days


def explode(spark, dat, mode="failfast", task_id=1, seed=0):
    df = spark.createDataFrame([(task_id, None, seed, dat)],
                               "task_id long, params_id long, seed long, output_dat string")
    return explode_days(df, mode).orderBy("Day").collect()


def test_sample_header_and_absent_columns(spark):
    dat = ("Day          Su       PS/PI     A/I\n"
           "    0    2090577         21    7\n"
           "    1    2090575         11    8\n")
    rows = explode(spark, dat)
    assert [r.Day for r in rows] == [0, 1]
    assert rows[0].Su == 2090577.0 and rows[0].PS_PI == 21.0 and rows[0].A_I == 7.0
    assert rows[0].ICU == 0.0 and rows[0].params_id == 0


def test_blank_short_long_rows(spark):
    dat = "Day Su R\n\n1 2 3\n2 5\n3 7 8 99\n   \n"
    rows = explode(spark, dat)
    assert [(r.Day, r.Su, r.R) for r in rows] == [(1, 2.0, 3.0), (3, 7.0, 8.0)]


def test_no_day_column_and_reordered(spark):
    rows = explode(spark, "Su D\n5 1\n6 2\n")
    # no Day column: position 0 is the day
    assert [(r.Day, r.Su, r.D) for r in rows] == [(5, 5.0, 1.0), (6, 6.0, 2.0)]
    rows = explode(spark, "R Day Su\n9 1 4\n")
    assert (rows[0].Day, rows[0].Su, rows[0].R) == (1, 4.0, 9.0)


def test_duplicate_header_last_wins(spark):
    rows = explode(spark, "Day Su Su\n1 2 3\n")
    assert rows[0].Su == 3.0


def test_blank_first_line_is_header(spark):
    # the header is line 1 even when blank: every data row then has >= 1 token
    rows = explode(spark, "\n1 2\n")
    assert [r.Day for r in rows] == [1]


def test_non_numeric_failfast_and_quarantine(spark):
    with pytest.raises(Exception):
        explode(spark, "Day Su\n1 abc\n")
    rows = explode(spark, "Day Su\n1 abc\n2 3\n", mode="quarantine")
    assert [(r.Day, r._bad) for r in rows] == [(1, True), (2, False)]


def test_schema(spark):
    df = spark.createDataFrame([(1, 2, 3, "Day Su\n1 2\n")], "task_id long, params_id long, seed long, output_dat string")
    out = explode_days(df)
    assert out.columns == ["row_id", "params_id", "seed", "Day"] + LONG_VALUE_COLUMNS
    assert dict(out.dtypes)["Day"] == "int" and dict(out.dtypes)["Su"] == "float"
