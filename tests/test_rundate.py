import datetime as dt

import pytest

from quarry.functions.rundate import date_range, date_spine, default_run_date, int_range, int_spine


def test_default_run_date_is_yesterday():
    assert default_run_date(dt.date(2024, 3, 1)) == "2024-02-29"


def test_date_range_cases():
    assert date_range("2024-01-01", "2024-01-01") == ["2024-01-01"]
    assert date_range("2024-01-01", "2024-01-03", 0) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert date_range("2024-01-01", "2024-01-03", None) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert date_range("2024-01-01", "2024-01-08", 3) == ["2024-01-01", "2024-01-04", "2024-01-07"]
    assert date_range("2024-01-05", "2024-01-01") == []
    with pytest.raises(ValueError):
        date_range("2024-01-01", "2024-01-08", -1)


def test_int_range_inclusive():
    assert int_range(3, 6) == [3, 4, 5, 6]


def test_spines_match_ranges(spark):
    dates = [r.run_date.isoformat() for r in date_spine(spark, "2024-01-01", "2024-02-01", 7).collect()]
    assert dates == date_range("2024-01-01", "2024-02-01", 7)
    assert [r.run_key for r in int_spine(spark, 1, 5).collect()] == [1, 2, 3, 4, 5]

