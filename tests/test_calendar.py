"""Calendar attributes against Python's calendar."""

import datetime as dt

from starloom.operators.calendar import calendar, month_dimension


def test_calendar_matches_python(spark):
    start, end = dt.date(2023, 12, 25), dt.date(2024, 3, 5)  # spans a year end and 29 February
    rows = calendar(spark, start, end).collect()
    assert len(rows) == (end - start).days + 1
    for r in rows:
        d = r["full_date"]
        assert r["date_key"] == d.year * 10000 + d.month * 100 + d.day
        assert r["day_name"] == d.strftime("%A")
        assert r["day_of_week"] == d.isoweekday()
        assert r["is_weekend"] == (d.isoweekday() >= 6)
        assert r["month_name"] == d.strftime("%B")
        assert r["quarter"] == (d.month - 1) // 3 + 1
        assert r["year_month"] == d.strftime("%Y-%m")
        assert (r["year"], r["month_number"], r["day_of_month"]) == (d.year, d.month, d.day)


def test_month_dimension_is_a_subset_of_the_calendar(spark):
    days = calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    months = {r["year_month"]: r for r in month_dimension(days).collect()}
    assert len(months) == 12
    assert months["2024-02"]["days_in_month"] == 29
    assert months["2024-02"]["month_key"] == 202402 and months["2024-02"]["quarter"] == 1
