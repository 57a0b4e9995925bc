"""Flights: cancellation rate by airline, standardized speed by day of the week."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace import operators as op


def cancellation_rate(df: DataFrame) -> DataFrame:
    return op.group_rate(df, ["Reporting_Airline"], "Cancelled", "cancellation_rate")


def speed_by_weekday(df: DataFrame) -> DataFrame:
    """Sum of the standard scores of a day's flights over the number of its flights.

    Flights of unknown duration have no score, and count as flights all the same.
    """
    flown = op.ratio(op.filter_equal(df, "Cancelled", 0), "Distance", "ActualElapsedTime", "speed")
    scored = op.standardize(flown.select("DayOfWeek", "speed"), ["speed"], name="standard_speed")
    return op.group_mean_all_rows(scored, ["DayOfWeek"], "standard_speed", "mean_standard_speed")
