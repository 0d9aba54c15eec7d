"""Adverse-event signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.calendar import last_completed_quarter
from dropforge.functions.text import day_first_to_iso, day_first_to_month
from dropforge.plans.registry import view
from dropforge.sources.schemas import SOURCES

DATES = ("date_reception", "date_cloture")


@view("staging__helios_sivss")
def until_last_quarter(views):
    """Signals received up to the last complete quarter, dates in ISO order. A blank date passes."""
    signals = views.view("staging__sa_sivss").where(
        day_first_to_month("date_reception") <= last_completed_quarter(views.today)
    )
    return signals.select(
        *[day_first_to_iso(c).alias(c) if c in DATES else F.col(c) for c in SOURCES["sa_sivss"].columns]
    )
