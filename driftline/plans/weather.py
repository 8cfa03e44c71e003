"""Worked example: the contract of a daily weather-station table."""

from __future__ import annotations

from driftline.operators.drift import Shift
from driftline.spec import TableSpec, between, flatten, isin, not_null

# Physical limits per sensor, in schema order.
BOUNDS = {
    "MinTemp": (-20, 50),
    "MaxTemp": (-15, 55),
    "Rainfall": (0, 500),
    "Evaporation": (0, 200),
    "Sunshine": (0, 24),
    "WindGustSpeed": (0, 200),
    "WindSpeed9am": (0, 200),
    "WindSpeed3pm": (0, 200),
    "Humidity9am": (0, 100),
    "Humidity3pm": (0, 100),
    "Pressure9am": (970, 1050),
    "Pressure3pm": (970, 1050),
    "Cloud9am": (0, 9),
    "Cloud3pm": (0, 9),
    "Temp9am": (-20, 55),
    "Temp3pm": (-20, 55),
}

WEATHER = TableSpec(
    name="weather",
    version="weather-contract-v1",
    key=("Date", "Location"),
    date="Date",
    numeric=tuple(BOUNDS),
    categorical=("Location", "WindGustDir", "WindDir9am", "WindDir3pm", "RainToday"),
    target="RainTomorrow",
    leak=("RISK_MM",),
    sparse=("Evaporation", "Sunshine", "Cloud9am", "Cloud3pm"),
    rules=flatten(
        [
            not_null("Date"),
            not_null("Location"),
            *[between(c, low, high) for c, (low, high) in BOUNDS.items()],
            isin("RainToday", "Yes", "No"),
            isin("RainTomorrow", "Yes", "No", training=True),
        ]
    ),
)

# Actions a score leads to.
ACTION_YES = "delay_spray_and_cover_harvest"
ACTION_NO = "proceed_field_work"

# Sensor shift of the drift exercise (scale, offset, clip range).
SHIFT = {
    "Humidity9am": Shift(0.35, 62, 0, 100),
    "Humidity3pm": Shift(0.35, 62, 0, 100),
    "Pressure9am": Shift(1, -8, 970, 1050),
    "Pressure3pm": Shift(1, -8, 970, 1050),
    "Rainfall": Shift(1, 8, 0, 500),
    "MinTemp": Shift(1, 5, -20, 50),
    "MaxTemp": Shift(1, 5, -15, 55),
    "Temp9am": Shift(1, 6, -20, 55),
    "Temp3pm": Shift(1, 6, -20, 55),
    "WindSpeed9am": Shift(1, 15, 0, 200),
    "WindSpeed3pm": Shift(1, 15, 0, 200),
}
