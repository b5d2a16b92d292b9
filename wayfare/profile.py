"""Tunable constants of the clean-up and the reports."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# Payment codes and their names.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# First and last hour of each part of the day; other hours are "Night".
DAY_PARTS = {"Morning": (5, 10), "Afternoon": (11, 15), "Evening": (16, 20)}

# Columns that identify a cleaned trip. The timestamps come first, so
# that a sort on the key is settled by its first column on nearly every comparison.
TRIP_KEY = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance",
    "total_amount",
    "vendor_id",
)


@dataclass(frozen=True)
class TripProfile:
    """What one load accepts, and how it names things."""

    window_start: datetime = datetime(2026, 1, 1)
    window_end: datetime = datetime(2026, 2, 1)
    window_error: str = "outside_january_2026"
    rejection_note: str = "Record rejected during bronze to silver validation"
    missing_name: str = "Unknown"
    payment_labels: dict[int, str] = field(default_factory=lambda: dict(PAYMENT_LABELS))
    other_payment: str = "Other"
    day_parts: dict[str, tuple[int, int]] = field(default_factory=lambda: dict(DAY_PARTS))
    other_day_part: str = "Night"
    trip_key: tuple[str, ...] = TRIP_KEY
    strict: bool = False


DEFAULT_PROFILE = TripProfile()
