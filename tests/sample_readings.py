"""Readings that several test modules start from."""

import numpy as np
import pandas as pd


def patterned(days: int = 10, routes: int = 3, seed: int = 42) -> pd.DataFrame:
    """Hourly readings with a daily pattern per route."""
    rng = np.random.default_rng(seed)
    rows = []
    for t in pd.date_range("2025-10-01", periods=days * 24, freq="h"):
        for i in range(routes):
            speed = (25 + 3 * i) * (1 - 0.3 * np.sin(2 * np.pi * t.hour / 24)) + rng.normal(0, 2)
            rows.append((t.year, t.month, t.day, t.hour, f"ROUTE_{'ABCDEFGH'[i]}", 600 / speed, 10.0, float(speed)))
    return pd.DataFrame(rows, columns=["year", "month", "day", "hour", "route_code", "duration", "distance", "avg_speed"])
