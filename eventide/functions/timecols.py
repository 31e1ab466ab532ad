"""Event-time column helpers (PRJ-3/4, WIN-4, TIM-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

MS = {"ms": 1, "s": 1000, "min": 60_000, "h": 3_600_000, "d": 86_400_000}


def ms(amount: int, unit: str = "s") -> int:
    return int(amount * MS[unit])


def from_seconds(col):
    """PRJ-3: epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(col)


def from_millis(col):
    """PRJ-4: epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(col)


def window_start_ms(t_ms, size_ms: int):
    """Epoch-aligned tumbling window start, in ms."""
    t = F.col(t_ms) if isinstance(t_ms, str) else t_ms
    return t - F.pmod(t, F.lit(size_ms))


def inclusive_window_end_ms(t_ms, size_ms: int):
    """WIN-4: ``t - t % d + d - 1``, the last millisecond of the window."""
    return window_start_ms(t_ms, size_ms) + F.lit(size_ms - 1)


def ntz_from_ms(col):
    """Epoch ms -> TIMESTAMP_NTZ (for results compared with stored tables)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c).cast("timestamp_ntz")
