"""Small frames, and a plain-Python account of what the series recipe must give."""

from __future__ import annotations

from datetime import datetime, timedelta

DAY = datetime(2021, 9, 1)
OBS = "station string, time timestamp_ntz, value double, seq bigint"


def at(minutes: float) -> datetime:
    return DAY + timedelta(minutes=minutes)


def obs_frame(spark, rows):
    """Rows of (station, minutes after the day, value); seq is the row number."""
    return spark.createDataFrame([(s, at(m), v, i) for i, (s, m, v) in enumerate(rows)], OBS)


def by_key(df):
    return {(r["station"], r["time"]): r["value"] for r in df.collect()}


def first_of_times(rows):
    seen = {}
    for s, t, v, _ in sorted(rows, key=lambda r: r[3]):
        seen.setdefault((s, t), v)
    series = {}
    for (s, t), v in sorted(seen.items()):
        series.setdefault(s, []).append((t, v))
    return series


def us(delta) -> int:
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def repaired(points, limit):
    """Fill the first `limit` NULLs of each inner gap, walking one series in time order."""
    out = []
    for i, (t, v) in enumerate(points):
        if v is None:
            back = i - 1
            while back >= 0 and points[back][1] is None:
                back -= 1
            ahead = i + 1
            while ahead < len(points) and points[ahead][1] is None:
                ahead += 1
            if back >= 0 and ahead < len(points) and i - back <= limit:
                (pt, p), (nt, n) = points[back], points[ahead]
                v = p + (n - p) * us(t - pt) / us(nt - pt)
        out.append((t, v))
    return out


def floor_bin(t, first, minutes):
    """Bins count from midnight of the series' first day."""
    origin = datetime(first.year, first.month, first.day)
    width = minutes * 60_000_000
    return origin + timedelta(microseconds=us(t - origin) // width * width)


def binned(points, minutes):
    """First value per bin, with the empty bins in between."""
    first = points[0][0]
    found = {}
    for t, v in points:
        b = floor_bin(t, first, minutes)
        if found.get(b) is None:
            found[b] = v
    b, last = min(found), max(found)
    while b <= last:
        found.setdefault(b, None)
        b += timedelta(minutes=minutes)
    return found


def recipe(rows, minutes=15, limit=1, fill=-99999.0):
    """The whole recipe on (station, time, value, seq) rows."""
    series = {s: repaired(p, limit) for s, p in first_of_times(rows).items()}
    regular = {s: dict(p) if minutes == 0 else binned(p, minutes) for s, p in series.items()}
    axis = {t for bins in regular.values() for t in bins}
    return {
        (s, t): fill if bins.get(t) is None else bins[t]
        for s, bins in regular.items() for t in axis
    }
