"""Time helpers: epoch milliseconds, bucket floors, run ranges.

Candles store time as epoch milliseconds (``LongType``). Buckets are
epoch-aligned: ``ts - pmod(ts, bucket)``. Because 1970-01-01 was a
Thursday, 7-day buckets start on Thursday 00:00 UTC.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
DAY_MS = 86_400_000

# The candle intervals and their scheduled look-back and
# slice sizes in days, as configured for each rollup.
INTERVAL_MINUTES = {"3m": 3, "15m": 15, "1h": 60, "4h": 240, "8h": 480, "1d": 1440, "7d": 10080}
LOOKBACK_DAYS = {"15m": 3, "1h": 7, "4h": 14, "8h": 30, "1d": 90, "7d": 365}
BATCH_DAYS = {"15m": 3, "1h": 7, "4h": 14, "8h": 30, "1d": 30, "7d": 90}


def interval_ms(name: str) -> int:
    return INTERVAL_MINUTES[name] * MINUTE_MS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP or TIMESTAMP_NTZ column, truncated.

    ``timestampdiff`` against the NTZ epoch works for both timestamp kinds
    (the session zone is UTC) and truncates sub-millisecond digits.
    """
    return F.timestamp_diff("MILLISECOND", F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"), _col(ts))


def epoch_us(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"), _col(ts))


def bucket_floor(ms, bucket_ms: int) -> Column:
    """Start of the epoch-aligned bucket holding ``ms`` (also for ms < 0)."""
    c = _col(ms)
    return c - F.pmod(c, F.lit(int(bucket_ms)))


def ms_to_timestamp(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def day_floor_ms(ms) -> Column:
    return bucket_floor(ms, DAY_MS)


# ISO-8601 date at the start of the text; anything else is rejected before
# the cast (Spark would otherwise also accept e.g. '2024').
_ISO_PREFIX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def parse_iso_ms(text) -> Column:
    """Epoch ms of ISO-8601 text; 'Z' and offsets honoured, zone-less = UTC.

    Unparsable, empty or NULL text gives NULL.
    """
    t = _col(text).cast("string")
    return F.when(t.rlike(_ISO_PREFIX), F.unix_millis(F.try_to_timestamp(t)))


def normalize_ts_day(text) -> Column:
    """ISO text -> epoch ms of its UTC midnight (NULL when unparsable)."""
    return day_floor_ms(parse_iso_ms(text))


# ---------------------------------------------------------------- run range

def instant(text: str | datetime, name: str) -> datetime:
    """A run argument as an aware UTC time: ISO-8601 text ('Z' or an offset; none means UTC) or a datetime.

    Raises ``ValueError`` naming the argument for anything else.
    """
    if isinstance(text, datetime):
        when = text
    else:
        try:
            when = datetime.fromisoformat(text.strip())
        except (AttributeError, ValueError):
            raise ValueError(f"{name}: {text!r} is not an ISO-8601 time") from None
    return when.replace(tzinfo=timezone.utc) if when.tzinfo is None else when.astimezone(timezone.utc)


def _to_ms(dt: datetime) -> int:
    return int(dt.timestamp() * 1000)


@dataclass(frozen=True)
class RunRange:
    """Half-open ``[start_ms, end_ms)`` range of one rollup run.

    Both ends are floored to the bucket, so the still-open bucket is left
    out; if the floored end is not after the start, one bucket is used.
    Explicit ``since``/``until`` text that does not parse raises (the
    original silently fell back to the default range).
    """

    start_ms: int
    end_ms: int

    @classmethod
    def resolve(cls, bucket_ms: int, run_time: str | datetime, lookback_days: int,
                since: str | None = None, until: str | None = None) -> "RunRange":
        run_dt = instant(run_time, "run_time")
        start_dt = instant(since, "since") if since else run_dt - timedelta(days=lookback_days)
        end_dt = instant(until, "until") if until else run_dt
        if end_dt <= start_dt:
            raise ValueError("end of the run range must be after its start")
        start = (_to_ms(start_dt) // bucket_ms) * bucket_ms
        end = (_to_ms(end_dt) // bucket_ms) * bucket_ms
        if end <= start:
            end = start + bucket_ms
        return cls(start, end)

    @classmethod
    def from_conf(cls, bucket_ms: int, run_time: str | datetime, lookback_days: int,
                  conf: dict | None = None) -> "RunRange":
        """Range from run arguments: ``since`` and ``until`` (or ``end``)."""
        conf = conf or {}
        return cls.resolve(bucket_ms, run_time, lookback_days, since=conf.get("since") or None,
                           until=conf.get("until") or conf.get("end") or None)

    def slices(self, batch_days: int, bucket_ms: int) -> list[tuple[int, int]]:
        """Report slices; width rounded up to whole buckets (no cut candles)."""
        width = max(batch_days, 1) * DAY_MS
        width = -(-width // bucket_ms) * bucket_ms
        out, s = [], self.start_ms
        while s < self.end_ms:
            out.append((s, min(s + width, self.end_ms)))
            s += width
        return out

