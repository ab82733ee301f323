"""Run context: the values the reference takes from ``current_timestamp()`` /
``current_date()`` and project variables.  One timestamp per run, so every
row written by a run carries the same audit stamp."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (project variables of the reference).
SOURCE_SYSTEM = "SYNTHETIC_CARD_PLATFORM"

# Deterministic stamp used by tests and by the registered queries, so results
# can be compared against an independent engine.
FIXED_RUN_TS = "2026-01-01 00:00:00"
FIXED_AS_OF_DATE = "2026-01-01"


def _utc_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass(frozen=True)
class RunContext:
    """``run_ts`` (UTC wall clock, TIMESTAMP_NTZ) and ``as_of_date``."""

    run_ts: str = field(default_factory=_utc_now)
    as_of_date: str | None = None
    source_system: str = SOURCE_SYSTEM

    @classmethod
    def fixed(cls) -> "RunContext":
        return cls(run_ts=FIXED_RUN_TS, as_of_date=FIXED_AS_OF_DATE)

    def ts(self) -> Column:
        return F.lit(self.run_ts).cast("timestamp_ntz")

    def date(self) -> Column:
        return F.lit(self.as_of_date or self.run_ts[:10]).cast("date")
