"""Validated job options."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from itemsync.functions.times import plain_utc
from itemsync.schemas import LOOK_BACK_DAYS, OBJECTS, PLATFORM_CLOUD, PLATFORMS


@dataclass(frozen=True)
class FieldRule:
    """Include or exclude list of one object; names are source field names."""

    include_fields: tuple[str, ...] = ()
    exclude_fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class JobOptions:
    """Options of one sync run. ``now`` is always passed in, so plans stay repeatable.

    ``bounds``: ``half_open`` keeps an item stamped exactly ``start``; ``open``
    drops it. ``same_chunk`` keeps an attachment only where it falls into the
    same of ``time_chunks`` slices as its parent. ``objects`` absent from the
    mapping are skipped. Times with a zone are taken as their UTC instants.
    ``drop_oversized`` sends a document above the request limit without its body,
    instead of in a request of its own.
    """

    now: datetime
    platform: str = PLATFORM_CLOUD
    start_time: datetime | None = None
    end_time: datetime | None = None
    permissions: bool = True
    objects: dict[str, FieldRule] = field(default_factory=lambda: {o: FieldRule() for o in OBJECTS})
    time_chunks: int = 5
    retries: int = 3
    bounds: str = "half_open"
    same_chunk: bool = False
    unify_created: bool = False
    dedup_calendar: bool = False
    reference_rules: bool = False
    drop_oversized: bool = False

    def __post_init__(self):
        for name in ("now", "start_time", "end_time"):
            moment = getattr(self, name)
            if moment is not None:
                object.__setattr__(self, name, plain_utc(moment))
        if self.platform not in PLATFORMS:
            raise ValueError(f"platform must be one of {PLATFORMS}, got {self.platform!r}")
        if self.start_time is None:
            object.__setattr__(self, "start_time", self.now - timedelta(days=LOOK_BACK_DAYS))
        if self.end_time is None:
            object.__setattr__(self, "end_time", self.now)
        if max(self.start_time, self.end_time) > self.now:
            raise ValueError("start_time and end_time must not lie after now")
        if self.start_time >= self.end_time:
            raise ValueError(f"start_time {self.start_time} must be before end_time {self.end_time}")
        if self.bounds not in ("half_open", "open"):
            raise ValueError(f"bounds must be half_open or open, got {self.bounds!r}")
        if self.time_chunks < 1 or self.retries < 1:
            raise ValueError("time_chunks and retries must be at least 1")
        unknown = set(self.objects) - set(OBJECTS)
        if unknown:
            raise ValueError(f"unknown objects: {sorted(unknown)}")
