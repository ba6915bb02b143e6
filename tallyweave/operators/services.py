"""Services of the driver: a spending ledger with reservations, bounded polling, release decisions. They are no queries."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLUG = re.compile(r"[a-z0-9]+(?:-[a-z0-9]+)*")


class OverBudget(RuntimeError):
    """A reservation above what is left."""


class Budget:
    """Reserve, call, settle: one at a time. A call that fails stays reserved, as its cost is unknown."""

    def __init__(self, limit: Decimal, spent: Decimal | None):
        if spent is None:
            raise ValueError("prior usage is unknown")
        self.limit, self.spent, self.entries = limit, spent, []
        self._lock = threading.Lock()

    @contextmanager
    def reserve(self, entry: str, ceiling: Decimal) -> Iterator[Callable[[Decimal], None]]:
        with self._lock:
            if self.spent + ceiling > self.limit:
                raise OverBudget(entry)
            self.spent += ceiling
            self.entries.append((entry, "reservation", ceiling))

            def settle(cost: Decimal) -> None:
                self.spent += cost - ceiling
                self.entries.append((entry, "settlement", cost))

            yield settle


def poll(check: Callable[[], object], attempts: int, wait: Callable[[int], None]) -> object | None:
    """The first answer that is not None, within a number of attempts."""
    for k in range(attempts):
        if (found := check()) is not None:
            return found
        wait(k)
    return None


def select_target(cities: dict[str, set[str]], city: str, organization: str | None = None) -> tuple[str, str | None]:
    """A known city, and a known organization of it if one is named; names must be slugs."""
    for name in (city, organization):
        if name is not None and not SLUG.fullmatch(name):
            raise ValueError("not a slug")
    if city not in cities or organization is not None and organization not in cities[city]:
        raise LookupError("unknown target")
    return city, organization


def release_decision(differences: DataFrame, last_good: str | None) -> tuple[str, str | None]:
    """keep, or roll back to the last verified release, or fail without one. differences: as of manifest_difference."""
    if differences.limit(1).count() == 0:
        return "keep", None
    return ("roll_back", last_good) if last_good else ("fail", None)


def record_state(map_status: Column, labels: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), map_status)


def nearest_state(visible: Column, heights: Column) -> Column:
    """The index (from 0) of the height nearest to what is visible; the first of equals."""
    return F.array_min(F.transform(heights, lambda h, k: F.struct(F.abs(h - visible).alias("gap"), k.alias("k"))))["k"]


def started_at(stamp: Column, now: Column, monotonic_now: Column) -> Column:
    """Monotonic milliseconds of an event stamp that is either monotonic or since the epoch."""
    return F.when(stamp > F.lit(1e12), stamp - now + monotonic_now).otherwise(stamp)


def proposals(replies: DataFrame) -> DataFrame:
    """status and reason of restoration proposals: withheld unless a supported answer names a known candidate and a name.

    replies: error, supported, candidate_source, candidates (array of sources), restored, rationale.
    """
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error")).when(~F.coalesce("supported", F.lit(False)), "unsupported").when(F.col("candidate_source").isNull() | ~F.array_contains("candidates", F.col("candidate_source")), "unknown_candidate")
        .when(blank("restored"), "missing_name").when(blank("rationale"), "missing_rationale")
    )
    return replies.withColumns({"reason": F.coalesce(reason, F.lit("proposed")), "status": F.when(reason.isNull(), "proposed").otherwise("withheld"), "confirmed": F.lit(False)})
