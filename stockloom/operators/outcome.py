"""What a batch of requests returns: decisions and the rows it adds or changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.schema import LEDGER_COLUMNS


class Outcome:
    """decisions: the requests with ``accepted`` and, where rejected, ``reason``.
    ledger: audit rows. changes: further frames by name (deltas, updates, new rows).

    Ledger and changes are worked out when first asked for; ``plain`` are changes that follow
    from the decisions alone and need none of the rest.
    """

    def __init__(
        self,
        decisions: DataFrame,
        effects: Callable[[], tuple[DataFrame, dict[str, DataFrame]]],
        plain: dict[str, DataFrame] | None = None,
    ):
        self.decisions = decisions
        self._effects = effects
        self._plain = plain or {}

    @cached_property
    def _built(self) -> tuple[DataFrame, dict[str, DataFrame]]:
        return self._effects()

    @property
    def ledger(self) -> DataFrame:
        return self._built[0]

    @property
    def changes(self) -> Mapping[str, DataFrame]:
        return Changes(self._plain, lambda: self._built[1])


class Changes(Mapping):
    """Frames by name, of which those not ``plain`` are built when one of them is asked for."""

    def __init__(self, plain: dict[str, DataFrame], built: Callable[[], dict[str, DataFrame]]):
        self._plain, self._built = plain, built

    def __getitem__(self, name: str) -> DataFrame:
        return self._plain[name] if name in self._plain else self._built()[name]

    def __contains__(self, name: object) -> bool:
        return name in self._plain or name in self._built()

    def __iter__(self) -> Iterator[str]:
        return iter({**self._plain, **self._built()})

    def __len__(self) -> int:
        return len({**self._plain, **self._built()})


@dataclass
class Event:
    """One kind of audit row; a row is written where ``when`` holds. The rest is NULL."""

    kind: str
    when: Column | None = None
    location: Column | None = None
    employee: Column | None = None
    reference: Column | None = None
    notes: str | Column | None = None


def ledger_events(rows: DataFrame, events: list[Event], quantity: str = "quantity") -> DataFrame:
    """Audit rows of several kinds from one pass over ``rows``, with one schema for all."""

    def text(value: str | Column | None) -> Column:
        return (F.lit(value) if value is None or isinstance(value, str) else value).cast("string")

    def number(value: Column | None) -> Column:
        return (F.lit(None) if value is None else value).cast("bigint")

    candidates = []
    for event in events:
        row = F.struct(
            F.lit(event.kind).alias("transaction_type"),
            F.col("product_id").cast("bigint").alias("product_id"),
            number(event.location).alias("location_id"),
            F.col(quantity).cast("bigint").alias("quantity"),
            number(event.employee).alias("employee_id"),
            text(event.reference).alias("reference_id"),
            text(event.notes).alias("notes"),
        )
        candidates.append(row if event.when is None else F.when(event.when, row))
    if len(candidates) == 1 and events[0].when is None:
        return rows.select(candidates[0].alias("e")).select(*[f"e.{c}" for c in LEDGER_COLUMNS])
    written = F.explode(F.array_compact(F.array(*candidates)))
    return rows.select(written.alias("e")).select(*[f"e.{c}" for c in LEDGER_COLUMNS])


def ledger_rows(rows: DataFrame, kind: str, quantity: str = "quantity", **values) -> DataFrame:
    """One audit row per row."""
    return ledger_events(rows, [Event(kind, **values)], quantity)


def first_per_order(requests: DataFrame) -> DataFrame:
    """(order_id, seq) of the first request of each order.

    A status change lets only one request per order pass; the minimum is combined inside
    the map tasks, so many requests for one order do not meet in one task.
    """
    return requests.groupBy("order_id").agg(F.min("seq").alias("seq"))
