"""Reports over appended batches, refreshed from stored partial aggregates.

Each batch of orders is reduced once to the aggregates that the reports start
from: revenue by month, and orders and purchase days by customer. They are
written under ``<root>/state/<name>/batch=<n>`` and a line in
``<root>/state/batches`` publishes them, after all are written. A refreshed
report merges the published aggregates (sums, minima, maxima) and goes on as the
full report does. A refresh never reads a batch's rows again.

A batch brings whole orders, with their items; an order comes in one batch. A
batch that is added again replaces itself, and one that failed half way is not
seen. ``compact`` merges old states into one, so a refresh reads as many rows as
there are months and customers, not as many as batches times these.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import customers as C
from . import revenue as R
from .pipeline import path_exists

BATCHES = "batch int, upto int"  # a compacted state stands for all batches up to ``upto``


@dataclass(frozen=True)
class State:
    """An aggregate that merges: keys, and how each value of two parts combines."""

    name: str
    of: Callable[[DataFrame, DataFrame], DataFrame]
    keys: tuple[str, ...]
    merge: dict[str, Callable[[str], Column]]

    def merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(*[how(c).alias(c) for c, how in self.merge.items()])


MONTHS = State("months", R.monthly_revenue, ("order_year", "order_month", "month_label"),
               {"rev_cents": F.sum})


def _per_customer(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    day = F.col("order_purchase_timestamp").cast("date")
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n_orders"), F.min(day).alias("first_d"),
        F.max(day).alias("last_d"))


CUSTOMERS = State("customers", _per_customer, ("customer_id",),
                  {"n_orders": F.sum, "first_d": F.min, "last_d": F.max})

STATES = (MONTHS, CUSTOMERS)


class ReportStates:
    """The stored aggregates below ``root``; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/state"

    def _folder(self, state: State, batch: int | None = None) -> str:
        base = f"{self.root}/{state.name}"
        return base if batch is None else f"{base}/batch={batch}"

    def published(self) -> list[int]:
        """The states to merge: the newest compacted one and the batches after it
        (one number each)."""
        path = f"{self.root}/batches"
        if not path_exists(self.spark, path):
            return []
        lines = self.spark.read.schema(BATCHES).parquet(path).distinct().collect()
        upto = max((r["upto"] for r in lines if r["upto"] is not None), default=None)
        whole = {r["batch"] for r in lines if upto is not None and r["upto"] == upto}
        return sorted(whole | {r["batch"] for r in lines if r["upto"] is None
                               and (upto is None or r["batch"] > upto)})

    def _publish(self, batch: int, upto: int | None) -> None:
        self.spark.createDataFrame([(batch, upto)], BATCHES).coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/batches")

    def add(self, batch: int, orders: DataFrame, order_items: DataFrame) -> None:
        """Store the aggregates of a batch. Numbers start at 1 and grow."""
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        done = self.published()
        if done and done[0] < 0 and batch <= -done[0]:
            raise ValueError(f"batch {batch} is part of a compacted state")
        for state in STATES:
            state.of(orders, order_items).write.mode("overwrite") \
                .parquet(self._folder(state, batch))
        self._publish(batch, None)

    def compact(self) -> None:
        """Merge all published states into one, kept under the negative number of
        the last batch in it."""
        done = self.published()
        last = max((abs(b) for b in done), default=0)
        if len(done) > 1:
            for state in STATES:
                self.read(state).write.mode("overwrite").parquet(self._folder(state, -last))
            self._publish(-last, last)

    def read(self, state: State) -> DataFrame:
        """The aggregate over all published batches."""
        done = self.published()
        if not done:
            raise FileNotFoundError(f"no published state under {self.root}")
        return state.merged(self.spark.read.parquet(*[self._folder(state, b) for b in done]))

    # ------------------------------------------------------------- reports ----
    def monthly_revenue_trend(self) -> DataFrame:
        return R.revenue_trend(self.read(MONTHS))

    def repeat_rate(self, customers: DataFrame, **args) -> DataFrame:
        return C.repeat_rate_of(self.read(CUSTOMERS), customers, **args)

    def churn(self, customers: DataFrame, **args) -> DataFrame:
        return C.churn_of(self.read(CUSTOMERS), customers, **args)
