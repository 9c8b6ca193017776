"""Order within lanes, and read models over logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.sources.logs import prefix_scan, start_at


def ordered_lanes(df: DataFrame, lane: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows dealt by lane, each lane in order in one task, lanes in parallel: the shape that a per-lane
    handler (mapInPandas, foreachPartition) needs. Rows without a lane keep no order."""
    dealt = df.repartition(partitions, lane) if partitions else df.repartition(lane)
    return dealt.sortWithinPartitions(lane, *order)


def order_violations(df: DataFrame, key: str = "key", processed: str = "processed_at") -> DataFrame:
    """Batch: (key, violations): rows of a key that were processed before the row in front of them in its
    partition's offset order; keys without any are left out. A row without a moment is in front of
    none: the next is held against the last one that has it. A hot key is spread over all tasks."""
    seen = prefix_scan(df.select(key, "topic", "partition", "offset", processed), [key, "topic", "partition"], ["offset"], {"_before": ("last", F.col(processed))}, before=True)
    return seen.where(F.col(processed) < F.col("_before")).groupBy(key).agg(F.count("*").alias("violations"))


def project_balances(df: DataFrame, account: str = "account", amount: str = "amount") -> DataFrame:
    """(account, balance): works on a stream in update mode too."""
    return df.groupBy(account).agg(F.sum(amount).alias("balance"))


def rebuild_on_revision(df: DataFrame, account: str = "account", amount: str = "amount") -> DataFrame:
    """(account, balance, revision): whenever a newer revision comes the model starts over from the log's
    start; at the end every retained posting counts once, under the highest revision of all."""
    top = df.agg(F.max("revision").alias("revision"))
    return project_balances(df, account, amount).join(F.broadcast(top))


def needs_rebuild(model_revision: int | None, batch: DataFrame) -> bool:
    """Whether a batch brings a newer revision than the model has: the gate of a streaming rebuild."""
    newest = batch.agg(F.max("revision")).first()[0]
    return newest is not None and (model_revision is None or newest > model_revision)


def running_ledger(df: DataFrame, account: str, amount: str, order: list[str]) -> DataFrame:
    """Batch: adds balance: the account's running sum after every entry, in order (a total order). An account
    of any share of the rows is spread over all tasks."""
    return prefix_scan(df, [account], order, {"balance": ("sum", F.col(amount))})


def enrich_totals(lines: DataFrame, order: str, quantity: str) -> DataFrame:
    """(order, lines, units) from line rows."""
    return lines.groupBy(order).agg(F.count("*").alias("lines"), F.sum(quantity).alias("units"))


def enrich_totals_nested(orders: DataFrame, items: str, quantity: str) -> DataFrame:
    """The same where an order holds its items in an array."""
    q = F.transform(F.col(items), lambda i: F.coalesce(i[quantity], F.lit(0)).cast("double"))
    return orders.withColumns({"lines": F.size(items).cast("bigint"), "units": F.aggregate(q, F.lit(0.0), lambda a, x: a + x)})


def count_views(df: DataFrame, page: str) -> DataFrame:
    return df.groupBy(page).agg(F.count("*").alias("views"))


def reconcile(df: DataFrame, batch: str, amount: str) -> DataFrame:
    """(batch, acked, dropped, total): a line of amount zero (or none) is dropped, the others acked."""
    zero = F.coalesce(F.col(amount) == 0, F.lit(True))
    return df.groupBy(batch).agg(F.count_if(~zero).alias("acked"), F.count_if(zero).alias("dropped"), F.sum(F.when(~zero, F.col(amount))).alias("total"))


def replay_since(log: DataFrame, since, key: str, amount: str) -> DataFrame:
    """(key, n, total) recomputed from a moment on: every partition is read from its first record at or
    after it."""
    return start_at(log, "timestamp", since).groupBy(key).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
