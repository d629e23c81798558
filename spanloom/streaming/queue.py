"""A queue with attempts, backoff and dead letters as tables, and stages as micro-batches.

messages: id, topic, run_id, case_id, status (pending, processing, done, failed), attempts, available_at (seconds),
last_error. Each function gives the next state of the whole table; a stage of a stream writes its results under the
number of the micro-batch, so that a batch that runs again after a failure replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATUSES = ("pending", "processing", "done", "failed")
LEDGER = "run_id string, spent double, reserved double, accepted long, refused long"


def publish(messages: DataFrame, new: DataFrame) -> DataFrame:
    """new(id, topic, run_id, case_id) as pending messages, due at once."""
    fresh = new.select("id", "topic", "run_id", "case_id", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(0.0).alias("available_at"), F.lit(None).cast("string").alias("last_error"))
    return messages.unionByName(fresh)


def claim(messages: DataFrame, topic: str, now: float, n: int) -> DataFrame:
    """The n oldest due messages of a topic become processing, each with one more attempt."""
    due = messages.filter((F.col("topic") == topic) & (F.col("status") == "pending") & (F.col("available_at") <= now))
    taken = due.orderBy("id").limit(n).select("id", F.lit(True).alias("_taken"))  # n is the number of workers
    rows = messages.join(F.broadcast(taken), "id", "left")
    mine = F.col("_taken").isNotNull()
    return rows.withColumns({"status": F.when(mine, "processing").otherwise(F.col("status")), "attempts": F.col("attempts") + mine.cast("int")}).drop("_taken")


def settle(messages: DataFrame, outcomes: DataFrame, now: float, most: int, backoff: tuple[float, ...]) -> DataFrame:
    """outcomes(id, error, retry): without an error a message is done; else it is pending again after the backoff of its
    attempt while it may be retried and has attempts left, and failed otherwise. Errors keep 500 characters."""
    rows = messages.join(outcomes.select("id", F.lit(True).alias("_seen"), F.col("error").alias("_error"), F.col("retry").alias("_retry")), "id", "left")
    seen = F.col("_seen").isNotNull() & (F.col("status") == "processing")
    again = F.coalesce(F.col("_retry"), F.lit(True)) & (F.col("attempts") < most)
    wait = F.element_at(F.array(*map(F.lit, map(float, backoff))), F.greatest(F.lit(1), F.least(F.col("attempts"), F.lit(len(backoff)))))
    status = F.when(~seen, F.col("status")).when(F.col("_error").isNull(), "done").when(again, "pending").otherwise("failed")
    failed = seen & F.col("_error").isNotNull()
    return rows.withColumns({
        "status": status,
        "available_at": F.when(failed & again, F.lit(float(now)) + wait).otherwise(F.col("available_at")),
        "last_error": F.when(failed, F.substring("_error", 1, 500)).otherwise(F.col("last_error")),
    }).drop("_seen", "_error", "_retry")


def recover(messages: DataFrame, now: float) -> DataFrame:
    """What was processing when its worker went is pending again, due now."""
    lost = F.col("status") == "processing"
    return messages.withColumns({"available_at": F.when(lost, F.lit(float(now))).otherwise(F.col("available_at")), "status": F.when(lost, "pending").otherwise(F.col("status"))})


def counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic", "status").agg(F.count("*").alias("n"))


def open_cases(cases: DataFrame) -> DataFrame:
    """Per run its cases and those not decided yet; a run without any of these is done."""
    n = F.count_if(F.coalesce(F.col("stage") != "decided", F.lit(True)))
    return cases.groupBy("run_id").agg(F.count("*").alias("cases"), n.alias("open")).withColumn("done", F.col("open") == 0)


def produced(messages: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """(sent, skipped) of messages by the names of what they break; skipped keep these."""
    judged = messages.withColumn("errors", errors)
    return judged.filter(F.size("errors") == 0).drop("errors"), judged.filter(F.size("errors") > 0)


def run_stage(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Runs a stage over all there is of a stream; each micro-batch overwrites a folder of its own under path."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(events: DataFrame, cap: float) -> DataFrame:
    """A stream of events(run_id, kind, estimate, actual) as the state of each run's budget.

    reserve is accepted while spent, reserved and its estimate stay within cap; settle gives its estimate back and adds
    what was spent."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        spent, reserved, accepted, refused = state.get if state.exists else (0.0, 0.0, 0, 0)
        for batch in batches:
            for e in batch.sort_values("seq").itertuples():
                if e.kind == "reserve":
                    fits = spent + reserved + e.estimate <= cap
                    reserved, accepted, refused = reserved + e.estimate * fits, accepted + fits, refused + (not fits)
                else:
                    reserved, spent = max(0.0, reserved - e.estimate), spent + (e.actual or 0.0)
        state.update((spent, reserved, int(accepted), int(refused)))
        yield pd.DataFrame([(key[0], spent, reserved, accepted, refused)], columns=["run_id", "spent", "reserved", "accepted", "refused"])

    return events.groupBy("run_id").applyInPandasWithState(update, LEDGER, "spent double, reserved double, accepted long, refused long", "update", "NoTimeout")
