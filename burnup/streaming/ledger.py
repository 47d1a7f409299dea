"""L1 as a running fold: run events -> ledger, whatever their order and however late they come.

The two folds of the ledger (sub tasks, main tasks) are streaming aggregations, and their state is Spark's. No aggregate
depends on the order of events, so late starts, repeated ends and errors that arrive after an end give the
same row as the batch fold over all events. Every micro-batch writes the rows it changed to a folder of its own number:
a batch that is run again writes the same folder anew, and the ledger is the newest row of each key.

State has a row for each task that ever ran: an end may always be written again, so none can be dropped by age.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from burnup.operators.quality import join_ledger, main_task_fold, sub_task_fold

FOLDS: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str]]] = {
    "sub": (sub_task_fold, ["task_id", "main_task_id"]), "main": (main_task_fold, ["main_task_id"])}


def _write(path: str):
    def run(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return run


def start_ledger_stream(spark: SparkSession, events_dir: str, schema: StructType, base: str, files_per_batch: int | None = None) -> list[StreamingQuery]:
    """Fold the event files that landed since the last run; the ledger and the streams' progress are below ``base``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return [fold(reader.parquet(events_dir)).writeStream.outputMode("update").option("checkpointLocation", f"{base}/progress-{name}")
            .foreachBatch(_write(f"{base}/{name}")).trigger(availableNow=True).start() for name, (fold, _) in FOLDS.items()]


def read_ledger(spark: SparkSession, base: str) -> DataFrame:
    """The ledger as of the last batch: the newest row of each task."""
    newest = []
    for name, (_, keys) in FOLDS.items():
        rows = spark.read.parquet(f"{base}/{name}")
        values = [c for c in rows.columns if c not in (*keys, "epoch")]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("__row"))
        newest.append(last.select(*keys, "__row.*"))
    return join_ledger(*newest)
