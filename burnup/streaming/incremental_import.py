"""C7 run incrementally: landed timesheet files -> entry store, one micro-batch at a time.

The reference pulls timesheets on a schedule from a per-user high-water mark and
re-imports whole timesheets (U21). Here new landed files are picked up by a file
stream with ``trigger(availableNow=True)``, and ``foreachBatch`` applies:

1. N2 flatten;
2. U21 versioned replace;
3. U10-U15 key resolution.

Cost per batch follows the batch, not the store. The store keeps a directory per
entry month; a batch reads and rewrites only the months it touches (months of its own entries
and of the stored rows of its timesheets; entries without a date have a month of their
own) and switches to them in one step. The store's locator, a lookup by timesheet, names
those months; no other month's entries are opened. A retried epoch finds the months of its first
attempt in the manifest.

Exactly once: appended rows carry (``import_stream``, ``import_epoch``) and rows the
batch switched off (``deactivated_stream``, ``deactivated_epoch``), so a retried epoch
first undoes its earlier attempt. The stream's identity is the one Spark keeps with its
progress; a stream with a new progress folder is another stream and undoes nothing.
Progress lives in the shared folder named by ``spark.checkpoint.dir``.

Key resolution runs on the touched months only. Keys missing in other months (for
example a dimension row that arrived late) are filled by ``resolve_missing_keys``,
which rewrites only the months that still hold a row with a missing key.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from burnup.operators.entries import resolve_entry_dims, versioned_replace
from burnup.operators.nesting import flatten_all_entries
from burnup.session import scratch_path
from burnup.sources.sinks import (ENTRY_MONTH, entry_month, located_months, marked_months, read_entry_store, replace_months, store_version,
                                  write_entry_store)

BOOKKEEPING = {"import_stream": "string", "import_epoch": "bigint", "deactivated_stream": "string",
               "deactivated_epoch": "bigint"}


def init_store(entries: DataFrame, path: str) -> None:
    """Write the first version of the store, with empty bookkeeping columns."""
    write_entry_store(entries.select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in BOOKKEEPING.items()]), path)


def _months(df: DataFrame) -> list[str]:
    return [r[0] for r in df.select(ENTRY_MONTH).distinct().collect()]


def apply_batch(store_path: str, dims: dict[str, DataFrame], as_of, stream_id: Callable[[], str]):
    """foreachBatch body for micro-batch ``epoch_id`` of landed timesheets of one stream."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id()
        flat = flatten_all_entries(batch)
        ts = flat.select("timesheetid").distinct()

        def here(what: str):
            return F.coalesce((F.col(f"{what}_stream") == stream) & (F.col(f"{what}_epoch") == epoch_id), F.lit(False))

        months = sorted({*located_months(spark, store_path, ts), *marked_months(spark, store_path, stream, epoch_id),
                         *_months(flat.select(entry_month().alias(ENTRY_MONTH)))})
        current = read_entry_store(spark, store_path, months=months).drop(ENTRY_MONTH)
        # Undo an earlier attempt of this epoch: drop its rows, re-activate what it switched off.
        undo = here("deactivated")
        current = current.where(~here("import")).withColumns({
            "is_active": F.when(undo, F.lit(True)).otherwise(F.col("is_active")),
            "deactivated_stream": F.when(~undo, F.col("deactivated_stream")),
            "deactivated_epoch": F.when(~undo, F.col("deactivated_epoch"))})
        new = versioned_replace(current, flat, as_of, mark=(stream, epoch_id))
        new = resolve_entry_dims(new, dims["resources"], dims["members"], dims["projects"], dims["tasks"],
                                 dims["portfolios"], dims["dates"], as_of)
        replace_months(new, store_path, months, ts, (stream, epoch_id))
    return run


def progress_id(spark: SparkSession, checkpoint: str) -> Callable[[], str]:
    """The identity Spark wrote to a stream's progress folder when it first started."""
    return lambda: json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_import_stream(spark: SparkSession, landed_dir: str, landed_schema: StructType, store_path: str,
                        dims: dict[str, DataFrame], as_of, initial_store: DataFrame | None = None,
                        checkpoint_location: str | None = None):
    """Start the incremental import; returns the StreamingQuery (call awaitTermination).
    ``initial_store`` seeds the store when ``store_path`` holds none yet."""
    if not store_version(spark, store_path):
        if initial_store is None:
            raise FileNotFoundError(f"no entry store at {store_path}")
        init_store(initial_store, store_path)
    checkpoint = checkpoint_location or scratch_path(spark, "import-stream")
    stream = spark.readStream.schema(landed_schema).parquet(landed_dir)
    return (stream.writeStream
            .trigger(availableNow=True)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(apply_batch(store_path, dims, as_of, progress_id(spark, checkpoint)))
            .start())


def missing_key(entries_type_col: str = "entrytypeid"):
    """True for a row whose dimension keys U10-U15 could still fill (their guards)."""
    t = F.col(entries_type_col)
    c = F.col
    return (c("resource_dim_id").isNull() | c("team_dim_id").isNull() | c("date_dim_id").isNull()
            | ((t == 1) & (c("project_dim_id").isNull() | c("portfolio_dim_id").isNull() | c("task_dim_id").isNull()))
            | ((t == 99) & c("portfolio_dim_id").isNull()))


def resolve_missing_keys(spark: SparkSession, store_path: str, dims: dict[str, DataFrame], as_of) -> None:
    """U10-U15 over the whole store, rewriting only the months that still hold a row with
    a missing key. Resolution only ever fills NULL keys, so the other months cannot
    change: the result equals a full-table pass."""
    months = _months(read_entry_store(spark, store_path).where(missing_key()))
    if not months:
        return
    current = read_entry_store(spark, store_path, months=months).drop(ENTRY_MONTH)
    new = resolve_entry_dims(current, dims["resources"], dims["members"], dims["projects"], dims["tasks"],
                             dims["portfolios"], dims["dates"], as_of)
    replace_months(new, store_path, months)
