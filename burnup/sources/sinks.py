"""Sinks: table versions and the entry store by month.

Every operator returns a new version of its target table; these helpers write it.
The entry store keeps each month of entries in a directory of its own and a manifest
that names the directories in force. A change writes the months it touches to new
directories and then one new manifest version, which is the switch: readers see all
of a change or nothing, and a change that breaks off leaves the store as it was.

Beside the months the manifest names the locator: which months hold a timesheet, a
directory per range of timesheet ids. A change that names its timesheets looks up and rewrites
only their ranges, so finding a batch's months doesn't read the entries. It also keeps
the months that each writer's last change touched, for a writer that has to undo it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY_MONTH = "entry_month"
#: The month of entries without a date.
NO_MONTH = "none"
#: Timesheet ids to a directory of the locator. Ids are given in order of time, so a batch has few ranges.
LOCATOR_IDS = 1 << 16


def entry_month(date_col: str = "entrydate") -> Column:
    return F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit(NO_MONTH))


def write_version(df: DataFrame, base: str, version: int, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as ``<base>/version=<n>``; rewriting the same version replaces it."""
    path = f"{base.rstrip('/')}/version={version}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names below ``path`` in whatever file system it is on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def store_version(spark: SparkSession, path: str) -> int:
    """The version in force: the highest whose manifest is complete; 0 when there is no store."""
    done = [int(n[2:]) for n in _children(spark, f"{path}/manifest") if n.startswith("v=")
            and "_SUCCESS" in _children(spark, f"{path}/manifest/{n}")]
    return max(done, default=0)


def _manifest(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Kind (month, locator, mark) -> key -> value of the version in force (one row per month, range and marked month)."""
    v = store_version(spark, path)
    out: dict[str, dict[str, str]] = {"month": {}, "locator": {}, "mark": {}}
    if v:
        for r in spark.read.parquet(f"{path}/manifest/v={v}").collect():
            out[r["kind"]][r["key"]] = r["value"]
    return out


def month_dirs(spark: SparkSession, path: str) -> dict[str, str]:
    """Month -> directory of the version in force."""
    if not store_version(spark, path):
        raise FileNotFoundError(f"no entry store at {path}")
    return _manifest(spark, path)["month"]


def _id_range() -> Column:
    return F.expr(f"timesheetid div {LOCATOR_IDS}").cast("string")


def _written(spark: SparkSession, data: str, column: str) -> dict[str, str]:
    return {n.partition("=")[2]: f"{data}/{n}" for n in _children(spark, data) if n.startswith(f"{column}=")}


def _locate(spark: SparkSession, path: str, old: dict[str, str], rows: DataFrame, timesheets: DataFrame | None) -> dict[str, str]:
    """The locator with the (timesheetid, month) pairs of ``rows``; of the given timesheets, or made anew from all rows."""
    pairs = rows.where("timesheetid IS NOT NULL").select("timesheetid", ENTRY_MONTH)
    if timesheets is not None:
        pairs = pairs.join(timesheets.select("timesheetid").distinct(), "timesheetid", "left_semi")
        touched = [r[0] for r in pairs.select(_id_range()).distinct().collect()]
        if held := [old[x] for x in touched if x in old]:
            pairs = pairs.unionByName(spark.read.parquet(*held).select("timesheetid", ENTRY_MONTH))
    data = f"{path}/locator/{uuid.uuid4().hex}"
    pairs.distinct().withColumn("__r", _id_range()).repartition("__r").write.partitionBy("__r").parquet(data)
    new = _written(spark, data, "__r")
    return new if timesheets is None else old | new


def located_months(spark: SparkSession, path: str, timesheets: DataFrame) -> list[str]:
    """The months that may hold entries of the given timesheets. Only their ranges of the locator are read."""
    locator = _manifest(spark, path)["locator"]
    ids = timesheets.select("timesheetid").where("timesheetid IS NOT NULL").distinct()
    dirs = [locator[r[0]] for r in ids.select(_id_range()).distinct().collect() if r[0] in locator]
    return [r[0] for r in spark.read.parquet(*dirs).join(ids, "timesheetid", "left_semi").select(ENTRY_MONTH).distinct().collect()] if dirs else []


def marked_months(spark: SparkSession, path: str, writer: str, epoch: int) -> list[str]:
    """The months that this change of this writer touched, if it is the writer's last one."""
    head = f"{writer}/{epoch}/"
    return [m for k, m in _manifest(spark, path)["mark"].items() if k.startswith(head)]


def replace_months(entries: DataFrame, path: str, months: list[str] | None = None, timesheets: DataFrame | None = None,
                   mark: tuple[str, int] | None = None) -> None:
    """Make ``entries`` the content of ``months`` (None: of the whole store) and switch to it.

    ``timesheets``: those whose entries may have come to a month; None where no timesheet's
    months change. ``mark``: the writer and its number of this change.
    """
    spark = entries.sparkSession
    v, old = store_version(spark, path), _manifest(spark, path)
    keep = {} if months is None else {m: x for m, x in old["month"].items() if m not in set(months)}
    data = f"{path}/months/{uuid.uuid4().hex}"
    dated = entries.withColumn(ENTRY_MONTH, entry_month())
    dated.withColumn("__m", F.col(ENTRY_MONTH)).write.partitionBy("__m").parquet(data)
    new = _written(spark, data, "__m")
    if not keep and not new:  # an empty store still has a schema
        dated.write.parquet(f"{data}/__m={NO_MONTH}")
        new = {NO_MONTH: f"{data}/__m={NO_MONTH}"}
    locator = old["locator"]
    if months is None or timesheets is not None:
        locator = _locate(spark, path, locator, spark.read.schema(dated.schema).parquet(*new.values()) if new else dated.limit(0), None if months is None else timesheets)
    marks = old["mark"]
    if mark is not None:
        marks = {k: m for k, m in marks.items() if not k.startswith(f"{mark[0]}/")} | {f"{mark[0]}/{mark[1]}/{m}": m for m in months or new}
    rows = [(kind, k, x) for kind, part in (("month", keep | new), ("locator", locator), ("mark", marks)) for k, x in sorted(part.items())]
    spark.createDataFrame(rows, "kind string, key string, value string").coalesce(1).write.parquet(f"{path}/manifest/v={v + 1}")


def write_entry_store(entries: DataFrame, path: str) -> None:
    """The timesheet entry store, a directory per month of the entry date."""
    replace_months(entries, path)


def read_entry_store(spark: SparkSession, path: str, date_from=None, date_to=None,
                     months: list[str] | None = None) -> DataFrame:
    """The version in force. A date range or a list of months reads only their directories."""
    dirs = month_dirs(spark, path)
    first, last = str(date_from or "")[:7], str(date_to or "~")[:7]
    ranged = date_from is not None or date_to is not None
    wanted = [x for m, x in dirs.items() if (months is None or m in months)
              and (not ranged or (m != NO_MONTH and first <= m <= last))]
    some = next(iter(dirs.values()))
    df = spark.read.parquet(*wanted) if wanted else spark.read.parquet(some).limit(0)
    if date_from is not None:
        df = df.where(F.col("entrydate") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.where(F.col("entrydate") <= F.lit(date_to).cast("date"))
    return df
