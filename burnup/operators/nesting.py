"""Nested data: explode / flatten / nest (N1, N2, N4, N5, A11) and bounded id lists.

Lists of ids (``string_agg`` in the warehouse) come in two forms: cut into batches of
ids that share ``id div batch_size``, so one list holds at most ``batch_size`` distinct
ids, or (``batch_size=None``) whole, one row per group as the warehouse has it, for
groups known to be small. Payloads are cut by a key of their records (the entry date).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_BATCH = 1000


def id_batch(c, batch_size: int = ID_BATCH) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(batch_size)).cast("bigint")


def bounded_listagg(df: DataFrame, group_cols: Sequence[str], id_col: str, list_col: str,
                    sep: str = ", ", batch_size: int | None = ID_BATCH, batch_col: str = "batch",
                    extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """``string_agg(id::text, ', ')`` per group, ordered by id, in batches of ids.

    Duplicates are kept (string_agg keeps them). Output: group columns, ``batch_col``
    (= id div batch_size), ``list_col`` and any ``extra_aggs``. With ``batch_size=None``
    there is one row per group and no ``batch_col``; without groups that row comes also
    for no ids, with a NULL list.
    """
    ids = F.array_sort(F.collect_list(F.col(id_col)))
    text = F.nullif(F.array_join(F.transform(ids, lambda x: x.cast("string")), sep), F.lit("")).alias(list_col)
    if batch_size is None:
        return df.groupBy(*group_cols).agg(text, *extra_aggs)
    # Shuffle on (group, batch) explicitly: input already partitioned on the group alone
    # would otherwise satisfy the aggregation and keep a hot group in one task.
    b = df.withColumn(batch_col, id_batch(id_col, batch_size)).repartition(*group_cols, batch_col)
    return b.groupBy(*group_cols, batch_col).agg(text, *extra_aggs)


# One row per project entry; a timesheet without entries keeps one NULL row.
def explode_project_entries(timesheets: DataFrame) -> DataFrame:
    e = timesheets.select("timesheetId", "userId", "startDate", "endDate",
                          F.explode_outer("entriesProject").alias("e"))
    return e.select("timesheetId", "userId", "startDate", "endDate",
                    F.col("e.entryId").alias("entryId"), F.col("e.entryDate").alias("entryDate"),
                    F.col("e.entryHours").alias("entryHours"),
                    F.col("e.level1Id").alias("project_ppm_id"), F.col("e.level2Id").alias("task_ppm_id"))


# Entry rows of the project array without header columns (draft variant of N1).
def draft_entry_rows(timesheets: DataFrame) -> DataFrame:
    return timesheets.select("timesheetId", F.explode("entriesProject").alias("e")).select(
        F.col("e.entryId").alias("entryId"), "timesheetId",
        F.col("e.entryDate").alias("entryDate"), F.col("e.entryHours").alias("entryHours"))


ENTRY_ARRAYS = ("entriesProject", "entriesOther", "entriesAccount", "entriesPortfolio")
IMPORT_COLUMNS = ("timesheetId", "companyId", "entryDate", "entryHours", "entryId", "entryTypeId",
                  "externalId", "internalRate", "billableRate", "isBillable", "isProductive",
                  "level1Id", "level2Id", "level3Id", "locationId", "notes", "state", "userId")


def flatten_all_entries(timesheets: DataFrame) -> DataFrame:
    """N2 + F9: the four entry arrays as one flat 18-column table (staging names in lower
    case); a timesheet without entries gives no row; a NULL array counts as empty;
    isBillable / isProductive NULL become false."""
    empty = F.array().cast(timesheets.schema["entriesProject"].dataType)
    allents = F.concat(*[F.coalesce(F.col(a), empty) for a in ENTRY_ARRAYS])
    e = timesheets.select("timesheetId", "userId", F.explode(allents).alias("e"))
    cols = []
    for c in IMPORT_COLUMNS:
        if c in ("timesheetId", "userId"):
            v = F.col(c)
        else:
            v = F.col(f"e.{c}")
        if c in ("isBillable", "isProductive"):
            v = F.coalesce(v, F.lit(False))
        cols.append(v.alias(c.lower()))
    return e.select(*cols)


# Records of a (timesheet, user) as payload lists.
PAYLOAD_FIELDS = ("companyId", "entryTypeId", "timesheetId", "level1Id", "level2Id", "entryDate",
                  "entryId", "level3Id", "entryHours")
#: The record field that cuts a payload into chunks: what is pushed, answered and retried as one.
CHUNK_FIELD = "entryDate"


def timesheet_payload(rows: DataFrame, keys: Sequence[str] = ("timesheetId", "userId"),
                      fields: Sequence[str] = PAYLOAD_FIELDS, chunk: str | None = CHUNK_FIELD) -> DataFrame:
    """Group rows per (timesheetId, userId, chunk) into ``entriesProject`` (userId dropped from
    the records, sorted for a stable payload). ``chunk`` names the record field whose value is
    the chunk, whatever the sizes; ``None`` gives one list per (timesheetId, userId)."""
    rec = F.struct(*[F.col(f) for f in fields])
    part = F.col(chunk).cast("string") if chunk else F.lit(None).cast("string")
    cut = rows.withColumn("chunk", part)
    # Rows may come partitioned on the keys alone, which would satisfy the aggregation and
    # keep a hot group's chunks in one task: shuffle on (keys, chunk).
    cut = cut.repartition(*keys, "chunk")
    return cut.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(rec)).alias("entriesProject"))


def payload_json(payload: DataFrame) -> DataFrame:
    """The payload as JSON text; an empty record list emits nothing."""
    p = payload.where(F.size("entriesProject") > 0)
    return p.select("timesheetId", "userId", "chunk",
                    F.to_json(F.struct("timesheetId", "userId", "entriesProject")).alias("payload"))


# Result columns in lower case -> the names the timesheet service expects (fixed values).
SERVICE_NAMES = {"companyid": "companyId", "entrytypeid": "entryTypeId", "timesheetid": "timesheetId",
                 "userid": "userId", "level1id": "level1Id", "level2id": "level2Id", "entrydate": "entryDate",
                 "entryid": "entryId", "level3id": "level3Id", "entryhours": "entryHours"}


def to_service_names(df: DataFrame) -> DataFrame:
    """Rename the lower-case columns present in ``df`` to the service's names."""
    return df.withColumnsRenamed({c: SERVICE_NAMES[c] for c in df.columns if c in SERVICE_NAMES})
