"""Landing of source data: registry (S2, S3, O1), positional entity rows (S4), staging
schema and length check (S5), null tokens (S6), delimited files (S7), schema
backfill (S11), projected extracts (S12), dimension upsert with key assignment
(S14, S15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnup.functions.expr import null_token
from burnup.operators.apply import one_row_per_key
from burnup.session import cut_lineage

FIELD_MAP_TYPE = "map<string,bigint>"
STAGING_LENGTH = 100


def entity_registry(registry: DataFrame) -> DataFrame:
    """S2 + O1: the registry in load order, the field map parsed from its JSON text."""
    fm = registry.schema["column_select_list"].dataType
    parsed = F.from_json("column_select_list", FIELD_MAP_TYPE) if isinstance(fm, T.StringType) \
        else F.col("column_select_list")
    return registry.select("entity_ppm_id", "entity_name", parsed.alias("field_map"), "load_sequence") \
        .orderBy("load_sequence")


def field_map_unpack(registry: DataFrame) -> DataFrame:
    """S3: one row per (entity, position, alias, field id). Aliases and ids come out of the
    same map entry, so their pairing holds whatever the key order of the JSON text."""
    r = entity_registry(registry)
    e = r.select("entity_ppm_id", "entity_name", "load_sequence",
                 F.posexplode(F.map_entries("field_map")).alias("position", "entry"))
    return e.select("entity_ppm_id", "entity_name", "load_sequence", "position",
                    F.col("entry.key").alias("alias"), F.col("entry.value").alias("field_id"))


def entity_fields(registry: DataFrame, entity_ppm_id: int) -> list[tuple[int, str, int]]:
    """The (position, alias, field id) list of one entity. A registry row holds a few
    dozen fields at most, so this small list is read to the driver to build the select."""
    rows = field_map_unpack(registry).where(F.col("entity_ppm_id") == entity_ppm_id) \
        .select("position", "alias", "field_id").orderBy("position").collect()
    return [(r["position"], r["alias"], r["field_id"]) for r in rows]


def land_entity(raw: DataFrame, aliases: Sequence[str], values_col: str = "methodValues") -> DataFrame:
    """S4 + S6: positional cell arrays -> one text column per alias; the first field of
    each cell struct is its value; 'None' and '' load as NULL."""
    cell_type = raw.schema[values_col].dataType.elementType
    first = cell_type.fields[0].name
    return raw.select(*[null_token(F.col(values_col)[i][first]).alias(a) for i, a in enumerate(aliases)])


def staging_schema(aliases: Sequence[str]) -> T.StructType:
    """Every staged column is text."""
    return T.StructType([T.StructField(a, T.StringType(), True) for a in aliases])


def over_length(df: DataFrame, limit: int = STAGING_LENGTH) -> DataFrame:
    """S5 check: rows with a text value longer than the staging width (a load error there)."""
    cond = F.lit(False)
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            cond = cond | F.coalesce(F.length(f.name) > limit, F.lit(False))
    return df.where(cond)


def null_tokens(df: DataFrame) -> DataFrame:
    """S6 over every text column."""
    return df.select(*[null_token(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name) for f in df.schema.fields])


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """S7 as a sink: delimited text with header, empty = NULL, backslash escape."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", "") \
        .option("emptyValue", "").option("escape", "\\").csv(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|") -> DataFrame:
    """S7 as a source: typed read, empty field = NULL, backslash escape, header skipped."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("nullValue", "") \
        .option("escape", "\\").option("mode", "FAILFAST").csv(path)


REJECTED = "_rejected"


def _escaped(c: str) -> Column:
    """Text on one line: backslashes doubled, line breaks as ``\\n`` and ``\\r``."""
    text = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(c: str) -> Column:
    between = F.split(F.col(c), r"\\\\")  # at doubled backslashes; single ones are part of an escape
    plain = F.transform(between, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


_STAGING = {"header": True, "nullValue": "", "escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def stage_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """S7 as a sink whose files can be split at any line: a record is a line, whatever its texts hold.

    Fields with the delimiter or a quote are quoted, quotes inside are doubled, backslashes and line breaks
    are escaped; empty text and NULL are both written as nothing.
    """
    out = df.select(*[_escaped(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])
    out.write.mode("append").options(**_STAGING).option("sep", sep).option("emptyValue", "").csv(path)


def read_staged(spark: SparkSession, path: str | list[str], schema: T.StructType | str, sep: str = "|") -> tuple[DataFrame, DataFrame]:
    """S7 as a source for files that may be wrong: (typed rows, rejected lines as one text column).

    A line with too few or too many fields, or with a field that isn't of its type, is rejected whole. The files
    are parsed once, to the shared folder when this is called; no line is in both results, and none is in neither.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.schema(T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])).options(**_STAGING).option("sep", sep) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).csv(path)
    lines = cut_lineage(lines, "staged")
    rows = lines.where(F.col(REJECTED).isNull()).select(
        *[_unescaped(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])
    return rows, lines.where(F.col(REJECTED).isNotNull()).select(REJECTED)


def schema_backfill(registry: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Registry rows without ``entity_schema`` get their field catalogue as JSON text
    (single quotes removed); other rows keep theirs."""
    cat_cols = [c for c in catalogue.columns if c != "entity_ppm_id"]
    cat = catalogue.groupBy("entity_ppm_id").agg(
        F.replace(F.to_json(F.array_sort(F.collect_list(F.struct(*cat_cols)))), F.lit("'"), F.lit(""))
        .alias("__schema"))
    j = registry.join(cat, "entity_ppm_id", "left")
    return j.select(*[F.coalesce(F.col("entity_schema"), F.col("__schema")).alias(c) if c == "entity_schema"
                      else F.col(c) for c in registry.columns])


def entity_extract(spark: SparkSession, path: str, fields: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """Landed entity JSON read with only the requested fields (pruned at the source)."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in fields])
    return spark.read.schema(schema).json(path)


def assign_keys(rows: DataFrame, order_col: str, start: Column | int, key_col: str) -> DataFrame:
    """Consecutive surrogate keys ``start + 1, start + 2, ...`` in ``order_col`` order,
    without a single-partition window.

    The rows are range partitioned on the order column, sorted, and written once with
    their partition and their index in it. Counts and offsets come from that written
    table, so both sides see the same partitions whatever a recomputation would have
    sampled. A window over one row per partition gives the offsets; a row's key is
    start + offset + index + 1.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    mono = F.monotonically_increasing_id()  # partition in the upper bits, index in the lower 33
    ranged = cut_lineage(rows.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
                         .withColumn("__mono", mono), "keys")
    ranged = ranged.select("*", F.shiftright("__mono", 33).alias("__pid"),
                           F.col("__mono").bitwiseAND(F.lit((1 << 33) - 1)).alias("__index")).drop("__mono")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    key = start + F.col("__off") + F.col("__index") + 1  # one offset row per partition: a small side
    return ranged.join(offsets, "__pid").withColumn(key_col, key.cast("bigint")).drop("__pid", "__index", "__off")


def dimension_upsert(target: DataFrame, staged: DataFrame, natural_key: str, surrogate_key: str,
                     keep_if_null: Sequence[str] = (), keep_always: Sequence[str] = ()) -> DataFrame:
    """S14 [INFERRED contract]: upsert staged rows into a dimension by natural key.

    Matched rows take the staged values, except ``keep_always`` columns (maintained by
    hand) and ``keep_if_null`` columns where the staged value is NULL; the surrogate
    key is kept. Unmatched target rows stay. New staged rows get the next surrogate
    keys in natural-key order. Of several staged rows of one key the smallest (by all
    its columns) counts. A NULL key equals none, as in SQL: such target rows stay as
    they are and such staged rows are new.
    """
    cols = target.columns
    rest = [c for c in staged.columns if c != natural_key]
    keyed = one_row_per_key(staged.where(F.col(natural_key).isNotNull()), natural_key, rest or [natural_key])
    s = keyed.unionByName(staged.where(F.col(natural_key).isNull())) \
        .select(*[F.col(c).alias(f"s__{c}") for c in staged.columns], F.lit(True).alias("__staged"))
    t = target.withColumn("__target", F.lit(True))
    # Joined once and written: old and new rows are both read from it.
    j = cut_lineage(t.join(s, t[natural_key] == s[f"s__{natural_key}"], "full_outer"), "upsert")
    matched = F.col("__target").isNotNull() & F.col("__staged").isNotNull()

    def merged(c):
        if c == surrogate_key or c not in staged.columns or c in keep_always:
            return F.col(c)
        if c in keep_if_null:
            return F.when(matched, F.coalesce(F.col(f"s__{c}"), F.col(c))).otherwise(F.col(c))
        return F.when(matched, F.col(f"s__{c}")).otherwise(F.col(c))

    old = j.where(F.col("__target").isNotNull()).select(*[merged(c).alias(c) for c in cols])
    new = j.where(F.col("__target").isNull()).select(
        *[F.col(f"s__{c}").alias(c) if c in staged.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
          for c in cols])
    max_key = target.select(F.coalesce(F.max(surrogate_key), F.lit(0))).scalar()
    new = assign_keys(new.drop(surrogate_key), natural_key, max_key, surrogate_key)
    return old.unionByName(new.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols]))


def load_dimensions(registry: DataFrame, raw: dict[str, DataFrame],
                    upserts: dict[str, "callable"]) -> dict[str, DataFrame]:
    """Every registry entity in load order that has landed rows is unpacked with the
    registry's aliases (S3, S4, S6) and handed, as a text staging table (S5), to that
    entity's upsert (S14). The registry (a handful of rows) is read once; the loop never
    sees data. The result's order is the load order (O1)."""
    out: dict[str, DataFrame] = {}
    aliases: dict[str, list[str]] = {}
    rows = field_map_unpack(registry).orderBy("load_sequence", "entity_ppm_id", "position") \
        .select("entity_name", "alias").collect()
    for r in rows:
        aliases.setdefault(r["entity_name"], []).append(r["alias"])
    for name, fields in aliases.items():
        if name in raw:
            staged = null_tokens(land_entity(raw[name], fields))
            out[name] = upserts[name](staged) if name in upserts else staged
    return out
