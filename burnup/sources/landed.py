"""Landed entity files as a Spark data source (S12): positional cells in, the registry's named fields out.

The service answers with JSON lines of one array of value cells each, in the order of the registry's
fields; a cell's place is its only name. ``spark.read.format("landed_entity")`` reads such a folder with the fields
asked for and no others::

    spark.dataSource.register(LandedEntity)
    spark.read.format("landed_entity").schema("id STRING, status STRING") \\
        .option("fields", "id,ahaid,title,status").load("/landed/project")

Each file is one or more partitions of ``split_bytes``, cut at line ends. A partition's cells are parsed by Arrow in blocks and only the wanted
places are taken; filters on them (equality, IN, null tests, comparisons of texts) are applied before rows go to Spark, which applies
them again. All fields are text: null tokens and types are the next steps (S5, S6).

Defined cases: a line with fewer cells than fields has nulls for the rest, more cells are not read; a null cell and a null row are
nulls; a file or folder without lines gives no rows; a field that the registry doesn't have, or a line that isn't JSON, raises. Paths are those
Arrow reads: shared folders, ``file:``, ``hdfs:``, ``s3:`` and ``gs:``. Spark's JSON reader serves any other store
(``landing.entity_extract``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.json as paj
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual)
from pyspark.sql.types import StringType, StructType

# Workers get this module with the reader, wherever the driver found it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
FILTER_CONF = "spark.sql.python.filterPushdown.enabled"


class Split(InputPartition):
    """The lines of a file that start in [start, end)."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def lines_of(split: Split) -> Iterator[bytes]:
    """Whole lines of a split, in blocks of about ``BLOCK_BYTES``."""
    fs, path = file_system(split.path)
    with fs.open_input_file(path) as f:
        at, rest = split.start, b""
        if at:  # the line that is under way belongs to the split before
            f.seek(at - 1)
            while chunk := f.read(BLOCK_BYTES):
                if (cut := chunk.find(b"\n")) >= 0:
                    at, rest = at + cut, chunk[cut + 1:]
                    break
                at += len(chunk)
            else:
                return
            f.seek(at)
            rest = b""
        begun = at  # of the line under way
        while begun < split.end:
            chunk = f.read(BLOCK_BYTES)
            data = rest + chunk
            if chunk:
                cut = data.rfind(b"\n") + 1
            else:
                cut = len(data)
            if begun + cut > split.end:  # lines that start in the next split are not ours
                edge = data.find(b"\n", max(split.end - begun - 1, 0)) + 1
                cut = edge or cut
            if cut:
                yield data[:cut]
            rest, begun = data[cut:], begun + cut
            if not chunk:
                return


def _test(f: Filter, column: pa.Array) -> pa.Array:
    if isinstance(f, IsNull):
        return pc.is_null(column)
    if isinstance(f, IsNotNull):
        return pc.is_valid(column)
    if isinstance(f, In):
        return pc.is_in(column, value_set=pa.array([x for x in f.value if x is not None], pa.string()))
    op = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}[type(f)]
    return pc.fill_null(op(column, pa.scalar(f.value, pa.string())), False)


class LandedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        fields = [x.strip() for x in options["fields"].split(",")]
        self.names = schema.fieldNames()
        if missing := [n for n in self.names if n not in fields]:
            raise ValueError(f"not among the entity's fields: {missing}")
        if wrong := [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]:
            raise ValueError(f"landed cells are text: {wrong}")
        self.places = [fields.index(n) for n in self.names]
        self.path, self.cells, self.value = options["path"], options.get("cells", "methodValues"), options.get("value", "elementValue")
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """All filters go back to Spark; those understood also reduce what is handed to it."""
        for f in filters:
            text = isinstance(f, (IsNull, IsNotNull, In)) or isinstance(getattr(f, "value", None), str)
            if isinstance(f, (EqualTo, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and text and f.attribute[0] in self.names:
                self.filters.append(f)
            yield f

    def partitions(self) -> Sequence[Split]:
        fs, path = file_system(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(path))
        splits = []
        for x in sorted(found, key=lambda x: x.path):
            if x.is_file and x.size and not x.base_name.startswith(("_", ".")):
                # the file's own path, with the scheme of the folder's
                full = x.path if info.is_file else f"{self.path.rstrip('/')}/{x.base_name}"
                splits += [Split(self.path if info.is_file else full, a, min(a + self.split_bytes, x.size)) for a in range(0, x.size, self.split_bytes)]
        return splits or [Split("", 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if not split.path:
            return
        cell = pa.list_(pa.struct([(self.value, pa.string())]))
        parse = paj.ParseOptions(explicit_schema=pa.schema([(self.cells, cell)]), unexpected_field_behavior="ignore")
        for block in lines_of(split):
            if not block.strip():
                continue
            table = paj.read_json(pa.BufferReader(block), paj.ReadOptions(use_threads=False, block_size=len(block) + 1), parse)
            for batch in table.to_batches():
                cells = batch.column(0)
                size = pc.fill_null(pc.list_value_length(cells), 0)
                flat, start = pc.struct_field(cells.values, 0), pa.array(cells.offsets)[:-1]
                # a place beyond a line's cells is null
                columns = [flat.take(pc.if_else(pc.greater(size, place), pc.add(start, place), None)) for place in self.places]
                out = pa.RecordBatch.from_arrays(columns, names=self.names)
                for f in self.filters:
                    out = out.filter(_test(f, out.column(self.names.index(f.attribute[0]))))
                yield out


class LandedEntity(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_entity"

    def schema(self) -> str:
        """All of the entity's fields, where the reader names none."""
        return ", ".join(f"`{x.strip()}` STRING" for x in self.options["fields"].split(","))

    def reader(self, schema: StructType) -> LandedReader:
        return LandedReader(schema, dict(self.options))


def read_landed(spark: SparkSession, path: str, fields: Sequence[str], wanted: Sequence[str] | None = None, **options) -> DataFrame:
    """The ``wanted`` fields (None: all) of an entity's landed files; ``fields`` are the registry's, in order."""
    spark.dataSource.register(LandedEntity)
    spark.conf.set(FILTER_CONF, "true")
    reader = spark.read.format("landed_entity").option("fields", ",".join(fields)).options(**options)
    if wanted is not None:
        reader = reader.schema(", ".join(f"`{x}` STRING" for x in wanted))
    return reader.load(path)
