"""Arrow IPC files, as a Python data source: one task to a part of a file, conditions applied where it is read."""

from __future__ import annotations

import operator
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

# A file is read by so many tasks that each has about this much of it.
SPLIT_BYTES = 128 << 20

# What compares to the same result in Arrow and in Spark; floating point numbers and times are left to Spark.
_COMPARED = (pa.types.is_integer, pa.types.is_string, pa.types.is_boolean, pa.types.is_date32, pa.types.is_decimal)

_COMPARE = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
}


@dataclass
class Part(InputPartition):
    """One of ``parts`` equal shares of a file's record batches."""

    file: str
    part: int
    parts: int


class ArrowFiles(DataSource):
    """The files named ``*.arrow`` in the folder ``path``, or that file.

    The schema is that of the first file by name. A column that another file lacks is NULL there, one that it has
    more is left out. Dictionaries are read as their values. ``split_bytes`` says how much of a file a task reads.
    Tasks open the files through Arrow, so ``path`` must be in a store that Arrow knows.
    """

    @classmethod
    def name(cls) -> str:
        return "arrow_files"

    def schema(self) -> StructType:
        store, files = self._files()
        if not files:
            raise ValueError(f"no Arrow files at {self.options['path']}")
        with store.open_input_file(files[0].path) as file, pa.ipc.open_file(file) as opened:
            return from_arrow_schema(opened.schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PushedReader if self.options.get("push_filters") == "true" else Reader
        return kind(self, schema)

    def _files(self) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
        store, path = open_store(self.options["path"])
        found = store.get_file_info(path)
        if found.type == fs.FileType.Directory:
            every = store.get_file_info(fs.FileSelector(path))
            return store, sorted((f for f in every if f.is_file and f.base_name.endswith(".arrow")), key=lambda f: f.path)
        return store, [found] if found.is_file else []


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it."""
    address = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(address) if ":" in address.split("/", 1)[0] else (fs.LocalFileSystem(), address)


class Reader(DataSourceReader):
    """Reads parts of files as record batches."""

    def __init__(self, source: ArrowFiles, schema: StructType) -> None:
        self.source = source
        self.schema = to_arrow_schema(schema)
        self.conditions: list[pc.Expression] = []

    def partitions(self) -> list[Part]:
        split = int(self.source.options.get("split_bytes", SPLIT_BYTES))
        made = []
        for file in self.source._files()[1]:
            parts = max(1, -(-file.size // split))
            made += [Part(file.path, part, parts) for part in range(parts)]
        return made

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.source.options["path"])
        wanted = reduce(operator.and_, self.conditions) if self.conditions else None
        with store.open_input_file(partition.file) as file, pa.ipc.open_file(file) as opened:
            n = opened.num_record_batches
            for i in range(n * partition.part // partition.parts, n * (partition.part + 1) // partition.parts):
                rows = pa.Table.from_batches([self._in_schema(opened.get_batch(i))])
                yield from (rows if wanted is None else rows.filter(wanted)).to_batches()

    def _in_schema(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        there = set(batch.schema.names)
        columns = [
            batch.column(f.name).cast(f.type) if f.name in there else pa.nulls(len(batch), f.type) for f in self.schema
        ]
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


class PushedReader(Reader):
    """Reads only rows that meet Spark's conditions, as far as Arrow has the same ones."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for wanted in filters:
            condition = self._condition(wanted)
            if condition is None:
                yield wanted
            else:
                self.conditions.append(condition)

    def _condition(self, wanted: Filter) -> pc.Expression | None:
        """The same condition for Arrow, None where it has none. NULL is dropped, as by Spark."""
        if isinstance(wanted, ds.Not):
            inner = self._condition(wanted.child)
            return None if inner is None else ~inner
        if len(wanted.attribute) != 1 or self.schema.get_field_index(wanted.attribute[0]) < 0:
            return None
        name = wanted.attribute[0]
        kind = self.schema.field(name).type
        if isinstance(wanted, ds.IsNull):
            return pc.field(name).is_null()
        if isinstance(wanted, ds.IsNotNull):
            return pc.field(name).is_valid()
        if not any(same(kind) for same in _COMPARED):
            return None
        if isinstance(wanted, ds.In):
            # by comparisons, as Arrow's own test says false for NULL, and so true for its opposite
            return reduce(operator.or_, [pc.field(name) == pa.scalar(v, kind) for v in wanted.value]) if wanted.value else None
        if isinstance(wanted, ds.StringStartsWith):
            return pc.starts_with(pc.field(name), wanted.value)
        compare = _COMPARE.get(type(wanted))
        return None if compare is None else compare(pc.field(name), pa.scalar(wanted.value, kind))


# Workers get these classes whole, and need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
