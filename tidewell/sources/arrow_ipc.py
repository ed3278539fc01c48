"""Arrow IPC folders as a Spark data source: ``spark.read.format("arrow_folder")``.

Reading plans partitions of consecutive record batches, so one large file is read by many
tasks; only the stream layout, which has no directory of its batches, is one partition a
file.  A schema given to the reader narrows the columns that are read, and comparisons of
whole numbers, texts, dates and booleans are applied before rows leave the Python worker.
Writing gives one file per task, shown when the job commits.  Paths go through Arrow's
filesystem layer, so any scheme it knows can be used.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType, StructType

NAME = "arrow_folder"

#: A partition reads about this much of a file; batches are taken to be of one size.
SPLIT_BYTES = 128 << 20

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_COMPARE = {
    ds.EqualTo: pc.equal,
    ds.GreaterThan: pc.greater,
    ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less,
    ds.LessThanOrEqual: pc.less_equal,
}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _shards(path: str) -> list[pafs.FileInfo]:
    fs, root = _open(path)
    found = fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True))
    return sorted((f for f in found if f.type == pafs.FileType.File and f.path.endswith((".arrow", ".arrows"))), key=lambda f: f.path)


def _schema(path: str, shard: str) -> pa.Schema:
    """The schema of one shard, in either the file or the stream layout."""
    fs, _ = _open(path)
    try:
        with fs.open_input_file(shard) as f:
            return ipc.open_file(f).schema
    except pa.ArrowInvalid:
        with fs.open_input_stream(shard) as f:
            return ipc.open_stream(f).schema


class _Slice(InputPartition):
    """Batches ``first`` to ``last`` (exclusive) of a shard, or all of a stream when ``last`` is None."""

    def __init__(self, shard: str, first: int = 0, last: int | None = None):
        self.shard, self.first, self.last = shard, first, last


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int):
        self.path, self.schema, self.split_bytes = path, schema, split_bytes
        self.filters: list[ds.Filter] = []

    def partitions(self) -> list[_Slice]:
        fs, _ = _open(self.path)

        def cut(info: pafs.FileInfo) -> list[_Slice]:
            try:
                with fs.open_input_file(info.path) as f:
                    n = ipc.open_file(f).num_record_batches
            except pa.ArrowInvalid:
                return [_Slice(info.path)]
            step = max(1, n * self.split_bytes // max(1, info.size))
            return [_Slice(info.path, lo, min(n, lo + step)) for lo in range(0, n, step)]

        with ThreadPoolExecutor(16) as pool:
            return [s for slices in pool.map(cut, _shards(self.path)) for s in slices]

    def read(self, partition: _Slice | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without any batch
            return
        columns = self.schema.fieldNames()
        for b in self._batches(partition, columns):
            b = b.select(columns)
            for f in self.filters:
                b = b.filter(_holds(f, b.column(f.attribute[0])))
            if b.num_rows:
                yield b

    def _batches(self, part: _Slice, columns: list[str]) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.path)
        names = _schema(self.path, part.shard).names
        options = ipc.IpcReadOptions(included_fields=[names.index(c) for c in columns])
        if part.last is None:
            with fs.open_input_stream(part.shard) as f:
                yield from ipc.open_stream(f, options=options)
        else:
            with fs.open_input_file(part.shard) as f:
                reader = ipc.open_file(f, options=options)
                for i in range(part.first, part.last):
                    yield reader.get_batch(i)


class _FilteringReader(_Reader):
    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Take the filters that Arrow answers as Spark does; floats are left, as NaN differs."""
        kinds = {f.name: f.dataType for f in self.schema}
        for f in filters:
            name = getattr(f, "attribute", ())
            plain = len(name) == 1 and isinstance(kinds.get(name[0]), (IntegralType, StringType, DateType, BooleanType))
            if plain and type(f) in (*_COMPARE, ds.In, ds.IsNull, ds.IsNotNull):
                self.filters.append(f)
            else:
                yield f


def _holds(f: ds.Filter, column: pa.Array) -> pa.Array:
    if isinstance(f, ds.IsNull):
        return column.is_null()
    if isinstance(f, ds.IsNotNull):
        return column.is_valid()
    if isinstance(f, ds.In):
        return pc.is_in(column, pa.array([v for v in f.value if v is not None], column.type))
    return _COMPARE[type(f)](column, pa.scalar(f.value, column.type))


class _Writer(DataSourceArrowWriter):
    """Tasks write below a hidden folder of the job.

    A commit shows the files of the attempts that counted and drops the folder, and with
    it what failed or lost attempts left; an abort only drops it.  Only the driver makes the
    folder, so a task that is still running then has nowhere to write and fails.
    """

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.job = f"_job-{uuid.uuid4().hex}"
        fs, root = _open(path)
        fs.create_dir(f"{root}/{self.job}", recursive=True)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _open(self.path)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return _Done("")
        name = f"part-{uuid.uuid4().hex}.arrow"
        with fs.open_output_stream(f"{root}/{self.job}/{name}") as sink, ipc.new_file(sink, first.schema) as writer:
            writer.write_batch(first)
            for b in batches:
                writer.write_batch(b)
        return _Done(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, root = _open(self.path)
        before = [f.path for f in _shards(self.path)]
        names = [m.name for m in messages if m is not None and m.name]
        if not names and (self.overwrite or not before):  # an empty table still has columns
            names = [f"part-{uuid.uuid4().hex}.arrow"]
            with fs.open_output_stream(f"{root}/{self.job}/{names[0]}") as sink:
                ipc.new_file(sink, to_arrow_schema(self.schema)).close()
        for name in names:
            fs.move(f"{root}/{self.job}/{name}", f"{root}/{name}")
        if self.overwrite:
            for old in before:
                fs.delete_file(old)
        self._drop()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        fs, root = _open(self.path)
        for last in (False, False, True):  # a task may add its file while the folder goes
            try:
                if fs.get_file_info(f"{root}/{self.job}").type == pafs.FileType.Directory:
                    fs.delete_dir(f"{root}/{self.job}")
                return
            except OSError:
                if last:
                    raise


class _Done(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class ArrowFolder(DataSource):
    """Options: ``path``, ``splitBytes`` (size of a partition) and ``pushFilters``.

    Spark refuses readers that take filters while its setting for it is off, so the
    option is to follow that setting; ``read_arrow_folder`` does so.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        path = self.options["path"]
        shards = _shards(path)
        if not shards:
            raise FileNotFoundError(f"no Arrow shards in {path}")
        return from_arrow_schema(_schema(path, shards[0].path))

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = _FilteringReader if self.options.get("pushFilters", "false").lower() == "true" else _Reader
        return kind(self.options["path"], schema, int(self.options.get("splitBytes", SPLIT_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], schema, overwrite)


def read_arrow_folder(spark: SparkSession, path: str, schema: StructType | str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The rows of a folder; a ``schema`` names the columns to read, in any order."""
    spark.dataSource.register(ArrowFolder)
    reader = spark.read.format(NAME).option("splitBytes", split_bytes).option("pushFilters", spark.conf.get(PUSHDOWN, "false"))
    return (reader if schema is None else reader.schema(schema)).load(path)


def write_arrow_folder(df: DataFrame, path: str, mode: str = "append") -> None:
    df.sparkSession.dataSource.register(ArrowFolder)
    df.write.format(NAME).mode(mode).save(path)
