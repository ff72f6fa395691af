"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each string of an Arrow column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def extended(schema: T.StructType, **added: T.DataType) -> T.StructType:
    """A new schema with more fields at its end."""
    return T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in added.items())])


def unused(name: str, taken: list[str]) -> str:
    """``name``, or what it becomes with underscores until no column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


#: Modules that keep results in a worker process from task to task.
STORES = ("weftgraph.llm.pieces",)
#: Texts reach Python in Arrow batches of about this size, whatever their length; short rows still come by the thousand.
BATCH_BYTES = "4m"


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str, keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` with bounded batches; a worker gives unused memory back at the end of each task, since it lives on idle.

    ``keeps``: the module whose stores in the worker process serve this function;
    other modules' stores (their ``forget``) are emptied first. Column names may hold dots, which ``mapInArrow`` itself would take for fields.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    names = df.columns
    if any("." in c or "`" in c for c in names):
        df = df.toDF(*(f"column_{k}" for k in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for module in STORES:
            if module != keeps and module in sys.modules:
                sys.modules[module].forget()
        try:
            yield from function(pa.RecordBatch.from_arrays(b.columns, names) for b in batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(_libc := ctypes.CDLL(None), "malloc_trim"):
                _libc.malloc_trim(0)

    return df.mapInArrow(run, schema)


def named_rows(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """``docs`` read from files, with the columns that name a row: the file's hash and the place in it."""
    if not _is_files(docs):
        docs = materialize(docs, "rows")
    meta = docs.metadataColumn("_metadata")
    return docs, F.xxhash64(meta.getField("file_path")), meta.getField("row_index")


def _is_files(docs: DataFrame) -> bool:
    """Whether ``docs`` is a table of Parquet files as it was read; only then a file and a place in it name one row."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        return False
    try:
        docs.select(docs.metadataColumn("_metadata").getField("row_index")).schema
    except AnalysisException:
        return False
    return True
