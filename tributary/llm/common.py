"""Words, bytes and row streams shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType, VariantType

from tributary.session import share_code

#: Rows that a task hands back to Spark at once.
ROWS_OUT = 20_000


def utf8(text: str) -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, as Spark reads it."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns in one, whatever their names."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in df.columns])


def hashable(column: Column, kind: DataType) -> Column:
    """The column for a hash over rows: maps have no order, so anything that holds one goes as JSON with sorted entries."""
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(column), lambda e: F.struct(F.to_json(F.struct(e["key"])).alias("k"), F.to_json(F.struct(hashable(e["value"], kind.valueType))).alias("v")))
        return F.array_sort(entries)
    if isinstance(kind, ArrayType) and holds_map(kind):
        return F.transform(column, lambda x: hashable(x, kind.elementType))
    if isinstance(kind, StructType) and holds_map(kind):
        return F.when(column.isNotNull(), F.struct(*[hashable(column.getField(f.name), f.dataType).alias(f.name) for f in kind]))
    return F.to_json(F.struct(column)) if isinstance(kind, VariantType) else column


def holds_map(kind: DataType) -> bool:
    return isinstance(kind, MapType) or any(
        holds_map(x) for x in ([kind.elementType] if isinstance(kind, ArrayType) else [f.dataType for f in kind] if isinstance(kind, StructType) else [])
    )


def fold_bucket(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def hash_sample(df: DataFrame, rows: int) -> DataFrame:
    """At most `rows` different rows, those with the smallest hash: the same ones on every run.

    All but about twice as many are dropped before anything is sorted, by the estimated
    number of different rows, so what one task sorts does not grow with the table.
    """
    key = F.xxhash64(*df.columns)
    total = df.agg(F.approx_count_distinct(key)).first()[0]
    if total > 2 * rows:
        df = df.where(key <= F.lit(int(-(2.0**63) + 2.0**64 * (2 * rows / total))))
    return df.distinct().orderBy(key, *df.columns).limit(rows)


def lower_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words between blanks and the control characters 9 to 13."""
    return text.lower().split()


def with_id(df: DataFrame, id_col: str, rest: str) -> StructType:
    """A schema of id, of the type it has in `df` (which may be a whole row), and the columns of `rest`."""
    fields = df.sparkSession.createDataFrame([], rest).schema.fields
    return StructType([StructField("id", df.schema[id_col].dataType), *fields])


def over_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[dict]], schema: str | StructType
) -> DataFrame:
    """mapInArrow whose function yields dicts of equally long columns."""
    return df.mapInArrow(BatchMapper(function, arrow_schema(df, schema)), schema)


def arrow_schema(df: DataFrame, schema: str | StructType) -> pa.Schema:
    """The Arrow form of a schema; every frame that runs Python here asks for it, so the code is shared first."""
    from pyspark.sql.pandas.types import to_arrow_schema

    share_code(df.sparkSession)
    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)


class BatchMapper:
    def __init__(self, function: Callable, schema: pa.Schema) -> None:
        self.function, self.schema = function, schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in self.function(batch):
                    yield as_batch(columns, self.schema)
                del batch
                pa.default_memory_pool().release_unused()


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns[field.name]
        values = values if isinstance(values, pa.Array) else pa.array(values, type=field.type)
        arrays.append(values if values.type == field.type else values.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(sorted_keys)])
