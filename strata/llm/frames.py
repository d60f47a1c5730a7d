"""Small helpers for operators that add columns to documents in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64(),
         "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
         "array<string>": pa.list_(pa.string())}


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns. Maps and variants, which Spark does not hash, go in as JSON."""
    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return F.xxhash64(*[col(f.name) if hashable(f.dataType) else F.to_json(F.struct(col(f.name))) for f in df.schema.fields])


def with_columns(docs: DataFrame, added: list[T.StructField], compute: Callable[[pa.Array], list[pa.Array]],
                 text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with columns computed from the text column of each Arrow batch.

    Other columns pass through; an added column replaces one of the same name (ignoring case). Without ``keep_text`` the
    text does not come back from Python. No shuffle.
    """
    names = {f.name.lower() for f in added} | (set() if keep_text else {text.lower()})
    rest = [c for c in docs.columns if c.lower() not in names]
    kinds = [ARROW[f.dataType.simpleString()] for f in added]
    # A text that passes through goes to Python once.
    sent = rest.index(text) if text in rest else len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [a if isinstance(a, pa.Array) else pa.array(a, k)
                     for a, k in zip(compute(batch.column(sent)), kinds, strict=True)]
            fields = [batch.schema.field(i) for i in range(len(rest))]
            fields += [pa.field(f.name, k) for f, k in zip(added, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], *found], schema=pa.schema(fields))

    schema = T.StructType([*(docs.schema[c] for c in rest), *added])
    own = [] if text in rest else [col(text).alias(unused(docs, "_text"))]
    return docs.select(*map(col, rest), *own).mapInArrow(run, schema)
