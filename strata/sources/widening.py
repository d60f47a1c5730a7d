"""Tables whose columns may grow wider: INT, then BIGINT, then DOUBLE batches in one table, and no file written again.

Parquet files keep the types that they were written with, and a catalog table has one type per column. So rows lie in
generations, plain tables ``<name>__g0``, ``<name>__g1``, ... of one schema each, and ``<name>`` is a view that casts them to
the least types that hold them all. A batch that fits into the newest generation is appended to it; one that does not
begins another, and the view is made anew. Filters and column selections on the view reach each generation's scan.

Types form a lattice; the least type above two others:

* whole numbers: the longer; with a decimal: a decimal that has room for both; with a real: DOUBLE
* FLOAT and DOUBLE: DOUBLE; a decimal with either: none
* decimals: as many digits before and after the point as either has (none beyond 38)
* DATE and TIMESTAMP_NTZ: TIMESTAMP_NTZ
* a column without type (all NULL): the other type
* structs: field by field, with the fields of both; arrays and maps: of their elements
* all others: only with themselves

A BIGINT beyond 2^53 may have no exact DOUBLE, and none is rounded: an append of such values to a DOUBLE column fails, and so
does one that would make a BIGINT column with such values a DOUBLE (its columns are read once for that).

A driver lost amid an append has either added the batch or not, as with any append. An empty generation may be left;
the next batch uses it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType,
    ShortType, StringType, StructField, StructType, TimestampNTZType)

from strata.sources import tables

# Digits of the largest number of each whole type.
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
REALS = (FloatType, DoubleType)


def widest(a: DataType, b: DataType) -> DataType | None:
    """The least type that holds the values of both, None if there is none."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    whole = [type(t) in DIGITS for t in (a, b)]
    if all(whole):
        return a if DIGITS[type(a)] > DIGITS[type(b)] else b
    if all(isinstance(t, REALS) or type(t) in DIGITS for t in (a, b)):
        return DoubleType()
    if all(isinstance(t, DecimalType) or type(t) in DIGITS for t in (a, b)):
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (DIGITS[type(t)], 0) for t in (a, b)]
        before, after = (max(s) for s in zip(*sizes))
        return DecimalType(before + after, after) if before + after <= 38 else None
    if {type(a), type(b)} == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        return widest_schema(a, b, strict=False)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inner = widest(a.elementType, b.elementType)
        return inner and ArrayType(inner)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = widest(a.keyType, b.keyType), widest(a.valueType, b.valueType)
        return MapType(key, value) if key and value else None
    return None


def widest_schema(a: StructType, b: StructType, strict: bool = True) -> StructType | None:
    """The columns of both (names ignore case; those of ``a`` first) in their least common types."""
    other = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        match = other.pop(f.name.lower(), None)
        kind = f.dataType if match is None else widest(f.dataType, match.dataType)
        if kind is None:
            if strict:
                raise ValueError(f"column {f.name!r}: no type holds both {f.dataType.simpleString()} and "
                                 f"{match.dataType.simpleString()}")
            return None
        fields.append(StructField(f.name, kind))
    return StructType(fields + [StructField(f.name, f.dataType) for f in other.values()])


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of a schema that is above its own; a whole number that a DOUBLE does not hold exactly fails
    the job."""
    return df.select(*[F.expr(_sql(f, df.schema, True)).alias(f.name) for f in schema.fields])


def generations(spark: SparkSession, table: str) -> list[str]:
    """The tables that the rows lie in, oldest first."""
    schema, _, short = table.rpartition(".")
    if schema and not spark.catalog.databaseExists(schema):
        return []
    found = spark.sql(f"SHOW TABLES {f'IN {tables._name(schema)} ' if schema else ''}LIKE '{short}__g*'").collect()
    numbers = sorted(int(n) for row in found if (n := row.tableName[len(short) + 3:]).isdigit())
    return [f"{table}__g{n}" for n in numbers]


def append(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append rows of any types above or below those that the table has; new columns are added, missing ones are NULL.

    Without a common type for a column the append is refused and nothing changes.
    """
    tables.ensure_schema(spark, table)
    held = generations(spark, table)
    if held:
        newest = spark.table(held[-1]).schema
        wanted = widest_schema(newest, df.schema)
        if _same(newest, wanted):
            _insert(spark, df, held[-1])
            return
    else:
        wanted = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    wanted = StructType([StructField(f.name, StringType() if isinstance(f.dataType, NullType) else f.dataType)
                         for f in wanted.fields])
    for name in held:
        _check(spark, name, wanted)
    name = f"{table}__g{len(held)}"
    tables._create(spark, name, wanted)
    _publish(spark, table, [*held, name])
    _insert(spark, df, name)


def _same(a: StructType, b: StructType) -> bool:
    return tables._columns(a) == tables._columns(b)


def _insert(spark: SparkSession, df: DataFrame, generation: str) -> None:
    conformed(df, spark.table(generation).schema).write.insertInto(generation)


def _publish(spark: SparkSession, table: str, held: Sequence[str]) -> None:
    wanted = reduce(widest_schema, (spark.table(name).schema for name in held))
    parts = []
    for name in held:
        have = spark.table(name).schema
        columns = [f"{_sql(f, have, False)} AS {tables._quoted(f.name)}" for f in wanted.fields]
        parts.append(f"SELECT {', '.join(columns)} FROM {tables._name(name)}")
    spark.sql(f"CREATE OR REPLACE VIEW {tables._name(table)} AS {' UNION ALL '.join(parts)}")


def _sql(wanted: StructField, schema: StructType, checked: bool) -> str:
    """A column of ``schema`` in a wider type, as SQL text: the view is stored as text."""
    have = {f.name.lower(): f for f in schema.fields}.get(wanted.name.lower())
    if have is None:
        return f"CAST(NULL AS {tables._type_ddl(wanted.dataType)})"
    return _sql_value(tables._quoted(have.name), have.dataType, wanted.dataType, checked)


def _sql_value(value: str, have: DataType, wanted: DataType, checked: bool, depth: int = 0) -> str:
    if have.simpleString() == wanted.simpleString():
        return value
    inner = lambda v, a, b: _sql_value(v, a, b, checked, depth + 1)
    if isinstance(have, StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in wanted.fields:
            mine = own.get(f.name.lower())
            part = f"CAST(NULL AS {tables._type_ddl(f.dataType)})" if mine is None else inner(
                f"{value}.{tables._quoted(mine.name)}", mine.dataType, f.dataType)
            parts.append(f"{part} AS {tables._quoted(f.name)}")
        return f"IF({value} IS NULL, NULL, struct({', '.join(parts)}))"
    if isinstance(have, ArrayType):
        return f"transform({value}, x{depth} -> {inner(f'x{depth}', have.elementType, wanted.elementType)})"
    if isinstance(have, MapType):
        both = f"(k{depth}, v{depth})"
        keys = f"transform_keys({value}, {both} -> {inner(f'k{depth}', have.keyType, wanted.keyType)})"
        return f"transform_values({keys}, {both} -> {inner(f'v{depth}', have.valueType, wanted.valueType)})"
    cast = f"CAST({value} AS {tables._type_ddl(wanted)})"
    if checked and isinstance(have, LongType) and isinstance(wanted, DoubleType):
        # As decimals: the greatest BIGINT would come back from its DOUBLE as itself.
        return (f"IF({value} IS NULL OR CAST({cast} AS DECIMAL(20, 0)) = CAST({value} AS DECIMAL(20, 0)), {cast}, "
                f"CAST(raise_error(concat('no exact DOUBLE: ', CAST({value} AS STRING))) AS DOUBLE))")
    return cast


def _check(spark: SparkSession, generation: str, wanted: StructType) -> None:
    """Fail if a stored value would change in the wider types. Reads the columns that could only."""
    have = spark.table(generation).schema
    texts = [_sql(f, have, True) for f in wanted.fields]
    at_risk = [F.expr(text).alias(f"c{i}") for i, text in enumerate(texts) if "raise_error(" in text]
    if at_risk:
        spark.read.table(generation).select(*at_risk).write.format("noop").mode("overwrite").save()


def read(spark: SparkSession, table: str) -> DataFrame:
    """All rows in the widest types, as of now."""
    for name in generations(spark, table):
        spark.catalog.refreshTable(name)
    return spark.read.table(table)
