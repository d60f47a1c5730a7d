"""Schema and type helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType


def as_schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema.strip())


def text_schema(data_type: DataType) -> DataType:
    """The same shape with every leaf a STRING, so that parsing never loses a badly typed value."""
    if isinstance(data_type, StructType):
        return StructType([StructField(f.name, text_schema(f.dataType)) for f in data_type.fields])
    if isinstance(data_type, ArrayType):
        return ArrayType(text_schema(data_type.elementType))
    if isinstance(data_type, MapType):
        return MapType(StringType(), text_schema(data_type.valueType))
    return StringType()


def conform(df: DataFrame, schema: str | StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to the declared columns: what cannot be cast is NULL (never an error), what is absent is NULL."""
    fields = as_schema(schema).fields
    return df.select(*[typed(F.col(f.name) if f.name in df.columns else F.lit(None), f.dataType).alias(f.name)
                       for f in fields], *keep)


def typed(column: Column, data_type: DataType) -> Column:
    return column.try_cast(data_type)
