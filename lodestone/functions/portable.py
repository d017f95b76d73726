"""Values as any JSON reader or other engine takes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def json_safe(df: DataFrame) -> DataFrame:
    """Decimals become doubles, dates and timestamps ISO text, inside arrays, structs
    and maps as well; the rest stays. Whole seconds are written without a fraction."""
    return df.select(*(_safe(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType).alias(f.name)
                       for f in df.schema.fields))


def _changes(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_changes(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _changes(kind.elementType)
    if isinstance(kind, T.MapType):
        return _changes(kind.keyType) or _changes(kind.valueType)
    return isinstance(kind, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _safe(column: Column, kind: T.DataType) -> Column:
    if not _changes(kind):
        return column
    if isinstance(kind, T.DecimalType):
        return column.cast("double")
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _safe(x, kind.elementType))
    if isinstance(kind, T.MapType):
        values = F.transform_values(column, lambda _, v: _safe(v, kind.valueType))
        return F.transform_keys(values, lambda k, _: _safe(k, kind.keyType))
    if isinstance(kind, T.StructType):
        fields = [_safe(column.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return F.regexp_replace(F.date_format(column, ISO_TIMESTAMP), r"\.0{6}$", "")
