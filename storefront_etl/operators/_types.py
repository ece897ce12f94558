"""Type helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def contains_map(data_type: DataType) -> bool:
    """True when the type is, or nests, a map (not hashable, not comparable)."""
    if isinstance(data_type, MapType):
        return True
    if isinstance(data_type, ArrayType):
        return contains_map(data_type.elementType)
    if isinstance(data_type, StructType):
        return any(contains_map(f.dataType) for f in data_type.fields)
    return False


def ref(name: str) -> Column:
    """Column by exact name (a header may contain dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")


def comparable(df: DataFrame, name: str) -> Column:
    """The column, or its JSON text when it holds a map (Spark's hash and
    DISTINCT reject map types)."""
    return F.to_json(ref(name)) if contains_map(df.schema[name].dataType) else ref(name)
