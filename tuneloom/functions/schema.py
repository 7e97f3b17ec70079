"""Schemas that can be built before there is a session."""

from pyspark.sql import types as T

STRING, LONG, INT, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
STRINGS = T.ArrayType(STRING)


def struct_of(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])
