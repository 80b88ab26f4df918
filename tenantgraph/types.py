"""Storage classes: their Spark types, and the allow-lists that sort, range filters, cursors and min/max/first share."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantgraph.errors import QueryFailed

SPARK: dict[str, T.DataType] = {
    "integer": T.LongType(), "float": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "ci_string": T.StringType(), "uuid": T.StringType(),
    "date": T.DateType(), "utc_datetime": T.TimestampType(), "naive_datetime": T.TimestampNTZType(), "time": T.LongType(), "decimal": T.DecimalType(38, 18),
    "binary": T.BinaryType(), "map": T.MapType(T.StringType(), T.StringType()), "array_integer": T.ArrayType(T.LongType()), "array_string": T.ArrayType(T.StringType()),
    "array_float": T.ArrayType(T.DoubleType()), "vector": T.ArrayType(T.FloatType()),
}
ORDERABLE = frozenset({"integer", "float", "boolean", "string", "ci_string", "uuid", "date", "utc_datetime", "naive_datetime", "time"})
SUMMABLE = frozenset({"integer", "float"})
_PYTHON: dict[str, tuple[type, ...]] = {
    "integer": (int,), "float": (int, float), "boolean": (bool,), "string": (str,), "ci_string": (str,), "uuid": (str,), "date": (dt.date,), "utc_datetime": (dt.datetime,),
    "naive_datetime": (dt.datetime,), "time": (dt.time, int), "decimal": (decimal.Decimal, int), "binary": (bytes, bytearray), "map": (dict,), "vector": (list, tuple),
}


def is_orderable(storage: str) -> bool:
    return storage in ORDERABLE


def is_summable(storage: str) -> bool:
    return storage in SUMMABLE


def literal(value: Any, storage: str | None, field: str | None = None) -> Column:
    """A bound value as a typed literal. What doesn't fit its storage class is refused before anything runs."""
    if value is None:
        return F.lit(None).cast(SPARK[storage]) if storage else F.lit(None)
    if storage is None:
        if isinstance(value, (bool, int, str, dt.date, decimal.Decimal)) or isinstance(value, float) and math.isfinite(value):
            return F.lit(value)
        raise QueryFailed("unencodable_value", field=field)
    kinds = (list, tuple) if storage.startswith("array_") else _PYTHON[storage]
    if not isinstance(value, kinds) or isinstance(value, bool) != (storage == "boolean") or isinstance(value, float) and not math.isfinite(value):
        raise QueryFailed("unencodable_value", field=field)
    if storage == "date" and isinstance(value, dt.datetime):
        raise QueryFailed("unencodable_value", field=field)
    if isinstance(value, dt.time):
        value = ((value.hour * 60 + value.minute) * 60 + value.second) * 1_000_000 + value.microsecond
    return F.lit(list(value) if isinstance(value, tuple) else value).cast(SPARK[storage])
