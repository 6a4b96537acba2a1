"""Cell conversions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ends in Z or an offset: text without a zone is no instant.
_ZONED = r"(?i)(Z|[+-]\d{2}(:?\d{2}){0,2})(\[.+\])?$"
_PER_MILLI = {"micros": 1000, "nanos": 1_000_000, "millis": 1}


def instant_from_number(value: Column, unit: str = "micros") -> Column:
    """Number -> timestamp at millisecond precision; digits below are cut towards zero."""
    return F.timestamp_millis(F.call_function("div", value.cast("bigint"), F.lit(_PER_MILLI[unit]).cast("bigint")))


def instant_from_text(value: Column) -> Column:
    """ISO text with zone -> timestamp at full precision; other text -> null."""
    return F.when(value.rlike(_ZONED), F.try_to_timestamp(value))


def local_from_text(value: Column) -> Column:
    """ISO text -> timestamp without zone."""
    return value.try_cast("timestamp_ntz")


def zoned_from_text(value: Column) -> Column:
    """ISO text with zone or offset -> timestamp; the zone itself is not kept."""
    return instant_from_text(F.regexp_replace(value, r"\[.+\]$", ""))


def convert(raw: Column, kind: T.DataType, unit: str = "micros") -> Column:
    """A variant converted to its declared type; null if absent, null or not convertible.

    Numbers are never read through text: that would pass through a double. In nested structs each field may be a cell again.
    """
    if isinstance(kind, T.TimestampType):
        is_number = F.schema_of_variant(raw).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
        return F.when(is_number, instant_from_number(F.try_variant_get(raw, "$", "bigint"), unit)).otherwise(instant_from_text(F.try_variant_get(raw, "$", "string")))
    if isinstance(kind, T.TimestampNTZType):
        return local_from_text(F.try_variant_get(raw, "$", "string"))
    if isinstance(kind, T.StructType):
        field = lambda f: F.coalesce(F.try_variant_get(raw, f"$.{f.name}.value", "variant"), F.try_variant_get(raw, f"$.{f.name}", "variant"))
        return F.when(F.schema_of_variant(raw).startswith("OBJECT"), F.struct(*(convert(field(f), f.dataType, unit).alias(f.name) for f in kind.fields)))
    return F.try_variant_get(raw, "$", kind.simpleString())


def cell(variant: Column, path: str, kind: T.DataType, unit: str = "micros") -> Column:
    """The cell at a path of a variant, unwrapped and converted."""
    return convert(F.try_variant_get(variant, path, "variant"), kind, unit)


def with_default(value: Column, default: object, kind: T.DataType) -> Column:
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))
