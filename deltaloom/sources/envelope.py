"""From change envelopes to typed rows: filter, route, pick the image, unwrap the cells.

Input columns: topic string, seq long, value string (JSON) — or value already parsed as a variant.
A cell is an object {value, set}; a null cell, a missing cell and a null value all mean null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import convert, with_default
from ..specs import Registry, TableSpec

HEARTBEAT = "debezium-heartbeat"
OPS = ("c", "u", "d", "r")


class ChangeFormatError(ValueError):
    """An event that cannot be read, under on_error='fail'."""


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is computed once, however often it is used: the optimizer copies no expression out of a generated row."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def parse(events: DataFrame, payload: bool = False) -> DataFrame:
    """Drop null records, heartbeats and tombstones; add op, table and schema_name. `value` becomes the variant `e`, parsed once.

    Malformed JSON gives e null and is kept, for validate(); rows without a source (transaction metadata) go.
    payload: the event stands in the field `payload` of the JSON, as where connectors send their schema along.
    """
    out = _parsed(events, payload)
    return out.filter(F.col("e").isNull() | F.col("table").isNotNull())


def _parsed(events: DataFrame, payload: bool) -> DataFrame:
    value = F.col("value") if isinstance(events.schema["value"].dataType, T.VariantType) else F.try_parse_json("value")
    kept = events.filter(F.col("value").isNotNull() & ~F.coalesce(F.col("topic"), F.lit("")).contains(HEARTBEAT))
    whole = _once(kept, value, "e")
    if payload:
        whole = _once(whole.withColumnRenamed("e", "_whole"), F.try_variant_get("_whole", "$.payload", "variant"), "e").drop("_whole")
    read = F.struct(F.try_variant_get("e", "$.op", "string").alias("op"), F.try_variant_get("e", "$.source.table", "string").alias("table"), F.try_variant_get("e", "$.source.schema", "string").alias("schema_name"))
    return _once(whole, read, "_h").select(*whole.columns, "_h.*")


def transactions(events: DataFrame, payload: bool = False) -> DataFrame:
    """The transaction metadata among events: seq, id, status (BEGIN or END), event_count, ts_ms."""
    rows = _parsed(events, payload).filter(F.col("e").isNotNull() & F.col("table").isNull())
    read = {"id": "string", "status": "string", "event_count": "bigint", "ts_ms": "bigint"}
    return rows.select("seq", *(F.try_variant_get("e", f"$.{c}", t).alias(c) for c, t in read.items())).filter("status IS NOT NULL")


def include(parsed: DataFrame, tables: Iterable[str] = (), schemas: Iterable[str] = ()) -> DataFrame:
    """Only the listed tables and schemas; an empty list includes all."""
    tables, schemas = list(tables), list(schemas)
    if tables:
        parsed = parsed.filter(F.col("table").isin(tables) | F.concat_ws(".", "schema_name", "table").isin(tables))
    return parsed.filter(F.col("schema_name").isin(schemas)) if schemas else parsed


def routed(parsed: DataFrame, registry: Registry) -> DataFrame:
    """Events of registered tables; the schema does not count. Unreadable events pass, for validate()."""
    return parsed.filter(F.col("e").isNull() | F.lower("table").isin(list(registry)))


def image(op: Column) -> Column:
    """Path of the row image: the old row of a delete, the new one of anything else."""
    return F.when(op == "d", F.lit("before")).otherwise(F.lit("after"))


def decode(parsed: DataFrame, spec: TableSpec, ts_unit: str = "micros", honor_set: bool = False, route: str | None = None) -> DataFrame:
    """Typed rows of one table, of the events under its route (by default its name, in any case): seq, op, error, and the columns. A delete decodes its key only.

    error names what is wrong, else null: an op that is none, a missing key, a cell that does not fit its type.
    honor_set adds `<c>__set`: the cell was set explicitly, be it to null. A scalar is read with its type at once, and looked
    at again only if that gives null; instants and structs are taken out once and converted.
    """
    rows = parsed.filter((F.lower("table") == (route or spec.name).lower()) | F.col("e").isNull())
    is_delete = F.col("op") == "d"
    names = list(spec.columns)
    whole = [isinstance(t, (T.TimestampType, T.TimestampNTZType, T.StructType)) for t in spec.columns.values()]

    def at(c: str, kind: str) -> Column:
        """The cell's value in the image that counts, as the type."""
        after = F.try_variant_get("e", f"$.after.{c}.value", kind)
        return F.when(is_delete, F.try_variant_get("e", f"$.before.{c}.value", kind)).otherwise(after) if c == spec.key else F.when(~is_delete, after)

    sets = [F.coalesce(F.try_variant_get("e", f"$.after.{c}.set", "boolean"), F.lit(False)).alias(f"{c}__set") for c in spec.values] if honor_set else []
    read = [at(c, "variant" if w else t.simpleString()).alias(f"c{i}") for i, ((c, t), w) in enumerate(zip(spec.columns.items(), whole))]
    found = _once(rows.select("seq", "op", "e"), F.struct(*read, *sets), "_r")
    made = [convert(F.col(f"_r.c{i}"), spec.columns[c], spec.ts_units.get(c, ts_unit)).alias(f"c{i}") for i, c in enumerate(names) if whole[i]]
    typed = _once(found, F.struct(*made), "_v") if made else found
    cell = lambda i: F.col(f"_v.c{i}" if whole[i] else f"_r.c{i}")

    def there(i: int) -> Column:
        return F.col(f"_r.c{i}").isNotNull() & ~F.is_variant_null(F.col(f"_r.c{i}")) if whole[i] else at(names[i], "string").isNotNull()

    error = F.coalesce(
        F.when(F.col("e").isNull(), F.lit("no JSON")),
        F.when(F.col("op").isNull() | ~F.col("op").isin(*OPS), F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))),
        *(F.when(cell(i).isNull() & there(i), F.lit(f"cell {c} does not fit {spec.columns[c].simpleString()}")) for i, c in enumerate(names)),
        F.when(cell(names.index(spec.key)).isNull(), F.lit(f"no {spec.key}")),
    )

    def value(i: int, c: str) -> Column:
        v = cell(i)
        return F.when(F.coalesce(~is_delete, F.lit(True)), with_default(v, spec.null_defaults.get(c), spec.columns[c])).alias(c) if c in spec.null_defaults else v.alias(c)

    # What is wrong is worked out once as well: a filter on it would else be a copy of it.
    told = _once(typed, error, "error")
    return told.select("seq", "op", "error", *(value(i, c) for i, c in enumerate(names)), *(F.col(f"_r.{c}__set").alias(f"{c}__set") for c in spec.values if honor_set))


def check(decoded: DataFrame, on_error: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """Good rows, and the bad ones if they are to be quarantined; under 'fail' a bad row fails the query."""
    if on_error == "quarantine":
        return decoded.filter("error is null").drop("error"), decoded.filter("error is not null")
    if on_error != "fail":
        raise ValueError("on_error is fail or quarantine")
    guarded = decoded.filter(F.when(F.col("error").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad change: "), F.col("error"))).cast("boolean")))
    return guarded.drop("error"), None


def envelope(rows: DataFrame, spec: TableSpec, op: Column, seq: Column, topic: str = "src", schema: str = "public") -> DataFrame:
    """The reverse: rows of a table as envelopes (topic, seq, value JSON), for snapshots and tests."""
    cells = F.struct(*(F.struct(_plain(F.col(c), t).alias("value"), F.lit(True).alias("set")).alias(c) for c, t in spec.columns.items()))
    null = F.lit(None).cast(rows.select(cells.alias("x")).schema["x"].dataType)
    body = F.struct(
        op.alias("op"), F.when(op == "d", cells).otherwise(null).alias("before"), F.when(op != "d", cells).otherwise(null).alias("after"),
        F.struct(F.lit(spec.name).alias("table"), F.lit(schema).alias("schema")).alias("source"),
    )
    return rows.select(F.lit(f"{topic}.{schema}.{spec.name}").alias("topic"), seq.cast("long").alias("seq"), F.to_json(body).alias("value"))


def _plain(c: Column, kind: T.DataType) -> Column:
    return F.unix_micros(c) if isinstance(kind, T.TimestampType) else c


def snapshot(rows: DataFrame, spec: TableSpec, seq: int = 0) -> DataFrame:
    """Existing rows as snapshot reads, which come before any change."""
    return envelope(rows, spec, F.lit("r"), F.lit(seq))
