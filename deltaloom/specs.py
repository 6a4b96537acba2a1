"""Target tables. A new table is one TableSpec."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DECIMAL = T.DecimalType(38, 10)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: columns in bind order, with their types; null_defaults replace a null or missing cell of an event."""

    name: str
    columns: dict[str, T.DataType]
    key: str = "id"
    null_defaults: dict[str, object] = field(default_factory=dict)
    ts_units: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.key not in self.columns:
            raise ValueError(f"{self.name}: key {self.key} is no column")
        if unknown := set(self.null_defaults) - set(self.columns):
            raise ValueError(f"{self.name}: defaults for unknown columns {sorted(unknown)}")

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c != self.key]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, c != self.key) for c, t in self.columns.items()])

    def preserving(self) -> TableSpec:
        """The same table where a missing cell of a defaulted column keeps the stored value."""
        return TableSpec(self.name, self.columns, self.key, {}, self.ts_units)


def _spec(name: str, text: str, **kw) -> TableSpec:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "decimal": DECIMAL, "timestamp": T.TimestampType()}
    return TableSpec(name, {c: kinds[k] for c, k in (x.split() for x in text.split(","))}, **kw)


ORDERS = _spec("orders", "id long,user_id long,product_id long,quantity int,discount decimal,subtotal decimal,tax decimal,total decimal,created_at timestamp", null_defaults={"quantity": 0})
PRODUCTS = _spec("products", "id long,category string,ean string,price decimal,quantity int,rating decimal,title string,vendor string,created_at timestamp", null_defaults={"quantity": 0})
REVIEWS = _spec("reviews", "id long,reviewer string,product_id long,rating decimal,body string,created_at timestamp")
USERS = _spec(
    "users",
    "id long,name string,email string,address string,city string,state string,zip string,birth_date string,latitude decimal,longitude decimal,password string,source string,created_at timestamp",
)


class Registry(dict):
    """Route name -> TableSpec; names are matched in lower case."""

    def register(self, spec: TableSpec, route: str | None = None) -> Registry:
        self[(route or spec.name).lower()] = spec
        return self


def default_registry() -> Registry:
    out = Registry()
    for spec in (PRODUCTS, USERS, ORDERS, REVIEWS):
        out.register(spec)
    return out
