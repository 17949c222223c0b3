"""The declared entities: fields, keys and types, never inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Field kinds of change events and the types of silver tables (timestamps stay text until staging).
SILVER = {"boolean": T.BooleanType(), "integer": T.LongType(), "decimal": T.DecimalType(18, 2), "string": T.StringType(), "timestamp": T.StringType()}
#: Columns that a snapshot carries along with an entity's own.
METADATA = {"source_lsn": T.LongType(), "topic": T.StringType(), "partition": T.IntegerType(), "offset": T.LongType(), "operation": T.StringType()}


@dataclass(frozen=True)
class Entity:
    """An entity's fields by kind, its key, and the fields that a row may lack."""

    name: str
    fields: dict[str, str]
    key: tuple[str, ...]
    optional: tuple[str, ...] = ("batch_id",)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f for f in self.fields if f not in self.optional)

    def row_type(self) -> T.StructType:
        return T.StructType([T.StructField(f, SILVER[k]) for f, k in self.fields.items()])

    def silver_type(self) -> T.StructType:
        return T.StructType([*self.row_type().fields, *(T.StructField(f, t) for f, t in METADATA.items())])


#: The retail domain.
ENTITIES = {
    e.name: e
    for e in (
        Entity("customers", {"customer_id": "integer", "email": "string", "first_name": "string", "last_name": "string", "status": "string", "updated_at": "timestamp", "batch_id": "integer"}, ("customer_id",)),
        Entity("products", {"product_id": "integer", "sku": "string", "name": "string", "category": "string", "unit_price": "decimal", "active": "boolean", "updated_at": "timestamp", "batch_id": "integer"}, ("product_id",)),
        Entity("orders", {"order_id": "integer", "customer_id": "integer", "ordered_at": "timestamp", "status": "string", "updated_at": "timestamp", "batch_id": "integer"}, ("order_id",)),
        Entity("order_items", {"order_id": "integer", "line_number": "integer", "product_id": "integer", "quantity": "integer", "unit_price": "decimal", "updated_at": "timestamp", "batch_id": "integer"}, ("order_id", "line_number")),
    )
}
