"""What is compared, declared and checked before use."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

from ..functions.canonical import KINDS
from ..functions.expressions import quoted


@dataclass(frozen=True)
class Aggregate:
    name: str
    operation: str
    column: str
    by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.operation not in ("sum", "min", "max"):
            raise ValueError(f"{self.name}: unknown operation {self.operation!r}")


@dataclass(frozen=True)
class Rule:
    """How an entity is compared: its columns by canonical kind, key, partitions and aggregates."""

    entity: str
    columns: Mapping[str, str]
    key: tuple[str, ...]
    partitions: Mapping[str, tuple[str, ...]]
    aggregates: tuple[Aggregate, ...] = ()
    deletes: bool = True
    allow_empty: bool = False

    def __post_init__(self) -> None:
        if not self.columns or not self.key:
            raise ValueError(f"{self.entity}: columns and a key are needed")
        for name in (self.entity, *self.columns):
            quoted(name)
        unknown = {k for k in self.columns.values() if k not in KINDS}
        used = {*self.key, *(c for p in self.partitions.values() for c in p), *(c for a in self.aggregates for c in (a.column, *a.by))}
        if unknown or not used <= set(self.columns):
            raise ValueError(f"{self.entity}: unknown kinds {sorted(unknown)} or columns {sorted(used - set(self.columns))}")
        names = [a.name for a in self.aggregates]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.entity}: aggregates repeat a name")

    @property
    def checks(self) -> list[str]:
        """Names of the checks, in their order."""
        return ["non_empty", "row_count", *(f"partition_count:{p}" for p in self.partitions), *["deleted_absent"] * self.deletes, *(f"checksum:{c}" for c in self.columns), *(f"aggregate:{a.name}" for a in self.aggregates)]


def load(document: Mapping[str, Any]) -> tuple[Rule, ...]:
    """Rules from plain data; a name that no rule has is an error."""
    out = []
    for item in document["entities"]:
        extra = set(item) - {f.name for f in fields(Rule)}
        if extra:
            raise ValueError(f"unknown settings: {sorted(extra)}")
        item = dict(item)
        item["key"] = tuple(item["key"])
        item["partitions"] = {k: tuple(v) for k, v in item.get("partitions", {}).items()}
        item["aggregates"] = tuple(Aggregate(a["name"], a["operation"], a["column"], tuple(a.get("by", ()))) for a in item.get("aggregates", ()))
        out.append(Rule(**item))
    if len({r.entity for r in out}) < len(out):
        raise ValueError("an entity is declared twice")
    return tuple(out)


#: The retail comparison, 43 checks.
RETAIL = (
    Rule("customers", {"customer_id": "integer", "email": "text", "first_name": "text", "last_name": "text", "updated_at": "timestamp"}, ("customer_id",), {}),
    Rule("products", {"product_id": "integer", "sku": "text", "name": "text", "category": "text", "unit_price": "decimal", "active": "boolean", "updated_at": "timestamp"}, ("product_id",), {"category": ("category",)}, (Aggregate("maximum_price", "max", "unit_price"),)),
    Rule("orders", {"order_id": "integer", "customer_id": "integer", "ordered_at": "timestamp", "status": "text", "updated_at": "timestamp"}, ("order_id",), {"status": ("status",)}, (Aggregate("earliest_order", "min", "ordered_at"), Aggregate("latest_order", "max", "ordered_at"))),
    Rule(
        "order_items",
        {"order_id": "integer", "line_number": "integer", "product_id": "integer", "quantity": "integer", "unit_price": "decimal", "updated_at": "timestamp"},
        ("order_id", "line_number"),
        {"product": ("product_id",)},
        (Aggregate("quantity_by_product", "sum", "quantity", ("product_id",)), Aggregate("price_sum_by_product", "sum", "unit_price", ("product_id",))),
    ),
)
