"""The staging models as queries that the catalog can keep: the same columns as in `staging`, as SQL text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from martwright.functions import rules


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS STRING), '_null_')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def _tidy(column: str) -> str:
    return f"lower(trim({column}))"


def _percent(top: str, bottom: str) -> str:
    share = f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0.0D) * 100"
    return f"CAST(round(CAST({share} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


def _band(column: str) -> str:
    (none, empty), *bands = rules.STOCK_BANDS
    branches = f"WHEN {column} = {empty} THEN {_text(none)} "
    branches += " ".join(f"WHEN {column} <= {top} THEN {_text(label)}" for label, top in bands)
    return f"CASE {branches} ELSE {_text(rules.STOCK_ABOVE)} END"


_COMPLETED = ", ".join(map(_text, rules.COMPLETED_STATUSES))
_EXPECTED = "round(quantity * unit_price, 2)"
_DISTANCE = f"abs(line_total - {_EXPECTED})"

COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "customer_id",
        "customer_key": _key("first_name", "last_name", "email"),
        "first_name": "first_name",
        "last_name": "last_name",
        "full_name": "concat(first_name, ' ', last_name)",
        "email": _tidy("email"),
        **{c: c for c in ("phone", "city", "state", "country", "postal_code", "created_at", "updated_at")},
    },
    "orders": {
        "order_id": "order_id",
        "order_key": _key("order_id"),
        "customer_id": "customer_id",
        "order_date": "order_date",
        "order_date_day": "to_date(order_date)",
        **{
            f"order_{unit}": f"CAST(trunc(to_date(order_date), '{unit}') AS TIMESTAMP_NTZ)"
            for unit in ("week", "month", "quarter", "year")
        },
        "order_status": _tidy("order_status"),
        "is_completed": _flag(f"lower(order_status) IN ({_COMPLETED})"),
        "is_cancelled": _flag(f"lower(order_status) = {_text(rules.CANCELLED_STATUS)}"),
        "shipping_method": _tidy("shipping_method"),
        "payment_method": _tidy("payment_method"),
        **{c: c for c in ("shipping_cost", "tax_amount", "discount_amount", "created_at", "updated_at")},
    },
    "products": {
        "product_id": "product_id",
        "product_key": _key("product_id"),
        **{c: f"trim({c})" for c in ("product_name", "category", "subcategory", "brand")},
        "unit_price": "price",
        "unit_cost": "cost",
        "unit_profit": "price - cost",
        "profit_margin_pct": _percent("(price - cost)", "price"),
        "stock_quantity": "stock_quantity",
        "inventory_status": _band("stock_quantity"),
        "created_at": "created_at",
        "updated_at": "updated_at",
    },
    "order_items": {
        "order_item_id": "order_item_id",
        "order_item_key": _key("order_item_id"),
        **{c: c for c in ("order_id", "product_id", "quantity", "unit_price", "line_total")},
        "calculated_line_total": _EXPECTED,
        "line_total_variance": _DISTANCE,
        "is_line_total_valid": _flag(f"{_DISTANCE} < CAST({rules.LINE_TOLERANCE} AS DECIMAL(4,2))"),
        "created_at": "created_at",
    },
}


def view_query(name: str, source: str, run_at: dt.datetime, run_id: str, audit_columns: Sequence[str]) -> str:
    """The query of the staging view of a stored raw table, with when and by which run it was made."""
    loaded_at, invocation_id = audit_columns
    columns = COLUMNS[name] | {
        loaded_at: f"CAST('{run_at.isoformat(sep=' ')}' AS TIMESTAMP)",
        invocation_id: _text(run_id),
    }
    return f"SELECT {', '.join(f'{text} AS `{column}`' for column, text in columns.items())} FROM {source}"
