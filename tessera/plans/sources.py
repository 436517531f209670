"""The adapted source tables themselves, exposed as queries so the
adapter is value-checked against its DuckDB twin."""

from __future__ import annotations

from tessera.plans.registry import query

_SOURCES = [
    "fact_online_sales", "fact_sales", "dim_customer", "dim_geography", "dim_product",
    "dim_product_subcategory", "dim_product_category", "dim_store", "dim_promotion", "dim_employee",
    "dim_date", "fact_exchange_rate", "fact_inventory", "fact_sales_quota",
]

for _t in _SOURCES:
    query(f"S1_{_t}", f"SELECT * FROM {_t}", (_t,))((lambda t: lambda m: getattr(m, t))(_t))
