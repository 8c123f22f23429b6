"""The declared warehouse tables that query texts and questions refer to."""

from __future__ import annotations

from typing import NamedTuple


class Table(NamedTuple):
    schema: str
    name: str
    description: str
    tags: list[str]
    columns: list[str]


# Names, descriptions, tags and columns of the declared tables.
TABLES = [
    Table("PROD_DW.SALES", "ORDERS", "Customer orders, one row per order",
          ["orders", "revenue", "sales", "transactions"],
          ["ORDER_ID", "CUSTOMER_ID", "ORDER_DATE", "TOTAL_AMOUNT", "STATUS", "PRODUCT_ID", "QUANTITY", "REGION",
           "DISCOUNT_PCT", "CREATED_AT"]),
    Table("PROD_DW.SALES", "CUSTOMERS", "Customer master table",
          ["customers", "users", "accounts", "clients"],
          ["CUSTOMER_ID", "EMAIL", "FIRST_NAME", "LAST_NAME", "SEGMENT", "COUNTRY", "SIGNUP_DATE", "LTV", "IS_ACTIVE",
           "CREATED_AT"]),
    Table("PROD_DW.CATALOG", "PRODUCTS", "Product catalog with pricing",
          ["products", "catalog", "items", "sku", "inventory"],
          ["PRODUCT_ID", "SKU", "NAME", "CATEGORY", "PRICE", "COST", "IS_ACTIVE", "CREATED_AT"]),
    Table("PROD_DW.ANALYTICS", "DAILY_REVENUE",
          "Pre-aggregated daily revenue by region — use for fast revenue queries",
          ["revenue", "daily", "aggregated", "finance", "kpi"],
          ["DATE", "REGION", "GROSS_REVENUE", "NET_REVENUE", "ORDER_COUNT", "CUSTOMER_COUNT", "UPDATED_AT"]),
    Table("PROD_DW.ANALYTICS", "USER_EVENTS", "Raw clickstream / product events",
          ["events", "clickstream", "behavior", "funnel", "pageview"],
          ["EVENT_ID", "USER_ID", "SESSION_ID", "EVENT_TYPE", "PAGE", "PROPERTIES", "OCCURRED_AT"]),
]


def full_name(table: Table) -> str:
    return f"{table.schema}.{table.name}"


def weighted_terms(table: Table) -> list[tuple[str, float]]:
    """What a question may mention, and how much each mention says about the table."""
    words = [w for w in table.description.lower().split() if len(w) > 3]
    return (
        [(tag, 2.0) for tag in table.tags]
        + [(w, 0.5) for w in words]
        + [(table.name.lower(), 3.0)]
        + [(c.lower().replace("_", " "), 1.0) for c in table.columns]
    )
