"""Who sees what: row filters and masked columns per table.

Fixed values: the table and column names. ``dim_store`` has no row filter on purpose, since marts
are built from it.
"""

from __future__ import annotations

from larderlake.operators.governance import TablePolicy

POLICIES = {
    "dim_region": TablePolicy(region_col="sales_region"),
    "agg_regional_sales": TablePolicy(region_col="sales_region"),
    "dim_customer": TablePolicy(
        text_columns=(
            "first_name",
            "last_name",
            "full_name",
            "email_address",
            "customer_address",
            "customer_postal_code",
        ),
        date_columns=("birthdate",),
    ),
    "dim_store": TablePolicy(text_columns=("store_street_address", "store_phone")),
    "agg_customer_ltv": TablePolicy(text_columns=("first_name", "last_name")),
}
