"""The row-quality contract.

Fixed values: rule names, conditions and actions. Audit entries and reports refer to them by name.
"""

from __future__ import annotations

from larderlake.operators.quality import RuleSet

RULES: dict[str, RuleSet] = {
    rules.table: rules
    for rules in (
        RuleSet.of(
            "transactions",
            drop={
                "valid_transaction_date": "transaction_date IS NOT NULL",
                "valid_quantity": "quantity > 0",
                "valid_product_id": "product_id IS NOT NULL",
                "valid_store_id": "store_id IS NOT NULL",
                "valid_customer_id": "customer_id IS NOT NULL",
            },
            warn={"stock_before_sale": "stock_date <= transaction_date"},
        ),
        RuleSet.of(
            "returns",
            drop={
                "valid_return_date": "return_date IS NOT NULL",
                "valid_return_quantity": "quantity > 0",
                "valid_return_product": "product_id IS NOT NULL",
                "valid_return_store": "store_id IS NOT NULL",
            },
        ),
        RuleSet.of(
            "stores",
            fail={"valid_store_pk": "store_id IS NOT NULL"},
            drop={"valid_region_fk": "region_id IS NOT NULL"},
            warn={
                "has_store_name": "store_name IS NOT NULL",
                "has_contact": "store_phone IS NOT NULL",
            },
        ),
        RuleSet.of(
            "regions",
            fail={"valid_region_pk": "region_id IS NOT NULL"},
            warn={"has_sales_region": "sales_region IS NOT NULL"},
        ),
        RuleSet.of("calendar", drop={"valid_date": "date IS NOT NULL"}),
        RuleSet.of(
            "orders",
            drop={
                "valid_order_id": "order_id IS NOT NULL",
                "valid_order_quantity": "quantity > 0",
                "valid_order_product": "product_id IS NOT NULL",
            },
            warn={"has_store_id": "store_id IS NOT NULL"},
        ),
        RuleSet.of(
            "inventory",
            drop={
                "valid_inventory_event": "event_id IS NOT NULL",
                "valid_stock_level": "stock_level >= 0",
            },
            warn={"valid_event_type": "event_type IN ('RESTOCK', 'SALE', 'ADJUSTMENT', 'RETURN')"},
        ),
        RuleSet.of(
            "customers",
            fail={"valid_customer_pk": "customer_id IS NOT NULL"},
            warn={
                "has_email": "email_address IS NOT NULL",
                "valid_country": "customer_country IS NOT NULL",
                "valid_gender": "gender IN ('M', 'F')",
            },
        ),
        RuleSet.of(
            "products",
            fail={"valid_product_pk": "product_id IS NOT NULL"},
            drop={
                "valid_retail_price": "product_retail_price > 0",
                "valid_cost": "product_cost > 0",
            },
            warn={"price_above_cost": "product_retail_price > product_cost"},
        ),
        RuleSet.of(
            "dim_date",
            drop={
                "valid_date_key": "date_key IS NOT NULL",
                "valid_date_column": "date IS NOT NULL",
            },
        ),
        RuleSet.of(
            "dim_region",
            drop={"valid_region_id": "region_id IS NOT NULL"},
            warn={"has_sales_region": "sales_region IS NOT NULL"},
        ),
        RuleSet.of(
            "dim_store",
            drop={
                "valid_store_id": "store_id IS NOT NULL",
                "valid_region_id": "region_id IS NOT NULL",
            },
            warn={"has_store_name": "store_name IS NOT NULL"},
        ),
        RuleSet.of(
            "dim_customer",
            drop={"valid_customer_id": "customer_id IS NOT NULL"},
            warn={
                "has_customer_country": "customer_country IS NOT NULL",
                "valid_customer_gender": "gender IN ('M', 'F')",
            },
        ),
        RuleSet.of(
            "dim_product",
            drop={
                "valid_product_id": "product_id IS NOT NULL",
                "valid_retail_price": "product_retail_price > 0",
            },
            warn={"margin_is_positive": "margin_pct > 0"},
        ),
        RuleSet.of(
            "fact_sales",
            drop={
                "valid_fs_quantity": "quantity > 0",
                "valid_fs_product_id": "product_id IS NOT NULL",
                "valid_fs_customer_id": "customer_id IS NOT NULL",
                "valid_fs_store_id": "store_id IS NOT NULL",
            },
            warn={"non_negative_revenue": "revenue >= 0"},
        ),
        RuleSet.of(
            "fact_returns",
            drop={
                "valid_fr_quantity": "quantity > 0",
                "valid_fr_product_id": "product_id IS NOT NULL",
                "valid_fr_store_id": "store_id IS NOT NULL",
            },
            warn={"non_negative_return_revenue": "return_revenue >= 0"},
        ),
    )
}
