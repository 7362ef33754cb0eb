"""Column names and types of sources and silver tables.

Fixed values, all of them: feeds arrive with these names, and users query by them.
"""

from __future__ import annotations

# --- message payloads --------------------------------------------------------------------------

ORDER_MESSAGE = (
    "event_time string, order_id int, product_id int, store_id int, customer_id int, quantity int"
)
INVENTORY_MESSAGE = (
    "event_id int, event_time string, product_id int, store_id int, stock_level int, "
    "event_type string"
)

# --- exported documents ------------------------------------------------------------------------

CUSTOMER_DOCUMENT = (
    "customer_id int, customer_acct_num string, first_name string, last_name string, "
    "email_address string, customer_address string, customer_city string, "
    "customer_state_province string, customer_postal_code string, customer_country string, "
    "birthdate string, marital_status string, yearly_income string, gender string, "
    "total_children int, num_children_at_home int, education string, acct_open_date string, "
    "member_card string, occupation string, homeowner string"
)
PRODUCT_DOCUMENT = (
    "product_id int, product_brand string, product_name string, product_sku bigint, "
    "product_retail_price double, product_cost double, product_weight double, "
    "recyclable int, low_fat int"
)

# --- what cleansing reads from bronze, as the types silver keeps -------------------------------

TRANSACTIONS = (
    "transaction_date date, stock_date date, product_id int, customer_id int, store_id int, "
    "quantity int"
)
RETURNS = "return_date date, product_id int, store_id int, quantity int"
STORES = (
    "store_id int, region_id int, store_type string, store_name string, "
    "store_street_address string, store_city string, store_state string, store_country string, "
    "store_phone string, first_opened_date date, last_remodel_date date, total_sqft int, "
    "grocery_sqft int"
)
REGIONS = "region_id int, sales_district string, sales_region string"
CALENDAR = "date date"
CUSTOMERS = (
    "customer_id int, customer_acct_num string, first_name string, last_name string, "
    "email_address string, customer_address string, customer_city string, "
    "customer_state_province string, customer_postal_code string, customer_country string, "
    "birthdate date, acct_open_date date, marital_status string, yearly_income string, "
    "member_card string, occupation string, homeowner string, gender string, "
    "total_children int, num_children_at_home int, education string"
)
PRODUCTS = (
    "product_id int, product_brand string, product_name string, product_sku bigint, "
    "product_retail_price double, product_cost double, product_weight double, "
    "recyclable boolean, low_fat boolean"
)
ORDERS = (
    "order_id int, event_time timestamp, product_id int, store_id int, customer_id int, "
    "quantity int"
)
INVENTORY = (
    "event_id int, event_time timestamp, product_id int, store_id int, stock_level int, "
    "event_type string"
)

# --- change application ------------------------------------------------------------------------

#: Columns whose change opens a new version.
TRACKED = {
    "stores": ["total_sqft", "grocery_sqft", "last_remodel_date", "store_type"],
    "customers": [
        "email_address",
        "customer_address",
        "marital_status",
        "member_card",
        "yearly_income",
        "occupation",
        "homeowner",
    ],
    "products": ["product_retail_price", "product_cost", "recyclable", "low_fat"],
}
KEYS = {
    "stores": ["store_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "regions": ["region_id"],
}
SEQUENCE = "bronze_ingestion_time"

# --- storage layout ----------------------------------------------------------------------------

PARTITIONS = {
    # Lines by year, so that a refresh of some years reads only those.
    "transactions": ["transaction_year"],
    "returns": ["return_year"],
    "fact_sales": ["transaction_year", "transaction_month"],
    "fact_returns": ["return_year"],
}
#: Columns of facts that hold hashed keys.
HASHES = ["sale_sk", "return_sk", "product_sk", "customer_sk", "store_sk", "date_sk"]
CLUSTERING = {
    "dim_date": ["date_key"],
    "dim_region": ["region_id"],
    "dim_store": ["store_id", "region_id"],
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id", "product_brand"],
    "fact_sales": ["transaction_date", "store_id", "product_id", "customer_id"],
    "fact_returns": ["return_date", "store_id", "product_id"],
}
