"""Facts: priced lines with the keys of their dimensions.

Every join here is a left lookup into a table unique on its key, so line counts never change and
the order of the joins is free. Lookups on the product come together: if products are too many to
broadcast, one shuffle on the product serves both. Keys are packed until all lookups are done.
"""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlake.functions import date_key, money, packed, surrogate_key, unpacked
from larderlake.operators.joins import Lookup, attach_keys, lookup_join
from larderlake.operators.scd import current

#: Dimension name -> (column of the fact, key of the dimension, surrogate key).
_DIMENSIONS = {
    "product": ("product_id", "product_id", "product_sk"),
    "customer": ("customer_id", "customer_id", "customer_sk"),
    "store": ("store_id", "store_id", "store_sk"),
    "date": ("date_key", "date_key", "date_sk"),
}
#: Amount of a line -> the price that its quantity is multiplied by.
_SALES_AMOUNTS = {"revenue": "product_retail_price", "cost": "product_cost"}
_RETURN_AMOUNTS = {"return_revenue": "product_retail_price", "return_cost": "product_cost"}


def _keyed(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return attach_keys(
        lines,
        [
            Lookup(dims[name], fact_key, key, [sk])
            for name, (fact_key, key, sk) in _DIMENSIONS.items()
            if name in dims and fact_key in lines.columns
        ],
    )


def _carried(found: DataFrame, sk: str) -> DataFrame:
    """A key packed for the lookups that follow. Not in the dimension: Spark takes bytes for large there and
    would broadcast less."""
    return found.withColumn(sk, packed(F.col(sk))) if sk in found.columns else found


def _priced(lines: DataFrame, products: DataFrame | None, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Lines with today's price and cost; lines of unknown products get NULLs.

    Prices are those of the current products. Only where ``products`` is None does the product
    dimension give them, and then the key in the same lookup.
    """
    wanted = ["product_retail_price", "product_cost"]
    if products is None:
        return lookup_join(lines, dims["product"], "product_id", "product_id", [*wanted, "product_sk"])
    priced = lookup_join(lines, current(products), "product_id", "product_id", wanted)
    return _keyed(priced, {name: d for name, d in dims.items() if name == "product"})


def _looked_up(lines: DataFrame, products: DataFrame | None, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Lines with prices and keys. What a lookup adds travels with every later one: the customer's key goes
    before prices and the product's key; amounts come from the prices when all lookups are done."""
    customer = {name: d for name, d in dims.items() if name == "customer"}
    priced = _priced(_carried(_keyed(lines, customer), "customer_sk"), products, dims)
    return _keyed(_carried(priced, "product_sk"), {name: d for name, d in dims.items() if name not in ("customer", "product")})


def _measured(found: DataFrame, lines: DataFrame, amounts: Mapping[str, str], profit: bool) -> DataFrame:
    """The lines' columns, the product's key, amounts, ``date_key`` and the other keys; keys as text."""
    kinds = dict(found.dtypes)
    keys = {
        sk: unpacked(F.col(sk)).alias(sk) if kinds[sk] == "binary" else F.col(sk)
        for _, _, sk in _DIMENSIONS.values()
        if sk in kinds
    }
    units = F.col("quantity")
    valued = found.select("*", *(money(units * F.col(price)).alias(name) for name, price in amounts.items()))
    gain = [money(F.col("revenue") - F.col("cost")).alias("gross_profit")] if profit else []
    return valued.select(
        *(c for c in lines.columns if c != "date_key"),
        *(key for sk, key in keys.items() if sk == "product_sk"),
        *amounts,
        *gain,
        "date_key",
        *(key for sk, key in keys.items() if sk != "product_sk"),
    )


def _sales_lines(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_date",
        "stock_date",
        "product_id",
        "customer_id",
        "store_id",
        "quantity",
        "transaction_year",
        "transaction_month",
        "transaction_quarter",
        date_key("transaction_date").alias("date_key"),
    )


def sales_measures(
    transactions: DataFrame, products: DataFrame | None, dims: Mapping[str, DataFrame] = MappingProxyType({})
) -> DataFrame:
    """Sales lines with revenue, cost and profit; of the keys only the product's, if it is in ``dims``."""
    lines = _sales_lines(transactions)
    return _measured(_priced(lines, products, dims), lines, _SALES_AMOUNTS, profit=True)


def fact_sales(
    transactions: DataFrame, products: DataFrame | None, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per sales line. ``sale_sk`` hashes the line's values: equal lines share it.

    ``dims`` maps any of product, customer, store and date to its dimension. Without ``products``
    the product dimension gives prices as well.
    """
    sale = surrogate_key(
        "fact_sales",
        "transaction_date",
        "product_id",
        "customer_id",
        "store_id",
        "quantity",
        "stock_date",
    )
    lines = _sales_lines(transactions)
    keyed = _measured(_looked_up(lines, products, dims), lines, _SALES_AMOUNTS, profit=True)
    return keyed.select(sale.alias("sale_sk"), "*", F.current_timestamp().alias("gold_loaded_at"))


def _return_lines(returns: DataFrame) -> DataFrame:
    lines = returns.select("return_date", "product_id", "store_id", "quantity", "return_year")
    return lines.withColumn("date_key", date_key("return_date"))


def returns_measures(
    returns: DataFrame, products: DataFrame | None, dims: Mapping[str, DataFrame] = MappingProxyType({})
) -> DataFrame:
    """Return lines with their value and cost; of the keys only the product's, if it is in ``dims``."""
    lines = _return_lines(returns)
    return _measured(_priced(lines, products, dims), lines, _RETURN_AMOUNTS, profit=False)


def fact_returns(
    returns: DataFrame, products: DataFrame | None, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per return line; dimensions the line has no key of are left out."""
    back = surrogate_key("fact_returns", "return_date", "product_id", "store_id", "quantity")
    lines = _return_lines(returns)
    keyed = _measured(_looked_up(lines, products, dims), lines, _RETURN_AMOUNTS, profit=False)
    return keyed.select(back.alias("return_sk"), "*", F.current_timestamp().alias("gold_loaded_at"))
