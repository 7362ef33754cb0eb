"""Scalar column builders. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: how source files spell dates.
DATE_TEXT = "M/d/yyyy"


def typed(name: str, to: T.DataType, strict: bool = True) -> str:
    """SQL for column ``name`` as type ``to``.

    Strict parsing raises on text that does not fit; tolerant parsing gives NULL, which a rule can
    then drop. Dates are read in the source spelling, timestamps in ISO form.
    """
    attempt = "" if strict else "try_"
    if isinstance(to, T.DateType):
        value = f"{attempt}to_date(`{name}`, '{DATE_TEXT}')"
    elif isinstance(to, T.TimestampType):
        value = f"{attempt}to_timestamp(`{name}`)"
    else:
        value = f"{attempt}cast(`{name}` AS {to.simpleString()})"
    return f"{value} AS `{name}`"


def conform(df: DataFrame, ddl: str, *carry: str, strict: bool = True) -> DataFrame:
    """Project ``df`` to the columns and types of a DDL string, then the ``carry`` expressions."""
    fields = T.StructType.fromDDL(ddl).fields
    return df.selectExpr(*(typed(f.name, f.dataType, strict) for f in fields), *carry)


def date_key(date: Column | str) -> Column:
    """A date as the integer yyyyMMdd."""
    d = F.col(date) if isinstance(date, str) else date
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def money(value: Column) -> Column:
    """Round an amount to cents, halves up."""
    return F.round(value, 2)


def total(amount: Column | str) -> Column:
    """Exact sum of amounts in whole cents.

    Adding doubles depends on the order of the rows, which on a cluster differs from run to run;
    adding integer cents does not.
    """
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(F.round(a * 100).cast("long")) / 100


def ratio(top: Column, bottom: Column, scale: int = 1) -> Column:
    """``top / bottom * scale`` to two decimals; NULL when the divisor is zero."""
    return F.round(F.try_divide(top, bottom) * scale, 2)


def stock_status(level: Column) -> Column:
    """Stock band of a level. A NULL level passes every test and lands in the last band."""
    # Band names and limits.
    return (
        F.when(level == 0, "OUT_OF_STOCK")
        .when(level < 10, "LOW")
        .when(level < 50, "MEDIUM")
        .otherwise("HEALTHY")
    )
