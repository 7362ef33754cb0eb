"""Expectations: what passes, what is counted, what aborts."""

import pytest

from larderlake.operators.quality import (
    RuleSet,
    apply_rules,
    enforce,
    expect,
    expect_or_drop,
    expect_or_fail,
    scorecard,
    violations,
)
from larderlake.plans.rules import RULES
from tests.conftest import rows


def kept(df, table, column):
    return sorted(r[column] for r in enforce(df, RULES[table]).collect())


def test_contract_size():
    rules = [r for s in RULES.values() for r in s.rules]
    by_action = {a: sum(r.action == a for r in rules) for a in ("warn", "drop", "fail")}
    assert by_action == {"warn": 17, "drop": 33, "fail": 4}


@pytest.mark.parametrize(
    ("table", "ddl", "bad"),
    [
        ("customers", "customer_id int, email_address string, customer_country string, gender string",
         (None, "e", "c", "M")),
        ("products", "product_id int, product_retail_price double, product_cost double", (None, 2.0, 1.0)),
        ("stores", "store_id int, region_id int, store_name string, store_phone string", (None, 1, "n", "p")),
        ("regions", "region_id int, sales_region string", (None, "r")),
    ],
)
def test_missing_primary_key_aborts(spark, table, ddl, bad):
    df = spark.createDataFrame([bad], ddl)
    with pytest.raises(Exception, match="violated"):
        enforce(df, RULES[table]).collect()
    # Counting only some columns must not hide it.
    with pytest.raises(Exception, match="violated"):
        enforce(df, RULES[table]).count()


def test_fail_wins_over_drop(spark):
    df = spark.createDataFrame(
        [(None, None, "n", "p")], "store_id int, region_id int, store_name string, store_phone string"
    )
    with pytest.raises(Exception, match="valid_store_pk"):
        enforce(df, RULES["stores"]).collect()


def test_prices_must_be_positive(spark):
    df = spark.createDataFrame(
        [(1, 9.99, 4.0), (2, 0.0, 4.0), (3, -1.0, 4.0), (4, 5.0, 0.0), (5, 5.0, None)],
        "product_id int, product_retail_price double, product_cost double",
    )
    assert kept(df, "products", "product_id") == [1]


def test_gender_counts_null_as_violation(spark):
    df = spark.createDataFrame([("M",), ("F",), ("X",), ("",), (None,)], "gender string")
    score = rows(scorecard(df, RuleSet.of("t", warn={"g": "gender IN ('M', 'F')"})))[0]
    assert (score["total_rows"], score["passed"], score["failed"]) == (5, 2, 3)


def test_quantity_must_be_positive(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, -1), (4, None)], "id int, quantity int")
    assert [r.id for r in expect_or_drop(df, {"q": "quantity > 0"}).collect()] == [1]


def test_price_above_cost_only_warns(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 5.0), (2, 5.0, 5.0), (3, 4.0, 5.0)],
        "product_id int, product_retail_price double, product_cost double",
    )
    kept_rows, seen = apply_rules(df, RULES["products"])
    assert kept_rows.count() == 3
    assert seen.get["price_above_cost"] == 2


def test_missing_region_is_dropped(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", "p"), (2, None, "b", "p"), (3, 3, None, None)],
        "store_id int, region_id int, store_name string, store_phone string",
    )
    assert kept(df, "stores", "store_id") == [1, 3]


def test_event_types(spark):
    names = ("RESTOCK", "SALE", "ADJUSTMENT", "RETURN", "UNKNOWN", "")
    df = spark.createDataFrame(
        [(i, 1, n) for i, n in enumerate(names)], "event_id int, stock_level int, event_type string"
    )
    found, seen = apply_rules(df, RULES["inventory"])
    assert found.count() == 6 and seen.get["valid_event_type"] == 2


def test_stock_level_not_negative(spark):
    df = spark.createDataFrame(
        [(1, 0, "SALE"), (2, 10, "SALE"), (3, -1, "SALE"), (4, None, "SALE")],
        "event_id int, stock_level int, event_type string",
    )
    assert kept(df, "inventory", "event_id") == [1, 2]


def transactions(spark):
    return spark.createDataFrame(
        [
            (1, "2024-01-02", "2024-01-01", 1, 1, 1),
            (2, None, "2024-01-01", 1, 1, 1),
            (3, "2024-01-02", "2024-01-01", None, 1, 1),
            (4, "2024-01-02", "2024-01-01", 1, None, 1),
            (5, "2024-01-02", "2024-01-01", 1, 1, None),
            (0, "2024-01-02", "2024-01-01", 1, 1, 1),
            (-3, "2024-01-02", "2024-01-01", 1, 1, 1),
            (8, "2024-01-02", "2024-01-05", 1, 1, 1),
        ],
        "quantity int, transaction_date string, stock_date string, product_id int, store_id int, "
        "customer_id int",
    )


def test_all_transaction_rules(spark):
    df, seen = apply_rules(transactions(spark), RULES["transactions"])
    assert sorted(r.quantity for r in df.collect()) == [1, 8]
    counts = seen.get
    assert (counts["total_rows"], counts["kept_rows"]) == (8, 2)
    assert counts["valid_quantity"] == 2 and counts["valid_transaction_date"] == 1
    assert counts["stock_before_sale"] == 2  # one late stock date, one NULL comparison


def test_quarantine_names_every_broken_rule(spark):
    broken = violations(transactions(spark), RULES["transactions"])
    found = {r.quantity: r.violated_rules for r in broken.collect()}
    assert found[2] == ["valid_transaction_date", "stock_before_sale"]
    assert found[8] == ["stock_before_sale"] and 1 not in found


def test_single_actions(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    has = {"has_a": "a IS NOT NULL"}
    assert expect(df, has).count() == 2
    assert expect_or_drop(df, has).count() == 1
    with pytest.raises(Exception, match="has_a"):
        expect_or_fail(df, has).count()
    assert expect_or_fail(df.filter("a = 1"), has).count() == 1


def test_no_rows(spark):
    empty = transactions(spark).filter("false")
    assert enforce(empty, RULES["transactions"]).count() == 0
    assert {r.total_rows for r in scorecard(empty, RULES["transactions"]).collect()} == {0}
