"""Row filters and masks by viewer."""

import pytest

from larderlake.operators.governance import (
    MASKED_TEXT,
    Viewer,
    apply_masks,
    load_user_regions,
    register_functions,
    row_filter,
    secure_read,
    secure_views,
)
from larderlake.plans.policies import POLICIES
from tests.conftest import day, rows

GRANTS = [("u_west", "West"), ("u_west", "West"), ("u_west", "South"), ("u_one", "East")]


@pytest.fixture(scope="module")
def mart(spark):
    data = [(1, "West"), (2, "South"), (3, "East"), (4, None)]
    return spark.createDataFrame(data, "id int, sales_region string")


@pytest.mark.parametrize(
    ("viewer", "seen"),
    [
        (Viewer.of("u_west", "analysts"), [1, 2]),
        (Viewer.of("u_one"), [3]),
        (Viewer.of("u_none"), []),
        (Viewer.of("u_none", "admins"), [1, 2, 3, 4]),
        (Viewer.of("u_one", "engineers"), [1, 2, 3, 4]),
    ],
)
def test_rows_by_viewer(spark, mart, viewer, seen):
    grants = load_user_regions(spark, GRANTS)
    found = row_filter(mart, "sales_region", grants, viewer)
    assert sorted(r.id for r in found.collect()) == seen


def test_grants_are_replaced_as_a_whole(spark, path):
    assert load_user_regions(spark, GRANTS, path).count() == 4
    assert load_user_regions(spark, GRANTS[:1], path).count() == 1


def customers(spark):
    return spark.createDataFrame(
        [(1, "Ada", None, day("1990-01-01"), "Gold")],
        "customer_id int, first_name string, last_name string, birthdate date, member_card string",
    )


def test_masks(spark):
    policy = POLICIES["dim_customer"]
    (masked,) = rows(apply_masks(customers(spark), policy, Viewer.of("u")))
    assert masked == {
        "customer_id": 1,
        "first_name": MASKED_TEXT,
        "last_name": MASKED_TEXT,  # NULL is masked as well
        "birthdate": None,
        "member_card": "Gold",
    }
    df = apply_masks(customers(spark), policy, Viewer.of("u"))
    assert df.schema["birthdate"].dataType.simpleString() == "date"
    assert rows(apply_masks(customers(spark), policy, Viewer.of("u", "admins"))) == rows(customers(spark))


def test_policy_covers_eleven_columns():
    masked = sum(len(p.text_columns) + len(p.date_columns) for p in POLICIES.values())
    filtered = [t for t, p in POLICIES.items() if p.region_col]
    assert masked == 11 and filtered == ["dim_region", "agg_regional_sales"]


def test_secure_read(spark, mart):
    grants = load_user_regions(spark, GRANTS)
    viewer = Viewer.of("u_one")
    assert secure_read(mart, "agg_regional_sales", POLICIES, grants, viewer).count() == 1
    assert secure_read(mart, "dim_store", POLICIES, grants, viewer).count() == 4  # no row filter
    assert secure_read(mart, "other", POLICIES, grants, viewer) is mart


def test_sql_of_a_viewer(spark, mart):
    grants = load_user_regions(spark, [*GRANTS, ("u_one", "O'Hara")])
    secure_views({"agg_regional_sales": mart}, POLICIES, grants, Viewer.of("u_west"))
    assert spark.sql("SELECT count(*) FROM agg_regional_sales").first()[0] == 2
    text = "SELECT region_filter({0}), mask_pii_string('x'), mask_pii_date(DATE '2024-01-01')"

    def seen(region, *who):
        register_functions(spark, grants, Viewer.of(*who))
        return tuple(spark.sql(text.format(region)).first())

    assert seen("'East'", "u_one") == (True, MASKED_TEXT, None)
    assert seen("'O\\'Hara'", "u_one")[0] is True
    assert seen("'West'", "u_one")[0] is False
    assert seen("NULL", "u_one")[0] is False
    assert seen("'East'", "u_none")[0] is False
    assert seen("NULL", "u_none", "admins") == (True, "x", day("2024-01-01"))


def test_row_filter_function_asks_the_grants(spark, mart, path):
    load_user_regions(spark, [("o'neil", "West")], path)
    register_functions(spark, spark.read.parquet(path), Viewer.of("o'neil"))
    mart.createOrReplaceTempView("mart_rows")
    found = spark.sql("SELECT sales_region FROM mart_rows WHERE region_filter(sales_region)")
    assert {r[0] for r in found.collect()} == {"West"}
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
