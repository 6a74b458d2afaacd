import random

import pytest
from conftest import rows

from daytally.operators import encoders

SCHEMA = "series string, kind string, price double, day long"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    made = [(f"s{i % 7}", rng.choice(["b", "a", "", None]), rng.choice([None, 1.0, 2.5, 9.0]), i) for i in range(200)]
    return spark.createDataFrame(made, SCHEMA).repartition(5)


def test_codes_follow_the_order_of_texts(table):
    got = {(r["name"], r["value"]): r["code"] for r in encoders.category_codes(table, ["series", "kind"]).collect()}
    expected = {("kind", v): i for i, v in enumerate(["", "a", "b"], 1)}
    expected |= {("series", f"s{i}"): i + 1 for i in range(7)}
    assert got == expected


def test_scalers_match_brute_force(table):
    got = {r["name"]: (r["center"], r["scale"]) for r in encoders.real_scalers(table, ["price", "day"]).collect()}
    prices = [r["price"] for r in table.collect() if r["price"] is not None]
    center = sum(prices) / len(prices)
    spread = (sum((p - center) ** 2 for p in prices) / len(prices)) ** 0.5
    assert got["price"] == pytest.approx((center, spread))
    assert got["day"][0] == pytest.approx(99.5)


def test_unseen_and_missing_values_get_code_zero(spark, table):
    names, reals = ["series", "kind"], ["price", "day"]
    codes, scalers = encoders.category_codes(table, names), encoders.real_scalers(table, reals)
    later = spark.createDataFrame([("s3", "a", 1.0, 5), ("new", None, None, 6), ("s0", "z", 2.0, None)], SCHEMA)
    got = encoders.encode(later, codes, scalers, names, reals)
    assert rows(got, "series", "series_code", "kind_code") == [("new", 0, 0), ("s0", 1, 0), ("s3", 4, 2)]
    assert got.filter("series = 'new'").first()["price_scaled"] is None
    assert got.count() == 3


def test_constant_and_empty_columns(spark, table):
    one = spark.createDataFrame([("a", "k", 2.0, None), ("a", "k", 2.0, None)], SCHEMA)
    assert rows(encoders.real_scalers(one, ["price", "day"]), "name", "center", "scale") == [
        ("day", None, None),
        ("price", 2.0, 1.0),
    ]
    none = table.limit(0)
    assert encoders.category_codes(none, ["series"]).isEmpty()
    coded = encoders.encode(one, encoders.category_codes(none, ["series"]), encoders.real_scalers(one, ["price"]), ["series"], ["price"])
    assert rows(coded, "series_code", "price_scaled") == [(0, 0.0)] * 2
