"""Column functions against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from costgauge.functions import numeric, prices, text, timing


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in frame.select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize("digits", [0, 1, 2, 4, 6, 8])
def test_half_even_equals_python_round(spark, digits):
    random.seed(digits)
    values = [random.uniform(-1e5, 1e5) for _ in range(2000)]
    values += [round(random.uniform(-1e4, 1e4), digits + 1) for _ in range(2000)]
    values += [k + 0.5 for k in range(-20, 20)] + [k / 1000 + 0.0005 for k in range(500)]
    values += [2.675, 1.005, 8.345, 0.125, 1e-7, 0.0, -0.0, 123456789.125]
    got = column(spark, values, "double", lambda x: numeric.half_even(x, digits))
    assert got == [float(round(v, digits)) for v in values]


def test_stable_ignores_the_last_bits(spark):
    total = 19.37325 / 52
    near = [total, total * (1 + 2**-52), total * (1 - 2**-52)]
    assert len(set(column(spark, near, "double", lambda x: numeric.stable(x, 6)))) == 1


def test_number_truthy_and_counts(spark):
    values = ["1.5", "", "None", None, "x", "-2", "0"]
    assert column(spark, values, "string", numeric.number) == [1.5, 0.0, 0.0, 0.0, 0.0, -2.0, 0.0]
    assert column(spark, [None, 0.0, 3.0], "double", lambda x: numeric.truthy(x, F.lit(7.0))) == [7.0, 7.0, 3.0]
    assert column(spark, [None, 0.0, 3.0], "double", numeric.count_or_one) == [1.0, 1.0, 3.0]


def test_required_capacity(spark):
    rows = [(8.0, 50.0, 5.2), (8.0, 0.0, 4.0), (1.0, 10.0, 1.0), (16.0, 100.0, 20.8)]
    frame = spark.createDataFrame(rows, "cap double, util double, want double")
    got = frame.select(numeric.required_capacity(F.col("cap"), F.col("util")), "want").collect()
    assert all(a == pytest.approx(b) for a, b in got)


def test_durations(spark):
    cases = {"PT5M": 5, "PT1H": 60, "P1D": 1440, "P1DT2H30M": 1590, "P": 0, "PT5S": 0, "5M": 5, "": 5}
    assert column(spark, list(cases), "string", text.iso_minutes) == list(cases.values())


def test_machine_families(spark):
    cases = {
        "e2-standard-4": "e2",
        "n2d-standard-16": "n2d",
        "n2-d-4": "n2d",
        "x9-d-4": "x9",
        "custom": "custom",
        "": "",
        "n2-highmem-8": "n2",
    }
    assert column(spark, list(cases), "string", text.machine_family) == list(cases.values())


def test_families_in_descriptions(spark):
    cases = {
        "N2D Instance Core": ("n2d", "n2"),
        "N2 Instance Ram": ("n2", "n2"),
        "C3D core": ("c3d", None),
        "plain disk": (None, None),
        "T2A Arm and E2": ("t2a", "e2"),
    }
    assert column(spark, list(cases), "string", text.family_in_description) == [a for a, _ in cases.values()]
    assert column(spark, list(cases), "string", text.family_substring) == [b for _, b in cases.values()]


def test_interval_floor(spark):
    frame = spark.sql("SELECT timestamp'2024-03-05 13:47:31.5' AS ts")
    for minutes, want in {5: "13:45:00", 60: "13:00:00", 7: "13:46:00", 1440: "00:00:00", 2000: "00:00:00"}.items():
        got = frame.select(timing.iso_text(timing.floor_to_interval(F.col("ts"), minutes))).first()[0]
        assert got == f"2024-03-05T{want}Z"
    assert frame.select(timing.floor_to_interval(F.col("ts"), 0)).first()[0] is None


def test_zone_to_region(spark):
    cases = {"us-central1-a": "us-central1", "us-central1": "us-central1", "global": "global", "a-b-c-d": "a-b-c-d"}
    assert column(spark, list(cases), "string", timing.zone_to_region) == list(cases.values())


def test_prices(spark):
    assert column(spark, [0.0, -1.0, 1.0, 1000.0, 1500.0], "double", prices.query_cost) == [0.0, 0.0, 0.4, 400.0, 500.0]
    regions = {"us-east1": 0.08, "EUROPE-west1": 0.08, "asia-x": 0.14, "southamerica-a": 0.12, "australia": 0.19, "": 0.08}
    assert column(spark, list(regions), "string", prices.egress_price) == list(regions.values())
    assert column(spark, ["STANDARD", "NEARLINE", "ARCHIVE", "OTHER"], "string", prices.colder_class) == [
        "NEARLINE",
        "COLDLINE",
        "ARCHIVE",
        "NEARLINE",
    ]


def test_storage_class_by_reads(spark):
    rows = [
        (0.0, "STANDARD", "NEARLINE", "ARCHIVE"),
        (0.5, "NEARLINE", None, None),
        (0.2, "NEARLINE", "COLDLINE", "COLDLINE"),
        (0.05, "COLDLINE", "ARCHIVE", "ARCHIVE"),
        (0.0, "ARCHIVE", None, None),
        (1.0, "STANDARD", None, None),
    ]
    frame = spark.createDataFrame(rows, "reads double, class string, want string, best string")
    got = frame.select(
        prices.class_for_reads(F.col("reads"), F.col("class")),
        "want",
        prices.class_for_reads(F.col("reads"), F.col("class"), best_class=True),
        "best",
    ).collect()
    assert all(a == b and c == d for a, b, c, d in got)


def test_hourly_price_takes_the_first_positive_tier(spark):
    schema = (
        "p array<struct<pricingExpression: struct<tieredRates: array<struct<unitPrice: struct<units: string, nanos: bigint>>>>>>"
    )

    def pricing(*tiers):
        return [(([((u, n),) for u, n in tiers],),)]

    rows = [
        (pricing(("0", 0), ("1", 500000000)),),
        (pricing(("0", 22890000),),),
        (pricing(("0", 0)),),
        ([],),
        (None,),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(prices.hourly_price(F.col("p"))).collect()]
    assert got == [1.5, 0.02289, 0.0, 0.0, 0.0]


def test_templates(spark):
    frame = spark.createDataFrame([("a", 2.25), ("b", 10.0)], "name string, growth double")
    rendered = text.render(F.lit("{x} grows {growth:.1f} {other}"), {"x": F.col("name"), "growth:.1f": text.fixed(F.col("growth"), 1)})
    assert [r[0] for r in frame.select(rendered).collect()] == ["a grows 2.2 {other}", "b grows 10.0 {other}"]
    assert column(spark, [12345.5, 999.0], "double", text.thousands) == ["12,346", "999"]
    assert column(spark, [2.5, 3.5, 0.4], "double", lambda x: text.fixed(x, 0)) == ["2", "4", "0"]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_fixed_equals_python_format(spark, digits):
    values = [-0.35 / 7, -0.01, -0.0, 0.0, 0.04, -0.25, -0.5, -1.25, 2.675, -999.85 / 7, 1e6]
    assert column(spark, values, "double", lambda x: text.fixed(x, digits)) == [f"{v:.{digits}f}" for v in values]


def test_yearly_price(spark):
    rows = spark.createDataFrame([(0.0316,), (0.0,), (None,)], "p double").select(prices.yearly_price(F.col("p")).alias("y")).collect()
    assert [r.y for r in rows] == [276.82, 0.0, 0.0]
