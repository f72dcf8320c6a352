import pytest
from pyspark.sql import functions as F

from wickwork.functions import columns as c


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "new, base, want", [(12.0, 10.0, 20.0), (5.0, 0.0, None), (5.0, None, None), (-1.0, 2.0, -150.0)]
)
def test_pct_change(spark, new, base, want):
    values = {"n": new, "b": base}
    expr = c.pct_change(F.col("n").cast("double"), F.col("b").cast("double"))
    assert one(spark, expr, **values) == want


@pytest.mark.parametrize("predicted, want", [(0.06, "High"), (-0.06, "High"), (0.05, "Low"), (0.0, "Low")])
def test_confidence(spark, predicted, want):
    assert one(spark, c.confidence(F.col("p")), p=predicted) == want


@pytest.mark.parametrize("p, a, want", [(1.0, 2.0, True), (-1.0, -2.0, True), (1.0, -1.0, False), (1.0, 0.0, False)])
def test_direction_hit(spark, p, a, want):
    assert one(spark, c.direction_hit(F.col("p"), F.col("a")), p=p, a=a) is want


@pytest.mark.parametrize("change, want", [(1.0, "up"), (-1.0, "down"), (0.0, "flat")])
def test_direction(spark, change, want):
    assert one(spark, c.direction(F.col("c")), c=change) == want


def test_predicted_price(spark):
    assert one(spark, c.predicted_price(F.col("p"), F.col("r")), p=200.0, r=1.5) == pytest.approx(203.0)


def test_time_parts(spark):
    ts = F.to_timestamp(F.lit("2024-03-05 07:09:11"))
    row = spark.range(1).select(*c.time_parts(ts)).first()
    assert tuple(row) == ("2024", "03", "05", "07", "09")


def test_names(spark):
    assert one(spark, c.split_list(F.col("t"), upper=True), t=" a ,,b") == ["A", "B"]
    assert one(spark, c.stream_name(F.lit("ABC"), F.lit("trade"))) == "abc@trade"


def test_sequence_key_orders_by_time_then_tie(spark):
    rows = spark.createDataFrame(
        [(2, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:01"), (5, "2024-01-01 00:00:01"), (9, "1950-01-01 00:00:00")],
        "id long, t string",
    )
    key = c.sequence_key(F.to_timestamp("t"), F.col("id"))
    assert [r.id for r in rows.orderBy(key).collect()] == [9, 2, 1, 5]
