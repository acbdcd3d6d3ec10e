"""Daily sums of readings of any size, and the station's facts of equal places."""

from decimal import ROUND_HALF_UP, Decimal

from stellata.operators.aggregates import hourly_to_daily

SCHEMA = ("ano int, codigo_estacao string, nome_estacao string, latitude double, longitude double, altitude double, "
          "data string, temp_max_c double, temp_min_c double, temp_med_c double, umidade_pct double, "
          "precipitacao_mm double, arquivo string, linha int")


def _row(rain, name="E", line=1):
    return (2020, "A1", name, 1.0, 2.0, 3.0, "2020-01-01", 1.0, 1.0, rain, None, rain, "a.csv", line)


def _daily(spark, rows):
    return hourly_to_daily(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()


def test_equal_places_give_the_same_station_in_any_order(spark):
    rows = [_row(1.0, "B"), _row(1.0, "A")]
    assert {_daily(spark, r)[0]["nome_estacao"] for r in (rows, rows[::-1])} == {"A"}


def test_short_and_long_fractions_sum_exactly(spark):
    for values in ([0.005, 0.01], [0.1234, 0.00000000000001, None], [123456.78, -0.0001, 2.5], [1e12, 0.005, 1e-17],
                   [1 / 3, 2 / 3], [99999.9999, 100000.0, -5e9], [None, None], [9e19, 0.25]):
        got = _daily(spark, [_row(v, line=i) for i, v in enumerate(values)])[0]
        known = [Decimal(repr(v)) for v in values if v is not None]
        whole = sum(known).quantize(Decimal("0.01"), ROUND_HALF_UP) if known else None
        assert got["precipitacao_mm"] == whole, values


def test_short_readings_are_summed_as_longs_beside_one_struct(spark):
    plan = hourly_to_daily(spark.createDataFrame([_row(1.0)], SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan and "as bigint)" in plan
