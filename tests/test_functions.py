from datetime import date, datetime

from pyspark.sql import functions as F

from tideledger.functions import addresses as AD
from tideledger.functions import amounts as A
from tideledger.functions import buckets as K
from tideledger.functions import jsontext as J
from tideledger.functions import labels as L


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_amount_text_that_does_not_parse(spark):
    rows = [("1500000", "6"), ("n/a", "6"), ("nan", "6"), (None, "6"), ("5", None)]
    got = values(spark, rows, "a string, d string", A.scaled("a", "d"), A.scaled("a", "d", 0), A.coerced("a"))
    assert got == [(1.5, 1.5, 1500000), (None, None, 0), (None, None, 0), (None, None, 0), (None, 5.0, 5)]


def test_eighteen_decimal_amounts(spark):
    got = values(spark, [("32909232000000000000",)], "a string", A.scaled("a", 18))
    assert abs(got[0][0] - 32.909232) < 1e-9


def test_money_and_fee_parts(spark):
    got = values(spark, [("$3,903.579", "100000000000000000")], "m string, f string", A.money_text("m"), A.net_of_fees(F.lit(10.0), "f", "f"))
    assert got == [(3903.579, 8.0)]


def test_zero_denominator_is_null(spark):
    got = values(spark, [(1, 0), (1, 3), (0, 0)], "a int, b int", A.percent("a", "b"), A.ratio("a", "b"))
    assert got[0] == (None, None) and got[1][0] == 33.33 and got[2] == (None, None)


def test_discount_bucket_edges(spark):
    rows = [(0.0,), (0.8,), (None,), (-0.1,), (4.8,), (4.79,)]
    got = [r[0] for r in values(spark, rows, "d double", K.discount_bucket("d"))]
    assert got == ["0 - 0.79", "0.8 - 1.59", "4.8.0+", "Negative", "4.8.0+", "4.0 - 4.8"]
    assert values(spark, [(None,)], "d double", K.discount_bucket("d", "none")) == [("none",)]


def test_size_class_shared_bounds(spark):
    rows = [(9.99,), (10.0,), (100.0,), (100.01,), (1000.0,), (10000.0,), (10000.5,), (None,)]
    got = [r[0] for r in values(spark, rows, "v double", K.usd_range("v"))]
    assert got == ["<10$", "10-100$", "10-100$", "100-1000$", "100-1000$", "1000-10000$", ">10000$", None]


def test_capacity_level_is_right_closed(spark):
    rows = [(-0.2,), (0.0,), (25.0,), (25.1,), (100.0,), (100.1,), (None,)]
    got = [r[0] for r in values(spark, rows, "u double", K.capacity_level("u"))]
    assert got == [None, "<25%", "<25%", "25%-50%", "75%-100%", None, None]


def test_week_starts(spark):
    rows = [(datetime(2024, 9, 29, 23, 59),), (datetime(2024, 9, 30, 0, 0),)]
    got = values(spark, rows, "t timestamp", K.sunday_week("t"), K.monday_week("t"))
    assert got == [(date(2024, 9, 29), date(2024, 9, 23)), (date(2024, 9, 29), date(2024, 9, 30))]


def test_nine_hour_buckets_restart_each_day(spark):
    rows = [(datetime(2024, 1, 1, 23, 30),), (datetime(2024, 1, 2, 0, 10),)]
    got = values(spark, rows, "t timestamp", K.hour_bucket("t", 9))
    assert got == [(datetime(2024, 1, 1, 18),), (datetime(2024, 1, 2, 0),)]


def test_month_range_crosses_the_year(spark):
    rows = [(datetime(1997, 12, 31, 23, 59, 59),), (datetime(1998, 1, 1),), (datetime(1997, 11, 30, 23, 59),)]
    assert [r[0] for r in values(spark, rows, "t timestamp", K.in_month("t", 1997, 12))] == [True, False, False]


def test_addresses_in_mixed_case_and_padded(spark):
    plain = "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"
    wide = "0x" + "0" * 24 + plain[2:]
    got = values(spark, [(plain,), (wide,)], "a string", AD.unpadded("a"), AD.last_20_bytes("a"), AD.padded(AD.last_20_bytes("a")))
    assert got == [(plain.lower(), plain.lower(), wide.lower())] * 2


def test_price_groups_take_the_first_match(spark):
    rows = [("ETH",), ("NEXT",), ("nextUSDC",), ("nextalETH",), ("alUSD",), ("ezETH",), ("WBTC",), (None,)]
    got = values(spark, rows, "s string", L.asset_group("s"), L.price_group("s"))
    assert got == [
        ("WETH", "WETH"), ("NEXT", "NEXT"), ("USDC", "USDC"), ("alETH", "alETH"), ("alUSD", "USDT"), ("ezETH", "WETH"), ("WBTC", "WBTC"), (None, None),
    ]


def test_notional_levels_and_powers_of_ten(spark):
    rows = [(1100.0,), (1100.5,), (9000.0,), (89999.0,)]
    assert [r[0] for r in values(spark, rows, "v double", A.snapped_notional("v"))] == [1000, None, 10000, None]
    assert values(spark, [(3.1622776601683795e5,)], "v double", A.nearest_power_of_ten("v"))[0][0] in (1e5, 1e6)


def test_json_columns(spark):
    rows = [('{"0x00":"5","0xAb":"7"}',), ("{}",), (None,), ("[]",)]
    fees = J.text_map("j")
    got = values(spark, rows, "j string", J.nth_fee(fees, 1)[0], J.nth_fee(fees, 1)[1], F.size(J.without_zero_address(fees)))
    assert got[0] == ("0xAb", "7", 1) and got[1][:2] == (None, None) and got[2][:2] == (None, None)
    assert values(spark, [("['a', 'b']",), ("plain",)], "s string", J.bracket_list("s")) == [("a, b",), ("plain",)]
