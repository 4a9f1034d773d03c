"""Feature presets and their boundaries (FIXTURES 2)."""

from riskflow.functions.features import GOLD, ONLINE, STORE, feature_columns


def _feat(spark, spec, rows, name):
    df = spark.createDataFrame(rows, "amount double, card_present boolean, timestamp string, "
                                     "payment_method string")
    return [r[0] for r in df.select(feature_columns(spec)[name]).collect()]


def test_amount_boundary(spark):
    rows = [(float(a), True, "2026-04-01T12:00:00+00:00", "upi")
            for a in (2000, 2000.01, 3000, 3000.01)]
    assert _feat(spark, STORE, rows, "is_high_amount") == [0, 1, 1, 1]
    assert _feat(spark, ONLINE, rows, "is_high_amount") == [0, 1, 1, 1]
    assert _feat(spark, GOLD, rows, "is_high_amount") == [0, 0, 0, 1]


def test_hour_boundary(spark):
    rows = [(1.0, True, f"2026-04-01T{h}:00:00+00:00", "upi") for h in ("05", "06", "22", "23")]
    assert _feat(spark, STORE, rows, "is_night_tx") == [1, 0, 0, 1]
    assert _feat(spark, ONLINE, rows, "is_night_tx") == [1, 0, 0, 1]
    assert _feat(spark, GOLD, rows, "is_night_tx") == [1, 0, 0, 0]


def test_null_card_present(spark):
    rows = [(1.0, None, "2026-04-01T12:00:00+00:00", "upi")]
    assert _feat(spark, GOLD, rows, "is_card_not_present") == [0]
    # NULL stands for a missing key there (a JSON null is read as False): no flag, so a reject
    assert _feat(spark, STORE, rows, "is_card_not_present") == [None]
    assert _feat(spark, ONLINE, rows, "is_card_not_present") == [None]


def test_time_zone(spark):
    rows = [(1.0, True, "2026-04-01T03:04:05+05:30", "upi")]
    assert _feat(spark, STORE, rows, "tx_hour") == [3]
    assert _feat(spark, ONLINE, rows, "tx_hour") == [3]
    assert _feat(spark, GOLD, rows, "tx_hour") == [21]   # UTC session


def test_bad_timestamp(spark):
    rows = [(1.0, True, "not-a-ts", "upi"), (1.0, True, "", "upi")]
    assert _feat(spark, GOLD, rows, "tx_hour") == [None, None]
    assert _feat(spark, GOLD, rows, "is_night_tx") == [0, 0]
    assert _feat(spark, STORE, rows, "tx_hour") == [None, None]
    assert _feat(spark, ONLINE, rows, "tx_hour") == [None, None]


def test_scores_and_risky(spark):
    rows = [(2500.0, False, "2026-04-01T23:00:00+00:00", "credit_card")]
    assert _feat(spark, GOLD, rows, "risk_score") == [2]        # cnp + risky; 23 is not < 6
    assert _feat(spark, STORE, rows, "is_risky_payment") == [1]  # high and not present
    assert _feat(spark, STORE, rows, "risk_score") == [3.0]
    assert _feat(spark, ONLINE, rows, "risk_score") == [4.0]


def test_nan_amount_python_vs_spark(spark):
    rows = [(float("nan"), True, "2026-04-01T12:00:00+00:00", "upi")]
    assert _feat(spark, GOLD, rows, "is_high_amount") == [1]    # Spark ordering
    assert _feat(spark, STORE, rows, "is_high_amount") == [0]   # Python comparison


def test_online_hour_iso_forms(spark):
    texts = ["2026-04-01T03:04:05+05:30", "2026-04-01T23:59:59Z", "2026-04-01 07:00:00-08:00",
             "2026-04-01", "2026-04-01T05:06:07.123456+00:00", "not-a-ts"]
    rows = [(1.0, True, t, "upi") for t in texts]
    assert _feat(spark, ONLINE, rows, "tx_hour") == [3, 23, 7, 0, 5, None]
    # the store variant slices characters 12-13: a date alone has no hour there
    assert _feat(spark, STORE, rows, "tx_hour")[3] is None
