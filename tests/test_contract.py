"""Feature contract and scoring-input checks (FIXTURES 2, contract rows)."""

from riskflow.operators import contract


def _store_rows(spark, rows, cols):
    types = {"transaction_id": "string", "amount": "double", "is_high_amount": "int",
             "is_card_not_present": "int", "tx_hour": "int", "is_night_tx": "int",
             "is_risky_payment": "int", "risk_score": "double", "is_fraud": "int",
             "timestamp": "string"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {types[c]}" for c in cols))


FULL = ("t1", 10.0, 0, 1, 3, 1, 0, 2.0, 0, "2024-01-01T03:00:00+00:00")
KEYS = contract.FEATURE_KEYS


def test_all_present_passes(spark):
    ok, bad = contract.split_contract(_store_rows(spark, [FULL], KEYS))
    assert ok.count() == 1 and bad.count() == 0
    assert ok.columns == KEYS


def test_missing_is_fraud_key(spark):
    cols = [k for k in KEYS if k != "is_fraud"]
    row = tuple(v for k, v in zip(KEYS, FULL) if k != "is_fraud")
    ok, bad = contract.split_contract(_store_rows(spark, [row], cols))
    assert ok.count() == 0
    assert bad.first()["violations"] == ["is_fraud"]


def test_null_is_fraud_and_missing_transaction_id(spark):
    r1 = FULL[:8] + (None,) + FULL[9:]
    r2 = (None,) + FULL[1:]
    ok, bad = contract.split_contract(_store_rows(spark, [r1, r2], KEYS))
    assert ok.count() == 0
    got = sorted(tuple(r["violations"]) for r in bad.collect())
    assert got == [("is_fraud",), ("transaction_id",)]


def test_feature_contract_is_strict(spark):
    """The feature contract converts nothing: text or a float for an int field, an int for a
    float field and a number for a text field are violations."""
    df = spark.createDataFrame([("t1", "3", 1.0, 5, 7)],
                               "transaction_id string, tx_hour string, is_night_tx double, amount int, timestamp int")
    r = contract.check_features(df).first()
    assert r["tx_hour"] is None
    assert {"tx_hour", "is_night_tx", "amount", "timestamp"} <= set(r["violations"])
    assert "transaction_id" not in r["violations"]


def test_request_schema_converts_but_takes_no_fraction(spark):
    """The scorer's request schema takes whole numbers and numeric text for an int field."""
    df = spark.createDataFrame([("a", "3", 1.0), ("b", "x", 1.5), ("c", "2.0", 0.0)],
                               "transaction_id string, tx_hour string, is_night_tx double")
    rows = {r["transaction_id"]: r for r in contract.check_model_input(df).collect()}
    assert rows["a"]["tx_hour"] == 3 and rows["a"]["is_night_tx"] == 1 and rows["c"]["tx_hour"] == 2
    assert {"tx_hour", "is_night_tx"} <= set(rows["b"]["violations"])


def test_model_input_rejects(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 0, 0, 5, 1, 0, 1.0), ("b", None, 0, 0, None, 0, 0, 0.0)],
        "transaction_id string, amount double, is_high_amount int, is_card_not_present int, "
        "tx_hour int, is_night_tx int, is_risky_payment int, risk_score double")
    ok, bad = contract.split_model_input(df)
    assert [r["transaction_id"] for r in ok.collect()] == ["a"]
    assert bad.first()["violations"] == ["amount", "tx_hour"]


def test_quoted_amount_store_lenient_online_strict(spark):
    """FN10: the feature store takes numeric text for amount; the online scorer does not."""
    import json
    from riskflow.functions.features import online_features, store_features
    from riskflow.operators import silver
    ev = {"transaction_id": "t1", "user_id": "u", "merchant_id": "m", "device_id": "d",
          "amount": "2500.5", "currency": "USD", "timestamp": "2024-01-01T23:00:00+00:00",
          "payment_method": "upi", "card_present": False, "is_fraud": 1}
    raw = spark.createDataFrame([(json.dumps(ev),), (json.dumps({**ev, "amount": "abc"}),)],
                                "json_str string")
    fields = silver.consumer_fields(silver.parse_raw(raw))
    ok, bad = contract.split_contract(store_features(silver.store_view(fields)))
    r = ok.first()
    assert ok.count() == 1 and r["amount"] == 2500.5 and r["is_high_amount"] == 1
    assert bad.first()["violations"] == ["amount"]
    ok2, bad2 = contract.split_model_input(online_features(fields))
    assert ok2.count() == 0 and bad2.count() == 2


def test_card_present_python_truthiness(spark):
    """Consumers evaluate card_present with Python truthiness: non-empty string or non-zero
    number -> present (0), empty string / zero / null -> not present (1)."""
    import json
    from riskflow.functions.features import online_features, store_features
    from riskflow.operators import silver
    base = {"transaction_id": "t", "user_id": "u", "merchant_id": "m", "device_id": "d",
            "amount": 10.0, "currency": "USD", "timestamp": "2024-01-01T12:00:00+00:00",
            "payment_method": "upi", "is_fraud": 0}
    values = [True, False, "false", "", 0, 1, 2.5, None, {}, {"a": 1}, [], [0]]
    texts = [json.dumps({**base, "transaction_id": f"t{i}", "card_present": v})
             for i, v in enumerate(values)]
    raw = spark.createDataFrame([(t,) for t in texts], "json_str string")
    fields = silver.consumer_fields(silver.parse_raw(raw))
    store = {r["transaction_id"]: r["is_card_not_present"]
             for r in store_features(silver.store_view(fields)).collect()}
    online = {r["transaction_id"]: r["is_card_not_present"]
              for r in online_features(fields).collect()}
    expect = [0, 1, 0, 1, 1, 0, 0, 1, 1, 0, 1, 0]
    assert [store[f"t{i}"] for i in range(len(values))] == expect
    assert [online[f"t{i}"] for i in range(len(values))] == expect


def test_missing_and_nested_keys(spark):
    """A missing card_present, a numeric id and a numeric timestamp fail the contract, as the
    consumer drops such events; a nested key of the same name does not count."""
    import json
    from riskflow.functions.features import online_features, store_features
    from riskflow.operators import silver
    base = {"user_id": "u", "amount": 10.0, "timestamp": "2024-01-01T12:00:00+00:00", "is_fraud": 0}
    texts = [json.dumps({**base, "transaction_id": "none"}),
             json.dumps({"x": {"card_present": True}, **base, "transaction_id": "nested", "card_present": None}),
             json.dumps({**base, "transaction_id": 5, "card_present": True}),
             json.dumps({**base, "transaction_id": "num_ts", "timestamp": 20240101120000, "card_present": True})]
    fields = silver.consumer_fields(silver.parse_raw(spark.createDataFrame([(t,) for t in texts], "json_str string")))
    ok, bad = contract.split_contract(store_features(silver.store_view(fields)))
    assert [(r["transaction_id"], r["is_card_not_present"]) for r in ok.collect()] == [("nested", 1)]
    found = {r["transaction_id"]: r["violations"] for r in bad.collect()}
    assert found == {"none": ["is_card_not_present", "risk_score"], None: ["transaction_id"],
                     "num_ts": ["tx_hour", "timestamp"]}
    _, unscored = contract.split_model_input(online_features(fields))
    assert {r["transaction_id"] for r in unscored.collect()} >= {"none"}


def test_is_fraud_bool_accepted_by_store(spark):
    """The feature store takes JSON true/false as is_fraud 1/0 (Python bool is int); a float
    or a string still fails the contract."""
    import json
    from riskflow.functions.features import store_features
    from riskflow.operators import silver
    base = {"user_id": "u", "merchant_id": "m", "device_id": "d", "amount": 10.0,
            "currency": "USD", "timestamp": "2024-01-01T12:00:00+00:00", "card_present": True}
    vals = [True, False, 1, 1.5, "1"]
    raw = spark.createDataFrame([(json.dumps({**base, "transaction_id": f"t{i}", "is_fraud": v}),)
                                 for i, v in enumerate(vals)], "json_str string")
    fields = silver.consumer_fields(silver.parse_raw(raw))
    ok, bad = contract.split_contract(store_features(silver.store_view(fields)))
    assert {r["transaction_id"]: r["is_fraud"] for r in ok.collect()} == \
        {"t0": 1, "t1": 0, "t2": 1}
    assert sorted(r["transaction_id"] for r in bad.collect()) == ["t3", "t4"]
