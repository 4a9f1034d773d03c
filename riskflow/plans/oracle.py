"""DuckDB SQL twin of every named query in ``catalog.py`` (same column names and types)."""

from .oracle_base import ONLINE, PARSED, STORE, TEXT

_TX_ONLY = PARSED.split(",\nparsed AS")[0]

_VALID_COLS = """transaction_id, user_id, merchant_id, device_id, amount, currency, timestamp,
  merchant_category, payment_method, card_present, location_city, location_state,
  location_country, ip_address, is_fraud"""

_MODEL = """amount, is_high_amount, is_card_not_present, tx_hour, is_night_tx, is_risky_payment,
  risk_score"""

_RULE_PRED = """CASE WHEN is_high_amount + is_card_not_present + is_night_tx >= 2 THEN 1 ELSE 0 END
    AS prediction,
  CAST(is_high_amount + is_card_not_present + is_night_tx AS DOUBLE) / 3.0 AS fraud_probability,
  1.0 - CAST(is_high_amount + is_card_not_present + is_night_tx AS DOUBLE) / 3.0
    AS non_fraud_probability"""

_TEST = STORE + """,
evalset AS (
  SELECT CAST(is_fraud AS DOUBLE) AS label, risk_score / 3.0 AS score,
    CASE WHEN risk_score >= 2 THEN 1.0 ELSE 0.0 END AS prediction
  FROM fstore
  WHERE ('0x' || substr(md5(transaction_id), 1, 8))::BIGINT % 10 >= 8
)"""

_F1 = """
cm AS (SELECT {by} label AS l, prediction AS p, count(*) AS c FROM {src} GROUP BY ALL),
act AS (SELECT {by} l, CAST(sum(c) AS DOUBLE) AS actual,
          CAST(sum(CASE WHEN l = p THEN c ELSE 0 END) AS DOUBLE) AS tp FROM cm GROUP BY ALL),
prd AS (SELECT {by} p AS l, CAST(sum(c) AS DOUBLE) AS predicted FROM cm GROUP BY ALL),
per AS (
  SELECT {act_by} act.l, actual, tp,
    CASE WHEN COALESCE(predicted, 0) = 0 THEN 0.0 ELSE tp / predicted END AS pr,
    tp / actual AS rc
  FROM act LEFT JOIN prd ON act.l = prd.l {join_by}
),
f1s AS (
  SELECT {by} sum(CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END * actual)
      / sum(actual) AS f1,
    sum(tp) / sum(actual) AS accuracy
  FROM per GROUP BY ALL
)"""

_LOG = ONLINE + """,
lg AS (
  SELECT *, row_number() OVER (ORDER BY inference_timestamp, transaction_id) AS rn,
    count(*) OVER () AS n
  FROM predlog
),
seg AS (
  SELECT *, CASE WHEN rn <= CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT)
    THEN 'baseline' ELSE 'recent' END AS segment
  FROM lg WHERE n >= 20
),
wide AS (
  SELECT
    avg(amount) FILTER (WHERE segment = 'baseline') AS b_avg_amount,
    avg(CAST(tx_hour AS DOUBLE)) FILTER (WHERE segment = 'baseline') AS b_avg_tx_hour,
    avg(risk_score) FILTER (WHERE segment = 'baseline') AS b_avg_risk_score,
    avg(fraud_probability) FILTER (WHERE segment = 'baseline') AS b_avg_fraud_probability,
    avg(CAST(prediction AS DOUBLE)) FILTER (WHERE segment = 'baseline')
      AS b_fraud_prediction_rate,
    avg(amount) FILTER (WHERE segment = 'recent') AS r_avg_amount,
    avg(CAST(tx_hour AS DOUBLE)) FILTER (WHERE segment = 'recent') AS r_avg_tx_hour,
    avg(risk_score) FILTER (WHERE segment = 'recent') AS r_avg_risk_score,
    avg(fraud_probability) FILTER (WHERE segment = 'recent') AS r_avg_fraud_probability,
    avg(CAST(prediction AS DOUBLE)) FILTER (WHERE segment = 'recent')
      AS r_fraud_prediction_rate
  FROM seg HAVING count(*) > 0
),
longf AS (
  SELECT 'avg_amount' AS metric, COALESCE(b_avg_amount, 0.0) AS base,
    COALESCE(r_avg_amount, 0.0) AS recent FROM wide
  UNION ALL SELECT 'avg_tx_hour', COALESCE(b_avg_tx_hour, 0.0), COALESCE(r_avg_tx_hour, 0.0)
    FROM wide
  UNION ALL SELECT 'avg_risk_score', COALESCE(b_avg_risk_score, 0.0),
    COALESCE(r_avg_risk_score, 0.0) FROM wide
  UNION ALL SELECT 'avg_fraud_probability', COALESCE(b_avg_fraud_probability, 0.0),
    COALESCE(r_avg_fraud_probability, 0.0) FROM wide
  UNION ALL SELECT 'fraud_prediction_rate', COALESCE(b_fraud_prediction_rate, 0.0),
    COALESCE(r_fraud_prediction_rate, 0.0) FROM wide
),
cmp AS (
  SELECT metric, base, recent, recent - base AS diff,
    CASE WHEN base <> 0 THEN (recent - base) / base * 100 ELSE 0.0 END AS pct
  FROM longf
),
report AS (
  SELECT metric, round(base, 4) AS baseline, round(recent, 4) AS recent,
    round(diff, 4) AS diff, round(pct, 2) AS pct_change, abs(pct) > 10 AS drift_detected
  FROM cmp
)"""

_EVAL_F1 = """evalset AS (
  SELECT CAST(is_fraud AS DOUBLE) AS label, CASE WHEN risk_score >= 2 THEN 1.0 ELSE 0.0 END AS prediction
  FROM fstore WHERE ('0x' || substr(md5(transaction_id), 1, 8))::BIGINT % 10 >= 8
),""" + _F1.format(by="", src="evalset", act_by="", join_by="").replace("cm AS", "cm2 AS").replace(
    "FROM cm ", "FROM cm2 ").replace("act AS", "act2 AS").replace("FROM act ", "FROM act2 act ").replace(
    "prd AS", "prd2 AS").replace("JOIN prd ", "JOIN prd2 prd ").replace("per AS", "per2 AS").replace(
    "FROM per ", "FROM per2 ").replace("f1s AS", "eval_f1 AS")

_RUNS = STORE + """,
lab AS (
  SELECT substr(timestamp, 1, 10) AS day, CAST(is_fraud AS DOUBLE) AS label,
    CASE WHEN risk_score >= 2 THEN 1.0 ELSE 0.0 END AS prediction
  FROM fstore
),""" + _F1.format(by="day,", src="lab", act_by="act.day,",
                   join_by="AND act.day = prd.day") + """,
runs AS (
  SELECT 'fraud_model' AS model_name, 'run-' || day AS run_id,
    CAST(dense_rank() OVER (ORDER BY day) AS INTEGER) AS version, day, f1 AS f1_score
  FROM f1s
)"""

_REASONS = """CASE WHEN no_text THEN 'empty_payload' ELSE concat_ws(',',
    CASE WHEN malformed THEN 'malformed_record' END,
    CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id' END,
    CASE WHEN user_id IS NULL THEN 'missing_user_id' END,
    CASE WHEN merchant_id IS NULL THEN 'missing_merchant_id' END,
    CASE WHEN device_id IS NULL THEN 'missing_device_id' END,
    CASE WHEN amount IS NULL THEN 'missing_amount' END,
    CASE WHEN currency IS NULL THEN 'missing_currency' END,
    CASE WHEN timestamp IS NULL THEN 'missing_timestamp' END,
    CASE WHEN amount <= 0 THEN 'non_positive_amount' END) END"""

_TEXTS = f""",
texts AS (SELECT event_id, {TEXT} AS json_str FROM txl)"""

_QUARANTINE = PARSED + _TEXTS + f"""
SELECT transaction_id, {_REASONS} AS reasons, json_str
FROM checked JOIN texts USING (event_id) WHERE NOT is_valid"""

ORACLES = {
    "bronze_json": _TX_ONLY + f"""
SELECT event_id, {TEXT} AS json_str FROM txl""",

    "silver_valid": PARSED + f"""
SELECT {_VALID_COLS} FROM checked WHERE is_valid""",

    "silver_quarantine_reasons": _QUARANTINE,

    "silver_partition_counts": PARSED + """
SELECT count(*) AS input_rows, count(*) FILTER (WHERE is_valid) AS valid_rows,
  count(*) FILTER (WHERE NOT is_valid) AS quarantine_rows
FROM checked""",

    "features_gold": PARSED + """
SELECT transaction_id, user_id, merchant_id, device_id, amount, currency,
  parsed_ts AS timestamp, merchant_category, payment_method, card_present, ip_address, is_fraud,
  CAST(hour(parsed_ts) AS INTEGER) AS tx_hour,
  CASE WHEN hour(parsed_ts) < 6 THEN 1 ELSE 0 END AS is_night_tx,
  CASE WHEN amount > 3000 THEN 1 ELSE 0 END AS is_high_amount,
  CASE WHEN NOT card_present THEN 1 ELSE 0 END AS is_card_not_present,
  CASE WHEN payment_method = 'credit_card' THEN 1 ELSE 0 END AS is_risky_payment,
  (CASE WHEN amount > 3000 THEN 1 ELSE 0 END)
    + (CASE WHEN NOT card_present THEN 1 ELSE 0 END)
    + (CASE WHEN payment_method = 'credit_card' THEN 1 ELSE 0 END)
    + (CASE WHEN hour(parsed_ts) < 6 THEN 1 ELSE 0 END) AS risk_score
FROM checked WHERE is_valid""",

    "features_store": STORE + """
SELECT transaction_id, amount, is_high_amount, is_card_not_present, tx_hour, is_night_tx,
  is_risky_payment, risk_score, is_fraud, timestamp
FROM fstore""",

    "features_online": ONLINE + f"""
SELECT transaction_id, {_MODEL} FROM online_f""",

    "rule_tiers": _TX_ONLY + """
SELECT rule_score,
  CASE WHEN rule_score >= 2 THEN 'high' ELSE 'low' END AS rule_tier,
  CASE WHEN rule_score >= 2 THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END
    AS expected_rate,
  count(*) AS rows, round(avg(is_fraud), 4) AS fraud_rate
FROM txl GROUP BY rule_score""",

    "feature_contract_violations": STORE + """
SELECT transaction_id, violations FROM store_v WHERE violations <> ''""",

    "scoring_input_rejects": ONLINE + """
SELECT transaction_id,
  concat_ws(',', CASE WHEN amount IS NULL THEN 'amount' END,
    CASE WHEN is_card_not_present IS NULL THEN 'is_card_not_present' END,
    CASE WHEN tx_hour IS NULL THEN 'tx_hour' END,
    CASE WHEN risk_score IS NULL THEN 'risk_score' END) AS violations
FROM online_f WHERE amount IS NULL OR tx_hour IS NULL OR is_card_not_present IS NULL""",

    "prediction_record_short": STORE + f"""
SELECT transaction_id, {_MODEL}, {_RULE_PRED} FROM fstore""",

    "prediction_record_rich": ONLINE + f"""
SELECT inference_timestamp, 'unknown' AS model_run_id, transaction_id, user_id,
  payment_method, card_present, {_MODEL}, prediction, fraud_probability,
  1.0 - fraud_probability AS non_fraud_probability
FROM predlog""",

    "training_frame": STORE + f"""
SELECT transaction_id, {_MODEL}, CAST(is_fraud AS DOUBLE) AS label FROM fstore""",

    "hash_split_counts": STORE + """
SELECT CASE WHEN ('0x' || substr(md5(transaction_id), 1, 8))::BIGINT % 10 < 8
    THEN 'train' ELSE 'test' END AS split,
  count(*) AS rows, sum(CAST(is_fraud AS DOUBLE)) AS positives
FROM fstore GROUP BY 1""",

    "eval_auc": _TEST + """,
g AS (
  SELECT score, CAST(sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
    CAST(sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
  FROM evalset GROUP BY score
),
c AS (
  SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
  FROM g
)
SELECT round(sum(pos * (neg_before + neg * 0.5)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""",

    "eval_f1": _TEST + "," + _F1.format(by="", src="evalset", act_by="", join_by="") + """
SELECT round(f1, 6) AS f1 FROM f1s""",

    "eval_accuracy": _TEST + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
FROM evalset""",

    "drift_segments": _LOG + """
SELECT segment, count(*) AS count, round(avg(amount), 4) AS avg_amount,
  round(avg(CAST(tx_hour AS DOUBLE)), 4) AS avg_tx_hour,
  round(avg(risk_score), 4) AS avg_risk_score,
  round(avg(fraud_probability), 4) AS avg_fraud_probability,
  round(avg(CAST(prediction AS DOUBLE)), 4) AS fraud_prediction_rate
FROM seg GROUP BY segment""",

    "drift_report": _LOG + """
SELECT * FROM report""",

    "drift_gauges": _LOG + """
SELECT metric, round(pct, 6) AS pct_change, CAST(abs(pct) > 10 AS INTEGER) AS drift_detected
FROM cmp WHERE metric <> 'avg_tx_hour'""",

    "drift_alerts": _LOG + """
SELECT metric, pct_change FROM report WHERE drift_detected""",

    "retrain_decision": _LOG + """
SELECT
  COALESCE(bool_or(drift_detected) FILTER (WHERE metric IN ('avg_risk_score', 'avg_amount')),
    FALSE) AS should_retrain,
  COALESCE(bool_or(drift_detected) FILTER (WHERE metric = 'avg_risk_score'), FALSE)
    AS risk_score_drift,
  COALESCE(bool_or(drift_detected) FILTER (WHERE metric = 'avg_amount'), FALSE)
    AS amount_drift
FROM report HAVING count(*) > 0""",

    "champion_history": _RUNS + """,
h AS (
  SELECT model_name, version, run_id, f1_score,
    count(*) OVER w AS n_prior,
    max(f1_score) OVER w AS prior_best
  FROM runs
  WINDOW w AS (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT model_name, version, run_id, round(f1_score, 6) AS f1_score,
  round(CASE WHEN n_prior > 0 THEN prior_best END, 6) AS champion_f1_before,
  n_prior = 0 OR f1_score > prior_best AS promoted
FROM h""",

    "current_champion": _RUNS + """,
h AS (
  SELECT model_name, version, run_id, f1_score,
    count(*) OVER w AS n_prior, max(f1_score) OVER w AS prior_best
  FROM runs
  WINDOW w AS (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
promoted AS (SELECT * FROM h WHERE n_prior = 0 OR f1_score > prior_best)
SELECT model_name, version, run_id, round(f1_score, 6) AS f1_score
FROM promoted WHERE version = (SELECT max(version) FROM promoted)""",

    "drift_gauge_rows": _LOG + """,
names AS (
  SELECT * FROM (VALUES
    ('avg_amount', 'fraud_avg_amount_pct_change', 'fraud_avg_amount_drift_detected'),
    ('avg_risk_score', 'fraud_avg_risk_score_pct_change', 'fraud_avg_risk_score_drift_detected'),
    ('avg_fraud_probability', 'fraud_avg_fraud_probability_pct_change',
     'fraud_avg_fraud_probability_drift_detected'),
    ('fraud_prediction_rate', 'fraud_prediction_rate_pct_change',
     'fraud_prediction_rate_drift_detected')) AS t(metric, pct_name, flag_name)
)
SELECT pct_name AS metric, round(pct, 6) AS value FROM cmp JOIN names USING (metric)
UNION ALL
SELECT flag_name, CAST(abs(pct) > 10 AS DOUBLE) FROM cmp JOIN names USING (metric)""",

    "latest_version": _RUNS + """
SELECT model_name,
  'week-' || strftime(date_trunc('week', CAST(day AS DATE)), '%Y-%m-%d') AS run_id,
  max(version) AS latest_version
FROM runs GROUP BY ALL""",

    # thresholds of 1 %, so that several metrics count as drifted
    "drift_alerts_1pct": _LOG + """
SELECT metric, round(pct, 2) AS pct_change FROM cmp WHERE abs(pct) > 1""",

    "retrain_decision_1pct": _LOG + """
SELECT
  COALESCE(bool_or(abs(pct) > 1) FILTER (WHERE metric IN ('avg_risk_score', 'avg_amount')),
    FALSE) AS should_retrain,
  COALESCE(bool_or(abs(pct) > 1) FILTER (WHERE metric = 'avg_risk_score'), FALSE)
    AS risk_score_drift,
  COALESCE(bool_or(abs(pct) > 1) FILTER (WHERE metric = 'avg_amount'), FALSE)
    AS amount_drift
FROM cmp HAVING count(*) > 0""",

    "drift_gauges_1pct": _LOG + """
SELECT metric, round(pct, 6) AS pct_change, CAST(abs(pct) > 1 AS INTEGER) AS drift_detected
FROM cmp WHERE metric <> 'avg_tx_hour'""",

    "drift_min_rows": _LOG + """
SELECT (SELECT count(*) FROM predlog) AS log_rows, 0::BIGINT AS report_rows""",

    "store_training_frame": STORE + f"""
SELECT transaction_id, {_MODEL}, CAST(is_fraud AS DOUBLE) AS label FROM fstore""",

    "registry_cycle": _RUNS + ", " + _EVAL_F1 + """,
every AS (
  SELECT run_id, version, f1_score FROM runs
  UNION ALL SELECT 'run-all', (SELECT max(version) + 1 FROM runs), f1 FROM eval_f1
),
h AS (
  SELECT *, count(*) OVER w AS n_prior, max(f1_score) OVER w AS prior_best FROM every
  WINDOW w AS (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
champion AS (SELECT version, run_id FROM h WHERE n_prior = 0 OR f1_score > prior_best
             ORDER BY version DESC LIMIT 1)
SELECT 'run-all' AS run_id, (SELECT max(version) FROM every) AS latest_version,
  (SELECT max(version) + 1 FROM every) AS next_version, champion.version AS champion_version,
  champion.run_id AS champion_run FROM champion""",

    # a forest has no SQL twin: what is determined is checked
    "scored_sample": STORE + """
SELECT transaction_id, CAST(is_fraud AS DOUBLE) AS label, amount, risk_score,
  TRUE AS probabilities_sum_to_1, TRUE AS prediction_follows
FROM fstore WHERE ('0x' || substr(md5(transaction_id), 1, 8))::BIGINT % 10 >= 8
ORDER BY transaction_id, event_id LIMIT 20""",

    "rf_metrics": STORE + """,
s AS (SELECT CAST(is_fraud AS DOUBLE) AS label,
        ('0x' || substr(md5(transaction_id), 1, 8))::BIGINT % 10 >= 8 AS test FROM fstore)
SELECT count(*) FILTER (WHERE NOT test) AS train_rows, count(*) FILTER (WHERE test) AS test_rows,
  sum(label) FILTER (WHERE NOT test) AS train_positives, sum(label) FILTER (WHERE test) AS test_positives,
  '50' AS num_trees, '5' AS max_depth,
  'amount,is_high_amount,is_card_not_present,tx_hour,is_night_tx,is_risky_payment,risk_score'
    AS feature_cols,
  TRUE AS f1_is_evaluators, TRUE AS accuracy_is_evaluators, TRUE AS auc_in_range
FROM s""",
}

# Streams must equal their batch twins (the scored stream stamps inference time at run time,
# so that column is left out)
ORACLES["stream_silver"] = ORACLES["silver_valid"]
ORACLES["stream_two_writers"] = ORACLES["silver_valid"]
ORACLES["stream_quarantine"] = _QUARANTINE
ORACLES["stream_bronze"] = _TX_ONLY + f"""
SELECT {TEXT} AS json_str FROM txl"""
ORACLES["stream_gold"] = ORACLES["features_gold"]
ORACLES["stream_gold_replay"] = ORACLES["features_gold"]
ORACLES["stream_features"] = ORACLES["features_store"]
ORACLES["stream_scored_store"] = ORACLES["prediction_record_short"]
ORACLES["stream_scored"] = ONLINE + f"""
SELECT 'unknown' AS model_run_id, transaction_id, user_id, payment_method, card_present,
  {_MODEL}, prediction, fraud_probability, 1.0 - fraud_probability AS non_fraud_probability
FROM predlog"""
ORACLES["stream_rejects"] = STORE + _TEXTS + """
SELECT transaction_id, CASE WHEN violations = '' THEN 'no_champion' ELSE 'feature_contract' END AS stage,
  violations, json_str
FROM store_v JOIN texts USING (event_id)"""

ORACLES["stream_drift_report"] = ORACLES["drift_report"]
ORACLES["drift_report_json"] = ORACLES["drift_report"]
ORACLES["drift_report_arrival"] = ORACLES["drift_report"].replace(
    "SELECT parsed_ts AS inference_timestamp,", "SELECT event_id, parsed_ts AS inference_timestamp,").replace(
    "ORDER BY inference_timestamp, transaction_id", "ORDER BY event_id")
ORACLES["daily_auc"] = STORE + """,
lab AS (
  SELECT substr(timestamp, 1, 10) AS day, CAST(is_fraud AS DOUBLE) AS label, risk_score * 1000000 + amount AS score
  FROM fstore WHERE TRY_CAST(substr(timestamp, 1, 10) AS DATE) IS NOT NULL
),
g AS (
  SELECT day, score, CAST(sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
    CAST(sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
  FROM lab GROUP BY day, score
),
c AS (
  SELECT day, pos, neg, COALESCE(sum(neg) OVER (PARTITION BY day ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
  FROM g
)
SELECT 'run-' || day AS run_id, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
  THEN round(sum(pos * (neg_before + neg * 0.5)) / (sum(pos) * sum(neg)), 6) END AS auc
FROM c GROUP BY day"""
