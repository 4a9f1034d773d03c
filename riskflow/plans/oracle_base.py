"""DuckDB SQL building blocks for the oracle: the same derivations as ``riskflow.sources.events``
and the silver / feature rules, written independently in SQL over the driver's views."""

# Transactions derived from events, plus the bad-row injection flags
TX = """WITH
tx AS (
  SELECT event_id, ts AS event_ts,
    CAST(event_id AS VARCHAR) AS transaction_id,
    CAST(user_id AS VARCHAR) AS user_id,
    'm' || CAST(event_id % 97 AS VARCHAR) AS merchant_id,
    'd' || CAST(user_id % 31 AS VARCHAR) AS device_id,
    value * 50 AS amount,
    'USD' AS currency,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
    event_type AS merchant_category,
    CASE event_id % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' ELSE 'upi' END
      AS payment_method,
    event_id % 2 = 0 AS card_present,
    'c' || CAST(user_id % 10 AS VARCHAR) AS location_city,
    's' || CAST(user_id % 5 AS VARCHAR) AS location_state,
    'USA' AS location_country,
    '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR)
      AS ip_address,
    ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT AS h,
    (CASE WHEN value * 50 > 2000 THEN 1 ELSE 0 END)
      + (CASE WHEN NOT (event_id % 2 = 0) THEN 1 ELSE 0 END)
      + (CASE WHEN hour(ts) < 6 OR hour(ts) > 22 THEN 1 ELSE 0 END) AS rule_score,
    event_id % 47 = 0 AS f_null, event_id % 53 = 0 AS f_blank, event_id % 37 = 0 AS f_broken,
    event_id % 47 = 0 OR event_id % 53 = 0 OR event_id % 37 = 0 AS gone,
    event_id % 29 = 0 AS f_no_user,
    event_id % 41 = 0 AS f_text_amount, event_id % 59 = 0 AS f_quoted,
    event_id % 43 = 0 AS f_bad_ts, event_id % 113 = 0 AS f_month, event_id % 89 = 0 AS f_offset,
    event_id % 67 = 0 AS f_no_card, event_id % 71 = 0 AS f_null_card, event_id % 73 = 0 AS f_text_card,
    event_id % 79 = 0 AS f_no_fraud, event_id % 83 = 0 AS f_bool_fraud,
    event_id % 107 = 0 AS f_num_id,
    CASE WHEN event_id % 61 = 0 THEN 0.0
      ELSE (CASE WHEN event_id % 97 = 0 THEN 2000.0 WHEN event_id % 101 = 0 THEN 3000.0
                 ELSE value * 50 END)
        * (CASE WHEN event_id % 31 = 0 THEN -1 ELSE 1 END) END::DOUBLE AS sent_amount,
    CASE WHEN event_id % 103 = 0 AND event_id % 107 <> 0
      THEN 'dup-' || CAST(event_id % 5 AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS sent_id
  FROM events
),
txl AS (
  SELECT *, CAST(CASE WHEN rule_score >= 2 THEN h % 100 < 80 ELSE h % 100 < 10 END AS INTEGER)
    AS is_fraud FROM tx
)"""

# What parsing the injected raw text yields, field by field
PARSED = TX + """,
parsed AS (
  SELECT event_id, event_ts, rule_score, gone, f_null OR f_blank AS no_text,
    NOT (f_null OR f_blank) AND (f_broken OR f_text_amount OR f_quoted
      OR (f_text_card AND NOT f_no_card AND NOT f_null_card) OR (f_bool_fraud AND NOT f_no_fraud))
      AS malformed,
    CASE WHEN gone THEN NULL ELSE sent_id END AS transaction_id,
    CASE WHEN gone OR f_num_id THEN NULL ELSE sent_id END AS id_strict,
    CASE WHEN gone OR f_no_user THEN NULL ELSE user_id END AS user_id,
    CASE WHEN gone THEN NULL ELSE merchant_id END AS merchant_id,
    CASE WHEN gone THEN NULL ELSE device_id END AS device_id,
    CASE WHEN gone OR f_text_amount OR f_quoted THEN NULL ELSE sent_amount END AS amount,
    CASE WHEN gone OR f_text_amount THEN NULL ELSE sent_amount END AS amount_lenient,
    CASE WHEN gone THEN NULL ELSE currency END AS currency,
    CASE WHEN gone THEN NULL WHEN f_bad_ts THEN 'not-a-ts' WHEN f_month THEN '2026-04'
      WHEN f_offset THEN substr(timestamp, 1, 26) || '+05:30' ELSE timestamp END AS timestamp,
    CASE WHEN gone OR f_bad_ts THEN NULL WHEN f_month THEN TIMESTAMP '2026-04-01'
      WHEN f_offset THEN event_ts - INTERVAL '5 hours 30 minutes' ELSE event_ts END AS parsed_ts,
    gone OR f_bad_ts OR f_month AS no_iso_day,
    CASE WHEN gone THEN NULL ELSE merchant_category END AS merchant_category,
    CASE WHEN gone THEN NULL ELSE payment_method END AS payment_method,
    CASE WHEN gone OR f_no_card OR f_null_card OR f_text_card THEN NULL ELSE card_present END
      AS card_present,
    CASE WHEN gone OR f_no_card THEN NULL WHEN f_null_card THEN FALSE WHEN f_text_card THEN TRUE
      ELSE card_present END AS card_truthy,
    CASE WHEN gone THEN NULL ELSE location_city END AS location_city,
    CASE WHEN gone THEN NULL ELSE location_state END AS location_state,
    CASE WHEN gone THEN NULL ELSE location_country END AS location_country,
    CASE WHEN gone THEN NULL ELSE ip_address END AS ip_address,
    CASE WHEN gone OR f_no_fraud OR f_bool_fraud THEN NULL ELSE is_fraud END AS is_fraud,
    CASE WHEN gone OR f_no_fraud THEN NULL ELSE is_fraud END AS fraud_lenient
  FROM txl
),
checked AS (
  SELECT *, COALESCE(transaction_id IS NOT NULL AND user_id IS NOT NULL
      AND merchant_id IS NOT NULL AND device_id IS NOT NULL AND amount IS NOT NULL
      AND amount > 0 AND currency IS NOT NULL AND timestamp IS NOT NULL, FALSE) AS is_valid
  FROM parsed
)"""

# The raw text, byte for byte: JSON built by hand in the key order and number formatting that
# to_json uses, and the unusual values as text behind it
TEXT = """(CASE WHEN f_null THEN NULL WHEN f_blank THEN '  ' WHEN f_broken THEN '{bad' ELSE
    CASE WHEN f_null_card THEN '{"extra":{"card_present":true},' ELSE '{' END
    || CASE WHEN f_num_id THEN '' ELSE '"transaction_id":"' || sent_id || '",' END
    || CASE WHEN f_no_user THEN '' ELSE '"user_id":"' || user_id || '",' END
    || '"merchant_id":"' || merchant_id || '","device_id":"' || device_id || '"'
    || CASE WHEN f_text_amount OR f_quoted THEN '' ELSE ',"amount":' || CAST(sent_amount AS VARCHAR) END
    || ',"currency":"USD","timestamp":"'
    || CASE WHEN f_bad_ts THEN 'not-a-ts' WHEN f_month THEN '2026-04'
         WHEN f_offset THEN substr(timestamp, 1, 26) || '+05:30' ELSE timestamp END || '"'
    || ',"merchant_category":"' || merchant_category || '","payment_method":"'
    || payment_method || '"'
    || CASE WHEN f_no_card OR f_null_card OR f_text_card THEN ''
         ELSE ',"card_present":' || CASE WHEN card_present THEN 'true' ELSE 'false' END END
    || ',"location":{"city":"' || location_city || '","state":"' || location_state
    || '","country":"USA"}'
    || ',"ip_address":"' || ip_address || '"'
    || CASE WHEN f_no_fraud OR f_bool_fraud THEN '' ELSE ',"is_fraud":' || CAST(is_fraud AS VARCHAR) END
    || CASE WHEN f_text_amount THEN ',"amount":"abc"'
         WHEN f_quoted THEN ',"amount":"' || CAST(sent_amount AS VARCHAR) || '"' ELSE '' END
    || CASE WHEN f_no_card THEN '' WHEN f_null_card THEN ',"card_present":null'
         WHEN f_text_card THEN ',"card_present":"yes"' ELSE '' END
    || CASE WHEN f_no_fraud THEN '' WHEN f_bool_fraud
         THEN ',"is_fraud":' || CASE WHEN is_fraud = 1 THEN 'true' ELSE 'false' END ELSE '' END
    || CASE WHEN f_num_id THEN ',"transaction_id":' || transaction_id ELSE '' END
    || '}' END)"""

# Feature-store variant over every parsed row (the consumer reads raw, not silver)
STORE = PARSED + """,
store AS (
  SELECT event_id, id_strict AS transaction_id, amount_lenient AS amount, event_ts, is_valid,
    CASE WHEN amount_lenient > 2000 AND NOT isnan(amount_lenient) THEN 1 ELSE 0 END AS is_high_amount,
    CASE WHEN card_truthy IS NULL THEN NULL WHEN card_truthy THEN 0 ELSE 1 END AS is_card_not_present,
    TRY_CAST(substr(timestamp, 12, 2) AS INTEGER) AS tx_hour,
    timestamp, fraud_lenient AS is_fraud
  FROM checked
),
store_f AS (
  SELECT event_id, transaction_id, amount, is_high_amount, is_card_not_present, tx_hour,
    CASE WHEN tx_hour < 6 OR tx_hour > 22 THEN 1 ELSE 0 END AS is_night_tx,
    CASE WHEN is_high_amount = 1 AND is_card_not_present = 1 THEN 1 ELSE 0 END
      AS is_risky_payment,
    CAST(is_high_amount + is_card_not_present
      + (CASE WHEN tx_hour < 6 OR tx_hour > 22 THEN 1 ELSE 0 END) AS DOUBLE) AS risk_score,
    is_fraud, timestamp, event_ts
  FROM store
),
store_v AS (
  SELECT *, concat_ws(',',
    CASE WHEN transaction_id IS NULL THEN 'transaction_id' END,
    CASE WHEN amount IS NULL THEN 'amount' END,
    CASE WHEN is_high_amount IS NULL THEN 'is_high_amount' END,
    CASE WHEN is_card_not_present IS NULL THEN 'is_card_not_present' END,
    CASE WHEN tx_hour IS NULL THEN 'tx_hour' END,
    CASE WHEN is_night_tx IS NULL THEN 'is_night_tx' END,
    CASE WHEN is_risky_payment IS NULL THEN 'is_risky_payment' END,
    CASE WHEN risk_score IS NULL THEN 'risk_score' END,
    CASE WHEN is_fraud IS NULL THEN 'is_fraud' END,
    CASE WHEN timestamp IS NULL THEN 'timestamp' END) AS violations
  FROM store_f
),
fstore AS (SELECT * FROM store_v WHERE violations = '')"""

# Online variant (7 model inputs) over every parsed row, and the scorable subset
ONLINE = STORE + """,
online AS (
  SELECT event_id, transaction_id, event_ts, amount, parsed_ts, user_id, payment_method,
    card_truthy AS card_present,
    CASE WHEN amount > 2000 AND NOT isnan(amount) THEN 1 ELSE 0 END AS is_high_amount,
    CASE WHEN card_truthy IS NULL THEN NULL WHEN card_truthy THEN 0 ELSE 1 END AS is_card_not_present,
    CASE WHEN NOT no_iso_day THEN TRY_CAST(substr(timestamp, 12, 2) AS INTEGER) END
      AS tx_hour,
    CASE WHEN payment_method = 'credit_card' THEN 1 ELSE 0 END AS is_risky_payment
  FROM checked
),
online_f AS (
  SELECT event_id, transaction_id, event_ts, parsed_ts, user_id, payment_method, card_present,
    amount, is_high_amount, is_card_not_present, tx_hour,
    CASE WHEN tx_hour < 6 OR tx_hour > 22 THEN 1 ELSE 0 END AS is_night_tx,
    is_risky_payment,
    CAST(is_high_amount + is_card_not_present
      + (CASE WHEN tx_hour < 6 OR tx_hour > 22 THEN 1 ELSE 0 END) + is_risky_payment AS DOUBLE)
      AS risk_score
  FROM online
),
scorable AS (
  SELECT * FROM online_f
  WHERE amount IS NOT NULL AND tx_hour IS NOT NULL AND is_card_not_present IS NOT NULL
),
predlog AS (
  SELECT parsed_ts AS inference_timestamp, transaction_id, user_id, payment_method,
    card_present, amount, is_high_amount,
    is_card_not_present, tx_hour, is_night_tx, is_risky_payment, risk_score,
    CAST(is_high_amount + is_card_not_present + is_night_tx AS DOUBLE) / 3.0
      AS fraud_probability,
    CASE WHEN is_high_amount + is_card_not_present + is_night_tx >= 2 THEN 1 ELSE 0 END
      AS prediction
  FROM scorable
)"""
