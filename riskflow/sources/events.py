"""Transactions derived from the driver's ``events`` table.

The reference generates random transactions; here every field is a deterministic function of
an ``events`` row, so the same rows can be rebuilt in SQL by the oracle. The derivation is a
pure projection: no shuffle, and it scales with the ``events`` scan.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import md5_prefix_int

# Damage of the raw text (event_id divisor -> what is unusual in it)
MISSING_USER_ID_MOD = 29      # user_id key omitted
NEGATIVE_AMOUNT_MOD = 31      # amount negated
BROKEN_TEXT_MOD = 37          # whole text replaced by the literal {bad
TEXT_AMOUNT_MOD = 41          # amount given as the string "abc"
BAD_TIMESTAMP_MOD = 43        # timestamp given as "not-a-ts"
NULL_TEXT_MOD = 47            # no text at all
BLANK_TEXT_MOD = 53           # blanks only
QUOTED_AMOUNT_MOD = 59        # amount given as a string that holds the number
ZERO_AMOUNT_MOD = 61          # amount 0
NO_CARD_PRESENT_MOD = 67      # card_present key omitted
NULL_CARD_PRESENT_MOD = 71    # card_present null, behind a nested key of the same name
TEXT_CARD_PRESENT_MOD = 73    # card_present given as the string "yes"
NO_IS_FRAUD_MOD = 79          # is_fraud key omitted
BOOL_IS_FRAUD_MOD = 83        # is_fraud given as true or false
OFFSET_MOD = 89               # the wall clock carries the offset +05:30
AMOUNT_2000_MOD = 97          # amount exactly at the consumers' threshold
AMOUNT_3000_MOD = 101         # amount exactly at the gold threshold
REPEATED_ID_MOD = 103         # one of five transaction ids shared by many events
NUMBER_ID_MOD = 107           # transaction_id given as a JSON number
MONTH_TIMESTAMP_MOD = 113     # timestamp without a day
BROKEN_TEXT = "{bad"
BAD_TIMESTAMP = "not-a-ts"
MONTH_TIMESTAMP = "2026-04"
OFFSET = "+05:30"

# Rule tiers of the simulated fraud label
RULE_HIGH_AMOUNT = 2000.0
HIGH_TIER_RATE_PCT = 80
LOW_TIER_RATE_PCT = 10


def _iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """One transaction per event, typed like silver, plus ``event_id`` and ``event_ts``."""
    return events.select(*_transaction_columns())


@cache
def _transaction_columns() -> tuple:
    # built once per process: column expressions are plain, name-based trees
    e = F.col("event_id")
    u = F.col("user_id")
    amount = F.col("value") * F.lit(50)
    card_present = (e % 2) == 0
    hour = F.hour(F.col("ts"))
    night = (hour < 6) | (hour > 22)
    rule = (F.when(amount > RULE_HIGH_AMOUNT, 1).otherwise(0)
            + F.when(~card_present, 1).otherwise(0)
            + F.when(night, 1).otherwise(0))
    h = md5_prefix_int(e.cast("string"))
    is_fraud = F.when(rule >= 2, (h % 100) < HIGH_TIER_RATE_PCT) \
        .otherwise((h % 100) < LOW_TIER_RATE_PCT).cast("int")
    return (
        e.alias("event_id"),
        F.col("ts").alias("event_ts"),
        e.cast("string").alias("transaction_id"),
        u.cast("string").alias("user_id"),
        F.concat(F.lit("m"), (e % 97).cast("string")).alias("merchant_id"),
        F.concat(F.lit("d"), (u % 31).cast("string")).alias("device_id"),
        amount.alias("amount"),
        F.lit("USD").alias("currency"),
        _iso_utc(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("merchant_category"),
        F.when(e % 3 == 0, "credit_card").when(e % 3 == 1, "debit_card").otherwise("upi")
         .alias("payment_method"),
        card_present.alias("card_present"),
        F.struct(F.concat(F.lit("c"), (u % 10).cast("string")).alias("city"),
                 F.concat(F.lit("s"), (u % 5).cast("string")).alias("state"),
                 F.lit("USA").alias("country")).alias("location"),
        F.concat(F.lit("10.0."), (u % 256).cast("string"), F.lit("."),
                 (e % 256).cast("string")).alias("ip_address"),
        is_fraud.alias("is_fraud"),
    )


def raw_events(events: DataFrame, inject_bad_rows: bool = True) -> DataFrame:
    """Raw JSON text per event (``event_id``, ``json_str``), as a producer would publish it.

    With ``inject_bad_rows`` the text of some events is damaged (rules above) so that silver,
    the feature contract and the scoring-input checks all see rejects.
    """
    return transactions_from_events(events).select("event_id",
                                                   _raw_text(inject_bad_rows).alias("json_str"))


@cache
def _raw_text(inject_bad_rows: bool) -> Column:
    if not inject_bad_rows:
        return F.to_json(F.struct(*[F.col(c) for c in _JSON_FIELDS]))

    def hit(divisor: int) -> Column:
        return F.col("event_id") % divisor == 0

    nothing = F.lit(None)
    amount = (F.when(hit(AMOUNT_2000_MOD), F.lit(2000.0)).when(hit(AMOUNT_3000_MOD), F.lit(3000.0))
              .otherwise(F.col("amount")))
    amount = (F.when(hit(ZERO_AMOUNT_MOD), F.lit(0.0)).when(hit(NEGATIVE_AMOUNT_MOD), -amount)
              .otherwise(amount))
    as_text = hit(TEXT_AMOUNT_MOD) | hit(QUOTED_AMOUNT_MOD)
    odd_card = hit(NO_CARD_PRESENT_MOD) | hit(NULL_CARD_PRESENT_MOD) | hit(TEXT_CARD_PRESENT_MOD)
    odd_fraud = hit(NO_IS_FRAUD_MOD) | hit(BOOL_IS_FRAUD_MOD)
    wall_clock = F.substring("timestamp", 1, 26)
    fields = {
        "transaction_id": F.when(hit(NUMBER_ID_MOD), nothing)
                           .when(hit(REPEATED_ID_MOD), F.concat(F.lit("dup-"), (F.col("event_id") % 5).cast("string")))
                           .otherwise(F.col("transaction_id")),
        "user_id": F.when(~hit(MISSING_USER_ID_MOD), F.col("user_id")),
        "amount": F.when(~as_text, amount),
        "timestamp": F.when(hit(BAD_TIMESTAMP_MOD), F.lit(BAD_TIMESTAMP))
                      .when(hit(MONTH_TIMESTAMP_MOD), F.lit(MONTH_TIMESTAMP))
                      .when(hit(OFFSET_MOD), F.concat(wall_clock, F.lit(OFFSET)))
                      .otherwise(F.col("timestamp")),
        "card_present": F.when(~odd_card, F.col("card_present")),
        "is_fraud": F.when(~odd_fraud, F.col("is_fraud")),
    }
    # to_json drops null fields, which is how a key is omitted; unusual values follow as text
    text = F.to_json(F.struct(*[fields.get(c, F.col(c)).alias(c) for c in _JSON_FIELDS]))
    nested = F.when(hit(NULL_CARD_PRESENT_MOD), F.lit('{"extra":{"card_present":true},')).otherwise(F.lit("{"))
    extras = [
        F.when(hit(TEXT_AMOUNT_MOD), F.lit(',"amount":"abc"'))
         .when(hit(QUOTED_AMOUNT_MOD), F.concat(F.lit(',"amount":"'), amount.cast("string"), F.lit('"'))),
        F.when(hit(NO_CARD_PRESENT_MOD), nothing).when(hit(NULL_CARD_PRESENT_MOD), F.lit(',"card_present":null'))
         .when(hit(TEXT_CARD_PRESENT_MOD), F.lit(',"card_present":"yes"')),
        F.when(hit(NO_IS_FRAUD_MOD), nothing)
         .when(hit(BOOL_IS_FRAUD_MOD), F.concat(F.lit(',"is_fraud":'), (F.col("is_fraud") == 1).cast("string"))),
        F.when(hit(NUMBER_ID_MOD), F.concat(F.lit(',"transaction_id":'), F.col("transaction_id"))),
    ]
    text = F.concat(nested, F.regexp_replace(text, r"^\{|\}$", ""),
                    *[F.coalesce(x, F.lit("")) for x in extras], F.lit("}"))
    return (F.when(hit(NULL_TEXT_MOD), nothing).when(hit(BLANK_TEXT_MOD), F.lit("  "))
            .when(hit(BROKEN_TEXT_MOD), F.lit(BROKEN_TEXT)).otherwise(text))


_JSON_FIELDS = ["transaction_id", "user_id", "merchant_id", "device_id", "amount", "currency",
                "timestamp", "merchant_category", "payment_method", "card_present", "location",
                "ip_address", "is_fraud"]
