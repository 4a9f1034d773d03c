"""Risk features as column expressions, defined once and shared by training and scoring.

The reference computes the same six features three different ways (gold stream, feature
store, online scorer) and a fourth rule score in its simulator. ``FeatureSpec`` captures the
differences as parameters; the presets reproduce each variant. All are plain column
expressions, so they run inside whole-stage codegen on batch and streaming frames alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import flag, hour_from_text, hour_iso_wallclock, hour_session

FLAG_NAMES = ("is_high_amount", "is_card_not_present", "is_night_tx", "is_risky_payment")


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    high_threshold: float          # amount strictly above this is "high"
    night_rule: str                # "lt6" (hour < 6) or "lt6_or_gt22"
    risky_rule: str                # "credit_card" or "high_and_cnp"
    score_terms: tuple             # flags summed into risk_score
    score_type: str                # "int" or "double"
    hour_rule: str                 # "session", "text" or "iso"
    null_card_present_flag: int | None  # is_card_not_present when card_present is NULL
    nan_is_high: bool              # Spark orders NaN above every number; Python's > says no


# The three production variants and their parameters
GOLD = FeatureSpec("gold", 3000.0, "lt6", "credit_card",
                   ("is_high_amount", "is_card_not_present", "is_risky_payment", "is_night_tx"),
                   "int", "session", 0, True)
STORE = FeatureSpec("store", 2000.0, "lt6_or_gt22", "high_and_cnp",
                    ("is_high_amount", "is_card_not_present", "is_night_tx"),
                    "double", "text", None, False)
ONLINE = FeatureSpec("online", 2000.0, "lt6_or_gt22", "credit_card",
                     ("is_high_amount", "is_card_not_present", "is_night_tx", "is_risky_payment"),
                     "double", "iso", None, False)
PRESETS = {s.name: s for s in (GOLD, STORE, ONLINE)}

# Simulator rule score and its tiers (score >= 2 -> expected fraud rate 0.8)
RULE_HIGH_AMOUNT = 2000.0
RULE_TIER_MIN_SCORE = 2
RULE_TIER_RATES = {"high": 0.8, "low": 0.1}


def _hour(spec: FeatureSpec, ts_text: Column) -> Column:
    if spec.hour_rule == "session":
        return hour_session(ts_text)
    if spec.hour_rule == "text":
        return hour_from_text(ts_text)
    if spec.hour_rule == "iso":
        return hour_iso_wallclock(ts_text)
    raise ValueError(spec.hour_rule)


def _night(spec: FeatureSpec, hour: Column) -> Column:
    if spec.night_rule == "lt6":
        return flag(hour < 6)
    return flag((hour < 6) | (hour > 22))


def feature_columns(spec: FeatureSpec, amount: Column = None, card_present: Column = None,
                    timestamp: Column = None, payment_method: Column = None) -> dict:
    """name -> Column for tx_hour and the flags of ``spec``, plus risk_score.

    Flags are built from the inputs directly (no reference to other output columns), so one
    ``select`` computes all of them and the optimizer collapses them into one projection.
    With the default input columns the expressions are built once per process.
    """
    if amount is None and card_present is None and timestamp is None and payment_method is None:
        return dict(_default_feature_columns(spec))
    return _feature_columns(spec, amount, card_present, timestamp, payment_method)


@cache
def _default_feature_columns(spec: FeatureSpec) -> tuple:
    return tuple(_feature_columns(spec, None, None, None, None).items())


def _feature_columns(spec, amount, card_present, timestamp, payment_method) -> dict:
    amount = F.col("amount") if amount is None else amount
    card_present = F.col("card_present") if card_present is None else card_present
    timestamp = F.col("timestamp") if timestamp is None else timestamp
    payment_method = F.col("payment_method") if payment_method is None else payment_method

    hour = _hour(spec, timestamp)
    above = amount > F.lit(spec.high_threshold)
    high = flag(above if spec.nan_is_high else above & ~F.isnan(amount))
    # without a value there is no flag (the consumers fail on a missing key), or a fixed one
    cnp = F.when(card_present.isNull(), F.lit(spec.null_card_present_flag).cast("int")) \
        .otherwise(flag(~card_present))
    night = _night(spec, hour)
    if spec.risky_rule == "credit_card":
        risky = flag(payment_method == F.lit("credit_card"))
    else:
        risky = flag((high == 1) & (cnp == 1))
    flags = {"is_high_amount": high, "is_card_not_present": cnp, "is_night_tx": night,
             "is_risky_payment": risky}
    score = None
    for t in spec.score_terms:
        score = flags[t] if score is None else score + flags[t]
    score = score.cast("double" if spec.score_type == "double" else "int")
    return {"tx_hour": hour, **flags, "risk_score": score}


def gold_features(silver: DataFrame) -> DataFrame:
    """Gold: silver without ``location``, ``timestamp`` parsed, then the six gold features
    in the reference's column order. Bad timestamp text gives a NULL timestamp and hour, not a
    failed stream (``try_to_timestamp``)."""
    cols = feature_columns(GOLD)
    base = [c for c in silver.columns if c not in ("location", "timestamp", "_malformed")]
    out = []
    for c in base:
        if c == "currency":
            out += [F.col(c), F.try_to_timestamp(F.col("timestamp")).alias("timestamp")]
        else:
            out.append(F.col(c))
    order = ["tx_hour", "is_night_tx", "is_high_amount", "is_card_not_present",
             "is_risky_payment", "risk_score"]
    return silver.select(*out, *[cols[n].alias(n) for n in order])


def store_features(tx: DataFrame, keep: tuple = ()) -> DataFrame:
    """Feature-store record (10 keys) from a parsed transaction, preset ``store``, behind the
    ``keep`` columns."""
    return tx.select(*[F.col(c) for c in keep], *_store_columns())


@cache
def _store_columns() -> tuple:
    cols = feature_columns(STORE)
    return (
        F.col("transaction_id"),
        F.col("amount"),
        cols["is_high_amount"].alias("is_high_amount"),
        cols["is_card_not_present"].alias("is_card_not_present"),
        cols["tx_hour"].alias("tx_hour"),
        cols["is_night_tx"].alias("is_night_tx"),
        cols["is_risky_payment"].alias("is_risky_payment"),
        cols["risk_score"].alias("risk_score"),
        F.col("is_fraud"),
        F.col("timestamp"),
    )


def model_input_columns(spec: FeatureSpec) -> list:
    """The 7 model inputs in canonical order, computed with ``spec``."""
    return list(_model_input_columns(spec))


@cache
def _model_input_columns(spec: FeatureSpec) -> tuple:
    cols = feature_columns(spec)
    return (F.col("amount").alias("amount"),
            cols["is_high_amount"].alias("is_high_amount"),
            cols["is_card_not_present"].alias("is_card_not_present"),
            cols["tx_hour"].alias("tx_hour"),
            cols["is_night_tx"].alias("is_night_tx"),
            cols["is_risky_payment"].alias("is_risky_payment"),
            cols["risk_score"].cast("double").alias("risk_score"))


def online_features(tx: DataFrame, keep=("transaction_id",)) -> DataFrame:
    """Online scorer's 7 inputs (preset ``online``), keeping ``keep`` columns in front."""
    return tx.select(*[F.col(c) for c in keep], *model_input_columns(ONLINE))


def rule_score(amount: Column = None, card_present: Column = None,
               ts: Column = None) -> Column:
    """Simulator rule score: high amount (> 2000) + card not present + night by the UTC clock
    (hour < 6 or > 22), as INT 0-3. ``ts`` is a timestamp (UTC)."""
    amount = F.col("amount") if amount is None else amount
    card_present = F.col("card_present") if card_present is None else card_present
    ts = F.col("event_ts") if ts is None else ts
    hour = F.hour(ts)
    return (flag(amount > F.lit(RULE_HIGH_AMOUNT)) + flag(~card_present)
            + flag((hour < 6) | (hour > 22)))


def rule_tier(score: Column) -> Column:
    """'high' when the rule score is at least 2, else 'low'."""
    return F.when(score >= RULE_TIER_MIN_SCORE, F.lit("high")).otherwise(F.lit("low"))


def rule_tier_rate(tier: Column) -> Column:
    """Expected fraud rate of a rule tier."""
    return F.when(tier == "high", F.lit(RULE_TIER_RATES["high"])) \
        .otherwise(F.lit(RULE_TIER_RATES["low"]))
