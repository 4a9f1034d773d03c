"""Silver: parse raw JSON text into typed transactions and route every row to exactly one of
valid or quarantine, with the reasons a row was rejected.

Validity is the reference's rule (seven required fields present and amount > 0). It is
computed once as a boolean column, so valid and quarantine are exact complements, also under
three-valued logic. The parse happens once per row: downstream filters read the parsed struct
instead of re-parsing per predicate.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COL, REQUIRED_FIELDS, TRANSACTION, TRANSACTION_PARSE

DATA = "data"
# Reason codes, in the order they are reported
EMPTY_PAYLOAD = "empty_payload"
MALFORMED_RECORD = "malformed_record"
NON_POSITIVE_AMOUNT = "non_positive_amount"
REASON_CODES = [EMPTY_PAYLOAD, MALFORMED_RECORD] + \
    [f"missing_{f}" for f in REQUIRED_FIELDS] + [NON_POSITIVE_AMOUNT]

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def parse_raw(bronze: DataFrame, text_col: str = "json_str") -> DataFrame:
    """Add ``data``: the typed transaction parsed from ``text_col`` (plus ``_malformed`` with
    the text of a record that did not fully convert). NULL/blank text gives ``data`` NULL; bad
    JSON gives a struct of NULLs; a wrongly typed field gives NULL for that field only."""
    return bronze.select("*", _parsed_column(text_col))


@cache
def _parsed_column(text_col: str) -> Column:
    parsed = F.from_json(F.col(text_col), TRANSACTION_PARSE, JSON_OPTIONS)
    # The parse sits in a Generate node (a one-element explode). Predicates on parsed fields
    # cannot be pushed below a generator's output, so the text is parsed once per row instead
    # of once per predicate that mentions a field (plain projections would be inlined into
    # every pushed-down filter).
    return F.explode(F.array(parsed)).alias(DATA)


def _field(name: str) -> Column:
    return F.col(f"{DATA}.{name}")


@cache
def is_valid() -> Column:
    """The silver rule as one never-NULL boolean."""
    cond = F.col(DATA).isNotNull()
    for f in REQUIRED_FIELDS:
        cond = cond & _field(f).isNotNull()
    cond = cond & (_field("amount") > 0)
    return F.coalesce(cond, F.lit(False))


@cache
def reasons() -> Column:
    """ARRAY<STRING> of reason codes for a rejected row, in ``REASON_CODES`` order; empty for
    a valid row."""
    checks = [F.when(F.col(DATA).isNull(), F.lit(EMPTY_PAYLOAD)),
              F.when(_field(CORRUPT_COL).isNotNull(), F.lit(MALFORMED_RECORD))]
    checks += [F.when(F.col(DATA).isNotNull() & _field(f).isNull(), F.lit(f"missing_{f}"))
               for f in REQUIRED_FIELDS]
    checks.append(F.when(_field("amount") <= 0, F.lit(NON_POSITIVE_AMOUNT)))
    return F.when(is_valid(), F.array().cast("array<string>")) \
        .otherwise(F.array_compact(F.array(*checks)))


def with_validity(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("is_valid", is_valid())


def flatten_valid(parsed: DataFrame, keep: tuple = ()) -> DataFrame:
    """Valid rows, flattened to the transaction schema (``keep`` columns in front)."""
    return parsed.filter(is_valid()).select(*[F.col(c) for c in keep], *transaction_fields())


VARIANT = "_variant"


def _value(name: str) -> Column:
    """A top-level value of the text as VARIANT; SQL NULL when the key is absent."""
    return F.try_variant_get(F.col(VARIANT), f"$.{name}", "variant")


def _text_of(name: str) -> Column:
    return F.try_variant_get(F.col(VARIANT), f"$.{name}", "string")


def _kind(name: str) -> Column:
    return F.schema_of_variant(_value(name))


@cache
def lenient_amount() -> Column:
    """The amount as the feature-store consumer reads it (FN10): a JSON number, or text that
    holds a number ("12.5"); NULL otherwise."""
    typed = _field("amount")
    return F.when(typed.isNotNull(), typed).when(_kind("amount") == "STRING", _text_of("amount").try_cast("double"))


@cache
def bool_as_int_is_fraud() -> Column:
    """``is_fraud`` as the feature store accepts it: an integer, or a JSON boolean as 1 / 0
    (a Python ``bool`` is an ``int``); floats and strings stay NULL (contract violation)."""
    typed = _field("is_fraud")
    return F.when(typed.isNotNull(), typed).when(
        _kind("is_fraud") == "BOOLEAN", F.try_variant_get(F.col(VARIANT), "$.is_fraud", "boolean").cast("int"))


@cache
def truthy_card_present() -> Column:
    """``card_present`` with Python truthiness, as the consumers evaluate it: false, null, 0,
    an empty string, object or array are not present; everything else is. NULL only when the
    text has no such key."""
    kind = _kind("card_present")
    shown = F.to_json(_value("card_present"))
    return (F.when(_value("card_present").isNull(), F.lit(None).cast("boolean"))
            .when(kind == "VOID", F.lit(False))
            .when(kind == "BOOLEAN", shown == "true")
            .when(kind == "STRING", shown != '""')
            .when(kind.startswith("OBJECT"), shown != "{}")
            .when(kind.startswith("ARRAY"), shown != "[]")
            .otherwise(shown.try_cast("double") != 0))


def consumer_fields(parsed: DataFrame, keep: tuple = (), text_col: str = "json_str"):
    """Every parsed row as transaction fields, with ``card_present`` under Python truthiness,
    plus what the feature store reads differently (``amount_lenient``, ``is_fraud_lenient``,
    and ``id_strict``, ``timestamp_strict``: NULL unless the text holds a JSON string): what
    the consumers see, since they read raw events. The text is parsed once more, into a
    VARIANT that all these values come from (behind a generator, as in ``parse_raw``)."""
    fields = [truthy_card_present().alias("card_present") if f.name == "card_present"
              else _field(f.name).alias(f.name) for f in TRANSACTION.fields]
    strict = {c: F.when(_kind(c) == "STRING", _field(c)) for c in ("transaction_id", "timestamp")}
    variant = F.explode(F.array(F.try_parse_json(F.col(text_col)))).alias(VARIANT)
    return parsed.select("*", variant).select(
        *[F.col(c) for c in keep], *fields, lenient_amount().alias("amount_lenient"),
        bool_as_int_is_fraud().alias("is_fraud_lenient"), strict["transaction_id"].alias("id_strict"),
        strict["timestamp"].alias("timestamp_strict"))


CONSUMER_ONLY = ("amount_lenient", "is_fraud_lenient", "id_strict", "timestamp_strict")


def store_view(fields: DataFrame) -> DataFrame:
    """Consumer fields as the feature store reads them, in place of the typed ones."""
    return (fields.withColumn("amount", F.col("amount_lenient"))
            .withColumn("is_fraud", F.col("is_fraud_lenient"))
            .withColumn("transaction_id", F.col("id_strict"))
            .withColumn("timestamp", F.col("timestamp_strict")).drop(*CONSUMER_ONLY))


@cache
def transaction_fields() -> tuple:
    """The parsed struct flattened to the transaction columns."""
    return tuple(_field(f.name).alias(f.name) for f in TRANSACTION.fields)


def quarantine(parsed: DataFrame, text_col: str = "json_str", keep: tuple = ()) -> DataFrame:
    """Rejected rows: original text and why."""
    return parsed.filter(~is_valid()).select(*[F.col(c) for c in keep], F.col(text_col),
                                            reasons().alias("reasons"))


def split_valid(bronze: DataFrame, text_col: str = "json_str", keep: tuple = ()):
    """(valid, quarantine) from raw text. Callers that materialise both should persist the
    parsed frame once (the streaming writer does, per micro-batch)."""
    parsed = parse_raw(bronze, text_col)
    return flatten_valid(parsed, keep), quarantine(parsed, text_col, keep)


def silver_counts(bronze: DataFrame, text_col: str = "json_str") -> DataFrame:
    """Input, valid and quarantined row counts in one aggregation pass."""
    v = is_valid()
    return parse_raw(bronze, text_col).agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count(F.when(v, 1)).alias("valid_rows"),
        F.count(F.when(~v, 1)).alias("quarantine_rows"))
