"""Feature contract and scoring-input checks as columns, with a rejects split.

The reference raises on the first bad key and drops the message; here every row gets the full
list of violations and failing rows go to a rejects table, so nothing is lost silently.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURES, MODEL_INPUT

FEATURE_KEYS = [f.name for f in FEATURES.fields]
MODEL_KEYS = [f.name for f in MODEL_INPUT.fields]


_SCHEMAS = {"features": FEATURES, "model": MODEL_INPUT}


def _typed(df: DataFrame, schema) -> list:
    """Per contract field: the column in the contract type, or NULL when the field is absent
    or its value is not of that type (the rules differ, see ``_typed_column``)."""
    name = "features" if schema is FEATURES else "model"
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return list(_typed_columns(name, tuple(kinds.get(f.name, "") for f in schema.fields)))


@cache
def _typed_columns(schema_name: str, kinds: tuple) -> tuple:
    return tuple(_typed_column(schema_name, f, kind).alias(f.name)
                 for f, kind in zip(_SCHEMAS[schema_name].fields, kinds))


# Spark types that hold what the checks call an integer or a float
_INTEGERS, _FLOATS = ("byte", "short", "integer", "long"), ("float", "double")


def _typed_column(schema_name: str, f, kind: str) -> Column:
    """The feature contract is strict: an int field takes integers (and booleans, which are
    integers there), a float field floats, a text field text; nothing is converted. The
    request schema of the scorer converts: numbers and numeric text, but no fractional value
    for an int field."""
    c, wanted = F.col(f.name), f.dataType.typeName()
    nothing = F.lit(None).cast(f.dataType)
    if not kind:
        return nothing
    if schema_name == "features":
        fits = {"integer": (*_INTEGERS, "boolean"), "double": _FLOATS}.get(wanted, (wanted,))
        return c.try_cast(f.dataType) if kind in fits else nothing
    if wanted == "integer" and kind not in (*_INTEGERS, "boolean"):
        number = c.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return c.try_cast(f.dataType)


def passes(keys) -> Column:
    """All keys present and not NULL (a plain conjunction: stays in generated code)."""
    return _passes(tuple(keys))


@cache
def _passes(keys: tuple) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def violations(keys) -> Column:
    """ARRAY<STRING> of the keys that are missing or NULL (NULL is the wrong type for a strict
    contract), in contract order."""
    return _violations(tuple(keys))


@cache
def _violations(keys: tuple) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))


def check_features(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """Feature-store records in contract types plus ``violations``."""
    return df.select(*[F.col(c) for c in keep], *_typed(df, FEATURES)) \
        .withColumn("violations", violations(FEATURE_KEYS))


def split_contract(df: DataFrame, keep: tuple = ()):
    """(passing records in contract schema, rejects with violations)."""
    typed = df.select(*[F.col(c) for c in keep], *_typed(df, FEATURES))
    ok = typed.filter(passes(FEATURE_KEYS))
    bad = typed.filter(~passes(FEATURE_KEYS)).withColumn("violations", violations(FEATURE_KEYS))
    return ok, bad


def check_model_input(df: DataFrame, keep: tuple = ("transaction_id",)) -> DataFrame:
    """The 7 scoring inputs coerced to float/int like the request schema (no range check),
    plus ``violations``. A NULL after coercion would fail the vector assembler, so those rows
    must not reach the model."""
    return df.select(*[F.col(c) for c in keep], *_typed(df, MODEL_INPUT)) \
        .withColumn("violations", violations(MODEL_KEYS))


def split_model_input(df: DataFrame, keep: tuple = ("transaction_id",)):
    typed = df.select(*[F.col(c) for c in keep], *_typed(df, MODEL_INPUT))
    return (typed.filter(passes(MODEL_KEYS)),
            typed.filter(~passes(MODEL_KEYS)).withColumn("violations", violations(MODEL_KEYS)))
