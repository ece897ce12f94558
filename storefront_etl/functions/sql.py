"""The library's semantics for SQL text: temporary SQL functions, no Python in the plan.

After ``register_functions(spark)`` a query may say::

    SELECT lenient_int(qty), region_of_state(lower(state)) FROM extract
    SELECT t.locality, p.cep_prefix FROM ranges t, LATERAL postcode_prefixes(t.postcode_range) p

They are SQL expressions that Catalyst inlines and optimises; each gives what
the Column builder of the same name gives.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from storefront_etl.functions.calendar import DAY_NAMES, MONTH_NAMES
from storefront_etl.functions.casts import FLOAT_SPECIAL_LITERALS, FRACTION_PATTERN, STRICT_INT_PATTERN, TRIMMED_CHARS
from storefront_etl.functions.labels import CATEGORY_DEFAULT, CATEGORY_GROUPS, REGION_DEFAULT, REGION_GROUPS


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _names(values: Iterable[str]) -> str:
    return ", ".join(_quoted(v) for v in values)


def _labels(groups: Iterable[tuple[str, Sequence[str]]], default: str) -> str:
    whens = " ".join(f"WHEN v IN ({_names(values)}) THEN {_quoted(label)}" for label, values in groups)
    return f"CASE {whens} ELSE {_quoted(default)} END"


def _name_of(values: Sequence[str]) -> str:
    return f"coalesce(CASE WHEN n BETWEEN 1 AND {len(values)} THEN element_at(array({_names(values)}), n) END, {_quoted(values[-1])})"


# Surrounding control characters, as a literal that needs no escapes.
_TRIMMED = f"decode(unhex('{TRIMMED_CHARS.encode().hex()}'), 'UTF-8')"
_TEXT = f"btrim(v, {_TRIMMED})"
_WHOLE = f"substring_index({_TEXT}, '.', 1)"


def _strict(text: str) -> str:
    """A run of digits as INT, spelled out (SQL functions can't be used in a generator)."""
    trimmed = f"btrim({text}, {_TRIMMED})"
    return f"try_cast(CASE WHEN {trimmed} RLIKE '{STRICT_INT_PATTERN}' THEN {trimmed} END AS INT)"


# name -> (parameters, result type, expression)
SCALARS = {
    "strict_int": ("v STRING", "INT", _strict("v")),
    "lenient_int": (
        "v STRING", "INT",
        f"CASE WHEN {_TEXT} RLIKE '{STRICT_INT_PATTERN}' THEN try_cast({_TEXT} AS INT) WHEN {_TEXT} RLIKE '{FRACTION_PATTERN}' THEN "
        f"CASE WHEN {_WHOLE} IN ('', '+', '-') THEN 0 ELSE try_cast({_WHOLE} AS INT) END END",
    ),
    "lenient_double": (
        "v STRING", "DOUBLE", f"try_cast(CASE WHEN v RLIKE '[0-9]' OR lower({_TEXT}) IN ({_names(FLOAT_SPECIAL_LITERALS)}) THEN v END AS DOUBLE)",
    ),
    "region_of_state": ("v STRING", "STRING", _labels(REGION_GROUPS, REGION_DEFAULT)),
    "category_group": ("v STRING", "STRING", _labels(CATEGORY_GROUPS, CATEGORY_DEFAULT)),
    "day_of_week_name": ("n INT", "STRING", _name_of(DAY_NAMES)),
    "month_name_of": ("n INT", "STRING", _name_of(MONTH_NAMES)),
}
_LOW, _HIGH = (_strict(f"split_part(split_part(r, ' a ', {side}), '-', 1)") for side in (1, 2))
# One row per prefix of a range text; none for NULL, malformed or reversed ones.
TABLES = {
    "postcode_prefixes": (
        "r STRING", "cep_prefix INT", f"SELECT explode(CASE WHEN {_LOW} <= {_HIGH} THEN sequence({_LOW}, {_HIGH}) ELSE CAST(array() AS ARRAY<INT>) END)",
    ),
}


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the temporary functions, named with ``prefix``; existing ones of these names are replaced.  Gives the names."""
    for name, (parameters, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
    for name, (parameters, result, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE({result}) RETURN {body}")
    return [f"{prefix}{name}" for name in (*SCALARS, *TABLES)]
