"""Lenient text-to-type conversion under ANSI mode.

The source job converted all-string extracts with plain ``CAST`` on a
non-ANSI engine, where malformed text silently became NULL.  Under ANSI
mode (the default from Spark 4) a plain cast raises instead, so each
conversion here is written with ``try_cast`` and, for integers, a pattern
that reproduces the old truncating behaviour (``'650.0' -> 650``,
``'-1.9' -> -1``).  Nothing touches the session configuration.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from storefront_etl.operators._types import ref

ColumnOrName = Column | str

# Fixed values.
# Optionally signed number with a fractional part, the integer digits
# possibly empty ('.5', '-.5', '5.').
FRACTION_PATTERN = r"^[+-]?[0-9]*[.][0-9]*$"
# Characters the old cast trimmed from both ends: U+0000 .. U+0020 and U+007F.
TRIMMED_CHARS = "".join(chr(i) for i in range(0x21)) + chr(0x7F)
# A bare optionally signed integer (no fraction, no exponent).
STRICT_INT_PATTERN = r"^[+-]?[0-9]+$"
# The only digit-free texts a floating-point cast accepts (compared lowercased,
# after trimming): infinities and NaN.
FLOAT_SPECIAL_LITERALS = (
    "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan",
)


def _col(c: ColumnOrName) -> Column:
    """A name stands for the column of exactly that name, dots included."""
    return ref(c) if isinstance(c, str) else c


def lenient_int(c: ColumnOrName) -> Column:
    """Text -> INT the way the non-ANSI cast did it.

    Surrounding whitespace and control characters are ignored, a fractional
    part is truncated toward zero ('-1.9' -> -1, '.5' -> 0, '5.' -> 5), and
    anything else (exponents, junk, empty text, a lone sign, overflow)
    becomes NULL.

    ``try_cast`` is only applied to text already known to be digits: its
    failure path is exception-based and ~10x slower than a pattern test, so
    junk never reaches it.  The fraction pattern is evaluated only for text
    that is not a plain integer.
    """
    text = F.btrim(_col(c), F.lit(TRIMMED_CHARS))
    fraction = F.regexp_extract(text, FRACTION_PATTERN, 0)  # '' when no match
    whole = F.substring_index(fraction, ".", 1)
    truncated = F.when(
        fraction != "",
        F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int")),
    )
    return F.when(text.rlike(STRICT_INT_PATTERN), text.try_cast("int")).otherwise(truncated)


def strict_int(c: ColumnOrName) -> Column:
    """Text -> INT accepting only a signed run of digits (else NULL).

    Surrounding whitespace and control characters are ignored.  The pattern
    guard keeps junk away from ``try_cast`` (see lenient_int).  Used for the
    postcode-range bounds, where the source job used Python's ``int()``;
    unlike ``int()``, digit-group underscores and non-ASCII digits are
    rejected (the range then yields no rows)."""
    t = F.btrim(_col(c), F.lit(TRIMMED_CHARS))
    return F.when(t.rlike(STRICT_INT_PATTERN), t).try_cast("int")


def lenient_cast(c: ColumnOrName, data_type: str | DataType) -> Column:
    """Text -> float/double/timestamp/date, NULL for malformed input.

    For ``int``/``integer`` the truncating :func:`lenient_int` is used so
    that every target type keeps the non-ANSI semantics.
    """
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    if name.lower() in ("int", "integer"):
        return lenient_int(c)
    if name.lower() in ("float", "double"):
        # Same result as a bare try_cast, but text without a digit (junk,
        # empty) skips the cast's slow exception-based failure path.
        text = _col(c)
        special = F.lower(F.btrim(text, F.lit(TRIMMED_CHARS))).isin(list(FLOAT_SPECIAL_LITERALS))
        return F.when(text.rlike("[0-9]") | special, text).try_cast(data_type)
    return _col(c).try_cast(data_type)
