"""Typing of text cells by declared column affinity.

Every feed value arrives as text.  ``integer`` columns take the text when it
is a well-formed number with an integral value (``5``, `` 5 ``, ``007``,
``+3``, ``1.0``, ``1e3``, ``5.``); ``real`` columns take any well-formed
number.  Everything else becomes NULL and is reported as a reject (an empty
cell is NULL but not a reject).  Accepted text is exactly what
``NUMERIC_TEXT`` describes; ``nan``, ``1d``, ``0x1F`` and ``Infinity``, which
a bare cast would accept, are kept out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUE: the shape of a well-formed decimal or scientific number.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_EXACT_DOUBLE_LIMIT = 2.0 ** 53


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Characters a well-formed number may contain.  Text made only of these is
# then cast: the cast enforces the structure, the character check keeps out
# what the cast would accept but SQL would not (``NaN``, ``Infinity``,
# ``1d``, ``1f``, ``0x1p3``).  Same result as the NUMERIC_TEXT guard, without
# running a regex per value.
_NUMBER_CHARS = "0123456789+-.eE \t\n\r\f\u000b"


def _number_chars_only(t: Column) -> Column:
    return F.length(F.translate(t, _NUMBER_CHARS, "")) == 0


def real_affinity(text) -> Column:
    t = _c(text)
    return F.when(_number_chars_only(t), t.try_cast("double"))


def integer_affinity(text) -> Column:
    t = _c(text)
    as_double = t.try_cast("double")
    integral_double = F.when(
        _number_chars_only(t)
        & (F.abs(as_double) < F.lit(_EXACT_DOUBLE_LIMIT))
        & (as_double == F.floor(as_double)),
        as_double.cast("bigint"),
    )
    # A plain integer casts directly; anything else takes the double path.
    return F.coalesce(t.try_cast("bigint"), integral_double)


def typed_value(text, affinity: str) -> Column:
    if affinity == "integer":
        return integer_affinity(text)
    if affinity == "real":
        return real_affinity(text)
    return _c(text)
