"""Unicode functions that the JVM has no built-in for, as vectorized functions over Arrow batches.

Only values that need it are sent to Python: the others are null there and come out as they are.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

#: Text with none but these characters is in canonical composition (fixed value).
_COMPOSED = r"^[\x{0}-\x{2FF}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20AC}]*$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None else unicodedata.normalize("NFC", s))


@F.pandas_udf(StringType())
def _bare(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


@F.pandas_udf(BooleanType())
def _is_nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else unicodedata.is_normalized("NFC", s))


def nfc(text: str | Column) -> Column:
    """Text in canonical composition (P17); null stays null."""
    return F.coalesce(_nfc(F.when(~_c(text).rlike(_COMPOSED), _c(text))), _c(text))


def is_nfc(text: str | Column) -> Column:
    """Whether text is in canonical composition; null for null."""
    return F.when(_c(text).isNotNull(), F.coalesce(_is_nfc(F.when(~_c(text).rlike(_COMPOSED), _c(text))), F.lit(True)))


def without_marks(text: str | Column) -> Column:
    """Text without diacritics: compatibility decomposition less its combining marks; null stays null."""
    return F.coalesce(_bare(F.when(~_c(text).rlike(r"^[\x{0}-\x{7F}]*$"), _c(text))), _c(text))
