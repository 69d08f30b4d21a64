"""Text functions that need Python's own semantics, as Arrow-batched pandas functions."""

from __future__ import annotations

import difflib
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def surface(text: pd.Series) -> pd.Series:
    """NFKC, case folded, white space collapsed; null stays null."""
    return text.map(lambda t: None if t is None else re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t).casefold()).strip())


def ratio(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp ratio; null counts as empty."""
    return difflib.SequenceMatcher(None, a or "", b or "").ratio()


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """``ratio`` of two columns."""
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """A JSON text with sorted keys and no white space, numbers as Python writes them; null where it isn't JSON."""

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else json.dumps(json.loads(t), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return None

    return text.map(one)


def rounded(value, places: int):
    """Rounding as Python's: of the exact binary value, half to even."""

    @F.pandas_udf(DoubleType())
    def one(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None or v != v else round(v, places)).astype("float64")

    return one(value)
