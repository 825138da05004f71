"""C2 full repair for rows flagged as mis-decoded (Arrow ``pandas_udf``).

Only rows matching the mojibake marker run through Python; every other row
keeps the native repair subset of ``lexis.functions.text.fix_encoding``.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions import text as tx

_CONTROL = re.compile(r"[\x00-\x08\x0E-\x1F\x7F]")
_MARKERS = re.compile("[â€™œžŸšŠ¢�ÃÂ]|[\x80-\x9f]")
_QUOTES = str.maketrans({**{c: "'" for c in tx.SINGLE_QUOTES}, **{c: '"' for c in tx.DOUBLE_QUOTES}})


def repair(s: str) -> str:
    """Undo UTF-8-read-as-cp1252/latin-1 while that lowers the marker count,
    then unescape HTML (no '<' present), NFKC-fold width forms and ligatures,
    drop control characters and normalise quotes."""
    if s is None:
        return None
    while True:  # every pass lowers the marker count, so this ends
        fixed = None
        for codec in ("cp1252", "latin-1"):
            try:
                fixed = s.encode(codec).decode("utf-8")
                break
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
        if fixed is None or len(_MARKERS.findall(fixed)) >= len(_MARKERS.findall(s)):
            break
        s = fixed
    if "<" not in s:
        s = html.unescape(s)
    s = "".join(unicodedata.normalize("NFKC", ch) if ("！" <= ch <= "～" or "ﬀ" <= ch <= "ﬆ")
                else ch for ch in s)
    return _CONTROL.sub("", s).translate(_QUOTES)


@F.pandas_udf(T.StringType())
def repair_udf(texts: pd.Series) -> pd.Series:
    return texts.map(repair)


def fix_encoding_full(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Adds ``out_col``: the Python repair where the marker pattern matches (only
    those texts travel to Python), the native one elsewhere."""
    flagged = tx.has_mojibake(text_col)
    repaired = repair_udf(F.when(flagged, F.col(text_col)))
    return df.withColumn(out_col, F.when(flagged, repaired).otherwise(tx.fix_encoding(text_col)))
