"""Cleaning variants (C9, C11-C14) and the frame-level cleaner.

A variant is a ``DataFrame -> DataFrame`` transformation that replaces one
text column, so it plugs into ``df.transform`` and into the MLlib pipeline's
cleaning stage.  The base clean, the dropping of words and the stemming (with a
memo of the stems seen) are row-local Arrow UDFs, which Spark runs in one pass, so
no variant shuffles and all work in the pipeline and on streams.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexis.functions import stopwords as sw
from lexis.functions import text as tx
from lexis.functions.porter import stem


def drop_words(c: str | Column, words: list[str]) -> Column:
    """Blank-separated tokens not in ``words``, re-joined with one space."""
    dropped = frozenset(words) | {""}

    @F.arrow_udf(T.StringType())
    def kept(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else " ".join([w for w in t.split(" ") if w not in dropped]) for t in texts.to_pylist()], pa.string())

    return kept(F.col(c) if isinstance(c, str) else c)


def clean_general(c: str | Column) -> Column:
    """C11: base clean, then drop the general list minus the negation whitelist."""
    return drop_words(tx.clean_text(c), sw.general_without_negations())


def clean_curated(c: str | Column) -> Column:
    """Base clean, then drop the curated grammar list."""
    return drop_words(tx.clean_text(c), sw.curated())


@F.arrow_udf(T.StringType())
def stem_words(texts: pa.Array) -> pa.Array:
    """Porter stem of every blank-separated token, order kept."""
    return pa.array([None if t is None else " ".join(map(stem, t.split(" "))) for t in texts.to_pylist()], pa.string())


def clean_stemmed(c: str | Column) -> Column:
    """Base clean, then the stem of every token."""
    return stem_words(tx.clean_text(c))


# C14 registry: variant name -> Column function.
VARIANTS: dict[str, Callable[[str | Column], Column]] = {
    "base": tx.clean_text,
    "stopwords_general": clean_general,
    "stopwords_curated": clean_curated,
    "stemming": clean_stemmed,
}
# What a variant adds to the base clean.
AFTER_BASE: dict[str, Callable[[Column], Column]] = {
    "base": lambda c: c,
    "stopwords_general": lambda c: drop_words(c, sw.general_without_negations()),
    "stopwords_curated": lambda c: drop_words(c, sw.curated()),
    "stemming": stem_words,
}


def clean_frame(df: DataFrame, text_col: str, variant: str = "base") -> DataFrame:
    """Replace ``text_col`` by its cleaned form, other columns preserved."""
    if variant not in VARIANTS:
        raise ValueError(f"Unknown variant: {variant!r}")
    return df.withColumn(text_col, VARIANTS[variant](F.col(text_col)))


def with_variants(df: DataFrame, text_col: str, variants: list[str]) -> DataFrame:
    """``df`` with a column ``clean_<variant>`` per variant: the base clean runs once a row for all of them."""
    if unknown := [v for v in variants if v not in AFTER_BASE]:
        raise ValueError(f"Unknown variant: {unknown[0]!r}")
    cleaned = df.withColumn("_base", tx.clean_text(F.col(text_col), shared=True))
    return cleaned.withColumns({f"clean_{v}": AFTER_BASE[v](F.col("_base")) for v in variants}).drop("_base")
