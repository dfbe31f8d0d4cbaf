"""Keyword splitting."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: a token is a run of letters of any script.
TOKEN = r"\p{L}+"


def tokens(text: Column | str) -> Column:
    """Lower-cased letter runs in text order, repeats kept."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def keywords(text: Column | str) -> Column:
    """One row per token; a text without tokens keeps one row with a null keyword."""
    return F.explode_outer(tokens(text))


def register_kw_split(spark: SparkSession, name: str = "kw_split") -> None:
    """Make ``LATERAL kw_split(text)`` callable from SQL.

    The Python table function exists for SQL texts written against it; DataFrame code
    uses :func:`keywords`, which stays inside the JVM.
    """

    class KwSplit:
        def eval(self, text: str) -> Iterator[tuple[str]]:
            from itertools import groupby

            for letters, run in groupby(text.lower() if text is not None else "", str.isalpha):
                if letters:
                    yield ("".join(run),)

    spark.udtf.register(name, F.udtf(KwSplit, returnType="keyword string"))
