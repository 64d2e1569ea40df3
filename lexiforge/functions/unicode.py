"""Unicode functions that Spark lacks, as Arrow-batched pandas functions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import TRANSLITERATION


@cache
def _marks() -> str:
    """Pattern of all combining characters, from the Unicode tables."""
    found = [i for i in range(sys.maxunicode + 1) if unicodedata.combining(chr(i))]
    starts = [i for i in found if not unicodedata.combining(chr(i - 1))]
    ends = [i for i in found if not unicodedata.combining(chr(min(i + 1, sys.maxunicode)))]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True)) + "]+"


#: All that separates words, for an engine whose classes are ASCII.
_BLANK = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]+"


def fold(texts: pa.Array) -> pa.Array:
    """Lookup folding of a batch: whole letters transliterated, the others decomposed and bared, blanks collapsed."""
    for letter, plain in TRANSLITERATION.items():
        texts = pc.replace_substring(texts, letter, plain)
    bared = pc.replace_substring_regex(pc.utf8_normalize(texts, "NFKD"), _marks(), "")
    return pc.utf8_trim(pc.replace_substring_regex(bared, _BLANK, " "), " ")


@F.pandas_udf(StringType())
def fold_lookup(s: pd.Series) -> pd.Series:
    return fold(pa.array(s, pa.string(), from_pandas=True)).to_pandas()


@F.pandas_udf(StringType())
def casefold(s: pd.Series) -> pd.Series:
    return s.map(str.casefold, na_action="ignore")


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def fold_key_exact(c):  # noqa: ANN001, ANN201
    """Key of the lookup indexes for any script."""
    return casefold(fold_lookup(c))
