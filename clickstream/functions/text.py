"""Charset repair."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Characters Latin-1 does not have.
FOREIGN = r"[^\x00-\xFF]"


def recode(df: DataFrame, charset: str = "UTF-8", column: str = "value") -> DataFrame:
    """Repair text whose bytes were taken for Latin-1 although they are `charset`.

    Characters outside Latin-1 count as "?" and undecodable bytes become U+FFFD, so that a
    dirty line never fails the job. UTF-8, the default, runs on built-in expressions and
    leaves ASCII lines, as many bytes as characters, alone.
    """
    text = F.col(column)
    raw = F.encode(F.regexp_replace(text, FOREIGN, "?"), "ISO-8859-1")
    if charset.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        ascii_only = F.octet_length(text) == F.char_length(text)
        repaired = F.when(ascii_only, text).otherwise(F.make_valid_utf8(raw.cast("string")))
    else:
        repaired = _decode(raw, charset)
    return df.withColumn(column, repaired)


def _decode(raw: Column, charset: str) -> Column:
    """Decode with replacement; `decode` itself fails on bad bytes and refuses e.g. GBK.

    A whole batch is decoded at once: its values are joined by a zero byte, which ends any broken
    character and is no part of another in the charsets that contain ASCII.
    """

    @F.pandas_udf("string")
    def decode(batch: pd.Series) -> pd.Series:
        known = batch.notna()
        values = batch[known].map(bytes)
        joined = b"\0".join(values)
        texts = joined.decode(charset, "replace").split("\0")
        if len(texts) != max(1, len(values)):  # a value has a zero byte itself
            texts = [value.decode(charset, "replace") for value in values]
        out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
        if len(values):
            out[known] = texts
        return out

    return decode(raw)
