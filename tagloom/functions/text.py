"""Text expressions; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.fixed_values import WHITESPACE

# Anything that is not whitespace in the sense of WHITESPACE, and maximal runs of it.
_NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"
_WORD = _NOT_BLANK + "+"
_TOKEN_BREAK = r"[^a-z0-9]+"


def strip(text: Column) -> Column:
    """Remove surrounding Unicode whitespace (SQL ``trim`` alone removes only spaces).

    Trimming a character set walks the whole text, so texts whose first and last
    characters are no whitespace skip it.
    """
    blanks = F.lit(WHITESPACE)
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    padded = F.contains(blanks, first) | F.contains(blanks, last)
    return F.when(padded, F.btrim(text, blanks)).otherwise(text)


def is_blank(text: Column) -> Column:
    """True for text without any non-whitespace character; stops at the first one."""
    return ~F.rlike(text, F.lit(_NOT_BLANK))


def label_key(label: Column) -> Column:
    """Lower-case, blanks to underscores. Not stripped: outer blanks become underscores."""
    return F.replace(F.lower(label), F.lit(" "), F.lit("_"))


def title(name: Column) -> Column:
    """``fine_tuned`` -> ``Fine Tuned``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_WORD))


def all_tokens(text: Column) -> Column:
    """Lower-case ASCII alphanumeric tokens in order; the text's ends may add empty ones."""
    return F.split(F.lower(text), _TOKEN_BREAK)


def distinct_tokens(text: Column) -> Column:
    """The distinct tokens of :func:`all_tokens` without empty ones."""
    return F.array_distinct(F.filter(all_tokens(text), lambda token: token != ""))


def encoder_token_count(factory: Callable[[], Any]):
    """Arrow UDF counting tokens with an encoder whose vocabulary the workers can load.

    ``factory`` returns an object with ``encode(text) -> list``; it runs once per task.
    """

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory().encode
        for batch in batches:
            yield batch.map(lambda text: len(encode(text)) if text is not None else 0)

    return count


def seeded_hash(seed: Column | int, *parts: Column) -> Column:
    """Hex digest of ``seed:part:...``: the same on every engine, machine and partitioning."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    pieces: list[Column] = [seed.cast("string")]
    for part in parts:
        pieces += [F.lit(":"), part.cast("string")]
    return F.md5(F.concat(*pieces))


def hash_number(digest: Column) -> Column:
    """First 32 bits of a hex digest as a non-negative bigint."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def as_text(value: Column, data_type: T.DataType) -> Column:
    """Value as parameter text: ``True``/``False``, shortest float form, comma-joined lists."""
    if isinstance(data_type, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return _float_text(value.cast("double"))
    if isinstance(data_type, T.ArrayType):
        return F.array_join(F.transform(value, lambda v: as_text(v, data_type.elementType)), ",")
    return value.cast("string")


def _float_text(value: Column) -> Column:
    java = value.cast("string")
    fixed = F.rtrim(java.cast("decimal(38,20)").cast("string"), F.lit("0"))
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    size = F.abs(value)
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), scientific)
        .otherwise(fixed)
    )
