"""Scalar column expressions: coercion, text hygiene, clipping, encoding.

All of them are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as "no value" after trimming.
TEXT_NULLS = ("", "NA", "nan", "None")

# Cells the CSV reader treats as null (the public pandas default list).
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: characters stripped from both ends of a text cell.
BLANKS = " \t\n\r\x0b\x0c"

def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def norm_text(c: Column) -> Column:
    """Trim and turn the null tokens into null."""
    text = strip(c.cast("string"))
    return F.when(~text.isin(*TEXT_NULLS), text)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_double(c: Column, *, is_text: bool = True) -> Column:
    """Number or null; bad text, NaN and Java-only spellings become null."""
    if not is_text:
        return nan_to_null(c.cast("double"))
    text = strip(c)
    value = text.try_cast("double")
    # The JVM also reads "1.0d", "1f" and hexadecimal numbers; these are not numbers here.
    low = F.lower(text)
    suffix = low.endswith("d") | (low.endswith("f") & ~low.endswith("inf"))
    return F.when(~F.isnan(value) & ~suffix & ~low.contains("x"), value)


def to_date(c: Column, fmt: str = "yyyy-MM-dd", *, is_text: bool = True) -> Column:
    """Date or null; a partial or differently ordered date is null, not a guess."""
    if not is_text:
        return c.cast("date")
    return F.try_to_date(strip(c), fmt)


def encode_label(c: Column, positive: str, negative: str, *, strict: bool = True) -> Column:
    """1/0 label. Any other non-null value raises (strict) or becomes null."""
    encoded = F.when(c == positive, F.lit(1)).when(c == negative, F.lit(0))
    if not strict:
        return encoded
    return encoded.when(
        c.isNotNull(),
        F.raise_error(F.concat(F.lit(f"labels must be {positive} or {negative}, got "), c)).cast("int"),
    )


def month(c: Column) -> Column:
    return F.month(c).cast("double")


def day_of_year(c: Column) -> Column:
    return F.dayofyear(c).cast("double")


def missing_flag(c: Column) -> Column:
    return c.isNull().cast("double")


def fill_cat(c: Column, token: str = "Unknown") -> Column:
    return F.coalesce(c, F.lit(token))


def clip(c: Column, low: float, high: float) -> Column:
    """Clip that keeps null null (least/greatest alone would return the bound)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def swap(c: Column, a: str, b: str) -> Column:
    return F.when(c == a, F.lit(b)).when(c == b, F.lit(a)).otherwise(c)


def decide(score: Column, threshold: Column | float) -> Column:
    return score >= (threshold if isinstance(threshold, Column) else F.lit(float(threshold)))


def action(flag: Column, yes: str, no: str) -> Column:
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def ratio(num: Column, den: Column, empty: float | None = 0.0) -> Column:
    """num/den in doubles; `empty` where the denominator is zero."""
    return F.when(den == 0, F.lit(empty).cast("double")).otherwise(
        num.cast("double") / F.when(den != 0, den.cast("double"))
    )


def rounded(c: Column, places: int = 6) -> Column:
    """floor(x*10^p + 0.5)/10^p in doubles: the same result in every SQL engine."""
    scale = float(10**places)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def key_hash(parts: Sequence[Column], seed: int) -> Column:
    """32-bit hash of the key and a seed as a bigint, independent of partitioning."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(parts: Sequence[Column], seed: int) -> Column:
    """The key hash as a number in [0, 1)."""
    return key_hash(parts, seed).cast("double") / F.lit(4294967296.0)
