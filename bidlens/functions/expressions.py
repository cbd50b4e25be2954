"""Column expressions shared by the reports. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 13  # 52 bits: every value is exact in a double


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean_of(c: Column | str) -> Column:
    """Average as double(sum) / count; null for a group without values.

    Dividing once, after an exact decimal or integer sum, gives the same
    double whatever the order in which partial sums were merged.
    """
    c = as_col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio in double, null when the denominator is zero (ANSI would raise)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def supplier_key(warehouse: Column | str, item: Column | str,
                 modulus: int | Column = 10000) -> Column:
    """Supplier that serves an item in a warehouse: pmod(warehouse * item, modulus)."""
    product = as_col(warehouse).cast("bigint") * as_col(item).cast("bigint")
    modulus = F.lit(modulus) if isinstance(modulus, int) else modulus
    return F.pmod(product, modulus.cast("bigint"))


def nation_code(state: Column | str) -> Column:
    """Nation key carried by a state text: the code of its first letter."""
    return F.ascii(F.substring(as_col(state), 1, 1))


def hash_unit(key: list[str], seed: str = "", portable: bool = False) -> Column:
    """Repeatable pseudo-random number in [0, 1) from the key columns.

    Null and empty key parts stay apart, as do ('a', 'bc') and ('ab', 'c'). The
    ``portable`` form costs several times as much but can be repeated by any
    engine that has md5: with one key column and no seed it hashes the column's text,
    otherwise the parts' texts with their lengths in front.
    """
    if not portable:
        parts = [F.lit(seed)]
        for name in key:
            parts += [as_col(name), as_col(name).isNull()]
        return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2 ** 53))
    if len(key) == 1:
        text = F.coalesce(as_col(key[0]).cast("string"), F.lit(""))
    else:
        parts = []
        for name in key:
            value = as_col(name).cast("string")
            parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
                F.concat(F.length(value).cast("string"), F.lit(":"), value)))
        text = F.concat(*parts)
    if seed:
        text = F.concat(F.lit(seed), text)
    digits = F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** HASH_DIGITS))
