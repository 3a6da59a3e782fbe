"""Exact numbers that are kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dec(c: Column | str, precision: int = 28, scale: int = 8) -> Column:
    """Text as an exact decimal; null where it is no number or does not fit."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(f"decimal({precision},{scale})")


def product(a: Column | str, b: Column | str) -> Column:
    """The product of two decimals(28,8) as decimal(38,16): exact if both are below 10^10, else rounded to six digits behind the point."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    narrow = [x.try_cast("decimal(18,8)") for x in (a, b)]
    return F.coalesce((narrow[0] * narrow[1]).cast("decimal(38,16)"), (a * b).cast("decimal(38,16)"))


def units(c: Column | str) -> Column:
    """Text as a whole number of 10^-8 units, a decimal(31,0); null where it is no number or has more than 22 digits before the point."""
    return (dec(c, 30, 8) * F.lit(100_000_000).cast("decimal(9,0)")).cast("decimal(31,0)")


def canonical(c: Column | str) -> Column:
    """Decimal text in one spelling: the shortest exact one that keeps trailing zeros of the fraction.

    Plain where the number has no positive exponent and its first digit is at most six places
    behind the point, else scientific with one digit before the point (``0.00000000`` is
    ``0E-8``, ``1e3`` is ``1E+3``, ``+5`` is ``5``). Null where the text is no finite number.
    Numbers that are plain already, which is nearly all, are recognised by one pattern.
    """
    c = F.col(c) if isinstance(c, str) else c
    known = c.rlike(r"^(0|[1-9][0-9]*)(\.[0-9]+)?$") & ~c.rlike(r"^0\.000000[0-9]")
    # each step binds its parts once, so the expression stays small
    return F.when(c.isNull(), None).when(known, c).otherwise(F.get(F.transform(F.transform(F.transform(F.array(c), _parts), _lengths), _spelled), 0))


def _parts(x: Column) -> Column:
    t = F.regexp_replace(F.trim(x), "(?<=[0-9])_(?=[0-9])", "")
    ok = t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    part = lambda p: F.regexp_extract(t, p, 1)
    exp = F.coalesce(part(r"[eE]([+-]?[0-9]+)$").try_cast("int"), F.lit(0))
    return F.struct(ok.alias("ok"), F.when(t.startswith("-"), "-").otherwise("").alias("sign"), part(r"^[+-]?([0-9]*)").alias("whole"), part(r"\.([0-9]*)").alias("frac"), exp.alias("exp"))


def _lengths(p: Column) -> Column:
    digits = F.regexp_replace(F.concat(p["whole"], p["frac"]), "^0+(?=.)", "")
    exp = p["exp"] - F.length(p["frac"])
    return F.struct(p["ok"].alias("ok"), p["sign"].alias("sign"), digits.alias("digits"), exp.alias("exp"), (exp + F.length(digits) - 1).alias("adj"))


def _spelled(p: Column) -> Column:
    digits, exp, adj = p["digits"], p["exp"], p["adj"]
    full = F.lpad(digits, F.greatest(F.length(digits), 1 - exp), "0")
    cut = F.length(full) + exp
    plain = F.when(exp == 0, digits).otherwise(F.concat(F.substring(full, F.lit(1), cut), F.lit("."), F.substring(full, cut + 1, -exp)))
    tail = F.substring(digits, F.lit(2), F.length(digits))
    science = F.concat(F.substring(digits, 1, 1), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)), F.when(adj >= 0, "E+").otherwise("E"), adj.cast("string"))
    return F.when(p["ok"], F.concat(p["sign"], F.when((exp <= 0) & (adj >= -6), plain).otherwise(science)))


def floor_div(c: Column | str, width: int) -> Column:
    """The whole number of ``width`` in ``c``, rounded down; exact where a double would not be."""
    c = F.col(c) if isinstance(c, str) else c
    w = F.lit(width).cast("bigint")
    return F.call_function("div", c.cast("bigint") - F.pmod(c.cast("bigint"), w), w)


def is_zero(c: Column) -> Column:
    """Whether decimal text is zero, judged by its mantissa alone."""
    return c.rlike(r"^[+-]?[0.]+([eE].*)?$")


def exact_percentile(values: Column, numerator: int, denominator: int, kind: str = "decimal(38,10)") -> Column:
    """The linearly interpolated percentile numerator/denominator of an array of decimals up to (26,8), exactly.

    Null for an empty array; nulls in the array do not count.
    """
    a = F.array_sort(F.array_compact(values))
    pos = (F.size(a) - 1) * numerator
    lo, rem = F.floor(pos / denominator).cast("int"), pos % denominator
    few = lambda x: x.cast("decimal(4,0)")
    at = lambda i: F.get(a, i).cast("decimal(26,8)")
    part = (at(lo) * few(F.lit(denominator) - rem) + F.coalesce(at(lo + 1), at(lo)) * few(rem)) / few(F.lit(denominator))
    return F.when(F.size(a) > 0, part).cast(kind)


def nine_decimals(x: Column) -> Column:
    """A ratio from 0 to 1 as text of nine decimals, rounded by its binary value to the nearest, ties to even.

    ``format_string`` rounds the shortest decimal that names the number instead and differs on what
    looks like a tie. The number is taken apart exactly into whole multiples of 2 ** -93.
    """
    whole = lambda n, digits: F.lit(str(n)).cast(f"decimal({digits},0)")
    up = x * F.lit(float(1 << 40))
    high = F.floor(up).cast("bigint")
    low = ((up - high) * F.lit(float(1 << 53))).cast("bigint")
    n = (high.cast("decimal(13,0)") * whole(1 << 53, 16) + low.cast("decimal(16,0)")) * whole(10**9, 10)
    unit = whole(1 << 93, 29)
    down = F.floor(n / unit).cast("bigint")
    down = F.when(down.cast("decimal(11,0)") * unit > n, down - 1).otherwise(down)  # a quotient of 38 digits may be rounded up
    twice = (n - down.cast("decimal(11,0)") * unit) * 2
    near = F.when((twice > unit) | ((twice == unit) & (down % 2 == 1)), down + 1).otherwise(down)
    return F.format_string("%d.%09d", F.floor(near / 10**9).cast("bigint"), near % 10**9)


def strict_whole(v: Column, least: int = 0) -> Column:
    """A VARIANT that is a whole number of at least ``least``, as bigint; null for all else: booleans, texts, fractions."""
    n = F.try_variant_get(v, "$", "bigint")
    return F.when(F.schema_of_variant(v).isin("BIGINT", "INT", "SMALLINT", "TINYINT") & (n >= least), n)


def strict_decimal(v: Column, zero: bool = False) -> Column:
    """A VARIANT that is a number, or the text of one, above zero (or zero), as decimal(28,8); null for all else: booleans, infinity."""
    n = F.try_variant_get(v, "$", "string").try_cast("decimal(28,8)")
    return F.when((F.schema_of_variant(v) != "BOOLEAN") & ((n > 0) | (F.lit(zero) & (n == 0))), n)
