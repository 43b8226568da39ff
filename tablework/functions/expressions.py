"""Column expressions: every helper returns a plain ``Column`` that stays inside code generation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Texts that stand for a missing number.
SENTINELS = ("NA", "NULL", "")


def parse_number(text: str | Column, dtype: str) -> Column:
    """Text to a number, null where it is none (a plain cast raises in ANSI mode).

    The common sentinels are sorted out first: each failed cast costs an exception inside the task,
    some twenty microseconds, which a file full of ``NA`` would pay per row.
    """
    c = as_col(text)
    return F.when(~c.isin(*SENTINELS), c).try_cast(dtype)


def presence_flag(*cols: str | Column) -> Column:
    """1 when any of the columns holds a value, else 0."""
    present = reduce(lambda a, b: a | b, [as_col(c).isNotNull() for c in cols])
    return F.when(present, F.lit(1)).otherwise(F.lit(0))


def yes_no(col: str | Column) -> Column:
    return F.when(as_col(col).isNull(), F.lit("No")).otherwise(F.lit("Yes"))


def binary_flag(col: str | Column) -> Column:
    """0 stays 0, any other number becomes 1, null stays null."""
    c = as_col(col)
    return F.when(c == 0, F.lit(0)).when(c.isNotNull(), F.lit(1))


def bucketize(
    col: str | Column,
    edges: Sequence[float],
    labels: Sequence,
    closed: str = "left",
    null_label=None,
    zero_label=None,
) -> Column:
    """Label ranges cut at ``edges``; ``len(labels) == len(edges) + 1``.

    ``closed="left"`` puts an edge value into the upper range, ``"right"`` into the lower one.
    With ``zero_label`` the scale starts at zero: zero gets that label and negatives none.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    c = as_col(col)
    out = F.when(c.isNull(), F.lit(null_label))
    if zero_label is not None:
        out = out.when(c == 0, F.lit(zero_label)).when(c < 0, F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(c < edge if closed == "left" else c <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def capped_count(col: str | Column, cap: int) -> Column:
    """Whole counts up to ``cap``; larger ones become the cap, null becomes 0."""
    return F.least(F.coalesce(as_col(col), F.lit(0)), F.lit(cap)).cast("int")


def parse_money(col: str | Column) -> Column:
    """``' $1,234 '`` to 1234.0; text that is no amount gives null."""
    return F.regexp_replace(F.trim(as_col(col)), "[$,]", "").try_cast("double")


def sentinel_to_zero(col: str | Column) -> Column:
    """``'NA'``, null and other non-numbers become 0."""
    return F.coalesce(parse_number(col, "double"), F.lit(0.0))


def late_flag(delay: str | Column) -> Column:
    """True when the delay is above zero; an unknown delay stays unknown."""
    return as_col(delay) > 0


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that gives null for a zero denominator."""
    return F.try_divide(as_col(num), as_col(den))


def correlation(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over rows that have both values; null (not an error) when one of them is constant."""
    x, y = as_col(a).cast("double"), as_col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, x))) * F.sqrt(F.var_pop(F.when(both, y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def years_since(year: str | Column, today: Column) -> Column:
    return F.year(today) - as_col(year)


def years_since_renewal(sold: str | Column, built: str | Column, renewed: str | Column) -> Column:
    """Years since the last renovation; year 0 means never, which falls back to years since built."""
    s, b, r = as_col(sold), as_col(built), as_col(renewed)
    return F.when(r != 0, s - r).otherwise(s - b)


def parity_estimate(value: str | Column) -> Column:
    """Even values grow by 3 percent, all others shrink by 2 percent."""
    v = as_col(value)
    return F.when(v % 2 == 0, v * 1.03).otherwise(v * 0.98)


def padded_prefix(code: str | Column, width: int, prefix: int) -> Column:
    """Left-pad a numeric code with zeros and keep its first digits (county code to state code)."""
    return F.substring(F.lpad(as_col(code).cast("string"), width, "0"), 1, prefix)


def format_pattern(value: str | Column, pattern: str) -> Column:
    """Number as text by a decimal pattern, e.g. ``,### K``."""
    return F.call_function("format_number", as_col(value), F.lit(pattern))


def hash_fraction(*keys: str | Column) -> Column:
    """A reproducible number in [0, 1) per key, equal on every run, cluster and engine."""
    text = F.concat_ws("|", *[as_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
