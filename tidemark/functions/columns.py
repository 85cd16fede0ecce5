"""Column-level helpers. Every helper returns a JVM-side ``Column`` so it
stays inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Sums of money are widened to the maximum precision so Spark and the SQL
# oracle agree on the result type (Spark would give precision 28).
MONEY_SUM = T.DecimalType(38, 2)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(*cols: Column | str) -> Column:
    """``'|'``-joined string forms with NULL rendered as ''."""
    return F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over ``key_text``."""
    return F.md5(key_text(*cols))


def cast_to(c: Column | str, dtype: T.DataType | str, lenient: bool = False) -> Column:
    """``cast`` (fails the job on malformed input under ANSI) or, when
    ``lenient``, ``try_cast`` (malformed -> NULL, for quarantine flows)."""
    col = _c(c)
    return col.try_cast(dtype) if lenient else col.cast(dtype)


def to_whole_number(c: Column | str, dtype: T.DataType, lenient: bool = False) -> Column:
    """Warehouse ``::number`` cast: text and fractions round to an integer.

    A straight string->bigint cast raises on '9.6' under ANSI; going through
    decimal(38,0) rounds half-up and still fails on malformed text.
    """
    col = _c(c)
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    whole = cast_to(cast_to(col, T.DecimalType(38, 0), lenient), "bigint", lenient)
    # a decimal is dear and most text is a plain integer: only the rest takes the long way
    return F.coalesce(col.try_cast("bigint"), whole) if isinstance(dtype, T.StringType) else whole


#: Keys as bytes, see ``pack_digests``.
PACKED = "_digest"


def pack_digests(df: DataFrame, key: str) -> DataFrame:
    """``df`` whose keys that are digests in hexadecimal text, which shuffles
    and state keep at full length, are bytes of half of it in a column of
    their own (``PACKED``); a key that bytes do not give back stays as it is."""
    same = F.coalesce(F.lower(F.hex(F.unhex(key))) == F.col(key), F.lit(False))
    return df.withColumns({PACKED: F.when(same, F.unhex(key)), key: F.when(~same, F.col(key))})


def unpack_digests(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The ``columns`` of a frame from ``pack_digests``, its keys as text."""
    return df.select(*[F.coalesce(F.lower(F.hex(PACKED)), F.col(key)).alias(key) if c == key else F.col(f"`{c}`") for c in columns])


#: A new word starts behind white space and each of these marks.
WORD_ENDS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def title_case(c: Column | str) -> Column:
    """``initcap(trim(x))`` of the warehouse: words also end at punctuation,
    where Spark's ``initcap`` knows white space only."""
    words = F.split(F.lower(F.trim(_c(c))), f"(?<=[{WORD_ENDS}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(_c(c)))


def strict_greatest(*cols: Column | str) -> Column:
    """``greatest`` that is NULL when any argument is NULL (warehouse
    semantics); Spark's own ``greatest`` skips NULLs."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def safe_ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``case when den > 0 then num/den else default`` evaluated in double
    (decimal/decimal widens differently per engine)."""
    out = num.cast("double") / den.cast("double")
    dflt = F.lit(default).cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(den > 0, out).otherwise(dflt)


def exact_avg(c: Column | str) -> Column:
    """Average as ``double(sum)/count``: an exact decimal sum divided once,
    so the value is bit-identical across engines; NULL over no values."""
    col = _c(c)
    return F.when(F.count(col) > 0, F.sum(col).cast("double") / F.count(col))


def money_sum(c: Column | str) -> Column:
    return F.sum(_c(c)).cast(MONEY_SUM)


def safe_column(df: DataFrame, name: str, data_type: T.DataType | str = "string") -> Column:
    """The column when present (case-insensitive), else a typed NULL."""
    for existing in df.columns:
        if existing.lower() == name.lower():
            return F.col(f"`{existing}`").cast(data_type).alias(name)
    return F.lit(None).cast(data_type).alias(name)


def basename(path: Column | str) -> Column:
    """Last path segment of a file URI, URL-decoded."""
    return F.url_decode(F.element_at(F.split(_c(path), "/"), -1))


def hour_boundaries_between(start: Column | str, end: Column | str) -> Column:
    """Warehouse ``DATEDIFF('hour', a, b)``: counts hour boundaries crossed,
    i.e. difference of the hour-truncated timestamps."""
    return F.timestamp_diff(
        "HOUR", F.date_trunc("hour", _c(start)), F.date_trunc("hour", _c(end))
    )


def week_start(d: Column | str) -> Column:
    return F.trunc(_c(d), "week")


def quarter_end(d: Column | str) -> Column:
    return F.last_day(F.add_months(F.trunc(_c(d), "quarter"), 2))


def year_end(d: Column | str) -> Column:
    return F.last_day(F.add_months(F.trunc(_c(d), "year"), 11))


def ilike_any(c: Column | str, *patterns: str) -> Column:
    col = _c(c)
    out = col.ilike(patterns[0])
    for p in patterns[1:]:
        out = out | col.ilike(p)
    return out
