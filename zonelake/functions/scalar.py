"""Row-level expressions: safe casts, category mapping, calendar parts, argmax, labels.

Spark runs in ANSI mode, where a plain cast of bad text raises.  Cleaning must
coerce bad values to null instead, so every parse goes through ``try_*`` forms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, data_type: str) -> Column:
    """Cast that yields null on unparsable input (pandas ``errors='coerce'``)."""
    return _col(c).try_cast(data_type)


def safe_timestamp(c: ColumnOrName, fmt: str | None = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse text to a timestamp with a declared format; null when it does not parse."""
    col = _col(c)
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def to_bool(c: ColumnOrName) -> Column:
    """0 -> false, any other number -> true, null stays null."""
    return _col(c) != F.lit(0)


def ordinal(c: ColumnOrName, mapping: Mapping[str, int]) -> Column:
    """Map a category to its ordinal; values outside the mapping become null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def time_of_day(c: ColumnOrName) -> Column:
    """``HH:mm:ss`` text of a timestamp (keeps minutes and seconds)."""
    return F.date_format(_col(c), "HH:mm:ss")


def hour_of(c: ColumnOrName) -> Column:
    return F.hour(_col(c))


def weekday_name(c: ColumnOrName) -> Column:
    """English weekday name, e.g. ``Sunday``."""
    return F.date_format(_col(c), "EEEE")


def round_half_up_int(c: ColumnOrName) -> Column:
    """Round half away from zero, then to int (a plain decimal->int cast truncates)."""
    return F.round(_col(c), 0).cast("int")


def row_argmax(names: Sequence[str], cols: Sequence[ColumnOrName] | None = None) -> Column:
    """Name of the column holding the row maximum; the first column wins ties.

    Nulls are skipped; an all-null row gives null.
    """
    values = [_col(c) for c in (cols or names)]
    arr = F.array(*values)
    pos = F.array_position(arr, F.greatest(*values))
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), pos.cast("int"))


def route_label(origin: ColumnOrName, dest: ColumnOrName, sep: str = " → ") -> Column:
    """``origin → dest``; null if either end is null (SQL ``||`` semantics)."""
    return F.concat(_col(origin).cast("string"), F.lit(sep), _col(dest).cast("string"))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null on a zero denominator instead of raising."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
