"""Exact sums of doubles of any size, as plain Spark aggregations.

A double stands for a decimal number that reads back as it: one with four decimals (below 9 * 10**11) or with ten
(below 10**15) if there is one, else the one that it prints as.  Sums of these numbers are exact, so they do not depend on the
order rows are added in, on the partitioning or on the scale of the values:

* a number with four decimals is a whole number of 10**-4, added in three runs of its bits;
* one with ten is added as ``decimal(38,10)``;
* any other is split into its digits and its power of ten; powers of ten are put into bands of nine, and the
  digits, shifted to their band's power, are added as whole decimals;
* at the end the sums of a group are put together with carries and read as one number, which is the
  correctly rounded double of the exact sum.

There is room for 10**12 rows of a group.  ``grouped`` aggregates in two steps: by keys and bands (one band for the first two
kinds; map-side partial sums, one row a key and band in the shuffle), then by keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelake.functions.scalar import ColumnOrName, _col

PLAIN, WHOLE = "decimal(38,10)", "decimal(38,0)"
PLAIN_BAND, PLAIN_AT = -1, 37            # the plain sum counts 10**-10, which is where band 37 begins
LOWEST, WIDTH, BANDS = -343, 9, 78       # band j counts 10**(LOWEST + WIDTH * j)
PLAIN_LIMIT = 1e15
QUICK_LIMIT, QUICK = 9e11, 10_000        # below it four decimals fit 53 bits
HIGH, LOW = 35, 17                       # bits of 10**-4: from HIGH on, from LOW on, below


def _split(df: DataFrame, c: str, to: str) -> DataFrame:
    """``df`` with the kinds of the double column ``c``: bits {to}_high, _mid, _low, or {to}_plain, or {to}_band and
    _whole; {to}_odd what is no finite number.  In steps, so that no step's expression is evaluated more than once."""
    x = F.col(c)
    df = df.withColumn(f"{to}_r", F.when(F.abs(x) < QUICK_LIMIT, F.rint(x * QUICK)))
    df = df.withColumn(f"{to}_r", F.when(F.col(f"{to}_r") / QUICK == x, F.col(f"{to}_r").cast("long")))
    r = F.col(f"{to}_r")
    df = df.withColumn(f"{to}_plain", F.when(r.isNull() & (F.abs(x) < PLAIN_LIMIT), x.cast(PLAIN)))
    plain = F.col(f"{to}_plain")
    df = df.withColumn(f"{to}_plain", F.when(plain.cast("double") == x, plain))
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rest = r.isNull() & plain.isNull() & x.isNotNull()
    band, whole = _digits(x)
    return df.withColumns({
        f"{to}_high": F.shiftright(r, HIGH), f"{to}_mid": F.shiftright(r, LOW).bitwiseAND(F.lit((1 << HIGH - LOW) - 1)),
        f"{to}_low": r.bitwiseAND(F.lit((1 << LOW) - 1)), f"{to}_odd": F.when(rest & ~finite, x),
        f"{to}_band": F.when(rest & finite, band).otherwise(PLAIN_BAND), f"{to}_whole": F.when(rest & finite, whole)})


def _digits(x: Column) -> tuple[Column, Column]:
    """Band and shifted digits of a finite double as it prints."""
    shown = x.cast("string")
    digits = F.substring_index(shown, "E", 1)
    power = F.when(F.contains(shown, F.lit("E")), F.substring_index(shown, "E", -1).cast("int")).otherwise(0)
    place = power - (F.length(digits) - F.instr(digits, ".")) - LOWEST
    shift = F.element_at(F.array(*(F.lit(10 ** i) for i in range(WIDTH))), (place % WIDTH + 1).cast("int"))
    whole = (F.replace(digits, F.lit("."), F.lit("")).cast("decimal(20,0)") * shift.cast("decimal(10,0)")).cast(WHOLE)
    return F.floor(place / WIDTH).cast("int"), whole


def parts(c: ColumnOrName) -> Column:
    """A value as an entry for ``total``: struct(band, quick, plain, whole, odd), with nulls only for a null."""
    x = _col(c).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    plain = F.when(F.abs(x) < PLAIN_LIMIT, x.cast(PLAIN))
    fits = F.coalesce(plain.cast("double") == x, F.lit(False))
    band, whole = _digits(x)
    split = x.isNotNull() & finite & ~fits
    return F.struct(F.when(split, band).otherwise(PLAIN_BAND).alias("band"), F.lit(None).cast(WHOLE).alias("quick"),
                    F.when(fits, plain).alias("plain"), F.when(split, whole).alias("whole"),
                    F.when(x.isNotNull() & ~finite, x).alias("odd"))


def _sum(entries: Column, value) -> Column:
    zero = F.lit(0).cast(WHOLE)
    return F.aggregate(entries, zero, lambda a, e: (a + F.coalesce(value(e), zero)).cast(WHOLE))


def _lifted(plain: Column) -> Column:
    """A plain sum as a whole number of 10**-10 (decimal products and sums of full precision would round)."""
    return F.replace(plain.cast("string"), F.lit("."), F.lit("")).cast(WHOLE)


def _carried(units: Column) -> Column:
    """struct(carry, digits): the units of all bands as one number of nine digits a band, the lowest band first."""

    def step(state, unit):
        t = (state["carry"] + unit).cast(WHOLE)
        digit = F.pmod(t, F.lit(10 ** WIDTH).cast(WHOLE)).cast(WHOLE)
        left = (t - digit).cast(WHOLE).cast("string")     # a multiple of 10**9
        carry = F.when(F.length(left) > WIDTH, F.substring(left, F.lit(1), F.length(left) - WIDTH).cast(WHOLE)).otherwise(F.lit(0).cast(WHOLE))
        return F.struct(carry.alias("carry"), F.concat(F.lpad(digit.cast("string"), WIDTH, "0"), state["digits"]).alias("digits"))

    return F.aggregate(units, F.struct(F.lit(0).cast(WHOLE).alias("carry"), F.lit("").alias("digits")), step)


def total(entries: Column) -> Column:
    """The double nearest to the sum of an array of ``parts`` (or of sums of them by band); null if it is of nulls only."""
    odd = F.aggregate(F.filter(entries, lambda e: e["odd"].isNotNull()), F.lit(0.0), lambda a, e: a + e["odd"])
    quick = _sum(entries, lambda e: e["quick"])     # of 10**-4
    plain = (_sum(entries, lambda e: _lifted(e["plain"])) + (quick * F.lit(10 ** 6).cast("decimal(7,0)")).cast(WHOLE)).cast(WHOLE)
    at = lambda j: _sum(F.filter(entries, lambda e: e["band"] == j), lambda e: e["whole"])
    units = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                        lambda j: (at(j) + F.when(j == PLAIN_AT, plain).otherwise(F.lit(0).cast(WHOLE))).cast(WHOLE))
    below = _carried(F.transform(units, lambda u: (-u).cast(WHOLE)))
    above = _carried(units)
    read = lambda n, sign: F.concat(F.lit(sign), n["carry"].cast("string"), n["digits"], F.lit(f"E{LOWEST}")).cast("double")
    wide = F.when(above["carry"] < 0, read(below, "-")).otherwise(read(above, ""))
    known = F.exists(entries, lambda e: e["quick"].isNotNull() | e["plain"].isNotNull() | e["whole"].isNotNull() | e["odd"].isNotNull())
    return F.when(F.exists(entries, lambda e: e["odd"].isNotNull()), odd) \
        .when(~F.exists(entries, lambda e: e["band"] != PLAIN_BAND), F.when(known, F.concat(plain.cast("string"), F.lit("E-10")).cast("double"))).otherwise(wide)


def grouped(df: DataFrame, keys: Mapping[str, ColumnOrName] | Sequence[str], sums: Mapping[str, ColumnOrName],
            others: Mapping[str, tuple[str, ColumnOrName]] | None = None, counts: Mapping[str, str] | None = None,
            means: Mapping[str, str] | None = None) -> DataFrame:
    """One row a key: exact ``sums`` (name -> value), ``others`` (name -> (``count``, ``sum``, ``min``, ``max`` or
    ``avg``, value)), ``counts`` (name -> a name of ``sums``: its non-null values) and ``means`` (name -> a name of ``sums``).
    """
    keys = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    others, counts, means = dict(others or {}), dict(counts or {}), dict(means or {})
    names = {s: i for i, s in enumerate(sums)}
    own = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*(_col(c).alias(k) for c, k in zip(keys.values(), own)), *(_col(c).alias(f"_o{i}") for i, (_, c) in enumerate(others.values())),
                     *(_col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(sums.values())))
    first, second = [F.count(F.lit(1)).alias("_rows")], []
    for i in names.values():
        rows = _split(rows, f"_x{i}", f"_{i}")
        first += [F.sum(f"_{i}_{c}").alias(f"_{i}_{c}") for c in ("high", "mid", "low", "plain", "whole", "odd")]
        first.append(F.count(f"_x{i}").alias(f"_n{i}"))
        high, mid, low = (F.col(f"_{i}_{c}").cast("decimal(20,0)") for c in ("high", "mid", "low"))
        quick = (high * F.lit(1 << HIGH).cast("decimal(11,0)") + mid * F.lit(1 << LOW).cast("decimal(6,0)") + low).cast(WHOLE)
        entry = F.struct(F.col(f"_{i}_band").alias("band"), quick.alias("quick"), *(F.col(f"_{i}_{c}").alias(c) for c in ("plain", "whole", "odd")))
        second += [F.collect_list(entry).alias(f"_s{i}"), F.sum(f"_n{i}").alias(f"_c{i}")]
    bands = [f"_{i}_band" for i in names.values()]
    merged = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
    for i, (kind, _) in enumerate(others.values()):
        if kind == "avg":
            first += [F.sum(F.col(f"_o{i}").cast("double")).alias(f"_os{i}"), F.count(f"_o{i}").alias(f"_on{i}")]
            second.append((F.sum(f"_os{i}") / F.sum(f"_on{i}")).alias(f"_r{i}"))
        else:
            first.append(getattr(F, kind)(f"_o{i}").alias(f"_os{i}"))
            second.append(getattr(F, merged[kind])(f"_os{i}").alias(f"_r{i}"))
    out = rows.groupBy(*own, *bands).agg(*first).groupBy(*own).agg(*second)
    if not keys:      # no row at all gives no band either
        out = out.withColumns({f"_c{i}": F.coalesce(f"_c{i}", F.lit(0)) for i in names.values()})
    out = out.withColumns({f"_t{i}": total(F.col(f"_s{i}")) for i in names.values()})
    columns = [F.col(k).alias(name) for k, name in zip(own, keys)] + [F.col(f"_t{i}").alias(s) for s, i in names.items()]
    columns += [F.col(f"_r{i}").alias(name) for i, name in enumerate(others)]
    columns += [F.col(f"_c{names[s]}").cast("long").alias(c) for c, s in counts.items()]
    columns += [F.try_divide(F.col(f"_t{names[s]}"), F.col(f"_c{names[s]}").cast("double")).alias(m) for m, s in means.items()]
    return out.select(*columns)
