"""Numeric, bit and date expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .text import blank_to_null, col, trim_ws


def tolerant_double(c) -> Column:
    return F.expr("try_cast(null as double)") if c is None else blank_to_null(c).try_cast("double")


def tolerant_bounds(low, high) -> Column:
    """struct<low, high>: both null if either can't be read or they are the wrong way round."""
    a, b = tolerant_double(low), tolerant_double(high)
    bad = (blank_to_null(low).isNotNull() & a.isNull()) | (blank_to_null(high).isNotNull() & b.isNull()) | F.coalesce(a > b, F.lit(False))
    none = F.lit(None).cast("double")
    return F.struct(F.when(bad, none).otherwise(a).alias("low"), F.when(bad, none).otherwise(b).alias("high"))


def tolerant_long(c) -> Column:
    """A whole number, null if the text isn't one."""
    text = trim_ws(c)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def tag_text(tag) -> Column:
    """A 32-bit tag as (GGGG,EEEE)."""
    tag = col(tag)
    return F.format_string("(%04X,%04X)", F.shiftright(tag, 16).bitwiseAND(0xFFFF), tag.bitwiseAND(0xFFFF))


def filled_count(*columns) -> Column:
    """How many of the columns aren't null."""
    out = F.lit(0)
    for c in columns:
        out = out + col(c).isNotNull().cast("int")
    return out


def dot(a, b) -> Column:
    """Inner product of two arrays, in double precision."""
    pairs = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def l2_norm(v) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v) -> Column:
    norm = F.greatest(l2_norm(v), F.lit(1e-9))
    return F.transform(col(v), lambda x: x.cast("double") / norm)


def mean_pool(vectors, mask) -> Column:
    """Mean of the vectors (array of arrays) whose mask isn't 0."""
    kept = F.filter(F.arrays_zip(col(vectors).alias("v"), col(mask).alias("m")), lambda z: z["m"] != 0)
    width = F.size(F.try_element_at(col(vectors), F.lit(1)))
    total = F.aggregate(F.transform(kept, lambda z: F.transform(z["v"], lambda x: x.cast("double"))), F.array_repeat(F.lit(0.0), width), lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    n = F.greatest(F.size(kept).cast("double"), F.lit(1e-9))
    return F.transform(total, lambda x: x / n)


def human_size(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:.1f} {unit}"
        n /= 1024
    return f"{n:.1f} TB"


def years_between(date, baseline) -> Column:
    return (F.datediff(col(date), col(baseline)) / F.lit(365.25)).cast("double")


def date_after(baseline, years) -> Column:
    return F.date_add(col(baseline), F.round(col(years) * 365.25).cast("int"))


def top_coded_age(age, top: int = 90) -> Column:
    return F.when(col(age) >= top, F.lit(f"{top}+")).otherwise(col(age).cast("int").cast("string"))


def suppress_small(n, least: int) -> Column:
    """Counts of at least 1 and under least become null; zero stays."""
    return F.when((col(n) > 0) & (col(n) < least), F.lit(None).cast("bigint")).otherwise(col(n))


def suppress_complement(df, group: list[str], n: str, least: int, tie: list[str]):
    """With small cells suppressed, and where a group has just one of them, its next smallest cell too."""
    every = Window.partitionBy(*group)
    small = (F.col(n) > 0) & (F.col(n) < least)
    order = Window.partitionBy(*group).orderBy(F.when(~small & (F.col(n) > 0), F.col(n)).asc_nulls_last(), *tie)
    out = df.withColumn("__small", F.sum(small.cast("int")).over(every)).withColumn("__rank", F.row_number().over(order))
    hide = small | ((F.col("__small") == 1) & (F.col("__rank") == 1) & (F.col(n) > 0))
    return out.withColumn("suppressed", F.when(hide, F.lit(None).cast("bigint")).otherwise(F.col(n))).drop("__small", "__rank")
