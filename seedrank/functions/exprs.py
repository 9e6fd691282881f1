"""Column-expression builders. Everything here is a built-in Spark expression (codegen'd,
no Python per row). Spark 4 runs with ANSI mode on, so casts use ``try_cast`` and every
division is guarded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_ne(a: str | Column, b: str | Column) -> Column:
    """``a != b`` where a missing side counts as *different* (pandas semantics, C1)."""
    return ~F.coalesce(col(a) == col(b), F.lit(False))


# ---------------------------------------------------------------- dates

def extract_year_text(c: str | Column) -> Column:
    """First stand-alone 4-digit group; else the first digit run cut to 4 if it is at
    least 4 long; else the text unchanged; NULL stays NULL."""
    s = col(c).cast("string")
    four = F.regexp_extract(s, r"\b(\d{4})\b", 1)
    run = F.regexp_extract(s, r"(\d+)", 1)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(four != "", four)
        .when(F.length(run) >= 4, F.substring(run, 1, 4))
        .otherwise(s)
    )


def release_year(c: str | Column) -> Column:
    """Full date parse (yyyy, yyyy-MM, yyyy-MM-dd) → year; else a 4-digit number in
    1900..2030; else the first 19xx/20xx word; else NULL."""
    s = F.trim(col(c).cast("string"))
    parsed = F.year(F.try_to_date(s))
    as_int = F.when(s.rlike(r"^\d{4}$"), s.try_cast("int"))
    guarded = F.when(as_int.between(1900, 2030), as_int)
    word = F.regexp_extract(s, r"\b(19\d{2}|20\d{2})\b", 1)
    return F.coalesce(parsed, guarded, F.when(word != "", word.try_cast("int"))).cast("int")


# ---------------------------------------------------------------- tags and vectors (V1, V2)

def split_tags(c: str | Column) -> Column:
    """V2: split on ',', trim, lower-case; NULL → empty list."""
    s = col(c)
    return F.when(s.isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(F.split(s, ","), lambda x: F.lower(F.trim(x)))
    )


def parse_vector(c: str | Column, dim: int) -> Column:
    """V1: '[a, b ...]' or 'a b\\n c' → array<double>; NULL or any unparseable element →
    ``dim`` zeros."""
    s = col(c)
    cleaned = F.trim(F.regexp_replace(s, r"[\[\],\s]+", " "))
    arr = F.transform(F.split(cleaned, " "), lambda x: x.try_cast("double"))
    zeros = F.array_repeat(F.lit(0.0), dim)
    bad = s.isNull() | (cleaned == "") | F.exists(arr, lambda x: x.isNull())
    return F.when(bad, zeros).otherwise(arr)


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


# ---------------------------------------------------------------- linear algebra over named columns

def dot(a: Sequence[Column], b: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    weights = weights or [1.0] * len(a)
    terms = [x * y * F.lit(float(w)) if w != 1.0 else x * y for x, y, w in zip(a, b, weights)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def cosine(a: Sequence[Column], b: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """V8: cosine of two vectors given as column lists; a zero norm gives 0 (as a normalised
    zero vector does). Integer ``weights`` equal repeating a column that many times."""
    num = dot(a, b, weights)
    na = F.sqrt(dot(a, a, weights))
    nb = F.sqrt(dot(b, b, weights))
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(num / (na * nb))


def array_cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine of two array<double> columns of equal length; zero norm → 0."""
    a, b = col(a), col(b)
    num = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(num / (na * nb))


def clip(x: Column, lo: Column | float | None, hi: Column | float | None) -> Column:
    """Clip to [lo, hi] keeping NULL as NULL (``least``/``greatest`` alone skip NULLs)."""
    y = x
    if lo is not None:
        y = F.greatest(y, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        y = F.least(y, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(x.isNotNull(), y)


def standardized(x: Column, mean: Column, std: Column) -> Column:
    """V7 transform: (x - mean) / std with a zero (or NULL) std treated as 1."""
    return (x - mean) / F.when((std.isNull()) | (std == 0), F.lit(1.0)).otherwise(std)


def minmax_100(x: Column, lo: Column, hi: Column, flat: str = "fifty") -> Column:
    """V9 with the reference's per-model flat-range rules:
    fifty (cosine, ridge by our decision) → 50; glm → range < 0.01 gives x*100;
    keep (network) → unchanged; zero → 0."""
    rng = hi - lo
    scaled = (x - lo) / rng * F.lit(100.0)
    if flat == "glm":
        return F.when(rng < 0.01, x * F.lit(100.0)).otherwise(scaled)
    if flat == "keep":
        return F.when(hi > lo, scaled).otherwise(x)
    if flat == "zero":
        return F.when(hi > lo, scaled).otherwise(F.lit(0.0))
    return F.when(hi > lo, scaled).otherwise(F.lit(50.0))


def round_doubles(df, places: int = 6):
    """Round every double/float column (deterministic output for hashing and display)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("double", "float"):
            out.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
