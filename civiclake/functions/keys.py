"""Place-key expressions and schema-driven column resolution.

Every function here is ``Column -> Column`` (or works on a schema only), so
it compiles into whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "cod_mun_ibge_7"
KEY_LEN = 7

# Column names and patterns the source payloads use.
KEY_ALIASES = ["codigo_ibge", "id_municipio", "CODMUN", "cod_mun", "codmun"]
EVENT_KEY_RENAMES = ["CODMUN", "codigo_ibge", "cod_mun_ibge_7", "codmun"]
DEATH_KEY_CANDIDATES = ["CODMUNRES", "codmunres", "CODESTAB"]
BIRTH_KEY_CANDIDATES = ["CODMUNRES", "codmunres", "CODMUNNASC"]
SCHOOL_KEY_NAMES = [
    "CO_MUNICIPIO", "CO_MUNICÍPIO", "Cod_Municipio", "Código do Município",
    "cod_mun", "cod_mun_ibge_7", "ID_MUNICIPIO", "codigo_ibge",
]
SCHOOL_ENROLMENT_NAMES = ["QT_MAT_BAS", "Matrículas", "Total de Matrículas", "matriculas", "QT_MAT"]
SCHOOL_TEACHER_NAMES = ["QT_DOC", "Docentes", "Total de Docentes", "docentes"]
SCHOOL_SCHOOL_NAMES = ["QT_ESC", "Escolas", "Total de Escolas", "QT_ESTAB", "escolas"]
SCHOOL_KEY_NAME_PATTERN = r"munic[ií]pio|cod.*mun|co_mun|id_mun"   # matched ignoring case
KEY_VALUE_PATTERN = r"^\d{6,7}$"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
            T.FloatType, T.DoubleType, T.DecimalType)


def zfill7(c: Column | str, width: int = KEY_LEN) -> Column:
    """Left-pad with zeros to ``width`` but never shorten (``lpad`` truncates)."""
    s = F.col(c) if isinstance(c, str) else c
    s = s.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def _digits(c: Column, numeric: bool) -> Column:
    if numeric:
        # A number becomes its integer text first: 3550308.0 -> "3550308".
        txt = c.try_cast("bigint").cast("string")
    else:
        txt = F.trim(c.cast("string"))
    return F.regexp_replace(txt, "[^0-9]", "")


def mun_code(c: Column | str, numeric: bool = False, mode: str = "pad") -> Column:
    """Standardise a municipality code to 7 digits.

    null -> null; numbers become integer text; only digits are kept; 6 digits
    are zero-padded (``mode="pad"``) or kept as a 6-digit join prefix
    (``mode="prefix6"``); 7 digits are kept; anything else is null.
    """
    col = F.col(c) if isinstance(c, str) else c
    d = _digits(col, numeric)
    six = F.lpad(d, KEY_LEN, "0") if mode == "pad" else d
    if mode not in ("pad", "prefix6"):
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(F.length(d) == 6, six).when(F.length(d) == 7, d)


def mun_code_of(df: DataFrame, name: str, mode: str = "pad") -> Column:
    """``mun_code`` choosing the numeric or text rule from the column's type."""
    dtype = df.schema[name].dataType
    return mun_code(quoted(name), numeric=isinstance(dtype, _NUMERIC), mode=mode)


def valid_key(c: Column | str = KEY, width: int = KEY_LEN) -> Column:
    """Non-null and exactly ``width`` characters long."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & (F.length(col) == width)


def resolve_column(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """P5: the first candidate present in ``columns`` (schema only, no job)."""
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def rename_first(df: DataFrame, candidates: Sequence[str], target: str) -> DataFrame:
    """P5: rename the first present candidate to ``target``; unchanged if none."""
    src = resolve_column(df.columns, candidates)
    if src is None or src == target:
        return df
    return df.withColumnRenamed(src, target)


def standardise_key(df: DataFrame, column: str = KEY, aliases: Sequence[str] = KEY_ALIASES,
                    mode: str = "pad") -> DataFrame:
    """Clean ``column`` in place, or build it from the first alias present,
    then drop rows whose key is not valid. With no usable column the frame is
    returned unchanged (the reference only logs a warning)."""
    src = column if column in df.columns else resolve_column(df.columns, aliases)
    if src is None:
        return df
    width = 6 if mode == "prefix6" else KEY_LEN
    out = df.withColumn(column, mun_code_of(df, src, mode=mode))
    if mode == "prefix6":
        return out.where(F.col(column).isNotNull())
    return out.where(valid_key(column, width))


def prefix6_join(fact: DataFrame, dim: DataFrame, key: str = KEY, how: str = "left") -> DataFrame:
    """D2 variant: join facts keyed by 6 or 7 digits to a 7-digit dimension on
    the first six digits (the 7th IBGE digit is a check digit)."""
    f = fact.withColumn("_k6", F.substring(F.col(key), 1, 6)).drop(key)
    d = dim.withColumn("_k6", F.substring(F.col(key), 1, 6))
    return f.join(d, "_k6", how).drop("_k6")


def resolve_short_keys(fact: DataFrame, dim: DataFrame, key: str = KEY) -> DataFrame:
    """Six-digit codes that were zero-padded take the whole code of their
    municipality (the 7th digit is a check digit).

    A key that is no municipality's and equals "0" plus the first six digits of
    exactly one code of ``dim`` becomes that code; codes of the dimension, keys
    without a match and prefixes that several codes share stay as they are. Two
    rows of ``fact`` may have one key afterwards: aggregate again."""
    codes = dim.select(F.col(key).alias("_code")).where(F.col("_code").isNotNull()).distinct()
    short = (codes.groupBy(F.concat(F.lit("0"), F.substring("_code", 1, 6)).alias("_short"))
             .agg(F.min("_code").alias("_whole"), F.count(F.lit(1)).alias("_n")).where("_n = 1"))
    both = fact.join(codes, F.col(key) == F.col("_code"), "left").join(short, F.col(key) == F.col("_short"), "left")
    whole = F.when(F.col("_code").isNull(), F.col("_whole"))
    return both.withColumn(key, F.coalesce(whole, F.col(key))).select(*[quoted(c) for c in fact.columns])


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _NUMERIC)


def key_candidates(df: DataFrame, pattern: str = SCHOOL_KEY_NAME_PATTERN) -> list[str]:
    """The columns whose name says that they may be the key, in order."""
    rx = re.compile(pattern, re.IGNORECASE)
    return [c for c in df.columns if rx.search(c.strip())]


def discover_key_column(df: DataFrame, names: Sequence[str] = SCHOOL_KEY_NAMES,
                        pattern: str = SCHOOL_KEY_NAME_PATTERN,
                        value_pattern: str = KEY_VALUE_PATTERN, codes: dict[str, int] | None = None) -> str | None:
    """Key column by exact name, else the first column whose name matches
    ``pattern`` and that is numeric or holds some 6-7 digit value.

    ``codes`` gives the number of such values per text column (a profile of many
    frames taken in one job); without it one aggregate counts them."""
    hit = resolve_column(df.columns, names)
    if hit is not None:
        return hit
    found = key_candidates(df, pattern)
    texts = [c for c in found if not is_numeric(df, c)]
    if codes is None and texts:
        counts = df.agg(*[F.count_if(quoted(c).cast("string").rlike(value_pattern)) for c in texts]).first()
        codes = dict(zip(texts, counts, strict=True))
    return next((c for c in found if is_numeric(df, c) or codes.get(c, 0) > 0), None)


def discover_measure_column(df: DataFrame, names: Sequence[str] = SCHOOL_ENROLMENT_NAMES,
                            fragment: str = "matr") -> str | None:
    """Measure by exact name, else the first numeric column whose lower-case
    name contains ``fragment``."""
    hit = resolve_column(df.columns, names)
    if hit is not None:
        return hit
    return next((c for c in df.columns if fragment in c.lower() and is_numeric(df, c)), None)
