"""Scans of landed record files: per-state event records (Parquet), school
microdata (delimited text), census synopsis sheets of differing schema.

Schema decisions (which column is the key, which separator) are made per
file from metadata (footers, header lines), as columns of an inventory that one
job takes; files that decide the same way are read in one scan, and all scans feed
one aggregation (one shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions.keys import (
    BIRTH_KEY_CANDIDATES, DEATH_KEY_CANDIDATES, KEY, KEY_VALUE_PATTERN, SCHOOL_ENROLMENT_NAMES, SCHOOL_KEY_NAMES,
    SCHOOL_SCHOOL_NAMES, SCHOOL_TEACHER_NAMES, discover_key_column, discover_measure_column,
    is_numeric, key_candidates, mun_code, mun_code_of, quoted, resolve_column, valid_key,
)
from civiclake.functions.numbers import lenient_double
from civiclake.operators.core import union_all
from civiclake.sources import inventory

# Microdata file selection and the header key marker.
MICRODATA_NAME_FRAGMENT = "matricula"
MICRODATA_KEY_MARKER = "CO_MUNICIPIO"
SEPARATORS = [";", ","]


@dataclass
class ScanReport:
    """Files used and files skipped (unreadable, or without a usable column)."""
    used: list[str] = field(default_factory=list)
    skipped: list[tuple[str, str]] = field(default_factory=list)


def auto_code(c: Column | str) -> Column:
    """N3 for text read from files: a number-looking value uses the numeric
    rule (``3550308.0`` -> 3550308), anything else the text rule."""
    s = F.col(c) if isinstance(c, str) else c
    s = s.cast("string")
    numeric = s.rlike(r"^\s*[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*$")
    return F.when(numeric, mun_code(s.try_cast("double"), numeric=True)).otherwise(mun_code(s))


# ---- S5/S6: event records per state file --------------------------------------------
def event_counts(spark: SparkSession, path: str, candidates: Sequence[str], out: str,
                 ano: int | None = None, report: ScanReport | None = None,
                 states: Sequence[str] | None = None) -> DataFrame:
    """S5/S6 + A1/A2: count records per (key, year) over per-state Parquet files.

    One job takes the inventory: files, the values of their ``uf=``/``ano=`` folders
    and their footers. Per file the key column is the first of ``candidates``
    present; files without one, or whose footer cannot be read, are skipped and
    reported. Files of one layout (key column, its type, type of a year column) are
    read together with that schema; one aggregation counts all of them. A file that
    fails later fails the job: no record is lost without a trace.

    The year is that of the file's folder, else its ``ano`` column, else the
    requested ``ano``. ``states`` and ``ano`` prune folders before anything is read.
    """
    report = report if report is not None else ScanReport()
    found = inventory.footers(inventory.landed_files(spark, path, ".parquet", states=states, ano=ano))
    key = inventory.first_present("columns", candidates)
    rows = found.select("path", F.when(F.col("error").isNull(), key).alias("col"), "columns", "error").select(
        "path", "col", inventory.type_of("columns", F.col("col")).alias("kind"), inventory.type_of("columns", "ano").alias("year_kind"),
        F.when(F.col("error").isNotNull(), F.concat(F.lit("unreadable: "), "error")).when(F.col("col").isNull(), F.lit("no key column")).alias("reason"))
    parts = []
    for g in inventory.layouts(rows, ["reason", "col", "kind", "year_kind"]):
        if g["reason"]:   # an unreadable file is skipped, as the source does
            report.skipped += [(f, g["reason"]) for f in g["paths"]]
            continue
        report.used += g["paths"]
        fields = [T.StructField(g["col"], T.DataType.fromDDL(g["kind"]))]
        if g["year_kind"]:
            fields.append(T.StructField("ano", T.DataType.fromDDL(g["year_kind"])))
        df = spark.read.schema(T.StructType(fields)).parquet(*g["paths"])
        year = F.coalesce(inventory.folder_value("_metadata.file_path", "ano").try_cast("int"),
                          F.col("ano").cast("int") if g["year_kind"] else F.lit(ano).cast("int"))
        parts.append(df.select(mun_code_of(df, g["col"]).alias(KEY), year.alias("ano")))
    if not parts:
        return spark.createDataFrame([], f"{KEY} string, ano int, {out} long")
    rows = union_all(parts).where(F.col(KEY).isNotNull())
    if ano is not None:
        rows = rows.where(F.col("ano") == F.lit(int(ano)))
    return rows.groupBy(KEY, "ano").agg(F.count(F.lit(1)).alias(out))


def death_counts(spark, path, ano=None, report=None, states=None):
    return event_counts(spark, path, DEATH_KEY_CANDIDATES, "total_obitos", ano, report, states)


def birth_counts(spark, path, ano=None, report=None, states=None):
    return event_counts(spark, path, BIRTH_KEY_CANDIDATES, "nascidos_vivos", ano, report, states)


# ---- S8: school microdata (delimited text) ---------------------------------------------
def header_layout(header: Column, encoding: str | None) -> Column:
    """(encoding, sep, at, n) of a header line given as latin-1 text, null without a
    key column: the separator under which some field, upper-cased without spaces,
    contains the key marker and no other separator (D7: a ';' probe of a ',' header
    yields one wide field). Without a given encoding it is UTF-8 if the header
    decodes so, else latin-1."""
    raw = F.encode(header, "ISO-8859-1").cast("string")
    utf8 = F.is_valid_utf8(raw)
    enc = F.lit(encoding) if encoding else F.when(utf8, F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1"))
    text = F.when(enc == "UTF-8", F.try_validate_utf8(raw)).otherwise(header)
    text = F.regexp_replace(text, "^\\ufeff", "")
    found = []
    for sep in SEPARATORS:
        others = [o for o in SEPARATORS if o != sep]
        cols = F.split(text, sep)

        def is_key(c: Column) -> Column:
            hit = F.contains(F.replace(F.upper(F.regexp_replace(F.trim(c), '^"+|"+$', "")), F.lit(" ")), F.lit(MICRODATA_KEY_MARKER))
            for o in others:
                hit &= ~F.contains(c, F.lit(o))
            return hit

        at = F.array_position(F.transform(cols, is_key), F.lit(True)) - 1
        found.append(F.when(at >= 0, F.struct(enc.alias("encoding"), F.lit(sep).alias("sep"), at.cast("int").alias("at"), F.size(cols).alias("n"),
                                              text.alias("header"))))
    return F.coalesce(*found)


def microdata_counts(spark: SparkSession, path: str, ano: int, encoding: str | None = None,
                     report: ScanReport | None = None) -> DataFrame:
    """S8 + A1: enrolment rows per municipality from ``*matricula*.csv`` files;
    only the key column is read; invalid keys are dropped; the year is the
    requested year. One job reads all header lines; files are read together only if
    their whole header is the same, since CSV columns are matched by position."""
    report = report if report is not None else ScanReport()
    found = inventory.headers(inventory.landed_files(spark, path, ".csv", MICRODATA_NAME_FRAGMENT))
    rows = found.select("path", "error", header_layout(F.coalesce("header", F.lit("")), encoding).alias("layout"))
    rows = rows.select("path", "layout.*", F.when(F.col("error").isNotNull(), F.concat(F.lit("unreadable: "), "error"))
                       .when(F.col("layout").isNull(), F.lit("no key column")).alias("reason"))
    parts = []
    for g in inventory.layouts(rows, ["reason", "encoding", "sep", "at", "n", "header"]):
        if g["reason"]:
            report.skipped += [(f, g["reason"]) for f in g["paths"]]
            continue
        report.used += g["paths"]
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(g["n"])])
        df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
              .option("sep", g["sep"]).option("encoding", g["encoding"]).csv(g["paths"]))
        parts.append(df.select(auto_code(F.col(f"c{g['at']}")).alias(KEY)))
    if not parts:
        return spark.createDataFrame([], f"{KEY} string, matriculas long, ano int")
    rows = union_all(parts).where(valid_key(KEY))
    return (rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("matriculas"))
            .withColumn("ano", F.lit(int(ano))))


# ---- S9: census synopsis sheets -----------------------------------------------------------
def read_sheets(spark: SparkSession, paths: Sequence[str], report: ScanReport | None = None) -> list[DataFrame]:
    """The sheets in these folders, with the schemas found by one inventory job (no
    job per sheet). A sheet is a folder; its first file names its columns."""
    roots = [p.rstrip("/") for p in paths]
    found = inventory.footers(inventory.landed_files(spark, roots, ".parquet"))
    tail = F.substring_index(F.regexp_replace("path", "/[^/]+$", ""), ":", -1)     # the folder, without its scheme
    first = found.groupBy(F.regexp_replace(tail, "^/+", "/").alias("folder")).agg(F.min_by(F.struct("columns", "error"), "path").alias("c")).select("folder", "c.*")
    by_folder = {r["folder"]: r for r in first.collect()}
    sheets = []
    for p in roots:
        r = by_folder.get("/" + p.split(":", 1)[-1].lstrip("/"))
        if r is None or r["error"]:
            if report is not None:
                report.skipped.append((p, f"unreadable: {r['error']}" if r else "no file"))
            continue
        schema = T.StructType([T.StructField(c["name"], T.DataType.fromDDL(c["type"])) for c in r["columns"] if c["type"] != "unknown"])
        sheets.append(spark.read.schema(schema).parquet(p))
    return sheets


def column_profile(sheets: Sequence[DataFrame]) -> dict[int, tuple[int, dict[str, int]]]:
    """P6 as data: per sheet its number of rows and, for the text columns that might
    be the key by name only, how many values look like a code. The sheets' tests are
    one frame, counted in one aggregation (a few columns are read, one row per task
    and sheet is shuffled)."""
    open_ = [[c for c in key_candidates(s) if not is_numeric(s, c)] if resolve_column(s.columns, SCHOOL_KEY_NAMES) is None else [] for s in sheets]
    width = range(max(map(len, open_), default=0))
    parts = []
    for i, (s, cols) in enumerate(zip(sheets, open_, strict=True)):
        looks = [F.coalesce(quoted(cols[j]).cast("string").rlike(KEY_VALUE_PATTERN), F.lit(False)) if j < len(cols) else F.lit(False) for j in width]
        parts.append(s.select(F.lit(i).alias("sheet"), *[x.alias(f"c{j}") for j, x in enumerate(looks)]))
    if not parts:
        return {}
    rows = union_all(parts).groupBy("sheet").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(f"c{j}").alias(f"c{j}") for j in width]).collect()
    found = {i: (0, {}) for i in range(len(sheets))}
    return found | {r["sheet"]: (r["n"], {c: r[f"c{j}"] for j, c in enumerate(open_[r["sheet"]])}) for r in rows}


def sheet_rows(sheet: DataFrame, ano: int | None = None, codes: dict[str, int] | None = None) -> DataFrame | None:
    """One synopsis sheet normalised to (key, enrolments[, teachers][, schools], year),
    or None when the sheet has no key or no enrolment column. Column choice is
    by name (P6), then by pattern and content (``codes``: a profile's counts)."""
    kc = discover_key_column(sheet, codes=codes)
    if kc is None:
        return None
    mc = discover_measure_column(sheet, SCHOOL_ENROLMENT_NAMES)
    if mc is None:
        return None
    sel = [mun_code_of(sheet, kc).alias(KEY), lenient_double(quoted(mc)).alias("matriculas")]
    tc = resolve_column(sheet.columns, SCHOOL_TEACHER_NAMES)
    sc = resolve_column(sheet.columns, SCHOOL_SCHOOL_NAMES)
    if tc:
        sel.append(lenient_double(quoted(tc)).alias("docentes"))
    if sc:
        sel.append(lenient_double(quoted(sc)).alias("escolas"))
    if ano is not None and "ano" in sheet.columns:     # a sheet of several years
        sheet = sheet.where(F.col("ano").cast("int") == F.lit(int(ano)))
    year = F.lit(int(ano)) if ano is not None else F.col("ano")
    sel.append(year.cast("int").alias("ano"))
    return sheet.select(*sel).where(valid_key(KEY))


def synopsis_sums(sheets: Sequence[DataFrame], ano: int | None = None, min_rows: int = 0,
                  report: ScanReport | None = None) -> DataFrame | None:
    """S9 + U1 + A4: normalise every usable sheet, union by name (absent measure
    columns null) and sum the measures present per (key, year); an all-null
    measure sums to 0. Sheets with fewer than ``min_rows`` rows are skipped
    and reported. One profile job serves the row counts and the choice of columns."""
    parts = []
    profile = column_profile(sheets)
    for i, s in enumerate(sheets):
        n, codes = profile[i]
        if n < min_rows:
            if report is not None:
                report.skipped.append((f"sheet {i}", f"fewer than {min_rows} rows"))
            continue
        r = sheet_rows(s, ano, codes)
        if r is not None:
            parts.append(r)
    if not parts:
        return None
    u = union_all(parts)
    opt = [c for c in ("docentes", "escolas") if c in u.columns]
    return u.groupBy(KEY, "ano").agg(
        F.coalesce(F.sum("matriculas"), F.lit(0.0)).alias("matriculas"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in opt])
