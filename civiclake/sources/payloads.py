"""Scans of landed API payloads (JSON) and their normalisation to lake rows.

Each source has a ``read_*`` (path -> DataFrame, explicit schema, no
inference) and a ``*_rows`` function working on already-parsed rows, so a
payload can come from files or from a JSON text column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake import schemas
from civiclake.functions.keys import KEY, zfill7
from civiclake.functions.numbers import lenient_double, locale_count, locale_double
from civiclake.functions.text import truthy_number, truthy_text, unwrap_envelope, year_used, year_value

# Payload field names and the renames applied to them.
TRANSFER_RENAMES = {
    "codigoMunicipio": "cod_ibge_6",
    "nomeMunicipio": "nome_municipio",
    "siglaUf": "sigla_uf",
    "anoReferencia": "ano",
    "mesReferencia": "mes",
    "nomeTipoTransferencia": "tipo_transferencia",
    "valor": "valor",
}
TRANSFER_ENVELOPE = ["data", "items"]
FACILITY_ENVELOPE = ["estabelecimentos", "data", "items"]
VACCINATION_ENVELOPE = ["results"]
GDP_TOTAL_VAR = "37"
GDP_PER_CAPITA_VAR = "498"


# ---- S1: municipality list ----------------------------------------------------
def read_municipalities(spark: SparkSession, path: str) -> DataFrame:
    """S1 scan of a landed JSON array (one file may hold the whole array)."""
    raw = spark.read.schema(schemas.MUNICIPALITY_JSON).option("multiLine", True).json(path)
    return municipality_rows(raw)


def municipality_rows(raw: DataFrame) -> DataFrame:
    """Flatten id/name/micro->meso->UF; an absent or non-object level gives
    state '' and a null state code; falsy id or name drops the row; the id is
    zero-filled to 7 (never shortened)."""
    uf = F.col("microrregiao.mesorregiao.UF")
    return (raw.where(truthy_number("id") & truthy_text("nome"))
            .select(zfill7(F.col("id").cast("string")).alias(KEY),
                    F.col("nome").alias("nome_municipio"),
                    F.coalesce(uf["sigla"], F.lit("")).alias("sigla_uf"),
                    uf["id"].cast("int").alias("cod_uf")))


def municipality_rows_from_text(df: DataFrame, column: str = "payload") -> DataFrame:
    """S1 from JSON texts (one municipality object per row), exact about the
    state abbreviation: present in the UF object -> its value (even a JSON
    null); absent, or any level missing or not an object -> ''. (Parsing into a
    struct alone cannot tell a null field from an absent one.)"""
    raw = df.select(F.col(column).alias("_t"), F.from_json(column, schemas.MUNICIPALITY_JSON).alias("_m"))
    uf_text = F.get_json_object("_t", "$.microrregiao.mesorregiao.UF")
    has_sigla = F.coalesce(F.array_contains(F.json_object_keys(uf_text), "sigla"), F.lit(False))
    uf = F.col("_m.microrregiao.mesorregiao.UF")
    m = F.col("_m")
    return (raw.where(truthy_number(m["id"]) & truthy_text(m["nome"]))
            .select(zfill7(m["id"].cast("string")).alias(KEY),
                    m["nome"].alias("nome_municipio"),
                    F.when(has_sigla, uf["sigla"]).otherwise(F.lit("")).alias("sigla_uf"),
                    uf["id"].cast("int").alias("cod_uf")))


# ---- S2/S3/S4/S18: SIDRA series ---------------------------------------------
def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Scan of landed series payloads: each file is a JSON array of variables."""
    return (spark.read.schema(schemas.SERIES_ITEM).option("multiLine", True).json(path))


def series_from_text(df: DataFrame, column: str = "payload") -> DataFrame:
    """Parse a column of series JSON texts into one row per variable item, with
    the payload position kept for last-wins ordering."""
    parsed = df.select(F.posexplode(F.from_json(column, schemas.SERIES_JSON)).alias("_item_pos", "_item"))
    return parsed.select("_item_pos", "_item.*")


def _series_points(items: DataFrame) -> DataFrame:
    """item -> resultados -> series: one row per (variable, place) with a
    total payload order ``_ord``."""
    if "_item_pos" not in items.columns:
        items = items.withColumn("_item_pos", F.lit(0))
    a = items.select(F.col("id").alias("_var"), "_item_pos",
                     F.posexplode_outer("resultados").alias("_res_pos", "_res"))
    b = a.select("_var", "_item_pos", "_res_pos",
                 F.posexplode_outer("_res.series").alias("_ser_pos", "_ser"))
    return b.select("_var", F.struct("_item_pos", "_res_pos", "_ser_pos").alias("_ord"),
                    F.col("_ser.localidade.id").alias("_loc"), F.col("_ser.serie").alias("_serie"))


def population_rows(items: DataFrame, ano: int) -> DataFrame:
    """S3: population at ``ano`` (else the latest 4-digit year, labelled ``ano``;
    ``ano_origem`` says which). Malformed values stay as null; a missing value
    drops the row; a falsy place id drops the row."""
    p = _series_points(items).where(truthy_text("_loc"))
    v = year_value("_serie", ano)
    return (p.where(v.isNotNull())
            .select(zfill7("_loc").alias(KEY), F.lit(int(ano)).alias("ano"),
                    locale_count(v).alias("populacao"),
                    year_used("_serie", ano).alias("ano_origem")))


def population_exact_year(items: DataFrame, ano: int) -> DataFrame:
    """Single-key lookup of one exact year, integer-cast (no fallback)."""
    p = _series_points(items)
    v = F.try_element_at("_serie", F.lit(str(ano)))
    return p.where(v.isNotNull()).select(
        zfill7("_loc").alias(KEY), F.lit(int(ano)).alias("ano"),
        F.when(v.rlike(r"^\s*[+-]?[0-9]+\s*$"), v.try_cast("long")).alias(f"populacao_{ano}"))


def gdp_rows(items: DataFrame, ano: int, total_var: str = GDP_TOTAL_VAR,
             per_capita_var: str = GDP_PER_CAPITA_VAR, exact: bool = False) -> DataFrame:
    """Two variables pivoted to columns over the union of keys. Per
    variable and key the last valid value in payload order wins; malformed or
    missing values are skipped; an absent id becomes '0000000' and ids longer
    than 7 characters are dropped. With ``exact`` only values of the year itself
    count, else a missing year takes the latest one.

    The pivot is one ``groupBy(key)`` with ``max_by`` per variable: the keyed
    full outer merge of the two measures in a single shuffle.
    """
    p = _series_points(items)
    code = zfill7(F.coalesce(F.col("_loc"), F.lit("")))
    val = locale_double(F.try_element_at("_serie", F.lit(str(ano))) if exact else year_value("_serie", ano))
    pts = (p.select(F.col("_var").cast("string").alias("_var"), "_ord", code.alias(KEY), val.alias("_v"))
           .where((F.length(KEY) == 7) & F.col("_v").isNotNull()))

    def last(var: str):
        hit = F.col("_var") == var
        return F.max_by(F.when(hit, F.col("_v")), F.when(hit, F.col("_ord")))

    return (pts.where(F.col("_var").isin(total_var, per_capita_var))
            .groupBy(KEY)
            .agg(last(total_var).alias("pib_total_mil_reais"), last(per_capita_var).alias("pib_per_capita"))
            .select(KEY, F.lit(int(ano)).alias("ano"), "pib_total_mil_reais", "pib_per_capita"))


def gdp_by_preference(items: DataFrame, years: Sequence[int], total_var: str = GDP_TOTAL_VAR,
                      per_capita_var: str = GDP_PER_CAPITA_VAR) -> tuple[DataFrame, int]:
    """S4 + F3 from one parse: GDP rows of the first year in ``years`` that was landed,
    else the latest value of every place under the first year's label; and the year
    used as label.

    Each place's map is looked up once for all candidate years; the pivot holds one
    column per variable and candidate (a few per municipality) and is written once,
    so that asking which candidate has values reads a small table."""
    from civiclake.session import materialize
    p = _series_points(items)
    code = zfill7(F.coalesce(F.col("_loc"), F.lit("")))
    values = {f"y{i}": locale_double(F.try_element_at("_serie", F.lit(str(y)))) for i, y in enumerate(years)}
    values["last"] = locale_double(year_value("_serie", years[0]))
    names = {"t": total_var, "c": per_capita_var}
    pts = (p.select(F.col("_var").cast("string").alias("_var"), "_ord", code.alias(KEY), *[v.alias(n) for n, v in values.items()])
           .where((F.length(KEY) == 7) & F.col("_var").isin(*names.values())))

    def last(var: str, value: str):
        hit = (F.col("_var") == var) & F.col(value).isNotNull()
        return F.max_by(F.when(hit, F.col(value)), F.when(hit, F.col("_ord")))

    wide = pts.groupBy(KEY).agg(*[last(v, n).alias(f"{k}_{n}") for k, v in names.items() for n in values])
    wide = materialize(wide, "gdp-candidates")
    filled = wide.agg(*[F.count_if(F.col(f"t_{n}").isNotNull() | F.col(f"c_{n}").isNotNull()).alias(n) for n in values]).first()
    use = next((f"y{i}" for i in range(len(years)) if filled[f"y{i}"]), "last")
    ano = years[0] if use == "last" else years[int(use[1:])]
    rows = wide.select(KEY, F.lit(int(ano)).alias("ano"), F.col(f"t_{use}").alias("pib_total_mil_reais"), F.col(f"c_{use}").alias("pib_per_capita"))
    return rows.where("pib_total_mil_reais is not null or pib_per_capita is not null"), ano


def restrict_keys(df: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """Keep rows whose key is in ``keys`` (a semi join; the key frame is
    broadcast by the planner when its measured size allows)."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


# ---- S7/S10/S11: paged JSON with envelopes ------------------------------------
def records_from_pages(pages: DataFrame, column: str, element: T.StructType,
                       envelope: Sequence[str]) -> DataFrame:
    """N9 + explode: one row per record of each page text (bare list or envelope)."""
    recs = unwrap_envelope(column, element, envelope)
    return pages.select(F.explode(recs).alias("_r")).select("_r.*")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file text scan of landed page files (one payload per file)."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def transfer_rows(records: DataFrame, ano: int | None = None) -> DataFrame:
    """Rename the fields present, zero-fill the 6-digit code to 7, parse the
    value leniently; the year is the requested year when one is given."""
    df = records.withColumnsRenamed({k: v for k, v in TRANSFER_RENAMES.items() if k in records.columns})
    if "cod_ibge_6" in df.columns:
        df = df.withColumn(KEY, zfill7(F.col("cod_ibge_6").cast("string")))
    if "valor" in df.columns:
        df = df.withColumn("valor", lenient_double("valor"))
    if ano is not None:
        df = df.withColumn("ano", F.lit(int(ano)))
    return df


def facility_rows(records: DataFrame, ano: int, keys: DataFrame | None = None) -> DataFrame:
    """Facility records keyed by the requested municipality code, for one
    year; optionally restricted to a key list. A code of more than 7 characters
    is no municipality's: its key is null."""
    code = F.col("co_municipio").cast("string")
    df = records.withColumn(KEY, F.when(F.length(code) <= 7, zfill7(code)))
    df = df.withColumn("ano", F.lit(int(ano)))
    return restrict_keys(df, keys) if keys is not None else df


def variant_records(pages: DataFrame, column: str, envelope: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """N9 without a schema: one row per record (``record``, a VARIANT) of every page
    that is a list or an object whose first *present* field among ``envelope`` is one;
    a field that is there but null, a scalar or text that is no JSON yields none.

    The page is parsed once into Spark's binary variant, which keeps what a fixed
    schema loses: a field that is absent, null or of another type. The records are
    rebalanced after parsing, so that one page with a very long list does not leave
    all its records in one task."""
    v = F.try_parse_json(column)
    inner = F.coalesce(*[F.try_variant_get(v, f"$.{f}", "variant") for f in envelope])
    found = F.when(F.ltrim(F.col(column)).startswith("["), v).otherwise(inner)
    parsed = pages.select(*keep, found.alias("_found"))
    return parsed.select(*keep, F.explode(F.expr("try_cast(_found as array<variant>)")).alias("record")).hint("rebalance")


def variant_fields(records: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The named fields of ``record`` as text (null if null or absent), each with
    ``tem_<field>``: whether the record has the field at all."""
    r = F.col("record")
    return records.select(*keep, *[F.try_variant_get(r, f"$.{f}", "string").alias(f) for f in fields],
                          *[F.try_variant_get(r, f"$.{f}", "variant").isNotNull().alias(f"tem_{f}") for f in fields])


# The fields of a facility record, and its type columns in order of preference.
FACILITY_TYPES = ["co_tipo_estabelecimento", "tp_estabelecimento", "ds_tipo_estabelecimento"]
FACILITY_FIELDS = ["co_municipio", "st_ativo", *FACILITY_TYPES, "qt_leito", "qt_leito_sus"]


def facility_rows_from_variants(pages: DataFrame, column: str, ano: int, group: str | None = None) -> DataFrame:
    """S11 + Q3 with the columns that the payloads have: (key, ano, st_ativo, type
    column, beds), ready for ``gold.facility_counts``.

    A field counts as a column if any record has it: then a record without it has a
    null there, as in a frame built from the records. The type is the first type
    column that exists, even where a later one is filled; records whose ``st_ativo``
    is not 'S' are out if the column exists at all, and none are if it does not.
    ``group`` names a column of ``pages`` whose values are payloads of their own."""
    from civiclake.session import materialize
    keep = [group] if group else []
    rows = variant_fields(variant_records(pages, column, FACILITY_ENVELOPE, keep), FACILITY_FIELDS, keep)
    rows = materialize(rows, "facility-fields")       # read twice: for what exists, and for the records
    flags = [f"tem_{f}" for f in ["st_ativo", *FACILITY_TYPES]]
    bare = rows.drop(*[f"tem_{f}" for f in FACILITY_FIELDS])
    if keep:
        bare = bare.join(rows.groupBy(*keep).agg(*[F.max(f).alias(f) for f in flags]), group)
    else:
        bare = bare.withColumns({f: F.coalesce(rows.select(F.max(f)).scalar(), F.lit(False)) for f in flags})
    kind = F.coalesce(*[F.when(F.col(f"tem_{t}"), F.struct(F.col(t).alias("v"))) for t in FACILITY_TYPES])
    active = ~F.col("tem_st_ativo") | F.coalesce(F.col("st_ativo") == "S", F.lit(False))
    out = bare.where(active).select(*keep, "co_municipio", F.lit("S").alias("st_ativo"), kind["v"].alias(FACILITY_TYPES[0]), "qt_leito", "qt_leito_sus")
    return facility_rows(out, ano)


def vaccination_rows(pages: DataFrame, element: T.StructType, column: str = "payload") -> DataFrame:
    """Vaccination records from pages that are a ``{"results": [...]}``
    envelope or a bare list; any other payload yields no rows."""
    return records_from_pages(pages, column, element, VACCINATION_ENVELOPE)


def file_position() -> Column:
    """Where a row of a scanned text file stands: file, start of its split, place in
    the split. The order of these is the order of the files, however Spark cuts them
    and packs the splits into tasks."""
    return F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Centroid CSV (header, explicit schema); the code is read as text and
    zero-filled to 7; key, coordinates and the row order are kept. The order is
    the file's ``ordem`` column when present, then the position in the files.
    Duplicates are resolved by the caller (first row per key)."""
    raw = spark.read.option("header", True).schema(schemas.CENTROIDS_CSV).csv(path)
    return raw.select(zfill7("codigo_ibge").alias(KEY), "latitude", "longitude",
                      F.struct(F.coalesce("ordem", F.lit(0)).alias("o"), file_position().alias("p")).alias("ordem"))
