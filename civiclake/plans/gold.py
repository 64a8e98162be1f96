"""Gold builders: indicators per (municipality, year).

Plans are written so each builder shuffles its raw input once, after
map-side partial aggregation (a hot key is pre-combined before the exchange).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake import schemas
from civiclake.functions.keys import KEY, resolve_column
from civiclake.functions.numbers import lenient_double, rate, sum_or_zero
from civiclake.functions.text import upper_matches

YEAR = "ano"

# Facility type patterns and the type-column preference.
HOSPITAL_PATTERN = r"^05$|HOSPITAL"
BASIC_UNIT_PATTERN = r"^01$|^02$|BASICA|UBS"
FACILITY_TYPE_COLUMNS = ["co_tipo_estabelecimento", "tp_estabelecimento", "ds_tipo_estabelecimento"]


def _stamp(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("data_carga", F.current_timestamp()) if stamp else df


def _with_year(df: DataFrame, ano: int | None) -> DataFrame:
    """Give a frame without a year column the requested year."""
    if YEAR in df.columns:
        return df
    if ano is None:
        raise ValueError("frame has no 'ano' column and no year was given")
    return df.withColumn(YEAR, F.lit(int(ano)))


def _year_filter(df: DataFrame, ano: int | None) -> DataFrame:
    """Optional year filter (reaches the scan as a partition/row-group filter)."""
    if ano is not None and YEAR in df.columns:
        return df.where(F.col(YEAR) == F.lit(int(ano)))
    return df


def empty_table(spark, name: str, stamp: bool = True) -> DataFrame:
    """Q3: a typed empty result."""
    sch = schemas.TABLES[name]
    df = spark.createDataFrame([], sch)
    return df if stamp else df.drop("data_carga")


EVENT_KINDS = {"obitos": ("_ob", "total_obitos"), "internacoes": ("_ih", None),
               "nascidos": ("_nv", "nascidos_vivos")}


def health_indicators(pop: DataFrame, deaths: DataFrame | None = None,
                      admissions: DataFrame | None = None, births: DataFrame | None = None,
                      ano: int | None = None, stamp: bool = True) -> DataFrame:
    """Population with deaths, admissions and births per (key, year) and rates
    per 100 000.

    Each event frame is either raw records (one row per event) or pre-counted
    (column ``total_obitos`` / ``nascidos_vivos``). Rows keep the population
    side (left-join semantics); absent events count 0; an absent source gives
    0 and rate 0.0. Zero or null population gives a null rate.
    """
    parts = []
    for kind, frame in (("obitos", deaths), ("internacoes", admissions), ("nascidos", births)):
        if frame is None or KEY not in frame.columns:
            continue
        precounted = EVENT_KINDS[kind][1]
        v = F.col(precounted) if precounted and precounted in frame.columns else F.lit(1)
        frame = _with_year(frame, ano)
        parts.append(frame.select(KEY, YEAR, F.lit(kind).alias("_kind"), v.cast("long").alias("_n")))
    events = reduce(DataFrame.unionByName, parts) if parts else None
    kinds = [k for k, f in (("obitos", deaths), ("internacoes", admissions), ("nascidos", births))
             if f is not None and KEY in f.columns]
    return health_from_events(pop, events, kinds, ano=ano, stamp=stamp)


def health_from_events(pop: DataFrame, events: DataFrame | None, kinds: list[str],
                       ano: int | None = None, stamp: bool = True) -> DataFrame:
    """A8 over one tagged event frame (``KEY``, ``ano``, ``_kind``, ``_n``):
    several event sources read by a single scan when they share a table.

    Plan: population rows and event rows are unioned and aggregated once by
    (key, year) - one shuffle, after map-side partial aggregation, instead of
    one aggregation and one join per source.
    """
    pop = _with_year(pop, ano)
    n = F.lit(None).cast("long")
    measures = [EVENT_KINDS[k][0] for k in EVENT_KINDS]
    u = pop.select(F.col(KEY), F.col(YEAR).cast("int").alias(YEAR),
                   F.col("populacao").cast("long").alias("_pop"), F.lit(1).alias("_is_pop"),
                   *[n.alias(m) for m in measures])
    if events is not None:
        ev = events.where(F.col("_kind").isin(*kinds)).select(F.col(KEY), F.col(YEAR).cast("int").alias(YEAR), n.alias("_pop"),
                           F.lit(0).alias("_is_pop"),
                           *[F.when(F.col("_kind") == k, F.col("_n").cast("long")).alias(m)
                             for k, (m, _) in EVENT_KINDS.items()])
        u = u.unionByName(ev)
    u = _year_filter(u, ano).where(F.col(KEY).isNotNull() & F.col(YEAR).isNotNull())
    g = (u.groupBy(KEY, YEAR)
         .agg(F.max("_pop").alias("populacao"), F.max("_is_pop").alias("_has_pop"),
              *[F.coalesce(F.sum(m), F.lit(0).cast("long")).alias(m) for m in measures])
         .where(F.col("_has_pop") == 1))
    present = {EVENT_KINDS[k][0] for k in kinds}

    def total(m: str) -> Column:
        return F.col(m) if m in present else F.lit(0).cast("long")

    def per100k(m: str) -> Column:
        return rate(F.col(m), F.col("populacao"), 100_000) if m in present else F.lit(0.0)

    out = g.select(
        KEY, YEAR, "populacao",
        total("_ih").alias("total_internacoes"),
        total("_ob").alias("total_obitos"),
        total("_nv").alias("nascidos_vivos"),
        per100k("_ih").alias("taxa_internacao_100k"),
        per100k("_ob").alias("taxa_obitos_100k"),
    )
    return _stamp(out, stamp)


def education_indicators(edu: DataFrame, pop: DataFrame | None = None, ano: int | None = None,
                         stamp: bool = True) -> DataFrame:
    """Enrolments, teachers and schools summed per (key, year); enrolments per
    1 000 inhabitants against the maximum population of the key (over the
    filtered years). No population -> null rate; absent measures -> null."""
    if KEY not in edu.columns:
        return empty_table(edu.sparkSession, "gold_indicadores_educacao_municipio", stamp)
    edu = _year_filter(_with_year(edu, ano), ano).where(F.col(KEY).isNotNull() & F.col(YEAR).isNotNull())
    opt = [c for c in ("docentes", "escolas") if c in edu.columns]
    g = edu.groupBy(KEY, F.col(YEAR).cast("int").alias(YEAR)).agg(
        sum_or_zero(F.col("matriculas").cast("long")).cast("long").alias("matriculas"),
        *[sum_or_zero(F.col(c).cast("long")).cast("long").alias(c) for c in opt])
    for c in ("docentes", "escolas"):
        if c not in opt:
            g = g.withColumn(c, F.lit(None).cast("long"))
    if pop is not None and "populacao" in pop.columns:
        p = (_year_filter(pop, ano).where(F.col(KEY).isNotNull())
             .groupBy(KEY).agg(F.max(F.col("populacao").cast("long")).alias("_pop")))
        g = g.join(p, KEY, "left").withColumn(
            "taxa_matriculas_por_1000_hab", rate("matriculas", "_pop", 1000)).drop("_pop")
    else:
        g = g.withColumn("taxa_matriculas_por_1000_hab", F.lit(None).cast("double"))
    out = g.select(KEY, YEAR, "matriculas", "docentes", "escolas", "taxa_matriculas_por_1000_hab")
    return _stamp(out, stamp)


def gdp_indicators(gdp: DataFrame, ano: int | None = None, stamp: bool = True) -> DataFrame:
    """Max of total and per-capita GDP per (key, year), nulls skipped."""
    if KEY not in gdp.columns:
        return empty_table(gdp.sparkSession, "gold_pib_municipio", stamp)
    g = _year_filter(_with_year(gdp, ano), ano)
    for c in ("pib_total_mil_reais", "pib_per_capita"):
        if c not in g.columns:
            g = g.withColumn(c, F.lit(None).cast("double"))
    out = (g.where(F.col(KEY).isNotNull() & F.col(YEAR).isNotNull())
           .groupBy(KEY, F.col(YEAR).cast("int").alias(YEAR))
           .agg(F.max(F.col("pib_total_mil_reais").cast("double")).alias("pib_total_mil_reais"),
                F.max(F.col("pib_per_capita").cast("double")).alias("pib_per_capita")))
    return _stamp(out, stamp)


def transfer_totals(transfers: DataFrame, stamp: bool = True) -> DataFrame:
    """A5: transfers summed per (key, year); an all-malformed group sums to 0.0.
    Missing key or value column -> empty result (Q3)."""
    if KEY not in transfers.columns or "valor" not in transfers.columns:
        return empty_table(transfers.sparkSession, "gold_transparencia_transferencias", stamp)
    out = (transfers.where(F.col(KEY).isNotNull() & F.col(YEAR).isNotNull())
           .groupBy(KEY, F.col(YEAR).cast("int").alias(YEAR))
           .agg(F.coalesce(F.sum(F.col("valor").cast("double")), F.lit(0.0))
                .alias("total_transferencias_reais")))
    return _stamp(out, stamp)


def facility_counts(records: DataFrame, ano: int | None = None,
                    hospital_pattern: str = HOSPITAL_PATTERN,
                    basic_pattern: str = BASIC_UNIT_PATTERN, stamp: bool = True) -> DataFrame:
    """Facilities per (key, year): total, hospitals and basic units by a
    pattern on the upper-cased type (first present of three type columns),
    and lenient sums of beds and public beds (0 when the column is absent).
    Records whose ``st_ativo`` is other than 'S' are not counted; payloads may
    lack the field, and each record takes the first type column it has."""
    r = _with_year(records, ano)
    if "st_ativo" in r.columns:
        # a payload without the field has been filtered by its request
        r = r.where(F.coalesce(F.col("st_ativo"), F.lit("S")) == "S")
    types = [F.col(c) for c in FACILITY_TYPE_COLUMNS if c in r.columns]
    tcol = F.coalesce(*types) if types else None
    zero = F.lit(0).cast("long")

    def count_like(p: str) -> Column:
        return F.count_if(upper_matches(tcol, p)).cast("long") if types else zero

    def beds(c: str) -> Column:
        if c not in r.columns:
            return zero
        return F.coalesce(F.sum(lenient_double(c)), F.lit(0.0)).cast("long")

    out = (r.where(F.col(KEY).isNotNull())
           .groupBy(KEY, F.col(YEAR).cast("int").alias(YEAR))
           .agg(F.count(F.lit(1)).alias("total_estabelecimentos"),
                count_like(hospital_pattern).alias("hospitais"),
                count_like(basic_pattern).alias("ubs"),
                beds("qt_leito").alias("leitos_totais"),
                beds("qt_leito_sus").alias("leitos_sus")))
    return _stamp(out, stamp)
