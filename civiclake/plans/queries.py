"""Query catalogue: each query is ``(spark, sf_dir) -> DataFrame`` over the
driver's test tables (through ``analogs``), exercising one or more operators.

Columns are aliased exactly as in the matching SQL of ``plans.oracle``.
Load stamps are left out of every query result (they are not reproducible).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.functions.keys import KEY
from civiclake.functions.numbers import round2
from civiclake.plans import analogs as A
from civiclake.plans import gold
from civiclake.sources import payloads

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---- gold builders -------------------------------------------------------------
@query("gold_health")
def gold_health(spark, sf):
    """Flagship: deaths, admissions, births per entity-year joined to population,
    rates per 100 000 (every year)."""
    return gold.health_from_events(A.v_pop(spark, sf), A.tagged_events(spark, sf),
                                   ["obitos", "internacoes", "nascidos"], stamp=False)


@query("gold_health_frames")
def gold_health_frames(spark, sf):
    """The same indicators through the per-source API (one frame per source)."""
    return gold.health_indicators(A.v_pop(spark, sf), deaths=A.deaths(spark, sf),
                                  admissions=A.admissions(spark, sf), births=A.births(spark, sf),
                                  stamp=False)


@query("gold_health_year")
def gold_health_year(spark, sf):
    """Single requested year (P2 on every input, as a pushable date range),
    deaths and births only (the batch run's call: admissions absent -> 0 and
    rate 0.0); one scan of the event table."""
    y = A.REF_YEAR
    return gold.health_from_events(A.v_pop(spark, sf, y), A.tagged_events(spark, sf, y),
                                   ["obitos", "nascidos"], ano=y, stamp=False)


@query("gold_health_precounted")
def gold_health_precounted(spark, sf):
    """Event frames arrive pre-counted (``total_obitos`` / ``nascidos_vivos``)."""
    d = A.deaths(spark, sf).groupBy(KEY, "ano").agg(F.count(F.lit(1)).alias("total_obitos"))
    b = A.births(spark, sf).groupBy(KEY, "ano").agg(F.count(F.lit(1)).alias("nascidos_vivos"))
    return gold.health_indicators(A.v_pop(spark, sf), deaths=d, births=b, stamp=False)


@query("gold_education")
def gold_education(spark, sf):
    return gold.education_indicators(A.education(spark, sf), A.v_pop(spark, sf), stamp=False)


@query("gold_education_year")
def gold_education_year(spark, sf):
    y = A.REF_YEAR
    return gold.education_indicators(A.education(spark, sf, y), A.v_pop(spark, sf, y), ano=y, stamp=False)


@query("gold_education_no_population")
def gold_education_no_population(spark, sf):
    e = A.education(spark, sf).drop("docentes")
    return gold.education_indicators(e, None, stamp=False)


@query("gold_gdp")
def gold_gdp(spark, sf):
    return gold.gdp_indicators(A.gdp(spark, sf), stamp=False)


@query("gold_transfers")
def gold_transfers(spark, sf):
    t = payloads.transfer_rows(A.transfer_records(spark, sf))
    g = gold.transfer_totals(t, stamp=False)
    return g.withColumn("total_transferencias_reais", round2("total_transferencias_reais"))


@query("gold_facilities")
def gold_facilities(spark, sf):
    recs = payloads.facility_rows(A.facility_records(spark, sf), ano=A.REF_YEAR)
    return gold.facility_counts(recs, hospital_pattern="ECONOMY", basic_pattern="SMALL", stamp=False)


# ---- marts and dashboard data ----------------------------------------------------
from civiclake.operators import core  # noqa: E402
from civiclake.plans import marts as M  # noqa: E402
from civiclake.functions import keys as K  # noqa: E402

MAP_UF, MAP_YEAR = "NATION_3", 1998   # the dashboard filter choice of ``mart_filtered``


def _gold(spark, sf) -> dict[str, DataFrame]:
    return {"saude": gold_health(spark, sf), "educacao": gold_education(spark, sf),
            "pib": gold_gdp(spark, sf), "transferencias": gold_transfers(spark, sf),
            "cnes": gold_facilities(spark, sf)}


def _marts(spark, sf) -> dict[str, DataFrame]:
    dim = A.v_entity(spark, sf)
    return {t: M.mart(g, dim, t) for t, g in _gold(spark, sf).items()}


def _mart_query(theme: str):
    def q(spark, sf):
        return M.mart(_gold(spark, sf)[theme], A.v_entity(spark, sf), theme)
    return q


for _t, _n in [("saude", "mart_health"), ("educacao", "mart_education"), ("pib", "mart_gdp"),
               ("transferencias", "mart_transfers"), ("cnes", "mart_facilities")]:
    REGISTRY[_n] = _mart_query(_t)


@query("mart_filtered")
def mart_filtered(spark, sf):
    return core.dashboard_filter(REGISTRY["mart_health"](spark, sf), uf=MAP_UF, ano=MAP_YEAR)


@query("mart_filtered_all")
def mart_filtered_all(spark, sf):
    """``Todos`` on both filters keeps every row; a filter on an absent column is ignored."""
    return core.dashboard_filter(REGISTRY["mart_transfers"](spark, sf).drop("sigla_uf"), uf=MAP_UF)


# KPI rows, map measures and source status use no dimension column except the
# state of the health mart: they read the gold tables directly (the mart's left
# join to unique dimension keys keeps gold rows one to one), which saves a
# dimension join per theme.
@query("kpi_overview")
def kpi_overview(spark, sf):
    g = _gold(spark, sf)
    health = M.mart(g["saude"], A.v_entity(spark, sf), "saude")
    return M.overview_kpis(health, g["educacao"], g["pib"], g["transferencias"], g["cnes"]) \
        .withColumn("pib_total_mil_reais", round2("pib_total_mil_reais"))


@query("kpi_health")
def kpi_health(spark, sf):
    return M.health_tab_kpis(gold_health(spark, sf), gold_facilities(spark, sf))


@query("kpi_education")
def kpi_education(spark, sf):
    return M.education_tab_kpis(gold_education(spark, sf))


@query("kpi_gdp")
def kpi_gdp(spark, sf):
    return M.gdp_kpis(gold_gdp(spark, sf)).withColumn("pib_total_bi", round2("pib_total_bi"))


@query("kpi_filtered")
def kpi_filtered(spark, sf):
    """P4 + A10-A13 + A19: the overview's figures for every choice of state and year."""
    m = _marts(spark, sf)
    return (M.filtered_kpis(m["saude"], m["educacao"], m["pib"], m["transferencias"], m["cnes"])
            .withColumn("pib_total_mil_reais", round2("pib_total_mil_reais"))
            .withColumn("transferencias_bi", F.round("transferencias_bi", 6)))


@query("top_n_measure")
def top_n_measure(spark, sf):
    return core.top_n_labelled(gold_gdp(spark, sf), A.v_entity(spark, sf), "pib_total_mil_reais",
                               "nome_municipio", 10)


@query("sum_by_state")
def sum_by_state(spark, sf):
    return M.state_totals(gold_health(spark, sf), A.v_entity(spark, sf), "populacao")


@query("scatter_pairs")
def scatter_pairs(spark, sf):
    return M.scatter_pairs(REGISTRY["mart_education"](spark, sf), "escolas", "docentes")


@query("filter_values")
def filter_values(spark, sf):
    m = _marts(spark, sf)
    return M.filter_values([m["saude"], m["educacao"], m["pib"]])


@query("source_status")
def source_status(spark, sf):
    return M.source_status(_gold(spark, sf))


@query("map_points")
def map_points(spark, sf):
    """Centroids landed as CSV (S13), first row per key (U3), joined to the
    health mart (J4), one point per municipality with radius and label."""
    from civiclake.session import scratch_dir
    path = scratch_dir(spark, "centroides")
    A.centroids(spark, sf).withColumnRenamed("_dup", "ordem").write.option("header", True).csv(path)
    cents = M.first_centroids(payloads.read_centroids(spark, path))
    return M.map_points(REGISTRY["mart_health"](spark, sf), cents, "saude", "populacao")


@query("map_measures")
def map_measures(spark, sf):
    return M.map_measures(_gold(spark, sf))


# ---- sampling, fallbacks, keys, checks ------------------------------------------------
@query("stratified_sample")
def stratified_sample(spark, sf):
    return core.stratified_sample(A.v_entity(spark, sf), n=100)


@query("stratified_sample_10")
def stratified_sample_10(spark, sf):
    return core.stratified_sample(A.v_entity(spark, sf), n=10)


@query("year_backoff")
def year_backoff(spark, sf):
    """population asked for 2002 (absent) falls back to 2001."""
    return core.preferred_year(A.v_pop(spark, sf), core.backoff_years(2002))


@query("year_lagged_preference")
def year_lagged_preference(spark, sf):
    """GDP asked for 2002 with publication lag after 2000 tries 2000, 1999, 2001."""
    rows = core.preferred_year(A.gdp(spark, sf), core.lagged_years(2002, lag_after=2000))
    return gold.gdp_indicators(rows, stamp=False)


@query("source_preference")
def source_preference(spark, sf):
    """Primary source empty -> the secondary one is used."""
    ev = A.table(spark, sf, "events")
    frames = [ev.where(F.col("event_type") == t).select("event_id", "user_id", "value")
              for t in ("refund", "purchase", "click")]
    return core.first_non_empty(frames)


@query("key_standardise")
def key_standardise(spark, sf):
    return K.standardise_key(A.raw_codes(spark, sf))


@query("key_prefix6_join")
def key_prefix6_join(spark, sf):
    raw = K.standardise_key(A.raw_codes(spark, sf), mode="prefix6")
    dim = A.v_entity(spark, sf).select(KEY, "nome_municipio")
    return K.prefix6_join(raw.select("c_custkey", KEY), dim.withColumnRenamed(KEY, "_dk")
                          .withColumn(KEY, F.col("_dk")), how="inner") \
        .select("c_custkey", F.col("_dk").alias("cod_dim"), "nome_municipio")


@query("alias_resolve")
def alias_resolve(spark, sf):
    c = A.table(spark, sf, "customer").select(
        (F.col("c_custkey") + 3_000_000).alias("CODMUN"), F.col("c_name").alias("nomeMunicipio"),
        F.col("c_acctbal").cast("string").alias("valor"))
    t = payloads.transfer_rows(c)
    t = K.standardise_key(t)
    from civiclake import schemas as S
    return core.require_columns(t, [KEY, "valor"], S.TABLES["gold_transparencia_transferencias"]) \
        .select(KEY, "nome_municipio", "valor")


@query("key_uniqueness")
def key_uniqueness(spark, sf):
    return core.duplicate_keys(A.gdp(spark, sf))


@query("orphan_keys")
def orphan_keys(spark, sf):
    return core.orphan_keys(K.standardise_key(A.raw_codes(spark, sf)), A.v_entity(spark, sf))


# Source, snapshot and sink queries register themselves on import.
from civiclake.plans import io_queries  # noqa: E402,F401


@query("mart_health_ordered")
def mart_health_ordered(spark, sf):
    """The health mart in display order (population descending, nulls last);
    a range-partitioned global sort."""
    return M.mart(gold_health(spark, sf), A.v_entity(spark, sf), "saude", ordered=True)
