"""Serving marts: star joins of gold tables to the municipality dimension, KPI
rows, rankings, state sums, scatter extracts, filter lists, source status and
map points - the data behind every dashboard panel, as DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.functions.keys import KEY
from civiclake.functions.numbers import sum_or_zero, value_text
from civiclake.operators import core

DIM_COLUMNS = ["nome_municipio", "sigla_uf"]

# The measure columns of each mart (in display order).
MART_MEASURES = {
    "saude": ["populacao", "total_internacoes", "total_obitos", "nascidos_vivos",
              "taxa_internacao_100k", "taxa_obitos_100k"],
    "educacao": ["matriculas", "docentes", "escolas", "taxa_matriculas_por_1000_hab"],
    "pib": ["pib_total_mil_reais", "pib_per_capita"],
    "transferencias": ["total_transferencias_reais"],
    "cnes": ["total_estabelecimentos", "hospitais", "ubs", "leitos_totais", "leitos_sus"],
}
# The measure that orders each mart.
MART_ORDER = {
    "saude": "populacao", "educacao": "matriculas", "pib": "pib_total_mil_reais",
    "transferencias": "total_transferencias_reais", "cnes": "total_estabelecimentos",
}
# Map layers (theme) and their indicator options, label -> column.
MAP_OPTIONS = {
    "saude": [("População", "populacao"), ("Óbitos", "total_obitos"),
              ("Nascidos vivos", "nascidos_vivos"), ("Taxa de óbitos (por 100k)", "taxa_obitos_100k")],
    "educacao": [("Matrículas", "matriculas"), ("Docentes", "docentes"), ("Escolas", "escolas"),
                 ("Taxa matrículas (por 1k hab.)", "taxa_matriculas_por_1000_hab")],
    "pib": [("PIB total (R$ mil)", "pib_total_mil_reais"), ("PIB per capita (R$)", "pib_per_capita")],
    "cnes": [("Estabelecimentos de saúde", "total_estabelecimentos"), ("Leitos hospitalares", "leitos_totais"),
             ("Hospitais", "hospitais"), ("UBS", "ubs")],
}
# Marker radius rule.
RADIUS_MIN, RADIUS_MAX, RADIUS_SPAN, RADIUS_FLAT_SCALE = 5, 28, 22.0, 0.01


def mart(gold: DataFrame, dim: DataFrame, theme: str, ordered: bool = False, stamp: bool = False) -> DataFrame:
    """Gold fact left-joined to the dimension for name and state; with ``stamp``
    also the fact's load time.

    The planner picks the join: a broadcast when the measured dimension is
    under the broadcast threshold, else a shuffle join on the key. Display
    order (T2, measure descending) only on request: it is a global sort.
    """
    measures = [c for c in [*MART_MEASURES[theme], *["data_carga"] * stamp] if c in gold.columns]
    d = dim.select(KEY, *DIM_COLUMNS)
    out = gold.join(d, KEY, "left").select(KEY, *DIM_COLUMNS, "ano", *measures)
    if ordered:
        out = out.orderBy(F.col(MART_ORDER[theme]).desc_nulls_last(), F.col(KEY), F.col("ano"))
    return out


def sum_by_state(m: DataFrame, measure: str) -> DataFrame:
    """Measure summed per state (null state dropped), largest first."""
    return (m.where(F.col("sigla_uf").isNotNull()).groupBy("sigla_uf")
            .agg(sum_or_zero(measure).alias(measure))
            .orderBy(F.col(measure).desc(), F.col("sigla_uf")))


def scatter_pairs(m: DataFrame, x: str, y: str, label: str = "nome_municipio") -> DataFrame:
    """Two non-null measures and the hover label."""
    return m.select(label, x, y).dropna(subset=[x, y])


def state_totals(gold: DataFrame, dim: DataFrame, measure: str) -> DataFrame:
    """A14 from the gold table: the measure is first summed per key (a partial
    aggregate), so the dimension join sees one row per key, not per key-year."""
    per_key = gold.groupBy(KEY).agg(F.sum(measure).alias(measure))
    m = per_key.join(dim.select(KEY, "sigla_uf"), KEY, "left")
    return sum_by_state(m, measure)


def health_kpis(health: DataFrame) -> DataFrame:
    """A10 + A11 in one chain: entities, states and the population total (max
    per key summed over keys). The state is a function of the key (dimension
    join), so grouping by both keeps one row per key."""
    per_key = (health.where(F.col(KEY).isNotNull()).groupBy(KEY, "sigla_uf")
               .agg(F.max("populacao").alias("p")))
    return per_key.agg(F.count_distinct(KEY).alias("municipios"),
                       F.count_distinct("sigla_uf").alias("ufs"),
                       F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("populacao_total"))


def overview_kpis(health: DataFrame, edu: DataFrame, gdp: DataFrame, transfers: DataFrame,
                  cnes: DataFrame) -> DataFrame:
    """The overview KPI row (entities, states, population, enrolments,
    facilities, beds, teachers, schools, GDP, median GDP per capita, transfers
    in billions). One-row aggregates are merged by a union, not a cross join.
    The GDP columns feed two aggregates (sum and median): they are written
    once to the checkpoint folder instead of being computed twice."""
    from civiclake.session import materialize
    gdp = materialize(gdp.select("pib_total_mil_reais", "pib_per_capita"), "kpi-pib")
    parts = [
        health_kpis(health),
        edu.agg(sum_or_zero("matriculas").cast("long").alias("matriculas"),
                sum_or_zero("docentes").cast("long").alias("docentes"),
                sum_or_zero("escolas").cast("long").alias("escolas")),
        cnes.agg(sum_or_zero("total_estabelecimentos").cast("long").alias("estabelecimentos"),
                 sum_or_zero("leitos_totais").cast("long").alias("leitos")),
        gdp.agg(F.sum("pib_total_mil_reais").alias("pib_total_mil_reais")),
        core.exact_median(gdp, "pib_per_capita", "pib_per_capita_mediano"),
        transfers.agg((sum_or_zero("total_transferencias_reais") / F.lit(1e9))
                      .alias("transferencias_bi")),
    ]
    row = core.one_row(parts)
    return row.select(
        "municipios", "ufs", "populacao_total", "matriculas", "docentes", "escolas",
        "estabelecimentos", "leitos", "pib_total_mil_reais", "pib_per_capita_mediano",
        "transferencias_bi",
        F.format_number("populacao_total", 0).alias("populacao_total_txt"),
        F.format_number("transferencias_bi", 1).alias("transferencias_bi_txt"))


def health_tab_kpis(health: DataFrame, cnes: DataFrame) -> DataFrame:
    """Health tab KPI row: municipalities, population (max per key,
    summed), facilities, hospitals and beds (null counts as 0). Works on the
    gold tables or on the marts (no dimension column is used)."""
    per_key = health.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.max("populacao").alias("p"))
    parts = [
        per_key.agg(F.count(F.lit(1)).alias("municipios"),
                    F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("populacao_total")),
        cnes.agg(sum_or_zero("total_estabelecimentos").cast("long").alias("estabelecimentos"),
                 sum_or_zero("hospitais").cast("long").alias("hospitais"),
                 sum_or_zero("leitos_totais").cast("long").alias("leitos")),
    ]
    return core.one_row(parts).select("municipios", "populacao_total", "estabelecimentos", "hospitais", "leitos")


def education_tab_kpis(edu: DataFrame) -> DataFrame:
    """Education tab KPI row: municipalities, enrolments, teachers, schools."""
    return edu.agg(F.count_distinct(KEY).alias("municipios"),
                   sum_or_zero("matriculas").cast("long").alias("matriculas"),
                   sum_or_zero("docentes").cast("long").alias("docentes"),
                   sum_or_zero("escolas").cast("long").alias("escolas"))


def gdp_kpis(gdp: DataFrame) -> DataFrame:
    """GDP tab KPIs: entities, total in billions, median and max per
    capita. The input is written once (checkpoint folder) and read by both the
    aggregates and the median."""
    from civiclake.session import materialize
    gdp = materialize(gdp.select(KEY, "pib_total_mil_reais", "pib_per_capita"), "kpi-pib")
    parts = [
        gdp.agg(F.count_distinct(KEY).alias("municipios"),
                (sum_or_zero("pib_total_mil_reais") / F.lit(1_000_000)).alias("pib_total_bi"),
                F.max("pib_per_capita").alias("pib_per_capita_max")),
        core.exact_median(gdp, "pib_per_capita", "pib_per_capita_mediano"),
    ]
    return core.one_row(parts).select("municipios", "pib_total_bi", "pib_per_capita_mediano",
                                      "pib_per_capita_max")


TOTAL_STATE, TOTAL_YEAR = 1, 2      # bits of ``_total``: summed over states, over years


def filtered_kpis(health: DataFrame, edu: DataFrame, gdp: DataFrame, transfers: DataFrame, cnes: DataFrame) -> DataFrame:
    """P4 + A10-A13 + A19 for every choice of the two filters at once: one row per
    (uf, ano) with ``Todos`` for a filter that is not set - what the overview's
    figures are after any choice of the sidebar.

    Arguments are marts. Sums are grouping sets over (state, year), each mart
    aggregated once; the population is the maximum per municipality of the chosen
    years, so its first aggregate is per municipality; the median is exact
    (``exact_median_by``). Rows without a state or year count under ``Todos`` only,
    as the filters' equality tests leave them out. Measure sets meet in a union and
    one aggregate over the choices, not in joins."""
    by = ["sigla_uf", "ano"]

    def cubed(m: DataFrame, *aggs) -> DataFrame:
        flags = [(F.grouping("sigla_uf").cast("int") + 2 * F.grouping("ano").cast("int")).alias("_total")]
        return m.cube(*by).agg(*aggs, *flags)

    def whole(*columns: str) -> list:
        return [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(o) for c, o in (x.split(":") for x in columns)]

    # per municipality and chosen years, then over municipalities; null keys have no row
    keyed = health.where(F.col(KEY).isNotNull())
    per_key = keyed.groupingSets([[F.col(KEY), F.col("sigla_uf"), F.col("ano")], [F.col(KEY), F.col("sigla_uf")]], KEY, "sigla_uf", "ano").agg(
        F.max("populacao").alias("p"), F.grouping("ano").cast("int").alias("_y"))
    people = per_key.groupingSets([[F.col("sigla_uf"), F.col("ano"), F.col("_y")], [F.col("ano"), F.col("_y")]], "sigla_uf", "ano", "_y").agg(
        F.count(F.lit(1)).alias("municipios"), F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("populacao_total"),
        (F.grouping("sigla_uf").cast("int") + 2 * F.col("_y")).alias("_total")).drop("_y")
    parts = [
        people,
        cubed(edu, *whole("matriculas:matriculas", "docentes:docentes", "escolas:escolas")),
        cubed(cnes, *whole("total_estabelecimentos:estabelecimentos", "leitos_totais:leitos")),
        cubed(gdp, F.sum("pib_total_mil_reais").alias("pib_total_mil_reais")),
        core.exact_median_by(gdp, by, "pib_per_capita", "pib_per_capita_mediano"),
        cubed(transfers, (sum_or_zero("total_transferencias_reais") / F.lit(1e9)).alias("transferencias_bi")),
    ]
    rows = core.union_all(parts)
    no_state, no_year = F.col("_total").bitwiseAND(F.lit(TOTAL_STATE)) != 0, F.col("_total").bitwiseAND(F.lit(TOTAL_YEAR)) != 0
    rows = rows.where((no_state | F.col("sigla_uf").isNotNull()) & (no_year | F.col("ano").isNotNull()))
    uf = F.when(no_state, F.lit(core.ALL)).otherwise(F.col("sigla_uf")).alias("uf")
    year = F.when(no_year, F.lit(core.ALL)).otherwise(F.col("ano").cast("string")).alias("ano")
    sums = ["municipios", "populacao_total", "matriculas", "docentes", "escolas", "estabelecimentos", "leitos"]
    return rows.groupBy(uf, year, "_total").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in sums], F.max("pib_total_mil_reais").alias("pib_total_mil_reais"),
        F.max("pib_per_capita_mediano").alias("pib_per_capita_mediano"), F.coalesce(F.max("transferencias_bi"), F.lit(0.0)).alias("transferencias_bi")).drop("_total")


def filter_values(marts: Sequence[DataFrame]) -> DataFrame:
    """Filter choices: distinct non-null states and years over the
    marts, as one (filtro, valor) frame in display order (T3: states ascending,
    then years descending). Every mart is read once: its (state, year) pairs are
    made distinct and taken apart, so only a bounded list is sorted."""
    pairs = core.union_all([m.select("sigla_uf", "ano").distinct() for m in marts])
    both = F.array(F.struct(F.lit("uf").alias("filtro"), F.col("sigla_uf").alias("valor")),
                   F.struct(F.lit("ano").alias("filtro"), F.col("ano").cast("string").alias("valor")))
    values = pairs.select(F.explode(both).alias("_v")).select("_v.*").dropna().distinct()
    state = F.col("filtro") == "uf"
    return values.orderBy(state.desc(), F.when(state, F.col("valor")).asc_nulls_last(), F.col("valor").desc())


def source_status(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Has-rows flag per source; each probe reads at most one row."""
    return core.union_all([
        df.limit(1).agg((F.count(F.lit(1)) > 0).alias("tem_dados")).select(
            F.lit(name).alias("fonte"), "tem_dados")
        for name, df in sources.items()])


def first_centroids(centroids: DataFrame) -> DataFrame:
    """First centroid row per key by its ``ordem`` column."""
    return core.first_per_key(centroids, KEY, ["ordem"]).select(KEY, "latitude", "longitude")


def map_points(m: DataFrame, centroids: DataFrame, theme: str, measure: str) -> DataFrame:
    """J4 + A15 + P11 + P13: one point per municipality with coordinates,
    marker radius and tooltip text.

    For each field the first non-null value in mart order (measure
    descending, then year) is taken. The radius scale uses the maximum of the
    chosen measure, a scalar subquery (no join, no cross product).
    """
    opts = [(lbl, c) for lbl, c in MAP_OPTIONS[theme] if c in m.columns]
    cols = [c for _, c in opts]
    # One row per municipality before the centroids are joined (they are unique per
    # key), written once to the checkpoint folder: the marker scale and the output
    # read it instead of recomputing the join.
    from civiclake.session import materialize
    one = core.first_non_null_by(m, KEY, [*DIM_COLUMNS, *cols], order=[measure, "ano"])
    pts = materialize(one.join(centroids, KEY, "inner").dropna(subset=["latitude", "longitude"]), "map_points")
    v = F.coalesce(F.col(measure).cast("double"), F.lit(0.0))
    mx = pts.select(F.max(v)).scalar()
    scale = F.when(mx > 0, F.lit(RADIUS_SPAN) / mx).otherwise(F.lit(RADIUS_FLAT_SCALE))
    radius = F.when(v == 0, F.lit(float(RADIUS_MIN))).otherwise(
        F.least(F.lit(float(RADIUS_MAX)), F.greatest(F.lit(float(RADIUS_MIN)), v * scale)))
    lines = [F.concat(F.coalesce(F.col("nome_municipio"), F.lit("")), F.lit(" ("),
                      F.coalesce(F.col("sigla_uf"), F.lit("")), F.lit(")"))]
    lines += [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{lbl}: "), value_text(c))) for lbl, c in opts]
    return pts.select(KEY, "latitude", "longitude", *DIM_COLUMNS, *cols,
                      radius.alias("raio"), F.concat_ws("\n", *lines).alias("rotulo"))


def map_measures(marts: Mapping[str, DataFrame]) -> DataFrame:
    """For the themes that have rows, the measures whose column exists, as
    one tall (key, year, theme, indicator label, column, value) frame. A theme
    without rows contributes no rows, so no separate emptiness probe runs."""
    frames = []
    for theme, df in marts.items():
        opts = [(lbl, c) for lbl, c in MAP_OPTIONS.get(theme, []) if c in df.columns]
        if not opts:
            continue
        tall = df.select(KEY, "ano", *[F.col(c).cast("double").alias(c) for _, c in opts]).unpivot(
            [KEY, "ano"], [c for _, c in opts], "coluna", "valor")
        labels = F.create_map(*[x for lbl, c in opts for x in (F.lit(c), F.lit(lbl))])
        frames.append(tall.withColumn("tema", F.lit(theme))
                      .withColumn("indicador", labels[F.col("coluna")]))
    return core.union_all(frames).select(KEY, "ano", "tema", "indicador", "coluna", "valor")
