"""Independent SQL (DuckDB dialect) for each query of ``plans.queries``.

Written from the semantics, not generated from the Spark plans. Notes:
integer sums are cast to BIGINT (DuckDB widens to HUGEINT); double -> integer
uses ``trunc`` (DuckDB rounds, Spark truncates); rates divide by ``nullif``
(DuckDB gives inf for x/0) and round with ``round_even(x*100, 0)/100``.
"""

from __future__ import annotations


def zf(expr: str) -> str:
    """Zero-fill to 7, never shortening."""
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) < 7 THEN lpad({s}, 7, '0') ELSE {s} END)"


def rate(num: str, den: str, scale: int) -> str:
    return f"(round_even(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * {scale}.0 * 100, 0) / 100)"


def r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


YEAR = "CAST(year({}) AS INTEGER)"

V = {
    "v_entity": f"""v_entity AS (
        SELECT {zf('c.c_custkey')} AS cod_mun_ibge_7, c.c_name AS nome_municipio,
               n.n_name AS sigla_uf, c.c_nationkey AS cod_uf
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "v_pop": f"""v_pop AS (
        SELECT {zf('c_custkey')} AS cod_mun_ibge_7, CAST(y.ano AS INTEGER) AS ano,
               CAST(CASE WHEN c_custkey % 50 = 0 THEN 0 WHEN c_custkey % 50 = 1 THEN NULL
                         ELSE 1000 + (c_custkey * 37) % 9000 + y.ano END AS BIGINT) AS populacao
        FROM customer, (SELECT range AS ano FROM range(1995, 2002)) y)""",
    "v_events": f"""v_events AS (
        SELECT {zf('o_custkey')} AS cod_mun_ibge_7, {YEAR.format('o_orderdate')} AS ano, o_orderstatus
        FROM orders)""",
    "v_edu": f"""v_edu AS (
        SELECT {zf('l_suppkey')} AS cod_mun_ibge_7, {YEAR.format('l_shipdate')} AS ano,
               CAST(l_quantity AS BIGINT) AS matriculas, CAST(l_linenumber AS BIGINT) AS docentes,
               CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE 1 END AS BIGINT) AS escolas
        FROM lineitem)""",
    "v_gdp": f"""v_gdp AS (
        SELECT {zf('o_custkey')} AS cod_mun_ibge_7, {YEAR.format('o_orderdate')} AS ano,
               o_totalprice AS pib_total_mil_reais, o_totalprice / 100 AS pib_per_capita
        FROM orders)""",
}


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(V[n] for n in names) + "\n"


def _health(year_filter: str, with_admissions: bool) -> str:
    ih_count = "count(*) FILTER (WHERE o_orderstatus = 'P')" if with_admissions else "0"
    ih_rate = rate("coalesce(d.ih, 0)", "p.populacao", 100000) if with_admissions else "CAST(0.0 AS DOUBLE)"
    return with_views("v_pop", "v_events") + f""",
    p AS (SELECT cod_mun_ibge_7, ano, max(populacao) AS populacao FROM v_pop {year_filter} GROUP BY 1, 2),
    d AS (SELECT cod_mun_ibge_7, ano,
                 count(*) FILTER (WHERE o_orderstatus = 'F') AS ob,
                 {ih_count} AS ih,
                 count(*) FILTER (WHERE o_orderstatus = 'O') AS nv
          FROM v_events {year_filter} GROUP BY 1, 2)
    SELECT p.cod_mun_ibge_7, p.ano, p.populacao,
           CAST(coalesce(d.ih, 0) AS BIGINT) AS total_internacoes,
           CAST(coalesce(d.ob, 0) AS BIGINT) AS total_obitos,
           CAST(coalesce(d.nv, 0) AS BIGINT) AS nascidos_vivos,
           {ih_rate} AS taxa_internacao_100k,
           {rate('coalesce(d.ob, 0)', 'p.populacao', 100000)} AS taxa_obitos_100k
    FROM p LEFT JOIN d ON p.cod_mun_ibge_7 = d.cod_mun_ibge_7 AND p.ano = d.ano"""


def _education(year_filter: str) -> str:
    return with_views("v_edu", "v_pop") + f""",
    e AS (SELECT cod_mun_ibge_7, ano, CAST(sum(matriculas) AS BIGINT) AS matriculas,
                 CAST(coalesce(sum(docentes), 0) AS BIGINT) AS docentes,
                 CAST(coalesce(sum(escolas), 0) AS BIGINT) AS escolas
          FROM v_edu {year_filter} GROUP BY 1, 2),
    p AS (SELECT cod_mun_ibge_7, max(populacao) AS populacao FROM v_pop {year_filter} GROUP BY 1)
    SELECT e.cod_mun_ibge_7, e.ano, e.matriculas, e.docentes, e.escolas,
           {rate('e.matriculas', 'p.populacao', 1000)} AS taxa_matriculas_por_1000_hab
    FROM e LEFT JOIN p ON e.cod_mun_ibge_7 = p.cod_mun_ibge_7"""


SQL: dict[str, str] = {}

SQL["gold_health"] = _health("", True)
SQL["gold_health_frames"] = SQL["gold_health"]
SQL["gold_health_year"] = _health("WHERE ano = 1998", False)
SQL["gold_health_precounted"] = _health("", False)  # pre-counting leaves totals unchanged
SQL["gold_education"] = _education("")
SQL["gold_education_year"] = _education("WHERE ano = 1998")
SQL["gold_education_no_population"] = with_views("v_edu") + """
    SELECT cod_mun_ibge_7, ano, CAST(sum(matriculas) AS BIGINT) AS matriculas,
           CAST(NULL AS BIGINT) AS docentes,
           CAST(coalesce(sum(escolas), 0) AS BIGINT) AS escolas,
           CAST(NULL AS DOUBLE) AS taxa_matriculas_por_1000_hab
    FROM v_edu GROUP BY 1, 2"""
SQL["gold_gdp"] = with_views("v_gdp") + """
    SELECT cod_mun_ibge_7, ano, max(pib_total_mil_reais) AS pib_total_mil_reais,
           max(pib_per_capita) AS pib_per_capita
    FROM v_gdp GROUP BY 1, 2"""
SQL["gold_transfers"] = f"""
    SELECT {zf('l_suppkey')} AS cod_mun_ibge_7, {YEAR.format('l_shipdate')} AS ano,
           {r2('coalesce(sum(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END), 0.0)')}
             AS total_transferencias_reais
    FROM lineitem GROUP BY 1, 2"""
SQL["gold_facilities"] = f"""
    SELECT {zf("regexp_replace(p_brand, '[^0-9]', '', 'g')")} AS cod_mun_ibge_7, 1998 AS ano,
           CAST(count(*) AS BIGINT) AS total_estabelecimentos,
           CAST(count(*) FILTER (WHERE regexp_matches(upper(p_type), 'ECONOMY')) AS BIGINT) AS hospitais,
           CAST(count(*) FILTER (WHERE regexp_matches(upper(p_type), 'SMALL')) AS BIGINT) AS ubs,
           CAST(trunc(coalesce(sum(CAST(p_size AS DOUBLE)), 0)) AS BIGINT) AS leitos_totais,
           CAST(trunc(coalesce(sum(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / 2 END), 0)) AS BIGINT)
             AS leitos_sus
    FROM part WHERE p_size % 10 <> 0 GROUP BY 1"""


# ---- marts and dashboard data ---------------------------------------------------
ENTITY = f"""SELECT {zf('c.c_custkey')} AS cod_mun_ibge_7, c.c_name AS nome_municipio,
                    n.n_name AS sigla_uf, c.c_nationkey AS cod_uf
             FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""
GOLD = {"saude": SQL["gold_health"], "educacao": SQL["gold_education"], "pib": SQL["gold_gdp"],
        "transferencias": SQL["gold_transfers"], "cnes": SQL["gold_facilities"]}
MEASURES = {
    "saude": ["populacao", "total_internacoes", "total_obitos", "nascidos_vivos",
              "taxa_internacao_100k", "taxa_obitos_100k"],
    "educacao": ["matriculas", "docentes", "escolas", "taxa_matriculas_por_1000_hab"],
    "pib": ["pib_total_mil_reais", "pib_per_capita"],
    "transferencias": ["total_transferencias_reais"],
    "cnes": ["total_estabelecimentos", "hospitais", "ubs", "leitos_totais", "leitos_sus"],
}


def mart_sql(theme: str) -> str:
    cols = ", ".join(f"g.{c}" for c in MEASURES[theme])
    return f"""SELECT g.cod_mun_ibge_7, m.nome_municipio, m.sigla_uf, g.ano, {cols}
               FROM ({GOLD[theme]}) g LEFT JOIN ({ENTITY}) m ON m.cod_mun_ibge_7 = g.cod_mun_ibge_7"""


def marts_with(*themes: str) -> str:
    alias = {"saude": "ms", "educacao": "me", "pib": "mp", "transferencias": "mt", "cnes": "mc"}
    return "WITH " + ",\n".join(f"{alias[t]} AS ({mart_sql(t)})" for t in themes) + "\n"


def median_sql(src: str, col: str) -> str:
    return f"""(SELECT avg(x) FROM (
                  SELECT x, row_number() OVER (ORDER BY x) - 1 AS r, count(*) OVER () AS n
                  FROM (SELECT CAST({col} AS DOUBLE) AS x FROM {src}
                        WHERE {col} IS NOT NULL AND NOT isnan({col})))
                WHERE r = (n - 1) // 2 OR r = n // 2)"""


for _t, _n in [("saude", "mart_health"), ("educacao", "mart_education"), ("pib", "mart_gdp"),
               ("transferencias", "mart_transfers"), ("cnes", "mart_facilities")]:
    SQL[_n] = mart_sql(_t)

SQL["mart_filtered"] = f"SELECT * FROM ({mart_sql('saude')}) WHERE sigla_uf = 'NATION_3' AND ano = 1998"
SQL["mart_filtered_all"] = f"SELECT * EXCLUDE (sigla_uf) FROM ({mart_sql('transferencias')})"
SQL["kpi_overview"] = marts_with("saude", "educacao", "pib", "transferencias", "cnes") + f""",
    pt AS (SELECT CAST(coalesce(sum(p), 0) AS BIGINT) AS v FROM
           (SELECT cod_mun_ibge_7, max(populacao) AS p FROM ms WHERE cod_mun_ibge_7 IS NOT NULL GROUP BY 1)),
    tb AS (SELECT {r2('coalesce(sum(total_transferencias_reais), 0)')} / 1e9 AS v FROM mt)
    SELECT (SELECT count(DISTINCT cod_mun_ibge_7) FROM ms) AS municipios,
           (SELECT count(DISTINCT sigla_uf) FROM ms) AS ufs,
           (SELECT v FROM pt) AS populacao_total,
           (SELECT CAST(coalesce(sum(matriculas), 0) AS BIGINT) FROM me) AS matriculas,
           (SELECT CAST(coalesce(sum(docentes), 0) AS BIGINT) FROM me) AS docentes,
           (SELECT CAST(coalesce(sum(escolas), 0) AS BIGINT) FROM me) AS escolas,
           (SELECT CAST(coalesce(sum(total_estabelecimentos), 0) AS BIGINT) FROM mc) AS estabelecimentos,
           (SELECT CAST(coalesce(sum(leitos_totais), 0) AS BIGINT) FROM mc) AS leitos,
           (SELECT {r2('sum(pib_total_mil_reais)')} FROM mp) AS pib_total_mil_reais,
           {median_sql('mp', 'pib_per_capita')} AS pib_per_capita_mediano,
           (SELECT v FROM tb) AS transferencias_bi,
           (SELECT format('{{:,}}', v) FROM pt) AS populacao_total_txt,
           (SELECT format('{{:,.1f}}', v) FROM tb) AS transferencias_bi_txt"""
SQL["kpi_gdp"] = marts_with("pib") + f"""
    SELECT (SELECT count(DISTINCT cod_mun_ibge_7) FROM mp) AS municipios,
           (SELECT {r2('coalesce(sum(pib_total_mil_reais), 0) / 1000000')} FROM mp) AS pib_total_bi,
           {median_sql('mp', 'pib_per_capita')} AS pib_per_capita_mediano,
           (SELECT max(pib_per_capita) FROM mp) AS pib_per_capita_max"""
SQL["top_n_measure"] = marts_with("pib") + """
    SELECT nome_municipio, pib_total_mil_reais FROM (
        SELECT * FROM mp WHERE pib_total_mil_reais IS NOT NULL
        ORDER BY pib_total_mil_reais DESC, cod_mun_ibge_7 LIMIT 10)
    WHERE nome_municipio IS NOT NULL"""
SQL["sum_by_state"] = marts_with("saude") + """
    SELECT sigla_uf, CAST(coalesce(sum(populacao), 0) AS BIGINT) AS populacao
    FROM ms WHERE sigla_uf IS NOT NULL GROUP BY 1"""
SQL["scatter_pairs"] = marts_with("educacao") + """
    SELECT nome_municipio, escolas, docentes FROM me WHERE escolas IS NOT NULL AND docentes IS NOT NULL"""
SQL["filter_values"] = marts_with("saude", "educacao", "pib") + """
    SELECT 'uf' AS filtro, sigla_uf AS valor FROM
      (SELECT sigla_uf FROM ms UNION SELECT sigla_uf FROM me UNION SELECT sigla_uf FROM mp)
    WHERE sigla_uf IS NOT NULL
    UNION ALL
    SELECT 'ano' AS filtro, CAST(ano AS VARCHAR) AS valor FROM
      (SELECT ano FROM ms UNION SELECT ano FROM me UNION SELECT ano FROM mp)
    WHERE ano IS NOT NULL"""
SQL["source_status"] = marts_with("saude", "educacao", "pib", "transferencias", "cnes") + """
    SELECT 'saude' AS fonte, EXISTS (SELECT 1 FROM ms) AS tem_dados
    UNION ALL SELECT 'educacao', EXISTS (SELECT 1 FROM me)
    UNION ALL SELECT 'pib', EXISTS (SELECT 1 FROM mp)
    UNION ALL SELECT 'transferencias', EXISTS (SELECT 1 FROM mt)
    UNION ALL SELECT 'cnes', EXISTS (SELECT 1 FROM mc)"""

CENTROIDS = f"""SELECT {zf('codigo_ibge')} AS cod_mun_ibge_7, latitude, longitude FROM (
      SELECT CAST(c_custkey AS VARCHAR) AS codigo_ibge,
             CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey - 30.0 AS DOUBLE) END AS latitude,
             CAST(-40.0 - c_nationkey AS DOUBLE) AS longitude, 0 AS d FROM customer
      UNION ALL
      SELECT CAST(c_custkey AS VARCHAR), CAST(c_nationkey - 31.0 AS DOUBLE), CAST(-41.0 - c_nationkey AS DOUBLE), 1
      FROM customer WHERE c_custkey % 13 = 0)
    QUALIFY row_number() OVER (PARTITION BY {zf('codigo_ibge')} ORDER BY d) = 1"""


def _first(col: str, order: str) -> str:
    return f"first({col} ORDER BY {order}) FILTER (WHERE {col} IS NOT NULL)"


def _fmt(col: str) -> str:
    v = f"CAST({col} AS DOUBLE)"
    return f"(CASE WHEN {v} = floor({v}) THEN format('{{:,.0f}}', {v}) ELSE format('{{:,.2f}}', {v}) END)"


_MAP_ORDER = "populacao DESC NULLS LAST, ano DESC"
_MAP_FIELDS = ["latitude", "longitude", "nome_municipio", "sigla_uf", "populacao", "total_obitos",
               "nascidos_vivos", "taxa_obitos_100k"]
_MAP_LABELS = [("População", "populacao"), ("Óbitos", "total_obitos"),
               ("Nascidos vivos", "nascidos_vivos"), ("Taxa de óbitos (por 100k)", "taxa_obitos_100k")]
SQL["map_points"] = marts_with("saude") + f""",
    c AS ({CENTROIDS}),
    j AS (SELECT ms.*, c.latitude, c.longitude FROM ms JOIN c ON ms.cod_mun_ibge_7 = c.cod_mun_ibge_7
          WHERE c.latitude IS NOT NULL AND c.longitude IS NOT NULL),
    pts AS (SELECT cod_mun_ibge_7, {', '.join(f"{_first(f, _MAP_ORDER)} AS {f}" for f in _MAP_FIELDS)}
            FROM j GROUP BY 1),
    mx AS (SELECT max(coalesce(CAST(populacao AS DOUBLE), 0.0)) AS m FROM pts)
    SELECT cod_mun_ibge_7, latitude, longitude, nome_municipio, sigla_uf, populacao, total_obitos,
           nascidos_vivos, taxa_obitos_100k,
           CASE WHEN coalesce(CAST(populacao AS DOUBLE), 0.0) = 0 THEN 5.0
                ELSE least(28.0, greatest(5.0, coalesce(CAST(populacao AS DOUBLE), 0.0) *
                     (CASE WHEN (SELECT m FROM mx) > 0 THEN 22.0 / (SELECT m FROM mx) ELSE 0.01 END))) END AS raio,
           concat_ws(chr(10), coalesce(nome_municipio, '') || ' (' || coalesce(sigla_uf, '') || ')',
             {', '.join(f"CASE WHEN {c} IS NOT NULL THEN '{lbl}: ' || {_fmt(c)} END" for lbl, c in _MAP_LABELS)}
           ) AS rotulo
    FROM pts"""

_MAP_OPTS = {
    "ms": ("saude", _MAP_LABELS),
    "me": ("educacao", [("Matrículas", "matriculas"), ("Docentes", "docentes"), ("Escolas", "escolas"),
                        ("Taxa matrículas (por 1k hab.)", "taxa_matriculas_por_1000_hab")]),
    "mp": ("pib", [("PIB total (R$ mil)", "pib_total_mil_reais"), ("PIB per capita (R$)", "pib_per_capita")]),
    "mc": ("cnes", [("Estabelecimentos de saúde", "total_estabelecimentos"), ("Leitos hospitalares", "leitos_totais"),
                    ("Hospitais", "hospitais"), ("UBS", "ubs")]),
}
SQL["map_measures"] = marts_with("saude", "educacao", "pib", "cnes") + "\n UNION ALL ".join(
    f"SELECT cod_mun_ibge_7, ano, '{theme}' AS tema, '{lbl}' AS indicador, '{c}' AS coluna, "
    f"CAST({c} AS DOUBLE) AS valor FROM {a}"
    for a, (theme, opts) in _MAP_OPTS.items() for lbl, c in opts)

# ---- sampling, fallbacks, keys, checks ----------------------------------------------


def _sample(n: int) -> str:
    k = max(1, n // 27)
    return f"""WITH e AS ({ENTITY})
    SELECT cod_mun_ibge_7, nome_municipio, sigla_uf, cod_uf FROM (
      SELECT *, row_number() OVER (PARTITION BY sigla_uf ORDER BY cod_mun_ibge_7) AS rn
      FROM e WHERE sigla_uf IS NOT NULL)
    WHERE rn <= {k} AND (SELECT count(*) FROM e) > {n}
    ORDER BY cod_mun_ibge_7 LIMIT {n}"""


SQL["stratified_sample"] = _sample(100)
SQL["stratified_sample_10"] = _sample(10)
SQL["year_backoff"] = with_views("v_pop") + """
    SELECT *, ano AS ano_efetivo FROM v_pop
    WHERE ano = (SELECT arg_min(ano, CASE ano WHEN 2002 THEN 1 WHEN 2001 THEN 2 END)
                 FROM v_pop WHERE ano IN (2002, 2001))"""
SQL["year_lagged_preference"] = with_views("v_gdp") + """
    SELECT cod_mun_ibge_7, ano, max(pib_total_mil_reais) AS pib_total_mil_reais,
           max(pib_per_capita) AS pib_per_capita
    FROM v_gdp
    WHERE ano = (SELECT arg_min(ano, CASE ano WHEN 2000 THEN 1 WHEN 1999 THEN 2 WHEN 2001 THEN 3 END)
                 FROM v_gdp WHERE ano IN (2000, 1999, 2001))
    GROUP BY 1, 2"""
SQL["source_preference"] = """
    WITH t AS (SELECT event_id, user_id, value,
                      CASE event_type WHEN 'refund' THEN 0 WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 END AS prio
               FROM events WHERE event_type IN ('refund', 'purchase', 'click'))
    SELECT event_id, user_id, value FROM t WHERE prio = (SELECT min(prio) FROM t)"""

RAW_CODES = f"""SELECT c_custkey, c_name,
      CASE c_custkey % 5 WHEN 0 THEN substr({zf('c_custkey')}, 1, 6)
                         WHEN 1 THEN {zf('c_custkey')}
                         WHEN 2 THEN ' 35-' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || ' '
                         WHEN 3 THEN lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS codigo_ibge
    FROM customer"""


def _std(mode: str) -> str:
    d = "regexp_replace(trim(codigo_ibge), '[^0-9]', '', 'g')"
    six = f"lpad({d}, 7, '0')" if mode == "pad" else d
    return f"""SELECT * FROM (SELECT *, CASE WHEN length({d}) = 6 THEN {six}
                                         WHEN length({d}) = 7 THEN {d} END AS cod_mun_ibge_7
                          FROM ({RAW_CODES}))
               WHERE cod_mun_ibge_7 IS NOT NULL"""


SQL["key_standardise"] = _std("pad") + " AND length(cod_mun_ibge_7) = 7"
SQL["key_prefix6_join"] = f"""
    SELECT r.c_custkey, e.cod_mun_ibge_7 AS cod_dim, e.nome_municipio
    FROM ({_std('prefix6')}) r JOIN ({ENTITY}) e
      ON substr(r.cod_mun_ibge_7, 1, 6) = substr(e.cod_mun_ibge_7, 1, 6)"""
SQL["alias_resolve"] = """
    SELECT CAST(c_custkey + 3000000 AS VARCHAR) AS cod_mun_ibge_7, c_name AS nome_municipio,
           c_acctbal AS valor
    FROM customer WHERE length(CAST(c_custkey + 3000000 AS VARCHAR)) = 7"""
SQL["key_uniqueness"] = with_views("v_gdp") + """
    SELECT cod_mun_ibge_7, ano, count(*) AS n_linhas FROM v_gdp GROUP BY 1, 2 HAVING count(*) > 1"""
SQL["orphan_keys"] = f"""
    SELECT DISTINCT cod_mun_ibge_7 FROM ({_std('pad')} AND length(cod_mun_ibge_7) = 7) r
    WHERE NOT EXISTS (SELECT 1 FROM ({ENTITY}) e WHERE e.cod_mun_ibge_7 = r.cod_mun_ibge_7)"""

# ---- sources, snapshots, sinks -----------------------------------------------------------
SQL["dim_flatten_nested_json"] = f"""
    SELECT {zf('c.c_custkey')} AS cod_mun_ibge_7, c.c_name AS nome_municipio,
           CASE WHEN c.c_custkey % 7 IN (0, 1) THEN '' ELSE coalesce(n.n_name, '') END AS sigla_uf,
           CASE WHEN c.c_custkey % 7 IN (0, 1) THEN NULL ELSE c.c_nationkey END AS cod_uf
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE c.c_custkey <> 0 AND c.c_custkey % 97 <> 5"""

_SER = f"""a AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n,
                    sum(o_totalprice) AS s FROM orders GROUP BY 1, 2),
    pick AS (SELECT k, CASE WHEN bool_or(y = 1999) THEN 1999 ELSE max(y) END AS y FROM a GROUP BY k),
    v AS (SELECT a.* FROM a JOIN pick ON a.k = pick.k AND a.y = pick.y),
    loc AS (SELECT k, CASE WHEN k % 17 = 0 THEN '1' || {zf('k')} ELSE {zf('k')} END AS cod FROM pick)"""
SQL["series_latest_year"] = f"""WITH {_SER}
    SELECT loc.cod AS cod_mun_ibge_7, 1999 AS ano,
           CAST(CASE WHEN v.n = 1 THEN 0 WHEN v.n = 2 THEN NULL ELSE floor(v.s / v.n) END AS BIGINT) AS populacao,
           v.y AS ano_origem
    FROM v JOIN loc ON v.k = loc.k WHERE v.k % 10 <> 3"""
SQL["series_exact_year"] = f"""WITH {_SER}
    SELECT loc.cod AS cod_mun_ibge_7, 1999 AS ano,
           CAST(CASE WHEN a.n >= 3 THEN floor(a.s) END AS BIGINT) AS populacao_1999
    FROM a JOIN loc ON a.k = loc.k WHERE a.y = 1999"""
SQL["series_two_measures_pivot"] = f"""WITH {_SER},
    r AS (SELECT {zf('k')} AS cod,
                 CASE WHEN n >= 3 THEN CAST(floor(s) + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS DOUBLE) END AS t,
                 CASE WHEN n >= 3 AND k % 10 <> 3 THEN CAST(floor(s / n) AS DOUBLE) END AS pc
          FROM v WHERE k % 17 <> 0)
    SELECT cod AS cod_mun_ibge_7, 1999 AS ano, t AS pib_total_mil_reais, pc AS pib_per_capita
    FROM r WHERE t IS NOT NULL OR pc IS NOT NULL"""
SQL["series_key_restricted"] = f"""
    SELECT * FROM ({SQL['series_latest_year']}) p
    WHERE p.cod_mun_ibge_7 IN (SELECT cod_mun_ibge_7 FROM ({_sample(100)}))"""
SQL["event_counts_by_key"] = """
    SELECT cod AS cod_mun_ibge_7, ano, count(*) AS total_obitos FROM (
      SELECT CASE WHEN y <= 1996 THEN CAST(o_custkey + 3000000 AS VARCHAR)
                  WHEN y <= 1998 THEN lpad(CAST(o_custkey + 300000 AS VARCHAR), 7, '0')
                  ELSE '35' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') END AS cod, y AS ano
      FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) WHERE y <= 1999)
    WHERE length(cod) = 7 GROUP BY 1, 2"""
SQL["envelope_unwrap"] = f"""
    SELECT {zf('user_id')} AS cod_mun_ibge_7, CAST(year(ts) AS INTEGER) AS ano,
           {r2('coalesce(sum(value), 0.0)')} AS total_transferencias_reais
    FROM events WHERE event_id % 4 <> 3 GROUP BY 1, 2"""
SQL["csv_microdata_count"] = """
    SELECT cod AS cod_mun_ibge_7, count(*) AS matriculas, 1998 AS ano FROM (
      SELECT CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey + 3000000 AS VARCHAR)
                  ELSE lpad(CAST(o_custkey + 300000 AS VARCHAR), 7, '0') END AS cod
      FROM orders WHERE o_orderstatus IN ('F', 'O'))
    WHERE length(cod) = 7 GROUP BY 1"""
SQL["ragged_union_sum"] = """
    SELECT CAST(l_suppkey + 3000000 AS VARCHAR) AS cod_mun_ibge_7, CAST(year(l_shipdate) AS INTEGER) AS ano,
           CAST(sum(l_quantity) AS DOUBLE) AS matriculas,
           CAST(coalesce(sum(l_linenumber) FILTER (WHERE l_linenumber <= 4), 0) AS DOUBLE) AS docentes,
           CAST(count(*) FILTER (WHERE l_linenumber <= 2) AS DOUBLE) AS escolas
    FROM lineitem GROUP BY 1, 2"""
SQL["latest_snapshot"] = SQL["gold_gdp"]
SQL["dim_upsert"] = f"""
    SELECT cod_mun_ibge_7,
           CASE WHEN CAST(cod_mun_ibge_7 AS BIGINT) % 8 = 0 THEN nome_municipio || ' v2'
                WHEN CAST(cod_mun_ibge_7 AS BIGINT) % 4 = 0 THEN nome_municipio || ' v1'
                ELSE nome_municipio END AS nome_municipio, sigla_uf, cod_uf
    FROM ({ENTITY})"""
_EDU_AGG = f"""SELECT {zf('l_suppkey')} AS cod_mun_ibge_7, CAST(year(l_shipdate) AS INTEGER) AS ano,
                      CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS matriculas,
                      CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS docentes,
                      CAST(count(*) FILTER (WHERE l_returnflag <> 'R') AS BIGINT) AS escolas
               FROM lineitem WHERE {{}} GROUP BY 1, 2"""
SQL["education_silver_upsert"] = f"""
    WITH b1 AS ({_EDU_AGG.format("TRUE")}),
         b2 AS ({_EDU_AGG.format("year(l_shipdate) >= 1998 AND l_returnflag <> 'R'")})
    SELECT * FROM b2
    UNION ALL
    SELECT * FROM b1 WHERE NOT EXISTS
      (SELECT 1 FROM b2 WHERE b2.cod_mun_ibge_7 = b1.cod_mun_ibge_7 AND b2.ano = b1.ano)"""
SQL["indicator_append"] = f"""
    SELECT {zf('user_id')} AS cod_mun_ibge_7, CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes,
           coalesce(CASE WHEN event_type <> 'error' THEN event_type END, 'raw') AS indicador,
           value AS valor, CAST(NULL AS VARCHAR) AS unidade
    FROM events"""
SQL["replace_by_year"] = f"""
    SELECT cod_mun_ibge_7, ano,
           CASE WHEN ano IN (1999, 2000) THEN pib_total_mil_reais * 2 ELSE pib_total_mil_reais END AS pib_total_mil_reais,
           CASE WHEN ano IN (1999, 2000) THEN pib_per_capita * 2 ELSE pib_per_capita END AS pib_per_capita
    FROM ({SQL['gold_gdp']})"""
SQL["export_roundtrip"] = SQL["gold_gdp"]
SQL["export_filtered"] = SQL["mart_filtered"]
SQL["ddl_roundtrip"] = f"""
    SELECT 'dim_municipio' AS tabela, (SELECT count(*) FROM customer) AS linhas, 4 AS colunas
    UNION ALL SELECT 'gold_cnes_municipio', (SELECT count(*) FROM ({SQL['gold_facilities']})), 8
    UNION ALL SELECT 'gold_indicadores_educacao_municipio', (SELECT count(*) FROM ({SQL['gold_education']})), 7
    UNION ALL SELECT 'gold_indicadores_saude_municipio', (SELECT count(*) FROM ({SQL['gold_health']})), 9
    UNION ALL SELECT 'gold_pib_municipio', (SELECT count(*) FROM ({SQL['gold_gdp']})), 5
    UNION ALL SELECT 'gold_transparencia_transferencias', (SELECT count(*) FROM ({SQL['gold_transfers']})), 4
    UNION ALL SELECT 'silver_datasus_indicadores', 0, 7
    UNION ALL SELECT 'silver_ibge_populacao', 0, 4
    UNION ALL SELECT 'silver_inep_educacao', 0, 6
    UNION ALL SELECT 'gold_inexistente', 0, 5"""
SQL["short_key_resolution"] = """
    SELECT CAST(1000000 + o_custkey * 10 + o_custkey % 10 AS VARCHAR) AS cod_mun_ibge_7,
           CAST(year(o_orderdate) AS INT) AS ano, count(*) AS n_registros
    FROM orders GROUP BY 1, 2"""
SQL["legacy_join_by_name"] = f"""
    WITH cities AS (SELECT c_custkey AS municipio_id_ibge, c_name AS municipio_nome,
                           CAST(1000 + (c_custkey * 37) % 9000 + 2001 AS BIGINT) AS populacao_2001
                    FROM customer WHERE c_custkey % 50 <> 1 AND c_custkey % 50 <> 0
                    UNION ALL
                    SELECT c_custkey, c_name, CAST(0 AS BIGINT) FROM customer WHERE c_custkey % 50 = 0),
         ag AS (SELECT 'Customer#' || lpad(CAST(s_nationkey AS VARCHAR), 9, '0') AS municipio_nome,
                       CAST(s_suppkey AS VARCHAR) AS convenio_id, s_suppkey * 1000 AS valor_convenio,
                       s_name AS objeto_convenio FROM supplier)
    SELECT cities.municipio_nome, municipio_id_ibge, populacao_2001, convenio_id, valor_convenio, objeto_convenio
    FROM cities LEFT JOIN ag ON cities.municipio_nome = ag.municipio_nome"""
SQL["stamp_columns"] = """
    SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS carimbo,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS data_carga_iso
    FROM events"""

_CODE_NUM = "CAST(o_custkey AS VARCHAR)"
SQL["batch_run"] = f"""
    WITH a AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n,
                      sum(o_totalprice) AS s FROM orders GROUP BY 1, 2),
    pick AS (SELECT k, CASE WHEN bool_or(y = 1998) THEN 1998 ELSE max(y) END AS y FROM a GROUP BY k),
    p AS (SELECT {zf('a.k')} AS cod,
                 CAST(CASE WHEN a.n = 1 THEN 0 WHEN a.n = 2 THEN NULL ELSE floor(a.s) END AS BIGINT) AS populacao
          FROM a JOIN pick ON a.k = pick.k AND a.y = pick.y WHERE a.k % 17 <> 0),
    ev AS (SELECT CASE WHEN o_orderstatus = 'O' OR o_custkey % 2 = 0 THEN {zf('o_custkey')}
                       WHEN length({_CODE_NUM}) = 6 THEN lpad({_CODE_NUM}, 7, '0')
                       WHEN length({_CODE_NUM}) = 7 THEN {_CODE_NUM} END AS cod, o_orderstatus
           FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus IN ('F', 'O')),
    d AS (SELECT cod, count(*) FILTER (WHERE o_orderstatus = 'F') AS ob,
                 count(*) FILTER (WHERE o_orderstatus = 'O') AS nv
          FROM ev WHERE cod IS NOT NULL GROUP BY 1)
    SELECT p.cod AS cod_mun_ibge_7, 1998 AS ano, p.populacao,
           CAST(0 AS BIGINT) AS total_internacoes, CAST(coalesce(d.ob, 0) AS BIGINT) AS total_obitos,
           CAST(coalesce(d.nv, 0) AS BIGINT) AS nascidos_vivos, CAST(0.0 AS DOUBLE) AS taxa_internacao_100k,
           {rate('coalesce(d.ob, 0)', 'p.populacao', 100000)} AS taxa_obitos_100k
    FROM p LEFT JOIN d ON p.cod = d.cod"""
SQL["streaming_bronze_ingest"] = f"""
    SELECT {zf('o_custkey')} AS cod_mun_ibge_7, CAST(year(o_orderdate) AS INTEGER) AS ano,
           count(*) AS nascidos_vivos
    FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2"""
SQL["vaccination_unwrap"] = f"""
    SELECT {zf('user_id')} AS cod_mun_ibge_7, CAST(year(ts) AS INTEGER) AS ano, event_type AS dose,
           count(*) AS doses
    FROM events WHERE event_id % 3 <> 2 GROUP BY 1, 2, 3"""
SQL["mart_health_ordered"] = mart_sql("saude") + " ORDER BY g.populacao DESC NULLS LAST, g.cod_mun_ibge_7, g.ano"
SQL["kpi_health"] = marts_with("saude", "cnes") + """
    SELECT (SELECT count(DISTINCT cod_mun_ibge_7) FROM ms) AS municipios,
           (SELECT CAST(coalesce(sum(p), 0) AS BIGINT) FROM
              (SELECT cod_mun_ibge_7, max(populacao) AS p FROM ms GROUP BY 1)) AS populacao_total,
           (SELECT CAST(coalesce(sum(total_estabelecimentos), 0) AS BIGINT) FROM mc) AS estabelecimentos,
           (SELECT CAST(coalesce(sum(hospitais), 0) AS BIGINT) FROM mc) AS hospitais,
           (SELECT CAST(coalesce(sum(leitos_totais), 0) AS BIGINT) FROM mc) AS leitos"""
SQL["kpi_education"] = marts_with("educacao") + """
    SELECT count(DISTINCT cod_mun_ibge_7) AS municipios,
           CAST(coalesce(sum(matriculas), 0) AS BIGINT) AS matriculas,
           CAST(coalesce(sum(docentes), 0) AS BIGINT) AS docentes,
           CAST(coalesce(sum(escolas), 0) AS BIGINT) AS escolas
    FROM me"""


# ---- landed files by folder and by layout ------------------------------------------
SQL["event_counts_by_folder"] = f"""
    SELECT CASE WHEN ano % 2 = 0 THEN CAST(o_custkey + 3000000 AS VARCHAR) ELSE lpad(CAST(o_custkey + 300000 AS VARCHAR), 7, '0') END
             AS cod_mun_ibge_7, ano, count(*) AS total_obitos
    FROM (SELECT o_custkey, {YEAR.format('o_orderdate')} AS ano FROM orders WHERE o_custkey % 5 IN (1, 3)) GROUP BY 1, 2"""
SQL["csv_microdata_layouts"] = """
    SELECT CAST(o_custkey + 3000000 AS VARCHAR) AS cod_mun_ibge_7, count(*) AS matriculas, 1998 AS ano
    FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1"""


# ---- one batch run of 1998 over everything landed ------------------------------------
_B_POP = f"""SELECT {zf('a.k')} AS cod,
                   CAST(CASE WHEN a.n = 1 THEN 0 WHEN a.n = 2 THEN NULL ELSE floor(a.s) END AS BIGINT) AS populacao
            FROM (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n, sum(o_totalprice) AS s FROM orders GROUP BY 1, 2) a
            JOIN (SELECT o_custkey AS k, CASE WHEN bool_or(year(o_orderdate) = 1998) THEN 1998 ELSE CAST(max(year(o_orderdate)) AS INTEGER) END AS y
                  FROM orders GROUP BY 1) pick ON a.k = pick.k AND a.y = pick.y WHERE a.k % 17 <> 0"""
SQL["batch_education"] = f"""
    SELECT e.*, {rate('e.matriculas', 'p.populacao', 1000)} AS taxa_matriculas_por_1000_hab
    FROM (SELECT {zf('l_suppkey')} AS cod_mun_ibge_7, 1998 AS ano, CAST(trunc(sum(l_quantity)) AS BIGINT) AS matriculas,
                 CAST(sum(l_linenumber) AS BIGINT) AS docentes, count(*) AS escolas
          FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY 1) e
    LEFT JOIN ({_B_POP}) p ON p.cod = e.cod_mun_ibge_7"""
SQL["batch_gdp"] = f"""
    SELECT cod AS cod_mun_ibge_7, 1998 AS ano, t AS pib_total_mil_reais, pc AS pib_per_capita FROM (
      SELECT {zf('k')} AS cod, CASE WHEN n >= 3 THEN CAST(floor(s) + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS DOUBLE) END AS t,
             CASE WHEN n >= 3 AND k % 10 <> 3 THEN CAST(floor(s / n) AS DOUBLE) END AS pc
      FROM (SELECT o_custkey AS k, count(*) AS n, sum(o_totalprice) AS s FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1) WHERE k % 17 <> 0)
    WHERE t IS NOT NULL OR pc IS NOT NULL"""
SQL["batch_transfers"] = f"""
    SELECT {zf('l_suppkey')} AS cod_mun_ibge_7, 1998 AS ano,
           {r2('coalesce(sum(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END), 0.0)')} AS total_transferencias_reais
    FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY 1"""
SQL["batch_facilities"] = SQL["gold_facilities"].replace("'ECONOMY'", "'^05$|HOSPITAL'").replace("'SMALL'", "'^01$|^02$|BASICA|UBS'")
_B_GOLD = {"saude": SQL["batch_run"], "educacao": SQL["batch_education"], "pib": SQL["batch_gdp"], "transferencias": SQL["batch_transfers"],
           "cnes": SQL["batch_facilities"]}
_B_DEATHS = f"""SELECT CASE WHEN o_orderstatus = 'O' OR o_custkey % 2 = 0 THEN {zf('o_custkey')}
                            WHEN length({_CODE_NUM}) = 6 THEN lpad({_CODE_NUM}, 7, '0') WHEN length({_CODE_NUM}) = 7 THEN {_CODE_NUM} END AS cod, o_orderstatus AS s
                FROM orders WHERE year(o_orderdate) = 1998"""


def _counts(rows: dict[str, str], name: str, more: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS {name}, ({v}) AS linhas{more}" for k, v in rows.items())


def _n(sql: str) -> str:
    return f"SELECT count(*) FROM ({sql})"


SQL["batch_bronze_formats"] = _counts({
    "ibge_municipios": _n(SQL["dim_flatten_nested_json"]), "ibge_populacao": _n(_B_POP),
    "datasus_obitos": f"SELECT count(DISTINCT cod) FROM ({_B_DEATHS}) WHERE s = 'F'",
    "datasus_nascidos": f"SELECT count(DISTINCT cod) FROM ({_B_DEATHS}) WHERE s = 'O'",
    "inep_educacao": _n(SQL["batch_education"]), "cnes_estabelecimentos": "SELECT count(*) FROM part", "ibge_pib": _n(SQL["batch_gdp"]),
    "transparencia_transferencias": "SELECT count(*) FROM lineitem WHERE year(l_shipdate) = 1998"}, "fonte", ", CAST(0 AS BIGINT) AS diferentes")
SQL["batch_catalog"] = _counts({
    "dim_municipio": _n(SQL["dim_flatten_nested_json"]), "silver_ibge_populacao": _n(_B_POP), "silver_datasus_indicadores": "0",
    "silver_inep_educacao": _n(SQL["batch_education"]), "gold_indicadores_saude_municipio": _n(_B_GOLD["saude"]),
    "gold_indicadores_educacao_municipio": _n(_B_GOLD["educacao"]), "gold_pib_municipio": _n(_B_GOLD["pib"]),
    "gold_transparencia_transferencias": _n(_B_GOLD["transferencias"]), "gold_cnes_municipio": _n(_B_GOLD["cnes"])}, "tabela")
_B_MART = f"""SELECT g.cod_mun_ibge_7, m.nome_municipio, m.sigla_uf, g.* EXCLUDE (cod_mun_ibge_7)
              FROM ({_B_GOLD['saude']}) g LEFT JOIN ({SQL['dim_flatten_nested_json']}) m ON m.cod_mun_ibge_7 = g.cod_mun_ibge_7"""
SQL["mart_from_published"] = f"SELECT *, TRUE AS tem_carga FROM ({_B_MART})"
_kpi = SQL["kpi_overview"]
SQL["kpi_from_published"] = (f"WITH ms AS ({_B_MART}), me AS ({_B_GOLD['educacao']}), mp AS ({_B_GOLD['pib']}), mt AS ({_B_GOLD['transferencias']}), "
                             f"mc AS ({_B_GOLD['cnes']})\n" + _kpi[_kpi.index(",\n    pt AS"):])
SQL["publish_audited"] = with_views("v_gdp") + f""",
    r AS (SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS k, CASE WHEN o_orderkey % 11 <> 0 THEN year(o_orderdate) END AS y, o_totalprice AS t FROM orders),
    g AS (SELECT k, y, max(t) AS t, count(*) AS n FROM r WHERE k IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2)
    SELECT count(*) AS linhas, {r2('sum(t)')} AS total, (SELECT count(*) FROM r) AS lidas, (SELECT count(*) FROM r WHERE k IS NULL) AS sem_chave,
           (SELECT count(*) FROM r WHERE k IS NOT NULL AND y IS NULL) AS sem_ano, CAST(sum(n) - count(*) AS BIGINT) AS duplicadas, count(*) AS publicadas,
           count(DISTINCT k) FILTER (WHERE k % 5 = 0) AS orfas FROM g"""
SQL["latest_snapshot_by_year"] = with_views("v_pop") + """
    SELECT *, ano AS ano_arquivo FROM v_pop WHERE ano BETWEEN 1996 AND 1999 AND (ano <> 1998 OR CAST(cod_mun_ibge_7 AS BIGINT) % 3 <> 0)"""


# ---- figures for every choice of the state and year filters ---------------------------
def _choices(src: str, aggs: str) -> str:
    return f"""(SELECT uf, a AS ano, {aggs} FROM (SELECT *, unnest(['Todos', CAST(ano AS VARCHAR)]) AS a FROM (SELECT *, unnest(['Todos', sigla_uf]) AS uf FROM {src}))
               WHERE uf IS NOT NULL AND a IS NOT NULL GROUP BY 1, 2)"""


_sums = {"me": ["matriculas", "docentes", "escolas"], "mc": ["total_estabelecimentos:estabelecimentos", "leitos_totais:leitos"]}
SQL["kpi_filtered"] = marts_with("saude", "educacao", "pib", "transferencias", "cnes") + f""",
    pk AS (SELECT cod_mun_ibge_7 AS cod, sigla_uf, CAST(ano AS VARCHAR) AS ano, max(populacao) AS p FROM ms GROUP BY 1, 2, 3
           UNION ALL SELECT cod_mun_ibge_7, sigla_uf, 'Todos', max(populacao) FROM ms GROUP BY 1, 2),
    pe AS (SELECT uf, ano, count(DISTINCT cod) AS municipios, CAST(coalesce(sum(p), 0) AS BIGINT) AS populacao_total
           FROM (SELECT *, unnest(['Todos', sigla_uf]) AS uf FROM pk) WHERE uf IS NOT NULL GROUP BY 1, 2),
    ce AS {_choices('me', ', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in _sums['me']))},
    cc AS {_choices('mc', ', '.join('CAST(coalesce(sum({}), 0) AS BIGINT) AS {}'.format(*c.split(':')) for c in _sums['mc']))},
    cp AS {_choices('mp', 'sum(pib_total_mil_reais) AS t, quantile_cont(pib_per_capita, 0.5) AS md')},
    ct AS {_choices('mt', 'sum(total_transferencias_reais) / 1e9 AS t')},
    u AS (SELECT uf, ano FROM pe UNION SELECT uf, ano FROM ce UNION SELECT uf, ano FROM cc UNION SELECT uf, ano FROM cp UNION SELECT uf, ano FROM ct)
    SELECT u.uf, u.ano, coalesce(municipios, 0) AS municipios, coalesce(populacao_total, 0) AS populacao_total, coalesce(matriculas, 0) AS matriculas,
           coalesce(docentes, 0) AS docentes, coalesce(escolas, 0) AS escolas, coalesce(estabelecimentos, 0) AS estabelecimentos, coalesce(leitos, 0) AS leitos,
           {r2('cp.t')} AS pib_total_mil_reais, cp.md AS pib_per_capita_mediano, round(coalesce(ct.t, 0), 6) AS transferencias_bi
    FROM u LEFT JOIN pe USING (uf, ano) LEFT JOIN ce USING (uf, ano) LEFT JOIN cc USING (uf, ano) LEFT JOIN cp USING (uf, ano) LEFT JOIN ct USING (uf, ano)"""


# ---- shared layout, variants, file order -----------------------------------------------
SQL["mart_bucketed"] = SQL["mart_health"]


def _facilities(name: str, kind: str, active: str) -> str:
    return f"""SELECT {zf("regexp_replace(p_brand, '[^0-9]', '', 'g')")} AS cod_mun_ibge_7, 1998 AS ano,
           CAST(count(*) AS BIGINT) AS total_estabelecimentos, count(*) FILTER (WHERE regexp_matches(upper({kind}), 'ECONOMY')) AS hospitais,
           count(*) FILTER (WHERE regexp_matches(upper({kind}), 'SMALL')) AS ubs,
           CAST(trunc(coalesce(sum(CAST(p_size AS DOUBLE)), 0)) AS BIGINT) AS leitos_totais,
           CAST(trunc(coalesce(sum(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / 2 END), 0)) AS BIGINT) AS leitos_sus, '{name}' AS fonte
    FROM part WHERE {active} AND NOT (p_partkey % 4 <> 0 AND p_partkey % 29 = 0) GROUP BY 1"""


_open = "p_size % 10 NOT IN (0, 5)"
SQL["facility_payload_variants"] = " UNION ALL ".join([
    _facilities("co", "p_type", _open), _facilities("tp", "CASE WHEN p_size % 2 = 0 THEN p_type END", _open), _facilities("ds", "p_type", _open),
    _facilities("livre", "p_type", "TRUE")])
SQL["first_by_file_position"] = f"""
    SELECT {zf('c_custkey')} AS cod_mun_ibge_7, CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey - 30.0 END::DOUBLE AS latitude,
           (-40.0 - c_nationkey)::DOUBLE AS longitude FROM customer"""
