"""Explicit schemas for raw payloads and lake tables.

Keys are text (leading zeros matter), years and months int, counts long,
rates and money double, load stamps timestamp.
"""

from pyspark.sql import types as T

S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


# ---- raw payloads -----------------------------------------------------------
MUNICIPALITY_JSON = _st(
    ("id", L), ("nome", S),
    ("microrregiao", _st(("mesorregiao", _st(("UF", _st(("id", I), ("sigla", S))))))),
)
SERIES_ITEM = _st(
    ("id", S),
    ("resultados", T.ArrayType(_st(
        ("series", T.ArrayType(_st(
            ("localidade", _st(("id", S))),
            ("serie", T.MapType(S, S)),
        ))),
    ))),
)
SERIES_JSON = T.ArrayType(SERIES_ITEM)
TRANSFER_RECORD = _st(
    ("codigoMunicipio", S), ("nomeMunicipio", S), ("siglaUf", S),
    ("anoReferencia", I), ("mesReferencia", I), ("nomeTipoTransferencia", S), ("valor", S),
)
FACILITY_RECORD = _st(
    ("co_municipio", S), ("st_ativo", S),
    ("co_tipo_estabelecimento", S), ("tp_estabelecimento", S), ("ds_tipo_estabelecimento", S),
    ("qt_leito", S), ("qt_leito_sus", S),
)
CENTROIDS_CSV = _st(("codigo_ibge", S), ("latitude", D), ("longitude", D), ("ordem", I))
AGREEMENT = _st(("municipio_nome", S), ("convenio_id", S), ("valor_convenio", L), ("objeto_convenio", S))

# ---- lake tables ------------------------------------------------------------
TABLES: dict[str, T.StructType] = {
    "dim_municipio": _st(("cod_mun_ibge_7", S), ("nome_municipio", S), ("sigla_uf", S), ("cod_uf", I)),
    "silver_ibge_populacao": _st(("cod_mun_ibge_7", S), ("ano", I), ("populacao", L), ("data_carga", TS)),
    "silver_datasus_indicadores": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("mes", I), ("indicador", S), ("valor", D),
        ("unidade", S), ("data_carga", TS)),
    "silver_inep_educacao": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("matriculas", L), ("docentes", L), ("escolas", L),
        ("data_carga", TS)),
    "gold_indicadores_saude_municipio": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("populacao", L), ("total_internacoes", L),
        ("total_obitos", L), ("nascidos_vivos", L), ("taxa_internacao_100k", D),
        ("taxa_obitos_100k", D), ("data_carga", TS)),
    "gold_indicadores_educacao_municipio": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("matriculas", L), ("docentes", L), ("escolas", L),
        ("taxa_matriculas_por_1000_hab", D), ("data_carga", TS)),
    "gold_pib_municipio": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("pib_total_mil_reais", D), ("pib_per_capita", D),
        ("data_carga", TS)),
    "gold_transparencia_transferencias": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("total_transferencias_reais", D), ("data_carga", TS)),
    "gold_cnes_municipio": _st(
        ("cod_mun_ibge_7", S), ("ano", I), ("total_estabelecimentos", L), ("hospitais", L),
        ("ubs", L), ("leitos_totais", L), ("leitos_sus", L), ("data_carga", TS)),
}

# Natural keys: (cod, ano) for facts; cod for the dimension.
TABLE_KEYS: dict[str, list[str]] = {
    name: (["cod_mun_ibge_7"] if name == "dim_municipio" else ["cod_mun_ibge_7", "ano"])
    for name in TABLES
}
# The layout of every table: the column it is partitioned by (the dimension by the
# state prefix of its key), none for the append-only table.
DIM_PARTITION = "prefixo_uf"
PARTITIONED_BY: dict[str, str | None] = {
    name: DIM_PARTITION if name == "dim_municipio" else None if name == "silver_datasus_indicadores" else "ano" for name in TABLES
}
