"""Batch pipeline: landed payload files -> bronze -> silver -> gold.

``run`` reads each landed source with its scan, keeps an immutable bronze
snapshot, standardises keys into silver tables (dimension upsert, population
and education replace/upsert) and publishes the gold tables by replacing the
years of the batch. Optional sources that are absent are skipped (the
reference logs and continues). Each gold table is one Catalyst plan; the
reruns of a year replace that year, so running twice equals running once.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake import schemas
from civiclake.functions.keys import EVENT_KEY_RENAMES, KEY, rename_first, resolve_short_keys, standardise_key
from civiclake.operators import core
from civiclake.plans import gold
from civiclake.session import materialize
from civiclake.sinks import tables as sinks
from civiclake.sources import files, payloads, snapshots

log = logging.getLogger("civiclake.batch")


@dataclass
class Landing:
    """Folders of landed payload files (None = source not landed)."""
    municipios: str
    populacao: str
    obitos: str | None = None
    nascidos: str | None = None
    sinopse: list[str] | None = None
    microdados: str | None = None
    cnes: str | None = None
    pib: str | None = None
    transferencias: str | None = None
    # True: each file holds one whole payload as the API returned it (a JSON
    # array or object, possibly pretty-printed); False: one payload per line.
    one_payload_per_file: bool = False


@dataclass
class RunResult:
    gold: dict[str, DataFrame] = field(default_factory=dict)
    population_year: int | None = None
    skipped: list[str] = field(default_factory=list)
    # files read and files passed over, with the reason
    report: files.ScanReport = field(default_factory=files.ScanReport)
    # table -> (duplicate (key, year) rows, keys missing from the dimension)
    checks: dict[str, tuple[int, int]] = field(default_factory=dict)
    # table -> rows read, rejected, repeated and published (``publish_audited``)
    audit: dict[str, dict[str, int]] = field(default_factory=dict)
    gdp_year: int | None = None
    education_source: str | None = None
    lake: str = ""
    database: str | None = None


def _exists(spark: SparkSession, path: str | None) -> bool:
    if not path:
        return False
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _payload_text(spark: SparkSession, path: str, whole_files: bool) -> DataFrame:
    """Payload texts: one per line, or one per file (``wholetext``)."""
    # text()'s own ``wholetext`` argument overrides a reader option: pass it here.
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "payload")


def read_series_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Series payloads (each a JSON array of variables)."""
    return payloads.series_from_text(_payload_text(spark, path, whole_files))


def read_record_pages(spark: SparkSession, path: str, element, envelope, whole_files: bool = False) -> DataFrame:
    """Paged API payloads (bare lists or envelopes)."""
    return payloads.records_from_pages(_payload_text(spark, path, whole_files), "payload", element, envelope)


def run(spark: SparkSession, landing: Landing, lake: str, ano: int,
        sample: int | None = None, keys: list[str] | None = None,
        all_municipalities: bool = False, include: tuple[str, ...] = (),
        check: bool = False, database: str | None = None, microdata_first: bool = False,
        states: list[str] | None = None) -> RunResult:
    """Run the batch for year ``ano`` over all municipalities, or over ``keys``, or
    over a stratified sample when a ``sample`` size is given. ``include`` may hold 'pib', 'transferencias',
    'cnes'; ``states`` restricts deaths and births to the folders of these states;
    ``microdata_first`` asks the school microdata before the synopsis.

    Every table is published with its audit (``RunResult.audit``): rows read, rejected
    for a null key or year, repeated (Q1). With ``check`` also the keys absent from the
    dimension (Q2) are counted; ``RunResult.checks`` has both (the
    reference's UNIQUE and foreign keys, reported instead of enforced).

    With ``database`` the run creates the catalog's tables (K11) over ``lake`` and
    registers what it writes, so that ``plans.published`` serves marts from them."""
    lake = lake.rstrip("/")
    res = RunResult(lake=lake, database=database)
    if database:
        sinks.create_tables(spark, database, lake)

    # Municipalities: scan -> bronze snapshot -> newest snapshot -> silver dimension upsert.
    whole = landing.one_payload_per_file
    if whole:      # each file is the API's JSON array of municipality objects
        texts = _payload_text(spark, landing.municipios, True).select(
            F.explode(F.from_json("payload", "array<string>")).alias("payload"))
    else:          # one municipality object per line
        texts = _payload_text(spark, landing.municipios, False)
    mun = payloads.municipality_rows_from_text(texts)
    sinks.write_snapshot(mun, f"{lake}/bronze", "ibge_municipios")
    dim_raw = snapshots.latest_snapshot(spark, f"{lake}/bronze/ibge_municipios/*/parquet")
    # of a municipality listed twice the later row of the snapshot stays
    at = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    dim = standardise_key(dim_raw.withColumn("_seq", at))
    sinks.dimension_upsert(spark, f"{lake}/dim_municipio", dim, "_seq")
    _register(spark, res, "dim_municipio")
    dim = sinks.read_dimension(spark, f"{lake}/dim_municipio")

    # Key restriction: all, an explicit list, or the stratified sample.
    key_df = None
    if keys and not all_municipalities:
        key_df = spark.createDataFrame([(k,) for k in keys], f"{KEY} string")
    elif sample is not None and not all_municipalities:
        key_df = core.stratified_sample(dim, n=sample).select(KEY)

    # Population: requested year, else one earlier (resolved once, D3).
    items = read_series_pages(spark, landing.populacao, whole)
    pop_years = core.union_all([payloads.population_rows(items, y) for y in core.backoff_years(ano)])
    if key_df is not None:
        pop_years = payloads.restrict_keys(pop_years, key_df)
    # parsed once: the probes for the year, its name and the snapshot read the rows
    pop_years = materialize(pop_years, "batch-populacao")
    pop = core.preferred_year(pop_years, core.backoff_years(ano))
    res.population_year = pop.agg(F.max("ano_efetivo")).first()[0]
    pop = (pop.withColumn("ano_origem", F.coalesce("ano_origem", "ano_efetivo"))
           .withColumn("ano", F.lit(int(ano))).drop("ano_efetivo"))
    pop = standardise_key(pop)
    sinks.write_snapshot(pop, f"{lake}/bronze", f"ibge_populacao_{ano}")
    # silver takes the newest bronze snapshot of its year
    pop = snapshots.latest_by_year(spark, f"{lake}/bronze", "ibge_populacao", ano)
    res.audit["silver_ibge_populacao"] = sinks.publish_audited(pop.select(KEY, "ano", "populacao"), f"{lake}/silver_ibge_populacao", "silver_ibge_populacao")
    _register(spark, res, "silver_ibge_populacao")
    pop = sinks.read_table(spark, f"{lake}/silver_ibge_populacao", "silver_ibge_populacao") \
        .where(F.col("ano") == ano)
    sinks.write_snapshot(pop, f"{lake}/silver", f"ibge_populacao_{ano}", csv=False)

    # Deaths and births per municipality (per-state record files).
    def guarded(name: str, build):
        """A source that fails is logged and skipped; the run goes on."""
        try:
            return build()
        except Exception as e:  # noqa: BLE001 - the failure is reported in the result
            res.skipped.append(f"{name}: {type(e).__name__}")
            log.warning("%s failed and was skipped: %s", name, e)
            return None

    def events(name: str, path: str | None, count):
        if not _exists(spark, path):
            return None
        rows = guarded(name, lambda: count(spark, path, ano, res.report, states))
        return None if rows is None else guarded(name, lambda: materialize(rows, f"batch-{name}"))

    deaths = events("obitos", landing.obitos, files.death_counts)
    births = events("nascidos", landing.nascidos, files.birth_counts)
    # P5 + P1: first matching key column renamed, then standardised (silver).
    deaths, births = [None if d is None else standardise_key(rename_first(d, EVENT_KEY_RENAMES, KEY))
                      for d in (deaths, births)]
    for name, df in (("obitos", deaths), ("nascidos", births)):
        if df is None:
            res.skipped.append(name)
        else:
            sinks.write_snapshot(df, f"{lake}/bronze", f"datasus_{name}")
    # six-digit codes (zero-padded so far) take the code of their municipality
    deaths, births = [None if d is None else resolve_short_keys(d, dim) for d in (deaths, births)]

    # Education: synopsis first, microdata when the synopsis gives nothing (F1), or
    # the other way round on request. A source is built when its turn comes: the
    # one that is not needed is never read.
    def synopsis():
        sheets = files.read_sheets(spark, [p for p in landing.sinopse if _exists(spark, p)], res.report)
        return files.synopsis_sums(sheets, ano, report=res.report)

    def microdata():
        return files.microdata_counts(spark, landing.microdados, ano, report=res.report)

    order = [("sinopse", synopsis, bool(landing.sinopse)), ("microdados", microdata, _exists(spark, landing.microdados))]
    edu = None
    for name, build, landed in order[::-1] if microdata_first else order:
        rows = guarded(name, build) if landed else None
        rows = None if rows is None else guarded(name, lambda r=rows: materialize(r, "batch-inep"))
        if rows is not None and not rows.isEmpty():
            edu, res.education_source = rows, name
            break
    if edu is not None:
        sinks.write_snapshot(edu, f"{lake}/bronze", "inep_educacao")
        sums = [F.sum(c).alias(c) for c in ("matriculas", "docentes", "escolas") if c in edu.columns]
        edu = resolve_short_keys(edu, dim).groupBy(KEY, "ano").agg(*sums)
        sinks.education_silver_upsert(spark, f"{lake}/silver_inep_educacao", edu)
        _register(spark, res, "silver_inep_educacao")
        edu = sinks.read_table(spark, f"{lake}/silver_inep_educacao", "silver_inep_educacao")
        sinks.write_snapshot(edu.where(F.col("ano") == ano), f"{lake}/silver", f"inep_educacao_{ano}", csv=False)
    else:
        res.skipped.append("inep")

    # Gold: health and education.
    audit_dim = dim if check else None
    health = gold.health_indicators(pop, deaths=deaths, births=births, ano=ano)
    _publish(spark, health, "gold_indicadores_saude_municipio", res, audit_dim)
    if edu is not None:
        _publish(spark, gold.education_indicators(edu, pop, ano=ano), "gold_indicadores_educacao_municipio", res, audit_dim)

    # Optional sources: a failing one is logged and skipped, the run goes on.
    def optional(name: str, path: str | None, build) -> None:
        if name not in include:
            return
        if not _exists(spark, path):
            res.skipped.append(name)
            log.info("%s: nothing landed at %s", name, path)
            return
        try:
            build()
        except Exception as e:  # noqa: BLE001 - optional sources never stop the run
            res.skipped.append(name)
            log.warning("%s failed and was skipped: %s", name, e)

    def bronze(rows: DataFrame, name: str) -> DataFrame:
        """K1: keep what was received, then work from the snapshot."""
        return spark.read.parquet(sinks.write_snapshot(rows, f"{lake}/bronze", f"{name}_{ano}") + "/parquet")

    def cnes() -> None:
        recs = bronze(read_record_pages(spark, landing.cnes, schemas.FACILITY_RECORD, payloads.FACILITY_ENVELOPE, whole), "cnes_estabelecimentos")
        rows = resolve_short_keys(payloads.facility_rows(recs, ano), dim)
        rows = payloads.restrict_keys(rows, key_df) if key_df is not None else rows
        _publish(spark, gold.facility_counts(rows), "gold_cnes_municipio", res, audit_dim)

    def pib() -> None:
        # a preferred year that was landed, before the latest one under the first label
        rows, res.gdp_year = payloads.gdp_by_preference(read_series_pages(spark, landing.pib, whole), core.lagged_years(ano))
        _publish(spark, gold.gdp_indicators(bronze(rows, "ibge_pib")), "gold_pib_municipio", res, audit_dim)

    def transferencias() -> None:
        recs = read_record_pages(spark, landing.transferencias, schemas.TRANSFER_RECORD,
                                 payloads.TRANSFER_ENVELOPE, whole)
        year = F.col("anoReferencia")      # pages of several years may have been landed
        recs = bronze(recs.where(year.isNull() | (year == F.lit(int(ano)))), "transparencia_transferencias")
        totals = resolve_short_keys(gold.transfer_totals(payloads.transfer_rows(recs, ano), stamp=False), dim)
        totals = totals.groupBy(KEY, "ano").agg(F.sum("total_transferencias_reais").alias("valor"))
        _publish(spark, gold.transfer_totals(totals), "gold_transparencia_transferencias", res, audit_dim)

    optional("cnes", landing.cnes, cnes)
    optional("pib", landing.pib, pib)
    optional("transferencias", landing.transferencias, transferencias)
    if database:
        _register(spark, res, "silver_datasus_indicadores")
    if check:
        res.checks = {t: (a["duplicadas"], a["orfas"]) for t, a in res.audit.items() if t in res.gold}
    log.info("batch %s done: gold %s, skipped %s, audit %s", ano, sorted(res.gold), res.skipped, res.audit)
    return res


def _register(spark: SparkSession, res: RunResult, table: str) -> None:
    if res.database:
        sinks.register(spark, res.database, table)


def _publish(spark: SparkSession, df: DataFrame, table: str, res: RunResult, dim: DataFrame | None) -> None:
    """K5 + K8: replace the batch's years with an audit, export a gold snapshot,
    register, read back."""
    path = f"{res.lake}/{table}"
    res.audit[table] = sinks.publish_audited(df, path, table, dim)
    _register(spark, res, table)
    res.gold[table] = sinks.read_table(spark, path, table)
    sinks.write_snapshot(res.gold[table], f"{res.lake}/exports", table)
    log.info("%s published: %s", table, res.audit[table])
