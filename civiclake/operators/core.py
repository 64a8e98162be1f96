"""Generic DataFrame -> DataFrame operators: filters, projections, unions,
deduplication, sampling, top-n, fallbacks.

None of them collects rows to the driver; decisions that depend on data
(counts, minimum priority, maximum) are scalar subqueries inside one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions.keys import KEY

ALL = "Todos"        # fixed value: the "no filter" choice of the dashboard filters
N_STATES = 27        # fixed value: number of states the default sample spreads over


# ---- P: filters and projections ---------------------------------------------
def year_filter(df: DataFrame, ano: int | None, column: str = "ano") -> DataFrame:
    """Filter to one year when a year is given and the column exists."""
    if ano is None or column not in df.columns:
        return df
    return df.where(F.col(column) == F.lit(int(ano)))


def dashboard_filter(df: DataFrame, uf: str = ALL, ano: str | int = ALL) -> DataFrame:
    """State and year filter; ``Todos`` means no filter; an absent column
    is ignored."""
    if uf != ALL and "sigla_uf" in df.columns:
        df = df.where(F.col("sigla_uf") == F.lit(uf))
    if ano != ALL and "ano" in df.columns:
        df = df.where(F.col("ano") == F.lit(int(ano)))
    return df


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bulk rename of the columns that are present."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_missing(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Add absent columns as typed nulls."""
    for c, t in columns.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.dropna(subset=list(subset))


def select_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: project the listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


# ---- U: unions and deduplication ------------------------------------------------
def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, absent columns as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order`` (ascending).

    An aggregate (``min_by`` of the whole row) rather than a window: partial
    aggregation combines duplicates map-side, so a key holding a third of the
    rows never lands whole in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordc = [F.col(o) if isinstance(o, str) else o for o in order]
    picked = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*rest), F.struct(*ordc)).alias("_row")))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


# ---- W1: stratified sample ------------------------------------------------------
def stratified_sample(dim: DataFrame, n: int = 100, group: str = "sigla_uf",
                      order: str = KEY, groups: int = N_STATES) -> DataFrame:
    """The first ``max(1, n // groups)`` rows per group (null group
    dropped), then the first ``n`` overall; skipped when the frame has at most
    ``n`` rows. Order is the key (deterministic) where the reference used
    payload order.

    ``row_number() <= k`` is planned as a WindowGroupLimit: each map task
    keeps at most k rows per group before the shuffle, so a hot group costs
    k rows per task, not its size.
    """
    k = max(1, n // groups)
    # "more than n rows?" needs at most n + 1 rows, not a full count.
    total = dim.limit(n + 1).select(F.count(F.lit(1))).scalar()
    w = Window.partitionBy(group).orderBy(F.col(order))
    sampled = (dim.where(F.col(group).isNotNull())
               .withColumn("_rn", F.row_number().over(w))
               .where(F.col("_rn") <= k).drop("_rn")
               .orderBy(F.col(order)).limit(n))
    return sampled.where(total > n).unionByName(dim.where(total <= n))


# ---- T: sorts and top-n -----------------------------------------------------------
def top_n(df: DataFrame, measure: str, label: str, n: int = 10, key: str = KEY) -> DataFrame:
    """The ``n`` largest by ``measure`` (ties by key), projected to label and
    measure, *then* rows with a null label or measure dropped - so fewer than
    ``n`` rows may remain, as in the reference. A distributed top-k
    (TakeOrderedAndProject), never a full sort."""
    cols = [label, measure] if label != measure else [measure]
    top = (df.where(F.col(measure).isNotNull()).orderBy(F.col(measure).desc(), F.col(key)).limit(n)
           .select(*cols))
    return top.dropna(subset=cols)


def first_n(df: DataFrame, n: int, order: Sequence[str] = (KEY,)) -> DataFrame:
    """T4: prefix limit in key order (the key-list cap, a preview)."""
    return df.orderBy(*order).limit(n)


def newest(df: DataFrame, value: str, stamp: str) -> DataFrame:
    """T5: the value with the newest stamp, as a one-row frame."""
    return df.agg(F.max_by(value, stamp).alias(value), F.max(stamp).alias(stamp))


# ---- F: data-driven fallbacks ------------------------------------------------------
def first_non_empty(frames: Sequence[DataFrame]) -> DataFrame:
    """the first frame (in list order) that has rows, in one plan: frames are
    tagged with their priority and unioned; the minimum priority that has a
    row is a scalar subquery over one row per frame (``limit(1)`` each, so the
    probe stops at the first row instead of scanning every source)."""
    tagged = union_all([f.withColumn("_prio", F.lit(i)) for i, f in enumerate(frames)])
    probe = reduce(DataFrame.unionByName,
                   [f.limit(1).select(F.lit(i).alias("_prio")) for i, f in enumerate(frames)])
    best = probe.select(F.min("_prio")).scalar()
    return tagged.where(F.col("_prio") == best).drop("_prio")


def preferred_year(df: DataFrame, preferences: Sequence[int], column: str = "ano") -> DataFrame:
    """keep the rows of the first year in ``preferences`` that has data,
    and add it as ``ano_efetivo`` (resolved once; D3)."""
    rank = F.array_position(F.array(*[F.lit(int(y)) for y in preferences]), F.col(column))
    cand = df.withColumn("_rank", rank).where(F.col("_rank") > 0)
    # One row per preferred year at most: the year filter reaches the scan and
    # each probe stops at its first row.
    probe = reduce(DataFrame.unionByName, [
        df.where(F.col(column) == F.lit(int(y))).limit(1).select(F.lit(i + 1).alias("_rank"))
        for i, y in enumerate(preferences)])
    best = probe.select(F.min("_rank")).scalar()
    out = cand.where(F.col("_rank") == best).drop("_rank")
    return out.withColumn("ano_efetivo", F.col(column))


def backoff_years(ano: int) -> list[int]:
    """the requested year, else one earlier."""
    return [ano, ano - 1]


def lagged_years(ano: int, lag_after: int = 2021) -> list[int]:
    """for years after ``lag_after`` try y-2, y-3, y-1 (publication lag);
    otherwise only y."""
    # fixed values: the first year and the lags of the rule
    return [ano - 2, ano - 3, ano - 1] if ano > lag_after else [ano]


# ---- A: aggregates ---------------------------------------------------------------------
def count_per_key(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """A1/A2: rows per key (partial per partition, final after the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def first_non_null_by(df: DataFrame, key: str, columns: Sequence[str],
                      order: Sequence[str]) -> DataFrame:
    """Per key, for every column the value of the row that comes first
    in descending ``order`` among the rows where that column is not null."""
    o = F.struct(*[F.col(c) for c in order])
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in columns]
    return df.groupBy(key).agg(*aggs)


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """Combine one-row aggregates with disjoint columns into one row (a union
    and a max per column: no cartesian product)."""
    u = union_all(frames)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def exact_median(df: DataFrame, column: str, out: str = "mediana") -> DataFrame:
    """Exact median (mean of the two middle values for an even count), as a
    one-row frame, without gathering all values in one task; null when there is
    no value.

    Spark's exact ``median`` keeps every distinct value of a group in one
    buffer. Here the values are counted per distinct value (a partial
    aggregate, so repeated values collapse map-side) and the counts are written
    once, partitioned by value range. A running sum over one total per partition
    names the partitions that hold the middle ranks; only their values are ranked.
    """
    from civiclake.session import materialize
    x = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    counts = x.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    counts = materialize(counts.repartitionByRange("x").withColumn("_part", F.spark_partition_id()), "median-counts")
    # one row per partition: the window without a key sees no data rows
    parts = counts.groupBy("_part").agg(F.sum("c").alias("m"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.col("n")
    k_lo, k_hi = F.floor((n - 1) / 2), F.floor(n / 2)
    middle = (parts.select("_part", (F.sum("m").over(upto) - F.col("m")).alias("below"), "m", F.sum("m").over(total).alias("n"))
              .where((F.col("below") <= k_hi) & (F.col("below") + F.col("m") > k_lo)).select("_part", "below", "n"))
    inside = Window.partitionBy("_part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (counts.join(middle, "_part").withColumn("_end", F.sum("c").over(inside) + F.col("below"))
              .withColumn("_start", F.col("_end") - F.col("c")))
    pick = ranked.where(((F.col("_start") <= k_lo) & (F.col("_end") > k_lo)) |
                        ((F.col("_start") <= k_hi) & (F.col("_end") > k_hi)))
    return pick.agg(((F.min("x") + F.max("x")) / 2).alias(out))


def exact_median_by(df: DataFrame, groups: Sequence[str], column: str, out: str = "mediana") -> DataFrame:
    """A13 per group: the exact median of every combination of ``groups`` and of every
    total over one or more of them (``GROUPING SETS``), as (*groups, ``_total``, out):
    bit i of ``_total`` is set where group i is summed over. Groups without a value
    are absent.

    One shuffle counts the distinct values of all grouping sets (a partial aggregate);
    the counts are range-partitioned by (set, groups, value), so the total over
    everything, which holds all values, lies in many partitions. Totals per group and
    partition give each partition's rank offset; only the partitions that hold a
    group's middle ranks are ranked."""
    from civiclake.session import materialize
    x = df.select(*groups, F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    sets = [[g for i, g in enumerate(groups) if not mask >> i & 1] + ["x"] for mask in range(1 << len(groups))]
    counts = x.groupingSets([[F.col(c) for c in s] for s in sets], *groups, "x").agg(
        F.count(F.lit(1)).alias("c"), *[F.grouping(g).cast("int").alias(f"_g{i}") for i, g in enumerate(groups)])
    total = sum((F.shiftleft(F.col(f"_g{i}"), i) for i in range(len(groups))), F.lit(0))
    key = F.struct("_total", *groups)
    counts = counts.select(*groups, "x", "c", total.alias("_total")).withColumn("_key", F.xxhash64(key))
    counts = materialize(counts.repartitionByRange("_key", "_total", *groups, "x").withColumn("_part", F.spark_partition_id()), "median-counts")
    of = ["_total", *groups]
    parts = counts.groupBy(*of, "_part").agg(F.sum("c").alias("m"))
    upto = Window.partitionBy(*of).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k_lo, k_hi = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = (parts.select(*of, "_part", "m", (F.sum("m").over(upto) - F.col("m")).alias("below"), F.sum("m").over(Window.partitionBy(*of)).alias("n"))
              .where((F.col("below") <= k_hi) & (F.col("below") + F.col("m") > k_lo)))
    right = middle.select(*[F.col(c).alias(f"_r_{c}") for c in [*of, "_part"]], "below", "n")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in [*of, "_part"]])
    inside = Window.partitionBy(*of, "_part").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (counts.join(right, same).withColumn("_end", F.sum("c").over(inside) + F.col("below"))
              .withColumn("_start", F.col("_end") - F.col("c")))
    pick = ranked.where(((F.col("_start") <= k_lo) & (F.col("_end") > k_lo)) | ((F.col("_start") <= k_hi) & (F.col("_end") > k_hi)))
    return pick.groupBy(*of).agg(((F.min("x") + F.max("x")) / 2).alias(out))


def top_n_labelled(fact: DataFrame, labels: DataFrame, measure: str, label: str, n: int = 10,
                   key: str = KEY) -> DataFrame:
    """T1 on a fact without labels: the top ``n`` keys are chosen first, then
    only those rows are joined to the label frame, then null labels or
    measures are dropped. Same rows as ``top_n`` over the joined mart,
    without joining the whole fact.

    The join is inner: a top row without a label would be dropped by the null
    test anyway, and an inner join can build its hash table on the at most n
    top rows (broadcast, a bounded side) while the label frame streams past
    unshuffled; an outer join would have to build on the label side."""
    top = (fact.where(F.col(measure).isNotNull())
           .orderBy(F.col(measure).desc(), F.col(key)).limit(n).select(key, measure))
    lab = labels.select(key, label)
    cols = [label, measure]
    return (lab.join(F.broadcast(top), key, "inner").select(key, *cols)
            .orderBy(F.col(measure).desc(), F.col(key)).drop(key).dropna(subset=cols))


# ---- Q: checks -------------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: Sequence[str] = (KEY, "ano")) -> DataFrame:
    """Q1: keys that occur more than once (must be empty)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_linhas"))
            .where(F.col("n_linhas") > 1))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str = KEY) -> DataFrame:
    """Q2: fact keys missing from the dimension (an anti join)."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti")


def require_columns(df: DataFrame, columns: Sequence[str], empty_schema: T.StructType) -> DataFrame:
    """Q3: the frame when all ``columns`` are present, else a typed empty frame."""
    if all(c in df.columns for c in columns):
        return df
    return df.sparkSession.createDataFrame([], empty_schema)
