"""Distributions and drift: PSI, CSI, Kolmogorov-Smirnov, chi-square.

Features are unpivoted once to (feature, value) rows; every test is then one
grouped aggregate over all features and months, with partial counts combined
before the shuffle. Bins are the deciles of the reference; an empty bin counts
as share 1e-4.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspine.operators.ranks import bucket_of, fit_edges, running_totals, small, unpivot_numeric
from creditspine.operators.stats import chi_square_pvalue, ks_pvalue
from creditspine.sources.session import cut_lineage

N_BINS = 10
EMPTY_SHARE = 1e-4


def _bin_name(index: Column) -> Column:
    return F.lpad(index.cast("string"), 2, "0")


def numeric_bins(df: DataFrame, edges: DataFrame, columns: Sequence[str], ids: Sequence[str] = (),
                 edge_keys: Sequence[str] = ("feature",), n_bins: int = N_BINS) -> DataFrame:
    """Counts per (ids, feature, bin) against fitted edges; nulls are left out.

    The edge table has one row per feature (and model); counted and found small
    it is broadcast, so rows are binned and counted before any shuffle.
    """
    long = unpivot_numeric(df, ids, columns).where(F.col("value").isNotNull())
    binned = long.join(small(edges, edges.count()), list(edge_keys)).withColumn("bin", _bin_name(bucket_of(F.col("value"), F.col("edges"), n_bins - 1)))
    return binned.groupBy(*dict.fromkeys([*edge_keys, *ids, "feature"]), "bin").agg(F.count(F.lit(1)).alias("n"))


def category_bins(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Counts per (ids, feature, category); null is ``Unknown``. ``known`` leaves the nulls out."""
    wide = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return _text_bins(wide.unpivot(list(ids), list(columns), "feature", "category").withColumn("n", F.lit(1).cast("long")), ids)


def _text_bins(counts: DataFrame, ids: Sequence[str]) -> DataFrame:
    named = counts.withColumn("bin", F.coalesce("category", F.lit("Unknown")))
    return named.groupBy(*ids, "feature", "bin").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("category").isNotNull(), F.col("n")).otherwise(0)).alias("known")
    )


def value_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, feature, value, category, n): rows per distinct value, all columns in one scan.

    The state that drift is told from: counts of the same ids add up, and bins,
    distribution functions, category shares and null counts follow from them.
    Numbers stand in ``value``, texts in ``category``; missing ones are null.
    """
    def cell(c: str, number: bool) -> Column:
        x = F.col(c)
        value = F.nanvl(x.cast("double"), F.lit(None).cast("double")) if number else F.lit(None).cast("double")
        return F.struct(value.alias("value"), (F.lit(None) if number else x).cast("string").alias("category")).alias(c)

    wide = df.select(*ids, *[cell(c, True) for c in numeric], *[cell(c, False) for c in categorical])
    rows = wide.unpivot(list(ids), [*numeric, *categorical], "feature", "cell").select(*ids, "feature", "cell.*")
    return rows.groupBy(*ids, "feature", "value", "category").agg(F.count(F.lit(1)).alias("n"))


def add_counts(*states: DataFrame) -> DataFrame:
    """The counts of several states as one."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy(*[c for c in rows.columns if c != "n"]).agg(F.sum("n").alias("n"))


def with_shares(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``share`` of ``n`` within the keys."""
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    return counts.join(totals, list(keys)).withColumn("share", F.col("n") / F.col("_total")).drop("_total")


def numeric_distribution(df: DataFrame, columns: Sequence[str], n_bins: int = N_BINS) -> DataFrame:
    """Decile edges (open ends) and share per bin for every numeric feature.

    ``(feature, bin, lower, upper, share)``; a bin between equal edges has share 0.
    """
    edges = fit_edges(df, columns, n_bins)
    counts = with_shares(numeric_bins(df, edges, columns, n_bins=n_bins), ["feature"])
    return _all_bins(edges, n_bins, F.lit(float("-inf")), F.lit(float("inf"))).join(
        counts, ["feature", "bin"], "left"
    ).select("feature", "bin", "lower", "upper", F.coalesce("share", F.lit(0.0)).alias("share"))


def _all_bins(edges: DataFrame, n_bins: int, first: Column, last: Column) -> DataFrame:
    limits = F.concat(F.array(first), F.col("edges"), F.array(last))
    bins = F.transform(
        F.sequence(F.lit(0), F.lit(n_bins - 1)),
        lambda i: F.struct(
            _bin_name(i).alias("bin"), F.get(limits, i).alias("lower"), F.get(limits, i + 1).alias("upper")
        ),
    )
    keys = [c for c in edges.columns if c != "edges"]
    return edges.select(*keys, F.inline(bins))


def score_distribution(df: DataFrame, score: str, by: Sequence[str] = (), n_bins: int = N_BINS) -> DataFrame:
    """Decile edges of a score (ends 0 and 1) and the share per bin."""
    edges = fit_edges(df, [score], n_bins, by)
    counts = with_shares(numeric_bins(df, edges, [score], by, [*by, "feature"], n_bins), [*by, "feature"])
    return _all_bins(edges, n_bins, F.lit(0.0), F.lit(1.0)).join(
        counts, [*by, "feature", "bin"], "left"
    ).select(*by, "bin", "lower", "upper", F.coalesce("share", F.lit(0.0)).alias("share"))


def category_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share per category, ``Unknown`` for null, largest first per feature."""
    shares = with_shares(category_bins(df, columns), ["feature"])
    return shares.select("feature", F.col("bin").alias("category"), "share").orderBy("feature", F.col("share").desc(), "category")


def feature_distributions(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                          n_bins: int = N_BINS) -> DataFrame:
    """Numeric and categorical distributions in one long table."""
    num = numeric_distribution(df, numeric, n_bins).select(
        "feature", F.lit("numeric").alias("kind"), "bin", "lower", "upper", "share"
    )
    cat = category_distribution(df, categorical).select(
        "feature", F.lit("categorical").alias("kind"), F.col("category").alias("bin"),
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"), "share",
    )
    return num.unionByName(cat)


def psi_from_bins(reference: DataFrame, current: DataFrame, subject: Sequence[str], run: Sequence[str]) -> DataFrame:
    """Stability index per (subject, run): ``sum((p - q) * ln(p / q))``.

    ``reference`` counts bins per subject, ``current`` per subject and run. Both
    are bin counts, so their size is bins, not rows; they are written out once
    (eager) because shares, runs and the comparison all read them.
    """
    return _psi(cut_lineage(reference), cut_lineage(current), list(subject), list(run))


def _psi(reference: DataFrame, current: DataFrame, subject: list[str], run: list[str]) -> DataFrame:
    ref = with_shares(reference, subject).select(*subject, "bin", F.col("share").alias("p"))
    cur = with_shares(current, [*subject, *run]).select(*subject, *run, "bin", F.col("share").alias("q"))
    runs = cur.select(*subject, *run).distinct()
    expected = ref.join(runs, subject)  # every reference bin of every run of the same subject
    both = expected.join(cur, [*subject, *run, "bin"], "full")
    p = F.greatest(F.coalesce("p", F.lit(0.0)), F.when(F.coalesce("p", F.lit(0.0)) == 0, F.lit(EMPTY_SHARE)))
    q = F.greatest(F.coalesce("q", F.lit(0.0)), F.when(F.coalesce("q", F.lit(0.0)) == 0, F.lit(EMPTY_SHARE)))
    return both.groupBy(*subject, *run).agg(F.sum((p - q) * F.log(p / q)).alias("psi"))


def prediction_psi(reference: DataFrame, current: DataFrame, score: str = "model_predictions",
                   version: str = "model_version", run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """Drift of scores per (version, run) against the version's reference scores."""
    edges = fit_edges(reference, [score], N_BINS, [version])
    ref = numeric_bins(reference, edges, [score], [version], [version, "feature"])
    cur = numeric_bins(current, edges, [score], [version, *run], [version, "feature"])
    out = psi_from_bins(ref, cur, [version, "feature"], run)
    return out.select(version, *run, F.col("psi").alias("psi_score"))


def feature_csi(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """Stability index of every feature per run: ``(feature, run..., csi)``.

    A feature without any value on either side gives no row.
    """
    run = list(run)
    edges = fit_edges(reference, numeric, N_BINS)
    ref = numeric_bins(reference, edges, numeric).withColumn("known", F.col("n"))
    cur = numeric_bins(current, edges, numeric, run).withColumn("known", F.col("n"))
    if categorical:
        ref = ref.unionByName(category_bins(reference, categorical))
        cur = cur.unionByName(category_bins(current, categorical, run))
    return _csi(ref, cur, run)


def csi_from_counts(reference: DataFrame, current: DataFrame, edges: DataFrame, categorical: Sequence[str],
                    run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """``feature_csi`` of the rows that two tables of value counts describe."""
    run, n_edges = list(run), edges.count()

    def bins(counts: DataFrame, ids: Sequence[str]) -> DataFrame:
        binned = counts.where(F.col("value").isNotNull()).join(small(edges, n_edges), "feature").withColumn(
            "bin", _bin_name(bucket_of(F.col("value"), F.col("edges"), N_BINS - 1)))
        numbers = binned.groupBy(*ids, "feature", "bin").agg(F.sum("n").alias("n")).withColumn("known", F.col("n"))
        return numbers.unionByName(_text_bins(counts.where(F.col("feature").isin(*categorical)), ids)) if categorical else numbers

    return _csi(bins(reference, []), bins(current, run), run)


def _csi(reference: DataFrame, current: DataFrame, run: list[str]) -> DataFrame:
    """Stability index from bins; a feature without known values on either side gives no row."""
    ref, cur = cut_lineage(reference), cut_lineage(current)
    seen = ref.groupBy("feature").agg(F.sum("known").alias("k")).where("k > 0").select("feature")
    usable = cur.groupBy("feature", *run).agg(F.sum("known").alias("k")).where("k > 0").drop("k").join(seen, "feature", "left_semi")
    kept = cur.join(usable, ["feature", *run], "left_semi")
    return _psi(ref, kept, ["feature"], run).withColumnRenamed("psi", "csi")


def csi_summary(csi: DataFrame, run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    return csi.groupBy(*run).agg(F.max("csi").alias("max_csi"), F.avg("csi").alias("mean_csi"))


def ks_numeric(reference: DataFrame, current: DataFrame, columns: Sequence[str],
               run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per (feature, run).

    Between two values of a run its distribution is flat, so the largest
    distance lies at a value of the run or just below one. The reference is
    ranked once for all runs and looked up there: the work grows with the
    distinct values of the reference plus those of the runs.
    """
    return ks_from_counts(value_counts(reference, columns, []), value_counts(current, columns, [], run), run)


def ks_from_counts(reference: DataFrame, current: DataFrame, run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """``ks_numeric`` of the rows that two tables of value counts describe."""
    run = list(run)
    keys = ["feature", *run]
    known = F.col("value").isNotNull()
    cur = cut_lineage(current.where(known).select(*keys, "value", F.col("n").alias("n_cur")))
    points = reference.where(known).select("feature", "value", F.col("n").alias("n_ref"))
    points = points.unionByName(
        cur.select("feature", "value", F.lit(0).cast("bigint").alias("n_ref"))
    ).groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"))
    looked_up = running_totals(cur, keys, "value", ["n_cur"]).join(
        running_totals(points, ["feature"], "value", ["n_ref"]), ["feature", "value"]
    )
    below = [F.try_divide(F.col(f"{m}_before").cast("double"), F.col(f"{m}_total")) for m in ("n_ref", "n_cur")]
    up_to = [
        F.try_divide((F.col(f"{m}_before") + F.col(m)).cast("double"), F.col(f"{m}_total")) for m in ("n_ref", "n_cur")
    ]
    return (
        looked_up.groupBy(*keys)
        .agg(
            F.max(F.greatest(F.abs(up_to[0] - up_to[1]), F.abs(below[0] - below[1]))).alias("statistic"),
            F.max("n_ref_total").alias("_a"),
            F.max("n_cur_total").alias("_b"),
        )
        .where((F.col("_a") > 0) & (F.col("_b") > 0))
        .withColumn("p_value", ks_pvalue(F.col("statistic"), F.col("_a"), F.col("_b")))
        .drop("_a", "_b")
    )


def chi_square_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                     run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """Goodness of fit of each run's categories to the reference shares.

    Nulls are left out. A category new to the run gives an infinite statistic
    and p-value 0.
    """
    return chi_square_from_counts(value_counts(reference, [], columns), value_counts(current, [], columns, run), run)


def chi_square_from_counts(reference: DataFrame, current: DataFrame, run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """``chi_square_drift`` of the rows that two tables of value counts describe."""
    run = list(run)

    def cells(counts: DataFrame, ids: Sequence[str]) -> DataFrame:
        return cut_lineage(counts.where(F.col("category").isNotNull()).select(*ids, "feature", F.col("category").alias("bin"), "n"))

    ref = with_shares(cells(reference, []), ["feature"]).select("feature", "bin", "share")
    cur = cells(current, run)  # category counts, read several times below
    totals = cur.groupBy(*run, "feature").agg(F.sum("n").alias("total"))
    both = ref.join(totals.drop("total"), "feature").join(cur, [*run, "feature", "bin"], "full")
    both = both.join(totals, [*run, "feature"])
    known = ref.select("feature").distinct()
    expected = F.col("share") * F.col("total")
    observed = F.coalesce("n", F.lit(0)).cast("double")
    term = F.when(F.col("share").isNull(), F.lit(float("inf"))).otherwise(
        (observed - expected) * (observed - expected) / expected
    )
    return (
        both.join(known, "feature", "left_semi")
        .groupBy("feature", *run)
        .agg(F.sum(term).alias("statistic"), (F.count(F.lit(1)) - 1).cast("int").alias("dof"))
        .withColumn("p_value", chi_square_pvalue("statistic", "dof"))
    )


def min_pvalue(tests: Sequence[DataFrame], run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    rows = tests[0].select(*run, "p_value")
    for t in tests[1:]:
        rows = rows.unionByName(t.select(*run, "p_value"))
    return rows.groupBy(*run).agg(F.min("p_value").alias("min_csi_pvalue"))


def usable_features(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                    run: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """(feature, run) pairs with a value on both sides."""
    run = list(run)
    ref = reference.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], list(columns), "feature", "n_ref")
    cur = current.groupBy(*run).agg(*[F.count(c).alias(c) for c in columns]).unpivot(run, list(columns), "feature", "n_cur")
    return cur.join(ref, "feature").select(
        "feature", *run, ((F.col("n_ref") > 0) & (F.col("n_cur") > 0)).alias("usable")
    )
