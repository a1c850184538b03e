"""Order statistics without a single-task window.

Ranks over a whole table (AUC, Kolmogorov-Smirnov, exact quantiles, exact
samples) would put all rows of a group into one task if written as one plain
window. Here equal values are counted first (partial aggregation before the
shuffle, so a value held by a third of all rows is one row afterwards). Running
sums then deal the distinct values of all groups into ranges of about equal
size; quantiles and samples only ever rank the values near the wanted ranks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspine.sources.session import cut_and_count, cut_lineage

ACCURACY = 10_000
#: Counted values that one task ranks.
ROWS_PER_RANGE = 1 << 17
#: Fitted tables (brackets, bin edges) up to this size are broadcast, so the data is not shuffled to meet them.
BROADCAST_ROWS = 100_000


def bucket_of(value: Column, edges: Column, n_edges: int) -> Column:
    """Number of interior edges at or below the value: its half-open bin.

    Written as a sum of ``n_edges`` comparisons, which is generated code; a
    higher-order function over the array would be interpreted row by row.
    """
    return sum(((F.get(edges, F.lit(j)) <= value).cast("int") for j in range(n_edges)), F.lit(0))


def running_totals(
    counts: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``<m>_before`` (sum over smaller values) and ``<m>_total`` per key group.

    ``counts`` holds one row per (keys, order); rows with a null key or value
    are left out. A scan on two levels: the rows are dealt into ranges of
    (keys, order) of about ``rows_per_range`` rows, so a key with many values
    spreads over many ranges and the number of ranges grows with the table; the
    sums of whole ranges, one row per key and range, are summed across ranges,
    and running sums are windows inside one range. Eager: the counts are written
    once and once more with their range, which both levels read.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("running_totals needs at least one key column")
    counts, rows = cut_and_count(counts.dropna(subset=[*keys, order]))
    ranges = math.ceil(rows / rows_per_range)
    if ranges > 1:
        placed = cut_lineage(counts.repartitionByRange(ranges, *keys, order).withColumn("_range", F.spark_partition_id()))
    else:
        placed = counts.withColumn("_range", F.lit(0))

    across = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    sums = placed.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
    offsets, n_offsets = cut_and_count(sums.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_s_{m}").over(across), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(whole).alias(f"{m}_total") for m in measures],
    ))
    inside = Window.partitionBy("_range", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumns({f"_b_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    return (
        within.join(small(offsets, n_offsets), [*keys, "_range"])
        .withColumns({f"{m}_before": F.col(f"_o_{m}") + F.col(f"_b_{m}") for m in measures})
        .drop("_range", *[f"_{x}_{m}" for m in measures for x in "ob"])
    )


def _number(c: Column) -> Column:
    """As a double; NaN counts as missing."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def small(table: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its counted ``rows`` are within BROADCAST_ROWS."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def unpivot_numeric(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                    name: str = "feature", value: str = "value") -> DataFrame:
    """Wide numeric columns to (ids, feature, value) rows, as doubles; NaN becomes null."""
    wide = df.select(*ids, *[_number(F.col(c)).alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), name, value)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact linear-interpolation quantiles of many columns at once.

    Returns ``(by..., feature, prob, quantile)``. Nulls and null groups are left
    out; a column without values gives no row. Eager, two scans:

    1. one aggregate sketches a narrow value bracket around every wanted rank;
       the brackets of all groups are a stored table;
    2. one aggregate counts values inside the brackets one by one and whole
       gaps between brackets as single cells, so that next to nothing is
       shuffled: about ``4 / accuracy`` of the rows per wanted rank.

    Nulls and NaN are left out. The counted cells are ranked on the
    cluster. The built-in exact percentile would keep all distinct values of a
    group in one task's memory.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    keys = [*by, "feature"]
    rows = df.dropna(subset=by) if by else df
    brackets, n_brackets = cut_and_count(_brackets(rows, columns, probs, by))
    long = unpivot_numeric(rows, by, columns).where(F.col("value").isNotNull())
    value = F.col("value")

    def passed(j: int) -> Column:
        span = F.get("spans", F.lit(j))
        return F.coalesce((value >= span["lo"]).cast("int") + (value > span["hi"]).cast("int"), F.lit(0))

    # span starts at or below the value plus span ends below it: odd inside a span
    cell = sum((passed(j) for j in range(len(probs))), F.lit(0))
    counts = (
        long.join(small(brackets, n_brackets), keys)
        .select(*keys, "value", cell.alias("cell"))
        .withColumn("single", F.col("cell") % 2 == 1)
        .groupBy(*keys, "cell", "single", F.when(F.col("single"), F.col("value")).alias("at"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value"), F.max("value").alias("top"))
        .drop("cell", "at")
    )
    return _rank_on_cluster(counts, keys, probs)


def _brackets(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., feature, spans): disjoint value spans (lo, hi) in rising order, one
    per wanted rank at most; no row for a feature without values."""
    reach = 2.0 / ACCURACY
    grid = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    aggs = [F.percentile_approx(_number(F.col(c)), grid, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)]
    sketches = df.groupBy(*by).agg(*aggs)
    named = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"q{i}").alias("q")) for i, c in enumerate(columns)])
    at = F.sequence(F.lit(0), F.lit(len(probs) - 1))
    pairs = F.array_sort(F.transform(at, lambda j: F.struct(F.get("q", 2 * j).alias("lo"), F.get("q", 2 * j + 1).alias("hi"))))

    def merged(spans: Column, new: Column) -> Column:
        last = F.element_at(spans, -1)
        wider = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], new["hi"]).alias("hi"))
        return F.when(new["lo"] <= last["hi"], F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(wider))).otherwise(
            F.concat(spans, F.array(new)))

    first = F.slice("pairs", 1, 1)
    rest = F.slice("pairs", 2, max(1, len(probs)))
    return (
        sketches.select(*by, F.inline(named)).where(F.col("q").isNotNull())
        .select(*by, "feature", pairs.alias("pairs"))
        .select(*by, "feature", F.aggregate(rest, first, merged).alias("spans"))
    )


def _rank_on_cluster(counts: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles from a distributed cell table (value, top, n, single value?)."""
    ranked = running_totals(counts, keys, "value", ["n"])

    def holds(rank: Column) -> Column:
        return (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))

    def position(p: Column) -> Column:
        return (F.col("n_total") - 1) * p

    def at(rank: Column) -> Column:
        first = F.col("single") | (rank == F.col("n_before"))
        last = rank == F.col("n_before") + F.col("n") - 1
        outside = F.raise_error(F.lit("wanted rank lies outside its bracket"))
        return F.when(holds(rank), F.when(first, F.col("value")).when(last, F.col("top")).otherwise(outside.cast("double")))

    served = F.filter(
        F.array(*[F.lit(p) for p in probs]),
        lambda p: holds(F.floor(position(p))) | holds(F.ceil(position(p))),
    )
    where = position(F.col("prob"))
    low, high = F.floor(where), F.ceil(where)
    hits = (
        ranked.select("*", F.explode(served).alias("prob"))
        .groupBy(*keys, "prob")
        .agg(F.max(at(low)).alias("_low"), F.max(at(high)).alias("_high"), F.max(where - low).alias("_frac"))
    )
    return hits.select(
        *keys, "prob",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")).alias("quantile"),
    )


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """Sketch quantiles of many columns in one aggregate, ``(feature, prob, quantile)``.

    Rank error is at most ``1/accuracy``; nothing but sketches is shuffled, so
    this is the cheap form for very wide, very large tables.
    """
    grid = [float(p) for p in probs]
    sketch = df.agg(*[F.percentile_approx(F.col(c).cast("double"), grid, accuracy).alias(c) for c in columns])
    long = sketch.unpivot([], list(columns), "feature", "q")
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in grid]).alias("prob"), F.col("q").alias("quantile"))
    return (
        long.where(F.col("q").isNotNull())
        .select("feature", F.explode(pairs).alias("pair"))
        .select("feature", F.col("pair.prob").alias("prob"), F.col("pair.quantile").alias("quantile"))
    )


def fit_edges(df: DataFrame, columns: Sequence[str], n_bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Interior quantile bin edges, one row ``(by..., feature, edges)`` each.

    The edges are part of a model's record (``n_bins - 1`` numbers per feature
    and group) and are stored, so that every later pass over the data reuses them.
    """
    by = list(by)
    q = exact_quantiles(df, columns, [i / n_bins for i in range(1, n_bins)], by)
    pairs = F.sort_array(F.collect_list(F.struct("prob", "quantile")))
    return cut_lineage(q.groupBy(*by, "feature").agg(F.transform(pairs, lambda p: p["quantile"]).alias("edges")))


def hash_cuts(df: DataFrame, order: str, wanted: Mapping[object, Sequence[int]], group: str | None = None,
              step: int = 12) -> dict[tuple[object, int], tuple[int | None, int | None]]:
    """For each group, the value of the ``r``-th smallest entry of a 64-bit hash
    column, for all wanted ranks ``r``; None when a group has no more rows.

    The second number is None where the rows up to that value are exactly ``r``;
    else more rows than wanted bear the value, and it says how many of them to take.

    Radix descent: each pass counts rows per next ``step`` bits, only inside the
    cells that still hold a wanted rank, so a pass is one partial aggregate
    whose result is at most ``2**step`` rows per wanted rank. The number of
    passes grows with the logarithm of the table (two for a million rows).
    """
    g = F.col(group) if group else F.lit(0)
    found: dict[tuple[object, int], tuple[int | None, int | None]] = {}
    open_cells = {(k, r): (0, None, r) for k, ranks in wanted.items() for r in ranks}  # bits, prefix, rank inside
    for key in [key for key, (_, _, r) in open_cells.items() if r <= 0]:
        found[key] = -(1 << 63) - 1, None  # below every hash
        del open_cells[key]
    while open_cells:
        bits = next(iter(open_cells.values()))[0]
        width = min(step, 64 - bits)
        child = F.shiftright(F.col(order), 64 - bits - width)
        rows = df
        if bits:
            parent = F.shiftright(F.col(order), 64 - bits)
            cells = {(k, p) for (k, _), (_, p, _) in open_cells.items()}
            rows = df.where(reduce(lambda a, b: a | b, [
                ((g == F.lit(k)) if group else F.lit(True)) & (parent == F.lit(p)) for k, p in cells
            ]))
        counted = rows.groupBy(g.alias("g"), child.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = sorted((r["g"] if group else None, r["p"], r["n"]) for r in counted)
        following = {}
        for (k, rank), (_, prefix, left) in open_cells.items():
            inside = [(p, n) for kk, p, n in counts if kk == (k if group else None) and (prefix is None or p >> width == prefix)]
            if sum(n for _, n in inside) <= left and prefix is None:
                found[k, rank] = None, None
                continue
            for p, n in inside:
                if left <= n:
                    break
                left -= n
            if left == n or bits + width == 64:  # the whole cell is taken: cut at its last hash
                found[k, rank] = ((p + 1) << (64 - bits - width)) - 1, None if left == n else left
            else:
                following[k, rank] = (bits + width, p, left)
        open_cells = following
    return found


def row_hash(df: DataFrame, seed: int) -> Column:
    """Seeded hash of all columns that can be hashed (maps can't): equal for equal rows only."""
    return F.xxhash64(F.lit(seed), *[F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind])


def cut_classes(df: DataFrame, orders: Sequence[Column], wanted: Mapping[object, Sequence[int]],
                group: str | None = None, name: str = "_class") -> DataFrame:
    """Add ``name``: how many of its group's ``wanted`` ranks each row lies beyond (null groups: 0).

    Rows are ranked by the first of ``orders`` (64-bit hashes), rows that tie
    there by the next, and rows that tie in all of them, which are equal rows
    if the last one hashes all columns, by number. So a class has exactly the
    rows that its ranks say, also where one key holds most of the table. The
    rows are only filtered and tagged; just those tied at a wanted rank are
    stored, and never meet in one task.
    """
    depth = len(orders)
    order, cell, more = f"_order{depth}", f"_cell{depth}", f"_more{depth}"
    hashed = df.withColumn(order, orders[0])
    cuts = hash_cuts(hashed, order, {v: sorted(set(ranks)) for v, ranks in wanted.items()}, group)

    def of(value) -> Column:
        return F.col(group) == F.lit(value) if group else F.lit(True)

    def beyond(cut: int | None) -> Column:
        if cut is None:
            return F.lit(0)
        return F.lit(1) if cut < -(1 << 63) else (F.col(order) > F.lit(cut)).cast("int")

    passed, tie, inside = F.lit(0), F.lit(None).cast("int"), {}
    for value, ranks in wanted.items():
        passed = F.when(of(value), sum((beyond(cuts[value, r][0]) for r in ranks), F.lit(0))).otherwise(passed)
        for r in ranks:
            cut, part = cuts[value, r]
            if part is not None:
                inside.setdefault((value, cut), []).append(part)
    tagged = hashed.withColumn(name, passed)
    if not inside:
        return tagged.drop(order)
    for n, (value, cut) in enumerate(inside):
        tie = F.when(of(value) & (F.col(order) == F.lit(cut)), F.lit(n)).otherwise(tie)
    tagged = tagged.withColumn(cell, tie).drop(order)
    tied = cut_lineage(tagged.where(F.col(cell).isNotNull()))
    parts = dict(enumerate(inside.values()))
    ranked = cut_classes(tied, orders[1:], parts, cell, more) if depth > 1 else _numbered_classes(tied, parts, cell, more)
    loose = tagged.where(F.col(cell).isNull()).drop(cell)
    return loose.unionByName(ranked.withColumn(name, F.col(name) + F.col(more)).drop(cell, more))


def number_alike(rows: DataFrame, alike: str, name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``name``: the rows with one value of ``alike`` numbered from 1.

    Which of them gets which number depends on the layout, so the table is the
    same on every run only if such rows are equal. Eager: the rows are stored and
    cut into ranges of about ``rows_per_range``; a row's number is the size of the
    ranges before its own plus its number there, so a hot value is many tasks.
    """
    salted, n_rows = cut_and_count(rows.withColumn("_at", F.monotonically_increasing_id()))
    salted = salted.withColumn("_range", F.pmod("_at", F.lit(max(1, math.ceil(n_rows / rows_per_range))))).drop("_at")
    before = Window.partitionBy(alike).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy(alike, "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets, n_offsets = cut_and_count(sizes.select(alike, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    own = F.row_number().over(Window.partitionBy(alike, "_range").orderBy("_range"))
    numbered = salted.withColumn("_own", own).join(small(offsets, n_offsets), [alike, "_range"])
    return numbered.withColumn(name, F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")


def _numbered_classes(rows: DataFrame, wanted: Mapping[int, Sequence[int]], cell: str, name: str,
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """As ``cut_classes`` for rows that are alike inside a cell: any numbering gives the same table."""
    passed = F.lit(0)
    for value, ranks in wanted.items():
        passed = F.when(F.col(cell) == value, sum(((F.col("_number") > r).cast("int") for r in ranks), F.lit(0))).otherwise(passed)
    return number_alike(rows, cell, "_number", rows_per_range).withColumn(name, passed).drop("_number")
