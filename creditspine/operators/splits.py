"""Time windows and train/validation/test splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.operators.projection import hash_order
from creditspine.operators.ranks import cut_classes, row_hash

SPLIT_NAMES = ("train", "val", "test")
#: Label values that a stratified split counts on the driver.
MAX_LABELS = 1000


def _add_months(d: date, months: int) -> date:
    serial = d.year * 12 + d.month - 1 + months
    return date(serial // 12, serial % 12 + 1, d.day)


@dataclass(frozen=True)
class TimeWindows:
    """Training and out-of-time windows around a train date; all ends inclusive."""

    train_date: date
    train_start: date
    train_end: date
    oot_start: date
    oot_end: date
    oot_months: tuple[tuple[date, date], ...]


def time_windows(train_date: str | date = S.TRAIN_DATE, train_months: int = S.TRAIN_TEST_MONTHS,
                 oot_months: int = S.OOT_MONTHS) -> TimeWindows:
    """Out of time = the last ``oot_months`` before the train date; training =
    the ``train_months`` before that."""
    day = timedelta(days=1)
    t = date.fromisoformat(train_date) if isinstance(train_date, str) else train_date
    oot_start = _add_months(t, -oot_months)
    months = tuple(
        (_add_months(oot_start, i), _add_months(oot_start, i + 1) - day) for i in range(oot_months)
    )
    return TimeWindows(t, _add_months(oot_start, -train_months), oot_start - day, oot_start, t - day, months)


def tag_windows(df: DataFrame, w: TimeWindows, column: str = S.SNAPSHOT) -> DataFrame:
    """Add ``window`` (train_test, oot or null) and ``oot_part`` (oot1, oot2, ...)."""
    d = F.col(column)
    part = F.lit(None).cast("string")
    for i, (start, end) in reversed(list(enumerate(w.oot_months))):
        part = F.when(d.between(F.lit(start), F.lit(end)), F.lit(f"oot{i + 1}")).otherwise(part)
    window = F.when(d.between(F.lit(w.train_start), F.lit(w.train_end)), "train_test").when(
        d.between(F.lit(w.oot_start), F.lit(w.oot_end)), "oot"
    )
    return df.withColumns({"window": window, "oot_part": part})


def split_by_dates(df: DataFrame, w: TimeWindows) -> tuple[DataFrame, DataFrame]:
    tagged = tag_windows(df, w)
    return (
        tagged.where(F.col("window") == "train_test").drop("window", "oot_part"),
        tagged.where(F.col("window") == "oot").drop("window", "oot_part"),
    )


def stratified_split(df: DataFrame, keys: Sequence[str], label: str = "label",
                     shares: Sequence[float] = S.SPLIT_SHARES, seed: int = 88) -> DataFrame:
    """Add ``split`` so that each label keeps the shares exactly; keys may repeat.

    Fits the hash value at each share's rank per label (two numbers a label),
    then tags every row by comparing its own key hash: the table is neither
    sorted nor shuffled, and a rerun gives the same split. Rows that repeat the
    key at a cut are divided by all their columns, equal rows by number. More
    than ``MAX_LABELS`` label values are an error: such a column is no class.
    """
    counts = df.groupBy(F.col(label).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    totals = {r["v"]: r["n"] for r in counts.limit(MAX_LABELS + 1).collect()}
    if len(totals) > MAX_LABELS:
        raise ValueError(f"stratified_split takes at most {MAX_LABELS} label values")
    if None in totals:
        raise ValueError("stratified_split needs a label on every row")
    ends = {}
    for value, n in totals.items():
        n_train = round(n * shares[0])
        ends[value] = (n_train, n_train + round((n - n_train) * shares[1] / (shares[1] + shares[2])))
    tagged = cut_classes(df, [hash_order(keys, seed), row_hash(df, seed)], ends, label)
    names = F.array(*[F.lit(name) for name in SPLIT_NAMES])
    return tagged.withColumn("split", F.get(names, F.col("_class"))).drop("_class")


def random_split(df: DataFrame, keys: Sequence[str], share: float = 0.7, seed: int = 88) -> DataFrame:
    """Add ``split`` train/test by key hash, without stratification."""
    parts = 1 << 20
    inside = F.pmod(hash_order(keys, seed), F.lit(parts)) < F.lit(int(round(share * parts)))
    return df.withColumn("split", F.when(inside, "train").otherwise("test"))
