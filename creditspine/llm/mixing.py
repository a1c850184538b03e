"""Mixing sources to target weights, with DataFrame functions only.

Words are summed per source. Targets share ``share`` times all words by weight,
at most ``most`` times a source's own words; what a source can't take is shared
again by weight until none is above. A document is repeated floor(rate) times,
rate = target / words of its source, and once more if a uniform number drawn
from a hash of seed and id falls below the fraction. Rows that repeat an id, or
have none, draw from their other columns too, equal rows from their number, so
that they aren't taken or left all together. So a rerun gives the same mix, and
no document is repeated more than ``most`` times rounded up.

Sources are ordered by code point, null last; the n-th has the weight
``weights[n % len(weights)]``.

Defined results: a null or blank text has size 0. A null source is a source of
its own. Rows that repeat an id draw one by one. A source without words
has target 0, and its documents are taken once each with their 0 words. An
empty table gives no rows. Further columns are carried along by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspine.llm.common import store
from creditspine.operators.ranks import number_alike, row_hash

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *names: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of a hash of seed and names (null: empty)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(n.cast("string"), F.lit("")) for n in names])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row per source."""
    n = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    out = store(sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most)))
    total = float(share) * (out.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        # sources at their cap at this level keep it; the others share the rest
        capped = F.col("weight") * level >= F.col("cap")
        row = out.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("held"),
                      F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)).alias("free")).first()
        if not row["free"]:
            break
        new = (total - row["held"]) / row["free"]
        if new <= level:
            break
        level = new
    target = F.least(F.col("cap"), F.col("weight") * level)
    return out.select("source", "source_size", "weight", target.alias("target"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17) -> DataFrame:
    """(row, size, source_size, target, copies): ``row`` is a struct of the input's columns."""
    name, text = F.col(id_col), word_count(text_col).alias("size")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    source = F.col(source_col).cast("string").alias("source")
    rows = docs.select(row, text, source, uniform(seed, name).alias("draw"))
    repeated = store(docs.groupBy(name.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    if not repeated.isEmpty():
        same = F.col("row")[id_col].eqNullSafe(F.col("id"))
        several = docs.select(row, text, source, row_hash(docs, seed).alias("hash")).join(repeated, same, "left_semi")
        draw = uniform(seed, F.col("row")[id_col], F.col("hash"), F.col("number")).alias("draw")
        drawn = number_alike(several, "hash", "number").select("row", "size", "source", draw)
        rows = rows.join(repeated, same, "left_anti").unionAll(drawn)
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(per_source, weights, share, most).withColumnRenamed("source", "named")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(1.0)
    copies = F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")
    return rows.join(plan, rows["source"].eqNullSafe(plan["named"])).select(
        "row", "size", "source_size", "target", copies.cast("long").alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    plan = mix_plan(docs, **options).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
