"""Sources and sinks as write-then-read queries, gates, and checks of splits and samples by membership."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import oracles as O
from checks.queries_models import REF_RANGE, _dist, reference
from checks.queries_tables import KEY, LABEL_KINDS, LEDGER_KINDS
from checks.registry import QUERIES, query
from creditspine import schemas as S
from creditspine.functions import cleaning as C
from creditspine.operators import drift, encode, impute, monitor, projection, splits
from creditspine.plans import gold
from creditspine.plans import training as training_plan
from creditspine.sources import snapshots as IO
from creditspine.sources.session import scratch

RUN_KINDS = {**KEY, "model_name": "s", "model_version": "s", "model_predictions": "f"}
RAW_KINDS = {c.name: "s" for c in S.RAW_ATTRIBUTES} | {"snapshot_date": "d"}
MONTH = "1996-03-01"


def place(t, name: str) -> str:
    """A new folder beside the intermediate tables."""
    return scratch(t.spark, name)


# --- sources and sinks -----------------------------------------------------------------
@query("history_written_and_read", LEDGER_KINDS, "SELECT * FROM led")
def _(t):
    path = place(t, "ledger")
    IO.write_snapshot(t.ledger(), path)
    return IO.read_history(t.spark, path)


@query("one_month_rewritten", LABEL_KINDS, (
    f"SELECT * REPLACE (CASE WHEN snapshot_date = DATE '{MONTH}' THEN 1 - label ELSE label END AS label) FROM labels"
))
def _(t):
    path = place(t, "labels")
    IO.write_snapshot(t.stored("labels"), path)
    IO.write_snapshot(projection.at_snapshot(t.stored("labels"), MONTH).withColumn("label", 1 - F.col("label")), path)
    return IO.read_history(t.spark, path)


@query("month_read", LABEL_KINDS, f"SELECT * FROM labels WHERE snapshot_date = DATE '{MONTH}'")
def _(t):
    path = place(t, "labels")
    IO.write_snapshot(t.stored("labels"), path)
    return IO.read_snapshot(t.spark, path, MONTH)


def attributes_csv(t) -> str:
    """The raw attributes as header CSV with quotes doubled, as an export would hold them."""
    path = place(t, "attributes-csv")
    raw = t.stored("raw_attributes").select(*S.RAW_ATTRIBUTES.names)
    # the writer would cut the blanks round a value
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(header=True, escape='"', **kept).csv(path)
    return path


query("csv_read", {c.name: "s" for c in S.RAW_ATTRIBUTES}, "SELECT * FROM att_raw")(
    lambda t: IO.read_csv(t.spark, attributes_csv(t), S.RAW_ATTRIBUTES))


@query("bronze_ingested", RAW_KINDS, "SELECT * FROM att_raw WHERE try_cast(snapshot_date AS DATE) >= DATE '1995-01-01'")
def _(t):
    mart = IO.Datamart(place(t, "mart"))
    IO.ingest_bronze(t.spark, attributes_csv(t), mart, "attributes", start="1995-01-01")
    return IO.read_bronze(t.spark, mart, "attributes")


@query("runs_written_and_read", RUN_KINDS, "SELECT * FROM preds")
def _(t):
    path = place(t, "runs")
    IO.write_runs(t.predictions().select(*RUN_KINDS), path)
    return IO.read_history(t.spark, path)


@query("table_replaced", LABEL_KINDS, "SELECT * FROM labels WHERE label = 1")
def _(t):
    path = place(t, "table")
    IO.write_table(t.stored("labels"), path)
    IO.write_table(t.stored("labels").where("label = 1"), path)
    return t.spark.read.parquet(path)


@query("preview_exported", LABEL_KINDS, "SELECT * FROM labels ORDER BY loan_id LIMIT 1000")
def _(t):
    path = place(t, "preview")
    IO.write_preview(t.stored("labels"), path, 1000, ["loan_id"])
    return t.spark.read.option("header", True).csv(path)


# --- gates, tables of a training run -----------------------------------------------------
_gated = ["Age", "Occupation", "Annual_Income", "debt_to_income", "fe_1", "fe_20"]


@query("null_gate", "feature:s n_null:i", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_null FROM features" for c in _gated
) + ") WHERE n_null > 0")
def _(t):
    try:
        impute.assert_no_nulls(t.stored("features").select(*_gated))
    except impute.NullValuesError as found:
        counts = found.columns
    else:
        counts = {}
    return t.spark.createDataFrame(list(counts.items()), "feature string, n_null long")


query("feature_distributions", "feature:s kind:s bin:s lower:f upper:f share:f", (
    f"SELECT feature, 'numeric' AS kind, bin, lower, upper, share FROM ({QUERIES['numeric_distribution'].sql}) UNION ALL "
    f"SELECT feature, 'categorical', category, NULL, NULL, share FROM ({QUERIES['category_distribution'].sql})"
))(lambda t: drift.feature_distributions(reference(t), _dist, ["Occupation", "Age_group"]).withColumns({
    c: F.when(F.abs(c) != F.lit(float("inf")), F.col(c)) for c in ("lower", "upper")}))

_after_train = ["accuracy", "precision", "recall", "f1"]
query("metrics_per_split", "model_version:s split:s auc:f gini:f accuracy:f precision:f recall:f f1:f", (
    "SELECT * REPLACE (" + ", ".join(f"CASE WHEN split <> 'train' THEN {c} END AS {c}" for c in _after_train)
    + f") FROM ({QUERIES['classification_metrics'].sql})"
))(lambda t: training_plan.split_metrics(t.stored("scored").select(
    "model_version", "split", "label", F.col("model_predictions").alias("score"), F.lit(None).cast("string").alias("oot_part"))))


# --- splits and samples by membership ----------------------------------------------------
def twice(t, pick) -> tuple[DataFrame, DataFrame]:
    """The result on the stored rows and on the same rows laid out otherwise."""
    rows = t.stored("labels")
    return pick(rows), pick(rows.repartition(7, "label", "loan_id"))


def membership(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows, distinct keys, and rows that the other layout gave alike."""
    both = first.intersectAll(second)
    return first.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*S.ID_COLS).alias("n_keys")).join(
        both.agg(F.count(F.lit(1)).alias("n_alike")))


_same = "n:i n_keys:i n_alike:i"
_all_keys = "SELECT count(*) AS n, count(DISTINCT (Customer_ID, loan_id, snapshot_date)) AS n_keys, count(*) AS n_alike FROM labels"
query("stratified_split_members", _same, _all_keys)(
    lambda t: membership(*twice(t, lambda d: splits.stratified_split(d, S.ID_COLS).select(*S.ID_COLS, "label", "split"))))
query("random_split_members", _same, _all_keys)(
    lambda t: membership(*twice(t, lambda d: splits.random_split(d, S.ID_COLS).select(*S.ID_COLS, "split"))))
query("reference_sample_members", "n:i n_keys:i n_alike:i n_known:i", (
    "SELECT least(5000, count(*)) AS n, n AS n_keys, n AS n_alike, n AS n_known FROM labels"
))(lambda t: _known(t, *twice(t, lambda d: projection.sample_rows(d, S.ID_COLS, 5000, 42))))


def _known(t, first: DataFrame, second: DataFrame) -> DataFrame:
    known = first.join(t.stored("labels"), S.ID_COLS, "left_semi").agg(F.count(F.lit(1)).alias("n_known"))
    return membership(first, second).join(known)


# --- both versions; versions that differ -------------------------------------------------
query("data_stats_per_version", "split:s n_rows:i bad_rate:f", (
    "SELECT model_version || '/' || split AS split, count(*) AS n_rows, round(avg(label), 4) AS bad_rate FROM scored GROUP BY ALL"
))(lambda t: training_plan.data_stats(t.scored().withColumn("split", F.concat_ws("/", "model_version", "split"))))
query("version_agreement_on_scores", "aligned:b", (
    "SELECT bool_and(coalesce(lo = hi, true)) AS aligned FROM "
    "(SELECT min(psi_score) AS lo, max(psi_score) AS hi FROM psi GROUP BY snapshot_date)"
))(lambda t: monitor.version_agreement(drift.prediction_psi(
    projection.between_dates(t.stored("predictions"), *REF_RANGE),
    projection.between_dates(t.stored("predictions"), O.RUN_START, None)), "psi_score"))


# --- one-hot vectors value by value, vocabularies of any size, repeated keys ----------------
def bits(vector: str):
    """A vector of zeros and ones as text."""
    return F.array_join(F.transform(vector_to_array(F.col(vector)), lambda x: x.cast("int").cast("string")), "")


def bits_sql(base: str, columns: dict[str, str]) -> str:
    """The same in SQL: labels by falling count, ties by text; nothing is set for null."""
    ranked = ", ".join(
        f"r_{c} AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS i, count(*) OVER () AS size FROM "
        f"(SELECT {c} AS v, count(*) AS n FROM base WHERE {c} IS NOT NULL GROUP BY 1))" for c in columns)
    texts = ", ".join(
        f"CASE WHEN r_{c}.v IS NULL THEN repeat('0', CAST((SELECT max(size) FROM r_{c}) AS INTEGER)) "
        f"ELSE repeat('0', CAST(r_{c}.i AS INTEGER)) || '1' || repeat('0', CAST(r_{c}.size - 1 - r_{c}.i AS INTEGER)) END AS {name}"
        for c, name in columns.items())
    joins = " ".join(f"LEFT JOIN r_{c} ON base.{c} = r_{c}.v" for c in columns)
    return f"WITH base AS ({base}), {ranked} SELECT loan_id, {texts} FROM base {joins}"


_financial = {c: c.lower() for c in gold.FINANCIAL_CATEGORIES}
query("financial_vectors", "loan_id:s " + " ".join(f"{n}:s" for n in _financial.values()), bits_sql(
    "SELECT loan_id, coalesce(Credit_Mix, 'Unknown') AS Credit_Mix, coalesce(Payment_Behaviour, 'Unknown') AS Payment_Behaviour, "
    "Min_Text AS Payment_of_Min_Amount FROM detail_training WHERE Monthly_Balance IS NOT NULL", _financial,
))(lambda t: gold.financial_features(t.detail_training()).select("loan_id", *[bits(f"{c}_vec").alias(n) for c, n in _financial.items()]))

_digits = "try_cast(nullif(regexp_replace(Age, '[^0-9]', '', 'g'), '') AS INTEGER)"
query("attribute_vectors", "loan_id:s age_bits:s occ_bits:s", bits_sql(
    f"SELECT loan_id, {O.band('age', *S.AGE_BANDS_FEATURE)} AS Age_group, CASE WHEN Occupation IS NULL THEN 'Unknown' "
    "WHEN n < 0.05 * count(*) OVER () THEN 'Other' ELSE Occupation END AS Occ_clean FROM (SELECT loan_id, Occupation, "
    "count(*) OVER (PARTITION BY Occupation) AS n, coalesce(v, CAST(trunc(quantile_cont(CAST(v AS DOUBLE), 0.5) OVER ()) AS INTEGER)) AS age "
    f"FROM (SELECT loan_id, Occupation, CASE WHEN {_digits} BETWEEN 18 AND 100 THEN {_digits} END AS v FROM att_training))",
    {"Age_group": "age_bits", "Occ_clean": "occ_bits"},
))(lambda t: gold.attribute_features(t.attribute_training()).select(
    "loan_id", bits("Age_group_vec").alias("age_bits"), bits("Occ_clean_vec").alias("occ_bits")))


@query("category_index", "loan_id:s snapshot_date:d name_index:i", (
    "SELECT loan_id, snapshot_date, dense_rank() OVER (ORDER BY loan_id) - 1 AS name_index FROM labels"
))
def _(t):
    rows = t.stored("labels").select("loan_id", "snapshot_date", F.col("loan_id").alias("name"))
    return encode.index_category(rows, "name", encode.fit_dictionary(rows, "name"))


@query("list_entries", "Customer_ID:s index:i n:i", (
    "WITH items AS (SELECT Customer_ID, lower(replace(trim(v), ' ', '_')) AS v FROM (SELECT Customer_ID, "
    "unnest(string_split(replace(Type_of_Loan, ' and ', ','), ',')) AS v FROM fin_raw) WHERE trim(v) <> ''), "
    "names AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS index FROM (SELECT DISTINCT v FROM items)) "
    "SELECT Customer_ID, index, count(*) AS n FROM items JOIN names USING (v) GROUP BY ALL"
))
def _(t):
    raw = t.stored("raw_financials")
    known = encode.fit_dictionary(raw, F.explode(C.list_keys("Type_of_Loan")))
    return encode.list_entries(raw, ["Customer_ID"], "Type_of_Loan", known)


def one_hot_key(t) -> DataFrame:
    """The label rows, a third of them under one key."""
    hot = F.pmod(F.crc32(F.col("loan_id")), F.lit(3)) == 0
    return t.stored("labels").withColumn("key", F.when(hot, F.lit("hot")).otherwise(F.col("loan_id")))


query("stratified_split_repeated_keys", "label:i split:s n:i", QUERIES["stratified_split"].sql)(
    lambda t: splits.stratified_split(one_hot_key(t), ["key"]).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n")))
query("sample_rows_repeated_keys", _same, "SELECT least(5000, count(*)) AS n, n AS n_keys, n AS n_alike FROM labels")(
    lambda t: membership(*[projection.sample_rows(d, ["key"], 5000, 42).drop("key") for d in (
        one_hot_key(t), one_hot_key(t).repartition(7, "label", "loan_id"))]))
