"""The applicant table and score tables derived from the order tables.

One customer is one applicant, the six latest orders are the billing months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import count_positive
from ..operators.prepare import add_features
from ..schema import BILLS, PAY_STATUS, PAYMENTS, TARGET
from .registry import scratch

# Rule scores, in ten-thousandths: start, per month of recent delay, per delayed month.
# Whole numbers keep the scores equal on every engine, with many ties.
RULES = {
    "delay_rule": (1500, 900, 300),
    "history_rule": (900, 500, 800),
    "recent_rule": (2600, 1300, 0),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple, str] = {}


def _file_state(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    """Size and time of the given tables, so that changed tables are never read from a copy."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    states = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        status = path.getFileSystem(conf).getFileStatus(path)
        states.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    return "|".join(states)


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once to the shared folder and read from there by every query.

    The audits pass over the applicants several times; they read a written table with only the
    columns they need instead of joining the order tables anew for each pass.
    """
    state = _file_state(spark, sf_dir, ("customer", "orders", "lineitem"))
    key = (spark.sparkContext.applicationId, name, state)
    if key not in _STORED:
        path = scratch(spark, name)
        build(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "applicants", build_applicants)


def build_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders meet their line items on the order key, then go once to the customer key.

    The rank filter cuts each map task's rows to six per customer before that shuffle, so a
    customer with very many orders does not fill one task.
    """
    price = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).otherwise(0.0)
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum(price), 2).alias("paid"),
        F.max(F.to_date("l_shipdate")).alias("ship"),
    )
    orders = table(spark, sf_dir, "orders")
    days = F.coalesce(F.datediff("ship", F.to_date("o_orderdate")), F.lit(0))
    latest = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    months = (
        orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        .withColumn("slot", F.row_number().over(latest))
        .where("slot <= 6")
        .select(
            "o_custkey",
            "slot",
            "o_orderstatus",
            F.least(F.lit(8), F.floor(F.abs(days) / 250.0) - 2).cast("int").alias("pay"),
            F.col("o_totalprice").alias("bill"),
            F.coalesce("paid", F.lit(0.0)).alias("paid"),
        )
    )

    def in_slot(slot: int, value: str, name: str):
        return F.expr(f"max(case when slot = {slot} then {value} end) as {name}")

    history = months.groupBy("o_custkey").agg(
        *[in_slot(k, "pay", name) for k, name in enumerate(PAY_STATUS, 1)],
        *[in_slot(k, "bill", name) for k, name in enumerate(BILLS, 1)],
        *[in_slot(k, "paid", name) for k, name in enumerate(PAYMENTS, 1)],
        in_slot(1, "o_orderstatus", "status"),
    )
    customer = table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    limit = F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.round(F.col("c_acctbal") * 50, 2))
    late = (F.coalesce("PAY_0", F.lit(-2)) >= 2) & (F.col("status") != "P")
    closed = (F.col("status") == "F") & (key % 7 == 0)
    return customer.join(history, customer["c_custkey"] == history["o_custkey"], "left").select(
        key.alias("applicant_id"),
        limit.alias("LIMIT_BAL"),
        (1 + nation % 2).cast("int").alias("SEX"),
        (1 + nation % 4).cast("int").alias("EDUCATION"),
        (1 + key % 3).cast("int").alias("MARRIAGE"),
        (21 + key % 59).cast("int").alias("AGE"),
        *PAY_STATUS,
        *BILLS,
        *PAYMENTS,
        F.when(late | closed, 1).otherwise(0).alias(TARGET),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The applicants with their engineered columns."""
    return stored(
        spark, sf_dir, "features", lambda spark, sf_dir: add_features(applicants(spark, sf_dir))
    )


def rule_score(start: int, per_recent: int, per_month: int):
    points = start + per_recent * F.coalesce("PAY_0", F.lit(-2)) + per_month * count_positive(PAY_STATUS)
    return F.greatest(F.lit(0), F.least(F.lit(10000), points)) / F.lit(10000.0)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score per applicant, with the true outcome and the protected attribute."""
    return applicants(spark, sf_dir).select(
        "applicant_id",
        "SEX",
        "AGE",
        F.col(TARGET).alias("y_true"),
        rule_score(*RULES["delay_rule"]).alias("y_proba"),
    )


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every applicant under every rule: ``model_name, split, y_true, y_proba``.

    About a fifth of the applicants are the test side, by hash of their id.
    """
    scores = F.array(
        *[
            F.struct(F.lit(name).alias("model_name"), rule_score(*rule).alias("y_proba"))
            for name, rule in RULES.items()
        ]
    )
    is_test = F.md5(F.col("applicant_id").cast("string")) < "33"
    return (
        applicants(spark, sf_dir)
        .withColumn("s", F.explode(scores))
        .select(
            "applicant_id",
            "SEX",
            "AGE",
            F.when(is_test, "test").otherwise("validation").alias("split"),
            F.col(TARGET).alias("y_true"),
            "s.model_name",
            "s.y_proba",
        )
    )


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large scored table: every line item, scored by its discount and tax."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        F.round(5 * F.col("l_discount") + 5 * F.col("l_tax"), 4).alias("y_proba"),
        F.col("l_linestatus").alias("segment"),
    )


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, scored by their length."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        "lang",
        F.col("quality").alias("y_true"),
        (F.col("n_chars") / (F.col("n_chars") + F.lit(10000.0))).alias("y_proba"),
    )
