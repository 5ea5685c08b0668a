"""All registered queries, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fairness as G
from ..operators.confusion import Policy
from . import choices, jobs, scores, tables, views  # noqa: F401
from .registry import QUERIES, SQL, query, rounded
from .sql import GAPS, counts_select, gaps_sql, measure_select, q

HEADLINE = [Policy("at_050", "delay_rule", 0.50), Policy("at_025", "delay_rule", 0.25)]
ERRORS = ["accuracy", "recall", "false_positive_rate", "false_negative_rate"]


@query(
    "headline",
    q(
        f"""select policy, threshold, sex_group, tp + fp + tn + fn as n, {measure_select(ERRORS)},
              g.* exclude (policy)
            from c join {gaps_sql('c', ['policy'])} g using (policy)""",
        f"""c as (select policy, threshold, sex_group, {counts_select()} from scored
            cross join (values ('at_050', 0.5::double), ('at_025', 0.25::double)) p(policy, threshold)
            group by policy, threshold, sex_group)""",
    ),
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the order tables to group error rates and fairness gaps at two thresholds, one plan."""
    people = views.build_applicants(spark, sf_dir)
    scored = G.with_sex_group(
        people.select(
            "SEX",
            F.col("Default_Flag").alias("y_true"),
            views.rule_score(*views.RULES["delay_rule"]).alias("y_proba"),
            F.lit("delay_rule").alias("model_name"),
        )
    )
    rows = G.group_confusion(scored, HEADLINE).select("policy", "threshold", "sex_group", "n", *ERRORS)
    gaps = G.policy_gaps(scored, HEADLINE).select("policy", *GAPS)
    return rounded(rows.join(gaps, "policy"))
