"""Queries on tables: sources and sinks, typing, features, labels, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.scalar import inf_to_null, numeric, safe_divide
from ..operators import models as M
from ..operators import prepare as P
from ..operators.audit import column_defaults
from ..operators.confusion import Policy, join_policy
from ..operators.splits import semi_by_split
from ..schema import (
    BASE,
    BILL_RATIOS,
    BILLS,
    DELAY_FEATURES,
    ENGINEERED,
    PAY_STATUS,
    PAYMENTS,
    PUBLIC_FEATURES,
    TARGET,
)
from ..sources import readers, sinks
from . import views as V
from .registry import query, rounded, scratch
from .sql import (
    BASE_LIST,
    divide,
    feature_select,
    label_case,
    q,
    r,
    unpivot_sql,
)

KEY = "applicant_id"


def rounded_features(names: list[str]) -> str:
    whole = set(DELAY_FEATURES)
    return ", ".join(f"{n if n in whole else r(n)} as {n}" for n in names)


@query("applicants_view", q("select * from applicants"))
def applicants_view(spark, sf):
    """One row per applicant from customers, orders and line items, in one plan."""
    return V.build_applicants(spark, sf)


# --- sources and sinks -----------------------------------------------------------------------

CUSTOMER_SCHEMA = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


@query("src_csv", "select * from customer")
def src_csv(spark, sf):
    path = scratch(spark, "customer-csv")
    sinks.sink_csv(V.table(spark, sf, "customer"), path)
    return readers.src_csv(spark, path, CUSTOMER_SCHEMA)


@query(
    "src_local",
    q(f"""select 'applicants.parquet' as dataset_name, 'local' as source, '{TARGET}' as target_column,
          'SEX, AGE, MARRIAGE, EDUCATION' as protected_attributes_available,
          count(*) as row_count from applicants"""),
)
def src_local(spark, sf):
    path = f"{scratch(spark, 'local')}/applicants.parquet"
    sinks.sink_parquet(V.applicants(spark, sf), path)
    df, about = readers.src_local(spark, path)
    return about.withColumn("row_count", df.agg(F.count("*")).scalar()).select(
        "dataset_name",
        "source",
        "target_column",
        F.array_join("protected_attributes_available", ", ").alias("protected_attributes_available"),
        "row_count",
    )


@query("src_detect", "select o_orderkey, o_custkey, o_orderstatus from orders")
def src_detect(spark, sf):
    folder = scratch(spark, "detect")
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.sink_parquet(V.table(spark, sf, "customer"), f"{folder}/a.parquet")
    sinks.sink_csv(orders, f"{folder}/b.csv")
    return readers.src_csv(spark, readers.src_detect(spark, folder), orders.schema)


@query("src_concat_cols", q(f"select applicant_id, {BASE_LIST}, {TARGET} from applicants"))
def src_concat_cols(spark, sf):
    table = V.applicants(spark, sf)
    return readers.src_concat_cols(table.select(KEY, *BASE), table.select(KEY, TARGET), KEY)


@query("sink_csv", q("select applicant_id, y_true, y_proba from scored"))
def sink_csv(spark, sf):
    path = scratch(spark, "scored-csv")
    table = V.scored(spark, sf).select(KEY, "y_true", "y_proba")
    sinks.sink_csv(table, path)
    return readers.src_csv(spark, path, table.schema)


@query(
    "sink_json",
    q("""select sex_code, count(*) as n, sum(y_true)::bigint as defaults, max(y_proba) as highest
         from scored group by sex_code"""),
)
def sink_json(spark, sf):
    """A nested summary document per group, written and read back."""
    path = scratch(spark, "summary-json")
    groups = V.scored(spark, sf).groupBy(F.col("SEX").alias("sex_code")).agg(
        F.count("*").alias("n"), F.sum("y_true").alias("defaults"), F.max("y_proba").alias("highest")
    )
    document = groups.select(
        "sex_code",
        sinks.nested_summary(
            counts=F.struct("n", "defaults"), scores=F.struct("highest")
        ).alias("summary"),
    )
    sinks.sink_json(document, path)
    back = spark.read.schema(document.schema).json(path)
    return back.select("sex_code", "summary.counts.n", "summary.counts.defaults",
                       "summary.scores.highest")


@query(
    "sink_predictions",
    q("""select applicant_id, y_true, y_proba, model_name, split from models
         where split = 'test'"""),
)
def sink_predictions(spark, sf):
    path = scratch(spark, "predictions")
    table = V.scored_models(spark, sf).select(KEY, "y_true", "y_proba", "model_name", "split")
    sinks.sink_predictions(table, path)
    return readers.read_predictions(spark, path).where("split = 'test'").select(*table.columns)


_CHANGED = f"case when applicant_id % 50 = 0 then 1 - {TARGET} else {TARGET} end"


@query(
    "scan_predictions",
    q(f"""select count(m.applicant_id) as rows, count(e.applicant_id) as expected_rows,
            count(*) filter (m.applicant_id is null or e.applicant_id is null
                             or m.y_true is distinct from e.y_true) as mismatches,
            count(*) filter (m.applicant_id is null or e.applicant_id is null
                             or m.y_true is distinct from e.y_true) = 0
              and count(m.applicant_id) > 0 as accepted
          from (select * from models where model_name = 'delay_rule') m
          full join (select applicant_id, {_CHANGED} as y_true from applicants) e
          using (applicant_id)"""),
)
def scan_predictions(spark, sf):
    export = V.scored_models(spark, sf).where("model_name = 'delay_rule'")
    expected = V.applicants(spark, sf).selectExpr(KEY, f"{_CHANGED} as y_true")
    return readers.scan_predictions(export, expected, KEY)


@query("sink_model")
def sink_model(spark, sf):
    """A saved and reloaded model scores every row as the fitted one did."""
    table, features = V.features(spark, sf), ["PAY_0", "MaxPaymentDelay", "AvgBillToLimitRatio"]
    model = M.train_logistic(table, features)
    path = scratch(spark, "model")
    model.save(path)
    again = M.Scored.load(path, features)
    both = model(table.select(KEY, *features)).withColumnRenamed("probability", "fitted")
    return again(both).select(
        KEY, "fitted", F.col("probability").alias("reloaded")
    ).withColumn("difference", F.abs(F.col("fitted") - F.col("reloaded")))


# --- header, typing, target ------------------------------------------------------------------


def raw_upload(spark: SparkSession, sf: str) -> DataFrame:
    """The applicant table as it may arrive: coded header with stray blanks, text cells, gaps."""
    table = V.applicants(spark, sf)
    limit = F.when(F.col(KEY) % 11 == 0, "n/a").otherwise(F.col("LIMIT_BAL").cast("string"))
    target = F.when(F.col(KEY) % 13 != 0, F.col(TARGET).cast("string"))
    columns = [F.col(KEY), limit.alias(" x1 ")]
    columns += [F.col(n).cast("string").alias(f"X{i}") for i, n in enumerate(BASE[1:], start=2)]
    return table.select(*columns, target.alias("default payment.next-month"))


_MONEY = {"LIMIT_BAL", *BILLS, *PAYMENTS}
_PARSED = "case when applicant_id % 11 = 0 then null else LIMIT_BAL end"
_DOUBLES = ", ".join(f"{n}::double as {n}" for n in BASE[1:])


@query(
    "norm_columns",
    q(f"""select applicant_id,
            case when applicant_id % 11 = 0 then null else LIMIT_BAL end as LIMIT_BAL,
            {', '.join(BASE[1:])},
            case when applicant_id % 13 <> 0 then {TARGET} end as {TARGET} from applicants"""),
)
def norm_columns(spark, sf):
    named = P.norm_columns(raw_upload(spark, sf))
    whole = [n for n in [*BASE, TARGET] if n not in _MONEY]
    return named.withColumns(
        {**{n: numeric(n) for n in _MONEY}, **{n: F.col(n).cast("int") for n in whole}}
    )


@query(
    "adapt_schema",
    q(
        f"""select applicant_id, LIMIT_BAL, {BASE_LIST.removeprefix('LIMIT_BAL, ')}, {TARGET},
            {', '.join(f'{r(n)} as {n}' for n in ENGINEERED if n not in DELAY_FEATURES)},
            RecentPaymentDelay, MaxPaymentDelay, NumDelayedMonths
            from (select *, {feature_select()} from upload)""",
        f"""upload as (select applicant_id, {_PARSED} as LIMIT_BAL, {_DOUBLES}, {TARGET}
            from applicants where applicant_id % 13 <> 0)""",
    ),
)
def adapt_schema(spark, sf):
    return rounded(P.adapt_schema(raw_upload(spark, sf)))


@query("coerce_numeric", q(f"select applicant_id, {_PARSED} as LIMIT_BAL from applicants"))
def coerce_numeric(spark, sf):
    named = P.norm_columns(raw_upload(spark, sf)).select(KEY, "LIMIT_BAL")
    return P.coerce_numeric(named, ["LIMIT_BAL", "NOT_THERE"])


_ANSWERS = ["'Yes'", "'No'", "'Y'", "'N'", "'1'", "'0'", "'unknown'", "null"]
_ANSWER = "case applicant_id % 8 " + " ".join(
    f"when {i} then {a}" for i, a in enumerate(_ANSWERS)
) + " end"


@query(
    "norm_target",
    q(f"""select applicant_id, cast(case when applicant_id % 8 in (0, 2, 4) then 1 else 0 end
          as integer) as {TARGET} from applicants"""),
)
def norm_target(spark, sf):
    return P.norm_target(V.applicants(spark, sf).selectExpr(KEY, f"{_ANSWER} as {TARGET}"))


@query(
    "safe_divide",
    q(f"""select applicant_id, {r(divide('BILL_AMT1', 'LIMIT_BAL'))} as by_limit,
          {r(divide('PAY_AMT6', 'BILL_AMT6'))} as by_bill,
          {r(divide('BILL_AMT6', 'LIMIT_BAL'))} as missing_top from applicants"""),
)
def safe_divide_query(spark, sf):
    return rounded(
        V.applicants(spark, sf).select(
            KEY,
            safe_divide("BILL_AMT1", "LIMIT_BAL").alias("by_limit"),
            safe_divide("PAY_AMT6", "BILL_AMT6").alias("by_bill"),
            safe_divide("BILL_AMT6", "LIMIT_BAL").alias("missing_top"),
        )
    )


def _feature_query(name: str, columns: list[str]) -> None:
    sql = q(f"select applicant_id, {rounded_features(columns)} from features")
    query(name, sql)(
        lambda spark, sf: rounded(P.add_features(V.applicants(spark, sf)).select(KEY, *columns))
    )


_feature_query("bill_to_limit", BILL_RATIOS)
_feature_query("avg_bill_to_limit", ["AvgBillToLimitRatio"])
_feature_query("avg_pay_to_bill", ["AvgPaymentToBillRatio"])
_feature_query("delay_features", DELAY_FEATURES)
_feature_query("avg_amounts", ["AvgBillAmount", "AvgPaymentAmount", "PaymentToLimitRatio"])


_ODD = "case applicant_id % 4 when 0 then {inf} when 1 then -{inf} when 2 then null else BILL_AMT1 end"


@query(
    "inf_to_null",
    q("""select applicant_id, case when applicant_id % 4 = 3 then BILL_AMT1 end as value
         from applicants"""),
)
def inf_to_null_query(spark, sf):
    odd = _ODD.format(inf="double('infinity')")
    return V.applicants(spark, sf).selectExpr(KEY, f"{odd} as odd").select(
        KEY, inf_to_null("odd").alias("value")
    )


@query(
    "date_parts",
    """select o_orderkey, year(o_orderdate)::integer as LoanStartYear,
       month(o_orderdate)::integer as LoanStartMonth, quarter(o_orderdate)::integer as LoanStartQuarter
       from orders""",
)
def date_parts(spark, sf):
    orders = V.table(spark, sf, "orders")
    return P.date_parts(orders.select("o_orderkey", F.col("o_orderdate").alias("LoanStartDate")))


@query(
    "prepare_table",
    q(f"""select applicant_id, LIMIT_BAL, {BASE_LIST.removeprefix('LIMIT_BAL, ')},
          cast(case when applicant_id % 8 in (0, 2, 4) then 1 else 0 end as integer) as {TARGET},
          {rounded_features(ENGINEERED)} from features"""),
)
def prepare_table(spark, sf):
    table = V.applicants(spark, sf).drop(TARGET)
    answers = table.selectExpr("*", f"{_ANSWER} as {TARGET}", f"{KEY} as ID", f"{KEY} as LoanID")
    prepared = rounded(P.prepare_table(answers))
    whole = [*PAY_STATUS, "RecentPaymentDelay", "MaxPaymentDelay"]
    return prepared.withColumns({n: F.col(n).cast("int") for n in whole})


@query(
    "select_features",
    q(f"""select applicant_id, {', '.join(n for n in PUBLIC_FEATURES if n in BASE)},
          {rounded_features(ENGINEERED)}, {TARGET} from features"""),
)
def select_features(spark, sf):
    return rounded(P.select_features(V.features(spark, sf), "application_public", [KEY]))


# --- labels ----------------------------------------------------------------------------------

_CODES = ["'1'", "'2'", "'1.0'", "'2.9'", "'abc'", "'9'", "null", "'Infinity'"]
_CODE = "case applicant_id % 8 " + " ".join(f"when {i} then {c}" for i, c in enumerate(_CODES)) + " end"
_KNOWN = ("case applicant_id % 8 when 0 then 1 when 1 then 2 when 2 then 1 when 3 then 2 "
          "when 5 then 9 end")
_SHOWN = ("case applicant_id % 8 when 0 then '1' when 1 then '2' when 2 then '1' when 3 then '2' "
          "when 4 then 'abc' when 5 then '9' when 6 then 'None' else 'Infinity' end")
_GROUP = f"(case {_KNOWN} when 1 then 'Male' when 2 then 'Female' else 'Unknown' end)"


@query(
    "sex_code",
    q(f"""select applicant_id, cast({_KNOWN} as integer) as sex_code, {_GROUP} as sex_group
          from applicants"""),
)
def sex_code(spark, sf):
    text = V.applicants(spark, sf).selectExpr(KEY, f"{_CODE} as code")
    return text.select(KEY, L.sex_code("code").alias("sex_code"),
                       L.sex_group("code").alias("sex_group"))


@query(
    "group_label",
    q(f"""select applicant_id, {_GROUP} || ' (SEX=' || {_SHOWN} || ')' as "group"
          from applicants"""),
)
def group_label(spark, sf):
    text = V.applicants(spark, sf).selectExpr(KEY, f"{_CODE} as code")
    return text.select(KEY, L.group_label("code").alias("group"))


_LABELS = "case applicant_id % 4 when 0 then 'SEX=1' when 1 then 'Women SEX= 2' when 2 then 'SEX2' else 'all' end"


@query(
    "legacy_group_parse",
    q("""select applicant_id,
          cast(case applicant_id % 4 when 0 then 1 when 1 then 2 when 2 then 2 end as integer)
            as sex_code,
          case applicant_id % 4 when 0 then 'Male' when 3 then 'Unknown' else 'Female' end
            as sex_group,
          case applicant_id % 4 when 0 then 'Male (SEX=1)' when 3 then 'Unknown (SEX=<NA>)'
            else 'Female (SEX=2)' end as "group" from applicants"""),
)
def legacy_group_parse(spark, sf):
    text = V.applicants(spark, sf).selectExpr(KEY, f"{_LABELS} as label")
    parsed = text.select(KEY, L.code_in_label("label").alias("sex_code"))
    return parsed.select(KEY, "sex_code", L.sex_group("sex_code").alias("sex_group"),
                         L.group_label("sex_code", missing="<NA>").alias("group"))


@query(
    "age_group",
    q("""select applicant_id, case when a < 0 or a is null then 'unknown' when a < 26 then '18-25'
          when a < 36 then '26-35' when a < 46 then '36-45' when a < 56 then '46-55'
          when a < 66 then '56-65' else '66+' end as age_group
         from (select applicant_id, case when applicant_id % 17 = 0 then null
                 when applicant_id % 19 = 0 then -5 else AGE end as a from applicants)"""),
)
def age_group(spark, sf):
    ages = V.applicants(spark, sf).selectExpr(
        KEY,
        "case when applicant_id % 17 = 0 then null when applicant_id % 19 = 0 then '-5' "
        "else cast(AGE as string) end as age",
    )
    return ages.select(KEY, L.age_group("age").alias("age_group"))


@query(
    "sex_group_lower",
    q("""select applicant_id, case when applicant_id % 17 = 0 then 'unknown' when SEX = 1
         then 'male' else 'female' end as sex_group from applicants"""),
)
def sex_group_lower(spark, sf):
    codes = V.applicants(spark, sf).withColumn("s", F.when(F.col(KEY) % 17 != 0, F.col("SEX")))
    return codes.select(KEY, L.sex_group_lower("s").alias("sex_group"))


@query(
    "categorical_codes",
    q("select applicant_id, "
      + ", ".join(f"cast({n} as varchar) as {n}" for n in P.STRING_CODES) + " from applicants"),
)
def categorical_codes(spark, sf):
    return P.categorical_codes(V.applicants(spark, sf)).select(KEY, *P.STRING_CODES)


@query(
    "risk_band",
    q("""select applicant_id, y_proba, case when y_proba < 0.30 then 'Low Risk'
         when y_proba <= 0.60 then 'Medium Risk' else 'High Risk' end as risk_band from scored"""),
)
def risk_band(spark, sf):
    return V.scored(spark, sf).select(KEY, "y_proba", L.risk_band("y_proba").alias("risk_band"))


@query(
    "recommendation",
    q("""select applicant_id,
           case when y_proba < 0.30 then 'Low predicted default risk / low review priority'
             when y_proba <= 0.60 then 'Manual review recommended'
             else 'High predicted default risk / strong review required' end as recommendation,
           case when y_proba >= 0.25 then 'Manual review recommended'
             else 'No manual review flag' end as review_flag from scored"""),
)
def recommendation(spark, sf):
    return V.scored(spark, sf).select(
        KEY,
        L.recommendation("y_proba").alias("recommendation"),
        L.review_flag("y_proba", 0.25).alias("review_flag"),
    )


_STATUS_CASE = " ".join(f"when {c} then '{t}'" for c, t in L.PAY_STATUS_LABELS.items())


@query(
    "pay_status_label",
    q(f"""select applicant_id, s as status, case s {_STATUS_CASE}
            else cast(s as varchar) || ' months delayed' end as label
          from (select applicant_id, cast(PAY_0 + (applicant_id % 3) * 2 as integer) as s
                from applicants)"""),
)
def pay_status_label(spark, sf):
    shifted = V.applicants(spark, sf).select(
        KEY, (F.col("PAY_0") + (F.col(KEY) % 3) * 2).cast("int").alias("status")
    )
    return shifted.withColumn("label", L.pay_status_label("status"))


MODEL_LABELS = {"delay_rule": "Delay rule, baseline", "history_rule": "Payment history"}


@query(
    "friendly_name",
    q("""select model_name, case model_name when 'delay_rule' then 'Delay rule, baseline'
           when 'history_rule' then 'Payment history' else 'Recent Rule' end as label,
           count(*) as n from models group by model_name"""),
)
def friendly_name(spark, sf):
    counts = V.scored_models(spark, sf).groupBy("model_name").agg(F.count("*").alias("n"))
    return counts.withColumn("label", L.friendly_name("model_name", MODEL_LABELS))


_TRANSFORMED = {
    "num__LIMIT_BAL": "LIMIT_BAL",
    "num__PAY_0": "PAY_0",
    "num__AvgBillAmount": "AvgBillAmount",
    "cat__SEX_1": "SEX",
    "cat__EDUCATION_2": "EDUCATION",
    "cat__OTHER_KIND": "AGE",
    "PAY_AMT1": "PAY_AMT1",
}


@query(
    "column_rename_features",
    q(
        f"""select feature, raw_feature,
              case when feature like 'cat__%' and raw_feature in ('SEX', 'EDUCATION', 'MARRIAGE')
                   then {label_case('raw_feature')} || ': ' ||
                        substr(feature, length(raw_feature) + 7)
                   when feature like 'cat__%' then replace(substr(feature, 6), '_', ' ')
                   else {label_case('raw_feature')} end as display_name,
              {r('avg(value)')} as mean_value
            from (select feature, value,
                    case when feature like 'cat__SEX%' then 'SEX'
                         when feature like 'cat__EDUCATION%' then 'EDUCATION'
                         when feature like 'num__%' or feature like 'cat__%'
                         then substr(feature, 6) else feature end as raw_feature
                  from {unpivot_sql('wide', [f'"{n}"' for n in _TRANSFORMED], []).replace("'\"", "'").replace("\"'", "'")})
            group by feature, raw_feature""",
        "wide as (select "
        + ", ".join(f'{c} as "{n}"' for n, c in _TRANSFORMED.items())
        + " from features)",
    ),
)
def column_rename_features(spark, sf):
    wide = V.features(spark, sf).select(
        *[F.col(c).cast("double").alias(n) for n, c in _TRANSFORMED.items()]
    )
    means = wide.unpivot([], list(_TRANSFORMED), "feature", "value").groupBy("feature").agg(
        F.avg("value").alias("mean_value")
    )
    return rounded(
        means.withColumns(
            {"raw_feature": L.raw_feature("feature"), "display_name": L.display_name("feature")}
        )
    )


# --- joins -----------------------------------------------------------------------------------


_MEANS = """(select model_name, split, count(*) as n, avg(y_proba) as mean_score from models
             group by model_name, split)"""


@query(
    "join_left_equi",
    q(f"""select m.model_name, m.split, m.n, {r('m.mean_score')} as mean_score,
            {r('d.difference')} as difference
          from {_MEANS} m left join
            (select model_name, max(case when split = 'test' then mean_score end)
                    - max(case when split = 'validation' then mean_score end) as difference
             from {_MEANS} where model_name <> 'recent_rule' group by model_name) d
          using (model_name)"""),
)
def join_left_equi(spark, sf):
    """Rows per model and split, with the model's difference of the two sides where it is known."""
    rows = V.scored_models(spark, sf).groupBy("model_name", "split").agg(
        F.count("*").alias("n"), F.avg("y_proba").alias("mean_score")
    )

    def side(name: str):
        return F.max(F.when(F.col("split") == name, F.col("mean_score")))

    known = rows.where("model_name <> 'recent_rule'").groupBy("model_name").agg(
        (side("test") - side("validation")).alias("difference")
    )
    return rounded(rows.join(known, "model_name", "left"))


@query(
    "join_index",
    q("""select applicant_id, y_true, y_proba, SEX, EDUCATION from models
         join (select applicant_id, EDUCATION from applicants) using (applicant_id)
         where model_name = 'delay_rule' and split = 'test'"""),
)
def join_index(spark, sf):
    """Protected attributes back onto scored test rows, by row id."""
    test = V.scored_models(spark, sf).where("model_name = 'delay_rule' and split = 'test'")
    people = V.applicants(spark, sf).select(KEY, "SEX", "EDUCATION")
    return test.select(KEY, "y_true", "y_proba").join(people, KEY)


@query(
    "join_semi",
    q(f"""select applicant_id, 'train' as side from applicants
          where applicant_id in (select applicant_id from models where split = 'validation')
          union all select applicant_id, 'test' from applicants
          where applicant_id not in (select applicant_id from models where split = 'validation')"""),
)
def join_semi(spark, sf):
    people = V.applicants(spark, sf).select(KEY)
    members = V.scored_models(spark, sf).where("split = 'validation'").select(KEY)
    inside = semi_by_split(people, members, [KEY], True).withColumn("side", F.lit("train"))
    outside = semi_by_split(people, members, [KEY], False).withColumn("side", F.lit("test"))
    return inside.unionByName(outside)


POLICIES = [
    Policy("delay_050", "delay_rule", 0.50, "Delay rule at 0.50"),
    Policy("delay_025", "delay_rule", 0.25, "Delay rule at 0.25"),
    Policy("history_050", "history_rule", 0.50, "History rule at 0.50"),
    Policy("recent_030", "recent_rule", 0.30, "Recent rule at 0.30"),
]
POLICY_VALUES = (
    "policies(policy, display_name, model_name, threshold) as (values "
    + ", ".join(
        f"('{p.name}', '{p.display_name}', '{p.model_name}', {p.threshold}::double)"
        for p in POLICIES
    )
    + ")"
)


@query(
    "join_policy",
    q("""select model_name, applicant_id, SEX, AGE, split, y_true, y_proba, policy, threshold,
           cast(y_proba >= threshold as integer) as predicted_high_risk
         from models join policies using (model_name)""", POLICY_VALUES),
)
def join_policy_query(spark, sf):
    return join_policy(V.scored_models(spark, sf), POLICIES)


@query(
    "applicant_row",
    q(f"""select applicant_id, LIMIT_BAL, {', '.join(PAY_STATUS)}, {r('AvgBillAmount')} as AvgBillAmount,
          {r('AvgBillToLimitRatio')} as AvgBillToLimitRatio,
          {r("(select quantile_cont(y_proba, 0.5) from scored)")} as y_proba from features"""),
)
def applicant_row(spark, sf):
    """Inputs to full rows; the score column, which no input has, takes its median."""
    table = V.applicants(spark, sf)
    defaults = column_defaults(V.scored(spark, sf), ["y_proba"], [])
    wanted = ["LIMIT_BAL", *PAY_STATUS, "AvgBillAmount", "AvgBillToLimitRatio", "y_proba"]
    rows = rounded(P.applicant_row(table.select(KEY, *BASE), defaults, wanted))
    return rows.withColumns({n: F.col(n).cast("int") for n in PAY_STATUS})


