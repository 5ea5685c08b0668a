"""Queries on scored rows: confusion, curves, grids, group audits, calibration, table audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import confusion as C
from ..operators import curves as R
from ..operators import fairness as G
from ..operators import mitigation as W
from ..operators.confusion import GRID, Policy
from ..operators.explain import attribution_long, group_attribution, linear_drivers
from ..operators.scenario import Scorecard, applicant_ratios
from ..operators.splits import sample_size_row
from ..schema import (
    BASE,
    BILLS,
    COVERAGE_BLOCKS,
    DIAGNOSTIC_FEATURES,
    INTERPRETABLE_FEATURES,
    PAY_STATUS,
    PAYMENTS,
    PUBLIC_FEATURES,
    TARGET,
)
from . import views as V
from .registry import query, rounded
from .sql import (
    FOUR_GAPS,
    counts_select,
    gaps_sql,
    grid_values,
    measure_select,
    q,
    quoted,
    r,
    ranks_sql,
    rate,
    row_mean,
    unpivot_sql,
)
from .tables import KEY, POLICIES, POLICY_VALUES

GROUP_COLUMNS = 'sex_code, sex_group, "group"'
GRID_CTE = f"grid(threshold) as (values {grid_values(GRID)})"
REPORT_NAMES = [*C.REPORT, "approval_support_rate", "predicted_default_rate"]
AS_HIGH_RISK = {"predicted_default_rate": "predicted_high_risk_rate"}


def delay_scores(spark, sf):
    return V.scored(spark, sf).withColumn("model_name", F.lit("delay_rule"))


def grouped(spark, sf):
    return G.with_sex_group(delay_scores(spark, sf))


def grouped_models(spark, sf):
    return G.with_sex_group(V.scored_models(spark, sf))


# --- one threshold, ranking, curves ----------------------------------------------------------


@query(
    "confusion",
    q(f"""select 0.5::double as threshold, {measure_select()}
          from (select {counts_select('0.5')} from scored)"""),
)
def confusion(spark, sf):
    return rounded(C.confusion(V.scored(spark, sf), 0.50))


@query(
    "confusion_lineitem",
    q(f"""select segment, 0.3::double as threshold, {measure_select()}
          from (select segment, {counts_select('0.3')} from line_scores group by segment)"""),
)
def confusion_lineitem(spark, sf):
    return rounded(C.confusion(V.line_scores(spark, sf), 0.30, ["segment"]))


def _report_sql(source: str, keys: list[str], threshold: float) -> str:
    by = "".join(f"{k}, " for k in keys)
    group = f"group by {', '.join(keys)}" if keys else ""
    join = f"join {ranks_sql(source, keys)} using ({', '.join(keys)})" if keys else (
        f"cross join {ranks_sql(source, keys)}"
    )
    return q(f"""select {by} {measure_select(REPORT_NAMES, AS_HIGH_RISK)},
                 {r('roc_auc')} as roc_auc, {r('pr_auc')} as pr_auc
                 from (select {by} {counts_select(str(threshold))} from {source} {group}) {join}""")


@query("classification_report", _report_sql("models", ["model_name", "split"], 0.5))
def classification_report(spark, sf):
    return rounded(C.classification_report(V.scored_models(spark, sf), 0.50, ["model_name", "split"]))


@query("classification_report_documents", _report_sql("document_scores", ["lang"], 0.1))
def classification_report_documents(spark, sf):
    return rounded(C.classification_report(V.document_scores(spark, sf), 0.10, ["lang"]))


@query("roc_auc", q(f"select {r('roc_auc')} as roc_auc from {ranks_sql('scored', [])}"))
def roc_auc(spark, sf):
    return rounded(R.roc_auc(V.scored(spark, sf)))


@query(
    "roc_auc_lineitem",
    q(f"""select segment, {r('roc_auc')} as roc_auc
          from {ranks_sql('line_scores', ['segment'])}"""),
)
def roc_auc_lineitem(spark, sf):
    return rounded(R.roc_auc(V.line_scores(spark, sf), ["segment"]))


@query("avg_precision", q(f"select {r('pr_auc')} as pr_auc from {ranks_sql('scored', [])}"))
def avg_precision(spark, sf):
    return rounded(R.avg_precision(V.scored(spark, sf)))


@query(
    "avg_precision_documents",
    q(f"select lang, {r('pr_auc')} as pr_auc from {ranks_sql('document_scores', ['lang'])}"),
)
def avg_precision_documents(spark, sf):
    return rounded(R.avg_precision(V.document_scores(spark, sf), ["lang"]))


@query(
    "pr_curve",
    q(
        f"""select model_name, y_proba as threshold, {r('tp::double / (tp + fp)')} as precision,
              {r('tp::double / p')} as recall from steps
            union all select distinct model_name, null, 1.0::double, 0.0::double from steps""",
        """steps as (
             select model_name, y_proba,
               sum(sum(y_true)) over (partition by model_name order by y_proba desc) as tp,
               sum(sum(1 - y_true)) over (partition by model_name order by y_proba desc) as fp,
               sum(sum(y_true)) over (partition by model_name) as p
             from models group by model_name, y_proba)""",
    ),
)
def pr_curve(spark, sf):
    return rounded(R.pr_curve(V.scored_models(spark, sf), ["model_name"]))


@query(
    "threshold_grid",
    q(f"""select model_name, split, threshold, {measure_select()}
          from (select model_name, split, threshold, {counts_select()}
                from models cross join grid group by model_name, split, threshold)""", GRID_CTE),
)
def threshold_grid(spark, sf):
    return rounded(C.threshold_grid(V.scored_models(spark, sf), ["model_name", "split"]))


@query(
    "join_cross_grid",
    q("""select segment, threshold, count(*) filter (y_proba >= threshold) as flagged,
           count(*) as n from line_scores cross join grid group by segment, threshold""", GRID_CTE),
)
def join_cross_grid(spark, sf):
    """Every row against every threshold, from counts per score level instead of a join."""
    counts = C.counts_at_thresholds(V.line_scores(spark, sf), GRID, ["segment"])
    return counts.select(
        "segment",
        "threshold",
        (F.col("tp") + F.col("fp")).alias("flagged"),
        sum((F.col(c) for c in ("fp", "tn", "fn")), F.col("tp")).alias("n"),
    )


# --- groups ----------------------------------------------------------------------------------

POLICY_COUNTS = f"""pcounts as (
  select policy, display_name, model_name, threshold, {GROUP_COLUMNS}, {counts_select()},
         sum(y_proba) as score_sum
  from models join policies using (model_name)
  group by policy, display_name, model_name, threshold, {GROUP_COLUMNS})"""


@query(
    "group_confusion",
    q(f"""select policy, threshold, {GROUP_COLUMNS}, tp + fp + tn + fn as n,
            tp as true_positives, fp as false_positives, tn as true_negatives,
            fn as false_negatives, {measure_select(['accuracy', 'precision', 'recall',
                                                    'false_positive_rate', 'false_negative_rate',
                                                    'specificity'])},
            {measure_select(['precision', 'recall', 'specificity'],
                            {'precision': 'positive_predictive_value',
                             'recall': 'true_positive_rate',
                             'specificity': 'true_negative_rate'})},
            {r(rate('tn', 'tn + fn'))} as negative_predictive_value
          from pcounts""", POLICY_VALUES, POLICY_COUNTS),
)
def group_confusion(spark, sf):
    return rounded(G.group_confusion(grouped_models(spark, sf), POLICIES))


@query(
    "group_outcome",
    q(f"""select policy, display_name, threshold, {GROUP_COLUMNS}, tp + fp + tn + fn as n,
            {r(rate('tp + fn', 'tp + fp + tn + fn'))} as actual_default_rate,
            {r(rate('score_sum', 'tp + fp + tn + fn'))} as mean_predicted_default_probability,
            {r(rate('tp + fp', 'tp + fp + tn + fn'))} as predicted_high_risk_rate,
            {r('1 - ' + rate('tp + fp', 'tp + fp + tn + fn'))} as predicted_low_risk_rate,
            {r('1 - ' + rate('tp + fp', 'tp + fp + tn + fn'))} as approval_support_rate,
            g.* exclude (policy)
          from pcounts join {gaps_sql('pcounts', ['policy'])} g using (policy)""",
      POLICY_VALUES, POLICY_COUNTS),
)
def group_outcome(spark, sf):
    return rounded(G.group_outcome(grouped_models(spark, sf), POLICIES))


@query(
    "fairness_gaps",
    q(f"select * from {gaps_sql('pcounts', ['policy', 'threshold'])}", POLICY_VALUES, POLICY_COUNTS),
)
def fairness_gaps(spark, sf):
    return rounded(G.policy_gaps(grouped_models(spark, sf), POLICIES))


@query(
    "fairness_metrics4",
    q(f"select * from {gaps_sql('pcounts', ['policy', 'model_name', 'threshold'], FOUR_GAPS)}",
      POLICY_VALUES, POLICY_COUNTS),
)
def fairness_metrics4(spark, sf):
    return rounded(G.fairness_metrics4(V.scored_models(spark, sf), POLICIES))


AGE_BAND = """case when AGE < 26 then '18-25' when AGE < 36 then '26-35' when AGE < 46 then '36-45'
  when AGE < 56 then '46-55' when AGE < 66 then '56-65' else '66+' end"""


@query(
    "fairness_ext",
    q(f"select * from {gaps_sql('ecounts', ['model_name', 'attribute'], FOUR_GAPS)}",
      f"""ecounts as (
        select model_name, attribute, value, {counts_select('0.5')} from (
          select model_name, y_true, y_proba, 'SEX' as attribute,
                 case SEX when 1 then 'male' else 'female' end as value from models
          union all select model_name, y_true, y_proba, 'AGE_GROUP', {AGE_BAND} from models)
        group by model_name, attribute, value)"""),
)
def fairness_ext(spark, sf):
    return rounded(G.fairness_ext(V.scored_models(spark, sf)))


TWO_POLICIES = [Policy("history_baseline", "history_rule", 0.50),
                Policy("history_tuned", "history_rule", 0.20)]


@query(
    "fairness_dnn",
    q(f"select * from {gaps_sql('c', ['policy', 'model_name', 'threshold'], FOUR_GAPS)}",
      f"""c as (select policy, model_name, threshold, SEX, {counts_select()}
        from models join (values ('history_baseline', 'history_rule', 0.5::double),
                                 ('history_tuned', 'history_rule', 0.2::double))
          p(policy, model_name, threshold) using (model_name)
        group by policy, model_name, threshold, SEX)"""),
)
def fairness_dnn(spark, sf):
    """The four gaps of a second model at its baseline and its tuned threshold."""
    return rounded(G.fairness_metrics4(V.scored_models(spark, sf), TWO_POLICIES))


def _before_after_select() -> str:
    parts = [
        f"{r(f'max(case when threshold = {t} then {n} end)')} as {n}_{word}"
        for n in FOUR_GAPS for word, t in (("before", 0.5), ("after", 0.25))
    ]
    parts += [
        r(f"max(case when threshold = 0.25 then {n} end) - max(case when threshold = 0.5 then {n} end)")
        + f" as {n}_change"
        for n in FOUR_GAPS
    ]
    return ", ".join(parts)


def _exact_gaps_sql(counts: str, keys: list[str]) -> str:
    """The four gaps before rounding, for differences of gaps."""
    by = ", ".join(keys)
    made = ", ".join(f"{e} as {n}" for n, e in FOUR_GAPS.items())
    return f"""(select {by}, {made} from (select {by},
        {rate('tn + fn', 'tp + fp + tn + fn')} as approved, {rate('tn', 'tn + fp')} as approved_good,
        {rate('fn', 'fn + tp')} as approved_bad from {counts}) group by {by})"""


@query(
    "fairness_before_after",
    q(f"select {_before_after_select()} from {_exact_gaps_sql('c', ['threshold'])}",
      f"""c as (select threshold, SEX, {counts_select()} from scored
        cross join (values (0.5::double), (0.25::double)) t(threshold) group by threshold, SEX)"""),
)
def fairness_before_after(spark, sf):
    before, after = POLICIES[:2]
    return rounded(G.fairness_before_after(delay_scores(spark, sf), before, after))


@query(
    "threshold_frontier",
    q(
        f"""select threshold, {measure_select(REPORT_NAMES, AS_HIGH_RISK)},
              {r('roc_auc')} as roc_auc, {r('pr_auc')} as pr_auc, g.* exclude (threshold)
            from (select threshold, sum(tp) as tp, sum(fp) as fp, sum(tn) as tn, sum(fn) as fn
                  from c group by threshold)
            join {gaps_sql('c', ['threshold'])} g using (threshold)
            cross join {ranks_sql('scored', [])}""",
        GRID_CTE,
        f"""c as (select threshold, "group", {counts_select()} from scored cross join grid
            group by threshold, "group")""",
    ),
)
def threshold_frontier(spark, sf):
    return rounded(G.threshold_frontier(grouped(spark, sf)))


_BINS = ", ".join(
    f"({i}, '{low:.2f}-{high:.2f}', {low}::double, {high}::double)"
    for i, (low, high) in enumerate(zip(G.CALIBRATION_EDGES, G.CALIBRATION_EDGES[1:]))
)
CALIBRATION_ROWS = f"""select g.sex_code, g.sex_group, g."group", bin, count(s.y_true) as n,
    avg(s.y_proba) as mean_predicted_probability, avg(s.y_true) as observed_default_rate,
    avg(s.y_true) - avg(s.y_proba) as calibration_gap
  from (select distinct {GROUP_COLUMNS} from scored) g
  cross join (values {_BINS}) b(position, bin, low, high)
  left join scored s on s."group" = g."group"
    and s.y_proba >= low and (s.y_proba < high or (position = 9 and s.y_proba = high))
  group by all"""


@query(
    "calibration_bins",
    q(f"""select {GROUP_COLUMNS}, bin, n, {r('mean_predicted_probability')} as
            mean_predicted_probability, {r('observed_default_rate')} as observed_default_rate,
            {r('calibration_gap')} as calibration_gap from ({CALIBRATION_ROWS})"""),
)
def calibration_bins(spark, sf):
    return rounded(G.calibration_bins(grouped(spark, sf)))


@query(
    "max_calibration_gap",
    q(f"""select sex_group, {r('max(abs(calibration_gap))')} as largest_absolute_calibration_gap
          from ({CALIBRATION_ROWS}) where n > 0 group by sex_group"""),
)
def max_calibration_gap(spark, sf):
    return rounded(G.max_calibration_gap(G.calibration_bins(grouped(spark, sf)), ["sex_group"]))


# --- table audits ----------------------------------------------------------------------------


def _coverage_sql() -> str:
    parts = []
    for block, names in COVERAGE_BLOCKS.items():
        here = [n for n in names if n not in ("PAY_3", "AvgBillAmount")]
        filled = " + ".join(f"count({n})" for n in here)
        parts.append(
            f"select {quoted(block)} as block, {quoted(', '.join(names))} as columns, "
            f"{quoted(', '.join(here))} as available_columns, {len(here)}::bigint as available_count, "
            f"{len(names)}::bigint as expected_count, "
            f"{r(f'({filled})::double / (count(*) * {len(here)})')} as fill_rate from features"
        )
    return q(" union all ".join(parts))


@query("coverage_audit", _coverage_sql())
def coverage_audit(spark, sf):
    """Coverage of a table that lacks two of the expected columns."""
    return rounded(A.coverage_audit(V.features(spark, sf).drop("PAY_3", "AvgBillAmount")))


def _profile_sql(source: str, names: list[str]) -> str:
    return q(
        " union all ".join(
            f"""select '{n}' as "column", count(*) - count({n}) as missing_values,
                count(distinct {n}) + (case when count(*) > count({n}) then 1 else 0 end)
                  as unique_values from {source}"""
            for n in names
        )
    )


@query("profile", _profile_sql("applicants", [*BASE, TARGET]))
def profile(spark, sf):
    return A.profile(V.applicants(spark, sf), [*BASE, TARGET])


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
                 "l_returnflag", "l_linestatus"]


@query("profile_lineitem", _profile_sql("lineitem", _LINE_COLUMNS))
def profile_lineitem(spark, sf):
    return A.profile(V.table(spark, sf, "lineitem"), _LINE_COLUMNS)


@query(
    "value_counts",
    q(f"select SEX, {TARGET}, count(*) as n from applicants group by SEX, {TARGET}"),
)
def value_counts(spark, sf):
    return A.value_counts(V.applicants(spark, sf), "SEX", TARGET)


@query("value_counts_events", "select event_type, count(*) as n from events group by event_type")
def value_counts_events(spark, sf):
    return A.value_counts(V.table(spark, sf, "events"), "event_type")


@query(
    "column_defaults",
    q("select " + ", ".join(
        f"{r(f'coalesce(quantile_cont({n}::double, 0.5), 0)')} as {n}" for n in PUBLIC_FEATURES)
      + """, (select o_orderpriority from orders where o_orderpriority is not null
              group by 1 order by count(*) desc, 1 limit 1) as priority from features"""),
)
def column_defaults(spark, sf):
    """Medians of the features, and the most frequent value of a text column."""
    priority = V.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority"))
    medians = A.column_defaults(V.features(spark, sf), PUBLIC_FEATURES, [])
    modes = A.column_modes(priority, ["priority"]).select("mode").scalar()
    return rounded(medians.withColumn("priority", modes))


@query(
    "class_weights",
    q(f"""select cast(row_number() over (order by first_at) - 1 as integer) as position, weight
          from (select weight, min(i) as first_at from (
            select unnest([1, 2, 3, 4, 5, 7, 10, w]::double[]) as weight, generate_subscripts(
              [1, 2, 3, 4, 5, 7, 10, w]::double[], 1) as i
            from (select round(count(*) filter ({TARGET} = 0)::double
                               / count(*) filter ({TARGET} = 1), 4) as w from applicants))
            group by weight)"""),
)
def class_weights(spark, sf):
    return W.class_weights(V.applicants(spark, sf))


@query(
    "balanced_weights",
    q(f"""select {TARGET}, count(*) as n,
            {r('(sum(count(*)) over ())::double / (count(*) over () * count(*))')} as weight
          from applicants group by {TARGET}"""),
)
def balanced_weights(spark, sf):
    return rounded(W.balanced_weights(V.applicants(spark, sf)))


@query(
    "reweigh",
    q(f"""select applicant_id, {r('''(count(*) over (partition by SEX))::double
              * (count(*) over (partition by Default_Flag))
              / (count(*) over ()) / (count(*) over (partition by SEX, Default_Flag))''')} as weight
          from applicants"""),
)
def reweigh(spark, sf):
    table = V.applicants(spark, sf).select(KEY, "SEX", TARGET)
    return rounded(W.reweigh(table).select(KEY, "weight"))


@query(
    "reweigh_binary",
    q(f"""select applicant_id, {r('''(count(*) over (partition by side))::double
              * (count(*) over (partition by Default_Flag))
              / (count(*) over ()) / (count(*) over (partition by side, Default_Flag))''')} as weight
          from (select *, EDUCATION = 1 as side from applicants)"""),
)
def reweigh_binary(spark, sf):
    table = V.applicants(spark, sf).select(KEY, "EDUCATION", TARGET)
    return rounded(W.reweigh_binary(table, "EDUCATION").select(KEY, "weight"))


def corr_sql(x: str, y: str) -> str:
    both = f"({x}) is not null and ({y}) is not null"
    return (
        f"case when count(*) filter ({both}) > 0 and var_pop({x}) filter ({both}) > 0 "
        f"and var_pop({y}) filter ({both}) > 0 "
        f"then covar_pop(({y})::double, ({x})::double) / sqrt(var_pop({x}) filter ({both}) * "
        f"var_pop({y}) filter ({both})) end"
    )


@query(
    "feature_target_corr",
    q(f"""select feature, {r(corr_sql('value', TARGET))} as correlation_with_target
          from {unpivot_sql('features', DIAGNOSTIC_FEATURES, [TARGET])} group by feature"""),
)
def feature_target_corr(spark, sf):
    return rounded(A.feature_target_corr(V.features(spark, sf), DIAGNOSTIC_FEATURES))


@query(
    "feature_target_corr_lineitem",
    f"""select feature, {r(corr_sql('value', 'y'))} as correlation_with_target from (
          select 'l_quantity' as feature, l_quantity as value, cast(l_returnflag = 'R' as int) as y
          from lineitem
          union all select 'l_discount', l_discount, cast(l_returnflag = 'R' as int) from lineitem
          union all select 'l_extendedprice', l_extendedprice, cast(l_returnflag = 'R' as int)
          from lineitem) group by feature""",
)
def feature_target_corr_lineitem(spark, sf):
    lines = V.table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(
        A.feature_target_corr(lines, ["l_quantity", "l_discount", "l_extendedprice"], "y")
    )


def information_sql(source: str, features: list[str], target: str, name: str) -> str:
    """Mutual information on decile bins, missing values at the median."""
    edges = ", ".join(f"0.{i}" for i in range(1, A.MI_BINS))
    return f"""(select feature, greatest(0.0, sum(part)) as {name} from (
      select feature, n::double / (sum(n) over f) * ln(n::double * (sum(n) over f)
               / ((sum(n) over (partition by feature, code))
                  * (sum(n) over (partition by feature, y)))) as part
      from (select feature, code, y, count(*) as n from (
        select t.feature, t.{target} as y,
               len(list_filter(e.edges, lambda x: x <= coalesce(t.value, e.middle, 0))) as code
        from {unpivot_sql(source, features, [target])} t join (
          select feature, quantile_cont(value, [{edges}]) as edges,
                 quantile_cont(value, 0.5) as middle
          from {unpivot_sql(source, features, [])} group by feature) e using (feature))
        group by feature, code, y)
      window f as (partition by feature)) group by feature)"""


def _digamma_sql(n: str) -> str:
    z = f"(({n})::double + 8)"
    steps = " - ".join(f"1 / (({n})::double + {i})" for i in range(8))
    return f"(ln({z}) - 1 / (2 * {z}) - 1 / (12 * {z}**2) + 1 / (120 * {z}**4) - 1 / (252 * {z}**6) - {steps})"


_LAGS = [s for s in range(-A.NEIGHBOURS, A.NEIGHBOURS + 1) if s]


def _side(s: int, column: str) -> str:
    return f"{'lag' if s < 0 else 'lead'}({column}, {abs(s)}) over d"


#: Mutual information with the k-th neighbour of the class, each interval counted directly.
NEIGHBOUR_CTES = [
    f"""tall as (select t.feature, t.{TARGET} as y, coalesce(t.value, e.middle, 0) as value
        from {unpivot_sql('features', DIAGNOSTIC_FEATURES, [TARGET])} t join (
          select feature, quantile_cont(value, 0.5) as middle from {unpivot_sql('features', DIAGNOSTIC_FEATURES, [])}
          group by feature) e using (feature) where t.{TARGET} is not null)""",
    """levels as (select feature, y, value, count(*) as n, sum(count(*)) over (partition by feature, y) as class_n
        from tall group by feature, y, value)""",
    f"""lists as (select *, least({A.NEIGHBOURS}, class_n - 1) as k, list_sort(list_filter([
          {', '.join(f"{{'gap': abs({_side(s, 'value')} - value), 'value': {_side(s, 'value')}, 'n': {_side(s, 'n')}}}" for s in _LAGS)}],
          lambda c: c.value is not null)) as near
        from levels where class_n > 1 window d as (partition by feature, y order by value))""",
    """gaps as (select *, case when n <= k then list_filter(near, lambda c, i:
          n - 1 + list_sum(list_transform(near[1:i], lambda x: x.n)) >= k)[1].gap end as gap from lists)""",
    """bounds as (select *, coalesce(list_filter(near, lambda c: c.gap = gaps.gap and c.value < gaps.value)[1].value, value - gap) as low,
          coalesce(list_filter(near, lambda c: c.gap = gaps.gap and c.value > gaps.value)[1].value, value + gap) as high from gaps)""",
    """merged as (select feature, value, sum(n) as n from lists group by feature, value)""",
    """counted as (select b.feature, b.y, b.value, any_value(b.n) as n, any_value(b.k) as k, any_value(b.class_n) as class_n, sum(a.n) as m
        from bounds b join merged a on a.feature = b.feature
          and (case when b.gap is null then a.value = b.value else a.value > b.low and a.value < b.high end)
        group by b.feature, b.y, b.value)""",
    f"""information as (select feature, greatest(0.0, {_digamma_sql('sum(n)')}
          + sum(n * ({_digamma_sql('k')} - {_digamma_sql('class_n')} - {_digamma_sql('m')})) / sum(n)) as mutual_information
        from counted group by feature)""",
]


@query(
    "mutual_info_target",
    q(f"select feature, {r('mutual_information')} as mutual_information from information", *NEIGHBOUR_CTES),
)
def mutual_info_target(spark, sf):
    """Nearest-neighbour mutual information of every feature with the target."""
    return rounded(A.mutual_info_target(V.features(spark, sf), DIAGNOSTIC_FEATURES))


@query(
    "binned_information",
    q(f"""select feature, {r('mutual_information')} as mutual_information
          from {information_sql('features', DIAGNOSTIC_FEATURES, TARGET, 'mutual_information')}"""),
)
def binned_information(spark, sf):
    return rounded(A.binned_information(V.features(spark, sf), DIAGNOSTIC_FEATURES))


@query(
    "mi_review_flag",
    q(f"""select feature, {r('mutual_information')} as mutual_information,
            {r('review_threshold')} as review_threshold
          from (select *, quantile_cont(mutual_information, 0.95) over () as review_threshold from information)
          where mutual_information >= review_threshold""", *NEIGHBOUR_CTES),
)
def mi_review_flag(spark, sf):
    scores = A.mutual_info_target(V.features(spark, sf), DIAGNOSTIC_FEATURES)
    return rounded(A.mi_review_flag(scores))


_ASSOC_MI = information_sql("tagged", INTERPRETABLE_FEATURES, "in_b", "information")
_POOLED = "sqrt((coalesce(va, 0) + coalesce(vb, 0)) / 2)"
_SMD = f"case when {_POOLED} > 0 then (mb - ma) / {_POOLED} else 0.0::double end"


@query(
    "feature_group_assoc",
    q(
        f"""select feature, 1 as group_a_sex_code, 2 as group_b_sex_code, {r('ma')} as group_a_mean,
              {r('mb')} as group_b_mean, {r('qa')} as group_a_median, {r('qb')} as group_b_median,
              {r('na')} as group_a_missing_rate, {r('nb')} as group_b_missing_rate,
              {r(_SMD)} as standardized_mean_difference,
              {r(f'abs({_SMD})')} as absolute_standardized_mean_difference,
              {r('coalesce(c, 0)')} as correlation_with_sex_binary,
              {r('information')} as mutual_information_with_sex
            from (select feature,
                    avg(value) filter (in_b = 0) as ma, avg(value) filter (in_b = 1) as mb,
                    var_samp(value) filter (in_b = 0) as va, var_samp(value) filter (in_b = 1) as vb,
                    quantile_cont(value, 0.5) filter (in_b = 0) as qa,
                    quantile_cont(value, 0.5) filter (in_b = 1) as qb,
                    (count(*) filter (in_b = 0 and value is null))::double
                      / count(*) filter (in_b = 0) as na,
                    (count(*) filter (in_b = 1 and value is null))::double
                      / count(*) filter (in_b = 1) as nb,
                    {corr_sql('value', 'in_b')} as c
                  from {unpivot_sql('tagged', INTERPRETABLE_FEATURES, ['in_b'])} group by feature)
            join {_ASSOC_MI} using (feature)""",
        "tagged as (select *, cast(SEX = 2 as integer) as in_b from features)",
    ),
)
def feature_group_assoc(spark, sf):
    return rounded(A.feature_group_assoc(V.features(spark, sf), INTERPRETABLE_FEATURES))


# --- reshapes and small reports --------------------------------------------------------------

_SHOWN = ["PAY_0", "MaxPaymentDelay", "AvgBillToLimitRatio", "LIMIT_BAL"]


@query(
    "shap_group_agg",
    q(f"""select sex_code, sex_group, "group", feature, {r('a')} as mean_abs_attribution,
            {r('m')} as mean_attribution, n,
            {r('''max(case when sex_code = 1 then a end) over (partition by feature)
                - max(case when sex_code = 2 then a end) over (partition by feature)''')}
              as mean_abs_difference
          from (select sex_code, sex_group, "group", feature, avg(abs(value)) as a,
                       avg(value) as m, count(*) as n
                from (select * from {unpivot_sql('centred', _SHOWN,
                                                 ['sex_code', 'sex_group', '"group"'])})
                group by all)""",
      "centred as (select s.sex_code, s.sex_group, s.\"group\", " + ", ".join(
          f"f.{n} - (select avg({n}) from features) as {n}" for n in _SHOWN)
      + " from features f join scored s using (applicant_id))"),
)
def shap_group_agg(spark, sf):
    """Attributions of a score with unit weights, compared between the groups."""
    card = Scorecard(0.0, {n: 1.0 for n in _SHOWN})
    table = G.with_sex_group(V.features(spark, sf))
    long = attribution_long(linear_drivers(table, card, KEY, G.GROUP), KEY, G.GROUP)
    return rounded(group_attribution(long, G.GROUP))


@query(
    "sample_size_row",
    q(
        f"""select 'delay_rule' as model_name, count(*) filter (split = 'train') as train_rows,
              count(*) filter (split = 'test') as test_rows, {len(PUBLIC_FEATURES)} as feature_count
            from (select case when split = 'test' then 'test' else 'train' end as split
                  from models where model_name = 'delay_rule')""",
    ),
)
def sample_size(spark, sf):
    split = V.scored_models(spark, sf).where("model_name = 'delay_rule'").withColumn(
        "split", F.when(F.col("split") == "test", "test").otherwise("train")
    )
    return sample_size_row(split, PUBLIC_FEATURES, "delay_rule")


def _lookup_sql(metric: str) -> str:
    return ", ".join(
        f"max(case when policy = '{p}' and sex_code = {c} then {metric} end) as {p}_{w}_{metric}"
        for p in ("delay_050", "delay_025") for c, w in ((1, "male"), (2, "female"))
    )


@query(
    "metric_lookup",
    q(f"""select {_lookup_sql('false_negative_rate')} from (
            select policy, sex_code, {r(rate('fn', 'fn + tp'))} as false_negative_rate
            from pcounts)""", POLICY_VALUES, POLICY_COUNTS),
)
def metric_lookup(spark, sf):
    errors = G.group_confusion(grouped_models(spark, sf), POLICIES)
    wanted = ["delay_050", "delay_025"]
    return rounded(G.metric_lookup(errors, "false_negative_rate", wanted, {1: "male", 2: "female"}))


@query(
    "reshape_pivot",
    q(f"""select policy, {', '.join(
        r(f"max(case when sex_group = '{g}' then recall end)") + f' as "{g}"'
        for g in ('Female', 'Male', 'Unknown'))}
          from (select policy, sex_group, {rate('tp', 'tp + fn')} as recall from pcounts)
          group by policy""", POLICY_VALUES, POLICY_COUNTS),
)
def reshape_pivot(spark, sf):
    errors = G.group_confusion(grouped_models(spark, sf), POLICIES)
    return rounded(
        errors.groupBy("policy").pivot("sex_group", ["Female", "Male", "Unknown"]).agg(
            F.first("recall")
        )
    )


_MELTED = list(FOUR_GAPS)


@query(
    "reshape_unpivot",
    q(f"""select policy, metric, value from (
            select policy, {', '.join(_MELTED)} from
              {gaps_sql('pcounts', ['policy', 'model_name', 'threshold'], FOUR_GAPS)})
          unpivot (value for metric in ({', '.join(_MELTED)}))""", POLICY_VALUES, POLICY_COUNTS),
)
def reshape_unpivot(spark, sf):
    gaps = G.fairness_metrics4(V.scored_models(spark, sf), POLICIES)
    return rounded(gaps.unpivot(["policy"], _MELTED, "metric", "value"))


_BILL, _PAID = f"coalesce({row_mean(BILLS)}, 0)", f"coalesce({row_mean(PAYMENTS)}, 0)"
RATIOS_SQL = {
    "average_bill": _BILL,
    "average_payment": _PAID,
    "utilization": f"{_BILL} / greatest(LIMIT_BAL, 1.0)",
    "payment_ratio": f"case when {_BILL} <> 0 then {_PAID} / {_BILL} else 0.0::double end",
    "max_delay": f"coalesce(greatest({', '.join(PAY_STATUS)}), 0)",
}


@query(
    "applicant_ratios",
    q("select applicant_id, " + ", ".join(
        f"{e if n == 'max_delay' else r(e)} as {n}" for n, e in RATIOS_SQL.items())
      + " from applicants"),
)
def ratios(spark, sf):
    made = applicant_ratios()
    return rounded(V.applicants(spark, sf).withColumns(made).select(KEY, *made))


@query(
    "threshold_optimizer",
    q(
        f"""select SEX, i / 1000.0 as fpr, {r('y')} as tpr, {r('own')} as own_tpr, t as high_threshold,
              case when share > 0 then t1 else t end as low_threshold, {r('share')} as low_share,
              {r('case when own > y then (own - y) / (own - i / 1000.0) else 0 end')} as ignored, {r('accuracy')} as accuracy
            from (select own.*, best.y, best.accuracy from own join best using (i))""",
        """levels as (select SEX, y_proba as t, count(*) filter (where y_true = 1) as pos, count(*) filter (where y_true = 0) as neg
            from scored where SEX is not null and y_proba is not null and y_true in (0, 1) group by SEX, y_proba)""",
        """points as (select SEX, t, sum(pos) over down as tp, sum(neg) over down as fp, sum(pos) over (partition by SEX) as p,
              sum(neg) over (partition by SEX) as n from levels window down as (partition by SEX order by t desc))""",
        """tops as (select SEX, fp, max(tp) as tp, min(t) as t, any_value(p) as p, any_value(n) as n from points where p > 0 and n > 0
              group by SEX, fp union all select SEX, 0, 0, null, max(p), max(n) from points group by SEX
              having max(p) > 0 and max(n) > 0 and min(fp) > 0)""",
        """hull as (select * from tops b where not exists (select 1 from tops a, tops c where a.SEX = b.SEX and c.SEX = b.SEX
              and a.fp < b.fp and b.fp < c.fp and (b.tp - a.tp) * (c.fp - a.fp) < (c.tp - a.tp) * (b.fp - a.fp)))""",
        """edges as (select *, lead(fp) over s as fp1, lead(tp) over s as tp1, lead(t) over s as t1 from hull
              window s as (partition by SEX order by fp))""",
        """own as (select *, (tp + share * coalesce(tp1 - tp, 0)) / p as own from (
              select *, case when i * n = 1000 * fp then 0.0::double else (i * n - 1000 * fp) / (1000.0::double * (fp1 - fp)) end as share
              from edges, range(1001) g(i) where i * n >= 1000 * fp and (fp1 is null or i * n < 1000 * fp1)))""",
        """best as (select * from (select i, min(own) as y,
              (sum(p) * min(own) + sum(n) * (1 - i / 1000.0)) / (sum(p) + sum(n)) as accuracy from own group by i)
              order by round(accuracy, 9) desc, i limit 1)""",
    ),
)
def threshold_optimizer(spark, sf):
    """Randomised rules that give both sexes the same error rates."""
    return rounded(W.equalised_odds(V.scored(spark, sf)))


@query(
    "matched_thresholds",
    q(
        f"""select c.SEX, c.threshold, {r('c.tpr')} as tpr, {r('c.fpr')} as fpr,
              {r('b.odds_gap')} as odds_gap, c.tp, c.fp, c.tn, c.fn
            from choices c join (
              select anchor, max(gap) as odds_gap from choices group by anchor
              order by odds_gap, sum(tp + tn) desc, anchor limit 1) b using (anchor)""",
        GRID_CTE,
        f"""points as (select *, {rate('tp', 'tp + fn')} as tpr, {rate('fp', 'fp + tn')} as fpr
            from (select SEX, threshold, {counts_select()} from scored cross join grid
                  group by SEX, threshold))""",
        """choices as (select * from (
             select p.*, a.threshold as anchor,
               round(greatest(abs(p.tpr - a.tpr), abs(p.fpr - a.fpr)), 9) as gap,
               row_number() over (partition by a.threshold, p.SEX
                 order by round(greatest(abs(p.tpr - a.tpr), abs(p.fpr - a.fpr)), 9),
                          p.tp + p.tn desc, p.threshold) as place
             from points p join points a on a.SEX = 1 and (p.SEX <> 1 or p.threshold = a.threshold))
           where place = 1)""",
    ),
)
def matched_thresholds(spark, sf):
    return rounded(W.matched_thresholds(V.scored(spark, sf)))

