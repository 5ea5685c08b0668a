"""Queries on choices: rules, candidates, rankings, set operations, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import confusion as C
from ..operators import selection as S
from ..operators import splits as P
from ..operators.curves import ranking_metrics
from ..operators.models import at_half
from ..operators.ordering import exact_quantiles
from ..schema import BASE, PUBLIC_FEATURES, TARGET
from . import views as V
from .registry import query, rounded
from .scores import GRID_CTE, corr_sql
from .sql import (
    counts_select,
    hash_sql,
    measures_sql,
    q,
    quoted,
    r,
    ranks_sql,
    signature_sql,
    unpivot_sql,
)
from .tables import KEY

PUBLIC_BASE = [n for n in PUBLIC_FEATURES if n in BASE]
CANDIDATE = ["model_name"]

# --- rules and candidates --------------------------------------------------------------------

EXACT = ", ".join(f"{e} as {n}" for n, e in measures_sql().items())
VALIDATION_GRID = f"""vgrid as (select model_name, threshold, {EXACT} from (
  select model_name, threshold, {counts_select()} from models cross join grid
  where split = 'validation' group by model_name, threshold))"""
TEST_GRID = VALIDATION_GRID.replace("vgrid", "tgrid").replace("'validation'", "'test'")
_WHOLE = {"true_positives", "false_positives", "true_negatives", "false_negatives", "expected_cost"}
ROUNDED = ", ".join(f"{n if n in _WHOLE else r(n)} as {n}" for n in measures_sql())


def validation_grid(spark, sf):
    return C.threshold_grid(V.scored_models(spark, sf).where("split = 'validation'"), CANDIDATE)


def test_grid(spark, sf):
    return C.threshold_grid(V.scored_models(spark, sf).where("split = 'test'"), CANDIDATE)


def _order_sql(rule: str) -> str:
    return ", ".join(
        f"{o[1:]} desc" if o.startswith("-") else o for o in S.RULES[rule][1]
    ) + ", threshold"


def rule_sql(rule: str) -> str:
    floor = S.RULES[rule][0]
    where = "" if floor is None else f"where precision >= {floor}"
    return f"""(select *, {quoted(rule)} as selection_rule from vgrid {where}
      qualify row_number() over (partition by model_name order by {_order_sql(rule)}) = 1)"""


def _rule_query(name: str, rule: str) -> None:
    sql = q(f"select model_name, threshold, {ROUNDED}, selection_rule from {rule_sql(rule)}",
            GRID_CTE, VALIDATION_GRID)
    query(name, sql)(
        lambda spark, sf: rounded(S.select_rule(validation_grid(spark, sf), rule, CANDIDATE))
    )


_rule_query("select_rule_a", S.RULE_A)
_rule_query("select_rule_b", S.RULE_B)
_rule_query("select_rule_c", S.RULE_C)
_rule_query("select_rule_d", S.RULE_D)
_rule_query("select_rule_e", S.RULE_E)

_RULE_NAMES = ", ".join(f"({quoted(rule)})" for rule in S.RULES)


@query(
    "selection_summary",
    q(f"""select model_name, selection_rule, s.threshold is not null as available, s.threshold,
            {ROUNDED}
          from (select distinct model_name from vgrid) cross join (values {_RULE_NAMES}) v(selection_rule)
          left join ({' union all '.join(f'select * from {rule_sql(rule)}' for rule in S.RULES)}) s
            using (model_name, selection_rule)""", GRID_CTE, VALIDATION_GRID),
)
def selection_summary(spark, sf):
    return rounded(S.selection_summary(validation_grid(spark, sf), CANDIDATE))


PREFERRED = f"""preferred as (
  select *, selection_rule <> {quoted(S.RULE_A)} as fallback_used
  from (select * from {rule_sql(S.RULE_A)}
        union all select * from {rule_sql(S.RULE_B)} b
        where b.model_name not in (select model_name from {rule_sql(S.RULE_A)})))"""


@query(
    "select_preferred",
    q(f"select model_name, threshold, {ROUNDED}, selection_rule, fallback_used from preferred",
      GRID_CTE, VALIDATION_GRID, PREFERRED),
)
def select_preferred(spark, sf):
    return rounded(S.select_preferred(validation_grid(spark, sf), CANDIDATE))


CANDIDATES = f"""candidates as (
  select p.*, a.pr_auc as validation_pr_auc, model_name = 'recent_rule' as resampled,
         case model_name when 'delay_rule' then 1 when 'history_rule' then 2 else 3 end as position
  from preferred p join {ranks_sql("(select * from models where split = 'validation')",
                                   ['model_name'])} a using (model_name))"""
_CHOSEN = """(select * from candidates where not resampled
  order by (not fallback_used and precision >= 0.50) desc,
    case when not fallback_used and precision >= 0.50 then recall else f2 end desc,
    case when not fallback_used and precision >= 0.50 then f2 else recall end desc,
    validation_pr_auc desc, position limit 1)"""


def candidates(spark, sf):
    validation = V.scored_models(spark, sf).where("split = 'validation'")
    preferred = S.select_preferred(C.threshold_grid(validation, CANDIDATE), CANDIDATE)
    areas = ranking_metrics(validation, CANDIDATE).select(
        "model_name", F.col("pr_auc").alias("validation_pr_auc")
    )
    place = F.when(F.col("model_name") == "delay_rule", 1).when(
        F.col("model_name") == "history_rule", 2
    ).otherwise(3)
    return preferred.join(areas, "model_name").withColumns(
        {"resampled": F.col("model_name") == "recent_rule", "position": place}
    )


@query(
    "choose_policy",
    q(f"""select model_name, threshold, selection_rule, fallback_used, {r('precision')} as precision,
            {r('recall')} as recall, {r('f2')} as f2, {r('validation_pr_auc')} as validation_pr_auc
          from {_CHOSEN}""", GRID_CTE, VALIDATION_GRID, PREFERRED, CANDIDATES),
)
def choose_policy(spark, sf):
    chosen = S.choose_policy(candidates(spark, sf))
    return rounded(
        chosen.select("model_name", "threshold", "selection_rule", "fallback_used", "precision",
                      "recall", "f2", "validation_pr_auc")
    )


@query(
    "choose_experiment",
    q(f"""select model_name as source_experiment, {r('pr_auc')} as validation_pr_auc
          from {ranks_sql("(select * from models where split = 'validation')", ['model_name'])}
          order by pr_auc desc limit 1"""),
)
def choose_experiment(spark, sf):
    validation = V.scored_models(spark, sf).where("split = 'validation'")
    areas = ranking_metrics(validation, CANDIDATE)
    return rounded(S.choose_experiment(areas.withColumnRenamed("pr_auc", "validation_pr_auc")))


_RECORD = ["precision", "recall", "f2"]


@query(
    "policy_record",
    q(f"""select 'recall_optimized' as policy_name, c.model_name as source_experiment,
            c.threshold as selected_threshold, selection_rule, fallback_used,
            'validation' as selection_split, 'untouched_test' as evaluation_split,
            {', '.join(f'{r(f"c.{n}")} as validation_{n}' for n in _RECORD)},
            {', '.join(f'{r(f"t.{n}")} as test_{n}' for n in _RECORD)}
          from {_CHOSEN} c join tgrid t on t.model_name = c.model_name and t.threshold = c.threshold
          where c.threshold between 0 and 1""",
      GRID_CTE, VALIDATION_GRID, TEST_GRID, PREFERRED, CANDIDATES),
)
def policy_record(spark, sf):
    chosen = S.choose_policy(candidates(spark, sf))
    test = test_grid(spark, sf).select(
        "model_name", "threshold", *[F.col(n).alias(f"test_{n}") for n in _RECORD]
    )
    joined = chosen.join(test, ["model_name", "threshold"])
    records = S.valid_records(S.policy_record(joined, "recall_optimized", _RECORD, _RECORD))
    return rounded(
        records.select(
            *[c for c in records.columns if not c.endswith("_metrics")],
            *[F.col(f"validation_metrics.{n}").alias(f"validation_{n}") for n in _RECORD],
            *[F.col(f"test_metrics.{n}").alias(f"test_{n}") for n in _RECORD],
        )
    )


_HALF = f"""half as (select model_name, {EXACT}, roc_auc, pr_auc from
  (select model_name, {counts_select('0.5')} from models group by model_name)
  join {ranks_sql('models', ['model_name'])} using (model_name))"""


@query(
    "model_ranking",
    q(f"""select model_name, {r('accuracy')} as accuracy, {r('roc_auc')} as roc_auc,
            cast(row_number() over (order by roc_auc desc, accuracy desc) as integer) as place
          from half""", _HALF),
)
def model_ranking(spark, sf):
    """Models by area, then accuracy, with their place (a handful of rows)."""
    ranked = S.model_ranking(at_half(V.scored_models(spark, sf))).select(
        "model_name", "accuracy", "roc_auc"
    )
    listed = ranked.agg(
        F.array_sort(F.collect_list(F.struct(-F.col("roc_auc"), -F.col("accuracy"), "model_name")))
        .alias("all")
    )
    placed = listed.select(F.posexplode("all").alias("at", "m"))
    return rounded(
        placed.select("m.model_name", (-F.col("m.col2")).alias("accuracy"),
                      (-F.col("m.col1")).alias("roc_auc"), (F.col("at") + 1).alias("place"))
    )


@query(
    "topk_features",
    q(f"""select feature, {r('c')} as correlation_with_target from (
            select feature, {corr_sql('value', TARGET)} as c
            from {unpivot_sql('features', PUBLIC_FEATURES, [TARGET])} group by feature)
          order by round(abs(c), 9) desc, feature limit 10"""),
)
def topk_features(spark, sf):
    ranked = A.feature_target_corr(V.features(spark, sf), PUBLIC_FEATURES)
    strength = F.round(F.abs("correlation_with_target"), 9)
    return rounded(S.topk(ranked, 10, strength.desc(), F.asc("feature")))


@query(
    "policy_summary",
    q(f"""select model_name, threshold, {ROUNDED}, 'baseline at 0.50' as note from tgrid
          where model_name = 'delay_rule' and round(threshold, 2) = 0.5
          union all select t.model_name, t.threshold, {', '.join(
              f'{f"t.{n}" if n in _WHOLE else r(f"t.{n}")}' for n in measures_sql())},
            case t.model_name when 'delay_rule' then 'baseline, tuned threshold'
                 when 'history_rule' then 'best class weight' else 'best resampled' end
          from tgrid t join preferred p on p.model_name = t.model_name and p.threshold = t.threshold""",
      GRID_CTE, VALIDATION_GRID, TEST_GRID, PREFERRED),
)
def policy_summary(spark, sf):
    preferred = S.select_preferred(validation_grid(spark, sf), CANDIDATE)
    test = test_grid(spark, sf)
    at_choice = test.join(preferred.select("model_name", "threshold"), ["model_name", "threshold"])
    return rounded(
        S.policy_summary(test, at_choice, "delay_rule", "history_rule", "recent_rule")
    )


@query(
    "comparison_table",
    q(f"""select model_name, {r('accuracy')} as accuracy, {r('recall')} as recall,
            {r('roc_auc')} as roc_auc, null::varchar as source from half
          where model_name <> 'recent_rule'
          union all select model_name, null, {r('recall')}, null, 'older table' from half
          where model_name = 'recent_rule'""", _HALF),
)
def comparison_table(spark, sf):
    """Two models recomputed from predictions; a third only known from an older table."""
    scores = V.scored_models(spark, sf)
    names = ["model_name", "accuracy", "recall", "roc_auc"]
    new = at_half(scores.where("model_name <> 'recent_rule'")).select(*names)
    older = C.confusion(scores, 0.50, CANDIDATE).select("model_name", "recall").withColumn(
        "source", F.lit("older table")
    )
    return rounded(S.comparison_table(new, older))


@query(
    "percentile_rank",
    q(f"""select segment, {r('quantile_cont(y_proba, 0.5)')} as median,
            {r('quantile_cont(y_proba, 0.9)')} as p90, {r('quantile_cont(y_proba, 0.95)')} as p95
          from line_scores group by segment"""),
)
def percentile_rank(spark, sf):
    lines = V.line_scores(spark, sf)
    found = exact_quantiles(lines, ["y_proba"], [0.5, 0.9, 0.95], ["segment"])
    names = ("median", "p90", "p95")
    return rounded(
        found.select("segment", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])
    )


# --- set operations --------------------------------------------------------------------------


@query(
    "row_signature_id",
    q(f"select applicant_id, {signature_sql([*BASE, TARGET])} as signature from applicants"),
)
def row_signature_id(spark, sf):
    table = V.applicants(spark, sf)
    return table.select(KEY, P.row_signature(table, [*BASE, TARGET], 2).alias("signature"))


@query(
    "union_frames",
    q(f"""select model_name, threshold, {r('recall')} as recall, null::double as roc_auc from vgrid
          union all select model_name, null, null, {r('roc_auc')}
          from {ranks_sql('models', ['model_name'])}""", GRID_CTE, VALIDATION_GRID),
)
def union_frames(spark, sf):
    grid = validation_grid(spark, sf).select("model_name", "threshold", "recall")
    areas = ranking_metrics(V.scored_models(spark, sf), CANDIDATE).select("model_name", "roc_auc")
    return rounded(S.union_frames([grid, areas]))


_COARSE = ["EDUCATION", "MARRIAGE", "PAY_0", "PAY_2"]
_SHARED = _COARSE[1:]


@query(
    "intersect_signatures",
    q(f"""select {signature_sql(_SHARED)} as signature from applicants where SEX = 1
          intersect select {signature_sql(_SHARED)} from applicants where SEX = 2"""),
)
def intersect_signatures(spark, sf):
    table = V.applicants(spark, sf)
    return P.intersect_signatures(table.where("SEX = 1"), table.where("SEX = 2"), _SHARED, 2)


@query(
    "distinct_group",
    q(f"""select {signature_sql(_COARSE)} as signature, min(applicant_id) as applicant_id,
            {', '.join(f'any_value({n}) as {n}' for n in _COARSE)}, count(*) as copies
          from applicants group by 1"""),
)
def distinct_group(spark, sf):
    return P.distinct_group(V.applicants(spark, sf), _COARSE, KEY, 2)


# --- splits and samples ----------------------------------------------------------------------


def sizes_sql(units: str, share: float) -> str:
    """Held-out rows per class: whole shares first, then the largest remainders."""
    return f"""(select y, n - whole - (case when row_number() over (
          order by exact - whole desc, y) <= kept - sum(whole) over () then 1 else 0 end) as take
        from (select *, kept * n / total::double as exact, floor(kept * n / total::double) as whole
              from (select y, n, sum(n) over () as total,
                      sum(n) over () - ceil({share}::double * sum(n) over ()) as kept
                    from (select y, count(*) as n from {units} group by y))))"""


def held_sql(units: str, share: float) -> str:
    """Held-out units ``y, o``: the first of every class in hash order."""
    return f"""(select y, o from (select y, o, row_number() over (partition by y order by o) as spot
        from {units}) join {sizes_sql(units, share)} using (y) where spot <= take)"""


def _rows(order: str, source: str = "applicants") -> str:
    return f"(select applicant_id, {TARGET} as y, {order} as o from {source})"


_SIGNED = f"""signed as (select applicant_id, {TARGET} as y,
  {hash_sql(signature_sql([*PUBLIC_BASE, TARGET]))} as o from applicants)"""
_UNITS = "(select distinct y, o from signed)"
GROUP_SPLIT = f"""gsplit as (select applicant_id, y,
  case when (y, o) in (select (y, o) from {held_sql(_UNITS, 0.2)}) then 'test' else 'train' end
    as split from signed)"""


def group_split(spark, sf):
    return P.split_group_stratified(V.applicants(spark, sf), PUBLIC_BASE, places=2)


@query(
    "split_group_stratified",
    q(f"select applicant_id, y as {TARGET}, split from gsplit", _SIGNED, GROUP_SPLIT),
)
def split_group_stratified(spark, sf):
    return group_split(spark, sf).select(KEY, TARGET, "split")


@query(
    "split_group_copies",
    q(
        "select applicant_id, y as Default_Flag, split from csplit",
        f"""coarse as (select applicant_id, {TARGET} as y,
              {hash_sql(signature_sql([*_COARSE, TARGET]))} as o from applicants)""",
        f"""csplit as (select applicant_id, y, case when (y, o) in (
              select (y, o) from {held_sql('(select distinct y, o from coarse)', 0.2)})
              then 'test' else 'train' end as split from coarse)""",
    ),
)
def split_group_copies(spark, sf):
    """The same split on few columns, where most rows have many copies."""
    return P.split_group_stratified(V.applicants(spark, sf), _COARSE, places=2).select(
        KEY, TARGET, "split"
    )


@query(
    "split_simple",
    q(f"""select applicant_id, y as {TARGET}, case when applicant_id in (
            select applicant_id from {_rows(hash_sql('applicant_id'))}
            join {held_sql(_rows(hash_sql('applicant_id')), 0.2)} using (y, o))
          then 'test' else 'train' end as split
          from {_rows(hash_sql('applicant_id'))}"""),
)
def split_simple(spark, sf):
    return P.split_simple(V.applicants(spark, sf), KEY).select(KEY, TARGET, "split")


_TRAIN = f"""(select applicant_id, y, {hash_sql('applicant_id')} as o from gsplit
  where split = 'train')"""


@query(
    "split_validation",
    q(f"""select applicant_id, y as {TARGET}, case when applicant_id in (
            select applicant_id from {_TRAIN} join {held_sql(_TRAIN, 0.25)} using (y, o))
          then 'validation' else split end as split from gsplit""", _SIGNED, GROUP_SPLIT),
)
def split_validation(spark, sf):
    return P.split_validation(group_split(spark, sf), KEY).select(KEY, TARGET, "split")


@query(
    "split_temporal",
    """select o_orderkey, case when row_number() over (order by o_orderdate, o_orderkey)
              <= greatest(1, floor(count(*) over () * (1 - 0.2::double))) then 'train' else 'test'
         end as split from orders where o_orderdate is not null""",
)
def split_temporal(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return P.split_temporal(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "split")


@query(
    "overlap_check",
    q(f"""select kind, count(*) filter (t) as train_values, count(*) filter (e) as test_values,
            count(*) filter (t and e) as overlap
          from (select kind, value, bool_or(split = 'train') as t, bool_or(split = 'test') as e
                from (select split, 'source_index' as kind, cast(applicant_id as varchar) as value
                      from gsplit
                      union all select split, 'selected_rows', {signature_sql([*_COARSE, TARGET])}
                      from gsplit join applicants using (applicant_id)
                      union all select split, 'feature_signatures', {signature_sql(_COARSE)}
                      from gsplit join applicants using (applicant_id)
                      union all select split, 'id_AGE', cast(AGE as varchar)
                      from gsplit join applicants using (applicant_id))
                group by kind, value) group by kind""", _SIGNED, GROUP_SPLIT),
)
def overlap_check(spark, sf):
    """What the two sides share, on few columns so that there is something to find."""
    return P.overlap_check(group_split(spark, sf), KEY, _COARSE, ids=["AGE"], places=2)


@query(
    "target_shuffle",
    q(f"""select applicant_id, cast(row_number() over (order by {hash_sql('applicant_id')})
            <= sum({TARGET}) over () as integer) as {TARGET} from applicants"""),
)
def target_shuffle(spark, sf):
    return P.target_shuffle(V.applicants(spark, sf).select(KEY, TARGET), KEY)


@query(
    "stratified_sample",
    q(f"""select applicant_id, SEX from applicants qualify row_number() over (
            partition by SEX order by {hash_sql('applicant_id')}, applicant_id) <= 600"""),
)
def stratified_sample(spark, sf):
    return P.stratified_sample(V.applicants(spark, sf).select(KEY, "SEX"), "SEX", 1200, KEY)


@query(
    "sample_n",
    q(f"""select applicant_id, y_true, y_proba from scored
          order by {hash_sql('applicant_id')} limit 500"""),
)
def sample_n(spark, sf):
    return P.sample_n(V.scored(spark, sf).select(KEY, "y_true", "y_proba"), 500, KEY)
