"""Queries that train, explain, match neighbours and run scenarios."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.labels import recommendation, review_flag, risk_band
from ..operators import audit as A
from ..operators import explain as E
from ..operators import fairness as G
from ..operators import models as M
from ..operators import neighbours as N
from ..operators import scenario as X
from ..operators import splits as P
from ..operators.confusion import classification_report
from ..operators.mitigation import class_weights
from ..operators.prepare import categorical_codes
from ..schema import (
    BASE,
    BILLS,
    DIAGNOSTIC_FEATURES,
    PAY_STATUS,
    PAYMENTS,
    PUBLIC_FEATURES,
    SENSITIVE,
    TARGET,
)
from ..session import reliable_checkpoint
from . import views as V
from .choices import PUBLIC_BASE
from .registry import query, rounded
from .scores import RATIOS_SQL
from .sql import BASE_LIST, feature_select, label_case, q, quoted, r, unpivot_sql
from .tables import KEY

# A fixed score for jobs whose numbers are checked: log-odds over base and engineered columns.
CARD = X.Scorecard(
    -1.9,
    {
        "PAY_0": 0.45,
        "MaxPaymentDelay": 0.21,
        "NumDelayedMonths": 0.26,
        "AvgBillToLimitRatio": 0.17,
        "AvgPaymentToBillRatio": -0.31,
        "AvgBillAmount": 0.0000005,
        "AvgPaymentAmount": -0.0000011,
        "PaymentToLimitRatio": -0.07,
        "PAY_AMT1": -0.0000007,
        "LIMIT_BAL": -0.0000013,
        "AGE": 0.006,
        "EDUCATION": -0.03,
        "SEX": 0.11,
    },
)
REVIEW = 0.30


def card_sql(names: dict[str, str] | None = None) -> str:
    names = names or {}
    terms = [f"({w!r})::double * coalesce(({names.get(n, n)})::double, 0)"
             for n, w in CARD.coefficients.items()]
    return f"1 / (1 + exp(-(({CARD.intercept!r})::double + {' + '.join(terms)})))"


def split_table(spark, sf):
    """Features of every applicant with their side: train, validation or test; written once."""

    def build(spark, sf):
        split = P.split_group_stratified(V.features(spark, sf), PUBLIC_BASE, places=2)
        return P.split_validation(split, KEY)

    return V.stored(spark, sf, "split", build)


# --- preprocessing and training --------------------------------------------------------------


@query("preprocess")
def preprocess(spark, sf):
    """Numbers imputed and scaled, text levels one-hot, as one array per applicant."""
    table = categorical_codes(V.features(spark, sf), ["SEX", "EDUCATION", "MARRIAGE"])
    names = ["SEX", "EDUCATION", "MARRIAGE", *BILLS, "AvgBillToLimitRatio"]
    stages = M.preprocess_stages(table, names)
    fitted = M.Pipeline(stages=stages).fit(table)
    return fitted.transform(table).select(KEY, vector_to_array("features").alias("features"))


_FILLED = [*PAY_STATUS, *BILLS, "LIMIT_BAL", "AGE"]
SCALED = (
    "filled as (select applicant_id, SEX, Default_Flag, "
    + ", ".join(
        f"coalesce({n}::double, (select quantile_cont({n}::double, 0.5) from features)) as {n}"
        for n in _FILLED
    )
    + " from features),\nscaled as (select applicant_id, SEX, Default_Flag, "
    + ", ".join(
        f"({n} - (select avg({n}) from filled)) / (select stddev_pop({n}) from filled) as {n}"
        for n in _FILLED
    )
    + " from filled)"
)


@query(
    "impute_scale_sql",
    q(f"select applicant_id, {', '.join(f'{r(n)} as {n}' for n in _FILLED)} from scaled", SCALED),
)
def impute_scale_sql(spark, sf):
    return rounded(A.impute_scale(V.features(spark, sf), _FILLED, [KEY]))


def _trained(name: str, trainer) -> None:
    def run(spark, sf):
        table = split_table(spark, sf)
        _, predictions, _ = M.fit_evaluate(table, PUBLIC_FEATURES, trainer, name, KEY)
        return predictions

    query(f"train_{name}")(run)


_trained("logistic", M.train_logistic)
_trained("boosted", M.train_boosted)
_trained("forest_proxy", M.train_forest)


@query("train_mlp")
def train_mlp(spark, sf):
    """The network plain and with balanced classes; both score the validation and test rows."""
    table = split_table(spark, sf)
    inner, validation = table.where("split = 'train'"), table.where("split = 'validation'")
    held = table.where("split <> 'train'")
    return M.union_frames(
        M.fit_many(
            {
                n: lambda n=n, b=b: M.train_mlp(
                    inner, PUBLIC_FEATURES, validation=validation, balanced=b
                ).predictions(held, KEY, n)
                for n, b in {"mlp_baseline": False, "mlp_class_weighted": True}.items()
            }
        )
    )


@query("fit_evaluate")
def fit_evaluate(spark, sf):
    table = split_table(spark, sf)
    return M.fit_evaluate(table, PUBLIC_FEATURES, M.train_logistic, "logistic_public", KEY)[2]


@query("ablation")
def ablation(spark, sf):
    return M.ablation(split_table(spark, sf), PUBLIC_FEATURES, KEY)


@query("standard_compare")
def standard_compare(spark, sf):
    return M.standard_compare(split_table(spark, sf), PUBLIC_FEATURES, DIAGNOSTIC_FEATURES, KEY)


@query("external_benchmark")
def external_benchmark(spark, sf):
    """Two models on text-coded columns: measures, and gaps by sex and by age group."""
    table = P.split_simple(categorical_codes(V.applicants(spark, sf)), KEY)
    people = V.applicants(spark, sf).select(KEY, "SEX", "AGE")
    models = {"logistic_regression": M.train_logistic, "boosted": M.train_boosted}
    scores = M.union_frames(
        M.fit_many(
            {
                n: lambda n=n, t=t: M.fit_evaluate(table, BASE, t, n, KEY)[1]
                for n, t in models.items()
            }
        )
    )
    report = classification_report(scores, 0.50, ["model_name"])
    gaps = G.fairness_ext(scores.join(people, KEY))
    return gaps.join(report, "model_name")


@query("proxy_predictability")
def proxy_predictability(spark, sf):
    reports, scores = M.proxy_predictability(split_table(spark, sf), PUBLIC_FEATURES, KEY)
    place = F.row_number().over(
        M.Window.partitionBy("model").orderBy(F.desc("absolute_score"), "feature")
    )
    return reports.join(scores.withColumn("place", place), "model")


@query("importance")
def importance(spark, sf):
    train = split_table(spark, sf).where("split <> 'test'")
    return M.importance(M.train_boosted(train, PUBLIC_FEATURES))


@query("recall_optimise")
def recall_optimise(spark, sf):
    """Class weight and threshold tuned on validation rows, every candidate tested once."""
    table = split_table(spark, sf)
    rows = class_weights(table.where("split = 'train'")).orderBy("position").collect()
    out = M.recall_optimise(table, PUBLIC_FEATURES, [row["weight"] for row in rows], KEY)
    chosen = out["chosen"].select("model_name").withColumn("is_chosen", F.lit(True))
    return out["test"].join(chosen, "model_name", "left").na.fill({"is_chosen": False})


@query("reweigh_train")
def reweigh_train(spark, sf):
    return M.reweigh_compare(split_table(spark, sf), PUBLIC_FEATURES, KEY)


@query("tradeoff_table")
def tradeoff_table(spark, sf):
    scored = M.reweigh_compare(split_table(spark, sf), PUBLIC_FEATURES, KEY, thresholds=True)
    return M.tradeoff_table(scored)


@query("target_shuffle_auc")
def target_shuffle_auc(spark, sf):
    """Report of a model trained on a shuffled target; its area should be near one half."""
    table = split_table(spark, sf)
    shuffled = P.target_shuffle(table, KEY)
    return M.fit_evaluate(shuffled, PUBLIC_FEATURES, M.train_boosted, "shuffled", KEY)[2]


_NOTES = [
    "Low predicted default risk / low review priority",
    "Manual review recommended",
    "High predicted default risk / strong review required",
]


@query(
    "batch_score",
    q(f"""select applicant_id, {r('p')} as probability,
            case when p < 0.30 then 'Low Risk' when p <= 0.60 then 'Medium Risk' else 'High Risk' end
              as risk_band,
            case when p < 0.30 then {quoted(_NOTES[0])} when p <= 0.60 then {quoted(_NOTES[1])}
              else {quoted(_NOTES[2])} end as recommendation,
            case when p >= 0.25 then 'Manual review recommended' else 'No manual review flag' end
              as review_flag
          from (select applicant_id, {card_sql()} as p from features)"""),
)
def batch_score(spark, sf):
    scored = CARD(V.applicants(spark, sf))
    return rounded(
        scored.select(
            KEY,
            "probability",
            risk_band("probability").alias("risk_band"),
            recommendation("probability").alias("recommendation"),
            review_flag("probability", 0.25).alias("review_flag"),
        )
    )


# --- neighbours ------------------------------------------------------------------------------


def neighbour_pairs(spark, sf):
    """Nearest applicant of the other sex on scaled features, with both scores."""
    scaled = A.impute_scale(
        V.features(spark, sf)
        .withColumn("y_proba", V.rule_score(*V.RULES["delay_rule"]))
        .withColumnRenamed(TARGET, "y_true"),
        _FILLED,
        [KEY, "SEX", "y_true", "y_proba"],
    ).withColumnRenamed(KEY, "id")
    return N.cross_group_table(N.join_nearest(scaled, _FILLED, "SEX", (1, 2), ["y_proba", "y_true"]))


_DISTANCE = " + ".join(f"(a.{n} - b.{n}) * (a.{n} - b.{n})" for n in _FILLED)
NEIGHBOURS = f"""pairs as (
  select a.applicant_id, b.applicant_id as nearest_other_group_id, sqrt({_DISTANCE}) as d
  from scaled a join scaled b on a.SEX <> b.SEX
  qualify row_number() over (partition by a.applicant_id order by round(sqrt({_DISTANCE}), 9),
                             b.applicant_id) = 1)"""


@query(
    "join_nearest",
    q(f"""select applicant_id, a.SEX as sex_code, nearest_other_group_id,
            {r('d')} as feature_distance, {r('a.y_proba')} as original_probability,
            {r('b.y_proba')} as neighbour_probability,
            {r('abs(a.y_proba - b.y_proba)')} as probability_difference,
            a.y_true as original_actual_default, b.y_true as neighbour_actual_default
          from pairs join scored a using (applicant_id)
          join scored b on b.applicant_id = nearest_other_group_id""", SCALED, NEIGHBOURS),
)
def join_nearest(spark, sf):
    pairs = neighbour_pairs(spark, sf)
    return rounded(
        pairs.drop("sex_group", "group", *[c for c in pairs.columns if c.startswith("nearest_other_sex")],
                   "nearest_other_group")
    )


@query(
    "join_nearest_embeddings",
    """with v as (select vec_id, label % 2 as side, embedding::double[] as e from embeddings)
       select a.vec_id as id, b.vec_id as neighbour_id,
         round(list_distance(a.e, b.e), 6) as distance
       from v a join v b on a.side <> b.side
       qualify row_number() over (partition by a.vec_id
         order by round(list_distance(a.e, b.e), 9), b.vec_id) = 1""",
)
def join_nearest_embeddings(spark, sf):
    """Nearest vector on the other side, where a side is the even or the odd labels."""
    vectors = V.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("vector"),  # single precision travels as it is
        (F.col("label") % 2).alias("side"),
    )
    both = N.nearest_both(*[vectors.where(F.col("side") == s) for s in (0, 1)], [])
    return rounded(both.select("id", "neighbour_id", "distance"))


@query(
    "neighbour_summary",
    q(f"""select {r('avg(p)')} as average_probability_difference,
            {r('quantile_cont(p, 0.5)')} as median_probability_difference,
            {r('quantile_cont(p, 0.9)')} as p90_probability_difference,
            count(*) filter (p > 0.10) as large_difference_count
          from (select round(abs(a.y_proba - b.y_proba), 6) as p from pairs
                join scored a using (applicant_id)
                join scored b on b.applicant_id = nearest_other_group_id)""", SCALED, NEIGHBOURS),
)
def neighbour_summary(spark, sf):
    gaps = rounded(neighbour_pairs(spark, sf)).select("probability_difference")
    return rounded(A.difference_summary(reliable_checkpoint(gaps)))  # written once: the search runs once


@query("oversample_minority")
def oversample_minority(spark, sf):
    train = split_table(spark, sf).where("split = 'train'")
    scaled = A.impute_scale(train, _FILLED, [KEY, TARGET])
    return N.oversample_minority(scaled, _FILLED, TARGET, KEY)


# --- attributions and drivers ----------------------------------------------------------------


def card_drivers(spark, sf):
    table = V.features(spark, sf).withColumn("probability", CARD.probability())
    return E.linear_drivers(table, CARD, KEY, ["probability"])


_NAMES = list(CARD.coefficients)
_WEIGHT = " ".join(f"when '{n}' then ({w!r})::double" for n, w in CARD.coefficients.items())
DRIVERS = f"""drivers as (
  select applicant_id, probability, feature,
         (case feature {_WEIGHT} end) * (coalesce(value, 0) - m.mean) as value,
         case when value > m.middle then 'above' else 'below' end as relation
  from {unpivot_sql(f'(select *, {card_sql()} as probability from features)', _NAMES,
                    ['applicant_id', 'probability'])}
  join (select feature, avg(value) as mean, quantile_cont(value, 0.5) as middle
        from {unpivot_sql('features', _NAMES, [])} group by feature) m using (feature)),
ranked as (
  select *, {label_case('feature')} as display_name, value > 0 as up,
         cast(row_number() over (partition by applicant_id, value > 0
           order by abs(value) desc, feature) as integer) as place
  from drivers where value <> 0),
top as (select * from ranked where place <= 5),
free as (
  select *, row_number() over (partition by applicant_id, up order by place) as rank
  from top t
  where feature not in ({', '.join(quoted(n) for n in SENSITIVE)})
     or not exists (select 1 from top o where o.applicant_id = t.applicant_id and o.up = t.up
                    and o.feature not in ({', '.join(quoted(n) for n in SENSITIVE)})))"""


@query(
    "attribution_linear",
    q(f"select applicant_id, feature, {r('value')} as value, relation from drivers", DRIVERS),
)
def attribution_linear(spark, sf):
    return rounded(E.attribution_long(card_drivers(spark, sf), KEY))


@query(
    "attribution_summary",
    q(f"""select feature, {r('avg(abs(value))')} as mean_abs_attribution,
          {r('avg(value)')} as mean_attribution from drivers group by feature""", DRIVERS),
)
def attribution_summary(spark, sf):
    return rounded(E.attribution_summary(card_drivers(spark, sf)))


@query(
    "topk_drivers",
    q(f"""select applicant_id, case when up then 'Increasing Risk' else 'Reducing Risk' end
            as direction, place, feature, display_name, {r('value')} as value from top""", DRIVERS),
)
def topk_drivers(spark, sf):
    return rounded(E.topk_drivers(card_drivers(spark, sf), KEY))


@query(
    "actionable_drivers",
    q("""select applicant_id, cast(rank as integer) as place, feature from free where up""",
      DRIVERS),
)
def actionable_drivers(spark, sf):
    ranked = E.ranked_drivers(card_drivers(spark, sf))
    listed = ranked.select(KEY, F.posexplode(E.actionable("positive")).alias("at", "d"))
    return listed.select(KEY, (F.col("at") + 1).alias("place"), F.col("d.feature").alias("feature"))


_ADVICE = " ".join(
    f"when feature in ({', '.join(quoted(n) for n in names)}) then {quoted(text)}"
    for names, text in E.GUIDANCE
)


@query(
    "guidance_top3",
    q(f"""select applicant_id, coalesce(g.texts, {quoted(E.DEFAULT_GUIDANCE)}) as guidance
          from applicants left join (
            select applicant_id, string_agg(advice, ' | ' order by first_rank) as texts from (
              select applicant_id, advice, min(rank) as first_rank,
                     row_number() over (partition by applicant_id order by min(rank)) as spot
              from (select applicant_id, rank, case {_ADVICE} end as advice from free where up)
              where advice is not null group by applicant_id, advice) where spot <= 3
            group by applicant_id) g using (applicant_id)""", DRIVERS),
)
def guidance_top3(spark, sf):
    ranked = E.ranked_drivers(card_drivers(spark, sf))
    return ranked.select(
        KEY, F.array_join(E.guidance_texts("positive"), " | ").alias("guidance")
    )


def _in(names: list[str]) -> str:
    return f"feature in ({', '.join(quoted(n) for n in names)})"


def _reason_sql() -> str:
    cases = "".join(
        f"  when {_in(names)} then case when up then '{more}' else '{less}' end\n"
        for names, more, less in E.REASONS
    )
    return f"""case
{cases}  else lower(display_name) || case when up then '{E.OTHER[0]}' else '{E.OTHER[1]}' end
  end"""


@query(
    "explanation_text",
    q(f"""select applicant_id, 'Default next month: ' || band || coalesce(
            '. Main reasons: ' || reasons || '.', '. No feature stands out.') as explanation
          from (select applicant_id, case when {card_sql()} < 0.30 then 'low risk'
                  when {card_sql()} <= 0.60 then 'medium risk' else 'high risk' end as band
                from features)
          left join (
            select applicant_id, string_agg(reason, '; ' order by first_rank) as reasons from (
              select applicant_id, {_reason_sql()} as reason, min(rank) as first_rank from free
              where rank <= 3 and up = (probability >= 0.30) group by 1, 2)
            group by applicant_id) using (applicant_id)""", DRIVERS),
)
def explanation_text(spark, sf):
    ranked = E.ranked_drivers(card_drivers(spark, sf))
    return ranked.select(KEY, E.explanation_text().alias("explanation"))


@query("interpret_drivers")
def interpret_drivers(spark, sf):
    """Full sentences for the shown drivers of every applicant."""
    ranked = E.ranked_drivers(card_drivers(spark, sf))
    shown = F.concat(F.slice("positive", 1, 3), F.slice("negative", 1, 3))
    return ranked.select(KEY, F.explode(F.transform(shown, E.interpretation)).alias("sentence"))


@query(
    "median_relation",
    q(f"""select applicant_id, feature, value, {r('middle')} as median,
            case when value > middle then 'above' else 'below' end as relation
          from {unpivot_sql('features', ['PAY_0', 'LIMIT_BAL', 'BILL_AMT6'], ['applicant_id'])}
          join (select feature, quantile_cont(value, 0.5) as middle
                from {unpivot_sql('features', ['PAY_0', 'LIMIT_BAL', 'BILL_AMT6'], [])}
                group by feature) using (feature)"""),
)
def median_relation(spark, sf):
    table = V.features(spark, sf)
    return rounded(A.median_relation(table, ["PAY_0", "LIMIT_BAL", "BILL_AMT6"], KEY))


@query("attribution_tree")
def attribution_tree(spark, sf):
    """Tree Shapley values of a boosted model for every test row, compared between the sexes."""
    table = split_table(spark, sf)
    model = M.train_boosted(table.where("split <> 'test'"), PUBLIC_FEATURES)
    test = G.with_sex_group(table.where("split = 'test'"))
    return E.group_attribution(E.attribution_tree(test, model, KEY, keep=G.GROUP), G.GROUP)


@query("permutation_importance")
def permutation_importance(spark, sf):
    table = split_table(spark, sf)
    model = M.train_logistic(table.where("split <> 'test'"), PUBLIC_FEATURES)
    return M.permutation_importance(table, model, KEY)


@query("local_surrogate")
def local_surrogate(spark, sf):
    """A weighted linear fit on quartiles around every test row of a logistic model on scaled features."""
    table = split_table(spark, sf)
    scaled = reliable_checkpoint(A.impute_scale(table, _FILLED, [KEY, "split", TARGET]))
    train = scaled.where("split <> 'test'")
    model = M.train_logistic(train, _FILLED)
    return E.local_surrogate(scaled.where("split = 'test'"), train, M.matrix_scorer(model), _FILLED, KEY)


@query("counterfactual")
def counterfactual(spark, sf):
    """For every applicant, up to three changed versions on the other side of the threshold."""
    table = V.applicants(spark, sf)
    names = ["LIMIT_BAL", *PAY_STATUS, *BILLS, *PAYMENTS]
    spread = {n: 1000.0 if n not in PAY_STATUS else 1.0 for n in names}
    fixed = [n for n in BASE if n not in names]
    return E.counterfactual(
        table, table, CARD, names, spread, KEY, fixed, profile=["PAY_0", "LIMIT_BAL", "BILL_AMT1"], threshold=REVIEW
    )


# --- scenarios -------------------------------------------------------------------------------

_REST = BASE_LIST.removeprefix("LIMIT_BAL, ")


def scenario_sql(limits: str, points: int) -> str:
    return f"""scenarios as (select applicant_id, i, {limits} as LIMIT_BAL, {_REST},
        LIMIT_BAL as was from applicants cross join range({points}) t(i)),
      scenario_scores as (select applicant_id, i, LIMIT_BAL, was, {card_sql()} as p
        from (select *, {feature_select()} from scenarios))"""


_LOW = f"least({X.LOWEST_LIMIT}::double, LIMIT_BAL)"
_EXPOSURE = f"(case when i = 23 then LIMIT_BAL else {_LOW} + i * ((LIMIT_BAL - {_LOW}) / 23.0::double) end)"


@query(
    "scenario_exposure",
    q(f"""select applicant_id,
            case when max(was) <= 0 then 0.0::double
                 else coalesce({r('max(LIMIT_BAL) filter (p < 0.30)')}, 0.0::double) end
              as max_exposure, 0.3::double as threshold,
            case when max(was) > 0 then coalesce(
              {r('arg_max(p, LIMIT_BAL) filter (p < 0.30)')}, {r('min(p)')}) end
              as probability_at_exposure,
            case when max(was) <= 0 then {quoted(X.NO_LIMIT_NOTE)}
                 when count(*) filter (p < 0.30) > 0 then {quoted(X.FOUND_NOTE)}
                 else {quoted(X.NONE_NOTE)} end as note
          from scenario_scores group by applicant_id""", scenario_sql(_EXPOSURE, 24)),
)
def scenario_exposure(spark, sf):
    return rounded(X.scenario_exposure(V.applicants(spark, sf), CARD, REVIEW, KEY))


_NOW = "greatest(LIMIT_BAL, 1.0::double)"
_FROM = f"greatest({_NOW} * 0.4::double, 1.0::double)"
_TO = f"greatest({_NOW} * 1.2::double, {_FROM})"
_CURVE = f"(case when i = 11 then {_TO} else {_FROM} + i * (({_TO} - {_FROM}) / 11.0::double) end)"


@query(
    "scenario_curve",
    q(f"""select applicant_id, cast(i as integer) as point, {r('LIMIT_BAL')} as target_credit_amount,
            {r('p')} as predicted_default_risk from scenario_scores""", scenario_sql(_CURVE, 12)),
)
def scenario_curve(spark, sf):
    return rounded(X.scenario_curve(V.applicants(spark, sf), CARD, KEY))


ADJUSTMENTS = [
    X.Adjustment("on_time", 150_000, 0, 20_000, 18_000),
    X.Adjustment("late", 80_000, 3, 60_000, 1_000),
    X.Adjustment("late_but_recovering", 80_000, 2, 50_000, 9_000, first_delay=0),
]
_OPTIONS = ", ".join(
    f"('{a.name}', {a.limit}::double, {a.delay if a.first_delay is None else a.first_delay}, "
    f"{a.delay}, {a.bill}::double, {a.payment}::double)"
    for a in ADJUSTMENTS
)


@query(
    "scenario_adjust",
    q(f"""select applicant_id, scenario, {r(card_sql())} as probability from (
            select *, {feature_select()} from (
              select applicant_id, scenario, lim as LIMIT_BAL, SEX, EDUCATION, MARRIAGE, AGE,
                first_delay as PAY_0, {', '.join(f'delay as {n}' for n in PAY_STATUS[1:])},
                {', '.join(f'bill as {n}' for n in BILLS)},
                {', '.join(f'paid as {n}' for n in PAYMENTS)}
              from (select applicant_id, SEX, EDUCATION, MARRIAGE, AGE from applicants)
              cross join (values {_OPTIONS}) o(scenario, lim, first_delay, delay, bill, paid)))"""),
)
def scenario_adjust(spark, sf):
    scenarios = X.scenario_adjust(V.applicants(spark, sf), ADJUSTMENTS, KEY)
    return rounded(CARD(scenarios).select(KEY, "scenario", "probability"))


_FLIPPED = card_sql({"SEX": "3 - SEX"})


@query(
    "sensitivity_flip",
    q(f"""select applicant_id, SEX as original_sex_code, 3 - SEX as flipped_sex_code,
            y_true as actual_default, {r('a')} as original_probability,
            {r('b')} as flipped_probability, {r('abs(b - a)')} as absolute_probability_change,
            (a >= 0.5) <> (b >= 0.5) as baseline_decision_changed,
            (a >= 0.25) <> (b >= 0.25) as recall_policy_decision_changed
          from (select applicant_id, SEX, {TARGET} as y_true, {card_sql()} as a, {_FLIPPED} as b
                from features)"""),
)
def sensitivity_flip(spark, sf):
    flips = X.sensitivity_flip(V.applicants(spark, sf), CARD, KEY, (1, 2), TARGET)
    return rounded(flips.drop("original_sex_group", "original_group", "flipped_sex_group",
                              "flipped_group"))


@query(
    "sensitivity_summary",
    q(f"""select {r('max(abs(b - a))')} as max_absolute_probability_change,
            count(*) filter ((a >= 0.5) <> (b >= 0.5)) as baseline_decision_changes,
            count(*) filter ((a >= 0.25) <> (b >= 0.25)) as recall_policy_decision_changes
          from (select {card_sql()} as a, {_FLIPPED} as b from features)"""),
)
def sensitivity_summary(spark, sf):
    flips = X.sensitivity_flip(V.applicants(spark, sf), CARD, KEY, (1, 2), TARGET)
    return rounded(X.sensitivity_summary(flips))


@query(
    "join_original_flipped",
    q(f"""select applicant_id, {r(card_sql())} as original_probability,
            {r(_FLIPPED)} as flipped_probability,
            {r(f'abs({_FLIPPED} - {card_sql()})')} as absolute_probability_change from features"""),
)
def join_original_flipped(spark, sf):
    table = V.applicants(spark, sf)
    flipped = CARD(table.withColumn("SEX", 3 - F.col("SEX")))
    return rounded(X.join_original_flipped(CARD(table), flipped, KEY))


def _shortcoming_rows() -> str:
    rules = {
        "delay": f"{RATIOS_SQL['max_delay']} > 0",
        "utilization": f"{RATIOS_SQL['utilization']} > {X.HIGH_UTILIZATION}",
        "payment": f"({RATIOS_SQL['payment_ratio']}) < {X.LOW_PAYMENT}",
        "risk": f"{card_sql()} >= {X.NOT_LOW_RISK}",
    }
    parts = [
        f"select applicant_id, {i} as i, {', '.join(quoted(t) for t in X.SHORTCOMINGS[name])} "
        f"from features where {rule}"
        for i, (name, rule) in enumerate(rules.items())
    ]
    none = " and ".join(f"not ({rule})" for rule in rules.values())
    parts.append(
        f"select applicant_id, 9, {', '.join(quoted(t) for t in X.SHORTCOMINGS['none'])} "
        f"from features where {none}"
    )
    return " union all ".join(parts)


@query(
    "shortcomings",
    q(f"""select applicant_id, cast(row_number() over (partition by applicant_id order by i)
            as integer) as position, shortcoming, why, action
          from ({_shortcoming_rows()}) t(applicant_id, i, shortcoming, why, action)"""),
)
def shortcomings(spark, sf):
    return X.shortcomings(CARD(V.applicants(spark, sf)), KEY)

