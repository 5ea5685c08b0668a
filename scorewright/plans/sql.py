"""SQL pieces for the check of every query: the derived views and measure expressions."""

from __future__ import annotations

from ..functions.labels import FEATURE_LABELS
from ..operators.confusion import FALSE_ALARM_COST, MISS_COST
from ..schema import BASE, BILL_RATIOS, BILLS, ENGINEERED, PAY_STATUS, PAYMENTS, TARGET
from .views import RULES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def r(value: str, places: int = 6) -> str:
    """Rounded, without a negative zero."""
    half = f"{0.5 / 10**places:.10f}"
    return (
        f"(case when abs({value}) < {half} then 0.0::double "
        f"else round(({value})::double, {places}) end)"
    )


def rate(top: str, bottom: str) -> str:
    return f"(case when ({bottom}) = 0 then 0.0::double else ({top})::double / ({bottom}) end)"


def divide(top: str, bottom: str) -> str:
    return (
        f"(case when ({bottom}) is null or ({bottom}) = 0 then 0.0::double "
        f"else ({top})::double / ({bottom}) end)"
    )


def row_mean(values: list[str]) -> str:
    total = " + ".join(f"coalesce(({v})::double, 0.0)" for v in values)
    present = " + ".join(f"(case when ({v}) is not null then 1 else 0 end)" for v in values)
    return f"(case when ({present}) > 0 then ({total}) / ({present}) end)"


def _slot(k: int, value: str, name: str) -> str:
    return f"max(case when slot = {k} then {value} end) as {name}"


_HISTORY = ",\n".join(
    [_slot(k, "pay", n) for k, n in enumerate(PAY_STATUS, 1)]
    + [_slot(k, "bill", n) for k, n in enumerate(BILLS, 1)]
    + [_slot(k, "paid", n) for k, n in enumerate(PAYMENTS, 1)]
)

_APPLICANTS = f"""
lines as (
  select l_orderkey,
         round(sum(case when l_linestatus = 'F' then l_extendedprice else 0 end), 2) as paid,
         max(cast(l_shipdate as date)) as ship
  from lineitem group by l_orderkey),
months as (
  select o_custkey, o_orderstatus as status, o_totalprice as bill,
         coalesce(paid, 0.0::double) as paid,
         cast(least(8, floor(abs(coalesce(
           date_diff('day', cast(o_orderdate as date), ship), 0)) / 250.0) - 2) as integer) as pay,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)
           as slot
  from orders left join lines on l_orderkey = o_orderkey),
history as (
  select o_custkey, {_slot(1, 'status', 'status')}, {_HISTORY}
  from months where slot <= 6 group by o_custkey),
applicants as (
  select c_custkey as applicant_id,
         case when c_acctbal < 0 then 0.0::double else round(c_acctbal * 50, 2) end as LIMIT_BAL,
         cast(1 + c_nationkey % 2 as integer) as SEX,
         cast(1 + c_nationkey % 4 as integer) as EDUCATION,
         cast(1 + c_custkey % 3 as integer) as MARRIAGE,
         cast(21 + c_custkey % 59 as integer) as AGE,
         {', '.join([*PAY_STATUS, *BILLS, *PAYMENTS])},
         cast(case when (coalesce(PAY_0, -2) >= 2 and status <> 'P')
                     or (status = 'F' and c_custkey % 7 = 0) then 1 else 0 end as integer)
           as {TARGET}
  from customer left join history on o_custkey = c_custkey)"""

DELAYED = " + ".join(f"(case when {n} > 0 then 1 else 0 end)" for n in PAY_STATUS)
RATIO = {name: divide(bill, "LIMIT_BAL") for name, bill in zip(BILL_RATIOS, BILLS)}
FEATURE_SQL = {
    **RATIO,
    "AvgBillToLimitRatio": row_mean(list(RATIO.values())),
    "AvgPaymentToBillRatio": row_mean(
        [divide(p, f"abs({b})") for p, b in zip(PAYMENTS, BILLS)]
    ),
    "RecentPaymentDelay": "PAY_0",
    "MaxPaymentDelay": f"greatest({', '.join(PAY_STATUS)})",
    "NumDelayedMonths": f"cast({DELAYED} as integer)",
    "AvgBillAmount": row_mean(BILLS),
    "AvgPaymentAmount": row_mean(PAYMENTS),
    "PaymentToLimitRatio": divide(row_mean(PAYMENTS), "LIMIT_BAL"),
}


def feature_select(names: list[str] | None = None) -> str:
    return ", ".join(f"{FEATURE_SQL[n]} as {n}" for n in names or ENGINEERED)


def _points(rule: str) -> str:
    start, recent, month = RULES[rule]
    points = f"{start} + {recent} * coalesce(PAY_0, -2) + {month} * ({DELAYED})"
    return f"greatest(0, least(10000, {points})) / 10000.0::double"


def sex_group_sql(code: str) -> str:
    return f"(case {code} when 1 then 'Male' when 2 then 'Female' else 'Unknown' end)"


def group_label_sql(code: str) -> str:
    return f"({sex_group_sql(code)} || ' (SEX=' || cast({code} as varchar) || ')')"


_VIEWS = f"""
features as (select *, {feature_select()} from applicants),
scored as (
  select applicant_id, SEX, AGE, {TARGET} as y_true, {_points('delay_rule')} as y_proba,
         SEX as sex_code, {sex_group_sql('SEX')} as sex_group, {group_label_sql('SEX')} as "group"
  from applicants),
models as (
  select applicant_id, SEX, AGE,
         case when md5(cast(applicant_id as varchar)) < '33' then 'test' else 'validation' end
           as split,
         {TARGET} as y_true, m.model_name, m.y_proba,
         SEX as sex_code, {sex_group_sql('SEX')} as sex_group, {group_label_sql('SEX')} as "group"
  from (select *, unnest([{', '.join(
      f"{{'model_name': '{name}', 'y_proba': {_points(name)}}}" for name in RULES)}]) as m
        from applicants)),
line_scores as (
  select cast(l_returnflag = 'R' as integer) as y_true,
         round(5 * l_discount + 5 * l_tax, 4) as y_proba, l_linestatus as segment
  from lineitem),
document_scores as (
  select doc_id, lang, quality as y_true, n_chars / (n_chars + 10000.0::double) as y_proba
  from documents join labels using (doc_id))"""


def q(body: str, *extra: str) -> str:
    """A query over the views, after further common tables."""
    return "with " + ",\n".join([_APPLICANTS, _VIEWS, *extra]) + "\n" + body


def measures_sql() -> dict[str, str]:
    n = "(tp + fp + tn + fn)"
    recall = rate("tp", "tp + fn")
    return {
        "accuracy": rate("tp + tn", n),
        "precision": rate("tp", "tp + fp"),
        "recall": recall,
        "specificity": rate("tn", "tn + fp"),
        "f1": rate("2 * tp", "2 * tp + fn + fp"),
        "f2": rate("5 * tp", "5 * tp + 4 * fn + fp"),
        "false_positive_rate": rate("fp", "fp + tn"),
        "false_negative_rate": rate("fn", "fn + tp"),
        "true_positives": "tp",
        "false_positives": "fp",
        "true_negatives": "tn",
        "false_negatives": "fn",
        "predicted_default_rate": rate("tp + fp", n),
        "predicted_non_default_rate": rate("tn + fn", n),
        "approval_support_rate": rate("tn + fn", n),
        "default_capture_rate": recall,
        "expected_cost": f"cast({MISS_COST} * fn + {FALSE_ALARM_COST} * fp as bigint)",
    }


COUNT_NAMES = {"true_positives", "false_positives", "true_negatives", "false_negatives",
               "expected_cost"}


def measure_select(names: list[str] | None = None, renamed: dict[str, str] | None = None) -> str:
    made, renamed = measures_sql(), renamed or {}
    return ", ".join(
        f"{made[n] if n in COUNT_NAMES else r(made[n])} as {renamed.get(n, n)}"
        for n in names or made
    )


def counts_select(threshold: str = "threshold") -> str:
    flagged = f"y_proba >= {threshold}"
    return (
        f"count(*) filter ({flagged} and y_true = 1) as tp, "
        f"count(*) filter ({flagged} and y_true = 0) as fp, "
        f"count(*) filter (not ({flagged}) and y_true = 0) as tn, "
        f"count(*) filter (not ({flagged}) and y_true = 1) as fn"
    )


def grid_values(thresholds: list[float]) -> str:
    return ", ".join(f"({t}::double)" for t in thresholds)


def ranks_sql(source: str, keys: list[str]) -> str:
    """ROC area and average precision per key, from one window over the distinct scores."""
    by = "".join(f"{k}, " for k in keys)
    part = f"partition by {', '.join(keys)}" if keys else ""
    group = f"group by {', '.join(keys)}" if keys else ""
    return f"""
    (select {by}
       case when max(p) > 0 and max(n) > 0
            then sum(pos * (neg_below + neg / 2.0::double)) / (max(p)::double * max(n)) end
         as roc_auc,
       case when max(p) > 0 and max(n) > 0
            then sum((pos::double / nullif(p, 0)) *
                     ((p - pos_below)::double / nullif((p - pos_below) + (n - neg_below), 0))) end
         as pr_auc
     from (select {by} y_proba, pos, neg,
             coalesce(sum(pos) over (w rows between unbounded preceding and 1 preceding), 0)
               as pos_below,
             coalesce(sum(neg) over (w rows between unbounded preceding and 1 preceding), 0)
               as neg_below,
             sum(pos) over ({part}) as p, sum(neg) over ({part}) as n
           from (select {by} y_proba, count(*) filter (y_true = 1) as pos,
                        count(*) filter (y_true = 0) as neg
                 from {source} group by {by} y_proba)
           window w as ({part} order by y_proba))
     {group})"""


GAPS = {
    "demographic_parity_difference": "max(approved) - min(approved)",
    "disparate_impact_ratio":
        "case when max(approved) > 0 then min(approved) / max(approved) else 1.0::double end",
    "equal_opportunity_difference": "max(approved_good) - min(approved_good)",
    "equalized_odds_difference":
        "greatest(max(approved_good) - min(approved_good), max(approved_bad) - min(approved_bad))",
    "false_positive_rate_difference": "max(flagged_good) - min(flagged_good)",
    "false_negative_rate_difference": "max(approved_bad) - min(approved_bad)",
    "high_risk_rate_difference": "max(flagged) - min(flagged)",
}
FOUR_GAPS = {
    **{n: GAPS[n] for n in ("demographic_parity_difference", "equalized_odds_difference",
                            "equal_opportunity_difference")},
    "disparate_impact_ratio":
        f"case when count(*) < 2 then 1.0::double else {GAPS['disparate_impact_ratio']} end",
}


def gaps_sql(counts: str, keys: list[str], gaps: dict[str, str] | None = None) -> str:
    by = ", ".join(keys)
    made = ", ".join(f"{r(e)} as {n}" for n, e in (gaps or GAPS).items())
    return f"""(select {by}, {made} from (
      select {by}, {rate('tn + fn', 'tp + fp + tn + fn')} as approved,
             {rate('tn', 'tn + fp')} as approved_good, {rate('fn', 'fn + tp')} as approved_bad,
             {rate('fp', 'fp + tn')} as flagged_good,
             {rate('tp + fp', 'tp + fp + tn + fn')} as flagged
      from {counts}) group by {by})"""


def unpivot_sql(source: str, names: list[str], keys: list[str]) -> str:
    """Long rows ``keys, feature, value``, with missing values kept."""
    by = "".join(f"{k}, " for k in keys)
    return (
        f"(select {by} e.feature as feature, e.value as value from (select {by} unnest(["
        + ", ".join(f"{{'feature': '{n}', 'value': {n}::double}}" for n in names)
        + f"]) as e from {source}))"
    )


def cents(name: str) -> str:
    return f"cast(cast(round({name} * 100) as hugeint) as varchar)"


def signature_sql(names: list[str]) -> str:
    """md5 of a row's cells, money in cents, missing as ``nan``."""
    money = {"LIMIT_BAL", *BILLS, *PAYMENTS}
    cells = [
        f"coalesce({cents(n) if n in money else f'cast({n} as varchar)'}, 'nan')" for n in names
    ]
    return "md5(" + " || '||' || ".join(cells) + ")"


def hash_sql(value: str, seed: int = 42) -> str:
    return f"md5(cast({value} as varchar) || '|{seed}')"


def label_case(column: str, table: dict[str, str] | None = None) -> str:
    cases = " ".join(
        f"when {quoted(k)} then {quoted(v)}" for k, v in (table or FEATURE_LABELS).items()
    )
    return f"(case {column} {cases} else {column} end)"


BASE_LIST = ", ".join(BASE)
