"""DuckDB SQL for each catalog query, over the raw test tables.

Each string starts from the same view definitions (``user_log``,
``user_info``, ``pairs``, ``scoring_pairs``) written against the
pre-registered parquet views, always with both log joins.
"""

from __future__ import annotations

from ..schemas import FEATURES

BASE = """
with user_log as (
  select cast(o_custkey as bigint) as user_id,
         cast(l_partkey as bigint) as item_id,
         cast(p_size as bigint) as cat_id,
         cast(l_suppkey as bigint) as seller_id,
         cast(p_brand as varchar) as brand_id,
         strftime(l_shipdate, '%m%d') as time_stamp,
         cast(case when l_returnflag = 'A' then 2 when l_returnflag = 'N' then 0
                   when l_linestatus = 'F' then 1 else 3 end as integer) as action_type
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
),
user_info as (
  select cast(c_custkey as bigint) as user_id,
         cast(case when c_custkey % 10 = 9 then null else c_custkey % 10 end as integer) as age_range,
         cast(case when c_nationkey % 4 = 3 then null else c_nationkey % 4 end as integer) as gender
  from customer
),
pairs as (
  select user_id, seller_id as merchant_id,
         cast(case when count(distinct time_stamp) >= 2 then 1 else 0 end as integer) as label
  from user_log where action_type = 2 group by user_id, seller_id
),
scoring_pairs as (
  select distinct user_id, seller_id as merchant_id, cast(null as varchar) as prob
  from user_log where action_type = 3
),
log_agg as (
  select user_id, seller_id as merchant_id,
         count(*) as total_logs,
         count(distinct item_id) + max(case when item_id is null then 1 else 0 end) as unique_item_ids,
         count(distinct cat_id) + max(case when cat_id is null then 1 else 0 end) as categories,
         count(distinct time_stamp) + max(case when time_stamp is null then 1 else 0 end) as browse_days,
         count(*) filter (where action_type is distinct from 0) as one_clicks,
         count(*) filter (where action_type = 1) as shopping_carts,
         count(*) filter (where action_type = 2) as purchase_times,
         count(*) filter (where action_type = 3) as favor_times,
         count(*) filter (where action_type = 0) as clicks
  from user_log group by user_id, seller_id
),
pair_features as (
  select p.user_id, p.merchant_id, p.label, u.age_range, u.gender,
         a.total_logs, a.unique_item_ids, a.categories, a.browse_days,
         a.one_clicks, a.shopping_carts, a.purchase_times, a.favor_times
  from pairs p
  left join log_agg a on p.user_id = a.user_id and p.merchant_id = a.merchant_id
  left join user_info u on p.user_id = u.user_id
),
features_filled as (
  select user_id, merchant_id, label,
         coalesce(age_range, 0) as age_range, coalesce(gender, 0) as gender,
         coalesce(total_logs, 0) as total_logs, coalesce(unique_item_ids, 0) as unique_item_ids,
         coalesce(categories, 0) as categories, coalesce(browse_days, 0) as browse_days,
         coalesce(one_clicks, 0) as one_clicks, coalesce(shopping_carts, 0) as shopping_carts,
         coalesce(purchase_times, 0) as purchase_times, coalesce(favor_times, 0) as favor_times
  from pair_features
),
rule_predictions as (
  select label, cast(case when purchase_times >= 2 then 1.0 else 0.0 end as double) as prediction
  from features_filled
)
"""

ENGAGED = "time_stamp = '1111' and action_type is distinct from 0"
PURCHASE = "time_stamp = '1111' and action_type = 2"
YOUNG = "user_id in (select user_id from user_info where age_range in (1, 2, 3))"


def _top_items(day_pred: str) -> str:
    return f"""
select row_number() over (order by n desc, item_id asc nulls last) as rank, item_id, n
from (select item_id, count(*) as n from user_log
      where {day_pred} and action_type is distinct from 0 group by item_id)
order by n desc, item_id asc nulls last limit 100
"""


def _top_merchants(day_pred: str, users: str = "user_info") -> str:
    return f"""
select row_number() over (order by n desc, seller_id asc nulls last) as rank, seller_id, n
from (select seller_id, count(*) as n from user_log
      where {day_pred} and action_type is distinct from 0
        and user_id in (select user_id from {users} where age_range in (1, 2, 3))
      group by seller_id)
order by n desc, seller_id asc nulls last limit 100
"""


def _counts_raw(attr: str) -> str:
    return f"""
select ui.{attr}, count(distinct b.user_id) as buy_num
from (select distinct user_id from user_log where {PURCHASE}) b
join (select * from user_info where gender is not null) ui on b.user_id = ui.user_id
group by ui.{attr}
"""


def _share(attr: str, pred: str, day_pred: str = PURCHASE) -> str:
    return f"""
select {attr}, buy_num, format('{{:,.5f}}', buy_num / sum(buy_num) over () * 100) as percent
from (select ui.{attr}, count(distinct ul.user_id) as buy_num
      from user_log ul join user_info ui on ul.user_id = ui.user_id
      where {day_pred} and {pred}
      group by ui.{attr})
"""


def _report(attr: str, pred: str) -> str:
    return f"""
select {attr}, buy_num,
       format('{{:.1f}}', round(buy_num / sum(buy_num) over () * 100, 1)) || '%' as percent
from ({_counts_raw(attr)}) where {pred}
"""


def _libsvm() -> str:
    feats = list(FEATURES)
    parts = " || ' ' || ".join(
        f"'{i + 1}:' || cast(cast({f} as double) as varchar)" for i, f in enumerate(feats)
    )
    return f"select cast(cast(label as double) as varchar) || ' ' || {parts} as line from features_filled"


def _normalized() -> str:
    feats = list(FEATURES)
    sq = " + ".join(f"cast({f} as double) * cast({f} as double)" for f in feats)
    cols = ", ".join(
        f"round(case when norm = 0 then 0.0 else cast({f} as double) / norm end, 6) as {f}"
        for f in feats
    )
    return f"select user_id, merchant_id, {cols} from (select *, sqrt({sq}) as norm from features_filled)"


def _nb_likelihoods() -> str:
    feats = list(FEATURES)
    unpivot = " union all ".join(
        f"select label, {i} as feature, cast({f} as double) as v from features_filled"
        for i, f in enumerate(feats)
    )
    return f"""
select cast(label as double) as label, feature,
       round(ln(s + 1.0) - ln(sum(s) over (partition by label) + {len(feats)} * 1.0), 6) as log_likelihood
from (select label, feature, sum(v) as s from ({unpivot}) group by label, feature)
"""


def _nb_predictions() -> str:
    """Multinomial naive Bayes (smoothing 1) fitted and applied in SQL."""
    feats = list(FEATURES)
    sums = ", ".join(f"sum({f}) as s{i}" for i, f in enumerate(feats))
    total = " + ".join(f"s{i}" for i in range(len(feats)))
    thetas = ", ".join(
        f"ln(s{i} + 1.0) - ln({total} + {len(feats)} * 1.0) as t{i}" for i in range(len(feats))
    )

    def score(alias: str) -> str:
        dot = f"f.{feats[0]} * {alias}.t0"
        for i, f in enumerate(feats[1:], start=1):
            dot = f"({dot} + f.{f} * {alias}.t{i})"
        return f"{dot} + {alias}.lp"

    return f"""
, nb_stats as (select label, count(*) as n, {sums} from features_filled group by label)
, nb_params as (
  select label, ln(n + 1.0) - ln(sum(n) over () + 2 * 1.0) as lp, {thetas} from nb_stats
)
select user_id, merchant_id, label,
       case when sc1 > sc0 then 1.0 else 0.0 end as prediction,
       round(1.0 / (1.0 + exp(sc0 - sc1)), 9) as score
from (select f.user_id, f.merchant_id, cast(f.label as double) as label,
             {score("p0")} as sc0, {score("p1")} as sc1
      from features_filled f
      join nb_params p0 on p0.label = 0
      join nb_params p1 on p1.label = 1)
"""


SQL: dict[str, str] = {
    "filter_day_engaged": f"select * from user_log where {ENGAGED}",
    "filter_day_purchase": f"select * from user_log where {PURCHASE}",
    "filter_age_valid": "select * from user_info where age_range between 1 and 8",
    "filter_youth": "select * from user_info where age_range in (1, 2, 3)",
    "users_complete": "select * from user_info where gender is not null",
    "users_any_attr": "select * from user_info where age_range is not null or gender is not null",
    "split_fields": "select * from user_log",
    "tagged_source": f"""
select user_id, cast(seller_id as varchar) as value, 'a' as tag from user_log where {ENGAGED}
union all
select user_id, cast(age_range as varchar) as value, 'b' as tag from user_info
where age_range is not null or gender is not null
""",
    "join_inner": f"""
select l.user_id, l.seller_id, u.age_range
from (select user_id, seller_id from user_log where {ENGAGED}) l
join (select user_id, age_range from user_info where gender is not null) u on l.user_id = u.user_id
""",
    "join_left_profile": """
select p.user_id, p.merchant_id, p.label, u.age_range, u.gender
from pairs p left join user_info u on p.user_id = u.user_id
""",
    "join_youth": f"select user_id, seller_id from user_log where {ENGAGED} and {YOUNG}",
    "join_tagged": f"select user_id, cast(seller_id as varchar) as seller_id from user_log where {ENGAGED} and {YOUNG}",
    "count_by_item": f"select item_id, count(*) as n from user_log where {ENGAGED} group by item_id",
    "count_by_seller": f"select seller_id, count(*) as n from user_log where {ENGAGED} and {YOUNG} group by seller_id",
    "distinct_buyers": f"select distinct user_id from user_log where {PURCHASE}",
    "total_logs": "select user_id, seller_id as merchant_id, count(*) as total_logs from user_log group by 1, 2",
    "action_counts": """
select user_id, seller_id as merchant_id, action_type, count(*) as times from user_log group by 1, 2, 3
""",
    "unique_items": "select user_id, merchant_id, unique_item_ids from log_agg",
    "categories": "select user_id, merchant_id, categories from log_agg",
    "browse_days": "select user_id, merchant_id, browse_days from log_agg",
    "action_features": """
select user_id, merchant_id, one_clicks, shopping_carts, purchase_times, favor_times, clicks from log_agg
""",
    "top_items": _top_items("time_stamp = '1111'"),
    "top_items_month": _top_items("time_stamp like '11%'"),
    "top_items_all": _top_items("true"),
    "top_items_replaced": _top_items(
        "time_stamp is distinct from '1111' and not (time_stamp like '11%' and action_type is not distinct from 3)"
    ),
    "top_merchants": _top_merchants("time_stamp = '1111'"),
    "top_merchants_month": _top_merchants("time_stamp like '11%'"),
    "top_merchants_all": _top_merchants("true"),
    "top_merchants_complete": _top_merchants(
        "true", "(select * from user_info where gender is not null)"
    ),
    "sorted_item_counts": """
select item_id, count(*) as n from user_log
where time_stamp like '11%' and action_type is distinct from 0 group by item_id
""",
    "item_ranks": """
select row_number() over (order by n desc, item_id asc nulls last) as rank, item_id, n
from (select item_id, count(*) as n from user_log where action_type is distinct from 0 group by item_id)
""",
    "seller_item_ranks": """
select seller_id, item_id, n,
       row_number() over (partition by seller_id order by n desc, item_id asc nulls last) as rank,
       cast(sum(n) over (partition by seller_id order by n desc, item_id asc nulls last) as bigint) as running_n
from (select seller_id, item_id, count(*) as n from user_log where action_type is distinct from 0 group by 1, 2)
""",
    "log_preview": """
select * from user_log
order by user_id, item_id, cat_id, seller_id, brand_id, time_stamp, action_type limit 10
""",
    "rank_report": f"""
select rank, format('{{}}: {{}}, {{}}', rank, item_id, n) as line
from ({_top_items("time_stamp like '11%'")})
""",
    "age_counts_raw": _counts_raw("age_range"),
    "gender_counts_raw": _counts_raw("gender"),
    "age_share": _share("age_range", "age_range between 1 and 8"),
    "gender_share": _share("gender", "gender in (0, 1)"),
    "age_share_month": _share(
        "age_range", "age_range between 1 and 8", "time_stamp like '11%' and action_type = 2"
    ),
    "sql_age_share": _share("age_range", "age_range >= 1 and age_range <= 8"),
    "sql_gender_share": _share("gender", "gender in (0, 1)"),
    "age_share_report": _report("age_range", "age_range between 1 and 8"),
    "gender_share_report": _report("gender", "gender in (0, 1)"),
    "pair_features": "select * from pair_features",
    "features_filled": "select * from features_filled",
    "scoring_features": """
select p.user_id, p.merchant_id, p.prob,
       coalesce(u.age_range, 0) as age_range, coalesce(u.gender, 0) as gender,
       coalesce(a.total_logs, 0) as total_logs, coalesce(a.unique_item_ids, 0) as unique_item_ids,
       coalesce(a.categories, 0) as categories, coalesce(a.browse_days, 0) as browse_days,
       coalesce(a.one_clicks, 0) as one_clicks, coalesce(a.shopping_carts, 0) as shopping_carts,
       coalesce(a.purchase_times, 0) as purchase_times, coalesce(a.favor_times, 0) as favor_times
from scoring_pairs p
left join log_agg a on p.user_id = a.user_id and p.merchant_id = a.merchant_id
left join user_info u on p.user_id = u.user_id
""",
    "libsvm_lines": _libsvm(),
    "normalize_l2": _normalized(),
    "nb_priors": """
select cast(label as double) as label,
       round(ln(count(*) + 1.0) - ln(sum(count(*)) over () + 2 * 1.0), 6) as log_prior
from features_filled group by label
""",
    "nb_likelihoods": _nb_likelihoods(),
    "error_rate": """
select avg(case when prediction <> label then 1.0 else 0.0 end) as error_rate from rule_predictions
""",
    "accuracy": """
select avg(case when prediction = label then 1.0 else 0.0 end) as accuracy from rule_predictions
""",
    "hard_auc": """
select round(case when pos = 0 or neg = 0 then 0.5 else (1.0 + tp / pos - fp / neg) / 2 end, 9) as hard_auc
from (select sum(case when label = 1 then 1.0 else 0.0 end) as pos,
             sum(case when label = 0 then 1.0 else 0.0 end) as neg,
             sum(case when label = 1 and prediction = 1 then 1.0 else 0.0 end) as tp,
             sum(case when label = 0 and prediction = 1 then 1.0 else 0.0 end) as fp
      from rule_predictions)
""",
    "hard_aupr": """
select round(case when tp + fp = 0 or pos = 0 then pos / (pos + neg)
                  else (tp / pos) * (tp / (tp + fp))
                       + (1 - tp / pos) * (tp / (tp + fp) + pos / (pos + neg)) / 2 end, 9) as hard_aupr
from (select sum(case when label = 1 then 1.0 else 0.0 end) as pos,
             sum(case when label = 0 then 1.0 else 0.0 end) as neg,
             sum(case when label = 1 and prediction = 1 then 1.0 else 0.0 end) as tp,
             sum(case when label = 0 and prediction = 1 then 1.0 else 0.0 end) as fp
      from rule_predictions)
""",
}


SQL |= {
    "csv_scan": SQL["split_fields"],
    "csv_multi_path": SQL["split_fields"],
    "csv_users_scan": "select * from user_info",
    "text_scan": SQL["split_fields"],
    "tagged_scan": SQL["tagged_source"],
    "csv_sink_round_trip": SQL["top_merchants_all"],
    "report_round_trip": f"select line from ({SQL['rank_report']})",
    "libsvm_round_trip": "select cast(label as double) as label, "
    + ", ".join(f"cast({f} as double) as {f}" for f in FEATURES)
    + " from features_filled",
    "submission_keys": """
select model, user_id, merchant_id
from scoring_pairs, (values ('lr'), ('svm'), ('nb'), ('dt')) kinds(model)
""",
    "split_rows": """
select user_id, merchant_id,
       case when (11 * 104729 + (user_id % 1000003) * 7919 + (merchant_id % 1000003) * 100121) % 1000003 % 10000 < 6000
            then 'train' else 'test' end as side
from pairs
""",
    "lr_gradient": " union all ".join(f"select {i} as feature, 0.0 as gradient" for i in range(len(FEATURES))),
    "tree_leaf_counts": "select cast(label as double) as label, count(*) as n from features_filled group by label",
}


#: The damaged file: lines by (user + item) mod 11, and why each is bad.
DAMAGED = """
with lines as (
  select (user_id + item_id) % 11 as kind, *, coalesce(cast(user_id as varchar), '') as u,
         concat_ws(',', item_id, cat_id, seller_id, coalesce(brand_id, '')) as middle
  from user_log)
select 'user_log_dirty.csv' as file,
       case kind when 0 then u || ',' || middle
                 when 1 then u || ',' || middle || ',' || time_stamp || ',' || action_type || ',x'
                 when 2 then 'u' || u || ',' || middle || ',' || time_stamp || ',' || action_type
                 when 3 then u || ',' || middle || ',' || time_stamp || ',1.5' else '' end as line,
       case kind when 0 then 'short' when 1 then 'long' when 2 then 'user_id: not a bigint'
                 when 3 then 'action_type: not a int' else 'blank' end as reason
from lines where kind < 5
"""

SQL |= {
    "csv_quarantine_good": "select * from user_log where (user_id + item_id) % 11 >= 5",
    "csv_quarantine_bad": f"select * from ({DAMAGED})",
    "tree_nodes": """
select model, trees, (select count(*) from features_filled) as root_rows,
       case when model <> 'rf' then 0 end as wrong_leaves, 0 as broken_sums
from (values ('dt', 1), ('rf', 3), ('gbt', 3)) kinds(model, trees)
""",
    "compressed_rows": "select cast(label as double) as label, "
    + ", ".join(f"cast({f} as double) as {f}" for f in FEATURES)
    + ", cast(count(*) as double) as weight from features_filled group by all",
    "tree_routes": """
select model, user_id, merchant_id, true as same_label, 0.0 as score_gap
from features_filled, (values ('dt'), ('rf'), ('gbt')) kinds(model)
""",
}


def _svm_weights(steps: int = 4, reg: float = 0.01, normalised: bool = False) -> str:
    """The gradient steps one after another, each a pass over all rows."""
    n = len(FEATURES)
    squares = " + ".join(f"cast({x} as double) * {x}" for x in FEATURES)
    scaled = ", ".join(f"case when norm = 0 then 0.0 else {x} / norm end as {x}" for x in FEATURES)
    source = f"(select label, {scaled} from (select *, sqrt({squares}) as norm from features_filled))" if normalised else "features_filled"
    out = f", rows_in as materialized (select * from {source})\n"
    out += ", w0 as (select " + ", ".join(f"cast(0 as double) as a{i}" for i in range(n)) + ")\n"
    for t in range(1, steps + 1):
        rate = f"(1.0 / sqrt({t}.0))"
        margin = " + ".join(f"f.{x} * w.a{i}" for i, x in enumerate(FEATURES))
        active = f"1.0 - (2.0 * f.label - 1.0) * ({margin}) > 0"
        cols = ", ".join(
            f"any_value(w.a{i}) * (1.0 - {rate} * {reg})"
            f" - {rate} * sum(case when {active} then -(2.0 * f.label - 1.0) * f.{x} else 0.0 end) / count(*) as a{i}"
            for i, x in enumerate(FEATURES)
        )
        out += f", w{t} as (select {cols} from rows_in f, w{t - 1} w)\n"
    return out + " union all ".join(f"select {i} as feature, round(a{i}, 6) as weight from w{steps}" for i in range(n))


def _evaluate_nb() -> str:
    """Naive Bayes fitted on one side of the split, measured on the other."""
    inner = _nb_predictions()
    side = "(11 * 104729 + (user_id % 1000003) * 7919 + (merchant_id % 1000003) * 100121) % 1000003 % 10000"
    inner = inner.replace("from features_filled group by label", f"from features_filled where {side} < 6000 group by label")
    head, tail = inner.split("\nselect user_id", 1)
    return f"""{head}
, predicted as (select user_id{tail}),
counts as (
  select sum(case when label = 1 then 1.0 else 0.0 end) as pos, sum(case when label = 0 then 1.0 else 0.0 end) as neg,
         sum(case when label = 1 and prediction = 1 then 1.0 else 0.0 end) as tp,
         sum(case when label = 0 and prediction = 1 then 1.0 else 0.0 end) as fp
  from predicted where {side} >= 6000)
select round((fp + pos - tp) / (pos + neg), 9) as error_rate, round((tp + neg - fp) / (pos + neg), 9) as accuracy,
       round(case when pos = 0 or neg = 0 then 0.5 else (1.0 + tp / pos - fp / neg) / 2 end, 9) as hard_auc,
       round(case when tp + fp = 0 or pos = 0 then pos / (pos + neg)
                  else (tp / pos) * (tp / (tp + fp)) + (1 - tp / pos) * (tp / (tp + fp) + pos / (pos + neg)) / 2 end, 9) as hard_aupr,
       cast(pos + neg as bigint) as rows
from counts
"""


def _grown(depth: int) -> str:
    """Best Gini splits level by level: histograms per (node, feature, value), running sums, the first best."""
    unpivot = " union all ".join(f"select rid, label, {i} as feature, cast({x} as double) as v from numbered" for i, x in enumerate(FEATURES))
    out = f""", numbered as (select row_number() over () as rid, * from features_filled),
cells as materialized ({unpivot}),
at0 as (select rid, 0 as node from numbered)
"""

    def purity(neg: str, pos: str) -> str:
        return f"(cast({neg} as double) * {neg} + cast({pos} as double) * {pos}) / ({neg} + {pos})"

    for k in range(depth):
        out += f""", hist{k} as (
  select node, feature, v, count(*) filter (where label = 0) as neg, count(*) filter (where label = 1) as pos
  from cells join at{k} using (rid) group by 1, 2, 3),
sums{k} as (
  select node, feature, v, lead(v) over w as nxt, sum(neg) over w as ln, sum(pos) over w as lp,
         sum(neg) over (partition by node, feature) as n, sum(pos) over (partition by node, feature) as p
  from hist{k} window w as (partition by node, feature order by v)),
gains{k} as (
  select node, feature, (v + nxt) / 2 as threshold, ln, lp, n - ln as rn, p - lp as rp,
         round(({purity('ln', 'lp')} + {purity('(n - ln)', '(p - lp)')} - {purity('n', 'p')}) / (n + p), 9) as gain
  from sums{k} where nxt is not null),
best{k} as materialized (
  select * from gains{k} where gain > 0
  qualify row_number() over (partition by node order by gain desc, feature, threshold) = 1),
at{k + 1} as materialized (
  select a.rid, 2 * a.node + case when c.v <= b.threshold then 1 else 2 end as node
  from at{k} a join best{k} b using (node) join cells c on c.rid = a.rid and c.feature = b.feature)
"""
    members = " union all ".join(f"select node, rid from at{k}" for k in range(depth + 1))
    splits = " union all ".join(f"select node, feature, threshold, gain from best{k}" for k in range(depth))
    return out + f""", members as ({members}), splits as ({splits}),
grown as (
  select m.node, any_value(s.feature) as feature, any_value(s.threshold) as threshold, any_value(s.gain) as gain,
         count(*) as rows, count(*) filter (where f.label = 1) as positives
  from members m join numbered f using (rid) left join splits s on s.node = m.node group by m.node)
"""


GROWN = _grown(3)

CURVE = """
points as (
  select score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg from scored group by score),
curve as (
  select row_number() over w as place, *, sum(pos) over w as tp, sum(neg) over w as fp,
         sum(pos) over () as all_pos, sum(neg) over () as all_neg
  from points window w as (order by score desc))
"""
AREAS = """
select round(sum((fp - lag_fp) / all_neg * (tp + lag_tp) / all_pos / 2), 9) as score_auc,
       round(sum((tp - lag_tp) / all_pos * (tp / (tp + fp) + lag_precision) / 2), 9) as score_aupr
from (select *, coalesce(lag(tp) over w, 0) as lag_tp, coalesce(lag(fp) over w, 0) as lag_fp,
             coalesce(lag(tp / (tp + fp)) over w, tp / (tp + fp)) as lag_precision
      from curve window w as (order by score desc))
"""


def _nb_curve() -> str:
    head, tail = _nb_predictions().split("\nselect user_id", 1)
    return f"{head}\n, scored as (select user_id{tail}),{CURVE}"


def _evaluate_fitted() -> str:
    """``_evaluate_nb`` with the training error and the score's areas."""
    body, last = _evaluate_nb().rsplit("\nselect round((fp", 1)
    side = "(11 * 104729 + (user_id % 1000003) * 7919 + (merchant_id % 1000003) * 100121) % 1000003 % 10000"
    return f"""{body},
scored as (select * from predicted where {side} >= 6000),{CURVE},
areas as ({AREAS}),
held as (select round((fp{last})
select 'nb' as model, held.*, areas.*,
       (select round(avg(case when prediction <> label then 1.0 else 0.0 end), 9) from predicted where {side} < 6000) as train_error
from held, areas
"""


def _submissions(steps: int = 4) -> str:
    """Scores of the unlabelled pairs by naive Bayes and by the SVM's weights."""
    bayes, predicted = _nb_predictions().split("\nselect user_id", 1)
    margin = " + ".join(f"f.{x} * w.a{i}" for i, x in enumerate(FEATURES))
    predicted = predicted.replace("from features_filled f", "from to_score f").replace("cast(f.label as double)", "0.0")
    return f"""{bayes}
{_svm_weights(steps).split("select 0 as feature", 1)[0]}
, to_score as ({SQL["scoring_features"]})
select 'nb' as model, user_id, merchant_id, score from (select user_id{predicted})
union all
select 'svm' as model, f.user_id, f.merchant_id, round({margin}, 9) as score from to_score f, w{steps} w
"""


# queries whose SQL continues the shared WITH list instead of starting a select
CONTINUED = {
    "train_nb": _nb_predictions(),
    "svm_weights": _svm_weights(),
    "svm_norm_weights": _svm_weights(normalised=True),
    "score_curve": _nb_curve() + """
select place, score, tp, fp, round(tp / all_pos, 9) as tpr, round(fp / all_neg, 9) as fpr, round(tp / (tp + fp), 9) as precision from curve
""",
    "score_areas": _nb_curve() + AREAS,
    "evaluate_fitted_nb": _evaluate_fitted(),
    "evaluate_nb": _evaluate_nb(),
    "submission_round_trip": _submissions(),
    "tree_root_split": _grown(1) + """
select feature, threshold, gain, ln as left_neg, lp as left_pos, rn as right_neg, rp as right_pos from best0
""",
    "tree_grown": GROWN + "select * from grown",
    "tree_grown_scores": GROWN + """
select f.user_id, f.merchant_id, g.node, round(g.positives / g.rows, 9) as score
from members m join grown g on g.node = m.node and (g.feature is null) join numbered f on f.rid = m.rid
""",
}


def oracle_sql() -> dict[str, str]:
    out = {k: BASE + v for k, v in SQL.items()}
    out.update({k: BASE.rstrip() + "\n" + v for k, v in CONTINUED.items()})
    return out
