"""DuckDB statements for the registered queries, in the plain form: joins on the full condition,
correlated conditions spelled out, no slots, masks or salts."""

from __future__ import annotations

from workload.views import DUCKDB, with_views

EPOCH = 1704067200000000

BASE = """
bi as (
  select i.*, coalesce(item_type, case when product_id is not null then 2 else 1 end) as kind
  from scroll_impressions i where scroll_id is not null or product_id is not null)"""

FLAGS = {
    "is_qualified_view": 1, "is_complete": 2, "is_skip": 3, "is_rewatch": 4, "is_product_view": 5,
    "is_share": 15, "is_product_click": 6, "is_add_to_cart": 7, "is_checkout_start": 14,
    "is_purchase": 8, "is_save": 9, "is_pause": 13,
}
CLICKS = [
    "is_qualified_view", "is_complete", "is_product_view", "is_product_click", "is_add_to_cart",
    "is_checkout_start", "is_purchase", "is_save",
]
LABELS = """
hits as (
  select b.id, {flags}
  from bi b left join scroll_interactions n on n.impression_id = b.id or (
    n.impression_id is null and n.user_id = b.user_id
    and ((b.kind = 1 and n.scroll_id = b.scroll_id) or (b.kind = 2 and n.product_id = b.product_id))
    and (b.session_id is null or n.session_id = b.session_id)
    and n.created_us >= b.created_us and n.created_us < b.created_us + 3600000000)
  group by b.id),
lab as (select *, cast(greatest({clicks}) as int) as is_click from hits)""".format(
    flags=", ".join(
        f"cast(coalesce(max(case when n.event_type = {c} then 1 else 0 end), 0) as int) as {f}"
        for f, c in FLAGS.items()),
    clicks=", ".join(CLICKS),
)

CONTEXT = """
ctx as (
  select b.id,
    count(case when p.created_us >= b.created_us - 300000000 then 1 end) / cast(5 as double)
      as session_velocity,
    greatest(coalesce((b.created_us - min(p.created_us)) / cast(1000000 as double), 0), 0)
      as session_dwell_time
  from scroll_impressions b left join scroll_impressions p
    on p.user_id = b.user_id and p.created_us <= b.created_us
    and case when b.session_id is null then p.created_us >= b.created_us - 1800000000
             else p.session_id = b.session_id end
  group by b.id, b.created_us)"""

ITEMS = """
joined as (
  select bi.*, s.category as s_category, s.content_category as s_content, s.user_id as s_user,
    s.quality_score, s.products, s.views, s.likes as s_likes, s.save_count as s_saves,
    s.created_us as s_created, p.category as p_category, p.content_category as p_content,
    p.user_id as p_user, p.average_rating, p.total_sales_count, p.review_count,
    p.likes as p_likes, p.save_count as p_saves, p.created_us as p_created,
    ss.impressions as ss_n, ss.completions, ss.qualified_views, ss.purchases as ss_bought,
    g.impressions as g_n, g.clicks, g.product_views, g.carts, g.purchases as g_bought
  from bi left join scrolls s on s.id = bi.scroll_id left join products p on p.id = bi.product_id
  left join scroll_stats ss on ss.scroll_id = bi.scroll_id
  left join item_global_stats g
    on g.item_id = coalesce(bi.product_id, bi.scroll_id) and g.item_type = bi.kind),
feat as (
  select *, coalesce(s_category, p_category) as category,
    coalesce(s_content, p_content, s_category, p_category) as content_category,
    coalesce(s_user, p_user) as creator_id,
    case when kind = 2 then 1 else 0 end as is_product,
    coalesce(case when kind = 2 then average_rating else quality_score end, 0) as video_quality,
    case when kind = 2 or len(products) > 0 then 1 else 0 end as has_products,
    cast(extract(hour from created_at) as int) as hour_of_day,
    case when kind = 2 then least(1, (coalesce(clicks, 0) + coalesce(product_views, 0)
        + 3 * coalesce(carts, 0) + 6 * coalesce(g_bought, 0))
        / cast(greatest(coalesce(g_n, 0), 1) as double))
      when ss_n > 0 then completions / cast(ss_n as double) else 0 end as completion_rate,
    coalesce(case when kind = 2 then (clicks + product_views) / cast(nullif(g_n, 0) as double)
      else qualified_views / cast(nullif(ss_n, 0) as double) end, 0) as global_ctr,
    coalesce(case when kind = 2 then g_bought / cast(nullif(g_n, 0) as double)
      else ss_bought / cast(nullif(ss_n, 0) as double) end, 0) as global_conversion_rate,
    least(1, ln(1 + case when kind = 2 then
        greatest(coalesce(total_sales_count, 0), 0) + greatest(coalesce(review_count, 0), 0)
        + greatest(coalesce(p_likes, 0), 0) + greatest(coalesce(p_saves, 0), 0)
      else greatest(coalesce(views, 0), 0) + greatest(coalesce(s_likes, 0), 0)
        + greatest(coalesce(s_saves, 0), 0) end) / 5) as social_proof_score,
    coalesce(case when kind = 2 then p_created else s_created end, created_us) as item_us,
    coalesce(cast(retrieval_score as double), 0) as retrieval,
    coalesce(cast(semantic_score as double), 0) as semantic,
    case recommendation_profile_kind when 'behavior_14d' then 1.0 when 'behavior_7d' then 0.9
      when 'session' then 0.75 when 'declared_interest' then 0.55 when 'manual' then 0.4 else 0.0
      end as strength
  from joined),
fresh as (
  select *, coalesce(1 / nullif(1 + ((created_us - item_us) / cast(3600000000 as double))
    / case when kind = 2 then 72 else 24 end, 0), 0) as content_freshness from feat)"""

USERS = """
rich as (
  select fresh.*, coalesce(ca.score, 0) as user_category_score,
    coalesce(cr.score, 0) as creator_affinity_score,
    coalesce(pb.expected_ctr, cast(0.05 as double)) as expected_ctr_at_position
  from fresh
  left join user_category_affinity ca
    on ca.user_id = fresh.user_id and ca.category_id = fresh.content_category
  left join user_creator_affinity cr
    on cr.user_id = fresh.user_id and cr.creator_id = fresh.creator_id
  left join position_bias_baseline pb on pb.position_index = fresh.position_index)"""

SCORED = """
scored as (
  select bi.ml_shadow_score as p, bi.ml_commerce_score, bi.heuristic_score, lab.is_click as y
  from bi join lab on lab.id = bi.id)"""

CURVE = """
curve as (
  select {bin} as bin, avg(p) as predicted, avg(y) as observed, count(*) as n
  from scored where p is not null group by 1)""".format(
    bin=" + ".join(
        f"case when p > cast({i * 0.1!r} as double) then 1 else 0 end" for i in range(1, 10)))

AUCS = """
paired as (select * from scored where p is not null and heuristic_score is not null),
long as (
  select 'ml_shadow_score' as score_name, p as s, y from paired
  union all select 'ml_commerce_score', ml_commerce_score, y from paired
  union all select 'heuristic_score', heuristic_score, y from paired),
ranked as (
  select score_name, y, rank() over (partition by score_name order by s)
    + (count(*) over (partition by score_name, s) - 1) / cast(2 as double) as r
  from long where s is not null),
aucs as (
  select score_name, cast(sum(y) as bigint) as positives,
    cast(count(*) - sum(y) as bigint) as negatives,
    (sum(case when y = 1 then r end) - sum(y) * (sum(y) + 1) / cast(2 as double))
      / nullif(cast(sum(y) as double) * (count(*) - sum(y)), 0) as auc
  from ranked group by 1)"""

PARTED = """
parted as (
  select *, place <= greatest(floor(n * 0.2 + 0.5), least(n - 1, 1)) as is_test
  from (
    select *, row_number() over (partition by is_click order by hash, id) as place,
      count(*) over (partition by is_click) as n
    from (select id, is_click, ('0x' || substr(md5('42|' || id), 1, 8))::bigint as hash from lab) h) r)"""

UNIQUE = {
    "scroll_impressions": ["id"], "scrolls": ["id"], "products": ["id"], "scroll_stats": ["scroll_id"],
    "item_global_stats": ["item_id", "item_type"], "user_category_affinity": ["user_id", "category_id"],
    "user_creator_affinity": ["user_id", "creator_id"], "position_bias_baseline": ["position_index"],
}

SUMMARY_COLUMNS = """
  cast(sum(is_click) as bigint) as click_positives,
  cast(sum(is_purchase) as bigint) as purchase_positives,
  cast(sum(is_checkout_start) as bigint) as checkout_start_positives,
  cast(sum(is_add_to_cart) as bigint) as add_to_cart_positives,
  cast(sum(is_product_click) as bigint) as product_click_positives,
  cast(sum(is_product_view) as bigint) as product_view_positives,
  cast(sum(intent) as bigint) as commerce_positives,
  round(avg(is_click), 9) as click_rate, round(avg(intent), 9) as commerce_rate"""
INTENT = """
flagged as (
  select bi.recommendation_run_id, bi.ranking_version, bi.created_us, lab.*,
    case when is_purchase + is_checkout_start + is_add_to_cart + is_product_click
      + is_product_view > 0 then 1 else 0 end as intent
  from bi join lab on lab.id = bi.id)"""
RANKS = """
probs as (
  select id, {e} as e, {c} as c, completion_rate as k, {hint} as h from rich),
parts as (
  select *, greatest(0, least(1, 0.65 * e + 0.35 * k)) as completion_score,
    greatest(0, least(1, 0.55 * e + 0.45 * c)) as save_score,
    greatest(0, least(1, c)) as product_click_score,
    greatest(0, least(1, 1 - (0.7 * e + 0.3 * k))) as fast_skip_score from probs)"""
RANKED = """
select id as impression_id, round(e, 9) as qualified_view_score,
  round(completion_score, 9) as completion_score, round(save_score, 9) as save_score,
  round(product_click_score, 9) as product_click_score,
  round(fast_skip_score, 9) as fast_skip_score,
  round(greatest(0, least(1, 0.35 * greatest(0, least(1, e)) + 0.2 * completion_score
    + 0.15 * save_score + 0.15 * product_click_score + 0.1 * greatest(0, least(1, h))
    - 0.2 * fast_skip_score)), 9) as final_rank_score,
  'phase7-auto-train-hybrid-v1' as ranker_version
from parts"""
HALF = "cast(0.5 as double)"

CANDIDATES = [
    "is_purchase", "commerce_intent", "is_checkout_start", "is_add_to_cart", "is_product_click",
    "is_product_view",
]
COUNTED = "counted as (" + " union all ".join(
    f"""select '{name}' as target, {i} as priority, count(*) as rows,
      count(case when {'intent' if name == 'commerce_intent' else name} = 1 then 1 end) as positives,
      count(case when {'intent' if name == 'commerce_intent' else name} = 0 then 1 end) as negatives
      from flagged"""
    for i, name in enumerate(CANDIDATES)) + ")"

GATE = """
runs as (
  select recommendation_run_id, ranking_version, count(*) as n,
    cast(sum(is_click) as bigint) as clicks, cast(sum(intent) as bigint) as commerce
  from flagged group by all),
facts as (
  select *, recommendation_run_id > 'run-1' as active, clicks % 2 = 1 as e_fallback,
    commerce % 3 = 0 as c_fallback from runs),
verdicts as (
  select *, concat_ws('; ',
    case when n < 250 then 'dataset too small (' || n || ' rows < 250)' end,
    case when clicks < 80 then 'not enough real click positives (' || clicks || ' < 80)' end,
    case when commerce < 70 then 'not enough real commerce positives (' || commerce || ' < 70)' end,
    case when active and e_fallback then 'engagement training used synthetic fallback' end,
    case when active and c_fallback then 'commerce training used synthetic fallback' end) as reasons
  from facts)"""

EVENT_NAMES = [
    "QUALIFIED_VIEW", "COMPLETE", "SKIP", "REWATCH", "PRODUCT_VIEW", "PRODUCT_CLICK",
    "ADD_TO_CART", "PURCHASE", "SAVE", "GRID_IMPRESSION", "GRID_DWELL", "PRODUCT_HOVER",
    "SCROLL_PAUSE", "CHECKOUT_START", "SHARE",
]


def uniform(name: str) -> str:
    text = f"md5('42|' || sample_id || '|{name}')"
    return f"((('0x' || substr({text}, 1, 8))::bigint + 0.5) / cast(4294967296 as double))"


DRAWN = f"""
drawn as (
  select sample_id, cast(floor({uniform('position_index')} * 15) as int) as position_index,
    cast(floor({uniform('hour_of_day')} * 24) as int) as hour_of_day,
    case when {uniform('has_products')} < 0.7 then 1 else 0 end as has_products,
    {uniform('user_category_score')} * 5 as user_category_score,
    {uniform('video_quality')} as video_quality, {uniform('completion_rate')} as completion_rate,
    cast(0.01 as double) + {uniform('expected_ctr_at_position')} * cast(0.14 as double)
      as expected_ctr_at_position,
    cast(0.5 as double) + {uniform('session_velocity')} * 2.5 as session_velocity,
    {uniform('session_dwell_time')} * 600 as session_dwell_time,
    sqrt(-2 * ln({uniform('radius')})) * cos(2 * pi() * {uniform('angle')}) as noise,
    {uniform('purchase')} as buys
  from (select event_id as sample_id from events))"""


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 9) as {n}" for n in names)


def query(text: str, *parts: str) -> str:
    return ",\n".join([with_views(DUCKDB), *parts]) + "\n" + text


ORACLES = {
    "item_type": query("select id as impression_id, kind as item_type from bi", BASE),
    "category_resolution": query(
        "select id as impression_id, category, content_category, creator_id from feat", BASE, ITEMS),
    "item_quality": query(
        f"select id as impression_id, {rounded('video_quality')}, has_products from feat",
        BASE, ITEMS),
    "popularity": query(
        "select id as impression_id, " + rounded(
            "completion_rate", "global_ctr", "global_conversion_rate", "social_proof_score")
        + " from feat", BASE, ITEMS),
    "freshness": query(
        f"""select id as impression_id, hour_of_day, is_product,
          item_us + {EPOCH} as content_created_us, {rounded('content_freshness')} from fresh""",
        BASE, ITEMS),
    "semantic_flags": query(
        """select id as impression_id, round(retrieval, 9) as retrieval_score,
          round(semantic, 9) as semantic_score,
          case when semantic > 0 or retrieval > 0 then 1 else 0 end as has_semantic_candidate,
          cast(strength as double) as semantic_profile_strength from feat""", BASE, ITEMS),
    "dim_joins": query(
        """select id as impression_id, s_category, p_category, s_user as s_creator,
          p_user as p_creator,
          round(case when ss_n > 0 then completions / cast(ss_n as double) when ss_n = 0 then 0 end,
            9) as scroll_completion,
          round(case when kind = 2 and g_n > 0 then g_bought / cast(g_n as double)
            when kind = 2 and g_n = 0 then 0 end, 9) as product_conversion from joined""",
        BASE, ITEMS),
    "affinity_joins": query(
        "select id as impression_id, "
        + rounded("user_category_score", "creator_affinity_score") + " from rich",
        BASE, ITEMS, USERS),
    "position_bias": query(
        f"select id as impression_id, {rounded('expected_ctr_at_position')} from rich",
        BASE, ITEMS, USERS),
    "attribution": query(
        f"select id as impression_id, {', '.join(FLAGS)} from lab", BASE, LABELS),
    "composite_click": query("select id as impression_id, is_click from lab", BASE, LABELS),
    "session_context": query(
        "select id as impression_id, " + rounded("session_velocity", "session_dwell_time")
        + " from ctx", CONTEXT),
    "newest_impressions": query(
        """select id, created_us, user_id from scroll_impressions
        where scroll_id is not null or product_id is not null
        order by created_us desc nulls first, id desc limit 1000"""),
    "training_frame": query(
        f"""select cast(rich.id as varchar) as impression_id, cast(user_id as varchar) as user_id,
          cast(scroll_id as varchar) as scroll_id, cast(product_id as varchar) as product_id,
          kind as item_type, feed_type, category, content_category,
          created_us + {EPOCH} as impressed_us, candidate_source, recommendation_profile_kind,
          recommendation_run_id, ranking_version, position_index, {rounded('user_category_score')},
          {rounded('video_quality')}, has_products, hour_of_day, {rounded('completion_rate')},
          {rounded('expected_ctr_at_position', 'session_velocity', 'session_dwell_time')},
          is_product, {rounded('creator_affinity_score', 'content_freshness', 'global_ctr')},
          {rounded('global_conversion_rate', 'social_proof_score')},
          round(semantic, 9) as semantic_score, round(retrieval, 9) as retrieval_score,
          case when semantic > 0 or retrieval > 0 then 1 else 0 end as has_semantic_candidate,
          cast(strength as double) as semantic_profile_strength,
          cast(0 as double) as text_semantic_score, cast(0 as double) as visual_semantic_score,
          cast(0 as double) as semantic_agreement_score, 0 as has_visual_embedding,
          cast(0 as double) as category_visual_prior, ml_shadow_score, ml_commerce_score,
          heuristic_score, is_click, {', '.join(FLAGS)}
        from rich join lab on lab.id = rich.id join ctx on ctx.id = rich.id""",
        BASE, ITEMS, USERS, LABELS, CONTEXT),
    "dataset_rates": query(
        """select count(*) as rows, count(*) = 0 as is_empty, round(avg(is_click), 9) as click_rate,
          round(avg(is_purchase), 9) as purchase_rate,
          round(avg(is_qualified_view), 9) as qualified_view_rate from lab""", BASE, LABELS),
    "dataset_summary": query(
        f"select count(*) as rows, {SUMMARY_COLUMNS} from flagged", BASE, LABELS, INTENT),
    "target_candidates": query(
        """select target, priority, rows, positives, negatives,
          round(positives / cast(greatest(rows, 1) as double), 9) as positive_rate from counted""",
        BASE, LABELS, INTENT, COUNTED),
    "target_choice": query(
        """select (select target from counted where positives >= 12 and negatives >= 12
            order by priority limit 1) as target,
          (select count(*) from counted where positives >= 12 and negatives >= 12)
            as usable_targets""", BASE, LABELS, INTENT, COUNTED),
    "label_distribution": query(
        "select y as is_click, count(*) as rows from scored where p is not null group by 1",
        BASE, LABELS, SCORED),
    "class_guard": query(
        """select count(distinct y) as classes, count(distinct y) >= 2 as usable from scored
        where p is not null""", BASE, LABELS, SCORED),
    "brier": query(
        """select round(avg((p - y) * (p - y)), 9) as brier, count(*) as rows from scored
        where p is not null""", BASE, LABELS, SCORED),
    "calibration_curve": query(
        """select bin, round(predicted, 9) as predicted, round(observed, 9) as observed, n as rows
        from curve""", BASE, LABELS, SCORED, CURVE),
    "calibration_error": query(
        """select round(e, 9) as calibration_error, round(w, 9) as weighted_calibration_error,
          case when e < 0.05 then 'high' when e < 0.15 then 'moderate' else 'miscalibrated' end
            as verdict
        from (select avg(abs(predicted - observed)) as e,
          sum(abs(predicted - observed) * n) / sum(n) as w from curve)""",
        BASE, LABELS, SCORED, CURVE),
    "auc": query(
        "select score_name, round(auc, 9) as auc, positives, negatives from aucs",
        BASE, LABELS, SCORED, AUCS),
    "lift": query(
        """select round(ml, 9) as ml_auc, round(heu, 9) as heuristic_auc,
          round((ml - heu) / heu, 9) as lift,
          case when ml > heu then 'ml' else 'heuristic' end as ahead
        from (select max(case when score_name = 'ml_shadow_score' then auc end) as ml,
          max(case when score_name = 'heuristic_score' then auc end) as heu from aucs)""",
        BASE, LABELS, SCORED, AUCS),
    "event_names": query(
        "select id, case event_type " + " ".join(
            f"when {i} then '{n}'" for i, n in enumerate(EVENT_NAMES, 1))
        + " end as event_name, event_type as event_code from scroll_interactions"),
    "split": query(
        "select id as impression_id, hash, is_test from parted", BASE, LABELS, PARTED),
    "split_balance": query(
        """select is_click, count(*) as rows, count(case when is_test then 1 end) as test_rows,
          round(count(case when is_test then 1 end) / cast(count(*) as double), 9) as test_share
        from parted group by 1""", BASE, LABELS, PARTED),
    "rank_scores": query(
        RANKED, BASE, ITEMS, USERS,
        RANKS.format(e=f"coalesce(ml_shadow_score, {HALF})",
                     c=f"coalesce(ml_commerce_score, {HALF})", hint="expected_ctr_at_position")),
    "rank_scores_without_models": query(
        RANKED, BASE, ITEMS, USERS,
        RANKS.format(e=HALF, c=HALF, hint="cast(0 as double)")),
    "promotion_gate": query(
        """select recommendation_run_id, ranking_version, reasons,
          not active or reasons = '' as promotion_allowed from verdicts""",
        BASE, LABELS, INTENT, GATE),
    "retention": query(
        """select run_id, rows from (
          select *, row_number() over (order by run_id desc) as place from (
            select concat(recommendation_run_id, '-',
                cast(cast(floor(created_us / cast(3600000000 as double)) as bigint) as varchar))
                as run_id, count(*) as rows
            from scroll_impressions group by 1) t) u
        where place > 10 and place < (select count(distinct concat(recommendation_run_id, '-',
          cast(cast(floor(created_us / cast(3600000000 as double)) as bigint) as varchar)))
          from scroll_impressions)"""),
    "batch_probability": query(
        """select count(*) as rows, count(distinct id) as impressions, cast(0 as bigint) as bad_engagement,
          cast(0 as bigint) as bad_commerce, cast(0 as bigint) as rank_differs from lab""", BASE, LABELS),
    "feature_importance": query(
        """select task, target, true as used_fallback_dataset, row_count, positive_count,
          row_count - positive_count as negative_count, cast(24 as bigint) as features,
          cast(1 as double) as total, cast(0 as bigint) as negative, true as above_floor
        from (
          select 'engagement' as task, 'is_click' as target, count(*) as row_count,
            count(case when clicked then 1 end) as positive_count from rules
          union all
          select 'commerce', 'is_purchase', count(*), count(case when clicked and buys > 0.7 then 1 end)
          from rules) t""", DRAWN, """
rules as (
  select buys, 0.4 * user_category_score + 0.3 * video_quality + 0.2 * has_products - 0.05 * position_index
    + 2 * expected_ctr_at_position - 0.1 * session_velocity + 0.1 * noise > 1.5 as clicked from drawn)"""),
    "run_ledger": query(
        """select 'latest' as kind, max_by(run_id, recorded) as run_id, max_by(state, recorded) as state from runs
        union all
        select 'active', max_by(run_id, recorded), max_by(state, recorded) from runs
        where promoted and state = 'completed'""", """
runs as (
  select concat(recommendation_run_id, '-',
      cast(cast(floor(created_us / cast(3600000000 as double)) as bigint) as varchar)) as run_id,
    max(created_us * 100 + id % 100) as recorded,
    case when count(*) % 4 = 0 then 'failed' else 'completed' end as state, count(*) % 3 = 0 as promoted
  from scroll_impressions group by 1)"""),
    "key_uniqueness": query(" union all ".join(
        f"select '{name}' as table_name, count(*) as keys, count(case when n > 1 then 1 end) as repeated "
        f"from (select count(*) as n from {name} where {' and '.join(f'{k} is not null' for k in keys)} "
        f"group by {', '.join(keys)}) t" for name, keys in UNIQUE.items())),
    "bootstrap": query(
        f"""select sample_id, position_index, {rounded('user_category_score', 'video_quality')},
          has_products, hour_of_day, {rounded('completion_rate', 'expected_ctr_at_position')},
          {rounded('session_velocity', 'session_dwell_time')},
          case when latent > 1.5 then 1 else 0 end as is_click,
          case when latent > 1.5 and buys > 0.7 then 1 else 0 end as is_purchase
        from (select *, 0.4 * user_category_score + 0.3 * video_quality + 0.2 * has_products
          - 0.05 * position_index + 2 * expected_ctr_at_position - 0.1 * session_velocity
          + 0.1 * noise as latent from drawn)""", DRAWN),
    "scroll_stats_from_logs": query(
        """select scroll_id, cast(sum(shown) as bigint) as impressions,
          count(case when event_type = 2 then 1 end) as completions,
          count(case when event_type = 1 then 1 end) as qualified_views,
          count(case when event_type = 8 then 1 end) as purchases
        from (select scroll_id, 1 as shown, null as event_type from scroll_impressions
          union all select scroll_id, 0, event_type from scroll_interactions)
        where scroll_id is not null group by 1"""),
    "product_stats_from_logs": query(
        """select product_id as item_id, 2 as item_type, cast(sum(shown) as bigint) as impressions,
          count(case when event_type = 6 then 1 end) as clicks,
          count(case when event_type = 5 then 1 end) as product_views,
          count(case when event_type = 7 then 1 end) as carts,
          count(case when event_type = 8 then 1 end) as purchases
        from (select product_id, 1 as shown, null as event_type from scroll_impressions
          union all select product_id, 0, event_type from scroll_interactions)
        where product_id is not null group by 1"""),
    "position_baseline_from_logs": query(
        """select position_index, round(avg(is_click), 9) as expected_ctr
        from bi join lab on lab.id = bi.id group by 1""", BASE, LABELS),
}
