"""DuckDB SQL oracle for every registered query.

Each view of ``martline.sources.views`` is restated here as a CTE; a query's
oracle is ``WITH <the views it needs> <select>``.  Tables are the driver's
pre-registered views (region nation customer supplier part orders lineitem
events ...).
"""

from __future__ import annotations

import re

V = {}

V["geo"] = """geo AS (
  SELECT n.n_nationkey, n.n_name AS dma_name, r.r_name AS state
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

V["v_txn"] = """v_txn AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, l.l_shipdate AS order_datetime,
         CAST(l.l_orderkey AS VARCHAR) AS order_id, CAST(o.o_custkey AS VARCHAR) AS user_id,
         g.dma_name, g.state,
         lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
         p.p_type AS product_category,
         CASE WHEN p.p_size <= 12 THEN 'XS' WHEN p.p_size <= 25 THEN 'S' WHEN p.p_size <= 37 THEN 'M' ELSE 'L' END AS size,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) - CAST(250 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS unit_cost,
         CASE WHEN l.l_discount >= 0.05 THEN CAST(l.l_discount * 10000 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS discount_per_unit,
         CAST(CAST(CAST(l.l_quantity AS BIGINT) AS DECIMAL(18,0)) * (CAST(p.p_retailprice AS DECIMAL(18,2))
              - CASE WHEN l.l_discount >= 0.05 THEN CAST(l.l_discount * 10000 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END)
              AS DECIMAL(18,2)) AS line_revenue,
         CAST(CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END AS INTEGER) AS promo_flag
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN geo g ON c.c_nationkey = g.n_nationkey
       JOIN part p ON l.l_partkey = p.p_partkey)"""

V["ev"] = """ev AS (
  SELECT event_id, ts - INTERVAL 9496 DAY AS ts, user_id, event_type, value, props,
         TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k
  FROM events)"""

V["v_web"] = """v_web AS (
  SELECT CAST(e.ts AS DATE) AS date, e.ts AS event_datetime, CAST(e.user_id AS VARCHAR) AS user_id,
         CAST(e.user_id AS VARCHAR) || '-' || strftime(CAST(e.ts AS DATE), '%Y%m%d') AS session_id,
         '/' || e.event_type || '/' || CAST(e.k AS VARCHAR) AS page_url,
         CASE e.event_type WHEN 'click' THEN 'instagram' WHEN 'view' THEN 'google' WHEN 'signup' THEN 'email'
              WHEN 'purchase' THEN 'direct' ELSE 'partner' END AS traffic_source,
         CASE WHEN e.k % 3 = 0 THEN 'cpc' WHEN e.k % 3 = 1 THEN 'organic' ELSE 'referral' END AS traffic_medium,
         CASE WHEN e.k % 6 = 1 THEN 'Always On' WHEN e.k % 6 = 2 THEN 'BTS 2023' WHEN e.k % 6 = 3 THEN 'BTS 2024'
              WHEN e.k % 6 = 4 THEN 'Black Friday 2023' WHEN e.k % 6 = 5 THEN 'Email Promo' END AS campaign,
         CASE WHEN e.user_id % 3 = 0 THEN 'desktop' WHEN e.user_id % 3 = 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
         g.dma_name, g.state,
         lpad(CAST((e.user_id * 37) % 100000 AS VARCHAR), 5, '0') AS zip_code
  FROM ev e JOIN geo g ON e.user_id % 25 = g.n_nationkey)"""

V["v_web_parts"] = """v_web_parts AS (
  SELECT *, 'web_a' AS _source FROM v_web WHERE event_datetime < TIMESTAMP '1998-01-21 00:00:00'
  UNION ALL
  SELECT *, 'web_b' AS _source FROM v_web WHERE event_datetime >= TIMESTAMP '1998-01-15 00:00:00')"""

V["web_events"] = """web_events AS (
  SELECT date, event_datetime, user_id, session_id, page_url, traffic_source, traffic_medium, campaign,
         device_category, dma_name, state, zip_code
  FROM v_web_parts
  WHERE NOT (_source = 'web_b' AND CAST(event_datetime AS DATE) BETWEEN DATE '1998-01-15' AND DATE '1998-01-20'))"""

V["web_daily"] = """web_daily AS (
  SELECT date, traffic_source, traffic_medium, campaign, device_category, dma_name, state,
         count(event_datetime) AS pageviews, count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users
  FROM web_events GROUP BY ALL)"""

V["v_posts"] = """v_posts AS (
  SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS post_id, 'post ' || event_type AS caption,
         CAST(round(value * 100) AS BIGINT) AS followers, CAST(round(value * 1000) AS BIGINT) AS impressions,
         CAST(k * 10 AS BIGINT) AS video_views, CAST(k AS BIGINT) AS video_completes,
         event_id % 50 AS likes, event_id % 7 AS comments, event_id % 11 AS shares,
         CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS clicks,
         CAST(k % 4 AS BIGINT) AS saves
  FROM ev)"""

V["v_mentions"] = """v_mentions AS (
  SELECT CASE event_type WHEN 'click' THEN 'Morning Drive GA' WHEN 'view' THEN 'Inside the ATL Hour'
              WHEN 'signup' THEN 'Peach State Weekly' WHEN 'purchase' THEN 'Coastal Living Talk'
              ELSE 'Trendline Radio' END AS podcast_name,
         'Episode ' || CAST(user_id AS VARCHAR) AS episode_title,
         CAST(CAST(ts AS DATE) - CAST(user_id % 3 AS INTEGER) AS DATE) AS episode_release_date,
         ts AS mention_datetime,
         'host_' || CAST(event_id % 7 AS VARCHAR) AS host_name,
         CAST(CASE WHEN value >= 25 THEN 1 ELSE 0 END AS INTEGER) AS mentions_brand,
         CAST(event_id % 2 AS INTEGER) AS mentions_founder,
         props AS transcript_snippet,
         CAST(round(value * 1000) AS BIGINT) AS estimated_impressions,
         CAST(k % 50 AS DOUBLE) / 10 AS episode_rating,
         CASE WHEN value < 10 THEN 'negative' WHEN value < 30 THEN 'neutral' ELSE 'positive' END AS sentiment
  FROM ev)"""

V["organic_daily"] = """organic_daily AS (
  SELECT date, count(DISTINCT post_id) AS posts, max(followers) AS followers_eod,
         CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(video_views) AS BIGINT) AS video_views,
         CAST(sum(video_completes) AS BIGINT) AS video_completes, CAST(sum(likes) AS BIGINT) AS likes,
         CAST(sum(comments) AS BIGINT) AS comments, CAST(sum(shares) AS BIGINT) AS shares,
         CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(saves) AS BIGINT) AS saves
  FROM v_posts WHERE date IS NOT NULL GROUP BY date)"""

V["podcast_daily"] = """podcast_daily AS (
  SELECT CAST(mention_datetime AS DATE) AS date, podcast_name, episode_title,
         arg_min(host_name, mention_datetime) FILTER (WHERE host_name IS NOT NULL) AS host_name,
         max(mentions_brand) AS mentions_brand, max(mentions_founder) AS mentions_founder,
         arg_min(sentiment, mention_datetime) FILTER (WHERE sentiment IS NOT NULL) AS sentiment,
         CAST(coalesce(sum(estimated_impressions), 0) AS BIGINT) AS estimated_impressions,
         arg_min(episode_rating, mention_datetime) FILTER (WHERE episode_rating IS NOT NULL) AS episode_rating,
         count(podcast_name) AS mentions
  FROM v_mentions
  WHERE CAST(mention_datetime AS DATE) IS NOT NULL AND podcast_name IS NOT NULL AND episode_title IS NOT NULL
  GROUP BY ALL)"""

V["paid_base"] = """paid_base AS (
  SELECT date, channel, campaign_name, campaign_id, dma_name, state, optimization_goal,
         sum(_spend) AS spend, CAST(sum(l_quantity) AS BIGINT) * 100 AS impressions, count(*) AS clicks,
         CAST(sum(l_linenumber) AS BIGINT) AS video_views,
         count(*) FILTER (WHERE l_linenumber >= 2) AS video_25pct,
         count(*) FILTER (WHERE l_linenumber >= 3) AS video_50pct,
         count(*) FILTER (WHERE l_linenumber >= 4) AS video_75pct,
         count(*) FILTER (WHERE l_linenumber >= 5) AS video_completes,
         '25-44' AS age_target,
         CASE WHEN contains(campaign_name, 'Teen') THEN 'teens' ELSE 'parents' END AS audience_segment,
         lower(channel) || '_part' || CAST(year(date) % 3 + 1 AS VARCHAR) AS _file
  FROM (
    SELECT CAST(l.l_shipdate AS DATE) AS date,
           CASE l.l_suppkey % 3 WHEN 0 THEN 'Instagram' WHEN 1 THEN 'Pinterest' ELSE 'TikTok' END AS channel,
           CASE l.l_suppkey % 3 WHEN 0 THEN 'Instagram' WHEN 1 THEN 'Pinterest' ELSE 'TikTok' END || ' ' ||
           CASE l.l_partkey % 3 WHEN 0 THEN 'Always On' WHEN 1 THEN 'BTS Moms' ELSE 'Teen Trends' END AS campaign_name,
           upper(substr(CASE l.l_suppkey % 3 WHEN 0 THEN 'Instagram' WHEN 1 THEN 'Pinterest' ELSE 'TikTok' END, 1, 2))
             || '_' || CAST(l.l_partkey % 3 + 1001 AS VARCHAR) AS campaign_id,
           g.dma_name, g.state,
           CASE l.l_partkey % 3 WHEN 0 THEN 'awareness' WHEN 1 THEN 'conversions' ELSE 'traffic' END AS optimization_goal,
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS _spend, l.l_quantity, l.l_linenumber
    FROM lineitem l JOIN geo g ON l.l_orderkey % 25 = g.n_nationkey) t
  GROUP BY date, channel, campaign_name, campaign_id, dma_name, state, optimization_goal)"""

V["paid_social"] = """paid_social AS (
  SELECT date, channel, campaign_name, campaign_id, dma_name, state, spend, impressions, clicks, video_views,
         CASE WHEN _file = 'pinterest_part1' THEN NULL ELSE video_25pct END AS video_25pct,
         CASE WHEN _file = 'pinterest_part1' THEN NULL ELSE video_50pct END AS video_50pct,
         video_75pct, video_completes,
         CASE WHEN _file = 'tiktok_part2' THEN NULL ELSE optimization_goal END AS optimization_goal,
         age_target, audience_segment, _file
  FROM paid_base)"""

V["v_ooh_weekly"] = """v_ooh_weekly AS (
  SELECT w.week_start_date, 'AP' || CAST(s.s_suppkey AS VARCHAR) AS airport_code,
         'Airport ' || s.s_name AS airport_name,
         CASE WHEN s.s_suppkey % 3 = 0 THEN 'digital' WHEN s.s_suppkey % 3 = 1 THEN 'static' ELSE 'spectacular' END AS format,
         CASE WHEN s.s_nationkey % 2 = 0 THEN 'business' ELSE 'leisure' END AS audience_segment,
         w.spend, w.impressions, w.placements
  FROM (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start_date, l_suppkey,
               sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend,
               CAST(sum(l_quantity) AS BIGINT) * 1000 AS impressions, count(*) AS placements
        FROM lineitem GROUP BY ALL) w
  JOIN supplier s ON w.l_suppkey = s.s_suppkey)"""

V["airport_lookup"] = """airport_lookup AS (
  SELECT trim(' AP' || CAST(s.s_suppkey AS VARCHAR) || ' ') AS iata_code,
         'Airport ' || s.s_name AS name, lower(n.n_name) AS municipality,
         regexp_replace(CASE WHEN s.s_suppkey % 4 = 0 THEN n.n_name ELSE 'US-' || n.n_name END, '^[^-]*-', '') AS state,
         'US' AS iso_country
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE trim(' AP' || CAST(s.s_suppkey AS VARCHAR) || ' ') IN
        (SELECT 'AP' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal >= 0))"""

V["airports_raw"] = V["airport_lookup"].replace("airport_lookup AS", "airports_raw AS").split("\n  WHERE")[0] + ")"
V["all_airports"] = V["airports_raw"].replace("airports_raw AS", "all_airports AS")

V["ooh_daily"] = """ooh_daily AS (
  SELECT CAST(w.week_start_date + d.i AS DATE) AS date, w.airport_code, w.airport_name, lk.state,
         w.format, w.audience_segment,
         CAST(w.spend AS DOUBLE) / 7.0 AS spend, CAST(w.impressions AS DOUBLE) / 7.0 AS impressions, w.placements
  FROM v_ooh_weekly w LEFT JOIN airport_lookup lk ON w.airport_code = lk.iata_code
  CROSS JOIN (SELECT CAST(unnest(range(7)) AS INTEGER) AS i) d)"""

V["ecommerce_daily"] = """ecommerce_daily AS (
  SELECT date, dma_name, state, product_category, size, promo_flag,
         count(DISTINCT order_id) AS orders, count(order_id) AS line_items,
         CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_quantity,
         CAST(coalesce(sum(line_revenue), 0) AS DOUBLE) AS gross_revenue,
         CAST(coalesce(sum(discount_per_unit * quantity), 0) AS DOUBLE) AS total_discount,
         CAST(coalesce(sum(unit_cost * quantity), 0) AS DOUBLE) AS total_cost,
         CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_unit_price
  FROM v_txn
  WHERE date IS NOT NULL AND dma_name IS NOT NULL AND state IS NOT NULL AND product_category IS NOT NULL
        AND size IS NOT NULL AND promo_flag IS NOT NULL
  GROUP BY ALL)"""

V["spine"] = """spine AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date
  FROM lineitem)"""

V["date_dim"] = """date_dim AS (
  SELECT date, dayname(date) AS day_of_week, CAST(isodow(date) AS INTEGER) AS day_of_week_num,
         CAST(date_trunc('week', date) AS DATE) AS week_start_date, CAST(month(date) AS INTEGER) AS month,
         monthname(date) AS month_name, CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
         isodow(date) >= 6 AS is_weekend,
         CASE WHEN strftime(date, '%m-%d') BETWEEN '07-15' AND '09-15' THEN 'back_to_school'
              WHEN strftime(date, '%m-%d') BETWEEN '11-15' AND '12-10' THEN 'black_friday_holiday'
              ELSE 'regular' END AS season_flag
  FROM spine)"""

V["local_geo"] = """local_geo AS (
  SELECT DISTINCT dma_name, state FROM (
    SELECT dma_name, state FROM paid_base UNION ALL SELECT dma_name, state FROM v_web
    UNION ALL SELECT dma_name, state FROM v_txn) t
  WHERE dma_name IS NOT NULL OR state IS NOT NULL)"""

V["geo_local"] = """geo_local AS (
  SELECT row_number() OVER (ORDER BY dma_name NULLS LAST, state NULLS LAST) AS geo_key, dma_name, state
  FROM local_geo)"""

V["ch"] = """ch AS (
  SELECT CAST(channel_key AS INTEGER) AS channel_key, channel_name, channel_group, is_paid FROM (VALUES
    (1, 'instagram', 'paid_social', true), (2, 'pinterest', 'paid_social', true), (3, 'tiktok', 'paid_social', true),
    (4, 'organic_tiktok', 'organic_social', false), (5, 'web', 'web_analytics', false),
    (6, 'podcast', 'earned_media', false), (7, 'ooh_airport', 'ooh', true)) t(channel_key, channel_name, channel_group, is_paid))"""

V["bridge"] = """bridge AS (
  SELECT CAST(initiative_key AS INTEGER) AS initiative_key, initiative_name, paid_social_campaign_pattern,
         web_analytics_campaign_value, notes FROM (VALUES
    (1, 'Always On', 'Instagram Always On, Pinterest Always On, TikTok Always On', 'Always On', 'Direct theme match across both streams'),
    (2, 'BTS', 'Instagram BTS Moms, Pinterest BTS Moms, TikTok BTS Moms', 'BTS 2023, BTS 2024', 'Web uses year-suffixed variants'),
    (3, 'Teen Trends', 'Instagram Teen Trends, Pinterest Teen Trends, TikTok Teen Trends', NULL, 'No web analytics counterpart found'),
    (4, 'Black Friday', NULL, 'Black Friday 2023', 'Web/promo only — no paid social campaign'),
    (5, 'Email Promo', NULL, 'Email Promo', 'Web/promo only — no paid social campaign'),
    (6, 'Unattributed', NULL, 'None', 'Web traffic with explicit ''None'' campaign value'))
    t(initiative_key, initiative_name, paid_social_campaign_pattern, web_analytics_campaign_value, notes))"""

V["paid_x"] = """paid_x AS (
  SELECT initiative_key, initiative_name, unnest(string_split(paid_social_campaign_pattern, ', ')) AS elem
  FROM bridge WHERE paid_social_campaign_pattern IS NOT NULL)"""

V["web_x"] = """web_x AS (
  SELECT initiative_key, initiative_name, unnest(string_split(web_analytics_campaign_value, ', ')) AS elem
  FROM bridge WHERE web_analytics_campaign_value IS NOT NULL)"""

V["ooh_totals"] = """ooh_totals AS (
  SELECT CAST(w.week_start_date + d.i AS DATE) AS date, CAST(w.spend AS DOUBLE) / 7.0 AS ooh_spend,
         CAST(w.impressions AS DOUBLE) / 7.0 AS ooh_impressions
  FROM (SELECT week_start_date, sum(spend) AS spend, sum(impressions) AS impressions FROM v_ooh_weekly GROUP BY 1) w
  CROSS JOIN (SELECT CAST(unnest(range(7)) AS INTEGER) AS i) d)"""

V["ccd"] = """ccd AS (
  SELECT dd.date, dd.day_of_week, dd.season_flag, dd.is_weekend, dd.month, dd.quarter, dd.year,
    coalesce(ps.paid_social_spend, 0) AS paid_social_spend, coalesce(ps.paid_social_impressions, 0) AS paid_social_impressions,
    coalesce(ps.paid_social_clicks, 0) AS paid_social_clicks, coalesce(ps.paid_social_video_views, 0) AS paid_social_video_views,
    coalesce(wa.web_pageviews, 0) AS web_pageviews, coalesce(wa.web_sessions, 0) AS web_sessions,
    coalesce(wa.web_users, 0) AS web_users,
    coalesce(ec.ecomm_revenue, 0) AS ecomm_revenue, coalesce(ec.ecomm_orders, 0) AS ecomm_orders,
    coalesce(ec.ecomm_units, 0) AS ecomm_units, coalesce(ec.ecomm_discount, 0) AS ecomm_discount,
    coalesce(org.followers_eod, 0) AS followers_eod, coalesce(org.organic_impressions, 0) AS organic_impressions,
    coalesce(org.organic_likes, 0) AS organic_likes, coalesce(org.organic_shares, 0) AS organic_shares,
    coalesce(org.organic_comments, 0) AS organic_comments,
    coalesce(pod.podcast_mentions, 0) AS podcast_mentions, coalesce(pod.podcast_impressions, 0) AS podcast_impressions,
    coalesce(oo.ooh_spend, 0) AS ooh_spend, coalesce(oo.ooh_impressions, 0) AS ooh_impressions
  FROM date_dim dd
  LEFT JOIN (SELECT date, CAST(sum(spend) AS DOUBLE) AS paid_social_spend, CAST(sum(impressions) AS BIGINT) AS paid_social_impressions,
                    CAST(sum(clicks) AS BIGINT) AS paid_social_clicks, CAST(sum(video_views) AS BIGINT) AS paid_social_video_views
             FROM paid_social GROUP BY date) ps ON dd.date = ps.date
  LEFT JOIN (SELECT date, CAST(sum(pageviews) AS BIGINT) AS web_pageviews, CAST(sum(sessions) AS BIGINT) AS web_sessions,
                    CAST(sum(users) AS BIGINT) AS web_users FROM web_daily GROUP BY date) wa ON dd.date = wa.date
  LEFT JOIN (SELECT date, CAST(sum(CAST(gross_revenue AS DECIMAL(18,2))) AS DOUBLE) AS ecomm_revenue,
                    CAST(sum(orders) AS BIGINT) AS ecomm_orders, CAST(sum(total_quantity) AS BIGINT) AS ecomm_units,
                    CAST(sum(CAST(total_discount AS DECIMAL(18,2))) AS DOUBLE) AS ecomm_discount
             FROM ecommerce_daily GROUP BY date) ec ON dd.date = ec.date
  LEFT JOIN (SELECT date, max(followers_eod) AS followers_eod, CAST(sum(impressions) AS BIGINT) AS organic_impressions,
                    CAST(sum(likes) AS BIGINT) AS organic_likes, CAST(sum(shares) AS BIGINT) AS organic_shares,
                    CAST(sum(comments) AS BIGINT) AS organic_comments FROM organic_daily GROUP BY date) org ON dd.date = org.date
  LEFT JOIN (SELECT date, CAST(sum(mentions) AS BIGINT) AS podcast_mentions,
                    CAST(sum(estimated_impressions) AS BIGINT) AS podcast_impressions FROM podcast_daily GROUP BY date) pod
            ON dd.date = pod.date
  LEFT JOIN ooh_totals oo ON dd.date = oo.date)"""

RESID_COLS = ["paid_social_spend", "web_sessions", "ecomm_revenue", "podcast_impressions", "organic_impressions"]
PAIRS = [("paid_social_spend", "web_sessions"), ("paid_social_spend", "ecomm_revenue"), ("web_sessions", "ecomm_revenue"),
         ("podcast_impressions", "web_sessions"), ("organic_impressions", "web_sessions")]


LABELS = {"paid_social_spend": "Paid Social Spend", "web_sessions": "Web Sessions", "ecomm_revenue": "Ecomm Revenue",
          "podcast_impressions": "Podcast Impressions", "organic_impressions": "Organic Impressions"}


def _resid_expr(c):
    w = "OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)"
    return f"{c} - CASE WHEN count({c}) {w} >= 14 THEN avg({c}) {w} END"


V["rs"] = "rs AS (\n  SELECT date, " + ", ".join(RESID_COLS) + ", " + ", ".join(
    f"{_resid_expr(c)} AS {c}__resid" for c in RESID_COLS) + " FROM ccd)"


def lag_sql(src, suffix, mode="positional"):
    parts = "\n  UNION ALL ".join(
        f"SELECT '{LABELS[x]} → {LABELS[y]}' AS signal_pair, date, CAST({x}{suffix} AS DOUBLE) AS x, CAST({y}{suffix} AS DOUBLE) AS y FROM {src}"
        for x, y in PAIRS)
    pos = ("row_number() OVER (PARTITION BY signal_pair ORDER BY date)" if mode == "positional"
           else "date_diff('day', DATE '1970-01-01', date)")
    return f"""SELECT a.signal_pair, CAST(l.lag_days AS INTEGER) AS lag_days,
  round(covar_pop(a.x, b.y) / nullif(stddev_pop(a.x) * stddev_pop(b.y), 0), 6) AS pearson_r
FROM (SELECT *, {pos} AS pos FROM ({parts}) t WHERE x IS NOT NULL AND y IS NOT NULL) a
CROSS JOIN (SELECT unnest(range(15)) AS lag_days) l
JOIN (SELECT *, {pos} AS pos FROM ({parts}) t WHERE x IS NOT NULL AND y IS NOT NULL) b
  ON a.signal_pair = b.signal_pair AND b.pos = a.pos + l.lag_days
GROUP BY a.signal_pair, l.lag_days"""


V["lag_raw"] = "lag_raw AS (" + lag_sql("ccd", "") + ")"
V["lag_resid"] = "lag_resid AS (" + lag_sql("rs", "__resid") + ")"

V["inflation"] = """inflation AS (
  SELECT r.signal_pair, r.pearson_r AS raw_r, s.pearson_r AS residual_r,
         round(CASE WHEN r.pearson_r <> 0 THEN (r.pearson_r - s.pearson_r) / r.pearson_r END, 6) AS percent_reduction
  FROM (SELECT * FROM lag_raw WHERE lag_days = 0) r JOIN (SELECT * FROM lag_resid WHERE lag_days = 0) s
    ON r.signal_pair = s.signal_pair)"""

V["promo"] = """promo AS (
  SELECT promo_flag, count(*) AS line_items, count(DISTINCT order_id) AS distinct_orders,
    CAST(sum(quantity) AS BIGINT) AS total_quantity,
    round(CAST(sum(line_revenue) AS DOUBLE), 2) AS total_revenue,
    round(coalesce(CAST(sum(line_revenue) AS DOUBLE) / nullif(count(DISTINCT order_id), 0), 0.0), 2) AS avg_order_value,
    round(CAST(sum(unit_price) AS DOUBLE) / count(unit_price), 2) AS avg_unit_price,
    round(CAST(sum(discount_per_unit) AS DOUBLE) / count(discount_per_unit), 2) AS avg_discount_per_unit,
    count(*) FILTER (WHERE line_revenue < 0) AS negative_revenue_rows,
    round(CAST(coalesce(sum(line_revenue) FILTER (WHERE line_revenue < 0), 0) AS DOUBLE), 2) AS negative_revenue_amount
  FROM v_txn GROUP BY promo_flag)"""

# dependencies between CTEs (a CTE must come after the ones it reads)
DEPS = {
    "v_txn": ["geo"], "v_web": ["ev", "geo"], "v_web_parts": ["v_web"], "web_events": ["v_web_parts"],
    "web_daily": ["web_events"], "v_posts": ["ev"], "v_mentions": ["ev"], "organic_daily": ["v_posts"],
    "podcast_daily": ["v_mentions"], "paid_base": ["geo"], "paid_social": ["paid_base"],
    "ooh_daily": ["v_ooh_weekly", "airport_lookup"], "ecommerce_daily": ["v_txn"],
    "date_dim": ["spine"], "local_geo": ["paid_base", "v_web", "v_txn"], "geo_local": ["local_geo"],
    "paid_x": ["bridge"], "web_x": ["bridge"],
    "ooh_totals": ["v_ooh_weekly"],
    "ccd": ["date_dim", "paid_social", "web_daily", "ecommerce_daily", "organic_daily", "podcast_daily", "ooh_totals"],
    "geography": ["local_geo", "v_ooh_weekly", "airport_lookup", "v_mentions"], "shows": ["v_mentions"],
    "rs": ["ccd"], "lag_raw": ["ccd"], "lag_resid": ["rs"], "inflation": ["lag_raw", "lag_resid"], "promo": ["v_txn"],
}


def _closure(names):
    out = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it references (found by name)."""
    used = [n for n in V if re.search(r"\b" + n + r"\b", sql)]
    ctes = [V[n] for n in _closure(used)]
    if ctes:
        return "WITH " + ",\n".join(ctes) + "\n" + sql
    return "WITH " + sql.lstrip()[1:] if sql.lstrip().startswith(",") else sql


Q = {}

Q["ecommerce_daily"] = "SELECT * FROM ecommerce_daily"

Q["transactions"] = """SELECT date, order_id, user_id, dma_name, state, zip_code, product_category, size, quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost,
  CAST(discount_per_unit AS DOUBLE) AS discount_per_unit, CAST(line_revenue AS DOUBLE) AS line_revenue, promo_flag
FROM v_txn"""


def oracle_sql() -> dict[str, str]:
    return {k: with_views(v) for k, v in Q.items()}


Q["web_events_dedup"] = "SELECT * FROM web_events"
Q["web_daily"] = "SELECT * FROM web_daily"
Q["paid_social_union"] = """SELECT date, channel, campaign_name, campaign_id, dma_name, state, CAST(spend AS DOUBLE) AS spend,
  impressions, clicks, video_views, video_25pct, video_50pct, video_75pct, video_completes, optimization_goal,
  age_target, audience_segment FROM paid_social"""

Q["drift_report"] = """, files AS (
  SELECT file, split_part(file, '_', 1) AS stream FROM (VALUES ('instagram_part1'), ('instagram_part2'), ('instagram_part3'),
    ('pinterest_part1'), ('pinterest_part2'), ('pinterest_part3'), ('tiktok_part1'), ('tiktok_part2'), ('tiktok_part3')) t(file)),
std AS (SELECT unnest(['date', 'channel', 'campaign_name', 'campaign_id', 'dma_name', 'state', 'optimization_goal', 'spend',
  'impressions', 'clicks', 'video_views', 'video_25pct', 'video_50pct', 'video_75pct', 'video_completes', 'age_target',
  'audience_segment']) AS column_name),
file_cols AS (
  SELECT f.file, f.stream, s.column_name FROM files f JOIN std s ON true
  WHERE NOT ((f.file = 'instagram_part3' AND s.column_name = 'spend')
          OR (f.file = 'pinterest_part1' AND s.column_name IN ('clicks', 'video_25pct', 'video_50pct'))
          OR (f.file = 'tiktok_part2' AND s.column_name IN ('video_views', 'optimization_goal')))
  UNION ALL SELECT 'instagram_part3', 'instagram', 'spend_usd'
  UNION ALL SELECT 'instagram_part3', 'instagram', 'spend_currency'
  UNION ALL SELECT 'pinterest_part1', 'pinterest', 'link_clicks'
  UNION ALL SELECT 'tiktok_part2', 'tiktok', 'views'),
file_rows AS (SELECT f.file, count(p._file) AS file_rows FROM files f LEFT JOIN paid_base p ON p._file = f.file GROUP BY f.file),
grid AS (SELECT DISTINCT a.stream, a.column_name, f.file FROM file_cols a JOIN files f ON a.stream = f.stream)
SELECT g.stream, g.column_name,
  coalesce(string_agg(g.file, ',' ORDER BY g.file) FILTER (WHERE fc.file IS NOT NULL), '') AS present_in,
  coalesce(string_agg(g.file, ',' ORDER BY g.file) FILTER (WHERE fc.file IS NULL), '') AS absent_from,
  CASE WHEN count(*) FILTER (WHERE fc.file IS NULL) = 0 THEN 'common' ELSE 'differing' END AS status,
  CAST(sum(CASE WHEN fc.file IS NOT NULL THEN fr.file_rows ELSE 0 END) AS BIGINT) AS rows_present
FROM grid g LEFT JOIN file_cols fc ON fc.file = g.file AND fc.column_name = g.column_name
JOIN file_rows fr ON fr.file = g.file
GROUP BY g.stream, g.column_name"""

Q["organic_daily"] = "SELECT * FROM organic_daily"
Q["mentions_daily"] = "SELECT * FROM podcast_daily"
Q["ooh_daily"] = "SELECT * FROM ooh_daily"
Q["date_dim"] = "SELECT * FROM date_dim"

V["geography"] = """geography AS (WITH ap AS (
  SELECT airport_code, arg_min(airport_name, week_start_date) AS airport_name, min(week_start_date) AS _first
  FROM v_ooh_weekly GROUP BY airport_code),
allg AS (
  SELECT 1 AS _scope, dma_name, state, CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS VARCHAR) AS airport_code,
         CAST(NULL AS VARCHAR) AS airport_name, 'local' AS geo_scope, CAST(NULL AS DATE) AS _first,
         dma_name AS _k1, state AS _k2 FROM local_geo
  UNION ALL
  SELECT 2, NULL, lk.state, NULL, ap.airport_code, ap.airport_name, 'national', ap._first, ap.airport_code, NULL
  FROM ap LEFT JOIN airport_lookup lk ON ap.airport_code = lk.iata_code
  UNION ALL
  SELECT 3, NULL, CASE WHEN contains(podcast_name, 'GA') OR contains(podcast_name, 'ATL')
                            OR contains(podcast_name, 'Peach State') THEN 'GA' END,
         NULL, NULL, NULL, 'inferred', NULL, podcast_name, NULL
  FROM (SELECT DISTINCT podcast_name FROM v_mentions WHERE podcast_name IS NOT NULL) s)
SELECT row_number() OVER (ORDER BY _scope, _first NULLS FIRST, _k1 NULLS LAST, _k2 NULLS LAST) AS geo_key,
  dma_name, state, zip_code, airport_code, airport_name, geo_scope
FROM allg)"""
Q["geography_dim"] = "SELECT * FROM geography"

V["shows"] = """shows AS (SELECT row_number() OVER (ORDER BY podcast_name) AS podcast_key, podcast_name,
  CASE WHEN hit THEN 'explicit' ELSE 'unknown' END AS geo_inferred, CASE WHEN hit THEN 'GA' END AS geo_state
FROM (SELECT DISTINCT podcast_name,
        (contains(podcast_name, 'GA') OR contains(podcast_name, 'ATL') OR contains(podcast_name, 'Peach State')) AS hit
      FROM v_mentions WHERE podcast_name IS NOT NULL) s)"""
Q["show_dim"] = "SELECT * FROM shows"

Q["channel_dim"] = """, counts AS (
  SELECT lower(channel) AS channel_name, count(*) AS fact_rows FROM paid_social GROUP BY 1
  UNION ALL SELECT 'organic_tiktok', count(*) FROM organic_daily
  UNION ALL SELECT 'web', count(*) FROM web_events
  UNION ALL SELECT 'podcast', count(*) FROM podcast_daily
  UNION ALL SELECT 'ooh_airport', count(*) FROM ooh_daily)
SELECT ch.channel_key, ch.channel_name, ch.channel_group, ch.is_paid, coalesce(c.fact_rows, 0) AS fact_rows
FROM ch LEFT JOIN counts c ON ch.channel_name = c.channel_name"""

Q["initiative_dim"] = """, ps AS (
  SELECT x.initiative_key, CAST(sum(p.spend) AS DOUBLE) AS paid_spend
  FROM paid_social p LEFT JOIN paid_x x ON p.campaign_name = x.elem GROUP BY 1),
wv AS (
  SELECT x.initiative_key, count(*) AS web_pageviews
  FROM web_events w LEFT JOIN web_x x ON coalesce(w.campaign, 'None') = x.elem GROUP BY 1)
SELECT b.initiative_key, b.initiative_name, b.paid_social_campaign_pattern, b.web_analytics_campaign_value, b.notes,
  coalesce(ps.paid_spend, 0) AS paid_spend, coalesce(wv.web_pageviews, 0) AS web_pageviews
FROM bridge b LEFT JOIN ps ON b.initiative_key = ps.initiative_key LEFT JOIN wv ON b.initiative_key = wv.initiative_key"""

Q["initiative_bridge"] = """, pv AS (SELECT campaign_name AS campaign_value, count(*) AS n_rows FROM paid_social GROUP BY 1),
wv AS (SELECT campaign AS campaign_value, count(*) AS n_rows FROM web_events GROUP BY 1)
SELECT 'paid_social' AS stream, pv.campaign_value, x.initiative_key, x.initiative_name, pv.n_rows
FROM pv LEFT JOIN paid_x x ON pv.campaign_value = x.elem
UNION ALL
SELECT 'web', wv.campaign_value, x.initiative_key, x.initiative_name, wv.n_rows
FROM wv LEFT JOIN web_x x ON coalesce(wv.campaign_value, 'None') = x.elem"""

Q["star_join"] = """SELECT p.date, p.campaign_id, ch.channel_key, g.geo_key, dd.season_flag, ch.channel_group,
  CAST(p.spend AS DOUBLE) AS spend, p.clicks
FROM paid_social p LEFT JOIN date_dim dd ON p.date = dd.date
LEFT JOIN ch ON lower(p.channel) = ch.channel_name
LEFT JOIN geo_local g ON p.dma_name = g.dma_name AND p.state = g.state"""

Q["drill_across"] = """SELECT coalesce(a.date, b.date) AS date, coalesce(a.dma_name, b.dma_name) AS dma_name, a.paid_spend, b.revenue
FROM (SELECT date, dma_name, CAST(sum(spend) AS DOUBLE) AS paid_spend FROM paid_social GROUP BY ALL) a
FULL OUTER JOIN (SELECT date, dma_name, CAST(sum(line_revenue) AS DOUBLE) AS revenue FROM v_txn GROUP BY ALL) b
ON a.date = b.date AND a.dma_name = b.dma_name"""


Q["cross_channel_daily"] = "SELECT * FROM ccd"
Q["residual_series"] = "SELECT date, " + ", ".join(RESID_COLS) + ", " + ", ".join(
    f"round({c}__resid, 6) AS {c}__resid" for c in RESID_COLS) + " FROM rs"
Q["lag_corr_raw"] = "SELECT * FROM lag_raw"
Q["lag_corr_resid"] = "SELECT * FROM lag_resid"
Q["lag_corr_calendar"] = lag_sql("ccd", "", "calendar")

_PEAK = """SELECT signal_pair, peak_lag, peak_r, lag0_r, '{series}' AS series FROM (
  SELECT signal_pair, lag_days AS peak_lag, pearson_r AS peak_r,
         max(CASE WHEN lag_days = 0 THEN pearson_r END) OVER (PARTITION BY signal_pair) AS lag0_r,
         row_number() OVER (PARTITION BY signal_pair ORDER BY abs(pearson_r) DESC, lag_days) AS rn
  FROM {src} WHERE pearson_r IS NOT NULL) t WHERE rn = 1"""
Q["peak_lag"] = _PEAK.format(series="raw", src="lag_raw") + "\nUNION ALL\n" + _PEAK.format(series="residual", src="lag_resid")
Q["seasonal_inflation"] = "SELECT * FROM inflation"

_LABEL = """'relationship is ' || CASE WHEN partial_corr >= 0 THEN 'positive' ELSE 'negative' END || ' and ' ||
  CASE WHEN abs(simple_corr) - abs(partial_corr) > 0.15 THEN 'meaningfully weaker'
       WHEN abs(simple_corr) - abs(partial_corr) > 0.05 THEN 'modestly weaker' ELSE 'similar' END ||
  ' after conditioning' || CASE WHEN sign(simple_corr) * sign(partial_corr) < 0 THEN ' (sign flipped)' ELSE '' END"""

Q["semi_partial_corr"] = """, sub AS (
  SELECT paid_social_spend__resid AS s, ecomm_revenue__resid AS y, web_sessions__resid AS x FROM rs
  WHERE paid_social_spend__resid IS NOT NULL AND ecomm_revenue__resid IS NOT NULL AND web_sessions__resid IS NOT NULL),
fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM sub),
e AS (SELECT s, y, y - (fit.b * x + fit.a) AS err FROM sub CROSS JOIN fit),
r AS (SELECT round(covar_pop(s, y) / nullif(stddev_pop(s) * stddev_pop(y), 0), 6) AS simple_corr,
             round(covar_pop(s, err) / nullif(stddev_pop(s) * stddev_pop(err), 0), 6) AS partial_corr FROM e)
SELECT simple_corr, partial_corr, """ + _LABEL + """ AS interpretation FROM r"""

Q["partial_corr"] = """, sub AS (
  SELECT paid_social_spend__resid AS s, ecomm_revenue__resid AS y, web_sessions__resid AS x FROM rs
  WHERE paid_social_spend__resid IS NOT NULL AND ecomm_revenue__resid IS NOT NULL AND web_sessions__resid IS NOT NULL),
c AS (SELECT covar_pop(s, y) / nullif(stddev_pop(s) * stddev_pop(y), 0) AS r_sy,
             covar_pop(s, x) / nullif(stddev_pop(s) * stddev_pop(x), 0) AS r_sx,
             covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS r_xy FROM sub),
r AS (SELECT round(r_sy, 6) AS simple_corr,
             round((r_sy - r_sx * r_xy) / nullif(sqrt((1 - r_sx * r_sx) * (1 - r_xy * r_xy)), 0), 6) AS partial_corr FROM c)
SELECT simple_corr, partial_corr, """ + _LABEL + """ AS interpretation FROM r"""

Q["promo_impact"] = "SELECT * FROM promo"

Q["season_summary"] = """SELECT season_flag, count(*) AS days,
  round(CAST(sum(CAST(ecomm_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(ecomm_revenue), 4) AS avg_daily_revenue,
  round(CAST(sum(CAST(paid_social_spend AS DECIMAL(18,2))) AS DOUBLE) / count(paid_social_spend), 4) AS avg_daily_paid_spend,
  round(avg(web_sessions), 4) AS avg_daily_sessions, round(avg(ecomm_orders), 4) AS avg_daily_orders,
  round(coalesce((CAST(sum(CAST(ecomm_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(ecomm_revenue))
     / nullif(CAST(sum(CAST(paid_social_spend AS DECIMAL(18,2))) AS DOUBLE) / count(paid_social_spend), 0), 0.0), 4)
     AS revenue_per_spend_dollar
FROM ccd GROUP BY season_flag"""

_W7 = "OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
Q["revenue_smooth"] = f"SELECT date, ecomm_revenue, round(avg(ecomm_revenue) {_W7}, 4) AS revenue_7d FROM ccd"

Q["season_bands"] = """, rng AS (SELECT min(date) AS s, max(date) AS e FROM date_dim),
yrs AS (SELECT e, unnest(range(year(s), year(e) + 1)) AS year FROM rng),
b AS (SELECT * FROM (VALUES ('back_to_school', 7, 15, 9, 15), ('black_friday_holiday', 11, 15, 12, 10)) t(season_flag, sm, sd, em, ed))
SELECT b.season_flag, CAST(y.year AS INTEGER) AS year, make_date(y.year, b.sm, b.sd) AS band_start,
  least(make_date(y.year, b.em, b.ed), y.e) AS band_end
FROM yrs y CROSS JOIN b WHERE make_date(y.year, b.sm, b.sd) <= y.e"""

Q["spend_vs_revenue"] = f"""SELECT date, round(paid_social_spend + ooh_spend, 4) AS total_spend,
  round(avg(paid_social_spend + ooh_spend) {_W7}, 4) AS spend_7d, round(avg(ecomm_revenue) {_W7}, 4) AS revenue_7d FROM ccd"""

Q["platform_pivot"] = f""", p AS (
  SELECT date,
    coalesce(CAST(sum(CAST(spend AS DECIMAL(18,2))) FILTER (WHERE channel = 'Instagram') AS DOUBLE), 0) AS instagram,
    coalesce(CAST(sum(CAST(spend AS DECIMAL(18,2))) FILTER (WHERE channel = 'Pinterest') AS DOUBLE), 0) AS pinterest,
    coalesce(CAST(sum(CAST(spend AS DECIMAL(18,2))) FILTER (WHERE channel = 'TikTok') AS DOUBLE), 0) AS tiktok
  FROM paid_social GROUP BY date)
SELECT date, instagram, pinterest, tiktok, round(avg(instagram) {_W7}, 4) AS instagram_7d,
  round(avg(pinterest) {_W7}, 4) AS pinterest_7d, round(avg(tiktok) {_W7}, 4) AS tiktok_7d FROM p"""

_SRC = ["direct", "email", "google", "instagram", "partner"]
Q["source_pivot"] = ", p AS (SELECT date, " + ", ".join(
    f"coalesce(CAST(sum(sessions) FILTER (WHERE traffic_source = '{v}') AS BIGINT), 0) AS {v}" for v in _SRC) + \
    " FROM web_daily GROUP BY date)\nSELECT date, " + ", ".join(_SRC) + ", " + ", ".join(
    f"round(avg({v}) {_W7}, 4) AS {v}_7d" for v in _SRC) + " FROM p"

Q["channel_group_smooth"] = """, m AS (SELECT * FROM (VALUES ('instagram', 'Paid Social'), ('tiktok', 'Paid Social'),
    ('facebook', 'Paid Social'), ('pinterest', 'Paid Social'), ('google', 'Search'), ('bing', 'Search'), ('yahoo', 'Search'),
    ('direct', 'Non-Paid (Direct + Email)'), ('email', 'Non-Paid (Direct + Email)')) t(traffic_source, channel_group)),
g AS (SELECT m.channel_group, w.date, CAST(sum(w.sessions) AS BIGINT) AS sessions
      FROM web_daily w JOIN m ON w.traffic_source = m.traffic_source GROUP BY 1, 2)
SELECT channel_group, date, sessions,
  round(avg(sessions) OVER (PARTITION BY channel_group ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS sessions_7d
FROM g"""

Q["season_points"] = "SELECT date, season_flag, paid_social_spend, web_sessions FROM ccd"

_PROMO_COLS = ["line_items", "distinct_orders", "total_quantity", "total_revenue", "avg_order_value", "avg_unit_price",
               "avg_discount_per_unit", "negative_revenue_rows", "negative_revenue_amount"]
_SEASON_COLS = ["days", "avg_daily_revenue", "avg_daily_paid_spend", "avg_daily_sessions", "avg_daily_orders"]
Q["kpi_table"] = """, t AS (
  SELECT CAST(sum(CAST(paid_social_spend AS DECIMAL(18,2))) AS DOUBLE) AS paid, sum(ooh_spend) AS ooh,
         CAST(sum(CAST(ecomm_revenue AS DECIMAL(18,2))) AS DOUBLE) AS rev, sum(ecomm_orders) AS orders,
         sum(web_pageviews) AS pv, sum(podcast_mentions) AS pm FROM ccd),
seasons AS (""" + Q["season_summary"] + """),
part AS (WITH """ + Q["semi_partial_corr"].lstrip()[1:] + """),
k AS (
  SELECT 'totals' AS section, 'paid_social_spend' AS metric, CAST(paid AS DOUBLE) AS value, 2 AS digits FROM t
  UNION ALL SELECT 'totals', 'ooh_spend', ooh, 2 FROM t
  UNION ALL SELECT 'totals', 'total_spend', paid + ooh, 2 FROM t
  UNION ALL SELECT 'totals', 'ecomm_revenue', rev, 2 FROM t
  UNION ALL SELECT 'totals', 'ecomm_orders', CAST(orders AS DOUBLE), 2 FROM t
  UNION ALL SELECT 'totals', 'web_pageviews', CAST(pv AS DOUBLE), 2 FROM t
  UNION ALL SELECT 'totals', 'podcast_mentions', CAST(pm AS DOUBLE), 2 FROM t
  UNION ALL SELECT 'totals', 'spend_to_revenue_ratio', (paid + ooh) / nullif(rev, 0), 2 FROM t
  UNION ALL SELECT 'correlation', signal_pair || ' reduction_pct',
     CASE WHEN raw_r <> 0 THEN (1 - abs(residual_r) / abs(raw_r)) * 100 ELSE 0.0 END, 2 FROM inflation
  UNION ALL SELECT 'correlation', signal_pair || ' raw_r', raw_r, 3 FROM inflation
  UNION ALL SELECT 'correlation', signal_pair || ' residual_r', residual_r, 3 FROM inflation
  UNION ALL SELECT 'partial', 'simple_corr', simple_corr, 3 FROM part
  UNION ALL SELECT 'partial', 'partial_corr', partial_corr, 3 FROM part
  """ + "\n  ".join(f"UNION ALL SELECT 'season', season_flag || ' {c}', CAST({c} AS DOUBLE), 2 FROM seasons" for c in _SEASON_COLS) + """
  """ + "\n  ".join(f"UNION ALL SELECT 'promo', 'flag=' || promo_flag || ' {c}', CAST({c} AS DOUBLE), 2 FROM promo" for c in _PROMO_COLS) + """
  UNION ALL SELECT 'promo', 'promo_revenue_share_pct',
     total_revenue / nullif((SELECT rev FROM t), 0) * 100, 2 FROM promo WHERE promo_flag = 1)
SELECT section, metric, CASE WHEN digits = 3 THEN round(value, 3) ELSE round(value, 2) END AS value FROM k"""

Q["ols_line"] = """SELECT round(s, 6) AS slope, round(my - s * mx, 2) AS intercept FROM (
  SELECT covar_pop(x, y) / nullif(var_pop(x), 0) AS s, avg(x) AS mx, avg(y) AS my
  FROM (SELECT CAST(paid_social_spend AS DOUBLE) AS x, CAST(ecomm_revenue AS DOUBLE) AS y FROM ccd) t WHERE x IS NOT NULL AND y IS NOT NULL) f"""

Q["airport_lookup"] = "SELECT * FROM airport_lookup"


# ------------------------------------------------------------------ data quality
DQ_CTE = {
    "fact_paid_social_daily": "paid_social", "fact_web_analytics_events": "web_events",
    "fact_web_analytics_daily": "web_daily", "fact_ecommerce_transactions": "v_txn",
    "fact_ecommerce_daily": "ecommerce_daily", "fact_organic_social_daily": "organic_daily",
    "fact_podcast_daily": "podcast_daily", "fact_ooh_daily": "ooh_daily", "dim_date": "date_dim",
    "dim_geography": "geography", "dim_podcast": "shows", "dim_channel": "ch", "dim_campaign_initiative": "bridge",
}
FACTS = ["fact_paid_social_daily", "fact_web_analytics_events", "fact_web_analytics_daily",
         "fact_ecommerce_transactions", "fact_ecommerce_daily", "fact_organic_social_daily",
         "fact_podcast_daily", "fact_ooh_daily"]
COLS = {
    "fact_paid_social_daily": "date channel campaign_name campaign_id dma_name state spend impressions clicks video_views "
                              "video_25pct video_50pct video_75pct video_completes optimization_goal age_target audience_segment",
    "fact_web_analytics_events": "date event_datetime user_id session_id page_url traffic_source traffic_medium campaign "
                                 "device_category dma_name state zip_code",
    "fact_web_analytics_daily": "date traffic_source traffic_medium campaign device_category dma_name state pageviews sessions users",
    "fact_ecommerce_transactions": "date order_id user_id dma_name state zip_code product_category size quantity unit_price "
                                   "unit_cost discount_per_unit line_revenue promo_flag",
    "fact_ecommerce_daily": "date dma_name state product_category size promo_flag orders line_items total_quantity "
                            "gross_revenue total_discount total_cost avg_unit_price",
    "fact_organic_social_daily": "date posts followers_eod impressions video_views video_completes likes comments shares clicks saves",
    "fact_podcast_daily": "date podcast_name episode_title host_name mentions_brand mentions_founder sentiment "
                          "estimated_impressions episode_rating mentions",
    "fact_ooh_daily": "date airport_code airport_name state format audience_segment spend impressions placements",
    "dim_geography": "geo_key dma_name state airport_code airport_name geo_scope",
}
GRAINS = {
    "fact_paid_social_daily": "date, channel, campaign_id, dma_name",
    "fact_web_analytics_daily": "date, traffic_source, traffic_medium, campaign, device_category, dma_name, state",
    "fact_ecommerce_daily": "date, dma_name, state, product_category, size, promo_flag",
    "fact_organic_social_daily": "date", "fact_podcast_daily": "date, podcast_name, episode_title",
    "fact_ooh_daily": "date, airport_code, format, audience_segment", "dim_date": "date", "dim_geography": "geo_key",
}


def _st(ok):
    return f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END"


def _u(parts):
    return "\nUNION ALL\n".join(parts)


DQ = {}
DQ["exists"] = _u(
    f"""SELECT 'exists' AS "check", '{n}' AS table_name, {_st('n > 0')} AS status,
  CASE WHEN n > 0 THEN 'non-empty' ELSE 'empty' END AS detail FROM (SELECT count(*) AS n FROM (SELECT 1 FROM {DQ_CTE[n]} LIMIT 1) t) x"""
    for n in sorted(["fact_paid_social_daily", "fact_web_analytics_events", "fact_web_analytics_daily",
                     "fact_ecommerce_transactions", "fact_ecommerce_daily", "fact_organic_social_daily",
                     "fact_podcast_daily", "fact_ooh_daily", "dim_date", "dim_geography", "dim_podcast",
                     "dim_channel", "dim_campaign_initiative"]))
DQ["grain"] = _u(
    f"""SELECT 'grain' AS "check", '{n}' AS table_name, {_st('dups = 0')} AS status, CAST(dups AS VARCHAR) AS detail
FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS dups FROM (SELECT count(*) AS n FROM {DQ_CTE[n]} GROUP BY {k} HAVING count(*) > 1) t) x"""
    for n, k in sorted(GRAINS.items()))
DQ["date_range"] = _u(
    f"""SELECT 'date_range' AS "check", '{n}' AS table_name, {_st('coalesce(mn >= b.s AND mx <= b.e, false)')} AS status,
  concat_ws('..', CAST(mn AS VARCHAR), CAST(mx AS VARCHAR)) AS detail
FROM (SELECT min(CAST(date AS DATE)) AS mn, max(CAST(date AS DATE)) AS mx FROM {DQ_CTE[n]}) a
CROSS JOIN (SELECT min(date) AS s, max(date) AS e FROM date_dim) b"""
    for n in FACTS)


def _empty(n):
    cols = sorted(COLS[n].split())
    lst = ", ".join(f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in cols)
    return f"""SELECT 'empty_columns' AS "check", '{n}' AS table_name, {_st("e = ''")} AS status, e AS detail
FROM (SELECT concat_ws(',', {lst}) AS e FROM {DQ_CTE[n]}) x"""


DQ["empty_cols"] = _u(_empty(n) for n in FACTS + ["dim_geography"])


def _recon(n, a, b):
    return f"""SELECT 'reconcile' AS "check", '{n}' AS table_name, {_st('round(abs(a - b), 6) <= 0.01')} AS status,
  CAST(CAST(round(abs(a - b), 2) AS DECIMAL(18,2)) AS VARCHAR) AS detail FROM (SELECT ({a}) AS a, ({b}) AS b) x"""


_EXACT = "sum(CAST({} AS DECIMAL(38,10)))"
DQ["reconcile"] = _u([
    _recon("fact_ecommerce_daily", f"SELECT {_EXACT.format('line_revenue')} FROM v_txn",
           f"SELECT {_EXACT.format('gross_revenue')} FROM ecommerce_daily"),
    _recon("fact_ooh_daily", f"SELECT {_EXACT.format('spend')} FROM v_ooh_weekly", f"SELECT {_EXACT.format('spend')} FROM ooh_daily"),
    _recon("fact_paid_social_daily", f"SELECT {_EXACT.format('spend')} FROM paid_base",
           f"SELECT {_EXACT.format('spend')} FROM paid_social")])

Q["dq_expected_total"] = _u(
    f"""SELECT 'expected_total' AS "check", '{n}' AS table_name, {_st('abs(t - x) <= 0.01')} AS status, CAST(CAST(t AS DECIMAL(18,2)) AS VARCHAR) AS detail
FROM (SELECT (SELECT sum(CAST(spend AS DECIMAL(18,2))) FROM {src}) AS t, (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem) AS x) q"""
    for n, src in (("fact_paid_social_daily", "paid_social"), ("raw_ooh_weekly", "v_ooh_weekly")))


def _exp(n, o, x):
    return f"""SELECT 'expected_rows' AS "check", '{n}' AS table_name, {_st('o = x')} AS status,
  CAST(o AS VARCHAR) || '/' || CAST(x AS VARCHAR) AS detail FROM (SELECT ({o}) AS o, ({x}) AS x) t"""


DQ["expected"] = _u([
    _exp("fact_ecommerce_transactions", "SELECT count(*) FROM v_txn", "SELECT count(*) FROM lineitem"),
    _exp("fact_ooh_daily", "SELECT count(*) FROM ooh_daily", "SELECT count(*) * 7 FROM v_ooh_weekly"),
    _exp("fact_paid_social_daily", "SELECT count(*) FROM paid_social",
         "SELECT count(*) FROM (SELECT DISTINCT date, channel, campaign_id, dma_name FROM paid_base) t"),
    _exp("fact_web_analytics_events", "SELECT count(*) FROM web_events", "SELECT count(*) FROM events")])


def _align(n, metric, src, s_expr, rollup, r_expr):
    return f"""SELECT 'alignment_{metric}' AS "check", '{n}' AS table_name, {_st('bad = 0')} AS status, CAST(bad AS VARCHAR) AS detail
FROM (SELECT count(*) FILTER (WHERE s IS NULL OR r IS NULL OR abs(s - r) > 0.01) AS bad
      FROM (SELECT date, CAST({s_expr} AS DOUBLE) AS s FROM {src} GROUP BY date) a
      FULL OUTER JOIN (SELECT date, CAST({r_expr} AS DOUBLE) AS r FROM {rollup} GROUP BY date) b ON a.date IS NOT DISTINCT FROM b.date) x"""


DQ["alignment"] = _u([
    _align("fact_ecommerce_daily", "revenue", "v_txn", "sum(line_revenue)", "ecommerce_daily", "sum(gross_revenue)"),
    _align("fact_ecommerce_daily", "quantity", "v_txn", "sum(quantity)", "ecommerce_daily", "sum(total_quantity)"),
    _align("fact_ecommerce_daily", "line_items", "v_txn", "count(*)", "ecommerce_daily", "sum(line_items)"),
    _align("fact_web_analytics_daily", "pageviews", "web_events", "count(*)", "web_daily", "sum(pageviews)")])

DQ["overlap"] = """SELECT 'overlap_removal' AS "check", 'fact_web_analytics_events' AS table_name,
  CASE WHEN raw - dr = kept THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(raw AS VARCHAR) || '-' || CAST(dr AS VARCHAR) || '=' || CAST(kept AS VARCHAR) AS detail
FROM (SELECT count(*) AS raw, count(*) FILTER (WHERE _source = 'web_b' AND CAST(event_datetime AS DATE)
        BETWEEN DATE '1998-01-15' AND DATE '1998-01-20') AS dr FROM v_web_parts) a
CROSS JOIN (SELECT count(*) AS kept FROM web_events) b"""

DQ["formula"] = """SELECT 'revenue_formula' AS "check", 'fact_ecommerce_transactions' AS table_name,
  CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(bad AS VARCHAR) AS detail
FROM (SELECT count(*) FILTER (WHERE abs(CAST(quantity AS DOUBLE) * CAST(unit_price AS DOUBLE)
      - CAST(discount_per_unit AS DOUBLE) * CAST(quantity AS DOUBLE) - CAST(line_revenue AS DOUBLE)) >= 0.01) AS bad
      FROM v_txn) x"""

for _k in ["exists", "grain", "date_range", "empty_cols", "reconcile", "expected", "alignment", "overlap", "formula"]:
    Q["dq_" + _k] = DQ[_k]

Q["dq_month_counts"] = "SELECT table_name, month, count(*) AS n_rows FROM (" + _u(
    f"SELECT '{n}' AS table_name, strftime(CAST(date AS DATE), '%Y-%m') AS month FROM {DQ_CTE[n]}"
    for n in ["fact_paid_social_daily", "fact_web_analytics_daily", "fact_ecommerce_daily", "fact_organic_social_daily",
              "fact_podcast_daily", "fact_ooh_daily"]) + ") t GROUP BY table_name, month"

Q["dq_suite"] = _u("SELECT * FROM (" + DQ[k] + ") q" for k in
                   ["exists", "grain", "date_range", "empty_cols", "reconcile", "expected", "alignment", "overlap", "formula"])

Q["dq_summary"] = """, allr AS (
""" + _u("SELECT * FROM (" + DQ[k] + ") q" for k in
         ["exists", "grain", "date_range", "empty_cols", "reconcile", "expected", "alignment", "overlap", "formula"]) + """)
SELECT status, count(*) AS checks FROM allr GROUP BY status
UNION ALL SELECT 'TOTAL', count(*) FROM allr"""


# ------------------------------------------------------------------ profiling
V["txn_out"] = """txn_out AS (
  SELECT date, order_id, user_id, dma_name, state, zip_code, product_category, size, quantity,
    CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost,
    CAST(discount_per_unit AS DOUBLE) AS discount_per_unit, CAST(line_revenue AS DOUBLE) AS line_revenue, promo_flag
  FROM v_txn)"""
DEPS["txn_out"] = ["v_txn"]
TXN_COLS = COLS["fact_ecommerce_transactions"].split()
TXN_NUM = ["quantity", "unit_price", "unit_cost", "discount_per_unit", "line_revenue", "promo_flag"]


def _role(c):
    return "date" if c == "date" else ("numeric" if c in TXN_NUM else "categorical")


Q["profile_columns"] = _u(
    f"""SELECT '{c}' AS column_name, '{_role(c)}' AS role, count(*) AS rows, count(*) - count({c}) AS nulls,
  round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 2) AS null_pct, count(DISTINCT {c}) AS n_unique
FROM txn_out""" for c in TXN_COLS)

Q["numeric_profile"] = _u(
    f"""SELECT '{c}' AS column_name, count(v) AS non_null, min(v) AS min, max(v) AS max,
  round(avg(v), 2) AS mean, round(median(v), 2) AS median, round(stddev_samp(v), 2) AS stdev
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM txn_out) t""" for c in TXN_NUM)

_TOPCOLS = ["traffic_source", "traffic_medium", "campaign", "device_category", "dma_name"]
Q["top_values"] = """SELECT column_name, value, n, CAST(value_rank AS INTEGER) AS value_rank FROM (
  SELECT column_name, value, n, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC) AS value_rank
  FROM (""" + _u(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM web_events "
               f"WHERE {c} IS NOT NULL GROUP BY 2" for c in _TOPCOLS) + """) c) r WHERE value_rank <= 5"""

V["stream_ts"] = """stream_ts AS (
  SELECT 'web_events' AS table_name, event_datetime AS ts FROM web_events
  UNION ALL SELECT 'transactions', order_datetime FROM v_txn
  UNION ALL SELECT 'ooh_weekly', CAST(week_start_date AS TIMESTAMP) FROM v_ooh_weekly
  UNION ALL SELECT 'orders', o_orderdate FROM orders)"""
DEPS["stream_ts"] = ["web_events", "v_txn", "v_ooh_weekly"]

Q["granularity"] = """, ht AS (SELECT table_name, max(CASE WHEN hour(ts) <> 0 OR minute(ts) <> 0 THEN 1 ELSE 0 END) AS t
            FROM stream_ts GROUP BY 1),
dd AS (SELECT DISTINCT table_name, CAST(ts AS DATE) AS d FROM stream_ts WHERE ts IS NOT NULL),
gp AS (SELECT table_name, date_diff('day', lag(d) OVER (PARTITION BY table_name ORDER BY d), d) AS gap FROM dd),
md AS (SELECT table_name, median(CAST(gap AS DOUBLE)) AS median_gap FROM gp GROUP BY 1)
SELECT ht.table_name, md.median_gap,
  CASE WHEN t = 1 THEN 'event-level' WHEN median_gap IS NULL THEN 'unknown' WHEN median_gap <= 1 THEN 'daily' WHEN median_gap >= 5 AND median_gap <= 9 THEN 'weekly'
       WHEN median_gap >= 25 AND median_gap <= 35 THEN 'monthly'
       ELSE '~' || CAST(CAST(floor(median_gap) AS BIGINT) AS VARCHAR) || '-day' END AS granularity
FROM ht LEFT JOIN md ON ht.table_name = md.table_name"""

Q["date_profile"] = """SELECT table_name, min(CAST(ts AS DATE)) AS min_date, max(CAST(ts AS DATE)) AS max_date,
  count(DISTINCT CAST(ts AS DATE)) AS distinct_days,
  date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 - count(DISTINCT CAST(ts AS DATE)) AS missing_days
FROM stream_ts GROUP BY table_name"""

Q["overlap_report"] = """, rng AS (SELECT _source AS f, min(CAST(event_datetime AS DATE)) AS s, max(CAST(event_datetime AS DATE)) AS e
             FROM v_web_parts GROUP BY 1),
pairs AS (SELECT a.f AS file_a, b.f AS file_b, greatest(a.s, b.s) AS overlap_start, least(a.e, b.e) AS overlap_end
          FROM rng a JOIN rng b ON a.f < b.f AND a.s <= b.e AND b.s <= a.e),
daily AS (SELECT _source AS f, CAST(event_datetime AS DATE) AS d, count(*) AS n FROM v_web_parts GROUP BY 1, 2)
SELECT p.file_a, p.file_b, p.overlap_start, p.overlap_end,
  CAST((SELECT coalesce(sum(n), 0) FROM daily WHERE f = p.file_a AND d BETWEEN p.overlap_start AND p.overlap_end) AS BIGINT) AS rows_a,
  CAST((SELECT coalesce(sum(n), 0) FROM daily WHERE f = p.file_b AND d BETWEEN p.overlap_start AND p.overlap_end) AS BIGINT) AS rows_b
FROM pairs p"""

_STREAMS = [("paid_instagram", "paid_social"), ("paid_pinterest", "paid_social"), ("paid_tiktok", "paid_social"),
            ("web_traffic", "web_analytics"), ("transactions", "ecommerce"), ("tiktok_owned", "organic_social"),
            ("podcast_mentions", "podcast"), ("ooh_airport", "ooh")]
_PAID_STD = ("date channel campaign_name campaign_id dma_name state optimization_goal spend impressions clicks video_views "
             "video_25pct video_50pct video_75pct video_completes age_target audience_segment").split()
_PAID_FILE = {"instagram_part3": ({"spend": "spend_usd"}, ["spend_currency"], []),
              "pinterest_part1": ({"clicks": "link_clicks"}, [], ["video_25pct", "video_50pct"]),
              "tiktok_part2": ({"video_views": "views"}, [], ["optimization_goal"])}


def _inventory(name, src, cols, shown, dates):
    """``cols`` are counted for nulls, ``shown`` is the header."""
    key, group = next(((k, g) for k, g in _STREAMS if k in name), ("unknown", "unknown"))
    nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    ts = f"SELECT CAST({dates[0]} AS TIMESTAMP) AS ts FROM {src}"
    return f"""SELECT '{name}' AS filename, n AS rows, CAST({len(shown)} AS INTEGER) AS cols, '{"; ".join(shown)}' AS columns,
  '{"; ".join(dates)}' AS date_columns, mn AS date_min, mx AS date_max, dd AS distinct_dates, date_diff('day', mn, mx) + 1 - dd AS missing_date_count,
  CASE WHEN timed = 1 THEN 'event-level' WHEN gap IS NULL THEN 'unknown' WHEN gap <= 1 THEN 'daily' WHEN gap >= 5 AND gap <= 9 THEN 'weekly'
       WHEN gap >= 25 AND gap <= 35 THEN 'monthly' ELSE '~' || CAST(CAST(floor(gap) AS BIGINT) AS VARCHAR) || '-day' END AS granularity,
  CAST(nulls AS BIGINT) AS total_nulls, '{key}' AS datastream, '{group}' AS stream_group
FROM (SELECT count(*) AS n, {nulls} AS nulls FROM {src}) a
CROSS JOIN (SELECT min(CAST(ts AS DATE)) AS mn, max(CAST(ts AS DATE)) AS mx, count(DISTINCT CAST(ts AS DATE)) AS dd,
    max(CASE WHEN hour(ts) <> 0 OR minute(ts) <> 0 THEN 1 ELSE 0 END) AS timed FROM ({ts}) t) b
CROSS JOIN (SELECT median(CAST(g AS DOUBLE)) AS gap FROM (SELECT date_diff('day', lag(d) OVER (ORDER BY d), d) AS g
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM ({ts}) t WHERE ts IS NOT NULL) u) v) c"""


def _paid_inventory(f):
    renamed, added, omitted = _PAID_FILE.get(f, ({}, [], []))
    cols = [c for c in _PAID_STD if c not in omitted]
    return _inventory(f"paid_{f}", f"(SELECT * FROM paid_base WHERE _file = '{f}')", cols, [renamed.get(c, c) for c in cols] + added, ["date"])


_VIEW_COLS = {
    "v_web": "date event_datetime user_id session_id page_url traffic_source traffic_medium campaign device_category dma_name state zip_code",
    "v_txn": "date order_datetime order_id user_id dma_name state zip_code product_category size quantity unit_price unit_cost "
             "discount_per_unit line_revenue promo_flag",
    "v_mentions": "podcast_name episode_title episode_release_date mention_datetime host_name mentions_brand mentions_founder "
                  "transcript_snippet estimated_impressions episode_rating sentiment",
    "v_posts": "date post_id caption followers impressions video_views video_completes likes comments shares clicks saves",
    "v_ooh_weekly": "week_start_date airport_code airport_name format audience_segment spend impressions placements"}
_VIEW_COLS = {k: v.split() for k, v in _VIEW_COLS.items()}
Q["inventory"] = _u(
    [_paid_inventory(f"{p}_part{i}") for p in ("instagram", "pinterest", "tiktok") for i in (1, 2, 3)] +
    [_inventory(f"{t}_web_traffic", f"(SELECT * FROM v_web_parts WHERE _source = '{t}')", _VIEW_COLS["v_web"], _VIEW_COLS["v_web"],
                ["event_datetime", "date"]) for t in ("web_a", "web_b")] +
    [_inventory(n, v, _VIEW_COLS[v], _VIEW_COLS[v], dates) for n, v, dates in (
        ("transactions", "v_txn", ["order_datetime", "date"]), ("podcast_mentions", "v_mentions", ["mention_datetime", "episode_release_date"]),
        ("tiktok_owned_posts", "v_posts", ["date"]), ("ooh_airport_weekly", "v_ooh_weekly", ["week_start_date"]))])

# ------------------------------------------------------------------ exploration
_KEYSETS = [("fact_ecommerce_transactions", "txn_out", k) for k in
            (["order_id"], ["order_id", "product_category"], ["order_id", "product_category", "size"],
             ["order_id", "product_category", "size", "quantity", "unit_price", "date"])] + \
           [("ooh_weekly", "v_ooh_weekly", k) for k in
            (["week_start_date", "airport_code"], ["week_start_date", "airport_code", "format"],
             ["week_start_date", "airport_code", "audience_segment"],
             ["week_start_date", "airport_code", "format", "audience_segment"], ["airport_code"])] + \
           [("web_events", "v_web_parts", ["event_datetime", "user_id", "session_id", "page_url"]),
            ("organic_posts", "v_posts", ["date", "post_id"]),
            ("podcast_mentions", "v_mentions", ["podcast_name", "episode_title", "mention_datetime"])]
_TESTED = "CASE WHEN extra_rows = 0 THEN 'UNIQUE' ELSE 'DUPLICATES' END AS status"
Q["key_battery"] = _u(
    f"""SELECT '{t}' AS table_name, '{",".join(k)}' AS key_columns, extra_rows, {_TESTED}
FROM (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM (SELECT count(*) AS n FROM {src} GROUP BY {", ".join(k)}) g) x"""
    for t, src, k in _KEYSETS) + """
UNION ALL SELECT 'fact_ecommerce_transactions', 'order_id,line_number', CAST(NULL AS BIGINT), 'SKIPPED'"""

_PAIDKEY = ["date", "channel", "campaign_id", "dma_name"]
Q["paid_key_battery"] = _u(
    f"""SELECT _file, 'paid_social' AS table_name, '{",".join(k)}' AS key_columns, extra_rows, {_TESTED}
FROM (SELECT _file, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM (SELECT _file, count(*) AS n FROM paid_base GROUP BY _file, {", ".join(k)}) g GROUP BY _file) x"""
    for k in (_PAIDKEY, _PAIDKEY + ["optimization_goal"], _PAIDKEY + ["age_target"], _PAIDKEY + ["audience_segment"],
              _PAIDKEY + ["age_target", "audience_segment"], _PAIDKEY + ["optimization_goal", "age_target", "audience_segment"]))

_WCOLS = COLS["fact_web_analytics_events"].split()


def _shared(cols, out):
    on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in cols)
    sel = ", ".join(cols)
    return f"""(SELECT a.f AS file_a, b.f AS file_b, count(*) AS {out}
  FROM (SELECT DISTINCT _source AS f, {sel} FROM v_web_parts) a
  JOIN (SELECT DISTINCT _source AS f, {sel} FROM v_web_parts) b ON a.f < b.f AND {on} GROUP BY 1, 2)"""


Q["overlap_keys"] = f""", sk AS {_shared(["event_datetime", "user_id", "page_url"], "shared_keys")},
sr AS {_shared(_WCOLS, "identical_rows")},
sd AS (SELECT a.f AS file_a, b.f AS file_b, count(*) AS shared_dates
  FROM (SELECT DISTINCT _source AS f, CAST(event_datetime AS DATE) AS d FROM v_web_parts) a
  JOIN (SELECT DISTINCT _source AS f, CAST(event_datetime AS DATE) AS d FROM v_web_parts) b ON a.f < b.f AND a.d = b.d GROUP BY 1, 2),
j1 AS (SELECT coalesce(sk.file_a, sr.file_a) AS file_a, coalesce(sk.file_b, sr.file_b) AS file_b, sk.shared_keys, sr.identical_rows
       FROM sk FULL OUTER JOIN sr ON sk.file_a = sr.file_a AND sk.file_b = sr.file_b)
SELECT coalesce(j1.file_a, sd.file_a) AS file_a, coalesce(j1.file_b, sd.file_b) AS file_b,
  coalesce(j1.shared_keys, 0) AS shared_keys, coalesce(j1.identical_rows, 0) AS identical_rows,
  coalesce(sd.shared_dates, 0) AS shared_dates
FROM j1 FULL OUTER JOIN sd ON j1.file_a = sd.file_a AND j1.file_b = sd.file_b"""

Q["sessions_per_day"] = """SELECT CAST(event_datetime AS DATE) AS date, count(*) AS n_rows, count(DISTINCT session_id) AS sessions,
  count(DISTINCT user_id) AS users FROM web_events GROUP BY 1"""
Q["basket_distribution"] = """SELECT line_items, count(*) AS orders FROM (SELECT order_id, count(*) AS line_items FROM v_txn GROUP BY 1) t
GROUP BY line_items"""
Q["order_values"] = """SELECT count(*) AS orders, round(CAST(min(v) AS DOUBLE), 2) AS min_value, round(avg(CAST(v AS DOUBLE)), 2) AS avg_value,
  round(CAST(max(v) AS DOUBLE), 2) AS max_value FROM (SELECT order_id, sum(line_revenue) AS v FROM v_txn GROUP BY 1) t"""

Q["recycled_ids"] = """, ps AS (SELECT CASE WHEN date < DATE '1998-01-16' THEN 'posts_a' ELSE 'posts_b' END AS f, post_id, date, followers FROM v_posts),
fst AS (SELECT f, post_id, date, followers, row_number() OVER (PARTITION BY f, post_id ORDER BY date, followers) AS rn FROM ps)
SELECT a.post_id, a.date AS first_date_a, a.followers AS followers_a, b.date AS first_date_b, b.followers AS followers_b
FROM fst a JOIN fst b ON a.post_id = b.post_id AND a.f = 'posts_a' AND b.f = 'posts_b' AND a.rn = 1 AND b.rn = 1"""

Q["follower_drops"] = """, fp AS (SELECT date, min(post_id) AS pid FROM v_posts GROUP BY date),
day AS (SELECT p.date, min(p.followers) FILTER (WHERE p.post_id = fp.pid) AS followers,
               count(DISTINCT p.followers) AS distinct_values
        FROM v_posts p JOIN fp ON p.date = fp.date GROUP BY p.date)
SELECT date, followers, distinct_values, lag(followers) OVER (ORDER BY date) AS prev_followers,
  coalesce(followers < lag(followers) OVER (ORDER BY date), false) AS decreased FROM day"""

Q["release_vs_mention"] = """SELECT count(*) AS mentions,
  count(*) FILTER (WHERE episode_release_date = CAST(mention_datetime AS DATE)) AS same_day,
  count(*) FILTER (WHERE NOT (episode_release_date = CAST(mention_datetime AS DATE))) AS different_day FROM v_mentions"""

Q["multi_mentions"] = """SELECT podcast_name, count(DISTINCT episode_title) AS episodes, count(*) FILTER (WHERE n > 1) AS multi_mention_groups,
  max(n) AS max_mentions
FROM (SELECT podcast_name, episode_title, count(*) AS n FROM v_mentions GROUP BY 1, 2) g
GROUP BY podcast_name"""

Q["promo_crosstab"] = """SELECT promo_flag, discount_per_unit > 0 AS has_discount, count(*) AS n_rows,
  count(*) FILTER (WHERE line_revenue < 0) AS negative_rows FROM v_txn GROUP BY 1, 2"""

_DAILY = ["fact_paid_social_daily", "fact_web_analytics_daily", "fact_ecommerce_daily", "fact_organic_social_daily",
          "fact_podcast_daily", "fact_ooh_daily"]
_RAW_DATES = [("paid_social", "date", "paid_base"), ("web_analytics", "event_datetime", "v_web"), ("ecommerce", "order_datetime", "v_txn"),
              ("organic_social", "date", "v_posts"), ("podcast", "episode_release_date", "v_mentions"), ("ooh", "week_start_date", "v_ooh_weekly")]
_RAW_DAYS = _u(f"SELECT DISTINCT '{n}' AS stream, CAST({c} AS DATE) AS d FROM {src}" for n, c, src in _RAW_DATES)
Q["spine_coverage"] = "SELECT stream, min(d) AS min_date, max(d) AS max_date, count(*) AS days_present, " \
    "date_diff('day', min(d), max(d)) + 1 - count(*) AS missing_days FROM (" + _RAW_DAYS + ") t GROUP BY stream"
Q["uncovered_days"] = "SELECT min(d) AS min_date, max(d) AS max_date, date_diff('day', min(d), max(d)) + 1 AS days_in_range, " \
    "count(DISTINCT d) AS days_with_data, date_diff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS days_without_data FROM (" + _RAW_DAYS + ") t"

Q["presence_matrix"] = """SELECT dma_name, bool_or(stream = 'ecommerce') AS ecommerce, bool_or(stream = 'paid_social') AS paid_social,
  bool_or(stream = 'web') AS web
FROM (SELECT 'paid_social' AS stream, dma_name FROM paid_base UNION ALL SELECT 'web', dma_name FROM v_web
      UNION ALL SELECT 'ecommerce', dma_name FROM v_txn) t GROUP BY dma_name"""

Q["near_match"] = r""", d AS (SELECT raw, lower(trim(replace(raw, '  ', ' '))) AS norm_key FROM (
             SELECT dma_name AS raw FROM v_txn UNION ALL SELECT dma_name FROM v_web
             UNION ALL SELECT dma_name FROM paid_base UNION ALL SELECT municipality FROM airports_raw) u
           WHERE raw IS NOT NULL),
g AS (SELECT norm_key, raw, count(*) AS n FROM d GROUP BY 1, 2),
v AS (SELECT norm_key, count(*) AS variants FROM g GROUP BY norm_key HAVING count(*) > 1)
SELECT g.norm_key, g.raw, v.variants, g.n AS n_rows FROM g JOIN v ON g.norm_key = v.norm_key"""

Q["state_format"] = """SELECT stream, state, count(*) AS n_rows, coalesce(regexp_matches(state, '^[A-Z]{2}$'), false) AS is_code,
  coalesce(length(state) > 2, false) AS is_full_name
FROM (SELECT 'paid_social' AS stream, state FROM paid_base UNION ALL SELECT 'web', state FROM v_web
      UNION ALL SELECT 'ecommerce', state FROM v_txn UNION ALL SELECT 'airport_lookup', state FROM all_airports) t
GROUP BY stream, state"""

Q["campaign_linkage"] = r""", x AS (SELECT DISTINCT campaign AS left_value FROM web_events WHERE campaign IS NOT NULL),
y AS (SELECT DISTINCT campaign_name AS right_value FROM paid_base WHERE campaign_name IS NOT NULL),
p AS (SELECT x.left_value, y.right_value, nullif(regexp_extract(y.right_value, '^\S+ (.*)$', 1), '') AS theme
      FROM x JOIN y ON lower(x.left_value) <> lower(y.right_value)
        AND (contains(lower(x.left_value), lower(y.right_value)) OR contains(lower(y.right_value), lower(x.left_value))))
SELECT left_value AS web_campaign, right_value AS paid_campaign, theme AS paid_theme, theme = left_value AS exact_theme_match FROM p"""

Q["campaign_crosstab"] = """SELECT campaign, traffic_source, traffic_medium, count(*) AS n_rows FROM web_events GROUP BY ALL"""

def _geo_terms():
    from martline.plans.explore import GEO_TERMS
    return ", ".join(f"('{k}', '{t}', '{m}')" for k, t, m in GEO_TERMS)


V["geo_signals"] = r"""geo_signals AS (
  SELECT per.podcast_name, per.mentions, per.founder_episodes, hits.geo_terms, hits.geo_terms IS NOT NULL AS is_geo,
    per.founder_episodes > 0 AS has_founder
  FROM (SELECT podcast_name, count(*) AS mentions,
          count(DISTINCT CASE WHEN mentions_founder = 1 THEN coalesce(episode_title, '') END) AS founder_episodes
        FROM v_mentions WHERE podcast_name IS NOT NULL GROUP BY 1) per
  LEFT JOIN (SELECT n.text, string_agg(DISTINCT t.kind || ':' || t.term, ',' ORDER BY t.kind || ':' || t.term) AS geo_terms
             FROM (SELECT DISTINCT podcast_name AS text FROM v_mentions WHERE podcast_name IS NOT NULL) n
             JOIN (SELECT * FROM (VALUES """ + _geo_terms() + r""") v(kind, term, mode)) t ON
               CASE WHEN t.mode = 'word' THEN regexp_matches(n.text, '\b' || t.term || '\b')
                    ELSE contains(lower(n.text), lower(t.term)) END GROUP BY n.text) hits ON per.podcast_name = hits.text)"""
DEPS["geo_signals"] = ["v_mentions"]
Q["geo_terms"] = "SELECT * FROM geo_signals"
Q["geo_summary"] = "SELECT is_geo, has_founder, count(*) AS shows FROM geo_signals GROUP BY 1, 2"

Q["campaign_exact"] = r"""SELECT campaign, bool_or(stream = 'paid_name') AS paid_name, bool_or(stream = 'paid_theme') AS paid_theme,
  bool_or(stream = 'web') AS web
FROM (SELECT 'web' AS stream, campaign FROM web_events WHERE length(campaign) > 0
      UNION ALL SELECT 'paid_name', campaign_name FROM paid_base
      UNION ALL SELECT 'paid_theme', nullif(regexp_extract(campaign_name, '^\S+ (.*)$', 1), '') FROM paid_base) t
WHERE campaign IS NOT NULL GROUP BY campaign"""

Q["podcast_metrics"] = _u(
    f"""SELECT '{c}' AS metric, count(v) AS n, round(min(v), 2) AS min, round(max(v), 2) AS max, round(avg(v), 2) AS mean,
  round(median(v), 2) AS median, round(stddev_samp(v), 2) AS stdev
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM v_mentions) t""" for c in ("estimated_impressions", "episode_rating"))

Q["stable_sample"] = """SELECT """ + ", ".join(TXN_COLS) + """ FROM (
  SELECT *, md5('42|' || coalesce(order_id, '') || '|' || coalesce(product_category, '') || '|' || coalesce(CAST(quantity AS VARCHAR), '')) AS h FROM txn_out) t
ORDER BY h, order_id, product_category, quantity, """ + ", ".join(c for c in TXN_COLS if c not in ("order_id", "product_category", "quantity")) + """ LIMIT 20"""

Q["metric_distribution"] = """SELECT podcast_name, count(v) AS n, round(min(v), 2) AS min, round(max(v), 2) AS max, round(avg(v), 2) AS mean,
  round(median(v), 2) AS median, round(stddev_samp(v), 2) AS stdev
FROM (SELECT podcast_name, CAST(estimated_impressions AS DOUBLE) AS v FROM v_mentions) t GROUP BY podcast_name"""

Q["sentiment_shares"] = """SELECT sentiment, count(*) AS n, round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM v_mentions WHERE sentiment IS NOT NULL GROUP BY sentiment"""


Q["distinct_values"] = """SELECT 'fact_ecommerce_transactions' AS table_name, product_category, count(*) AS n_rows FROM v_txn
  WHERE product_category IS NOT NULL GROUP BY 2
UNION ALL SELECT 'fact_ecommerce_daily', product_category, count(*) FROM ecommerce_daily
  WHERE product_category IS NOT NULL GROUP BY 2"""

Q["missing_dates"] = """, u AS (""" + _RAW_DAYS + """),
rng AS (SELECT stream, min(d) AS s, max(d) AS e FROM u GROUP BY stream),
days AS (SELECT stream, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM rng)
SELECT stream, date FROM days WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.stream = days.stream AND u.d = days.date)"""

Q["duplicate_rows"] = "SELECT " + ", ".join(_WCOLS) + ", count(*) AS count FROM v_web_parts GROUP BY ALL HAVING count(*) > 1"

Q["date_columns"] = _u(
    f"""SELECT '{c}' AS column_name, count(v) AS non_null, count(v) > 0 AND count(*) FILTER (WHERE v IS NOT NULL AND try_strptime(v, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d', '%m/%d/%Y']) IS NULL) = 0 AS is_date
FROM (SELECT CAST({c} AS VARCHAR) AS v FROM v_txn) t"""
    for c in ["order_datetime", "order_id", "dma_name", "product_category", "size"])

Q["airport_inventory"] = """SELECT airport_code, arg_max(airport_name, week_start_date) AS airport_name, count(*) AS weeks
FROM v_ooh_weekly GROUP BY airport_code"""

Q["campaign_ids"] = """SELECT campaign_id, max(campaign_name) AS campaign_name, count(DISTINCT campaign_name) AS names,
  count(*) AS n_rows FROM paid_social GROUP BY campaign_id"""

Q["daily_distincts"] = """, o AS (SELECT date, count(DISTINCT order_id) AS orders_exact FROM v_txn GROUP BY date),
eo AS (SELECT date, CAST(sum(orders) AS BIGINT) AS orders_summed FROM ecommerce_daily GROUP BY date),
w AS (SELECT date, count(DISTINCT session_id) AS sessions_exact, count(DISTINCT user_id) AS users_exact
      FROM web_events GROUP BY date),
ws AS (SELECT date, CAST(sum(sessions) AS BIGINT) AS sessions_summed, CAST(sum(users) AS BIGINT) AS users_summed
       FROM web_daily GROUP BY date),
a AS (SELECT coalesce(o.date, eo.date) AS date, orders_exact, orders_summed FROM o FULL OUTER JOIN eo ON o.date = eo.date),
b AS (SELECT coalesce(w.date, ws.date) AS date, sessions_exact, users_exact, sessions_summed, users_summed
      FROM w FULL OUTER JOIN ws ON w.date = ws.date)
SELECT coalesce(a.date, b.date) AS date, orders_exact, orders_summed, sessions_exact, users_exact, sessions_summed,
  users_summed FROM a FULL OUTER JOIN b ON a.date = b.date"""

Q["discount_by_promo"] = """SELECT promo_flag, count(v) AS n, round(min(v), 2) AS min, round(max(v), 2) AS max, round(avg(v), 2) AS mean,
  round(median(v), 2) AS median, round(stddev_samp(v), 2) AS stdev
FROM (SELECT promo_flag, CAST(discount_per_unit AS DOUBLE) AS v FROM v_txn) t GROUP BY promo_flag"""

Q["post_id_reuse"] = """SELECT uses, count(*) AS post_ids FROM (SELECT post_id, count(*) AS uses FROM v_posts GROUP BY post_id) t
GROUP BY uses"""

Q["follower_first_decreases"] = """, fp AS (SELECT date, min(post_id) AS pid FROM v_posts GROUP BY date),
day AS (SELECT p.date, min(p.followers) FILTER (WHERE p.post_id = fp.pid) AS followers
        FROM v_posts p JOIN fp ON p.date = fp.date GROUP BY p.date),
s AS (SELECT date, followers, lag(followers) OVER (ORDER BY date) AS prev_followers FROM day)
SELECT date, followers, prev_followers FROM s WHERE followers < prev_followers ORDER BY date LIMIT 10"""

Q["negative_revenue_lines"] = """SELECT date, order_id, product_category, size, quantity, unit_price, line_revenue,
  discount_per_unit, promo_flag FROM txn_out WHERE line_revenue < 0
ORDER BY date, order_id, product_category, size, quantity, unit_price, line_revenue, discount_per_unit, promo_flag LIMIT 5"""

Q["sessions_edge_days"] = """, p AS (SELECT CAST(event_datetime AS DATE) AS date, count(*) AS n_rows, count(DISTINCT session_id) AS sessions,
  count(DISTINCT user_id) AS users FROM web_events GROUP BY 1)
SELECT * FROM (SELECT *, 'first' AS edge FROM p ORDER BY date LIMIT 3)
UNION ALL SELECT * FROM (SELECT *, 'last' AS edge FROM p ORDER BY date DESC LIMIT 3)"""


# ------------------------------------------------------------------ written files: sources and sinks
def _decimal(c):
    # digits before and after the point, as the values are written
    return f"""SELECT '{c}' AS column_name, 'decimal(' || (max(length(CAST(CAST(trunc(abs({c})) AS BIGINT) AS VARCHAR))) + max(length(split_part(CAST({c} AS VARCHAR), '.', 2))))
  || ',' || max(length(split_part(CAST({c} AS VARCHAR), '.', 2))) || ')' AS type, count({c}) AS n_values FROM lineitem"""


Q["csv_types"] = _u(
    [f"SELECT '{c}' AS column_name, 'bigint' AS type, count({c}) AS n_values FROM lineitem" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    + [_decimal(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    + [f"SELECT '{c}' AS column_name, '{t}' AS type, count({c}) AS n_values FROM lineitem"
       for c, t in (("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))])

Q["csv_round_trip"] = "SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem"

Q["csv_untyped"] = _u(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS empty, count(DISTINCT coalesce(CAST({c} AS VARCHAR), '')) AS distinct_texts FROM v_web"
    for c in ("event_datetime", "user_id", "page_url", "traffic_source", "campaign", "zip_code"))

Q["month_slice"] = "SELECT date, count(*) AS n_rows FROM web_events WHERE date BETWEEN DATE '1998-01-10' AND DATE '1998-02-20' GROUP BY date"

Q["replaced_table"] = """SELECT CAST(1 AS BIGINT) AS version, count(*) AS n_rows, false AS current, true AS verified FROM orders
UNION ALL SELECT CAST(2 AS BIGINT), count(*), true, true FROM orders WHERE o_orderstatus = 'F'"""

Q["two_outputs"] = """SELECT 'clean' AS table_name, count(*) AS n_rows FROM v_txn UNION ALL SELECT 'detail', count(*) FROM v_txn
UNION ALL SELECT 'daily', count(*) FROM ecommerce_daily"""

Q["published_tables"] = _u(f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS verified, true AS change_found FROM {t}" for t in ("customer", "part", "supplier"))

Q["step_metrics"] = _u(
    f"""SELECT '{step}' AS step, (SELECT count(*) FROM {src}) AS rows_in, count(*) AS rows, CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date,
  '{actions}' AS actions FROM {out}"""
    for step, src, out, actions in (("web_events", "v_web_parts", "web_events", "overlap dropped"), ("organic_daily", "v_posts", "organic_daily", "grouped by day"),
                                    ("podcast_daily", "v_mentions", "podcast_daily", "grouped by day, show and episode")))

Q["exported_order"] = "SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_totalprice DESC, o_orderkey) AS place FROM orders"

Q["first_appearance"] = """, e AS (SELECT *, row_number() OVER () AS rn FROM events),
f AS (SELECT user_id, min(rn) AS rn FROM e GROUP BY user_id)
SELECT f.user_id, row_number() OVER (ORDER BY f.rn) AS user_number, e.event_type, e.value FROM f JOIN e ON e.rn = f.rn"""

Q["event_rolling"] = """, e AS (SELECT event_id, ts, CAST(value AS DECIMAL(18,4)) AS v FROM events),
w AS (
  SELECT event_id, v, CAST(sum(v) OVER t AS DOUBLE) / count(v) OVER t AS value_7,
    CASE WHEN count(v) OVER c >= 14 THEN CAST(sum(v) OVER c AS DOUBLE) / count(v) OVER c END AS value_14, CAST(lag(v) OVER o AS DOUBLE) AS value_prev
  FROM e WINDOW o AS (ORDER BY ts, event_id), t AS (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
    c AS (ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING))
SELECT event_id, value_7, value_14, CAST(v AS DOUBLE) - value_14 AS value_resid, value_prev FROM w"""


# ------------------------------------------------------------------ keys and mergeable states
_KEY_TABLES = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "events": "event_id ts user_id event_type value props",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
}


def _keys(table, cols):
    def unique(*c):
        return f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(c)} FROM {table}) x) = (SELECT count(*) FROM {table})"
    ones = [f"SELECT '{c}' AS a, CAST(NULL AS VARCHAR) AS b, {unique(c)} AS u" for c in cols]
    twos = [f"SELECT '{a}', '{b}', {unique(a, b)}" for i, a in enumerate(cols) for b in cols[i + 1:]]
    return f"""SELECT '{table}' AS table_name, concat_ws(',', a, b) AS key_columns, CAST(1 + (b IS NOT NULL)::INT AS INTEGER) AS size
FROM (SELECT *, string_agg(CASE WHEN b IS NULL AND u THEN a END, ',') OVER () AS singles FROM ({_u(ones + twos)}) c) k
WHERE u AND (b IS NULL OR NOT (list_contains(string_split(coalesce(singles, ''), ','), a) OR list_contains(string_split(coalesce(singles, ''), ','), b)))"""


Q["minimal_keys"] = _u(_keys(t, c.split()) for t, c in _KEY_TABLES.items())

Q["monthly_distincts"] = """SELECT strftime(date, '%Y-%m') AS month, count(*) AS n_rows, count(DISTINCT session_id) AS session_ids, count(DISTINCT user_id) AS user_ids,
  true AS session_ids_close, true AS user_ids_close FROM web_events GROUP BY 1"""

Q["profile_merged"] = _u(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
  round(CAST(sum(CAST({c} AS DECIMAL(38,8))) AS DOUBLE) / count({c}), 6) AS mean, round(stddev_samp({c}), 4) AS stdev, true AS unique_close FROM txn_out"""
    for c in ("quantity", "unit_price", "line_revenue"))

Q["raw_spend_totals"] = """SELECT _file AS file, count(spend) AS n_rows, CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM paid_base GROUP BY _file"""

Q["geo_columns"] = _u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS filled, count(DISTINCT {c}) AS distinct_values FROM {v}"
    for t, v, cols in (("transactions", "v_txn", "dma_name state zip_code"), ("web", "v_web", "dma_name state zip_code"))
    for c in cols.split())
