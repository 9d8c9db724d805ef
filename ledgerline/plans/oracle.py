"""Independent DuckDB SQL for every registered query.

Each text runs against the supplied tables registered as views (orders, customer,
lineitem, events, documents, ...). The derivations repeat the fixture rules in SQL
(written separately from the DataFrame code in sources/fixtures.py); the metric uses
the straightforward months x subscriptions theta join that the DataFrame side avoids.
"""

from __future__ import annotations

from ledgerline.plans.params import WINDOW_END, WINDOW_START

# ---------------------------------------------------------------------------------------
# Common table expressions
# ---------------------------------------------------------------------------------------

SUBS = """
subs AS (
  SELECT 'sub_' || o_orderkey AS stripe_subscription_id,
         'cus_' || o_custkey AS stripe_customer_id,
         CASE o_orderkey % 8 WHEN 0 THEN 'active' WHEN 1 THEN 'canceled' WHEN 2 THEN 'past_due'
              WHEN 3 THEN 'trialing' WHEN 4 THEN 'incomplete' WHEN 5 THEN 'incomplete_expired'
              WHEN 6 THEN 'unpaid' ELSE 'canceled' END AS status,
         'price_' || (o_orderkey % 3) AS current_price_id,
         CAST(CASE o_orderkey % 3 WHEN 0 THEN 5000 WHEN 1 THEN 10000 ELSE 25000 END AS BIGINT) AS unit_amount_cents,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'month' WHEN '2' THEN 'MONTH' WHEN '3' THEN 'year'
              WHEN '4' THEN 'week' END AS bill_interval,
         CAST(1 + o_orderkey % 3 AS BIGINT) AS interval_count,
         o_orderdate AS start_date,
         CASE WHEN o_orderkey % 8 IN (1, 7)
              THEN lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) END AS canceled_at,
         o_orderdate AS created_at
  FROM orders
)"""

MONTHS = f"""
months AS (
  SELECT CAST(unnest(generate_series(DATE '{WINDOW_START}', DATE '{WINDOW_END}', INTERVAL 1 MONTH)) AS DATE) AS month_start
)"""

ACTIVE = """
active AS (
  SELECT stripe_subscription_id, stripe_customer_id, status,
         CAST(start_date AS DATE) AS sd, CAST(canceled_at AS DATE) AS cd,
         unit_amount_cents, lower(bill_interval) AS it, interval_count,
         CASE WHEN lower(bill_interval) = 'month' THEN unit_amount_cents / interval_count / 100.0
              WHEN lower(bill_interval) = 'year' THEN unit_amount_cents / 12.0 / interval_count / 100.0 END AS amt
  FROM subs
  WHERE status NOT IN ('incomplete', 'incomplete_expired')
)"""

# end-of-month snapshot: every (month, activated subscription) pair, amount may be NULL
PAIRS = """
pairs AS (
  SELECT m.month_start, s.*
  FROM months m CROSS JOIN active s
  WHERE s.sd <= last_day(m.month_start) AND (s.cd IS NULL OR s.cd > last_day(m.month_start))
)"""

TOTALS = """
totals AS (
  SELECT m.month_start, COALESCE(SUM(p.amt), 0) AS total
  FROM months m LEFT JOIN pairs p ON p.month_start = m.month_start
  GROUP BY m.month_start
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DECIMAL(18,2))"


ORACLE: dict[str, str] = {}

ORACLE["mrr_monthly"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"""
SELECT month_start AS month, {money('SUM(amt)')} AS mrr_amount
FROM pairs WHERE amt IS NOT NULL
GROUP BY month_start""",
)

PAIRS_ANY = """
pairs_any AS (
  SELECT m.month_start, s.*
  FROM months m CROSS JOIN active s
  WHERE s.sd <= last_day(m.month_start) AND (s.cd IS NULL OR s.cd >= m.month_start)
)"""

TIER_PAIRS = f"""
tc AS (
  SELECT v0.stripe_customer_id,
         v0.stripe_subscription_id AS v0_sub_id, v1.stripe_subscription_id AS v1_sub_id,
         CAST(v0.canceled_at AS DATE) AS v0_cancel_date, CAST(v1.start_date AS DATE) AS v1_start_date,
         CAST(date_trunc('month', CAST(v0.canceled_at AS DATE)) AS DATE) AS month,
         CASE WHEN lower(v0.bill_interval) = 'month' THEN v0.unit_amount_cents / v0.interval_count / 100.0
              WHEN lower(v0.bill_interval) = 'year' THEN v0.unit_amount_cents / 12.0 / v0.interval_count / 100.0 END AS c0,
         CASE WHEN lower(v1.bill_interval) = 'month' THEN v1.unit_amount_cents / v1.interval_count / 100.0
              WHEN lower(v1.bill_interval) = 'year' THEN v1.unit_amount_cents / 12.0 / v1.interval_count / 100.0 END AS c1
  FROM subs v0
  JOIN subs v1
    ON v0.stripe_customer_id = v1.stripe_customer_id
   AND v0.stripe_subscription_id <> v1.stripe_subscription_id
   AND v0.canceled_at IS NOT NULL
   AND CAST(v1.start_date AS DATE) >= CAST(v0.canceled_at AS DATE)
   AND CAST(v1.start_date AS DATE) <= CAST(v0.canceled_at AS DATE) + 1
  WHERE CAST(v0.canceled_at AS DATE) >= DATE '{WINDOW_START}'
    AND CAST(v0.canceled_at AS DATE) <= DATE '{WINDOW_END}'
)"""

CANDIDATES = f"""
cand AS (
  SELECT stripe_subscription_id AS cid,
         CAST(date_trunc('month', CAST(canceled_at AS DATE)) AS DATE) AS cm,
         CASE WHEN lower(bill_interval) = 'month' THEN unit_amount_cents / interval_count / 100.0
              WHEN lower(bill_interval) = 'year' THEN unit_amount_cents / 12.0 / interval_count / 100.0 END AS c
  FROM subs
  WHERE status = 'canceled' AND canceled_at IS NOT NULL
    AND CAST(canceled_at AS DATE) >= DATE '{WINDOW_START}' + INTERVAL 1 MONTH
    AND CAST(canceled_at AS DATE) < DATE '{WINDOW_END}'
),
cand_months AS (
  SELECT cid, cm, c, CAST(cm - INTERVAL 1 MONTH AS DATE) AS month FROM cand
  UNION ALL
  SELECT cid, cm, c, cm AS month FROM cand
),
loo AS (
  SELECT k.cid, k.cm, k.c, k.month, COALESCE(SUM(COALESCE(p.amt, 0)), 0) AS excl
  FROM cand_months k
  LEFT JOIN pairs p ON p.month_start = k.month AND p.stripe_subscription_id <> k.cid
  GROUP BY k.cid, k.cm, k.c, k.month
)"""

STRICT = """
strict AS (
  SELECT month_start, SUM(amt) AS mrr FROM pairs WHERE amt IS NOT NULL GROUP BY month_start
)"""

ORACLE["mrr_monthly_filled"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"""
SELECT m.month_start AS month, {money('COALESCE(SUM(p.amt), 0)')} AS mrr_amount
FROM months m LEFT JOIN pairs p ON p.month_start = m.month_start AND p.amt IS NOT NULL
GROUP BY m.month_start""",
)

ORACLE["mrr_any_part_of_month"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS_ANY,
    body=f"""
SELECT month_start AS month, {money('SUM(amt)')} AS mrr_amount
FROM pairs_any WHERE amt IS NOT NULL
GROUP BY month_start""",
)

ORACLE["mrr_window_total"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"SELECT {money('COALESCE(SUM(amt), 0)')} AS window_total FROM pairs WHERE amt IS NOT NULL",
)

ORACLE["mrr_active_pairs"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"SELECT month_start AS month, stripe_subscription_id, {money('amt')} AS amount FROM pairs WHERE amt IS NOT NULL",
)

ORACLE["mrr_left_fill"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"""
SELECT m.month_start AS month, COUNT(p.stripe_subscription_id) AS active_pairs,
       {money('COALESCE(SUM(COALESCE(p.amt, 0)), 0)')} AS mrr_amount
FROM months m LEFT JOIN pairs p ON p.month_start = m.month_start
GROUP BY m.month_start""",
)

ORACLE["mrr_inner_theta"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"""
SELECT month_start AS month, COUNT(*) AS active_pairs, {money('SUM(COALESCE(amt, 0))')} AS mrr_amount
FROM pairs GROUP BY month_start""",
)

ORACLE["tier_change_pairs"] = with_ctes(
    SUBS, TIER_PAIRS,
    body="SELECT stripe_customer_id, v0_sub_id, v1_sub_id, v0_cancel_date, v1_start_date FROM tc",
)

ORACLE["mrr_leave_one_out"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, CANDIDATES,
    body=f"SELECT cid AS stripe_subscription_id, month, {money('excl')} AS mrr_excluding FROM loo",
)

ORACLE["mrr_excluding_pair"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, TIER_PAIRS,
    body=f"""
SELECT t.v0_sub_id, t.v1_sub_id, t.month, {money('COALESCE(SUM(COALESCE(p.amt, 0)), 0)')} AS mrr_excluding_pair
FROM tc t
LEFT JOIN pairs p ON p.month_start = t.month AND p.stripe_subscription_id NOT IN (t.v0_sub_id, t.v1_sub_id)
GROUP BY t.v0_sub_id, t.v1_sub_id, t.month""",
)

ORACLE["check_cancel_month"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, CANDIDATES, STRICT,
    body=f"""
SELECT lp.cid AS stripe_subscription_id, lp.cm AS cancel_month, {money('lp.c')} AS contribution,
       COALESCE(ROUND(sp.mrr, 2) = ROUND(lp.excl + lp.c, 2), false) AS prev_ok,
       COALESCE(ROUND(sc.mrr, 2) = ROUND(lc.excl, 2), false) AS cancel_ok
FROM loo lp
JOIN loo lc ON lc.cid = lp.cid AND lc.month = lc.cm
LEFT JOIN strict sp ON sp.month_start = lp.month
LEFT JOIN strict sc ON sc.month_start = lc.month
WHERE lp.month < lp.cm AND lp.c IS NOT NULL""",
)

ORACLE["check_tier_change"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, TIER_PAIRS, STRICT,
    body="""
SELECT x.v0_sub_id, x.v1_sub_id, x.month,
       COALESCE(ROUND(s.mrr, 2) = ROUND(x.excl + COALESCE(x.c1, 0), 2), false) AS v1_only_ok,
       COALESCE(ROUND(s.mrr, 2) <> ROUND(x.excl + COALESCE(x.c0, 0) + COALESCE(x.c1, 0), 2), false) AS no_double_count
FROM (
  SELECT t.v0_sub_id, t.v1_sub_id, t.month, t.c0, t.c1, COALESCE(SUM(COALESCE(p.amt, 0)), 0) AS excl
  FROM tc t
  LEFT JOIN pairs p ON p.month_start = t.month AND p.stripe_subscription_id NOT IN (t.v0_sub_id, t.v1_sub_id)
  GROUP BY t.v0_sub_id, t.v1_sub_id, t.month, t.c0, t.c1
) x
LEFT JOIN strict s ON s.month_start = x.month""",
)

ORACLE["check_total_reconciles"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, STRICT,
    body=f"""
SELECT months_sum, window_total, months_sum = window_total AS reconciles FROM (
  SELECT {money('(SELECT SUM(ROUND(mrr, 9)) FROM strict)')} AS months_sum,
         {money('(SELECT SUM(amt) FROM pairs WHERE amt IS NOT NULL)')} AS window_total)""",
)

# ---------------------------------------------------------------------------------------
# Raw objects and flatten: the same corruption rules applied to the base rows
# (r = numeric id % 101: 3 ISO created, 5 junk created, 7 no items, 11 unknown status,
#  13 live mode, 17 not JSON, 19 no metadata, 23 no recurring; every 4th id listed twice)
# ---------------------------------------------------------------------------------------

RUN_TS = "TIMESTAMP '2026-01-01 00:00:00'"

RSUBS = """
rsubs AS (
  SELECT s.*, CAST(substr(stripe_subscription_id, 5) AS BIGINT) AS n,
         CAST(substr(stripe_subscription_id, 5) AS BIGINT) % 101 AS r
  FROM subs s
),
lsubs AS (
  SELECT *,
         CASE WHEN r = 11 THEN 'unknown_status' ELSE status END AS raw_status,
         CASE WHEN r = 3 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') WHEN r = 5 THEN 'not-a-time'
              ELSE CAST(CAST(epoch(created_at) AS BIGINT) AS VARCHAR) END AS created_raw,
         'seed-sub-' || stripe_customer_id || '-' || stripe_subscription_id AS idem
  FROM rsubs
  WHERE r NOT IN (13, 7, 17)
)"""

RCUST = """
rcust AS (
  SELECT c_custkey AS ck, c_custkey % 101 AS r, 'cus_' || c_custkey AS id,
         lower(c_name) || '@example.com' AS email, c_name AS name,
         make_timestamp(CAST(770000000 + c_custkey * 60 AS BIGINT) * 1000000) AS created_ts,
         'clock_' || CAST(floor(c_custkey / 3) AS BIGINT) AS clock,
         (c_custkey % 10 = 0 OR c_custkey % 101 = 13) AS live
  FROM customer
),
lcust AS (
  SELECT *,
         CASE WHEN r = 3 THEN strftime(created_ts, '%Y-%m-%dT%H:%M:%SZ') WHEN r = 5 THEN 'not-a-time'
              ELSE CAST(770000000 + ck * 60 AS VARCHAR) END AS created_raw
  FROM rcust WHERE NOT live AND r <> 17
)"""

RINV = """
inv AS (
  SELECT 'in_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS id,
         l_orderkey % 101 AS r,
         'cus_' || o_custkey AS customer,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE 'sub_' || l_orderkey END AS subscription,
         l_shipdate AS period_start,
         CASE l_returnflag WHEN 'R' THEN 'void' WHEN 'A' THEN 'paid' ELSE 'open' END AS status,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS total,
         l_returnflag = 'A' AS paid,
         CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS paid_at,
         o_orderdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
linv AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY period_start, total, status) AS rn
    FROM inv WHERE r <> 17
  ) WHERE rn = 1
)"""

ORACLE["load_customers"] = with_ctes(
    RCUST, body="SELECT id, email, name, created_raw AS created, false AS livemode FROM lcust",
)

ORACLE["load_subscriptions"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT stripe_subscription_id AS id, stripe_customer_id AS customer, raw_status AS status,
       created_raw AS created, CAST(1 AS BIGINT) AS n_items FROM lsubs""",
)

ORACLE["load_invoices"] = with_ctes(
    RINV, body="SELECT id, customer, subscription, status, total FROM linv",
)

ORACLE["scope_union"] = with_ctes(
    RCUST,
    body="""SELECT id, CASE WHEN r = 13 AND false THEN '' ELSE 'default' END AS scope, name,
       CASE WHEN ck % 4 = 0 THEN 2 ELSE 1 END AS listings
FROM rcust WHERE r <> 17""",
)

ORACLE["union_distinct_by_id"] = with_ctes(
    SUBS, RSUBS, RCUST, RINV,
    body="""SELECT 'customers' AS entity, id FROM lcust
UNION ALL SELECT 'subscriptions', stripe_subscription_id FROM lsubs
UNION ALL SELECT 'invoices', id FROM linv""",
)

ORACLE["epoch_to_ts"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT stripe_subscription_id AS id, created_raw,
       CASE WHEN r = 5 THEN NULL ELSE created_at END AS created_at FROM lsubs""",
)

ORACLE["flatten_price"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT stripe_subscription_id AS id, current_price_id, unit_amount_cents, 'usd' AS currency,
       CASE WHEN r = 23 THEN NULL ELSE bill_interval END AS bill_interval,
       CASE WHEN r = 23 THEN NULL ELSE interval_count END AS interval_count
FROM lsubs""",
)

ORACLE["metadata_json"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT stripe_subscription_id AS id,
       CASE WHEN r = 19 THEN NULL ELSE '{"idempotency_key":"' || idem || '"}' END AS metadata
FROM lsubs""",
)

ORACLE["metadata_get"] = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"

ORACLE["nested_field"] = with_ctes(
    RCUST,
    body="SELECT id AS stripe_customer_id, CASE WHEN ck % 2 = 0 THEN 'usd' END AS default_currency FROM lcust",
)

ORACLE["stamp_synced_at"] = with_ctes(
    RCUST, body=f"SELECT id AS stripe_customer_id, {RUN_TS} AS synced_at FROM lcust WHERE r <> 5",
)

ORACLE["flatten_customer"] = with_ctes(
    RCUST,
    body=f"""SELECT id AS stripe_customer_id, email, name, created_ts AS created_at,
       CASE WHEN ck % 2 = 0 THEN 'usd' END AS default_currency, false AS livemode,
       CASE WHEN r = 19 THEN NULL ELSE clock END AS test_clock_id,
       CASE WHEN r = 19 THEN NULL ELSE '{{"test_clock_id":"' || clock || '"}}' END AS metadata,
       {RUN_TS} AS synced_at
FROM lcust WHERE r <> 5""",
)

ORACLE["flatten_subscription"] = with_ctes(
    SUBS, RSUBS,
    body=f"""SELECT stripe_subscription_id, stripe_customer_id, status, current_price_id, unit_amount_cents,
       'usd' AS currency,
       CASE WHEN r = 23 THEN NULL ELSE bill_interval END AS bill_interval,
       CASE WHEN r = 23 THEN NULL ELSE interval_count END AS interval_count,
       start_date AS billing_cycle_anchor, start_date AS current_period_start, start_date AS current_period_end,
       start_date, canceled_at, canceled_at AS ended_at, created_at, false AS livemode,
       CASE WHEN r = 19 THEN NULL ELSE idem END AS idempotency_key,
       CASE WHEN r = 19 THEN NULL ELSE '{{"idempotency_key":"' || idem || '"}}' END AS metadata,
       {RUN_TS} AS synced_at
FROM lsubs
WHERE r <> 5 AND raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')""",
)

ORACLE["flatten_invoice"] = with_ctes(
    RINV,
    body=f"""SELECT id AS stripe_invoice_id, customer AS stripe_customer_id, subscription AS stripe_subscription_id,
       period_start, period_start AS period_end, status, total AS total_cents,
       CASE WHEN paid THEN total ELSE 0 END AS amount_paid_cents,
       CASE WHEN paid THEN 0 ELSE total END AS amount_due_cents,
       'usd' AS currency, paid_at, created_at, false AS livemode, CAST(NULL AS VARCHAR) AS metadata,
       {RUN_TS} AS synced_at
FROM linv WHERE r <> 5""",
)

ORACLE["valid_status"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT raw_status AS status,
       raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete') AS admitted,
       COUNT(*) AS rows
FROM lsubs GROUP BY raw_status""",
)

ORACLE["skip_livemode"] = "SELECT 'cus_' || c_custkey AS stripe_customer_id FROM customer WHERE c_custkey % 10 <> 0"

ORACLE["skip_no_items"] = with_ctes(
    SUBS, RSUBS, body="SELECT stripe_subscription_id AS id FROM rsubs WHERE r = 7",
)

ORACLE["skip_malformed"] = with_ctes(
    SUBS, RSUBS, RCUST, RINV,
    body="""SELECT entity, reason, rows FROM (
  SELECT 'customers' AS entity, 'not_json' AS reason,
         SUM(CASE WHEN ck % 4 = 0 THEN 2 ELSE 1 END) AS rows
  FROM rcust WHERE r = 17
  UNION ALL
  SELECT 'customers', 'bad_created', COUNT(*) FROM lcust WHERE r = 5
  UNION ALL
  SELECT 'subscriptions', 'not_json', SUM(CASE WHEN n % 4 = 0 THEN 2 ELSE 1 END) FROM rsubs WHERE r = 17
  UNION ALL
  SELECT 'subscriptions', 'invalid_status', COUNT(*) FROM lsubs
  WHERE raw_status NOT IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')
  UNION ALL
  SELECT 'subscriptions', 'bad_created', COUNT(*) FROM lsubs
  WHERE r = 5 AND raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')
  UNION ALL
  SELECT 'invoices', 'not_json', COUNT(*) FROM inv WHERE r = 17
  UNION ALL
  SELECT 'invoices', 'bad_created', COUNT(*) FROM linv WHERE r = 5
) WHERE rows > 0""",
)

ORACLE["invoices_of_known_customers"] = with_ctes(
    RCUST, RINV,
    body="""SELECT id AS stripe_invoice_id, customer AS stripe_customer_id FROM linv
WHERE r <> 5 AND (CAST(split_part(id, '_', 2) AS BIGINT) % 3 <> 0 OR customer IN (SELECT id FROM lcust WHERE r <> 5))""",
)

# ---------------------------------------------------------------------------------------
# Tables: two loads by key parity, sync counts, bookmarks, incremental load
# ---------------------------------------------------------------------------------------

LOADS = """
loads AS (
  SELECT stripe_subscription_id, status, unit_amount_cents, created_at,
         CAST(substr(stripe_subscription_id, 5) AS BIGINT) AS n
  FROM subs
)"""

ORACLE["staged_append"] = with_ctes(
    SUBS,
    body="""SELECT stripe_subscription_id, status, unit_amount_cents, CAST(NULL AS VARCHAR) AS current_price_id,
       created_at, CAST(NULL AS TIMESTAMP) AS ended_at FROM subs""",
)

ORACLE["upsert_by_key"] = with_ctes(
    SUBS, LOADS,
    body="""SELECT stripe_subscription_id, status,
       CASE WHEN n % 3 <> 0 THEN unit_amount_cents + 100 ELSE unit_amount_cents END AS unit_amount_cents,
       CAST(date_trunc('month', CAST(created_at AS TIMESTAMP)
            + CASE WHEN n % 3 <> 0 AND n % 2 = 0 THEN INTERVAL 40 DAY ELSE INTERVAL 0 DAY END) AS DATE) AS created_month
FROM loads""",
)

ORACLE["upsert_counts"] = with_ctes(
    SUBS, LOADS,
    body="""SELECT 1 AS load, COUNT(*) FILTER (WHERE n % 3 <> 2) AS inserted, 0::BIGINT AS updated FROM loads
UNION ALL SELECT 2, COUNT(*) FILTER (WHERE n % 3 = 2), COUNT(*) FILTER (WHERE n % 3 = 1) FROM loads""",
)

ORACLE["upsert_match"] = with_ctes(
    SUBS, LOADS,
    body="""SELECT stripe_subscription_id,
       CASE WHEN n % 3 = 1 THEN 'matched' WHEN n % 3 = 2 THEN 'source_only' ELSE 'target_only' END AS side
FROM loads""",
)

ENTITY_COUNTS = """
ecounts AS (
  SELECT 'customers' AS entity,
         (SELECT COUNT(*) FROM lcust) + (SELECT SUM(CASE WHEN ck % 4 = 0 THEN 2 ELSE 1 END) FROM rcust WHERE r = 17) AS fetched,
         (SELECT COUNT(*) FROM lcust WHERE r <> 5) AS accepted,
         (SELECT SUM(CASE WHEN ck % 4 = 0 THEN 2 ELSE 1 END) FROM rcust WHERE r = 17)
           + (SELECT COUNT(*) FROM lcust WHERE r = 5) AS rejected
  UNION ALL
  SELECT 'subscriptions',
         (SELECT COUNT(*) FROM lsubs) + (SELECT SUM(CASE WHEN n % 4 = 0 THEN 2 ELSE 1 END) FROM rsubs WHERE r = 17),
         (SELECT COUNT(*) FROM lsubs WHERE r <> 5
            AND raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')),
         (SELECT SUM(CASE WHEN n % 4 = 0 THEN 2 ELSE 1 END) FROM rsubs WHERE r = 17)
           + (SELECT COUNT(*) FROM lsubs
              WHERE r = 5 OR raw_status NOT IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete'))
  UNION ALL
  SELECT 'invoices',
         (SELECT COUNT(*) FROM linv) + (SELECT COUNT(*) FROM inv WHERE r = 17),
         (SELECT COUNT(*) FROM linv WHERE r <> 5),
         (SELECT COUNT(*) FROM inv WHERE r = 17) + (SELECT COUNT(*) FROM linv WHERE r = 5)
)"""

ORACLE["dry_run"] = with_ctes(
    SUBS, RSUBS, RCUST, RINV, ENTITY_COUNTS,
    body="""SELECT entity, fetched, 0 AS inserted, 0 AS updated, rejected FROM ecounts
UNION ALL SELECT 'total', SUM(fetched), 0, 0, SUM(rejected) FROM ecounts""",
)

ORACLE["sync_summary"] = with_ctes(
    SUBS, RSUBS, RCUST, RINV, ENTITY_COUNTS,
    body="""SELECT entity, fetched, accepted AS inserted, 0 AS updated, rejected, 0 AS errors FROM ecounts
UNION ALL SELECT 'total', SUM(fetched), SUM(accepted), 0, SUM(rejected), 0 FROM ecounts""",
)

ORACLE["watermark_read"] = with_ctes(
    RCUST,
    body=f"""SELECT 'customers' AS sync_key, {RUN_TS} AS last_synced_at, COUNT(*) AS rows_synced FROM lcust WHERE r <> 5
UNION ALL SELECT 'invoices', CAST(NULL AS TIMESTAMP), 0""",
)

ORACLE["incremental_upsert"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT stripe_subscription_id, status,
       CASE WHEN n % 3 <> 0 THEN CAST('1' || unit_amount_cents AS BIGINT) ELSE unit_amount_cents END AS unit_amount_cents
FROM lsubs
WHERE r <> 5
  AND raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')""",
)

ORACLE["check_resync_idempotent"] = with_ctes(
    SUBS, RSUBS,
    body="""SELECT stripe_customer_id, COUNT(*) AS subs_before, COUNT(*) AS subs_after, true AS unchanged
FROM lsubs
WHERE r <> 5 AND raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')
GROUP BY stripe_customer_id""",
)

# ---------------------------------------------------------------------------------------
# Scans, scalar functions, filters, aggregates, ordering, generator, series
# ---------------------------------------------------------------------------------------

AMT = """CASE WHEN lower(bill_interval) = 'month' THEN unit_amount_cents / interval_count / 100.0
              WHEN lower(bill_interval) = 'year' THEN unit_amount_cents / 12.0 / interval_count / 100.0 END"""

ORACLE["scan_subscriptions"] = with_ctes(
    SUBS, ACTIVE,
    body="""SELECT stripe_subscription_id, sd AS sub_start_date, cd AS sub_canceled_date, status, unit_amount_cents,
       it AS interval_type, interval_count FROM active""",
)
ORACLE["dataset_param"] = ORACLE["mrr_monthly"]
ORACLE["month_series"] = """SELECT CAST(unnest(generate_series(
  (SELECT date_trunc('month', MIN(o_orderdate)) FROM orders), (SELECT date_trunc('month', MAX(o_orderdate)) FROM orders),
  INTERVAL 1 MONTH)) AS DATE) AS month_start"""

ORACLE["unnest_literal_dates"] = with_ctes(
    SUBS,
    body="""SELECT stripe_subscription_id, CAST(m AS DATE) AS month_start FROM (
  SELECT stripe_subscription_id,
         unnest([date_trunc('month', CAST(canceled_at AS DATE)) - INTERVAL 1 MONTH,
                 date_trunc('month', CAST(canceled_at AS DATE))]) AS m
  FROM subs
  WHERE status = 'canceled' AND canceled_at IS NOT NULL)""",
)

_SUB_TYPES = {
    "unit_amount_cents": "bigint", "interval_count": "bigint", "livemode": "boolean",
    **{c: "timestamp" for c in ["billing_cycle_anchor", "current_period_start", "current_period_end", "start_date",
                                "canceled_at", "ended_at", "created_at", "synced_at"]},
}
_SUB_COLUMNS = [
    "stripe_subscription_id", "stripe_customer_id", "status", "current_price_id", "unit_amount_cents", "currency",
    "interval", "interval_count", "billing_cycle_anchor", "current_period_start", "current_period_end", "start_date",
    "canceled_at", "ended_at", "created_at", "livemode", "idempotency_key", "metadata", "synced_at",
]
_SUB_FILLED = {"interval": "bill_interval", "canceled_at": "canceled_at", "ended_at": "canceled_at"}
ORACLE["table_schema"] = with_ctes(SUBS, body=" UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, '{_SUB_TYPES.get(c, 'string')}' AS data_type, "
    f"COUNT({_SUB_FILLED.get(c, '*')}) AS non_null FROM subs"
    for i, c in enumerate(_SUB_COLUMNS)
))

ORACLE["ts_to_date"] = with_ctes(SUBS, body="SELECT stripe_subscription_id, CAST(start_date AS DATE) AS sub_start_date FROM subs")
ORACLE["nullable_ts_to_date"] = with_ctes(
    SUBS, body="SELECT stripe_subscription_id, CAST(canceled_at AS DATE) AS sub_canceled_date FROM subs")
ORACLE["lower_interval"] = with_ctes(SUBS, body="SELECT stripe_subscription_id, lower(bill_interval) AS interval_type FROM subs")
ORACLE["normalize_monthly"] = with_ctes(SUBS, body=f"SELECT stripe_subscription_id, {money(AMT)} AS monthly_amount FROM subs")
ORACLE["last_day"] = with_ctes(SUBS, body="SELECT stripe_subscription_id, last_day(CAST(start_date AS DATE)) AS month_end FROM subs")
ORACLE["coalesce_zero"] = with_ctes(
    SUBS, body=f"SELECT stripe_subscription_id, {money('COALESCE(' + AMT + ', 0)')} AS monthly_amount FROM subs")
ORACLE["cast_numeric"] = with_ctes(
    SUBS, body=f"SELECT stripe_subscription_id, CAST({AMT} AS DECIMAL(38,9)) AS monthly_numeric FROM subs")
ORACLE["round_cents"] = with_ctes(SUBS, body=f"SELECT stripe_subscription_id, ROUND({AMT}, 2) AS monthly_rounded FROM subs")
ORACLE["date_add_day"] = with_ctes(
    SUBS, body="SELECT stripe_subscription_id, CAST(canceled_at AS DATE) + 1 AS day_after_cancel FROM subs")
ORACLE["month_floor"] = with_ctes(
    SUBS, body="SELECT stripe_subscription_id, CAST(date_trunc('month', CAST(start_date AS DATE)) AS DATE) AS start_month FROM subs")
ORACLE["prev_month"] = with_ctes(
    SUBS,
    body="""SELECT stripe_subscription_id,
       CAST(date_trunc('month', CAST(canceled_at AS DATE)) - INTERVAL 1 MONTH AS DATE) AS month_before_cancel FROM subs""",
)
ORACLE["cast_int"] = with_ctes(SUBS, body="SELECT stripe_subscription_id, CAST(unit_amount_cents AS BIGINT) AS cents FROM subs")

PLANS = """
draws AS (
  SELECT c_custkey - 1 AS cust_idx,
         1 + CAST(('0x' || substr(md5('42:status:' || (c_custkey - 1)), 1, 8)) AS BIGINT) % 100 AS d_status,
         CAST(('0x' || substr(md5('42:start_month:' || (c_custkey - 1)), 1, 8)) AS BIGINT) % 5 AS start_month,
         CAST(('0x' || substr(md5('42:tier:' || (c_custkey - 1)), 1, 8)) AS BIGINT) % 3 AS tier_pos,
         CAST(('0x' || substr(md5('42:tier_change_roll:' || (c_custkey - 1)), 1, 8)) AS BIGINT) / 4294967296.0 AS roll,
         1 + CAST(('0x' || substr(md5('42:tier_change_delta:' || (c_custkey - 1)), 1, 8)) AS BIGINT) % 2 AS delta,
         1 + CAST(('0x' || substr(md5('42:new_tier:' || (c_custkey - 1)), 1, 8)) AS BIGINT) % 2 AS new_pos,
         3 + CAST(('0x' || substr(md5('42:cancel_month:' || (c_custkey - 1)), 1, 8)) AS BIGINT) % 2 AS cancel_draw
  FROM customer
),
p1 AS (
  SELECT *,
         CASE WHEN d_status <= 70 THEN 'active' WHEN d_status <= 90 THEN 'canceled' ELSE 'past_due' END AS status,
         ['basic', 'pro', 'enterprise'][tier_pos + 1] AS initial_tier,
         start_month + delta AS change_m
  FROM draws
),
p2 AS (
  SELECT *,
         (status <> 'past_due' AND roll < 0.3 AND change_m <= 4) AS has_change,
         list_filter(['basic', 'pro', 'enterprise'], lambda t: t <> initial_tier)[new_pos] AS pick
  FROM p1
),
plans AS (
  SELECT cust_idx, status, start_month, initial_tier,
         CASE WHEN has_change THEN change_m END AS tier_change_month,
         CASE WHEN has_change THEN pick END AS new_tier,
         CASE WHEN status = 'canceled' THEN
              CASE WHEN has_change AND cancel_draw <= change_m THEN least(change_m + 1, 5) ELSE cancel_draw END
         END AS cancel_month
  FROM p2
)"""

CUSTOMERS = "custs AS (SELECT c_custkey - 1 AS cust_idx FROM customer)"
ORACLE["format_id"] = with_ctes(
    CUSTOMERS,
    body="""SELECT cust_idx, printf('mrr-seed-%03d@example.com', cust_idx + 1) AS email,
       printf('Test Customer %03d', cust_idx + 1) AS name,
       'seed-sub-cus_seed_' || cust_idx || '-v0' AS idempotency_key FROM custs""",
)
ORACLE["batch_index"] = with_ctes(
    CUSTOMERS, body="SELECT cust_idx, CAST(floor(cust_idx / 3) AS BIGINT) AS batch, (COUNT(*) OVER () + 2) // 3 AS batches FROM custs")

ORACLE["ever_activated"] = with_ctes(
    SUBS, body="SELECT stripe_subscription_id, status FROM subs WHERE status NOT IN ('incomplete', 'incomplete_expired')")
ORACLE["start_boundary"] = with_ctes(
    SUBS, MONTHS, ACTIVE,
    body="""SELECT m.month_start, COUNT(a.sd) AS started
FROM months m LEFT JOIN active a ON a.sd <= last_day(m.month_start) GROUP BY m.month_start""",
)
ORACLE["cancel_boundary"] = with_ctes(
    SUBS, MONTHS, ACTIVE,
    body="""SELECT m.month_start, COUNT(a.cd) AS canceled
FROM months m LEFT JOIN active a ON a.cd <= last_day(m.month_start) GROUP BY m.month_start""",
)
ORACLE["supported_interval"] = with_ctes(
    SUBS, body=f"SELECT stripe_subscription_id, lower(bill_interval) AS interval_type FROM subs WHERE {AMT} IS NOT NULL")

CANCELED_RANGE = f"""
cr AS (
  SELECT stripe_subscription_id, CAST(canceled_at AS DATE) AS cancel_date FROM subs
  WHERE status = 'canceled' AND canceled_at IS NOT NULL
    AND CAST(canceled_at AS DATE) >= DATE '1994-11-01' AND CAST(canceled_at AS DATE) < DATE '{WINDOW_END}'
)"""
ORACLE["canceled_in_range"] = with_ctes(SUBS, CANCELED_RANGE, body="SELECT * FROM cr")
ORACLE["exclude_ids"] = with_ctes(
    SUBS, TIER_PAIRS,
    body="""SELECT stripe_subscription_id FROM subs
WHERE stripe_subscription_id NOT IN (SELECT v0_sub_id FROM tc UNION SELECT v1_sub_id FROM tc)""",
)
ORACLE["name_pattern"] = """
SELECT 'customer' AS kind, email AS name FROM (
  SELECT CASE WHEN c_custkey % 5 = 0 THEN printf('mrr-seed-%03d@example.com', c_custkey)
              WHEN c_custkey % 7 = 0 THEN 'smoke-test-' || lower(c_name) || '@example.com'
              ELSE lower(c_name) || '@example.com' END AS email FROM customer
) WHERE email LIKE '%mrr-seed-%' OR email LIKE '%smoke-test-%'
UNION ALL
SELECT 'clock', clock FROM (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN 'mrr-seed-clock-' || c_custkey
              WHEN c_custkey % 13 = 0 THEN 'mrr-smoke-clock-' || c_custkey
              WHEN c_custkey = 17 THEN 'mrr-seed-smoke-clock'
              ELSE 'old-mrr-seed-clock-' || c_custkey END AS clock FROM customer
) WHERE clock LIKE 'mrr-seed-clock-%' OR clock LIKE 'mrr-smoke-clock-%' OR clock = 'mrr-seed-smoke-clock'"""
ORACLE["metadata_predicate"] = """SELECT event_id, user_id FROM events
WHERE json_extract_string(props, '$.k') = '7' AND event_type = 'purchase'"""

TIER_PRICES = """
tp AS (
  SELECT ['basic', 'pro', 'enterprise'][p_partkey % 3 + 1] AS tier,
         arg_min('price_' || p_partkey, p_partkey) AS price_id,
         arg_min(CAST(round(p_retailprice * 100) AS BIGINT), p_partkey) AS unit_amount,
         COUNT(*) AS candidates
  FROM part
  WHERE p_partkey % 7 = 0 AND p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 6 <> 0 AND p_partkey % 11 <> 0
  GROUP BY 1
)"""
ORACLE["price_catalog_filter"] = with_ctes(TIER_PRICES, body="SELECT tier, price_id, unit_amount, candidates FROM tp")
ORACLE["price_resolution_count"] = with_ctes(
    TIER_PRICES, body="SELECT COUNT(tier) AS tiers_resolved, COUNT(DISTINCT price_id) AS distinct_prices FROM tp")

ORACLE["sensitive_token_scan"] = """SELECT doc_id, array_to_string(m, ',') AS markers FROM (
  SELECT doc_id, list_filter([
    CASE WHEN contains(text, 'sk_test_') THEN 'sk_test_' END,
    CASE WHEN contains(text, 'sk_live_') THEN 'sk_live_' END,
    CASE WHEN contains(text, 'GOOGLE_APPLICATION_CREDENTIALS') THEN 'GOOGLE_APPLICATION_CREDENTIALS' END,
    CASE WHEN contains(text, 'service_account') THEN 'service_account' END,
    CASE WHEN contains(text, 'client_secret') THEN 'client_secret' END], lambda x: x IS NOT NULL) AS m
  FROM documents
) WHERE len(m) > 0"""

ORACLE["new_customers_only"] = """SELECT 'cus_' || c_custkey AS stripe_customer_id, lower(c_name) || '@example.com' AS email
FROM customer
WHERE lower(c_name) || '@example.com' NOT IN (
  SELECT lower(c_name) || '@example.com' FROM customer WHERE CAST(floor(c_custkey / 3) AS BIGINT) % 2 = 0)"""

TIERS = """
tiers AS (
  SELECT stripe_subscription_id, ['basic', 'pro', 'enterprise'][CAST(substr(current_price_id, 7) AS INTEGER) + 1] AS tier
  FROM subs
)"""
ORACLE["tier_price_lookup"] = with_ctes(
    SUBS, TIERS,
    body="""SELECT t.tier, t.stripe_subscription_id, d.amount_cents FROM tiers t
LEFT JOIN (VALUES ('basic', 5000), ('pro', 10000), ('enterprise', 25000)) AS d(tier, amount_cents) ON d.tier = t.tier""",
)

ORACLE["status_count_and_sum"] = with_ctes(
    SUBS, body="SELECT status, COUNT(*) AS cnt, COALESCE(SUM(unit_amount_cents), 0) AS total_cents FROM subs GROUP BY status")
ORACLE["distinct_customers"] = with_ctes(SUBS, body="SELECT COUNT(DISTINCT stripe_customer_id) AS customers FROM subs")
ORACLE["multi_sub_customers"] = with_ctes(
    SUBS,
    body="SELECT COUNT(*) AS customers FROM (SELECT stripe_customer_id FROM subs GROUP BY 1 HAVING COUNT(*) >= 2)",
)
ORACLE["customer_sub_count"] = with_ctes(
    SUBS, body="SELECT stripe_customer_id, COUNT(*) AS subscriptions FROM subs GROUP BY stripe_customer_id")
ORACLE["table_row_counts"] = """SELECT 'customers' AS table_name, COUNT(*) AS rows FROM customer
UNION ALL SELECT 'subscriptions', COUNT(*) FROM orders
UNION ALL SELECT 'invoices', COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

ORACLE["status_distribution"] = with_ctes(
    SUBS,
    body="""SELECT status, n AS subscriptions, pct,
       CASE status WHEN 'active' THEN pct BETWEEN 65 AND 75 WHEN 'canceled' THEN pct BETWEEN 15 AND 25
                   WHEN 'past_due' THEN pct BETWEEN 8 AND 12 END AS in_band
FROM (SELECT status, COUNT(*) AS n, COUNT(*) * 100 // SUM(COUNT(*)) OVER () AS pct FROM subs GROUP BY status)""",
)
ORACLE["distinct_start_months"] = with_ctes(
    SUBS, body="SELECT COUNT(DISTINCT date_trunc('month', start_date)) AS start_months FROM subs")
ORACLE["tier_change_rate"] = with_ctes(
    SUBS, TIER_PAIRS,
    body="""SELECT eligible, changed, changed >= eligible * 0.2 AND changed <= eligible * 0.35 AS in_band FROM (
  SELECT COUNT(*) AS eligible, COUNT(*) FILTER (stripe_subscription_id IN (SELECT v0_sub_id FROM tc)) AS changed
  FROM subs WHERE status <> 'past_due')""",
)

ORACLE["order_by_month"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS,
    body=f"""SELECT month, mrr_amount, row_number() OVER (ORDER BY month) AS ordinal FROM (
  SELECT month_start AS month, {money('SUM(amt)')} AS mrr_amount FROM pairs WHERE amt IS NOT NULL GROUP BY month_start)""",
)
ORACLE["first_by_key"] = with_ctes(
    SUBS, CANCELED_RANGE, body="SELECT stripe_subscription_id FROM cr ORDER BY stripe_subscription_id LIMIT 1")
ORACLE["limit_one"] = with_ctes(
    SUBS,
    body="""SELECT stripe_customer_id, COUNT(*) AS subscriptions FROM subs GROUP BY 1 HAVING COUNT(*) >= 2
ORDER BY stripe_customer_id LIMIT 1""",
)
ORACLE["row_limit"] = with_ctes(
    SUBS, body="SELECT stripe_subscription_id FROM subs ORDER BY stripe_subscription_id LIMIT 1000")
ORACLE["monotone_months"] = with_ctes(
    MONTHS,
    body="""SELECT COUNT(*) AS points, MIN(month_start) AS first_month, MAX(month_start) AS last_month,
       true AS contiguous FROM months""",
)
ORACLE["other_tiers"] = with_ctes(
    SUBS, TIERS,
    body="""SELECT stripe_subscription_id, array_to_string(list_filter(['basic', 'pro', 'enterprise'], lambda t: t <> tier), ',')
       AS other_tiers FROM tiers""",
)

ORACLE["lifecycle_plan"] = with_ctes(
    PLANS, body="SELECT cust_idx, status, start_month, initial_tier, tier_change_month, new_tier, cancel_month FROM plans")

GEN_SUBS = """
gen AS (
  SELECT 'sub_seed_' || cust_idx || '_v0' AS stripe_subscription_id, 'cus_seed_' || cust_idx AS stripe_customer_id,
         status AS plan_status, initial_tier AS tier,
         TIMESTAMP '2025-11-03 00:00:00' + to_days(CAST(30 * start_month AS INTEGER)) AS start_date,
         CASE WHEN tier_change_month IS NOT NULL
                THEN TIMESTAMP '2025-11-03 00:00:00' + to_days(CAST(30 * tier_change_month AS INTEGER))
              WHEN cancel_month IS NOT NULL AND cancel_month >= start_month
                THEN TIMESTAMP '2025-11-03 00:00:00' + to_days(CAST(30 * cancel_month AS INTEGER)) END AS canceled_at
  FROM plans
  UNION ALL
  SELECT 'sub_seed_' || cust_idx || '_v1', 'cus_seed_' || cust_idx, status, new_tier,
         TIMESTAMP '2025-11-03 00:00:00' + to_days(CAST(30 * tier_change_month AS INTEGER)),
         CASE WHEN cancel_month IS NOT NULL AND cancel_month >= start_month
                THEN TIMESTAMP '2025-11-03 00:00:00' + to_days(CAST(30 * cancel_month AS INTEGER)) END
  FROM plans WHERE tier_change_month IS NOT NULL
),
gsubs AS (
  SELECT stripe_subscription_id, stripe_customer_id,
         CASE WHEN canceled_at IS NOT NULL THEN 'canceled' WHEN plan_status = 'past_due' THEN 'past_due' ELSE 'active' END AS status,
         CAST(CASE tier WHEN 'basic' THEN 5000 WHEN 'pro' THEN 10000 ELSE 25000 END AS BIGINT) AS unit_amount_cents,
         start_date, canceled_at
  FROM gen
)"""
ORACLE["lifecycle_to_subscriptions"] = with_ctes(PLANS, GEN_SUBS, body="SELECT * FROM gsubs")
ORACLE["lifecycle_mrr"] = with_ctes(
    PLANS, GEN_SUBS,
    body=f"""SELECT m.month_start AS month,
       {money('COALESCE(SUM(CASE WHEN g.stripe_subscription_id IS NOT NULL THEN g.unit_amount_cents / 100.0 END), 0)')} AS mrr_amount
FROM (SELECT CAST(unnest(generate_series(DATE '2025-11-01', DATE '2026-05-01', INTERVAL 1 MONTH)) AS DATE) AS month_start) m
LEFT JOIN gsubs g
  ON CAST(g.start_date AS DATE) <= last_day(m.month_start)
 AND (g.canceled_at IS NULL OR CAST(g.canceled_at AS DATE) > last_day(m.month_start))
GROUP BY m.month_start""",
)
ORACLE["check_plan_invariants"] = with_ctes(
    PLANS,
    body="""SELECT
  COUNT(*) FILTER (WHERE tier_change_month IS NOT NULL AND tier_change_month <= start_month) AS change_not_after_start,
  COUNT(*) FILTER (WHERE tier_change_month IS NOT NULL AND cancel_month IS NOT NULL AND cancel_month <= tier_change_month)
    AS cancel_not_after_change,
  COUNT(*) FILTER (WHERE tier_change_month IS NOT NULL AND new_tier = initial_tier) AS same_tier_change,
  COUNT(*) FILTER (WHERE status = 'past_due' AND tier_change_month IS NOT NULL) AS past_due_changed,
  COUNT(*) FILTER (WHERE start_month < 0 OR start_month > 4) AS start_out_of_range,
  COUNT(*) FILTER (WHERE status <> 'past_due') AS eligible,
  COUNT(*) FILTER (WHERE status <> 'past_due' AND tier_change_month IS NOT NULL) AS changed
FROM plans""",
)

FILLED = """
filled AS (
  SELECT m.month_start AS month, CAST(ROUND(COALESCE(SUM(p.amt), 0), 2) AS DECIMAL(18,2)) AS mrr_amount
  FROM months m LEFT JOIN pairs p ON p.month_start = m.month_start AND p.amt IS NOT NULL
  GROUP BY m.month_start
)"""
ORACLE["json_series_write"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, FILLED,
    body="""SELECT COUNT(*) AS points, strftime(MIN(month), '%Y-%m-%d') AS first_month,
       strftime(MAX(month), '%Y-%m-%d') AS last_month, CAST(SUM(mrr_amount) AS DECIMAL(18,2)) AS total_amount FROM filled""",
)
ORACLE["json_series_read"] = with_ctes(SUBS, MONTHS, ACTIVE, PAIRS, FILLED, body="SELECT month, mrr_amount FROM filled")
ORACLE["month_label"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, FILLED, body="SELECT month, strftime(month, '%b %Y') AS month_label FROM filled")
ORACLE["currency_label"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, FILLED,
    body="""SELECT month, '$' || format('{:,.2f}', CAST(mrr_amount AS DOUBLE)) AS amount_label,
       '$' || format('{:,.0f}', CAST(mrr_amount AS DOUBLE)) AS axis_label FROM filled""",
)
ORACLE["iso_month"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, FILLED, body="SELECT strftime(month, '%Y-%m-%d') AS month_iso, month FROM filled")
ORACLE["series_min_max"] = with_ctes(
    SUBS, MONTHS, ACTIVE, PAIRS, FILLED,
    body="""SELECT MIN(mrr_amount) AS min_amount, MAX(mrr_amount) AS max_amount,
       arg_min(mrr_amount, month) AS first_amount, arg_max(mrr_amount, month) AS last_amount,
       MIN(month) AS first_month, MAX(month) AS last_month FROM filled""",
)

ORACLE["ensure_database"] = with_ctes(
    RCUST, body="SELECT true AS database_exists, COUNT(*) AS customers FROM lcust WHERE r <> 5")
ORACLE["ensure_tables"] = with_ctes(
    SUBS, RSUBS, RCUST, RINV, ENTITY_COUNTS,
    body="""SELECT entity AS table_name, accepted AS rows FROM ecounts
UNION ALL SELECT '_sync_watermarks', 3""",
)
ORACLE["truncate_table"] = with_ctes(
    RCUST, body="SELECT 'customers' AS table_name, COUNT(*) AS rows_before, 0 AS rows_after FROM lcust WHERE r <> 5")
ORACLE["watermark_write"] = with_ctes(
    SUBS, RSUBS, RCUST, RINV,
    body="""SELECT 'customers' AS sync_key, MAX(created_ts) AS last_synced_at FROM lcust WHERE r <> 5
UNION ALL
SELECT 'subscriptions', MAX(created_at) FROM lsubs
WHERE r <> 5 AND raw_status IN ('active', 'past_due', 'canceled', 'trialing', 'incomplete')
UNION ALL
SELECT 'invoices', MAX(created_at) FROM linv WHERE r <> 5""",
)
ORACLE["watermark_reset"] = f"""SELECT sync_key, last_synced_at AS before_reset, CAST(NULL AS TIMESTAMP) AS after_reset
FROM ({ORACLE["watermark_write"]}) AS written"""
ORACLE["pct_floor"] = with_ctes(
    SUBS,
    body="""SELECT CAST(substr(stripe_customer_id, 5) AS BIGINT) // 3 AS batch,
       COUNT(*) FILTER (WHERE status = 'canceled') * 100 // COUNT(*) AS pct_canceled
FROM subs GROUP BY 1""",
)


def _bigint(name: str, cols: list[str]) -> None:
    """Report integer results of ``name`` as BIGINT (DuckDB sums give HUGEINT, literals INTEGER)."""
    casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)
    ORACLE[name] = f"SELECT * REPLACE ({casts}) FROM ({ORACLE[name]}) AS q"


for _name, _cols in {
    "dry_run": ["fetched", "inserted", "updated", "rejected"],
    "scope_union": ["listings"],
    "skip_malformed": ["rows"],
    "status_count_and_sum": ["total_cents"],
    "status_distribution": ["pct"],
    "sync_summary": ["fetched", "inserted", "updated", "rejected", "errors"],
    "tier_price_lookup": ["amount_cents"],
    "truncate_table": ["rows_after"],
    "watermark_read": ["rows_synced"],
}.items():
    _bigint(_name, _cols)

ORACLE["lifecycle_tier_change"] = "WITH " + ",".join([PLANS, GEN_SUBS]) + """
, gmonths AS (
  SELECT CAST(unnest(generate_series(DATE '2025-11-01', DATE '2026-05-01', INTERVAL 1 MONTH)) AS DATE) AS month_start
),
gpairs AS (
  SELECT m.month_start, g.stripe_subscription_id, g.unit_amount_cents / 100.0 AS amt
  FROM gmonths m JOIN gsubs g
    ON CAST(g.start_date AS DATE) <= last_day(m.month_start)
   AND (g.canceled_at IS NULL OR CAST(g.canceled_at AS DATE) > last_day(m.month_start))
),
gstrict AS (SELECT month_start, SUM(amt) AS mrr FROM gpairs GROUP BY month_start),
gtc AS (
  SELECT v0.stripe_subscription_id AS v0_sub_id, v1.stripe_subscription_id AS v1_sub_id,
         CAST(date_trunc('month', CAST(v0.canceled_at AS DATE)) AS DATE) AS month,
         v0.unit_amount_cents / 100.0 AS c0, v1.unit_amount_cents / 100.0 AS c1
  FROM gsubs v0 JOIN gsubs v1
    ON v0.stripe_customer_id = v1.stripe_customer_id
   AND v0.stripe_subscription_id <> v1.stripe_subscription_id
   AND v0.canceled_at IS NOT NULL
   AND CAST(v1.start_date AS DATE) >= CAST(v0.canceled_at AS DATE)
   AND CAST(v1.start_date AS DATE) <= CAST(v0.canceled_at AS DATE) + 1
  WHERE CAST(v0.canceled_at AS DATE) >= DATE '2025-11-01' AND CAST(v0.canceled_at AS DATE) <= DATE '2026-05-01'
)
SELECT x.v0_sub_id, x.v1_sub_id, x.month,
       COALESCE(ROUND(s.mrr, 2) = ROUND(x.excl + x.c1, 2), false) AS v1_only_ok,
       COALESCE(ROUND(s.mrr, 2) <> ROUND(x.excl + x.c0 + x.c1, 2), false) AS no_double_count
FROM (
  SELECT t.v0_sub_id, t.v1_sub_id, t.month, t.c0, t.c1, COALESCE(SUM(p.amt), 0) AS excl
  FROM gtc t
  LEFT JOIN gpairs p ON p.month_start = t.month AND p.stripe_subscription_id NOT IN (t.v0_sub_id, t.v1_sub_id)
  GROUP BY t.v0_sub_id, t.v1_sub_id, t.month, t.c0, t.c1
) x
LEFT JOIN gstrict s ON s.month_start = x.month"""

# ---------------------------------------------------------------------------------------
# Change feed, differences, irregular calendars, filtered anti joins, marker tables
# ---------------------------------------------------------------------------------------

ORACLE["upsert_changes"] = with_ctes(
    SUBS, LOADS,
    body="""SELECT stripe_subscription_id, CASE WHEN n % 3 = 1 THEN 'updated' ELSE 'inserted' END AS op,
       CASE WHEN n % 3 = 1 THEN unit_amount_cents END AS cents_before, unit_amount_cents + 100 AS cents_after
FROM loads WHERE n % 3 <> 0""",
)

ORACLE["mrr_from_changes"] = with_ctes(
    SUBS.replace("subs AS (", "base AS ("),
    """
subs AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(stripe_subscription_id, 5) AS BIGINT) % 3 <> 0 THEN unit_amount_cents + 100
                         ELSE unit_amount_cents END AS unit_amount_cents) FROM base
)""",
    MONTHS, ACTIVE, PAIRS,
    body=f"""
SELECT month_start AS month, {money('SUM(amt)')} AS mrr_amount
FROM pairs WHERE amt IS NOT NULL
GROUP BY month_start""",
)

ORACLE["mrr_by_period"] = with_ctes(
    SUBS, ACTIVE,
    """
periods AS (
  SELECT o_custkey AS period_id, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY o_custkey
)""",
    body=f"""
SELECT period_id, COUNT(s.stripe_subscription_id) AS active, {money('COALESCE(SUM(COALESCE(s.amt, 0)), 0)')} AS mrr_amount
FROM periods LEFT JOIN active s ON s.sd <= last_day AND (s.cd IS NULL OR s.cd > last_day)
GROUP BY period_id""",
)

ORACLE["resync_difference"] = with_ctes(
    SUBS, LOADS,
    body="""SELECT stripe_subscription_id, unit_amount_cents AS cents_before, unit_amount_cents + 1 AS cents_after
FROM loads WHERE n % 500 = 7""",
)

ORACLE["subscriptions_without_paid_invoice"] = with_ctes(
    SUBS,
    body="""SELECT stripe_subscription_id, status FROM subs
WHERE stripe_subscription_id NOT IN (
  SELECT 'sub_' || l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber <> 1)""",
)

ORACLE["marker_table_scan"] = """
WITH listed AS (
  SELECT c_name AS marker FROM customer UNION SELECT substr(text, 50, 12) FROM documents
), found AS (
  SELECT doc_id, marker FROM documents JOIN listed ON marker <> '' AND contains(text, marker)
)
SELECT doc_id, array_to_string(list(marker ORDER BY encode(marker)), chr(10)) AS markers FROM found GROUP BY doc_id"""
