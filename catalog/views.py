"""SQL for the site tables, written by hand and apart from the library."""

LEADS = """leads AS (
  SELECT o_orderkey AS id, o_custkey AS form_id,
    CASE WHEN o_orderkey % 20 = 0 THEN 'spam' ELSE 'active' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fulfilled,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'gateway' ELSE 'other' END AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN 'Active' ELSE 'Paid' END
      WHEN 'O' THEN 'Processing' ELSE CASE WHEN o_orderpriority = '1-URGENT' THEN 'Cancelled' ELSE 'Failed' END END
      AS payment_status,
    CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 1 END AS transaction_type,
    'T' || o_orderkey AS transaction_id,
    CASE WHEN o_orderkey % 3 = 0 THEN 'IRT' ELSE 'IRR' END AS currency,
    CAST(o_totalprice AS DECIMAL(19,2)) AS payment_amount, o_orderdate AS payment_date
  FROM orders)"""

PAID = """paid AS (SELECT * FROM leads WHERE status = 'active' AND is_fulfilled = 1)"""

HOURLY = """leads AS (
  SELECT event_id AS id, user_id AS form_id, 'active' AS status,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS is_fulfilled,
    CASE WHEN event_id % 3 = 0 THEN 'other' ELSE 'gateway' END AS payment_method,
    CAST(value AS DECIMAL(19,2)) AS payment_amount, ts AS payment_date
  FROM events)"""

ENTRIES = """entries AS (
  SELECT leads.* EXCLUDE (payment_date, transaction_id),
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS payment_date,
    CASE WHEN o_orderstatus <> 'O' THEN 'T' || o_orderkey END AS transaction_id,
    o_orderdate AS date_created,
    o_orderpriority AS input_1, CAST(CAST(o_totalprice AS DECIMAL(19,2)) AS VARCHAR) AS input_2,
    o_orderstatus AS input_3,
    CASE WHEN o_orderstatus = 'O' THEN 'user' || o_custkey || '@example.com' ELSE '' END AS input_5_3,
    CASE o_orderpriority WHEN '1-URGENT' THEN '+98 ' WHEN '2-HIGH' THEN '0098-' WHEN '3-MEDIUM' THEN '0'
      WHEN '4-NOT SPECIFIED' THEN '%2B98' ELSE '' END || lpad(CAST(o_custkey AS VARCHAR), 10, '9') AS input_6,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'gift' WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN '0'
      WHEN '4-NOT SPECIFIED' THEN 'repeat order' ELSE 'late' END AS input_7,
    o_orderstatus = 'P' AS hides_3, o_orderpriority = '3-MEDIUM' AS is_delayed,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS post_id
  FROM leads JOIN orders ON id = o_orderkey)"""

META = """lead_meta AS (
  SELECT o_orderkey AS lead_id, 'payment_gateway' AS meta_key, 'Gateway' AS meta_value FROM orders
  UNION ALL SELECT o_orderkey, 'feed_id', CAST(o_custkey * 2 + 1 AS VARCHAR) FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION ALL SELECT o_orderkey, 'payment_type', CASE o_orderpriority WHEN '1-URGENT' THEN 'custom' ELSE 'form' END
    FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
  UNION ALL SELECT o_orderkey, 'part_price', CAST(CAST(o_totalprice AS DECIMAL(19,2)) AS VARCHAR)
    FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'crm_is_fulfilled', CASE o_orderstatus WHEN 'F' THEN '1' ELSE '0' END
    FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, 'user_registration_is_fulfilled', '1' FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey, 'processed_feeds', '{"crm":"1","mail":"1"}' FROM orders WHERE o_orderpriority = '2-HIGH')"""

# Attributes of custom payments, named after forms.
CUSTOM_META = """custom_meta AS (
  SELECT o_orderkey AS lead_id, 'part_price_' || o_custkey AS meta_key, CAST(CAST(o_totalprice AS DECIMAL(19,2)) AS VARCHAR) AS meta_value
    FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'part_desc_' || o_custkey, 'Custom ' || o_orderkey
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, 'part_name_' || o_custkey, 'payer ' || o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'part_email_' || o_custkey, 'payer' || o_custkey || '@example.com'
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 'part_mobile_' || o_custkey, '0098 ' || lpad(CAST(o_custkey AS VARCHAR), 10, '9')
    FROM orders WHERE o_orderpriority = '1-URGENT')"""

# The new entries of custom payments, each with the order it comes from.
CUSTOM = """asked AS (
  SELECT o_orderkey AS from_id, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS id
  FROM orders WHERE o_orderpriority = '1-URGENT')"""

FEEDS = """feeds AS (
  SELECT c_custkey * 2 + 1 AS id, c_custkey AS form_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 1 ELSE 0 END AS is_active,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'subscription' ELSE 'product' END AS type,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'true' ELSE '' END AS addon,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN CASE WHEN c_acctbal > 5000 THEN 'sadt' ELSE 'raygan' END END AS floor_policy,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'publish' WHEN 'BUILDING' THEN 'draft' WHEN 'FURNITURE' THEN 'private'
      WHEN 'MACHINERY' THEN 'other' ELSE '' END AS update_post_action1,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'dont' WHEN 'BUILDING' THEN 'publish' WHEN 'FURNITURE' THEN 'other'
      WHEN 'MACHINERY' THEN 'draft' ELSE '' END AS update_post_action2,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN '1' ELSE '' END AS rule_enabled,
    CASE WHEN c_nationkey = 23 THEN '' WHEN c_nationkey % 7 IN (2, 3) THEN '2' WHEN c_nationkey % 7 = 6 THEN '3' ELSE '1' END AS rule_field,
    CASE c_nationkey % 7 WHEN 0 THEN 'is' WHEN 1 THEN 'isnot' WHEN 2 THEN '>' WHEN 3 THEN '<' WHEN 4 THEN 'contains'
      WHEN 5 THEN 'starts_with' ELSE 'ends_with' END AS rule_operator,
    CASE c_nationkey % 7 WHEN 0 THEN ' 1-urgent ' WHEN 1 THEN '5-LOW' WHEN 2 THEN '250000' WHEN 3 THEN '100000.5'
      WHEN 4 THEN 'MED' WHEN 5 THEN '4-' ELSE 'f' END AS rule_value,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'Entry {entry_id} of {form_title} ({form_id})' ELSE '' END AS desc_pm,
    CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE '6' END AS mobile_field,
    ['c2', 'c3'] AS conf_1, ['c3'] AS conf_2, CAST([] AS VARCHAR[]) AS conf_3,
    ['n1'] AS notif_1, ['n1', 'n3'] AS notif_2,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ['n2'] WHEN 'BUILDING' THEN ['n2'] WHEN 'HOUSEHOLD' THEN ['n2', 'n9']
      WHEN 'MACHINERY' THEN ['n1'] ELSE CAST([] AS VARCHAR[]) END AS notif_3, ['n3'] AS notif_4
  FROM customer WHERE c_nationkey <> 24
  UNION ALL
  SELECT c_custkey * 2 + 2, c_custkey, 1, 'product', '', 'sadt', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    ['c2'], NULL, NULL, NULL, NULL, NULL, NULL
  FROM customer WHERE c_nationkey <> 24 AND c_acctbal < 3000)"""

FORMS = """forms AS (
  SELECT c_custkey AS id, c_name AS title,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'publish' WHEN 'FURNITURE' THEN 'pending' WHEN 'HOUSEHOLD' THEN 'private'
      ELSE 'draft' END AS post_status
  FROM customer)"""

# The first active feed of a form, and whether its rule holds for the entry.
ACTIVE = """first_feed AS (
  SELECT * FROM feeds WHERE is_active = 1 QUALIFY row_number() OVER (PARTITION BY form_id ORDER BY id) = 1),
tested AS (
  SELECT e.id AS entry_id, f.*, e.hides_3,
    lower(trim(CASE coalesce(CASE f.rule_field WHEN '1' THEN e.input_1 WHEN '2' THEN e.input_2 WHEN '3' THEN e.input_3 END, '')
      WHEN '0' THEN '' ELSE coalesce(CASE f.rule_field WHEN '1' THEN e.input_1 WHEN '2' THEN e.input_2 WHEN '3' THEN e.input_3 END, '') END)) AS have,
    lower(trim(f.rule_value)) AS want
  FROM entries e JOIN first_feed f USING (form_id)),
active AS (
  SELECT * FROM tested
  WHERE rule_enabled IS NULL OR rule_enabled IN ('', '0') OR rule_field IS NULL OR rule_field IN ('', '0')
    OR (NOT (hides_3 AND rule_field = '3') AND coalesce(CASE rule_operator
      WHEN 'is' THEN have = want WHEN 'isnot' THEN have <> want
      WHEN '>' THEN TRY_CAST(have AS DOUBLE) > TRY_CAST(want AS DOUBLE)
      WHEN '<' THEN TRY_CAST(have AS DOUBLE) < TRY_CAST(want AS DOUBLE)
      WHEN 'contains' THEN contains(have, want) WHEN 'starts_with' THEN starts_with(have, want)
      WHEN 'ends_with' THEN ends_with(have, want) END, FALSE)))"""

ORDER_TOTALS = """order_totals AS (
  SELECT l_orderkey AS lead_id, CAST(greatest(sum(CAST(l_extendedprice AS DECIMAL(19,2)) * CAST(l_quantity AS INTEGER)), 0) AS DECIMAL(19,2)) AS total
  FROM lineitem GROUP BY l_orderkey)"""

CALLBACKS = """callbacks AS (
  SELECT l_partkey * 8 + l_linenumber AS event_id, l_shipdate AS ts, l_orderkey AS lead_id,
    CASE WHEN l_returnflag = 'R' THEN 'OK' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'ok' ELSE 'NOK' END AS status_arg,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'true' ELSE '' END AS no_arg,
    CASE WHEN l_returnflag = 'R' THEN 100 WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN
      CASE l_linenumber WHEN 1 THEN -1 WHEN 2 THEN -2 WHEN 3 THEN -11 WHEN 4 THEN -22 WHEN 5 THEN -33 WHEN 6 THEN 7 ELSE 101 END
    END AS result_code,
    CASE WHEN l_returnflag = 'R' THEN 'R' || l_partkey END AS ref_id
  FROM lineitem)"""

# Result codes and their messages.
MESSAGES = """messages(code, message) AS (VALUES
  (-1, 'اطلاعات ارسال شده ناقص است .'),
  (-2, 'آی پی یا مرچنت Gateway اشتباه است .'),
  (-3, 'با توجه به محدودیت های شاپرک امکان پرداخت با رقم درخواست شده میسر نمیباشد .'),
  (-4, 'سطح تایید پذیرنده پایین تر از سطح نقره ای میباشد .'),
  (-11, 'درخواست مورد نظر یافت نشد .'),
  (-21, 'هیچ نوع عملیات مالی برای این تراکنش یافت نشد .'),
  (-22, 'تراکنش نا موفق میباشد .'),
  (-33, 'رقم تراکنش با رقم وارد شده مطابقت ندارد .'),
  (-40, 'اجازه دسترسی به متد مورد نظر وجود ندارد .'),
  (-54, 'درخواست مورد نظر آرشیو شده است .'),
  (100, 'اتصال با Gateway به خوبی برقرار شد و همه چیز صحیح است .'),
  (101, 'تراکنش با موفقیت به پایان رسیده بود و تاییدیه آن نیز انجام شده بود .'))"""

# What settling needs, one row per open entry of the gateway with its first callback.
MATCHED = """first_callback AS (
  SELECT * FROM callbacks WHERE lead_id <> 0
  QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY ts, event_id) = 1),
matched AS (
  SELECT c.lead_id, c.ts, c.ref_id, c.result_code, e.form_id, e.payment_status, e.payment_method, e.currency, e.post_id,
    e.input_1, e.input_2, f.type, f.floor_policy, f.update_post_action1,
    f.conf_1, f.conf_2, f.conf_3, f.notif_2, f.notif_3, f.notif_4,
    coalesce(o.total, 0) AS order_total, e.input_1 = '1-URGENT' AS custom,
    CAST(e.input_2 AS DECIMAL(19,2)) AS price, c.no_arg = 'true' AS is_free,
    CASE WHEN c.no_arg = 'true' THEN 'completed' WHEN lower(c.status_arg) = 'ok' AND c.result_code = 100 THEN 'completed'
      WHEN lower(c.status_arg) = 'ok' THEN 'failed' ELSE 'cancelled' END AS outcome
  FROM first_callback c JOIN entries e ON e.id = c.lead_id AND e.payment_method = 'gateway' AND e.payment_date IS NULL
  LEFT JOIN feeds f ON f.id = e.form_id * 2 + 1 AND e.input_1 NOT IN ('1-URGENT', '5-LOW')
  LEFT JOIN order_totals o ON o.lead_id = c.lead_id
  WHERE e.input_1 = '1-URGENT' OR f.id IS NOT NULL),
settled AS (
  SELECT m.*, CAST(m.total_due AS DECIMAL(19,2)) AS total,
    CASE WHEN custom OR type <> 'subscription' THEN 1 ELSE 2 END AS new_transaction_type,
    CASE WHEN is_free THEN NULL WHEN outcome = 'completed' THEN CASE WHEN NOT custom AND type = 'subscription' THEN 'Active' ELSE 'Paid' END
      WHEN outcome = 'cancelled' THEN 'Cancelled' ELSE 'Failed' END AS new_status,
    CASE WHEN is_free THEN NULL WHEN outcome = 'completed' THEN CAST(total_due AS DECIMAL(19,2)) ELSE 0 END AS new_amount,
    CASE WHEN is_free THEN NULL WHEN outcome = 'completed' THEN 1 ELSE 0 END AS new_fulfilled,
    CASE WHEN NOT is_free THEN payment_method END AS new_method,
    CASE WHEN is_free THEN CAST(CAST('0x' || substr(md5(CAST(lead_id AS VARCHAR)), 1, 15) AS BIGINT) % 9000000000 + 1000000000 AS VARCHAR)
      WHEN ref_id IS NULL OR ref_id IN ('', '0') THEN '-' ELSE ref_id END AS new_transaction_id,
    CASE WHEN outcome = 'failed' THEN coalesce((SELECT message FROM messages WHERE code = result_code), ' ') ELSE '' END AS message
  FROM (SELECT *, CASE WHEN custom THEN price
      WHEN floor_policy IS NOT NULL AND order_total > 0 AND order_total < CASE currency WHEN 'IRR' THEN 1000 ELSE 100 END
        THEN CASE floor_policy WHEN 'sadt' THEN CASE currency WHEN 'IRR' THEN 1000 ELSE 100 END ELSE 0 END
      ELSE order_total END AS total_due FROM matched) m)"""

# A Jalali calendar by adding up year lengths from 1 Farvardin 1300.
JALALI = """jyears AS (
  SELECT jy, CASE WHEN jy % 33 IN (1, 5, 9, 13, 17, 22, 26, 30) THEN 366 ELSE 365 END AS len
  FROM (SELECT CAST(unnest(range(1300, 2001)) AS INTEGER) AS jy)),
jstarts AS (
  SELECT jy, len, DATE '1921-03-21' + CAST(coalesce(sum(len) OVER (ORDER BY jy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS y0
  FROM jyears),
jcal AS (
  SELECT y0 + i AS d, jy, len, y0, i AS yday,
    CAST(CASE WHEN i < 186 THEN i // 31 + 1 ELSE (i - 186) // 30 + 7 END AS INTEGER) AS jm,
    CAST(CASE WHEN i < 186 THEN i % 31 + 1 ELSE (i - 186) % 30 + 1 END AS INTEGER) AS jd
  FROM (SELECT jy, len, y0, CAST(unnest(range(0, len)) AS INTEGER) AS i FROM jstarts))"""

# Literal bounds for 15 July 2001 and 30 January 2024.
WINDOWS_2001 = """windows(w, lo, hi, divisor) AS (VALUES
  ('today', DATE '2001-07-15', DATE '2001-07-15', 24), ('yesterday', DATE '2001-07-14', DATE '2001-07-14', 24),
  ('last7days', DATE '2001-07-09', DATE '2001-07-15', 7), ('last30days', DATE '2001-06-16', DATE '2001-07-15', 30),
  ('thisweek', DATE '2001-07-14', DATE '2001-07-20', 7), ('thismonth', DATE '2001-06-22', DATE '2001-07-22', 31),
  ('lastmonth', DATE '2001-05-22', DATE '2001-06-21', 31), ('last2month', DATE '2001-05-22', DATE '2001-07-22', 62),
  ('last3month', DATE '2001-04-21', DATE '2001-07-22', 93), ('last6month', DATE '2001-01-20', DATE '2001-07-22', 184),
  ('last9month', DATE '2000-10-22', DATE '2001-07-22', 274), ('last12month', DATE '2000-07-22', DATE '2001-07-22', 366),
  ('spring', DATE '2001-03-21', DATE '2001-06-21', 93), ('summer', DATE '2001-06-22', DATE '2001-09-22', 93),
  ('fall', DATE '2001-09-23', DATE '2001-12-21', 90), ('winter', DATE '2001-12-22', DATE '2002-03-20', 89),
  ('thisyear', DATE '2001-03-21', DATE '2002-03-20', 365), ('selection', DATE '2000-11-05', DATE '2001-02-20', 108))"""


def sql(*parts: str) -> str:
    """The last part is the query, the others its tables."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]
