"""DuckDB SQL with the expected rows of every query, written directly on the test tables.

It shares nothing with the Spark code: the billing model is spelled out again in the common table expressions
below, money is computed with whole numbers, and windows and subqueries are used where Spark aggregates.
"""

from __future__ import annotations


def _uuid(text: str) -> str:
    return f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def _key(*ordered: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in ordered)


_LINE_GUID = _uuid("'transaction|' || line")
_ORDER = _key("zip", "city", "state", "dest", "rate_type", "up")

_BASE = f"""
WITH item(m, module, guid) AS (VALUES
  (0, 'Billing.Calculators.LetterShop.AdditionalPagesLineItemCalculator', '0a970d9c-fdf0-4a67-ae30-ecdf3c37e1e6'),
  (1, 'Billing.Calculators.LetterShop.DuplexLineItemCalculator', '3fa59b34-b073-47bb-b196-5541e7367e2a'),
  (2, 'Billing.Calculators.LetterShop.InsertsLineItemCalculator', '39362017-6b1e-4d75-90a2-75fd0e422756'),
  (3, 'Billing.Calculators.LetterShop.LetterShopLineItemCalculator', '7cd5755a-3827-4d05-ac9e-fe40322947e5'),
  (4, 'Billing.Calculators.Postage.AdditionalPostageInternationalLineItemCalculator',
      '5e9dcb63-78ae-415a-9100-5a6d0c0f6d77'),
  (5, 'Billing.Calculators.Postage.AdditionalPostageLineItemCalculator', 'f4a7f8fa-966e-4140-ae08-77d03e9434e4'),
  (6, 'Billing.Calculators.Postage.ForceMailPostageLineItemCalculator', '032c0ea6-de40-489e-9889-459e88fff1e8'),
  (7, 'Billing.Calculators.Postage.ForceMailSpecialHandlingPostageLineItemCalculator',
      '1ef4110f-47d7-4c54-bbed-d037eb6b3ddf'),
  (8, 'Billing.Calculators.Postage.InternationalPostageCanadaLineItemCalculator',
      '981259db-bc3e-462a-8819-1a793dca9ca5'),
  (9, 'Billing.Calculators.Postage.InternationalPostageLineItemCalculator', '981259db-bc3e-462a-8819-1a793dca9ca5'),
  (10, 'Billing.Calculators.Postage.PostageLineItemCalculator', '032c0ea6-de40-489e-9889-459e88fff1e8'),
  (11, 'Billing.Calculators.Archive.ScanLineItemCalculator', NULL),
  (12, 'Billing.Calculators.Service.ReturnsLineItemCalculator', NULL)),
type_ids(guid, type_id) AS (VALUES
  ('032c0ea6-de40-489e-9889-459e88fff1e8', 1), ('0a970d9c-fdf0-4a67-ae30-ecdf3c37e1e6', 2),
  ('1ef4110f-47d7-4c54-bbed-d037eb6b3ddf', 3), ('39362017-6b1e-4d75-90a2-75fd0e422756', 4),
  ('3fa59b34-b073-47bb-b196-5541e7367e2a', 5), ('5e9dcb63-78ae-415a-9100-5a6d0c0f6d77', 6),
  ('7cd5755a-3827-4d05-ac9e-fe40322947e5', 7), ('981259db-bc3e-462a-8819-1a793dca9ca5', 8)),
o AS (
  SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS st, o_orderdate AS od,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS pr,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         o_custkey * 10000 + year(o_orderdate) AS sk
  FROM orders),
place AS (
  SELECT s_suppkey, n_nationkey AS nk, n_name, n_regionkey AS rk,
         CASE WHEN n_nationkey % 10 = 0 THEN NULL WHEN n_nationkey % 10 = 5 THEN '' ELSE n_name END AS city,
         CASE WHEN n_nationkey % 10 = 0 THEN NULL WHEN n_nationkey % 10 = 5 THEN '' ELSE r_name END AS state,
         CASE WHEN n_nationkey % 10 = 0 THEN NULL WHEN n_nationkey % 10 = 5 THEN ''
              ELSE lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END AS zip
  FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
pc AS (
  SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))) AS pid,
         CASE WHEN l_linenumber = 2 AND l_orderkey % 11 = 0 THEN NULL
              WHEN l_linenumber = 2 AND l_orderkey % 11 = 1 THEN repeat('0', 32)
              WHEN l_linenumber = 2 AND l_orderkey % 11 = 2 THEN '' ELSE pid END AS piece,
         NOT (l_linenumber = 2 AND l_orderkey % 11 < 3) AS known,
         CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
              strftime(l_shipdate, '%Y-%m-%d'))), 1, 15) AS BIGINT) AS dk,
         o.*, p_size % 13 AS m, l_linenumber AS ln, CAST(l_quantity AS BIGINT) AS lq, l_discount AS disc,
         l_linestatus AS ls, l_returnflag AS lf,
         l_orderkey * 100 + p_size % 13 AS line,
         (l_orderkey * 100 + p_size % 13) * 10
           + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS cat,
         place.*
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN o ON ok = l_orderkey JOIN place ON s_suppkey = l_suppkey),
li AS (
  SELECT line, ok, any_value(m) AS m, any_value(sk) AS sk, any_value(ck) AS ck, any_value(cents) AS cents,
         any_value(st) AS st, any_value(pr) AS pr, 'group-' || any_value(m % 4) AS grp,
         CAST(CASE WHEN any_value(m) = 0 AND any_value(st) = 'O' THEN sum((lq + 1) // 2 - 1)
                   WHEN any_value(m) = 1 AND any_value(st) = 'O' THEN sum(lq - (lq + 1) // 2)
                   ELSE count(*) END AS BIGINT) AS qty
  FROM pc GROUP BY line, ok),
lx AS (
  SELECT li.*, CAST(li.m + 1 AS BIGINT) AS item_key, module, guid, 'TC' || (li.m % 5) AS tax_code,
         CASE WHEN li.m = 12 THEN 'Service' WHEN li.m >= 4 THEN 'Postage' ELSE 'Print' END AS tax_category,
         li.m % 4 <> 3 AS exportable, 'Vendor item ' || CASE WHEN ok % 3 = 0 THEN (li.m + 1) % 13 ELSE li.m END AS vendor
  FROM li JOIN item ON item.m = li.m),
act AS (
  SELECT DISTINCT line, cat, cat % 10 AS kind FROM pc
  UNION ALL SELECT DISTINCT line, -line, 3 FROM pc WHERE ok % 7 = 0
  UNION ALL SELECT line, cat, cat % 10
            FROM (SELECT min(line) AS line, max(cat) AS cat FROM pc WHERE ok % 5 = 0 GROUP BY ok) WHERE cat // 10 <> line),
behind AS (SELECT act.line AS of_line, pc.* FROM act JOIN pc ON pc.cat = act.cat),
native_point AS (
  SELECT 'bt-' || cat || '-' || ln AS g, upper(city) AS city, upper(state) AS state, zip, lq AS q,
         CASE rk WHEN 1 THEN 'F' WHEN 2 THEN 'N' ELSE 'D' END AS dest
  FROM pc WHERE st = 'P' AND ls = 'F'),
native_detail AS (SELECT cat, 'bt-' || cat || '-' || ln AS g FROM pc WHERE st = 'P'),
flagged AS (
  SELECT line, cat, kind,
         EXISTS (SELECT 1 FROM native_detail d JOIN native_point p ON p.g = d.g WHERE d.cat = act.cat) AS hit
  FROM act WHERE kind <> 2),
native_line AS (SELECT DISTINCT line FROM flagged JOIN lx USING (line) WHERE hit OR m = 12),
todo AS (SELECT * FROM lx WHERE m <> 12 AND EXISTS (SELECT 1 FROM flagged f WHERE f.line = lx.line AND NOT hit)),
hosted AS (
  SELECT line, m,
         CASE WHEN st = 'F' AND n_known > 0 THEN 1 WHEN st = 'O' AND n_known > 0 THEN 2 ELSE 0 END AS host
  FROM (SELECT todo.line, any_value(todo.m) AS m, any_value(todo.st) AS st, count(*) FILTER (known) AS n_known
        FROM todo LEFT JOIN behind ON of_line = todo.line GROUP BY todo.line)),
qual AS (
  SELECT hosted.line, hosted.m, host, b.* EXCLUDE (of_line, line, m),
    CASE WHEN host = 1 THEN
      CASE WHEN hosted.m IN (0, 1, 2, 3, 5) THEN 1 WHEN NOT known THEN NULL WHEN hosted.m = 10 AND ls = 'F' THEN 1
           WHEN hosted.m IN (4, 9) AND rk NOT IN (0, 4) THEN 1
           WHEN hosted.m = 8 AND rk NOT IN (0, 4) AND nk = 3 THEN 1
           WHEN hosted.m IN (6, 7) AND disc >= 0.05 THEN 1 END
    WHEN host = 2 THEN
      CASE WHEN hosted.m IN (2, 3, 5, 10) THEN 1 WHEN NOT known THEN NULL
           WHEN hosted.m = 0 AND lq > 1 THEN (lq + 1) // 2 - 1
           WHEN hosted.m = 1 AND lq - (lq + 1) // 2 > 0 THEN lq - (lq + 1) // 2
           WHEN hosted.m IN (6, 7) AND disc >= 0.05 THEN 1 END
    END AS q
  FROM hosted JOIN behind b ON b.of_line = hosted.line),
st1 AS (
  SELECT todo.*, (SELECT CAST(host AS BIGINT) FROM hosted WHERE hosted.line = todo.line) AS host,
         (SELECT CAST(sum(q) AS BIGINT) FROM qual WHERE qual.line = todo.line) AS calc,
         (SELECT count(q) FROM qual WHERE qual.line = todo.line) AS n_details,
         (SELECT CAST(type_id AS BIGINT) FROM type_ids WHERE type_ids.guid = todo.guid) AS type_id,
         (SELECT c_custkey FROM customer WHERE c_custkey = ck AND c_acctbal >= 0) AS cust
  FROM todo),
status AS (
  SELECT *, coalesce(calc = qty, false) AS is_match,
    CASE WHEN cust IS NULL THEN 'Customer id could not be identified.'
         WHEN host = 0 THEN 'Line item host system could not be identified for delivery point data generation.'
         WHEN guid IS NULL THEN
           'Cannot match line item calculator module ' || module || ' to a billing transaction type guid.'
         WHEN type_id IS NULL THEN
           'Cannot find billing transaction type id for billing transaction type guid ' || guid
         WHEN host = 2 AND m IN (4, 8, 9) THEN
           'No btdpd-generation line item calculator module match found for ' || module || ' with host system id 2'
         WHEN calc IS NULL OR calc <> qty THEN
           'Calculated quantity (' || coalesce(CAST(calc AS VARCHAR), 'NULL')
             || ') does not match invoiced quantity (' || qty || ')'
    END AS warning
  FROM st1),
good AS (SELECT *, {_LINE_GUID} AS tg FROM status WHERE warning IS NULL),
new_point AS (
  SELECT line, upper(city) AS city, upper(state) AS state, zip, CASE WHEN rk = 4 THEN NULL ELSE rk <> 0 END AS abroad,
         count(*) AS q
  FROM qual WHERE q IS NOT NULL AND known AND host <> 0 GROUP BY ALL),
gen_point AS (
  SELECT p.*, g.tg, CASE WHEN abroad THEN 'F' ELSE 'D' END AS dest FROM new_point p JOIN good g USING (line)),
rate AS (
  SELECT lx.*, cat,
         CASE CASE WHEN kind = 3 THEN pr % 5 + 1 ELSE pr END
           WHEN 1 THEN 6 WHEN 2 THEN 8 WHEN 3 THEN NULL ELSE 1 END AS rate_type,
         CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) WHEN kind = 3 THEN 0 END AS up
  FROM lx JOIN flagged USING (line) JOIN customer ON c_custkey = ck),
native_addr AS (
  SELECT r.line AS b, r.ck, city, state, zip, dest, rate_type, up, exportable, cents, CAST(sum(p.q) AS BIGINT) AS q
  FROM rate r JOIN native_detail d ON d.cat = r.cat JOIN native_point p ON p.g = d.g
  WHERE r.m <> 12 AND r.line IN (SELECT line FROM native_line)
  GROUP BY ALL),
gen_addr AS (
  SELECT r.line AS b, r.ck, p.city, p.state, p.zip, dest, rate_type, up, exportable, cents,
         CAST(sum(p.q) AS BIGINT) AS q
  FROM rate r JOIN gen_point p ON p.line = r.line
  GROUP BY ALL)
"""


def _distribution(addr: str) -> str:
    return f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY b ORDER BY {_ORDER}) AS n, count(*) OVER (PARTITION BY b) AS cnt,
         CAST(sum(q) OVER (PARTITION BY b) AS BIGINT) AS total
  FROM ({addr})),
rd AS (SELECT *, (2 * cents * 1000000 + total) // (2 * total) AS pr8 FROM numbered)
"""


_RATE = """,
milled AS (SELECT *, (pr8 + 50000) // 100000 AS mills FROM rd),
given AS (
  SELECT *, cents * 10 - CAST(coalesce(sum(CASE WHEN n < cnt THEN mills * q END) OVER (PARTITION BY b), 0) AS BIGINT)
            AS rem FROM milled),
alloc AS (
  SELECT b, ck, city, state, zip, dest, q, exportable,
    CASE WHEN rate_type NOT IN (6, 8) THEN coalesce(up, 0) * 10000
         WHEN n = cnt THEN CAST(sign(rem) AS BIGINT) * ((2 * abs(rem) * 1000 + q) // (2 * q))
         ELSE mills * 1000 END AS rate_u
  FROM given),
home AS (
  SELECT c_custkey AS hk, n_name AS hcity, r_name AS hstate, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS hzip
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
filled AS (
  SELECT b, q, rate_u, dest, exportable,
    CASE WHEN e THEN hcity ELSE city END AS city, CASE WHEN e THEN hstate ELSE state END AS state,
    CASE WHEN e THEN hzip ELSE zip END AS zip
  FROM (SELECT *, trim(coalesce(city, '')) = '' AND trim(coalesce(state, '')) = '' AND trim(coalesce(zip, '')) = ''
               AS e FROM alloc) JOIN home ON hk = ck),
service AS (
  SELECT line AS b, CAST(qty AS BIGINT) AS q, CASE WHEN pr < 5 THEN (cents // 1000) * 10000 ELSE 0 END AS rate_u,
         hcity AS city, hstate AS state, hzip AS zip, exportable
  FROM lx JOIN home ON hk = ck
  WHERE m = 12 AND EXISTS (SELECT 1 FROM flagged f WHERE f.line = lx.line))
"""

_DISTRIBUTION_OUT = """
SELECT b AS sales_tax_batch_key, city, state AS state_region, zip AS postal_code, q AS quantity, n AS line_number,
       cnt AS lines_per_batch, pr8 AS pro_rata_e8, cents * 10000 AS price_u, coalesce(up, 0) * 10000 AS unit_price_u,
       CAST(rate_type AS BIGINT) AS rate_type_key, dest AS destination_code, exportable AS is_exportable
FROM rd"""


def _details_out(source: str, domestic: str = "coalesce(dest = 'D', false)") -> str:
    return f"""
SELECT b AS sales_tax_batch_key, q AS quantity, CAST(rate_u AS BIGINT) AS rate_u, city, state AS region, zip,
       NOT ({domestic}) AS is_foreign, ({domestic}) AND exportable AS should_export
FROM {source}"""


_SERVICE_OUT = _details_out("service", "true")
_NATIVE = _BASE + _distribution("SELECT * FROM native_addr")
_GENERATED = _BASE + _distribution("SELECT * FROM gen_addr")
# A line with generated points takes its addresses from them.
_BOTH = _BASE + _distribution(
    "SELECT * FROM native_addr WHERE b NOT IN (SELECT b FROM gen_addr) UNION ALL SELECT * FROM gen_addr"
)


def _zeros_below(n: int) -> str:
    """Batches of a run over native points of which those under ``n`` count nothing."""
    return _BOTH.replace("zip, lq AS q", f"zip, CASE WHEN lq < {n} THEN 0 ELSE lq END AS q") + """,
zero AS (
  SELECT b, any_value(sk) AS sk, CASE WHEN bool_or(fixed) AND sum(q) = 0 THEN 'total quantity of a batch is zero'
         ELSE 'quantity of the last address of a batch is zero' END AS why
  FROM (SELECT *, coalesce(rate_type IN (6, 8), true) AS fixed FROM numbered) JOIN lx ON line = b GROUP BY b
  HAVING (bool_or(fixed) AND sum(q) = 0) OR bool_or(fixed AND n = cnt AND q = 0))"""


def _batches(lines: str) -> str:
    return f"""
SELECT line AS sales_tax_batch_key, {_uuid("'batch|' || line")} AS sales_tax_batch_id, sk AS session_key,
       line AS invoice_line_item_key, CAST(1 AS BIGINT) AS status_key, grp AS group_key, item_key AS line_item_key,
       tax_code, tax_category
FROM lx WHERE line IN ({lines})"""


def _summary(where: str) -> str:
    return f"""
SELECT CASE host WHEN 1 THEN 'Host 1' WHEN 2 THEN 'Host 2' ELSE 'Unknown' END AS host,
       line AS invoice_line_item_key, format('{{:,}}', calc) AS calc, format('{{:,}}', qty) AS inv, is_match AS valid,
       vendor AS item, format('{{:,}}', n_details) AS cat_details, module
FROM status WHERE {where}"""


_TODO_COLUMNS = """line AS invoice_line_item_key, sk AS session_key, grp AS group_key, item_key AS line_item_key,
       tax_code, tax_category"""

_EVENT_LOG = """
WITH e AS (
  SELECT event_id, props, strftime(ts, '%Y-%m-%d %H:%M:%S.') || substr(strftime(ts, '%f'), 1, 4) AS logged,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'TRACE' WHEN 'click' THEN 'DEBUG' ELSE 'INFO' END
           AS level,
         CASE event_type WHEN 'purchase' THEN 'App-ApiTiming' ELSE 'App-ApiContent' END AS name,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events)
"""

_CLIENTS = """
SELECT c_custkey AS client_configuration_key, c_name AS client_configuration_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders)"""


def _check(table: str, check: str, key: str, count: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '{key}' AS key_name,
       CAST(({count}) AS BIGINT) AS violations"""


_LATEST = "SELECT {} FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)"
_LATEST_SESSIONS = _LATEST.format("o_custkey * 10000 + year(o_orderdate)")
_LATEST_ORDERS = _LATEST.format("o_orderkey")
_HELD = [  # declared constraints that generated links always meet
    ("category_detail_links", "primary_key", "category_detail_id"), ("session_line_links", "primary_key", "session_line_id"),
    *[("category_detail_links", "foreign_key", k) for k in (
        "detail_key -> details.detail_key", "session_key -> sessions.session_key",
        "invoice_line_item_key -> invoice_line_items.invoice_line_item_key", "line_item_key -> line_items.line_item_key")],
    *[("session_line_links", "foreign_key", k) for k in (
        "session_key -> sessions.session_key", "invoice_line_item_key -> invoice_line_items.invoice_line_item_key",
        "line_item_key -> line_items.line_item_key")],
    *[("category_detail_links", "not_null", k) for k in (
        "category_detail_id", "transaction_guid", "session_key", "invoice_line_item_key", "line_item_key", "host_system_id",
        "detail_key")],
    *[("session_line_links", "not_null", k) for k in (
        "session_line_id", "session_key", "invoice_line_item_key", "line_item_key", "host_system_id")],
    ("category_detail_links", "default", "host_system_id"),
]

_DAMAGED_LOG = _EVENT_LOG.rstrip()[:-1] + """),
d AS (
  SELECT logged, name, lv AS level, event_id || chr(10) || '  at ' || props AS message,
         'DateTime: ' || logged || '|MessageLevel:' || lv || '|' || CASE WHEN event_id % 7 = 0 THEN 'Log:' ELSE 'LogName:' END || name
           || '|' || event_id || chr(10) || '  at ' || props AS raw,
         CASE WHEN event_id % 7 = 0 THEN 'layout' WHEN lv = 'NOTICE' THEN 'level' END AS reason
  FROM (SELECT *, CASE name WHEN 'App-ApiTiming' THEN 'NOTICE' ELSE level END AS lv FROM e))
"""

ORACLE: dict[str, str] = {
    "rate_distribution": _NATIVE + _DISTRIBUTION_OUT,
    "rate_distribution_line_bridge": _GENERATED + _DISTRIBUTION_OUT,
    "rate_distribution_tag_bridge": _GENERATED + _DISTRIBUTION_OUT,
    "sales_tax_allocation": _NATIVE + _RATE + _details_out("alloc"),
    "sales_tax_service_lines": _NATIVE + _RATE + _SERVICE_OUT,
    "sales_tax_address_fill": _NATIVE + _RATE + _details_out("filled"),
    "sales_tax_details": _NATIVE + _RATE + _details_out("filled") + " UNION ALL " + _SERVICE_OUT,
    "sales_tax_run": _BOTH + _RATE + _details_out("filled") + " UNION ALL " + _SERVICE_OUT,
    "sales_tax_run_batches": _BASE
    + _batches("SELECT line FROM native_line UNION SELECT line FROM gen_point"),
    "sales_tax_run_zero_warnings": _BOTH.replace("zip, lq AS q", "zip, CASE WHEN lq < 10 THEN 0 ELSE lq END AS q") + """
SELECT b AS sales_tax_batch_key, any_value(sk) AS session_key, 'Amount cannot be spread: zero quantity.' AS message
FROM (SELECT *, coalesce(rate_type IN (6, 8), true) AS fixed FROM numbered) JOIN lx ON line = b GROUP BY b
HAVING (bool_or(fixed) AND sum(q) = 0) OR bool_or(fixed AND n = cnt AND q = 0)""",
    "sales_tax_run_outcomes": _zeros_below(4) + """
SELECT sk AS session_key, CAST(CASE WHEN b IS NULL THEN 1 ELSE -102 END AS BIGINT) AS return_code,
       CASE WHEN b IS NULL THEN 'Success' ELSE 'Error creating the sales tax batches. Batch ' || b || ': ' || why END AS return_message
FROM (SELECT DISTINCT o_custkey * 10000 + year(o_orderdate) AS sk FROM orders)
LEFT JOIN (SELECT sk, min(b) AS b, arg_min(why, b) AS why FROM zero GROUP BY sk) USING (sk)""",
    "sales_tax_run_good_sessions": _zeros_below(4) + """
SELECT table_name, sk AS session_key, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT 'transactions' AS table_name, sk FROM good
  UNION ALL SELECT 'delivery_points', sk FROM gen_point JOIN lx USING (line)
  UNION ALL SELECT 'category_detail_links', good.sk FROM qual JOIN good USING (line) WHERE q IS NOT NULL
  UNION ALL SELECT 'session_line_links', sk FROM status
  UNION ALL SELECT 'invoice_warnings', sk FROM status WHERE warning IS NOT NULL AND host <> 0
  UNION ALL SELECT 'sales_tax_batch_details', sk FROM numbered JOIN lx ON line = b
  UNION ALL SELECT 'sales_tax_batch_details', sk FROM lx
            WHERE m = 12 AND EXISTS (SELECT 1 FROM flagged f WHERE f.line = lx.line)
  UNION ALL SELECT 'sales_tax_batches', sk FROM lx
            WHERE line IN (SELECT line FROM native_line UNION SELECT line FROM gen_point))
WHERE sk NOT IN (SELECT sk FROM zero) GROUP BY ALL""",
    "taxable_line_items": _BASE + _batches("SELECT line FROM native_line"),
    "taxable_line_items_sessions": "SELECT * FROM (" + _BASE + _batches("SELECT line FROM native_line")
    + ") WHERE session_key IN (" + _LATEST_SESSIONS + ")",
    "sales_tax_run_sessions": "SELECT * FROM (" + _BOTH + _RATE + _details_out("filled") + " UNION ALL " + _SERVICE_OUT
    + ") WHERE sales_tax_batch_key // 100 IN (" + _LATEST_ORDERS + ")",
    "session_line_item_batches": _BASE + _batches("SELECT line FROM flagged"),
    "session_line_item_batches_strict": _BASE + _batches("SELECT line FROM flagged WHERE cat IN (SELECT cat FROM pc)"),
    "non_service_line_items": _BASE + f"SELECT {_TODO_COLUMNS} FROM todo",
    "infer_host_system": _BASE + "SELECT line AS invoice_line_item_key, host AS host_system_id FROM status",
    "host_of_batches": """
SELECT o_orderkey AS activity_batch_key,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS BIGINT) AS host_system_id
FROM orders WHERE o_orderstatus <> 'P'""",
    "line_item_batches_by_module": _BASE + """
SELECT sk AS session_key, line AS invoice_line_item_key, module, md5('bab-' || ok) AS activity_batch_id,
       n AS meta_group_key, st = 'P' AS is_native_batch
FROM (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY line) AS n FROM lx) x JOIN act USING (line)
WHERE cat > 0""",
    "calculator_transaction_type": _BASE + """
SELECT line AS invoice_line_item_key, module, lx.guid AS transaction_type_guid,
       CAST(type_id AS BIGINT) AS transaction_type_id
FROM lx LEFT JOIN type_ids ON type_ids.guid = lx.guid""",
    "qualify_details": _BASE + """
SELECT line AS invoice_line_item_key, CAST(host AS BIGINT) AS host_system_id, dk AS detail_key,
       piece AS data_stream_detail_id, CAST(q AS BIGINT) AS quantity
FROM qual WHERE q IS NOT NULL""",
    "reconcile_quantity": _BASE + """
SELECT line AS invoice_line_item_key, calc AS calculated_quantity, qty AS invoiced_quantity, is_match FROM status""",
    "qualification_summary": _BASE + _summary("true"),
    "qualification_summary_mismatched": _BASE + _summary("NOT is_match"),
    "qualification_log": _BASE + """
SELECT line AS invoice_line_item_key,
       concat(line, ' - Matched: ', CAST(is_match AS INT), ' - Calc: ', calc, ' - Inv: ', qty, ' - Module: ', module)
         AS line
FROM status""",
    "mismatched_details": _BASE + """
SELECT s.host AS host_system_id, s.line AS invoice_line_item_key, dk AS detail_key, CAST(q AS BIGINT) AS quantity,
       CASE s.host WHEN 2 THEN city END AS city, CASE s.host WHEN 2 THEN lower(state) END AS state,
       CASE s.host WHEN 2 THEN zip END AS zip, CAST(CASE s.host WHEN 2 THEN lq END AS BIGINT) AS page_count,
       CAST(CASE s.host WHEN 2 THEN (lq + 1) // 2 END AS BIGINT) AS paper_page_count,
       CASE s.host WHEN 2 THEN disc >= 0.05 END AS is_force_mailed,
       CASE WHEN s.host = 2 AND rk <> 4 THEN rk <> 0 END AS is_foreign
FROM status s JOIN qual USING (line) WHERE NOT is_match AND q IS NOT NULL AND known""",
    "delivery_point_preview": _BASE + """
SELECT s.line AS invoice_line_item_key, s.host AS host_system_id, q AS detail_count, city, state AS state_region,
       zip AS postal_code, CASE WHEN abroad THEN 'Yes' ELSE 'No' END AS is_foreign
FROM status s JOIN new_point USING (line) WHERE is_match""",
    "generate_delivery_points": _BASE + """
SELECT -g.line AS transaction_id, g.tg AS transaction_guid, p.city, p.state AS state_region, p.zip AS postal_code,
       CAST(NULL AS VARCHAR) AS country_code, p.dest AS destination_code, p.q AS quantity,
       concat_ws('|', 'btdp-gen', g.sk, g.host, g.line, g.tg) AS user_added, true AS is_active
FROM good g JOIN gen_point p ON p.line = g.line""",
    "generate_billing_transactions": _BASE + """
SELECT -line AS transaction_id, tg AS transaction_guid, type_id AS transaction_type_id,
       CAST(3 AS BIGINT) AS transaction_status_id, cust AS customer_id, CAST(4 AS BIGINT) AS location_id,
       qty AS quantity, concat_ws('|', 'btdp-gen', sk, host, line, tg) AS user_added, true AS is_active
FROM good""",
    "link_details_to_transactions": _BASE + """
SELECT g.tg AS transaction_guid, g.sk AS session_key, g.line AS invoice_line_item_key, g.item_key AS line_item_key,
       g.module, g.host AS host_system_id, dk AS detail_key
FROM good g JOIN qual ON qual.line = g.line WHERE q IS NOT NULL""",
    "link_details_last_wins": _BASE + """
SELECT g.tg AS transaction_guid, g.sk AS session_key, g.line AS invoice_line_item_key, g.item_key AS line_item_key,
       g.module, g.host AS host_system_id, dk AS detail_key
FROM good g JOIN qual ON qual.line = g.line WHERE q IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY dk ORDER BY g.line DESC) = 1""",
    "session_line_links": _BASE + f"""
SELECT sk AS session_key, line AS invoice_line_item_key, item_key AS line_item_key, host AS host_system_id,
       CASE WHEN warning IS NULL THEN {_LINE_GUID} END AS transaction_guid
FROM status""",
    "invoice_warnings": _BASE + """
SELECT sk AS session_key, item_key AS line_item_key, warning AS message, false AS is_resolved,
       'tax-run' AS user_added, true AS is_active
FROM status WHERE warning IS NOT NULL AND host <> 0""",
    "referential_checks": _BASE
    + " UNION ALL ".join(
        [
            *[_check(*held, "SELECT 0") for held in _HELD],
            _check("details", "primary_key", "category_key", "SELECT count(*) - count(DISTINCT cat) FROM pc"),
            _check("details", "foreign_key", "data_stream_detail_id -> host1_pieces.data_stream_detail_id",
                   "SELECT count(*) FROM pc WHERE piece IS NOT NULL AND (st <> 'F' OR NOT known)"),
            _check("client_configurations", "foreign_key", "account_code -> customers.account",
                   "SELECT count(*) FROM customer WHERE c_acctbal < 0"),
            _check("details", "not_null", "transaction_guid", "SELECT count(*) FROM pc WHERE st <> 'P'"),
            _check("details", "not_null", "return_detail_id", "SELECT count(*) FROM pc WHERE lf = 'N'"),
            _check("session_line_links", "default", "host_system_id", "SELECT count(*) FROM status WHERE host = 0"),
        ]
    ),
    "category_totals": _BASE + """
SELECT lx.line AS invoice_line_item_key, grp AS group_key, item_key AS line_item_key, module,
       CAST(sum(lq) AS BIGINT) AS batch_total, count(*) FILTER (disc >= 0.05) AS total_suppressed,
       count(*) FILTER (ls = 'F') AS total_updated, count(*) FILTER (ls = 'O') AS total_returned
FROM lx JOIN behind ON of_line = lx.line WHERE lx.line IN (SELECT line FROM flagged) GROUP BY 1, 2, 3, 4""",
    "return_update_counts": _BASE + """
SELECT of_line AS invoice_line_item_key, count(*) FILTER (lf = 'R') AS num_returns,
       count(*) FILTER (lf = 'A') AS num_updates
FROM behind WHERE lf <> 'N' GROUP BY of_line""",
    "line_item_details": _BASE + """
SELECT cat AS category_key, of_line AS invoice_line_item_key, dk AS detail_key, pid AS detail_id,
       CASE st WHEN 'P' THEN md5('bt-' || cat || '-' || ln) END AS transaction_guid, piece AS data_stream_detail_id,
       CASE WHEN lf <> 'N' THEN 'r' || pid END AS return_detail_id
FROM behind""",
    "transactions_for_line": _BASE + """
SELECT cat * 10 + ln AS transaction_id, md5('bt-' || cat || '-' || ln) AS transaction_guid, ck AS customer_id,
       CAST(sum(lq) AS BIGINT) AS quantity
FROM pc WHERE st = 'P' GROUP BY cat, ln, ck""",
    "session_line_item_report": _BASE + """
SELECT line AS invoice_line_item_key, 'Item ' || m AS line_item_name, 'Catalogue item ' || m AS line_item_description,
       qty AS quantity, m = 12 AS use_customer_tax_address, exportable AS is_exportable
FROM lx WHERE line IN (SELECT line FROM flagged)""",
    "active_clients": _CLIENTS + """
  AND c_custkey IN (SELECT user_id FROM events WHERE event_type = 'click'
                    AND ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31')""",
    "clients_with_invoices": _CLIENTS,
    "invoices_for_client": """
SELECT o_custkey * 10000 + year(o_orderdate) AS session_key, o_custkey AS client_configuration_key,
       strftime(o_orderdate, '%Y-%m-%d') AS invoice_billing_date, strftime(o_orderdate, '%Y-%m-%d') AS date_added,
       'clerk-' || substr(o_orderpriority, 1, 1) AS user_added, o_orderstatus <> 'P' AS is_active
FROM orders""",
    "activity_category_types": _BASE + """
SELECT DISTINCT md5('ct-' || lf) AS category_type_id, 'Category ' || lf AS category_type_name,
       lx.line AS invoice_line_item_key, module
FROM lx JOIN behind ON of_line = lx.line""",
    "non_service_lines_with_item": _BASE + f"SELECT {_TODO_COLUMNS}, vendor AS vendor_item_name FROM todo",
    "non_service_lines_with_catalogue_item": _BASE
    + f"SELECT {_TODO_COLUMNS}, 'Vendor item ' || m AS vendor_item_name FROM todo",
    "parse_log_lines": _EVENT_LOG + """
SELECT logged AS logged_at, level, name AS log_name, event_id || ' | ' || props AS message, day FROM e
WHERE level <> 'TRACE'""",
    "parse_log_records": _EVENT_LOG + """
SELECT logged AS logged_at, level, name AS log_name, event_id || chr(10) || '  at ' || props AS message, day FROM e
WHERE level <> 'TRACE'""",
    "rejected_log_records": _DAMAGED_LOG + "SELECT raw, reason FROM d WHERE reason IS NOT NULL",
    "log_record_counts": _DAMAGED_LOG + """
SELECT verdict, count(reason IS NULL OR true) FILTER (of) AS records FROM (
  SELECT v.verdict, reason, CASE v.verdict WHEN 'read' THEN true WHEN 'rejected' THEN reason IS NOT NULL
         WHEN 'below level' THEN reason IS NULL AND level = 'TRACE' WHEN 'kept' THEN reason IS NULL AND level <> 'TRACE'
         ELSE false END AS of
  FROM d, (VALUES ('read'), ('kept'), ('below level'), ('other log'), ('rejected')) v(verdict)) GROUP BY verdict""",
    "stream_log_records": _DAMAGED_LOG + """
SELECT CASE WHEN reason IS DISTINCT FROM 'layout' THEN logged END AS logged_at,
       CASE WHEN reason IS DISTINCT FROM 'layout' THEN level END AS level,
       CASE WHEN reason IS DISTINCT FROM 'layout' THEN name END AS log_name,
       CASE WHEN reason IS DISTINCT FROM 'layout' THEN message END AS message,
       CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END AS verdict, reason, CASE WHEN reason IS NOT NULL THEN raw END AS raw
FROM d WHERE reason IS NOT NULL OR level <> 'TRACE'""",
    "latest_outcomes": """
SELECT o_custkey AS session_key, 'run-' || o_orderkey AS run_id,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -102 ELSE 0 END AS return_code, o_orderpriority AS return_message
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate), 'run-' || o_orderkey DESC) = 1""",
    "parse_log_blocks": _EVENT_LOG + """
SELECT logged AS logged_at, level, 'App-Application' AS log_name, event_id || chr(13) || chr(10) || props AS message, day
FROM e WHERE level <> 'TRACE'""",
    "unwrap_nested_json": """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS logged FROM events)
SELECT event_id || '-1' AS name1, logged AS time1, event_id || '-2' AS name2, logged AS time2, event_id || '-3' AS name3,
       logged AS time3, props AS data
FROM e""",
}
ORACLE["qualify_details_bucketed"] = ORACLE["qualify_details"]  # the same rows by another plan
ORACLE["unwrap_json_levels"] = """
SELECT event_id AS id, CAST(level AS BIGINT) AS level, event_id || '-' || level AS name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time,
       CASE WHEN level = event_id % 5 + 1 THEN CASE WHEN event_id % 11 = 0 THEN '{"Name": "cut o' ELSE props END END AS data,
       level = event_id % 5 + 1 AND event_id % 11 = 0 AS broken
FROM events, generate_series(1, 5) g(level) WHERE level <= event_id % 5 + 1"""
