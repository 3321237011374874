"""SQL that states, for another engine, what each registered query returns.

``PARTS`` holds named common table expressions; a statement lists the ones it starts
from and gets those they refer to, in order.  The SQL is written from the meaning of
each result, with plain range joins and correlated conditions where the Spark jobs carry
values forward or split keys.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-02-01'"
LINES_AS_OF = "DATE '2001-12-01'"
LINES_SINCE = f"CAST({LINES_AS_OF} - 2600 AS TIMESTAMP)"
SINCE_YEAR = "TIMESTAMP '2023-02-01'"
SINCE_HALF = f"({AS_OF} - INTERVAL 180 DAY)"

PARTS: dict[str, str] = {}
STATEMENTS: dict[str, str] = {}

# -- feeds -------------------------------------------------------------------------------

PARTS["ev"] = """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id AS uid, event_type, value, props,
       CAST(REPLACE(REPLACE(props, '{"k": ', ''), '}', '') AS INTEGER) AS k,
       'u' || CAST(user_id AS VARCHAR) || '@example.com' AS email
FROM events"""

PARTS["history"] = """
SELECT CAST(uid % 25 AS VARCHAR) AS workspace_id, 'st-' || event_id AS statement_id, email AS executed_by,
       'wh-' || uid % 5 AS warehouse_id,
       CASE WHEN k % 6 = 0 THEN '  describe select * from t' || event_id
            WHEN k % 6 = 1 THEN 'SELECT approx_top_k(c' || k || ', 1024) FROM t'
            WHEN k % 6 = 2 THEN 'with sampleddata as (select 1) select * from sampleddata'
            WHEN k % 6 = 3 THEN 'DESCRIBE SELECT approx_top_k(c) FROM t'
            ELSE 'SELECT ' || props END AS statement_text,
       CASE WHEN k <> 97 THEN 'SELECT' END AS statement_type,
       CASE k % 4 WHEN 1 THEN 'Console' WHEN 2 THEN 'Driver' WHEN 3 THEN 'Notebook UI' END AS client,
       (k % 5) * 200 AS compute_ms, (k % 7) * 100 AS queue_ms, (k % 11) * 50 AS compile_ms,
       CASE WHEN k = 98 THEN 0 ELSE CAST(floor(value * 1000) AS BIGINT) END AS task_ms,
       (k % 13) * 30 AS fetch_ms,
       ts AS start_time, ts + to_seconds(CAST(floor(value * 20) AS BIGINT)) AS end_time,
       CASE WHEN k % 10 = 0 THEN 'JOB' WHEN k = 11 THEN 'LEGACY DASHBOARD' WHEN k % 10 IN (1, 2) THEN 'DASHBOARD'
            WHEN k % 10 = 3 THEN 'ALERT' WHEN k % 10 = 4 THEN 'NOTEBOOK' WHEN k % 10 = 5 THEN 'SQL QUERY'
            WHEN k % 10 IN (6, 7, 8) THEN 'ASSISTANT SPACE' END AS source,
       CASE WHEN k % 10 = 0 THEN 'job-' || uid WHEN k = 11 THEN 'ld-' || uid
            WHEN k % 10 IN (1, 2) THEN 'd-' || k % 20 WHEN k % 10 = 3 THEN 'al-' || uid
            WHEN k % 10 = 4 THEN 'nb-' || uid WHEN k % 10 = 5 THEN 'sq-' || uid
            WHEN k % 10 IN (6, 7, 8) THEN 'sp-' || uid % 7 END AS source_key
FROM ev WHERE event_type <> 'signup'"""

PARTS["wh_events"] = """
SELECT CASE WHEN k = 98 THEN 'wh-unused' ELSE 'wh-' || uid % 5 END AS warehouse_id,
       CASE WHEN k <> 99 THEN k % 3 END AS cluster_count, ts AS event_time
FROM ev WHERE event_type = 'signup'"""

PARTS["bill_wh"] = """
SELECT CAST(uid % 5 AS VARCHAR) AS workspace_id, 'WH_' || uid % 2 AS sku_name, 'C0' AS cloud,
       date_trunc('hour', ts) AS usage_start_time, date_trunc('hour', ts) + INTERVAL 1 HOUR AS usage_end_time,
       CAST(count(*) * CAST(0.500000123 AS DECIMAL(10,9)) AS DECIMAL(18,9)) AS quantity, 'wh-' || uid % 5 AS warehouse_id
FROM ev WHERE event_type <> 'signup' GROUP BY uid % 5, uid % 2, date_trunc('hour', ts)"""

PARTS["bill_app"] = """
SELECT CAST(uid % 25 AS VARCHAR) AS workspace_id,
       CASE WHEN uid % 40 = 39 THEN 'APP_UNPRICED' ELSE 'APP_STD' END AS sku_name, 'C0' AS cloud,
       date_trunc('day', ts) AS usage_start_time, date_trunc('day', ts) + INTERVAL 1 DAY AS usage_end_time,
       CAST(SUM(CAST(value AS DECIMAL(18,6)) + CAST(0.000000123 AS DECIMAL(18,9))) AS DECIMAL(18,9)) AS quantity,
       'a-' || uid % 40 AS app_id, 'n-' || uid % 5 AS app_name
FROM ev WHERE event_type IN ('purchase', 'error')
GROUP BY uid % 40, uid % 25, uid % 5, date_trunc('day', ts)"""

PARTS["bill_serve"] = """
SELECT CAST(uid % 40 % 25 AS VARCHAR) AS workspace_id, 'SERVE_STD' AS sku_name, 'C0' AS cloud,
       date_trunc('day', ts) AS usage_start_time, date_trunc('day', ts) + INTERVAL 1 DAY AS usage_end_time,
       CAST(SUM(CAST(value AS DECIMAL(18,6)) + CAST(0.000000123 AS DECIMAL(18,9))) AS DECIMAL(18,9)) AS quantity,
       'ep-' || uid % 40 AS endpoint_id, 'endpoint ' || uid % 40 AS endpoint_name
FROM ev WHERE event_type IN ('view', 'error') GROUP BY uid % 40, date_trunc('day', ts)"""

PARTS["bill_events"] = """
SELECT workspace_id, sku_name, cloud, usage_start_time, usage_end_time, quantity FROM bill_wh
UNION ALL SELECT workspace_id, sku_name, cloud, usage_start_time, usage_end_time, quantity FROM bill_app
UNION ALL SELECT workspace_id, sku_name, cloud, usage_start_time, usage_end_time, quantity FROM bill_serve"""

PARTS["lines"] = """
SELECT CAST(s_nationkey AS VARCHAR) AS workspace_id,
       CASE WHEN l_linenumber % 2 = 0 THEN p_brand WHEN l_returnflag = 'A' THEN 'ASSISTANT_FREE_USAGE'
            ELSE 'REALTIME_INFERENCE_' || p_brand END AS sku_name,
       'C' || l_suppkey % 3 AS cloud, CAST(l_shipdate AS TIMESTAMP) AS usage_start_time,
       CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 HOUR AS usage_end_time,
       CAST(l_quantity AS DECIMAL(18,9)) + CAST(0.000000123 AS DECIMAL(18,9)) AS quantity,
       CASE WHEN l_linenumber % 2 = 0 AND l_partkey % 20 <> 0 THEN 'ep-' || l_suppkey END AS endpoint_id,
       CASE WHEN l_linenumber % 2 = 0 AND l_partkey % 20 <> 0 THEN 'index ' || l_suppkey END AS endpoint_name,
       CASE l_suppkey % 3 WHEN 0 THEN 'CODE' WHEN 1 THEN 'ONE' ELSE 'AGENTS' END AS surface,
       CASE WHEN l_partkey % 2 = 0 THEN 'UI' ELSE 'API' END AS channel,
       CASE WHEN l_suppkey % 3 = 2 THEN 'sp-' || l_suppkey % 8 END AS agent_id,
       'u' || l_suppkey || '@example.com' AS run_as,
       l_linenumber % 2 = 0 AS is_index,
       NOT (l_returnflag = 'R' AND l_linestatus = 'F') AS is_original,
       l_suppkey % 10 <> 0 AS is_token
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey"""

PARTS["prices"] = """
SELECT prefix || p_brand AS sku_name, 'C' || c AS cloud, make_timestamp(y, 1, 1, 0, 0, 0.0) AS price_start,
       CASE WHEN y < 2001 THEN make_timestamp(y + 1, 1, 1, 0, 0, 0.0) END AS price_end,
       CAST((100 + (y - 1995) * 10 + c) * 0.001 AS DECIMAL(18,9)) + CAST(0.000000321 AS DECIMAL(18,9)) AS price
FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'Brand#25')
CROSS JOIN range(0, 3) AS clouds(c) CROSS JOIN range(1995, 2002) AS years(y)
CROSS JOIN (VALUES (''), ('REALTIME_INFERENCE_')) AS prefixes(prefix)
UNION ALL
SELECT sku, 'C0', CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), CAST(p AS DECIMAL(18,9)) + CAST(0.000000321 AS DECIMAL(18,9))
FROM (VALUES ('WH_0', '2023-01-01', '2024-01-15 12:00:00', 0.704), ('WH_0', '2024-01-15 12:00:00', NULL, 0.784),
             ('WH_1', '2023-01-01', '2024-01-15 12:00:00', 0.224), ('WH_1', '2024-01-15 12:00:00', NULL, 0.256),
             ('APP_STD', '2023-01-01', '2024-01-15 12:00:00', 0.95), ('APP_STD', '2024-01-15 12:00:00', NULL, 1.00),
             ('SERVE_STD', '2023-01-01', '2024-01-15 12:00:00', 0.07),
             ('SERVE_STD', '2024-01-15 12:00:00', NULL, 0.08)) AS stepped(sku, s, e, p)"""

PARTS["workspaces"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS workspace_id, n_name AS workspace_name FROM nation WHERE n_nationkey < 24"""

PARTS["spaces"] = """
SELECT DISTINCT 'sp-' || s_suppkey % 7 AS space_id, 'Space ' || s_suppkey % 7 AS space_name FROM supplier"""

PARTS["dashboards"] = """
SELECT DISTINCT 'd-' || p_size % 18 AS dashboard_id, 'Dashboard ' || p_size % 18 AS dashboard_name FROM part"""

PARTS["users"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, lower(c_name) || '@example.com' AS address
FROM customer WHERE c_mktsegment <> 'BUILDING'"""

PARTS["app_events"] = """
SELECT CAST(uid % 25 AS VARCHAR) AS workspace_id, CAST(ts AS DATE) AS usage_date, email,
       CASE WHEN k >= 95 THEN 'x-' ELSE 'n-' END || uid % 5 AS app_name
FROM ev WHERE event_type IN ('purchase', 'click')"""

PARTS["entities"] = """
SELECT DISTINCT 'se-' || uid % 60 AS served_entity_id, CAST(uid % 60 % 40 % 25 AS VARCHAR) AS workspace_id,
       'endpoint ' || uid % 60 % 40 AS endpoint_name, 'ep-' || uid % 60 % 40 AS endpoint_id,
       CASE uid % 4 WHEN 0 THEN 'FOUNDATION_MODEL' WHEN 1 THEN 'EXTERNAL_MODEL' WHEN 2 THEN 'CUSTOM_MODEL'
            ELSE 'FEATURE_SPEC' END AS entity_type,
       'model ' || uid % 60 AS entity_name, CASE WHEN uid % 4 >= 2 THEN CAST(uid AS VARCHAR) END AS entity_version,
       1 + uid // 60 AS version
FROM ev WHERE uid % 60 NOT IN (59, 39)"""

PARTS["current_entities"] = """
SELECT endpoint_id, endpoint_name, served_entity_id, entity_type, entity_name, entity_version, workspace_id
FROM (SELECT *, row_number() OVER (PARTITION BY served_entity_id ORDER BY version DESC) AS rn FROM entities)
WHERE rn = 1"""

PARTS["requests"] = """
SELECT CAST(uid % 60 % 40 % 25 AS VARCHAR) AS workspace_id, 'se-' || uid % 60 AS served_entity_id, ts AS request_time,
       k * 10 AS input_tokens, CASE WHEN k % 20 <> 0 THEN CAST(floor(value) AS BIGINT) END AS output_tokens
FROM ev WHERE event_type IN ('view', 'click')"""

PARTS["endpoint_requests"] = """
SELECT e.endpoint_id, CAST(r.request_time AS DATE) AS usage_date, r.workspace_id, count(*) AS request_count,
       CAST(SUM(coalesce(r.input_tokens, 0)) AS BIGINT) AS input_tokens,
       CAST(SUM(coalesce(r.output_tokens, 0)) AS BIGINT) AS output_tokens
FROM requests r JOIN current_entities e USING (served_entity_id) GROUP BY ALL"""

PARTS["endpoint_main"] = """
SELECT endpoint_id, workspace_id, served_entity_id, endpoint_name, entity_type, entity_name, entity_version,
       entity_count
FROM (SELECT e.*, count(*) OVER (PARTITION BY e.endpoint_id, e.workspace_id) AS entity_count,
             row_number() OVER (PARTITION BY e.endpoint_id, e.workspace_id
                                ORDER BY coalesce(n.n, 0) DESC, e.served_entity_id) AS rn
      FROM current_entities e
      LEFT JOIN (SELECT served_entity_id, workspace_id, count(*) AS n FROM requests GROUP BY ALL) n
             ON n.served_entity_id = e.served_entity_id AND n.workspace_id = e.workspace_id)
WHERE rn = 1"""

# -- allocation --------------------------------------------------------------------------

PARTS["bounds"] = """
SELECT date_trunc('hour', greatest(a, b, c)) + INTERVAL 1 HOUR AS lo, date_trunc('hour', least(d, e, f)) AS hi
FROM (SELECT min(event_time) AS a, max(event_time) AS d FROM wh_events),
     (SELECT min(start_time) AS b, max(end_time) AS e FROM history),
     (SELECT min(usage_end_time) AS c, max(usage_end_time) AS f FROM bill_events)"""

PARTS["work"] = """
SELECT h.*, (task_ms + fetch_ms + compile_ms) / 1000.0 AS task_seconds,
       start_time + to_milliseconds(queue_ms + compute_ms + compile_ms) AS work_start,
       end_time + to_milliseconds(fetch_ms) AS work_end
FROM history h, bounds
WHERE statement_type IS NOT NULL AND start_time < hi AND end_time > lo AND task_ms > 0"""

PARTS["states"] = """
WITH seconds AS (
  SELECT warehouse_id, greatest(lo, date_trunc('second', event_time)) AS moment,
         arg_max(CASE WHEN cluster_count > 0 THEN 'ON' ELSE 'OFF' END, event_time) AS state
  FROM wh_events, bounds
  WHERE event_time < hi AND warehouse_id IN (SELECT warehouse_id FROM work) GROUP BY ALL),
changes AS (
  SELECT *, lag(state) OVER (PARTITION BY warehouse_id ORDER BY moment) AS before FROM seconds)
SELECT warehouse_id, state AS window_state, moment AS "start",
       coalesce(lead(moment) OVER (PARTITION BY warehouse_id ORDER BY moment), hi) AS "end"
FROM changes, bounds WHERE before IS DISTINCT FROM state"""

PARTS["steps"] = """
SELECT warehouse_id, least(hi, greatest(lo, moment)) AS moment, CAST(SUM(step) AS BIGINT) AS step
FROM (SELECT warehouse_id, date_trunc('second', work_start) AS moment, 1 AS step FROM work
      UNION ALL
      SELECT warehouse_id, greatest(date_trunc('second', work_end),
                                    date_trunc('second', work_start) + INTERVAL 1 SECOND), -1 FROM work), bounds
GROUP BY ALL"""

PARTS["active"] = """
SELECT * FROM (
  SELECT warehouse_id, moment AS "start", coalesce(lead(moment) OVER w, hi) AS "end",
         CAST(SUM(step) OVER w AS BIGINT) AS queries_active
  FROM steps, bounds WINDOW w AS (PARTITION BY warehouse_id ORDER BY moment))
WHERE "start" < "end" """

PARTS["ticks"] = """
SELECT warehouse_id, unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour
FROM (SELECT DISTINCT warehouse_id FROM work), bounds"""

PARTS["segments"] = """
WITH instants AS (
  SELECT warehouse_id, hour AS moment FROM ticks UNION SELECT warehouse_id, "start" FROM states
  UNION SELECT warehouse_id, "end" FROM states UNION SELECT warehouse_id, "start" FROM active
  UNION SELECT warehouse_id, "end" FROM active)
SELECT warehouse_id, moment AS "start", coalesce(lead(moment) OVER (PARTITION BY warehouse_id ORDER BY moment), hi) AS "end"
FROM instants, bounds WHERE moment < hi"""

PARTS["periods"] = """
SELECT p.warehouse_id, date_trunc('hour', p."start") AS hour,
       CASE WHEN coalesce(s.window_state, 'OFF') = 'OFF' THEN 'OFF'
            WHEN a.queries_active > 0 THEN 'UTILIZED' ELSE 'ON_IDLE' END AS utilization_flag,
       CAST(SUM(date_diff('second', p."start", p."end")) AS BIGINT) AS duration
FROM segments p
LEFT JOIN states s ON s.warehouse_id = p.warehouse_id AND s."start" < p."end" AND s."end" > p."start"
LEFT JOIN active a ON a.warehouse_id = p.warehouse_id AND a."start" < p."end" AND a."end" > p."start"
GROUP BY ALL"""

PARTS["utilization"] = """
SELECT warehouse_id, hour, CAST(coalesce(SUM(duration) FILTER (utilization_flag = 'UTILIZED'), 0) AS BIGINT) AS used,
       CAST(coalesce(SUM(duration) FILTER (utilization_flag = 'ON_IDLE'), 0) AS BIGINT) AS idle,
       CAST(coalesce(SUM(duration) FILTER (utilization_flag = 'OFF'), 0) AS BIGINT) AS off_time
FROM periods GROUP BY ALL"""

_PRICED_HOURS = """
SELECT u.warehouse_id, u.usage_start_time AS hour_bucket, CAST(SUM(quantity) AS DOUBLE) AS units,
       CAST(SUM(quantity * price) AS DOUBLE) AS dollars
FROM bill_wh u LEFT JOIN prices p ON {match}, bounds
WHERE u.usage_start_time >= lo AND u.usage_end_time <= hi GROUP BY ALL"""

_OPEN = """p.sku_name = u.sku_name AND p.cloud = u.cloud AND u.usage_start_time >= p.price_start
  AND (p.price_end IS NULL OR u.usage_start_time < p.price_end)"""
_CLOSED = """p.sku_name = u.sku_name
  AND u.usage_end_time >= p.price_start AND (p.price_end IS NULL OR u.usage_end_time <= p.price_end)"""

PARTS["priced_hours"] = _PRICED_HOURS.format(match=_OPEN)
PARTS["priced_hours_closed"] = _PRICED_HOURS.format(match=_CLOSED)

PARTS["hours_cost"] = """
SELECT warehouse_id, hour_bucket, units, dollars, used, idle, used + idle + off_time AS total,
       CASE WHEN used + idle > 0 THEN used / (used + idle) END AS share_used
FROM priced_hours LEFT JOIN utilization ON utilization.warehouse_id = priced_hours.warehouse_id
  AND utilization.hour = priced_hours.hour_bucket"""
PARTS["hours_cost"] = PARTS["hours_cost"].replace(
    "SELECT warehouse_id, hour_bucket", "SELECT priced_hours.warehouse_id, hour_bucket"
)

PARTS["hours_cost_closed"] = """
SELECT p.warehouse_id, hour_bucket, units, dollars,
       CASE WHEN used + idle > 0 THEN (200 * used + used + idle) // (2 * (used + idle)) / 100.0 END AS share_used
FROM priced_hours_closed p LEFT JOIN utilization u ON u.warehouse_id = p.warehouse_id AND u.hour = p.hour_bucket"""

PARTS["touched"] = """
SELECT *, date_diff('microsecond', work_start, work_end) / 1e6 AS seconds,
       unnest(generate_series(date_trunc('hour', work_start),
              greatest(date_trunc('hour', work_start), date_trunc('hour', work_end)), INTERVAL 1 HOUR)) AS hour_bucket
FROM work"""

PARTS["parts_of_work"] = """
SELECT statement_id, warehouse_id, hour_bucket, overlap,
       CASE WHEN seconds > 0 THEN task_seconds * (overlap / seconds) ELSE task_seconds END AS part
FROM (SELECT *, greatest(0, date_diff('microsecond', greatest(work_start, hour_bucket),
                                      least(work_end, hour_bucket + INTERVAL 1 HOUR)) / 1e6) AS overlap FROM touched)"""

PARTS["parts_of_work_closed"] = """
SELECT statement_id, warehouse_id, hour_bucket,
       CASE WHEN seconds > 0 THEN task_seconds * (overlap / seconds) ELSE 0 END AS part
FROM (SELECT *, greatest(0, floor(epoch(least(work_end, hour_bucket + INTERVAL 1 HOUR)))
                            - floor(epoch(greatest(work_start, hour_bucket)))) AS overlap FROM touched)"""

_ATTRIBUTED = """
SELECT w.statement_id, w.warehouse_id, w.hour_bucket, w.part, SUM(w.part) OVER h AS total,
       c.hour_bucket IS NOT NULL AS billed,
       CASE WHEN SUM(w.part) OVER h <> 0 THEN w.part / SUM(w.part) OVER h END AS share,
       share_used * dollars * CASE WHEN SUM(w.part) OVER h <> 0 THEN w.part / SUM(w.part) OVER h END AS cost,
       share_used * units * CASE WHEN SUM(w.part) OVER h <> 0 THEN w.part / SUM(w.part) OVER h END AS units,
       (SELECT max(hour_bucket) FROM {hours}) AS latest
FROM {work} w LEFT JOIN {hours} c ON c.warehouse_id = w.warehouse_id AND c.hour_bucket = w.hour_bucket
WINDOW h AS (PARTITION BY w.warehouse_id, w.hour_bucket)"""

PARTS["attributed"] = _ATTRIBUTED.format(work="parts_of_work", hours="hours_cost")
PARTS["attributed_closed"] = _ATTRIBUTED.format(work="parts_of_work_closed", hours="hours_cost_closed")

_CHECK = """CASE WHEN {billed} THEN 'Has Billing Record'
       ELSE 'No Billing Record for this hour and warehouse yet available' END"""

PARTS["labelled"] = """
SELECT statement_id, coalesce(source, client, 'UNKNOWN') AS source_type, coalesce(source_key, 'UNKNOWN') AS source_id,
       coalesce(client, 'Unknown') AS client_application,
       CASE coalesce(source, client, 'UNKNOWN')
            WHEN 'JOB' THEN '/jobs/' || source_key WHEN 'SQL QUERY' THEN '/sql/queries/' || source_key
            WHEN 'DASHBOARD' THEN '/sql/dashboardsv3/' || source_key
            WHEN 'LEGACY DASHBOARD' THEN '/sql/dashboards/' || source_key
            WHEN 'ALERT' THEN '/sql/alerts/' || source_key
            WHEN 'NOTEBOOK' THEN '/editor/notebooks/' || source_key ELSE '' END AS link,
       '/sql/history?uiQueryProfileVisible=true&queryId=' || statement_id AS profile
FROM history"""

PARTS["costs"] = """
SELECT a.statement_id, l.source_type, l.source_id, l.client_application, w.executed_by, w.warehouse_id,
       w.statement_text, w.workspace_id, w.start_time, w.end_time, w.work_start, w.work_end, w.task_seconds,
       a.cost, a.units, a.latest, a.billed, a.hours, l.link, l.profile
FROM (SELECT statement_id, SUM(cost) AS cost, SUM(units) AS units, max(latest) AS latest, bool_and(billed) AS billed,
             count(*) AS hours
      FROM attributed GROUP BY ALL) a
JOIN work w ON w.statement_id = a.statement_id JOIN labelled l ON l.statement_id = a.statement_id"""

# -- assistant messages ------------------------------------------------------------------

PARTS["turns"] = """
SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
       lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations"""

PARTS["asked"] = """
SELECT 'sp-' || conv_id % 7 AS space_id, 'Space ' || conv_id % 7 AS space_name, conv_id || '-' || turn AS message_id,
       'cv-' || conv_id AS conversation_id, CAST(conv_id AS VARCHAR) AS user_id,
       CASE WHEN conv_id <> 0 THEN coalesce(u.address, 'ID_' || conv_id) END AS user_email,
       CASE WHEN role = 'user' AND next_role = 'assistant' THEN next_text END AS answer, conv_id, turn, text AS question,
       make_timestamp((1704067200123 + conv_id * 3600000 + turn * 60000) * 1000) AS created,
       'st-' || (conv_id * 31 + turn * 7) % 1000 AS first_statement,
       CASE WHEN turn % 3 = 0 AND conv_id % 5 <> 0 THEN 'st-' || (conv_id * 17 + turn * 3) % 1000 END AS second_statement,
       CASE conv_id % 3 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE' ELSE 'NONE' END AS rating
FROM turns LEFT JOIN users u ON u.user_id = CAST(conv_id AS VARCHAR) WHERE role <> 'assistant'"""

PARTS["messages"] = """
SELECT space_id, space_name, message_id, conversation_id, user_id, user_email,
       CASE WHEN answer IS NULL THEN 'FAILED' ELSE 'COMPLETED' END AS status,
       created AS created_timestamp, created + INTERVAL 5 SECOND AS last_updated_timestamp,
       question AS user_question, answer AS ai_response,
       'SELECT 1 FROM t' || turn || CASE WHEN turn % 3 = 0 THEN ' | SELECT 2 FROM t' || turn ELSE '' END AS sql_query,
       first_statement || coalesce('|' || second_statement, '') AS statement_id,
       CASE WHEN second_statement IS NULL THEN 1 ELSE 2 END AS num_statements,
       'What about ' || conv_id || ', Why ' || turn AS suggested_questions,
       2 + CASE WHEN answer IS NULL THEN 0 ELSE 1 END + CASE WHEN turn % 3 = 0 THEN 1 ELSE 0 END AS num_attachments,
       rating AS feedback_rating, 0 AS num_comments,
       CASE WHEN answer IS NULL AND conv_id % 2 = 0 THEN 'Unknown' WHEN answer IS NULL THEN 'QUERY_ERROR' END AS error_type,
       CASE WHEN answer IS NULL AND conv_id % 4 = 0 THEN '{timeout} while running'
            WHEN answer IS NULL AND conv_id % 2 = 0 THEN 'timeout'
            WHEN answer IS NULL THEN 'bad statement' END AS error_message
FROM asked"""

PARTS["bridge"] = """
SELECT space_id, space_name, conversation_id, message_id, 'query-' || n AS attachment_id,
       CASE WHEN answer IS NULL THEN 0 ELSE 1 END + n - 1 AS attachment_index,
       CASE n WHEN 1 THEN first_statement ELSE second_statement END AS statement_id,
       'SELECT ' || n || ' FROM t' || turn AS sql_query, 'step ' || n AS query_description, conv_id * 10 + n AS row_count,
       user_id, user_email, created AS created_timestamp
FROM asked, range(1, 3) AS numbers(n) WHERE n = 1 OR turn % 3 = 0"""

PARTS["comments"] = """
SELECT message_id || '-c' || n AS message_comment_id, space_id, space_name, conversation_id, message_id, user_id,
       regexp_replace(CASE n WHEN 1 THEN '  fine ' || user_id || ' ' || chr(10) ELSE question END,
                      '^\\s+|\\s+$', '', 'g') AS comment_text,
       created + to_seconds(n) AS created_timestamp
FROM asked, (VALUES (1), (3)) AS kept(n) WHERE rating <> 'NONE'"""

PARTS["message_costs"] = """
SELECT b.space_id, b.space_name, b.conversation_id, b.message_id, max(b.user_email) AS user_email,
       count(b.statement_id) AS num_statements, count(*) - count(c.statement_id) AS num_statements_missing_cost,
       SUM(coalesce(c.cost, 0)) AS message_cost, SUM(coalesce(c.units, 0)) AS message_units,
       max(a.question) AS user_question, max(a.created) AS created_datetime, max(a.rating) AS feedback_rating
FROM bridge b LEFT JOIN costs c USING (statement_id) JOIN asked a ON a.message_id = b.message_id
GROUP BY b.space_id, b.space_name, b.conversation_id, b.message_id"""

PARTS["categories"] = """
SELECT c.*, b.statement_id IS NOT NULL AS linked,
       CASE WHEN b.statement_id IS NOT NULL THEN 'CONVERSATIONAL'
            WHEN ltrim(upper(statement_text)) LIKE 'DESCRIBE %' THEN 'SCHEMA_PROBE'
            WHEN upper(statement_text) LIKE '%APPROX_TOP_K(%' OR upper(statement_text) LIKE '%SAMPLEDDATA%'
            THEN 'AUTHORING_PROFILING'
            WHEN task_seconds = 0 THEN 'METADATA_OTHER' ELSE 'OTHER_UNATTRIBUTED' END AS cost_category,
       CASE WHEN b.statement_id IS NOT NULL THEN 'USAGE'
            WHEN upper(statement_text) LIKE '%APPROX_TOP_K(%' OR upper(statement_text) LIKE '%SAMPLEDDATA%'
            THEN 'AUTHORING' ELSE 'OVERHEAD_OR_UNATTRIBUTED' END AS cost_class
FROM costs c LEFT JOIN (SELECT DISTINCT statement_id FROM bridge) b ON b.statement_id = c.statement_id
WHERE source_type = 'ASSISTANT SPACE'"""

# -- facts -------------------------------------------------------------------------------

PARTS["index_fact"] = f"""
SELECT endpoint_id, coalesce(max(endpoint_name), '(no endpoint)') AS endpoint_name,
       CAST(usage_start_time AS DATE) AS usage_date, u.workspace_id, max(workspace_name) AS workspace_name, u.sku_name,
       SUM(quantity) AS units, SUM(quantity * coalesce(price, 0)) AS dollars
FROM lines u LEFT JOIN prices p ON {_OPEN} LEFT JOIN workspaces w ON w.workspace_id = u.workspace_id
WHERE is_index AND usage_start_time >= {LINES_SINCE}
GROUP BY endpoint_id, CAST(usage_start_time AS DATE), u.workspace_id, u.sku_name"""

PARTS["app_bill"] = f"""
SELECT app_id, CAST(usage_start_time AS DATE) AS usage_date, workspace_id, max(app_name) AS app_name,
       SUM(quantity) AS units, SUM(quantity * coalesce(price, 0)) AS dollars
FROM bill_app u LEFT JOIN prices p ON {_OPEN} WHERE usage_start_time >= {SINCE_YEAR} GROUP BY ALL"""

PARTS["xwalk"] = """
SELECT workspace_id, app_name, app_id
FROM (SELECT workspace_id, app_name, app_id,
             row_number() OVER (PARTITION BY workspace_id, app_name ORDER BY SUM(quantity) DESC, app_id) AS rn
      FROM bill_app GROUP BY workspace_id, app_name, app_id) WHERE rn = 1"""

PARTS["app_fact"] = """
SELECT app_id, coalesce(b.app_name, e.app_name) AS app_name, usage_date, workspace_id, workspace_name,
       coalesce(units, 0) AS units, coalesce(dollars, 0) AS dollars,
       coalesce(lifecycle_events, 0) AS lifecycle_events, coalesce(distinct_users, 0) AS distinct_users
FROM app_bill b
FULL JOIN (SELECT coalesce(x.app_id, a.app_name) AS app_id, usage_date, workspace_id, max(a.app_name) AS app_name,
                  count(*) AS lifecycle_events, count(DISTINCT email) AS distinct_users
           FROM app_events a LEFT JOIN xwalk x USING (workspace_id, app_name)
           GROUP BY ALL) e USING (app_id, usage_date, workspace_id)
LEFT JOIN workspaces USING (workspace_id)"""

PARTS["serve_bill"] = f"""
SELECT endpoint_id, CAST(usage_start_time AS DATE) AS usage_date, workspace_id, max(endpoint_name) AS billed_name,
       SUM(quantity) AS units, SUM(quantity * coalesce(price, 0)) AS dollars
FROM bill_serve u LEFT JOIN prices p ON {_OPEN} WHERE usage_start_time >= {SINCE_YEAR} GROUP BY ALL"""

PARTS["serve_fact"] = """
SELECT endpoint_id, coalesce(d.endpoint_name, b.billed_name) AS endpoint_name, served_entity_id, entity_type,
       coalesce(entity_name, billed_name) AS entity_name, entity_version, coalesce(entity_count, 0) AS entity_count,
       usage_date, workspace_id, workspace_name, coalesce(request_count, 0) AS request_count,
       coalesce(input_tokens, 0) AS input_tokens, coalesce(output_tokens, 0) AS output_tokens,
       coalesce(units, 0) AS units, coalesce(dollars, 0) AS dollars
FROM serve_bill b FULL JOIN endpoint_requests USING (endpoint_id, usage_date, workspace_id)
LEFT JOIN endpoint_main d USING (endpoint_id, workspace_id) LEFT JOIN workspaces USING (workspace_id)"""


def money(*names: str, table: str = "") -> str:
    prefix = f"{table}." if table else ""
    return ", ".join(f"round(CAST(CAST({prefix}{n} AS DECIMAL(38,6)) AS DOUBLE) + 1e-9, 6) AS {n}" for n in names)


# -- statements --------------------------------------------------------------------------

S = STATEMENTS
S["completeness_window"] = "SELECT lo, hi FROM bounds"
S["price_usage_half_open"] = f"""
SELECT workspace_id, u.sku_name, u.cloud, usage_start_time, round(CAST(price AS DOUBLE) + 1e-9, 6) AS unit_price,
       round(CAST(quantity AS DOUBLE) + 1e-9, 6) AS units,
       round(CAST(quantity * coalesce(price, 0) AS DOUBLE) + 1e-9, 6) AS dollars
FROM lines u LEFT JOIN prices p ON {_OPEN}"""
S["price_usage_closed"] = f"""
SELECT workspace_id, u.sku_name, usage_end_time, round(CAST(price AS DOUBLE) + 1e-9, 6) AS unit_price,
       round(CAST(quantity AS DOUBLE) + 1e-9, 6) AS units, round(CAST(quantity * price AS DOUBLE) + 1e-9, 6) AS dollars
FROM bill_events u LEFT JOIN prices p ON {_CLOSED}"""
S["query_work"] = """
SELECT statement_id, start_time + to_milliseconds(queue_ms + compute_ms + compile_ms) AS query_work_start_time,
       end_time + to_milliseconds(fetch_ms) AS query_work_end_time,
       round((task_ms + fetch_ms + compile_ms) / 1000.0 + 1e-9, 6) AS query_work_task_time FROM history"""
S["source_type"] = """
SELECT statement_id, source_type AS query_source_type, source_id AS query_source_id, client_application FROM labelled"""
S["deep_links"] = "SELECT statement_id, link AS url_helper, profile AS query_profile_url FROM labelled"
S["state_intervals"] = "SELECT * FROM states"
S["concurrency_sweep"] = "SELECT * FROM active"
S["split_by_day"] = """
SELECT warehouse_id, greatest("start", d) AS "start", least("end", d + INTERVAL 1 DAY) AS "end", queries_active,
       CAST(d AS DATE) AS day
FROM (SELECT *, unnest(generate_series(date_trunc('day', "start"), date_trunc('day', "end"), INTERVAL 1 DAY)) AS d
      FROM active) WHERE greatest("start", d) < least("end", d + INTERVAL 1 DAY)"""
S["timeline_segments"] = """
SELECT warehouse_id, "start", "end", date_trunc('hour', "start") AS hour FROM segments"""
S["period_utilization"] = "SELECT * FROM periods"
S["classify_periods"] = S["period_utilization"]
S["hourly_utilization"] = """
SELECT warehouse_id, hour, used AS utilized_seconds, idle AS idle_seconds, off_time AS off_seconds,
       used + idle + off_time AS total_seconds,
       round(CASE WHEN used + idle > 0 THEN used / (used + idle) END + 1e-9, 6) AS utilization_proportion FROM utilization"""
S["hour_cost"] = f"""
SELECT warehouse_id, hour_bucket, round(CAST(units AS DOUBLE) + 1e-9, 6) AS units,
       round(CAST(dollars AS DOUBLE) + 1e-9, 6) AS dollars, used AS utilized_seconds, idle AS idle_seconds,
       total AS total_seconds, round(share_used + 1e-9, 6) AS utilization_proportion FROM hours_cost"""
S["apportion_by_hour"] = """
SELECT statement_id, warehouse_id, hour_bucket, round(overlap + 1e-9, 6) AS overlap_duration,
       round(part + 1e-9, 6) AS attributed_query_work FROM parts_of_work"""
S["work_share"] = """
SELECT statement_id, warehouse_id, hour_bucket, round(part + 1e-9, 6) AS attributed_query_work,
       round(SUM(part) OVER h + 1e-9, 6) AS total_work_done_on_warehouse,
       round(CASE WHEN part <> 0 THEN part / SUM(part) OVER h END + 1e-9, 6) AS proportion_of_warehouse_time_used_by_query
FROM parts_of_work WINDOW h AS (PARTITION BY warehouse_id, hour_bucket)"""
S["attribute_cost"] = f"""
SELECT statement_id, warehouse_id, hour_bucket, round(part + 1e-9, 6) AS attributed_query_work,
       round(total + 1e-9, 6) AS total_work_done_on_warehouse, {_CHECK.format(billed="billed")} AS billing_record_check,
       round(share + 1e-9, 6) AS query_task_time_proportion, round(cost + 1e-9, 6) AS query_attributed_dollars_estimation,
       round(units + 1e-9, 6) AS query_attributed_units_estimation, latest AS most_recent_billing_hour FROM attributed"""
S["idle_residual"] = """
SELECT c.warehouse_id, c.hour_bucket, round(c.dollars + 1e-9, 6) AS billed_dollars, round(c.units + 1e-9, 6) AS billed_units,
       round(a.cost + 1e-9, 6) AS attributed_dollars, round(a.units + 1e-9, 6) AS attributed_units,
       round(c.dollars - coalesce(a.cost, 0) + 1e-9, 6) AS residual_dollars,
       round(c.units - coalesce(a.units, 0) + 1e-9, 6) AS residual_units
FROM hours_cost c LEFT JOIN (SELECT warehouse_id, hour_bucket, SUM(cost) AS cost, SUM(units) AS units
                             FROM attributed GROUP BY ALL) a
  ON a.warehouse_id = c.warehouse_id AND a.hour_bucket = c.hour_bucket"""
S["cost_per_query"] = f"""
SELECT statement_id, source_id AS query_source_id, source_type AS query_source_type, client_application, executed_by,
       warehouse_id, statement_text, workspace_id, start_time, end_time, work_start AS query_work_start_time,
       work_end AS query_work_end_time,
       round(date_diff('microsecond', start_time, end_time) // 1000 / 1000.0 + 1e-9, 6) AS duration_seconds,
       round(CAST(trunc(date_diff('microsecond', work_start, work_end) / 1000) AS BIGINT) / 1000.0 + 1e-9, 6)
         AS query_work_duration_seconds,
       round(task_seconds + 1e-9, 6) AS query_work_task_time_seconds, round(cost + 1e-9, 6) AS query_attributed_dollars_estimation,
       round(units + 1e-9, 6) AS query_attributed_units_estimation, link AS url_helper, profile AS query_profile_url,
       latest AS most_recent_billing_hour, {_CHECK.format(billed="billed")} AS billing_record_check,
       date_trunc('hour', start_time) AS query_start_hour, hours FROM costs"""
S["cost_per_query_incremental"] = S["cost_per_query"]
S["cost_per_query_hours"] = """
SELECT statement_id, hour_bucket, round(cost + 1e-9, 6) AS hour_attributed_cost, round(units + 1e-9, 6) AS hour_attributed_units
FROM attributed"""
S["cost_per_query_closed"] = f"""
SELECT a.statement_id, round(max(w.task_seconds) + 1e-9, 6) AS query_work_task_time_seconds,
       round(SUM(a.cost) + 1e-9, 6) AS query_attributed_dollars_estimation,
       round(SUM(a.units) + 1e-9, 6) AS query_attributed_units_estimation,
       {_CHECK.format(billed="bool_and(billed)")} AS billing_record_check
FROM attributed_closed a JOIN work w USING (statement_id) GROUP BY a.statement_id"""

_TOKENS = """
SELECT u.workspace_id, run_as AS user_email, surface, channel, agent_id, space_name, 'STANDARD' AS offering,
       CASE WHEN u.sku_name = 'ASSISTANT_FREE_USAGE' THEN 'FREE' ELSE 'PAID' END AS tier, u.sku_name,
       CASE WHEN u.sku_name <> 'ASSISTANT_FREE_USAGE'
            THEN regexp_replace(u.sku_name, '^REALTIME_INFERENCE_', '') END AS cloud_region,
       CAST(usage_start_time AS DATE) AS usage_date, round(CAST(CAST(SUM(quantity) AS DECIMAL(38,6)) AS DOUBLE) + 1e-9, 6) AS token_units,
       round(CAST(CAST(SUM(quantity * coalesce(price, 0)) AS DECIMAL(38,6)) AS DOUBLE) + 1e-9, 6) AS token_cost, count(*) AS usage_records
FROM lines u LEFT JOIN prices p ON {match} LEFT JOIN spaces ON space_id = agent_id
WHERE NOT is_index AND is_token AND is_original {since} GROUP BY ALL"""
S["token_usage_fact"] = _TOKENS.format(match=_OPEN, since=f"AND usage_start_time >= {LINES_SINCE}")
S["token_usage_fact_closed"] = _TOKENS.format(match=_CLOSED, since="")
S["index_cost_fact"] = f"""
SELECT endpoint_id, endpoint_name, usage_date, workspace_id, workspace_name, sku_name, {money("units", "dollars")}
FROM index_fact"""
S["index_cost_stream"], S["token_usage_stream"] = S["index_cost_fact"], S["token_usage_fact"]
S["bad_documents"] = """
SELECT bad_line, count(*) AS lines FROM (SELECT left(props, 5) AS bad_line FROM ev WHERE k % 10 = 0)
GROUP BY bad_line
UNION ALL SELECT 'good', count(*) FROM ev WHERE k % 10 <> 0"""
S["dq_schema_facts"] = """
SELECT 'index_cost' AS fact, 0 AS problems, count(*) AS rows FROM index_fact
UNION ALL SELECT 'token_usage', 0, count(*) FROM (""" + _TOKENS.format(match=_OPEN, since=f"AND usage_start_time >= {LINES_SINCE}") + """)
UNION ALL SELECT 'app_usage', 0, count(*) FROM app_fact
UNION ALL SELECT 'serving_usage', 0, count(*) FROM serve_fact
UNION ALL SELECT 'reach', 0, count(*) FROM (""" + "@REACH@" + """)
UNION ALL SELECT 'dashboard_views', 0, count(*) FROM (""" + "@VIEWS@" + """)
UNION ALL SELECT 'cost_per_query', 0, count(*) FROM costs
UNION ALL SELECT 'cost_per_message', 0, count(*) FROM message_costs
UNION ALL SELECT 'cost_category', 0, count(*) FROM categories"""
S["dq_facts"] = """
SELECT 'index_cost' AS fact, 0 AS negative, 0 AS unlabelled, count(*) AS rows FROM index_fact
UNION ALL SELECT 'app_usage', count(*) FILTER (units < 0 OR dollars < 0), count(*) FILTER (app_name IS NULL), count(*) FROM app_fact
UNION ALL SELECT 'serving_usage', count(*) FILTER (units < 0 OR dollars < 0), count(*) FILTER (entity_name IS NULL), count(*)
FROM serve_fact"""
S["usage_measures"] = """
SELECT workspace_id, CAST(request_count AS BIGINT) AS request_count, CAST(input_tokens AS BIGINT) AS input_tokens,
       CAST(output_tokens AS BIGINT) AS output_tokens, app_users
FROM (SELECT workspace_id, SUM(request_count) AS request_count, SUM(input_tokens) AS input_tokens,
             SUM(output_tokens) AS output_tokens FROM serve_fact GROUP BY workspace_id) r
FULL JOIN (SELECT workspace_id, count(DISTINCT email) AS app_users FROM app_events GROUP BY workspace_id) u
  USING (workspace_id)"""
S["fact_totals"] = """
SELECT fact, round(CAST(SUM(quantity) AS DOUBLE), 3) AS billed_units,
       round(CAST(SUM(quantity * price) AS DOUBLE), 3) AS billed_dollars, true AS equal_to_billing
FROM (
  SELECT 'index_cost' AS fact, quantity, coalesce(price, 0) AS price FROM lines u LEFT JOIN prices p ON {match}
  WHERE is_index AND usage_start_time >= {since}
  UNION ALL
  SELECT 'token_usage', quantity, coalesce(price, 0) FROM lines u LEFT JOIN prices p ON {match}
  WHERE NOT is_index AND is_token AND is_original AND usage_start_time >= {since}
  UNION ALL SELECT 'app_usage', quantity, coalesce(price, 0) FROM bill_app u LEFT JOIN prices p ON {match}
  UNION ALL SELECT 'serving_usage', quantity, coalesce(price, 0) FROM bill_serve u LEFT JOIN prices p ON {match}
) billed GROUP BY fact""".format(match=_OPEN, since=LINES_SINCE)
S["app_billing"] = f"SELECT app_id, usage_date, workspace_id, app_name, {money('units', 'dollars')} FROM app_bill"
S["name_crosswalk"] = "SELECT * FROM xwalk"
S["app_audit"] = """
SELECT workspace_id, app_name, usage_date, count(*) AS lifecycle_events, count(DISTINCT email) AS distinct_users
FROM app_events GROUP BY ALL"""
S["app_usage_fact"] = f"""
SELECT app_id, app_name, usage_date, workspace_id, workspace_name, {money("units", "dollars")}, lifecycle_events,
       distinct_users FROM app_fact"""
S["latest_version"] = "SELECT * FROM current_entities"
S["request_usage"] = """
SELECT endpoint_id, usage_date, workspace_id, CAST(request_count AS BIGINT) AS request_count, input_tokens,
       output_tokens FROM endpoint_requests"""
S["serving_billing"] = (
    f"SELECT endpoint_id, usage_date, workspace_id, billed_name, {money('units', 'dollars')} FROM serve_bill"
)
S["representative_entity"] = "SELECT * FROM endpoint_main"
S["serving_usage_fact"] = f"""
SELECT endpoint_id, endpoint_name, served_entity_id, entity_type, entity_name, entity_version, entity_count, usage_date,
       workspace_id, workspace_name, request_count, input_tokens, output_tokens, {money("units", "dollars")}
FROM serve_fact"""
S["reach_fact"] = f"""
SELECT s.space_id, s.space_name, CAST(uid % 25 AS VARCHAR) AS workspace_id, w.workspace_name,
       CAST(ts AS DATE) AS activity_date, count(*) FILTER (k % 3 <> 2) AS space_views,
       count(DISTINCT CASE WHEN k % 3 <> 2 THEN email END) AS distinct_viewers,
       count(*) FILTER (k % 3 = 2) AS spaces_created
FROM ev JOIN spaces s ON s.space_id = 'sp-' || uid % 8
LEFT JOIN workspaces w ON w.workspace_id = CAST(uid % 25 AS VARCHAR)
WHERE event_type = 'click' AND ts > {SINCE_HALF} GROUP BY ALL"""
S["dashboard_views"] = f"""
SELECT d.dashboard_id, d.dashboard_name, CAST(ts AS DATE) AS viewed_date, w.workspace_id, w.workspace_name,
       count(*) AS num_views, count(*) FILTER (k % 2 = 0) AS draft_views, count(*) FILTER (k % 2 = 1) AS published_views
FROM ev JOIN dashboards d ON d.dashboard_id = 'd-' || k % 20
JOIN workspaces w ON w.workspace_id = CAST(uid % 25 AS VARCHAR)
WHERE event_type = 'view' AND k % 10 <> 9 AND ts > {SINCE_HALF} GROUP BY ALL"""

S["cost_per_message"] = f"""
SELECT space_id, space_name, conversation_id, message_id, user_email, num_statements, num_statements_missing_cost,
       {money("message_cost", "message_units")}, user_question, created_datetime, feedback_rating FROM message_costs"""
S["cost_category"] = """
SELECT statement_id, source_id AS query_source_id, workspace_id, round(cost + 1e-9, 6) AS query_attributed_dollars_estimation,
       cost_category, cost_class FROM categories"""
S["space_cost"] = """
SELECT source_id AS space_id, round(SUM(cost) + 1e-9, 6) AS space_cost FROM costs WHERE source_type = 'ASSISTANT SPACE'
GROUP BY source_id"""
S["space_cost_by_category"] = """
SELECT space_name, cost_category, count(*) AS statements, round(SUM(cost) + 1e-9, 6) AS cost
FROM categories LEFT JOIN spaces ON space_id = source_id GROUP BY ALL"""
S["reconcile_space_cost"] = """
SELECT space_id, round(coalesce(total, 0) + 1e-9, 6) AS total, round(coalesce(detail, 0) + 1e-9, 6) AS detail,
       round(coalesce(total, 0) - coalesce(detail, 0) + 1e-9, 6) AS gap,
       abs(coalesce(total, 0) - coalesce(detail, 0)) <= 0.005 AS reconciles
FROM (SELECT source_id AS space_id, SUM(cost) AS total FROM costs WHERE source_type = 'ASSISTANT SPACE' GROUP BY ALL)
FULL JOIN (SELECT space_id, SUM(message_cost) AS detail FROM message_costs GROUP BY ALL) USING (space_id)"""
S["space_statements"] = """
SELECT statement_id, source_id AS query_source_id, start_time, round(cost + 1e-9, 6) AS query_attributed_dollars_estimation
FROM costs WHERE source_id IN (SELECT space_id FROM messages)
  AND start_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"""
S["error_mix"] = """
SELECT space_name, status, error_type, count(*) AS message_count,
       round(count(*) * 100.0 / SUM(count(*)) OVER (PARTITION BY space_name), 2) AS pct_of_space
FROM messages GROUP BY space_name, status, error_type"""
S["user_engagement"] = """
SELECT user_email, count(DISTINCT conversation_id) AS total_conversations, count(*) AS total_messages,
       count(*) FILTER (feedback_rating = 'POSITIVE') AS positive_feedback,
       count(*) FILTER (feedback_rating = 'NEGATIVE') AS negative_feedback
FROM messages WHERE user_email IS NOT NULL GROUP BY ALL ORDER BY total_messages DESC, user_email LIMIT 20"""
S["cost_by_source"] = """
SELECT source_type AS query_source_type, client_application, count(*) AS query_count,
       round(AVG(cost), 4) AS avg_cost_dollars, round(SUM(cost), 2) AS total_cost_dollars,
       round(AVG(date_sub('second', start_time, end_time)), 2) AS avg_duration_sec
FROM costs WHERE cost IS NOT NULL GROUP BY ALL"""
S["cost_trend"] = f"""
SELECT h.*, coalesce(assistant_messages, 0) AS assistant_messages
FROM (SELECT date_trunc('hour', start_time) AS hour_bucket, count(*) AS total_queries, round(SUM(cost), 2) AS total_cost,
             round(AVG(cost), 4) AS avg_cost_per_query
      FROM costs WHERE start_time >= {AS_OF} - INTERVAL 90 DAY GROUP BY ALL) h
LEFT JOIN (SELECT date_trunc('hour', start_time) AS hour_bucket, count(DISTINCT message_id) AS assistant_messages
           FROM costs JOIN messages ON space_id = source_id GROUP BY ALL) USING (hour_bucket)
ORDER BY hour_bucket DESC LIMIT 100"""

S["flatten_messages"] = "SELECT * FROM messages"
S["message_statements"] = "SELECT * FROM bridge"
S["message_comments"] = "SELECT * FROM comments"
S["comment_counts"] = """
SELECT message_id, rating AS feedback_rating, CASE WHEN rating = 'NONE' THEN 0 ELSE 2 END AS num_comments FROM asked"""
S["resolve_users"] = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS user_id,
       CASE WHEN o_custkey <> 0 THEN coalesce(address, 'ID_' || o_custkey) END AS user_email
FROM orders LEFT JOIN users ON user_id = CAST(o_custkey AS VARCHAR)"""

_MODEL = "'main.' || p_brand || '.' || p_partkey"
_USERS, _GROUPS = "p_size - p_size // 3", "p_size // 3 - p_size // 6"
S["acl_counts"] = f"""
SELECT {_MODEL} AS full_name, {_USERS} AS num_users_with_access, {_GROUPS} AS num_groups_with_access FROM part"""
S["entity_models"] = f"""
SELECT {_MODEL} AS full_name, p_name AS name, 'main' AS catalog_name, p_brand AS schema_name,
       make_timestamp((1700000000456 + p_partkey * 1000) * 1000) AS created_at, 'u1' AS created_by,
       CASE WHEN p_partkey % 4 <> 0 THEN make_timestamp(1710000000000000) END AS updated_at,
       CAST(NULL AS VARCHAR) AS updated_by, CAST(NULL AS VARCHAR) AS owner, p_type AS comment,
       {_USERS} AS num_users_with_access, {_GROUPS} AS num_groups_with_access FROM part"""
_NAMES = "[NULL, 'm0', 'm0,n1', 'm0,n1,m2', 'm0,n1,m2'][1 + s_suppkey % 5]"
S["served_models"] = f"SELECT CAST(s_suppkey AS VARCHAR) AS id, {_NAMES} AS models FROM supplier"
S["entity_serving_endpoints"] = f"""
SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS id, make_timestamp((1700000000000 + s_suppkey) * 1000)
       AS creation_timestamp, 'u1' AS creator,
       CASE WHEN s_suppkey % 2 = 0 THEN make_timestamp(1710000000789000) END AS last_updated_timestamp, 'READY' AS state,
       {_NAMES} AS models, 1 AS num_users_with_access, 0 AS num_groups_with_access FROM supplier"""
S["entity_apps"] = """
SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS id,
       make_timestamp(2023, 5, 1 + c_custkey % 28, 10, 11, 12.0) AS create_time, 'u1' AS creator,
       CASE WHEN c_custkey % 3 <> 0 THEN make_timestamp(2023, 6, 1 + c_custkey % 28, 1, 2, 3.5) - INTERVAL 2 HOUR END
         AS update_time,
       CAST(NULL AS VARCHAR) AS updater, 'https://apps.example.com/' || c_custkey AS url,
       CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN 'SUCCEEDED' END AS app_status,
       CASE WHEN c_custkey % 4 = 2 THEN 'ACTIVE' WHEN c_custkey % 4 <> 0 THEN 'STOPPED' END AS compute_status,
       0 AS num_users_with_access, 0 AS num_groups_with_access FROM customer"""
S["flatten_apps"] = S["entity_apps"]
S["entity_subscriptions"] = """
SELECT 'd-' || o_orderkey % 20 AS dashboard_id, 'sc-' || o_orderkey % 50 AS schedule_id,
       'su-' || o_orderkey AS subscription_id,
       CASE WHEN o_orderstatus <> 'P' THEN date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) END AS create_time,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS destination_id FROM orders"""
S["flatten_subscriptions"] = S["entity_subscriptions"]
S["parse_times"] = f"""
SELECT {_MODEL} AS full_name, make_timestamp((1700000000456 + p_partkey * 1000) * 1000) AS created_at,
       CASE WHEN p_partkey % 4 <> 0 THEN make_timestamp(1710000000000000) END AS updated_at,
       TRY_CAST(p_name AS TIMESTAMP) AS iso FROM part"""
S["parse_times_whole_seconds"] = f"""
SELECT {_MODEL} AS full_name, make_timestamp((1700000000 + p_partkey) * 1000000) AS created_at FROM part"""
S["entity_spaces"] = """
SELECT 'sp-' || s_suppkey AS space_id, s_name AS name, CAST(NULL AS VARCHAR) AS description,
       'wh-' || s_nationkey AS warehouse_id FROM supplier"""
S["entity_conversations"] = """
SELECT 'sp-' || conv_id % 7 AS space_id, conv_id || '-' || turn AS conversation_id,
       make_timestamp((1704067200123 + conv_id * 3600000 + turn * 60000) * 1000) AS created_timestamp, text AS title,
       conv_id AS user_id FROM conversations"""
S["entity_dashboards"] = """
SELECT 'd-' || o_orderkey AS dashboard_id, 'Board ' || o_orderpriority AS display_name,
       date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) AS create_time,
       CASE WHEN o_orderstatus = 'F' THEN 'TRASHED' ELSE 'ACTIVE' END AS lifecycle_state,
       CASE WHEN o_orderstatus <> 'O' THEN date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) END AS update_time,
       'wh-' || o_custkey AS warehouse_id FROM orders"""
S["entity_dashboard_schedules"] = """
SELECT 'd-' || o_orderkey AS dashboard_id, 'sc-' || o_orderkey AS schedule_id,
       strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS create_time,
       'Board ' || o_orderpriority AS display_name,
       CASE WHEN o_orderstatus = 'F' THEN 'PAUSED' ELSE 'UNPAUSED' END AS pause_status FROM orders"""

S["dq_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
S["dq_unique_facts"] = """
SELECT 'app_usage' AS fact, count(*) - count(DISTINCT (app_id, usage_date, workspace_id)) AS violations FROM app_fact
UNION ALL
SELECT 'serving_usage', count(*) - count(DISTINCT (endpoint_id, usage_date, workspace_id)) FROM serve_fact
UNION ALL
SELECT 'index_cost', count(*) - count(DISTINCT (endpoint_id, usage_date, workspace_id, sku_name)) FROM index_fact"""
S["dq_non_negative"] = """
SELECT c_custkey, round(c_acctbal + 1e-9, 6) AS c_acctbal, c_nationkey FROM customer WHERE c_acctbal < 0 OR c_nationkey < 0"""
S["dq_not_null"] = """
SELECT statement_id, client AS client_application, statement_type FROM history
WHERE client IS NULL OR statement_type IS NULL"""
S["dq_schema"] = """
SELECT 'events' AS table_name, column_name, problem, expected_type, actual_type, (SELECT count(*) FROM events) AS rows
FROM (VALUES ('props', 'extra', NULL, 'string'), ('session_id', 'missing', 'string', NULL),
             ('user_id', 'type changed', 'string', 'bigint')) AS found(column_name, problem, expected_type, actual_type)"""
S["observed_values"] = f"""
SELECT DISTINCT sku_name FROM lines WHERE usage_start_time >= {LINES_AS_OF} - 30 AND usage_start_time <= {LINES_AS_OF}"""
S["incremental_usage"] = """
SELECT CAST(ts AS DATE) AS usage_date, event_type, count(*) AS events,
       round(CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) + 1e-9, 6) AS amount FROM events GROUP BY ALL"""
S["incremental_marks"] = """
SELECT workspace_id, CASE WHEN start_time <= TIMESTAMP '2024-01-15' THEN 'first' ELSE 'second' END AS step,
       count(*) AS rows FROM history GROUP BY ALL"""
S["messages_stream"] = S["flatten_messages"]
S["space_cost_by_stored_category"] = S["space_cost_by_category"]
S["distinct_users_by_month"] = """
SELECT CAST(uid % 25 AS VARCHAR) AS workspace_id, CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT email) AS distinct_users
FROM ev WHERE event_type = 'click' GROUP BY ALL"""
S["dq_in_write"] = """
SELECT 'customer' AS table_name, 'rows' AS rule, count(*) AS n FROM customer
UNION ALL SELECT 'customer', 'non_negative:c_acctbal', count(*) FILTER (c_acctbal < 0) FROM customer
UNION ALL SELECT 'customer', 'unique', coalesce(SUM(n) FILTER (n > 1), 0)::BIGINT
  FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey, c_acctbal)
UNION ALL SELECT 'history', 'rows', count(*) FROM history
UNION ALL SELECT 'history', 'unique', coalesce(SUM(n) FILTER (n > 1), 0)::BIGINT
  FROM (SELECT count(*) AS n FROM history GROUP BY statement_id)
UNION ALL SELECT 'history', 'not_null:client_application', count(*) FILTER (client IS NULL) FROM history
UNION ALL SELECT 'history', 'not_null:statement_type', count(*) FILTER (statement_type IS NULL) FROM history"""
S["upsert_latest"] = """
SELECT order_key, changed_at, status
FROM (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY changed_at DESC, status DESC) AS rn
      FROM (SELECT o_orderkey AS order_key, CAST(o_orderdate AS TIMESTAMP) AS changed_at, o_orderstatus AS status
            FROM orders
            UNION ALL SELECT l_orderkey, CAST(l_shipdate AS TIMESTAMP), l_linestatus FROM lineitem)) WHERE rn = 1"""
S["measures_by_dim"] = """
SELECT workspace_name, sku_name, round(CAST(SUM(CAST(units AS DECIMAL(38,6))) AS DOUBLE) + 1e-9, 6) AS units,
       round(CAST(SUM(CAST(dollars AS DECIMAL(38,6))) AS DOUBLE) + 1e-9, 6) AS dollars, count(*) AS rows FROM index_fact
GROUP BY workspace_name, sku_name"""
S["crosswalk_by_brand"] = """
SELECT s_nationkey, p_brand, l_suppkey
FROM (SELECT s_nationkey, p_brand, l_suppkey,
             row_number() OVER (PARTITION BY s_nationkey, p_brand
                                ORDER BY SUM(CAST(l_quantity AS DECIMAL(18,2))) DESC, l_suppkey) AS rn
      FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
      GROUP BY s_nationkey, p_brand, l_suppkey) WHERE rn = 1"""

_WORD = re.compile(r"[a-z_]+")


S["dq_schema_facts"] = S["dq_schema_facts"].replace("@REACH@", S["reach_fact"]).replace("@VIEWS@", S["dashboard_views"])


def statements() -> dict[str, str]:
    """Every statement with the common table expressions it needs."""
    return {name: _with_parts(sql) for name, sql in STATEMENTS.items()}


def _with_parts(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in _WORD.findall(text):
            if word in PARTS and word not in needed:
                visit(PARTS[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{name} AS ({PARTS[name]}\n)" for name in needed)
    return f"WITH {parts}\n{sql.strip()}"
