"""Dirty views over the test tables, in SQL common to Spark and DuckDB.

The tables hold almost no dirt, so these views inject it by rule: missing and
repeated keys, orphans, malformed lines, junk cells and drifting batches.  Row
conditions below leave rows out of one side or repeat them on purpose; the
missing and repeated rows are what the checks must find.  ``{name}`` marks a base
table.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

# pos bigint, id string, email string, age string
VIEWS["v_dirty_customer"] = r"""
SELECT c_custkey AS pos,
  CASE WHEN c_custkey % 37 = 0 THEN '' WHEN c_custkey % 50 = 1 THEN cast(c_custkey - 1 AS string) ELSE cast(c_custkey AS string) END AS id,
  CASE WHEN c_custkey % 41 = 0 THEN 'bad-email' WHEN c_custkey % 43 = 0 THEN '   ' WHEN c_custkey % 47 = 0 THEN NULL
       ELSE 'u' || cast(c_custkey AS string) || '@x' || cast(c_nationkey AS string) || '.com' END AS email,
  CASE WHEN c_custkey % 29 = 0 THEN '212' WHEN c_custkey % 31 = 0 THEN 'abc' WHEN c_custkey % 53 = 0 THEN '' WHEN c_custkey % 59 = 0 THEN 'nan'
       WHEN c_custkey % 61 = 0 THEN '1_0' WHEN c_custkey % 67 = 0 THEN '1d' ELSE ' ' || cast(c_custkey % 100 AS string) || ' ' END AS age
FROM {customer}
"""

# pos bigint, claim_id string, member_id string, amount string, status string
VIEWS["v_source"] = r"""
SELECT o_orderkey AS pos, cast(o_orderkey AS string) AS claim_id, cast(o_custkey AS string) AS member_id,
  cast(cast(round(o_totalprice * 100) AS bigint) AS string) AS amount, o_orderstatus AS status FROM {orders}
UNION ALL
SELECT o_orderkey + 1000000000000000, cast(o_orderkey AS string), cast(o_custkey AS string), cast(cast(round(o_totalprice * 100) AS bigint) AS string), 'X'
FROM {orders} WHERE o_orderkey % 113 = 0
"""

# pos bigint, claim_id string, member_id string, amount string, status string
VIEWS["v_target"] = r"""
SELECT o_orderkey AS pos, cast(o_orderkey AS string) || ' ' AS claim_id, cast(o_custkey AS string) AS member_id,
  cast(cast(round(o_totalprice * 100) AS bigint) + CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS string) AS amount,
  CASE WHEN o_orderkey % 17 = 0 THEN 'Z' WHEN o_orderkey % 19 = 0 THEN ' ' || o_orderstatus ELSE o_orderstatus END AS status
FROM {orders} WHERE o_orderkey % 101 <> 0
UNION ALL
SELECT o_orderkey + 1000000000000000, cast(o_orderkey + 1000000000000000 AS string), cast(o_custkey AS string), '0', o_orderstatus FROM {orders} WHERE o_orderkey % 211 = 0
"""

# pos bigint, line string
VIEWS["v_log_lines"] = r"""
SELECT event_id AS pos, CASE WHEN event_id % 83 = 0 THEN 'this line is corrupted' WHEN event_id % 97 = 0 THEN '   ' ELSE
  '10.0.' || cast(user_id % 7 AS string) || '.' || cast(user_id % 250 AS string) || ' - - [' ||
  lpad(cast(1 + cast(floor(event_id / 1440) AS bigint) % 28 AS string), 2, '0') || '/Jul/2026:' || lpad(cast(cast(floor(event_id / 60) AS bigint) % 24 AS string), 2, '0') ||
  ':' || lpad(cast(event_id % 60 AS string), 2, '0') || ':07] "' || CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END || ' /api/' || event_type || '/' || cast(user_id % 3 AS string) ||
  ' HTTP/1.1" ' || CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '500' WHEN event_type = 'error' THEN '404' ELSE '200' END || ' ' ||
  CASE WHEN event_type = 'error' THEN '-' ELSE cast(event_id % 5000 AS string) END || ' ' || cast((event_id * 37) % 900 AS string) END AS line
FROM {events}
"""

# patient_id bigint, name string, state string
VIEWS["v_patients"] = r"""
SELECT c_custkey AS patient_id, c_name AS name, n_name AS state FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

# claim_id bigint, patient_id bigint, service string, amount double, claim_date string
VIEWS["v_claims"] = r"""
SELECT o_orderkey AS claim_id, CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN o_custkey + 1000000000000000 ELSE o_custkey END AS patient_id,
  o_orderpriority AS service, CASE WHEN o_orderkey % 71 = 0 THEN -40.0E0 WHEN o_orderkey % 73 = 0 THEN 0.0E0 ELSE o_totalprice END AS amount, substr(cast(o_orderdate AS string), 1, 10) AS claim_date
FROM {orders} WHERE o_custkey % 10 <> 7
UNION ALL
SELECT o_orderkey + 1000000000000000, o_custkey, o_orderpriority, o_totalprice, substr(cast(o_orderdate AS string), 1, 10) FROM {orders} WHERE o_orderkey % 103 = 0 AND o_custkey % 10 <> 7
"""

# lineno bigint, member_id string, name string, age string, monthly_premium string
VIEWS["v_csv_cells"] = r"""
SELECT c_custkey + 2 AS lineno, CASE WHEN c_custkey % 31 = 0 THEN ' ' ELSE cast(c_custkey AS string) END AS member_id, ' ' || c_name || ' ' AS name,
  CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN NULL ELSE cast(c_custkey % 90 AS string) END AS age,
  CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 23 = 0 THEN 'n/k' WHEN c_custkey % 2 = 0 THEN cast(c_custkey % 300 AS string) ELSE cast(c_custkey % 300 AS string) || '.50' END AS monthly_premium
FROM {customer}
"""

# pos bigint, line string
VIEWS["v_forecast_lines"] = r"""
SELECT c_custkey AS pos, CASE WHEN c_custkey % 29 = 0 THEN 'Bad Row 999/xx/z 12/9/q' WHEN c_custkey % 31 = 0 THEN '  ' WHEN c_custkey % 37 = 0 THEN '80/90/s 80/70/s'
  ELSE 'City  ' || cast(c_custkey AS string) || ' ' || cast(60 + (c_custkey * 7) % 55 AS string) || '/' || cast(40 + (c_custkey * 3) % 25 AS string) || '/' ||
  CASE c_custkey % 4 WHEN 0 THEN 's' WHEN 1 THEN 'PC' WHEN 2 THEN 't' ELSE 'zz' END || ' ' || cast(60 + (c_custkey * 11) % 55 AS string) || '/' || cast(45 + c_custkey % 20 AS string) || '/sh' END AS line
FROM {customer}
"""

# id bigint, y_true string, y_pred string
VIEWS["v_pred"] = r"""
SELECT doc_id AS id, lang AS y_true, CASE WHEN doc_id % 7 = 0 THEN 'en' WHEN doc_id % 11 = 0 THEN 'it' WHEN lang = 'es' THEN 'fr' ELSE lang END AS y_pred FROM {documents}
"""

# pos bigint, segment string
VIEWS["v_segment"] = r"""
SELECT c_custkey AS pos, CASE c_custkey % 23 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NA' WHEN 3 THEN 'N/A' WHEN 4 THEN 'null' WHEN 5 THEN 'NULL' WHEN 6 THEN '-' WHEN 7 THEN '?' WHEN 8 THEN ' NA ' ELSE c_mktsegment END AS segment FROM {customer}
"""

# doc_id bigint, text string
VIEWS["v_paragraphs"] = r"""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || ' ' || chr(10)) ELSE text END AS text FROM {documents}
"""

# batch bigint, ts timestamp_ntz, is_incident boolean, account_length string, temp_f string, sales string, churn string
VIEWS["v_drift"] = r"""
SELECT event_id % 7 AS batch, ts, event_id % 7 IN (3, 4, 6) AS is_incident,
  CASE WHEN event_id % 7 = 2 AND event_id % 1001 = 9 THEN 'N/A' ELSE cast(1 + user_id % 240 AS string) END AS account_length,
  cast(cast(CASE WHEN event_id % 7 = 3 THEN ((60 + (event_id * 13) % 2400 * 0.01) - 32) * 5 / 9 ELSE 60 + (event_id * 13) % 2400 * 0.01 END AS decimal(9, 2)) AS string) AS temp_f,
  CASE WHEN event_id % 7 IN (5, 6) THEN '0' ELSE cast((event_id * 17) % 41 AS string) END AS sales,
  CASE WHEN event_id % 7 = 4 AND event_id % 2 = 0 THEN 'true' WHEN event_id % 7 = 4 THEN 'false' ELSE cast(event_id % 2 AS string) END AS churn
FROM {events}
"""

# series bigint, i bigint, clean double, noisy double
VIEWS["v_signal"] = r"""
SELECT user_id AS series, event_id AS i, cast(10 + event_id % 12 AS double) AS clean,
  cast(10 + event_id % 12 AS double) + cast((event_id * 7919) % 13 - 6 AS double) / 10 + CASE WHEN event_id % 17 = 0 THEN 6.0E0 ELSE 0.0E0 END AS noisy FROM {events}
"""

# series bigint, i bigint, v double (values missing, infinite and not a number now and then)
VIEWS["v_spikes"] = r"""
SELECT event_id % 2 AS series, event_id AS i, CASE WHEN event_id % 4999 = 7 THEN cast('Infinity' AS double) WHEN event_id % 7919 = 5 THEN cast('NaN' AS double)
  WHEN event_id % 13 = 4 THEN NULL ELSE cast((event_id * 7919) % 1009 - 504 AS double) / 8 END AS v FROM {events}
"""

# id bigint, label int, f0..f7 bigint
VIEWS["v_bits"] = r"""
SELECT doc_id AS id, quality AS label, h % 2 AS f0, cast(floor(h / 2) AS bigint) % 2 AS f1, cast(floor(h / 4) AS bigint) % 2 AS f2, cast(floor(h / 8) AS bigint) % 2 AS f3,
  cast(floor(h / 16) AS bigint) % 2 AS f4, cast(floor(h / 32) AS bigint) % 2 AS f5, cast(floor(h / 64) AS bigint) % 2 AS f6, cast(floor(h / 128) AS bigint) % 2 AS f7
FROM (SELECT l.doc_id, quality, (l.doc_id * 7919 + n_chars) % 256 AS h FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id) t
"""


def base_tables(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))
