"""The registered queries as plain SQL, written from the definition of each result."""

from __future__ import annotations

# -- shared building blocks ---------------------------------------------------------
# Payload times are whole milliseconds, cut off; epoch_ms() rounds in some versions.

_M = """
m AS (
  SELECT 'customer-' || user_id AS identifier, ts AS event_time,
         epoch_us(ts) // 1000 AS payload_ts_ms, value AS value_w, event_id AS arrival_seq
  FROM events
)"""

_PLACES = "(SELECT greatest(97, max(event_id) // 103) FROM events)"


def _late(seq: str) -> str:
    return f"({seq} + ({seq} * 7919) % {_PLACES}) * {_PLACES} + {seq} % {_PLACES}"


_SHUFFLED = (
    _M
    + f""",
s AS (
  SELECT identifier, event_time, payload_ts_ms, value_w, {_late('arrival_seq')} AS arrival_seq
  FROM m
),
timed AS (
  SELECT *, max(event_time) OVER (ORDER BY arrival_seq) AS stream_time,
         time_bucket(INTERVAL '6 hours', event_time) AS window_start
  FROM s
),
acc AS (
  SELECT * FROM timed
  WHERE window_start + INTERVAL '6 hours' + INTERVAL '1 hour' > stream_time
)"""
)

_LAST = """
last_value AS (
  SELECT window_start, identifier, payload_ts_ms, value_w FROM (
    SELECT *, row_number() OVER (
      PARTITION BY window_start, identifier ORDER BY payload_ts_ms DESC, arrival_seq DESC
    ) AS rn
    FROM (SELECT *, time_bucket(INTERVAL '6 hours', event_time) AS window_start FROM {source})
  ) WHERE rn = 1
)"""

_CUSTOMERS = """
customers AS (
  SELECT 'customer-' || c_custkey AS child, 'nation-' || c_nationkey AS parent FROM customer
)"""

_GROUPS = """
nations AS (
  SELECT 'nation-' || n_nationkey AS child, 'region-' || n_regionkey AS parent FROM nation
),
regions AS (SELECT 'region-' || r_regionkey AS child, 'root' AS parent FROM region)"""

_VERSION_2 = """
version2 AS (
  SELECT 'customer-' || c_custkey AS child,
         'nation-' || CASE WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25
                           ELSE c_nationkey END AS parent
  FROM customer WHERE c_custkey % 17 <> 0
)"""

_CHANGES = (
    _CUSTOMERS
    + ","
    + _VERSION_2
    + """,
diff AS (
  SELECT coalesce(a.child, b.child) AS child,
         CASE WHEN b.child IS NULL THEN 'delete' ELSE 'upsert' END AS op,
         a.parent AS old_parents, b.parent AS parents
  FROM customers a FULL JOIN version2 b ON a.child = b.child
  WHERE a.parent IS DISTINCT FROM b.parent
),
changes AS (
  SELECT child, 'upsert' AS op, CAST(NULL AS VARCHAR) AS old_parents, parent AS parents,
         CAST(0 AS BIGINT) AS arrival_seq, TIMESTAMP '2024-01-01 00:00:00' AS event_time
  FROM customers
  UNION ALL
  SELECT child, op, old_parents, parents, CAST(1 AS BIGINT),
         TIMESTAMP '2024-01-15 00:00:00'
  FROM diff
),
versions AS (
  SELECT * FROM (
    SELECT child, op, parents, event_time AS valid_from,
           lead(event_time) OVER (PARTITION BY child ORDER BY arrival_seq) AS valid_to
    FROM changes
  ) WHERE op = 'upsert'
),
current_set AS (
  SELECT child, parents FROM (
    SELECT *, row_number() OVER (PARTITION BY child ORDER BY arrival_seq DESC) AS rn
    FROM changes
  ) WHERE rn = 1 AND op = 'upsert'
)"""
)


def _rollup(name: str, values: str, edges: str) -> str:
    """A CTE with one level's results from one value per window and child."""
    return f"""
{name} AS (
  SELECT v.window_start, e.parent AS identifier, max(v.payload_ts_ms) AS timestamp_ms,
         count(*) AS count, sum(CAST(v.value_w AS DECIMAL(18, 2))) AS total
  FROM {values} v JOIN {edges} e ON v.identifier = e.child
  GROUP BY 1, 2
)"""


def _as_value(name: str) -> str:
    return (
        f"(SELECT window_start, identifier, timestamp_ms AS payload_ts_ms, "
        f"total AS value_w FROM {name})"
    )


def _final(*levels: str) -> str:
    union = " UNION ALL ".join(f"SELECT * FROM {level}" for level in levels)
    return f"""
SELECT window_start, identifier, timestamp_ms, count, CAST(total AS DOUBLE) AS sum_w,
       CAST(total AS DOUBLE) / count AS average_w
FROM ({union})"""


_THREE_LEVELS = ",".join(
    [
        _rollup("by_nation", "last_value", "customers"),
        _rollup("by_region", _as_value("by_nation"), "nations"),
        _rollup("by_root", _as_value("by_region"), "regions"),
    ]
)

_BALANCED_ROLLUP = (
    f"WITH {_M},{_LAST.format(source='m')},{_CUSTOMERS},{_GROUPS},{_THREE_LEVELS}"
    + _final("by_nation", "by_region", "by_root")
)

# Only windows the newest event time has passed.
_CLOSED = """
WHERE window_start + INTERVAL '6 hours' <= (SELECT max(event_time) FROM m)"""

# A group's own reading against the sum of its children: the newer counts, the sum on a tie.
_NEWER = """
{name} AS (
  SELECT coalesce(r.window_start, d.window_start) AS window_start,
         coalesce(r.identifier, d.identifier) AS identifier,
         CASE WHEN r.identifier IS NOT NULL
                   AND (d.identifier IS NULL OR r.timestamp_ms >= d.payload_ts_ms)
              THEN r.timestamp_ms ELSE d.payload_ts_ms END AS payload_ts_ms,
         CASE WHEN r.identifier IS NOT NULL
                   AND (d.identifier IS NULL OR r.timestamp_ms >= d.payload_ts_ms)
              THEN r.total ELSE CAST(d.value_w AS DECIMAL(18, 2)) END AS value_w
  FROM {results} r
  FULL JOIN (SELECT * FROM last_value WHERE identifier LIKE 'nation-%') d
    ON r.window_start = d.window_start AND r.identifier = d.identifier
)"""

_CLOSURE = """
closure AS (
  SELECT child AS leaf, parent AS ancestor, child AS via FROM customers
  UNION ALL
  SELECT c.child, n.parent, n.child FROM customers c JOIN nations n ON c.parent = n.child
  UNION ALL
  SELECT c.child, r.parent, r.child
  FROM customers c JOIN nations n ON c.parent = n.child JOIN regions r ON n.parent = r.child
)"""

# For every accepted reading and group above it: the last value of each sensor of the
# group among the readings that had arrived by then.
_CHANGELOG = """
pairs AS (
  SELECT u.window_start, a.ancestor AS identifier, u.arrival_seq, u.stream_time,
         v.identifier AS sensor, b.via, v.payload_ts_ms, v.value_w, v.event_time,
         row_number() OVER (
           PARTITION BY u.arrival_seq, a.ancestor, v.identifier
           ORDER BY v.payload_ts_ms DESC, v.arrival_seq DESC) AS rn
  FROM acc u
  JOIN closure a ON u.identifier = a.leaf
  JOIN acc v ON v.window_start = u.window_start AND v.arrival_seq <= u.arrival_seq
  JOIN closure b ON b.leaf = v.identifier AND b.ancestor = a.ancestor
),
log AS (
  SELECT window_start, identifier, arrival_seq, stream_time,
         max(event_time) AS event_time, max(payload_ts_ms) AS timestamp_ms,
         count(DISTINCT via) AS count,
         sum(CAST(value_w AS DECIMAL(18, 2))) FILTER (WHERE rn = 1) AS total
  FROM pairs GROUP BY 1, 2, 3, 4
)"""

_LOG_COLUMNS = """window_start, identifier, timestamp_ms, count,
       CAST(total AS DOUBLE) AS sum_w, CAST(total AS DOUBLE) / count AS average_w,
       event_time, arrival_seq, stream_time"""

_AS_OF = """
as_of AS (
  SELECT m.*, v.parents FROM m JOIN versions v ON m.identifier = v.child
  WHERE m.event_time >= v.valid_from AND (v.valid_to IS NULL OR m.event_time < v.valid_to)
)"""

_REATTRIBUTED = """
reattributed AS (
  SELECT c.child AS identifier, c.parents, c.event_time AS change_time,
         c.arrival_seq AS change_seq, m.value_w, m.payload_ts_ms, m.arrival_seq
  FROM (SELECT * FROM changes WHERE op = 'upsert') c
  ASOF JOIN m ON c.child = m.identifier AND c.event_time >= m.event_time
)"""

_RETRACTIONS = """
retractions AS (
  SELECT child, old_parents AS parent, 'delete' AS op, arrival_seq, event_time
  FROM changes
  WHERE old_parents IS NOT NULL AND old_parents IS DISTINCT FROM parents
)"""

ORACLE: dict[str, str] = {
    "measurement_scan": f"WITH {_M} SELECT * FROM m",
    "registry_events": """
SELECT event_type, payload, event_time, arrival_seq FROM (
  SELECT CASE event_type WHEN 'signup' THEN 'SENSOR_REGISTRY_CHANGED'
                         WHEN 'view' THEN 'SENSOR_REGISTRY_STATUS'
                         ELSE event_type END AS event_type,
         '{"identifier":"root","children":[{"identifier":"customer-' || user_id || '"}]}'
           AS payload,
         ts AS event_time, event_id AS arrival_seq
  FROM events)
WHERE event_type IN ('SENSOR_REGISTRY_CHANGED', 'SENSOR_REGISTRY_STATUS')""",
    "results_as_measurements": f"""
WITH {_M},{_LAST.format(source='m')},{_CUSTOMERS},{_rollup('by_nation', 'last_value', 'customers')}
SELECT r.identifier, t.event_time, r.timestamp_ms AS payload_ts_ms,
       CAST(r.total AS DOUBLE) AS value_w
FROM by_nation r JOIN (
  SELECT time_bucket(INTERVAL '6 hours', m.event_time) AS window_start, c.parent,
         max(m.event_time) AS event_time
  FROM m JOIN customers c ON m.identifier = c.child GROUP BY 1, 2
) t ON r.window_start = t.window_start AND r.identifier = t.parent""",
    "merge_streams": f"""
WITH {_M},{_LAST.format(source='m')},{_CUSTOMERS},{_rollup('by_nation', 'last_value', 'customers')}
SELECT identifier, event_time, payload_ts_ms, value_w FROM m
UNION ALL
SELECT r.identifier, t.event_time, r.timestamp_ms, CAST(r.total AS DOUBLE)
FROM by_nation r JOIN (
  SELECT time_bucket(INTERVAL '6 hours', m.event_time) AS window_start, c.parent,
         max(m.event_time) AS event_time
  FROM m JOIN customers c ON m.identifier = c.child GROUP BY 1, 2
) t ON r.window_start = t.window_start AND r.identifier = t.parent""",
    "registry_flatten": """
SELECT c_custkey AS arrival_seq, 'region-' || n_regionkey AS child, 'root' AS parent,
       1 AS level
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT c_custkey, 'nation-' || c_nationkey, 'region-' || n_regionkey, 2
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT c_custkey, 'customer-' || c_custkey, 'nation-' || c_nationkey, 3 FROM customer""",
    "registry_duplicate_ids": """
SELECT 'part-' || l_partkey AS child, count(*) AS occurrences
FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "registry_diff": f"WITH {_CHANGES} SELECT child, op, old_parents, parents FROM diff",
    "registry_history": f"""
WITH {_CHANGES}
SELECT child, op, old_parents, parents, arrival_seq, event_time FROM changes""",
    "current_parents": f"WITH {_CHANGES} SELECT child, parents FROM current_set",
    "membership_retractions": f"""
WITH {_CHANGES},{_RETRACTIONS}
SELECT child, parent, op, arrival_seq, event_time FROM retractions""",
    "join_current_parents": f"""
WITH {_M},{_CHANGES}
SELECT n.identifier, n.event_time, n.payload_ts_ms, n.value_w, n.arrival_seq, p.parents
FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY arrival_seq DESC) AS rn FROM m
) n JOIN current_set p ON n.identifier = p.child
WHERE n.rn = 1""",
    "join_parents_as_of": f"WITH {_M},{_CHANGES},{_AS_OF} SELECT * FROM as_of",
    "fan_out": f"""
WITH {_M},{_CUSTOMERS}
SELECT m.*, c.parent FROM m JOIN customers c ON m.identifier = c.child""",
    "fan_out_multi_parent": f"""
WITH {_M},{_CUSTOMERS}
SELECT m.*, c.parent FROM m JOIN (
  SELECT * FROM customers
  UNION ALL
  SELECT 'customer-' || c_custkey, 'segment-' || c_mktsegment FROM customer
) c ON m.identifier = c.child""",
    "reattribute_on_change": f"""
WITH {_M},{_CHANGES},{_REATTRIBUTED} SELECT * FROM reattributed""",
    "latest_per_sensor": f"""
WITH {_M}
SELECT identifier, event_time, payload_ts_ms, value_w, arrival_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY arrival_seq DESC) AS rn FROM m
) WHERE rn = 1""",
    "tumbling_windows": f"""
WITH {_M}
SELECT *, time_bucket(INTERVAL '6 hours', event_time) AS window_start,
       time_bucket(INTERVAL '6 hours', event_time) + INTERVAL '6 hours' AS window_end
FROM m""",
    "last_value_per_window": f"""
WITH {_M},{_CUSTOMERS}
SELECT window_start, identifier, parent, value_w, payload_ts_ms, event_time FROM (
  SELECT m.*, c.parent, time_bucket(INTERVAL '6 hours', event_time) AS window_start,
         row_number() OVER (
           PARTITION BY identifier, parent, time_bucket(INTERVAL '6 hours', event_time)
           ORDER BY payload_ts_ms DESC, arrival_seq DESC) AS rn
  FROM m JOIN customers c ON m.identifier = c.child
) WHERE rn = 1""",
    "late_filter": f"""
WITH {_SHUFFLED}
SELECT identifier, event_time, payload_ts_ms, value_w, arrival_seq,
       window_start + INTERVAL '6 hours' + INTERVAL '1 hour' <= stream_time AS late
FROM timed""",
    "stream_time": f"""
WITH {_SHUFFLED}
SELECT identifier, event_time, payload_ts_ms, value_w, arrival_seq, stream_time FROM timed""",
    "rollup_one_level": f"""
WITH {_M},{_LAST.format(source='m')},{_CUSTOMERS},{_rollup('by_nation', 'last_value', 'customers')}
{_final('by_nation')}""",
    "rollup_child_avg": f"""
WITH {_M},{_CUSTOMERS},
child_avg AS (
  SELECT time_bucket(INTERVAL '24 hours', event_time) AS window_start, identifier,
         CAST(sum(CAST(round(value_w * 1000000) AS BIGINT)) AS DOUBLE) / 1000000
           / count(*) AS value_w,
         max(payload_ts_ms) AS payload_ts_ms
  FROM m GROUP BY 1, 2
)
SELECT v.window_start, e.parent AS identifier, max(v.payload_ts_ms) AS timestamp_ms,
       count(*) AS count,
       CAST(sum(CAST(round(v.value_w * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 AS sum_w,
       CAST(sum(CAST(round(v.value_w * 1000000) AS BIGINT)) AS DOUBLE) / 1000000
         / count(*) AS average_w
FROM child_avg v JOIN customers e ON v.identifier = e.child
GROUP BY 1, 2""",
    "rollup_multilevel": _BALANCED_ROLLUP,
    "rollup_closure": _BALANCED_ROLLUP,
    "rollup_unbalanced": f"""
WITH {_M},{_LAST.format(source='m')},{_GROUPS},
customers AS (
  SELECT 'customer-' || c_custkey AS child,
         CASE WHEN n_regionkey = 2 THEN 'region-2' ELSE 'nation-' || c_nationkey END AS parent
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
to_nation AS (SELECT * FROM customers WHERE parent LIKE 'nation-%'),
to_region AS (SELECT * FROM customers WHERE parent LIKE 'region-%'),
{_rollup('by_nation', 'last_value', 'to_nation')},
region_input AS (
  SELECT window_start, identifier, timestamp_ms AS payload_ts_ms, total AS value_w
  FROM by_nation
  UNION ALL
  SELECT window_start, identifier, payload_ts_ms, CAST(value_w AS DECIMAL(18, 2))
  FROM last_value WHERE identifier IN (SELECT child FROM to_region)
),
region_edges AS (SELECT * FROM nations UNION ALL SELECT * FROM to_region),
{_rollup('by_region', 'region_input', 'region_edges')},
{_rollup('by_root', _as_value('by_region'), 'regions')}
{_final('by_nation', 'by_region', 'by_root')}""",
    "rollup_multi_parent": f"""
WITH {_M},{_LAST.format(source='m')},{_CUSTOMERS},{_GROUPS},
in_segment AS (
  SELECT 'customer-' || c_custkey AS child, 'segment-' || c_mktsegment AS parent FROM customer
),
segments AS (SELECT DISTINCT parent AS child, 'root' AS parent FROM in_segment),
{_rollup('by_nation', 'last_value', 'customers')},
{_rollup('by_region', _as_value('by_nation'), 'nations')},
{_rollup('by_segment', 'last_value', 'in_segment')},
top AS (SELECT * FROM by_region UNION ALL SELECT * FROM by_segment),
top_edges AS (SELECT * FROM regions UNION ALL SELECT * FROM segments),
{_rollup('by_root', _as_value('top'), 'top_edges')}
{_final('by_nation', 'by_region', 'by_segment', 'by_root')}""",
    "rollup_inner_node_reports": f"""
WITH inner_m AS (
  SELECT CASE WHEN event_type = 'error' THEN 'nation-' || c_nationkey
              ELSE 'customer-' || user_id END AS identifier,
         ts AS event_time, epoch_us(ts) // 1000 AS payload_ts_ms, value AS value_w,
         event_id AS arrival_seq
  FROM events JOIN customer ON user_id = c_custkey
),{_LAST.format(source='inner_m')},{_CUSTOMERS},{_GROUPS},
{_rollup('by_nation', 'last_value', 'customers')},
{_NEWER.format(name='nation_value', results='by_nation')},
{_rollup('by_region', 'nation_value', 'nations')},
{_rollup('by_root', _as_value('by_region'), 'regions')}
{_final('by_nation', 'by_region', 'by_root')}""",
    "rollup_accepted": f"""
WITH {_SHUFFLED},
accepted AS (SELECT * EXCLUDE (window_start, stream_time) FROM acc),
{_LAST.format(source='accepted')},{_CUSTOMERS},{_GROUPS},{_THREE_LEVELS}
{_final('by_nation', 'by_region', 'by_root')}""",
    "rollup_changing_members": f"""
WITH {_M},{_CHANGES},{_AS_OF},{_REATTRIBUTED},{_RETRACTIONS},{_GROUPS},
contributions AS (
  SELECT identifier, parents AS parent, event_time, payload_ts_ms, value_w, arrival_seq
  FROM as_of
  UNION ALL
  SELECT identifier, parents, change_time, payload_ts_ms, value_w, arrival_seq
  FROM reattributed
),
kept AS (
  SELECT c.* FROM contributions c WHERE NOT EXISTS (
    SELECT 1 FROM retractions r
    WHERE r.child = c.identifier AND r.parent = c.parent AND r.event_time > c.event_time
      AND time_bucket(INTERVAL '6 hours', r.event_time)
          = time_bucket(INTERVAL '6 hours', c.event_time))
),
by_nation AS (
  SELECT window_start, parent AS identifier, max(payload_ts_ms) AS timestamp_ms,
         count(*) AS count, sum(CAST(value_w AS DECIMAL(18, 2))) AS total
  FROM (
    SELECT *, row_number() OVER (
             PARTITION BY window_start, identifier, parent
             ORDER BY payload_ts_ms DESC, arrival_seq DESC) AS rn
    FROM (SELECT *, time_bucket(INTERVAL '6 hours', event_time) AS window_start FROM kept)
  ) WHERE rn = 1
  GROUP BY 1, 2
),
{_rollup('by_region', _as_value('by_nation'), 'nations')},
{_rollup('by_root', _as_value('by_region'), 'regions')}
{_final('by_nation', 'by_region', 'by_root')}""",
    "aggregate_changelog": f"""
WITH {_SHUFFLED},{_CUSTOMERS},{_GROUPS},{_CLOSURE},{_CHANGELOG}
SELECT {_LOG_COLUMNS} FROM log""",
    "throttled_emission": f"""
WITH RECURSIVE {_SHUFFLED},{_CUSTOMERS},{_GROUPS},{_CLOSURE},{_CHANGELOG},
due AS (SELECT *, event_time + INTERVAL '6 hours' AS due FROM log),
waiting AS (SELECT * FROM due WHERE stream_time < due),
jumps AS (
  SELECT a.window_start, a.identifier, a.arrival_seq, a.event_time, a.due,
         min(b.arrival_seq) FILTER (WHERE b.stream_time >= a.due) AS next_seq,
         max(b.arrival_seq) FILTER (WHERE b.stream_time < a.due) AS last_seq
  FROM waiting a JOIN waiting b
    ON a.window_start = b.window_start AND a.identifier = b.identifier
  GROUP BY 1, 2, 3, 4, 5
),
opened AS (
  SELECT window_start, identifier, min(arrival_seq) AS arrival_seq
  FROM waiting GROUP BY 1, 2
  UNION ALL
  SELECT o.window_start, o.identifier, j.next_seq
  FROM opened o JOIN jumps j
    ON o.window_start = j.window_start AND o.identifier = j.identifier
       AND o.arrival_seq = j.arrival_seq
  WHERE j.next_seq IS NOT NULL
),
released AS (
  SELECT l.*, j.event_time AS entry_time
  FROM opened o
  JOIN jumps j ON o.window_start = j.window_start AND o.identifier = j.identifier
                  AND o.arrival_seq = j.arrival_seq
  JOIN log l ON l.window_start = j.window_start AND l.identifier = j.identifier
                AND l.arrival_seq = j.last_seq
  WHERE j.due <= (SELECT max(event_time) FROM m)
  UNION ALL
  SELECT * EXCLUDE (due), event_time FROM due WHERE stream_time >= due
)
SELECT {_LOG_COLUMNS}, entry_time FROM released""",
}

# State of every sensor and group as of each accepted reading (q), level by level.
ORACLE["changelog_group_reports"] = f"""
WITH inner_m AS (
  SELECT CASE WHEN event_type = 'error' THEN 'nation-' || c_nationkey
              ELSE 'customer-' || user_id END AS identifier,
         ts AS event_time, epoch_us(ts) // 1000 AS payload_ts_ms, value AS value_w,
         {_late('event_id')} AS arrival_seq
  FROM events JOIN customer ON user_id = c_custkey
),
timed AS (
  SELECT *, max(event_time) OVER (ORDER BY arrival_seq) AS stream_time,
         time_bucket(INTERVAL '6 hours', event_time) AS window_start
  FROM inner_m
),
acc AS (
  SELECT * FROM timed
  WHERE window_start + INTERVAL '6 hours' + INTERVAL '1 hour' > stream_time
),{_CUSTOMERS},{_GROUPS},{_CLOSURE},
below AS (
  SELECT leaf, ancestor FROM closure
  UNION ALL
  SELECT child, parent FROM nations
  UNION ALL
  SELECT n.child, r.parent FROM nations n JOIN regions r ON n.parent = r.child
),
seen AS (
  SELECT u.arrival_seq AS q, u.window_start, v.identifier, v.payload_ts_ms,
         CAST(v.value_w AS DECIMAL(18, 2)) AS value_w, v.event_time,
         row_number() OVER (
           PARTITION BY u.arrival_seq, v.identifier
           ORDER BY v.payload_ts_ms DESC, v.arrival_seq DESC) AS rn
  FROM acc u JOIN acc v
    ON v.window_start = u.window_start AND v.arrival_seq <= u.arrival_seq
),
nation_now AS (
  SELECT s.q, c.parent AS identifier, count(*) AS count, sum(s.value_w) AS total,
         max(s.payload_ts_ms) AS timestamp_ms
  FROM seen s JOIN customers c ON s.identifier = c.child WHERE s.rn = 1 GROUP BY 1, 2
),
nation_value AS (
  SELECT coalesce(r.q, d.q) AS q, coalesce(r.identifier, d.identifier) AS identifier,
         CASE WHEN d.q IS NULL OR r.timestamp_ms >= d.payload_ts_ms
              THEN r.timestamp_ms ELSE d.payload_ts_ms END AS timestamp_ms,
         CASE WHEN d.q IS NULL OR r.timestamp_ms >= d.payload_ts_ms
              THEN r.total ELSE d.value_w END AS total
  FROM nation_now r
  FULL JOIN (SELECT * FROM seen WHERE rn = 1 AND identifier LIKE 'nation-%') d
    ON r.q = d.q AND r.identifier = d.identifier
),
region_now AS (
  SELECT v.q, n.parent AS identifier, count(*) AS count, sum(v.total) AS total,
         max(v.timestamp_ms) AS timestamp_ms
  FROM nation_value v JOIN nations n ON v.identifier = n.child GROUP BY 1, 2
),
root_now AS (
  SELECT v.q, r.parent AS identifier, count(*) AS count, sum(v.total) AS total,
         max(v.timestamp_ms) AS timestamp_ms
  FROM region_now v JOIN regions r ON v.identifier = r.child GROUP BY 1, 2
),
newest AS (
  SELECT s.q, b.ancestor AS identifier, max(s.event_time) AS event_time
  FROM seen s JOIN below b ON s.identifier = b.leaf GROUP BY 1, 2
),
states AS (
  SELECT * FROM nation_now UNION ALL SELECT * FROM region_now UNION ALL SELECT * FROM root_now
)
SELECT u.window_start, s.identifier, s.timestamp_ms, s.count,
       CAST(s.total AS DOUBLE) AS sum_w, CAST(s.total AS DOUBLE) / s.count AS average_w,
       t.event_time, u.arrival_seq, u.stream_time
FROM acc u
JOIN below b ON u.identifier = b.leaf
JOIN states s ON s.q = u.arrival_seq AND s.identifier = b.ancestor
JOIN newest t ON t.q = u.arrival_seq AND t.identifier = b.ancestor"""
ORACLE["rollup_final"] = _BALANCED_ROLLUP + _CLOSED
ORACLE["rollup_throttled_stream"] = ORACLE["throttled_emission"]
ORACLE["results_upserted"] = ORACLE["rollup_one_level"]

ORACLE["registry_emptied"] = f"""
WITH {_CUSTOMERS},{_VERSION_2}
SELECT child, 'upsert' AS op, CAST(NULL AS VARCHAR) AS old_parents, parent AS parents,
       CAST(0 AS BIGINT) AS arrival_seq, TIMESTAMP '2024-01-01 00:00:00' AS event_time
FROM customers
UNION ALL
SELECT child, 'delete', parent, NULL, 1, TIMESTAMP '2024-01-08 00:00:00' FROM customers
UNION ALL
SELECT child, 'upsert', NULL, parent, 2, TIMESTAMP '2024-01-15 00:00:00' FROM version2"""

# Sources take turns by their own numbers; each has its own stream time.
_SOURCES = f"""
shuffled AS (
  SELECT 'customer-' || user_id AS identifier, ts AS event_time,
         epoch_us(ts) // 1000 AS payload_ts_ms, value AS value_w, event_type,
         {_late('event_id')} AS seq
  FROM events
),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY seq) - 1)
              * (SELECT count(DISTINCT event_type) FROM events)
            + dense_rank() OVER (ORDER BY event_type) - 1 AS arrival_seq
  FROM shuffled
),
timed AS (
  SELECT *, max(event_time) OVER (PARTITION BY event_type ORDER BY arrival_seq) AS stream_time,
         time_bucket(INTERVAL '6 hours', event_time) AS window_start
  FROM numbered
),
acc AS (
  SELECT * EXCLUDE (event_type, seq) FROM timed
  WHERE window_start + INTERVAL '6 hours' + INTERVAL '1 hour' > stream_time
)"""
ORACLE["changelog_two_sources"] = ORACLE["aggregate_changelog"].replace(_SHUFFLED, _SOURCES)


# -- memberships that change, in the order of arrival ----------------------------------

_MIDDLE = "(SELECT max(event_id) // 2 FROM events)"


def _member_input(region: str) -> str:
    """Readings and two registries in one order; the second one has nations in region."""
    return f"""
stamps AS (
  SELECT CAST(-1 AS BIGINT) AS seq, TIMESTAMP '2024-01-01 00:00:00' AS event_time
  UNION ALL
  SELECT 2 * {_MIDDLE} * {_PLACES} + 1, (SELECT max(ts) FROM events WHERE event_id <= {_MIDDLE})
),
arrivals AS (
  SELECT *, max(event_time) OVER (ORDER BY seq) AS st FROM (
    SELECT 2 * arrival_seq AS seq, event_time, identifier AS node, payload_ts_ms AS pay,
           CAST(value_w AS DECIMAL(18, 2)) AS units FROM s
    UNION ALL
    SELECT seq, event_time, NULL, NULL, NULL FROM stamps)
),
v1 AS (SELECT * FROM customers UNION ALL SELECT * FROM nations UNION ALL SELECT * FROM regions),
v2 AS (
  SELECT * FROM version2
  UNION ALL
  SELECT 'nation-' || n_nationkey, 'region-' || ({region}) FROM nation
  UNION ALL
  SELECT * FROM regions
),
chg AS (
  SELECT c.node, c.old, c.new, a.seq, a.event_time, a.st
  FROM (
    SELECT child AS node, CAST(NULL AS VARCHAR) AS old, parent AS new, 0 AS version FROM v1
    UNION ALL
    SELECT coalesce(v1.child, v2.child), v1.parent, v2.parent, 1
    FROM v1 FULL JOIN v2 ON v1.child = v2.child WHERE v1.parent IS DISTINCT FROM v2.parent
  ) c JOIN arrivals a ON a.node IS NULL AND (a.seq < 0) = (c.version = 0)
),
u0 AS (
  SELECT node, time_bucket(INTERVAL '6 hours', event_time) AS w, seq, pay, units,
         event_time AS et, st, FALSE AS gone
  FROM arrivals WHERE node IS NOT NULL
)"""


def _member_level(h: int, prefix: str) -> str:
    """What updates u{h} and changes of nodes of a level make of the level above."""
    pair = "PARTITION BY w, child, parent"
    before = "ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
one{h} AS (
  SELECT * FROM u{h} QUALIFY row_number() OVER (PARTITION BY node, seq ORDER BY w DESC) = 1
),
moved{h} AS (
  SELECT c.node, c.old, c.new, c.seq, c.st, o.node IS NOT NULL AND NOT o.gone AS has, o.pay,
         o.units, greatest(o.et, c.event_time) AS et,
         time_bucket(INTERVAL '6 hours', greatest(o.et, c.event_time)) AS w
  FROM (SELECT * FROM chg WHERE node LIKE '{prefix}-%') c
  ASOF LEFT JOIN one{h} o ON c.node = o.node AND c.seq > o.seq
),
pair{h} AS (
  SELECT * FROM (
    SELECT u.w, u.node AS child, c.new AS parent, 2 * u.seq + 1 AS ord, u.seq,
           CASE WHEN NOT u.gone THEN u.pay END AS pay, u.units, u.et, u.st, u.gone AS removal
    FROM u{h} u ASOF JOIN chg c ON u.node = c.node AND u.seq >= c.seq
    UNION ALL
    SELECT w, node, new, 2 * seq, seq, pay, units, et, st, FALSE FROM moved{h} WHERE has
    UNION ALL
    SELECT w, node, old, 2 * seq, seq, NULL, NULL, et, st, TRUE
    FROM moved{h} WHERE old IS DISTINCT FROM new)
  WHERE parent IS NOT NULL AND w + INTERVAL '6 hours' + INTERVAL '1 hour' > st
),
stretch{h} AS (
  SELECT *, CASE WHEN NOT removal THEN CAST(pay AS HUGEINT) * 1000000000000 + ord END AS place,
         coalesce(sum(CASE WHEN removal THEN 1 ELSE 0 END) OVER ({pair} {before}), 0) AS number
  FROM pair{h}
),
offer{h} AS (
  SELECT *, max(place) OVER ({pair}, number {before}) AS had,
         arg_max(units, place) OVER ({pair}, number {before}) AS old_units
  FROM stretch{h}
),
step{h} AS (
  SELECT w, parent AS node, seq, max(pay) AS pay, max(et) AS et, max(st) AS st,
         sum(CASE WHEN removal THEN -1 WHEN had IS NULL THEN 1 ELSE 0 END) AS joins,
         sum(CASE WHEN removal THEN -old_units
                  WHEN had IS NULL THEN units
                  WHEN place > had THEN units - old_units ELSE 0 END) AS moves
  FROM offer{h} WHERE NOT removal OR had IS NOT NULL GROUP BY 1, 2, 3
),
r{h + 1} AS (
  SELECT w, node, seq, st, sum(joins) OVER s AS n, sum(moves) OVER s AS total,
         max(pay) OVER s AS newest, max(et) OVER s AS et
  FROM step{h} WINDOW s AS (PARTITION BY w, node ORDER BY seq)
),
u{h + 1} AS (
  SELECT node, w, seq, newest AS pay, CAST(total AS DECIMAL(18, 2)) AS units, et, st,
         n = 0 AS gone
  FROM r{h + 1}
)"""


def _members(region: str) -> str:
    levels = [_member_level(h, p) for h, p in enumerate(("customer", "nation", "region"))]
    return f"""
WITH {_SHUFFLED},{_CUSTOMERS},{_VERSION_2},{_GROUPS},{_member_input(region)},{','.join(levels)},
results AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3)
SELECT w AS window_start, node AS identifier, newest AS timestamp_ms, CAST(n AS BIGINT) AS count,
       CAST(total AS DOUBLE) AS sum_w,
       CASE WHEN n = 0 THEN 0.0 ELSE CAST(total AS DOUBLE) / n END AS average_w"""


_MOVING = "CASE WHEN n_nationkey % 4 = 1 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END"
_LOG = ", et AS event_time, seq AS arrival_seq, st AS stream_time FROM results"
ORACLE["changelog_changing_members"] = _members("n_regionkey") + _LOG
ORACLE["rollup_changing_members_stream"] = ORACLE["changelog_changing_members"]
ORACLE["changelog_moving_groups"] = _members(_MOVING) + _LOG
ORACLE["rollup_moving_groups"] = _members(_MOVING) + """
FROM (SELECT * FROM results
      QUALIFY row_number() OVER (PARTITION BY w, node ORDER BY seq DESC) = 1)
WHERE n > 0"""


# -- several sources, corrections in one table -------------------------------------------

ORACLE["throttled_upserted"] = f"""
SELECT * FROM ({ORACLE["throttled_emission"]})
QUALIFY row_number() OVER (PARTITION BY window_start, identifier ORDER BY arrival_seq DESC) = 1"""

# The least clock of the sources that have reported, which never goes back.
_RELEASED = """
clocks AS (
  SELECT n.arrival_seq, k.event_type,
         max(CASE WHEN n.event_type = k.event_type THEN n.event_time END)
           OVER (PARTITION BY k.event_type ORDER BY n.arrival_seq) AS clock
  FROM numbered n, (SELECT DISTINCT event_type FROM events) k
),
released_at AS (
  SELECT arrival_seq, max(least_clock) OVER (ORDER BY arrival_seq) AS release_time
  FROM (SELECT arrival_seq, min(clock) AS least_clock FROM clocks GROUP BY 1)
),
acc AS (
  SELECT t.* EXCLUDE (event_type, seq, stream_time), r.release_time AS stream_time
  FROM timed t JOIN released_at r ON t.arrival_seq = r.arrival_seq
  WHERE window_start + INTERVAL '6 hours' + INTERVAL '1 hour' > t.stream_time
)"""
_BY_SOURCE = _SOURCES[: _SOURCES.index("acc AS (")] + _RELEASED
ORACLE["throttled_two_sources"] = (
    ORACLE["throttled_emission"]
    .replace(_SHUFFLED, _BY_SOURCE)
    .replace("(SELECT max(event_time) FROM m)", "(SELECT max(release_time) FROM released_at)")
)
ORACLE["rollup_two_sources_stream"] = f"""
WITH {_SOURCES},
accepted AS (SELECT * EXCLUDE (window_start, stream_time) FROM acc),
{_LAST.format(source='accepted')},{_CUSTOMERS},{_GROUPS},{_THREE_LEVELS}
{_final('by_nation', 'by_region', 'by_root')}
WHERE window_start + INTERVAL '7 hours' <= (
  SELECT min(newest) FROM (SELECT max(ts) AS newest FROM events GROUP BY event_type))"""


# -- other values of a child than the last one, and sums of any doubles --------------------


def _log_of_all(value: str, total: str) -> str:
    """The changelog with a value of each sensor made from all its readings so far."""
    return f"""
now AS (
  SELECT u.window_start, a.ancestor AS identifier, u.arrival_seq, u.stream_time,
         v.identifier AS sensor, b.via, max(v.event_time) AS event_time,
         max(v.payload_ts_ms) AS payload_ts_ms, {value} AS value
  FROM acc u
  JOIN closure a ON u.identifier = a.leaf
  JOIN acc v ON v.window_start = u.window_start AND v.arrival_seq <= u.arrival_seq
  JOIN closure b ON b.leaf = v.identifier AND b.ancestor = a.ancestor
  GROUP BY 1, 2, 3, 4, 5, 6
),
log AS (
  SELECT window_start, identifier, arrival_seq, stream_time, max(event_time) AS event_time,
         max(payload_ts_ms) AS timestamp_ms, count(DISTINCT via) AS count, {total} AS total
  FROM now GROUP BY 1, 2, 3, 4
)"""


_UNITS = "sum(CAST(round(v.value_w * 1000000) AS BIGINT))"
_DAILY = _SHUFFLED.replace("INTERVAL '6 hours'", "INTERVAL '24 hours'")
ORACLE["changelog_child_max"] = f"""
WITH {_SHUFFLED},{_CUSTOMERS},{_GROUPS},{_CLOSURE},
{_log_of_all("max(CAST(v.value_w AS DECIMAL(18, 2)))", "sum(value)")}
SELECT {_LOG_COLUMNS} FROM log"""
ORACLE["changelog_child_avg"] = f"""
WITH {_DAILY},{_CUSTOMERS},{_GROUPS},{_CLOSURE},
{_log_of_all(
    f"CAST(round(CAST({_UNITS} AS DOUBLE) / 1000000 / count(*) * 1000000) AS BIGINT)",
    "CAST(sum(value) AS DOUBLE) / 1000000",
)}
SELECT {_LOG_COLUMNS} FROM log"""

# Whole units of 2^-40: the values are whole numbers times a power of two from -40 to 40.
_WIDE = _SHUFFLED.replace(
    "SELECT identifier, event_time, payload_ts_ms, value_w, {}".format(_late("arrival_seq")),
    "SELECT identifier, event_time, payload_ts_ms, floor(value_w) * pow(2.0, ({0} % 5 - 2) * 20)"
    " AS value_w, {0}".format("(" + _late("arrival_seq") + ")"),
)
ORACLE["changelog_any_doubles"] = f"""
WITH {_WIDE},{_CUSTOMERS},{_GROUPS},{_CLOSURE},
{_CHANGELOG.replace(
    "sum(CAST(value_w AS DECIMAL(18, 2)))", "sum(CAST(value_w * pow(2.0, 40) AS HUGEINT))"
)}
SELECT window_start, identifier, timestamp_ms, count,
       CAST(total AS DOUBLE) / pow(2.0, 40) AS sum_w, event_time, arrival_seq, stream_time
FROM log"""

ORACLE["rollup_final_groups_report"] = ORACLE["rollup_inner_node_reports"] + """
WHERE window_start + INTERVAL '6 hours' <= (SELECT max(event_time) FROM inner_m)"""
