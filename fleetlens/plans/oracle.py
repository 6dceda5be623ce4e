"""DuckDB oracle text for each registered query.

Written independently of the Spark code paths (plain SQL over the fixture
views, often in the reference's own formulation, e.g. the per-node test of
the admission check), so that a Spark rewrite that changes results shows up.
Aggregates are cast to the Spark result types (DuckDB sums are HUGEINT).
"""

from __future__ import annotations

from fleetlens.plans.views import with_views

APP_ID = ("concat('application_', split_part(container_id, '_', 2), '_', "
          "split_part(container_id, '_', 3))")
ATTEMPT = "CAST(split_part(container_id, '_', 4) AS INT)"
APP_NUM = "CAST(split_part(container_id, '_', 3) AS BIGINT)"
TERMINAL = "('FINISHED', 'FAILED', 'KILLED')"


# Addresses by string functions alone: what stands behind ``://`` up to the
# next ``/``, ``?`` or ``#``, without user and password.
def _authority(a: str) -> str:
    for stop in "/?#":
        a = f"split_part({a}, '{stop}', 1)" if stop != "/" else f"split_part(substr({a}, strpos({a}, '://') + 3), '/', 1)"
    return f"split_part({a}, '@', -1)"


def _is_url(a: str) -> str:
    return f"strpos({a}, '://') > 1"


def _is_pair(a: str) -> str:
    """``host:port``: one colon, no slash, digits behind it."""
    return (f"(len(string_split({a}, ':')) = 2 AND strpos({a}, '/') = 0 AND split_part({a}, ':', 1) <> '' "
            f"AND split_part({a}, ':', 2) <> '' AND translate(split_part({a}, ':', 2), '0123456789', '') = '')")


def _behind_host(a: str) -> str:
    """A URL's authority behind its host; an IPv6 host stands in brackets."""
    x = _authority(a)
    return f"CASE WHEN starts_with({x}, '[') THEN split_part({x}, ']', 2) ELSE substr({x}, length(split_part({x}, ':', 1)) + 1) END"


def sql_host(a: str) -> str:
    x = _authority(a)
    return (f"CASE WHEN {_is_url(a)} THEN lower(CASE WHEN starts_with({x}, '[') THEN split_part(substr({x}, 2), ']', 1) "
            f"ELSE split_part({x}, ':', 1) END) WHEN {_is_pair(a)} THEN split_part({a}, ':', 1) ELSE {a} END")


def sql_port(a: str) -> str:
    return (f"CASE WHEN {_is_url(a)} THEN TRY_CAST(NULLIF(split_part({_behind_host(a)}, ':', 2), '') AS INT) "
            f"WHEN {_is_pair(a)} THEN TRY_CAST(split_part({a}, ':', 2) AS INT) END")


CONTAINER_SUMMARY = f"""
SELECT app_id, requested, completed, failed,
  CASE WHEN completed < requested THEN 'RUNNING' WHEN failed > 0 THEN 'FAILED'
    ELSE 'UNDEFINED' END AS final_status
FROM (SELECT {APP_ID} AS app_id, count(*) AS requested,
    CAST(count_if(completed = 1) AS BIGINT) AS completed,
    CAST(count_if(completed = 1 AND exit_status <> 0) AS BIGINT) AS failed
  FROM containers GROUP BY 1) s"""

PROGRESS = ("CASE WHEN requested > 0 THEN 0.1::DOUBLE + completed / (requested * 0.9::DOUBLE) "
            "ELSE 0.1::DOUBLE END")

ERROR_BODY = """
SELECT CASE WHEN event_id % 11 = 0
    THEN concat('{"RemoteException": {"message": "', event_type, '", "body": ', cut, '}}')
  WHEN event_id % 13 = 0 THEN concat('{"RemoteException": ', cut, '}')
  ELSE cut END AS body
FROM (SELECT event_id, event_type,
  CASE WHEN event_id % 7 = 0 THEN concat('503 Service Unavailable ', props) ELSE props END AS cut FROM events) e"""

LOG_CONTAINER = ("concat('container_1700000000000_', lpad(CAST(conv_id AS VARCHAR), CAST(greatest(9, length(CAST(conv_id AS VARCHAR))) AS INT), '0'), '_01_', "
                 "CASE role WHEN 'system' THEN '000001' WHEN 'user' THEN '000002' ELSE '000003' END)")

FINGERPRINTS = """
SELECT env_name, fp, CAST(regexp_extract(env_name, '([0-9]+)$', 1) AS INT) AS num FROM (
  SELECT env_name, sha1(string_agg(DISTINCT spec, '-' ORDER BY spec)) AS fp
  FROM packages GROUP BY env_name) f"""

RAW_WIDE = """
SELECT cluster_key,
  max(CASE WHEN key = 'yarn.resourcemanager.hostname' THEN value END) AS hn,
  max(CASE WHEN key = 'yarn.resourcemanager.webapp.address' THEN value END) AS wa,
  max(CASE WHEN key = 'yarn.resourcemanager.webapp.https.address' THEN value END) AS hs,
  max(CASE WHEN key = 'dfs.replication' THEN value END) AS rf
FROM raw_config GROUP BY cluster_key"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["app_progress"] = with_views(f"""
SELECT a.app_id, a.name, coalesce(s.requested, 0) AS requested, coalesce(s.completed, 0) AS completed,
  coalesce(s.failed, 0) AS failed, coalesce(s.final_status, 'UNDEFINED') AS final_status,
  {PROGRESS} AS progress
FROM apps a LEFT JOIN (
  SELECT app_id, requested, completed, failed,
    CASE WHEN completed < requested THEN 'RUNNING' WHEN failed > 0 THEN 'FAILED'
      ELSE 'UNDEFINED' END AS final_status
  FROM (SELECT {APP_NUM} AS app_id, count(*) AS requested,
      CAST(count_if(completed = 1) AS BIGINT) AS completed,
      CAST(count_if(completed = 1 AND exit_status <> 0) AS BIGINT) AS failed
    FROM containers GROUP BY 1) x) s ON s.app_id = a.app_id""", "apps", "containers")

    q["flatten_envelope"] = with_views(
        "SELECT app_id, event_id, state FROM state_events WHERE app_id % 10 <> 0", "state_events")

    q["rest_applications"] = with_views("""
SELECT concat('application_1700000000000_', lpad(CAST(app_id AS VARCHAR), CAST(greatest(9, length(CAST(app_id AS VARCHAR))) AS INT), '0')) AS id,
  name, state, started FROM apps""", "apps")

    q["error_responses"] = f"""
WITH b AS ({ERROR_BODY.strip()})
SELECT CASE WHEN NOT json_valid(body) THEN 'not_json'
    WHEN json_extract_string(body, '$.RemoteException.message') IS NOT NULL THEN 'remote'
    WHEN coalesce(json_type(body, '$.RemoteException'), 'NULL') <> 'NULL' THEN 'remote_other'
    ELSE 'unknown' END AS status, count(*) AS n
FROM b GROUP BY 1"""

    q["container_logs"] = f"""
WITH s AS (
  SELECT {LOG_CONTAINER} AS container_id,
    concat('host_', CAST(conv_id % 5 AS VARCHAR)) AS node_id,
    count(*) AS turns, string_agg(CASE WHEN turn % 3 = 0 THEN concat('Container: - ', text) ELSE text END,
      chr(10) ORDER BY turn) AS body
  FROM conversations GROUP BY conv_id, role)
SELECT container_id, node_id, 'stderr' AS log_type, concat('turns=', CAST(turns AS VARCHAR)) AS content FROM s
UNION ALL
SELECT container_id, node_id, 'stdout' AS log_type, rtrim(body, chr(10)) AS content FROM s"""

    # Between the marks; then white space and one <pre> pair are cut by position.
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    q["log_html"] = f"""
WITH t AS (SELECT page_id, html, substr(html, strpos(html, '<title>') + 7) AS tail FROM pages),
i AS (
  SELECT page_id, html, CASE WHEN strpos(html, '<title>') > 0 AND strpos(tail, '</title>') > 0
    THEN ltrim(substr(tail, 1, strpos(tail, '</title>') - 1), {space}) ELSE '' END AS x FROM t),
o AS (SELECT page_id, html, rtrim(CASE WHEN starts_with(x, '<pre>') THEN substr(x, 6) ELSE x END, {space}) AS x FROM i)
SELECT page_id, CASE WHEN contains(html, 'Cannot find this log') THEN ''
    WHEN ends_with(x, '</pre>') THEN substr(x, 1, length(x) - 6) ELSE x END AS content
FROM o"""

    q["site_config"] = with_views("SELECT cluster_key, key, value FROM raw_config", "raw_config")

    q["file_manifest"] = with_views(
        "SELECT path, size FROM remote_files WHERE ends_with(path, '.zip')", "remote_files")

    q["whole_manifest"] = with_views(
        "SELECT path, size FROM local_files WHERE ends_with(path, '.zip')", "local_files")

    q["listed_files"] = """
SELECT source, CAST(sum(coalesce(strlen(text), 0) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source"""

    q["killable_apps"] = with_views(f"""
SELECT app_id, state FROM apps
WHERE name = 'etl' AND (state IS NULL OR state NOT IN {TERMINAL})""", "apps")

    q["container_status"] = with_views("""
SELECT container_id, CASE WHEN completed = 1 THEN 'COMPLETE' ELSE 'RUNNING' END AS state
FROM containers""", "containers")

    q["log_search"] = """
WITH w AS (
  SELECT concat('container_1700000000000_', lpad(CAST(conv_id AS VARCHAR), CAST(greatest(9, length(CAST(conv_id AS VARCHAR))) AS INT), '0'), '_01_',
      lpad(CAST(turn AS VARCHAR), CAST(greatest(6, length(CAST(turn AS VARCHAR))) AS INT), '0')) AS container_id,
    text AS stdout, concat('role=', role) AS stderr
  FROM conversations),
l AS (
  SELECT container_id, 'stdout' AS log_type, stdout AS content FROM w
  UNION ALL SELECT container_id, 'stderr', stderr FROM w),
x AS (
  SELECT container_id, log_type,
    CAST((SELECT count(*) FROM unnest(string_split(content, chr(10))) AS t(ln)
          WHERE contains(ln, 'tion')) AS INT) AS n_lines
  FROM l)
SELECT container_id, log_type, n_lines FROM x WHERE n_lines > 0"""

    q["host_port_rollup"] = f"""
SELECT host, port, count(*) AS n FROM (
  SELECT {sql_host('url')} AS host, {sql_port('url')} AS port FROM pages) p
GROUP BY host, port"""

    q["normalize_uris"] = with_views("""
SELECT uri, count(*) AS n_refs FROM (
  SELECT CASE WHEN starts_with(uri, 'hdfs://') AND NOT starts_with(uri, 'hdfs:///')
      THEN concat('hdfs:///', substr(uri, 8))
    WHEN regexp_matches(uri, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN uri
    ELSE concat('file:', uri) END AS uri
  FROM uris) u GROUP BY uri""", "uris")

    q["attribute_containers"] = with_views(f"""
SELECT a.app_id, a.name, count(*) AS n_containers, CAST(sum(c.memory_mb) AS BIGINT) AS memory_mb
FROM apps a JOIN containers c ON {APP_NUM} = a.app_id
GROUP BY a.app_id, a.name""", "apps", "containers")

    q["reject_unknown"] = with_views("""
SELECT container_id FROM containers
WHERE container_id NOT IN (SELECT container_id FROM containers WHERE completed = 0)""", "containers")

    q["upload_delta"] = with_views("""
SELECT l.path, CASE WHEN r.path IS NULL THEN 'missing' WHEN l.size <> r.size THEN 'size'
    WHEN NOT (l.mtime < r.last_mod) THEN 'stale' ELSE 'skip' END AS action
FROM local_files l LEFT JOIN remote_files r ON l.path = r.path""", "local_files", "remote_files")

    q["cached_sets"] = with_views(f"""
SELECT s.env_name, s.fp,
  CASE WHEN s.fp IN (SELECT fp FROM ({FINGERPRINTS}) a WHERE num % 3 = 0) THEN 'reuse'
    WHEN s.fp IN (SELECT fp FROM ({FINGERPRINTS}) d WHERE num % 3 = 1) THEN 'zip'
    ELSE 'build' END AS action
FROM ({FINGERPRINTS}) s""", "packages")

    q["admission_check"] = with_views("""
SELECT r.request_id,
  CASE WHEN coalesce(c.n_nodes, 0) < 1 THEN 'NO_NODES'
    WHEN c.total_mb < 1024 + r.num_containers * greatest(r.memory_mb, 1024) THEN 'MEMORY'
    WHEN c.total_vcores < 1 + r.num_containers * r.vcores THEN 'VCORES'
    WHEN NOT EXISTS (SELECT 1 FROM nodes n WHERE n.cluster_id = r.cluster_id
        AND NOT (greatest(1024, r.memory_mb) > n.avail_mb AND r.vcores > n.avail_vcores))
      THEN 'NO_NODE_FITS'
    ELSE 'OK' END AS decision
FROM requests r LEFT JOIN (
  SELECT cluster_id, count(*) AS n_nodes, sum(avail_mb) AS total_mb,
    sum(avail_vcores) AS total_vcores FROM nodes GROUP BY cluster_id) c
  ON r.cluster_id = c.cluster_id""", "requests", "nodes")

    q["state_counts"] = with_views("SELECT state, count(*) AS n FROM apps GROUP BY state", "apps")

    q["capacity_rollup"] = with_views("""
SELECT cluster_id, count(*) AS n_nodes, CAST(sum(avail_mb) AS BIGINT) AS total_mb,
  CAST(sum(avail_vcores) AS BIGINT) AS total_vcores, max(avail_mb) AS max_mb,
  max(avail_vcores) AS max_vcores
FROM nodes GROUP BY cluster_id""", "nodes")

    q["storage_need"] = with_views("""
SELECT app, CAST(sum(size) // 1024 AS BIGINT) AS need FROM local_files
WHERE NOT starts_with(path, 'hdfs://') GROUP BY app""", "local_files")

    q["completion_summary"] = with_views(CONTAINER_SUMMARY, "containers")

    q["progress"] = with_views(
        f"SELECT app_id, {PROGRESS} AS progress FROM ({CONTAINER_SUMMARY}) t", "containers")

    q["latest_attempt"] = with_views(f"""
SELECT app_id, string_agg(container_id, ',' ORDER BY container_id) AS ids FROM (
  SELECT {APP_ID} AS app_id, {ATTEMPT} AS attempt, container_id FROM containers
  QUALIFY attempt = max(attempt) OVER (PARTITION BY app_id)) c
GROUP BY app_id""", "containers")

    q["used_containers"] = with_views(f"""
SELECT {APP_ID} AS app_id, CAST(count_if(completed = 0) AS BIGINT) AS n_used
FROM containers GROUP BY 1""", "containers")

    q["set_fingerprint"] = with_views("""
SELECT env_name, sha1(string_agg(DISTINCT spec, '-' ORDER BY spec)) AS fp
FROM packages GROUP BY env_name""", "packages")

    q["worker_containers"] = with_views(f"""
SELECT container_id, {APP_ID} AS app_id FROM containers
QUALIFY row_number() OVER (PARTITION BY {APP_ID} ORDER BY container_id) > 1""", "containers")

    q["first_by_key"] = with_views(r"""
SELECT env_name, key, arg_min(spec, pos) AS spec FROM (
  SELECT env_name, regexp_extract(spec, '^\w+', 0) AS key, spec, pos FROM packages) p
GROUP BY env_name, key""", "packages")

    q["latest_state"] = with_views("""
SELECT c.c_custkey AS app_id, coalesce(l.state, 'NONE') AS state
FROM customer c LEFT JOIN (
  SELECT app_id, state FROM state_events
  QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY ts DESC, event_id DESC) = 1) l
  ON l.app_id = c.c_custkey""", "state_events")

    q["time_to_terminal"] = with_views(f"""
SELECT app_id, wait_us, coalesce(wait_us < 86400000000, false) AS in_time FROM (
  SELECT app_id, date_diff('microsecond', min(ts),
      min(CASE WHEN state IN {TERMINAL} THEN ts END)) AS wait_us
  FROM state_events GROUP BY app_id) t""", "state_events")

    q["pool_size"] = with_views("""
SELECT event_id, app_id,
  CAST(sum(CASE WHEN state = 'FAILED' THEN 0 ELSE 1 END) OVER w AS BIGINT) AS requested,
  CAST(sum(CASE WHEN state = 'FAILED' THEN -1 ELSE 1 END) OVER w AS BIGINT) AS net
FROM state_events
WINDOW w AS (PARTITION BY app_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "state_events")

    q["resolve_layers"] = with_views("""
SELECT key, layer, value FROM config_layers
QUALIFY row_number() OVER (PARTITION BY key ORDER BY priority DESC, seq DESC) = 1""",
                                     "config_layers")

    q["derive_parameters"] = with_views(f"""
SELECT n.node_id,
  CASE WHEN w.wa IS NOT NULL THEN {sql_host('w.wa')} ELSE coalesce(w.hn, 'localhost') END AS rm,
  CASE WHEN w.wa IS NOT NULL THEN {sql_port('w.wa')} ELSE 8088 END AS rm_port,
  CASE WHEN w.hs IS NOT NULL THEN {sql_port('w.hs')} ELSE 8090 END AS rm_port_https,
  coalesce(TRY_CAST(w.rf AS INT), 3) AS replication_factor
FROM nodes n LEFT JOIN ({RAW_WIDE}) w ON n.node_id = w.cluster_key""", "nodes", "raw_config")

    q["stream_completion"] = """
SELECT user_id AS app_id, count(*) AS done, CAST(count_if(event_type = 'error') AS BIGINT) AS failed
FROM events GROUP BY user_id"""

    q["map_outcome"] = r"""
SELECT doc_id, CASE WHEN contains(text, '|') THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN NOT contains(text, '|') THEN CAST(len(regexp_extract_all(text, '[^ \x09-\x0D]+')) AS BIGINT) END AS n_words
FROM documents"""

    q["stream_final_status"] = with_views(
        f"SELECT * FROM ({CONTAINER_SUMMARY}) t WHERE final_status <> 'RUNNING'", "containers")

    # The watermark is the last event less six hours, in whole milliseconds; a
    # deadline is up at its next whole millisecond.
    q["stream_deadlines"] = with_views(f"""
SELECT app_id, first, CASE WHEN in_time THEN wait_us END AS wait_us, in_time FROM (
  SELECT app_id, min(ts) AS first, date_diff('microsecond', min(ts), min(CASE WHEN state IN {TERMINAL} THEN ts END)) AS wait_us,
    coalesce(date_diff('microsecond', min(ts), min(CASE WHEN state IN {TERMINAL} THEN ts END)) < 86400000000, false) AS in_time
  FROM state_events GROUP BY app_id) t
WHERE ceil((epoch_us(first) + 86400000000) / 1000) <= (SELECT floor(epoch_us(max(ts)) / 1000) - 6 * 3600000 FROM state_events)""",
                                       "state_events")

    # A section's bytes: header, its stderr block, its stdout block, line ends.
    q["log_sections"] = f"""
WITH s AS (
  SELECT {LOG_CONTAINER} AS container_id,
    concat('host_', CAST(conv_id % 5 AS VARCHAR)) AS node_id, concat('turns=', CAST(count(*) AS VARCHAR)) AS err,
    CAST(sum(length(text)) + count(*) - 1 AS VARCHAR) AS out_len,
    string_agg(CASE WHEN turn % 3 = 0 THEN concat('Container: - ', text) ELSE text END, chr(10) ORDER BY turn) AS body
  FROM conversations GROUP BY conv_id, role),
l AS (
  SELECT *, strlen(concat('Container: ', container_id, ' on ', node_id, chr(10), 'LogType:stderr', chr(10), 'LogLength:',
    CAST(length(err) AS VARCHAR), chr(10), 'Log Contents:', chr(10), err, chr(10), 'LogType:stdout', chr(10), 'LogLength:',
    out_len, chr(10), 'Log Contents:', chr(10), body, chr(10))) AS section_bytes FROM s)
SELECT container_id, node_id, 'stderr' AS log_type, err AS content, section_bytes FROM l
UNION ALL
SELECT container_id, node_id, 'stdout' AS log_type, rtrim(body, chr(10)) AS content, section_bytes FROM l"""

    q["queue_tree"] = "WITH RECURSIVE " + with_views("""
SELECT response, path, depth, queue, state, capacity, n_apps FROM tree""", "queue_nodes").replace("WITH ", "", 1).replace(
        "\nSELECT response", """, tree AS (
  SELECT response, node, concat('q', CAST(node AS VARCHAR)) AS path, 0 AS depth, concat('q', CAST(node AS VARCHAR)) AS queue,
    state, capacity, CAST(n_apps AS BIGINT) AS n_apps FROM queue_nodes WHERE node = 0
  UNION ALL
  SELECT n.response, n.node, concat(t.path, '.q', CAST(n.node AS VARCHAR)), t.depth + 1, concat('q', CAST(n.node AS VARCHAR)),
    n.state, n.capacity, CAST(n.n_apps AS BIGINT)
  FROM queue_nodes n JOIN tree t ON t.response = n.response AND t.node = (n.node - 1) // 3 AND n.node > 0)
SELECT response""", 1)

    q["barrier_run"] = r"""
WITH t AS (
  SELECT CAST(doc_id % 4 AS INT) AS task, count(*) AS n_docs,
    sum(len(regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+'))) AS n_words FROM documents GROUP BY 1),
r AS (
  SELECT task, CAST(4 AS INT) AS n_tasks, CAST(3 * (n_words % 2) AS INT) AS exit_status,
    concat(n_docs, ' documents, ', n_words, ' words') AS output FROM t)
SELECT task, n_tasks, exit_status, output, CAST(NULL AS VARCHAR) AS error,
  (SELECT count(*) FROM r WHERE exit_status <> 0) AS failed,
  CASE WHEN EXISTS (FROM r WHERE exit_status <> 0) THEN 'FAILED' ELSE 'UNDEFINED' END AS final_status FROM r"""

    q["site_parameters"] = with_views(f"""
SELECT n.node_id,
  CASE WHEN w.wa IS NOT NULL THEN {sql_host('w.wa')} ELSE coalesce(w.hn, 'localhost') END AS rm,
  CASE WHEN w.wa IS NOT NULL THEN {sql_port('w.wa')} ELSE 8088 END AS rm_port,
  CASE WHEN w.hs IS NOT NULL THEN {sql_port('w.hs')} ELSE 8090 END AS rm_port_https,
  coalesce(TRY_CAST(w.rf AS INT), 3) AS replication_factor
FROM nodes n LEFT JOIN ({RAW_WIDE.replace('FROM raw_config', """FROM (
  SELECT cluster_key, key, value FROM site_properties
  QUALIFY row_number() OVER (PARTITION BY cluster_key, key ORDER BY layer = 'core-site' DESC, seq DESC) = 1) p""")}) w
  ON n.node_id = w.cluster_key""", "nodes", "site_properties")

    needles = ", ".join(f"('{n}')" for n in ("tion", "ion", "on", "en", "the", "th", "role=user", "role=", "e e", ". ", "ung", "aaa"))
    q["log_search_many"] = f"""
WITH w AS (
  SELECT concat('container_1700000000000_', lpad(CAST(conv_id AS VARCHAR), CAST(greatest(9, length(CAST(conv_id AS VARCHAR))) AS INT), '0'), '_01_',
      lpad(CAST(turn AS VARCHAR), CAST(greatest(6, length(CAST(turn AS VARCHAR))) AS INT), '0')) AS container_id,
    text AS stdout, concat('role=', role) AS stderr
  FROM conversations),
l AS (
  SELECT container_id, 'stdout' AS log_type, unnest(string_split(stdout, chr(10))) AS line FROM w
  UNION ALL SELECT container_id, 'stderr', unnest(string_split(stderr, chr(10))) FROM w)
SELECT container_id, log_type, needle, CAST(count(*) AS INT) AS n_lines
FROM l JOIN (VALUES {needles}) n(needle) ON contains(line, needle) GROUP BY ALL"""

    # The form by its parts: container, perhaps an epoch, then four numbers.
    parts = "string_split(container_id, '_')"
    skip = f"CASE WHEN starts_with({parts}[2], 'e') THEN 1 ELSE 0 END"
    digits = "len(list_filter({p}[2 + {k}:], lambda x: x = '' OR translate(x, '0123456789', '') <> '')) = 0"
    formed = (f"(container_id IS NOT NULL AND {parts}[1] = 'container' AND len({parts}) = 5 + {skip} AND "
              f"({skip} = 0 OR (length({parts}[2]) > 1 AND translate(substr({parts}[2], 2), '0123456789', '') = '')) AND "
              + digits.format(p=parts, k=f"({skip})") + ")")
    q["malformed_containers"] = with_views(f"""
SELECT container_id, count(*) AS n, CASE WHEN container_id IS NULL THEN 'null'
    WHEN NOT starts_with(container_id, 'container_') THEN 'prefix' WHEN len({parts}) < 5 THEN 'parts' ELSE 'form' END AS reason
FROM captured_containers WHERE NOT {formed} GROUP BY container_id""", "captured_containers")

    q["captured_summary"] = with_views(f"""
SELECT app_id, requested, completed, failed,
  CASE WHEN completed < requested THEN 'RUNNING' WHEN failed > 0 THEN 'FAILED' ELSE 'UNDEFINED' END AS final_status
FROM (SELECT concat('application_', split_part(container_id, '_', -4), '_', split_part(container_id, '_', -3)) AS app_id,
    count(*) AS requested, count(*) FILTER (completed = 1) AS completed,
    count(*) FILTER (completed = 1 AND exit_status <> 0) AS failed
  FROM captured_containers WHERE {formed} GROUP BY 1) s""", "captured_containers")

    channel_fp = r"""
SELECT env_name, sha1(string_agg(spec, '-' ORDER BY channel, spec)) AS fp, CAST(split_part(env_name, '#', 2) AS INT) AS num FROM (
  SELECT env_name, arg_min(spec, pos) AS spec, false AS channel FROM packages GROUP BY env_name, split_part(spec, ' ', 1)
  UNION ALL SELECT DISTINCT env_name, spec, true FROM channels) x GROUP BY env_name"""
    q["channel_sets"] = with_views(f"""
SELECT s.env_name, s.fp, CASE WHEN s.fp IN (SELECT fp FROM ({channel_fp}) a WHERE num % 3 = 0) THEN 'reuse'
    WHEN s.fp IN (SELECT fp FROM ({channel_fp}) d WHERE num % 3 = 1) THEN 'zip' ELSE 'build' END AS action
FROM ({channel_fp}) s""", "packages", "channels")

    q["rest_admission"] = q["admission_check"]
    q["rest_completion"] = q["completion_summary"]

    return q
