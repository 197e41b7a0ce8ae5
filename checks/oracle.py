"""SQL, on the plain test tables, for every registered query.

Each text is the CTEs a query needs plus its own SELECT. Sums are cast back to BIGINT because the
checking engine widens them.
"""

LOOKBACK_DAYS = 7

_CTES = {
    "raw": """
        SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
          CASE event_type WHEN 'view' THEN 'edit' WHEN 'click' THEN 'edit'
            WHEN 'purchase' THEN 'new' WHEN 'signup' THEN 'log' ELSE 'categorize' END AS type,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id % 5 = 0 END AS bot,
          event_id % 3 = 0 AS minor,
          'user_' || CAST(user_id AS VARCHAR) AS "user",
          (['en.wikipedia.org', 'www.wikidata.org', 'commons.wikimedia.org', 'de.wikipedia.org',
            'fr.wiktionary.org', 'ja.wikipedia.org', 'localhost'])
            [1 + CAST((event_id * 7 + user_id) % 7 AS INT)] AS server_name,
          CASE event_id % 8 WHEN 0 THEN 'Talk:Page_' WHEN 2 THEN 'User:Page_'
            WHEN 4 THEN 'Template:Page_' ELSE 'Page_' END
            || CAST(event_id % 200 AS VARCHAR) AS title,
          CAST(event_id % 16 AS INT) AS namespace,
          CAST(regexp_extract(props, '[0-9]+') AS INT) * 10 AS len_old,
          CAST(floor(value * 10) AS INT) AS len_new,
          CASE WHEN event_type = 'signup' THEN replace(props, ' ', '') END AS log_params
        FROM events""",
    # Everything the enrichment adds, before the noise filter.
    "derived": """
        SELECT *, bot AS is_bot, minor AS is_minor, type = 'new' AS is_new_page,
          CAST(abs(len_new - len_old) AS BIGINT) AS bytes_changed,
          CASE WHEN server_name LIKE '%.%' THEN split_part(server_name, '.', 1) END AS language,
          CASE WHEN server_name LIKE '%.%' THEN split_part(server_name, '.', 2) END AS project
        FROM raw""",
    "enriched": "SELECT * FROM derived WHERE type IN ('edit', 'new', 'log')",
    "recent": """
        SELECT * FROM enriched
        WHERE "timestamp" >= (SELECT max("timestamp") FROM enriched) - 7 * 86400""",
    "hourly": """
        SELECT date_trunc('hour', make_timestamp("timestamp" * 1000000)) AS hour_bucket, *
        FROM enriched""",
    "changes": """
        SELECT make_timestamp("timestamp" * 1000000) AS event_time, "user", title, server_name,
          coalesce(bot, false) AS is_bot, type, bytes_changed,
          CAST(len_new - len_old AS BIGINT) AS length_diff, id
        FROM enriched""",
    "asked": f"""
        SELECT * FROM changes
        WHERE event_time >= (SELECT max(event_time) FROM changes)
                            - INTERVAL '{LOOKBACK_DAYS}' DAY""",
    "asked_30min": """
        SELECT * FROM changes
        WHERE event_time >= (SELECT max(event_time) FROM changes) - INTERVAL '30' MINUTE""",
    "traffic": """
        SELECT make_timestamp(w * 10000000) AS window_start, total_bytes, event_count,
          total_bytes / event_count AS avg_bytes_per_event
        FROM (SELECT "timestamp" // 10 AS w, CAST(sum(bytes_changed) AS BIGINT) AS total_bytes,
                count(*) AS event_count FROM enriched GROUP BY 1)""",
    "traffic_hourly": """
        SELECT hour_bucket AS window_start, CAST(sum(bytes_changed) AS BIGINT) AS total_bytes,
          count(*) AS event_count, sum(bytes_changed) / count(*) AS avg_bytes_per_event
        FROM hourly GROUP BY 1""",
    "asked_traffic": f"""
        SELECT * FROM traffic
        WHERE window_start >= (SELECT max(event_time) FROM changes)
                              - INTERVAL '{LOOKBACK_DAYS}' DAY
        ORDER BY window_start DESC LIMIT 500""",
    "lines": """
        SELECT *, id % 50 = 0 AS broken, id % 50 = 1 AS comment FROM raw""",
    "delivered": "SELECT * FROM lines WHERE NOT broken AND NOT comment",
}

_BASE = {
    "raw": [],
    "derived": ["raw"],
    "enriched": ["derived"],
    "recent": ["enriched"],
    "hourly": ["enriched"],
    "changes": ["enriched"],
    "asked": ["changes"],
    "asked_30min": ["changes"],
    "traffic": ["enriched"],
    "traffic_hourly": ["hourly"],
    "asked_traffic": ["traffic", "changes"],
    "lines": ["raw"],
    "delivered": ["lines"],
}


def _needed(name: str, seen: list[str]) -> list[str]:
    for base in _BASE[name]:
        _needed(base, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _with(ctes: str, select: str) -> str:
    seen: list[str] = []
    for name in ctes.split():
        _needed(name, seen)
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in seen) + "\n" + select


_RAW_COLUMNS = """id, "timestamp", type, bot, minor, "user", server_name, title,
    CAST(namespace AS {namespace}) AS namespace, log_params, len_old, len_new"""
_DERIVED = "id, {bot} AS is_bot, is_minor, is_new_page, bytes_changed, language, project"
_KEPT_NULL = _DERIVED.format(bot="is_bot")
_NO_NULL = _DERIVED.format(bot="coalesce(is_bot, false)")
_LAKE = """id, make_timestamp("timestamp" * 1000000) AS "timestamp", type, "user", server_name,
    title, is_bot, is_new_page, bytes_changed, language, project, log_params,
    false AS timestamp_imputed,
    CAST(year(make_timestamp("timestamp" * 1000000)) AS INTEGER) AS year,
    CAST(month(make_timestamp("timestamp" * 1000000)) AS INTEGER) AS month"""
_LAKE_ALL = _with("enriched", f"SELECT {_LAKE} FROM enriched")
_CHANGES = """event_time, "user", title, server_name, is_bot, type, bytes_changed, length_diff"""
_TRAFFIC = "window_start, total_bytes, event_count, avg_bytes_per_event"


# The malformed payloads of the feed.
_BROKEN = """'{"id": N', '{"id": N, "log_params": {"a": ', '{"id": N} trailing',
    '{"id": N} {"id": N}', '{''id'': N}', '[N]', 'N', '"N"', 'null', '{N}', '{"id": N}]'"""


def _patterns(literal: bool) -> str:
    bots, humans = (
        ("count(is_bot)", "count(is_bot)")
        if literal
        else ("count(*) FILTER (is_bot)", "count(*) FILTER (NOT is_bot)")
    )
    return _with(
        "hourly",
        f"""SELECT hour_bucket, count(*) AS total_events,
          CAST(sum(bytes_changed) AS BIGINT) AS total_bytes, avg(bytes_changed) AS avg_bytes,
          {bots} AS bot_events, {humans} AS human_events
        FROM hourly GROUP BY 1 ORDER BY 1""",
    )


def _trends(literal: bool, frame: str) -> str:
    counts = (
        ("count(is_bot)", "count(type)", "count(type)")
        if literal
        else (
            "count(*) FILTER (is_bot)",
            "count(*) FILTER (type = 'new')",
            "count(*) FILTER (type = 'edit')",
        )
    )
    return _with(
        "hourly",
        f"""SELECT *, avg(total_events) OVER w AS events_24h_avg,
          avg(total_bytes) OVER w AS bytes_24h_avg
        FROM (SELECT hour_bucket, count(*) AS total_events,
            CAST(sum(bytes_changed) AS BIGINT) AS total_bytes, {counts[0]} AS bot_count,
            {counts[1]} AS new_pages, {counts[2]} AS edits FROM hourly GROUP BY 1)
        WINDOW w AS (ORDER BY hour_bucket {frame})""",
    )


_ROWS = "ROWS BETWEEN 23 PRECEDING AND CURRENT ROW"
_RANGE = "RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW"


def _contributors(literal: bool, limit: int) -> str:
    pages = "count(is_new_page)" if literal else "count(*) FILTER (is_new_page)"
    return _with(
        "enriched",
        f"""SELECT "user", is_bot, count(*) AS edit_count,
          CAST(sum(bytes_changed) AS BIGINT) AS total_bytes, {pages} AS pages_created
        FROM enriched GROUP BY 1, 2
        ORDER BY edit_count DESC, "user" NULLS FIRST, is_bot NULLS FIRST LIMIT {limit}""",
    )


def _languages(literal: bool, limit: str = "") -> str:
    bots, pages = (
        ("count(is_bot)", "count(is_new_page)")
        if literal
        else ("count(*) FILTER (is_bot)", "count(*) FILTER (is_new_page)")
    )
    return _with(
        "enriched",
        f"""SELECT language, project, count(*) AS edit_count,
          CAST(sum(bytes_changed) AS BIGINT) AS total_bytes, {bots} AS bot_edits,
          {pages} AS new_pages
        FROM enriched GROUP BY 1, 2
        ORDER BY edit_count DESC, language NULLS FIRST, project NULLS FIRST {limit}""",
    )


def _servers(limit: int, events: str = "enriched") -> str:
    return _with(
        events,
        f"""SELECT * FROM (
          SELECT *, CAST(row_number() OVER (ORDER BY edit_count DESC, server_name) AS INTEGER)
              AS rank,
            percent_rank() OVER (ORDER BY edit_count DESC) AS percentile
          FROM (SELECT server_name, language, project, count(*) AS edit_count,
              CAST(sum(bytes_changed) AS BIGINT) AS total_bytes,
              count(DISTINCT "user") AS unique_users
            FROM {events} GROUP BY 1, 2, 3))
        WHERE rank <= {limit}""",
    )


def _count_of(table: str, select: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS row_count FROM ({select})"


_HISTORY_COUNTS = [
    _count_of("historical_hourly_patterns", "SELECT DISTINCT hour_bucket FROM hourly"),
    _count_of("historical_hourly_trends", "SELECT DISTINCT hour_bucket FROM hourly"),
    _count_of(
        "historical_top_contributors",
        'SELECT DISTINCT "user", is_bot FROM enriched LIMIT 100',
    ),
    _count_of("historical_language_distribution", "SELECT DISTINCT language, project FROM enriched"),
    _count_of("historical_server_rankings", "SELECT DISTINCT server_name FROM enriched LIMIT 50"),
]
_LIVE_COUNTS = [
    _count_of("realtime_traffic_volume", "SELECT * FROM traffic"),
    _count_of("realtime_recent_changes", "SELECT * FROM changes"),
]


def _fresh(table: str, select: str) -> str:
    return f"""SELECT '{table}' AS table_name, max(t) AS latest,
        CAST(epoch((SELECT max(event_time) FROM changes)) - epoch(max(t)) AS BIGINT) AS age_seconds
        FROM ({select})"""


_SPIKES = f"""SELECT hour_bucket, total_events, events_24h_avg,
      total_events / events_24h_avg AS spike_ratio
    FROM (SELECT *, avg(total_events) OVER (ORDER BY hour_bucket {_ROWS}) AS events_24h_avg
      FROM (SELECT hour_bucket, count(*) AS total_events FROM hourly GROUP BY 1))"""

_RECENT = f"SELECT {_CHANGES}, id FROM asked ORDER BY event_time DESC, id DESC LIMIT 400"


def _severity(source: str) -> str:
    return _with(
        source,
        f"""SELECT CASE WHEN abs(bytes_changed) > 1000 THEN 'Major'
            WHEN abs(bytes_changed) > 100 THEN 'Moderate' ELSE 'Minor' END AS edit_type,
          count(*) AS total_count FROM {source} GROUP BY 1""",
    )


def _top_servers(source: str, limit: int = 12) -> str:
    return _with(
        source,
        f"""SELECT server_name, count(*) AS total_edits,
          CAST(sum(abs(bytes_changed)) AS BIGINT) AS total_bytes
        FROM {source} GROUP BY 1 ORDER BY total_edits DESC, server_name LIMIT {limit}""",
    )


def _namespaces(limit: int) -> str:
    return _with(
        "asked",
        f"""SELECT split_part(title, ':', 1) AS namespace, count(*) AS total_count
        FROM asked WHERE title LIKE '%:%' GROUP BY 1
        ORDER BY total_count DESC, namespace LIMIT {limit}""",
    )


def _live_languages(limit: int) -> str:
    return _with(
        "asked",
        f"""SELECT split_part(server_name, '.', 1) AS language, count(*) AS total_count,
          CAST(sum(abs(bytes_changed)) AS BIGINT) AS total_bytes
        FROM asked GROUP BY 1 ORDER BY total_count DESC, language LIMIT {limit}""",
    )


_USERS = 'SELECT "user", count(*) AS total_edits FROM asked GROUP BY 1'
_POWER_USERS = f"{_USERS} HAVING count(*) >= 10"


# What each list of the live page counts: its name, key, second key and moved bytes.
_COUNTERS = [
    ("server", "server_name", "NULL", "bytes_changed"),
    ("page", "title", "server_name", "bytes_changed"),
    ("action", "type", "NULL", "bytes_changed"),
    (
        "severity",
        """CASE WHEN abs(bytes_changed) > 1000 THEN 'Major'
          WHEN abs(bytes_changed) > 100 THEN 'Moderate' ELSE 'Minor' END""",
        "NULL",
        "bytes_changed",
    ),
    ("change", "CASE WHEN length_diff >= 0 THEN 'Addition' ELSE 'Deletion' END", "NULL", "length_diff"),
    ("namespace", "split_part(title, ':', 1)", "NULL", "bytes_changed"),
    ("language", "split_part(server_name, '.', 1)", "NULL", "bytes_changed"),
]


def _lists() -> str:
    counters = "\nUNION ALL ".join(
        f"""SELECT '{name}' AS dimension,
          {"date_trunc('minute', event_time)" if name == "action" else "CAST(NULL AS TIMESTAMP)"} AS minute,
          {key} AS key, CAST({key_2} AS VARCHAR) AS key_2, abs({moved}) AS moved FROM asked
        {"WHERE title LIKE '%:%'" if name == "namespace" else ""}"""
        for name, key, key_2, moved in _COUNTERS
    )
    return _with(
        "asked",
        f"""SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY dimension ORDER BY minute DESC NULLS LAST,
            CASE WHEN dimension <> 'action' THEN edits END DESC NULLS LAST,
            key NULLS FIRST, key_2 NULLS FIRST) AS INTEGER) AS place
          FROM (SELECT dimension, minute, key, key_2, count(*) AS edits,
              CAST(sum(moved) AS BIGINT) AS moved FROM ({counters}) GROUP BY ALL))
        WHERE place <= CASE dimension WHEN 'action' THEN 500 WHEN 'namespace' THEN 20 ELSE 12 END""",
    )


def all_oracles() -> dict[str, str]:
    all_changes = _with("changes", f"SELECT {_CHANGES} FROM changes")
    traffic = _with("traffic", f"SELECT {_TRAFFIC} FROM traffic")
    traffic_hourly = _with("traffic_hourly", f"SELECT {_TRAFFIC} FROM traffic_hourly")
    count_windows = _with(
        "enriched",
        """SELECT make_timestamp(max("timestamp") * 1000000) AS window_start,
          CAST(sum(bytes_changed) AS BIGINT) AS total_bytes, count(*) AS event_count,
          sum(bytes_changed) / count(*) AS avg_bytes_per_event
        FROM (SELECT *, row_number() OVER (PARTITION BY id % 3 ORDER BY id) - 1 AS n FROM enriched)
        GROUP BY id % 3, n // 100 HAVING count(*) = 100""",
    )
    deduplicated = """SELECT id, type, "user", title, bytes_changed FROM enriched"""
    return {
        # ingest
        "sse_parse": _with(
            "delivered", f"SELECT {_RAW_COLUMNS.format(namespace='VARCHAR')} FROM delivered"
        ),
        "sse_rejects": _with(
            "lines",
            f"""SELECT replace(([{_BROKEN}])[1 + (id // 50) % 11], 'N', CAST(id AS VARCHAR))
              AS payload, 'malformed' AS reject_reason
            FROM lines WHERE broken""",
        ),
        "max_messages": _with(
            "enriched", "SELECT id, type, title, bytes_changed FROM enriched ORDER BY id LIMIT 500"
        ),
        "ingest_stats": _with(
            "lines",
            """SELECT count(*) AS seen, count(*) FILTER (broken) AS failed,
              count(*) FILTER (NOT broken AND type = 'categorize') AS skipped,
              count(*) FILTER (NOT broken AND type <> 'categorize') AS sent
            FROM lines WHERE NOT comment""",
        ),
        "filter_events": _with(
            "enriched", f"SELECT {_RAW_COLUMNS.format(namespace='INTEGER')} FROM enriched"
        ),
        "filter_events_talk_ids": _with(
            "enriched", "SELECT id, type, namespace FROM enriched WHERE namespace % 2 = 0"
        ),
        "enrich_events": _with("derived", f"SELECT {_NO_NULL} FROM derived"),
        "normalize_events": _with(
            "enriched",
            f"""SELECT {_RAW_COLUMNS.format(namespace='INTEGER')},
              coalesce(is_bot, false) AS is_bot, is_minor,
              is_new_page, bytes_changed, language, project, false AS timestamp_imputed
            FROM enriched WHERE id % 50 NOT IN (0, 1)""",
        ),
        "kafka_records": _with(
            "enriched", "SELECT server_name AS key, id, bytes_changed, len_new FROM enriched"
        ),
        "kafka_decode": _with(
            "enriched",
            f"""SELECT CAST(id % 3 AS INTEGER) AS "partition", id // 3 AS "offset", "timestamp",
              type, "user", server_name, {_KEPT_NULL} FROM enriched""",
        ),
        "project_analytics": _with(
            "enriched",
            """SELECT "timestamp", type, "user", server_name, title, namespace, bot, is_bot,
              is_minor, is_new_page, bytes_changed, language, project, len_old, len_new
            FROM enriched""",
        ),
        "project_full": _with(
            "enriched",
            f"""SELECT id, "timestamp", type, bot, minor, "user", server_name, title, namespace,
              is_bot, is_minor, is_new_page, bytes_changed, language, project,
              (SELECT string_agg(key || '=' || json_extract_string(log_params, '$.' || key), ','
                ORDER BY key) FROM unnest(json_keys(log_params)) AS t(key)) AS log_params
            FROM enriched""",
        ),
        "project_minimal": _with(
            "enriched", 'SELECT "user", bot, type, server_name, "timestamp" FROM enriched'
        ),
        "dedup_events": _with("enriched", deduplicated),
        # lake
        "lake_roundtrip": _LAKE_ALL,
        "lake_compact": _LAKE_ALL,
        "lake_scan": _with(
            "enriched",
            f"""SELECT {_LAKE} FROM enriched
            WHERE "timestamp" >= (SELECT max("timestamp") FROM enriched) - 7 * 86400""",
        ),
        "lake_backfill": _LAKE_ALL,
        "lake_scan_future": _with(
            "enriched",
            f"""SELECT * EXCLUDE (year, month) FROM (SELECT {_LAKE} FROM enriched
            WHERE "timestamp" >= (SELECT max("timestamp") FROM enriched) - 7 * 86400)""",
        ),
        "lake_scan_daily": _with(
            "enriched",
            f"""SELECT * EXCLUDE (year, month) FROM (SELECT {_LAKE} FROM enriched
            WHERE "timestamp" >= (SELECT max("timestamp") FROM enriched) - 7 * 86400)""",
        ),
        "lake_scan_empty": _with("enriched", f"SELECT {_LAKE} FROM enriched WHERE false"),
        # historical views
        "hourly_patterns": _patterns(False),
        "hourly_patterns_literal": _patterns(True),
        "hourly_trends": _trends(False, _ROWS),
        "hourly_trends_literal": _trends(True, _ROWS),
        "hourly_trends_range": _trends(False, _RANGE),
        "top_contributors": _contributors(False, 100),
        "top_contributors_literal": _contributors(True, 100),
        "top_contributors_top20": _contributors(False, 20),
        "language_distribution": _languages(False),
        "language_distribution_literal": _languages(True),
        "server_rankings": _servers(50),
        "server_rankings_top3": _servers(3),
        "batch_run": _with("hourly", "\nUNION ALL ".join(_HISTORY_COUNTS)),
        "hist_read_trends": _trends(False, _ROWS),
        "hist_read_patterns": _patterns(False),
        "hist_read_languages": _languages(False, "LIMIT 20"),
        "hist_read_servers": _servers(15),
        "hist_read_contributors": _contributors(False, 50),
        # live tables and queries
        "recent_changes": _with("changes", f"SELECT {_CHANGES}, id FROM changes"),
        "traffic_volume": traffic,
        "traffic_volume_hourly": traffic_hourly,
        "traffic_count_window": count_windows,
        "stream_count_window": count_windows,
        "live_traffic": _with("asked_traffic", f"SELECT {_TRAFFIC} FROM asked_traffic"),
        "live_velocity": _with(
            "asked_traffic",
            """SELECT window_start, CAST(event_count AS DOUBLE) / 10 AS events_per_second,
              event_count FROM asked_traffic""",
        ),
        "live_servers": _top_servers("asked"),
        "live_servers_30min": _top_servers("asked_30min"),
        "live_leaderboard": _with(
            "asked",
            """SELECT title, server_name AS "Server", count(*) AS "Edits",
              CAST(sum(abs(bytes_changed)) AS BIGINT) AS "Bytes"
            FROM asked GROUP BY 1, 2 ORDER BY 3 DESC, title, server_name LIMIT 12""",
        ),
        "live_actions": _with(
            "asked",
            """SELECT date_trunc('minute', event_time) AS window_start, type AS action_type,
              count(*) AS action_count
            FROM asked GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 500""",
        ),
        "live_severity": _severity("asked"),
        "live_severity_30min": _severity("asked_30min"),
        "live_volume_change": _with(
            "asked",
            """SELECT CASE WHEN length_diff >= 0 THEN 'Addition' ELSE 'Deletion' END AS change_type,
              CAST(sum(abs(length_diff)) AS BIGINT) AS total_bytes, count(*) AS "count"
            FROM asked GROUP BY 1""",
        ),
        "live_namespaces": _namespaces(20),
        "live_namespaces_top2": _namespaces(2),
        "live_languages": _live_languages(12),
        "live_languages_top3": _live_languages(3),
        "live_servers_top3": _top_servers("asked", 3),
        "hist_read_languages_top3": _languages(False, "LIMIT 3"),
        "hist_read_servers_top3": _servers(3),
        "live_users": _with("asked", _USERS),
        "live_page_lists": _lists(),
        "live_page_users": _with("asked", _USERS),
        "live_page_traffic": _with("asked_traffic", f"SELECT {_TRAFFIC} FROM asked_traffic"),
        "live_power_users": _with("asked", _POWER_USERS),
        "live_user_histogram": _with(
            "asked",
            f"""SELECT ((total_edits - low) * 20) // (high - low + 1) AS bin, count(*) AS users
            FROM (SELECT total_edits, min(total_edits) OVER () AS low,
                max(total_edits) OVER () AS high FROM ({_POWER_USERS}))
            GROUP BY 1""",
        ),
        "live_recent": _with("asked", _RECENT),
        "live_battlefield": _with(
            "asked",
            f"""SELECT id, event_time, length_diff,
              greatest(5, least(500, abs(bytes_changed))) AS impact,
              CASE WHEN length_diff > 0 THEN 'Addition' ELSE 'Deletion' END AS direction,
              title, "user", server_name FROM ({_RECENT})""",
        ),
        "live_kpis": _with(
            "asked_traffic asked",
            """SELECT CAST(sum(event_count) AS BIGINT) AS total_events,
              CAST(sum(total_bytes) AS BIGINT) AS total_bytes,
              CAST(sum(total_bytes) AS DOUBLE) / 1048576 AS total_mb,
              CAST(arg_max(event_count, window_start) AS DOUBLE) / 10 AS current_velocity,
              (SELECT server_name FROM asked GROUP BY 1 ORDER BY count(*) DESC, server_name LIMIT 1)
                AS top_server
            FROM asked_traffic""",
        ),
        "live_sql": _with(
            "asked",
            """SELECT server_name, type, count(*) AS total_edits FROM asked
            GROUP BY 1, 2 HAVING count(*) >= 2""",
        ),
        # monitors
        "live_avg_change": _with(
            "asked",
            "SELECT server_name, avg(abs(bytes_changed)) AS avg_change FROM asked GROUP BY 1",
        ),
        "keyword_monitor": _with(
            "changes",
            f"""SELECT {_CHANGES}, id FROM changes
            WHERE lower(title) LIKE '%template%' OR lower("user") LIKE '%template%'
              OR contains(lower(title), 'user_7') OR contains(lower("user"), 'user_7')""",
        ),
        "hourly_spikes": _with("hourly", _SPIKES),
        "hourly_spikes_over": _with(
            "hourly", f"SELECT * FROM ({_SPIKES}) WHERE spike_ratio >= 1.5"
        ),
        "silence_gaps": _with(
            "changes",
            """SELECT gap_start, gap_end,
              CAST((epoch(gap_end) - epoch(gap_start)) // 60 AS BIGINT) AS gap_minutes
            FROM (SELECT lag(m) OVER (ORDER BY m) AS gap_start, m AS gap_end
              FROM (SELECT DISTINCT date_trunc('minute', event_time) AS m FROM changes))
            WHERE gap_end - gap_start >= INTERVAL '5' MINUTE""",
        ),
        "silence_now": _with(
            "changes",
            """SELECT date_trunc('minute', max(event_time)) AS gap_start,
              CAST(NULL AS TIMESTAMP) AS gap_end, CAST(8 AS BIGINT) AS gap_minutes FROM changes""",
        ),
        "freshness": _with(
            "traffic changes hourly",
            "\nUNION ALL ".join(
                [
                    _fresh("realtime_traffic_volume", "SELECT window_start AS t FROM traffic"),
                    _fresh("realtime_recent_changes", "SELECT event_time AS t FROM changes"),
                    _fresh("historical_hourly_patterns", "SELECT hour_bucket AS t FROM hourly"),
                    _fresh("historical_hourly_trends", "SELECT hour_bucket AS t FROM hourly"),
                ]
            ),
        ),
        "table_counts": _with(
            "traffic changes hourly", "\nUNION ALL ".join(_LIVE_COUNTS + _HISTORY_COUNTS)
        ),
        "incremental_hours": _patterns(False),
        "incremental_late_file": _patterns(False),
        "server_users_sketch": _servers(50),
        "incremental_tables_hourly_patterns": _patterns(False),
        "incremental_tables_hourly_trends": _trends(False, _ROWS),
        "incremental_tables_top_contributors": _contributors(False, 100),
        "incremental_tables_language_distribution": _languages(False),
        "incremental_tables_server_rankings": _servers(50),
        "incremental_lookback": _servers(50, "recent"),
        # streaming
        "stream_recent_changes": all_changes,
        "stream_traffic": traffic,
        "stream_traffic_hourly": traffic_hourly,
        "stream_traffic_fold": traffic_hourly,
        "stream_late_data": _with(
            "changes",
            """SELECT window_start, CAST(sum(bytes_changed) AS BIGINT) AS total_bytes,
              count(*) AS event_count, sum(bytes_changed) / count(*) AS avg_bytes_per_event
            FROM (SELECT *, date_trunc('hour', event_time) AS window_start FROM changes)
            WHERE id % 20 <> 0 OR window_start + INTERVAL '1' HOUR >
              (SELECT max(event_time) FROM changes WHERE id % 20 <> 0) - INTERVAL '10' SECOND
            GROUP BY 1""",
        ),
        "stream_dedup": _with(
            "enriched",
            """SELECT id, make_timestamp("timestamp" * 1000000) AS event_time, type, "user",
              title, bytes_changed FROM enriched""",
        ),
        "archive_dedup": _with(
            "enriched",
            """SELECT id, make_timestamp("timestamp" * 1000000) AS event_time, type, "user",
              title, bytes_changed FROM enriched""",
        ),
        "stream_heavy_pages": _with(
            "changes",
            """SELECT title, server_name AS "Server", count(*) AS "Edits",
              CAST(sum(abs(bytes_changed)) AS BIGINT) AS "Bytes"
            FROM changes GROUP BY 1, 2 ORDER BY 3 DESC, title, server_name LIMIT 12""",
        ),
        "stream_heavy_users": _with(
            "changes",
            """SELECT "user", count(*) AS total_edits FROM changes GROUP BY 1
            ORDER BY 2 DESC, 1 LIMIT 12""",
        ),
        "stream_archive": _LAKE_ALL,
        "live_sink": traffic,
        "live_fold": traffic,
        "pipeline_live": _with(
            "enriched",
            """SELECT 'changes' AS table_name, count(*) AS rows,
              CAST(sum(bytes_changed) AS BIGINT) AS bytes FROM enriched WHERE id % 50 <> 0
            UNION ALL SELECT 'traffic', count(DISTINCT "timestamp" // 10),
              CAST(sum(bytes_changed) AS BIGINT) FROM enriched WHERE id % 50 <> 0
            UNION ALL SELECT 'rejects', 2 * count(*), 0 FROM enriched WHERE id % 50 = 0""",
        ),
        "retention_24h": _with(
            "changes",
            f"""SELECT {_CHANGES} FROM changes
            WHERE event_time >= (SELECT max(event_time) FROM changes) - INTERVAL '24' HOUR""",
        ),
    }
