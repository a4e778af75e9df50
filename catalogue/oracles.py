"""The same answers in plain SQL, for comparison with another engine.

Written from the rules' meaning, one rule at a time, not from the plans.
"""

from __future__ import annotations

from catalogue import standins as st

VIEWING = st.as_sql(st.VIEWING, "events")
ACCOUNT = st.as_sql(st.ACCOUNT, "orders")
CHANNEL = st.as_sql(st.CHANNEL, "events")


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


def _day(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


def _days(first: str, last: str) -> str:
    """All days from first to last, as numbers."""
    return (
        "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS day, CAST(d AS DATE) AS date "
        f"FROM generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY) AS g(d)"
    )


def _improper(column: str, length: str) -> str:
    return (
        f"({column} IS NULL OR length({column}) < {length} "
        f"OR upper({column}) IN ('NULL', 'UNKNOWN', '', 'NA', 'N/A'))"
    )


def _category(percent: str) -> str:
    return (
        f"CASE WHEN abs({percent}) < 5 THEN 'lessThan5Percent' "
        f"WHEN abs({percent}) < 10 THEN '5to9percent' "
        f"WHEN abs({percent}) <= 15 THEN '10to15percent' ELSE 'GreaterThan15Percent' END"
    )


PERCENT = "((20000 * bad + total) // (2 * total)) / 100.0"

VIEWING_SEGMENT = """
    CASE WHEN upper(r.businessLine) IN ('DIRECT-NOW', 'DTVNOW')
         THEN ((v.business_line = 'OTT' AND v.source_system = 'QUICKPLAY')
               OR (v.business_line = 'ATT-OTT' AND v.source_system = 'OMNITURE'))
              AND v.viewing_platform = r.viewMode AND upper(v.channel_tune_type) = r.viewType
         WHEN r.viewMode = 'STB'
         THEN v.business_line = r.businessLine AND v.viewing_platform = 'STB'
              AND upper(v.channel_tune_type) = r.viewType
         ELSE v.business_line = r.businessLine AND v.viewing_platform != 'STB'
              AND upper(v.channel_tune_type) = r.viewType END
"""
ACCOUNT_SEGMENT = "v.business_line = r.businessLine AND v.status = r.viewMode"
LINE_SEGMENT = "v.business_line = r.businessLine"


def _quality(rules, source, table, day, segment, columns, first, last, extra="") -> str:
    """Rules of one table as (rule columns) x days with counts, percent and category."""
    value = "CASE r.dataQualityColumn " + " ".join(
        f"WHEN '{c}' THEN CAST(v.{c} AS VARCHAR)" for c in columns
    ) + " END"
    return f"""
    WITH v AS (SELECT *, {_day(day)} AS day FROM ({source})),
    r AS (SELECT DISTINCT environment, databaseName, viewMode, businessLine, viewType,
                 dataQualityColumn, coalesce(priority, 'HIGHPRIORITYCOLUMN') AS priority,
                 coalesce(CAST(columnLength AS INTEGER), 1) AS n, given
          FROM (VALUES {_values(rules)}) AS t(environment, databaseName, given, businessLine,
               viewMode, viewType, dataQualityColumn, priority, columnLength)
          WHERE priority IS NULL OR upper(priority) IN ('HIGHPRIORITYCOLUMN'{extra})),
    days AS ({_days(first, last)}),
    m AS (SELECT r.given, r.businessLine, r.viewMode, r.viewType, r.dataQualityColumn, r.n, v.day,
                 count(*) AS total, count(*) FILTER (WHERE {_improper(value, 'r.n')}) AS bad
          FROM r JOIN v ON {segment} GROUP BY ALL),
    f AS (SELECT r.*, d.day, coalesce(m.total, 0) AS total, coalesce(m.bad, 0) AS bad
          FROM r CROSS JOIN days d
          LEFT JOIN m ON m.day = d.day AND m.given = r.given AND m.businessLine = r.businessLine
               AND m.viewMode IS NOT DISTINCT FROM r.viewMode
               AND m.viewType IS NOT DISTINCT FROM r.viewType
               AND m.dataQualityColumn = r.dataQualityColumn AND m.n = r.n)
    SELECT environment, databaseName, '{table}' AS tableName,
           CAST(viewMode AS VARCHAR) AS viewMode, businessLine, CAST(viewType AS VARCHAR) AS viewType,
           dataQualityColumn, CAST(bad AS BIGINT) AS improperColumnCount,
           CASE WHEN total > 0 THEN {PERCENT} END AS improperColumnPercent,
           CAST(total AS BIGINT) AS totalColumnCount,
           CASE WHEN total = 0 THEN 'GreaterThan15Percent'
                ELSE {_category('(bad * 100.0 / total)')} END AS category,
           priority, day AS partitionDate
    FROM f
    """


def _viewing_quality() -> str:
    return _quality(
        st.VIEWING_RULES, VIEWING, "EV_VIEWING_HISTORY", "program_watch_start_dt_local",
        VIEWING_SEGMENT, ["ban", "series_id", "device_id", "client_id"], "2023-12-30", "2024-02-02",
    )


def _segment_rows(source: str, day: str, test: str) -> str:
    return (
        f"SELECT {_day(day)} AS partitionDate, count(*) AS n FROM ({source}) AS v "
        f"WHERE {test} GROUP BY 1"
    )


STREAMING = """((business_line = 'OTT' AND source_system = 'QUICKPLAY')
    OR (business_line = 'ATT-OTT' AND source_system = 'OMNITURE')) AND viewing_platform = 'STB'"""
WATCHED = "program_watch_start_dt_local"


def _drift(kind: str, day_count: str, baseline: str) -> str:
    """Difference and category from a day count and a nullable baseline."""
    difference = f"CAST(trunc(({day_count} - {baseline}) / {baseline} * 100.0) AS BIGINT)"
    percent = f"CASE WHEN {baseline} > 0 THEN {difference} END"
    return f"""
           coalesce({baseline}, 0.0) AS averageRecordCount,
           {percent} AS {kind},
           CASE WHEN {baseline} IS NULL OR {baseline} = 0 THEN 'noBaseline'
                ELSE {_category(difference)} END AS category
    """


def _column_consistency(baseline: str, first="2024-01-16", last="2024-02-01", on="") -> str:
    """Channel columns over a run; ``baseline`` gives (status, col, average), ``on`` its day."""
    return f"""
    WITH v AS (SELECT *, {_day('data_dt')} AS day FROM ({CHANNEL})),
    cells AS (SELECT day, status, 'channel_name' AS col, channel_name AS val FROM v
              UNION ALL SELECT day, status, 'channel_key', CAST(channel_key AS VARCHAR) FROM v),
    counts AS (SELECT day, status, col,
                      count(DISTINCT val) + max(CASE WHEN val IS NULL THEN 1 ELSE 0 END) AS n
               FROM cells GROUP BY ALL),
    r AS (SELECT s.status, c.col FROM (VALUES ('click'), ('view'), ('purchase')) AS s(status),
          (VALUES ('channel_name'), ('channel_key')) AS c(col)),
    days AS ({_days(first, last)}),
    baseline AS ({baseline}),
    f AS (SELECT r.status, r.col, d.day, coalesce(c.n, 0) AS n, b.average
          FROM r CROSS JOIN days d
          LEFT JOIN counts c ON c.day = d.day AND c.status = r.status AND c.col = r.col
          LEFT JOIN baseline b ON b.status = r.status AND b.col = r.col {on})
    SELECT 'prod' AS environment, 'gold' AS databaseName, 'EV_CHANNEL' AS tableName,
           status AS viewMode, 'EVENTS' AS businessLine, CAST(NULL AS VARCHAR) AS viewType,
           col AS columnConsistencyField, CAST(n AS BIGINT) AS dayCount,
           {_drift('columnConsistencyPercentDiff', 'n', 'average')}, day AS partitionDate
    FROM f
    """


# Two logged runs per day of January before the 16th; the 7th has none.
LOGGED = f"""
    SELECT event_type AS status, {_day('ts')} AS day,
           count(DISTINCT CASE WHEN value < 60 THEN user_id END) AS early,
           count(DISTINCT user_id) AS late
    FROM events WHERE ts < TIMESTAMP '2024-01-16' AND {_day('ts')} != 20240107 GROUP BY ALL
"""


def _total_consistency(first: str, last: str, window: str, days: str, by="", on="") -> str:
    """``window`` gives the counts that a baseline sums, ``days`` the number of days it is shared by."""
    return f"""
    WITH v AS (SELECT *, {_day('data_dt')} AS day FROM ({ACCOUNT})),
    r AS (SELECT * FROM (VALUES ('SATELLITE', 'Active', 'LIVE'), ('OTT', 'Pending', NULL),
          ('CABLE', 'Suspended', 'VOD')) AS t(businessLine, viewMode, viewType)),
    days AS ({_days(first, last)}),
    counts AS (SELECT business_line, status, day, count(*) AS n FROM v GROUP BY ALL),
    baseline AS (SELECT business_line, status, CAST(sum(n) AS DOUBLE) / {days} AS average {by} FROM ({window}) GROUP BY ALL),
    f AS (SELECT r.*, d.day, coalesce(c.n, 0) AS n, b.average
          FROM r CROSS JOIN days d
          LEFT JOIN counts c ON c.day = d.day AND c.business_line = r.businessLine
               AND c.status = r.viewMode
          LEFT JOIN baseline b ON b.business_line = r.businessLine AND b.status = r.viewMode {on})
    SELECT 'prod' AS environment, 'gold' AS databaseName, 'EV_ACCOUNT' AS tableName,
           viewMode, businessLine, viewType, CAST(n AS BIGINT) AS dayCount,
           {_drift('totalConsistencyPercentDiff', 'n', 'average')}, day AS partitionDate
    FROM f
    """


def _duplicates(source, day, table, where, labels, keys, having, listed) -> str:
    return f"""
    SELECT 'prod' AS environment, 'gold' AS databaseName, '{table}' AS tableName, {labels},
           '{listed}' AS selectColumns, '{having}' AS duplicateCheckColumn,
           count(*) AS duplicateCount, partitionDate
    FROM (SELECT {_day(day)} AS partitionDate, {keys} FROM ({source}) AS v WHERE {where}
          GROUP BY ALL HAVING count({having}) > 1)
    GROUP BY partitionDate
    """


def _viewing_duplicates() -> str:
    queries = []
    for key in ("ban", "device_id"):
        for line, mode, kind in (
            ("SATELLITE", "STB", "LIVE"), ("SATELLITE", "TVE", "LIVE"), ("SATELLITE", "OTT", "LIVE"),
            ("CABLE", "STB", "DVR"),
        ):
            platform = "= 'STB'" if mode == "STB" else "!= 'STB'"
            queries.append(_duplicates(
                VIEWING, WATCHED, "EV_VIEWING_HISTORY",
                f"business_line = '{line}' AND viewing_platform {platform} "
                f"AND upper(channel_tune_type) = '{kind}'",
                f"'{mode}' AS viewMode, '{line}' AS businessLine, '{kind}' AS viewType",
                f"{key}, program_watch_start_time_local", "business_line",
                f"{key}, program_watch_start_time_local",
            ))
    return " UNION ALL ".join(queries)


def _satellite_duplicates() -> str:
    return _duplicates(
        VIEWING, WATCHED, "EV_VIEWING_HISTORY",
        "business_line = 'SATELLITE' AND viewing_platform = 'STB' AND upper(channel_tune_type) = 'LIVE'",
        "'STB' AS viewMode", "ban", "business_line", "ban")


def _line_duplicates(flags, havings, keys, listed, table) -> str:
    return " UNION ALL ".join(
        _duplicates(
            "SELECT *, nullif(l_linestatus, 'F') AS kept_status FROM lineitem", "l_shipdate",
            table, f"l_returnflag = '{flag}'",
            f"'{flag}' AS viewMode, 'any' AS businessLine, CAST(NULL AS VARCHAR) AS viewType",
            keys, having, listed,
        )
        for flag in flags for having in havings
    )


# The order tree's rows.
TREE = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
           CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderstatus AS status,
           CASE WHEN o_orderpriority < '3' THEN '020' ELSE '19980102' END AS load_dt
    FROM orders
"""

# Leaves of the mixed schema tree and their outcome.
LEAVES = """
    SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'Correct' ELSE 'Wrong' END AS schema_status,
           'status=' || o_orderstatus AS leaf FROM orders
"""


def _clean(text: str) -> tuple[str, str]:
    kept = f"regexp_replace({text}, '[^0-9.E-]', '', 'g')"
    number = f"TRY_CAST({kept} AS DOUBLE)"
    return (
        f"CASE WHEN {kept} = '' THEN 0 ELSE TRY_CAST({kept} AS INTEGER) END",
        f"CASE WHEN {kept} = '' THEN '0' WHEN {number} IS NOT NULL "
        f"THEN printf('%.2f', {number}) END",
    )


def oracles() -> dict[str, str]:
    viewing_day = _day(WATCHED)
    as_int, as_text = _clean("props")
    name_int, name_text = _clean("p_name")
    brand = "(p_brand || CASE WHEN p_type = 'ECONOMY' THEN '-E' ELSE '' END)"
    brand_int, brand_text = _clean(brand)
    improper_sql = "upper(ban) IN ('NULL', 'UNKNOWN', '', 'NA', 'N/A')"
    gated = [r for r in dict.fromkeys(st.VIEWING_RULES) if (r[7] or "high").lower().startswith("high")]
    log_rules = _values([(r[3], r[4], r[5], r[6], r[8] or "1") for r in gated])
    streams = "r.businessLine IN ('DTVNow', 'Direct-Now')"
    streaming_test = STREAMING.split(" AND viewing_platform")[0]
    streaming_text = " ".join(streaming_test.split()).replace("'", "''")
    return {
        "quality_viewing": _viewing_quality(),
        "quality_short_values": _quality(
            [("prod", "gold", "CHANNEL", "EVENTS", "click", None, "channel_name", None, "9")],
            CHANNEL, "EV_CHANNEL", "data_dt", ACCOUNT_SEGMENT, ["channel_name"],
            "2024-01-01", "2024-01-30",
        ),
        "quality_null_values": _quality(
            [("prod", "gold", "ev_account", line, status, None, "service_level",
              "mediumPriorityColumn", "6")
             for line in ("SATELLITE", "OTT") for status in ("Active", "Pending")],
            ACCOUNT, "EV_ACCOUNT", "data_dt", ACCOUNT_SEGMENT, ["service_level"],
            "1994-12-30", "2001-12-31", ", 'MEDIUMPRIORITYCOLUMN'",
        ),
        "quality_two_tables":
            "SELECT * FROM (" + _quality(
                [("prod", "gold", "a", "OTT", None, None, "service_level", None, "1")],
                ACCOUNT, "EV_CHANNEL_PROGRAM_SCHEDULE", "data_dt", LINE_SEGMENT,
                ["service_level"], "1994-12-30", "2001-12-31",
            ) + ") UNION ALL SELECT * FROM (" + _quality(
                [("prod", "gold", "b", "EVENTS", "any", "any", "channel_key", None, "3")],
                CHANNEL, "EV_ACCOUNT_PACKAGE_MARKET", "data_dt", LINE_SEGMENT,
                ["channel_key"], "1994-12-30", "2001-12-31",
            ) + ")",
        "improper_values": f"""
            SELECT lang, source,
                   count(*) FILTER (WHERE {_improper('text', '200')}) AS short_text,
                   count(*) FILTER (WHERE quality IS NULL) AS missing_quality,
                   count(*) FILTER (WHERE {_improper('CAST(n_chars AS VARCHAR)', '4')}) AS short_count,
                   count(*) AS n
            FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang, source""",
        "percent_categories": f"""
            SELECT day, bad, total, {PERCENT} AS percent,
                   {_category('(bad * 100.0 / total)')} AS category
            FROM (SELECT {_day('l_shipdate')} AS day,
                         count(*) FILTER (WHERE l_returnflag = 'R') AS bad, count(*) AS total
                  FROM lineitem GROUP BY 1)""",
        "priority_gate": """
            WITH p AS (SELECT p_brand, CASE p_type WHEN 'ECONOMY' THEN 3 WHEN 'MEDIUM' THEN 3
                              WHEN 'PROMO' THEN 2 WHEN 'LARGE' THEN 1 END AS rank,
                              CASE p_type WHEN 'STANDARD' THEN 3 WHEN 'ECONOMY' THEN 3
                              WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 2 WHEN 'LARGE' THEN 1
                              ELSE 0 END AS gate FROM part)
            SELECT p_brand, CAST(rank AS INTEGER) AS rank,
                   count(*) FILTER (WHERE gate >= 1) AS lowprioritycolumn,
                   count(*) FILTER (WHERE gate >= 2) AS mediumprioritycolumn,
                   count(*) FILTER (WHERE gate >= 3) AS highprioritycolumn, count(*) AS n
            FROM p GROUP BY p_brand, rank""",
        "table_resolution": """
            SELECT given, canonical, partition_column, count(*) AS n
            FROM customer JOIN (VALUES
                ('BUILDING', 'Viewership', 'EV_VIEWING_HISTORY', 'program_watch_start_dt_local'),
                ('FURNITURE', 'account', 'EV_ACCOUNT', 'data_dt'),
                ('MACHINERY', 'EV_Channel', 'EV_CHANNEL', 'data_dt'),
                ('HOUSEHOLD', 'ev_account_package_market', 'EV_ACCOUNT_PACKAGE_MARKET', 'data_dt'),
                ('AUTOMOBILE', 'sales', NULL, NULL))
                AS t(segment, given, canonical, partition_column) ON c_mktsegment = segment
            GROUP BY ALL""",
        "query_log": f"""
            WITH r AS (SELECT * FROM (VALUES {log_rules})
                       AS t(businessLine, viewMode, viewType, dataQualityColumn, n)),
            v AS (SELECT *, {viewing_day} AS day FROM ({VIEWING})),
            days AS ({_days('2023-12-30', '2024-02-02')})
            SELECT 'SELECT ' || dataQualityColumn || ' FROM gold.ev_viewing_history WHERE '
                   || 'program_watch_start_dt_local = ' || d.day || ' AND '
                   || CASE WHEN {streams} THEN '{streaming_text} AND viewing_platform = ''' || viewMode || ''''
                      ELSE 'business_line = ''' || businessLine || ''' AND viewing_platform '
                           || CASE WHEN viewMode = 'STB' THEN '= ''STB''' ELSE '!= ''STB''' END END
                   || ' AND upper(channel_tune_type) = ''' || viewType || ''' AND ('
                   || dataQualityColumn || ' IS NULL OR length(' || dataQualityColumn || ') < ' || n
                   || ' OR upper(' || dataQualityColumn
                   || ') IN (''NULL'', ''UNKNOWN'', '''', ''NA'', ''N/A''))' AS query,
                   'ColumnQuality' AS scenario, d.day AS executionDate,
                   20240201 AS logDate, dataQualityColumn,
                   (SELECT count(*) FROM v WHERE v.day = d.day
                    AND CASE WHEN {streams} THEN {streaming_test} AND v.viewing_platform = r.viewMode
                        ELSE v.business_line = r.businessLine
                             AND (r.viewMode = 'STB') = (v.viewing_platform = 'STB') END
                    AND upper(v.channel_tune_type) = r.viewType) AS totalColumnCount
            FROM r CROSS JOIN days d""",
        "stored_results": f"""
            SELECT q.partitionDate, l.logdate, 'ColumnQuality' AS scenario, count(*) AS n,
                   count(*) AS ids, CAST(sum(improperColumnCount) AS BIGINT) AS improper
            FROM ({_viewing_quality()}) q
            CROSS JOIN (VALUES (20240201), (20240202)) AS l(logdate)
            WHERE q.partitionDate BETWEEN 20240101 AND 20240131 GROUP BY ALL""",
        "rule_files": """
            SELECT DISTINCT 'prod' AS environment, 'gold' AS database, p_brand AS tableType,
                   p_type AS businessLine, nullif(p_type, 'PROMO') AS viewMode,
                   CAST(NULL AS VARCHAR) AS viewType, p_name AS dataQualityColumn,
                   'highPriorityColumn' AS priority, CAST(p_size AS VARCHAR) AS columnLength
            FROM part""",
        "segment_streaming": _segment_rows(
            VIEWING, WATCHED, f"{STREAMING} AND upper(channel_tune_type) = 'VOD'"),
        "segment_set_top_box": _segment_rows(
            VIEWING, WATCHED, "business_line = 'SATELLITE' AND viewing_platform = 'STB' "
            "AND upper(channel_tune_type) = 'LIVE'"),
        "segment_other_platforms": _segment_rows(
            VIEWING, WATCHED, "business_line = 'SATELLITE' AND viewing_platform != 'STB' "
            "AND upper(channel_tune_type) = 'LIVE'"),
        "segment_account": _segment_rows(
            ACCOUNT, "data_dt", "business_line = 'OTT' AND status = 'Active'"),
        "segment_package": _segment_rows(ACCOUNT, "data_dt", "business_line = 'SATELLITE'"),
        "row_count_per_day":
            f"SELECT {_day('o_orderdate')} AS partitionDate, count(*) AS n FROM orders GROUP BY 1",
        "overlapping_segments": " UNION ALL ".join(
            f"SELECT {viewing_day} AS partitionDate, CAST({i} AS INTEGER) AS segment, "
            f"count(*) AS n FROM ({VIEWING}) AS v WHERE {test} GROUP BY 1"
            for i, test in enumerate([
                "business_line = 'SATELLITE' AND viewing_platform = 'STB' AND upper(channel_tune_type) = 'LIVE'",
                "business_line = 'SATELLITE' AND viewing_platform != 'STB' AND upper(channel_tune_type) = 'LIVE'",
                "business_line = 'SATELLITE' AND viewing_platform != 'STB' AND upper(channel_tune_type) = 'LIVE'",
                "business_line = 'OTT' AND viewing_platform = 'STB' AND upper(channel_tune_type) = 'DVR'",
                f"{STREAMING} AND upper(channel_tune_type) = 'DVR'",
                "true",
            ])
        ),
        "distinct_per_day": " UNION ALL ".join(
            f"SELECT {_day('data_dt')} AS partitionDate, CAST({segment} AS INTEGER) AS segment, "
            f"CAST({column} AS INTEGER) AS \"column\", "
            f"count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) AS n "
            f"FROM ({ACCOUNT}) AS v WHERE {test} GROUP BY 1"
            for segment, test in enumerate(
                ["business_line = 'SATELLITE' AND status = 'Active'", "business_line = 'OTT'"])
            for column, name in enumerate(["service_level", "ban", "status"])
            if not (column == 2 and segment == 0)
        ),
        "column_consistency_source": _column_consistency(
            "SELECT status, col, CAST(sum(n) AS DOUBLE) / 30 AS average FROM counts "
            "WHERE day BETWEEN 20231217 AND 20240115 GROUP BY ALL"),
        "column_consistency_per_day": _column_consistency(
            f"SELECT status, 'channel_key' AS col, avg(late) AS average FROM ({LOGGED}) GROUP BY status"),
        "column_consistency_latest_row": _column_consistency(
            "SELECT status, 'channel_key' AS col, CAST(late AS DOUBLE) AS average "
            f"FROM ({LOGGED}) QUALIFY row_number() OVER (PARTITION BY status ORDER BY day DESC) = 1"),
        "column_consistency_daily": _column_consistency(
            "SELECT c.status, c.col, d.day, CAST(sum(c.n) AS DOUBLE) / 30 AS average FROM counts c JOIN days d "
            "ON strptime(CAST(c.day AS VARCHAR), '%Y%m%d') "
            "BETWEEN d.date - INTERVAL 30 DAY AND d.date - INTERVAL 1 DAY GROUP BY ALL",
            "2023-12-30", "2024-02-02", "AND b.day = d.day"),
        "total_consistency_daily": _total_consistency(
            "1994-12-30", "2001-12-31",
            """SELECT c.business_line, c.status, c.n, d.day AS on_day,
                      30 + day(last_day(CAST(d.date - INTERVAL 1 YEAR AS DATE))) AS n_days
               FROM (SELECT *, strptime(CAST(day AS VARCHAR), '%Y%m%d') AS date FROM counts) c
               JOIN days d ON c.date BETWEEN d.date - INTERVAL 30 DAY AND d.date - INTERVAL 1 DAY
                    OR c.date BETWEEN date_trunc('month', d.date - INTERVAL 1 YEAR)
                       AND last_day(CAST(d.date - INTERVAL 1 YEAR AS DATE))""",
            "any_value(n_days)", ", on_day", "AND b.on_day = d.day"),
        "total_consistency_filled": _total_consistency(
            "1994-12-30", "2001-12-31",
            """SELECT c.business_line, c.status, c.n, d.day AS on_day,
                      30 + day(last_day(CAST(d.date - INTERVAL 1 YEAR AS DATE))) AS n_days
               FROM (SELECT *, strptime(CAST(day AS VARCHAR), '%Y%m%d') AS date FROM counts) c
               JOIN days d ON c.date BETWEEN d.date - INTERVAL 30 DAY AND d.date - INTERVAL 1 DAY
                    OR c.date BETWEEN date_trunc('month', d.date - INTERVAL 1 YEAR)
                       AND last_day(CAST(d.date - INTERVAL 1 YEAR AS DATE))""",
            "any_value(n_days)", ", on_day", "AND b.on_day = d.day"),
        "total_consistency_source": _total_consistency(
            "1996-02-15", "2001-12-31",
            "SELECT * FROM counts WHERE day BETWEEN 19950201 AND 19950228 "
            "OR day BETWEEN 19960116 AND 19960214", "58"),
        "total_consistency_logged": _total_consistency(
            "1998-03-01", "2001-12-31",
            f"""SELECT s.business_line, s.status, d.day, coalesce(c.n, 0) AS n
                FROM (SELECT DISTINCT business_line, status FROM counts) s
                CROSS JOIN (SELECT * FROM ({_days('1997-03-01', '1997-03-31')})
                            UNION ALL SELECT * FROM ({_days('1998-01-30', '1998-02-28')})) d
                LEFT JOIN counts c ON c.business_line = s.business_line AND c.status = s.status
                     AND c.day = d.day""", "61"),
        "total_consistency_latest_row": _total_consistency(
            "1998-03-01", "1998-03-31",
            """SELECT s.business_line, s.status, coalesce(c.n, 0) AS n
               FROM (SELECT DISTINCT business_line, status FROM counts) s
               LEFT JOIN counts c ON c.business_line = s.business_line AND c.status = s.status
                    AND c.day = 19980228""", "1"),
        "baseline_of_source_and_log": f"""
            SELECT viewMode, average AS from_source, average AS from_log FROM (
                SELECT r.viewMode, CAST(count(v.day) AS DOUBLE) / 61 AS average
                FROM (VALUES ('SATELLITE', 'Active'), ('OTT', 'Pending'), ('CABLE', 'Suspended'))
                    AS r(businessLine, viewMode)
                LEFT JOIN (SELECT *, {_day('data_dt')} AS day FROM ({ACCOUNT})) v
                    ON v.business_line = r.businessLine AND v.status = r.viewMode
                    AND (v.day BETWEEN 19970301 AND 19970331 OR v.day BETWEEN 19980130 AND 19980228)
                GROUP BY r.viewMode)""",
        "large_differences": """
            SELECT o_custkey, count(*) * 2500000000 - 100 AS difference, 'GreaterThan15Percent' AS category
            FROM orders GROUP BY o_custkey""",
        "query_ids_of_all_checks": f"""
            SELECT scenario, CAST(2 * n AS BIGINT) AS n, CAST(2 * n AS BIGINT) AS ids FROM (
                SELECT 'ColumnQuality' AS scenario, count(*) AS n FROM ({_viewing_quality()})
                UNION ALL SELECT 'ColumnConsistencyCheck', 6 * count(*) FROM ({_days('2023-12-30', '2024-02-02')})
                UNION ALL SELECT 'TotalConsistencyCheck', 3 * count(*) FROM ({_days('1996-03-01', '1996-03-31')})
                UNION ALL SELECT 'DuplicateCheck', count(*) FROM ({_satellite_duplicates()}))
            WHERE n > 0""",
        "result_tables": f"""
            SELECT 'EV_ACCOUNT' AS tableName, status AS viewMode, businessLine, count(v.day) AS dayCount,
                   d.day AS partitionDate, 'TotalConsistencyCheck' AS scenario
            FROM (VALUES ('SATELLITE', 'Active'), ('OTT', 'Pending'), ('CABLE', 'Suspended'))
                AS r(businessLine, viewMode)
            CROSS JOIN ({_days('1996-03-01', '1996-03-31')}) d
            LEFT JOIN (SELECT business_line, status AS own, {_day('data_dt')} AS day FROM ({ACCOUNT})) v
                ON v.business_line = r.businessLine AND v.own = r.viewMode AND v.day = d.day
            CROSS JOIN LATERAL (SELECT r.viewMode AS status)
            GROUP BY ALL""",
        "merge_mixed_schemas": """
            SELECT o_orderstatus AS status, position, name, type, n AS load_rows, n AS merged_rows, true AS complete
            FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) JOIN (
                VALUES ('F', 0, 'o_orderkey', 'bigint'), ('F', 1, 'o_custkey', 'bigint'), ('F', 2, 'o_totalprice', 'double'),
                       ('O', 0, 'o_custkey', 'bigint'), ('O', 1, 'o_orderkey', 'bigint'), ('O', 2, 'o_totalprice', 'double'),
                       ('P', 0, 'o_orderkey', 'bigint'), ('P', 1, 'o_custkey', 'int'), ('P', 2, 'o_totalprice', 'double')
            ) AS t(status, position, name, type) ON o_orderstatus = status""",
        "partition_tree_default": """
            SELECT DISTINCT 'status=' || o_orderstatus || '/yr=' || year(o_orderdate) || '/' AS place
            FROM orders WHERE o_orderstatus != 'P'""",
        "total_no_baseline": _total_consistency(
            "1995-01-01", "2001-12-31", "SELECT * FROM counts WHERE day < 19950101", "61"),
        "latest_row_per_key": """
            SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
            QUALIFY row_number() OVER
                (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
        "date_bounds": f"""
            SELECT {_day('d')} AS day,
                   {_day("date_trunc('month', d - INTERVAL 1 YEAR)")} AS month_first,
                   {_day("last_day(CAST(d - INTERVAL 1 YEAR AS DATE))")} AS month_last,
                   {_day('d - INTERVAL 30 DAY')} AS trailing_first,
                   {_day('d - INTERVAL 1 DAY')} AS trailing_last
            FROM (SELECT DISTINCT o_orderdate AS d FROM orders)""",
        "day_ranges": f"""
            WITH o AS (SELECT o_custkey,
                              CAST(min(o_orderdate) FILTER (WHERE o_orderstatus = 'F') AS DATE) AS a,
                              CAST(max(o_orderdate) FILTER (WHERE o_orderstatus = 'O') AS DATE) AS b
                       FROM orders GROUP BY 1)
            SELECT o_custkey, CAST(CASE WHEN a <= b THEN b - a + 1 ELSE 0 END AS BIGINT) AS days,
                   CASE WHEN a <= b THEN {_day('b')} END AS last_day
            FROM o WHERE a IS NOT NULL AND b IS NOT NULL""",
        "duplicates_keys": _line_duplicates(
            "ANR", ["l_shipdate"], "l_orderkey, l_linenumber", "l_orderkey, l_linenumber", "LINEITEM"),
        "duplicates_null_having": _line_duplicates(
            "AR", ["kept_status", "l_orderkey"], "l_suppkey, l_linenumber",
            "l_suppkey,l_linenumber", "LINEITEM"),
        "duplicates_any_day": """
            SELECT CAST(0 AS INTEGER) AS partitionDate,
                   CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS segment,
                   count(*) AS n
            FROM (SELECT l_returnflag FROM lineitem GROUP BY l_returnflag, l_orderkey, l_linenumber
                  HAVING count(l_shipdate) > 1) GROUP BY l_returnflag""",
        "duplicates_viewing": _viewing_duplicates(),
        "grouped_count_like": f"""
            SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
            WHERE CAST({_day('o_orderdate')} AS VARCHAR) LIKE '1998%' GROUP BY ALL""",
        "count_compare": """
            WITH o AS (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority
                       FROM orders WHERE year(o_orderdate) BETWEEN 1990 AND 1999),
            l AS (SELECT o_orderstatus, priority, count(*) AS n FROM o GROUP BY ALL),
            r AS (SELECT o_orderstatus, priority, count(*) AS n FROM o
                  WHERE o_totalprice < 400000 AND o_orderstatus != 'F' GROUP BY ALL)
            SELECT coalesce(l.o_orderstatus, r.o_orderstatus) AS o_orderstatus,
                   coalesce(l.priority, r.priority) AS priority,
                   coalesce(l.n, 0) AS left_count, coalesce(r.n, 0) AS right_count,
                   coalesce(l.n, 0) - coalesce(r.n, 0) AS difference
            FROM l FULL JOIN r ON l.o_orderstatus IS NOT DISTINCT FROM r.o_orderstatus
                 AND l.priority IS NOT DISTINCT FROM r.priority""",
        "grouped_count_loads": f"""
            SELECT CAST(yr AS VARCHAR) AS yr, status, count(*) AS n, half FROM ({TREE})
            CROSS JOIN (VALUES ('loads'), ('merged')) AS h(half) GROUP BY ALL""",
        "merge_load_partitions": f"""
            SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, yr, status,
                   CAST(99999999 AS INTEGER) AS load_dt FROM ({TREE})""",
        "merge_in_place": f"""
            SELECT CAST(yr AS VARCHAR) AS yr, status, load_dt, count(*) AS n FROM ({TREE}) GROUP BY ALL
            UNION ALL
            SELECT CAST(yr AS VARCHAR), status, '99999999', count(*) FROM ({TREE}) GROUP BY ALL""",
        "merge_reconcile": f"""
            SELECT CAST(yr AS VARCHAR) AS yr, status, count(*) AS load_rows,
                   count(*) FILTER (WHERE yr < 2000) AS merged_rows, bool_and(yr < 2000) AS complete
            FROM ({TREE}) GROUP BY yr, status""",
        "merge_publish_outcomes": """
            SELECT concat('yr=', year(o_orderdate), '/status=', o_orderstatus, '/load_dt=99999999') AS leaf,
                   o.outcome, count(*) AS rows
            FROM orders JOIN (VALUES ('written', true), ('replaced', true), ('kept', false)) AS o(outcome, again)
                ON o.again = (CAST(year(o_orderdate) AS VARCHAR) LIKE '199%')
            GROUP BY ALL""",
        "schema_check_typed_directories": """
            WITH t(kind, type) AS (VALUES ('short', 'int'), ('long', 'bigint'), ('twenty', 'decimal(20,0)'),
                ('date', 'date'), ('time', 'timestamp'), ('mixed', 'string'), ('fraction', 'double'), ('no date', 'string'))
            SELECT a.kind AS reference, 'kind=' || b.kind AS leaf,
                   CASE WHEN a.type = b.type THEN 'Correct' ELSE 'Wrong' END AS schema_status
            FROM t a, t b WHERE EXISTS (SELECT 1 FROM orders)""",
        "merge_written_files": f"""
            SELECT 'yr=' || yr || '/status=' || status || '/load_dt=99999999' AS leaf,
                   count(*) AS "rows" FROM ({TREE}) GROUP BY ALL""",
        "schema_check": f"SELECT *, CAST(20240201060000 AS BIGINT) AS log_time FROM ({LEAVES})",
        "schema_check_stored": f"""
            SELECT schema_status, log_time, count(*) AS n FROM ({LEAVES})
            CROSS JOIN (VALUES (20240201060000), (20240201180000)) AS t(log_time) GROUP BY ALL""",
        "schema_failures": f"SELECT count(*) AS failed FROM ({LEAVES}) WHERE schema_status != 'Correct'",
        "schema_differences": """
            SELECT 'status=' || o_orderstatus AS leaf, side, CAST(position AS INTEGER) AS position,
                   name, type
            FROM (SELECT DISTINCT o_orderstatus FROM orders) JOIN (VALUES
                ('O', 'location', 0, 'o_custkey', 'bigint'), ('O', 'location', 1, 'o_orderkey', 'bigint'),
                ('O', 'reference', 0, 'o_orderkey', 'bigint'), ('O', 'reference', 1, 'o_custkey', 'bigint'),
                ('P', 'location', 1, 'o_custkey', 'int'), ('P', 'reference', 1, 'o_custkey', 'bigint'))
                AS t(status, side, position, name, type) ON o_orderstatus = status""",
        "schema_check_merged": f"""
            SELECT DISTINCT 'Correct' AS schema_status, 'yr=' || yr || '/status=' || status AS leaf
            FROM ({TREE}) WHERE yr BETWEEN 1990 AND 1999""",
        "partition_tree": f"""
            WITH t AS (SELECT 'yr=' || yr || '/' AS a, 'status=' || status || '/' AS b,
                              'load_dt=' || load_dt || '/' AS c FROM ({TREE})
                       WHERE yr BETWEEN 1990 AND 1999)
            SELECT DISTINCT 1 AS depth, a AS place FROM t
            UNION ALL SELECT DISTINCT 2, a || b FROM t
            UNION ALL SELECT DISTINCT 3, a || b || c FROM t""",
        "clean_numbers": f"SELECT event_id, {as_int} AS as_int, {as_text} AS as_text FROM events",
        "clean_names": f"""
            SELECT p_partkey, {name_int} AS name_int, {name_text} AS name_text,
                   {brand_int} AS brand_int, {brand_text} AS brand_text FROM part""",
    }
