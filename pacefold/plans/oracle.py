"""ANSI SQL for DuckDB, one text per registered query, over the same tables."""

from __future__ import annotations

from pacefold.feeds import ALERTS, READINGS, SUMMARIES
from pacefold.functions.messages import (
    ALERT_MESSAGES,
    GOAL_ACHIEVED,
    HIGH_HEART_RATE,
    LOW_ACTIVITY,
)
from pacefold.plans.fixtures import CALORIE_DECIMALS, TOPIC_PARTITIONS
from pacefold.plans.queries import AS_OF, STEP_GOAL, STREAMED_RATE, TOLD_TOLERANCE

_R, _S, _A = READINGS.topic, SUMMARIES.topic, ALERTS.topic
_HIGH, _LOW, _GOAL = (
    ALERT_MESSAGES[kind] for kind in (HIGH_HEART_RATE, LOW_ACTIVITY, GOAL_ACHIEVED)
)

_FEEDS = f"""
readings AS (
  SELECT 'user_' || CAST(user_id AS varchar) AS user_id,
         CAST(60 + event_id % 91 AS integer) AS heart_rate,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS integer) * 5 AS steps,
         value AS calories,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         date_trunc('second', ts) AS t,
         event_id AS k
  FROM events
),
daily AS (
  SELECT user_id, CAST(sum(steps) AS bigint) AS total_steps,
         round(sum(calories), {CALORIE_DECIMALS}) AS total_calories,
         sum(calories) AS calories_sum,
         CAST(round(avg(heart_rate)) AS integer) AS avg_heart_rate,
         substr("timestamp", 1, 10) AS "date", min(k) AS k
  FROM readings GROUP BY user_id, substr("timestamp", 1, 10)
),
alerts AS (
  SELECT 'user_' || CAST(user_id AS varchar) AS user_id,
         CASE event_type WHEN 'error' THEN '{HIGH_HEART_RATE}'
                         WHEN 'view' THEN '{LOW_ACTIVITY}'
                         ELSE '{GOAL_ACHIEVED}' END AS alert_type,
         CASE event_type WHEN 'error' THEN '{_HIGH}'
                         WHEN 'view' THEN '{_LOW}'
                         ELSE '{_GOAL}' END AS alert_message,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         event_id AS k
  FROM events WHERE event_type IN ('error', 'view', 'purchase')
),
closing AS (SELECT max(t) - INTERVAL 1 HOUR AS watermark FROM readings)
"""


def _sql(query: str, *tables: str) -> str:
    """A query after the feed definitions and any further common tables."""
    return "WITH " + ",".join([_FEEDS, *tables]) + query


def _id(topic: str) -> str:
    return (
        f"'{topic}:' || CAST(k % {TOPIC_PARTITIONS} AS varchar) || ':' "
        "|| CAST(k AS varchar) AS id"
    )


_READING_FIELDS = 'user_id, heart_rate, steps, round(calories, 9) AS calories, "timestamp"'
_DAILY_FIELDS = (
    "user_id, total_steps, round(total_calories, 9) AS total_calories, "
    'avg_heart_rate, "date"'
)
# The roll-up's own result, with the sum as it is.
_ROLLUP_FIELDS = (
    "user_id, total_steps, round(calories_sum, 9) AS total_calories, "
    'avg_heart_rate, "date"'
)
# Messages and stored tables carry 32-bit step totals.
_DAILY_MESSAGE = _DAILY_FIELDS.replace(
    "total_steps,", "CAST(total_steps AS integer) AS total_steps,", 1
)
_ALERT_FIELDS = 'user_id, alert_type, alert_message, "timestamp"'

_USER_STATS = """
SELECT user_id, count(*) AS total_records,
       round(avg(steps), 9) AS avg_steps,
       round(avg(calories), 9) AS avg_calories,
       round(avg(heart_rate), 9) AS avg_heart_rate,
       max(steps) AS max_steps, round(max(calories), 9) AS max_calories
FROM readings GROUP BY user_id
"""

_DAILY_TRENDS = """
SELECT substr("timestamp", 1, 10) AS "date",
       round(avg(steps), 9) AS avg_steps,
       round(avg(calories), 9) AS avg_calories,
       round(avg(heart_rate), 9) AS avg_heart_rate,
       count(*) AS total_records
FROM readings GROUP BY 1
"""

_USER_PERFORMANCE = """
SELECT user_id, round(avg(total_steps), 9) AS avg_daily_steps,
       round(avg(total_calories), 9) AS avg_daily_calories,
       round(avg(avg_heart_rate), 9) AS avg_heart_rate
FROM daily GROUP BY user_id
"""

_OVERALL = """
SELECT round(avg(total_steps), 9) AS avg_total_steps,
       max(total_steps) AS max_total_steps,
       round(avg(total_calories), 9) AS avg_total_calories,
       round(avg(avg_heart_rate), 9) AS overall_avg_heart_rate
FROM daily
"""

_ALERT_TYPES = """
SELECT alert_type, count(*) AS "count" FROM alerts GROUP BY alert_type
"""

_ROW_COUNTS = """
SELECT 'readings' AS table_name, count(*) AS row_count FROM readings
UNION ALL SELECT 'summaries', count(*) FROM daily
UNION ALL SELECT 'alerts', count(*) FROM alerts
"""

_USER_ALERTS = """
SELECT user_id, count(*) AS total_alerts, count(alert_type) AS typed_alerts,
       count(DISTINCT alert_type) AS unique_alert_types
FROM alerts GROUP BY user_id
"""

_BATCH_USER_STATS = """
SELECT user_id, round(avg(steps), 9) AS avg_steps,
       round(avg(calories), 9) AS avg_calories,
       round(avg(heart_rate), 9) AS avg_heart_rate
FROM readings GROUP BY user_id
"""

_HEALTH = """
SELECT round(avg(heart_rate), 9) AS avg_heart_rate,
       max(heart_rate) AS max_heart_rate, min(heart_rate) AS min_heart_rate
FROM readings
"""

_BOX = """
box AS (
  SELECT quantile_cont(total_steps, 0.25) AS q1,
         quantile_cont(total_steps, 0.5) AS median,
         quantile_cont(total_steps, 0.75) AS q3
  FROM daily
)
"""

_HOURLY = """
hourly AS (
  SELECT user_id, date_trunc('hour', t) AS h, count(*) AS readings,
         round(avg(heart_rate), 9) AS avg_heart_rate
  FROM readings GROUP BY 1, 2
)
"""

_SESSIONS = """
marked AS (
  SELECT user_id, t,
         CASE WHEN t <= lag(t) OVER w + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS starts
  FROM readings WINDOW w AS (PARTITION BY user_id ORDER BY t)
),
numbered AS (
  SELECT user_id, t, sum(starts) OVER (
           PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS session
  FROM marked
),
sessions AS (
  SELECT user_id, min(t) AS first_t, max(t) AS last_t, count(*) AS readings
  FROM numbered GROUP BY user_id, session
)
"""

_SESSION_FIELDS = """
SELECT user_id, strftime(first_t, '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(last_t + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end, readings
FROM sessions
"""

_HOURLY_FIELDS = """
SELECT user_id, strftime(h, '%Y-%m-%d %H:%M:%S') AS window_start, readings,
       avg_heart_rate
FROM hourly
"""

_GOALS = f"""
running AS (
  SELECT user_id, CAST(t AS date) AS d, t, sum(steps) OVER (
           PARTITION BY user_id, CAST(t AS date) ORDER BY t
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
  FROM readings
),
goals AS (
  SELECT user_id, d, min(t) AS t FROM running
  WHERE so_far >= {STEP_GOAL} GROUP BY user_id, d
)
"""

_CLOSED_DAILY = """
closed AS (
  SELECT daily.* FROM daily, closing
  WHERE CAST("date" AS timestamp) + INTERVAL 1 DAY <= watermark
)
"""

# The first run's readings say which days were closed when the second run came.
_LATE = f"""
marked AS (
  SELECT r.*, substr("timestamp", 1, 10) AS "date",
         r.heart_rate > {STREAMED_RATE} AND date_trunc('day', r.t) + INTERVAL 1 DAY <= first.watermark AS late
  FROM readings AS r,
       (SELECT max(t) - INTERVAL 1 HOUR AS watermark FROM readings
        WHERE heart_rate <= {STREAMED_RATE}) AS first, closing
  WHERE date_trunc('day', r.t) + INTERVAL 1 DAY <= closing.watermark
),
told AS (
  SELECT user_id, CAST(sum(steps) AS bigint) AS total_steps,
         round(sum(calories), 9) AS total_calories,
         CAST(round(avg(heart_rate)) AS integer) AS avg_heart_rate, "date"
  FROM marked WHERE NOT late GROUP BY user_id, "date"
),
tardy AS (
  SELECT user_id, "date", count(*) AS late_readings FROM marked WHERE late GROUP BY ALL
)
"""

# A second roll-up with the day cut from the event time instead of the text.
_WINDOWED_DAILY = """
streamed AS (SELECT * FROM readings),
windowed AS (
  SELECT user_id, CAST(sum(steps) AS bigint) AS total_steps,
         sum(calories) AS total_calories,
         CAST(round(avg(heart_rate)) AS integer) AS avg_heart_rate,
         strftime(date_trunc('day', t), '%Y-%m-%d') AS "date"
  FROM streamed, closing
  WHERE date_trunc('day', t) + INTERVAL 1 DAY <= watermark
  GROUP BY user_id, date_trunc('day', t)
),
compared AS (
  SELECT coalesce(b.user_id, s.user_id) AS user_id,
         coalesce(b."date", s."date") AS "date",
         b.total_steps AS batch_total_steps, s.total_steps AS stream_total_steps,
         b.calories_sum AS batch_total_calories,
         s.total_calories AS stream_total_calories,
         b.avg_heart_rate AS batch_avg_heart_rate,
         s.avg_heart_rate AS stream_avg_heart_rate,
         b."date" IS NOT NULL AS in_batch, s."date" IS NOT NULL AS in_stream,
         b.total_steps IS NOT DISTINCT FROM s.total_steps
           AND b.avg_heart_rate IS NOT DISTINCT FROM s.avg_heart_rate
           AND coalesce(abs(b.calories_sum - s.total_calories) < 0.000001, false) AS matches
  FROM closed b FULL JOIN windowed s
    ON b.user_id = s.user_id AND b."date" = s."date"
)
"""

_ALL_STREAMED = "streamed AS (SELECT * FROM readings"

_DIFFERENCES = """
SELECT user_id, "date", batch_total_steps, stream_total_steps,
       round(batch_total_calories, 9) AS batch_total_calories,
       round(stream_total_calories, 9) AS stream_total_calories,
       batch_avg_heart_rate, stream_avg_heart_rate
FROM compared WHERE NOT matches
"""

_HIGH_RATE = f"""
SELECT user_id, '{HIGH_HEART_RATE}' AS alert_type, '{_HIGH}' AS alert_message, "timestamp"
FROM readings WHERE heart_rate > 100
"""

_GOAL_ALERTS = f"""
SELECT user_id, '{GOAL_ACHIEVED}' AS alert_type, '{_GOAL}' AS alert_message,
       strftime(t, '%Y-%m-%d %H:%M:%S') AS "timestamp"
FROM goals
"""

_PAIRED = """
paired AS (SELECT user_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS next_t
           FROM readings)
"""

_LOW_ALERTS = f"""
SELECT user_id, '{LOW_ACTIVITY}' AS alert_type, '{_LOW}' AS alert_message,
       strftime(t, '%Y-%m-%d %H:%M:%S') AS "timestamp"
FROM paired
WHERE coalesce(next_t, TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}') > t + INTERVAL 1 HOUR
"""

_FLAWED = """
flawed AS (
  SELECT event_type, 'user_' || CAST(user_id AS varchar) AS user_id, event_id AS k
  FROM events
)
"""


def oracle() -> dict[str, str]:
    stored = {
        "stored_readings": f"SELECT {_id(_R)}, {_READING_FIELDS} FROM readings",
        "stored_summaries": f"SELECT {_id(_S)}, {_DAILY_MESSAGE} FROM daily",
        "stored_alerts": f"SELECT {_id(_A)}, {_ALERT_FIELDS} FROM alerts",
    }
    decoded = {
        "decode_readings": f"SELECT {_READING_FIELDS}, '{_R}' AS topic FROM readings",
        "decode_summaries": f"SELECT {_DAILY_MESSAGE}, '{_S}' AS topic FROM daily",
        "decode_alerts": f"SELECT {_ALERT_FIELDS}, '{_A}' AS topic FROM alerts",
    }
    return {
        **{name: _sql(query) for name, query in {**stored, **decoded}.items()},
        "user_stats": _sql(_USER_STATS),
        "batch_job_user_stats": _sql(_USER_STATS),
        "top_users": _sql(
            f"SELECT * FROM ({_USER_STATS} ORDER BY avg(steps) DESC NULLS LAST, user_id "
            "LIMIT 20)"
        ),
        "daily_trends": _sql(_DAILY_TRENDS),
        "batch_job_daily_trends": _sql(_DAILY_TRENDS),
        **dict.fromkeys(
            ("user_performance", "batch_job_user_performance"),
            _sql(_USER_PERFORMANCE),
        ),
        **dict.fromkeys(
            ("overall_daily_stats", "batch_job_overall_daily_stats"),
            _sql(_OVERALL),
        ),
        **dict.fromkeys(
            ("alert_type_distribution", "batch_job_alert_type_distribution"),
            _sql(_ALERT_TYPES),
        ),
        "user_alert_distribution": _sql(_USER_ALERTS),
        "batch_job_user_alert_distribution": _sql(_USER_ALERTS),
        **dict.fromkeys(
            ("table_row_counts", "batch_job_table_row_counts"), _sql(_ROW_COUNTS)
        ),
        "batch_user_stats": _sql(_BATCH_USER_STATS),
        "stream_batch_user_stats": _sql(_BATCH_USER_STATS),
        "health_snapshot": _sql(_HEALTH),
        "stream_health_snapshot": _sql(_HEALTH),
        "daily_summary_view": _sql(f"SELECT {_DAILY_FIELDS} FROM daily"),
        "daily_summary_rollup": _sql(f"SELECT {_ROLLUP_FIELDS} FROM daily"),
        "stream_daily_summary": _sql(
            f"SELECT {_ROLLUP_FIELDS} FROM closed", _CLOSED_DAILY
        ),
        "late_corrected_daily": _sql(f"SELECT {_ROLLUP_FIELDS} FROM closed", _CLOSED_DAILY),
        "late_told_daily": _sql("SELECT * FROM told", _LATE),
        "late_corrections": _sql(
            "SELECT told.*, -1 AS sign, late_readings FROM told JOIN tardy USING (user_id, \"date\") "
            f"UNION ALL SELECT {_ROLLUP_FIELDS}, 1, late_readings "
            "FROM closed JOIN tardy USING (user_id, \"date\")",
            _CLOSED_DAILY,
            _LATE,
        ),
        "alert_view": _sql(f"SELECT {_ALERT_FIELDS} FROM alerts"),
        **dict.fromkeys(
            ("recent_alerts", "stream_recent_alerts"),
            _sql(
                f"SELECT {_ALERT_FIELDS} FROM alerts "
                'ORDER BY "timestamp" DESC, user_id, alert_type LIMIT 20'
            ),
        ),
        **dict.fromkeys(("decode_flawed", "dedup_flawed"), _sql(
            f"SELECT {_id(_R)}, CASE WHEN event_type IN ('click', 'view') THEN user_id END "
            "AS user_id, CAST(CASE WHEN event_type = 'click' THEN 70 END AS integer) "
            "AS heart_rate, CAST(NULL AS integer) AS steps, "
            "CAST(NULL AS double) AS calories, CAST(NULL AS varchar) AS \"timestamp\", "
            f"'{_R}' AS topic FROM flawed",
            _FLAWED,
        )),
        "quarantine": _sql(
            f"SELECT {_id(_R)}, CASE event_type "
            """WHEN 'view' THEN '{"user_id":"' || user_id || '","heart_rate":"70"}' """
            """WHEN 'error' THEN '{"user_id":"' || user_id || '","heart_ra' """
            "WHEN 'signup' THEN '' END AS value, "
            f"'{_R}' AS topic, "
            "CASE event_type WHEN 'view' THEN 'partial' "
            "ELSE 'undecodable' END AS grade FROM flawed WHERE event_type <> 'click'",
            _FLAWED,
        ),
        "publish_envelope": _sql(
            """SELECT '{"user_id":"' || user_id || '","heart_rate":' || heart_rate """
            """|| ',"steps":' || steps || ',"calories":' || calories """
            """|| ',"timestamp":"' || "timestamp" || '"}' AS value, """
            f"'{_R}' AS topic FROM readings "
            """UNION ALL SELECT '{"user_id":"' || user_id || '","total_steps":' """
            """|| total_steps || ',"total_calories":' || total_calories """
            """|| ',"avg_heart_rate":' || avg_heart_rate """
            f"""|| ',"date":"' || "date" || '"}}', '{_S}' FROM daily """
            """UNION ALL SELECT '{"user_id":"' || user_id || '","alert_type":"' """
            """|| alert_type || '","alert_message":"' || alert_message """
            f"""|| '","timestamp":"' || "timestamp" || '"}}', '{_A}' FROM alerts"""
        ),
        "combined_stream": _sql(
            f"SELECT {_READING_FIELDS}, NULL AS total_steps, NULL AS total_calories, "
            'NULL AS avg_heart_rate, NULL AS "date", NULL AS alert_type, '
            f"NULL AS alert_message, '{_R}' AS topic FROM readings "
            f"UNION ALL BY NAME SELECT {_DAILY_MESSAGE}, '{_S}' AS topic FROM daily "
            f"UNION ALL BY NAME SELECT {_ALERT_FIELDS}, '{_A}' AS topic FROM alerts"
        ),
        "topic_routing": _sql(
            f"SELECT '{_R}' AS topic, '{READINGS.table}' AS target_table, "
            "count(*) AS row_count FROM readings "
            f"UNION ALL SELECT '{_S}', '{SUMMARIES.table}', count(*) FROM daily "
            f"UNION ALL SELECT '{_A}', '{ALERTS.table}', count(*) FROM alerts"
        ),
        **dict.fromkeys(
            ("dedup_readings", "stored_without_positions", "stored_two_checkpoints"),
            _sql(f"SELECT {_READING_FIELDS} FROM readings"),
        ),
        **dict.fromkeys(
            ("compacted_readings", "read_during_compaction"),
            _sql(f"SELECT {_READING_FIELDS}, 2 * count(*) AS copies FROM readings GROUP BY ALL"),
        ),
        **dict.fromkeys(
            ("dedup_late_files", "dedup_new_checkpoint"),
            _sql(f"SELECT {_READING_FIELDS}, count(*) AS copies FROM readings GROUP BY ALL"),
        ),
        "read_as_of_version": _sql(
            f"SELECT {_READING_FIELDS} FROM readings WHERE heart_rate <= {STREAMED_RATE}"
        ),
        "stream_summary_view": _sql(
            f"SELECT {_DAILY_MESSAGE} FROM daily ORDER BY \"date\" DESC, user_id LIMIT 20"
        ),
        "dedup_batch": _sql(f"SELECT {_id(_R)}, {_READING_FIELDS} FROM readings"),
        "chart_heart_rate_histogram": _sql(
            "SELECT CAST(b AS integer) AS bin, "
            "round(low + b * (high - low) / 20.0, 9) AS bin_start, "
            "round(low + (b + 1) * (high - low) / 20.0, 9) AS bin_end, "
            'count(x.bin) AS "count" FROM range(20) AS bins(b) '
            "CROSS JOIN bounds LEFT JOIN x ON x.bin = b GROUP BY b, low, high",
            "bounds AS (SELECT CAST(min(heart_rate) AS double) AS low, "
            "CAST(max(heart_rate) AS double) AS high FROM readings)",
            "x AS (SELECT least(19, floor((heart_rate - low) * 20.0 / (high - low))) "
            "AS bin FROM readings, bounds)",
        ),
        "chart_steps_calories": _sql(
            'SELECT steps AS x, round(calories, 9) AS y, count(*) AS "count" '
            "FROM readings GROUP BY steps, calories"
        ),
        "chart_daily_steps_calories": _sql(
            'SELECT total_steps AS x, round(total_calories, 9) AS y, count(*) AS "count" '
            "FROM daily GROUP BY 1, 2"
        ),
        "chart_steps_boxplot": _sql(
            "SELECT round(q1, 9) AS q1, round(median, 9) AS median, round(q3, 9) AS q3, "
            "round(least(q1, min(total_steps) FILTER "
            "(WHERE total_steps >= q1 - 1.5 * (q3 - q1))), 9) AS whisker_low, "
            "round(greatest(q3, max(total_steps) FILTER "
            "(WHERE total_steps <= q3 + 1.5 * (q3 - q1))), 9) AS whisker_high "
            "FROM daily, box GROUP BY q1, median, q3",
            _BOX,
        ),
        "chart_steps_outliers": _sql(
            'SELECT user_id, "date", total_steps FROM daily, box '
            "WHERE total_steps < q1 - 1.5 * (q3 - q1) "
            "OR total_steps > q3 + 1.5 * (q3 - q1)",
            _BOX,
        ),
        "chart_alert_types": _sql(
            'SELECT alert_type AS "key", count(*) AS "count" FROM alerts '
            "WHERE alert_type IS NOT NULL GROUP BY alert_type"
        ),
        "chart_user_alerts": _sql(
            'SELECT user_id AS "key", count(*) AS "count" FROM alerts '
            "WHERE user_id IS NOT NULL GROUP BY user_id"
        ),
        "running_user_stats": _sql(_USER_STATS),
        "running_daily_trends": _sql(_DAILY_TRENDS),
        "running_health_snapshot": _sql(_HEALTH),
        "running_user_performance": _sql(_USER_PERFORMANCE),
        "running_user_alerts": _sql(_USER_ALERTS),
        "running_alert_users": _sql(
            "SELECT alert_type, count(*) AS alerts, count(DISTINCT user_id) AS users, "
            "true AS sketch_is_near FROM alerts GROUP BY alert_type"
        ),
        "hourly_user_stats": _sql(_HOURLY_FIELDS, _HOURLY),
        "stream_hourly_user_stats": _sql(
            _HOURLY_FIELDS + ", closing WHERE h + INTERVAL 1 HOUR <= watermark", _HOURLY
        ),
        "alert_high_heart_rate": _sql(_HIGH_RATE),
        "stream_high_heart_rate": _sql(_HIGH_RATE),
        "alert_low_activity": _sql(
            "SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS \"timestamp\", "
            "strftime(next_t, '%Y-%m-%d %H:%M:%S') AS next_timestamp FROM paired "
            "WHERE next_t > t + INTERVAL 1 HOUR",
            _PAIRED,
        ),
        "alert_low_activity_messages": _sql(_LOW_ALERTS, _PAIRED),
        "derived_alert_feed": _sql(
            f"{_HIGH_RATE} UNION ALL {_LOW_ALERTS} UNION ALL {_GOAL_ALERTS}", _PAIRED, _GOALS
        ),
        "activity_sessions": _sql(_SESSION_FIELDS, _SESSIONS),
        "stream_activity_sessions": _sql(
            _SESSION_FIELDS + ", closing WHERE last_t + INTERVAL 1 HOUR <= watermark",
            _SESSIONS,
        ),
        "stream_low_activity": _sql(
            f"SELECT user_id, '{LOW_ACTIVITY}' AS alert_type, '{_LOW}' AS alert_message, "
            "strftime(last_t, '%Y-%m-%d %H:%M:%S') AS \"timestamp\" "
            "FROM sessions, closing WHERE last_t + INTERVAL 1 HOUR <= watermark",
            _SESSIONS,
        ),
        "alert_goal_achieved": _sql(
            "SELECT user_id, strftime(d, '%Y-%m-%d') AS \"date\", "
            "strftime(t, '%Y-%m-%d %H:%M:%S') AS \"timestamp\" FROM goals",
            _GOALS,
        ),
        "stream_goal_achieved": _sql(
            "SELECT user_id, strftime(d, '%Y-%m-%d') AS \"date\", "
            "strftime(t, '%Y-%m-%d %H:%M:%S') AS \"timestamp\" "
            "FROM goals, closing WHERE t + INTERVAL 1 SECOND <= watermark",
            _GOALS,
        ),
        "alert_goal_messages": _sql(_GOAL_ALERTS, _GOALS),
        "reconcile_daily": _sql(_DIFFERENCES, _CLOSED_DAILY, _WINDOWED_DAILY),
        "reconcile_differing": _sql(
            _DIFFERENCES, _CLOSED_DAILY, _WINDOWED_DAILY
        ).replace(_ALL_STREAMED, f"{_ALL_STREAMED} WHERE heart_rate <= {STREAMED_RATE}"),
        "stream_reconcile": _sql(
            'SELECT user_id, "date", r.total_steps AS readings_total_steps, '
            "CAST(d.total_steps AS integer) AS summaries_total_steps, "
            "round(r.total_calories, 9) AS readings_total_calories, "
            "round(d.total_calories, 9) AS summaries_total_calories, "
            "r.avg_heart_rate AS readings_avg_heart_rate, d.avg_heart_rate AS summaries_avg_heart_rate "
            'FROM daily AS d FULL JOIN reached AS r USING (user_id, "date"), both_closed '
            'WHERE CAST("date" AS timestamp) + INTERVAL 1 DAY <= watermark AND (r.total_steps = d.total_steps '
            "AND r.avg_heart_rate = d.avg_heart_rate AND abs(r.total_calories - d.total_calories) "
            f"<= greatest(1, abs(r.total_calories), abs(d.total_calories)) * {TOLD_TOLERANCE}) IS NOT TRUE",
            "reached AS (SELECT user_id, substr(\"timestamp\", 1, 10) AS \"date\", "
            "CAST(sum(steps) AS bigint) AS total_steps, sum(calories) AS total_calories, "
            "CAST(round(avg(heart_rate)) AS integer) AS avg_heart_rate, max(t) AS newest "
            f"FROM readings WHERE heart_rate <= {STREAMED_RATE} GROUP BY ALL)",
            "both_closed AS (SELECT least(max(reached.newest), max(CAST(daily.\"date\" AS timestamp))) "
            "- INTERVAL 1 HOUR AS watermark FROM reached FULL JOIN daily USING (user_id, \"date\"))",
        ),
        "reconcile_report": _sql(
            'SELECT "date", count(*) FILTER (WHERE in_batch) AS batch_rows, '
            "count(*) FILTER (WHERE in_stream) AS stream_rows, "
            "count(*) FILTER (WHERE matches) AS matching_rows, "
            "count(*) FILTER (WHERE matches IS NOT TRUE) AS differing_rows "
            'FROM compared GROUP BY "date"',
            _CLOSED_DAILY,
            _WINDOWED_DAILY,
        ),
    }
