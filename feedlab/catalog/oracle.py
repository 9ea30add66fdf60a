"""The named queries as SQL for DuckDB, written the long way round.

The texts follow the definitions (joins, distinct counts, cross joins with a
scalar, integrals of densities), not the plans of the library.
"""

from __future__ import annotations

import math

import numpy as np

from feedlab.catalog import parameters as p

# Fixed values, written out here so that a slip in the library shows.
METRICS = ["users_feed", "users_message", "views", "likes", "ctr"]
DAILY_MESSAGE = "Ключевые метрики за вчерашний день %s \nDAU %d\nПросмотры %d\nЛайки %d\nCTR %s"
APP_MESSAGE = ("Доброе утро,чат! Основные показатели приложения представлены в отчёте. \n"
               "Вчера к нам пришло %d новых юзеров\n"
               "Retention первого дня вчера составил %s%%\n"
               "Основную информацию об аудитории см. в прикреплённом файле.\n"
               "Хорошего рабочего дня!")
ALERT_MESSAGE = ("ALERT❗️Метрика %s:\n   - текущее значение %s;\n"
                 "   - отклонение от предыдущего значения %s%%")

COUNTERS = ["views", "likes", "messages_sent", "messages_received", "users_sent", "users_received"]


def hash15(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


EXP_GROUP = f"CAST({hash15("'exp:' || CAST(user_id AS VARCHAR)")} % 5 AS INTEGER)"

LOGS = f"""
feed AS (
  SELECT event_id, user_id, ts AS time,
         CASE WHEN ts >= TIMESTAMP '2024-01-15' AND exp_group = 2 AND event_id % 3 = 0
                   AND event_type = 'click' THEN 'view'
              WHEN ts >= TIMESTAMP '2024-01-15' AND exp_group = 3 AND event_id % 3 = 0
                   AND event_type = 'view' THEN 'like'
              WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action,
         CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
         CAST(user_id % 2 AS INTEGER) AS gender,
         CAST(18 + (user_id % 4) * 10 AS INTEGER) AS age,
         CASE WHEN user_id % 5 < 2 THEN 'ads' ELSE 'organic' END AS source,
         exp_group
  FROM (SELECT *, {EXP_GROUP} AS exp_group FROM events WHERE event_type IN ('view', 'click')) e),
messages AS (
  SELECT event_id, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS reciever_id,
         ts AS time,
         CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
         CAST(user_id % 2 AS INTEGER) AS gender,
         CAST(18 + (user_id % 4) * 10 AS INTEGER) AS age
  FROM events WHERE event_type IN ('signup', 'purchase'))"""


def query(body: str, *steps: str) -> str:
    return "WITH " + ",\n".join([LOGS, *steps]) + "\n" + body


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def six(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + CAST(0 AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


DATE = "CAST(time AS DATE)"
LIKES, VIEWS = "count(*) FILTER (action = 'like')", "count(*) FILTER (action = 'view')"


# --- daily metrics -----------------------------------------------------------

def daily(days: int) -> str:
    return query(f"""
SELECT {DATE} AS date, count(DISTINCT user_id) AS dau, {VIEWS} AS views, {LIKES} AS likes,
       {six(ratio(LIKES, VIEWS))} AS ctr
FROM feed WHERE {DATE} < DATE '{p.AS_OF}' AND {DATE} >= DATE '{p.AS_OF}' - {days} GROUP BY 1""")


DAU = query(f"""
SELECT {DATE} AS date, count(DISTINCT user_id) AS dau FROM feed
WHERE {DATE} < DATE '{p.AS_OF}' AND {DATE} >= DATE '{p.AS_OF}' - 7 GROUP BY 1""")

CTR_DAILY = query(f"""
SELECT {DATE} AS date, {six(ratio(LIKES, VIEWS))} AS ctr FROM feed
WHERE {DATE} < DATE '{p.AS_OF}' AND {DATE} >= DATE '{p.AS_OF}' - 7 GROUP BY 1""")

BY_SOURCE = f"""
SELECT {DATE} AS date,
       count(DISTINCT CASE WHEN source = 'organic' THEN user_id END) AS organic,
       count(DISTINCT CASE WHEN source = 'ads' THEN user_id END) AS ads,
       count(DISTINCT CASE WHEN source IS NULL OR source NOT IN ('organic', 'ads') THEN user_id END) AS other
FROM feed WHERE {DATE} >= DATE '{p.AS_OF}' - 14 AND {DATE} <= DATE '{p.AS_OF}' GROUP BY 1"""

VIEWS_PER_USER = f"""
SELECT date, {six('avg(views)')} AS avg_views, {six('median(views)')} AS median_views
FROM (SELECT {DATE} AS date, user_id, count(action) AS views FROM feed WHERE action = 'view' GROUP BY 1, 2) u
WHERE date < DATE '{p.AS_OF}' AND date >= DATE '{p.AS_OF}' - 14 GROUP BY 1"""


def peak(table: str, counted: str = "count(user_id)") -> str:
    return f"""
SELECT date_trunc('hour', second) AS hour, max(users) AS peak_users
FROM (SELECT date_trunc('second', time) AS second, {counted} AS users FROM {table} GROUP BY 1) s
WHERE date_trunc('hour', second) >= TIMESTAMP '{p.PEAK_DAY}'
  AND date_trunc('hour', second) < TIMESTAMP '{p.PEAK_DAY}' + INTERVAL 1 DAY
GROUP BY 1 ORDER BY 1 LIMIT 1000"""


AUDIENCE = query(f"""
SELECT age, os, gender, count(DISTINCT user_id) AS users,
       {six(ratio('count(action)', 'count(DISTINCT user_id)'))} AS actions_per_user
FROM feed GROUP BY 1, 2, 3 ORDER BY users DESC, age, os, gender LIMIT {p.AUDIENCE}""")


# --- daily load --------------------------------------------------------------

def feed_user_day(views: str = VIEWS, likes: str = LIKES) -> str:
    return f"""
SELECT user_id, {DATE} AS event_date, os, gender, age, {views} AS views, {likes} AS likes
FROM feed GROUP BY 1, 2, 3, 4, 5"""


def message_user_day(literal: bool = False) -> str:
    extra = ", os, gender, age" if literal else ""
    on = "" if literal else " AND s.event_date = r.event_date"
    day = f"WHERE {DATE} = DATE '{p.LITERAL_DAY}'" if literal else ""
    return f"""
SELECT s.user_id, s.event_date, s.os, s.gender, s.age, messages_sent,
       coalesce(messages_received, 0) AS messages_received, users_sent,
       coalesce(users_received, 0) AS users_received
FROM (SELECT user_id, {DATE} AS event_date, os, gender, age, count(reciever_id) AS messages_sent,
             count(DISTINCT reciever_id) AS users_sent FROM messages {day} GROUP BY 1, 2, 3, 4, 5) s
LEFT JOIN (SELECT reciever_id, {DATE} AS event_date{extra}, count(user_id) AS messages_received,
             count(DISTINCT user_id) AS users_received FROM messages {day}
             GROUP BY reciever_id, {DATE}{extra}) r
  ON s.user_id = r.reciever_id{on}"""


JOINED = [f"feed_stats AS ({feed_user_day()})", f"message_stats AS ({message_user_day()})",
          """joined AS (
SELECT * FROM feed_stats JOIN message_stats USING (user_id, event_date, os, gender, age))"""]

JOINED_LITERAL = [f"feed_stats AS ({feed_user_day("count(action = 'view')", "count(action = 'like')")})",
                  f"message_stats AS ({message_user_day(literal=True)})", JOINED[2]]

FULL_JOIN = query("SELECT user_id, event_date, os, gender, age, "
                  + ", ".join(f"coalesce({c}, 0) AS {c}" for c in COUNTERS)
                  + " FROM feed_stats FULL JOIN message_stats USING (user_id, event_date, os, gender, age)",
                  *JOINED[:2])

SUMS = ", ".join(f"{big(f'sum({c})')} AS {c}" for c in COUNTERS)


def slice_by(dimension: str) -> str:
    return query(f"SELECT event_date, {dimension}, {SUMS} FROM joined GROUP BY 1, 2", *JOINED)


def stacked(*steps: str) -> str:
    return query("\nUNION ALL\n".join(
        f"SELECT event_date, '{d}' AS dimension, CAST({d} AS VARCHAR) AS dimension_value, {SUMS} "
        f"FROM joined GROUP BY event_date, {d}" for d in ("os", "gender", "age")), *steps)


SLICES = stacked(*JOINED)


# --- cohorts -----------------------------------------------------------------

FIRST_DAY = f"first_day AS (SELECT user_id, min({DATE}) AS start_date FROM feed GROUP BY 1)"
ACTIVE = f"active AS (SELECT DISTINCT user_id, {DATE} AS date FROM feed)"
NEW_USERS = query(f"SELECT count(user_id) AS new_users FROM first_day "
                  f"WHERE start_date = DATE '{p.NEW_USERS_AS_OF}' - 1", FIRST_DAY)
DAY1 = f"""
SELECT DATE '{p.RETENTION_AS_OF}' - 2 AS start_date, count(*) AS cohort_size,
       count(a.user_id) AS returned, {ratio('count(a.user_id)', 'count(*)')} * 100 AS retention_pct
FROM first_day f LEFT JOIN active a ON a.user_id = f.user_id AND a.date = DATE '{p.RETENTION_AS_OF}' - 1
WHERE f.start_date = DATE '{p.RETENTION_AS_OF}' - 2"""
CURVE = f"""curve AS (
SELECT start_date, date, count(user_id) AS users FROM first_day JOIN active USING (user_id)
WHERE start_date = DATE '{p.CURVE_AS_OF}' - {p.CURVE_AGE} AND date <= DATE '{p.CURVE_AS_OF}' GROUP BY 1, 2)"""


ARRIVALS = query(f"""
SELECT d.date, count(f.user_id) AS new_users, count(a.user_id) AS returned,
       {six(ratio('count(a.user_id)', 'count(f.user_id)') + ' * 100')} AS retention_pct
FROM (SELECT DISTINCT date FROM active) d LEFT JOIN first_day f ON f.start_date = d.date
LEFT JOIN active a ON a.user_id = f.user_id AND a.date = f.start_date + 1 GROUP BY 1""", FIRST_DAY, ACTIVE)
REPORTS = query(f"""
SELECT (SELECT count(*) FROM first_day WHERE start_date = DATE '{p.NEW_USERS_AS_OF}' - 1) AS new_users,
       cohort_size, returned, (SELECT max(users) FROM curve) AS curve_size,
       {big('(SELECT sum(users) FROM curve)')} AS curve_visits FROM ({DAY1}) day1""", FIRST_DAY, ACTIVE, CURVE)
MATRIX = query("SELECT start_date AS first_day, date, count(*) AS users FROM first_day JOIN active USING (user_id) "
               "GROUP BY 1, 2", FIRST_DAY, ACTIVE)
WEEKLY_USERS = query("SELECT CAST(date_trunc('week', date) AS DATE) AS week, count(DISTINCT user_id) AS users "
                     "FROM active GROUP BY 1", ACTIVE)
SKETCHED = query(f"SELECT {DATE} AS date, count(DISTINCT user_id) AS users, {VIEWS} AS views, {LIKES} AS likes, "
                 f"{six(ratio(LIKES, VIEWS))} AS ctr FROM feed GROUP BY 1")


# --- 15-minute metrics and alerts --------------------------------------------

def quarter_hours(condition: str = "true") -> list[str]:
    ts = "time_bucket(INTERVAL '15 minutes', time)"
    return [f"""feed_15 AS (
SELECT {ts} AS ts, count(DISTINCT user_id) AS users_feed, {VIEWS} AS views, {LIKES} AS likes,
       {ratio(LIKES, VIEWS)} AS ctr FROM feed WHERE {condition} GROUP BY 1)""",
            f"""message_15 AS (
SELECT {ts} AS ts, count(DISTINCT user_id) AS users_message, count(user_id) AS sent_message
FROM messages WHERE {condition} GROUP BY 1)""",
            """both_15 AS (
SELECT ts, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS hm, users_feed, views, likes, ctr,
       users_message, sent_message
FROM feed_15 FULL JOIN message_15 USING (ts))"""]


CLOSED = "time >= TIMESTAMP '2024-01-20 00:00:00' AND time < TIMESTAMP '2024-01-21 12:00:00'"
METRICS_15 = f"""
SELECT ts, CAST(date AS VARCHAR) AS date, hm, {six('ctr')} AS ctr, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in (
    "users_feed", "views", "likes", "users_message", "sent_message"))} FROM both_15"""

SERIES = "series AS (" + " UNION ALL ".join(
    f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM both_15" for m in METRICS) + ")"


def bands(source: str = "series") -> list[str]:
    return [f"""quartiles AS (
SELECT *, CASE WHEN count(value) OVER w = 5 THEN quantile_cont(value, 0.25) OVER w END AS q25,
          CASE WHEN count(value) OVER w = 5 THEN quantile_cont(value, 0.75) OVER w END AS q75
FROM {source}
WINDOW w AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))""",
            """bands AS (
SELECT *, q75 - q25 AS iqr, q75 + 3 * (q75 - q25) AS up, q25 - 3 * (q75 - q25) AS low FROM quartiles)"""]


BAND_COLUMNS = ", ".join(f"{six(c)} AS {c}" for c in ("value", "q25", "q75", "iqr", "up", "low"))
BANDS = f"SELECT ts, metric, {BAND_COLUMNS} FROM bands"
SMOOTHED = f"""
SELECT ts, metric, {", ".join(f"{six(c)} AS {c}" for c in ("value", "q25", "q75", "iqr"))},
       {six("avg(up) OVER (PARTITION BY metric ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")} AS up,
       {six("avg(low) OVER (PARTITION BY metric ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")} AS low
FROM bands"""
DENSE = """dense AS (
SELECT g.ts, g.metric, s.value
FROM (SELECT metric, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)) AS ts
      FROM series GROUP BY metric) g
LEFT JOIN series s ON s.metric = g.metric AND s.ts = g.ts)"""
FLAGGED = """flagged AS (
SELECT *, CASE WHEN value < low OR value > up THEN 1 ELSE 0 END AS is_alert,
       lag(value) OVER (PARTITION BY metric ORDER BY ts) AS previous,
       row_number() OVER (PARTITION BY metric ORDER BY ts DESC) AS newest
FROM bands)"""
DEVIATION = "abs(1 - value / nullif(previous, 0))"


# --- report texts ------------------------------------------------------------

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fill(template: str, *values: str) -> str:
    """Concatenate the template's fixed parts with the given expressions."""
    marked = template.replace("%%", "\0").replace("%d", "%s")
    parts = [part.replace("\0", "%") for part in marked.split("%s")]
    pieces = [quoted(parts[0])]
    for value, part in zip(values, parts[1:]):
        pieces += [f"CAST({value} AS VARCHAR)", quoted(part)]
    return " || ".join(pieces)


TWO_DIGITS = ("CASE WHEN ctr IS NULL THEN 'nan' WHEN printf('%.2g', ctr) SIMILAR TO '[0-9]+' THEN printf('%.2g', ctr) || '.0' "
              "ELSE printf('%.2g', ctr) END")
DAILY_TEXT = query(f"""
SELECT {fill(DAILY_MESSAGE, 'date', 'dau', 'views', 'likes', TWO_DIGITS)} AS message
FROM (SELECT {DATE} AS date, count(DISTINCT user_id) AS dau, {VIEWS} AS views, {LIKES} AS likes,
             {ratio(LIKES, VIEWS)} AS ctr
      FROM feed WHERE {DATE} = DATE '{p.AS_OF}' - 1 GROUP BY 1) d""")
APP_TEXT = query(f"""
SELECT {fill(APP_MESSAGE,
             f"(SELECT count(*) FROM first_day WHERE start_date = DATE '{p.RETENTION_AS_OF}' - 1)",
             "coalesce(printf('%.2f', retention_pct), 'nan')")} AS message
FROM ({DAY1}) d""", FIRST_DAY, ACTIVE)
ALERT_TEXT = query(f"""
SELECT metric, ts, is_alert,
       {fill(ALERT_MESSAGE, 'metric', "coalesce(printf('%.2f', value), 'nan')",
             f"coalesce(printf('%.2f', {DEVIATION} * 100), 'nan')")} AS message
FROM flagged WHERE newest = 1""", *quarter_hours(CLOSED), SERIES, *bands(), FLAGGED)


def labelled(pattern: str, column: str, rest: str, source: str, *steps: str) -> str:
    return query(f"SELECT strftime({column}, '{pattern}') AS label, {column}, {rest} FROM ({source}) c", *steps)


# --- experiments -------------------------------------------------------------

def users(week: tuple[str, str], pair: tuple[int, int], name: str = "users") -> str:
    return f"""{name} AS (
SELECT exp_group, user_id, {LIKES} AS likes, {VIEWS} AS views, {ratio(LIKES, VIEWS)} AS ctr
FROM feed WHERE {DATE} BETWEEN DATE '{week[0]}' AND DATE '{week[1]}' AND exp_group IN {pair} GROUP BY 1, 2)"""


AB_USERS = users(p.AB_WEEK, p.AB_PAIR)
AA_USERS = users(p.AA_WEEK, p.AA_PAIR)


def linearized(control: int) -> str:
    return f"""linear AS (
SELECT user_id, exp_group, likes, views, ctr_control, likes - views * ctr_control AS linearized_likes
FROM users CROSS JOIN (SELECT {ratio('sum(likes)', 'sum(views)')} AS ctr_control
                       FROM users WHERE exp_group = {control}) c)"""


NODES, WEIGHTS = np.polynomial.legendre.leggauss(16)
PANELS = 48
GRID = f"""grid AS (
SELECT (k + (1 + node) / 2) / {PANELS} AS place, weight / (2 * {PANELS}) AS weight
FROM (VALUES {", ".join(f"(CAST({n!r} AS DOUBLE), CAST({w!r} AS DOUBLE))"
                        for n, w in zip(NODES.tolist(), WEIGHTS.tolist()))}) q(node, weight),
     range({PANELS}) panels(k))"""


def welch(source: str, value: str, pair: tuple[int, int], by: str = "") -> list[str]:
    """t, df and p; the density is integrated over the angle atan(t / sqrt(df))."""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    sides = ", ".join(
        f"count({value}) FILTER (exp_group = {g}) AS n{i}, avg({value}) FILTER (exp_group = {g}) AS mean{i}, "
        f"var_samp({value}) FILTER (exp_group = {g}) AS var{i}" for i, g in enumerate(pair, start=1))
    tail_key = by or "one"
    return [f"moments AS (SELECT {key}1 AS one, {sides} FROM {source} {group})",
            """tests AS (
SELECT *, (mean1 - mean2) / nullif(sqrt(var1 / n1 + var2 / n2), 0) AS statistic,
       pow(var1 / n1 + var2 / n2, 2)
         / nullif(pow(var1 / n1, 2) / (n1 - 1) + pow(var2 / n2, 2) / (n2 - 1), 0) AS df
FROM moments)""",
            GRID,
            f"""tails AS (
SELECT {tail_key}, sum(weight * (pi() / 2 - low) * pow(cos(low + place * (pi() / 2 - low)), df - 1))
            / sum(weight * (pi() / 2) * pow(cos(place * (pi() / 2)), df - 1)) AS pvalue
FROM (SELECT *, atan(abs(statistic) / sqrt(df)) AS low FROM tests WHERE statistic IS NOT NULL) t, grid
GROUP BY {tail_key})""",
            f"""tested AS (
SELECT tests.*, pvalue FROM tests LEFT JOIN tails ON tests.{tail_key} = tails.{tail_key})"""]


WELCH = (f"SELECT n1, n2, {', '.join(f'{six(c)} AS {c}' for c in ('mean1', 'mean2', 'statistic', 'df', 'pvalue'))} "
         "FROM tested")


BUCKETS = f"""buckets AS (
SELECT exp_group, CAST({hash15("'bucket:' || CAST(user_id AS VARCHAR)")} % {p.BUCKETS} AS INTEGER) AS bucket,
       {ratio('sum(likes)', 'sum(views)')} AS bucket_ctr
FROM users GROUP BY 1, 2)"""


# XXH64 with seed 0 of eight bytes, step by step in unsigned 128-bit arithmetic.
_P1, _P2, _P3, _P4, _P5 = (f"{x}::UHUGEINT" for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_WORD = f"{1 << 64}::UHUGEINT"


def _times(x: str, y: str) -> str:
    return f"(({x}) * {y} % {_WORD})"


def _rotated(x: str, bits: int) -> str:
    return f"((({x}) * {1 << bits}::UHUGEINT) % {_WORD} + ({x}) // {1 << (64 - bits)}::UHUGEINT)"


def _folded(x: str, bits: int) -> str:
    return f"xor({x}, {x} // {1 << bits}::UHUGEINT)"


XX_HASHED = [
    "xx0 AS (SELECT DISTINCT user_id, user_id::UHUGEINT AS x FROM feed WHERE user_id IS NOT NULL)",
    f"xx1 AS (SELECT user_id, {_times('x', _P2)} AS x FROM xx0)",
    f"xx2 AS (SELECT user_id, {_times(_rotated('x', 31), _P1)} AS x FROM xx1)",
    f"xx3 AS (SELECT user_id, xor(({_P5} + 8::UHUGEINT) % {_WORD}, x) AS x FROM xx2)",
    f"xx4 AS (SELECT user_id, ({_times(_rotated('x', 27), _P1)} + {_P4}) % {_WORD} AS x FROM xx3)",
    f"xx5 AS (SELECT user_id, {_times(_folded('x', 33), _P2)} AS x FROM xx4)",
    f"xx6 AS (SELECT user_id, {_times(_folded('x', 29), _P3)} AS x FROM xx5)",
    f"hashed AS (SELECT user_id, ({_folded('x', 32)})::UBIGINT AS h FROM xx6)"]


def mann_whitney(source: str, value: str, pair: tuple[int, int]) -> list[str]:
    """U by comparing every pair; the normal density is integrated from z upwards."""
    return [f"side1 AS (SELECT {value} AS v FROM {source} WHERE exp_group = {pair[0]} AND {value} IS NOT NULL)",
            f"side2 AS (SELECT {value} AS v FROM {source} WHERE exp_group = {pair[1]} AND {value} IS NOT NULL)",
            "tied AS (SELECT count(*) AS t FROM (SELECT v FROM side1 UNION ALL SELECT v FROM side2) GROUP BY v)",
            """u AS (
SELECT sum(CASE WHEN side1.v > side2.v THEN 1 WHEN side1.v = side2.v THEN 0.5 ELSE 0 END)::DOUBLE AS statistic,
       (SELECT count(*) FROM side1) AS n1, (SELECT count(*) FROM side2) AS n2,
       (SELECT sum(t * t * t - t) FROM tied)::DOUBLE AS ties
FROM side1, side2)""",
            """scored AS (
SELECT *, (greatest(statistic, n1 * n2 - statistic) - n1 * n2 / 2.0::DOUBLE - 0.5::DOUBLE)
   / nullif(sqrt(n1 * n2 / 12.0::DOUBLE * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 0) AS z FROM u)""",
            GRID,
            f"""upper AS (
SELECT z, least(1.0::DOUBLE, 2 * sum(weight * 14 * exp(-pow(z + place * 14, 2) / 2) / sqrt(2 * pi()))) AS pvalue
FROM scored, grid GROUP BY z)"""]


MANN_WHITNEY = f"""
SELECT n1, n2, {six('statistic')} AS statistic, {six('scored.z')} AS z, {six('pvalue')} AS pvalue
FROM scored LEFT JOIN upper ON scored.z = upper.z"""


def histogram(source: str, value: str, bins: int | None = None, by: str = "", common: bool = False) -> str:
    """Rows between consecutive edges; automatic bin counts unless ``bins``."""
    key = "1" if common or not by else by
    shown = f"{by}, " if by else ""
    count = str(bins) if bins else """
CASE WHEN least(greatest(2.0::DOUBLE * iqr * pow(n, -1.0::DOUBLE / 3.0::DOUBLE), (high - low) / sqrt(n) / 2),
                (high - low) / (log2(n) + 1)) > 0
     THEN ceil((high - low) / least(greatest(2.0::DOUBLE * iqr * pow(n, -1.0::DOUBLE / 3.0::DOUBLE),
                                            (high - low) / sqrt(n) / 2), (high - low) / (log2(n) + 1)))
     ELSE 1 END"""
    return f"""
SELECT {shown}bin, {six('bin_start')} AS bin_start, {six('bin_end')} AS bin_end,
       count(v) AS rows
FROM (SELECT g.*, e.bin, e.bin_start, e.bin_end, e.bins, e.k
      FROM (SELECT DISTINCT {shown}{key} AS k FROM {source}) g
      JOIN (SELECT k, bins, bin, first + bin * ((last - first) / bins) AS bin_start,
                   CASE WHEN bin = bins - 1 THEN last ELSE first + (bin + 1) * ((last - first) / bins) END AS bin_end
            FROM (SELECT *, CAST(unnest(range(bins)) AS INTEGER) AS bin
                  FROM (SELECT k, CASE WHEN low = high THEN low - 0.5::DOUBLE ELSE low END AS first,
                               CASE WHEN low = high THEN high + 0.5::DOUBLE ELSE high END AS last,
                               CAST({count} AS INTEGER) AS bins
                        FROM (SELECT {key} AS k, min({value}) AS low, max({value}) AS high,
                                     count({value})::DOUBLE AS n,
                                     quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25) AS iqr
                              FROM {source} WHERE {value} IS NOT NULL GROUP BY 1) s) f) b) e ON e.k = g.k) cells
LEFT JOIN (SELECT {"" if not by else by + " AS member, "}{value} AS v FROM {source}) x
  ON v >= bin_start AND (v < bin_end OR (bin = bins - 1 AND v <= bin_end)){f" AND member = cells.{by}" if by else ""}
GROUP BY {shown}bin, bin_start, bin_end"""


# --- resampling --------------------------------------------------------------

def sampling(source: str, groups: tuple[int, ...], n: int, iterations: int, seed: str, draws: int,
             value: str = "ctr") -> list[str]:
    """Of each iteration's draws the first ``n`` different ones; ``draws`` of them hold that many."""
    chunk = f"{hash15("'chunk:' || CAST(user_id AS VARCHAR)")} % 1024"
    key = hash15(f"concat_ws(':', '{seed}', exp_group, iteration, i)")
    return [f"""numbered AS (
SELECT *, row_number() OVER (PARTITION BY exp_group ORDER BY {chunk}, user_id) - 1 AS number
FROM {source} WHERE {value} IS NOT NULL AND exp_group IN {groups})""",
            """population AS (SELECT exp_group, count(*) AS size FROM numbered GROUP BY 1)""",
            f"""draws AS (
SELECT exp_group, iteration, {key} % size AS number, min(i) AS i
FROM population, range({iterations}) r(iteration), range({draws}) d(i) GROUP BY 1, 2, 3)""",
            f"""samples AS (
SELECT iteration, exp_group, user_id, {value}
FROM (SELECT *, row_number() OVER (PARTITION BY exp_group, iteration ORDER BY i) AS place FROM draws) c
JOIN numbered USING (exp_group, number) WHERE place <= {n})"""]


ORDERS = f"""orders_as_users AS (
SELECT CASE o_orderstatus WHEN 'F' THEN {p.AA_PAIR[0]} WHEN 'O' THEN {p.AA_PAIR[1]} END AS exp_group,
       o_orderkey AS user_id, CAST(o_totalprice AS DOUBLE) AS price FROM orders)"""
ORDER_SAMPLES = sampling("orders_as_users", p.AA_PAIR, p.SAMPLE, p.ITERATIONS, p.AA_SEED, 2 * p.SAMPLE, "price")
SIMULATION = [ORDERS, *ORDER_SAMPLES, *welch("samples", "price", p.AA_PAIR, "iteration")]


def poisson_steps() -> list[float]:
    steps, total = [], 0.0
    for k in range(18):
        total += math.exp(-1.0) / math.factorial(k)
        steps.append(total)
    return steps


WEIGHT = ("CASE " + " ".join(f"WHEN u < CAST({step!r} AS DOUBLE) THEN {k}"
                             for k, step in enumerate(poisson_steps())) + " ELSE 18 END")
BOOTSTRAP = [AB_USERS, f"""bootstrap AS (
SELECT exp_group, replicate, {ratio('sum(weight * likes)', 'sum(weight * views)')} AS ctr
FROM (SELECT *, {WEIGHT} AS weight
      FROM (SELECT users.*, CAST(replicate AS INTEGER) AS replicate,
                   {hash15(f"concat_ws(':', '{p.BOOTSTRAP_SEED}', user_id, replicate)")}
                     / CAST(1152921504606846976 AS DOUBLE) AS u
            FROM users, range({p.REPLICATES}) r(replicate)) d) w
GROUP BY 1, 2)""", f"""differences AS (
SELECT replicate, b.ctr - a.ctr AS difference
FROM (SELECT * FROM bootstrap WHERE exp_group = {p.AB_PAIR[0]}) a
JOIN (SELECT * FROM bootstrap WHERE exp_group = {p.AB_PAIR[1]}) b USING (replicate))"""]


# --- streams -----------------------------------------------------------------

def closed_by_watermark(table: str) -> str:
    return (f"ts + INTERVAL 15 MINUTE <= (SELECT date_trunc('millisecond', max(time)) FROM {table}) "
            "- INTERVAL 30 MINUTE")


STREAM_SERIES = "series AS (" + " UNION ALL ".join(
    f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {side}_15 "
    f"WHERE {closed_by_watermark(log)}"
    for m, side, log in [("users_feed", "feed", "feed"), ("views", "feed", "feed"), ("likes", "feed", "feed"),
                         ("ctr", "feed", "feed"), ("users_message", "message", "messages")]) + ")"


ORACLE: dict[str, str] = {
    "source_tsv": query(feed_user_day()),
    "source_tsv_by_name": query(feed_user_day()),
    "partitioned_log": daily(7),
    "sql_user_ctr": query(f"SELECT exp_group, user_id, likes, views, {six('ctr')} AS ctr FROM users", AB_USERS),
    "daily_slices_sink": SLICES,
    "daily_slices_table": SLICES,
    "daily_slices_table_again": SLICES,
    "audience_csv": AUDIENCE,
    "daily_metrics": daily(1),
    "weekly_metrics": daily(7),
    "dau": DAU,
    "ctr_daily": CTR_DAILY,
    "dau_by_source": query(BY_SOURCE),
    "views_per_user": query(VIEWS_PER_USER),
    "pccu_feed": query(peak("feed")),
    "pccu_message": query(peak("messages")),
    "pccu_feed_distinct": query(peak("feed", "count(DISTINCT user_id)")),
    "active_audience": AUDIENCE,
    "feed_user_day": query(feed_user_day()),
    "feed_user_day_literal": query(feed_user_day("count(action = 'view')", "count(action = 'like')")),
    "message_user_day": query(message_user_day()),
    "message_user_day_literal": query(message_user_day(literal=True)),
    "feed_message_join": query("SELECT * FROM joined", *JOINED),
    "feed_message_join_literal": query("SELECT * FROM joined", *JOINED_LITERAL),
    "daily_slices_literal": stacked(*JOINED_LITERAL),
    "feed_message_join_full": FULL_JOIN,
    "slice_by_os": slice_by("os"),
    "slice_by_age": slice_by("age"),
    "slice_by_gender": slice_by("gender"),
    "daily_slices": SLICES,
    "daily_slices_union": SLICES,
    "new_users": NEW_USERS,
    "user_active_days": query("SELECT user_id, date FROM active", ACTIVE),
    "retention_day1": query(f"SELECT CAST(start_date AS DATE) AS start_date, cohort_size, returned, "
                            f"{six('retention_pct')} AS retention_pct FROM ({DAY1}) d", FIRST_DAY, ACTIVE),
    "retention_curve": query(f"""
SELECT start_date, date, users, cohort_size, {six(ratio('users', 'cohort_size'))} AS retention_rate
FROM curve CROSS JOIN (SELECT max(users) AS cohort_size FROM curve) c""", FIRST_DAY, ACTIVE, CURVE),
    "first_seen_arrivals": ARRIVALS,
    "first_seen_reports": REPORTS,
    "cohort_matrix": MATRIX,
    "weekly_users": WEEKLY_USERS,
    "sketched_users": SKETCHED,
    "metrics_15min": query(METRICS_15, *quarter_hours()),
    "metrics_15min_closed": query(METRICS_15, *quarter_hours(CLOSED)),
    "iqr_bands": query(BANDS, *quarter_hours(), SERIES, *bands()),
    "iqr_bands_smoothed": query(SMOOTHED, *quarter_hours(), SERIES, *bands()),
    "iqr_bands_dense": query(BANDS, *quarter_hours(), SERIES, DENSE, *bands("dense")),
    "alert_flags": query(f"""
SELECT ts, metric, {BAND_COLUMNS}, is_alert, {six('previous')} AS previous, {six(DEVIATION)} AS deviation
FROM flagged WHERE newest = 1""", *quarter_hours(CLOSED), SERIES, *bands(), FLAGGED),
    "report_daily_text": DAILY_TEXT,
    "report_app_text": APP_TEXT,
    "report_app_text_stored": APP_TEXT,
    "alert_text": ALERT_TEXT,
    "weekly_chart": labelled("%m/%d/%Y", "date", "dau, views, likes, ctr", f"""
SELECT {DATE} AS date, count(DISTINCT user_id) AS dau, {VIEWS} AS views, {LIKES} AS likes,
       {six(ratio(LIKES, VIEWS))} AS ctr
FROM feed WHERE {DATE} < DATE '{p.AS_OF}' AND {DATE} >= DATE '{p.AS_OF}' - 7 GROUP BY 1"""),
    "source_chart": labelled("%d/%m/%Y", "date", "organic, ads, other", BY_SOURCE),
    "views_chart": labelled("%d/%m/%Y", "date", "avg_views, median_views", VIEWS_PER_USER),
    "peak_chart": labelled("%d/%m %H:%M", "hour", "peak_users", peak("feed")),
    "retention_chart": labelled("%d/%m/%Y", "date", "users", "SELECT * FROM curve", FIRST_DAY, ACTIVE, CURVE),
    "alert_chart": labelled("%d/%m %H:%M", "ts", "metric, " + ", ".join(
        f"{six(c)} AS {c}" for c in ("value", "up", "low")), "SELECT * FROM bands",
        *quarter_hours(CLOSED), SERIES, *bands()),
    "user_ctr": query(f"SELECT exp_group, user_id, likes, views, {six('ctr')} AS ctr FROM users", AB_USERS),
    "group_sizes": query("SELECT exp_group, count(DISTINCT user_id) AS users FROM users GROUP BY 1", AA_USERS),
    "welch_ctr": query(WELCH, AB_USERS, *welch("users", "ctr", p.AB_PAIR)),
    "linearized_likes": query(
        f"SELECT user_id, exp_group, likes, views, {six('ctr_control')} AS ctr_control, "
        f"{six('linearized_likes')} AS linearized_likes FROM linear", AB_USERS, linearized(p.AB_PAIR[0])),
    "welch_linearized_12": query(WELCH, AB_USERS, linearized(p.AB_PAIR[0]),
                                 *welch("linear", "linearized_likes", p.AB_PAIR)),
    "welch_linearized_03": query(WELCH, users(p.AB_WEEK, p.OTHER_PAIR), linearized(p.OTHER_PAIR[0]),
                                 *welch("linear", "linearized_likes", p.OTHER_PAIR)),
    "bucket_ctr": query(f"SELECT exp_group, bucket, {six('bucket_ctr')} AS bucket_ctr FROM buckets",
                        AB_USERS, BUCKETS),
    "bucket_ctr_xxhash64": query(f"""
SELECT exp_group, CAST(h % {p.BUCKETS} AS INTEGER) AS bucket, {six(ratio('sum(likes)', 'sum(views)'))} AS bucket_ctr
FROM users JOIN hashed USING (user_id) GROUP BY 1, 2""", AB_USERS, *XX_HASHED),
    "hashed_users": query(f"SELECT user_id, lower(printf('%016x', h)) AS hash, CAST(h % {p.BUCKETS} AS INTEGER) AS bucket "
                          "FROM hashed", *XX_HASHED),
    "mann_whitney_bucket": query(MANN_WHITNEY, AB_USERS, BUCKETS,
                                 *mann_whitney("buckets", "bucket_ctr", p.AB_PAIR)),
    "mann_whitney_users": query(MANN_WHITNEY, AB_USERS, *mann_whitney("users", "ctr", p.AB_PAIR)),
    "ctr_histogram": query(histogram("users", "ctr", by="exp_group"), AB_USERS),
    "ctr_histogram_by_group": query(histogram("users", "ctr", by="exp_group", common=True), AB_USERS),
    "bucket_histogram": query(histogram("buckets", "bucket_ctr", by="exp_group"), AB_USERS, BUCKETS),
    "sample_n_per_group": query("SELECT iteration, exp_group, user_id FROM samples", AA_USERS, *sampling(
        "users", p.AA_PAIR, p.SMALL_SAMPLE, p.ITERATIONS, p.AA_SEED, 40 * p.SMALL_SAMPLE)),
    "sample_500_orders": query(f"SELECT exp_group, user_id, count(*) AS samples, {big('sum(iteration)')} AS iterations "
                               "FROM samples GROUP BY 1, 2", ORDERS, *ORDER_SAMPLES),
    "aa_simulation": query(f"SELECT iteration, {six('statistic')} AS statistic, {six('pvalue')} AS pvalue "
                           "FROM tested", *SIMULATION),
    "aa_false_positive_rate": query(f"""
SELECT count(*) AS iterations, count(*) FILTER (pvalue <= 0.05::DOUBLE) AS significant,
       {six(ratio('count(*) FILTER (pvalue <= 0.05::DOUBLE)', 'count(*)') + ' * 100')} AS share_pct
FROM tested""", *SIMULATION),
    "pvalue_histogram": query(histogram("tested", "pvalue", bins=p.PVALUE_BINS), *SIMULATION),
    "poisson_bootstrap": query(f"SELECT exp_group, replicate, {six('ctr')} AS ctr FROM bootstrap", *BOOTSTRAP),
    "poisson_bootstrap_counts": query(f"""
SELECT exp_group, CAST({p.REPLICATES} AS BIGINT) AS replicates, {six(ratio('sum(likes)', 'sum(views)'))} AS ctr,
       true AS is_near FROM users GROUP BY 1""", AB_USERS),
    "bootstrap_diff_ci": query(f"""
SELECT count(difference) AS replicates, {six('avg(difference)')} AS mean, {six('min(difference)')} AS min,
       {six('max(difference)')} AS max, {six('quantile_cont(difference, 0.025)')} AS low,
       {six('quantile_cont(difference, 0.975)')} AS high,
       min(difference) <= 0 AND max(difference) >= 0 AS crosses_zero
FROM differences""", *BOOTSTRAP),
    "bootstrap_histogram": query(histogram("bootstrap", "ctr", by="exp_group"), *BOOTSTRAP),
    "bootstrap_diff_histogram": query(histogram("differences", "difference"), *BOOTSTRAP),
    "stream_metrics_15min": query(f"""
SELECT ts, users_feed, views, likes, {six('ctr')} AS ctr FROM feed_15
WHERE {closed_by_watermark('feed')}""", *quarter_hours()),
    "stream_alerts": query(f"""
SELECT metric, ts, {six('value')} AS value, {six('up')} AS up, {six('low')} AS low, is_alert
FROM flagged""", *quarter_hours(), STREAM_SERIES, *bands(), FLAGGED),
    "stream_daily_slices": SLICES,
}
