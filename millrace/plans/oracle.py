"""The same queries in plain SQL over the stored tables, for a second engine to check."""

from __future__ import annotations

from millrace.functions.access_log import ACCESS_LOG_PATTERN
from millrace.sources.derived import EPOCH, GAP, SQUEEZE

_GROUPS = ("ip", "client", "usr", "date_time", "request", "status", "bytes", "referer", "agent")

_TIMED = f"""timed AS (
    SELECT *, {EPOCH} + ((epoch_us(ts) // 1000000) - {EPOCH}) // {SQUEEZE} AS t FROM events)"""

_LOGS = _TIMED + """,
logs AS (
    SELECT event_id, t, CASE WHEN event_id % 97 = 0 THEN 'corrupt ' || event_id
        ELSE CASE WHEN event_id % 83 = 0 THEN '' ELSE '10.0.' || (user_id // 100) || '.' || (user_id % 100) END
            || ' - - [' || strftime(make_timestamp(t * 1000000), '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /'
            || event_type || CASE WHEN event_id % 89 = 0 THEN '' ELSE ' HTTP/1.1' END || '" '
            || CASE event_type WHEN 'error' THEN '500' WHEN 'click' THEN '302' ELSE '200' END
            || ' ' || event_id || ' "-" "agent-' || (user_id % 7) || '"' END AS line
    FROM timed)"""

_PARSED = (
    _LOGS
    + """,
raw AS (SELECT event_id, t, line, regexp_matches(line, '{re}') AS matched, {groups} FROM logs),
parsed AS (
    SELECT *, string_split(rtrim(request, ' '), ' ') AS tokens,
        epoch_us(try_strptime(regexp_extract(date_time, '\\[(.*?) .+]', 1), '%d/%b/%Y:%H:%M:%S')) // 1000000 AS secs
    FROM raw),
urls AS (
    SELECT *,
        CASE WHEN matched AND len(tokens) = 3 THEN tokens[2] ELSE '[error]' END AS strict_url,
        CASE WHEN NOT matched THEN 'error' ELSE coalesce(tokens[2], '[error]') END AS lenient_url,
        CASE WHEN status LIKE '2__' THEN 'Success' WHEN status LIKE '5__' THEN 'Failure' ELSE 'Other' END AS class
    FROM parsed)"""
).format(
    re=ACCESS_LOG_PATTERN,
    groups=", ".join(f"regexp_extract(line, '{ACCESS_LOG_PATTERN}', {i + 1}) AS {g}" for i, g in enumerate(_GROUPS)),
)

_POSTS = _TIMED + """,
posts AS (
    SELECT event_id AS id, t, 'saw ' || event_type || ' $' || event_type || ' $' || user_id || ' $ $Tag'
        || chr((65 + event_id % 26)::INT) || CASE WHEN event_id % 50 = 0 THEN '  ' ELSE '' END AS text
    FROM timed)"""

_XY = """xy AS (
    SELECT event_id AS id, value / 250 - 1 AS feature,
        -(value / 250 - 1) + ((event_id * 7919) % 1000) / 1000.0::DOUBLE * 0.4::DOUBLE - 0.2::DOUBLE AS label
    FROM events)"""

_WORDS = """words AS (
    SELECT unnest(CASE WHEN length(text) > 0 AND length(rtrim(text, ' ')) = 0 THEN []::VARCHAR[]
        ELSE string_split(rtrim(lower(text), ' '), ' ') END) AS word FROM documents)"""

_TERMS = _POSTS + """,
tokens AS (SELECT t, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM posts),
terms AS (
    SELECT t, upper(word) AS term FROM tokens
    WHERE starts_with(word, '$') AND length(word) > 1 AND NOT regexp_matches(word, '\\p{Nd}'))"""


def _sliding(source: str, key: str, name: str, window: int = 300) -> str:
    return f""",
per_second AS (SELECT {key} AS {name}, t, count(*) AS c FROM {source} GROUP BY ALL),
slides AS (
    SELECT t + 1 + i AS window_end, {name}, sum(c)::BIGINT AS n
    FROM per_second, range(0, {window}) r(i) GROUP BY ALL)"""


def _top(name: str, k: int = 10) -> str:
    return f"""
SELECT window_end, rank, {name}, n FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, {name})::INT AS rank FROM slides)
WHERE rank <= {k}"""


def _status_windows(width: int) -> str:
    return f"""WITH {_PARSED}
SELECT status, secs // {width} * {width} AS window_start, secs // {width} * {width} + {width} AS window_end,
    count(*) AS n
FROM urls WHERE matched GROUP BY ALL"""


def _sessions(source: str, key: str, at: str, item: str, gap_us: int) -> str:
    return f""",
hits AS (SELECT {key} AS k, {at} AS moment, event_id AS seq, {item} AS item FROM {source}),
marked AS (
    SELECT *, CASE WHEN moment - lag(moment) OVER w <= {gap_us} THEN 0 ELSE 1 END AS starts
    FROM hits WINDOW w AS (PARTITION BY k ORDER BY moment, seq)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY k ORDER BY moment, seq) AS session FROM marked),
found AS (
    SELECT k, session, min(moment) AS start_us, max(moment) AS last_us, count(*) AS session_length,
        array_to_string(list(item ORDER BY moment, seq)[1:10], ' ') AS clicks
    FROM numbered GROUP BY k, session)"""


_USER_SESSIONS = "WITH base AS (SELECT * FROM events)" + _sessions(
    "base", "user_id", "epoch_us(ts)", "event_type", 12 * 3600 * 1000000
)
_SNAPSHOT = """
SELECT k AS user_id, start_us, last_us, session_length, clicks FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY start_us DESC) AS r FROM found) WHERE r = 1"""

def _status(rows: str = "true") -> str:
    return f"""WITH RECURSIVE {_PARSED},
base AS (SELECT t, class FROM urls WHERE {rows}),
per_second AS (
    SELECT t, count(*) AS c, count(*) FILTER (class = 'Success') AS s, count(*) FILTER (class = 'Failure') AS f
    FROM base GROUP BY t),
busy AS (
    SELECT t + 1 + i AS window_end, sum(c)::BIGINT AS n, sum(s)::BIGINT AS success, sum(f)::BIGINT AS failure
    FROM per_second, range(0, 300) r(i) GROUP BY ALL),
grid AS (SELECT unnest(range(min(t) + 1, max(t) + 301)) AS window_end FROM base),
slides AS (
    SELECT window_end, coalesce(n, 0) AS n, coalesce(success, 0) AS success, coalesce(failure, 0) AS failure
    FROM grid LEFT JOIN busy USING (window_end)),
rated AS (
    SELECT *, CASE WHEN success + failure > 100 THEN
        CASE WHEN success = 0 THEN 'inf'::DOUBLE ELSE failure / success END END AS ratio FROM slides),
seen AS (
    SELECT *, max(CASE WHEN n > 0 THEN window_end END) OVER (ORDER BY window_end) AS last_seen FROM rated),
silent AS (SELECT window_end, 'no_data' AS kind FROM seen WHERE n = 0 AND window_end - last_seen > 30)"""


_STATUS, _GAP_STATUS = _status(), _status(f"t < {GAP[0]} OR t >= {GAP[1]}")


def _alarms(bound: str) -> str:
    return f""",
due AS (SELECT window_end, 'error_ratio' AS kind FROM rated WHERE ratio > {bound} UNION ALL SELECT * FROM silent),
sent(window_end) AS (
    SELECT min(window_end) FROM due
    UNION ALL
    SELECT (SELECT min(d.window_end) FROM due d WHERE d.window_end > s.window_end + 30)
    FROM sent s WHERE s.window_end IS NOT NULL)"""


_FATES = """
SELECT window_end, kind, CASE WHEN window_end IN (SELECT window_end FROM sent WHERE window_end IS NOT NULL)
    THEN 'issued' ELSE 'suppressed' END AS action FROM due"""

_ISSUED = " SELECT window_end, kind FROM due WHERE window_end IN (SELECT window_end FROM sent WHERE window_end IS NOT NULL)"

_CENTRES = """WITH centres AS (
    SELECT label % 5 AS g, arg_min(embedding::DOUBLE[], vec_id) AS c FROM embeddings GROUP BY ALL),
ranked_centres AS (SELECT (row_number() OVER (ORDER BY g) - 1)::INT AS cluster, c FROM centres),
scored AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v, cluster,
        list_sum([power(embedding[i]::DOUBLE - c[i], 2) FOR i IN range(1, len(c) + 1)]) AS d
    FROM embeddings, ranked_centres),
assigned AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)"""

_FIT = f"WITH {_XY}, fit AS (SELECT regr_slope(label, feature) AS slope, regr_intercept(label, feature) AS intercept FROM xy)"

_RUNNING = f"""WITH {_POSTS},
b AS (SELECT t, count(*) AS posts, sum(length(text)) AS chars, max(length(text)) AS top FROM posts GROUP BY t),
running AS (
    SELECT t AS batch, (sum(posts) OVER w)::BIGINT AS total_posts, (sum(chars) OVER w)::BIGINT AS total_chars,
        (sum(chars) OVER w // sum(posts) OVER w)::BIGINT AS average, top AS batch_max, max(top) OVER w AS max_so_far
    FROM b WINDOW w AS (ORDER BY t))"""

_URL_SLIDES = f"WITH {_PARSED}" + _sliding("urls", "strict_url", "url")

_ORACLE = {
    "parse_access_log": f"""WITH {_PARSED}
SELECT event_id, matched, coalesce(secs, -1) AS ts_seconds, ip, client, usr AS "user", request, status, bytes,
    referer, agent FROM urls""",
    "log_time": f"""WITH {_PARSED}
SELECT event_id, strftime(make_timestamp(secs * 1000000), '%Y-%m-%d %H:%M:%S') AS log_time FROM urls WHERE matched""",
    "unmatched_policies": f"""WITH {_PARSED}
SELECT event_id, strict_url AS bucket_url, CASE WHEN matched THEN agent ELSE '()' END AS bucket_agent,
    lenient_url AS sentinel_url, class AS status_class, matched AS kept_by_drop FROM urls""",
    "url_lenient_vs_strict": f"""WITH {_PARSED}
SELECT event_id, strict_url AS strict, lenient_url AS lenient FROM urls WHERE matched""",
    "request_records": f"""WITH {_PARSED}
SELECT event_id, lenient_url AS url, CASE WHEN matched THEN status::INT ELSE 0 END AS status,
    CASE WHEN matched THEN agent ELSE 'error' END AS agent FROM urls""",
    "agent_counts_sql": f"""WITH {_PARSED}
SELECT CASE WHEN matched THEN agent ELSE 'error' END AS agent, count(*) AS total FROM urls GROUP BY ALL""",
    "agent_counts_per_batch": f"""WITH {_PARSED}
SELECT t AS batch, CASE WHEN matched THEN agent ELSE 'error' END AS agent, count(*) AS total FROM urls GROUP BY ALL""",
    "json_export_roundtrip": f"""WITH {_PARSED}
SELECT event_id, lenient_url AS url, CASE WHEN matched THEN status::INT ELSE 0 END AS status,
    CASE WHEN matched THEN agent ELSE 'error' END AS agent, t // 60 AS batch_id FROM urls""",
    "text_export_roundtrip": f"""WITH {_POSTS}
SELECT t // 60 AS batch_id, text AS line, count(*) AS n FROM posts GROUP BY ALL""",
    "status_class_counts": f"WITH {_PARSED} SELECT class AS status_class, count(*) AS n FROM urls GROUP BY ALL",
    "status_by_window": _status_windows(600),
    "status_by_hour": _status_windows(3600),
    "sliding_url_counts": _URL_SLIDES + " SELECT * FROM slides",
    "sliding_status_counts": f"WITH {_PARSED}" + _sliding("urls", "class", "status_class") + " SELECT * FROM slides",
    "sliding_delta_points": _URL_SLIDES
    + """,
flagged AS (
    SELECT *, CASE WHEN lag(window_end) OVER w = window_end - 1 AND lag(n) OVER w = n AND window_end % 3600 <> 0
        THEN 0 ELSE 1 END AS f FROM slides WINDOW w AS (PARTITION BY url ORDER BY window_end)),
islands AS (SELECT *, sum(f) OVER (PARTITION BY url ORDER BY window_end) AS g FROM flagged)
SELECT url, min(window_end) AS from_t, max(window_end) + 1 AS until_t, any_value(n) AS n FROM islands GROUP BY url, g""",
    "top_urls": _URL_SLIDES + _top("url"),
    "top_agents": f"WITH {_PARSED}"
    + _sliding("urls", "CASE WHEN matched THEN agent ELSE '()' END", "agent")
    + _top("agent"),
    "top_referrers": f"WITH {_PARSED}"
    + _sliding("urls", "CASE WHEN matched THEN referer ELSE '()' END", "referer")
    + _top("referer"),
    "leading_urls": _URL_SLIDES + _top("url", 2),
    "leading_agents": f"WITH {_PARSED}"
    + _sliding("urls", "CASE WHEN matched THEN agent ELSE '()' END", "agent")
    + _top("agent", 3),
    "leading_referrer": f"WITH {_PARSED}"
    + _sliding("urls", "CASE WHEN matched THEN referer ELSE '()' END", "referer")
    + _top("referer", 1),
    "trending_terms": f"WITH {_TERMS}" + _sliding("terms", "term", "term", 600) + _top("term"),
    "word_count": f"WITH {_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word",
    "top_words": f"WITH {_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 20",
    "print_batches": f"""WITH {_POSTS}
SELECT t AS batch, id, text, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY t ORDER BY id)::INT AS rank FROM posts) WHERE rank <= 10""",
    "first_posts": f"""WITH {_POSTS}
SELECT t AS batch, id, text, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY t ORDER BY id)::INT AS rank FROM posts) WHERE rank <= 2""",
    "text_lengths": """
SELECT doc_id, length(text) + len(regexp_extract_all(text, '[\\x{10000}-\\x{10FFFF}]')) AS units,
    length(text) AS points FROM documents""",
    "running_length": _RUNNING + " SELECT batch, total_posts, total_chars, average FROM running",
    "running_max_length": _RUNNING + " SELECT * FROM running",
    "total_lengths": f"""WITH {_POSTS}
SELECT count(*) AS total_posts, sum(length(text))::BIGINT AS total_chars, max(length(text)) AS max_so_far,
    (sum(length(text)) // count(*))::BIGINT AS average FROM posts""",
    "stop_after_n": f"""WITH {_POSTS},
b AS (SELECT t, count(*) AS n FROM posts GROUP BY t),
r AS (
    SELECT t, coalesce(sum(n) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b)
SELECT id, text FROM posts WHERE t IN (SELECT t FROM r WHERE before <= 1000)""",
    "sessions_by_user": _USER_SESSIONS
    + " SELECT k AS user_id, start_us, last_us, session_length, clicks FROM found",
    "sessions_by_ip": f"WITH {_PARSED}"
    + _sessions(
        "urls",
        "CASE WHEN NOT matched THEN 'error' ELSE nullif(ip, '') END",
        "t * 1000000",
        "lenient_url",
        1800 * 1000000,
    )
    + " SELECT coalesce(k, '') AS ip, start_us, last_us, session_length, clicks FROM found",
    "session_snapshot": _USER_SESSIONS + _SNAPSHOT,
    "live_sessions": _USER_SESSIONS
    + _SNAPSHOT
    + """ AND epoch_us(TIMESTAMP '2024-01-31 00:00:00') - last_us <= 43200000000
    AND start_us <= epoch_us(TIMESTAMP '2024-01-31 00:00:00')""",
    "error_ratio": _STATUS
    + """
SELECT window_end, n, success, failure, coalesce(round(ratio, 9), -1) AS ratio,
    CASE WHEN n = 0 THEN 'empty' WHEN ratio IS NULL THEN 'too_few' WHEN ratio > 0.5 THEN 'alarm' ELSE 'ok' END AS state
FROM rated""",
    "no_data_alarms": _GAP_STATUS + " SELECT * FROM silent",
    "alarms_issued": _STATUS + _alarms("1.0::DOUBLE / 3.0::DOUBLE") + _ISSUED,
    "alarms_issued_with_silence": _GAP_STATUS + _alarms("0.5::DOUBLE") + _ISSUED,
    "alarm_log": _STATUS + _alarms("1.0::DOUBLE / 3.0::DOUBLE") + _FATES,
    "alarm_log_with_silence": _GAP_STATUS + _alarms("1.0::DOUBLE / 3.0::DOUBLE") + _FATES,
    "kmeans_assign": _CENTRES + " SELECT vec_id, label, cluster FROM assigned",
    "parsed_vectors": """
SELECT vec_id, len(embedding)::INT AS n, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings""",
    "parsed_points": f"WITH {_XY} SELECT id, round(label, 6) AS label, round(feature, 6) AS feature FROM xy",
    "kmeans_agreement": _CENTRES + " SELECT label, cluster, count(*) AS n FROM assigned GROUP BY ALL",
    "kmeans_step": _CENTRES
    + """,
axes AS (SELECT cluster, v, unnest(range(0, len(v)))::INT AS axis FROM assigned)
SELECT cluster, count(*) AS n, axis, round(sum(v[axis + 1]) / count(*), 6) AS centre FROM axes GROUP BY cluster, axis""",
    "regression_exact": f"""WITH {_XY}
SELECT round(regr_slope(label, feature), 6) AS slope, round(regr_intercept(label, feature), 6) AS intercept,
    round(regr_r2(label, feature), 6) AS r2 FROM xy""",
    "regression_predict": _FIT
    + """
SELECT count(*) AS n, round(avg(abs(feature * slope + intercept - label)), 6) AS mean_abs,
    round(sqrt(avg(power(feature * slope + intercept - label, 2))), 6) AS rmse FROM xy, fit""",
    "regression_sgd": f"""WITH RECURSIVE {_XY},
s AS (
    SELECT count(*)::DOUBLE AS n, sum(feature) AS sx, sum(label) AS sy, sum(feature * feature) AS sxx,
        sum(feature * label) AS sxy FROM xy),
steps(i, w, b, done) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, false
    UNION ALL
    SELECT i, nw, nb, i > 1 AND sqrt(power(nw - w, 2) + power(nb - b, 2))
        < 0.001::DOUBLE * greatest(sqrt(nw * nw + nb * nb), 1.0::DOUBLE)
    FROM (
        SELECT i + 1 AS i, w, b,
            w - 0.1::DOUBLE / sqrt(i + 1) * (w * sxx + b * sx - sxy) / n AS nw,
            b - 0.1::DOUBLE / sqrt(i + 1) * (w * sx + b * n - sy) / n AS nb
        FROM steps, s WHERE i < 50 AND NOT done))
SELECT round(arg_max(w, i), 6) AS slope, round(arg_max(b, i), 6) AS intercept FROM steps""",
    "standardised_moments": f"""WITH {_XY},
m AS (
    SELECT avg(feature) AS fm, stddev_pop(feature) AS fd, avg(label) AS lm, stddev_pop(label) AS ld FROM xy),
z AS (SELECT (feature - fm) / fd AS x, (label - lm) / ld AS y FROM xy, m)
SELECT count(*)::DOUBLE AS n, round(sum(x * x), 5) + 0.0 AS sxx, round(sum(x * y), 5) + 0.0 AS sxy FROM z""",
}


_ORACLE |= {
    "stream_status_by_window": _ORACLE["status_by_window"],
    "stream_total_lengths": _ORACLE["total_lengths"],
    "stream_top_urls": _ORACLE["top_urls"],
    "stream_trending_terms": _ORACLE["trending_terms"],
    "stream_alarm_log": _ORACLE["alarm_log"],
    "stream_alarm_log_with_silence": _ORACLE["alarm_log_with_silence"],
    "stream_top_agents": _ORACLE["leading_agents"],
    "stream_text_status": _ORACLE["status_by_window"],
    "stream_json_lengths": _ORACLE["total_lengths"],
    "stream_kmeans_scores": _ORACLE["kmeans_agreement"],
    "stream_agent_counts": _ORACLE["agent_counts_sql"],
    "stream_sessions": _ORACLE["sessions_by_user"],
    "stream_kmeans": _ORACLE["kmeans_step"],
    "stream_regression": _ORACLE["regression_sgd"],
    "stream_feed_posts": f"WITH {_POSTS} SELECT id, t AS at, text FROM posts",
    "stream_saved_posts": f"WITH {_POSTS} SELECT text, count(*) AS n FROM posts GROUP BY text",
}


_PART = "({at} - min({at}) OVER ()) * 4 // (max({at}) OVER () - min({at}) OVER () + 1)"


def _kmeans_batches(decay: float) -> str:
    """Centres (``m<p>``) before each of four batches, and the batch's vectors with their cluster (``a<p>``)."""
    steps = [
        f"points AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, {_PART.format(at='vec_id')} AS part FROM embeddings)",
        "c0 AS (SELECT label % 5 AS g, arg_min(embedding::DOUBLE[], vec_id) AS c FROM embeddings GROUP BY ALL)",
        "m0 AS (SELECT (row_number() OVER (ORDER BY g) - 1)::INT AS cluster, c, 0.0::DOUBLE AS w FROM c0)",
    ]
    for p in range(4):
        steps += [
            f"""a{p} AS (
                SELECT vec_id, label, v, cluster, list_sum([power(v[i] - c[i], 2) FOR i IN range(1, len(c) + 1)]) AS d
                FROM points, m{p} WHERE part = {p} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)""",
            f"x{p} AS (SELECT cluster, v, unnest(range(1, len(v) + 1)) AS axis FROM a{p})",
            f"s{p} AS (SELECT cluster, axis, sum(v[axis]) AS total, count(*) AS n FROM x{p} GROUP BY cluster, axis)",
            f"t{p} AS (SELECT cluster, any_value(n) AS n, list(total ORDER BY axis) AS total FROM s{p} GROUP BY cluster)",
            f"""m{p + 1} AS (
                SELECT m{p}.cluster, w * {decay}::DOUBLE + coalesce(n, 0) AS w, CASE WHEN n IS NULL THEN c ELSE
                    [c[i] * (1 - n / (w * {decay}::DOUBLE + n)) + n / (w * {decay}::DOUBLE + n) * (total[i] / n) FOR i IN range(1, len(c) + 1)] END AS c
                FROM m{p} LEFT JOIN t{p} ON t{p}.cluster = m{p}.cluster)""",
        ]
    return "WITH " + ", ".join(steps)


def _line_batches() -> str:
    """Gradient steps over four batches, each from the slope before it."""
    steps = [
        f"""parted AS (SELECT event_id AS id, {_PART.format(at='epoch_us(ts)')} AS part FROM events)""",
        """s AS (
    SELECT part, count(*)::DOUBLE AS n, sum(feature) AS sx, sum(label) AS sy, sum(feature * feature) AS sxx, sum(feature * label) AS sxy
    FROM xy JOIN parted USING (id) GROUP BY part)""",
        "l0 AS (SELECT 0.0::DOUBLE AS w)",
    ]
    for p in range(4):
        steps += [
            f"""g{p}(i, w, b, done) AS (
    SELECT 0, w, 1.0::DOUBLE, false FROM l{p}
    UNION ALL
    SELECT i, nw, nb, i > 1 AND sqrt(power(nw - w, 2) + power(nb - b, 2)) < 0.001::DOUBLE * greatest(sqrt(nw * nw + nb * nb), 1.0::DOUBLE)
    FROM (
        SELECT i + 1 AS i, w, b,
            w - 0.1::DOUBLE / sqrt(i + 1) * (w * sxx + b * sx - sxy) / n AS nw, b - 0.1::DOUBLE / sqrt(i + 1) * (w * sx + b * n - sy) / n AS nb
        FROM g{p}, s WHERE part = {p} AND i < 50 AND NOT done))""",
            f"l{p + 1} AS (SELECT arg_max(w, i) AS w, arg_max(b, i) AS b FROM g{p})",
        ]
    return f"WITH RECURSIVE {_XY}, " + ", ".join(steps)


#: How late rows may come in streams of four parts, in log time.
_LATE = f"((max(epoch_us(ts)) // 1000000 - min(epoch_us(ts)) // 1000000) // 4 + 1) // {SQUEEZE} + 2"

_ORACLE |= {
    "stream_session_hits": "WITH base AS (SELECT * FROM events)"
    + _sessions("base", "user_id", "epoch_us(ts)", "event_type", 12 * 3600 * 1000000)
    + f""",
parted AS (SELECT event_id, {_PART.format(at='epoch_us(ts)')} AS part FROM events)
SELECT k AS user_id, seq AS event_id, min(moment) OVER s AS start_us, moment AS last_us, row_number() OVER s AS session_length,
    array_to_string((list(item) OVER s)[1:10], ' ') AS clicks
FROM numbered JOIN parted ON event_id = seq
WINDOW s AS (PARTITION BY k, session ORDER BY moment, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) QUALIFY part >= 2""",
    "stream_session_snapshot": _USER_SESSIONS
    + _SNAPSHOT
    + " AND last_us + 43200000000 >= (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM events)",
    "stream_closed_windows": f"SELECT * FROM ({_ORACLE['status_by_window']}) WHERE window_end <= (SELECT max(t) FROM ({'WITH ' + _TIMED + ' SELECT t FROM timed'})) - (SELECT {_LATE} FROM events)",
    "stream_saved_until": f"""WITH {_POSTS},
parted AS (SELECT text, (t - min(t) OVER ()) // ((max(t) OVER () - min(t) OVER ()) // 4 + 1) AS part FROM posts),
sizes AS (SELECT part, coalesce(sum(count(*)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM parted GROUP BY part)
SELECT text, count(*) AS n FROM parted JOIN sizes USING (part) WHERE before <= 1000 GROUP BY text""",
    "stream_train_and_score": _kmeans_batches(0.5)
    + " SELECT label, cluster, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT label, cluster FROM a{p}" for p in range(4))
    + ") GROUP BY ALL",
    "stream_kmeans_decay": _kmeans_batches(0.5)
    + " SELECT cluster, round(w, 6) AS n, axis, round(c[axis + 1], 6) AS centre FROM (SELECT *, unnest(range(0, len(c)))::INT AS axis FROM m4)",
    "stream_silences": _ORACLE["no_data_alarms"],
    "stream_regression_batches": _line_batches() + " SELECT round(w, 6) AS slope, round(b, 6) AS intercept FROM l4",
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLE)
