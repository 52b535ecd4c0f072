"""DuckDB statements that compute the registered queries independently."""

from __future__ import annotations

# Spark's English stop words (its default list for removing stop words).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's
where's who's why's would
""".split()

ROLES = {
    "us": """
        SELECT c_custkey AS user_id, c_name AS name,
            lower(replace(c_name, '#', '.')) || '@example.com' AS email,
            '+1-555-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone,
            n_name AS country,
            DATE '2023-01-01' + (c_custkey % 365)::INTEGER AS registration_date,
            CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Premium'
                 WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Standard'
                 ELSE 'Basic' END AS tier,
            CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "ct": """
        SELECT p_partkey AS content_id, p_name AS title,
            CASE p_size % 3 WHEN 0 THEN 'Movie' WHEN 1 THEN 'Series' ELSE 'Documentary' END AS content_type,
            p_type AS genre, 1974 + p_size AS release_year, 30 + 2 * p_size AS duration_mins,
            5.0::DOUBLE + ((p_partkey * 37) % 50)::DOUBLE / 10.0::DOUBLE AS rating, p_brand AS director
        FROM part""",
    "ev": """
        SELECT event_id, user_id, event_type, content_id,
            CASE WHEN event_type = 'video_watch' THEN floor(value)::INTEGER ELSE 0 END AS watch_time_mins,
            device, 'sess_' || user_id || '_' || strftime(moved, '%Y-%m-%d') AS session_id,
            moved AS "timestamp", ip_address
        FROM (
            SELECT event_id, user_id, value, ts - to_days((user_id % 25)::INTEGER) AS moved,
                CASE WHEN event_type = 'view' AND user_id % 10 = 7 THEN 'content_view'
                     WHEN event_type = 'view' THEN 'video_watch'
                     WHEN event_type = 'click' THEN 'search'
                     WHEN event_type = 'purchase' THEN 'subscription'
                     WHEN event_type = 'signup' THEN 'user_login'
                     ELSE event_type END AS event_type,
                CASE WHEN event_type <> 'signup' THEN json_extract_string(props, '$.k')::BIGINT END AS content_id,
                CASE event_id % 4 WHEN 0 THEN 'Smart TV' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Web'
                     ELSE 'Tablet' END AS device,
                '10.' || ((user_id + event_id % (1 + user_id % 4)) % 256) || '.0.1' AS ip_address
            FROM events)""",
    "sb": """
        SELECT o_orderkey AS sub_id, o_custkey AS user_id, o_orderpriority AS plan_name,
            (floor(o_totalprice / 100)::BIGINT * 0.01)::DECIMAL(12, 2) AS monthly_price,
            o_orderdate::DATE AS start_date, o_orderdate::DATE + 30 AS renewal_date,
            CASE o_orderkey % 10 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'expired' ELSE 'active' END AS status,
            CASE o_orderstatus WHEN 'F' THEN 'credit_card' WHEN 'O' THEN 'paypal'
                 ELSE 'bank_transfer' END AS payment_method
        FROM orders""",
    "ev_raw": """
        SELECT 'EVT' || event_id AS event_id,
            CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 83 = 0 THEN '  '
                 ELSE 'U' || user_id END AS user_id,
            event_type, 'C' || content_id AS content_id,
            CASE WHEN event_id % 37 = 0 THEN '-10' WHEN event_id % 53 = 0 THEN 'abc'
                 ELSE watch_time_mins::VARCHAR END AS watch_time_mins,
            CASE WHEN event_id % 29 = 0 THEN NULL ELSE device END AS device,
            CASE WHEN event_id % 31 = 0 THEN NULL ELSE session_id END AS session_id,
            CASE WHEN event_id % 43 = 0 THEN 'malformed-date'
                 ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS "timestamp",
            ip_address, 2 * event_id + k AS ord
        FROM ev, (VALUES (0), (1)) c(k) WHERE k = 0 OR event_id % 50 = 0""",
    "us_raw": """
        SELECT CASE WHEN user_id % 97 = 0 THEN NULL ELSE 'U' || user_id END AS user_id,
            CASE WHEN user_id % 31 = 0 THEN NULL ELSE ' ' || name || chr(9) END AS name,
            CASE WHEN user_id % 47 = 0 THEN 'no-at-sign' WHEN user_id % 59 = 0 THEN NULL ELSE email END AS email,
            CASE WHEN user_id % 23 = 0 THEN '12' WHEN user_id % 37 = 0 THEN NULL ELSE phone END AS phone,
            CASE WHEN user_id % 19 = 0 THEN NULL ELSE country END AS country,
            CASE WHEN user_id % 43 = 0 THEN 'not-a-date'
                 ELSE registration_date::DATE::VARCHAR END AS registration_date,
            CASE WHEN user_id % 29 = 0 THEN NULL ELSE tier END AS tier,
            CASE WHEN user_id % 37 = 0 THEN NULL ELSE status END AS status,
            2 * user_id + k AS ord
        FROM us, (VALUES (0), (1)) c(k) WHERE k = 0 OR user_id % 60 = 0""",
    "ct_raw": """
        SELECT 'C' || content_id AS content_id,
            CASE WHEN content_id % 61 = 0 THEN NULL ELSE '  ' || title END AS title,
            CASE WHEN content_id % 67 = 0 THEN NULL ELSE content_type END AS content_type,
            CASE WHEN content_id % 71 = 0 THEN NULL ELSE genre END AS genre,
            CASE WHEN content_id % 41 = 0 THEN 'n/a' ELSE release_year::VARCHAR END AS release_year,
            CASE WHEN content_id % 13 = 0 THEN NULL WHEN content_id % 11 = 0 THEN '95.7'
                 ELSE duration_mins::VARCHAR END AS duration_mins,
            CASE WHEN content_id % 19 = 0 THEN 'bad' WHEN content_id % 17 = 0 THEN '7.26'
                 ELSE rating::VARCHAR END AS rating,
            CASE WHEN content_id % 23 = 0 THEN NULL ELSE director END AS director,
            2 * content_id + k AS ord
        FROM ct, (VALUES (0), (1)) c(k) WHERE k = 0 OR content_id % 50 = 0""",
    "sb_raw": """
        SELECT 'S' || sub_id AS sub_id,
            CASE WHEN sub_id % 67 = 0 THEN NULL ELSE 'U' || user_id END AS user_id,
            CASE WHEN sub_id % 31 = 0 THEN NULL ELSE plan_name END AS plan_name,
            CASE WHEN sub_id % 71 = 0 THEN 'free' WHEN sub_id % 73 = 0 THEN NULL
                 ELSE (-monthly_price)::VARCHAR END AS monthly_price,
            CASE WHEN sub_id % 43 = 0 THEN 'soon' ELSE start_date::VARCHAR END AS start_date,
            CASE WHEN sub_id % 29 = 0 THEN 'later' ELSE renewal_date::DATE::VARCHAR END AS renewal_date,
            CASE WHEN sub_id % 19 = 0 THEN NULL ELSE status END AS status,
            CASE WHEN sub_id % 23 = 0 THEN NULL ELSE payment_method END AS payment_method,
            2 * sub_id + k AS ord
        FROM sb, (VALUES (0), (1)) c(k) WHERE k = 0 OR sub_id % 50 = 0""",
    "qs": """
        SELECT conv_id, turn, CASE conv_id % 7
            WHEN 0 THEN 'Which content has the highest watch time?'
            WHEN 1 THEN 'Which users are most active?'
            WHEN 2 THEN 'What were the most common events today?'
            WHEN 3 THEN 'Which content is trending?'
            WHEN 4 THEN 'Summarize the current data quality status.'
            WHEN 5 THEN 'What is our subscription MRR and breakdown?'
            ELSE 'Hello.' END || ' ' || text AS question
        FROM conversations WHERE role = 'user'""",
}

VERBS = "('user_login','content_view','video_watch','search','add_to_watchlist','subscription','logout')"
TIERS = "('Basic','Standard','Premium')"
WS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)"
    "||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)"
    "||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)
WS_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def stamp(x: str, name: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S') AS {name}"


def r1(x: str) -> str:
    return f"round_even(({x}) * 10.0::DOUBLE, 0)::DOUBLE / 10.0::DOUBLE"


def with_(sql: str, *extra: str) -> str:
    """Prefix the statement with the role tables it mentions."""
    chain = {"ev_raw": "ev", "us_raw": "us", "ct_raw": "ct", "sb_raw": "sb"}
    body = " ".join([*extra, sql])
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in body).split())
    needed = {r for r in ROLES if r in words}
    needed |= {chain[r] for r in needed if r in chain}
    parts = [f"{r} AS ({ROLES[r]})" for r in ROLES if r in needed] + list(extra)
    return (f"WITH {', '.join(parts)} " if parts else "") + sql


# --- rule flags -------------------------------------------------------------------

EV_FLAGS = f"""evf AS (
    SELECT ord, event_id, user_id, event_type, watch_time_mins, "timestamp",
        count(*) OVER (PARTITION BY event_id) > 1 AS is_duplicate,
        (user_id IS NULL OR {strip('user_id')} = '') AS invalid_user_ids,
        NOT coalesce(event_type IN {VERBS}, false) AS invalid_event_types,
        coalesce(try_cast(watch_time_mins AS DOUBLE) < 0, true) AS invalid_numerics,
        try_cast("timestamp" AS TIMESTAMP) IS NULL AS invalid_timestamps,
        (event_id IS NULL)::INT + (user_id IS NULL)::INT + (event_type IS NULL)::INT + (content_id IS NULL)::INT
        + (watch_time_mins IS NULL)::INT + (device IS NULL)::INT + (session_id IS NULL)::INT
        + ("timestamp" IS NULL)::INT + (ip_address IS NULL)::INT AS nulls
    FROM ev_raw)"""
EV_BAD = "(is_duplicate OR invalid_user_ids OR invalid_event_types OR invalid_numerics OR invalid_timestamps)"
CLEAN_FLAGS = EV_FLAGS.replace("evf AS", "evc AS").replace("ord, ", "").replace("FROM ev_raw", "FROM (SELECT * REPLACE (user_id::VARCHAR AS user_id) FROM ev)")
US_FLAGS = f"""usf AS (
    SELECT ord, user_id,
        count(*) OVER (PARTITION BY user_id) > 1 AS is_duplicate,
        (user_id IS NULL OR {strip('user_id')} = '') AS invalid_user_ids,
        (email IS NULL OR NOT contains(email, '@')) AS invalid_emails,
        try_cast(registration_date AS TIMESTAMP) IS NULL AS invalid_dates,
        (user_id IS NULL)::INT + (name IS NULL)::INT + (email IS NULL)::INT + (phone IS NULL)::INT
        + (country IS NULL)::INT + (registration_date IS NULL)::INT + (tier IS NULL)::INT
        + (status IS NULL)::INT AS nulls
    FROM us_raw)"""
US_BAD = "(is_duplicate OR invalid_user_ids OR invalid_emails OR invalid_dates)"


def audit(dataset: str) -> str:
    table, bad, width = {"events": ("evf", EV_BAD, 9), "users": ("usf", US_BAD, 8)}[dataset]
    return f"""(SELECT *, valid_records::DOUBLE AS v,
        least(greatest({r1(f'''(0.50::DOUBLE * (valid_records::DOUBLE / total_records)
            + 0.25::DOUBLE * (1.0::DOUBLE - duplicates::DOUBLE / total_records)
            + 0.25::DOUBLE * (1.0::DOUBLE - missing_values::DOUBLE / (total_records * {width}))) * 100.0::DOUBLE''')},
            0.0::DOUBLE), 100.0::DOUBLE) AS dq_score
      FROM (SELECT '{dataset}' AS dataset, count(*) AS total_records,
          count(*) FILTER (WHERE NOT {bad}) AS valid_records,
          count(*) FILTER (WHERE {bad}) AS invalid_records,
          count(*) FILTER (WHERE is_duplicate) AS duplicates,
          sum(nulls)::BIGINT AS missing_values FROM {table}))"""


COLS = {
    "users": ("us_raw", "user_id name email phone country registration_date tier status".split()),
    "content": (
        "ct_raw",
        "content_id title content_type genre release_year duration_mins rating director".split(),
    ),
    "subscriptions": (
        "sb_raw",
        "sub_id user_id plan_name monthly_price start_date renewal_date status payment_method".split(),
    ),
    "events": (
        "ev_raw",
        "event_id user_id event_type content_id watch_time_mins device session_id timestamp ip_address".split(),
    ),
}
KEY = {"users": "user_id", "content": "content_id", "subscriptions": "sub_id", "events": "event_id"}
EXPECT = {
    "content": {"release_year": "int64", "duration_mins": "int64", "rating": "float64"},
    "subscriptions": {"monthly_price": "float64"},
    "events": {"watch_time_mins": "int64"},
}


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def null_profile(d: str) -> str:
    t, cols = COLS[d]
    return union(
        f"""SELECT '{d}' AS dataset, '{c}' AS column_name, count(*) FILTER (WHERE "{c}" IS NULL) AS missing_values
            FROM {t}"""
        for c in cols
    )


def type_rows(d: str) -> str:
    t, cols = COLS[d]
    rows = union(
        f"""SELECT '{c}' AS column_name, '{EXPECT.get(d, {}).get(c, "object")}' AS expected,
            CASE WHEN count("{c}") = 0 THEN 'float64'
                WHEN count(*) FILTER (WHERE lower("{c}") IN ('true', 'false')) = count(*) THEN 'bool'
                WHEN count(*) FILTER (WHERE regexp_full_match("{c}", '\\s*[+-]?[0-9]+\\s*')) = count(*) THEN 'int64'
                WHEN count(try_cast("{c}" AS DOUBLE)) = count("{c}") THEN 'float64'
                ELSE 'object' END AS actual FROM {t}"""
        for c in cols
    )
    return f"""SELECT '{d}' AS dataset, column_name, 'type_mismatch' AS kind, expected, actual,
        'WARNING: Column ''' || column_name || ''' expected ' || expected || ', got ' || actual AS warning
        FROM ({rows}) WHERE NOT (expected = actual OR (expected = 'int64' AND contains(actual, 'int'))
            OR (expected = 'float64' AND (contains(actual, 'float') OR contains(actual, 'int')))
            OR (expected = 'object' AND contains(actual, 'str')))"""


def mismatches() -> str:
    return f"""SELECT *, 'Medium' AS severity FROM ({union(type_rows(d) for d in COLS)})"""


def arrivals(kind: str) -> str:
    """Column differences of the supplied event table from the contract."""
    arrived = "SELECT column_name FROM (DESCRIBE SELECT * FROM events)"
    cols = ", ".join(f"('{c}')" for c in COLS["events"][1])
    if kind == "added":
        return f"""SELECT 'events' AS dataset, column_name, 'added' AS kind, NULL::VARCHAR AS expected,
            CASE WHEN column_type LIKE '%INT%' THEN 'int64' WHEN column_type = 'DOUBLE' THEN 'float64'
                 WHEN column_type LIKE 'TIMESTAMP%' THEN 'datetime64[ns]' ELSE 'object' END AS actual,
            'WARNING: New column detected: ''' || column_name || ''' (Potential Schema Expansion)' AS warning,
            'High' AS severity
            FROM (DESCRIBE SELECT * FROM events) WHERE column_name NOT IN (SELECT * FROM (VALUES {cols}))"""
    return f"""SELECT 'events' AS dataset, c AS column_name, 'missing' AS kind,
        CASE c WHEN 'watch_time_mins' THEN 'int64' ELSE 'object' END AS expected, NULL::VARCHAR AS actual,
        'CRITICAL: Missing expected column: ''' || c || '''' AS warning, 'High' AS severity
        FROM (VALUES {cols}) v(c) WHERE c NOT IN ({arrived})"""


def drift_report() -> str:
    supplied = f"""SELECT 'events' AS dataset, column_name, 'type_mismatch' AS kind, 'object' AS expected,
        'int64' AS actual, 'WARNING: Column ''' || column_name || ''' expected object, got int64' AS warning,
        'High' AS severity FROM (DESCRIBE SELECT * FROM events)
        WHERE column_name IN ('event_id', 'user_id') AND column_type LIKE '%INT%'"""
    others = union(type_rows(d) for d in COLS if d != "events")
    return union([arrivals("added"), arrivals("missing"), supplied, f"SELECT *, 'Medium' AS severity FROM ({others})"])


def first_of(d: str) -> str:
    t = COLS[d][0]
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY[d]} ORDER BY ord) AS rn
        FROM {t}) WHERE rn = 1)"""


def filled(c: str, default: str) -> str:
    return f"{strip(f'''coalesce({c}, '{default}')''')} AS {c}"


EMAIL = """CASE WHEN email IS NULL THEN '' WHEN NOT contains(email, '@') THEN email
    ELSE left(split_part(email, '@', 1), 1) || CASE WHEN length(split_part(email, '@', 1)) <= 2 THEN '*'
        ELSE repeat('*', length(split_part(email, '@', 1)) - 2) || right(split_part(email, '@', 1), 1) END
        || '@' || split_part(email, '@', 2) END"""
PHONE = r"""CASE WHEN coalesce(phone, '') = '' THEN ''
    WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) < 4 THEN '***'
    ELSE '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) END"""
IP = r"""CASE WHEN ip_address IS NULL THEN ''
    WHEN length(ip_address) - length(replace(ip_address, '.', '')) = 3
    THEN split_part(ip_address, '.', 1) || '.' || split_part(ip_address, '.', 2) || '.*.*' ELSE ip_address END"""

CLEAN = {
    "users": f"""SELECT user_id, {filled('name', 'Anonymous User')}, email, phone, {filled('country', 'Global')},
        try_cast(registration_date AS DATE)::VARCHAR AS registration_date,
        {filled('tier', 'Basic')}, {filled('status', 'active')}
        FROM {first_of('users')} WHERE user_id IS NOT NULL AND try_cast(registration_date AS DATE) IS NOT NULL""",
    "content": f"""SELECT content_id, {filled('title', 'Untitled Content')}, {filled('content_type', 'Movie')},
        {filled('genre', 'General')},
        coalesce(trunc(try_cast(release_year AS DOUBLE)), 2023)::BIGINT AS release_year,
        coalesce(trunc(try_cast(duration_mins AS DOUBLE)), 90)::BIGINT AS duration_mins,
        {r1("coalesce(try_cast(rating AS DOUBLE), 7.0)")} AS rating, {filled('director', 'Unknown Director')}
        FROM {first_of('content')}""",
    "subscriptions": f"""SELECT sub_id, user_id, {filled('plan_name', 'Standard HD')},
        round_even(abs(coalesce(try_cast(monthly_price AS DOUBLE), 9.99::DOUBLE)) * 100.0::DOUBLE, 0)::DOUBLE
            / 100.0::DOUBLE AS monthly_price,
        try_cast(start_date AS DATE)::VARCHAR AS start_date, try_cast(renewal_date AS DATE)::VARCHAR AS renewal_date,
        {filled('status', 'active')}, {filled('payment_method', 'credit_card')}
        FROM {first_of('subscriptions')}
        WHERE sub_id IS NOT NULL AND user_id IS NOT NULL AND try_cast(start_date AS DATE) IS NOT NULL""",
    "events": f"""SELECT event_id, user_id, event_type, content_id,
        greatest(coalesce(trunc(try_cast(watch_time_mins AS DOUBLE)), 0), 0)::BIGINT AS watch_time_mins,
        {filled('device', 'Smart TV')}, {filled('session_id', 'sess_gen')},
        {stamp('try_cast("timestamp" AS TIMESTAMP)', '"timestamp"')}, {IP} AS ip_address
        FROM {first_of('events')}
        WHERE event_type IN {VERBS} AND {strip('user_id')} <> '' AND try_cast("timestamp" AS TIMESTAMP) IS NOT NULL""",
}


def clean_stats(d: str) -> str:
    t = COLS[d][0]
    return f"""SELECT '{d}' AS dataset, (SELECT count(*) FROM {t}) AS initial_rows,
        (SELECT count(*) FROM ({CLEAN[d]})) AS cleaned_rows,
        (SELECT count(*) FROM {t}) - (SELECT count(*) FROM {first_of(d)}) AS duplicates_removed,
        (SELECT count(*) FROM {first_of(d)}) - (SELECT count(*) FROM ({CLEAN[d]})) AS invalid_dropped"""


HISTORY = f"""wh AS (
    SELECT 'WH_' || CASE WHEN length(n::VARCHAR) < 4 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS history_id,
        user_id, content_id, total_watch_time_mins, completion_percentage,
        {stamp('last_watched_at', 'last_watched_at')}, completion_percentage >= 90.0 AS completed
    FROM (SELECT *, row_number() OVER (ORDER BY user_id, content_id) AS n,
            least({r1('total_watch_time_mins::DOUBLE / duration_mins * 100.0::DOUBLE')}, 100.0::DOUBLE)
                AS completion_percentage
        FROM (SELECT user_id, ev.content_id, sum(watch_time_mins)::BIGINT AS total_watch_time_mins,
                max("timestamp") AS last_watched_at, coalesce(max(duration_mins), 90) AS duration_mins
            FROM ev LEFT JOIN ct ON ev.content_id = ct.content_id
            WHERE event_type = 'video_watch' AND user_id IS NOT NULL AND ev.content_id IS NOT NULL
            GROUP BY user_id, ev.content_id)))"""

STG_EV = """stg_ev AS (SELECT event_id, user_id, lower(trim(event_type)) AS event_type, content_id,
    coalesce(watch_time_mins, 0) AS watch_time_mins, device, session_id, "timestamp", ip_address
    FROM ev WHERE user_id IS NOT NULL)"""

FACT = f"""fact AS (
    SELECT u.user_id, any_value(u.name) AS name, any_value(u.country) AS country, any_value(u.tier) AS tier,
        count(e.event_id) AS total_events,
        coalesce(sum(CASE WHEN e.event_type = 'video_watch' THEN e.watch_time_mins ELSE 0 END), 0)::BIGINT
            AS total_watch_mins,
        count(DISTINCT e.content_id) AS distinct_content_consumed,
        {stamp('max(e."timestamp")', 'last_active_at')}
    FROM us u LEFT JOIN stg_ev e ON u.user_id = e.user_id GROUP BY u.user_id)"""

# Topics and the phrases that lead to them.
TOPICS = (
    ("Content Analytics", ("watch time", "most watched", "highest watch", "longest")),
    ("User Analytics", ("active user", "most active", "top user", "user activity")),
    ("Event Stream Analytics", ("common event", "events today", "event type", "most common", "event breakdown")),
    ("Trend Analysis", ("trending", "popular", "frequent")),
    ("Data Governance & Quality", ("data quality", "quality status", "dq", "duplicates", "null")),
    ("Financial Analytics", ("subscription", "revenue", "mrr", "plan", "paying")),
)

RPT = {
    "watched": """SELECT title, genre, content_type, rating, sum(watch_time_mins)::BIGINT AS total_watch_mins,
        count(e.event_id) AS total_sessions FROM ct c JOIN ev e ON c.content_id = e.content_id
        WHERE event_type = 'video_watch' GROUP BY title, genre, content_type, rating
        ORDER BY total_watch_mins DESC, title, genre, content_type, rating LIMIT 5""",
    "users": """SELECT u.user_id, u.name, u.country, u.tier, count(e.event_id) AS total_interactions,
        sum(CASE WHEN event_type = 'video_watch' THEN watch_time_mins ELSE 0 END)::BIGINT AS total_watch_mins
        FROM us u JOIN ev e ON u.user_id = e.user_id GROUP BY ALL
        ORDER BY total_watch_mins DESC, total_interactions DESC, u.user_id LIMIT 5""",
    "mix": """SELECT event_type, count(*) AS event_count,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev), 1) AS percentage_share
        FROM ev GROUP BY event_type ORDER BY event_count DESC, event_type""",
    "trend": """SELECT c.content_id, c.title, c.content_type, c.genre, count(e.event_id) AS total_interactions,
        sum(e.watch_time_mins)::BIGINT AS watch_time_mins FROM ct c JOIN ev e ON c.content_id = e.content_id
        GROUP BY ALL ORDER BY total_interactions DESC, c.content_id LIMIT 5""",
    "revenue": """SELECT plan_name, count(sub_id) AS active_subscribers,
        round(sum(monthly_price), 2)::DOUBLE AS monthly_revenue,
        round(sum(monthly_price)::DOUBLE / count(monthly_price), 2) AS avg_price
        FROM sb WHERE status = 'active' GROUP BY plan_name ORDER BY monthly_revenue DESC, plan_name""",
}


def nth(report: str, column: str, n: int) -> str:
    return f"(SELECT {column} FROM ({RPT[report]}) LIMIT 1 OFFSET {n})"


NARRATIVE = union(
    [
        f"""SELECT 'Content Analytics' AS category, '**' || {nth('watched', 'title', 0)}
            || '** leads the platform with **' || format('{{:,}}', {nth('watched', 'total_watch_mins', 0)})
            || ' total watch minutes** across ' || {nth('watched', 'total_sessions', 0)}
            || ' streaming sessions. Followed by *' || {nth('watched', 'title', 1)} || '* ('
            || {nth('watched', 'total_watch_mins', 1)} || ' mins).' AS answer""",
        f"""SELECT 'User Analytics', 'The most active user is **' || {nth('users', 'name', 0)} || '** ('
            || {nth('users', 'tier', 0)} || ' tier from ' || {nth('users', 'country', 0)} || ') with **'
            || {nth('users', 'total_watch_mins', 0)} || ' streaming minutes** and '
            || {nth('users', 'total_interactions', 0)} || ' total platform interactions.'""",
        f"""SELECT 'Event Stream Analytics', 'The most frequent event type is **`' || {nth('mix', 'event_type', 0)}
            || '`** with **' || {nth('mix', 'event_count', 0)} || ' occurrences** ('
            || {nth('mix', 'percentage_share', 0)} || '% of all platform traffic), followed by `'
            || {nth('mix', 'event_type', 1)} || '` (' || {nth('mix', 'event_count', 1)} || ' events).'""",
        f"""SELECT 'Trend Analysis', 'Trending content is led by **' || {nth('trend', 'title', 0)} || '** ('
            || {nth('trend', 'genre', 0)} || ') with ' || {nth('trend', 'total_interactions', 0)}
            || ' total user interactions and ' || {nth('trend', 'watch_time_mins', 0)} || ' minutes watched.'""",
        f"""SELECT 'Data Governance & Quality',
            '**Data Quality Status**: Operational warehouse tables are clean and healthy. Events health is at **'
            || (SELECT dq_score FROM {audit('events').replace('evf', 'evc')})::VARCHAR
            || '%**, with zero unresolved duplicates remaining after ETL deduplication.'""",
        f"""SELECT 'Financial Analytics', 'Total Monthly Recurring Revenue (MRR) stands at **'
            || format('${{:,.2f}}', (SELECT sum(monthly_revenue) FROM ({RPT['revenue']})))
            || '**. The top revenue driver is **' || {nth('revenue', 'plan_name', 0)} || '** bringing in '
            || format('${{:,.2f}}', {nth('revenue', 'monthly_revenue', 0)}) || '.'""",
        """SELECT 'Platform Summary', 'Here is the high-level platform summary: **' || (SELECT count(*) FROM us)
            || ' users**, **' || (SELECT count(*) FROM ct) || ' catalog titles**, and **'
            || (SELECT count(*) FROM ev) || ' events logged**. Try asking specific questions like: '
            || '*''Which content has the highest watch time?''* or *''Which users are most active?''*'""",
    ]
)

CHURN_FEATURES = """cf AS (
    SELECT u.user_id, u.name, u.email, u.country, u.tier, coalesce(n, 0) AS total_events,
        CASE WHEN last_event IS NULL THEN 30 ELSE greatest(0,
            floor(epoch((SELECT max("timestamp") FROM ev) - last_event) / 86400))::BIGINT END AS days_inactive,
        coalesce(minutes, 0)::BIGINT AS total_watch_time_mins, coalesce(watches, 0) AS watch_count,
        coalesce(errors, 0) AS error_count, coalesce(titles, 0) AS distinct_content,
        coalesce(sub_status, 'active') AS sub_status
    FROM us u
    LEFT JOIN (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'video_watch') AS watches,
            sum(watch_time_mins) FILTER (WHERE event_type = 'video_watch') AS minutes,
            count(DISTINCT content_id) AS titles, max("timestamp") AS last_event,
            count(*) FILTER (WHERE event_type IN ('buffering', 'error', 'playback_failed')) AS errors
        FROM ev GROUP BY user_id) e ON u.user_id = e.user_id
    LEFT JOIN (SELECT user_id, arg_min(status, sub_id) AS sub_status FROM sb GROUP BY user_id) s
        ON u.user_id = s.user_id)"""
CHURN = """cs AS (
    SELECT user_id, name, email, country, tier, days_inactive, total_watch_time_mins, watch_count, error_count,
        distinct_content, churn_risk_score,
        CASE WHEN churn_risk_score >= 65 THEN 'High' WHEN churn_risk_score >= 35 THEN 'Medium' ELSE 'Low' END
            AS risk_level,
        coalesce(nullif(concat_ws(' • ',
            CASE WHEN days_inactive >= 10 THEN 'Dormant: ' || days_inactive || ' days since last stream' END,
            CASE WHEN total_watch_time_mins < 45
                THEN 'Low engagement: Only ' || total_watch_time_mins || ' mins watched' END,
            CASE WHEN error_count > 0
                THEN 'Streaming friction: ' || error_count || ' playback issue(s) reported' END,
            CASE WHEN tier = 'Basic' AND churn_risk_score > 40
                THEN 'Basic tier subscriber with low catalog discovery' END), ''),
            'Healthy engagement patterns across catalog') AS risk_factors,
        CASE WHEN churn_risk_score >= 65
            THEN '🚨 Immediate Win-back: Send 25% discount voucher + highlight trending new releases'
            WHEN churn_risk_score >= 35
            THEN '⚡ Re-engagement Push: Recommend personalized watchlist based on past genres'
            ELSE '💎 Loyalty Nurture: Offer early access to 4K / VIP screenings' END AS retention_action
    FROM (SELECT *, CASE WHEN sub_status IN ('cancelled', 'expired') THEN 98.0::DOUBLE ELSE
        least(98, greatest(2, 15
            + CASE WHEN days_inactive > 20 THEN 40 WHEN days_inactive > 10 THEN 25 WHEN days_inactive > 5 THEN 10
                ELSE -10 END
            + CASE WHEN watch_count = 0 OR total_watch_time_mins < 30 THEN 25 WHEN total_watch_time_mins > 150
                THEN -20 WHEN total_watch_time_mins > 60 THEN -10 ELSE 0 END
            + CASE WHEN error_count >= 2 THEN 15 WHEN error_count = 1 THEN 8 ELSE 0 END
            + CASE WHEN distinct_content >= 3 THEN -10 ELSE 0 END
            + CASE tier WHEN 'Basic' THEN 10 WHEN 'Premium' THEN -8 ELSE 0 END))::DOUBLE END AS churn_risk_score
        FROM cf))"""

KNOWN = """seen AS (SELECT DISTINCT user_id, content_id FROM ev WHERE content_id IS NOT NULL),
    known AS (SELECT s.user_id, c.* FROM seen s JOIN ct c ON s.content_id = c.content_id),
    fg AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS rn
        FROM (SELECT user_id, genre, count(*) AS n, min(content_id) AS first FROM known GROUP BY 1, 2)
        QUALIFY rn <= 3),
    fd AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS rn
        FROM (SELECT user_id, director, count(*) AS n, min(content_id) AS first FROM known
            WHERE director <> '' GROUP BY 1, 2)
        QUALIFY rn <= 2)"""

ANOMALY = f"""
    ips AS (SELECT user_id, count(DISTINCT ip_address) AS n FROM ev WHERE user_id IS NOT NULL GROUP BY 1
        HAVING count(DISTINCT ip_address) > 2),
    devs AS (SELECT user_id, string_agg(device, ', ' ORDER BY seen_at) AS devices FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen_at) AS rn FROM (
            SELECT user_id, device, min(event_id) AS seen_at FROM ev WHERE device IS NOT NULL GROUP BY 1, 2))
        WHERE rn <= 3 GROUP BY 1),
    a_ip AS (SELECT 'ANO-ACC-' || ips.user_id AS anomaly_id, 'Security / Credential Sharing' AS category,
        'CRITICAL' AS severity, 'User ' || ips.user_id AS affected_entity,
        'Streaming activity detected across ' || n || ' distinct IP addresses and multiple devices (' || devices
            || ').' AS description,
        n || ' IPs' AS metric_value,
        'Trigger 2FA re-verification or prompt for Family Plan upgrade.' AS recommended_action
        FROM ips JOIN devs ON ips.user_id = devs.user_id),
    a_friction AS (SELECT 'ANO-QOS-01' AS anomaly_id, 'QoS / Network Degradation' AS category, 'HIGH' AS severity,
        'CDN Streaming Cluster' AS affected_entity,
        'Buffering & playback friction events represent ' || p || '% of total stream traffic (threshold: 10%).'
            AS description,
        p || '% friction' AS metric_value,
        'Auto-switch CDN edge POP or downscale initial adaptive bitrate (ABR) profile.' AS recommended_action
        FROM (SELECT r, {r1('r * 100.0::DOUBLE')} AS p FROM (
            SELECT count(*) FILTER (WHERE event_type IN ('buffering', 'error'))::DOUBLE / count(event_type) AS r
            FROM ev)) WHERE r > 0.10),
    a_long AS (SELECT 'ANO-BOT-' || event_id AS anomaly_id, 'Abnormal Playback Duration' AS category,
        'MEDIUM' AS severity, 'User ' || user_id || ' (' || device || ')' AS affected_entity,
        'Continuous playback session exceeded ' || watch_time_mins || ' minutes without user interaction.'
            AS description,
        watch_time_mins || ' mins' AS metric_value,
        'Send ''Are you still watching?'' prompt to preserve CDN bandwidth.' AS recommended_action
        FROM ev WHERE event_type = 'video_watch' AND watch_time_mins > 240),
    a_scrape AS (SELECT 'ANO-SCRAP-' || user_id AS anomaly_id, 'Automated Crawler / Scraping' AS category,
        'WARNING' AS severity, 'User ' || user_id AS affected_entity,
        'Disproportionate search requests (' || s || ' queries) with zero video playback initiation.' AS description,
        s || ' queries : 0 plays' AS metric_value,
        'Enforce rate limiting on search endpoint for this session.' AS recommended_action
        FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'search') AS s,
                count(*) FILTER (WHERE event_type = 'video_watch') AS w FROM ev GROUP BY 1)
        WHERE s >= 5 AND w = 0),
    a_all AS (SELECT * FROM a_ip UNION ALL SELECT * FROM a_friction UNION ALL SELECT * FROM a_long
        UNION ALL SELECT * FROM a_scrape)"""

CLEANED_TEXT = (
    f"""trim(regexp_replace(regexp_replace(replace(text, chr(13)||chr(10), chr(10)), '\\n{{3,}}', chr(10)||chr(10), 'g'),"""
    f""" '[ \\t]+', ' ', 'g'), {WS})"""
)
CHUNKS = f"""ws AS (SELECT doc_id::VARCHAR AS doc_id, source,
        list_filter(regexp_split_to_array(trim(text, {WS}), '{WS_CLASS}'), lambda w: w <> '') AS w FROM documents),
    starts AS (SELECT *, unnest(range(0, greatest(ceil((len(w) - 40) / 210.0), 1)::BIGINT)) AS i
        FROM ws WHERE len(w) > 0),
    ch AS (SELECT doc_id || '_c' || (i + 1) AS chunk_id, doc_id,
        array_to_string(w[i * 210 + 1 : i * 210 + 250], ' ') AS text,
        len(w[i * 210 + 1 : i * 210 + 250]) AS word_count, i * 210 AS start_word_index, source FROM starts)"""
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)


def grams(name: str, key: str, text: str, source: str) -> str:
    return f"""{name}_t AS (SELECT {key}, list_filter(
            regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}'),
            lambda t: t NOT IN ({_STOP})) AS t FROM {source}),
        {name}_p AS (SELECT {key}, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM {name}_t),
        {name} AS (SELECT {key}, term, count(*) AS tf FROM (
            SELECT {key}, tok AS term FROM {name}_p
            UNION ALL SELECT a.{key}, a.tok || ' ' || b.tok FROM {name}_p a JOIN {name}_p b
                ON a.{key} = b.{key} AND b.pos = a.pos + 1) GROUP BY 1, 2)"""


INDEX = f"""{CHUNKS}, {grams('tc', 'chunk_id', 'text', 'ch')},
    df AS (SELECT term, count(*) AS df, ln((1.0::DOUBLE + (SELECT count(*) FROM ch)) / (1.0::DOUBLE + count(*)))
        + 1.0::DOUBLE AS idf FROM tc GROUP BY 1),
    wt AS (SELECT tc.term, chunk_id, tf, tf * idf AS raw FROM tc JOIN df ON tc.term = df.term),
    nm AS (SELECT chunk_id, sqrt(sum(raw * raw)) AS norm FROM wt GROUP BY 1),
    idx AS (SELECT term, wt.chunk_id, tf, raw / norm AS weight FROM wt JOIN nm ON wt.chunk_id = nm.chunk_id)"""
SEARCH = f"""{INDEX}, {grams('qc', 'item_id', 'text', 'benchmark')},
    qw AS (SELECT item_id, qc.term, tf * idf AS raw FROM qc JOIN df ON qc.term = df.term),
    qn AS (SELECT item_id, sqrt(sum(raw * raw)) AS norm FROM qw GROUP BY 1),
    sim AS (SELECT qw.item_id, chunk_id, round(sum(weight * raw / norm), 9) AS s
        FROM qw JOIN qn ON qw.item_id = qn.item_id JOIN idx ON qw.term = idx.term GROUP BY 1, 2),
    hit AS (SELECT item_id AS query_id, place::INTEGER AS place, chunk_id,
        round_even(s * 1000.0::DOUBLE, 0)::DOUBLE / 1000.0::DOUBLE AS similarity_score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, chunk_id) AS place FROM sim)
        WHERE place <= 3 AND s > 0.01)"""

NOTE = f"""CASE WHEN coalesce(event_id, '') = '' THEN 'Missing event_id'
    WHEN coalesce(user_id, '') = '' THEN 'Missing user_id'
    WHEN NOT coalesce(event_type IN {VERBS}, false) THEN 'Invalid event_type ''' || coalesce(event_type, 'None') || ''''
    WHEN try_cast(watch_time_mins AS BIGINT) < 0 THEN 'Negative watch_time_mins'
    WHEN try_cast(watch_time_mins AS BIGINT) IS NULL THEN 'Malformed watch_time_mins' ELSE 'Valid' END"""


def unique_test(model: str, column: str, source: str | None = None) -> str:
    return f"""SELECT 'unique_{model}_{column}' AS test_name, '{model}' AS model,
        CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS failures
        FROM (SELECT {column} FROM {source or model} GROUP BY {column} HAVING count(*) > 1)"""


def null_test(model: str, column: str, source: str | None = None) -> str:
    return f"""SELECT 'not_null_{model}_{column}' AS test_name, '{model}' AS model,
        CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS failures
        FROM {source or model} WHERE {column} IS NULL"""


def list_test(model: str, column: str, values: str, source: str | None = None) -> str:
    return f"""SELECT 'accepted_values_{model}_{column}' AS test_name, '{model}' AS model,
        CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS failures
        FROM {source or model} WHERE {column} NOT IN {values}"""


def orphan(child: str, column: str, parent: str, parent_key: str, ct_: str, pt: str) -> str:
    return f"""SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent,
        count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows
        FROM {ct_} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_key} FROM {pt})"""


def pii(d: str) -> str:
    t, cols = COLS[d]
    kinds = {
        "mail": ("Email Address", "High", "Masked"),
        "phone": ("Phone Number", "High", "Masked"),
        "ip": ("IP Address (Network Identifier)", "Medium", "Truncated / Masked"),
        "name": ("Full Name", "Medium", "Pseudonymized / Access-Controlled"),
    }
    rows = []
    for c in cols:
        for word, (kind, risk, action) in kinds.items():
            if word in c and c != "plan_name":
                rows.append(
                    f"""SELECT '{d}' AS dataset, '{c}' AS column_name, '{kind}' AS pii_type, '{risk}' AS risk,
                    '{action}' AS action, count({c}) AS values_found FROM {t}"""
                )
                break
    return union(rows) if rows else ""


def statements() -> dict[str, str]:
    s: dict[str, str] = {}
    doc_text = ", ".join(
        f"""coalesce({c}, '') AS {a}"""
        for c, a in (
            ("event_id", "event_id"),
            ("user_id", "user_id"),
            ("event_type", "event"),
            ("content_id", "content_id"),
            ('"timestamp"', '"timestamp"'),
            ("device", "device"),
            ("session_id", "session_id"),
            ("ip_address", "ip_address"),
        )
    )
    minutes = "coalesce(trunc(try_cast(watch_time_mins AS DOUBLE)), 0)::BIGINT"
    s["raw_docs_shape"] = with_(f"SELECT {doc_text}, {minutes} AS watch_time_mins FROM ev_raw")
    s["sink_raw_docs"] = with_(
        f"""SELECT event_id, '{{"device":"' || coalesce(device, '') || '","watch_time_mins":' || {minutes}
        || ',"session_id":"' || coalesce(session_id, '') || '","ip_address":"' || coalesce(ip_address, '') || '"}}'
        AS metadata_json FROM ev_raw"""
    )
    ev_cols = f"""event_id, user_id, event_type, content_id, watch_time_mins, device, session_id,
        {stamp('"timestamp"', '"timestamp"')}, ip_address"""
    s["docs_recent"] = with_(
        f"""SELECT {ev_cols} FROM (SELECT * FROM ev ORDER BY "timestamp" DESC, event_id DESC LIMIT 50)"""
    )
    s["docs_count"] = with_("SELECT count(*) AS n_documents FROM ev_raw")
    s["retain_last_n"] = with_(f"SELECT {ev_cols} FROM (SELECT * FROM ev ORDER BY event_id DESC LIMIT 5000)")
    s["table_row_counts"] = with_(
        union(
            f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}"
            for n, t in (
                ("users", "us"),
                ("content", "ct"),
                ("events", "ev"),
                ("subscriptions", "sb"),
                ("watch_history", "wh"),
            )
        ),
        HISTORY,
    )
    s["adhoc_sql"] = with_(
        """SELECT country, device, count(*) AS n_events, sum(watch_time_mins)::BIGINT AS minutes
        FROM us JOIN ev ON us.user_id = ev.user_id
        WHERE tier = 'Premium' AND "timestamp" >= TIMESTAMP '2024-01-05' GROUP BY country, device"""
    )

    s["dq_duplicate_keys"] = with_(
        union(
            f"SELECT '{d}' AS dataset, count(*) FILTER (WHERE is_duplicate) AS duplicates FROM {t}"
            for d, t in (("events", "evf"), ("users", "usf"))
        ),
        EV_FLAGS,
        US_FLAGS,
    )
    s["dq_full_row_duplicates"] = with_(
        union(
            f"""SELECT '{d}' AS dataset, (SELECT count(*) FROM {t}) - (SELECT count(*) FROM
            (SELECT DISTINCT {', '.join('"' + c + '"' for c in cols)} FROM {t})) AS duplicates"""
            for d, (t, cols) in COLS.items()
        )
    )
    s["dq_null_profile"] = with_(union(null_profile(d) for d in COLS))
    for name, flag, table in (
        ("dq_missing_key", "invalid_user_ids", EV_FLAGS),
        ("dq_accepted_values", "invalid_event_types", EV_FLAGS),
        ("dq_numeric_bounds", "invalid_numerics", EV_FLAGS),
        ("dq_email_format", "invalid_emails", US_FLAGS),
    ):
        s[name] = with_(f"SELECT count(*) FILTER (WHERE {flag}) AS violations FROM {table[:3]}", table)
    s["dq_timestamp_parse"] = with_(
        """SELECT 'events' AS dataset, count(*) FILTER (WHERE invalid_timestamps) AS violations FROM evf
        UNION ALL SELECT 'users', count(*) FILTER (WHERE invalid_dates) FROM usf""",
        EV_FLAGS,
        US_FLAGS,
    )
    s["dq_row_verdict"] = with_(
        f"""SELECT ord AS row_index, event_id, invalid_user_ids, invalid_event_types, invalid_numerics,
        invalid_timestamps, is_duplicate, NOT {EV_BAD} AS is_valid FROM evf""",
        EV_FLAGS,
    )
    s["dq_score"] = with_(
        union(
            f"""SELECT dataset, total_records, valid_records, invalid_records, duplicates, missing_values, dq_score
            FROM {audit(d)}"""
            for d in ("events", "users")
        ),
        EV_FLAGS,
        US_FLAGS,
    )
    s["dq_error_log"] = with_(
        f"""SELECT ord AS row_index, event_id, concat_ws(', ',
            CASE WHEN is_duplicate THEN 'Duplicate event_id' END,
            CASE WHEN invalid_user_ids THEN 'Missing user_id' END,
            CASE WHEN invalid_event_types THEN 'Invalid event_type ''' || coalesce(event_type, 'nan') || '''' END,
            CASE WHEN invalid_numerics
                THEN 'Negative/malformed watch_time (' || coalesce(watch_time_mins, 'nan') || ')' END,
            CASE WHEN invalid_timestamps
                THEN 'Malformed timestamp ''' || coalesce("timestamp", 'nan') || '''' END) AS reasons
        FROM evf WHERE {EV_BAD}""",
        EV_FLAGS,
    )
    s["dq_error_log_users"] = with_(
        f"""SELECT ord AS row_index, user_id, concat_ws(', ',
            CASE WHEN is_duplicate THEN 'Duplicate user_id' END,
            CASE WHEN invalid_user_ids THEN 'Missing user_id' END,
            CASE WHEN invalid_emails THEN 'Malformed or missing email' END,
            CASE WHEN invalid_dates THEN 'Invalid registration date' END) AS reasons
        FROM usf WHERE {US_BAD}""",
        US_FLAGS,
    )
    s["dq_rule_report"] = with_(
        "SELECT *, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ("
        + union(
            f"SELECT '{label}' AS rule, count(*) FILTER (WHERE {flag}) AS violations FROM evf"
            for label, flag in (
                ("Duplicate Event IDs", "is_duplicate"),
                ("Missing Mandatory User IDs", "invalid_user_ids"),
                ("Invalid Event Types", "invalid_event_types"),
                ("Negative / Malformed Watch Time", "invalid_numerics"),
                ("Unparseable Timestamps", "invalid_timestamps"),
            )
        )
        + ")",
        EV_FLAGS,
    )

    def load(d: str) -> str:
        warned = f"(SELECT count(*) FROM ({type_rows(d)}))"
        if d in ("events", "users"):
            body = f"""SELECT total_records, valid_records, invalid_records, duplicates, missing_values, dq_score
                FROM {audit(d)}"""
        else:
            t, cols = COLS[d]
            cells = " + ".join(f'("{c}" IS NULL)::INT' for c in cols)
            names = ", ".join(f'"{c}"' for c in cols)
            body = f"""SELECT count(*) AS total_records, count(*) AS valid_records, 0::BIGINT AS invalid_records,
                count(*) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {t})) AS duplicates,
                sum({cells})::BIGINT AS missing_values, 100.0::DOUBLE AS dq_score FROM {t}"""
        return f"""SELECT '{d}' AS dataset_name, *, CASE WHEN schema_warnings_count > 0 OR invalid_records > 0
            THEN 'COMPLETED_WITH_WARNINGS' ELSE 'SUCCESS' END AS status
            FROM (SELECT *, {warned} AS schema_warnings_count FROM ({body}))"""

    s["dq_ingest_summary"] = with_(union(load(d) for d in COLS), EV_FLAGS, US_FLAGS)
    s["dq_entity_summary"] = with_(
        union(
            f"""SELECT '{d.capitalize()}' AS entity, total_records AS total_rows, dq_score, duplicates,
            invalid_records AS invalid_rows FROM {audit(d)}"""
            for d in ("events", "users")
        ),
        EV_FLAGS,
        US_FLAGS,
    )

    s["drift_added_columns"] = with_(arrivals("added"))
    s["drift_missing_columns"] = with_(arrivals("missing"))
    s["drift_type_mismatches"] = with_(mismatches())
    s["drift_report"] = with_(drift_report())

    s["assert_unique"] = with_(
        union(
            [unique_test(f"{d}_raw", KEY[d], COLS[d][0]) for d in COLS] + [unique_test("users", "user_id", "us")]
        )
    )
    s["assert_not_null"] = with_(
        union(
            [null_test("events_raw", c, "ev_raw") for c in ("event_id", "user_id", "device")]
            + [null_test("users", "user_id", "us")]
        )
    )
    s["assert_accepted_values"] = with_(
        union(
            [
                list_test("events", "event_type", VERBS, "ev"),
                list_test("users_raw", "tier", TIERS, "us_raw"),
            ]
        )
    )
    s["assert_suite"] = with_(
        union(
            [
                unique_test("users", "user_id", "us"),
                null_test("users", "user_id", "us"),
                list_test("events", "event_type", VERBS, "ev"),
                unique_test("stg_events", "event_id", "stg_ev"),
                null_test("stg_events", "event_id", "stg_ev"),
                null_test("stg_events", "user_id", "stg_ev"),
                null_test("stg_events", "event_type", "stg_ev"),
                list_test("stg_events", "event_type", VERBS, "stg_ev"),
                unique_test("stg_users", "user_id", "us"),
                null_test("stg_users", "user_id", "us"),
                list_test("stg_users", "tier", TIERS, "us"),
                unique_test("fact_user_activity", "user_id", "fact"),
                null_test("fact_user_activity", "user_id", "fact"),
            ]
        ),
        STG_EV,
        FACT,
    )
    s["assert_foreign_keys"] = with_(
        union(
            [
                orphan("subscriptions", "user_id", "users", "user_id", "sb", "us"),
                orphan("events", "user_id", "users", "user_id", "ev", "us"),
                orphan("events", "content_id", "content", "content_id", "ev", "ct"),
                orphan("watch_history", "user_id", "users", "user_id", "wh", "us"),
                orphan("watch_history", "content_id", "content", "content_id", "wh", "ct"),
            ]
        ),
        HISTORY,
    )
    s["assert_row_counts"] = with_(
        union(
            f"""SELECT '{n}' AS table_name, count(*) AS row_count,
            CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {t}"""
            for n, t in (("users", "us"), ("content", "ct"))
        )
    )

    ev_raw_cols = ", ".join(f'"{c}"' for c in COLS["events"][1])
    s["dedupe_keep_first"] = with_(f"SELECT {ev_raw_cols} FROM {first_of('events')}")
    for d in COLS:
        s[f"clean_{d}"] = with_(CLEAN[d])
    s["clean_users_masked"] = with_(
        f"""SELECT user_id, name, {EMAIL} AS email, {PHONE} AS phone, country, registration_date, tier, status
        FROM ({CLEAN['users']})"""
    )
    s["clean_stats"] = with_(union(clean_stats(d) for d in COLS))
    s["etl_batch"] = with_(
        f"""SELECT {' + '.join(f'(SELECT count(*) FROM {t})' for t, _ in COLS.values())} AS total_extracted,
        (SELECT count(*) FROM ({CLEAN['users']})) AS users_loaded,
        (SELECT count(*) FROM ({CLEAN['content']})) AS content_loaded,
        (SELECT count(*) FROM ({CLEAN['subscriptions']})) AS subs_loaded,
        (SELECT count(*) FROM ({CLEAN['events']})) AS events_loaded,
        (SELECT count(*) FROM (SELECT DISTINCT user_id, content_id FROM ({CLEAN['events']})
            WHERE event_type = 'video_watch' AND content_id IS NOT NULL)) AS watch_history_derived,
        (SELECT dq_score FROM {audit('events')}) AS events_dq_score,
        (SELECT dq_score FROM {audit('users')}) AS users_dq_score,
        (SELECT invalid_dropped FROM ({clean_stats('events')})) AS invalid_dropped,
        (SELECT duplicates_removed FROM ({clean_stats('events')}))
            + (SELECT duplicates_removed FROM ({clean_stats('users')})) AS duplicates_removed""",
        EV_FLAGS,
        US_FLAGS,
    )
    s["mask_email"] = with_(f"SELECT ord AS row_index, user_id, {EMAIL} AS email FROM us_raw")
    s["mask_phone"] = with_(f"SELECT ord AS row_index, user_id, {PHONE} AS phone FROM us_raw")
    s["mask_ip"] = with_(f"SELECT ord AS row_index, event_id, {IP} AS ip_address FROM ev_raw")
    s["mask_table"] = with_(
        f"""SELECT user_id, name, {EMAIL} AS email, {PHONE} AS phone, country, registration_date, tier, status,
        ord AS row_index FROM us_raw"""
    )
    s["detect_pii_columns"] = with_(union(p for p in (pii(d) for d in COLS) if p))

    s["stg_events"] = with_(
        f"""SELECT event_id, user_id, event_type, content_id, watch_time_mins, device, session_id,
        {stamp('"timestamp"', '"timestamp"')}, ip_address FROM stg_ev""",
        STG_EV,
    )
    s["stg_users"] = with_(
        "SELECT user_id, name, country, tier, status, registration_date::DATE::VARCHAR AS registration_date FROM us"
    )
    s["fact_user_activity"] = with_("SELECT * FROM fact", STG_EV, FACT)
    daily = """SELECT "timestamp"::DATE::VARCHAR AS usage_date, count(DISTINCT user_id) AS daily_active_users,
        count(event_id) AS total_events_logged,
        sum(CASE WHEN event_type = 'video_watch' THEN watch_time_mins ELSE 0 END)::BIGINT AS total_daily_watch_mins,
        count(*) FILTER (WHERE event_type = 'subscription') AS new_subscriptions_started
        FROM stg_ev GROUP BY 1"""
    s["analytics_daily_usage"] = with_(daily, STG_EV)
    s["watch_history"] = with_("SELECT * FROM wh", HISTORY)

    s["q_dau"] = with_(
        """SELECT "timestamp"::DATE::VARCHAR AS activity_date, count(DISTINCT user_id) AS active_users,
        count(event_id) AS total_events,
        round(count(event_id)::DOUBLE / nullif(count(DISTINCT user_id), 0), 2) AS events_per_user
        FROM ev WHERE user_id IS NOT NULL GROUP BY 1"""
    )
    s["q_most_watched"] = with_(
        """SELECT c.content_id, c.title, c.content_type, c.genre, count(e.event_id) AS total_views,
        sum(e.watch_time_mins)::BIGINT AS total_watch_time_mins, round(avg(e.watch_time_mins), 1) AS avg_watch_mins,
        c.duration_mins,
        round(sum(e.watch_time_mins)::DOUBLE / nullif(c.duration_mins * count(e.event_id), 0) * 100, 1)
            AS estimated_avg_completion_pct
        FROM ct c JOIN ev e ON c.content_id = e.content_id WHERE e.event_type = 'video_watch'
        GROUP BY c.content_id, c.title, c.content_type, c.genre, c.duration_mins"""
    )
    s["q_top_users"] = with_(
        """SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY total_stream_mins DESC, total_interactions DESC)::INTEGER
            AS activity_rank FROM (
            SELECT u.user_id, u.name, u.country, u.tier, count(e.event_id) AS total_interactions,
            coalesce(sum(CASE WHEN e.event_type = 'video_watch' THEN e.watch_time_mins ELSE 0 END), 0)::BIGINT
                AS total_stream_mins, count(DISTINCT e.content_id) AS unique_titles_viewed
            FROM us u LEFT JOIN ev e ON u.user_id = e.user_id GROUP BY u.user_id, u.name, u.country, u.tier))
        ORDER BY activity_rank, user_id LIMIT 15"""
    )
    s["q_genre_engagement"] = with_(
        """SELECT c.content_type, c.genre, count(DISTINCT c.content_id) AS total_titles,
        count(e.event_id) AS total_sessions, coalesce(sum(e.watch_time_mins), 0)::BIGINT AS cumulative_watch_mins,
        round(avg(e.watch_time_mins), 1) AS mean_session_duration
        FROM ct c LEFT JOIN ev e ON c.content_id = e.content_id AND e.event_type = 'video_watch'
        GROUP BY c.content_type, c.genre"""
    )
    s["q_plan_mrr"] = with_(
        """SELECT plan_name, count(sub_id) AS subscriber_count,
        round(sum(monthly_price), 2)::DOUBLE AS total_monthly_revenue,
        round(sum(monthly_price)::DOUBLE / count(monthly_price), 2) AS avg_plan_price,
        round(count(sub_id) * 100.0::DOUBLE / (SELECT count(*) FROM sb), 1) AS plan_share_pct
        FROM sb WHERE status = 'active' GROUP BY plan_name"""
    )
    s["q_device_funnel"] = with_(
        """SELECT device, event_type, count(event_id) AS event_count,
        round(count(event_id) * 100.0::DOUBLE / sum(count(event_id)) OVER (PARTITION BY device), 1)
            AS device_percentage
        FROM ev WHERE device IS NOT NULL AND device <> '' GROUP BY device, event_type"""
    )
    s["q_device_counts"] = with_(
        """SELECT device, event_type, count(event_id) AS event_count FROM ev
        WHERE device IS NOT NULL AND device <> '' GROUP BY device, event_type"""
    )
    s["q_cohort_retention"] = with_(
        """SELECT f.cohort_date::VARCHAR AS cohort_date, count(DISTINCT f.user_id) AS cohort_size,
        count(DISTINCT CASE WHEN a.active_date = f.cohort_date THEN a.user_id END) AS day_0_active,
        count(DISTINCT CASE WHEN a.active_date > f.cohort_date THEN a.user_id END) AS retained_subsequent_days
        FROM (SELECT user_id, min("timestamp"::DATE) AS cohort_date FROM ev WHERE user_id IS NOT NULL GROUP BY 1) f
        LEFT JOIN (SELECT DISTINCT user_id, "timestamp"::DATE AS active_date FROM ev WHERE user_id IS NOT NULL) a
            ON f.user_id = a.user_id GROUP BY f.cohort_date"""
    )
    s["q_genre_rank"] = with_(
        """SELECT *, dense_rank() OVER (PARTITION BY genre ORDER BY total_watch_minutes DESC) AS genre_rank FROM (
        SELECT c.content_id, c.title, c.genre, sum(e.watch_time_mins)::BIGINT AS total_watch_minutes,
        count(e.event_id) AS total_stream_sessions, c.rating FROM ct c JOIN ev e ON c.content_id = e.content_id
        WHERE e.event_type = 'video_watch' GROUP BY c.content_id, c.title, c.genre, c.rating)"""
    )
    s["q_daily_rollup"] = with_(
        """SELECT "timestamp"::DATE::VARCHAR AS activity_date, count(DISTINCT user_id) AS daily_active_users,
        sum(watch_time_mins)::BIGINT AS total_platform_minutes,
        sum(watch_time_mins)::DOUBLE / count(watch_time_mins) AS avg_session_duration,
        count(*) FILTER (WHERE event_type = 'video_watch') AS total_plays FROM ev GROUP BY 1"""
    )

    arms = " ".join(
        "WHEN " + " OR ".join(f"contains(q, '{p}')" for p in phrases) + f" THEN '{topic}'"
        for topic, phrases in TOPICS
    )
    s["route_questions"] = with_(
        f"""SELECT conv_id, turn, question, CASE {arms} ELSE 'Platform Summary' END AS category
        FROM (SELECT *, lower(question) AS q FROM qs)"""
    )
    for name, report in (
        ("rpt_top_watched", "watched"),
        ("rpt_top_users", "users"),
        ("rpt_event_mix", "mix"),
        ("rpt_trending", "trend"),
        ("rpt_revenue", "revenue"),
    ):
        s[name] = with_(f"SELECT * FROM ({RPT[report]})")
    s["rpt_platform_summary"] = with_(
        """SELECT (SELECT count(*) FROM us) AS total_users, (SELECT count(*) FROM ct) AS total_titles,
        (SELECT count(*) FROM ev) AS total_events, (SELECT count(*) FROM sb) AS total_subs"""
    )
    s["rpt_narrative"] = with_(NARRATIVE, CLEAN_FLAGS)
    s["answer_questions"] = with_(
        f"""SELECT conv_id, turn, category, answer FROM (
            SELECT conv_id, turn, CASE {arms} ELSE 'Platform Summary' END AS category
            FROM (SELECT *, lower(question) AS q FROM qs)) JOIN ({NARRATIVE}) USING (category)""",
        CLEAN_FLAGS,
    )

    s["churn_features"] = with_("SELECT * FROM cf", CHURN_FEATURES)
    s["churn_scores"] = with_("SELECT * FROM cs", CHURN_FEATURES, CHURN)
    s["churn_ranked"] = with_(
        "SELECT user_id, churn_risk_score, risk_level, risk_factors FROM cs", CHURN_FEATURES, CHURN
    )
    s["churn_fleet_summary"] = with_(
        f"""SELECT count(*) AS total_users, count(*) FILTER (WHERE risk_level = 'High') AS high_risk,
        count(*) FILTER (WHERE risk_level = 'Medium') AS medium_risk,
        count(*) FILTER (WHERE risk_level = 'Low') AS low_risk, {r1('avg(churn_risk_score)')} AS avg_risk,
        count(*) FILTER (WHERE risk_level = 'High') * 14.99::DOUBLE AS at_risk_mrr_impact FROM cs""",
        CHURN_FEATURES,
        CHURN,
    )
    s["churn_level_counts"] = with_(
        "SELECT risk_level, count(*) AS n_users FROM cs GROUP BY 1", CHURN_FEATURES, CHURN
    )

    s["rec_user_profile"] = with_(
        """SELECT s.user_id, coalesce(g, '') AS favorite_genres, coalesce(d, '') AS favorite_directors,
        coalesce(t, '') AS watched_titles, n AS total_watched_count
        FROM (SELECT user_id, count(*) AS n FROM seen GROUP BY 1) s
        LEFT JOIN (SELECT user_id, string_agg(genre, '|' ORDER BY rn) AS g FROM fg GROUP BY 1) a
            ON s.user_id = a.user_id
        LEFT JOIN (SELECT user_id, string_agg(director, '|' ORDER BY rn) AS d FROM fd GROUP BY 1) b
            ON s.user_id = b.user_id
        LEFT JOIN (SELECT user_id, string_agg(title, '|' ORDER BY content_id) AS t FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY content_id) AS rn FROM known)
            WHERE rn <= 4 GROUP BY 1) c ON s.user_id = c.user_id""",
        KNOWN,
    )
    s["rec_for_users"] = with_(
        """SELECT user_id, place::INTEGER AS place, content_id, title, genre, content_type, rating, director,
            match_score,
            '⭐ ' || match_score || '% Match • ' || coalesce(nullif(concat_ws(' • ',
                CASE WHEN g IS NOT NULL THEN 'Matches your affinity for ' || genre END,
                CASE WHEN d IS NOT NULL THEN 'Directed by ' || director END,
                CASE WHEN rating >= 8.5 THEN 'Masterpiece rating (' || rating || '/10)' END), ''),
                'Trending pick aligned with platform audience') AS reason
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                ORDER BY match_score DESC, rating DESC, content_id) AS place
            FROM (SELECT u.user_id, c.*, fg.rn AS g, fd.rn AS d,
                trunc(least(99.0::DOUBLE, greatest(50.0::DOUBLE, 60.0::DOUBLE + (rating - 5.0::DOUBLE) * 4.0::DOUBLE
                    + CASE WHEN fg.rn = 1 THEN 25 WHEN fg.rn IS NOT NULL THEN 15 ELSE 0 END
                    + CASE WHEN fd.rn IS NOT NULL THEN 15 ELSE 0 END)))::INTEGER AS match_score
                FROM (SELECT DISTINCT user_id FROM seen) u CROSS JOIN ct c
                LEFT JOIN fg ON fg.user_id = u.user_id AND fg.genre = c.genre
                LEFT JOIN fd ON fd.user_id = u.user_id AND fd.director = c.director
                LEFT JOIN seen s ON s.user_id = u.user_id AND s.content_id = c.content_id
                LEFT JOIN (SELECT user_id, count(*) AS n FROM known GROUP BY 1) k ON k.user_id = u.user_id
                WHERE s.content_id IS NULL OR k.n = (SELECT count(*) FROM ct)))
        WHERE place <= 5""",
        KNOWN,
    )
    s["rec_cold_start"] = with_(
        """SELECT user_id, place::INTEGER AS place, content_id, title, genre, content_type, rating, director,
        85 AS match_score, '🔥 Trending Global Top Pick — Acclaimed by critics' AS reason
        FROM us, (SELECT *, row_number() OVER (ORDER BY rating DESC, content_id) AS place FROM ct
            ORDER BY rating DESC, content_id LIMIT 5)
        WHERE user_id NOT IN (SELECT user_id FROM seen)""",
        KNOWN,
    )
    s["rec_similar_titles"] = with_(
        """SELECT content_id, title, place::INTEGER AS place, similar_id, similar_title, similar_genre,
            similar_rating, similarity_score
        FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY similarity_score DESC, similar_id) AS place
            FROM (SELECT a.content_id, a.title, b.content_id AS similar_id, b.title AS similar_title,
                b.genre AS similar_genre, b.rating AS similar_rating,
                least(98, 50 + CASE WHEN a.genre = b.genre THEN 35 ELSE 0 END
                    + CASE WHEN a.director = b.director THEN 15 ELSE 0 END
                    + trunc((b.rating - 7.0::DOUBLE) * 4)::INTEGER) AS similarity_score
                FROM ct a JOIN ct b ON a.content_id <> b.content_id))
        WHERE place <= 4"""
    )
    for name, table in (
        ("anom_multi_ip", "a_ip"),
        ("anom_friction_ratio", "a_friction"),
        ("anom_long_session", "a_long"),
        ("anom_scraper", "a_scrape"),
    ):
        s[name] = with_(f"SELECT * FROM {table}", ANOMALY)
    s["anom_all"] = with_(
        """SELECT * FROM a_all UNION ALL SELECT 'ANO-HEALTH-OK', 'System Health', 'INFO', 'Global Streaming Fleet',
        'All streaming metrics, QoS buffering ratios, and concurrent session checks are within nominal limits.',
        'Nominal', 'Continue passive telemetry monitoring.'
        WHERE NOT EXISTS (SELECT 1 FROM a_all) AND EXISTS (SELECT 1 FROM ev)""",
        ANOMALY,
    )
    s["anom_summary"] = with_(
        """SELECT count(*) AS total_anomalies, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_count,
        count(*) FILTER (WHERE severity IN ('HIGH', 'WARNING')) AS warning_count,
        count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_count,
        CASE WHEN count(*) FILTER (WHERE severity = 'CRITICAL') = 0 THEN 'Healthy' ELSE 'Action Required' END
            AS fleet_status FROM a_all""",
        ANOMALY,
    )

    s["text_clean"] = f"SELECT doc_id::VARCHAR AS doc_id, {CLEANED_TEXT} AS text FROM documents"
    s["text_chunks"] = with_("SELECT * FROM ch", CHUNKS)
    s["doc_inventory"] = with_("SELECT doc_id, count(*) AS n_chunks FROM ch GROUP BY 1", CHUNKS)
    s["tfidf_index"] = with_("SELECT term, chunk_id, tf, round(weight, 6) AS weight FROM idx", INDEX)
    s["tfidf_search"] = with_("SELECT * FROM hit", SEARCH)
    s["rag_answer"] = with_(
        """SELECT b.item_id AS query_id, CASE WHEN n IS NULL THEN
            'No relevant documentation or knowledge base records found matching your query.'
            || ' Try rephrasing or uploading relevant documents.' ELSE head || chr(10) || coalesce(tail, '') END
            AS answer, coalesce(n, 0)::INTEGER AS n_sources
        FROM benchmark b LEFT JOIN (
            SELECT query_id, count(*) AS n,
                max(CASE WHEN place = 1 THEN '**Information Retrieved from:** `' || source || '` (Relevance Score: `'
                    || printf('%.2f', similarity_score) || '`)' || chr(10) || chr(10)
                    || '### Summary & Key Findings:' || chr(10) || '> ' || left(text, 400) || '...' || chr(10)
                    || chr(10) || '### Additional Context Details:' END) AS head,
                string_agg(CASE WHEN place > 1 THEN '- **[Source ' || place || ' - ' || source || ']**: '
                    || left(text, 200) || '...' END, chr(10) ORDER BY place) AS tail
            FROM hit JOIN ch ON hit.chunk_id = ch.chunk_id GROUP BY 1) h ON b.item_id = h.query_id""",
        SEARCH,
    )

    s["stream_validate"] = with_(
        f"""SELECT event_id, user_id, event_type, note = 'Valid' AS is_valid, note AS validation_note
        FROM (SELECT *, {NOTE} AS note FROM ev_raw)"""
    )
    s["stream_route_valid"] = with_(
        f"""SELECT event_id, user_id, event_type, content_id, try_cast(watch_time_mins AS BIGINT) AS watch_time_mins,
        coalesce(device, 'Unknown') AS device, coalesce(session_id, 'sess_stream') AS session_id, {IP} AS ip_address
        FROM (SELECT * REPLACE (coalesce(ip_address, '127.0.0.1') AS ip_address), {NOTE} AS note FROM ev_raw)
        WHERE note = 'Valid'"""
    )
    s["stream_dead_letter"] = with_(
        f"""SELECT event_id, user_id, event_type, note AS validation_note
        FROM (SELECT *, {NOTE} AS note FROM ev_raw) WHERE note <> 'Valid'"""
    )
    s["stream_documents"] = with_(
        f"""SELECT event_id, user_id, event_type AS event, content_id, "timestamp", device,
        try_cast(watch_time_mins AS BIGINT) AS watch_time_mins, 'kafka_stream_consumer' AS source
        FROM (SELECT *, {NOTE} AS note FROM ev_raw) WHERE note = 'Valid'"""
    )
    day = stamp("date_trunc('day', \"timestamp\")", "window_start")
    s["stream_multi_ip_windows"] = with_(
        f"""SELECT {day}, user_id, count(DISTINCT ip_address) AS n_ips FROM ev
        WHERE user_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY ALL HAVING n_ips > 2"""
    )
    s["stream_friction_windows"] = with_(
        f"""SELECT {day}, count(*) FILTER (WHERE event_type IN ('buffering', 'error'))::DOUBLE / count(event_type)
        AS friction FROM ev WHERE "timestamp" IS NOT NULL GROUP BY 1 HAVING friction > 0.10"""
    )
    s["stream_long_session_windows"] = with_(
        f"""SELECT {day}, event_id, user_id, watch_time_mins FROM ev
        WHERE event_type = 'video_watch' AND watch_time_mins > 240"""
    )
    s["stream_scraper_windows"] = with_(
        f"""SELECT {day}, user_id, count(*) FILTER (WHERE event_type = 'search') AS searches FROM ev
        WHERE user_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY ALL
        HAVING searches >= 5 AND count(*) FILTER (WHERE event_type = 'video_watch') = 0"""
    )
    s["stream_metrics"] = with_(
        f"""SELECT count(*) AS total_consumed, count(*) FILTER (WHERE note = 'Valid') AS valid_events,
        count(*) FILTER (WHERE note <> 'Valid') AS invalid_events,
        {r1("count(*) FILTER (WHERE note = 'Valid')::DOUBLE / count(*) * 100.0::DOUBLE")} AS valid_rate
        FROM (SELECT {NOTE} AS note FROM ev_raw)"""
    )
    s["stream_usage_windows"] = with_(
        daily.replace('"timestamp"::DATE::VARCHAR AS usage_date', f"""{stamp("date_trunc('day', \"timestamp\")", 'window_start')}"""),
        STG_EV,
    )
    s["ov_event_type_counts"] = with_(
        "SELECT event_type, count(*) AS n FROM ev WHERE event_type IS NOT NULL GROUP BY 1"
    )
    s["ov_device_counts"] = with_("SELECT device, count(*) AS n FROM ev_raw WHERE device IS NOT NULL GROUP BY 1")
    s["ov_kpis"] = with_(
        f"""SELECT (SELECT count(*) FROM us) AS total_users, (SELECT count(*) FROM ev) AS total_events,
        (SELECT count(DISTINCT event_type) FROM ev) AS event_types,
        (SELECT dq_score FROM {audit('events')}) AS dq_score, (SELECT count(*) FROM ct) AS total_titles""",
        EV_FLAGS,
    )
    s["ov_valid_rate"] = with_(
        f"""SELECT total_records, valid_records, {r1('valid_records::DOUBLE / total_records * 100.0::DOUBLE')} AS valid_percent
        FROM {audit('events')}""",
        EV_FLAGS,
    )
    return s
