"""SQL over the raw test tables that gives the same rows as the queries of the same name."""

from __future__ import annotations


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _date(column: str) -> str:
    return f"cast({column} AS varchar)"


def _avg(column: str, n: str) -> str:
    """Average of a decimal(10,6) in whole units of 1e-10, rounded half up."""
    total = f"cast(sum({column}) * 1000000 AS hugeint)"
    return f"(({total} * 20000 + {n}) // (2 * {n}))"


def _avg_share(column: str) -> str:
    return f"({_avg(column, f'count({column})')} / 10000000000.0)"


def _avg_pct(column: str, digits: int) -> str:
    step = 10 ** (8 - digits)
    rounded = f"(({_avg(column, f'count({column})')} * 2 + {step}) // {2 * step})"
    return f"cast({rounded} AS double) / {10 ** digits}.0"


# Each block names the blocks it reads.
_BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "media": ((), """
        SELECT cast(p_partkey AS varchar) AS media_id,
               p_name || CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN ' YouTube Paid Ads'
                              WHEN p_type IN ('MEDIUM', 'LARGE') THEN ' FACEBOOK paid ads'
                              ELSE '' END AS name,
               cast(p_retailprice AS decimal(10,3)) AS duration_seconds,
               TIMESTAMP '2020-01-01' + to_days(p_size) AS created_at,
               CASE WHEN p_type <> 'SMALL'
                    THEN TIMESTAMP '2020-01-01' + to_days(2 * p_size) END AS updated_at,
               CASE WHEN p_type = 'STANDARD' THEN 'archived' ELSE 'ready' END AS status,
               p_brand AS project_name, p_type AS section_name
          FROM part"""),
    "stats": ((), """
        SELECT cast(l_partkey AS varchar) AS media_id, count(*) AS total_plays,
               cast(sum(l_quantity) AS bigint) AS total_loads,
               cast(count(*) / 100.0 AS decimal(10,6)) AS play_rate,
               cast(count(*) / 1000.0 AS decimal(14,6)) AS hours_watched,
               count(DISTINCT l_suppkey) AS total_visitors,
               cast(count(DISTINCT l_suppkey) / 1000.0 AS decimal(10,6)) AS engagement
          FROM lineitem GROUP BY l_partkey HAVING count(*) >= 25"""),
    "dim_media": (("media", "stats"), """
        SELECT m.*,
               CASE WHEN lower(m.name) LIKE '%youtube%' THEN 'YouTube'
                    WHEN lower(m.name) LIKE '%facebook%' THEN 'Facebook'
                    ELSE 'Unknown' END AS channel,
               s.total_plays, s.total_loads, s.play_rate, s.hours_watched, s.total_visitors,
               s.engagement, DATE '2024-02-01' AS load_date
          FROM media m LEFT JOIN stats s ON m.media_id = s.media_id"""),
    "snapshots": ((), """
        SELECT CASE WHEN NOT (o_orderstatus = 'F' AND o_totalprice < 5000)
                    THEN cast(o_custkey AS varchar) END AS visitor_key,
               o_orderdate + to_microseconds(o_orderkey) AS last_active_at,
               o_orderdate + to_microseconds(o_orderkey) - INTERVAL 30 DAY AS first_seen_at,
               cast(floor(o_totalprice / 1000) AS integer) AS load_count,
               cast(floor(o_totalprice / 5000) AS integer) AS play_count,
               CASE WHEN o_totalprice < 400000 THEN o_orderpriority END AS browser,
               substring(o_orderpriority, 1, 1) AS browser_version,
               o_orderstatus AS platform,
               o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_mobile
          FROM orders"""),
    "people": (("snapshots",), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY visitor_key
                                       ORDER BY last_active_at DESC NULLS LAST) AS rn
            FROM snapshots WHERE visitor_key IS NOT NULL) WHERE rn = 1"""),
    "first_events": ((), """
        SELECT CASE WHEN NOT (event_type = 'error' AND value < 1)
                    THEN cast(event_id AS varchar) END AS event_key,
               CASE WHEN NOT (event_type = 'signup' AND value < 1) THEN props->>'$.k' END AS media_id,
               CASE WHEN NOT (event_type = 'view' AND value < 5)
                    THEN cast(user_id AS varchar) END AS visitor_key,
               ts AS received_at, '10.0.0.' || n_nationkey AS ip,
               nullif(n_name, 'NATION_0') AS country, r_name AS region, c_mktsegment AS city,
               CASE WHEN event_type <> 'error' THEN cast(c_acctbal AS decimal(10,6)) END AS lat,
               cast(value AS decimal(10,6)) AS lon,
               cast(least(value, 100.0) / 100 AS decimal(10,6)) AS percent_viewed,
               'https://video.example.com/' || (props->>'$.k') AS embed_url,
               'Video ' || (props->>'$.k') AS media_name,
               c_mktsegment AS browser, event_type AS platform, event_type = 'click' AS is_mobile
          FROM events JOIN customer ON user_id = c_custkey
               JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey"""),
    "replays": (("first_events",), """
        SELECT * REPLACE (received_at + INTERVAL 1 HOUR AS received_at)
          FROM first_events WHERE platform = 'purchase'"""),
    "deliveries": (("first_events", "replays"), """
        SELECT * FROM first_events UNION ALL SELECT * FROM replays"""),
    "facts": (("deliveries",), """
        SELECT * EXCLUDE (rn), cast(received_at AS date) AS event_date FROM (
          SELECT *, row_number() OVER (PARTITION BY event_key
                                       ORDER BY received_at DESC NULLS LAST) AS rn
            FROM deliveries WHERE event_key IS NOT NULL AND media_id IS NOT NULL) WHERE rn = 1"""),
    "fact": (("facts", "people"), """
        SELECT f.*, p.play_count AS visitor_play_count, p.load_count AS visitor_load_count,
               DATE '2024-02-01' AS load_date
          FROM facts f LEFT JOIN people p ON f.visitor_key = p.visitor_key"""),
    "geo": (("deliveries",), """
        SELECT visitor_key, country, region, city, ip AS last_ip FROM (
          SELECT *, row_number() OVER (PARTITION BY visitor_key
                                       ORDER BY received_at DESC NULLS LAST) AS rn
            FROM deliveries WHERE visitor_key IS NOT NULL) WHERE rn = 1"""),
    "geo_mode": (("geo", "usual"), """
        SELECT g.visitor_key, c.value AS country, r.value AS region, t.value AS city, g.last_ip
          FROM geo g
          LEFT JOIN usual c ON c.visitor_key = g.visitor_key AND c.name = 'country'
          LEFT JOIN usual r ON r.visitor_key = g.visitor_key AND r.name = 'region'
          LEFT JOIN usual t ON t.visitor_key = g.visitor_key AND t.name = 'city'"""),
    "usual": (("deliveries",), """
        SELECT visitor_key, name, value FROM (
          SELECT visitor_key, name, value,
                 row_number() OVER (PARTITION BY visitor_key, name
                                    ORDER BY count(*) DESC, value) AS rn
            FROM (SELECT visitor_key, 'country' AS name, country AS value FROM deliveries
                  UNION ALL SELECT visitor_key, 'region', region FROM deliveries
                  UNION ALL SELECT visitor_key, 'city', city FROM deliveries)
           WHERE visitor_key IS NOT NULL AND value IS NOT NULL
           GROUP BY visitor_key, name, value) WHERE rn = 1"""),
    "dim_visitor": (("people", "geo"), """
        SELECT p.*, g.country, g.region, g.city, g.last_ip, DATE '2024-02-01' AS load_date
          FROM people p LEFT JOIN geo g ON p.visitor_key = g.visitor_key"""),
    "dim_visitor_mode": (("people", "geo_mode"), """
        SELECT p.*, g.country, g.region, g.city, g.last_ip, DATE '2024-02-01' AS load_date
          FROM people p LEFT JOIN geo_mode g ON p.visitor_key = g.visitor_key"""),
    "target": (("first_events",), """
        SELECT event_key, received_at, percent_viewed, platform FROM first_events"""),
    "staging": (("replays",), """
        SELECT event_key, received_at, percent_viewed, platform FROM replays
         WHERE event_key IS NOT NULL"""),
    "kept": (("target", "staging"), """
        SELECT * FROM target t
         WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.event_key = t.event_key)"""),
    "measured": (("dim_media",), "SELECT * FROM dim_media WHERE total_plays IS NOT NULL"),
    "landed": ((), """
        SELECT event_type || '/' || (props->>'$.k') AS media_id,
               date_diff('day', cast(ts AS date), DATE '2024-01-30') + 1 AS page,
               cast(event_id AS varchar) AS event_key, ts AS received_at
          FROM events"""),
    "marks": ((), """
        SELECT DISTINCT event_type || '/' || (props->>'$.k') AS media_id,
               CASE WHEN event_type <> 'error' THEN TIMESTAMP '2024-01-20' END AS mark
          FROM events WHERE event_type <> 'signup'"""),
    "paged": (("first_events",), """
        SELECT * REPLACE (CASE WHEN platform = 'view' AND cast(lon AS double) < 10 THEN NULL
                               ELSE received_at END AS received_at),
               received_at < TIMESTAMP '2024-01-16' AS early,
               platform || '/' || coalesce(media_id, 'none') AS request
          FROM first_events"""),
    "pulled": (("paged",), """
        SELECT 'bronze' AS place, * FROM paged WHERE early
        UNION ALL
        SELECT CASE WHEN m.mark IS NULL OR p.received_at > m.mark THEN 'bronze'
                    ELSE 'quarantine' END, p.*
          FROM (SELECT * FROM paged WHERE NOT early OR platform = 'purchase') p
          LEFT JOIN (SELECT request, max(received_at) AS mark FROM paged WHERE early
                      GROUP BY request) m ON m.request = p.request"""),
    "marked": (("landed", "marks"), """
        SELECT l.*, m.mark, (m.mark IS NULL OR l.received_at > m.mark) AS is_new
          FROM landed l LEFT JOIN marks m ON l.media_id = m.media_id"""),
}


def _with(sql: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _BLOCKS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    blocks = ", ".join(f"{n} AS ({_BLOCKS[n][1].strip()})" for n in ordered)
    return f"WITH {blocks} {sql}" if ordered else sql


_MEDIA_OUT = f"""
    media_id, name, cast(duration_seconds AS double) AS duration_seconds,
    {_ts('created_at')} AS created_at, {_ts('updated_at')} AS updated_at, status, project_name,
    section_name, channel, total_plays, total_loads, cast(play_rate AS double) AS play_rate,
    cast(hours_watched AS double) AS hours_watched, total_visitors,
    cast(engagement AS double) AS engagement, {_date('load_date')} AS load_date"""
_VISITOR_OUT = f"""
    visitor_key, {_ts('first_seen_at')} AS first_seen_at, {_ts('last_active_at')} AS last_active_at,
    load_count, play_count, browser, browser_version, platform, is_mobile, country, region, city,
    last_ip, {_date('load_date')} AS load_date"""
_FACT_OUT = f"""
    event_key, media_id, visitor_key, {_date('event_date')} AS event_date,
    {_ts('received_at')} AS received_at, ip, country, region, city, cast(lat AS double) AS lat,
    cast(lon AS double) AS lon, cast(percent_viewed AS double) AS percent_viewed, embed_url,
    media_name, browser, platform, is_mobile, visitor_play_count, visitor_load_count,
    {_date('load_date')} AS load_date"""
_UPSERT_OUT = f"""
    event_key, {_ts('received_at')} AS received_at,
    cast(percent_viewed AS double) AS percent_viewed, platform"""
_JOINED = "FROM facts f JOIN dim_media m ON f.media_id = m.media_id"


_FACT_LENGTHS = (
    ("event_key", 256), ("media_id", 64), ("visitor_key", 256), ("ip", 64), ("country", 128),
    ("region", 128), ("city", 128), ("embed_url", 1000), ("media_name", 500), ("browser", 64),
    ("platform", 64),
)


def _null_lines() -> str:
    parts = []
    for c in ("event_key", "media_id", "visitor_key", "country", "lat", "percent_viewed"):
        parts.append(
            f"SELECT 'fact_media_engagement' AS \"table\", '{c}' AS \"column\", "
            f"count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 2) AS null_pct "
            "FROM deliveries"
        )
    return " UNION ALL ".join(parts)


def _dq_lines() -> str:
    # table, source, key, required columns, allowed null percentages
    lost = {
        "dim_media": "(SELECT count(*) FROM media WHERE media_id IS NULL)",
        "dim_visitor": "(SELECT count(*) FROM snapshots WHERE visitor_key IS NULL)",
        "fact_media_engagement":
            "(SELECT count(*) FROM deliveries WHERE event_key IS NULL OR media_id IS NULL)",
    }
    lengths = {
        "dim_media": {"media_id": 64, "name": 500, "status": 32, "project_name": 200,
                      "section_name": 300, "channel": 20},
        "dim_visitor": {"visitor_key": 256, "browser": 64, "browser_version": 32, "platform": 64,
                        "country": 128, "region": 128, "city": 128, "last_ip": 64},
        "fact_media_engagement": dict(_FACT_LENGTHS),
    }
    tables = (
        ("dim_media", "dim_media", "media_id", ("media_id", "name", "channel", "created_at"),
         {"media_id": 0, "name": 0, "channel": 0}),
        ("dim_visitor", "dim_visitor", "visitor_key", ("visitor_key", "browser", "platform"),
         {"visitor_key": 0, "browser": 20, "platform": 20}),
        ("fact_media_engagement", "facts", "event_key",
         ("event_key", "media_id", "visitor_key", "event_date", "percent_viewed"),
         {"event_key": 0, "media_id": 0, "visitor_key": 5}),
    )
    parts = []

    def line(table, check, column, value, threshold, ok):
        named = f"'{column}'" if column else "cast(NULL AS varchar)"
        limit = "cast(NULL AS double)" if threshold is None else f"cast({threshold} AS double)"
        return (
            f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", {named} AS \"column\", "
            f"cast({value} AS double) AS value, {limit} AS threshold, "
            f"CASE WHEN {ok} THEN 'ok' ELSE 'fail' END AS status"
        )

    for table, source, key, required, limits in tables:
        kept = f"count({key})"
        parts.append(line(table, "dropped_null_key", key, lost[table], None, "TRUE"))
        for c, n in lengths[table].items():
            long = f"count(*) FILTER (WHERE strlen({c}) > {n})"
            parts.append(line(table, "max_length", c, long, 0, f"{long} = 0") + f" FROM {source}")
        parts.append(line(table, "min_rows", None, kept, 1, f"{kept} >= 1") + f" FROM {source}")
        for c in required:
            parts.append(line(table, "required_column", c, 1, 1, "TRUE"))
        for c, limit in limits.items():
            nulls = f"count(*) FILTER (WHERE {key} IS NOT NULL AND {c} IS NULL)"
            share = f"({nulls} / {kept} * 100)"
            parts.append(
                line(table, "null_pct", c, f"round({share}, 2)", limit, f"{share} <= {limit}")
                + f" FROM {source}"
            )
        surplus = f"(count({key}) - count(DISTINCT {key}))"
        parts.append(
            line(table, "unique_key", key, surplus, 0, f"{surplus} = 0") + f" FROM {source}"
        )
    orphans = "count(*)"
    parts.append(
        line("fact_media_engagement", "orphan_media", "media_id", orphans, 0, f"{orphans} = 0")
        + " FROM facts f WHERE NOT EXISTS (SELECT 1 FROM dim_media m WHERE m.media_id = f.media_id)"
    )
    return " UNION ALL ".join(parts)


def _constraint_lines() -> str:
    titles = (
        ("not_null", "media_id", None, "doc_id IS NULL"),
        ("max_length", "media_id", 64, "strlen(cast(doc_id AS varchar)) > 64"),
        ("max_length", "name", 500, "strlen(text) > 500"),
        ("max_length", "status", 32, "strlen(lang) > 32"),
        ("max_length", "section_name", 300, "strlen(source) > 300"),
    )
    staged = [("not_null", c, None, f"{c} IS NULL") for c in ("event_key", "media_id")]
    staged += [("max_length", c, n, f"strlen({c}) > {n}") for c, n in _FACT_LENGTHS]
    staged += [
        ("decimal_range", c, 10000, f"abs({c}) >= 10000") for c in ("lat", "lon", "percent_viewed")
    ]
    parts = []
    for table, source, rules in (
        ("dim_media", "documents", titles), ("fact_media_engagement", "deliveries", staged)
    ):
        for rule, c, limit, bad in rules:
            shown = f"cast({'NULL' if limit is None else limit} AS bigint)"
            parts.append(
                f"SELECT '{table}' AS \"table\", '{rule}' AS \"constraint\", '{c}' AS \"column\", "
                f"{shown} AS \"limit\", count(*) FILTER (WHERE {bad}) AS violations FROM {source}"
            )
    return " UNION ALL ".join(parts)


def _cast_lines() -> str:
    failing = {"lat": "count(*) FILTER (WHERE platform = 'error')"}
    typed = (
        ("received_at", "timestamp"), ("lat", "decimal(10,6)"), ("lon", "decimal(10,6)"),
        ("percent_viewed", "decimal(10,6)"), ("is_mobile", "boolean"),
    )
    return " UNION ALL ".join(
        f"SELECT 'events' AS resource, '{c}' AS \"column\", '{t}' AS type, "
        f"{failing.get(c, 'count(*) FILTER (WHERE FALSE)')} AS failed FROM deliveries"
        for c, t in typed
    )


def all_oracles() -> dict[str, str]:
    upserted = f"""SELECT {_UPSERT_OUT} FROM (SELECT * FROM kept UNION ALL SELECT * FROM staging)"""
    landed_out = f"media_id, page, event_key, {_iso('received_at')} AS received_at"
    return {
        "channel_derivation": _with(
            "SELECT media_id AS hashed_id, name, channel FROM dim_media", "dim_media"),
        "dim_media_build": _with(f"SELECT {_MEDIA_OUT} FROM dim_media", "dim_media"),
        "media_without_stats": _with(
            """SELECT media_id, name, channel, total_plays,
                      cast(hours_watched AS double) AS hours_watched
                 FROM dim_media WHERE total_plays IS NULL""", "dim_media"),
        "media_metadata_only": _with(
            """SELECT media_id, channel, cast(NULL AS bigint) AS total_plays,
                      cast(NULL AS double) AS play_rate, cast(NULL AS double) AS hours_watched,
                      cast(NULL AS bigint) AS total_visitors FROM dim_media""", "dim_media"),
        "dim_visitor_build": _with(f"SELECT {_VISITOR_OUT} FROM dim_visitor", "dim_visitor"),
        "dim_visitor_mode": _with(
            f"SELECT {_VISITOR_OUT} FROM dim_visitor_mode", "dim_visitor_mode"),
        "visitor_geo_latest": _with("SELECT * FROM geo", "geo"),
        "visitor_geo_mode": _with("SELECT * FROM geo_mode", "geo_mode"),
        "fact_build": _with(f"SELECT {_FACT_OUT} FROM fact", "fact"),
        "fact_without_visitors": _with(
            """SELECT event_key, visitor_key, cast(NULL AS integer) AS visitor_play_count,
                      cast(NULL AS integer) AS visitor_load_count FROM facts""", "facts"),
        "replay_dedup_lineitem": f"""
            SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                   l_discount, l_tax, l_returnflag, l_linestatus, {_ts('l_shipdate')} AS l_shipdate
              FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                               l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC,
                               l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem)
             WHERE rn = 1""",
        "event_dates": f"""
            SELECT {_date('cast(ts AS date)')} AS local_date,
                   {_date("cast(CASE WHEN event_type = 'click' THEN ts + INTERVAL 5 HOUR ELSE ts END AS date)")} AS utc_date,
                   count(*) AS events
              FROM events GROUP BY 1, 2""",
        "engagement_daily": _with(
            f"""SELECT {_date('f.event_date')} AS event_date, m.channel, m.media_id,
                       m.name AS media_name, count(DISTINCT f.visitor_key) AS unique_visitors,
                       count(*) AS total_events, {_avg_share('f.percent_viewed')} AS avg_percent_viewed
                  {_JOINED} GROUP BY 1, 2, 3, 4""", "facts", "dim_media"),
        "top_countries": _with(
            f"""SELECT m.channel, f.country, count(*) AS events,
                       count(DISTINCT f.visitor_key) AS unique_visitors
                  {_JOINED} WHERE f.country IS NOT NULL GROUP BY 1, 2""", "facts", "dim_media"),
        "kpi_media": _with(
            """SELECT cast(sum(total_plays) AS bigint) AS total_plays,
                      cast(sum(total_loads) AS bigint) AS total_loads,
                      cast(round(sum(hours_watched), 1) AS double) AS total_hours
                 FROM dim_media""", "dim_media"),
        "kpi_fact": _with(
            f"""SELECT count(*) AS event_count, count(DISTINCT visitor_key) AS unique_visitors,
                       {_avg_pct('percent_viewed', 1)} AS avg_view_pct FROM facts""", "facts"),
        "channel_comparison": _with(
            f"""SELECT m.channel, count(*) AS events,
                       count(DISTINCT f.visitor_key) AS unique_visitors,
                       {_avg_pct('f.percent_viewed', 2)} AS avg_view_pct
                  {_JOINED} GROUP BY m.channel ORDER BY events DESC, channel""",
            "facts", "dim_media"),
        "geo_top15": _with(
            f"""SELECT country, count(*) AS events, count(DISTINCT visitor_key) AS unique_visitors,
                       {_avg_pct('percent_viewed', 2)} AS avg_view_pct
                  FROM facts WHERE country IS NOT NULL GROUP BY country
                 ORDER BY events DESC, country LIMIT 15""", "facts"),
        "daily_trend": _with(
            f"""SELECT {_date('f.event_date')} AS event_date, m.channel, count(*) AS events
                  {_JOINED} GROUP BY 1, 2 ORDER BY 1, 2""", "facts", "dim_media"),
        "depth_histogram": _with(
            f"""SELECT m.channel, cast(floor(f.percent_viewed * 10) * 10 AS integer) AS bucket_pct,
                       count(*) AS events
                  {_JOINED} GROUP BY 1, 2 ORDER BY 2, 1""", "facts", "dim_media"),
        "table_counts": _with(
            """SELECT 'dim_media' AS "table", count(*) AS row_count FROM dim_media
               UNION ALL SELECT 'dim_visitor', count(*) FROM dim_visitor
               UNION ALL SELECT 'fact_media_engagement', count(*) FROM fact""",
            "dim_media", "dim_visitor", "fact"),
        "sql_dashboard": _with(
            """SELECT week, m.channel, count(DISTINCT visitor_key) AS visitors,
                      count(*) FILTER (WHERE best >= 0.5) AS half_watched
                 FROM (SELECT cast(weekofyear(event_date) AS integer) AS week, media_id, visitor_key,
                              max(percent_viewed) AS best
                         FROM facts WHERE visitor_key IS NOT NULL GROUP BY ALL) s
                 JOIN dim_media m ON m.media_id = s.media_id
                GROUP BY 1, 2""", "facts", "dim_media"),
        "null_key_filter": _with(
            """SELECT 'fact_media_engagement' AS "table", count(*) AS rows_read,
                      count(*) FILTER (WHERE event_key IS NOT NULL AND media_id IS NOT NULL) AS rows_kept,
                      count(*) FILTER (WHERE event_key IS NULL OR media_id IS NULL) AS rows_dropped
                 FROM deliveries
               UNION ALL
               SELECT 'dim_visitor', count(*), count(visitor_key), count(*) - count(visitor_key)
                 FROM snapshots""", "deliveries", "snapshots"),
        "null_pct_profile": _with(_null_lines(), "deliveries"),
        "dq_report": _with(
            _dq_lines(), "media", "snapshots", "deliveries", "dim_media", "dim_visitor", "facts"),
        "orphan_facts": _with(
            f"""SELECT event_key, media_id, {_date('event_date')} AS event_date FROM facts f
                 WHERE NOT EXISTS (SELECT 1 FROM measured m WHERE m.media_id = f.media_id)""",
            "facts", "measured"),
        "orphan_count": _with(
            """SELECT count(*) AS orphans FROM facts f
                WHERE NOT EXISTS (SELECT 1 FROM measured m WHERE m.media_id = f.media_id)""",
            "facts", "measured"),
        "duplicate_keys": """
            SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
             GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "constraint_violations": _with(_constraint_lines(), "deliveries"),
        "cast_failures": _with(_cast_lines(), "deliveries"),
        "upsert_fact": _with(upserted, "kept", "staging"),
        "upsert_idempotent": _with(upserted, "kept", "staging"),
        "delete_using": _with(f"SELECT {_UPSERT_OUT} FROM kept", "kept"),
        # rows without a key never enter a published table
        "publish_replays": _with(
            f"""SELECT {_UPSERT_OUT}, {_date('cast(received_at AS date)')} AS event_date
                  FROM (SELECT * FROM kept UNION ALL SELECT * FROM staging)
                 WHERE event_key IS NOT NULL""", "kept", "staging"),
        "staging_load": _with(
            """SELECT m.media_id, m.channel, m.total_plays,
                      cast(m.hours_watched AS double) AS hours_watched, e.events, e.of_visitors
                 FROM dim_media m LEFT JOIN
                      (SELECT media_id, count(*) AS events, count(p.visitor_key) AS of_visitors
                         FROM facts f LEFT JOIN people p ON p.visitor_key = f.visitor_key
                        GROUP BY media_id) e
                      ON m.media_id = e.media_id""", "dim_media", "facts", "people"),
        "declared_replays": _with(
            f"""SELECT event_key, media_id, visitor_key,
                      {_date("""CASE WHEN event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'
                                THEN cast(event_date + INTERVAL 1 DAY AS date) ELSE event_date END""")}
                      AS event_date FROM facts""", "facts"),
        "incremental_filter": _with(f"SELECT {landed_out} FROM marked WHERE is_new", "marked"),
        "late_rows": _with(
            f"SELECT {landed_out}, {_ts('mark')} AS mark FROM marked WHERE NOT is_new", "marked"),
        "pull_and_publish": _with(
            f"""SELECT place, event_key, media_id, visitor_key, {_iso('received_at')} AS received_at
                  FROM pulled""", "pulled"),
        "broken_documents": _with(
            """SELECT platform = 'error' AS is_broken,
                      CASE WHEN platform <> 'error' THEN event_key END AS event_key
                 FROM first_events""", "first_events"),
        "full_refresh": _with(
            "SELECT media_id AS hashed_id, name FROM media WHERE status = 'ready'", "media"),
        "rerun_older_day": _with(f"SELECT {_VISITOR_OUT} FROM dim_visitor", "dim_visitor"),
        "publish_two_sources": _with(
            f"""SELECT event_key, media_id, {_ts('received_at')} AS received_at,
                       {_date('event_date')} AS event_date,
                       cast(percent_viewed AS double) AS percent_viewed FROM facts""", "facts"),
        "next_watermark": _with(
            f"""SELECT 'events' AS endpoint, media_id, {_iso('high_water')} AS high_water FROM (
                  SELECT coalesce(s.media_id, m.media_id) AS media_id,
                         greatest(s.seen, m.mark) AS high_water
                    FROM (SELECT media_id, max(received_at) AS seen FROM landed
                           GROUP BY media_id) s
                    FULL JOIN marks m ON s.media_id = m.media_id)
                 WHERE high_water IS NOT NULL""", "landed", "marks"),
        "path_media_id": """
            SELECT regexp_extract('bronze/media_stats/' || strftime(ts, 'year=%Y/month=%m/day=%d')
                     || '/media_id=' || (props->>'$.k') || '/' || (props->>'$.k') || '.json',
                     'media_id=([^/]+)/', 1) AS media_id, count(*) AS documents
              FROM events GROUP BY 1""",
        "json_props": """
            SELECT event_type, cast(props->>'$.k' AS integer) AS k, count(*) AS events,
                   '{"k":' || (props->>'$.k') || '}' AS as_json
              FROM events GROUP BY event_type, props->>'$.k'""",
        "media_allow_list": _with(
            """SELECT event_key, media_id FROM facts
                WHERE media_id IN (SELECT media_id FROM media WHERE status = 'archived')""",
            "facts", "media"),
        "json_bronze_roundtrip": _with(
            f"""SELECT event_key, media_id, visitor_key, {_ts('received_at')} AS received_at, ip,
                       country, region, city, cast(lat AS double) AS lat,
                       cast(lon AS double) AS lon,
                       cast(percent_viewed AS double) AS percent_viewed, embed_url, media_name,
                       browser, platform, is_mobile FROM deliveries""", "deliveries"),
        "silver_roundtrip": _with(f"SELECT {_VISITOR_OUT} FROM dim_visitor", "dim_visitor"),
        "landed_documents": _with(
            f"""SELECT coalesce(media_id, 'none') AS request_media_id,
                       date_diff('day', cast(first_at AS date), DATE '2024-01-30') + 1 AS page,
                       pos, event_key, {_iso('received_at')} AS received_at
                  FROM (SELECT media_id, received_at AS first_at, 0 AS pos, event_key, received_at
                          FROM first_events
                        UNION ALL
                        SELECT media_id, received_at - INTERVAL 1 HOUR, 1, event_key, received_at
                          FROM replays)""", "first_events", "replays"),
        "daily_load": _with(f"SELECT {_FACT_OUT} FROM fact", "fact"),
        "distinct_visitors": _with("""
            SELECT channel, count(DISTINCT visitor_key) AS unique_visitors
              FROM facts f JOIN dim_media m ON f.media_id = m.media_id
             WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY channel
            UNION ALL SELECT 'all days', count(DISTINCT visitor_key) FROM facts""", "facts", "dim_media"),
        "bucketed_joins": _with("""
            SELECT 'visitor' AS side, event_key AS key, cast(visitor_play_count AS bigint) AS n FROM fact
            UNION ALL SELECT 'channel', channel, count(*)
              FROM fact f JOIN dim_media m ON f.media_id = m.media_id GROUP BY channel""",
            "fact", "dim_media"),
        "schema_drift": """
            SELECT 'events' AS resource, * FROM (VALUES
              ('city', 'gone', 'STRING', CAST(NULL AS varchar), 0),
              ('embed_url', 'gone', 'STRING', NULL, 0),
              ('device', 'new', NULL, 'OBJECT', (SELECT count(*) FROM events)),
              ('percent_viewed', 'type', 'STRING', 'NUMBER', (SELECT count(value) FROM events)))
              AS t(field, change, old_kinds, new_kinds, documents)""",
        "snapshot_changes": _with("""
            SELECT media_id, CASE WHEN project_name = 'Brand#1' THEN 'new'
                                  WHEN section_name = 'SMALL' THEN 'gone'
                                  WHEN status = 'archived' THEN 'changed' ELSE 'same' END AS change
              FROM media WHERE project_name <> 'Brand#1' OR section_name <> 'SMALL'""", "media"),
        "evolving_parts": """
            SELECT event_id, cast(props->>'$.k' AS bigint) AS k,
                   CASE WHEN event_id % 3 < 2 THEN event_type END AS event_type,
                   CASE WHEN event_id % 3 > 0 THEN user_id END AS user_id FROM events""",
        "sql_geo_range": _with(f"""
            SELECT country, count(*) AS events, count(DISTINCT visitor_key) AS unique_visitors,
                   {_avg_pct('percent_viewed', 2)} AS avg_view_pct
              FROM facts WHERE country IS NOT NULL AND event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
             GROUP BY country ORDER BY events DESC, country LIMIT 7""", "facts"),
        "sql_depth_range": _with(f"""
            SELECT channel, cast(floor(percent_viewed * 10) * 10 AS integer) AS bucket_pct,
                   count(*) AS events {_JOINED} WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY ALL""", "facts", "dim_media"),
        "sql_channels": _with(
            "SELECT channel, count(*) AS videos FROM dim_media GROUP BY channel", "dim_media"
        ),
        "stats_by_path": """
            SELECT p_brand || ' ' || p_size AS media_id, count(*) AS plays
              FROM part GROUP BY p_brand, p_size""",
        "tracked_setting": _with(
            "SELECT event_key, media_id FROM facts WHERE media_id IN ('1', '7', '42', '99', 'none')",
            "facts",
        ),
        "empty_builds": _with("""
            SELECT s.status, nullif(count(m.media_id), 0) AS written
              FROM (VALUES ('ready'), ('archived'), ('deleted')) AS s(status)
              LEFT JOIN media m ON m.status = s.status GROUP BY s.status""", "media"),
        "gated_stream": _with("""
            SELECT 'published' AS place, event_key FROM first_events
             WHERE platform <> 'error' AND event_key IS NOT NULL AND media_id IS NOT NULL
            UNION ALL SELECT 'broken', event_key FROM first_events WHERE platform = 'error'
            UNION ALL SELECT 'rows', cast(count(*) AS varchar) FROM first_events WHERE platform <> 'error'
            UNION ALL SELECT 'no_key', cast(count(*) AS varchar) FROM first_events
             WHERE platform <> 'error' AND (event_key IS NULL OR media_id IS NULL)
            UNION ALL SELECT 'broken', cast(count(*) AS varchar) FROM first_events
             WHERE platform = 'error'""", "first_events"),
        "late_files": _with(
            f"SELECT event_key, media_id, visitor_key, {_ts('received_at')} AS received_at, "
            f"{_date('event_date')} AS event_date FROM facts", "facts"
        ),
        "stream_daily_trend": _with(
            f"""SELECT {_date('f.event_date')} AS event_date, m.channel, count(*) AS events
                  {_JOINED} GROUP BY 1, 2""", "facts", "dim_media"),
        "stream_upsert": _with(
            f"""SELECT event_key, media_id, {_ts('received_at')} AS received_at,
                       {_date('event_date')} AS event_date,
                       cast(percent_viewed AS double) AS percent_viewed FROM facts""", "facts"),
    }
