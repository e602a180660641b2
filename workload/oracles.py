"""The same questions in plain SQL over the supplied tables."""

from __future__ import annotations

BASE = "https://example.org"
R1, R2 = "2024-01-01 12:00:00", "2024-01-02 12:00:00"

SERIES = """
series AS (
  SELECT concat('PRS', lpad(CAST(c_nationkey AS VARCHAR), CAST(greatest(8, length(CAST(c_nationkey AS VARCHAR))) AS INTEGER), '0')) AS series_id,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         concat('Q0', quarter(o_orderdate)) AS period,
         round_even(o_totalprice / 16 * 1000, 0) / 1000 AS value
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

ODD_SERIES = """
series AS (
  SELECT CASE WHEN o_orderkey % 11 <> 0 THEN concat('S', c_nationkey) END AS series_id,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         concat('Q0', quarter(o_orderdate)) AS period,
         CASE WHEN c_nationkey <> 3 AND o_orderkey % 7 > 1
              THEN round_even((CAST(o_orderkey % 32 AS DOUBLE) / 16 - 1) * 1000, 0) / 1000 END AS value
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

QUOTED_SERIES = """
SELECT concat('S', c_nationkey) AS series_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE o_orderkey % 3 WHEN 0 THEN concat('order "', o_orderkey, '"', chr(10), chr(10), 'of', chr(9), o_orderpriority)
            WHEN 1 THEN '5" pipe' END AS footnote_codes,
       concat('Q0', quarter(o_orderdate)) AS period, round_even(o_totalprice / 16 * 1000, 0) / 1000 AS value
FROM orders JOIN customer ON o_custkey = c_custkey"""

# A series without any value sums to 0; rows without a key drop out.
ODD_YEARLY = """
yearly AS (
  SELECT series_id, year, coalesce(sum(CAST(value AS DECIMAL(28, 3))), 0) AS total
  FROM series WHERE series_id IS NOT NULL GROUP BY series_id, year
)"""

POPULATION = """
population AS (
  SELECT year(l_shipdate) + 2 AS "ID Year",
         CASE WHEN year(l_shipdate) + 2 <> 1999 THEN count(*) END AS "Population"
  FROM lineitem GROUP BY year(l_shipdate)
)"""

CHOSEN = """
chosen AS (SELECT * FROM population WHERE "ID Year" BETWEEN 1998 AND 2002)"""

# The exact sums of whole numbers, so that both engines take the same last steps.
STATS = """
sums AS (
  SELECT count("Population") AS n, sum(CAST("Population" AS HUGEINT)) AS total,
         sum(CAST("Population" AS HUGEINT) * "Population") AS squares
  FROM chosen
),
stats AS (
  SELECT CAST(total AS DOUBLE) / CAST(n AS DOUBLE) AS mean,
         CASE WHEN n > 1 THEN sqrt(CAST(CAST(n * squares - total * total AS VARCHAR) AS DOUBLE) / (CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) - 1))) END AS std
  FROM sums
)"""

YEARLY = """
yearly AS (
  SELECT series_id, year, sum(CAST(value AS DECIMAL(28, 3))) AS total FROM series GROUP BY series_id, year
)"""

BEST = """
best AS (
  SELECT series_id, year, CAST(total AS DOUBLE) AS summed_value
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY total DESC, year) AS place FROM yearly)
  WHERE place = 1
)"""

JOINED = """
joined AS (
  SELECT series_id, year, period, value, "Population"
  FROM series LEFT JOIN population ON year = "ID Year"
  WHERE series_id = 'PRS00000007' AND period = 'Q01' AND "Population" IS NOT NULL
)"""


def _listing(name: str, status: str) -> str:
    return f"""
{name} AS (
  SELECT concat('p', l_partkey, '-s', l_suppkey) AS file_name,
         concat('01/0', max(l_linenumber), '/2024 08:30 AM') AS file_timestamp,
         concat('{BASE}/pub/', CASE WHEN max(l_quantity) > 25 THEN 'bulk' ELSE 'retail' END,
                '/p', l_partkey, '-s', l_suppkey) AS full_url
  FROM lineitem WHERE l_linestatus = '{status}' GROUP BY l_partkey, l_suppkey
)"""


LISTINGS = _listing("first", "F") + "," + _listing("second", "O")

# Both runs of the pair `first`, `second`.
FEED = f"""
feed AS (
  SELECT file_name, status, file_timestamp, full_url, old_file_timestamp, old_full_url,
         CASE WHEN status <> 'new' THEN '{R1}' END AS old_start_timestamp, '{R2}' AS run_ts
  FROM (
    SELECT coalesce(n.file_name, o.file_name) AS file_name,
           CASE WHEN n.file_name IS NULL THEN 'removed' WHEN o.file_name IS NULL THEN 'new'
                WHEN n.file_timestamp = o.file_timestamp AND n.full_url = o.full_url THEN 'unchanged'
                ELSE 'changed' END AS status,
           n.file_timestamp, n.full_url, o.file_timestamp AS old_file_timestamp, o.full_url AS old_full_url
    FROM second n FULL OUTER JOIN first o ON n.file_name = o.file_name
  )
)"""

TRACKER = f"""
tracker AS (
  SELECT file_name, old_file_timestamp AS file_timestamp, old_full_url AS full_url, '{R1}' AS start_timestamp,
         CASE WHEN status <> 'unchanged' THEN '{R2}' END AS end_timestamp,
         CASE WHEN status <> 'unchanged' THEN 'N' ELSE 'Y' END AS is_active
  FROM feed WHERE status <> 'new'
  UNION ALL
  SELECT file_name, file_timestamp, full_url, '{R2}', NULL, 'Y' FROM feed WHERE status IN ('new', 'changed')
)"""

SCD2 = f"WITH {LISTINGS},{FEED},{TRACKER}"

ANSWERS = f"""
WITH {SERIES},{POPULATION},{CHOSEN},{STATS},{YEARLY},{BEST},{JOINED}
SELECT 'population_stats' AS question, mean, std,
       CAST(NULL AS VARCHAR) AS series_id, CAST(NULL AS INTEGER) AS year, CAST(NULL AS DOUBLE) AS summed_value,
       CAST(NULL AS VARCHAR) AS period, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS BIGINT) AS "Population"
FROM stats
UNION ALL
SELECT 'best_years', NULL, NULL, series_id, year, summed_value, NULL, NULL, NULL FROM best
UNION ALL
SELECT 'series_with_population', NULL, NULL, series_id, year, NULL, period, value, "Population" FROM joined"""


def _spells(history: str, runs: str) -> str:
    """Gaps and islands over the runs that took place."""
    return f"""
WITH history AS ({history}),
calendar AS (
  SELECT run_ts, row_number() OVER (ORDER BY run_ts) AS ord, lead(run_ts) OVER (ORDER BY run_ts) AS next_run
  FROM ({runs})
),
marked AS (
  SELECT h.*, ord, next_run,
         CASE WHEN lag(ord) OVER w = ord - 1 AND lag(file_timestamp) OVER w = file_timestamp
                   AND lag(full_url) OVER w = full_url THEN 0 ELSE 1 END AS starts
  FROM history h JOIN calendar USING (run_ts)
  WINDOW w AS (PARTITION BY file_name ORDER BY ord)
),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY file_name ORDER BY ord) AS nth FROM marked)
SELECT file_name, file_timestamp, full_url, min(run_ts) AS start_timestamp,
       arg_max_null(next_run, ord) AS end_timestamp,
       CASE WHEN arg_max_null(next_run, ord) IS NULL THEN 'Y' ELSE 'N' END AS is_active
FROM numbered GROUP BY file_name, nth, file_timestamp, full_url"""


def _profile(table: str, columns: list[tuple[str, str]], prefix: str = "") -> str:
    lines = [
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
        f'count("{name}") AS non_null_count, count(*) AS row_count FROM {table}'
        for i, (name, kind) in enumerate(columns)
    ]
    return prefix + "\nUNION ALL\n".join(lines)


DOCUMENT_LISTINGS = f"""
first AS (
  SELECT concat('doc-', doc_id) AS file_name, '01/01/2024 08:30 AM' AS file_timestamp,
         concat('{BASE}/', lang, '/', source) AS full_url, text
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
),
second AS (
  SELECT concat('doc-', d.doc_id) AS file_name, '01/01/2024 08:30 AM' AS file_timestamp,
         concat('{BASE}/', lang, '/', source, CASE WHEN quality = 1 THEN '?v=2' ELSE '' END) AS full_url, text
  FROM documents d JOIN labels USING (doc_id)
)"""

CURRENT_FILES = f"""
WITH {DOCUMENT_LISTINGS},
copies AS (
  SELECT s.file_name,
         CASE WHEN f.full_url = s.full_url THEN s.text ELSE concat(s.text, ' v2') END AS content
  FROM second s LEFT JOIN first f USING (file_name)
)
SELECT file_name, CAST(octet_length(encode(content)) AS INTEGER) AS n_bytes, md5(content) AS md5 FROM copies"""

LINE_COLUMNS = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]

SERIES_COLUMNS = [
    ("series_id", "string"),
    ("year", "int"),
    ("period", "string"),
    ("value", "double"),
    ("missing", "string"),
]

TRACKER_ROWS = f"{SCD2} SELECT * FROM tracker"

ORACLES: dict[str, str] = {
    "clean_series": f"WITH {SERIES} SELECT *, CAST(NULL AS VARCHAR) AS footnote_codes FROM series",
    "population_prepared": f"WITH {POPULATION} SELECT * FROM population",
    "population_source": f"""WITH {POPULATION}
        SELECT 'lines' AS name, 'Population' AS measures, 'lineitem' AS source_name
        FROM population""",
    "population_stats": f"""WITH {POPULATION},{CHOSEN},{STATS}
        SELECT mean, std FROM stats""",
    "population_rows": f"WITH {POPULATION},{CHOSEN} SELECT * FROM chosen",
    "population_band": f"""WITH {POPULATION},{CHOSEN},{STATS}
        SELECT chosen.*, mean, mean - std AS lower, mean + std AS upper
        FROM chosen, stats""",
    "best_year_per_series": f"WITH {SERIES},{YEARLY},{BEST} SELECT * FROM best",
    "best_year_from_text": f"WITH {SERIES},{YEARLY},{BEST} SELECT * FROM best",
    "best_year_odd": f"WITH {ODD_SERIES},{ODD_YEARLY},{BEST} SELECT * FROM best",
    "clean_series_odd": f"WITH {ODD_SERIES} SELECT * FROM series",
    "clean_series_quoted": QUOTED_SERIES,
    "clean_landed_quoted": QUOTED_SERIES,
    "best_year_from_landed": f"WITH {SERIES},{YEARLY},{BEST} SELECT * FROM best",
    "yearly_sums": f"WITH {SERIES},{YEARLY} SELECT series_id, year, CAST(total AS DOUBLE) AS value FROM yearly",
    "series_with_population": f"WITH {SERIES},{POPULATION},{JOINED} SELECT * FROM joined",
    "analysis_all": ANSWERS,
    "distinct_years": f"WITH {SERIES},{POPULATION},{JOINED} SELECT DISTINCT year FROM joined",
    "distinct_populations": f'WITH {SERIES},{POPULATION},{JOINED} SELECT DISTINCT "Population" FROM joined',
    "first_label": f"""WITH {SERIES},{POPULATION},{JOINED}
        SELECT series_id, period FROM joined ORDER BY year, period, value LIMIT 1""",
    "table_profile": _profile(
        "marked", SERIES_COLUMNS, f"WITH {SERIES}, marked AS (SELECT *, nullif(period, 'Q02') AS missing FROM series)\n"
    ),
    "table_profile_lines": _profile("lineitem", LINE_COLUMNS),
    "listing_extract": f"""
        WITH timed AS (
          SELECT *, TIMESTAMP '2024-01-01' + p_size * INTERVAL 1 DAY + (p_partkey % 1440) * INTERVAL 1 MINUTE AS t
          FROM part
        )
        SELECT concat('p', p_partkey, '.', kind) AS file_name, strftime(t, '%m/%d/%Y %I:%M %p') AS file_timestamp,
               concat('{BASE}/pub/', lower(p_type), '/p', p_partkey, '.', kind) AS full_url,
               CASE kind WHEN 'data' THEN p_size ELSE p_partkey END AS file_size
        FROM timed, (VALUES ('data'), ('series')) kinds(kind)""",
    "listing_extract_odd": f"""
        SELECT CASE p_partkey % 3 WHEN 0 THEN concat('p', p_partkey) WHEN 1 THEN concat('caf\u00e9 p', p_partkey)
                    ELSE concat('\u65e5 p', p_partkey) END AS file_name,
               CASE p_partkey % 3 WHEN 0 THEN '01/02/2024 08:30 AM' WHEN 1 THEN '11/12/2024 12:05 PM'
                    ELSE '11/12/2024 12:05 AM' END AS file_timestamp,
               concat('{BASE}', CASE p_partkey % 3 WHEN 0 THEN '/pub/p' WHEN 1 THEN '/a&b/p' ELSE '/q?x=1&y=&unknown;/p' END,
                      p_partkey) AS full_url,
               CAST(p_size AS BIGINT) AS file_size
        FROM part""",
    "listing_from_files": f"WITH {LISTINGS} SELECT * FROM first",
    "page_links": f"""
        WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a href=".*?">.*?</a>')) AS link FROM pages)
        SELECT page_id, concat('{BASE}', regexp_extract(link, '(?s)<a href="(.*?)">(.*?)</a>', 1)) AS full_url,
               regexp_extract(link, '(?s)<a href="(.*?)">(.*?)</a>', 2) AS label
        FROM links""",
    "path_parts": r"""
        WITH urls AS (SELECT page_id, regexp_replace(url, '^http://', 's3://') AS url FROM pages)
        SELECT page_id, starts_with(url, 's3://') AS is_object, starts_with(url, 'https://') AS is_http,
               regexp_extract(url, '^(s3://)?([^/]*)/(.*)$', 2) AS container,
               regexp_extract(url, '^(s3://)?([^/]*)/(.*)$', 3) AS key,
               regexp_extract(url, '^(.*)/[^/]*$', 1) AS directory,
               regexp_extract(url, '([^/]*)$', 1) AS file_name,
               concat(regexp_extract(url, '^(.*)/[^/]*$', 1), '/index.html') AS joined
        FROM urls""",
    "scd2_bootstrap": f"""WITH {LISTINGS}
        SELECT *, '{R1}' AS start_timestamp, CAST(NULL AS VARCHAR) AS end_timestamp, 'Y' AS is_active FROM first""",
    "scd2_bootstrap_now": f"WITH {LISTINGS} SELECT true AS stamped, count(*) AS n_files, true AS well_formed, true AS of_today FROM first",
    "scd2_apply": TRACKER_ROWS,
    "scd2_changes": f"WITH {LISTINGS},{FEED} SELECT * FROM feed WHERE status <> 'unchanged'",
    "scd2_reactivated": f"""WITH {LISTINGS},{FEED}
        SELECT file_name, CASE status WHEN 'new' THEN 'removed' WHEN 'removed' THEN 'reactivated' ELSE status END AS status
        FROM feed WHERE status <> 'unchanged'""",
    "first_active": f"""{SCD2}
        SELECT file_name, min(start_timestamp) AS start_timestamp, count(*) AS n_active
        FROM tracker WHERE is_active = 'Y' GROUP BY file_name""",
    "sync_plan": f"""WITH {LISTINGS},{FEED}
        SELECT file_name, coalesce(full_url, old_full_url) AS full_url,
               CASE status WHEN 'removed' THEN 'delete' ELSE 'fetch' END AS action
        FROM feed WHERE status <> 'unchanged'""",
    "tracker_round_trip": TRACKER_ROWS,
    "tracker_store": TRACKER_ROWS,
    "scd2_history": _spells(
        f"""SELECT concat('user-', user_id) AS file_name, '01/01/2024 08:30 AM' AS file_timestamp,
                   concat('{BASE}/', event_type) AS full_url, concat(strftime(ts, '%Y-%m-%d'), ' 12:00:00') AS run_ts
            FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
        "SELECT DISTINCT concat(strftime(ts, '%Y-%m-%d'), ' 12:00:00') AS run_ts FROM events",
    ),
    "scd2_history_parts": _spells(
        f"""SELECT concat('part-', l_partkey) AS file_name,
                   concat('01/0', max(l_linenumber), '/2024 08:30 AM') AS file_timestamp,
                   concat('{BASE}/part-', l_partkey) AS full_url,
                   concat(strftime(l_shipdate, '%Y-%m'), '-01 12:00:00') AS run_ts
            FROM lineitem GROUP BY l_partkey, strftime(l_shipdate, '%Y-%m')""",
        "SELECT DISTINCT concat(strftime(l_shipdate, '%Y-%m'), '-01 12:00:00') AS run_ts FROM lineitem",
    ),
    "scd2_backlog": _spells(
        f"""SELECT concat('part-', l_partkey) AS file_name,
                   concat('01/0', max(l_linenumber), '/2024 08:30 AM') AS file_timestamp,
                   concat('{BASE}/part-', l_partkey) AS full_url,
                   concat(strftime(l_shipdate, '%Y-%m'), '-01 12:00:00') AS run_ts
            FROM lineitem GROUP BY l_partkey, strftime(l_shipdate, '%Y-%m')""",
        "SELECT DISTINCT concat(strftime(l_shipdate, '%Y-%m'), '-01 12:00:00') AS run_ts FROM lineitem",
    ),
    "raw_after_sync": CURRENT_FILES,
    "raw_store_current": CURRENT_FILES,
    "raw_from_directory": f"""
        WITH lines AS (SELECT *, l_suppkey % 40 AS g FROM lineitem)
        SELECT concat('g[', g, ']') AS file_name,
               CAST(sum(length(concat_ws(',', l_orderkey, l_linenumber)) + 1) AS INTEGER) AS n_bytes,
               CASE WHEN g % 4 = 3 OR g % 5 = 0 THEN '{R2}' ELSE '{R1}' END AS run_ts
        FROM lines WHERE g % 4 <> 1 GROUP BY g""",
    "scheduled_run": f"""{SCD2},{POPULATION}
        SELECT start_timestamp, end_timestamp, count(*) AS n FROM tracker GROUP BY ALL
        UNION ALL
        SELECT r, CAST(NULL AS VARCHAR), count(*) FROM population,
               (VALUES ('r20240101120000'), ('r20240102120000'), ('r20240103120000')) runs(r) GROUP BY r""",
    "file_bytes": """SELECT concat('lang=', lang) AS folder,
        CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY lang""",
    "snapshot_round_trip": f"WITH {POPULATION} SELECT * FROM population",
    "stream_scd2": TRACKER_ROWS,
    "stream_scd2_pages": f"""{TRACKER_ROWS}
        UNION ALL SELECT NULL, NULL, NULL, '2024-01-01 18:00:00', NULL, 'refused'
        UNION ALL SELECT NULL, NULL, NULL, '2023-12-31 12:00:00', NULL, 'refused'""",
    "stream_scd2_unreadable": f"""{TRACKER_ROWS}
        UNION ALL SELECT NULL, NULL, 'no such time: 13/45/2025 08:30 AM', '2024-01-01 15:00:00', NULL, 'refused'
        UNION ALL SELECT NULL, NULL, 'a page does not say ''page''', '2024-01-01 16:00:00', NULL, 'refused'
        UNION ALL SELECT NULL, NULL, 'not a run time: (missing)', '(missing)', NULL, 'refused'
        UNION ALL SELECT '7', NULL, 'no such time: 13/45/2025 08:30 AM', NULL, NULL, 'unreadable'
        UNION ALL SELECT NULL, NULL, 'a page does not say ''page''', NULL, NULL, 'unreadable'
        UNION ALL SELECT CAST(p AS VARCHAR), NULL, 'not a run time: (missing)', NULL, NULL, 'unreadable' FROM range(1, 4) pages(p)""",
    "stream_analysis": ANSWERS,
    "stream_analysis_kept": ANSWERS,
}
