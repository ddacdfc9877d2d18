"""DuckDB SQL computing the same results as ``registry.QUERIES``.

Written the straightforward way (the fan-out joins are materialised, windows
are global) so it checks the distributed formulations independently.  Views
of the provided tables are registered by the caller.
"""

from __future__ import annotations

YEARS = (1996, 2000)

# The provided tables seen as titles and links (see plans/standin.py).
SILVER = """
anime AS (
  SELECT CAST(0 AS BIGINT) AS raw_id, 1 AS batch_id, 0 AS page,
         o.o_orderkey AS anime_id, c.c_name AS title, c.c_name AS title_english,
         o.o_orderpriority AS type, c.c_mktsegment AS source,
         CAST(dayofmonth(o.o_orderdate) AS INTEGER) AS no_of_episodes,
         o.o_orderstatus AS status,
         CASE o.o_orderpriority
           WHEN '1-URGENT' THEN CAST(dayofmonth(o.o_orderdate) AS VARCHAR) || ' min per ep'
           WHEN '2-HIGH' THEN CAST(month(o.o_orderdate) AS VARCHAR) || ' hr '
                              || CAST(dayofmonth(o.o_orderdate) AS VARCHAR) || ' min'
           WHEN '3-MEDIUM' THEN CAST(dayofmonth(o.o_orderdate) AS VARCHAR) || ' sec per ep'
           WHEN '4-NOT SPECIFIED' THEN CAST(month(o.o_orderdate) AS VARCHAR) || ' hr'
           ELSE 'Unknown' END AS duration,
         CASE o.o_orderpriority
           WHEN '1-URGENT' THEN CAST(dayofmonth(o.o_orderdate) AS FLOAT)
           WHEN '2-HIGH' THEN CAST(month(o.o_orderdate) * 60 + dayofmonth(o.o_orderdate) AS FLOAT)
           WHEN '3-MEDIUM' THEN CAST(CAST(dayofmonth(o.o_orderdate) AS FLOAT) / 60.0 AS FLOAT)
           WHEN '4-NOT SPECIFIED' THEN CAST(month(o.o_orderdate) * 60 AS FLOAT)
           ELSE CAST(NULL AS FLOAT) END AS minutes_expected,
         CAST(ROUND(c.c_acctbal * 100) AS INTEGER) AS score,
         CAST(o.o_custkey AS INTEGER) AS scored_by,
         c.c_nationkey AS rank,
         CAST(month(o.o_orderdate) AS INTEGER) AS popularity,
         CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS members,
         CAST(dayofmonth(o.o_orderdate) AS INTEGER) AS favorites,
         CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
links_anime_genres AS (
  SELECT DISTINCT l.l_orderkey AS anime_id,
         CAST(regexp_extract(p.p_brand, '(\\d+)', 1) AS INTEGER) AS genre_id, p.p_brand AS genre_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
links_anime_producers AS (
  SELECT DISTINCT l.l_orderkey AS anime_id, p.p_partkey AS producer_id, p.p_name AS producer_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
links_anime_studios AS (
  SELECT DISTINCT l.l_orderkey AS anime_id, s.s_suppkey AS studio_id, s.s_name AS studio_name
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
links_anime_licensors AS (
  SELECT DISTINCT l.l_orderkey AS anime_id, n.n_nationkey AS licensor_id, n.n_name AS licensor_name
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
),
links_anime_themes AS (
  SELECT DISTINCT l.l_orderkey AS anime_id, r.r_regionkey AS theme_id, r.r_name AS theme_name
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
links_anime_demographics AS (
  SELECT DISTINCT o.o_orderkey AS anime_id, n.n_nationkey AS demographic_id, n.n_name AS demographic_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

GOLD = """,
d_sources AS (SELECT CAST(row_number() OVER (ORDER BY source) AS BIGINT) AS source_id, source
              FROM (SELECT DISTINCT source FROM anime WHERE source IS NOT NULL)),
d_statuses AS (SELECT CAST(row_number() OVER (ORDER BY status) AS BIGINT) AS status_id, status
               FROM (SELECT DISTINCT status FROM anime WHERE status IS NOT NULL)),
d_types AS (SELECT CAST(row_number() OVER (ORDER BY type) AS BIGINT) AS type_id, type
            FROM (SELECT DISTINCT type FROM anime WHERE type IS NOT NULL)),
f_anime AS (
  SELECT a.anime_id, a.title, a.title_english, a.no_of_episodes,
         a.minutes_expected AS duration_minutes_per_episode, a.score, a.scored_by, a.rank,
         a.popularity, a.members, a.favorites, a.year, ds.status_id, dt.type_id, dsrc.source_id
  FROM anime a
  LEFT JOIN d_statuses ds ON a.status = ds.status
  LEFT JOIN d_types dt ON a.type = dt.type
  LEFT JOIN d_sources dsrc ON a.source = dsrc.source
  WHERE a.batch_id = (SELECT MAX(batch_id) FROM anime)
),
d_genres AS (SELECT DISTINCT genre_id, genre_name FROM links_anime_genres),
d_producers AS (SELECT DISTINCT producer_id, producer_name FROM links_anime_producers),
d_studios AS (SELECT DISTINCT studio_id, studio_name FROM links_anime_studios),
d_licensors AS (SELECT DISTINCT licensor_id, licensor_name FROM links_anime_licensors),
d_themes AS (SELECT DISTINCT theme_id, theme_name FROM links_anime_themes),
d_demographics AS (SELECT DISTINCT demographic_id, demographic_name FROM links_anime_demographics),
links_genres AS (SELECT anime_id, genre_id FROM links_anime_genres),
links_producers AS (SELECT anime_id, producer_id FROM links_anime_producers),
links_studios AS (SELECT anime_id, studio_id FROM links_anime_studios),
links_licensors AS (SELECT anime_id, licensor_id FROM links_anime_licensors),
links_themes AS (SELECT anime_id, theme_id FROM links_anime_themes),
links_demographics AS (SELECT anime_id, demographic_id FROM links_anime_demographics),
enriched AS (
  SELECT f.*, src.source, ty.type, st.status, ll.licensor_id, dl.licensor_name, lg.genre_id, dg.genre_name
  FROM f_anime f
  LEFT JOIN d_sources src ON f.source_id = src.source_id
  LEFT JOIN d_types ty ON f.type_id = ty.type_id
  LEFT JOIN d_statuses st ON f.status_id = st.status_id
  LEFT JOIN links_licensors ll ON f.anime_id = ll.anime_id
  LEFT JOIN d_licensors dl ON ll.licensor_id = dl.licensor_id
  LEFT JOIN links_genres lg ON f.anime_id = lg.anime_id
  LEFT JOIN d_genres dg ON lg.genre_id = dg.genre_id
),
filtered AS (SELECT * FROM enriched WHERE year BETWEEN {lo} AND {hi})""".format(lo=YEARS[0], hi=YEARS[1])

PREFIX = "WITH " + SILVER + GOLD

ORACLES: dict[str, str] = {}

ORACLES["q_category_share_by_year"] = PREFIX + """,
gy AS (
  SELECT f.year, dg.genre_name, SUM(f.members) AS members
  FROM links_genres lg JOIN d_genres dg ON lg.genre_id = dg.genre_id
  JOIN (SELECT anime_id, year, members FROM filtered) f ON lg.anime_id = f.anime_id
  WHERE f.year IS NOT NULL AND dg.genre_name IS NOT NULL
  GROUP BY f.year, dg.genre_name
),
top10 AS (SELECT genre_name FROM gy GROUP BY genre_name ORDER BY SUM(members) DESC, genre_name LIMIT 10),
kept AS (SELECT * FROM gy WHERE genre_name IN (SELECT genre_name FROM top10))
SELECT year, genre_name, CAST(members AS BIGINT) AS members,
       CAST(members AS DOUBLE) * 100.0 / CAST(SUM(members) OVER (PARTITION BY year) AS DOUBLE) AS share_pct
FROM kept
"""

# ------------------------------------------------------------------- marts
ORACLES["q_enriched_asis"] = PREFIX + """
SELECT AVG(score) AS avg_score, CAST(COALESCE(SUM(members), 0) AS BIGINT) AS total_members FROM filtered
"""

ORACLES["q_enriched_dedup"] = PREFIX + """
SELECT AVG(score) AS avg_score, CAST(COALESCE(SUM(members), 0) AS BIGINT) AS total_members
FROM f_anime WHERE year BETWEEN {lo} AND {hi}
""".format(lo=YEARS[0], hi=YEARS[1])

ORACLES["q_enriched_rows"] = PREFIX + """
SELECT * REPLACE (CAST(licensor_id AS DOUBLE) AS licensor_id, CAST(genre_id AS DOUBLE) AS genre_id) FROM filtered
"""

ORACLES["q_bubble_rows"] = PREFIX + """
SELECT anime_id, title_english, score, members, favorites, genre_name FROM filtered
"""

ORACLES["q_category_summary_top15"] = PREFIX + """,
gs AS (
  SELECT dg.genre_name, COUNT(e.anime_id) AS anime_count, SUM(e.members) AS members, AVG(e.score) AS score
  FROM links_genres lg JOIN d_genres dg ON lg.genre_id = dg.genre_id
  JOIN (SELECT anime_id, members, score FROM enriched) e ON lg.anime_id = e.anime_id
  WHERE dg.genre_name IS NOT NULL
  GROUP BY dg.genre_name
)
SELECT genre_name, CAST(anime_count AS BIGINT) AS anime_count, CAST(members AS BIGINT) AS members, score
FROM gs ORDER BY members DESC, genre_name LIMIT 15
"""

ORACLES["q_stored_marts"] = PREFIX + """,
late AS (SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)),
now AS (SELECT anime_id, score, genre_id, members + CASE WHEN anime_id IN (SELECT o_orderkey FROM late) THEN 1000 ELSE 0 END AS members
        FROM enriched)
SELECT dg.genre_name, COUNT(*) AS anime_count, CAST(SUM(e.members) AS BIGINT) AS members, AVG(e.score) AS score
FROM links_genres lg JOIN d_genres dg ON lg.genre_id = dg.genre_id JOIN now e ON lg.anime_id = e.anime_id
GROUP BY dg.genre_name
"""

ORACLES["q_category_summary_top15_dedup"] = PREFIX + """,
titles AS (SELECT f.*, src.source FROM f_anime f LEFT JOIN d_sources src ON f.source_id = src.source_id),
gs AS (
  SELECT dg.genre_name, COUNT(t.anime_id) AS anime_count, SUM(t.members) AS members, AVG(t.score) AS score
  FROM links_genres lg JOIN d_genres dg ON lg.genre_id = dg.genre_id
  JOIN (SELECT anime_id, members, score FROM titles) t ON lg.anime_id = t.anime_id
  WHERE dg.genre_name IS NOT NULL
  GROUP BY dg.genre_name
)
SELECT genre_name, CAST(anime_count AS BIGINT) AS anime_count, CAST(members AS BIGINT) AS members, score
FROM gs ORDER BY members DESC, genre_name LIMIT 15
"""

ORACLES["q_source_analysis"] = PREFIX + """
SELECT source, AVG(score) AS score, AVG(popularity) AS popularity, CAST(COUNT(anime_id) AS BIGINT) AS anime_count
FROM filtered WHERE source IS NOT NULL GROUP BY source
"""

ORACLES["q_source_share"] = PREFIX + """,
c AS (SELECT source, COUNT(anime_id) AS anime_count FROM filtered WHERE source IS NOT NULL GROUP BY source)
SELECT source, CAST(anime_count AS BIGINT) AS anime_count,
       CAST(anime_count AS DOUBLE) * 100.0 / CAST(SUM(anime_count) OVER () AS DOUBLE) AS share_pct
FROM c
"""

ORACLES["q_source_summary"] = PREFIX + """
SELECT source, CAST(COUNT(anime_id) AS BIGINT) AS anime_count, AVG(members) AS members, AVG(score) AS score
FROM filtered WHERE source IS NOT NULL GROUP BY source ORDER BY members DESC
"""

ORACLES["q_source_summary_dedup"] = PREFIX + """,
t AS (SELECT f.*, src.source FROM f_anime f LEFT JOIN d_sources src ON f.source_id = src.source_id
      WHERE f.year BETWEEN {lo} AND {hi})
SELECT source, CAST(COUNT(anime_id) AS BIGINT) AS anime_count, AVG(members) AS members, AVG(score) AS score
FROM t WHERE source IS NOT NULL GROUP BY source
""".format(lo=YEARS[0], hi=YEARS[1])

_YEAR_TREND = """
SELECT year, CAST(COUNT(anime_id) AS BIGINT) AS anime_count, CAST(COALESCE(SUM(members), 0) AS BIGINT) AS members,
       AVG(score) AS score
FROM {src} WHERE year IS NOT NULL GROUP BY year
"""
ORACLES["q_year_trend"] = PREFIX + _YEAR_TREND.format(src="filtered")
ORACLES["q_year_trend_dedup"] = PREFIX + _YEAR_TREND.format(
    src=f"(SELECT * FROM f_anime WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]})")

_DIM_METRICS = """,
m AS (
  SELECT d.{name}, COUNT(f.anime_id) AS anime_count, AVG(f.score) AS score, AVG(f.members) AS members
  FROM links_{kind} l JOIN d_{kind} d ON l.{id} = d.{id}
  JOIN (SELECT anime_id, score, members FROM filtered) f ON l.anime_id = f.anime_id
  WHERE d.{name} IS NOT NULL
  GROUP BY d.{name}
)
SELECT {name}, CAST(anime_count AS BIGINT) AS anime_count, score, members FROM m WHERE anime_count >= {support}
"""
ORACLES["q_dim_metrics_supplier"] = PREFIX + _DIM_METRICS.format(
    kind="studios", id="studio_id", name="studio_name", support=5)
ORACLES["q_dim_metrics_part"] = PREFIX + _DIM_METRICS.format(
    kind="producers", id="producer_id", name="producer_name", support=150)

ORACLES["q_dim_metrics_nation"] = PREFIX + """
SELECT licensor_name, CAST(COUNT(anime_id) AS BIGINT) AS anime_count, AVG(score) AS score, AVG(members) AS members
FROM filtered WHERE licensor_name IS NOT NULL GROUP BY licensor_name HAVING COUNT(anime_id) >= 5
"""

ORACLES["q_industry_avg"] = PREFIX + _DIM_METRICS.format(
    kind="studios", id="studio_id", name="studio_name", support=5).replace(
    "SELECT studio_name, CAST(anime_count AS BIGINT) AS anime_count, score, members FROM m WHERE anime_count >= 5",
    "SELECT ROUND(AVG(score), 6) AS industry_avg_score FROM m WHERE anime_count >= 5")

ORACLES["q_year_bounds"] = PREFIX + """
SELECT MIN(year) AS min_year, MAX(year) AS max_year FROM f_anime
"""

# -------------------------------------------------------------------- gold
ORACLES["q_dim_surrogate_status"] = PREFIX + "\nSELECT * FROM d_statuses\n"
ORACLES["q_dim_surrogate_type"] = PREFIX + "\nSELECT * FROM d_types\n"
ORACLES["q_dim_surrogate_source"] = PREFIX + "\nSELECT * FROM d_sources\n"

ORACLES["q_dim_natural"] = PREFIX + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'd_{k}' AS dim, CAST({p}_id AS BIGINT) AS x_id, {p}_name AS x_name FROM d_{k}"
    for k, p in [("producers", "producer"), ("licensors", "licensor"), ("studios", "studio"),
                 ("genres", "genre"), ("themes", "theme"), ("demographics", "demographic")]) + "\n"

ORACLES["q_link_sorted"] = PREFIX + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'links_{k}' AS link, anime_id, CAST({p}_id AS BIGINT) AS x_id FROM links_{k}"
    for k, p in [("producers", "producer"), ("licensors", "licensor"), ("studios", "studio"),
                 ("genres", "genre"), ("themes", "theme"), ("demographics", "demographic")]) + "\n"

ORACLES["q_fact"] = PREFIX + "\nSELECT * FROM f_anime\n"

ORACLES["q_fact_latest_batch"] = PREFIX + """,
anime_b AS (SELECT * REPLACE (year AS batch_id) FROM anime)
SELECT a.anime_id, a.title, a.title_english, a.no_of_episodes,
       a.minutes_expected AS duration_minutes_per_episode, a.score, a.scored_by, a.rank,
       a.popularity, a.members, a.favorites, a.year, ds.status_id, dt.type_id, dsrc.source_id
FROM anime_b a
LEFT JOIN d_statuses ds ON a.status = ds.status
LEFT JOIN d_types dt ON a.type = dt.type
LEFT JOIN d_sources dsrc ON a.source = dsrc.source
WHERE a.batch_id = (SELECT MAX(batch_id) FROM anime_b)
"""

ORACLES["q_star_select"] = PREFIX + """
SELECT f.*, CAST(l.genre_id AS DOUBLE) AS genre_id, g.genre_name
FROM f_anime f LEFT JOIN links_genres l ON f.anime_id = l.anime_id
LEFT JOIN d_genres g ON l.genre_id = g.genre_id
"""

ORACLES["q_duration_minutes"] = """
WITH p AS (SELECT p_partkey, p_size, p_type, p_size <= 25 AS small, CAST(ceil(p_size / 20) AS INTEGER) AS h FROM part)
SELECT p_partkey,
  CASE
    WHEN p_type = 'STANDARD' AND small THEN CAST(p_size AS VARCHAR) || ' min per ep'
    WHEN p_type = 'STANDARD' THEN CAST(h AS VARCHAR) || ' hr ' || CAST(p_size AS VARCHAR) || ' min per ep'
    WHEN p_type = 'LARGE' AND small THEN CAST(p_size AS VARCHAR) || ' min'
    WHEN p_type = 'LARGE' THEN CAST(p_size AS VARCHAR) || ' min ' || CAST(p_size AS VARCHAR) || ' sec'
    WHEN p_type = 'SMALL' AND small THEN CAST(h AS VARCHAR) || ' hr ' || CAST(p_size AS VARCHAR) || ' min '
                                         || CAST(p_size AS VARCHAR) || ' sec'
    WHEN p_type = 'SMALL' THEN CAST(p_size AS VARCHAR) || ' sec per ep'
    WHEN p_type = 'ECONOMY' THEN CAST(h AS VARCHAR) || ' hr'
    WHEN p_type = 'PROMO' THEN 'Unknown'
    ELSE CAST(p_size AS VARCHAR) || ' MIN' END AS duration,
  CASE
    WHEN p_type = 'STANDARD' AND small THEN CAST(p_size AS FLOAT)
    WHEN p_type = 'STANDARD' THEN CAST(h * 60 + p_size AS FLOAT)
    WHEN p_type = 'LARGE' THEN CAST(p_size AS FLOAT)
    WHEN p_type = 'SMALL' AND small THEN CAST(h * 60 + p_size AS FLOAT)
    WHEN p_type = 'SMALL' THEN CAST(CAST(p_size AS FLOAT) / 60.0 AS FLOAT)
    WHEN p_type = 'ECONOMY' THEN CAST(h * 60 AS FLOAT)
    ELSE CAST(NULL AS FLOAT) END AS minutes
FROM p
"""

# ------------------------------------------------------------ silver, json
PAGED = PREFIX + """,
ranked AS (SELECT a.* EXCLUDE (page), row_number() OVER (ORDER BY members DESC, anime_id) AS rn FROM anime a),
paged AS (SELECT r.*, CAST((rn - 1) // 25 + 1 AS INTEGER) AS page, CAST((rn - 1) % 25 AS INTEGER) AS rec_pos,
                 (SELECT COUNT(*) FROM links_anime_genres g WHERE g.anime_id = r.anime_id) AS n_genres
          FROM ranked r)"""

ORACLES["q_json_page_unpack"] = PAGED + """
SELECT page, rec_pos, CAST(anime_id AS INTEGER) AS anime_id, title, type, source, status, duration,
       CAST(score AS FLOAT) AS score, CAST(members AS INTEGER) AS members, year,
       CAST(n_genres AS INTEGER) AS n_genres
FROM paged
"""

ORACLES["q_struct_array_links"] = PREFIX + """
SELECT CAST(anime_id AS INTEGER) AS anime_id, genre_id, genre_name FROM links_anime_genres
WHERE genre_name <> 'Brand#1'
"""

ORACLES["q_event_props"] = """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
"""

ORACLES["q_discovered_fields"] = """
WITH f AS (SELECT event_type, props, unnest(json_keys(props)) AS field FROM events),
t AS (SELECT event_type, field, json_type(props, '$.' || field) AS type FROM f)
SELECT event_type, field, COUNT(*) AS n_present, COUNT(*) FILTER (WHERE type = 'NULL') AS n_null,
       CASE WHEN bool_and(type IN ('UBIGINT', 'BIGINT')) FILTER (WHERE type <> 'NULL') THEN 'BIGINT'
            WHEN bool_and(type = 'VARCHAR') FILTER (WHERE type <> 'NULL') THEN 'STRING' END AS type
FROM t GROUP BY event_type, field
"""

ORACLES["q_keep_last"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1
"""

ORACLES["q_pipeline_end_to_end"] = PREFIX + """
SELECT CAST(a.anime_id AS INTEGER) AS anime_id, a.title, a.title_english, a.no_of_episodes,
       a.minutes_expected AS duration_minutes_per_episode, CAST(a.score AS FLOAT) AS score, a.scored_by, a.rank,
       a.popularity, CAST(a.members AS INTEGER) AS members, a.favorites, a.year,
       ds.status_id, dt.type_id, dsrc.source_id
FROM anime a
LEFT JOIN d_statuses ds ON a.status = ds.status
LEFT JOIN d_types dt ON a.type = dt.type
LEFT JOIN d_sources dsrc ON a.source = dsrc.source
"""

ORACLES["q_silver_links_from_pages"] = PREFIX + """
SELECT CAST(anime_id AS INTEGER) AS anime_id, genre_id, genre_name FROM links_anime_genres
"""

# ------------------------------------------------------------------ upsert
_UPSERT = """
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01'),
source AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT t.* FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT * FROM source
"""
ORACLES["q_upsert"] = _UPSERT
ORACLES["q_upsert_twice"] = _UPSERT

# ------------------------------------------------------------------ bronze
_EV = """
WITH ev AS (SELECT *, CAST(dayofmonth(ts) AS INTEGER) AS batch_id FROM events),
loaded AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-15')"""

ORACLES["q_missing_batches"] = _EV + """
SELECT DISTINCT batch_id FROM ev WHERE batch_id NOT IN (SELECT batch_id FROM loaded)
"""

ORACLES["q_incremental_rows"] = _EV + """
SELECT event_id, batch_id FROM ev WHERE batch_id NOT IN (SELECT batch_id FROM loaded)
"""

ORACLES["q_next_batch"] = _EV + """
SELECT CAST(COALESCE(MAX(batch_id), 0) + 1 AS INTEGER) AS next_batch_id FROM ev
"""

ORACLES["q_sequence_id"] = _EV + """,
kept AS (SELECT event_id, batch_id FROM loaded
         UNION ALL SELECT event_id, batch_id FROM ev WHERE batch_id NOT IN (SELECT batch_id FROM loaded))
SELECT event_id, batch_id, CAST(row_number() OVER (ORDER BY batch_id, event_id) AS BIGINT) AS id FROM kept
"""

ORACLES["q_paginate"] = PREFIX + """,
ranked AS (SELECT anime_id, members, CAST(row_number() OVER (ORDER BY members DESC, anime_id) AS BIGINT) AS rn FROM anime)
SELECT anime_id, members, rn, CAST((rn - 1) // 25 + 1 AS INTEGER) AS page, CAST((rn - 1) % 25 AS INTEGER) AS rec_pos
FROM ranked
"""

ORACLES["q_page_files"] = PAGED + """,
numbered AS (
  SELECT page, CAST(page % 4 + 1 AS INTEGER) AS batch_id,
         row_number() OVER (ORDER BY (page % 4 + 1) % 2, page % 4, page) AS raw_id
  FROM (SELECT DISTINCT page FROM paged))
SELECT CAST(n.raw_id AS BIGINT) AS raw_id, n.batch_id, p.page, rec_pos, CAST(anime_id AS INTEGER) AS anime_id,
       CAST(members AS INTEGER) AS members
FROM paged p JOIN numbered n ON p.page = n.page
"""

_PROBE = PAGED + """,
probe AS (
  SELECT page, CAST(COUNT(*) AS INTEGER) AS n_records,
         arg_max(title, rec_pos) AS last_title, CAST(arg_max(members, rec_pos) AS INTEGER) AS last_members
  FROM paged GROUP BY page)"""

ORACLES["q_page_probe"] = _PROBE + """
SELECT * FROM probe
"""

ORACLES["q_take_while_pages"] = _PROBE + """,
bad AS (SELECT MIN(page) AS first_bad FROM probe WHERE last_members < 20000000)
SELECT page, n_records, last_members FROM probe
WHERE (SELECT first_bad FROM bad) IS NULL OR page < (SELECT first_bad FROM bad)
"""

# ------------------------------------------------------------------ checks
ORACLES["q_dq_not_null"] = """
SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'
"""

ORACLES["q_dq_unique"] = """
SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS n_rows FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey HAVING COUNT(*) > 1
"""

ORACLES["q_dq_composite"] = """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
"""

_SOURCE_TESTS = [("anime", "anime_id", "unique"), ("anime", "anime_id", "not_null")] + [
    (f"links_anime_{k}", c, "not_null")
    for k, p in [("producers", "producer"), ("licensors", "licensor"), ("studios", "studio"),
                 ("genres", "genre"), ("themes", "theme"), ("demographics", "demographic")]
    for c in ("anime_id", f"{p}_id")]


def _source_test_sql(table, column, kind):
    src = "lg_nulled" if table == "links_anime_genres" else table
    if kind == "unique":
        fails = (f"(SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {src} "
                 f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1))")
    else:
        fails = f"(SELECT COUNT(*) FROM {src} WHERE {column} IS NULL)"
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS test, "
            f"CAST({fails} AS BIGINT) AS failures")


ORACLES["q_dq_source_tests"] = PREFIX + """,
lg_nulled AS (SELECT anime_id, NULLIF(genre_id, 1) AS genre_id, genre_name FROM links_anime_genres)
""" + "\nUNION ALL\n".join(_source_test_sql(*t) for t in _SOURCE_TESTS) + "\n"

# ------------------------------------------------- names, batches, silver rules
ORACLES["q_name_numbers"] = """
SELECT event_id, CAST(dayofmonth(ts) AS INTEGER) AS batch_id, CAST(event_id AS INTEGER) AS page FROM events
"""

ORACLES["q_batch_scan"] = """
SELECT event_id AS id, CAST(dayofmonth(ts) AS INTEGER) AS batch_id, CAST(user_id AS INTEGER) AS page, props AS raw_json
FROM events WHERE dayofmonth(ts) = 9
"""

ORACLES["q_silver_keep_last"] = """
SELECT CAST(l_orderkey AS INTEGER) AS anime_id, 't' || MAX(l_linenumber) AS title,
       CASE WHEN MAX(l_linenumber) % 2 = 0 THEN 's' || MAX(l_linenumber) END AS source,
       COUNT(DISTINCT CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END) AS n_links
FROM lineitem GROUP BY l_orderkey
"""

ORACLES["q_upsert_links"] = """
WITH source AS (SELECT l_orderkey, l_linenumber, l_partkey, 'U' AS l_returnflag FROM lineitem WHERE l_suppkey % 2 = 0)
SELECT * FROM source
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem t
WHERE l_suppkey % 3 <> 0 AND NOT EXISTS (
  SELECT 1 FROM source s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
"""

ORACLES["q_kpi_labels"] = PREFIX + """
SELECT printf('%.2f', ROUND(AVG(score), 4)) AS avg_score_label,
       format('{:,}', CAST(COALESCE(SUM(members), 0) AS BIGINT)) AS total_members_label
FROM filtered
"""

ORACLES["q_dim_metrics_part_5"] = PREFIX + _DIM_METRICS.format(
    kind="producers", id="producer_id", name="producer_name", support=5)

ORACLES["q_category_share_zero_year"] = ORACLES["q_category_share_by_year"].replace(
    "(SELECT anime_id, year, members FROM filtered)",
    "(SELECT anime_id, year, CASE WHEN year = 1998 THEN 0 ELSE members END AS members FROM filtered)").replace(
    "/ CAST(SUM(members) OVER (PARTITION BY year) AS DOUBLE)",
    "/ NULLIF(CAST(SUM(members) OVER (PARTITION BY year) AS DOUBLE), 0)")
