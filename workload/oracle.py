"""The same results in SQL, for the check against another engine.

``VIEWS`` defines the season tables as common table expressions, in order of
dependency; a query names what it reads and gets those it depends on.  The SQL
says what a result is, not how the Spark side computes it: forward fill is an
as-of join, a running repair a correlated window, the cutoff a literal.
"""

from __future__ import annotations

import re

_STAMP = "TIMESTAMP '2024-01-01 00:00:00'"
_CUTOFF = "TIMESTAMP '1998-06-01 00:00:00'"

VIEWS: dict[str, str] = {
    "per_race": """
        SELECT CAST(l_suppkey AS INTEGER) AS driver_number, CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS meeting_key,
               sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS pts,
               sum(CASE WHEN l_tax >= 0.06 THEN l_quantity ELSE 0 END) AS pen
        FROM lineitem GROUP BY 1, 2, 3""",
    "raw_results": """
        SELECT *, sum(pts) OVER (PARTITION BY driver_number, year ORDER BY meeting_key
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp
        FROM per_race""",
    "driver_records": """
        SELECT CASE WHEN pts IS NOT NULL THEN (CAST(cp AS BIGINT) * 7 + driver_number) % 20 + 1 END AS position_current,
               CASE WHEN cp - pen * 0.5 > 0 THEN cp - pen * 0.5 ELSE 0 END AS points_current,
               driver_number, meeting_key * 10 + 1 AS session_key, meeting_key, year
        FROM raw_results""",
    "meetings": """
        SELECT CAST(year * 100 + month AS BIGINT) AS meeting_key, CAST(month AS BIGINT) AS circuit_key,
               CASE WHEN month % 3 = 0 THEN monthname(first) || ' Cup ' || year
                    ELSE monthname(first) || ' Prix' END AS meeting_name,
               dayname(first) AS location, monthname(first) AS country_name,
               upper(substr(monthname(first), 1, 3)) AS country_code,
               dayname(first) || ' Ring' AS circuit_short_name,
               CAST(first AS TIMESTAMP) AS date_start, CAST(year AS INTEGER) AS year, month
        FROM (SELECT DISTINCT year(l_shipdate) AS year, month(l_shipdate) AS month,
                     make_date(year(l_shipdate), month(l_shipdate), 1) AS first FROM lineitem)""",
    "folders": """
        SELECT meeting_key, lpad(CAST(month AS VARCHAR), 2, '0') || '_' || replace(meeting_name, ' ', '_') AS race_folder
        FROM meetings""",
    "roster_records": """
        SELECT driver_number, CASE WHEN s_acctbal >= 0 THEN s_name END AS full_name,
               right(s_name, 3) AS name_acronym,
               'Team ' || CASE WHEN s_acctbal >= 9000 AND meeting_key % 100 >= 7 THEN r_name ELSE n_name END
                       || CASE WHEN n_regionkey = 2 AND meeting_key % 100 >= 7 THEN ' ' ELSE '' END AS team_name,
               substr(n_name, 1, 3) AS country_code,
               CASE WHEN s_acctbal >= 3000 THEN 'http://img/' || driver_number
                    WHEN s_acctbal >= 1500 THEN '' END AS headshot_url,
               CASE n_regionkey WHEN 0 THEN NULL WHEN 1 THEN ''
                    ELSE lpad(CAST(s_nationkey AS VARCHAR), 6, '0') END AS team_colour,
               meeting_key, year, pts, pen
        FROM raw_results JOIN supplier ON s_suppkey = driver_number
        JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "listed": "SELECT CAST(s_suppkey AS INTEGER) AS driver_number FROM supplier WHERE s_acctbal >= -500",
    "team_per_race": """
        SELECT team_name, year, meeting_key, sum(pts) AS pts, sum(pen) AS pen
        FROM roster_records GROUP BY ALL""",
    "team_records": """
        SELECT meeting_key, team_name,
               CASE WHEN pts IS NOT NULL THEN (CAST(cp AS BIGINT) * 3 + length(team_name)) % 10 + 1 END AS position_current,
               CASE WHEN cp - pen * 0.5 > 0 THEN cp - pen * 0.5 ELSE 0 END AS points_current, year
        FROM (SELECT *, sum(pts) OVER (PARTITION BY team_name, year ORDER BY meeting_key
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp
              FROM team_per_race)""",
    "session_records": """
        SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS meeting_key, o_orderkey AS session_key,
               CASE o_orderstatus WHEN 'F' THEN 'Race' WHEN 'O' THEN 'Sprint' END AS session_name,
               CASE WHEN o_orderstatus = 'F' THEN 'Race' ELSE 'Other' END AS session_type,
               o_orderdate AS session_start
        FROM orders""",
    "standings": f"""
        SELECT CAST(position_current AS INTEGER) AS position, CAST(points_current AS REAL) AS points,
               CAST(driver_number AS INTEGER) AS driver_number, session_key, meeting_key,
               race_folder AS race_folder_name, year, {_STAMP} AS ingestion_date
        FROM driver_records JOIN folders USING (meeting_key)
        WHERE position_current IS NOT NULL""",
    "team_standings": f"""
        SELECT meeting_key, team_name, CAST(position_current AS INTEGER) AS position,
               CAST(points_current AS REAL) AS points, year, {_STAMP} AS ingestion_date
        FROM team_records WHERE position_current IS NOT NULL""",
    "calendar": """
        SELECT meeting_key, circuit_key, meeting_name AS gp_name, location AS city, country_name AS country,
               country_code AS gp_code, circuit_short_name AS circuit, date_start, year
        FROM meetings""",
    "roster": f"""
        SELECT CAST(driver_number AS INTEGER) AS driver_number, full_name, name_acronym, team_name, country_code, year,
               CASE WHEN coalesce(headshot_url, '') = '' THEN 'assets/portrait.png' ELSE headshot_url END AS headshot_url,
               CASE WHEN coalesce(team_colour, '') = '' THEN '#999999' ELSE '#' || team_colour END AS team_colour,
               {_STAMP} AS ingestion_date, race_folder AS race_folder_name
        FROM roster_records JOIN folders USING (meeting_key)""",
    "entrants": """
        SELECT * EXCLUDE (race_folder_name) FROM roster
        QUALIFY row_number() OVER (PARTITION BY driver_number, year
                                   ORDER BY race_folder_name DESC, team_name, full_name, name_acronym,
                                            country_code, headshot_url, team_colour) = 1""",
    "known_entrants": "SELECT * FROM entrants WHERE driver_number IN (SELECT driver_number FROM listed)",
    "teams": f"""
        SELECT DISTINCT team_name, year, 'assets/teams/' || replace(team_name, ' ', '%20') || '.png' AS team_logo_url,
               {_STAMP} AS last_updated
        FROM team_standings""",
    "dated": """
        SELECT driver_number, s.year, s.meeting_key, position, date_start
        FROM standings s JOIN calendar c USING (meeting_key)""",
    "named": """
        SELECT full_name, d.year, d.driver_number, meeting_key, date_start, position AS rank_in_race
        FROM dated d JOIN entrants e ON e.driver_number = d.driver_number AND e.year = d.year""",
    "final_ranks": """
        SELECT full_name, year, rank_in_race AS Final_Season_Rank FROM named WHERE full_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY full_name, year
                                   ORDER BY date_start DESC, meeting_key DESC, driver_number, rank_in_race) = 1""",
    "dim_driver": """
        SELECT CASE WHEN driver_number >= 10000 THEN -(CAST(driver_number AS BIGINT) * 10000 + e.year) ELSE e.year * 10000 + CAST(driver_number AS BIGINT) END AS Driver_Key, driver_number AS Number, e.year AS Year,
               e.full_name AS Driver, headshot_url AS Driver_Photo, country_code AS Driver_Country,
               Final_Season_Rank AS Season_Rank_Sort
        FROM entrants e LEFT JOIN final_ranks r ON r.full_name = e.full_name AND r.year = e.year
        QUALIFY row_number() OVER (PARTITION BY CASE WHEN driver_number >= 10000 THEN -(CAST(driver_number AS BIGINT) * 10000 + e.year) ELSE e.year * 10000 + CAST(driver_number AS BIGINT) END
                                   ORDER BY e.year, driver_number) = 1""",
    "team_colours": """
        SELECT trim(team_name) AS team, year, max(team_colour) AS Hex_Color
        FROM entrants WHERE team_name IS NOT NULL GROUP BY 1, 2""",
    "dim_team": """
        SELECT trim(team_name) || '-' || t.year AS Team_Key, trim(team_name) AS Team, t.year AS Year,
               team_logo_url AS Team_Logo, coalesce(Hex_Color, '#999999') AS Hex_Color
        FROM teams t LEFT JOIN team_colours c ON c.team = trim(team_name) AND c.year = t.year
        QUALIFY row_number() OVER (PARTITION BY trim(team_name), t.year ORDER BY team_name) = 1""",
    "dim_race": """
        SELECT meeting_key AS Race_Key, year AS Year, gp_name AS Grand_Prix, circuit AS Circuit_Name,
               upper(substr(CASE WHEN (SELECT count(DISTINCT o.gp_name) FROM calendar o
                                       WHERE upper(substr(o.gp_name, 1, 3)) = upper(substr(c.gp_name, 1, 3))) > 1
                                 THEN circuit ELSE gp_name END, 1, 3)) AS GP_Display,
               date_start AS Date
        FROM calendar c""",
    "timeline": "SELECT DISTINCT date_start AS Date, CAST(meeting_key AS INTEGER) AS Race_Key FROM calendar",
    "driver_series": """
        SELECT driver_number, s.year, s.meeting_key, date_start, points, position,
               coalesce(lag(points) OVER (PARTITION BY driver_number, s.year ORDER BY date_start), 0) AS prev_points
        FROM standings s JOIN calendar c USING (meeting_key)""",
    "fact_driver": """
        SELECT CASE WHEN d.driver_number >= 10000 THEN -(CAST(d.driver_number AS BIGINT) * 10000 + d.year) ELSE d.year * 10000 + CAST(d.driver_number AS BIGINT) END AS Driver_Key,
               trim(team_name) || '-' || d.year AS Team_Key, meeting_key AS Race_Key,
               CAST(greatest(points - prev_points, 0) AS REAL) AS Race_Points,
               points AS Season_Points, position AS World_Position
        FROM driver_series d LEFT JOIN known_entrants e ON e.driver_number = d.driver_number AND e.year = d.year""",
    "fact_driver_at_race": """
        SELECT CASE WHEN d.driver_number >= 10000 THEN -(CAST(d.driver_number AS BIGINT) * 10000 + d.year) ELSE d.year * 10000 + CAST(d.driver_number AS BIGINT) END AS Driver_Key,
               trim(team_name) || '-' || d.year AS Team_Key, d.meeting_key AS Race_Key,
               CAST(greatest(points - prev_points, 0) AS REAL) AS Race_Points,
               points AS Season_Points, position AS World_Position
        FROM driver_series d LEFT JOIN roster_records r
          ON r.driver_number = d.driver_number AND r.meeting_key = d.meeting_key
         AND r.driver_number IN (SELECT driver_number FROM listed)""",
    "team_series": """
        SELECT *, row_number() OVER (PARTITION BY team_name, year
                                     ORDER BY date_start, points NULLS FIRST, position) AS step
        FROM (SELECT trim(team_name) AS team_name, s.year, meeting_key, date_start, points, position
              FROM team_standings s JOIN calendar c USING (meeting_key))""",
    "team_fixed": """
        SELECT a.team_name, a.year, a.meeting_key, a.date_start, a.points, a.position, a.step,
               max(b.points) AS fixed_points
        FROM team_series a JOIN team_series b
          ON b.team_name = a.team_name AND b.year = a.year AND b.step <= a.step
        GROUP BY ALL""",
    "team_lagged": """
        SELECT a.*, coalesce(b.fixed_points, 0) AS prev_points
        FROM team_fixed a LEFT JOIN team_fixed b
          ON b.team_name = a.team_name AND b.year = a.year AND b.step = a.step - 1""",
    "fact_team": """
        SELECT team_name || '-' || year AS Team_Key, meeting_key AS Race_Key,
               CAST(greatest(fixed_points - prev_points, 0) AS REAL) AS Race_Points,
               fixed_points AS Season_Points, position AS World_Position
        FROM team_lagged""",
    "driver_star": "SELECT f.*, r.* EXCLUDE (Race_Key) FROM fact_driver f LEFT JOIN dim_race r USING (Race_Key)",
    "team_star": "SELECT f.*, r.* EXCLUDE (Race_Key) FROM fact_team f LEFT JOIN dim_race r USING (Race_Key)",
    "full_driver_star": """
        SELECT s.*, Team, Team_Logo, Hex_Color, Number, Driver, Driver_Photo, Driver_Country, Season_Rank_Sort
        FROM driver_star s LEFT JOIN dim_team t ON t.Team_Key = s.Team_Key
        LEFT JOIN dim_driver d ON d.Driver_Key = s.Driver_Key""",
    "full_team_star": """
        SELECT s.*, Team, Team_Logo, Hex_Color
        FROM team_star s LEFT JOIN dim_team t ON t.Team_Key = s.Team_Key""",
    "team_daily": """
        SELECT Team_Key, Year, Date, max(World_Position) AS rank, max(Season_Points) AS points
        FROM team_star GROUP BY 1, 2, 3""",
}


def given(select: str) -> str:
    """``select`` behind the common table expressions it needs."""
    needed: set[str] = set()
    text = select
    for name in reversed(VIEWS):
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
            needed.add(name)
            text += f" {VIEWS[name]}"
    parts = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    return f"WITH {', '.join(parts)} {select}" if parts else select


_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
_YEAR = "CAST(year(o_orderdate) AS INTEGER)"
_FOLDER = "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '_Round ' || month(o_orderdate)"

_MEETINGS = """
    SELECT meeting_key, circuit_key, meeting_name AS gp_name, location AS city, country_name AS country,
           country_code AS gp_code, circuit_short_name AS circuit, date_start, year,
           {stamp} AS ingestion_date FROM meetings"""

_POINTS_TEXT = """CASE WHEN {x} > 0 THEN regexp_replace(printf('%.2f', {x}), '\\.?0+$', '')
                       WHEN {x} < 0 THEN '' WHEN {x} = 0 THEN '-' END"""


def _display() -> str:
    signed = "(CASE WHEN World_Position = 1 THEN -Race_Points ELSE Race_Points END)"
    return f"""
        SELECT Driver_Key, Race_Key, strftime(Date, '%d/%m/%Y') AS shown_date,
               {_POINTS_TEXT.format(x=signed)} AS shown_points,
               ' ' || regexp_replace(printf('%.6f', Season_Points), '\\.?0+$', '') AS shown_total
        FROM driver_star"""


_BOTH_FACTS = """
        SELECT CAST(Driver_Key AS VARCHAR) AS entity, * EXCLUDE (Driver_Key) FROM fact_driver
        UNION ALL BY NAME SELECT 'team' AS entity, * FROM fact_team"""

# Points of a team on every race day since its first.
_RUNNING = """
        SELECT s.Team_Key, r.Date, CAST(max(s.Season_Points) AS DOUBLE) AS Team_Points
        FROM dim_race r JOIN team_star s ON s.Date <= r.Date GROUP BY 1, 2"""

_RESULTS = "SELECT CAST(Race_Key // 100 AS INTEGER) AS year, count(*) AS results FROM fact_driver GROUP BY 1"


def _watch_counts() -> str:
    """Rows of every watched table, repeated keys of dimensions, keys of facts that no dimension row has."""
    # the landed rosters are those of the listed entrants
    listed = "dim_driver WHERE Number IN (SELECT driver_number FROM listed)"
    dimensions = {"dim_driver": "Driver_Key", "dim_team": "Team_Key", "dim_race": "Race_Key"}
    facts = {"fact_driver": dimensions, "fact_team": {k: v for k, v in dimensions.items() if k != "dim_driver"}}
    counts = []
    for table, key in dimensions.items():
        rows = listed if table == "dim_driver" else table
        counts.append(f"SELECT '{table}' AS table_name, 'rows' AS counted, count(*) AS n FROM {rows}")
        counts.append(f"SELECT '{table}', 'duplicate_keys', count(*) - count(DISTINCT {key}) FROM {rows}")
    for table, used in facts.items():
        counts.append(f"SELECT '{table}_results', 'rows', count(*) FROM {table}")
        for dimension, key in used.items():
            of = f"{listed} AND" if dimension == "dim_driver" else f"{dimension} WHERE"
            known = f"SELECT {key} FROM {of} {key} IS NOT NULL"
            counts.append(f"SELECT '{table}_results', 'orphans_{key}', count(*) FROM {table} WHERE {key} NOT IN ({known})")
    return " UNION ALL ".join(counts)


_QUERIES: dict[str, str] = {
    # scans and sinks
    "scan_json_glob": f"SELECT {_ORDERS} FROM orders",
    "scan_json_array": f"""
        SELECT {_ORDERS} FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, 'twin', o_totalprice / 2 FROM orders""",
    "scan_path_columns": f"SELECT o_orderkey, {_FOLDER} AS race_folder_name, {_YEAR} AS year FROM orders",
    "scan_path_regex_year": f"SELECT o_orderkey, {_YEAR} AS year FROM orders",
    "scan_json_permissive": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
               CAST(NULL AS DOUBLE) AS o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN '{"o_orderkey":' || o_orderkey || ',"o_cust' END AS rejected_text
        FROM orders""",
    "scan_quarantine": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS o_orderkey,
               CASE o_orderstatus WHEN 'P' THEN 'malformed' WHEN 'O' THEN 'error payload' END AS reason,
               CASE o_orderstatus WHEN 'P' THEN '{"o_orderkey":' || o_orderkey || ',"o_cust'
                                  WHEN 'O' THEN 'no order ' || o_orderkey END AS payload
        FROM orders""",
    "scan_rescued_fields": f"""
        SELECT o_orderkey, {_YEAR} AS year,
               CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END AS unknown_fields,
               nullif(o_orderstatus, 'O') AS status,
               CASE WHEN o_orderstatus = 'F' THEN '{{"key":' || o_custkey || '}}' END AS customer
        FROM orders""",
    "scan_table": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "scan_catalog_table": f"SELECT o_orderkey, o_totalprice, {_YEAR} AS year FROM orders",
    "scan_season_pruned": f"""
        SELECT o_orderkey, o_totalprice, {_YEAR} AS year FROM orders WHERE year(o_orderdate) = 1997""",
    "scan_gold_star": """
        SELECT Year, Team, count(*) AS result_rows, max(World_Position) AS worst_position
        FROM full_team_star GROUP BY Year, Team""",
    "sink_partitioned": f"SELECT {_ORDERS}, {_YEAR} AS year FROM orders",
    "sink_dynamic_overwrite": f"""
        SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               {_YEAR} AS year FROM orders""",
    "sink_merge_schema": f"""
        SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END AS o_orderstatus,
               {_YEAR} AS year FROM orders""",
    "sink_full_overwrite": f"SELECT {_ORDERS} FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "sink_landing_replace": f"""
        SELECT {_ORDERS}, {_FOLDER} AS race_folder_name, 1997 AS year FROM orders
        WHERE o_orderstatus = 'F' AND month(o_orderdate) < 7""",
    "union_seasons": f"""
        SELECT {_YEAR} AS year, count(*) AS orders, max(o_custkey) AS top_customer FROM orders GROUP BY 1""",
    "sort_before_write": "SELECT year, meeting_key, gp_name, date_start FROM calendar",
    "silver_driver_standings": "SELECT * FROM standings",
    "silver_team_standings": "SELECT * FROM team_standings",
    "silver_calendar": _MEETINGS.format(stamp=_STAMP),
    "silver_entrants": "SELECT * FROM entrants",
    "silver_teams": "SELECT * FROM teams",
    "incremental_season_load": _BOTH_FACTS,
    "season_reload_failed": _BOTH_FACTS,
    "season_switch": _BOTH_FACTS,
    "schema_growth_load": f"""
        SELECT year, count(*) AS standings, count(*) FILTER (laps = -1) AS unknown,
               CAST(sum(laps) FILTER (laps >= 0) AS BIGINT) AS laps, results
        FROM (SELECT year, CASE WHEN year >= 1997 AND driver_number % 3 > 0 THEN driver_number % 50 ELSE -1 END AS laps
              FROM standings)
        LEFT JOIN ({_RESULTS}) USING (year) GROUP BY year, results""",
    "load_watch_counts": _watch_counts(),
    "catalog_driven_load": f"""
        SELECT c.year, count(*) AS rounds, max(folder) AS last_folder, results,
               CASE WHEN c.year = 1994 THEN 2 ELSE 1 END AS loaded_by
        FROM (SELECT year, lpad(CAST(row_number() OVER (PARTITION BY year ORDER BY date_start) AS VARCHAR), 2, '0')
                           || '_' || replace(meeting_name, ' ', '_') AS folder
              FROM meetings WHERE meeting_key IN (SELECT meeting_key FROM session_records)) c
        JOIN ({_RESULTS}) f ON f.year = c.year GROUP BY c.year, results""",
    "load_team_at_race": "SELECT * FROM fact_driver_at_race",
    # projections and filters
    "project_typed": """
        SELECT CAST(c_custkey AS INTEGER) AS number, CAST(c_acctbal AS REAL) AS balance,
               CAST(substr(c_name, 10) AS BIGINT) AS number_in_name, CAST(c_nationkey AS VARCHAR) AS nation
        FROM customer""",
    "project_join_aliases": """
        SELECT team_name, t.year, team_logo_url, coalesce(Hex_Color, '#999999') AS Hex_Color
        FROM teams t LEFT JOIN team_colours c ON c.team = trim(team_name) AND c.year = t.year""",
    "project_derived": """
        SELECT p_partkey, p_name, p_type, p_size, upper(left(p_name, 3)) AS code, 2 * p_size AS double_size,
               p_type || '-' || p_size AS label FROM part""",
    "project_rename": "SELECT date_start AS Date, CAST(meeting_key AS INTEGER) AS Race_Key FROM calendar",
    "filter_na_drop": """
        SELECT driver_number, meeting_key, position_current AS position FROM driver_records
        WHERE position_current IS NOT NULL AND driver_number IS NOT NULL""",
    "filter_not_contains": """
        SELECT p_partkey, p_name AS name FROM part WHERE p_size > 1 AND p_name NOT LIKE '%ring%'""",
    "filter_not_null": """
        SELECT driver_number, meeting_key, full_name FROM roster_records WHERE full_name IS NOT NULL""",
    "filter_isin": """
        SELECT meeting_key, session_key, session_name FROM session_records
        WHERE session_name IN ('Race', 'Sprint') AND session_key <> 0""",
    "filter_pushdown_eq": """
        SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'""",
    "default_if_blank": """
        SELECT driver_number, meeting_key, coalesce(nullif(headshot_url, ''), 'assets/portrait.png') AS photo,
               coalesce('#' || nullif(team_colour, ''), '#999999') AS colour FROM roster_records""",
    # joins
    "join_inner": "SELECT * FROM dated",
    "join_inner_composite": "SELECT * FROM named",
    "join_left_selfderived": """
        SELECT e.driver_number, e.year, e.full_name, Final_Season_Rank
        FROM entrants e LEFT JOIN final_ranks r ON r.full_name = e.full_name AND r.year = e.year""",
    "join_left_composite": """
        SELECT team_name, t.year, coalesce(Hex_Color, '#999999') AS Hex_Color
        FROM teams t LEFT JOIN team_colours c ON c.team = trim(team_name) AND c.year = t.year""",
    "join_chain_inner_left": """
        SELECT s.meeting_key, s.driver_number, s.year, s.points, s.position, date_start, full_name, team_name
        FROM standings s JOIN calendar c ON c.meeting_key = s.meeting_key
        LEFT JOIN entrants e ON e.driver_number = s.driver_number AND e.year = s.year""",
    "join_inner_default": """
        SELECT s.meeting_key, trim(team_name) AS team_name, position, points, s.year, date_start
        FROM team_standings s JOIN calendar c ON c.meeting_key = s.meeting_key""",
    "join_star_driver": "SELECT * FROM full_driver_star",
    "join_star_bucketed": """
        SELECT f.Driver_Key, Driver, CAST(Race_Key // 100 AS INTEGER) AS season, count(*) AS results, max(Season_Points) AS points
        FROM fact_driver f LEFT JOIN dim_driver d ON d.Driver_Key = f.Driver_Key GROUP BY 1, 2, 3""",
    "join_star_team": "SELECT * FROM full_team_star",
    "join_star_timeline": """
        SELECT CAST(t.Race_Key AS BIGINT) AS Race_Key, t.Date, Year, Grand_Prix, Circuit_Name, GP_Display
        FROM timeline t LEFT JOIN dim_race r ON r.Race_Key = t.Race_Key""",
    "join_asof_rank": """
        SELECT g.driver_number, g.year AS Year, g.meeting_key AS Race_Key, g.date_start AS Date,
               d.position AS last_position
        FROM (SELECT driver_number, c.year, meeting_key, date_start
              FROM (SELECT DISTINCT driver_number, year FROM standings) e JOIN calendar c ON c.year = e.year) g
        ASOF LEFT JOIN dated d
          ON d.driver_number = g.driver_number AND d.year = g.year AND d.date_start <= g.date_start""",
    # aggregates
    "agg_max_ts": """
        SELECT team_name, year, max(CAST(make_date(meeting_key // 100, meeting_key % 100, 1) AS TIMESTAMP)) AS last_updated
        FROM team_standings GROUP BY 1, 2""",
    "agg_max_string": "SELECT * FROM team_colours",
    "agg_max_multi": """
        SELECT driver_number, year, meeting_key, points, position + 1 AS position FROM standings""",
    "dedup_by_key": "SELECT * EXCLUDE (ingestion_date) FROM entrants",
    "distinct_rows": "SELECT driver_number, year, team_name FROM roster_records GROUP BY ALL",
    "distinct_count_window": """
        WITH names AS (SELECT p_partkey AS id, p_name AS gp_name FROM part
                       UNION ALL SELECT CAST(-r_regionkey - 1 AS BIGINT), r_name FROM region),
             coded AS (SELECT *, upper(substr(gp_name, 1, 3)) AS Default_Code FROM names)
        SELECT id, gp_name, Default_Code, CAST(n AS INTEGER) AS Distinct_GPs
        FROM coded JOIN (SELECT Default_Code, count(DISTINCT gp_name) AS n FROM coded GROUP BY 1) USING (Default_Code)""",
    "measure_max": """
        SELECT Year, CAST(max(Season_Points) AS DOUBLE) AS max_points, max(World_Position) AS max_position,
               max(Race_Key) AS max_race, max(Date) AS max_date, max(Team_Logo) AS max_logo
        FROM full_team_star GROUP BY Year""",
    "implicit_sum_race_points": """
        SELECT Year, Team, sum(CAST(Race_Points AS DOUBLE)) AS Race_Points FROM full_team_star GROUP BY 1, 2""",
    "implicit_max_season_points": """
        SELECT Year, GP_Display, CAST(max(Season_Points) AS DOUBLE) AS Season_Points FROM driver_star GROUP BY 1, 2""",
    "agg_last_nonblank": """
        SELECT Driver_Key, arg_max(World_Position, Date) FILTER (WHERE Race_Points > 0) AS last_scored_position
        FROM driver_star GROUP BY 1""",
    "agg_selected_value": """
        SELECT driver_number, year, CASE WHEN count(DISTINCT team_name) = 1 THEN any_value(team_name) END AS only_team
        FROM roster_records GROUP BY 1, 2""",
    # windows
    "window_row_number_latest": "SELECT * FROM final_ranks",
    "top1_per_group": """
        SELECT DISTINCT ON (year, meeting_key) year, meeting_key, driver_number, points
        FROM standings ORDER BY year, meeting_key, points DESC, driver_number""",
    "window_lag_default": "SELECT * FROM driver_series",
    "window_running_max": "SELECT * EXCLUDE (step) FROM team_fixed",
    "window_lag_of_running_max": "SELECT * EXCLUDE (step) FROM team_lagged",
    "delta_clamped": """
        SELECT driver_number, year, meeting_key, points,
               CAST(CASE WHEN points > prev_points THEN points - prev_points ELSE 0 END AS REAL) AS race_points
        FROM driver_series""",
    "window_ffill_rank": """
        SELECT Team_Key, Year, Race_Key, Date, Team_Ranks FROM (
            SELECT k.Team_Key, r.Year, r.Race_Key, r.Date,
                   last_value(d.rank IGNORE NULLS) OVER (PARTITION BY k.Team_Key, r.Year ORDER BY r.Date
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Team_Ranks
            FROM (SELECT DISTINCT Team_Key, Year FROM team_daily) k JOIN dim_race r ON r.Year = k.Year
            LEFT JOIN team_daily d ON d.Team_Key = k.Team_Key AND d.Year = r.Year AND d.Date = r.Date)
        WHERE Team_Ranks IS NOT NULL""",
    # scalar functions
    "fn_try_cast": """
        SELECT p_partkey, TRY_CAST(substr(p_brand, 7, 3) AS INTEGER) AS brand_number,
               TRY_CAST(p_name AS INTEGER) AS name_as_int, CAST(p_retailprice AS REAL) AS price,
               CASE WHEN p_size BETWEEN 1 AND 31
                    THEN CAST(make_date(2024, 1, 1) + CAST(p_size - 1 AS INTEGER) AS TIMESTAMP) END AS day
        FROM part""",
    "fn_split_element": """
        SELECT p_partkey, p_name AS folder, p_size AS season, CAST(NULL AS VARCHAR) AS beyond FROM part""",
    "fn_logo_url": """
        SELECT p_partkey, 'assets/teams/' || replace(p_name, ' ', '%20') || '.png' AS url FROM part""",
    "fn_concat_key": """
        SELECT driver_number, meeting_key, full_name || '-' || year AS name_key FROM roster_records""",
    "fn_code3": """
        SELECT p_partkey, upper(left(p_name, 3)) AS name_code, upper(left(p_type, 3)) AS type_code FROM part""",
    "fn_trim_key": """
        SELECT driver_number, meeting_key, team_name, year, trim(team_name) || '-' || year AS Team_Key
        FROM roster_records""",
    "fn_case_when": """
        SELECT c_custkey, greatest(CAST(c_acctbal - 1000 AS REAL), CAST(0 AS REAL)) AS gain,
               CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'low' END AS level
        FROM customer""",
    "fn_load_stamp": "SELECT team_name, meeting_key, ingestion_date FROM team_standings",
    "fn_driver_key": """
        SELECT driver_number, meeting_key, CASE WHEN driver_number >= 10000 THEN -(CAST(driver_number AS BIGINT) * 10000 + year) ELSE CAST(year AS BIGINT) * 10000 + driver_number END AS Driver_Key FROM standings""",
    "fn_coalesce_default": """
        SELECT session_key, coalesce(session_name, 'Unknown') AS session_name FROM session_records""",
    "fn_display_format": _display(),
    # data quality
    "dq_duplicate_keys": """
        SELECT trim(team_name) || '-' || year AS Team_Key, count(*) AS rows FROM teams GROUP BY 1 HAVING count(*) > 1""",
    "dq_orphan_keys": """
        SELECT team_name || '-' || year AS Team_Key, count(*) AS rows FROM team_standings
        WHERE team_name || '-' || year NOT IN (SELECT Team_Key FROM dim_team) GROUP BY 1""",
    # star
    "season_catalog": """
        SELECT year, CAST(row_number() OVER (PARTITION BY year ORDER BY date_start) AS INTEGER) AS round, meeting_key,
               session_key, meeting_name, date_start,
               lpad(CAST(row_number() OVER (PARTITION BY year ORDER BY date_start) AS VARCHAR), 2, '0')
                   || '_' || replace(meeting_name, ' ', '_') AS folder_name
        FROM meetings JOIN (
            SELECT meeting_key, session_key FROM session_records WHERE session_type = 'Race'
            QUALIFY row_number() OVER (PARTITION BY meeting_key ORDER BY session_start DESC, session_key DESC) = 1
        ) USING (meeting_key)
        WHERE meeting_name NOT LIKE '%Testing%' AND session_key <> 0""",
    "gold_dim_driver": "SELECT * FROM dim_driver",
    "gold_dim_team": "SELECT * FROM dim_team",
    "gold_dim_race": "SELECT * FROM dim_race",
    "gold_fact_driver": "SELECT * FROM fact_driver",
    "gold_fact_driver_team_at_race": "SELECT * FROM fact_driver_at_race",
    "gold_fact_team": "SELECT * FROM fact_team",
    "gold_fact_team_blocked": """
        SELECT * FROM fact_team UNION ALL BY NAME
        SELECT * REPLACE (CAST(0 AS REAL) AS Race_Points) FROM fact_team WHERE Race_Key % 3 = 0""",
    "timeline": "SELECT * FROM timeline",
    "order_gp_by_date": "SELECT GP_Display, min(Date) AS first_date FROM dim_race GROUP BY 1 ORDER BY 2, 1",
    "order_driver_by_rank": "SELECT * FROM dim_driver ORDER BY Season_Rank_Sort NULLS LAST, Driver_Key",
    "standings_by_round": """
        SELECT Year, Race_Key, Date, GP_Display, World_Position, Driver_Key, Driver, Team,
               CAST(Race_Points AS DOUBLE) AS Race_Points, CAST(Season_Points AS DOUBLE) AS Season_Points
        FROM full_driver_star ORDER BY Year, Date, World_Position, Driver_Key""",
    # measures
    "measure_points_as_of": f"""
        SELECT Team_Key, CAST(max(Season_Points) AS DOUBLE) AS Team_Points
        FROM team_star WHERE Date <= {_CUTOFF} GROUP BY 1""",
    "measure_points_by_race": f"""
        SELECT Team_Key, Year, GP_Display, CAST(max(Season_Points) AS DOUBLE) AS Team_Points
        FROM team_star WHERE Date <= {_CUTOFF} GROUP BY 1, 2, 3""",
    "measure_points_by_date": f"""
        SELECT s.Team_Key, r.Date, CAST(max(s.Season_Points) AS DOUBLE) AS Team_Points
        FROM dim_race r JOIN team_star s ON s.Date <= r.Date
        WHERE r.Date <= {_CUTOFF} GROUP BY 1, 2""",
    "measure_point_spans": f"""
        SELECT Team_Key, min(Date) AS since, lead(min(Date)) OVER (PARTITION BY Team_Key ORDER BY min(Date)) AS until, Team_Points
        FROM ({_RUNNING}) GROUP BY Team_Key, Team_Points""",
    "measure_points_on_dates": f"""
        SELECT p.* FROM ({_RUNNING}) p
        JOIN (SELECT min(Date) AS Date FROM dim_race GROUP BY date_trunc('quarter', Date)) q ON q.Date = p.Date""",
    "measure_team_ranks": f"""
        SELECT d.Team_Key, r.Year, r.Race_Key, r.Date, arg_max(d.rank, d.Date) AS Team_Ranks
        FROM dim_race r JOIN team_daily d ON d.Year = r.Year AND d.Date <= r.Date
        WHERE r.Date <= {_CUTOFF} GROUP BY 1, 2, 3, 4""",
    "measure_team_ranks_as_of": f"""
        SELECT Team_Key, arg_max(rank, Date) FILTER (WHERE Date <= {_CUTOFF}) AS Team_Ranks
        FROM team_daily WHERE Year = 1998 GROUP BY 1""",
    "measure_team_ranks_by_code": f"""
        SELECT Team, c.GP_Display, arg_max(s.rank, s.Date) AS Team_Ranks
        FROM (SELECT GP_Display, max(Date) AS cutoff FROM dim_race WHERE Date <= {_CUTOFF} GROUP BY 1) c
        JOIN (SELECT DISTINCT GP_Display, Year FROM dim_race) y ON y.GP_Display = c.GP_Display
        JOIN (SELECT Team, Year, Date, max(World_Position) AS rank FROM full_team_star GROUP BY 1, 2, 3) s
          ON s.Year = y.Year AND s.Date <= c.cutoff
        GROUP BY 1, 2""",
    "measure_driver_ranks": """
        SELECT Driver_Key, max(CASE WHEN Date = (SELECT max(Date) FROM dim_race WHERE Year = 1998)
                                    THEN World_Position END) AS Driver_Ranks
        FROM driver_star WHERE Year = 1998 GROUP BY 1""",
    "measure_driver_ranks_by_race": "SELECT Driver_Key, Race_Key, World_Position AS Driver_Ranks FROM fact_driver",
    "measure_driver_ranks_by_code": """
        SELECT Driver, GP_Display,
               max(World_Position) FILTER (WHERE Date = (SELECT max(r.Date) FROM dim_race r
                                                         WHERE r.GP_Display = s.GP_Display)) AS Driver_Ranks
        FROM full_driver_star s WHERE s.Driver_Key IN (SELECT Driver_Key FROM dim_driver) GROUP BY 1, 2""",
    "measure_actual_team_logo": f"""
        SELECT k.Driver_Key, Team_Logo AS Actual_Team_Logo
        FROM (SELECT Driver_Key, arg_max(coalesce(Team_Key, ''), r.Date) FILTER (WHERE r.Date <= {_CUTOFF}) AS Team_Key
              FROM fact_driver_at_race f JOIN dim_race r ON r.Race_Key = f.Race_Key WHERE r.Year = 1998 GROUP BY 1) k
        LEFT JOIN dim_team t ON t.Team_Key = k.Team_Key""",
    "measure_team_color": "SELECT Team, max(Hex_Color) AS Team_Color_Hex FROM dim_team GROUP BY 1",
    "measure_draw_team_points": f"""
        SELECT Team_Key, s.Year, s.GP_Display,
               CASE WHEN (SELECT max(Date) FROM dim_race r WHERE r.Year = s.Year AND r.GP_Display = s.GP_Display)
                         <= (SELECT max(Date) FROM timeline WHERE Date <= {_CUTOFF})
                    THEN CAST(max(Season_Points) AS DOUBLE) END AS Draw_Team_Points
        FROM team_star s GROUP BY 1, 2, 3""",
    "championship_state_at": f"""
        SELECT Team_Key, Year, CAST(max(points) FILTER (WHERE Date <= {_CUTOFF}) AS DOUBLE) AS Team_Points,
               arg_max(rank, Date) FILTER (WHERE Date <= {_CUTOFF}) AS Team_Ranks,
               CASE WHEN (SELECT max(Date) FROM dim_race r WHERE r.Year = d.Year) <= {_CUTOFF}
                    THEN CAST(max(points) AS DOUBLE) END AS Draw_Team_Points
        FROM team_daily d GROUP BY 1, 2""",
}


def statements() -> dict[str, str]:
    return {name: given(select) for name, select in _QUERIES.items()}
