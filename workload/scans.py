"""Scans, sinks and loads: land or write whole tables, then read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasongrid.functions.cast import to_type
from seasongrid.functions.text import folder_from_path, season_from_path
from seasongrid.operators.quality import Limits, LoadRejected
from seasongrid.plans import gold, job, silver
from seasongrid.schemas import CORRUPT, Added, Schemas
from seasongrid.session import fresh_dir
from seasongrid.sources import landing, sinks
from seasongrid.sources.tables import create_tables, read_table, register_star
from workload.registry import query
from workload.standins import ASSETS, Standins, loaded_at

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)
ORDER_COLUMNS = ORDER_SCHEMA.names
# ``season`` is in the path only; a calendar record has a ``year`` of its own.
FOLDERS = ["season", "race_folder"]


def _orders(s: Standins) -> DataFrame:
    """All orders with the season and the race folder of their date."""
    month = F.month("o_orderdate")
    return s.table("orders").select(
        *ORDER_COLUMNS,
        F.year("o_orderdate").alias("year"),
        F.format_string("%02d_Round %d", month, month).alias("race_folder"),
    )


def _landed_orders(s: Standins) -> str:
    root = f"{fresh_dir(s.spark, 'landing')}/bronze"
    sinks.land_json(_orders(s).withColumnRenamed("year", "season"), root, "orders", FOLDERS)
    return root


def _landed_lines(s: Standins, lines: DataFrame) -> str:
    """Land ready-made JSON lines (column ``value``) as they are."""
    root = f"{fresh_dir(s.spark, 'lines')}/bronze"
    writer = sinks.balanced(lines, FOLDERS).write.option("mapreduce.output.basename", "orders")
    writer.partitionBy(*FOLDERS).text(root)
    return root


# ---- landing scans ----------------------------------------------------------


@query
def scan_json_glob(s: Standins) -> DataFrame:
    root = _landed_orders(s)
    sinks.land_json(s.table("supplier"), root, "orders_suppliers")
    scan = landing.scan_json(s.spark, root, landing.entity_files("orders"), ORDER_SCHEMA)
    return landing.accepted(scan).select(*ORDER_COLUMNS)


@query
def scan_json_array(s: Standins) -> DataFrame:
    twin = F.struct("o_orderkey", "o_custkey", F.lit("twin").alias("o_orderstatus"), F.col("o_totalprice") / 2)
    twin = twin.cast(T.StructType(ORDER_SCHEMA.fields))
    pair = F.array(F.struct(*ORDER_COLUMNS).cast(T.StructType(ORDER_SCHEMA.fields)), twin)
    root = _landed_lines(s, _orders(s).select(F.to_json(pair).alias("value"), F.col("year").alias("season"), "race_folder"))
    scan = landing.scan_json(s.spark, root, "orders-*", ORDER_SCHEMA)
    return landing.accepted(scan).select(*ORDER_COLUMNS)


@query
def scan_path_columns(s: Standins) -> DataFrame:
    scan = landing.scan_json(s.spark, _landed_orders(s), landing.entity_files("orders"), ORDER_SCHEMA)
    return landing.with_path_columns(scan).select("o_orderkey", "race_folder_name", "year")


@query
def scan_path_regex_year(s: Standins) -> DataFrame:
    scan = landing.scan_json(s.spark, _landed_orders(s), landing.entity_files("orders"), ORDER_SCHEMA)
    return landing.with_season_by_pattern(scan).select("o_orderkey", "year")


def _mixed_lines(s: Standins) -> DataFrame:
    """Orders as text: fulfilled ones whole, pending ones cut off, open ones an error payload."""
    status = F.col("o_orderstatus")
    record = F.format_string('{"o_orderkey":%d,"o_custkey":%d}', "o_orderkey", "o_custkey")
    cut = F.format_string('{"o_orderkey":%d,"o_cust', "o_orderkey")
    error = F.format_string('{"detail":"no order %d"}', "o_orderkey")
    line = F.when(status == "P", cut).when(status == "O", error).otherwise(record)
    return _orders(s).select(line.alias("value"), F.col("year").alias("season"), "race_folder")


@query
def scan_json_permissive(s: Standins) -> DataFrame:
    scan = landing.scan_json(s.spark, _landed_lines(s, _mixed_lines(s)), "orders-*", ORDER_SCHEMA)
    return scan.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.col(CORRUPT).alias("rejected_text"),
    )


@query
def scan_quarantine(s: Standins) -> DataFrame:
    scan = landing.scan_json(s.spark, _landed_lines(s, _mixed_lines(s)), "orders-*", ORDER_SCHEMA)
    good = landing.accepted(scan).select("o_orderkey", F.lit(None).cast("string").alias("reason"))
    bad = landing.quarantined(scan)
    return good.withColumn("payload", F.lit(None).cast("string")).unionByName(
        bad.select(F.lit(None).cast("long").alias("o_orderkey"), "reason", "payload")
    )


@query
def scan_rescued_fields(s: Standins) -> DataFrame:
    """Only the key is declared; status, price and a nested customer come along, differently by status."""
    status = F.col("o_orderstatus")
    customer = F.struct(F.col("o_custkey").alias("key"))
    orders = _orders(s).select(
        "o_orderkey",
        F.when(status != "O", status).alias("o_orderstatus"),
        F.when(status == "F", customer).alias("customer"),
        F.col("year").alias("season"),
        "race_folder",
    )
    root = f"{fresh_dir(s.spark, 'rescue')}/bronze"
    sinks.land_json(orders, root, "orders", FOLDERS)
    scan = landing.scan_rescued(s.spark, root, landing.entity_files("orders"), ["o_orderkey"])
    return landing.with_season_by_pattern(scan).select(
        to_type(F.col("o_orderkey"), "long").alias("o_orderkey"),
        "year",
        F.coalesce(F.size(landing.RESCUED), F.lit(0)).alias("unknown_fields"),
        F.try_element_at(landing.RESCUED, F.lit("o_orderstatus")).alias("status"),
        F.try_element_at(landing.RESCUED, F.lit("customer")).alias("customer"),
    )


# ---- table scans ------------------------------------------------------------


@query
def scan_table(s: Standins) -> DataFrame:
    s.table("customer").createOrReplaceTempView("typed_customer")
    return s.spark.table("typed_customer").select("c_custkey", "c_name", "c_mktsegment")


@query
def scan_catalog_table(s: Standins) -> DataFrame:
    """Named in the catalog by one session, read by another."""
    root = fresh_dir(s.spark, "catalog")
    sinks.overwrite_seasons(_orders(s), f"{root}/orders")
    (name,) = create_tables(s.spark, root, ["orders"], "typed")
    return s.spark.newSession().table(name).select("o_orderkey", "o_totalprice", "year")


@query
def scan_season_pruned(s: Standins) -> DataFrame:
    path = fresh_dir(s.spark, "seasons")
    sinks.overwrite_seasons(_orders(s), path)
    return read_table(s.spark, path, seasons=[1997]).select("o_orderkey", "o_totalprice", "year")


@query
def scan_gold_star(s: Standins) -> DataFrame:
    root = fresh_dir(s.spark, "gold")
    for name, table in {
        "dim_driver": s.dim_driver,
        "dim_team": s.dim_team,
        "dim_race": s.dim_race,
        "fact_driver_results": s.fact_driver,
        "fact_team_results": s.fact_team,
        "ui_play_timeline": s.timeline,
    }.items():
        sinks.overwrite_table(table, f"{root}/{name}")
    register_star(s.spark, root)
    return s.spark.sql(
        """
        SELECT r.Year, t.Team, count(*) AS result_rows, max(f.World_Position) AS worst_position
        FROM gold_fact_team_results f
        LEFT JOIN gold_dim_race r ON r.Race_Key = f.Race_Key
        LEFT JOIN gold_dim_team t ON t.Team_Key = f.Team_Key
        GROUP BY r.Year, t.Team
        """
    )


# ---- sinks ------------------------------------------------------------------


@query
def sink_partitioned(s: Standins) -> DataFrame:
    path = fresh_dir(s.spark, "partitioned")
    sinks.overwrite_seasons(_orders(s), path)
    return read_table(s.spark, path).select(*ORDER_COLUMNS, "year")


@query
def sink_dynamic_overwrite(s: Standins) -> DataFrame:
    """All seasons, then one of them again with other prices."""
    path = fresh_dir(s.spark, "dynamic")
    orders = _orders(s)
    sinks.overwrite_seasons(orders, path)
    again = orders.where("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    sinks.overwrite_seasons(again, path)
    return read_table(s.spark, path).select("o_orderkey", "o_totalprice", "year")


@query
def sink_merge_schema(s: Standins) -> DataFrame:
    """Later seasons bring a column the earlier ones lack."""
    path = fresh_dir(s.spark, "merge")
    orders = _orders(s).select("o_orderkey", "o_orderstatus", "year")
    sinks.overwrite_seasons(orders.where("year < 1998").drop("o_orderstatus"), path)
    sinks.overwrite_seasons(orders.where("year >= 1998"), path)
    return read_table(s.spark, path, merge_schema=True).select("o_orderkey", "o_orderstatus", "year")


@query
def sink_full_overwrite(s: Standins) -> DataFrame:
    path = fresh_dir(s.spark, "full")
    orders = _orders(s).select(*ORDER_COLUMNS)
    sinks.overwrite_table(orders, path)
    sinks.overwrite_table(orders.where("o_orderstatus <> 'O'"), path)
    return read_table(s.spark, path)


@query
def sink_landing_replace(s: Standins) -> DataFrame:
    """A season landed twice; the second time only some of its folders exist."""
    season = f"{fresh_dir(s.spark, 'replace')}/bronze/1997"
    orders = _orders(s).drop("year")
    sinks.replace_season({"orders": orders}, season)
    kept = orders.where("o_orderstatus = 'F' AND race_folder < '07'")
    sinks.replace_season({"orders": kept, "nations": s.table("nation")}, season)
    scan = landing.scan_json(s.spark, season, landing.entity_files("orders"), ORDER_SCHEMA)
    path = F.col(landing.SOURCE_PATH)
    return landing.accepted(scan).select(
        *ORDER_COLUMNS, folder_from_path(path).alias("race_folder_name"), season_from_path(path).alias("year")
    )


@query
def union_seasons(s: Standins) -> DataFrame:
    """Seasons loaded one batch after the other; readers see all of them."""
    path = fresh_dir(s.spark, "accumulate")
    orders = _orders(s).select("o_orderkey", "o_custkey", "year")
    sinks.overwrite_seasons(orders.where("year <= 1997"), path)
    sinks.overwrite_seasons(orders.where("year > 1997"), path)
    return read_table(s.spark, path).groupBy("year").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_custkey").alias("top_customer")
    )


@query
def sort_before_write(s: Standins) -> DataFrame:
    path = fresh_dir(s.spark, "sorted")
    sinks.overwrite_seasons(sinks.date_ordered(s.calendar), path, arrange=False)
    return read_table(s.spark, path).select("year", "meeting_key", "gp_name", "date_start")


# ---- typed tables from landed records ---------------------------------------


def _landed(s: Standins, entity: str, records: DataFrame, folder: bool = True) -> DataFrame:
    """Land records of one entity and scan them back."""
    root = f"{fresh_dir(s.spark, entity)}/bronze"
    _land(s, root, entity, records, folder)
    return landing.accepted(landing.scan_entity(s.spark, root, entity))


def _land(s: Standins, root: str, entity: str, records: DataFrame, folder: bool = True) -> None:
    placed = records.withColumn("season", F.col("year"))
    if folder:
        sinks.land_json(s.in_folder(placed.drop("year")), root, entity, FOLDERS)
    else:
        sinks.land_json(placed, root, entity, ["season"])


def _meeting_records(s: Standins) -> DataFrame:
    """The calendar plus, per January, a test and a meeting without a name."""
    january = s.meetings.where("meeting_key % 100 = 1")
    test = january.withColumns(
        {
            "meeting_key": F.col("meeting_key") + 50,
            "meeting_name": F.concat(F.lit("Winter Testing "), F.col("year").cast("string")),
        }
    )
    unnamed = january.withColumns(
        {"meeting_key": F.col("meeting_key") + 60, "meeting_name": F.lit(None).cast("string")}
    )
    return s.meetings.unionByName(test).unionByName(unnamed)


@query
def silver_driver_standings(s: Standins) -> DataFrame:
    records = _landed(s, "drivers_standings", s.driver_records)
    return silver.driver_standings(records, loaded_at())


@query
def silver_team_standings(s: Standins) -> DataFrame:
    return silver.team_standings(_landed(s, "teams_standings", s.team_records), loaded_at())


@query
def silver_calendar(s: Standins) -> DataFrame:
    records = _landed(s, "circuits", _meeting_records(s), folder=False)
    return silver.calendar(records, loaded_at()).withColumn("date_start", F.col("date_start").cast("timestamp_ntz"))


@query
def silver_entrants(s: Standins) -> DataFrame:
    records = _landed(s, "drivers", s.roster_records.drop("pts", "pen"))
    return silver.entrants(silver.roster(records, ASSETS, loaded_at()))


@query
def silver_teams(s: Standins) -> DataFrame:
    standings = silver.team_standings(_landed(s, "teams_standings", s.team_records), loaded_at())
    return silver.teams(standings, ASSETS)


def _land_all(s: Standins, bronze: str, driver_records: DataFrame | None = None) -> list[int]:
    """Every season's records in its folders; the seasons."""
    _land(s, bronze, "drivers_standings", s.driver_records if driver_records is None else driver_records)
    _land(s, bronze, "teams_standings", s.team_records)
    _land(s, bronze, "drivers", s.listed(s.roster_records).drop("pts", "pen"))
    _land(s, bronze, "circuits", _meeting_records(s), folder=False)
    # one number for each season of the calendar
    return sorted(r[0] for r in _meeting_records(s).select("year").distinct().collect())


def _doubled(s: Standins, season: int) -> DataFrame:
    """Driver records with twice the points in one season."""
    points = F.col("points_current")
    return s.driver_records.withColumn("points_current", F.when(F.col("year") == season, points * 2).otherwise(points))


def _last_season(s: Standins) -> int:
    return s.raw_results.agg(F.max("year")).first()[0]


def _both_facts(drivers: DataFrame, teams: DataFrame) -> DataFrame:
    drivers, teams = drivers.drop(gold.SEASON), teams.drop(gold.SEASON)
    return drivers.withColumn("entity", F.col("Driver_Key").cast("string")).drop("Driver_Key").unionByName(
        teams.withColumn("entity", F.lit("team"))
    )


@query
def incremental_season_load(s: Standins) -> DataFrame:
    """Every season loaded, then the last one landed and loaded again.

    At first its points are delivered doubled; the second landing is right.
    """
    root = fresh_dir(s.spark, "load")
    bronze, last = f"{root}/bronze", _last_season(s)
    roster = s.listed(s.roster_records).drop("pts", "pen")
    seasons = _land_all(s, bronze, _doubled(s, last))
    job.run(s.spark, seasons, root, "season={year}", ASSETS, loaded_at())

    def corrected(records: DataFrame) -> DataFrame:
        return s.in_folder(records.where(F.col("year") == last).drop("year"))

    sinks.replace_season(
        {
            "drivers_standings": corrected(s.driver_records),
            "teams_standings": corrected(s.team_records),
            "drivers": corrected(roster),
            "circuits": _meeting_records(s).where(F.col("year") == last),
        },
        f"{bronze}/season={last}",
    )
    job.run(s.spark, [last], root, "season={year}", ASSETS, loaded_at())
    return _both_facts(*(read_table(s.spark, f"{root}/gold/{name}") for name in ("fact_driver_results", "fact_team_results")))


@query
def season_reload_failed(s: Standins) -> DataFrame:
    """Two reloads of the last season fail, one while writing and one at its limits: readers keep the season as it was."""
    root = fresh_dir(s.spark, "failed")
    bronze, last = f"{root}/bronze", _last_season(s)
    names = f"c{uuid.uuid4().hex[:12]}_"
    seasons = _land_all(s, bronze)
    job.run(s.spark, seasons, root, "season={year}", ASSETS, loaded_at(), catalog=names)

    def gone(records: DataFrame) -> DataFrame:
        return s.in_folder(records.where(F.col("year") == last).drop("year"))

    sinks.replace_season(
        {
            "drivers_standings": gone(_doubled(s, last)),
            "teams_standings": gone(s.team_records),
            "drivers": gone(s.listed(s.roster_records).drop("pts", "pen")).where("driver_number % 2 = 0"),
            "circuits": _meeting_records(s).where(F.col("year") == last),
        },
        f"{bronze}/season={last}",
    )
    lost = F.raise_error(F.lit("an executor went away")).cast("timestamp")
    for stamp, limits, error in ((lost, None, Exception), (loaded_at(), Limits(orphan_keys=0), LoadRejected)):
        try:
            job.run(s.spark, [last], root, "season={year}", ASSETS, stamp, catalog=names, limits=limits)
        except error:
            continue
        raise AssertionError("the load was to fail")
    return _both_facts(s.spark.table(f"{names}gold_fact_driver_results"), s.spark.table(f"{names}gold_fact_team_results"))


@query
def season_switch(s: Standins) -> DataFrame:
    """The last season loaded twice into the catalog: its partition points to the new files, the old ones are left to running readers, then dropped."""
    root = fresh_dir(s.spark, "switch")
    bronze, last = f"{root}/bronze", _last_season(s)
    names = f"c{uuid.uuid4().hex[:12]}_"
    seasons = _land_all(s, bronze, _doubled(s, last))
    job.run(s.spark, seasons, root, "season={year}", ASSETS, loaded_at(), catalog=names)
    records = s.driver_records.where(F.col("year") == last).drop("year")
    season = f"{bronze}/season={last}"
    sinks.replace_season(
        {
            "drivers_standings": s.in_folder(records),
            **{
                entity: s.in_folder(table.where(F.col("year") == last).drop("year"))
                for entity, table in (("teams_standings", s.team_records), ("drivers", s.listed(s.roster_records).drop("pts", "pen")))
            },
            "circuits": _meeting_records(s).where(F.col("year") == last),
        },
        season,
    )
    job.run(s.spark, [last], root, "season={year}", ASSETS, loaded_at(), catalog=names)
    _, star = job.stores(s.spark, root, catalog=names)
    for name in ("fact_driver_results", "fact_team_results"):
        star.drop_unused(name)
    return _both_facts(s.spark.table(f"{names}gold_fact_driver_results"), s.spark.table(f"{names}gold_fact_team_results"))


@query
def schema_growth_load(s: Standins) -> DataFrame:
    """Seasons loaded before and after the source brings the laps led; older files show the default."""
    root = fresh_dir(s.spark, "growth")
    bronze = f"{root}/bronze"
    laps = F.when((F.col("year") >= 1997) & (F.col("driver_number") % 3 > 0), F.col("driver_number") % 50)
    seasons = _land_all(s, bronze, s.driver_records.withColumn("laps_led_total", laps))
    older = [year for year in seasons if year < 1998]
    job.run(s.spark, older, root, "season={year}", ASSETS, loaded_at())
    grown = Schemas((Added("drivers_standings", "laps_led_total", "laps_led", "int", "-1"),))
    newer = [year for year in seasons if year >= 1997]
    job.run(s.spark, newer, root, "season={year}", ASSETS, loaded_at(), schemas=grown)
    typed, star = job.stores(s.spark, root, schemas=grown)
    results = star.read("fact_driver_results").groupBy(F.col(gold.SEASON).alias("year")).agg(F.count(F.lit(1)).alias("results"))
    led = typed.read("drivers_standings").groupBy("year").agg(
        F.count(F.lit(1)).alias("standings"),
        F.count_if(F.col("laps_led") == -1).alias("unknown"),
        F.sum(F.when(F.col("laps_led") >= 0, F.col("laps_led"))).alias("laps"),
    )
    return led.join(results, "year", "left")


@query
def load_watch_counts(s: Standins) -> DataFrame:
    """What a load counts while it writes: rows, repeated keys and keys without a dimension row, by table."""
    root = fresh_dir(s.spark, "watch")
    seasons = _land_all(s, f"{root}/bronze")
    report = job.run(s.spark, seasons, root, "season={year}", ASSETS, loaded_at(), limits=Limits())
    rows = [(table, rule, n) for table, counts in report.counts.items() for rule, n in counts.items()]
    return s.spark.createDataFrame(rows, "table_name string, counted string, n long")


@query
def catalog_driven_load(s: Standins) -> DataFrame:
    """Loads without a list of seasons: one is incomplete at first, one lands again, and a last call finds nothing to do."""
    root = fresh_dir(s.spark, "due")
    bronze = f"{root}/bronze"
    held_back = F.col("meeting_key") == 199412
    sessions = s.session_records.withColumns({"session_type": F.lit("Race"), "year": (F.col("meeting_key") / 100).cast("int")})
    months = s.meetings.select("meeting_key")
    sessions = sessions.withColumnRenamed("session_start", "date_start")
    _land(s, bronze, "sessions", sessions.join(months, "meeting_key"))
    _land(s, bronze, "drivers_standings", s.driver_records)
    _land(s, bronze, "teams_standings", s.team_records)
    roster = s.listed(s.roster_records).drop("pts", "pen")
    _land(s, bronze, "drivers", roster.where(~held_back))
    _land(s, bronze, "circuits", _meeting_records(s), folder=False)

    def due() -> list[int]:
        return job.run(s.spark, None, root, "season={year}", ASSETS, loaded_at()).seasons

    first = due()
    _land(s, bronze, "drivers", roster.where(held_back))
    second, third = due(), due()
    assert third == []
    typed, star = job.stores(s.spark, root)
    facts = star.read("fact_driver_results").groupBy(F.col(gold.SEASON).alias("year")).agg(F.count(F.lit(1)).alias("results"))
    order = F.when(F.col("year").isin(first), 1).when(F.col("year").isin(second), 2)
    rounds = typed.read("seasons").groupBy("year").agg(F.count(F.lit(1)).alias("rounds"), F.max("folder_name").alias("last_folder"))
    return rounds.join(facts, "year").withColumn("loaded_by", order)


@query
def load_team_at_race(s: Standins) -> DataFrame:
    """All seasons landed and loaded, each result with the team of its day."""
    root = fresh_dir(s.spark, "transfers")
    seasons = _land_all(s, f"{root}/bronze")
    job.run(s.spark, seasons, root, "season={year}", ASSETS, loaded_at(), team_at_race=True)
    return read_table(s.spark, f"{root}/gold/fact_driver_results").drop(gold.SEASON)
