"""Season standings derived from the driver tables.

A supplier is an entrant, a ship month a race, a ship year a season, and the
quantity of returned lines the points won.  The whole of ``lineitem`` is used.
What the operators have to cope with occurs in the data itself:

* no points in a month without returned lines: a result without a position;
* a penalty for highly taxed lines that counts for one race only: cumulative
  totals that drop;
* suppliers with a low balance have no name or no photo, and those with the
  lowest are missing where rosters are landed or looked up for a driver's results;
* suppliers with a high balance change teams in July;
* nations of the third region pad their team name from July on;
* race names of a quarter's last month differ by season and share a code.

``lineitem`` is read once per query: its results, one row per supplier and month,
and the entrants are written to the shared folder, as the typed tables of a
load would be, and the later steps read them there.

The calendar, the races and the teams are stored as well, so that their true size
decides how Spark joins them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasongrid.config import Assets
from seasongrid.functions.text import default_if_blank, folder_name, hex_colour
from seasongrid.plans import gold, silver, star
from seasongrid.sources.sinks import stored

ASSETS = Assets(default_photo="assets/portrait.png", logo_base="assets/teams/")
LOADED_AT = "2024-01-01 00:00:00"


def loaded_at() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def _first_day(meeting_key: Column) -> Column:
    return F.make_date((meeting_key / 100).cast("int"), (meeting_key % 100).cast("int"), F.lit(1))


def meeting_name(meeting_key: Column) -> Column:
    first = _first_day(meeting_key)
    cup = F.concat(F.date_format(first, "MMMM"), F.lit(" Cup "), F.year(first).cast("string"))
    prix = F.concat(F.date_format(first, "MMMM"), F.lit(" Prix"))
    return F.when(F.month(first) % 3 == 0, cup).otherwise(prix)


def race_folder(meeting_key: Column) -> Column:
    return folder_name((meeting_key % 100).cast("int"), meeting_name(meeting_key))


class Standins:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- landed shape ---------------------------------------------------------

    @cached_property
    def raw_results(self) -> DataFrame:
        """Entrant, race, cumulative points and penalty; one row per supplier and month."""
        quantity = F.col("l_quantity")
        # One narrow key for the month; its parts are worked out for each result, not for each line.
        per_month = (
            self.table("lineitem")
            .groupBy(
                F.col("l_suppkey").cast("int").alias("driver_number"),
                F.trunc("l_shipdate", "month").alias("first_day"),
            )
            .agg(
                F.sum(F.when(F.col("l_returnflag") == "R", quantity)).alias("pts"),
                F.sum(F.when(F.col("l_tax") >= 0.06, quantity).otherwise(0.0)).alias("pen"),
            )
        )
        year = F.year("first_day")
        per_race = per_month.select(
            "driver_number",
            year.alias("year"),
            (year * 100 + F.month("first_day")).cast("long").alias("meeting_key"),
            "pts",
            "pen",
        )
        so_far = (
            Window.partitionBy("driver_number", "year")
            .orderBy("meeting_key")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return stored(per_race.withColumn("cp", F.sum("pts").over(so_far)), "results")

    @cached_property
    def driver_records(self) -> DataFrame:
        """Entrant standings as a source would deliver them, one per race."""
        standing = (F.col("cp").cast("long") * 7 + F.col("driver_number")) % 20 + 1
        return self.raw_results.select(
            F.when(F.col("pts").isNotNull(), standing).alias("position_current"),
            F.greatest(F.col("cp") - F.col("pen") * 0.5, F.lit(0.0)).alias("points_current"),
            "driver_number",
            (F.col("meeting_key") * 10 + 1).alias("session_key"),
            "meeting_key",
            "year",
        )

    @cached_property
    def folders(self) -> DataFrame:
        """The folder of each race that has results, also of the one without a date."""
        key = F.col("meeting_key")
        races = self.raw_results.select("meeting_key").distinct()
        return stored(races.select(key.alias("of_race"), race_folder(key).alias("race_folder")), "folders")

    def in_folder(self, records: DataFrame) -> DataFrame:
        """Records with the folder of their race, whose name is made once for a race and not for a record."""
        here = F.col("meeting_key").eqNullSafe(F.col("of_race"))
        return records.join(self.folders, here, "left").drop("of_race")

    @cached_property
    def meetings(self) -> DataFrame:
        """The calendar: every month in which anything was shipped.

        Results that are stored already have a row for each supplier and month, so the lines are not read again.
        """
        year, month = F.year("l_shipdate"), F.month("l_shipdate")
        if "raw_results" in vars(self):
            lines = self.raw_results.select("meeting_key")
        else:
            lines = self.table("lineitem").select((year * 100 + month).cast("long").alias("meeting_key"))
        months = stored(lines.distinct(), "months")
        key = F.col("meeting_key")
        month_name = F.date_format(_first_day(key), "MMMM")
        day_name = F.date_format(_first_day(key), "EEEE")
        return months.select(
            "meeting_key",
            (key % 100).alias("circuit_key"),
            meeting_name(key).alias("meeting_name"),
            day_name.alias("location"),
            month_name.alias("country_name"),
            F.upper(F.substring(month_name, 1, 3)).alias("country_code"),
            F.concat(day_name, F.lit(" Ring")).alias("circuit_short_name"),
            _first_day(key).cast("timestamp_ntz").alias("date_start"),
            F.year(_first_day(key)).alias("year"),
        )

    @cached_property
    def roster_records(self) -> DataFrame:
        """Who raced for whom, one row per entrant and race."""
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
        region = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        home = nation.join(region, "n_regionkey")
        supplier = (
            self.table("supplier")
            .withColumn("driver_number", F.col("s_suppkey").cast("int"))
            .join(home, "s_nationkey")
        )
        entries = self.raw_results.join(supplier, "driver_number")
        balance = F.col("s_acctbal")
        second_half = F.col("meeting_key") % 100 >= 7
        squad = F.when((balance >= 9000) & second_half, F.col("r_name")).otherwise(F.col("n_name"))
        padding = F.when((F.col("n_regionkey") == 2) & second_half, F.lit(" ")).otherwise(F.lit(""))
        return entries.select(
            "driver_number",
            F.when(balance >= 0, F.col("s_name")).alias("full_name"),
            F.substring("s_name", -3, 3).alias("name_acronym"),
            F.concat(F.lit("Team "), squad, padding).alias("team_name"),
            F.substring("n_name", 1, 3).alias("country_code"),
            F.when(balance >= 3000, F.concat(F.lit("http://img/"), F.col("driver_number").cast("string")))
            .when(balance >= 1500, F.lit(""))
            .alias("headshot_url"),
            F.when(F.col("n_regionkey") == 0, F.lit(None))
            .when(F.col("n_regionkey") == 1, F.lit(""))
            .otherwise(F.lpad(F.col("s_nationkey").cast("string"), 6, "0"))
            .alias("team_colour"),
            "meeting_key",
            "year",
            "pts",
            "pen",
        )

    def listed(self, roster: DataFrame) -> DataFrame:
        """Rows of the entrants a source lists: all but the suppliers with the lowest balance."""
        listed = self.table("supplier").where("s_acctbal >= -500").select(F.col("s_suppkey").cast("int").alias("driver_number"))
        return roster.join(listed, "driver_number", "left_semi")

    @cached_property
    def team_records(self) -> DataFrame:
        """Team standings as a source would deliver them."""
        per_race = self.roster_records.groupBy("team_name", "year", "meeting_key").agg(
            F.sum("pts").alias("pts"), F.sum("pen").alias("pen")
        )
        so_far = (
            Window.partitionBy("team_name", "year")
            .orderBy("meeting_key")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        cumulative = per_race.withColumn("cp", F.sum("pts").over(so_far))
        standing = (F.col("cp").cast("long") * 3 + F.length("team_name")) % 10 + 1
        return cumulative.select(
            "meeting_key",
            "team_name",
            F.when(F.col("pts").isNotNull(), standing).alias("position_current"),
            F.greatest(F.col("cp") - F.col("pen") * 0.5, F.lit(0.0)).alias("points_current"),
            "year",
        )

    @cached_property
    def session_records(self) -> DataFrame:
        """Sessions of the meetings: every order of a month is one."""
        placed = F.col("o_orderdate")
        kind = F.col("o_orderstatus")
        return self.table("orders").select(
            (F.year(placed) * 100 + F.month(placed)).cast("long").alias("meeting_key"),
            F.col("o_orderkey").alias("session_key"),
            F.when(kind == "F", F.lit("Race")).when(kind == "O", F.lit("Sprint")).alias("session_name"),
            F.when(kind == "F", F.lit("Race")).otherwise(F.lit("Other")).alias("session_type"),
            placed.alias("session_start"),
        )

    # -- silver shape ---------------------------------------------------------

    # What the silver builders make of the landed records; the queries named
    # silver_* take the way through landed files and arrive at the same rows.

    @cached_property
    def standings(self) -> DataFrame:
        return self.driver_records.where("position_current IS NOT NULL").select(
            F.col("position_current").cast("int").alias("position"),
            F.col("points_current").cast("float").alias("points"),
            "driver_number",
            "session_key",
            "meeting_key",
            race_folder(F.col("meeting_key")).alias("race_folder_name"),
            "year",
            loaded_at().alias("ingestion_date"),
        )

    @cached_property
    def team_standings(self) -> DataFrame:
        return self.team_records.where("position_current IS NOT NULL").select(
            "meeting_key",
            "team_name",
            F.col("position_current").cast("int").alias("position"),
            F.col("points_current").cast("float").alias("points"),
            "year",
            loaded_at().alias("ingestion_date"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        # The declared type is a timestamp; zone-free here, for comparison with SQL.
        return self.meetings.select(
            "meeting_key",
            "circuit_key",
            F.col("meeting_name").alias("gp_name"),
            F.col("location").alias("city"),
            F.col("country_name").alias("country"),
            F.col("country_code").alias("gp_code"),
            F.col("circuit_short_name").alias("circuit"),
            "date_start",
            "year",
        )

    @cached_property
    def roster(self) -> DataFrame:
        return self.roster_records.select(
            "driver_number",
            "full_name",
            "name_acronym",
            "team_name",
            "country_code",
            "year",
            default_if_blank(F.col("headshot_url"), ASSETS.default_photo).alias("headshot_url"),
            hex_colour(F.col("team_colour"), ASSETS.default_colour).alias("team_colour"),
            loaded_at().alias("ingestion_date"),
            race_folder(F.col("meeting_key")).alias("race_folder_name"),
        )

    @cached_property
    def entrants(self) -> DataFrame:
        return stored(silver.entrants(self.roster), "entrants")

    @cached_property
    def teams(self) -> DataFrame:
        return silver.teams(self.team_standings, ASSETS)

    # -- gold shape -----------------------------------------------------------

    @cached_property
    def dim_driver(self) -> DataFrame:
        return gold.dim_driver(self.entrants, self.standings, self.calendar)

    @cached_property
    def dim_team(self) -> DataFrame:
        return stored(gold.dim_team(self.teams, self.entrants), "dim-team")

    @cached_property
    def dim_race(self) -> DataFrame:
        return stored(gold.dim_race(self.calendar), "dim-race")

    @cached_property
    def timeline(self) -> DataFrame:
        return gold.timeline(self.calendar)

    @cached_property
    def fact_driver(self) -> DataFrame:
        return gold.fact_driver(self.standings, self.calendar, self.listed(self.entrants))

    @cached_property
    def fact_team(self) -> DataFrame:
        return gold.fact_team(self.team_standings, self.calendar)

    @cached_property
    def driver_star(self) -> DataFrame:
        """Driver facts with their race only; measures join no more than they read."""
        return self.fact_driver.join(self.dim_race, "Race_Key", "left")

    @cached_property
    def team_star(self) -> DataFrame:
        return self.fact_team.join(self.dim_race, "Race_Key", "left")

    @cached_property
    def full_driver_star(self) -> DataFrame:
        return star.driver_star(self.fact_driver, self.dim_driver, self.dim_race, self.dim_team)

    @cached_property
    def full_team_star(self) -> DataFrame:
        return star.team_star(self.fact_team, self.dim_team, self.dim_race)
