"""Declared columns of the landed JSON, one set per entity, and their typed form.

Declaring them saves the inference pass over the data and keeps a scan working
when a column is absent from every file.  Values are read as text, whether
quoted or not, and get their type in the typed table, where a value that does
not fit becomes null.  A typed scan would reject the whole array it stands in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# The field an error payload carries in place of records.
ERROR_FIELD = "detail"

# Landed column, column of the typed table, its type.
TYPED_COLUMNS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "drivers_standings": (
        ("position_current", "position", "int"),
        ("points_current", "points", "float"),
        ("driver_number", "driver_number", "int"),
        ("session_key", "session_key", "long"),
        ("meeting_key", "meeting_key", "long"),
    ),
    "teams_standings": (
        ("meeting_key", "meeting_key", "long"),
        ("team_name", "team_name", "string"),
        ("position_current", "position", "int"),
        ("points_current", "points", "float"),
    ),
    "circuits": (
        ("meeting_key", "meeting_key", "long"),
        ("circuit_key", "circuit_key", "long"),
        ("meeting_name", "gp_name", "string"),
        ("location", "city", "string"),
        ("country_name", "country", "string"),
        ("country_code", "gp_code", "string"),
        ("circuit_short_name", "circuit", "string"),
        ("date_start", "date_start", "timestamp"),
        ("year", "year", "int"),
    ),
    "drivers": (
        ("driver_number", "driver_number", "int"),
        ("full_name", "full_name", "string"),
        ("name_acronym", "name_acronym", "string"),
        ("team_name", "team_name", "string"),
        ("country_code", "country_code", "string"),
        ("headshot_url", "headshot_url", "string"),
        ("team_colour", "team_colour", "string"),
    ),
    "meetings": (
        ("meeting_key", "meeting_key", "long"),
        ("meeting_name", "meeting_name", "string"),
        ("date_start", "date_start", "timestamp"),
        ("year", "year", "int"),
    ),
    "sessions": (
        ("meeting_key", "meeting_key", "long"),
        ("session_key", "session_key", "long"),
        ("session_name", "session_name", "string"),
        ("session_type", "session_type", "string"),
        ("date_start", "session_start", "timestamp"),
    ),
}


_KINDS = {
    "int": T.IntegerType,
    "long": T.LongType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "string": T.StringType,
    "boolean": T.BooleanType,
    "timestamp": T.TimestampType,
}

# Columns of the tables beside those of their entity, and the column by which a table is partitioned.
_STAMP = ("ingestion_date", "timestamp")
_YEAR = ("year", "int")
_FOLDER = ("race_folder_name", "string")
_TABLES: dict[str, tuple[str | None, tuple[tuple[str, str], ...], str | None]] = {
    "drivers_standings": ("drivers_standings", (_FOLDER, _STAMP, _YEAR), "year"),
    "teams_standings": ("teams_standings", (_STAMP, _YEAR), "year"),
    "circuits": ("circuits", (_STAMP,), "year"),
    "drivers_by_race": ("drivers", (_FOLDER, _STAMP, _YEAR), "year"),
    "drivers": ("drivers", (_STAMP, _YEAR), "year"),
    "teams": (
        None,
        (("team_name", "string"), ("team_logo_url", "string"), ("last_updated", "timestamp"), _YEAR),
        "year",
    ),
    "seasons": (
        None,
        (
            ("round", "int"),
            ("meeting_key", "long"),
            ("session_key", "long"),
            ("meeting_name", "string"),
            ("date_start", "timestamp"),
            ("folder_name", "string"),
            _YEAR,
        ),
        "year",
    ),
    "landed_files": (None, (("path", "string"), ("length", "long"), ("modified", "timestamp"), _YEAR), "year"),
    "unknown_fields": (
        None,
        (("entity", "string"), ("field", "string"), ("records", "long"), ("example", "string"), _YEAR),
        "year",
    ),
    "dim_driver": (
        None,
        (
            ("Driver_Key", "long"),
            ("Number", "int"),
            ("Driver", "string"),
            ("Driver_Photo", "string"),
            ("Driver_Country", "string"),
            ("Season_Rank_Sort", "int"),
            ("Year", "int"),
        ),
        "Year",
    ),
    "dim_team": (
        None,
        (("Team_Key", "string"), ("Team", "string"), ("Team_Logo", "string"), ("Hex_Color", "string"), ("Year", "int")),
        "Year",
    ),
    "dim_race": (
        None,
        (
            ("Race_Key", "long"),
            ("Year", "int"),
            ("Grand_Prix", "string"),
            ("Circuit_Name", "string"),
            ("GP_Display", "string"),
            ("Date", "timestamp"),
        ),
        None,
    ),
    "fact_driver_results": (
        None,
        (
            ("Driver_Key", "long"),
            ("Team_Key", "string"),
            ("Race_Key", "long"),
            ("Race_Points", "float"),
            ("Season_Points", "float"),
            ("World_Position", "int"),
            ("season", "int"),
        ),
        "season",
    ),
    "fact_team_results": (
        None,
        (
            ("Team_Key", "string"),
            ("Race_Key", "long"),
            ("Race_Points", "float"),
            ("Season_Points", "float"),
            ("World_Position", "int"),
            ("season", "int"),
        ),
        "season",
    ),
    "ui_play_timeline": (None, (("Date", "timestamp"), ("Race_Key", "int")), None),
}


@dataclass(frozen=True)
class Added:
    """A column that landed files bring from some version on.

    ``default`` is an SQL literal.  It stands for a value that is absent or does
    not fit, in files written before the column as in records loaded later.
    """

    entity: str
    landed: str
    name: str
    kind: str
    default: str | None = None


@dataclass(frozen=True)
class Schemas:
    """A version of the declared schemas: the columns above and those added since, in order."""

    added: tuple[Added, ...] = ()

    def columns(self, entity: str) -> tuple[tuple[str, str, str], ...]:
        more = tuple((a.landed, a.name, a.kind) for a in self.added if a.entity == entity)
        return TYPED_COLUMNS[entity] + more

    def record(self, entity: str) -> T.StructType:
        return text_schema(*[landed for landed, _, _ in self.columns(entity)])

    def defaults(self, entity: str | None) -> dict[str, str]:
        return {a.name: a.default for a in self.added if a.entity == entity and a.default is not None}

    def table(self, name: str) -> T.StructType | None:
        """The schema of a stored table; a scan with it shows the default where a file lacks the column."""
        if name not in _TABLES:
            return None
        entity, extra, _ = _TABLES[name]
        own = [(column, kind) for _, column, kind in self.columns(entity)] if entity else []
        defaults = self.defaults(entity)
        schema = T.StructType()
        for column, kind in (*own, *extra):
            default = defaults.get(column)
            # the two names under which Spark keeps a column's default
            marks = {} if default is None else {"CURRENT_DEFAULT": default, "EXISTS_DEFAULT": default}
            schema.add(T.StructField(column, _KINDS[kind](), True, marks))
        return schema


@dataclass(frozen=True)
class RejectSchemas(Schemas):
    """Tables of refused records, one per entity, with the season of their file."""

    def table(self, name: str) -> T.StructType:
        return text_schema("source_path", "reason", "payload").add("year", T.IntegerType())


def partition_column(table: str) -> str | None:
    """The column a table is partitioned by; a season in every case."""
    return _TABLES[table][2] if table in _TABLES else "year"


def text_schema(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def with_diagnostics(schema: T.StructType) -> T.StructType:
    """The record schema plus the error field and the corrupt-record column."""
    extra = [name for name in (ERROR_FIELD, CORRUPT) if name not in schema.names]
    return T.StructType([*schema.fields, *text_schema(*extra).fields])
