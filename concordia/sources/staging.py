"""Staging projections: one declarative column list for each landed feed (output name -> SQL expression).

Feeds: charts (scraped lap charts, all text), timing (session timing), events (REST event feed), dump (relational
dump), archive (results database). Bad values become null; sources that haven't landed give typed empty relations
through `optional_source`. Plain renames go through `rename_cast`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.functions.columns import classify, code_map, duration_ms, has_code, json_number, local_date, placeholder_null, utc_timestamp

#: What feeds write for a compound that they don't know, and the chart's codes. Fixed values.
NO_COMPOUND = ("NAN", "NONE", "UNKNOWN", "TEST_UNKNOWN", "")
COMPOUNDS = {"H": "HARD", "M": "MEDIUM", "S": "SOFT", "SS": "SUPERSOFT", "US": "ULTRASOFT", "HS": "HYPERSOFT", "I": "INTERMEDIATE", "W": "WET"}

#: Schemas of the event feed's tables, for those that haven't landed. Fixed values.
EVENT_SCHEMAS = {
    "laps": "session_key bigint, driver_number bigint, lap_number bigint, date_start string, lap_duration double, duration_sector_1 double, duration_sector_2 double, duration_sector_3 double, is_pit_out_lap boolean, i1_speed double, i2_speed double, st_speed double",
    "meetings": "meeting_key bigint, year bigint, meeting_name string, meeting_official_name string, country_name string, location string, is_cancelled boolean",
    "pit": "session_key bigint, driver_number bigint, lap_number bigint, date string, lane_duration double, pit_duration double, stop_duration double",
    "position": "session_key bigint, driver_number bigint, date string, position bigint",
    "race_control": "session_key bigint, date string, lap_number bigint, category string, flag string, scope string, sector double, driver_number double, message string",
    "session_result": "session_key bigint, driver_number bigint, position string, number_of_laps bigint, dnf boolean, dns boolean, dsq boolean, duration string, gap_to_leader string, points double",
    "sessions": "session_key bigint, meeting_key bigint, year bigint, session_name string, session_type string, date_start string, date_end string, gmt_offset string, circuit_key bigint, circuit_short_name string, country_code string, country_name string, location string, is_cancelled boolean",
    "stints": "session_key bigint, driver_number bigint, stint_number bigint, lap_start double, lap_end double, compound string, tyre_age_at_start bigint",
    "weather": "session_key bigint, date string, air_temperature double, track_temperature double, humidity double, pressure double, rainfall bigint, wind_direction bigint, wind_speed double",
}


#: In a plain projection, the type of a column that only tells whether the source is not null.
PRESENT = "present"
#: Plain projections by feed and table: a column as it is, (column, name) or (column, name, type). The columns and names are those
#: of the feeds and of the published model. Fixed values.
PROJECTIONS = {
    "archive": {
        "circuits": [("id", "circuit_id"), "name", "full_name", ("type", "circuit_type"), "place_name", "country_id", "latitude", "longitude", ("length", "circuit_length_km"), "turns"],
        "constructors": [("id", "constructor_id"), "name", "full_name", "country_id"],
        "countries": [("id", "country_id"), "alpha2_code", "alpha3_code", ("name", "country_name"), "demonym", "continent_id"],
        "drivers": [
            ("id", "driver_id"), "name", "first_name", "last_name", "full_name", "abbreviation", "permanent_number", "gender", "date_of_birth", "date_of_death", "place_of_birth", "country_of_birth_country_id",
            "nationality_country_id",
        ],
        "engine_manufacturers": [("id", "engine_manufacturer_id"), "name", "country_id"],
        "grands_prix": [("id", "grand_prix_id"), "name", "full_name", "short_name", "abbreviation", "country_id"],
        "race_constructor_standings": ["race_id", "position_display_order", "position_number", "position_text", "constructor_id", "engine_manufacturer_id", "points", "positions_gained", ("championship_won", "championship_won", "boolean")],
        "race_driver_standings": ["race_id", "position_display_order", "position_number", "position_text", "driver_id", "points", "positions_gained", ("championship_won", "championship_won", "boolean")],
        "race_data": [
            "race_id", ("type", "session_type"), "position_display_order", "position_number", "position_text", "driver_number", "driver_id", "constructor_id", "engine_manufacturer_id", "tyre_manufacturer_id",
            "qualifying_time_millis", "qualifying_q1_millis", "qualifying_q2_millis", "qualifying_q3_millis", "qualifying_gap_millis", "qualifying_laps", "starting_grid_position_grid_penalty",
            "starting_grid_position_grid_penalty_positions", ("race_shared_car", "race_shared_car", "boolean"), "race_laps", "race_time_millis", "race_time_penalty_millis", "race_gap_millis", "race_gap_laps",
            "race_interval_millis", "race_reason_retired", "race_points", ("race_pole_position", "race_pole_position", "boolean"), "race_qualification_position_number", "race_grid_position_number",
            "race_grid_position_text", "race_positions_gained", "race_pit_stops", ("race_fastest_lap", "race_fastest_lap", "boolean"), ("race_driver_of_the_day", "race_driver_of_the_day", "boolean"),
            ("race_grand_slam", "race_grand_slam", "boolean"), "fastest_lap_lap", "fastest_lap_time_millis", "fastest_lap_gap_millis", "pit_stop_stop", "pit_stop_lap", "pit_stop_time_millis",
        ],
        "races": [
            ("id", "race_id"), ("year", "season"), "round", ("date", "race_date"), ("time", "race_time_utc"), "grand_prix_id", "official_name", "qualifying_format", "sprint_qualifying_format",
            ("sprint_race_date", "has_sprint", PRESENT), "circuit_id", "circuit_type", "direction", "course_length", "turns", "laps", "distance", "scheduled_laps", "scheduled_distance",
            ("drivers_championship_decider", "drivers_championship_decider", "boolean"), ("constructors_championship_decider", "constructors_championship_decider", "boolean"),
        ],
        "season_constructor_standings": [("year", "season"), "position_display_order", "position_number", "position_text", "constructor_id", "engine_manufacturer_id", "points", ("championship_won", "championship_won", "boolean")],
        "season_driver_standings": [("year", "season"), "position_display_order", "position_number", "position_text", "driver_id", "points", ("championship_won", "championship_won", "boolean")],
        "tyre_manufacturers": [("id", "tyre_manufacturer_id"), "name", "country_id"],
    },
    "timing": {
        "quali_results": [
            ("season", "season", "int"), ("round", "round", "int"), ("DriverNumber", "driver_number"), ("Abbreviation", "driver_code"), ("Position", "position", "int"), ("Q1_ms", "q1_ms"), ("Q2_ms", "q2_ms"),
            ("Q3_ms", "q3_ms"),
        ],
        "quali_telemetry": [
            ("season", "season", "int"), ("round", "round", "int"), ("Driver", "driver_code"), ("DriverNumber", "driver_number"), ("Compound", "tyre_compound"), ("LapTime_ms", "lap_time_ms"),
            ("Distance", "distance_m"), ("Speed", "speed_kmh"), ("RPM", "rpm"), ("nGear", "gear"), ("Throttle", "throttle_pct"), ("Brake", "is_braking", "boolean"), ("DRS", "drs"), ("X", "x"), ("Y", "y"),
        ],
        "race_control_messages": [
            ("season", "season", "int"), ("round", "round", "int"), ("Time", "message_utc", "timestamp"), ("SessionTime_ms", "session_time_ms", "bigint"), ("Lap", "lap_number", "int"), ("Category", "category"),
            ("Flag", "flag"), ("Scope", "scope"), ("Sector", "sector", "int"), ("RacingNumber", "driver_number", "int"), ("Message", "message"), ("Status", "status"),
        ],
        "weather": [
            ("season", "season", "int"), ("round", "round", "int"), ("Date", "sample_utc", "timestamp"), ("Time_ms", "session_time_ms", "bigint"), ("AirTemp", "air_temperature_c", "double"),
            ("TrackTemp", "track_temperature_c", "double"), ("Humidity", "humidity_pct", "double"), ("Pressure", "pressure_mbar", "double"), ("Rainfall", "is_raining", "boolean"),
            ("WindDirection", "wind_direction_deg", "int"), ("WindSpeed", "wind_speed_ms", "double"),
        ],
    },
    "dump": {
        "drivers": ["driver_ref", "forename", "surname", ("date_of_birth", "date_of_birth", "date"), "origin"],
        "lap_times": [("season", "season", "int"), ("round", "round", "int"), "driver_ref", ("lap", "lap_number", "int"), ("position", "position", "int"), ("time_ms", "lap_time_ms", "bigint"), "origin"],
        "pit_stops": [("season", "season", "int"), ("round", "round", "int"), "driver_ref", ("stop", "stop_number", "int"), ("lap", "lap_number", "int"), "local_time", ("duration_ms", "duration_ms", "bigint"), "origin"],
        "qualifying": [
            ("season", "season", "int"), ("round", "round", "int"), "driver_ref", "constructor_ref", ("car_number", "driver_number", "string"), ("position", "position", "int"), ("q1_ms", "q1_ms", "bigint"),
            ("q2_ms", "q2_ms", "bigint"), ("q3_ms", "q3_ms", "bigint"), "origin",
        ],
        "results": [
            ("season", "season", "int"), ("round", "round", "int"), "session_type", "driver_ref", "constructor_ref", ("car_number", "driver_number", "string"), ("position", "position", "int"), "position_text",
            ("points", "points", "double"), ("grid", "grid", "int"), ("laps", "laps", "int"), "status", ("time_ms", "time_ms", "bigint"), ("fastest_lap_rank", "fastest_lap_rank", "int"),
            ("fastest_lap_number", "fastest_lap_number", "int"), ("fastest_lap_ms", "fastest_lap_ms", "bigint"), "origin",
        ],
    },
}


def projection(feed: str, table: str) -> list[tuple[str, str | None, bool, str]]:
    """(source column, type or none, whether only its presence counts, name) of each column of a plain projection."""
    out = []
    for item in PROJECTIONS[feed][table]:
        source, name, kind = (item, item, None) if isinstance(item, str) else (*item, None)[:3]
        out.append((source, None if kind == PRESENT else kind, kind == PRESENT, name))
    return out


def project(df: DataFrame, feed: str, table: str) -> DataFrame:
    """A feed's table as its staging model: renamed, cast (bad values become null), other columns left out."""
    columns = []
    for source, kind, present, name in projection(feed, table):
        value = F.col(f"`{source}`")
        columns.append((value.isNotNull() if present else value.try_cast(kind) if kind else value).alias(name))
    return df.select(*columns)


def event_meetings(df: DataFrame) -> DataFrame:
    return df.select(F.col("meeting_key").cast("bigint"), _int("year").alias("season"), "meeting_name", "meeting_official_name", "country_name", "location", _yes("is_cancelled").alias("is_cancelled"))


def _int(c: str) -> Column:
    return F.col(c).try_cast("int")


def _ms(c: Column) -> Column:
    return F.round(c * 1000).cast("long")


def _yes(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("boolean"), F.lit(False))


def chart_laps(df: DataFrame) -> DataFrame:
    """Text lap charts: rows without a lap number are headings; '-' and other text in a time is no time."""
    behind = lambda c: duration_ms(F.regexp_replace(c, r"^\+", ""))
    tyre = F.upper(F.nullif(F.nullif(F.trim("tyre"), F.lit("")), F.lit("-")))
    status = F.col("status")
    return df.where(_int("lap").isNotNull()).select(
        _int("season").alias("season"), _int("round").alias("round"), F.col("car_number").alias("driver_number"), "driver_name", _int("lap").alias("lap_number"), _int("rank").alias("position"),
        duration_ms("lap_time").alias("lap_time_ms"), duration_ms("time").alias("race_time_ms"), behind("gap").alias("gap_to_leader_ms"), F.regexp_extract("gap", r"\+(\d+) Lap", 1).try_cast("int").alias("gap_to_leader_laps"), behind("interval").alias("interval_ms"),
        *[duration_ms(f"sector_{i}").alias(f"sector_{i}_ms") for i in (1, 2, 3)], code_map(tyre, COMPOUNDS).alias("tyre_compound"), _int("tyre_age").alias("tyre_age_laps"),
        status.contains("Pit").alias("is_pit_in_lap"), status.contains("Out Lap").alias("is_pit_out_lap"), status.contains("Yellow Flag").alias("is_yellow_flag"), status.rlike("(^|, )Safety Car").alias("is_safety_car"),
        status.contains("Virtual Safety Car").alias("is_virtual_safety_car"), status.contains("Red Flag").alias("is_red_flag"),
    )


def timing_laps(df: DataFrame) -> DataFrame:
    """Session timing: the packed track status holds 2 yellow, 4 safety car, 5 red, 6 or 7 virtual safety car."""
    status = F.coalesce("TrackStatus", F.lit(""))
    return df.select(
        _int("season").alias("season"), _int("round").alias("round"), F.col("Driver").alias("driver_code"), F.col("DriverNumber").alias("driver_number"), _int("LapNumber").alias("lap_number"), _int("Position").alias("position"),
        F.col("LapTime_ms").alias("lap_time_ms"), F.col("Time_ms").alias("session_time_ms"), F.col("LapStartTime_ms").alias("lap_start_session_time_ms"), *[F.col(f"Sector{i}Time_ms").alias(f"sector_{i}_ms") for i in (1, 2, 3)],
        _int("Stint").alias("stint"), placeholder_null("Compound", NO_COMPOUND).alias("tyre_compound"), _int("TyreLife").alias("tyre_age_laps"), F.col("FreshTyre").alias("is_fresh_tyre"), F.col("PitInTime_ms").isNotNull().alias("is_pit_in_lap"), F.col("PitOutTime_ms").isNotNull().alias("is_pit_out_lap"),
        has_code(status, "2").alias("is_yellow_flag"), has_code(status, "4").alias("is_safety_car"), has_code(status, "67").alias("is_virtual_safety_car"), has_code(status, "5").alias("is_red_flag"), _yes("Deleted").alias("is_deleted"), F.col("IsAccurate").alias("is_accurate"), F.col("SpeedST").alias("speed_trap_kmh"),
    )


def timing_results(df: DataFrame) -> DataFrame:
    return df.select(
        _int("season").alias("season"), _int("round").alias("round"), F.col("DriverNumber").alias("driver_number"), F.col("Abbreviation").alias("driver_code"), F.col("FullName").alias("full_name"), F.col("TeamName").alias("team_name"),
        F.concat(F.lit("#"), F.nullif(F.col("TeamColor"), F.lit(""))).alias("team_color"), F.col("HeadshotUrl").alias("headshot_url"), _int("Position").alias("position"), _int("GridPosition").alias("grid_position"), F.col("Status").alias("status"), F.col("Points").alias("points"),
    )


def event_laps(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("session_key").cast("bigint"), _int("driver_number").alias("driver_number"), _int("lap_number").alias("lap_number"), utc_timestamp("date_start").alias("date_start_utc"), _ms(F.col("lap_duration")).alias("lap_time_ms"),
        *[_ms(F.col(f"duration_sector_{i}")).alias(f"sector_{i}_ms") for i in (1, 2, 3)], _yes("is_pit_out_lap").alias("is_pit_out_lap"), F.col("i1_speed").alias("speed_i1_kmh"), F.col("i2_speed").alias("speed_i2_kmh"), F.col("st_speed").alias("speed_trap_kmh"),
    )


def event_positions(df: DataFrame) -> DataFrame:
    return df.select(F.col("session_key").cast("bigint"), _int("driver_number").alias("driver_number"), utc_timestamp("date").alias("date_utc"), _int("position").alias("position"))


def event_pits(df: DataFrame) -> DataFrame:
    return df.select(F.col("session_key").cast("bigint"), _int("driver_number").alias("driver_number"), _int("lap_number").alias("lap_number"), utc_timestamp("date").alias("date_utc"), _ms(F.coalesce("lane_duration", "pit_duration")).alias("lane_time_ms"), _ms(F.col("stop_duration")).alias("stop_time_ms"))


def event_stints(df: DataFrame) -> DataFrame:
    return df.select(F.col("session_key").cast("bigint"), _int("driver_number").alias("driver_number"), _int("stint_number").alias("stint"), _int("lap_start").alias("lap_start"), _int("lap_end").alias("lap_end"), placeholder_null("compound", NO_COMPOUND).alias("tyre_compound"), _int("tyre_age_at_start").alias("tyre_age_at_start"))


def event_messages(df: DataFrame) -> DataFrame:
    return df.select(F.col("session_key").cast("bigint"), utc_timestamp("date").alias("message_utc"), _int("lap_number").alias("lap_number"), "category", "flag", "scope", _int("sector").alias("sector"), _int("driver_number").alias("driver_number"), "message")


def event_sessions(df: DataFrame) -> DataFrame:
    """The local date is that of the start at the circuit's own offset."""
    start = utc_timestamp("date_start")
    return df.select(
        F.col("session_key").cast("bigint"), F.col("meeting_key").cast("bigint"), _int("year").alias("season"), "session_name", "session_type", start.alias("date_start_utc"), utc_timestamp("date_end").alias("date_end_utc"),
        local_date(start, "gmt_offset").alias("local_date"), F.col("circuit_key").cast("bigint"), "circuit_short_name", "country_code", "country_name", "location", _yes("is_cancelled").alias("is_cancelled"),
    )


def event_results(df: DataFrame) -> DataFrame:
    """duration and position may be numbers, texts or lists: only numbers count."""
    position = F.trim(F.regexp_replace(F.col("position").cast("string"), '"', "")).try_cast("double").try_cast("int")
    return df.select(F.col("session_key").cast("bigint"), _int("driver_number").alias("driver_number"), position.alias("position"), _int("number_of_laps").alias("laps"), *[_yes(c).alias(f"is_{c}") for c in ("dnf", "dns", "dsq")], _ms(json_number("duration")).alias("time_ms"), F.col("gap_to_leader").alias("gap_to_leader_json"), F.col("points").cast("double").alias("points"))


def event_weather(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("session_key").cast("bigint"), utc_timestamp("date").alias("sample_utc"), F.col("air_temperature").alias("air_temperature_c"), F.col("track_temperature").alias("track_temperature_c"), F.col("humidity").alias("humidity_pct"), F.col("pressure").alias("pressure_mbar"),
        (F.col("rainfall") > 0).alias("is_raining"), _int("wind_direction").alias("wind_direction_deg"), F.col("wind_speed").alias("wind_speed_ms"),
    )


def dump_laps(laps: DataFrame, races: DataFrame, results: DataFrame) -> DataFrame:
    """Laps of an old dump with season and round, and the car number of the driver's result in that race."""
    numbers = results.groupBy("raceId", "driverId").agg(F.min(F.col("number").try_cast("int").cast("string")).alias("driver_number"))
    out = laps.join(races.select("raceId", "year", "round"), "raceId").join(numbers, ["raceId", "driverId"], "left")
    return out.select(_int("year").alias("season"), _int("round").alias("round"), "driver_number", _int("lap").alias("lap_number"), _int("position").alias("position"), F.col("milliseconds").try_cast("bigint").alias("lap_time_ms"))


def official_totals(drivers: DataFrame, constructors: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Precomputed totals of both kinds of entity (source column -> name), for parity checks; a column that one lacks is null."""
    one = lambda df, kind: df.select(F.lit(kind).alias("entity_type"), F.col("id").alias("entity_id"), *[(F.col(c) if c in df.columns else F.lit(None)).cast("double").alias(n) for c, n in columns.items()])
    return one(drivers, "driver").unionByName(one(constructors, "constructor"))


def message_event(message: str = "message", flag: str = "flag", category: str = "category", scope: str = "scope") -> Column:
    """The class of a race-control message, or null. The texts are the feed's. Fixed values."""
    begins = lambda *texts: F.exists(F.array(*map(F.lit, texts)), lambda t: F.col(message).startswith(t))
    clear = (F.col(category) == "Flag") & (F.col(scope) == "Track") & F.col(flag).isin("CLEAR", "GREEN")
    return classify([
        ((F.col(flag) == "RED") | begins("RED FLAG"), "red_flag"), (begins("VIRTUAL SAFETY CAR DEPLOYED", "VSC DEPLOYED"), "vsc_deployed"), (begins("VIRTUAL SAFETY CAR ENDING", "VSC ENDING"), "vsc_ending"),
        (begins("SAFETY CAR DEPLOYED"), "safety_car_deployed"), (begins("SAFETY CAR IN THIS LAP"), "safety_car_in"), (clear, "track_clear"), (F.col(flag) == "CHEQUERED", "chequered_flag"),
    ])
