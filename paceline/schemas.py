"""Fixed schemas of the stored tables and of the landed files, as DDL."""

RESULTS = (
    "DriverKey string, DriverName string, Team string, grid double, position double, "
    "status string, points string, circuitId string, year int, round int"
)
CALENDAR = "year int, round int, raceName string, circuitId string, date string"
SPRINT = (
    "DriverKey string, DriverName string, Team string, sprint_grid double, sprint_pos double, "
    "status string, sprint_points double, year int, round int"
)
QUALIFYING = "DriverKey string, DriverName string, Team string, grid double, year int, round int"
TIMING = (
    "year int, round int, DriverNumber string, DriverKey string, DriverName string, Team string, "
    "avg_race_pace double, best_lap double, pitstops_count bigint, mean_pit_loss double, stint_count bigint, "
    "stint1_length double, stint1_avg double, stint1_compound string, "
    "stint2_length double, stint2_avg double, stint2_compound string, "
    "stint3_length double, stint3_avg double, stint3_compound string, "
    "compound_first_stint string, compound_changes bigint, degradation_global double, long_run_consistency double"
)
LAPS = (
    "year int, round int, driver_number string, lap_number int, LapTime interval day to second, "
    "PitInTime interval day to second, PitOutTime interval day to second, Stint double, Compound string"
)
DRIVER_INFO = (
    "year int, round int, driver_number string, FirstName string, LastName string, FullName string, TeamName string"
)

ENTRY = (
    "struct<Driver: struct<givenName: string, familyName: string>, Constructor: struct<name: string>, "
    "number: string, position: string, grid: string, points: string, status: string, circuitId: string>"
)
RACE = (
    "struct<season: string, round: string, raceName: string, date: string, Circuit: struct<circuitId: string>, "
    f"Results: array<{ENTRY}>, QualifyingResults: array<{ENTRY}>, SprintResults: array<{ENTRY}>>"
)
RESPONSE = f"MRData struct<RaceTable: struct<Races: array<{RACE}>>>"
