"""The race pipeline's feature steps, each a composition of the general operators."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.scalars import before, finished, list_mean, number
from paceline.operators.grouped import correlation_by, correlation_by_cutoff, fill_global_median, fill_group_median, medians_by_cutoff
from paceline.operators.history import Career, Recent, RunningSum, with_history
from paceline.operators.joins import RACE, attach, sprint_features, with_circuit
from paceline.operators.ranking import dense_scaled_rank
from paceline.operators.skew import MARK, HotGroups, hot_groups, hot_groups_of_each, lookup_side, max_group_rows
from paceline.session import durable, fresh_path
from paceline.sources.tables import with_defaults

ENTITY = "DriverKey"
# An entity has one row per race; repeated rows keep the stored order, by grid.
ORDER = ["year", "round", "grid"]

# What stands in where there is no history, and the timing columns.
FORM_FILL = 13.0
CAREER_FILL = 14.0
IMPORTANCE_FILL = 0.5
TIMING = ["avg_race_pace", "best_lap", "pitstops_count", "mean_pit_loss"]
PACE = {"career_race_pace": "avg_race_pace", "career_best_lap": "best_lap", "career_pit_loss": "mean_pit_loss"}


def form(df: DataFrame, hot: HotGroups | None = None) -> DataFrame:
    """Recent form on the grid and in the race: the last three starts."""
    df = df.withColumns({c: number(c) for c in ("grid", "position")})
    features = [Recent("form_grid", "grid", 3, FORM_FILL), Recent("form_race", "position", 3, FORM_FILL)]
    return with_history(df, [ENTITY], ORDER, features, hot)


def circuit_importance(df: DataFrame, calendar: DataFrame | None, cutoff=None) -> DataFrame:
    """How closely finishing follows the grid at each circuit, over finishers.

    All rows count, as published; with ``cutoff`` only races before it.
    """
    if calendar is None:
        return df.withColumn("circuit_importance", F.lit(IMPORTANCE_FILL))
    df = with_circuit(df, calendar).withColumn("circuitId", F.coalesce("circuitId", F.lit("unknown")))
    finishers = df.where(finished("status"))
    if cutoff:
        finishers = finishers.where(before(*RACE, cutoff))
    table = correlation_by(finishers, "circuitId", "grid", "position", "circuit_importance", IMPORTANCE_FILL)
    return df.join(lookup_side(table), "circuitId", "left").fillna(IMPORTANCE_FILL, ["circuit_importance"])


def attach_timing(df: DataFrame, extra: DataFrame):
    """(starts with what their race timing has of the timing columns, the names of these)."""
    if "pit_losses" in extra.columns and "mean_pit_loss" not in extra.columns:
        extra = extra.withColumn("mean_pit_loss", list_mean("pit_losses"))
    df = attach(df, extra, [*RACE, ENTITY], TIMING, null_safe=[ENTITY])
    known = [c for c in TIMING if c in df.columns]
    return df.withColumns({c: F.col(c).cast("double") for c in known}), known


def timing(df: DataFrame, extra: DataFrame | None, cutoff=None, rows=None) -> DataFrame:
    """Race timing; gaps take the column's median, missing columns are zero.

    ``rows`` is the number of starts, where the caller knows it. Many starts are written with
    their timing, since the medians need them before the steps that follow do.
    """
    if extra is None:
        return df.withColumns({c: F.lit(0.0) for c in TIMING})
    rows = df.count() if rows is None else rows
    df, known = attach_timing(df, extra)
    if rows > max_group_rows(df.sparkSession):
        df = durable(df)
    of = df.where(before(*RACE, cutoff)) if cutoff else None
    return with_defaults(fill_global_median(df, known, of=of, rows=rows), {c: 0.0 for c in TIMING})


def driver_history(
    df: DataFrame, hot: HotGroups | None = None, hot_seasons: HotGroups | None = None, cutoff=None
) -> DataFrame:
    """Career and circuit means over earlier races, and pace ranked within the season.

    Gaps in career pace take the driver's median over all races, and a season is
    ranked as a whole; with ``cutoff`` the races from it on do not affect earlier ones.
    """
    df = with_defaults(df, {c: 0.0 for c in PACE.values()})
    hot = hot_groups(df, [ENTITY]) if hot is None else hot
    df = hot.mark(df)
    career = [Career("career_grid_avg", "grid", CAREER_FILL), Career("career_race_avg", "position", CAREER_FILL)]
    career += [Career(name, column) for name, column in PACE.items()]
    df = with_history(df, [ENTITY], ORDER, career, hot)
    skill = {"circuit_grid_skill": "grid", "circuit_race_skill": "position"}
    if "circuitId" in df.columns:
        # a pair can only be hot if its entity is
        pairs = [Career(n, c, CAREER_FILL) for n, c in skill.items()]
        df = with_history(df, [ENTITY, "circuitId"], ORDER, pairs, hot.within("circuitId"))
    else:
        df = df.withColumns({n: F.lit(CAREER_FILL) for n in skill})
    known = before(*RACE, cutoff) if cutoff else None
    df = fill_group_median(df, [ENTITY], list(PACE), hot, known).drop(MARK)
    hot_seasons = hot_groups(df, ["year"]) if hot_seasons is None else hot_seasons
    if not cutoff:
        return dense_scaled_rank(df, ["year"], "career_race_pace", "pace_rank_season", hot=hot_seasons)
    df = df.withColumn("_known", known)
    return dense_scaled_rank(df, ["year", "_known"], "career_race_pace", "pace_rank_season", hot=hot_seasons).drop("_known")


def enrich(results: DataFrame, calendar=None, extra=None, cutoff=None) -> DataFrame:
    """All feature steps. ``cutoff`` keeps whole-table statistics to earlier races.

    Sizes are looked up once, on the stored results: the steps add columns, and only
    repeated rows in a context table could add rows.
    """
    if ENTITY not in results.columns:
        results = results.withColumn(ENTITY, F.lower("DriverName"))
    hot, hot_seasons = hot_groups_of_each(results, ENTITY, "year")
    df = form(hot.mark(results), hot)
    df = circuit_importance(df, calendar, cutoff)
    df = timing(df, extra, cutoff, hot.rows)
    df = sprint_features(df)
    return driver_history(df, hot, hot_seasons, cutoff)


CUTOFF = "_cutoff"


def enrich_by_season(results: DataFrame, seasons, calendar=None, extra=None) -> DataFrame:
    """All feature steps with whole-table statistics from before a season, for many seasons in one pass.

    A row for every start and each of ``seasons`` that is its own or a later one, with the season in
    CUTOFF: what ``enrich`` gives with the cutoff (season, 0). The results are read once. What does not
    depend on a cutoff is computed once for each start: form, grid and finish histories, and how many
    earlier starts have which sum of known timing and how many gaps. A cutoff then only puts its own
    medians into those gaps, and its own circuits' importance beside them; medians and importance
    come from one pass over the starts for all cutoffs. The table is written by season.
    """
    seasons = sorted(seasons)
    if ENTITY not in results.columns:
        results = results.withColumn(ENTITY, F.lower("DriverName"))
    hot, hot_seasons = hot_groups_of_each(results, ENTITY, "year")
    starts, known = _starts(hot.mark(results), calendar, extra, hot)
    starts = durable(starts)
    at = F.filter(F.array(*[F.lit(s) for s in seasons]).cast("array<int>"), lambda s: s >= F.col("year"))
    rows = starts.withColumn(CUTOFF, F.explode(at))
    if calendar is not None:
        finishers = starts.where(finished("status"))
        importance = correlation_by_cutoff(
            finishers, "circuitId", "year", "grid", "position", "circuit_importance", IMPORTANCE_FILL, seasons
        ).withColumnRenamed("year", CUTOFF)
        rows = rows.join(lookup_side(importance), ["circuitId", CUTOFF], "left").fillna(IMPORTANCE_FILL, ["circuit_importance"])
    for c in known:
        middle = medians_by_cutoff(starts, "year", c, f"_mid_{c}", cutoffs=seasons).withColumnRenamed("year", CUTOFF)
        rows = rows.join(lookup_side(middle), CUTOFF, "left").withColumn(f"_mid_{c}", F.coalesce(f"_mid_{c}", F.lit(0.0)))
    rows = rows.withColumns({c: F.coalesce(c, f"_mid_{c}") for c in known})
    rows = rows.withColumns({name: _career_at_cutoff(c, c in known) for name, c in PACE.items()})
    rows = rows.drop("_earlier", *[f"_{part}_{c}" for c in TIMING for part in ("mid", "raw", "gap", "sum", "gaps")])
    seen = F.col("year") < F.col(CUTOFF)
    rows = fill_group_median(rows, [ENTITY, CUTOFF], list(PACE), hot.within(CUTOFF), seen).drop(MARK).withColumn("_known", seen)
    ranked = dense_scaled_rank(rows, ["year", CUTOFF, "_known"], "career_race_pace", "pace_rank_season", hot=hot_seasons).drop("_known")
    return by_season(ranked)


def _starts(results, calendar, extra, hot):
    """(starts with all that no cutoff changes, the timing columns that have gaps to fill)."""
    df = form(results, hot)
    if calendar is None:
        df = df.withColumn("circuit_importance", F.lit(IMPORTANCE_FILL))
    else:
        df = with_circuit(df, calendar).withColumn("circuitId", F.coalesce("circuitId", F.lit("unknown")))
    df, known = attach_timing(df, extra) if extra is not None else (df, [])
    df = sprint_features(with_defaults(df, {c: 0.0 for c in [*TIMING, *PACE.values()]}))
    df = df.withColumns({f"_raw_{c}": F.coalesce(F.col(c), F.lit(0.0)) for c in PACE.values()})
    df = df.withColumns({f"_gap_{c}": F.col(c).isNull().cast("long") for c in PACE.values()}).withColumn("_one", F.lit(1).cast("long"))
    features = [Career("career_grid_avg", "grid", CAREER_FILL), Career("career_race_avg", "position", CAREER_FILL)]
    features += [RunningSum(f"_sum_{c}", f"_raw_{c}") for c in PACE.values()] + [RunningSum(f"_gaps_{c}", f"_gap_{c}") for c in PACE.values()]
    df = with_history(df, [ENTITY], ORDER, [*features, RunningSum("_earlier", "_one")], hot).drop("_one")
    skill = {"circuit_grid_skill": "grid", "circuit_race_skill": "position"}
    if "circuitId" not in df.columns:
        return df.withColumns({n: F.lit(CAREER_FILL) for n in skill}), known
    pairs = [Career(n, c, CAREER_FILL) for n, c in skill.items()]
    return with_history(df, [ENTITY, "circuitId"], ORDER, pairs, hot.within("circuitId")), known


def _career_at_cutoff(column, has_gaps):
    """The mean over earlier starts, whose gaps the cutoff's median fills."""
    total = F.col(f"_sum_{column}")
    if has_gaps:
        total = total + F.col(f"_gaps_{column}") * F.col(f"_mid_{column}")
    return F.when(F.col("_earlier") > 0, total / F.col("_earlier"))


def by_season(rows: DataFrame) -> DataFrame:
    """The rows, written with a folder for each cutoff, so that a season's reader opens its own files only."""
    path = fresh_path(rows.sparkSession)
    rows.write.partitionBy(CUTOFF).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
