"""Enrich, encode, split by time, train, score and rank."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.scalars import before, finished
from paceline.operators.catalog import choose_entries, find_races, participants, with_display_name
from paceline.operators.grouped import global_medians, group_median
from paceline.operators.joins import RACE, as_of_cutoff, as_of_previous
from paceline.operators.ranking import encode_labels, finishing_order, label_index, label_index_by_cutoff, label_side
from paceline.operators.skew import lookup_side
from paceline.plans.features import CUTOFF, ENTITY, ORDER, PACE, by_season, enrich, enrich_by_season
from paceline.plans.load import load_facts, read_stored
from paceline.plans.models import ForestSettings, TwoStage, score, train
from paceline.session import durable
from paceline.sources.tables import read_race

LABELS = {ENTITY: "driver_id", "Team": "team_id", "circuitId": "circuit_id"}
RESULT = [*RACE, ENTITY, "DriverName", "Team", "Grid_Input", "Course_Score", "Grid", "Pos", "Delta"]

# Stats of an entity without an earlier race, and the fallbacks for the
# timing medians where the column is missing.
SCORING_DEFAULTS = {
    "form_grid": 13.0, "form_race": 15.0, "career_grid_avg": 14.0, "career_race_avg": 14.0,
    "circuit_grid_skill": 14.0, "circuit_race_skill": 14.0, "pace_rank_season": 0.5,
}
TIMING_DEFAULTS = {"career_race_pace": 95.0, "career_best_lap": 95.0, "career_pit_loss": 25.0}


@dataclass(frozen=True)
class Encoders:
    """One (label, number) lookup per encoded column; ``within`` are columns that a lookup has besides."""

    tables: dict
    within: tuple = ()

    @classmethod
    def fit(cls, df: DataFrame, cutoff=None):
        rows = df.where(before(*RACE, cutoff)) if cutoff else df
        present = {c: name for c, name in LABELS.items() if c in df.columns}
        return cls({c: label_side(label_index(rows, c, name), c, name) for c, name in present.items()})

    def apply(self, df: DataFrame, unknown_circuit=0) -> DataFrame:
        """Unknown drivers and teams drop the row; an unknown circuit counts as 0."""
        for column, name in LABELS.items():
            if column not in self.tables:
                df = df.withColumn(name, F.lit(0))
            else:
                unknown = unknown_circuit if column == "circuitId" else None
                df = encode_labels(df, self.tables[column], column, name, unknown, self.within)
        return df


def encode(df: DataFrame, cutoff=None):
    """(finishers with numbered labels, encoders). Labels come from all rows."""
    encoders = Encoders.fit(df, cutoff)
    return encoders.apply(df.where(finished("status"))), encoders


def scoring_defaults(df: DataFrame) -> dict:
    medians = global_medians(df, [c for c in PACE if c in df.columns])
    return {**SCORING_DEFAULTS, **TIMING_DEFAULTS, **medians}


def race_entries(enriched: DataFrame, entries: DataFrame, year, rnd, defaults=None) -> DataFrame:
    """Scoring rows of one race: each entry with its last row strictly before the race.

    The last row's features are those it had before its own race. The race's circuit
    and its importance come from the fact table; a race not there counts as unknown.
    """
    stats = defaults or scoring_defaults(enriched)
    stats = {c: v for c, v in stats.items() if c in enriched.columns}
    rows = as_of_cutoff(enriched, entries, ENTITY, *RACE, (year, rnd), stats, tie=ORDER[2:])
    known = read_race(enriched, year, rnd, ["circuit_importance", "circuitId"]).first()
    known = known.asDict() if known else {}
    return rows.withColumns(
        {
            "circuit_importance": F.lit(known.get("circuit_importance", 0.5)),
            "circuitId": F.lit(known.get("circuitId", "unknown")),
            "year": F.lit(year),
            "round": F.lit(rnd),
            "has_sprint": F.lit(0),
            "sprint_delta": F.lit(0.0),
        }
    )


def season_entries(enriched: DataFrame, wanted, defaults=None, fresh=False) -> DataFrame:
    """Scoring rows of many races at once (``wanted`` is a condition on the races).

    As in the single-race form an entry gets the row before it; ``fresh`` uses the
    features of the race itself, which know the last result and this circuit.
    """
    stats = defaults or scoring_defaults(enriched)
    stats = {c: v for c, v in stats.items() if c in enriched.columns}
    if fresh:
        rows = enriched.fillna(stats)
    else:
        rows = as_of_previous(enriched, ENTITY, ORDER, stats, RACE)
    off = {"has_sprint": F.lit(0), "sprint_delta": F.lit(0.0)}
    return rows.where(wanted).withColumns(off)


def rank(scored: DataFrame, race=RACE) -> DataFrame:
    return finishing_order(scored, list(race), "Grid_Input", "Course_Score", ENTITY)


def train_before(enriched: DataFrame, cutoff, settings: ForestSettings | None = None, leak_free=False):
    """(models, encoders) from the finishers strictly before the cutoff race."""
    finishers, encoders = encode(enriched, cutoff if leak_free else None)
    return train(finishers.where(before(*RACE, cutoff)), settings), encoders


def predict_race(
    models: TwoStage, encoders: Encoders, enriched, entries, year, rnd, use_real=False, defaults=None
) -> DataFrame:
    rows = encoders.apply(race_entries(enriched, entries, year, rnd, defaults))
    rows = with_display_name(rows, enriched, ORDER)
    return rank(score(models, rows, use_real))


def forecast(
    results: DataFrame,
    year,
    rnd,
    calendar=None,
    extra=None,
    use_real_grid=False,
    latest_qualifying=None,
    entries=None,
    settings: ForestSettings | None = None,
    leak_free=False,
    top=None,
) -> DataFrame:
    """Predicted finishing order of one race with keys and scores, first places first.

    ``entries`` (DriverKey, Team, optional grid) serves a race without rows yet; ``top``
    keeps the first places only.
    """
    cutoff = (year, rnd)
    enriched = durable(enrich(results, calendar, extra, cutoff if leak_free else None))
    models, encoders = train_before(enriched, cutoff, settings, leak_free)
    if entries is None:
        entries = participants(enriched, year, rnd)
    entries, use_real = choose_entries(entries, latest_qualifying, year, rnd, use_real_grid)
    defaults = scoring_defaults(enriched.where(before(*RACE, cutoff)) if leak_free else enriched)
    ranked = predict_race(models, encoders, enriched, entries, year, rnd, use_real, defaults)
    ranked = ranked.select(*RESULT).orderBy("Pos")
    return ranked if top is None else ranked.limit(top)


def walk_forward(results, seasons, calendar=None, extra=None, settings=None, fresh=False, leak_free=False) -> DataFrame:
    """Every race of some seasons, in both modes: predicted grid and real grid.

    Each season is scored by models trained on the rows before it. Features, labels, scoring
    rows and training rows are made once for all seasons; per season there is only the
    training. ``leak_free`` takes every statistic from what came before the season, too.
    """
    seasons = sorted(seasons)
    prepare = _leak_free_rows if leak_free else _published_rows
    training, wanted = prepare(results, seasons, calendar, extra, fresh)
    rows = durable(wanted).withColumn("mode", F.explode(F.array(F.lit("oracle"), F.lit("analyst"))))
    parts = []
    for season in seasons:
        models = train(training(season), settings)
        parts.append(score(models, rows.where(F.col("year") == season), F.col("mode") == "analyst"))
    return rank(reduce(DataFrame.unionByName, parts), [*RACE, "mode"])


def _published_rows(results, seasons, calendar, extra, fresh):
    """(season to its training rows, scoring rows of the seasons), statistics from the whole table."""
    enriched = durable(enrich(results, calendar, extra))
    finishers, encoders = encode(enriched)
    finishers = durable(finishers)
    wanted = season_entries(enriched, F.col("year").isin(seasons), scoring_defaults(enriched), fresh)
    return lambda season: finishers.where(before(*RACE, (season, 0))), encoders.apply(wanted)


def _leak_free_rows(results, seasons, calendar, extra, fresh):
    """The same from what came before each season: one table of (start, season) rows for all of them."""
    enriched = enrich_by_season(results, seasons, calendar, extra)
    earlier = F.col("year") < F.col(CUTOFF)
    labels = enriched.where(F.col(CUTOFF) == seasons[-1])  # all starts up to the last season
    tables = {}
    for column, name in LABELS.items():
        if column in enriched.columns:
            numbered = label_index_by_cutoff(labels, column, name, "year", seasons)
            tables[column] = label_side(numbered.withColumnRenamed("year", CUTOFF), column, name)
    encoders = Encoders(tables, (CUTOFF,))
    wanted = encoders.apply(_entries_by_season(enriched, earlier, fresh)).drop(CUTOFF)
    finishers = by_season(encoders.apply(enriched.where(earlier & finished("status"))))
    return lambda season: finishers.where(F.col(CUTOFF) == season).drop(CUTOFF), wanted


def _entries_by_season(enriched, earlier, fresh):
    """``season_entries`` for each cutoff's own season, with the cutoff's own medians where there is no earlier start."""
    medians = {}
    for c in PACE:
        middle = group_median(enriched.where(earlier), [CUTOFF], c, f"_default_{c}")
        enriched, medians[c] = enriched.join(lookup_side(middle), CUTOFF, "left"), f"_default_{c}"
    stats = {**{c: v for c, v in SCORING_DEFAULTS.items() if c in enriched.columns}, **dict.fromkeys(PACE)}
    if fresh:
        rows = enriched.fillna({c: v for c, v in stats.items() if v is not None})
    else:
        rows = as_of_previous(enriched, [ENTITY, CUTOFF], ORDER, stats, RACE)
    rows = rows.where(F.col("year") == F.col(CUTOFF)).withColumns({c: F.coalesce(c, m) for c, m in medians.items()})
    return rows.drop(*medians.values()).withColumns({"has_sprint": F.lit(0), "sprint_delta": F.lit(0.0)})


def forecast_by_name(spark, folder, name, season, use_real_grid=False, settings=None, fmt="parquet", top=None):
    """Forecast the race whose name matches, from the stored tables.

    None where no results are stored or the season has no such race.
    """
    facts, calendar = load_facts(spark, folder, fmt), read_stored(spark, folder, "calendar", fmt)
    if facts is None or calendar is None:
        return None
    race = find_races(calendar, name).where(F.col("year") == season).first()
    if race is None:
        return None
    extra, latest = (read_stored(spark, folder, t, fmt) for t in ("extra", "latest_qualifying"))
    return forecast(facts, season, race["round"], calendar, extra, use_real_grid, latest, settings=settings, top=top)
