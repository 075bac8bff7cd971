"""Lap timing to one row per driver and race.

The laps are the largest input. Everything but the median, the order of compounds
and the stint numbers is an aggregate with map-side combine; stints are aggregated
first and numbered afterwards, so numbering sees stints and not laps.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.scalars import at_zero, seconds, without_nan
from paceline.operators.grouped import with_group_median
from paceline.operators.history import Carried, with_history
from paceline.operators.ranking import number_rows
from paceline.operators.skew import HotGroups, hot_groups

DRIVER_RACE = ("year", "round", "DriverNumber")
IDENTITY = ("DriverKey", "DriverName", "Team")
STORED_STINTS = 3


def lap_seconds(laps: DataFrame) -> DataFrame:
    """Landed laps with durations as seconds and pit times as a flag; NaN stints count as unknown."""
    pit = F.col("PitInTime").isNotNull() | F.col("PitOutTime").isNotNull()
    return without_nan(laps).select(
        *[c for c in laps.columns if c not in ("LapTime", "PitInTime", "PitOutTime")],
        seconds("LapTime").alias("lap"),
        pit.alias("pit"),
    )


def pace(laps: DataFrame, keys, lap="lap", pit="pit", hot: HotGroups | None = None) -> DataFrame:
    """Mean, best and spread of lap times, pit laps and the mean time lost in them.

    A lap into the pits and the lap out of them each count. The loss of a pit lap is
    its time above the driver's median, at least zero. Drivers without any lap time
    drop out.
    """
    rows = with_group_median(laps, keys, {"_median": lap}, hot)
    return _timed(rows.groupBy(*keys).agg(*_pace_measures(lap, pit)))


def _pace_measures(lap, pit):
    time = F.col(lap)
    return [
        F.avg(time).alias("avg_race_pace"),
        F.min(time).alias("best_lap"),
        F.count_if(F.col(pit)).alias("pitstops_count"),
        F.avg(F.when(F.col(pit), at_zero(time - F.col("_median")))).alias("mean_pit_loss"),
        F.stddev_samp(time).alias("long_run_consistency"),
        F.count(time).alias("_timed"),
    ]


def _timed(rows):
    return rows.where(F.col("_timed") > 0).drop("_timed")


def stints(
    laps: DataFrame, keys, stint="Stint", lap="lap", compound="Compound", order=("lap_number",), hot=None
) -> DataFrame:
    """Stint count, the first three stints side by side, and the pace lost over the race.

    The loss is the last stint's mean minus the first's, null beyond three stints.
    ``hot`` holds the hot groups of the laps; without any, there are few stints too.
    """
    keys = list(keys)
    place = F.struct(*order)
    each = (
        laps.where(F.col(stint).isNotNull())
        .groupBy(*keys, F.col(stint).cast("int").alias("_stint"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("_length"),
            F.avg(lap).alias("_avg"),
            F.min_by(F.col(compound), F.when(F.col(compound).isNotNull(), place)).alias("_compound"),
        )
    )
    numbered = number_rows(each, keys, ["_stint"], "_k", None if hot else hot)
    wide = [
        F.max(F.when(F.col("_k") == k, F.col(f"_{c}"))).alias(f"stint{k}_{c}")
        for k in range(1, STORED_STINTS + 1)
        for c in ("length", "avg", "compound")
    ]
    rows = numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("stint_count"), *wide)
    means = F.array(*[F.col(f"stint{k}_avg") for k in range(1, STORED_STINTS + 1)])
    last = F.when(F.col("stint_count") <= STORED_STINTS, F.get(means, (F.col("stint_count") - 1).cast("int")))
    return rows.withColumns(
        {"compound_first_stint": F.col("stint1_compound"), "degradation_global": last - F.col("stint1_avg")}
    )


def compound_changes(laps: DataFrame, keys, order, compound="Compound", hot: HotGroups | None = None) -> DataFrame:
    """How often the compound changes along the laps; unknown laps carry the last one.

    After a forward fill only known compounds can differ from the lap before. Groups
    without any known compound have no changes.
    """
    rows = with_history(laps, keys, order, [_last_known(compound, order)], hot)
    return rows.groupBy(*keys).agg(_changes(compound))


def _last_known(compound, order):
    return Carried("_last_known", compound, tuple(order), own=False)


def _changes(compound):
    change = F.col(compound).isNotNull() & ~F.col(compound).eqNullSafe(F.col("_last_known"))
    return F.greatest(F.count_if(change) - 1, F.lit(0)).alias("compound_changes")


def timing_features(laps: DataFrame, keys=DRIVER_RACE, order=("lap_number",), identity=IDENTITY) -> DataFrame:
    """One row per driver and race with pace, stint and compound features.

    ``laps`` has lap (seconds), pit (flag), Stint and Compound columns; its keys are
    not null. The ``identity`` columns it has are the same on all laps of a group. The
    laps are shuffled once, for the median and the compounds; stints are aggregated
    before they are shuffled.
    """
    keys = list(keys)
    hot = hot_groups(laps, keys)
    rows = with_history(hot.mark(laps), keys, order, [_last_known("Compound", order)], hot)
    rows = with_group_median(rows, keys, {"_median": "lap"}, hot)
    who = [F.first(c).alias(c) for c in identity if c in laps.columns]
    base = _timed(rows.groupBy(*keys).agg(*who, *_pace_measures("lap", "pit"), _changes("Compound")))
    return base.join(stints(laps, keys, order=order, hot=hot), keys, "left").fillna(0, ["stint_count"])
