"""Features of an entity's earlier rows: recent form, career means, carried values.

``order`` is a list of column names, ascending with nulls last, and should name a
total order (end it with a tie-break). Rows whose key is null get null features.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.skew import RANGE, HotGroups, all_present, hot_groups, in_ranges

HALO = "_halo"
SPREAD = "_spread"
NULL_GROUPS = 4096


@dataclass(frozen=True)
class Recent:
    """Mean of ``column`` over the ``rows`` rows before the current one."""

    name: str
    column: str
    rows: int = 3
    fill: float | None = None
    running = False

    @property
    def reach(self):
        return self.rows

    def over(self, window):
        return F.avg(self.column).over(window.rowsBetween(-self.rows, -1))


@dataclass(frozen=True)
class Previous:
    """Value of ``column`` (a struct too) in the row before."""

    name: str
    column: str
    fill: float | None = None
    reach = 1
    running = False

    def over(self, window):
        return F.lag(self.column, 1).over(window)


@dataclass(frozen=True)
class Career:
    """Mean of ``column`` over all earlier rows."""

    name: str
    column: str
    fill: float | None = None
    reach = 0
    running = True

    def over(self, window):
        return F.avg(self.column).over(_before(window))

    def totals(self):
        return [F.sum(self.column).alias(f"{self.name}_sum"), F.count(self.column).alias(f"{self.name}_n")]

    def carry(self, window):
        return [F.sum(c).over(_before(window)).alias(c) for c in (f"{self.name}_sum", f"{self.name}_n")]

    def local(self, window, own):
        value = F.when(own, F.col(self.column))
        return {
            f"{self.name}_sum_here": F.sum(value).over(_before(window)),
            f"{self.name}_n_here": F.count(value).over(_before(window)),
        }

    def joined(self):
        rows = _plus(f"{self.name}_n", f"{self.name}_n_here")
        return F.when(rows > 0, _plus(f"{self.name}_sum", f"{self.name}_sum_here") / rows)


@dataclass(frozen=True)
class RunningSum:
    """Sum of a non-null ``column`` over all earlier rows, 0 for the first row."""

    name: str
    column: str
    fill: float | None = None
    reach = 0
    running = True

    def over(self, window):
        return F.coalesce(F.sum(self.column).over(_before(window)), F.lit(0))

    def totals(self):
        return [F.sum(self.column).alias(f"{self.name}_sum")]

    def carry(self, window):
        return [F.sum(f"{self.name}_sum").over(_before(window)).alias(f"{self.name}_sum")]

    def local(self, window, own):
        return {f"{self.name}_sum_here": F.sum(F.when(own, F.col(self.column))).over(_before(window))}

    def joined(self):
        return _plus(f"{self.name}_sum", f"{self.name}_sum_here")


@dataclass(frozen=True)
class Ordinal:
    """Row number in the group, from 1."""

    name: str
    fill: float | None = None
    column = None
    reach = 0
    running = True

    def over(self, window):
        return F.row_number().over(window)

    def totals(self):
        return [F.count(F.lit(1)).alias(f"{self.name}_n")]

    def carry(self, window):
        return [F.sum(f"{self.name}_n").over(_before(window)).alias(f"{self.name}_n")]

    def local(self, window, own):
        return {f"{self.name}_n_here": F.count(F.when(own, 1)).over(window.rowsBetween(Window.unboundedPreceding, 0))}

    def joined(self):
        return _plus(f"{self.name}_n", f"{self.name}_n_here")


@dataclass(frozen=True)
class Carried:
    """Forward fill: the last non-null ``column`` up to the current row, or before it."""

    name: str
    column: str
    order: tuple
    own: bool = True
    fill: float | None = None
    reach = 0
    running = True

    def _frame(self, window):
        return window.rowsBetween(Window.unboundedPreceding, 0) if self.own else _before(window)

    def over(self, window):
        return F.last(self.column, ignorenulls=True).over(self._frame(window))

    def totals(self):
        place = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in self.order])
        seen = F.max_by(F.col(self.column), F.when(F.col(self.column).isNotNull(), place))
        return [seen.alias(f"{self.name}_seen")]

    def carry(self, window):
        return [F.last(f"{self.name}_seen", ignorenulls=True).over(_before(window)).alias(f"{self.name}_seen")]

    def local(self, window, own):
        value = F.when(own, F.col(self.column))
        return {f"{self.name}_seen_here": F.last(value, ignorenulls=True).over(self._frame(window))}

    def joined(self):
        return F.coalesce(F.col(f"{self.name}_seen_here"), F.col(f"{self.name}_seen"))


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _plus(left, right) -> Column:
    return F.coalesce(F.col(left), F.lit(0)) + F.coalesce(F.col(right), F.lit(0))


def _ascending(order):
    return [F.col(c).asc_nulls_last() for c in order]


def with_history(df: DataFrame, keys, order, features, hot: HotGroups | None = None) -> DataFrame:
    """Add one column per feature, computed within ``keys`` along ``order``.

    ``hot`` may be passed when the caller has already looked for hot groups on
    these keys or on a coarser key.
    """
    keys, order, features = list(keys), list(order), list(features)
    hot = hot_groups(df, keys) if hot is None else hot
    if not hot:
        out = _by_window(df, keys, order, features, hot)
    else:
        ordinary, huge = hot.divide(df)
        out = _by_ranges(huge.where(all_present(keys)), keys, order, features, hot)
        if ordinary is not None:
            out = _by_window(ordinary, keys, order, features, hot).unionByName(out)
        if keys:
            # rows of a hot group may lack a finer key: they are in no group, and never share a task
            nulls = {f.name: F.lit(None).cast(out.schema[f.name].dataType) for f in features}
            out = out.unionByName(huge.where(~all_present(keys)).withColumns(nulls))
    filled = {f.name: F.coalesce(F.col(f.name), F.lit(f.fill)) for f in features if f.fill is not None}
    return out.withColumns(filled) if filled else out


def _by_window(df, keys, order, features, hot):
    df, by = spread_unkeyed(df, keys, hot)
    window = Window.partitionBy(*by).orderBy(*_ascending(order))
    known = all_present(keys)
    added = {f.name: F.when(known, f.over(window)) for f in features}
    return df.withColumns(added).drop(SPREAD)


def spread_unkeyed(df, keys, hot):
    """(rows, columns to partition a window by).

    Rows without a key are not a group. When there are many they are spread, so they
    cannot pile up in one task; their results are masked in any case.
    """
    if not keys:
        return df, [F.lit(0)]
    if not hot.many_unkeyed:
        return df, list(keys)
    spread = F.when(~all_present(keys), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_GROUPS)))
    return df.withColumn(SPREAD, spread), [*keys, SPREAD]


def _by_ranges(df, keys, order, features, hot):
    ranged = in_ranges(df, keys, order, hot)
    running = [f for f in features if f.running]
    rows = ranged.withColumn(HALO, F.lit(False))
    reach = max(f.reach for f in features)
    if reach:
        used = dict.fromkeys([*keys, *order, *(f.column for f in features if f.reach)])
        rows = rows.unionByName(_halo(ranged.select(*used, RANGE), keys, order, reach), allowMissingColumns=True)

    window = Window.partitionBy(*keys, RANGE).orderBy(*_ascending(order))
    own = ~F.col(HALO)
    local = {f.name: f.over(window) for f in features if not f.running}
    for f in running:
        local.update(f.local(window, own))
    rows = rows.withColumns(local).where(own).drop(HALO)
    if running:
        rows = _join_carry(rows, ranged, keys, running)
    added = [F.col(f.name) if not f.running else f.joined().alias(f.name) for f in features]
    names = {f.name for f in features}
    return rows.select(*[c for c in df.columns if c not in names], *added)


def _halo(ranged, keys, order, reach):
    """Copies of the ``reach`` rows that precede each piece of a group.

    Only the last rows of every piece take part, so the work per group grows with
    its number of pieces, not with its rows.
    """
    back = Window.partitionBy(*keys, RANGE).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    along = Window.partitionBy(*keys).orderBy(RANGE, *_ascending(order))
    piece = Window.partitionBy(*keys, RANGE).orderBy(*_ascending(order))
    content = [c for c in ranged.columns if c != RANGE]
    return (
        ranged.withColumn("_back", F.row_number().over(back))
        .where(F.col("_back") <= reach)
        .withColumn("_earlier", F.collect_list(F.struct(*content)).over(along.rowsBetween(-reach, -1)))
        .withColumn("_first", F.row_number().over(piece))
        .where(F.col("_first") == 1)
        .select(RANGE, F.explode("_earlier").alias("_row"))
        .select("_row.*", RANGE, F.lit(True).alias(HALO))
    )


def _join_carry(rows, ranged, keys, running):
    """Add what the earlier pieces of the group amount to.

    The carried table has one row per piece: at most the number of ranges plus the
    number of hot groups, so broadcasting it is bounded.
    """
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(RANGE)
    totals = [t for f in running for t in f.totals()]
    carried = [c for f in running for c in f.carry(along)]
    pieces = ranged.groupBy(*keys, RANGE).agg(*totals).select(*keys, RANGE, *carried)
    return rows.join(F.broadcast(pieces), [*keys, RANGE], "left")
