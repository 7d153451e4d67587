"""Window features over history bridges.

A family is a list of features over one bridge with ``event_date`` and
``anchor_date``.  The windows are nested, so an event belongs to one age bucket:
that of the youngest window that holds it.  A bridge is aggregated once, to one
row of mergeable states (counts, sums, extremes, moments, sets, first and last
rows) for each anchor and bucket, of which an anchor has five at most; a window
merges the buckets up to its own.  Features are made from merged states, each
state is kept once however many features share it, and the catalog is the plan.

Numbers, values and rows are grouped apart: numbers by anchor and bucket, in
Spark's hash map with generated code; values (for distinct counts and modes) by
anchor and value, with their count and youngest bucket, so that no set is held
in memory; first and last rows, which Spark has to sort, with all columns that
are wanted of them in one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from priorwise.functions.exprs import DAYS_PER_MONTH, expected_months, month_index, population_std, safe_divide

from .bridges import ANCHOR

#: Months back; None is all history.
WINDOWS: dict[str, int | None] = {"3m": 3, "6m": 6, "12m": 12, "24m": 24, "all": None}

# The measures of the monthly telemetry table.
ADDITIVE = ("mileage_month", "engine_hours_month", "idle_hours_month", "low_oil_pressure_events", "brake_air_pressure_alerts", "battery_voltage_alerts", "fault_code_count", "harsh_braking_events")
CONTINUOUS = ("avg_engine_temp", "max_engine_temp", "avg_oil_pressure", "avg_payload_weight", "fuel_efficiency_mpg", "route_severity_score", "maintenance_compliance_score")
TRENDS = ("mileage_month", "engine_hours_month", "fault_code_count", "avg_engine_temp", "avg_oil_pressure", "fuel_efficiency_mpg", "route_severity_score", "maintenance_compliance_score")
TREND_WINDOWS = ("6m", "12m", "24m")


#: A column's name, or what makes a column (which needs a session).
Values = str | Callable[[], Column]


#: Column of a bridge that holds its rows' :func:`age_bucket`; a bridge that is read more than once may bring it along.
BUCKET = "__bucket"


def age_bucket(event: str = "event_date", anchor: str = "anchor_date") -> Column:
    """The place in ``WINDOWS`` of the youngest window that holds the event."""
    out = F.lit(len(WINDOWS) - 1)
    for k, months in reversed(list(enumerate(WINDOWS.values()))):
        out = out if months is None else F.when(F.col(event) >= F.add_months(anchor, -months), k).otherwise(out)
    return out


def _value(x: Values) -> Column:
    return F.col(x) if isinstance(x, str) else x()


class States:
    """The states that the features of a family need of a bucket, and how windows merge them.

    Every method registers what it needs, once however often it is asked for,
    and gives the SQL of the merged value.  ``what`` names the values ``x``, a
    column or what makes one.  Merges are SQL text, which is parsed in one call.
    """

    def __init__(self) -> None:
        self.fixed: dict[str, Column] = {}
        self.shifts: dict[str, str] = {}
        self.merged_fixed: dict[str, str] = {}
        self.values: dict[str, Column] = {}
        self.of_values: dict[str, str] = {}
        self.edges: dict[tuple[str, str], list[str]] = {}
        self.of_edges: dict[str, tuple[str, str, str]] = {}

    def _state(self, op: str, what: str, aggregate: Callable[[Column], Column], x: Values) -> str:
        name = f"{op}|{what}"
        if name not in self.fixed:
            self.fixed[name] = aggregate(_value(x))
        return f"`{name}`"

    def _merge(self, out: str, window: str, merge: str, state: str) -> str:
        self.merged_fixed[f"{out}|{window}"] = merge.format(f"CASE WHEN __bucket <= {_BUCKET[window]} THEN {state} END")
        return f"numbers.`{out}|{window}`"

    def count(self, what: str, x: Values, window: str) -> str:
        return self._merge(f"n|{what}", window, "coalesce(sum({}), 0)", self._state("n", what, F.count, x))

    def count_if(self, what: str, x: Values, window: str) -> str:
        return self._merge(f"if|{what}", window, "coalesce(sum({}), 0)", self._state("if", what, F.count_if, x))

    def total(self, what: str, x: Values, window: str) -> str:
        return self._merge(f"sum|{what}", window, "sum({})", self._state("sum", what, F.sum, x))

    def least(self, what: str, x: Values, window: str) -> str:
        return self._merge(f"min|{what}", window, "min({})", self._state("min", what, F.min, x))

    def greatest(self, what: str, x: Values, window: str) -> str:
        return self._merge(f"max|{what}", window, "max({})", self._state("max", what, F.max, x))

    def mean(self, what: str, x: Values, window: str) -> str:
        return divided(self.total(what, x, window), self.count(what, x, window))

    def std(self, what: str, x: Values, window: str) -> str:
        """Population deviation, null below two values.

        Buckets give number, mean and variance; means are taken from one of the
        anchor's own bucket means, so that nothing cancels.
        """
        n, size = self.count(what, x, window), self._state("n", what, F.count, x)
        mean, var, shift = self._state("avg", what, F.avg, x), self._state("var", what, F.var_pop, x), f"`shift|{what}`"
        self.shifts[f"shift|{what}"] = f"max({mean})"
        off = f"({mean} - {shift})"
        m1 = self._merge(f"m1|{what}", window, "sum({})", f"{size} * {off}")
        m2 = self._merge(f"m2|{what}", window, "sum({})", f"{size} * ({var} + {off} * {off})")
        return f"CASE WHEN {n} >= 2 THEN sqrt(greatest({m2} / {n} - ({m1} / {n}) * ({m1} / {n}), 0D)) END"

    def _tallied(self, what: str, x: Values) -> None:
        if what not in self.values:
            self.values[what] = _value(x)

    def distinct(self, what: str, x: Values, window: str) -> str:
        """Distinct values; as windows are nested, a value belongs to those from its youngest bucket on."""
        self._tallied(what, x)
        self.of_values[f"distinct|{what}|{window}"] = f"count_if(what = '{what}' AND youngest <= {_BUCKET[window]})"
        return f"coalesce(tallied.`distinct|{what}|{window}`, 0)"

    def mode(self, column: str) -> str:
        """The most frequent value of all history, the least on ties."""
        self._tallied(column, column)
        self.of_values[f"mode|{column}"] = f"min(CASE WHEN what = '{column}' THEN struct(-n AS n, value) END).value"
        return f"tallied.`mode|{column}`"

    def _edge(self, which: str, column: str, key: str, window: str) -> str:
        columns = self.edges.setdefault((which, key), [])
        if column not in columns:
            columns.append(column)
        self.of_edges[f"{which}|{key}|{window}"] = (which, key, window)
        return f"edges.`{which}|{key}|{window}`.v.`{column}`"

    def last(self, column: str, key: str, window: str) -> str:
        """The value of the row with the greatest (date, key), null included."""
        return self._edge("last", column, key, window)

    def first(self, column: str, key: str, window: str) -> str:
        return self._edge("first", column, key, window)


def divided(a: str, b: str) -> str:
    """Ratio; null where the denominator is null or not positive."""
    return f"CASE WHEN {b} > 0 THEN {a} / {b} END"


_BUCKET = {w: k for k, w in enumerate(WINDOWS)}
_AGGREGATES: dict[str, Callable[[States, str, Values, str], str]] = {
    "count": States.count, "sum": States.total, "mean": States.mean, "min": States.least, "max": States.greatest, "std": States.std, "nunique": States.distinct,
}


@dataclass(frozen=True)
class Feature:
    """One column of the matrix: what it is made of, and how.

    ``make`` gives its SQL over a family's states, which needs a session; the
    rest does not.
    """

    name: str
    family: str
    tier: str
    kind: str
    window: str
    aggregation: str
    sources: tuple[str, ...]
    formula: str
    make: Callable[[States], str] = field(compare=False, repr=False)
    zero_fill: bool = False
    derived: bool = False


def within(window: str) -> Column:
    """The event is inside the window of the bridge row's anchor."""
    months = WINDOWS[window]
    return F.lit(True) if months is None else F.col("event_date") >= F.add_months("anchor_date", -months)


def metric(family: str, column: str, aggregation: str, windows: Iterable[str] = WINDOWS, tier: str = "CORE", name: str | None = None) -> list[Feature]:
    """An aggregate of a column in each window; counts are 0 and measures null without rows."""
    counts = aggregation in ("count", "nunique")
    make = lambda w: lambda st: _AGGREGATES[aggregation](st, column, column, w)
    return [Feature(f"{family}_{name or column}_{aggregation}_{w}", family, tier, "long" if counts else "double", w, aggregation, (column,), f"{aggregation}({column})", make(w), counts) for w in windows]


def event_count(family: str, key: str, windows: Iterable[str] = WINDOWS) -> list[Feature]:
    return [Feature(f"{family}_event_count_{w}", family, "CORE", "long", w, "count", (key,), f"count({key})", lambda st, w=w: st.count(key, key, w), True) for w in windows]


def flag_count(family: str, flag: str, windows: Iterable[str] = WINDOWS, negate: bool = False, tier: str = "CORE", name: str | None = None) -> list[Feature]:
    """Rows whose flag is true (``negate``: false); null flags are neither."""
    cond = lambda: ~F.col(flag) if negate else F.col(flag)
    name = name or (f"not_{flag}" if negate else flag)
    return [Feature(f"{family}_{name}_count_{w}", family, tier, "long", w, "flag_count", (flag,), f"sum({name})", lambda st, w=w: st.count_if(f"{flag}|{negate}", cond, w), True) for w in windows]


def ratio(family: str, name: str, numerator: str, denominator: str, windows: Iterable[str] = WINDOWS, tier: str = "CORE") -> list[Feature]:
    """Ratio of two features of the family, named up to the window."""
    return [Feature(f"{family}_{name}_ratio_{w}", family, tier, "double", w, "ratio", (numerator, denominator), f"{numerator} / {denominator}", lambda st, w=w: divided(f"`{numerator}_{w}`", f"`{denominator}_{w}`"), derived=True) for w in windows]


def latest(family: str, column: str, key: str, tier: str = "CORE") -> Feature:
    """The value of the row with the greatest (date, key), null included."""
    return Feature(f"{family}_{column}_latest", family, tier, "value", "all", "latest", (column, key), f"latest({column})", lambda st: st.last(column, key, "all"))


def recency(family: str) -> Feature:
    return Feature(f"{family}_recency_days", family, "CORE", "long", "all", "recency", ("event_date",), "anchor - max(date)", lambda st: f"date_diff({st.greatest('anchor_date', 'anchor_date', 'all')}, {st.greatest('event_date', 'event_date', 'all')})")


def first_to_last(family: str, column: str, key: str, windows: Iterable[str], least: int = 0, tier: str = "CORE", name: str = "change") -> list[Feature]:
    """The latest row's value minus the earliest row's in each window, null when either has none.

    ``least``: values that the window must hold.
    """
    make = lambda w: lambda st: f"CASE WHEN {st.count(column, column, w)} >= {least} THEN {st.last(column, key, w)} - {st.first(column, key, w)} END"
    return [Feature(f"{family}_{column}_{name}_{w}", family, tier, "double", w, name, (column, key), f"latest - earliest {column}", make(w)) for w in windows]


def _month() -> Column:
    return month_index(F.col("event_date"))


def months_observed(family: str, windows: Iterable[str] = WINDOWS) -> list[Feature]:
    return [Feature(f"{family}_months_observed_{w}", family, "CORE", "long", w, "nunique", ("event_date",), "count(distinct month)", lambda st, w=w: st.distinct("month", _month, w), True) for w in windows]


def month_span(family: str) -> list[Feature]:
    span = lambda st: f"{st.greatest('month', _month, 'all')} - {st.least('month', _month, 'all')} + 1"
    return [
        Feature(f"{family}_month_span", family, "CORE", "long", "all", "span", ("event_date",), "max - min month + 1", span),
        Feature(f"{family}_missing_months", family, "CORE", "long", "all", "span", ("event_date",), "span - observed months", lambda st: f"{span(st)} - {st.distinct('month', _month, 'all')}"),
    ]


def type_diversity(family: str, column: str, key: str) -> list[Feature]:
    return [
        Feature(f"{family}_{column}_nunique_all", family, "CORE", "long", "all", "nunique", (column,), f"count(distinct {column})", lambda st: st.distinct(column, column, "all"), True),
        latest(family, column, key),
        Feature(f"{family}_{column}_dominant", family, "CORE", "string", "all", "mode", (column,), f"mode({column}), least on ties", lambda st: st.mode(column)),
    ]


def since_latest(family: str, anchor: str, column: str, key: str) -> Feature:
    """The anchor's reading minus the one at the latest event."""
    return Feature(f"{family}_{column}_since_last", family, "CORE", "double", "all", "since_last", (anchor, column), f"{anchor} - latest {column}", lambda st: f"{st.greatest(anchor, anchor, 'all')} - {st.last(column, key, 'all')}")


def packed(df: DataFrame, by: Sequence[str], name: str, columns: Iterable[str]) -> DataFrame:
    """The keys and one struct of the columns: joins then pass on one value, not hundreds."""
    return df.select(*by, F.struct(*[F.col(f"`{c}`") for c in columns]).alias(name))


def build_family(bridge: DataFrame, features: Sequence[Feature], key: str = ANCHOR, near: Sequence[str] = (), tasks: int | None = None, stay: bool = False) -> DataFrame:
    """All features of one family for each anchor that the bridge has.

    ``near``: columns of the bridge that the key determines and that the bridge
    is partitioned by, such as the entity; grouping by them as well keeps the
    rows of the bridge where they are.  ``tasks``: as of the bridge, for joins by the key.
    ``stay``: states are joined by ``near`` as well, which are not null then,
    and come along, so nothing is exchanged.
    """
    states = States()
    made = {f.name: f"{f.make(states)} AS `{f.name}`" for f in features}
    keys = [*near, key]
    by = keys if stay else [key]
    bucketed = bridge if BUCKET in bridge.columns else bridge.withColumn(BUCKET, age_bucket())
    rows = bucketed.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__rows"), *[x.alias(n) for n, x in states.fixed.items()])
    if states.shifts:
        of = ", ".join(f"`{k}`" for k in keys)
        rows = rows.selectExpr("*", *[f"{x} OVER (PARTITION BY {of}) AS `{n}`" for n, x in states.shifts.items()])
    dealt = lambda frame: frame if tasks is None else frame.repartition(tasks, key)
    out = packed(rows.groupBy(*keys).agg(F.sum("__rows").alias("__rows"), *[F.expr(f"{x} AS `{n}`") for n, x in states.merged_fixed.items()]), by, "numbers", ["__rows", *states.merged_fixed])
    if states.values or states.edges:
        out = dealt(out)
    if states.values:
        tallied = tallies(bucketed, states.values, key, near, any(n.startswith("mode|") for n in states.of_values)).groupBy(*keys).agg(*[F.expr(f"{x} AS `{n}`") for n, x in states.of_values.items()])
        out = out.join(dealt(packed(tallied, by, "tallied", states.of_values)), by, "left")
    if states.edges:
        row = lambda order, columns: F.struct(F.col("event_date").alias("d"), F.col(order).alias("k"), F.struct(*columns).alias("v"))
        kept = {(which, order): (F.max if which == "last" else F.min)(row(order, columns)).alias(f"{which}|{order}") for (which, order), columns in states.edges.items()}
        ends = bucketed.groupBy(*keys, "__bucket").agg(*kept.values())
        picked = [f"{'max' if which == 'last' else 'min'}(CASE WHEN __bucket <= {_BUCKET[w]} THEN `{which}|{order}` END) AS `{n}`" for n, (which, order, w) in states.of_edges.items()]
        out = out.join(dealt(packed(ends.groupBy(*keys).agg(*map(F.expr, picked)), by, "edges", states.of_edges)), by)
    names = [f"`{k}`" for k in by]
    out = out.selectExpr(*names, *[made[f.name] for f in features if not f.derived])
    return out.selectExpr(*names, *[made[f.name] if f.derived else f"`{f.name}`" for f in features])


def tallies(bridge: DataFrame, values: Mapping[str, Column], key: str = ANCHOR, near: Sequence[str] = (), text: bool = True) -> DataFrame:
    """Per anchor, name and value that is not null: n, and youngest, the least ``BUCKET`` it lies in.  Values are as text, one alone as it is if not ``text``."""
    counted = [F.count(F.lit(1)).alias("n"), F.min(BUCKET).alias("youngest")]
    if len(values) == 1:
        (what, x), = values.items()
        alone = bridge.select(*near, key, BUCKET, x.cast("string").alias("value") if text else x.alias("value")).filter("value IS NOT NULL")
        return alone.groupBy(*near, key, "value").agg(*counted).withColumn("what", F.lit(what))
    cells = F.array(*[F.struct(F.lit(n).alias("what"), x.cast("string").alias("value")) for n, x in values.items()])
    long = bridge.select(*near, key, BUCKET, F.explode(cells).alias("c")).filter("c.value IS NOT NULL")
    return long.groupBy(*near, key, "c.what", "c.value").agg(*counted)


def dominant_share(bridge: DataFrame, column: str, name: str, key: str = ANCHOR, near: Sequence[str] = (), stay: bool = False) -> DataFrame:
    """Share of events that have the most frequent value; null values are not events."""
    counts = bridge.filter(F.col(column).isNotNull()).groupBy(*near, key, column).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*near, key).agg(safe_divide(F.max("n"), F.sum("n")).alias(name)).drop(*([] if stay else near))


def inter_event_stats(bridge: DataFrame, event_key: str, family: str, key: str = ANCHOR, near: Sequence[str] = (), stay: bool = False) -> DataFrame:
    """Mean and population deviation of day gaps between consecutive events."""
    gap = F.date_diff(F.col("event_date"), F.lag("event_date").over(Window.partitionBy(*near, key).orderBy("event_date", event_key)))
    return bridge.select(*near, key, gap.alias("gap")).groupBy(*near, key).agg(F.avg("gap").alias(f"{family}_gap_days_mean"), population_std(F.col("gap")).alias(f"{family}_gap_days_std")).drop(*([] if stay else near))


def slopes(bridge: DataFrame, columns: Sequence[str], windows: Sequence[str], family: str, key: str = ANCHOR, near: Sequence[str] = (), stay: bool = False) -> DataFrame:
    """Least-squares slope of monthly averages on the month index, for three months or more.

    Null when the months do not vary.  Months count from the anchor's, so sums
    of whole values are exact and a slope is one division.
    """
    out = []
    month = (month_index(F.col("event_date")) - month_index(F.col("anchor_date"))).cast("double")
    inside = lambda w: F.col(BUCKET) <= _BUCKET[w] if BUCKET in bridge.columns else within(w)
    monthly = bridge.groupBy(*near, key, month.alias("m")).agg(*[F.avg(F.when(inside(w), F.col(c))).alias(f"{c}|{w}") for c in columns for w in windows])
    for c in columns:
        for w in windows:
            y = F.col(f"`{c}|{w}`")
            x = F.when(y.isNotNull(), F.col("m"))
            n, sx = F.count(y), F.sum(x)
            spread = n * F.sum(x * x) - sx * sx
            out.append(F.when((n >= 3) & (spread > 0), (n * F.sum(x * y) - sx * F.sum(y)) / spread).alias(f"{family}_{c}_slope_{w}"))
    return monthly.groupBy(*near, key).agg(*out).drop(*([] if stay else near))


def coverage_ratios(observed: DataFrame, anchors: DataFrame, key: str, date: str, start: str, family: str, windows: Sequence[str] = tuple(WINDOWS)) -> DataFrame:
    """Per anchor the expected months and observed over expected months in each window."""
    j = anchors.select(F.col(key).alias(ANCHOR), F.col(date).alias("__d"), F.col(start).alias("__s")).join(observed, ANCHOR, "left")
    cols = coverage_columns("__d", "__s", family, windows)
    return j.withColumns(cols).select(ANCHOR, *cols)


def coverage_columns(date: str, start: str, family: str, windows: Sequence[str] = tuple(WINDOWS)) -> dict[str, Column]:
    """The columns of :func:`coverage_ratios` over a frame that has the observed months."""
    cols = {}
    for w in windows:
        n = expected_months(F.col(date), F.col(start), WINDOWS[w])
        seen = F.coalesce(F.col(f"{family}_months_observed_{w}"), F.lit(0))
        cols |= {f"{family}_months_expected_{w}": n, f"{family}_coverage_ratio_{w}": safe_divide(seen, n)}
    return cols


def telemetry_spec(additive: Sequence[str] = ADDITIVE, continuous: Sequence[str] = CONTINUOUS, key: str = "month_key", idle: tuple[str, str] | None = ("idle_hours_month", "engine_hours_month"), odometer: str | None = "total_odometer_miles", trends: Sequence[str] = TRENDS) -> list[Feature]:
    """Monthly facts: sums and means, extremes and deviations, latest values, recency, span and changes."""
    f = "telemetry"
    out = months_observed(f)
    for c in additive:
        for a, tier in (("sum", "CORE"), ("mean", "CORE"), ("max", "EXTENDED"), ("std", "EXTENDED")):
            out += metric(f, c, a, tier=tier)
    for c in continuous:
        out += metric(f, c, "mean")
        for a, tier in (("min", "EXTENDED"), ("max", "EXTENDED"), ("std", "EXTENDED")):
            out += metric(f, c, a, ("24m", "all"), tier)
    if idle:
        out += ratio(f, "idle", f"{f}_{idle[0]}_sum", f"{f}_{idle[1]}_sum")
    measures = [*additive, *continuous, *([odometer] if odometer else [])]
    out += [latest(f, c, key) for c in measures] + [recency(f)] + month_span(f)
    if odometer:
        out += first_to_last(f, odometer, key, ("3m", "6m", "12m", "24m"), name="delta")
    for c in trends:
        out += first_to_last(f, c, key, TREND_WINDOWS, least=2, tier="EXTENDED")
    return out


def event_spec(family: str, key: str, kind: str, readings: Mapping[str, str] | None = None, windows: Sequence[str] = tuple(WINDOWS)) -> list[Feature]:
    """Events: counts, recency, kinds, and what the anchor gained since the last; readings: event column to anchor column."""
    out = event_count(family, key, windows) + [recency(family)] + type_diversity(family, kind, key)
    return out + [since_latest(family, a, c, key) for c, a in (readings or {}).items()]


def service_spec(key: str = "service_key", kind: str = "service_type", readings: Mapping[str, str] | None = None, windows: Sequence[str] = ("6m", "12m", "24m", "all")) -> list[Feature]:
    """Service visits: counts, recency, kinds, and what the anchor gained since the last."""
    return event_spec("service", key, kind, readings, windows)


def maintenance_spec(key: str = "maintenance_event_key", kind: str = "maintenance_type", scheduled: str = "scheduled_flag", on_time: str = "completed_on_time_flag", overdue: str = "overdue_days", cost: str = "maintenance_cost", readings: Mapping[str, str] | None = None) -> list[Feature]:
    f = "maintenance"
    out = event_spec(f, key, kind, readings)
    out += flag_count(f, scheduled) + flag_count(f, scheduled, negate=True, name="unscheduled") + flag_count(f, on_time)
    out += [Feature(f"{f}_overdue_count_{w}", f, "CORE", "long", w, "count", (overdue,), f"{overdue} > 0", lambda st, w=w: st.count_if(f"{overdue}|>0", lambda: F.col(overdue) > 0, w), True) for w in WINDOWS]
    out += metric(f, cost, "sum") + metric(f, overdue, "mean") + metric(f, overdue, "max", tier="EXTENDED")
    late = ("6m", "12m", "24m", "all")
    return out + ratio(f, scheduled, f"{f}_{scheduled}_count", f"{f}_event_count", late) + ratio(f, on_time, f"{f}_{on_time}_count", f"{f}_event_count", late)


def component_spec(key: str = "installation_key", rework: str = "rework_flag", safety: str = "is_safety_critical", distinct: Sequence[str] = ("supplier_key", "component_system", "component_category"), measures: Sequence[str] = ("inspection_score", "torque_value", "unit_cost"), life_months: str = "standard_life_months") -> list[Feature]:
    f = "component"
    out = event_count(f, key) + flag_count(f, rework) + flag_count(f, safety)
    out += ratio(f, rework, f"{f}_{rework}_count", f"{f}_event_count") + ratio(f, safety, f"{f}_{safety}_count", f"{f}_event_count")
    for c in distinct:
        out += metric(f, c, "nunique", ("all",))
    for c in measures:
        for a in ("mean", "min", "max"):
            out += metric(f, c, a, ("all",), "CORE" if a == "mean" else "EXTENDED")
    age = lambda: F.date_diff("anchor_date", "event_date")
    share = lambda: safe_divide(age() / DAYS_PER_MONTH, F.col(life_months))
    for a in ("mean", "min", "max"):
        out.append(Feature(f"{f}_age_days_{a}", f, "CORE", "double", "all", a, ("event_date",), f"{a}(age)", lambda st, a=a: _AGGREGATES[a](st, "age", age, "all")))
    for a in ("mean", "max"):
        out.append(Feature(f"{f}_age_over_life_{a}", f, "CORE", "double", "all", a, ("event_date", life_months), f"{a}(age / life)", lambda st, a=a: _AGGREGATES[a](st, "age over life", share, "all")))
    past = lambda: F.when(share().isNotNull(), (share() >= 1).cast("double"))
    out.append(Feature(f"{f}_past_life_share", f, "EXTENDED", "double", "all", "ratio", ("event_date", life_months), "share of age / life >= 1", lambda st: st.mean("past life", past, "all")))
    return [*out, recency(f)]


def prior_claim_spec(key: str = "prior_claim_key", safety: str = "safety_related_flag", recall: str = "recall_related_flag", distinct: Sequence[str] = ("failure_code", "failure_system", "failure_category"), severity: str = "severity_level") -> list[Feature]:
    f = "prior_claim"
    out = event_count(f, key) + flag_count(f, safety) + flag_count(f, recall)
    out += ratio(f, safety, f"{f}_{safety}_count", f"{f}_event_count") + ratio(f, recall, f"{f}_{recall}_count", f"{f}_event_count")
    for c in distinct:
        out += [*metric(f, c, "nunique", ("all",)), latest(f, c, key)]
    return [*out, latest(f, severity, key), recency(f)]


def lifecycle_days(anchors: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Day differences: name to (later, earlier)."""
    return anchors.withColumns({name: F.date_diff(late, early) for name, (late, early) in pairs.items()})


def usage_rates(anchors: DataFrame, miles: str, hours: str, months: str) -> DataFrame:
    m, h, t = F.col(miles).cast("double"), F.col(hours).cast("double"), F.col(months).cast("double")
    return anchors.withColumns({"usage_miles_per_month": safe_divide(m, t), "usage_hours_per_month": safe_divide(h, t), "usage_miles_per_hour": safe_divide(m, h)})


def warranty_utilization(anchors: DataFrame, uses: Mapping[str, tuple[str, str]]) -> DataFrame:
    """name to (used, allowed): the ratio and what remains of each, and the greatest ratio, nulls left out."""
    cols = {}
    for name, (used, allowed) in uses.items():
        u, a = F.col(used).cast("double"), F.col(allowed).cast("double")
        cols |= {f"warranty_{name}_ratio": safe_divide(u, a), f"warranty_{name}_remaining": a - u}
    out = anchors.withColumns(cols)
    return out.withColumn("warranty_max_ratio", F.greatest(*[F.col(f"warranty_{n}_ratio") for n in uses]))


def direct_values(anchors: DataFrame, passed: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Safe direct fields as they are; numeric-looking text as numbers, anything else in it null."""
    return anchors.select(*[F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in passed])


def frame_features(frame: DataFrame, family: str, aggregation: str, sources: Sequence[str], names: Sequence[str], tier: str = "CORE", window: str = "all") -> tuple[DataFrame, list[Feature]]:
    """Columns that a frame of one row an anchor holds already, as a family of the matrix.

    A name that ends in a window's is a feature of that window.
    """
    kinds = dict(frame.dtypes)

    def window_of(name: str) -> str:
        return next((w for w in WINDOWS if name.endswith(f"_{w}")), window)

    return frame, [Feature(n, family, tier, kinds[n], window_of(n), aggregation, tuple(sources), f"{aggregation}({', '.join(sources)})", lambda st, n=n: f"`{n}`") for n in names]


#: Parts of a column name that the matrix must not have.
FORBIDDEN = ("target", "claim_id", "vin", "serial_no", "description", "notes")


def feature_matrix(anchors: DataFrame, key: str, controls: Sequence[str], families: Sequence[tuple[DataFrame, Sequence[Feature]]], near: Sequence[str] = ()) -> DataFrame:
    """Anchors LEFT JOIN each family: key, controls, CORE, EXTENDED; counts 0 and measures null without history.

    A family whose frame is ``anchors`` itself is not joined.  ``near``: columns
    that the key determines and all frames are dealt by; a family whose frame
    has none of a row's is empty for it, so rows where they are null may only
    have features of ``anchors``.
    """
    features = [f for _, fs in families for f in fs]
    names = [f.name for f in features]
    if len(set(names)) != len(names):
        raise ValueError("feature names repeat")
    if bad := [n for n in [*names, *controls] if any(x in n for x in FORBIDDEN)]:
        raise ValueError(f"not allowed in the matrix: {bad}")
    packed = lambda k, own: F.struct(*[F.col(f"`{f.name}`") for f in own]).alias(f"__f{k}")
    out = anchors.select(F.col(key).alias(ANCHOR), *near, *controls, *[packed(k, own) for k, (frame, own) in enumerate(families) if frame is anchors])
    for k, (frame, own) in enumerate(families):
        if frame is not anchors:
            out = out.join(frame.select(*near, ANCHOR, packed(k, own)), [*near, ANCHOR], "left")
    at = {f.name: f"__f{k}.`{f.name}`" for k, (_, own) in enumerate(families) for f in own}
    value = lambda f: f"coalesce({at[f.name]}, 0) AS `{f.name}`" if f.zero_fill else f"{at[f.name]} AS `{f.name}`"
    ordered = [f for f in features if f.tier == "CORE"] + [f for f in features if f.tier != "CORE"]
    return out.selectExpr(ANCHOR, *[f"`{c}`" for c in controls], *[value(f) for f in ordered])


def history_presence(anchors: DataFrame, key: str, bridges: Mapping[str, DataFrame]) -> DataFrame:
    """Per anchor and source whether it has any history."""
    out = anchors.select(F.col(key).alias(ANCHOR))
    for name, bridge in bridges.items():
        out = out.join(bridge.select(ANCHOR).distinct().withColumn(f"has_{name}_history", F.lit(True)), ANCHOR, "left")
    return out.select(ANCHOR, *[F.coalesce(f"has_{n}_history", F.lit(False)).alias(f"has_{n}_history") for n in bridges])


def feature_catalog(spark: SparkSession, features: Sequence[Feature]) -> DataFrame:
    """One row a feature."""
    rows = [(f.name, f.family, f.tier, f.kind, f.window, f.aggregation, list(f.sources), f.formula) for f in features]
    return spark.createDataFrame(rows, "feature string, family string, tier string, kind string, `window` string, aggregation string, sources array<string>, formula string")


def catalog_counts(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("family", "tier").agg(F.count(F.lit(1)).alias("features"))


def source_coverage(catalog: DataFrame, fields: DataFrame) -> DataFrame:
    """source_field, status: USED when a feature is made from it, else DEFERRED; fields: family, source_field."""
    used = catalog.select("family", F.explode("sources").alias("source_field")).distinct().withColumn("u", F.lit(True))
    return fields.join(used, ["family", "source_field"], "left").select("family", "source_field", F.when(F.col("u"), "USED").otherwise("DEFERRED").alias("status"))
