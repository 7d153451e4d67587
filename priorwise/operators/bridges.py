"""History bridges: current claim to strictly earlier source records.

Each bridge is an equi-join on the entity with the date rule as a residual of
the join condition, so rows that fail it are never materialised.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from priorwise.functions.exprs import month_is_complete

ANCHOR = "current_claim_key"


#: Claim columns that come along in a bridge, and their names there.
Carried = Mapping[str, str] | None


def _anchors(claims: DataFrame, claim: tuple[str, str, str], carry: Carried, *more: str) -> DataFrame:
    key, entity, date = claim
    along = [F.col(c).alias(f"__a_{c}") for c in carry or {}]
    return claims.select(F.col(key).alias(ANCHOR), F.col(entity).alias("__entity"), F.col(date).alias("__anchor"), *along, *[F.col(m).alias(f"__{m}") for m in more])


def _e(column: str) -> Column:
    """An event's column in the join of a bridge; the prefix keeps equal names apart."""
    return F.col(f"__e_{column}")


#: Pairs of claims and events that one block of an entity's claims may make.
MOST_PAIRS = 10_000_000
#: Column of a dealt bridge: the block of its entity's claims.
BLOCK = "history_block"


#: Events that one task of a bridge is given.
EVENTS_A_TASK = 100_000


def tasks_for(events: DataFrame) -> int:
    """As many tasks as keep one to ``EVENTS_A_TASK`` events, and all cores busy where there are 10,000 events for each.

    A bridge and what is grouped from it are many times the rows that are
    exchanged for it, so tasks must not be sized by exchanged bytes.
    """
    n = events.count()
    return max(1, -(-n // EVENTS_A_TASK), min(events.sparkSession.sparkContext.defaultParallelism, n // 10_000))


def heavy_entities(claims: DataFrame, events: DataFrame, entity: str, event_entity: str, most: int = MOST_PAIRS) -> DataFrame:
    """__heavy and __blocks of the entities whose claims times events exceed ``most``.

    Both sides are counted by entity, with partial counts before the exchange.
    """
    a = claims.filter(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("__heavy")).agg(F.count(F.lit(1)).alias("__claims"))
    e = events.groupBy(F.col(event_entity).alias("__of")).agg(F.count(F.lit(1)).alias("__events"))
    blocks = F.least(F.ceil(F.col("__claims") / most * F.col("__events")), F.col("__claims")).cast("int")
    return a.join(e, F.col("__heavy") == F.col("__of")).select("__heavy", blocks.alias("__blocks")).filter("__blocks > 1")


def _deal(anchors: DataFrame, events: DataFrame, entity: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claims of a heavy entity in blocks by hash of their key, its events once for each block; others have block 0."""
    n = F.coalesce("__blocks", F.lit(1))
    dealt = anchors.join(heavy, F.col("__entity") == F.col("__heavy"), "left").withColumn(BLOCK, F.pmod(F.xxhash64(ANCHOR), n).cast("int")).drop("__heavy", "__blocks")
    copied = events.join(heavy, _e(entity) == F.col("__heavy"), "left").withColumn("__e_block", F.explode(F.sequence(F.lit(0), n - 1))).drop("__heavy", "__blocks")
    return dealt, copied


def _bridge(anchors: DataFrame, events: DataFrame, entity: str, rule: Column, outputs: Mapping[str, str], carry: Carried = None, heavy: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """``carry``: claim columns that come along, such as the date, and their names.

    ``heavy`` (of :func:`heavy_entities`) deals the claims of heavy entities in
    blocks, so that no task makes all pairs of one entity; the block comes along.
    ``tasks`` (of :func:`tasks_for`) is how many tasks make the pairs.
    """
    renamed = events.select(*[F.col(c).alias(f"__e_{c}") for c in events.columns])
    on, more = (F.col("__entity") == _e(entity)) & rule, []
    if heavy is not None:
        anchors, renamed = _deal(anchors, renamed, entity, heavy)
        on, more = (F.col(BLOCK) == F.col("__e_block")) & on, [BLOCK]
    if tasks is not None:
        anchors, renamed = anchors.repartition(tasks, *more, "__entity"), renamed.repartition(tasks, *(["__e_block"] if more else []), _e(entity))
    return anchors.join(renamed, on).select(ANCHOR, *[F.col(f"__a_{c}").alias(name) for c, name in (carry or {}).items()], *more, *[_e(c).alias(a) for c, a in outputs.items()])


def bridge_strict_before(claims: DataFrame, events: DataFrame, claim: tuple[str, str, str], event: tuple[str, str], outputs: Mapping[str, str], carry: Carried = None, heavy: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Events of the claim's entity dated before the claim.

    claim: (key, entity, date); event: (entity, date).  carry, heavy, tasks: as in every bridge, see :func:`_bridge`.
    """
    return _bridge(_anchors(claims, claim, carry), events, event[0], _e(event[1]) < F.col("__anchor"), outputs, carry, heavy, tasks)


def bridge_exclude_current(claims: DataFrame, events: DataFrame, claim: tuple[str, str, str], event: tuple[str, str], current: str, event_key: str, outputs: Mapping[str, str], carry: Carried = None, heavy: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """As bridge_strict_before, without the claim's own event; a null key is never the own one."""
    rule = (_e(event[1]) < F.col("__anchor")) & ~_e(event_key).eqNullSafe(F.col(f"__{current}"))
    return _bridge(_anchors(claims, claim, carry, current), events, event[0], rule, outputs, carry, heavy, tasks)


def bridge_completed_month(claims: DataFrame, months: DataFrame, claim: tuple[str, str, str], month: tuple[str, str], outputs: Mapping[str, str], carry: Carried = None, heavy: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Months of the entity that ended before the claim."""
    return _bridge(_anchors(claims, claim, carry), months, month[0], month_is_complete(_e(month[1]), F.col("__anchor")), outputs, carry, heavy, tasks)


def bridge_with_dimension(claims: DataFrame, events: DataFrame, dimension: DataFrame, claim: tuple[str, str, str], event: tuple[str, str], keys: tuple[str, str], outputs: Mapping[str, str], carry: Carried = None, heavy: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Events LEFT JOIN a dimension, then bridge_strict_before."""
    enriched = events.join(dimension.withColumnRenamed(keys[1], "__dim_key"), events[keys[0]] == F.col("__dim_key"), "left").drop("__dim_key")
    return bridge_strict_before(claims, enriched, claim, event, outputs, carry, heavy, tasks)


def bridge_self_prior(claims: DataFrame, claim: tuple[str, str, str], outputs: Mapping[str, str], taxonomy: tuple[DataFrame, str, str, Mapping[str, str]] | None = None, carry: Carried = None, heavy: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Earlier claims of the same entity with another key, LEFT JOIN a taxonomy.

    taxonomy: (frame, claim column, taxonomy key, outputs).
    """
    prior = claims.select(*[F.col(c).alias(f"p_{c}") for c in claims.columns])
    key, entity, date = claim
    rule = (_e(f"p_{date}") < F.col("__anchor")) & (_e(f"p_{key}") != F.col(ANCHOR))
    renamed = {f"p_{c}": a for c, a in outputs.items()}
    if taxonomy is None:
        return _bridge(_anchors(claims, claim, carry), prior, f"p_{entity}", rule, renamed, carry, heavy, tasks)
    frame, column, tax_key, tax_out = taxonomy
    out = _bridge(_anchors(claims, claim, carry), prior, f"p_{entity}", rule, renamed | {f"p_{column}": "__tax"}, carry, heavy, tasks)
    dim = frame.select(F.col(tax_key).alias("__tax_key"), *[F.col(c).alias(a) for c, a in tax_out.items()])
    return out.join(dim, F.col("__tax") == F.col("__tax_key"), "left").drop("__tax", "__tax_key")


def bridge_completed_prior(claims: DataFrame, repairs: DataFrame, claim: tuple[str, str, str], end: str, repair_claim: str, outputs: Mapping[str, str]) -> DataFrame:
    """Repair records of earlier claims of the entity whose repair ended before the current claim."""
    key, entity, date = claim
    prior = claims.select(F.col(key).alias("__prior"), F.col(entity).alias("__p_entity"), F.col(end).alias("__end")).filter(F.col("__end").isNotNull())
    named = repairs.select(*[F.col(c).alias(f"__e_{c}") for c in {repair_claim, *outputs}])
    done = named.join(prior, _e(repair_claim) == F.col("__prior"))
    anchors = _anchors(claims, claim, None)
    joined = anchors.join(done, (F.col("__entity") == F.col("__p_entity")) & (F.col("__end") < F.col("__anchor")) & (F.col("__prior") != F.col(ANCHOR)))
    return joined.select(ANCHOR, *[_e(c).alias(a) for c, a in outputs.items()])


def history_coverage(claims: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """One row: claims with and without history; min, median, p95, max rows a claim, zeros included."""
    n = bridge.groupBy(F.col(ANCHOR).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    per = claims.select(key).join(n, key, "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    q = F.percentile("n", F.array(F.lit(0.5), F.lit(0.95)))
    return per.agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(F.col("n") > 0).alias("with_history"), F.count_if(F.col("n") == 0).alias("without_history"),
        F.min("n").alias("min_rows"), F.get(q, F.lit(0)).alias("median_rows"), F.get(q, F.lit(1)).alias("p95_rows"), F.max("n").alias("max_rows"),
    )


def asof_latest_match(claims: DataFrame, installs: DataFrame, claim: tuple[str, str, str, str | None], component: str, install: tuple[str, str, str], groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per claim the latest installation of its component on or before the date.

    claim: (key, entity, date, earlier date that counts instead when present);
    install: (entity, component, date).  match_status is no_causal_component,
    unmatched, ambiguous (rows of the latest date differ in ``groups``) or
    matched; tied is true when several rows share the latest date; n_candidates
    counts all on or before.  The groups' values come from the first of the
    latest rows by ``order``, nulls first, and are null unless matched.
    """
    key, entity, date, early = claim
    when = F.coalesce(F.col(early), F.col(date)) if early else F.col(date)
    left = claims.select(F.col(key), F.col(entity).alias("__e"), F.col(component).alias("__c"), when.alias("__d"))
    i_entity, i_component, i_date = install
    on = (F.col("__e") == installs[i_entity]) & (F.col("__c") == installs[i_component]) & (installs[i_date] <= F.col("__d"))
    pairs = left.join(installs, on)
    latest = Window.partitionBy(key).orderBy(F.col(i_date).desc())
    ranked = pairs.withColumns({"__rank": F.rank().over(latest), "__n": F.count(F.lit(1)).over(Window.partitionBy(key))}).filter("__rank = 1")
    value = F.struct(*[F.coalesce(F.col(g).cast("string"), F.lit("<NULL>")).alias(g) for g in groups])
    first = F.min_by(F.struct(*groups), F.struct(*[F.col(o) for o in order]))
    best = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("__ties"), F.count_distinct(value).alias("__values"), first.alias("__first"), F.max("__n").alias("n_candidates"))
    out = left.join(best, key, "left")
    status = F.when(F.col("__c").isNull(), "no_causal_component").when(F.col("__ties").isNull(), "unmatched").when(F.col("__values") > 1, "ambiguous").otherwise("matched")
    out = out.withColumn("match_status", status)
    return out.select(
        key, "match_status", F.coalesce(F.col("__ties") > 1, F.lit(False)).alias("tied"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
        *[F.when(F.col("match_status") == "matched", F.col("__first")[g]).alias(g) for g in groups],
    )


def match_counters(matches: DataFrame) -> DataFrame:
    """One row of counters; a tie that collapses counts as ambiguous and as matched, one that conflicts as ambiguous and unmatched."""
    s = F.col("match_status")
    return matches.agg(
        F.count_if(s == "no_causal_component").alias("no_causal_component"), F.count_if(s == "matched").alias("matched"),
        F.count_if(s.isin("unmatched", "ambiguous")).alias("unmatched"), F.count_if(F.col("tied")).alias("ambiguous"), F.count_if(F.col("n_candidates") > 1).alias("multi_history"),
    )


def bridge_violations(claims: DataFrame, bridge: DataFrame, key: str, date: str, event_date: str, month_rule: bool = False, current: tuple[str, str] | None = None) -> DataFrame:
    """One row of counts that must be zero: not earlier, own event, claims outside the snapshot.

    ``month_rule``: the event date is a month start whose month must be over.
    ``current``: (claim column, bridge column) that must differ.
    """
    c = claims.select(F.col(key).alias(ANCHOR), F.col(date).alias("__anchor"), *([F.col(current[0]).alias("__current")] if current else []), F.lit(True).alias("__known"))
    j = bridge.join(c, ANCHOR, "left")
    e = F.last_day(event_date) if month_rule else F.col(event_date)
    own = F.col(current[1]).eqNullSafe(F.col("__current")) & F.col("__known").isNotNull() if current else F.lit(False)
    return j.agg(F.count(F.lit(1)).alias("bridge_rows"), F.count_if(e >= F.col("__anchor")).alias("not_earlier"), F.count_if(own).alias("own_event"), F.count_if(F.col("__known").isNull()).alias("unknown_claims"))


def attach_anchor_dates(claims: DataFrame, bridge: DataFrame, key: str, date: str, event_date: str) -> DataFrame:
    """The bridge with anchor_date and event_date; null events leave, an unsafe one fails the query."""
    c = claims.select(F.col(key).alias(ANCHOR), F.col(date).alias("anchor_date"))
    j = bridge.withColumn("event_date", F.col(event_date)).filter(F.col("event_date").isNotNull()).join(c, ANCHOR)
    safe = F.when(F.col("event_date") < F.col("anchor_date"), F.col("event_date")).otherwise(F.raise_error(F.lit("an event is not before its claim")))
    return j.withColumn("event_date", safe)
