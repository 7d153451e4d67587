"""Queries for splits, exposure, cohorts and folds (D)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from priorwise.functions.exprs import UNIT_SEPARATOR, canonical
from priorwise.operators import groups as G, splits as S
from priorwise.operators.bridges import tasks_for
from priorwise.operators.keys import left_many_to_one
from priorwise.sources.tables import bucketed, written

from .bindings import ANCHORS, LINES, anchors, ctes, lines, table
from .registry import query
from .tables_and_bridges import MEMBERSHIP, membership

TYPES = ("entity", "nation", "segment", "fingerprint")

SPLIT = """
daily AS (SELECT claim_date, count(*) AS n, sum(count(*)) OVER (ORDER BY claim_date) AS cum, sum(count(*)) OVER () AS total FROM anchors GROUP BY claim_date),
b1 AS (SELECT claim_date AS train_end FROM daily ORDER BY abs(cum - 0.7::DOUBLE * total), claim_date LIMIT 1),
b2 AS (SELECT claim_date AS validation_end FROM daily, b1 WHERE claim_date > train_end ORDER BY abs(cum - (0.7::DOUBLE + 0.15::DOUBLE) * total), claim_date LIMIT 1),
assigned AS (SELECT anchors.*, CASE WHEN claim_date <= train_end THEN 'TRAIN' WHEN claim_date <= validation_end THEN 'VALIDATION' ELSE 'TEST' END AS split FROM anchors, b1, b2)"""


def assigned(spark: SparkSession, d: str) -> DataFrame:
    a = anchors(spark, d)
    return S.assign_split(a, S.split_boundaries(a, "claim_date"), "claim_date")


@query("d01_split_boundaries", f"""{ctes(ANCHORS, SPLIT)} SELECT train_end, validation_end, CAST(sum(n) AS BIGINT) AS total_claims, count(*) AS unique_dates,
  CAST(sum(n) FILTER (claim_date <= train_end) AS BIGINT) AS train_count, count(*) FILTER (claim_date <= train_end) AS train_dates,
  CAST(sum(n) FILTER (claim_date > train_end AND claim_date <= validation_end) AS BIGINT) AS validation_count, count(*) FILTER (claim_date > train_end AND claim_date <= validation_end) AS validation_dates,
  CAST(sum(n) FILTER (claim_date > validation_end) AS BIGINT) AS test_count, count(*) FILTER (claim_date > validation_end) AS test_dates, 'OK' AS status FROM daily, b1, b2 GROUP BY ALL""", dates=["train_end", "validation_end"])
def d01(spark: SparkSession, d: str) -> DataFrame:
    return S.split_boundaries(anchors(spark, d), "claim_date")


@query("d02_assign_split", f"{ctes(ANCHORS, SPLIT)} SELECT claim_key, split FROM assigned")
def d02(spark: SparkSession, d: str) -> DataFrame:
    return assigned(spark, d).select("claim_key", "split")


@query("d03_validate_assignment", f"""{ctes(ANCHORS, SPLIT)}, bad AS (SELECT claim_key, CASE WHEN claim_key % 97 = 0 THEN 'OTHER' ELSE split END AS split FROM assigned WHERE claim_key % 101 <> 0)
SELECT 0 AS null_keys, 0 AS repeated_keys, (SELECT count(*) FROM bad WHERE split = 'OTHER') AS unknown_labels, (SELECT count(*) FROM anchors WHERE claim_key % 101 = 0) AS missing_claims, 0 AS extra_claims""")
def d03(spark: SparkSession, d: str) -> DataFrame:
    a = assigned(spark, d)
    flawed = a.filter("claim_key % 101 <> 0").withColumn("split", F.when(F.col("claim_key") % 97 == 0, "OTHER").otherwise(F.col("split")))
    return S.assignment_problems(flawed, anchors(spark, d), "claim_key")


@query("d04_split_ranges", f"{ctes(ANCHORS, SPLIT)} SELECT split, count(*) AS rows, min(claim_date) AS earliest, max(claim_date) AS latest FROM assigned GROUP BY split", dates=["earliest", "latest"])
def d04(spark: SparkSession, d: str) -> DataFrame:
    return S.split_ranges(assigned(spark, d), "claim_date")


@query("d05_date_order_errors", f"""{ctes(ANCHORS, SPLIT)}, x AS (SELECT claim_date, CASE WHEN claim_key % 500 = 1 THEN 'VALIDATION' ELSE split END AS split FROM assigned)
SELECT (SELECT count(*) FROM (SELECT claim_date FROM x GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS dates_in_several_splits,
       CAST(max(claim_date) FILTER (split = 'TRAIN') >= min(claim_date) FILTER (split = 'VALIDATION') AS INTEGER) AS train_overlaps_validation,
       CAST(max(claim_date) FILTER (split = 'VALIDATION') >= min(claim_date) FILTER (split = 'TEST') AS INTEGER) AS validation_overlaps_test FROM x""")
def d05(spark: SparkSession, d: str) -> DataFrame:
    flawed = assigned(spark, d).withColumn("split", F.when(F.col("claim_key") % 500 == 1, "VALIDATION").otherwise(F.col("split")))
    return S.date_order_errors(flawed, "claim_date")


_DIST = "SELECT split, count(*) AS rows, count(*) FILTER (target = 1) AS positives, count(*) FILTER (target = 0) AS negatives, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS row_pct, round(100.0 * count(*) FILTER (target = 1) / count(*), 6) AS positive_pct FROM assigned GROUP BY split"


@query("d06_split_distribution", f"{ctes(ANCHORS, SPLIT)} {_DIST}")
def d06(spark: SparkSession, d: str) -> DataFrame:
    return S.split_distribution(assigned(spark, d), "target").withColumns({c: F.round(c, 6) for c in ("row_pct", "positive_pct")})


@query("d14_split_sufficiency", f"""{ctes(ANCHORS, SPLIT)}, x AS ({_DIST})
SELECT split, 'BLOCK' AS severity, 'FRACTION_BELOW_MINIMUM' AS code FROM x WHERE row_pct < 16
UNION ALL SELECT split, 'WARN', 'FRACTION_OFF_REQUEST' FROM x WHERE abs(row_pct / 100 - CASE split WHEN 'TRAIN' THEN 0.6 ELSE 0.2 END) > 0.03
UNION ALL SELECT split, 'BLOCK', 'ONE_CLASS' FROM x WHERE positives = 0 OR negatives = 0
UNION ALL SELECT split, 'BLOCK', 'FEW_POSITIVES' FROM x WHERE split <> 'TRAIN' AND positives < 200
UNION ALL SELECT split, 'WARN', 'LIMITED_POSITIVES' FROM x WHERE split <> 'TRAIN' AND positives >= 200 AND positives < 5000
UNION ALL SELECT split, 'WARN', 'LIMITED_TRAIN_POSITIVES' FROM x WHERE split = 'TRAIN' AND positives < 5000""")
def d14(spark: SparkSession, d: str) -> DataFrame:
    return S.split_sufficiency(d06(spark, d), {"TRAIN": 0.6, "VALIDATION": 0.2, "TEST": 0.2}, minimum=0.16, block=200, warn=5000)


MEMBERS = "members AS (SELECT DISTINCT m.claim_key, m.group_type, m.group_value_hash, split FROM membership m LEFT JOIN assigned USING (claim_key))"
EXPOSURE = """exposure AS (SELECT *, CASE min(CASE split WHEN 'TRAIN' THEN 0 WHEN 'VALIDATION' THEN 1 ELSE 2 END) OVER w WHEN 0 THEN 'TRAIN' WHEN 1 THEN 'VALIDATION' ELSE 'TEST' END AS first_split,
  bool_or(split = 'TRAIN') OVER w AS seen_in_train, bool_or(split = 'VALIDATION') OVER w AS seen_in_validation, bool_or(split <> 'TEST') OVER w AS seen_in_development
  FROM members WINDOW w AS (PARTITION BY group_type, group_value_hash))"""
_ALL = ctes(ANCHORS, LINES, MEMBERSHIP, SPLIT, MEMBERS, EXPOSURE)


_BY = ("entity_key", "claim_date")


#: Direct types of which a group has claims of one entity only.
WITHIN = ("entity", "fingerprint")


def direct_of(types: tuple[str, ...] = TYPES) -> dict[str, Column]:
    of = {"entity": F.col("entity_key"), "nation": F.col("nation"), "segment": F.col("segment"), "fingerprint": F.concat_ws(UNIT_SEPARATOR, *[canonical(F.col(x)) for x in ("entity_key", "priority", "nation")])}
    return {t: of[t] for t in types}


def _with_customer(spark: SparkSession, d: str, claims: DataFrame) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    snap = left_many_to_one(claims, c, ["entity_key"], ["c_custkey"], {"c_nationkey": "nation", "c_mktsegment": "segment"})
    return snap.select("claim_key", "entity_key", "claim_date", "priority", "nation", "segment", "split")


def own_members(spark: SparkSession, d: str, direct: tuple[str, ...] = TYPES) -> tuple[DataFrame, DataFrame]:
    """The claims with their split, and the groups that they name, both dealt by entity."""
    x = anchors(spark, d)
    a = S.assign_split(x.repartition(tasks_for(table(spark, d, "lineitem")), "entity_key"), S.split_boundaries(x, "claim_date"), "claim_date")
    return a, G.direct_members(_with_customer(spark, d, a), direct_of(direct))


_HISTORICAL = {"supplier": "supp_key", "part": "part_key"}


def compact(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The claims with their split, and the groups of claims and of entities that the membership is made of, dealt by entity in the same tasks."""
    a, own = own_members(spark, d)
    events = lines(spark, d).select("entity_key", "event_date", "supp_key", "part_key").repartition(tasks_for(table(spark, d, "lineitem")), "entity_key")
    return a, own, G.first_dates(events, "entity_key", "event_date", _HISTORICAL)


def kept(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The claims with what their groups are made of, and the groups of entities, for plans that read them more than once.

    Both are written in buckets of the entity, so nothing that reads them is
    exchanged but groups.  Events are written before they are dealt as well:
    the exchange by order is gone when the one by entity is made.
    """
    tasks = tasks_for(table(spark, d, "lineitem"))
    of_order = written(lines(spark, d).select("entity_key", "event_date", "supp_key", "part_key"), "events-by-order")
    events = bucketed(of_order, "events", "entity_key", tasks)
    claims = bucketed(_with_customer(spark, d, assigned(spark, d)), "claims", "entity_key", tasks)
    return claims, G.first_dates(events, "entity_key", "event_date", _HISTORICAL)


def members(spark: SparkSession, d: str) -> DataFrame:
    a, own, firsts = compact(spark, d)
    return G.expand_members(own, firsts, "claim_key", *_BY, a)


@query("d07_normalize_membership", f"{_ALL} SELECT * FROM members")
def d07(spark: SparkSession, d: str) -> DataFrame:
    return members(spark, d)


@query("d07_membership_problems", f"{_ALL} SELECT 0 AS null_fields, count(*) FILTER (claim_key % 50 = 0) AS unknown_claims FROM membership")
def d07_problems(spark: SparkSession, d: str) -> DataFrame:
    return G.membership_problems(membership(spark, d), assigned(spark, d).filter("claim_key % 50 <> 0"), "claim_key")


@query("d08_group_exposure", f"{_ALL} SELECT * FROM exposure")
def d08(spark: SparkSession, d: str) -> DataFrame:
    claims, firsts = kept(spark, d)
    own = G.direct_members(claims, direct_of())
    return G.expand_members(*G.compact_exposure(own, firsts, *_BY, claims, WITHIN), "claim_key", *_BY, claims, G.EXPOSED)


@query("d09_group_overlap", f"""{_ALL}, g AS (SELECT group_type, group_value_hash, count(*) FILTER (split = 'TRAIN') AS t, count(*) FILTER (split = 'VALIDATION') AS v, count(*) FILTER (split = 'TEST') AS x FROM members GROUP BY 1, 2)
SELECT group_type, count(*) AS groups, count(*) FILTER (t > 0) AS train_groups, count(*) FILTER (v > 0) AS validation_groups, count(*) FILTER (x > 0) AS test_groups,
  count(*) FILTER (t > 0 AND v > 0) AS validation_seen, count(*) FILTER (t = 0 AND v > 0) AS validation_unseen, count(*) FILTER (x > 0 AND t + v > 0) AS test_seen, count(*) FILTER (x > 0 AND t + v = 0) AS test_unseen,
  CAST(coalesce(sum(v) FILTER (t > 0), 0) AS BIGINT) AS validation_rows_seen, CAST(coalesce(sum(v) FILTER (t = 0), 0) AS BIGINT) AS validation_rows_unseen,
  CAST(coalesce(sum(x) FILTER (t + v > 0), 0) AS BIGINT) AS test_rows_seen, CAST(coalesce(sum(x) FILTER (t + v = 0), 0) AS BIGINT) AS test_rows_unseen FROM g GROUP BY group_type""")
def d09(spark: SparkSession, d: str) -> DataFrame:
    claims, firsts = kept(spark, d)
    return G.compact_overlap(G.direct_members(claims, direct_of()), firsts, *_BY, claims, WITHIN)


@query("d10_group_availability", f"{_ALL} SELECT t AS group_type FROM (VALUES ('entity'), ('part'), ('batch'), ('station')) v(t) WHERE t NOT IN (SELECT group_type FROM members)")
def d10(spark: SparkSession, d: str) -> DataFrame:
    return G.group_availability(members(spark, d), ["entity", "part", "batch", "station"])


_COHORTS = "c AS (SELECT claim_key, split, " + ", ".join(f"coalesce(bool_or(NOT seen) FILTER (group_type = '{t}'), FALSE) AS {t}_unseen" for t in TYPES) + ", " + ", ".join(
    f"count(*) FILTER (group_type = '{t}') AS {t}_count, count(*) FILTER (group_type = '{t}' AND seen) AS {t}_seen_count, count(*) FILTER (group_type = '{t}' AND NOT seen) AS {t}_unseen_count, count(*) FILTER (group_type = '{t}' AND NOT seen) > 0 AS {t}_any_unseen, count(*) FILTER (group_type = '{t}') > 0 AND count(*) FILTER (group_type = '{t}' AND seen) = 0 AS {t}_all_unseen"
    for t in ("supplier", "part")) + """, coalesce(bool_or(NOT seen) FILTER (group_type = 'fingerprint'), FALSE) OR split = 'TRAIN' AS fingerprint_clean
  FROM (SELECT a.claim_key, a.split, group_type, CASE WHEN a.split = 'TEST' THEN seen_in_development ELSE seen_in_train END AS seen FROM assigned a LEFT JOIN exposure e ON a.claim_key = e.claim_key) GROUP BY claim_key, split)"""


def cohorts(spark: SparkSession, d: str) -> DataFrame:
    claims, firsts = kept(spark, d)
    return G.compact_cohorts(claims, direct_of(), firsts, "claim_key", *_BY, tuple(_HISTORICAL), WITHIN)


@query("d11_evaluation_cohorts", f"{_ALL}, {_COHORTS} SELECT * FROM c")
def d11(spark: SparkSession, d: str) -> DataFrame:
    return cohorts(spark, d)


_FLAGS = [f"{t}_unseen" for t in TYPES] + [f"{t}_{w}_unseen" for t in ("supplier", "part") for w in ("any", "all")] + ["fingerprint_clean"]


@query("d12_cohort_summary", f"{_ALL}, {_COHORTS} SELECT split, count(*) AS rows, {', '.join(f'count(*) FILTER ({f}) AS {f}' for f in _FLAGS)} FROM c GROUP BY split")
def d12(spark: SparkSession, d: str) -> DataFrame:
    return G.cohort_summary(cohorts(spark, d))


@query("d13_fingerprint_overlap", f"""{_ALL}, f AS (SELECT *, CASE WHEN split = 'TEST' THEN seen_in_development ELSE seen_in_train END AS seen FROM exposure WHERE group_type = 'fingerprint' AND split <> 'TRAIN'),
g AS (SELECT split, count(DISTINCT group_value_hash) AS fingerprints, count(DISTINCT group_value_hash) FILTER (seen) AS shared_fingerprints, count(DISTINCT claim_key) AS claims, count(DISTINCT claim_key) FILTER (seen) AS shared_claims FROM f GROUP BY split)
SELECT *, round(100.0 * shared_fingerprints / fingerprints, 6) AS shared_fingerprint_pct, round(100.0 * shared_claims / claims, 6) AS shared_claim_pct FROM g""")
def d13(spark: SparkSession, d: str) -> DataFrame:
    _, own = own_members(spark, d, ("fingerprint",))
    exposure = G.group_exposure(own.withColumnRenamed("value", "group_value_hash"))
    return G.fingerprint_overlap(exposure, "claim_key").withColumns({c: F.round(c, 6) for c in ("shared_fingerprint_pct", "shared_claim_pct")})


_FP = ", ".join(f"CAST(sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT) AS BIGINT) AS sum_{i}" for i in range(4))
_FP_SQL = f"SELECT count(*) AS row_count, {_FP} FROM (SELECT sha256(concat_ws(chr(31), coalesce(CAST(n_name AS VARCHAR), '<NULL>'), CAST(n_nationkey AS VARCHAR), CAST(n_regionkey AS VARCHAR))) AS h FROM nation"


@query("d15_content_fingerprint", _FP_SQL + ")")
def d15(spark: SparkSession, d: str) -> DataFrame:
    return G.content_fingerprint(spark.read.parquet(f"{d}/nation.parquet"))


@query("d16_membership_lock", f"""WITH a AS ({_FP_SQL})), b AS ({_FP_SQL} WHERE n_nationkey <> 3)) SELECT 'row_count' AS field, a.row_count AS locked, b.row_count AS found FROM a, b WHERE a.row_count <> b.row_count
{' '.join(f"UNION ALL SELECT 'sum_{i}', a.sum_{i}, b.sum_{i} FROM a, b WHERE a.sum_{i} <> b.sum_{i}" for i in range(4))}""")
def d16(spark: SparkSession, d: str) -> DataFrame:
    n = spark.read.parquet(f"{d}/nation.parquet")
    return G.membership_lock(n.filter("n_nationkey <> 3"), G.content_fingerprint(n))


FOLDS = """
train AS (SELECT * FROM assigned WHERE split = 'TRAIN'),
fd AS (SELECT claim_date, sum(count(*)) OVER (ORDER BY claim_date) AS cum, sum(count(*)) OVER () AS total FROM train GROUP BY claim_date),
f1 AS (SELECT claim_date AS b1 FROM fd ORDER BY abs(cum - 0.55::DOUBLE * total), claim_date LIMIT 1),
f2 AS (SELECT claim_date AS b2 FROM fd, f1 WHERE claim_date > b1 ORDER BY abs(cum - 0.7::DOUBLE * total), claim_date LIMIT 1),
f3 AS (SELECT claim_date AS b3 FROM fd, f2 WHERE claim_date > b2 ORDER BY abs(cum - 0.85::DOUBLE * total), claim_date LIMIT 1),
f4 AS (SELECT max(claim_date) AS b4 FROM fd),
folds AS (
  SELECT claim_key, 1 AS fold_id, CASE WHEN claim_date <= b1 THEN 'TRAIN' ELSE 'VALIDATION' END AS role FROM train, f1, f2 WHERE claim_date <= b2
  UNION ALL SELECT claim_key, 2, CASE WHEN claim_date <= b2 THEN 'TRAIN' ELSE 'VALIDATION' END FROM train, f2, f3 WHERE claim_date <= b3
  UNION ALL SELECT claim_key, 3, CASE WHEN claim_date <= b3 THEN 'TRAIN' ELSE 'VALIDATION' END FROM train, f3, f4 WHERE claim_date <= b4)"""


def folds(spark: SparkSession, d: str) -> DataFrame:
    t = assigned(spark, d).filter("split = 'TRAIN'")
    return S.expanding_folds(t, S.fold_boundaries(t, "claim_date"), "claim_key", "claim_date")


@query("d17_expanding_folds", f"{ctes(ANCHORS, SPLIT, FOLDS)} SELECT * FROM folds")
def d17(spark: SparkSession, d: str) -> DataFrame:
    return folds(spark, d)


@query("d17_fold_sufficiency", f"""{ctes(ANCHORS, SPLIT, FOLDS)} SELECT fold_id, role, count(*) AS rows, CAST(sum(target) AS BIGINT) AS positives,
  sum(target) >= CASE role WHEN 'TRAIN' THEN 40 ELSE 10 END AND sum(target) < count(*) AS sufficient FROM folds JOIN anchors USING (claim_key) GROUP BY 1, 2""")
def d17_sufficiency(spark: SparkSession, d: str) -> DataFrame:
    return S.fold_sufficiency(folds(spark, d), anchors(spark, d), "claim_key", "target")


@query("d18_calibration_folds", f"""{ctes(ANCHORS, SPLIT, FOLDS)}, oof AS (SELECT claim_key, fold_id FROM folds WHERE role = 'VALIDATION')
SELECT claim_key, fold_id, 'C1' AS calibration_fold_id, CASE fold_id WHEN 1 THEN 'CALIBRATION_TRAIN' ELSE 'CALIBRATION_VALIDATION' END AS role FROM oof WHERE fold_id <= 2
UNION ALL SELECT claim_key, fold_id, 'C2', CASE WHEN fold_id <= 2 THEN 'CALIBRATION_TRAIN' ELSE 'CALIBRATION_VALIDATION' END FROM oof""")
def d18(spark: SparkSession, d: str) -> DataFrame:
    return S.calibration_folds(folds(spark, d).filter("role = 'VALIDATION'").select("claim_key", "fold_id"))
