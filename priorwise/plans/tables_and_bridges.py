"""Queries for sources (A) and keys, joins and bridges (B)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from priorwise.functions.exprs import fingerprint
from priorwise.operators import bridges as B, groups as G, keys as K
from priorwise.sources import tables as S

from .bindings import ANCHORS, CLAIM, EVENT, LINES, MONTHS, anchors, ctes, lines, months, table
from .registry import query

CONTRACT = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"],
}


@query("a01_scan_explicit", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def a01(spark: SparkSession, d: str) -> DataFrame:
    return S.scan_explicit(spark, f"{d}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus"])


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in CONTRACT)


@query("a02_a03_exact_counts", _COUNTS)
def a02(spark: SparkSession, d: str) -> DataFrame:
    return S.exact_counts(S.scan_all_tables(spark, d, CONTRACT))


@query("a07_write_parquet", f"SELECT count(*) AS row_count, {len(CONTRACT['lineitem'])} AS column_count FROM lineitem")
def a07(spark: SparkSession, d: str) -> DataFrame:
    """What is found in the written table."""
    return S.write_parquet(S.scan_explicit(spark, f"{d}/lineitem.parquet", CONTRACT["lineitem"]), f"{S.shared_folder(spark)}/lineitem-{uuid.uuid4().hex}")


@query("a08_a09_publish_verified", "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders", dates=["o_orderdate"])
def a08(spark: SparkSession, d: str) -> DataFrame:
    """Orders published under a checked key and read again against their fingerprint."""
    orders = S.scan_explicit(spark, f"{d}/orders.parquet", CONTRACT["orders"])
    path = f"{S.shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    S.publish_staged(orders, path, "o_orderkey")
    return S.read_verified(spark, path, G.content_fingerprint(orders))


@query("a08_publish_versioned", "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders", dates=["o_orderdate"])
def a08_versions(spark: SparkSession, d: str) -> DataFrame:
    """Orders published as a version with a manifest, and the newest version read."""
    root = f"{S.shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    S.publish_versioned(S.scan_explicit(spark, f"{d}/orders.parquet", CONTRACT["orders"]), root, "o_orderkey")
    return S.read_version(spark, root)


@query("a04_chunks", "SELECT (rn - 1) // 1000 AS chunk, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, CAST(sum(o_custkey) AS BIGINT) AS customers FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1")
def a04(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of a thousand orders, in the order of their key."""
    rows = S.chunks(table(spark, d, "orders"), "o_orderkey", ["o_orderkey", "o_custkey"], 1000)
    return rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.sum("o_custkey").alias("customers"))


#: Field mappings: table and column of a field, and the join columns on the way to it.
MAPPINGS = [
    ("orders", "o_orderstatus", []), ("orders", "o_orderpriority", []), ("customer", "c_mktsegment", ["orders.o_custkey", "customer.c_custkey"]),
    ("nation", "n_name", ["orders.o_custkey", "customer.c_custkey", "customer.c_nationkey", "nation.n_nationkey"]), ("labels", "quality", []),
]


@query("a05_planned_scan", "SELECT o_orderstatus, o_orderpriority, c_mktsegment, n_name, count(*) AS claims FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4")
def a05(spark: SparkSession, d: str) -> DataFrame:
    """Each table is scanned for the columns that the plan finds its fields and joins need."""
    mappings = spark.createDataFrame(MAPPINGS, "source_table string, source_column string, join_columns array<string>")
    # a row a table
    needed = {r["table_name"]: r["columns"] for r in S.plan_columns(mappings, ["labels"]).collect()}
    t = {name: S.scan_explicit(spark, f"{d}/{name}.parquet", columns) for name, columns in needed.items()}
    wide = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left").join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return wide.groupBy("o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name").agg(F.count(F.lit(1)).alias("claims"))


@query("a06_scan_labels_semi", f"{ctes(ANCHORS)} SELECT claim_key, target FROM anchors WHERE entity_key IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def a06(spark: SparkSession, d: str) -> DataFrame:
    a = anchors(spark, d)
    allowed = a.join(table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'"), F.col("entity_key") == F.col("c_custkey"), "left_semi")
    return S.scan_labels_semi(a, allowed, "claim_key", "target")


@query("a06_label_guard", f"""{ctes(ANCHORS)}, allowed AS (SELECT DISTINCT doc_id FROM documents), got AS (SELECT * FROM labels WHERE doc_id IN (SELECT doc_id FROM allowed))
SELECT (SELECT count(*) FROM allowed WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS missing_labels,
       (SELECT count(*) FROM got WHERE quality IS NULL OR quality NOT IN (0, 1)) AS invalid_labels,
       (SELECT count(*) - count(DISTINCT doc_id) FROM got) AS duplicate_labels""")
def a06_guard(spark: SparkSession, d: str) -> DataFrame:
    return S.label_guard(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id", "quality")


def _keys_sql(t: str, keys: list[str]) -> str:
    k, null = ", ".join(keys), " OR ".join(f"{x} IS NULL" for x in keys)
    return f"""SELECT '{t}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count, CAST(coalesce(sum(n) FILTER ({null}), 0) AS BIGINT) AS null_keys,
      count(*) FILTER (NOT ({null}) AND n > 1) AS duplicate_values, CAST(coalesce(sum(n) FILTER (NOT ({null}) AND n > 1), 0) AS BIGINT) AS duplicate_rows
      FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})"""


_KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"], "supplier": ["s_suppkey"], "lineitem": ["l_orderkey", "l_linenumber"], "labels": ["doc_id"]}


@query("b01_b03_key_violations", " UNION ALL ".join(_keys_sql(t, k) for t, k in _KEYS.items()))
def b01(spark: SparkSession, d: str) -> DataFrame:
    parts = [K.key_violations(table(spark, d, t), k).withColumn("table_name", F.lit(t)) for t, k in _KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("b02_join_many_to_one", "SELECT l_orderkey, l_linenumber, l_shipdate, p_brand AS part_brand, p_type AS part_type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def b02(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    return K.join_many_to_one(li, table(spark, d, "part"), ["l_partkey"], ["p_partkey"], {"p_brand": "part_brand", "p_type": "part_type"}).drop("l_partkey")


@query("b02_join_audit", """
SELECT CAST(sum(n) AS BIGINT) AS input_rows, CAST(sum(n * coalesce(m, 1)) AS BIGINT) AS output_rows,
       CAST(coalesce(sum(n) FILTER (m IS NULL), 0) AS BIGINT) AS unmatched_rows, CAST(sum(n * (coalesce(m, 1) - 1)) AS BIGINT) AS multiplied_rows
FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1) LEFT JOIN (SELECT l_orderkey, count(*) AS m FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def b02_audit(spark: SparkSession, d: str) -> DataFrame:
    return K.join_audit(table(spark, d, "orders"), table(spark, d, "lineitem"), ["o_orderkey"], ["l_orderkey"])


def _context(spark: SparkSession, d: str) -> DataFrame:
    a = anchors(spark, d)
    return K.star_context(a, [
        (table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), ["entity_key"], ["c_custkey"], "customer_"),
        (table(spark, d, "nation"), ["c_nationkey"], ["n_nationkey"], "nation_"),
        (table(spark, d, "region"), ["n_regionkey"], ["r_regionkey"], "region_"),
    ])


_CONTEXT = "SELECT anchors.*, c_nationkey, c_mktsegment, n_name, n_regionkey, r_name FROM anchors LEFT JOIN customer ON entity_key = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"


@query("b04_star_context", f"{ctes(ANCHORS)} {_CONTEXT}", dates=["claim_date"])
def b04(spark: SparkSession, d: str) -> DataFrame:
    return _context(spark, d)


@query("b05_context_coverage", f"""{ctes(ANCHORS)}, c AS ({_CONTEXT})
SELECT (SELECT count(*) FROM anchors) AS input_rows, count(*) AS output_rows, count(n_name) AS with_nation, count(*) - count(n_name) AS without_nation,
       count(r_name) AS with_region, count(*) - count(r_name) AS without_region, CAST((SELECT count(*) FROM anchors) <> count(*) AS INTEGER) AS multiplied FROM c""")
def b05(spark: SparkSession, d: str) -> DataFrame:
    return K.context_coverage(_context(spark, d), anchors(spark, d), {"nation": "n_name", "region": "r_name"})


@query("b06_direct_snapshot", f"""{ctes(ANCHORS)} SELECT claim_key AS warranty_claim_key, claim_date AS claim__claim_date, target AS target__flag, c_mktsegment AS customer__segment, n_name AS location__nation
FROM anchors LEFT JOIN customer ON entity_key = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""", dates=["claim__claim_date"])
def b06(spark: SparkSession, d: str) -> DataFrame:
    joins = [
        (table(spark, d, "customer"), ["entity_key"], ["c_custkey"], {"c_mktsegment": "segment", "c_nationkey": "nationkey"}),
        (table(spark, d, "nation"), ["nationkey"], ["n_nationkey"], {"n_name": "nation"}),
    ]
    return K.direct_snapshot(anchors(spark, d), joins, {"claim_key": "warranty_claim_key", "claim_date": "claim__claim_date", "target": "target__flag", "segment": "customer__segment", "nation": "location__nation"})


# Policies: a brand is valid from its first ship date; open-ended for odd sizes, else for two years.
@query("b07_scd_validity", f"""{ctes(LINES)}, policy AS (SELECT p_partkey, p_brand, DATE '1995-01-01' + CAST(p_size * 30 AS INTEGER) AS valid_from,
  CASE WHEN p_size % 2 = 0 THEN DATE '1995-01-01' + CAST(p_size * 30 + 730 AS INTEGER) END AS valid_to FROM part)
SELECT event_key, event_date, CASE WHEN ok THEN p_brand END AS policy_brand, ok AS policy_valid FROM
  (SELECT event_key, event_date, p_brand, coalesce(valid_from <= event_date AND (valid_to IS NULL OR valid_to >= event_date), FALSE) AS ok FROM lines LEFT JOIN policy ON part_key = p_partkey)""", dates=["event_date"])
def b07(spark: SparkSession, d: str) -> DataFrame:
    start = F.date_add(F.to_date(F.lit("1995-01-01")), (F.col("p_size") * 30).cast("int"))
    policy = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("policy_brand"), start.alias("valid_from"), F.when(F.col("p_size") % 2 == 0, F.date_add(start, 730)).alias("valid_to"))
    j = K.left_many_to_one(lines(spark, d), policy, ["part_key"], ["p_partkey"], {c: c for c in policy.columns[1:]})
    return K.null_unless_valid(j, ["policy_brand"], "event_date", "valid_from", "valid_to", "policy_valid").select("event_key", "event_date", "policy_brand", "policy_valid")


@query("b08_eligibility", """SELECT l_orderkey * 100 + l_linenumber AS k, CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'INVALID_KEY' WHEN l_quantity > 45 THEN 'NULL_TARGET'
  WHEN l_quantity > 40 THEN 'INVALID_TARGET' WHEN l_shipdate < TIMESTAMP '1995-03-01' THEN 'MISSING_DATE' WHEN s_suppkey IS NULL THEN 'MISSING_L_SUPPKEY' ELSE 'ELIGIBLE' END AS eligibility
FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20) ON l_suppkey = s_suppkey""")
def b08(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    x = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("k"), F.when(q <= 40, 1).when(q <= 45, 7).alias("y"),
        F.when(F.col("l_shipdate") >= F.lit("1995-03-01").cast("timestamp"), F.to_date("l_shipdate")).alias("dt"), "l_suppkey")
    return K.classify_eligibility(x, "k", "y", "dt", {"l_suppkey": (table(spark, d, "supplier").filter("s_nationkey < 20"), "s_suppkey")})


@query("b09_bridge_strict_before", f"""{ctes(ANCHORS, LINES)} SELECT claim_key AS current_claim_key, event_key, event_date AS history__date, qty AS history__qty FROM anchors JOIN lines USING (entity_key) WHERE event_date < claim_date""", dates=["history__date"])
def b09(spark: SparkSession, d: str) -> DataFrame:
    return B.bridge_strict_before(anchors(spark, d), lines(spark, d), CLAIM, EVENT, {"event_key": "event_key", "event_date": "history__date", "qty": "history__qty"})


@query("b09_bridge_dealt", f"""{ctes(ANCHORS, LINES)} SELECT claim_key AS current_claim_key, event_key, event_date AS history__date, qty AS history__qty FROM anchors JOIN lines USING (entity_key) WHERE event_date < claim_date""", dates=["history__date"])
def b09_dealt(spark: SparkSession, d: str) -> DataFrame:
    """The same bridge with the claims of entities that make over 500 pairs dealt in blocks."""
    a, e = anchors(spark, d), S.written(lines(spark, d), "lines")
    heavy = S.written(B.heavy_entities(a, e, "entity_key", "entity_key", 500), "heavy")
    return B.bridge_strict_before(a, e, CLAIM, EVENT, {"event_key": "event_key", "event_date": "history__date", "qty": "history__qty"}, heavy=heavy).drop(B.BLOCK)


@query("b10_bridge_exclude_current", f"""{ctes(ANCHORS, LINES)} SELECT claim_key AS current_claim_key, event_key, event_date AS service__date FROM anchors JOIN lines USING (entity_key) WHERE event_date < claim_date AND order_key IS DISTINCT FROM claim_key""", dates=["service__date"])
def b10(spark: SparkSession, d: str) -> DataFrame:
    a = anchors(spark, d).withColumn("own", F.col("claim_key"))
    return B.bridge_exclude_current(a, lines(spark, d), CLAIM, EVENT, "own", "order_key", {"event_key": "event_key", "event_date": "service__date"})


@query("b11_bridge_completed_month", f"""{ctes(ANCHORS, LINES, MONTHS)} SELECT claim_key AS current_claim_key, month_key, month_start AS telemetry__month_start, qty AS telemetry__qty FROM anchors JOIN months USING (entity_key) WHERE last_day(month_start) < claim_date""", dates=["telemetry__month_start"])
def b11(spark: SparkSession, d: str) -> DataFrame:
    return B.bridge_completed_month(anchors(spark, d), months(spark, d), CLAIM, ("entity_key", "month_start"), {"month_key": "month_key", "month_start": "telemetry__month_start", "qty": "telemetry__qty"})


@query("b12_bridge_with_dimension", f"""{ctes(ANCHORS, LINES)} SELECT claim_key AS current_claim_key, event_key, p_type AS component__system, p_brand AS component__category FROM anchors JOIN lines USING (entity_key) LEFT JOIN part ON part_key = p_partkey WHERE event_date < claim_date""")
def b12(spark: SparkSession, d: str) -> DataFrame:
    dim = table(spark, d, "part").select("p_partkey", "p_type", "p_brand")
    return B.bridge_with_dimension(anchors(spark, d), lines(spark, d), dim, CLAIM, EVENT, ("part_key", "p_partkey"), {"event_key": "event_key", "p_type": "component__system", "p_brand": "component__category"})


_TAXONOMY = "taxonomy AS (SELECT DISTINCT o_orderpriority AS code, substr(o_orderpriority, 3) AS severity FROM orders)"


@query("b13_bridge_self_prior", f"""{ctes(ANCHORS, _TAXONOMY)} SELECT a.claim_key AS current_claim_key, p.claim_key AS prior_claim_key, p.claim_date AS prior_claim__date, severity AS prior_failure__severity
FROM anchors a JOIN anchors p ON a.entity_key = p.entity_key AND p.claim_date < a.claim_date AND p.claim_key <> a.claim_key LEFT JOIN taxonomy ON p.priority = code""", dates=["prior_claim__date"])
def b13(spark: SparkSession, d: str) -> DataFrame:
    a = anchors(spark, d)
    tax = a.select(F.col("priority").alias("code"), F.expr("substr(priority, 3)").alias("severity")).distinct()
    return B.bridge_self_prior(a, CLAIM, {"claim_key": "prior_claim_key", "claim_date": "prior_claim__date"}, (tax, "priority", "code", {"severity": "prior_failure__severity"}))


_ENDED = "ended AS (SELECT anchors.*, repair_end FROM anchors LEFT JOIN (SELECT order_key, max(event_date) AS repair_end FROM lines GROUP BY 1) ON order_key = claim_key)"


@query("b14_bridge_completed_prior", f"""{ctes(ANCHORS, LINES, _ENDED)} SELECT a.claim_key AS current_claim_key, event_key, cents AS repair__cents
FROM ended a JOIN ended p ON a.entity_key = p.entity_key AND p.repair_end < a.claim_date AND p.claim_key <> a.claim_key JOIN lines l ON l.order_key = p.claim_key""")
def b14(spark: SparkSession, d: str) -> DataFrame:
    x = lines(spark, d)
    end = x.groupBy(F.col("order_key").alias("k")).agg(F.max("event_date").alias("repair_end"))
    a = anchors(spark, d)
    a = a.join(end, a["claim_key"] == end["k"], "left").drop("k")
    return B.bridge_completed_prior(a, x, CLAIM, "repair_end", "order_key", {"event_key": "event_key", "cents": "repair__cents"})


@query("b15_history_coverage", f"""{ctes(ANCHORS, LINES)}, n AS (SELECT claim_key, count(event_key) AS n FROM anchors LEFT JOIN lines ON anchors.entity_key = lines.entity_key AND event_date < claim_date GROUP BY 1)
SELECT count(*) AS claims, count(*) FILTER (n > 0) AS with_history, count(*) FILTER (n = 0) AS without_history, min(n) AS min_rows,
       quantile_cont(n, 0.5) AS median_rows, round(quantile_cont(n, 0.95), 6) AS p95_rows, max(n) AS max_rows FROM n""")
def b15(spark: SparkSession, d: str) -> DataFrame:
    return B.history_coverage(anchors(spark, d), b09(spark, d), "claim_key").withColumn("p95_rows", F.round("p95_rows", 6))


# The claim's own component: the part of its first line, none where that part's size is a multiple of 9.
_CAUSAL = """causal AS (SELECT a.*, CASE WHEN p_size % 9 <> 0 THEN f.part_key END AS component, claim_date - CAST(claim_key % 40 AS INTEGER) AS failure_date
  FROM anchors a LEFT JOIN (SELECT order_key, min_by(part_key, event_key) AS part_key FROM lines GROUP BY 1) f ON f.order_key = claim_key LEFT JOIN part ON f.part_key = p_partkey)"""


_MATCH = f"""{ctes(ANCHORS, LINES, _CAUSAL)}, pairs AS (
  SELECT c.claim_key, l.event_key, l.supp_key, l.line_status, rank() OVER (PARTITION BY c.claim_key ORDER BY l.event_date DESC) AS r, count(*) OVER (PARTITION BY c.claim_key) AS n
  FROM causal c JOIN lines l ON c.entity_key = l.entity_key AND c.component = l.part_key AND l.event_date <= coalesce(c.failure_date, c.claim_date)
), best AS (SELECT claim_key, count(*) AS ties, count(DISTINCT supp_key || '|' || line_status) AS vals, min_by(supp_key, event_key) AS supp_key, min_by(line_status, event_key) AS line_status, max(n) AS n FROM pairs WHERE r = 1 GROUP BY 1)
SELECT c.claim_key, CASE WHEN component IS NULL THEN 'no_causal_component' WHEN ties IS NULL THEN 'unmatched' WHEN vals > 1 THEN 'ambiguous' ELSE 'matched' END AS match_status,
       coalesce(ties > 1, FALSE) AS tied, coalesce(n, 0) AS n_candidates, CASE WHEN vals = 1 THEN supp_key END AS supp_key, CASE WHEN vals = 1 THEN line_status END AS line_status
FROM causal c LEFT JOIN best USING (claim_key)"""


@query("b16_asof_latest_match", _MATCH)
def b16(spark: SparkSession, d: str) -> DataFrame:
    a, x = anchors(spark, d), lines(spark, d)
    first = x.groupBy(F.col("order_key").alias("k")).agg(F.min_by("part_key", "event_key").alias("fp"))
    p = table(spark, d, "part").select("p_partkey", "p_size")
    c = a.join(first, a["claim_key"] == first["k"], "left").join(p, F.col("fp") == F.col("p_partkey"), "left")
    c = c.withColumns({"component": F.when(F.col("p_size") % 9 != 0, F.col("fp")), "failure_date": F.expr("date_sub(claim_date, cast(claim_key % 40 as int))")}).drop("k", "fp", "p_partkey", "p_size")
    return B.asof_latest_match(c, x.drop("order_key"), ("claim_key", "entity_key", "claim_date", "failure_date"), "component", ("entity_key", "part_key", "event_date"), ["supp_key", "line_status"], ["event_key"])


@query("b16_match_counters", f"""SELECT count(*) FILTER (match_status = 'no_causal_component') AS no_causal_component, count(*) FILTER (match_status = 'matched') AS matched, count(*) FILTER (match_status IN ('unmatched', 'ambiguous')) AS unmatched,
  count(*) FILTER (tied) AS ambiguous, count(*) FILTER (n_candidates > 1) AS multi_history FROM ({_MATCH})""")
def b16_counters(spark: SparkSession, d: str) -> DataFrame:
    return B.match_counters(b16(spark, d))


@query("b17_align_one_to_one", f"""{ctes(ANCHORS)}, other AS (SELECT doc_id AS claim_key, quality AS target FROM labels)
SELECT count(*) FILTER (a.claim_key IS NOT NULL AND o.claim_key IS NOT NULL) AS matched, count(*) FILTER (o.claim_key IS NULL) AS left_only, count(*) FILTER (a.claim_key IS NULL) AS right_only,
       count(*) FILTER (a.claim_key IS NOT NULL AND o.claim_key IS NOT NULL AND a.target IS DISTINCT FROM o.target) AS mismatched_target FROM anchors a FULL JOIN other o ON a.claim_key = o.claim_key""")
def b17(spark: SparkSession, d: str) -> DataFrame:
    other = table(spark, d, "labels").select(F.col("doc_id").alias("claim_key"), F.col("quality").alias("target"))
    return K.align_one_to_one(anchors(spark, d), other, "claim_key", ["target"])


_FKS = [("lineitem", "orders", "l_orderkey", "o_orderkey"), ("orders", "customer", "o_custkey", "c_custkey"), ("lineitem", "part", "l_partkey", "p_partkey"), ("lineitem", "supplier", "l_suppkey", "s_suppkey"), ("labels", "documents", "doc_id", "doc_id"), ("documents", "labels", "doc_id", "doc_id")]


def _fk_sql(c: str, p: str, ck: str, pk: str) -> str:
    return f"""SELECT '{c}.{ck}' AS fk_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_checked, CAST(coalesce(sum(n) FILTER (p.k IS NULL), 0) AS BIGINT) AS orphan_rows,
      round(100.0 * coalesce(sum(n) FILTER (p.k IS NULL), 0) / sum(n), 6) AS orphan_pct, count(*) FILTER (n IS NULL) AS childless_parents
      FROM (SELECT {ck} AS k, count(*) AS n FROM {c} WHERE {ck} IS NOT NULL GROUP BY 1) c FULL JOIN (SELECT DISTINCT {pk} AS k FROM {p} WHERE {pk} IS NOT NULL) p ON c.k = p.k"""


@query("b18_fk_orphans", " UNION ALL ".join(_fk_sql(*x) for x in _FKS))
def b18(spark: SparkSession, d: str) -> DataFrame:
    parts = [K.fk_orphans(table(spark, d, c), table(spark, d, p), [ck], [pk], f"{c}.{ck}") for c, p, ck, pk in _FKS]
    return reduce(DataFrame.unionByName, parts).withColumn("orphan_pct", F.round("orphan_pct", 6))


@query("b19_bridge_violations", f"""{ctes(ANCHORS, LINES)}, loose AS (SELECT claim_key AS current_claim_key, order_key, event_date FROM anchors JOIN lines USING (entity_key) WHERE event_date <= claim_date)
SELECT count(*) AS bridge_rows, count(*) FILTER (event_date >= claim_date) AS not_earlier, count(*) FILTER (order_key = claim_key) AS own_event, count(*) FILTER (claim_key IS NULL) AS unknown_claims
FROM loose LEFT JOIN (SELECT * FROM anchors WHERE claim_key % 10 <> 0) a ON current_claim_key = claim_key""")
def b19(spark: SparkSession, d: str) -> DataFrame:
    a, x = anchors(spark, d), lines(spark, d)
    loose = a.join(x, "entity_key").filter("event_date <= claim_date").select(F.col("claim_key").alias("current_claim_key"), "order_key", "event_date")
    known = a.filter("claim_key % 10 <> 0").withColumn("own", F.col("claim_key"))
    return B.bridge_violations(known, loose, "claim_key", "claim_date", "event_date", current=("own", "order_key"))


def membership(spark: SparkSession, d: str) -> DataFrame:
    a = anchors(spark, d)
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    snap = K.left_many_to_one(a, c, ["entity_key"], ["c_custkey"], {"c_nationkey": "nation", "c_mktsegment": "segment"})
    hist = B.bridge_strict_before(a, lines(spark, d), CLAIM, EVENT, {"supp_key": "supp_key", "part_key": "part_key"})
    return G.group_membership(snap, "claim_key", {"entity": "entity_key", "nation": "nation", "segment": "segment"}, {"supplier": (hist, "current_claim_key", "supp_key"), "part": (hist, "current_claim_key", "part_key")}, ["entity_key", "priority", "nation"])


MEMBERSHIP = """
snap AS (SELECT anchors.*, c_nationkey AS nation, c_mktsegment AS segment FROM anchors LEFT JOIN customer ON entity_key = c_custkey),
membership AS (
  SELECT claim_key, 'entity' AS group_type, sha256(CAST(entity_key AS VARCHAR)) AS group_value_hash FROM snap WHERE entity_key IS NOT NULL
  UNION ALL SELECT claim_key, 'nation', sha256(CAST(nation AS VARCHAR)) FROM snap WHERE nation IS NOT NULL
  UNION ALL SELECT claim_key, 'segment', sha256(segment) FROM snap WHERE segment IS NOT NULL
  UNION ALL SELECT claim_key, 'supplier', sha256(CAST(supp_key AS VARCHAR)) FROM anchors JOIN lines USING (entity_key) WHERE event_date < claim_date
  UNION ALL SELECT claim_key, 'part', sha256(CAST(part_key AS VARCHAR)) FROM anchors JOIN lines USING (entity_key) WHERE event_date < claim_date
  UNION ALL SELECT claim_key, 'fingerprint', sha256(concat_ws(chr(31), coalesce(CAST(entity_key AS VARCHAR), '<NULL>'), coalesce(priority, '<NULL>'), coalesce(CAST(nation AS VARCHAR), '<NULL>'))) FROM snap
)"""


@query("b20_group_membership", f"{ctes(ANCHORS, LINES, MEMBERSHIP)} SELECT * FROM membership")
def b20(spark: SparkSession, d: str) -> DataFrame:
    return membership(spark, d)


@query("b21_row_fingerprint", "SELECT p_partkey, sha256(concat_ws(chr(31), coalesce(p_name, '<NULL>'), coalesce(p_brand, '<NULL>'), coalesce(p_type, '<NULL>'), coalesce(CAST(p_size AS VARCHAR), '<NULL>'))) AS row_fingerprint FROM part")
def b21(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", fingerprint([F.col(c) for c in ("p_name", "p_brand", "p_type", "p_size")]).alias("row_fingerprint"))


@query("b22_attach_anchor_dates", f"""{ctes(ANCHORS, LINES)} SELECT claim_key AS current_claim_key, event_key, event_date, claim_date AS anchor_date FROM anchors JOIN lines USING (entity_key) WHERE event_date < claim_date""", dates=["event_date", "anchor_date"])
def b22(spark: SparkSession, d: str) -> DataFrame:
    bridge = B.bridge_strict_before(anchors(spark, d), lines(spark, d), CLAIM, EVENT, {"event_key": "event_key", "event_date": "event_date"})
    return B.attach_anchor_dates(anchors(spark, d), bridge, "claim_key", "claim_date", "event_date")


