"""Queries that have to work on every row of their tables, against brute force."""

import collections
import hashlib
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from priorwise.operators import robustness as R, textfeatures as T
from priorwise.plans import robustness_queries as Q
from priorwise.plans.catalog import QUERIES

DATA = "/root/testdata/sf0.001"


def ten_metrics(y, p, t):
    order = np.argsort(-p, kind="stable")
    y, p = y[order], p[order]
    last = np.append(np.flatnonzero(np.diff(p)), len(p) - 1)
    tp, fp = np.cumsum(y)[last], np.cumsum(1 - y)[last]
    P, N = tp[-1], fp[-1]
    dp, dn = np.diff(tp, prepend=0), np.diff(fp, prepend=0)
    a, b = int(y[p >= t].sum()), int((1 - y)[p >= t].sum())
    c, d = P - a, N - b
    ratio = lambda x, z: x / z if z else 0.0
    return {
        "average_precision": (dp / P * tp / (tp + fp)).sum(), "roc_auc": (dn * (tp - dp / 2)).sum() / (P * N), "log_loss": -np.mean(np.where(y == 1, np.log(p), np.log(1 - p))), "brier": np.mean((p - y) ** 2),
        "precision": ratio(a, a + b), "recall": a / P, "f1": ratio(2 * a, 2 * a + b + c), "f2": ratio(5 * a, 5 * a + b + 4 * c), "mcc": ratio(a * d - b * c, float((a + b) * P * N * (c + d)) ** 0.5), "balanced_accuracy": (a / P + d / N) / 2,
    }


def test_bootstrap_follows_single_draws(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGE_ROWS", 20)
    rng = np.random.default_rng(5)
    y = (rng.random(400) < 0.3).astype(int)
    p = np.round(np.clip(rng.normal(0.35 + 0.15 * y, 0.15), 0.01, 0.99), 2)
    df = spark.createDataFrame([("a", int(v), float(x)) for v, x in zip(y, p)] + [("b", 1, 0.5), (None, 0, 0.5)], "g string, y int, p double")
    got = {(r.g, r.metric): r for r in R.bootstrap_ci(R.bootstrap_metrics(df, 1000, 0.4, ["g"]), 1000, ["g"]).collect()}
    assert len(got) == 30 and {r.failed for (g, _), r in got.items() if g == "a"} == {0} and {(r.failed, r.low) for (g, _), r in got.items() if g != "a"} == {(1000, None)}
    pos, neg = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    drawn = [np.concatenate([rng.choice(pos, len(pos)), rng.choice(neg, len(neg))]) for _ in range(1000)]
    drawn = [ten_metrics(y[i], p[i], 0.4) for i in drawn]
    for m, value in ten_metrics(y, p, 0.4).items():
        r, v = got["a", m], np.array([x[m] for x in drawn])
        assert r.point == pytest.approx(value)
        near = 0.5 * v.std()
        assert abs(r.mean - v.mean()) < 0.2 * v.std() and abs(r.low - np.quantile(v, 0.025)) < near and abs(r.high - np.quantile(v, 0.975)) < near


def test_bootstrap_takes_every_row_and_metric(spark):
    rows = [(r.y, r.p) for r in Q.parts(spark, DATA)[1].select("y", "p").collect()]
    want = ten_metrics(*map(np.array, zip(*rows)), 0.4)
    got = {r.metric: r for r in QUERIES["i12_bootstrap_ci"](spark, DATA).collect()}
    assert {m: r.point for m, r in got.items()} == pytest.approx(want, abs=1e-6)
    assert all(r.failed == 0 and r.low <= r.point <= r.high for r in got.values())


def test_bootstrap_takes_every_supported_slice(spark):
    y = {r.claim_key: r.y for r in Q.parts(spark, DATA)[1].select("claim_key", "y").collect()}
    labels = {}
    for r in Q.slices(spark, DATA).collect():
        labels.setdefault(f"{r.slice_id}={r.label}", []).append(y[r.claim_key])
    want = {k for k, v in labels.items() if len(v) >= 75 and sum(v) >= 8 and len(v) - sum(v) >= 20}
    got = QUERIES["i13_slice_bootstrap"](spark, DATA).collect()
    assert {r.slice for r in got} == want and len(want) < len(labels) and {k.split("=")[0] for k in want} > {"level", "third"}
    assert len(got) == 10 * len(want)


def test_support_counts_every_row(spark):
    rows = QUERIES["h17_support_status"](spark, DATA).collect()
    n = spark.read.parquet(f"{DATA}/orders.parquet").count()
    assert [sum(r.rows for r in rows if r.grain == g) for g in ("month", "day")] == [n, n]
    for r in rows:
        assert r.support == ("LOW_SUPPORT" if r.rows < 75 or r.positives < 5 or r.rows - r.positives < 20 else "SUPPORTED")
        assert (r.average_precision is None) == (r.positives in (0, r.rows))
    assert any(r.average_precision is None for r in rows) and any(r.average_precision is not None for r in rows)


def test_texts_of_every_script_are_normalised(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    one = lambda t: " ".join(unicodedata.normalize("NFKC", t).split()).casefold() or None
    want = {r.doc_id: (len(t), hashlib.md5(t.encode()).hexdigest()) for r in docs if (t := one(r.text))}
    got = {r.doc_id: (r.n, r.digest) for r in QUERIES["f01_normalize_description"](spark, DATA).collect()}
    assert len(got) == len(docs) and {k: v for k, v in got.items() if v[0]} == want and len({r.lang for r in docs}) == 4
    assert {r.item_id: r.t for r in QUERIES["c05_normalize_ws"](spark, DATA).collect()} == {r.item_id: fold(r.text) for r in items}
    odd = spark.createDataFrame([(" Straße  GROSS ",), (None,), (" ",)], "t string")
    assert [r.t for r in odd.select(T.fold_space("t").alias("t")).collect()] == ["strasse gross", "", ""]


def fold(t):
    return re.sub(r"\s+", " ", (t or "").strip().casefold())


def test_text_audit_takes_every_labelled_text(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[fold(r.text)].append(r.quality)
    groups.pop("", None)
    hit = [v for t, vs in groups.items() if "the" in t or "$$$" in t for v in vs]
    all_, many = [v for vs in groups.values() for v in vs], [vs for vs in groups.values() if len(vs) > 1]
    r = QUERIES["c33_text_audit"](spark, DATA).first()
    assert (r.rows, r.distinct_texts, r.duplicated_rows, r.pure_groups) == (len(all_), len(groups), sum(map(len, many)), sum(len(set(v)) == 1 for v in many))
    assert (r.word_rate_1, r.word_rate_0) == pytest.approx((sum(hit) / sum(all_), hit.count(0) / all_.count(0)), abs=1e-6)


def test_association_has_every_field(spark):
    assert {(r.field, r.method) for r in QUERIES["c11_c12_c14_association"](spark, DATA).collect()} == {(f, "point_biserial") for f in ("total_cents", "entity_key")} | {(f, "cramers_v") for f in ("priority", "entity_key")}


def test_isotonic_fits_exact_scores(spark):
    a, b = (np.array([(r.p, r.y) for r in x.select("p", "y").collect()]) for x in Q.parts(spark, DATA))
    xs, at, n = np.unique(a[:, 0], return_inverse=True, return_counts=True)
    assert len(xs) > 101
    blocks = []
    for x, mean, w in zip(xs, np.bincount(at, a[:, 1]) / n, n):
        blocks.append([mean, w, [x]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, m, c = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * m) / (u[1] + m), u[1] + m, u[2] + c]
    ys = np.concatenate([np.full(len(c), v) for v, _, c in blocks])
    q = np.interp(b[:, 0], xs, ys)
    r = QUERIES["g09_g11_isotonic"](spark, DATA).first()
    assert r.rows == len(b)
    assert (r.brier, r.mean_p) == pytest.approx((np.mean((q - b[:, 1]) ** 2), q.mean()), abs=6e-5)


def test_bootstrap_places_are_not_taken_in_one_task_a_class(spark):
    df = spark.createDataFrame([(k, int(k % 3 == 0), 0.5) for k in range(7, 3000, 7)], "k long, y int, p double")
    w = R.bootstrap_weights(df, "k", 2)
    # places come from a range-partitioned table: no window sorts a class
    plan = w._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
    n = df.count()
    assert {r["sum(weight)"] for r in w.groupBy("replicate").sum("weight").collect()} == {n}


def _exchanged(df):
    """Columns of each exchange of the plan, as text."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]


@pytest.mark.parametrize("name", ["d07_normalize_membership", "d08_group_exposure"])
def test_hashes_are_not_exchanged(spark, name):
    """no exchange is by hash of text."""
    from priorwise.plans.catalog import QUERIES

    assert not [x for x in _exchanged(QUERIES[name](spark, "/root/testdata/sf0.001")) if "group_value_hash" in x]


def test_compact_groups_equal_plain_ones(spark):
    """Compact groups against exposure, overlap and cohorts of the plain membership, with ties of dates, nulls, repeats and an entity without events."""
    import datetime as dt

    from priorwise.operators import groups as G

    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    claims = spark.createDataFrame([(1, 7, day(5), "TRAIN"), (2, 7, day(9), "VALIDATION"), (3, 8, day(9), "VALIDATION"), (4, 8, day(12), "TEST"), (5, 9, day(12), "TEST"), (6, None, day(1), "TRAIN")], "k int, e int, day date, split string")
    events = spark.createDataFrame([(7, day(5), 50, 1), (7, day(6), 50, 2), (7, day(4), 51, None), (8, day(1), 50, 1), (8, day(10), 51, 1), (8, day(12), 52, 3), (None, day(0), 50, 1), (8, None, 53, 3), (8, day(2), 50, 1)], "e int, at date, supp int, part int")
    own, firsts = G.compact_members(claims, {"entity": F.col("e")}, events, "e", "at", {"supplier": "supp", "part": "part"})
    j = claims.alias("c").join(events.alias("v"), (F.col("c.e") == F.col("v.e")) & (F.col("at") < F.col("day"))).select(F.col("k").alias("current_claim_key"), "supp", "part")
    plain = G.normalize_membership(G.group_membership(claims, "k", {"entity": "e"}, {"supplier": (j, "current_claim_key", "supp"), "part": (j, "current_claim_key", "part")}), claims, "k")
    same = lambda a, b: sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect()))
    assert same(G.expand_members(own, firsts, "k", "e", "day", claims), plain)
    exposure = G.expand_members(*G.compact_exposure(own, firsts, "e", "day", claims), "k", "e", "day", claims, G.EXPOSED)
    assert same(exposure, G.group_exposure(plain))
    assert same(G.compact_overlap(own, firsts, "e", "day", claims), G.group_overlap(plain))


@pytest.mark.parametrize(("name", "most"), [("d08_group_exposure", 0), ("d09_group_overlap", 1), ("d11_evaluation_cohorts", 0), ("d12_cohort_summary", 0)])
def test_groups_are_not_exchanged_with_their_claims(spark, name, most):
    """No exchange is by a group's value but the one that adds up its counts."""
    from priorwise.plans.catalog import QUERIES

    found = [x for x in _exchanged(QUERIES[name](spark, "/root/testdata/sf0.001")) if "value#" in x.split("ENSURE")[0]]
    assert len(found) <= most


def test_groups_that_not_every_split_has_seen(spark):
    """groups of one entity, groups of many and groups without TRAIN or VALIDATION have the flags of the plain exposure."""
    import datetime as dt

    from priorwise.operators import groups as G

    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    claims = spark.createDataFrame([(k, k % 4, "n" + str(k % 3 + (5 if k > 17 else 0)), day(k), "TRAIN" if k < 12 else "VALIDATION" if k < 16 else "TEST") for k in range(20)] + [(20, None, "n0", day(19), "TEST"), (21, 9, None, day(13), "VALIDATION"), (22, 8, "only", day(1), "TRAIN")], "k int, e int, nation string, day date, split string")
    events = spark.createDataFrame([(e, day(n), (e * n) % 5, n) for e in (0, 1, 2, 3, 9) for n in (2, 9, 12, 14, 17)], "e int, at date, supp int, part int")
    own, firsts = G.compact_members(claims, {"entity": F.col("e"), "nation": F.col("nation")}, events, "e", "at", {"supplier": "supp", "part": "part"})
    plain = G.group_exposure(G.expand_members(own, firsts, "k", "e", "day", claims))
    got = G.expand_members(*G.compact_exposure(own, firsts, "e", "day", claims, ["entity"]), "k", "e", "day", claims, G.EXPOSED)
    kinds = {(r.seen_in_train, r.seen_in_validation) for r in got.collect()}
    assert len(kinds) == 4
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, plain.select(*sorted(got.columns)).collect()))


def test_texts_are_folded_one_at_a_time(spark):
    """marks made text by text equal those of whole folded columns, and no folded text comes back from Python."""
    from priorwise.operators import profile as P, textfeatures as T
    from priorwise.plans.catalog import QUERIES

    odd = spark.createDataFrame([(1, "  Stra\u00dfe\t THE  end "), (2, None), (3, "\u2003 \n"), (4, "a $$$"), (5, "strasse the END"), (6, "")], "doc_id int, text string").repartition(2)
    key = lambda df: sorted((r.doc_id, bytes(r.t), r.w) for r in df.select("doc_id", "t", "w").collect())
    got = key(T.folded_marks(odd, ["doc_id"], "text", ["the", "$$$"]))
    assert len(got) == 3
    assert got == key(P.text_marks(odd, ["doc_id"], "text", ["the", "$$$"], T.fold_space))
    assert "ArrowEvalPython" not in QUERIES["c33_text_audit"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("a_task", [4_000_000, 7])
def test_draws_are_counted_where_they_are_made(spark, monkeypatch, a_task):
    """weights equal those of plain loops, in one block and in several; draws of one block are not exchanged."""
    import hashlib
    from collections import Counter

    from priorwise.operators import robustness as R

    monkeypatch.setattr(R, "DRAWS_A_TASK", a_task)
    keys = [(g, k, int(k % 3 == 0)) for g in ("a", "b") for k in range(5, 40 if g == "a" else 12)]
    got = R.bootstrap_weights(spark.createDataFrame(keys, "g string, k long, y int"), "k", 3, ["g"])
    want = Counter()
    for g, y in {(g, y) for g, _, y in keys}:
        of = sorted(k for h, k, z in keys if (h, z) == (g, y))
        for r in (1, 2, 3):
            for i in range(len(of)):
                want[g, r, of[int(hashlib.md5(f"17:{r}:{g}:{y}:{i}".encode()).hexdigest()[:12], 16) % len(of)]] += 1
    assert {(r.g, r.replicate, r.k): r.weight for r in got.collect()} == want
    assert any("at#" in x.split("ENSURE")[0] for x in _exchanged(got)) == (a_task < 100)


def test_coverage_of_an_entity_without_events(spark, tmp_path):
    """claims of an entity that has no event expect the months of each window, in the query and in its SQL."""
    import duckdb

    from priorwise.plans.catalog import ORACLES

    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"create table {t} as select * from '{DATA}/{t}.parquet'")
    con.execute("delete from lineitem where l_orderkey in (select o_orderkey from orders where o_custkey = (select min(o_custkey) from orders))")
    for t in ("orders", "lineitem", "part"):
        con.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
    df = QUERIES["e11_e12_coverage_ratio"](spark, str(tmp_path))
    expected = con.execute(ORACLES["e11_e12_coverage_ratio"])
    columns = [c[0] for c in expected.description]
    got = sorted(tuple(r) for r in df.select(*columns).collect())
    assert sorted(columns) == sorted(df.columns)
    want = sorted(expected.fetchall())
    key = lambda r: tuple(repr(float(x)) if x is not None else "" for x in r)
    assert sorted(map(key, got)) == sorted(map(key, want))
    lost = con.execute("select o_orderkey from orders where o_custkey = (select min(o_custkey) from orders)").fetchall()
    mine = df.filter(F.col("current_claim_key").isin([k for (k,) in lost]))
    assert {r[0] for r in mine.select("telemetry_months_expected_3m").collect()} == {3}
    assert {r[0] for r in mine.select("telemetry_months_expected_all").collect()} == {None}


def test_membership_is_counted_before_claims_are_looked_up(spark):
    """what is exchanged by claim is a row a claim."""
    plan = QUERIES["d07_membership_problems"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [claim_key" in plan


def test_flagship_makes_pairs_once(spark):
    """the claim's date comes along in the bridge, so pairs are not joined to claims again."""
    plan = QUERIES["e01_e05_window_metrics"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2


def test_tasks_follow_the_number_of_events(spark):
    """Bridges are dealt in tasks that follow the events, not the session's shuffle partitions."""
    from priorwise.operators import bridges as B

    assert B.tasks_for(spark.range(1000)) == 1
    assert B.tasks_for(spark.range(40_000)) == 4
    assert B.tasks_for(spark.range(100 * B.EVENTS_A_TASK + 1)) == 101


def _odd_claims(spark):
    """Claims and events with ties of dates, nulls, an entity without events and groups that not every split has seen."""
    import datetime as dt

    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    claims = spark.createDataFrame([(k, k % 4, "n" + str(k % 3 + (5 if k > 17 else 0)), day(k), "TRAIN" if k < 12 else "VALIDATION" if k < 16 else "TEST") for k in range(20)] + [(20, None, "n0", day(19), "TEST"), (21, 9, None, day(13), "VALIDATION"), (22, 8, "only", day(1), "TRAIN"), (23, None, None, day(3), "TRAIN")], "k int, e int, nation string, day date, split string")
    events = spark.createDataFrame([(e, day(n), (e * n) % 5 or None, n) for e in (0, 1, 2, 3, 9) for n in (2, 9, 12, 14, 17)] + [(None, day(0), 1, 1)], "e int, at date, supp int, part int")
    return claims, events


def test_compact_overlap_and_cohorts_equal_plain_ones(spark):
    """counts by type and flags by claim, made where the entity is, equal those of the plain membership."""
    from priorwise.operators import groups as G

    claims, events = _odd_claims(spark)
    direct = {"entity": F.col("e"), "nation": F.col("nation"), "fingerprint": F.concat_ws("|", F.coalesce(F.col("e").cast("string"), F.lit("-")), "nation")}
    own, firsts = G.compact_members(claims, direct, events, "e", "at", {"supplier": "supp", "part": "part"})
    plain = G.expand_members(own, firsts, "k", "e", "day", claims)
    same = lambda a, b: a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    for within in ((), ("entity", "fingerprint")):
        assert same(G.compact_overlap(own, firsts, "e", "day", claims, within), G.group_overlap(plain))
        cohorts = G.compact_cohorts(claims, direct, firsts, "k", "e", "day", ("supplier", "part"), within)
        assert same(cohorts, G.evaluation_cohorts(claims, G.group_exposure(plain), "k", tuple(direct), ("supplier", "part")))


@pytest.mark.parametrize("name", ["d09_group_overlap", "d11_evaluation_cohorts", "d12_cohort_summary"])
def test_claims_are_not_exchanged_after_they_are_dealt(spark, name):
    """What is left to exchange is a row a type or a split."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert not [x for x in _exchanged(plan) if "claim_key" in x or "entity" in x or "value#" in x]


def test_written_frames_leave_no_shuffle_files(spark):
    """What a write exchanged is deleted when it ends, and the session's setting is as before."""
    import time
    from pathlib import Path

    from priorwise.sources import tables as S

    root = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    files = lambda: {p.name for p in root.rglob("shuffle_*.data") if p.stat().st_size}
    before, setting = files(), spark.conf.get(S._SHUFFLES_END)
    x = spark.range(20_000).select((F.col("id") % 7001).alias("k"), "id")
    kept = [S.written(x.groupBy("k").agg(F.max("id").alias("id")), "sums"), S.bucketed(x, "dealt", "k", 3)]
    assert [f.count() for f in kept] == [7001, 20_000]
    time.sleep(2)  # the files are deleted behind the query
    big = [n for n in files() - before if next(root.rglob(n)).stat().st_size > 5000]
    assert not big and spark.conf.get(S._SHUFFLES_END) == setting


def test_pairs_of_the_matrix_are_not_exchanged(spark):
    """Bridges of the matrix come about, and are grouped, in the buckets of their entity."""
    from priorwise.plans import feature_queries as Q

    h = Q.History(spark, DATA, once=True)
    for bridge in (Q.maint, Q.comp):
        pairs = bridge(h)
        assert not _exchanged(pairs.groupBy("entity_key", "current_claim_key").count())


def test_matrix_keeps_claims_without_an_entity(spark):
    """with frames dealt by entity, a claim without one has the features of claims and counts of 0."""
    import datetime as dt

    from priorwise.operators import features as E

    day = dt.date(2020, 5, 1)
    claims = spark.createDataFrame([(1, 7, 2.5), (2, None, 3.5)], "k int, e int, v double").withColumnRenamed("k", "current_claim_key")
    bridge = spark.createDataFrame([(7, 1, dt.date(2020, 4, 1), day, 9), (7, 1, dt.date(2020, 3, 1), day, 8)], "e int, current_claim_key int, event_date date, anchor_date date, event int")
    spec = E.event_count("f", "event", ["all"]) + [E.latest("f", "event", "event")]
    parts = [(E.build_family(bridge, spec, near=["e"], stay=True), spec), E.frame_features(claims, "own", "own", ["v"], ["v"])]
    got = E.feature_matrix(claims, "current_claim_key", [], parts, ["e"]).select("current_claim_key", "f_event_count_all", "f_event_latest", "v").collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 9, 2.5), (2, 0, None, 3.5)]


def test_numbered_digests_equal_hashlib():
    """digests made many at once are those of MD5, at every number of digits and for texts of over one block."""
    import hashlib

    from priorwise.functions.md5 import numbered

    for head in (b"17:3:1:", b"17:3:" + b"g" * 46, b"x" * 70, b""):
        for start, stop in ((0, 12), (95, 105), (9_990, 10_011), (99_995, 120_003), (4_000_000_000, 4_000_000_003)):
            got = numbered(head, start, stop)
            assert [int(x) for x in got] == [int(hashlib.md5(head + b"%d" % i).hexdigest()[:12], 16) for i in range(start, stop)]


@pytest.mark.parametrize("a_task", [4_000_000, 7])
def test_weights_meet_their_keys_in_parts(spark, monkeypatch, a_task):
    """counts are never broadcast, whatever Spark takes their size for, and parts, blocks and a group without a name lose none."""
    import hashlib
    from collections import Counter

    from priorwise.operators import robustness as R

    monkeypatch.setattr(R, "DRAWS_A_TASK", a_task)
    monkeypatch.setattr(R, "MOST_PLACES", 5, raising=False)
    keys = [(g, k, int(k % 3 == 0)) for g in ("a", None) for k in range(5, 60 if g else 13)]
    got = R.bootstrap_weights(spark.createDataFrame([*keys, ("a", 99, None)], "g string, k long, y int"), "k", 4, ["g"])
    want = Counter()
    for g, y in {(g, y) for g, _, y in keys}:
        of = sorted(k for h, k, z in keys if (h, z) == (g, y))
        for r in range(1, 5):
            for i in range(len(of)):
                text = ":".join(["17", str(r), *([g] if g else []), str(y), str(i)])
                want[g, r, of[int(hashlib.md5(text.encode()).hexdigest()[:12], 16) % len(of)]] += 1
    rows = got.collect()
    assert {(r.g, r.replicate, r.k): r.weight for r in rows} == want and len(rows) == len(want)
    assert got.dtypes == [("g", "string"), ("replicate", "int"), ("k", "bigint"), ("weight", "bigint")]
    # rows of a broadcast are put together on the driver
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_great_weights_are_kept():
    """a weight of over 255 has more than a byte."""
    import zlib

    from priorwise.operators import robustness as R

    few, great = np.array([0, 1, 255]), np.array([0, 300, 2])
    assert list(zlib.decompress(R._squeezed(few), -15)) == [0, 1, 255]
    assert list(np.frombuffer(zlib.decompress(R._squeezed(great), -15), "<u4")) == [0, 300, 2]


@pytest.mark.parametrize("a_part", [1_000_000, 40])
def test_column_values_equal_plain_ones(spark, monkeypatch, a_part):
    """values, nulls, zeros and rows that a frame lacks, in one part and in several."""
    from priorwise.operators import column_values as V

    monkeypatch.setattr(V, "ROWS_A_PART", a_part)
    monkeypatch.setattr(V, "ROWS_A_STRETCH", 50)
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 5)), None if k % 4 == 0 else float(rng.normal()), (0.0, -0.0, 2.5)[k % 3], None, 7 if k % 2 else None) for k in range(300)]
    df = spark.createDataFrame(rows, "few int, many double, zero double, none double, `count` long").repartition(3)

    def plain(values, lacks, filled_up):
        v = [0.0 if x is None and filled_up else x for x in [*values, *[None] * lacks]]
        has = np.array([x for x in v if x is not None], float)
        return len(v), len(v) - len(has), len(np.unique(has)), *((has.min(), has.max(), has.mean(), has.std()) if len(has) else (None,) * 4)

    for told, lacks in ((V.column_values([(df, df.columns)], 300), 0), (V.column_values([(df.select("few", "many"), ["few", "many"]), (df, ["zero", "none", "count"])], 320, False, {"few", "count"}), 20)):
        got = {r.feature: tuple(r)[1:] for r in told.collect()}
        for k, c in enumerate(df.columns):
            want = plain([r[k] for r in rows], lacks, lacks and c in ("few", "count"))
            assert got[c] == pytest.approx(want, abs=1e-9), c


def test_catalog_quality_needs_no_matrix(spark, monkeypatch):
    """the matrix is not put together, and every feature has the quality that its column of the matrix has."""
    from priorwise.operators import features as E
    from priorwise.plans import feature_queries as Q

    m = Q.matrix(spark, DATA)
    kinds = dict(m.dtypes)
    m = m.toPandas()

    def refuse(*_):
        raise AssertionError("the matrix was put together")

    monkeypatch.setattr(E, "feature_matrix", refuse)
    got = {r.feature: r for r in QUERIES["e35_c36_catalog_quality"](spark, DATA).collect()}
    assert set(got) == set(m.columns) - {"current_claim_key", "claim_date"}
    for c, r in got.items():
        if kinds[c] not in ("double", "bigint", "int"):
            assert r.rows is None
            continue
        v = m[c].dropna().astype(float)
        assert (r.rows, r.nulls, r.distinct_values) == (len(m), len(m) - len(v), v.nunique()), c
        if len(v):
            assert (r.min, r.max, r.mean) == pytest.approx((v.min(), v.max(), v.mean())), c


def test_many_doubles_are_rounded_to_the_bit(spark):
    """rounding of very many doubles gives what Spark's gives, ties and odd values included."""
    from priorwise.plans import feature_queries as Q

    x = spark.range(400_000).selectExpr(
        "id % 12 AS k", "CASE id % 9 WHEN 0 THEN id / 128D - 2 WHEN 1 THEN -id / 2000000D - 5e-7D WHEN 2 THEN rand(1) WHEN 3 THEN (rand(2) - 0.5D) * pow(10D, id % 40 - 20) WHEN 4 THEN round(rand(3) * 1000, 6) + 5e-7D "
        "WHEN 5 THEN rand(4) * 1e9 WHEN 6 THEN id * 5e-7D WHEN 7 THEN (id % 1000) / 7D ELSE element_at(array(double('NaN'), double('Infinity'), double('-Infinity'), -0D, null, 5e-7D, -4.9e-324D, -4e-7D), int(id % 8) + 1) END AS v", "id / 3D AS a_slope_6m")
    x = x.withColumn("w", F.col("v"))
    x = spark.createDataFrame(x.collect(), x.schema)
    bits = lambda df: [tuple(None if c is None else np.float64(c).tobytes() for c in r[1:]) for r in df.collect()]
    assert bits(Q.rounded_wide(x)) == bits(Q.rounded(x))


def test_monthly_pairs_are_read_once_a_kind_of_state(spark):
    """numbers, values, first and last rows, and slopes; the months of coverage come with the values."""
    import re

    from priorwise.plans import feature_queries as Q

    plan = Q.matrix(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \S*\.tele_", plan)) == 4
    # the age of a pair is found where the pair comes about
    assert "add_months" not in plan.replace("add_months(claim_date", "")


def test_a_single_value_is_counted_as_it_is(spark):
    """distinct months are not told apart as text; modes still are, by text."""
    import datetime as dt

    from priorwise.operators import features as E

    day = dt.date(2020, 5, 1)
    rows = [(1, dt.date(2020, 4, d), day, n) for d, n in ((1, 9), (2, 10), (3, 9), (4, 10))] + [(1, dt.date(2019, 1, 1), day, None)]
    bridge = spark.createDataFrame(rows, "current_claim_key int, event_date date, anchor_date date, n int")
    got = E.build_family(bridge, E.months_observed("f")).first()
    assert (got.f_months_observed_3m, got.f_months_observed_12m, got.f_months_observed_all) == (1, 1, 2)
    assert E.tallies(bridge.withColumn(E.BUCKET, E.age_bucket()), {"n": F.col("n")}, text=False).schema["value"].dataType.typeName() == "integer"
    kinds = E.build_family(bridge, E.type_diversity("f", "n", "n")).first()
    assert (kinds.f_n_nunique_all, kinds.f_n_dominant) == (2, "10")
