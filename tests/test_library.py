"""Hand-worked cases for the operators whose rules matter most."""

import datetime as dt
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from priorwise.operators import bridges as B, calibration as C, features as E, groups as G, keys as K, metrics as M, profile as P, splits as S, textfeatures as T
from priorwise.operators.quantiles import exact_quantiles
from priorwise.sources import tables

D = dt.date
CLAIM = ("k", "e", "d")


@pytest.fixture(scope="module")
def claims(spark):
    return spark.createDataFrame([(1, 7, D(2026, 3, 15), 10), (2, 7, D(2026, 5, 15), None), (3, 9, D(2026, 5, 15), None)], "k long, e long, d date, own long")


def test_history_is_strictly_before(spark, claims):
    ev = spark.createDataFrame([(10, 7, D(2026, 3, 14)), (11, 7, D(2026, 3, 15)), (12, 7, None), (None, 7, D(2026, 1, 1))], "id long, e long, t date")
    got = B.bridge_strict_before(claims, ev, CLAIM, ("e", "t"), {"id": "id"}).collect()
    assert sorted((r.current_claim_key, str(r.id)) for r in got) == [(1, "10"), (1, "None"), (2, "10"), (2, "11"), (2, "None")]
    got = B.bridge_exclude_current(claims, ev, CLAIM, ("e", "t"), "own", "id", {"id": "id"}).collect()
    # a null key is dropped only where the claim's own is null too
    assert sorted((r.current_claim_key, str(r.id)) for r in got) == [(1, "None"), (2, "10"), (2, "11")]


def test_a_month_counts_when_it_is_over(spark, claims):
    m = spark.createDataFrame([(1, 7, D(2026, 2, 1)), (2, 7, D(2026, 3, 1)), (3, 7, D(2026, 5, 1))], "id long, e long, m date")
    got = B.bridge_completed_month(claims, m, CLAIM, ("e", "m"), {"id": "id"}).collect()
    assert sorted((r.current_claim_key, r.id) for r in got) == [(1, 1), (2, 1), (2, 2)]


def test_an_unsafe_event_fails(spark, claims):
    bad = spark.createDataFrame([(1, D(2026, 3, 15))], "current_claim_key long, t date")
    with pytest.raises(Exception, match="not before"):
        B.attach_anchor_dates(claims, bad, "k", "d", "t").collect()


def test_keys_and_joins_fail_closed(spark, claims):
    with pytest.raises(ValueError):
        K.assert_unique_key(claims, "e")
    with pytest.raises(ValueError):
        K.assert_unique_key(claims, "missing")
    with pytest.raises(ValueError):
        K.join_many_to_one(claims, claims.withColumn("x", F.lit(1)), ["e"], ["e"], {"x": "x"})
    assert K.join_many_to_one(claims, spark.createDataFrame([(7, "a")], "e long, x string"), ["e"], ["e"], {"x": "x"}).filter("x is null").count() == 1


def test_latest_takes_null_and_windows_include_their_lower_bound(spark):
    rows = [(1, 5, D(2026, 1, 15), D(2026, 7, 15), 2.0), (1, 6, D(2026, 6, 1), D(2026, 7, 15), None), (1, 4, D(2026, 1, 14), D(2026, 7, 15), 8.0)]
    b = spark.createDataFrame(rows, "current_claim_key long, id long, event_date date, anchor_date date, v double")
    spec = [E.latest("f", "v", "id"), *E.metric("f", "v", "sum", ("6m", "all")), *E.event_count("f", "id", ("3m", "6m")), E.recency("f"), *E.metric("f", "v", "std", ("6m",))]
    r = E.build_family(b, spec).first()
    assert (r.f_v_latest, r.f_v_sum_6m, r.f_v_sum_all, r.f_event_count_3m, r.f_event_count_6m, r.f_recency_days, r.f_v_std_6m) == (None, 2.0, 10.0, 1, 2, 44, None)


def test_matrix_zero_fills_counts_and_nulls_measures(spark, claims):
    b = spark.createDataFrame([(1, 5, D(2026, 1, 15), D(2026, 3, 15), 2.0)], "current_claim_key long, id long, event_date date, anchor_date date, v double")
    spec = [*E.event_count("f", "id", ("all",)), *E.metric("f", "v", "sum", ("all",))]
    got = {r.current_claim_key: (r.f_event_count_all, r.f_v_sum_all) for r in E.feature_matrix(claims, "k", [], [(E.build_family(b, spec), spec)]).collect()}
    assert got == {1: (1, 2.0), 2: (0, None), 3: (0, None)}
    with pytest.raises(ValueError):
        E.feature_matrix(claims, "k", ["target"], [])


def test_changes_take_the_rows_at_the_edges(spark):
    """A null reading in the first or last row gives no change; one in between does not matter."""
    rows = [(1, 1, D(2026, 1, 1), 10.0), (1, 2, D(2026, 2, 1), 15.0), (1, 3, D(2026, 3, 1), None), (2, 1, D(2026, 1, 1), 10.0), (2, 2, D(2026, 2, 1), None), (2, 3, D(2026, 3, 1), 15.0), (3, 1, D(2026, 1, 1), 4.0), (4, 1, D(2026, 1, 1), None), (4, 2, D(2026, 2, 1), 3.0)]
    b = spark.createDataFrame([(*r[:3], D(2026, 4, 1), r[3]) for r in rows], "current_claim_key long, id long, event_date date, anchor_date date, v double")
    spec = [*E.first_to_last("f", "v", "id", ("6m",), name="delta"), *E.first_to_last("f", "v", "id", ("6m",), least=2)]
    got = {r.current_claim_key: (r.f_v_delta_6m, r.f_v_change_6m) for r in E.build_family(b, spec).collect()}
    assert got == {1: (None, None), 2: (5.0, 5.0), 3: (0.0, None), 4: (None, None)}


def test_dates_are_never_split(spark):
    days = [(i, D(2026, 1, 1) + dt.timedelta(days=i)) for i in range(20)]
    r = S.split_boundaries(spark.createDataFrame(days, "k long, d date"), "d").first()
    assert (r.train_end, r.validation_end, r.status) == (D(2026, 1, 14), D(2026, 1, 17), "OK")
    one = spark.createDataFrame([(i, D(2026, 1, 1)) for i in range(5)], "k long, d date")
    assert S.split_boundaries(one, "d").first().status == "TOO_FEW"


def test_asof_ties(spark):
    c = spark.createDataFrame([(1, 1, 5, D(2026, 2, 1)), (2, 1, None, D(2026, 2, 1)), (3, 1, 6, D(2026, 2, 1)), (4, 2, 5, D(2026, 2, 1))], "k long, e long, c long, d date")
    i = spark.createDataFrame([(1, 5, D(2026, 1, 1), "a", 1), (1, 5, D(2026, 1, 1), "a", 2), (1, 6, D(2026, 1, 1), "a", 3), (1, 6, D(2026, 1, 1), "b", 4), (1, 6, D(2025, 1, 1), "c", 5)], "e long, c long, t date, lot string, id long")
    got = B.asof_latest_match(c, i, ("k", "e", "d", None), "c", ("e", "c", "t"), ["lot"], ["id"])
    assert {r.k: (r.match_status, r.tied, r.lot, r.n_candidates) for r in got.collect()} == {1: ("matched", True, "a", 2), 2: ("no_causal_component", False, None, 0), 3: ("ambiguous", True, None, 3), 4: ("unmatched", False, None, 0)}
    r = B.match_counters(got).first()
    assert (r.matched, r.unmatched, r.ambiguous, r.no_causal_component) == (1, 2, 2, 1)


def test_metrics_by_hand(spark):
    s = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.8), (4, 0, 0.1)], "k long, y int, p double")
    r = M.ranking_metrics(s).first()
    assert r.average_precision == pytest.approx(0.5 * 1 + 0.5 * 2 / 3) and r.roc_auc == pytest.approx(0.875)
    c = M.confusion_metrics(s, 0.8).first()
    assert (c.tp, c.fp, c.tn, c.fn, c.mcc) == (2, 1, 1, 0, pytest.approx(2 / 12**0.5))
    assert M.threshold_curve(s).count() == 999


def test_normalisation_is_unicode_aware(spark):
    df = spark.createDataFrame([(" Straße  ﬁx ",), ("  ",), (None,)], "t string")
    assert [r[0] for r in df.select(T.normalize_description("t")).collect()] == ["strasse fix", None, None]


def test_publish_refuses_bad_keys_and_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    path = f"file://{tmp_path}/out"
    assert tables.publish_staged(df, path, "k").count() == 2
    with pytest.raises(FileExistsError):
        tables.publish_staged(df, path, "k")
    with pytest.raises(ValueError):
        tables.publish_staged(df.union(df), f"file://{tmp_path}/bad", "k")
    assert not (tmp_path / "bad").exists()
    from priorwise.operators.groups import content_fingerprint

    assert tables.read_verified(spark, path, content_fingerprint(df.orderBy(F.desc("k")))).count() == 2
    with pytest.raises(ValueError):
        tables.read_verified(spark, path, content_fingerprint(df.limit(1)))
    meta = tables.write_parquet(df, f"file://{tmp_path}/z", "zstd").first()
    assert (meta.row_count, meta.column_count) == (2, 1)
    need = tables.plan_columns(spark.createDataFrame([("a", "x", ["a.k", "b.k"]), ("c", "y", [])], "source_table string, source_column string, join_columns array<string>"), ["c"])
    assert {r.table_name: r.columns for r in need.collect()} == {"a": ["k", "x"], "b": ["k"]}


def test_exact_quantiles_equal_sorted_values(spark):
    parts = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    draw = np.random.default_rng(3)
    samples = {
        "many": draw.normal(size=3000).tolist(), "ties": draw.integers(0, 5, 900).astype(float).tolist(), "one": [4.5], "two": [1.0, 2.0],
        "hot": [7.0] * 800 + draw.normal(size=400).tolist(), None: [3.0, 1.0, 2.0, 2.0], "nothing": [],
    }
    rows = [(g, v) for g, vs in samples.items() for v in [*vs, None]]
    got = {r.g: r.q for r in exact_quantiles(spark.createDataFrame(rows, "g string, value double"), "value", parts, ["g"]).collect()}
    assert "nothing" not in got and len(got) == len(samples) - 1
    for g, q in got.items():
        assert q == pytest.approx(np.quantile(samples[g], parts).tolist(), rel=1e-12)
    whole = exact_quantiles(spark.createDataFrame([(v,) for v in samples["many"]], "value double"), "value", parts).collect()
    assert whole[0].q == pytest.approx(np.quantile(samples["many"], parts).tolist(), rel=1e-12)
    assert exact_quantiles(spark.createDataFrame([], "value double"), "value", parts).collect() == []


def test_profile_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {r.field: r for r in P.profile_numeric(df, ["a", "b"]).collect()}
    assert (got["a"].median, got["a"].p25, got["b"].median, got["b"].nulls) == (2.0, 1.5, None, 2)
    quality = {r.field: r.outliers for r in P.measurement_quality(df, ["a", "b"]).collect()}
    assert quality == {"a": 0, "b": None}


def test_membership_takes_types_of_one_bridge_together(spark):
    snapshot = spark.createDataFrame([(1, "x"), (2, None)], "k int, nation string")
    bridge = spark.createDataFrame([(1, 5, None), (1, 5, 6), (2, None, 6)], "c int, s int, p int")
    m = G.group_membership(snapshot, "k", {"nation": "nation"}, {"s": (bridge, "c", "s"), "p": (bridge, "c", "p")}, ["nation"])
    assert sorted((r.k, r.group_type) for r in m.collect()) == [(1, "fingerprint"), (1, "nation"), (1, "p"), (1, "s"), (1, "s"), (2, "fingerprint"), (2, "p")]
    assigned = spark.createDataFrame([(1, "TRAIN"), (2, "TEST")], "k int, split string")
    members = G.normalize_membership(m, assigned, "k")
    assert sorted((r.k, r.group_type, r.split) for r in members.collect()) == [(1, "fingerprint", "TRAIN"), (1, "nation", "TRAIN"), (1, "p", "TRAIN"), (1, "s", "TRAIN"), (2, "fingerprint", "TEST"), (2, "p", "TEST")]
    seen = {(r.k, r.group_type): (r.first_split, r.seen_in_development) for r in G.group_exposure(members).collect()}
    assert seen[2, "p"] == ("TRAIN", True) and seen[2, "fingerprint"] == ("TEST", False)


def test_chunks_go_to_their_sink_on_the_executors(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k}") for k in range(25)], "k long, v string").repartition(5)
    folder = str(tmp_path)

    def sink(number, table):
        import pyarrow.parquet as pq

        pq.write_table(table, f"{folder}/{number}.parquet")

    got = tables.deliver_chunks(df, "k", ["k", "v"], 10, sink).collect()
    assert sorted((r.chunk, r.rows) for r in got) == [(0, 10), (1, 10), (2, 5)]
    assert sorted(r.k for r in spark.read.parquet(f"file://{folder}/1.parquet").collect()) == list(range(10, 20))


def test_a_database_with_a_skewed_key_is_read_in_even_parts(spark):
    url = "jdbc:derby:memory:skewed;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    keys = [*range(900), *[10**6 + 7 * k for k in range(100)], None, None]
    spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "K long, V long").coalesce(1).write.jdbc(url, "T", mode="overwrite", properties=driver)
    df = tables.scan_jdbc_balanced(spark, url, "T", ["K", "V"], "K", 5, 0, 2 * 10**6, **driver)
    assert sorted(r.V for r in df.collect()) == list(range(len(keys)))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 2 * len(keys) / 5
    even = tables.scan_jdbc(spark, url, "T", ["K", "V"], "K", 0, 2 * 10**6, 5, **driver)
    assert sorted(r.V for r in even.collect()) == list(range(len(keys)))
    assert max(r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()) >= 900


def test_versions_stand_until_the_next_manifest_does(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, root)
    one, two = spark.range(5), spark.range(9)
    assert tables.publish_versioned(one, root, "id") == 1
    # a writer killed after its files and in the middle of its manifest
    two.write.parquet(f"{root}/versions/lost")
    (tmp_path / "t" / "manifests" / "000000000002").write_text('{"data": "')
    assert tables.read_version(spark, root).count() == 5
    assert tables.publish_versioned(two, root, "id") == 3
    assert (tables.read_version(spark, root).count(), tables.read_version(spark, root, 1).count()) == (9, 5)
    with pytest.raises(ValueError):
        tables.publish_versioned(one.union(one), root, "id")
    assert tables.read_version(spark, root).count() == 9
    Path(tables.read_version(spark, root, 3).inputFiles()[0].removeprefix("file:")).unlink()
    assert tables.read_version(spark, root, 1).count() == 5
    with pytest.raises(ValueError):
        tables.read_version(spark, root)


def test_places_of_a_constant_score_are_spread(spark):
    rows = spark.range(4000).selectExpr("(id * 7919) % 4000 AS k", "0.5D AS p", "CASE WHEN id % 5 = 0 THEN NULL ELSE 'g' END AS g")
    got = M.global_place(rows, [F.desc("p"), F.col("k")], F.lit(1), ["g"]).collect()
    for g in ("g", None):
        own = sorted((r.k, r.place, r.total) for r in got if r.g == g)
        assert [r[1] for r in own] == list(range(len(own))) and {r[2] for r in own} == {len(own)}
    placed = M.global_place(rows, [F.desc("p"), F.col("k")], F.lit(1))
    files = [r["count"] for r in spark.read.parquet(*placed.inputFiles()).groupBy("__part").count().collect()]
    assert len(files) == 4 and max(files) <= 2 * 4000 / 4


def test_a_heavy_entity_is_dealt_in_blocks(spark):
    start = D(2020, 1, 1)
    anchors = [(k, 1, start + dt.timedelta(days=k)) for k in range(300)] + [(1000 + k, 2 + k, start + dt.timedelta(days=400)) for k in range(5)] + [(2000, None, start)]
    c = spark.createDataFrame(anchors, "k long, e long, d date")
    ev = spark.createDataFrame([(k, 1, start + dt.timedelta(days=k % 290)) for k in range(400)] + [(9000 + k, 2 + k % 3, start) for k in range(9)] + [(9999, None, start)], "id long, e long, t date")
    heavy = B.heavy_entities(c, ev, "e", "e", 10_000)
    assert [(r["__heavy"], r["__blocks"]) for r in heavy.collect()] == [(1, 12)]
    plain = B.bridge_strict_before(c, ev, CLAIM, ("e", "t"), {"id": "id", "e": "e"}, {"d": "day"})
    dealt = B.bridge_strict_before(c, ev, CLAIM, ("e", "t"), {"id": "id", "e": "e"}, {"d": "day"}, heavy)
    pick = lambda df: sorted(map(tuple, df.select("current_claim_key", "day", "id", "e").collect()))
    assert pick(plain) == pick(dealt)
    sizes = [r["count"] for r in dealt.filter("e = 1").groupBy(B.BLOCK).count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 3 * sorted(sizes)[6]


def test_rows_and_texts_are_equal_by_digest(spark):
    rows = [("a", 0.0, None), ("a", -0.0, None), ("a", 0.0, ""), ("a\x1f", 1.0, "b"), ("a", 1.0, "\x1fb"), ("a\x1f", 1.0, "b"), (None, None, None), (None, None, None)]
    r = P.duplicate_rows(spark.createDataFrame(rows, "x string, v double, y string"), "t").first()
    assert (r.duplicate_records, r.distinct_duplicates, r.max_repeats) == (6, 3, 2)
    texts = [("The  end", 1), ("the end", 0), ("other", 1), (" ", 1), (None, 0)]
    r = P.text_audit(spark.createDataFrame(texts, "t string, y int"), "t", "y", ["end"]).first()
    assert (r.rows, r.distinct_texts, r.duplicated_rows, r.mixed_groups, r.word_rate_1, r.word_rate_0) == (3, 2, 2, 1, 0.5, 1.0)


def test_windows_merge_states_of_the_whole_spec(spark):
    """Every measure of the monthly table at full width against plain Python, window by window."""
    rng = np.random.default_rng(8)
    names = [*E.ADDITIVE, *E.CONTINUOUS, "total_odometer_miles"]
    anchors = {1: D(2026, 3, 31), 2: D(2024, 2, 29), 3: D(2026, 7, 15)}
    rows = []
    for a, day in anchors.items():
        for i in range(60):
            when = day - dt.timedelta(days=int(rng.integers(1, 1100)))
            rows.append((a, day, 100 * a + i, when, *[None if rng.random() < 0.15 else float(1e7 + rng.integers(0, 3)) if n == "mileage_month" else float(np.round(rng.normal(50, 9), 3)) for n in names]))
    b = spark.createDataFrame(rows, "current_claim_key long, anchor_date date, month_key long, event_date date, " + ", ".join(f"{n} double" for n in names))
    spec = E.telemetry_spec()
    assert len(spec) == len({f.name for f in spec}) > 270
    got = {r.current_claim_key: r.asDict() for r in E.build_family(b, spec).collect()}

    def back(day, months):
        y, m = divmod(day.year * 12 + day.month - 1 - months, 12)
        for last in (day.day, 30, 29, 28):
            try:
                return D(y, m + 1, last)
            except ValueError:
                continue

    for a, day in anchors.items():
        own = sorted((r for r in rows if r[0] == a), key=lambda r: (r[3], r[2]))
        for w, months in E.WINDOWS.items():
            some = [r for r in own if months is None or r[3] >= back(day, months)]
            assert got[a][f"telemetry_months_observed_{w}"] == len({(r[3].year, r[3].month) for r in some})
            for i, n in enumerate(names):
                v = np.array([r[4 + i] for r in some if r[4 + i] is not None])
                for agg, value in (("sum", v.sum), ("mean", v.mean), ("min", v.min), ("max", v.max), ("std", v.std)):
                    if f"telemetry_{n}_{agg}_{w}" in got[a]:
                        want = value() if len(v) > (agg == "std") else None
                        assert got[a][f"telemetry_{n}_{agg}_{w}"] == (want if want is None else pytest.approx(want, rel=1e-9, abs=1e-9)), (n, agg, w)
                if f"telemetry_{n}_change_{w}" in got[a]:
                    first, last = (some[0][4 + i], some[-1][4 + i]) if some else (None, None)
                    assert got[a][f"telemetry_{n}_change_{w}"] == (None if len(v) < 2 or first is None or last is None else pytest.approx(last - first))
        assert all(got[a][f"telemetry_{n}_latest"] == own[-1][4 + i] for i, n in enumerate(names))


@pytest.mark.parametrize("block", [16, 100_000])
def test_isotonic_blocks_equal_pooling(spark, block):
    rng = np.random.default_rng(4)
    p = np.round(rng.random(1500), 3)
    y = (rng.random(1500) < np.where(p < 0.5, p * p, 0.2 + 0.6 * p)).astype(int)
    xs, at, n = np.unique(p, return_inverse=True, return_counts=True)
    pooled = []
    for x, mean, w in zip(xs, np.bincount(at, y) / n, n):
        pooled.append([mean, w, [x]])
        while len(pooled) > 1 and pooled[-2][0] >= pooled[-1][0]:
            v, m, c = pooled.pop()
            u = pooled[-1]
            pooled[-1] = [(u[0] * u[1] + v * m) / (u[1] + m), u[1] + m, u[2] + c]
    ys = np.concatenate([np.full(len(c), v) for v, _, c in pooled])
    train = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)] + [(1, None)], "y int, p double")
    pieces = C.isotonic_pieces(train, block=block)
    q = [0.0, 1.0, *rng.random(300).tolist(), *xs[:50].tolist()]
    got = {r.k: r.p for r in C.apply_pieces(spark.createDataFrame([(k, v) for k, v in enumerate(q)] + [(-1, None)], "k int, p double"), pieces).collect()}
    assert got.pop(-1) is None and len(got) == len(q)
    assert [got[k] for k in range(len(q))] == pytest.approx(np.interp(q, xs, ys).tolist(), abs=1e-12)
