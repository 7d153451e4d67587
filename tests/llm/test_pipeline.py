"""The pipeline against the brute-force composition of its stages."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from priorwise.llm import quality_gam
from priorwise.llm.queries import ORACLES
from priorwise.llm.scratch import materialize

SF = "/root/testdata/sf0.001"


def test_stages_compose(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in quality_gam.score_quality(docs, labels).filter("score >= 0.5").collect()}
    now, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, SF), "stage")
        seen.append((name, now))
    quality, exact, near, mixed, packed = (df for _, df in seen)
    assert all(df.columns == columns for _, df in seen[:4])
    assert {r.doc_id for r in quality.collect()} == want
    import re

    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    keep = {}
    for r in quality.collect():
        keep[norm(r.text)] = min(keep.get(norm(r.text), r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(keep.values())

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    rows = [(r.doc_id, shingles(r.text)) for r in exact.collect()]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(rows):
        for b, t in rows[:i]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert sorted(r.doc_id for r in near.collect()) == sorted(d for d, s in rows if find(d) == d)
    # mixing: the plan's SQL over the rows that came in says how often each document is taken
    con = duckdb.connect()
    incoming = near.toPandas()
    con.register("documents", incoming)
    taken = con.execute(f"SELECT doc_id, CASE WHEN size > 0 THEN taken // size END FROM ({ORACLES['op4_mixing']})").fetchall()
    mixed_rows = mixed.collect()
    copies = Counter(r.doc_id for r in mixed_rows)
    assert len(taken) == len(incoming) and all(n is None or copies[d] == n for d, n in taken)
    assert set(copies) <= set(incoming["doc_id"])

    # packing: every id of every copy lies in one piece, as the vocabulary's own library encodes it
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text or "" for r in mixed_rows}
    ids = {d: np.array([*encoder.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, own in pieces.items():
        covered = Counter(i for start, n in own for i in range(start, start + n))
        assert set(covered) == set(range(len(ids[d]))) and set(covered.values()) == {copies[d]}
    assert set(pieces) == set(copies)
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048


def test_run_is_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_run_on_nulls_clashing_columns_and_no_rows(spark, tmp_path):
    """Null texts and identifiers pass through; extra columns do not clash; no documents give no rows."""
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words), (2, words), (3, None), (None, words + " more"), (4, ""), (5, "alone " * 60), (5, "alone " * 60)]
    docs = spark.createDataFrame([(d, t, "en", None if d == 5 else "s", 0, "x", 1, 2.0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, norm string, node long, rate double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, table in (("some", docs), ("none", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()}
    assert got <= {1, 3, 4, 5, None} and 2 not in got and got & {1, 5, None}
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
