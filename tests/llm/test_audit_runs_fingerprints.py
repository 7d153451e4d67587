"""Filter audit, periodic runs and edit fingerprints against plain loops."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from priorwise.llm import edit_fingerprints as ef
from priorwise.llm import filter_audit, periodic_runs
from priorwise.llm.kernels import PLACES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, part string, hash long, least long, fails int, after int"


def corpus():
    rng = random.Random(23)
    rows = []

    def add(doc, text, lang="en"):
        rows.append((doc, text, lang, "clash", 1, 2, 3, 4))

    for i in range(60):
        few = rng.choice([3, 20, 400])
        words = ["".join(rng.choice("abcdefgZ") for _ in range(rng.randint(1, 9))) for _ in range(few)]
        text = [rng.choice(words) for _ in range(rng.choice([4, 150, 260, 900]))]
        if i % 4 == 0:  # a block many times over
            block = [rng.choice(words) for _ in range(rng.randint(1, 30))]
            at = rng.randint(0, len(text))
            text[at:at] = (block * 9)[: rng.randint(len(block), 9 * len(block))]
        add(i, rng.choice([" ", "\n", " \t"]).join(text) + rng.choice(["", "", " #", "|"]), rng.choice(["en", "de", "", None]))
    for i in range(60, 75):
        add(i, rows[i % 7][1], rng.choice(["en", "fr"]))
    add(75, None)
    add(76, "")
    add(77, " \n\t ", "fr")
    add(78, "one")
    add(79, "x " * 300)
    add(80, "Zoë naïve ΑΣ İstanbul 漢字 á \U0001f600 $ \x1cq" * 40)
    add(81, "w" * 70 + " " + "w" * 70 + " " + "w" * 69 + "v", "de")
    add(3, rows[3][1])
    add(82, rows[5][1] + " and more")
    add(82, rows[5][1] + " and more")
    add(None, rows[4][1])
    add(None, "a text of its own without an identifier")
    return rows


ROWS = corpus()
LABELS = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(70)] + [(1, 0, 1), (None, 1, 1), (90, 1, 1), (2, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


# ---- filter audit


def plain_fails(rows):
    least = {}
    for doc, text, *_ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    out = []
    for doc, text, *_ in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if t in least and (doc is None or doc > least[t]) else set()
        out.append(fails)
    return out


def plain_audit(rows):
    quality, toxic = {}, {}
    for doc, q, t in LABELS:
        if doc is not None:
            quality[doc] = min([x for x in (q, quality.get(doc)) if x is not None], default=None)
            toxic[doc] = max([x for x in (t, toxic.get(doc)) if x is not None], default=None)
    table = [(r[2] or "", f, quality.get(r[0]) == 1, toxic.get(r[0]) == 1) for r, f in zip(rows, plain_fails(rows), strict=True)]
    out = []
    for part in {p for p, *_ in table}:
        own = [x[1:] for x in table if x[0] == part]
        removed_by = Counter()
        part_rows = []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                removed_by[f] += len(gone)
                part_rows.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in x[0] and bool(x[0] & set(order[:k])) for x in own), sum(x[0] == {f} for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out += [(*r[:-1], removed_by[r[-1]]) for r in part_rows]
    return sorted(out)


def test_audit_equals_plain_loops(docs, labels):
    got = filter_audit.audit_filters(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(ROWS)


def test_audit_of_an_empty_table(empty, labels):
    assert filter_audit.audit_filters(empty, labels).count() == 0


def test_transducer_marks_words_at_the_edges_of_texts():
    column = pa.array(["ab", "", None, "cd ", " ", "é f", "g"])
    raw, off = filter_audit.text_bytes(column)
    _, starts, ends = filter_audit.transduce(raw, off)
    assert [bytes(raw[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["ab", "cd", "é", "f", "g"]


def test_hash_table_verifies_every_meeting(monkeypatch):
    monkeypatch.setattr(filter_audit.SpanTable, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    texts = ["a b a abcdefgh abcdefghi abcdefgh " + "x" * 65 + " " + "x" * 64 + "y " + "x" * 65, "a b c"]
    raw, off = filter_audit.text_bytes(pa.array(texts))
    _, starts, ends = filter_audit.transduce(raw, off)
    words = [len(WORD.findall(t)) for t in texts]
    got = filter_audit.SpanTable(raw, starts, ends, np.repeat([0, 1], words)).distinct(2)
    assert got.tolist() == [len(set(WORD.findall(t))) for t in texts]


def test_audit_of_a_very_long_text():
    rng = random.Random(1)
    text = " ".join(str(rng.randrange(150000)) for _ in range(200_000))
    fails, digests = filter_audit.text_failures(pa.array([text, "z" * 1_000_000]))
    assert fails.tolist() == [0 if len(set(text.split())) >= 100_000 else 2, 1]
    assert digests[0] == hashlib.sha256(text.encode()).digest()


# ---- periodic runs


def plain_runs(w):
    runs = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if n >= max(6, 4 * q) and not any(w[s : s + n - r] == w[s + r : s + n] for r in range(1, q)):
                runs.append((s, n, q))
            i = max(i, s + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def plain_report(doc, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
    return (doc, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, digest, kept)


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.mark.parametrize("shift", [0, 1000, 2000])
def test_runs_equal_plain_loops(docs, shift):
    moved = docs.withColumn("doc_id", F.col("doc_id") + shift)
    want = [plain_report(None if r[0] is None else r[0] + shift, r[1]) for r in ROWS]
    assert any(w[1] for w in want)
    assert order(map(tuple, periodic_runs.collapse_runs(moved, plant=True).collect())) == order(want)


def test_runs_of_an_empty_table(empty):
    assert periodic_runs.collapse_runs(empty).count() == 0


def test_random_sequences_of_few_words():
    rng = random.Random(5)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 9)):
            k = rng.choice([1, 2, 3, 5, 50])
            w = [rng.randrange(k) for _ in range(rng.choice([0, 1, 5, 6, 30, 120]))]
            for _ in range(rng.randint(0, 3)):
                p = rng.randint(1, 40)
                block, at = [rng.randrange(k) for _ in range(p)], rng.randint(0, len(w))
                w[at:at] = (block * 7)[: rng.randint(p, 7 * p)]
            texts.append(w)
        first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        text, start, size, period = periodic_runs.find_runs(np.array([x for w in texts for x in w], np.int64), first)
        for k, w in enumerate(texts):
            assert [(int(a), int(b), int(c)) for t, a, b, c in zip(text, start, size, period, strict=True) if t == k] == plain_runs(w)


def test_extensions_equal_plain_comparison():
    rng = random.Random(8)
    block = [rng.randrange(5) for _ in range(400)]
    seq = np.array([0, *[x + 3 for x in block + block + block[:150]], 1])
    lce = periodic_runs.CoverLce(seq)
    pairs = [(i, j) for i in range(1, 951, 7) for j in range(i + 1, 951, 3) if j + 21 <= len(seq) and (seq[i : i + 21] == seq[j : j + 21]).all()]
    assert pairs
    got = lce(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    for (i, j), n in zip(pairs, got, strict=True):
        k = 0
        while seq[i + k] == seq[j + k]:
            k += 1
        assert n == k


def test_runs_of_a_very_long_text():
    block = [f"w{i}" for i in range(700)]
    text = " ".join(block * 280 + ["end"]).encode()  # about 1 MB
    got = periodic_runs.run_report([1], [text], plant=False)
    assert (got["n_runs"], got["start"], got["length"], got["period"]) == ([1], [0], [196000], [700])
    assert got["collapsed_sha256"] == [hashlib.sha256(" ".join([*block, "end"]).encode()).hexdigest()]


# ---- edit fingerprints


def mix64(x):
    m = 2**64 - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def plain_fingerprint(text):
    m = 2**64 - 1
    place = [int(p) for p in PLACES]
    steps = []  # places of the walk, -1 after a segment's end
    for a in range(0, len(text), 1024):
        b = min(len(text), a + 1024)
        slots = -(-(b - a) * 3 // 12)
        i = a
        for j in range(12 * slots):
            if j % 12 == 0:
                steps.append(i if i < b else -1)
            if i < b:
                i += int(ef._MOVES[j][mix64(ord(text[i]) * place[42] & m) % 63 + 1])
    level = 0
    while -(-len(steps) // 128) > 1 << level:
        level += 1
    out = bytes([level]) + len(steps).to_bytes(4, "big")
    for t, i in enumerate(steps):
        h = mix64((t * place[40] + place[41]) & m)
        if h % (1 << level):
            continue
        gram = sum((ord(text[i + g]) + 1) * place[43 + g] for g in range(6) if i + g < len(text)) if i >= 0 else 0
        out += bytes([mix64((gram + t * place[50]) & m) % 15 + 1 if i >= 0 else 0])
    return out


def test_fingerprints_equal_plain_walks():
    rng = random.Random(3)
    texts = ["", "a", "İé漢\U0001f600", *["".join(rng.choice("abc é漢") for _ in range(n)) for n in (5, 11, 12, 500, 1023, 1024, 1025, 3000, 9000)]]
    assert ef.fingerprints([ef.points(t) for t in texts]) == [plain_fingerprint(t) for t in texts]
    for t in texts:
        assert ef.packed(ef.shown(plain_fingerprint(t))) == plain_fingerprint(t)


def plain_documents(rows):
    """Rows in the order of the contract; ties stand as the operator orders them, by text within equal identifiers here."""
    texts = [(r[0], r[1] or "") for r in rows]
    out = []
    for k, (doc, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        edit = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = (plain_fingerprint(x) for x in (t, edit, after))
        out.append((doc, len(t), hashlib.sha256(edit.encode()).hexdigest(), ef.shown(a), ef.shown(b), ef.likeness(a, b), ef.likeness(a, c)))
    return out


def test_documents_meet_their_next(spark, docs):
    # the hash that orders ties is Spark's
    keyed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    ranked = sorted(keyed, key=lambda r: (r[0] is None, -(r[0] or 0), r[2], r[1] or ""))
    got = ef.fingerprint_documents(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert order(map(tuple, got.collect())) == order(plain_documents(ranked))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_documents(spark, n):
    rows = [(7, "seven is a text"), (5, "five is another one")][:n]
    got = ef.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order(map(tuple, got.collect())) == order(plain_documents(rows))


def test_likeness_follows_edits():
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(6000))
    own = ef.fingerprints([ef.points(base)])[0]
    near = []
    for edits in (1, 10, 100, 600):
        chars = list(base)
        for _ in range(edits):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([[], ["z"], [chars[at], "z"]])
        near.append(ef.likeness(own, ef.fingerprints([ef.points("".join(chars))])[0]))
    other = "".join(rng.choice("abcdefghijklmnop ") for _ in range(6000))
    assert near == sorted(near, reverse=True) and near[0] > 0.95 and near[1] > 0.8 and near[2] > 0.3
    assert ef.likeness(own, ef.fingerprints([ef.points(other)])[0]) < 0.1


def test_fingerprint_of_a_very_long_text():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(1_000_000))
    a, b = ef.fingerprints([ef.points(text), ef.points(text[:500_000])])
    assert 50 < len(a) - 5 < 200 and 0.3 < ef.likeness(a, b) < 0.7


def test_bands_find_near_documents(spark):
    rng = random.Random(12)
    rows, near = [], set()
    for i in range(0, 120, 2):
        t = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(40, 4000)))
        rows.append((i, t))
        if i % 6 == 0:
            at = rng.randrange(len(t))
            rows.append((i + 1, t[:at] + "x" + t[at:]))
            near.add((i + 1, i))
    rows += [(None, rows[0][1])]
    got = {(r[0], r[1]): r[2] for r in ef.near_documents(spark.createDataFrame(rows, "doc_id long, text string"), 0.7).collect()}
    texts = dict(rows)
    want = {p for p in near if ef.likeness(*(plain_fingerprint(texts[x]) for x in p)) >= 0.7}
    assert len(want) > 15 and set(got) == want
