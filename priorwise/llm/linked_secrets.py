"""Secret scans with multipart credential linking, in DataFrame functions only.

Each kind's pattern marks its matches in the text with a control character; the
pieces between marks give the spans.  Strong kinds are reported as they are.
Weak candidates (a bare 40-character secret, an account name, an endpoint) are
reported only when complementary parts co-occur: an interval join matches parts
whose spans lie within ``SCOPE`` code points of each other in one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import materialize

SCOPE = 400
_MARK = "\x01"
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Strong kinds, in the order in which ties are listed.  Patterns keep whole
#: runs, so what is too short uses up its run before it is dropped.
STRONG = (
    ("assign", _ASSIGN),
    ("access", r"AKIA[A-Z0-9]{12,}"),
    ("hex", r"[0-9a-f]{32,}"),
)
#: Weak kinds: pattern, and the strong kinds of which one must lie in scope.
WEAK = (
    ("bare_secret", r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", ("access",)),
    ("account", r"(?i)\b(?:user(?:name)?|login|client_?id|account)\b[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@+-]{3,}", ("assign", "hex")),
    ("endpoint", r"(?i)\b(?:https?|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D\"'<>]{4,}", ("assign", "access", "hex")),
)
_KINDS = [k for k, _ in STRONG] + [k for k, _, _ in WEAK]
#: Pieces of a text that are turned into spans at a time.
_GROUP = 256
_SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _spans(text: Column, kind: int, pattern: str) -> Column:
    """Spans of the pattern's matches, leftmost and non-overlapping, by code point.

    ``text`` must not hold the mark.
    """
    pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)

    def step(acc: Column, piece: Column) -> Column:
        # pieces at odd places are matches
        stop = acc["at"] + F.length(piece)
        keep = acc["i"] % 2 == 1
        if kind == 0:
            keep = keep & (F.length(F.regexp_extract(piece, _ASSIGN, 2)) >= 8)
        span = F.struct(acc["at"].alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"))
        return F.struct(stop.alias("at"), (acc["i"] + 1).alias("i"), F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def spans_of(group: Column) -> Column:
        start = F.struct(group["at"].alias("at"), F.lit(0).alias("i"), F.array().cast(_SPANS).alias("out"))
        return F.aggregate(group["pieces"], start, step, lambda acc: acc["out"])

    # Appending copies what stands, so spans are gathered in groups of an even
    # number of pieces; where each group begins is summed up from numbers alone.
    groups = F.transform(F.sequence(F.lit(0), F.ceil(F.size(pieces) / _GROUP).cast("int") - 1), lambda g: F.slice(pieces, g * _GROUP + 1, F.lit(_GROUP)))
    lengths = F.transform(groups, lambda group: F.aggregate(group, F.lit(0), lambda n, piece: n + F.length(piece)))
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    begins = F.aggregate(lengths, begun, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    found = F.flatten(F.transform(F.zip_with(begins, groups, lambda at, group: F.struct(at.alias("at"), group.alias("pieces"))), spans_of))
    return F.when(F.size(pieces) > 1, found).otherwise(F.array().cast(_SPANS))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in _KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def scan_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    A null text counts as empty: no spans, the digest of an empty string.
    Rows equal in identifier and text get equal results.  Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), _MARK, "\x02")
    cols = {"strong": F.array_sort(F.concat(*[_spans(F.col("text"), k, p) for k, (_, p) in enumerate(STRONG)]))}
    cols["weak"] = F.concat(*[_spans(F.col("text"), k + len(STRONG), p) for k, (_, p, _) in enumerate(WEAK)])
    scanned = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumns(cols | {"text_hash": F.xxhash64("text"), "chars": F.length("text")})
    scanned = materialize(scanned.drop("text"), "secrets")

    # Only texts with both a weak and a strong part go into the join.
    key = ["doc_id", "text_hash", "chars"]
    both = scanned.filter((F.size("weak") > 0) & (F.size("strong") > 0)).dropDuplicates(key)
    weak = both.select(*key, F.explode("weak").alias("part"))
    strong = both.select(*key, F.explode("strong").alias("part"))
    # A part stands in every cell of ``scope`` code points that it touches, a
    # strong one widened by the scope, so each pair in scope meets in a cell.
    cells = lambda start, stop: F.explode(F.sequence(F.floor(F.greatest(start, F.lit(0)) / scope), F.floor(stop / scope)))
    strong = strong.withColumn("cell", cells(F.col("part.start") - scope, F.col("part.stop") + scope)).alias("s")
    weak = weak.withColumn("cell", cells(F.col("part.start"), F.col("part.stop"))).alias("w")
    pairs = [(k + len(STRONG), [i for i, (name, _) in enumerate(STRONG) if name in needs]) for k, (_, _, needs) in enumerate(WEAK)]
    fits = F.lit(False)
    for kind, wanted in pairs:
        fits = fits | ((F.col("w.part.kind") == kind) & F.col("s.part.kind").isin(wanted))
    near = (F.col("s.part.start") <= F.col("w.part.stop") + scope) & (F.col("s.part.stop") >= F.col("w.part.start") - scope)
    apart = (F.col("s.part.start") >= F.col("w.part.stop")) | (F.col("s.part.stop") <= F.col("w.part.start"))
    meet = F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.text_hash") == F.col("s.text_hash")) & (F.col("w.chars") == F.col("s.chars")) & (F.col("w.cell") == F.col("s.cell"))
    linked = weak.join(strong, meet & fits & near & apart, "left_semi").groupBy(*key).agg(F.collect_set("part").alias("linked"))
    linked = materialize(linked, "linked").select(*[F.col(c).alias(f"k_{c}") for c in key], "linked")
    same = F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & (F.col("text_hash") == F.col("k_text_hash")) & (F.col("chars") == F.col("k_chars"))
    out = scanned.join(linked, same, "left").withColumn("linked", F.coalesce("linked", F.array().cast(_SPANS)))
    n = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(_written(F.col("strong")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("strong", "linked"))).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
