"""Mixing sources to target weights, in DataFrame functions only.

Words are summed per source, targets are set by weight with a ceiling of three
repetitions, and the repetition rate is target over size.  Each document is
taken floor(rate) times plus one more with probability equal to the fraction,
drawn from a hash of its identifier.

The draws of a source are spread evenly.  Its documents fall into classes by
the binary length of their size.  In a class those whose hash is below a cut
get the extra copy, and the cut is set on a histogram of 4096 cells of the hash
so that the words taken fall on either side of the wanted ones by at most one
cell, on which side by a hash-seeded draw that keeps the expectation.  What a
class takes too much or too little is made good by the next smaller class, so a
source misses its target by about one of its smallest cells, not by what
independent draws over long documents would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
#: The cells of a class's histogram of hashes, 2^12.
_CELL_BITS = 12
_CELLS = 1 << _CELL_BITS


def word_count(text):
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Of (source, source_size): the target and the repetition rate of each source.

    Sources by code point, null last, weigh 1, 2, 3, repeating.  Together they
    get the sum of all sizes; a target stops at ``max_repeats`` times its
    source's size and the excess is shared again by weight: with sources in
    order of ceiling per weight, the ones before some place are at their
    ceiling and the rest share what is left by weight.  The windows run over
    one row a source.  A source without words has target and rate 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    weighed = weighed.withColumn("ceiling", F.col("source_size") * float(max_repeats))
    order = Window.orderBy((F.col("ceiling") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    levels = weighed.withColumns({
        "total": F.sum("source_size").over(all_rows).cast("double"),
        "capped": F.coalesce(F.sum("ceiling").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "share": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("level", (F.col("total") - F.col("capped")) / F.col("share"))
    free = F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))
    # the first place at which the level fits is the water level
    level = F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("ceiling"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return levels.withColumn("target", target).select(
        "source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")
    )


def _hash_bits(text):
    """52 bits of a text's hash, as a long."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _cell(id_col, seed: int):
    """The cell, 0 to 4095, of a document's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.shiftright(_hash_bits(text), 52 - _CELL_BITS).cast("int")


def _class(size):
    """The binary length of a size."""
    return F.length(F.bin(size))


def _plan_sources(sized: DataFrame, seed: int, max_repeats: int) -> DataFrame:
    """Of (source, size, cell) rows: per source its size, target, rate and the cut of every class.

    A group below holds at most 4096 cells of one class, or one source's
    classes, of which there are fewer than 64.
    """
    cells = materialize(sized.groupBy("source", _class(F.col("size")).alias("class"), "cell").agg(F.sum("size").alias("words")), "mixing-cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), max_repeats)
    running = Window.partitionBy("source", "class").orderBy("cell")
    upto = cells.filter("words > 0").withColumn("upto", F.sum("words").over(running)).withColumn("before", F.col("upto") - F.col("words"))
    classes = upto.groupBy("source", "class").agg(F.max("upto").alias("total"), F.collect_list(F.struct("cell", "before", "upto")).alias("cells"))
    seeds = F.concat(F.lit(f"{seed}:"), F.col("class").cast("string"), F.lit(":"), F.coalesce(F.col("source"), F.lit("null")))
    classes = classes.withColumn("draw", _hash_bits(seeds).cast("double") / float(2**52))
    by_source = classes.groupBy(F.col("source").alias("of")).agg(F.sort_array(F.collect_list(F.struct("class", "total", "draw", "cells")), asc=False).alias("classes"))
    planned = targets.join(by_source, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("part", F.col("rate") - F.floor("rate"))

    def step(state, group):
        want = F.col("part") * group["total"] + state["carry"]
        # the cell in which the wanted words end
        hit = F.get(F.filter(group["cells"], lambda c: (c["before"] <= want) & (want < c["upto"])), F.lit(0))
        more = group["draw"] < (want - hit["before"]) / (hit["upto"] - hit["before"])
        cut = F.when(want < 0, 0).when(hit.isNull(), _CELLS).otherwise(hit["cell"] + F.when(more, 1).otherwise(0))
        taken = F.when(want < 0, F.lit(0).cast("long")).when(hit.isNull(), group["total"]).when(more, hit["upto"]).otherwise(hit["before"])
        return F.struct((want - taken).alias("carry"), F.map_concat(state["cuts"], F.create_map(group["class"], cut)).alias("cuts"))

    none = F.struct(F.lit(0.0).alias("carry"), F.create_map().cast("map<int,int>").alias("cuts"))
    cuts = F.aggregate(F.coalesce("classes", F.array()), none, step, lambda state: state["cuts"])
    return materialize(planned.select("source", "source_size", "target", "rate", cuts.alias("cuts")), "mixing-targets")


def _copies(rate, cuts, size, cell):
    """floor(rate), and one more below the cut of the size's class; without a cut, below the fraction."""
    part = rate - F.floor(rate)
    # one lookup: inside a lambda the size would be worked out for every class
    cut = F.coalesce(F.try_element_at(cuts, _class(size)).cast("double"), part * _CELLS)
    return (F.floor(rate) + F.when(cell < cut, 1).otherwise(0)).cast("long")


def mix_plan(docs: DataFrame, seed: int = 17, max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often each document is taken: doc_id, size, source_size, target, taken, copies.

    Size counts words (null: 0).  Rows that share an identifier share the hash.
    Every source, null included, has its own target; a document without words
    takes none.  Reruns agree.  Other columns are ignored; an empty table gives
    an empty result.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), _cell(F.col(id_col), seed).alias("cell"))
    slim = materialize(slim, "mixing")
    # written, so that its true size decides how it is joined
    targets = _plan_sources(slim, seed, max_repeats).withColumnRenamed("source", "of")
    joined = slim.join(targets, F.col("source").eqNullSafe(F.col("of")))
    planned = joined.withColumn("copies", _copies(F.col("rate"), F.col("cuts"), F.col("size"), F.col("cell")))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source")


def mix_documents(docs: DataFrame, seed: int = 17, max_repeats: int = MAX_REPEATS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix_plan` takes it.

    All columns are kept, whatever their names.  A null or empty text has no
    words and is taken as often as the fraction and its hash say; repeated rows
    are each taken as often.  An empty table gives an empty result.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: F.col(names[i]) for i, c in enumerate(docs.columns)}
    # positions stand for names, so no column of the input can clash
    rows = docs.toDF(*names)
    source, size, cell = at[source_col].cast("string"), word_count(at[text_col]), _cell(at[id_col], seed)
    targets = _plan_sources(rows.select(source.alias("source"), size.alias("size"), cell.alias("cell")), seed, max_repeats)
    targets = targets.select(F.col("source").alias("of"), "rate", "cuts")
    joined = rows.join(targets, source.eqNullSafe(F.col("of")))
    n = _copies(F.col("rate"), F.col("cuts"), size, cell)
    repeated = joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), n.cast("int"))))
    return repeated.select(*names).toDF(*docs.columns)
