"""Keys, cardinality-checked joins and eligibility."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row_count, null_keys, duplicate_values, duplicate_rows."""
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(some_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~some_null & (F.col("n") > 1)).alias("duplicate_values"),
        F.coalesce(F.sum(F.when(~some_null & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("duplicate_rows"),
    )


def assert_unique_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``df`` itself; raises when a key column is missing, null or repeats."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"no column {missing}")
    found = key_violations(df, keys).first()
    if found["null_keys"] or found["duplicate_values"]:
        raise ValueError(f"{keys}: {found['null_keys']} null, {found['duplicate_values']} repeated")
    return df


assert_pair_unique = assert_unique_key


def left_many_to_one(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], columns: Mapping[str, str], hit: str | None = None) -> DataFrame:
    """LEFT join to a dimension; ``columns`` renames what is taken from it.

    Whether the dimension is broadcast is left to its size.  ``hit`` names a
    marker that is true for matched rows.
    """
    taken = [F.col(k).alias(f"__k{i}") for i, k in enumerate(right_keys)] + [F.col(c).alias(a) for c, a in columns.items()]
    dim = right.select(*taken, *([F.lit(True).alias(hit)] if hit else []))
    on = reduce(lambda a, b: a & b, [left[k] == dim[f"__k{i}"] for i, k in enumerate(left_keys)])
    return left.join(dim, on, "left").drop(*[f"__k{i}" for i in range(len(right_keys))])


def join_many_to_one(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """left_many_to_one after a check that the right key is unique, so rows cannot multiply."""
    assert_unique_key(right.dropna(subset=list(right_keys)), right_keys)
    return left_many_to_one(left, right, left_keys, right_keys, columns)


def join_audit(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """One row: input_rows, output_rows, unmatched_rows, multiplied_rows, from counts per key."""
    l = left.groupBy(*left_keys).agg(F.count(F.lit(1)).alias("n"))
    r = right.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(right_keys)]).agg(F.count(F.lit(1)).alias("m"))
    on = reduce(lambda a, b: a & b, [l[k] == r[f"__k{i}"] for i, k in enumerate(left_keys)])
    j = l.join(r, on, "left")
    zero = F.lit(0)
    return j.agg(
        F.coalesce(F.sum("n"), zero).alias("input_rows"),
        F.coalesce(F.sum(F.col("n") * F.coalesce("m", F.lit(1))), zero).alias("output_rows"),
        F.coalesce(F.sum(F.when(F.col("m").isNull(), F.col("n"))), zero).alias("unmatched_rows"),
        F.coalesce(F.sum(F.col("n") * (F.coalesce("m", F.lit(1)) - 1)), zero).alias("multiplied_rows"),
    )


def null_unless_valid(df: DataFrame, columns: Sequence[str], date: str, start: str, end: str, flag: str) -> DataFrame:
    """Keep rows; null the columns unless start <= date and (end is null or end >= date)."""
    valid = F.coalesce((F.col(start) <= F.col(date)) & (F.col(end).isNull() | (F.col(end) >= F.col(date))), F.lit(False))
    return df.withColumns({c: F.when(valid, F.col(c)) for c in columns} | {flag: valid})


def classify_eligibility(claims: DataFrame, key: str, target: str, date: str, links: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """key, eligibility: one category a row, by priority.

    INVALID_KEY (null or repeated), NULL_TARGET, INVALID_TARGET, MISSING_DATE,
    MISSING_<LINK> (null or unknown), ELIGIBLE.
    """
    marked = claims.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    for i, (column, (entities, entity_key)) in enumerate(links.items()):
        known = entities.select(F.col(entity_key).alias(f"__e{i}")).dropna().distinct()
        marked = marked.join(known, marked[column] == F.col(f"__e{i}"), "left")
    category = F.when(F.col(key).isNull() | (F.col("__n") > 1), "INVALID_KEY").when(F.col(target).isNull(), "NULL_TARGET").when(~F.col(target).isin(0, 1), "INVALID_TARGET").when(F.col(date).isNull(), "MISSING_DATE")
    for i, column in enumerate(links):
        category = category.when(F.col(f"__e{i}").isNull(), F.lit(f"MISSING_{column.upper()}"))
    return marked.select(key, category.otherwise("ELIGIBLE").alias("eligibility"))


def align_one_to_one(left: DataFrame, right: DataFrame, key: str, same: Sequence[str] = ()) -> DataFrame:
    """One row: matched, left_only, right_only and mismatches of the columns that must agree."""
    l = left.select(F.col(key), F.lit(True).alias("__l"), *[F.col(c).alias(f"__l_{c}") for c in same])
    r = right.select(F.col(key), F.lit(True).alias("__r"), *[F.col(c).alias(f"__r_{c}") for c in same])
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    return l.join(r, key, "full_outer").agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("__r").isNull()).alias("left_only"),
        F.count_if(F.col("__l").isNull()).alias("right_only"),
        *[F.count_if(both & ~F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}"))).alias(f"mismatched_{c}") for c in same],
    )


def aligned(left: DataFrame, right: DataFrame, key: str, same: Sequence[str] = ()) -> DataFrame:
    """The inner join of two frames that align_one_to_one finds equal in keys and ``same``; else raises."""
    found = align_one_to_one(left, right, key, same).first().asDict()
    if any(v for k, v in found.items() if k != "matched"):
        raise ValueError(f"frames do not align: {found}")
    return left.join(right.drop(*same), key)


def fk_orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str], name: str) -> DataFrame:
    """One row: fk_name, rows_checked (all key parts present), orphan_rows, orphan_pct, childless_parents."""
    present = child.dropna(subset=list(child_keys)).groupBy(*[F.col(k).alias(f"c{i}") for i, k in enumerate(child_keys)]).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.dropna(subset=list(parent_keys)).select(*[F.col(k).alias(f"p{i}") for i, k in enumerate(parent_keys)]).distinct().withColumn("known", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(f"c{i}") == F.col(f"p{i}") for i in range(len(child_keys))])
    j = present.join(parents, on, "full_outer")
    rows, orphans = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0))
    return j.agg(rows.alias("rows_checked"), orphans.alias("orphan_rows"), F.count_if(F.col("n").isNull()).alias("childless_parents")).select(
        F.lit(name).alias("fk_name"), "rows_checked", "orphan_rows", F.coalesce(F.when(F.col("rows_checked") > 0, 100.0 * F.col("orphan_rows") / F.col("rows_checked")), F.lit(0.0)).alias("orphan_pct"), "childless_parents"
    )


def star_context(fact: DataFrame, joins: Sequence[tuple[DataFrame, Sequence[str], Sequence[str], str]]) -> DataFrame:
    """Chain of LEFT many-to-one joins; a dimension's column keeps its name unless it is taken, else gets the prefix."""
    out = fact
    for dim, left_keys, right_keys, prefix in joins:
        columns = {c: (c if c not in out.columns else f"{prefix}{c}") for c in dim.columns if c not in right_keys}
        out = left_many_to_one(out, dim, left_keys, right_keys, columns)
    return out


def direct_snapshot(claims: DataFrame, joins: Sequence[tuple[DataFrame, Sequence[str], Sequence[str], Mapping[str, str]]], outputs: Mapping[str, str], check: bool = True) -> DataFrame:
    """Eligible claims with validated dimension joins, renamed to the mapped outputs."""
    out = claims
    for dim, left_keys, right_keys, columns in joins:
        join = join_many_to_one if check else left_many_to_one
        out = join(out, dim, left_keys, right_keys, columns)
    return out.select(*[F.col(c).alias(a) for c, a in outputs.items()])


def context_coverage(context: DataFrame, input_rows: DataFrame, markers: Mapping[str, str]) -> DataFrame:
    """One row: input_rows, output_rows, multiplied (0/1) and with_/without_ counts per marker column."""
    n = input_rows.agg(F.count(F.lit(1)).alias("input_rows"))
    counts: list[Column] = [F.count(F.lit(1)).alias("output_rows")]
    for name, column in markers.items():
        counts += [F.count_if(F.col(column).isNotNull()).alias(f"with_{name}"), F.count_if(F.col(column).isNull()).alias(f"without_{name}")]
    both = n.crossJoin(context.agg(*counts))
    return both.withColumn("multiplied", (F.col("input_rows") != F.col("output_rows")).cast("int"))
