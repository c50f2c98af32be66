"""Exact ranks, samples, splits and running totals without a one-task window.

The order key of every seeded operator is a hash of the row id, so its leading hex digits
cut each group into even buckets. Counting rows per (group, bucket) is a partial
aggregation with a result of at most groups x 65,536 rows; running totals over that small
table give each bucket its offset. Only rows of one bucket ever meet in a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.text import _c
from voxloom.schema import SEED

HEX_DIGITS = 4      # 16 ** 4 buckets per group
BROADCAST_GROUPS = 100_000   # groups up to which their cut-offs are broadcast
GROUP_LIMIT = 1000   # Spark's default bound for a group limit below the shuffle
PARTS = 1024
CUTS = 64


def seeded_hash(id_col: Column | str, seed: int = SEED) -> Column:
    """Reproducible random order key of a row. A row without an id has no place in the order: an error."""
    key = _c(id_col).cast("string")
    none = F.raise_error(F.lit("a seeded order needs an id on every row, found null")).cast("string")
    return F.when(key.isNull(), none).otherwise(F.md5(F.concat(F.lit(f"{seed}-"), key)))


def _offsets(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, bucket) -> rows in the bucket and rows of the group in earlier buckets."""
    counts = df.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_in_bucket"))
    earlier = (Window.partitionBy(*groups).orderBy("_bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn(
        "_before", F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)))


def _keyed(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    h = seeded_hash(id_col, seed)
    return df.withColumn("_hash", h).withColumn("_bucket", F.substring("_hash", 1, HEX_DIGITS))


def seeded_rank(df: DataFrame, id_col: str, groups: Sequence[str] = (), seed: int = SEED,
                name: str = "shuffle_pos") -> DataFrame:
    """Position (from 1) of every row in the seeded random order of its group."""
    keyed = _keyed(df, id_col, seed)
    offsets = _offsets(keyed, groups).drop("_in_bucket")
    within = Window.partitionBy(*groups, "_bucket").orderBy("_hash", id_col)
    ranked = keyed.withColumn("_rn", F.row_number().over(within))
    return (ranked.join(offsets, [*groups, "_bucket"])
            .withColumn(name, (F.col("_rn") + F.col("_before")).cast("long"))
            .select(*df.columns, name))


def cutoffs(df: DataFrame, id_col: str, groups: Sequence[str], quota: Column | DataFrame,
            seed: int = SEED) -> DataFrame:
    """Per group: the order key of the last row inside the quota.

    ``quota`` may use ``n_group``, the size of the group, or is a table with ``quota`` per
    group. A group whose quota is below one has no row here. Rows of one bucket per group are
    ranked. The joins are left to Spark: few groups are broadcast by their measured size.
    """
    keyed = _keyed(df.select(*groups, id_col), id_col, seed)
    # Both windows run over the (group, bucket) counts, never over rows.
    sized = _offsets(keyed, groups).withColumn(
        "n_group", F.sum("_in_bucket").over(Window.partitionBy(*groups)))
    if isinstance(quota, DataFrame):
        sized, quota = sized.join(quota, list(groups)), F.col("quota")
    last = (sized.withColumn("_quota", F.least(quota.cast("long"), F.col("n_group")))
            .filter((F.col("_before") < F.col("_quota"))
                    & (F.col("_before") + F.col("_in_bucket") >= F.col("_quota")))
            .select(*groups, "_bucket", (F.col("_quota") - F.col("_before")).alias("_nth")))
    edge = keyed.join(last, [*groups, "_bucket"])
    within = Window.partitionBy(*groups, "_bucket").orderBy("_hash", id_col)
    return (edge.withColumn("_rn", F.row_number().over(within))
            .filter(F.col("_rn") == F.col("_nth"))
            .select(*groups, F.col("_hash").alias("_cut_hash"), F.col(id_col).alias("_cut_id")))


def mark_quota(df: DataFrame, id_col: str, groups: Sequence[str], quota: Column | DataFrame,
               seed: int = SEED, name: str = "chosen") -> DataFrame:
    """Flag the first ``quota`` rows of each group in seeded order; the rows do not move.

    The cut-offs, a row per group, are counted first and broadcast up to BROADCAST_GROUPS. Left to
    itself Spark deals the rows by group to join them, so that a few classes are as many tasks; and it
    does not turn to a broadcast later, as most of the dealt partitions are empty.
    """
    cut = cutoffs(df, id_col, groups, quota, seed)
    if cut.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        cut = F.broadcast(cut)
    keyed = df.withColumn("_hash", seeded_hash(id_col, seed))
    inside = (F.col("_hash") < F.col("_cut_hash")) | (
        (F.col("_hash") == F.col("_cut_hash")) & (F.col(id_col) <= F.col("_cut_id")))
    return (keyed.join(cut, list(groups), "left")
            .withColumn(name, F.coalesce(inside, F.lit(False)))
            .select(*df.columns, name))


def balanced_sample(df: DataFrame, id_col: str, group: str, per_group: int,
                    seed: int = SEED) -> DataFrame:
    """At most ``per_group`` seeded random rows of every class."""
    return mark_quota(df, id_col, [group], F.lit(per_group), seed).filter("chosen").drop("chosen")


def stratified_split(df: DataFrame, id_col: str, label: str, test_share: float = 0.2,
                     seed: int = SEED, name: str = "part") -> DataFrame:
    """Exact per-label split; ``name`` is 'test' or 'train'."""
    quota = F.round(F.col("n_group") * F.lit(test_share))
    marked = mark_quota(df, id_col, [label], quota, seed)
    return (marked.withColumn(name, F.when(F.col("chosen"), "test").otherwise("train"))
            .drop("chosen"))


def validation_carve(train: DataFrame, id_col: str, label: str, size: float | int = 0.15,
                     seed: int = SEED, name: str = "part") -> DataFrame:
    """Carve a validation part out of the training rows, in proportion to the labels.

    ``size`` is a share, or as an integer the exact number of rows over all labels: each label
    gets the whole part of its share, what is over goes to the largest remainders (ties to the
    smaller label). The window for that holds one row per label.
    """
    if isinstance(size, int):
        exact = F.col("n") * F.lit(size) / F.sum("n").over(Window.partitionBy(F.lit(0)))
        shares = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).select(
            label, F.floor(exact).alias("whole"), (exact - F.floor(exact)).alias("rest"))
        order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("rest", 9)), label)
        over = F.lit(size) - F.sum("whole").over(Window.partitionBy(F.lit(0)))
        quota = shares.withColumn("_over", over).withColumn("_at", F.row_number().over(order)).select(
            label, (F.col("whole") + (F.col("_at") <= F.col("_over")).cast("int")).alias("quota"))
    else:
        quota = F.round(F.col("n_group") * F.lit(size))
    marked = mark_quota(train, id_col, [label], quota, seed + 1)
    return (marked.withColumn(name, F.when(F.col("chosen"), "validation").otherwise("train"))
            .drop("chosen"))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = SEED) -> DataFrame:
    """The n rows that are first in seeded order, found by their cut-off: for any n the rows
    stay where they are, and only one bucket of ids is ranked."""
    keyed = df.withColumn("_all", F.lit(0))
    cut = F.broadcast(cutoffs(keyed, id_col, ["_all"], F.lit(n), seed))  # a single row
    h = seeded_hash(id_col, seed)
    return (keyed.join(cut, "_all")
            .filter((h < F.col("_cut_hash")) | ((h == F.col("_cut_hash")) & (F.col(id_col) <= F.col("_cut_id"))))
            .select(*df.columns))


def head_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str],
                   n: int) -> DataFrame:
    """First n rows per group; ``order`` should be a total order.

    Up to GROUP_LIMIT the rank filter lets Spark cut every map task to n rows per group
    before the shuffle (a group limit below the exchange), so a hot group stays small. For
    larger n the groups are ranked in salted parts first: the first n of a group are among
    the first n of its parts.
    """
    if n > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))
        parts = Window.partitionBy(*groups, "_part").orderBy(*order)
        df = (df.withColumn("_part", salt).withColumn("_rn", F.row_number().over(parts))
              .filter(F.col("_rn") <= n).drop("_part", "_rn"))
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def ordered_distinct_topn(df: DataFrame, group: str, key: str, pos: str, n: int) -> DataFrame:
    """First n distinct keys per group in order of first appearance."""
    first = df.groupBy(group, key).agg(F.min(pos).alias("first_pos"))
    return head_per_group(first, [group], ["first_pos", key], n)


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact sum of ``value`` over all rows before this one in a total order.

    The order key is cut into slices at up to ``CUTS`` of its values, those of the rows with the
    smallest hashes. A value that is a cut has a slice of its own, which the next order column cuts
    again, so that a value with very many rows does not meet in one task. Totals of slices are a
    small table; only rows of one slice are summed in a window. The cuts are a scalar subquery:
    nothing runs before the result is asked for, and any cuts give the same sums.
    """
    keys = [F.col(c) for c in order]
    some = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)], F.xxhash64(*keys).alias("_h")).orderBy("_h").limit(CUTS)
    cuts = some.agg(F.struct(*[F.collect_set(f"_k{i}").alias(f"c{i}") for i in range(len(keys))])).scalar()
    within, fields = F.lit(True), []
    for i, key in enumerate(keys):
        own = cuts[f"c{i}"]
        below = F.array_position(F.sort_array(F.array_append(own, key)), key).cast("int") - 1
        is_cut = F.coalesce(F.array_contains(own, key), F.lit(False))
        fields.append(F.when(within, F.coalesce(below * 2 + is_cut.cast("int"), F.lit(-1))).otherwise(F.lit(0)).alias(f"s{i}"))
        within = within & is_cut
    sliced = df.withColumn("_slice", F.struct(*fields))
    before_slice = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (sliced.groupBy("_slice").agg(F.sum(value).alias("_slice_sum"))
              .select("_slice", F.coalesce(F.sum("_slice_sum").over(before_slice), F.lit(0)).alias("_before")))
    before_row = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Slices are bounded by the cuts: at most 2 x CUTS + 1 for a column and for each cut of it.
    return (sliced.withColumn("_within", F.coalesce(F.sum(value).over(before_row), F.lit(0)))
            .join(F.broadcast(slices), "_slice")
            .withColumn(name, F.col("_within") + F.col("_before"))
            .select(*df.columns, name))


def running_cap(df: DataFrame, order: Sequence[str], n: str, target: int) -> DataFrame:
    """Keep whole threads while the total before them is below the target."""
    return running_total(df, order, n, "total_before").filter(F.col("total_before") < target)


def page_cap(pages: DataFrame, thread: str, page: str, size: str, max_pages: int,
             page_size: int) -> DataFrame:
    """Pages a reader would visit: every earlier page is there and full, below the cap.

    The page bound comes first, and repeated fetches of a page collapse before the window,
    so a thread has at most ``max_pages`` rows in it however hot it is.
    """
    sizes = (pages.filter((F.col(page) >= 0) & (F.col(page) < max_pages))
             .groupBy(thread, page).agg(F.max(size).alias(size)))
    earlier = Window.partitionBy(thread).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    return (sizes
            .withColumn("_full", F.count_if(F.col(size) >= page_size).over(earlier))
            .filter((F.col("_full") == F.col(page)) & (F.col(size) > 0)).drop("_full"))
