"""Joins, ranks, quantiles and lineage cuts that hold when one key owns a third of the rows.

Three habits run through the library:

* a join to a per-key aggregate goes through :func:`join_hot`, which salts the keys known to be heavy;
* an ordered computation inside a group runs over (group, block) pieces, where the block is a monotone
  function of the order, and small per-block totals carry the offsets;
* a table is broadcast only after its rows were counted, and takes a shuffled join otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

HOT_ROWS = 2_000_000
"""Rows of one key above which its rows are spread over several tasks."""

LOOKUP_ROWS = 200_000
"""Largest lookup table that is broadcast."""


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, which all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyweave-"))
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 250_000
"""Rows that one task of a sort or an aggregation gets, on average, where rows were counted."""


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks share ``rows``: as many as Spark is set to, more where a task's rows would pass TASK_ROWS."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def join_hot(
    facts: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    rows: str,
    how: str = "inner",
    hot_rows: int | None = None,
    hot: bool = True,
) -> DataFrame:
    """Join ``facts`` to a table with one row per key whose column ``rows`` counts the key's facts.

    Keys above ``hot_rows`` are cut into salted pieces on the fact side and repeated on the other.  The list
    of such keys has at most |facts| / hot_rows rows, which bounds the broadcast.  ``rows`` is dropped.  A caller
    that has measured there is no such key (:func:`any_hot`) says ``hot=False`` and gets the plain join.
    """
    keys = list(keys)
    hot_rows = hot_rows or HOT_ROWS
    if not hot:
        return facts.join(per_key.drop(rows), keys, how)
    pieces = F.ceil(F.col(rows) / F.lit(float(hot_rows))).cast("int")
    heavy = per_key.where(F.col(rows) > hot_rows).select(*keys, pieces.alias("_pieces"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.col("_pieces")).cast("int")
    left = (
        facts.join(F.broadcast(heavy), keys, "left")
        .withColumn("_salt", F.coalesce(spread, F.lit(0)))
        .drop("_pieces")
    )
    right = per_key.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1))
    ).drop(rows)
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def any_hot(per_key: DataFrame, rows: str) -> bool:
    """Whether some key of a written table has more than HOT_ROWS facts."""
    return (per_key.agg(F.max(rows)).first()[0] or 0) > HOT_ROWS


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a lookup table: broadcast when it was counted to be small, salted otherwise."""
    keys = list(keys)
    if lookup.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS:
        return facts.join(F.broadcast(lookup), keys, how)
    used = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return join_hot(facts, lookup.join(used, keys), keys, "_rows", how)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    block: Column,
    sums: dict[str, str],
    peers: bool = False,
) -> DataFrame:
    """Inclusive running sums inside ``by`` in ``order``: ``sums`` maps output name to summed column.

    ``block`` must rise with ``order``, so that each (by, block) piece is summed in its own task.  With
    ``peers`` the rows equal in ``order`` share the sum of all of them.
    """
    by = list(by)
    keyed = df.withColumn("_block", block)
    totals = keyed.groupBy(*by, "_block").agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_block", *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums]
    )
    w = Window.partitionBy(*by, "_block").orderBy(*order)
    w = w.rangeBetween(Window.unboundedPreceding, 0) if peers else w.rowsBetween(Window.unboundedPreceding, 0)
    inside = keyed.select("*", *[F.sum(c).over(w).alias(f"_l_{o}") for o, c in sums.items()])
    out = inside.join(offsets, [*by, "_block"])
    for o in sums:
        out = out.withColumn(o, F.col(f"_l_{o}") + F.col(f"_o_{o}")).drop(f"_l_{o}", f"_o_{o}")
    return out.drop("_block")


def global_position(df: DataFrame, order: Sequence[Column | str], name: str = "pos") -> DataFrame:
    """1-based position of every row in the total ``order``, by a range-partitioned sort.

    The sorted table is written once with its partition number, so that the offsets (one row per partition)
    and the rows refer to the same split.
    """
    part = F.spark_partition_id().alias("_part")
    inner = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = materialise(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("*", part, inner))
    sizes = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        cut.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_row", "_before")
    )


PIECE_ROWS = 200_000
"""Rows of a group that are put in order together; larger groups are cut at quantiles of their own values."""

MOST_PIECES = 256
"""Pieces of the largest groups."""


def in_pieces(df: DataFrame, by: Sequence[str], value: str, piece_rows: int | None = None) -> DataFrame:
    """``df`` with ``_piece``, which rises with ``value`` inside ``by``: pieces of a group hold about equally many rows, however the values are spread.

    A mergeable quantile sketch of each group gives the cuts, so an outlier or a crowd near zero moves them along.  Equal values
    share a piece; a value that fills more than a piece makes a large one, so callers tally equal values first.
    Read twice: pass a written table, or one that is cheap to make."""
    by = list(by)
    piece_rows = piece_rows or PIECE_ROWS
    v = F.col(value).cast("double")
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    large = materialise(groups.where(F.col("_rows") > piece_rows))
    if not large.limit(1).count():
        return df.withColumn("_piece", F.lit(0))
    probs = F.array(*[F.lit(i / MOST_PIECES) for i in range(1, MOST_PIECES)])
    some = join_hot(df.select(*by, value), large, by, "_rows", "left_semi")
    cuts = some.groupBy(*by).agg(F.percentile_approx(v, probs, F.lit(16 * MOST_PIECES)).alias("_cuts"), F.count(F.lit(1)).alias("_rows"))
    pieces = F.least(F.lit(MOST_PIECES), F.ceil(F.col("_rows") / piece_rows))
    chosen = F.filter("_cuts", lambda c, i: F.pmod((i + 1) * pieces, F.lit(MOST_PIECES)) < pieces)
    cuts = materialise(cuts.select(*by, "_rows", F.array_distinct(chosen).alias("_cuts")))
    piece = F.size(F.filter("_cuts", lambda c: c < v))
    return join_hot(df, cuts, by, "_rows", "left").withColumn("_piece", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(piece)).drop("_cuts")


def average_ranks(df: DataFrame, by: Sequence[str], value: str, block: Column | None, name: str) -> DataFrame:
    """Ranks with ties averaged inside ``by``; equal values are one row while ranking.

    ``block`` must rise with the value; None takes pieces of about equal size."""
    by = list(by)
    tally = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    if block is None:
        tally, block = in_pieces(materialise(tally), by, value), F.col("_piece")
    ranked = running(tally, by, [value], block, {"_upto": "_n"})
    ranked = ranked.select(*by, value, (F.col("_upto") - (F.col("_n") - 1) / 2.0).alias(name), "_n")
    return join_hot(df, ranked, [*by, value], "_n")


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group: (by, p, q).

    Equal values are counted first.  A group's values are cut into pieces of about equal size (:func:`in_pieces`); the pieces' counts locate
    the wanted ranks, and only pieces that hold one are ordered.  No group is collected.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    if not by:
        rows = rows.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    counted = materialise(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_k")))
    binned = in_pieces(counted, keys, "_v").withColumnRenamed("_piece", "_block")
    span = counted.groupBy(*keys).agg(F.sum("_k").alias("_n"))
    held = binned.groupBy(*keys, "_block").agg(F.sum("_k").alias("_c"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    wanted = span.select(*keys, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    wanted = wanted.withColumn("_h", F.col("p") * (F.col("_n") - 1))
    wanted = wanted.select(
        *keys, "p", "_h", F.explode(F.array(F.floor("_h"), F.ceil("_h"))).alias("_rank")
    ).distinct()
    at = held.join(wanted, keys).where(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c"))
    )
    blocks = at.select(*keys, "_block", "_rows").distinct()
    tally = join_hot(binned, blocks, [*keys, "_block"], "_rows", "left_semi")
    w = Window.partitionBy(*keys, "_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    tally = tally.withColumn("_upto", F.sum("_k").over(w))
    picked = tally.join(at, [*keys, "_block"]).where(
        (F.col("_rank") >= F.col("_before") + F.col("_upto") - F.col("_k"))
        & (F.col("_rank") < F.col("_before") + F.col("_upto"))
    )
    low, high = F.min("_v"), F.max("_v")
    share = F.first(F.col("_h") - F.floor("_h"))
    return picked.groupBy(*keys, "p").agg((low + share * (high - low)).alias("q")).select(*by, "p", "q")
