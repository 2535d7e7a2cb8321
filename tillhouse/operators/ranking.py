"""Ranks over a whole table without sending it through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import shared_folder

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition below this bit


def global_row_number(frame: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Exact row number over the whole table in the given total order.

    The rows are range-partitioned and sorted, so a row's rank is the number of rows in earlier
    partitions plus its place in its own. The sorted rows are checkpointed once: partition sizes and
    ranks must come from the same range boundaries, also after a lost executor.
    """
    shared_folder(frame.sparkSession)
    place = F.monotonically_increasing_id()
    ordered = (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.shiftright(place, _ROW_BITS),
                "_place": place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
            }
        )
        .checkpoint()
    )
    # One row per partition: its size is bounded by the shuffle partition count, not by the data.
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_offset_part"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        ordered.join(F.broadcast(offsets), F.col("_part") == F.col("_offset_part"))
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset_part", "_offset")
    )


def global_ntile(frame: DataFrame, tiles: int, order: list[Column | str], name: str) -> DataFrame:
    """ntile(tiles) over the whole table: the first `rows mod tiles` tiles hold one row more."""
    ranked = global_row_number(frame, order, "_row")
    total = ranked.agg(F.count("*")).scalar()
    base, extra = F.floor(total / F.lit(tiles)), total % tiles
    long_rows = extra * (base + 1)
    row = F.col("_row") - 1
    tile = F.when(row < long_rows, F.floor(row / (base + 1))).otherwise(
        extra + F.floor((row - long_rows) / F.greatest(base, F.lit(1)))
    )
    return ranked.withColumn(name, (tile + 1).cast("int")).drop("_row")


#: How many characters of a key, after those that all keys share, make a piece of the key order.
_PIECE = 5


def _shared_prefix(low: Column, high: Column) -> Column:
    """How many leading characters two strings have in common: with the least and the greatest, all in between do."""
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(low), F.length(high))))
    return F.size(F.filter(places, lambda i: (F.length(low) >= i) & (F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i))))


def tile_ends(frame: DataFrame, tiles: int, value: str, key: str) -> DataFrame:
    """One row with `ends`: the last (value, key) of each tile but the last, as ntile over (value, key) has them.

    Found from counts, without sorting the rows: distinct values are counted and summed up in bins that keep their order
    (256 to each power of two, so a bin's values are bounded by their precision, not by the rows). Only inside the values
    that a tile ends in, one per end at most, keys matter: these rows are counted by the next characters of their keys,
    and only the pieces that hold an end are ranked. The values are not null; a null key counts as empty.
    """
    rows = frame.select(F.col(value).alias("value"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"))
    double = F.col("value").cast("double")
    counts = rows.groupBy("value").agg(F.count("*").alias("n")).withColumn("bin", (F.signum(double) * F.floor(F.log2(F.abs(double) + 1) * 256)).cast("long"))
    earlier = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = counts.groupBy("bin").agg(F.sum("n").alias("_n")).select("bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(bins, "bin")
    total = counts.agg(F.sum("n")).scalar()
    before, upto = F.col("_before") + F.col("_inside"), F.col("_before") + F.col("_inside") + F.col("n")
    ends = F.transform(F.sequence(F.lit(1), F.lit(tiles - 1)), lambda j: j * F.floor(F.col("total") / tiles) + F.least(j, F.col("total") % tiles))
    # At most tiles - 1 rows, here and below.
    ended = placed.withColumn("total", total).select("value", before.alias("before"), F.explode(F.filter(ends, lambda e: (e > before) & (e <= upto))).alias("end"))
    ended = ended.select("value", "end", (F.col("end") - F.col("before")).alias("at"))
    prefix = rows.agg(_shared_prefix(F.min("key"), F.max("key"))).scalar()
    held = rows.join(F.broadcast(ended.select("value").distinct()), "value").withColumn("piece", F.substring("key", prefix + 1, F.lit(_PIECE)))
    sooner = Window.partitionBy("value").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = held.groupBy("value", "piece").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(sooner), F.lit(0)))
    within = pieces.join(F.broadcast(ended), "value").filter("at > before AND at <= before + n").select("value", "piece", "end", (F.col("at") - F.col("before")).alias("at"))
    ranked = held.join(F.broadcast(within.select("value", "piece").distinct()), ["value", "piece"])
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("value", "piece").orderBy("key")))
    last = ranked.join(F.broadcast(within), ["value", "piece"]).filter("rank = at")
    return last.agg(F.array_agg(F.struct("value", "key")).alias("ends"))


def in_tile(frame: DataFrame, ends: Column, value: str, key: str, name: str) -> DataFrame:
    """Adds the tile of each row, given the `ends` of the tiles: one more than the number of tiles that end before it.

    Rows equal in value and key are in the same tile.
    """
    own = F.coalesce(F.col(key).cast("string"), F.lit(""))
    passed = F.filter(F.col("_ends"), lambda e: (F.col(value) > e["value"]) | ((F.col(value) == e["value"]) & (own > e["key"])))
    return frame.withColumn("_ends", ends).withColumn(name, (F.size(passed) + 1).cast("int")).drop("_ends")


def previous_in_group(frame: DataFrame, group: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """`lag(column)` within each group, for groups too large for one task.

    Rows are numbered in (group, order) and joined with the row before, so a group may span any
    number of partitions. `order` has to be total within a group.
    """
    numbered = global_row_number(frame, [*group, *order], "_row")
    before = numbered.select(
        (F.col("_row") + 1).alias("_next"),
        *[F.col(g).alias(f"_before_{g}") for g in group],
        F.col(column).alias(name),
    )
    follows = F.col("_row") == F.col("_next")
    for g in group:
        follows = follows & F.col(g).eqNullSafe(F.col(f"_before_{g}"))
    return numbered.join(before, follows, "left").drop("_row", "_next", *[f"_before_{g}" for g in group])


def previous_by_piece(frame: DataFrame, group: str, piece: str, order: list[str], column: str, name: str) -> DataFrame:
    """`lag(column)` within each group, for groups too large for one task, in one pass.

    `piece` ascends with `order` (a day, if rows are ordered by a moment) and cuts a group into parts that fit a task. The
    first row of a piece takes the last value of the piece before, carried over in one row per piece. `order` has to be
    total within a group. A null group or piece is one like any other; null pieces come first.
    """
    last = F.max_by(F.struct(F.col(column).alias("v")), F.struct(*order))
    carried = frame.groupBy(F.col(group).alias("_group"), F.col(piece).alias("_piece")).agg(last.alias("_last"))
    earlier = Window.partitionBy("_group").orderBy(F.asc_nulls_first("_piece"))
    carried = carried.select("_group", "_piece", F.lag("_last").over(earlier)["v"].alias("_carried"))
    inside = Window.partitionBy(group, piece).orderBy(*order)
    placed = frame.withColumns({"_before": F.lag(column).over(inside), "_place": F.row_number().over(inside)})
    here = F.col(group).eqNullSafe(F.col("_group")) & F.col(piece).eqNullSafe(F.col("_piece")) & (F.col("_place") == 1)
    joined = placed.join(carried, here, "left")
    return joined.withColumn(name, F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_before"))).drop("_before", "_place", "_group", "_piece", "_carried")
