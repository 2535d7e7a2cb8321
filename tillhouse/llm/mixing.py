"""Mixing sources to target weights by a low-discrepancy schedule.

The order of training is a sequence of 2^m slots. Slot i stands at the van der Corput point of i (the bits of i
reversed), and the sources' slot counts, laid end to end, are the cumulative weights those points are mapped through: a
source owns an interval of points and so exactly its count of slots, spread evenly over the sequence. A source's slots
are ranked in sequence order, and rank r takes block r of the source's own stream, going round once the stream ends.
The stream is the source's documents in the order of the MD5 of their ids, cut into blocks of `block_words` words (the
last is shorter); the last slot takes only what the target leaves.

Sizes are words. Sources in code-point order (null last) weigh 5, 2, 1 repeating and share 150 % of all words; a target
stops at twice its source's size and the excess goes to the others by weight until none is above.

Null texts have no words, a null id counts as empty in the order, null is a source like any other. Repeated rows are
documents of their own. With no words at all every target is 0. Only doc_id, text and source are read by `mix`; `mixed`
passes every column on. No rows give no rows.

Sums over a source are taken in 4096 pieces of the MD5's first three digits, so one source may hold any share of the
rows; slots are generated and ranked in pieces of 2^20.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.columns import word_count, words
from tillhouse.operators.ranking import global_row_number
from tillhouse.session import shared_folder

#: Weights of the sources in order.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 4096
PIECE_BITS = 20
_SOURCE = ["s_null", "s"]


@dataclass
class Mix:
    """documents: one row per document with its target and the words taken; slots: the schedule."""

    documents: DataFrame
    slots: DataFrame


def _running(frame: DataFrame, piece: str, amount: str, order: list[Column | str], name: str) -> DataFrame:
    """The sum of `amount` over a source's earlier rows, piece by piece. Pieces follow the order."""
    before = Window.partitionBy(*_SOURCE).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frame.groupBy(*_SOURCE, piece)
        .agg(F.sum(amount).alias("_sum"))
        .select(*_SOURCE, piece, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*_SOURCE, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = frame.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(offsets, [*_SOURCE, piece]).withColumn(name, F.col("_offset") + F.col("_inside")).drop("_offset", "_inside")


def targets(per_source: DataFrame) -> DataFrame:
    """Adds `weight` and `target` to (s_null, s, source_size)."""
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("_row") - 1) % len(WEIGHTS) + 1).cast("int"))
    weighed = global_row_number(per_source, list(_SOURCE), "_row").withColumn("weight", weight).drop("_row").checkpoint()
    total, free = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    capped, level, full = 0, SHARE * total / free if free else 0.0, -1
    while True:
        below = CAP * F.col("source_size") < F.lit(level) * F.col("weight")
        now, capped, free = weighed.agg(
            F.count(F.when(below, 1)),
            F.coalesce(F.sum(F.when(below, CAP * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~below, F.col("weight"))), F.lit(0)),
        ).first()
        if now == full or not free:
            break
        full, level = now, (SHARE * total - capped) / free
    return weighed.withColumn(
        "target", F.least(CAP * F.col("source_size").cast("double"), F.lit(level) * F.col("weight"))
    )


def _slots(plan: DataFrame, block_words: int) -> DataFrame:
    """The schedule: place in the sequence, source, rank, epoch, block, words taken of that block."""
    rest = F.col("wanted") % F.greatest("source_size", F.lit(1))
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
    counted = plan.filter("wanted > 0").select(
        *_SOURCE,
        "source_size",
        "wanted",
        blocks.alias("blocks"),
        (F.floor(F.col("wanted") / F.col("source_size")) * blocks + F.ceil(rest / F.lit(block_words))).cast("long").alias("n_slots"),
    )
    counted = _lay_out(counted)
    all_slots = counted.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    bits = max(1, (max(all_slots, 1) - 1).bit_length())
    piece = 1 << PIECE_BITS
    point = F.col("first") + F.col("_piece") * piece + F.col("_k")
    place = F.expr(f"conv(reverse(lpad(bin(_point), {bits}, '0')), 2, 10)").cast("long")
    slots = (
        counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / piece).cast("long"))))
        .repartition(F.col("_piece"), *_SOURCE)
        .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(piece - 1), F.col("n_slots") - 1 - F.col("_piece") * piece))))
        .withColumn("_point", point)
        .select(*_SOURCE, "source_size", "wanted", "blocks", place.alias("place"))
        .withColumns({"_part": F.shiftright("place", PIECE_BITS), "_one": F.lit(1)})
    )
    ranked = _running(slots, "_part", "_one", ["place"], "rank")
    epoch = F.floor(F.col("rank") / F.col("blocks"))
    start = F.col("block") * block_words
    left = F.col("wanted") - F.col("epoch") * F.col("source_size") - start
    return ranked.select(*_SOURCE, "source_size", "wanted", "place", "rank", epoch.alias("epoch"), (F.col("rank") % F.col("blocks")).alias("block")).withColumn(
        "take", F.least(F.lit(block_words), F.col("source_size") - start, left)
    )


def _lay_out(counted: DataFrame) -> DataFrame:
    """Each source's first point. Sources are ordered by name; sums run over pieces of the order."""
    ranked = global_row_number(counted, list(_SOURCE), "_row").withColumn("_piece_no", F.floor(F.col("_row") / 100_000)).checkpoint()
    # One row per 100,000 sources.
    earlier = Window.orderBy("_piece_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.groupBy("_piece_no").agg(F.sum("n_slots").alias("_sum")).select("_piece_no", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_piece_no").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.withColumn("_inside", F.coalesce(F.sum("n_slots").over(inside), F.lit(0)))
        .join(offsets, "_piece_no")
        .withColumn("first", F.col("_offset") + F.col("_inside"))
        .drop("_row", "_piece_no", "_offset", "_inside")
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, keys: tuple[str, ...] = ()) -> Mix:
    """`keys`: columns that are passed on to `documents` and order rows of equal id and size."""
    shared_folder(docs.sparkSession)
    rows = (
        docs.select(
            "doc_id",
            F.col("source").isNull().alias("s_null"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("s"),
            word_count(F.col("text")).alias("size"),
            *keys,
        )
        .withColumn("_md5", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .withColumn("_piece", F.substring("_md5", 1, 3))
        .checkpoint()
    )
    plan = targets(rows.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))).withColumn("wanted", F.floor("target").cast("long"))
    plan = plan.checkpoint()
    slots = _slots(plan, block_words)
    # A block is taken whole in some rounds and in part in at most one.
    whole = F.col("take") == F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words)
    takes = slots.groupBy(*_SOURCE, "block").agg(
        F.count(F.when(whole, 1)).alias("rounds"), F.coalesce(F.max(F.when(~whole, F.col("take"))), F.lit(0)).alias("part")
    )
    placed = _running(rows, "_piece", "size", ["_md5", "doc_id", "size", *keys], "start")
    start, end = F.greatest("start", F.col("block") * block_words), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    part_end = F.least("end_in", F.col("block") * block_words + F.col("part"))
    taken = (
        placed.filter("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))))
        .withColumns({"start_in": start, "end_in": end})
        .join(takes, [*_SOURCE, "block"])
        .groupBy(*_SOURCE, "start")
        .agg(F.sum(F.col("rounds") * (F.col("end_in") - F.col("start_in")) + F.greatest(F.lit(0), part_end - F.col("start_in"))).alias("_taken"))
    )
    # Documents without words share their start with the next one and take nothing.
    found = placed.join(taken, [*_SOURCE, "start"], "left").join(plan.select(*_SOURCE, "source_size", "target"), _SOURCE)
    documents = found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.coalesce("_taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        F.when(F.col("s_null"), F.lit(None)).otherwise(F.col("s")).alias("source"),
        *keys,
    )
    return Mix(documents, slots)


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of the mix: a document once for each time it is taken whole, and its first words where it is taken in part.

    `n_chars` is set for cut texts. Every row has its own count, also rows with a null id or with one that others share.
    """
    # The input's own columns stay in one struct, whatever their names. Rows and their keys are written once, so that the
    # counts and the rows they are joined to come from the same numbering.
    path = f"{shared_folder(docs.sparkSession)}/mix-{uuid.uuid4().hex}"
    named = docs.select(F.struct("*").alias("row")).withColumns({"_hash": F.xxhash64("row.text"), "_row": F.monotonically_increasing_id()})
    named.write.parquet(path)
    named = docs.sparkSession.read.schema(named.schema).parquet(path)
    sized = named.select("row.doc_id", "row.text", "row.source", "_hash", "_row")
    counts = mix(sized, block_words, ("_hash", "_row")).documents.filter("taken > 0").select("_row", "taken", "size")
    rows = named.select("row", "_row").join(counts, "_row")
    rows = rows.withColumn("round", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
    left = F.col("taken") - (F.col("round") - 1) * F.col("size")
    text = F.when(left < F.col("size"), F.concat_ws(" ", F.slice(words(F.col("row.text")), F.lit(1), left.cast("int")))).otherwise(F.col("row.text"))
    rows = rows.select("row", text.alias("text"), (left < F.col("size")).alias("cut"))
    new = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.when(F.col("cut"), F.length("text").cast("long")).otherwise(F.col("row.n_chars")))
    return rows.select(new.alias("row")).select("row.*")
