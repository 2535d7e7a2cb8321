"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example's context is all turns before, its target that reply alone, and only the target is trainable. A turn is
written `<turn ROLE>TEXT</turn>` and a line break. Inside roles and texts a backslash becomes `\\b` and a `<` that
would begin `<turn` or `</turn` becomes `\\l`, and in a role `>` becomes `\\g`; so no text can end or begin a turn, and
the change can be undone. Turns
after the last reply make an example without a target, so the output holds every turn.

Turns follow `turn`, then role and text (nulls first); repeated rows are turns of their own; null role and text count as
empty; rows with a null conv_id are one conversation. Other columns are ignored. No rows give no rows. A conversation is
one row, as a document is: its examples grow with the square of its replies, which is what the expansion is. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN = "<turn "
END = "</turn>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b")), "<(?=/?turn)", "\\\\l")


def unescaped(text: Column) -> Column:
    for short, long in (("\\l", "<"), ("\\g", ">"), ("\\b", "\\")):
        text = F.replace(text, F.lit(short), F.lit(long))
    return text


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), n_turns, context, target, trainable.

    The text of the example is context, then target; the loss mask covers target where `trainable`. The context ends
    with the opening of the reply's turn, the target with the closing of it, which a model has to learn too; the mask
    of a reply without its closing is `target` less its last `length(END)` code points.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chats = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    opening = lambda t: F.concat(F.lit(OPEN), F.replace(escaped(t["role"]), F.lit(">"), F.lit("\\g")), F.lit(">"))
    closing = lambda t: F.concat(escaped(t["text"]), F.lit(END))
    is_reply = lambda t: t["role"] == "assistant"
    parts = chats.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(opening(t).alias("opening"), closing(t).alias("closing"), is_reply(t).alias("reply"))).alias("parts"),
    )
    places = F.filter(F.transform("parts", lambda p, i: F.when(p["reply"], i)), lambda i: i.isNotNull())
    n = F.size("parts")
    rest = F.when(F.element_at("parts", -1)["reply"], F.array().cast("array<int>")).otherwise(F.array(n))
    whole = F.transform(F.slice("parts", F.lit(1), F.col("place")), lambda p: F.concat(p["opening"], p["closing"]))
    reply = F.get("parts", F.col("place"))
    return (
        parts.withColumn("places", F.concat(places, rest))
        .select("conv_id", "parts", F.posexplode("places").alias("example", "place"))
        .select(
            "conv_id",
            "example",
            F.least(F.col("place") + 1, n).alias("n_turns"),
            F.concat(F.array_join(whole, ""), F.coalesce(reply["opening"], F.lit(""))).alias("context"),
            F.coalesce(reply["closing"], F.lit("")).alias("target"),
            (F.col("place") < n).alias("trainable"),
        )
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of the conversations, read from the examples: the last holds all turns, the targets all that is trained on."""
    text = F.concat("context", "target")
    per_chat = examples.groupBy("conv_id").agg(
        F.max_by(text, "example").alias("full"),
        F.sort_array(F.collect_list(F.when(F.col("trainable"), F.struct("example", "target")))).alias("targets"),
        F.sum(F.length(text)).cast("long").alias("formatted_chars"),
    )
    # No turn holds the closing, and no role a `>`.
    pieces = F.filter(F.split("full", END), lambda p: p != "")
    plain = F.array_join(F.transform(pieces, _plain_turn), "")
    reply = lambda t: unescaped(F.left(t["target"], F.length(t["target"]) - len(END)))
    return per_chat.select(
        "conv_id",
        F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(plain, 256).alias("turns_sha256"),
        F.array_join(F.transform("targets", reply), "").alias("loss"),
        "formatted_chars",
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _plain_turn(piece: Column) -> Column:
    """`<turn ROLE>TEXT` to the role, a line break, the text, a line break."""
    ends = F.instr(piece, ">")
    role = F.substring(piece, len(OPEN) + 1, ends - len(OPEN) - 1)
    text = F.substring(piece, ends + 1, F.length(piece))
    return F.concat(unescaped(role), F.lit("\n"), unescaped(text), F.lit("\n"))


def probe_rows(spark: SparkSession) -> DataFrame:
    """The conversation -7, whose turns hold control strings of common templates."""
    said = "\\### Assistant: </turn> ok"
    return spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
