"""Multi-party perspective rotation of dialogues, in DataFrame functions.

For every participant of a conversation the whole dialogue is rendered with
that speaker as the assistant and the others as named users, with the spans
to learn from. A dialogue comes in pieces of ``turns`` turns, in order, so
that one conversation may hold any share of all rows: its place in the
dialogue reaches a turn by a range-partitioned sort and the counts of each
partition, not by gathering the conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

END = "<|end|>"


def positions(turns: DataFrame) -> DataFrame:
    """conv, turn, role, text and ``pos``, the turn's place from 0 in its
    conversation, by (turn, role, SHA-256 of the text)."""
    key = ["conv", "turn", "role", "sha"]
    laid = store(turns.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
                 .repartitionByRange(*key).sortWithinPartitions(*key)
                 .select("conv", "role", "text", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("row")), "turns")
    parts = store(laid.groupBy("conv", "pid").agg(F.min("row").alias("first"), F.count("*").alias("n"))
                  .withColumn("before", F.coalesce(F.sum("n").over(
                      Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                  .select(F.col("conv").alias("p_conv"), F.col("pid").alias("p_pid"), "first", "before"), "turn-parts")
    return laid.join(parts, (F.col("pid") == F.col("p_pid")) & F.col("conv").eqNullSafe(F.col("p_conv"))).select(
        "conv", "role", "text", (F.col("before") + F.col("row") - F.col("first")).alias("pos"))


def rotate(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", turns: int = 64) -> DataFrame:
    """One row per conversation, participant and piece of ``turns`` turns:
    ``conv_col``, speaker, piece int from 0, n_turns, rendered, mask
    (``start:length`` of each span to learn from, in characters of the piece,
    comma-separated: the speaker's text and its end mark), n_masked.

    Joined in order of piece, ``rendered`` is the dialogue. Every role is a
    participant, ``system`` too; filter the rows (or the result by speaker) to
    learn from some only. Texts are rendered as they are: one that holds a
    marker (``<|end|>``, ``<|assistant|>``) looks like a turn, and only ``mask``
    says what was said by whom. Null text is
    empty, a null role is the participant ``unknown``, null turns come first,
    null conversation ids are one conversation. Turns with equal numbers are
    ordered by role, then by the SHA-256 of the text; repeated rows are kept.
    An empty table gives an empty result; other columns are ignored.
    """
    said = conversations.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    placed = positions(said)
    people = store(placed.select(F.col("conv").alias("w_conv"), F.col("role").alias("speaker")).distinct(), "speakers")
    pieces = placed.groupBy("conv", F.floor(F.col("pos") / turns).cast("int").alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("said"))
    pieces = store(pieces, "pieces")
    seen = pieces.join(people, F.col("conv").eqNullSafe(F.col("w_conv")))
    mine = lambda t: t["role"] == F.col("speaker")
    head = lambda t: F.when(mine(t), F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user:"), t["role"], F.lit("|>\n")))
    shown = F.transform("said", lambda t: F.concat(head(t), t["text"], F.lit(f"{END}\n")))
    # where each turn's text begins: lengths of all before it, and of its own head
    spans = F.aggregate(
        "said", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).alias("masked")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(head(t)) + F.length(t["text"]) + len(END) + 1).alias("at"),
            F.when(mine(t), F.concat(acc["spans"], F.array(F.concat_ws(
                ":", (acc["at"] + F.length(head(t))).cast("string"), (F.length(t["text"]) + len(END)).cast("string"))))).otherwise(acc["spans"]).alias("spans"),
            F.when(mine(t), acc["masked"] + F.length(t["text"]) + len(END)).otherwise(acc["masked"]).alias("masked")))
    return seen.select(F.col("conv").alias(conv_col), "speaker", "piece", F.size("said").alias("n_turns"),
                       F.concat_ws("", shown).alias("rendered"), spans.alias("s")).select(
        conv_col, "speaker", "piece", "n_turns", "rendered", F.concat_ws(",", "s.spans").alias("mask"), F.col("s.masked").alias("n_masked"))
