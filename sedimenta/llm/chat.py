"""Chat formatting by prefix-target expansion, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# This template's marks.
TURN, END, NEWLINE = "<|turn|>", "<|end|>", "<|nl|>"
ASSISTANT = "assistant"

# Control strings of this template and of common ones, as first character, any
# number of backslashes, rest.  Escaping adds a backslash after the first
# character and unescaping takes one away, so texts that look escaped already
# survive as well.
_REST = r"\|(?:turn|end|nl|im_start|im_end|endoftext|system|user|assistant)\|>|/?s>|/?INST\]|</?SYS>>"
_PLAIN = rf"([<\[])(\\*)({_REST})"
_ESCAPED = rf"([<\[])\\(\\*)({_REST})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_PLAIN), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def _role_out(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(NEWLINE))


def _role_back(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """One training example per assistant turn: all turns before it as context,
    and only that reply trainable.

    Returns ``conv_id``, ``example`` (from 1), ``is_last``, ``formatted``,
    ``loss_start`` and ``loss_length``: the mask in characters of ``formatted``
    (from 0), over the reply without its marks.  A conversation that does not end
    in a reply gets one more example, of all its turns, with nothing trainable,
    so the output holds every turn.  Turns go by ``turn``, NULL first; ties by
    role, then text.  NULL roles and texts count as empty; NULL ``conv_id`` is one
    conversation.  Only the four columns are read.

    A conversation is the unit of output and is gathered by its key; examples are
    streamed out one at a time, so a task holds one conversation, never its
    expansion.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    gathered = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = F.transform(
        "turns", lambda t: F.concat(F.lit(TURN), _role_out(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(END))
    )
    replies = F.filter(
        F.sequence(F.lit(1), F.size("turns")), lambda i: F.get(F.col("turns"), i - 1)["role"] == ASSISTANT
    )
    ends = F.when(F.element_at("turns", -1)["role"] == ASSISTANT, replies).otherwise(
        F.concat(replies, F.array(F.size("turns") + 1))
    )
    per_reply = gathered.select(
        "conv_id",
        written.alias("written"),
        F.size("turns").alias("n"),
        F.transform("turns", lambda t: F.length(escaped(t["text"]))).alias("lengths"),
        ends.alias("ends"),
    ).select("conv_id", "written", "n", "lengths", F.size("ends").alias("examples"), F.posexplode("ends").alias("at", "upto"))
    has_target = F.col("upto") <= F.col("n")
    context = F.array_join(F.slice("written", F.lit(1), F.col("upto") - 1), "")
    opening = len(TURN) + len(ASSISTANT) + 1
    return per_reply.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        (F.col("at") + 1 == F.col("examples")).alias("is_last"),
        context.alias("context"),
        F.when(has_target, F.element_at("written", F.col("upto"))).otherwise(F.lit("")).alias("target"),
        F.when(has_target, F.get("lengths", F.col("upto") - 1)).otherwise(F.lit(0)).alias("loss_length"),
    ).select(
        "conv_id",
        "example",
        "is_last",
        F.concat("context", "target").alias("formatted"),
        (F.length("context") + F.when(F.col("target") != "", F.lit(opening)).otherwise(F.lit(0))).alias("loss_start"),
        "loss_length",
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted example, unescaped."""
    split = F.split(formatted, r"<\|turn\|>")
    pieces = F.slice(split, F.lit(2), F.size(split) - 1)
    body = F.transform(pieces, lambda p: p.substr(F.lit(1), F.length(p) - len(END)))

    def parsed(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        return F.struct(
            _role_back(role).alias("role"),
            unescaped(piece.substr(F.length(role) + 2, F.length(piece))).alias("text"),
        )

    return F.transform(body, parsed)


def chat_digest(examples: DataFrame) -> DataFrame:
    """What can be read back from the examples, one row per conversation.

    ``loss_chars`` and ``loss_sha256`` cover the masked text of all examples in
    order; the turns come from the last example.
    """
    masked = unescaped(F.col("formatted").substr(F.col("loss_start") + 1, F.col("loss_length")))
    lean = examples.select(
        "conv_id",
        F.struct("example", masked.alias("loss")).alias("part"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("is_last"), F.col("formatted")).alias("whole"),
    )
    gathered = lean.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
        F.max("whole").alias("whole"),
    )
    turns = gathered.withColumn("turns", read_turns(F.col("whole")))
    digest = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
