"""Chat formatting by prefix-target expansion (column expressions).

Every assistant turn becomes an example of its own: all preceding turns as context, then this reply, which alone is
trainable. ``loss_start`` and ``loss_end`` (characters of ``formatted``) mark it. Turns after the last reply would be in
no example; they end a last one without a target (``target`` null, an empty mask), so that the output holds every turn.

A turn reads ``### Role: text</turn>`` and a line end. Inside roles and texts the backslash is doubled, ``</turn>``
becomes ``\\l/turn>``, of three number signs in a row the first becomes ``\\h``; in roles also ``:`` becomes ``\\c``. So
control strings occur nowhere but in the template, and `read_back` restores the turns exactly.

Defined cases: a null text or role is an empty one; turns are ordered by number (null first), then role, then text, so
repeated and tied turns all stay, in a fixed order; a null conversation id is one conversation; an empty table gives an
empty result. A conversation is the unit of the method (its last example holds all of it) and is put together in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINABLE = "assistant"
END = "</turn>"


def _escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit(END), F.lit("\\l/turn>"))
    out = F.regexp_replace(out, "#(?=##)", r"\\h")
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def _unescape(text: Column) -> Column:
    """Doubled backslashes separate parts in which each escape stands for itself alone."""
    plain = lambda p: F.replace(F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#")), F.lit("\\c"), F.lit(":"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def expand(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 0), target (number of the reply among the turns, from 0), formatted, loss_start, loss_end, last."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    segment = lambda t: F.concat(F.lit("### "), _escape(t["role"], True), F.lit(": "), _escape(t["text"]), F.lit(END + "\n"))
    numbered = F.transform("turns", lambda t, i: F.struct(i.alias("i"), (t["role"] == TRAINABLE).alias("reply")))
    targets = F.transform(F.filter(numbered, lambda t: t["reply"] | (t["i"] == F.size("turns") - 1)), lambda t: t)
    made = whole.select("conv_id", F.transform("turns", segment).alias("segments"), targets.alias("targets"), F.size("turns").alias("n"))
    made = made.select("conv_id", "segments", "n", F.posexplode("targets").alias("example", "target"))
    text = F.array_join(F.slice("segments", 1, F.col("target.i") + 1), "")
    stop = F.length("formatted") - len(END + "\n")
    # The reply begins where its segment does, after "### assistant: ".
    begin = F.length("formatted") - F.length(F.col("segment")) + len(f"### {TRAINABLE}: ")
    made = made.select(
        "conv_id", "example", F.when(F.col("target.reply"), F.col("target.i")).alias("target"), text.alias("formatted"),
        F.element_at("segments", F.col("target.i") + 1).alias("segment"), (F.col("target.i") == F.col("n") - 1).alias("last"),
    )
    return made.select(
        "conv_id", "example", "target", "formatted", F.when(F.col("target").isNull(), stop).otherwise(begin).alias("loss_start"),
        stop.alias("loss_end"), "last",
    )


def loss_text() -> Column:
    """What the mask of an example covers, as it was before escaping."""
    return _unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    parts = F.split(formatted, END + "\n")  # what follows the last end is empty
    marked = F.slice(parts, 1, F.size(parts) - 1)
    at = lambda s: F.instr(s, ": ")
    return F.transform(marked, lambda s: F.struct(
        _unescape(F.substr(s, F.lit(5), at(s) - 5)).alias("role"), _unescape(F.substr(s, at(s) + 2)).alias("text")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted texts alone: counts and digests of its turns and of all text under the mask."""
    turns = read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns_", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = examples.withColumn("turns_", F.when(F.col("last"), turns)).select(
        "conv_id", "example", F.size("turns_").cast("long").alias("n"), F.sha2(said, 256).alias("digest"), "last",
        loss_text().alias("loss"), F.length("formatted").cast("long").alias("chars"),
    )
    whole = rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("n"))).alias("n_turns"), F.max(F.when(F.col("last"), F.col("digest"))).alias("turns_sha256"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"), F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return whole.select(
        "conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars", "n_examples",
    )
