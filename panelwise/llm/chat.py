"""Chat formatting: every assistant turn becomes an example with all earlier turns as its context.

A turn is ``<s>[INST]role[/INST]text</s>``. Backslashes inside roles and texts are doubled and a
backslash is put into any of the four control strings, so no text can end a turn and every turn
can be read back. Only built-in functions are used.

Turns of a conversation are ordered by turn, then role and text; null roles and texts are empty,
a null conversation id is a conversation of its own, repeated rows are turns like others. A last
row without a target holds what follows the last assistant turn, so nothing of the input is lost;
conversations without an assistant have only that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Control strings and their escaped forms.
CONTROL = (("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]"))
OPEN, SPLIT, CLOSE = "<s>[INST]", "[/INST]", "</s>"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, safe in CONTROL:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in CONTROL:
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", reply: str = "assistant") -> DataFrame:
    """conv_id, example (from 0), context, target, n_turns (with the target's); target is null in a last, untrained row.

    ``context || target || '</s>'`` is what a model reads and only ``target`` is trained on. One
    shuffle by conversation; the running lengths come from a window over it, so a conversation of
    many turns costs its output and no more.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    by = F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"),
        F.concat(F.lit(OPEN), escaped(by), F.lit(SPLIT)).alias("head"), escaped(said).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    total = F.sum(F.length("head") + F.length("body") + len(CLOSE)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumns({"n": F.row_number().over(order), "stop": total})
    whole = (
        numbered.select("conv_id", "n", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.when(F.col("role") == reply, F.struct("n", (F.col("stop") - len(CLOSE) - F.length("body")).alias("start"), F.length("body").alias("size"))).alias("reply"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "piece"))).alias("pieces"), F.sort_array(F.collect_list("reply")).alias("replies"), F.max("n").alias("turns"))
        .withColumn("formatted", F.array_join(F.col("pieces.piece"), ""))
    )
    tail = F.struct(F.col("turns").alias("n"), F.length("formatted").cast("bigint").alias("start"), F.lit(None).cast("int").alias("size"))
    last = F.get(F.col("replies"), F.size("replies") - 1)["n"]
    spans = F.when(F.coalesce(last, F.lit(0)) < F.col("turns"), F.concat("replies", F.array(tail))).otherwise(F.col("replies"))
    start, size = F.col("span.start").cast("int"), F.col("span.size")
    return whole.select("conv_id", "formatted", F.posexplode(spans).alias("example", "span")).select(
        "conv_id",
        F.col("example").cast("bigint").alias("example"),
        F.substring("formatted", F.lit(1), start).alias("context"),
        F.when(size.isNotNull(), F.substring("formatted", start + 1, size)).alias("target"),
        F.col("span.n").cast("bigint").alias("n_turns"),
    )


def digest(made: DataFrame) -> DataFrame:
    """What the examples of each conversation say, read back from their text."""
    text = F.concat("context", F.coalesce(F.concat("target", F.lit(CLOSE)), F.lit("")))
    whole = made.groupBy("conv_id").agg(
        F.max_by(text, "example").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", "target")))).alias("targets"),
    )
    # The last turn ends with the marker too, so the last of the parts is empty.
    parts = F.filter(F.split("formatted", CLOSE, -1), lambda p: p.startswith(OPEN))
    read = F.transform(
        parts,
        lambda p: F.concat(
            unescaped(F.substring_index(F.replace(p, F.lit(OPEN), F.lit("")), SPLIT, 1)),
            F.lit("\n"),
            unescaped(F.substring_index(p, SPLIT, -1)),
            F.lit("\n"),
        ),
    )
    loss = F.array_join(F.transform(F.col("targets.target"), unescaped), "")
    return whole.select(
        "conv_id",
        F.size(parts).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(read, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
