"""Preference formatting: chosen and rejected conversations as one prompt and two masked
completions, with DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers of a rendered turn.
START, STOP = "<|im_start|>", "<|im_end|>"

_SEGMENTS = "array<struct<text:string,trained:boolean>>"


def _turns(side: str) -> Column:
    """The turns of one side in order, as structs of role and text."""
    held = F.when(
        F.col("__side") == side, F.struct("__turn", F.struct("__role", "__text").alias("said"))
    )
    # A list of nulls only where the side has no turn is empty, as nulls are not collected.
    return F.transform(F.sort_array(F.collect_list(held)), lambda turn: turn["said"]).alias(side)


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(turn["__role"], F.lit("user")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["__text"], F.lit("")), F.lit(f"{STOP}\n"))


def _segments(turns: Column, trained_role: str) -> Column:
    """Two segments per turn: its head, never trained, and its text with the end marker."""
    pairs = F.transform(
        turns,
        lambda turn: F.array(
            F.struct(_head(turn).alias("text"), F.lit(False).alias("trained")),
            F.struct(
                _body(turn).alias("text"),
                F.coalesce(turn["__role"] == trained_role, F.lit(False)).alias("trained"),
            ),
        ),
    )
    return F.flatten(pairs).cast(_SEGMENTS)


def format_preferences(
    chosen: DataFrame,
    rejected: DataFrame,
    pair: str = "pair_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per pair: ``pair, n_prompt_turns, prompt, chosen, rejected``.

    Both inputs hold one row per turn. The longest common prefix of turns (equal role and text,
    nulls equal to nulls) is rendered once, as ``prompt``; what is left of either conversation is a
    list of segments ``text, trained``, whose texts joined are the completion and of which only
    the turns of ``trained_role`` are trained on.

    Turns are in order of ``turn`` (null first), equal numbers by role and text; gaps do not
    matter. A null role is rendered as user and never trained, a null text as nothing. A pair of
    equal conversations has empty completions, a pair that one side lacks has no prompt and an empty
    completion on that side, and rows with a null pair are one pair. Repeated rows are repeated
    turns. Other columns are not read; empty inputs give an empty result.

    One shuffle by pair, of lists that are gathered on the map side first. A conversation is one
    example and becomes one row, so it has to fit into one.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col(pair).alias("__pair"),
            F.lit(name).alias("__side"),
            F.col(turn).alias("__turn"),
            F.col(role).alias("__role"),
            F.col(text).alias("__text"),
        )

    gathered = (
        side(chosen, "chosen")
        .unionByName(side(rejected, "rejected"))
        .groupBy("__pair")
        .agg(_turns("chosen"), _turns("rejected"))
    )
    # The shorter list is filled up with nulls, which equal no turn.
    differs = F.array_position(
        F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b)), F.lit(False)
    )
    common = F.when(differs > 0, differs - 1).otherwise(F.size("chosen")).cast("int")

    def rest(name: str) -> Column:
        return _segments(F.slice(name, F.col("__n") + 1, F.size(name) - F.col("__n")), trained_role)

    prompt = F.transform(
        F.slice("chosen", 1, F.col("__n")), lambda turn: F.concat(_head(turn), _body(turn))
    )
    return gathered.withColumn("__n", common).select(
        F.col("__pair").alias(pair),
        F.col("__n").alias("n_prompt_turns"),
        F.array_join(prompt, "").alias("prompt"),
        rest("chosen").alias("chosen"),
        rest("rejected").alias("rejected"),
    )


def completion(segments: Column) -> Column:
    """The text of a list of segments."""
    return F.array_join(F.transform(segments, lambda part: part["text"]), "")


def mask(segments: Column) -> Column:
    """Lengths of the segments in characters, with + where they are trained on, - elsewhere."""
    return F.array_join(
        F.transform(
            segments,
            lambda part: F.concat(
                F.length(part["text"]).cast("string"), F.when(part["trained"], "+").otherwise("-")
            ),
        ),
        " ",
    )


def swapped_answers(conversations: DataFrame, answering: str = "assistant") -> DataFrame:
    """Rejected conversations: each one with its last answer replaced by the last answer of the
    conversation whose id differs in the lowest bit, and nothing after that.

    Where that one has no answer the conversation just ends before its own; a conversation without
    answers is left as it is. Gives ``conv_id, turn, role, text``.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    last = (
        turns.where(F.col("role") == answering)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
    )
    before = (
        turns.join(last, "conv_id", "left")
        .where(F.col("last").isNull() | (F.col("turn") < F.col("last.turn")))
        .drop("last")
    )
    other = last.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("text")
    )
    answers = last.join(other, "conv_id").select(
        "conv_id", F.col("last.turn").alias("turn"), F.lit(answering).alias("role"), "text"
    )
    return before.unionByName(answers)
