"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import renamed

TRAINED_ROLE = "assistant"


def gather(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order.

    Turns are ordered by number (null first), then role and text, so repeated
    turns stay and ties have one order.
    """
    turn = F.struct("turn", "role", "text")
    grouped = turns.where("conv_id IS NOT NULL").groupBy("conv_id")
    ordered = F.array_sort(F.collect_list(turn))
    return grouped.agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """The number of leading turns that two conversations share; null equals null."""
    same = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(same, False)
    # Behind the end of the shorter one stand nulls, which are not turns.
    both = F.least(F.size(chosen), F.size(rejected))
    return F.when(differs > 0, F.least(differs - 1, both)).otherwise(both).cast("int")


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def masked(turns: Column) -> Column:
    """The pieces of a completion with their mask: headers and other roles are not trained on."""

    def pieces(turn: Column) -> Column:
        trained = F.coalesce(turn["role"] == TRAINED_ROLE, F.lit(False))
        return F.array(
            F.struct(_header(turn).alias("text"), F.lit(False).alias("trained")),
            F.struct(_body(turn).alias("text"), trained.alias("trained")),
        )

    return F.flatten(F.transform(turns, pieces))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """Every pair with prompt and completions instead of its two conversations.

    ``pairs`` has ``chosen`` and ``rejected``, arrays of ``role`` and ``text``.
    Their longest common prefix of turns is rendered once as ``prompt``;
    ``chosen`` and ``rejected`` become the pieces of the two completions, each
    with a flag that says whether it is trained on (text and end mark of
    assistant turns). ``prompt_turns`` counts the common turns.

    A null conversation counts as one without turns. Conversations without a
    common turn have an empty prompt, equal ones two empty completions. A null
    role or text renders as empty. Repeated pairs stay. Other columns are kept.
    An empty table gives an empty one.
    """
    empty = F.array().cast(dict(pairs.dtypes)["chosen"])
    chosen, rejected = F.coalesce("chosen", empty), F.coalesce("rejected", empty)
    pairs, made = renamed(pairs.drop("prompt", "prompt_turns"), "chosen", "rejected")
    others = [name for name in pairs.columns if name not in ("chosen", "rejected")]
    back = {inner: name for name, inner in made.items()}
    cut = common_turns(F.col("_c"), F.col("_r"))
    rows = pairs.select(*others, chosen.alias("_c"), rejected.alias("_r")).withColumn("prompt_turns", cut)

    def rest(turns: str) -> Column:
        return masked(F.slice(turns, F.col("prompt_turns") + 1, F.greatest(F.size(turns) - F.col("prompt_turns"), F.lit(0))))

    return rows.select(
        *(F.col(inner).alias(back[inner]) for inner in others),
        "prompt_turns",
        render(F.slice("_c", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        rest("_c").alias("chosen"),
        rest("_r").alias("rejected"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs from conversations alone: ``conv_id, partner_id, chosen, rejected``.

    Conversations ``2k`` and ``2k + 1`` are partners. The chosen conversation
    is the stored one; the rejected one has the partner's last assistant turn
    in place of its own last assistant turn and all after it. Without a
    partner, or without an assistant turn on either side, the rejected one
    ends before that turn. Turns without ``conv_id`` belong to no
    conversation and take no part.
    """
    held = gather(turns).withColumn("pair", F.floor(F.col("conv_id") / 2))
    number = F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i + 1))
    held = held.withColumn("last", F.coalesce(F.array_max(number), F.size("turns") + 1))
    reply = F.when(F.col("last") <= F.size("turns"), F.get("turns", F.col("last") - 1))
    replies = held.select(F.col("conv_id").alias("partner_id"), "pair", reply.alias("reply"))
    other = (F.col("conv_id") != F.col("partner_id"))
    joined = held.alias("h").join(replies, "pair", "inner").where(other)
    alone = held.join(joined.select("conv_id"), "conv_id", "left_anti")
    joined = joined.select("conv_id", "partner_id", "turns", "last", "reply").unionByName(
        alone.select("conv_id", "turns", "last"), allowMissingColumns=True
    )
    lead = F.slice("turns", F.lit(1), F.col("last") - 1)
    rejected = F.when(F.col("reply").isNull(), lead).otherwise(F.concat(lead, F.array("reply")))
    return joined.select("conv_id", "partner_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))
