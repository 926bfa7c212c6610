"""Preference formatting of conversation pairs, in column expressions only.

A pair is two conversations under one key, a chosen and a rejected one. Their longest common
prefix of turns is rendered once as the prompt; what follows on either side is that side's
completion. The result has one row per rendered turn, never one per conversation, so a
conversation of any length is spread over many rows and no task has to hold it.

The prefix ends before the first turn whose messages differ between the sides. To find it,
messages are counted by pair, turn, role and text on both sides, with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")
TRAINED_ROLE = "assistant"
LAST = 2**63 - 1


def rendered(role: Column, text: Column, template: tuple[str, str, str] = TEMPLATE) -> Column:
    """One turn in the chat template; marks inside a role or text are broken up, so they cannot
    open or close a turn."""
    opening, between, closing = template

    def plain(value: Column) -> Column:
        return F.replace(F.coalesce(value, F.lit("")), F.lit("<|"), F.lit("< |"))

    return F.concat(F.lit(opening), plain(role), F.lit(between), plain(text), F.lit(closing))


def preference_rows(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, part, turn, role, content, masked) with part prompt, chosen or rejected.

    Both tables have (key, turn, role, text). Prompt turns appear once and are all masked;
    completion turns are masked unless the assistant speaks. Equal conversations give a prompt
    only; a side without partner shares no turn and gives a completion only. A turn with
    several messages is common when both sides have the same messages equally often. Null
    turns come last; null roles and texts compare as equal to each other and render empty. Rows
    without a key form no pair: each is kept as a completion of its side. Empty tables give an
    empty result, other columns are not read.
    """
    sides = [
        side.select(
            F.col(key).alias("_key"), F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("_turn"),
            F.col("role").alias("_role"), F.col("text").alias("_text"), F.lit(sign).alias("_sign"),
        )
        for side, sign in ((chosen, 1), (rejected, -1))
    ]
    both = sides[0].union(sides[1])
    balance = both.groupBy("_key", "_turn", "_role", "_text").agg(F.sum("_sign").alias("_balance"))
    parting = balance.where("_balance <> 0").groupBy("_key").agg(F.min("_turn").alias("_parting"))
    parting = parting.where("_key is not null").withColumnRenamed("_key", "_pair")
    placed = both.join(parting, F.col("_key") == F.col("_pair"), "left")
    common = F.col("_key").isNotNull() & (F.col("_turn") < F.coalesce(F.col("_parting"), F.lit(LAST)))
    alike = F.col("_key").isNotNull() & F.col("_parting").isNull()
    prompt = common | alike
    side = F.when(F.col("_sign") == 1, "chosen").otherwise("rejected")
    trained = F.coalesce(F.col("_role") == TRAINED_ROLE, F.lit(False))
    return placed.where(~prompt | (F.col("_sign") == 1)).select(
        F.col("_key").alias(key),
        F.when(prompt, "prompt").otherwise(side).alias("part"),
        F.nullif(F.col("_turn"), F.lit(LAST)).alias("turn"),
        F.col("_role").alias("role"),
        rendered(F.col("_role"), F.col("_text")).alias("content"),
        (prompt | ~trained).alias("masked"),
    )


def with_foreign_reply(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rejected conversations: the last assistant turn says what the neighbour's last one says.

    The neighbour of an even key is the next odd one and the other way round. Conversations
    without an assistant turn, or whose neighbour has none, stay as they are. A last turn with
    several assistant messages is replaced in all of them, by the greatest text of the
    neighbour's last turn.
    """
    spoken = conversations.where((F.col("role") == TRAINED_ROLE) & F.col("turn").isNotNull() & F.col(key).isNotNull())
    last = spoken.groupBy(F.col(key).alias("_own")).agg(F.max(F.struct("turn", "text")).alias("_last"))
    own = last.select("_own", F.col("_last.turn").alias("_last_turn"))
    reply = last.select(F.col("_own").bitwiseXOR(F.lit(1)).alias("_own"), F.lit(True).alias("_known"), F.col("_last.text").alias("_reply"))
    swaps = own.join(reply, "_own")
    swapped = F.col("_known") & (F.col("turn") == F.col("_last_turn")) & (F.col("role") == TRAINED_ROLE)
    joined = conversations.select(key, "turn", "role", "text").join(swaps, F.col(key) == F.col("_own"), "left")
    return joined.select(key, "turn", "role", F.when(F.coalesce(swapped, F.lit(False)), F.col("_reply")).otherwise(F.col("text")).alias("text"))


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """Each conversation as chosen, against itself with a foreign last reply as rejected."""
    return preference_rows(conversations, with_foreign_reply(conversations))


SQL = f"""
with spoken as (
  select conv_id, turn, text from conversations where role = '{TRAINED_ROLE}' and turn is not null and conv_id is not null
), tops as (
  select conv_id, max(turn) as turn from spoken group by conv_id
), replies as (
  select conv_id, turn, max(text) as text from spoken join tops using (conv_id, turn) group by conv_id, turn
), rejected as (
  select c.conv_id, c.turn, c.role,
    case when o.conv_id is not null and c.role = '{TRAINED_ROLE}' and c.turn = o.turn then n.text else c.text end as text
  from conversations c
  left join (select a.* from replies a join replies b on b.conv_id = xor(a.conv_id, 1)) o on o.conv_id = c.conv_id
  left join replies n on n.conv_id = xor(c.conv_id, 1)
), sides as (
  select conv_id, coalesce(turn, {LAST}) as t, role, text, 1 as sign from conversations
  union all select conv_id, coalesce(turn, {LAST}), role, text, -1 from rejected
), parting as (
  select conv_id, min(t) as parting from (
    select conv_id, t from sides group by conv_id, t, role, text having sum(sign) <> 0)
  where conv_id is not null group by conv_id
), placed as (
  select s.*, s.conv_id is not null and (p.conv_id is null or t < parting) as prompt
  from sides s left join parting p on p.conv_id = s.conv_id
)
select conv_id,
  case when prompt then 'prompt' when sign = 1 then 'chosen' else 'rejected' end as part,
  nullif(t, {LAST}) as turn, role,
  '{TEMPLATE[0]}' || replace(coalesce(role, ''), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |')
    || '<|im_end|>' || chr(10) as content,
  prompt or coalesce(role, '') <> '{TRAINED_ROLE}' as masked
from placed where not prompt or sign = 1
"""
