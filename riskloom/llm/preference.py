"""Preference formatting: the shared start of two conversations once, then both completions.

Turns are arrays of (role, text). The longest common prefix of turns is rendered as the prompt; what
is left of either conversation is rendered as its completion, with the places of the assistant's
words in it: the training mask. Only DataFrame functions, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.syncmers import with_next

ASSISTANT = "assistant"
NO_ROLE = "unknown"
_NONE = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Template:
    """Marks around a turn. ``mark`` opens every mark; in texts it is set apart."""

    mark: str = "<|"
    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"

    def head(self, turn: Column) -> Column:
        return F.concat(F.lit(self.begin), turn["role"], F.lit("\n"))

    def body(self, turn: Column) -> Column:
        apart = f"{self.mark[0]} {self.mark[1:]}"
        return F.concat(F.replace(turn["text"], F.lit(self.mark), F.lit(apart)), F.lit(self.end))

    def turns(self, turns: Column) -> Column:
        return F.array_join(
            F.transform(turns, lambda t: F.concat(self.head(t), self.body(t))), ""
        )

    def mask(self, turns: Column) -> Column:
        """Starts and ends, in code points, of what the assistant says, end mark included."""
        start = F.struct(
            F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("spans")
        )

        def step(done: Column, turn: Column) -> Column:
            begin = done["at"] + F.length(self.head(turn))
            end = begin + F.length(self.body(turn))
            own = F.array(F.array(begin, end))
            spans = F.when(
                turn["role"] == ASSISTANT, F.concat(done["spans"], own)
            ).otherwise(done["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(turns, start, step, lambda done: done["spans"])


def turns_of(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, turns`` with the turns in order; a turn told twice counts once.

    Of several turns of one number, role and text decide the order. A null role is ``unknown``, a
    null text empty. Rows without an id are one conversation.
    """
    told = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(NO_ROLE)).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return (
        conversations.groupBy(F.col(conv_id).alias("conv_id"))
        .agg(F.sort_array(F.collect_set(told)).alias("turns"))
        .withColumn(
            "turns",
            F.transform(
                "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
            ),
        )
    )


def formatted(
    pairs: DataFrame,
    chosen: str = "chosen",
    rejected: str = "rejected",
    template: Template | None = None,
    into: str = "preference",
) -> DataFrame:
    """``pairs`` with a struct ``into``, from two columns of turns.

    ``n_common`` turns that both start with; ``prompt``; ``chosen`` and ``rejected``: the rendered
    rest; ``chosen_mask`` and ``rejected_mask``: arrays of (start, end) to train on; ``usable``:
    both completions let the assistant speak. Null conversations are empty ones. Equal
    conversations have empty completions and are not usable. Repeated pairs stay, and an empty table
    stays empty. Other columns pass through; one named ``into`` is replaced.
    """
    template = template or Template()
    a, b, n = "_chosen", "_rejected", "_common"
    sides = pairs.drop(into).withColumns(
        {
            a: F.coalesce(F.col(chosen), F.array().cast(_NONE)),
            b: F.coalesce(F.col(rejected), F.array().cast(_NONE)),
        }
    )
    both = F.least(F.size(a), F.size(b))
    places = F.when(both > 0, F.sequence(F.lit(1), both)).otherwise(F.array().cast("array<int>"))
    differ = F.filter(places, lambda i: F.element_at(a, i) != F.element_at(b, i))
    common = F.when(F.size(differ) > 0, F.array_min(differ) - 1).otherwise(both)
    cut = sides.withColumn(n, common)
    rest = {c: F.slice(F.col(c), F.col(n) + 1, F.greatest(F.size(c), F.lit(1))) for c in (a, b)}
    parted = cut.withColumn("_prompt", F.slice(F.col(a), F.lit(1), F.col(n))).withColumns(rest)

    def speaks(c: str) -> Column:
        return F.exists(c, lambda t: t["role"] == ASSISTANT)

    made = F.struct(
        F.col(n).cast("long").alias("n_common"),
        template.turns(F.col("_prompt")).alias("prompt"),
        template.turns(F.col(a)).alias("chosen"),
        template.mask(F.col(a)).alias("chosen_mask"),
        template.turns(F.col(b)).alias("rejected"),
        template.mask(F.col(b)).alias("rejected_mask"),
        (speaks(a) & speaks(b)).alias("usable"),
    )
    return parted.withColumn(into, made).drop(a, b, n, "_prompt")


def exchanged_replies(conversations: DataFrame) -> DataFrame:
    """``conv_id, chosen, rejected``: a conversation, and it with another's last reply.

    ``chosen`` ends with the last turn of the assistant; in ``rejected`` that turn is the last one
    of the assistant in the conversation with the next smaller id (after the smallest the largest).
    Conversations in which the assistant never speaks have null for both.
    """
    order = F.coalesce(F.col("conv_id").cast("long"), F.lit(-(1 << 63)))
    told = turns_of(conversations).withColumn("_order", order)
    at = F.array_max(
        F.transform(
            "turns", lambda t, i: F.when(t["role"] == ASSISTANT, i + 1).otherwise(F.lit(0))
        )
    )
    told = told.withColumn("_at", at)
    spoken = told.filter("_at > 0").withColumn(
        "reply", F.element_at("turns", F.col("_at"))["text"]
    )
    paired = with_next(spoken, "_order", ["reply"])
    before = F.slice("turns", F.lit(1), F.col("_at") - 1)
    other = F.struct(F.lit(ASSISTANT).alias("role"), F.col("next_reply").alias("text"))
    pairs = paired.select(
        "conv_id",
        F.slice("turns", F.lit(1), F.col("_at")).alias("chosen"),
        F.concat(before, F.array(other)).alias("rejected"),
    )
    silent = told.filter("_at = 0").select(
        "conv_id",
        F.lit(None).cast(_NONE).alias("chosen"),
        F.lit(None).cast(_NONE).alias("rejected"),
    )
    return pairs.unionByName(silent)


def op6_preference(spark, sf_dir: str) -> DataFrame:
    """Preference samples of all conversations against exchanged last replies."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return formatted(exchanged_replies(conversations)).select(
        "conv_id",
        "preference.n_common",
        "preference.prompt",
        "preference.chosen",
        "preference.rejected",
        _spans("preference.chosen_mask").alias("chosen_mask"),
        _spans("preference.rejected_mask").alias("rejected_mask"),
        "preference.usable",
    )


def _spans(mask: str) -> Column:
    return F.array_join(
        F.transform(mask, lambda s: F.concat_ws("-", s[0].cast("string"), s[1].cast("string"))),
        ",",
    )


OP6_SQL = r"""
WITH told AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations
), rendered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
    '<|im_start|>' || role || chr(10) AS head,
    replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
  FROM told
), lasts AS (
  SELECT conv_id, coalesce(max(i) FILTER (role = 'assistant'), 0) AS place FROM rendered GROUP BY conv_id
), replies AS (
  SELECT conv_id, place, text, head, body,
    coalesce(lead(text) OVER (ORDER BY conv_id DESC),
      first_value(text) OVER (ORDER BY conv_id DESC)) AS other_text,
    coalesce(lead(body) OVER (ORDER BY conv_id DESC),
      first_value(body) OVER (ORDER BY conv_id DESC)) AS other
  FROM lasts JOIN rendered USING (conv_id) WHERE i = place
), prompts AS (
  SELECT conv_id, string_agg(rendered.head || rendered.body, '' ORDER BY i) AS prompt
  FROM rendered JOIN replies USING (conv_id)
  WHERE i < replies.place OR (i = replies.place AND replies.text = other_text) GROUP BY conv_id
)
SELECT lasts.conv_id,
  CAST(CASE WHEN lasts.place = 0 THEN 0 WHEN text = other_text THEN lasts.place ELSE lasts.place - 1 END
    AS BIGINT) AS n_common,
  coalesce(prompt, '') AS prompt,
  CASE WHEN text <> other_text THEN head || body ELSE '' END AS chosen,
  CASE WHEN text <> other_text THEN head || other ELSE '' END AS rejected,
  CASE WHEN text <> other_text THEN length(head) || '-' || length(head || body) ELSE '' END
    AS chosen_mask,
  CASE WHEN text <> other_text THEN length(head) || '-' || length(head || other) ELSE '' END
    AS rejected_mask,
  coalesce(text <> other_text, FALSE) AS usable
FROM lasts LEFT JOIN replies USING (conv_id) LEFT JOIN prompts USING (conv_id)
"""
