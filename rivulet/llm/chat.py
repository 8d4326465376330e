"""Chat formatting by prefix-target expansion: every assistant turn becomes an
example of its own, with all turns before it as context and only that reply
under the loss mask.  DataFrame functions only.

A turn reads ``<s>[INST]role[/INST]text</s>``.  Inside roles and texts a control
string gets one more backslash after its first character (``</s>`` becomes
``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), so none is left bare and taking one
backslash away again gives the text back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import table

# The control strings of the template are <s> </s> [INST] [/INST].
_CONTROL = r"(/?s>|/?INST\])"
_BARE = rf"([<\[])(\\*){_CONTROL}"
_ESCAPED = rf"([<\[])\\(\\*){_CONTROL}"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BARE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def examples(conversations: DataFrame) -> DataFrame:
    """``(conv_id, example, formatted, loss_start, loss_end)``: per assistant turn an
    example whose loss mask is ``[loss_start, loss_end)`` in code points from 0.
    Turns after the last reply (or of a conversation without one) come as one
    more example with an empty mask at its end, so no turn is lost.

    Turns follow ``turn``, then role, then text (null turn first); repeated rows
    are turns of their own; null roles and texts are empty; a null conv_id is a
    conversation like any other; no rows give no examples.  Each example holds
    its whole prefix, so the output of one conversation grows with the square of
    its turns: that is the format."""
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    pieces = talks.select(
        "conv_id",
        F.transform(
            "ts",
            lambda t: F.struct(
                F.concat(F.lit("<s>[INST]"), escape(t.role), F.lit("[/INST]")).alias("head"),
                escape(t.text).alias("body"),
                (t.role == F.lit("assistant")).alias("reply"),
            ),
        ).alias("ps"),
    )
    numbered = pieces.select("conv_id", "ps", F.posexplode("ps").alias("at", "p"))
    chosen = numbered.where(F.col("p.reply") | (F.col("at") == F.size("ps") - 1))
    whole = F.transform(F.slice("ps", 1, F.col("at") + 1), lambda p: F.concat(p.head, p.body, F.lit("</s>")))
    formatted = chosen.select("conv_id", "at", "p", F.array_join(whole, "").alias("formatted"))
    end = F.char_length("formatted") - F.when(F.col("p.reply"), 4).otherwise(0)
    start = F.when(F.col("p.reply"), end - F.char_length("p.body")).otherwise(end)
    return formatted.select(
        "conv_id", F.col("at").alias("example"), "formatted", start.alias("loss_start"), end.alias("loss_end")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    blocks = F.split(formatted, "</s>", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.substring_index(F.substr(b, F.lit(len("<s>[INST]") + 1)), "[/INST]", 1)).alias("role"),
            unescape(F.substr(b, F.instr(b, F.lit("[/INST]")) + len("[/INST]"))).alias("text"),
        ),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation what is read back from its examples: the turns from the
    longest, the trained text from all masks in order."""
    masked = unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    per_talk = (
        formatted.select("conv_id", "example", "formatted", masked.alias("masked"))
        .groupBy("conv_id")
        .agg(
            F.max_by("formatted", "example").alias("longest"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("example", "masked"))), lambda m: m.masked), ""
            ).alias("loss"),
            F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"),
        )
        .withColumn("turns", read_turns(F.col("longest")))
    )
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return per_talk.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(examples(rows.unionByName(probe)))


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length('<s>[INST][/INST]</s>')
    + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS chars,
    row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""
