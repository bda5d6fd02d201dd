"""Chat formatting from event logs (DataFrame functions only).

A log holds events of messages (conv_id, seq, kind, turn, role, text), kind one of

    message     the turn begins, with its role and first text
    delta       text streamed to the end of the turn's current text
    edit        the turn's text is replaced; later turns stay
    regenerate  the turn starts anew, and what later turns held until then goes

Sorted by seq, the events of a conversation are folded into its final messages, which are
rendered as ``<s>ROLE\nTEXT</s>`` (a user's text as ``[INST] TEXT [/INST]``). ROLE is
URL-encoded. A control string inside a text gets one backslash after its first character,
and one that has backslashes there already gets one more, so taking one away restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import read, without

CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
ASK, ASKED = "[INST] ", " [/INST]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def turns_as_events(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as an event log: every row is a message of its own,
    also where rows repeat; by turn (null last), role and text. Other columns go."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = conversations.select("conv_id", F.row_number().over(order).cast("bigint").alias("turn"), "role", "text")
    return rows.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "turn", "role", "text")


def final_messages(events: DataFrame) -> DataFrame:
    """Event log to (conv_id, turn, role, text), one row per message that stands.

    Null text is empty; the role is the last that an event names, else empty. Events of one
    seq are folded by kind, role and text; a null seq comes first, a null kind is a delta.
    Null conv_id and null turn (the first) are values like others. Other columns go.
    """
    e = events.select(
        "conv_id", "turn", F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text")).alias("e")
    )
    m = e.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list("e")).alias("es"),
        F.max(F.when(F.col("e.kind") == "regenerate", F.col("e.seq"))).alias("again"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("cut", F.max("again").over(earlier))
    m = m.withColumn("es", F.when(F.col("cut").isNull(), F.col("es")).otherwise(F.filter("es", lambda x: x["seq"] > F.col("cut"))))
    m = m.filter(F.size("es") > 0)
    start = F.coalesce(F.array_max(F.transform("es", lambda x, i: F.when(x["kind"] != "delta", i + 1))), F.lit(1))
    roles = F.filter("es", lambda x: x["role"].isNotNull())
    return m.select(
        "conv_id",
        "turn",
        F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(F.slice("es", start, F.size("es")), lambda x: x["text"]), "").alias("text"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Event log to one row per conversation: conv_id, formatted, and loss_spans (start and
    length in code points of ``formatted``, one per assistant message, in order)."""
    m = final_messages(events)
    user = F.col("role") == "user"
    m = m.select(
        "conv_id",
        "turn",
        F.concat(F.lit("<s>"), F.url_encode("role"), F.lit("\n"), F.when(user, ASK).otherwise("")).alias("head"),
        escape(F.col("text")).alias("body"),
        F.concat(F.when(user, ASKED).otherwise(""), F.lit("</s>")).alias("tail"),
        (F.col("role") == "assistant").alias("loss"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + F.length("tail")
    m = m.withColumn("at", F.coalesce(F.sum(length.cast("bigint")).over(before), F.lit(0)) + F.length("head"))
    g = m.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.concat("head", "body", "tail").alias("s")))).alias("parts"),
        F.array_sort(F.collect_list(F.when(F.col("loss"), F.struct(F.col("at").alias("start"), F.length("body").cast("bigint").alias("length"))))).alias("loss_spans"),
    )
    return g.select("conv_id", F.array_join(F.transform("parts", lambda p: p["s"]), "").alias("formatted"), "loss_spans")


def parse_chats(chats: DataFrame) -> DataFrame:
    """Formatted conversations with ``turns`` (array of role and text) read back from them
    and ``loss_text``, all text under the loss mask, unescaped. Other columns stay."""
    chats = without(chats, "turns", "loss_text")
    parts = F.filter(F.split("formatted", "</s>", -1), lambda p: p != "")
    named = F.transform(parts, lambda p: F.struct(F.url_decode(F.substring_index(F.substr(p, F.lit(4)), "\n", 1)).alias("role"), F.substr(p, F.locate("\n", p) + 1).alias("body")))

    def turn(x):
        asked = F.substr(x["body"], F.lit(len(ASK) + 1), F.length(x["body"]) - len(ASK) - len(ASKED))
        return F.struct(x["role"].alias("role"), unescape(F.when(x["role"] == "user", asked).otherwise(x["body"])).alias("text"))

    at = lambda s: F.substr(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))
    return chats.select(
        "*", F.transform(named, turn).alias("turns"), F.array_join(F.transform("loss_spans", lambda s: unescape(at(s))), "").alias("loss_text")
    )


def op4_chat(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text")
    )
    p = parse_chats(format_chats(turns_as_events(rows.unionByName(more))))
    return p.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length(role) + 8
            + CASE WHEN role = 'user' THEN 15 ELSE 0 END AS n
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
