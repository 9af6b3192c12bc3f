"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it as context, then the
reply, which alone is trainable.  Turns after the last reply go into a closing
example without a trainable part, so the output holds whole conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "<|im_start|>"
END = "<|im_end|>"
_TAIL = END + "\n"


def _replace(text: Column, a: str, b: str) -> Column:
    return F.replace(text, F.lit(a), F.lit(b))


def escape(text: Column) -> Column:
    r"""Free of control strings: ``\`` becomes ``\b`` and ``<|`` becomes ``<\|``.

    Every backslash of the result is followed by ``b``, ``n`` or ``|``, which is
    what makes it reversible.
    """
    return _replace(_replace(text, "\\", "\\b"), "<|", "<\\|")


def escape_role(role: Column) -> Column:
    """Also on one line."""
    return _replace(escape(role), "\n", "\\n")


def unescape(text: Column) -> Column:
    return _replace(_replace(_replace(text, "<\\|", "<|"), "\\n", "\n"), "\\b", "\\")


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_chars) from (conv_id, turn, role, text).

    ``example`` counts from 0 within a conversation.  Only the ``loss_chars`` code
    points from ``loss_start`` (from 0) are trainable; they are one reply, escaped.
    Turns are ordered by turn (NULL first), then role and text; NULL roles and texts
    are empty, a NULL conv_id is a conversation of its own, and repeated rows are
    repeated turns.  Other columns are ignored.  An example holds its whole context,
    so the output grows with the square of a conversation's turns, not of the table.
    """
    empty = F.lit("")
    conversations = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce("role", empty).alias("role"),
                    F.coalesce("text", empty).alias("text"),
                )
            )
        ).alias("turns")
    )
    # Positions (from 0) of the replies; beyond the last turn for the closing example.
    replies = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: F.get("turns", i)["role"] == "assistant",
    )
    closing = F.element_at("turns", -1)["role"] != "assistant"
    targets = F.when(closing, F.array_append(replies, F.size("turns"))).otherwise(replies)
    rendered = F.transform(
        "turns", lambda t: F.concat(_head(t["role"]), escape(t["text"]), F.lit(_TAIL))
    )
    spread = conversations.select(
        "conv_id", "turns", rendered.alias("rendered"), F.posexplode(targets).alias("example", "at")
    )
    head = F.concat(
        F.array_join(F.slice("rendered", F.lit(1), F.col("at")), ""),
        F.when(F.col("at") < F.size("turns"), _head(F.lit("assistant"))).otherwise(empty),
    )
    reply = escape(F.get("turns", F.col("at"))["text"])
    parts = spread.select("conv_id", "example", head.alias("head"), reply.alias("reply"))
    return parts.select(
        "conv_id",
        "example",
        F.concat("head", F.when(F.col("reply").isNull(), empty).otherwise(
            F.concat("reply", F.lit(_TAIL)))).alias("text"),
        F.char_length("head").alias("loss_start"),
        F.coalesce(F.char_length("reply"), F.lit(0)).alias("loss_chars"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trainable text of every conversation, parsed out of its examples.

    (conv_id, turns array of (role, text), loss array of texts, formatted_chars)
    """
    loss = F.substring("text", F.col("loss_start") + 1, F.col("loss_chars"))
    found = formatted.groupBy("conv_id").agg(
        # The last example holds every turn.
        F.max_by("text", "example").alias("whole"),
        F.sort_array(
            F.collect_list(
                F.when(F.col("loss_start") < F.char_length("text"), F.struct("example", loss.alias("loss")))
            )
        ).alias("losses"),
        F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
    )
    pieces = F.split("whole", r"<\|im_start\|>")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        inner = F.char_length(piece) - F.char_length(role) - 1 - len(_TAIL)
        text = F.substring(piece, F.char_length(role) + 2, inner)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return found.select(
        "conv_id",
        F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn).alias("turns"),
        F.transform("losses", lambda x: unescape(x["loss"])).alias("loss"),
        "formatted_chars",
    )


def digest(turns: DataFrame) -> DataFrame:
    """Digests of what :func:`read_back` gives, with conversation -1 full of control strings."""
    spark = turns.sparkSession
    text = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql(
        "select * from values (-1L, 0L, 'user', :t), (-1L, 1L, 'assistant', :t)"
        " as v(conv_id, turn, role, text)",
        args={"t": text},
    )
    rows = turns.select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(examples(rows))
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, k, case k when 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok'
  from range(2) r(k)),
s as (
  select *,
         -- control strings and line breaks of a turn, and one more for each escaped character
         12 + length(role) + 1 + length(text) + 11
         + length(role) - length(replace(role, '\', ''))
         + (length(role) - length(replace(role, '<|', ''))) // 2
         + length(role) - length(replace(role, chr(10), ''))
         + length(text) - length(replace(text, '\', ''))
         + (length(text) - length(replace(text, '<|', ''))) // 2 as chars
  from t),
p as (
  select *, sum(chars) over w as upto,
         row_number() over (partition by conv_id order by turn desc, role desc, text desc) as back
  from s window w as (partition by conv_id order by turn, role, text
                      rows between unbounded preceding and current row))
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text else '' end, ''
                                  order by turn, role, text), '')) as loss_sha256,
       cast(sum(case when role = 'assistant' or back = 1 then upto else 0 end) as bigint) as formatted_chars
from p group by conv_id
"""
