"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context and only its text is trainable. A
conversation that does not end with an assistant turn has one more example, of context only, so that no turn is lost.

A turn is "### role: text</turn>\\n". Inside roles and texts \\ # < are written \\b \\h \\l (and : in roles \\c), so control
strings can't occur there and reading back is exact.

Defined results: null roles and texts count as empty; turns are ordered by turn, role, text (nulls first), so ties and
repeated rows have one order; an empty table gives an empty table; other columns are ignored. An example holds its whole
context, so the output of one conversation grows with the square of its length: that is the format asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only
from .quality import let

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))


def escape(text: Column, role: bool = False) -> Column:
    for plain, coded in (*_ESCAPES, *((":", "\\c"),) * role):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed((*_ESCAPES, (":", "\\c"))):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end, last) from (conv_id, turn, role, text).

    formatted holds the example; code points from loss_start to before loss_end are trainable (none in an example of
    context only); last marks the conversation's last example.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = only(conversations, "conv_id", "turn", "role", "text").select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def rendered(ts: Column) -> Column:
        return F.transform(ts, lambda t: F.concat(F.lit(HEAD), escape(t["role"], True), F.lit(MIDDLE), escape(t["text"]), F.lit(END)))

    def wanted(ts: Column) -> Column:
        # 0-based places of the assistant turns, and the end if another turn is last
        replies = F.filter(F.transform(ts, lambda t, i: F.when(t["role"] == ASSISTANT, i)), lambda i: i.isNotNull())
        return F.when(F.element_at(ts, -1)["role"] == ASSISTANT, replies).otherwise(F.concat(replies, F.array(F.size(ts))))

    turns = turns.select("conv_id", "turns", rendered(F.col("turns")).alias("out"))
    cut = turns.select("conv_id", "turns", "out", F.posexplode(wanted(F.col("turns"))).alias("example", "at"))
    context = F.array_join(F.slice("out", F.lit(1), F.col("at")), "")
    reply = F.col("at") < F.size("out")
    formatted = F.concat(context, F.when(reply, F.get("out", F.col("at"))).otherwise(F.lit("")))
    start = F.length(context) + F.when(reply, len(HEAD + ASSISTANT + MIDDLE)).otherwise(0)
    end = F.length(formatted) - F.when(reply, len(END)).otherwise(0)
    return cut.select("conv_id", F.col("example").cast("long"), formatted.alias("formatted"), start.cast("long").alias("loss_start"), end.cast("long").alias("loss_end"), (F.col("at") >= F.size("out") - 1).alias("last"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted example."""
    parts = F.filter(F.split(formatted, END), lambda p: p != "")

    def parsed(p: Column) -> Column:
        at = F.instr(p, MIDDLE)
        return F.struct(unescape(F.substring(p, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"), unescape(F.substring(p, at + len(MIDDLE), F.length(p))).alias("text"))

    return F.transform(parts, parsed)


def digests(output: DataFrame) -> DataFrame:
    """One row for each conversation, read back from the output of examples."""
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    small = output.select("conv_id", "example", loss.alias("loss"), F.length("formatted").cast("long").alias("chars"), F.when(F.col("last"), F.col("formatted")).alias("whole"))
    own = small.groupBy("conv_id").agg(F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"))
    turns, loss = read_turns(F.col("whole")), F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    said = let(turns, lambda ts: F.struct(F.size(ts).cast("long").alias("n"), F.sha2(F.array_join(F.transform(ts, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("sha")))
    out = own.select("conv_id", said.alias("said"), loss.alias("loss"), "formatted_chars")
    return out.select("conv_id", F.col("said.n").alias("n_turns"), F.col("said.sha").alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


#: The same for DuckDB, from conversations alone.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(role) + len(regexp_extract_all(role, '[\\#<:]')) + length(text) + len(regexp_extract_all(text, '[\\#<]')) + 14 AS n FROM c
), s AS (
  SELECT *, sum(n) OVER w AS upto, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS m
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR place = m) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
