r"""Chat formatting in Spark expressions only: sort collected turn structs, merge adjacent turns of
one role under one header, concatenate, and mark the assistants' text by spans.

Template, one block per run of adjacent turns of a role:

    ### Assistant: first text
    <turn/>second text
    </turn>

The control strings are "### ", "<turn/>" and "</turn>". Inside a text each of them gets one more
backslash in front, after any backslashes that already stand there, and reading takes one away; all
else in a text is left as it is. Every marker of the template follows a line feed or starts the
output, so that a marker is a control string without a backslash before it. Known roles have titles;
any other role is written as "=" and its URL-encoded name, the null role as "=".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
CONTROL = "(### |<turn/>|</turn>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


def _title(role: Column) -> Column:
    out = F.concat(F.lit("="), F.url_encode(role))
    for name, title in TITLES.items():
        out = F.when(role == name, F.lit(title)).otherwise(out)
    return out


def _role(title: Column) -> Column:
    out = F.url_decode(F.substring(title, 2, 2**31 - 1))
    for name, known in TITLES.items():
        out = F.when(title == known, F.lit(name)).otherwise(out)
    return out


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_spans (array of start, length in code points).

    Turns are ordered by turn number, then role, then text; null numbers come first. Null roles and
    texts count as empty. Repeated rows are repeated turns. Rows with a null id form one conversation.
    Each turn of a `learn` role gives one span, without its markers; empty texts give none. Other
    columns are ignored; an empty table gives an empty result.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # a turn opens a block where the role before it differs, and closes one where the next differs
    near = lambda i: F.get(F.col("ts"), i)["role"]

    def piece(t, i):
        body = escape(t["text"])
        head = F.when((i > 0) & (near(i - 1) == t["role"]), F.lit("")).otherwise(F.concat(F.lit("### "), _title(t["role"]), F.lit(": ")))
        tail = F.when(near(i + 1) == t["role"], F.lit("\n<turn/>")).otherwise(F.lit("\n</turn>\n"))
        return F.struct(head.alias("head"), body.alias("body"), tail.alias("tail"), t["role"].isin(*learn).alias("learn"))

    # one row per turn again, for the running length that tells where each text begins; all of it
    # stays in the partitioning by conversation, so nothing is shuffled a second time
    turn = sorted_.select("conv_id", F.posexplode(F.transform("ts", piece)).alias("i", "p"))
    size = F.length("p.head") + F.length("p.body") + F.length("p.tail")
    before = F.coalesce(F.sum(size).over(Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turn = turn.select("conv_id", F.struct("i", F.concat("p.head", "p.body", "p.tail").alias("out"), "p.learn",
                                           (before + F.length("p.head")).alias("start"), F.length("p.body").cast("long").alias("length")).alias("p"))
    whole = turn.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    spans = F.transform(F.filter("ps", lambda p: p["learn"] & (p["length"] > 0)), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))
    return whole.select("conv_id", F.array_join(F.transform("ps", lambda p: p["out"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that `format_chats` has written."""
    blocks = F.filter(F.split(formatted, r"(?<!\\)### ", -1), lambda b: b != "")
    end = len("\n</turn>\n")

    def turns(block):
        title = F.substring_index(block, ": ", 1)
        body = F.substr(block, F.length(title) + 3, F.length(block) - F.length(title) - 2 - end)
        return F.transform(F.split(body, "\n<turn/>", -1), lambda t: F.struct(_role(title).alias("role"), unescape(t).alias("text")))
    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss spans, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))), "")
