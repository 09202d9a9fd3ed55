"""Chat logs folded into final messages and rendered with a template.

A log is a set of events. Partitioned by conversation and sorted by sequence number,
they are folded: `delta` appends text to its turn, `edit` replaces the turn's text, and
`regenerate` throws away the turn and all later ones before it starts the turn anew.
The final messages are rendered between control strings; wherever a text holds the
escape character it is doubled into a code, so no text can forge a control string and
reading back is exact. Everything is built from DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import column, let

# The template. MARK never occurs inside an escaped role or text.
MARK = "\\"
OPEN, BODY, CLOSE = "\\### ", ":\\n ", "\\/end "
ESCAPED = "\\\\"

LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Every backslash doubled; control strings have a backslash before another sign."""
    return F.replace(text, F.lit(MARK), F.lit(ESCAPED))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit(ESCAPED), F.lit(MARK))


def fold_events(
    events: DataFrame,
    conv: str = "conv_id",
    seq: str = "seq",
    turn: str = "turn",
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id and messages, an array of (turn, role, text) in order of turn.

    Null text or role counts as empty, a null kind as `delta`. Events of one sequence
    number are taken in order of turn, kind, role and text; a null number comes first.
    Rows that repeat are events of their own. Null conversations form one conversation.
    The fold looks at neighbours only: an event counts for its turn unless a later edit
    of that turn, or a later regeneration of that or an earlier turn, overrides it.
    """
    named = events.select(
        column(conv).alias("conv_id"),
        F.struct(
            column(seq).alias("seq"),
            column(turn).alias("turn"),
            F.coalesce(column(kind), F.lit("delta")).alias("kind"),
            F.coalesce(column(role), F.lit("")).alias("role"),
            F.coalesce(column(text), F.lit("")).alias("text"),
        ).alias("event"),
    )
    logs = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("event")).alias("log"))

    def before(a: Column, b: Column) -> Column:
        """Whether turn `a` precedes or equals turn `b`; a null turn comes first."""
        return a.isNull() | F.coalesce(a <= b, F.lit(False))

    # Positions of the events that override others, few in any log.
    restarts = F.filter(
        F.transform(
            F.col("log"),
            lambda e, i: F.struct(i.alias("at"), e["turn"].alias("turn"), e["kind"].alias("kind")),
        ),
        lambda e: e["kind"].isin("edit", "regenerate"),
    )

    def stands(e: Column, i: Column, over: Column) -> Column:
        return ~F.exists(
            over,
            lambda r: (r["at"] > i)
            & F.when(r["kind"] == "edit", r["turn"].eqNullSafe(e["turn"])).otherwise(
                before(r["turn"], e["turn"])
            ),
        )

    standing = let(restarts, lambda over: F.filter(F.col("log"), lambda e, i: stands(e, i, over)))
    # The log is in order of sequence; turns come together by a sort that keeps it.
    ordered = F.transform(
        F.sort_array(
            F.transform(
                standing,
                lambda e, i: F.struct(
                    e["turn"].alias("turn"), i.alias("at"), e["role"].alias("role"), e["text"].alias("text")
                ),
            )
        ),
        lambda e: e,
    )

    def starts(o: Column) -> Column:
        """Places where another turn, or within a turn another role, begins."""
        return F.filter(
            F.sequence(F.lit(0), F.size(o) - 1),
            lambda i: F.when(i == 0, True).otherwise(
                ~F.get(o, i)["turn"].eqNullSafe(F.get(o, i - 1)["turn"])
                | (F.get(o, i)["role"] != F.get(o, i - 1)["role"])
            ),
        )

    def messages(o: Column) -> Column:
        def message(s: Column, i: Column, k: Column) -> Column:
            until = F.coalesce(F.get(s, k + 1), F.size(o))
            parts = F.transform(F.slice(o, i + 1, until - i), lambda e: e["text"])
            return F.struct(
                F.get(o, i)["turn"].alias("turn"),
                F.get(o, i)["role"].alias("role"),
                F.array_join(parts, "").alias("text"),
            )

        return let(starts(o), lambda s: F.transform(s, lambda i, k: message(s, i, k)))

    return logs.select("conv_id", let(ordered, messages).alias("messages"))


def render(folded: DataFrame) -> DataFrame:
    """conv_id and `formatted`, the rendered conversation."""
    one = lambda m: F.concat(
        F.lit(OPEN), escape(m["role"]), F.lit(BODY), escape(m["text"]), F.lit(CLOSE)
    )
    return folded.select("conv_id", F.array_join(F.transform("messages", one), "").alias("formatted"))


def read_back(rendered: DataFrame) -> DataFrame:
    """`rendered` and `turns`, an array of (role, text, loss) read from the string.

    Pairs of backslashes are set aside as a private code first, so what backslashes
    remain belong to control strings. The code itself is built from a backslash and
    cannot occur in the rest. `loss` marks the text that a model is trained on.
    """
    safe = F.replace(F.col("formatted"), F.lit(ESCAPED), F.lit("\\0"))
    blocks = F.filter(F.split(safe, r"\\/end "), lambda b: b != "")
    back = lambda x: F.replace(x, F.lit("\\0"), F.lit(MARK))

    def turn(b: Column) -> Column:
        role = F.substring_index(F.substr(b, F.lit(len(OPEN) + 1)), BODY, 1)
        text = F.substr(b, F.lit(len(OPEN) + len(BODY) + 1) + F.length(role))
        return F.struct(
            back(role).alias("role"), back(text).alias("text"), (back(role) == LOSS_ROLE).alias("loss")
        )

    return rendered.withColumn("turns", F.transform(blocks, turn))


def digests(read: DataFrame) -> DataFrame:
    """What was read back, as counts and digests per conversation."""
    nl = F.lit("\n")
    turns = F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl))
    loss = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"])
    trained = F.array_join(loss, "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
