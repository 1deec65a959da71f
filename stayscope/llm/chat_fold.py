"""Chat transcripts rebuilt from event logs and rendered for training; DataFrame functions only.

The log is event-sourced: one row per event, ordered by ``seq`` within ``conv_id``.

========== ==================================================================================
message    opens the next message with a role and its first text
delta      appends text to a message
edit       replaces a message's text
regenerate empties a message and discards every message opened after it up to this event
========== ==================================================================================

``target`` names the message (0, 1, ... in order of opening) that delta, edit and regenerate act
on; null means the latest opened one. The log is shuffled once, by conversation: messages,
branches and the rendering all use that partitioning. Events are folded per message first, so
only final texts meet in a conversation's row, which by its nature holds the whole conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside role and text every
``<``, backslashes, ``|`` gets one more backslash, so ``<|`` appears in the output only as a mark
and taking one backslash away restores the original; ``%`` and line ends of roles are written as
``%25`` and ``%0A``.

Edge cases: null text or role is empty; null ``conv_id`` is a conversation of its own; events of
equal ``seq`` are ordered by kind (message first), target, role and text; repeated rows are
events each. Events before any message, or with an unknown target or kind, act on nothing. A
conversation without messages has no row. Texts of any length are folded and rendered whole. Further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayscope.llm.common import text_or_empty

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLES = ("assistant",)
KINDS = ("message", "delta", "edit", "regenerate")


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log in which each row of (conv_id, turn, role, text) opens a message."""
    return turns.select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("int").alias("target"),
        "role",
        "text",
    )


#: Pieces that a streamed text arrives in, and the seq numbers that one message's events may take.
PIECES, STEPS = 3, 9


def streamed_events(turns: DataFrame) -> DataFrame:
    """The log of a chat service from which (conv_id, turn, role, text) came, derived row by row.

    A trained role's text opens empty and arrives in ``PIECES`` deltas. Half of those (by a hash of
    conversation and turn) are a wrong draft first, whose message is regenerated and streamed anew. Every
    other text opens as a draft that an edit corrects; half of these target the message by its number.
    After a conversation's last turn an answer and a question follow that a regeneration of that turn
    discards, before its text comes again. Folding the log gives ``turns`` back, in the order of turn, role
    and text. Null and empty texts stream empty deltas; a long text is cut into ``PIECES`` like any other;
    further columns are ignored.
    """
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    named = turns.select("conv_id", "turn", text_or_empty("role").alias("role"), text_or_empty().alias("text"))
    placed = named.withColumns(
        {"at": F.row_number().over(place) - 1, "ends": F.lead(F.lit(1)).over(place).isNull()}
    ).withColumns(
        {
            "chance": F.pmod(F.xxhash64("conv_id", "turn"), F.lit(2)) == 0,
            "size": F.ceil(F.char_length("text") / F.lit(PIECES)).cast("int"),
            "trained": F.col("role").isin(*TRAINED_ROLES),
        }
    )

    def event(step: int, kind: str, text: Column, role: Column | None = None, target: Column | None = None) -> Column:
        return F.struct(
            F.lit(step).alias("step"),
            F.lit(kind).alias("kind"),
            (F.lit(None) if target is None else target).cast("int").alias("target"),
            (F.lit(None) if role is None else role).cast("string").alias("role"),
            text.alias("text"),
        )

    empty, draft = F.lit(""), F.concat(F.lit("draft: "), F.reverse("text"))
    role, own = F.col("role"), F.col("at")
    piece = [F.substring(F.col("text"), F.lit(k) * F.col("size") + 1, F.col("size")) for k in range(PIECES)]
    streamed = [event(2 + k, "delta", piece[k]) for k in range(PIECES)]
    answer = F.when(
        F.col("chance"), F.array(event(0, "message", draft, role), event(1, "regenerate", empty), *streamed)
    ).otherwise(F.array(event(0, "message", empty, role), *streamed))
    edited = F.when(F.col("chance"), event(1, "edit", F.col("text"), target=own)).otherwise(
        event(1, "edit", F.col("text"))
    )
    said = F.when(F.col("trained"), answer).otherwise(F.array(event(0, "message", draft, role), edited))
    branch = F.array(
        event(5, "message", draft, F.lit(TRAINED_ROLES[0])),
        event(6, "message", F.col("text"), F.lit("user")),
        event(7, "regenerate", empty, target=own),
        event(8, "delta", F.col("text"), target=own),
    )
    events = F.when(F.col("ends"), F.concat(said, branch)).otherwise(said)
    return placed.select("conv_id", "at", F.inline(events)).select(
        "conv_id", (F.col("at") * STEPS + F.col("step")).alias("seq"), "kind", "target", "role", "text"
    )


def fold(events: DataFrame) -> DataFrame:
    """The final messages, ``conv_id, message, role, text``, of an event log."""
    log = events.select(
        "conv_id",
        "seq",
        F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("what"),
        "target",
        text_or_empty("role").alias("role"),
        text_or_empty().alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("seq", "what", "target", "role", "text")
    opened = F.sum(F.when(F.col("what") == 1, 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    numbered = log.withColumns({"at": F.row_number().over(order), "latest": opened - 1}).withColumn(
        "message", F.when(F.col("what") == 1, F.col("latest")).otherwise(F.coalesce("target", "latest"))
    )
    event = F.struct("at", "what", "role", "text")
    folded = numbered.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(event)).alias("log"),
        F.max(F.when(F.col("what") == 1, F.col("at"))).alias("opened_at"),
        F.max(F.when(F.col("what") >= 3, F.col("at"))).alias("reset_at"),
        F.max(F.when(F.col("what") == 4, F.col("at"))).alias("branched_at"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    since = F.greatest("opened_at", "reset_at")
    live = folded.where(F.col("opened_at").isNotNull()).withColumn(
        "cut_at", F.max("branched_at").over(earlier)
    )
    return live.where(F.coalesce(F.col("cut_at") < F.col("opened_at"), F.lit(True))).select(
        "conv_id",
        "message",
        F.filter("log", lambda e: e["what"] == 1)[0]["role"].alias("role"),
        F.array_join(
            F.transform(
                F.filter("log", lambda e: (e["at"] >= since) & (e["what"] > 0)), lambda e: e["text"]
            ),
            "",
        ).alias("text"),
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(messages: DataFrame, trained_roles: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """``conv_id, formatted, loss_spans``: the rendered text and where the loss applies.

    ``loss_spans`` are (start, end) code points of ``formatted``, end exclusive: the escaped text
    of each trained role's turn, without its marks.
    """
    turn = F.struct(
        "message",
        F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        F.col("role").isin(*trained_roles).alias("trained"),
    )
    tail = END + "\n"
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def place(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(t["head"])
        end = start + F.char_length(t["body"])
        span = F.struct(start.alias("start"), end.alias("end"), t["trained"].alias("trained"))
        return F.struct((end + len(tail)).alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    nothing = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int,trained:boolean>>").alias("spans"),
    )
    return turns.select(
        "conv_id",
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), ""
        ).alias("formatted"),
        F.transform(
            F.filter(F.aggregate("turns", nothing, place, lambda acc: acc["spans"]), lambda s: s["trained"]),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
        ).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text`` parsed from the rendered text and its spans alone."""

    def parse(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.char_length(head) + 2, F.char_length(part) - F.char_length(head) - 1)
        return F.struct(_unescape_role(head).alias("role"), unescape(body).alias("text"))

    # What follows a mark up to the end mark; the piece before the first mark is empty.
    parts = F.transform(
        F.filter(F.split("formatted", r"<\|im_start\|>"), lambda p: p != ""),
        lambda p: F.substring(p, F.lit(1), F.char_length(p) - len(END + "\n")),
    )
    return rendered.select(
        "conv_id",
        F.transform(parts, parse).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans",
                lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
            ),
            "",
        ).alias("loss_text"),
        "formatted",
    )


def digest(parsed: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_back`` found."""
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
