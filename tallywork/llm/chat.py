"""Chat formatting with a declarative template, in DataFrame functions only.

A finite-state machine over the roles says whether the turns of a conversation come in a valid order.
The template writes every turn as segments of text, each with a flag that says whether the loss
counts it, and the formatted text is the segments one after the other.

Control strings inside texts and roles are escaped: every backslash is doubled, and then a single
backslash goes after the first character of whatever starts a control string. A single backslash is
never next to a doubled one, so reading back takes one backslash off each run that starts a pair and
drops the single ones.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are written and which roles may follow each other.

    ``opening`` + role + ``before_text`` + text + ``closing`` is one turn. ``starts`` maps the first
    character of control strings to what may follow it, as a regular expression; it covers the three
    marks of the template. ``order`` maps a state of the machine to the roles that may come next; a
    role that comes is the next state, and ``start`` is the first one. A conversation is valid if it
    ends in one of the states ``accepting``.
    """

    opening: str = "<|turn|>"
    before_text: str = "<|text|>"
    closing: str = "<|end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    starts: dict[str, str] = field(
        default_factory=lambda: {"<": r"\||/?s>", r"\[": r"/?INST\]"}
    )
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    accepting: tuple[str, ...] = ("assistant",)


def escape(text: Column, template: ChatTemplate) -> Column:
    doubled = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE * 2))
    start = "|".join(f"{first}(?={rest})" for first, rest in template.starts.items())
    return F.regexp_replace(doubled, start, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _valid(turns: Column, template: ChatTemplate) -> Column:
    """Whether the machine accepts the roles of ``turns``, in order."""
    steps = [(f"{a}\n{b}", b) for a, following in template.order.items() for b in following]
    table = F.create_map(*(F.lit(x) for step in steps for x in step))

    def move(state: Column, turn: Column) -> Column:
        return F.coalesce(F.try_element_at(table, F.concat_ws("\n", state, turn["role"])), F.lit(""))

    return F.aggregate(turns, F.lit("start"), move).isin(*template.accepting)


def format_chats(
    turns: DataFrame,
    template: ChatTemplate,
    *,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``key``, ``valid``, ``segments`` (text, loss) and ``formatted``.

    Turns go by ``turn``, a NULL first; rows with one turn number go by role and text, and repeated
    rows stay. NULL roles and texts count as empty; an empty or unknown role makes the order invalid but
    is formatted all the same. Rows with a NULL key form one conversation. An empty table gives an
    empty result; other columns are not read, whatever their names.

    A conversation comes together once, as the one row that it is in the result.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = turns.select(
        F.col(key).alias("_key"),
        F.struct(F.col(turn).alias("turn"), who.alias("role"), said.alias("text")).alias("_turn"),
    )
    grouped = rows.groupBy("_key").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(t: Column) -> Column:
        before = F.concat(
            F.lit(template.opening), escape(t["role"], template), F.lit(template.before_text)
        )
        return F.array(
            segment(before, F.lit(False)),
            segment(escape(t["text"], template), t["role"].isin(*template.loss_roles)),
            segment(F.lit(template.closing), F.lit(False)),
        )

    segments = F.flatten(F.transform("_turns", written))
    return grouped.select(
        F.col("_key").alias(key),
        _valid(F.col("_turns"), template).alias("valid"),
        segments.alias("segments"),
    ).withColumn("formatted", F.array_join("segments.text", ""))


def _literally(mark: str) -> str:
    return rf"\Q{mark}\E"


def read_back(formatted: Column, template: ChatTemplate) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    # what follows the last closing mark is empty
    parts = F.split(formatted, _literally(template.closing))
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def parse(part: Column) -> Column:
        both = F.split(part, _literally(template.before_text))
        role = F.substr(both[0], F.lit(len(template.opening) + 1))
        return F.struct(unescape(role).alias("role"), unescape(both[1]).alias("text"))

    return F.transform(parts, parse)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    counted = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(counted, lambda s: unescape(s["text"])), "")


def digests(chats: DataFrame, template: ChatTemplate, *, key: str = "conv_id") -> DataFrame:
    """Digests of what can be read back from the result of ``format_chats``."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chats.select(
        key,
        "valid",
        read_back(F.col("formatted"), template).alias("turns"),
        loss_text(F.col("segments")).alias("loss"),
        F.char_length("formatted").alias("chars"),
    )
    return read.select(
        key,
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").cast("bigint").alias("formatted_chars"),
        "valid",
    )
