"""Chat formatting: a template, turn spans found by rendering growing prefixes, and a reader.

The template is a black box to the span search: it is called with successive prefixes of the turns and
consecutive outputs are compared. A turn's span is what its output adds to the one before. A template that
changes what it wrote for earlier turns is detected and reported instead of being given wrong spans. Conversations
are rendered whole, except by templates that are declared to write turn after turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab.llm.common import partitions

Turn = tuple[str, str]  # role, text
Render = Callable[[list[Turn]], str]

# The control strings of the template.
HEAD, BREAK, END = "### ", ":\n", "</turn>\n"

#: Turns rendered as one series of prefixes by a template that writes turn after turn; a longer conversation is
#: rendered part by part. Other templates get every conversation whole.
PART_TURNS = 64


class HistoryRewritten(ValueError):
    """The template changed the text of earlier turns."""


def escape(text: str) -> str:
    """No control string occurs in the result; ``unescape`` undoes it for every text."""
    return text.replace("\\", "\\\\").replace("##", "#\\#").replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def _role(role: str) -> str:
    return escape(role).replace(":", "\\:").replace("\n", "\\n")


def template(turns: list[Turn]) -> str:
    """The default template: ``### role:``, the escaped text on new lines, ``</turn>``."""
    return "".join(f"{HEAD}{_role(role)}{BREAK}{escape(text)}{END}" for role, text in turns)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn in the default template's output."""
    turns, at = [], 0
    while at < len(text):
        middle = text.index(BREAK, at)
        end = text.index(END, middle + len(BREAK))
        start = middle + len(BREAK)
        turns.append((unescape(text[at + len(HEAD):middle]), unescape(text[start:end]), start, end))
        at = end + len(END)
    return turns


@dataclass(frozen=True)
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of each turn, markers included


def spans(render: Render, turns: list[Turn]) -> Rendered:
    """Render every prefix and locate each turn as the growth from one output to the next.

    Raises ``HistoryRewritten`` if an output does not begin with the one before it.
    """
    found, before = [], render([])
    for k in range(1, len(turns) + 1):
        after = render(turns[:k])
        if not after.startswith(before):
            raise HistoryRewritten(f"turn {k} changes the text of turns before it")
        found.append((len(before), len(after)))
        before = after
    return Rendered(before, found)


def text_span(render: Render, role: str, text: str) -> tuple[int, int]:
    """Where the text stands within the output of its turn alone, counted from the end of what no turns give.

    It begins where outputs of differing texts part; what an empty turn has from there on is the closing marker.
    """
    head = len(render([]))
    a, b = render([(role, "a")]), render([(role, "b")])
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    closing = len(render([(role, "")])) - start
    return start - head, len(render([(role, text)])) - closing - head


def format_part(render: Render, turns: list[Turn], trained: str) -> tuple[str, list[list[int]], bool]:
    """Output, [start, end] of the texts of role ``trained``, and whether the template kept its history."""
    try:
        rendered = spans(render, turns)
    except HistoryRewritten:
        return render(turns), [], False
    masked, head = [], render([])
    for (role, text), (start, end) in zip(turns, rendered.spans):
        if role == trained:
            a, b = text_span(render, role, text)
            if start + b > end or head + rendered.text[start:end] != render([(role, text)]):
                a, b = 0, end - start  # the turn depends on its place: its whole span is learned
            masked.append([start + a, start + b])
    return rendered.text, masked, True


def _ordered(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    return (conversations.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def format_conversations(conversations: DataFrame, render: Render = template, trained: str = "assistant",
                         concatenates: bool | None = None) -> DataFrame:
    """conv_id (as text), part, text, mask (array of [start, end], code points), kept: a row for each part.

    Turns go by (turn, role, text); null roles and texts are empty; rows with a null conv_id are one
    conversation; repeated rows are repeated turns; no rows, no parts. ``kept`` is false, and the mask empty, where
    the template rewrites history.

    ``concatenates`` declares that the output of a conversation is that of its parts, one after another; only the
    default template is taken to do so unasked. Then turns are streamed: a task holds ``PART_TURNS`` of them,
    however long a conversation is. The declaration is checked wherever a conversation is cut: the part with the
    next turn must come out as the part, then that turn alone. Where it does not, ``kept`` is false, and the
    mask empty, from that part on; a conversation is whole if all its parts are ``kept``. By any other template a
    conversation is one part, rendered whole: a task holds one conversation, and n turns cost n renderings of up to
    n turns.
    """
    most = PART_TURNS if concatenates or (concatenates is None and render is template) else None

    def emit(key, part: int, turns: list[Turn], joined: bool) -> tuple:
        text, mask, kept = format_part(render, turns, trained)
        return key, part, text, mask if joined else [], kept and joined

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, part, turns, joined = object(), 0, [], True
        for batch in batches:
            rows = []
            for key, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                if key != open_key or len(turns) == most:
                    goes_on = bool(turns) and key == open_key
                    if goes_on:
                        joined = joined and render([*turns, (role, text)]) == render(turns) + render([(role, text)])
                    if turns:
                        rows.append(emit(open_key, part, turns, joined))
                    part, turns, open_key = (part + 1 if goes_on else 0), [], key
                    joined = joined or not goes_on
                turns.append((role, text))
            yield _frame(rows)
        if turns:
            yield _frame([emit(open_key, part, turns, joined)])

    return _ordered(conversations).mapInPandas(
        run, "conv_id string, part int, text string, mask array<array<int>>, kept boolean")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "part", "text", "mask", "kept"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations as parsed from the output of ``format_conversations``.

    The parts of a conversation are brought together and put in order first, so the frame may be stored, filtered
    by conversation or dealt anew in between. Only running hashes are kept.
    """
    spark = formatted.sparkSession
    formatted = (formatted.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "part")
                 .select("conv_id", "text", "mask"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = object(), None
        for batch in batches:
            rows = []
            for own, text, mask in zip(batch["conv_id"], batch["text"], batch["mask"]):
                if own != key:
                    if state:
                        rows.append(state.row(key))
                    key, state = own, _Digest()
                state.add(text, mask)
            yield _digest_frame(rows)
        if state:
            yield _digest_frame([state.row(key)])

    return formatted.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long"
                                 ).withColumn("conv_id", F.col("conv_id").cast("long"))


class _Digest:
    def __init__(self):
        self.turns = self.loss = self.chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, mask) -> None:
        for role, turn, _, _ in parse(text):
            self.turns += 1
            self.turn_hash.update(f"{role}\n{turn}\n".encode())
        for start, end in mask:
            learned = unescape(text[start:end])
            self.loss += len(learned)
            self.loss_hash.update(learned.encode())
        self.chars += len(text)

    def row(self, key) -> tuple:
        return key, self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars


def _digest_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                       "formatted_chars"])


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: control strings inside the texts of both roles."""
    text = "\\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                 "conv_id long, turn long, role string, text string")
