"""Chat formatting in budgeted windows.

A conversation's turns become text with marked turns; prefix sums of the turns' tokens choose turn-aligned windows
under a token budget. Every window starts with the system turn, if the conversation has one, and a limited history
of turns that earlier windows already hold; the loss mask covers each assistant text once, in the window where it
is new. A single turn over the budget has a window of its own and stays whole.

Template: ``### role: text </turn>`` and a line feed. Inside roles and texts a backslash, ``#`` and ``<`` (in roles
also ``:``) are written as a backslash and a letter, so no text can hold a mark and the reading is exact.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, tokenizer_path

_OUT = str.maketrans({"\\": "\\\\", "#": "\\h", "<": "\\l"})
_OUT_ROLE = str.maketrans({"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"})
_IN = {"\\": "\\", "h": "#", "l": "<", "c": ":"}
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ([^:]*): ([^<]*) </turn>\n")
_CLOSE = " </turn>\n"

WINDOWS = ("conv_id long, window int, text string, repeated int, n_tokens long, "
           "loss array<struct<start:int,end:int>>")
_ARROW = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("text", pa.string()), ("repeated", pa.int32()),
                    ("n_tokens", pa.int64()),
                    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _IN[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its escaped text starts and ends in it."""
    head, body = f"### {role.translate(_OUT_ROLE)}: ", text.translate(_OUT)
    return head + body + _CLOSE, len(head), len(head) + len(body)


def read_turns(window: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(window)]


class _Conversation:
    """Takes the turns of one conversation in order and gives its windows; keeps one window and its history."""

    def __init__(self, conv_id, budget: int, history: int):
        self.id, self.budget, self.history = conv_id, budget, history
        self.number, self.total = 0, 0
        self.system = None
        self.repeated: list = []  # system and history of the window
        self.new: list = []
        self.new_at = 0  # prefix sum where the new turns begin
        self.past: deque = deque()  # turns that may be repeated, with the prefix sum before each
        self.first = True

    def _size(self) -> int:
        return sum(t[3] for t in self.repeated)

    def close(self):
        """The window so far."""
        text, loss, at = [], [], 0
        for k, (formatted, start, end, _, role, _) in enumerate([*self.repeated, *self.new]):
            if k >= len(self.repeated) and role == "assistant" and end > start:
                loss.append({"start": at + start, "end": at + end})
            text.append(formatted)
            at += len(formatted)
        row = (self.id, self.number, "".join(text), len(self.repeated), self._size() + self.total - self.new_at, loss)
        self.number += 1
        return row

    def add(self, role: str, formatted: str, start: int, end: int, tokens: int):
        """A window that the turn completes, or None."""
        turn = (formatted, start, end, tokens, role, self.total)
        done = None
        if self.new and self._size() + self.total + tokens - self.new_at > self.budget:
            done = self.close()
            kept = [self.system] if self.system else []
            room = min(self.history, self.budget - tokens - sum(t[3] for t in kept))
            # of the prefix sums, those within reach of the end are the history
            past = [t for t in self.past if self.total - t[5] <= room and t is not self.system]
            self.repeated = kept + past if tokens + sum(t[3] for t in kept) <= self.budget else kept
            self.new, self.new_at = [], self.total
        if self.first and role == "system":
            self.system = turn
        self.first = False
        self.new.append(turn)
        self.total += tokens
        self.past.append(turn)
        while self.past and self.total - self.past[0][5] > self.history:
            self.past.popleft()
        return done


def chat_windows(conversations: DataFrame, budget: int = 1024, history: int = 256,
                 tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Windows of every conversation, from rows (conv_id, turn, role, text).

    Turns go by turn (null first), equal ones by role and formatted text, so repeated rows are kept and reruns agree;
    null roles and texts count as empty; rows without conv_id form one conversation. Other columns are ignored. Turns
    are formatted and their tokens counted where the rows lie; then a conversation's turns stream through one task in
    order, which only sums, and holds one window of it at a time.
    """
    path = tokenizer_path(tokenizer)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        encode = Tokenizer.from_file(path)
        for batch in batches:
            roles, texts = (batch.column(c).to_pylist() for c in ("role", "text"))
            turns = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
            tokens = [len(e) for e in encode.encode_batch([t[0] for t in turns], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array([t[0] for t in turns], pa.string()),
                 *[pa.array(c, pa.int32()) for c in ([t[1] for t in turns], [t[2] for t in turns], tokens)]],
                ["conv_id", "turn", "role", "formatted", "first", "last", "tokens"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk = None
        for batch in batches:
            rows = []
            for conv_id, *turn in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "formatted", "first", "last", "tokens")], strict=True):
                if talk is None or talk.id != conv_id:
                    if talk is not None:
                        rows.append(talk.close())
                    talk = _Conversation(conv_id, budget, history)
                if (done := talk.add(*turn)) is not None:
                    rows.append(done)
            yield _batch(rows, _ARROW)
        if talk is not None:
            yield _batch([talk.close()], _ARROW)

    rows = conversations.selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "coalesce(role, '') role", "coalesce(text, '') text")
    rows = rows.mapInArrow(formatted, "conv_id long, turn long, role string, formatted string, first int, last int, tokens int")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return rows.mapInArrow(windows, WINDOWS)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                     ("n_windows", pa.int64())])


def window_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from the text and masks of its windows.

    Works on the rows as ``chat_windows`` leaves them: a conversation's windows together and in order.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if now is None or now[0] != row["conv_id"]:
                    if now is not None:
                        rows.append(_finished(now))
                    now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in read_turns(row["text"])[row["repeated"]:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    masked = unescape(row["text"][span["start"]:span["end"]])
                    now[3] += len(masked)
                    now[4].update(masked.encode())
                now[5] += len(row["text"])
                now[6] += 1
            yield _batch(rows, _DIGEST)
        if now is not None:
            yield _batch([_finished(now)], _DIGEST)

    return windows.mapInArrow(digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long, n_windows long")


def _finished(now: list) -> tuple:
    return (now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5], now[6])


#: The conversation that the contract adds: both texts hold the marks of common templates.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op4_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the added one."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return window_digests(chat_windows(rows.unionByName(extra)))
