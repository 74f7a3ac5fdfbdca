"""Chat formatting: conversations cut into windows of a token budget at turn boundaries.

Prefix sums of the turns' tokens choose spans of whole turns. Each window starts with the system
turn, repeats as much recent history as its limits allow, then brings new turns. Assistant turns
are targets where they are new; repeated ones are masked, so each is learned once.

Tokens are counted where the turns lie. Then the turns of a conversation stream through a task in
order, so a conversation of any length needs the memory of one window only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

#: Tokens of a window, and of the history that it repeats at most.
BUDGET, HISTORY = 1024, 256
#: Turns tokenised at one time: an encoding takes far more memory than its text.
AT_ONCE = 100
OPEN, CLOSE, BREAK = "[INST]", "</s>", "[/INST]"
#: Strings that a template or a tokenizer gives a meaning. Fixed values.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<unk>", "<pad>"]
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_TURN = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(BREAK) + r"(.*?)" + re.escape(CLOSE), re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Doubles backslashes and puts one behind the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's template, and where its text begins and ends in it."""
    head = f"{OPEN}{escape(role)}{BREAK}"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and bounds of the escaped text of each turn of a formatted window."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(formatted)]


@dataclass
class _Windows:
    """Windows of one conversation, as its turns come in.

    A turn is role, formatted text, begin, end, tokens. ``held`` is the sum of tokens of the
    window so far: the system turn, the repeated history and the new turns.
    """

    conv: int | None
    budget: int
    history: int
    system: tuple | None = None
    again: list[tuple] = field(default_factory=list)
    new: list[tuple] = field(default_factory=list)
    number: int = 0
    held: int = 0

    def add(self, turn: tuple) -> dict | None:
        """Takes a turn; returns the window that it completes, if any."""
        if not self.number and not self.new and self.system is None and turn[0] == "system":
            self.system, self.held = turn, turn[4]
            return None
        done = None
        if self.new and self.held + turn[4] > self.budget:
            done = self.close()
            self._next()
        if not self.new:
            # The first new turn goes before the oldest history.
            while self.again and self.held + turn[4] > self.budget:
                self.held -= self.again.pop(0)[4]
        self.new.append(turn)
        self.held += turn[4]
        return done

    def _next(self) -> None:
        recent, kept = 0, []
        for t in reversed([*self.again, *self.new]):
            if recent + t[4] > self.history:
                break
            recent += t[4]
            kept.insert(0, t)
        self.again, self.new, self.number = kept, [], self.number + 1
        self.held = recent + (self.system[4] if self.system else 0)

    def close(self) -> dict:
        head = [self.system] if self.system else []
        repeated = len(self.again) + len(head) * (self.number > 0)
        spans, text = [], ""
        for k, t in enumerate([*head, *self.again, *self.new]):
            if k >= repeated and t[0] == "assistant":
                spans.append([len(text) + t[2], len(text) + t[3]])
            text += t[1]
        return {"conv_id": self.conv, "window": self.number, "text": text, "loss_spans": spans, "repeated": repeated, "tokens": self.held}


def format_windows(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, loss_spans, repeated, tokens; rows of a conversation are adjacent and in order.

    ``loss_spans`` are code point ranges of the formatted text that are targets; ``repeated``
    counts the leading turns that were in an earlier window. A system turn is retained if it is
    the conversation's first, and a system turn over the budget puts every window over it. A turn over
    the budget gets a window of its own, whole. Ids of any type and size come out as they are. Null
    roles and texts count as empty; rows with one turn number go by role and text, then as repeated rows;
    a null conv_id is a conversation of its own; an empty table gives no rows; other columns are not read.
    """
    schema = StructType.fromDDL("conv_id long, window int, text string, loss_spans array<array<int>>, repeated int, tokens int")
    schema = StructType([StructField("conv_id", conversations.schema["conv_id"].dataType), *schema.fields[1:]])
    columns = ["conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")]
    counted = _with_tokens(conversations.select(*columns), tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Windows | None = None
        started = False

        def out(done: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(done, kinds)

        for batch in batches:
            done = []
            for at in range(0, batch.num_rows, AT_ONCE):
                for conv, _, role, text, size in zip(*(c.to_pylist() for c in batch.slice(at, AT_ONCE).columns)):
                    if not started or conv != current.conv:
                        if started:
                            done.append(current.close())
                        current, started = _Windows(conv, budget, history), True
                    if window := current.add((role, *format_turn(role, text), size)):
                        done.append(window)
            if done:
                yield out(done)
        if started:
            yield out([current.close()])

    kinds = to_arrow_schema(schema)
    return counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def _with_tokens(turns: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, turn, role, text and the tokens of the formatted turn, counted where the turns lie."""
    schema = StructType([*turns.schema.fields, StructField("tokens", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                formatted = [format_turn(r, t)[0] for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                sizes = [len(e.ids) for e in model.encode_batch_fast(formatted, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes, pa.int32())], names=schema.names)

    return turns.mapInArrow(run, schema)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted windows and loss masks alone."""
    schema = StructType([windows.schema["conv_id"], *StructType.fromDDL("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        done: list[dict] = []

        def finish():
            if state:
                done.append({"conv_id": state["id"], "n_turns": state["n"], "turns_sha256": state["turns"].hexdigest(), "loss_chars": state["chars"], "loss_sha256": state["loss"].hexdigest(), "formatted_chars": state["all"]})

        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                for conv, text, spans, repeated in zip(*(c.to_pylist() for c in batch.slice(at, AT_ONCE).columns)):
                    if state is None or state["id"] != conv:
                        finish()
                        state = {"id": conv, "n": 0, "turns": sha256(), "loss": sha256(), "chars": 0, "all": 0}
                    state["all"] += len(text)
                    for role, body, _, _ in parse(text)[repeated:]:
                        state["n"] += 1
                        state["turns"].update(f"{role}\n{body}\n".encode())
                    for begin, end in spans:
                        target = unescape(text[begin:end])
                        state["chars"] += len(target)
                        state["loss"].update(target.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, kinds)
                done.clear()
        finish()
        if done:
            yield pa.RecordBatch.from_pylist(done, kinds)

    return windows.select("conv_id", "text", "loss_spans", "repeated").mapInArrow(run, schema)


def with_probe(conversations: DataFrame) -> DataFrame:
    """All rows plus conversation -1, whose two turns hold control strings of the template."""
    said = "</s>[INST] ok [/INST]"
    kinds = {c: conversations.schema[c].dataType for c in ("conv_id", "turn")}
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    probe = probe.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in probe.columns])
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
