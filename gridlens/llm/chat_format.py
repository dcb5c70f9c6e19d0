"""Chat formatting: every assistant turn becomes a training example with all turns before it as context.

An example is written out: the formatted text from the start of its conversation up to the end of its own reply, with
only the reply trainable. All examples of a conversation together grow with the square of its length, but memory does
not: a task reads a conversation turn by turn, and texts leave it in parts of `PART` code points. Whole parts of a
context that later examples repeat wait in a temporary file.

Template: ``<s>[INST] text [/INST]`` for a user, ``<s> text</s>`` for an assistant, ``<s>[ROLE]role[/ROLE] text</s>``
for any other role. Inside texts a backslash is doubled and each control string gets one after its first letter.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.textops import prepare

#: The strings that mark turns.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"\[INST\] (?P<user>.*) \[/INST\]|\[ROLE\](?P<role>.*)\[/ROLE\] (?P<other>.*)</s>| (?P<reply>.*)</s>",
                   re.DOTALL)
#: Code points of output that a batch holds at most, but for a last row, and those of a part of an example.
OUT_CHARS = 4 << 20
PART = 1 << 20


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its trainable part begins and ends (equal if it has none)."""
    body = escape(text)
    if role == "user":
        return f"<s>[INST] {body} [/INST]", 0, 0
    if role == "assistant":
        return f"<s> {body}</s>", 4, 4 + len(body)
    return f"<s>[ROLE]{escape(role)}[/ROLE] {body}</s>", 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out = []
    for part in formatted.split("<s>")[1:]:
        m = _TURN.fullmatch(part)
        if m["user"] is not None:
            out.append(("user", unescape(m["user"])))
        elif m["reply"] is not None:
            out.append(("assistant", unescape(m["reply"])))
        else:
            out.append((unescape(m["role"]), unescape(m["other"])))
    return out


EXAMPLES = "conv long, example long, part long, text string, loss_start long, loss_end long"
_KINDS = pa.schema([("conv", pa.int64()), ("example", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                    ("loss_start", pa.int64()), ("loss_end", pa.int64())])


class _Prefix:
    """The formatted text of a conversation so far: whole parts in a temporary file, the rest in memory."""

    def __init__(self, size: int):
        self.size, self.file, self.ends, self.rest, self.length = size, None, [0], [], 0

    def add(self, segment: str) -> None:
        self.rest.append(segment)
        self.length += len(segment)
        if self.length - self.size * (len(self.ends) - 1) < self.size:
            return
        text = "".join(self.rest)
        self.file = self.file or tempfile.TemporaryFile()
        while len(text) >= self.size:
            self.file.seek(self.ends[-1])
            self.ends.append(self.ends[-1] + self.file.write(text[: self.size].encode()))
            text = text[self.size :]
        self.rest = [text]

    def parts(self) -> Iterator[str]:
        for low, high in zip(self.ends, self.ends[1:]):
            self.file.seek(low)
            yield self.file.read(high - low).decode()
        self.rest = ["".join(self.rest)]
        if self.rest[0] or len(self.ends) == 1:
            yield self.rest[0]

    def close(self) -> None:
        if self.file:
            self.file.close()


def _expander(size: int):
    """Rows in conversation order to the parts of their examples, of so many code points each."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, prefix, examples, trained = object(), None, 0, True
        rows: list[tuple] = []
        held = 0

        def example(number: int | None, low: int | None, high: int | None) -> Iterator[pa.RecordBatch]:
            nonlocal rows, held
            for k, text in enumerate(prefix.parts()):
                rows.append((conv, number, k, text, low, high))
                held += len(text)
                if held >= OUT_CHARS:
                    yield _batch(rows)
                    rows, held = [], 0

        def close() -> Iterator[pa.RecordBatch]:
            if prefix is not None:
                if not trained:
                    yield from example(None, None, None)
                prefix.close()

        for batch in batches:
            for c, role, text in zip(*(col.to_pylist() for col in batch.columns)):
                if prefix is None or c != conv:
                    yield from close()
                    conv, prefix, examples = c, _Prefix(size), 0
                segment, low, high = format_turn(role or "", text or "")
                at, trained = prefix.length, role == "assistant"
                prefix.add(segment)
                if trained:
                    yield from example(examples, at + low, at + high)
                    examples += 1
        yield from close()
        yield _batch(rows)
    return task


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_KINDS)], schema=_KINDS)


def expand_prefix_targets(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                          text_col: str = "text", part: int = PART) -> DataFrame:
    """The training examples, one an assistant turn: ``conv``, ``example`` (numbered from 0 in the conversation),
    ``text`` (all turns before the reply and the reply, formatted), and ``loss_start`` and ``loss_end``, the code
    points of that text that are trainable. A text longer than ``part`` code points comes as several rows, ``part``
    numbered from 0; most have one. Where a conversation does not end with a reply, a last text with a null
    ``example`` holds the whole conversation, so that every turn is in the output.

    Turns are ordered by turn, role and text, nulls first, so ties and repeated rows have one order. A null text or
    role is empty; a null conversation id is a conversation of its own. Other columns are not carried. An empty
    table gives an empty table. A partition holds conversations whole and sorted, as spilled runs of a sort; the
    task streams through it, so a conversation may be larger than memory. Rows leave in conversation order.
    """
    prepare(df.sparkSession)
    names = {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col}
    rows = df.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()])
    rows = rows.withColumn("conv", F.col("conv").cast("long"))
    return (rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
            .select("conv", "role", "text").mapInArrow(_expander(part), EXAMPLES))


def full_examples(examples: DataFrame) -> DataFrame:
    """The examples alone, without the texts of conversations that do not end with a reply."""
    return examples.where(F.col("example").isNotNull())


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "n_examples long")


class _Reader:
    """Reads a conversation back from its examples. A context must be the text before it; only what is new is parsed."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.n_examples = self.length = 0
        self.known: list[bytes] = []  # digests of the parts of the text before, but for the last
        self.last = self.pending = ""  # its last part, and what of it is not parsed yet
        self.at, self.masked = 0, []

    def read(self, example: int | None, part: int, text: str, low: int | None, high: int | None) -> None:
        if part == 0:
            self.end()
            if example is not None:
                self.n_examples += 1
        elif part == len(self.known) + 1:  # the last part is whole now
            self.known.append(hashlib.sha256(self.last.encode()).digest())
            self.last = ""
        if part < len(self.known):
            if hashlib.sha256(text.encode()).digest() != self.known[part]:
                raise ValueError("the context of an example is not the text before it")
        elif part > len(self.known) or not text.startswith(self.last):
            raise ValueError("the context of an example is not the text before it")
        else:
            self.pending += text[len(self.last) :]
            self.last = text
            cut = self.pending.rfind("<s>")
            if cut > 0:
                self._parse(self.pending[:cut])
                self.pending = self.pending[cut:]
        if low is not None:
            self.masked.append(text[max(low - self.at, 0) : max(high - self.at, 0)])
        self.at += len(text)

    def _parse(self, formatted: str) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1

    def end(self) -> None:
        """The text is read to its end: its last turn is whole, and so is its reply."""
        if self.at < self.length:
            raise ValueError("the context of an example is not the text before it")
        self._parse(self.pending)
        reply = unescape("".join(self.masked))
        self.loss.update(reply.encode())
        self.loss_chars += len(reply)
        self.length, self.pending, self.at, self.masked = self.at, "", 0, []

    def row(self) -> list:
        self.end()
        return [self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.length,
                self.n_examples]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST.split(", ")]
    reader, out = None, []
    for batch in batches:
        for c, *cells in zip(*(col.to_pylist() for col in batch.columns)):
            if reader is None or c != reader.conv:
                if reader is not None:
                    out.append(reader.row())
                reader = _Reader(c)
            reader.read(*cells)
        yield _table(out, names)
        out = []
    yield _table([reader.row()] if reader is not None else [], names)


def _table(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the output of `expand_prefix_targets` in its order: turns, digests of the turns and of
    the text under the loss masks of its examples, and the length of the formatted text. Every example's context is
    compared with the text before it; one that differs is an error."""
    return examples.select("conv", "example", "part", "text", "loss_start", "loss_end").mapInArrow(_digest, DIGEST)
