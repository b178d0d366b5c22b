r"""Chat formatting of messages with typed content parts.

A message has a role and parts: text, or a reference to an image, an audio clip or a document. A visitor flattens the
parts in order: text is escaped, an attachment becomes a numbered placeholder, and its reference is recorded with the
number of tokens that the placeholder stands for. A turn is

    <|im_start|>role<|im_sep|>content<|im_end|>

and a conversation is its turns one after another. Control strings inside a text or role are broken by a backslash after
their first character, and a backslash is doubled, so that the template's own marks are the only ones in the output and
every text can be read back exactly.

Each turn is formatted by itself, without a shuffle, so that a conversation of any length is spread over tasks; the
output keeps the order columns. Reading a conversation back digests its turns in order, in a stream: a task holds one
batch of rows, not a conversation.

Defined cases: NULL text is empty, NULL role an empty role; turns are ordered by turn (NULL first), then role and text,
unescaped and byte by byte;
repeated rows are repeated turns; NULL conv_id is a conversation of its own; a part of unknown type is a placeholder of
no tokens, with its text as reference; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ATTACHMENT = re.compile(r"<\|(image|audio|document|part):(\d+)\|>")
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*)" + re.escape(STOP), re.S)
# Control strings of this and of other common templates; a backslash escapes.
CONTROL = re.compile(r"\\|<(?=\||/?s>)|\[(?=/?INST\])")
ESCAPED = re.compile(r"\\(\\?)")

PART = "struct<type: string, text: string, uri: string, width: int, height: int, seconds: double, pages: int>"
FORMATTED = ("formatted string, loss_start array<int>, loss_end array<int>, text_tokens int, "
             "attachments array<struct<number: int, type: string, uri: string, at: int, tokens: int>>")


@dataclass(frozen=True)
class Costs:
    """Tokens that attachments expand to."""

    patch: int = 28  # pixels of an image patch's side; one token each
    most_patches: int = 4096
    audio_rate: float = 12.5  # tokens a second
    page: int = 1024  # tokens a document page


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of one message in order."""

    costs: Costs = Costs()
    text: str = ""
    spans: list[tuple[int, int]] = field(default_factory=list)  # of texts, in the flattened content
    attachments: list[tuple[int, str, str | None, int, int]] = field(default_factory=list)

    def visit(self, part) -> None:
        kind = part["type"] if part["type"] in ("text", "image", "audio", "document") else "other"
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part) -> None:
        added = escape(part["text"] or "")
        self.spans.append((len(self.text), len(self.text) + len(added)))
        self.text += added

    def visit_image(self, part) -> None:
        patches = math.ceil((part["width"] or 0) / self.costs.patch) * math.ceil((part["height"] or 0) / self.costs.patch)
        self._attach("image", part["uri"], min(patches, self.costs.most_patches))

    def visit_audio(self, part) -> None:
        self._attach("audio", part["uri"], math.ceil((part["seconds"] or 0.0) * self.costs.audio_rate))

    def visit_document(self, part) -> None:
        self._attach("document", part["uri"], (part["pages"] or 0) * self.costs.page)

    def visit_other(self, part) -> None:
        self._attach("part", part["uri"] or part["text"], 0)

    def _attach(self, kind: str, uri: str | None, tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append((number, kind, uri, len(self.text), tokens))
        self.text += f"<|{kind}:{number}|>"


def format_turn(role: str | None, parts, learn: bool, costs: Costs = Costs()) -> tuple:
    """(formatted, loss starts, loss ends, words as a plain token count, attachments) of one turn."""
    flat = Flattener(costs)
    for part in parts if parts is not None else []:
        if part is not None:
            flat.visit(part)
    head = START + escape(role or "") + SEP
    spans = [(a + len(head), b + len(head)) for a, b in flat.spans] if learn else []
    words = sum(len(flat.text[a:b].split()) for a, b in flat.spans)
    return (head + flat.text + STOP, [a for a, _ in spans], [b for _, b in spans], words,
            [{"number": n, "type": t, "uri": u, "at": at + len(head), "tokens": k} for n, t, u, at, k in flat.attachments])


def text_part(text: Column) -> Column:
    """One text part as the parts of a message."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            *[F.lit(None).cast(t).alias(n) for n, t in (("uri", "string"), ("width", "int"),
                              ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def format_turns(messages: DataFrame, learn: tuple[str, ...] = ("assistant",), costs: Costs = Costs()) -> DataFrame:
    """Messages (conv_id, turn, role, parts) as (conv_id, turn, role, formatted, loss spans, attachments, ...)."""
    @F.pandas_udf(FORMATTED)
    def formatter(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for roles, parts in batches:
            yield pd.DataFrame([format_turn(r, p, r in learn, costs) for r, p in zip(roles, parts)],
                               columns=["formatted", "loss_start", "loss_end", "text_tokens", "attachments"])

    return (messages.select("conv_id", "turn", "role", formatter("role", "parts").alias("f"))
            .select("conv_id", "turn", "role", "f.*"))


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "attachment_tokens long")


class _Reader:
    """Running digests of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars, self.tokens = conv_id, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts, ends, attachments) -> None:
        role, content = TURN.fullmatch(formatted).groups()
        text = unescape(ATTACHMENT.sub("", content))
        self.all.update(f"{unescape(role)}\n{text}\n".encode())
        for a, b in zip(starts, ends):
            learned = unescape(formatted[a:b])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.turns += 1
        self.chars += len(formatted)
        self.tokens += sum(a["tokens"] for a in attachments)

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.tokens)


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, reader = [c.split()[0] for c in DIGESTS.split(", ")], None
    for batch in batches:
        done = []
        for known, conv_id, formatted, starts, ends, attachments in zip(
                batch["known"], batch["conv"], batch["formatted"], batch["loss_start"], batch["loss_end"],
                batch["attachments"]):
            conv_id = int(conv_id) if known else None
            if reader is None or reader.conv_id != conv_id:
                if reader is not None:
                    done.append(reader.row())
                reader = _Reader(conv_id)
            reader.add(formatted, starts, ends, attachments)
        yield _digest_frame(done, names)
    yield _digest_frame([reader.row()] if reader is not None else [], names)


def _digest_frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


def raw_content(formatted: Column) -> Column:
    """The unescaped content of a formatted turn, by which turns that are equal in turn and role are ordered."""
    begin = F.instr(formatted, SEP) + len(SEP)  # an escaped role holds no such mark
    content = F.substring(formatted, begin, F.length(formatted) - begin + 1 - len(STOP))
    return F.regexp_replace(content, ESCAPED.pattern, "$1")


def read_back(turns: DataFrame) -> DataFrame:
    """One row of digests per conversation of formatted turns, from the formatted text and the loss spans alone."""
    keyed = turns.select(F.col("conv_id").isNotNull().alias("known"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
                         "turn", "role", "formatted", "loss_start", "loss_end", "attachments")
    ordered = keyed.repartition("known", "conv").sortWithinPartitions(
        "known", "conv", F.col("turn").asc_nulls_first(), F.coalesce("role", F.lit("")), raw_content(F.col("formatted")))
    return ordered.mapInPandas(_read_back, DIGESTS)
