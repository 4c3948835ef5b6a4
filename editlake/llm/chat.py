"""Chat formatting of turns whose content is a list of typed parts.

A visitor with a method for each kind of part flattens the parts of a conversation, in the order of turns, into text: a turn is
``<|turn|>role``, its parts, ``<|end|>``. A text part is ``<|text|>`` and its text; an image, audio or document part is a placeholder, and
its reference, its number within the conversation and the tokens it stands for go beside it. Under the loss mask are the texts of the
turns of one role.

Control strings inside a role or a text (the template's, and common ones of other templates) are escaped: a backslash more is put after
their first character, after any that stand there, and reading takes one away. So every unescaped one is the template's, and reading gives
the very texts back.

The formatted conversation is the pieces of its parts, one after the other; a piece is a row, so a conversation of any length is never
one row or one value. Pieces of a conversation come in order, within one partition. Digests of whole conversations can only be made in
order; they are made while the rows of a partition stream by, in memory of fixed size.

Rows of one conversation go by turn, nulls last, then by role, then by parts; equal rows are turns of their own. Rows without conv_id are one
conversation. Null texts, roles and contents count as empty; a null part is an empty text; a part of an unknown kind is a placeholder of
its own kind for no tokens. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, END, TEXT = "<|turn|>", "<|end|>", "<|text|>"
#: First character, backslashes, the rest; no control string has a first character within it.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|\|(?:turn|end|text|image|audio|document|other)\|>)"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: An image's token stands for a square of so many pixels a side; tokens of a second of sound and of a page.
PATCH, A_SECOND, A_PAGE = 28, 25, 512

MARK = re.compile(r"<\|(turn|end|text|image|audio|document|other)\|>")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|\|(?:turn|end|text|image|audio|document|other)\|>)")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def _at_least_one(n: Column) -> Column:
    return F.greatest(F.coalesce(F.ceil(n), F.lit(1)), F.lit(1)).cast("bigint")


class PartVisitor:
    """What becomes of a part, by its kind: its text in the conversation and how many tokens it stands for."""

    def __init__(self, patch: int = PATCH, a_second: int = A_SECOND, a_page: int = A_PAGE):
        self.patch, self.a_second, self.a_page = patch, a_second, a_page

    def visit_text(self, part: Column) -> tuple[Column, Column]:
        return F.concat(F.lit(TEXT), escape(F.coalesce(part["text"], F.lit("")))), F.lit(None).cast("bigint")

    def visit_image(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|image|>"), _at_least_one(part["width"] / self.patch) * _at_least_one(part["height"] / self.patch)

    def visit_audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|audio|>"), _at_least_one(part["seconds"] * self.a_second)

    def visit_document(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|document|>"), _at_least_one(part["pages"]) * self.a_page

    def visit_other(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|other|>"), F.lit(0).cast("bigint")

    def visit(self, part: Column) -> tuple[Column, Column]:
        kinds: dict[str, Callable] = {k: getattr(self, f"visit_{k}") for k in ("image", "audio", "document")}
        text, tokens = self.visit_other(part)
        for kind, method in kinds.items():
            made = method(part)
            text = F.when(part["type"] == kind, made[0]).otherwise(text)
            tokens = F.when(part["type"] == kind, made[1]).otherwise(tokens)
        plain, none = self.visit_text(part)
        is_text = part["type"].isNull() | (part["type"] == "text")
        return F.when(is_text, plain).otherwise(text), F.when(is_text, none).otherwise(tokens)


def text_parts(text: Column) -> Column:
    """The content of a turn that is one text."""
    fields = {f.split(":")[0]: f.split(":")[1] for f in PART[7:-1].split(",")}
    values = {"type": F.lit("text"), "text": text}
    return F.array(F.struct(*(values.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in fields.items())))


def format_turns(turns: DataFrame, visitor: PartVisitor | None = None, learn: str = "assistant") -> DataFrame:
    """``turns`` has conv_id, turn, role and content (an array of PART). One row per part, in order: conv_id, turn_no, part_no, role,
    kind, formatted (its piece of the conversation), start (code points before it), loss_start, loss_end (code points, null outside
    the mask), attachment_no, ref, tokens (null for texts)."""
    by = Window.partitionBy("conv_id")
    order = [F.col("turn").asc_nulls_last(), "role", "content"]
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.col("content").cast(f"array<{PART}>").alias("content"))
    rows = rows.withColumn("turn_no", F.row_number().over(by.orderBy(*order)))
    rows = rows.select("conv_id", "turn_no", "role", F.size("content").alias("size"), F.posexplode_outer("content").alias("part_no", "part"))
    rows = rows.withColumns({"part_no": F.coalesce("part_no", F.lit(0)), "none": F.coalesce(F.col("size") <= 0, F.lit(True))})
    piece, tokens = (visitor or PartVisitor()).visit(F.col("part"))
    head = F.when(F.col("part_no") == 0, F.concat(F.lit(TURN), escape(F.col("role")))).otherwise("")
    tail = F.when(F.col("none") | (F.col("part_no") == F.col("size") - 1), F.lit(END)).otherwise("")
    rows = rows.withColumns({"head": head, "piece": F.when(F.col("none"), F.lit(TEXT)).otherwise(piece), "tokens": F.when(~F.col("none"), tokens)})
    rows = rows.withColumn("formatted", F.concat("head", "piece", tail))
    so_far = by.orderBy("turn_no", "part_no").rowsBetween(Window.unboundedPreceding, -1)
    with_own = by.orderBy("turn_no", "part_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("formatted")).over(so_far), F.lit(0)).cast("bigint"))
    number = F.when(F.col("tokens").isNotNull(), F.count("tokens").over(with_own))
    learned = (F.col("role") == learn) & F.col("tokens").isNull()
    begin = F.col("start") + F.length("head") + len(TEXT)
    return rows.select(
        "conv_id",
        "turn_no",
        "part_no",
        "role",
        F.coalesce("part.type", F.lit("text")).alias("kind"),
        "formatted",
        "start",
        F.when(learned, begin).alias("loss_start"),
        F.when(learned, begin + F.length("piece") - len(TEXT)).alias("loss_end"),
        number.alias("attachment_no"),
        "part.ref",
        "tokens",
    )


class _Reading:
    """What is read of one conversation, piece by piece."""

    def __init__(self):
        self.turns, self.placeholders, self.chars, self.loss_chars = 0, 0, 0, 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def piece(self, formatted: str, span: tuple[int, int] | None) -> None:
        marks = list(MARK.finditer(formatted))
        for k, mark in enumerate(marks):
            kind = mark[1]
            text = unescape(formatted[mark.end() : marks[k + 1].start() if k + 1 < len(marks) else len(formatted)])
            if kind == "turn":
                self.turns += 1
                self.digest.update(f"{text}\n".encode())
            elif kind == "text":
                self.digest.update(text.encode())
            elif kind == "end":
                self.digest.update(b"\n")
            else:
                self.placeholders += 1
        if span is not None:
            text = unescape(formatted[span[0] : span[1]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self, conv_id: int | None, tokens: int) -> tuple:
        return conv_id, self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.placeholders, tokens


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """One row per conversation, from the formatted texts and the mask alone: conv_id, n_turns, turns_sha256 (of role, line feed, texts,
    line feed of each turn), loss_chars, loss_sha256, formatted_chars, n_placeholders, attachment_tokens.

    ``in_order``: the rows come straight from :func:`format_turns`; else, as from a table, they are put in order again.
    """
    rows = formatted.select(F.col("conv_id").cast("bigint").alias("conv_id"), "formatted", "start", "loss_start", "loss_end", "tokens")
    if not in_order:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "start")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_placeholders", "attachment_tokens"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reading, tokens = None, None, 0
        for batch in batches:
            out = []
            for conv_id, text, start, a, b, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reading is None or conv_id != now:
                    if reading is not None:
                        out.append(reading.row(now, tokens))
                    now, reading, tokens = conv_id, _Reading(), 0
                reading.piece(text, None if a is None else (a - start, b - start))
                tokens += n or 0
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names)
        if reading is not None:
            last = reading.row(now, tokens)
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(last, kinds, strict=True)], names)

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_placeholders bigint, attachment_tokens bigint"
    return rows.mapInArrow(run, schema)
