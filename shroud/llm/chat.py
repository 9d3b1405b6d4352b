"""Chat formatting with offset-aligned loss masks.

Conversations are rendered whole, encoded once with offsets, and the sorted spans of the
assistant's texts are intersected with the sorted token spans by binary search.

Template: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` for each turn.  The three
markers are tokens of their own, so no token crosses the edge of a text.  Inside roles and texts
``<``, any backslashes, ``|`` gets one more backslash (so no marker can occur); reading removes it.

Rows are dealt by ranges of conversation, turn, role and the text's first ``PREFIX`` characters;
rows equal in these are dealt at random if that is the whole text.  In the order of rows, a
conversation is cut into parts of at most ``PART`` turns, or of about ``PART_CHARS`` characters,
which are encoded alone: tokens never cross a marker, so the parts' tokens are those of the whole.
So a huge conversation, or a turn repeated very often, spreads over tasks, and a task holds few
parts.  Only longer texts of one turn and role that begin alike share a task, part by part.

Defined cases: null role or text is empty.  Turns go by number (null first), then role and text;
repeated rows are repeated turns.  Rows without conversation id are one conversation with id null.
An empty assistant text has no token.  Empty table: no row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PART, PART_CHARS, PREFIX = 64, 1 << 20, 128
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
SCHEMA = ("conv_id long, part long, n_turns long, formatted string, token_ids array<int>, "
          "token_start array<int>, token_end array<int>, loss_from array<int>, loss_to array<int>")


def escape(text: str) -> str:
    return _OPEN.sub(lambda m: f"<{m[1]}\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the span of each assistant text."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head = f"{START}{escape(role)}{SEP}"
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{END}")
        at += len(out[-1])
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, text = turn[:-len(END)].split(SEP)
        out.append((unescape(role), unescape(text)))
    return out


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer, processors
    t = Tokenizer.from_file(path)
    t.add_special_tokens([START, SEP, END])
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep leading spaces
    return t


def mask_runs(start: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]
              ) -> list[tuple[int, int]]:
    """Token ranges [from, to) under each span: binary search among sorted token offsets."""
    out = []
    for a, b in spans:
        i, j = int(np.searchsorted(end, a, "right")), int(np.searchsorted(start, b, "left"))
        if i < j and a < b:
            out.append((i, j))
    return out


def format_chats(rows: DataFrame, tokenizer_path: str, *, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row a part: formatted text, tokens with offsets, and the token ranges under the loss."""
    limit, chars = PART, PART_CHARS
    prefix = F.substring("text", 1, PREFIX)
    # rows that agree in a whole text are the same, so their order does not matter
    tie = F.when(F.length("text") <= PREFIX, F.rand(1)).otherwise(0.0)
    dealt = (rows.select(F.col(conv_col).cast("long").alias("conv_id"),
                         F.col(turn_col).cast("long").alias("turn"),
                         F.coalesce(role_col, F.lit("")).alias("role"),
                         F.coalesce(text_col, F.lit("")).alias("text"))
             .withColumns({"prefix": prefix, "tie": tie})
             .repartitionByRange("conv_id", "turn", "role", "prefix", "tie")
             .select("conv_id", "turn", "role", "text")
             .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def encode(held):
        encoded = tokenizer(tokenizer_path).encode_batch([f for _, _, f, _ in held], add_special_tokens=False)
        cols: list[list] = [[] for _ in range(9)]
        for (key, n, text, spans), e in zip(held, encoded):
            offsets = np.array(e.offsets, np.int32).reshape(-1, 2)
            runs = mask_runs(offsets[:, 0], offsets[:, 1], spans)
            for c, x in zip(cols, (*key, n, text, e.ids, offsets[:, 0], offsets[:, 1],
                                   [a for a, _ in runs], [b for _, b in runs])):
                c.append(x)
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int32())] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)],
            names=["conv_id", "part", "n_turns", "formatted", "token_ids", "token_start",
                   "token_end", "loss_from", "loss_to"])

    def run(batches):
        # ranges lie in the order of rows, so do parts numbered by range and place
        part = TaskContext.get().partitionId() << 32
        conv, turns, begun, held, size = None, [], 0, [], 0

        def close():
            text, spans = render(turns)
            held.append(((conv, part), len(turns), text, spans))
            return len(text)

        for batch in batches:
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if turns and (key != conv or len(turns) >= limit or begun + len(text) > chars):
                    size += close()
                    part, turns, begun = part + 1, [], 0
                    if size > 1 << 20:
                        yield encode(held)
                        held, size = [], 0
                conv = key
                turns.append((role, text))
                begun += len(role) + len(text)
        if turns:
            close()
        if held:
            yield encode(held)

    return dealt.mapInArrow(run, SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the
    formatted parts and their token masks, a conversation's parts in order."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
    rows = (formatted.select("conv_id", "part", "formatted", "token_start", "token_end",
                             "loss_from", "loss_to")
            .repartition("conv_id").sortWithinPartitions("conv_id", "part"))

    def run(batches):
        out, key, state = [], None, None

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(),
                                                             pa.int64(), pa.string(), pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        def done():
            n, turns, chars, loss, size = state
            out.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            starts, ends = batch.column(3), batch.column(4)
            for i, (conv, text, lo, hi) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 5, 6)))):
                if key != (conv,):
                    if key is not None:
                        done()
                    if len(out) >= 4096:
                        yield batch_of(out)
                        out = []
                    key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                a, b = starts[i].values, ends[i].values
                for x, y in zip(lo, hi):
                    said = unescape(text[a[x].as_py():b[y - 1].as_py()])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
        if key is not None:
            done()
        if out:
            yield batch_of(out)

    return rows.mapInArrow(run, schema)
