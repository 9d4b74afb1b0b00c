r"""Chat formatting with loss masks that are aligned by offsets.

A conversation is rendered whole as ``<|im|>role<|say|>text<|end|>\n`` per turn,
encoded once, and the sorted spans of the assistant's texts are intersected with
the token spans by binary search. The three control strings are single tokens,
so no token reaches across the edge of a text. Inside roles and texts ``\``
becomes ``\\`` and ``<|`` becomes ``<\|``; both are undone by dropping the
backslash before any character.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map

TURN, SAY, END = "<|im|>", "<|say|>", "<|end|>"
FORMATTED = "formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_TURNS = re.compile(r"<\|im\|>(.*?)<\|say\|>(.*?)<\|end\|>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
#: Conversations encoded together.
TOGETHER = 64


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@cache
def tokenizer(path: str):
    from tokenizers import Tokenizer, pre_tokenizers, processors

    t = Tokenizer.from_file(path)
    t.add_special_tokens([TURN, SAY, END])
    if isinstance(t.pre_tokenizer, pre_tokenizers.ByteLevel):
        t.post_processor = processors.ByteLevel(trim_offsets=False)  # a token owns its leading space
    return t


def render(turns: list[tuple[str, str]], trained: str) -> tuple[str, list[int], list[int]]:
    """The formatted conversation and the code-point spans of the texts of role ``trained``."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = TURN + escaped(role) + SAY, escaped(text)
        at += len(head)
        if role == trained and body:
            starts.append(at)
            ends.append(at + len(body))
        at += len(body) + len(END) + 1
        parts += (head, body, END, "\n")
    return "".join(parts), starts, ends


def inside(token_starts: np.ndarray, token_ends: np.ndarray, starts: list[int], ends: list[int]) -> np.ndarray:
    """Which tokens lie in one of the sorted spans."""
    if not starts:
        return np.zeros(len(token_starts), bool)
    own = np.searchsorted(np.array(starts), token_starts, "right") - 1
    return (own >= 0) & (token_ends <= np.array(ends)[own]) & (token_ends > token_starts)


def format_chat(rows: DataFrame, tokenizer_path: str, trained: str = "assistant") -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): conv_id and ``FORMATTED``.

    ``starts``/``ends`` are the tokens' code-point offsets in ``formatted``, ``loss``
    their mask. Rows of a conversation go by turn, then role, then text (nulls
    first); repeated rows are turns of their own. Null roles and texts are empty;
    rows without a conv_id make one conversation; an empty table gives an empty one. A conversation is one string, so
    one task holds one conversation at a time, and streams through them.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        encode, arrow = tokenizer(tokenizer_path), None
        for group in groups(batches, TOGETHER):
            arrow = group[0][2]
            shown = [render(turns, trained) for _, turns, _ in group]
            coded = encode.encode_batch([x[0] for x in shown], add_special_tokens=False)
            cols = [[], [], [], []]
            for code, (_, starts, ends) in zip(coded, shown):
                spans = np.array(code.offsets, np.int32).reshape(-1, 2)
                for col, x in zip(cols, (np.array(code.ids, np.int32), spans[:, 0], spans[:, 1], inside(spans[:, 0], spans[:, 1], starts, ends))):
                    col.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in group], arrow), pa.array([x[0] for x in shown]), *(pa.array(c, pa.list_(t)) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.bool_())))],
                ["conv_id", "formatted", "ids", "starts", "ends", "loss"],
            )

    return arrow_map(rows, run, f"conv_id {kind}, {FORMATTED}")


def groups(batches, together: int):
    """Lists of (conv_id, turns, Arrow type of the id) from rows sorted by conversation."""
    out, size, key, turns, begun, arrow = [], 0, None, [], False, None
    for b in batches:
        arrow = b.column("conv_id").type
        for k, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if not begun or k != key:
                if begun:
                    out.append((key, turns, arrow))
                    if len(out) >= together or size > 1 << 20:
                        yield out
                        out, size = [], 0
                key, turns, begun = k, [], True
            turns.append((role or "", text or ""))
            size += len(text or "")
    if begun:
        out.append((key, turns, arrow))
        yield out


def read_back(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns of a formatted conversation, and the texts under its mask, unescaped."""
    turns = [(unescaped(r), unescaped(t)) for r, t in _TURNS.findall(formatted)]
    s, e = starts[loss], ends[loss]
    if len(s) == 0:
        return turns, []
    cut = np.r_[True, s[1:] > np.maximum.accumulate(e)[:-1]]
    last = np.r_[np.nonzero(cut)[0][1:], len(s)] - 1
    return turns, [unescaped(formatted[a:b]) for a, b in zip(s[cut].tolist(), np.maximum.accumulate(e)[last].tolist())]


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets from formatted conversations: counts and SHA-256 of turns and of the text under the mask."""
    import hashlib

    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for text, *arrays in zip(*(b.column(c).to_pylist() if c == "formatted" else lists(b.column(c)) for c in ("formatted", "starts", "ends", "loss"))):
                turns, under = read_back(text, *arrays)
                loss = "".join(under)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return arrow_map(
        formatted.select("conv_id", "formatted", "starts", "ends", "loss"), run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def lists(column: pa.ListArray) -> list[np.ndarray]:
    values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]
