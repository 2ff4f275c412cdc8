r"""Chat formatting that is proven by reading it back.

The template is a small grammar over control strings:

    conversation = <s> turn*
    turn = [SYS] text [/SYS] or [INST] text [/INST] or [OUT] text </s> or [ROLE]name[/ROLE] text </s>

for the roles system, user, assistant and any other, with one space on either side of a text. A deterministic parser reads
a rendered conversation: control strings, and what lies between them. Turns are rendered as they are, parsed and compared
with their source; turns that do not come back get their control strings escaped, until the conversation is identical.
Escaping puts a backslash behind the first sign of every control string, and of everything that would be one without such
backslashes ([INST] becomes [\INST], and [\INST] becomes [\\INST]). Reading takes one away, so every text has one way back.

The turns of a conversation are streamed in order and written in pieces of bounded size, each rendered and parsed by
itself. A conversation is one text in the end and so belongs to one task, but is never held whole. The loss mask is a list
of spans of code points, one per assistant turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20  # code points of source texts after which a conversation goes on in another piece
BATCH = 4 << 20  # code points of pieces in one batch

BEGIN, END = "<s>", "</s>"
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", END)}
NAME, NAMED = "[ROLE]", "[/ROLE]"
CONTROL = re.compile(r"\[(?:/?(?:INST|SYS|ROLE)|OUT)\]|</?s>")
LOOSE = re.compile(r"\[\\*(?:/?(?:INST|SYS|ROLE)|OUT)\]|<\\*/?s>")  # the same with any number of backslashes

_BY_MARK = {a: (role, b) for role, (a, b) in MARKS.items()}

PIECES = "conv_id bigint, piece int, formatted string, loss array<struct<first:int,end:int>>"
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str) -> str:
    return LOOSE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return LOOSE.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text) if "\\" in text else text


def _rendered(role: str, text: str) -> str:
    if role in MARKS:
        begin, end = MARKS[role]
        return f"{begin} {text} {end}"
    return f"{NAME}{role}{NAMED} {text} {END}"


def parse(text: str, begins: bool = True) -> list[tuple[str, str, int, int]] | None:
    """(role, text, first, end) of the turns of a piece, the span being that of the text as it stands there.

    None if the piece does not follow the grammar. `begins` tells whether it is the first one of a conversation.
    """
    turns, at = [], 0
    marks = CONTROL.finditer(text)
    if begins:
        if not text.startswith(BEGIN):
            return None
        at = next(marks).end()
    for mark in marks:
        if mark.start() != at:
            return None
        if mark[0] in _BY_MARK:
            role, closing = _BY_MARK[mark[0]]
        elif mark[0] == NAME:
            begin, mark = mark, next(marks, None)
            if mark is None or mark[0] != NAMED:
                return None
            role, closing = unescape(text[begin.end() : mark.start()]), END
        else:
            return None
        end = next(marks, None)
        first = mark.end() + 1
        if end is None or end[0] != closing or end.start() - 1 < first or text[first - 1] != " " or text[end.start() - 1] != " ":
            return None
        turns.append((role, unescape(text[first : end.start() - 1]), first, end.start() - 1))
        at = end.end()
    return turns if at == len(text) else None


def format_turns(turns: list[tuple[str, str]], begins: bool = True) -> tuple[str, list[tuple[int, int]]]:
    """The rendered turns (role, text), from which `parse` reads exactly these, and the spans of the assistant's texts."""
    escaped: set[int] = set()

    def render(i: int) -> str:
        role, text = turns[i]
        return _rendered(escape(role), escape(text)) if i in escaped else _rendered(role, text)

    while True:
        formatted = (BEGIN if begins else "") + "".join(map(render, range(len(turns))))
        back = parse(formatted, begins)
        if back is not None and [t[:2] for t in back] == turns:
            return formatted, [(first, end) for role, _, first, end in back if role == "assistant"]
        conflicts = {i for i in range(len(turns)) if i not in escaped and [t[:2] for t in parse(render(i), False) or ()] != [turns[i]]}
        if not conflicts:
            raise ValueError(f"turns do not come back: {formatted[:200]!r}")
        escaped |= conflicts


def _pieces(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        out: list[tuple] = []
        turns: list[tuple[str, str]] = []
        conv, piece, size, waiting = None, 0, 0, 0

        def cut() -> None:
            nonlocal piece, size, turns, waiting
            if turns:
                text, spans = format_turns(turns, piece == 0)
                out.append((conv, piece, text, [{"first": a, "end": b} for a, b in spans]))
                piece, size, turns, waiting = piece + 1, 0, [], waiting + len(text)

        for batch in batches:
            for new, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                if new != conv or size >= limit:
                    cut()
                    if new != conv:
                        conv, piece = new, 0
                    if waiting >= BATCH:
                        yield _batch(out, PIECES_ARROW)
                        out, waiting = [], 0
                turns.append((role or "", text or ""))
                size += len(turns[-1][1])
        cut()
        yield _batch(out, PIECES_ARROW)

    return run


PIECES_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int32()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))]
)
DIGESTS_ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in DIGESTS.split(", ")])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def format_conversations(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """(conv_id, piece, formatted, loss) of `conversations` (conv_id, turn, role, text; other columns are ignored).

    Turns go by `turn`, nulls first, then by role and text; repeated rows are turns of their own. A null text or role is an
    empty one, rows without conv_id are one conversation of that id. A conversation's pieces, joined by `piece`, are its
    text; `loss` holds spans of code points of the piece. Pieces follow each other within a partition. An empty table gives
    an empty result. A turn that could not be read back would raise.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_pieces(piece), PIECES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: list | None = None

    def done() -> tuple:
        conv, n_turns, turns, chars, loss, formatted = state
        return conv, n_turns, turns.hexdigest(), chars, loss.hexdigest(), formatted

    for batch in batches:
        out = []
        for conv, piece, text, spans in zip(*[c.to_pylist() for c in batch.columns]):
            if piece == 0:
                if state:
                    out.append(done())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns = parse(text, piece == 0)
            if state is None or turns is None or state[0] != conv:
                raise ValueError(f"piece {piece} of conversation {conv} is out of place or cannot be read")
            state[1] += len(turns)
            for role, said, _, _ in turns:
                state[2].update(f"{role}\n{said}\n".encode())
            for span in spans:
                learned = unescape(text[span["first"] : span["end"]])
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(text)
        yield _batch(out, DIGESTS_ARROW)
    if state:
        yield _batch([done()], DIGESTS_ARROW)


def read_back(pieces: DataFrame, in_order: bool = False) -> DataFrame:
    """What the formatted text itself holds, one row per conversation: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Pass `in_order` only for the result of `format_conversations` itself, whose pieces follow each other; a table of pieces
    that was written and read is sorted first.
    """
    pieces = pieces.select("conv_id", "piece", "formatted", "loss")
    if not in_order:
        pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return pieces.mapInArrow(_digests, DIGESTS)
