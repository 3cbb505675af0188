"""Chat formatting by incremental black-box rendering.

A template is a function from a list of turns to a string; nothing else about it is known. The turns of a
conversation are rendered as growing prefixes, and consecutive outputs are compared: what the longer one
adds behind the shorter one is the new turn's span. If the shorter one is no prefix of the longer one, the
template rewrote history, and the turn is flagged. A second rendering of the last turn with a marker in
place of its text shows where in the span the text lies, which gives the loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# strings that a model may read as control; none occurs in a formatted text but where the template puts it
CONTROLS = ["<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]"]
BREAK = "\\-"                      # put inside a control string; a backslash itself becomes two
# a turn beyond twice as many is first rendered behind the last 64 to 127 turns only, and checked against the whole
HISTORY = 64


def escape(text: str, controls: list[str] = CONTROLS) -> str:
    """The text without any control string, reversibly."""
    text = text.replace("\\", "\\\\")
    for c in controls:
        while c in text:
            text = text.replace(c, c[0] + BREAK + c[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|-)", lambda m: "\\" if m[1] == "\\" else "", text)


def turn_template(turns: list[Turn]) -> str:
    """The production template: each turn's role and text between control strings, both escaped."""
    return "<s>" + "".join(f"<|turn|>{escape(r)}<|text|>{escape(t)}<|end|>" for r, t in turns)


_TURN = re.compile(re.escape("<|turn|>") + "(.*?)" + re.escape("<|text|>") + "(.*?)" + re.escape("<|end|>"), re.S)


def read_turns(formatted: str) -> list[Turn]:
    """The turns back from text that ``turn_template`` made."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


Span = tuple[Turn, str, int, int, bool]


def spans(turns: Iterator[Turn], template: Template, history: int = HISTORY) -> Iterator[Span]:
    """For each turn: the turn, what it adds to the output, begin and end of its text in that, and whether the
    template rewrote history at it (then the output from the first changed character on is returned).

    The text comes out empty if the template doesn't show it. The first ``2 * history`` prefixes are rendered
    whole. Rendering all of them whole takes time in proportion to the square of a conversation's turns, so later
    turns are compared behind a part of the history, ``history`` turns or up to twice as many, and their rows are
    held back. When the turns have doubled, and at the end, the whole conversation is rendered: if it is what was
    checked before followed by the pieces held, they are returned; if not, the template looks further back, and
    from the last check on every prefix is rendered whole. Between two checks a change that the template takes
    back again is not seen.
    """
    past: list[Turn] = []
    held: list[Span] = []                                # of past[checked:], found behind a part of the history
    opening = before = whole = template([])
    start = checked = 0                                  # ``before`` renders past[start:], ``whole`` past[:checked]
    local = True
    rest = iter(turns)
    while True:
        turn = next(rest, None)
        if held and (turn is None or len(past) >= 2 * checked):
            now = template(past)
            if _continues(now, whole, held):
                yield from held
            else:
                local, start, before = False, 0, whole
                for k in range(checked, len(past)):
                    row, before = _span(past[:k], before, past[k], template)
                    yield row
            held, whole, checked = [], now, len(past)
        if turn is None:
            return
        if local and len(past) - start >= 2 * history:
            if not start:
                whole, checked = before, len(past)
            start = len(past) - history
            before = template(past[start:])
        row, before = _span(past[start:], before, turn, template)
        if not past and not row[4]:                      # the opening belongs to the first turn's span
            row = (turn, opening + row[1], row[2] + len(opening), row[3] + len(opening), False)
        past.append(turn)
        if start:
            held.append(row)
        else:
            yield row


def _span(past: list[Turn], before: str, turn: Turn, template: Template) -> tuple[Span, str]:
    """The row of a turn behind ``past``, which renders to ``before``, and what both render to."""
    now = template([*past, turn])
    common = len(before) if now.startswith(before) else _common(before, now)
    piece = now[common:]
    marker = _absent(now)
    begin = end = 0
    probe = template([*past, (turn[0], marker)])
    at = probe.find(marker)
    if at >= common:
        begin, end = at - common, len(piece) - (len(probe) - at - len(marker))
        if end < begin or now[:at] != probe[:at]:
            begin = end = 0
    return (turn, piece, begin, end, common < len(before)), now


def _continues(now: str, before: str, rows: list[Span]) -> bool:
    """Whether ``now`` is ``before`` and then the rows' pieces."""
    at = len(before)
    if not now.startswith(before):
        return False
    for _, piece, *_ in rows:
        if not now.startswith(piece, at):
            return False
        at += len(piece)
    return at == len(now)


def _absent(text: str) -> str:
    """A private-use string that isn't in the text. No two of its occurrences overlap, so none arises where it is
    put between other characters either."""
    if "\ue001\ue002" not in text:
        return "\ue001\ue002"
    return "\ue001" + "\ue000" * (1 + max(map(len, re.findall("\ue001(\ue000*)\ue002", text)))) + "\ue002"


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


FORMATTED = "conv_id long, k long, piece string, text_begin long, text_end long, assistant boolean, rewrites boolean"


def _formatted(template: Template, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((c, r or "", t or "") for b in batches for c, r, t in zip(*(x.to_pylist() for x in b.columns), strict=True))
        held: list[tuple] = []
        size = 0
        ahead = next(rows, None)
        while ahead is not None:
            conv = ahead[0]

            def turns() -> Iterator[Turn]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:      # noqa: B023
                    yield ahead[1], ahead[2]
                    ahead = next(rows, None)

            for k, (turn, piece, a, b, rewrote) in enumerate(spans(turns(), template, history)):
                held.append((conv, k, piece, a, b, turn[0] == "assistant", rewrote))
                size += len(piece)
                if size > 4_000_000 or len(held) >= 2000:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "k", "piece", "text_begin", "text_end", "assistant", "rewrites"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def formatted(conversations: DataFrame, template: Template = turn_template, history: int = HISTORY) -> DataFrame:
    """One row a turn, in the order of the conversation: conv_id, k (from 0), piece (what the turn adds to the
    formatted text; with the opening at the first), text_begin and text_end (its text in the piece, in
    characters), assistant, rewrites.

    Turns are ordered by (turn, role, text), nulls first, so ties and repeated rows have a place; null roles
    and texts are empty; rows without a conv_id form one conversation. Rows are sorted, not collected: a task
    holds the one conversation it is at, whose whole text the template is asked for.
    """
    return (conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
            .mapInArrow(_formatted(template, history), FORMATTED))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces -> each conversation's digests, read back from the pieces alone."""
    done: list[tuple] = []
    key, state = None, None

    def close() -> None:
        turns, loss, n, chars, size = state
        done.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))

    for batch in batches:
        conv, _, piece, begin, end, assistant, _ = (c.to_pylist() for c in batch.columns)
        for c, p, a, b, is_assistant in zip(conv, piece, begin, end, assistant, strict=True):
            if key != (c,):
                if state:
                    close()
                key, state = (c,), [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
            for role, text in read_turns(p):
                state[0].update(f"{role}\n{text}\n".encode())
                state[2] += 1
            if is_assistant:
                text = unescape(p[a:b])
                state[1].update(text.encode())
                state[3] += len(text)
            state[4] += len(p)
        if len(done) >= 1000:
            yield _digests(done)
            done = []
    if state:
        close()
    if done:
        yield _digests(done)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c) if i not in (0,) else pa.array(c, pa.int64())
                                       for i, c in enumerate(zip(*rows, strict=True))], names)


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def digests(conversations: DataFrame) -> DataFrame:
    """One row a conversation, read back from the formatted pieces: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. A digest runs over one conversation's text in order, so it is made in the
    task that formats the conversation, piece by piece."""
    return formatted(conversations).mapInArrow(
        _digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
