"""Best-fit decreasing packing of token windows, with a segment tree over the free rooms.

Overlong documents are first cut into full windows, which are finished sequences. What remains, the pieces
shorter than a window, is dealt to tasks in batches of bounded size. A task takes its pieces longest first;
each goes to the open window with the least room that still holds it, found in a segment tree indexed by
remaining room. Windows that a batch leaves poorly filled are opened again: their pieces meet those of other
batches in a further, smaller round, so the padding is that of one large batch whatever the number of tasks.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, stored, text_bytes

SEQUENCE = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# pieces that one task packs together
BATCH_PIECES = 1 << 18
# a window with more than this share of free room is opened again in the next round
SPARE = 1 / 64
# words that a worker remembers between batches, and the longest word among them
CACHED_WORDS = 400_000
CACHED_BYTES = 48


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters stand for
    themselves, the other bytes in order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class WordTokenizer:
    """Token ids of whole texts as little-endian 32-bit bytes: those of the tokenizer file.

    The file drops white space and never joins across it, so a text's ids are those of its words between
    ASCII white space, one after the other; ids of words are remembered. Two more steps leave the ids as they
    are and make fewer different words: A-Z are lower-cased (the file does that too), and a full stop or comma
    between a letter and white space stands alone. Texts with ``<|`` may spell out a special token, whose
    case counts: they are encoded whole.

    New words of plain lower-case letters go through the file's merges as ranks, many at a time: a word is
    its bytes and a space for its end, the byte before the end merges with it first, then the file's merges in
    their order. That gives the file's ids if every token comes out whole from its own bytes, as in this file
    (tests check it). All other words go through the file itself.
    """

    _loaded: dict[str, WordTokenizer] = {}
    _stop = re.compile(rb"([.,])(?:(?<=[a-z][.,])|(?<=\xc3[\x9f-\xb6\xb8-\xbf][.,]))(?=[ \n]|$)")
    _plain = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.file = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte, end = _byte_alphabet(), model["end_of_word_suffix"]
        raw = lambda t: bytes(byte[c] for c in t.removesuffix(end)) + b" " * t.endswith(end)
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 32]): 256 + b for b in range(256)}
        ranks |= {raw(a + b): 512 + i for i, (a, b) in enumerate(model["merges"])}
        special = {t.content for t in self.file.get_added_tokens_decoder().values()}
        self.id_of_rank, self.is_end = np.zeros(len(ranks), "<u4"), np.zeros(len(ranks), bool)
        for token, i in model["vocab"].items():
            if token not in special and (rank := ranks[raw(token)]) != 32:
                self.id_of_rank[rank], self.is_end[rank] = i, token.endswith(end)
        self.ranks = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def load(cls, path: str) -> WordTokenizer:
        """One tokenizer for all tasks of a worker process."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, text: str) -> bytes:
        return np.array(self.file.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of plain letters, in one call for all."""
        if not words:
            return []
        ranks = self.ranks.encode_to_numpy((b" ".join(words) + b" ").decode())
        ids, stops = self.id_of_rank[ranks].tobytes(), (4 * (np.flatnonzero(self.is_end[ranks]) + 1)).tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def learn(self, words: set[bytes]) -> None:
        """Remember all ``words``; what is known is dropped whole when it outgrows its bound."""
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        new = words - self.known.keys()
        plain = [w for w in new if self._plain.fullmatch(w)]
        self.known.update(zip(plain, self.plain_ids(plain), strict=True))
        for w in new.difference(plain):
            self.known[w] = self.encode(w.decode())

    def ids_of(self, texts: list[bytes]) -> list[bytes]:
        split = [None if b"<|" in t else self._stop.sub(rb" \1", t.lower()).split() for t in texts]
        self.learn(set(chain.from_iterable(w for w in split if w)))
        out = [self.encode(t.decode()) if w is None else b"".join(map(self.known.__getitem__, w))
               for t, w in zip(texts, split, strict=True)]
        for w in [w for w in self.known if len(w) > CACHED_BYTES]:
            del self.known[w]
        return out


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def piece_column(text: str, size: int = SEQUENCE, path: str | None = None, with_ids: bool = False):
    """Text -> its pieces (start, length, ids_crc32, doc_tokens, ids): the ids with ``END_ID`` behind, cut from
    the front into full windows, so only the last piece may be shorter. A null text is an empty one. ``ids``
    (little-endian 32-bit) is null unless asked for."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                               ("doc_tokens", pa.int64()), ("ids", pa.binary())]))

    def start():
        tok = WordTokenizer.load(path or tokenizer_path())
        end = np.array([END_ID], "<u4").tobytes()

        def cut(ids: bytes) -> list[dict]:
            n = len(ids) // 4
            parts = [(a, ids[4 * a:4 * (a + size)]) for a in range(0, n, size)]
            return [{"start": a, "length": len(p) // 4, "ids_crc32": zlib.crc32(p), "doc_tokens": n,
                     "ids": p if with_ids else None} for a, p in parts]

        return lambda batch: pa.array([cut(ids + end) for ids in tok.ids_of(batch.to_pylist())], kind)
    return per_batch(start, "array<struct<start:long,length:long,ids_crc32:long,doc_tokens:long,ids:binary>>")(text_bytes(text))


class RoomTree:
    """Open windows by remaining room: a segment tree whose leaf ``r`` is the stack of windows with room ``r``
    and whose inner nodes say whether a leaf below has any."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, window: int) -> None:
        self.stacks[room].append(window)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(room, window)`` with the least room of at least ``need``; None if none has it."""
        node, has = self.leaves + need, self.any
        while not has[node]:
            while node & 1:                            # a right child: nothing to the right below its parent
                node >>= 1
            if not node:
                return None
            node += 1                                  # the right sibling
        while node < self.leaves:
            node = 2 * node if has[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.stacks[room].pop()
        if not self.stacks[room]:
            while node and not (node < self.leaves and (has[2 * node] or has[2 * node + 1])):
                has[node] = 0
                node >>= 1
        return room, window


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each piece's window, its offset there, and the window's room at the end.

    Windows are named by the place of their first piece in ``lengths``. Equal lengths go in their order.
    """
    tree = RoomTree(size)
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room_of = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        room, w = tree.take(n) or (size, i)
        window[i], offset[i] = w, size - room
        room_of[w] = room - n
        if room > n:
            tree.put(room - n, w)
    return window, offset, room_of[window]


def _pack(size: int, batch_pieces: int):
    """Batches of (uid, length) -> (uid, length, sequence_id, offset, room), ``batch_pieces`` packed at a time."""

    def flush(uid: list, length: list) -> pa.RecordBatch:
        u, n = np.concatenate(uid), np.concatenate(length)
        order = np.argsort(u, kind="stable")           # the rows' order in a shuffle block doesn't matter
        u, n = u[order], n[order]
        window, offset, room = best_fit(n, size)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (u, n, u[window], offset, room)],
                                          ["uid", "length", "sequence_id", "offset", "room"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, length, held = [], [], 0
        for batch in batches:
            uid.append(batch.column(0).to_numpy(zero_copy_only=False))
            length.append(batch.column(1).to_numpy(zero_copy_only=False))
            held += len(uid[-1])
            if held >= batch_pieces:
                yield flush(uid, length)
                uid, length, held = [], [], 0
        if held:
            yield flush(uid, length)
    return run


def placed(tails: DataFrame, size: int = SEQUENCE, batch_pieces: int = BATCH_PIECES) -> DataFrame:
    """``(uid, length)`` of pieces shorter than a window (a stored table) -> ``uid, sequence_id, offset``.

    Pieces are dealt to tasks by a hash of their unique ``uid``: no key holds many. A sequence is named by the
    ``uid`` of its first piece. While there are several batches, the pieces of windows with more than ``SPARE``
    of free room go on to a next round; it ends when one batch holds all that is left, or when a round
    leaves over half of its pieces open, as then the lengths themselves don't fill windows.
    """
    done: list[DataFrame] = []
    n = tails.count()
    while True:
        tasks = max(1, -(-n // batch_pieces))
        slots = stored(tails.repartition(tasks, "uid").mapInArrow(
            _pack(size, batch_pieces), "uid long, length long, sequence_id long, offset long, room long"), "window-slots")
        open_ = F.col("room") > size * SPARE
        left = slots.filter(open_).count() if tasks > 1 else 0
        if not left or 2 * left > n:
            done.append(slots)
            break
        done.append(slots.filter(~open_))
        tails, n = slots.filter(open_).select("uid", "length"), left
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("uid", "sequence_id", "offset")


def packed(docs: DataFrame, size: int = SEQUENCE, path: str | None = None, with_ids: bool = False,
           batch_pieces: int = BATCH_PIECES) -> DataFrame:
    """Pack all documents: one row a piece with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``with_ids``, the piece's ``ids`` as little-endian 32-bit integers.

    Texts are tokenized once; only piece rows are stored and only (uid, length) is shuffled for packing, the
    slots are joined back on the unique uid. Null and empty texts are the end id alone; repeated rows are
    packed as often as they occur; a null doc_id is kept; other columns, whatever their names, are not read;
    an empty table gives no rows.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    pieces = docs.select("doc_id", F.explode(piece_column("text", size, path, with_ids)).alias("p")).select("doc_id", "p.*")
    pieces = stored(pieces.select(*names).withColumn("uid", F.monotonically_increasing_id()), "window-pieces")
    full = F.col("length") == size
    whole = pieces.filter(full).select(*names, F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    slots = placed(pieces.filter(~full).select("uid", "length"), size, batch_pieces)
    return whole.unionByName(pieces.filter(~full).join(slots, "uid").select(*names, "sequence_id", "offset"))


def sequences(docs: DataFrame, size: int = SEQUENCE, path: str | None = None) -> DataFrame:
    """The training sequences themselves: sequence_id, n_tokens, ``ids`` (little-endian 32-bit, unpadded) and
    ``pieces``, the array of (offset, length, doc_id, start) in order. A sequence is at most ``size`` tokens, so
    no group is large."""
    rows = packed(docs, size, path, with_ids=True)
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return (rows.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", (F.octet_length(joined) / 4).cast("long").alias("n_tokens"), joined.alias("ids"),
                    F.transform("parts", lambda p: F.struct(p["offset"], p["length"], p["doc_id"], p["start"])).alias("pieces")))
