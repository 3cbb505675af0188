"""Best-fit packing planned on the histogram of piece lengths.

The plan sees counts, not documents: best-fit decreasing runs over the at most ``size`` lengths, filling
whole runs of equal sequences at once. Its rows say "the documents of length ``l`` with ranks ``a`` to
``a + n`` take place ``offset`` of the sequences from ``s`` on"; documents then find their slot by their
rank within their length. The plan's size depends on ``size`` only, not on the number of documents.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tidemark.llm.common import buckets_for, per_batch, rank_within, stored, text_bytes

SEQUENCE = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
# the rank file with the same vocabulary and merges as the tokenizer file
RANKS = "byte_bpe_50k.tiktoken"


class Tokenizer:
    """Token ids of whole texts as little-endian 32-bit bytes.

    Texts go through the rank file, whose ids are those of the tokenizer file at a fifth of the time (tests
    compare them); texts that spell out a special token, which only the tokenizer file knows, or that the
    rank file's pattern cannot take go through the tokenizer file.
    """

    _loaded: dict[tuple[str, str], Tokenizer] = {}

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer as File
        self.file = File.from_file(path)
        self.special = [t.content for t in self.file.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @classmethod
    def load(cls, path: str, ranks: str) -> Tokenizer:
        """One tokenizer for all tasks of a worker process."""
        if (path, ranks) not in cls._loaded:
            cls._loaded[path, ranks] = cls(path, ranks)
        return cls._loaded[path, ranks]

    def ids(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:                          # its pattern gives up on millions of white-space characters
                pass
        return np.array(self.file.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def piece_column(text: str, size: int = SEQUENCE, path: str | None = None, ranks: str | None = None):
    """Text -> its pieces (piece, start, length, ids_crc32): the ids with ``END_ID`` behind, cut from the
    end into ``size`` tokens, so only the first piece may be shorter. A null text is an empty one."""
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    def start():
        tok = Tokenizer.load(path or tokenizer_path(), ranks or tokenizer_path(RANKS))
        end = np.array([END_ID], "<u4").tobytes()

        def cut(ids: bytes) -> list[dict]:
            n = len(ids) // 4
            cuts = [0, *range(n % size or size, n + 1, size)]
            return [{"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a:4 * b])}
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

        def step(batch):
            return pa.array([cut(tok.ids(t.decode("utf-8", "replace")) + end) for t in batch.to_pylist()], kind)
        return step
    return per_batch(start, "array<struct<piece:int,start:long,length:long,ids_crc32:long>>")(text_bytes(text))


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, n, first sequence, offset).

    Sequences are kept as runs of equal free room. The longest pieces go first; each takes the runs with
    the least room that fits, and what is left over opens new sequences, each filled with as many pieces of
    that length as it holds.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []                                # free rooms that have runs, ascending
    runs: dict[int, list[tuple[int, int]]] = {}          # room -> [(first sequence, count)]
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            first, n = runs[room].pop()
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            deep = min(room // length, -(-left // n))    # pieces of this length one sequence takes
            used = 0
            for k in range(deep):
                m = min(n, left)
                rows.append((length, rank, m, first, size - room + k * length))
                left, rank, used = left - m, rank + m, m
            put(room - deep * length, first, used)
            put(room - (deep - 1) * length, first + used, n - used)
        if left:
            fit = size // length
            full, rest = divmod(left, fit)
            for k in range(fit):
                if full:
                    rows.append((length, rank, full, sequences, k * length))
                    rank += full
            put(size - fit * length, sequences, full)
            sequences += full
            for k in range(rest):
                rows.append((length, rank, 1, sequences, k * length))
                rank += 1
            if rest:
                put(size - rest * length, sequences, 1)
                sequences += 1
    return rows


def slot_column(rows: list[tuple[int, int, int, int, int]], spark):
    """(length, rank) -> (sequence_id, offset) by binary search in the broadcast plan."""
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)

    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        t = shared.value
        lengths, first = np.unique(t[:, 0], return_index=True)
        # one ascending key: the length's place, then the rank (ranks of one length stay below the shift)
        shift = int((t[:, 1] + t[:, 2]).max(initial=0)) + 1
        key = np.searchsorted(lengths, t[:, 0]) * shift + t[:, 1]
        for length, rank in batches:
            n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
            row = np.searchsorted(key, np.searchsorted(lengths, n) * shift + r, side="right") - 1
            yield pa.StructArray.from_arrays([pa.array(t[row, 3] + r - t[row, 1]), pa.array(t[row, 4])], ["sequence_id", "offset"])

    return arrow_udf(find, "sequence_id long, offset long", ArrowUDFType.SCALAR_ITER)


def packed(docs: DataFrame, size: int = SEQUENCE, path: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pack all documents: one row a piece with doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Texts are tokenized once and only the small piece rows are stored. Ranks within a length are made from
    bucket counts, so a length that a third of all pieces share is no hot group. Null and empty texts are
    the end id alone; repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = docs.select("doc_id", F.explode(piece_column("text", size, path, ranks)).alias("p")).select("doc_id", "p.*")
    pieces = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranked = rank_within(pieces, ["length"], "uid", "rank", buckets_for(sum(histogram.values())))
    slot = slot_column(plan(histogram, size), spark)
    return (ranked.withColumn("slot", slot(F.col("length"), F.col("rank")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "slot.sequence_id", "slot.offset"))
