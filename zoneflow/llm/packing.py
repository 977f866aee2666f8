"""Pack documents into token sequences of equal capacity with balanced attention cost.

Full stretches of a document fill sequences of their own; what remains of each
document is packed. Remainders are dealt into blocks of a bounded number of
pieces by the hash of a row number, so no source or id can make a block large,
and every block is packed by its own task. Token ids never leave the task that
tokenised them: a piece travels as its length and checksums.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.text import Memo, to_arrow, word_pieces
from zoneflow.session import write_table

CAPACITY = 1024
# Cuts of a remainder fall on multiples of this many tokens, whose checksums are kept.
GRAIN = 16
# Remainders in one block on average.
BLOCK_PIECES = 4096
PAD_ID = 0
WORD = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Characters whose classes every Unicode version agrees on; other texts go to the tokenizer whole.
SETTLED = regex.compile(r"[\x00-ɏ‐-‧‰-›€]*+")


class ByteBpe:
    """Token ids of a text: split once, then one dictionary entry per distinct word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._specials = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._model = self._whole.model
        self._words = Memo(self._word, 1_000_000)

    def _word(self, word: str) -> bytes:
        return np.array([t.id for t in word_pieces(self._model, word)], "<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if not (text.isascii() or SETTLED.fullmatch(text)) or any(s in text for s in self._specials):
            return np.frombuffer(self._ids(text), "<u4")
        return np.frombuffer(b"".join(map(self._words.__getitem__, WORD.findall(text))), "<u4")


@lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    """One tokenizer per Python worker, kept over its tasks."""
    return ByteBpe(path)


_PIECE = "doc_id long, start long, length long, crc long, doc_tokens long, grains array<long>"


def _cut_documents(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Full stretches (no grains) and the remainder of every document, with checksums of its grains."""
    wanted = to_arrow(_PIECE)

    def run(batches):
        encode = byte_bpe(tokenizer)
        for batch in batches:
            out = [[] for _ in wanted]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = encode(text or "").tobytes() + PAD_ID.to_bytes(4, "little")
                n = len(raw) // 4
                for start in range(0, n, capacity):
                    piece = raw[4 * start:4 * (start + capacity)]
                    whole = len(piece) == 4 * capacity
                    grains = [] if whole else [zlib.crc32(piece[i:i + 4 * GRAIN]) for i in range(0, len(piece), 4 * GRAIN)]
                    for values, value in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), n, grains), strict=True):
                        values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, wanted, strict=True)], schema=wanted)

    return docs.mapInArrow(run, _PIECE)


def joined_crc(parts: list[int], lengths: list[int]) -> int:
    """Checksum of a concatenation from the checksums of its parts and their lengths in bytes."""
    total = 0
    for crc, n in zip(parts, lengths, strict=True):
        zeros = bytes(n)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def pack(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = 1.0 / CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset) for pieces shorter than `capacity`.

    Pieces go by descending cost to the sequence of lowest cost with room for
    them. One that fits nowhere is cut into whole grains over the sequences of
    lowest cost with room; what is left opens sequences whose length is a power
    of two as far as it goes.
    """
    count = max(1, -(-int(lengths.sum()) // capacity))
    room, cost, placed = np.full(count, capacity), np.zeros(count), []

    def put(piece: int, start: int, n: int, to: int) -> None:
        placed.append((piece, start, n, to, capacity - int(room[to])))
        room[to] -= n
        cost[to] += linear * n + quadratic * n * n

    for piece in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[piece])
        while left:
            fits = room >= left
            some = fits if fits.any() else room >= GRAIN
            if not some.any():
                room, cost = np.append(room, capacity), np.append(cost, 0.0)
                continue
            to = int(np.argmin(np.where(some, cost, np.inf)))
            n = left if fits.any() else int(room[to]) // GRAIN * GRAIN
            put(piece, start, n, to)
            start, left = start + n, left - n
    return placed


_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack_block(block: pa.Table, capacity: int, schema: pa.Schema) -> pa.Table:
    """Pack one block; ids of its sequences carry the block's number."""
    rows, number = block.sort_by("row").to_pydict(), block.column("block")[0].as_py()
    out = {name: [] for name in schema.names}
    for piece, start, n, to, offset in pack(np.array(rows["length"], np.int64), capacity):
        whole, crc = n == rows["length"][piece], rows["crc"][piece]
        if not whole:
            grains = rows["grains"][piece][start // GRAIN:-(-(start + n) // GRAIN)]
            crc = joined_crc(grains, [4 * min(GRAIN, n - i * GRAIN) for i in range(len(grains))])
        values = (rows["doc_id"][piece], rows["start"][piece] + start, n, crc, rows["doc_tokens"][piece], (number << 20 | to) * 2 + 1, offset)
        for name, value in zip(out, values, strict=True):
            out[name].append(value)
    return pa.table(out, schema=schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Pieces of all rows' token ids, each followed by id 0, with their place in a sequence.

    A null text is empty and takes one token. Rows that repeat are packed as
    often as they occur; null ids are kept. Other columns are ignored.
    Sequences of full stretches have even ids, packed ones odd ids.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    pieces = _cut_documents(docs.select("doc_id", "text"), str(path), capacity)
    # The row number is stored with the pieces: a task that runs again reads the same number.
    stored = write_table(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = stored.where(F.col("length") == capacity).select(
        "doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens",
        (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = stored.where(F.col("length") < capacity)
    blocks = max(1, -(-rest.count() // block_pieces))
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    schema = to_arrow(_PACKED)
    packed = dealt.groupBy("block").applyInArrow(lambda t: _pack_block(t, capacity, schema), _PACKED)
    return full.unionByName(packed)
