"""Small helpers the text operators share: batches of rows, word hashes, bounded memos."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMO_WORDS = 400_000
_U = np.uint64


class Memo(dict):
    """Dictionary that computes missing values and starts over when it is full, so a task's memory stays bounded."""

    def __init__(self, fn: Callable, limit: int = MEMO_WORDS):
        super().__init__()
        self._fn, self._limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._fn(key)
        return value


def _byte_characters() -> list[str]:
    """The visible character that byte-level tokenizers write for each byte: itself where visible, else from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()


def word_pieces(model, word: str) -> list:
    """Tokens of one word by a tokenizer's own merges, without its word splitting."""
    return model.tokenize("".join(map(BYTE_CHARACTERS.__getitem__, word.encode())))


def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def raw_texts(column: pa.Array) -> list:
    """UTF-8 bytes of each text, None where it is null."""
    return column.cast(pa.large_binary()).to_pylist()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch], schema: str) -> DataFrame:
    """Apply `fn` to every Arrow batch; `fn` returns lists by column name of `schema`."""
    wanted = to_arrow(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([to_array(out[f.name], f.type) for f in wanted], schema=wanted)

    return df.mapInArrow(run, schema)


def to_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def to_arrow(schema: str) -> pa.Schema:
    """Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema))


def lists(parts: list[np.ndarray]) -> pa.Array:
    """Arrow list<int64> with one list per array."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(flat)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's labels stay unseen: crc32 of the id as text is a multiple of five. A null id counts as seen."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def free_prefix(columns: list[str]) -> str:
    """A prefix that no column name begins with."""
    return "_" * (1 + max(map(len, columns), default=0))


def same_columns(df: DataFrame) -> tuple[list[str], pa.Schema]:
    """Names and Arrow schema of the columns of `df`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return df.columns, to_arrow_schema(df.schema)
