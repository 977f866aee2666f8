"""Fill-in-middle transformation over seekable compressed texts.

A text is stored as independent zstandard frames with the cumulative number of
its code points after each frame. A cut decompresses the frame it falls into
and no other; all whole frames between two cuts move to the output as they are.
Digests and the inverse read the frames in order and hold one at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.text import raw_texts, to_array, to_arrow
from zoneflow.session import write_table

MARKERS = ("<P>", "<S>", "<M>")
# Bytes of text in a frame, at most.
FRAME_BYTES = 1 << 16
LEVEL = 3
# Rows that a task turns into one Arrow batch.
ROWS = 512

_STORED = "doc_id long, n long, marked boolean, ends array<long>, frames array<binary>"
_FORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, ends array<long>, frames array<binary>"


def _decode(piece: bytes) -> str:
    return piece.decode("utf-8", "surrogateescape")


def _encode(piece: str) -> bytes:
    return piece.encode("utf-8", "surrogateescape")


class Frames:
    """Frames of one text and the number of code points up to the end of each."""

    def __init__(self, ends: list[int] | None = None, frames: list[bytes] | None = None):
        self.ends, self.frames = ends or [], frames or []
        self._loose: list[str] = []

    @property
    def units(self) -> int:
        return self.ends[-1] if self.ends else 0

    def add_frame(self, units: int, frame: bytes, packer: zstandard.ZstdCompressor) -> None:
        """Append a whole frame without opening it."""
        self.close(packer)
        self.ends.append(self.units + units)
        self.frames.append(frame)

    def add_text(self, text: str) -> None:
        """Append text; it becomes a frame with what is added beside it."""
        self._loose.append(text)

    def close(self, packer: zstandard.ZstdCompressor) -> Frames:
        text, self._loose = "".join(self._loose), []
        if text:
            self.ends.append(self.units + len(text))
            self.frames.append(packer.compress(_encode(text)))
        return self

    def pieces(self, opener: zstandard.ZstdDecompressor) -> Iterator[bytes]:
        """The text's bytes in order, a frame at a time."""
        return map(opener.decompress, self.frames)

    def between(self, first: int, last: int) -> Iterator[tuple[int, int, int, int]]:
        """(frame, its code points, first and last wanted one inside) of every frame that holds a code point of first..last."""
        at = bisect_left(self.ends, first + 1)
        while first < last:
            start = self.ends[at - 1] if at else 0
            yield at, self.ends[at] - start, first - start, min(last, self.ends[at]) - start
            first, at = self.ends[at], at + 1


def frame_text(raw: bytes, packer: zstandard.ZstdCompressor, size: int = FRAME_BYTES) -> Frames:
    """Frames of at most `size` bytes, cut between code points."""
    out, at = Frames(), 0
    while at < len(raw):
        to = min(len(raw), at + max(4, size))
        # A code point has at most three bytes after its first.
        least = max(at + 1, to - 3)
        while least < to < len(raw) and raw[to] & 0xC0 == 0x80:
            to -= 1
        piece = raw[at:to]
        out.add_frame(len(piece) if piece.isascii() else len(_decode(piece)), packer.compress(piece), packer)
        at = to
    return out


def rearrange(text: Frames, form: str, first: int, last: int, markers, packer, opener) -> Frames:
    """Frames of the output for a middle of the code points `first` to `last`.

    Only the frames that the two cuts fall into are decompressed.
    """
    out, opened = Frames(), {}
    p, s, m = markers
    parts = {"prefix": (0, first), "middle": (first, last), "suffix": (last, text.units)}
    order = {"psm": [(p, "prefix"), (s, "suffix"), (m, "middle")], "spm": [(s, "suffix"), (p, "prefix"), (m, "middle")]}[form]
    for marker, part in order:
        out.add_text(marker)
        for at, units, begin, end in text.between(*parts[part]):
            if (begin, end) == (0, units):
                out.add_frame(units, text.frames[at], packer)
                continue
            if at not in opened:
                opened[at] = _decode(opener.decompress(text.frames[at]))
            out.add_text(opened[at][begin:end])
    return out.close(packer)


def sections(pieces: Iterable[bytes], marks: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(k, bytes) of a stream, where k counts the marks before the bytes; each mark is looked for after the one before it."""
    k, held = 0, b""
    for piece in pieces:
        held += piece
        while k < len(marks) and (at := held.find(marks[k])) >= 0:
            yield k, held[:at]
            held, k = held[at + len(marks[k]):], k + 1
        # A mark may begin in this frame and end in the next one.
        keep = len(marks[k]) - 1 if k < len(marks) else 0
        ready = max(0, len(held) - keep)
        yield k, held[:ready]
        held = held[ready:]
    yield k, held


def restored(output: Frames, form: str, markers, opener) -> Iterator[bytes]:
    """The original text's bytes in order, from the output and its form alone."""
    if form == "plain":
        yield from output.pieces(opener)
        return
    p, s, m = (_encode(x) for x in markers)
    marks, wanted = {"psm": ([p, s, m], (1, 3, 2)), "spm": ([s, p, m], (2, 3, 1))}[form]
    for part in wanted:
        yield from (piece for k, piece in sections(output.pieces(opener), marks) if k == part)


def digest(pieces: Iterable[bytes]) -> str:
    h = hashlib.sha256()
    for piece in pieces:
        h.update(piece)
    return h.hexdigest()


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers that depend on the id alone; a null id counts as an empty one."""
    h = hashlib.sha256(b"1:" if doc_id is None else b"1:%d" % doc_id).digest()
    return tuple(int.from_bytes(h[4 * i:4 * i + 4]) for i in range(4))


def _check(markers) -> None:
    for a in markers:
        for b in markers:
            if any(a.endswith(b[:k]) for k in range(1, len(b) + (a != b))):
                raise ValueError("no marker may end with the beginning of another or of itself")


def _by_rows(df: DataFrame, fn, schema: str) -> DataFrame:
    """`fn(row)` for every row, as batches of a bounded number of rows; one compressor and decompressor a task."""
    wanted = to_arrow(schema)

    def run(batches):
        packer, opener = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                columns = [raw_texts(c) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c.to_pylist() for c in part.columns]
                out = zip(*(fn(packer, opener, *row) for row in zip(*columns, strict=True)), strict=True)
                yield pa.RecordBatch.from_arrays([to_array(list(c), f.type) for c, f in zip(out, wanted, strict=True)], schema=wanted)

    return df.mapInArrow(run, schema)


def store_frames(docs: DataFrame, markers: tuple[str, str, str] = MARKERS, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id, n (code points), marked (holds a marker), ends and frames of every document, as a stored table.

    `ends` holds the cumulative code points after each frame. A null text is an
    empty one, without frames; repeated rows and null ids stay rows of their
    own; other columns of `docs` are not read.
    """
    _check(markers)
    marks = [_encode(m) for m in markers]

    def run(packer, opener, doc_id, raw):
        text = frame_text(raw or b"", packer, frame_bytes)
        return doc_id, text.units, any(m in (raw or b"") for m in marks), text.ends, text.frames

    return write_table(_by_rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, _STORED), "frames")


def fill_in_middle(stored: DataFrame, markers: tuple[str, str, str] = MARKERS, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the output text as `ends` and `frames`, of every stored document.

    Two numbers drawn from the id cut the text into prefix, middle and suffix.
    `psm` writes them as prefix, suffix, middle, `spm` as suffix, prefix,
    middle, each behind its marker. Empty texts, texts that hold a marker and
    `plain_percent` of all others stay plain: the output is the text, its
    frames are those stored, and the two lengths are null.
    """
    _check(markers)

    def run(packer, opener, doc_id, n, marked, ends, frames):
        h = draws(doc_id)
        if n == 0 or marked or h[2] % 100 >= 100 - plain_percent:
            return doc_id, n, "plain", None, None, ends, frames
        form = "spm" if h[3] % 100 < spm_percent else "psm"
        first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        out = rearrange(Frames(ends, frames), form, first, last, markers, packer, opener)
        return doc_id, n, form, first, last - first, out.ends, out.frames

    return _by_rows(stored.select("doc_id", "n", "marked", "ends", "frames"), run, _FORMED)


def with_digests(formed: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """`formed` without its frames, with the SHA-256 of every output and of the text rebuilt from it."""
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def run(packer, opener, doc_id, n, form, first, middle, ends, frames):
        output, kind = Frames(ends, frames), form.decode()
        return doc_id, n, kind, first, middle, digest(output.pieces(opener)), digest(restored(output, kind, markers, opener))

    return _by_rows(formed, run, schema)


def output_texts(formed: DataFrame) -> DataFrame:
    """doc_id, form and the output as one string a row, for training."""
    def run(packer, opener, doc_id, form, ends, frames):
        return doc_id, form.decode(), b"".join(Frames(ends, frames).pieces(opener)).decode("utf-8", "replace")

    return _by_rows(formed.select("doc_id", "form", "ends", "frames"), run, "doc_id long, form string, text string")
