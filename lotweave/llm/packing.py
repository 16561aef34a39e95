"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document is cut into pieces of the capacity and a remainder. A remainder of length l belongs to class k = capacity // l,
whose bins hold k pieces each, of at most capacity // k ids. Where that would waste more than ``waste`` of a slot, the
largest slot that fits is cut off and the rest is classed again. Each worker fills the bins of each class independently
in one pass, so nothing is shuffled or sorted and a worker holds at most one open bin per class. At the end of a worker's
rows the pieces of its open bins are laid end to end, cut at the capacity; so it leaves one sequence unfilled at most.

Whole texts of any length are packed; a worker holds the ids of one at a time. Nulls: a null text is the empty text (its ids: the
end id alone); a null id stays null. Repeated rows are packed as often as they come. An empty table gives an empty result. Only
``id_col`` and ``text_col`` are read, whatever other columns are called.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, workers

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
WIDTH = 4  # bytes of an id
#: Sequence ids of a worker start at its number shifted by so many bits.
WORKER_SHIFT = 40
BATCH_ROWS = 20_000
#: Chunks whose ids a worker remembers: some 90 MB. Fewer take more time, not more memory.
CHUNKS = 500_000
STOPS = (b".", b",", b";", b":", b"!", b"?")
#: What a vocabulary file says of its normaliser and its pre-tokens if these don't look beyond white space, which falls out.
PLAIN_NORMALS = ["NFC", "Replace", "Lowercase"]
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_at_spaces(config: dict) -> bool:
    """Whether a vocabulary file (parsed) lower-cases texts and drops white space between pre-tokens of letters, digits and others.

    Then the ids of a text are those of its chunks between white space, and a stop after letters is a pre-token of its own. Nothing is
    assumed of any other file.
    """
    normal, pre = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [])
    if [x.get("type") for x in steps] != PLAIN_NORMALS or (steps[1].get("pattern"), steps[1].get("content")) != ({"Regex": r"\s+"}, " "):
        return False
    parts = pre.get("pretokenizers", [])
    if [x.get("type") for x in parts] != ["Split", "ByteLevel"] or parts[1].get("add_prefix_space") or parts[1].get("use_regex"):
        return False
    cut = parts[0]
    return cut.get("pattern") == {"Regex": PLAIN_PATTERN} and cut.get("behavior") == "Removed" and bool(cut.get("invert")) and config.get("post_processor") is None


class IdsOfChunk(dict):
    """Bytes of the ids of a chunk without ASCII white space; remembers up to ``limit`` short chunks.

    Only for vocabularies that :func:`splits_at_spaces`: their pre-tokens never hold white space, so the ids of a text are those of its chunks in order.
    """

    def __init__(self, tokenizer, limit: int = CHUNKS, longest: int = 48):
        super().__init__()
        self.tokenizer, self.limit, self.longest = tokenizer, limit, longest

    def __missing__(self, chunk: bytes) -> bytes:
        core, limit = (chunk[:-1] if chunk[-1:] in STOPS else chunk), self.limit
        if core.isalpha() and (core is not chunk or not chunk.islower()):
            # ASCII letters, perhaps one stop: the vocabulary has lower case only, and a stop is a pre-token of its own.
            out = self[core.lower()] + (self[chunk[-1:]] if core is not chunk else b"")
            limit //= 2
        else:
            out = np.asarray(self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < limit and len(chunk) <= self.longest:
            self[chunk] = out
        return out

    def of_text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


class IdsOfText:
    """Bytes of the ids of a whole text, for any vocabulary."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def of_text(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def ids_by(tokenizer_path: str, chunks: int = CHUNKS) -> IdsOfChunk | IdsOfText:
    """The worker's way to ids for a vocabulary file, remembering so many chunks."""

    def make() -> IdsOfChunk | IdsOfText:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as f:
            plain = splits_at_spaces(json.load(f))
        return IdsOfChunk(tokenizer, chunks) if plain else IdsOfText(tokenizer)

    return workers.kept(("ids", tokenizer_path, chunks), make)


def remainder_cuts(length: int, capacity: int, waste: float) -> list[tuple[int, int]]:
    """(length, class) of the pieces that a remainder of fewer than ``capacity`` ids is cut into."""
    out = []
    while length > 0:
        k = capacity // length
        slot = capacity // k
        if slot - length <= waste * slot:
            out.append((length, k))
            break
        cut = capacity // (k + 1)
        out.append((cut, k + 1))
        length -= cut
    return out


class Packer:
    """One worker's bins. ``emit`` collects rows (doc_id, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, worker: int, capacity: int, waste: float):
        self.next, self.capacity, self.waste = worker << WORKER_SHIFT, capacity, waste
        self.open: dict[int, list] = {}
        self.cuts: dict[int, list[tuple[int, int]]] = {}
        self.rows: list[tuple] = []

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc_id, ids: bytes) -> None:
        n, at = len(ids) // WIDTH, 0
        while n - at >= self.capacity:
            self.put(doc_id, at, ids[at * WIDTH : (at + self.capacity) * WIDTH], n, self.sequence(), 0)
            at += self.capacity
        rest = n - at
        if rest not in self.cuts:
            self.cuts[rest] = remainder_cuts(rest, self.capacity, self.waste)
        for length, k in self.cuts[rest]:
            part = ids[at * WIDTH : (at + length) * WIDTH]
            if k == 1:
                self.put(doc_id, at, part, n, self.sequence(), 0)
            else:
                bin_ = self.open.setdefault(k, [])
                bin_.append((doc_id, at, part, n))
                if len(bin_) == k:
                    self.close(self.open.pop(k))
            at += length

    def put(self, doc_id, start: int, part: bytes, n: int, sequence: int, offset: int) -> None:
        self.rows.append((doc_id, start, len(part) // WIDTH, zlib.crc32(part), n, sequence, offset))

    def close(self, pieces: list) -> None:
        sequence, offset = self.sequence(), 0
        for doc_id, start, part, n in pieces:
            self.put(doc_id, start, part, n, sequence, offset)
            offset += len(part) // WIDTH

    def finish(self) -> None:
        """Lay the pieces of all open bins end to end, cut at the capacity."""
        filled, sequence = 0, None
        for k in sorted(self.open):
            for doc_id, start, part, n in self.open[k]:
                while part:
                    if sequence is None:
                        sequence, filled = self.sequence(), 0
                    take = part[: (self.capacity - filled) * WIDTH]
                    self.put(doc_id, start, take, n, sequence, filled)
                    filled += len(take) // WIDTH
                    start, part = start + len(take) // WIDTH, part[len(take) :]
                    if filled == self.capacity:
                        sequence = None
        self.open = {}

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        self.rows = []
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack_harmonic(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, waste: float = 1 / 64, id_col: str = "doc_id", text_col: str = "text", chunks: int = CHUNKS,
) -> DataFrame:
    """One row per piece; a document's ids are the tokenizer's, without special ids added, then ``end_id``.

    Columns: doc_id, start (the document's ids before the piece), length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), doc_tokens, sequence_id, offset. ``tokenizer_path`` must exist on every worker. ``chunks`` trades a worker's memory for time.
    """
    shared.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_by(tokenizer_path, chunks)
        end = np.asarray([end_id], "<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId(), capacity, waste)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, ids.of_text(text.as_py() or "") + end)
            if len(packer.rows) >= BATCH_ROWS:
                yield packer.drain()
        packer.finish()
        yield packer.drain()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(workers.tidied(run), SCHEMA)
