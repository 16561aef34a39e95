"""Token counts of byte-level BPE without token ids.

The pieces of each distinct pre-token are counted once, in a table (pre-token, pieces). Documents are turned into frequencies
of pre-tokens, which are joined to that table and summed. A bounded head of frequent pre-tokens is joined by broadcast
within the scan; only what is left, rare pre-tokens with the row's number and frequency, goes through a shuffled join.

Texts of any length go through whole; a text without spaces is one chunk, which is taken apart and not held. Nulls: a null text
is the empty text (0 bytes, 0 tokens); a null id stays null. Repeated rows are counted each, since the join runs on a row number
of its own. An empty table gives an empty result. Only ``id_col`` and ``text_col`` are read, whatever other columns are called.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, workers

#: Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Pre-tokens in the broadcast head at most, and bytes of the longest one there: together they bound its size.
HEAD, HEAD_BYTES = 300_000, 32
#: Distinct chunks that a worker holds before it passes their pre-tokens' frequencies on, or remembers, and characters of the longest one
#: held. Longer chunks are taken apart at once, so a table is bounded in bytes whatever the texts are.
FLUSH, LONGEST = 250_000, 32
#: Characters of pre-tokens from long chunks that a worker holds before it passes their frequencies on.
FLUSH_CHARS = 8 << 20


#: A space before anything but white space. Python knows a few more kinds of that than the pattern does: such texts are split less.
_GAP = re.compile(r" (?=\S)")


class PreTokens:
    """Splits texts first before each single space that a character other than white space follows: pre-tokens start there, whatever
    comes before, and what comes before falls into the same pre-tokens without the rest.

    Special strings stand apart and count as one token each, as the vocabulary's library has them.
    """

    def __init__(self, special: list[str]):
        self.find = regex.compile(PATTERN, regex.V1).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def segments(self, text: str) -> tuple[int, list[str]]:
        """Number of special strings in the text, and what lies between them."""
        if self.special is None or not (parts := self.special.split(text))[1:]:
            return 0, [text]
        return len(parts) - 1, parts

    def chunks(self, text: str) -> list[str]:
        plain = "  " not in text and text.isprintable()  # single spaces are the only white space
        first, *more = text.split(" ") if plain else _GAP.split(text)
        return [first, *(" " + x for x in more)]


class Chunks(dict):
    """Pieces of a chunk whose pre-tokens are all in the head; the pre-tokens that aren't, of chunks looked up since, gather in ``tail``."""

    def __init__(self, pieces_of: dict[str, int], split: PreTokens):
        super().__init__()
        self.pieces_of, self.split = pieces_of, split
        self.tail: list[str] = []

    def __missing__(self, chunk: str) -> int:
        tokens = self.split.find(chunk)
        others = [t for t in tokens if t not in self.pieces_of]
        out = sum(self.pieces_of.get(t, 0) for t in tokens)
        if others:
            self.tail += others
        elif len(self) < FLUSH and len(chunk) <= LONGEST:
            self[chunk] = out
        return out


def _chunks(known, split: PreTokens) -> Chunks:
    """The worker's table for a broadcast head."""
    return workers.kept(("chunks", known.value[2]), lambda: Chunks(dict(zip(*known.value[:2], strict=True)), split))


def special_strings(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def piece_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """(token, freq, pieces): each distinct pre-token of all texts, how often it comes, and its number of pieces."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workers.drop()
        split = PreTokens(special_strings(_load(tokenizer_path)))
        chunks: Counter = Counter()
        found: Counter = Counter()
        held = 0

        def flush() -> pa.RecordBatch:
            for chunk, n in chunks.items():
                for token in split.find(chunk):
                    found[token] += n
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["token", "n"])
            chunks.clear()
            found.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                for segment in split.segments(text.as_py() or "")[1]:
                    parts = split.chunks(segment)
                    if len(max(parts, key=len)) > LONGEST:
                        for part in parts:
                            if len(part) > LONGEST:
                                tokens = split.find(part)
                                held += len(part)
                                found.update(tokens)
                        parts = [x for x in parts if len(x) <= LONGEST]
                    chunks.update(parts)
                if len(chunks) >= FLUSH or held >= FLUSH_CHARS:
                    yield flush()
                    held = 0
        yield flush()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _load(tokenizer_path)
        tokenizer.encode_special_tokens = True
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            n: list[int] = []
            for at in range(0, len(tokens), 2000):
                n += [len(e.ids) for e in tokenizer.encode_batch_fast(tokens[at : at + 2000], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int32())], ["token", "freq", "pieces"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(workers.tidied(seen), "token string, n long")
    found = found.groupBy("token").agg(F.sum("n").alias("freq"))
    return shared.staged(found.mapInArrow(workers.tidied(pieces), "token string, freq long, pieces int"), "token-pieces")


def _head(pieces: DataFrame, size: int) -> pa.Table:
    """The most frequent pre-tokens, at most ``size``: those above the frequency that so many exceed."""
    short = pieces.filter(F.octet_length("token") <= HEAD_BYTES)
    ranks = short.groupBy(F.least("freq", F.lit(1_000_000)).alias("freq")).agg(F.count(F.lit(1)).alias("n"))
    least, total = None, 0
    for freq, n in ranks.orderBy(F.col("freq").desc()).limit(size).collect():
        if total + n > size:
            break
        least, total = freq, total + n
    if least is None:
        return short.limit(0).select("token", "pieces").toArrow()
    return short.filter(F.col("freq") >= least).select("token", "pieces").toArrow()


def count_tokens(docs: DataFrame, tokenizer_path: str, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``. ``tokenizer_path`` must exist on every worker."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    pieces = piece_counts(docs, tokenizer_path, text_col)
    top = _head(pieces, head)
    known = spark.sparkContext.broadcast((top.column(0).to_pylist(), top.column(1).to_pylist(), uuid.uuid4().hex))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PreTokens(special_strings(_load(tokenizer_path)))
        row = TaskContext.get().partitionId() << 33

        chunks = _chunks(known, split)
        for batch in batches:
            rows, n_bytes, sums, rare, times = [], [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                total, segments = split.segments(text)
                chunks.tail = []
                for segment in segments:
                    total += sum(map(chunks.__getitem__, split.chunks(segment)))
                freq = Counter(chunks.tail)
                rows.append(row)
                n_bytes.append(len(text.encode("utf-8", "replace")))
                sums.append(total)
                rare.append(list(freq))
                times.append(list(freq.values()))
                row += 1
            columns = [pa.array(rows, pa.int64()), batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(sums, pa.int64()), pa.array(rare, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_bytes", "n", "tokens", "times"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = shared.staged(source.mapInArrow(workers.tidied(frequencies), "row long, doc_id long, n_bytes long, n long, tokens array<string>, times array<int>"), "token-frequencies")
    tail = rows.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t")).select("row", F.col("t.tokens").alias("token"), F.col("t.times").alias("times"))
    more = tail.join(pieces.select("token", "pieces"), "token").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
    out = rows.select("row", "doc_id", "n_bytes", "n").join(more, "row", "left")
    return out.select("doc_id", "n_bytes", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_tokens"))
