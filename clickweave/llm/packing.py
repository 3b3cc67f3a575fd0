"""Documents packed into fixed-length token sequences, shortest pack first.

Tokenised documents are cut into pieces of at most ``max_tokens``. The
histogram of piece lengths (at most ``max_tokens`` numbers, whatever the
corpus) is packed on the driver: lengths are placed longest first, always into
the pattern with the most room, and only counts of equal sequences are
touched. Each step says: of this length, the pieces of these ranks stand at
this offset of these sequences; pieces then look up their own rank.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.llm.common import per_worker
from clickweave.session import materialize

#: Entries that a worker's word cache holds before it starts anew.
CACHE_WORDS = 300_000
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

#: The normalizer and pre-tokenizer for which words can be encoded one by one.
WORD_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
WORD_CUT = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class PieceIds(dict):
    """Token ids (little-endian uint32 bytes) of lower-cased pieces, straight from the file's BPE model."""

    def __init__(self, model: Any):
        super().__init__()
        self.model = model
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = [b for b in range(256) if b not in set(printable)]
        self.byte_chars = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        # printable ASCII stands for itself
        chars = piece if piece.isascii() else "".join(map(self.byte_chars.__getitem__, piece.encode()))
        out = self[piece] = pack_ids([t.id for t in self.model.tokenize(chars)])
        return out


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(dict):
    """Token ids (little-endian uint32 bytes) of texts and of words cut at ASCII white space.

    For tokenizers that drop white space and never merge across it (``fits``
    tells), so a text's ids are its words' ids in a row. Texts of plain
    letters, digits and punctuation are cut by the tokenizer's own pattern and
    their pieces go to its BPE model; in other texts so do the plain words, and
    the rest (rare scripts, special tokens) take the whole encoder.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = PieceIds(self.tokenizer.model)
        #: ASCII and the accented Latin-1 letters: lower-casing and NFC are plain there.
        self.plain = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
        self.plain_text = re.compile(r"[ \t-\r!-~À-ÖØ-öø-ÿ]*").fullmatch
        self.cut = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-zß-öø-ÿ0-9]+").findall

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = word.decode()
        if self.plain(text) and "<|" not in text:
            out = b"".join(map(self.pieces.__getitem__, self.cut(text.lower())))
        else:
            out = pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        if self.plain_text(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, self.cut(text.lower())))
        return b"".join(map(self.__getitem__, text.encode().split()))

    @staticmethod
    def fits(path: str) -> bool:
        """Whether the file cuts, lower-cases and composes texts the way that this class does."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        marks = all(a["special"] and a["content"].startswith("<|") for a in spec["added_tokens"])
        steps = (spec.get("normalizer"), spec.get("pre_tokenizer"))
        return model["type"] == "BPE" and plain and marks and steps == (WORD_NORMALIZER, WORD_CUT)


class TextIds:
    """Token ids of whole texts by any tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def ids_by(path: str) -> WordIds | TextIds:
    """The word cache where the file is known to allow it, the tokenizer itself for any other."""
    return WordIds(path) if WordIds.fits(path) else TextIds(path)


def cut_documents(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: every document's ids with ``end_id`` behind them, cut
    after each ``max_tokens``. Null texts are empty and give the end alone."""
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECE_SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker(("word_ids", tokenizer), lambda: ids_by(tokenizer))
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1)):
                tokens = words.encode(text.as_py() or "") + end
                n = len(tokens) // 4
                for start in range(0, n, max_tokens):
                    cut = tokens[4 * start : 4 * (start + max_tokens)]
                    out.append((doc_id, start, len(cut) // 4, zlib.crc32(cut), n))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE_SCHEMA)


def shortest_pack_first(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, int, int, int, int]]:
    """Placements ``(length, first rank, count, first sequence, offset)``: the
    pieces of ``length`` with these ranks stand at ``offset`` of as many
    sequences in a row.

    A pattern is a run of sequences filled alike. The one with the most room
    takes the next pieces; it is split when fewer pieces than sequences are
    left, so the number of steps depends on ``max_tokens`` only.
    """
    placed: list[tuple[int, int, int, int, int]] = []
    open_patterns: list[tuple[int, int, int]] = []  # (-room, first sequence, sequences)
    n_sequences = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if open_patterns and -open_patterns[0][0] >= length:
                room, first, count = heapq.heappop(open_patterns)
                room = -room
            else:
                # as few new sequences as can hold what is left
                room, first, count = max_tokens, n_sequences, -(-left // (max_tokens // length))
                n_sequences += count
            n = min(left, count)
            placed.append((length, rank, n, first, max_tokens - room))
            if count > n:
                heapq.heappush(open_patterns, (-room, first + n, count - n))
            if room > length:
                heapq.heappush(open_patterns, (length - room, first, n))
            rank, left = rank + n, left - n
    return placed


def pack_documents(
    docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 1, rank_buckets: int = 1024
) -> DataFrame:
    """Pieces of ``docs`` (``doc_id``, ``text``) with their places.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset:
    the pieces of a sequence fill it gaplessly from offset 0, up to
    ``max_tokens``. Null and empty texts are the end token alone. A null
    doc_id stays null. Repeated rows are packed each. Other columns are not
    read. An empty table gives an empty table.

    Ranks within a length are numbered within ``rank_buckets`` hash buckets
    whose sizes are summed up first, so a length that a third of all pieces
    have, or one piece that as many rows repeat, is numbered by as many tasks.
    """
    spark = docs.sparkSession
    cut = cut_documents(docs, tokenizer, max_tokens, end_id)
    # exact repeats of a piece are dealt by their number in the task, which is written with them
    dealt = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id() % rank_buckets)
    pieces = materialize(cut.withColumn("bucket", F.pmod(dealt, F.lit(rank_buckets))), "pieces")
    sizes = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = W.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        pieces.withColumn("within", F.row_number().over(within))
        .join(first, ["length", "bucket"])
        .select(*(c.split()[0] for c in PIECE_SCHEMA.split(", ")), (F.col("first") + F.col("within") - 1).alias("rank"))
    )
    steps = np.array(sorted(shortest_pack_first(histogram, max_tokens)), dtype=np.int64).reshape(-1, 5)
    sent = spark.sparkContext.broadcast(steps)  # bounded by max_tokens, not by the corpus
    out_schema = pa.schema([(c.split()[0], pa.int64()) for c in f"{PIECE_SCHEMA}, sequence_id long, offset long".split(", ")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = sent.value
        starts = (steps[:, 0] << 48) + steps[:, 1]
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(starts, (length << 48) + rank, side="right") - 1
            places: list[Any] = [pa.array(steps[at, 3] + rank - steps[at, 1]), pa.array(steps[at, 4])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *places], schema=out_schema)

    return ranked.mapInArrow(place, f"{PIECE_SCHEMA}, sequence_id long, offset long")
