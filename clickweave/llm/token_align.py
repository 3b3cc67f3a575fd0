"""Token sequences of two tokenizers aligned by byte offsets, in Arrow arrays.

Workers tokenize a batch twice and go on with flat arrays: the token lists are
flattened beside their parent indices, running sums of the tokens' byte
lengths give each token's end in its document, and an Acero hash join on
(document, end) keys of the two sides tells where both end. Pair counts are
partial ``Table.group_by`` results that Spark merges; each document's links then
look up their counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import per_worker
from clickweave.session import work_path

#: Characters, or links, of the texts that are worked on at once; a longer text goes alone.
CHUNK = 250_000
#: Links of a row between the steps: Spark's batches hold rows, so a document's links go in rows of bounded size.
PIECE = 256
#: Distinct pairs that a worker counts before it hands the counts on.
HELD_PAIRS = 1_000_000
#: Pairs whose counts are sent to the workers (the most frequent ones; any others meet theirs in a join).
SENT_PAIRS = 1_000_000

COUNTS = ("n_a", "n_b", "n_groups", "n_links")

#: Fixed value: the cut of the public byte-level BPE family, as its pre-tokenizer does it.
BYTE_LEVEL_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable bytes for themselves, the others from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file; special tokens' strings are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_of_char()
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        decoded = {i: t.encode() for t, i in special.items()}
        entries = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        for t, i in entries.items():
            decoded[i] = bytes(map(to_byte.__getitem__, t)) if to_byte.keys() >= set(t) else t.encode()
        self.tokens = [decoded.get(i, b"") for i in range(max(decoded) + 1)]
        self.ranks = self._as_ranks(spec, entries, {decoded[i]: i for i in entries.values()})
        if self.ranks is not None:
            self.tokenizer = None  # its memory is free for the texts

    def _as_ranks(self, spec: dict, entries: dict[str, int], ranks: dict[bytes, int]) -> Any:
        """The same encoder by merge ranks, several times faster; None unless it is provably the same: the file
        has nothing but the known cut, ids in the order of merges, and every entry is reached by merging (then two
        neighbours that make up an entry are always merged)."""
        import tiktoken

        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        known = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        extras = [spec.get("normalizer"), model.get("dropout"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix")]
        if not known or any(extras) or model.get("type") != "BPE" or not all(a["special"] for a in spec["added_tokens"]):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        whole = len(ranks) == len(entries) and all(bytes([b]) in ranks for b in range(256))
        if not whole or made != sorted(set(made)) or any([x.id for x in self.tokenizer.model.tokenize(t)] != [i] for t, i in entries.items()):
            return None
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if self.ranks is not None:
            ids = [self.ranks.encode_to_numpy(t, disallowed_special=()) for t in texts]
        else:
            ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32), np.array([len(i) for i in ids], np.int64)


class Pieces:
    """Ids and token bytes of a sentence-piece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(self.model.id_to_piece(list(range(n))))
        ]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.encode(texts, num_threads=1)
        counts = np.array([len(i) for i in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts


class Aligner:
    """Both tokenizers of a worker, with what their tokens look like in bytes and in the digested text."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.bytes_a, self.bytes_b = (pa.array(x.tokens, pa.binary()) for x in (self.a, self.b))
        # a token of A ends in "," inside its group and in "|" at its side's end; one of B in "," or ";"
        self.after_a = 2 * len(self.a.tokens)
        written = [f"{i}{c}" for i in range(len(self.a.tokens)) for c in ",|"]
        written += [f"{i}{c}" for i in range(len(self.b.tokens)) for c in ",;"]
        self.written = pa.array(written, pa.binary())

    def whole(self, ids: np.ndarray, counts: np.ndarray, vocabulary: pa.Array, texts: list[bytes]) -> list[bool]:
        """Whether the joined token bytes of each text are the text."""
        joined = pc.take(vocabulary, pa.array(ids))
        data, ends = _joined(joined), _ends(counts)
        starts = _byte_offsets(joined)[np.concatenate([[0], ends])]
        return [data[starts[i] : starts[i + 1]] == text for i, text in enumerate(texts)]

    def align(self, texts: list[str | None]) -> dict[str, Any]:
        """Counts, digests and links (flat, with the number of each text) of ``texts``."""
        at: Any = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in at]
        ids_a, n_a = self.a.encode(spaced)
        ids_b, n_b = self.b.encode([t[1:] for t in spaced])
        raw = [t.encode("utf-8", "surrogatepass") for t in spaced]
        if not at:
            none = np.empty(0, np.int32)
            zeros = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
            return zeros | {"groups_sha256": [""] * len(texts), "link_a": none, "link_b": none}
        fine = np.logical_and(self.whole(ids_a, n_a, self.bytes_a, raw), self.whole(ids_b, n_b, self.bytes_b, raw))
        ids_a, ids_b = ids_a[np.repeat(fine, n_a)], ids_b[np.repeat(fine, n_b)]  # without the texts that do not come back
        at, n_a, n_b = np.array(at, np.int64)[fine], n_a[fine], n_b[fine]
        base = _ends(np.array([len(raw[i]) for i in np.flatnonzero(fine)], np.int64))  # where each document's bytes end
        out: dict[str, Any] = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
        digests = [""] * len(texts)
        out["n_a"][at], out["n_b"][at] = n_a, n_b

        def side(ids: np.ndarray, counts: np.ndarray, vocabulary: pa.Array, name: str) -> pa.Table:
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], _ends(counts)]), pa.int32()), pa.array(ids))
            flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
            running = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(vocabulary, flat)), pa.int64()))
            # the sum begins anew in each document, so (document, end) is the key
            begins = pc.take(pa.array(np.concatenate([[0], base])[:-1] if len(base) else base), parent)
            return pa.table({"doc": parent, "end": pc.subtract(running, begins), name: np.arange(len(ids), dtype=np.int64)})

        side_a, side_b = (side(*x) for x in ((ids_a, n_a, self.bytes_a, "ia"), (ids_b, n_b, self.bytes_b, "ib")))
        # every end of either side closes one stretch of bytes that is held by one token of each: one link
        links = side_a.join(side_b, keys=["doc", "end"], join_type="full outer", use_threads=False)
        links = links.take(pc.sort_indices(links, sort_keys=[("doc", "ascending"), ("end", "ascending")])).combine_chunks()
        both = pc.and_(pc.is_valid(links["ia"]), pc.is_valid(links["ib"])).to_numpy(zero_copy_only=False)
        ia, ib = (pc.fill_null_backward(links[c]).to_numpy() for c in ("ia", "ib"))
        doc = links["doc"].to_numpy()
        out["n_links"][at] = np.bincount(doc, minlength=len(at))
        out["n_groups"][at] = np.bincount(doc[both], minlength=len(at))

        # groups end at the links at which both sides end; their last tokens are known, so is every token's group
        last_a, last_b = ia[both], ib[both]
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        group_a, group_b = np.repeat(np.arange(len(last_a)), size_a), np.repeat(np.arange(len(last_b)), size_b)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        ends_here = np.zeros(len(ids_a), np.int64)
        ends_here[last_a] = 1
        codes[np.arange(len(ids_a)) + (last_b + 1 - size_b)[group_a]] = 2 * ids_a.astype(np.int64) + ends_here
        ends_here = np.zeros(len(ids_b), np.int64)
        ends_here[last_b] = 1
        codes[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = self.after_a + 2 * ids_b.astype(np.int64) + ends_here
        shown = pc.take(self.written, pa.array(codes))
        data, offsets = _joined(shown), _byte_offsets(shown)
        starts = offsets[np.concatenate([[0], _ends(n_a + n_b)])]
        for k, i in enumerate(at):
            digests[i] = hashlib.sha256(data[starts[k] : starts[k + 1] - 1]).hexdigest()
        return out | {"groups_sha256": digests, "link_a": ids_a[ia], "link_b": ids_b[ib]}


def _ends(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts, dtype=np.int64)


def _byte_offsets(values: pa.Array) -> np.ndarray:
    first = values.offset
    return np.frombuffer(values.buffers()[1], np.int32)[first : first + len(values) + 1].astype(np.int64)


def _joined(values: pa.Array) -> memoryview:
    return memoryview(values.buffers()[2] or b"").cast("B")


def _chunks(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in stretches of about CHUNK characters or links in all."""
    start = held = 0
    for i, n in enumerate(pc.fill_null(sizes, 0).to_numpy()):
        if held and held + n > CHUNK:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link_a array<int>, link_b array<int>"


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of up to PIECE links of a row of ``docs``, one at least: ``row`` (a
    number of its own), doc_id, the counts and digest of its whole alignment,
    and the links as two lists of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        for batch in batches:
            for part in _chunks(batch, pc.utf8_length(batch.column(2))):
                found = aligner.align(part.column(2).to_pylist())
                pieces = np.maximum(1, -(-found["n_links"] // PIECE))
                of = np.repeat(np.arange(part.num_rows), pieces)
                nth = np.arange(len(of)) - np.repeat(_ends(pieces) - pieces, pieces)
                sizes = np.minimum(PIECE, found["n_links"][of] - nth * PIECE)
                offsets = pa.array(np.concatenate([[0], _ends(sizes)]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(found[c])) for c in ("link_a", "link_b")]
                whole = [*part.columns[:2], *(pa.array(found[c]) for c in COUNTS), pa.array(found["groups_sha256"], pa.string())]
                columns = [*(c.take(pa.array(of)) for c in whole), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return read.mapInArrow(run, ALIGNED)


def _pairs(batch: pa.RecordBatch, a: int, b: int) -> pa.Table:
    return pa.table({"a": pc.list_flatten(batch.column(a)), "b": pc.list_flatten(batch.column(b))})


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n`` (links that hold the pair, over all documents) and
    ``best`` (whether n is the greatest of that b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        for batch in batches:
            for part in _chunks(batch, pc.list_value_length(batch.column(0))):
                new = _pairs(part, 0, 1).group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
                both = pa.concat_tables([held, new.select(["a", "b", "count_all"]).rename_columns(["a", "b", "n"])])
                held = both.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])
                if held.num_rows >= HELD_PAIRS:
                    yield from held.to_batches()
                    held = held.slice(0, 0)
        yield from held.to_batches()

    counts = aligned.select("link_a", "link_b").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    spark = aligned.sparkSession
    path = work_path(spark, "pairs", unique=True)
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    top = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_pairs(counts: DataFrame, at_most: int) -> pa.Table:
    """The pairs of n >= 2^k, with the smallest k for which they are not more than ``at_most``."""
    power = (F.length(F.bin("n")) - 1).alias("power")
    sizes = {r["power"]: r["size"] for r in counts.groupBy(power).agg(F.count(F.lit(1)).alias("size")).collect()}
    least, total = max(sizes, default=0) + 1, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= at_most:
        least, total = least - 1, total + sizes.get(least - 1, 0)
    return counts.filter(F.col("n") >= 2**least).toArrow()


def align_tokens(docs: DataFrame, path_a: str, path_b: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """Alignment of the tokens of a byte-level BPE file (A, which encodes a
    space and the text) and of a sentence-piece model (B, which adds that
    space), for every row of ``docs`` (``doc_id``, ``text``).

    Returns doc_id, n_a, n_b (tokens), n_groups (stretches between byte
    offsets where a token of both ends), n_links (pairs of tokens whose bytes
    overlap), n_best (links whose pair is the most counted one of its B id over
    all documents, ties included), count_sum (the counts of its links added
    up), groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).

    A text that is null or empty, or whose tokens' bytes do not make up the
    space and the text, has zeros and an empty digest. A null doc_id stays
    null; rows that repeat an id or a text are aligned and counted each. Very
    long texts are aligned in one piece: a worker holds about 300 bytes a token
    of the longest text. An empty table gives an empty table. Other columns
    are not read.

    The counts of the ``sent_pairs`` most frequent pairs are sent to the
    workers, whatever the corpus; links of any other pair are added up per row
    and joined with their counts.
    """
    spark = docs.sparkSession
    path = work_path(spark, "aligned", unique=True)
    align_documents(docs, path_a, path_b).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    pairs_path = work_path(spark, "pair_counts", unique=True)
    pair_counts(aligned).write.parquet(pairs_path)
    counts = spark.read.parquet(pairs_path)
    frequent = frequent_pairs(counts, sent_pairs)
    keys = (frequent["a"].to_numpy().astype(np.int64) << 32) | frequent["b"].to_numpy()
    order = np.argsort(keys)
    sent = spark.sparkContext.broadcast(  # bounded by sent_pairs
        (path, keys[order], frequent["n"].to_numpy()[order], frequent["best"].to_numpy()[order])
    )
    columns = ["row", "doc_id", *COUNTS, "groups_sha256"]
    names = [*columns, "n_best", "count_sum", "rare_a", "rare_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        key, keys, n, best = sent.value
        index = per_worker(("pair_index", key), lambda: pd.Index(keys))
        n, best = np.append(n, 0), np.append(best, False)
        for batch in batches:
            for part in _chunks(batch, pc.list_value_length(batch.column(7))):
                links = _pairs(part, 7, 8)
                a, b = links["a"].to_numpy(), links["b"].to_numpy()
                at = index.get_indexer((a.astype(np.int64) << 32) | b)  # -1, the appended zero, where a pair is not there
                of = pc.list_parent_indices(part.column(7)).to_numpy()
                per_row = [np.bincount(of[best[at]], minlength=len(part)), _sums(of, n[at], len(part))]
                rare = at < 0
                offsets = pa.array(np.concatenate([[0], _ends(np.bincount(of[rare], minlength=len(part)))]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[rare], pa.int32())) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([*part.columns[:7], *(pa.array(x, pa.int64()) for x in per_row), *lists], names=names)

    schema = ", ".join(ALIGNED.split(", ")[:7]) + ", n_best long, count_sum long, rare_a array<int>, rare_b array<int>"
    scored = aligned.mapInArrow(run, schema)
    sums = ["n_best", "count_sum"]
    if frequent.num_rows < counts.count():
        scored_path = work_path(spark, "scored", unique=True)
        scored.write.parquet(scored_path)
        written = spark.read.parquet(scored_path)
        rare = written.select(*columns, F.explode(F.arrays_zip("rare_a", "rare_b")).alias("p"))
        rare = rare.groupBy(*columns, F.col("p.rare_a").alias("a"), F.col("p.rare_b").alias("b")).agg(F.count(F.lit(1)).alias("times"))
        # the counts are a written table, so the pairs of a hot token are split
        more = rare.join(counts, ["a", "b"]).select(
            *columns, (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")
        )
        scored = written.select(*columns, *sums).unionByName(more)
    summed = scored.groupBy(*columns).agg(*(F.sum(c).alias(c) for c in sums))
    return summed.select(*columns[1:6], *sums, "groups_sha256")


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of ``values`` by ``group`` (ascending)."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.searchsorted(group, np.arange(n), side="right")
    return np.diff(running[ends], prepend=0)
