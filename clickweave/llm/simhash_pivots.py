"""SimHash near-dedup with pivot distance tables.

Distinct fingerprints are compared through their Hamming distances to many
fixed reference fingerprints (pivots). By the triangle inequality two
fingerprints within r bits differ by at most r in every distance. Two pivot
tables use that:

* the *masked* table finds candidates. The 64 bits are cut into r + 2 blocks;
  fingerprints within r bits agree on two whole blocks at least, and on these
  blocks all their pivot distances are equal. So an equality join on the
  distances under each two blocks' mask meets every pair.
* the *whole* table discards candidates whose largest coordinate difference
  is over r; survivors are verified bit by bit.

Cells of the masked table over ``max_cell`` members are not joined pair by
pair. Their fingerprints are linked exactly through one-bit neighbours: two
fingerprints are within 2 bits if and only if some value is within one bit of
both, and at most 65 fingerprints are that near to a value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.llm.common import fresh
from clickweave.llm.components import connected_components
from clickweave.session import materialize

SLICE = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def simhash(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text: XXH64 of its word shingles, a bit set when
    over half of the hashes have it; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        grams = zip(*(words[at + i : min(at + SLICE, n) + i] for i in range(min(shingle, len(words)))))
        hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, grams), repeat(seed)), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` (null: empty) as the long ``name``."""
    where = docs.columns.index(text)
    schema = docs.withColumn(name, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((simhash(t.as_py() or "", shingle) for t in batch.column(where)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def _pivots(n: int, seed: int) -> list[int]:
    rng = Random(seed)
    return [rng.getrandbits(64) for _ in range(n)]


def _masks(max_bits: int) -> list[int]:
    """Masks of every two of ``max_bits`` + 2 blocks."""
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _distance(x: Column, pivot: int, mask: int = (1 << 64) - 1) -> Column:
    return F.bit_count(x.bitwiseXOR(F.lit(_signed(pivot))).bitwiseAND(F.lit(_signed(mask))))


def fingerprint_links(
    prints: DataFrame, max_bits: int = 2, n_pivots: int = 24, max_cell: int = 64, seed: int = 7
) -> DataFrame:
    """Links between the distinct longs ``fp`` of ``prints``: ``a``, ``b``.
    Every two values within ``max_bits`` (0 to 2) bits are linked directly or
    through a common value; no others are.

    The table holds each value's distances to ``n_pivots`` reference values.
    Two values within ``max_bits`` bits have, under one of a few masks, the same
    masked distance to every pivot: these tables of masked distances deal the
    values to cells. Within a cell, pairs whose whole distances differ by more
    than ``max_bits`` at any pivot are discarded, and the rest verified bit by
    bit. Cells over ``max_cell`` values are not paired: there values meet at
    the values one bit away from both, which gives the same groups."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits: 0, 1 or 2")
    fp = F.col("fp")
    pivots = _pivots(n_pivots, seed)
    # the distance table: eight distances of 0 to 64 fit into one long
    packs = [pivots[i : i + 8] for i in range(0, n_pivots, 8)]
    table = F.array(
        *(sum((F.shiftleft(_distance(fp, p).cast("long"), 7 * i) for i, p in enumerate(pack)), F.lit(0).cast("long")) for pack in packs)
    )
    cells = [F.xxhash64(F.lit(t), *(_distance(fp, p, m) for p in pivots)) for t, m in enumerate(_masks(max_bits))]
    keyed = prints.select(fp, table.alias("distances"), F.explode(F.array(*cells)).alias("cell"))
    sizes = materialize(keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "cells")
    members = materialize(keyed.join(sizes, "cell"), "members")

    a, b = (members.filter(F.col("n") <= max_cell).select("cell", *(F.col(c).alias(c + s) for c in ("fp", "distances"))) for s in "ab")
    def distance_at(side: str, k: int) -> Column:
        return F.shiftright(F.get(f"distances{side}", F.lit(k // 8)), 7 * (k % 8)).bitwiseAND(F.lit(127))

    # the maximum coordinate difference: a pivot tells two values apart by no more than their own distance
    apart = F.greatest(*(F.abs(distance_at("a", k) - distance_at("b", k)) for k in range(n_pivots)))
    verified = F.bit_count(F.col("fpa").bitwiseXOR(F.col("fpb"))) <= max_bits
    pairs = a.join(b, "cell").filter((F.col("fpa") < F.col("fpb")) & (apart <= max_bits) & verified)
    links = pairs.select(F.col("fpa").alias("a"), F.col("fpb").alias("b"))

    crowded = members.filter(F.col("n") > max_cell).select("fp").distinct()
    bits = [F.lit(_signed(1 << i)) for i in range(64)]
    if max_bits == 2:
        meet = F.array(F.struct(F.lit(64).alias("i"), fp.alias("z")), *(F.struct(F.lit(64).alias("i"), fp.bitwiseXOR(b).alias("z")) for b in bits))
    else:  # equal but for bit i
        meet = F.array(*(F.struct(F.lit(i).alias("i"), fp.bitwiseAND(F.bitwise_not(b)).alias("z")) for i, b in enumerate(bits)))
    if max_bits:
        near = crowded.select("fp", F.explode(meet).alias("m")).groupBy("m").agg(F.collect_set("fp").alias("all"))
        one = F.array_min("all")  # of at most 65
        links = links.unionByName(near.filter(F.size("all") > 1).select(one.alias("a"), F.explode("all").alias("b")).filter("a <> b"))
    return links


def fingerprint_groups(fingerprints: DataFrame, max_bits: int = 2) -> DataFrame:
    """``fp``, ``root`` (a value that names the group), ``component_id`` (the
    smallest doc_id of the group; null if it has none) of the distinct ``fp``
    in ``fingerprints`` (``doc_id``, ``fp``)."""
    prints = materialize(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    found = connected_components(fingerprint_links(prints, max_bits))
    named = materialize(
        prints.join(found, prints["fp"] == found["node"], "left").select(
            "fp", "first_id", F.coalesce("component", "fp").alias("root")
        ),
        "roots",
    )
    first = materialize(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "groups")
    return materialize(named.join(first, "root").select("fp", "root", "first_id", "component_id"), "fp_groups")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of each row.

    Fingerprints within ``max_bits`` bits are linked; component_id is the
    smallest doc_id that links reach. Null texts are empty; texts without
    words have fingerprint zero and link like others. Rows without a doc_id
    take part, but name no component (null if no other row does). Repeated
    rows are returned each. Only ``doc_id`` and ``text`` are read.
    """
    slim = with_fingerprint(docs.select("doc_id", F.col("text").cast("string")), "fp", shingle=shingle)
    fingerprints = materialize(slim.select("doc_id", "fp"), "fingerprints")
    groups = fingerprint_groups(fingerprints, max_bits).select("fp", "component_id")
    return fingerprints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group: the one whose doc_id names it.

    Among rows that repeat this doc_id, and in groups without any doc_id, the
    row that sorts first by text and then by its other columns stays. Null and
    empty texts have fingerprint zero and form one group. Columns keep their
    names and values, whatever they are called. An empty table gives an empty
    table.
    """
    fp = fresh(docs, "fp")
    spark_rows = with_fingerprint(docs, fp, shingle=shingle)
    rows = materialize(spark_rows, "scored")
    chosen_fp, chosen_id, copies = (fresh(rows, c) for c in ("chosen_fp", "chosen_id", "copies"))
    slim = rows.select("doc_id", F.col(fp).alias("fp"))
    groups = fingerprint_groups(slim, max_bits)
    named = groups.filter((F.col("first_id").eqNullSafe(F.col("component_id"))) & (F.col("component_id").isNotNull() | (F.col("fp") == F.col("root"))))
    many = slim.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    chosen = materialize(
        named.alias("g")
        .join(many.alias("m"), (F.col("g.fp") == F.col("m.fp")) & F.col("g.first_id").eqNullSafe(F.col("m.doc_id")))
        .select(F.col("g.fp").alias(chosen_fp), F.col("g.first_id").alias(chosen_id), F.col("n").alias(copies)),
        "chosen",
    )
    single = chosen.filter(F.col(copies) == 1)
    match = (F.col(fp) == F.col(chosen_fp)) & F.col("doc_id").eqNullSafe(F.col(chosen_id))
    kept = rows.join(single, match, "left_semi").drop(fp)
    repeated = chosen.filter(F.col(copies) > 1)
    if repeated.isEmpty():
        return kept
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = W.partitionBy(fp, "doc_id").orderBy("text", *(F.col(f"`{c}`").cast("string") for c in others))
    rank = fresh(rows, "rank")
    again = rows.join(repeated, match, "left_semi").withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1)
    return kept.unionByName(again.drop(fp, rank))
