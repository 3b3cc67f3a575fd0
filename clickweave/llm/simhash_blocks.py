"""SimHash document fingerprints and permuted block tables, with DataFrame functions only.

A text's terms are its pairs of adjacent words (lower case, cut at ASCII white
space). Each occurrence votes on 128 signed bits with the bits of the term's
hash; its weight grows with the term's length, as long pairs say more. A bit
is set if the votes for it outweigh those against.

The votes of one text are counted by ordinary sums: a bit's counter takes half
of a long, so 64 sums count 128 bits, and the partial sums of a scan's task
already hold whole texts. One short row a text is shuffled.

Fingerprints within r bits of each other agree on one of r + 1 blocks of bits.
A block table per block, led by that block, meets all such pairs in equality
joins; cells with many members are cut again by blocks of the other bits.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickweave.llm.common import ASCII_SPACE
from clickweave.session import materialize

BITS = 128
LANES = (1 << 32) + 1
MAX_WEIGHT = 16


def terms(text: Column) -> Column:
    """An array of structs a, b: each word and the one behind it (null for the last)."""
    words = F.split(F.btrim(F.lower(text), F.lit(ASCII_SPACE)), r"[ \t\n\x0B\f\r]+")
    return F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``hi`` and ``lo`` (the fingerprint's two longs) of the rows of
    ``texts``, which ``keys`` tell apart. Null texts are empty; texts without
    words vote with the empty word alone, so they are equal."""
    voting = texts.select(*keys, F.inline(terms(F.coalesce(F.col(text), F.lit("")))).alias("a", "b"))
    weight = F.least(F.char_length("a") + F.coalesce(F.char_length("b"), F.lit(0)) + 1, F.lit(MAX_WEIGHT)).cast("long")
    hashed = voting.select(*keys, weight.alias("w"), F.xxhash64("a", "b").alias("h0"), F.xxhash64(F.lit(1), "a", "b").alias("h1"))
    sums = [
        F.sum(F.col("w") * F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANES))).alias(f"{h}_{j}")
        for h in ("h0", "h1")
        for j in range(32)
    ]
    votes = hashed.groupBy(*keys).agg(F.sum("w").alias("all"), *sums)

    def word(h: str) -> Column:
        half = (1 << 32) - 1
        lanes = [(j + 32 * up, F.shiftrightunsigned(f"{h}_{j}", 32 * up).bitwiseAND(F.lit(half))) for j in range(32) for up in (0, 1)]
        bits = [F.when(2 * lane > F.col("all"), F.lit((1 << k) - (1 << 64) * (k == 63))).otherwise(0) for k, lane in lanes]
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    return votes.select(*keys, word("h0").alias("hi"), word("h1").alias("lo"))


def bits_apart(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b)), F.lit(0))


def likeness(apart: Column) -> Column:
    """The cosine of two texts' term vectors that so many differing bits speak for; 0 from half of the bits on."""
    return F.greatest(F.lit(0.0), F.cos(apart * (F.pi() / BITS)))


def shown(hi: str, lo: str) -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(F.col(x)), 16, "0") for x in (hi, lo))))


def _block(n: int, i: int, skip: tuple[int, int] | None = None) -> list[tuple[str, int]]:
    """Masks (column, mask) of the i-th of ``n`` runs of the bits outside ``skip``."""
    places = [k for k in range(BITS) if skip is None or not skip[0] <= k < skip[1]]
    run = places[len(places) * i // n : len(places) * (i + 1) // n]
    out = []
    for name, low in (("hi", 0), ("lo", 64)):
        mask = sum(1 << (k - low) for k in run if low <= k < low + 64)
        if mask:
            out.append((name, mask - (1 << 64) * (mask >> 63)))
    return out


def _cell(table: int, masks: list[tuple[str, int]]) -> Column:
    return F.xxhash64(F.lit(table), *(F.col(c).bitwiseAND(F.lit(m)) for c, m in masks))


def near_fingerprints(prints: DataFrame, radius: int = 3, max_cell: int = 256) -> DataFrame:
    """Pairs (hi, lo, hi2, lo2, apart) of the distinct fingerprints (hi, lo) of
    ``prints`` that are within ``radius`` bits, each pair once, none missing."""
    n = radius + 1
    edges = [BITS * i // n for i in range(n + 1)]
    first = [_cell(i, _block(n, i)) for i in range(n)]
    cells = prints.select("hi", "lo", F.posexplode(F.array(*first)).alias("led", "cell"))
    sizes = materialize(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "block_cells")
    members = materialize(cells.join(sizes, "cell"), "block_members")
    # Pairs in a crowded cell agree on its block, so they differ in the other bits and agree on one of n runs of these.
    finer = [F.array(*(_cell(n + n * i + j, _block(n, j, (edges[i], edges[i + 1]))) for j in range(n))) for i in range(n)]
    by_led = reduce(lambda c, i: F.when(F.col("led") == i, finer[i]).otherwise(c), range(1, n), finer[0])
    crowded = members.filter(F.col("n") > max_cell).withColumn("finer", F.explode(by_led)).select(
        "hi", "lo", F.xxhash64("cell", "finer").alias("cell")
    )
    table = members.filter(F.col("n") <= max_cell).select("hi", "lo", "cell").unionByName(crowded)
    table = materialize(table, "block_tables")
    other = table.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), "cell")
    apart = bits_apart(("hi", "lo"), ("hi2", "lo2"))
    below = (F.col("hi") < F.col("hi2")) | ((F.col("hi") == F.col("hi2")) & (F.col("lo") < F.col("lo2")))
    pairs = table.join(other, "cell").filter(below & (apart <= radius))
    return pairs.select("hi", "lo", "hi2", "lo2").distinct().withColumn("apart", apart)


def _places(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` (row, doc_id, text) with ``digest`` and ``bucket``, numbered
    upward in the order of documents; and the first document of each bucket.

    Buckets are cut at quantiles of doc_id (at most ``buckets`` numbers). An id
    that several quantiles name has its rows cut again, by digest, into as many
    parts. The rows without an id follow, by digest.
    """
    ids = docs.select("doc_id").filter("doc_id is not null")
    parts = [i / buckets for i in range(1, buckets)]
    quantiles = ids.agg(F.percentile_approx("doc_id", parts, 10 * buckets).alias("cuts")).collect()[0]["cuts"] or []
    cuts = sorted(set(quantiles))
    held = Counter(quantiles)
    hot = [(F.lit(i), F.lit(n)) for i, n in held.items() if n > 1]  # at most half as many as buckets
    steps = max(1, len(cuts)).bit_length()
    full = cuts + [(1 << 63) - 1] * ((1 << steps) - 1 - len(cuts))  # a search tree of 2^steps leaves
    bounds = F.array(*map(F.lit, full)).cast("array<bigint>") if len(full) < 64 else F.from_json(F.lit(str(full)), "array<bigint>")
    place = F.aggregate(
        F.array(*(F.lit(1 << s) for s in range(steps - 1, -1, -1))),
        F.lit(0),
        lambda at, step: F.when(F.element_at(bounds, at + step) <= F.col("doc_id"), at + step).otherwise(at),
    )
    digest = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    # a cut id comes first in its bucket: its parts by digest, then the ids behind it
    parts_of = F.create_map(*[x for pair in hot for x in pair])[F.col("doc_id")] if hot else F.lit(None).cast("int")
    share = (F.col("digest") / F.lit(float(1 << 63)) + 1) / 2
    part = F.when(parts_of.isNotNull(), F.least(F.floor(share * parts_of), parts_of - 1)).otherwise(buckets)
    unnamed = F.shiftright("digest", 54).cast("long") + ((1 << steps) + 512) * (buckets + 1)
    named = place.cast("long") * (buckets + 1) + part
    placed = docs.withColumn("digest", digest).withColumn("bucket", F.when(F.col("doc_id").isNull(), unnamed).otherwise(named))
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("lowest")
    return placed, placed.groupBy("bucket").agg(lowest)


def edited_documents(docs: DataFrame, buckets: int = 4096) -> DataFrame:
    """row, doc_id, text, n_chars, edited, next_row of ``docs`` (row, doc_id, text).

    ``edited``: the text's last floor(n_chars/2) code points replaced by the
    first as many of the next document (all, if it has fewer). Documents stand
    by doc_id, equal ones by a hash of their texts, then their texts; rows
    without doc_id come last; after the last comes the first.

    Each document goes to its bucket, and the first one of a bucket to the
    bucket before, too; so the text is shuffled once.
    """
    placed, firsts = _places(docs.withColumn("text", F.coalesce("text", F.lit(""))), buckets)
    firsts = materialize(firsts, "bucket_firsts")  # a row a bucket at most
    around = W.orderBy("bucket")
    last = F.max("bucket").over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    before = firsts.select(
        F.col("bucket").alias("own"), F.col("lowest.doc_id").alias("first_id"), F.col("lowest.digest").alias("first_digest"),
        F.coalesce(F.lag("bucket").over(around), last).alias("previous"),
    )
    match = (F.col("bucket") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    sent = placed.join(F.broadcast(before), match, "left")  # bounded by ``buckets``
    homes = F.array(F.struct(F.col("bucket").alias("home"), F.lit(0).alias("guest")))
    guest = F.array(F.struct(F.col("previous").alias("home"), F.lit(1).alias("guest")))
    spread = sent.select("row", "doc_id", "digest", "text", F.inline(F.when(F.col("own").isNull(), homes).otherwise(F.concat(homes, guest))))
    order = W.partitionBy("home").orderBy("guest", F.col("doc_id").asc_nulls_last(), "digest", "text")
    led = spread.withColumn("next_text", F.lead("text").over(order)).withColumn("next_row", F.lead("row").over(order))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half))
    return (
        led.filter("guest = 0")
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .select("row", "doc_id", "text", "n_chars", edited.alias("edited"), "next_row")
    )


def compare_with_edits(docs: DataFrame, radius: int = 3, buckets: int = 4096) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_near of each row of ``docs`` (doc_id, text).

    Null texts are empty. Repeated rows are documents of their own. The next
    document of an only row is itself. ``n_near``: other rows whose
    fingerprint is within ``radius`` bits. An empty table gives an empty one.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    edits = edited_documents(rows, buckets)
    both = edits.select(
        "row", "doc_id", "n_chars", "next_row", F.sha2("edited", 256).alias("sha"),
        F.inline(F.array(F.struct(F.lit(0).alias("is_edit"), "text"), F.struct(F.lit(1).alias("is_edit"), F.col("edited").alias("text")))),
    )
    prints = materialize(fingerprints(both, ["row", "doc_id", "n_chars", "next_row", "sha", "is_edit"]), "edit_prints")
    own = prints.filter("is_edit = 0").drop("is_edit")
    edit = prints.filter("is_edit = 1").select("row", F.col("hi").alias("ehi"), F.col("lo").alias("elo"))
    after = prints.filter("is_edit = 0").select(F.col("row").alias("next_row"), F.col("hi").alias("nhi"), F.col("lo").alias("nlo"))

    distinct = materialize(own.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies")), "distinct_prints")
    pairs = near_fingerprints(distinct.select("hi", "lo"), radius).select("hi", "lo", "hi2", "lo2")
    both_ways = pairs.unionByName(pairs.select(F.col("hi2").alias("hi"), F.col("lo2").alias("lo"), F.col("hi").alias("hi2"), F.col("lo").alias("lo2")))
    others = distinct.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), "copies")
    near = both_ways.join(others, ["hi2", "lo2"]).groupBy("hi", "lo").agg(F.sum("copies").alias("around"))
    counted = distinct.join(near, ["hi", "lo"], "left").select(
        "hi", "lo", (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("n_near")
    )
    counted = materialize(counted, "near_counts")
    return (
        own.join(edit, "row")
        .join(after, "next_row")
        .join(counted, ["hi", "lo"])
        .select(
            "doc_id", "n_chars", F.col("sha").alias("edited_sha256"),
            shown("hi", "lo").alias("fingerprint"), shown("ehi", "elo").alias("edited_fingerprint"),
            likeness(bits_apart(("hi", "lo"), ("ehi", "elo"))).alias("near_edited"),
            likeness(bits_apart(("hi", "lo"), ("nhi", "nlo"))).alias("near_next"),
            "n_near",
        )
    )
