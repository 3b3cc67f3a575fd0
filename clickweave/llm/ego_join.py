"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors have cosine >= t exactly if their distance is at most
eps = sqrt(2 - 2t). Vectors are projected on their leading principal
dimensions, where distances only shrink, and sorted by the cells of a grid of
side eps, lexicographically, within each label. The sorted sequence is cut
into blocks, and intervals of blocks are joined recursively: two intervals
whose bounding boxes are over eps apart are skipped with all below them.
Tasks receive the pairs of blocks that remain, go on in the same way with
parts of blocks, and verify by cosine in double precision.

Equal vectors are joined once, as a class with a count. A task returns, for
each vector of its two blocks, how many it is linked with and one neighbour in
its linked group, so dense groups cost time but not rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.components import connected_components
from clickweave.session import materialize

GRID_DIMS, BOX_DIMS, FAN_BITS = 4, 12, 8
#: Children of a node in the tree that says which vectors of two blocks are in one group.
TREE = 16
BLOCK_SCHEMA = "label string, dim int, part int, run int, n int, lo array<double>, hi array<double>, cids binary, counts binary, vectors binary"


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets, offsets[1:])]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_dimensions(classes: DataFrame) -> dict[int, np.ndarray]:
    """The leading principal dimensions (rows) of the unit vectors of each length."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            by_dim: dict[int, list[np.ndarray]] = {}
            for v in _lists(batch.column(0)):
                by_dim.setdefault(len(v), []).append(v)
            for dim, rows in by_dim.items():
                x = np.hstack([_unit(np.stack(rows)), np.ones((len(rows), 1))])
                sums[dim] = sums.get(dim, 0) + x.T @ x
        yield from rows_of(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, m in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[dim] = sums.get(dim, 0) + np.frombuffer(m.as_py()).reshape(dim + 1, dim + 1)
        yield from rows_of(sums)

    def rows_of(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([np.ascontiguousarray(m).tobytes() for m in sums.values()], pa.binary())], names=["dim", "m"]
        )

    schema = "dim int, m binary"
    parts = classes.select("vector").mapInArrow(moments, schema).repartition(16).mapInArrow(add, schema).collect()
    out: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in parts}:
        total = sum(np.frombuffer(r["m"]).reshape(dim + 1, dim + 1) for r in parts if r["dim"] == dim)
        mean = total[:dim, dim] / total[dim, dim]
        _, axes = np.linalg.eigh(total[:dim, :dim] / total[dim, dim] - np.outer(mean, mean))
        out[dim] = np.ascontiguousarray(axes[:, ::-1][:, :BOX_DIMS].T)
    return out


def _shadow(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Projections on ``axes``, and the length of what they leave. Distances
    between shadows are never above those between the vectors."""
    p = x @ axes.T
    return np.hstack([p, np.sqrt(np.maximum(0, (x * x).sum(1) - (p * p).sum(1)))[:, None]])


def _block_rows(classes: DataFrame, axes: dict[int, np.ndarray], eps: float, block_rows: int) -> DataFrame:
    sent = classes.sparkSession.sparkContext.broadcast(axes)  # BOX_DIMS vectors for each length

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = [
                np.floor(_shadow(_unit(v[None, :]), sent.value[len(v)])[0, :GRID_DIMS] / eps).astype(int).tolist()
                for v in _lists(batch.column(4))
            ]
            grid = [g + [0] * (GRID_DIMS - len(g)) for g in grid]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(grid, pa.list_(pa.int64()))], names=[*batch.schema.names, "cell"])

    keep = "label string, dim int, cid long, n long, vector array<double>, cell array<long>"
    placed = classes.select("label", "dim", "cid", "n", "vector").mapInArrow(cells, keep)
    order = ["label", "dim", *(F.col("cell")[i] for i in range(GRID_DIMS)), "cid"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.spark_partition_id())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, made = None, 0

        def block() -> pa.RecordBatch:
            label, dim, at = key
            x = np.stack([h[2] for h in held])
            s = _shadow(_unit(x), sent.value[dim])
            row = (
                label, dim, at, made, len(held), s.min(0).tolist(), s.max(0).tolist(),
                np.array([h[0] for h in held], np.int64).tobytes(), np.array([h[1] for h in held], np.int64).tobytes(), x.tobytes(),
            )
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), *[pa.binary()] * 3)
            names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            label, dim, cid, n = (batch.column(i).to_pylist() for i in range(4))
            at = batch.column(6).to_pylist()
            for i, v in enumerate(_lists(batch.column(4))):
                if held and (len(held) == block_rows or key != (label[i], dim[i], at[i])):
                    yield block()
                    held, made = [], made + 1
                key = (label[i], dim[i], at[i])
                held.append((cid[i], n[i], v))
        if held:
            yield block()

    return ordered.mapInArrow(cut, BLOCK_SCHEMA)


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """``blocks`` with their number in the sorted sequence, and its bits."""
    top = blocks.agg(F.max("part").alias("part"), F.max("run").alias("run")).collect()[0]
    low = int(top["run"]).bit_length()
    return blocks.withColumn("block", F.shiftleft(F.col("part").cast("long"), low) + F.col("run")), int(top["part"]).bit_length() + low


def _near_blocks(blocks: DataFrame, bits: int, eps: float) -> DataFrame:
    """Pairs ``a`` <= ``b`` of blocks of one label whose boxes are within eps,
    found from the whole sequence downward: a level cuts each interval by the
    next FAN_BITS bits of the block number and keeps the pairs of intervals
    whose boxes are near enough. A level's pairs are a written table."""
    slim = materialize(blocks.select("label", "dim", "block", "lo", "hi"), "boxes")
    size = slim.select(F.max(F.size("lo"))).collect()[0][0]

    def level(shift: int) -> DataFrame:
        box = [f(F.get(F.col(c), F.lit(i))).alias(f"{c}{i}") for i in range(size) for f, c in ((F.min, "lo"), (F.max, "hi"))]
        grouped = slim.groupBy("label", "dim", F.shiftright("block", shift).alias("node")).agg(*box)
        return grouped.select(
            "label", "dim", "node",
            F.array(*(f"lo{i}" for i in range(size))).alias("lo"), F.array(*(f"hi{i}" for i in range(size))).alias("hi"),
        )

    gap = F.aggregate(
        F.zip_with(
            F.zip_with("alo", "bhi", lambda x, y: x - y), F.zip_with("blo", "ahi", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ),
        F.lit(0.0), lambda s, g: s + F.coalesce(g * g, F.lit(0.0)),
    )
    depth = max(1, -(-bits // FAN_BITS))
    pairs = slim.select("label", "dim", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).distinct()
    for d in range(depth - 1, -1, -1):
        nodes = slim.withColumnRenamed("block", "node") if d == 0 else materialize(level(d * FAN_BITS), "intervals")
        nodes = nodes.withColumn("up", F.shiftright("node", FAN_BITS))
        a = nodes.select("label", "dim", F.col("up").alias("a"), F.col("node").alias("na"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
        b = nodes.select("label", "dim", F.col("up").alias("b"), F.col("node").alias("nb"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
        near = (
            pairs.join(a, ["label", "dim", "a"])
            .join(b, ["label", "dim", "b"])
            .filter((F.col("na") <= F.col("nb")) & (gap <= (eps + 1e-6) ** 2))
            .select("label", "dim", F.col("na").alias("a"), F.col("nb").alias("b"))
        )
        pairs = materialize(near, "interval_pairs")
    return pairs


def join_parts(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, eps: float, threshold: float, same: bool, part: int):
    """Masks ``(first row, first column, linked)`` of the parts of two blocks
    that are near enough, halving the longer interval as long as it is over ``part``."""
    out = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and d <= a:  # below the diagonal: the mirror of a part above
            continue
        gap = np.maximum(0, np.maximum(sx[a:b].min(0) - sy[c:d].max(0), sy[c:d].min(0) - sx[a:b].max(0)))
        if (gap * gap).sum() > (eps + 1e-6) ** 2:
            continue
        if max(b - a, d - c) > part:
            if b - a >= d - c:
                m = (a + b) // 2
                todo += [(a, m, c, d), (m, b, c, d)]
            else:
                m = (c + d) // 2
                todo += [(a, b, c, m), (a, b, m, d)]
            continue
        linked = x[a:b] @ y[c:d].T >= threshold
        if same:  # each pair once
            linked &= np.arange(c, d)[None, :] > np.arange(a, b)[:, None]
        if linked.any():
            out.append((a, c, linked))
    return out


def _groups(n: int, parts: list[tuple[int, int, np.ndarray]], shift: int) -> np.ndarray:
    """Smallest node reachable, of the nodes 0 to n - 1; columns count from ``shift`` on."""
    label = np.arange(n)
    while True:
        before = label.copy()
        for a, c, linked in parts:
            rows, cols = slice(a, a + linked.shape[0]), slice(c + shift, c + shift + linked.shape[1])
            down = np.where(linked, label[cols][None, :], n).min(1)
            label[rows] = np.minimum(label[rows], down)
            down = np.where(linked, label[rows][:, None], n).min(0)
            label[cols] = np.minimum(label[cols], down)
        label = label[label]
        if (label == before).all():
            return label


def _join_blocks(a: dict, b: dict, same: bool, axes: np.ndarray, eps: float, threshold: float, part: int = 256):
    """cid, links, neighbour (or None) of the vectors of two blocks that are linked."""
    cids, counts = (np.concatenate([np.frombuffer(s[c], np.int64) for s in ((a,) if same else (a, b))]) for c in ("cids", "counts"))
    x, y = (_unit(np.frombuffer(s["vectors"]).reshape(s["n"], -1)) for s in (a, b))
    parts = join_parts(x, y, _shadow(x, axes), _shadow(y, axes), eps, threshold, same, part)
    shift = 0 if same else len(x)
    links = np.zeros(len(cids), np.int64)
    for i, j, linked in parts:
        rows, cols = slice(i, i + linked.shape[0]), slice(j + shift, j + shift + linked.shape[1])
        links[rows] += linked @ counts[cols]
        links[cols] += counts[rows] @ linked
    out = []
    if parts:
        label = _groups(len(cids), parts, shift)
        order = np.lexsort((np.arange(len(cids)), label))
        firsts = np.flatnonzero(np.r_[True, label[order][1:] != label[order][:-1]])
        first = np.repeat(firsts, np.diff(np.r_[firsts, len(order)]))
        for k, node in enumerate(order):
            if links[node]:  # a tree of few levels without hubs
                up = first[k] + (k - first[k] - 1) // TREE
                out.append((int(cids[node]), int(links[node]), int(cids[order[up]]) if k > first[k] else None))
    return out


def embedding_components(vectors: DataFrame, threshold: float = 0.93, block_rows: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of ``vectors``
    (``vec_id``, ``embedding``, ``label``).

    Rows of equal, non-null labels whose cosine is at least ``threshold``
    (above 0) are linked; component_id is the smallest vec_id that links
    reach. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, nor do vectors of different lengths: they
    have no links and are their own component. Rows without a vec_id take part
    but name no component and are not kept. Repeated rows are returned each,
    and link with each other. Other columns are not read.
    """
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    e = F.col("vector")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0.0)
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector")).withColumn(
        "joined", F.coalesce(fine & F.col("label").isNotNull(), F.lit(False))
    )
    keyed = rows.withColumn("h1", F.when(F.col("joined"), F.xxhash64("label", "vector"))).withColumn(
        "h2", F.when(F.col("joined"), F.xxhash64(F.lit(1), "vector", "label"))
    )
    classes = materialize(
        keyed.filter("joined").groupBy("label", "h1", "h2")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
        .withColumn("dim", F.size("vector")).withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    alone = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    if classes.isEmpty():
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")).select(
            "*", alone
        )
    axes = principal_dimensions(classes)
    blocks, bits = _numbered(materialize(_block_rows(classes, axes, eps, block_rows), "blocks"))
    pairs = _near_blocks(blocks, bits, eps)
    sent = vectors.sparkSession.sparkContext.broadcast(axes)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                a, b = ({c: r[s + c] for c in ("n", "cids", "counts", "vectors")} for s in "ab")
                found = _join_blocks(a, b, r["a"] == r["b"], sent.value[r["dim"]], eps, threshold)
                cid, links, near = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (cid, links, near)], names=["cid", "links", "near"])

    payload = ["n", "cids", "counts", "vectors"]
    left, right = (
        blocks.select("label", "dim", F.col("block").alias(s), *(F.col(c).alias(s + c) for c in payload)) for s in "ab"
    )
    tiles = pairs.join(left, ["label", "dim", "a"]).join(right, ["label", "dim", "b"])
    found = materialize(tiles.mapInArrow(join, "cid long, links long, near long"), "links")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("near is not null").select("cid", "near"))
    known = classes.select("label", "h1", "h2", "cid", "first_id", "n")
    named = materialize(
        known.join(links, "cid", "left")
        .join(groups.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("component", "cid")),
        "named",
    )
    first = materialize(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "first_ids")
    result = materialize(
        named.join(first, "root").select(
            "label", "h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
        ),
        "class_links",
    )
    slim = keyed.select("vec_id", "joined", "label", "h1", "h2")
    linked = slim.filter("joined").join(result, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    apart = slim.filter(~F.col("joined")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(apart).select("*", alone)
