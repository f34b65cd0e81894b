"""Embedding whitening with MLlib's BlockMatrix.

Every entry c of a usable vector becomes the integer x = floor(64 c) + 1000000. With n vectors and the exact
sums S of each dimension, the rows x - S/n are indexed into the row blocks of a distributed ``BlockMatrix``
A; A'A / n is the covariance V, whose eigenvectors are found locally (V is as large as the dimensions are
many, never as the rows); A times the whitening matrix W, whose columns are eigenvectors over the roots of
their eigenvalues, projects the rows.

Blocks. A task packs its own rows, in the order it reads them, into blocks of ``block_rows`` rows; the
packed rows are written to the shared folder with the task's number of each block, so that block numbers are
fixed from then on, and numbered without gaps over all tasks. The last block of a task is filled up with
zero rows, which add nothing to A'A. No row is shuffled to form a block. The transposed product is split
along its middle dimension, ``MID_BLOCKS`` blocks a split: without that, all blocks would meet in the one
task that owns the one result block.

Exactness. x, S, n and the deviation are integers. ``identity_error`` is measured on the projected rows, by
sums over blocks.

Rows. A vector that is null or holds a null or non-finite entry is dropped; the dimension is the greatest
length, and a shorter vector lacks entries, which count as null. Fewer than two distinct vectors, or more
components than the data's rank, have no whitened values: only components with an eigenvalue over
``RANK_FLOOR`` of the greatest are returned, at most ``COMPONENTS``. Equal eigenvalues are numbered as the
solver gives them. Repeated rows and null ids come back as often as they come. Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
RANK_FLOOR = 1e-12
BLOCK_ROWS = 1024
#: Blocks of the middle dimension that one task multiplies and adds up.
MID_BLOCKS = 16


@dataclass(frozen=True)
class Whitening:
    """Fitted statistics: ``whiten(x) = (x - sums / n) @ matrix``."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    matrix: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance) if len(self.values) else self.values


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the usable vectors."""
    rows = clash_free(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("c"))
    whole = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = rows.where(F.col("c").isNotNull() & whole)
    most = rows.agg(F.max(F.size("c"))).first()[0] or 0
    return usable.where((F.size("c") == most) & (F.size("c") > 0)).select(
        "vec_id", F.transform("c", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def packed(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """Stored blocks ``block, vec_ids, x`` (x row by row, no fill), and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def block(table: pa.Table) -> pa.RecordBatch:
            ids = table.column(0).combine_chunks().cast(pa.int64())
            flat = table.column(1).combine_chunks().flatten()
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)], ["vec_ids", "x"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= block_rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, block_rows))
                held = table.slice(block_rows).to_batches()
                size -= block_rows
        if size:
            yield block(pa.Table.from_batches(held))

    # The engine's row numbers (task, place in the task) are written with the blocks and do not change again.
    made = stored(rows.mapInArrow(run, "vec_ids array<long>, x array<long>").select(
        F.monotonically_increasing_id().alias("made"), "vec_ids", "x"), "whiten-blocks")
    task = F.shiftright("made", 33)
    per_task = made.groupBy(task.alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()  # a row for each task
    before = np.concatenate(([0], np.cumsum([r.n for r in per_task]))).tolist()
    starts = made.sparkSession.createDataFrame(
        [(r.task, b) for r, b in zip(per_task, before)] or [(0, 0)], "task long, before long")
    place = F.col("made").bitwiseAND(F.lit((1 << 33) - 1))
    return made.withColumn("task", task).join(F.broadcast(starts), "task").select(
        (F.col("before") + place).cast("int").alias("block"), "vec_ids", "x"), int(before[-1])


def _sums(blocks: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """n and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, np.int64)
        for batch in batches:
            for x in batch.column(0):
                rows = x.values.to_numpy().reshape(-1, width)
                n += len(rows)
                sums += rows.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), pa.array(np.append(sums, n))], ["cell", "part"])

    got = blocks.select("x").mapInArrow(run, "cell long, part long").groupBy("cell").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).orderBy("cell").collect()  # a row for each dimension
    parts = [int(r.part) for r in got]
    return (parts[-1], np.array(parts[:-1], object)) if parts else (0, np.zeros(width, object))


def _centred(x: np.ndarray, n: int, sums: np.ndarray, width: int) -> np.ndarray:
    """x - S/n, rounded once: S is split into a whole part and a rest below n."""
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n / n for s in sums])
    return (x.reshape(-1, width) - whole).astype(float) - rest


def _matrix(blocks: DataFrame, n_blocks: int, block_rows: int, n: int, sums: np.ndarray) -> BlockMatrix:
    width = len(sums)

    def block(row) -> tuple[tuple[int, int], DenseMatrix]:
        rows = _centred(np.array(row.x, np.int64), n, sums, width)
        full = np.zeros((block_rows, width))
        full[:len(rows)] = rows
        return (row.block, 0), DenseMatrix(block_rows, width, full.ravel(order="F"))

    return BlockMatrix(blocks.select("block", "x").rdd.map(block), block_rows, width, n_blocks * block_rows, width)


def _transposed_product(a: BlockMatrix, n_blocks: int) -> np.ndarray:
    """A'A, its middle dimension in splits of ``MID_BLOCKS`` blocks (the engine has this argument; the Python
    class does not pass it on)."""
    splits = max(1, -(-n_blocks // MID_BLOCKS))
    turned = a.transpose()
    product = turned._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def fit_blocks(blocks: DataFrame, n_blocks: int, block_rows: int, components: int = COMPONENTS
               ) -> tuple[Whitening, BlockMatrix | None]:
    """The whitening of stored blocks, and their centred matrix."""
    first = blocks.select((F.size("x") / F.size("vec_ids")).cast("int").alias("width")).first()
    if first is None:
        return Whitening(0, np.zeros(0, object), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0))), None
    n, sums = _sums(blocks, first.width)
    a = _matrix(blocks, n_blocks, block_rows, n, sums)
    v = _transposed_product(a, n_blocks) / n
    v = (v + v.T) / 2
    values, vectors = np.linalg.eigh(v)
    falling = np.argsort(-values, kind="stable")[:components]
    falling = falling[values[falling] > max(values.max() * RANK_FLOOR, 0)]
    return Whitening(n, sums, v, values[falling], vectors[:, falling] / np.sqrt(values[falling])), a


def _projected(blocks: DataFrame, a: BlockMatrix, model: Whitening) -> DataFrame:
    """Stored ``vec_ids, deviation, w`` of each block; w row by row, without the fill."""
    width, k = model.matrix.shape
    spark = blocks.sparkSession
    w = BlockMatrix(spark.sparkContext.parallelize(
        [((0, 0), DenseMatrix(width, k, model.matrix.ravel(order="F")))], 1), width, k, width, k)

    def pack(entry) -> tuple[int, bytearray]:
        (block, _), m = entry
        return int(block), bytearray(np.ascontiguousarray(m.toArray()).tobytes())

    product = a.multiply(w).blocks.map(pack).toDF("at int, w binary")
    n, sums = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(2):
                rows = x.values.to_numpy().reshape(-1, width)
                out.append(_deviation(rows, n, sums))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["block", "vec_ids", "deviation"])

    known = blocks.select("block", "vec_ids", "x").mapInArrow(run, "block int, vec_ids array<long>, deviation array<long>")
    return stored(known.join(product, known.block == product.at).select("vec_ids", "deviation", "w"), "whiten-projected")


def _deviation(rows: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum of (n x - S)^2 of each row, exactly: in 64 bits where they hold it, else in Python's integers."""
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n for s in sums], np.int64)
    off = rows - whole  # n x - S = n off - rest
    most = (int(np.abs(off).max(initial=0)) + 1) * n
    if most * most * rows.shape[1] < 1 << 63:
        return ((n * off - rest) ** 2).sum(1).tolist()
    return [sum((n * int(o) - int(r)) ** 2 for o, r in zip(row, rest)) for row in off]


def _identity_error(projected: DataFrame, n: int, k: int) -> float:
    """Largest entry of the whitened rows' covariance less the identity, from sums over the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for raw in batch.column(0):
                w = np.frombuffer(raw.as_py()).reshape(-1, k)
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "part"])

    cells = projected.select("w").mapInArrow(run, "cell long, part double").groupBy("cell").agg(
        F.sum("part").alias("part")).orderBy("cell").collect()  # one row for each pair of components
    total = np.array([r.part for r in cells]).reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    shape = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    blocks, n_blocks = packed(integers(vectors), block_rows)
    model, a = fit_blocks(blocks, n_blocks, block_rows, components)
    k = len(model.values)
    if a is None or not k:
        return vectors.sparkSession.createDataFrame([], shape)
    projected = _projected(blocks, a, model)
    error, n, explained = _identity_error(projected, model.n, k), model.n, model.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviation, raw in zip(*[batch.column(i) for i in range(3)]):
                rows = len(ids)
                w = np.frombuffer(raw.as_py(), count=rows * k)
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)), deviation.values.take(each), pa.array(w),
                    pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return projected.mapInArrow(run, shape.replace(f"vec_id {kind}", "vec_id long")).withColumn("vec_id", F.col("vec_id").cast(kind))
