"""Embedding near-duplicates by NN-descent.

A graph of ``k`` neighbours per vector is seeded from the leaves of random-hyperplane trees and refined by
joining neighbours of neighbours: around every vector its neighbours, and those it is a neighbour of, are
compared with each other, and pairs that improve a list enter it. Rounds go on until few lists change.
Vectors whose whole list lies above the threshold are *saturated*: their lists are doubled and refined
again. Recall is then audited against brute force on a bounded sample of vectors, averaged over each
component and then over the components, so that no large one hides what others lose; if it is short of
``RECALL``, more trees and rounds follow, and after ``MAX_AUDITS`` of them all components are compared
exactly. Links that only the audit shows are kept in any case. Edges of at least ``threshold`` are kept, checked in double
precision, and give the connected components.

Lists end at ``MAX_K``. Vectors whose lists are full at that size may link with others that no list shows,
so their components are compared exactly: cut into blocks with a centre and a radius, and every two blocks
of different components that can still hold a link by the angles are multiplied; components that link are
one (``_bridges``). Then links are counted exactly: every component is cut into blocks of
about ``BLOCK`` vectors, and each pair of its blocks is multiplied in a task of its own, which returns the
number of links of each vector and never the pairs. So a group of copies of any size costs tasks of
bounded memory, and ``n_links`` is exact within every component.

During the descent vectors travel as one byte per component (64 bytes instead of 512); that shifts a
cosine by some thousandths, so edges from ``threshold - SLACK`` on are checked again exactly. A vector that
many others have in their lists has its join split into blocks of ``JOIN`` members, others in every round;
so are large leaves, others in every tree.

Equal unit vectors are one from the start (an aggregate with map-side combine), known by their least id and
their number, which the link counts use; a group of exact copies of any size costs one vector.

Rows. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
vectors of different lengths with each other. Rows of one ``vec_id`` are one vector (the least of them); a
null id is kept, without links or component. Ties in a list go by a hash of the pair, so no vector becomes
everyone's neighbour. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.frames import clash_free, components, hashed_sample, stored

THRESHOLD = 0.9
SLACK = 0.02
K = 8
MAX_K = 32
TREES = 6
LEAF = 96
JOIN = 64
MAX_ROUNDS = 6
SETTLED = 0.003
AUDIT = 1024
RECALL = 0.97
MAX_AUDITS = 4
BLOCK = 256


def _unit(rows: list) -> list[bytes | None]:
    out = []
    for values in rows:
        v = np.array([np.nan if x is None else x for x in values or []], float)
        top = np.abs(v).max() if len(v) else 0.0
        if not np.isfinite(top) or top == 0 or not np.isfinite(v).all():
            out.append(None)
            continue
        v = v / top  # before squaring, so no component over- or underflows
        out.append((v / np.sqrt(v @ v) + 0.0).tobytes())  # no negative zeros: equal vectors have equal bytes
    return out


def prepared(vectors: DataFrame) -> DataFrame:
    """``vec_id, unit`` (doubles as bytes; null: links with nothing) and ``code`` (a byte per component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                unit = _unit(part.column(1).to_pylist())
                code = [None if u is None else
                        np.rint((v := np.frombuffer(u)) * (127 / np.abs(v).max())).astype(np.int8).tobytes() for u in unit]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(unit, pa.binary()), pa.array(code, pa.binary())],
                    ["vec_id", "unit", "code"])

    one = clash_free(vectors, "vec_id", "embedding").where("vec_id is not null").groupBy("vec_id").agg(
        F.min("embedding").alias("embedding"))
    return one.mapInArrow(run, "vec_id long, unit binary, code binary")


def _matrix(codes: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1).astype(np.float32)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (a ^ (b * np.int64(0x9E3779B97F4A7C15 - (1 << 64)))) * np.int64(0x94D049BB133111EB - (1 << 64))


def _best(ids: np.ndarray, codes: list[bytes], bar: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each member of a group its ``k`` best others above its own bar: ``(u, v, sim)``."""
    m = _matrix(codes)
    sim = m @ m.T
    sim[ids[:, None] == ids[None, :]] = -2
    order = np.lexsort((_pair_hash(ids[:, None], ids[None, :]), -sim), axis=1)[:, :k]
    top = np.take_along_axis(sim, order, 1)
    r, c = np.nonzero(top > bar[:, None])
    return ids[r], ids[order[r, c]], top[r, c]


def _joined(rows: DataFrame, group: list[str], k: int) -> DataFrame:
    """Compare the members of each group: input ``*group, id, bar, code``, output ``u, v, sim``."""
    width = len(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def done(parts):
            ids = np.concatenate([p[0] for p in parts])
            if len(ids) > 1:
                yield _best(ids, [c for p in parts for c in p[2]], np.concatenate([p[1] for p in parts]), k)

        def batch_of(found):
            if found:
                u, v, s = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s.astype(np.float32))], ["u", "v", "sim"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)
            ids = batch.column(width).to_numpy(zero_copy_only=False)
            bar = batch.column(width + 1).to_numpy(zero_copy_only=False)
            codes = batch.column(width + 2).to_pylist()
            edge = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))
            found = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if a == b:
                    continue
                key = keys[a].tobytes()
                if held and key != held_key:
                    found.extend(done(held))
                    held = []
                held_key = key
                held.append((ids[a:b], bar[a:b], codes[a:b]))
            yield from batch_of(found)
        yield from batch_of(list(done(held)) if held else [])

    return rows.repartition(*group).sortWithinPartitions(*group).select(*group, "id", "bar", "code").mapInArrow(
        run, "u long, v long, sim float")


def _leaves(vectors: DataFrame, n: int, first: int, trees: int) -> DataFrame:
    """The leaf of each vector in each tree, large leaves cut into blocks: ``leaf, part, id, bar, code``."""
    bits = max(0, math.ceil(math.log2(max(1, n / LEAF))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, codes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            size = np.array([len(c) for c in codes])
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                m = _matrix([codes[i] for i in at])
                if d not in planes:
                    planes[d] = np.random.default_rng([d, first]).normal(size=(d, trees * max(bits, 1)))
                side = (m @ planes[d] > 0).reshape(len(at), trees, -1)[:, :, :bits]
                code = (side * (1 << np.arange(bits))).sum(2) if bits else np.zeros((len(at), trees), np.int64)
                for t in range(trees):
                    leaf = ((d * 64 + first + t) << 40) + code[:, t].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf), pa.array(ids[at]), pa.array([codes[i] for i in at], pa.binary())], ["leaf", "id", "code"])

    rows = vectors.select("vec_id", "code").mapInArrow(run, "leaf long, id long, code binary")
    rows = stored(rows, "nnd-leaves")
    size = rows.groupBy("leaf").agg(F.count("*").alias("n"))
    large = stored(size.where(F.col("n") > 4 * LEAF), "nnd-large")
    parts = F.ceil(F.coalesce("n", F.lit(1)) / (2 * LEAF))
    return rows.join(large, "leaf", "left").select(
        "leaf", F.pmod(F.xxhash64("id", "leaf"), parts).cast("long").alias("part"), "id", F.lit(-2.0).cast("float").alias("bar"), "code")


def _merged(edges: DataFrame) -> DataFrame:
    """Lists of each vector's ``k`` best entries ``u, v, sim, k, fresh, place``, by one exchange."""
    best = edges.repartition("u").groupBy("u", "v").agg(
        F.max("sim").alias("sim"), F.max("k").alias("k"), F.min("fresh").alias("fresh"))
    own = Window.partitionBy("u")
    return stored(best.withColumn("k", F.max("k").over(own)).withColumn("place", F.row_number().over(
        own.orderBy(F.col("sim").desc(), F.xxhash64("u", "v"), "v"))).where("place <= k"), "nnd-graph")


def _refine(vectors: DataFrame, graph: DataFrame, n: int) -> DataFrame:
    """Rounds of neighbour-of-neighbour joins until few entries are new."""
    for turn in range(MAX_ROUNDS):
        # The bar of a vector: its last entry if the list is full.
        bars = graph.groupBy("u").agg(F.min("sim").alias("low"), F.count("*").alias("n"), F.max("k").alias("k")).select(
            F.col("u").alias("vec_id"), F.when(F.col("n") >= F.col("k"), F.col("low")).otherwise(F.lit(-2.0)).cast("float").alias("bar"))
        member = stored(vectors.select("vec_id", "code").join(bars, "vec_id").select(
            F.col("vec_id").alias("id"), "bar", "code"), "nnd-member")
        around = graph.select(F.col("u").alias("w"), F.col("v").alias("id"), "fresh").union(
            graph.select(F.col("v").alias("w"), F.col("u").alias("id"), "fresh"))
        # Only around vectors whose surroundings changed can a new pair appear.
        around = stored(around.groupBy("w", "id").agg(F.max("fresh").alias("fresh")), "nnd-around")
        size = around.groupBy("w").agg(F.count("*").alias("n"), F.max("fresh").alias("fresh")).where("fresh")
        groups = stored(size.select("w", F.ceil(F.col("n") / JOIN).alias("parts")), "nnd-groups")
        rows = around.join(groups, "w").select(
            "w", F.pmod(F.xxhash64("id", "w", F.lit(turn)), F.col("parts")).cast("long").alias("part"), "id").join(member, "id")
        found = _joined(rows, ["w", "part"], MAX_K)
        new = found.select("u", "v", "sim", F.lit(0).alias("k"), F.lit(True).alias("fresh"))
        graph = _merged(graph.select("u", "v", "sim", "k", F.lit(False).alias("fresh")).union(new))
        if graph.where("fresh").count() <= SETTLED * n * K:
            break
    return graph


def neighbour_graph(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links ``(a, b)`` of at least ``threshold`` found by the descent, checked exactly, with the pairs of
    components that full lists keep apart and the links of the audit; short of ``RECALL`` after the last audit
    with all pairs of components that link."""
    n = vectors.count()
    graph = None
    for audit in range(MAX_AUDITS):
        leaves = _joined(_leaves(vectors, n, audit * TREES, TREES), ["leaf", "part"], MAX_K if audit else K)
        seeds = leaves.select("u", "v", "sim", F.lit(K).alias("k"), F.lit(True).alias("fresh"))
        if graph is not None:
            seeds = seeds.union(graph.select("u", "v", "sim", "k", F.lit(False).alias("fresh")))
        graph = _merged(seeds)
        while True:
            graph = _refine(vectors, graph, n)
            full = graph.groupBy("u").agg(F.min("sim").alias("low"), F.count("*").alias("n"), F.max("k").alias("k")).where(
                (F.col("n") >= F.col("k")) & (F.col("low") >= threshold - SLACK) & (F.col("k") < MAX_K)).select("u")
            saturated = stored(full, "nnd-saturated")
            if saturated.isEmpty():
                break
            graph = stored(graph.join(saturated.withColumn("more", F.lit(True)), "u", "left").select(
                "u", "v", "sim", F.when(F.col("more"), F.least(F.col("k") * 4, F.lit(MAX_K))).otherwise(F.col("k")).alias("k"),
                F.coalesce("more", F.lit(False)).alias("fresh"), "place"), "nnd-graph")
        near = graph.where(F.col("sim") >= threshold - SLACK).select(
            F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        links = stored(_checked(near, vectors, threshold), "nnd-links")
        full = stored(graph.groupBy("u").agg(F.min("sim").alias("low"), F.count("*").alias("n"), F.max("k").alias("k")).where(
            (F.col("n") >= F.col("k")) & (F.col("low") >= threshold - SLACK)).select(F.col("u").alias("vec_id")), "nnd-full")
        if not full.isEmpty():
            links = links.union(_bridges(vectors.join(full, "vec_id"), links, threshold))
        recall, missed = _audit(vectors, links, threshold)
        links = links.union(missed)
        if recall >= RECALL:
            return links
    return links.union(_bridges(vectors, links, threshold))


def _bridges(vectors: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of components of ``links`` (a vector without links is its own) between which some of
    ``vectors`` link: exact, and enough of them to join all components that belong together.

    A component with at least ``MAX_K`` of the vectors has blocks of its own, the others share blocks. Two
    blocks are multiplied in a task of their own unless the angle of their centres less both radii is too
    large for any link; what comes back is one row for each component that is joined to another.
    """
    edge = math.acos(min(1.0, threshold)) + 1e-6
    near = components(links)
    of = near.select(F.col("node").alias("vec_id"), "component").union(near.select("component", "component")).distinct()
    of = vectors.select("vec_id", "unit").join(of, "vec_id", "left").select(
        F.coalesce("component", "vec_id").alias("component"), "vec_id", "unit")
    of = stored(of, "nnd-bridge-of")
    size = of.groupBy("component").agg(F.count("*").alias("n"))
    # ``region``: the component of a large one, else none; vectors of different lengths never share a block.
    placed = of.join(size, "component").select("component", "vec_id", "unit", F.length("unit").alias("d"), F.when(
        F.col("n") >= MAX_K, F.col("component")).alias("region"))
    parts = stored(placed.groupBy("d", "region").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "nnd-bridge-parts")
    placed = placed.alias("p").join(parts.alias("q"), F.col("p.d").eqNullSafe(F.col("q.d")) & F.col("p.region").eqNullSafe(
        F.col("q.region"))).select("component", "vec_id", "unit", "p.d", "p.region", F.pmod(
            F.xxhash64("vec_id"), "parts").alias("part"))

    def centre(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(rows.unit)).reshape(len(rows), -1)
        c = x.sum(0)
        if not (size := np.sqrt(c @ c)):
            c, size = x[0], 1.0
        c = c / size
        return pd.DataFrame({"block": [rows.vec_id.min()], "d": rows.d.iloc[:1].to_numpy(), "region": rows.region.iloc[:1].array,
                             "centre": [c.tobytes()], "radius": [float(np.arccos(np.clip((x @ c).min(), -1, 1)))],
                             "ids": [rows.vec_id.to_numpy()]})

    blocks = stored(placed.groupBy("d", "region", "part").applyInPandas(
        centre, "block long, d int, region long, centre binary, radius double, ids array<long>"), "nnd-bridge-blocks")
    member = stored(blocks.select("block", F.explode("ids").alias("vec_id")).join(of, "vec_id"), "nnd-bridge-member")
    # Blocks meet as vectors do in _link_counts: their centres are cut into blocks too, met in pairs.
    spans = F.lit(max(1, math.ceil(blocks.count() / BLOCK))).cast("long")
    met = blocks.drop("ids").withColumn("own", F.pmod(F.xxhash64("block"), spans)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), spans - 1))).select(
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "block", "d",
            F.coalesce("region", F.lit(0)).alias("region"), F.col("region").isNull().alias("mixed"), "centre", "radius")

    def can_link(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, same in rows.groupby("d"):
            a, b = same[same.own == key[0]], same[same.own == key[1]]
            if not len(a) or not len(b):
                continue
            x = np.frombuffer(b"".join(a.centre)).reshape(len(a), -1)
            y = np.frombuffer(b"".join(b.centre)).reshape(len(b), -1)
            angle = np.arccos(np.clip(x @ y.T, -1, 1)) - a.radius.to_numpy()[:, None] - b.radius.to_numpy()
            one = ((a.region.to_numpy()[:, None] == b.region.to_numpy())
                   & ~a.mixed.to_numpy()[:, None] & ~b.mixed.to_numpy())
            r, c = np.nonzero((angle <= edge) & ~one)
            u, v = a.block.to_numpy()[r], b.block.to_numpy()[c]
            good = u <= v if key[0] == key[1] else np.ones(len(u), bool)
            found.append(pd.DataFrame({"p": u[good], "q": v[good]}))
        return pd.concat(found) if found else pd.DataFrame({"p": [], "q": []}).astype("int64")

    pairs = stored(met.groupBy("i", "j").applyInPandas(can_link, "p long, q long"), "nnd-bridge-pairs")
    sides = pairs.select("p", "q", F.col("p").alias("block")).union(pairs.where("p <> q").select("p", "q", "q"))

    def joined(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows.block == key[0]], rows[rows.block == key[1]]
        x = np.frombuffer(b"".join(a.unit)).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b.unit)).reshape(len(b), -1)
        near = x @ y.T >= threshold
        own, at = np.unique(np.concatenate([a.component, b.component]), return_inverse=True)
        low, r, c = np.arange(len(own)), *np.nonzero(near)
        r, c = at[:len(a)][r], at[len(a):][c]
        while True:  # the least component reachable over the links of these two blocks
            new = low.copy()
            np.minimum.at(new, r, low[c])
            np.minimum.at(new, c, low[r])
            if (new == low).all():
                break
            low = new
        moved = low != np.arange(len(own))
        return pd.DataFrame({"a": own[low[moved]], "b": own[moved]})

    return stored(sides.join(member, "block").groupBy("p", "q").applyInPandas(joined, "a long, b long").distinct(), "nnd-bridges")


def _checked(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                cos = np.fromiter((np.frombuffer(x) @ np.frombuffer(y) for x, y in zip(
                    part.column(2).to_pylist(), part.column(3).to_pylist())), float, part.num_rows)
                keep = pa.array(cos >= threshold)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])

    left = vectors.select(F.col("vec_id").alias("a"), F.col("unit").alias("ua"))
    right = vectors.select(F.col("vec_id").alias("b"), F.col("unit").alias("ub"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ua", "ub").mapInArrow(run, "a long, b long")


def _audit(vectors: DataFrame, links: DataFrame, threshold: float) -> tuple[float, DataFrame]:
    """Recall, and the links found missing, of a bounded, hashed sample of vectors: the share of a vector's true
    links whose ends lie in one component, averaged over each component and then over the components.

    The sample (``AUDIT`` vectors) goes to every task; each task multiplies it with its own rows.
    """
    sample = hashed_sample(vectors.select("vec_id", "unit"), AUDIT, "vec_id").collect()
    if not sample:
        return 1.0, links.limit(0)
    ids = np.array([r.vec_id for r in sample])
    units = [bytes(r.unit) for r in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(u) for u in units])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own, codes = part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_pylist()
                own_size = np.array([len(c) for c in codes])
                for d in np.unique(own_size).tolist():
                    i, j = np.flatnonzero(own_size == d), np.flatnonzero(size == d)
                    if not len(j):
                        continue
                    x = np.frombuffer(b"".join(codes[k] for k in i)).reshape(len(i), -1)
                    y = np.frombuffer(b"".join(units[k] for k in j)).reshape(len(j), -1)
                    r, c = np.nonzero(x @ y.T >= threshold)
                    a, b = own[i[r]], ids[j[c]]
                    yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    true = stored(vectors.select("vec_id", "unit").mapInArrow(run, "a long, b long"), "nnd-audit")
    near = components(links)
    of = stored(near.select(F.col("node").alias("a"), F.col("component").alias("ca")).union(
        near.select("component", "component")).distinct(), "nnd-audit-components")
    met = stored(true.join(of, "a", "left").join(of.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left").select(
        "a", "b", F.coalesce("cb", "b").alias("component"),
        (F.coalesce("ca", "a") == F.coalesce("cb", "b")).alias("met")), "nnd-audit-met")
    share = met.groupBy("component", "b").agg(F.avg(F.col("met").cast("int")).alias("share"))
    recall = share.groupBy("component").agg(F.avg("share").alias("share")).agg(F.avg("share")).first()[0]
    return (1.0 if recall is None else recall), met.where(~F.col("met")).select("a", "b")


def _link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """Exact number of links of every member within its component to others: ``vec_id, n_links``. A member
    stands for ``n`` equal vectors.

    A component's blocks meet in pairs, each pair in a group of its own of some ``2 * BLOCK`` vectors.
    """
    size = stored(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "nnd-sizes")
    placed = members.join(size, "component").withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "vec_id", "unit", "n")

    def count(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        a = rows[rows.own == i]
        b = rows[rows.own == j]
        x = np.frombuffer(b"".join(a.unit)).reshape(len(a), -1) if len(a) else None
        y = np.frombuffer(b"".join(b.unit)).reshape(len(b), -1) if len(b) else None
        if x is None or y is None:
            return pd.DataFrame({"vec_id": [], "n": []}).astype("int64")
        near = x @ y.T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
            return pd.DataFrame({"vec_id": a.vec_id.to_numpy(), "n": near @ a.n.to_numpy()})
        return pd.DataFrame({"vec_id": np.concatenate([a.vec_id, b.vec_id]),
                             "n": np.concatenate([near @ b.n.to_numpy(), a.n.to_numpy() @ near])})

    return met.groupBy("component", "i", "j").applyInPandas(count, "vec_id long, n long").groupBy("vec_id").agg(
        F.sum("n").alias("n_links"))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector."""
    every = stored(prepared(embeddings), "nnd-vectors")
    classes = stored(every.where("unit is not null").groupBy("unit").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.min("code").alias("code")), "nnd-classes")
    vectors = classes.select("vec_id", "unit", "code")
    links = neighbour_graph(vectors, threshold)
    near = components(links)
    of = stored(near.select(F.col("node").alias("vec_id"), "component").union(
        near.select("component", "component")).distinct(), "nnd-of")
    members = classes.select("vec_id", "unit", "n").join(of, "vec_id")
    counts = stored(_link_counts(members, threshold), "nnd-counts")
    judged = stored(classes.select("vec_id", "unit", "n").join(of, "vec_id", "left").join(counts, "vec_id", "left").select(
        "unit", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component")), "nnd-judged")
    out = every.select("vec_id", "unit").join(judged, "unit", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"))
    lost = clash_free(embeddings, "vec_id").where("vec_id is null").select(
        F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return out.union(lost).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
