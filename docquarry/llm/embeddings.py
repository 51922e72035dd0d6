"""Near-duplicate vectors by an epsilon grid order join.

Two vectors link when their labels are equal and their cosine is at least `cosine`; for normalised vectors
that is a Euclidean distance of at most eps = sqrt(2 - 2 * cosine). Normalised vectors are rotated onto
principal axes (distances stay) and sorted by the eps-wide grid cells of the leading ones. The sorted
sequence is cut into blocks with a bounding box each; runs of FAN blocks are intervals, runs of FAN intervals
larger ones, up to one for each task's part of the sequence. Joining descends from pairs of the largest to
blocks, then to halves of blocks; whatever lies further apart than eps is skipped whole, and what is left is
compared by the exact cosine in double precision. An interval never mixes labels.

The axes are fitted to the second moments of all vectors (a matrix of dim * dim, summed in two steps).
Equal vectors form a class that is compared once and counts as often as it occurs. A pair of blocks returns
one row a linked vector (its number of links there, and the smallest id linked to it within the pair), so
output grows with the vectors, not with the pairs. A block with many partners is dealt over salted tasks.
The comparisons within a dense group are quadratic in its classes: n_links asks for each of them.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without
a label, link with nothing (n_links 0, their own component); vectors of different length don't link; labels of
any type are compared as they are; repeated rows of one id and vector are one vector; rows of one id with
different vectors are vectors of their own; null ids are compared with nothing; of several smallest rows the
smallest id names a component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import cut, only, passing, table
from docquarry.operators.graph import components

COSINE = 0.98
#: Vectors a block; log2 of the blocks an interval, and of the intervals a larger one; vectors below which halving stops.
BLOCK = 256
FAN = 5
LEAF = 64
#: Leading axes that the order and the bounding boxes use.
AXES = 8
SALTS = 16
_LO, _HI = [f"lo{i}" for i in range(AXES)], [f"hi{i}" for i in range(AXES)]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, int | None, str | None, np.ndarray | None]]:
    """(row, id, label, vector or None where it can't link)."""
    ids, labels, cells = (batch.column(i) for i in range(3))
    ids, labels = ids.to_pylist(), labels.to_pylist()
    for i, cell in enumerate(cells):
        v = None
        if cell.is_valid and ids[i] is not None and labels[i] is not None and len(cell.values) and not cell.values.null_count:
            v = cell.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(v).all() or not v.any():
                v = None
        yield i, ids[i], labels[i], v


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, key, vec): vec as bytes of doubles, null where it can't link; key is its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, lab, None, None, None) if v is None else (i, lab, len(v), hashlib.blake2b(v.tobytes(), digest_size=16, key=hashlib.blake2b(lab.encode()).digest()).digest(), (v + 0.0).tobytes()) for _, i, lab, v in _vectors(batch)]
            ids, labels, dims, keys, vecs = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "label", "dim", "key", "vec"])

    label = F.col("label") + 0 if vectors.schema["label"].dataType.typeName() in ("float", "double") else F.col("label")
    read = only(vectors, "vec_id", "label", "embedding").select("vec_id", label.cast("string"), F.col("embedding").cast("array<double>"))
    return read.mapInArrow(run, "vec_id long, label string, dim int, key binary, vec binary")


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Axes by vector length, in the order of falling variance. Sums are combined twice before the driver
    gets at most 16 matrices for each length."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for d in set(dims):
                x = _unit(np.frombuffer(b"".join(r for r, k in zip(rows, dims, strict=True) if k == d)).reshape(-1, d))
                x = np.hstack([x, np.ones((len(x), 1))])
                total[d] = total.get(d, 0) + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], ["dim", "m"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[d] = total.get(d, 0) + np.frombuffer(m)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], ["dim", "m"])

    shape = "dim int, m binary"
    parts = classes.select("dim", "vec").mapInArrow(moments, shape).repartition(16).mapInArrow(summed, shape).collect()
    axes = {}
    for d in {r["dim"] for r in parts}:
        m = np.sum([np.frombuffer(r["m"]) for r in parts if r["dim"] == d], axis=0).reshape(d + 1, d + 1)
        mean = m[d, :d] / m[d, d]
        axes[d] = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))[1][:, ::-1][:, :AXES]
    return axes


def _lead(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), AXES))
    out[:, : axes.shape[1]] = x @ axes
    return out


def blocks(classes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """The sorted sequence, cut: (block, part, place, label, dim, lo*, hi*, ids, counts, vecs); part and place tell
    where in the sequence a block stands."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            cell = [np.floor(_lead(_unit(np.frombuffer(v)[None]), axes[d])[0] / eps).astype(np.int32).tolist() for d, v in zip(dims, vecs, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(cell, pa.list_(pa.int32()))], ["id", "label", "dim", "count", "vec", "cell"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part, place = TaskContext.get().partitionId(), itertools.count()

        def block() -> pa.RecordBatch:
            ids, labels, dims, counts, vecs = zip(*held, strict=True)
            lead = _lead(_unit(np.frombuffer(b"".join(vecs)).reshape(len(vecs), -1)), axes[dims[0]])
            box = [pa.array([float(x)]) for x in (*lead.min(0), *lead.max(0))]
            raw = [pa.array([np.array(x, np.int64).tobytes()], pa.binary()) for x in (ids, counts)]
            where = [pa.array([ids[0]], pa.int64()), pa.array([part], pa.int32()), pa.array([next(place)], pa.int64())]
            return pa.RecordBatch.from_arrays(
                [*where, pa.array([labels[0]], pa.string()), pa.array([dims[0]], pa.int32()), *box, *raw, pa.array([b"".join(vecs)], pa.binary())],
                ["block", "part", "place", "label", "dim", *_LO, *_HI, "ids", "counts", "vecs"],
            )

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if held and (len(held) == BLOCK or held[0][1:3] != row[1:3]):
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()

    shape = "id long, label string, dim int, count long, vec binary"
    order = ("label", "dim", "cell", "id")
    rows = classes.select("id", "label", "dim", "count", "vec").mapInArrow(placed, f"{shape}, cell array<int>")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("cell")
    boxes = ", ".join(f"{c} double" for c in (*_LO, *_HI))
    return dealt.mapInArrow(packed, f"block long, part int, place long, label string, dim int, {boxes}, ids binary, counts binary, vecs binary")


def _near(a: str, b: str, eps: float):
    """Whether two boxes lie within eps."""
    gap = lambda i: F.greatest(F.lit(0.0), F.col(f"{a}.lo{i}") - F.col(f"{b}.hi{i}"), F.col(f"{b}.lo{i}") - F.col(f"{a}.hi{i}"))
    return sum((gap(i) * gap(i) for i in range(AXES)), F.lit(0.0)) <= eps * eps + 1e-9


def block_pairs(sequence: DataFrame, eps: float) -> DataFrame:
    """(a, b) of blocks that may hold a link: pairs of the largest intervals, then of their parts, and so on."""
    same = ("label", "dim")
    box = cut(sequence.select("block", "part", "place", *same, *_LO, *_HI))
    depth = -(-int(box.agg(F.max("place")).first()[0]).bit_length() // FAN)

    def level(n: int) -> DataFrame:
        keys = (*same, "part", F.shiftright("place", FAN * n).alias("node"))
        return box.groupBy(*keys).agg(*(F.min(c).alias(c) for c in _LO), *(F.max(c).alias(c) for c in _HI), F.min("block").alias("block"))

    equal = lambda a, b, *names: reduce(and_, (F.col(f"{a}.{n}") == F.col(f"{b}.{n}") for n in names))
    ordered = F.struct("x.part", "x.node") <= F.struct("y.part", "y.node")
    columns = ("x.label", "x.dim", F.col("x.part").alias("xp"), F.col("x.node").alias("xn"), F.col("y.part").alias("yp"), F.col("y.node").alias("yn"))
    top = level(depth)
    near = top.alias("x").join(top.alias("y"), equal("x", "y", *same) & ordered & _near("x", "y", eps))
    for n in range(depth - 1, -1, -1):
        pairs, child = cut(near.select(*columns)), level(n)
        up = lambda side: F.shiftright(f"{side}.node", FAN)
        left = pairs.alias("p").join(child.alias("x"), equal("p", "x", *same) & (F.col("p.xp") == F.col("x.part")) & (F.col("p.xn") == up("x")))
        near = left.join(child.alias("y"), equal("p", "y", *same) & (F.col("p.yp") == F.col("y.part")) & (F.col("p.yn") == up("y")) & ordered & _near("x", "y", eps))
    return near.select(F.col("x.block").alias("a"), F.col("y.block").alias("b"))


def _links(p: np.ndarray, q: np.ndarray, pl: np.ndarray, ql: np.ndarray, cosine: float) -> np.ndarray:
    """Matrix of links between two runs of unit vectors, found by halving both; pl, ql: leading coordinates."""
    eps2, found = 2 - 2 * cosine + 1e-9, np.zeros((len(p), len(q)), bool)
    todo = [(0, len(p), 0, len(q))]
    while todo:
        i, j, k, m = todo.pop()
        gap = np.maximum(0, np.maximum(pl[i:j].min(0) - ql[k:m].max(0), ql[k:m].min(0) - pl[i:j].max(0)))
        if (gap * gap).sum() > eps2:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            found[i:j, k:m] = p[i:j] @ q[k:m].T >= cosine
        elif j - i >= m - k:
            todo += [(i, (i + j) // 2, k, m), ((i + j) // 2, j, k, m)]
        else:
            todo += [(i, j, k, (k + m) // 2), (i, j, (k + m) // 2, m)]
    return found


def linked(pairs: DataFrame, sequence: DataFrame, axes: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """(id, links, low): for each class in a pair of blocks, the vectors linked to it there, and the smallest
    id that it reaches within the pair."""
    payload = sequence.select("block", "dim", "ids", "counts", "vecs")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    columns = ("a", "salt", "kind", "block", "dim", "ids", "counts", "vecs")
    right = salted.join(payload, F.col("b") == F.col("block")).withColumn("kind", F.lit(1)).select(*columns)
    left = salted.select("a", "salt").distinct().join(payload, F.col("a") == F.col("block")).withColumn("kind", F.lit(0)).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for r in range(batch.num_rows):
                _, _, kind, block, dim, ids, counts, vecs = (batch.column(i)[r].as_py() for i in range(8))
                x = _unit(np.frombuffer(vecs).reshape(-1, dim))
                now = (block, np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64), x, _lead(x, axes[dim]))
                if kind == 0:
                    held = now
                    continue
                own = held[0] == block
                link = _links(held[3], now[3], held[4], now[4], cosine)
                if own:
                    np.fill_diagonal(link, False)
                if not link.any():
                    continue
                degree, low = [link @ now[2]], [held[1].copy()]
                degree.append(link.T @ held[2])
                low.append(now[1].copy())
                top = np.iinfo(np.int64).max
                while True:
                    back = np.minimum(low[1], np.where(link, low[0][:, None], top).min(0))
                    forth = np.minimum(low[0], np.where(link, back[None], top).min(1))
                    if (back == low[1]).all() and (forth == low[0]).all():
                        break
                    low = [forth, back]
                out_ids, out_degree, out_low = [held[1], now[1]], degree, low
                if own:
                    out_ids, out_degree, out_low = [held[1]], [degree[0]], [np.minimum(*low)]
                ids_, degree_, low_ = (np.concatenate(c) for c in (out_ids, out_degree, out_low))
                some = degree_ > 0
                yield pa.RecordBatch.from_arrays([pa.array(c[some], pa.int64()) for c in (ids_, degree_, low_)], ["id", "links", "low"])

    dealt = right.unionByName(left).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return dealt.mapInArrow(run, "id long, links long, low long")


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors."""
    eps = float(np.sqrt(2 - 2 * cosine))
    with passing(vectors.sparkSession) as keep:
        rows = cut(prepared(vectors))
        known = rows.where("key is not null").select("vec_id", "label", "dim", "key", "vec").distinct()
        of_key = known.groupBy("key").agg(F.min("vec_id").alias("low_id"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.count(F.lit(1)).alias("count"), F.first("vec").alias("vec"))
        classes = cut(of_key.withColumn("id", F.monotonically_increasing_id()))
        told = rows.select("vec_id", "key")
        if classes.isEmpty():
            return keep(told.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
        axes = principal_axes(classes)
        sequence = cut(blocks(classes, axes, eps))
        found = cut(linked(cut(block_pairs(sequence, eps)), sequence, axes, cosine))
        degree = found.groupBy("id").agg(F.sum("links").alias("links"))
        joined = components(found, "id", "low").withColumnRenamed("component_id", "c")
        of_class = classes.select("key", "id", "low_id", "count").join(degree, "id", "left").join(joined, "id", "left").withColumn("c", F.coalesce("c", "id"))
        smallest = of_class.groupBy("c").agg(F.min("low_id").alias("component_id"))
        of_class = of_class.join(smallest, "c").select("key", (F.col("count") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
        out = told.join(of_class, "key", "left")
        component = F.coalesce("component_id", "vec_id")
        return keep(out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where list_cosine_similarity(x.e, y.e) >= 0.98),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id, vec_id <= coalesce(low, vec_id) as kept
from embeddings left join (select a as vec_id, count(distinct b) as n from links group by a) using (vec_id)
left join (select a as vec_id, min(b) as low from reach group by a) using (vec_id)
"""
