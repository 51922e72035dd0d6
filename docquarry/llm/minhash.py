"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Each document's set of hashed word shingles is sketched (see shingles.sketches), the sketch is cut into
bands, and documents that agree on a whole band become candidates; a candidate pair is linked only if its
full sets have 100 * |A & B| >= percent * |A | B|. With 64 bands of 8 coordinates a pair at similarity 0.8
is missed with a probability below 1e-5, at 0.85 below 2e-9, whatever the size of the sets.

Work that grows with the square of a group is avoided in steps. Equal sets form a class, and only its first
document goes on. In a band's bucket, members are first held against its smallest id only (a star), and links
are closed to components. Pairs within a component can't change it, so what is left is every bucket that
holds several components: its members outside the component with most of them (the strays) are assigned to
that component, and each component's strays are held against all its members and against each other. That
covers every pair of a bucket that is still apart, and takes a row for each stray and each member, not for
each pair: a task holds a block of strays and counts their common shingles with each row that streams by.

No bucket is gathered in one task: stars are dealt by (centre, salt), components by (block of strays, salt),
and a centre's or stray's set travels once for each of those. Sets are made for candidates only. What stays
quadratic is arithmetic inside tasks, between the strays and the members of one component.

Defined results: null, empty and blank texts have an empty set and link with nothing; rows of one id are one
document, which is linked by each of its texts (n_shingles is a row's own); a null id is its own component (null) and kept; ties go to the smallest id; texts are
processed whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import shingles
from docquarry.llm.common import cut, held, only, passing, table
from docquarry.operators.graph import components

BINS = 512
ROWS = 8
PERCENT = 80
#: Tasks over which the members of one star can be dealt.
SALTS = 64
#: Strays that a task holds, and rows of a component that stream past them in one task.
STRAYS, STREAMED = 1_000, 4_000
#: Ids of candidates that are broadcast to the texts, at most (16 MB); beyond, both shuffle.
HELD = 2_000_000


def sketched(docs: DataFrame, k: int, bins: int = BINS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n, set_key, bands): set size, a 128-bit digest of the set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, shingles.GROUP):
                part = batch.slice(lo, shingles.GROUP)
                sets = [shingles.shingle_set(t, k) for t in shingles.texts(part.column(1))]
                keys = shingles.band_keys(shingles.sketches(sets, bins), rows).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (bins // rows)), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        bands,
                    ],
                    ["doc_id", "n", "set_key", "bands"],
                )

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n long, set_key binary, bands array<long>")


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """(id, items): the sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, shingles.GROUP):
                part = batch.slice(lo, shingles.GROUP)
                items = [shingles.shingle_set(t, k).tobytes() for t in shingles.texts(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(items, pa.binary())], ["id", "items"])

    return only(docs, "doc_id", "text").mapInArrow(run, "id long, items binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    member = salted.join(sets.withColumnRenamed("id", "b"), "b").select("a", "salt", F.lit(1).alias("kind"), "b", "items")
    centre = salted.select("a", "salt").distinct().join(sets.withColumnRenamed("id", "a"), "a")
    centre = centre.select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("b"), "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, []
        for batch in batches:
            a, kind, b, items = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            links: tuple[list[int], list[int]] = ([], [])
            for i in range(len(a)):
                row = np.frombuffer(items[i], np.uint64)
                if kind[i] == 0:
                    own, held = (own if held == a[i] else []) + [row], a[i]
                    continue
                for centre_row in own:
                    # searchsorted walks the shorter set through the longer one
                    few, many = sorted((centre_row, row), key=len)
                    if not len(few) or 100 * len(few) < percent * len(many):
                        continue
                    common = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                    if 100 * common >= percent * (len(few) + len(many) - common):
                        links[0].append(a[i])
                        links[1].append(b[i])
                        break
            yield pa.RecordBatch.from_arrays([pa.array(links[0], pa.int64()), pa.array(links[1], pa.int64())], ["a", "b"])

    dealt = member.unionByName(centre).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return dealt.mapInArrow(run, "a long, b long")


def _apart(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between documents of a bucket that are in different components, a a stray. Of the links
    of a stray to one component a task returns the first."""
    here = members.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c"))
    counted = here.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size"))
    main = counted.groupBy("key").agg(F.max(F.struct("size", (-F.col("c")).alias("c"))).alias("main"), F.count(F.lit(1)).alias("n")).where("n > 1")
    main = main.select("key", (-F.col("main.c")).alias("main"))
    strays = cut(here.join(main, "key").where("c <> main").select("main", "id").distinct())
    component = members.select("id").distinct().join(labels, "id", "left").select("id", F.coalesce("component_id", "id").alias("main"))
    rows = component.join(strays.select("main").distinct(), "main", "left_semi").select("main", "id", F.lit(True).alias("inside"))
    rows = rows.unionByName(strays.withColumn("inside", F.lit(False)))
    dealt = rows.groupBy("main").agg(
        F.ceil(F.count_if(~F.col("inside")) / STRAYS).cast("int").alias("blocks"), F.ceil(F.count(F.lit(1)) / STREAMED).cast("int").alias("salts")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    held = strays.join(dealt, "main").select("main", own("blocks").alias("block"), every("salts").alias("salt"), F.lit(0).alias("kind"), "id", F.lit(False).alias("inside"))
    passing = rows.join(dealt, "main").select("main", every("blocks").alias("block"), own("salts").alias("salt"), F.lit(1).alias("kind"), "id", "inside")
    full = held.unionByName(passing).join(sets, "id").select("main", "block", "salt", "kind", "id", "inside", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, own_sets, index = None, [], [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            links: tuple[list[int], list[int]] = ([], [])
            for main, block, salt, kind, id_, inside, items in zip(*columns, strict=True):
                if (main, block, salt) != group:
                    group, ids, own_sets, index = (main, block, salt), [], [], None
                row = np.frombuffer(items, np.uint64)
                if kind == 0:
                    ids.append(id_)
                    own_sets.append(row)
                    continue
                if index is None:
                    flat = np.concatenate(own_sets)
                    order = np.argsort(flat, kind="stable")
                    sizes = np.array([len(s) for s in own_sets])
                    index = flat[order], np.repeat(np.arange(len(ids)), sizes)[order], sizes, np.array(ids), np.zeros(len(ids), bool)
                flat, owner, sizes, names, inside_linked = index
                first, last = np.searchsorted(flat, row, "left"), np.searchsorted(flat, row, "right")
                runs = last - first
                at = np.repeat(first - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
                common = np.bincount(owner[at], minlength=len(names))
                similar = (common > 0) & (100 * common >= percent * (sizes + len(row) - common)) & (names != id_)
                similar &= ~inside_linked if inside else names < id_
                if similar.any():
                    links[0].extend(names[similar].tolist())
                    links[1].extend([id_] * int(similar.sum()))
                    if inside:
                        inside_linked |= similar
            yield pa.RecordBatch.from_arrays([pa.array(links[0], pa.int64()), pa.array(links[1], pa.int64())], ["a", "b"])

    keys = ("main", "block", "salt")
    return full.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(run, "a long, b long")


def _renamed(made: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, y): components that rows of one id with different sets lie in."""
    several = made.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo <> hi").select("doc_id")
    rows = made.join(several, "doc_id").join(classes.select("set_key", "id"), "set_key").join(labels, "id", "left")
    rows = rows.select("doc_id", F.coalesce("component_id", "id").alias("y")).distinct()
    return rows.join(rows.groupBy("doc_id").agg(F.min("y").alias("x")), "doc_id").where("x <> y").select("x", "y")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = PERCENT, bins: int = BINS, rows: int = ROWS, most: int = HELD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    docs = only(docs, "doc_id", "text")
    with passing(docs.sparkSession) as keep:
        with passing(docs.sparkSession) as pass_on:
            made = cut(sketched(docs, k, bins, rows))
            sizes = pass_on(made.select("doc_id", "n", "set_key"))
            known = made.where("n > 0 and doc_id is not null")
            banded = cut(known.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")))
            classes = pass_on(banded.select("set_key", "id"))
            spread = banded.select("id", F.explode("bands").alias("key"))
            shared = spread.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("tail")).where("head <> tail")
            members = pass_on(spread.join(shared.select("key", "head"), "key"))
        wanted = cut(members.select(F.col("id").alias("doc_id")).distinct())
        sets = cut(sets_of(docs.join(held(wanted, most), "doc_id", "left_semi"), k).distinct())

        stars = members.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
        labels = components(verified(cut(stars), sets, percent))
        late = _apart(members, labels, sets, percent)
        component = labels.select("id", F.col("component_id").alias("c"))
        ends = late.join(component.withColumnRenamed("id", "a"), "a", "left").withColumn("x", F.coalesce("c", "a")).drop("c")
        ends = ends.join(component.withColumnRenamed("id", "b"), "b", "left").select("x", F.coalesce("c", "b").alias("y"))
        ends = ends.unionByName(_renamed(sizes.where("n > 0 and doc_id is not null"), classes, labels))
        merged = components(ends, "x", "y").select(F.col("id").alias("c"), F.col("component_id").alias("m"))

        of_class = classes.select("set_key", "id").join(component, "id", "left").select("set_key", F.coalesce("c", "id").alias("c"))
        of_class = of_class.join(merged, "c", "left").select("set_key", F.coalesce("m", "c").alias("c"))
        told = sizes.join(of_class, "set_key", "left")
        component_id = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("c")).otherwise(F.col("doc_id"))
        told = told.select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))
        return keep(told)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i + 1 : i + 4], ' ') as shingle
  from (select *, unnest(range(greatest(len(w) - 3, least(len(w), 1)))) as i from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as common from s x join s y using (shingle) where x.doc_id <> y.doc_id group by all) p
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * common >= 80 * (na.n + nb.n - common)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) as component_id,
  d.doc_id <= coalesce(r.low, d.doc_id) as kept
from d left join n using (doc_id) left join (select a, min(b) as low from reach group by a) r on r.a = d.doc_id
"""
