"""Embedding near-dedup by iterative quantisation and multi-index tables.

For each length of vectors a rotation is learnt (ITQ) that makes the signs of centred unit vectors balanced
codes of one bit a dimension. The code is cut into substrings, one hash table
each; their number follows from the dimensions and the counted vectors. A vector is posted under its own substrings and looked up
under neighbouring ones; pairs that meet are compared by the cosine of the
original vectors in double precision.

The lookups are exact, whatever the rotation: if two unit vectors are nearer
than r, then in one of the m substrings their rotated coordinates differ by
r**2 / m at most in square. Where a sign differs there, the two coordinates'
sizes add up to what they differ by, so over those coordinates the squares of
one of the two vectors sum to half of that budget at most: flipping each set of
its coordinates with such a sum reaches the other's substring.

Each vector's codes and coordinates' costs (squares, as whole numbers, so that
sums are exact) are stored once. A pair may meet in several tables and from both
sides; its first meeting, by table and then from the smaller id, is the one that
counts, and that is settled from the stored numbers alone. Where a code is
shared by over ``DENSE`` vectors, as among near copies, its vectors are not
paired as rows: blocks of them are compared as matrices, and a task returns how
many links each vector has and the links that connect its block. A vector
with more lookups than an eighth (``WIDE``) of its label's vectors, as in a group
around the mean, is compared in such blocks with all of its label instead, which
costs less; the result is the same.

Equal vectors of a label are one class with a count. The rotations are learnt on
at most ``SAMPLE`` vectors in all (smallest hash of their id); a length with
fewer sampled vectors than dimensions keeps its axes, centred on those sampled.
All vectors are indexed, under their length and label.

Defined results: a vector that is null, zero, holds null or non-finite
components or has a null label links with nothing; vectors link with those of
their own length only; a zero vector has no equals; rows with equal ids are separate vectors for the
links and share a component id; labels keep their type, of ties in cosine all
count; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm.common import save, table
from recoengine.llm.components import components

COSINE = 0.98
#: Bits that a substring may have, as its code is an int64.
MOST_BITS = 62
#: Vectors that the rotation is learnt on, at most.
SAMPLE = 20_000
#: Vectors with one code, above which they are compared in blocks.
DENSE = 64
#: Vectors of a block.
BLOCK = 2048
#: Lookups of a vector, as a share of its label's vectors (and at least
#: ``WIDE_LEAST``), above which it is compared with them all.
WIDE = 1 / 8
WIDE_LEAST = 64
#: Squares of coordinates are rounded down to whole numbers of this size.
UNIT = 2.0 ** -40


def learn_rotation(x: np.ndarray, rounds: int = 30, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation (ITQ): codes are the signs of (x - mean) @ rotation."""
    mean = x.mean(axis=0)
    centred = x - mean
    _, principal = np.linalg.eigh(centred.T @ centred)  # a matrix of dimensions, however many vectors
    v = centred @ principal
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return mean, principal @ r


def flip_sets(cost: np.ndarray, budget: float, most: float = math.inf) -> list[int] | None:
    """Bit masks of the sets of coordinates whose costs sum to the budget at
    most (the empty set first); None if there are over ``most``."""
    order = [int(i) for i in np.argsort(cost) if cost[i] <= budget]
    out = []

    def walk(k: int, mask: int, left: float) -> None:
        out.append(mask)
        for j in range(k, len(order)):
            if cost[order[j]] > left or len(out) > most:
                break
            walk(j + 1, mask | 1 << order[j], left - cost[order[j]])

    walk(0, 0, budget)
    return out if len(out) <= most else None


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _by_length(batch: pa.RecordBatch, column: str, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of ``rows`` rows at most whose vectors have one length."""
    sizes = pc.list_value_length(batch.column(column))
    for n in pc.unique(sizes):
        own = batch.filter(pc.equal(sizes, n))
        for at in range(0, own.num_rows, rows):
            yield own.slice(at, rows)


def _codes(r: np.ndarray, tables: int) -> np.ndarray:
    """Each row's code in each substring."""
    parts = np.array_split(np.arange(r.shape[1]), tables)
    return np.stack([((r[:, p] >= 0) * (1 << np.arange(len(p)))).sum(axis=1) for p in parts], axis=1)


def _signs(codes: np.ndarray, dim: int) -> np.ndarray:
    """+1 and -1 of each coordinate, from the codes."""
    parts = np.array_split(np.arange(dim), codes.shape[1])
    return np.concatenate([np.where(codes[:, [t]] >> np.arange(len(p)) & 1, 1.0, -1.0) for t, p in enumerate(parts)], axis=1)


def _first_meeting(codes_a: np.ndarray, cost_a: np.ndarray, codes_b: np.ndarray, cost_b: np.ndarray, budget: int) -> np.ndarray:
    """Of each pair of rows (a has the smaller id): 2 t if a's lookup reaches b
    first in table t, 2 t + 1 if only b's reaches a."""
    dim, tables = cost_a.shape[1], codes_a.shape[1]
    begin = [int(p[0]) for p in np.array_split(np.arange(dim), tables)]
    unlike = _signs(codes_a, dim) != _signs(codes_b, dim)
    ok_a = np.add.reduceat(cost_a * unlike, begin, axis=1) <= budget
    ok_b = np.add.reduceat(cost_b * unlike, begin, axis=1) <= budget
    each = np.where(ok_a, 2 * np.arange(tables), np.where(ok_b, 2 * np.arange(tables) + 1, 2 * tables))
    return each.min(axis=1)


def table_count(dim: int, largest: int, tables: int | None = None) -> int:
    """Number of substrings: dimensions / log2(vectors of the largest label), so
    that a substring has about as many values as there are vectors, or
    ``tables``; as many at least as ``MOST_BITS`` asks for."""
    wanted = tables or round(dim / math.log2(max(largest, 2)))
    return min(dim, max(wanted, math.ceil(dim / MOST_BITS)))


def _budget(cosine: float, tables: int) -> int:
    return math.ceil(((2 - 2 * cosine) / tables / 2 * (1 + 1e-6) + 1e-9) / UNIT)


KEY = ["label", "dim", "t", "code"]


def coded(classes: DataFrame, tables: int | None, sample: int) -> DataFrame | None:
    """(id, label, n, vector, dim, codes, cost) of rows (id, label, n, vector);
    None without rows."""
    some = classes.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()["vector"]
    if not len(some):
        return None
    sizes = save(classes.groupBy(F.size("vector").alias("dim"), "label").agg(F.count(F.lit(1)).alias("alike")), "label-sizes")
    # one row a length
    largest = sizes.groupBy("dim").agg(F.max("alike").alias("n"))
    number = {r["dim"]: table_count(r["dim"], r["n"], tables) for r in largest.collect()}
    learnt: dict[int, tuple[np.ndarray, np.ndarray | None]] = {}
    for dim, own in some.groupby(some.map(len)):
        x = _unit(np.stack([np.asarray(v, dtype=np.float64) for v in own]))
        learnt[int(dim)] = learn_rotation(x) if len(x) >= dim else (x.mean(axis=0), None)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _by_length(b, "vector"):
                v = _matrix(part.column("vector"))
                mean, rotation = learnt.get(v.shape[1], (0.0, None))  # the lookups are exact under any
                r = _unit(v) - mean
                r = r if rotation is None else r @ rotation
                codes, cost = _codes(r, number[v.shape[1]]), np.floor(r * r / UNIT).astype(np.int64)
                dims = pa.array(np.full(len(v), v.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, dims, _lists(codes), _lists(cost)], [*part.schema.names, "dim", "codes", "cost"])

    rows = classes.select("id", "label", "n", "vector")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    done = rows.mapInArrow(kernel, f"{ddl}, dim int, codes array<long>, cost array<long>")
    return save(done.join(sizes, ["dim", "label"]), "coded-vectors")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(x).ravel()))


def _whole(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lookups(rows: DataFrame, cosine: float) -> DataFrame:
    """(id, label, dim, t, code): the codes that each vector looks up; t is -1 in
    the one row of a vector that is compared with all of its label."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _by_length(b, "cost"):
                codes, cost = _whole(part.column("codes")), _whole(part.column("cost"))
                budget = _budget(cosine, codes.shape[1])
                row, where, code = [], [], []
                parts = np.array_split(np.arange(cost.shape[1]), codes.shape[1])
                for i, alike in enumerate(part.column("alike").to_pylist()):
                    left, mine = max(WIDE_LEAST, WIDE * alike), []
                    for t, p in enumerate(parts):
                        found = flip_sets(cost[i, p], budget, left)
                        if found is None:
                            mine = [(-1, 0)]
                            break
                        left -= len(found)
                        mine += [(t, int(codes[i, t]) ^ m) for m in found]
                    row += [i] * len(mine)
                    where += [t for t, _ in mine]
                    code += [c for _, c in mine]
                picked = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([picked.column("id"), picked.column("label"), picked.column("dim"),
                                                  pa.array(where, pa.int32()), pa.array(code, pa.int64())], ["id", *KEY])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("id", "label", "dim", "codes", "cost", "alike").mapInArrow(kernel, f"id long, label {kind}, dim int, t int, code long")


def _near(u: np.ndarray, v: np.ndarray, cosine: float) -> np.ndarray:
    return (u * v).sum(axis=1) / (np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1)) >= cosine


def _sparse_pairs(looked: DataFrame, posted: DataFrame, rows: DataFrame, cosine: float) -> DataFrame:
    """(a, b), a < b: links whose first meeting is under a code that few share."""
    meet = looked.withColumnRenamed("id", "x").join(posted.withColumnRenamed("id", "y"), KEY).where("x != y")
    meet = meet.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.min(2 * F.col("t") + (F.col("x") > F.col("y")).cast("int")).alias("met"))

    def beside(pairs: DataFrame, *columns: str) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(rows.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
        return pairs

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _by_length(batch, "vector_a"):
                keep = pa.array(_near(_matrix(b.column("vector_a")), _matrix(b.column("vector_b")), cosine))
                yield pa.RecordBatch.from_arrays([b.column(c).filter(keep) for c in ("a", "b", "met")], ["a", "b", "met"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _by_length(batch, "cost_a"):
                codes = _whole(b.column("codes_a"))
                first = _first_meeting(codes, _whole(b.column("cost_a")), _whole(b.column("codes_b")), _whole(b.column("cost_b")), _budget(cosine, codes.shape[1]))
                keep = pa.array(first == b.column("met").to_numpy())
                yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])

    # few of those that meet are links: only those take their codes along
    links = beside(meet, "vector").select("a", "b", "met", "vector_a", "vector_b").mapInArrow(rerank, "a long, b long, met int")
    return beside(links, "codes", "cost").mapInArrow(settle, "a long, b long")


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) links that connect what the matrix connects."""
    label = np.arange(sum(links.shape))
    n, out = len(links), []
    for i in range(n):
        found = np.flatnonzero(links[i])
        if not len(found):
            continue
        parts, first = np.unique(label[n + found], return_index=True)
        new = parts != label[i]
        if new.any():
            out += [(i, int(found[k])) for k in first[new]]
            label[np.isin(label, parts[new])] = label[i]
    return out


def _compare(cosine: float):
    """Links of a block that looks up (side 0) with one that is posted (side 1):
    (a, b, null) connect them, (a, null, links) count them."""
    def kernel(rows: pa.Table) -> pa.Table:
        side = rows.column("side").to_numpy()
        t = rows.column("t")[0].as_py()
        x, y = (rows.filter(pa.array(side == k)) for k in (0, 1))
        out: list[tuple] = []
        if x.num_rows and y.num_rows:
            idx, idy = x.column("id").to_numpy(), y.column("id").to_numpy()
            ux, uy = _unit(_matrix(x.column("vector").combine_chunks())), _unit(_matrix(y.column("vector").combine_chunks()))
            links = (ux @ uy.T >= cosine - 1e-9) & (idx[:, None] != idy[None, :])
            codes, cx, cy = _whole(x.column("codes")), _whole(x.column("cost")).astype(np.float64), _whole(y.column("cost")).astype(np.float64)
            sx, sy = _signs(codes, cx.shape[1]), _signs(_whole(y.column("codes")), cx.shape[1])
            budget, lower = _budget(cosine, codes.shape[1]), idx[:, None] < idy[None, :]
            if t < 0:  # two that are compared with all meet twice
                links &= ~(y.column("wide").to_numpy()[None, :] & ~lower)
            first = np.full(links.shape, 2 * codes.shape[1])
            for k, p in list(enumerate(np.array_split(np.arange(cx.shape[1]), codes.shape[1])))[t::-1] if t >= 0 else ():
                # whole numbers below 2**53: exact
                from_x = (cx[:, p].sum(axis=1)[:, None] - (cx[:, p] * sx[:, p]) @ sy[:, p].T) / 2 <= budget
                from_y = (cy[:, p].sum(axis=1)[None, :] - sx[:, p] @ (cy[:, p] * sy[:, p]).T) / 2 <= budget
                first = np.where(np.where(lower, from_x, from_y), 2 * k, np.where(np.where(lower, from_y, from_x), 2 * k + 1, first))
            if t >= 0:
                links &= first == np.where(lower, 2 * t, 2 * t + 1)
            # at the threshold the plain sum decides, as it does for single pairs
            i, j = np.nonzero(links)
            vx, vy = _matrix(x.column("vector").combine_chunks()), _matrix(y.column("vector").combine_chunks())
            for at in range(0, len(i), 1 << 16):
                a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                links[a, b] = _near(vx[a], vy[b], cosine)
            nx, ny = x.column("n").to_numpy(), y.column("n").to_numpy()
            out += [(int(idx[a]), int(idy[b]), None) for a, b in _forest(links)]
            out += [(int(a), None, int(c)) for a, c in zip(idx, links @ ny) if c]
            out += [(int(b), None, int(c)) for b, c in zip(idy, nx @ links) if c]
        a, b, n = zip(*out) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(n, pa.int64())})
    return kernel


def _dense_links(looked: DataFrame, posted: DataFrame, rows: DataFrame, cosine: float, block: int) -> DataFrame:
    """(a, b, links) of ``_compare`` over the codes that many share."""
    blocks = posted.groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_post")).join(
        looked.groupBy(*KEY).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_look")), KEY)
    blocks = save(blocks, "dense-blocks")

    def copies(ids: DataFrame, own: str, others: str, mine: str, other: str, side: int) -> DataFrame:
        placed = ids.join(blocks, KEY).withColumn(mine, F.pmod(F.xxhash64("id"), F.col(own).cast("long")).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).select(*KEY, "i", "j", "id", F.lit(side).alias("side"))

    both = copies(looked, "n_look", "n_post", "i", "j", 0).unionByName(copies(posted, "n_post", "n_look", "j", "i", 1))
    both = both.join(rows.select("id", "n", "vector", "codes", "cost", "wide"), "id")
    return both.groupBy(*KEY, "i", "j").applyInArrow(_compare(cosine), "a long, b long, links long")


def similar(classes: DataFrame, cosine: float = COSINE, tables: int | None = None, sample: int = SAMPLE, dense: int = DENSE,
            block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """((a, b) links that connect what is linked, (id, links) of the rows that
    have any) among rows (id, label, n, vector) with equal labels and a cosine of
    at least ``cosine``; a row stands for ``n`` vectors."""
    rows = coded(classes, tables, sample)
    if rows is None:
        spark = classes.sparkSession
        return spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "id long, links long")
    looked = save(lookups(rows, cosine), "lookups")
    wide = looked.where("t < 0").select("id", F.lit(True).alias("wide"))
    rows = save(rows.join(wide, "id", "left").withColumn("wide", F.coalesce("wide", F.lit(False))), "vector-rows")
    posted = rows.where("not wide").select("id", "label", "dim", F.posexplode("codes").alias("t", "code"))
    everything = rows.select("id", "label", "dim", F.lit(-1).alias("t"), F.lit(0).cast("long").alias("code"))
    all_of = looked.where("t < 0").select(*KEY).distinct()
    looked_at = posted.unionByName(everything.join(all_of, KEY, "left_semi"))
    many = save(posted.groupBy(*KEY).count().where(F.col("count") > dense).select(*KEY).unionByName(all_of), "dense-codes")
    pairs = save(_sparse_pairs(looked.join(many, KEY, "left_anti"), posted.join(many, KEY, "left_anti"), rows, cosine), "vector-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = both.join(rows.select(F.col("id").alias("b"), "n"), "b").select(F.col("a").alias("id"), F.col("n").alias("links"))
    if many.limit(1).count():
        found = save(_dense_links(looked.join(many, KEY), looked_at.join(many, KEY), rows, cosine, block), "dense-links")
        pairs = pairs.unionByName(found.where("b is not null").select("a", "b"))
        links = links.unionByName(found.where("b is null").select(F.col("a").alias("id"), "links"))
    return pairs, links.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(rows: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", **params) -> DataFrame:
    """One row a vector: (vec_id, n_links, component_id, kept)."""
    v = F.col("vector")
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                       F.col(vector_col).alias("vector"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
    classes = save(good.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    pairs, links = similar(classes, cosine, **params)
    smallest = components(pairs, classes.select("id", F.col("first_id").alias("label")))
    per = classes.join(links, "id", "left").join(smallest, "id").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.col("component").alias("component_id"))
    linked = rows.where("usable").join(per, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")))
    out = linked.select("vec_id", "n_links", "component_id").unionByName(
        rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
good AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least l ON l.a = vec_id LEFT JOIN links k ON k.a = vec_id
"""
