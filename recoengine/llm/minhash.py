"""MinHash near-dedup by a signature-coordinate inverted join.

A document's signature is the minimum of ``COORDINATES`` hash functions over
its set of 5-word shingles. Documents are posted under each (coordinate,
value). Two documents of similarity 0.75 agree in at least ``MATCHES``
coordinates but for a chance of 1e-7 a pair, and then share one of their
``COORDINATES - MATCHES + 1`` rarest postings (prefix filter). A value that one document has is
such a posting too, so documents with fewer than ``MATCHES`` shared values are
skipped, and frequent values are seldom merged at all.

Posting lists are not expanded into pairs. First each document is compared
with one document: the least of its lists, by most collisions. The links found
join most lists into one component each. Documents of lists that still hold
several are gathered by the lists' own connection (a cluster; by list, where a
cluster is over ``CLUSTER``), in pairs of blocks of bounded size. A task counts the collisions
of its pairs, confirms those with ``MATCHES`` on the full shingle sets, and
returns only links that join two components.

Documents with equal sets are one class, so copies cost one row.

Defined results: a text without words (or null) has an empty set and links
with nothing; with fewer than five words its set is the whole sequence; rows
with a null id take part, but a component's id is its least non-null one; of
rows with equal ids one stays (``stays``); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoengine.llm.common import as_bytes, byte_chunks, save, table
from recoengine.llm.components import components
from recoengine.llm.windows import hash_runs, packed_texts, unpacked, word_codes

SHINGLE = 5
PERCENT = 75
COORDINATES = 64
#: Chance that a pair of just the similarity collides in fewer coordinates.
MISS = 1e-7
#: Documents of a cluster or list that are merged as one block.
BLOCK = 1000
#: Documents of a cluster, above which its lists are merged one by one.
CLUSTER = 50_000

_MULTIPLY = np.random.default_rng(75).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.random.default_rng(76).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def matches_needed(percent: int = PERCENT, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest threshold that a pair of the similarity fails with a chance
    of at most ``miss`` (binomial tail)."""
    p, below, k = percent / 100, 0.0, 0
    while True:
        below += math.comb(coordinates, k) * p ** k * (1 - p) ** (coordinates - k)
        if below > miss:
            return k
        k += 1


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    joined = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)  # lowers A-Z only
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    codes, at = word_codes(joined, 31)
    lo, hi = np.searchsorted(at, ends - [len(t) for t in texts]), np.searchsorted(at, ends)
    runs = hash_runs(codes, shingle, 32)
    out = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if b - a >= shingle:
            out.append(np.unique(runs[a:b - shingle + 1]))
        else:
            out.append(hash_runs(codes[a:b], b - a, 32) if b > a else np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES) minima; of an empty set all ones."""
    size = np.array([len(s) for s in sets])
    out = np.full((len(sets), COORDINATES), ~np.uint64(0))
    some = np.flatnonzero(size)
    if len(some):
        flat = np.concatenate([sets[i] for i in some])
        begin = np.cumsum(size[some]) - size[some]
        for k in range(COORDINATES):
            out[some, k] = np.minimum.reduceat((flat ^ _SHIFT[k]) * _MULTIPLY[k], begin)
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, set_key, n_shingles, signature) of (doc_id, text)."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 2 << 20):
            texts = as_bytes(chunk.column("text"))
            sets = shingle_sets(texts)
            found = signatures(sets).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, COORDINATES, dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("row"), chunk.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([hashlib.sha256(s.tobytes()).digest() for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), lists],
                ["row", "doc_id", "text_key", "set_key", "n_shingles", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(kernel, f"row long, doc_id {kind}, text_key binary, set_key binary, n_shingles long, signature array<long>")


def prefixes(reps: DataFrame, needed: int) -> DataFrame:
    """(row, token): the rarest postings of each signature, as many as a pair
    with ``needed`` collisions can't all miss; only those that others have too."""
    posts = reps.select("row", F.posexplode("signature").alias("k", "value")).select("row", F.xxhash64("k", "value").alias("token"))
    shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    each = posts.join(shared, "token")
    mine = Window.partitionBy("row")  # at most COORDINATES rows
    each = each.withColumn("_has", F.count(F.lit(1)).over(mine))
    each = each.withColumn("_rank", F.row_number().over(mine.orderBy("n", "token")))
    return each.where(F.col("_rank") <= F.col("_has") - needed + 1).select("row", "token")


def full_sets(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, hashes): shingle sets, as bytes, of ``rows`` (row, doc_id, text_key)."""
    texts = packed_texts(docs).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    joined = texts.join(rows, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("doc_id")))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "packed", 1 << 20):
            sets = shingle_sets(unpacked(chunk.column("packed")))
            yield pa.RecordBatch.from_arrays([chunk.column("row"), pa.array([s.tobytes() for s in sets], pa.binary())], ["row", "hashes"])

    return joined.select("row", "packed").mapInArrow(kernel, "row long, hashes binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""
    both = pairs.join(sets.withColumnsRenamed({"row": "a", "hashes": "x"}), "a").join(sets.withColumnsRenamed({"row": "b", "hashes": "y"}), "b")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])

    return both.mapInArrow(kernel, "a long, b long")


def _merge(needed: int, percent: int):
    """Links that join two components, of two blocks (or one with itself)."""
    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        row, side = rows.column("row").to_numpy(), rows.column("side").to_numpy()  # 0, 1: that block; 2: one block alone
        part = np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
        signs = rows.column("signature").combine_chunks().flatten().to_numpy().reshape(len(row), -1)
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in rows.column("hashes")]
        size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(row)), size)
        shingle, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
        common = often[shingle] > 1  # only these can be in two sets
        owner, shingle = owner[common], shingle[common]
        by = np.argsort(shingle, kind="stable")
        members = owner[by]  # of each shingle, one after the other
        begin = np.searchsorted(shingle[by], np.arange(len(often) + 1))
        cuts = np.searchsorted(owner, np.arange(len(row) + 1))
        links = []
        for i in range(len(row)):
            other = (part != part[i]) & ((side == 2) | (side != side[i])) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
            other[:i + 1] = False
            j = np.flatnonzero(other)
            j = j[(signs[j] == signs[i]).sum(axis=1) >= needed]
            if not len(j):
                continue
            mine = shingle[cuts[i]:cuts[i + 1]]
            both = np.bincount(np.concatenate([members[begin[x]:begin[x + 1]] for x in mine] or [members[:0]]), minlength=len(row))[j]
            for k in j[100 * both >= percent * (size[i] + size[j] - both)]:
                if part[k] != part[i]:
                    links.append((row[i], row[k]))
                    part[part == part[k]] = part[i]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return merge


def across_components(posts: DataFrame, sketched: DataFrame, sets: DataFrame, needed: int, block: int = BLOCK,
                      cluster: int = CLUSTER, percent: int = PERCENT) -> DataFrame:
    """(a, b): links between different components among documents that share a
    posting. ``posts``: (row, token, component)."""
    lists = posts.groupBy("token").agg(F.min("row").alias("least"), F.min("component").alias("_low"), F.max("component").alias("_high"))
    open_ = save(posts.join(lists.where("_low != _high").select("token", "least"), "token"), "open-lists")
    nodes = open_.select(F.col("row").alias("id"), F.col("row").alias("label")).distinct()
    found = components(open_.select(F.col("least").alias("a"), F.col("row").alias("b")), nodes)
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    where = found.join(sizes, "component").select(F.col("id").alias("row"), F.col("component").alias("cluster"), (F.col("n") > cluster).alias("large"))
    placed = open_.join(where, "row").select(
        "row", "component", "large", F.when(F.col("large"), F.col("token")).otherwise(F.col("cluster")).alias("group")).distinct()
    blocks = placed.groupBy("large", "group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = placed.join(blocks, ["large", "group"])
    # a member of block i meets every block j once, in the task of (i, j)
    members = members.withColumn("_own", F.pmod(F.xxhash64("row", "group"), F.col("blocks").cast("long")).cast("int"))
    members = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("large", "group", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
                             F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"),
                             "row", "component")
    # in the task of (i, j) block i is 0 and block j is 1; pairs within a block
    # are left to (i, i)
    members = members.join(sketched.select("row", "signature"), "row").join(sets, "row")
    return members.groupBy("large", "group", "i", "j").applyInArrow(_merge(needed, percent), "a long, b long")


def near_duplicates(docs: DataFrame, block: int = BLOCK, cluster: int = CLUSTER) -> DataFrame:
    """One row a document: (doc_id, n_shingles, component_id, kept, row, stays).
    row numbers the rows of ``docs``, a table as it is read; stays holds for one
    row of each component."""
    docs = docs.select("doc_id", "text")
    needed = matches_needed()
    sketched = save(sketch(docs), "sketch")
    classes = sketched.where("n_shingles > 0").groupBy("set_key").agg(F.min("row").alias("row"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
    reps = sketched.join(classes.select("row"), "row")
    posts = save(prefixes(reps, needed), "postings")

    stars = posts.join(posts.groupBy("token").agg(F.min("row").alias("a")), "token").where("row != a")
    best = stars.groupBy("row", "a").agg(F.count(F.lit(1)).alias("n")).groupBy("row").agg(
        F.max(F.struct("n", -F.col("a")))["col2"].alias("_a"))
    pairs = best.select((-F.col("_a")).alias("a"), F.col("row").alias("b"))
    posted = reps.join(posts.select("row").distinct(), "row").select("row", "doc_id", "text_key")
    sets = full_sets(docs, posted)
    if sketched.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count():
        sets = sets.dropDuplicates(["row"])  # a repeated row brings its text again
    sets = save(sets, "shingle-sets")
    links = save(confirm(pairs, sets), "links")

    nodes = classes.select(F.col("row").alias("id"), F.col("row").alias("label"))
    so_far = components(links, nodes.join(posts.select(F.col("row").alias("id")).distinct(), "id"))
    placed = save(posts.join(so_far.withColumnRenamed("id", "row"), "row"), "placed")
    more = save(across_components(placed, sketched, sets, needed, block, cluster), "links")

    found = components(links.unionByName(more), classes.select(F.col("row").alias("id"), F.col("first").alias("label")))
    by_set = classes.join(found.withColumnRenamed("id", "row"), "row").select("set_key", "component")
    some = sketched.where("n_shingles > 0").join(by_set, "set_key").select(
        "row", "doc_id", "n_shingles", F.col("component.doc_id").alias("component_id"), (F.col("row") == F.col("component.row")).alias("stays"))
    none = sketched.where("n_shingles = 0").select("row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("stays"))
    return some.unionByName(none).select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "row", "stays")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component, with their columns.
    ``docs`` is a table as it is read: its rows are numbered twice alike."""
    row = "__near_row"
    keep = near_duplicates(docs).where("stays").select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(keep, row).select(*docs.columns)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row", "stays")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least l ON l.a = d.doc_id
"""
