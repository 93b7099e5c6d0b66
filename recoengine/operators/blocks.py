"""Blocked factor products (the all-pairs kernels behind J4 and J6).

Rows of a factor table ``(id, features)`` are hashed into *stripes* of
about ``stripe_rows`` rows. A *tile* pairs one stripe of the left table
with one stripe of the right table; every row is copied once per tile it
takes part in and the two sides meet in one group, where numpy screens
the products in float32, scores in float64 what the rounding of that
product can't rule out, and emits only what the caller keeps:

* ``top_n_products``: per left row the best ``n`` right rows (optionally only
  positive scores, optionally skipping "seen" pairs); a stripe of users is held by
  one task and all items pass by it, longest first, so its lists are final;
* ``similar_pairs``: cosine above a threshold over the upper triangle of
  stripe pairs, emitted in both directions;
* ``similar_pairs_by_item``: the same rows, but a stripe meets all items in one
  task, so an item's rows come together and in order: items move, pairs don't.

Neither side ever forms all pairs as rows; each group of pairs holds at most two
stripes and sends its pairs back in batches, so task memory is bounded by
``stripe_rows`` whatever the data size or the number of pairs, and replication is one copy per stripe of the other side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoengine.operators.cells import no_vector
from recoengine.operators.topn import top_n_per_group

# Replication of an all-pairs product is U*M*(1/stripe_u + 1/stripe_i)
# rows: large stripes keep the shuffle small, and the kernel processes a
# tile in chunks so memory stays flat whatever the stripe size.
DEFAULT_STRIPE_ROWS = 32768
# The item id set (4 bytes per id) is broadcast to pre-filter "seen" pairs
# only below this size; above it the filter is skipped (the kernel ignores
# pairs whose item is not in its tile anyway).
ID_BROADCAST_BYTES = 32 * 1024 * 1024
MIN_STRIPE_ROWS = 512
#: Users and items whose products are screened at once (8 MB of float32), items
#: of the first such block, and products and columns of a block of a similarity tile.
SCREEN_USERS, SCREEN_ITEMS, SCREEN_FIRST = 256, 8192, 1024
SCREEN_CELLS, SCREEN_COLS = 1 << 20, 4096


def stripe_of(id_col: Column | str, n_stripes: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.xxhash64(c.cast("int")), F.lit(n_stripes)).cast("int")


def n_stripes(n_rows: int, stripe_rows: int, want: int = 1) -> int:
    """Stripes of at most ``stripe_rows`` rows; more (down to
    ``MIN_STRIPE_ROWS`` rows each) when that gives ``want`` stripes."""
    s = max(1, math.ceil(n_rows / max(1, stripe_rows)))
    cap = max(1, n_rows // MIN_STRIPE_ROWS)
    return max(s, min(want, cap))


def _present(df: pd.DataFrame, col: str = "features") -> pd.DataFrame:
    """Rows with a feature vector (an absent cogroup side has no columns)."""
    if len(df) == 0 or col not in df.columns:
        return df.iloc[0:0]
    return df[df[col].notna()]


def _matrix(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.concatenate(col.to_numpy()).reshape(len(col), -1).astype(np.float64)


def _stored_matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """In the precision that the vectors are stored in."""
    flat = lists.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def _arrow_matrix(lists: pa.ChunkedArray) -> np.ndarray:
    return _stored_matrix(lists).astype(np.float64)


# ---------------------------------------------------------- screening ---

# Products are first taken of unit vectors in single precision; what may reach
# the bound by that product's rounding is scored again in double precision.

def _slack(k: int) -> float:
    """What rounding may take from a single-precision product of unit vectors."""
    return (k + 8) * 2.0 ** -23


def _norms(x: np.ndarray) -> np.ndarray:
    """Norms without overflow; not finite for rows that hold such values."""
    if not x.size:
        return np.zeros(len(x))
    with np.errstate(all="ignore"):
        top = np.abs(x).max(axis=1)
        safe = np.where(top > 0, top, 1.0)[:, None]
        return top * np.sqrt(((x / safe) ** 2).sum(axis=1))


def _dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """a[i] . b[j], pair by pair, some at a time."""
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 10):
        p, q = i[at:at + (1 << 10)], j[at:at + (1 << 10)]
        out[at:at + (1 << 10)] = np.einsum("ij,ij->i", a[p].astype(np.float64, copy=False), b[q].astype(np.float64, copy=False))
    return out


# ------------------------------------------------------------- top-n ---

def _first_k(row: np.ndarray, col: np.ndarray, value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row (value desc, col asc) and their places from 0."""
    order = np.lexsort((col, -value, row))
    row, col, value = row[order], col[order], value[order]
    start = np.r_[0, np.flatnonzero(np.diff(row)) + 1]
    pos = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
    keep = pos < k
    return row[keep], col[keep], value[keep], pos[keep]


class _Lists:
    """The ``k`` best items of each user so far (ties: lower id), while blocks of
    items are met. An item is scored in double precision only if its screened product
    may reach the user's k-th score so far, and the user's ``floor``, below which
    nothing is wanted. Items met first should be those of large norm."""

    def __init__(self, U: np.ndarray, k: int, positive_only: bool, floor: np.ndarray | None = None) -> None:
        size = _norms(U.astype(np.float64, copy=False))
        self.rows = np.flatnonzero(np.isfinite(size) & ((size > 0) | (not positive_only)))
        self.place = np.full(len(U), -1)
        self.place[self.rows] = np.arange(len(self.rows))
        self.U, self.k, self.positive_only = U[self.rows], k, positive_only
        self.scale = np.maximum(size[self.rows], np.finfo(np.float64).tiny)
        with np.errstate(all="ignore"):
            self.U32 = (self.U / self.scale[:, None]).astype(np.float32)
        self.floor = None if floor is None else floor[self.rows]
        self.least = np.full(len(self.rows), 0.0 if positive_only else -np.inf)
        if floor is not None:
            self.least = np.maximum(self.least, self.floor)
        self.value = np.full((len(self.rows), k), -np.inf)
        self.id = np.zeros((len(self.rows), k), dtype=np.int64)
        self.room = np.empty(0, dtype=np.float32)
        self.met = floor is not None  # whether the first bound is found

    def meet(self, ids: np.ndarray, I: np.ndarray, norm: np.ndarray, seen_r: np.ndarray, seen_c: np.ndarray) -> None:
        """``norm``: of the items ``I``, all finite; seen_r, seen_c: (row of U, row of I)
        of the pairs to leave out."""
        p = self.place[seen_r]
        seen_r, seen_c = p[p >= 0], seen_c[p >= 0]
        # few items give the first bound, as finding it costs more than the product
        starts = [*range(0, len(ids), SCREEN_ITEMS)] if self.met else [0, *range(min(SCREEN_FIRST, SCREEN_ITEMS), len(ids), SCREEN_ITEMS)]
        for c, d in zip(starts, [*starts[1:], len(ids)]):
            inside = (seen_c >= c) & (seen_c < d)
            with np.errstate(all="ignore"):
                self._meet(ids[c:d], I[c:d], norm[c:d], seen_r[inside], seen_c[inside] - c)
            self.met = True

    def _meet(self, ids: np.ndarray, I: np.ndarray, norm: np.ndarray, seen_r: np.ndarray, seen_c: np.ndarray) -> None:
        tiny = np.finfo(np.float64).tiny
        largest = max(norm.max(), tiny)
        I32 = np.ascontiguousarray((I / largest).astype(np.float32).T)
        slack = _slack(I.shape[1])
        least = self.least / np.maximum(self.scale * largest, tiny)  # of the product of unit vectors
        live = np.flatnonzero(1 + slack >= least)  # for the others these items are too short
        which = np.full(len(least), -1)
        which[live] = np.arange(len(live))
        seen_r = which[seen_r]
        order = np.argsort(seen_r, kind="stable")
        seen_r, seen_c = seen_r[order], seen_c[order]
        for lo in range(0, len(live), SCREEN_USERS):
            mine = live[lo:lo + SCREEN_USERS]
            S = np.matmul(self.U32[mine], I32, out=self._product(len(mine), len(ids)))
            a, b = np.searchsorted(seen_r, (lo, lo + len(mine)))
            S[seen_r[a:b] - lo, seen_c[a:b]] = -np.inf
            limit = least[mine] - slack
            if not self.met and self.k < len(ids):  # nothing is kept yet: the screened k-th score
                limit = np.maximum(limit, np.partition(S, len(ids) - self.k, axis=1)[:, len(ids) - self.k] - 2 * slack)
            low = np.nextafter(limit.astype(np.float32), np.float32(-np.inf))
            some = np.flatnonzero(S.max(axis=1) >= low)
            rr, cc = np.divmod(np.flatnonzero((S[some] >= low[some, None]) & (S[some] > -np.inf)), len(ids))
            if len(rr):
                self._add(mine[some[rr]], ids[cc], _dots(self.U, I, mine[some[rr]], cc))

    def _product(self, rows: int, columns: int) -> np.ndarray:
        """Room for a product; always the same, so it stays in the cache."""
        if self.room.size < rows * columns:
            self.room = np.empty(rows * columns, dtype=np.float32)
        return self.room[:rows * columns].reshape(rows, columns)

    def _add(self, row: np.ndarray, ids: np.ndarray, value: np.ndarray) -> None:
        good = np.isfinite(value) & ((value > 0) | (not self.positive_only)) & (value >= self.least[row])
        if not good.any():
            return
        users, at = np.unique(row[good], return_inverse=True)
        kept = self.value[users]
        r, c = np.nonzero(kept > -np.inf)
        r, i, v, pos = _first_k(np.append(r, at), np.append(self.id[users[r], c], ids[good]), np.append(kept[r, c], value[good]), self.k)
        kept[r, pos] = v
        self.value[users] = kept
        self.id[users[r], pos] = i
        full = kept[:, -1] > -np.inf
        self.least[users[full]] = np.maximum(self.least[users[full]], kept[full, -1])

    def lists(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row of U, id, score, place) some users at a time."""
        for lo in range(0, len(self.rows), max(1, PAIR_BATCH // self.k)):
            r, pos = np.nonzero(self.value[lo:lo + max(1, PAIR_BATCH // self.k)] > -np.inf)
            if len(r):
                yield self.rows[lo + r], self.id[lo + r, pos], self.value[lo + r, pos], pos


def _best(U: np.ndarray, I: np.ndarray, k: int, positive_only: bool, seen_r: np.ndarray, seen_c: np.ndarray,
          floor: np.ndarray | None = None):
    """Yields (user row, item row, score, place) of each user's ``k`` best items
    (ties: lower item row), some users at a time. Items are met by falling norm."""
    lists = _Lists(U, k, positive_only, floor)
    norm = _norms(I)
    by = np.argsort(-norm, kind="stable")
    by = by[np.isfinite(norm[by])]
    place = np.full(len(I), -1)
    place[by] = np.arange(len(by))
    ok = place[seen_c] >= 0
    if len(by):
        lists.meet(by, I[by], norm[by], seen_r[ok], place[seen_c[ok]])
    yield from lists.lists()


def _top_n_kernel(n: int, positive_only: bool):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"uid": pd.Series([], dtype="int32"),
                              "rank": pd.Series([], dtype="int32"),
                              "mid": pd.Series([], dtype="int32"),
                              "r": pd.Series([], dtype="float64")})
        users = _present(left)
        right = _present(right, "item_features")
        if len(users) == 0 or len(right) == 0:
            return empty
        right = right.sort_values("mid", kind="stable")
        mids = right["mid"].to_numpy(dtype=np.int64)
        I = _matrix(right["item_features"])
        uids = users["uid"].to_numpy(dtype=np.int64)
        U = _matrix(users["features"])
        # a user's n-th score so far, if the caller knows it
        floor = users["least"].to_numpy(dtype=np.float64) if "least" in users.columns else None
        seen = left[left["features"].isna() & left["seen_mid"].notna()]
        seen_r = seen_c = np.zeros(0, dtype=np.int64)
        if len(seen):
            row_of = pd.Index(uids).get_indexer(seen["uid"].to_numpy(dtype=np.int64))
            col_of = pd.Index(mids).get_indexer(seen["seen_mid"].to_numpy(dtype=np.int64))
            ok = (row_of >= 0) & (col_of >= 0)
            seen_r, seen_c = row_of[ok], col_of[ok]
        out = [pd.DataFrame({"uid": uids[row].astype("int32"), "rank": (pos + 1).astype("int32"),
                             "mid": mids[col].astype("int32"), "r": value})
               for row, col, value, pos in _best(U, I, min(n, len(mids)), positive_only, seen_r, seen_c, floor)]
        return pd.concat(out, ignore_index=True) if out else empty

    return run


#: Columns of a tile's kind: a user, a pair to leave out, an item.
_USER, _SEEN, _ITEM = 0, 1, 2


def _items_in_blocks(batches: Iterator[pa.RecordBatch], users: list[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Some items at a time, with the pairs to leave out, which come before their
    item. The users, who come first, are put into ``users``."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        is_user = pc.equal(batch.column("kind"), _USER)
        if pc.any(is_user).as_py():
            users.append(batch.filter(is_user))
            batch = batch.filter(pc.invert(is_user))
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < SCREEN_ITEMS:
            continue
        rows = pa.Table.from_batches(held)
        mids = rows.column("mid").to_numpy()
        ends = np.flatnonzero(np.diff(mids))  # the last item may go on
        if len(ends):
            yield rows.slice(0, int(ends[-1]) + 1)
            held = rows.slice(int(ends[-1]) + 1).to_batches()
            n = sum(b.num_rows for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _lists_kernel(n: int, positive_only: bool):
    """The lists of a tile's users, who are held, over its items, which pass by."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        users: list[pa.RecordBatch] = []
        lists = uids = None
        for rows in _items_in_blocks(batches, users):
            if not users:
                continue
            if lists is None:
                mine = pa.Table.from_batches(users)
                uids = mine.column("uid").to_numpy()
                by = np.argsort(uids, kind="stable")
                lists = _Lists(_stored_matrix(mine.column("features")), n, positive_only)
            items = rows.filter(pc.equal(rows.column("kind"), _ITEM))
            I = _stored_matrix(items.column("features"))
            norm, mids = _norms(I.astype(np.float64, copy=False)), items.column("mid").to_numpy().astype(np.int64)
            good = np.flatnonzero(np.isfinite(norm))
            I, norm, mids = I[good], norm[good], mids[good]
            if not len(mids):
                continue
            seen = rows.filter(pc.equal(rows.column("kind"), _SEEN))
            left_out = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            if seen.num_rows:
                i, r = _matches(uids[by], seen.column("uid").to_numpy())
                r, seen_mid = by[r], seen.column("mid").to_numpy()[i]
                order = np.argsort(mids, kind="stable")
                i, c = _matches(mids[order], seen_mid)
                left_out = r[i], order[c]
            lists.meet(mids, I, norm, *left_out)
        if lists is not None:
            for row, mid, value, pos in lists.lists():
                yield pa.RecordBatch.from_arrays([pa.array(uids[row], pa.int32()), pa.array(pos + 1, pa.int32()), pa.array(mid, pa.int32()),
                                                  pa.array(value, pa.float64())], ["uid", "rank", "mid", "r"])

    return run


def _matches(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``wanted``, place in ``ids``) of all equal pairs; ``ids`` in order."""
    first = np.searchsorted(ids, wanted)
    times = np.searchsorted(ids, wanted, "right") - first
    i = np.repeat(np.arange(len(wanted)), times)
    return i, first[i] + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)


#: Users of a tile, in stripes: a user takes less than a list and two vectors.
USER_STRIPES = 4


def top_n_products(users: DataFrame, items: DataFrame, n: int, *, seen: DataFrame | None = None,
                   positive_only: bool = True, stripe_rows: int = DEFAULT_STRIPE_ROWS,
                   n_users: int | None = None, n_items: int | None = None) -> DataFrame:
    """(uid, rank, mid, r): for every user factor row the ``n`` item rows
    with the highest dot product (ties: lower mid first).

    ``users``/``items``: ``(id, features)``. ``seen``: optional ``(uid, mid)``
    pairs to skip; each comes to its user's tile right before its item. A tile's users
    are held by one task, and all items pass by them in order of falling norm; with
    fewer users than tasks the items are dealt over several tiles, too.
    """
    spark = users.sparkSession
    want = spark.sparkContext.defaultParallelism
    nu = n_users if n_users is not None else users.count()
    ni = n_items if n_items is not None else items.count()
    su = n_stripes(nu, USER_STRIPES * stripe_rows, 2 * want)
    if su > want:  # no task is left alone at the end
        su = math.ceil(su / want) * want
    si = n_stripes(ni, max(1, ni), max(1, want // su))

    def row(kind: int, tile: Column, uid: Column, mid: Column, features: Column, at: Column) -> list[Column]:
        return [tile.alias("tile"), F.lit(kind).alias("kind"), uid.cast("int").alias("uid"), mid.cast("int").alias("mid"), features.alias("features"), at.alias("_at")]

    none = F.lit(None)
    u = users.where("id is not null and features is not null").select(F.col("id").cast("int").alias("uid"), "features")
    left = u.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(si - 1)))).select(
        *row(_USER, stripe_of("uid", su) * si + F.col("_t"), F.col("uid"), none, F.col("features"), none.cast("double")))
    square = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    it = items.where("id is not null and features is not null").select(F.col("id").cast("int").alias("mid"), "features", F.coalesce(-square, F.lit(0.0)).alias("_at"))
    right = it.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(su - 1)))).select(
        *row(_ITEM, F.col("_t") * si + stripe_of("mid", si), none, F.col("mid"), F.col("features"), F.col("_at")))
    rows = left.unionByName(right)
    if seen is not None:
        # distinct bounds the seen rows of a tile by its users x items; pairs of
        # unknown users are simply ignored in their tile, so the user side is not
        # re-derived just to filter them
        s = seen.select(F.col("uid").cast("int").alias("uid"), F.col("mid").cast("int").alias("mid")).distinct()
        scored = it.select("mid", "_at").distinct()
        s = s.join(F.broadcast(scored) if ni * 12 <= ID_BROADCAST_BYTES else scored, "mid").where("uid is not null")
        rows = rows.unionByName(s.select(*row(_SEEN, stripe_of("uid", su) * si + stripe_of("mid", si), F.col("uid"), F.col("mid"),
                                              no_vector(u), F.col("_at"))))

    # one task a tile: tiles are few and heavy, so they are not left to a hash
    rows = rows.repartitionById(su * si, "tile").sortWithinPartitions("tile", F.asc_nulls_first("_at"), F.asc_nulls_first("mid"), "kind")
    partial = rows.drop("_at").groupBy("tile").applyInArrow(_lists_kernel(n, positive_only), "uid int, rank int, mid int, r double")
    if si == 1:
        # every user met all items in its one tile: the kernel's exact
        # top-n (ties by mid) is final, no shuffle across tiles needed
        return partial
    return top_n_per_group(partial.drop("rank"), ["uid"], [F.desc("r"), F.asc("mid")], n) \
        .select("uid", "rank", "mid", "r")


# -------------------------------------------------------- similarity ---

PAIRS = "mid int, sim_mid int, r double"
#: Pairs sent back in one batch.
PAIR_BATCH = 1 << 18


def _screened(ua: np.ndarray, ub: np.ndarray, limit: np.float32, same: bool) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
    """Yields (rows, columns, row, column) of the products above ``limit``, block by
    block, the last two counted from the block's first; of one matrix with itself
    (``same``) only blocks that reach above the diagonal. A block
    stays in the processor's cache, and its marks are looked through eight at a time."""
    step = max(16, SCREEN_CELLS // SCREEN_COLS)
    product = np.empty(step * SCREEN_COLS, dtype=np.float32)
    marks = np.zeros(-(-step * SCREEN_COLS // 8) * 8, dtype=bool)
    for lo in range(0, len(ua), step):
        left = ua[lo:lo + step]
        for c in range(lo if same else 0, len(ub), SCREEN_COLS):
            right = ub[c:c + SCREEN_COLS]
            size, w = len(left) * len(right), len(right)
            block = product[:size].reshape(len(left), w)
            np.matmul(left, right.T, out=block)
            np.greater(block, limit, out=marks[:size].reshape(len(left), w))
            end = -(-size // 8) * 8
            marks[size:end] = False
            eight = np.flatnonzero(marks[:end].view(np.uint64) != 0)
            if not len(eight):
                continue
            which = np.flatnonzero(marks[:end].reshape(-1, 8)[eight])
            yield slice(lo, lo + len(left)), slice(c, c + w), *np.divmod(eight[which >> 3] * 8 + (which & 7), w)


def _similar_kernel(threshold: float, stripes: int):
    """The pairs of a tile, sent back while the tile is being multiplied."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = divmod(int(key[0].as_py()), stripes)
        rows = pa.Table.from_batches(list(batches))
        sides = []
        for side in ((False,) if a == b else (False, True)):
            mine = rows.filter(pc.equal(rows.column("second"), side))
            ids = mine.column("id").to_numpy().astype(np.int64)
            x = _arrow_matrix(mine.column("features"))
            norm = np.sqrt((x * x).sum(axis=1))
            keep = np.flatnonzero((norm > 0) & np.isfinite(norm))  # a zero vector has no cosine: no pairs
            keep = keep[np.argsort(ids[keep], kind="stable")]
            x, norm = x[keep], norm[keep]
            sides.append((ids[keep], x, norm, (x / norm[:, None]).astype(np.float32)))
        del rows
        (ida, A, na, ua), (idb, B, nb, ub) = sides[0], sides[-1]
        if not len(ida) or not len(idb):
            return
        limit = np.nextafter(np.float32(threshold - _slack(A.shape[1])), np.float32(-np.inf))
        held, n_held = [], 0
        for rows, cols, rr, cc in _screened(ua, ub, limit, a == b):
            # screened in single precision, what may pass is scored in double precision
            if a == b:  # each pair once
                later = ida[rows][rr] < idb[cols][cc]
                rr, cc = rr[later], cc[later]
            if 24 * len(rr) > len(ida[rows]) * len(idb[cols]):  # many are left: one product is cheaper
                dots = (A[rows] @ B[cols].T)[rr, cc]
            else:
                dots = _dots(A[rows], B[cols], rr, cc)
            rr, cc = rows.start + rr, cols.start + cc
            v = dots / (na[rr] * nb[cc])
            keep = v > threshold
            held.append((ida[rr[keep]], idb[cc[keep]], v[keep]))
            n_held += len(held[-1][2])
            if n_held >= min(PAIR_BATCH, SCREEN_CELLS):
                yield from pair_batches(*map(np.concatenate, zip(*held)))
                held, n_held = [], 0
        if n_held:
            yield from pair_batches(*map(np.concatenate, zip(*held)))

    return run


def pair_batches(x: np.ndarray, y: np.ndarray, r: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(mid, sim_mid, r) of the pairs, both directions."""
    x, y = x.astype(np.int32), y.astype(np.int32)
    for at in range(0, len(r), PAIR_BATCH):
        p, q, v = (pa.array(z[at:at + PAIR_BATCH]) for z in (x, y, r))
        yield pa.RecordBatch.from_arrays([p, q, v], ["mid", "sim_mid", "r"])
        yield pa.RecordBatch.from_arrays([q, p, v], ["mid", "sim_mid", "r"])


def similar_pairs(factors: DataFrame, threshold: float, *, stripe_rows: int = DEFAULT_STRIPE_ROWS,
                  n_rows: int | None = None) -> DataFrame:
    """(mid, sim_mid, r): all ordered pairs of distinct ids whose cosine
    exceeds ``threshold`` (both directions, no self pairs)."""
    spark = factors.sparkSession
    n = n_rows if n_rows is not None else factors.count()
    want = spark.sparkContext.defaultParallelism
    s = n_stripes(n, stripe_rows, max(1, int(math.sqrt(2 * want))))
    f = factors.select(F.col("id").cast("int").alias("id"), "features") \
        .where("id is not null and features is not null").withColumn("_s", stripe_of("id", s))
    # stripe a meets every stripe b >= a once: first copies go to (a, b>=a),
    # second copies to (a<b, b)
    first = F.transform(F.sequence(F.col("_s"), F.lit(s - 1)), lambda t: F.struct((F.col("_s") * s + t).alias("tile"), F.lit(False).alias("second")))
    second = F.transform(F.filter(F.sequence(F.lit(0), F.col("_s")), lambda t: t < F.col("_s")),
                         lambda t: F.struct((t * s + F.col("_s")).alias("tile"), F.lit(True).alias("second")))
    copies = f.withColumn("_c", F.explode(F.concat(first, second))).select("_c.tile", "_c.second", "id", "features")
    # one task a tile, as in top_n_products; those below the diagonal are empty
    return copies.repartitionById(s * s, "tile").groupBy("tile").applyInArrow(_similar_kernel(float(threshold), s), PAIRS)


#: Items up to which a task of ``similar_pairs_by_item`` holds them all: 512 MB of 64
#: features in single precision, as given and as unit vectors.
WHOLE_ITEMS = 1 << 20
#: Pairs of one block of items that are put in order at once, about.
ORDERED_PAIRS = 1 << 20


def _items_of(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(own, id, features, norm, unit vector) by ascending id, of vectors that have a
    cosine; the features keep the precision that they are stored in."""
    parts = []
    for batch in batches:
        flat = batch.column("features")
        x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 0), np.float32)
        wide = x.astype(np.float64)
        norm = np.sqrt((wide * wide).sum(axis=1))
        keep = np.flatnonzero((norm > 0) & np.isfinite(norm))
        if len(keep):
            parts.append((batch.column("own").to_numpy(zero_copy_only=False)[keep], batch.column("id").to_numpy()[keep], x[keep], norm[keep],
                          (wide[keep] / norm[keep, None]).astype(np.float32)))
    if not parts:
        return np.zeros(0, bool), np.zeros(0, np.int32), np.zeros((0, 1)), np.zeros(0), np.zeros((0, 1), np.float32)
    by = np.argsort(np.concatenate([p[1] for p in parts]), kind="stable")
    columns = [list(c) for c in zip(*parts)]
    del parts
    out = []
    while columns:  # one column at a time is there twice
        out.append(np.concatenate(columns.pop(0))[by])
    return tuple(out)


def _by_item_kernel(threshold: float):
    """The pairs of a stripe's items with all items, item by item, most similar
    first (ties: lower id)."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids, x, norm, unit = _items_of(batches)
        mine = np.flatnonzero(own)
        if not len(mine):
            return
        limit = np.nextafter(np.float32(threshold - _slack(x.shape[1])), np.float32(-np.inf))
        first = np.flatnonzero(np.append(True, np.diff(ids[mine]) != 0))  # rows of one id stay together
        ends = np.append(first[1:], len(mine))
        at, width = 0, 64
        while at < len(first):
            to = min(at + width, len(first))
            rows = mine[first[at]:ends[to - 1]]
            item = np.repeat(np.arange(to - at), (ends - first)[at:to])
            held = []
            for some, cols, rr, cc in _screened(unit[rows], unit, limit, False):
                rr, cc = some.start + rr, cols.start + cc
                other = ids[rows[rr]] != ids[cc]
                rr, cc = rr[other], cc[other]
                v = _dots(x, x, rows[rr], cc) / (norm[rows[rr]] * norm[cc])
                keep = v > threshold
                held.append((item[rr[keep]], ids[cc[keep]], v[keep]))
            n = sum(len(h[2]) for h in held)
            if n:
                yield from _in_order(ids[mine[first[at:to]]], *map(np.concatenate, zip(*held)))
            at, width = to, min(256, max(1, width * ORDERED_PAIRS // max(n, 1)))

    return run


def _in_order(ids: np.ndarray, item: np.ndarray, sim: np.ndarray, r: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(mid, sim_mid, r) of the pairs, by item, then falling r, then ``sim_mid``."""
    by = np.argsort(item.astype(np.int16), kind="stable")
    item, sim, r = item[by], sim[by], r[by]
    start = np.searchsorted(item, np.arange(len(ids) + 1))
    for a, b in zip(start[:-1], start[1:]):
        order = np.lexsort((sim[a:b], -r[a:b]))
        sim[a:b], r[a:b] = sim[a:b][order], r[a:b][order]
    mid = ids[item].astype(np.int32)
    sim = sim.astype(np.int32)
    for at in range(0, len(r), PAIR_BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(z[at:at + PAIR_BATCH]) for z in (mid, sim, r)], ["mid", "sim_mid", "r"])


def similar_pairs_by_item(factors: DataFrame, threshold: float, *, stripe_rows: int = DEFAULT_STRIPE_ROWS,
                          n_rows: int | None = None) -> DataFrame:
    """The rows of ``similar_pairs``, all of an item next to each other in one
    partition, most similar first (ties: lower sim_mid), items by ascending mid
    within a stripe. Each product is taken twice, once for either item, but only
    items are shuffled, a copy for each stripe. Over ``WHOLE_ITEMS`` items, which a task
    does not hold, the pairs are shuffled and sorted instead."""
    n = n_rows if n_rows is not None else factors.count()
    if n > WHOLE_ITEMS:
        return similar_pairs(factors, threshold, stripe_rows=stripe_rows, n_rows=n) \
            .repartition("mid").sortWithinPartitions("mid", F.desc("r"), "sim_mid")
    s = n_stripes(n, stripe_rows, 2 * factors.sparkSession.sparkContext.defaultParallelism)
    f = factors.select(F.col("id").cast("int").alias("id"), "features") \
        .where("id is not null and features is not null").withColumn("_s", stripe_of("id", s))
    copies = f.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(s - 1)))) \
        .select("tile", (F.col("_s") == F.col("tile")).alias("own"), "id", "features")
    return copies.repartitionById(s, "tile").groupBy("tile").applyInArrow(_by_item_kernel(float(threshold)), PAIRS)
