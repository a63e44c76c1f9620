"""Nearest neighbours by inner product: an inverted file scanned dimension by dimension.

Inner product becomes distance: with M the largest norm, x gets the extra component
sqrt(M^2 - |x|^2) and q gets 0, so |q - x|^2 = |q|^2 + M^2 - 2 <q, x>.  The extended
vectors are dealt into lists by k-means; a query probes its nearest lists.  In a list
the vectors are turned by a fixed random rotation and read in column blocks.  After d
of D columns the partial distance, scaled by D / d, estimates the whole; a candidate
is abandoned once it exceeds the query's bound by the factor (1 + eps / sqrt(d))^2 - a
test that fails a true neighbour with tiny probability.  The bound holds in all lists
of a query: its k-th best product within the sample below, which no answer is below.  A
query that still has many candidates in a list takes the list's own k-th best instead.
Blocks are compared as matrices while many pairs live, pair by pair afterwards.
Survivors are compared by the exact inner product of the original vectors, in doubles.

The lists are fitted on a bounded sample (``sample_rows`` lowest id hashes; broadcast,
some 10 MB), every row is indexed.  The number of probed lists is the least that holds ``target`` of the
neighbours of sample queries within the sample.

Hot lists (a vector may hold a third of all rows) are split into segments of about
``segment_rows`` rows, their queries likewise, so no task holds a list of any size.

Edge cases: rows whose id is NULL or whose vector is NULL, zero, of another length than
most, or holds NULL or non-finite components take no part; rows with the query's own id
are not its candidates; ties go to the smaller id; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .labels import hashed_sample
from .util import bounded_batches, stored


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]


def _matrix(col, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lift(x: np.ndarray, top: float, query: bool = False) -> np.ndarray:
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(top * top - (x * x).sum(1), 0))
    return np.column_stack([x, extra])


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = _nearest(x, centres, 1)[:, 0]
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    out = np.empty((len(x), n), np.int32)
    for at in range(0, len(x), 4096):
        out[at:at + 4096] = np.argsort(_gaps(x[at:at + 4096], centres), axis=1, kind="stable")[:, :n]
    return out


def scan(q: np.ndarray, x: np.ndarray, tx: np.ndarray, ids: np.ndarray, own: np.ndarray, least: np.ndarray, k: int, top: float,
         turn: np.ndarray, block: int = 16, eps: float = 2.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, inner product) of the k best of x for each row of q.

    ``tx``: x extended and turned; ``least``: for each query a product that k candidates reach (or -inf)."""
    dim, tiny = turn.shape[0], 1e-9 * top * top
    tq = _lift(q, top, True) @ turn
    bound = (q * q).sum(1) + top * top - 2 * least + tiny
    alive = own[:, None] != ids[None]
    part, row, col = np.zeros(alive.shape), None, None
    for at in range(0, dim, block):
        to = min(at + block, dim)
        slack = to / dim * ((1 + eps / np.sqrt(to)) ** 2 if to < dim else 1 + 1e-9)
        if row is not None:                          # pair by pair
            part = part + ((tq[row, at:to] - tx[col, at:to]) ** 2).sum(1)
            keep = part <= bound[row] * slack + tiny
            row, col, part = row[keep], col[keep], part[keep]
            continue
        part += _gaps(tq[:, at:to], tx[:, at:to])
        alive &= part <= (bound * slack + tiny)[:, None]
        if at == 0:
            many = np.flatnonzero(alive.sum(1) > 8 * k)
            if len(many):                            # exact distances of the most promising
                seen = np.where(alive[many], part[many], np.inf)
                first = np.argpartition(seen, 2 * k - 1, axis=1)[:, :2 * k]
                exact = _lift_gaps(tq[many], tx, first)
                exact[~np.take_along_axis(alive[many], first, 1)] = np.inf
                bound[many] = np.minimum(bound[many], np.partition(exact, k - 1, axis=1)[:, k - 1] + tiny)
                alive[many] &= part[many] <= (bound[many] * slack + tiny)[:, None]
        if alive.mean() < 0.02:
            row, col = np.nonzero(alive)
            part = part[row, col]
    if row is None:
        row, col = np.nonzero(alive)
    score = np.einsum("ij,ij->i", q[row], x[col])
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    keep = nth < k
    return row[keep], ids[col[keep]], score[keep]


def _lift_gaps(tq: np.ndarray, tx: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Squared distances of each query to the rows of tx that ``of`` names for it."""
    return ((tq[:, None] - tx[of]) ** 2).sum(2)


def _reached(q: np.ndarray, own: np.ndarray, sample: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best product within the sample, -inf where that holds fewer candidates."""
    out = np.full(len(q), -np.inf)
    if len(sample) > k:
        for at in range(0, len(q), 256):
            score = q[at:at + 256] @ sample.T
            score[own[at:at + 256, None] == ids[None]] = -np.inf
            out[at:at + 256] = np.partition(score, len(sample) - k, axis=1)[:, len(sample) - k]
    return out


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           sample_rows: int = 20_000, max_lists: int = 1024, target: float = 0.97, segment_rows: int = 8192) -> DataFrame:
    """Neighbours of the rows where ``is_query`` (a column) holds: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("is_q"))
    good = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("v", lambda c: c != 0))
    sizes = good.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim, total = sizes["dim"], sizes["count"]
    good = good.where(F.size("v") == dim)
    top = float(good.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))).first()[0])
    top *= 1 + 1e-9
    some = hashed_sample(good, sample_rows, "id").select("v", "id").toArrow()
    sample = _matrix(some.column(0), dim)
    known = spark.sparkContext.broadcast((sample, some.column(1).to_numpy()))     # at most sample_rows vectors
    lifted = _lift(sample, top)
    centres = kmeans(lifted, int(max(1, min(max_lists, round(total ** 0.4), len(lifted)))))
    probes = _probes(sample, lifted, centres, k, top, target)

    def place(batches):
        for b in batches:
            x = _matrix(b.column(1), dim)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_nearest(_lift(x, top), centres, 1)[:, 0])], ["id", "v", "is_q", "list"])

    def choose(batches):
        for b in batches:
            x = _matrix(b.column(1), dim)
            near = _nearest(_lift(x, top, True), centres, probes)
            least = _reached(x, b.column(0).to_numpy(), *known.value, k)
            pick = np.repeat(np.arange(len(x)), probes)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(pick)), b.column(1).take(pa.array(pick)), pa.array(near.ravel()), pa.array(least[pick])],
                                             ["id", "v", "list", "least"])
    bounded_batches(spark)
    kind = vectors.schema[vector_col].dataType.simpleString()
    placed = stored(spark, good.mapInArrow(place, f"id long, v {kind}, is_q boolean, list int"), "lists")
    asked = placed.where("is_q").select("id", "v").mapInArrow(choose, f"id long, v {kind}, list int, least double")
    # a row a list: how many segments its vectors and its queries are split into
    held = placed.groupBy("list").agg(F.ceil(F.count("*") / segment_rows).alias("segs"))
    want = asked.groupBy("list").agg(F.ceil(F.count("*") / segment_rows).alias("q_segs"))
    plan = F.broadcast(stored(spark, held.join(want, "list"), "segments"))     # at most max_lists rows
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = placed.join(plan, "list").select("list", F.pmod(F.xxhash64("id"), "segs").alias("seg"), each("q_segs").alias("q_seg"), "id", "v")
    right = asked.join(plan, "list").select("list", each("segs").alias("seg"), F.pmod(F.xxhash64("id", F.lit(1)), "q_segs").alias("q_seg"), "id", "v", "least")
    turn = rotation(dim + 1)

    def compare(x_rows: pa.Table, q_rows: pa.Table) -> pa.Table:
        out = [[], [], []]
        if x_rows.num_rows and q_rows.num_rows:
            x, q = _matrix(x_rows["v"], dim), _matrix(q_rows["v"], dim)
            ids, own, least = x_rows["id"].to_numpy(), q_rows["id"].to_numpy(), q_rows["least"].to_numpy()
            tx = _lift(x, top) @ turn
            for at in range(0, len(q), 256):
                row, near, score = scan(q[at:at + 256], x, tx, ids, own[at:at + 256], least[at:at + 256], k, top, turn)
                for o, v in zip(out, (own[at:at + 256][row], near, score)):
                    o.append(v)
        cat = [np.concatenate(o) if o else np.empty(0) for o in out]
        return pa.table({"query_id": pa.array(cat[0].astype(np.int64)), "vec_id": pa.array(cat[1].astype(np.int64)), "score": pa.array(cat[2].astype(float))})
    keys = ["list", "seg", "q_seg"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _probes(sample: np.ndarray, lifted: np.ndarray, centres: np.ndarray, k: int, top: float, target: float, queries: int = 256) -> int:
    """The least number of lists that hold ``target`` of the sample queries' neighbours in the sample."""
    q = sample[:queries]
    score = q @ sample.T
    score[np.arange(len(q)), np.arange(len(q))] = -np.inf
    near = np.argsort(-score, axis=1, kind="stable")[:, :min(k, max(1, len(sample) - 1))]
    home = _nearest(lifted, centres, 1)[:, 0]
    order = _nearest(_lift(q, top, True), centres, len(centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres), dtype=order.dtype)[None].repeat(len(q), 0), 1)
    ranks = np.sort(np.take_along_axis(place, home[near], 1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]) + 1
