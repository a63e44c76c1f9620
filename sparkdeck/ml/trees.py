"""Histogram boosting of many models over one shared binned matrix (L-14 to L-16, R-01 to R-05).

The matrix.  Every feature is binned once (quantile edges; bin 0 holds NULL and NaN, so a row with a missing
value is trained on and scored like any other).  Rows with equal bins, class and sampling fold become one *cell* with their
number and sums of the response: one Spark aggregate, and all that boosting needs, since a prediction depends on bins alone.
Row sampling draws folds (64 hash classes of the rows) for each tree, column sampling draws features for each node.

Growing.  A level of a tree needs, for each open node, feature and bin, the number of rows and the sums of gradients.

* While the cells are few (``few_cells``, counted first) they are broadcast and every model of the list is grown by a task of its own.
* Beyond that, cells stay a Spark table in blocks; one aggregate over (model, node, feature, bin) grows a level of
  all models, and a round's new scores are stored with the blocks (checkpointed every few rounds).

Gradients are integers of a fixed scale, so sums do not depend on their order: both ways, any partitioning and any
repetition of a lost task give the same trees.  An ensemble is a few flat arrays; scoring it is one Arrow pass whatever
the number of trees.  Split gains are kept, so every ensemble has its variable importance.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

FOLDS = 64


@dataclass(frozen=True)
class Spec:
    """The parameters of one model."""
    ntrees: int = 100
    max_depth: int = 5
    learn_rate: float = 0.1
    sample_rate: float = 1.0
    col_sample_rate: float = 1.0
    min_rows: int = 1
    seed: int = 1


@dataclass
class Tree:
    """Nodes as parallel lists: split feature (-1 in a leaf), last bin that goes left, left child (the right one follows), step, gain."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    step: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def down(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """One step of each row towards its leaf."""
        f = np.array(self.feature)[node]
        right = bins[np.arange(len(node)), np.maximum(f, 0)] > np.array(self.cut)[node]
        return np.where(f >= 0, np.array(self.left)[node] + right, node)

    def leaf(self, bins: np.ndarray, depth: int) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            node = self.down(bins, node)
        return node


def bin_edges(df: DataFrame, xs: Sequence[str], bins: int) -> list[list[float]]:
    """Quantile edges of each feature: a value's bin is 1 + the number of edges below it."""
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double")), probs, 10_000).alias(f"e{i}")
                   for i, x in enumerate(xs)]).first()
    return [sorted(set(e)) if e else [] for e in row]


def bin_values(columns: list[np.ndarray], edges: list[list[float]]) -> np.ndarray:
    out = np.zeros((len(columns[0]) if columns else 0, len(edges)), np.uint8)
    for j, (x, e) in enumerate(zip(columns, edges)):
        x = np.asarray(x, np.float64)
        out[:, j] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(e, np.float64), x, side="left"))
    return out


def cells(df: DataFrame, xs: Sequence[str], y: Column, cls: Column, edges: list[list[float]], scale: float) -> DataFrame:
    """(key, fold, cls, n, s, ss): rows with equal bins, with the sums of the scaled response and of its square."""
    rows = df.select(*[F.col(x).cast("double").alias(f"_x{j}") for j, x in enumerate(xs)], y.cast("double").alias("_y"), cls.cast("int").alias("_c"))
    rows = rows.withColumn("_f", F.pmod(F.xxhash64(*rows.columns), F.lit(FOLDS)).cast("int"))
    d = len(xs)

    def run(batches):
        for b in batches:
            keys = bin_values([b.column(j).to_numpy(zero_copy_only=False) for j in range(d)], edges)
            yield pa.RecordBatch.from_arrays([pa.FixedSizeBinaryArray.from_buffers(pa.binary(d), len(keys), [None, pa.py_buffer(keys.tobytes())])
                                              .cast(pa.binary()), b.column(d), b.column(d + 1), b.column(d + 2)], ["key", "y", "cls", "fold"])
    # from the shuffle on, a cell is one row
    return rows.mapInArrow(run, "key binary, y double, cls int, fold int").groupBy("key", "fold", "cls").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("y") * scale).cast("long")).alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss"))


@dataclass
class Matrix:
    """Cells as arrays."""
    bins: np.ndarray
    fold: np.ndarray
    cls: np.ndarray
    n: np.ndarray
    s: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, d: int) -> Matrix:
        keys = b"".join(table.column("key").to_pylist())
        pick = lambda c: table.column(c).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(c).to_numpy()
        return cls(np.frombuffer(keys, np.uint8).reshape(-1, d), pick("fold"), pick("cls"), pick("n"), pick("s"))


class Loss:
    """Gradients of the cells in fixed-point integers; ``k`` scores a row (one for a number, one a class)."""

    def __init__(self, k: int, scale: float, start: list[float]):
        self.k, self.scale, self.start = k, scale, start

    def begin(self, m: Matrix) -> np.ndarray:
        if self.k == 1:
            return np.full((len(m.n), 1), round(self.start[0] * self.scale), np.int64)
        return np.tile(np.array(self.start, np.float64), (len(m.n), 1))

    def shares(self, score: np.ndarray) -> np.ndarray:
        """What the gradients of all classes are made of: a number's score, or the classes' probabilities."""
        if self.k == 1:
            return score
        e = np.exp(score - score.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, m: Matrix, share: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
        if self.k == 1:
            return m.s - m.n * share[:, 0], m.n
        r = (m.cls == c) - share[:, c]
        a = np.abs(r)
        return m.n * np.rint(r * self.scale).astype(np.int64), m.n * np.rint(a * (1 - a) * self.scale).astype(np.int64)

    def step(self, g: float, h: float, rate: float) -> float:
        """A leaf's addition to the score."""
        if self.k == 1:
            return float(round(rate * g / h)) if h else 0.0
        return rate * (self.k - 1) / self.k * g / h if h else 0.0

    def add(self, score: np.ndarray, c: int, tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
        score = score.copy()
        score[:, c] += np.array(tree.step)[tree.leaf(bins, depth)].astype(score.dtype)
        return score


def histogram(m: Matrix, node: np.ndarray, low: int, count: int, wide: int, g: np.ndarray, h: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """(open node, feature, bin, [rows, g, h]) of the sampled cells below the open nodes low, low + 1, ..."""
    use = np.flatnonzero(taken & (node >= low))
    d = m.bins.shape[1]
    out = np.zeros((count, d, wide, 3))
    at = (node[use] - low) * wide
    bins = np.ascontiguousarray(m.bins[use].T)
    sums = [v[use].astype(np.float64) for v in (m.n, g, h)]
    for j in range(d):
        where = at + bins[j]
        for i, v in enumerate(sums):       # integers below 2^53: exact in any order
            out[:, j, :, i] = np.bincount(where, v, count * wide).reshape(count, wide)
    return out


def folds_of(spec: Spec, t: int, c: int) -> np.ndarray:
    """The folds that tree t of class c is grown on."""
    many = max(1, round(spec.sample_rate * FOLDS))
    taken = np.zeros(FOLDS, bool)
    taken[np.random.default_rng((spec.seed, t, c, 1)).choice(FOLDS, many, replace=False)] = True
    return taken


def extend(tree: Tree, low: int, hist: np.ndarray, spec: Spec, loss: Loss, t: int, c: int, level: int) -> None:
    """Split the open nodes low, low + 1, ... of ``tree`` by their histograms; new children are open."""
    count, d, wide, _ = hist.shape
    left = hist.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    if not level:
        tree.step[0] = loss.step(whole[0, 0, 0, 1], whole[0, 0, 0, 2], spec.learn_rate)
    rng = np.random.default_rng((spec.seed, t, c, 2, level))
    many = max(1, round(spec.col_sample_rate * d))
    order = rng.random((count, d)).argsort(axis=1).argsort(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - whole[..., 1] ** 2 / whole[..., 0]
    bad = (left[..., 0] < spec.min_rows) | (right[..., 0] < spec.min_rows) | (left[..., 0] == 0) | (right[..., 0] == 0) | (order >= many)[:, :, None]
    gain = np.where(bad, -1.0, gain).reshape(count, -1)
    best = gain.argmax(axis=1)
    unit = loss.scale * loss.scale
    for k in range(count):
        got = gain[k, best[k]]
        if got <= 1e-9 * max(1.0, unit) or not math.isfinite(got):
            continue
        f, b = divmod(int(best[k]), wide)
        node = low + k
        tree.feature[node], tree.cut[node], tree.left[node], tree.gain[node] = f, b, len(tree.feature), float(got / unit)
        for side in (left, right):
            for c_, v in zip((tree.feature, tree.cut, tree.left, tree.step, tree.gain),
                             (-1, 0, 0, loss.step(side[k, f, b, 1], side[k, f, b, 2], spec.learn_rate), 0.0)):
                c_.append(v)


def grow_in_task(m: Matrix, spec: Spec, loss: Loss, wide: int) -> list[list[Tree]]:
    """All rounds of one model over broadcast cells."""
    score, rounds = loss.begin(m), []
    for t in range(spec.ntrees):
        trees, share = [], loss.shares(score)
        for c in range(loss.k):
            g, h = loss.gradients(m, share, c)
            tree, node, low, taken = Tree(), np.zeros(len(m.n), np.int64), 0, folds_of(spec, t, c)[m.fold]
            for level in range(spec.max_depth):
                count = len(tree.feature) - low
                extend(tree, low, histogram(m, node, low, count, wide, g, h, taken), spec, loss, t, c, level)
                if len(tree.feature) == low + count:
                    break
                low, node = low + count, tree.down(m.bins, node)
            trees.append(tree)
        for c, tree in enumerate(trees):
            score = loss.add(score, c, tree, m.bins, spec.max_depth)
        rounds.append(trees)
    return rounds


def grow_by_level(table: DataFrame, d: int, specs: Sequence[Spec], loss: Loss, wide: int, block_cells: int, many: int, checkpoint_every: int = 10) -> list[list[list[Tree]]]:
    """All rounds of all models, a level of all trees by one aggregate over the blocks of ``many`` cells.

    Cells are few bytes for the work they make, so they are dealt to every core by number: by size, Spark would put them into one task."""
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    names = ["bins", "fold", "cls", "n", "s", "score"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(block_cells))

    def unpack(b, r) -> tuple[Matrix, np.ndarray]:
        v = [b.column(i)[r].as_py() for i in range(6)]
        m = Matrix(np.frombuffer(v[0], np.uint8).reshape(-1, d), *[np.frombuffer(x, np.int64) for x in v[1:5]])
        return m, np.frombuffer(v[5], np.int64 if loss.k == 1 else np.float64).reshape(len(specs), len(m.n), loss.k)

    def packed(m: Matrix, score) -> pa.RecordBatch:
        parts = [m.bins, *(np.asarray(x, np.int64) for x in (m.fold, m.cls, m.n, m.s)), score]
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts], names)

    def first(batches):
        for b in batches:
            if b.num_rows:
                m = Matrix.of(b, d)
                yield packed(m, np.stack([loss.begin(m)] * len(specs)))
    schema = ", ".join(f"{c} binary" for c in names)
    dealt = table.repartition(max(spark.sparkContext.defaultParallelism, -(-many // block_cells)), "key", "fold", "cls")
    data, old = dealt.mapInArrow(first, schema).persist(StorageLevel.MEMORY_AND_DISK), None
    out: list[list[list[Tree]]] = [[] for _ in specs]
    for t in range(max((s.ntrees for s in specs), default=0)):
        live = [i for i, s in enumerate(specs) if t < s.ntrees]
        trees = {(i, c): Tree() for i in live for c in range(loss.k)}
        low = dict.fromkeys(trees, 0)
        for level in range(max(specs[i].max_depth for i in live)):
            todo = {key: len(trees[key].feature) - low[key] for key in trees if level < specs[key[0]].max_depth and len(trees[key].feature) > low[key]}
            if not todo:
                break

            def count(batches, trees=trees, low=low, todo=todo, t=t, level=level):
                for b in batches:
                    for r in range(b.num_rows):
                        m, score = unpack(b, r)
                        share = {i: loss.shares(score[i]) for i in {i for i, _ in todo}}
                        for (i, c), n in todo.items():
                            hist = histogram(m, trees[i, c].leaf(m.bins, level), low[i, c], n, wide, *loss.gradients(m, share[i], c), folds_of(specs[i], t, c)[m.fold])
                            at = np.flatnonzero(hist[..., 0])
                            flat = hist.reshape(-1, 3)[at].astype(np.int64)
                            yield pa.RecordBatch.from_pydict({"slot": np.full(len(at), i * loss.k + c, np.int32), "at": at, "n": flat[:, 0], "g": flat[:, 1], "h": flat[:, 2]})
            # a row for each open node, feature and bin: model-sized
            got = data.mapInArrow(count, "slot int, at long, n long, g long, h long").groupBy("slot", "at") \
                .agg(F.sum("n"), F.sum("g"), F.sum("h")).toArrow()
            if old is not None:          # the level has stored this round's scores
                old.unpersist()
                old = None
            slot, at = got.column(0).to_numpy(), got.column(1).to_numpy()
            sums = np.stack([got.column(j).to_numpy() for j in (2, 3, 4)], axis=1).astype(np.float64)
            for (i, c), n in todo.items():
                hist = np.zeros((n * d * wide, 3))
                mine = slot == i * loss.k + c
                hist[at[mine]] = sums[mine]
                extend(trees[i, c], low[i, c], hist.reshape(n, d, wide, 3), specs[i], loss, t, c, level)
                low[i, c] += n

        def add(batches, trees=trees):
            for b in batches:
                for r in range(b.num_rows):
                    m, score = unpack(b, r)
                    score = score.copy()
                    for (i, c), tree in trees.items():
                        score[i] = loss.add(score[i], c, tree, m.bins, specs[i].max_depth)
                    yield packed(m, score)
        new = data.mapInArrow(add, schema)
        if (t + 1) % checkpoint_every == 0:
            new = new.checkpoint(eager=True)
        else:
            new = new.persist(StorageLevel.MEMORY_AND_DISK)
        if old is not None:
            old.unpersist()
        data, old = new, data
        for i in live:
            out[i].append([trees[i, c] for c in range(loss.k)])
    data.unpersist()
    if old is not None:
        old.unpersist()
    return out


@dataclass
class Ensemble:
    """All trees of a model as flat arrays; node numbers count on over the trees."""
    xs: list[str]
    edges: list[list[float]]
    start: list[float]
    labels: list[str] | None
    scale: float
    depth: int
    roots: np.ndarray           # (round, class)
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    step: np.ndarray
    gain: np.ndarray

    @classmethod
    def of(cls, xs, edges, loss: Loss, labels, depth: int, rounds: list[list[Tree]]) -> Ensemble:
        parts: list[list] = [[], [], [], [], []]
        roots, base = [], 0
        for trees in rounds:
            for tree in trees:
                roots.append(base)
                for p, v in zip(parts, (tree.feature, tree.cut, [base + x for x in tree.left], tree.step, tree.gain)):
                    p.extend(v)
                base += len(tree.feature)
        kinds = (np.int16, np.uint8, np.int64, np.float64, np.float64)
        scale = loss.scale if loss.k == 1 else 1.0
        return cls(list(xs), edges, loss.start, labels, scale, depth, np.array(roots, np.int64).reshape(len(rounds), loss.k),
                   *[np.array(p, k) for p, k in zip(parts, kinds)])

    def scores(self, bins: np.ndarray, every_round: bool = False):
        """Scores of binned rows (row, class), of each round where asked for."""
        rows = np.arange(len(bins))
        start = np.rint(np.array(self.start) * self.scale) if self.labels is None else np.array(self.start)
        score, seen = np.tile(start, (len(bins), 1)).astype(np.float64), []
        for roots in self.roots:
            for c, root in enumerate(roots.tolist()):
                node = np.full(len(bins), root, np.int64)
                for _ in range(self.depth):
                    f = self.feature[node]
                    node = np.where(f >= 0, self.left[node] + (bins[rows, np.maximum(f, 0)] > self.cut[node]), node)
                score[:, c] += self.step[node]
            if every_round:
                seen.append(score / self.scale)
        return seen if every_round else score / self.scale

    def column(self) -> Column:
        """array<double> of a row's scores: one Arrow pass over the features."""
        model = self

        @F.pandas_udf("array<double>")
        def scored(x: pd.DataFrame) -> pd.Series:
            bins = bin_values([x.iloc[:, j].to_numpy(np.float64, na_value=np.nan) for j in range(x.shape[1])], model.edges)
            return pd.Series(list(model.scores(bins)))
        return scored(F.struct(*[F.col(x).cast("double").alias(f"x{j}") for j, x in enumerate(self.xs)]))

    def importance(self, spark: SparkSession) -> DataFrame:
        """Split gains summed by feature, scaled to a maximum of 1, and as shares that add up to 1."""
        total = np.bincount(self.feature[self.feature >= 0], self.gain[self.feature >= 0], len(self.xs))
        top, whole = float(total.max(initial=0)) or 1.0, float(total.sum()) or 1.0
        rows = sorted(((x, float(v), float(v / top), float(v / whole)) for x, v in zip(self.xs, total)), key=lambda r: (-r[1], r[0]))
        return spark.createDataFrame(rows, "variable string, relative_importance double, scaled_importance double, percentage double")


def fit_boosters(train: DataFrame, y: str, xs: Sequence[str], specs: Sequence[Spec], labels: list[str] | None = None, bins: int = 32,
                 few_cells: int = 500_000, block_cells: int = 65_536) -> list[Ensemble]:
    """One ensemble a spec, all over one binned matrix.  With ``labels`` the response is a class, else a number; rows
    with a NULL response (or another class) are left out."""
    spark = train.sparkSession
    if bins > 254:
        raise ValueError("at most 254 bins")
    xs = list(xs)
    if labels is None:
        train = train.where(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")))
        target, cls = F.col(y).cast("double"), F.lit(0)
        n, most, mean = train.agg(F.count(F.lit(1)), F.max(F.abs(target)), F.avg(target)).first()
        # the sum of all absolute gradients stays below 2^52
        scale, start = 2.0 ** (50 - math.ceil(math.log2(max(2, n))) - math.ceil(math.log2(max(most or 0, 1e-30)))), [mean or 0.0]
    else:
        target = F.lit(0.0)
        cls = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(y).cast("string")) - 1
        train = train.where(F.col(y).cast("string").isin(labels))
        held = {r[0]: r[1] for r in train.groupBy(F.col(y).cast("string")).count().collect()}         # a row a label
        n = sum(held.values())
        scale = 2.0 ** (50 - math.ceil(math.log2(max(2, n))))
        start = [math.log(max(held.get(x, 0), 1) / max(1, n)) for x in labels]
    loss = Loss(1 if labels is None else len(labels), scale, start)
    edges = bin_edges(train, xs, bins)
    wide = max((len(e) for e in edges), default=0) + 2
    table = cells(train, xs, target, cls, edges, scale if labels is None else 1.0).select("key", "fold", "cls", "n", "s").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        depth = max((s.max_depth for s in specs), default=0)
        many = table.count()
        if many <= few_cells:
            # sorted: the same ensembles whatever the partitions
            sent = spark.sparkContext.broadcast(Matrix.of(table.sort("key", "fold", "cls").toArrow(), len(xs)))
            todo = list(specs)

            def grow(batches):
                for b in batches:
                    for i in b.column(0).to_pylist():
                        rounds = grow_in_task(sent.value, todo[i], loss, wide)
                        e = Ensemble.of(xs, edges, loss, labels, depth, rounds)
                        yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), **{c: [getattr(e, c).tobytes()] for c in _ARRAYS}})
            # the largest first; a model is a task
            order = sorted(range(len(todo)), key=lambda i: -todo[i].ntrees * todo[i].max_depth)
            asked = spark.createDataFrame([(i, p) for p, i in enumerate(order)], "i int, p int").repartitionByRange(max(1, len(todo)), "p").select("i")
            rows = asked.mapInArrow(grow, "i int, " + ", ".join(f"{c} binary" for c in _ARRAYS)).collect() if todo else []
            sent.destroy()
            kinds = dict(zip(_ARRAYS, (np.int64, np.int16, np.uint8, np.int64, np.float64, np.float64)))
            found = {r.i: Ensemble(xs, edges, loss.start, labels, scale if labels is None else 1.0, todo[r.i].max_depth, **{
                c: np.frombuffer(r[c], k) if c != "roots" else np.frombuffer(r[c], k).reshape(-1, loss.k) for c, k in kinds.items()}) for r in rows}
            return [found[i] for i in range(len(todo))]
        rounds = grow_by_level(table, len(xs), specs, loss, wide, block_cells, many)
        return [Ensemble.of(xs, edges, loss, labels, s.max_depth, r) for s, r in zip(specs, rounds)]
    finally:
        table.unpersist()


_ARRAYS = ("roots", "feature", "cut", "left", "step", "gain")


def squared_errors(df: DataFrame, y: str, models: Sequence[Ensemble]) -> list[float | None]:
    """The mean squared error of each model (all over the same bins) in one pass; None without rows."""
    if not models:
        return []
    one = models[0]
    use = df.where(F.col(y).isNotNull())
    table = cells(use, one.xs, F.col(y), F.lit(0), one.edges, one.scale)
    sent, d = df.sparkSession.sparkContext.broadcast(list(models)), len(one.xs)

    def run(batches):
        for b in batches:
            m, ss = Matrix.of(b, d), b.column("ss").to_numpy()
            for i, e in enumerate(sent.value):
                p = e.scores(m.bins)[:, 0]
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "n": [int(m.n.sum())], "se": [float((ss - 2 * p * (m.s / e.scale) + m.n * p * p).sum())]})
    got = table.mapInArrow(run, "i int, n long, se double").groupBy("i").agg(F.sum("n"), F.sum("se")).collect()      # a row a model
    found = {i: max(0.0, se) / n for i, n, se in got if n}
    return [found.get(i) for i in range(len(models))]
