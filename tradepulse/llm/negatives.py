"""Hard-negative mining: angles to reference directions bound inner products, integers decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches, landed
from tradepulse.llm.topk import MOST, quantised, scores

#: Vectors of a block of rows and of a block of anchors, rows of a strip (which has one label and one
#: interval of angles a reference direction), reference directions, anchors and strips scored at a time.
BLOCK_ROWS, ANCHOR_ROWS, STRIP_ROWS, REFERENCES, AT_A_TIME, ROUND = 4096, 4096, 128, 24, 256, 8
#: What angles and norms may be off by rounding; bounds are widened by it.
SLACK = 1e-7
LEAST = -MOST


def references(dim: int) -> np.ndarray:
    """Unit reference directions: the same for all tasks, whatever the data."""
    r = np.random.default_rng(dim).standard_normal((REFERENCES, max(dim, 1)))[:, :dim]
    return r / np.maximum(np.linalg.norm(r, axis=1, keepdims=True), 1e-300)


def angles(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and the angles to the reference directions; a vector of length zero has angle zero to all."""
    most = np.abs(x).max(axis=1, initial=0.0)
    unit = x / np.where(most > 0, most, 1.0)[:, None]
    length = np.linalg.norm(unit, axis=1)
    cos = unit @ references(x.shape[1]).T / np.where(length > 0, length, 1.0)[:, None]
    return length * most, np.arccos(np.clip(cos, -1, 1))


def score_bounds(norm: np.ndarray, angle: np.ndarray, norms: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with what a strip can hold.

    ``norm``, ``angle`` belong to the anchors, ``norms`` (least and greatest) and the intervals ``lows`` to
    ``highs`` of angles to the strips. By the triangle inequality the angle between two vectors
    lies between the difference and the sum of their angles to any third one; the interval of its cosine
    times the norms bounds the score. Widened by what rounding can do, bounds are safe.
    """
    nearest = np.maximum(np.maximum(lows[None] - angle[:, None], angle[:, None] - highs[None]), 0).max(axis=2)
    farthest = np.minimum(angle[:, None] + highs[None], 2 * np.pi - angle[:, None] - lows[None]).min(axis=2)
    high, low = np.cos(np.clip(nearest - SLACK, 0, np.pi)), np.cos(np.clip(farthest + SLACK, 0, np.pi))
    most, least = norm[:, None] * norms[None, :, 1], norm[:, None] * norms[None, :, 0]
    slack = 1 + most * SLACK
    return np.minimum(low * most, low * least) - slack, np.maximum(high * most, high * least) + slack


def _packed(rows: DataFrame, size: int, n_rows: int) -> DataFrame:
    """``(vec_id, label, dim, v)`` as blocks of one dimension, sorted by label and nearest reference."""
    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, labels, dims = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            values, ends = batch.column(3).values.to_numpy(), batch.column(3).offsets.to_numpy()
            for dim in np.unique(dims):
                of_dim = np.flatnonzero(dims == dim)
                for i in range(0, len(of_dim), size):
                    at = of_dim[i:i + size]
                    x = np.stack([values[ends[r]:ends[r + 1]] for r in at])
                    norm, angle = angles(x)
                    nearest = angle.argmin(axis=1) if len(at) else np.zeros(0, int)
                    order = np.lexsort((ids[at], angle[np.arange(len(at)), nearest], nearest, labels[at]))
                    at, x, norm, angle = at[order], x[order], norm[order], angle[order]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part << 32 | n], pa.int64()), pa.array([dim], pa.int32()), pa.array([ids[at]], pa.list_(pa.int64())),
                         pa.array([labels[at]], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
                         pa.array([norm.tobytes()], pa.binary()), pa.array([angle.tobytes()], pa.binary())],
                        ["block", "dim", "ids", "labels", "data", "norms", "angles"])
                    n += 1

    return rows.repartition(max(1, -(-n_rows // size))).mapInArrow(
        run, "block bigint, dim int, ids array<bigint>, labels array<bigint>, data binary, norms binary, angles binary")


class Side:
    """The vectors of one block."""

    def __init__(self, row: dict, prefix: str):
        self.ids, self.labels = (np.array(row[prefix + c], np.int64) for c in ("ids", "labels"))
        n = len(self.ids)
        self.x = np.frombuffer(row[prefix + "data"]).reshape(n, row["dim"])
        self.norm = np.frombuffer(row[prefix + "norms"])
        self.angle = np.frombuffer(row[prefix + "angles"]).reshape(n, -1)


class Strips:
    """Stretches of a block with one label, and the intervals of their norms and angles."""

    def __init__(self, side: Side):
        ends, n = [], len(side.ids)
        starts = [0, *(np.flatnonzero(np.diff(side.labels)) + 1), n]
        for a, b in zip(starts, starts[1:]):
            ends += [(int(i), int(min(i + STRIP_ROWS, b))) for i in range(a, b, STRIP_ROWS)]
        self.ends = ends
        self.labels = np.array([side.labels[a] for a, _ in ends])
        self.norms = np.array([(side.norm[a:b].min(), side.norm[a:b].max()) for a, b in ends]).reshape(-1, 2)
        self.lows = np.array([side.angle[a:b].min(axis=0) for a, b in ends])
        self.highs = np.array([side.angle[a:b].max(axis=0) for a, b in ends])


def _first(who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of each ``who``: highest score, then smallest id."""
    if score.dtype == object:
        order = np.array(sorted(range(len(who)), key=lambda i: (who[i], -score[i], ids[i])), int)
    else:
        order = np.lexsort((ids, -score, who))
    sorted_who = who[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_who, sorted_who) < k]


def _searched(anchors: Side, rows: Side, same_label: bool, wanted: list[list[tuple[int, int]]], k: int):
    """Best ``k`` rows of a block for each wanted window of each anchor: ``(anchor, window, row id, score)``.

    ``wanted[a]`` lists the windows ``(lowest, highest score)`` of anchor ``a``. Strips come in falling
    order of their greatest bound. They are scored only for anchors with a window that a strip's
    bounds overlap and in which its best could still be among the k found.
    """
    strips, windows = Strips(rows), max(map(len, wanted), default=0)
    for first in range(0, len(anchors.ids), AT_A_TIME):
        own = np.arange(first, min(first + AT_A_TIME, len(anchors.ids)))
        low, high = score_bounds(anchors.norm[own], anchors.angle[own], strips.norms, strips.lows, strips.highs)
        eligible = (anchors.labels[own][:, None] == strips.labels[None, :]) == same_label
        floor = np.full((len(own), windows), MOST, object)
        ceiling = np.full((len(own), windows), LEAST, object)
        for i, a in enumerate(own):
            for w, (lo, hi) in enumerate(wanted[a]):
                floor[i, w], ceiling[i, w] = lo, hi
        kept = [(np.zeros(0, int), None, np.zeros(0, np.int64)) for _ in range(windows)]
        order = np.argsort(-high.max(axis=0, initial=-np.inf), kind="stable")
        for at in range(0, len(order), ROUND):
            some_strips = order[at:at + ROUND]
            # one float outwards, so that ends beyond 2^53 lose nothing
            lo, hi = np.nextafter(floor.astype(float), -np.inf), np.nextafter(ceiling.astype(float), np.inf)
            meets = (high[:, some_strips, None] >= lo[:, None]) & (low[:, some_strips, None] <= hi[:, None])
            meets = meets.any(axis=2) & eligible[:, some_strips]
            some = np.flatnonzero(meets.any(axis=1))
            used = np.flatnonzero(meets.any(axis=0))
            if not len(some):
                continue
            spans = [strips.ends[s] for s in some_strips[used]]
            columns = np.concatenate([np.arange(a, b) for a, b in spans])
            open_to = np.repeat(meets[np.ix_(some, used)], [b - a for a, b in spans], axis=1)
            score = scores(anchors.x[own[some]], rows.x[columns])
            for i, j in zip(*np.nonzero(anchors.ids[own[some]][:, None] == rows.ids[columns][None, :])):
                a, r = own[some[i]], columns[j]
                if anchors.labels[a] == rows.labels[r] and (anchors.x[a] == rows.x[r]).all():
                    open_to[i, j] = False
            for w in range(windows):
                lo, hi = (e[some, w] if score.dtype == object else e[some, w].astype(float) for e in (floor, ceiling))
                i, j = np.nonzero(open_to & (score >= lo[:, None]) & (score <= hi[:, None]))
                if not len(i):
                    continue
                who, value, ids = kept[w]
                who, ids = np.concatenate([who, some[i]]), np.concatenate([ids, rows.ids[columns[j]]])
                new = score[i, j] if score.dtype == object else score[i, j].astype(np.int64)
                value = new if value is None else np.concatenate([value, new])
                best = _first(who, value, ids, k)
                kept[w] = who, value, ids = who[best], value[best], ids[best]
                # nothing below the kth counts any more; its equals may, by a smaller id
                full = np.flatnonzero(np.bincount(who, minlength=len(own)) == k)
                ends = np.searchsorted(who, full, side="right") - 1
                floor[full, w] = [int(v) for v in value[ends]]
        for w, (who, value, ids) in enumerate(kept):
            for n in range(len(who)):
                yield int(own[who[n]]), w, int(ids[n]), int(value[n])


def tenths(score: int) -> tuple[int, int]:
    """Least and greatest ``n`` with ``30 score <= 100 n <= 90 score``."""
    return -(-30 * score // 100), 90 * score // 100


def mine(anchors: DataFrame, rows: DataFrame, positives: int = 5, negatives: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Vectors become whole numbers ``floor(scale * x)``; a score is an inner product with the anchor. An
    anchor's positives are its ``positives`` highest other rows of its label, and for each the
    ``negatives`` highest rows of other labels with 0.3 to 0.9 of the positive's score follow, ranked from
    1; ties go to the smaller id. A negative positive score leaves no window, and a score of zero only scores of zero.

    Null ids, labels and vectors, and vectors with a null or non-finite component, take no part; only
    vectors of the same length meet. A row with the anchor's id, vector and label is the anchor itself,
    however often it comes; other rows with its id are others. Repeated rows count as often as they
    come. Scores are cut to the range of a bigint. Other columns are ignored. Empty tables give an empty result.

    Blocks of anchors meet blocks of rows on a grid of cells; of a cell no more than the best of each
    window leaves, so neither a label nor a vector that a third of all rows share is a hot key.
    """
    def prepared(frame: DataFrame) -> DataFrame:
        v = quantised(F.col(vector_col), scale)
        return (frame.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
                .where("v is not null").select("vec_id", "label", F.size("v").alias("dim"), "v"))

    def blocks(frame: DataFrame, size: int, label: str) -> DataFrame:
        ready = landed(prepared(frame), f"{label}-rows")
        return landed(_packed(ready, size, ready.count()), label)

    a, r = blocks(anchors.dropDuplicates([id_col, label_col, vector_col]), ANCHOR_ROWS, "anchors"), blocks(rows, BLOCK_ROWS, "rows")
    down, across = max(1, a.count()), max(1, r.count())

    named = lambda frame, p: frame.select("block", "dim", *[F.col(c).alias(p + c) for c in ("ids", "labels", "data", "norms", "angles")])
    number = lambda n: F.pmod(F.xxhash64("block"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    right = named(r, "r_").withColumn("across", number(across)).withColumn("down", every(down)).drop("block")

    def grid(left: DataFrame) -> DataFrame:
        left = left.withColumn("down", number(down)).withColumn("across", every(across))
        # the planner takes copies for cells to be as few as the blocks: neither side may be broadcast
        return left.join(right.hint("merge"), ["dim", "down", "across"]).drop("down", "across")

    def near(batches: Batches) -> Batches:
        everything = [(LEAST, MOST)]
        for batch in batches:
            for row in batch.to_pylist():
                left, other = Side(row, "a_"), Side(row, "r_")
                found = _searched(left, other, True, [everything] * len(left.ids), positives)
                yield _batch([(row["block"], i, near_id, s) for i, _, near_id, s in found], ["block", "pos", "positive_id", "positive_score"])

    best = Window.partitionBy("block", "pos").orderBy(F.col("positive_score").desc(), "positive_id")
    found = grid(named(a, "a_")).mapInArrow(near, "block bigint, pos bigint, positive_id bigint, positive_score bigint")
    chosen = landed(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives), "positives")

    per_anchor = chosen.groupBy("block", "pos").agg(F.array_sort(F.collect_list(F.struct("n", "positive_score"))).alias("p"))
    states = per_anchor.groupBy("block").agg(F.collect_list(F.struct("pos", F.col("p.positive_score").alias("p"))).alias("state"))

    def far(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                left, other = Side(row, "a_"), Side(row, "r_")
                windows = [[] for _ in left.ids]
                for known in row["state"]:
                    windows[known["pos"]] = [tenths(s) for s in known["p"]]
                found = _searched(left, other, False, windows, negatives)
                yield _batch([(row["block"], i, w + 1, far_id, s) for i, w, far_id, s in found],
                             ["block", "pos", "n", "negative_id", "negative_score"])

    hits = grid(named(a, "a_").join(states.hint("merge"), "block")).mapInArrow(
        far, "block bigint, pos bigint, n bigint, negative_id bigint, negative_score bigint")
    best = Window.partitionBy("block", "pos", "n").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    anchor_ids = a.select("block", F.posexplode("ids").alias("at", "anchor_id")).select("block", F.col("at").cast("long").alias("pos"), "anchor_id")
    return (ranked.join(chosen.hint("merge"), ["block", "pos", "n"]).join(anchor_ids.hint("merge"), ["block", "pos"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def moved_label(label: Column, vec_id: Column) -> Column:
    """The label, one further (of ten) where the id is divisible by 7."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
