"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches, landed

#: rows of a packed block, blocks of candidates that share a cell of the grid, queries scored at a
#: time, and bins of a query's histogram
BLOCK_ROWS, CELL_BLOCKS, STRIP_ROWS, BINS = 16384, 4, 512, 1024
MOST = 2 ** 63 - 1


def quantised(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` for every component, or null for a vector that takes no part."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    usable = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # from 2^52 on a double is whole already, and need not fit the bigint that floor gives
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x))
    return F.when(usable, whole)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as float32 or float64 where sums fit, else by Python integers cut to MOST."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0 ** 24:
        return q.astype(np.float32) @ c.astype(np.float32).T
    if most < 2.0 ** 53:
        return q @ c.T
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q) @ whole(c).T if q.shape[1] else np.zeros((len(q), len(c)), object)
    return np.clip(exact, -MOST, MOST)


def packed(rows: DataFrame, n_rows: int) -> DataFrame:
    """``(vec_id, dim, v)`` to blocks ``(block, dim, ids, data)`` of one dimension each."""
    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims, ids = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            values, ends = batch.column(2).values.to_numpy(), batch.column(2).offsets.to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for i in range(0, len(at), BLOCK_ROWS):
                    some = at[i:i + BLOCK_ROWS]
                    data = b"".join(values[ends[r]:ends[r + 1]].tobytes() for r in some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part << 32 | n], pa.int64()), pa.array([dim], pa.int32()),
                         pa.array([ids[some]], pa.list_(pa.int64())), pa.array([data], pa.binary())], ["block", "dim", "ids", "data"])
                    n += 1

    return rows.repartition(max(1, -(-n_rows // BLOCK_ROWS)), "vec_id").mapInArrow(
        run, "block bigint, dim int, ids array<bigint>, data binary")


def _strips(batch: pa.RecordBatch, span: int = 1):
    """The scores of a few queries at a time against a block of candidates, with the queries' state."""
    for row in batch.to_pylist():
        c_ids = np.array(row["c_ids"], np.int64)
        c = np.frombuffer(row["c_data"]).reshape(len(c_ids), row["dim"])
        order = np.argsort(c_ids, kind="stable")
        c, c_ids = c[order], c_ids[order]
        q = np.frombuffer(row["q_data"]).reshape(len(row["q_ids"]), row["dim"])
        for i in range(0, len(q), STRIP_ROWS):
            cut = slice(i, i + STRIP_ROWS)
            s = scores(q[cut], c)
            q_ids, lo = np.array(row["q_ids"][cut], np.int64), np.array(row["lo"][cut], object)
            if s.dtype == object or span + max(map(abs, row["lo"][cut]), default=0) >= 2 ** 52:
                # distances that no double holds are taken as Python integers
                s = np.vectorize(int, otypes=[object])(s)
            else:
                lo = lo.astype(np.int64)
            other = np.ones(s.shape, bool)
            for a, b in zip(*np.nonzero(q_ids[:, None] == c_ids[None, :])):
                other[a, b] = (q[i + a] != c[b]).any()
            places = row["block"], np.arange(i, i + len(q_ids))
            yield places, c_ids, s, lo, np.array(row["need"][cut], np.int64), other


def _histogram(span: int, width: int):
    """Counts of the bins of [lo, lo + span) per query; of one block only bins that can hold its own share of the k best."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for (block, places), _, s, lo, need, other in _strips(batch, span):
                at = (s - lo[:, None]) // width
                at = np.where(other & (s >= lo[:, None]) & (s < lo[:, None] + span), at, BINS).astype(np.int64)
                flat = (at + np.arange(len(places))[:, None] * (BINS + 1)).ravel()
                count = np.bincount(flat, minlength=len(places) * (BINS + 1)).reshape(len(places), -1)[:, :BINS]
                above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
                r, b = np.nonzero((count > 0) & (above < need[:, None]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), block)), pa.array(places[r]), pa.array(b.astype(np.int64)),
                                                  pa.array(count[r, b].astype(np.int64))], ["block", "pos", "bin", "n"])

    return run


def _select(batches: Batches) -> Batches:
    """Candidates above the kth score, and of those that equal it the smallest ids still needed."""
    for batch in batches:
        for (block, places), c_ids, s, kth, need, other in _strips(batch):
            equal = (s == kth[:, None]) & other
            equal &= np.cumsum(equal, axis=1) <= need[:, None]
            r, c = np.nonzero(((s > kth[:, None]) & other & (need > 0)[:, None]) | equal)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), block)), pa.array(places[r]), pa.array(c_ids[c]),
                                              pa.array([int(x) for x in s[r, c]], pa.int64())], ["block", "pos", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest inner products of each query, ties to the smaller id.

    Vectors are quantised to ``floor(scale * x)`` first. A candidate with the query's id and vector is
    the query itself, however often it comes, and no candidate of it; other rows with its id are candidates. Rows
    that repeat count as often as they come; a query that repeats is one, and an id with several
    vectors is a query for each. Null ids, null vectors and vectors with a null or non-finite
    component take no part; vectors of different dimension are not compared. Scores beyond a bigint
    stay at its bounds. Fewer than k candidates: all of them. Empty tables give an empty result.

    Each pass scores all blocks of queries against all blocks of candidates and sums one
    histogram per query; the bin that holds the kth score becomes the range of the next pass,
    until bins are one score wide. The last pass keeps what lies above the kth score and the
    smallest ids at it. Only counts and the final rows leave a tile, however many scores tie.
    """
    def prepared(rows: DataFrame) -> DataFrame:
        v = quantised(F.col(vector_col), scale)
        return (rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
                .where("v is not null").select("vec_id", F.size("v").alias("dim"), "v"))

    q, c = prepared(queries).distinct(), prepared(candidates)

    def measured(rows: DataFrame) -> tuple[int, float]:
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
        n, norm = rows.agg(F.count("*"), F.max(norm)).first()
        return n, norm or 0.0

    (n_q, norm_q), (n_c, norm_c) = measured(q), measured(c)
    qb = landed(packed(q, n_q), "queries")
    cb = landed(packed(c, n_c), "candidates")
    # By Cauchy and Schwarz no score is beyond the product of the greatest norms.
    bound = int(min(norm_q * norm_c * (1 + 1e-9) + 1, MOST))
    span = 2 * bound + 1
    width = -(-span // BINS)
    rows_of = qb.select("block", F.posexplode("ids").alias("at", "query_id")).select("block", F.col("at").cast("long").alias("pos"), "query_id")
    state = rows_of.select("block", "pos", F.lit(-bound).cast("long").alias("lo"), F.lit(k).cast("long").alias("need"))

    # Every block of candidates goes to every block of queries of its dimension, as the stated
    # query set asks. The cells of this grid are the join key, so no dimension is a hot key.
    down_cells, across = max(1, -(-n_q // BLOCK_ROWS)), max(1, -(-n_c // (BLOCK_ROWS * CELL_BLOCKS)))

    def cells(blocks: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        return blocks.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(own_n))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)).cast("array<bigint>")))

    right = cells(cb.select("block", "dim", F.col("ids").alias("c_ids"), F.col("data").alias("c_data")), "across", across, "down", down_cells).drop("block")

    def tiles(state: DataFrame) -> DataFrame:
        known = F.struct("pos", F.coalesce("lo", F.lit(0)).alias("lo"), F.coalesce("need", F.lit(0)).alias("need"))
        states = rows_of.join(state, ["block", "pos"], "left").groupBy("block").agg(F.array_sort(F.collect_list(known)).alias("s"))
        left = qb.join(states, "block").select("block", "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                                               F.col("s.lo").alias("lo"), F.col("s.need").alias("need"))
        left = cells(left, "down", down_cells, "across", across)
        return left.join(right, ["dim", "down", "across"]).drop("down", "across")

    while True:
        counts = tiles(state).mapInArrow(_histogram(span, width), "block bigint, pos bigint, bin bigint, n bigint")
        counts = counts.groupBy("block", "pos", "bin").agg(F.sum("n").alias("n"))
        downward = Window.partitionBy("block", "pos").orderBy(F.col("bin").desc())
        upto = counts.withColumn("upto", F.sum("n").over(downward))
        total = F.max("upto").over(Window.partitionBy("block", "pos"))
        cut = upto.withColumn("total", total).join(state, ["block", "pos"]).withColumn("want", F.least("need", "total"))
        cut = cut.where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
        # a bin's distance from the lowest score may be beyond a bigint, its place is not
        begin = (F.col("lo").cast("decimal(38,0)") + F.col("bin").cast("decimal(19,0)") * F.lit(width).cast("decimal(19,0)")).cast("long")
        state = landed(cut.select("block", "pos", begin.alias("lo"),
                                  (F.col("want") - (F.col("upto") - F.col("n"))).alias("need")), "state")
        if width == 1:
            break
        span, width = width, -(-width // BINS)
    found = tiles(state).mapInArrow(_select, "block bigint, pos bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("block", "pos").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(rows_of, ["block", "pos"]).select("query_id", "rank", "vec_id", "score")
