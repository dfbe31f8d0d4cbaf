"""SimHash near-dedup: exact comparison of fingerprints in tiles, with tile pairs skipped by population count."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.components import connected_components
from tradepulse.llm.shared import Batches, landed

SEED = 42
#: fingerprints are cut in four 16-bit parts, whose population counts name a tile
PARTS, PART_BITS = 4, 16
TILE = 4096


def shingle_bits(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes set each of the 64 bits (lowest first), and how many shingles there are."""
    if not words:
        return np.zeros(64, np.int64), 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, 1 << 16):
        end = min(n, at + (1 << 16))
        part = words[at:end + width - 1]
        spans = zip(*(part[i:] for i in range(width))) if len(words) >= width else [words]
        h = np.array([digest(join(s), SEED) for s in spans], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return ones, n


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """SimHash as a signed 64-bit integer; texts without a word have zero."""
    ones, n = shingle_bits((text or b"").lower().split(), width)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id, fp)`` for every row, null ids and null texts included."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, fp bigint")


def part_counts(fp: Column) -> list[Column]:
    mask = (1 << PART_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, PART_BITS * i).bitwiseAND(F.lit(mask))) for i in range(PARTS)]


def tile_key(counts: list[Column]) -> Column:
    key = F.lit(0)
    for c in counts:
        key = key * (PART_BITS + 1) + c
    return key.cast("int")


def near_offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts that two fingerprints within the radius can have, one of each pair of opposites."""
    near = [o for o in itertools.product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, o)) <= radius]
    return [o for o in near if o >= (0,) * PARTS]


def linked(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles, thinned to a forest with the same components.

    Round by round every fingerprint of either tile that still has a partner in another
    component keeps one such link, so no link between components is lost, and at most
    ``len(a) + len(b)`` remain.
    """
    near = np.empty((len(a), len(b)), bool)
    step = max(1, (1 << 17) // max(1, len(b)))
    for i in range(0, len(a), step):
        near[i:i + step] = np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius
    near &= a[:, None] != b[None, :]
    us, vs = [], []
    label: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while label.get(root, root) != root:
            root = label[root]
        while label.get(x, x) != root:
            label[x], x = root, label[x]
        return root

    while near.any():
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        pairs = [*zip(rows.tolist(), near[rows].argmax(axis=1).tolist()), *zip(near[:, cols].argmax(axis=0).tolist(), cols.tolist())]
        for r, c in pairs:
            x, y = find(int(a[r])), find(int(b[c]))
            if x != y:
                label[max(x, y)] = min(x, y)
                us.append(r)
                vs.append(c)
        la = np.array([find(int(x)) for x in a], np.uint64)
        lb = np.array([find(int(x)) for x in b], np.uint64)
        near &= la[:, None] != lb[None, :]
    return a[us], b[vs]


def near_links(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints ``fp`` to ``(u, v)``: links whose components are those of all pairs within the radius.

    A tile holds fingerprints with the same four part counts. Two fingerprints within the
    radius differ by no more than it in the sum of their part counts, so only such tiles meet.
    Tiles beyond ``tile`` fingerprints are cut by hash into pieces that all meet each other.
    """
    keyed = fps.select("fp", tile_key(part_counts(F.col("fp"))).alias("key"))
    cuts = keyed.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts")).where("cuts > 1")
    tiles = (keyed.join(cuts, "key", "left")
             .groupBy("key", F.pmod(F.xxhash64("fp"), F.coalesce("cuts", F.lit(1))).alias("cut"))
             .agg(F.collect_list("fp").alias("fps")))
    tiles = landed(tiles, "tiles")
    base = PART_BITS + 1
    digits = [F.floor(F.col("key") / base ** (PARTS - 1 - i)) % base for i in range(PARTS)]
    offsets = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(o)]) for o in near_offsets(radius)])
    moved = tiles.select(*[d.alias(f"c{i}") for i, d in enumerate(digits)], F.col("cut").alias("cut_a"), F.col("key").alias("key_a"),
                         F.col("fps").alias("a"), F.explode(offsets).alias("o"))
    sums = [F.col(f"c{i}") + F.col(f"o.d{i}") for i in range(PARTS)]
    valid = F.lit(True)
    for s in sums:
        valid = valid & s.between(0, PART_BITS)
    left = moved.where(valid).select("key_a", "cut_a", "a", tile_key(sums).alias("key"))
    met = (left.join(tiles.withColumnRenamed("fps", "b"), "key")
           .where((F.col("key") != F.col("key_a")) | (F.col("cut_a") <= F.col("cut"))).select("a", "b"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            us, vs = [], []
            a, b = batch.column(0), batch.column(1)
            av, bv = (c.values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (a, b))
            ao, bo = a.offsets.to_numpy(), b.offsets.to_numpy()
            for i in range(batch.num_rows):
                u, v = linked(av[ao[i]:ao[i + 1]], bv[bo[i]:bo[i + 1]], radius)
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], ["u", "v"])

    return met.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 3, radius: int = 3) -> DataFrame:
    """``(id, fp, component)`` for every row; component is the smallest id reachable over links.

    Fingerprints link at ``radius`` or fewer differing bits, equal ones always. Empty and null
    texts share fingerprint zero and link like any other. Rows without an id get a component
    but never name one, unless no row of it has an id: then it is null. Only distinct
    fingerprints are compared, so copies cost one row each.
    """
    prints = landed(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = landed(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(near_links(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select("fp", "component")
    return prints.join(named, "fp").select("id", "fp", "component")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
