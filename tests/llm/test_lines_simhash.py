"""Line dedup and SimHash beside brute force, with the odd rows both must bear."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents
from tradepulse.llm import components, linededup, simhash

SHARED = "This very line stands in many documents"
ODD = [
    (1, f"{SHARED}\nfirst own line\n\n"), (2, f"  {SHARED.upper()}\t\nsecond\n{SHARED}"), (3, f"{SHARED}"), (4, f"a\r\n{SHARED}\r\nb"),
    (5, None), (6, ""), (7, "short\nshort"), (8, "short"), (9, "short"), (3, f"{SHARED}"), (3, "third has two rows"),
    (None, SHARED), (None, None), (10, "\n".join(["Ünïcode lïne, löng enough İ"] * 3)), (11, "ünïcode lïne, löng enough İ"),
    (12, "ÜNÏCODE lïne, löng enough İ"), (13, "exactly twenty chars"), (14, "exactly twenty chars"), (15, "exactly twenty chars"),
    (16, "only nineteen chars"), (17, "only nineteen chars"), (18, "only nineteen chars"), (20, "word " * 200_000 + "\n" + SHARED),
]


def brute_lines(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got_lines(df):
    return sorted((tuple(r) for r in linededup.dedupe_lines(df).select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def test_lines_like_brute_force(spark):
    assert got_lines(documents(spark, *ODD)) == brute_lines(ODD)


def test_lines_random(spark):
    r = random.Random(3)
    pool = [" ".join(r.choices("alpha Beta gamma DELTA".split(), k=5)) for _ in range(30)]
    rows = [(i, "\n".join(r.choices(pool, k=r.randrange(0, 9)))) for i in range(120)]
    assert got_lines(documents(spark, *rows)) == brute_lines(rows)


def test_lines_keep_columns_and_bear_clashes(spark):
    out = linededup.dedupe_lines(clashing(documents(spark, (1, "a"), (2, None))))
    assert {"lang", "fp", "gone", "row"} <= set(out.columns) and out.columns.count("kept") == 1
    assert {r.doc_id: (r.kept, r.gone) for r in out.collect()} == {1: ("a", "x"), 2: ("", "x")}


def test_lines_of_nothing(spark):
    assert linededup.dedupe_lines(documents(spark)).count() == 0


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(prints, radius):
    at = list(range(len(prints)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= radius:
                x, y = find(i), find(j)
                at[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def near_rows():
    r = random.Random(5)
    base = [r.choices("one two three four five six seven eight nine ten".split(), k=120) for _ in range(8)]
    rows = [(100 + i, " ".join(base[i % 8][:100 + i // 8])) for i in range(60)]
    return rows + [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "É é"), (None, "one"), (None, "alone here"),
                   (4, "One"), (8, "word " * 100_000)]


def test_simhash_like_brute_force(spark):
    rows = near_rows()
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints, 3)
    groups = defaultdict(list)
    for (i, _), c in zip(rows, root):
        groups[c].append(i)
    want = sorted((str((i, f"{p:016x}", min((x for x in groups[c] if x is not None), default=None))) for (i, _), p, c in zip(rows, prints, root)))
    out = simhash.near_duplicates(clashing(documents(spark, *rows)))
    got = sorted(str(tuple(r)) for r in out.select("id", simhash.hex_fingerprint(F.col("fp")), "component").collect())
    assert got == want
    assert len(set(root)) < len(rows) - 8


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(documents(spark)).count() == 0


def chain(n, seed=1):
    """Fingerprints in which each is two bits from the next, so only links over the chain join them."""
    r, now, out = random.Random(seed), 0, []
    for i in range(n):
        out.append(now)
        now ^= 1 << (2 * i % 64) | 1 << ((2 * i + 1) % 64) if i < 32 else 1 << r.randrange(64) | 1 << r.randrange(64)
    return out


@pytest.mark.parametrize("tile", [3, 4096])
def test_tiles_lose_no_component(spark, tile):
    r = random.Random(9)
    seeds = [r.getrandbits(64) for _ in range(25)]
    prints = {s ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 4))) for s in seeds for _ in range(12)} | set(chain(60))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), 3, tile)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    got = defaultdict(set)
    for s in signed:
        got[roots.get(s, s)].add(s)
    want = defaultdict(set)
    for s, c in zip(signed, brute_components(prints, 3)):
        want[c].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_hot_group_keeps_links_few(spark):
    """A thousand fingerprints within the radius of each other: links stay in proportion to them."""
    center = 0x0123456789ABCDEF
    prints = [center ^ (1 << a) ^ (1 << b if b != a else 0) for a in range(32) for b in range(32)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), 3)
    assert links.count() < 70 * len(signed)
    assert len({r.root for r in components.connected_components(links).collect()}) == 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=12), st.lists(st.integers(0, 63), min_size=1, max_size=30))
def test_forest_has_the_components_of_all_pairs(bases, flips):
    prints = sorted({b ^ 1 << f for b in bases for f in flips} | set(bases))
    a = np.array(prints, np.uint64)
    u, v = simhash.linked(a, a, 3)
    at = {int(x): int(x) for x in a}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for x, y in zip(u.tolist(), v.tolist()):
        x, y = find(x), find(y)
        at[max(x, y)] = min(x, y)
    assert [find(int(x)) for x in a] == [prints[c] for c in brute_components(prints, 3)]
    assert len(u) < len(prints)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)], "u bigint, v bigint")
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert roots == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_kept_digest_of_query(spark, sf):
    from tradepulse.llm.queries import QUERIES

    rows = QUERIES["op3_line_dedup"](spark, sf).collect()
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    same = [r for r in rows if r.n_dropped == 0]
    assert same and all(r.kept_sha256 == hashlib.sha256((whole[r.doc_id] or "").encode()).hexdigest() for r in same)
