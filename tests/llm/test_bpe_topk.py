"""BPE beside the public library; top-k beside brute force."""

import random
import sys

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import clashing, documents
from tradepulse.llm import bpe, topk

PATH = public_tokenizers.path("byte_bpe_50k.json")
BPE = bpe.ByteBpe(open(PATH, encoding="utf-8").read())
PUBLIC = Tokenizer.from_file(PATH)
TEXTS = [
    None, "", " ", "  ", "\n", "a", "Hello, world! It's 42.", "don't we'll I'd x's 's 't", "  two  spaces   and\t\ttabs \n\n lines  ",
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "Grüße, façade, naïve, ñandú", "日本語のテキスト", "🙂🙃 é ‍", "x\x1cy\x1dz\x85w v u　t",
    "a" * 3000, "ab" * 3000, "1234567890" * 50, "!?" * 500, "word " * 5000, "İǅⅠ½²³ ١٢", "\x00\x01\x7f�",
]


def public(text):
    ids = PUBLIC.encode(text or "", add_special_tokens=False).ids
    return ids, PUBLIC.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_like_public_library(text):
    ids, decoded = public(text)
    assert BPE.encode(text or "").tolist() == ids
    assert BPE.decode(ids) == decoded


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs", "Cn", "Co"], max_codepoint=0x2FFF), st.sampled_from(" \n\t'stredlvmaeiouth<|>")), max_size=60))
def test_like_public_library_on_any_text(text):
    ids, decoded = public(text)
    assert BPE.encode(text).tolist() == ids
    assert BPE.decode(ids) == decoded == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=0, max_size=40), st.dictionaries(st.tuples(st.integers(0, 9), st.integers(0, 9)), st.integers(0, 3), max_size=30))
def test_tree_is_leftmost_lowest_rank(ids, ranks):
    pairs = {a << 20 | b: (r, 6 + (a + b) % 4) for (a, b), r in ranks.items()}
    now = list(ids)
    while True:
        found = [(pairs[now[i] << 20 | now[i + 1]][0], i) for i in range(len(now) - 1) if now[i] << 20 | now[i + 1] in pairs]
        if not found or len(ids) - len(now) > 60:
            break
        i = min(found)[1]
        now[i:i + 2] = [pairs[now[i] << 20 | now[i + 1]][1]]
    assert bpe.merge_all(list(ids), pairs) == now


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeinrstdlhéß日"), min_size=1, max_size=80))
def test_node_and_tree_agree(word):
    ids = [BPE.first[b] for b in word.encode()]
    side_by_side = BPE.merge_words([b"x", word.encode(), b"the"])
    assert bpe.merge_all(ids, BPE.pairs) == np.frombuffer(side_by_side[1], np.int32).tolist() == public(word)[0]


def instructions(call):
    """Python instructions that a call executes."""
    count, before = 0, sys.gettrace()

    def trace(frame, event, arg):
        nonlocal count
        frame.f_trace_opcodes = True
        count += event == "opcode"
        return trace

    sys.settrace(trace)
    try:
        call()
    finally:
        sys.settrace(before)
    return count


def test_new_words_take_few_instructions():
    pick = random.Random(5)
    words = {"".join(pick.choices("aeinrstdlhéß", k=pick.randint(6, 14))) for _ in range(2000)}
    text, fresh = " ".join(sorted(words)), bpe.ByteBpe(open(PATH, encoding="utf-8").read())
    steps = instructions(lambda: fresh.encode(text))
    assert steps < 30 * len(text), steps / len(text)
    assert fresh.encode(text).tolist() == public(text)[0]


def test_memory_keeps_what_is_met():
    memory, found = bpe.Memory(4), {}
    for word in "abacadaeafag":
        for w in memory.recall({word}, found):
            memory.put(w, w.encode())
        assert len(memory) <= 4 and not memory.recall({"a"}, {})
    assert memory.recall(set("bcg"), {}) == {"b", "c"} and found["a"] == b"a"


def test_texts_together_like_one_by_one(monkeypatch):
    texts = [t or "" for t in TEXTS] * 2
    want = [public(t)[0] for t in texts]
    for together in (1, 50, bpe.TOGETHER):
        monkeypatch.setattr(bpe, "TOGETHER", together)
        assert [c.tolist() for c in BPE.encode_all(texts)] == want
    assert BPE.encode_all([]) == []


def test_operator_on_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (6, "same id"), (6, "same id")]
    got = bpe.encode_decode(clashing(documents(spark, *rows)), PATH).collect()
    want = sorted(str((i, *public(t))) for i, t in rows)
    assert sorted(str((r.id, r.ids, r.decoded)) for r in got) == want
    assert bpe.encode_decode(documents(spark), PATH).count() == 0


def test_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_MEMORY", 3)
    monkeypatch.setattr(bpe, "RUN_MEMORY", 2)
    small = bpe.ByteBpe(open(PATH, encoding="utf-8").read())
    text = "many different words stand here and there, many different words"
    assert small.encode(text).tolist() == public(text)[0]
    assert len(small.known_words) <= 3 and len(small.known_runs) <= 2


def brute_top(queries, rows, k):
    whole = [(i, tuple(int(np.floor(64 * float(x))) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({r for r in whole if r[0] in queries}):
        found = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in whole if (i, v) != q and len(v) == len(q[1]))
        out += [(q[0], n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def run_top(spark, rows, queries, k):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    out = topk.top_k(clashing(df.where(df.vec_id.isin(list(queries)) if queries else "false")), clashing(df), k)
    return sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())


def test_top_k_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    r = np.random.RandomState(4)
    rows = [(i, [float(x) for x in r.randn(8).astype(np.float32)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a hot vector: ties far beyond k
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 6), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, [1.0] * 8),
             (2004, [1.0, 2.0]), (2005, [2.0, 1.0]), (2006, []), (3, rows[3][1]), (5, [9.0] * 8), (2007, [-0.0] * 8), (2008, [3e30] * 8), (2009, [-3e30] * 8)]
    queries = {0, 3, 5, 7, 1005, 2000, 2004, 2006, 2007}
    got = run_top(spark, rows, queries, 20)
    cut = lambda s: max(-topk.MOST, min(topk.MOST, s))
    want = [(q, n, i, cut(s)) for q, n, i, s in brute_top(queries, rows, 20)]
    assert got == sorted(want)


def test_top_k_of_few_and_none(spark):
    assert run_top(spark, [(0, [1.0]), (1, [2.0])], {0, 1}, 20) == [(0, 1, 1, 64 * 128), (1, 1, 0, 64 * 128)]
    assert run_top(spark, [(0, [1.0])], {0}, 20) == []
    assert run_top(spark, [(0, [1.0]), (1, [1.0])], set(), 20) == []
    assert run_top(spark, [], set(), 20) == []


def test_rows_that_share_an_id(spark):
    """All rows but the query's own are candidates, whatever their ids."""
    rows = [(0, [1.0]), (1, [0.5]), (1, [0.9]), (0, [0.7]), (2, [0.1]), (2, [0.1])]
    got = run_top(spark, rows, {0}, 3)
    assert got == sorted(brute_top({0}, rows, 3)) and (0, 1, 1, 64 * 57) in got and (0, 2, 0, 64 * 44) in got


def test_great_scores_are_not_ties(spark):
    rows = [(0, [2.0 ** 26]), (1, [2.0 ** 24]), (2, [2.0 ** 24 + 2])]
    assert [r[2:] for r in run_top(spark, rows, {0}, 2)] == [(2, 2 ** 62 + 2 ** 39), (1, 2 ** 62)]


def test_random_ties(spark):
    r = random.Random(8)
    rows = [(i, [r.choice([-0.5, 0.0, 0.5]) for _ in range(3)]) for i in range(120)]
    assert run_top(spark, rows, set(range(0, 120, 10)), 7) == sorted(brute_top(set(range(0, 120, 10)), rows, 7))
