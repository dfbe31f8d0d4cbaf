"""Mined words and best paths beside brute force."""

import math
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tradepulse.operators import segment
from tradepulse.session import landed


def paths(size, edges):
    """All ways to cover the run, as lists of ends with their cost."""
    def walk(at, cost, ends):
        if at == size:
            yield cost, ends
        for start, end, c in edges:
            if start == at:
                yield from walk(end, cost + c, [*ends, end])

    return list(walk(0, 0, []))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.randoms(use_true_random=False))
def test_best_path_like_all_paths(size, pick):
    edges = [(i, i + 1, pick.randint(1, 9)) for i in range(size)]
    edges += [(i, j, pick.randint(1, 12)) for i in range(size) for j in range(i + 2, min(size, i + 4) + 1) if pick.random() < 0.5]
    pick.shuffle(edges)
    every = paths(size, edges)
    least = min((c, len(e)) for c, e in every)
    same = [e for c, e in every if (c, len(e)) == least]
    # of equals the one with the longer last word, then the longer one before it, and so on
    want = min(same, key=lambda e: [0 if len(e) < k + 2 else e[-k - 2] for k in range(len(e))])
    assert segment.best_cuts(size, edges) == want


def mined_by_hand(runs, longest, least, cohesion):
    grams, letters = Counter(), sum(n * len(r) for r, n in runs.items())
    for run, n in runs.items():
        for i in range(len(run)):
            for size in range(1, min(longest, len(run) - i) + 1):
                grams[run[i:i + size]] += n
    out = {}
    for word, n in grams.items():
        chance = max((grams[word[:i]] * grams[word[i:]] for i in range(1, len(word))), default=0)
        if len(word) == 1 or n >= least and n * letters >= cohesion * chance:
            out[word] = round(math.log(letters / n) * segment.UNIT)
    return out


def test_words_run_together_are_found(spark):
    pick = random.Random(2)
    words = ["red", "shoe", "blue", "hat", "größe", "鞋子", "红"]
    texts = ["".join(pick.choices(words, k=3)) + " " + pick.choice(words) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate([*texts, "redshoehat", None, "", "123 !"])), "id bigint, text string")
    runs = {r.run: r.n for r in segment.letter_runs(df).collect()}
    assert runs == Counter(w for t in [*texts, "redshoehat"] for w in t.split())
    known = {r.word: r.cost for r in segment.mine_words(segment.letter_runs(df)).collect()}
    want = mined_by_hand(runs, segment.LONGEST, segment.LEAST, segment.COHESION)
    assert known.keys() == want.keys() and all(abs(known[w] - want[w]) <= 1 for w in want)
    got = {(r.id, r.keyword): r.n for r in segment.segmented_keywords(df, "id").collect()}
    for i, text in [*enumerate(texts), (len(texts), "redshoehat")]:
        want_words = Counter()
        for run in text.split():
            ends = segment.best_cuts(len(run), [(a, b, known[run[a:b]]) for a in range(len(run)) for b in range(a + 1, min(len(run), a + segment.LONGEST) + 1) if run[a:b] in known])
            want_words.update(run[a:b] for a, b in zip([0, *ends], ends))
        assert {k: n for (j, k), n in got.items() if j == i} == want_words
    assert {k for (i, k) in got if i == len(texts)} == {"red", "shoe", "hat"}
    assert not [k for (i, k) in got if i > len(texts)]


def test_segments_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    assert segment.segmented_keywords(df, "id").count() == 0


def test_rows_made_of_runs_are_not_broadcast(spark):
    """The planner takes the stretches of runs to be as few as the runs; sent to the driver they would fill it."""
    runs = landed(spark.createDataFrame([("redshoe", 7), ("red", 9), ("shoe", 8)], "run string, n bigint"), "runs")
    words = segment.mine_words(runs)
    for rows in (words, segment.segment_runs(runs, words)):
        assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()


def test_frequent_and_rare_runs_meet_the_same_words(spark):
    texts = [*["red shoe redshoe hat"] * 9, *["hatred shoehat"] * 3, "bluehat", "the" * 40, "größe"]
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 7, t) for i, t in enumerate(texts)], "id bigint, text string")
    got = [sorted(map(str, segment.segmented_keywords(df, "id", often_letters=n).collect())) for n in (0, 200, 1 << 20)]
    assert got[0] == got[1] == got[2] and got[0]
