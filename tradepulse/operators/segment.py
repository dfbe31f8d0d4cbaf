"""Word segmentation of letter runs: a word list mined from the texts, and the best path through it.

Texts without spaces between words, or with words run together, need a word list. Here it comes from the texts
themselves: a stretch of letters is a word if it is frequent and holds together, that is if its
halves meet far more often than chance would have them meet.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradepulse import functions as fx
from tradepulse.session import landed

# Executors get the path search with the plan and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: letters of the longest word, least count of a word, least cohesion of its halves, and the unit of costs
LONGEST, LEAST, COHESION, UNIT = 6, 5, 4.0, 1000
#: letters of the runs that are cut by one task at a time, and of the frequent runs that are broadcast
GROUP, OFTEN = 1 << 19, 1 << 21


def letter_runs(texts: DataFrame, text: str = "text") -> DataFrame:
    """``run, n``: the distinct letter runs of the texts, lower-cased, and how often each comes."""
    return texts.select(F.explode(fx.tokens(text)).alias("run")).groupBy("run").agg(F.count("*").alias("n"))


def _tails(run: str, longest: int) -> Column:
    """Up to ``longest`` letters from each place of a run on, a row a place: the stretches from there are its beginnings."""
    return F.transform(F.sequence(F.lit(1), F.char_length(run)), lambda at: F.substr(run, at, F.lit(longest)))


def _beginnings(tails: DataFrame) -> DataFrame:
    """``word`` in the place of ``tail``: a row for each of its beginnings."""
    rest = [c for c in tails.columns if c != "tail"]
    sizes = tails.select("*", F.explode(F.sequence(F.lit(1), F.char_length("tail"))).alias("_size"))
    return sizes.select(*rest, F.substr("tail", F.lit(1), F.col("_size")).alias("word"))


def mine_words(runs: DataFrame, longest: int = LONGEST, least: int = LEAST, cohesion: float = COHESION) -> DataFrame:
    """``word, n, cost`` from ``run, n``: single letters, and stretches that come ``least`` times and hold together.

    A stretch holds together if, wherever it is cut in two, it comes ``cohesion`` times as often as its halves would
    meet by chance. The cost of a word is the negative logarithm of its share of all letters.
    Only distinct stretches are counted and joined, whatever the number of texts. The planner takes rows made of others to be
    as many as those, so the joins are told not to broadcast them.
    """
    tails = runs.select(F.explode(_tails("run", longest)).alias("tail"), "n").groupBy("tail").agg(F.sum("n").alias("n"))
    grams = landed(_beginnings(tails).groupBy("word").agg(F.sum("n").alias("n")), "stretches")
    letters = runs.agg(F.sum(F.col("n") * F.char_length("run"))).first()[0] or 0
    frequent = grams.where((F.char_length("word") > 1) & (F.col("n") >= least))
    cuts = frequent.select("word", "n", F.explode(F.sequence(F.lit(1), F.char_length("word") - 1)).alias("at"))
    halves = cuts.select("word", "n", F.substr("word", F.lit(1), F.col("at")).alias("a"), F.substr("word", F.col("at") + 1).alias("b"))
    counts = lambda side: grams.select(F.col("word").alias(side), F.col("n").alias(f"n_{side}")).hint("merge")
    chance = halves.join(counts("a"), "a").join(counts("b"), "b")
    loosest = chance.groupBy("word", "n").agg(F.max(F.col("n_a").cast("double") * F.col("n_b")).alias("chance"))
    held = loosest.where(F.col("n") * F.lit(float(letters)) >= cohesion * F.col("chance")).select("word", "n")
    words = held.unionByName(grams.where(F.char_length("word") == 1))
    return words.withColumn("cost", F.round(F.log(F.lit(float(letters)) / F.col("n")) * UNIT).cast("bigint"))


def best_cuts(size: int, edges: list[tuple[int, int, int]]) -> list[int]:
    """Where the words of the cheapest path end. ``edges`` are ``(start, end, cost)`` of known words.

    Of equally cheap paths the one with fewer words, then the one with the longer last word.
    """
    best: list[tuple[int, int, int] | None] = [None] * (size + 1)
    best[0] = (0, 0, 0)
    for start, end, cost in sorted(edges, key=lambda e: (e[1], e[0])):
        if best[start] is not None:
            now = best[start][0] + cost, best[start][1] + 1, start
            if best[end] is None or now < best[end]:
                best[end] = now
    ends, at = [], size
    while at:
        ends.append(at)
        at = best[at][2]
    return ends[::-1]


def _cheapest(run: str, costs: dict[str, int], longest: int) -> list[str]:
    """The words of :func:`best_cuts` for a run of any length; ``costs`` have the cost of a word above its 32 lowest bits, which count words."""
    best, back = [0], [0]
    for end in range(1, len(run) + 1):
        least, since = None, 0
        for start in range(max(0, end - longest), end):
            cost = costs.get(run[start:end])
            if cost is not None and (least is None or best[start] + cost < least):
                least, since = best[start] + cost, start
        best.append(least)
        back.append(since)
    words, at = [], len(run)
    while at:
        words.append(run[back[at]:at])
        at = back[at]
    return words[::-1]


def segment_runs(runs: DataFrame, words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``words`` beside the columns of ``runs``: each distinct run cut into words of the list by the cheapest path.

    Runs are dealt out in groups of some ``GROUP`` letters. A group is sent its distinct stretches that are in the list, found
    by a join on their text, so the list may be of any size and no stretch moves twice for a group; the path is worked
    out once a distinct run. Each letter must be a word, as in a list mined from these runs.
    """
    total = runs.agg(F.sum(F.char_length("run").cast("bigint"))).first()[0] or 0
    dealt = runs.withColumn("_group", F.pmod(F.xxhash64("run"), F.lit(-(-total // GROUP) or 1)))
    # dealt out by group once: neither the distinct stretches nor the runs move again for it
    tails = dealt.select("_group", "run").repartition("_group").select(F.col("_group").alias("_of"), F.explode(_tails("run", longest)).alias("tail"))
    stretches = _beginnings(tails.distinct()).distinct()
    known = stretches.join(words.select("word", "cost").hint("merge"), "word")
    out = to_arrow_schema(T.StructType([*runs.schema.fields, T.StructField("words", T.ArrayType(T.StringType()))]))

    def cut(mine: pa.Table, list_: pa.Table) -> pa.Table:
        costs = {w: c << 32 | 1 for w, c in zip(list_.column("word").to_pylist(), list_.column("cost").to_pylist())}
        found = [_cheapest(run, costs, longest) for run in mine.column("run").to_pylist()]
        return pa.table([*(mine.column(f.name).combine_chunks() for f in out if f.name != "words"), pa.array(found, pa.list_(pa.string()))], schema=out)

    both = dealt.groupBy("_group").cogroup(known.groupBy("_of"))
    return both.applyInArrow(cut, T.StructType([*runs.schema.fields, T.StructField("words", T.ArrayType(T.StringType()))]))


def _often(runs: DataFrame, letters: int) -> int:
    """The least power of two such that all runs that come as often have at most so many ``letters``, 32 more counted for each."""
    size = F.char_length("run").cast("bigint") + 32
    powers = runs.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.sum(size).alias("size")).collect()
    often, rest = 1 + max((r.p for r in powers), default=0), letters
    for r in sorted(powers, reverse=True):
        rest -= r["size"]
        if rest < 0:
            break
        often = r.p
    return 1 << often


def segmented_keywords(texts: DataFrame, id_col: str, text: str = "text", often_letters: int = OFTEN, **limits) -> DataFrame:
    """``id, keyword, n``: how often each word of the mined list comes in a text, by best-path segmentation.

    The runs that come most often, up to ``often_letters`` of them, are broadcast; the others meet their words by a shuffle, in
    which none of them is a hot key.
    """
    runs = landed(letter_runs(texts, text), "runs")
    cut = landed(segment_runs(runs, mine_words(runs, **limits), limits.get("longest", LONGEST)), "cut")
    often = F.col("n") >= _often(runs, often_letters)
    few = F.broadcast(cut.where(often).select("run", "words"))
    own = texts.select(F.col(id_col), F.explode(fx.tokens(text)).alias("run"))
    met = own.join(few, "run", "left")
    other = own.join(few, "run", "left_anti").join(cut.where(~often).select("run", "words").hint("merge"), "run")
    pieces = met.where("words is not null").unionByName(other).select(id_col, F.explode("words").alias("keyword"))
    return pieces.groupBy(id_col, "keyword").agg(F.count("*").alias("n"))
