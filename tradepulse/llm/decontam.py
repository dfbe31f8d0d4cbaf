"""Benchmark decontamination: rare seeds join documents to items, Smith-Waterman alignment scores the pairs."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches, landed, map_rows

WORDS = re.compile(r"\w+")
#: Bytes of item texts whose words and texts go to the documents at once, and seeds of an item beyond those
#: that edits can break.
ITEM_BYTES, SPARE = 16 << 20, 6
#: Candidate documents, some eighty bytes each, that every executor may hold; with more of them texts are shuffled.
BROADCAST_CANDIDATES = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def align(item: list[str], words: list[str]) -> tuple[int, int, int]:
    """Best local alignment score of the item's words in the words, with its span there (end excluded).

    Rows are items' words. Gaps in the text are a running maximum along the row, so each row is
    a few array operations.
    """
    codes = {w: i for i, w in enumerate(dict.fromkeys(item))}
    text = np.array([codes.get(w, -1) for w in words], np.int64)
    n = len(text)
    column = np.arange(n + 1, dtype=np.int64)
    score, start = np.zeros(n + 1, np.int64), column.copy()
    best = (0, 0, 0)
    for w in item:
        diagonal = np.concatenate([[0], score[:-1] + np.where(text == codes[w], MATCH, MISMATCH)])
        upper = score + GAP
        came = np.concatenate([[0], start[:-1]])
        now = np.maximum(diagonal, upper)
        began = np.where(diagonal >= upper, came, start)
        fresh = now <= 0
        now[fresh] = 0
        began[fresh] = column[fresh]
        # a gap of g words costs g: the best cell to the left is the running maximum of score + position
        lifted = now - GAP * column
        top = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == top, column, 0))
        along = top + GAP * column
        better = along > now
        score, start = np.where(better, along, now), np.where(better, began[origin], began)
        i = int(score.argmax())
        if score[i] > best[0]:
            best = (int(score[i]), int(start[i]), i)
    return best


class Index:
    """A block of items: their words as codes, their word pairs, and where in a text one of them can stand.

    Seeds are pairs of words, those next to each other in an item; in a text also pairs with one word between
    count, so that an inserted word breaks none. An edit that breaks two pairs costs 3 of the score (a word
    replaced or left out), one that breaks one costs 2 (a word cut off at an end, two words put in). A text that reaches ``least``
    of the greatest score has lost ``2 n (1 - least)`` of it at most, so no more than two thirds of that in pairs are broken.
    Items too short for this have their words as seeds.
    """

    def __init__(self, items: list[tuple[int, int, str]], least: float):
        self.least, self.codes = least, {}
        self.items = [(key, i, words) for key, i, words in ((key, i, words_of(text)) for key, i, text in items) if words]
        self.place = {key: k for k, (key, *_) in enumerate(self.items)}
        self.words = [np.array([self.codes.setdefault(w, len(self.codes)) for w in words], np.int64) for *_, words in self.items]
        self.goal = [MATCH * len(words) * least - 1e-9 for *_, words in self.items]
        # the last place stands for words that no item has
        self.gain = np.full(len(self.codes) + 1, MISMATCH, np.int64)
        seeds = [self.seeds(k) for k in range(len(self.items))]
        self.known = np.unique(np.concatenate([np.array(list(counts), np.int64) for counts, _ in seeds] or [np.zeros(0, np.int64)]))
        size = len(self.codes)
        self.single = np.zeros(size + 1, bool)
        self.single[self.known[self.known >= size * size] - size * size] = True

    def seeds(self, k: int) -> tuple[Counter, int]:
        """Seeds of item ``k`` with their numbers, and how many of them edits can break."""
        words, size = self.words[k], len(self.codes)
        broken = int(2 * (MATCH * len(words) - self.goal[k]) // 3)
        if len(words) - 1 > broken:
            return Counter((words[:-1] * size + words[1:]).tolist()), broken
        return Counter((size * size + words).tolist()), len(words) - int(np.ceil(self.goal[k] / MATCH))

    def text(self, words: list[str]) -> np.ndarray:
        get = self.codes.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def met(self, text: np.ndarray) -> np.ndarray:
        """Distinct seeds of any item that a text holds."""
        size, found = len(self.codes), []
        for apart in (1, 2):
            a, b = text[:-apart], text[apart:]
            both = (a >= 0) & (b >= 0)
            found.append(a[both] * size + b[both])
        found.append(size * size + text[self.single[text]])
        grams = np.unique(np.concatenate(found))
        at = np.searchsorted(self.known, grams)
        return grams[(at < len(self.known)) & (self.known[np.minimum(at, len(self.known) - 1)] == grams)] if len(self.known) else grams[:0]

    def stretches(self, k: int, text: np.ndarray) -> list[tuple[int, int]]:
        """Stretches that can hold an alignment of the item with its goal: a word brings 2 if the item has it, else costs 1."""
        self.gain[self.words[k]] = MATCH
        total = np.concatenate([[0], np.cumsum(self.gain[text])])
        self.gain[self.words[k]] = MISMATCH
        # the best sum of a stretch around each word
        most = np.maximum.accumulate(total[:0:-1])[::-1] - np.minimum.accumulate(total[:-1])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], most >= self.goal[k], [0]])))
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def blocks(items: DataFrame, longest: int) -> Iterator[list[tuple[int, int, str]]]:
    """``(key, id, text)`` in blocks of about so many bytes, each distinct row once."""
    items = landed(items.distinct().select(F.xxhash64("id", "text").alias("key"), "id", "text"), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // longest + 1
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod("key", F.lit(n)) == k).collect()]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``(id, item, score, first_word, last_word)``: items of which a document holds an exact or edited copy.

    The score is the best Smith-Waterman alignment of words over that of a whole copy; ``least``
    or more is reported, with the span in the document's words. Seeds are an item's rarest word pairs, by the
    number of documents that hold them: as many as edits can break (``Index``) and SPARE more. Documents
    and items are joined on them, and pairs with at least SPARE seeds in common are aligned. Whichever pairs
    the edits break, enough of any choice of that many remain, so each document that scores ``least`` is aligned,
    whatever other documents hold; how rare a seed is only tells how much is aligned in vain.

    Rows without an id or with a text without words match nothing. Rows that share an id are
    aligned each, and the best is kept. Each block of ITEM_BYTES of items is one pass over the documents; only the
    seeds found leave it, and the texts of candidates.
    """
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    spark = docs.sparkSession

    def against(block: list[tuple[int, int, str]]) -> DataFrame:
        kept = spark.sparkContext.broadcast(Index(block, least))
        keys = spark.createDataFrame([(key,) for key, *_ in block], "key bigint")

        def own_seeds(part: dict) -> dict:
            index, out = kept.value, {c: [] for c in ("item", "gram", "times", "broken")}
            for key in part["key"]:
                if key in index.place:
                    counts, broken = index.seeds(index.place[key])
                    for gram, times in counts.items():
                        for c, v in zip(out, (key, gram, times, broken)):
                            out[c].append(v)
            return out

        def met(batches: Batches) -> Batches:
            index = kept.value
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    batch = whole.slice(at, 1000)
                    found = [index.met(index.text(words_of(t.as_py()))) for t in batch.column(2)]
                    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                    grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), grams], ["id", "key", "grams"])

        keyed = docs.select("id", F.xxhash64("text").alias("key"), "text")
        hits = landed(keyed.mapInArrow(met, "id bigint, key bigint, grams array<bigint>").where("size(grams) > 0")
                      .select("id", "key", F.explode("grams").alias("gram")), "seeds-met")
        seeds = map_rows(keys, own_seeds, "item bigint, gram bigint, times bigint, broken bigint")
        seeds = seeds.join(hits.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left").na.fill(0, ["n"])
        rarest = Window.partitionBy("item").orderBy("n", "gram")
        seeds = seeds.withColumn("upto", F.sum("times").over(rarest.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        seeds = seeds.where(F.col("upto") - F.col("times") < F.col("broken") + SPARE)
        chosen = landed(seeds.withColumn("need", F.max("upto").over(Window.partitionBy("item")) - F.col("broken")), "seeds")
        pairs = (hits.join(chosen.where("n > 0").select("gram", "item", "times", "need"), "gram").groupBy("id", "key", "item")
                 .agg(F.sum("times").alias("hits"), F.max("need").alias("need")).where("hits >= need"))
        wanted = landed(pairs.groupBy("id", "key").agg(F.collect_set("item").alias("items")), "candidates")

        def judge(part: dict) -> dict:
            index, out = kept.value, {c: [] for c in ("id", "item", "score", "first_word", "last_word")}
            for i, text, some in zip(part["id"], part["text"], part["items"]):
                words = words_of(text)
                codes = index.text(words)
                for key in some:
                    k = index.place[key]
                    _, item, item_words = index.items[k]
                    best = (0, 0, 0)
                    for a, b in index.stretches(k, codes):
                        score, x, y = align(item_words, words[a:b])
                        if score > best[0]:
                            best = (score, a + x, a + y)
                    score = best[0] / (MATCH * len(item_words))
                    if score >= least:
                        for c, v in zip(out, (i, item, score, best[1], best[2])):
                            out[c].append(v)
            return out

        if wanted.count() <= BROADCAST_CANDIDATES:
            wanted = F.broadcast(wanted)
        candidates = keyed.join(wanted, ["id", "key"]).select("id", "text", "items")
        return landed(map_rows(candidates, judge, "id bigint, item bigint, score double, first_word bigint, last_word bigint"), "leaks")

    found = reduce(DataFrame.unionAll, map(against, blocks(items, ITEM_BYTES)))
    best = F.max_by(F.struct("first_word", "last_word"), F.struct("score", -F.col("first_word"))).alias("at")
    return found.groupBy("id", "item").agg(F.max("score").alias("score"), best).select("id", "item", "score", "at.first_word", "at.last_word")
