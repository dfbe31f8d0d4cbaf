"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches

#: Fixed by the byte-level vocabulary: how text is cut before merging, and what counts as white space.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
         rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The same cut, but runs without white space stay whole: these are remembered with their ids. It needs no
#: letter classes, so the faster ``re`` does it.
RUNS = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NONE = 1 << 62
#: Nodes below a node of the tree.
FAN = 32
#: Letters of the texts that are encoded at once, at least one text.
TOGETHER = 1 << 16
#: Entries of a process's memories of words and of runs of several words. Longer ones aren't kept.
WORD_MEMORY, RUN_MEMORY, LONGEST = 600_000, 300_000, 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


def merge_all(ids: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Merge the leftmost pair of lowest rank until none is left.

    Leaf ``i`` of the tree holds ``rank * n + i`` of the pair that starts at ``i``; a node of the next
    level holds the minimum of FAN nodes below, so the minimum of the last level is the next
    merge. A merge changes three leaves at most, and their nodes. Words of no more than FAN letters are
    trees of one node, which ``ByteBpe.merge_words`` works off side by side.
    """
    n = len(ids)
    if n < 2:
        return ids
    get = pairs.get
    leaves = [NONE] * n
    i, left = 0, ids[0]
    for right in ids[1:]:
        found = get(left << 20 | right)
        if found:
            leaves[i] = found[0] * n + i
        left = right
        i += 1
    levels = [leaves]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        levels.append([min(below[k:k + FAN]) for k in range(0, len(below), FAN)])
    root, deep = levels[-1], len(levels) > 1
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (least := min(root)) < NONE:
        i = least % n
        j = after[i]
        k = after[j]
        merged = ids[i] = get(ids[i] << 20 | ids[j])[1]
        ids[j] = -1
        leaves[j] = NONE
        after[i] = k
        h = before[i]
        if k < n:
            before[k] = i
            found = get(merged << 20 | ids[k])
            leaves[i] = found[0] * n + i if found else NONE
        else:
            leaves[i] = NONE
        if h >= 0:
            found = get(ids[h] << 20 | merged)
            leaves[h] = found[0] * n + h if found else NONE
        if deep:
            for at in (i, j, h) if h >= 0 else (i, j):
                for level, above in zip(levels, levels[1:]):
                    at //= FAN
                    above[at] = min(level[at * FAN:at * FAN + FAN])
    return [i for i in ids if i >= 0]


class Memory:
    """What was found for words met before, of ``size`` entries. Once half of that is new, what was not met since goes."""

    def __init__(self, size: int):
        self.half = max(size // 2, 1)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self.new) + len(self.old)

    def put(self, word: str, found: bytes) -> None:
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[word] = found

    def recall(self, words: set[str], into: dict[str, bytes]) -> set[str]:
        """Puts what is known into ``into``; the words that are not known come back."""
        new = self.new.keys() & words
        into.update(zip(new, map(self.new.__getitem__, new)))
        words = words - new
        old, was = self.old.keys() & words, self.old
        for word in old:
            into[word] = was[word]
            self.put(word, was[word])
        return words - old


class ByteBpe:
    """A byte-level BPE vocabulary, read from a tokenizer file's JSON."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", ())}
        letters = byte_letters()
        self.first = [vocab[c] for c in letters]
        self.pairs = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(vocab[a] << 20 | vocab[b], (rank, vocab[a + b]))
        byte_of = {c: bytes([b]) for b, c in enumerate(letters)}
        self.spelt = {i: b"".join(byte_of[c] for c in t) for t, i in vocab.items() if t not in self.special}
        self.spelt |= {i: t.encode() for t, i in self.special.items()}
        self.first_ids = np.array(self.first, np.int64)
        # the last key is no pair's, so that every search ends at a key
        self.keys = np.array([*sorted(self.pairs), NONE])
        self.ranks = np.array([self.pairs[k][0] for k in self.keys[:-1].tolist()] + [0])
        self.merged = np.zeros(len(merges) + 1, np.int64)
        for rank, made in self.pairs.values():
            self.merged[rank] = made
        self.words, self.runs = regex.compile(WORDS), re.compile(RUNS)
        found = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({found})") if found else None
        self.special_ids = {t: array("i", [i]).tobytes() for t, i in self.special.items()}
        self.known_words, self.known_runs = Memory(WORD_MEMORY), Memory(RUN_MEMORY)

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and place of the pairs, NONE where two ids are no pair."""
        keys = left << 20 | right
        near = np.searchsorted(self.keys, keys)
        return np.where(self.keys[near] == keys, self.ranks[near] << 32 | at, NONE)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as int32, each the one node of its tree: a step merges the leftmost pair of lowest rank in every word."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        ids = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        at = np.arange(len(ids))
        after, before = at + 1, at - 1
        after[ends - 1] = before[starts] = -1
        leaves = np.full(len(ids), NONE)
        leaves[:-1] = self._leaves(ids[:-1], ids[1:], at[:-1])
        leaves[ends - 1] = NONE
        while True:
            least = np.minimum.reduceat(leaves, starts)
            least = least[least < NONE]
            if not len(least):
                break
            i = least & 0xFFFFFFFF
            j = after[i]
            k = after[j]
            ids[i], ids[j] = self.merged[least >> 32], -1
            leaves[i] = leaves[j] = NONE
            after[i] = k
            h, right, left = before[i], k >= 0, before[i] >= 0
            before[k[right]] = i[right]
            leaves[i[right]] = self._leaves(ids[i[right]], ids[k[right]], i[right])
            leaves[h[left]] = self._leaves(ids[h[left]], ids[i[left]], h[left])
        kept = ids >= 0
        flat = ids[kept].astype(np.int32).tobytes()
        cuts = [0, *(4 * np.cumsum(kept)[ends - 1]).tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, words: Iterable[str], into: dict[str, bytes]) -> None:
        """Ids of words that no memory holds."""
        short, letters = [], []
        for word in words:
            spelt = word.encode()
            if len(spelt) <= FAN:
                short.append(word)
                letters.append(spelt)
            else:
                into[word] = array("i", merge_all([self.first[b] for b in spelt], self.pairs)).tobytes()
                if len(word) <= LONGEST:
                    self.known_words.put(word, into[word])
        for word, found in zip(short, self.merge_words(letters)):
            into[word] = found
            self.known_words.put(word, found)

    def _ids_of(self, runs: set[str]) -> dict[str, bytes]:
        """Ids of runs, as int32. A run of one word is a word; other runs are cut into words."""
        found = dict(self.special_ids)
        unknown = self.known_runs.recall(self.known_words.recall(runs - found.keys(), found), found)
        cut = [self.words.findall(run) for run in unknown]
        missing = set(chain.from_iterable(cut)) - found.keys()
        self._learn(self.known_words.recall(missing, found), found)
        for run, words in zip(unknown, cut):
            if len(words) > 1:
                packed = found[run] = b"".join([found[w] for w in words])
                if len(run) <= LONGEST:
                    self.known_runs.put(run, packed)
        return found

    def _cut(self, text: str) -> list[str]:
        """The runs and special tokens of a text."""
        if self.specials is None or not self.specials.search(text):
            return self.runs.findall(text)
        parts = self.specials.split(text)
        return [run for part in parts for run in ([part] if part in self.special else self.runs.findall(part))]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts as int32. Special tokens in a text get their own ids, as in the public library."""
        coded, cut, letters = [], [], 0
        for last, text in enumerate(texts, 1):
            cut.append(self._cut(text))
            letters += len(text)
            if letters >= TOGETHER or last == len(texts):
                found = self._ids_of(set(chain.from_iterable(cut)))
                coded += [np.frombuffer(b"".join([found[run] for run in runs]), np.int32) for runs in cut]
                cut, letters = [], 0
        return coded

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spelt.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def shared_vocabulary(spec: str) -> ByteBpe:
    """One vocabulary, with its memories, for all tasks that a Python worker runs."""
    return ByteBpe(spec)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, decoded string)`` per row; null text counts as empty, with no ids.

    ``vocabulary`` is the path of a byte-level tokenizer file. The driver reads it (its size is
    fixed) and tasks get it with the code, so executors need no copy.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    kept = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Batches) -> Batches:
        bpe = shared_vocabulary(kept.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                coded = bpe.encode_all([t or "" for t in part.column(1).to_pylist()])
                ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded) if coded else [], pa.int32()))
                texts = pa.array([bpe.decode(c.tolist()) for c in coded], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, texts], ["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
