"""Language by cross-parsing: how few phrases of each language's training text does a text need?"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches, landed

#: Size of the model: texts and bytes of training text of a language, and bytes of all languages' tables, which are
#: broadcast: with very many languages each gets less text. Texts are chosen by a hash of the id.
TRAIN_TEXTS, TRAIN_BYTES, MODEL_BYTES = 60, 40_000, 512 << 20
#: Texts are parsed in windows of this many bytes, many windows at a time.
WINDOW, STRIP = 256, 16384
#: Chosen ids, a few bytes each, that every executor may hold; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
UNKNOWN = "und"


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of the text; state 0 is the root."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


@dataclass
class Automaton:
    """Steps of the greedy parse as a table: ``steps[state + symbol]`` is twice the next state, plus one where a phrase ends."""

    steps: np.ndarray
    cost: float

    @classmethod
    def of(cls, text: bytes, codes: np.ndarray, symbols: int) -> Automaton:
        nexts = suffix_automaton(text)
        width = symbols + 2  # one symbol for unseen bytes, one for the padding of windows
        # an unseen symbol is a phrase of its own: the last state, which nothing can follow
        nexts.append({})
        begin = np.full(width, (len(nexts) - 1) * width, np.int64)
        for byte, to in nexts[0].items():
            begin[codes[byte]] = to * width
        # where the phrase can't go on, the next one begins with this symbol
        steps = np.tile(begin << 1 | 1, (len(nexts), 1))
        steps[0] = begin << 1  # only a window's first symbol meets the root
        for state, moves in enumerate(nexts):
            for byte, to in moves.items():
                steps[state, codes[byte]] = (to * width) << 1
            steps[state, symbols + 1] = (state * width) << 1
        return cls(steps.astype(np.int32).ravel(), float(np.log2(len(text) + 2)))

    def phrases(self, columns: np.ndarray) -> np.ndarray:
        """Phrases begun after the first in each window; windows are columns of symbols."""
        state, ends = np.zeros(columns.shape[1], np.int32), np.zeros(columns.shape[1], np.int32)
        for symbols in columns:
            step = self.steps.take(state + symbols)
            ends += step & 1
            state = step >> 1
        return ends


def cleaned(text: str) -> bytes:
    return text.lower().encode().translate(SPACED)


#: ASCII other than letters counts as space; bytes of other scripts stay.
SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass
class LanguageModel:
    codes: np.ndarray
    symbols: int
    languages: dict[str, Automaton]

    @classmethod
    def of(cls, texts: dict[str, bytes]) -> LanguageModel:
        seen = sorted(set(b"".join(texts.values())))
        # an automaton has up to two states a byte, each a row of a 4-byte cell a symbol
        longest = MODEL_BYTES // (8 * (len(seen) + 2) * max(1, len(texts)))
        texts = {k: v[:longest] for k, v in texts.items()}
        codes = np.full(256, len(seen), np.int32)
        codes[seen] = np.arange(len(seen))
        return cls(codes, len(seen), {k: Automaton.of(v, codes, len(seen)) for k, v in sorted(texts.items())})

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores. A phrase costs the bits that point into its training text; fewest bits win, ties by name."""
        data = [cleaned(t or "") for t in texts]
        counts = np.array([max(1, -(-len(d) // WINDOW)) for d in data])
        padded = b"".join(d.ljust(n * WINDOW, b"\0") for d, n in zip(data, counts))
        # a cleaned text holds no zero byte: zeros are padding
        codes = self.codes.copy()
        codes[0] = self.symbols + 1
        cells = codes[np.frombuffer(padded, np.uint8)].reshape(-1, WINDOW)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(int)
        names, bits = list(self.languages), []
        for automaton in self.languages.values():
            ends = np.concatenate([automaton.phrases(np.ascontiguousarray(cells[i:i + STRIP].T)) for i in range(0, len(cells), STRIP)])
            bits.append((np.add.reduceat(ends + 1, starts)) * automaton.cost)
        spelt = [t is not None and any(map(str.isalpha, t)) for t in texts]
        if not names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits = np.array(bits)
        best = bits.argmin(axis=0)
        share = 1 / np.exp2(np.maximum(bits.min(axis=0) - bits, -60)).sum(axis=0)
        return ([names[b] if s else UNKNOWN for b, s in zip(best, spelt)],
                [float(x) if s else 0.0 for x, s in zip(share, spelt)])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model from labelled texts: of each language the first TRAIN_TEXTS by a hash of the id, up to TRAIN_BYTES.

    Null ids, texts and languages are left out. Without any text every prediction is ``und``.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = labelled.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = labelled.select("id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= TRAIN_TEXTS)
    # ids are chosen before any text moves; no more text is taken than a language's model holds
    chosen = landed(chosen, "chosen")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen
    rows = labelled.join(chosen, ["id", "lang"]).select("lang", "n", F.substring("text", 1, TRAIN_BYTES).alias("text"))
    ahead = Window.partitionBy("lang").orderBy("n", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum(F.char_length("text")).over(ahead), F.lit(0))).where(F.col("ahead") < TRAIN_BYTES)
    texts: dict[str, bytes] = {}
    for r in rows.orderBy("lang", "n", "text").collect():
        have = texts.get(r.lang, b"")
        texts[r.lang] = (have + cleaned(f" {r.text} "))[:TRAIN_BYTES]
    return LanguageModel.of(texts)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` per row from its whole text; ``und`` with score 0 where the text is null or has no letter.

    The score is the share of the winner when every bit saved doubles a language's weight.
    """
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                langs, scores = kept.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
