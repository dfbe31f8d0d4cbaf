"""SentencePiece encoding and decoding with the place of every piece in the original bytes."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches

#: Fixed values of the model format: kinds of pieces, kind of model, and the sign that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
SPACE = "▁"
#: Entries of a process's memories of runs and words (a full one starts anew), the longest kept, and
#: bytes of text whose results make one Arrow batch.
RUN_MEMORY, WORD_MEMORY, LONGEST, BATCH_BYTES = 400_000, 1_000_000, 64, 4 << 20


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value, at = message[at:at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """A compiled character map: a double-array trie of source bytes, and the texts they become."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0]
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.texts = compiled[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest known prefix of ``data[at:]`` becomes, and its length."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit >> 9 & 1) << 3)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            # an inner unit carries its byte in the low bits and has its top bit clear
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit >> 9 & 1) << 3)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start, length = found
        return self.texts[start:self.texts.index(b"\0", start)], length


class PieceModel:
    """A SentencePiece model of the BPE kind, read from the bytes of its file."""

    def __init__(self, model: bytes):
        pieces, trainer, rules = [], {}, {}
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif number in (2, 3):
                (trainer if number == 2 else rules).update(fields(value))
            elif number == 5 and dict(fields(value)).get(2):
                raise ValueError("a model that rewrites decoded text is not known here")
        if trainer.get(3) != BPE_MODEL:
            raise ValueError("only models of the BPE kind are read")
        self.suffix, self.byte_fallback = bool(trainer.get(24)), bool(trainer.get(35))
        self.end_id = trainer.get(42, 2)
        unknown_text = trainer.get(44, " ⁇ ".encode())
        self.dummy, self.squeeze, self.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        self.map = CharacterMap(rules[2]) if rules.get(2) else None

        self.ids = {p: i for i, (p, _, _) in reversed(list(enumerate(pieces)))}
        self.unknown = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
        kinds = [p[2] for p in pieces]
        self.byte_of = {i: int(p[3:5], 16) for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        self.cost = {p: -score for p, score, kind in pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
        self.unused = {p for p, _, kind in pieces if kind == UNUSED}
        whole = sorted((p for p, _, kind in pieces if kind == USER_DEFINED), key=len, reverse=True)
        self.whole = re.compile("(" + "|".join(map(re.escape, whole)) + ")") if whole else None

        # Decoding: a piece's bytes; control pieces vanish, an unknown one has a text of its own.
        self.spelt = [b"" if kind == CONTROL else unknown_text if kind == UNKNOWN else bytes([self.byte_of[i]]) if kind == BYTE
                      else p.replace(SPACE, " ").encode() for i, (p, _, kind) in enumerate(pieces)]
        self.spaced = [kind not in (CONTROL, UNKNOWN, BYTE) and p.startswith(SPACE) for p, _, kind in pieces]
        self.kinds = kinds
        self._cuts()
        self.known_runs: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def _cuts(self) -> None:
        """Where text can be cut without a piece across: between letters that stand side by side in no piece."""
        long = [p for p in self.cost if len(p) > 1]
        self.beside = {p[i:i + 2] for p in long for i in range(len(p) - 1)}
        joined = {c for p in long for c in p} - {SPACE}
        inner_space = any(pair[0] != SPACE and pair[1] == SPACE for pair in self.beside)
        if self.unused or not joined:
            self.runs = re.compile("(?s).+")
        else:
            some = "".join(map(re.escape, sorted(joined)))
            self.runs = re.compile(f"[{some}{SPACE}]+|[^{some}{SPACE}]+" if inner_space
                                   else f"{SPACE}*[{some}]+|{SPACE}+|[^{some}{SPACE}]+")

    # -- normalisation -------------------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the byte of ``text`` it comes from."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int32)
        if self.map or self.squeeze or self.whole or self.suffix:
            return self._mapped(data)
        widths = 1 + (len(SPACE.encode()) - 1) * ((np.frombuffer(data, np.uint8) == 32) if self.escape else np.zeros(len(data), int))
        sign = SPACE if self.escape else " "
        ahead = sign if self.dummy else ""
        places = np.repeat(np.arange(len(data), dtype=np.int32), widths)
        places = np.concatenate([np.zeros(len(ahead.encode()), np.int32), places, np.array([len(data)], np.int32)])
        return ahead + text.replace(" ", sign), places

    def _prefix(self, data: bytes, text_at: dict[int, int], at: int) -> tuple[bytes, int]:
        """What stands for the longest prefix that the pieces kept whole, or else the map, know; else one letter."""
        if at in text_at:
            return data[at:at + text_at[at]], text_at[at]
        found = self.map.longest(data, at) if self.map else None
        if found:
            return found
        lead = data[at]
        size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at:at + size], size

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        kept = {}
        if self.whole:
            kept = {m.start(): m.end() - m.start() for m in re.compile(self.whole.pattern.encode()).finditer(data)}
        sign = SPACE.encode() if self.escape else b" "
        out, places, at, n = bytearray(), [], 0, len(data)

        def put(some: bytes) -> None:
            for byte in some:
                new = sign if byte == 32 else bytes([byte])
                out.extend(new)
                places.extend([at] * len(new))

        while self.squeeze and at < n:
            new, size = self._prefix(data, kept, at)
            if new != b" ":
                break
            at += size
        if at == n:
            return "", np.array([at], np.int32)
        if self.dummy and not self.suffix:
            put(b" ")
        after_space = self.squeeze
        while at < n:
            new, size = self._prefix(data, kept, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                put(new)
                after_space = self.squeeze and new.endswith(b" ")
            at += size
        if self.squeeze:
            while out.endswith(sign):
                at = places[len(out) - len(sign)]
                del out[-len(sign):], places[-len(sign):]
        if self.dummy and self.suffix:
            put(b" ")
        return out.decode(), np.array([*places, at], np.int32)

    # -- encoding ------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Pieces of ``text``: the neighbours whose joint piece scores highest merge first, the leftmost of equals."""
        cost, parts = self.cost, list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        halves: dict[str, tuple[str, str]] = {}
        waiting = []
        for i in range(n - 1):
            joint = parts[i] + parts[i + 1]
            if joint in cost:
                waiting.append((cost[joint], i, joint))
                if joint in self.unused:
                    halves[joint] = parts[i], parts[i + 1]
        heapify(waiting)
        while waiting:
            _, i, joint = heappop(waiting)
            j = after[i]
            # what merged meanwhile is longer, or gone
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != len(joint) or parts[i] + parts[j] != joint:
                continue
            parts[i], parts[j] = joint, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            h = before[i]
            for left, right in ((h, i), (i, k)):
                if left >= 0 and right < n:
                    new = parts[left] + parts[right]
                    if new in cost:
                        heappush(waiting, (cost[new], left, new))
                        if new in self.unused:
                            halves[new] = parts[left], parts[right]
        found = [p for p in parts if p]
        return [q for p in found for q in self._used(p, halves)] if halves else found

    def _used(self, piece: str, halves: dict[str, tuple[str, str]]) -> list[str]:
        if piece not in self.unused or piece not in halves:
            return [piece]
        return [q for half in halves[piece] for q in self._used(half, halves)]

    def _word(self, word: str) -> bytes:
        """``id << 32 | bytes`` of the pieces of a stretch that no piece crosses."""
        packed = self.known_words.get(word)
        if packed is None:
            found = []
            for piece in self.merged(word):
                spelt, known = piece.encode(), self.ids.get(piece)
                if known is None and self.byte_fallback:
                    # only the last byte stands for the letter in the text
                    found += [self.byte_ids[b] << 32 for b in spelt[:-1]] + [self.byte_ids[spelt[-1]] << 32 | len(spelt)]
                else:
                    found.append((self.unknown if known is None else known) << 32 | len(spelt))
            packed = np.array(found, np.int64).tobytes()
            if len(word) <= LONGEST:
                if len(self.known_words) >= WORD_MEMORY:
                    self.known_words.clear()
                self.known_words[word] = packed
        return packed

    def _run(self, run: str) -> bytes:
        if self.unused:
            return self._word(run)
        beside, words, start = self.beside, [], 0
        for i in range(1, len(run)):
            if run[i - 1:i + 1] not in beside:
                words.append(run[start:i])
                start = i
        words.append(run[start:])
        packed = b"".join(map(self._word, words))
        if len(run) <= LONGEST:
            if len(self.known_runs) >= RUN_MEMORY:
                self.known_runs.clear()
            self.known_runs[run] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        known, run = self.known_runs.get, self._run
        return b"".join([known(r) or run(r) for r in self.runs.findall(text)])

    def encode(self, text: str, end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the bytes of ``text`` at which each piece starts and ends; ``end`` adds the end id."""
        norm, places = self.normalise(text)
        if self.whole:
            packed = b"".join([np.array([self.ids[p] << 32 | len(p.encode())], np.int64).tobytes() if i % 2 else self._plain(p)
                               for i, p in enumerate(self.whole.split(norm))])
        else:
            packed = self._plain(norm)
        both = np.frombuffer(packed, np.int64)
        ids, sizes = (both >> 32).astype(np.int32), both & 0xFFFFFFFF
        upto = np.cumsum(sizes)
        starts, ends = places[upto - sizes], places[upto]
        if not self.byte_fallback and (ids == self.unknown).any():
            # neighbouring unknown pieces are one
            again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
            first, last = np.concatenate([[True], ~again]), np.concatenate([~again, [True]])
            ids, starts, ends = ids[first], starts[first], ends[last]
        if end:
            whole = len(text.encode())
            ids, starts, ends = (np.append(a, np.int32(x)) for a, x in ((ids, self.end_id), (starts, whole), (ends, whole)))
        return ids, starts, ends

    # -- decoding ------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids. The space put ahead of every text goes; bytes that are no letter become U+FFFD each."""
        parts = list(map(self.spelt.__getitem__, ids))
        if self.dummy or self.squeeze:
            for n, i in enumerate(ids):
                if i in self.byte_of:
                    break
                if self.spaced[i]:
                    parts[n] = parts[n][1:]
                    if not self.squeeze or parts[n]:
                        break
                elif parts[n]:
                    break
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._repaired(ids, parts)

    def _repaired(self, ids: list[int], parts: list[bytes]) -> str:
        out, bytes_run = [], b""
        for i, part in zip(ids, parts):
            if i in self.byte_of:
                bytes_run += part
            else:
                out += [letters(bytes_run), part.decode()]
                bytes_run = b""
        return "".join([*out, letters(bytes_run)])


def letters(data: bytes) -> str:
    """Bytes as text; a byte that starts no whole letter becomes U+FFFD by itself."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def shared_model(model: bytes) -> PieceModel:
    """One model, with its memories, for all tasks that a Python worker runs."""
    return PieceModel(model)


def encode_decode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """``(id, ids, starts, ends, decoded)`` per row: piece ids, the bytes of the original text each piece
    stands for (``[start, end)``, in UTF-8), and what the ids decode to.

    Null text counts as empty: the end id alone, if ``end``. Texts of any length are encoded whole.
    Rows that repeat, or whose id is null, are rows like others; other columns are ignored; an empty
    table gives an empty result. Of the bytes of a letter without a piece, the last one spans it.

    The driver reads the model file, whose size does not depend on the data; tasks get it by broadcast.
    """
    with open(model_file, "rb") as f:
        kept = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "ids", "starts", "ends", "decoded"]

    def lists(arrays: list[np.ndarray]) -> pa.ListArray:
        ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays), pa.int32()))

    def run(batches: Batches) -> Batches:
        model = shared_model(kept.value)
        for batch in batches:
            rows, first, size = [], 0, 0
            for n, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                rows.append(model.encode(text, end))
                size += len(text)
                if size >= BATCH_BYTES or n + 1 == batch.num_rows:
                    ids, starts, ends = zip(*rows)
                    texts = pa.array([model.decode(i.tolist()) for i in ids], pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), lists(ids), lists(starts), lists(ends), texts], names)
                    rows, first, size = [], n + 1, 0

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"id {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string")
