"""SentencePiece beside the public library: ids, byte spans, decoding and mapped normalisation."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import clashing, documents
from tradepulse.llm import spm

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = spm.PieceModel(open(PATH, "rb").read())
PUBLIC = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    None, "", " ", "   ", "\n", "a", "Hello, world! It's 42.", "  two  spaces   and\t\ttabs \n\n lines  ", "▁", "▁a ▁ b▁c", "a▁▁ ▁",
    "<s>", "</s> <unk> <0x0A>", "Grüße, façade, naïve, ñandú", "日本語のテキスト", "🙂🙃 é ‍", "x\x1cy\x85w v u　t",
    "a" * 3000, "ab" * 3000, "1234567890" * 50, "!?" * 500, "word " * 5000, "İǅⅠ½²³ ١٢", "\x00\x01\x7f�", "𒍅𒍅", "éé",
]


def check(text):
    ids, starts, ends = MODEL.encode(text)
    assert ids.tolist() == PUBLIC.encode(text, add_eos=True)
    assert MODEL.decode(ids.tolist()) == PUBLIC.decode(ids.tolist())
    spans = [(p.begin, p.end) for p in PUBLIC.encode(text, return_type="proto").pieces]
    assert list(zip(starts.tolist(), ends.tolist()))[:-1] == spans
    assert starts[-1] == ends[-1] == len(text.encode())


@pytest.mark.parametrize("text", TEXTS)
def test_like_public_library(text):
    check(text or "")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁\n\tthe anior<>12")), max_size=60))
def test_like_public_library_on_any_text(text):
    check(text)


def test_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(spm, "RUN_MEMORY", 5)
    monkeypatch.setattr(spm, "WORD_MEMORY", 5)
    small = spm.PieceModel(open(PATH, "rb").read())
    for text in TEXTS:
        assert small.encode(text or "")[0].tolist() == PUBLIC.encode(text or "", add_eos=True)
    assert len(small.known_runs) <= 5 and len(small.known_words) <= 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 300), st.sampled_from([0, 1, 2, 28705, 264, 231, 187])), max_size=25))
def test_decodes_any_ids_like_the_public_library(ids):
    assert MODEL.decode(ids) == PUBLIC.decode(ids)


def pb(*parts):
    """A protocol buffer message of (number, value): text and bytes, floats, or whole numbers."""
    import struct

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in parts:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def small_model(rule="nmt_nfkc", byte_fallback=0, squeeze=1, dummy=1, suffix=0, kinds=()):
    """A tiny model with a compiled character map, and the public library's reading of it."""
    rules = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    compiled = dict(spm.fields(rules.serialized_normalizer_spec())).get(2, b"")
    pieces = [pb((1, "<unk>"), (2, 0.0), (3, 2)), pb((1, "<s>"), (2, 0.0), (3, 3)), pb((1, "</s>"), (2, 0.0), (3, 3))]
    if byte_fallback:
        pieces += [pb((1, f"<0x{b:02X}>"), (2, 0.0), (3, 6)) for b in range(256)]
    names = ["▁a", "ab", "▁ab", "▁▁", "b▁", "aba", "ba", "xy", "▁", "a", "b", "x", "é", "1", "Z", "c"]
    special = dict(kinds)
    pieces += [pb((1, p), (2, -float(n)), (3, special.get(p, 1))) for n, p in enumerate(names)]
    pieces += [pb((1, p), (2, 0.0), (3, k)) for p, k in special.items() if p not in names]
    trainer = pb((3, 2), (24, suffix), (35, byte_fallback))
    normal = pb((1, rule), (2, compiled), (3, dummy), (4, squeeze), (5, 1))
    proto = b"".join(pb((1, p)) for p in pieces) + pb((2, trainer)) + pb((3, normal))
    return spm.PieceModel(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)


MODELS = [dict(), dict(byte_fallback=1), dict(squeeze=0), dict(dummy=0), dict(suffix=1), dict(rule="nfkc_cf"), dict(rule="identity"),
          dict(kinds=(("aba", 5), ("▁ab", 5))), dict(kinds=(("<tag>", 4), ("xy", 4)), squeeze=0), dict(rule="identity", squeeze=0, byte_fallback=1)]


@pytest.mark.parametrize("shape", MODELS, ids=str)
def test_mapped_normalisation_like_the_public_library(shape):
    mine, public = small_model(**shape)
    pick = random.Random(3)
    letters = ["a", "b", "a", "b", " ", " ", "x", "y", "Ａ", "①", "ﾊﾞ", "ㄱ", "é", "é", "　", "\t", "\n", "​", "ﬁ", "Z", "▁", "<tag>", "㍿", "c", "ß", "🙂"]
    texts = ["", " ", "  ", "▁", "ａｂ", *("".join(pick.choices(letters, k=pick.randrange(1, 25))) for _ in range(400))]
    for text in texts:
        ids, starts, ends = mine.encode(text, end=False)
        want = public.encode(text, return_type="proto").pieces
        assert [(i, s, e) for i, s, e in zip(ids.tolist(), starts.tolist(), ends.tolist())] == [(p.id, p.begin, p.end) for p in want], text
        assert mine.decode(ids.tolist()) == public.decode(ids.tolist())


def test_operator_on_odd_rows(spark):
    rows = [*enumerate(TEXTS), (None, "no id"), (6, "same id"), (6, "same id")]
    got = spm.encode_decode(clashing(documents(spark, *rows)), PATH)
    assert got.columns == ["id", "ids", "starts", "ends", "decoded"]
    want = sorted(((i, PUBLIC.encode(t or "", add_eos=True)) for i, t in rows), key=str)
    assert sorted(((r.id, r.ids) for r in got.collect()), key=str) == want
    for r in got.where("id = 6").collect():
        assert len(r.starts) == len(r.ends) == len(r.ids)
    assert spm.encode_decode(documents(spark), PATH).count() == 0
