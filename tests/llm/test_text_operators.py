"""Licences, decontamination, toxicity and language: brute force, planted cases and odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents
from tradepulse.llm import decontam, langid, licenses, toxicity

ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "no id"), (None, None), (4, "same"), (4, "same"), (5, "long " * 60_000), (6, "é ß 日本"), (7, "!!! 123")]


def brute_licenses(text, least=0.8):
    def grams(t):
        w = licenses.WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        return {(a, b) for a, b in zip(w, w[1:])}

    out = {}
    for p in licenses.passages(text):
        for name, template in licenses.TEMPLATES.items():
            a, b = grams(p), grams(template)
            if a and 2 * len(a & b) / (len(a) + len(b)) >= least:
                s, n = out.get(name, (0, 0))
                out[name] = (max(s, 2 * len(a & b) / (len(a) + len(b))), n + 1)
    return out


def license_rows():
    r = random.Random(2)
    mit = licenses.TEMPLATES["mit"].split()
    edited = " ".join(w for w in mit if r.random() > 0.05)
    wrapped = "\n".join(" ".join(mit[i:i + 10]) for i in range(0, len(mit), 10))
    return [*ODD, (10, "Intro.\nReleased under the  MIT license\nmore"), (11, edited), (12, f"Code here\n\n{wrapped}\n\nmore code"),
            (13, "licensed UNDER the apache license version 2 0"), (14, "All rights reserved."), (15, "Licensed under nothing at all"),
            (16, "All rights reserved.\nALL RIGHTS RESERVED")]


def test_licenses_like_brute_force(spark):
    rows = license_rows()
    got = sorted(str(tuple(r)) for r in licenses.scan(clashing(documents(spark, *rows))).collect())
    assert got == sorted(str((i, n, s, k)) for i, t in rows for n, (s, k) in brute_licenses(t or "").items())
    assert any("(11, 'mit'" in x for x in got) and any("(12, 'mit'" in x for x in got)
    assert licenses.scan(documents(spark)).count() == 0


def test_a_licence_of_three_paragraphs_at_the_head_of_a_long_text(spark):
    mit = licenses.TEMPLATES["mit"]
    a, b = mit.index("The above copyright"), mit.index("THE SOFTWARE IS PROVIDED")
    text = "\n\n".join(["Some Project", mit[:a], mit[a:b], mit[b:], *["A paragraph about the project and what it does."] * 125])
    got = {r.license: r.score for r in licenses.scan(documents(spark, (1, text), (2, text.replace("\n\n", "\n \n")))).where("id = 2").collect()}
    assert got == {"mit": 1.0}


def test_size_bounds_lose_nothing():
    r = random.Random(3)
    words = "released under the mit license all rights reserved licensed cc by 4 0".split()
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for _ in range(2000):
        text = " ".join(r.choices(words, k=r.randrange(0, 14)))
        assert {n: s for n, (s, _) in scanner.text(text).items()} == {n: s for n, (s, _) in brute_licenses(text).items()}


def brute_align(item, words):
    h = np.zeros((len(item) + 1, len(words) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_like_brute_force():
    r = random.Random(4)
    for _ in range(300):
        item, words = r.choices("abcde", k=r.randrange(1, 12)), r.choices("abcdefg", k=r.randrange(0, 30))
        score, first, last = decontam.align(item, words)
        assert score == brute_align(item, words)
        assert brute_align(item, words[first:last]) == score


def planted():
    r = random.Random(6)
    vocabulary = ["".join(r.choices("abcdefghij", k=r.randrange(3, 8))) for _ in range(3000)]
    items = [(k, " ".join(r.choices(vocabulary, k=30))) for k in range(12)] + [(90, None), (91, ""), (92, "one"), (None, "no id of an item")]

    def noise(n):
        return " ".join(r.choices(vocabulary, k=n))

    docs, want = [*ODD], set()
    for d in range(100, 160):
        k = d % 12
        w = items[k][1].split()
        if d % 5 == 0:
            w = [x if r.random() > 0.1 else r.choice(vocabulary) for x in w]
        if d % 5 == 1:
            w = [x for x in w if r.random() > 0.1]
        if d % 5 == 2:
            w = [y for x in w for y in ([x, r.choice(vocabulary)] if r.random() < 0.1 else [x])]
        if d % 5 == 3:
            docs.append((d, noise(400)))
            continue
        docs.append((d, f"{noise(200)}\n{' '.join(w).upper() if d % 2 else ' '.join(w)}. {noise(50)}"))
        want.add((d, k))
    docs += [(1000 + n, f"{noise(20)} {items[0][1]}") for n in range(200)]  # a passage that very many documents quote
    want |= {(1000 + n, 0) for n in range(200)}
    return docs, items, want


def test_leaks_are_found_and_clean_documents_left(spark):
    docs, items, want = planted()
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.contaminated(clashing(documents(spark, *docs)), clashing(frame)).collect()
    assert {(r.id, r.item) for r in got} == want
    assert all(r.score == 1.0 for r in got if r.id >= 1000)
    texts = dict(docs)
    for r in got:
        span = decontam.words_of(texts[r.id])[r.first_word:r.last_word]
        item = decontam.words_of(dict(items)[r.item])
        assert brute_align(item, span) == round(r.score * 2 * len(item))


@pytest.mark.parametrize("block", [decontam.ITEM_BYTES, 200])
def test_edited_copies_beside_a_verbatim_one(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "ITEM_BYTES", block)
    r = random.Random(7)
    vocabulary = ["".join(r.choices("abcdefghij", k=r.randrange(3, 8))) for _ in range(300)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.randrange(15, 40)))) for k in range(10)]
    docs = [(k, f"before {t} after") for k, t in items]
    for n in range(120):
        w = items[n % 10][1].split()
        edited = [x if r.random() > (0.2, 0.25, 0.3)[n % 3] else r.choice(vocabulary) for x in w]
        docs += [(100 + n, " ".join(r.choices(vocabulary, k=60) + edited + r.choices(vocabulary, k=60)))]
    w = items[0][1].split()
    docs += [(300, " ".join(x if i % 3 else "other" for i, x in enumerate(w, 1))), (301, " ".join(f"{x} other" for x in w))]
    want = {(i, k) for i, t in docs for k, s in items if decontam.align(s.split(), t.split())[0] >= len(s.split())}
    assert {(300, 0), (301, 0)} <= want and len(want) > 110
    got = decontam.contaminated(documents(spark, *docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(x.id, x.item) for x in got} == want


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contaminated(documents(spark, (1, "a b c d")), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d")], "item_id bigint, text string")
    assert decontam.contaminated(documents(spark), some).count() == 0
    assert decontam.contaminated(documents(spark, (1, "A b, c d!")), some).count() == 1


def toxic_corpus(n, seed):
    r = random.Random(seed)
    plain = ["".join(r.choices("aeiounrstl", k=r.randrange(2, 8))) for _ in range(400)]
    bad = ["zorkhead", "blivvet", "gronkwit", "fuzzwumper", "dreckling", "vexbrain"]
    docs, labels = [], []
    for i in range(n):
        words = r.choices(plain, k=r.randrange(20, 120))
        toxic = i % 4 == 0
        for _ in range(r.randrange(3, 7) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus(900, 7)
    frame, marks = documents(spark, *docs), spark.createDataFrame(labels, LABELS)
    seen = toxicity.fold(F.col("doc_id"), 3) != 1
    model = toxicity.train(clashing(frame.where(seen)), clashing(marks.where(seen)).drop("label"))
    rows = {r.doc_id: r.score for r in toxicity.classify(frame, model).collect()}
    held = [(rows[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 200
    assert sum((s >= 0.7) == bool(t) for s, t in held) / len(held) > 0.97
    odd = toxicity.classify(clashing(documents(spark, *ODD)), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score < 0.7 for r in odd)
    assert toxicity.classify(documents(spark), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (1, 1, None)]])
def test_toxicity_without_labels_of_both_kinds(spark, labels):
    docs = documents(spark, (1, "some text"), (2, None))
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    assert [r.score for r in toxicity.classify(docs, model).collect()] == [0.0, 0.0]


def test_label_both_ways_is_toxic(spark):
    docs, labels = toxic_corpus(120, 9)
    frame = documents(spark, *docs)
    both = [*labels, *[(i, 1, 0) for i, _, t in labels if t]]
    a = toxicity.train(frame, spark.createDataFrame(labels, LABELS))
    b = toxicity.train(frame, spark.createDataFrame(both, LABELS))
    assert (a.toxic, a.ordinary) == (b.toxic, b.ordinary)


def test_windows_hold_the_whole_text():
    text = "Ä word, " * 40 + "x" * 500
    assert b"".join(toxicity.windows(text)) == toxicity.NOT_LETTERS.sub(" ", f" {text} ".lower()).encode()
    assert max(map(len, toxicity.windows(text))) <= toxicity.WINDOW


def brute_phrases(train, text, width):
    """Greedy cross-parsing window by window with plain substring search."""
    n = 0
    for at in range(0, max(1, len(text)), width):
        part, i, first = text[at:at + width], 0, True
        n += 1
        while i < len(part):
            j = i + 1
            while j < len(part) and part[i:j + 1] in train:
                j += 1
            if part[i:j] not in train:
                j = i + 1
            i = j
            n += i < len(part)
    return n


def test_phrases_like_substring_search():
    r = random.Random(8)
    for _ in range(40):
        train = bytes(r.choices(b"abc ", k=r.randrange(1, 200)))
        texts = ["".join(r.choices("abcd ", k=r.randrange(0, 700))) for _ in range(5)]
        model = langid.LanguageModel.of({"x": train})
        counted = []
        for t in texts:
            _, _ = model.predict([t])
            data = langid.cleaned(t)
            cells = np.frombuffer(data.ljust(max(1, -(-len(data) // langid.WINDOW)) * langid.WINDOW, b"\0"), np.uint8)
            codes = model.codes.copy()
            codes[0] = model.symbols + 1
            columns = codes[cells].reshape(-1, langid.WINDOW).T
            counted.append(int((model.languages["x"].phrases(np.ascontiguousarray(columns)) + 1).sum()))
        assert counted == [brute_phrases(train, langid.cleaned(t), langid.WINDOW) for t in texts]


def test_languages(spark):
    r = random.Random(10)
    of = {"en": "the of and that with house water green".split(), "de": "der die und nicht mit haus wasser grün".split(), "fr": "le la et que avec maison eau verte".split()}
    rows = [(i, " ".join(r.choices(of[lang], k=r.randrange(3, 60))), lang) for i, lang in enumerate(list(of) * 60)]
    odd = [(i, t, None) for i, t in ODD]
    model = langid.train(clashing(documents(spark, *[x for x in rows if x[0] % 2], *odd)))
    got = langid.identify(clashing(documents(spark, *rows, *odd)), model).collect()
    by_id = {r.id: r for r in got}
    assert len(got) == len(rows) + len(odd)
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows if i >= 10)
    assert all(0 <= r.score <= 1 for r in got)
    again = {r.id: (r.lang_pred, r.score) for r in langid.identify(documents(spark, (1, None), (2, ""), (3, " \n"), (7, "!!! 123")), model).collect()}
    assert set(again.values()) == {("und", 0.0)}
    assert langid.identify(documents(spark), model).count() == 0


def test_language_without_training_text(spark):
    model = langid.train(documents(spark, (1, None, "en"), (2, "", "en"), (None, "abc", "en")))
    assert [tuple(r) for r in langid.identify(documents(spark, (1, "some text")), model).collect()] == [(1, "und", 0.0)]


def test_tables_of_many_languages_stay_within_their_bytes(monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 200_000)
    r = random.Random(3)
    texts = {f"l{k}": "".join(r.choices("abcdefghijklmnop ", k=5000)).encode() for k in range(30)}
    model = langid.LanguageModel.of(texts)
    assert len(model.languages) == 30
    assert sum(a.steps.nbytes for a in model.languages.values()) <= 200_000 * 1.2


@pytest.mark.parametrize("spare", [1, 6, 50])
def test_the_choice_of_seeds_loses_no_copy(spark, monkeypatch, spare):
    """However many seeds are taken beyond those that edits can break, the same copies are found."""
    monkeypatch.setattr(decontam, "SPARE", spare)
    monkeypatch.setattr(decontam, "BROADCAST_CANDIDATES", 0 if spare == 6 else 1000)
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.randrange(1, 25)))) for k in range(25)]
    docs = []
    for n in range(150):
        w = r.choice(items)[1].split()
        out = []
        for x in w:
            p = r.random()
            out += [] if p < 0.1 else [r.choice(vocabulary)] if p < 0.25 else [x, "put"] if p < 0.4 else [x, "put", "in"] if p < 0.45 else [x]
        docs.append((n, " ".join(["before", *out, "after"])))
    want = {(i, k) for i, t in docs for k, s in items if decontam.align(s.split(), t.split())[0] >= len(s.split())}
    got = decontam.contaminated(documents(spark, *docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(x.id, x.item) for x in got} == want and len(want) > 100
