"""Every query of the package beside its SQL twin, and the pipeline's stages."""

import pytest

import check
import corpus_pipeline
from tests.llm.helpers import CLASHES, clashing, documents
from tradepulse.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    result = check.compare(spark, duck, sf, name)
    assert result.startswith("ok" if name in ORACLE else "rows"), result


def test_queries_are_registered():
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


ROWS = [(1, None), (2, ""), (3, "own text of three"), (3, "own text of three"), (None, "no id"), (None, None),
        *[(i, f"A line that many documents share\nbut number {i} is {'zyxwv'[i % 5] * 9} {i * i}") for i in range(10, 40)],
        (50, "x " * 100_000)]


def test_stages_keep_columns_and_bear_odd_rows(spark, sf):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (ROWS, []):
            docs = clashing(documents(spark, *rows))
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            if rows:
                assert {1, 2, 3, 50} <= {r.doc_id for r in out.collect()}
            else:
                assert out.count() == 0
    assert set(CLASHES)


def test_stages_take_effect(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    words = "several quite different words that stand in this long text and make a fingerprint of their own".split()
    text = " ".join(words * 6)
    copies = documents(spark, (1, text), (2, text), (3, text + " end"), (4, "something else entirely, that nobody else has written"), (5, None), (6, ""))
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"](spark, copies, sf).collect()) == [1, 4, 5, 6]
    shared = "A line that many documents share"
    lines = documents(spark, *[(i, f"{shared}\nown {i}") for i in range(4)], (9, None))
    got = {r.doc_id: (r.text, r.n_chars) for r in stages["line_dedup"](spark, lines, sf).collect()}
    assert got == {0: ("own 0", 5), 1: ("own 1", 5), 2: ("own 2", 5), 3: (f"{shared}\nown 3", 38), 9: (None, 0)}
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("item_id = 2").first().text
    leaks = documents(spark, (1, f"before {item} after"), (2, "clean text"))
    assert [r.doc_id for r in stages["benchmark_decontamination"](spark, leaks, sf).collect()] == [2]
    encoded = stages["bpe"](spark, documents(spark, (1, "some text"), (2, None)), sf).collect()
    assert {r.doc_id: (r.n_tokens, r.n_decoded) for r in encoded} == {1: (2, 9), 2: (0, 0)}


def test_rows_that_share_an_id_are_judged_each(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    text, other = " ".join(f"word{i}" for i in range(60)), " ".join(f"other{i * i}" for i in range(60))
    docs = documents(spark, (1, text), (3, text), (3, other), (None, text))
    assert sorted(((r.doc_id, r.text) for r in stages["simhash_near_dedup"](spark, docs, sf).collect()), key=str) == sorted(
        [(1, text), (3, other), (None, text)], key=str)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("item_id = 2").first().text
    leaks = documents(spark, (1, f"before {item} after"), (1, text), (None, other))
    assert sorted(str(r.doc_id) for r in stages["benchmark_decontamination"](spark, leaks, sf).collect()) == ["1", "None"]


def test_one_of_the_copies_that_line_dedup_empties_stays(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    text = "A paragraph that is longer than twenty characters"
    docs = documents(spark, *[(i, text) for i in range(1, 5)], *[(i, f"{text} and more\n\n{text}") for i in range(5, 9)], (9, None), (10, None))
    emptied = stages["line_dedup"](spark, docs, sf)
    assert sorted(r.doc_id for r in emptied.collect() if r.text is not None and not r.text.strip()) == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"](spark, emptied, sf).collect()) == [1, 8, 9, 10]


def test_pipeline_is_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf).collect()
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, sf)
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in step.select("doc_id").collect())
