"""Toxicity by compression distance: how much shorter do windows get with a dictionary of toxic text?"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tradepulse.llm.shared import Batches, landed, map_rows, table

WINDOW, LEVEL, MIN_MATCH = 64, 7, 4
#: Sizes of the model: words and bytes of the dictionaries, and labelled rows that calibrate it (expected number).
TOXIC_WORDS, ORDINARY_WORDS, ORDINARY_BYTES, CALIBRATION_ROWS = 100, 4000, 12000, 6000
#: A word is typical of toxic text if the lower bound of its log-odds there is above this.
TYPICAL = 2.2
NOT_LETTERS = re.compile(r"[\W\d_]+")
BINS = 11
#: The score that calls a text toxic: the cut that is best on the calibration rows is put there.
DECISION = 0.7
STEMS = (4, 5)
#: Labels, a few bytes each, that every executor may hold; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000


def windows(text: str) -> list[bytes]:
    """Lower-cased text, letters only, in windows of at most 64 bytes cut at spaces where there are any."""
    data = NOT_LETTERS.sub(" ", f" {text} ".lower()).encode()
    out, i = [], 0
    while i < len(data):
        j = i + WINDOW
        if j < len(data):
            k = data.rfind(b" ", i + 1, j)
            j = k if k > i else j
        out.append(data[i:j])
        i = j
    return out


def dictionary(words: list[tuple[str, int]], size: int | None) -> bytes:
    """Dictionary content trained on the words with their weights.

    The trainer leaves out what it finds dispensable. Where no size is given, missing words are
    put in front; with too little text to train on, the words themselves are the content.
    """
    spelt = [f" {w} ".encode() for w, n in words for _ in range(n)]
    order = np.random.RandomState(7).permutation(len(spelt))
    samples = [b"".join(spelt[i] for i in order[k:k + 4]) for k in range(0, len(order), 4)]
    try:
        content = zstandard.train_dictionary(size or 65536, samples * (1 + 3000 // max(1, len(samples))), k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        content = b""
    if size and content:
        return content[-size:]
    missing = b"".join(f" {w}".encode() for w, _ in reversed(words) if f" {w}".encode() not in content)
    return (missing + content)[-size if size else 0:]


@dataclass
class ToxicityModel:
    """Two dictionaries, and a logistic function of the histogram of length differences."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: list[float] = field(default_factory=list)
    base: float = 0.0

    def differences(self):
        def length(content: bytes):
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=MIN_MATCH, source_size=WINDOW, dict_size=len(self.ordinary),
                write_content_size=False, write_checksum=False, write_dict_id=False)
            kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=kept, compression_params=params).compress

        # Both know ordinary text, so that they part only where toxic text is met.
        plain, toxic = length(self.ordinary), length(self.toxic + self.ordinary)
        return lambda text: np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)])

    def score(self, features: np.ndarray) -> float:
        if not self.weights:
            return self.base
        return float(1 / (1 + np.exp(-np.clip(features @ np.array(self.weights), -30, 30))))


def features(d: np.ndarray) -> np.ndarray:
    """How many windows differ by how many bytes, with the largest differences and the length."""
    counts = np.bincount(np.clip(d, -1, BINS - 2) + 1, minlength=BINS).astype(float)
    counts[:2] = 0
    return np.concatenate([np.log1p(counts), [d.max(), 1.0, np.log(len(d) + 1), np.log1p(np.clip(d - 2, 0, None).sum()), np.sort(d)[-2:].sum()]])


def fit_logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Newton's method with a small ridge."""
    w, ridge = np.zeros(x.shape[1]), 1e-4 * len(x)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
    return w.tolist()


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The value from which on calling rows toxic gives the best F1, midway to the next lower one."""
    order = np.argsort(-z, kind="stable")
    z, hits = z[order], np.cumsum(y[order])
    f1 = np.where(np.append(z[1:] < z[:-1], True), 2 * hits / (np.arange(1, len(z) + 1) + y.sum()), 0)
    i = int(f1.argmax())
    return float((z[i] + z[min(i + 1, len(z) - 1)]) / 2)


def fold(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string")) % folds


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """A model from labelled texts. Word statistics cover all of them, over distinct lines, so that copies count once.

    Words typical of toxic lines (at most TOXIC_WORDS) train one dictionary, the commonest other
    words (ORDINARY_WORDS) the other. The weights are fitted on about CALIBRATION_ROWS labelled
    rows, chosen by a hash of the id. Null ids, labels and texts are left out; an id labelled both
    ways counts as toxic. Without labels of both kinds the model gives every text the share of
    toxic labels.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null")
    marks = marks.groupBy("id").agg(F.max("label").alias("label"))
    if marks.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null").join(marks, "id")
    n, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        return ToxicityModel(base=n_toxic / n if n else 0.0)
    lines = rows.select("label", F.explode(F.split(F.lower("text"), "\n")).alias("line")).groupBy("line").agg(F.min("label").alias("label"))
    found = F.regexp_extract_all("line", F.lit("([\\p{L}]+)"), 1)
    # Beginnings count as words of their own: compounds of one stem are rare each, but not the stem.
    # The empty word of every line counts the lines.
    begun = F.array_union(F.array_union(F.array(F.lit("")), found), F.flatten(F.array(*[F.transform(found, lambda w, n=n: F.left(w, F.lit(n))) for n in STEMS])))
    words = lines.select("label", F.explode(begun).alias("word"))
    counts = landed(words.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where("a + b >= 3 or word = ''"), "words")
    lines_a, lines_b = counts.where("word = ''").select("a", "b").first()
    odds = F.log((F.col("a") + 0.5) / (lines_a + 1)) - F.log((F.col("b") + 0.5) / (lines_b + 1))
    bound = odds - 2 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    counts = counts.where("word <> ''").withColumn("bound", bound)
    typical = counts.where(F.col("bound") >= TYPICAL).orderBy(F.col("bound").desc(), "word").limit(TOXIC_WORDS).collect()
    usual = counts.where("bound < 0").orderBy(F.col("b").desc(), "word").limit(ORDINARY_WORDS).collect()
    if not typical:
        return ToxicityModel(base=n_toxic / n)
    weight = lambda k, of: max(1, min(20, k * 200 // max(1, of)))
    model = ToxicityModel(dictionary([(r.word, weight(r.a, n_toxic)) for r in typical], None),
                          dictionary([(r.word, weight(r.b, n - n_toxic)) for r in usual], ORDINARY_BYTES), [], n_toxic / n)
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, CALIBRATION_ROWS / n)) + 1)

    def measure(part: dict) -> dict:
        differ = model.differences()
        return {"label": part["label"], "x": [features(differ(t)) for t in part["text"]]}

    sample = map_rows(chosen.select("label", "text"), measure, "label int, x array<double>").collect()
    y = np.array([r.label for r in sample], float)
    if 0 < y.sum() < len(y):
        x = np.array([r.x for r in sample])
        weights = np.array(fit_logistic(x, y))
        weights[BINS + 1] += np.log(DECISION / (1 - DECISION)) - best_cut(x @ weights, y)
        model.weights = weights.tolist()
    return model


def classify(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns, with ``score_col`` (0 to 1) in place of any column of that name. Null and empty texts are scored as empty."""
    rows = docs.drop(score_col)
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Batches:
        differ = kept.value.differences()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = [kept.value.score(features(differ(t.as_py() or ""))) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(score_col, DoubleType())]))


def trained_on_labels(spark, sf_dir: str) -> ToxicityModel:
    """The model of the given tables: from labelled rows whose crc32(doc_id) mod 3 is not 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return train(docs.where(fold(F.col("doc_id"), 3) != 1), labels.where(fold(F.col("doc_id"), 3) != 1))
