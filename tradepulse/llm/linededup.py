"""Line dedup: drop lines that many documents share, except in one document."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else untouched. Pure ASCII takes the fast built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: all its columns, then ``n_lines``, ``n_dropped`` and ``kept``.

    A line's key is the line stripped of ASCII white space, with A-Z lower-cased. A key of at
    least ``min_chars`` code points in at least ``min_docs`` documents loses its lines in every
    document but the largest id that holds it. Keys are compared by two 64-bit hashes.

    Null or empty text is one empty line. Rows without an id are returned whole and count for
    no key. Rows that share an id count as one document. Input columns that are called like a
    result column give way to it. An empty table gives an empty table.
    """
    own = ("n_lines", "n_dropped", "kept")
    carried = [c for c in docs.columns if c not in own or c in (id_col, text_col)]
    # The row travels as one struct, so that no name in it meets one used here.
    doc = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc")
    rows = docs.select(doc, F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("row"))
    text = F.col("doc").getField(text_col)
    lines = (rows.where("id is not null")
             .select("id", "row", F.posexplode(lines_of(text)).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line")))
             .where(F.length("key") >= min_chars)
             .select("id", "row", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2")))
    # Two steps, both with map-side combine: a line that sits in every document is no hot group.
    shared = (lines.select("h1", "h2", "id").distinct()
              .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
              .where(F.col("n") >= min_docs).drop("n"))
    # Equal texts under one id drop the same positions, so (id, hash of text) names a row.
    drops = (lines.join(shared, ["h1", "h2"]).where(F.col("id") != F.col("keeper"))
             .groupBy("id", "row").agg(F.collect_set("pos").alias("gone")))
    # The generator keeps the optimizer from splitting the text anew for each line.
    split = rows.join(drops, ["id", "row"], "left").select("doc", "gone", F.explode(F.array(lines_of(text))).alias("all"))
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("all") - 1), gone), lambda p: F.get(F.col("all"), p))
    whole = F.when(F.size(gone) == 0, F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))
    # In two steps: beside the row's own columns a name could mean one of them.
    done = split.select("doc", F.size("all").cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"), whole.alias("kept"))
    return done.select("doc.*", *own)
