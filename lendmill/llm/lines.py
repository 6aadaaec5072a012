"""Line deduplication, by built-in functions only.

The lines of every text are exploded with their positions and normalised: white space at
both ends goes, A-Z become small. A line's key is a 128-bit hash of what is left. Keys are
counted by distinct documents; those of at least ``LEAST_DOCUMENTS`` documents lose their
lines everywhere but in the document of the largest id. What is dropped comes back to its
document as a list of positions, and the text is put together from the other lines.

Only keys and positions are shuffled for the counts. A key that stands in a third of all
documents is reduced per task before its counts meet, and its join is one row against many,
which adaptive execution splits; no task holds more of a document than its own lines.

Defined cases: a null or empty text is one empty line; documents are told apart by their id,
so rows that repeat an id count once, and all of them keep the lines if the id is the largest;
rows without an id count as one document, which comes before all others; white space alone is
a line with an empty key, which stays; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import text_rows, written

LEAST_CHARS, LEAST_DOCUMENTS = 20, 3
#: The white space that is cut at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for the id of rows without one.
NO_ID = -(1 << 63)


def normalised(line: Column) -> Column:
    """The line without white space at its ends and with A-Z as small letters. Lines of ASCII
    alone take the quicker function, which does the same to them."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, CAPITALS, SMALL))


def split_lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def keyed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """id, mark (of the text), place (from 0) and the two halves of the key, of every line whose
    normalised form has enough characters."""
    rows = text_rows(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("mark"), F.posexplode(split_lines("text")).alias("place", "line"))
    # Shorter in bytes is shorter in characters: most short lines are not normalised at all.
    long = rows.filter(F.octet_length("line") >= least_chars).select("id", "mark", "place", normalised(F.col("line")).alias("key")).filter(F.char_length("key") >= least_chars)
    return long.select("id", "mark", "place", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def common_keys(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Keys of enough documents, and the largest id that holds each."""
    held = lines.groupBy("k1", "k2", "id").agg(F.lit(1).alias("one"))
    return held.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= least_documents)


def without_common_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of every document."""
    lines = written(keyed_lines(docs, least_chars), "lines")
    common = written(common_keys(lines, least_documents), "common-lines")
    gone = lines.join(common.select("k1", "k2", "keeper"), ["k1", "k2"]).filter(F.col("id") != F.col("keeper"))
    places = written(gone.groupBy("id", "mark").agg(F.collect_set("place").alias("gone")), "dropped-lines")
    named = text_rows(docs).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("mark", F.xxhash64("text"))
    split = named.join(places, ["id", "mark"], "left").select("doc_id", split_lines("text").alias("lines"), "gone", "text")
    size = F.size("lines")
    # Linear in the lines: the places left over, then the lines at these.
    left = F.array_except(F.sequence(F.lit(0), size - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return split.select("doc_id", size.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))


def kept_table(docs: DataFrame) -> DataFrame:
    return without_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def sql() -> str:
    """DuckDB SQL for ``kept_table``."""
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, i AS place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{CAPITALS}', '{SMALL}') AS key
  FROM (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)
),
common AS (
  SELECT key, max(coalesce(doc_id, -9223372036854775808)) AS keeper FROM lines WHERE length(key) >= {LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= {LEAST_DOCUMENTS}
),
judged AS (
  SELECT r, l.doc_id, place, line, keeper IS NOT NULL AND coalesce(l.doc_id, -9223372036854775808) <> keeper AS gone
  FROM lines l LEFT JOIN common c ON l.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""
