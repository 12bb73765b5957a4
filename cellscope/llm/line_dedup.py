"""Line dedup over overlapping windows of three lines.

Lines (split at \\n, trimmed of ASCII white space; blank ones don't count) are taken in windows of
three consecutive ones, and every window is hashed (128 bits). A window that occurs in several
places of the corpus stays where it comes first, by doc_id and position; the lines that any later
occurrence covers are removed, overlapping windows together removing their union. A document's
other lines, blank ones included, stay as they are.

The first places come from one aggregate with partial minima, so a window that a third of all
documents hold is one row for each task; they are joined back on the hash by a join that adaptive
execution can split. Removed positions are collected for one document at a time.

Defined results: null and empty texts and texts of fewer than three lines have no window and
stay as they are; rows of the same doc_id and text count as one document, so repeated rows are
never removed from on each other's account; a null doc_id comes before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import SPACE, as_rows, with_text

WINDOW = 3


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, hash (h1, h2), start (number of its first line among the non-blank) and
    lines (positions p1..p3 in the text) of every window."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.filter(F.transform(F.split("text", "\n", -1),
                                             lambda x, i: F.struct(i.alias("p"), _trimmed(x).alias("s"))),
                                 lambda x: x["s"] != "").alias("l"))
    at = F.col("start")
    line = lambda k: F.get("l", at + k)
    text = F.concat_ws("\n", *[line(k)["s"] for k in range(WINDOW)])
    return (lines.where(F.size("l") >= WINDOW)
            .select("doc_id", "text_hash", "l",
                    F.explode(F.sequence(F.lit(0), F.size("l") - WINDOW)).alias("start"))
            .select("doc_id", "text_hash", "start", F.md5(text).alias("h"),
                    F.array(*[line(k)["p"] for k in range(WINDOW)]).alias("lines")))


def later_occurrences(docs: DataFrame) -> DataFrame:
    """The windows that occur earlier too: doc_id, text_hash, lines."""
    w = windows(docs)
    place = F.struct("doc_id", "text_hash", "start")
    firsts = (w.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .where("NOT (first <=> last)").select(F.col("h").alias("k"), "first"))
    return (w.join(firsts, F.col("h") == F.col("k"))
            .where(~F.col("first").eqNullSafe(place)).select("doc_id", "text_hash", "lines"))


def _positions(docs: DataFrame) -> DataFrame:
    """_id, _hash, _gone: the positions to remove, one row for each document that loses lines."""
    return (later_occurrences(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
            .agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("_gone")))


def _marked(docs: DataFrame) -> DataFrame:
    gone = _positions(docs)
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.xxhash64("text") == F.col("_hash")), "left")


def _rest() -> Column:
    """The text without the lines of `_gone`, in linear time."""
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    return F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda p: F.get(lines, p)), "\n"))


def dedup(docs: DataFrame) -> DataFrame:
    """`docs` (all columns) with `text` rid of later occurrences and `n_chars`, if there, brought
    up to date for the rows that changed."""
    gone = _positions(docs)
    rows = as_rows(docs)
    marked = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    return with_text(marked.withColumn("_left", _rest()), docs, F.col("_left"), F.col("_gone").isNotNull())


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (non-blank), n_removed and the md5 of the remaining text, for every row."""
    filled = F.size(F.filter(F.split("text", "\n", -1), lambda x: _trimmed(x) != ""))
    return _marked(docs.select("doc_id", "text")).select(
        "doc_id", F.coalesce(F.when(F.col("text").isNotNull(), filled), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.md5(F.coalesce(_rest(), F.lit(""))).alias("text_md5"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS p
  FROM documents),
solid AS (
  SELECT doc_id, p, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM lines
  WHERE trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
win AS (
  SELECT doc_id, p AS p1, lead(p, 1) OVER w AS p2, lead(p, 2) OVER w AS p3,
         s || chr(10) || lead(s, 1) OVER w || chr(10) || lead(s, 2) OVER w AS h
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, p1) AS place FROM win WHERE h IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest([p1, p2, p3]) AS p FROM placed WHERE place > 1),
rest AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.p) AS text
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p GROUP BY l.doc_id),
n_solid AS (SELECT doc_id, count(*) AS n FROM solid GROUP BY doc_id),
n_gone AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed,
       md5(coalesce(r.text, '')) AS text_md5
FROM documents d LEFT JOIN n_solid s USING (doc_id) LEFT JOIN n_gone g USING (doc_id)
LEFT JOIN rest r USING (doc_id)
"""
