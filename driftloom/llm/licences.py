"""Licence scan by canonical digests.

A text is made canonical: lower case, copyright lines dropped, equivalent spellings made one,
everything but letters and digits taken for blanks, runs of blanks for one. The SHA-256 of the
whole canonical text is looked up among those of known licences, and so are the digests of its
single lines, where licence notices stand. All of it is DataFrame functions; the lookup is one
hash join, and nothing else is shuffled. Where the known digests are too many to broadcast,
Spark shuffles both sides and splits a line that is very common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.llm.common import need
from driftloom.llm.licence_texts import KNOWN

#: A line that starts with a mark of copyright, after any comment signs, and goes on with a sign or a year. The word
#: alone may start a line in running text.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n(©]*(copyright[ \t:]*(\(c\)|©|[0-9]{4})|\(c\)[ \t]*(copyright|[0-9]{4})|©)[^\n]*"
#: Spellings that licence texts use for one another, in lower case.
SPELLINGS = (
    (r"licence", "license"),
    (r"\bnon[- ]?(commercial|infringement|exclusive)\b", "non$1"),
    (r"\backnowledgement", "acknowledgment"),
    (r"\b(recogni|organi|authori)s(e|ation)", "$1z$2"),
    (r"\b(fav|hon|col)our", "$1or"),
    (r"\bhttps://", "http://"),
    (r"&", " and "),
)


def canonical_lines(text: Column) -> Column:
    """The canonical text with its lines kept apart."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for pattern, plain in SPELLINGS:
        out = F.regexp_replace(out, pattern, plain)
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(canonical: Column) -> Column:
    """SHA-256 in hex; null for a canonical text without any letter or digit."""
    return F.when(canonical != "", F.sha2(canonical.cast("binary"), 256))


def known_licences(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    return spark.createDataFrame(texts, "license_id string, text string")


def licence_digests(known: DataFrame) -> DataFrame:
    """Distinct digests of known texts with the licence; the first in order where licences share a text."""
    need(known, "license_id", "text")
    rows = known.select("license_id", digest(whole(canonical_lines(F.col("text")))).alias("digest"))
    return rows.filter("digest IS NOT NULL AND license_id IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licences(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line, digest, license_id: line 0 is the whole text of every row, found or not; others are lines found.

    A null text, or one without letters or digits, has a null digest and licence. Repeated rows
    are each looked up. Lines count from 1, and a line that is all of the text appears both ways.
    Other columns are not read.
    """
    need(docs, id_col, text_col)
    lines = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"))
    units = F.concat(F.array(whole(F.col("lines"))), F.coalesce(F.transform(F.split("lines", "\n"), lambda x: F.trim(x)), F.array()))
    rows = lines.select("doc_id", F.posexplode(units).alias("line", "canonical")).filter("line = 0 OR canonical <> ''")
    rows = rows.select("doc_id", "line", digest(F.col("canonical")).alias("digest"))
    found = licence_digests(known).select(F.col("digest").alias("known"), "license_id")
    return rows.join(found, F.col("digest") == F.col("known"), "left").filter("line = 0 OR license_id IS NOT NULL").drop("known")
