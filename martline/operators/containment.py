"""Pairs of texts and terms found by an inverted index (J9, J10, F12), without comparing every text with every term.

A text that contains a term contains every q-gram of it, and with a whole-word
match every word of it.  So each term is looked up under one entry only, the
q-gram or word that fewest texts have, and the pairs that meet there are
verified once.  Index entries are narrow rows (entry, text id) of the entries
that occur in terms; both sides may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.text import word_match

#: Length of the q-grams; shorter terms are looked up under themselves.
Q = 4


def _looked_up(entries: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, pid) pairs that meet at the rarest entry of ``wanted`` (pid, entry); a term with an entry that no text has meets none."""
    there = entries.join(wanted.select("entry").distinct(), "entry")
    counts = there.groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    known = wanted.join(counts, "entry", "left")
    best = known.groupBy("pid").agg(F.min_by("entry", F.struct(F.coalesce("n", F.lit(0)), "entry")).alias("entry"))
    return there.join(best, "entry").select("id", "pid")


def _grams(value: Column, length: Column) -> Column:
    """Distinct substrings of ``length``."""
    at = F.sequence(F.lit(1), F.length(value) - length + 1)
    return F.array_distinct(F.transform(at, lambda i: F.substring(value, i, length)))


def _named(df: DataFrame, col: str, out: str, name: str) -> DataFrame:
    """Distinct non-empty values with an id."""
    d = df.select(F.col(f"`{col}`").alias(out)).where(F.length(F.col(out)) > 0).distinct()
    return d.withColumn(name, F.md5(F.col(out)))


def contained(texts: DataFrame, text_col: str, terms: DataFrame, term_col: str, q: int = Q) -> DataFrame:
    """Distinct (text, term) where the text contains the term in any case (nulls and empty values left out)."""
    t, p = _named(texts, text_col, "text", "id"), _named(terms, term_col, "term", "pid")
    # lower case may change a value's length, so grams are taken of the lowered value
    low = p.withColumn("low", F.lower("term")).withColumn("len", F.least(F.length("low"), F.lit(q)))
    wanted = low.select("pid", F.explode(_grams(F.col("low"), F.col("len"))).alias("entry"))
    lengths = low.select("len").distinct()
    lowered = t.select("id", F.lower("text").alias("low")).where(F.length("low") > 0)
    # at most q lengths are looked for
    at = lowered.select("id", "low", F.explode(F.sequence(F.lit(1), F.least(F.length("low"), F.lit(q)))).alias("len")).join(F.broadcast(lengths), "len", "left_semi")
    entries = at.select("id", F.explode(_grams(F.col("low"), F.col("len"))).alias("entry"))
    met = _looked_up(entries, wanted)
    return (met.join(t, "id").join(p, "pid").where(F.lower("text").contains(F.lower("term"))).select("text", "term"))


def whole_words(texts: DataFrame, text_col: str, terms: DataFrame, term_col: str) -> DataFrame:
    """Distinct (text, term) where the term stands in the text as whole words, in its own case."""
    t, p = _named(texts, text_col, "text", "id"), _named(terms, term_col, "term", "pid")
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"([A-Za-z0-9_]+)")))
    spelled = p.withColumn("words", words(F.col("term")))
    wanted = spelled.select("pid", F.explode("words").alias("entry"))
    entries = t.select("id", F.explode(words(F.col("text"))).alias("entry"))
    met = _looked_up(entries, wanted).join(t, "id").join(p, "pid").select("text", "term")
    # terms without an ASCII word have no entry there: their characters are looked up
    other = contained(texts, text_col, spelled.where(F.size("words") == 0), "term")
    return met.unionByName(other).where(word_match("text", "term"))
