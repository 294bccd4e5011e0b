"""Licence scans by canonical digests.

A text is brought into canonical form as a whole: lower case, every run of characters other than
letters and digits a single space, equal spellings unified, copyright statements and a title left
out. Its digest is hash-joined to the digests of known licences, so a text is found when all of it
is the licence, however it is wrapped, also on one line, and never by a part.

A copyright statement begins at "copyright" or a copyright sign that a year, a holder's mark or
another sign follows. It lasts to the end of its paragraph, further lines with holders included,
or to the first words that begin a licence or a condition (``STATEMENT_ENDS``), so that a
condition beside it is never taken for a holder. "All rights reserved" ends it and is left out.
Digests of single lines are joined to known one-line notices in the same way.

Only DataFrame functions run. Line digests are made distinct per text and pre-aggregated before
anything is shuffled; known texts are broadcast up to a checked number and shuffled beyond it.

Defined cases: a null or empty text, or one of copyright statements alone, has no licence;
canonical collisions of known texts keep the name that sorts first; repeated rows are scanned
alike; other columns stay out of the way; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.licence_texts import LICENCES, NOTICES, SPELLINGS, STATEMENT_ENDS

MOST_NOTICES = 200
MOST_BROADCAST = 10_000  # known licences; longer lists are joined without a hint
PARAGRAPH = "\x1f"  # no letter or digit, so it is in no canonical text
# the end of a statement is part of the match and put back
STATEMENT = rf" copyright(?: copyright| [0-9]+| by| year| yyyy)+(?: [^\x1f]*?)??(\x1f|$| (?:{'|'.join(STATEMENT_ENDS)}) )"
TITLE = r"^(?:(?:the )?(?:[a-z0-9]+ ){0,6}?license(?: mit| isc| bsd| 0bsd| zlib)?(?: version [0-9]+(?: [0-9])?)? ){1,2}"  # as "The MIT License (MIT)"


def canonical_lines(text: Column) -> Column:
    """The canonical form of the text, its lines kept apart by line feeds."""
    marked = F.replace(F.replace(F.lower(text), F.lit("©"), F.lit(" copyright ")), F.lit("(c)"), F.lit(" copyright "))
    words = F.regexp_replace(F.regexp_replace(marked, r"\r\n?", "\n"), r"[^\p{L}\p{N}\n]+", " ")
    for spelling, usual in SPELLINGS.items():
        words = F.replace(words, F.lit(spelling), F.lit(usual))
    return F.regexp_replace(words, " ?\n ?", "\n")


def canonical_text(lines: Column) -> Column:
    """The canonical form without line breaks, copyright statements and title."""
    words = F.regexp_replace(F.regexp_replace(lines, "\n{2,}", f" {PARAGRAPH} "), "\n", " ")
    for spelling, usual in SPELLINGS.items():
        if " " in spelling:  # its words may have stood on two lines
            words = F.replace(words, F.lit(spelling), F.lit(usual))
    words = F.replace(F.concat(F.lit(" "), words), F.lit(" all rights reserved"), F.lit(f" {PARAGRAPH}"))
    joined = F.trim(F.regexp_replace(F.regexp_replace(words, STATEMENT, " $1"), rf"[ {PARAGRAPH}]+", " "))
    return F.regexp_replace(joined, TITLE, "")


def _digest(lines: Column) -> Column:
    """Digest of the whole text; null when nothing is left."""
    return F.sha2(F.nullif(canonical_text(lines), F.lit("")), 256)


def _known(documents: DataFrame, named_texts: Iterable[tuple[str, str]], digest) -> DataFrame:
    """(digest, name) of known texts."""
    rows = documents.sparkSession.createDataFrame(list(named_texts), "name string, text string")
    return rows.groupBy(digest(canonical_lines(F.col("text"))).alias("digest")).agg(F.min("name").alias("name"))


def scan(documents: DataFrame, licences: Mapping[str, str] = LICENCES, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """(doc_id, licence, notices): the licence that the whole text is, and the sorted names of the
    notices among its lines, joined by commas (empty when there is none)."""
    if len(notices) > MOST_NOTICES:
        raise ValueError(f"more than {MOST_NOTICES} notices: pass long lists as licences, which are joined")
    read = documents.select("doc_id", canonical_lines(F.coalesce("text", F.lit(""))).alias("lines"))
    line_digests = F.array_distinct(F.transform(F.split("lines", "\n"), lambda line: F.md5(F.trim(line))))
    digests = read.select("doc_id", _digest(F.col("lines")).alias("digest"), line_digests.alias("line_digests"))
    known = _known(documents, licences.items(), _digest)
    known = F.broadcast(known) if len(licences) <= MOST_BROADCAST else known
    found = digests.join(known, "digest", "left").withColumnRenamed("name", "licence")
    # notices are few: they are looked up where the line is, and no line is shuffled
    book = {r["digest"]: r["name"] for r in _known(documents, [(name, text) for text, name in notices.items()], lambda known: F.md5(F.trim(known))).collect()}
    names = F.lit("")
    if book:
        hits = F.array_intersect("line_digests", F.array(*map(F.lit, book)))
        places = F.create_map(*[F.lit(x) for pair in book.items() for x in pair])
        names = F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda digest: places[digest]))), ",")
    return found.select("doc_id", "licence", names.alias("notices"))
