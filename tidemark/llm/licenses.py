"""License scans by canonical digest, DataFrame functions only.

A text is brought to a canonical form (case, copyright lines, punctuation, equivalent
spellings), and the digest of the whole form is joined to the digests of known texts. Whole
documents are looked up, and so is every line that speaks of a license, so that a notice at
the end of a document is found as well. The license texts themselves are looked for in all runs of
whole lines, however they are wrapped.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.license_texts import ALL_KNOWN, KNOWN

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# lines that name a holder differ from copy to copy
COPYRIGHT_LINE = r"^[^a-z0-9\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
# Of them those are removed that name a year, a mark or a holder, up to the words that begin a
# license on the same line; lines of a license's own text begin with the word as well.
_BODY = (
    r"\b(?:permission (?:is hereby granted|to use)|redistribution and use|licensed under"
    r"|released under|this software is provided|this is free and unencumbered)\b"
)
_NOT_HOLDER = (
    r"holders?|owners?|notices?|licen[sc]es?|laws?|liable|shall|permission|disclaimers?"
    r"|statements?|conditions?|and|or|in|is|are|treaty|protection|interests?"
)
HOLDER_LINE = (
    r"^[^a-z0-9\n]*(?:copyright[^a-z0-9\n]*(?:\(c\)|©)"
    r"|(?:copyright|\(c\))[^\n]*?\b(?:19|20)[0-9]{2}\b|©"
    rf"|copyright[ \t:]+(?!(?:{_NOT_HOLDER})\b)(?![^\n]*\b(?:liable|shall|notice)\b)"
    r"|all rights reserved(?=[^a-z0-9\n]*$))"
    # possessive, so that a line of any length needs neither a second look nor a deep stack
    rf"(?:(?!{_BODY})[^\n])*+"
)
# words of a known text that is looked for in runs of lines, at least
LONG = 40
# all but ASCII letters and digits, and of the rest of Unicode the no-break space, guillemets, middle
# dot, general punctuation (quotes, dashes, bullets, spaces), CJK punctuation and byte order mark
PUNCTUATION = (
    r"[^a-z0-9\x{80}-\x{9F}\x{A1}-\x{AA}\x{AC}-\x{B6}\x{B8}-\x{BA}\x{BC}-\x{1FFF}"
    r"\x{2070}-\x{2FFF}\x{3040}-\x{FEFE}\x{FF00}-\x{10FFFF}]+"
)
# a first line of at most eight words that speaks of a license
TITLE = r"(?id)\A\s*+(?=[^\n]*licen[sc]e)(?:[^\s]++[ \t]*+){1,8}+\r?\n"

# Spellings that license matching treats as the same word.
SPELLINGS = (
    ("acknowledgment", "acknowledgement"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "wilfull"),
    ("https", "http"),
)


def canonical(text: Column, lines: bool = False) -> Column:
    """The canonical form: words of lower-case letters and digits with a space between them.

    With ``lines`` the line ends stay, as if they were words. A text of nothing but a
    copyright line keeps it.
    """
    lower = F.translate(text, _UPPER, _LOWER)
    plain = F.regexp_replace(lower, "(?dm)" + HOLDER_LINE, " ")
    if lines:
        plain = F.regexp_replace(plain, PUNCTUATION.replace("0-9", "0-9\\n", 1), " ")
        words = F.trim(F.regexp_replace(F.replace(plain, F.lit("\n"), F.lit(" \n ")), " +", " "))
    else:
        words = F.trim(F.regexp_replace(plain, PUNCTUATION, " "))
        kept = F.trim(F.regexp_replace(lower, PUNCTUATION, " "))
        words = F.when(words == "", kept).otherwise(words)
    # two spaces between words, so that neighbours do not share one
    spaced = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for one, other in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {one} "), F.lit(f" {other} "))
    return F.trim(F.replace(spaced, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def _known_texts(spark: SparkSession, known: dict[str, str]) -> DataFrame:
    # a literal per text, so that no Python takes part
    rows = [F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in known.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def known_digests(spark: SparkSession, known: dict[str, str] = ALL_KNOWN) -> DataFrame:
    """(digest, license_id) of the known texts, one row per digest: the smallest id."""
    texts = _known_texts(spark, known)
    found = texts.select(digest(F.col("text")).alias("digest"), "license_id")
    return found.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def _long(known: dict[str, str]) -> dict[str, str]:
    """The license texts without title; a title is a line of its own, and the text below it is
    known as well."""
    return {i: t for i, t in known.items() if len(t.split()) >= LONG and "\n" not in t}


def _in_lines(base: DataFrame, known: dict[str, str]) -> DataFrame:
    """(doc_id, license_id) of the long known texts without title that are whole lines of a text."""
    long = _long(known)
    if not long:
        return base.select("doc_id", F.lit("").alias("license_id")).limit(0)
    # no text holds one of them without its longest word
    spelled = {w for pair in SPELLINGS for w in pair}
    rare = {
        max(set(re.findall("[a-z0-9]+", t.lower())) - spelled, key=lambda w: (len(w), w))
        for t in long.values()
    }
    lower = F.translate(F.col("text"), _UPPER, _LOWER)
    some = base.filter(reduce(Column.__or__, [lower.contains(w) for w in sorted(rare)]))
    form = canonical(F.col("text"))
    wanted = _known_texts(base.sparkSession, long).select(
        "license_id",
        F.concat(
            F.lit("(?:^|\n )"), F.replace(form, F.lit(" "), F.lit("(?: \n)* ")), F.lit("(?= \n|$)")
        ).alias("pattern"),
    )
    lined = some.select("doc_id", canonical(F.col("text"), lines=True).alias("lined"))
    # as many rows as there are known texts
    return lined.join(F.broadcast(wanted), F.expr("lined rlike pattern")).select(
        "doc_id", "license_id"
    )


def scan(docs: DataFrame, known: dict[str, str] = ALL_KNOWN) -> DataFrame:
    """(doc_id, digest, license_id, notices), one row per row of ``docs``.

    ``license_id`` names the known text that the whole document is, be it below a title of its
    own, or is null.
    ``notices`` lists the known texts among its lines that hold "licen", and the long ones
    without title among all runs of its lines, ascending, separated by commas. A null text counts as empty; the empty text is no license. Rows
    that repeat a doc_id share their notices; a row without a doc_id has none. Other
    columns are ignored.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # as many rows as there are known texts
    table = F.broadcast(known_digests(docs.sparkSession, known))
    below = F.when(F.col("text").rlike(TITLE), digest(F.regexp_replace("text", TITLE, "")))
    whole = base.select("doc_id", digest(F.col("text")).alias("digest"), below.alias("below")).join(
        table, "digest", "left"
    )
    long = _long(known)
    if long:
        texts = known_digests(docs.sparkSession, long).withColumnsRenamed(
            {"digest": "below", "license_id": "titled"}
        )
        whole = whole.join(F.broadcast(texts), "below", "left").withColumn(
            "license_id", F.coalesce("license_id", "titled")
        )
    speaks = F.filter(
        F.split("text", "\n"),
        lambda line: F.translate(line, _UPPER, _LOWER).contains("licen"),
    )
    named = base.filter(F.col("doc_id").isNotNull())
    lines = named.select("doc_id", F.explode(speaks).alias("line"))
    notices = (
        lines.select("doc_id", digest(F.col("line")).alias("digest"))
        .join(table, "digest")
        .select("doc_id", "license_id")
        .union(_in_lines(named, known))
        .groupBy("doc_id")
        # bounded by the number of known texts
        .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    )
    return whole.join(notices, "doc_id", "left").select(
        "doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices")
    )


def _sql_canonical(text: str) -> str:
    plain = f"regexp_replace(translate({text}, '{_UPPER}', '{_LOWER}'), '(?m){COPYRIGHT_LINE}', ' ', 'g')"
    words = f"trim(regexp_replace({plain}, '{PUNCTUATION}', ' ', 'g'))"
    spaced = f"' ' || replace({words}, ' ', '  ') || ' '"
    for one, other in SPELLINGS:
        spaced = f"replace({spaced}, ' {one} ', ' {other} ')"
    return f"trim(replace({spaced}, '  ', ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE = f"""
WITH texts(license_id, text) AS (
  VALUES {', '.join(f'({_quoted(i)}, {_quoted(t)})' for i, t in KNOWN.items())}
), known AS (
  SELECT sha256({_sql_canonical('text')}) AS digest, min(license_id) AS license_id
  FROM texts GROUP BY 1
), docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), whole AS (
  SELECT doc_id, sha256({_sql_canonical('text')}) AS digest FROM docs
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs WHERE doc_id IS NOT NULL
), notices AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM lines JOIN known ON known.digest = sha256({_sql_canonical('line')})
  WHERE translate(line, '{_UPPER}', '{_LOWER}') LIKE '%licen%' GROUP BY 1
)
SELECT whole.doc_id, whole.digest, known.license_id, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices ON notices.doc_id = whole.doc_id
"""
