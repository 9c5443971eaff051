"""Scan for licences: lines and blocks of lines against templates by the Dice coefficient of word bigrams.

Only DataFrame functions on each row; nothing is shuffled. Texts and templates are normalised alike: lower
case, runs of letters and digits as words. From a template's size follow the least and the most bigrams that
a text may have to reach the threshold, so that most templates are left out before any bigram is compared.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.license_templates import TEMPLATES

_BETWEEN = r"[^\p{L}\p{N}]+"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Least and most bigrams of a text whose Dice coefficient with `size` bigrams may reach the threshold."""
    exact = Fraction(str(threshold))
    return math.ceil(size * exact / (2 - exact)), math.floor(size * (2 - exact) / exact)


def _templates(templates: list[tuple[str, str]], threshold: float) -> Column:
    rows = []
    for number, (license_id, text) in enumerate(templates):
        bigrams = template_bigrams(text)
        least, most = bounds(len(bigrams), threshold)
        rows.append(F.struct(
            F.lit(license_id).alias("license_id"), F.lit(number).alias("template"), F.lit(least).alias("least"),
            F.lit(most).alias("most"), F.array(*map(F.lit, bigrams)).alias("bigrams")))
    return F.array(*rows)


def units(docs: DataFrame) -> DataFrame:
    """doc_id, unit (`line` or `block`), unit_no (from 0) and body: every line, and every block of several
    lines between blank lines."""
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    lines = F.transform(F.split("text", "\n"), lambda body, i: F.struct(
        F.lit("line").alias("unit"), i.cast("bigint").alias("unit_no"), body.alias("body")))
    blocks = F.filter(F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda body, i: F.struct(
        F.lit("block").alias("unit"), i.cast("bigint").alias("unit_no"), body.alias("body"))),
        lambda u: u["body"].contains("\n"))
    return docs.select(doc_id, F.inline(F.concat(lines, blocks)))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """A row for each line or block of `docs` (doc_id, text) whose Dice coefficient with a template reaches
    `threshold`: doc_id, unit, unit_no, license_id and template (number in the list) of the best one, dice,
    n_bigrams. Of equally good templates the last of the list is named.

    A null or empty text has no row. Repeated rows have their rows each. Other columns are not read.
    """
    smallest = min(bounds(len(template_bigrams(t)), threshold)[0] for _, t in templates)
    # Generators keep a text's words and bigrams in one place; as plain columns they would be made anew for
    # every expression that reads them.
    normal = F.trim(F.regexp_replace(F.lower("body"), _BETWEEN, " "))
    spaces = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    sized = units(docs).select("doc_id", "unit", "unit_no", F.explode(F.array(normal)).alias("words")).where(
        spaces >= smallest)
    bigrams = F.array_distinct(F.regexp_extract_all("words", F.lit(r"(?<!\S)(?=(\S+ \S+))"), F.lit(1)))
    known = sized.select("doc_id", "unit", "unit_no", F.explode(F.array(bigrams)).alias("bigrams"))
    fitting = F.filter(_templates(templates, threshold), lambda t: F.size("bigrams").between(t["least"], t["most"]))
    scored = F.transform(fitting, lambda t: F.struct(
        (F.size(F.array_intersect("bigrams", t["bigrams"])) * 2 / (F.size("bigrams") + F.size(t["bigrams"])))
        .alias("dice"), t["template"].alias("template"), t["license_id"].alias("license_id")))
    return known.withColumn("best", F.array_max(scored)).where(F.col("best.dice") >= threshold).select(
        "doc_id", "unit", "unit_no", "best.license_id", "best.template", "best.dice",
        F.size("bigrams").cast("bigint").alias("n_bigrams"))


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> str:
    """The same scan as a DuckDB query over `documents`."""
    rows = ", ".join("({}, {}, '{}')".format(i, repr(name), text.replace("'", "''"))
                     for i, (name, text) in enumerate(templates))
    bigrams = (r"list_distinct(list_transform(generate_series(1, len(w) - 1), "
               r"lambda i: w[i] || ' ' || w[i + 1]))")
    words = r"list_filter(regexp_split_to_array(lower(body), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return rf"""
WITH split AS (
  SELECT doc_id, 'line' AS unit, string_split(text, chr(10)) AS bodies FROM documents
  UNION ALL
  SELECT doc_id, 'block', regexp_split_to_array(text, '\n[ \t\r]*\n') FROM documents),
units AS (
  SELECT doc_id, unit, generate_subscripts(bodies, 1) - 1 AS unit_no, unnest(bodies) AS body FROM split),
bags AS (
  SELECT doc_id, unit, unit_no, {bigrams} AS b FROM (
    SELECT doc_id, unit, unit_no, {words} AS w FROM units WHERE unit = 'line' OR contains(body, chr(10)))
  WHERE len(w) > 1),
templates AS (
  SELECT template, license_id, {bigrams} AS t FROM (
    SELECT template, license_id, {words} AS w FROM (VALUES {rows}) v(template, license_id, body))),
scored AS (
  SELECT doc_id, unit, unit_no, license_id, template, len(b) AS n_bigrams,
         len(list_intersect(b, t)) * 2 / (len(b) + len(t))::DOUBLE AS dice
  FROM bags, templates)
SELECT doc_id, unit, unit_no, license_id, template, dice, n_bigrams FROM scored
WHERE dice >= {threshold}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, template DESC) = 1"""
