"""Keys, buckets, sentences, and grounding of citation records."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave.functions.values import BLANK, first_match, or_none, squeeze

# Section names by pattern, first match wins.
SECTIONS = {
    "introduction": r"\b(introduction|background|overview)\b",
    "methods": r"\b(method|materials|design|experimental|protocol)\b",
    "results": r"\b(result|finding)\b",
    "discussion": r"\b(discussion|conclusion|interpretation|implication)\b",
}
# Specialties by pattern over subject headings, first match wins.
SPECIALTIES = {
    "Neoplasms": r"\b(neoplasm|cancer|carcinoma|tumor|lymphoma|leukemia|sarcoma|melanoma|adenocarcinoma|metastas)",
    "Cardiovascular": r"\b(cardiovascular|heart|cardiac|coronary|myocardial|stroke|hypertension|atrial|vascular|aort)",
    "Infectious": r"\b(infection|bacteria|viral|hiv|tuberculosis|pneumonia|sepsis|hepatitis|covid|influenza|malaria|antimicrobial)",
    "Mental": r"\b(mental|depression|anxiety|schizophren|psychiatric|bipolar|ptsd|suicide)",
    "Endocrine": r"\b(diabetes|thyroid|endocrine|insulin|obesity|metabolic syndrome)",
    "Respiratory": r"\b(respiratory|lung|pulmonary|asthma|bronchitis|copd)",
    "Nervous": r"\b(nervous system|brain|neurol|cognitive|alzheimer|parkinson|epilepsy|multiple sclerosis|dementia)",
    "Pediatric": r"\b(infant|pediatric|child|newborn|neonate)",
}
# Study designs to their groups.
DESIGNS = {
    "rct": "rct",
    "non-randomized-trial": "non-rand-trial",
    "prospective-cohort": "cohort-observational",
    "retrospective-cohort": "cohort-observational",
    "observational": "cohort-observational",
    "case-control": "case-control",
    "cross-sectional": "cross-sectional",
    "guideline": "guideline",
    "systematic-review": "review",
    "meta-analysis": "review",
    "case-series": "case",
    "case-report": "case",
    "preclinical": "preclinical",
    "other": "other",
}
# A sentence ends before white space that a capital, digit or opening bracket follows; identifiers inside raw text.
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z0-9(\[])"
DOI = r"\b10\.\d{4,9}/[^\s\"<>]+"
PMID = r"(?i)pmid[:\s]*([0-9]{4,9})"


def by_pattern(c: Column, patterns: dict[str, str], default: str) -> Column:
    """The name of the first pattern found in ``c``."""
    return reduce(lambda rest, item: F.when(c.rlike(f"(?iu){item[1]}"), item[0]).otherwise(rest), reversed(patterns.items()), F.lit(default))


def section_bucket(name: Column) -> Column:
    return by_pattern(F.coalesce(name, F.lit("")), SECTIONS, "other")


def specialty_bucket(headings: Column, patterns: dict[str, str] = SPECIALTIES, default: str = "Other") -> Column:
    return by_pattern(F.coalesce(F.concat_ws(" | ", headings), F.lit("")), patterns, default)


def design_bucket(design: Column, groups: dict[str, str] = DESIGNS) -> Column:
    table = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.coalesce(design, F.lit("other"))), F.lit("other"))


def stratum(relevance: Column, strength: Column) -> Column:
    """Sampling stratum; null for records whose relevance is none of the three."""
    graded = F.when(strength.isin("strong", "moderate", "weak"), F.concat(F.lit("match_"), strength)).otherwise("ambiguous")
    return F.when(relevance.isin("mismatch", "ambiguous"), relevance).when(relevance == "match", graded)


def report_stratum(relevance: Column, strength: Column) -> Column:
    """Stratum of the split report, where what fits nowhere is ``other``."""
    graded = F.when(strength.isin("strong", "moderate", "weak"), F.concat(F.lit("match_"), strength)).otherwise("other")
    return F.when(relevance.isin("mismatch", "ambiguous"), relevance).when(relevance == "match", graded).otherwise("other")


def record_key(pmcid: Column, pmid: Column, paragraph: Column, sentence: Column, chars: int = 80) -> Column:
    return F.concat(or_none(pmcid), F.lit("|"), or_none(pmid), F.lit("|"), or_none(paragraph), F.lit("|"), F.substring(F.coalesce(sentence, F.lit("")), 1, chars))


def record_id(key: Column) -> Column:
    return F.substring(F.sha2(key, 256), 1, 16)


def hash_share(seed: Column | str, key: Column, of: int = 1000) -> Column:
    """A number below ``of`` from the first 32 bits of a digest of seed and key."""
    seed = F.lit(seed) if isinstance(seed, str) else seed
    return F.conv(F.substring(F.sha2(F.concat(seed, F.lit("|"), key), 256), 1, 8), 16, 10).cast("bigint") % of


def sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_GAP)


def inline_pmid(raw: Column) -> Column:
    return first_match(raw, PMID, 1).try_cast("bigint")


def inline_doi(raw: Column) -> Column:
    return F.rtrim(first_match(raw, DOI), F.lit(".,;)"))


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition, which no built-in function offers."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def loose(text: Column, compose: bool = True) -> Column:
    """Text for comparison: composed, lower-case, one kind of hyphen, single spaces.

    With ``compose`` False nothing leaves the JVM.
    """
    text = F.coalesce(text, F.lit(""))
    # ASCII texts are in composed form already: only others are sent to Python.
    text = F.when(F.octet_length(text) == F.length(text), text).otherwise(nfkc(F.when(F.octet_length(text) != F.length(text), text))) if compose else text
    return squeeze(F.regexp_replace(F.lower(text), "[‐-―-]", "-"))


def grounded(quote: Column, source: Column, compose: bool = True) -> Column:
    """Whether the quote stands in the source, compared loosely; null without a quote."""
    return F.when(F.coalesce(quote, F.lit("")) != "", loose(source, compose).contains(loose(quote, compose)))


def blank_free(text: Column) -> Column:
    return F.regexp_replace(text, BLANK, "")
