"""Prompts, JSON recovery, validation, cache keys and chat turns for the structured-extraction step."""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeweave import schemas
from citeweave.functions.values import or_empty, or_none

# What the record's closed fields may hold, which fields it must have, which are capped, and its scalar fields in the order of an answer.
CHOICES = {
    "relevance_check": ("match", "ambiguous", "mismatch"),
    "citation_purpose": ("background", "method", "result-support", "comparison", "contrast", "negative", "other"),
    "evidence_type": ("direct-quote", "paraphrase", "statistic", "method-citation", "generic-background", "other"),
    "support_strength": ("strong", "moderate", "weak", "insufficient-context"),
    "cited_study_design": ("rct", "non-randomized-trial", "prospective-cohort", "retrospective-cohort", "case-control", "cross-sectional", "observational", "case-series", "case-report", "systematic-review", "meta-analysis", "guideline", "preclinical", "other"),
    "answer_grounded_in": ("evidence_sentence", "cited_abstract", "both"),
}
REQUIRED = ("relevance_check", "attributed_claim", "citation_purpose", "evidence_type", "support_strength", "cited_study_design", "question", "answer")
CAPPED, CAP = ("attributed_claim", "question", "answer", "evidence_quote_from_cited", "mismatch_reason"), 1500
SCALARS = ("relevance_check", "mismatch_reason", "attributed_claim", "citation_purpose", "evidence_type", "support_strength", "cited_study_design", "question", "answer", "evidence_quote_from_cited")


#: Fixed value: a reply's code fence.
FENCE = r"(?i)^```(?:json)?\s*|\s*```$"


def loads(text: str):
    """The JSON value of a reply: of the reply without code fences, else from its first { to its last }; ValueError without one."""
    bare = re.sub(FENCE, "", text.strip()).strip()
    try:
        return json.loads(bare)
    except ValueError:
        first, last = bare.find("{"), bare.rfind("}")
        if 0 <= first < last:
            return json.loads(bare[first : last + 1])
        raise


def dumps(record) -> str:
    """A record as strict JSON: of a repeated key the last value, for numbers that JSON lacks null."""

    def strict(x):
        if isinstance(x, dict):
            return {k: strict(v) for k, v in x.items()}
        if isinstance(x, list):
            return [strict(v) for v in x]
        return None if isinstance(x, float) and not math.isfinite(x) else x

    return json.dumps(strict(record), ensure_ascii=False)


@F.pandas_udf(T.StringType())
def _rescued(texts: pd.Series) -> pd.Series:
    """The object that ``loads`` finds, as strict JSON, or null."""

    def one(text):
        try:
            found = loads(text)
        except ValueError:
            return None
        return dumps(found) if isinstance(found, dict) else None

    return texts.map(one, na_action="ignore")


def recovered(text: Column) -> Column:
    """The JSON object in a model's reply as text, or null, as ``loads`` finds it.

    Strict JSON stays as it is and never leaves the JVM; only replies with a brace that aren't (repeated keys, NaN, or no JSON) go to Python.
    """
    bare = F.trim(F.regexp_replace(F.trim(text), FENCE, ""))
    first = F.locate("{", bare)
    span = F.substring(bare, first, F.length(bare) - F.locate("}", F.reverse(bare)) - first + 2)
    strict = lambda t: F.try_parse_json(t).isNotNull()
    plain = F.when(strict(bare), F.when(bare.startswith("{"), bare))
    # A list or a number is a value of its own: what stands inside is not looked for.
    open_case = ~strict(bare) & (first > 0)
    inner = F.when(open_case & (F.locate("}", bare) > first) & ~bare.startswith("[") & strict(span), span)
    return F.coalesce(plain, inner, _rescued(F.when(open_case & inner.isNull(), text)))


def _field(payload: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(payload, f"$.{name}", kind)


def problems(text: Column) -> Column:
    """Names of the fields of a JSON record that break the record's rules; an array, empty for a valid record.

    The text is parsed once and bound to a lambda's variable, as each rule would parse it anew.
    """
    names = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    once = F.array(F.struct(F.try_parse_json(text).alias("v"), names.alias("names")))
    return F.get(F.transform(once, lambda x: _broken_rules(x["v"], x["names"])), 0)


def _broken_rules(v: Column, names: Column) -> Column:
    kind = lambda name: F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))
    is_text = lambda name: F.coalesce(kind(name) == "STRING", F.lit(False))
    absent = lambda name: ~F.array_contains(names, name)
    bad: dict[str, Column] = {}
    for name in REQUIRED:
        bad[name] = ~is_text(name)
    for name in ("mismatch_reason", "evidence_quote_from_cited"):
        bad[name] = ~(absent(name) | is_text(name))
    for name in CAPPED:
        bad[name] = bad[name] | (F.coalesce(F.length(_field(v, name)), F.lit(0)) > CAP)
    for name, allowed in CHOICES.items():
        if name == "answer_grounded_in":
            listed = _field(v, name, "array<string>")
            fine = F.forall(listed, lambda x: F.coalesce(x.isin(*allowed), F.lit(False)))
            bad[name] = ~(absent(name) | F.coalesce(fine, F.lit(False)))
        else:
            bad[name] = bad[name] | ~F.coalesce(_field(v, name).isin(*allowed), F.lit(False))
    s = "statistic_extraction"
    part = lambda name: F.schema_of_variant(F.try_variant_get(v, f"$.{s}.{name}", "variant"))
    whole = (part("metric") == "STRING") & (part("value") == "STRING")
    soft = lambda name: part(name).isNull() | (part(name) == "STRING")
    number = part("n_subjects").isNull() | part("n_subjects").isin("VOID", "BIGINT") | F.coalesce(F.try_variant_get(v, f"$.{s}.n_subjects", "string").rlike(r"^\s*[+-]?[0-9]+(\.0*)?\s*$"), F.lit(False))
    nothing = kind(s).isNull() | (kind(s) == "VOID")
    bad[s] = ~F.coalesce(nothing | (whole & soft("ci_or_range") & soft("p_value") & number), F.lit(False))
    return F.array_compact(F.array(*[F.when(b, F.lit(name)) for name, b in bad.items()]))


def typed(text: Column) -> Column:
    """The record with its types; absent fields are null, other fields stay in the text."""
    return F.from_json(text, schemas.EXTRACTED)


def cache_key(model: Column | str, system: Column | str, user: Column) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.sha2(F.concat_ws("\0", lit(model), lit(system), user), 256)


#: The blocks of a prompt in order: heading, and label and field of each entry.  A field is a path below citing, context or cited.
PROMPT = (
    ("CITED ABSTRACT", (("text", "cited.abstract"),)),
    ("CITED WORK", (("title", "cited.title"), ("venue", "cited.journal"), ("published", "cited.year"), ("pubmed", "cited.pmid"), ("doi", "cited.doi"), ("kinds", "cited.pub_types"), ("subjects", "cited.mesh"), ("impact", "cited.icite"))),
    ("SENTENCE WITH THE CITATION", (("text", "context.evidence_sentence"), ("heading", "context.section"), ("part", "context.section_bucket"), ("works cited here", "context.n_co_cited_refs"))),
    ("CITING WORK", (("title", "citing.title"), ("venue", "citing.journal"), ("published", "citing.year"), ("pubmed", "citing.pmid"), ("pmc", "citing.pmcid"))),
)
ASK = "Answer with the one JSON object that the instructions describe. Quotes are copied from the abstract letter by letter."


def user_prompt(citing: Column, context: Column, cited: Column, abstract_chars: int = 3500, headings: int = 15, kinds: int = 8) -> Column:
    """The blocks of ``PROMPT``: a heading in brackets, then ``label = value`` for each entry that has a value."""
    whole = {"citing": citing, "context": context, "cited": cited}

    def value(path: str) -> Column:
        part, name = path.split(".")
        c = whole[part][name]
        if name in ("mesh", "pub_types"):
            return F.nullif(F.array_join(F.slice(F.coalesce(c, F.array()), 1, headings if name == "mesh" else kinds), "; "), F.lit(""))
        if name == "icite":
            of = lambda label, field: F.concat(F.lit(f"{label} "), or_none(c[field]))
            return F.when(c.isNotNull(), F.concat_ws(", ", of("cited", "citation_count"), of("ratio", "relative_citation_ratio"), of("clinical", "is_clinical")))
        if name == "abstract":
            return F.coalesce(F.nullif(F.substring(c, 1, abstract_chars), F.lit("")), F.lit("(not given)"))
        return F.nullif(c.cast("string"), F.lit(""))

    blocks = []
    for heading, entries in PROMPT:
        lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{label} = "), v)) for label, v in ((label, value(path)) for label, path in entries)]
        blocks.append(F.array_join(F.array_compact(F.array(F.lit(f"[{heading}]"), *lines)), "\n"))
    return F.concat_ws("\n\n", *blocks, F.lit(ASK))


def system_prompt() -> str:
    """Instructions, the record's schema, and an example of a match and of a mismatch; rendered once on the driver."""
    text = {"type": "string"}
    properties: dict = {name: {"type": "string", "enum": list(allowed)} for name, allowed in CHOICES.items() if name != "answer_grounded_in"}
    properties |= {name: text | {"maxLength": CAP} for name in CAPPED}
    properties["answer_grounded_in"] = {"type": "array", "items": {"enum": list(CHOICES["answer_grounded_in"])}}
    properties["statistic_extraction"] = {"type": ["object", "null"], "properties": {"metric": text, "value": text, "ci_or_range": text, "p_value": text, "n_subjects": {"type": ["integer", "null"]}}, "required": ["metric", "value"]}
    match = dict.fromkeys(SCALARS, "") | {"relevance_check": "match", "attributed_claim": "Drug X lowers blood pressure.", "citation_purpose": "result-support", "evidence_type": "paraphrase", "support_strength": "strong", "cited_study_design": "rct", "question": "What does drug X do to blood pressure?", "answer": "It lowers it.", "evidence_quote_from_cited": "drug X lowered blood pressure", "answer_grounded_in": ["both"], "statistic_extraction": None}
    other = dict.fromkeys(SCALARS, "") | {"relevance_check": "mismatch", "mismatch_reason": "The cited paper is about soil.", "citation_purpose": "other", "evidence_type": "other", "support_strength": "insufficient-context", "cited_study_design": "other", "answer_grounded_in": [], "statistic_extraction": None}
    parts = [
        "You read a sentence of a paper that cites another paper, and the cited paper's abstract. Say what is claimed, how it is presented, and how well the abstract supports it.",
        "If the cited paper has nothing to do with the sentence, relevance_check is mismatch, support_strength is insufficient-context, and question, answer and quote are empty. A record with a number has evidence_type statistic and fills statistic_extraction.",
        "Schema:\n" + json.dumps({"type": "object", "properties": properties, "required": list(REQUIRED)}, indent=2),
        "Example of a match:\n" + json.dumps(match, indent=2),
        "Example of a mismatch:\n" + json.dumps(other, indent=2),
    ]
    return "\n\n".join(parts)


def chat(system: Column | str, sentence: Column, abstract: Column, record: dict[str, Column], grounded_json: Column, statistic_json: Column) -> Column:
    """Three turns; ``record`` has the ten scalar fields, the two JSON columns default to [] and null."""
    system = F.lit(system) if isinstance(system, str) else system
    keep = {"ignoreNullFields": "false"}
    grounds = F.from_json(F.coalesce(F.nullif(grounded_json, F.lit("")), F.lit("[]")), "array<string>")
    statistic = F.from_json(F.nullif(statistic_json, F.lit("")), schemas.STATISTIC)
    user = F.to_json(F.struct(sentence.alias("citing_sentence"), abstract.alias("cited_abstract")), keep)
    answer = F.to_json(F.struct(*[record[name].alias(name) for name in SCALARS], grounds.alias("answer_grounded_in"), statistic.alias("statistic_extraction")), keep)
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", system), turn("user", user), turn("assistant", answer))
