"""The structured-extraction step: cache, calls to a pluggable model, retries, validation, result rows."""

from __future__ import annotations

import asyncio
import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeweave import schemas
from citeweave.functions import extraction as E
from citeweave.operators.curate import with_key


@dataclass(frozen=True)
class Reply:
    text: str
    usage_in: int = 0
    usage_out: int = 0


class Extractor(Protocol):
    """Anything that answers a prompt.  ``json_mode`` asks for a JSON object; ValueError("response_format ...") says it can't."""

    async def complete(self, endpoint: str, system: str, user: str, temperature: float, max_tokens: int, json_mode: bool) -> Reply: ...


@dataclass(frozen=True)
class Settings:
    model: str = "offline-stub"
    endpoints: tuple[str, ...] = ("local",)
    api_key: str = field(default_factory=lambda: os.environ.get("EXTRACTOR_API_KEY", "none"), repr=False)
    temperatures: tuple[float, ...] = (0.0, 0.3, 0.6, 0.9)
    max_retry: int = 3
    max_tokens: int = 2048
    concurrency: int = 16
    prompt_version: str = "v1"


class Stub:
    """An extractor without a network: what it answers follows from the prompt's digest alone.

    ``bad_share`` of the prompts get broken replies at first, so that retries have something to do.
    """

    def __init__(self, bad_share: float = 0.0):
        self.bad_share = bad_share

    async def complete(self, endpoint, system, user, temperature, max_tokens, json_mode) -> Reply:
        n = int(hashlib.sha256(user.encode()).hexdigest()[:8], 16)
        pick = lambda name, k: E.CHOICES[name][(n >> k) % len(E.CHOICES[name])]
        relevance = pick("relevance_check", 0)
        match = relevance == "match"
        record = {
            "relevance_check": relevance,
            "mismatch_reason": "" if match else "The abstract is about something else.",
            "attributed_claim": "A claim." if match else "",
            "citation_purpose": pick("citation_purpose", 3),
            "evidence_type": pick("evidence_type", 6),
            "support_strength": pick("support_strength", 9) if match else "insufficient-context",
            "cited_study_design": pick("cited_study_design", 12),
            "question": "What is claimed?" if match else "",
            "answer": "What the sentence says." if match else "",
            "answer_grounded_in": ["both"] if match else [],
            "evidence_quote_from_cited": "",
            "statistic_extraction": None,
        }
        text = json.dumps(record)
        if (n >> 16) % 1000 < self.bad_share * 1000 and temperature == 0.0:
            text = ("", "{broken", '{"relevance_check": "maybe"}')[n % 3]
        return Reply(f"```json\n{text}\n```" if n % 2 else text, len(user) // 4, len(text) // 4)


class ChatEndpoint:
    """An extractor over HTTP: each endpoint is a base URL that serves ``/chat/completions`` with JSON in and out.

    Calls wait in threads, so that as many are under way as the settings allow.  An answer of 4xx or 5xx is an error whose
    text is the body, in which a server says that it has no JSON mode.
    """

    def __init__(self, model: str, api_key: str = "none", timeout: float = 300.0):
        self.model, self.api_key, self.timeout = model, api_key, timeout

    def request(self, system: str, user: str, temperature: float, max_tokens: int, json_mode: bool) -> dict:
        body = {"model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], "temperature": temperature, "max_tokens": max_tokens}
        return body | ({"response_format": {"type": "json_object"}} if json_mode else {})

    def _post(self, endpoint: str, body: dict) -> Reply:
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"}
        asked = urllib.request.Request(f"{endpoint.rstrip('/')}/chat/completions", json.dumps(body).encode(), headers)
        try:
            with urllib.request.urlopen(asked, timeout=self.timeout) as answer:
                found = json.load(answer)
        except urllib.error.HTTPError as error:
            raise ValueError(f"{error.code}: {error.read().decode(errors='replace')}") from error
        usage = found.get("usage") or {}
        return Reply(found["choices"][0]["message"].get("content") or "", usage.get("prompt_tokens", 0), usage.get("completion_tokens", 0))

    async def complete(self, endpoint, system, user, temperature, max_tokens, json_mode) -> Reply:
        return await asyncio.to_thread(self._post, endpoint, self.request(system, user, temperature, max_tokens, json_mode))


_CALL = "cache_key string, ok boolean, raw_text string, data string, usage_in int, usage_out int, spent_in int, spent_out int, latency_s double, attempts int, error_kind string, error string"


def broken_field(record) -> str | None:
    """The first field that breaks the record's rules, by the same rules as ``functions.extraction.problems``."""
    if not isinstance(record, dict):
        return "record"
    for name in E.REQUIRED:
        if not isinstance(record.get(name), str):
            return name
    for name in E.CAPPED:
        if not isinstance(record.get(name, ""), str) or len(record.get(name, "")) > E.CAP:
            return name
    for name, allowed in E.CHOICES.items():
        values = record.get(name, []) if name == "answer_grounded_in" else [record[name]]
        if not isinstance(values, list) or any(v not in allowed for v in values):
            return name
    s = record.get("statistic_extraction")
    if s is not None:
        fine = isinstance(s, dict) and all(isinstance(s.get(k), str) for k in ("metric", "value")) and all(isinstance(s.get(k, ""), str) for k in ("ci_or_range", "p_value"))
        if not fine:
            return "statistic_extraction"
        if s.get("n_subjects") is not None:
            try:
                if isinstance(s["n_subjects"], bool) or float(s["n_subjects"]) % 1:
                    return "statistic_extraction"
            except (TypeError, ValueError):
                return "statistic_extraction"
    return None


async def _answer(extractor: Extractor, settings: Settings, system: str, key: str, user: str, turn: int, mode: dict) -> tuple:
    began, kind, said, raw, spent = time.time(), "api_error", "", "", [0, 0]
    for attempt in range(settings.max_retry + 1):
        temperature = settings.temperatures[min(attempt, len(settings.temperatures) - 1)]
        endpoint = settings.endpoints[(turn + attempt) % len(settings.endpoints)]
        try:
            reply = await extractor.complete(endpoint, system, user, temperature, settings.max_tokens, mode["json"])
        except Exception as error:  # whatever a client raises counts as a failed call
            kind, said = "api_error", str(error)
            if "response_format" in said:
                mode["json"] = False
            continue
        spent[0], spent[1], raw = spent[0] + reply.usage_in, spent[1] + reply.usage_out, reply.text
        if not reply.text.strip():
            kind, said = "empty", "no text"
            continue
        try:
            record = E.loads(reply.text)
        except ValueError as error:
            kind, said = "json_parse", str(error)
            continue
        if wrong := broken_field(record):
            kind, said = "schema_invalid", f"field {wrong}"
            continue
        return key, True, raw, E.dumps(record), reply.usage_in, reply.usage_out, *spent, round(time.time() - began, 3), attempt + 1, None, None
    return key, False, raw, None, 0, 0, *spent, round(time.time() - began, 3), settings.max_retry + 1, kind, said[:500]


def calls(prompts: DataFrame, extractor: Extractor, settings: Settings, system: str) -> DataFrame:
    """Answers to (cache_key, user): inside each partition up to ``concurrency`` calls are under way at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mode = {"json": True}

        async def batch(rows):
            gate = asyncio.Semaphore(settings.concurrency)

            async def one(i, key, user):
                async with gate:
                    return await _answer(extractor, settings, system, key, user, i, mode)

            return await asyncio.gather(*[one(i, k, u) for i, (k, u) in enumerate(rows)])

        for frame in frames:
            found = asyncio.run(batch(zip(frame["cache_key"], frame["user"], strict=True)))
            yield pd.DataFrame(found, columns=[c.split()[0] for c in _CALL.split(", ")])

    return prompts.select("cache_key", "user").mapInPandas(run, _CALL)


CACHE = "key string, raw string, data string"


def undone(records: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Records (line_idx, citing, context, cited) that no earlier result has, failed ones included; the limit comes first."""
    some = records.filter(F.col("line_idx") < limit) if limit is not None else records
    keyed = with_key(some.withColumn("input", F.struct("citing", "context", "cited")))
    return keyed.join(with_key(done).select("record_key").distinct(), "record_key", "left_anti")


def extract(records: DataFrame, cache: DataFrame, extractor: Extractor, settings: Settings = Settings(), save: Callable[[DataFrame], DataFrame] = lambda d: d) -> tuple[DataFrame, DataFrame]:
    """(results, new cache rows) for records with ``input``.

    A prompt in the cache is answered from it with 0 attempts; each other prompt is sent once, however many records have
    it.  ``save`` should write what it is given and read it again, so that calls aren't repeated by a lost executor.
    """
    system = E.system_prompt()
    user = E.user_prompt(F.col("input.citing"), F.col("input.context"), F.col("input.cited"))
    asked = records.withColumn("user", user).withColumn("cache_key", E.cache_key(settings.model, system, F.col("user")))
    stored = cache.select(F.col("key").alias("cache_key"), F.col("raw").alias("c_raw"), F.col("data").alias("c_data"))
    looked = asked.join(stored, "cache_key", "left")
    missing = looked.filter("c_data is null").groupBy("cache_key").agg(F.first("user").alias("user"))
    answers = save(calls(missing, extractor, settings, system))
    both = looked.join(answers, "cache_key", "left")
    hit = F.col("c_data").isNotNull()
    ok = hit | F.coalesce("ok", F.lit(False))
    data = F.coalesce("c_data", "data")
    generator = F.struct(F.lit(settings.model).alias("model"), F.lit(settings.prompt_version).alias("prompt_version"), F.unix_micros(F.current_timestamp()).cast("double").__truediv__(1e6).alias("ts"))
    zero = lambda c: F.when(hit, F.lit(0)).otherwise(F.col(c)).cast("int").alias(c)
    results = both.select(
        "input", ok.alias("ok"), F.coalesce("c_raw", "raw_text").alias("raw_text"), zero("usage_in"), zero("usage_out"),
        F.when(hit, F.lit(0.0)).otherwise(F.col("latency_s")).alias("latency_s"), zero("attempts"), generator.alias("generator"),
        "error_kind", "error", F.when(ok, E.typed(data)).alias("extracted"), F.when(ok, data).alias("payload"),
    )
    return results, answers.filter("ok").select(F.col("cache_key").alias("key"), F.col("raw_text").alias("raw"), "data")


def merged_cache(old: DataFrame, new: DataFrame) -> DataFrame:
    """Cache rows with the newer one of a key."""
    rows = old.withColumn("age", F.lit(1)).unionByName(new.withColumn("age", F.lit(0)))
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("age"))).filter("n = 1").select("key", "raw", "data")


def call_counts(results: DataFrame) -> DataFrame:
    """Tokens and failures by kind."""
    return results.groupBy(F.coalesce("error_kind", F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.sum("usage_in").alias("usage_in"), F.sum("usage_out").alias("usage_out"))


def quality_flags(results: DataFrame) -> DataFrame:
    """What the record's description asks for but validation lets pass: a quote that isn't in the abstract, a statistic without numbers."""
    from citeweave.functions.text import grounded

    x = F.col("extracted")
    return results.withColumn("quote_in_abstract", grounded(x["evidence_quote_from_cited"], F.col("input.cited.abstract"))).withColumn("statistic_missing", (x["evidence_type"] == "statistic") & x["statistic_extraction"].isNull())


RESULT = schemas.RESULT
