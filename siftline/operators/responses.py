"""Answers of a search model: their text, usage, sources and evidence, decoded relationally from stored JSON.

The external call is billed and has side effects, so a run makes it once, writes the raw answers, and decodes what it
reads back; decoding can be repeated at will.
"""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siftline.functions import values as V
from siftline.operators.merge import SOURCES, sanitized
from siftline.sources import versions

# The fields an answer must have, and how many of its sources count.
ANSWER = "email string, phone string, website string, website_type string, email_source string, phone_source string, website_source string, identity_verified boolean, identity_match_type string, identity_source string"
FIELDS = [x.split()[0] for x in ANSWER.split(", ")]
MAX_SOURCES = 20
FIRST_CAP, SECOND_CAP, GENERATIONS = 600, 1200, 2
# The kinds of website that a model may name.
ASKED_KINDS = ("official_site", "google_maps", "directory", "social_network", "marketplace", "other", "not_found")
#: The strict form that a model is asked to answer in.
FORM = {
    "type": "object",
    "properties": {f: {"type": "boolean"} if f == "identity_verified" else {"type": "string"} for f in FIELDS} | {"website_type": {"type": "string", "enum": list(ASKED_KINDS)}, "identity_match_type": {"type": "string", "enum": list(V.MATCH_TYPES)}},
    "required": FIELDS,
    "additionalProperties": False,
}
_OUTPUT = "array<struct<type: string, action: struct<type: string, sources: array<struct<url: string, url_citation: struct<url: string>>>>, content: array<struct<annotations: array<struct<url: string, url_citation: struct<url: string>>>>>>>"


def _text(raw: Column, path: str) -> Column:
    """A JSON string at ``path``, trimmed; numbers and other kinds are no strings."""
    v = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    return F.when(F.schema_of_variant(v) == "STRING", F.btrim(F.try_variant_get(F.try_parse_json(raw), path, "string")))


def usage_count(raw: Column, path: str) -> Column:
    """A non-negative whole number at ``path``, else 0."""
    v = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    n = F.try_variant_get(F.try_parse_json(raw), path, "long")
    return F.when(F.schema_of_variant(v).isin("BIGINT", "INT", "LONG") & (n >= 0), n).otherwise(F.lit(0)).cast("long")


def usage(raw: Column) -> dict[str, Column]:
    """Token counts of an answer; a total of 0 is input plus output."""
    read = {c: usage_count(raw, f"$.usage.{c}") for c in ("input_tokens", "output_tokens", "total_tokens")}
    both = read["input_tokens"] + read["output_tokens"]
    return read | {"total_tokens": F.when(read["total_tokens"] == 0, both).otherwise(read["total_tokens"])}


def usage_by_row(attempts: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Token counts per ``row_index`` over all its attempts, cut off ones too."""
    counted = attempts.withColumns(usage(F.col(raw_col)))
    return counted.groupBy("row_index").agg(*[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "total_tokens")])


def origin(raw: Column) -> dict[str, Column]:
    """Which answer of which model: trimmed strings, empty where an answer doesn't say."""
    return {name: F.coalesce(_text(raw, path), F.lit("")) for name, path in (("response_id", "$.id"), ("model_snapshot", "$.model"))}


def output(raw: Column) -> Column:
    items = F.get_json_object(raw, "$.output")
    return F.coalesce(F.from_json(items, _OUTPUT), F.from_json(F.lit("[]"), _OUTPUT))


def search_calls(raw: Column) -> Column:
    """Web searches among an answer's items; an action without a type is a search."""
    calls = F.filter(output(raw), lambda x: (x["type"] == "web_search_call") & (F.coalesce(x["action"]["type"], F.lit("search")) == "search"))
    return F.size(calls).cast("long")


def sources(raw: Column) -> Column:
    """Addresses that an answer's searches and citations name, in order, each once, the first twenty."""
    none = F.from_json(F.lit("[]"), "array<struct<url: string, url_citation: struct<url: string>>>")
    listed = lambda item: F.concat(F.coalesce(item["action"]["sources"], none), F.coalesce(F.flatten(F.transform(item["content"], lambda c: F.coalesce(c["annotations"], none))), none))
    urls = F.transform(F.flatten(F.transform(output(raw), listed)), lambda s: F.btrim(F.coalesce(s["url"], s["url_citation"]["url"])))
    return F.slice(F.array_distinct(F.filter(urls, lambda u: u.isNotNull() & (u != ""))), 1, MAX_SOURCES)


def answer_text(raw: Column) -> Column:
    """The text of an answer: ``output_text``, else the texts and JSON of its content items by line, else empty."""
    parts = F.from_json(F.get_json_object(raw, "$.output"), "array<struct<content: array<string>>>")
    value = lambda c: F.coalesce(F.nullif(_text(c, "$.text"), F.lit("")), F.nullif(_text(c, "$.text.value"), F.lit("")), F.when(F.get_json_object(c, "$.json").startswith("{"), F.get_json_object(c, "$.json")))
    texts = F.filter(F.flatten(F.transform(F.coalesce(parts, F.array().cast("array<struct<content: array<string>>>")), lambda p: F.transform(F.coalesce(p["content"], F.array().cast("array<string>")), value))), lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(F.nullif(_text(raw, "$.output_text"), F.lit("")), F.array_join(texts, "\n"))


def is_cut_off(raw: Column) -> Column:
    return F.coalesce((F.get_json_object(raw, "$.status") == "incomplete") & (F.get_json_object(raw, "$.incomplete_details.reason") == "max_output_tokens"), F.lit(False))


_MARKS = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"?|[{}]', re.S)


def first_object(text: str | None) -> str | None:
    """The first balanced JSON object in a text; braces in strings don't count."""
    start, depth = (text or "").find("{"), 0
    for mark in _MARKS.finditer(text, start) if start >= 0 else ():
        depth += {"{": 1, "}": -1}.get(mark[0], 0)
        if not depth:
            return text[start : mark.end()]
    return None


@F.pandas_udf(StringType())
def embedded_object(texts: pd.Series) -> pd.Series:
    return texts.map(first_object)


def decoded(rows: DataFrame, text_col: str = "answer") -> DataFrame:
    """``rows`` with the ten fields of an answer and ``decode_error``: the text as JSON, or the first object in it.

    Keys other than the ten are not taken over. Contacts and evidence are brought to normal form and held to identity.
    """
    is_object = lambda c: F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))
    whole = F.btrim(F.col(text_col))
    chosen = rows.withColumn("_json", F.when(is_object(whole), whole).otherwise(embedded_object(F.col(text_col))))
    parsed = chosen.withColumn("_a", F.when(is_object(F.col("_json")), F.from_json("_json", ANSWER, {"mode": "PERMISSIVE"})))
    good = F.col("_a").isNotNull() & F.coalesce(F.col("_a.identity_match_type"), F.lit("none")).isin(*V.MATCH_TYPES) & F.coalesce(F.col("_a.website_type"), F.lit("not_found")).isin(*V.WEBSITE_TYPES)
    error = F.when(F.col("_a").isNull(), "no JSON object").when(~good, "unknown value").otherwise("")
    return sanitized(parsed.select(*rows.columns, *[F.col(f"_a.{f}").alias(f) for f in FIELDS], error.alias("decode_error")))


def unreadable(raw: DataFrame) -> DataFrame:
    """(row_index, attempt, recorded_at_utc, error_type, answer, raw) of answers that can't be used, for diagnosis: cut
    off, without a JSON object, or with an unknown value."""
    rows = decoded(raw.filter("error_type = ''").withColumn("answer", answer_text(F.col("raw")))).filter("decode_error <> ''")
    why = F.when(is_cut_off(F.col("raw")), "CutOff").when(F.col("decode_error") == "unknown value", "UnknownValue").otherwise("UnreadableAnswer")
    return rows.select("row_index", "attempt", F.current_timestamp().alias("recorded_at_utc"), why.alias("error_type"), "answer", "raw")


def consulted(source: Column, pages: Column) -> Column:
    """Whether a source is among the pages that were looked at, fragments and closing slashes aside."""
    key = V.evidence_key(source)
    return (source != V.MISSING) & F.exists(F.coalesce(pages, F.array().cast("array<string>")), lambda p: V.evidence_key(p) == key)


def evidence_policy(results: DataFrame, pages_col: str = "sources") -> DataFrame:
    """Under audit nothing stands that no consulted page shows: contacts one by one, all of them with the identity."""
    seen = {c: consulted(F.col(s), F.col(pages_col)) for c, s in SOURCES.items()}
    proven = consulted(F.col("identity_source"), F.col(pages_col))
    keep = lambda ok, c, other: F.when(ok, F.col(c)).otherwise(F.lit(other))
    out = {c: keep(ok, c, V.MISSING) for c, ok in seen.items()} | {SOURCES[c]: keep(ok, SOURCES[c], V.MISSING) for c, ok in seen.items()}
    out |= {"identity_verified": proven & F.col("identity_verified"), "identity_match_type": keep(proven, "identity_match_type", "none"), "identity_source": keep(proven, "identity_source", V.MISSING)}
    return sanitized(results.withColumns(out))


def mark_methods(results: DataFrame, method: str = "llm_web_search") -> DataFrame:
    """The method by which found contacts and identities were found."""
    mark = lambda c, ok: F.when(ok, F.lit(method)).otherwise(F.lit(""))
    return results.withColumns({f"{c}_extraction_method": mark(c, F.col(c) != V.MISSING) for c in ("email", "phone")} | {"identity_extraction_method": mark("identity", F.col("identity_verified"))})


def prompts(companies: DataFrame, template: str, unknown: dict[str, str]) -> Column:
    """``template`` with {siret}, {company_name}, {address}, {postal_code} and {city} filled in; absent ones as ``unknown`` says."""
    text: Column = F.lit(template)
    for f in ("siret", "company_name", "address", "postal_code", "city"):
        value = F.col(f) if f in companies.columns else F.lit(None).cast("string")
        text = F.replace(text, F.lit("{" + f + "}"), F.coalesce(F.nullif(value, F.lit("")), F.lit(unknown.get(f, ""))))
    return text


def requests(companies: DataFrame, model: str, instructions: str, template: str, unknown: dict[str, str], context_size: str = "default", audit: bool = False, cap: int = FIRST_CAP, effort: str = "low") -> DataFrame:
    """(row_index, request): the JSON that a provider sends for each company, with the strict form of its answer."""
    tool = F.struct(F.lit("web_search").alias("type"), *([F.lit(context_size).alias("search_context_size")] if context_size != "default" else []))
    fields = [F.lit(model).alias("model"), F.lit(instructions).alias("instructions"), prompts(companies, template, unknown).alias("input"), F.array(tool).alias("tools"), F.lit("required").alias("tool_choice"), F.lit(cap).alias("max_output_tokens")]
    form = json.dumps({"format": {"type": "json_schema", "name": "company_contacts", "strict": True, "schema": FORM}})
    fields += [F.struct(F.lit(effort).alias("effort")).alias("reasoning"), F.from_json(F.lit(form), F.schema_of_json(F.lit(form))).alias("text")]
    fields += [F.array(F.lit("web_search_call.action.sources")).alias("include")] if audit else []
    return companies.select("row_index", F.to_json(F.struct(*fields)).alias("request"))


class Provider(Protocol):
    """Sends a request (JSON text, with an idempotency key) and returns the raw answer (JSON text); may raise."""

    def __call__(self, request: str, key: str) -> str: ...


_SAVED = pa.schema([("row_index", pa.int32()), ("attempt", pa.int32()), ("raw", pa.string()), ("error_type", pa.string()), ("error_message", pa.string()), ("latency_seconds", pa.float64())])


class Retryable(RuntimeError):
    """A provider's error that another try may get past: a timeout, a limit, a server's fault."""


class Pacer:
    """Calls at least ``1 / per_second`` seconds apart, from the moment each may begin; no bound if it is none or 0."""

    def __init__(self, per_second: float | None, now: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.gap, self.now, self.sleep, self.next = (1 / per_second if per_second else 0.0), now, sleep, -math.inf

    def wait(self) -> None:
        at = self.now()
        if at < self.next:
            self.sleep(self.next - at)
        self.next = max(at, self.next) + self.gap


def paced(provider: Provider, pacer: Pacer) -> Provider:
    """``provider`` under a pacer: every request counts, tries and second generations too."""

    def ask(request: str, key: str) -> str:
        pacer.wait()
        return provider(request, key)

    return ask


ANSWERS = "row_index int, attempt int, raw string, error_type string, error_message string, latency_seconds double"
_COLUMNS = [c.split()[0] for c in ANSWERS.split(", ")]


def _dealt(requests: DataFrame, concurrency: int | None, calls_per_second: float | None) -> tuple[DataFrame, float | None]:
    """Requests over as many tasks as may call at once, and each task's part of the calls a second.

    The bound holds because no more than ``concurrency`` tasks exist, however many cores there are.
    """
    if calls_per_second and not concurrency:
        raise ValueError("a bound on calls a second needs a bound on tasks that call at once")
    dealt = requests.select("row_index", "request")
    return (dealt.repartition(concurrency) if concurrency else dealt), calls_per_second / concurrency if calls_per_second else None


def call(requests: DataFrame, make_provider: Callable[[], Provider], tries: int = 3, wait_s: float = 5.0, concurrency: int | None = None, calls_per_second: float | None = None) -> DataFrame:
    """(row_index, attempt, raw, error_type, error_message, latency_seconds) of each request; a row per call.

    Runs on the executors, one client a task; ``concurrency`` is how many tasks call at once, and all of them together
    make at most ``calls_per_second`` calls. An answer cut off at its token cap is asked for once more with twice the cap
    or ``SECOND_CAP``, whichever is more. An answer that can't be used (no JSON object, an unknown value) is generated
    once more, under ``SECOND_CAP`` or its own cap, whichever is more. The latency is measured at the call, with its
    tries and waits. The caller writes the result before using it: reading it twice would bill twice, so the key of a
    call is its row and attempt. ``call_once`` writes answers as they come.
    """
    dealt, share = _dealt(requests, concurrency, calls_per_second)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = paced(make_provider(), Pacer(share))
        for pdf in batches:
            rows = []
            for row, request in zip(pdf["row_index"], pdf["request"], strict=True):
                rows += _generations(provider, int(row), request, tries, wait_s)
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return dealt.mapInPandas(run, ANSWERS)


def call_once(requests: DataFrame, make_provider: Callable[[], Provider], folder: str, tries: int = 3, wait_s: float = 5.0, concurrency: int = 4, calls_per_second: float | None = None, chunk: int = 20) -> DataFrame:
    """What ``call`` gives, saved in ``folder`` by the tasks themselves as it comes, so that a run that breaks off has paid
    for nothing twice: rows with a saved answer are not asked again.

    A task saves after every ``chunk`` rows and, whatever ends it short of a kill, what it holds then; a killed one loses
    less than a chunk, for which a provider has the keys of the calls. A task that is tried again looks up what was saved
    before. Rows saved twice, by tasks that ran twice at once, count once, by the least (error, answer).
    """
    spark, (dealt, share) = requests.sparkSession, _dealt(requests, concurrency, calls_per_second)
    folder = versions.made(spark, folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import dataset, fs, parquet

        store, place = fs.FileSystem.from_uri(folder)
        held: list[tuple] = []

        def save() -> int:
            if not held:
                return 0
            name, rows = uuid.uuid4().hex, {r[0] for r in held}
            parquet.write_table(pa.Table.from_pandas(pd.DataFrame(held, columns=_COLUMNS), _SAVED, preserve_index=False), f"{place}/_{name}", filesystem=store)
            store.move(f"{place}/_{name}", f"{place}/{name}.parquet")
            held.clear()
            return len(rows)

        there: set[int] = set()
        context = TaskContext.get()
        if context is not None and context.attemptNumber() > 0:
            files = [f.path for f in store.get_file_info(fs.FileSelector(place)) if f.path.endswith(".parquet")]
            there = set(dataset.dataset(files, filesystem=store, schema=_SAVED).to_table(["row_index"])["row_index"].to_pylist()) if files else there
        provider = paced(make_provider(), Pacer(share))
        rows = n = 0
        try:
            for pdf in batches:
                for row, request in zip(pdf["row_index"], pdf["request"], strict=True):
                    if int(row) not in there:
                        held += _generations(provider, int(row), request, tries, wait_s)
                        n += 1
                        if n % chunk == 0:
                            rows += save()
        finally:
            rows += save()
        yield pd.DataFrame({"rows": [rows]})

    saved = lambda: spark.read.schema(ANSWERS).parquet(folder)
    left = dealt.join(saved().select("row_index").distinct(), "row_index", "left_anti")
    left.repartition(concurrency).mapInPandas(run, "rows long").agg(F.sum("rows")).collect()
    one = saved().groupBy("row_index", "attempt").agg(F.min(F.struct("error_type", "raw", "error_message", "latency_seconds")).alias("r"))
    return one.select("row_index", "attempt", "r.raw", "r.error_type", "r.error_message", "r.latency_seconds")


def _generations(provider: Provider, row: int, request: str, tries: int, wait_s: float) -> list[tuple]:
    out, body = [], json.loads(request)
    cap = body.get("max_output_tokens", FIRST_CAP)
    for first in (cap, max(SECOND_CAP, cap))[:GENERATIONS]:
        for allowed in (first, max(SECOND_CAP, 2 * first)):
            out.append(_one_call(provider, row, len(out), body | {"max_output_tokens": allowed}, tries, wait_s))
            if out[-1][3]:
                return out
            if not _was_cut(out[-1][2]):
                break
        if _is_usable(out[-1][2]):
            break
    return out


def _one_call(provider: Provider, row: int, attempt: int, body: dict, tries: int, wait_s: float) -> tuple:
    began = time.perf_counter()
    raw, kind, message = None, "", ""
    for n in range(tries):
        try:
            raw, kind, message = provider(json.dumps(body, ensure_ascii=False), f"{row}-{attempt}"), "", ""
            break
        except Retryable as e:
            kind, message = type(e).__name__, str(e)[:500]
            if n + 1 < tries:
                time.sleep(wait_s)
        except Exception as e:  # noqa: BLE001  whatever a provider raises is this row's outcome
            kind, message = type(e).__name__, str(e)[:500]
            break
    return row, attempt, raw, kind, message, time.perf_counter() - began


def _answer(raw: str | None) -> dict:
    try:
        answer = json.loads(raw or "")
    except ValueError:
        return {}
    return answer if isinstance(answer, dict) else {}


def _was_cut(raw: str | None) -> bool:
    answer = _answer(raw)
    return answer.get("status") == "incomplete" and (answer.get("incomplete_details") or {}).get("reason") == "max_output_tokens"


def _is_usable(raw: str | None) -> bool:
    """Whether an answer holds a JSON object whose kinds are known ones."""
    try:
        found = json.loads(first_object(_plain_text(raw or "")) or "")
    except ValueError:
        return False
    return found.get("identity_match_type", "none") in V.MATCH_TYPES and found.get("website_type", "not_found") in V.WEBSITE_TYPES


def _plain_text(raw: str) -> str:
    answer = _answer(raw)
    if answer.get("status") == "incomplete":
        return ""
    if isinstance(answer.get("output_text"), str) and answer["output_text"].strip():
        return answer["output_text"]
    items = answer.get("output") if isinstance(answer.get("output"), list) else []
    found = [c.get("text") for i in items if isinstance(i, dict) for c in i.get("content") or [] if isinstance(c, dict)]
    return "\n".join(t if isinstance(t, str) else t.get("value", "") for t in found if isinstance(t, (str, dict)))


def recorded(answers: dict[str, str]) -> Callable[[], Provider]:
    """A provider that plays stored answers by company number, for offline runs and tests."""

    def make() -> Provider:
        def answer(request: str, key: str) -> str:
            asked = json.loads(request)["input"]
            numbers = (re.sub(r"[^0-9]", "", m) for m in re.findall(r"[0-9](?:[ .\u00a0]?[0-9])+", asked))
            hit = next((n for n in numbers if n in answers), None)
            if hit is None:
                raise KeyError("no recorded answer")
            return answers[hit]

        return answer

    return make
