"""Boundaries to services outside the engine: fetching pages, language models, traffic reports, encyclopedia lookups.

A provider is any picklable callable from a list of requests to a list of answers (dicts). It runs inside
``mapInPandas``; failures of one request become an error in its row, never a failed task. Tests pass fakes.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Provider = Callable[[list[str]], list[dict | None]]


def call_provider(requests: DataFrame, provider: Provider, answer: str, request_col: str = "request", chunk: int = 100) -> DataFrame:
    """``requests`` with ``answer`` (parsed by the DDL schema) and ``error``."""
    fields = [*requests.schema.fields, T.StructField("__json", T.StringType()), T.StructField("error", T.StringType())]

    def one(r: str) -> tuple[str | None, str | None]:
        try:
            a = provider([r])[0]
            return (None, "no answer") if a is None else (json.dumps(a), None)
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple[str | None, str | None]] = []
            asks = pdf[request_col].tolist()
            for i in range(0, len(asks), chunk):
                part = asks[i : i + chunk]
                try:
                    got = provider(part)
                    if len(got) != len(part):
                        raise ValueError("answers do not fit the requests")
                    out += [(None, "no answer") if a is None else (json.dumps(a), None) for a in got]
                except Exception:  # noqa: BLE001 - find the request that fails
                    out += [one(r) for r in part]
            yield pdf.assign(__json=[j for j, _ in out], error=[e for _, e in out])

    return requests.mapInPandas(run, T.StructType(fields)).withColumn("answer", F.from_json("__json", answer)).drop("__json")


def with_retries(provider: Provider, attempts: int = 3, wait: float = 0.0) -> Provider:
    """The provider with repeated attempts; the last error is raised."""
    def call(asks: list[str]) -> list[dict | None]:
        for k in range(attempts):
            try:
                return provider(asks)
            except Exception:  # noqa: BLE001
                if k + 1 == attempts:
                    raise
                time.sleep(wait)
        return []

    return call


def poll(ready: Callable[[], dict | None], tries: int, wait: float = 0.0) -> dict:
    """Bounded polling: None means not yet; the end of the tries is an error."""
    for _ in range(tries):
        answer = ready()
        if answer is not None:
            return answer
        time.sleep(wait)
    raise TimeoutError(f"no answer after {tries} tries")


#: Generated keywords of one answer.
GENERATION = "brand_name string, vertical string, keywords array<struct<keyword string, type string, specificity string, rationale string>>"
#: Verdicts of one answer.
VERDICTS = "verdicts array<struct<keyword string, accept boolean, reason string>>"


def batch_requests(rows: DataFrame, model: str) -> DataFrame:
    """``custom_id, body`` of a batch job: brand and generation joined by a double pipe, and the JSON body."""
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("messages")))
    return rows.select(F.concat_ws("||", "brand", F.col("generation").cast("string")).alias("custom_id"), body.alias("body"))


def batch_responses(rows: DataFrame, schema: str = GENERATION) -> DataFrame:
    """``brand, generation, answer`` of ``custom_id, status, content``; failed or unreadable answers are null."""
    ok = F.when(F.col("status") == 200, F.from_json("content", schema))
    brand = F.regexp_extract("custom_id", r"(?s)^(.*)\|\|([^|]*)$", 1)
    return rows.select(brand.alias("brand"), F.regexp_extract("custom_id", r"(?s)^(.*)\|\|([^|]*)$", 2).try_cast("int").alias("generation"), ok.alias("answer"))


def explode_generations(responses: DataFrame) -> DataFrame:
    """``brand, generation, pos, keyword, type, specificity, rationale`` of parsed answers."""
    return responses.select("brand", "generation", F.posexplode("answer.keywords").alias("pos", "k")).select("brand", "generation", F.col("pos").cast("long").alias("pos"), "k.*")


def regroup_generations(rows: DataFrame) -> DataFrame:
    """``brand, generation, keywords``: what :func:`explode_generations` gave, in order of ``pos`` again.

    An answer is a bounded list, as one request yields it. Null brands and generations are groups of their own.
    """
    item = F.struct("pos", "keyword", "type", "specificity", "rationale")
    grouped = rows.groupBy("brand", "generation").agg(F.array_sort(F.collect_list(item)).alias("keywords"))
    return grouped.withColumn("keywords", F.transform("keywords", lambda k: k.dropFields("pos")))


def strict_schema(schema: object) -> object:
    """A JSON schema whose objects admit and require exactly the properties that they list, at every depth."""
    if isinstance(schema, list):
        return [strict_schema(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: strict_schema(v) for k, v in schema.items()}
    # A property may itself be called "properties": only objects with a table of properties are closed.
    if out.get("type") == "object" and isinstance(out.get("properties"), dict):
        out |= {"required": sorted(out["properties"], key=list(out["properties"]).index), "additionalProperties": False}
    return out


def response_format(schema: dict, name: str) -> dict:
    """The request parameter that binds an answer to a schema."""
    return {"type": "json_schema", "json_schema": {"name": name, "strict": True, "schema": strict_schema(schema)}}
