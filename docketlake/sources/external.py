"""Boundaries to the outside: what the engine asks for, and stubs that answer from tables.

Search, crawling, browsers, code libraries, models, OCR and transcription need a
network or libraries that are not part of this package.  Each is an interface whose
answers are rows; the stub answers from a saved table, so that everything around it
runs and is tested.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Searcher(Protocol):
    def search(self, queries: DataFrame) -> DataFrame:
        """``(query)`` to ``(query, body)``: raw response JSON."""


class Fetcher(Protocol):
    def fetch(self, addresses: DataFrame) -> DataFrame:
        """``(url)`` to ``(url, status_code, content, mime_type)``."""


class Model(Protocol):
    def answer(self, requests: DataFrame) -> DataFrame:
        """``(request_id, prompt)`` to ``(request_id, reply, input_tokens, output_tokens, cost)``."""


class Reader(Protocol):
    def read(self, pages: DataFrame) -> DataFrame:
        """``(source_id, page, image)`` to ``(source_id, page, text)``: OCR or transcription."""


@dataclass
class Saved:
    """Answers from a table by a key column; a key without an answer gives a row of nulls."""

    table: DataFrame
    key: str

    def _look(self, asked: DataFrame) -> DataFrame:
        return asked.select(self.key).distinct().join(self.table, self.key, "left")

    search = fetch = answer = read = _look


def request_key(*parts) -> object:
    """Cache key of a request: start of the SHA-256 of its parts."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 24)


def uncached(requests: DataFrame, cache: DataFrame, key: str, max_age_days: int, now: str) -> DataFrame:
    """Requests without an answer that is young enough."""
    young = cache.where(F.col("fetched_at") > F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {max_age_days} days"))
    return requests.join(young.select(key), key, "left_anti")


def response_state(body: object) -> object:
    """``ok``, ``empty`` or ``error`` of a saved search response."""
    error, organic = F.get_json_object(body, "$.error"), F.get_json_object(body, "$.organic_results")
    nothing = F.coalesce(F.lower(error).contains("hasn't returned any results"), F.lit(False)) & (F.get_json_object(body, "$.search_metadata.status") == "Success")
    return F.when(nothing, "empty").when(error.isNotNull() | body.isNull(), "error").when(organic.isNotNull() & organic.startswith("["), "ok").otherwise("error")


@dataclass
class CountingModel:
    """A model for tests: a Python function of the prompt, run in batches on the workers, with usage counted."""

    reply: Callable[[str], str]
    price: float = 0.0
    settings: Mapping = field(default_factory=dict)

    def answer(self, requests: DataFrame) -> DataFrame:
        reply, price = self.reply, self.price

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                replies = [reply(p) for p in pdf["prompt"]]
                tokens_in, tokens_out = [len(p) // 4 + 1 for p in pdf["prompt"]], [len(r) // 4 + 1 for r in replies]
                yield pd.DataFrame({"request_id": pdf["request_id"], "reply": replies, "input_tokens": tokens_in, "output_tokens": tokens_out, "cost": [price * (a + b) / 1e6 for a, b in zip(tokens_in, tokens_out)]})

        return requests.select("request_id", "prompt").mapInPandas(run, "request_id string, reply string, input_tokens bigint, output_tokens bigint, cost double")


def owner_key(*parts: str) -> str:
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()[:8]


def chunk_starts(levels: list[float], step: int = 300, reach: int = 30) -> list[int]:
    """Where to cut a recording: the quietest second within ``reach`` of each ``step`` after the last cut."""
    starts = [0]
    while starts[-1] + step + reach < len(levels):
        mark = starts[-1] + step
        lo, hi = mark - reach, min(mark + reach + 1, len(levels))
        starts.append(min(range(lo, hi), key=lambda i: (levels[i], abs(i - mark))))
    return starts


def cut_points_of(levels: object, step: int = 300, reach: int = 30) -> object:
    """``chunk_starts`` of an array of levels, as a column; null for none."""

    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else chunk_starts(list(x), step, reach) for x in lists])

    return F.pandas_udf(run, "array<int>")(levels)
