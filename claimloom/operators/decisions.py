"""Model calls as batch functions: a deterministic keyword backend, adapters, judges; a failing call is a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators import numbering

#: Characters of a section that a model is shown.
MOST_CHARS = 4000
#: A backend takes a batch of states and returns an answer or an exception for each.
Backend = Callable[[list[dict]], list["dict | Exception"]]


def keyword_backend(keyword: str, fail_on: str | None = None) -> Backend:
    """Level 4 where the text holds the keyword, else level 1; texts with ``fail_on`` fail."""

    def answer(states: list[dict]) -> list[dict | Exception]:
        out: list[dict | Exception] = []
        for state in states:
            text = (state.get("text") or "").lower()
            if fail_on and fail_on.lower() in text:
                out.append(ValueError("refused"))
                continue
            level = 4 if keyword.lower() in text else 1
            out.append({"score": float(level), "confidence": 0.9, "choice": "changed_behavior", "probabilities": {str(k): 0.9 if k == level else 0.025 for k in range(5)}})
        return out

    return answer


def decided(sections: DataFrame, backend: Callable[[], Backend], key: str = "candidate_id", text: str = "text", most_chars: int = MOST_CHARS) -> DataFrame:
    """key, score, confidence, choice, probabilities and error; ``backend`` is opened once per task and a failing call aborts nothing."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = backend()
        for batch in batches:
            states = batch.to_dict("records")
            out = []
            for state, answer in zip(states, own(states), strict=True):
                failed = isinstance(answer, Exception)
                row = {} if failed else answer
                out.append((state[key], row.get("score"), row.get("confidence"), row.get("choice"), row.get("probabilities"), str(answer) if failed else None))
            yield pd.DataFrame(out, columns=[key, "score", "confidence", "choice", "probabilities", "error"])

    kind = dict(sections.dtypes)[key]
    source = sections.select(key, F.substring(text, 1, most_chars).alias("text"))
    return source.mapInPandas(rows, f"{key} {kind}, score double, confidence double, choice string, probabilities map<string,double>, error string")


def judged(conditions: DataFrame, verdict: Callable[[], Callable[[list[dict]], list[str]]] | None, budget: int, *order: str) -> DataFrame:
    """Adds ``verdict``: not_checked without a judge and past the budget, else what the judge says of statement and quotes."""
    if verdict is None:
        return conditions.withColumn("verdict", F.lit("not_checked"))
    placed = numbering.within(conditions, budget, order)
    columns = conditions.columns

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = verdict()
        for batch in batches:
            batch["verdict"] = own(batch.to_dict("records"))
            yield batch[[*columns, "verdict"]]

    schema = ", ".join(f"`{c}` {t}" for c, t in conditions.dtypes) + ", verdict string"
    asked = placed.filter("within").drop("within").mapInPandas(rows, schema)
    return asked.unionByName(placed.filter("NOT within").drop("within").withColumn("verdict", F.lit("not_checked")))


def portions(documents: DataFrame, key: str, text: str, size: int = MOST_CHARS) -> DataFrame:
    """key, portion (from 0) and text of whole documents in portions of ``size`` characters, as a model is asked."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(size))
    each = documents.select(key, text, F.posexplode(starts).alias("portion", "__at"))
    return each.select(key, "portion", F.substring(F.col(text), F.col("__at") + 1, F.lit(size)).alias(text))


def combined(answers: DataFrame, key: str) -> DataFrame:
    """One row per document from its portions: an error if any call failed, else the highest score."""
    grouped = answers.groupBy(key).agg(F.max("score").alias("score"), F.min("error").alias("error"))
    return grouped.select(key, F.when(F.col("error").isNull(), F.col("score")).alias("score"), "error")


def claims(drafts: DataFrame, observed: DataFrame) -> DataFrame:
    """Each claim with accepted and reason: its source must be observed, its quote contiguous there and not only a heading.

    Drafts: claim, source, quote; observed: source, text, heading. Claims are judged one by one.
    """
    from claimloom.functions.text import loose

    joined = drafts.join(observed.select("source", "text", "heading"), "source", "left")
    reason = (
        F.when(F.col("text").isNull(), "source_not_observed")
        .when(loose(F.col("quote")) == "", "empty_quote")
        .when(loose(F.col("quote")) == loose(F.col("heading")), "heading_only")
        .when(~F.contains(loose(F.col("text")), loose(F.col("quote"))), "not_contiguous")
    )
    return joined.select(*drafts.columns, reason.isNull().alias("accepted"), reason.alias("reason"))
