"""Generators of facts, groups and paths, and the model clients behind them; a failing call is a row, an unknown id is none."""

from __future__ import annotations

import json
import math
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.settings import closed_schema, strict_json

#: Takes a prepared request and returns the answer as text.
Client = Callable[[dict], str]


def prepared(question: Mapping[str, object]) -> dict:
    """A question as it may be sent: known type, text that is not blank, finite JSON."""
    if question.get("type") not in ("score", "choice", "extract", "group", "path"):
        raise ValueError(f"unknown question type {question.get('type')!r}")
    if not str(question.get("text") or "").strip():
        raise ValueError("a question without text")

    def check(value: object) -> None:
        if isinstance(value, float) and not math.isfinite(value):
            raise ValueError("numbers must be finite")
        for inner in value.values() if isinstance(value, Mapping) else value if isinstance(value, list | tuple) else ():
            check(inner)

    check(question)
    return json.loads(json.dumps(question, allow_nan=False))


def opened(config: Mapping[str, str] | None = None, client: Client | None = None) -> Client:
    """The client to use: a remote one by its settings, or the one supplied; exactly one of both."""
    if (config is None) == (client is None):
        raise ValueError("give either settings of a remote model or a client")
    return client or remote(config)


def remote(config: Mapping[str, str], attempts: int = 3, wait: float = 1.0) -> Client:
    """A client of an HTTP model that answers JSON; its key is sent as a header and never logged."""

    def ask(request: dict) -> str:
        body = json.dumps({"model": config.get("model"), **request}).encode()
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {config['key']}"} if config.get("key") else {})
        for n in range(attempts):
            try:
                with urllib.request.urlopen(urllib.request.Request(config["url"], body, headers), timeout=float(config.get("timeout", 60))) as answer:
                    return answer.read().decode("utf-8")
            except OSError as error:
                if n + 1 == attempts:
                    raise ValueError(f"the model did not answer: {type(error).__name__}") from None
                time.sleep(wait * 2**n)
        raise AssertionError

    return ask


def validated(answer: str, fields: Mapping[str, type], items: str = "items") -> list[dict]:
    """The items of an answer: strict JSON whose items have just the named fields, of their types; anything else is an error."""
    found = strict_json(answer)
    if not isinstance(found, dict) or not isinstance(found.get(items), list):
        raise ValueError(f"no list of {items}")
    for item in found[items]:
        if not isinstance(item, dict) or set(item) != set(fields):
            raise ValueError("an item with other fields")
        for name, kind in fields.items():
            if not isinstance(item[name], kind):
                raise ValueError(f"{name} is no {kind.__name__}")
    return found[items]


def generated(batches: DataFrame, key: str, text: str, client: Callable[[], Client], fields: Mapping[str, type], question: str = "extract") -> DataFrame:
    """A row per item that the model gives for a batch (a row of ``batches``), or one with its error.

    The client is opened once per task; answers are validated there, and a failing batch aborts nothing.
    """
    names = {str: "string", int: "bigint", bool: "boolean", float: "double"}
    kinds = ", ".join(f"`{n}` {names[t]}" for n, t in fields.items())

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for frame in frames:
            out = []
            for own, told in zip(frame[key].tolist(), frame[text].tolist(), strict=True):
                try:
                    out += [(own, *(item[n] for n in fields), None) for item in validated(ask(prepared({"type": question, "text": told})), fields)]
                except ValueError as error:
                    out.append((own, *([None] * len(fields)), str(error)))
            made = pd.DataFrame(out, columns=[key, *fields, "error"], dtype=object)
            yield made

    return batches.select(key, text).mapInPandas(rows, f"`{key}` {dict(batches.dtypes)[key]}, {kinds}, error string")


def only_known(items: DataFrame, allowed: DataFrame, name: str) -> DataFrame:
    """Items whose id is one that was offered, and rows with errors; what a schema of choices demands, as a semi join."""
    known = items.join(allowed.select(F.col(name)).distinct(), name, "left_semi")
    return known.unionByName(items.filter("error IS NOT NULL").select(*known.columns))


def action_schema(actions: Mapping[str, list[str]]) -> dict:
    """The closed schema of a research step: an action, and the ids that have been observed so far as its choices."""
    return closed_schema({"type": "object", "properties": {"action": {"type": "string", "enum": list(actions)}, "target": {"type": "string", "enum": sorted({i for ids in actions.values() for i in ids})}}, "required": ["action", "target"]})


def research(step: Callable[[list[dict]], dict], act: Callable[[str, str], object], budget: int, covered: Callable[[list[dict]], bool]) -> list[dict]:
    """A client's loop of search, fetch and finish on the driver: a trace of at most ``budget`` steps.

    A step that fails is recorded and may be repaired by the next; finishing before the coverage gate passes is refused once.
    """
    trace: list[dict] = []
    refused = False
    for _ in range(budget):
        chosen = step(trace)
        if chosen["action"] == "finish":
            if covered(trace) or refused:
                return [*trace, {**chosen, "status": "finished"}]
            refused = True
            trace.append({**chosen, "status": "not_covered"})
            continue
        try:
            trace.append({**chosen, "status": "done", "result": act(chosen["action"], chosen["target"])})
        except ValueError as error:
            trace.append({**chosen, "status": "failed", "error": str(error)})
    return [*trace, {"action": "finish", "status": "budget"}]
