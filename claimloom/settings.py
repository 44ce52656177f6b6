"""Settings of external models, and strict reading of what they answer; no network here."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field


def strict_json(text: str) -> object:
    """JSON without repeated keys and without NaN or infinities."""

    def unique(pairs: list[tuple[str, object]]) -> dict:
        names = [k for k, _ in pairs]
        if len(names) != len(set(names)):
            raise ValueError("an object repeats a key")
        return dict(pairs)

    def refuse(name: str) -> object:
        raise ValueError(f"{name} is no JSON number")

    return json.loads(text, object_pairs_hook=unique, parse_constant=refuse)


def closed_schema(schema: object) -> object:
    """A JSON Schema whose objects take no other properties and need all of theirs; references elsewhere are refused."""
    if isinstance(schema, list):
        return [closed_schema(s) for s in schema]
    if not isinstance(schema, dict):
        return schema
    if not str(schema.get("$ref", "#")).startswith("#"):
        raise ValueError("the schema refers to another document")
    out = {k: closed_schema(s) for k, s in schema.items()}
    if schema.get("type") == "object" and isinstance(schema.get("properties"), dict):
        out |= {"additionalProperties": False, "required": list(schema["properties"])}
    return out


def with_choices(schema: dict, name: str, values: list[str]) -> dict:
    """The schema with property ``name``, wherever it is, limited to the values of this batch."""
    if isinstance(schema, list):
        return [with_choices(s, name, values) for s in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: with_choices(s, name, values) for k, s in schema.items()}
    own = out.get("properties", {}).get(name) if isinstance(out.get("properties"), dict) else None
    if own is not None:
        target = own["items"] if own.get("type") == "array" else own
        target["enum"] = list(values)
    return out


@dataclass(frozen=True)
class Transport:
    """Where a model is reached. Keys are never shown."""

    url: str
    key: str = field(default="", repr=False)
    timeout: float = 60.0
    retries: int = 2

    def __post_init__(self) -> None:
        if not self.url.startswith(("https://", "http://localhost", "http://127.0.0.1")):
            raise ValueError("a model is reached by https, or on this machine")
        if not 0 < self.timeout <= 600 or not 0 <= self.retries <= 10:
            raise ValueError("timeout lies in (0, 600] and retries in 0..10")

    def waits(self, retry_after: float | None = None) -> list[float]:
        """Seconds to wait before each new attempt."""
        return [min(30.0, max(2.0**n, retry_after or 0.0)) for n in range(self.retries)]


def resolved(stage: str, arguments: Mapping[str, str | None], environment: Mapping[str, str] | None = None, default: Mapping[str, str] | None = None) -> dict[str, str]:
    """Settings of a stage: its own argument, the common argument, its own variable, the common variable, the default."""
    environment = os.environ if environment is None else environment
    out = {}
    for name in ("backend", "model", "url"):
        found = (
            arguments.get(f"{stage}_{name}"), arguments.get(name),
            environment.get(f"CLAIMLOOM_{stage.upper()}_{name.upper()}"), environment.get(f"CLAIMLOOM_{name.upper()}"), (default or {}).get(name),
        )
        value = next((v for v in found if v), None)
        if value:
            out[name] = value
    return out


class Registry:
    """Opened models by their settings, so that stages with equal settings share one."""

    def __init__(self, open_model: Callable[[dict[str, str]], object]):
        self.open_model, self.opened = open_model, {}

    def get(self, settings: Mapping[str, str]) -> object:
        key = tuple(sorted(settings.items()))
        if key not in self.opened:
            self.opened[key] = self.open_model(dict(settings))
        return self.opened[key]
