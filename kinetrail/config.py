"""Configuration: policies from plain objects or YAML, profiles over defaults, variables of the environment."""

from __future__ import annotations

import dataclasses
import os
import re
from collections.abc import Mapping
from copy import deepcopy
from typing import Any, TypeVar

_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")
P = TypeVar("P")


class ConfigError(ValueError):
    pass


def expanded(value: Any, environment: Mapping[str, str] | None = None) -> Any:
    """${NAME} and ${NAME:-default} in all texts of an object; an empty variable counts as not set, and one without default is an error."""
    known = os.environ if environment is None else environment

    def found(match: re.Match) -> str:
        name, default = match.groups()
        if known.get(name):
            return known[name]
        if default is None:
            raise ConfigError(f"the environment variable {name} is not set")
        return default

    if isinstance(value, str):
        out = _VARIABLE.sub(found, value)
        return os.path.expanduser(out) if out.startswith("~") else out
    if isinstance(value, Mapping):
        return {str(k): expanded(v, known) for k, v in value.items()}
    return [expanded(v, known) for v in value] if isinstance(value, list) else value


def merged(base: Mapping, over: Mapping) -> dict:
    """over on top of base, object by object; lists and plain values are replaced."""
    out = {k: deepcopy(v) for k, v in base.items() if k not in over}
    for k, v in over.items():
        out[k] = merged(base[k], v) if isinstance(v, Mapping) and isinstance(base.get(k), Mapping) else deepcopy(v)
    return out


def policy(kind: type[P], values: Mapping[str, Any]) -> P:
    """A policy from an object; a key that the policy does not have is an error."""
    unknown = sorted(set(values) - {f.name for f in dataclasses.fields(kind)})
    if unknown:
        raise ConfigError(f"{kind.__name__} has no {unknown}")
    return kind(**values)


def profile(profiles: Mapping[str, Any], name: str) -> dict:
    """The settings of a dataset: its own on top of the defaults."""
    return merged(profiles.get("defaults") or {}, (profiles.get("datasets") or {}).get(name) or {})


def load(path: str) -> Any:
    """A JSON or YAML file. YAML needs its library."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        import json

        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise ConfigError("reading YAML needs the yaml library") from error
    return yaml.safe_load(text)


@dataclasses.dataclass(frozen=True)
class TargetProfile:
    """What a model target asks for: rate, window, channels and cameras."""

    name: str
    fps: float = 20.0
    window: int = 81
    stride: int = 40
    frame_stride: int = 4
    channels: tuple[int, ...] = ()
    width: int = 80
    cameras: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.fps <= 0 or self.window < 2 or self.stride < 1 or self.frame_stride < 1:
            raise ConfigError(f"{self.name}: rate, window and strides must be positive")
        if len(set(self.channels)) != len(self.channels) or any(not 0 <= c < self.width for c in self.channels):
            raise ConfigError(f"{self.name}: channels must be distinct and inside the width")
