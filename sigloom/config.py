"""Layered settings on the driver: defaults, file, environment, command line; later layers win."""

from __future__ import annotations

import copy
import hashlib
import json
import os
import re
from collections.abc import Mapping, Sequence
from pathlib import Path
from types import MappingProxyType
from typing import Any

try:
    import yaml
except ImportError:  # YAML files need it; JSON files and everything else do not
    yaml = None

_TEMPLATE = re.compile(r"\$\{([A-Za-z_]\w*)(?::([^}]*))?\}")
SECRET = ("secret", "token", "password", "key")


def merged(*layers: Mapping[str, Any]) -> dict[str, Any]:
    """Nested maps as one; a later layer's value replaces, a map in both is merged in turn."""
    out: dict[str, Any] = {}
    for layer in layers:
        for k, v in layer.items():
            both = isinstance(v, Mapping) and isinstance(out.get(k), Mapping)
            out[k] = merged(out[k], v) if both else copy.deepcopy(v)
    return out


def scalar(text: str) -> Any:
    """null, true and false, numbers and JSON lists or maps as such; other text as it is."""
    if text.strip().lower() in ("null", "none", "~"):
        return None
    if text.strip().lower() in ("true", "false"):
        return text.strip().lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    if text.strip()[:1] in ("[", "{"):
        try:
            return json.loads(text)
        except ValueError:
            pass
    return text


def filled(value: Any, env: Mapping[str, str]) -> Any:
    """``${NAME:default}`` in all texts of a tree replaced from the environment; without either it stays."""
    if isinstance(value, str):
        return _TEMPLATE.sub(lambda m: env.get(m[1], m[2] if m[2] is not None else m[0]), value)
    if isinstance(value, Mapping):
        return {k: filled(v, env) for k, v in value.items()}
    return [filled(v, env) for v in value] if isinstance(value, list) else value


def at_paths(pairs: Mapping[str, Any]) -> dict[str, Any]:
    """``{"a.b": 1}`` as ``{"a": {"b": 1}}``."""
    return merged(*(_nest(path.split("."), v) for path, v in pairs.items()))


def _nest(names: Sequence[str], value: Any) -> dict[str, Any]:
    return {names[0]: _nest(names[1:], value) if len(names) > 1 else value}


def from_environment(prefix: str, env: Mapping[str, str]) -> dict[str, Any]:
    """``PREFIX__a__b=v`` as a tree."""
    head = prefix + "__"
    return at_paths({k[len(head) :].replace("__", "."): scalar(v) for k, v in env.items() if k.startswith(head)})


def from_arguments(items: Sequence[str]) -> dict[str, Any]:
    """``a.b=v`` as a tree."""
    for item in items:
        if "=" not in item:
            raise ValueError(f"not name=value: {item}")
    return at_paths({k: scalar(v) for k, v in (i.split("=", 1) for i in items)})


def read(path: str | Path) -> Any:
    """A JSON or YAML file; ``!include`` in YAML reads a YAML or JSON file in place, and any other file as text."""
    path = Path(path)
    if path.suffix in (".yaml", ".yml"):
        if yaml is None:
            raise RuntimeError("YAML files need PyYAML")

        class Loader(yaml.SafeLoader):
            pass

        Loader.add_constructor("!include", lambda loader, node: read(path.parent / loader.construct_scalar(node)))
        return yaml.load(path.read_text(encoding="utf-8"), Loader) or {}  # noqa: S506: a SafeLoader
    text = path.read_text(encoding="utf-8")
    return json.loads(text) if path.suffix == ".json" else text


def canonical(data: Any) -> bytes:
    return json.dumps(data, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str).encode()


class Config:
    """Settings from all layers. A reload reads file and environment again and keeps the arguments."""

    def __init__(self, defaults: Mapping[str, Any] | None = None, path: str | Path | None = None, prefix: str | None = None, arguments: Sequence[str] = (), env: Mapping[str, str] | None = None):
        self._how = (defaults or {}, path, prefix, tuple(arguments), env)
        self.reload()

    def reload(self) -> None:
        defaults, path, prefix, arguments, env = self._how
        env = os.environ if env is None else env
        layers = [defaults, filled(read(path), env) if path else {}, from_environment(prefix, env) if prefix else {}, from_arguments(arguments)]
        self._data = merged(*layers)

    def get(self, path: str, kind: type | None = None, default: Any = None) -> Any:
        """The value at a dotted path, of ``kind`` if given; a name that itself holds dots is found too."""
        value = _find(self._data, path)
        if value is None:
            return default
        if kind is None or isinstance(value, kind):
            return value
        try:
            return bool(scalar(str(value))) if kind is bool else kind(value)
        except (TypeError, ValueError):
            return default

    def snapshot(self) -> Mapping[str, Any]:
        return MappingProxyType(copy.deepcopy(self._data))

    def fingerprint(self) -> str:
        return hashlib.sha256(canonical(self._data)).hexdigest()

    def export(self, redact: bool = True) -> dict[str, Any]:
        return _hidden(self._data) if redact else copy.deepcopy(self._data)

    def validate(self, required: Mapping[str, type]) -> None:
        """Raises ValueError where a path is missing or of another type."""
        wrong = [p for p, kind in required.items() if not isinstance(_find(self._data, p), kind)]
        if wrong:
            raise ValueError("missing or of another type: " + ", ".join(wrong))


def _find(tree: Any, path: str) -> Any:
    if not isinstance(tree, Mapping):
        return None
    if path in tree:
        return tree[path]
    names = path.split(".")
    for i in range(len(names) - 1, 0, -1):
        head = ".".join(names[:i])
        if head in tree and (found := _find(tree[head], ".".join(names[i:]))) is not None:
            return found
    return None


def _hidden(tree: Any) -> Any:
    if isinstance(tree, Mapping):
        return {k: "***" if any(s in str(k).lower() for s in SECRET) and not isinstance(v, Mapping) else _hidden(v) for k, v in tree.items()}
    return copy.deepcopy(tree)


def session_settings(config: Config) -> dict[str, str]:
    """Spark settings for the job settings that have a counterpart: retries, timeouts, workers, batch sizes."""
    names = {"executor.max_retries": ("spark.task.maxFailures", 1), "executor.max_concurrency": ("spark.default.parallelism", 0), "executor.task_timeout_seconds": ("spark.task.reaper.killTimeout", None), "queue.lease_batch": ("spark.sql.execution.arrow.maxRecordsPerBatch", 0), "gpu.per_task": ("spark.task.resource.gpu.amount", 0)}
    out = {}
    for path, (name, more) in names.items():
        value = config.get(path, float)
        if value is not None:
            out[name] = f"{value:g}s" if more is None else f"{value + more:g}"
    return out
