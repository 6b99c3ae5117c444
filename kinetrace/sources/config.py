"""Strict YAML configuration: duplicate, unknown and missing keys are errors; one level of
inheritance by `extends`, with overrides by stream; every configuration has a hash."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    pass


def load_yaml(text: str) -> Any:
    import yaml

    class Strict(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        out = {}
        for k, v in node.value:
            key = loader.construct_object(k, deep=deep)
            if key in out:
                raise ConfigError(f"duplicate key {key!r} at line {k.start_mark.line + 1}")
            out[key] = loader.construct_object(v, deep=True)
        return out

    Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return yaml.load(text, Strict)  # noqa: S506


def checked(data: Mapping, required: Sequence[str], optional: Sequence[str] = (), where: str = "configuration") -> Mapping:
    if not isinstance(data, Mapping):
        raise ConfigError(f"{where}: a mapping is expected")
    missing = [k for k in required if k not in data]
    unknown = [k for k in data if k not in required and k not in optional]
    if missing or unknown:
        raise ConfigError(f"{where}: missing {missing}, unknown {unknown}")
    return data


def digest(data: Any) -> str:
    return hashlib.sha256(json.dumps(data, sort_keys=True, default=str).encode()).hexdigest()


@dataclass(frozen=True)
class Stream:
    """One stream of a robot: its topic, payload and gates."""

    key: str
    topic: str
    message_type: str
    semantic: str  # image, joint, pose
    alignment: str  # anchor, nearest, linear, pose, previous
    hz: float = 0.0
    names: tuple[str, ...] = ()
    max_gap_s: float | None = None
    max_age_s: float | None = None
    soft_skew_s: float | None = None
    hard_skew_s: float | None = None
    max_consecutive: int = 1
    max_ratio: float = 0.005
    low: float | None = None
    high: float | None = None
    filter_hz: float | None = None

    def __post_init__(self):
        if self.semantic not in ("image", "joint", "pose"):
            raise ConfigError(f"{self.key}: unknown semantic {self.semantic!r}")
        if self.alignment not in ("anchor", "nearest", "linear", "pose", "previous"):
            raise ConfigError(f"{self.key}: unknown alignment {self.alignment!r}")


@dataclass(frozen=True)
class Profile:
    name: str
    streams: tuple[Stream, ...]
    fps: float = 30.0
    minimum_frames: int = 1
    sha256: str = field(default="", compare=False)

    def of(self, *alignments: str) -> list[Stream]:
        return [s for s in self.streams if s.alignment in alignments]


REQUIRED = ("name", "streams")
OPTIONAL = ("extends", "stream_overrides", "fps", "minimum_frames")


def resolved(path: str | Path, seen: tuple[str, ...] = ()) -> dict:
    """The configuration with its base merged in; cycles are errors."""
    path = Path(path).resolve()
    if str(path) in seen:
        raise ConfigError(f"cycle of extends: {' -> '.join((*seen, str(path)))}")
    data = dict(load_yaml(path.read_text()))
    if base := data.pop("extends", None):
        merged = resolved(path.parent / base, (*seen, str(path)))
        streams = {k: dict(v) for k, v in merged.get("streams", {}).items()}
        for key, change in (data.pop("stream_overrides", None) or {}).items():
            if key not in streams:
                raise ConfigError(f"override of unknown stream {key!r}")
            streams[key] |= change
        merged |= data
        merged["streams"] = streams | data.get("streams", {})
        return merged
    return data


def load_profile(path: str | Path) -> Profile:
    data = checked(resolved(path), REQUIRED, OPTIONAL, str(path))
    names = {f for f in Stream.__dataclass_fields__ if f != "key"}
    streams = []
    topics: dict[str, str] = {}
    for key, s in data["streams"].items():
        checked(s, ("topic", "message_type", "semantic", "alignment"), names, f"stream {key}")
        if s["topic"] in topics:
            raise ConfigError(f"topic {s['topic']!r} is used by {topics[s['topic']]} and {key}")
        topics[s["topic"]] = key
        streams.append(Stream(key=key, **{k: tuple(v) if k == "names" else v for k, v in s.items()}))
    if sum(s.alignment == "anchor" for s in streams) != 1:
        raise ConfigError("exactly one stream must be the anchor")
    return Profile(data["name"], tuple(streams), float(data.get("fps", 30.0)), int(data.get("minimum_frames", 1)), digest(data))


def load_tasks(text: str) -> list[dict]:
    """The batch task list: {"version": 1, "tasks": [{"name", "instruction", "bags"}]}."""
    data = checked(json.loads(text), ("version", "tasks"), (), "task list")
    if data["version"] != 1:
        raise ConfigError(f"unknown version {data['version']!r}")
    seen = set()
    for t in data["tasks"]:
        checked(t, ("name", "instruction", "bags"), (), "task")
        if not all(isinstance(t[k], str) and t[k].strip() for k in ("name", "instruction")):
            raise ConfigError("names and instructions must be non-empty strings")
        if t["name"] in seen:
            raise ConfigError(f"duplicate task {t['name']!r}")
        seen.add(t["name"])
    return data["tasks"]


def overlapping(paths: Sequence[str]) -> list[tuple[str, str]]:
    """Pairs of paths of which one lies in the other, or that are equal."""
    norm = sorted(Path(p).resolve().as_posix() for p in paths)
    return [(a, b) for i, a in enumerate(norm) for b in norm[i + 1 :] if b == a or b.startswith(a + "/")]


def check_modality(config: Mapping[str, Mapping]) -> dict[str, Mapping]:
    """Known modalities only; language has at least one key and looks at the present step alone."""
    known = {k: v for k, v in config.items() if k in ("video", "state", "action", "language")}
    lang = known.get("language")
    if not lang or not lang.get("modality_keys"):
        raise ConfigError("language needs at least one key")
    if list(lang.get("delta_indices", [])) != [0]:
        raise ConfigError("language looks at step 0 only")
    return known
