"""Configuration of a pipeline run: nested mappings to checked settings."""

from __future__ import annotations

import dataclasses
import json
import types
import typing
import warnings
from dataclasses import dataclass, field
from typing import Any

from tidewright.operators.decontam import Rules
from tidewright.operators.generate import Generation, Judging
from tidewright.operators.hooks import Injection
from tidewright.operators.minhash import Settings
from tidewright.operators.quality import Limits
from tidewright.sources.readers import Source
from tidewright.sources.writers import Export, Sharding


@dataclass
class Report:
    enabled: bool = True
    output_dir: str | None = None
    include_samples: int = 200


@dataclass
class Monitoring:
    enabled: bool = True
    output_dir: str | None = None
    job_name: str = "tidewright"
    emit_json: bool = True
    emit_prometheus_text: bool = True
    labels: dict[str, str] = field(default_factory=dict)


@dataclass
class Runtime:
    #: Kept for the format; Spark's own parallelism is used.
    num_proc: int = 1
    work_dir: str = "outputs/tidewright"
    #: Write every stage to the shared folder, so that its duration means something and nothing is computed twice.
    materialize_stages: bool = True
    #: Make the export one file at exactly its path (small results only).
    single_file_export: bool = False


@dataclass
class Pipeline:
    sources: list[Source] = field(default_factory=list)
    runtime: Runtime = field(default_factory=Runtime)
    sharding: Sharding = field(default_factory=Sharding)
    dedup: Settings = field(default_factory=Settings)
    contamination: Rules = field(default_factory=Rules)
    quality: Limits = field(default_factory=Limits)
    augmentation: Generation = field(default_factory=Generation)
    judge: Judging = field(default_factory=Judging)
    export: Export = field(default_factory=Export)
    visualization: Report = field(default_factory=Report)
    monitoring: Monitoring = field(default_factory=Monitoring)
    operators: list[Injection] = field(default_factory=list)

    def overview(self) -> dict[str, Any]:
        """What a valid configuration will do, for the command line."""
        switches = {"deduplicated": self.dedup, "decontaminated": self.contamination, "quality_filtered": self.quality, "augmented": self.augmentation, "judge_filtered": self.judge}
        return {
            "valid": True, "work_dir": self.runtime.work_dir, "source_count": len(self.sources),
            "stages": ["normalized", *(name for name, section in switches.items() if section.enabled)], "operators": [f"{o.hook}: {o.class_path}" for o in self.operators if o.enabled],
        }


#: Element types that the annotations leave open.
_ELEMENTS = {(Rules, "reference_sources"): Source}


def _convert(value: Any, kind: Any, where: str) -> Any:
    """``value`` as ``kind``, or an error that names the place."""
    origin = typing.get_origin(kind)
    if origin in (typing.Union, types.UnionType):
        choices = typing.get_args(kind)
        if value is None and type(None) in choices:
            return None
        return _convert(value, next(c for c in choices if c is not type(None)), where)
    if kind is Any:
        return value
    if dataclasses.is_dataclass(kind):
        return build(kind, value, where)
    if origin is list:
        if not isinstance(value, (list, tuple)):
            raise ValueError(f"{where} must be a list")
        return [_convert(v, typing.get_args(kind)[0], f"{where}[{i}]") for i, v in enumerate(value)]
    if origin is dict:
        if not isinstance(value, dict):
            raise ValueError(f"{where} must be a mapping")
        return dict(value)
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
        raise ValueError(f"{where} must be {kind.__name__}, not {value!r}")
    return value


def build(kind: type, given: Any, where: str = "config") -> Any:
    """A settings object from a mapping. Null sections and missing keys take the defaults; unknown keys are warned about."""
    if given is None:
        given = {}
    if not isinstance(given, dict):
        raise ValueError(f"{where} must be a mapping")
    hints = typing.get_type_hints(kind)
    unknown = set(given) - set(hints)
    if unknown:
        warnings.warn(f"{where}: unknown keys {', '.join(sorted(map(str, unknown)))}", stacklevel=2)
    made = {}
    for name, hint in hints.items():
        if name not in given or (given[name] is None and not _nullable(hint)):
            continue
        element = _ELEMENTS.get((kind, name))
        made[name] = [build(element, v, f"{where}.{name}[{i}]") for i, v in enumerate(given[name])] if element else _convert(given[name], hint, f"{where}.{name}")
    try:
        return kind(**made)
    except TypeError as error:
        raise ValueError(f"{where}: {error}") from error


def _nullable(hint: Any) -> bool:
    return type(None) in typing.get_args(hint)


def pipeline_config(given: dict[str, Any]) -> Pipeline:
    """The checked configuration; at least one source is needed. Nothing is created on disk."""
    made = build(Pipeline, given)
    if not made.sources:
        raise ValueError("the configuration names no sources")
    return made


def load_config(path: str) -> Pipeline:
    """From a JSON file, or a YAML file where the yaml module is installed."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return pipeline_config(json.loads(text))
    try:
        import yaml
    except ImportError as error:
        raise ValueError("YAML configurations need the yaml module; give a JSON file") from error
    return pipeline_config(yaml.safe_load(text))
