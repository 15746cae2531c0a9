"""User operators at named points of the pipeline."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, Protocol, runtime_checkable

from pyspark.sql import DataFrame

from tidewright.operators.generate import load_object

#: Points at which operators run, in pipeline order. Fixed values.
HOOKS = ("post_normalized", "post_dedup", "post_contamination", "post_quality", "post_augmentation", "post_judge", "pre_export")


@dataclass
class Injection:
    """One configured operator. Names and defaults belong to the configuration format."""

    enabled: bool = True
    hook: str = "post_normalized"
    class_path: str = ""
    init_kwargs: dict[str, Any] = field(default_factory=dict)
    run_kwargs: dict[str, Any] = field(default_factory=dict)
    name: str | None = None
    note: str = ""


@runtime_checkable
class Operator(Protocol):
    """A transformation of the whole table; ``context`` tells it where it runs."""

    name: str
    hook: str
    note: str

    def apply(self, df: DataFrame, *, context: dict[str, Any]) -> DataFrame: ...


@dataclass
class Injected:
    """An object of the user's made into an operator."""

    target: Any
    hook: str
    name: str
    note: str = ""
    run_kwargs: dict[str, Any] = field(default_factory=dict)

    def apply(self, df: DataFrame, *, context: dict[str, Any] | None = None) -> DataFrame:
        """``target.apply`` or ``target.run`` with the options it accepts, else a call of the object itself."""
        if isinstance(self.target, Operator):
            return self.target.apply(df, context=context or {})
        run = getattr(self.target, "run", None)
        if callable(run):
            return run(df, **_accepted(run, {**(context or {}), **self.run_kwargs}, set(self.run_kwargs)))
        if callable(self.target):
            return self.target(df)
        raise TypeError(f"operator {self.name} has no run method and cannot be called")


def _accepted(function: Callable, offered: dict[str, Any], wanted: set[str]) -> dict[str, Any]:
    """The offered options that the function takes; with ``**kwargs`` it takes those that were asked for."""
    parameters = inspect.signature(function).parameters
    anything = any(p.kind is inspect.Parameter.VAR_KEYWORD for p in parameters.values())
    return {k: v for k, v in offered.items() if k in parameters or (anything and k in wanted)}


def resolve(injections: list[Injection]) -> list[Injected]:
    """Operators of the enabled injections, in their order; a bad hook, path or name fails here, before any data is read."""
    found = []
    for item in injections:
        if not item.enabled:
            continue
        if item.hook not in HOOKS:
            raise ValueError(f"unknown hook {item.hook!r}; known are {', '.join(HOOKS)}")
        if not item.class_path:
            raise ValueError("an operator needs class_path")
        target = load_object(item.class_path)
        if inspect.isclass(target):
            target = target(**item.init_kwargs)
        found.append(Injected(target, item.hook, item.name or item.class_path.replace(":", ".").rsplit(".", 1)[-1], item.note, item.run_kwargs))
    return found


class AlphanumericFilter:
    """Keeps rows whose text has at least ``min_ratio`` and at most ``max_ratio`` letters and digits."""

    def __init__(self, text_key: str = "text", min_ratio: float = 0.25, max_ratio: float = 1.0):
        self.text_key, self.min_ratio, self.max_ratio = text_key, min_ratio, max_ratio

    def run(self, df: DataFrame) -> DataFrame:
        from pyspark.sql import functions as F

        from tidewright.functions.text import alphanumeric_ratio

        return df.where(alphanumeric_ratio(F.col(self.text_key)).between(self.min_ratio, self.max_ratio))
