"""Named providers: ``DataFrame -> DataFrame`` functions looked up by name and used with ``transform``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

_PROVIDERS: dict[str, Callable[..., DataFrame]] = {}


def register(name: str):
    def wrap(fn: Callable[..., DataFrame]):
        if name in _PROVIDERS:
            raise ValueError(f"provider {name} is already registered")
        _PROVIDERS[name] = fn
        return fn

    return wrap


def provider(name: str, **params) -> Callable[[DataFrame], DataFrame]:
    """``df.transform(provider("ground_band", dz=0.4))``"""
    if name not in _PROVIDERS:
        raise KeyError(f"unknown provider {name}; known: {sorted(_PROVIDERS)}")
    fn = _PROVIDERS[name]
    return lambda df: fn(df, **params)


def names() -> list[str]:
    return sorted(_PROVIDERS)
