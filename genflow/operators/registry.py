"""User functions by name."""

from __future__ import annotations

from collections.abc import Callable

_FACTORIES: dict[str, Callable] = {}


def register(name: str, factory: Callable | None = None):
    """Register a factory, directly or as a decorator."""
    if factory is None:
        return lambda f: register(name, f)
    _FACTORIES[name.lower()] = factory
    return factory


def lookup(name: str) -> Callable:
    try:
        return _FACTORIES[name.lower()]
    except KeyError:
        known = ", ".join(sorted(_FACTORIES)) or "none"
        raise ValueError(f"unknown scorer {name!r}; known: {known}") from None


def registered() -> list[str]:
    return sorted(_FACTORIES)
