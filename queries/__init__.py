"""Every registered query of the repository."""

from __future__ import annotations


def _load():
    from . import catalog
    from . import attempts, columns, images, requests, scoring, streams, tasks  # noqa: F401

    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
