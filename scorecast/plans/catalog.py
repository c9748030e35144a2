"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import functools

from ..session import ensure_workers_can_import
from . import q_models, q_monitor, q_prepare, q_profile, q_stream  # noqa: F401
from .registry import ORACLE, QUERIES


def _shipped(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        ensure_workers_can_import(spark)
        return fn(spark, sf_dir)

    return run


def queries():
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
