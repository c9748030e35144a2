"""Imports every query module of the subpackage, so that the registry is complete."""

from __future__ import annotations

import functools

from ..session import ensure_workers_can_import
from . import (  # noqa: F401
    q_bitslice,
    q_coordjoin,
    q_failaudit,
    q_htmltemplate,
    q_langid,
    q_latticelm,
    q_mixing,
    q_omh,
    q_packing,
    q_sanitise,
    q_setm,
    q_substring,
    q_urltrees,
)
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
    return dict(ORACLE)
