"""Registered queries and the SQL each of them must agree with."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from checks import cleaning, evaluation, features, models, profiling, scoring, sources, splits

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODULES = (sources, profiling, cleaning, splits, features, models, evaluation, scoring)

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}
