"""Every operator bound to the given tables, with the SQL that computes the same rows."""

import sys
from importlib import import_module

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODULES = ["relational", "landing", "enrichment", "similarity", "search", "insights", "intake"]

ALL_QUERIES, ALL_SQL = {}, {}
for _m in MODULES:
    _mod = import_module(f"{__name__}.{_m}")
    ALL_QUERIES.update(_mod.QUERIES)
    ALL_SQL.update(_mod.SQL)
