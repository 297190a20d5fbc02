"""Registry of every query the package answers, keyed by a stable name.

Each entry builds a DataFrame from (spark, sf_dir): the store tables are
derived from the driver tables, the warehouse from the store tables, all
lazily. ``oracle`` gives the matching DuckDB statement where one exists.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import questions as Q
from .plans.warehouse import Warehouse
from .session import apply_conf
from .sources.fixtures import Store

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One lazily built warehouse per session and data folder (DataFrames are plans, not data)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        apply_conf(spark)
        _WAREHOUSES[key] = Warehouse(Store(spark, sf_dir))
    return _WAREHOUSES[key]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, fn: Callable[[Warehouse], DataFrame], sql: str | None = None, star: bool = True):
    QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(warehouse(spark, sf_dir))
    if sql is not None:
        from oracle import with_fixtures
        ORACLE[name] = with_fixtures(sql, star=star)


def _register_questions():
    from oracle import questions as OQ
    for i, (name, (store_fn, star_fn)) in enumerate(Q.QUESTIONS.items(), start=1):
        register(f"q{i:02d}_{name}_store", store_fn, OQ.STORE.get(name), star=False)
        register(f"q{i:02d}_{name}_star", star_fn, OQ.STAR.get(name), star=True)


def _register_reports():
    from oracle import reports as OR
    from .plans.reports import REPORTS
    for name, fn in REPORTS.items():
        register(name, fn, OR.SQL.get(name))


def _register_lessons():
    from oracle import lessons as OL
    from .plans.lessons import LESSONS
    for name, fn in LESSONS.items():
        register(name, fn, OL.SQL.get(name))


def _register_views():
    from oracle import views as OV
    from .plans.views import VIEWS
    for name, fn in VIEWS.items():
        register(name, fn, OV.SQL.get(name))


def _register_analysis():
    from oracle import analysis as OA
    from .plans.analysis import ANALYSIS
    for name, fn in ANALYSIS.items():
        register(name, fn, OA.SQL.get(name), star=False)


def _register_checks():
    from oracle import checks as OC
    from .plans.checks import CHECKS
    for name, fn in CHECKS.items():
        register(name, fn, OC.SQL.get(name))


def _register_trees():
    from oracle import trees as OT
    from .plans.trees import TREES
    for name, fn in TREES.items():
        register(name, fn, OT.SQL.get(name))


def _register_loads():
    from oracle import loads as OL
    from .plans.incremental import LOADS
    for name, fn in LOADS.items():
        register(name, fn, OL.SQL.get(name))


def _register_changes():
    from oracle import changes as OC
    from .plans.changes import CHANGES
    for name, fn in CHANGES.items():
        register(name, fn, OC.SQL.get(name), star=False)


def _register_coverage():
    from oracle import coverage as OC
    from .plans.coverage import COVERAGE
    for name, fn in COVERAGE.items():
        register(name, fn, OC.SQL.get(name))


def _register_streams():
    from oracle import streams as OS
    from oracle import with_fixtures
    from .streaming.jobs import STREAMS
    for name, fn in STREAMS.items():
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(apply_conf(spark), sf_dir)
        if name in OS.SQL:
            ORACLE[name] = with_fixtures(OS.SQL[name], star=False)


def _register_idioms():
    from oracle import idioms as OI
    from .plans.idioms import IDIOMS
    for name, fn in IDIOMS.items():
        register(name, fn, OI.SQL.get(name))


_register_questions()
_register_reports()
_register_lessons()
_register_views()
_register_analysis()
_register_checks()
_register_trees()
_register_loads()
_register_changes()
_register_coverage()
_register_streams()
_register_idioms()
