"""Registry of driver queries: name -> (spark, sf_dir) -> DataFrame, and
the matching oracle SQL (every key has one)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .plans import analytics
from .plans.extras import EXTRA_QUERIES
from .plans.scenario import SCENARIO_QUERIES
from .plans.stages import STAGE_QUERIES
from .plans.star import star_from_testdata

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_star(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_from_testdata(spark, sf_dir, oracle.TEST_SALT))
    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, QueryFn] = {name: _on_star(fn) for name, fn in analytics.QUERIES.items()}
QUERIES.update(STAGE_QUERIES)
QUERIES.update(SCENARIO_QUERIES)
QUERIES.update(EXTRA_QUERIES)

ORACLE_SQL: dict[str, str] = {**oracle.QUERY_SQL, **oracle.STAGE_SQL}
ORACLE_SQL = {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
