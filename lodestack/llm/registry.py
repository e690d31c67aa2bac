"""What __spark_entry__ registers for this subpackage."""

import importlib.util

from .queries import QUERIES
from .shared import ship
from .sqls import SQL


def _shipped(query):
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


def _pipeline():
    # corpus_pipeline.py stands at the repository's top and goes with this folder.
    import corpus_pipeline

    return corpus_pipeline


def queries():
    return {name: _shipped(query) for name, query in QUERIES.items()} | {"pipeline": _shipped(lambda spark, sf_dir: _pipeline().run(spark, sf_dir))}


def oracle_sql():
    return dict(SQL)
