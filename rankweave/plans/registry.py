"""All registered queries of the library, without those of the llm subpackage."""

from . import dataset_queries, diagnosis_queries, evaluation_queries, guard_queries, metric_queries, model_queries, source_queries

_ALL = (metric_queries, dataset_queries, diagnosis_queries, source_queries, evaluation_queries, guard_queries, model_queries)
QUERIES = {name: query for module in _ALL for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _ALL for name, sql in module.ORACLE_SQL.items()}
