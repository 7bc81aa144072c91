"""The queries of the operators, one each."""

import corpus_pipeline

from . import (
    collocations,
    decontaminate,
    fill_in_middle,
    hnsw,
    language_id,
    pii,
    quality,
    sentencepiece_lattice,
    simhash,
    suffix_array,
    suffix_trees,
    token_files,
    url_filter,
)

_ALL = (pii, decontaminate, simhash, suffix_array, language_id, suffix_trees, token_files, url_filter, quality, sentencepiece_lattice,
        hnsw, collocations, fill_in_middle)
QUERIES = {name: query for module in _ALL for name, query in module.QUERIES.items()} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL = {name: sql for module in _ALL for name, sql in module.ORACLE_SQL.items()}
