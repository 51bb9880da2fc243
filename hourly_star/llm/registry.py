"""All queries of the training-data operators and the SQL of those that have one."""

from __future__ import annotations

from hourly_star.llm import (
    chat,
    collocations,
    decontaminate,
    extract,
    fingerprints,
    licenses,
    mixing,
    quality,
    repeats,
    sharding,
    simhash,
    toxicity,
    variants,
)

MODULES = [simhash, extract, decontaminate, toxicity, sharding, chat, quality, licenses, mixing, repeats,
           variants, fingerprints, collocations]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
