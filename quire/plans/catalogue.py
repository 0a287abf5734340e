"""All queries of the library by name, with the SQL that checks them."""

from __future__ import annotations

from quire.plans import editions, layouts, repairs, streams, words

_MODULES = (words, streams, repairs, layouts, editions)
QUERIES = {name: query for module in _MODULES for name, query in module.R.queries.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.R.oracles.items()}
