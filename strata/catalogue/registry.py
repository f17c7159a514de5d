"""All queries of the catalogue by name."""

from __future__ import annotations

from strata.catalogue.arrivals import arrivals
from strata.catalogue.common import Query
from strata.catalogue.configs import configs
from strata.catalogue.flagship import flagship
from strata.catalogue.ingest import ingest
from strata.catalogue.loads import loads
from strata.catalogue.quality import quality
from strata.catalogue.reports import reports
from strata.catalogue.runs import runs

_PARTS = [flagship, ingest, quality, loads, reports, configs, arrivals, runs]


def all_queries() -> dict[str, Query]:
    return {name: query for part in _PARTS for name, query in part.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.sql.items()}
