"""All queries of this package."""

from __future__ import annotations

from tidewell.llm import common
from tidewell.llm import decontaminate, fixity, language, licenses, manifest, neardup, packing, periodic, pii, quality, sharding, tokenstore, vectorcopies  # noqa: F401 - importing registers the queries


def queries():
    return dict(common.QUERIES)


def oracles():
    return dict(common.ORACLES)
