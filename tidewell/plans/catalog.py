"""All registered queries."""

from __future__ import annotations

from tidewell.plans import base
from tidewell.plans import climate, core, embeddings, spatial, text, tokens  # noqa: F401 - importing registers the queries


def queries():
    return dict(base.QUERIES)


def oracles():
    return dict(base.ORACLES)
