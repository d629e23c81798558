"""Names of the queries and their SQL oracles."""

from . import cases, curation, labeling

QUERIES = {**labeling.QUERIES, **curation.QUERIES, **cases.QUERIES}
ORACLES = {**labeling.ORACLES, **curation.ORACLES, **cases.ORACLES}
