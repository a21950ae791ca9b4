"""All registered queries."""

from tallyloom.workload import facts, documents, audiences, ingest, publishing, rollups  # noqa: F401
from tallyloom.workload.registry import ORACLES, QUERIES  # noqa: F401
