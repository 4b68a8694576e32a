"""All registered queries."""

from workloads import measuring, partials, progressing, replays, rows, scans, streams, texts  # noqa: F401
from workloads.registry import ORACLES, QUERIES  # noqa: F401
