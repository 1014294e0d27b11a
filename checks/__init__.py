"""Every registered query with the SQL that must give the same rows."""

from checks import boards, changes, files, ingest, marts, planning, prices, runs, scalars, windows  # noqa: F401
from checks.registry import QUERIES, SQL  # noqa: F401
