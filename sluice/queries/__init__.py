"""The registered queries: what each operator gives on the test tables, and the same in SQL."""

from sluice.queries import groups, outputs, scans, stages
from sluice.queries.common import Query

ALL: dict[str, Query] = {**scans.QUERIES, **stages.QUERIES, **groups.QUERIES, **outputs.QUERIES}
