"""CRM tables to one row per subscriber."""

from __future__ import annotations

from pyspark.sql import DataFrame

from propensa.operators.joins import with_purchase_flag, with_tag_count
from propensa.sources import schemas
from propensa.sources.tables import CrmTables, cast_columns


def typed(crm: CrmTables, lenient: bool = False) -> CrmTables:
    """The CRM tables with ids, ratings and times cast to their types."""
    return CrmTables(
        subscribers=cast_columns(crm.subscribers, schemas.SUBSCRIBERS_CASTS, lenient),
        tags=cast_columns(crm.tags, schemas.TAGS_CASTS, lenient),
        transactions=cast_columns(crm.transactions, schemas.TRANSACTIONS_CASTS, lenient),
    )


def join_subscribers(crm: CrmTables) -> DataFrame:
    """Subscribers with ``tag_count`` and ``made_purchase``, in the published column order."""
    tables = typed(crm)
    counted = with_tag_count(tables.subscribers, tables.tags)
    flagged = with_purchase_flag(counted, tables.transactions)
    return flagged.select(*schemas.SUBSCRIBERS_JOINED_COLUMNS)
