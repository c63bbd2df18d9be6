from __future__ import annotations

import pytest

from propensa import __main__ as command
from propensa.sources import tables


class Reader:
    """Keeps what a scan was asked for."""

    def __init__(self, seen):
        self.seen, self.asked = seen, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, name, value):
        self.asked[name] = value
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def load(self):
        self.seen.append(self.asked)
        return self.asked["dbtable"]


class Session:
    def __init__(self):
        self.seen = []

    @property
    def read(self):
        return Reader(self.seen)


SPLITS = ["Subscribers:mailchimp_id:1:900", "Tags:mailchimp_id:1:900:8", "Transactions:transaction_id:5:7000"]


def arguments(splits):
    return command.arguments().parse_args(["ingest", "--jdbc-url", "jdbc:x", *[a for s in splits for a in ("--jdbc-split", s)]])


def test_every_table_is_read_by_ranges():
    session = Session()
    found = command.crm_tables(session, arguments(SPLITS))
    assert (found.subscribers, found.tags, found.transactions) == ("Subscribers", "Tags", "Transactions")
    assert [(a["partitionColumn"], a["lowerBound"], a["upperBound"], a["numPartitions"], a["fetchsize"]) for a in session.seen] == [
        ("mailchimp_id", 1, 900, 64, 10_000), ("mailchimp_id", 1, 900, 8, 10_000), ("transaction_id", 5, 7000, 64, 10_000)]


def test_a_table_without_a_split_is_refused():
    with pytest.raises(ValueError, match="Tags, Transactions"):
        command.crm_tables(Session(), arguments(SPLITS[:1]))


@pytest.mark.parametrize("text", ["Tags", "Tags:id", "Tags:id:1", "Tags::1:2", "Tags:id:1:2:3:4", "Tags:id:a:b"])
def test_a_bad_split_is_refused(text):
    with pytest.raises(ValueError):
        tables.Split.parse(text)
