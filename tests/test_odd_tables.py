"""Capture queries against their SQL on small tables of odd rows."""

import datetime
from collections import Counter

import duckdb
import pandas as pd
import pytest

from arkspark.plans import QUERIES, SQL

NOON = datetime.datetime(2024, 1, 5, 12, 0, 0)


@pytest.fixture
def same(spark, tmp_path):
    def run(name, pages, events):
        con = duckdb.connect()
        tables = {"pages": (pages, ["page_id", "url", "html"]), "events": (events, ["event_id", "ts", "user_id", "event_type"])}
        for table, (rows, columns) in tables.items():
            frame = pd.DataFrame(rows, columns=columns)
            con.register("frame", frame.astype({"ts": "datetime64[us]"}) if table == "events" else frame)
            con.sql(f"copy frame to '{tmp_path}/{table}.parquet' (format parquet)")
            con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
        ours, theirs = QUERIES[name](spark, str(tmp_path)), con.sql(SQL[name])
        columns = theirs.columns
        assert sorted(ours.columns) == sorted(columns)
        assert Counter(tuple(r[c] for c in columns) for r in ours.collect()) == Counter(theirs.fetchall())

    return run


def events(*rows):
    return [(i, ts, user, "view") for i, ts, user in rows]


def test_mirror_and_own_captures_of_one_address(same):
    """Two pages share an address, one of them a mirror: each kind's nearest is taken, not the nearest of both."""
    pages = [(0, "http://a.org/", "x"), (1, "http://a.org/", "y")]
    hours = [0, 1, 5, 6, 7, 11, 12, 13, 17, 18, 23]
    same("limited_mirror_captures", pages, events(*((i, NOON.replace(hour=h), (h + 1) % 2) for i, h in enumerate(hours))))


def test_hosts_as_numbers_past_65280(same):
    same("url_wayback_key_hard", [(i, "http://a.org/", "x") for i in (1, 65273, 65281, 65289, 65545, 131081, 16777217)], events((0, NOON, 0)))


@pytest.mark.parametrize("name", ["transform_links", "transform_contents"])
def test_page_that_holds_the_tag(same, name):
    same(name, [(0, "http://a.org/", "<html><body>MONTAG</body></html>"), (1, "http://b.org/", "<HTML><body>a</body>")], events((0, NOON, 0)))


def test_hosts_as_numbers_past_32_bits(same):
    same("url_dotted_ipv4", [(0, "http://a.org/", "x")], events(*((i, NOON, 0) for i in (0, 542_362, 542_363, 6_000_000))))
