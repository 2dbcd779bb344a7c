import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawstrata.llm.common import Workspace, likely_among
from rawstrata.llm.graph import components, spanning_links


def brute(vertices, edges):
    label = {v: v for v in vertices}
    for _ in vertices:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)]
    edges += [(i, i + 1) for i in range(100, 130)] + [(5, 5), (5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.component for r in components(frame, Workspace(spark, "t")).collect()}
    ends = {v for a, b in edges if a != b for v in (a, b)}
    want = brute(ends, [e for e in edges if e[0] != e[1]])
    assert found == want


def test_components_of_nothing(spark):
    frame = spark.createDataFrame([], "a long, b long")
    assert components(frame, Workspace(spark, "t")).count() == 0


def close():
    """Links numbers that differ by at most 2. A closure, so that it is sent by value."""

    def link(payloads):
        values = np.array([int(v) for v in payloads.to_pylist()])
        return np.arange(len(values)), lambda i: np.abs(values - values[i]) <= 2

    return link


@pytest.mark.parametrize("chunks", [1, 3, 7])
def test_links_connect_what_is_linked_for_any_number_of_parts(spark, chunks):
    """Two rounds over parts give the components that all pairs would, without all pairs."""
    draw = random.Random(chunks)
    rows = [(g, 1000 * g + i, draw.randrange(90)) for g in range(3) for i in range(70)]
    frame = spark.createDataFrame(rows, "group long, member long, v int")
    payloads = frame.select("member", F.col("v").cast("string").alias("payload"))
    sizes = spark.createDataFrame([(g, chunks) for g in range(3)], "group long, chunks long")
    links = [tuple(r) for r in spanning_links(frame.select("group", "member"), sizes, payloads, close(), Workspace(spark, "t")).collect()]
    pairs = [
        (a, b) for g, a, x in rows for h, b, y in rows if g == h and a < b and abs(x - y) <= 2
    ]
    members = [m for _, m, _ in rows]
    assert brute(members, links) == brute(members, pairs)
    assert len(links) <= 2 * chunks * len(rows)


def test_the_filter_before_a_join_keeps_every_wanted_row(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"), "id")
    wanted = rows.filter("id % 50 = 0").select("h")
    kept = {r.id for r in likely_among(rows, wanted, "h").collect()}
    assert {i for i in range(5000) if i % 50 == 0} <= kept and len(kept) < 150
    assert likely_among(rows, wanted.limit(0), "h").count() == 0
