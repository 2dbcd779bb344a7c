"""Connected components, and finding links inside groups of any size in bounded tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rawstrata.llm.common import Workspace

PIVOTS = 8


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(id, component) of every end of an edge (a, b): the smallest id it is connected to.

    Labels start at the smallest neighbour. Each round takes the smallest label around and
    then the label of the label, so paths shorten by doubling. Rounds are written tables;
    grouped minima combine before the shuffle, and a vertex with very many edges meets its one
    label by a join whose skewed side can be split.
    """
    both = work.write(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges"
    )
    labels = work.write(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("label")),
        "labels",
    )
    number = 0
    while True:
        number += 1
        around = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("near"))
        nearest = labels.join(around, labels.id == around.a).select(
            "id", "label", F.least("label", "near").alias("near")
        )
        of_label = labels.select(F.col("id").alias("near"), F.col("label").alias("far"))
        step = work.write(
            nearest.join(of_label, "near").select(
                "id", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved")
            ),
            f"labels{number}",
        )
        work.drop(labels)
        labels = step
        if labels.filter("moved").isEmpty():
            work.drop(both)
            return labels.select("id", F.col("label").alias("component"))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The consecutive rows with equal keys, of batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [np.asarray(batch[k]) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(v[start] for v in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Labels:
    """Labels of a few places that are merged as links turn up."""

    def __init__(self, count: int):
        self.of = np.arange(count)

    def merge(self, place: int, linked: np.ndarray) -> None:
        """Join the places that are linked with one."""
        found = np.unique(self.of[linked])
        if (found != self.of[place]).any():
            self.of[np.isin(self.of, found)] = self.of[place]


# payloads -> (order in which places are tried, place -> mask of the places linked with it)
Linker = Callable[[pa.ChunkedArray], tuple[np.ndarray, Callable[[int], np.ndarray]]]

_FOUND = "kind string, a long, b long"


def spanning_links(
    rows: DataFrame, sizes: DataFrame, payloads: DataFrame, linker: Linker, work: Workspace
) -> DataFrame:
    """(a, b): pairs that connect all members of each group which links connect at all. A pair
    joins the least member of what a task has connected with another one of it.

    ``rows`` has (group, member), ``sizes`` (group, chunks): into how many parts a group is dealt
    so that one is a task's worth. ``payloads`` has what the linker compares, by member and any
    further columns that ``rows`` has too; it is joined once members have their parts, so it
    is shuffled by part only. Within a part every place is compared with all others unless
    those have its label, so a group of mutual copies takes a few comparisons per member.

    A group of several parts is compared in two rounds. A few pivots, chosen by hash, are in
    every part; members that a part connects with the first pivot are done. Those left over are
    compared with all parts of their group, in slices that are a task's worth themselves.
    """
    keys = [c for c in payloads.columns if c != "payload"]
    group = rows.join(sizes, "group")
    part = F.pmod(F.xxhash64("member"), F.col("chunks")).cast("long")
    many = sizes.filter("chunks > 1")
    picks = [
        F.min(F.struct(F.xxhash64("member", F.lit(s)).alias("h"), F.col("member").alias("m")))["m"]
        for s in range(PIVOTS)
    ]
    pivots = (
        rows.join(many.select("group"), "group")
        .groupBy("group")
        .agg(*[p.alias(f"p{s}") for s, p in enumerate(picks)])
    )
    if many.isEmpty():  # nothing to choose pivots for
        no_pivots = {f"p{s}": F.lit(None).cast("long") for s in range(PIVOTS)}
        in_parts = group.withColumns(no_pivots)
    else:
        in_parts = group.join(pivots, "group", "left")
    is_pivot = F.coalesce(
        F.array_contains(F.array(*[f"p{s}" for s in range(PIVOTS)]), F.col("member")), F.lit(False)
    )
    every = F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)
    first_round = in_parts.select(
        "group",
        F.explode(F.when(is_pivot, every).otherwise(F.array(part))).alias("part"),
        *keys,
        is_pivot.alias("pivot"),
        F.coalesce(F.col("member") == F.col("p0"), F.lit(False)).alias("main"),
        (F.col("chunks") > 1).alias("many"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["group", "part"]):
            yield from _links(run, linker, run["group"][0].as_py())

    found = work.write(
        first_round.join(payloads, keys)
        .repartition("group", "part")
        .sortWithinPartitions("group", "part")
        .mapInArrow(compare, _FOUND),
        "links",
    )
    links = found.filter("kind = 'link'").select("a", "b").distinct()
    left = found.filter("kind = 'left'").select(
        F.col("a").alias("group"), F.col("b").alias("member")
    ).distinct()
    if left.isEmpty():
        return links
    left = work.write(left, "left")
    slices = left.groupBy("group").agg(F.count("*").alias("n_left")).join(
        rows.groupBy("group").agg(F.count("*").alias("n_all")), "group"
    )
    # As many slices as make each about the size of a part.
    slices = slices.join(many, "group").select(
        "group", "chunks", F.ceil(F.col("n_left") * F.col("chunks") / F.col("n_all")).alias("slices")
    )
    slice_of = F.pmod(F.xxhash64("member", F.lit("left")), F.col("slices")).cast("long")
    base = rows.join(slices, "group")
    per_part = base.select(
        "group",
        part.alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices").cast("long") - 1)).alias("slice"),
        *keys, F.lit(False).alias("pivot"),
    )
    per_slice = base.join(left, ["group", "member"], "left_semi").select(
        "group", F.explode(every).alias("part"), slice_of.alias("slice"), *keys,
        F.lit(True).alias("pivot"),
    )
    second_round = per_part.union(per_slice).select(
        "*", F.lit(False).alias("main"), F.lit(False).alias("many")
    )

    def compare_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["group", "part", "slice"]):
            yield from _links(run, linker, run["group"][0].as_py(), pivots_only=True)

    more = (
        second_round.join(payloads, keys)
        .repartition("group", "part", "slice")
        .sortWithinPartitions("group", "part", "slice")
        .mapInArrow(compare_left, _FOUND)
    )
    more = work.write(more, "more_links").select("a", "b")
    return links.union(more).distinct()


def _links(
    run: pa.Table, linker: Linker, group: int, *, pivots_only: bool = False
) -> Iterator[pa.RecordBatch]:
    size = run.num_rows
    if size < 2:
        return
    member = np.asarray(run["member"])
    pivot = np.asarray(run["pivot"])
    order, linked_with = linker(run["payload"])
    labels = Labels(size)
    tried = np.zeros(size, dtype=bool)
    for place in [*order[pivot[order]], *order[~pivot[order]]]:
        if pivots_only and not pivot[place]:
            break
        # All with another label were tried before, or none has one: nothing to learn.
        if (~tried & (labels.of != labels.of[place])).any():
            labels.merge(place, linked_with(place))
        tried[place] = True
    # Each label's members, sorted, with the least one of them.
    by_label = np.lexsort((member, labels.of))
    label, member_of = labels.of[by_label], member[by_label]
    starts = np.flatnonzero(np.append(True, label[1:] != label[:-1]))
    least = np.repeat(member_of[starts], np.diff(np.append(starts, size)))
    other = least != member_of
    yield from _found("link", least[other], member_of[other])
    if run["many"][0].as_py():
        main = np.flatnonzero(np.asarray(run["main"]))
        left = labels.of != labels.of[main[0]] if len(main) else np.ones(size, dtype=bool)
        yield from _found("left", np.full(int(left.sum()), group), member[left])


def _found(kind: str, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(a)), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            names=["kind", "a", "b"],
        )
