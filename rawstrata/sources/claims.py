"""One writer at a time: claims on a target, as files that only one run can create.

Claims of a target are numbered files in a hidden folder beside it. A run that finds none
creates number 1; one whose newest claim has not been renewed for ``stale_after`` seconds is
taken over by creating the next number. Creating a file is exclusive, so of several runs that
see the same stale claim one goes on and the others are refused, and no run ever deletes a claim
that may belong to another one at work. A run that was taken over finds a larger number when it
next renews its claim, before it publishes anything, and stops.

Object stores without exclusive creation give no such promise. Ages compare the file's time,
set by its owner's clock, with the clock here.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from rawstrata.sources import storage
from rawstrata.sources.storage import PathLike, child

STALE_AFTER = 6 * 3600.0


class TargetClaimedError(RuntimeError):
    """Another run writes to the target, or has taken it over."""


def claims_folder(target: PathLike) -> str:
    """Where the claims of a target are: hidden, and not inside the table."""
    parent, _, name = str(target).rstrip("/").rpartition("/")
    return child(parent, f"_claims-{name}") if parent or str(target).startswith("/") else f"_claims-{name}"


def _number(name: str) -> int:
    number = name.removesuffix(".json")
    return int(number) if number.isdigit() else 0


class Claim:
    """A run's claim on a target."""

    def __init__(self, spark: SparkSession, target: PathLike, owner: str, number: int):
        self.spark, self.target, self.owner, self.number = spark, str(target), owner, number
        self.folder = claims_folder(target)
        self.path = child(self.folder, f"{number:08d}.json")

    def renew(self) -> None:
        """Say that the owner is at work. Raises if another run has taken over."""
        held = [(_number(name), name) for name, _ in storage.entries(self.spark, self.folder)]
        if not held or max(held)[0] != self.number:
            raise TargetClaimedError(f"Another run took over {self.target} from {self.owner}")
        storage.touch(self.spark, self.path, int(time.time() * 1000))

    def release(self) -> None:
        """Remove this claim and the stale ones before it."""
        for name, _ in storage.entries(self.spark, self.folder):
            if _number(name) <= self.number:
                storage.delete(self.spark, child(self.folder, name))
        if not storage.entries(self.spark, self.folder):
            storage.delete_empty(self.spark, self.folder)


def claim(
    spark: SparkSession, target: PathLike, owner: str | None = None, stale_after: float = STALE_AFTER
) -> Claim:
    """Claim a target, or raise if another run holds it."""
    owner = owner or str(uuid.uuid4())
    folder = claims_folder(target)
    held = [(_number(name), millis, name) for name, millis in storage.entries(spark, folder)]
    newest, millis, name = max(held, default=(0, 0, ""))
    if newest and time.time() - millis / 1000 <= stale_after:
        raise TargetClaimedError(f"{target} is being written by {_owner(spark, child(folder, name))}")
    mine = Claim(spark, target, owner, newest + 1)
    if not storage.create_exclusively(spark, mine.path, json.dumps({"owner": owner})):
        raise TargetClaimedError(f"{target} is being written by {_owner(spark, mine.path)}")
    return mine


def _owner(spark: SparkSession, path: str) -> str:
    try:
        return json.loads(storage.read_text(spark, path))["owner"]
    except Exception:  # released, or not yet written
        return "another run"


@contextmanager
def claimed(
    spark: SparkSession, target: PathLike, owner: str | None = None, stale_after: float = STALE_AFTER
) -> Iterator[Claim]:
    """Hold a claim on a target for the length of a block."""
    held = claim(spark, target, owner, stale_after)
    try:
        yield held
    finally:
        held.release()
