"""Claims on pieces of work, so that two drivers never load the same month at once.

A claim is a small file ``<name>.<generation>`` in a shared folder, made only if
it is not there yet, which exactly one contender achieves. It holds its owner and
the time until which it is valid. Nobody takes a claim away: a claim whose time
has passed (its driver died) is succeeded by the next generation, which again
only one contender can make. The highest generation is the one that counts.

Needs a file system that makes a file only once (local disks, HDFS, stores with
conditional puts); clocks of drivers may differ by less than the claims last.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from strata.sources.paths import children, create_once, delete, read_text


class ClaimLost(RuntimeError):
    """The work went to another driver since its claim ran out."""


@dataclass(frozen=True)
class Claim:
    name: str
    generation: int
    owner: str
    until: float


def _generations(spark: SparkSession, folder: str, names: set[str]) -> dict[str, list[int]]:
    """Generations there are, a list for each name; one listing for all names."""
    found: dict[str, list[int]] = {}
    for entry in children(spark, folder):
        name, _, generation = entry.rpartition(".")
        if name in names and generation.isdigit():
            found.setdefault(name, []).append(int(generation))
    return found


def _until(spark: SparkSession, folder: str, name: str, generation: int) -> float:
    """Until when a claim is valid; one that is gone has ended, one being written has not."""
    text = read_text(spark, f"{folder}/{name}.{generation}")
    if text is None:
        return 0.0
    return float(text.partition(" ")[0]) if text.endswith("\n") else float("inf")


def take(spark: SparkSession, folder: str, names: Iterable[str], seconds: float, now: float | None = None) -> list[Claim]:
    """Claims on those of ``names`` that nobody holds; each is valid for ``seconds``."""
    names, now, owner = sorted(set(names)), time.time() if now is None else now, uuid.uuid4().hex
    there, taken = _generations(spark, folder, set(names)), []
    for name in names:
        last = max(there.get(name, [0]))
        if last and _until(spark, folder, name, last) > now:
            continue
        new = Claim(name, last + 1, owner, now + seconds)
        if create_once(spark, f"{folder}/{name}.{new.generation}", f"{new.until} {owner}\n"):
            taken.append(new)
    return taken


def wait_for(spark: SparkSession, folder: str, name: str, seconds: float, pause: float = 0.2) -> Claim:
    """The claim on ``name``, as soon as whoever has it gives it up or runs out of time."""
    while True:
        got = take(spark, folder, [name], seconds)
        if got:
            return got[0]
        time.sleep(pause)


def lost(spark: SparkSession, folder: str, claims: Iterable[Claim], now: float | None = None) -> list[str]:
    """Names of claims that ran out or were succeeded by another driver's."""
    claims, now = list(claims), time.time() if now is None else now
    there = _generations(spark, folder, {c.name for c in claims})
    return [c.name for c in claims if c.until <= now or max(there.get(c.name, [0])) != c.generation]


def release(spark: SparkSession, folder: str, claims: Iterable[Claim]) -> None:
    """Give up claims; also removes the ended generations below them."""
    claims = list(claims)
    there = _generations(spark, folder, {c.name for c in claims})
    for c in claims:
        for generation in sorted(there.get(c.name, [])):  # the own one last: until then nobody starts anew below it
            if generation <= c.generation:
                delete(spark, f"{folder}/{c.name}.{generation}")
