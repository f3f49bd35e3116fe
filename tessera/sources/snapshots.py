"""Index snapshots: whole folders behind a pointer, so that there is an index at every moment.

``path/snapshots/<name>/<table>`` hold the tables of one build, ``path/current/<number>-<name>`` are empty files: the one
with the highest number names the snapshot that counts. A build writes its own folder, is checked there, and only then
gets its pointer; a pointer is made by an exclusive create, so of two builds that finish together one is numbered
after the other. A reader picks a snapshot once and keeps it, whatever is published meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tessera.sources import files


def new(path: str) -> tuple[str, str]:
    """Name and folder of a snapshot to be written."""
    name = uuid.uuid4().hex
    return name, f"{path.rstrip('/')}/snapshots/{name}"


def pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and snapshot of every pointer, in order."""
    found = (n.split("-", 1) for n in files.names(spark, f"{path.rstrip('/')}/current") if n[:1].isdigit() and "-" in n)
    return sorted((int(number), name) for number, name in found)


def publish(spark: SparkSession, path: str, name: str) -> int:
    """Make a written snapshot the one that counts; its number.

    A number belongs to whoever makes its claim file first; the pointer itself appears with its whole content, which is its name.
    """
    number = max((n for n, _ in pointers(spark, path)), default=0)
    while True:
        number += 1
        if files.mark(spark, f"{path.rstrip('/')}/claims/{number:012d}"):
            break
    files.mark(spark, f"{path.rstrip('/')}/current/{number:012d}-{name}")
    return number


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the snapshot that counts, None without any."""
    found = pointers(spark, path)
    return f"{path.rstrip('/')}/snapshots/{found[-1][1]}" if found else None


def sweep(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` published snapshots, which readers may hold; folders that were never published stay, as a build may be writing them."""
    old = pointers(spark, path)[:-keep] if keep else []
    still = {name for _, name in pointers(spark, path)[-keep:]}
    for number, name in old:
        files.remove(spark, f"{path.rstrip('/')}/current/{number:012d}-{name}")
        if name not in still:
            files.remove(spark, f"{path.rstrip('/')}/snapshots/{name}")
    return [name for _, name in old]
