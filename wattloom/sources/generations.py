"""Whole tables published at once: generation folders and one small mark.

A rebuilt table is written to a new generation folder inside the table's folder. Then an
empty file is created whose name holds a running number and the generation's name, which
is a single step on any file system or object store and copies nothing. The mark with the
highest number says where the table is, so a reader finds the old table or the new one,
never none. The generation before stays for readers that are under way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from wattloom.session import delete_path, hadoop_path

MARK, FOLDER = "_current.", "generation-"
KEPT = 2


def _marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and generation of every mark, the valid one last."""
    fs, place = hadoop_path(spark, path)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    parts = [name[len(MARK) :].split(".") for name in names if name.startswith(MARK)]
    return sorted((int(number), generation) for number, generation in parts)


def located(spark: SparkSession, path: str) -> str:
    """The folder that holds the table now: a generation, or ``path`` itself where the
    table was never published."""
    marks = _marks(spark, path)
    return f"{path.rstrip('/')}/{FOLDER}{marks[-1][1]}" if marks else path


@contextmanager
def publishing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new generation folder of the table at ``path``, which is published when the
    block ends, and removed if the block fails.

    Of two that are published at once the one with the greater name is valid, and the
    other is gone, as if it had come first. Generations before the last two are deleted,
    and so is what an unpublished table left in the folder.
    """
    generation = uuid.uuid4().hex
    new = f"{path.rstrip('/')}/{FOLDER}{generation}"
    try:
        yield new
        fs, new_place = hadoop_path(spark, new)
        fs.mkdirs(new_place)
        marks = _marks(spark, path)
        number = marks[-1][0] + 1 if marks else 0
        _, mark = hadoop_path(spark, f"{path.rstrip('/')}/{MARK}{number:012d}.{generation}")
        if not fs.createNewFile(mark):
            raise OSError(f"cannot publish {new}")
    except BaseException:
        delete_path(spark, new)
        raise
    _clean(spark, path, [*marks, (number, generation)])
    spark.catalog.refreshByPath(path)


def _clean(spark: SparkSession, path: str, marks: list[tuple[int, str]]) -> None:
    fs, place = hadoop_path(spark, path)
    for number, generation in marks[:-KEPT]:
        # a generation goes after its mark, so that no mark leads nowhere
        delete_path(spark, f"{path.rstrip('/')}/{MARK}{number:012d}.{generation}")
        delete_path(spark, f"{path.rstrip('/')}/{FOLDER}{generation}")
    for status in fs.listStatus(place):
        if not status.getPath().getName().startswith((MARK, FOLDER)):
            fs.delete(status.getPath(), True)
