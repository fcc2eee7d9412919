"""Journalled commits of staged files.

A commit first writes a journal beside the staged files: which file goes where, and what files each window
has then. From then on the commit is decided; whoever comes next can finish it, as every step may be done
again. Manifests, one per day and pane, remember each window's files, so that a window written again with
fewer shards loses the files it no longer has. Nothing that a commit of the same output has not written
itself is ever deleted.
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import SparkSession

from windrow import hadoop

JOURNAL = "_journal.json"
MANIFESTS = "_windows"
STAGING = "_staging"


def decide(
    spark: SparkSession, staging: str, moves: list[tuple[str, str]], windows: dict[str, dict[str, list[str]]]
) -> None:
    """Write the journal: ``moves`` of staged files, and by manifest path the files of each window."""
    journal = {"moves": moves, "windows": windows}
    hadoop.write_text(spark, hadoop.join(staging, JOURNAL), json.dumps(journal))


def finish(spark: SparkSession, staging: str) -> None:
    """Carry out the journal of a staging folder, whatever part of it has been done before."""
    journal = json.loads(hadoop.read_text(spark, hadoop.join(staging, JOURNAL)))
    hadoop.replace_all(spark, [(a, b) for a, b in journal["moves"]], moved_before=True)

    def remember(entry: tuple[str, dict[str, list[str]]]) -> None:
        path, windows = entry
        known = json.loads(hadoop.read_text(spark, path)) if hadoop.exists(spark, path) else {}
        stale = {file for window in windows for file in known.get(window, [])}
        known.update(windows)
        stale -= {file for files in known.values() for file in files}
        for file in stale:
            hadoop.delete(spark, file)
        hadoop.write_text(spark, path, json.dumps(known))

    hadoop.in_parallel(remember, journal["windows"].items())
    hadoop.delete(spark, staging)


def finish_all(spark: SparkSession, staging_set: str) -> int:
    """Finish every decided commit below a folder of staging folders; returns their number."""
    journals = hadoop.glob_below(spark, staging_set, f"*/{JOURNAL}")
    for journal in journals:
        finish(spark, journal.rsplit("/", 1)[0])
    return len(journals)


def by_manifest(base: str, files: list[tuple[str, str, str]]) -> dict[str, dict[str, list[str]]]:
    """Files grouped for ``decide``, from rows of day, window and path."""
    windows: dict[str, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
    for day, window, path in sorted(files):
        windows[hadoop.join(base, f"{day}.json")][window].append(path)
    return windows
