"""The load history of a table: what its commits say, and what packed files say of commits that have gone.

Every load leaves a commit, so a table that is loaded each minute gets half a
million of them a year. ``pack_history`` writes the load entries of expired
versions together into one file and deletes their commits: a load then lists as
many commits as versions are kept, and ``load_history`` reads few files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD_DDL = ("load_id string, table_name string, mode string, location string, rows_written bigint, "
            "updated bigint, added bigint, removed bigint, started_ms bigint, ended_ms bigint")
#: Expired commits that are worth a file of their own.
PACK = 64


class History:
    """The part of a table store that reads and packs the history."""

    def _commit_loads(self, folder: str) -> DataFrame:
        """(number, load) of the commits in a folder: commits themselves, or packed ones."""
        ddl = f"number bigint, load struct<{', '.join(f.replace(' ', ':', 1) for f in LOAD_DDL.split(', '))}>"
        return self.spark.read.schema(ddl).option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(folder)

    def load_history(self, name: str) -> DataFrame:
        """Every load of the table, oldest first: mode, folder, row counts, times."""
        folders = [f"{self._folder(name)}/{kind}" for kind in ("_history", "_commits") if self._children(f"{self._folder(name)}/{kind}")]
        if not folders:
            return self.spark.createDataFrame([], LOAD_DDL)
        # A commit may be both packed and still there, where packing was interrupted.
        rows = [self._commit_loads(f) for f in folders]
        found = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        found = found.filter(F.col("load.load_id").isNotNull()).groupBy("number").agg(F.first("load").alias("load"))
        return found.sort("number").select("load.*")

    def pack_history(self, name: str, keep: int = 2, least: int = PACK) -> int:
        """Expire all but the last ``keep`` versions (see ``expire_versions``) and, when at least ``least`` expired commits lie
        about, pack their load entries into one file; returns how many were packed.

        The parts of expired versions are deleted first, the entries written next and
        the commits deleted last, so whatever is interrupted is done by the next call.
        """
        self.expire_versions(name, keep)
        own = self._folder(name)
        upto = self._number(f"{own}/_expired")
        old = [f for f in self._children(f"{own}/_commits") if f[:10].isdigit() and int(f[:10]) <= upto]
        commits = [f for f in old if f.endswith(".json")]
        if len(commits) < max(1, least):
            return 0
        self._commit_loads(f"{own}/_commits").filter(F.col("number") <= upto).coalesce(1) \
            .write.json(f"{own}/_history/{upto:010d}-{uuid.uuid4().hex[:8]}")
        for f in old:               # with their claims
            fs, path = self._fs(f"{own}/_commits/{f}")
            fs.delete(path, False)
        return len(commits)
