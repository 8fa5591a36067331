"""Details of loads: an id before a load starts, an entry while it runs, one that stays when it fails, a handle to wait on.

A finished load is found in its table's commits. Of a running one there is a
small entry beside them; a load that fails leaves its entry with the message, so
it is found by its id, too. An entry that still says RUNNING after its
application has gone is that of a load that died without a word (``app_id``
says which application it was).
"""

from __future__ import annotations

import functools
import json
import time
import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

RUNNING, COMPLETED, FAILED = "RUNNING", "COMPLETED", "FAILED"
ENTRY_DDL = ("load_id string, table_name string, mode string, status string, message string, app_id string, started_ms bigint, "
             "ended_ms bigint")

#: The id of the load that this thread is in.
_LOAD: ContextVar[str | None] = ContextVar("load", default=None)


def load_id() -> str:
    return _LOAD.get() or uuid.uuid4().hex


def tracked(method):
    """A load method (store, name, ...): entered before it starts, its entry kept if it fails, dropped once it is committed."""
    @functools.wraps(method)
    def run(self, name: str, *args, **kw):
        if _LOAD.get():                 # part of a load that is tracked already
            return method(self, name, *args, **kw)
        return self._tracked(uuid.uuid4().hex, method, name, *args, **kw)

    return run


class LoadHandle:
    """A load that runs in the background."""

    def __init__(self, store, name: str, own_id: str, future: Future) -> None:
        self.store, self.name, self.load_id, self._future = store, name, own_id, future

    def wait(self, timeout: float | None = None) -> Row:
        """Wait for the end (``TimeoutError`` beyond ``timeout`` seconds) and return the details; a failed load does not raise."""
        self._future.exception(timeout)
        return self.details()

    def details(self) -> Row | None:
        return self.store.load_details(self.name, self.load_id)


class LoadJobs:
    """The part of a table store that keeps the entries."""

    def _entries(self, name: str) -> str:
        return f"{self._folder(name)}/_loads"

    def _enter(self, name: str, entry: dict) -> None:
        fs, path = self._fs(f"{self._entries(name)}/{entry['load_id']}.json")
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()

    def _tracked(self, own_id: str, method, name: str, *args, **kw):
        entry = {"load_id": own_id, "table_name": name, "mode": method.__name__, "status": RUNNING, "message": None,
                 "app_id": self.spark.sparkContext.applicationId, "started_ms": int(time.time() * 1000), "ended_ms": None}
        token = _LOAD.set(own_id)
        try:
            self._enter(name, entry)
            out = method(self, name, *args, **kw)
        except BaseException as e:
            self._enter(name, entry | {"status": FAILED, "message": str(e) or type(e).__name__, "ended_ms": int(time.time() * 1000)})
            raise
        finally:
            _LOAD.reset(token)
        fs, path = self._fs(f"{self._entries(name)}/{own_id}.json")
        fs.delete(path, False)
        return out

    def start_load(self, method: str, name: str, *args, **kw) -> LoadHandle:
        """Start a load method (``"append"``, ``"full_refresh"``, ...) in the background; its id is known at once."""
        load = getattr(type(self), method)
        own_id = uuid.uuid4().hex
        pool = ThreadPoolExecutor(1, thread_name_prefix=f"load-{own_id[:8]}")
        future = pool.submit(self._tracked, own_id, getattr(load, "__wrapped__", load), name, *args, **kw)
        pool.shutdown(wait=False)
        return LoadHandle(self, name, own_id, future)

    def open_loads(self, name: str) -> DataFrame:
        """Loads that run or failed: ENTRY_DDL."""
        fs, path = self._fs(self._entries(name))
        if not fs.exists(path):
            return self.spark.createDataFrame([], ENTRY_DDL)
        return self.spark.read.schema(ENTRY_DDL).option("pathGlobFilter", "*.json").json(self._entries(name))

    def load_details(self, name: str, own_id: str) -> Row | None:
        """What is known of a load: status, mode, times; rows and folder of a finished one, the message of a failed one; None
        when the table never had it."""
        found = self.load_history(name).filter(F.col("load_id") == own_id).first()
        if found is not None:
            return Row(**found.asDict(), status=COMPLETED, message=None)
        return self.open_loads(name).filter(F.col("load_id") == own_id).first()
