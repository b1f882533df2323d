"""One run at a time writes a dataset.

An owner file beside the dataset is created exclusively, and holds the run's token. The run renews it
while it lives. A file that was not renewed for ``LEASE_SECONDS`` is a dead run's: the next run
takes over by moving it away, which only one run can do, and creates its own. The token is read again
before each renewal, publish and delete, so a run that paused, was overtaken and wakes fails with
:class:`Overtaken` instead of touching what its successor owns. What a run stages carries
its token in its name, so that two runs never write the same files.

Ages are taken from the file system's clock alone. (Where a file system cannot create a file exclusively, as some
object stores, two runs that start at the same moment may both begin; the later token stays, and the other run fails
before it publishes.)
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from uuid import uuid4

from pyspark.sql import SparkSession

from stratalake.sinks import storage

_OWNER = "__owner"
_DEAD = "__dead"
_CLOCK = "__now"

# A run that lives renews its ownership several times within this.
LEASE_SECONDS = 300


class Overtaken(RuntimeError):
    """Another run owns what this one was writing."""


class Owner:
    """A run's hold on a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.run = spark, path, uuid4().hex
        self.file = path.rstrip("/") + _OWNER
        self._text = json.dumps({"run": self.run, "application": spark.sparkContext.applicationId})
        self._over, self._reading = threading.Event(), threading.Lock()
        self._renewing = threading.Thread(target=self._renew, daemon=True)

    @property
    def suffix(self) -> str:
        """What the names of this run's stages end with."""
        return f"_{self.run}"

    def take(self) -> None:
        if not storage.create_new(self.spark, self.file, self._text):
            self._take_over()
        self._renewing.start()

    def _take_over(self) -> None:
        found, age = storage.read_if_exists(self.spark, self.file), self._age()
        if age is not None and age < LEASE_SECONDS:
            raise RuntimeError(f"another run is writing {self.path}, by {self.file}, renewed {age:.0f} seconds ago")
        dead = f"{self.file}{_DEAD}{self.suffix}"
        if age is not None and storage.rename(self.spark, self.file, dead):
            if storage.read_if_exists(self.spark, dead) != found:  # a third run was faster
                storage.rename(self.spark, dead, self.file)
            else:
                storage.delete(self.spark, dead)
        if not storage.create_new(self.spark, self.file, self._text):
            raise RuntimeError(f"another run has begun to write {self.path}, by {self.file}")

    def _age(self) -> float | None:
        """Seconds since the owner file was written, by the clock that stamps files; None if it is gone."""
        written = storage.written_at(self.spark, self.file)
        if written is None:
            return None
        clock = f"{self.file}{_CLOCK}{self.suffix}"
        storage.write_text(self.spark, clock, "")
        now = storage.written_at(self.spark, clock)
        storage.delete(self.spark, clock)
        return (now - written) / 1000

    def holds(self) -> bool:
        with self._reading:
            return storage.read_if_exists(self.spark, self.file) == self._text

    def require(self) -> None:
        """Fail if another run has taken over."""
        if not self.holds():
            raise Overtaken(f"another run has taken over {self.path}; this one publishes nothing")

    def _renew(self) -> None:
        while not self._over.wait(LEASE_SECONDS / 5):
            with suppress(Exception):  # tried again; what publishes looks for itself
                if not self.holds():
                    return
                with self._reading:
                    storage.write_text(self.spark, self.file, self._text)

    def release(self) -> None:
        self._over.set()
        self._renewing.join()
        if self.holds():
            storage.delete(self.spark, self.file)


@contextmanager
def owned(spark: SparkSession, path: str) -> Iterator[Owner]:
    """Own a dataset while writing it; fail if another run does."""
    owner = Owner(spark, path)
    owner.take()
    try:
        yield owner
    except Exception:
        owner.require()  # what failed may be for want of what the successor has cleared away
        raise
    finally:
        owner.release()
