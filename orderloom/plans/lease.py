"""The lease of a run: a mark in its folder that the driver renews while it lives."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from orderloom import files

LEASE = "_lease"
LEASE_SECONDS = 600.0


class Lease:
    """Held from creation until `release`, or until its driver no longer renews it.

    The file's modification time says when it was renewed, its content for how many seconds
    that holds; both by the storage's clock. A run whose lease has lapsed may not publish,
    and its folder may be reclaimed once as much time again has passed.
    """

    def __init__(self, spark: SparkSession, folder: str, seconds: float = LEASE_SECONDS):
        self._spark, self._folder, self._seconds = spark, folder, seconds
        self._path = f"{folder}/{LEASE}"
        self._over = threading.Event()
        files.write_text(spark, self._path, str(seconds))
        self._renewer = threading.Thread(target=self._keep, name="lease", daemon=True)
        self._renewer.start()

    def _keep(self) -> None:
        while not self._over.wait(self._seconds / 4):
            try:
                if not self._over.is_set() and files.exists(self._spark, self._path):
                    files.write_text(self._spark, self._path, str(self._seconds))
            except Exception:
                # Storage out of reach: the next turn tries again, and the lease lapses meanwhile.
                continue

    def held(self) -> bool:
        return lease_age(self._spark, self._folder) <= 1

    def release(self) -> None:
        self._over.set()
        self._renewer.join()
        files.delete(self._spark, self._path)


def lease_age(spark: SparkSession, folder: str) -> float:
    """Time since the last renewal, in terms of the lease: above 1 it has lapsed.

    A folder without a lease has no age that says anything and counts as lapsed for its run only.
    """
    path = f"{folder}/{LEASE}"
    if not files.exists(spark, path):
        return float("inf")
    seconds = files.read_text(spark, path)
    if not seconds:
        return 0.0  # just being renewed
    passed = files.clock_ms(spark, folder) - files.modified_ms(spark, path)
    return passed / 1000 / float(seconds)


def reclaimable(spark: SparkSession, folder: str) -> bool:
    """Whether the folder's run has a lease that lapsed at least as long ago as it held."""
    return 2 < lease_age(spark, folder) < float("inf")
