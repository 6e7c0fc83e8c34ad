"""Run record and lease of one table, kept as small files beside it.

Record: one file per state a run reached, ``<number>.json``. States, in order:
``staged`` (written, not yet checked), ``verified`` (read back and equal to what
was written), ``publishing`` (the target may be partly replaced), ``done``. A
later run completes one that stopped between ``verified`` and ``done`` before it
does anything else. Numbers rise by one and a file is created exclusively, so
the newest record doesn't depend on any host's clock, and two runs can't write
the same one. The last ``KEEP`` files stay.

Lease: ``lease-<token>.json``, created exclusively. A run holds the table while
its token is the highest and not released; it renews the file's time while it
works. Another run that finds a lease renewed less than ``ttl`` seconds ago (by
the storage's clock, both times) stops before it writes anything. A lease left by
a lost driver runs out and the next token takes over; should the old run wake up,
``check`` finds the higher token and stops it, and its records count as older.

The driver writes all this through the Hadoop file system; no Spark job runs.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession

from ..sources.files import (create_text, delete_file, list_names, modified_at, path_exists,
                             read_text, write_text)

STAGED, VERIFIED, PUBLISHING, DONE = "staged", "verified", "publishing", "done"
KEEP = 20
TTL = 600


class Overlap(RuntimeError):
    """Another run of the same table is at work."""


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def _numbered(spark: SparkSession, folder: str, prefix: str = "") -> list[tuple[int, str]]:
    """(number, path) of the files ``<prefix><number>.json``, ascending."""
    out = []
    for name in list_names(spark, folder):
        stem = name.removesuffix(".json").removeprefix(prefix)
        if name == f"{prefix}{stem}.json" and stem.isdigit():
            out.append((int(stem), f"{folder}/{name}"))
    return sorted(out)


def _load(spark: SparkSession, path: str) -> dict | None:
    """A record; None for one whose writer stopped before its end."""
    try:
        return json.loads(read_text(spark, path))
    except ValueError:
        return None


def write_state(spark: SparkSession, folder: str, run_id: str, state: str, facts: dict) -> None:
    """Add the next record. ``facts`` may name the ``token`` of the run's lease."""
    have = _numbered(spark, folder)
    number = have[-1][0] + 1 if have else 1
    line = json.dumps({"number": number, "token": facts.get("token", 0), "run_id": run_id,
                       "state": state, "facts": facts})
    if not create_text(spark, f"{folder}/{number:012d}.json", line):
        raise Overlap(f"another run wrote record {number} of {folder}")
    for _, old in have[:-KEEP]:
        delete_file(spark, old)


def last_state(spark: SparkSession, folder: str) -> dict | None:
    """The newest record (highest token, then number), its facts unpacked; None if
    there is none."""
    records = [r for _, p in _numbered(spark, folder) if (r := _load(spark, p))]
    if not records:
        return None
    last = max(records, key=lambda r: (r["token"], r["number"]))
    return {**last["facts"], "run_id": last["run_id"], "state": last["state"]}


class Lease:
    """``with Lease(spark, folder, run_id) as lease`` around a run; call ``check``
    before each write that others can see."""

    def __init__(self, spark: SparkSession, folder: str, owner: str, ttl: float = TTL):
        self.spark, self.folder, self.owner, self.ttl = spark, folder, owner, ttl
        self.token = 0
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None

    def _path(self, token: int) -> str:
        return f"{self.folder}/lease-{token:012d}.json"

    def _text(self, released: bool) -> str:
        return json.dumps({"owner": self.owner, "released": released})

    def _storage_time(self) -> int:
        probe = f"{self.folder}/probe-{self.owner}"
        write_text(self.spark, probe, "")
        try:
            return modified_at(self.spark, probe)
        finally:
            delete_file(self.spark, probe)

    def __enter__(self) -> Lease:
        have = _numbered(self.spark, self.folder, "lease-")
        if have:
            newest, path = have[-1]
            held = _load(self.spark, path)
            age = (self._storage_time() - modified_at(self.spark, path)) / 1000
            if not (held and held["released"]) and age < self.ttl:
                raise Overlap(f"run {held['owner'] if held else '?'} holds {self.folder}, renewed "
                              f"{age:.0f} s ago; it ends, or its lease runs out after {self.ttl:.0f} s")
        token = have[-1][0] + 1 if have else 1
        if not create_text(self.spark, self._path(token), self._text(False)):
            raise Overlap(f"another run has just taken {self.folder}")
        self.token = token
        for old, path in have[:-1]:
            delete_file(self.spark, path)
        self._thread = threading.Thread(target=self._renew, daemon=True)
        self._thread.start()
        return self

    def _renew(self) -> None:
        while not self._stop.wait(self.ttl / 5):
            try:
                write_text(self.spark, self._path(self.token), self._text(False))
            except Exception:           # the next turn tries again; without any, the lease runs out
                continue

    def check(self) -> None:
        """Stop if a later run has taken over."""
        newest = _numbered(self.spark, self.folder, "lease-")[-1][0]
        if newest != self.token:
            raise Overlap(f"{self.folder} was taken over (token {newest}, own {self.token}); "
                          "nothing more is written")

    def __exit__(self, *exc) -> None:
        self._stop.set()
        if self._thread:
            self._thread.join()
        if path_exists(self.spark, self._path(self.token)):
            write_text(self.spark, self._path(self.token), self._text(True))
