"""Versions of a folder by optimistic commits: what was written apart becomes visible at once, or not at all.

A version is a file ``commits/<number>.json``.  A writer writes its data to places of their own, then claims the next
number; the claim fails if another writer has it, and then the writer reads what is there now and tries again.  A claim
is a hard link on a file system of this machine and a rename that does not replace elsewhere: both are atomic, as on any file
system whose renames are.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Commits:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        root = self._hadoop("")
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._fs.getScheme() == "file"

    def _hadoop(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def new_place(self, kind: str) -> str:
        """A folder that no other writer writes to, below this one."""
        return f"{kind}/{uuid.uuid4().hex}"

    def versions(self) -> list[int]:
        folder = self._hadoop("commits")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._hadoop(f"commits/{version:020d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """Number and content of the last version; 0 and nothing if there is none."""
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else (0, {})

    def claim(self, version: int, content: dict) -> bool:
        """Make ``content`` the version of this number, one above the last; False if another writer has it."""
        draft, final = self._hadoop(f"drafts/{uuid.uuid4().hex}"), self._hadoop(f"commits/{version:020d}.json")
        stream = self._fs.create(draft, False)
        stream.write((json.dumps(content) + "\n").encode())
        stream.close()
        self._fs.mkdirs(final.getParent())
        try:
            if self._local:
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            else:
                jvm = self.spark._jvm
                rename = jvm.org.apache.hadoop.fs.Options.Rename
                options = self.spark.sparkContext._gateway.new_array(rename, 1)
                options[0] = rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, final, options)
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        finally:
            if self._fs.exists(draft):
                self._fs.delete(draft, False)
        return True

    def change(self, make: Callable[[int, dict], dict | None], tries: int = 100) -> tuple[int, dict] | None:
        """Commit what ``make`` makes of the last version, anew as long as another writer is faster; None from it commits nothing.

        Whatever ``make`` has written for a try that fails stays unseen.
        """
        for n in range(tries):
            version, content = self.latest()
            new = make(version, content)
            if new is None:
                return None
            if self.claim(version + 1, new):
                return version + 1, new
            time.sleep(random.random() * 0.02 * min(n + 1, 20))
        raise TimeoutError(f"{tries} tries, and another writer was faster each time")

    def delete(self, place: str) -> None:
        self._fs.delete(self._hadoop(place), True)
