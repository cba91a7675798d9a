"""Folders whose content is replaced as a whole, safe against two writers and lost drivers.

A writer fills a folder of its own, ``versions/<id>``, and then publishes it: the
numbered file ``manifests/<n>.json``, which names the folder, comes into being by one atomic step that fails if the
number is taken. Readers follow the manifest with the highest number, so they see the old content or the new one, never
a part; what a killed writer left behind is named nowhere. A writer that started from
version ``n`` publishes ``n + 1`` or learns that another one did, and starts again from there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

DIGITS = 12
RETRIES = 20


class Taken(Exception):
    """Another writer published this number first."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    store = _store(spark, path)
    if not store.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _store(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _store(spark, path).create(_path(spark, path), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> Version | None:
    """The published version of a folder, if there is one."""
    base = path.rstrip("/")
    names = [n for n in list_folder(spark, f"{base}/manifests") if n.endswith(".json") and n.removesuffix(".json").isdigit()]
    if not names:
        return None
    found = json.loads(read_text(spark, f"{base}/manifests/{names[-1]}"))
    return Version(int(names[-1].removesuffix(".json")), f"{base}/versions/{found['version']}")


def _publish(spark: SparkSession, path: str, number: int, version: str) -> None:
    """Give the version its number, in one step that fails if the number is taken."""
    jvm, base = spark._jvm, path.rstrip("/")
    target = f"{base}/manifests/{number:0{DIGITS}d}.json"
    draft = f"{base}/versions/{version}.json"
    write_text(spark, draft, json.dumps({"version": version}))
    store = _store(spark, base)
    store.mkdirs(_path(spark, f"{base}/manifests"))
    try:
        if store.getScheme() == "file":
            # a local rename replaces what is there; a link does not
            local = lambda p: jvm.java.nio.file.Paths.get(_path(spark, p).toUri().getPath(), spark._sc._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(local(target), local(draft))
        else:
            none = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            qualified = store.makeQualified(_path(spark, base)).toUri()
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified, spark._jsc.hadoopConfiguration())
            context.rename(_path(spark, draft), _path(spark, target), none)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            raise Taken(target) from error
        raise


def replace(spark: SparkSession, path: str, write: Callable[[str, Version | None], None], retries: int = RETRIES) -> Version:
    """Write a new version and publish it.

    ``write(folder, before)`` fills the folder; ``before`` is the version it starts from. If another writer
    publishes in the meantime, it is called again with that version.
    """
    base = path.rstrip("/")
    for _ in range(retries):
        before, version = latest(spark, base), uuid.uuid4().hex
        folder = f"{base}/versions/{version}"
        write(folder, before)
        number = 1 if before is None else before.number + 1
        try:
            _publish(spark, base, number, version)
        except Taken:
            continue
        return Version(number, folder)
    raise RuntimeError(f"{path}: {retries} other writers came first")


def prune(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` published versions, and their number; drafts of running writers stay."""
    if keep < 1:
        raise ValueError("at least the last version must be kept")
    base, store = path.rstrip("/"), _store(spark, path)
    names = [n for n in list_folder(spark, f"{base}/manifests") if n.endswith(".json")][:-keep]
    for name in names:
        version = json.loads(read_text(spark, f"{base}/manifests/{name}"))["version"]
        store.delete(_path(spark, f"{base}/manifests/{name}"), False)
        store.delete(_path(spark, f"{base}/versions/{version}.json"), False)
        store.delete(_path(spark, f"{base}/versions/{version}"), True)
    return len(names)
