"""The few file-system calls Spark's readers and writers do not offer.

Everything goes through Hadoop's FileSystem, so any path Spark can read works.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import SparkSession

_fallback: str | None = None


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder the cluster names for checkpoints.

    Only a local session without that setting (a test) gets a folder of its own.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this application; no DataFrame made from them can be read after."""
    delete(spark, _scratch_root(spark))


def _scratch_root(spark: SparkSession) -> str:
    global _fallback
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _fallback = _fallback or tempfile.mkdtemp(prefix="tidemark-")
        base = _fallback
    return f"{base.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


class _Hadoop:
    """Hadoop's classes, looked up once: every lookup by name is a chain of calls."""

    def __init__(self, context: SparkContext):
        jvm = context._jvm
        self.Path = jvm.org.apache.hadoop.fs.Path
        self.FileContext = jvm.org.apache.hadoop.fs.FileContext
        self.Rename = jvm.org.apache.hadoop.fs.Options.Rename
        self.text = jvm.org.apache.commons.io.IOUtils.toString
        self.conf = context._jsc.hadoopConfiguration()
        self.no_overwrite = context._gateway.new_array(self.Rename, 1)
        self.no_overwrite[0] = self.Rename.NONE


@lru_cache(maxsize=2)
def _hadoop(context: SparkContext) -> _Hadoop:
    return _Hadoop(context)


def _path(spark: SparkSession, path: str):
    return _hadoop(spark.sparkContext).Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(_hadoop(spark.sparkContext).conf)


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def bare(spark: SparkSession, path: str) -> str:
    """The path without scheme and host."""
    return _path(spark, path).toUri().getPath()


# What Spark's writers leave beside their data.
MARKERS = ("_SUCCESS", "_temporary", "_spark_metadata")
MARK_FILES = re.compile(r"_(started|committed)_(vacuum)?\d+")


def children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Entries of a folder as (name, modification time in seconds), by name. Hidden files and
    the marks of Spark's writers are no entries; other names may begin with an underscore."""
    where = _path(spark, path)
    fs = _fs(spark, path)
    if not fs.exists(where):
        return []
    found = [(s.getPath().getName(), s.getModificationTime() / 1000.0, s.isFile()) for s in fs.listStatus(where)]
    return sorted((name, changed) for name, changed, is_file in found if not _is_mark(name, is_file))


def _is_mark(name: str, is_file: bool) -> bool:
    return name.startswith(".") or name in MARKERS or (is_file and MARK_FILES.fullmatch(name) is not None)


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """(path without scheme, modification time) of all that match a pattern, in one call."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern)) or []
    return [(s.getPath().toUri().getPath(), s.getModificationTime() / 1000.0) for s in found]


def size(spark: SparkSession, path: str) -> int:
    if not exists(spark, path):
        return 0
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return _hadoop(spark.sparkContext).text(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False when another writer has it.

    The text goes to a hidden file first and is renamed without overwrite, so readers
    see the whole file or none. Object stores need a committer with conditional renames.
    """
    hadoop = _hadoop(spark.sparkContext)
    folder, _, name = path.rpartition("/")
    draft = _path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    fs = draft.getFileSystem(hadoop.conf)
    draft = fs.makeQualified(draft)
    out = fs.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    try:
        hadoop.FileContext.getFileContext(draft.toUri(), hadoop.conf).rename(draft, hadoop.Path(path), hadoop.no_overwrite)
        return True
    except Exception:
        if not fs.exists(hadoop.Path(path)):
            raise
        fs.delete(draft, False)
        # a rename may fail after it has taken effect
        return read_text(spark, path) == text
