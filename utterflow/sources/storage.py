"""Files that tasks read and write themselves, on any file system pyarrow knows (file, hdfs, s3, ...).

Roots are URIs or absolute paths of storage that all nodes share. A path without
a scheme means Spark's default file system: ``qualified`` names it on the
driver, before the path goes to tasks.
"""

from __future__ import annotations

import fnmatch
import os
import re
from functools import lru_cache

import pyarrow.fs as pafs

_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.S)


def qualified(spark, path: str) -> str:
    """``path`` as a URI with the scheme that Spark reads it with: the default file system's, if it has none."""
    if _URI.match(path):
        return path
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:             # no driver JVM (e.g. Spark Connect): paths must be URIs there, or local
        return path
    hadoop = jvm.org.apache.hadoop.fs
    uri = hadoop.FileSystem.getDefaultUri(conf)
    here = hadoop.Path("/") if path.startswith("/") else hadoop.FileSystem.get(conf).getWorkingDirectory()
    named = hadoop.Path(path).makeQualified(uri, here).toString()
    return re.sub(r"^file:/(?!/)", "file:///", named)


@lru_cache(maxsize=64)
def _system(scheme: str, authority: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.LocalFileSystem(), "") if scheme == "file" else pafs.FileSystem.from_uri(f"{scheme}://{authority}/")


def open_root(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI. Paths are taken as they are, never percent-decoded."""
    m = _URI.match(root)
    if not m:
        return _system("file", "")[0], os.path.abspath(root)
    fs, base = _system(m[1], m[2] or "")
    return fs, (base.rstrip("/") + (m[3] or "")).rstrip("/") or "/"


def patterns_of(glob: str) -> list[str]:
    """A file-name pattern with its ``{a,b}`` alternatives spelled out."""
    m = re.search(r"\{([^{}]*)\}", glob)
    if not m:
        return [glob]
    return [p for alternative in m[1].split(",") for p in patterns_of(glob[:m.start()] + alternative + glob[m.end():])]


def list_matching(pattern: str) -> list[str]:
    """URIs or paths of the files that match a glob pattern, sorted."""
    at = min((pattern.index(c) for c in "*?[" if c in pattern), default=len(pattern))
    base = pattern if at == len(pattern) else pattern[:at].rpartition("/")[0]
    fs, root = open_root(base)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [pattern]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    wanted = root + pattern.rstrip("/")[len(base.rstrip("/")):] if at < len(pattern) else f"{root}/*"
    prefix = base.rstrip("/")[:len(base.rstrip("/")) - len(root)] if base.rstrip("/").endswith(root) else ""
    return sorted(prefix + f.path for f in found if f.type == pafs.FileType.File
                  and not f.base_name.startswith(".") and fnmatch.fnmatchcase(f.path, wanted)
                  and f.path.count("/") == wanted.count("/"))
