"""Files that cannot be read at all - cut off archives, lost blocks, denied access - found without giving
up the files around them.

Spark ends a job at the first such file. Only then are the files tested in groups: a group that fails
names one file and is divided, a group that passes is done. So a healthy folder costs nothing, and each
bad file a few partial scans, whatever its format or size. The groups are a hash of the file's path,
which Spark prunes files by, so that no list of files is held.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial
from typing import TypeVar

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import together

#: Parts of a group that failed, and groups tested at once.
PARTS, AT_ONCE = 4, 16
#: A folder with more unreadable files than this is refused as a whole.
MOST_UNREADABLE = 1000

_FAILED = re.compile(r"\[FAILED_READ_FILE[.\w]*\].*?reading file (.*?)\.(?:\s+SQLSTATE| File)", re.DOTALL)

Out = TypeVar("Out")


def unreadable_path(error: Exception) -> str | None:
    """The file that an error names as unreadable, or None for any other error."""
    found = _FAILED.search(str(error))
    # The message writes an empty authority, the metadata column does not.
    return re.sub(r"^([\w+.-]+):///", r"\1:/", found[1]) if found else None


def not_among(paths: list[str]) -> Column:
    """Rows of other files; Spark does not open the files themselves."""
    return ~F.col("_metadata.file_path").isin(paths) if paths else F.lit(True)


def _first_failure(spark: SparkSession, folder: str, modulus: int, residue: int, known: list[str]) -> str | None:
    files = spark.read.option("recursiveFileLookup", "true").text(folder).where(not_among(known))
    group = files.where(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(modulus)) == residue)
    try:
        group.agg(F.count("value")).collect()
    except (Py4JError, PySparkException) as error:
        path = unreadable_path(error)
        if path is None or path in known:
            raise
        return path
    return None


def unreadable_files(spark: SparkSession, folder: str) -> list[str]:
    """The paths of all files below ``folder``, at any depth, that cannot be read."""
    found: list[str] = []
    groups = [(1, 0)]
    while groups:
        some, groups = groups[:AT_ONCE], groups[AT_ONCE:]
        failures = together(spark, *[partial(_first_failure, spark, folder, m, r, list(found)) for m, r in some])
        for (modulus, residue), path in zip(some, failures, strict=True):
            if path is not None:
                found.append(path)
                groups += [(modulus * PARTS, residue + modulus * part) for part in range(PARTS)]
        if len(found) > MOST_UNREADABLE:
            raise RuntimeError(f"more than {MOST_UNREADABLE} files below {folder} cannot be read")
    return sorted(found)


def isolated(spark: SparkSession, folder: str, act: Callable[[list[str]], Out]) -> Out:
    """``act([])``; if that fails and files below ``folder`` cannot be read, ``act`` once more with all
    such files, which it must leave out. Readers that parse whole files may fail without naming one, so
    the files are tested after any failed job; without a bad file the error is raised as it was."""
    try:
        return act([])
    except AnalysisException:
        raise
    except (Py4JError, PySparkException):
        if not (lost := unreadable_files(spark, folder)):
            raise
    return act(lost)
