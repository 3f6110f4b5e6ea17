"""Errors of one table that must not stop the others."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

#: An error of a plan is the first; one of a running job may come as the second; a missing table as the third.
FAILURES = (PySparkException, Py4JJavaError, FileNotFoundError)


def first_line(error: BaseException) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]
