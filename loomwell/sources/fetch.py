"""Archives over HTTP and whole texts by path."""

from __future__ import annotations

import http.client
import random
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCHED = "path string, content binary, error string"
#: Answers that another try may change.
PASSING = {408, 425, 429, 500, 502, 503, 504}


def get(url: str, timeout: float = 60.0, attempts: int = 3, pause: float = 60.0) -> tuple[bytes | None, str | None]:
    """(content, None), or (None, what went wrong last). Timeouts, broken connections and answers of PASSING are tried again after a
    pause that grows with each try; other answers (a missing archive) and unknown addresses are not."""
    error = None
    for n in range(attempts):
        if n:
            time.sleep(pause * n * random.uniform(0.5, 1.0))
        try:
            with urllib.request.urlopen(url, timeout=timeout) as answer:
                return answer.read(), None
        except urllib.error.HTTPError as e:
            error = f"HTTP {e.code}"
            if e.code not in PASSING:
                break
        except urllib.error.URLError as e:
            error = str(e.reason)
            if not isinstance(e.reason, OSError):
                break
        except (OSError, http.client.HTTPException) as e:
            error = str(e) or type(e).__name__
    return None, error


def fetch(paths: DataFrame, base: str, timeout: float = 60.0, attempts: int = 3, pause: float = 60.0, stagger: float = 10.0, tasks: int | None = None) -> DataFrame:
    """Rows of FETCHED, one for each row of ``paths`` (wet_path): the bytes under ``base`` + path, or the error.

    A task holds one archive at a time. Each begins at a random moment within ``stagger`` seconds, so that a job's tasks don't ask at
    once; ``tasks`` deals the paths over so many. Archives with an error aren't finished in the ledger and come up again; a lost
    executor's paths are fetched anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        time.sleep(random.uniform(0, stagger))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                content, error = get(base + path, timeout, attempts, pause) if path else (None, "no path")
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([content], pa.binary()), pa.array([error], pa.string())], ["path", "content", "error"])

    own = paths.select("wet_path")
    return (own if tasks is None else own.repartition(tasks)).mapInArrow(run, FETCHED)


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): each file as one text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
