"""WET archives as DataFrames: gzip files through Spark's binary source, records by a tolerant scan."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomwell.operators.records import CONVERSION_FIELDS, INFO_FIELDS

SCHEMA = "wet_path string, warc_record_id string, headers map<string,string>, info map<string,string>, content string, truncated boolean, records long, log_message string"
#: Lines that aren't fields, beyond the number of required fields, before a record that lacks one counts as corrupt.
EXTRA_TRIES = 4
#: Characters of contents after which a batch of records leaves, however few they are.
BATCH_CHARS = 1 << 20
#: What a finished archive's ledger row says (fixed values).
NORMAL = "File Parsed Normally"
CORRUPT = "File Parsed - Some corruption detected"
NO_INFO = "Unable to Parse File - didn't even get a complete WARCInfo record. Is the file corrupt?"
END_CORRUPT = "End of file was corrupt, some records were extracted successfully."
END_CORRUPT_EMPTY = "End of file was corrupt and no WARC Conversion records were extracted successfully."


#: What is trimmed at both ends of a content: the space and all control characters before it.
BLANK = "".join(map(chr, range(33)))


class StepLimit(RuntimeError):
    pass


class _Scan:
    """One archive: header blocks, contents by their length in bytes, resynchronisation at the next version line."""

    def __init__(self, stream, step_limit: int = 0):
        self.stream, self.left, self.limit = stream, step_limit, step_limit
        self.corrupt = self.ended = False

    def step(self) -> None:
        self.left -= 1
        if self.limit and self.left < 0:
            raise StepLimit(f"more than {self.limit} steps")

    def line(self) -> str | None:
        raw = self.stream.readline()
        if not raw:
            self.ended = True
            return None
        return raw.decode("utf-8", "replace").rstrip()

    def headers(self, required: tuple[str, ...], kind: str) -> dict[str, str] | None:
        """Fields up to the blank line once all required ones are there; None if lines run out, tries do, or the type differs."""
        need = set(required) - {"Content"}
        out: dict[str, str] = {}
        # Only lines that aren't fields of the first block count, so that any number of further fields may stand anywhere in it.
        tries, block = len(required) + EXTRA_TRIES + 1, True
        while need <= out.keys() or tries > 0:
            self.step()
            line = self.line()
            if line is None:
                return None if not out else {}
            parts = line.split(": ")
            if len(parts) == 2:
                if parts[0] == "WARC-Type" and parts[1] != kind:
                    return None
                out[parts[0]] = parts[1]
            elif not line and need <= out.keys():
                return out
            else:
                block = block and (bool(line) or not out)
            tries -= not (block and len(parts) == 2)
        self.corrupt = True
        return None

    def content(self, length: str) -> tuple[str, bool]:
        self.step()
        n = int(length) if length.isdigit() else 0
        raw = self.stream.read(n)
        self.stream.read(2)
        return raw.decode("utf-8", "replace").strip(BLANK), len(raw) < n

    def resync(self) -> bool:
        while True:
            self.step()
            line = self.line()
            if line is None:
                return False
            if "WARC/1.0" in line:
                return True


def parse(stream, step_limit: int = 0) -> Iterator[tuple]:
    """(headers, info, content, truncated, records so far, log message) per record; a last row without headers closes the archive."""
    scan, n = _Scan(stream, step_limit), 0
    info = scan.headers(INFO_FIELDS, "warcinfo")
    if not info:
        yield None, None, None, False, 0, NO_INFO
        return
    info["Content"], _ = scan.content(info["Content-Length"])
    message = None
    while message is None:
        headers = scan.headers(CONVERSION_FIELDS, "conversion")
        if headers:
            text, short = scan.content(headers["Content-Length"])
            n += 1
            yield headers, info, text, short, n, None
        elif headers == {}:
            message = END_CORRUPT if n else END_CORRUPT_EMPTY
        elif scan.ended:
            message = CORRUPT if scan.corrupt else NORMAL
        elif not scan.resync():
            message = END_CORRUPT if n else END_CORRUPT_EMPTY
    yield None, info, None, False, n, message


def read_wet(spark: SparkSession, path: str, step_limit: int = 0, rows: int = 256) -> DataFrame:
    """Archives under a path of any store that Spark reads, see parse_archives()."""
    return parse_archives(spark.read.format("binaryFile").load(path).select("path", "content"), step_limit, rows)


def parse_archives(files: DataFrame, step_limit: int = 0, rows: int = 256) -> DataFrame:
    """Rows of SCHEMA from (path, content): one for each conversion record, and one for each archive (warc_record_id null) with its outcome.

    An archive is one task; members of a gzip file are read as one stream and records leave in batches of ``rows`` or BATCH_CHARS,
    so what a task holds is the Arrow batch of compressed archives that it was given, which are read in place, and a batch of records. A corrupt gzip stream, wherever it breaks, ends the archive as a
    corrupt end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("wet_path", pa.string()), ("warc_record_id", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("info", pa.map_(pa.string(), pa.string())), ("content", pa.string()), ("truncated", pa.bool_()), ("records", pa.int64()), ("log_message", pa.string())])
        for batch in batches:
            for k in range(batch.num_rows):
                name, raw = batch.column(0)[k].as_py(), pa.BufferReader(batch.column(1)[k].as_buffer())
                zipped = raw.read(2) == b"\x1f\x8b"
                raw.seek(0)
                stream = gzip.GzipFile(fileobj=raw) if zipped else io.BufferedReader(raw)
                held, chars = [], 0

                def flush(held: list[tuple] = held):
                    out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], schema.field(i).type) for i in range(len(schema))], schema=schema)
                    held.clear()
                    return out

                n = 0
                try:
                    for headers, info, text, short, n, message in parse(stream, step_limit):
                        held.append((name, headers and headers.get("WARC-Record-ID"), headers and list(headers.items()), info and list(info.items()), text, short, n, message))
                        chars += len(text or "")
                        if len(held) >= rows or chars >= BATCH_CHARS:
                            yield flush()
                            chars = 0
                except (EOFError, OSError, zlib.error):
                    held.append((name, None, None, None, None, False, n, END_CORRUPT if n else END_CORRUPT_EMPTY))
                yield flush()

    return files.mapInArrow(run, SCHEMA)
