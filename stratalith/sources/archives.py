"""Listings of archives and binaries, from tables of (path, content): files stay where Spark read them."""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_binaries(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)


#: Bytes of files that a batch holds, as it is read and as it is told.
BATCH_BYTES = 4 << 20


def in_batches(df: DataFrame) -> DataFrame:
    """The table, for mapping in Arrow: its session's batches are bounded by BATCH_BYTES, if they were larger."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return df


def explode_binary(files: DataFrame, parse: Callable[[bytes], list[dict]], schema: str) -> DataFrame:
    """Rows of each file by a parser; a file that it refuses gives one row with error_code and nulls."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = T.StructType.fromDDL(f"path string, {schema}, error_code string")
    arrow = to_arrow_schema(out)
    names = [f.name for f in out][1:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            last, read = batch.num_rows - 1, 0
            for k, (path, content) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                data = content.as_py() or b""
                read += len(data)
                try:
                    rows += [(path, *(r.get(n) for n in names), None) for r in parse(data)]
                except (ValueError, struct.error, zipfile.BadZipFile, UnicodeDecodeError) as error:
                    rows.append((path, *(None for _ in names), f"{type(error).__name__}: {error}"[:200]))
                if rows and (k == last or len(rows) >= 10_000 or read >= BATCH_BYTES):
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                    rows, read = [], 0

    return in_batches(files.select("path", "content")).mapInArrow(run, out)


def zip_entries(data: bytes) -> list[dict]:
    """Entries of a ZIP in the order of its directory."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        return [
            {"entry_index": i, "name": e.filename, "size": e.file_size, "packed_size": e.compress_size, "crc32": f"{e.CRC:08X}", "is_folder": e.is_dir()}
            for i, e in enumerate(archive.infolist())
        ]


ZIP_SCHEMA = "entry_index int, name string, size long, packed_size long, crc32 string, is_folder boolean"


def list_zips(files: DataFrame) -> DataFrame:
    return explode_binary(files, zip_entries, ZIP_SCHEMA)


def pe_sections(data: bytes) -> list[dict]:
    """Sections of a 64-bit PE image."""
    if data[:2] != b"MZ":
        raise ValueError("no MZ header")
    start = struct.unpack_from("<I", data, 60)[0]
    if data[start : start + 4] != b"PE\0\0":
        raise ValueError("no PE header")
    count, optional = struct.unpack_from("<H", data, start + 6)[0], struct.unpack_from("<H", data, start + 20)[0]
    if struct.unpack_from("<H", data, start + 24)[0] != 0x20B:
        raise ValueError("not PE32+")
    out = []
    for i in range(count):
        name, size, address, raw_size, raw = struct.unpack_from("<8sIIII", data, start + 24 + optional + 40 * i)
        flags = struct.unpack_from("<I", data, start + 24 + optional + 40 * i + 36)[0]
        out.append({"name": name.rstrip(b"\0").decode("ascii"), "address": address, "size": size, "file_offset": raw, "file_size": raw_size, "executable": bool(flags & 0x20000000)})
    return out


PE_SCHEMA = "name string, address long, size long, file_offset long, file_size long, executable boolean"


def list_pe_sections(files: DataFrame) -> DataFrame:
    return explode_binary(files, pe_sections, PE_SCHEMA)


def printable_strings(data: bytes) -> list[dict]:
    """Printable ASCII runs of two or more characters that a NUL ends."""
    return [{"file_offset": m.start(), "text": m[1].decode("ascii")} for m in re.finditer(rb"([\x20-\x7e]{2,})\0", data)]


def list_strings(files: DataFrame) -> DataFrame:
    return explode_binary(files, printable_strings, "file_offset long, text string")
