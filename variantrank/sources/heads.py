"""Heads of text files: the first bytes of each file, without a job and without reading the rest.

Files may have headers of their own, with other columns in another order. Files of the same header are read together, and each
line by the header of its file.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from variantrank.sources.lines import read_lines

STEP = 1 << 16
THREADS = 32


def _head(spark: SparkSession, file: str, enough: Callable[[bytes], bool]) -> tuple[str, bytes]:
    """The name of a file as lines have it, and its first bytes, unpacked if it is compressed, until they are enough or all."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = stream if codec is None else codec.createInputStream(stream)
    found = b""
    try:
        while not enough(found):
            more = bytes(stream.readNBytes(STEP))
            if not more:
                break
            found += more
    finally:
        stream.close()
    return path.toString(), found


def header_lines(spark: SparkSession, path, wanted: Callable[[str], bool] = lambda line: True) -> dict[str, str]:
    """For each file its first line that is wanted; empty files are left out.

    Of ``#`` lines any may be wanted, of others only the first. A file that has lines and no such line stops the run.
    """

    def lines_of(head: bytes, ended: bool) -> list[str]:
        parts = head.decode("utf-8", "replace").split("\n")
        return [p.removesuffix("\r") for p in (parts if ended else parts[:-1])]

    def first(lines: list[str]) -> str | None:
        return next((line for line in lines if wanted(line)), None)

    def enough(head: bytes) -> bool:
        lines = lines_of(head, False)
        return first(lines) is not None or any(line and not line.startswith("#") for line in lines)

    def read(file: str) -> tuple[str, str | None]:
        name, head = _head(spark, file, enough)
        lines = [line for line in lines_of(head, True) if line]
        upto = next((i for i, line in enumerate(lines) if not line.startswith("#")), len(lines) - 1)
        found = first(lines[: upto + 1])
        if lines and found is None:
            raise ValueError(f"no header line in {file}")
        return name, found

    with ThreadPoolExecutor(THREADS) as pool:
        found = pool.map(read, spark.read.text(path).inputFiles())
    return {file: line for file, line in found if line is not None}


def read_by_header(
    spark: SparkSession, path, parse: Callable[[DataFrame, str], DataFrame], wanted: Callable[[str], bool] = lambda line: True
) -> DataFrame:
    """``parse(lines, header)`` of all files: those with the same header together, each file once and by its own header.

    Empty files have no header and no rows.
    """
    by_header: dict[str, list[str]] = {}
    for file, line in header_lines(spark, path, wanted).items():
        by_header.setdefault(line, []).append(re.sub(r"([\\*?\[\]{}])", r"\\\1", file))
    if not by_header:
        raise ValueError(f"no header line in {path}")
    if len(by_header) == 1:
        return parse(read_lines(spark, path), next(iter(by_header)))
    parts = [parse(read_lines(spark, files), line) for line, files in sorted(by_header.items())]
    return reduce(DataFrame.unionByName, parts)
