"""Data source "doctree": every file below a directory, with what detection needs of it.

Unlike the built-in binary file source it lists empty files, names with a leading underscore and files within dot directories; only files whose
own name starts with a dot are left out. Contents are hashed and sniffed where they are read; only a sample travels.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "relpath string, length bigint, sha256 string, head binary, sample string, encoding string, zip_kind string"
#: A partition is closed at this many bytes or files.
PARTITION_BYTES, PARTITION_FILES = 64 << 20, 2000
CHUNK, SAMPLE = 1 << 20, 65536


@dataclass
class Files(InputPartition):
    root: str
    paths: list[str]


class Reader(DataSourceReader):
    def __init__(self, root: str):
        self.root = os.path.abspath(root)

    def partitions(self) -> list[Files]:
        """Files in the order of their lower-case paths, cut by bytes and number."""
        found: list[tuple[str, str, int]] = []
        todo = [self.root]
        while todo:
            with os.scandir(todo.pop()) as entries:
                for e in entries:
                    if e.is_dir(follow_symlinks=False):
                        todo.append(e.path)
                    elif not e.name.startswith(".") and e.is_file():
                        rel = os.path.relpath(e.path, self.root)
                        found.append((rel.lower(), rel, e.stat().st_size))
        out: list[Files] = []
        now, size = [], 0
        for _, rel, n in sorted(found):
            now.append(rel)
            size += n
            if size >= PARTITION_BYTES or len(now) >= PARTITION_FILES:
                out.append(Files(self.root, now))
                now, size = [], 0
        return [*out, Files(self.root, now)] if now or not out else out

    def read(self, partition: Files) -> Iterator[tuple]:
        from leafmill.parsers.office import detect
        from leafmill.parsers.plain import sniff_encoding

        for rel in partition.paths:
            path, digest, sample, length = os.path.join(partition.root, rel), hashlib.sha256(), b"", 0
            try:
                with open(path, "rb") as f:
                    while chunk := f.read(CHUNK):
                        sample = sample or chunk[:SAMPLE]
                        digest.update(chunk)
                        length += len(chunk)
                kind = encoding = text = None
                if sample[:2] == b"PK" and sample[2:4] in (b"\3\4", b"\5\6", b"\7\b"):
                    with open(path, "rb") as f:  # only the directory at its end is read
                        kind = detect(f)
                elif sample:
                    encoding = sniff_encoding(sample)
                    text = sample.decode(encoding, "ignore") if encoding else None
            except OSError:  # gone or unreadable since it was listed
                continue
            yield rel.replace(os.sep, "/"), length, digest.hexdigest(), sample[:64], text, encoding, kind


class DocTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "doctree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocTree)
