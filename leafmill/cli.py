"""Command line: leafmill [-i INPUT] [-o OUTPUT] [-c CONFIG] [--move] [-v]; without arguments the input directory is looked for."""

from __future__ import annotations

import argparse
import os
import sys

from leafmill.operators.catalog import DOCUMENT_EXTENSIONS, EXCLUDED_DIRECTORIES, MOST_COUNTED

MARK = os.path.join("index", "artifact", "catalog.yaml")


def count_documents(folder: str, most_files: int = 5000, most: int = MOST_COUNTED) -> int:
    seen = found = 0
    for _, _, names in os.walk(folder):
        for name in names:
            seen += 1
            found += os.path.splitext(name)[1].lower() in DOCUMENT_EXTENSIONS
            if seen > most_files or found >= most:
                return min(found, most)
    return found


def find_input(cwd: str) -> str | None:
    """The direct subdirectory with most documents; equal ones by name. Outputs, links and dot directories do not count."""
    best = None
    for name in sorted(os.listdir(cwd)):
        path = os.path.join(cwd, name)
        if name.startswith(".") or name.lower() in EXCLUDED_DIRECTORIES or os.path.islink(path) or not os.path.isdir(path) or os.path.exists(os.path.join(path, MARK)):
            continue
        n = count_documents(path)
        if n and (best is None or n > best[0]):
            best = n, path
    return best[1] if best else None


def find_config(cwd: str, folder: str) -> str | None:
    return next((p for d in (cwd, folder) if os.path.isfile(p := os.path.join(d, "config.yaml"))), None)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="leafmill")
    p.add_argument("-i", "--input"), p.add_argument("-o", "--output"), p.add_argument("-c", "--config")
    p.add_argument("--move", action="store_true"), p.add_argument("-v", "--verbose", action="store_true")
    a = p.parse_args(argv)
    cwd = os.getcwd()
    folder = a.input or find_input(cwd)
    if not folder:
        print("no directory with documents found; give one with -i", file=sys.stderr)
        return 1
    from pyspark.sql import SparkSession

    from leafmill.plans.pipeline import run

    spark = SparkSession.builder.appName("leafmill").getOrCreate()
    spark.sparkContext.setLogLevel("INFO" if a.verbose else "ERROR")
    s = run(spark, folder, a.output or os.path.join(cwd, "knowledge"), a.config or find_config(cwd, folder), a.move)
    print(f"processed {s.processed}, skipped {s.skipped}, errors {s.errors}, purged {s.purged}, unsupported {s.unsupported}, deferred {s.deferred}")
    return int(s.errors > 0)


if __name__ == "__main__":
    sys.exit(main())
