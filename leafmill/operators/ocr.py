"""Recognition of text in pictures behind a small protocol; without an engine every picture becomes deferred work."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.assets import image_class

VECTOR_SIGNS = (b"\xd7\xcd\xc6\x9a", b"<svg", b"<?xm")
#: Pictures a task has at least, and memory of one engine; what a run of recognition is divided by.
PICTURES_A_TASK, ENGINE_MB = 10, 400


class Backend(Protocol):
    def lines(self, blob: bytes) -> list[str]:
        """Lines of text in the picture, in order."""


class NoEngine:
    def lines(self, blob: bytes) -> list[str]:
        return []


def supported(blob: bytes | None) -> bool:
    return bool(blob) and len(blob) >= 4 and not blob.startswith(VECTOR_SIGNS)


def prepared(blob: bytes, dest: str, render: Callable[[bytes, str], bytes | None] | None) -> bytes | None:
    """What the engine is given: a vector picture rendered, any other as it is; None for what it cannot read."""
    if render and not supported(blob) and (png := render(blob, dest.rpartition(".")[2])):
        return png
    return blob if supported(blob) else None


def one_thread_each() -> None:
    """Engines run side by side in tasks, so each keeps to one thread; to be called before the engine's libraries are loaded."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "ORT_NUM_THREADS"):
        os.environ.setdefault(name, "1")


def tasks_for(pictures: int, cores: int, free_mb: int) -> int:
    """Tasks that recognise side by side: no more than cores, than memory holds engines, or than have PICTURES_A_TASK pictures each; at least one."""
    return max(1, min(cores, (free_mb - 1024) // ENGINE_MB, -(-pictures // PICTURES_A_TASK)))


#: Engines of this worker process by their maker; None for one that could not be started, which is not tried again.
_STARTED: dict[object, Backend | None] = {}


def engine(make: Callable[[], Backend]) -> Backend | None:
    key = (getattr(make, "__module__", ""), getattr(make, "__qualname__", repr(make)))
    if key not in _STARTED:
        one_thread_each()
        try:
            _STARTED[key] = make()
        except Exception:  # noqa: BLE001
            _STARTED[key] = None
    return _STARTED[key]


def recognise(assets: DataFrame, make: Callable[[], Backend] = NoEngine, render: Callable[[bytes, str], bytes | None] | None = None) -> DataFrame:
    """(relpath, dest, kind, cls, text, present, readable, vector, seconds): one row for each asset (relpath, dest, kind, blob, present), spread over all tasks
    whatever document it belongs to.

    The engine is made once in a worker process; only a failed start turns it off there. A picture that it cannot read has no text, and the next one is
    tried as usual. present without bytes: the asset could not be read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said, took = [], []
            for blob, dest in zip(b["blob"], b["dest"]):
                began, text = time.perf_counter(), ""
                try:
                    picture = prepared(bytes(blob), dest, render) if blob is not None else None
                    if picture is not None and (reader := engine(make)):
                        text = "\n".join(x for x in reader.lines(picture) if x)
                except Exception:  # noqa: BLE001
                    text = ""
                said.append(text)
                took.append(time.perf_counter() - began)
            vector = [not supported(bytes(x)) and bytes(x).startswith(VECTOR_SIGNS) if x is not None else False for x in b["blob"]]
            yield pd.DataFrame({"relpath": b["relpath"], "dest": b["dest"], "kind": b["kind"], "cls": b["cls"], "text": said, "present": b["present"], "readable": b["blob"].notna(), "vector": vector, "seconds": took})

    rows = assets.select("relpath", "dest", "kind", "blob", "present", image_class(F.col("blob"), F.col("dest")).alias("cls"))
    return rows.mapInPandas(run, "relpath string, dest string, kind string, cls string, text string, present boolean, readable boolean, vector boolean, seconds double")


def statistics(recognised: DataFrame) -> DataFrame:
    """(pictures, with_text, seconds, longest) of a run."""
    return recognised.agg(F.count(F.lit(1)).alias("pictures"), F.sum((F.col("text") != "").cast("bigint")).alias("with_text"), F.sum("seconds").alias("seconds"), F.max("seconds").alias("longest"))
