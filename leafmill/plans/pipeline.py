"""The whole job: a directory of files to a knowledge base of Markdown, with incremental state.

Scan, diff against the manifest, parse what is new, recognise pictures, clean, classify, summarise, write. Contents are read where they are
parsed, only for files that changed; bodies never pass the driver. A document's identity is its path: every join goes by relpath. The short id only
names files, and is lengthened where two paths share it.

Input and output lie in a folder that the driver and all executors see at the same path (shared_folder() checks that); Spark reads and writes it as file://.
State is a Parquet snapshot behind a pointer file that is replaced last, so that a broken run leaves the previous state whole. Everything a task writes
is written beside and renamed, and originals are copied, never moved, by tasks: a task that runs twice does no harm. With move=True originals whose
copy has the recorded hash are deleted after the manifest is committed.
"""

from __future__ import annotations

import hashlib
import logging
import os
import shutil
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill import parsers
from leafmill.functions import text as T
from leafmill.operators import assets as A
from leafmill.operators import classify as C
from leafmill.operators import incremental as I
from leafmill.operators.ocr import Backend, NoEngine, recognise
from leafmill.parsers import base, vector
from leafmill.plans.contract import CONTRACT
from leafmill.plans.render import rendered
from leafmill.sources import doctree

log = logging.getLogger("leafmill")

# Items, entries, notes.
ITEM = "struct<type:string,count:bigint,note:string,unit:string,cls:string,locs:array<string>>"
ENTRY = f"relpath string, sha256 string, id string, title string, category string, source string, source_type string, doc_path string, summary string, tags array<string>, deferred array<{ITEM}>, classify_text string, ord bigint"
_TEXT = {"mode": "w", "encoding": "utf-8", "newline": "\n"}
#: Files of this size and more are named in the log before they are parsed.
LARGE = 50 << 20


@dataclass
class Summary:
    processed: int = 0
    skipped: int = 0
    errors: int = 0
    unsupported: int = 0
    purged: int = 0
    deferred: int = 0
    #: Seconds by phase.
    seconds: dict[str, float] = field(default_factory=dict)


def detected(scan: DataFrame) -> DataFrame:
    """Scan with format and handler: signature first, then text by content and name."""
    by_sign = A.signature(F.col("head"))
    fmt = F.coalesce("zip_kind", F.when(by_sign != "zip", by_sign), F.when(F.col("encoding").isNull(), "binary"), T.sniff_format(F.col("relpath"), F.coalesce("sample", F.lit(""))))
    lang = F.when(F.col("format") == "code", F.coalesce(T.code_language(F.col("relpath")), T.guess_language(F.coalesce("sample", F.lit("")))))
    return scan.withColumn("format", fmt).withColumn("handler", A.handler(F.col("format"))).withColumn("lang", lang)


def identified(scan: DataFrame, previous: DataFrame, digits: int = 8) -> DataFrame:
    """scan with the id of each path: that of its entry, else the short one, else, where another path has that too, one of 32 digits."""
    known = previous.select("relpath", F.col("id").alias("old"))
    named = scan.drop("id").join(known, "relpath", "left").withColumn("short", T.document_key(F.col("relpath"), digits))
    names = named.select("relpath", F.coalesce("old", "short").alias("short")).unionAll(known.select("relpath", F.col("old"))).distinct()
    shared = names.groupBy("short").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("short", F.lit(True).alias("shared"))
    free = F.coalesce("old", F.when(F.col("shared"), T.document_key(F.col("relpath"), 32)).otherwise(F.col("short")))
    return named.join(shared, "short", "left").withColumn("id", free).drop("old", "short", "shared")


def parsed(todo: DataFrame, root: str, render: Callable[[bytes, str], bytes | None] | None = vector.render) -> DataFrame:
    """Drafts, parsed where the files are read; failures are rows. beside: files that a text refers to, as (path, dest)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                source = base.Source(row.relpath, row.id, row.encoding, row.lang, render)
                try:
                    with open(os.path.join(root, row.relpath), "rb") as f:
                        content = f.read()
                    draft = parsers.parse(row.handler, content, source)
                except OSError as ex:
                    draft = parsers.failed(source, ex)
                out.append(draft.row() | {"id": row.id, "beside": [{"path": p, "dest": d} for p, d in draft.beside]})
            yield pd.DataFrame(out)

    return todo.select("relpath", "id", "handler", "encoding", "lang").mapInPandas(run, base.PARSED + ", id string, beside array<struct<path:string,dest:string>>")


def with_pictures_beside(drafts: DataFrame, scan: DataFrame, root: str) -> DataFrame:
    """Drafts whose references to pictures that the scan knows are followed: the join with the scan says which exist."""
    plain = drafts.where(F.size("beside") == 0).drop("beside")
    asked = drafts.where(F.size("beside") > 0)
    found = asked.select("relpath", F.explode("beside").alias("b")).select("relpath", "b.path", "b.dest").join(scan.select(F.col("relpath").alias("path")), "path", "left_semi")
    given = found.groupBy("relpath").agg(F.collect_list(F.struct("path", "dest")).alias("there"))
    names = base.PARSED + ", id string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                there = {x["path"]: x["dest"] for x in (row.pop("there") if row["there"] is not None else [])}
                folder = os.path.dirname(row["relpath"])
                assets = list(row["assets"])
                for path, dest in there.items():
                    try:
                        with open(os.path.join(root, path), "rb") as f:
                            blob = f.read()
                    except OSError:
                        blob = None
                    assets.append({"dest": dest, "kind": "img", "ext": dest.rpartition(".")[2], "blob": blob})
                row["assets"] = assets
                row["blocks"] = [dict(b) | {"text": parsers.plain.follow_pictures(b["text"], there, row["id"], folder)} if b["kind"] == "text" and b["text"] else dict(b) for b in row["blocks"]]
                rows.append(row)
            yield pd.DataFrame(rows)

    columns = [f.split(" ")[0] for f in ("relpath", "titles", "title_in_body", "blocks", "assets", "if_empty", "error", "id")]
    followed = asked.drop("beside").join(given, "relpath", "left").select(*columns, "there").mapInPandas(run, names)
    return plain.select(*columns).unionByName(followed.select(*columns))


def aggregated(items: F.Column) -> F.Column:
    """Deferred items of one document by type, in first-seen order."""
    types = F.array_distinct(F.transform(items, lambda x: x["type"]))
    first = lambda mine, name: F.try_element_at(F.filter(F.transform(mine, lambda x: x[name]), lambda v: F.coalesce(v, F.lit("")) != ""), F.lit(1))

    def one(t: F.Column) -> F.Column:
        mine = F.filter(items, lambda x: x["type"] == t)
        total = F.aggregate(mine, F.lit(0).cast("bigint"), lambda a, x: a + x["count"])
        locs = F.array_distinct(F.filter(F.transform(mine, lambda x: x["loc"]), lambda v: F.coalesce(v, F.lit("")) != ""))
        return F.struct(t.alias("type"), total.alias("count"), F.coalesce(first(mine, "note"), F.lit("")).alias("note"), first(mine, "unit").alias("unit"), first(mine, "cls").alias("cls"), locs.alias("locs"))

    return F.transform(types, one)


def finished(files: DataFrame, docs: DataFrame, said: DataFrame, config: C.Config) -> DataFrame:
    """Cleaned documents ready to write: pictures resolved, titled, classified, summarised, with contents. Joins go by relpath."""
    clean = docs.join(files.select("relpath", "sha256", "format"), "relpath")
    repl = said.select("relpath", "dest", A.resolution(F.col("kind"), F.col("text"), F.col("present"), F.when(F.col("cls") != "", F.col("cls")), F.col("vector"), F.col("readable")).alias("replacement"), (F.col("text") == "").alias("left"), F.col("kind"), F.col("cls"))
    bodies = A.resolve_placeholders(clean.select("relpath", "body"), repl, "relpath")
    none = F.lit(None).cast("string")
    item = F.struct(F.when(F.col("kind") == "scan", "scan-page").otherwise("image-ocr").alias("type"), F.lit(1).cast("bigint").alias("count"), F.lit("").alias("note"), none.alias("loc"), F.when(F.col("cls") != "", F.col("cls")).alias("cls"), none.alias("unit"))
    lost = repl.where("left").groupBy("relpath").agg(F.collect_list(item).alias("lost"))
    d = clean.drop("body").join(bodies, "relpath").join(lost, "relpath", "left")
    d = d.withColumn("classify_text", C.classify_text(F.col("title"), F.col("body")))
    d = d.withColumn("category", T.let(C.classify(config, T.base_name(F.col("relpath")), F.col("classify_text")), lambda c: C.valid_category(config, c)))
    d = d.withColumn("summary", T.let(T.summary(F.col("body")), lambda s: F.when(s != "", s).otherwise(T.table_summary(F.col("body")))))
    d = d.withColumn("deferred", aggregated(F.concat("deferred", F.coalesce("lost", F.array().cast("array<struct<type:string,count:bigint,note:string,loc:string,cls:string,unit:string>>")))))
    d = d.withColumn("rendered", F.concat(T.let(T.sections(F.col("body")), T.table_of_contents), "body"))
    return d.withColumn("source", F.concat(F.lit("original-doc/"), "relpath")).withColumn("source_type", F.col("format")).withColumn("doc_path", F.concat(F.lit("docs/"), "category", F.lit("/"), "id", F.lit(".md")))


def cleaned(docs: DataFrame) -> DataFrame:
    return docs.withColumn("body", T.strip_boilerplate(T.clean_text(F.col("body"))))


def dump(x) -> str:
    """YAML in the order given, by libyaml where that is there: it is several times as fast, and every string is read back as it was."""
    import yaml

    return yaml.dump(x, Dumper=getattr(yaml, "CSafeDumper", yaml.SafeDumper), allow_unicode=True, sort_keys=False)


def front_matter(row: dict) -> str:
    head = {k: row[k] for k in ("id", "title", "category", "source", "source_type", "tags", "summary") if row.get(k) is not None}
    head["tags"] = list(head.get("tags", ()))
    if items := _items(row.get("deferred")):
        head["deferred"] = items
    return "---\n" + dump(head) + "---\n\n"


def _items(deferred) -> list[dict]:
    """Without empty parts, as the indexes show them."""
    out = []
    for x in deferred if deferred is not None else []:
        x = x.asDict() if hasattr(x, "asDict") else dict(x)
        out.append({k: (list(v) if k == "locs" else v) for k, v in x.items() if k in ("type", "count", "note") or v is not None and len(v)})
    return out


@contextmanager
def beside(path: str, mode: str = "wb", **more):
    """A file that appears whole: written under another name in its folder, then renamed."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    tmp = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with open(tmp, mode, **more) as f:
            yield f
        os.replace(tmp, path)
    finally:
        if os.path.exists(tmp):
            os.remove(tmp)


def write_documents(docs: DataFrame, root: str, out: str) -> DataFrame:
    """Write rendered documents, assets and copies of originals from the executors; (relpath, written) says what became of each. May run twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = []
            for row in b.to_dict("records"):
                try:
                    folder = os.path.join(out, "original-doc", row["id"] + "_assets")
                    mine = {a["dest"]: a["blob"] for a in (row["assets"] if row["assets"] is not None else []) if a["blob"] is not None}
                    for dest, blob in mine.items():
                        with beside(os.path.join(folder, dest)) as f:
                            f.write(blob)
                    for name in os.listdir(folder) if os.path.isdir(folder) else ():  # what an earlier version of the document had
                        if name not in mine and not name.endswith(".part"):
                            os.remove(os.path.join(folder, name))
                    with beside(os.path.join(out, row["doc_path"]), **_TEXT) as f:
                        f.write(front_matter(row) + row["rendered"].rstrip("\n") + "\n")
                    with beside(os.path.join(out, "original-doc", row["relpath"])) as f, open(os.path.join(root, row["relpath"]), "rb") as original:
                        shutil.copyfileobj(original, f)
                    done.append(True)
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"relpath": b["relpath"], "written": done})

    cols = ["relpath", "id", "title", "category", "source", "source_type", "tags", "summary", "deferred", "assets", "rendered", "doc_path"]
    return docs.select(*cols).mapInPandas(run, "relpath string, written boolean")


def remove_originals(entries: DataFrame, root: str, out: str) -> int:
    """Delete originals whose copy has the recorded hash; gives their number. Runs after the manifest is committed, and may run twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            gone = 0
            for row in b.itertuples(index=False):
                digest = hashlib.sha256()
                try:
                    with open(os.path.join(out, "original-doc", row.relpath), "rb") as f:
                        while chunk := f.read(1 << 20):
                            digest.update(chunk)
                    if digest.hexdigest() == row.sha256:
                        os.remove(os.path.join(root, row.relpath))
                        gone += 1
                except OSError:
                    continue
            yield pd.DataFrame({"n": [gone]})

    return entries.select("relpath", "sha256").mapInPandas(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def shared_folder(spark: SparkSession, folder: str) -> None:
    """Raise where a task does not see what the driver writes into the folder."""
    os.makedirs(folder, exist_ok=True)
    mark = os.path.join(folder, f".{uuid.uuid4().hex}")
    with open(mark, "w"):
        pass
    try:
        n = spark.sparkContext.defaultParallelism
        seen = spark.range(0, n, 1, n).mapInPandas(lambda batches: (pd.DataFrame({"seen": [os.path.exists(mark)] * len(b)}) for b in batches), "seen boolean")
        if not seen.agg(F.min(F.col("seen").cast("int"))).first()[0]:
            raise RuntimeError(f"{folder} is not shared by the driver and all executors")
    finally:
        os.remove(mark)


class State:
    """Manifest snapshots: numbered Parquet folders and a pointer that is replaced last."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.root = spark, os.path.join(out, "index", "process", ".manifest")
        self.pointer = os.path.join(self.root, "CURRENT")

    def load(self) -> DataFrame:
        try:
            with open(self.pointer, encoding="utf-8") as f:
                return self.spark.read.schema(ENTRY).parquet("file://" + os.path.join(self.root, f.read().strip()))
        except OSError:
            return self.imported()

    def imported(self) -> DataFrame:
        """The entries of a manifest.yaml that was written without snapshots, in its order; none where there is no such file, or a broken one."""
        import yaml

        path = os.path.join(os.path.dirname(self.root), ".manifest.yaml")
        try:
            with open(path, encoding="utf-8") as f:
                raw = yaml.safe_load(f)
        except (OSError, yaml.YAMLError):
            raw = None
        listed = [dict(v, relpath=v.get("relpath", k)) for k, v in raw.items() if isinstance(v, dict)] if isinstance(raw, dict) else [v for v in raw or [] if isinstance(v, dict) and v.get("relpath")]
        text = lambda v, k: None if v.get(k) is None else str(v[k])
        rows = []
        for n, v in enumerate(listed):
            items = [(str(x.get("type")), int(x.get("count") or 0), str(x.get("note") or ""), text(x, "unit"), text(x, "cls"), [str(y) for y in x.get("locs") or []]) for x in v.get("deferred") or [] if isinstance(x, dict)]
            named = {k: text(v, k) for k in ("relpath", "sha256", "id", "title", "category", "source", "source_type", "doc_path", "summary")}
            rows.append((*named.values(), [str(t) for t in v.get("tags") or []], items, f"{named['title'] or ''}\n{named['summary'] or ''}", n))
        return self.spark.createDataFrame(rows, ENTRY)

    def write(self, entries: DataFrame) -> DataFrame:
        """Write a snapshot without making it current."""
        n = 1 + max((int(x.split("-")[1]) for x in os.listdir(self.root) if x.startswith("snap-")), default=0) if os.path.isdir(self.root) else 1
        self.next = f"snap-{n:06d}"
        entries.write.mode("overwrite").parquet(path := "file://" + os.path.join(self.root, self.next))
        return self.spark.read.schema(ENTRY).parquet(path)

    def commit(self) -> None:
        tmp = self.pointer + ".new"
        with open(tmp, "w", encoding="utf-8") as f:
            f.write(self.next)
        os.replace(tmp, self.pointer)

    def clean(self) -> None:
        """Drop snapshots that are no longer current."""
        for x in os.listdir(self.root):
            if x.startswith("snap-") and x != self.next:
                shutil.rmtree(os.path.join(self.root, x), ignore_errors=True)


def _key(category: str | None) -> str:
    """A category as a key of the catalog."""
    return "".join("  " + x + "\n" for x in dump({category: 0}).rsplit("0", 1)[0].rstrip().splitlines())


def write_indexes(manifest: DataFrame, out: str) -> int:
    """catalog.yaml, handoff.yaml and manifest.yaml; gives the number of documents with deferred work. Tasks write the entries of their range in order, and
    the driver strings the pieces together."""
    artifact, process = os.path.join(out, "index", "artifact"), os.path.join(out, "index", "process")
    os.makedirs(artifact, exist_ok=True), os.makedirs(process, exist_ok=True)
    pieces = os.path.join(process, f".pieces-{uuid.uuid4().hex}")

    def piece(kind: str, n: int) -> str:
        return os.path.join(pieces, kind, f"{n:06d}")

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The piece of a range: a line for each id, with the categories between them; (n, first, last) says which came first and last."""
        n, first, now = TaskContext.get().partitionId(), None, None
        with beside(piece("ids", n), **_TEXT) as f:
            for b in batches:
                for category, id_ in b.itertuples(index=False):
                    if now is not None and category != now[0]:
                        f.write(_key(category))
                    f.write("  - " + dump(id_).splitlines()[0] + "\n")
                    now = (category,)
                    first = first or now
        if first:
            yield pd.DataFrame({"n": [n], "first": [first[0]], "last": [now[0]]})

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, pending = TaskContext.get().partitionId(), 0
        with beside(piece("catalog", n), **_TEXT) as c, beside(piece("handoff", n), **_TEXT) as h, beside(piece("manifest", n), **_TEXT) as m:
            for b in batches:
                for r in b.to_dict("records"):
                    items, tags = _items(r["deferred"]), list(r["tags"] if r["tags"] is not None else [])
                    doc = {"id": r["id"], "title": r["title"], "category": r["category"], "path": r["doc_path"], "source": r["source"], "source_type": r["source_type"], "tags": tags, "summary": r["summary"]} | ({"deferred": items} if items else {})
                    c.write(dump([doc]))
                    if items:
                        pending += 1
                        h.write(dump([{"id": r["id"], "title": r["title"], "doc": r["doc_path"], "source": r["source"], "deferred": items}]))
                    m.write(dump([{k: r[k] for k in ("relpath", "sha256", "id", "title", "category", "source", "source_type", "doc_path", "summary")} | {"tags": tags, "deferred": items}]))
        yield pd.DataFrame({"n": [n], "pending": [pending]})

    def string(f, kind: str, n: int) -> None:
        with open(piece(kind, n), "rb") as part:
            shutil.copyfileobj(part, f, 1 << 20)

    try:
        named = sorted(manifest.select("category", "id").orderBy("category", "id").mapInPandas(ids, "n int, first string, last string").collect(), key=lambda r: r["n"])
        done = sorted(manifest.drop("classify_text").orderBy("ord").mapInPandas(entries, "n int, pending bigint").collect(), key=lambda r: r["n"])
        with open(os.path.join(artifact, "catalog.yaml"), "wb") as c, open(os.path.join(process, "handoff.yaml"), "wb") as h, open(os.path.join(process, ".manifest.yaml"), "wb") as m:
            c.write((dump({"version": 1, "generated_at": datetime.now().astimezone().isoformat(timespec="seconds")}) + "categories:\n").encode())
            now = ()
            for r in named:
                if now != (r["first"],):
                    c.write(_key(r["first"]).encode())
                now = (r["last"],)
                string(c, "ids", r["n"])
            c.write(b"documents:\n")
            h.write((dump(CONTRACT) + "stage2_pending:\n").encode())
            for r in done:
                string(c, "catalog", r["n"]), string(h, "handoff", r["n"]), string(m, "manifest", r["n"])
        return sum(r["pending"] for r in done)
    finally:
        shutil.rmtree(pieces, ignore_errors=True)


def run(spark: SparkSession, input_dir: str, output_dir: str, config: C.Config | str | None = None, move: bool = False, backend: Callable[[], Backend] | None = None, id_digits: int = 8) -> Summary:
    """One full or incremental run. backend makes the recognition engine, once in a worker process."""
    root, out = os.path.abspath(input_dir), os.path.abspath(output_dir)
    if not os.path.isdir(root) or root == out or out.startswith(root + os.sep):
        return Summary(errors=1)
    config = config if isinstance(config, C.Config) else C.Config.load(config)
    doctree.register(spark)
    process = os.path.join(out, "index", "process")
    shared_folder(spark, process)
    state = State(spark, out)
    previous = state.load()
    # one reading of the files: the detected scan is written once and read from there
    tmp = os.path.join(process, ".run")
    shutil.rmtree(tmp, ignore_errors=True)
    seconds: dict[str, float] = {}

    def stage(df: DataFrame, name: str) -> DataFrame:
        began = time.perf_counter()
        df.write.mode("overwrite").parquet(path := "file://" + os.path.join(tmp, name))
        seconds[name] = round(time.perf_counter() - began, 3)
        log.info("%s: %.1f s", name, seconds[name])
        return spark.read.parquet(path)

    try:
        found = stage(detected(spark.read.format("doctree").option("path", root).load()).drop("head", "sample"), "found")
        scan = stage(identified(found, previous, id_digits), "scan")
        for r in scan.where(F.col("length") >= LARGE).select("relpath", "length").toLocalIterator():
            log.warning("large file: %s, %d MB", r["relpath"], r["length"] >> 20)
        actions = stage(I.diff(previous, scan.select("relpath", "sha256", (F.col("length") == 0).alias("empty"))), "actions")
        work = scan.join(actions.where("action in ('new', 'changed')").select("relpath"), "relpath", "left_semi")
        if move:  # known files without a handler are worked off again, so that they leave the input
            work = work.unionByName(scan.join(actions.where("action = 'skip'").select("relpath"), "relpath", "left_semi").where("handler is null"))
        drafts = with_pictures_beside(parsed(work.where("handler is not null"), root), scan, root)
        left = unsupported(work.where("handler is null"))
        docs = stage(cleaned(rendered(drafts.unionByName(left))), "parsed")
        assets = docs.select("relpath", F.explode("assets").alias("a")).select("relpath", "a.*", F.lit(True).alias("present"))
        said = stage(recognise(assets, backend or NoEngine, vector.render), "recognised")
        ready = stage(finished(work, docs, said, config), "ready")
        written = stage(write_documents(ready, root, out), "written")
        entries = ready.join(written.where("written").select("relpath"), "relpath", "left_semi").select(*[c.split()[0] for c in ENTRY.split(", ")[:-1] if c.split()[0] in ready.columns])
        gone = actions.where("action in ('prune', 'empty') and ord is not null").select("relpath") if not move else actions.where("1 = 0").select("relpath")
        kept = previous.join(gone, "relpath", "left_anti")
        moved = stage(C.reclassified(config, kept.join(entries.select("relpath"), "relpath", "left_anti")), "moved")
        kept = kept.join(moved.select("relpath", "new_category"), "relpath", "left").withColumn("doc_path", F.when(F.col("new_category").isNotNull(), F.concat(F.lit("docs/"), "new_category", F.lit("/"), "id", F.lit(".md"))).otherwise(F.col("doc_path"))).withColumn("category", F.coalesce("new_category", "category")).drop("new_category")
        manifest = state.write(I.upsert(kept, entries))
        deferred = write_indexes(manifest, out)
        state.commit()
        _tidy(previous, manifest, gone, out)
        if move:
            remove_originals(entries, root, out)
        n = {r["action"]: r["n"] for r in I.counts(actions).collect()}
        purged = gone.count()
        state.clean()
        errors = docs.where("error is not null").count() + written.where("not written").count()
        return Summary(written.where("written").count(), n.get("skip", 0), errors, work.where("handler is null").count(), purged, deferred, seconds)
    finally:
        shutil.rmtree(tmp, ignore_errors=True)


def unsupported(files: DataFrame) -> DataFrame:
    """Drafts of files that no parser takes: work for a later stage is all there is."""
    note = F.concat(F.lit("格式'"), "format", F.lit("' stage1未解析, 见 original-doc/"), "relpath")
    named = {"kind": F.lit("work"), "prefix": F.lit(""), "prompt": F.lit(False), "type": F.lit("unsupported"), "count": F.lit(1).cast("bigint"), "note": note}
    fields = [x.split(":")[0] for x in base.BLOCK.removeprefix("struct<").removesuffix(">").replace("array<array<string>>", "rows").split(",")]
    block = F.struct(*[named.get(f, F.lit(None)).alias(f) for f in fields]).cast(base.BLOCK)
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return files.select("relpath", empty(base.TITLE).alias("titles"), F.lit(False).alias("title_in_body"), F.array(block).alias("blocks"), empty(base.ASSET).alias("assets"), F.lit("").alias("if_empty"), F.lit(None).cast("string").alias("error"), "id")


def _tidy(previous: DataFrame, manifest: DataFrame, gone: DataFrame, out: str) -> None:
    """After the commit: rendered files that moved category, and everything of documents that are gone."""
    for r in I.moved(previous, manifest).join(manifest.select("relpath", F.col("doc_path").alias("new"), "category"), "relpath").toLocalIterator():
        old, new = os.path.join(out, r["doc_path"]), os.path.join(out, r["new"])
        if os.path.exists(old) and not os.path.exists(new):
            os.makedirs(os.path.dirname(new), exist_ok=True)
            with open(old, encoding="utf-8") as f:
                text = f.read()
            with open(new, "w", encoding="utf-8", newline="\n") as f:
                f.write("\n".join(f"category: {r['category']}" if i < 12 and x.startswith("category: ") else x for i, x in enumerate(text.split("\n"))))
        if os.path.exists(old):
            os.remove(old)
    for r in previous.join(gone, "relpath", "left_semi").select("relpath", "id", "doc_path").toLocalIterator():
        for path in (r["doc_path"], "original-doc/" + r["relpath"]):
            if os.path.exists(full := os.path.join(out, path)):
                os.remove(full)
        shutil.rmtree(os.path.join(out, "original-doc", r["id"] + "_assets"), ignore_errors=True)
