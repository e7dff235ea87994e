import os

import pytest
import yaml

from leafmill import cli
from leafmill.operators import ocr
from leafmill.operators.classify import Config
from leafmill.plans import pipeline
from leafmill.plans.contract import CONTRACT
from leafmill.plans.pipeline import run


def put(root, **files):
    for name, content in files.items():
        path = os.path.join(root, name.replace("__", "/").replace("_dot_", "."))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content if isinstance(content, bytes) else content.encode())


def catalog_of(out):
    with open(f"{out}/index/artifact/catalog.yaml") as f:
        return yaml.safe_load(f)


def test_full_and_incremental(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(src, a_dot_md="# Title A\n\nSome text.\n\n![p](p.png)\n", p_dot_png=b"\x89PNG\r\n\x1a\n123", old_dot_txt="will go", bin_dot_bin=b"\0\1", empty_dot_txt="", bad_dot_pdf=b"%PDF junk")
    config = Config(("x",), keywords={"x": ("title a",)})
    first = run(spark, src, out, config)
    assert (first.processed, first.errors, first.unsupported) == (5, 1, 1)
    assert {"scan", "parsed", "recognised", "ready", "written"} <= set(first.seconds)
    catalog = catalog_of(out)
    assert {d["title"] for d in catalog["documents"]} == {"Title A", "p", "old", "bin", "bad"}
    mine = catalog["categories"]["x"][0]
    assert os.path.exists(f"{out}/docs/x/{mine}.md") and os.path.exists(f"{out}/original-doc/{mine}_assets/01_p.png")
    assert "image-ocr=1 class=screenshot" in open(f"{out}/docs/x/{mine}.md").read()
    put(src, new_dot_txt="fresh")
    os.remove(f"{src}/old.txt")
    second = run(spark, src, out, Config(("y",), keywords={"y": ("title a",)}))
    assert (second.processed, second.skipped, second.purged) == (1, 4, 1)
    catalog = catalog_of(out)
    moved = next(d for d in catalog["documents"] if d["title"] == "Title A")
    assert moved["category"] == "y" and os.path.exists(f"{out}/{moved['path']}")
    assert not any(d["title"] == "old" for d in catalog["documents"]) and not os.path.exists(f"{out}/original-doc/old.txt")
    handoff = yaml.safe_load(open(f"{out}/index/process/handoff.yaml"))
    assert {d["title"] for d in handoff["stage2_pending"]} >= {"Title A", "bin", "bad"}
    assert set(handoff["deferred_contract"]) == set(CONTRACT["deferred_contract"]) and handoff["procedure"] and handoff["blocked_format"] and handoff["output_guide"]


def test_paths_that_share_an_id_stay_apart(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(src, **{f"d{i}_dot_md": f"# Head {i}\n\nBody {i}.\n\n![p](p{i}.png)\n" for i in range(6)}, **{f"p{i}_dot_png": b"\x89PNG\r\n\x1a\n" + bytes([i]) for i in range(6)})
    assert run(spark, src, out, id_digits=0).errors == 0
    docs = catalog_of(out)["documents"]
    assert len(docs) == 12 and len({d["id"] for d in docs}) == 12
    for i in range(6):
        d = next(x for x in docs if x["title"] == f"Head {i}")
        text = open(f"{out}/{d['path']}").read()
        assert f"Body {i}." in text and open(f"{out}/original-doc/{d['id']}_assets/01_p{i}.png", "rb").read()[-1] == i
    before = {d["source"]: d["id"] for d in docs}
    put(src, more_dot_txt="more")
    run(spark, src, out, id_digits=0)
    after = {d["source"]: d["id"] for d in catalog_of(out)["documents"]}
    assert all(after[k] == v for k, v in before.items()) and len(set(after.values())) == 13


def test_move_survives_a_repeated_task(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(src, a_dot_txt="first", b_dot_txt="second")
    whole = pipeline.write_documents

    def twice(docs, *rest):
        whole(docs, *rest).collect()  # as a task that is run again after all its work
        return whole(docs, *rest)

    monkeypatch.setattr(pipeline, "write_documents", twice)
    s = run(spark, src, out, move=True)
    assert (s.processed, s.errors) == (2, 0) and not os.path.exists(f"{src}/a.txt") and open(f"{out}/original-doc/a.txt").read() == "first"
    assert {d["title"] for d in catalog_of(out)["documents"]} == {"a", "b"}


def test_a_broken_run_leaves_the_state_whole(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(src, a_dot_txt="first")
    run(spark, src, out)
    put(src, b_dot_txt="second")

    def broken(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(pipeline, "write_indexes", broken)
        with pytest.raises(KeyboardInterrupt):
            run(spark, src, out, move=True)
    assert os.path.exists(f"{src}/b.txt") and [d["title"] for d in catalog_of(out)["documents"]] == ["a"]
    assert run(spark, src, out).processed == 1
    assert sorted(d["title"] for d in catalog_of(out)["documents"]) == ["a", "b"]


def engines():
    """Made here, so that they travel to the workers by value."""

    class Reader:
        def lines(self, blob):
            if blob.endswith(b"bad"):
                raise ValueError("cannot be read")
            return ["text of", "", blob[-2:].decode()]

    class NoStart:
        def __init__(self):
            raise RuntimeError("no engine")

    return Reader, NoStart


def test_one_bad_picture_among_good_ones(spark, tmp_path):
    reader, no_start = engines()
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    png = b"\x89PNG\r\n\x1a\n"
    put(src, a_dot_png=png + b"aa", b_dot_png=png + b"bad", c_dot_png=png + b"cc")
    run(spark, src, out, backend=reader)
    text = {d["title"]: open(f"{out}/{d['path']}").read() for d in catalog_of(out)["documents"]}
    assert "```\ntext of\naa\n```" in text["a"] and "image-ocr=1 class=screenshot" in text["b"] and "text of\ncc" in text["c"]
    assets = spark.createDataFrame([("a", "01_img.png", "img", bytearray(png + b"xx"), True), ("a", "02_img.png", "img", None, True)], "relpath string, dest string, kind string, blob binary, present boolean")
    said = {r.dest: r for r in ocr.recognise(assets, no_start).collect()}
    assert said["01_img.png"].text == "" and not said["02_img.png"].readable
    figures = ocr.statistics(ocr.recognise(assets, reader)).first()
    assert (figures.pictures, figures.with_text) == (2, 1)


def test_tasks_for_recognition():
    assert ocr.tasks_for(1000, 8, 64_000) == 8 and ocr.tasks_for(15, 8, 64_000) == 2 and ocr.tasks_for(1000, 8, 2000) == 2 and ocr.tasks_for(0, 8, 0) == 1


def test_manifest_of_another_run_is_imported(spark, tmp_path):
    out = str(tmp_path / "out")
    put(out, index__process__x="")
    with open(f"{out}/index/process/.manifest.yaml", "w") as f:
        yaml.safe_dump({"b.txt": {"sha256": "1", "id": "doc-b", "title": "B", "tags": ["t"], "deferred": [{"type": "chart", "count": 2, "locs": ["p1"]}]}, "a.txt": {"sha256": "2", "id": "doc-a", "title": "A"}}, f, sort_keys=False)
    rows = pipeline.State(spark, out).load().orderBy("ord").collect()
    assert [(r.relpath, r.id, r.ord) for r in rows] == [("b.txt", "doc-b", 0), ("a.txt", "doc-a", 1)] and rows[0].deferred[0].locs == ["p1"]
    with open(f"{out}/index/process/.manifest.yaml", "w") as f:
        f.write("{ broken")
    assert pipeline.State(spark, out).load().count() == 0


def test_indexes_are_written_by_tasks(spark, tmp_path, monkeypatch):
    """In order and whole over several ranges, without an entry on the driver; strings are read back as they were."""
    titles = ["a\x85b", "c: 'd' ---", "\ufeff#", "null"]
    rows = [(f"{i}.md", "0", f"doc-{i:03d}", titles[i % 4], ("x", "y: z", "é")[i % 3], "s", "md", "p", "", ["t"], [("chart", 2, "", None, None, ["l"])] if i % 5 == 0 else [], "", 7 * i) for i in range(60)]
    manifest = spark.createDataFrame(rows, pipeline.ENTRY).repartition(5)
    monkeypatch.setattr(type(manifest), "toLocalIterator", None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert pipeline.write_indexes(manifest, str(tmp_path)) == 12
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    catalog = catalog_of(tmp_path)
    assert [(d["id"], d["title"]) for d in catalog["documents"]] == [(r[2], r[3]) for r in rows]
    assert catalog["categories"] == {c: [r[2] for r in rows if r[4] == c] for c in ("x", "y: z", "é")}
    assert open(f"{tmp_path}/index/artifact/catalog.yaml", encoding="utf-8").read().count("'y: z':") == 1
    assert [d["id"] for d in yaml.safe_load(open(f"{tmp_path}/index/process/handoff.yaml", encoding="utf-8"))["stage2_pending"]] == [r[2] for r in rows[::5]]
    with open(f"{tmp_path}/index/process/.manifest.yaml", encoding="utf-8") as f:
        assert [(d["relpath"], d["title"]) for d in yaml.safe_load(f)] == [(r[0], r[3]) for r in rows]
    assert os.listdir(f"{tmp_path}/index/process") and not [x for x in os.listdir(f"{tmp_path}/index/process") if x.startswith(".pieces")]


def test_broken_config_gives_defaults(tmp_path):
    put(str(tmp_path), c_dot_yaml="taxonomy: [a\n b: {")
    assert Config.load(str(tmp_path / "c.yaml")) == Config() and Config.load(None) == Config()


def test_large_files_are_named(spark, tmp_path, monkeypatch, caplog):
    monkeypatch.setattr(pipeline, "LARGE", 1 << 20)
    put(str(tmp_path / "in"), big_dot_txt="x" * (2 << 20), small_dot_txt="x")
    with caplog.at_level("WARNING", logger="leafmill"):
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [r.getMessage() for r in caplog.records] == ["large file: big.txt, 2 MB"]


def test_scan_order_and_partitions(tmp_path):
    from leafmill.sources.doctree import Reader as Tree

    put(str(tmp_path), b_dot_txt="x", A_dot_txt="x", C__a_dot_txt="x", c0_dot_txt="x")
    assert [p for f in Tree(str(tmp_path)).partitions() for p in f.paths] == ["A.txt", "b.txt", "C/a.txt", "c0.txt"]


def test_wrong_paths(spark, tmp_path):
    assert run(spark, str(tmp_path / "no"), str(tmp_path / "o")).errors == 1
    assert run(spark, str(tmp_path), str(tmp_path / "inside")).errors == 1


def test_input_is_found(tmp_path):
    put(str(tmp_path), aaa__1_dot_md="x", aaa__2_dot_md="x", bbb__1_dot_md="x", out__1_dot_md="x")
    assert cli.find_input(str(tmp_path)) == str(tmp_path / "aaa")
    assert cli.find_config(str(tmp_path), str(tmp_path / "aaa")) is None


def test_streaming_summaries(spark, tmp_path):
    from leafmill.streaming.front import arrivals, backlog, summarise

    src = str(tmp_path / "s")
    spark.createDataFrame([(1, "# h\n\nHello there.")], "doc_id bigint, body string").write.parquet(src)
    q = summarise(spark.readStream.schema("doc_id bigint, body string").parquet(src), str(tmp_path / "o"), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "o")).first().summary == "Hello there."
    schema = "doc_no bigint, pos bigint, type string, cnt bigint, received_at timestamp"
    assert backlog(arrivals(spark, src, schema)).isStreaming
