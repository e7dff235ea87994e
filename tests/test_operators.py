from pyspark.sql import functions as F

from leafmill.operators import assets as A
from leafmill.operators import classify as C
from leafmill.operators import defer as D
from leafmill.operators import geometry as G
from leafmill.operators import incremental as I
from leafmill.operators import sheets as S
from leafmill.operators.ocr import NoEngine, recognise

ITEMS = "doc_no bigint, pos bigint, type string, cnt bigint, note string, loc string, unit string, cls string, received_at timestamp"


def test_aggregate_keeps_order_and_repeats_once(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, "image-ocr", 2, "", "p3", None, None, t), (1, 1, "image-ocr", 2, "", "p3", None, None, t), (1, 2, "image-ocr", 3, "n", "p7", None, "photo", t), (1, 3, "image-ocr", 1, "later", "p3", "page", None, t), (1, 4, "formula", 1, None, None, None, None, t)]
    got = {r.type: r for r in D.aggregate(D.items_once(spark.createDataFrame(rows, ITEMS))).collect()}
    assert (got["image-ocr"].cnt, got["image-ocr"].note, got["image-ocr"].locs, got["image-ocr"].unit, got["image-ocr"].cls) == (6, "n", ["p3", "p7"], "page", "photo")
    assert got["formula"].locs == [] and got["formula"].note is None
    assert D.aggregate(D.items_once(spark.createDataFrame([], ITEMS))).count() == 0


def test_markers_round_trip_and_resolve(spark):
    f = spark.createDataFrame([(1, "a <!-- stage2:chart=2 unit=slide class=chart drawing --> b <!-- stage2:formula=1 --> c"), (2, "none")], "doc_id bigint, body string")
    got = [(r.type, r.cnt, r.modifiers, r.note) for r in D.extract_markers(f, "doc_id", "body").orderBy("pos").collect()]
    assert got == [("chart", 2, "unit=slide class=chart", "drawing"), ("formula", 1, "", "")]
    given = spark.createDataFrame([(1, 1, "x=y")], "doc_id bigint, pos bigint, result string")
    out = {r.doc_id: r.body for r in D.resolve(f, "doc_id", "body", given).collect()}
    assert out[1] == "a <!-- stage2:chart=2 unit=slide class=chart drawing --> b x=y c" and out[2] == "none"


def test_marker_note_cannot_close(spark):
    none = F.lit(None).cast("string")
    assert spark.range(1).select(D.marker(F.lit("chart"), F.lit(1), F.lit("a --> b\nc"), none, none)).first()[0] == "<!-- stage2:chart=1 a  b c -->"


def test_classify(spark):
    config = C.Config(("a", "b"), mapping={"*.py": "b", "x[!0]?.txt": "a"}, keywords={"a": ("one", "two"), "b": ("two", "three", "three")})
    f = spark.createDataFrame([("f.PY", "one"), ("x1y.txt", ""), ("x0y.txt", "three"), ("n", "ONE two"), ("n", "two"), ("n", "nothing")], "name string, text string")
    assert [r[0] for r in f.select(C.classify(config, F.col("name"), F.col("text"))).collect()] == ["b", "a", "b", "a", "a", "unclassified"]
    assert C.Config.load("/nowhere").default_category == "unclassified"


def test_diff_and_upsert(spark):
    a = spark.createDataFrame([("keep", "1", 0), ("mod", "2", 1), ("gone", "3", 2), ("emptied", "4", 3)], "relpath string, sha256 string, ord bigint")
    b = spark.createDataFrame([("keep", "1", False), ("mod", "9", False), ("new", "5", False), ("emptied", "e", True), ("blank", "e", True)], "relpath string, sha256 string, empty boolean")
    assert {r.relpath: r.action for r in I.diff(a, b).collect()} == {"keep": "skip", "mod": "changed", "gone": "prune", "emptied": "empty", "new": "new", "blank": "empty"}
    out = {r.relpath: (r.sha256, r.ord) for r in I.upsert(a, spark.createDataFrame([("mod", "9"), ("new", "5"), ("also", "6")], "relpath string, sha256 string")).collect()}
    assert out["mod"] == ("9", 1) and 3 < out["also"][1] < out["new"][1]


def test_geometry(spark):
    blocks = spark.createDataFrame([("d", p, 72.0, 10.0, 100.0, 20.0, "head  er") for p in range(5)] + [("d", p, 72.0, 50.0 + p, 100.0, 60.0, f"t{p}") for p in range(5)], "doc string, page bigint, x0 double, y0 double, x1 double, y1 double, text string")
    rep = G.repeated_blocks(blocks)
    assert [(r.text, r.n_pages) for r in rep.collect()] == [("head er", 5)]
    assert G.without_repeated(blocks, rep).count() == 5
    tables = spark.createDataFrame([("d", 0, 70.0, 45.0, 110.0, 65.0)], "doc string, page bigint, x0 double, y0 double, x1 double, y1 double")
    assert G.outside_tables(blocks, tables).count() == 9


def test_cell_lines(spark):
    words = [(1, i, x, y, y + 10.0, t) for i, (x, y, t) in enumerate([(30.0, 10.0, "b"), (0.0, 11.0, "a"), (0.0, 30.0, "c")])] + [(1, 9, 0.0, 0.0, 400.0, "MARK")]
    got = G.cell_lines(spark.createDataFrame(words, "cell bigint, wid bigint, x0 double, y0 double, y1 double, text string"))
    assert [r.text for r in got.orderBy("line").collect()] == ["a b", "c"]


def test_sheets(spark):
    cells = spark.createDataFrame(
        [("d", "s", 1, 1, "top", None), ("d", "s", 2, 1, None, None), ("d", "s", 1, 3, None, "=A1"), ("e", "s", 2, 1, None, None), ("d", "long", 1, 1, "far", None), ("d", "long", 9000, 300, None, None)],
        "doc string, sheet string, r bigint, c bigint, cached string, formula string",
    )
    merges = spark.createDataFrame([("d", "s", 1, 1, 2, 1), ("d", "long", 1, 1, 9000, 300)], "doc string, sheet string, r0 bigint, c0 bigint, r1 bigint, c1 bigint")
    shown = S.fill_merged(S.values(cells), merges)
    got = {(r.doc, r.sheet, r.r, r.c): r.value for r in shown.collect()}
    assert got == {("d", "s", 1, 1): "top", ("d", "s", 2, 1): "top", ("d", "s", 1, 3): "=A1", ("e", "s", 2, 1): None, ("d", "long", 1, 1): "far", ("d", "long", 9000, 300): "far"}
    assert [r.line for r in S.rendered_rows(shown).where("sheet = 's'").orderBy("doc", "r").collect()] == ["| top |  | =A1 |", "| top |  |  |"]


def test_placeholders(spark):
    bodies = spark.createDataFrame([("d", "a <!-- ocr:img:01_x.png --> b <!-- ocr:scan:02_y.png -->"), ("e", "plain")], "doc_id string, body string")
    given = spark.createDataFrame([("d", "01_x.png", "TEXT")], "doc_id string, dest string, replacement string")
    out = {r.doc_id: r.body for r in A.resolve_placeholders(bodies, given).collect()}
    assert out == {"d": "a TEXT b <!-- stage2:scan-page=1 资产文件丢失 -->", "e": "plain"}


def test_no_engine_defers(spark):
    f = spark.createDataFrame([("d", "01_x.png", "img", b"\x89PNG", True)], "relpath string, dest string, kind string, blob binary, present boolean")
    r = recognise(f, NoEngine).first()
    assert (r.text, r.cls, r.readable) == ("", "screenshot", True)


def test_items_stand_as_they_were_received(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(1, 1, "chart", 2, "b", "p1", None, None, t), (1, 1, "chart", 3, "a", "p2", None, None, t)]
    got = D.items_once(spark.createDataFrame(rows, ITEMS)).first()
    assert (got.cnt, got.note, got.loc) in {(2, "b", "p1"), (3, "a", "p2")}
