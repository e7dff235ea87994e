import random
import re
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import p04_near_copies as P4
from leafmill.llm import p05_lookalikes as P5
from leafmill.llm import p06_residue as P6
from leafmill.llm import p07_encoding as P7
from leafmill.llm.common import fields

WORDS = "pump valve report office noon river garden machine lantern copper window table orange silver bridge castle doctor engine farmer guitar hammer island jacket kettle ladder magnet needle oyster pencil quartz rocket saddle tunnel umbrella violin walnut yellow zebra".split()


def corpus(seed, groups, size):
    r, out = random.Random(seed), []
    for _ in range(groups):
        base = [r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(90)]
        out.append(" ".join(base))
        for _ in range(size - 1):
            t = list(base)
            for _ in range(r.randint(0, 6)):
                t[r.randrange(len(t))] = r.choice(WORDS)
            out.append(" ".join(t))
    return out


def brute(texts):
    red = [re.sub(r"\s+", "", (t or "").lower()) for t in texts]
    sets = [{t[i : i + 10] for i in range(len(t) - 9)} if len(t) >= 400 else set() for t in red]
    return {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.6}


def test_pairs_equal_brute_force(spark):
    texts = corpus(1, 25, 3) + corpus(2, 20, 1) + [None, "", "short"]
    texts += [texts[0], texts[0].upper()]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x")], "doc_id bigint, body string, same string")
    got = {tuple(r) for r in P4.pairs(frame).collect()}
    assert got == brute(texts)
    classes = {r.doc_id: r.class_id for r in P4.groups(frame).collect()}
    for i, j in got:
        assert classes[i] == classes[j]
    assert set(classes) == {i for p in got for i in p}
    assert P4.pairs(frame.where("1 = 0")).count() == 0


def test_hot_bucket_is_split_and_whole(spark):
    texts = corpus(3, 1, 40)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, body string")
    P4.shared_dir(spark)
    sketched = P4.sketches(frame).checkpoint()
    whole = {tuple(r) for r in P4.candidates(sketched).collect()}
    assert {tuple(r) for r in P4.candidates(sketched, bucket_rows=6).collect()} == whole


def test_bucket_of_a_hundred_thousand_rows(spark):
    n = 100_000
    r = np.random.default_rng(4)
    sketch = r.integers(0, 2**63, n)  # far apart, but for pairs of neighbours
    sketch[1::2] = sketch[::2] ^ 1
    one = spark.range(n).selectExpr("id as member", "array(7L, id + 100L) as bands")
    hot = P4.hot_keys(one, n, 2000).collect()
    assert [x.key for x in hot] == [7] and hot[0].chunks == 100
    sizes = []
    whole = P4.trie_join

    def spy(key, *rest, **more):
        sizes.append(len(key))
        return whole(key, *rest, **more)

    P4.trie_join = spy
    try:
        got = {p for x, y in P4.join_bucketwise(np.zeros(1500, np.int64), sketch[:1500], np.arange(1500), np.full(1500, 2), bucket_rows=150) for p in zip(x.tolist(), y.tolist())}
    finally:
        P4.trie_join = whole
    assert max(sizes) <= 300 and {(i, i + 1) for i in range(0, 1500, 2)} <= got


def test_joined_back_equals_a_join(spark):
    rows = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(6000)], "k int, v int")
    of = rows.groupBy("k").agg(P4.F.min("v").alias("least"), P4.F.count("*").alias("copies"))
    want = {(r.k, r.v, r.least) for r in rows.join(of, "k").collect()}
    assert {(r.k, r.v, r.least) for r in P4.joined_back(rows, of, "k", 6000).collect()} == want


def test_long_chain_is_one_group(spark):
    r = random.Random(3)
    words = [r.choice(WORDS) + str(r.randint(0, 999)) for _ in range(90 + 15 * 199)]
    ids = r.sample(range(1000), 200)  # each version is a copy of the one before, in no order of ids
    rows = [(i, " ".join(words[15 * k : 15 * k + 90])) for k, i in enumerate(ids)]
    got = P4.groups(spark.createDataFrame(rows, "doc_id bigint, body string")).collect()
    assert sorted(x.doc_id for x in got) == sorted(ids)
    assert {x.class_id for x in got} == {min(ids)}
    assert sorted(x.n_links for x in got) == [1] * 2 + [2] * 198


def test_components(spark):
    r = random.Random(5)
    star = [(999, i) for i in range(500, 560)]
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + star + [(i, i + 1) for i in range(1000, 1040)]
    pairs = [p for p in pairs if p[0] != p[1]]
    least = {v: v for p in pairs for v in p}
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    got = P4.components(spark.createDataFrame(pairs + [p[::-1] for p in pairs], "a bigint, b bigint")).collect()
    assert len(got) == len(least) and {x.v: x.label for x in got} == least
    assert P4.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**64 - 1)), max_size=40), st.integers(0, 40))
def test_trie_join_equals_all_pairs(rows, budget):
    rows = [(k, s if i % 3 else rows[0][1] ^ (1 << i % 64)) for i, (k, s) in enumerate(rows)]
    key = np.array([k for k, _ in rows], np.int64)
    sketch = np.array([s for _, s in rows], np.uint64).view(np.int64)
    member = np.arange(len(rows), dtype=np.int64)
    x, y = P4.trie_join(key, sketch, member, budget=budget)
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if rows[i][0] == rows[j][0] and bin(rows[i][1] ^ rows[j][1]).count("1") <= budget}
    assert set(zip(x.tolist(), y.tolist())) == want and len(x) == len(want)


@pytest.fixture(scope="module")
def table(spark):
    return P5.prototypes(spark)


@pytest.mark.parametrize(
    "text",
    ["thе valve", "ｔｈｅ valve", "va\u200blve", "the\u00a0valve", "Mu\u0308ller", "con\ufb02ict", "𝗍𝗁𝖾 valve", "２０２０年报告", "人⼈民", "Ηοw it works", "lot РN-4781", "a\u2009b"],
)
def test_stand_ins_are_found(text, table):
    n = P5.Normaliser(table)
    form = n.case(text)
    assert form is not None and form != text
    assert n.case(form) is None and P5.skeleton(form, table) == P5.skeleton(text, table)


@pytest.mark.parametrize("text", ["Протокол 9", "α = 0.07", "👩\u200d🔧 ok", "Prix\u00a0: 3 €", "“quoted” – dash…", "Straße naïve cœur", "（送审稿）：中文，标点。", "SÃO VELTO", "H2O ² ½ ™", ""])
def test_usual_text_is_no_case(text, table):
    assert P5.Normaliser(table).case(text) is None


def test_the_table_is_the_public_one(table):
    assert len(table) > 15_000
    of = lambda c: P5.skeleton(c, table)
    assert of("\u0430") == of("a") and of("\u13aa") == of("A") and of("\U0001d5cd") == of("t") and of("\uff21") == of("A") and of("m") == of("rn") and of("\u2f08") == "人"


def test_without_skeletons_nothing_is_found(table, monkeypatch):
    n = P5.Normaliser(table)
    monkeypatch.setattr(P5, "skeleton", lambda text, table: text)
    assert n.case("th\u0435 valve") is None


def test_normalising_twice_changes_nothing(table):
    n = P5.Normaliser(table)

    @settings(max_examples=60, deadline=None)
    @given(st.text(max_size=40))
    def check(text):
        once = n(text)
        assert n(once) == once or unicodedata.normalize("NFC", once) != once

    check()


def test_lookalike_frames(spark):
    md = spark.createDataFrame([(1, "thе valve", "t"), (2, "the valve", "t"), (3, None, "t"), (4, "", "t"), (5, "x" * 200_000 + "\u200b", "t")], "doc_id bigint, body string, title string")
    fm = spark.createDataFrame([(1, "Gemäß"), (1, None), (2, "Ã‰tude\u00a0x")], "doc_id bigint, title string")
    f = fields(md, fm)
    assert {tuple(r) for r in P5.find(f).collect()} == {(1, "body"), (5, "body")}
    rows = {(r.doc_id, r.field): r for r in P5.normalise(f).collect()}
    assert rows[1, "body"].normal == "the valve" and rows[1, "body"].skeleton_id == rows[2, "body"].skeleton_id
    assert P5.groups(P5.normalise(f)).where("field = 'body' and n = 2").count() == 1
    assert P5.find(f.where("1 = 0")).count() == 0


MODEL = P6.fit([(f"The pump number {i} was tested before noon and the valve was closed again by the office.", False, f"host{i % 7}") for i in range(300)] + [(f"Report {i} on the pumps", True, f"host{i % 7}") for i in range(100)])[0]


@pytest.mark.parametrize("text", ["404 Not Found\n\nThe page could not be located on this server.", "Please enable JavaScript to continue.", "{{title}}", "Approved by [DATE] on {contract.number}.", "本文件为【项目名称】编制。", "Lorem ipsum dolor sit amet.", "Frist: ${vertrag.nummer}"])
def test_residue(text):
    assert MODEL.case(text, False)


@pytest.mark.parametrize("text", ["The manual explains how a 404 differs from a 403. The pump was tested before noon and closed.", "```\n{{ x.name }}\n```\n\nThe pump was tested before noon and the valve was closed.", "{{Infobox|code=AB-12}} The pump was tested before noon.", "The valve was tested, see [3] and [pump](x.md).", None, "", "   "])
def test_no_residue(text):
    assert not MODEL.case(text, False)


@pytest.mark.parametrize(("text", "label"), [("by {{due_date}}, on", 1), ("see [pump name](x.md)", 0), (r"\emph{title}", 0), ("x_{date} or", 0), ("see [3] or", 0), ("in [Foo] we", None)])
def test_weak_span_labels(text, label):
    (m,) = P6.SPAN.finditer(text)
    assert P6.weak_span_label(text, m) == label


def test_spans_are_judged_by_the_score_alone():
    text = "Approved by {{title}}."
    (m,) = P6.SPAN.finditer(text)
    assert MODEL.span(text, m) > 0 and not P6.Model(bias_segment=-1.0, bias_span=-1.0).case(text, False)
    long = "{{ x | the long name of a thing that has to be filled in by somebody at some time before it goes to print and to the reader }}"
    assert P6.SPAN.search(long).group() == long and len(P6.span_features(long, P6.SPAN.search(long))) > 100


def test_long_segment_is_scored_whole():
    ends = "please enable javascript to continue " * 14
    middle = "the pump was tested before noon and the valve was closed again by the office " * 40
    assert MODEL.case(ends + ends, False)
    assert not MODEL.case(ends + middle + ends, False)


def test_residue_validates_on_unseen_hosts(spark):
    md = spark.createDataFrame([(i, f"h{i % 9}/a", f"The pump number {i} was tested before noon and the valve was closed again by the office." if i % 10 else "Access denied.", "x") for i in range(120)], "doc_id bigint, relpath string, body string, field string")
    fm = spark.createDataFrame([(1, "Untitled", "original-doc/h1/a"), (2, None, None)], "doc_id bigint, title string, source string")
    model, figures = P6.train(md, fm)
    assert figures["segment_recall"] > 0.9
    found = {tuple(r) for r in P6.find(fields(md, fm), model).collect()}
    assert found == {(i, "body") for i in range(0, 120, 10)} | {(1, "title")}
    empty, _ = P6.train(md.where("1 = 0"), fm.where("1 = 0"))
    assert P6.find(fields(md, fm).where("1 = 0"), empty).count() == 0


CASES = [("utf-8", "cp1252"), ("utf-8", "cp1251"), ("utf-8", "gb18030"), ("utf-8", "mac_roman")]


@pytest.mark.parametrize(("was", "shown"), CASES)
def test_round_trip(was, shown):
    fix = P7.Repairer()
    for text in ("Gemäß Vermerk prägt die Lücke", "Étude sur la mémoire créée", "with a “margin” – so"):
        try:
            broken = text.encode(was).decode(shown)
        except UnicodeDecodeError:
            continue
        case, whole, new = fix(f"Before. {broken} after.")
        assert case and whole and new == f"Before. {text} after."


def test_short_runs_and_lost_bytes():
    fix = P7.Repairer()
    assert fix("教练组使用手册第16册".encode("gbk").decode("latin-1"))[2] == "教练组使用手册第16册"
    assert fix("Ça créée à Noël")[0] is False and fix("«é» ÉÈ")[0] is False
    broken = "线程池支持稳定的消息队列，共5次。".encode().decode("gb18030", "replace")
    case, whole, new = fix(broken)
    assert case and not whole and new.count("\ufffd") <= broken.count("\ufffd") + 1 and "消息队列" in new


def test_layers_and_double_bytes():
    fix = P7.Repairer()
    assert fix("ÃƒÂ©lan") == (True, True, "élan")
    assert fix("公共评分标准核对了语言课程".encode("gbk").decode("latin-1"))[2] == "公共评分标准核对了语言课程"
    assert fix("线程池支持稳定的消息队列".encode().decode("gb18030"))[2] == "线程池支持稳定的消息队列"
    assert fix("Anders als frⁿher bestΣtigt")[2] == "Anders als früher bestätigt"
    case, whole, _ = fix("Apr\ufffds la visite")
    assert case and not whole
    assert fix("锟斤拷锟斤拷")[:2] == (True, False)


def test_any_number_of_layers_and_encodings():
    fix = P7.Repairer()
    for codec in ("cp1252", "latin-1"):
        text = "Étude créée à élan"
        for _ in range(5):
            text = "".join(bytes([b]).decode(codec) if codec == "latin-1" or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())
        assert fix(text) == (True, True, "Étude créée à élan")
    parts = [("früher", "cp437"), ("bestätigt", "mac_roman"), ("Prüfgerät", "cp850")]
    assert fix(" und ".join(w.encode("cp1252").decode(c) for w, c in parts)) == (True, True, " und ".join(w for w, _ in parts))
    stretches = [("Étude créée", "cp1252"), ("Gemäß", "mac_roman"), ("Lücke", "cp1251"), ("prägt", "cp437"), ("Öl", "cp850")]
    assert fix("; ".join(w.encode().decode(c) for w, c in stretches))[2] == "; ".join(w for w, _ in stretches)
    assert fix("GemÃ¤ÃŸ und so â€ weiter")[:2] == (True, False)


@pytest.mark.parametrize("text", ["Straße, Ölgemälde, à près, cœur", "SÃO VELTO", "Протокол 9 in Cyrillic", "α = 0.07", "公共评分标准核对了语言课程。", "“quoted” – and …", "Das Οmega", "", None, "plain"])
def test_clean_text_is_left_alone(text):
    assert P7.Repairer()(text) == (False, True, text)


def test_encoding_frames(spark):
    f = spark.createDataFrame([(1, "body", "GemÃ¤ÃŸ"), (1, "body", "GemÃ¤ÃŸ"), (2, "title", "x"), (3, "body", ""), (4, "body", "a" * 300_000 + "Ã©")], "doc_id bigint, field string, text string")
    assert P7.repair(f, every=True).count() == 5 and P7.repair(f, every=True).where("doc_id = 2 and recovered is null and repaired = 'x'").count() == 1
    got = sorted((r.doc_id, r.recovered, r.repaired[-5:]) for r in P7.repair(f).collect())
    assert got == [(1, True, "Gemäß"), (1, True, "Gemäß"), (4, True, "aaaaé")]
