import random
import re
from collections import Counter

import numpy as np

from leafmill.llm import p01_scans, p02_markup, p02_train, p03_subjects

TEXT = "the improved oral examination depends on the annual tuition waiver and the reading group outlasted the planned school board"
VOCABULARY = dict.fromkeys(TEXT.split() + ["without", "extra", "cost", "library", "post", "treatment", "values"], 500)
PAGE = "\n".join(
    ["Archive of the Gorse office", "The improved exam@ination depends on the ann-", "ual tuition wa!ver and the re@ding group", "12", "Archive of the G0rse office", "outlasted the p1anned school board without", "extra cost and pre- and post-", "treatment values", "13"]
)


def test_scanned_page():
    see = p01_scans.Scanner(VOCABULARY)
    defects, text = see(PAGE.replace("exam@ination", "examination"))
    assert set(defects) == {"page_number", "running_header", "split_word", "misread"}
    assert text == "The improved examination depends on the annual tuition waiver and the reading group outlasted the planned school board without extra cost and pre- and post-treatment values"


def test_content_is_no_defect():
    see = p01_scans.Scanner(VOCABULARY)
    for text in ("Status: open\n\nThe improved examination.\n\n42\n\nmore", "", "one line", "- a\n- b\n- a\n- b", "| a | b |\n|---|---|\n| 1 | 2 |\n| 2 | 3 |", "```\nout = []\nx\nout = []\n```"):
        assert see(text) == ([], text)
    assert see(None) == ([], None)


def test_page_number_forms():
    for form in ("- %d -", "%d", "p. %d", "Seite %d von 40", "第 %d 页 共 50 页", "·%d·", "[%d]", "%d / 51"):
        assert p01_scans.page_numbers(["a", form % 8, "b", form % 9]) == {1, 3}, form
        assert p01_scans.page_numbers(["a", form % 8, "b", form % 8]) == set()
    assert p01_scans.page_numbers(["i", "b", "ii"]) == {0, 2}


def test_header_of_long_scan_without_numbers():
    some = "improved examination depends annual tuition waiver reading group outlasted planned school board without extra cost values".split()
    lines = []
    for page in range(14):
        lines.append("Annals of the Harb0ur Board" if page % 3 else "Annals of the Harbour Board")
        lines += [f"{some[(page * 7 + k) % 16]} {some[k % 13]} {some[(k * k + page) % 16]} {chr(97 + page) * 5} {chr(97 + k % 26) * (5 + k // 26)}" for k in range(60)]
    defects, text = p01_scans.Scanner({})("\n".join(lines))
    assert defects == ["running_header"] and "Annals" not in text


def test_forms_equal_linear_scan():
    for seed in range(4):
        r = random.Random(seed)
        base = ["".join(r.choice("abcd") for _ in range(r.randint(3, 60))) for _ in range(60)]
        forms, first = p01_scans.Forms(), []
        for _ in range(900):
            x = list(r.choice(base))
            for _ in range(r.randint(0, 9)):
                i = r.randrange(len(x))
                x[i : i + r.randint(0, 2)] = r.choice(["", "a", "b", "cd"]) or "d"
            x = "".join(x)
            want = forms.exact.get(x, next((k for k, g in enumerate(first) if p01_scans.alike(g, x)), len(first)))
            if want == len(first):
                first.append(x)
            assert forms.at(x) == want
        assert len(first) > 300


def test_misreading_is_a_matter_of_shares():
    for times in (1, 10, 100):
        see = p01_scans.Scanner({"the": 700 * times, "tbe": 8 * times, "science": 60 * times, "pre": 6 * times, "mise": 5 * times, "premise": 60 * times})
        assert see.undo("tbe") == ("the", 1) and see._line("tbe")[0] == "the"
        assert see.undo("scicncc") == ("science", 2)
        assert see.join("pre", "mise", "") == "premise"


def test_chinese_misreading():
    df = {"尚未": 900, "未公": 900, "期末": 900, "末考": 500}
    assert p01_scans.Scanner(df)._line("数据尚末公开，期末考试l6次") == ("数据尚未公开，期末考试16次", 2)


def test_scan_frames(spark):
    schema = "doc_id bigint, body string, defects string, text string"
    empty = spark.createDataFrame([], schema)
    assert p01_scans.scan(empty).count() == 0
    some = spark.createDataFrame([(1, PAGE, "x", "y"), (1, PAGE, "x", "y"), (2, None, None, None), (3, "", None, None), (4, "word " * 50_000, None, None)], schema)
    got = p01_scans.scan(some, VOCABULARY).collect()
    assert [r.doc_id for r in got] == [1, 1]
    every = p01_scans.scan(some, VOCABULARY, every=True).collect()
    assert sorted(r.doc_id for r in every) == [1, 1, 2, 3, 4] and [r.repaired for r in every if r.doc_id == 2] == [None]


def test_vocabulary_counts_records_and_long_words(spark):
    long = "donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft"
    frame = spark.createDataFrame([(f"pump {long} {i}",) for i in range(6)] + [(None,)], "body string")
    assert p01_scans.vocabulary(frame) == {"pump": 6, long: 6}
    see = p01_scans.Scanner({long: 600})
    assert see.undo(long.replace("schiff", "sch1ff")) == (long, 1)


def test_short_words_do_not_turn_into_others():
    see = p01_scans.Scanner({"scan": 600, "ocr": 600, "vous": 600})
    assert see.undo("seau") == ("seau", 0) and see.undo("cor") == ("cor", 0) and see.undo("von$") == ("von$", 0)


FIELD = p02_markup.Field.load()


def decoded(text):
    ls = p02_markup.leaves(text)
    path = FIELD.viterbi([[p02_markup.feature_ids(x) for x in ls]])[0]
    langs = p02_markup.languages(ls, path)
    return langs, p02_markup.clean(ls, path, langs)


def languages(text):
    return decoded(text)[0]


def test_field_is_accurate():
    assert p02_train.accuracy(FIELD) > 0.95
    assert p02_train.accuracy(p02_train.trained(300)) > 0.9


def test_labels_decide():
    ls = p02_markup.leaves("## Report on pumps\n\n<p>The valve</p>")
    assert p02_markup.languages(ls, np.zeros(len(ls), np.int64)) == []
    assert p02_markup.languages(ls, np.full(len(ls), 1)) == ["html"]


def test_structure_is_kept():
    _, out = decoded("<h1>Report</h1>\n<p>The <b>valve</b> was &amp; is.<br>Second line</p>\n<table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td>2</td></tr></table>\n<pre><code>if a &lt; b:\n    pass</code></pre>")
    assert out == "# Report\n\nThe valve was & is.\nSecond line\n\nx | y\n\n1 | 2\n\n```\nif a < b:\n    pass\n```"
    _, out = decoded("\\section{Report}\nThe \\textbf{valve} holds $x^2 = \\frac{a}{b}$ at\nall times.\n\\begin{equation}\nE = mc^{2}\n\\end{equation}\n\\[ a = b_{1} \\]")
    assert out == "# Report\n\nThe valve holds $x^2 = \\frac{a}{b}$ at\nall times.\n\n$$E = mc^{2}$$\n\n$$a = b_{1}$$"
    _, out = decoded("== Report ==\nThe '''valve''' and the [[pump|pumps]] are\nlisted below.\n\n{| class=\"wikitable\"\n! a !! b\n|-\n| 1 || 2\n|}")
    assert out == "# Report\n\nThe valve and the pumps are\nlisted below.\n\n| a | b |\n| 1 | 2 |"
    _, out = decoded("# Head\n\nSome **bold** text\nand [link](a/b.md) more.\n\n| a | b |\n|---|---|\n| 1 | 2 |")
    assert out == "# Head\n\nSome bold text\nand link more.\n\n| a | b |\n|---|---|\n| 1 | 2 |"


def test_any_depth():
    langs, out = decoded("<div>" * 3000 + "<h2>Deep</h2><p>text</p>" + "</div>" * 3000 + "<p>after</p>")
    assert langs == ["html"] and out == "## Deep\n\ntext\n\nafter"


def test_languages():
    md = "## Report on pumps\n\nThe **valve** was tested before noon on site.\n\n- one\n- two\n\n```c\n<b>x</b> \\section{y}\n```\n"
    assert languages(md) == ["markdown"]
    assert languages("<h1>Report</h1>\n<p>The <b>valve</b> was &amp; is.</p>\n<ul><li>a</li></ul>") == ["html"]
    assert languages("== Report ==\n\nThe '''valve''' and the [[pump|pumps]] are listed.\n\n{{Infobox|code=AB-1}}") == ["wiki"]
    assert languages("\\section{Report}\n\nThe \\textbf{valve} was tested.\n\n\\begin{itemize}\n  \\item one\n\\end{itemize}") == ["latex"]


def test_prose_is_no_markup():
    for text in ("If x < y and y > z, the file wins.", "The price rose from $3 to $9 per unit.", "See [3] for the list of pumps.", "<!-- stage2:chart=2 unit=page -->", "The form is for {{DATE}} and ${client}.", "- 12 -"):
        assert languages(text) == [], text


def test_markup_frames(spark):
    schema = "doc_id bigint, body string, markup string"
    assert p02_markup.decode(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "# A\n\n**b** c\n\n```\nx\n```", "z"), (2, None, None), (3, "", None), (4, "plain", None), (5, "<p>" * 3000 + "a\n" * 3000, None)]
    got = {r.doc_id: r for r in p02_markup.decode(spark.createDataFrame(rows, schema), text=True).collect()}
    assert {i for i, r in got.items() if r.markup} == {1, 5} and set(got) == {1, 2, 3, 4, 5} and got[4].cleaned == "plain" and got[2].cleaned is None and got[1].markup == ["markdown"] and got[1].cleaned == "# A\n\nb c\n\n```\nx\n```"


SAMPLES = [("sport", f"The goalkeeper saved the penalty kick in match {i}. The referee praised the goalkeeper after the match.") for i in range(12)] + [
    ("law", f"The plaintiff lost the appeal ruling in case {i}. The court filing names the plaintiff and the injunction.") for i in range(12)
]


def test_subjects_several_one_none():
    m, figures = p03_subjects.train(SAMPLES, [], ["law", "sport"])
    assert figures["held_out_accuracy"] > 0.9
    j = p03_subjects.Judge(m, None, {})
    sport, law = "The goalkeeper saved the penalty kick in the match. ", "The plaintiff lost the appeal ruling and the injunction. "
    accepted = [{s for s, x in found if x >= p03_subjects.MIN_SHARE} for _, found in j([sport * 4, sport * 3 + law * 3, sport * 9 + law, "", "Zzz qqq."])]
    assert accepted == [{"sport"}, {"sport", "law"}, {"sport"}, set(), set()]


def test_subject_frames(spark):
    md = spark.createDataFrame([(1, SAMPLES[0][1] * 3, "a"), (1, SAMPLES[0][1] * 3, "a"), (2, None, None), (3, "", None)], "doc_id bigint, body string, subject string")
    fm = spark.createDataFrame([], "doc_id bigint, category string, written_at timestamp")
    samples = spark.createDataFrame([(*x, "en") for x in SAMPLES], "subject string, sample string, lang string")
    subjects = spark.createDataFrame([("sport",), ("law",)], "subject string")
    got = p03_subjects.subjects_of(md, fm, samples, subjects, None)
    assert [tuple(r) for r in got.collect()] == [(1, "sport")]
    share = {r.subject: r.n_docs for r in p03_subjects.composition(got, md, subjects).collect()}
    assert share == {"sport": 1, "law": 0}
    assert p03_subjects.subjects_of(md.where("1 = 0"), fm, samples, subjects, None).count() == 0


def word(i):
    return "".join(chr(97 + i // 26**k % 26) for k in range(4)) + "x"


def test_subjects_are_learned_from_all_bodies(spark):
    own = [word(i) for i in range(4200)]
    kick = "The goalkeeper saved the penalty kick {0} in the match. The referee praised the goalkeeper {0}. The penalty match of {0} was for the goalkeeper."
    long = " ".join(kick.format("zyzzyva") for _ in range(160))
    assert len(long) > 20_000
    teach = [(i, kick.format(w)) for i, w in enumerate(own)] + [(20_000, long)]
    ask = [(10_000 + i, " ".join([w] * 6) + ".") for i, w in enumerate([*own, "zyzzyva"])]
    md = spark.createDataFrame(teach + ask, "doc_id bigint, body string").repartition(5)
    fm = spark.createDataFrame([], "doc_id bigint, category string, written_at timestamp")
    samples = spark.createDataFrame(SAMPLES, "subject string, sample string")
    subjects = spark.createDataFrame([("sport",), ("law",)], "subject string")
    got = {tuple(r) for r in p03_subjects.subjects_of(md, fm, samples, subjects, None).collect()}
    assert got == {(i, "sport") for i, _ in teach + ask}


def test_models_do_not_depend_on_parts(spark):
    said = [("Sports desk" if i % 2 else " court ", SAMPLES[i % 24][1] + f" The {word(i)} was seen beside the {word(i // 2)}. A {word(i)} is a thing.") for i in range(60)]
    said += [("court", f"One {word(i)} stood by itself. Two {word(i)} came along later. Then the {word(i)} went away.") for i in range(100, 110)]
    md = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(said)], "doc_id bigint, body string").repartition(4)
    fm = spark.createDataFrame([(i, c, d) for i, (c, _) in enumerate(said) for d in (1, 2)], "doc_id bigint, category string, day int").selectExpr("doc_id", "if(day = 2, category, 'none') as category", "timestamp_seconds(day) as written_at")
    kept = p03_subjects.parts(md, fm, None)
    ours, figures = p03_subjects.model(kept, spark.createDataFrame(SAMPLES, "subject string, sample string"), spark.createDataFrame([("sport",), ("law",)], "subject string"))
    theirs, also = p03_subjects.train(SAMPLES, [(b, c) for c, b in said], ["law", "sport"])
    assert figures == also and figures["added_tokens"] > 1000 and ours.ids == theirs.ids
    assert all((getattr(ours, a) == getattr(theirs, a)).all() for a in ("unigram", "keys", "bigram"))


def test_a_round_scores_bodies_once(monkeypatch):
    scored, of = [], p03_subjects.Opinion.of
    monkeypatch.setattr(p03_subjects.Opinion, "of", lambda m, part: scored.append(len(part.docs)) or of(m, part))
    bodies = [(SAMPLES[i % 24][1] + f" The {word(i)} was seen beside the {word(i // 2)}. A {word(i)} is a thing.", "Sports desk" if i % 2 else None) for i in range(60)]
    _, figures = p03_subjects.train(SAMPLES, bodies, ["law", "sport"])
    assert scored == [60] * p03_subjects.ROUNDS and figures["added_tokens"] > 1000


def test_what_bodies_teach_by_category():
    k, none = 3, 3
    cases = [  # top, best, second, enough, category, taught where x means 1
        (2, 0.9, 0.0, True, "x", 2), (1, 0.2, 0.0, True, "x", 1), (2, 0.2, 0.0, True, "x", 1), (1, 0.5, 0.1, True, "x", 1), (2, 0.5, 0.1, True, "x", none),
        (1, 0.5, 0.3, True, "x", none), (2, 0.9, 0.0, False, "x", none), (1, 0.2, 0.0, False, "x", none), (1, 0.2, 0.0, True, "y", none), (1, 0.5, 0.0, True, "y", none), (0, 0.8, 0.1, True, "y", 0),
    ]
    top, best, second, enough, categories, expected = zip(*cases)
    part = p03_subjects.pack([[f"{word(i)} {word(i + 1)} {word(i)} {word(i + 2)}"] for i in range(len(cases))])
    ids = dict(zip(part.words, range(len(part.words))))
    opinion = p03_subjects.Opinion(np.array(top), np.array(best), np.array(second), np.array(enough))
    got = p03_subjects.Lessons.of(opinion, part, list(categories), k, ids).taught({"x": 1}, k)
    want = p03_subjects.counts(part, np.array(expected), k, ids)
    rows = lambda c: sum((Counter({(int(p), int(s)): int(n)}) for p, s, n in zip(c.pair, c.subject, c.n)), Counter())
    assert rows(got) == rows(want) and rows(want).total() == 4 * sum(e < k for e in expected)


def test_tokens_of_many_sentences_at_once():
    code = re.compile(r"[a-z]{1,3}-?\d+|\d+|[^\W\d_一-鿿]+|[一-鿿]+")

    def tokens(sentence):
        out = []
        for t in code.findall(sentence.lower()):
            out += ([a + b for a, b in zip(t, t[1:])] or [t]) if "一" <= t[0] <= "鿿" else ["0" if t[-1].isdigit() else t]
        return out if len(out) >= 7 or len(out) >= 4 and out[0][0] < "一" else []

    texts = ["", "a b c", "Ab-12 abc34 abcd-5 ab--6 é7 aé8 1a2 a_b ÄÖ m² ²m ①② ٣ x٣ 𝐀𝟗 İK ΑΣ", "光谱仪", "光谱仪的分析结果如下", "光 谱仪ab仪 c1 é 光谱", "the 光谱仪 was here", "one two three four", "\n", "가나 다라 마바 사아", "a1 b2 c-3 d-e4"]
    for some in (texts, texts[::-1], *([t] for t in texts), []):
        found, size = p03_subjects.tokenise(some)
        assert [len(tokens(t)) for t in some] == size.tolist() and found.to_pylist() == [x for t in some for x in tokens(t)]


def test_parts_do_not_depend_on_chunks(monkeypatch):
    bodies = [[f"The {word(i)} was seen beside the {word(i // 2)}."] * (i % 4) + ["Too short."] for i in range(40)]
    one = p03_subjects.pack(bodies)
    assert one.docs.tolist() == [i % 4 for i in range(40)] and set(one.size) == {7} and len(p03_subjects.pack(bodies, 1).docs) == 40
    for n in (1, 100):
        monkeypatch.setattr(p03_subjects, "CHUNK", n)
        many = p03_subjects.pack(bodies)
        assert many.words == one.words and all((getattr(many, a) == getattr(one, a)).all() for a in ("before", "now", "code", "size", "docs"))
        assert len(p03_subjects.pack(iter(bodies), 1).docs) < 10


def test_gaps_between_sentences():
    text = "One two. Three!\n\nFour\n- five\n 6) six\nseven\n \n\neight。九？ ten... eleven."
    assert p03_subjects.sentences(text) == ["One two.", "Three!", "Four", "- five", " 6) six\nseven", "eight。", "九？", "ten...", "eleven."]
    assert p03_subjects.sentences("a <b> c&amp;d \\emph{x} ]( {{y}} <!-- z\n --> e") == ["a   c d   x   (     e"]


def test_words_are_counted_once_a_text():
    assert Counter(p01_scans.words("a b a 光谱仪")) == Counter(["a", "b", "光谱", "谱仪"])
