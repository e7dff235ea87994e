import base64
import os
import random

import numpy as np
import pytest

from leafmill.llm import p08_tokens as P8
from leafmill.llm import p09_leaks as P9
from leafmill.llm import p10_personal as P10
from leafmill.llm import p10_train as T10

needs_vocabulary = pytest.mark.skipif(not os.path.exists(P8.VOCABULARY), reason="no vocabulary files")


@needs_vocabulary
def test_ids_equal_a_public_library(spark):
    import tiktoken

    with open(P8.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=P8.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    texts = ["".join(r.choice("ab  'sléüß中文字😀²½\x1c\u0301\n\t1239.,!—<|endoftext|>") for _ in range(r.randint(0, 90))) for _ in range(300)]
    texts += [None, "", " ", "a" * 5000, "中文" * 900, "".join(r.choice("abcdeé") for _ in range(200_000)), "<|endoftext|>", "same", "same"]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in P8.encode(frame).collect()}
    assert all(got[i] == (known.encode_ordinary(t) if t else []) for i, t in enumerate(texts))
    assert P8.encode(frame.where("1 = 0")).count() == 0


def brute(docs, items):
    out = set()
    for i, item in items:
        red = P9.reduce(item or "")
        run = 20 if len(P9._HAN.findall(red)) * 3 > len(red) else 60
        grams = {red[k : k + run] for k in range(len(red) - run + 1)}
        for d, t in docs:
            x = P9.reduce(t or "")
            if any(x[k : k + run] in grams for k in range(len(x) - run + 1)):
                out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij0123456789") for _ in range(r.randint(2, 9)))
    items = [(i, " ".join(word() for _ in range(r.choice([14, 30, 60])))) for i in range(30)] + [(90, "".join(chr(0x4E00 + r.randrange(900)) for _ in range(60))), (91, None), (92, ""), (93, "short")]
    docs = []
    for d in range(120):
        text = [word() for _ in range(40)]
        if d % 2:
            src = items[r.randrange(30)][1]
            at = r.randrange(max(1, len(src) - 90))
            text.insert(r.randrange(40), src[at : at + r.choice([55, 66, 72, 90])].upper().replace(" ", r.choice([" ", " - ", "\n"])))
        docs.append((d, " ".join(text)))
    for k, n in enumerate((19, 20, 21, 40)):
        docs.append((200 + k, "开头" + items[30][1][k * 3 : k * 3 + n] + "结尾"))
    docs += [(300, None), (301, ""), (302, items[0][1] * 2), (302, items[0][1] * 2)]
    frame = spark.createDataFrame([(*x, "z") for x in docs], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, doc_id string")
    got = [tuple(x) for x in P9.leaks(frame, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items)
    assert P9.leaks(frame, bench.where("1 = 0")).count() == 0 and P9.leaks(frame.where("1 = 0"), bench).count() == 0


BACKGROUND = ["The pump was tested before noon and the valve was closed by the office.", "Die Pumpe stützt das Ventil trotz früherer Einwände.", "La pompe modifie la vanne sans frais.", "闲置水泵影响到稳定的阀门，直至另行通知。"]


@pytest.fixture(scope="module")
def net():
    return P10.Net.load()


def test_training_learns():
    figures = T10.accuracy(T10.train(BACKGROUND, steps=240, rate=0.02), BACKGROUND, 200)
    assert figures["all"] > 0.9


def test_stored_weights_decode_held_out_spans(net):
    figures = T10.accuracy(net, BACKGROUND, 400)
    assert figures["all"] > 0.98 and min(figures.values()) > 0.93


def test_gradient_is_right():
    net = P10.Net(3)
    x, y = T10.spans_by_rule(3, ["a list of words that is long enough", "名单已经核对并存放"], seed=1)
    x, y = x[:, :12], y[:, :12]
    _, grad = T10.gradient(net, x, y)
    for name in P10.Net.NAMES:
        w = getattr(net, name)
        at = np.unravel_index(np.abs(grad[name]).argmax(), w.shape)
        keep, eps = w[at], 1e-2
        w[at] = keep + eps
        up = T10.gradient(net, x, y)[0]
        w[at] = keep - eps
        down = T10.gradient(net, x, y)[0]
        w[at] = keep
        assert abs((up - down) / (2 * eps) - grad[name][at]) < 0.05 * abs(grad[name][at]) + 2e-3


def test_cut_chain_gives_the_viterbi_path():
    net = P10.Net(5)
    r = np.random.default_rng(0)
    net.trans = r.standard_normal((P10.TAGS, P10.TAGS)).astype(np.float32)
    net.be[0] = 2
    x = r.integers(1, P10.VOCAB, (40, 90)).astype(np.int16)
    length = r.integers(1, 91, 40)
    for i, n in enumerate(length):
        x[i, n:] = 0
    e, got = net.emissions(x, length), net.decode(x, length)
    for i, n in enumerate(length):
        best, back = e[i, 0].copy(), []
        for t in range(1, n):
            both = best[:, None] + net.trans
            back.append(both.argmax(0))
            best = both.max(0) + e[i, t]
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        assert got[i, :n].tolist() == path[::-1] and not got[i, n:].any()
        alone = net.emissions(x[i : i + 1, :n], length[i : i + 1])
        assert np.allclose(alone[0], e[i, :n], atol=1e-4)


def test_found_values(net):
    find = P10.Finder(net)
    text = "Please write to quenna.vessmark [at] example [dot] org with any questions. SSN: 920-22-7576. My number is +44 20 7946 0915, leave a message.\n\nOrder 4500-1182-7833 is out of stock. Router 10.20.34.55 stays in use until March."
    got = {(k, v) for _, _, k, v in find([text])[0]}
    assert got == {("email", "quenna.vessmark@example.org"), ("id_number", "920227576"), ("phone", "442079460915")}


@pytest.mark.parametrize("name", ["Maria Dupont", "Łukasz Żak", "Šárka Nová", "Иван Петров", "Ανδρέας Παππάς", "Jan de Vries", "Anna von Berg", "J. Holmberg", "王建国"])
def test_names_of_any_script(net, name):
    frame = "Contact person: {}\n" if name[0] < "一" else "联系人：{}\n"
    assert ("name", "") in {(k, v) for _, _, k, v in P10.Finder(net)([frame.format(name)])[0]}


def test_windows_are_reconciled(net):
    pad = "The pump was tested before noon and the valve was closed by the office. "
    find = P10.Finder(net)
    for shift in range(0, 60, 7):  # a value on a seam is found once and whole, wherever it stands
        text = (pad * 12)[: P10.WINDOW - 60 + shift] + " Please write to desk-12@example.com today. " + pad * 12
        assert [(k, v) for _, _, k, v in find([text])[0]] == [("email", "desk-12@example.com")]


def test_redaction_and_frames(spark, net):
    rows = [(1, "Contact: desk-12@example.com\n\nThe pump was tested.", "k"), (1, "Contact: desk-12@example.com\n\nThe pump was tested.", "k"), (2, None, None), (3, "", None), (4, "The pump was tested. " * 4000 + "Mail desk-9@example.org now.", None)]
    f = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    assert sorted(tuple(r) for r in P10.find(f, net).distinct().collect()) == [(1, "email", "desk-12@example.com"), (4, "email", "desk-9@example.org")]
    out = {r.doc_id: r.text for r in P10.redact(f, net).collect()}
    assert out[1] == "Contact: <EMAIL>\n\nThe pump was tested." and out[2] is None and out[3] == "" and out[4].endswith("Mail <EMAIL> now.")
    assert P10.find(f.where("1 = 0"), net).count() == 0
