"""Trainer of the field of problem 2: writes labelled pages by rule, fits the chain by exact likelihood, and stores its weights beside the operator.

    python -m leafmill.llm.p02_train [--pages N]
"""

from __future__ import annotations

import argparse
import random
from pathlib import Path

import numpy as np

from .p02_markup import CODE, LABELS, N_FEATURES, NOTE, OWN, PLAIN, WEIGHTS, Field, feature_ids, leaves


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def fit(pages: list[list[list[int]]], labels: list[list[int]], steps: int = 160, l2: float = 2e-4) -> Field:
    """Maximum likelihood by full-batch adaptive gradient steps; forward-backward over padded matrices."""
    k = len(LABELS)
    f = Field(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros(k))
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    groups = [order[i : i + 64] for i in range(0, len(order), 64)]
    g2 = [np.full(x.shape, 1e-6) for x in (f.emission, f.transition, f.start)]
    prepared = []
    for rows in groups:
        _, mask = f.scores([pages[i] for i in rows])
        y = np.zeros(mask.shape, np.int64)
        y[mask] = [v for i in rows for v in labels[i]]
        flat = [x for i in rows for x in pages[i]]
        cols = np.concatenate([np.array(x) for x in flat])
        which = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
        prepared.append((rows, mask, y, cols, which))
    total = sum(len(p) for p in pages)
    for _ in range(steps):
        grad = [l2 * f.emission, l2 * f.transition, l2 * f.start]
        for rows, mask, y, cols, which in prepared:
            s, _ = f.scores([pages[i] for i in rows])
            n, top, _ = s.shape
            alpha, beta = np.zeros_like(s), np.zeros_like(s)
            alpha[:, 0] = f.start + s[:, 0]
            for t in range(1, top):
                new = _lse(alpha[:, t - 1, :, None] + f.transition[None], 1) + s[:, t]
                alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
            for t in range(top - 2, -1, -1):
                new = _lse(f.transition[None] + (s[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
            z = _lse(alpha[:, -1], 1)
            p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
            one = np.eye(k)[y] * mask[:, :, None]
            d = (p - one)[mask] / total
            np.add.at(grad[0], cols, d[which])
            grad[2] += (p - one)[:, 0].sum(0) / total
            for t in range(1, top):
                pair = np.exp(alpha[:, t - 1, :, None] + f.transition[None] + (s[:, t] + beta[:, t])[:, None, :] - z[:, None, None])
                seen = one[:, t - 1, :, None] * one[:, t, None, :]
                grad[1] += ((pair - seen) * mask[:, t, None, None]).sum(0) / total
        for w, g, q in zip((f.emission, f.transition, f.start), grad, g2):
            q += g * g
            w -= 0.5 * g / np.sqrt(q)
    return f


def sample_pages(n: int, seed: int = 7) -> tuple[list[str], list[list[int]]]:
    """Pages written by rule, with the label of each leaf."""
    rng = random.Random(seed)
    base = "the report covers water pumps and lists every valve that was tested before noon on site der Bericht nennt alle Pumpen le rapport cite chaque vanne 报告 列出 所有 阀门".split()
    w = lambda a=3, b=9: " ".join(rng.choice(base) for _ in range(rng.randint(a, b)))
    word = lambda: rng.choice(base)
    plain = [lambda: w(6, 16) + ".", lambda: w(6, 14) + "。", lambda: f"If {word()[0]} < y and y > z, {w()}.", lambda: f"The price rose from ${rng.randint(1, 99)} to ${rng.randint(1, 99)} {w()}.", lambda: f"{w()} see [{rng.randint(1, 40)}] for {w()}.", lambda: f"Multiply {rng.randint(1, 9)} * 3 * {rng.randint(1, 9)} before {w()}.", lambda: f"The variable snake_case_{rng.randint(1, 9)} {w()}.", lambda: f"{w()} {{{{customer_name}}}} {w()}.", lambda: f"by ${{DATE}} or %version% {w()}.", lambda: f"Path C:\\temp\\x{rng.randint(1, 9)} {w()}.", lambda: f"Issue #{rng.randint(1, 900)} {w()}.", lambda: f"- {rng.randint(1, 90)} -", lambda: f"[{rng.randint(1, 90)}]", lambda: f"{rng.randint(1, 90)}", lambda: f"{rng.randint(1, 9)} / 40", lambda: f"[Insert {word()} here] {w()}"]
    shared = [lambda: f"- {w()}", lambda: f"* {w()}", lambda: f"{rng.randint(1, 9)}. {w()}", lambda: f"+ {w()}"]
    md = [lambda: "#" * rng.randint(1, 4) + " " + w(), lambda: f"{w()} **{word()}** {w()}.", lambda: f"*{w(1, 3)}* {w()}.", lambda: f"{w()} `{word()}` {w()}.", lambda: f"{w()} [{word()}](../a/b_{rng.randint(1, 9)}.md)", lambda: f"{w()} [{w(1, 3)}](../x-{rng.randint(1, 9)}/y_z.md) {w()}.", lambda: f"[{w(1, 2)}](n/f.md) {w()}.", lambda: f"![{word()}](assets/{rng.randint(1, 9)}.png)", lambda: f"> {w(5, 12)}.", lambda: f"| {word()} | {word()} |", lambda: "|---|---|", lambda: f"~~{word()}~~ {w()}.", lambda: f"__{word()}__ {w()}."]
    wiki = [lambda: f"== {w()} ==", lambda: f"=== {w()} ===", lambda: f"{w()} '''{word()}''' {w()}.", lambda: f"{w()} [[{word()}]] {w()}.", lambda: f"[[{word()}|{word()}]] {w()}.", lambda: f"{{{{Infobox|code=AB-{rng.randint(1, 99)}}}}}", lambda: f"{w()}. {{{{cite|AB-{rng.randint(1, 99)}}}}}", lambda: '{| class="wikitable"', lambda: f"! {word()} !! {word()}", lambda: "|-", lambda: f"| {word()} || {rng.randint(1, 9)}", lambda: "|}", lambda: f"[[Category:{word()}]]"]
    tex = [lambda: f"\\section{{{w()}}}", lambda: f"\\subsection*{{{w()}}}", lambda: f"{w()} \\textbf{{{word()}}} {w()}.", lambda: f"\\emph{{{w(1, 3)}}} {w()}.", lambda: f"\\begin{{{rng.choice(['itemize', 'equation', 'align*'])}}}", lambda: f"\\end{{{rng.choice(['itemize', 'equation', 'align*'])}}}", lambda: f"  \\item {w()}", lambda: f"{w()} $k = \\frac{{x_{{3}}}}{{d + 2}}$", lambda: "  \\int_0^{20} p(z)\\,dz = \\beta_{j}", lambda: "\\[ t = \\frac{y_{2}}{j} \\]", lambda: "\\maketitle", lambda: f"{w()} \\cite{{a_{rng.randint(1, 9)}}}"]
    code = ["def f(path, limit=5):", "    out = []", "# comment here", "for item in scan(path):", "return out", "int f(const char *p) {", "}", '<section id="a">', '  <p class="b">{{ x.name }}</p>', "merge_all --depth 30 | wrap > out.txt", "add_library(a STATIC b.c)", "**not bold**"]
    tag = lambda: rng.choice(["kbd", "u", "small", "b", "i", "font", "span", "sub", "strong"])
    inline = [lambda: f"{w()} <{(t := tag())}{rng.choice(['', ' size=\"2\"', ' class=\"x\"'])}>{word()}</{t}> {w()}.", lambda: f"{w()} &{rng.choice(['lt', 'gt', 'amp', 'nbsp', 'ldquo', 'eacute', '#8217'])};{word()} {w()}.", lambda: f"{w()}<br /> {w()}."]
    sparse = {1: inline, 2: md, 3: wiki, 4: tex}
    pages, labels = [], []
    for _ in range(n):
        kind = rng.choice(["plain", "plain", "html", "markdown", "markdown", "wiki", "latex", "mixed", "sparse", "sparse", "sparse"])
        lone = rng.randint(1, 4)
        text, y = [], []

        def line(s: str, label: int) -> None:
            text.append(s)
            for x in leaves("\n".join(text))[len(y) :]:  # a tag is a leaf of its own within a line; what stands around it is not of its language
                own = bool(x.opened or x.within.any or OWN["html"].search(x.text)) and x.fence == "" and label not in (CODE, NOTE)
                y.append(1 if own else PLAIN if label == 1 else label)

        for _ in range(rng.randint(3, 16)):
            r = rng.random()
            if kind == "plain":
                line(rng.choice(plain)() if r < 0.85 else rng.choice(shared)(), PLAIN)
            elif kind == "sparse":  # mostly prose, now and then a sign of one language
                line(rng.choice(sparse[lone])() if r < 0.3 else rng.choice(plain)(), lone if r < 0.3 else PLAIN)
            elif kind in ("markdown", "mixed"):
                if r < 0.12:
                    mark = rng.choice(["```", "~~~"])
                    line(mark + rng.choice(["", "python", "c", "html"]), 2)
                    for _ in range(rng.randint(1, 5)):
                        line(rng.choice(code), CODE)
                    line(mark, 2)
                elif r < 0.5:
                    line(rng.choice(md)(), 2)
                elif r < 0.54 and kind == "mixed":
                    line(f"{rng.choice(md)()} <{(t := tag())}>{word()}</{t}>{rng.choice(['', ' ' + w() + '.'])}", 2)
                elif r < 0.58 and kind == "mixed":
                    line(f"{w()} <{(t := rng.choice(['kbd', 'u', 'small', 'b']))}>{word()}</{t}> {w()}.", 1)
                elif r < 0.68:
                    line(rng.choice(shared)(), 2)
                else:
                    line(rng.choice(plain)(), PLAIN)
            elif kind == "html":
                if r < 0.03:
                    line("<!DOCTYPE html>", 1)
                elif r < 0.4:
                    line(f"<p>{w()} <b>{word()}</b> {w()} &amp; {w()}.</p>", 1)
                elif r < 0.5:
                    line(f"<h{(h := rng.randint(1, 4))}>{w()}</h{h}>", 1)
                elif r < 0.62:
                    line(f"<ul><li>{w()}</li><li>{w()}</li></ul>", 1)
                elif r < 0.7:
                    line(f"<table><tr><td>{word()}</td><td>{rng.randint(1, 9)}</td></tr></table>", 1)
                elif r < 0.78:
                    before = len(leaves("\n".join(text)))
                    text.append("<pre><code>" + "\n".join(rng.choice(code).replace("<", "&lt;") for _ in range(3)) + "</code></pre>")
                    new = leaves("\n".join(text))[before:]
                    y.extend(CODE if x.within.code and not x.text.startswith("</") else 1 for x in new)
                else:
                    line(rng.choice(plain)() if r < 0.9 else f"{w()} &ldquo;{word()}&rdquo; {w()}.", PLAIN if r < 0.9 else 1)
            else:
                own = wiki if kind == "wiki" else tex
                line(rng.choice(own)() if r < 0.5 else rng.choice(shared)() if r < 0.6 else rng.choice(plain)(), (3 if kind == "wiki" else 4) if r < 0.6 else PLAIN)
            if rng.random() < 0.06:
                line(f"<!-- stage2:{rng.choice(['chart', 'formula', 'image-ocr'])}={rng.randint(1, 9)} unit=page -->", NOTE)
            if rng.random() < 0.3 and text:
                text.append("")
        joined = "\n".join(text)
        if len(leaves(joined)) == len(y) and y:
            pages.append(joined)
            labels.append(y)
    return pages, labels


def trained(n_pages: int = 900, seed: int = 7) -> Field:
    pages, labels = sample_pages(n_pages, seed)
    return fit([[feature_ids(x) for x in leaves(p)] for p in pages], labels)


def accuracy(field: Field, n_pages: int = 200, seed: int = 99) -> float:
    """Share of leaves decoded right on held-out pages."""
    pages, labels = sample_pages(n_pages, seed)
    got = field.viterbi([[feature_ids(x) for x in leaves(p)] for p in pages])
    return float(np.mean(np.concatenate([g == np.array(y) for g, y in zip(got, labels)])))


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--pages", type=int, default=2500)
    p.add_argument("--out", type=Path, default=WEIGHTS)
    a = p.parse_args()
    field = trained(a.pages)
    field.save(a.out)
    print(accuracy(field))


if __name__ == "__main__":
    main()
