"""Nulls, empty and very long texts, ties and repeated rows, empty tables, and clashing columns."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, html, langid, licenses, mixing, mtree, quality, simhash, toxicity, urls

LONG = "the quick brown fox jumps over the lazy dog near river " * 3000 + "idiot"
DOCS = [
    (1, "a plain text of some ten words that is not much longer than that"),
    (2, "a plain text of some ten words that is not much longer than that"),
    (2, "a plain text of some ten words that is not much longer than that"),
    (None, "a plain text of some ten words that is not much longer than that"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "1234 5678 !!!"),
    (7, LONG),
    (8, "Grüße aus İstanbul Σίσυφος <|endoftext|> it's 42   é \x1c x"),
    (9, "Licensed under the\nApache License, Version 2.0.\nAll rights reserved."),
]
SCHEMA = "doc_id long, text string, kept string, score string, mixed string, judged string, lang string, key string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, "k", "s", "m", "j", "en", "y") for d in DOCS], SCHEMA)


def by_text(rows, column):
    return {(r.doc_id, r.text): r[column] for r in rows}


def test_toxicity(docs):
    model = toxicity.train(["you idiot are a nice one", "you are a nice one"] * 20 + [None, ""], [1, 0] * 20 + [0, 0], ["en"] * 42, [False] * 42, steps=100)
    rows = docs.withColumn("out", toxicity.score(F.col("text"), model)).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.out <= 1 and r.score == "s" for r in rows)
    out = by_text(rows, "out")
    assert out[3, None] == out[4, ""] < 0.5 < out[7, LONG]
    assert toxicity.train(["a"], [1], ["en"], [False]) is None
    assert docs.select(toxicity.score(F.col("text"), None).alias("x")).first().x == 0.0


def test_language(docs):
    model = langid.train(["the cat and the dog", "der Hund und die Katze", "le chat et le chien"] * 5, ["en", "de", "fr"] * 5)
    rows = docs.withColumn("out", langid.identify(F.col("text"), model)).collect()
    out = by_text(rows, "out")
    assert all(out[k].lang == "und" and out[k].score == 0 for k in [(3, None), (4, ""), (5, " \t\n "), (6, "1234 5678 !!!")])
    assert out[7, LONG].lang == "en" and rows[0].lang == "en"
    assert langid.train([], []) is None


def test_bpe(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = bpe.encode_decode(docs, path, keep=("doc_id", "text", "key")).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == t.decode(ids, skip_special_tokens=False) and r.key == "y"
    assert bpe.encode_decode(docs.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_decode(docs.withColumn("ids", F.lit(1)), path, keep=["ids"])


def test_bpe_equal_blocks(spark):
    """Partitions of the same rows make blocks of the same name, words and slots."""
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    same = spark.createDataFrame([(None, "the river, the unforeseeable river")] * 40, "doc_id long, text string")
    rows = bpe.encode_decode(same, path).collect()
    ids = t.encode("the river, the unforeseeable river", add_special_tokens=False).ids
    assert len(rows) == 40
    assert all(np.frombuffer(r.ids, dtype="<u4").tolist() == ids and r.doc_id is None for r in rows)
    assert {r.decoded for r in rows} == {t.decode(ids, skip_special_tokens=False)}


def test_bpe_raises_when_texts_change_between_reads(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    changing = spark.range(20).select(F.col("id").alias("doc_id"), F.expr("reflect('java.util.UUID', 'randomUUID')").alias("text"))
    with pytest.raises(Exception, match="changed between two reads"):
        bpe.encode_decode(changing, path).collect()


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href='/a'>A</a><li><a href='/b'>B</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies.</div><article><h1>Head &amp; line</h1><p>One <b>bold</b> &lt;tag&gt;\n  text.<p title='a > b'>Two&nbsp;x<br>y</p>"
    "<aside>See also</aside><form><input value=1>Mail</form><section id='comments'><p>First!</p></section></article><script>var a='<p>no</p>';</script><footer>&copy; us"
)


def test_html(spark):
    weights = html.train([PAGE] * 5)
    pages = spark.createDataFrame([(1, PAGE, "x"), (1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "<<p>a < b<p", "x"), (5, "<article>" + "<p>para</p>" * 5000, "x")], "page_id long, html string, text string")
    rows = pages.withColumn("out", html.main_text(F.col("html"), weights)).orderBy("page_id").collect()
    assert rows[0].out.text == rows[1].out.text == "Head & line\nOne bold <tag> text.\nTwo x y"
    assert rows[2].out.text == rows[3].out.text == "" and rows[0].text == "x"
    assert rows[5].out.text == "\n".join(["para"] * 5000)


def test_html_hidden_by_attributes_only():
    shown = ['style="overflow:hidden"', 'class="overflow-hidden"', 'title="Hidden costs"', "data-x='aria-hidden=true'", "data-hidden", 'hidden="false"', 'title="display:none"', 'aria-hidden="false"', "title='a > hidden'", 'style="x-display:none"']
    hidden = ["hidden", "HIDDEN", 'hidden=""', "hidden=until-found", 'aria-hidden="true"', "aria-hidden = 'true'", 'style="color:red; display : none"', "style=display:none", 'class="a"hidden']
    texts = lambda attribute, name: [b.text for b in html.blocks_of(f"<{name} {attribute}><p>own</p></{name}>")]
    assert all(texts(a, name) == ["own"] for a in shown for name in ("body", "div"))
    assert all(texts(a, name) == [] for a in hidden for name in ("body", "div"))
    assert html.blocks_of('<p><a href="/hidden-gems">gems</a></p>')[0].text == "gems"
    assert html.blocks_of('<div data-class="ad" class="x">a</div>')[0].words == {"x"}


def test_html_costs_and_cut_decide():
    weights = np.zeros(html.FEATURES)
    page = html.blocks_of("<div><p>a</p><aside>x</aside><p>b</p></div>")
    assert html.Costs(weights)(page[1], 1, 3) == 0
    weights[html._bucket("own p")], weights[html._bucket("own aside")] = 2, -0.4  # doubtful: its neighbours decide
    assert html.content(page, html.Costs(weights)) == [True, True, True]
    weights[html._bucket("own aside")] = -4
    assert html.content(page, html.Costs(weights)) == [True, False, True]


def test_html_names_around_an_article():
    site = '<body class="x"><nav><a href=a>Home</a></nav><div class="sidebar">Read <a href=b>more</a></div><article><h1>Head</h1><p>One long line.</p><div class="share">Tell</div></article><footer>Legal</footer>'
    weights = html.train([site] * 50)
    for body, wrap in (("has-sidebar search", "page"), ("x", "share sidebar"), ("form", "legal notice")):
        page = f'<html class="copyright"><body class="{body}"><div class="{wrap}"><nav><a href=a>Home</a></nav><article class="comment form"><h1>Head</h1><p>One long line.</p><div class="share">Tell</div></article></div><div class="sidebar">Read <a href=b>more</a></div><footer>Legal</footer>'
        blocks = html.blocks_of(page)
        kept = html.content(blocks, html.Costs(weights))
        assert [b.text for b, keep in zip(blocks, kept) if keep] == ["Head", "One long line."]


def test_min_cut_against_all_labellings():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        terminal = rng.normal(0, 1, n).round(2).tolist()
        edges = [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, n, 12), rng.integers(0, n, 12), rng.random(12).round(2)) if a != b]

        def cost(side):
            return sum(max(t, 0) if not s else max(-t, 0) for t, s in zip(terminal, side)) + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert abs(cost(html.max_flow_side(terminal, edges)) - best) < 1e-6


def test_quality(docs):
    good = ["A fine line of plain words here.\nAnd then another one of them that ends."] * 20
    bad = ["THEA,!! NDOR!! AND&&& OF%%% IT!!\nBUY!! NOW!! $$$ AND### SAVE***"] * 20
    field = quality.train(good + bad + [None, ""], [1] * 20 + [0] * 20 + [1, 0])
    rows = docs.withColumn("out", quality.rules(F.col("text"), field)).collect()
    out = by_text(rows, "out")
    assert all(out[k].n_words == 0 and out[k].base_failed and not out[k].kept for k in [(3, None), (4, ""), (5, " \t\n ")])
    assert out[1, DOCS[0][1]].kept and rows[0].kept == "k" and out[7, LONG].base_failed
    assert quality.train(["x"], [1]) is None


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(50):
        field = quality.LineField(rng.normal(0, 1, (3, 2)), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2))
        lines = rng.normal(0, 1, (6, 3))
        emit = lines @ field.emission

        def score(path):
            return field.start[path[0]] + sum(emit[i][m] for i, m in enumerate(path)) + sum(field.transition[a, b] for a, b in zip(path, path[1:]))

        paths = [[k >> i & 1 for i in range(6)] for k in range(64)]
        assert quality.viterbi(field, lines.tolist()) == max(paths, key=score)


def test_simhash(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    ids = {(r.id, r.fp): r.component_id for r in rows}
    zero = [r for r in rows if r.id in (3, 4, 5)]
    assert all(r.fp == 0 and r.component_id == 3 for r in zero)
    assert {r.component_id for r in rows if r.id in (1, 2, None)} == {1} and len(ids) == len(DOCS) - 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_pigeonhole_finds_all_links(spark):
    rng = np.random.default_rng(9)
    center = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {int(c) for c in center}
    for c in center[:20]:
        for _ in range(60):
            x = int(c)
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    a = np.array(sorted(prints), dtype=np.uint64)
    simhash_links = simhash.linked_prints(spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")).collect()
    number = {int(x): i for i, x in enumerate(a.view(np.int64))}

    def classes(edges):
        up = list(range(len(a)))

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for u, v in edges:
            up[root(u)] = root(v)
        return {frozenset(i for i in range(len(a)) if root(i) == r) for r in {root(i) for i in range(len(a))}}

    real = [(i, int(j)) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4) if j > i]
    assert classes([(number[r.u], number[r.v]) for r in simhash_links]) == classes(real)


@pytest.mark.parametrize("total", [100, 10**6, 10**10])
def test_thresholds_cover_the_limit(total):
    sample = np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64)
    chosen = simhash.plan(sample, total, 4)
    masks = [m for m, _ in chosen]
    assert all(a & b == 0 for i, a in enumerate(masks) for b in masks[:i])
    # the adversary spends threshold + 1 bits in each probed partition
    assert sum(t + 1 for _, t in chosen) >= 5


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(300)] + [(20, [0.5] * 8), (400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (None, [1.0] * 8), (403, []), (440, [1.0, 2.0])]
    vectors += [(i, [1.0] * 8) for i in range(500, 560)]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, rank string")
    rows = mtree.top_k(df, lambda i: i % 20 == 0, k=20).collect()
    usable = [(i, tuple(int(np.floor(64 * float(x))) for x in v)) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for q in {i for i, _ in usable if i % 20 == 0 and i != 20}:
        own = next(v for i, v in usable if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in usable if i != q and len(v) == len(own))[:20]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == scores
    assert mtree.top_k(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_licenses(docs):
    assert all(any(a in s for a in licenses.ANCHORS) for texts in licenses.SENTENCES.values() for s in texts)
    rows = docs.select("doc_id", "text", licenses.scan(F.col("text")).alias("out")).collect()
    out = by_text(rows, "out")
    assert out[9, DOCS[-1][1]].licenses == ["All-Rights-Reserved", "Apache-2.0"]
    assert out[3, None].licenses == out[4, ""].licenses == []


GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""


def test_license_notices(spark):
    mit = licenses.SENTENCES["mit-grant"] + licenses.SENTENCES["mit-notice"] + licenses.SENTENCES["as-is"]
    texts = {
        "// SPDX-License-Identifier: MIT\nint x;": ["MIT"],
        "/* spdx-license-identifier: Apache-2.0 */": ["Apache-2.0"],
        "# SPDX-License-Identifier: GPL-3.0-or-later": ["GPL-3.0"],
        "# SPDX-License-Identifier:\tGPL-2.0-only\n\nimport x": ["GPL-2.0"],
        "SPDX-License-Identifier: BSD-3-Clause": ["BSD-3-Clause"],
        GPL.format(";", ";", 2): ["GPL-2.0"],
        GPL.format(":", ",", 2): ["GPL-2.0"],
        GPL.format(":", ",", 3): ["GPL-3.0"],
        GPL.format(";", ";", 3): ["GPL-3.0"],
        GPL.format(",", ",", 3): ["GPL-3.0"],
        "This program is free software. This program is distributed in the hope that it will be useful, but without any warranty.": [],
        BSD2: ["BSD-2-Clause"],
        BSD3: ["BSD-3-Clause"],
        BSD3 + BSD3: ["BSD-3-Clause"],
        BSD3 + BSD2: ["BSD-2-Clause", "BSD-3-Clause"],
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy": ["MPL-2.0"],
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file': ["Apache-2.0"],
        "\n".join(x + "." for x in mit): ["MIT"],
    }
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", licenses.scan(F.col("text"))["licenses"].alias("own")).collect()
    assert {r.text: r.own for r in rows} == texts


def test_every_license_rule_can_fire(spark):
    said = {name: texts[0] for name, texts in licenses.ALL_SENTENCES.items()}
    said |= {n: t.replace("spdx license identifier", "SPDX-License-Identifier:") for n, t in said.items()}
    rules = licenses.ALL_RULES
    rows = spark.createDataFrame([(i, ".\n".join(said[x] for x in rule)) for i, (_, rule) in enumerate(rules)], "i int, text string")
    for r in rows.select("i", licenses.scan(F.col("text"))["licenses"].alias("own")).collect():
        assert rules[r.i][0] in r.own


def test_mixing(spark, docs):
    labelled = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate([("one two three", "a"), ("vier fuenf sechs", "b"), (None, "a"), ("x", None)] * 5)], "id long, text string, domain string")
    domains = mixing.fit(labelled)
    table = docs.union(spark.createDataFrame([(20 + i, "vier fuenf", "k", "s", "m", "j", "en", "y") for i in range(5)], SCHEMA))
    rows = mixing.mix(table, domains, {"a": 0.5, "b": 0.5, "none": 1.0}, into="out").collect()
    assert len(rows) == len(DOCS) + 5 and rows[0].mixed == "m" and all(r.out.rate >= 0 for r in rows)
    total = sum(r.out.tokens * r.out.rate for r in rows)
    assert abs(sum(r.out.tokens * r.out.rate * r.out.p[0] for r in rows) / total - 0.5) < 1e-3
    assert mixing.mix(docs.limit(0), domains, 0.7).count() == 0
    alone = mixing.fit(labelled.limit(0))
    assert all(r.mixed.rate == 1 for r in mixing.mix(docs, alone, {"a": 1.0}).collect())


def test_mixing_words(spark):
    import re

    texts = ["a\nb\tc", " \t\n", "", None, "a  b\r\n c ", "one", "\x0ba\x0cb", "é\xa0x y\x1cz", "a\n\n\nb"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", mixing.words(F.col("text")).alias("w"), mixing.n_words(F.col("text")).alias("n")).collect()
    for r in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        assert r.w == own and r.n == len(own)


def test_pipeline_mixing_drops_nothing(spark):
    import corpus_pipeline

    rng = np.random.default_rng(1)
    own = {"en": [f"e{i}" for i in range(40)], "de": [f"d{i}" for i in range(40)]}
    some = lambda lang, n: " ".join(rng.choice(own[lang], n))
    rows = [(i, some("en", 30), "en") for i in range(300)] + [(1000 + i, some("de", 20) + " " + some("en", 15), "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, "").collect()}
    assert out == {r[0] for r in rows}


def test_urls(spark):
    labelled = [(f"http://m.win{i % 3}.bad.com/en/{i}", "block") for i in range(60)] + [(f"http://m.ok{i}.good.com/en/{i}", "allow") for i in range(60)] + [(None, "block"), ("x", None)]
    rules = urls.mine(spark.createDataFrame(labelled, "url string, verdict string"), min_support=0.1)
    assert rules.filter("verdict = 'block'").count() > 0 and rules.filter("verdict = 'allow'").count() == 0
    fixed = [("block", "net/"), ("allow", "bad.com/en/good")]
    own = ["http://Q.BAD.com/en/7?x=1", "http://q.bad.com/en/good/1", "https://a.net", "https://a.net/", "https://evilnet/", None, "no scheme", "http://q.bad.com/en/7?x=1"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(own)], "page_id long, url string, host string")
    out = {r.page_id: r.judged for r in urls.judge(pages, fixed, rules).collect()}
    assert (out[0].host, out[0].path, out[0].verdict) == ("q.bad.com", "/en/7", "block")
    assert (out[1].rule, out[1].verdict) == ("bad.com/en/good", "allow")
    assert out[2].rule is None and (out[3].rule, out[3].verdict) == ("net/", "block") and out[4].rule is None
    assert all((out[i].host, out[i].path, out[i].rule, out[i].verdict) == ("", "", None, "allow") for i in (5, 6))
    assert urls.judge(pages.limit(0), fixed, rules).count() == 0


def test_url_rules_by_count_exceptions_and_words(spark):
    rows = [(f"http://s{chr(97 + i % 26)}.good.com/{i}", "allow") for i in range(12_000)]
    rows += [(f"http://x.rare.org/{i}", "block") for i in range(25)]
    rows += [(f"http://x.mixed.com/bad/{i}", "block") for i in range(200)] + [(f"http://x.mixed.com/help/{i}", "allow") for i in range(30)]
    rows += [(f"http://{h}/{i}", "block") for h in ("cheap-pills.info", "pills-now.biz", "best-pills.net") for i in range(8)]
    rules = urls.mine(spark.createDataFrame(rows, "url string, verdict string"))
    own = ["http://y.rare.org/7", "http://x.mixed.com/other", "http://x.mixed.com/help/9", "http://new-pills.shop/", "http://sa.good.com/1"]
    pages = spark.createDataFrame([(u,) for u in own], "url string")
    out = {r.url: r.judged.verdict for r in urls.judge(pages, [], rules).collect()}
    assert [out[u] for u in own] == ["block", "block", "allow", "block", "allow"]
    assert rules.filter("verdict = 'allow' AND NOT array_contains(tokens, 'path:help')").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("kept", F.lit(1))
    odd = spark.createDataFrame([(None, None), (None, ""), (9001, None)], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and 0 < out.count()
        assert stage(spark, docs.limit(0), sf).count() == 0
    final = corpus_pipeline.run(spark, sf)
    assert final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and final.count() > 100


def test_pipeline_near_copies(spark):
    import corpus_pipeline

    rng = np.random.default_rng(3)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    put = lambda text, at, new: text[:at] + new + text[at + len(new) :]
    rows, groups = [], 0
    for i in range(40):
        text = words(60)  # 56 shingles; one other word leaves 51 of 61, two leave 46 of 66
        rows += [(100 + i, text), (200 + i, put(text, 20, ["x"])), (300 + i, put(put(text, 20, ["y"]), 40, ["y"]))]
        groups += 2
    chain = words(400)
    for i in range(60):  # a group whose ends are not alike themselves
        rows.append((1000 + i, put(chain, 6 * i, ["z"] * 6) if i else chain))
    rows += [(5000, words(30)), (5000, words(30)), (5001, ["a"]), (5002, ["A"]), (5003, []), (5004, [])]
    docs = spark.createDataFrame([(i, " ".join(t), "s") for i, t in rows], "doc_id long, text string, source string")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    kept = sorted(r.doc_id for r in out.collect())
    assert kept == sorted([*range(100, 140), *range(300, 340), 1000, 5000, 5000, 5001, 5003])
