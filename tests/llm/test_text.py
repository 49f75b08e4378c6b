"""Page, license, toxicity and language operators: plain versions, planted cases, edge cases."""

import re
import zlib

import numpy as np
import pytest

from oslogs.llm import dom, language_id, licenses, toxicity, wrapper

ODD = [None, "", "  \n", "123 !?", "x" * 200_000, "Ünïcode ß 日本", "a\u0000b"]


def page(title, body, aside="Menu A"):
    return (f"<html><head><title>{title}</title><script>var a='<p>no</p>'</script></head><body><nav><a href=/x>{aside}</a></nav>"
            f"<div class='ad'>Buy</div><article><h1>{title}</h1>{body}</article><aside>more</aside><footer>&copy; us</footer></body></html>")


def soup(k):
    return (f"<div id=top>My Site</div><div class=box><h1>T{k}</h1><div class=m>posted in News</div><div class=t>para {k} one<br>x &amp; y</div>"
            f"<div class=t>two {k * 7}</div></div><div class=z>Copyright</div>")


def test_main_text(spark):
    rows = [(1, "http://a.example/1", page("T", "<p>One  <b>b</b>old &amp; &lt;x&gt;<br>y<p>Two<div class=comments><p>no</p></div>")),
            (2, "http://a.example/2", page("U", "<p>Three</p>")), (2, "http://a.example/2", page("U", "<p>Three</p>")),
            (3, None, page("V", "<p>Four")), (4, "http://b.example/", ""), (5, "not a url", None), (6, "http://a.example/6", "plain <text"), (None, "http://a.example/7", page("W", ""))]
    rows += [(100 + k, f"http://soup.example/{k}", soup(k)) for k in range(6)]
    rows += [(200 + k, "http://copies.example/", page("Same", "<p>All the same")) for k in range(5)]
    rows += [(300, "http://deep.example/", "<div>" * 3000 + "deep"), (301, "http://wide.example/", "".join(f"<h2>h{i}</h2><p>p{i}</p>" for i in range(300)))]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = {r.page_id: r.text for r in wrapper.main_text(df).collect()}
    assert wrapper.main_text(df).count() == len(rows)
    assert got[1] == "T\n\nOne bold & <x> y\n\nTwo" and got[2] == "U\n\nThree" and got[3] == "V\n\nFour" and got[None] == "W"
    assert got[4] == got[5] == "" and got[6] == "plain" and got[300] == "deep"
    assert [got[100 + k] for k in range(6)] == [f"T{k}\n\npara {k} one x & y\n\ntwo {k * 7}" for k in range(6)]  # constant nodes are template
    assert {got[200 + k] for k in range(5)} == {"Same\n\nAll the same"}  # an article is no template for being copied
    assert got[301].startswith("h0\n\np0\n\nh1") and got[301].count("\n\n") == 599
    assert wrapper.main_text(df.limit(0)).count() == 0


def alone(text):
    return wrapper.Wrapper(wrapper.tree_of([dom.parse(text)])).text(dom.parse(text))


def test_deep_pages_keep_their_article():
    for n in (120, 30_000):
        assert alone("<div id=page><article><p>head</p>" + "<div>" * n + "</div>" * n + "<p>tail</p></article></div>") == "head\n\ntail"
        assert alone("<article><p>a</p>" + "<div>" * n + "<nav>no</nav><p>b</p>" + "</div>" * n + "c</article>") == "a\n\nb\n\nc"
        assert alone("<font>" * n + "<article><p>in</p><form>no</form></article>out") == "in"
        assert alone("<div>" * n + "<article>x</article>y") == "x"
    a, b = ([dom.parse("<div>" * 30_000 + x)] for x in ("<p>1", "<h1>t</h1><p>2"))
    merged = wrapper.merge(wrapper.tree_of(a), wrapper.tree_of(b))
    assert merged.pages == 2 and wrapper.wrapper(wrapper.json.dumps(merged.dump())).tree.shape() == merged.shape()


def test_long_quoted_attributes():
    state = "{hidden class=ad >" + "x" * 50_000 + "}"
    page = f"<div>top</div><article data-state=\"{state}\"><p title='{state}'>in</p></article>out"
    assert alone(page) == "in" and not dom.parse(page).children[1].words


@pytest.mark.parametrize("role", ["has-sidebar", "no-comments", "search-enabled", "content share-on", "has-header", "content search", "menu", "x banner"])
def test_a_class_of_its_wrapper_loses_no_article(role):
    def made(body, k):
        return f"<div class=ad>Buy {k}</div><div id=page class='{role}'>{body}</div><div class=related>see {k}</div>"

    named = [made(f"<article><h1>T{k}</h1><p>some longer text {k}</p><div class=share>no {k}</div></article>", k) for k in range(4)]
    within = [f"<article class='no-comments'><h1>T{k}</h1><div class='{role}'><p>some longer text {k}</p></div></article>" for k in range(4)]
    main = [f"<main><p>x{k}</p>" + made(f"<article><h1>T{k}</h1><p>some longer text {k}</p></article>", k) + "</main>" for k in range(4)]
    bare = [made(f"<h1>T{k}</h1><p>some longer text {k}</p><p>and more {k}</p>", k) for k in range(4)]
    inline = [f"<font class='{role}'><h1>T{k}</h1><p>some longer text {k}</p></font>" for k in range(4)]
    for pages in (named, within, main, bare, inline):
        whole = None
        for text in pages:
            tree = wrapper.tree_of([dom.parse(text)])
            whole = tree if whole is None else wrapper.merge(whole, tree)
        for found in ([alone(x) for x in pages], list(map(wrapper.Wrapper(whole).text, map(dom.parse, pages)))):
            wanted = [f"T{k}\n\nsome longer text {k}" + f"\n\nand more {k}" * (pages is bare) for k in range(4)]
            assert found == wanted


def test_trees_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "MERGED", 2)
    df = spark.createDataFrame([(k, "http://soup.example/x", soup(k)) for k in range(40)], "page_id long, url string, html string").repartition(11)
    tree = wrapper.induce(df).collect()
    assert len(tree) == 1 and wrapper.wrapper(tree[0].tree).tree.pages == 40


def test_simple_tree_matching():
    a, b = (wrapper.tree_of([dom.parse(x)]) for x in ("<div><h1>a</h1><p>x</p><ul><li>1</li></ul></div>", "<div><p>y</p><table></table><ul><li>2</li></ul></div>"))
    assert wrapper._score(a, b) == 5  # root, div, p, ul, li
    merged = wrapper.merge(a, b)
    assert [c.label for c in merged.children[0].children] == ["h1", "p", "table", "ul"] and merged.children[0].children[1].sum == 0


def test_given_pages(spark, sf_dir):
    """Every page of the given tables has one article; its blocks are its headings and paragraphs."""
    import html
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in wrapper.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def plain_base(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}), ("GNU Lesser General Public License v2.1 or later", {"lgpl-2.1-or-later"}),
    ("CC BY-SA 4.0; MIT License", {"cc-by", "cc-by-sa-4.0", "mit"}), ("SPDX-License-Identifier: GPL-3.0-only", {"gpl-3.0-only"}),
    ("The BSD 3-Clause License", {"bsd-3-clause"}), ("https://creativecommons.org/licenses/by-nc/3.0/", {"cc-by-nc-3.0"}), ("GNU General Public License version 3", {"gpl", "gpl-3.0"}),
    ("limited mitigation of emitting ccs by name", set()), ("Mozilla Public License 2.0", {"mpl-2.0"}), ("cc by cc by", {"cc-by"}),
])
def test_license_rules(text, labels):
    _, base, found = licenses.scanner().scan(text)
    assert {x for _, x in base} | {d.label for d in found} == labels


def strings(parsed):
    """Strings that a parsed pattern matches: every branch, options with and without, the first sign of a set of ranges."""
    out = [""]
    for op, value in parsed:
        kind = str(op)
        if kind == "LITERAL":
            more = [chr(value)]
        elif kind == "ANY":
            more = ["x"]
        elif kind == "IN":
            more = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
        elif kind == "BRANCH":
            more = [x for branch in value[1] for x in strings(branch)]
        elif kind == "SUBPATTERN":
            more = strings(value[3])
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            more = [x * n for n in sorted({value[0], max(value[0], 1)}) for x in strings(value[2])]
        else:
            assert kind == "ASSERT_NOT", kind
            more = [""]
        out = [a + b for a in out for b in dict.fromkeys(more)]
    return out


def test_every_rule_has_its_keyword_in_what_it_matches():
    for rule in licenses.rules():
        made = strings(re._parser.parse(rule.pattern.pattern))
        assert made and all(rule.pattern.fullmatch(x) for x in made), rule
        assert all(any(k in x for k in rule.keyword.split("|")) for x in made), rule


@pytest.mark.parametrize(("text", "label"), [("Apache 2.0", "apache-2.0"), ("Apache v2", "apache-2.0"), ("Apache-1.1", "apache-1.1"), ("ASL 2.0", "apache-2.0")])
def test_short_forms_need_no_other_text(text, label):
    assert [d.label for d in licenses.scanner().scan(text)[2]] == [label]


def test_no_detection_lies_within_another():
    found = licenses.scanner().scan("GNU General Public License version 2 or later, and GPL-2.0, gnu general public license")[2]
    spans = [(d.first, d.last) for d in found]
    assert [d.label for d in found] == ["gpl-2.0-or-later", "gpl-2.0", "gpl"]
    assert not any(a != b and a[0] >= b[0] and a[1] <= b[1] for a in spans for b in spans)
    assert len(licenses.rules()) > 300


def test_license_summary(spark, sf_dir):
    texts = [*ODD, "CC BY cc by, Cc-By", "the MIT license. É MIT LICENSE"]
    df = spark.createDataFrame([(i, t, "l") for i, t in enumerate(texts)] + [(0, "cc by", "l")], "doc_id long, text string, labels string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for rows in (df, docs):
        source, got = rows.collect(), licenses.license_summary(rows).collect()
        assert len(source) == len(got)
        for s, r in zip(source, got):
            n, places = plain_base(s.text)
            at = [i for i, _ in places]
            assert (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word) == (s.doc_id, n, len(at), min(at, default=None), max(at, default=None))
            assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.license_summary(df.limit(0)).count() == licenses.detections(df.limit(0)).count() == 0
    assert {r.label for r in licenses.detections(df).collect()} >= {"mit", "cc-by"}


def labelled_rows(n=900):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abdegiklmnorstu"), rng.integers(2, 8))) for _ in range(800)]
    out = []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(20, 120)))
        toxic = i % 6 == 0
        if toxic:
            for at in rng.integers(0, len(text), 1 + len(text) // 25):
                text[at] = str(rng.choice(["wretched", "dunderhead", "nincompoop"]))
        out.append((i, " ".join(text), int(toxic)))
    return out


def test_toxicity(spark):
    rows = labelled_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic")
    model = toxicity.fit(toxicity.labelled(df.drop("toxic"), labels))
    got = {r.doc_id: r for r in toxicity.scores(df.withColumnRenamed("toxic", "score"), model).collect()}
    held = [(r[0], r[2]) for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean([got[i].predicted == t for i, t in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    base = " ".join(labelled_rows(2)[1][1].split()[:12])
    odd = spark.createDataFrame([(i, t) for i, t in enumerate([base + " dunderheads", base, *ODD, base])], "doc_id long, text string")
    score = [r.score for r in toxicity.scores(odd, model).collect()]
    assert score[0] > 5 * score[1] and score[1] == score[-1]  # a form that no row has
    assert score[2] == score[3] == score[4] == score[5] < 0.5
    assert [r.doc_id for r in toxicity.clean(odd, model).collect()] == [r.doc_id for r in odd.collect() if score[r.doc_id] < 0.5]
    # the held-out fold is never learned from
    assert toxicity.labelled(df.drop("toxic"), labels).where("doc_id in (" + ",".join(str(i) for i, _ in held) + ")").count() == 0


def test_toxicity_of_no_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled(df, none))
    assert [r.predicted for r in toxicity.scores(df, model).collect()] == [0, 0] and toxicity.scores(df.limit(0), model).count() == 0
    only = toxicity.fit(df.selectExpr("doc_id", "text", "0 as toxic"))
    assert all(r.score < 0.1 for r in toxicity.scores(df, only).collect())


def test_long_texts_score_like_their_parts():
    model = {"slots": np.random.default_rng(0).normal(size=toxicity.BUCKETS).astype(np.float32), "bias": 0.1}
    text = " ".join(labelled_rows(30)[i][1] for i in range(30))
    whole = list(toxicity.Scorer(model)([text * 40]))[0]
    words = [w for w in re.findall(r"[^\W\d_]+", text)]
    total = [toxicity.features(w) for w in words]
    plain = np.mean([model["slots"][s] @ w for s, w in total]) + 0.1
    assert abs(whole - 1 / (1 + np.exp(-plain))) < 1e-3


def test_gradients_of_the_network():
    net = language_id.Network(["a", "b", "c"])
    rng = np.random.default_rng(0)
    for k in net.p:
        net.p[k] = net.p[k].astype(float)
    rows, real, truth = rng.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8), np.array([96, 50, 3, 96, 80]), np.array([0, 1, 2, 1, 0])

    def loss():
        labels = net._labels(net._run(rows)[0])
        return -sum(np.log(labels[t, i, truth[i]]) for i in range(5) for t in range(real[i])) / real.sum()

    for k, g in net.gradients(rows, real, truth).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        value = net.p[k][at]
        net.p[k][at] = value + 0.01
        up = loss()
        net.p[k][at] = value - 0.01
        slope = (up - loss()) / 0.02
        net.p[k][at] = value
        assert abs(slope - g[at]) < 1e-3 + 0.05 * abs(slope)


def test_language(spark):
    rng = np.random.default_rng(3)
    parts = {"aa": "the ing and tion of er", "bb": "der sch ung ein ich keit", "cc": "ção não que os ado inho"}
    rows = [(i, " ".join("".join(rng.choice(parts[lang].split(), 2)) for _ in range(rng.integers(8, 60))), lang)
            for i, lang in enumerate(rng.choice(list(parts), 700))]
    df = spark.createDataFrame(rows + [(900, "x y", None), (901, None, "aa")], "doc_id long, text string, lang string")
    train = df.where("crc32(cast(doc_id as string)) % 4 != 2")
    net = language_id.fit(train)
    assert net.languages == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language_id.languages(df.withColumnRenamed("lang", "score"), net).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 100 and np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.97
    odd = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, rows[0][1] * 3000])], "doc_id long, text string")
    found = [(r.lang_pred, r.score) for r in language_id.languages(odd, net).collect()]
    assert found[:4] == [("und", 0.0)] * 4 and found[-1][0] == rows[0][2] and all(0 <= s <= 1 for _, s in found)
    assert 4 <= language_id.recognised(odd, net).count() + 4 <= 8
    empty = language_id.fit(df.limit(0))
    assert [r.lang_pred for r in language_id.languages(odd, empty).collect()] == ["und"] * 8 and language_id.recognised(odd, empty).count() == 8
