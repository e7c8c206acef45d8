"""Quality field, language filters, page extraction, packing: edge cases, brute force, held-out accuracy, round trips."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import html_blocks, language, lines, packing, quality, style_tree
from tidewatch.llm.plans import tokenizer_path


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


# --- quality --------------------------------------------------------------------------------------------------------

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 1, 5, 2])
    good, links = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    got, z, pairs = quality._forward_backward(good, links, lengths, paired=True)
    want, at, total = [], 0, np.zeros((2, 2))
    for n in lengths:
        weight = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            weight[y] = np.exp(sum(good[at + k] for k in range(n) if y[k]) + sum(links[a, b] for a, b in itertools.pairwise(y)))
        whole = sum(weight.values())
        want += [sum(w for y, w in weight.items() if y[k]) / whole for k in range(n)]
        for a, b in itertools.product((0, 1), repeat=2):
            total[a, b] += sum(w * sum(p == (a, b) for p in itertools.pairwise(y)) for y, w in weight.items()) / whole
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, total)


def test_held_out_quality(spark, docs):
    field = quality.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    told = quality.score(docs, field).where(quality.held_out(F.col("doc_id"))).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    got = rows(told.select("predicted", "quality"))
    assert sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.97


def test_splices_use_every_stretch_once():
    stretches = [np.full((n, len(lines.OWN)), k, np.float32) for k, n in enumerate((3, 1, 5, 2, 4))]
    x, counts, told = quality.splice(stretches, np.array([1, 0, 1, 1, 0]))
    assert counts.sum() == 15 and len(counts) == 3
    assert np.bincount(x[:, 1].astype(int)).tolist() == [3, 1, 5, 2, 4]
    assert np.array_equal(told, np.array([1, 0, 1, 1, 0])[x[:, 1].astype(int)])
    assert quality.splice([], np.zeros(0, int))[0].shape == (0, lines.WIDTH)


def test_a_junk_block_is_seen_inside_a_good_text(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    field = quality.train(docs, labels)
    tried = rows(docs.where(quality.held_out(F.col("doc_id"))).join(labels, "doc_id").where("text IS NOT NULL").orderBy("doc_id").select("text", "quality"))
    good, bad = ([r["text"].split("\n") for r in tried if r["quality"] == k] for k in (1, 0))
    inside, around, alone = [], [], []
    for article, junk in zip(good, bad, strict=False):
        cut = len(article) // 2
        x, _, n = lines.line_features(["\n".join(article[:cut] + junk + article[cut:]), "\n".join(article)])
        p = field.marginals(x, n)
        inside.append(p[cut : cut + len(junk)].mean())
        around.append(np.concatenate([p[:cut], p[cut + len(junk) : n[0]]]).mean())
        alone.append(p[n[0] :].mean())
    assert len(inside) > 10 and np.mean(inside) < 0.35 and np.mean(around) > 0.65 and np.mean(alone) > 0.9


def test_long_documents_train_too(spark):
    """Every stretch of a long document counts; the only labelled documents here are longer than one stretch."""
    docs = spark.createDataFrame([(i, "\n".join((["Buy now!!! ### $$$ | x"] if i % 2 else ["A calm line of plain words."]) * 25)) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, quality int")
    told = rows(quality.score(docs, quality.train(docs, labels, stretch=10)))
    assert all(r["predicted"] == 1 - r["doc_id"] % 2 for r in told)


def test_quality_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(i, i % 2 if i != 4 else None, 0) for i in range(1, 13)] + [(None, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    field = quality.train(edge, labels)
    got = rows(quality.score(edge, field))
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert len({r["score"] for r in got if not r["text"]}) == 1
    unknown = quality.train(nothing, labels)
    assert {r["score"] for r in rows(quality.score(edge, unknown))} == {0.5}
    assert quality.score(nothing, field).count() == 0


def test_line_features_of_parts():
    x, size, n = lines.line_features(["a B!\n12 | #", "", "É é é."])
    assert n.tolist() == [2, 1, 1] and size.tolist() == [4, 6, 0, 6] and x.shape == (4, lines.WIDTH)
    one, _, _ = lines.line_features(["É é é."])
    assert np.allclose(x[3], one[0])


# --- language -------------------------------------------------------------------------------------------------------

def test_held_out_language(docs):
    told = language.identify(docs.select("doc_id", "text", "lang"), language.train(docs))
    got = rows(told.where(quality.held_out(F.col("doc_id"))).select("lang", "lang_pred"))
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98


def test_grams_equal_loops():
    texts = ["Ab c", "", "x1yz é", "12"]
    h, owner, lettered = language.grams(texts)
    assert lettered.tolist() == [True, False, True, False]

    def expect(t):
        s = " " + "".join(c if c.isalpha() else " " for c in t.lower()) + " "
        while "  " in s:
            s = s.replace("  ", " ")
        out = []
        for n in language.ORDERS:
            out += [s[i : i + n] for i in range(len(s) - n + 1) if " " not in s[i + 1 : i + n - 1] and s[i : i + n].strip()]
        return len(out)

    assert np.bincount(owner, minlength=4).tolist() == [expect(t) if any(map(str.isalpha, t)) else 0 for t in texts]


def test_filters_hold_all_members_and_correct_chance():
    rng = np.random.default_rng(5)
    members = [rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(70)]
    known = language.Filters.build([f"l{k:02}" for k in range(70)], members)
    owners = np.repeat(np.arange(2), 5000)
    count = known.counts(np.concatenate([members[3], members[69]]), owners, 2)
    assert count[0, 3] == 5000 and count[1, 69] == 5000
    strangers = known.counts(rng.integers(0, 2**63, 50000).astype(np.uint64), np.zeros(50000, np.int64), 1)
    assert strangers.max() < 1000


def test_language_edges(spark, edge, nothing):
    got = rows(language.identify(edge, language.train(edge, least=0.0)))
    assert len(got) == edge.count()
    for r in got:
        no_letter = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == no_letter and 0 <= r["score"] <= 1 and (r["score"] == 0 or not no_letter)
    assert {r["lang_pred"] for r in rows(language.identify(edge, language.train(nothing)))} == {"und"}
    assert language.identify(nothing, language.train(edge)).count() == 0


@pytest.mark.parametrize("text", ["\U0001f600\U0001f600", "\u2764\ufe0f", "\u0301", "\u0301 12 \U0001f1eb\U0001f1f7", "1\u20e3", "\u00b2 \u2160"])
def test_texts_without_a_letter_have_no_language(spark, docs, text):
    known = language.Filters.build(["en"], [language.grams(["the quick brown fox"])[0]])
    got = rows(language.identify(spark.createDataFrame([(1, text), (2, text + " \U00010400")], "doc_id long, text string"), known))
    # The second ends in a letter beyond the first plane.
    assert [(r["doc_id"], r["lang_pred"]) for r in got] == [(1, "und"), (2, "en")]


# --- pages ----------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header>site head</header><nav><ul><li><a href=x>menu</a></ul></nav><div class="cookie-notice">notice</div><div id="ad-1">buy</div>
<div class=wrap>site motto</div>
<article class="post has-sidebar"><h1>T &amp; %d</h1><p>one   %d<br>two <b>bold<p>next &lt;%d&gt; &eacute;<ul><li>a%d<li>b</ul><table><tr><td>c%d<td>d</table></article>
<form><input>sign</form><section class=comments><p>reader %d</p></section><aside>side</aside><footer>&copy; x</footer></body></html>"""


def page(i):
    return PAGE % ((i,) * 6)


def test_article_text(spark):
    pages = spark.createDataFrame([(i, f"https://h.example/{i}", page(i)) for i in range(60)], "page_id long, url string, html string")
    for r in rows(style_tree.extract(pages)):
        i = r["page_id"]
        assert r["text"] == f"T & {i}\none {i} two bold\nnext <{i}> é\na{i}\nb\nc{i}\nd", r["text"]
        assert r["n_chars"] == len(r["text"])


def test_importance_comes_from_the_site(spark):
    # No element or name tells: only that the motto stands on every page and the story on one.
    html = lambda i: f"<body><div><p>same motto</p></div><div><span>x</span><h2>story {i}</h2></div></body>"
    pages = spark.createDataFrame([(i, f"//u@H.example:80/{i}", html(i)) for i in range(200)], "page_id long, url string, html string")
    # The span's text is on every page too, so it goes as the motto does.
    assert {r["text"] for r in rows(style_tree.extract(pages))} == {f"story {i}" for i in range(200)}


@pytest.mark.parametrize("count", [1, 40])
@pytest.mark.parametrize("start", [
    "<html><head><title>T</title><body>", "<head><meta charset=utf-8><link rel=x><style>p{}</style>", "<html><head><title>T</title>", "<body><nav><a href=x>menu</a>",
    "<body><button>press", "<body><nav><ul><li>menu<li><button>press",
])
def test_end_tags_left_out_do_not_cost_the_page(spark, start, count):
    html = lambda i: f"{start}<article><h1>title {i}</h1><p>story {i}</article>"
    pages = spark.createDataFrame([(i, f"//h.example/{i}", html(i)) for i in range(count)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in rows(style_tree.extract(pages))} == {i: f"title {i}\nstory {i}" for i in range(count)}


def test_an_article_in_a_template_is_not_read(spark):
    html = "<body><template><article>draft</article></template><noscript><article>off</article></noscript><article>story</article>"
    assert rows(style_tree.extract(spark.createDataFrame([(1, None, html)], "page_id long, url string, html string")))[0]["text"] == "story"


def test_all_class_words_tell_elements_apart():
    found, _ = html_blocks.parse("<body><div class='one two three four five'>x</div><div class='one two three four six'>y</div>")
    assert len({path for path, _, _ in found}) == 2


def test_inline_children_do_not_cost_the_text(spark):
    # Lines parted by br, links, and bare text between blocks; on a host of one page and one of 200.
    parts = lambda i, gap: gap.join(f"line {i} {k}" for k in range(31))
    html = lambda i: f"<body><div class=a>{parts(i, '<br>')}</div><div class=b>{parts(i, ' <a href=x>link</a> ')}</div><div class=c>{parts(i, '<hr>')}</div><p>motto</p></body>"
    pages = spark.createDataFrame([(i, f"https://{'one' if i == 0 else 'many'}.example/{i}", html(i)) for i in range(201)], "page_id long, url string, html string")
    for r in rows(style_tree.extract(pages)):
        i = r["page_id"]
        want = [parts(i, " "), parts(i, " link "), parts(i, "\n")] + (["motto"] if i == 0 else [])
        assert r["text"] == "\n".join(want), r["text"]


def test_the_host_outvotes_priors(spark):
    # A notice in every article goes; what a name calls furniture stays where its texts all differ, and goes where they do not.
    html = lambda i: f"<body><article><p class=n>notice</p><p>story {i}</p></article><div class=promo>offer {i}</div><div class=ad>buy</div><p>{'end ' * 9}{i}</p></body>"
    pages = spark.createDataFrame([(i, f"//{'few' if i < 20 else 'many'}.example/{i}", html(i)) for i in range(320)], "page_id long, url string, html string")
    for r in rows(style_tree.extract(pages)):
        i = r["page_id"]
        offer = [] if i < 20 else [f"offer {i}"]
        assert r["text"].split("\n") == [f"story {i}", *offer, "end " * 9 + str(i)], r["text"]


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "elementor-widget-wrap", "widget Blog", "search-results"])
@pytest.mark.parametrize("count", [1, 50])
def test_wrappers_keep_the_page(spark, name, count):
    inner = ["<p>{0}</p><ul><li>item {0}</ul>", "<article><p>{0}</p></article><div class=comments>reader {0}</div>"]
    html = lambda i, k: f"<body><form><p class=t>title {i}</p><div class='{name}'>{inner[k].format('story ' * 20 + str(i))}</div></form></body>"
    pages = spark.createDataFrame([(k * 100 + i, f"//h{k}.example/{i}", html(i, k)) for i in range(count) for k in (0, 1)], "page_id long, url string, html string")
    for r in rows(style_tree.extract(pages)):
        assert f"{'story ' * 20}{r['page_id'] % 100}" in r["text"].split("\n"), r["text"]


def test_copies_of_a_page_count_once(spark):
    html = "<body><article><p>story</p></article><div>end</div></body>"
    pages = spark.createDataFrame([(i, f"//h.example/{i}", html) for i in range(100)], "page_id long, url string, html string")
    assert {r["text"] for r in rows(style_tree.extract(pages))} == {"story\nend"}


def test_page_edges(spark):
    data = [
        (1, None, None), (2, "x", ""), (3, "https://a.b/c", "plain &am &amp text"), (4, None, page(4)), (4, None, page(4)), (5, "https://a.b/d", "<p>open <b>x"),
        (6, "https://a.b/e", "<nav>only"), (None, "https://a.b/f", "</p></div>stray"), (7, "https://a.b/g", "<article>" + "<div><p>deep " * 3000 + "</article>"),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(1)).withColumn("host", F.lit("z"))
    got = rows(style_tree.extract(pages))
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 9 and text[1] == text[2] == text[6] == ""
    assert text[3] == "plain &am & text" and text[4].startswith("site motto\nT & 4\n") and text[5] == "open x" and text[None] == "stray"
    assert text[7].count("deep") == 3000
    assert style_tree.extract(pages.limit(0)).count() == 0


def test_parser_keeps_block_order():
    blocks, children = html_blocks.parse("<div>a<p>b</p>c</div>d")
    assert [t for _, _, t in blocks] == ["a", "b", "c", "d"] and children["/div"] == ["p"]


# --- packing --------------------------------------------------------------------------------------------------------

def test_pieces_equal_the_tokenizer(edge):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    placed = packing.pack(packing.pieces(edge, tokenizer_path()))
    got = rows(placed.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset", "extra", "score"))
    assert {r["score"] for r in got} == {-1} and all(r["extra"] == {"k": 1} for r in got)
    want = []
    for r in edge.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want += [(r.doc_id, k // 4096, k, ids[k : k + 4096]) for k in range(0, len(ids), 4096)]
    key = lambda x: sorted(x, key=repr)
    assert key([(r["doc_id"], r["piece"], r["start"], r["ids"]) for r in got]) == key(want)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) for r in got)
    check_places(got)


def check_places(got):
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
        assert filled[r["sequence_id"]] <= 4096
    return len(filled)


def test_packing_wastes_little(spark, docs, nothing):
    got = rows(packing.pack(packing.pieces(docs.select("doc_id", "text"), tokenizer_path(), with_ids=False)))
    assert check_places(got) <= 1.02 * sum(r["length"] for r in got) / 4096 + 1
    assert packing.pack(packing.pieces(nothing, tokenizer_path())).count() == 0


def test_assembled_sequences(docs):
    placed = packing.pack(packing.pieces(docs.limit(50), tokenizer_path()), group_rows=20)
    whole = {r["sequence_id"]: r["ids"] for r in rows(packing.sequences(placed))}
    for r in rows(placed):
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def sum_after(levels, capacity):
    """Sum of squared numbers of open sequences per fill."""
    return sum(c * c for c in np.bincount([v for v in levels if v < capacity]).tolist()) if levels else 0


def test_the_rule_is_sum_of_squares():
    """Every single step goes where the sum becomes smallest, over all open sequences and a new one."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 11, 30).tolist()
        place, offset = packing.sum_of_squares(np.array(lengths), 10)
        levels = {}
        for s, p, o in zip(lengths, place.tolist(), offset.tolist(), strict=True):
            assert levels.get(p, 0) == o and o + s <= 10
            options = [sum_after([*(v for k, v in levels.items() if k != q), levels.get(q, 0) + s], 10) for q in [*levels, "new"] if levels.get(q, 0) + s <= 10]
            levels[p] = o + s
            assert sum_after(list(levels.values()), 10) == min(options)
