"""Line quality, URL rules, main text, licences and the pipeline."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tenderloom.llm import licence_digest, line_quality, main_text, url_rules
from tenderloom.llm.queries import URL_RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules -------------------------------------------------------------------------------
def counts_by_hand(text):
    words = WORD.findall(text or "")
    triples = {}
    for i in range(len(words) - 2):
        triples.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeated = {p + d for at in triples.values() if len(at) > 1 for p in at for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


def test_counts_and_verdicts_of_lines(spark):
    rng = random.Random(1)
    few = "a b c ä \U0001F600 dd".split()
    prose = " ".join(rng.choices("one two three four five six seven eight nine ten eleven".split(), k=70)) + "."
    unique = " ".join(f"word{i}" for i in range(80)) + "."
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x\nx\n\nx y\n x", "A#*$%&|<>B <b>", prose, unique,
             "a a a a a", " ".join(rng.choices(few, k=400)), "\u00a0nbsp is\u00a0no space\u2003here",
             unique + "\n" + " | ".join(["home", "news", "about", "shop"]), unique[:60] + "\n" + "Buy$$$ now***\n" * 40,
             unique + "\nThis site uses cookies to count visits.", "\n".join([unique] * 3), "word " * 70000]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, kept string, _w string")
    got = {r["doc_id"]: r for r in line_quality.judge_lines(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts_by_hand(t), i
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    assert got[10]["kept"] and got[10]["clean_text"] == unique
    assert got[14]["kept"] and got[14]["n_removed_lines"] == 1 and got[14]["clean_text"] == unique
    assert got[16]["kept"] and got[16]["clean_text"] == unique
    assert not got[15]["kept"] and got[15]["n_removed_lines"] == 40
    assert not any(got[i]["kept"] for i in (0, 1, 2, 3, 17, 18))
    assert line_quality.judge_lines(docs.limit(0)).count() == 0


def test_deceptive_hash_prefixes_are_seen_through(spark, monkeypatch):
    """With the high bits of every hash equal, the words decide."""
    text = "a b c d a b c e a b d"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    frame = line_quality.judge_lines(docs)
    assert frame.first()["n_repeat_words"] == counts_by_hand(text)[4]
    from pyspark.sql import DataFrame
    select = DataFrame.selectExpr
    monkeypatch.setattr(DataFrame, "selectExpr", lambda self, *e: select(self, *[
        x.replace("xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))", "xxhash64(1)") for x in e]))
    assert line_quality.judge_lines(docs).first()["n_repeat_words"] == counts_by_hand(text)[4]


# --- URLs ----------------------------------------------------------------------------------------
PAGES = [
    ("https://A.Example.org/en/7?x#y", ""), ("http://a.example.org/en/15", ""), ("https://example.org/es/1", None), ("https://notexample.org/es/1", ""),
    ("http://b.com/de/1", '<link href="https://alias.net/page" rel="canonical">'), ("https://alias.net/page/?utm_source=x", ""),
    ("http://third.net/p", "<META HTTP-EQUIV=refresh content='0; url=//alias.net/page'>"), ("http://b.com/fr/1", "<link rel='canonical' href='/de/2'>"),
    ("http://fourth.net/q", '<link rel=canonical href="http://b.com/fr/9">'), ("http://fifth.net/r", '<link rel="canonical" href="http://b.com/de/9">'),
    ("http://sixth.net/s", '<link rel="canonical" href="http://fourth.net/q">'), ("http://sixth.net/t", '<link rel="canonical" href="http://b.com/de/1">'),
    ("no scheme here", '<link rel="canonical" href="http://b.com/de/1">'), (None, "x"), ("", ""), ("http://", ""), ("a://b://c/d", ""),
    ("http://com/de/", ""), ("http://xcom/de/", ""), ("http://b.com", ""), ("http://b.com/de", ""),
]


def test_rules_hosts_and_aliases(spark):
    pages = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(PAGES)] + [(5, PAGES[5][0], "", "clash")],
                                  "page_id long, url string, html string, rule string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    rows = url_rules.judge_urls(pages.drop("html"), rules, url_rules.page_links(pages)).collect()
    assert len(rows) == len(PAGES) + 1
    got = {r["page_id"]: r for r in rows}
    for i, (url, _) in enumerate(PAGES):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fitting = [(len(h + p), v == "allow", h + p, v) for h, p, v in URL_RULES
                   if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, max(fitting)[2] if fitting else None), i
        if fitting:
            assert got[i]["verdict"] == max(fitting)[3]
    blocked = {i for i in got if got[i]["rule"] is None and got[i]["verdict"] == "block"}
    # aliases of b.com/de/1; the block of b.com/de/2 meets an allowed alias; fifth.net leads to a blocked page
    assert blocked == {5, 6, 9, 11}
    assert got[7]["verdict"] == "allow"
    empty = url_rules.judge_urls(pages.drop("html").limit(0), rules, url_rules.page_links(pages.limit(0)))
    assert empty.count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(pages.drop("html"), rules.limit(0), url_rules.page_links(pages)).collect()} == {"allow"}


# --- main text -----------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>";</script></head><body>
<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/b">B</a></ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice"><p>We use cookies on this site to make it better for everyone who visits it often.</p></div>
<main><article><h2>Title &amp; more</h2><p>First para with a <a href=x title="a > b">link</a> in&nbsp;it.<p>To.</p><div class="ad">Buy now</div>
<p>Third   para<br>continues <b>un<i>closed</p><form>Name <input> <select><option>x</select></form></article>
<section id="comments"><p>Great article, I liked it very much and will read it again tomorrow morning.</p></section></main>
<aside>Side stuff text long enough to be counted as text of the article by words only.</aside><footer>&copy; x</footer>"""


def test_main_text_of_pages(spark):
    pages = [(1, PAGE), (2, None), (3, ""), (4, "<nav><a href=x>only a menu</a></nav>"), (5, "<article><p>Short.</article><footer>no"),
             (6, "<article><p>Whole " + "text " * 40000 + "</p></article>"), (7, "<article><p>Cut <b>off"), (8, "<script>never closed <p>x</p>"),
             (9, "<div><p>" + "Plain page without any article element but with long sentences in it. " * 3 + "</p></div>"), (1, PAGE)]
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in pages], "page_id long, url string, html string, text string")
    rows = main_text.extract_text(df).collect()
    assert len(rows) == len(pages)
    got = {r["page_id"]: r["text"] for r in rows}
    assert got[1] == "Title & more\nFirst para with a link in it.\nTo.\nThird para continues unclosed"
    assert got[2] == got[3] == got[4] == got[8] == ""
    assert got[5] == "Short." and got[7] == "Cut off" and len(got[6].split()) == 40001 and got[9].startswith("Plain page")
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert main_text.extract_text(df.limit(0)).count() == 0


def test_links_around_blocks_and_names_that_only_look_like_furniture():
    tree = main_text.train()
    first, second = (" ".join(f"{w}{i}" for i in range(14)) for w in ("alpha", "beta"))
    box = f'<article><p>{first}</p><a href="/x"><div>Read more</div></a><p>{second}</p></article>'
    assert main_text.extract(box, tree) == f"{first}\n{second}"
    # a link that is never closed ends with its paragraph
    assert main_text.extract(f'<article><p>{first} <a name="top">x</p><p>{second}</p></article>', tree) == f"{first} x\n{second}"
    named = f'<main><p>{first}</p><div class="side-effects"><p>{second}</p></div><div class="side">{first}</div></main>'
    assert main_text.extract(named, tree) == f"{first}\n{second}"


def test_tree_fits_its_table_and_long_tags_are_read_in_time():
    rows = np.array(main_text.LABELLED, float)
    assert (main_text.decide(main_text.train(), rows[:, :-1]) == rows[:, -1]).mean() > 0.95
    assert main_text.blocks_of("<p " + '"' * 20001 + "<" * 20000) is not None
    flat = main_text.blocks_of("<p>a<td>b</table>c<li>d<li>e")
    assert [b.text for b in flat] == ["a", "b", "c", "d", "e"]


# --- licences ------------------------------------------------------------------------------------
def test_licences_are_whole_texts_or_lines(spark):
    mit = dict((name, text) for name, text in licence_digest.KNOWN if len(text) > 800)["MIT"]
    texts = [mit, "Copyright (c) 2020 A. Person\n" + mit.upper().replace(" ", "\n  "), mit.replace("LICENSE", "LICENCE").replace(".", " !"),
             mit + " and more", "Prose.\nReleased under the MIT Licence!\nProse.", "Released under the MIT License.", "released under MIT",
             "Text. Licensed under CC BY-NC 4.0. Text.", None, "", "Copyright (c) 2020", "Licensed under CC BY-NC 4.0.\n" * 2]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, line string")
    got = sorted((r["doc_id"], r["line"], r["license"]) for r in licence_digest.scan_licences(docs).collect())
    assert got == [(0, 0, "MIT"), (1, 0, "MIT"), (2, 0, "MIT"), (4, 2, "MIT"), (5, 0, "MIT"), (11, 1, "CC-BY-NC-4.0"), (11, 2, "CC-BY-NC-4.0")]
    assert licence_digest.scan_licences(docs.limit(0)).count() == 0


# --- the pipeline --------------------------------------------------------------------------------
@pytest.fixture
def corpus(tmp_path):
    rng = random.Random(8)
    prose = lambda n: [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(400)}" for _ in range(n)]
    item = prose(14)
    passage = prose(60)
    original = prose(48)
    rows = []
    for i in range(80):
        rows.append((i, " ".join(prose(rng.randint(30, 90)))))
    rows += [(100 + i, " ".join(w + "***" for w in prose(60))) for i in range(30)]
    rows += [(200, " ".join(prose(20) + passage + prose(20))), (201, " ".join(prose(10) + passage + prose(30)))]
    rows += [(300, " ".join(original)), (301, " ".join(original[:47] + ["changed"])), (302, " ".join(original))]
    rows += [(400, " ".join(prose(30) + item + prose(5))), (500, None), (501, ""), (502, "two words"), (None, " ".join(prose(70)))]
    n = len(rows)
    pq.write_table(pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "lang": ["en"] * n,
                             "source": ["s"] * n, "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64()),
                             "extra": ["x"] * n}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([*range(60), *range(100, 125)], pa.int64()), "quality": pa.array([1] * 60 + [0] * 25, pa.int32()),
                             "toxic": pa.array([0] * 85, pa.int32())}), tmp_path / "labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([7], pa.int64()), "text": [" ".join(item)]}), tmp_path / "benchmark.parquet")
    return str(tmp_path), item, passage


def test_pipeline_stages_decide(spark, corpus):
    sf_dir, item, passage = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        seen[name] = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = {name: [r["doc_id"] for r in rows] for name, rows in seen.items()}
    clean = set(range(80)) | {None}
    assert clean <= set(ids["quality classifier"]) and not set(range(100, 130)) & set(ids["quality classifier"])
    after = {r["doc_id"]: r["text"] for r in seen["line dedup"]}
    assert " ".join(passage) in after[200] and " ".join(passage) not in after[201] and len(after[201].split()) == 40
    similar = set(ids["n-gram Jaccard join"])
    assert 300 in similar and not {301, 302} & similar and clean <= similar
    final = {r["doc_id"]: r for r in seen["benchmark decontamination"]}
    assert " ".join(item) not in final[400]["text"] and final[400]["n_chars"] == len(final[400]["text"])
    assert clean <= set(final)
    packed = seen["best-fit packing"]
    assert sorted(map(str, {r["doc_id"] for r in packed})) == sorted(map(str, final))
    assert corpus_pipeline.run(spark, sf_dir).count() == len(packed)


def test_one_of_each_group_stays_and_rows_without_words_do(spark):
    rng = random.Random(6)
    prose = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    nameless, twice, plain = prose(60), prose(60), prose(60)
    rows = [(None, " ".join(nameless + [w])) for w in ("x", "y", "z")]
    rows += [(5, " ".join(twice)), (5, " ".join(twice + ["x"])), (6, " ".join(twice + ["y"]))]
    rows += [(None, " ".join(plain)), (8, " ".join(plain + ["x"])), (9, " ".join(plain)), (9, " ".join(plain))]
    empty = [(None, None, "en"), (None, None, "de"), (None, "", "en"), (None, "", "de"), (7, " \n", "en"), (7, " \n", "de")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows] + [(i, t, lang, "s", 0) for i, t, lang in empty],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"], r["lang"]) for r in corpus_pipeline.one_of_similar(spark, docs, "").collect()]
    assert sorted((g for g in got if not (g[1] or "").strip()), key=repr) == sorted(empty, key=repr)
    assert sorted((g[0] for g in got if (g[1] or "").strip()), key=repr) == [5, 8, None]


def test_pipeline_of_an_empty_table(spark, corpus):
    sf_dir, *_ = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
