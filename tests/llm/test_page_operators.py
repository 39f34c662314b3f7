"""Page and vector operators on small tables, and the pipeline on a whole one."""

import hashlib
import html
import os
import re
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from pixelframe.llm import html_text, queries, urls, vectors, warc
from pixelframe.storage import scratch_path, shared_dir

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
PAGES = "page_id long, url string, html string, shard string"


def test_warc(spark):
    big, other = "é" * 600, "x" * 2000
    rows = [(i, f"http://h/{i}", big, "s") for i in (3, 1, 2)] + [(4, None, None, "s"), (5, "http://h/a b", "", "s")]
    rows += [(6, "u", "small", "s"), (7, "u", "small", "s"), (8, "u", other, "s"), (8, "u", other, "s"), (None, "u", other, "s")]
    rows += [(10 + i, "http://p", f"page {i} " * 300, "s") for i in range(20)]
    pages = spark.createDataFrame(rows, PAGES)
    folder = scratch_path(spark, "test-archives")
    manifest = warc.write_archives(pages, folder, roll_bytes=700)
    files = manifest.collect()
    assert len(files) > 3 and sum(f.records for f in files) == len(rows)
    got = warc.read_archives(manifest, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        body = next((h or "").encode() for i, _, h, _ in rows if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert r.payload == (body if r.record_type == "response" else None)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got if (r.page_id or 0) < 10)
    assert kinds == [
        (0, "revisit", 8), (1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (4, "response", None),
        (5, "response", None), (6, "response", None), (7, "response", None), (8, "response", None), (8, "revisit", 8),
    ]
    second = scratch_path(spark, "test-archives")
    again = warc.write_archives(pages.repartition(3), second, roll_bytes=700).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, files))
    nothing = scratch_path(spark, "test-archives")
    assert warc.read_archives(warc.write_archives(pages.limit(0), nothing), nothing).count() == 0


def test_cut_archive_raises():
    import io
    import zlib

    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = packer.compress(b"WARC/1.1\r\n\r\n") + packer.flush()
    assert list(warc.members(io.BytesIO(whole * 3))) == [b"WARC/1.1\r\n\r\n"] * 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(whole + whole[:-9])))


def test_html_pieces():
    tree = html_text.trained_tree()
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav>
      <div class="cookie-notice"><p>We use cookies on this site for very many long reasons that nobody reads at all</p></div>
      <article><h1>Title</h1><p>One &amp; two\n  three<br>four <b>five</b><p>Six<script>no()</script></p>
      <div class="ad">Buy this now</div><aside>Side</aside>
      <section class="comments"><p>A reader says a lot of things here and there and everywhere</p></section></article>
      <form><input><p>Your mail</p></form><footer>&copy; all</footer></body></html>"""
    assert html_text.main_text(page, tree) == "Title\n\nOne & two three four five\n\nSix"
    plain = "<body><div id=menu><a href=1>a</a> <a href=2>b</a></div><div>" + "<p>" + "word " * 40 + "</p>" * 2 + "</div><div>x</div>"
    assert html_text.main_text(plain, tree) == ("word " * 40).strip()
    for odd in ("", "<", "<p", "<!-- open", "<script>x", "a < b", "<p class='x", "&#x41;&bogus;"):
        html_text.main_text(odd, tree)
    assert html_text.blocks_of("<p>&#x41;&amp")[0].text == "A&"


def test_html_unseen():
    tree = html_text.trained_tree()
    story = "Some words of the story stand here. " * 4
    for tag in (
        "<svg-icon></svg-icon>", "<video-player>", "<button-group>x</button-group>", "<title-bar/>", "<svg width=5 />", "<svg/>",
        "<button>", "<video src='a>b'>", "<svg viewBox='0 0 1 1'><path d='M0'/></svg >", "<iframe src=x />", "<SVG/>",
    ):
        for rest in ("", "<p>Last</p>"):
            got = html_text.main_text(f"<article><p>First</p>{tag}<p>{story}</p>{rest}</article>", tree)
            assert story.strip() in got and got.startswith("First") and got.endswith("Last" if rest else "here."), tag
    later = f"<article><svg-icon></svg-icon><svg/><p>{story}</p><svg><text>no</text></svg><p>{story}</p></article>"
    assert html_text.main_text(later, tree) == "\n\n".join([story.strip()] * 2)
    for open_tag in ("<script>", "<style>", "<title>", "<script src='/a/'/>"):
        assert html_text.main_text(f"<article><p>First</p>{open_tag}<p>{story}", tree) == "First"
    formula = "<math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x=2</annotation></semantics></math>"
    assert html_text.main_text(f"<article><p>So {formula} holds.</p></article>", tree) == "So x=2 holds."


def test_html_wrappers():
    """What wraps the only article does not mark it; marks in it, and around other articles, do."""
    tree = html_text.trained_tree()
    story = ("word " * 30).strip()
    inner = f"<h1>Title</h1><p>{story}</p><div class=ad>Buy this now</div><p>{story}</p>"
    inner += f"<section class=comments><article><p>reader {story}</p></article></section>"
    beside = f"<aside><article><p>teaser {story}</p></article></aside><div class=sidebar><article><p>more {story}</p></article></div>"
    want = f"Title\n\n{story}\n\n{story}"
    for before, after in (
        ("", ""), ('<div class="layout has-sidebar">', "</div>"), ("<form id=aspnetForm><fieldset>", "</fieldset></form>"),
        ("<main><div class=has-sidebar>", "</div></main>"), ("<form><div class='page with-sidebar'><main>", "</main></div></form>"),
    ):
        for own in ("article", "main", "div class=article-body"):
            page = f"<body>{before}<nav><p>Menu of {story}</p></nav><{own}>{inner}</{own.split()[0]}>{beside}{after}</body>"
            assert html_text.main_text(page, tree) == want, (before, own)
    unmarked = f"<main><h1>Title</h1><p>{story}</p><section class=comments><article><p>reader {story}</p></article></section></main>"
    assert html_text.main_text(unmarked, tree) == f"Title\n\n{story}"


def test_html_table(spark):
    rows = [(1, "u", None, "s"), (2, None, "", "s"), (3, "u", "<article><p>é one</p></article>", "s")] * 2
    got = html_text.extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0)] * 2 + [(2, "", 0)] * 2 + [(3, "é one", 5)] * 2


def test_html_pages(spark):
    """Every generated page: the article's blocks, by a plain split of its markup."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.QUERIES["op5_html_text"](spark, SF_DIR).collect():
        article = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id])[1]
        pieces = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(p for p in pieces if p) and r.n_chars == len(r.text)


def test_urls(spark):
    rows = [
        ("http://a.example.com/en/1", "block", "example.com/en/"), ("http://www.example.com/en/1", "allow", "www.example.com/en/"),
        ("https://x.COM/", "allow", "com/"), ("http://x.com", "allow", None), ("http://s.net/fr/a?b", "block", "net/fr/"),
        ("http://freebets.org/x", "block", None), ("http://my-casino-win.org/", "block", None), ("http://planet.org/wiki", "allow", None),
        (None, "allow", None), ("no scheme", "allow", None), ("http://", "allow", None), ("http://notexample.com/en/", "allow", "com/"),
    ]
    pages = spark.createDataFrame([(i, u, None, "s") for i, (u, *_) in enumerate(rows)] * 2, PAGES)
    got = urls.judge(pages).collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        assert (r.verdict, r.rule) == rows[r.page_id][1:], (rows[r.page_id], r)
    parts = {r.page_id: (r.host, r.path) for r in got}
    assert parts[2] == ("x.com", "/") and parts[3] == ("x.com", "") and parts[8] == parts[9] == ("", "")
    assert urls.judge(pages.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    rows += [(300 + i, rows[0][1]) for i in range(9)]
    odd = [(400, None), (450, [0.0] * 8), (500, [None] + [1.0] * 7), (550, [float("nan")] * 8), (600, [1.0] * 3), (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, score int")
    got = vectors.neighbours(table, "vec_id % 50 = 0").collect()
    x = np.array([v for _, v in rows], np.float32).astype(float)
    norm = np.sqrt((x * x).sum(axis=1))
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    assert {q for q, _ in found} == {0, 50, 100, 150, 200, 250, 300}
    hits = 0
    for q in {q for q, _ in found}:
        score = (x * x[q]).sum(axis=1) / (norm * norm[q])
        best = [j for j in np.lexsort((np.arange(len(x)), -score)) if j != q][:5]
        hits += sum(found[(q, k + 1)][0] == j for k, j in enumerate(best))
        assert all(abs(found[(q, k + 1)][1] - score[found[(q, k + 1)][0]]) < 1e-12 for k in range(5))
    assert hits >= 0.9 * 35
    few = vectors.neighbours(table.where("vec_id in (0, 1, 2)"), "vec_id = 0").collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert vectors.neighbours(table.limit(0), "vec_id = 0").count() == 0


@pytest.mark.parametrize("copies", [2, 5, 600])
def test_repeated_vectors(spark, copies):
    """Repeats of a near row take one place; of rows with one id the best counts."""
    x = np.random.default_rng(5).normal(size=(200, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1, (x[0] + 0.01).tolist())] * copies + [(2, (x[0] + 0.001 * (j + 1)).tolist()) for j in range(7)] + [rows[0]] * 3
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    score = {}
    for i, v in rows:
        found = float(np.dot(v, x[0]) / np.linalg.norm(v) / np.linalg.norm(x[0]))
        score[i] = max(score.get(i, -1), found)
    best = sorted(set(score) - {0}, key=lambda i: (-score[i], i))[:5]
    got = sorted(vectors.neighbours(table, "vec_id = 0").collect(), key=lambda r: r["rank"])
    assert [r.vec_id for r in got] == best and [r["rank"] for r in got] == [1, 2, 3, 4, 5]
    assert all(abs(r.score - score[r.vec_id]) < 1e-12 for r in got)


def test_recall(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    norm = np.sqrt((x * x).sum(axis=1))
    found = {}
    for r in queries.QUERIES["op9_nearest_vectors"](spark, SF_DIR).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x * x[q]).sum(axis=1) / (norm * norm[q])
        best = [j for j in np.lexsort((ids, -score)) if j != q][:5]
        hits += len(found[ids[q]] & set(ids[best]))
    assert hits >= 0.9 * 5 * len(found)


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [r for r in queries.QUERIES["op1_language_id"](spark, SF_DIR).collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)


def test_pipeline(spark):
    """Each stage against what it must do to its own input, on the whole table."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = scratch_path(spark, "test-pipeline")
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    windows = set()
    for item in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = split.findall(lower(item.text))
        windows |= {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{path}/{name}")
        after = spark.read.parquet(f"{path}/{name}")
        before, left = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}
        assert after.count() == len(left) and set(left) <= set(before)
        if name != "mixing":
            assert after.columns == docs.columns
        if name == "language_id":
            assert len(left) >= 0.995 * len(before)
        if name == "near_duplicates":
            sets = {}
            for i, r in before.items():
                w = re.findall(r"[^\x20\x09-\x0D]+", lower(r.text))
                sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
            order = sorted(before)
            linked = {i: i for i in order}
            for a in range(len(order)):
                for b in range(a):
                    x, y = sets[order[a]], sets[order[b]]
                    if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                        one, two = linked[order[a]], linked[order[b]]
                        linked = {i: min(one, two) if g in (one, two) else g for i, g in linked.items()}
            assert set(left) == set(linked.values())
        if name == "decontamination":
            bad = {i for i, r in before.items() if (w := split.findall(lower(r.text))) and any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9))}
            assert set(left) == set(before) - bad
        if name == "secrets":
            assert set(left) == set(before)
            assert not any(re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r.text or "") for r in left.values())
            assert sum(left[i].text == before[i].text for i in left) > 0.8 * len(left)
        if name == "mixing":
            assert all(0 < r.taken <= 2 * r.size for r in left.values())
        docs = after
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


PARAGRAPH = " ".join(f"Sentence number {i} tells of rivers and hills in plain words." for i in range(7))
ARTICLE = f"<h1>Title here</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
SHAPES = {
    "named by what it has": f'<div class="layout has-sidebar">{ARTICLE}</div>',
    "named by what it lacks": f'<article><div class="row no-sidebar">{ARTICLE}</div></article>',
    "resembling name beside an article's": f'<div class="entry-content social-ready">{ARTICLE}</div>',
    "resembling name in main": f'<main><section class="content-widget">{ARTICLE}</section></main>',
    "link without end": f'<article><h1>Title here</h1><a href="#x"><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article>',
    "anchor without end": f'<article><a name="top">{ARTICLE}</article>',
    "section of related work": f'<article><h1>Title here</h1><p>{PARAGRAPH}</p><section id="related-work"><p>{PARAGRAPH}</p></section></article>',
    "apostrophes in attributes": f"<article><h1>Title here</h1><p title=it's>{PARAGRAPH}</p><p data-x='a' id=b'>{PARAGRAPH}</p></article>",
    "bare body": ARTICLE,
    "table layout": f"<table><tr><td><a href=/>Home</a></td><td>{ARTICLE}</td></tr></table>",
}
AROUND = (
    '<nav><a href="/">Home</a> <a href="/n">News</a></nav>', f'<div class="comment-list"><p>GONE {PARAGRAPH}</p></div>',
    f'<div id="cookie-banner"><p>GONE {PARAGRAPH}</p></div>', f"<footer><p>GONE {PARAGRAPH}</p></footer>",
    f'<aside class="sidebar-left"><p>GONE {PARAGRAPH}</p></aside>',
    '<div class="cards"><a href="/x"><h3>GONE teaser</h3><p>GONE some more words in a card that is one link to another page here</p></a></div>',
)


@pytest.mark.parametrize("shape", SHAPES)
def test_page_shapes(shape):
    """Shapes that are not in the labelled table: the article is kept, what surrounds it goes."""
    tree = html_text.trained_tree()
    expected = f"{PARAGRAPH}\n\n{PARAGRAPH}"
    for before, after in (((), ()), (AROUND[:1], AROUND[1:]), (AROUND, ())):
        text = html_text.main_text(f"<html><body>{''.join(before)}{SHAPES[shape]}{''.join(after)}</body></html>", tree)
        assert text.removeprefix("Title here\n\n") == expected, (shape, before)


def test_extreme_vectors(spark):
    """Lengths that overflow or vanish when squared: nearness is that of the directions."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    base[50] = np.ldexp(base[0], 700)
    base[52] = np.ldexp(base[0], -700)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in vectors.neighbours(frame, "vec_id % 50 = 0").where("query_id = 0").orderBy("rank").collect()]
    assert [i for i, _ in got[:2]] == [50, 52] and all(s == pytest.approx(1) for _, s in got[:2])


def test_lists_are_balanced():
    """A third of all vectors near one point, as few centroids as there may be."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 8))
    x[:1000] = x[0] + rng.normal(size=(1000, 8)) * 1e-3
    x = vectors.unit(x)
    centroids = vectors.cluster(x, 30, rng)
    even = vectors.balanced(x, centroids, rng)
    sizes = np.bincount(np.argmax(x @ even.T, axis=1), minlength=len(even))
    assert sizes.max() <= 3 * vectors.BALANCE * len(x) / len(centroids) < 1000
    same = np.repeat(x[:1], 50, axis=0)
    assert len(vectors.balanced(same, same[:1], rng)) == 1


def test_pipeline_leaves_one_table(spark):
    """Of all that the stages store only the result stays, and it can be read."""
    shared = Path(shared_dir(spark).removeprefix("file:")) / "pixelframe"
    before = set(shared.iterdir()) if shared.exists() else set()
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before] == ["pipeline-mixing"]


def test_recall_at_most_centroids(spark, monkeypatch):
    """Where the bound on centroids decides, lists get longer and neighbours are still found."""
    monkeypatch.setattr(vectors, "MAX_CENTROIDS", 12)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in vectors.neighbours(table, "vec_id % 50 = 0").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = vectors.usable(table).orderBy("vec_id").toArrow().combine_chunks()
    ids, x = rows["vec_id"].to_numpy(), vectors.unit(vectors.vector_matrix(rows["vector"].combine_chunks()))
    found = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        near = x @ x[i]
        near[i] = -2
        best = set(ids[np.argsort(-near, kind="stable")[:5]].tolist())
        found, total = found + len(best & got[ids[i]]), total + 5
    assert found >= 0.9 * total
