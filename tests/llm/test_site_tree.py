import html
import math
import random
import re
from collections import Counter

import pytest

from proofmill.llm import site_tree as s

PAGES = "page_id long, url string, html string"


def text_of(source):
    blocks, _, has_article = s.parse(source)
    return "\n".join(t for t, _, inside in blocks if inside or not has_article)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<p>a<p>b <b>c</b>\n d<br>e", "a\nb c d\ne"), ("plain &lt;text&gt; &amp", "plain <text> &"), ("", ""), ("<p>unclosed <i>it", "unclosed it"),
        ("<nav><div><p>no</div></nav><p>yes", "yes"), ("<script>var t='</p>';</script><p>yes</p><style>p{}</style>", "yes"),
        ("<article><header><h1>T</h1></header><p>a</p><aside>n</aside><form>f</form><div class='cookie-notice'>n</div></article><p>out", "T\na"),
        ("<header>n</header><div class='post'><p>a</p></div><div id='comments'><article class='comment'>n</article></div><footer>n</footer>", "a"),
        ("<article><p>a</p><article class='comment'><p>n</p></article></article>", "a"), ("<article class='no-sidebar'><p>a</p></article>", "a"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<!-- <p>n</p> --><p>1 < 2</p><p hidden>n</p>", "1 < 2"), ("<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>", "1\n2\n3\n4"),
        ("<div class=ad>n</div><p title='a > b'>x</p><!doctype html><p style='display:none'>n", "x"), ("<script>never closed", ""), ("<!-- never closed <p>n", ""),
    ],
)
def test_blocks(source, want):
    assert text_of(source) == want


def test_repeated_branches_go_and_articles_stay(make):
    pages = [
        (i, f"http://h.example/{i}", f"<div class='wrap x{i}'><div class='story'><p>Story {i} of the day {i * i}</p></div><div class='blurb'>Read our paper.</div></div>")
        for i in range(40)
    ]
    pages += [(100 + i, "http://h.example/copy", "<div class='wrap x1'><div class='story'><p>One story many times</p></div></div>") for i in range(200)]
    pages += [(500 + i, "http://few.example/", f"<div class='blurb'>Read our paper.</div><p>{i}</p>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in s.main_text(make(pages, PAGES)).collect()}
    assert len(got) == len(pages)
    assert all(got[i] == f"Story {i} of the day {i * i}" for i in range(40))
    assert all(got[100 + i] == "One story many times" for i in range(200))
    assert got[501] == "Read our paper.\n1"  # too few pages to tell


def test_odd_rows(make):
    long = "<p>" + "word " * 50_000
    rows = [(1, None, None), (1, None, None), (2, "no host", ""), (None, "http://a/", "<p>x"), (3, "http://a/", long)]
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in s.main_text(make(rows, PAGES)).collect()), key=repr)
    assert got == sorted([(1, None, ""), (1, None, ""), (2, "no host", ""), (None, "http://a/", "x"), (3, "http://a/", " ".join(["word"] * 50_000))], key=repr)
    assert s.main_text(make([], PAGES)).count() == 0


def test_all_pages_equal_a_plain_reading(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in s.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = re.split("</?(?:p|h1|br)>", re.sub("</?b>", "", article))
        assert got[r["page_id"]] == "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_hosts_below_twenty_pages_are_learned(make):
    pages = [(100 * n + i, f"http://h{n}.example/{i}", f"<div class='wrap'><div class='story'><p>Story {i} of {n}</p></div><div class='blurb'>Read our paper.</div></div>") for n in (6, 12, 19) for i in range(n)]
    got = {r["page_id"]: r["text"] for r in s.main_text(make(pages, PAGES)).collect()}
    assert got == {100 * n + i: f"Story {i} of {n}" for n in (6, 12, 19) for i in range(n)}


def test_articles_keep_what_they_share(make):
    """Headings and sentences that all articles of a host share stay, on hosts of any size; what is repeated outside goes."""
    pages, want = [], {}
    for n in (1, 2, 4, 6, 12, 30):
        for i in range(n):
            pages.append(
                (
                    1000 * n + i, f"http://h{n}.example/{i}",
                    f"<div class='blurb'>Read our paper.</div><article><h2>Summary</h2><p>Story {i} of {n}</p><p>As always, <b>thanks</b>.</p><ul><li>One</ul>"
                    f"<h2>Method</h2><p>Same for all</p></article><p>Outside</p>",
                )
            )
            want[1000 * n + i] = f"Summary\nStory {i} of {n}\nAs always, thanks.\nOne\nMethod\nSame for all"
    assert {r["page_id"]: r["text"] for r in s.main_text(make(pages, PAGES)).collect()} == want


def test_importance_recounted(make):
    """The weights of the tree against entropies worked out one by one."""
    rng, rows = random.Random(3), []
    for body in range(60):
        for node in range(rng.randrange(6)):
            rows.append((rng.choice(["a", "b", None]), body, node, rng.randrange(3), rng.randrange(8)))
    rows += rows[:40]  # copies of a page's nodes count once
    seen = {}
    for host, body, node, style, content in rows:
        seen.setdefault((host, node), {}).setdefault(body, (style, content))
    want = {}
    for key, pages in seen.items():
        m = len(pages)

        def entropy(values, m=m):
            counts = Counter(values).values()
            return -sum(n / m * math.log(n / m) for n in counts) / math.log(m) if m > 1 else 1.0

        want[key] = (m, s.PRESENTATION * entropy([x for x, _ in pages.values()]) + (1 - s.PRESENTATION) * entropy([c for _, c in pages.values()]))
    frame = make(rows, "host string, body long, node long, style long, content long")
    got = {(r["host"], r["node"]): (r["pages"], r["importance"]) for r in s.importance(frame).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_repeated_plain_texts_go_and_others_stay(make):
    pages = [(i, f"http://h.example/{i}", f"<div class='story'><h2>Title {i}</h2><p>Story {i}</p><p>Read our paper.</p><p>Part {i % 2}</p></div>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in s.main_text(make(pages, PAGES)).collect()}
    assert got == {i: f"Title {i}\nStory {i}\nPart {i % 2}" for i in range(30)}
