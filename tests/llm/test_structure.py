"""Periodic runs, the prefix trie and page texts against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from hearthline.llm import queries
from hearthline.llm.html_extract import extract_pages, main_text
from hearthline.llm.periodic_runs import Grammar, find_runs, periodic_runs
from hearthline.llm.prefix_trie import prefix_trie, turn_numbers


def plain_runs(w):
    found = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                j = i
                while j + q < len(w) and w[j] == w[j + q]:
                    j += 1
                run = w[i : j + q]
                if len(run) >= max(6, 4 * q) and not any(run[p:] == run[: len(run) - p] for p in range(1, q)):
                    found.add((i, j + q, q))
                i = j
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def word_lists(rng, count):
    for _ in range(count):
        out, k = [], rng.choice([1, 2, 2, 3, 10])
        for _ in range(rng.randint(0, 15)):
            out += [rng.randrange(k) for _ in range(rng.randint(1, 6))] * rng.choice([1, 1, 2, 5, 7])
        yield out


def test_runs_equal_plain_version():
    rng = random.Random(3)
    for _ in range(150):
        docs = list(word_lists(rng, rng.randint(1, 4)))
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        words = np.array(sum(docs, []), np.int64)
        expected = [(s + o, e + o, q) for d, o in zip(docs, bounds.tolist()) for s, e, q in plain_runs(d)]
        assert [tuple(x) for x in find_runs(words, bounds).tolist()] == expected


def test_grammar_extensions():
    rng = random.Random(5)
    for words in word_lists(rng, 60):
        if len(words) < 2:
            continue
        w, n = np.array(words), len(words)
        pairs = [sorted(rng.sample(range(n), 2)) for _ in range(20)]
        a, b = np.array(pairs).T
        grammar, doc = Grammar(w, np.array([0, n])), np.zeros(20, np.int64)
        ahead = [next((k for k in range(n - y) if words[x + k] != words[y + k]), n - y) for x, y in pairs]
        back = [next((k for k in range(x) if words[x - 1 - k] != words[y - 1 - k]), x) for x, y in pairs]
        assert grammar.extend(a, b, doc, True).tolist() == ahead
        assert grammar.extend(a, b, doc, False).tolist() == back


def plain_op11(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = max(((e - s) / q, -s, -q) for s, e, q in runs) if runs else None
    top = (None, None, None)
    if best:
        top = next((s, e - s, q) for s, e, q in runs if (-s, -q) == best[1:])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(runs), *top, top[1] and 1000 * top[1] // top[2], sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_op11_equals_plain_version(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(f"w{x}é" for x in words) for words in word_lists(rng, 150)]
    texts += [None, "", "  \t\n ", "a " * 5, "a " * 6, "a b " * 400, "x y " * 9, texts[3], texts[3]]
    texts.append(" ".join(rng.choice("abc") for _ in range(3000)))
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {plain_op11(k, t) for k, t, _ in rows}


def test_collapsed_text_long_text_and_empty_table(spark):
    df = spark.createDataFrame([("a", "so it goes " * 30 + "end"), ("b", "z " * 300_000), ("a", None)], "key string, text string")
    rows = periodic_runs(df, "key").collect()
    assert [(r.key, r.collapsed, r.n_words) for r in rows] == [("a", "so it goes end", 91), ("b", "z", 300_000), ("a", "", 0)]
    assert [tuple(x) for x in rows[1].runs] == [(0, 300_000, 1)]
    assert periodic_runs(df.limit(0), "key").collect() == []


def plain_trie(paths):
    nodes = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    children = defaultdict(list)
    for key in nodes:
        if key:
            children[key[:-1]].append(key)
    out = set()
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(key))
        out.add((
            min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(children[key]),
            sum(not children[k] for k in below), sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    return out


def test_op12_equals_plain_version(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(210, 230), *range(1000, 3400, 100)]:
        long = 30 if c % 7 == 0 else 4
        rows += [(c, None if k == 2 else k, rng.choice(["user", None, "ab"]), rng.choice(["a", "bb", "", None, "b" * 900])) for k in range(rng.randint(1, long))]
    rows += rows[:20]  # repeated rows, and ties of turn
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "role AS node_a", "turn AS depth")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_prefix_trie(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == plain_trie(rebuilt(rows))
    assert len(got) == len(set(got))


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_widths_and_empty_table(spark, width):
    rows = [(c, k, "r", "abc"[(c >> k) % 3]) for c in range(40) for k in range(c % 8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    everyone = spark.range(40).withColumnRenamed("id", "conv_id")
    paths = {c: tuple(("r", "abc"[(c >> k) % 3]) for k in range(c % 8)) for c in range(40)}
    assert {tuple(r) for r in prefix_trie(everyone, turn_numbers(df), width).collect()} == plain_trie(paths)
    assert prefix_trie(everyone.limit(0), turn_numbers(df.limit(0)), width).collect() == []


PAGES = {
    "": "",
    "plain text": "plain text",
    "<body><nav><ul><li><a href=x>Home</a></ul></nav><article><h1>Title</h1><p>One &amp; two,<br>three. <b>Bo</b>ld<p>Short</article><footer>c</footer>": "Title One & two, three. Bold Short",
    "<div id=menu><a href=x>Home</a></div><div class=content><h2>T</h2><p>First paragraph, with commas. And more text.<p>Second, of it.<ul><li>item</ul></div>"
    "<div class=sidebar><p>Side text, long enough, really. Yes.</div><div id=comments><p>I disagree, strongly.</div><form>Name, please.</form>": "T First paragraph, with commas. And more text. Second, of it. item",
    '<article><p>a, b.<script>var x="</article>"</script><!-- no <p>, no. --><aside>no, no.</aside><p title="a>b">z.</article><p>After': "a, b. z.",
    "<main><article><p>Long text, of it. More, still.</p></article><article class=comment><p>C, d, e, f, g, h.</p></article></main>": "Long text, of it. More, still.",
    "<article><p>x &lt;p&gt; 3 < 4, y.</p><p>  </p><table><tr><td>1<td>2</table></article>": "x <p> 3 < 4, y. 1 2",
    "<div class='wrap has-sidebar'><div class='content no-ads'><h1>T</h1><p>Text of it, here. More, too, of it.</p></div><div class='side'>Short, aside.</div></div>": "T Text of it, here. More, too, of it.",
    "<div class='page with-menu'><article><p>a, b.</p></article><ul class=menu><li>Home, work, and more of it, all day.</ul></div>": "a, b.",
    "<p>Short, true.</p><div class=comments><p>Long, long, long comment, of a reader. Longer than all, by far.</p></div>": "Short, true.",
    "<p>unclosed, text. <a href='q": "unclosed, text.",
    "<head><title>T, t.</title><style>p{}</style>": "",
}


def test_page_texts(spark):
    assert {p: main_text(p) for p in PAGES} == PAGES
    rows = [(k, "u", p) for k, p in enumerate(PAGES)] + [(99, None, None), (0, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    got = sorted(map(tuple, extract_pages(df).collect()), key=str)
    assert got == sorted([(k, "u", t, len(t)) for k, t in enumerate(PAGES.values())] + [(99, None, "", 0), (0, "u", "", 0)], key=str)
    assert extract_pages(df.limit(0)).collect() == []


@pytest.mark.parametrize("part", ["<div>", "<p>some, text. ", "<", "<a ", "<!--", '<a b="', '<a b=">', "<script>", "</p><b></i>", "&amp"])
def test_hostile_pages_end(part):
    main_text(part * 20_000 + "end, here.")
