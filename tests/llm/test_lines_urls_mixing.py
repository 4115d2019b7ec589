"""Line deduplication, URL filters and source mixing against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import parity
from cartwright.llm import line_dedup, mixing, url_filter
from cartwright.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert parity.differences(QUERIES[name](spark, SF), parity.connect(SF), ORACLE[name]) is None


def _lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def _plain_dedup(rows, min_docs):
    found = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            found.setdefault(_lower(line.strip(SPACE)), set()).add(doc_id)
    gone = {k for k, ids in found.items() if k and len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if _lower(x.strip(SPACE)) not in gone]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup(documents):
    rng = random.Random(4)
    lines = ["", "  ", "Menu", " menu\t", "ÄB", "äb", "x y", "a\x0bb", "foot er\r", "FOOT ER", *map(str, range(30))]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randrange(1, 9)))) for i in range(60)]
    # Null and empty texts, a very long one, repeated rows, a null id, and an id with two texts.
    rows += [(60, None), (61, ""), (62, "menu\n" * 20_000), (3, rows[3][1]), (None, "menu\nz"), (5, "FOOT ER\nonly here")]
    docs = documents([(i, t, None, None) for i, t in rows], clash=("pos", "h1", "row", "dropped", "line", "n_lines"))
    for min_docs in (2, 10, 1000):
        got = line_dedup.drop_common_lines(docs, min_docs=min_docs)
        found = [tuple(r) for r in got.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()]
        assert sorted(found, key=repr) == _plain_dedup(rows, min_docs)


def test_line_dedup_of_nothing(documents):
    assert line_dedup.drop_common_lines(documents([])).count() == 0


def test_line_dedup_is_native(documents):
    plan = line_dedup.drop_common_lines(documents(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _plain_verdict(url, rules):
    tail = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([tail.find(c) for c in "/?#" if c in tail], default=len(tail))
    host, rest = _lower(tail[:cut]), tail[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (-len(h + p), v != "block", h + p, v)
        for h, p, v in rules
        if (host == h or (h and host.endswith("." + h))) and path.startswith(p)
    ]
    best = min(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_filter(spark):
    rules = [
        ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
        ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("b.com", "", "block"), ("b.com", "", "allow"),
        ("", "", "block"),
    ]
    urls = [
        None, "", "nothing", "http://", "http:///p", "http://Example.ORG/es/1?x=/en", "https://a.example.org/es/",
        "https://xexample.org/es/", "https://a.b.example.org/en/17#t", "https://example.org/en/2", "http://org", "http://org?/",
        "http://a.com/de/x", "http://com/fr/", "http://a.com/DE/", "http://b.com", "http://q.b.com?x", "http://a://b.com/fr/",
        "http://x.org\n/y", "http://" + "a." * 3000 + "org/z", "http://a.com/de/" + "p" * 100_000, "http://.org/", "http://a.b.com/",
    ]
    pages = spark.createDataFrame(
        [(i, u, "a", "b") for i, u in enumerate([*urls, *urls])], "page_id long, url string, host string, verdict string"
    )
    for listed in (rules, rules[:5], []):
        got = url_filter.judge_urls(pages, url_filter.rules_frame(spark, listed)).select(
            "row.page_id", "host", "path", "rule", "verdict"
        )
        want = [(i, *_plain_verdict(u, listed)) for i, u in enumerate([*urls, *urls])]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_many_rules_of_many_path_lengths(spark):
    """Expansions follow the hosts that a URL meets, and the plan does not grow with the rules."""
    deep = [("busy.org", "/" + "x" * n, "block") for n in range(0, 900, 3)]
    other = [(f"h{i}.net", "/" + "y" * (i % 500), "block") for i in range(3000)]
    urls = [f"http://{h}/{'x' * n}" for n in range(0, 1000, 7) for h in ("a.busy.org", "busy.org", "h7.net")]
    urls += [f"http://q.h{i}.net/{'y' * 300}" for i in range(0, 3000, 11)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = deep + other
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, rules))
    by_host = {}
    for r in rules:
        by_host.setdefault(r[0], []).append(r)
    near = lambda u: [r for h, rs in by_host.items() if h in u for r in rs]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.select("row.page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {i: _plain_verdict(u, near(u)) for i, u in enumerate(urls)}
    # The plan holds one array of label counts, and no expression per path length.
    assert len(judged._jdf.queryExecution().optimizedPlan().toString()) < 30_000


def _plain_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = most * sizes[s]
        open_ -= full
        left = share * sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mixing_targets_and_draws(documents, seed):
    rng = random.Random(seed)
    names = [None, "", "é", "Z", "a", "b", "😀", "\uffff"][: 2 + 2 * seed]
    rows = [(i, "w " * rng.randrange(0, 9 if rng.random() < 0.9 else 400), None, rng.choice(names)) for i in range(400)]
    docs = documents(rows, clash=("size", "rate", "target", "copies", "weight", "row"))
    got = mixing.mix_counts(docs, weights=(3, 1, 2), share=1.5, most=2).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = _plain_targets(sizes, (3, 1, 2), 1.5, 2)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        rate = r.target / r.source_size if r.source_size else 0
        draw = int(hashlib.md5(f"0:{r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        assert r.copies == int(rate) + (draw < rate - int(rate))
    # The mixed corpus holds each row that often, with the columns of the input.
    mixed = mixing.mix_documents(docs, weights=(3, 1, 2), share=1.5, most=2)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in got if r.copies}


def test_mixing_without_words(documents):
    assert mixing.mix_counts(documents([])).count() == 0
    (row,) = mixing.mix_counts(documents([(None, None, None, None)])).collect()
    assert (row.size, row.target, row.copies) == (0, 0.0, 0)


def test_mixing_draws_alike_for_repeated_rows(documents):
    docs = documents([(7, "a b c", None, "s"), (7, "a b c", None, "s"), (8, "d", None, "t")])
    copies = mixing.mix_counts(docs).filter("doc_id = 7").select("copies").distinct()
    assert copies.count() == 1
    again = mixing.mix_counts(docs.repartition(3)).orderBy(F.col("doc_id")).collect()
    assert again == mixing.mix_counts(docs).orderBy(F.col("doc_id")).collect()
