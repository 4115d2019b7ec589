"""Language ID, toxicity, quality rules and licence scans: plain versions and held-out accuracy."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.llm import language, licenses, quality, toxicity
from cartwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ language


def _plain_bundle(encoder, text):
    """Sum over all n-grams of the product of the letters' rotated vectors, one n-gram at a time."""
    slots = [ord(c) % language.SLOTS + 1 if c.isalpha() else 0 for c in f" {text.lower()} "]
    slots = [s for i, s in enumerate(slots) if s or not i or slots[i - 1]]
    total = np.zeros(encoder.dimensions)
    for i in range(len(slots) - language.GRAM + 1):
        total += np.prod([encoder._rotated[k][slots[i + k]] for k in range(language.GRAM)], axis=0)
    return total


@pytest.mark.parametrize("text", ["a", "Der Hund, der  bellt!", "été 12 été", "中文 字", "x" * 3000, "ab" * 900 + "cde " * 300])
@pytest.mark.parametrize("kept", [1, 1 << 15])
def test_bundles(monkeypatch, text, kept):
    monkeypatch.setattr(language, "KEPT_GRAMS", kept)
    encoder = language.Encoder()
    assert np.array_equal(encoder.bundle(*encoder.grams(text)), _plain_bundle(encoder, text))


def test_language_of_odd_texts(documents):
    rows = [(i, "the house and the garden with that", "en", "s") for i in range(6)]
    rows += [(10 + i, "der garten und das haus mit ihnen", "de", "s") for i in range(6)]
    rows += [(20, None, None, None), (21, "", "en", None), (22, "12 !? 3", "de", None), (None, "und das haus", None, None)]
    rows += [(23, "the garden " * 40_000, None, None), (0, "the house and the garden with that", "en", "s")]
    docs = documents(rows, clash=("lang_pred", "score", "row", "found", "bundle"))
    prototypes = language.train_prototypes(docs)
    assert sorted(prototypes) == ["de", "en"]
    got = [(r.row.doc_id, r.lang_pred, r.score) for r in language.identify(docs, prototypes).collect()]
    assert len(got) == len(rows)
    found = {i: (lang, score) for i, lang, score in got}
    assert {found[i] for i in (20, 21, 22)} == {("und", 0.0)}
    assert found[0][0] == "en" and found[11][0] == "de" and found[None][0] == "de" and found[23][0] == "en"
    assert all(0 <= score <= 1 for _, _, score in got)
    # Nothing to learn from.
    assert language.train_prototypes(documents([])) == {}
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}


def test_prototypes_do_not_depend_on_partitions(documents):
    docs = documents([(i, f"words {i} and more words", "en" if i % 2 else "fr", "s") for i in range(40)])
    assert language.train_prototypes(docs.repartition(7)) == language.train_prototypes(docs.coalesce(1))


def test_language_accuracy(spark):
    got = QUERIES["op7_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98 and got.count() == 1000


# ------------------------------------------------------------------ toxicity


def _auc(pairs):
    good = [s for s, y in pairs if y]
    bad = [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def _corpus(n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "rt", "ll", "sk")]
    insults = ["zarkon", "blivet", *(f"gromp{e}" for e in ("el", "us", "ia", "oth", "ig", "an", "ex", "ur"))]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = rng.choices(words, k=rng.randrange(5, 120))
        for _ in range(rng.randrange(1, 4) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(insults))
        rows.append((i, " ".join(text), None, None))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_invented_words(spark, documents):
    rows, labels = _corpus(900, 1)
    # Copies of one toxic text make none of its words an insult.
    rows += [(2000 + i, "dan fert koll gusk ban bart bell besk zarkon", None, None) for i in range(40)]
    labels += [(2000 + i, 1) for i in range(40)]
    rows += [(5000, None, None, None), (5001, "", None, None), (5002, "!" * 50_000, None, None), (None, "dan", None, None)]
    labels = spark.createDataFrame([*labels, (3, None), (None, 1), (77777, 1), (6, 0)], "doc_id long, toxic int")
    docs = documents(rows, clash=("toxic", "x", "score", "predicted", "votes", "entry"))
    held = toxicity.held_out()
    scored = toxicity.score_toxicity(docs, labels.filter(~held)).withColumn("held", held).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    assert all(r.predicted == int(r.score >= 0.5) for r in scored)
    pairs = [(r.score, r.doc_id % 6 == 0) for r in scored if r.held and r.doc_id is not None and r.doc_id < 900]
    assert _auc(pairs) > 0.97
    clean = [r.predicted for r in scored if r.held and r.doc_id is not None and r.doc_id < 900 and r.doc_id % 6]
    assert sum(clean) <= 0.02 * len(clean)
    assert {r.predicted for r in scored if r.doc_id in (5000, 5001, 5002, None)} == {0}


def test_toxicity_learns_from_every_training_label(spark, documents, monkeypatch):
    """``max_rows`` bounds the rows of the linear classifier, not the mining and not the label model."""
    rows, labels = _corpus(600, 2)
    seen = {}
    mine, label_model, linear = toxicity.mine_lexicon, toxicity.fit_label_model, toxicity.fit_linear

    def mined(labelled, **options):
        seen["mined"] = labelled.count()
        return mine(labelled, **options)

    def modelled(votes, counts, **options):
        seen["modelled"] = int(counts.sum())
        return label_model(votes, counts, **options)

    def fitted(x, y, **options):
        seen["fitted"] = len(x)
        return linear(x, y, **options)

    for name, f in (("mine_lexicon", mined), ("fit_label_model", modelled), ("fit_linear", fitted)):
        monkeypatch.setattr(toxicity, name, f)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.score_toxicity(documents(rows), labels, max_rows=100).count() == 600
    assert seen == {"mined": 600, "modelled": 600, "fitted": 100}


def test_words_of_copies_take_no_places_in_the_lexicon(spark):
    """Words frequent through copies alone outrank the real ones, and are no entries all the same."""
    rng = random.Random(8)
    clean = [(" ".join(rng.choices(["dan", "fert", "koll", "gusk", "bart", "bell", "besk"], k=12)), 0) for _ in range(300)]
    copies = [(" ".join(f"copied{chr(97 + i)}x" for i in range(20)), 1)] * 80
    real = [(" ".join([f"w{i}", "zarkon", f"v{i}", "blivet"]), 1) for i in range(40)]
    labelled = spark.createDataFrame(clean + copies + real, "text string, toxic int")
    assert set(toxicity.mine_lexicon(labelled).words) == {"zarkon", "blivet"}


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(["you are an idiot", "a fine day", None])
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, none).collect()}
    assert got == {0: 1, 1: 0, 2: 0}
    assert toxicity.score_toxicity(documents([]), none).count() == 0


def test_label_model_finds_accuracies_and_repeated_voters():
    rng = np.random.default_rng(2)
    truth = rng.random(6000) < 0.2
    positive = np.array([[0.02, 0.05, 0.3, 0.05], [0.7, 0.6, 0.35, 0.8]])
    votes = (rng.random((6000, 4)) < positive[truth.astype(int)]).astype(float)
    human = np.where(rng.random(6000) < 0.98, truth, ~truth).astype(float)
    votes = np.column_stack([votes, votes[:, 0], human])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model(patterns, counts.astype(float))
    assert np.abs(model.positive[:, :4] - positive).max() < 0.06
    assert model.weight[0] < 0.65 and model.weight[4] < 0.65 and model.weight[1] > 0.9
    without = votes.copy()
    without[:, -1] = np.nan
    assert ((model.posterior(without) > 0.5) == truth).mean() > 0.9


def test_toxicity_of_test_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op6_toxicity"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    pairs = [(r.score, r.toxic) for r in got]
    # 33 toxic texts in four languages are few to learn from; the larger tables give 1.0.
    assert _auc(pairs) > 0.75
    assert sum(r.predicted for r in got if not r.toxic) <= 0.05 * len(got)


# ------------------------------------------------------------------- quality


def _plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é😀#|\n \t\x1c\x85　"), max_size=80))
def test_statistics(text):
    assert quality.text_statistics(text) == _plain_statistics(text)


def test_consistency_factor():
    """Against the share of five normal coordinates' variance that the inner half holds."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400_000, 5))
    inner = x[np.argsort((x**2).sum(axis=1))[:200_000]]
    assert quality.consistency() == pytest.approx((inner**2).mean(), rel=0.01)


def test_estimates_ignore_outliers(spark):
    rng = np.random.default_rng(1)
    good = rng.standard_normal((600, 5)) * [2, 3, 2, 4, 5] + 10
    bad = rng.standard_normal((200, 5)) * 0.5 + 60
    rows = [(g, *map(float, r)) for g in ("a", "b") for r in np.vstack([good, bad])]
    points = spark.createDataFrame(rows, "key string, " + ", ".join(f"x{i} double" for i in range(5)))
    for r in quality.robust_estimates(points).collect():
        assert np.abs(np.array(r.centre) - 10).max() < 1.5
        inverse = np.zeros((5, 5))
        inverse[np.triu_indices(5)] = r.inverse
        d = (bad - r.centre) @ np.triu(inverse) @ (bad - r.centre).T
        assert np.diag(d).min() > quality.MAX_SQUARED_DISTANCE


def test_quality_rules(documents):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("str", "bl", "gr", "t") for b in ("ong", "ue", "een", "able", "ime")]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    rows = [(i, prose(rng.randrange(60, 400)), ("en", "de", None)[i % 3], ("a", None)[i % 2]) for i in range(700)]
    odd = [
        (1000, None), (1001, ""), (1002, prose(20)), (1003, "buy it now " * 100), (1004, prose(20_000)),
        (1005, " ".join(w + "###$$$" for w in prose(200).split())), (1006, prose(300)), (None, prose(100)),
        (1007, "\n".join(["one two three four five six"] + [prose(2) if i % 2 else "Menu" for i in range(200)])),
    ]
    rows += [(i, t, "en", "a") for i, t in odd] + [rows[0]]
    docs = documents(rows, clash=("n_words", "kept", "x0", "key", "n", "class", "centre", "stat"))
    got = quality.judge_quality(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert sum(not by_id[i].kept for i in range(700)) <= 2
    kept = {i: by_id[i].kept for i, _ in odd}
    assert kept == {1000: False, 1001: False, 1002: False, 1003: False, 1004: True, 1005: False, 1006: True, None: True, 1007: False}
    assert [by_id[i].base_failed for i in (1000, 1002, 1003, 1005, 1007)] == [True, True, True, False, False]
    assert quality.judge_quality(documents([])).count() == 0


def test_groups_with_spread_are_judged_by_their_own(spark):
    """Moderate outliers of every coordinate, beside clean vectors; each coordinate's deviation is above its floor."""
    rng = np.random.default_rng(4)
    deviation = 1.5 * np.array(list(quality.COORDINATES.values()))
    clean = rng.standard_normal((2000, 5)) * deviation + 5
    odd = np.vstack([5 + sign * 5.8 * deviation * unit for unit in np.eye(5) for sign in (1, -1)])
    points = spark.createDataFrame(
        [("a", *map(float, r)) for r in np.vstack([clean, odd])], "key string, " + ", ".join(f"x{i} double" for i in range(5))
    )
    (r,) = quality.robust_estimates(points).collect()
    inverse = np.zeros((5, 5))
    inverse[np.triu_indices(5)] = r.inverse
    inverse += np.triu(inverse, 1).T
    distance = lambda x: np.einsum("ij,jk,ik->i", x - r.centre, inverse, x - r.centre)
    assert (distance(odd) > quality.MAX_SQUARED_DISTANCE).all()
    assert (distance(clean) > quality.MAX_SQUARED_DISTANCE).mean() < 0.005
    # A group without spread has the floors' distances.
    alike = spark.createDataFrame([("b", *[1.0] * 5)] * 50, points.schema)
    floors = np.array(list(quality.COORDINATES.values()))
    assert quality.robust_estimates(alike).first().inverse == pytest.approx(np.diag(floors**-2.0)[np.triu_indices(5)])


def test_moderate_outliers_are_rejected(documents):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("str", "bl", "gr", "t") for b in ("ong", "ue", "een", "able", "ime")]
    prose = lambda n: [rng.choice(words) + rng.choice(words) for _ in range(n)]
    rows = [(i, " ".join(prose(rng.randrange(60, 400))), "en", "a") for i in range(600)]
    text = prose(300)
    odd = {
        1000: " ".join(w + "xyz" for w in text),
        1001: " ".join(w + "#" * (i % 3 == 0) for i, w in enumerate(text)),
        1002: "\n".join(" ".join(text[i : i + 5]) for i in range(0, 150, 5)) + "\nsee all of our posts" * 30,
        1003: " ".join(text[:160] + text[:40] * 2),
    }
    got = {r.doc_id: r for r in quality.judge_quality(documents(rows + [(i, t, "en", "a") for i, t in odd.items()])).collect()}
    assert [got[i].base_failed for i in odd] == [False] * 4 and [got[i].kept for i in odd] == [False] * 4
    assert sum(not got[i].kept for i in range(600)) <= 2


def _plain_mcd(points):
    """Centre and floored covariance of the best half: exact halves, both starts, numpy alone."""
    floors, n = np.array(list(quality.COORDINATES.values())), len(points)
    quartiles = np.quantile(points, [0.25, 0.75], axis=0, method="inverted_cdf")
    middle = np.quantile(points, 0.5, axis=0, method="inverted_cdf")
    best = (np.inf, None, None)
    for deviation in (floors, np.maximum((quartiles[1] - quartiles[0]) / 1.349, floors)):
        centre, inverse, least = middle, np.diag(deviation**-2.0), np.inf
        for _ in range(50):
            d = np.einsum("ij,jk,ik->i", points - centre, inverse, points - centre)
            inner = points[d <= np.sort(d)[min(n, (n + 6) // 2) - 1]]
            cov, new_inverse, size = quality._floored(np.cov(inner.T, bias=True) / quality.consistency())
            if size >= least - 1e-9:
                break
            least, centre, inverse = size, inner.mean(axis=0), new_inverse
            best = min(best, (least, centre, cov), key=lambda e: e[0])
    return best[1:]


def test_quality_query_against_plain_estimates(spark):
    """Verdicts of all documents; distances agree but for halves that are cut at a class edge or by a tie."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    stats = [quality.text_statistics(r.text or "") for r in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    x = np.array(
        [(np.log1p(n), np.log((c + 1) / max(n, 1)), *np.sqrt([y / max(c, 1), d / max(n, 1), r / max(n, 1)])) for n, c, y, d, r in stats]
    )
    members = {}
    for i, r in enumerate(rows):
        if not failed[i]:
            for key in ((), (r.lang,), (r.lang, r.source)):
                members.setdefault(key, []).append(i)
    final = {}
    for key in sorted(members, key=len):
        centre, cov = _plain_mcd(x[members[key]])
        if key:
            w, (far, far_cov) = len(members[key]) / (len(members[key]) + quality.PRIOR_TEXTS), final[key[:-1]]
            cov = w * cov + (1 - w) * far_cov + w * (1 - w) * np.outer(centre - far, centre - far)
            centre = w * centre + (1 - w) * far
        final[key] = centre, cov
    got = {r.doc_id: r for r in QUERIES["op10_quality_rules"](spark, SF).collect()}
    assert len(got) == len(rows) and sum(len(k) == 2 for k in members) > 50
    close = 0
    for i, r in enumerate(rows):
        assert got[r.doc_id].base_failed == failed[i]
        if failed[i]:
            assert not got[r.doc_id].kept
            continue
        centre, cov = final[r.lang, r.source]
        d = (x[i] - centre) @ np.linalg.solve(cov, x[i] - centre)
        close += abs(d - got[r.doc_id].distance) <= 0.1 * d + 0.1
        if abs(d / quality.MAX_SQUARED_DISTANCE - 1) > 0.15:
            assert got[r.doc_id].kept == (d <= quality.MAX_SQUARED_DISTANCE), r.doc_id
    assert close >= 0.98 * (len(rows) - sum(failed))


def test_small_groups_are_drawn_towards_their_language(spark):
    """The weight of a group's own estimate grows with its texts, without a jump."""
    wide = np.eye(5)[np.triu_indices(5)].tolist()
    kinds = "key string, parent string, n long, centre array<double>, covariance array<double>, inverse array<double>"
    own = spark.createDataFrame([(f"g{n}", "l", n, [2.0] * 5, wide, wide) for n in (0, 50, 99, 100, 101, 10**9)], kinds)
    far = spark.createDataFrame([("l", "", 1, [0.0] * 5, wide, wide)], kinds)
    got = {r.n: r.centre[0] for r in quality.drawn_towards(own, far, prior=100).collect()}
    assert got[0] == 0 and got[100] == pytest.approx(1) and got[10**9] == pytest.approx(2, abs=1e-6)
    assert 0 < got[101] - got[100] < 0.02 and 0 < got[100] - got[99] < 0.02


# ------------------------------------------------------------------ licences


def _files(spark, rows):
    return spark.createDataFrame(rows, "file_id long, path string, text string, license string, found string")


def test_license_scan(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"]
    rows = [
        (1, "LICENSE", mit), (2, "a/x.c", "int main"), (3, "a/b/LICENSE", gpl), (4, "a/b/c/y.c", "code\n" * 20_000),
        (5, "a/b/z.c", "words before\n" + licenses.TEMPLATES["Apache-2.0"] + "\nand many more words after it"),
        (6, "ab/q.c", None), (7, None, "text"), (8, "a/b/c/d", ""), (9, "a/b/COPYING", mit.upper()), (4, "a/b/c/y.c", "code"),
        (10, "top.c", "the general public works under this version of the first work"),
    ]
    got = licenses.scan_licenses(_files(spark, [(*r, "x", "y") for r in rows])).collect()
    assert len(got) == len(rows)
    found = {r.file_id: (r.license, r.origin, r.directory) for r in got}
    assert found[1] == ("MIT", "own", None) and found[5] == ("Apache-2.0", "own", None)
    assert found[2] == ("MIT", "inherited", "") and found[6] == ("MIT", "inherited", "")
    # Two licence files tie in a/b: the first licence by name counts.
    assert found[4] == ("GPL-3.0", "inherited", "a/b") == found[8]
    assert found[7] == (None, "none", None) and found[10] == ("MIT", "inherited", "")
    assert licenses.scan_licenses(_files(spark, [])).count() == 0


def test_license_cosines_are_those_of_dense_vectors():
    counts = {"license": 5, "the": 40, "version": 3}
    scanner = licenses.Scanner(licenses.TEMPLATES, 50, counts)
    line = "Licensed under the MIT License, version two of the text"
    vocabulary = sorted({w for t in [*licenses.TEMPLATES.values(), line] for w in licenses.terms(t)})
    idf = {w: np.log(51 / (1 + counts.get(w, 0))) + 1 for w in vocabulary}
    vector = lambda t: np.array([licenses.terms(t).count(w) * idf[w] for w in vocabulary])
    known = set(scanner.columns)
    idf |= {w: np.log(51) + 1 for w in vocabulary if w not in known}
    v = vector(line)
    want = {n: v @ vector(t) / np.linalg.norm(v) / np.linalg.norm(vector(t)) for n, t in licenses.TEMPLATES.items()}
    name, cosine, n = scanner.best(line)
    assert name == max(sorted(want), key=want.get) and cosine == pytest.approx(want[name]) and n == 10


def test_license_query_against_plain_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op4_license_scan"](spark, SF).collect()}
    assert len(got) == len(texts)
    templates = {t: n for n, t in licenses.TEMPLATES.items()}
    for i, text in texts.items():
        own = [templates[x] for x in text.split("\n") if x in templates]
        assert (got[i].origin == "own") == bool(own) and (not own or got[i].license == own[0])


def test_license_similarity_does_not_depend_on_the_number_of_files(spark):
    """Common words that no template has weigh little, however many files there are."""
    common = "this file is released to you for the work of a library or later use and it is under"
    line = "This file is released under the MIT License."
    found = {}
    for n in (200, 20_000):
        files = spark.range(n).selectExpr("id AS file_id", "'f' AS path", f"'{common}' AS text").unionByName(
            _files(spark, [(-1, "x", f"{line}\nother words {n}", None, None)]).select("file_id", "path", "text")
        )
        own = licenses.own_licenses(files, licenses.TEMPLATES, 0.5).filter("file_id = -1").first()
        counts = dict.fromkeys(common.split(), n) | {w: n + 1 for w in "this file is released under the".split()}
        scanner = licenses.Scanner(licenses.TEMPLATES, n + 1, counts | {"mit": 1, "license": 1, "other": 1, "words": 1, str(n): 1})
        assert (own.found, own.similarity) == ("MIT", pytest.approx(scanner.best(line)[1]))
        found[n] = own.similarity
    assert found[20_000] >= found[200] > 0.9


def test_license_texts_and_headers(spark):
    texts = dict(licenses.license_texts())
    gpl2, apache = licenses.HEADERS["GPL-2.0"][0].split(), licenses.HEADERS["Apache-2.0"][1].split()
    wrap = lambda words, mark: "\n".join(f"{mark} " + " ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    body = "\nimport os\n" + "value = compute(other, result)\n" * 60
    rows = [(i, f"{name}/LICENSE", "Copyright (c) 2024 Someone\n\n" + text) for i, (name, text) in enumerate(texts.items())]
    rows += [(100 + i, f"{name}/src/deep/x.py", body) for i, name in enumerate(texts)]
    rows += [
        (200, "f/a.py", "#!/usr/bin/python\n" + wrap(gpl2, "#") + "\n" + body),
        (201, "f/b.c", "/*\n" + wrap(apache, " *") + "\n */\n" + body),
        (202, "f/c.c", "// SPDX-License-Identifier: MPL-2.0\n" + body),
        (203, "f/d.c", "// SPDX-License-Identifier: Unheard-9\n" + body),
        (204, "f/e.c", wrap(texts["MIT"].split(), "//") + "\n" + body),
        (205, "f/f.md", "A short text about this. All rights reserved. Released under the MIT License. It goes on after that."),
        (206, "f/g.md", "The use of the work and of the files is free to all of the persons that come to this place."),
    ]
    frame = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r.file_id: (r.license, r.origin) for r in licenses.scan_licenses(frame).collect()}
    for i, name in enumerate(texts):
        assert got[i] == (name, "own") and got[100 + i] == (name, "inherited")
    assert [got[i][0] for i in range(200, 207)] == ["GPL-2.0", "Apache-2.0", "MPL-2.0", None, "MIT", "MIT", None]
