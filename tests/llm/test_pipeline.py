"""The corpus pipeline, stage by stage, against plain versions of its operators."""

import ast
import math
import pathlib

import corpus_pipeline as P
import pyarrow as pa
from pyspark.sql import functions as F

from cartwright import runtime
from cartwright.llm import language, packing, simhash
from cartwright.llm.queries import QUERIES
from cartwright.runtime import materialize, work_dir
from test_lines_urls_mixing import _plain_dedup, _plain_targets
from test_near_duplicates import components, plain_fingerprint

SF = "/root/testdata/sf0.01"
ROOT = pathlib.Path(__file__).parents[2]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_in_their_order():
    assert [name for name, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    assert QUERIES["pipeline"] is P.run


def test_each_stage_on_the_test_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(P.STAGES[:-1]):
        before, out = docs, stage(spark, docs, SF)
        assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        old, new = before.collect(), docs.collect()
        if name == "language_id":
            assert {r.doc_id: r.lang for r in new} == _plain_languages(before) and len(new) >= 0.99 * len(old)
        if name == "line_dedup":
            want = {i: t for i, _, _, t in _plain_dedup([(r.doc_id, r.text) for r in old], 10)}
            assert {r.doc_id: r.text for r in new} == want
            assert all(r.n_chars == len(r.text) for r in new) and any(r.text != t.text for r, t in zip(_by_id(new), _by_id(old)))
        if name == "simhash_near_dedup":
            fps = {r.doc_id: plain_fingerprint(r.text) for r in old}
            first = {}
            for d in sorted(fps):
                first.setdefault(fps[d], d)
            unique = sorted(first)
            links = [(first[a], first[b]) for k, a in enumerate(unique) for b in unique[k + 1 :] if bin(a ^ b).count("1") <= 2]
            found = components(first.values(), links)
            assert sorted(r.doc_id for r in new) == sorted(set(found.values()))
        if name == "mix_sources":
            sizes = {}
            for r in old:
                sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
            targets = _plain_targets(sizes, (3, 1, 2), 1.5, 2)
            times = {r.doc_id: 0 for r in old}
            for r in new:
                times[r.doc_id] += 1
            assert max(times.values()) <= 2
            for r in old:
                rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0
                assert int(rate) <= times[r.doc_id] <= int(rate) + 1
        kept.append(len(new))
    packed = P.pack_sequences(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.filter("piece = 0").count() == kept[-1]


def _by_id(rows):
    return sorted(rows, key=lambda r: r.doc_id)


def _plain_languages(docs):
    """doc_id and language of the documents that stay, by loops over the cosines."""
    prototypes = language.train_prototypes(docs)
    found = [r for r in language.identify(docs, prototypes).collect() if r.lang_pred != "und"]
    names = sorted(prototypes)
    groups = {}
    for r in found:
        best, second = sorted(r.cosines)[::-1][:2]
        scores, leads = groups.setdefault((r.lang_pred, int(math.log2(len(r.row.text)))), ([], []))
        scores.append(r.score)
        leads += [best - second] if r.row.lang == r.lang_pred else []
    lower = lambda xs, q: sorted(xs)[max(0, math.ceil(q * len(xs)) - 1)] if xs else math.inf
    kept = {}
    for r in found:
        scores, leads = groups[r.lang_pred, int(math.log2(len(r.row.text)))]
        if r.score < 0.25 * lower(scores, 0.25):
            continue
        known = r.row.lang in names
        wrong = known and r.row.lang != r.lang_pred and r.score - r.cosines[names.index(r.row.lang)] > 0.5 * lower(leads, 0.5)
        kept[r.row.doc_id] = r.row.lang if known and not wrong else r.lang_pred
    return kept


def test_language_stage_acts_on_its_predictions(spark):
    """Real texts with a wrong label, without one, with an unknown one, and texts of none of the languages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    german = docs.filter("lang = 'de' AND n_chars BETWEEN 600 AND 900").limit(30)
    change = F.when(F.col("doc_id") % 3 == 0, F.lit("en")).when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise("xx")
    odd = german.select((F.col("doc_id") + 10**6).alias("doc_id"), "text", change.alias("lang"), "source", "n_chars")
    greek = "η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί " * 12
    foreign = [(2 * 10**6 + i, greek[i:], "en", "s", len(greek) - i) for i in range(5)] + [(3 * 10**6, "12 345 !", "en", "s", 8)]
    table = docs.union(odd).union(spark.createDataFrame(foreign, docs.schema))
    got = {r.doc_id: r.lang for r in P.keep_known_languages(spark, table, SF).select("doc_id", "lang").collect()}
    assert {i for i in got if i >= 2 * 10**6} == set()
    wanted = {r.doc_id for r in odd.filter("lang IS NULL OR lang = 'en'").collect()}
    assert wanted and {got[i] for i in wanted} == {"de"}
    labels = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert sum(got.get(i) == lang for i, lang in labels.items()) >= 0.99 * len(labels)
    assert got == _plain_languages(table)


def test_stages_handle_odd_documents(spark, documents):
    common = "\n".join(f"shared line {i}" for i in range(3))
    rows = [(i, f"{common}\nown words of text number {i}", "en", ("a", None)[i % 2]) for i in range(12)]
    rows += [(20, None, None, None), (21, "", "en", "a"), (22, "123 456", "en", "a"), (None, "no id here", "en", "a")]
    rows += [(23, "long text " * 30_000, "en", "b"), (3, rows[3][1], "en", None)]
    docs = documents(rows, clash=("row", "copies", "fp", "component_id", "score", "lines"))
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.count()
    kept = {r.doc_id for r in P.keep_known_languages(spark, docs, SF).collect()}
    assert kept == {*range(12), None, 23}
    texts = {r.doc_id: (r.text, r.n_chars) for r in P.drop_common_lines(spark, docs, SF).collect()}
    assert texts[0] == ("own words of text number 0", 26) and texts[20] == (None, None) and texts[21] == ("", 0)
    single = [r.doc_id for r in P.keep_one_of_near_copies(spark, docs, SF).collect()]
    assert single.count(3) in (0, 2) and None in single and 20 in single and 21 not in single
    assert P.pack_sequences(spark, docs, SF).count() >= len(rows)


def test_empty_documents(spark, documents):
    docs = documents([])
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0
    # Nothing to learn a language from: only texts without letters go.
    docs = documents([(1, "words", None, "a"), (2, "12", None, "a"), (3, None, None, "a")])
    assert [r.doc_id for r in P.keep_known_languages(spark, docs, SF).collect()] == [1]
    assert language.train_prototypes(docs) == {}


def test_nothing_else_imports_the_subpackage():
    outside = [p for p in (*ROOT.glob("cartwright/**/*.py"), *ROOT.glob("oracle/*.py"), ROOT / "bench.py") if "llm" not in p.parts]
    for path in outside:
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path


def test_a_run_leaves_its_result_only(spark):
    folder = pathlib.Path(work_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    (left,) = set(folder.iterdir()) - before
    assert left.name.startswith("pipeline-best_fit_packing-")


def _largest_batch(spark):
    """Bytes of the largest batch that Python gets of one task's 12 MB of texts."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    return texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]


def test_texts_reach_python_in_small_batches(spark, documents, monkeypatch):
    """Whatever a task's share of a table: the worker, its executor and pandas never hold it whole."""
    seen, usual = {}, _largest_batch(spark)

    def watched(df, label):
        seen[label] = _largest_batch(spark)
        return materialize(df, label)

    for module in (P, simhash, packing):
        monkeypatch.setattr(module, "materialize", watched)
    docs = documents([f"some words of text number {i}" for i in range(20)])
    for stage in (P.keep_known_languages, P.keep_one_of_near_copies, P.pack_sequences):
        assert stage(spark, docs, SF).count() > 0
    assert max(seen[label] for label in ("identified", "fingerprints", "pieces")) < 1.1 * runtime.BATCH_BYTES
    assert _largest_batch(spark) == usual > 4 * runtime.BATCH_BYTES


def test_prototypes_add_up_over_batches(spark, monkeypatch):
    """Few n-grams counted at a time, few texts in a batch, texts without a letter: the same prototypes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(docs.limit(3).select("doc_id", F.lit("12 3"), F.lit("none"))).coalesce(1)
    want = language.train_prototypes(docs)
    encoder, sums = language.Encoder(), {}
    for r in docs.filter("lang IS NOT NULL").collect():
        codes, counts = encoder.grams(r.text or "")
        if len(codes):
            sums[r.lang] = sums.get(r.lang, 0) + encoder.bundle(codes, counts)
    assert want == {lang: total.tolist() for lang, total in sums.items()}
    monkeypatch.setattr(runtime, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(language, "KEPT_GRAMS", 2000)
    assert language.train_prototypes(docs) == want
