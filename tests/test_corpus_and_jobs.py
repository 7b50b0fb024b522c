from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from checks.tables import labelled_documents
from pressmark import constants as K
from pressmark.operators import classify, linear
from pressmark.operators.folds import assign_folds
from pressmark.operators.articles import NEWS_LAYOUT
from pressmark.operators.classify import Settings
from pressmark.plans import classify_job
from pressmark.plans.import_job import ImportJob
from pressmark.sinks import render, writers
from pressmark.sources import archive, corpus
from pressmark.streaming.pages import write_rows

SMALL = Settings(max_terms=2**10)


def frame(spark, contents):
    return spark.createDataFrame(list(enumerate(contents)), "n int, content string")


def test_training_documents(spark):
    mark = K.CORPUS_MARKER + "\n"
    contents = [
        mark + "category: A b\nother\ncategory: Home Page\ncategory: A b\n" + mark + "body\nmore",
        mark + "category: Home Page\n" + mark + "x",
        "no block\n",
        mark + "category: C\nopen",
        "before\n" + mark + "category: D\n" + mark + "category: not one\n" + mark + "category: E\n" + mark,
    ]
    rows = {r["n"]: r for r in corpus.parse_training(frame(spark, contents)).collect()}
    assert [rows[i]["categories"] for i in range(5)] == [["A b", "A b"], [], [], ["C"], ["D", "E"]]
    assert rows[0]["article_body"] == "body\nmore" and rows[2]["article_body"] == "no block\n"
    assert rows[4]["article_body"] == "before\ncategory: not one\n"
    assert [rows[i]["unclosed"] for i in range(5)] == [False, False, False, True, False]
    parsed = corpus.parse_training(frame(spark, contents))
    assert tuple(corpus.label_counts(parsed).first()) == (3, 2)
    assert corpus.labelled(parsed).count() == 3


line = st.text(alphabet=st.characters(exclude_characters="\n\r\x00", exclude_categories=["Cs"]), max_size=8)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(line.filter(bool), max_size=3), st.lists(line, max_size=4)), min_size=1, max_size=20))
def test_corpus_round_trip(spark, documents):
    made = [(n, names, "\n".join(lines)) for n, (names, lines) in enumerate(documents)]
    rows = spark.createDataFrame(made, "n int, categories array<string>, body string")
    text = rows.select("n", render.training_document(F.col("categories"), F.col("body")).alias("content"))
    found = {r["n"]: r for r in corpus.parse_training(text, excluded=()).collect()}
    for n, names, body in made:
        assert (found[n]["categories"], found[n]["article_body"]) == (names, body + "\n")


def by_lines(content):
    metadata, body, seen = "", "", 0
    for part in content.splitlines(keepends=True):
        if part.rstrip("\n") == "---":
            seen += 1
        elif seen == 1:
            metadata += part
        else:
            body += part
    return metadata, body


def test_front_matter(spark):
    contents = [
        "---\na: 1\nb: 2\n---\n<p>x &amp; é</p>\ny", "no marker\n", "---\nonly one\n", "a\n---\nb\n---\nc\n---\nd\n---",
        "---\n---\n", "", "text before\n---\nm\n---", "---\n----\n ---\n---\nz", "---", "---\n---\n---\n---\nx",
    ]
    rows = {r["n"]: r for r in corpus.parse_front_matter(frame(spark, contents)).collect()}
    for n, content in enumerate(contents):
        assert (rows[n]["metadata"], rows[n]["article_body"]) == by_lines(content), content
    assert rows[0]["article_body_no_html"] == "x  e\ny"


@pytest.fixture(scope="module")
def learnable(spark):
    made = []
    for n in range(60):
        labels = ["all"] + (["cats"] if n % 2 else ["dogs"]) + (["big"] if n % 3 == 0 else [])
        words = ("purring whiskers " if n % 2 else "barking leash ") + ("enormous huge " if n % 3 == 0 else "tiny ")
        made.append((n, labels, words + f"word{n % 7}"))
    return spark.createDataFrame(made, "doc_id long, categories array<string>, text string")


@pytest.mark.parametrize("terms", [2**10, 16])
def test_fit_save_load_predict(spark, learnable, tmp_path, terms):
    settings = Settings(max_terms=terms)
    path = str(tmp_path / "model")
    model = classify.load_or_fit(learnable, path, "text", settings)
    assert [kind for _, _, kind in model.index] == ["always", "svm", "svm", "svm"]
    again = classify.load_or_fit(learnable.limit(0), path, "text", settings)
    first = {r["doc_id"]: r["categories"] for r in model.predict(learnable, "text", ["doc_id"]).collect()}
    second = {r["doc_id"]: r["categories"] for r in again.predict(learnable, "text", ["doc_id"]).collect()}
    assert first == second
    if terms > 100:
        assert all(sorted(first[r["doc_id"]]) == sorted(r["categories"]) for r in learnable.collect())


def _solved(x, y, penalty):
    """The least value of the objective, by Newton steps over dense rows with a constant column."""
    w = np.zeros(x.shape[1])
    for _ in range(100):
        slack = np.maximum(0, 1 - y * (x @ w))
        on = slack > 0
        slope = w - 2 * penalty * x[on].T @ (y * slack)[on]
        w = w - np.linalg.solve(np.eye(len(w)) + 2 * penalty * x[on].T @ x[on], slope)
    slack = np.maximum(0, 1 - y * (x @ w))
    return w, 0.5 * w @ w + penalty * slack @ slack


@pytest.mark.parametrize("fold", [-1, 1])
def test_problems_are_solved_together(spark, fold):
    pick = np.random.default_rng(4)
    rows = []
    for i in range(150):
        terms = sorted(pick.choice(30, size=pick.integers(0, 9), replace=False).tolist())
        labels = [label for label in range(4) if pick.random() < 0.1 + 0.6 * (label in terms)]
        rows.append((int(pick.integers(0, 3)), labels, terms, pick.integers(1, 4, len(terms)).tolist()))
    table = spark.createDataFrame(rows, "fold int, labels array<int>, terms array<int>, tf array<int>").repartition(5)
    scale = pick.random(30) + 0.5
    problems = linear.Problems(np.arange(4), np.full(4, fold), np.array([fold]), scale[None, :])
    found = linear.fit_together(table, problems, 4, 1.0, 1e-6, 300)
    kept = [r for r in rows if r[0] != fold]
    x = np.zeros((len(kept), 31))
    for own, row in zip(x, kept):
        own[row[2]] = np.array(row[3]) * scale[row[2]]
        own[:] /= max(np.linalg.norm(own), 1e-12)
        own[30] = 1
    for label in range(4):
        y = np.array([1.0 if label in r[1] else -1.0 for r in kept])
        w, value = _solved(x, y, 1.0)
        slack = np.maximum(0, 1 - y * (x @ found.weights[label]))
        assert 0.5 * found.weights[label] @ found.weights[label] + slack @ slack <= value * (1 + 1e-6)
        assert np.abs(found.weights[label] - w).max() < 1e-3
    assert (found.slopes <= 1e-6).all()
    with pytest.raises(linear.NotConverged, match="4 of 4"):
        linear.fit_together(table, problems, 4, 1.0, 1e-6, 2)


def test_folds_together_equal_folds_apart(spark, learnable):
    settings = Settings(max_terms=2**10, tolerance=1e-5)
    folds = assign_folds(learnable, 3, seed=5)
    rows = learnable.join(folds.drop("position"), "doc_id").cache()
    together = {(r["fold"], r["label"]): (r["tp"], r["fp"], r["fn"]) for r in classify.cross_validate(learnable, 3, settings=settings, seed=5).collect()}
    for fold in range(3):
        model = classify.fit(rows.where(F.col("fold") != fold), "text", settings)
        said = {r["doc_id"]: set(r["categories"]) for r in model.predict(rows.where(F.col("fold") == fold), "text", ["doc_id"]).collect()}
        truth = {r["doc_id"]: set(r["categories"]) for r in rows.where(F.col("fold") == fold).collect()}
        for label in ("all", "big", "cats", "dogs"):
            assert together[fold, label] == tuple(
                sum(label in said[d] and label in truth[d] if k == 0 else label in said[d] and label not in truth[d] if k == 1
                    else label not in said[d] and label in truth[d] for d in truth) for k in range(3))


@pytest.mark.parametrize("features", ["hashed", "vocabulary"])
def test_tables_score_as_the_model_in_memory(spark, learnable, tmp_path, features):
    model = classify.fit(learnable, "text", Settings(features=features, max_terms=2**10))
    path = str(tmp_path / "model")
    model.save(spark, path)
    odd = spark.createDataFrame([(1000, "unknown words only"), (1001, None), (1002, "")], "doc_id long, text string")
    documents = learnable.select("doc_id", "text").unionByName(odd)
    again = classify.load(spark, path)
    kept = [m.scores(classify.with_terms(documents, "text"), ["doc_id"]).collect() for m in (model, again)]
    first, second = ({r["doc_id"]: r["scores"] for r in rows} for rows in kept)
    names = [category for _, category, _ in model.index]
    by_table = {(r["doc_id"], r["category"]): r["score"] for r in classify.score_by_tables(documents, path).collect()}
    assert len(by_table) == len(names) * documents.count()
    for doc, scores in first.items():
        assert np.allclose(scores, second[doc], atol=1e-12)
        assert np.allclose(scores, [by_table[doc, name] for name in names], atol=1e-9)
    with pytest.raises(ValueError, match="score_by_tables"):
        classify.load(spark, path, Settings(broadcast_bytes=10)).scores(documents, ["doc_id"])


def test_features_are_chosen_by_the_caller(spark, learnable):
    exact = Settings(features="vocabulary", max_terms=2**10)
    model = classify.fit(learnable, "text", exact)
    found = {r["doc_id"]: sorted(r["categories"]) for r in model.predict(learnable, "text", ["doc_id"]).collect()}
    assert found == {r["doc_id"]: sorted(r["categories"]) for r in learnable.collect()}
    with pytest.raises(ValueError, match="terms"):
        classify.fit(learnable, "text", Settings(features="vocabulary", max_terms=10))
    with pytest.raises(ValueError, match="features"):
        classify.fit(learnable, "text", Settings(features="other"))
    with pytest.raises(ValueError, match="labels"):
        classify.fit(learnable, "text", Settings(max_labels=3))


def test_a_fit_separates_languages_on_its_training_rows(spark):
    folder = "/root/testdata/sf0.01"
    documents = labelled_documents(spark, folder)
    languages = ["de", "en", "es", "fr"]
    only = documents.withColumn("categories", F.filter("categories", lambda c: c.isin(languages))).cache()
    found = classify.fit(only, "text").predict(only, "text", ["doc_id"]).collect()
    wanted = {r["doc_id"]: r["categories"] for r in only.collect()}
    wrong = [r for r in found if list(r["categories"]) != list(wanted[r["doc_id"]])]
    assert len(found) == 399 and len(wrong) <= 2


def test_written_documents_are_read_back(spark, tmp_path):
    names = [f"doc {n}%2F+é={n}.md" if n % 5 == 0 else f"doc-{n}.md" for n in range(1000)]
    rows = [(name, f"---\ntitle: {n}\n---\nbody {n}\n") for n, name in enumerate(names)]
    documents = spark.createDataFrame(rows, "file_name string, content string").repartition(4)
    writers.write_texts(documents, str(tmp_path / "out"))
    found = {r["filename"]: r["article_body"] for r in classify_job.unlabelled_documents(spark, str(tmp_path / "out")).collect()}
    assert {k: v.strip() for k, v in found.items()} == {name: f"body {n}" for n, name in enumerate(names)}
    plain = tmp_path / "plain" / "deep"
    plain.mkdir(parents=True)
    (plain / "a b.md").write_text("---\nx: 1\n---\ny\n")
    assert [r["filename"] for r in classify_job.unlabelled_documents(spark, str(tmp_path / "plain")).collect()] == ["a b.md"]


def test_named_files(spark, tmp_path):
    def listing():
        return sorted(f.name for f in tmp_path.iterdir() if not f.name.startswith("."))

    rows = [(f"import-{n}.xml", f"<a>{n}</a>\n") for n in range(30)] + [("a b=%2F+é.xml", "x")]
    files = spark.createDataFrame(rows, "file_name string, content string").repartition(3)
    failing = files.withColumn("content", F.when(F.col("file_name") == "import-7.xml", F.raise_error(F.lit("no"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="no"):
        writers.write_named_texts(failing, str(tmp_path))
    assert listing() == []
    writers.write_named_texts(files, str(tmp_path))
    assert listing() == sorted(name for name, _ in rows)
    assert (tmp_path / "import-7.xml").read_text() == "<a>7</a>\n"
    with pytest.raises(ValueError, match="2 files"):
        writers.write_named_texts(files.where("file_name = 'import-1.xml'").unionByName(files).repartition(8), str(tmp_path))
    assert listing() == sorted(name for name, _ in rows)
    writers.write_named_texts(files.limit(0), str(tmp_path / "none"))


def test_packed_documents(spark, tmp_path):
    documents = spark.range(100_000).selectExpr(
        "concat('doc-', id % 99990, '.md') file_name", "concat('---\ntitle: ', id, '\n---\nbody ', id, '\n') content")
    writers.write_packed(documents, str(tmp_path / "packed"))
    assert len(list((tmp_path / "packed").glob("part-*"))) < 100
    found = corpus.read_packed(spark, str(tmp_path / "packed")).withColumnRenamed("path", "file_name")
    assert found.count() == 100_000 and found.exceptAll(documents).isEmpty()
    parsed = classify_job.unlabelled_documents(spark, str(tmp_path / "packed"), packed=True)
    row = parsed.where("filename = 'doc-99989.md'").first()
    assert (row["metadata"], row["article_body"]) == ("title: 99989\n", "body 99989\n")


def test_cross_validation(spark, learnable):
    rows = classify.cross_validate(learnable, 2, settings=SMALL, seed=1).collect()
    assert {(r["fold"], r["label"]) for r in rows} == {(f, c) for f in (0, 1) for c in ("all", "big", "cats", "dogs")}
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == 30 for r in rows)
    assert all(r["f1"] > 0.9 for r in rows)


def texts_below(folder: Path) -> dict[str, str]:
    return {
        part.parent.name.split("=", 1)[1]: part.read_text()
        for part in folder.rglob("part-*.txt")
    }


def test_classify_job(spark, learnable, tmp_path):
    training, documents = tmp_path / "corpus", tmp_path / "new"
    for row in learnable.collect():
        folder = training / f"{row['doc_id'] % 3}"
        folder.mkdir(parents=True, exist_ok=True)
        head = "".join(f"category: {c}\n" for c in [*row["categories"], "Home Page"])
        (folder / f"{row['doc_id']}.txt").write_text(f"{K.CORPUS_MARKER}\n{head}{K.CORPUS_MARKER}\n{row['text']}\n")
    (training / "none.txt").write_text(f"{K.CORPUS_MARKER}\ncategory: Home Page\n{K.CORPUS_MARKER}\nx\n")
    documents.mkdir()
    (documents / "new.md").write_text("---\ntitle: T\n---\n<b>purring</b> whiskers tiny\n")
    assert classify_job.training_set(spark, str(training)).count() == 60
    classify_job.run(spark, str(training), str(documents), str(tmp_path / "model"), str(tmp_path / "out"), SMALL)
    assert texts_below(tmp_path / "out") == {
        "new.md": "---\ntitle: T\ncategories:\n  - name: all\n    nicename: all\n  - name: cats\n    nicename: cats\n"
        "---\n<b>purring</b> whiskers tiny\n"
    }


def article(day: str, body: str) -> str:
    return (
        f'<meta name="category" content="News"><div id="main"><h1 id="title">T & "{body}"</h1><p class="date">{day}</p>'
        f'<figure class="article-image"><img src="i.png" width=1 height=2></figure>'
        f'<div class="article-body"><p>{body}]]></p></div></div>'
    )


@pytest.fixture(scope="module")
def site(spark):
    listing = '<ul class="archive-list"><a href="a.html">a</a><a href="b.html">b</a><a href="gone.html">g</a></ul>'
    made = [
        (1, "http://h/2011/03/", listing),
        (2, "http://h/2011/03/a.html", article("March 1, 2011", "old")),
        (3, "http://h/2011/03/a.html", article("March 1, 2011", "new")),
        (4, "http://h/2011/03/b.html", article("March 2, 2011", "bee")),
        (5, "http://h/2011/03/gone.html", "<p>gone</p>"),
        (6, "http://h/2011/03/unlinked.html", article("March 2, 2011", "no")),
    ]
    return spark.createDataFrame(made, "n int, url string, html string")


def test_import_job(spark, site, tmp_path):
    job = ImportJob("http://h/", "http://up/", limit=10)
    job.run(site, *archive.month_range("01/2011", "04/2011"), order="n", target=str(tmp_path), start_index=7, markdown=True)
    files = {file.name: file.read_text() for file in (tmp_path / "import").iterdir() if not file.name.startswith(".")}
    # a limit below the header's size closes the first file before its first item
    assert sorted(files) == ["import-1.xml", "import-2.xml"]
    first = files["import-1.xml"]
    assert first.startswith('<?xml version="1.0" encoding="UTF-8"?>\n<rss') and first.endswith("</channel>\n</rss>\n\n")
    assert "<title>T &amp; 'new'</title>" in first and "new]]]]><![CDATA[></p>" in first
    assert "<wp:post_id>9</wp:post_id>" in first and "<wp:post_id>8</wp:post_id>" in first
    assert "<wp:post_parent>9</wp:post_parent>" in first
    assert "<link>http://up/2011/03/a.html/attachment/8/</link>" in first
    assert "http://up/wp-content/uploads/2011/03/i.png" in first
    notes = texts_below(tmp_path / "markdown")
    assert sorted(notes) == ["2011-03-01-a.md", "2011-03-02-b.md"]
    assert 'src="http://up/2011/03/i.png"' in notes["2011-03-02-b.md"]
    assert notes["2011-03-02-b.md"].endswith(
        '<p><a href="http://h/2011/03/b.html" title="Permalink to b">Source</a></p>\n'
    )
    rejected = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [tuple(r) for r in rejected] == [("http://h/2011/03/gone.html", "no main section")]


def test_pages_of_a_range_are_not_shuffled(spark, site, tmp_path):
    site.write.parquet(str(tmp_path / "site"))
    job = ImportJob("http://h/", "http://up/")
    rows = job.rows(spark.read.parquet(str(tmp_path / "site")), *archive.month_range("03/2011", "03/2011"), "n")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    physical = rows._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
    assert "http://h/2011/03/unlinked.html" not in {r["url"] for r in rows.collect()}


def test_save_training_set(spark, site, tmp_path):
    articles = ImportJob("http://h/", "http://up/").articles(site, *archive.month_range("03/2011", "03/2011"), "n")
    classify_job.save_training_set(articles, str(tmp_path / "set"))
    found = {Path(r["path"]).parent.name: r for r in classify_job.training_set(spark, str(tmp_path / "set")).collect()}
    assert {name.split("=")[1] for name in found} == {"2011-03-01-a.md", "2011-03-02-b.md"}
    assert all(r["categories"] == ["News"] for r in found.values())


def test_stream_of_pages(spark, site, tmp_path):
    site.drop("n").repartition(3).write.parquet(str(tmp_path / "in"))
    pages = spark.readStream.schema("url string, html string").parquet(str(tmp_path / "in"))
    write_rows(pages, str(tmp_path / "out"), str(tmp_path / "state"), NEWS_LAYOUT).awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 6 and sum(r["reason"] is None for r in rows) == 4


def test_a_model_beyond_memory_scores_from_its_tables(spark, learnable, tmp_path):
    path = str(tmp_path / "model")
    classify.fit(learnable, "text", Settings(features="vocabulary", max_terms=2**10)).save(spark, path)
    odd = spark.createDataFrame([(7, "unknown words only"), (7, None), (None, "")], "doc_id long, text string")
    prepared = classify.with_terms(learnable.select("doc_id", "text").unionByName(odd), "text")
    stored = classify.load_stored(spark, path, Settings(broadcast_bytes=10))
    assert isinstance(stored, classify.StoredClassifier) and isinstance(classify.load_stored(spark, path), classify.Classifier)
    first, second = (
        sorted(((r["doc_id"] is None, r["doc_id"] or 0, np.round(r["scores"], 9).tolist()) for r in m.scores(prepared, ["doc_id"]).collect()))
        for m in (classify.load(spark, path), stored))
    assert first == second


def test_terms_are_counted_some_at_a_time(spark, learnable, monkeypatch):
    def counted():
        terms = classify.counted_terms(spark, F.col("terms"), Settings(max_terms=2**10), None)
        rows = classify.with_terms(learnable, "text").select("doc_id", terms.alias("c")).orderBy("doc_id").collect()
        return [(r["doc_id"], r["c"]["terms"], r["c"]["tf"]) for r in rows]

    import pyarrow as pa

    lists = pa.array([[1, 2, 3], [], [4], None, [5, 6], [7]])
    monkeypatch.setattr(linear, "_CHUNK", 3)
    assert [(s.start, s.stop) for s in linear.stretches(lists)] == [(0, 2), (2, 5), (5, 6)]
    assert [(s.start, s.stop) for s in linear.stretches(lists.slice(2, 3))] == [(0, 3)]
    few = counted()
    monkeypatch.setattr(linear, "_CHUNK", 1 << 20)
    assert few == counted()


def test_a_group_of_problems_keeps_its_folds_only():
    problems = linear.Problems(np.array([0, 1, 0, 1]), np.array([0, 0, 2, 2]), np.array([0, 1, 2]), np.arange(6.0).reshape(3, 2))
    own = problems.only(np.array([3]))
    assert own.folds.tolist() == [2] and own.scales.tolist() == [[4.0, 5.0]] and own.fold.tolist() == [2]
    assert 78 * (2**18 + 1) * linear.STATE_BYTES > 3 * Settings().fit_bytes


def test_terms_are_dealt_to_more_tasks_as_texts_grow(spark, monkeypatch):
    from pressmark.operators import tfidf

    documents = spark.createDataFrame([(1, "aa bb aa"), (1, "bb"), (None, "cc"), (2, None)], "doc_id long, text string")
    for stored in (1, 100 * tfidf._PART_BYTES):
        monkeypatch.setattr("pressmark.session._stored_bytes", lambda df: stored)
        counts = tfidf.term_counts(documents)
        assert counts.rdd.getNumPartitions() == max(stored // tfidf._PART_BYTES, spark.sparkContext.defaultParallelism)
        assert sorted((r["doc_id"] or 0, r["term"], r["tf"]) for r in counts.where("not term like '% %'").collect()) == [
            (0, "cc", 1), (1, "aa", 2), (1, "bb", 2)]


def test_a_pass_sums_in_a_task_a_core_and_one_fit_makes_room_for_the_next(spark, monkeypatch):
    """Sums of all problems leave each task: their number must not follow that of the files."""
    rows = [(i % 3, [label for label in range(3) if i % (label + 2) == 0], [i % 2, 2 + i % 3, 5 + i % 5], [1, 2, 1]) for i in range(200)]
    table = spark.createDataFrame(rows, "fold int, labels array<int>, terms array<int>, tf array<int>").repartition(30)

    @F.arrow_udf("binary")
    def bytes_of(column: pa.Array) -> pa.Array:
        return linear.packed(column)

    packed = table.select("fold", "labels", bytes_of("terms").alias("terms"), bytes_of("tf").alias("tf"))
    problems = linear.Problems(np.array([0, 1, 2, 0]), np.array([-1, -1, -1, 1]), np.array([-1, 1]), np.ones((2, 10)))
    parts = []
    real = type(packed).mapInArrow

    def noted(df, function, schema, *args, **kwargs):
        if "places" in schema:
            parts.append(df.rdd.getNumPartitions())
        return real(df, function, schema, *args, **kwargs)

    monkeypatch.setattr(type(packed), "mapInArrow", noted)
    passed = linear.losses_and_slopes
    trial = np.random.default_rng(1).standard_normal((4, 11)).astype(np.float32)
    for squares in (False, True):
        a, b = (passed(t, problems, trial, 1.0, 3, squares) for t in (table, packed))
        assert np.allclose(a[0], b[0]) and np.allclose(a[1], b[1], atol=1e-4)
    assert parts == [min(30, spark.sparkContext.defaultParallelism)] * 4
    monkeypatch.undo()
    few = packed.coalesce(2).cache()
    together = linear.fit_together(few, problems, 3, 1.0, 1e-3, 100)
    apart = linear.fit_together(few, problems, 3, 1.0, 1e-3, 100, held=3)
    assert np.allclose(together.weights, apart.weights, atol=1e-3) and (apart.slopes <= 1e-3).all()
    assert together.passes <= apart.passes < 2 * together.passes


@pytest.mark.parametrize("weights", [0, 40, 2**21])
def test_terms_of_scores_by_tables_are_not_shuffled_by_document(spark, learnable, tmp_path, monkeypatch, weights):
    model = classify.fit(learnable, "text", Settings(features="vocabulary", max_terms=2**10))
    path = str(tmp_path / "model")
    model.save(spark, path)
    monkeypatch.setattr(classify, "_BROADCAST_WEIGHTS", weights)
    documents = learnable.select("doc_id", "text")
    twice = documents.unionByName(documents.limit(3)).unionByName(spark.createDataFrame([(None, "cats and dogs")], "doc_id long, text string"))
    scored = classify.score_by_tables(twice, path)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert not any("hashpartitioning(doc_id" in line and "term" in line.split("hashpartitioning(doc_id")[1].split(")")[0] for line in plan.splitlines())
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["category"], r["score"]) for r in scored.collect())
    memory = {r["doc_id"]: r["scores"] for r in model.scores(classify.with_terms(documents, "text"), ["doc_id"]).collect()}
    names = [category for _, category, _ in model.index]
    assert len(found) == len(names) * twice.count()
    for doc, category, score in found:
        wanted = model.intercepts if doc == -1 else memory[doc]
        assert abs(score - wanted[names.index(category)]) < 1e-9


def test_terms_go_to_the_parts_of_a_model_once(spark, learnable, tmp_path, monkeypatch):
    from pressmark.operators import tfidf

    model = classify.fit(learnable, "text", Settings(features="vocabulary", max_terms=2**10))
    path = str(tmp_path / "model")
    model.save(spark, path)
    sent = []
    real = type(learnable).mapInArrow

    def noted(df, function, schema, *args, **kwargs):
        out = real(df, function, schema, *args, **kwargs)
        sent.append(out)
        return out

    monkeypatch.setattr(type(learnable), "mapInArrow", noted)
    monkeypatch.setattr(classify, "_ROWS", 3)
    monkeypatch.setattr(classify, "_CELLS", 1)
    monkeypatch.setattr(classify, "_PART_TEXT", 1)  # every part is held by several tasks
    extra = spark.createDataFrame([(2000, "zzunknown zzwords"), (2001, "zzunknown " * 50)], "doc_id long, text string")
    documents = learnable.select("doc_id", "text").unionByName(extra)
    monkeypatch.setattr(tfidf, "parts", lambda documents: 1)
    monkeypatch.setattr(tfidf, "_PART_BYTES", 20)
    scored = classify.score_by_tables(documents, path)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "(term#" in line]
    asked, back = sent
    rows = [(r["key"], r["part"], r["text"].split("\n")) for r in asked.collect()]
    assert len({(key, part) for key, part, _ in rows}) == len(rows)
    known = set(model.vocabulary)
    wanted = {(r["doc_id"], t) for r in classify.with_terms(documents, "text").collect() for t in r["terms"] if t in known}
    assert wanted <= {(key, t) for key, _, terms in rows for t in terms}
    assert not [key for key, _, _ in rows if key >= 2000]
    assert back.count() <= len(rows)
    found = {(r["doc_id"], r["category"]): r["score"] for r in scored.collect()}
    names = [category for _, category, _ in model.index]
    for r in model.scores(classify.with_terms(documents, "text"), ["doc_id"]).collect():
        assert np.allclose(r["scores"], [found[r["doc_id"], n] for n in names], atol=1e-9)


def test_few_rows_are_fitted_whole_in_tasks(spark, monkeypatch):
    """No pass of its own is a job where all rows fit a task; more rows take the same steps in jobs."""
    pick = np.random.default_rng(6)
    rows = []
    for i in range(200):
        terms = sorted(pick.choice(400, size=pick.integers(0, 40), replace=False).tolist())
        rows.append((int(i % 3), [label for label in range(3) if pick.random() < 0.2 + 0.6 * (label in terms)], terms, pick.integers(1, 300, len(terms)).tolist()))
    table = spark.createDataFrame(rows, "fold int, labels array<int>, terms array<int>, tf array<int>").repartition(5).cache()
    scale = pick.random((3, 400)) + 0.5
    problems = linear.Problems(np.tile(np.arange(3), 3), np.repeat(np.arange(3), 3), np.arange(3), scale)
    apart = linear.fit_together(table, problems, 3, 1.0, 1e-6, 300)
    monkeypatch.setattr(linear, "losses_and_slopes", None)
    terms = sum(len(r[2]) for r in rows)
    for piece, state in ((1 << 15, linear._TASK_STATE), (7, 0)):
        monkeypatch.setattr(linear, "_PIECE", piece)
        monkeypatch.setattr(linear, "_CHUNK", 64 * piece)
        monkeypatch.setattr(linear, "_TASK_STATE", state)
        found = linear.fit_together(table, problems, 3, 1.0, 1e-6, 300, terms=terms)
        assert np.allclose(found.weights, apart.weights, atol=1e-4) and (found.slopes <= 1e-6).all()
        loose = linear.fit_together(table, problems, 3, 1.0, 1e-3, 300, terms=terms)
        assert (loose.slopes <= 1e-3).all() and np.abs(loose.weights - apart.weights).max() < 0.1
    with pytest.raises(linear.NotConverged, match="[89] of 9"):
        linear.fit_together(table, problems, 3, 1.0, 1e-6, 2, terms=terms)
    with pytest.raises(TypeError):
        linear.fit_together(table, problems, 3, 1.0, 1e-6, 300, terms=linear._WHOLE + 1)


def test_rows_sum_alike_by_row_and_by_term(monkeypatch):
    monkeypatch.setattr(linear, "_PIECE", 50)
    monkeypatch.setattr(linear, "_CHUNK", 300)
    pick = np.random.default_rng(2)
    lists = [np.sort(pick.choice(90, size=n, replace=False)) for n in pick.integers(0, 60, 40)]
    tf = [pick.integers(1, 70_000, len(x)) for x in lists]
    columns = [pa.array([x.tolist() for x in y], pa.list_(pa.int32())) for y in (lists, tf)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 40, pa.int32()), pa.array([[i % 2] for i in range(40)], pa.list_(pa.int32())), *columns], names=["fold", "labels", "terms", "tf"])
    chunks = list(linear.chunks_of(batch, 2))
    dense = np.zeros((40, 90))
    for line, x, n in zip(dense, lists, tf):
        line[x] = n
    again = [linear._from_bytes(pa.py_buffer(linear._to_bytes(own))) for own in chunks]
    for a, b in zip(chunks, again):
        assert (a.terms == b.terms).all() and (a.tf == b.tf).all() and (a.at == b.at).all() and (a.marks == b.marks).all()
    assert len(chunks) > 3 and np.concatenate([own.marks[1] for own in again]).tolist() == [-1, 1] * 20
    tables, pulled = pick.standard_normal((5, 90)), pick.standard_normal((5, 40))
    pulled[:2, 5:] = 0
    columns = linear.Columns(again)
    margins = np.concatenate([own.margins(tables, wide=w) for own in chunks for w in [np.ascontiguousarray(tables.T)]], axis=1)
    for power in (1, 2):
        slopes = np.zeros((2, 5, 90))
        first = 0
        for own in chunks:
            own.add_slopes(pulled[:, first : first + len(own.folds)], slopes[0], power)
            first += len(own.folds)
        columns.add_slopes(pulled, slopes[1], power)
        assert np.allclose(slopes, pulled @ dense**power)
        plain = np.concatenate([own.margins(tables, power) for own in chunks], axis=1)
        assert np.allclose(plain, tables @ dense.T**power) and np.allclose(columns.margins(tables, power), plain)
    assert np.allclose(margins, tables @ dense.T)
