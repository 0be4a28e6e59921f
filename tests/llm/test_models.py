"""Language identification, page extraction, neighbours, licences and the pipeline."""

import itertools
import random

import numpy as np
import pytest
from helpers import docs, prose
from pyspark.sql import functions as F

import corpus_pipeline
from spanquarry.llm import languages as L
from spanquarry.llm import neighbours
from spanquarry.llm.licenses import license_scan
from spanquarry.llm.neighbours import Tree, nearest
from spanquarry.llm.pages import extract_text, main_text
from spanquarry.llm.queries import QUERIES

EN = "the house stands on the hill and the wind blows through the old windows while children play with their brother in the garden"
DE = "das haus steht auf dem berg und der wind weht durch die alten fenster während kinder mit ihrem bruder im garten spielen"
RU = "дом стоит на горе и ветер дует в старые окна пока дети играют с братом в саду"


def shuffled(text, seed, n=12):
    words = text.split()
    return " ".join(random.Random(seed).choices(words, k=n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(shuffled(t, s), lang) for lang, t in (("en", EN), ("de", DE), ("ru", RU)) for s in range(60)]
    return L.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_viterbi_equals_brute_force():
    r = np.random.default_rng(1)
    texts = [r.normal(size=(n, 3)).astype(np.float32) * 3 for n in (1, 4, 6, 7, 2, 7)]
    for scores, path in zip(texts, L.viterbi(texts, 2.0)):
        def value(p, scores=scores):
            return sum(scores[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=len(scores)), key=value)
        assert value(path.tolist()) == pytest.approx(value(best), abs=1e-4)
    assert L.viterbi([]) == []
    many = np.zeros((5, 300), np.float32)
    many[:, 250] = 1
    assert L.viterbi([many])[0].tolist() == [250] * 5


def test_columns_named_like_the_result_are_replaced(spark, model):
    table = docs(spark, [(1, shuffled(EN, 500)), (2, None)]).withColumns({"lang_pred": F.lit("x"), "score": F.lit("y"), "spans": F.lit(7)})
    got = L.predict(table, model)
    assert sorted(got.columns) == sorted(table.columns) and {(r.doc_id, r.lang_pred, r.spans) for r in got.collect()} == {(1, "en", 7), (2, "und", 7)}
    assert [len(r.spans) for r in L.predict(table, model, keep_spans=True).where("doc_id = 1").collect()] == [1]
    named = L.predict(table, model).where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    assert [r.doc_id for r in named.select(table.columns).collect()] == [1]


def test_languages(spark, model):
    mixed = " ".join([shuffled(EN, 900, 20), shuffled(DE, 901, 9)])
    rows = [(1, shuffled(EN, 500)), (2, shuffled(DE, 501)), (3, shuffled(RU, 502)), (4, None), (5, ""), (6, "123 !?"), (7, mixed), (7, mixed), (8, "der"), (9, "the " * 30000)]
    table = docs(spark, rows).withColumn("spans", F.lit("x")).drop("spans")
    got = {r.doc_id: r for r in L.predict(table, model, keep_spans=True).collect()}
    assert [got[i].lang_pred for i in range(1, 10)] == ["en", "de", "ru", "und", "und", "und", "en", "de", "en"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4].score == 0
    assert [s.lang for s in got[7].spans] == ["en", "de"] and abs(got[7].spans[0].words - 20) <= 1
    assert L.predict(docs(spark, []), model).count() == 0
    none = L.fit(spark.createDataFrame([], "text string, lang string"))
    assert [r.lang_pred for r in L.predict(docs(spark, rows[:1]), none).collect()] == ["und"]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op4_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


LONG = "It was the best of the times and it was the worst of the times, and the people of the town were in it for the long run, which is what they had to say to the others in the room when they met on the hill."
PAGES = [
    (f"<html><head><title>x</title><style>p{{}}</style></head><body><nav><a href=a>Home</a></nav><article><h1>Title &amp; more</h1><p>{LONG}<p>a&nbsp; b <b>c</b>d<br>e</article><footer>c</footer>", f"Title & more\n{LONG}\na b cd e"),
    (f'<body class="has-sidebar"><div class="cookie-notice">{LONG}</div><ul class=menu><li><a href="/">Home</a></ul><div id="content"><h2>Head</h2><p>{LONG}</p><p>Short end.</p></div><aside>{LONG}</aside><section id="comments"><p>{LONG}</p></section><form>Name<input></form></body>', f"Head\n{LONG}\nShort end."),
    (f'<div><p>{LONG}</p><p><a href="x">One</a> <a href="y">Two three four five six seven eight</a></p><script>var a="</p><p>{LONG}";</script></div>', LONG),
    ("", ""), (None, ""), ("no markup", ""), ("<article>bare", "bare"), ("<article><p>a < b &lt; c &#x41;</p><!-- <p>no</p> --></article>", "a < b < c A"),
    ('<article><p title="a>b">x</p><p class=ad>y<p>z</article>', "x\nz"), ('<article><i title="oops>x</i><p>y', "x\ny"),
    (f"<main><p>{LONG}</p><article class='comment'><p>{LONG}</p></article></main>", LONG),
]


@pytest.mark.parametrize("page, want", [p for p in PAGES if p[0] is not None])
def test_main_text(page, want):
    assert main_text(page) == want


def test_extract_text(spark):
    table = spark.createDataFrame([(i, f"u{i}", p, -1) for i, (p, _) in enumerate(PAGES)], "page_id bigint, url string, html string, n_chars int")
    got = {r.page_id: r for r in extract_text(table.union(table.limit(1))).collect()}
    assert [(got[i].text, got[i].n_chars) for i in range(len(PAGES))] == [(t, len(t)) for _, t in PAGES]
    assert extract_text(table).columns == ["page_id", "url", "text", "n_chars"]
    assert extract_text(table.where("false")).count() == 0
    assert main_text("<div>" * 20000 + "x") == "" and main_text('<p a="' * 3000) == ""


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PORTION", 25)
    r = np.random.default_rng(2)
    base = r.normal(size=(1200, 16)).astype(np.float32)
    base[40] *= 9
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)] + [(2000 + i, base[40].tolist(), 1) for i in range(60)]
    bad = [(5000, None, 0), (5020, [0.0] * 16, 0), (5040, [float("nan")] + [1.0] * 15, 0), (5060, [None] + [1.0] * 15, 0), (5080, [float("inf")] * 16, 0), (None, [1.0] * 16, 0)]
    table = spark.createDataFrame(rows + bad, VECTORS).withColumn("leaf", F.lit("x"))
    got = {}
    for x in nearest(table, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    ids, matrix = np.array([i for i, *_ in rows]), np.array([v for _, v, _ in rows], np.float64)
    queries = [i for i, *_ in rows if i % 20 == 0]
    assert sorted(got) == queries
    found = 0
    for q in queries:
        v = matrix[ids == q][0]
        score = (matrix * v).sum(axis=1)
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:20]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21)) and [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)
        assert all(m[2] == pytest.approx(score[ids == m[1]][0], abs=1e-12) for m in mine)
        found += len({m[1] for m in mine} & set(ids[order].tolist()))
    assert found / (20 * len(queries)) >= 0.9
    assert [m[1] for m in sorted(got[40])] == list(range(2000, 2020))
    few = spark.createDataFrame(rows[:4], VECTORS)
    assert sorted((x.rank, x.query_id) for x in nearest(few, few.where("vec_id % 20 = 0")).collect()) == [(1, 0), (2, 0), (3, 0)]
    assert nearest(few.where("false"), few.where("false")).count() == 0


def test_recall_of_queries_that_did_not_set_the_visits(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = table.where("vec_id % 5 = 0")
    mixed = asked.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec_id", "embedding").collect()
    others = {x.vec_id: np.array(x.embedding, np.float64) for x in mixed[neighbours.CALIBRATION :][:100]}
    found = {}
    for x in nearest(table, asked).where(F.col("query_id").isin(list(others))).collect():
        found.setdefault(x.query_id, set()).add(x.vec_id)
    rows = table.select("vec_id", "embedding").toArrow()
    ids, matrix = rows.column("vec_id").to_numpy(), np.array(rows.column("embedding").to_pylist(), np.float64)
    share = []
    for q, v in others.items():
        score = np.where(ids == q, -np.inf, matrix @ v)
        share.append(len(found[q] & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    assert len(share) == 100 and np.mean(share) >= 0.9


def test_tree_visits_every_leaf_once():
    r = np.random.default_rng(3)
    tree = Tree(r.normal(size=(700, 8)), 9.0)
    for order in tree.visits(r.normal(size=(300, 8)), 10**6):
        assert sorted(order) == list(range(tree.leaves))
    query = r.normal(size=8)
    order = next(Tree.of(vars(tree)).visits(query[None], 5))
    centre = {tree.leaf[n]: c for n, c in enumerate(tree.centres)}
    unit = np.append(query / np.linalg.norm(query), 0)
    assert len(order) == 5 and np.square(centre[order[0]] - unit).sum() <= np.median([np.square(c - unit).sum() for c in centre.values()])
    assert Tree(np.ones((500, 4)), 2.0).leaves == 1


def test_licenses(spark):
    mit, gpl, apache = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."
    rows = [
        ("a/LICENSE", mit), ("a/x.txt", "code\nmore code"), ("a/b/c/y.txt", "deep"), ("a/b/z.txt", f"head\n{gpl}\nrest of it"),
        ("a/b/c/d/COPYING", gpl), ("a/b/c/d/w.txt", None), ("e/f.txt", "free"), ("LICENSE.md", apache), ("top.txt", ""), ("top.txt", ""),
        (None, "no path"), ("a/near.txt", "The license of the version is public and general"), ("g/LICENSE.a", mit), ("g/LICENSE.b", mit), ("g/h", "x"), ("mine/LICENSE", "All rights reserved"),
    ]
    table = spark.createDataFrame([(p, t, "z", 1) for p, t in rows], "path string, text string, folder string, depth int")
    got = [(r.path, r.license, r.from_path, r.inherited) for r in license_scan(table).collect()]
    want = [
        ("a/LICENSE", "MIT", "a/LICENSE", False), ("a/x.txt", "MIT", "a/LICENSE", True), ("a/b/c/y.txt", "MIT", "a/LICENSE", True),
        ("a/b/z.txt", "GPL-3.0", "a/b/z.txt", False), ("a/b/c/d/COPYING", "GPL-3.0", "a/b/c/d/COPYING", False), ("a/b/c/d/w.txt", "GPL-3.0", "a/b/c/d/COPYING", True),
        ("e/f.txt", "Apache-2.0", "LICENSE.md", True), ("LICENSE.md", "Apache-2.0", "LICENSE.md", False), ("top.txt", "Apache-2.0", "LICENSE.md", True),
        ("top.txt", "Apache-2.0", "LICENSE.md", True), (None, None, None, False), ("a/near.txt", "MIT", "a/LICENSE", True), ("g/LICENSE.a", "MIT", "g/LICENSE.a", False),
        ("g/LICENSE.b", "MIT", "g/LICENSE.b", False), ("g/h", "MIT", "g/LICENSE.a", True), ("mine/LICENSE", "Apache-2.0", "LICENSE.md", True),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert license_scan(table.where("false")).count() == 0


def test_pipeline_on_planted_cases(spark, tmp_path):
    rows = [(i, shuffled(EN if i % 2 else DE, i, 60) + " " + prose(i, 40)) for i in range(30)]
    base = rows[3][1] + " " + prose(77, 200)
    passage = prose(78, 60)
    item = prose(79, 40)
    rows += [(40, base), (41, base), (42, base.replace("w1", "q1", 1)), (50, prose(80, 50) + " " + passage), (51, passage + " " + prose(81, 80)), (60, prose(82, 90) + " " + item), (70, None), (71, "123 456"), (72, "")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, table = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        stage(spark, table, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        table = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in table.collect()}
    ids = {i for i, _ in rows}
    assert set(kept["language_id"]) == ids - {70, 71, 72}
    assert set(kept["near_dedup"]) == ids - {70, 71, 72, 41, 42}
    cut = kept["substring_dedup"]
    assert set(cut) == set(kept["near_dedup"]) and passage in cut[50].text and passage not in cut[51].text
    assert cut[51].n_chars == len(cut[51].text)
    assert set(kept["decontamination"]) == set(cut) - {60}
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == set(kept["decontamination"])
