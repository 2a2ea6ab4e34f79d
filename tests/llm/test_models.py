"""Toxicity, language, nearest neighbours, HTML and the pipeline."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from docfold.llm import folds, graphann, htmltext, langid, minmax, toxicity
from docfold.llm.catalog import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def is_held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_fold(spark):
    rows = spark.createDataFrame([(i,) for i in [0, 1, 17, 123456, -3, None]], "doc_id long").withColumn("h", folds.held_out(F.col("doc_id")))
    assert all(r.h == is_held_out(r.doc_id) for r in rows.collect())


def test_toxicity_on_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    extra = spark.createDataFrame([(None, None, "x"), (77_000_001, "", "x"), (77_000_002, "idiot idiot", "x")], "doc_id long, text string, source string")
    learned = toxicity.learn(docs, labels)
    got = toxicity.score(docs.select("doc_id", "text").unionByName(extra.select("doc_id", "text")), learned).collect()
    assert len(got) == docs.count() + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    score = {r.doc_id: r.predicted for r in got}
    assert score[None] == score[77_000_001] == 0
    known = {r.doc_id: r.toxic for r in labels.collect() if is_held_out(r.doc_id)}
    right = [score[i] == y for i, y in known.items() if i in score]
    assert sum(right) / len(right) >= 0.95 and not any(score[i] for i, y in known.items() if i in score and not y)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), labels)).count() == 0


def test_label_model_discounts_voters_that_repeat_each_other(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(4000):
        toxic = rng.random() < 0.2
        one, other = rng.random() < (0.6 if toxic else 0.02), rng.random() < (0.6 if toxic else 0.02)
        bits = one * 0b111 | other * 0b1000        # voters 0-2 say the same
        rows.append((int(bits or 1 << toxicity.SILENT), -1, 1))
    model = toxicity.fit_labels(spark.createDataFrame(rows, "votes long, label long, n long"))
    assert model.weight[3] > 2 * model.weight[0] and model.speaks[1][0] > 10 * model.speaks[0][0]
    p = model.posterior(toxicity.unpacked(np.array([0b1000, 1 << toxicity.SILENT])))
    assert p[0] > 0.5 > p[1]


def test_language_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None), (88_000_001, ""), (88_000_002, "12 34 !?"), (88_000_003, "\n" * 10)], "doc_id long, text string")
    got = langid.predict(docs.select("doc_id", "text").unionByName(odd), langid.learn(docs)).collect()
    true = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.doc_id in true and r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) / len(held) >= 0.98
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id not in true) and all(0 <= r.score <= 1 for r in got)
    nothing = langid.predict(odd, langid.learn(odd.withColumn("lang", F.lit(None).cast("string"))))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_nearest_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 12)) * rng.uniform(0.5, 2, (700, 1))
    x[300:360] = x[7]                                                  # one vector many times
    rows = [(i, [float(v) for v in y]) for i, y in enumerate(x)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 12), (1003, [float("nan")] * 12), (1004, [None] * 12), (1005, [1.0]), (None, [1.0] * 12), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict[int, list] = {}
    for r in graphann.nearest(df, df.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 700, 20))
    recall = []
    for q, found in got.items():
        s = x @ x[q]
        assert [f[0] for f in sorted(found)] == list(range(1, 21)) and all(f[1] != q and f[2] == pytest.approx(s[f[1]], abs=1e-9) for f in found)
        assert [f[1:] for f in sorted(found)] == sorted((f[1:] for f in found), key=lambda f: (-f[1], f[0]))
        s[q] = -np.inf
        recall.append(np.mean([s[f[1]] >= np.sort(s)[-20] - 1e-9 for f in found]))
    assert np.mean(recall) >= 0.95
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert graphann.nearest(few, few.where("vec_id = 0"), 20).count() == 2 and graphann.nearest(few.limit(0), few.limit(0), 20).count() == 0


def test_blocks_of_broken_markup():
    text = lambda page: [t for _, t in htmltext.blocks(page)]
    assert text("") == [] and text("plain") == ["plain"]
    assert text("<p>a<b>b</b> c<br>d<p>e &amp; f&lt;g&gt;</p>") == ["ab c d", "e & f<g>"]
    assert text("<script>x='<p>no</p>'</script><p>yes<!-- <p>no -->!") == ["yes!"]
    assert text("<div><p>cut off &am") == ["cut off &am"] and text("a<div class='x") == ["a"] and text("a<!-- open <p>b") == ["a"]
    assert text("<ul><li>1<li>2</ul>3") == ["1", "2", "3"] and text("1 < 2 <p>\xa0&nbsp;x\n\ty</p>") == ["1 < 2", "x y"]
    place, _ = htmltext.blocks('<div class="Side-Bar big" id=q><span>x</span></div>')[0]
    assert place == htmltext.place_of(("div.side.bar.big.q", "span"))


def test_custom_elements_and_self_closed_drawings_keep_what_follows():
    text = lambda page: [t for _, t in htmltext.blocks(page)]
    for tag in ("<svg-icon name=x></svg-icon>", "<template-card>", "<math-field/>", "<svg/>", "<svg class='>' />", "<MATH x=1 />"):
        assert text(f"<p>a</p>{tag}<p>rest of article</p>") == ["a", "rest of article"], tag
    for tag in ("<svg><p>no</p></svg>", "<svg href=a/><p>no</p></svg>", "<svg x='/>'><p>no</p></svg>", "<script/><p>no</p></script>", "<math\n><p>no</p></math >"):
        assert text(f"<p>a</p>{tag}<p>rest of article</p>") == ["a", "rest of article"], tag


def test_main_text_of_pages(spark):
    import brute

    pages = table(spark, SF, "pages")
    weights = htmltext.learn(pages)
    odd = spark.createDataFrame([(None, None, None), (1_000_001, "u", ""), (1_000_002, "u", "<p>" + "x " * 60_000)], pages.schema)
    got = htmltext.extract(pages.unionByName(odd), weights).collect()
    assert len(got) == pages.count() + 3 and all(r.n_chars == len(r.text) for r in got)
    html = {r.page_id: r.html for r in pages.collect()}
    for r in got:
        if r.page_id in html:
            assert r.text == "\n".join(brute.article_blocks(html[r.page_id]))
    assert [r.text for r in got if r.page_id in (None, 1_000_001)] == ["", ""]
    assert htmltext.extract(pages.limit(0), htmltext.learn(pages.limit(0))).count() == 0


def test_the_network_learns_furniture_by_many_names(spark):
    rng = np.random.default_rng(5)
    pages = [r.html for r in table(spark, SF, "pages").limit(60).collect()]
    net, encoder = htmltext.Labeller(htmltext.train(pages)), htmltext.Encoder()
    made = [htmltext.rewrapped(htmltext.blocks(p), rng) for p in pages]
    wrong = sum(int((keep != [not htmltext.is_furniture(p) for p, _ in page]).sum()) for page, keep in zip(made, htmltext.label(made, net, encoder)))
    assert wrong / sum(map(len, made)) < 0.05


def test_pipeline_against_plain_python(spark, tmp_path):
    """Each stage against brute force on its own input."""
    import brute

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    vocabulary = [word() for _ in range(400)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bad = ["grunkle", "snarf", "blorf", "zwark"]
    docs, labels = [], []
    for i in range(300):
        text = "\n".join(line(rng.randint(8, 30)) for _ in range(rng.randint(1, 4)))
        toxic = i % 4 == 0
        if toxic:
            text += " " + " ".join(rng.sample(bad, 2))
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    items = [(k, line(20)) for k in range(3)]
    clean = [d for d in docs if d[0] % 4][:12]
    docs += [(1000 + d[0], d[1], "en", "s0", d[4]) for d in clean[:4]]                                 # copies
    docs += [(2000 + d[0], d[1].replace(d[1].split()[3], "other", 1) + " " + line(3), "en", "s1", 0) for d in clean[4:8]]
    docs += [(3000 + k, line(30) + " " + t + " " + line(30), "en", None, 0) for k, t in items] + [(4000, None, None, None, None), (4001, "", "en", "s1", 0)]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, steps = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.shared.written(stage(spark, now, folder), name)
        steps.append({r.doc_id: r for r in now.collect()})
        assert list(corpus_pipeline.COLUMNS) == now.columns[:5]
    toxic, lined, near, leaks, mixed = steps
    assert set(toxic) == {d[0] for d in docs} - {d[0] for d in docs[:300] if d[0] % 4 == 0}
    gone = brute.repeated_lines([(i, r.text) for i, r in toxic.items()])
    want = {}
    for i, r in toxic.items():
        text = r.text if r.text is None else "\n".join(x for n, x in enumerate(r.text.split("\n")) if n not in gone.get(i, []))
        if not gone.get(i) or brute.words(text):
            want[i] = text
    assert {i: r.text for i, r in lined.items()} == want and all(1000 + d[0] not in lined for d in clean[:4])
    assert set(near) == {i for i, (_, c) in brute.near_duplicates([(i, r.text) for i, r in lined.items()]).items() if i == c}
    assert set(near) - set(leaks) == {3000, 3001, 3002}
    size = {i: len(brute.words(r.text)) for i, r in leaks.items()}
    assert set(mixed) <= set(leaks) and all(r.taken == r.copies * size[i] > 0 for i, r in mixed.items())
    for r in mixed.values():
        assert r.source_size == sum(n for i, n in size.items() if leaks[i].source == r.source)
        assert abs(r.target - sum(m.taken for m in mixed.values() if m.source == r.source)) <= max(size.values())
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == set(mixed)


def test_near_dedup_stage_links_from_80_percent(spark):
    """Pairs of Jaccard in [0.80, 0.85) are near-duplicates in the pipeline, those below are not."""
    import brute

    docs = []
    for k in range(200):
        text = [f"w{k}x{i}" for i in range(64)]                      # 60 shingles
        docs += [(k, " ".join(text)), (1000 + k, " ".join(text + [f"y{k}z{i}" for i in range(12 + k % 5)]))]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, rows, "").collect()}
    want = {i for i, (_, c) in brute.near_duplicates(docs, 80).items() if i == c}
    assert got == want == set(range(200)) | {1000 + k for k in range(4, 200, 5)}
    assert minmax.permutations(85) == 32 and all((1 - (p / 100) ** 4) ** (minmax.permutations(p) // 2) <= 1e-5 for p in (50, 80, 85, 95))
