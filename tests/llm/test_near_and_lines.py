"""Near-duplicates, line dedup and decontamination against brute force."""

import random

import brute
import corpus_pipeline
import pyarrow as pa
from docfold.llm import catalog, decontam, graphs, lines, minmax, textcore

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int) -> list[tuple[int, str | None]]:
    """Copies, near copies of every degree, shared lines, short and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ärger", "ΩΩ", "x\x0bY"]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 30, 80]))] for _ in range(14)]
    texts: list[str | None] = [None, "", " \t\n ", "one", "one two three four", "ONE two\nthree four"]
    for words in base:
        for _ in range(rng.randint(1, 5)):
            w = list(words)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(x + ("\n" if rng.random() < 0.1 else "") for x in w))
    rng.shuffle(texts)
    return list(zip(rng.sample(range(1000), len(texts)), texts))


def test_words_and_shingles_match_plain_python():
    texts = [t for _, t in corpus(1)]
    words = textcore.Words()
    seen: dict[str, int] = {}
    for limit in (64, 1 << 18):
        for a, b, data, offs in textcore.pieces(pa.array(texts, pa.string()), limit):
            h, at = words.hashes(data, offs)
            s, s_at = textcore.unique_by_row(*textcore.shingles(h, at))
            for i in range(a, b):
                found = h[at[i - a]:at[i - a + 1]].tolist()
                assert len(found) == len(brute.words(texts[i]))
                assert all(seen.setdefault(w, x) == x for w, x in zip(brute.words(texts[i]), found))
                assert s_at[i - a + 1] - s_at[i - a] == len(brute.shingles(texts[i]))
    assert len(set(seen.values())) == len(seen)
    assert textcore.characters(*textcore.raw(pa.array(["aß€😀", ""])))[0].tolist() == [ord(c) for c in "aß€😀"]


def test_components_follow_long_chains(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_match_brute_force(spark):
    docs = corpus(2)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_shingles int, f1 string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax.link(rows).collect()}
    want = brute.near_duplicates(docs)
    assert got == want and any(i != c for i, (_, c) in want.items())


def test_near_duplicates_with_repeated_and_null_ids(spark):
    long = " ".join(f"a{i}" for i in range(20))
    other = " ".join(f"b{i}" for i in range(20))
    rows = spark.createDataFrame([(5, long), (5, long), (5, other), (9, other), (None, long), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minmax.link(rows).collect()), key=str)
    assert got == sorted([(5, 5, True)] * 3 + [(9, 5, False), (None, 5, False), (None, None, False)], key=str)
    assert minmax.link(rows.limit(0)).count() == 0


def test_repeated_lines_match_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(9)) for _ in range(rng.choice([2, 5, 9, 60, 130]))) for _ in range(25)]
    docs: list[tuple[int, str | None]] = [(999, None), (998, "")]
    for i in rng.sample(range(900), 50):
        chosen = []
        for _ in range(rng.randint(1, 5)):
            w = rng.choice(pool).split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 8))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
            chosen.append(rng.choice([" ", "  "]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
        docs.append((i, "\n".join(chosen)))
    want = brute.repeated_lines(docs)
    rows = spark.createDataFrame([(i, t, "k", [7]) for i, t in docs], "doc_id long, text string, _key string, id array<int>").drop("_key")
    got = {r.doc_id: r for r in lines.dedup(rows).collect()}
    assert {i: r.removed_lines for i, r in got.items() if r.removed_lines} == want and sum(map(len, want.values())) > 20
    for i, t in docs:
        keep = t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want.get(i, []))
        assert got[i].text == keep and got[i].id == [7]


def test_many_variants_of_one_line_are_all_removed(spark):
    """More partners than a list keeps: the second round must find those whose first partners fail."""
    rng = random.Random(8)
    common = [f"c{i}" for i in range(12)]
    docs = [(i, " ".join(common[:rng.randint(6, 12)] + [f"v{rng.randrange(12)}" for _ in range(rng.randint(0, 4))])) for i in range(150)]
    got = {r.doc_id: r.removed_lines for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.removed_lines}
    assert got == brute.repeated_lines(docs)


def test_copies_in_descending_order_of_documents(spark):
    """The earliest copy by doc_id meets the similar line, wherever it stands in its partition."""
    line, similar = "a b c d e f g h i j", "a b c d e f g h i x"
    docs = [(10, line), (5, line), (7, similar), (3, "k l m n o p\nk l m n o p"), (1, "q r s t u v"), (2, "q r s t u v\nk l m n o p")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.removed_lines for r in lines.dedup(rows).collect() if r.removed_lines}
    assert got == brute.repeated_lines(docs) == {10: [0], 7: [0], 2: [0], 3: [0, 1]}


def test_short_lines_in_query_and_pipeline(spark, tmp_path):
    """No line with a word is too short: sets of one to three words match equal ones, four words match four of five."""
    rng = random.Random(11)
    docs = [(i, "\n".join(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 6))) for _ in range(4))) for i in rng.sample(range(500), 60)]
    docs += [(600, "Les."), (700, "les.\n \nall rights reserved."), (701, "p q r s t"), (702, "p q r s"), (703, "p q r")]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute.repeated_lines(docs, least=1)
    got = {r.doc_id: [int(x) for x in r.removed_lines.split(",")] for r in catalog.op4(spark, str(tmp_path)).collect() if r.n_removed}
    assert got == want and want[700] == [0] and want[702] == [0] and 703 not in want
    kept = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want.get(i, [])) for i, t in docs}
    kept = {i: t for i, t in kept.items() if i not in want or brute.words(t)}
    assert {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, rows, "").collect()} == kept


def test_repeated_rows_and_null_ids_in_line_dedup(spark):
    text = "one two three four five six"
    rows = spark.createDataFrame([(3, text), (3, text), (None, text), (4, text)], "doc_id long, text string")
    got = sorted(((r.doc_id, len(r.removed_lines)) for r in lines.dedup(rows).collect()), key=str)
    assert got == sorted([(3, 0), (3, 0), (None, 1), (4, 1)], key=str)
    assert lines.dedup(rows.limit(0)).count() == 0


def test_contained_items_match_brute_force(spark):
    rng = random.Random(6)
    item = lambda n: [f"i{rng.randrange(500)}" for _ in range(n)]
    items = [(k, item(n)) for k, n in enumerate([1, 2, 4, 5, 6, 9, 17, 40, 40])]
    docs: list[tuple[int, str | None]] = [(900, None), (901, ""), (902, "i")]
    for d in range(60):
        w = [f"d{rng.randrange(300)}" for _ in range(rng.choice([3, 40, 400]))]
        for _ in range(rng.randint(0, 2)):
            piece = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, max(1, len(piece) // 20))):
                piece[rng.randrange(len(piece))] = "zz"
            at = rng.randrange(len(w))
            w[at:at] = piece
        docs.append((d, rng.choice([" ", "\n", " \t"]).join(w).title()))
    bench = [(k, " ".join(w)) for k, w in items] + [(77, None), (78, " ")]
    want = set()
    for d, t in docs:
        for k, b in bench:
            n = min(5, len(brute.words(b)))
            if n:
                s = brute.shingles(b)
                found = len(s & {tuple(brute.words(t)[i:i + n]) for i in range(len(brute.words(t)) - n + 1)})
                if 100 * found >= 80 * len(s):
                    want.add((d, k, len(s), found))
    rows = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string")
    table = spark.createDataFrame(bench, "item_id long, text string")
    got = {tuple(r) for r in decontam.contained(rows, table).drop("_text").collect()}
    assert got == want and len(want) > 20
    assert {r.doc_id for r in decontam.clean(rows, table).collect()} == {d for d, _ in docs} - {d for d, *_ in want}
    assert decontam.contained(rows, table.limit(0)).count() == 0 and decontam.contained(rows.limit(0), table).count() == 0


def test_decontamination_shuffles_no_text(spark, monkeypatch):
    """Few candidates are broadcast, as their size is known before texts are joined with them."""
    rows = spark.createDataFrame([(i, f"a b c d e f {i}") for i in range(50)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f 7")], "item_id long, text string")
    monkeypatch.setattr(decontam.shared, "written", seen := Written(decontam.shared.written))
    left = decontam.clean(rows, bench)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and seen.names == ["candidates", "contained"]
    assert {r.doc_id for r in left.collect()} == set(range(50)) - {r.doc_id for r in rows.collect() if r.doc_id == 7}


class Written:
    def __init__(self, made):
        self.made, self.names = made, []

    def __call__(self, df, name):
        self.names.append(name)
        return self.made(df, name)


def test_index_entries_leave_a_task_in_small_batches():
    """A task deals its entries out before they take much memory; nothing is lost at the cuts."""
    import numpy as np
    import pyarrow as pa

    class Sent:
        value = np.ones(1 << lines.TABLE_BITS, np.uint64)

    texts = ["\n".join(" ".join(f"w{i}x{k}x{j}" for j in range(10)) for k in range(1000)) for i in range(250)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(250), pa.int64()), pa.array(range(250), pa.int64()), pa.array(texts)], names=["id", "key", "text"])
    sizes, line_rows = [], 0
    for out in lines.indexed(Sent, 8, 5)(iter([batch])):
        sizes.append(sum(len(lines.unpack(e)[0]) for e in out.column(1).to_pylist() if e is not None))
        line_rows += sum(len(x) // lines.LINE.itemsize for x in out.column(2).to_pylist() if x is not None)
    assert max(sizes) < 600_000 and sum(sizes) == 250 * 1000 * 3 and line_rows == 250 * 1000


class Ones:
    def __init__(self, np):
        self.value = np.ones(1 << lines.TABLE_BITS, np.uint64)


def batch_of(texts):
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["id", "key", "text"])


def test_no_batch_of_index_entries_is_large():
    """What a task deals out at once is held by the task, by Arrow and by the JVM: four MB at most, however much it read."""
    import numpy as np

    texts = ["\n".join(" ".join(f"w{i}x{k}x{j}" for j in range(10)) for k in range(1000)) for i in range(250)]
    out = list(lines.indexed(Ones(np), 8, 5)(iter([batch_of(texts)])))
    assert max(x.nbytes for x in out) < 4 << 20
    assert sum(len(lines.unpack(e)[0]) for x in out for e in x.column(1).to_pylist()) == 250 * 1000 * 3


def test_equal_lines_are_settled_before_they_are_dealt_out():
    """Of a common line one row goes on from a task's block, and its other copies are known to go; none is lost or doubled."""
    import numpy as np

    texts = [f"the same line\nTHE same   line the\nown line {i}\n" for i in range(500)]
    out = list(lines.indexed(Ones(np), 8, 1)(iter([batch_of(texts)])))
    first, gone = (np.concatenate([np.frombuffer(b, lines.LINE) for x in out for b in x.column(c).to_pylist()]) for c in (2, 3))
    assert len(first) == 501 and sorted(zip(gone["id"], gone["line"])) == [(i, k) for i in range(500) for k in (0, 1)][1:]
    one, two = lines.firsts(np.concatenate([first, first[:1], gone[:3]]))
    assert len(one) == 501 and sorted(zip(two["id"], two["line"])) == sorted(zip(gone["id"][:3], gone["line"][:3]))
    assert [len(x) for x in lines.firsts(first[:0])] == [0, 0]


def test_line_dedup_passes_over_its_lines_once(spark, monkeypatch):
    """Equal lines need no tables of their own, open lines are found once, and many removals meet texts that are not sorted."""
    rng = random.Random(9)
    docs = [(i, " ".join([f"c{k}" for k in range(rng.randint(6, 12))] + [f"v{rng.randrange(12)}" for _ in range(rng.randint(0, 4))])) for i in range(120)]
    monkeypatch.setattr(lines.shared, "written", seen := Written(lines.shared.written))
    monkeypatch.setattr(lines, "MANY", 0)
    out = lines.dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert "twice" not in seen.names and seen.names.count("open-lines") == seen.names.count("line-index") == 1
    assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.removed_lines for r in out.collect() if r.removed_lines} == brute.repeated_lines(docs)
