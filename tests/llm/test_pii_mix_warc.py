"""Personal data, mixing and archives."""

import base64
import hashlib
import io
import random
import time
import zlib

import brute
import pytest
from docfold.llm import mixture, pii, warc
from hypothesis import given, settings
from hypothesis import strategies as st

KINDS = list(brute.PII)


def listed(text):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in brute.personal(text))


def hard_texts() -> list[str | None]:
    rng = random.Random(2)
    parts = ["a@b.cc", "%d@e.f", "x.y+z@q-r.s.t", "@", "..", "1.2.3.4", "256.1.1.1", "0.0.0.0", "010.001.000.255", ".5", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "5500000000000004", "+1 (456) 555-2186", "+49 30 1234567", "+1", "€😀", " ", "\n", "ü", "-", "12", "+", "9" * 25, "00000000000000"]
    return [None, "", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(150)], "a" * 5000 + "@", "a@b" + ".c" * 6000, "1" * 20000]


def test_base_spans_match_the_plain_patterns(spark):
    texts = hard_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in pii.report(rows).collect()}
    for i, t in enumerate(texts):
        assert ",".join(s for s in got[i].spans.split(",") if not s.startswith("term")) == listed(t), t
        assert got[i].base_sha256 == hashlib.sha256(listed(t).encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == j for _, k, _ in brute.personal(t)) for j in range(4)]


def test_terms_that_disclose_an_entity_are_generalised_or_removed(spark):
    rows = [(1, "Contact Zorblax at ada@x.org in the morning"), (2, "please tell Zorblax ada@x.org of the plan"), (3, "the morning was fine"),
            (4, "a plan of the day in the morning"), (5, "the copy bob@y.org Quux"), (6, "the copy bob@y.org Quux"), (7, None)]
    rows += [(10 + i, f"the day number {i} in the plan of morning") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert got[1].spans == "term:8:15,email:19:28" and got[1].n_terms == 1 and got[2].n_terms == 1
    assert got[5].n_terms == 0 and got[3].spans == ""     # copies of one passage are one observation
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[1] == "Contact  at [EMAIL] in the morning" and clean[3] == "the morning was fine" and clean[7] == ""
    assert pii.report(df.limit(0)).count() == 0


def test_long_texts_of_numbers_take_seconds(spark):
    text = "12 a " * 200_000 + "1.2.3.4 " * 2000 + "mail x@y.zz"
    rows = spark.createDataFrame([(i, text + str(i)) for i in range(2)], "doc_id long, text string").repartition(2)
    began = time.monotonic()
    got = pii.report(rows).select("n_ip", "n_email", "n_card").collect()
    assert [tuple(r) for r in got] == [(2000, 1, 0)] * 2 and time.monotonic() - began < 120


def test_targets_share_what_capped_sources_leave():
    sizes, weights = {"a": 10, "b": 1000, None: 40}, {"a": 5, "b": 2, None: 1}
    got = mixture.targets(sizes, weights)
    assert got["a"] == 30 and got[None] == 120 and got["b"] == pytest.approx(900)
    assert mixture.targets({"a": 0}, {"a": 5}) == {"a": 0.0}
    assert mixture.cyclic_weights([None, "b", "a", "é", "z"]) == {"a": 5, "b": 2, "z": 1, "é": 5, None: 2}


def test_flow_prefers_first_copies_and_reroutes():
    # x alone feeds a; xy could feed both, but b has nothing else
    used = mixture.flow({("a",): 100, ("a", "b"): 100}, {"a": 100.0, "b": 100.0})
    assert used == {("a",): [100.0, 0.0, 0.0], ("a", "b"): [100.0, 0.0, 0.0]}
    used = mixture.flow({("a",): 100, ("a", "b"): 50}, {"a": 250.0, "b": 50.0})
    assert sum(map(sum, used.values())) == pytest.approx(300)
    assert used["a",][:2] == [100.0, 100.0] and used["a", "b"][0] == 50.0


@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 500), min_size=1))
@settings(max_examples=60, deadline=None)
def test_targets_are_a_fixed_point(sizes):
    weights = mixture.cyclic_weights(list(sizes))
    got = mixture.targets(sizes, weights)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))
    free = [got[s] / weights[s] for s in sizes if got[s] < 3 * sizes[s] - 1e-9]
    assert all(x == pytest.approx(free[0]) for x in free) and all(got[s] <= 3 * sizes[s] + 1e-9 for s in sizes)


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["a", "b", "b", "b", "b", None]), "x") for i in range(400)] + [(1, None, "a", "x"), (None, "w w", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens string").drop("tokens")
    first, again = (sorted(map(tuple, mixture.mix_sources(d).select("doc_id", "size", "taken", "source", "target").collect()), key=str) for d in (df, df.repartition(7)))
    assert first == again and len(first) == len(rows)
    for s in ("a", "b", None):
        taken, target = sum(r[2] for r in first if r[3] == s), next(r[4] for r in first if r[3] == s)
        assert abs(taken - target) <= 15 and all(0 <= r[2] <= 3 * r[1] for r in first)
    assert mixture.mix_sources(df.limit(0)).count() == 0


def test_overlapping_sources(spark):
    rows = [(i, "w w w w", ["a", "b"] if i % 2 else ["a"]) for i in range(100)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, member array<string>")
    out = mixture.mix(df, F.col("member"), {"a": 1, "b": 3}).groupBy("pattern").agg(F.sum("taken").alias("t")).collect()
    got = {tuple(r.pattern): r.t for r in out}
    assert got["a", "b"] == pytest.approx(300, abs=4) and got["a",] == pytest.approx(100, abs=4)


def test_archives_give_back_what_was_written(spark, tmp_path):
    pages = [(5, "http://a/ b\r\n", "<p>x</p>"), (2, None, "<p>x</p>"), (2, None, "<p>x</p>"), (9, "u", None), (7, "u", ""), (None, "u", "<p>x</p>"), (3, "u", "ü" * 300_000), (4, "u", "\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, digest string").drop("digest")
    folder = str(tmp_path / "warc")
    rows = warc.read(warc.write(df, folder), folder).collect()
    assert len(rows) == len(pages) and all(r.problem is None for r in rows)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in rows), key=str)
    assert kinds == sorted([(5, "revisit", 2), (2, "response", None), (2, "response", None), (9, "revisit", 7), (7, "response", None), (None, "revisit", 2),
                            (3, "response", None), (4, "response", None)], key=str)
    by_id = {p[0]: (p[2] or "").encode() for p in pages}
    for r in rows:
        want = by_id[r.page_id]
        assert r.payload_bytes == len(want) and r.payload_digest == base64.b32encode(hashlib.sha1(want).digest()).decode()
        assert r.payload == (None if r.record_type == "revisit" else want)
    alone = warc.read(warc.write(df, folder + "2", min_bytes=1), folder + "2").collect()
    assert {r.page_id for r in alone if r.record_type == "revisit"} == {5, None}
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_the_reader_tells_what_is_wrong():
    good = warc.record(1, "u", b"payload" * 50_000, None, False, "1970-01-01T00:00:00Z")
    read = lambda data: list(warc.Reader(io.BytesIO(data)))
    ok = read(warc.member(good) + warc.member(good))
    assert [r["problem"] for r in ok] == [None, None] and ok[0]["payload"] == b"payload" * 50_000
    bad = read(warc.member(good.replace(b"payload", b"pAyload", 1)) + warc.member(good))
    assert "digest differs" in bad[0]["problem"] and bad[1]["problem"] is None
    assert "longer" in read(warc.member(good + b"x"))[0]["problem"] and "shorter" in read(warc.member(good[:-400]))[0]["problem"]
    assert "unreadable" in read(warc.member(good)[:-30])[-1]["problem"] and "no end" in read(warc.member(b"abc"))[0]["problem"]
    assert read(b"") == [] and zlib.decompress(warc.member(good), 31) == good
