"""Winnowing against a plain rendering of its rules, and neighbours against a loop."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import fingerprints
from tidemill.llm.fingerprints import Winnow


def plain(text, winnow):
    """Fingerprints window by window, from the hash of each k-gram on its own."""
    points = fingerprints.code_points(text)
    k = min(winnow.k, len(text))
    if not k:
        return []
    grams = [int(winnow.hashes(points[i : i + k])[0]) for i in range(len(text) - k + 1)]
    window, kept = min(winnow.window, len(grams)), []
    for i in range(len(grams) - window + 1):
        least = min(grams[i : i + window])
        place = max(j for j in range(i, i + window) if grams[j] == least)
        if not kept or kept[-1][1] != place:
            kept.append((least, place))
    return kept


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abäß 𝔘"), max_size=120), st.integers(1, 9), st.integers(1, 12), st.integers(3, 60))
def test_against_every_window(text, k, window, size):
    winnow = Winnow(k, window)
    was, fingerprints.SLICE = fingerprints.SLICE, size
    try:
        hashes, places = winnow.select(fingerprints.code_points(text))
    finally:
        fingerprints.SLICE = was
    assert list(zip(hashes.tolist(), places.tolist())) == plain(text, winnow)


def test_shared_passages_are_found():
    """A passage of k + window - 1 characters always shares a fingerprint, a shorter one than k none."""
    draw, winnow = random.Random(3), Winnow()
    letters = "abcdefghijklmnopqrstuvwxyz "
    some = lambda n: "".join(draw.choices(letters, k=n))
    for _ in range(200):
        passage = some(winnow.k + winnow.window - 1)
        a, b = (winnow.select(fingerprints.code_points(some(draw.randrange(90)) + passage + some(draw.randrange(90))))[0] for _ in "ab")
        assert set(a.tolist()) & set(b.tolist())
    a, b = (winnow.select(fingerprints.code_points(some(500)))[0] for _ in "ab")
    assert not set(a.tolist()) & set(b.tolist())


def test_long_runs_of_one_letter():
    """All hashes are equal: the rightmost of every window moves along with it."""
    hashes, places = Winnow(4, 5).select(fingerprints.code_points("a" * 30))
    assert places.tolist() == list(range(4, 27)) and len(set(hashes.tolist())) == 1


def key(name):
    return name is not None, name or 0


def check(rows, got):
    """Every row has the digests of its own text and of some row of the next id."""
    texts = {}
    for name, text in rows:
        texts.setdefault(key(name), set()).add(text or "")
    ids = sorted(texts)
    after = {i: ids[(n + 1) % len(ids)] for n, i in enumerate(ids)}
    left = sorted((key(n), hashlib.sha256((t or "").encode()).hexdigest()) for n, t in rows)
    seen = []
    by_text = {}
    for r in got:
        me = key(r["doc_id"])
        options = [(t, f) for t in texts[me] for f in texts[after[me]] if len(t) == r["n_chars"]]
        fits = [
            (t, f)
            for t, f in options
            if hashlib.sha256(fingerprints.edited(t, f).encode()).hexdigest() == r["edited_sha256"]
            and r["fingerprint"] == " ".join(f"{h:08x}:{p}" for h, p in plain(t, Winnow()))
        ]
        assert fits
        text, following = fits[0]
        seen.append((me, hashlib.sha256(text.encode()).hexdigest()))
        marks = [{h for h, _ in plain(x, Winnow())} for x in (text, fingerprints.edited(text, following), following)]
        share = lambda a, b: len(a & b) / max(len(a), len(b)) if a or b else 1.0
        assert r["near_edited"] == pytest.approx(share(marks[0], marks[1]))
        assert r["near_next"] == pytest.approx(share(marks[0], marks[2]))
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert sorted(seen) == left


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_neighbours(spark, ranges):
    draw = random.Random(5)
    rows = [(i * 3 - 50, "".join(draw.choices("abcd é", k=draw.choice([0, 1, 3, 50, 300])))) for i in range(60)]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(rows, fingerprints.compare_neighbours(docs, ranges=ranges).collect())


def test_one_id_holds_half_of_the_rows(spark):
    """It is dealt to several tasks; its rows share a successor."""
    draw = random.Random(6)
    some = lambda: "".join(draw.choices("abc ", k=80))
    rows = [(7, some()) for _ in range(60)] + [(i, some()) for i in range(8, 30)] + [(None, some()) for _ in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    starts, tasks, nulls = fingerprints._ranges(docs.selectExpr("doc_id as id"), 10)
    assert tasks[starts.index(7)] > 3 and 8 in starts and nulls == 2
    check(rows, fingerprints.compare_neighbours(docs, ranges=10).collect())


def test_odd_documents(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = fingerprints.compare_neighbours(odd_docs).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == ""
    assert by_id[3]["near_next"] == 1.0 and by_id[4]["near_next"] == 0.0
    assert by_id[9]["n_chars"] == len(dict(rows)[9])
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[1]["near_next"] == 1.0


def test_few_rows(spark, odd_docs):
    assert fingerprints.compare_neighbours(odd_docs.limit(0)).collect() == []
    one = fingerprints.compare_neighbours(spark.createDataFrame([(4, "a quick brown fox")], "doc_id long, text string")).head()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a quick brown" + b"a qu").hexdigest()
    nulls = spark.createDataFrame([(None, None), (None, "x")], "doc_id long, text string")
    assert fingerprints.compare_neighbours(nulls).count() == 2


def test_dataset(spark):
    """Whole documents of the given table; three quarters of an edited text stay."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = fingerprints.compare_neighbours(docs).collect()
    check([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], got)
    long = [r for r in got if r["n_chars"] > 1000]
    assert np.mean([r["near_edited"] for r in long]) > 0.7
