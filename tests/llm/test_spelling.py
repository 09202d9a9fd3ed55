"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import queries, spelling

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(counts, ratio=2):
    """word -> (form, root, n, n_near, form_n); neighbours by leaving letters out."""
    left_out = {}
    for word in counts:
        for i in range(len(word)):
            left_out.setdefault((word[:i] + word[i + 1 :], i), set()).add(word)
    near = {w: set() for w in counts}
    for (rest, _), words in left_out.items():
        for word in words:
            near[word] |= words - {word}
            if rest in counts:
                near[word].add(rest)
                near[rest].add(word)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def counted(rows, min_length=5, min_count=3):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            crc = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if crc % 97 == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def as_map(rows):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=8), min_size=1, max_size=40, unique=True), st.text("abé", min_size=1, max_size=8))
def test_recurrence(words, query):
    slices = spelling.BitSlices(words)
    replaced, longer, shorter = ({words[i] for i in spelling.members(bits)} for bits in slices.near(query))
    assert replaced | longer | shorter == {w for w in words if one_edit(w, query)}
    assert all(len(w) == len(query) for w in replaced) and all(len(w) == len(query) + 1 for w in longer)


@pytest.mark.parametrize("block_words", [3, 64, None])
def test_against_all_pairs(spark, block_words):
    """Words over few letters, so blocks are large, dealt to parts and read in pieces."""
    draw = random.Random(block_words or 0)
    counts = {"".join(draw.choices("abc", k=draw.randrange(5, 10))): draw.randrange(3, 400) for _ in range(700)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_map(spelling.group_variants(words, block_words=block_words).collect()) == brute(counts)


def test_long_chain_of_forms(spark):
    """Every word leads to the next, which is twice as frequent."""
    counts = {"a" * (5 + i): 3 * 2**i for i in range(20)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = as_map(spelling.group_variants(words).collect())
    assert got == brute(counts)
    assert {v[1] for v in got.values()} == {"a" * 24}


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = as_map(queries.op12_spelling_groups(spark, "/root/testdata/sf0.01").collect())
    assert got == brute(counted([(r["doc_id"], r["text"]) for r in docs]))
    assert any(v[0] for v in got.values()) and any(v[0] is None and v[3] for v in got.values())


def test_odd_documents(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows += [(20 + i, "Straße STRAÞE Strasse strase x÷y×zab " + "z" * 5000) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    found = spelling.runs(docs)
    words = found.select(spelling.misspelled(F.col("doc_id"), F.col("run")).alias("word"))
    got = as_map(spelling.group_variants(spelling.vocabulary(words)).collect())
    assert got == brute(counted(rows))


def test_no_words(spark, odd_docs):
    words = spelling.vocabulary(spelling.runs(odd_docs.limit(0)), word="run")
    assert spelling.group_variants(words).collect() == []
