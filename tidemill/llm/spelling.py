"""Spelling variants: words one edit apart, each led to its most frequent neighbour.

Near words are searched in blocks by a bit-sliced position index. For every position and
letter a bitset says which words of the block have that letter there; bits are bits of
one whole number, so a step works on all words of the block at once. Reading a query
letter by letter, one recurrence keeps the words without an error so far, and beside it
the words with one replaced letter, with one letter more (their positions shifted ahead
by one) and with one letter less (shifted back).

An edit leaves the first or the last half of a word as it is. Words are therefore in the
blocks of their halves: for the length m of the shorter of two words, they share the
first m // 2 letters or the last m - m // 2. A pair that shares both is left to the
block of first halves. Large blocks are dealt out: each part has a share of the queries
and reads all words, some at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import column, stage

# A run of these characters is a word; capitals are lowered first.
LETTERS = "[a-zÀ-ÿ]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words that are indexed at a time, and queries of one part of a block.
BLOCK_WORDS = 8192


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `run` for every maximal run of letters, in lower case."""
    lower = F.translate(column(text), _CAPITALS, _CAPITALS.lower())
    found = F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))
    return docs.select(column(doc_id).alias("doc_id"), F.explode(found).alias("run"))


def misspelled(doc_id: Column, run: Column, one_in: int = 97) -> Column:
    """The run, with a letter left out in one of so many (document, run) pairs.

    The pair's crc32 decides whether and which. A null id counts as an empty one.
    """
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    crc = F.crc32(name.cast("binary"))
    at = (crc % F.length(run)).cast("int")
    return F.when(crc % one_in != 0, run).otherwise(F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2)))


def vocabulary(words: DataFrame, word: str = "word", min_length: int = 5, min_count: int = 3) -> DataFrame:
    """`word` and `n`, its number of occurrences, for words long and frequent enough."""
    long = words.select(column(word).alias("word")).filter(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


class BitSlices:
    """The bitsets of a block of words: which of them have a letter at a position."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.every = (1 << len(words)) - 1
        held: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
            for place in enumerate(word):
                held.setdefault(place, []).append(i)
        self.at = {place: _bits(members) for place, members in held.items()}
        self.of_length = {n: _bits(members) for n, members in lengths.items()}

    def near(self, query: str, stem: int = 0) -> tuple[int, int, int]:
        """Words with one letter replaced, one more, one less than the query.

        With `stem`, words that share so many first letters with the query are left out.
        """
        at, exact = self.at, self.every
        replaced, longer, shorter, stemmed = 0, self.every, 0, 0
        for i, letter in enumerate(query):
            here = at.get((i, letter), 0)
            going = exact & here
            replaced = (replaced & here) | (exact ^ going)
            longer = (longer & at.get((i + 1, letter), 0)) | going
            shorter = (shorter & at.get((i - 1, letter), 0)) | exact
            exact = going
            if i + 1 == stem:
                stemmed = going
        n, lengths = len(query), self.of_length
        return (
            replaced & lengths.get(n, 0) & ~stemmed,
            longer & lengths.get(n + 1, 0) & ~stemmed,
            shorter & lengths.get(n - 1, 0) & ~stemmed,
        )


def _bits(members: list[int]) -> int:
    if len(members) < 64:
        bits = 0
        for i in members:
            bits |= 1 << i
        return bits
    raw = bytearray(members[-1] // 8 + 1)
    for i in members:
        raw[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(raw, "little")


def members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


_FOUND = "word string, n_near long, near_n long, near string"


def near_words(words: DataFrame, block_words: int | None = None) -> DataFrame:
    """For every word with a near one: how many are near, and the most frequent of them.

    `words` holds distinct words with their number `n`. Near words differ by exactly one
    inserted, deleted or replaced code point; of equally frequent ones the smallest in
    the order of code points is given.
    """
    most = block_words or BLOCK_WORDS
    length = F.length("word")
    classes = F.array(length, length - 1)
    both = words.select("word", "n", F.explode(classes).alias("m"))
    half = (F.col("m") / 2).cast("int")
    halves = F.array(
        F.struct(F.lit(True).alias("first"), F.substr("word", F.lit(1), half).alias("half")),
        F.struct(F.lit(False).alias("first"), F.expr("right(word, m - cast(m / 2 as int))").alias("half")),
    )
    placed = both.select("word", "n", "m", F.inline(halves))
    block = ["m", "first", "half"]
    # Only blocks too large for one index are dealt to several parts; they are few.
    sizes = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > most)
    large = stage(sizes.select(*[F.col(c).alias(f"s_{c}") for c in block], F.ceil(F.col("size") / most).cast("int").alias("parts")), "large")
    same = [F.col(c) == F.col(f"s_{c}") for c in block]
    shares = F.coalesce("parts", F.lit(1))
    part = F.explode(F.sequence(F.lit(0), shares - 1)).alias("part")
    dealt = placed.join(large, same, "left").select("word", "n", *block, shares.alias("parts"), part)
    asks = F.pmod(F.xxhash64("word"), F.col("parts")) == F.col("part")
    dealt = dealt.select("word", "n", *block, "part", asks.alias("asks"))

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for (m, first, _, _), block_rows in groupby(_rows(rows), key=lambda r: r[2:6]):
            found += _block(block_rows, m, 0 if first else m // 2, most)
            if len(found) >= 4096:
                yield _batch(found)
                found = []
        if found:
            yield _batch(found)

    order = [*block, "part", F.desc("asks"), "word"]
    found = dealt.repartition(*block, "part").sortWithinPartitions(*order).mapInArrow(search, _FOUND)
    # The largest number first, then the smallest word.
    least = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("least"))
    return summed.select("word", "n_near", (-F.col("least.n")).alias("near_n"), F.col("least.word").alias("near"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _block(rows: Iterator[tuple], m: int, stem: int, most: int) -> Iterator[tuple]:
    """(query, number of near words, best of them) of one part of a block.

    Words that ask come first. All words are indexed, `most` at a time, and an index
    is given up once all that ask have been read and have seen it.
    """
    asking: list[str] = []
    indexes: list[tuple[BitSlices, list[int]]] = []
    best: dict[str, tuple] = {}
    some = list(islice(rows, most))
    more = len(some) > 1  # a word alone has no pairs
    while more:
        more = len(some) == most
        asking += [row[0] for row in some if row[6]]
        if some:
            indexes.append((BitSlices([row[0] for row in some]), [row[1] for row in some]))
        asks, some = more and some[-1][6], list(islice(rows, most)) if more else []
        if asks:
            continue  # others that ask may follow
        for slices, numbers in indexes:
            for query in asking:
                replaced, longer, shorter = slices.near(query, stem)
                # Of this block are pairs whose shorter word has m letters.
                for i in members(replaced | longer if len(query) == m else shorter):
                    near = (-numbers[i], slices.words[i])
                    count, least = best.get(query, (0, near))
                    best[query] = (count + 1, min(least, near))
        indexes.clear()
    for query, (count, (negative, word)) in best.items():
        yield query, count, -negative, word


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["word", "n_near", "near_n", "near"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def roots(forms: DataFrame) -> DataFrame:
    """`word` and `root`: where one comes to by following `form` from every word.

    Each round doubles the steps taken. Forms lead to ever more frequent words, so there
    are no rings.
    """
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        over = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        further = links.join(over, F.col("root") == F.col("at"), "left")
        links = stage(
            further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "forms",
        )
        if links.filter("moved").isEmpty():
            return links.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 2, block_words: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of `word`, `n`.

    The form of a word is its most frequent near word (of several the smallest), if that
    has at least `ratio` times its number, else null. The root is the last word that the
    forms lead to; a word without a form is its own root. An empty vocabulary gives no
    rows. Words have to be distinct.
    """
    words = stage(words.select("word", "n"), "vocabulary")
    near = stage(near_words(words, block_words), "near")
    joined = words.join(near.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left")
    enough = F.col("near_n") >= ratio * F.col("n")
    formed = joined.select(
        "word",
        F.when(enough, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_n")).alias("form_n"),
    )
    formed = stage(formed, "formed")
    ends = roots(formed.filter("form is not null")).withColumnRenamed("word", "w")
    ended = formed.join(ends, F.col("word") == F.col("w"), "left")
    return ended.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
