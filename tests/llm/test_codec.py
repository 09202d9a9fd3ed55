"""Round trips of token ids, alone and through files."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemill.llm import codec, token_files, tokens


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 65535), max_size=200), st.integers(1, 40))
def test_round_trip(ids, times):
    ids = np.array(ids * times, np.uint32)
    assert (codec.decode(codec.encode(ids)) == ids).all()


@pytest.mark.parametrize("n", [0, 1, codec.BLOCK - 1, codec.BLOCK, codec.BLOCK + 1, 2 * codec.BLOCK + 7])
def test_block_borders(n):
    ids = np.random.default_rng(n).integers(0, 300, n).astype(np.uint32)
    assert (codec.decode(codec.encode(ids)) == ids).all()


def test_repetition_costs_little():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    assert len(codec.encode(ids)) < len(ids)


def test_a_damaged_block_is_found():
    data = bytearray(codec.encode(np.arange(5000, dtype=np.uint32)))
    data[-40] ^= 0x55
    with pytest.raises(ValueError):
        codec.decode(bytes(data))


@pytest.mark.parametrize("kinds", [1, 2, 3, 40, 65536])
def test_runs_follow_each_other(monkeypatch, kinds):
    monkeypatch.setattr(codec, "LANES", 3)
    ids = np.random.default_rng(kinds).zipf(1.3, 4000).astype(np.uint64) % kinds
    for n in (1536, 1537, 4000):
        assert (codec.decode(codec.encode(ids[:n])) == ids[:n]).all()


def _sentences(n: int) -> np.ndarray:
    """Ids each of which is followed by one of four others, out of 2,000."""
    rng = np.random.default_rng(3)
    follow = rng.integers(0, 2000, (2000, 4))
    ids = [0]
    for choice in rng.integers(0, 4, n - 1).tolist():
        ids.append(int(follow[ids[-1], choice]))
    return np.array(ids, np.uint32)


def test_followers_are_counted_over_the_whole_run():
    ids = _sentences(200_000)
    data = codec.encode(ids)
    assert (codec.decode(data) == ids).all()
    assert len(data) < 0.6 * len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_a_run_takes_few_steps(monkeypatch):
    calls = []
    put = codec._Writer.put
    monkeypatch.setattr(codec._Writer, "put", lambda *a: calls.append(1) or put(*a))
    codec.encode(_sentences(50_000))
    assert len(calls) <= 512


def test_damage_is_found_wherever_it_is():
    ids = _sentences(3000)
    data = codec.encode(ids)
    found = 0
    for at in range(8, len(data), 41):
        try:
            got = codec.decode(data[:at] + bytes([data[at] ^ 0x15]) + data[at + 1 :])
        except ValueError:
            found += 1
        else:  # the last digit of a lane has bits that nothing depends on
            assert (got == ids).all()
    assert found > 0.9 * len(range(8, len(data), 41))
    with pytest.raises(ValueError):
        codec.decode(data[:-4])


def test_ids_equal_the_library():
    import pyarrow as pa

    texts = [
        "Don't  stop, they're HERE!! 12 a1b2 x_y", None, "", " \n\t ", "<|endoftext|> <|ENDOFTEXT|> a",
        "é é  ΣΑΣ İ ß ﬁ ½ K \x1c z q　r", "word " * 3000, "wörter, über: straße.", "a" * 5000,
    ]
    encoder = tokens.Encoder(tokens.vocabulary_path())
    library = Tokenizer.from_file(tokens.vocabulary_path())
    for _ in range(2):
        ids, lengths = encoder.encode(pa.array(texts, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == sum(want, [])


def test_words_may_be_forgotten():
    import pyarrow as pa

    encoder = tokens.Encoder(tokens.vocabulary_path(), remembered=3)
    library = Tokenizer.from_file(tokens.vocabulary_path())
    for text in ("one, two three", "four four, one", "two: (5) x", "", "one. three four!", "two (5)") * 2:
        ids, _ = encoder.encode(pa.array([text], pa.string()))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_files_give_back_all_documents(spark, odd_docs, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(odd_docs, path, parts=3)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    library = Tokenizer.from_file(tokens.vocabulary_path())
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for row, (name, text) in zip(got, rows, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert row.asDict() == {"doc_id": name, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes())}
        start += len(ids)


def test_runs_are_closed_at_whole_documents(spark, odd_docs, tmp_path, monkeypatch):
    path = str(tmp_path / "ids")
    token_files.write_tokens(odd_docs, path, parts=1)
    assert sum(len(r["doc_ids"]) for r in spark.read.parquet(path).collect()) == odd_docs.count()


def test_no_documents(spark, odd_docs, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(odd_docs.limit(0), path)
    assert token_files.read_tokens(spark, path).count() == 0
