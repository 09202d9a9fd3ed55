"""Token ids of whole texts, with a memory of words already seen.

The vocabulary splits words at white space before anything else, drops the white space
and treats every word for itself, so the ids of a text are the ids of its pieces between
white space, one after the other. Of a batch, every different piece is looked up once.
Of a plain word with signs behind it (`word,`) the two parts are looked up.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"

# Pieces remembered by one worker in each of two generations, and bytes encoded at once.
REMEMBERED = 400_000
BATCH_CHARS = 12_000_000
_WORDS_PER_CALL = 4000

# A run of letters and a run of signs, of scripts whose letters are beyond doubt.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes batches of texts; the ids come as one array with a length per text."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._remembered = remembered
        self._known: dict[str, bytes] = {}  # ids as 32-bit integers
        self._older: dict[str, bytes] = {}

    def _look_up(self, pieces: list[str], learn: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of each piece; those of the older generation and new ones become known."""
        ids = list(map(self._known.get, pieces))
        places = [i for i, known in enumerate(ids) if known is None]
        missing = [pieces[i] for i in places]
        found = list(map(self._older.get, missing))
        learned = iter(learn([p for p, older in zip(missing, found, strict=True) if older is None]))
        found = [next(learned) if older is None else older for older in found]
        self._known.update(zip(missing, found, strict=True))
        for i, known in zip(places, found, strict=True):
            ids[i] = known
        return ids

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of new pieces, by way of their plain parts where they have some."""
        matches = list(map(_PLAIN.fullmatch, pieces))
        words = list({m[1] for m in matches if m})
        words = dict(zip(words, self._look_up(words, self._learn_words), strict=True))
        whole = [p for p, m in zip(pieces, matches, strict=True) if not m]
        whole += {m[2] for m in matches if m and m[2]}
        found = dict(zip(whole, self._look_up(whole, self._learn_whole), strict=True))
        found[""] = b""
        return [words[m[1]] + found[m[2]] if m else found[p] for p, m in zip(pieces, matches, strict=True)]

    def _learn_words(self, words: list[str]) -> list[bytes]:
        known: list[bytes] = []
        for i in range(0, len(words), _WORDS_PER_CALL):
            found = self._tokenizer.encode(" ".join(words[i : i + _WORDS_PER_CALL]), add_special_tokens=False)
            ids = np.array(found.ids, np.int32).tobytes()
            of = np.array(found.word_ids, np.int64)
            cuts = [*(4 * np.flatnonzero(np.diff(of, prepend=-1))).tolist(), len(ids)]
            known += [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return known

    def _learn_whole(self, pieces: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, np.int32).tobytes() for e in found]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as int32, and how many belong to each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        # Spelling is folded anyway; only marks for special ids depend on case.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self._known) > self._remembered:
            self._known, self._older = {}, self._known
        ids = self._look_up(pieces, self._learn)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        starts = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy(zero_copy_only=False)
        each = lengths[at]
        after = np.concatenate([[0], np.cumsum(each)])
        out = flat[np.repeat(starts[at] - after[:-1], each) + np.arange(after[-1])]
        ends = split.offsets.to_numpy(zero_copy_only=False) - split.offsets[0].as_py()
        return out, np.diff(after[ends])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker."""
    return Encoder(path)


def slices(texts: pa.Array, most_chars: int = BATCH_CHARS):
    """Slices of the array whose texts together stay near a number of bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // most_chars
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield a, b
