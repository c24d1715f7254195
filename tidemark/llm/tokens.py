"""Token ids of whole texts, each distinct word encoded once a task.

With a byte-level vocabulary whose texts are cut by the usual pattern, no token reaches
over a single space between two other characters: what stands before it ends there, and
what follows begins with it. So a text is its first word followed by its other words, each
with the space before it, and the ids of a text are theirs in order. Words repeat, so the
tokenizer sees each once. Texts with other spacing (two spaces, a space beside a line
break, at an end) go through the tokenizer whole, as do all texts of other kinds of
vocabulary.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Distinct words a worker remembers before it starts anew.
CACHE_WORDS = 1_200_000
#: Characters given to the tokenizer at once.
PIECE_CHARS = 1 << 14

_encoders: dict[str, Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> Encoder:
    """The encoder of this worker for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        cut = spec.get("pre_tokenizer") or {}
        self.by_words = (
            cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space", True)
            and cut.get("use_regex", True)
            and not spec.get("normalizer")
        )
        size = self.tokenizer.get_vocab_size()
        self.after_space = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros((1 << 14) + 1, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Adds words, each encoded behind a space."""
        sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        cuts = np.unique(np.append(np.searchsorted(sizes, np.arange(0, int(sizes[-1]), PIECE_CHARS)), len(words))).tolist()
        ids = np.concatenate([self._encode([" " + " ".join(words[a:b])])[0] for a, b in zip(cuts, cuts[1:])])
        starts = np.flatnonzero(self.after_space[ids])
        if len(starts) != len(words):
            raise RuntimeError("a word was not kept apart by the tokenizer")
        have = len(self.known)
        end = int(self.starts[have])
        while len(self.ids) < end + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.starts) < have + len(words) + 1:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[end : end + len(ids)] = ids
        self.starts[have : have + len(words)] = end + starts
        self.starts[have + len(words)] = end + len(ids)
        self.known = pa.concat_arrays([self.known, pa.array(words, pa.large_string())])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has; a null text has none."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if not self.by_words:
            each = self._encode(texts.to_pylist())
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(e) for e in each], np.int64)
        parts = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        coded = parts.flatten().dictionary_encode()
        del parts
        codes = coded.indices.to_numpy(zero_copy_only=False)
        odd = _odd_ends(coded.dictionary)
        words = coded.dictionary.cast(pa.large_string())
        firsts = np.cumsum(counts) - counts
        whole = np.zeros(n, bool)
        if odd.any():
            whole[np.repeat(np.arange(n), counts)[odd[codes]]] = True
        inner = np.repeat(~whole, counts)
        inner[firsts] = False
        used = np.zeros(len(words), bool)
        used[codes[inner]] = True
        if len(self.known) > CACHE_WORDS:
            self._forget()
        # Looked up as a column: only words not seen before become Python's.
        found = pc.index_in(words, value_set=self.known)
        place = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
        new = np.flatnonzero(used & found.is_null().to_numpy(zero_copy_only=False))
        if len(new):
            place[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(words.take(pa.array(new)).to_pylist())

        # Pieces in the order of the texts: what stands first or a whole text, then its words.
        rows = texts.to_pylist() if whole.any() else None
        first_words = words.take(pa.array(codes[firsts])).to_pylist()
        heads = self._encode([rows[i] if whole[i] else first_words[i] for i in range(n)]) if n else []
        del rows, words, first_words, found, new
        head_len = np.array([len(h) for h in heads], np.int32)
        pool = np.concatenate([self.ids[: self.starts[len(self.known)]], *heads])
        place = place[codes]
        piece_at = self.starts[place].astype(np.int32)
        piece_len = self.starts[place + 1].astype(np.int32) - piece_at
        piece_at[firsts] = self.starts[len(self.known)] + np.cumsum(head_len) - head_len
        piece_len[firsts] = head_len
        inner[firsts] = True
        piece_len[~inner] = 0
        ends = np.cumsum(piece_len, dtype=np.int64)
        lengths = np.diff(ends[np.cumsum(counts) - 1], prepend=0) if n else np.zeros(0, np.int64)
        total = int(ends[-1]) if n else 0
        at = np.repeat((piece_at - (ends - piece_len)).astype(np.int32), piece_len)
        at += np.arange(total, dtype=np.int32)
        return pool[at], lengths


def _odd_ends(words: pa.Array) -> np.ndarray:
    """Which words are empty, or begin or end with white space."""
    odd = np.zeros(len(words), bool)
    for ends in (pc.utf8_slice_codeunits(words, 0, 1), pc.utf8_slice_codeunits(words, -1)):
        coded = ends.dictionary_encode()
        space = np.array([not c or c.isspace() for c in coded.dictionary.to_pylist()], bool)
        if len(space):
            odd |= space[coded.indices.to_numpy(zero_copy_only=False)]
    return odd


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one more id after each text."""
    ends = np.cumsum(lengths)
    return np.insert(ids, ends, np.uint32(end_id)), lengths + 1
