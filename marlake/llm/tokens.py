"""Token ids of whole texts from a public word-level vocabulary, with a bounded cache of word pieces."""

from __future__ import annotations

import json
from array import array
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, normalizers, pre_tokenizers

CACHE_PIECES = 300_000
# Words of printable ASCII and Latin-1 without an apostrophe or the mark of a special token.
PLAIN_WORD = r"^[\x21-\x26\x28-\x3b\x3d-\x7e\x{a1}-\x{ff}]*$"
# What the vocabulary's own pattern cuts such a word into, besides runs of letters: one digit, or a run of the rest.
NO_LETTERS = r"(\p{N}|[^\s\p{L}\p{N}]+)"


class WordEncoder:
    """Encodes texts by looking up their distinct words.

    For a vocabulary that drops white space and cuts at it, a text's ids are those of its words,
    one after the other. The distinct words of a slice are lower-cased and cut into pieces by
    Arrow, and each distinct piece is encoded once by the tokenizers library and kept in a cache
    (emptied at ``CACHE_PIECES`` entries). A word with any character besides printable ASCII and
    Latin-1, an apostrophe or ``<`` goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            cuts = [p["type"] for p in json.load(f)["pre_tokenizer"]["pretokenizers"]]
        if cuts != ["Split", "ByteLevel"]:
            raise ValueError(f"{path} does not cut texts at white space")
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.clear()

    @cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer as it is, loaded when the first odd word comes."""
        return Tokenizer.from_file(self.path)

    def clear(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.starts, self.lengths, self.flat = array("q", [0]), array("i", [0]), array("I")

    def add(self, names: list[str], ids: np.ndarray, edges: np.ndarray) -> None:
        self.slots.update(zip(names, range(len(self.starts), len(self.starts) + len(names))))
        self.starts.frombytes((edges[:-1] + len(self.flat)).astype(np.int64).tobytes())
        self.lengths.frombytes(np.diff(edges).astype(np.int32).tobytes())
        self.flat.frombytes(ids.astype(np.uint32).tobytes())

    def find(self, names: list[str]) -> np.ndarray:
        """Slots of pieces, which are encoded first if they are new."""
        new = [p for p in names if p not in self.slots]
        if new:
            found = self.merges.encode(new, is_pretokenized=True, add_special_tokens=False)
            self.add(new, np.array(found.ids), np.searchsorted(np.asarray(found.word_ids), np.arange(len(new) + 1)))
        return np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))

    def find_odd(self, names: list[str]) -> np.ndarray:
        """Slots of whole words that take the tokenizer's full path; kept apart from pieces by a leading blank."""
        keys = [f" {w}" for w in names]
        new = [i for i, k in enumerate(keys) if k not in self.slots]
        if new:
            found = [e.ids for e in self.whole.encode_batch([names[i] for i in new], add_special_tokens=False)]
            self.add([keys[i] for i in new], np.array([x for ids in found for x in ids], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in found])]))
        return np.fromiter(map(self.slots.__getitem__, keys), np.int64, len(keys))

    def words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the pieces of all words in one array, and the offsets at which each word begins."""
        odd = self.is_odd(distinct)
        lone = pc.and_not(pc.utf8_is_alpha(distinct), odd)
        rest = pc.invert(pc.or_(lone, odd))
        spaced = pc.replace_substring_regex(pc.utf8_lower(pc.filter(distinct, rest)), NO_LETTERS, r" \1 ")
        cut = pc.ascii_split_whitespace(spaced)
        lowered = pc.utf8_lower(pc.filter(distinct, lone))
        coded = pa.concat_arrays([lowered, cut.values]).dictionary_encode()
        found = self.find(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        kinds = [x.to_numpy(zero_copy_only=False) for x in (lone, rest, odd)]
        counts = [np.ones(len(lowered), np.int64), np.diff(cut.offsets.to_numpy()), np.ones(int(kinds[2].sum()), np.int64)]
        slots = [found[: len(lowered)], found[len(lowered) :], self.find_odd(pc.filter(distinct, odd).to_pylist())]
        each = np.empty(len(distinct), np.int64)
        for kind, n in zip(kinds, counts):
            each[kind] = n
        edges = np.concatenate([[0], np.cumsum(each)])
        out = np.empty(edges[-1], np.int64)
        for kind, n, own in zip(kinds, counts, slots):
            out[spread(edges[:-1][kind], n)] = own
        return out, edges

    def is_odd(self, distinct: pa.Array) -> pa.Array:
        ascii = pc.string_is_ascii(distinct)
        marked = pc.or_(pc.match_substring(distinct, "'"), pc.match_substring(distinct, "<"))
        other = pc.invert(ascii)
        strange = pc.invert(pc.match_substring_regex(pc.filter(distinct, other), PLAIN_WORD))
        # An ASCII word is plain unless it holds a control character.
        control = pc.match_substring_regex(pc.filter(distinct, ascii), r"[\x00-\x20\x7f]")
        odd = np.empty(len(distinct), bool)
        ascii = ascii.to_numpy(zero_copy_only=False)
        odd[ascii] = control.to_numpy(zero_copy_only=False)
        odd[~ascii] = strange.to_numpy(zero_copy_only=False)
        return pc.or_(pa.array(odd), marked)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets at which each text begins (one more than texts)."""
        if len(self.slots) > CACHE_PIECES:
            self.clear()
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.values.dictionary_encode()
        pieces, edges = self.words(coded.dictionary)
        lengths = np.frombuffer(self.lengths, np.int32)[pieces]
        ids = np.frombuffer(self.flat, np.uint32)[spread(np.frombuffer(self.starts, np.int64)[pieces], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[edges]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        each = np.diff(ends)[codes]
        offsets = np.concatenate([[0], np.cumsum(each)])
        # Copies, since an array that numpy looks into cannot grow.
        out = ids[spread(ends[:-1][codes], each)]
        at = cut.offsets.to_numpy()
        return out, offsets[at - at[0]]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary file."""
    return WordEncoder(path)
