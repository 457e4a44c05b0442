"""Token ids of whole texts from a public tokenizer file, with a bounded cache of encoded pieces."""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestone.llm.common import kept

_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A space next to white space, where a cut at the space could change how the pattern splits the text.
_RUN = f" {_WHITE}|{_WHITE} "


#: Letters with one space at most before them, and marks after them, which any of the patterns keeps apart from the letters.
#: The letters are composed, and lower-casing keeps their number.
_WORD = r"^(?P<word> ?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]+)(?P<marks>[.,;:!?]*)$"
#: Words that are encoded as one text.
_JOINED = 64


class PieceEncoder:
    """Encodes texts piece by piece, where pieces are cut only at places that can't change the ids.

    spaced: byte-level vocabularies, in which a word's leading space is part of the piece. A single space between two other
    characters is a cut: no match of the pattern spans it, and nothing looks behind it. Texts with a space next to white
    space are encoded whole. Otherwise white space is dropped by the tokenizer, and any space is a cut.
    New words are joined to short texts and their ids parted at the mark that opens (spaced) or closes each word's ids; where
    these don't part as many words as went in, the batch's words are encoded one by one.
    Texts that hold the string of an added token (special ones too) are encoded whole, so ids are those of the tokenizer as it is
    read from its file: such a string is that token. With special_as_text it is ordinary text.
    `limit` bounds the pieces that are kept between batches; those met early stay.
    """

    def __init__(self, path: str, spaced: bool, limit: int = 400_000, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.joined = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.joined.model._resize_cache(0)  # what recurs is in `known`
        for x in (self.tokenizer, self.joined):
            x.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [x.content for x in added if not (x.special and special_as_text)]
        # what a normalizer turns into such a string isn't looked for, so all texts are whole then
        self.whole = self.tokenizer.normalizer is not None and any(x.normalized and x.content in self.added for x in added)
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for x, i in vocabulary.items() if (x.startswith("\u0120") if spaced else x.endswith("</w>"))]] = True
        self.spaced, self.limit = spaced, limit
        self.known: dict[str, bytes] = {}

    def plain(self, texts: list[str]) -> pa.Array:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return pa.array([array("I", x.ids).tobytes() for x in found], pa.large_binary())

    def words(self, words: list[str]) -> pa.Array:
        """Ids of words; with `spaced`, each begins with a space."""
        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        found = self.joined.encode_batch_fast([("" if self.spaced else " ").join(x) for x in groups], add_special_tokens=False)
        flat, sizes = array("I"), []
        for x in found:
            ids = x.ids
            sizes.append(len(ids))
            flat.extend(ids)
        ids = np.frombuffer(flat, np.uint32)
        edges = self.edge[ids]
        # each group must part into its words, at its first or last id too
        ends = np.cumsum(sizes, dtype=np.int64)
        counts = np.diff(np.r_[0, np.cumsum(edges)][np.r_[0, ends]]) if len(sizes) else np.zeros(0, np.int64)
        outer = edges[ends - np.array(sizes, np.int64)] if self.spaced else edges[ends - 1]
        if not (all(sizes) and outer.all() and np.array_equal(counts, np.fromiter(map(len, groups), np.int64))):
            return self.plain(words)
        at = np.flatnonzero(edges)
        bounds = np.r_[at, len(ids)] if self.spaced else np.r_[0, at + 1]
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer((4 * bounds).astype(np.int64)), pa.py_buffer(flat.tobytes())])

    def units(self, units: pa.Array, is_word: np.ndarray) -> pa.Array:
        """Ids of distinct words and other pieces, from `known` where they are there."""
        names = units.to_numpy(zero_copy_only=False).tolist()  # faster than by scalars
        held = list(map(self.known.get, names))
        new = np.fromiter((x is None for x in held), bool, len(held))
        words, others = np.flatnonzero(new & is_word), np.flatnonzero(new & ~is_word)
        pick = names.__getitem__
        found = pa.concat_arrays([self.words(list(map(pick, words))), self.plain(list(map(pick, others)))])
        fresh = np.r_[words, others]
        room = max(0, self.limit - len(self.known))
        self.known.update(zip(map(pick, fresh[:room]), found.slice(0, room).to_pylist(), strict=False))
        old = np.flatnonzero(~new)
        place = np.empty(len(names), np.int64)
        place[np.r_[old, fresh]] = np.arange(len(names))
        return pa.concat_arrays([pa.array(map(held.__getitem__, old), pa.large_binary()), found]).take(pa.array(place))

    def pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces: a word's and its marks' are joined."""
        parts = pc.extract_regex(pieces, _WORD)
        ok = parts.is_valid()
        matched = ok.to_numpy(zero_copy_only=False)
        units = pc.if_else(ok, pc.struct_field(parts, "word"), pieces).dictionary_encode()
        marks = pc.fill_null(pc.struct_field(parts, "marks"), "").dictionary_encode()
        codes = units.indices.to_numpy()
        is_word = np.zeros(len(units.dictionary), bool)
        is_word[codes] = matched
        if self.spaced:
            is_word &= pc.starts_with(units.dictionary, " ").to_numpy(zero_copy_only=False)
        ids = self.units(units.dictionary, is_word).take(units.indices)
        after = self.units(marks.dictionary, np.zeros(len(marks.dictionary), bool)).take(marks.indices)
        return pc.binary_join_element_wise(ids, after, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        bad = pc.match_substring_regex(texts, _RUN) if self.spaced else pa.array(np.zeros(len(texts), bool))
        for x in self.added:
            bad = pc.or_(bad, pc.match_substring(texts, x))
        if self.whole:
            bad = pa.array(np.ones(len(texts), bool))
        odd = np.flatnonzero(bad.to_numpy(zero_copy_only=False))
        whole = self.plain(texts.take(pa.array(odd)).to_pylist()).to_pylist() if len(odd) else []
        if len(odd):
            texts = pc.if_else(bad, pa.scalar("", pa.large_string()), texts)
        cut = pc.split_pattern(texts if self.spaced else pc.replace_substring(texts, "\n", " "), " ")
        bounds = cut.offsets.to_numpy()
        coded = cut.values[bounds[0] : bounds[-1]].dictionary_encode()
        bounds = bounds - bounds[0]
        codes, pieces = coded.indices.to_numpy().copy(), coded.dictionary
        if self.spaced and len(texts):
            first = pieces.take(pa.array(codes[bounds[:-1]]))
            codes[bounds[:-1]] = len(pieces) + np.arange(len(first))
            none = pa.scalar("", pa.large_string())
            pieces = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pieces, none), first])
        taken = self.pieces(pieces).take(pa.array(codes))
        if not len(taken):
            return [b""] * len(texts)
        ends, raw = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1], memoryview(taken.buffers()[2] or b"")
        at = ends[bounds].tolist()
        out = [bytes(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        for i, x in zip(odd.tolist(), whole, strict=True):
            out[i] = x
        return out


def encoder(path: str, spaced: bool) -> PieceEncoder:
    """The encoder of a worker process, which serves its tasks until another operator runs there; `kept` has it under this call's arguments."""
    return kept((path, spaced), lambda: PieceEncoder(path, spaced))
