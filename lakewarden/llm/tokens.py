"""Whole texts to token ids, encoding each distinct word once per worker.

The ids come from the tokenizers library. Most words of a text occur before, in it or in an earlier
one, so texts are cut where every tokenizer of a known kind begins a new token, the pieces are made
distinct by Arrow, and only pieces the worker has not seen go through the library.

Two kinds are known, told by the tokenizer's own file: byte-level BPE whose words carry their leading
space, and BPE with word ends, which drops white space. Of any other tokenizer, and for texts with
special tokens or unusual white space, whole texts go through the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from lakewarden.llm.common import KEPT

#: Text encoded at a time, and the size above which one text is encoded in parts.
SLICE_CHARS = 6_000_000
#: Pieces a worker remembers before it starts anew.
REMEMBERED = 500_000
#: Words in one call of the library.
JOINED = 500
#: Letters that compose with nothing, and whose lower case does not depend on their place.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
#: A word and the marks after it, which begin a new token.
PLAIN = re.compile(rf"(\x01?[{LETTERS}]+)([!-/:-@\[-`{{-~]*)")
#: A place where both kinds begin a new token.
SEAM = re.compile(r"(?<=[!-~]) (?=[!-~])")
#: Marks a piece that has no space before it.
BARE = "\x01"


class CachedEncoder:
    """Encodes string arrays; one per worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        odd = r"[\x00-\x09\x0b-\x1f\x7f-\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        before, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.kind = "whole"
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
            if spec["normalizer"] is None:
                self.kind = "bytes"
                special += [odd, "  ", " \n", "\n ", "\n\n", "^[ \n]", "[ \n]$"]
        elif model.get("end_of_word_suffix") == "</w>" and _drops_space(before):
            self.kind = "ends"
            special += [BARE]
        self.apart = "|".join(special)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.newline = vocabulary.get("Ċ")
        self.bounds = np.zeros(self.size, bool)
        for token, number in vocabulary.items():
            self.bounds[number] = token.endswith("</w>") if self.kind == "ends" else token.startswith("Ġ")
        # The same model for lower-case or spaced words of letters, which need no rules.
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = None
        spaced = pre_tokenizers.ByteLevel(add_prefix_space=self.kind == "bytes", use_regex=False)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), spaced])
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _joined(self, words: list[str], bare: bool) -> list[bytes]:
        """Ids of words of letters, encoded together and cut apart again."""
        out: list[bytes] = []
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            if bare and self.kind == "bytes":
                text = "\n" + "\n".join(some)
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                starts = np.flatnonzero(ids == self.newline)
                ends, starts = np.append(starts[1:], len(ids)), starts + 1
            else:
                ids = np.array(self.words.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
                marks = np.flatnonzero(self.bounds[ids])
                ends = marks + 1 if self.kind == "ends" else np.append(marks[1:], len(ids))
                starts = np.append(0, ends[:-1]) if self.kind == "ends" else marks
            if len(starts) == len(some):
                data = ids.tobytes()
                out += [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            else:
                out += self._library(some if bare or self.kind == "ends" else [f" {w}" for w in some])
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Remember pieces; a word shares its ids with the same word in front of marks."""
        words: dict[bool, dict[str, None]] = {False: {}, True: {}}
        plain, other = [], []
        for piece in pieces:
            match = PLAIN.fullmatch(piece)
            if match is None:
                other.append(piece)
                continue
            key, mark = match.groups()
            if self.kind == "ends":
                key = key.lower()
            if key not in self.known:
                words[key.startswith(BARE)][key] = None
            if mark not in self.marks:
                self.marks[mark] = self._library([mark])[0]
            plain.append((piece, key, mark))
        for bare, group in words.items():
            if group:
                self.known.update(zip(group, self._joined([k[bare:] for k in group], bare), strict=True))
        for piece, key, mark in plain:
            self.known[piece] = self.known[key] + self.marks[mark] if mark else self.known[key]
        if other:
            space = "" if self.kind == "ends" else " "
            texts = [p[1:] if p.startswith(BARE) else p if p == "\n" else space + p for p in other]
            self.known.update(zip(other, self._library(texts), strict=True))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text) of texts that may be cut at spaces."""
        if self.kind == "ends":
            cut = pc.split_pattern(pc.replace_substring(pc.ascii_lower(texts), "\n", " "), " ")
        else:
            bare = pc.replace_substring(texts, "\n", f" \n {BARE}")
            cut = pc.split_pattern(pc.binary_join_element_wise(BARE, bare, ""), " ")
        pieces = cut.flatten().dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known, self.marks = {}, {}
        unknown = [p for p in distinct if p not in self.known]
        if unknown:
            self._learn(unknown)
        found = pa.array(list(map(self.known.__getitem__, distinct)), pa.large_binary()).take(pieces.indices)
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, np.int64, len(found) + 1) // 4
        ids = np.frombuffer(data, "<u4", int(ends[-1])) if ends[-1] else np.zeros(0, "<u4")
        return ids, np.diff(ends[cut.offsets.to_numpy()])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids per text) for consecutive texts, in slices; null is empty."""
        held: list[str] = []
        owner: list[int] = []
        rows = size = 0
        for value in texts:
            for part in _parts(value.as_py() or ""):
                held.append(part)
                owner.append(rows)
                size += len(part)
            rows += 1
            if size >= SLICE_CHARS:
                yield self._slice(held, owner, rows)
                held, owner, rows, size = [], [], 0, 0
                pa.default_memory_pool().release_unused()
        if rows:
            yield self._slice(held, owner, rows)

    def _slice(self, held: list[str], owner: list[int], rows: int) -> tuple[np.ndarray, np.ndarray]:
        array = pa.array(held, pa.string())
        whole = np.ones(len(held), bool)
        if self.kind != "whole":
            whole = pc.match_substring_regex(array, self.apart).to_numpy(zero_copy_only=False).astype(bool)
        if not whole.any():
            ids, counts = self._cut(array)
        else:
            parts = self._library(array.filter(pa.array(whole)).to_pylist())
            counts = np.zeros(len(held), np.int64)
            counts[whole] = [len(p) // 4 for p in parts]
            cut_ids = np.zeros(0, "<u4")
            if not whole.all():
                cut_ids, counts[~whole] = self._cut(array.filter(pa.array(~whole)))
            ids = np.zeros(int(counts.sum()), "<u4")
            takes = np.repeat(whole, counts)
            ids[takes], ids[~takes] = np.frombuffer(b"".join(parts), "<u4"), cut_ids
        return ids, np.bincount(owner, weights=counts, minlength=rows).astype(np.int64)


def _drops_space(before: dict) -> bool:
    """Whether the pre-tokenizer keeps only matches, none of which holds white space."""
    first = next(iter(before.get("pretokenizers", [])), {})
    return first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed"


def _parts(text: str) -> Iterator[str]:
    while len(text) > SLICE_CHARS:
        seam = SEAM.search(text, SLICE_CHARS // 2)
        if seam is None:
            break
        yield text[: seam.start()]
        text = text[seam.start() :]
    yield text


_ENCODERS: dict[str, CachedEncoder] = {}
KEPT.append(_ENCODERS)


def encoder(path: str) -> CachedEncoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]
