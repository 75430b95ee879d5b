"""Whole texts to ids with the ``tokenizers`` library, each distinct word encoded once.

A text may be encoded piece by piece where no token, merge or look-ahead can reach over the
cut. ``spaces`` names the rule that holds for a vocabulary:

* ``"dropped"``: white space only separates words, so any space or line feed is a cut, and
  marks that end a word are cut off it by a space of their own;
* ``"leading"``: byte-level pieces carry one leading space, so a single space or line feed
  between two other characters is a cut before it. Texts with longer white space are cut
  by the same rule spelled out as a pattern, texts with odd blanks only at single spaces
  between ASCII letters or digits;
* ``None``: no cut.

A worker remembers words from one task to the next. Where there are too many, the most used stay;
other work ends that where it needs the memory.

Tests hold all of them against encoding the text as a whole.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Unicode white space, and characters some engines count as such.
BLANK = "\t-\r \u0085   -     　"
BLANK_RE2 = r"\t-\r \x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_RE2 = r"\x{001c}-\x{001f}\x{180e}\x{200b}\x{feff}"
PIECES = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
UNSAFE = f"[{BLANK_RE2}][{BLANK_RE2}]|^[{BLANK_RE2}]|[{BLANK_RE2}]$"
ODD_CUT = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")
#: Words that begin with their only blank, and marks between a word and a space.
SPACED = f"^ [^{BLANK_RE2}{ODD_RE2}]+$"
MARKS, MARKS_APART = r"(\pL)([,.;:!?%&*$]+) ", r"\1 \2 "
#: Words a worker remembers; beyond that, and at a task's end, the most used of them stay. That changes speed only.
REMEMBERED, KEPT = 600_000, 300_000
#: Words encoded in one call; the library's results are large until they are cut to ids.
AT_ONCE = 10_000


def _strings(texts: pa.Array) -> list[str]:
    """``to_pylist``, without a scalar object for each."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    def __init__(self, path: str, spaces: str | None) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.spaces = spaces
        # With word-end tokens, words of letters alone can be encoded as one text and told apart.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # With tokens that begin with the byte of a space, so can words that begin with one.
        self.begins_word = np.zeros(len(self.ends_word), dtype=bool)
        self.begins_word[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 16, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)

    def keep(self, most: int) -> None:
        """Forget all but the ``most`` used words; what is left counts half from now on."""
        if len(self.known) <= most:
            return
        used = np.zeros(len(self.known), dtype=np.int64)
        used[: len(self.uses)] = self.uses
        order = np.sort(np.argsort(-used, kind="stable")[:most])
        words = list(self.known)
        ids, ends = self._gathered(order)
        self.known = {words[i]: k for k, i in enumerate(order.tolist())}
        self.pool = np.concatenate([ids, np.zeros(1 << 16, dtype=np.uint32)])
        self.ends = np.concatenate([ends, np.zeros(1 << 16, dtype=np.int64)])
        self.uses = used[order] // 2

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of remembered words one after the other, and the bounds of each."""
        sizes = self.ends[at + 1] - self.ends[at]
        to = np.concatenate([[0], np.cumsum(sizes)])
        return self.pool[np.arange(to[-1]) + np.repeat(self.ends[at] - to[:-1], sizes)], to

    def _joins(self, words: list[str]) -> list[bool]:
        """Whether each word may be encoded as part of a long text and told apart by its tokens."""
        if self.spaces == "dropped":
            return [w.isalpha() and w.lower().isalpha() for w in words]
        if self.spaces == "leading":
            return pc.match_substring_regex(pa.array(words, pa.large_string()), SPACED).to_pylist()
        return [False] * len(words)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``texts`` joined, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _words(self, words: list[str], together: bool) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded``; if each word has one word end, or beginning, as a few long texts."""
        if together:
            between = " " if self.spaces == "dropped" else ""
            ids, _ = self._encoded([between.join(words[i : i + 500]) for i in range(0, len(words), 500)])
            if self.spaces == "dropped":
                ends = np.flatnonzero(self.ends_word[ids]) + 1
            else:
                ends = np.append(np.flatnonzero(self.begins_word[ids])[1:], len(ids))
            if len(ends) == len(words):
                return ids, np.diff(ends, prepend=0)
        return self._encoded(words)

    def _indices(self, words: list[str]) -> np.ndarray:
        """Places of ``words`` in the memory; unknown ones are encoded first."""
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            n, filled = len(self.known), int(self.ends[len(self.known)])
            new = list(dict.fromkeys(map(words.__getitem__, unknown)))
            joins = self._joins(new)
            alone, together = [w for w, j in zip(new, joins, strict=True) if not j], [w for w, j in zip(new, joins, strict=True) if j]
            new = alone + together
            parts = [self._words(group[i : i + AT_ONCE], group is together) for group in (alone, together) for i in range(0, len(group), AT_ONCE)]
            ids, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            while n + len(new) + 1 > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            while filled + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.ends[n + 1 : n + 1 + len(new)] = filled + np.cumsum(sizes)
            self.pool[filled : filled + len(ids)] = ids
            self.known.update(zip(new, range(n, n + len(new)), strict=True))
            at[unknown] = [self.known[words[i]] for i in unknown]
        return at

    def _joined(self, at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of remembered words, run i being ``at[bounds[i]:bounds[i + 1]]``."""
        ids, to = self._gathered(at)
        uses = np.bincount(at, minlength=len(self.known))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return ids, to[bounds]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as uint32, and the bounds of each text among them. Null is an empty text."""
        if len(self.known) > REMEMBERED:
            self.keep(KEPT)
        texts = pa.array(texts).fill_null("")
        if self.spaces == "dropped":
            apart = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), MARKS, MARKS_APART)
            words = pc.split_pattern(apart, " ")
            coded = words.flatten().dictionary_encode()
            at = self._indices(_strings(coded.dictionary))[coded.indices.to_numpy()]
            offsets = words.offsets.to_numpy().astype(np.int64)
            return self._joined(at, offsets - offsets[0])
        if self.spaces == "leading":
            return self._leading(texts)
        ids, sizes = self._encoded(texts.to_pylist())
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def _leading(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, f"[{ODD_RE2}]").to_numpy(zero_copy_only=False)
        unsafe = pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False) | odd
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~unsafe & ~empty))
        words = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = flat.dictionary_encode()
        inner = coded.dictionary
        blank, nothing = pa.scalar(" ", inner.type), pa.scalar("", inner.type)
        inner = pc.if_else(pc.starts_with(inner, "\n"), inner, pc.binary_join_element_wise(blank, inner, nothing))
        at = self._indices(_strings(inner))[coded.indices.to_numpy()]
        at[offsets[:-1]] = self._indices(_strings(flat.take(pa.array(offsets[:-1]))))
        runs: list[np.ndarray | None] = [None] * len(texts)
        for i, (a, b) in zip(np.flatnonzero(~unsafe & ~empty), zip(offsets[:-1], offsets[1:], strict=True), strict=True):
            runs[i] = at[a:b]
        for i in np.flatnonzero(unsafe | empty):
            text = texts[int(i)].as_py()
            runs[i] = self._indices(ODD_CUT.split(text) if odd[i] else PIECES.findall(text))
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        return self._joined(np.concatenate(runs) if runs else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum(sizes)]))


_ENCODERS: dict[tuple[str, str | None], Encoder] = {}


def encoder(path: str, spaces: str | None) -> Encoder:
    """This worker's encoder for a vocabulary file; it outlives a task."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = Encoder(path, spaces)
    return _ENCODERS[path, spaces]


def release(path: str, spaces: str | None) -> None:
    """End of a task: of a memory that has grown large the most used words stay, for what the worker does next."""
    encoder(path, spaces).keep(KEPT)


def forget() -> None:
    """Forget all words, in a worker that turns to other work."""
    _ENCODERS.clear()


def byte_slices(texts: pa.Array, most: int = 8 << 20) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts, i = [], 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        cuts.append((i, j))
        i = j
    return cuts
