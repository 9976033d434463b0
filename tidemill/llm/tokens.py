"""Token ids of whole texts by a public tokenizer, through a bounded cache of text chunks.

Prose repeats its words, so a task encodes each distinct chunk once. Chunks, the cache and the ids
gathered from it are Arrow arrays, so that no Python code runs per known chunk. A chunk ends only
where the tokenizer's own pre-tokenisation ends a piece, so the ids of the chunks, joined, are the
ids of the whole text. The cut rules:

``space``  byte-level BPE whose pieces are an optional space and what follows: a cut
           before every single space, and around every single line feed, between two
           characters that aren't white space.
``white``  tokenizers that drop white space: a cut at every space and line feed.
``None``   any other tokenizer: the whole text is one chunk and nothing is cached.

With both rules a run of letters ends where punctuation begins, so that a chunk that ends in
punctuation is made of two that others share; ``white`` tokenizers also lower the case. What is left
and consists of letters alone is one piece, which needs the vocabulary but no pre-tokenisation.
"""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# What Python takes for white space, and what Latin-1 and Latin's first extensions don't hold, for Arrow.
_WHITE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BEYOND_LATIN = r"[^\x00-\xff]"
_BEYOND_EXTENDED = r"[^\x00-\x{24f}]"
# Marks a chunk that no space precedes; with the rule "space", one precedes all others.
_BARE = "\t"
_FEED = _BARE + "\n"
_JOINED = 2_000
_TAIL = string.punctuation.replace("'", "")
_IDS = pa.large_binary()
_NOTHING = pa.scalar(b"", _IDS)


def _true(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)


def _matches(texts: pa.Array, pattern: str) -> np.ndarray:
    return _true(pc.match_substring_regex(texts, pattern))


def _sizes(values: pa.Array) -> np.ndarray:
    return pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)


def _of_letters_alone(texts: pa.Array) -> np.ndarray:
    """str.isalpha; Arrow's own may know letters of a later Unicode than Python's."""
    alone = _true(pc.utf8_is_alpha(texts)).copy()
    far = np.flatnonzero(alone & _matches(texts, _BEYOND_EXTENDED))
    if len(far):
        alone[far] = [t.isalpha() for t in texts.take(pa.array(far)).to_pylist()]
    return alone


def _in_place(values: list[pa.Array], at: list[np.ndarray]) -> pa.Array:
    """One array of all values, each at its position."""
    back = np.argsort(np.concatenate(at), kind="stable")
    return pa.concat_arrays(values).take(pa.array(back))


class ChunkEncoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, rule: str | None, cached_chars: int = 4_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.rule, self.cached_chars = rule, cached_chars
        # Known parts of chunks, their ids, whether they aren't regular, and whether this generation used them.
        self.parts, self.ids = pa.array([], pa.string()), pa.array([], _IDS)
        self.odd, self.used = np.zeros(0, dtype=bool), np.zeros(0, dtype=bool)
        if rule:
            # Byte-level tokens spell a character per byte.
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
            for token, i in vocabulary.items():
                self.bytes[i] = len(token.removesuffix("</w>") if rule == "white" else token)
            self.letters = self._of_letters(path)

    def _of_letters(self, path: str):
        """The same vocabulary for words of letters in lower case: cut at spaces only."""
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cut = {"type": "WhitespaceSplit"}
        if self.rule == "space":
            cut = {"type": "Split", "pattern": {"String": " "}, "behavior": "MergedWithNext", "invert": False}
        spelt = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        parts |= {
            "added_tokens": [], "normalizer": None, "post_processor": None,
            "pre_tokenizer": {"type": "Sequence", "pretokenizers": [cut, spelt]},
        }
        return Tokenizer.from_str(json.dumps(parts))

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _together(self, parts: pa.Array, letters: bool) -> pa.Array | None:
        """The ids of parts encoded as one text, parted by the bytes that the tokens spell."""
        tokenizer = self.letters if letters else self.tokenizer
        text = pc.binary_join(pa.array([parts.to_pylist()], pa.list_(pa.string())), " ")[0].as_py()
        sizes, gaps = _sizes(parts), np.zeros(len(parts), dtype=np.int64)
        if self.rule == "space":
            text = f" {text}".replace(f" {_BARE}", "\n")
            gaps = _true(pc.starts_with(parts, _BARE)).astype(np.int64)
            sizes += 1 - 2 * gaps
        elif not letters:
            sizes = _sizes(pa.array(tokenizer.normalizer.normalize_str(text).split(" "), pa.string()))
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        if len(sizes) != len(parts):
            return None
        ends = np.cumsum(gaps + sizes)
        upto = np.concatenate([[0], np.cumsum(self.bytes[ids])])
        if upto[-1] != ends[-1]:
            return None
        first, last = np.searchsorted(upto, ends - sizes), np.searchsorted(upto, ends)
        if (upto[first] != ends - sizes).any() or (upto[last] != ends).any():
            return None
        # A gap is a byte, so that it is one token.
        ids = np.delete(ids, first[gaps > 0] - 1)
        offsets = 4 * np.concatenate([[0], np.cumsum(last - first)])
        return pa.Array.from_buffers(_IDS, len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])

    def _parts(self, chunks: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """For chunks the parts that have their ids together: one each, and a second for some, and for which."""
        trimmed = pc.ascii_rtrim(chunks, characters=_TAIL)
        short = np.flatnonzero(_sizes(trimmed) < _sizes(chunks))
        last = pc.utf8_slice_codeunits(trimmed.take(pa.array(short)), -1)
        # The one letter that in lower case ends in a mark, which isn't a letter.
        short = short[_of_letters_alone(last) & ~_true(pc.equal(last, "\u0130"))]
        whole = chunks.take(pa.array(short)).to_pylist()
        kept = pc.utf8_length(trimmed.take(pa.array(short))).to_pylist()
        bare = _BARE if self.rule == "space" else ""
        tails = pa.array([bare + c[n:] for c, n in zip(whole, kept)], pa.string())
        cut = np.zeros(len(chunks), dtype=bool)
        cut[short] = True
        bodies = pc.if_else(pa.array(cut), trimmed, chunks)
        if not bare:
            # Letters of Latin-1 have no other composed form, in either case.
            bodies = pc.if_else(pa.array(_matches(bodies, _BEYOND_LATIN)), bodies, pc.utf8_lower(bodies))
        return bodies, tails, short

    def _of_parts(self, parts: pa.Array) -> pa.Array:
        """The ids of distinct regular parts."""
        alone = _of_letters_alone(parts)
        if self.rule != "space":
            alone &= ~_matches(parts, _BEYOND_LATIN)
        values, at = [pa.array([], _IDS)], [np.zeros(0, dtype=np.int64)]
        for letters in (False, True):
            where = np.flatnonzero(alone == letters)
            chosen = parts.take(pa.array(where))
            for start in range(0, len(chosen), _JOINED):
                some = chosen.slice(start, _JOINED)
                ids = self._together(some, letters)
                if ids is None:
                    chunks = some.to_pylist()
                    ids = pa.array(self._ids([c[1:] if c[:1] == _BARE else " " + c for c in chunks]
                                             if self.rule == "space" else chunks), _IDS)
                values.append(ids)
            at.append(where)
        return _in_place(values, at)

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks of all texts one after the other, and where each text's chunks start."""
        if self.rule == "white":
            marked = pc.replace_substring(texts, "\n", " ")
        else:
            # Texts that hold the mark themselves get a chunk that isn't regular.
            plain = pc.if_else(pc.match_substring(texts, _BARE), "  ", texts)
            marked = pc.binary_join_element_wise(
                _BARE, pc.replace_substring(plain, "\n", f" {_FEED} {_BARE}"), ""
            )
        lists = pc.split_pattern(marked, " ")
        return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()

    def _regular(self, chunk: str) -> bool:
        if self.rule == "white":
            return True
        body = chunk[1:] if chunk[:1] == _BARE else chunk
        return bool(body) and not body[0].isspace() and not body[-1].isspace()

    def _learn(self, missing: pa.Array) -> None:
        """Keep the ids of distinct parts that aren't known."""
        bodies = missing
        if self.rule == "space":
            bare = pc.starts_with(missing, _BARE)
            bodies = pc.if_else(bare, pc.utf8_slice_codeunits(missing, 1), missing)
        plain = (_sizes(bodies) > 0) & ~_matches(bodies, _WHITE)
        # Those that have white space inside, or are empty.
        rest = np.flatnonzero(~plain)
        chunks, found = missing.take(pa.array(rest)).to_pylist(), [None] * len(rest)
        plain[[k for i, k in enumerate(rest.tolist()) if not self._odd(chunks, found, i)]] = True
        regular = np.flatnonzero(plain)
        odd = {k: x for k, x in zip(rest.tolist(), found) if x is not None}
        values = [self._of_parts(missing.take(pa.array(regular))), pa.array([x or b"" for x in odd.values()], _IDS)]
        new = np.zeros(len(missing), dtype=bool)
        new[[k for k, x in odd.items() if x is False]] = True
        where = np.fromiter(odd, dtype=np.int64, count=len(odd))
        self.ids = pa.concat_arrays([self.ids, _in_place(values, [regular, where])])
        self.odd = np.concatenate([self.odd, new])
        self.used = np.concatenate([self.used, np.zeros(len(missing), dtype=bool)])

    def _turn(self) -> None:
        """Once the parts in use are many, those that weren't in use since the last time are dropped."""
        if _sizes(self.parts)[self.used].sum() > self.cached_chars:
            keep = pa.array(self.used)
            self.parts, self.ids, self.odd = self.parts.filter(keep), self.ids.filter(keep), self.odd[self.used]
            self.used = np.zeros(len(self.odd), dtype=bool)

    def _odd(self, missing: list[str], found: list, i: int) -> bool:
        """Whether chunk i isn't regular; if so, its ids are put in its place, or False if its text is cut otherwise."""
        chunk = missing[i]
        if not chunk or chunk == _FEED:
            found[i] = self._ids(["\n"])[0] if chunk else self.rule == "white" and b""
        elif not self._regular(chunk):
            found[i] = False
        elif self.rule == "white" and chunk.split() != [chunk]:
            found[i] = self._ids([chunk])[0]  # other white space inside would count as a cut
        return found[i] is not None

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids end."""
        chunks, starts = self._cut(texts)
        coded = chunks.dictionary_encode()
        self._turn()
        bodies, tails, cut = self._parts(coded.dictionary)
        # Known parts come first, so that an index below their number is one of theirs.
        held, n = len(self.parts), len(bodies)
        joined = pa.concat_arrays([self.parts, bodies, tails]).dictionary_encode()
        at, self.parts = joined.indices.to_numpy()[held:], joined.dictionary
        self._learn(self.parts.slice(held))
        self.used[at] = True
        tail = np.zeros(n, dtype=np.int64)
        tail[cut] = at[n:]
        no_tail = np.ones(n, dtype=bool)
        no_tail[cut] = False
        found = pc.binary_join_element_wise(
            self.ids.take(pa.array(at[:n])), self.ids.take(pa.array(tail, mask=no_tail)), _NOTHING,
            null_handling="skip",
        )
        # The ids of the chunks, gathered from those of the distinct ones.
        flat = found.take(coded.indices)
        _, offsets, data = flat.buffers()
        upto = np.frombuffer(offsets, "<i8", len(flat) + 1) // 4
        ids = np.frombuffer(data, "<u4", upto[-1]) if len(flat) and upto[-1] else np.zeros(0, dtype="<u4")
        ends, is_odd = upto[starts], self.odd[at[:n]]
        if is_odd.any():  # white space that isn't single: cut at single spaces only
            count = np.concatenate([[0], np.cumsum(is_odd[coded.indices.to_numpy()])])[starts]
            parts = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            for i in np.flatnonzero(np.diff(count)).tolist():
                first, *rest = _SINGLE_SPACE.split(texts[i].as_py())
                parts[i] = np.frombuffer(b"".join(self._ids([first, *(" " + c for c in rest)])), dtype="<u4")
            return np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return ids, ends[1:]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if self.rule is None or not len(texts):
            return self._ids(texts.to_pylist())
        ids, ends = self.encode_flat(texts)
        data, upto = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *upto], upto)]


@lru_cache(maxsize=4)
def encoder(path: str, rule: str | None, cached_chars: int = 4_000_000) -> ChunkEncoder:
    """One encoder per Python worker, kept from task to task."""
    return ChunkEncoder(path, rule, cached_chars)


def batches(texts: pa.Array, most_bytes: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Slices of an array of texts with at most so many bytes, one text at least."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + most_bytes, side="right")))
        yield start, end
        start = end


def gathered(frames: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches joined up to so many bytes, so that a worker meets fewer distinct chunks in all."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += frame.nbytes
        if size >= most_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)
