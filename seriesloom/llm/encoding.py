"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

Both kinds of public tokenizers cut a text at white space before they merge, so the ids of a text are
those of its words in a row. A word is looked up with the space or line break before it, by two 64-bit
hashes of its bytes. Where that doesn't hold (runs of white space in a tokenizer that keeps it, or one of
the tokenizer's own special tokens), the whole text goes to the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from .shared import worker_memory
from .words import mix, powers

#: Distinct words that a worker remembers; then it starts anew.
REMEMBERED = 600_000

#: Bytes of text looked at together: what is made on the way is some forty times as large.
RUN = 1 << 18

#: Characters that count as white space in the tokenizers' patterns (fixed values).
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"

#: What precedes a word: nothing (the start of a text), a space, a line break.
FIRST, SPACED, BROKEN = 0, 1, 2

#: Words that tokenizers cut into letters and, if any, signs after them.
PLAIN = re.compile("\n?([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:*$%&#|]*)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts; ``keeps_space`` tells whether white space has ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keeps_space = bool(self.plainly([" "])[0])
        self.model = self.tokenizer.model
        # How the tokenizer writes letters before it merges them.
        lower = self.plainly(["A"]) == self.plainly(["a"])
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: spell.pre_tokenize_str(chr(c).lower() if lower else chr(c))[0][0] for c in range(65, 256) if PLAIN.fullmatch(chr(c))}
        self.newline = self.tokenizer.token_to_id("Ċ")
        self.forget()

    def forget(self) -> None:
        """Start without words: sorted hashes, and the number by which a word's ids are found."""
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)
        self.unsafe = np.zeros(0, bool)

    def plainly(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_letters(self, before: int, letters: str, signs: str) -> list[int]:
        """Ids of a plain word: both kinds of tokenizers merge its letters alone, and then its signs."""
        text = letters.translate(self.letters)
        ids = []
        if self.keeps_space:
            if before == BROKEN:
                ids = [self.newline]
            elif before == SPACED:
                text = "Ġ" + text
        ids += [t.id for t in self.model.tokenize(text)]
        if signs:
            ids += [t.id for t in self.model.tokenize(signs)]
        return ids

    def learn(self, words: list[str], before: list[int]) -> None:
        """Encode words that were not met before."""
        found: list[list[int]] = [[]] * len(words)
        rest = []
        for i, w in enumerate(words):
            cut = PLAIN.fullmatch(w)
            if cut:
                found[i] = self.of_letters(before[i], cut[1], cut[2])
            else:
                rest.append(i)
        lead = ("", " ", "\n") if self.keeps_space else ("", "", "")
        for i, ids in zip(rest, self.plainly([lead[before[i]] + words[i] for i in rest]), strict=True):
            found[i] = ids
        # A word that is empty, or begins or ends with white space of its own, is part of a longer run.
        bad = np.zeros(len(words), bool)
        for i in rest:
            w = words[i]
            bad[i] = self.keeps_space and before[i] != FIRST and (w == "" or w[0] in WHITE or w[-1] in WHITE)
        self.flat = np.concatenate([self.flat, np.fromiter((x for ids in found for x in ids), np.uint32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(ids) for ids in found], dtype=np.int64)])
        self.unsafe = np.concatenate([self.unsafe, bad])

    def encode(self, texts: list[str | None], end: int) -> Iterator[np.ndarray]:
        """The ids of each text, then ``end``."""
        last = np.array([end], np.uint32)
        held: list[tuple[int, bytes, int]] = []
        whole: dict[int, str] = {}
        size, first = 0, 0
        for i, text in enumerate(texts):
            text = text or ""
            # White space at the very start is a run of its own.
            if self.keeps_space and text[:1] in WHITE and text or any(s in text for s in self.special):
                whole[i] = text
                held.append((i, b"", FIRST))
            else:
                for part, before in _parts(text.encode("utf-8", "surrogatepass")):
                    held.append((i, part, before))
                    size += len(part) + 1
            if size >= RUN or i + 1 == len(texts):
                yield from self._encode(texts, first, i + 1, held, whole, last)
                held, whole, size, first = [], {}, 0, i + 1

    def _encode(self, texts: list, first: int, stop: int, held: list[tuple[int, bytes, int]], whole: dict[int, str], last: np.ndarray) -> Iterator[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self.forget()
        parts: dict[int, list[np.ndarray]] = {i: [] for i in range(first, stop)}
        at = 0
        while at < len(held):
            # Runs of about a slice; longer texts come in parts of that size.
            to, size = at, 0
            while to < len(held) and (to == at or size + len(held[to][1]) <= RUN):
                size += len(held[to][1]) + 1
                to += 1
            for (i, _, _), ids in zip(held[at:to], self._ids([h[1] for h in held[at:to]], [h[2] for h in held[at:to]]), strict=True):
                if ids is None:
                    whole.setdefault(i, texts[i])
                else:
                    parts[i].append(ids)
            at = to
        for i in range(first, stop):
            if i in whole:
                yield np.array([*self.tokenizer.encode(whole[i], add_special_tokens=False).ids, last[0]], np.uint32)
            else:
                yield np.concatenate([*parts[i], last])

    def _ids(self, parts: list[bytes], before: list[int]) -> Iterator[np.ndarray | None]:
        """The ids of each part, or None where its words don't tell them."""
        data = b" ".join(parts) + b" "
        b = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero((b == 32) | (b == 10))
        starts = np.concatenate([[0], ends[:-1] + 1])
        up, down = powers(len(b) + 1)
        hashes = []
        for table in _BYTES:
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(table[b] * up[:-1], out=total[1:])
            hashes.append((total[ends] - total[starts]) * down[starts])
        lead = np.full(len(starts), SPACED, np.uint64)
        lead[1:][b[ends[:-1]] == 10] = BROKEN
        part_ends = np.searchsorted(ends, np.cumsum([len(p) + 1 for p in parts]))
        part_starts = np.concatenate([[0], part_ends[:-1]])
        lead[part_starts] = before
        if not self.keeps_space:
            lead[:] = FIRST
        key = mix(hashes[0] + lead * np.uint64(0xD6E8FEB86659FD93))
        check = mix(hashes[1] + (ends - starts).astype(np.uint64))

        distinct, sample, place = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        new = at == len(self.keys)
        new[~new] = self.keys[at[~new]] != distinct[~new]
        if new.any():
            fresh = sample[new]
            self.learn([data[a:z].decode("utf-8", "surrogatepass") for a, z in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)], lead[fresh].tolist())
            self.numbers = np.insert(self.numbers, at[new], np.arange(len(self.keys), len(self.keys) + len(fresh)))
            self.checks = np.insert(self.checks, at[new], check[fresh])
            self.keys = np.insert(self.keys, at[new], distinct[new])
            at = np.searchsorted(self.keys, distinct)
        w = self.numbers[at][place]
        # Words of one hash that differ in the other would be mistaken for each other.
        doubtful = self.unsafe[w] | (self.checks[at][place] != check)
        start, length = self.ends[w], self.ends[w + 1] - self.ends[w]
        done = np.cumsum(length)
        ids = self.flat[np.repeat(start - done + length, length) + np.arange(done[-1])]
        done, spoilt = np.concatenate([[0], done]), np.concatenate([[0], np.cumsum(doubtful)])
        for a, z in zip(part_starts, part_ends, strict=True):
            yield None if spoilt[z] > spoilt[a] else ids[done[a] : done[z]]


#: What each byte counts in the two hashes.
_BYTES = (np.arange(1, 257, dtype=np.uint64), mix(np.arange(1, 257, dtype=np.uint64)))


def _parts(data: bytes) -> Iterator[tuple[bytes, int]]:
    """A text cut at spaces or line breaks into parts of about a slice, each with what precedes it."""
    at, before = 0, FIRST
    while len(data) - at > 2 * RUN:
        cuts = [i for i in (data.find(b" ", at + RUN), data.find(b"\n", at + RUN)) if i >= 0]
        if not cuts:
            break
        cut = min(cuts)
        yield data[at:cut], before
        at, before = cut + 1, BROKEN if data[cut] == 10 else SPACED
    yield data[at:], before


def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder of a tokenizer file."""
    return worker_memory("encoder_" + path, lambda: WordEncoder(path))
