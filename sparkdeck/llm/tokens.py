"""Exact, cached encoding with a public tokenizers file.

The tokenizers library encodes about a megabyte a second; natural text repeats its
words, so a batch's texts are cut into whitespace-bounded chunks and each distinct one is
encoded once, in arrays.  That is exact because neither
vocabulary lets a token cross a single blank between two non-blanks: the word
vocabulary drops white space, the byte vocabulary glues one blank to the next word.
Texts where this does not hold (two white-space characters in a row, letters whose
lower case depends on their neighbours, text that is not NFC) go to the library whole,
and so do chunks that are more than a run of letters with closing marks.

Runs of letters are merged by tiktoken over the vocabulary of the same file (the
ids are the merge order, so both libraries make the same merges; six times faster), those of
ASCII letters anew for each batch, which costs less than to look them up.  Other chunks are
kept in a bounded two-generation cache.
``tests/llm/test_tokens.py`` compares the ids with the library's.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Two characters that Python takes for white space.
_TWO_BLANKS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
_TAIL = ".,;:!?|*$%&#"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_SHARED: dict[tuple, "Encoder"] = {}


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters are themselves, the others follow from U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Cache(dict):
    """Remembers the keys that were asked for in vain."""

    def __init__(self):
        super().__init__()
        self.missing: set[str] = set()

    def __missing__(self, key):
        self.missing.add(key)
        return None


class Encoder:
    """``ids(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str, keep: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True       # their strings in a text are ordinary text
        self.keep, self.new, self.old, self.marks = keep, _Cache(), {}, {}
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.word_ends = self.tok.model.end_of_word_suffix == "</w>"
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        byte, ranks = byte_of(), {}
        self.mark = np.zeros(max(vocab.values()) + 1, bool)      # ids that end (begin) a run of letters
        for s, i in vocab.items():
            if s not in special:
                end = self.word_ends and s.endswith("</w>")
                ranks[bytes(byte[c] for c in (s[:-4] if end else s)) + b"\n" * end] = i
                self.mark[i] = end if self.word_ends else s[0] == "Ġ"
        if self.word_ends:       # "\n" never occurs in a word, so it stands for the end of one
            self.merge = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
        else:
            self.merge = tiktoken.Encoding("bytes", pat_str=r" [^ ]+", mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def prepared(self, texts: list[str | None]) -> list[str | None]:
        """Each text as chunks with one blank between; None where it is empty or must be encoded whole.

        Byte vocabulary: a chunk stands for itself behind one blank, unless it begins with "\\n"."""
        if self.word_ends:
            return [t.lower().replace("\n", " ") if t and (t.isascii() or not ("Σ" in t or "İ" in t) and unicodedata.is_normalized("NFC", t)) else None
                    for t in texts]
        two = pc.match_substring_regex(pa.array(texts, pa.large_string()), _TWO_BLANKS).to_pylist()
        return [None if not t or b or t[0] == " " or "\0" in t else ("\0" + t).replace("\n", " \n") for t, b in zip(texts, two)]

    def _source(self, chunk: str) -> str:
        """The text that a chunk of the byte vocabulary stands for."""
        return chunk[1:] if chunk[0] == "\0" else chunk if chunk[0] == "\n" else " " + chunk

    def _merged(self, letters: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs of letters, one after the other, and their bounds."""
        joined = "\n".join(letters) + "\n" if self.word_ends else " " + " ".join(letters)
        ids = np.asarray(self.merge.encode_ordinary(joined), "<u4")
        at = np.flatnonzero(self.mark[ids])
        if len(at) != len(letters):
            raise ValueError("the vocabulary has no mark for word bounds")
        return ids, np.concatenate([[0], at + 1]) if self.word_ends else np.concatenate([at, [len(ids)]])

    def learn(self, missing: set[str]) -> None:
        new, old = self.new, self.old
        letters, tails, odd = [], [], []
        for c in missing:
            if (v := old.get(c)) is not None:
                new[c] = v
            elif c.isalpha():
                letters.append(c)
            elif not c:
                new[c] = b"" if self.word_ends else self.whole([" "])[0]
            else:
                head = c.rstrip(_TAIL)
                if head.isalpha():
                    tails.append((c, head, c[len(head):]))
                else:
                    odd.append(c)
        if tails:                                    # letters and closing marks are separate pieces
            have = set(letters)
            for _, head, tail in tails:
                if head not in new and head not in have:
                    if head in old:
                        new[head] = old[head]
                    else:
                        have.add(head)
                        letters.append(head)
                if "\0tail" + tail not in new:
                    new["\0tail" + tail] = self.whole([tail])[0]
        if letters:
            ids, cut = self._merged(letters)
            data, cut = ids.tobytes(), (cut * 4).tolist()
            for c, a, b in zip(letters, cut, cut[1:]):
                new[c] = data[a:b]
        if odd:
            new.update(zip(odd, self.whole(odd if self.word_ends else [self._source(c) for c in odd])))
        for c, head, tail in tails:
            new[c] = new[head] + new["\0tail" + tail]

    def _plain(self, words: pa.Array):
        """Of words that are a run of ASCII letters with closing marks (a mask): the ids of the distinct runs and marks, one after
        the other, and each such word's two ranges in them, (start, size) of the run and of its marks."""
        heads = pc.utf8_rtrim(words, _TAIL)
        plain = pc.ascii_is_alpha(heads)
        heads = heads.filter(plain).dictionary_encode()
        tails = pc.utf8_ltrim(words.filter(plain), _LETTERS).dictionary_encode()
        runs, marks = heads.dictionary.to_pylist(), tails.dictionary.to_pylist()
        ids, sizes = np.empty(0, "<u4"), np.empty(0, np.int64)
        if runs:
            ids, cut = self._merged(runs)
            sizes = np.diff(cut)
        if len(self.marks) > self.keep:
            self.marks = {}
        missing = [m for m in marks if m not in self.marks]
        self.marks |= zip(missing, self.whole(missing))
        closing = [self.marks[m] for m in marks]
        pool = np.concatenate([ids, np.frombuffer(b"".join(closing), "<u4")])
        sizes = np.r_[sizes, np.array([len(c) // 4 for c in closing], np.int64)].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        at = np.stack([heads.indices.to_numpy(), tails.indices.to_numpy().astype(np.int64) + len(runs)], 1)
        return plain.to_numpy(zero_copy_only=False), pool, starts[at], sizes[at]

    def ids(self, texts: list[str | None], group: int = 4000, chars: int = 2 << 20) -> list[bytes]:
        out: list[bytes] = []
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t or "")
            if len(part) == group or size >= chars:
                out += self._ids(part)
                part, size = [], 0
        return out + self._ids(part) if part else out

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each distinct chunk of the texts are made once, and copied to its occurrences in arrays."""
        if len(self.new) > self.keep:
            self.old, self.new = self.new, _Cache()
        ready, new = self.prepared(texts), self.new
        whole = iter(self.whole([t for t, r in zip(texts, ready) if t and r is None]))
        split = pc.split_pattern(pa.array([r for r in ready if r is not None], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        plain, pool, starts, sizes = self._plain(coded.dictionary)
        odd = coded.dictionary.filter(pa.array(~plain)).to_pylist()
        found = list(map(new.__getitem__, odd))
        if new.missing:
            missing, new.missing = new.missing, set()
            self.learn(missing)
            found = list(map(new.__getitem__, odd))
        # two ranges of the pool for each distinct chunk, the second empty but for closing marks
        start, size = np.zeros((len(plain), 2), np.int64), np.zeros((len(plain), 2), np.int64)
        start[plain], size[plain] = starts, sizes
        own = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start[~plain, 0], size[~plain, 0] = len(pool) + np.cumsum(own) - own, own
        pool = np.concatenate([pool, np.frombuffer(b"".join(found), "<u4")])
        pool, size = pool[_ranges(start.ravel(), size.ravel())], size.sum(1)
        code = coded.indices.to_numpy()
        ends = np.r_[0, np.cumsum(size[code])]
        data = pool[_ranges((np.cumsum(size) - size)[code], size[code])].tobytes()
        bound = (ends[split.offsets.to_numpy()] * 4).tolist()
        cut = iter([data[x:y] for x, y in zip(bound, bound[1:])])
        return [b"" if not t else next(whole) if r is None else next(cut) for t, r in zip(texts, ready)]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    out = np.repeat(start - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    key = (os.getpid(), path)
    if key not in _SHARED:
        _SHARED[key] = Encoder(path)
    return _SHARED[key]


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
