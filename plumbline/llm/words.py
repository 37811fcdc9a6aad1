"""Words of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# The hashes that stand for a text's begin and end, which are no words.
BEGIN, END = np.uint64(1), np.uint64(2)

# Bytes of a text to its words of digits, letters and characters beyond ASCII: A-Z in lower case, other ASCII blank.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_slices(text: str | None, size: int = 4 << 20):
    """The words of a text, as lists of bytes from slices of about `size` bytes, cut between words."""
    low, start = (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS), 0
    while start < len(low):
        cut = low.find(b" ", start + size)
        end = len(low) if cut < 0 else cut
        yield low[start:end].split()
        start = end


class Words:
    """The words of a column of texts with A-Z in lower case: `known`, the hashes of the distinct ones,
    `code`, which of them stands where, all texts after another, and `count`, how many each text has."""

    def __init__(self, texts: pa.Array):
        low = pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))
        words = pc.ascii_split_whitespace(low)
        tokens, parent = words.flatten(), pc.list_parent_indices(words).to_numpy()
        real = pc.not_equal(tokens, "")
        self.count = np.bincount(parent[real.to_numpy(zero_copy_only=False)], minlength=len(texts)).astype(np.int64)
        coded = tokens.filter(real).dictionary_encode()
        digest = xxhash.xxh3_64_intdigest
        self.known = np.array([max(3, digest(w)) for w in coded.dictionary.to_pylist()], np.uint64)
        self.code = coded.indices.to_numpy().astype(np.int64)

    def framed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, code, begin) with each text's words between a BEGIN and an END; `begin` is where each
        text's BEGIN stands. The last two entries of `known` are these marks."""
        known = np.append(self.known, [BEGIN, END])
        n = len(self.count)
        sizes = self.count + 2
        begin = np.cumsum(sizes) - sizes
        code = np.empty(int(sizes.sum()), np.int64)
        inner = np.ones(len(code), bool)
        inner[begin] = inner[begin + sizes - 1] = False
        code[inner] = self.code
        code[begin], code[begin + sizes - 1] = len(known) - 2, len(known) - 1
        assert len(begin) == n
        return known, code, begin
