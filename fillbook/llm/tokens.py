"""Token ids of whole texts, with the ids of frequent pieces remembered.

The byte-level BPE never merges across the start of a blank-led word: where
every white space of a text is a single blank or line feed between two other
characters, the text is the concatenation of its pieces `` word`` and
``\\nword``, and so are its ids. Arrow cuts a batch of texts into pieces and
numbers the distinct ones; a task keeps the ids of those seen lately (two
generations of ``GENERATION``) and encodes only the others: pieces of letters go straight to the vocabulary's BPE
model, as they are one unit to its pre-tokenizer anyway; other pieces, and
texts with any other white space, take the whole tokenizer.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
GENERATION = 350_000
#: Pieces longer than this are not kept.
LONGEST = 64
#: Bytes of text that are cut and numbered at once.
SLICE = 5 << 20
#: Texts that cannot be cut at single blanks and line feeds: other white space
#: (by any of the libraries' reading), white space side by side or at an end;
#: also NUL, which marks the first piece of a text.
_ODD = (r"[\x00\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        r"|[ \n][ \n]|\A[ \n]|[ \n]\z")
_FIRST = "\x00"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 stands for itself, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_LETTERS = _byte_letters()


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a vocabulary file lies; an absolute path is taken as it is."""
    if name.startswith("/"):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts with a vocabulary file of the tokenizers library."""

    def __init__(self, name: str = TOKENIZER):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        #: Ids of tokens that end a sentence.
        self.ends = np.zeros(self.size, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token[-1] in ".!?Ċ"
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.feed = self._raw(["\n"])[0]
        self.marks = {c: self._raw([c])[0] for c in ".,"}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in done]

    def _letters(self, word: str) -> bytes:
        """Ids of a word of letters, led by a blank or by a line feed."""
        lead, word = ("", word[1:]) if word[0] == "\n" else ("Ġ", word)
        written = lead + (word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS))
        ids = array(self.code, [t.id for t in self.model.tokenize(written)]).tobytes()
        return ids if lead else self.feed + ids

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of pieces that the young generation lacks. A mark after a letter
        is a token of its own, so ``word.`` is ``word`` and the mark."""
        pieces, older, marks, letters, whole = self.pieces, self.older, self.marks, self._letters, []
        kept = list(map(older.get, missing))
        found = {w: x for w, x in zip(missing, kept, strict=True) if x is not None}
        for w in [w for w, x in zip(missing, kept, strict=True) if x is None]:
            stem = w[:-1] if w[-1] in marks and len(w) > 1 and w[-2].isalpha() else w
            if not (stem.isalpha() or stem[0] == "\n" and stem[1:].isalpha()):
                whole.append(w)
            elif stem is w:
                found[w] = letters(w)
            else:
                pieces[stem] = ids = pieces.get(stem) or older.get(stem) or found.get(stem) or letters(stem)
                found[w] = ids + marks[w[-1]]
        written = [w[1:] if w[0] == _FIRST else w if w[0] == "\n" else " " + w for w in whole]
        found.update(zip(whole, self._raw(written), strict=True))
        pieces.update(found)
        for w in missing:
            if len(w) > LONGEST:
                pieces.pop(w, None)
                pieces.pop(w[:-1], None)
        return found

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        marked = pc.binary_join_element_wise(_FIRST, pc.if_else(odd, "", texts), "")
        lists = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        numbered = lists.values.dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.pieces) > GENERATION:
            self.pieces, self.older = {}, self.pieces
        ids = list(map(self.pieces.get, words))
        missing = [w for w, x in zip(words, ids, strict=True) if x is None]
        if missing:
            found = self._learn(missing)
            ids = [found[w] if x is None else x for w, x in zip(words, ids, strict=True)]
        pool = np.frombuffer(b"".join(ids), self.dtype)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        begin = np.cumsum(size) - size
        at = numbered.indices.to_numpy()
        n = size[at]
        upto = np.append(0, np.cumsum(n))
        flat = pool[np.repeat(begin[at] - upto[:-1], n) + np.arange(upto[-1])]
        ends = upto[lists.offsets.to_numpy()]
        out = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = np.frombuffer(self._raw([texts[i].as_py()])[0], self.dtype)
        return out

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        out, at = [], 0
        while at < len(texts):  # slices of about SLICE bytes, one text at least
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right")))
            out += self._slice(texts.slice(at, end - at))
            at = end
        return out


@lru_cache(maxsize=1)
def encoder(name: str = TOKENIZER) -> Encoder:
    """The task process's encoder, kept from batch to batch."""
    return Encoder(name)
