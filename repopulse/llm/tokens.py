"""Token ids of whole texts, with every piece between white space encoded once.

Ids are little-endian unsigned numbers of 16 bits, or of 32 for large vocabularies.
"""

from __future__ import annotations

import re
import sys

import numpy as np

#: Pieces whose ids a worker remembers before it starts anew.
REMEMBERED = 1_000_000
#: Words that are encoded together.
TOGETHER = 200
#: Marks at the end of a piece, after an ASCII or Latin-1 letter or a digit: always a
#: pre-token of their own, and so as good as a piece.
_MARKS = re.compile(
    rb"[!-&(-/:-@\[-`{-~](?:(?<=[A-Za-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))"
    rb"[!-&(-/:-@\[-`{-~]*(?![^ \n])"
)


#: Runs of ASCII and other Latin letters, up to U+024F.
_LATIN = re.compile(
    rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+"
)


class Encoder:
    """Ids of texts as octets.

    For vocabularies whose pre-tokens are runs of letters, single digits, and runs
    of other characters but white space, so that the ids of a text are those of its
    pieces in order; and which ignore case, if `lower`. Strings of special tokens
    inside a text get the ids of these, as the tokenizer's default has it: texts are
    split at them first.
    """

    def __init__(self, path: str, lower: bool) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lower = lower
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content.encode(): i for i, t in added.items() if t.special}
        self.specials = re.compile(b"(%s)" % b"|".join(map(re.escape, self.special))) if self.special else None
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.kind = id_kind(self.tokenizer)
        self.last = suffix and np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _each(self, pieces: list[bytes]) -> None:
        texts = [p.decode() for p in pieces]
        for piece, found in zip(pieces, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.known[piece] = np.array(found.ids, self.kind).tobytes()

    def _line(self, words: list[bytes]) -> None:
        """Ids of words that are one pre-token each, encoded as one text.

        Tokens that end a word tell where each word's ids end.
        """
        text = b" ".join(words).decode()
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, self.kind)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._each(words)
        data, bounds = ids.tobytes(), [0, *(ids.itemsize * ends).tolist()]
        self.known.update((w, data[a:b]) for w, a, b in zip(words, bounds, bounds[1:]))

    def learn(self, pieces: set[bytes]) -> None:
        """Makes the ids of the pieces known."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(pieces)
        words, others = [], []
        for p in new:
            plain = self.last is not None and (p.isalpha() or _LATIN.fullmatch(p))
            (words if plain else others).append(p)
        for i in range(0, len(words), TOGETHER):
            self._line(words[i : i + TOGETHER])
        for i in range(0, len(others), TOGETHER):
            self._each(others[i : i + TOGETHER])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        raw = [(t or "").encode() for t in texts]
        if self.specials and any(b"<|" in r and self.specials.search(r) for r in raw):
            return [self._with_specials(r) for r in raw]
        return self._plain(raw)

    def _plain(self, raw: list[bytes]) -> list[bytes]:
        raw = [_MARKS.sub(rb" \g<0>", r) for r in raw]
        split = [(r.lower() if self.lower else r).split() for r in raw]
        self.learn(set().union(*split))
        of = self.known.__getitem__
        return [b"".join(map(of, pieces)) for pieces in split]

    def _with_specials(self, text: bytes) -> bytes:
        """Ids of a text, whose parts between special tokens are texts of their own."""
        parts = self.specials.split(text)
        plain = self._plain(parts[::2])
        ids = [np.array([self.special[x]], self.kind).tobytes() for x in parts[1::2]]
        return b"".join(x for pair in zip(plain, [*ids, b""]) for x in pair)


def id_kind(tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def worker_encoder(path: str, lower: bool) -> Encoder:
    """The encoder of this Python worker, which outlives its tasks.

    It hangs on `sys`, as the modules of functions that are sent to workers do not
    outlive a task.
    """
    held = vars(sys).setdefault("_repopulse_encoders", {})
    if (path, lower) not in held:
        held[path, lower] = Encoder(path, lower)
    return held[path, lower]
