"""Token ids by a public tokenizer file, with a bounded cache of word ids.

The byte-level vocabulary splits a text before merging, and never merges
across a split; so a text's ids are those of its pieces one after another.
Texts of Latin letters are split as the vocabulary's own pattern does;
other texts only at white space, where that pattern always splits. Pieces
seen before come from a dictionary of at most ``CACHE`` entries; the
tokenizer itself encodes the rest. The result equals encoding the whole
text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Pieces remembered per Python worker (about 200 bytes each); what comes later is encoded each time.
CACHE = 600_000

# Character classes as the vocabulary's splitter knows them. Letters and numbers are
# complete up to U+024F; the punctuation from U+2010 on is neither.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_OTHER_SCRIPT = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e]")
_SPACES = f"[{_WS}]+(?![^{_WS}])|[{_WS}]+"
_LATIN = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_WS}{_L}{_N}]+|{_SPACES}")
_COARSE = re.compile(f" ?[^{_WS}]+|{_SPACES}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """Little-endian unsigned 32-bit ids of whole texts.

    Strings of special tokens in a text are ordinary text, or with
    ``specials`` the tokens themselves, as the file's tokenizer has them.
    """

    def __init__(self, path: str, specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.reader = Tokenizer.from_file(path) if specials else None
        self.special = [t.content for t in self.reader.get_added_tokens_decoder().values()] if specials else []

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Words go as the lines of one text: a line feed is a piece of its own there."""
        words = [p for p in pieces if not p.isspace()]
        found = {p: self._ids(p) for p in pieces if p.isspace()}
        if words:
            ids = np.frombuffer(self._ids("\n".join(words)), "<u4")
            ends = np.append(np.flatnonzero(ids == self.line_feed), len(ids))
            starts = np.append(0, ends[:-1] + 1)
            data = ids.tobytes()
            found.update((w, data[4 * i : 4 * j]) for w, i, j in zip(words, starts.tolist(), ends.tolist()))
        return [found[p] for p in pieces]

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.reader.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = (_COARSE if _OTHER_SCRIPT.search(text) else _LATIN).findall(text)
        ids = list(map(self.known.get, pieces))
        if None in ids:
            new = list({p for p, i in zip(pieces, ids) if i is None})
            fresh = dict(zip(new, self._encode(new)))
            room = CACHE - len(self.known)
            if room >= len(fresh):
                self.known.update(fresh)
            elif room > 0:
                self.known.update(list(fresh.items())[:room])
            ids = [fresh[p] if i is None else i for p, i in zip(pieces, ids)]
        return b"".join(ids)

    def decode_all(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


@lru_cache(maxsize=4)
def encoder(path: str, specials: bool = False) -> PieceEncoder:
    """One encoder per file, reading of special strings and Python worker."""
    return PieceEncoder(path, specials)
