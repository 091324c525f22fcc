"""Byte-level BPE over whole texts with a bounded memory of encoded words.

The vocabularies' splitting rule never lets a token reach from a visible character over to white
space, so a text may be cut before any white space that follows a visible character. Words repeat
far more often than texts: each is encoded once per worker and looked up afterwards.
"""

from __future__ import annotations

import os
import re

import numpy as np

from marquee.llm.common import hold

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A worker keeps between one and two times this many characters of words.
HELD_CHARS = 4_000_000
JOINED = 200

_TWO_WHITE = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=\s)")
_WHITE = re.compile(r"\s")
#: So many characters are looked up at once.
GROUP_CHARS = 1_000_000
_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, escape_special: bool = False) -> WordEncoder:
    """The encoder of this worker process for a vocabulary file."""
    hold("tokens", _ENCODERS.clear)
    if (path, escape_special) not in _ENCODERS:
        _ENCODERS[path, escape_special] = WordEncoder(path, escape_special)
    return _ENCODERS[path, escape_special]


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, equal to the library's for the whole text.

    ``words`` has the ids of words by a key: ``w`` for a word after a space, ``"\\n" + w`` for one after a line
    end. Both include what stands before the word. A key that starts with a space stands for what follows it. ``old`` has those of the time before the last clearing.
    ``escape_special`` encodes the strings of special tokens as ordinary text.
    """

    def __init__(self, path: str, escape_special: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # By default the string of a special token in a text is that token, as the library has it. Such strings
        # hold no white space, so no cut goes through one.
        self.library.encode_special_tokens = escape_special
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.chars = 0
        self.line_end = self._plain(["\n"])[0]
        self.mark = int.from_bytes(self.line_end, "little") if len(self.line_end) == 4 else -1

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, keys: set[str]) -> dict[str, bytes]:
        """The ids of all keys, remembered from now on."""
        new = {key: self.old[key] for key in keys if key in self.old}
        missing = [key for key in keys if key not in new]
        self.chars += sum(map(len, missing))
        odd = {key for key in missing if not key or key == "\n" or _WHITE.search(key.removeprefix("\n"))}
        first = [key for key in missing if key[:1] == "\n" and key not in odd]
        spaced = [key for key in missing if key[:1] != "\n" and key not in odd]
        new |= self._joined(first, [key[1:] for key in first], self.line_end)
        new |= self._joined(spaced, [" " + key for key in spaced], b"")
        rest = [key for key in missing if key not in new]
        whole = [key if key[:1] == "\n" else key[1:] if key[:1] == " " else " " + key for key in rest]
        new.update(zip(rest, self._plain(whole)))
        self.words |= new
        return new

    def _joined(self, keys: list[str], texts: list[str], before: bytes) -> dict[str, bytes]:
        """Many short words in one call, with line ends between them, which are tokens of their own."""
        found: dict[str, bytes] = {}
        joined = ["\n".join(texts[i : i + JOINED]) for i in range(0, len(texts), JOINED)]
        for i, encoding in enumerate(self.library.encode_batch_fast(joined, add_special_tokens=False)):
            group = keys[i * JOINED : (i + 1) * JOINED]
            ids = np.array(encoding.ids, "<u4")
            data, ends = ids.tobytes(), (np.flatnonzero(ids == self.mark) * 4).tolist()
            if len(ends) == len(group) - 1:
                starts = [0, *[end + 4 for end in ends]]
                ends.append(len(data))
                found.update(zip(group, [before + data[a:b] for a, b in zip(starts, ends)]))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        group: list[str] = []
        chars = 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars > GROUP_CHARS:
                out += self._group(group)
                group, chars = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        if self.chars > HELD_CHARS:
            self.old, self.words, self.chars = self.words, {}, 0
        keys = [_keys(text) for text in texts]
        get = self.words.get
        found = [list(map(get, of_text)) for of_text in keys]
        lacking = [i for i, ids in enumerate(found) if None in ids]
        if lacking:
            new = self._learn({key for i in lacking for key, ids in zip(keys[i], found[i]) if ids is None})
            for i in lacking:
                found[i] = [new[key] if ids is None else ids for key, ids in zip(keys[i], found[i])]
        # The line end before the first word is not in the text.
        skip = len(self.line_end)
        return [b"".join(ids)[skip:] for ids in found]


def _keys(text: str) -> list[str]:
    """Keys of the words of a text; joined, they spell a line end and the text."""
    if not _TWO_WHITE.search(text) and not text[:1].isspace():
        return ("\n" + text.replace("\n", " \n")).split(" ")
    if text[:1].isspace():
        return ["\n", *map(_key, _CUT.split(text))]
    return list(map(_key, _CUT.split("\n" + text)))


def _key(piece: str) -> str:
    """A piece with other white space than one space or line end in front gets a key that starts with a space."""
    if piece[:1] in (" ", "\n") and not piece[1:2].isspace():
        return piece[1:] if piece[0] == " " else piece
    return " " + piece
