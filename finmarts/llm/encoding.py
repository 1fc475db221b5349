"""Token ids of whole texts with the tokenizers library, each distinct word encoded once per worker.

Both supported tokenizers cut a text into pieces before they look at merges,
and no piece crosses the places where this module cuts, so the ids of a text
are the ids of its parts in order:

* ``spaced`` (byte-level, no normaliser, no added prefix space): a single space
  between two other characters always begins a new piece, and a single line
  feed between two others is a piece of its own. Texts with any other white
  space, or with white space at an end, are encoded whole.
* ``words`` (white space dropped): any white space parts pieces. Texts with the
  separators U+001C to U+001F, which Python counts as white space and the
  tokenizer does not, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

SEPARATORS = re.compile("[\x1c-\x1f]")
#: White space beside white space; other white space than space and line feed isn't printable.
DOUBLE = ("  ", " \n", "\n ", "\n\n")
#: Distinct words in one of the two memories of a worker: when the newer is full, it takes the place of the older, so
#: that words which come again stay known. Results do not depend on it.
REMEMBERED = 1 << 19
#: Parts encoded in one call.
RUN = 200


def cut_rule(description: dict) -> str:
    """Which of the module's cuts is safe for a tokenizer, from its JSON: spaced, words or whole."""
    normal, before = description.get("normalizer"), description.get("pre_tokenizer") or {}
    if before.get("type") == "ByteLevel" and normal is None and not before.get("add_prefix_space"):
        return "spaced" if before.get("use_regex", True) else "whole"
    steps = [p.get("type") for p in before.get("pretokenizers", [])]
    if steps == ["Split", "ByteLevel"] and before["pretokenizers"][0].get("behavior") == "Removed":
        return "words"
    return "whole"


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens of its own."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.rule = cut_rule(json.load(f))
        self.size = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _parts(self, text: str) -> list[str] | None:
        """The text in parts that are encoded alike wherever they stand; None: encode it whole."""
        if self.rule == "words":
            return None if SEPARATORS.search(text) or "\x00" in text else text.split()
        if self.rule == "spaced" and text and "\x00" not in text and text[0] not in " \n" and text[-1] not in " \n":
            if not any(pair in text for pair in DOUBLE):
                return ("\x00" + text).replace("\n", " \n").split(" ")
        return None

    def _unsafe(self, new: set[str]) -> set[str]:
        """Parts met for the first time that hold white space, or what may count as such."""
        return {p for p in new if not p.lstrip("\x00\n").isprintable()} if self.rule == "spaced" else set()

    def _runs(self, parts: list[str]) -> list[bytes]:
        """The ids of each part. Parts are encoded in runs, which is much cheaper than one by one, and cut by offsets."""
        gap = " " if self.rule == "words" else ""
        runs = [parts[i : i + RUN] for i in range(0, len(parts), RUN)]
        sources = [[self._source(p) + gap for p in run] for run in runs]
        out: list[bytes] = []
        for source, found in zip(sources, self.tokenizer.encode_batch(["".join(s) for s in sources], add_special_tokens=False)):
            ends = np.cumsum([len(s) for s in source])
            starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found))
            cuts = np.searchsorted(starts, ends, "left")
            ids = np.array(found.ids, dtype="<u4")
            out += [ids[a:b].tobytes() for a, b in zip([0, *cuts[:-1]], cuts)]
        return out

    def _source(self, part: str) -> str:
        """What to encode for a part: one inside a spaced text carries the space before it."""
        return part if self.rule == "words" or part[0] == "\n" else " " + part

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self._parts(t) for t in texts]
        new = set().union(*(ps for ps in parts if ps))
        new -= self.known.keys()
        if unsafe := self._unsafe(new):
            parts = [None if ps and not unsafe.isdisjoint(ps) else ps for ps in parts]
            new = set().union(*(ps for ps in parts if ps)) - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known = self.known, {}
            new = set().union(*(ps for ps in parts if ps))
        again = new & self.older.keys()
        self.known.update((p, self.older[p]) for p in again)
        new -= again
        if new:
            order = list(new)
            firsts = [p for p in order if p[0] == "\x00"]
            inner = [p for p in order if p[0] != "\x00"]
            self.known.update(zip(firsts, self._whole([p[1:] for p in firsts])))
            self.known.update(zip(inner, self._runs(inner)))
        whole = [i for i, ps in enumerate(parts) if ps is None]
        out = [b"".join(map(self.known.__getitem__, ps)) if ps else b"" for ps in parts]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
