"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
# a word of Latin letters, maybe behind a line feed, and marks behind it; an apostrophe may begin another part of the pattern
_WORD = re.compile(r"\n?([A-Za-zÀ-ÖØ-öø-ɏ]+)[!-&(-/:-@[-`{-~]*")
# all bytes but those that white space other than space and line feed is made of or begins with
_USUAL = bytes(set(range(256)) - set(b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3"))
_MARKS = 10_000  # remembered runs of marks


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)


def _byte_characters() -> str:
    """The character that stands for each byte in byte-level tokens; the line feed stays, as a separator of words."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    characters = [chr(b if b in shown else next(hidden)) for b in range(256)]
    characters[ord("\n")] = "\n"
    return "".join(characters)


_CHARACTERS = _byte_characters()


def _spaced_singly(text: str) -> bool:
    """Not empty, no two white space characters in a row, and none at an end."""
    if text.encode().translate(None, _USUAL):  # maybe other white space than space and line feed
        return not (_SPACES.search(text) or text[:1].isspace() or text[-1:].isspace())
    if text[:1] in " \n" or text[-1:] in " \n":
        return False
    return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes.

    A byte-level BPE splits a text by a fixed pattern and merges within the parts only. The pattern always cuts
    before a single space between two characters that are no space, and around a single line feed between such
    characters. So the parts between those places can be encoded once each and remembered: the result is that of
    the whole text. A part is remembered when it is met a second time (or another one that falls on the same place of
    a table of bytes), so that parts that do not come again take no room. The pattern need not be run over words of
    Latin letters, and marks behind them are a part of the pattern of their own.
    Other kinds of tokenizers get the whole text. Special tokens' strings are ordinary text.
    """

    def __init__(self, path: str, max_remembered: int = 349_000, met_places: int = 1 << 22):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        spec = json.loads(self.tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        self.by_parts = (
            spec["model"]["type"] == "BPE"
            and spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and all(x["special"] for x in spec.get("added_tokens") or ())
        )
        self.max_remembered = max_remembered
        # every character of a byte-level token stands for one byte
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.met = bytearray(met_places)
        self.n_met = 0
        # the same model for words that are cut already, in the characters of its tokens
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.marks: dict[str, bytes] = {}
        self.line_feed = self._encode(["\n"])[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _cut(self, ids: list[int], sizes: list[int]) -> list[bytes]:
        """Ids of parts of the given numbers of bytes: the lengths of the tokens tell where a part ends."""
        found = np.array(ids, dtype="<u4")
        cuts = np.searchsorted(np.cumsum(self.token_bytes[found]), np.cumsum(sizes), side="left") + 1
        raw = found.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, from one text made of all of them."""
        if not parts:
            return []
        joined = "".join([x if x[0] == "\n" else " " + x for x in parts])
        ids = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        return self._cut(ids, [len(x.encode()) + (x[0] != "\n") for x in parts])

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word of letters only (behind a space, or without its line feed)."""
        if not words:
            return []
        joined = "\n".join([x[1:] if x[0] == "\n" else " " + x for x in words]).encode()
        joined = joined.decode("latin-1").translate(_CHARACTERS)
        ids = self.words.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        found = self._cut(ids, [len(x.encode()) + (1 if x[0] != "\n" else -1) for x in words])
        return [self.line_feed + ids if x[0] == "\n" else ids for x, ids in zip(words, found)]

    def _encode_marks(self, runs: set[str]) -> dict[str, bytes]:
        new = [x for x in runs if x not in self.marks]
        if new:
            found = dict(zip(new, self._encode(new)))
            if len(self.marks) + len(new) > _MARKS:
                return {x: found.get(x) or self.marks[x] for x in runs}
            self.marks.update(found)
        return self.marks

    def _learn(self, wanted: list[str]) -> dict[str, bytes]:
        """Ids of parts that are not known; those met before are remembered while there is room."""
        known, word = self.known.get, _WORD.fullmatch
        new: dict[str, bytes] = {}
        marked: list[tuple[str, str, str]] = []
        words: dict[str, None] = {}
        others: list[str] = []
        for x in wanted:
            found = word(x)
            if not found:
                others.append(x)
                continue
            end = found.end(1)
            if end < len(x):
                stem = x[:end]
                marked.append((x, stem, x[end:]))
                if known(stem) is None:
                    words[stem] = None
            else:
                words[x] = None
        new.update(zip(words, self._encode_words(list(words))))
        if marked:
            marks = self._encode_marks({run for _, _, run in marked})
            for x, stem, run in marked:
                new[x] = (new.get(stem) or self.known[stem]) + marks[run]
        odd = [x for x in others if x[-1].isspace()]
        plain = [x for x in others if not x[-1].isspace()]
        new.update(zip(plain, self._encode_parts(plain)))
        new.update(zip(odd, self._encode([" " + x for x in odd])))
        self._remember(new)
        return new

    def _remember(self, new: dict[str, bytes]) -> None:
        room, met, n = self.max_remembered - len(self.known), self.met, len(self.met)
        if room <= 0:
            return
        for x, ids in new.items():
            place = hash(x) % n
            if met[place]:
                self.known[x] = ids
                room -= 1
                if not room:
                    self.met = bytearray(1)  # not needed any more
                    return
            else:
                met[place] = 1
                self.n_met += 1
        if 2 * self.n_met > n:
            self.met, self.n_met = bytearray(n), 0

    def _ids_of(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in a row, and the number of ids of each part. Equal parts are looked up once."""
        coded = parts.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, different))
        gaps = [k for k, ids in enumerate(found) if ids is None]
        new = self._learn([different[k] for k in gaps])
        for k in gaps:
            found[k] = new[different[k]]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        start = np.cumsum(size) - size
        at = coded.indices.to_numpy()
        sizes = size[at]
        places = np.repeat(start[at] - (np.cumsum(sizes) - sizes), sizes)
        places += np.arange(len(places))
        return np.frombuffer(b"".join(found), dtype="<u4")[places], sizes

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; null is the empty text."""
        texts = [t or "" for t in texts]
        if not self.by_parts:
            return self._encode(texts)
        # A part is known by its own text, which stands for the part with a space before it, or by a line feed and its text.
        # A text is read like a line, without the first id, that of the line feed (four bytes).
        single = [_spaced_singly(text) for text in texts]
        lines = ["\n" + text.replace("\n", " \n") for text, plain in zip(texts, single) if plain]
        split = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        heads: list[str] = []
        rests: list[str] = []
        counts = split.value_lengths().to_pylist()
        for text, plain in zip(texts, single):
            if not plain:
                head, *rest = _CUT.split(text)
                heads.append(head)
                rests += rest
                counts.append(len(rest))
        ids, sizes = self._ids_of(pa.concat_arrays([split.flatten(), pa.array(rests, pa.large_string())]))
        raw = memoryview(ids.tobytes())
        bounds = 4 * np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        out = [bytes(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        lined = iter([ids[4:] for ids in out[: len(lines)]])
        begun = iter([head + ids for head, ids in zip(self._encode(heads), out[len(lines) :])])
        return [next(lined if plain else begun) for plain in single]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process; what it remembers serves later tasks too."""
    return Encoder(path)
