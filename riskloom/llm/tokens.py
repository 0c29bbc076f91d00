"""Token ids by the tokenizers library, whole texts, with a word cache.

A tokenizer that cuts at white space before its merges gives a word the same ids in any
text, so each distinct word is encoded once as long as a worker's cache holds it. That holds for two kinds of file,
told by their settings: byte-level with its own pattern (a space belongs to the word after
it), and letters, digits and marks by pattern with white space dropped. Any other kind, and
any text with unusual white space, is encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARKS = ".,!?;:%$#&*|()[]{}\"-_=+/\\@^~`<>"  # no letters, digits, white space or apostrophes
#: The pattern of the tokenizer kind whose white space is dropped.
DROPPING = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: What keeps a text from being encoded word by word: white space at an end, two in a row, or
#: any other than a space or newline (as ``str.split`` sees it).
UNUSUAL = (
    r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
CACHE_WORDS = 800_000  # about 60 bytes each


class Cut(NamedTuple):
    array: pa.Array  # the words of all texts
    first: np.ndarray  # the first word of each text, and the number of words


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.kind = _kind(said)
        self.special = [t["content"] for t in said["added_tokens"]]
        self.keys, self.ids = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())  # the cache
        self.used = np.zeros(0, dtype=bool)  # which of it was met again since

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        texts = [t or "" for t in texts]
        alone = self._by_words(texts)
        words = self._cut([t.encode() if w else b"" for t, w in zip(texts, alone)])
        coded = words.array.dictionary_encode()
        found = self._ids(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(found.buffers()[1], dtype=np.int64, count=len(found) + 1) >> 2
        out = np.frombuffer(found.buffers()[2] or b"", dtype="<u4", count=int(ends[-1]))
        total = ends[words.first]
        counts = np.diff(total)
        if alone.all():
            return out, counts
        pieces = np.split(out, total[1:-1])
        whole = np.flatnonzero(~alone)
        for i, e in zip(whole, self.whole.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
            pieces[i] = np.asarray(e.ids, dtype="<u4")
            counts[i] = len(pieces[i])
        return np.concatenate(pieces), counts

    def _by_words(self, texts: list[str]) -> np.ndarray:
        """Whether the words of each text can be encoded each by itself."""
        if self.kind == "leading":
            return ~np.asarray(pc.match_substring_regex(pa.array(texts, pa.large_string()), UNUSUAL), dtype=bool)
        return np.full(len(texts), self.kind == "dropping")

    def _cut(self, texts: list[bytes]) -> Cut:
        """Every text cut before each space and newline, which stay with the word after them."""
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([0, *map(len, texts)])
        mark = np.zeros(len(raw) + 1, dtype=bool)
        mark[:-1] = (raw == 32) | (raw == 10)
        mark[ends] = True
        offsets = np.flatnonzero(mark).astype(np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        return Cut(array, np.searchsorted(offsets, ends))

    def _ids(self, words: pa.Array) -> pa.Array:
        """The ids of each word, as bytes.

        A run of letters before marks is a part by itself, and so are the marks; any other word
        is one part.
        """
        text = words.cast(pa.large_string())
        body = pc.utf8_ltrim(text, " \n")
        core = pc.utf8_rtrim(body, MARKS)
        split = pc.utf8_is_alpha(core)
        for s in self.special:
            split = pc.and_not(split, pc.match_substring(text, s))
        split = np.asarray(split)
        core, body = core.cast(pa.large_binary()), body.cast(pa.large_binary())
        ends = np.asarray(pc.binary_length(core))
        marked = np.flatnonzero(split & (np.asarray(pc.binary_length(body)) > ends))
        tails = pa.array([b[n:] for b, n in zip(body.take(pa.array(marked)).to_pylist(), ends[marked].tolist())], pa.large_binary()).dictionary_encode()
        if self.kind == "dropping":  # nor does the case of plain letters count
            head = pc.if_else(pc.string_is_ascii(core.cast(pa.large_string())), pc.ascii_lower(core.cast(pa.large_string())), core.cast(pa.large_string())).cast(pa.large_binary())
        else:
            lead = pc.if_else(pc.greater(pc.binary_length(words), pc.binary_length(body)), pc.binary_slice(words, 0, 1), pa.scalar(b"", pa.large_binary()))
            head = pc.binary_join_element_wise(lead, core, pa.scalar(b"", pa.large_binary()))
        heads = head.filter(pa.array(split)).dictionary_encode()
        odd = words.filter(pa.array(~split))
        none = pa.array([b""], pa.large_binary())
        parts = pa.concat_arrays([none, heads.dictionary, tails.dictionary, odd])
        first, second = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        first[split] = 1 + np.asarray(heads.indices)
        second[marked] = 1 + len(heads.dictionary) + np.asarray(tails.indices)
        first[~split] = 1 + len(heads.dictionary) + len(tails.dictionary) + np.arange(len(odd))
        known = self._known(parts, 1 + len(heads.dictionary))
        return pc.binary_join_element_wise(known.take(pa.array(first)), known.take(pa.array(second)), none[0])

    def _known(self, parts: pa.Array, letters: int) -> pa.Array:
        """The ids of parts, from the cache or learned; the first ``letters`` parts are runs of letters.

        A full cache keeps the parts met again since they were learned or it was last full, or
        none if those are too many.
        """
        if len(self.keys) > CACHE_WORDS:
            kept = pa.array(self.used)
            self.keys, self.ids = self.keys.filter(kept), self.ids.filter(kept)
            self.used = np.zeros(len(self.keys), dtype=bool)
            if len(self.keys) > 3 * CACHE_WORDS // 4:
                self.keys, self.ids, self.used = self.keys[:0], self.ids[:0], self.used[:0]
        at = pc.index_in(parts, value_set=self.keys)
        missing = np.flatnonzero(np.asarray(at.is_null()))
        cut = int(np.searchsorted(missing, letters))
        new = parts.take(pa.array(missing))
        keys = new.to_pylist()
        learned = pa.array(self._encode_letters(keys[:cut]) + self._library(keys[cut:]), pa.large_binary())
        self.used[np.asarray(at.drop_null())] = True
        at = np.array(at.fill_null(0), dtype=np.int64)
        at[missing] = len(self.keys) + np.arange(len(missing))
        self.keys, self.ids = pa.concat_arrays([self.keys, new]), pa.concat_arrays([self.ids, learned])
        self.used = np.r_[self.used, np.zeros(len(missing), dtype=bool)]
        return self.ids.take(pa.array(at))

    def _encode_letters(self, heads: list[bytes]) -> list[bytes]:
        """Letters go to the model at once if their case and composition are beyond doubt."""
        out, rest = [b""] * len(heads), []
        tokenize, lower = self.model.tokenize, self.kind == "dropping"
        for i, head in enumerate(heads):
            text = head.decode()
            if head.isascii():
                text = text.replace(" ", BYTE_LETTERS[32])
            elif PLAIN.fullmatch(text):
                text = (text.lower() if lower else text).encode().decode("latin-1").translate(BYTE_LETTERS)
            else:
                text = "\n"
            if text[:1] == "\n":
                rest.append(i)
            else:
                out[i] = array("I", [t.id for t in tokenize(text)]).tobytes()
        for i, v in zip(rest, self._library([heads[i] for i in rest])):
            out[i] = v
        return out

    def _library(self, parts: list[bytes]) -> list[bytes]:
        found = self.whole.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]


def _byte_letters() -> dict[int, str]:
    """How byte-level files write bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    out, spare = {}, 0x100
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


BYTE_LETTERS = _byte_letters()
#: Letters of one lower-case letter each, that no composition changes; a space may come first.
PLAIN = re.compile("[ ]?[A-Za-z\u00c0-\u012f\u0131-\u0148\u014a-\u017e]+")


def _kind(said: dict) -> str:
    pre, normal = said["pre_tokenizer"] or {}, said["normalizer"]
    if any(c.isspace() for t in said["added_tokens"] for c in t["content"]):
        return "whole"
    if said["model"]["type"] != "BPE" or said["model"].get("dropout") or any(t["lstrip"] or t["rstrip"] for t in said["added_tokens"]):
        return "whole"
    if pre.get("type") == "ByteLevel" and normal is None and pre["use_regex"] and not pre["add_prefix_space"]:
        return "leading"
    if pre.get("type") == "Sequence" and normal and normal["type"] == "Sequence":
        cut, rest = pre["pretokenizers"][0], pre["pretokenizers"][1:]
        if (
            cut["type"] == "Split" and cut["pattern"] == {"Regex": DROPPING} and cut["behavior"] == "Removed" and cut["invert"]
            and [r["type"] for r in rest] == ["ByteLevel"] and not rest[0]["use_regex"] and not rest[0]["add_prefix_space"]
            and [n["type"] for n in normal["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        ):
            return "dropping"
    return "whole"
