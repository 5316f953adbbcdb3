"""Encoding texts word by word with a public tokenizer."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: White space at which the tokenizer's words end (Unicode White_Space). Arrow also splits at U+001C to U+001F.
_GAPS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = re.compile(f"[^{_GAPS}]+")
#: Latin letters and printable ASCII.
_LATIN = re.compile("[ -~\xc0-\u012f\u0131-\u017f]+")


def split_column(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's words begin, and all words: stretches without white space.

    The tokenizer's own words never cross white space. Null has no words;
    white space at an end of a text may give an empty word.
    """
    texts = texts.cast(pa.string()).fill_null("")
    if pc.any(pc.match_substring_regex(texts, "[\\x1c-\\x1f]")).as_py():
        lists = [_SPLIT.findall(text) for text in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(words) for words in lists])])
        return offsets, pa.array([w for words in lists for w in words], pa.string())
    lists = pc.utf8_split_whitespace(texts)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    return offsets - offsets[0], lists.flatten()


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file in a broadcast; its size is the file's (a few MB at most)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast({"text": file.read()})


def encoder_of(shared: Broadcast) -> WordEncoder:
    """This worker's encoder, built once and kept from task to task."""
    held = shared.value
    if "encoder" not in held:
        held["encoder"] = WordEncoder(held["text"])
    return held["encoder"]


class WordEncoder:
    """Ids of words by a tokenizer, with a bounded memory of words seen."""

    def __init__(self, text: str, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.remember = remember
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._model = self.tokenizer.model
        self._level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        made = json.loads(text)
        self._added = [t["content"] for t in made.get("added_tokens", ())]
        pattern = _split_pattern(made)
        self._split = regex.compile(pattern) if pattern else None

    def _part(self, part: str) -> bytes:
        """Ids of one part of a plain word; characters outside ASCII first become the tokenizer's byte letters."""
        if len(self._parts) >= self.remember // 2:
            self._parts.clear()
        level = part if part.isascii() else self._level.pre_tokenize_str(part)[0][0]
        found = self._parts[part] = array("I", [t.id for t in self._model.tokenize(level)]).tobytes()
        return found

    def _plain(self, text: str) -> bool:
        """Whether Python and the tokenizer are sure to agree on case, letters and composition.

        Holds for words and for words joined by blanks.
        """
        if self._split is None or not (text.isprintable() if text.isascii() else _LATIN.fullmatch(text)):
            return False
        return not any(t in text for t in self._added) and (text.isascii() or unicodedata.is_normalized("NFC", text))

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers, as the library gives them.

        Plain words go straight to the library's merge model, part by part;
        any other word goes through the whole library.
        """
        out: list[bytes] = []
        parts, make = self._parts, self._part
        for start in range(0, len(words), 64):
            some = words[start : start + 64]
            if not self._plain(" ".join(some)):
                out += [self._one(word) for word in some]
                continue
            for word in some:
                lower = word.lower()
                if lower.isalpha():
                    out.append(parts.get(lower) or make(lower))
                else:
                    out.append(b"".join([parts.get(p) or make(p) for p in self._split.findall(lower)]))
        return out

    def _one(self, word: str) -> bytes:
        if self._plain(word):
            return b"".join([self._parts.get(p) or self._part(p) for p in self._split.findall(word.lower())])
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and the last ones end. Null is empty.

        Words are split and made distinct by Arrow; each distinct word is looked
        up once, and its ids are taken for every place at once.
        """
        offsets, places = split_column(texts)
        coded = places.dictionary_encode()
        names = coded.dictionary.to_pylist()
        found = list(map(self._known.get, names))
        if None in found:
            new = [i for i, ids in enumerate(found) if ids is None]
            words = [names[i] for i in new]
            ids = list(map(self._older.get, words))
            unseen = [i for i, known in enumerate(ids) if known is None]
            for i, fresh in zip(unseen, self.encode_words([words[i] for i in unseen])):
                ids[i] = fresh
            for i, known in zip(new, ids):
                found[i] = known
            if len(self._known) + len(words) > self.remember:
                self._older, self._known = self._known, {}
            self._known.update(zip(words, ids))
        taken = pa.array(found, pa.large_binary()).take(coded.indices)
        _, ends, data = taken.buffers()
        if data is None or not len(taken):
            return np.empty(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        at = np.frombuffer(ends, np.int64)[taken.offset : taken.offset + len(taken) + 1] // 4
        return np.frombuffer(data, "<u4"), at[offsets]


def _split_pattern(made: dict) -> str | None:
    """The word pattern, if the tokenizer composes, lowers case, takes the matches and maps bytes; else None."""
    normal = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", ())]
    steps = (made.get("pre_tokenizer") or {}).get("pretokenizers", ())
    if normal != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        return None
    cut, level = steps
    taken = cut["behavior"] == "Removed" and cut["invert"] and not level["add_prefix_space"] and not level["use_regex"]
    return cut["pattern"].get("Regex") if taken else None
