"""Byte-level BPE encoding over a trie of the distinct words, and decoding.

The last token of a prefix's encoding is unique, and the encoding of a prefix is
the encoding of a shorter prefix followed by that token. So every trie node needs
its last token only, found once from the nodes above it, and words with a common
prefix share all of that work.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from ontime.llm.common import append_columns, slices, texts_of, with_fields

# Words whose ids a task keeps; beyond it they are dropped and collected anew.
MAX_WORDS = 600_000

# Fixed value: the pre-tokenisation pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a vocabulary entry stands for: printable
    characters for themselves, the others numbered from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def unknown_letters() -> str:
    """Ranges of characters that ``regex`` takes for letters or numbers and the
    tokenizers library, whose character tables are older, for neither."""
    letter = regex.compile(r"[\p{L}\p{N}]")
    found = letter.findall("".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000))
    probe = "".join(f"a{c}1{c}\n" for c in found)
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(probe)
    alone = {probe[a:b] for _, (a, b) in split if b == a + 1 and a % 5 == 1 and probe[b] == "1"}
    # A number joins the 1 that follows and a letter the a before; what stands alone is neither.
    codes = sorted(map(ord, alone))
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


class Vocabulary:
    """Tables of a byte-level BPE file, from its content."""

    def __init__(self, content: str, unknown: str = ""):
        spec = json.loads(content)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only plain byte-level BPE files are supported")
        byte = byte_of_char()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of: dict[bytes, int] = {}
        for text, i in model["vocab"].items():
            if text not in self.added:
                self.id_of[bytes(byte[c] for c in text)] = i
        self.longest = max(map(len, self.id_of))
        self.size = 1 + max(*self.id_of.values(), *self.added.values())
        self.bytes_of = [b""] * self.size
        for piece, i in self.id_of.items():
            self.bytes_of[i] = piece
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        self.length_of = [*map(len, self.bytes_of)]
        # rank: of a pair's merge. made, left, right: the merge that makes a token.
        self.rank: dict[int, int] = {}
        self.made, self.left, self.right = [-1] * self.size, [0] * self.size, [0] * self.size
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            x, y = model["vocab"][a], model["vocab"][b]
            token = model["vocab"][a + b]
            self.rank[x * self.size + y] = rank
            self.made[token], self.left[token], self.right[token] = rank, x, y
        self.words = regex.compile(WORDS)
        self.unknown = regex.compile(f"[{unknown}]" if unknown else r"(?!)")
        self.careful = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}--[{unknown}]]+| ?[\p{{N}}--[{unknown}]]+"
            rf"| ?(?:[^\s\p{{L}}\p{{N}}]|[{unknown}])+|\s+(?!\S)|\s+" if unknown else WORDS,
            regex.V1,
        )
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def split(self, text: str, careful: bool = False) -> list[str | int]:
        """The words of a text in order; an added token as its id. The careful
        pattern is slower and right for unknown letters too."""
        pattern = self.careful if careful else self.words
        if not any(a in text for a in self.added):
            return pattern.findall(text)
        out: list[str | int] = []
        for part in self.special.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += pattern.findall(part)
        return out

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether tokens a and b next to each other are never merged across.

        Their last merges are undone from the latest back; if at some stage the
        pieces at the border merge before the piece's own next merge, they don't.
        """
        ended = len(self.rank)
        while True:
            if self.rank.get(a * self.size + b, ended) < ended:
                return False
            if self.made[a] < 0 and self.made[b] < 0:
                return True
            if self.made[a] > self.made[b]:
                ended, a = self.made[a], self.right[a]
            else:  # of two equal merges the one further left comes first, the border's before b's
                ended, b = self.made[b] + 1, self.left[b]


class Trie:
    """Encodes words along the trie of their bytes and keeps their ids.

    Distinct words in byte order are the leaves of their trie in depth-first
    order. The branch to the word at hand is a stack with the last token of every
    prefix on it; the next word goes back to where it leaves that branch and adds
    the rest, so a prefix that words share is encoded once.
    """

    def __init__(self, vocabulary: Vocabulary, max_words: int = MAX_WORDS):
        self.vocabulary, self.max_words = vocabulary, max_words
        self.known: dict[str | int, bytes] = {i: array("I", [i]).tobytes() for i in vocabulary.added.values()}
        self.apart: dict[int, bool] = {}

    def insert(self, words: list[str]) -> None:
        v, apart, known = self.vocabulary, self.apart, self.known
        id_of, size, longest, length_of = v.id_of, v.size, v.longest, v.length_of
        last, before = [0], b""  # last token of each prefix of the word before
        for data, word in sorted((w.encode(), w) for w in words):
            common = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                common += 1
            del last[common + 1 :]
            for depth in range(common + 1, len(data) + 1):
                # Exactly one token can come last, so the lengths may be tried in
                # any order: first the one before with one more byte, which is
                # right most often.
                longer = length_of[last[-1]] + 1 if depth > 1 else 1
                for length in (longer, *range(1, depth + 1 if depth < longest else longest + 1)):
                    token = id_of.get(data[depth - length : depth])
                    if token is None:
                        continue
                    if length < depth:
                        left = last[depth - length]
                        pair = left * size + token
                        ok = apart.get(pair)
                        if ok is None:
                            ok = apart[pair] = v.stay_apart(left, token)
                        if not ok:
                            continue
                    last.append(token)
                    break
                else:
                    raise ValueError(f"no token for byte {data[depth - 1]}")
            ids, depth = array("I"), len(data)
            while depth:
                token = last[depth]
                ids.append(token)
                depth -= length_of[token]
            ids.reverse()
            known[word] = ids.tobytes()
            before = data

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit little-endian numbers."""
        v, known = self.vocabulary, self.known
        split = [v.split(t) for t in texts]
        new = set(chain.from_iterable(split)).difference(known)
        odd = v.unknown.search("".join(w for w in new if not w.isascii()))
        if odd:
            split = [v.split(t, careful=True) if not t.isascii() and v.unknown.search(t) else w for t, w in zip(texts, split, strict=True)]
            new = set(chain.from_iterable(split)).difference(known)
        self.insert(list(new))
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        if odd:  # words with such letters are not kept, so that they are met as new again
            for word in [w for w in new if v.unknown.search(w)]:
                del known[word]
        if len(known) > self.max_words:
            self.__init__(v, self.max_words)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@cache
def vocabulary_of(content: str, unknown: str) -> Vocabulary:
    """One set of tables per Python worker."""
    return Vocabulary(content, unknown)


def read_vocabulary(path: str) -> tuple[str, str]:
    """The file's content and the characters to treat with care, read once on the
    driver: their size is that of a vocabulary, whatever the corpus, so they may
    travel to every task."""
    with open(path, encoding="utf-8") as f:
        return f.read(), unknown_letters()


def id_arrays(blobs: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(b) // 4 for b in blobs)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(blobs), "<u4").astype("i4")))


def encode_documents(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of each text as ``array<int>``, special tokens only where
    the text spells them; a null or empty text has no ids. Rows stay where they
    are, no shuffle; all other columns pass through, whatever their names."""
    content = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(vocabulary_of(*content.value))
        for batch in batches:
            for part in slices(batch, text):
                yield append_columns(part, [id_arrays(trie.encode_all(texts_of(part, text)))], [ids])

    return df.mapInArrow(run, with_fields(df.schema, [(ids, T.ArrayType(T.IntegerType()))]))


def decode_documents(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of the ids, special tokens included; bytes that are not UTF-8
    give replacement characters, unknown ids and nulls nothing."""
    content = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary_of(*content.value).bytes_of
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([*map(len, pieces), 0])  # the last one for ids that are unknown
        firsts = np.cumsum(sizes) - sizes
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = part.column(ids)
                own = pa.compute.fill_null(lists.flatten(), -1).to_numpy()
                own = np.where((own >= 0) & (own < len(pieces)), own, len(pieces))
                counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
                length = sizes[own]
                after = np.cumsum(length)
                data = flat[np.arange(length.sum()) + np.repeat(firsts[own] - (after - length), length)].tobytes()
                ends = np.concatenate([[0], after])[np.cumsum(counts)].tolist()
                out = [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield append_columns(part, [pa.array(out, pa.string())], [text])

    return df.mapInArrow(run, with_fields(df.schema, [(text, T.StringType())]))
