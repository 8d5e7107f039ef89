"""Token counts by a two-tier lookup of pre-tokens.

Byte-level BPE never merges across pre-tokens, so a text's length in tokens is
the sum of its pre-tokens' lengths. The lengths of the most frequent
pre-tokens (taken from a bounded sample of documents) are broadcast as a
packed table; every other pre-token is encoded by the library once per worker
and remembered in a bounded cache. Texts are counted where they are read: no
pre-token is ever shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import bounded_sample, map_text

TABLE_ROWS = 32_768      # pre-tokens in the broadcast table
TABLE_CHARS = 64         # longer pre-tokens are neither in the table nor in a cache
SAMPLE_DOCS = 5_000      # documents that the table's choice is taken from
SKETCH_TASKS = 8         # tasks that count the sample; each returns 2 * TABLE_ROWS pre-tokens at most
CACHE_ROWS = 1 << 18     # pre-tokens a worker remembers besides the table
LONG_TEXT = 1 << 22      # longer texts are split as a stream, not as one list

# Fixed value: the byte-level pre-token pattern.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text; ValueError where pre-tokens are not independent byte-level ones."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    made = json.loads(text)
    pre = made.get("pre_tokenizer") or {}
    if (made["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space") or made.get("normalizer") or made.get("truncation")
            or made.get("padding") or made["model"].get("dropout")):
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    return text


class TokenCounter:
    """Counts tokens as the library does for one tokenizer file, from pre-token lengths."""

    def __init__(self, tokenizer: str, frequent: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(tokenizer)
        self._split = regex.compile(PRE_TOKEN)
        added = [t for t in json.loads(tokenizer).get("added_tokens") or [] if t["content"]]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        # Special strings are cut out first, leftmost and longest; with any finer rule the library counts the text.
        self._special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self._plain_special = plain
        self._lengths = _Lengths(self._encode, frequent or {})
        self._known = set()   # characters that the pattern classes as the library does
        self._other = set()   # characters that it does not

    def _encode(self, text: str) -> int:
        return len(self._library.encode(text, add_special_tokens=False).ids)

    def _agrees(self, text: str) -> bool:
        """Whether library and pattern put every character of the text into the same class.

        The two may follow different Unicode versions. Classes are all that
        the pattern asks of a character, and the probe's pieces differ for
        each class.
        """
        seen = set(text)
        for char in seen - self._known - self._other:
            probe = f"a{char}1{char}.{char} {char}a"
            pieces = [probe[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(probe)]
            (self._known if pieces == self._split.findall(probe) else self._other).add(char)
        return seen.isdisjoint(self._other)

    def pre_tokens(self, text: str) -> list[str]:
        return self._split.findall(text)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        parts, total = [text], 0
        if self._special and self._special.search(text):
            if not self._plain_special:
                return self._encode(text)
            parts = self._special.split(text)
            total = len(parts) - 1
        if not self._agrees(text):
            return self._encode(text)
        get = self._lengths.__getitem__
        for part in parts:
            if len(part) > LONG_TEXT:
                total += sum(get(m.group()) for m in self._split.finditer(part))
            else:
                total += sum(map(get, self._split.findall(part)))
        return total


class _Lengths(dict):
    """Pre-token lengths: the frequent ones, then those this worker has met (forgotten when too many)."""

    def __init__(self, encode, frequent: dict[str, int]):
        super().__init__(frequent)
        self._encode, self._frequent = encode, frequent

    def __missing__(self, word: str) -> int:
        size = self._encode(word)
        if len(word) <= TABLE_CHARS:
            if len(self) >= len(self._frequent) + CACHE_ROWS:
                self.clear()
                self.update(self._frequent)
            self[word] = size
        return size


def pack(lengths: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """A table as three byte strings: the words end to end, where each ends, and the lengths."""
    words = [w.encode("utf-8") for w in lengths]
    return (b"".join(words), np.cumsum([len(w) for w in words], dtype=np.uint32).tobytes(),
            np.fromiter(lengths.values(), np.uint16, len(lengths)).tobytes())


def unpack(table: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    words, ends, lengths = table[0], np.frombuffer(table[1], np.uint32), np.frombuffer(table[2], np.uint16)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return {words[a:b].decode("utf-8"): n for a, b, n in zip(starts.tolist(), ends.tolist(), lengths.tolist())}


_COUNTERS: dict[str, TokenCounter] = {}   # one per worker process and tokenizer table


def _counter(tokenizer: str, table: tuple[bytes, bytes, bytes]) -> TokenCounter:
    name = hashlib.sha256(tokenizer.encode() + b"".join(table)).hexdigest()
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = TokenCounter(tokenizer, unpack(table))
    return _COUNTERS[name]


def frequent_lengths(docs: DataFrame, tokenizer: str, id_col: str, text_col: str) -> dict[str, int]:
    """Lengths of the TABLE_ROWS most frequent pre-tokens of a sample of SAMPLE_DOCS documents.

    The table only decides what is looked up first, never a count. Each of
    SKETCH_TASKS tasks returns its 2 * TABLE_ROWS most frequent pre-tokens at
    most, so the driver gets a bounded number of rows.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    sample = bounded_sample(texts, F.col("id"), SAMPLE_DOCS).select("text").repartition(SKETCH_TASKS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = regex.compile(PRE_TOKEN), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(m.group() for m in split.finditer(text.as_py()) if m.end() - m.start() <= TABLE_CHARS)
                if len(seen) > 16 * TABLE_ROWS:
                    seen = Counter(dict(seen.most_common(8 * TABLE_ROWS)))
        top = seen.most_common(2 * TABLE_ROWS)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    total: Counter = Counter()
    for row in sample.mapInArrow(sketch, "word string, n long").toLocalIterator():
        total[row["word"]] += row["n"]
    count = TokenCounter(tokenizer)
    best = heapq.nsmallest(TABLE_ROWS, total.items(), key=lambda item: (-item[1], item[0]))
    return {word: count._encode(word) for word, _ in best}


def count_tokens(docs: DataFrame, keep: list[str], tokenizer_path: str, limit: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` columns plus n_bytes, n_tokens (long) and over_limit (n_tokens > ``limit``), per row.

    Tokens are those of the library for the file at ``tokenizer_path``, without
    begin or end tokens; strings of special tokens inside a text are one token
    each, as is the library's default. Texts are counted whole.

    Defined cases: a null or empty text has no bytes and no tokens; repeated
    rows, and rows with a null id, are counted one by one; an empty table gives
    an empty result; columns outside ``keep`` are ignored, whatever their names.
    """
    tokenizer = read_tokenizer(tokenizer_path)
    table = pack(frequent_lengths(docs, tokenizer, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, table))

    def measure(texts: list) -> dict[str, list]:
        count = _counter(*shared.value)
        tokens = [count(t) for t in texts]
        return {"n_bytes": [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts],
                "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

    return map_text(docs, keep, text_col, "n_bytes long, n_tokens long, over_limit boolean", measure)
