"""Token counts of whole texts by a two-tier lookup on the map side.

The tokenizer (``word_bpe_49k.json`` by default) encodes each pre-token by
itself, so a text's count is the sum over its pre-tokens.  Pre-tokens are never
shuffled:

* first, every task counts the pre-tokens of its texts in a Misra-Gries summary
  of bounded size; the summaries merge in two rounds (their merge keeps the
  bound), and the driver encodes the heaviest ``TABLE_WORDS`` once;
* their lengths go to all executors as one compact table (words and one number
  each, below 1 MB);
* then every task adds up lengths from the table and encodes what is not in it
  with the library, through a bounded cache for each worker.

Both tiers hold the library's own lengths; the table's content changes only the
speed.  Pre-tokens are found by the tokenizer's own rule where a text has only
characters on which that rule leaves no doubt (ASCII, Latin letters and common
signs).  Elsewhere the unit is a stretch between spaces, and a text that may
hold a special token's string, or a tokenizer with other rules, is encoded as a
whole.

Defined results: a null or empty text has no bytes and no tokens; repeated rows
are counted each; a null id stays null; an empty table gives an empty result.
Only the id and text columns are read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import map_batches, merge_states, state_batch

LIMIT = 2048
#: Pre-tokens in the broadcast table, in a task's summary, in a worker's cache beside the table.
TABLE_WORDS = 1 << 16
SUMMARY_WORDS = 1 << 15
CACHE_WORDS = 200_000
#: Longer pre-tokens are encoded when they come and not remembered.
WORD_CHARS = 64

#: The tokenizer's rules under which texts are cut into pre-tokens here (fixed values).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}

# Characters whose class, lower case and composed form no version of Unicode changes: ASCII,
# Latin-1 and Latin Extended-A (without the dotted capital I, whose lower case is two), dashes and quotes.
_LETTERS = "a-zªµºß-öø-ÿĀ-įı-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ſ‐-‧‰-⁞€]*")
_UNIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Library:
    """The tokenizer of a file: ``tokenizers`` for .json, ``sentencepiece`` for .model."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.by_word, self.special = False, ()
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.length = lambda text: len(processor.encode(text))
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.length = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        added = rules.get("added_tokens") or []
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
        self.by_word = (rules.get("normalizer") == NORMALIZER and steps[0] == SPLIT and all(s.get("use_regex") is False for s in steps[1:])
                        and not any(a["normalized"] or a["single_word"] for a in added))
        self.special = tuple(a["content"] for a in added)
        if self.by_word:
            whole, tokenize = self.length, tokenizer.model.tokenize
            # a word of plain letters is one pre-token that is already in the byte-level alphabet
            self.length = lambda text: len(tokenize(text)) if text.isascii() and text.isalpha() and text.islower() else whole(text)

    def units(self, text: str) -> list[str]:
        """Parts of a text whose lengths add up to the text's."""
        if not self.by_word or any(s in text for s in self.special):
            return [text]
        if _PLAIN.fullmatch(text):
            return _UNIT.findall(text.lower())
        out = []
        for part in text.replace("\n", " ").split(" "):
            if part:
                out += _UNIT.findall(part.lower()) if _PLAIN.fullmatch(part) else [part]
        return out


class Lengths(dict):
    """Lengths by unit: the broadcast table, and what was encoded since, up to a bound."""

    def __init__(self, library: Library, table: dict[str, int], room: int = CACHE_WORDS):
        super().__init__(table)
        self.library, self.table, self.most = library, table, len(table) + room

    def __missing__(self, unit: str) -> int:
        n = self.library.length(unit)
        if len(unit) <= WORD_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.table)
            self[unit] = n
        return n

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.library.units(text))) if text else 0


_libraries: dict[str, Library] = {}
_tables: dict[tuple[str, int], Lengths] = {}


def library(path: str) -> Library:
    if path not in _libraries:
        _libraries[path] = Library(path)
    return _libraries[path]


def _lengths(path: str, packed: bytes) -> Lengths:
    """The worker's two tiers (kept between tasks that use the same table)."""
    key = (path, hash(packed))
    if key not in _tables:
        _tables.clear()
        _tables[key] = Lengths(library(path), unpack(packed))
    return _tables[key]


def pack(counts: dict[str, int]) -> bytes:
    """Words and a number each, compressed; words hold no white space."""
    return zlib.compress("\n".join(f"{w}\t{n}" for w, n in counts.items()).encode(), 1)


def unpack(packed: bytes) -> dict[str, int]:
    lines = (line.split("\t") for line in zlib.decompress(packed).decode().split("\n") if line)
    return {w: int(n) for w, n in lines}


def trim(counts: Counter, most: int) -> Counter:
    """Misra-Gries: at most ``most`` words stay, each count lowered by that of the first word left out."""
    if len(counts) <= most:
        return counts
    ranked = sorted(counts.values(), reverse=True)
    cut = ranked[most]
    return Counter({w: n - cut for w, n in counts.items() if n > cut})


def frequent(docs: DataFrame, path: str, most: int = TABLE_WORDS, summary: int = SUMMARY_WORDS) -> list[str]:
    """The heaviest pre-tokens of all texts, heaviest first (ties by the word)."""
    def run(batches):
        counts, tool = Counter(), library(path)
        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    counts.update(tool.units(text))
            if len(counts) > 4 * summary:
                counts = trim(counts, summary)
        counts = trim(Counter({w: n for w, n in counts.items() if len(w) <= WORD_CHARS and not re.search(r"\s", w)}), summary)
        if counts:
            yield state_batch(pack(counts))

    def merge(states: Iterator[bytes]) -> bytes | None:
        total, size = Counter(), max(most, summary)
        for s in states:
            total.update(unpack(s))
            if len(total) > 4 * size:
                total = trim(total, size)
        return pack(trim(total, size)) if total else None

    packed = merge_states(map_batches(docs, ["text"], "state binary", run), merge)
    counts = unpack(packed) if packed else {}
    return sorted(counts, key=lambda w: (-counts[w], w))[:most]


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, table_words: int = TABLE_WORDS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``."""
    path = tokenizer or default_path()
    tool = Library(path)
    words = frequent(docs, path, table_words) if tool.by_word else []
    table = docs.sparkSession.sparkContext.broadcast(pack({w: tool.length(w) for w in words}))

    def run(batches):
        lengths = _lengths(path, table.value)
        for b in batches:
            n = [lengths.count(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")],
                       "doc_id long, n_bytes long, n_tokens long, over_limit boolean", run)
