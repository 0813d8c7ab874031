"""Byte-level BPE with a lexicon of the corpus's frequent words.

Words are counted over all documents.  The frequent ones are merged once and
compiled into a minimal acyclic automaton that shares suffixes; walking it
adds up the number of words passed, which is the word's place in a table of
ids.  The automaton and the table are one file of flat arrays that every
Python worker maps into memory.  Other words are merged exactly where they
occur.  Ids are those of the vocabulary file's own rules.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tintero.llm.common import ship_package, text_or_empty
from tintero.session import materialize

#: The public pattern of byte-level BPE vocabularies (contractions, letters, digits, others, white space)
#: in the standard library's classes, for texts without the characters that these class otherwise.
WORDS = re.compile(r" ?[^\W\d_]+| ?\d+|'s|'t|'re|'ve|'m|'ll|'d| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
LEXICON_WORDS = 100_000
LONGEST_WORD = 64
_FLUSH_WORDS = 100_000
#: Bytes of words outside the lexicon that a worker remembers before it forgets them.
_RARE_BYTES = 1 << 20
#: Characters that are split into words before the new ones are looked up together.
_CHARS = 1 << 20
#: Words of so many bytes are merged many at a time, longer ones one by one with a heap.
_SHORT, _AT_ONCE = 40, 4096
#: Rows that are encoded before their results are passed on.
_ROWS = 200
_NO_RULE, _MERGED = 1 << 62, (1 << 32) - 1


@lru_cache(maxsize=1)
def unusual() -> bytes:
    """Marks, by code point, characters that the standard library classes otherwise than Unicode's letters, digits and white space, or not at all."""

    def odd(c: str) -> bool:
        kind = unicodedata.category(c)
        return kind == "Cn" or c.isalnum() != (kind[0] == "L" or kind == "Nd") or c in "\x1c\x1d\x1e\x1f"

    return bytes(map(odd, map(chr, range(0x110000))))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in own}
    others = [b for b in range(256) if b not in letters]
    return [letters.get(b) or chr(256 + others.index(b)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special strings of a vocabulary file."""

    def __init__(self, path: str):
        self.path, self.splitter = path, None
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        ids = data["model"]["vocab"]
        self.of_byte = [ids[letters[b]] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}  # rank, then the merged id in the low bits
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.setdefault((ids[left], ids[right]), rank << 32 | ids[left + right])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        rules = sorted((left << 32 | right, rule) for (left, right), rule in self.pairs.items())
        self.rule_keys, self.rule_values = np.array([*rules, (1 << 62, _NO_RULE)], np.int64).T.copy()
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, number in ids.items():
            self.bytes[number] = bytes(of_letter[c] for c in token)
        for token, number in self.special.items():
            self.bytes[number] = token.encode()
        found = "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.cut = re.compile(f"({found})") if found else None

    def merge(self, word: bytes) -> list[int]:
        """The word's ids: the lowest-ranked pair is merged first, the leftmost of equals."""
        ids: list[int] = [self.of_byte[b] for b in word]
        rule_of = self.pairs.get
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (r := rule_of(pair)) is not None]
        heapq.heapify(heap)
        end = len(ids)
        while heap:
            rule, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= end or ids[j] != right:
                continue
            merged = rule & _MERGED
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (rule := rule_of((merged, ids[k]))) is not None:
                    heapq.heappush(heap, (rule, i, merged, ids[k]))
            if (h := before[i]) >= 0 and (rule := rule_of((ids[h], merged))) is not None:
                heapq.heappush(heap, (rule, h, ids[h], merged))
        return [i for i in ids if i >= 0]

    def rules_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rule of each pair; a negative id has none."""
        keys = left << 32 | right
        at = np.searchsorted(self.rule_keys, keys)
        return np.where(self.rule_keys[at] == keys, self.rule_values[at], _NO_RULE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word, as :meth:`merge` finds them.

        Short words of similar length are the rows of a matrix.  Each step
        merges one pair in every row that has a rule left, so the rows stay of
        equal width.
        """
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        short = [i for i in order if 0 < len(words[i]) <= _SHORT]
        for i in order[len(order) - sum(len(w) > _SHORT for w in words) :]:
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        of_byte = np.array(self.of_byte, np.int64)

        def finish(places: np.ndarray, ids: np.ndarray) -> None:
            own = ids >= 0
            ends = (4 * own.sum(1).cumsum()).tolist()
            packed = ids[own].astype("<u4").tobytes()
            for place, start, end in zip(places.tolist(), [0, *ends], ends):
                out[place] = packed[start:end]

        for first in range(0, len(short), _AT_ONCE):
            places = np.array(short[first : first + _AT_ONCE])
            chosen = [words[i] for i in places]
            width = len(chosen[-1])
            raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in chosen), np.uint8).reshape(-1, width)
            inside = np.arange(width) < np.array([len(w) for w in chosen])[:, None]
            ids = np.where(inside, of_byte[raw], -1)
            rules = self.rules_of(ids[:, :-1], ids[:, 1:])
            while width > 1 and len(ids):
                at = rules.argmin(1)
                best = np.take_along_axis(rules, at[:, None], 1)[:, 0]
                more = best != _NO_RULE
                if not more.all():
                    finish(places[~more], ids[~more])
                    places, ids, rules, at, best = (x[more] for x in (places, ids, rules, at, best))
                width -= 1
                rows, columns = np.arange(len(ids)), np.arange(width)
                ids[rows, at] = best & _MERGED
                ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
                rules = np.take_along_axis(rules, columns[:-1] + (columns[:-1] >= at[:, None]), 1)
                for some, near in ((at > 0, at - 1), (at < width - 1, at)):
                    r, c = rows[some], near[some]
                    rules[r, c] = self.rules_of(ids[r, c], ids[r, c + 1])
            finish(places, ids)
        return out

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """Stretches of ordinary text and special strings, in turn."""
        if self.cut is None:
            yield False, text
        else:
            for i, part in enumerate(self.cut.split(text)):
                yield bool(i % 2), part

    def words(self, text: str) -> list[str]:
        """The words that merges stay within; rare characters are left to the library's own tables."""
        if not any(map(unusual().__getitem__, map(ord, set(text)))):
            return WORDS.findall(text)
        if self.splitter is None:
            self.splitter = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# ------------------------------------------------------------------ the lexicon


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.number, self.words = False, -1, 0


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The automaton of sorted, distinct words and their ids as one block of flat arrays.

    States that accept the same endings are one state.  Layout: six lengths,
    then per arc a key of its state and byte, ascending, its target and the
    words that pass before it, per state whether a word ends there, per word the
    first id, and all ids.
    """
    root, known, last, path = _State(), {}, b"", []
    firsts, ids = [0], []

    def close(depth: int) -> None:
        while len(path) > depth:
            parent, byte, state = path.pop()
            key = (state.final, *((b, id(s)) for b, s in state.arcs.items()))
            if key in known:
                parent.arcs[byte] = known[key]
            else:
                known[key] = state

    for word, word_ids in entries:
        shared = len(os.path.commonprefix([word, last]))
        close(shared)
        state = path[-1][2] if path else root
        for byte in word[shared:]:
            following = state.arcs[byte] = _State()
            path.append((state, byte, following))
            state = following
        state.final, last = True, word
        ids.extend(word_ids)
        firsts.append(len(ids))
    close(0)

    states = [root]
    root.number = 0
    for state in states:
        for following in state.arcs.values():
            if following.number < 0:
                following.number = len(states)
                states.append(following)

    def count(top: _State) -> None:
        stack = [(top, False)]
        while stack:
            state, ready = stack.pop()
            if ready:
                state.words = state.final + sum(s.words for s in state.arcs.values())
            elif not state.words:
                stack.append((state, True))
                stack.extend((s, False) for s in state.arcs.values() if not s.words)

    count(root)
    keys, targets, passed = [], [], []
    for state in states:
        before = int(state.final)
        for byte, following in state.arcs.items():
            keys.append(state.number << 8 | byte)
            targets.append(following.number)
            passed.append(before)
            before += following.words
    arrays = [np.array(x, "<i4").tobytes() for x in (targets, passed, [s.final for s in states], firsts, ids)]
    head = struct.pack("<6i", len(keys), len(keys), len(keys), len(states), len(firsts), len(ids))
    return b"".join([head, np.array(keys, "<i8").tobytes(), *arrays])


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, parts = 24, []
        for i, size in enumerate(struct.unpack_from("<6i", self.map)):
            parts.append(np.frombuffer(self.map, "<i4" if i else "<i8", size, at))
            at += parts[-1].nbytes
        self.keys, self.targets, self.passed, self.finals, self.firsts, self.ids = parts

    def find(self, word: bytes) -> list[int] | None:
        (packed,) = self.find_many([word])
        return None if packed is None else np.frombuffer(packed, "<u4").tolist()

    def find_many(self, words: list[bytes]) -> list[bytes | None]:
        """The packed ids of each word, or None; the words walk the automaton together, a byte at a step."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out: list[bytes | None] = [None] * len(words)
        raw, at = np.frombuffer(b"".join(words), np.uint8), sizes.cumsum() - sizes
        rows = np.flatnonzero((sizes <= LONGEST_WORD) & bool(len(self.keys)))
        state, place = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for step in range(LONGEST_WORD + 1):
            ended = sizes[rows] == step
            hit = ended & (self.finals[state] == 1)
            for row, i in zip(rows[hit].tolist(), place[hit].tolist()):
                out[row] = self.ids[self.firsts[i] : self.firsts[i + 1]].tobytes()
            rows, state, place = rows[~ended], state[~ended], place[~ended]
            if not len(rows):
                break
            key = state << 8 | raw[at[rows] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            goes = self.keys[arc] == key
            rows, arc = rows[goes], arc[goes]
            state, place = self.targets[arc].astype(np.int64), place[goes] + self.passed[arc]
        return out


@lru_cache(maxsize=1)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def _count_words(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, counts = vocabulary(path), Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"word": [w.encode() for w in counts], "n": list(counts.values())})
            counts.clear()
            return out

        for batch in batches:
            for text in batch["text"]:
                for special, part in vocab.parts(text):
                    if not special:
                        counts.update(vocab.words(part))
                if len(counts) > _FLUSH_WORDS:
                    yield flush()
        yield flush()

    return run


def _merge_words(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for batch in batches:
            packed = vocab.merge_many(list(batch["word"]))
            yield pd.DataFrame({"word": batch["word"], "ids": [np.frombuffer(p, "<u4").astype("i4") for p in packed]})

    return run


def _compile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    entries = sorted((bytes(w), list(i)) for b in batches for w, i in zip(b["word"], b["ids"]))
    yield pd.DataFrame({"lexicon": [compile_lexicon(entries)]})


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the words most frequent over all of ``docs``, ``size`` at most.

    Words of equal count are taken or left together, so the result doesn't
    depend on their order.  Words beyond ``LONGEST_WORD`` bytes are left out.
    """
    texts = docs.select(text_or_empty().alias("text"))
    counts = texts.mapInPandas(_count_words(path), "word binary, n long")
    counts = counts.where(F.octet_length("word") <= LONGEST_WORD).groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n > 1"), "word-counts")
    scale = F.floor(F.log2("n") * 16)
    least, total = None, 0
    for step in sorted(counts.groupBy(scale.alias("s")).agg(F.count("*").alias("words")).collect(), reverse=True):
        total += step.words
        if total > size:
            break
        least = step.s
    frequent = counts.where(scale >= least) if least is not None else counts.limit(0)
    merged = frequent.select("word").repartition(32).mapInPandas(_merge_words(path), "word binary, ids array<int>")
    return merged.coalesce(1).mapInPandas(_compile, "lexicon binary").first().lexicon


class _Coder(dict):
    """Packed ids of words (str) and special strings (one-element tuples).

    Words that the lexicon has stay, at most as many as it has; others are
    merged and remembered up to a number of bytes.
    """

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon):
        super().__init__({(text,): struct.pack("<I", number) for text, number in vocab.special.items()})
        self.vocab, self.lexicon = vocab, lexicon
        self.rare: list[str] = []
        self.rare_bytes = 0

    def _learn(self, words: Iterable[str]) -> None:
        words = list(words)
        raws = [word.encode() for word in words]
        found = self.lexicon.find_many(raws)
        self.update((word, ids) for word, ids in zip(words, found) if ids is not None)
        unseen = [i for i, ids in enumerate(found) if ids is None]
        rare = [words[i] for i in unseen]
        self.update(zip(rare, self.vocab.merge_many([raws[i] for i in unseen])))
        self.rare.extend(rare)
        self.rare_bytes += sum(len(raws[i]) for i in unseen)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        keys: list[list] = []
        for text in texts:
            keys.append([])
            for special, part in self.vocab.parts(text):
                keys[-1].extend([(part,)] if special else self.vocab.words(part))
        self._learn(set(chain.from_iterable(keys)).difference(self))
        out = [b"".join(map(self.__getitem__, k)) for k in keys]
        if self.rare_bytes > _RARE_BYTES:
            for word in self.rare:
                del self[word]
            self.rare, self.rare_bytes = [], 0
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text.  New words of several texts are looked up together."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= _CHARS:
                out.extend(self._encode_group(group))
                group, size = [], 0
        return out + self._encode_group(group)


@lru_cache(maxsize=1)
def _coder(path: str, name: str) -> _Coder:
    return _Coder(vocabulary(path), _lexicon(name))


def decode(vocab: Vocabulary, ids: bytes) -> str:
    numbers = np.frombuffer(ids, "<u4").tolist()
    return b"".join(map(vocab.bytes.__getitem__, numbers)).decode("utf-8", errors="replace")


def encode_decode(docs: DataFrame, path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit ids) and ``decoded`` (text read back from ids).

    ``path`` names a byte-level BPE vocabulary file that every executor can
    read.  Null and empty texts have no ids and decode to the empty text; all
    other columns pass unchanged, except that columns named ids and decoded
    are replaced.  Special strings of the vocabulary are one id each.  An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    name = f"lexicon-{uuid4().hex}"
    local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(local, "wb") as file:
        file.write(build_lexicon(docs, path, lexicon_words))
    spark.sparkContext.addFile(local)

    kept = docs.drop("ids", "decoded")
    kind = T.StructType([*kept.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, name)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(start, _ROWS)
                ids = coder.encode([t or "" for t in rows.column("text").to_pylist()])
                decoded = [decode(coder.vocab, i) for i in ids]
                columns = [*rows.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "ids", "decoded"])

    return kept.mapInArrow(code, kind)
