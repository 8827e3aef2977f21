"""Byte-pair encoding and decoding with a minimal acyclic transducer lexicon.

Frequent words of the corpus are compiled, with their ids as outputs, into a
minimal acyclic automaton whose words share both prefixes and suffixes. Arcs
carry numbers whose sum along a word's path is the word's rank in the lexicon,
and the rank leads to the word's ids. The automaton is a set of flat arrays in
one file; Spark ships that file to the executors, which map it into memory. A
word that it does not hold is merged exactly, pair by pair, in order of rank.

Texts are cut at spaces into words, and equal words of a batch are looked up once;
the ids of a batch are gathered by number of word. Texts in which a cut at a space could
fall inside a word (runs of white space, characters beyond PLAIN, special tokens) are
split by the vocabulary's own rules instead.
"""

from __future__ import annotations

import json
import mmap
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import discard, new_path, staged, write_file

#: Rows of counted words that a worker holds before it adds them up or passes them on.
COUNT_ROWS = 1_000_000

# White space as the tokenizers library's patterns take it, and the two split patterns of the public vocabularies.
SPACE = r"\t-\r \x85\xa0  -     　"
BYTE_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORD_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
#: Texts with other characters are split by the library, as its tables of characters may be older or newer.
PLAIN = re.compile(r"[\x00-ɏ‐-‧‰-⁞₠-₽]*")
#: Words with none but the first of these characters are not split further.
UNSPLIT = r"[^A-Za-zÀ-ÖØ-öø-ɏ]"
ODD_SPACE = re.compile(r"[\x1c-\x1f]")
SPACE_RUN = re.compile(rf" [{SPACE}]")


@lru_cache(1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an array of strings without nulls."""
    if not len(words):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return offsets, np.frombuffer(words.buffers()[2] or b"", np.uint8)


class Merges:
    """The vocabulary's merges, applied to many words at once.

    Each round merges in every word that is not done the pair of least rank, at all its
    places from left to right. A pair with a merged symbol in it ranks after the pair that made
    the symbol, so this is the order in which single merges would go.
    """

    _NONE = np.int32(2**31 - 1)

    def __init__(self, pairs: np.ndarray, merged: np.ndarray) -> None:
        self.merged = merged
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self._NONE, np.int32)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        keys, first = np.unique(keys, return_index=True)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # each free slot takes one key, the others go one further
            free = left[self.keys[at[left]] == -1]
            slots, taker = np.unique(at[free], return_index=True)
            self.keys[slots], self.ranks[slots] = keys[free[taker]], first[free[taker]]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, _NONE where it is none."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.ranks[at], self._NONE)
        todo = np.flatnonzero((held != keys) & (held != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        return out

    def apply(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words, with the given lengths, after all merges: lengths and symbols."""
        word = np.repeat(np.arange(len(lens)), lens)
        done_word, done_symbol = [], []
        while len(symbols):
            inner = np.append(word[1:] == word[:-1], False)
            rank = np.full(len(symbols), self._NONE, np.int32)
            pairs = np.flatnonzero(inner)
            rank[pairs] = self.rank(symbols[pairs], symbols[pairs + 1])
            start = np.flatnonzero(np.append(True, ~inner[:-1]))
            size = np.diff(np.append(start, len(symbols)))
            least = np.repeat(np.minimum.reduceat(rank, start), size)
            done = least == self._NONE
            if done.any():
                done_word.append(word[done])
                done_symbol.append(symbols[done])
                word, symbols, rank, least = (x[~done] for x in (word, symbols, rank, least))
            at = np.flatnonzero(rank == least)
            # of places that overlap, as in a run of one symbol, every second one counts
            fresh = np.append(True, at[1:] != at[:-1] + 1) if len(at) else np.empty(0, bool)
            run = np.cumsum(fresh) - 1
            at = at[(np.arange(len(at)) - np.flatnonzero(fresh)[run]) % 2 == 0] if len(at) else at
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            word, symbols = word[keep], symbols[keep]
        word, symbols = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_word, done_symbol))
        order = np.argsort(word, kind="stable")
        return np.bincount(word.astype(np.int64), minlength=len(lens)), symbols[order].astype(np.uint32)


class Merger:
    """Exact merges of single words, and the rules that split a text into words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.letters = byte_letters()
        self.words_only = bool(self.end)
        self.find = regex.compile(WORD_SPLIT if self.words_only else BYTE_SPLIT).findall
        self.library = Tokenizer.from_file(path)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges(np.array([[self.vocab[a], self.vocab[b]] for a, b in pairs], np.int64).reshape(-1, 2), np.array([self.vocab[a + b] for a, b in pairs], np.int32))
        self.letter_ids = np.array([self.vocab[c] for c in self.letters], np.int32)
        self.last_ids = np.array([self.vocab[c + self.end] for c in self.letters], np.int32)
        to_byte = {c: b for b, c in enumerate(self.letters)}
        strings = self.vocab | self.special
        self.id_bytes: list[bytes] = [b""] * (max(strings.values()) + 1)
        for token, i in strings.items():
            plain = token.removesuffix(self.end) if self.end else token
            self.id_bytes[i] = token.encode() if token in self.special else bytes(to_byte[c] for c in plain) + b" " * (plain != token)

    def plain(self, text: str) -> bool:
        """Whether every space of the text surely begins a word, and no special token is in it."""
        if not PLAIN.fullmatch(text) or any(t in text for t in self.special):
            return False
        return not (ODD_SPACE if self.words_only else SPACE_RUN).search(text)

    def split(self, texts: list[str]) -> pa.ListArray:
        """Plain texts cut at spaces (or at white space, normalised). No word reaches over a cut."""
        if self.words_only:
            return pc.utf8_split_whitespace(pa.array([unicodedata.normalize("NFC", t).lower() for t in texts], pa.string()))
        return pc.split_pattern(pa.array(texts, pa.string()), " ")

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, in order."""
        if self.words_only:
            text = unicodedata.normalize("NFC", text)
        if PLAIN.fullmatch(text):
            return self.find(text.lower() if self.words_only else text)
        if not self.words_only:
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, text: str) -> Iterator[str | int]:
        """Stretches of ordinary text, and the ids of special tokens between them."""
        at = 0
        for m in self.special_re.finditer(text) if self.special else ():
            yield text[at : m.start()]
            yield self.special[m[0]]
            at = m.end()
        yield text[at:]

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all these ids; a word is a stretch that merges do not cross."""
        offsets, data = _buffers(words)
        lens = np.diff(offsets)
        symbols = self.letter_ids[data[offsets[0] : offsets[-1]]]
        if self.end and len(symbols):
            last = (offsets[1:] - 1 - offsets[0])[lens > 0]
            symbols[last] = self.last_ids[data[offsets[0] + last]]
        return self.merges.apply(symbols, lens)


@lru_cache(4)
def merger(path: str) -> Merger:
    return Merger(path)


def build_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The file of a lexicon: header, arc keys, arc targets, arc outputs, finals, id offsets, ids.

    States are numbered after their minimisation; an arc's key is 256 * state + byte, and
    keys are sorted. An arc's output is the number of words that sort before it below its state.
    """
    register: dict[tuple, int] = {}
    arcs: list[list[tuple[int, int]]] = []
    final: list[bool] = []
    count: list[int] = []

    def settle(node: list) -> int:
        sig = (node[0], tuple(node[1]))
        if sig not in register:
            register[sig] = len(arcs)
            arcs.append(list(node[1]))
            final.append(node[0])
            count.append(int(node[0]) + sum(count[t] for _, t in node[1]))
        return register[sig]

    path: list[list] = [[False, [], None]]  # final, settled arcs, byte of the arc still open

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            done = settle(path.pop())
            path[-1][1].append((path[-1][2], done))

    ordered, last = sorted(words), b""
    for w in ordered:
        same = os.path.commonprefix([last, w])
        close(len(same))
        for byte in w[len(same) :]:
            path[-1][2] = byte
            path.append([False, [], None])
        path[-1][0], last = True, w
    close(0)
    root = settle(path[0])
    keys, targets, outs = [], [], []
    for s, own in enumerate(arcs):
        before = int(final[s])
        for byte, t in own:
            keys.append(s * 256 + byte)
            targets.append(t)
            outs.append(before)
            before += count[t]
    offsets = np.cumsum([0, *(len(words[w]) for w in ordered)])
    ids = [i for w in ordered for i in words[w]]
    parts = [np.array(keys, np.int64), np.array(targets, np.int32), np.array(outs, np.int32), np.array(final, np.uint8), offsets.astype(np.int64), np.array(ids, np.uint32)]
    head = np.array([root, len(keys), len(final), len(ordered), len(ids), 0, 0, 0], np.int64)
    return head.tobytes() + b"".join(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)


class Lexicon:
    """A lexicon file, mapped into memory."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, n_arcs, n_states, n_words, n_ids = (int(x) for x in np.frombuffer(self.map, np.int64, 5))
        at = 64
        self.parts = []
        for kind, n in ((np.int64, n_arcs), (np.int32, n_arcs), (np.int32, n_arcs), (np.uint8, n_states), (np.int64, n_words + 1), (np.uint32, n_ids)):
            self.parts.append(np.frombuffer(self.map, kind, n, at))
            at += -(-self.parts[-1].nbytes // 8) * 8
        self.keys, self.targets, self.outs, self.final, self.offsets, self.ids = self.parts

    def ranks(self, words: pa.Array, prefix: bytes = b"") -> np.ndarray:
        """The rank of each word, with the prefix before it, in the lexicon; -1 where it is not in it."""
        n = len(words)
        offsets, data = _buffers(words)
        start, lens = offsets[:-1], np.diff(offsets)
        state, rank = np.full(n, self.root, np.int64), np.zeros(n, np.int64)
        if not len(self.keys):
            return np.full(n, -1)

        def follow(alive: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
            key = state[alive] * 256 + byte
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            state[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            rank[alive] += self.outs[arc]
            state[alive] = self.targets[arc]
            return alive

        alive, depth = np.arange(n), 0
        for byte in prefix:
            alive = follow(alive, byte)
        while len(alive):
            alive = alive[lens[alive] > depth]
            alive = follow(alive, data[start[alive] + depth])
            depth += 1
        good = state >= 0
        good[good] = self.final[state[good]] == 1
        return np.where(good, rank, -1)

    def ids_of(self, rank: int) -> bytes:
        return self.ids[self.offsets[rank] : self.offsets[rank + 1]].tobytes()


def _gathered(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of values, one after the other."""
    return values[np.repeat(start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))]


class Encoder:
    """Texts to little-endian 32-bit ids: lexicon first, exact merges for the rest."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None = None) -> None:
        self.merger, self.lexicon = merger, lexicon
        self.tokens = pa.array(merger.id_bytes, pa.binary())

    def _merged(self, chunks: pa.Array, prefix: str) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each chunk of text has, and all these ids, by merges."""
        m = self.merger
        split = np.flatnonzero(np.asarray(pc.match_substring_regex(chunks, UNSPLIT).to_numpy(zero_copy_only=False), bool))
        whole = np.setdiff1d(np.arange(len(chunks)), split)
        found = [m.find(prefix + c) for c in chunks.take(pa.array(split)).to_pylist()]
        words = chunks.take(pa.array(whole))
        if prefix:
            words = pc.binary_join_element_wise(prefix, words, "")
        lens, ids = m.merge(pa.concat_arrays([words, pa.array([w for f in found for w in f], pa.string())]))
        owner = np.concatenate([whole, np.repeat(split, np.fromiter(map(len, found), np.int64, len(found)))])
        order = np.argsort(owner, kind="stable")
        start = np.cumsum(lens) - lens
        return np.bincount(owner, lens, len(chunks)).astype(np.int64), _gathered(ids, start[order], lens[order])

    def _table(self, chunks: pa.Array, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of different chunks has, and all these ids: those of the lexicon, and merges for the rest."""
        if not self.lexicon:
            return self._merged(chunks, prefix)
        ranks = self.lexicon.ranks(chunks, prefix.encode())
        hit = ranks >= 0
        missed, at = np.flatnonzero(~hit), self.lexicon.offsets
        lens, start = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        lens[missed], values = self._merged(chunks.take(pa.array(missed)), prefix)
        start[missed] = np.cumsum(lens[missed]) - lens[missed]
        lens[hit] = at[ranks[hit] + 1] - at[ranks[hit]]
        start[hit] = len(values) + np.cumsum(lens[hit]) - lens[hit]
        values = np.concatenate([values, _gathered(self.lexicon.ids, at[ranks[hit]], lens[hit])])
        return lens, _gathered(values, start, lens)

    def _plain(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are plain."""
        lists = self.merger.split(texts)
        offsets, words = np.asarray(lists.offsets).astype(np.int64), lists.values.dictionary_encode()
        which = np.asarray(words.indices).astype(np.int64)
        if self.merger.words_only:
            lens, ids = self._table(words.dictionary)
        else:
            lens, ids = self._table(words.dictionary, " ")
            first = offsets[:-1]  # the first chunk of a text has no space before it
            more, more_ids = self._table(lists.values.take(pa.array(first)))
            which[first] = len(lens) + np.arange(len(first))
            lens, ids = np.concatenate([lens, more]), np.concatenate([ids, more_ids])
        out = np.asarray(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(ids)).take(pa.array(which)).flatten())
        ends = np.concatenate([[0], np.cumsum(lens[which])])[offsets] * 4
        raw = memoryview(out.astype("<u4").tobytes())
        return [bytes(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        m = self.merger
        plain = [m.plain(t) for t in texts]
        done = iter(self._plain([t for t, p in zip(texts, plain, strict=True) if p]) if any(plain) else ())
        return [next(done) if p else b"".join(x.to_bytes(4, "little") if isinstance(x, int) else m.merge(pa.array(m.words(x), pa.string()))[1].astype("<u4").tobytes() for x in m.pieces(t)) for t, p in zip(texts, plain, strict=True)]

    def decode(self, ids: list[bytes]) -> list[str]:
        """The texts of lists of ids: the bytes of their tokens, invalid ones replaced."""
        out = self.tokens.take(pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.uint32)))
        if not len(out):
            return [""] * len(ids)
        ends = np.frombuffer(out.buffers()[1], np.int32)[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        raw = memoryview(out.buffers()[2])
        return [str(raw[a:b], "utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _chunks(texts: list[str], size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` characters together."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def word_counts(df: DataFrame, text_col: str, path: str) -> DataFrame:
    """``word, n``: how often each stretch between spaces (with the space before it, if it is part of a word) occurs in all texts; nulls count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, rows = merger(path), [], 0

        def added(parts: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for lo, hi in _chunks(texts):
                found = m.split(texts[lo:hi]).values.value_counts()
                words = found.field(0)
                held.append(pa.table({"word": words if m.words_only else pc.binary_join_element_wise(" ", words, ""), "n": found.field(1)}))
                rows += len(words)
                if rows > COUNT_ROWS:
                    held = [added(held)]
                    rows = len(held[0])
                    if rows > COUNT_ROWS // 2:
                        yield from held.pop().to_batches()
                        rows = 0
        if held:
            yield from added(held).to_batches()

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon_file(df: DataFrame, text_col: str, path: str, size: int = 50_000, max_bytes: int = 64) -> str:
    """Build the lexicon of up to ``size`` most frequent words and give it to the executors.

    The least count that a word needs is read off a histogram of the counts, so the
    driver gets no more than ``size`` words whatever the corpus; words of the class of
    counts that would exceed it, and words longer than ``max_bytes``, are left to exact
    merging. Returns the name under which the workers find the file.
    """
    m = merger(path)
    step = F.floor(F.log2("n") * 8)
    counts = staged(word_counts(df, text_col, path).where(F.octet_length("word") <= max_bytes).withColumn("step", step), "word-counts")
    least, held = None, 0
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        held += row["count"]
        if held > size:
            break
        least = row["step"]
    top = counts.where(F.col("step") >= least).collect() if least is not None else []
    spark = df.sparkSession
    words = [r["word"] for r in top]
    split = [m.find(w) for w in words]
    lens, ids = m.merge(pa.array([w for own in split for w in own], pa.string()))
    ends = np.cumsum([0, *lens])[np.cumsum([0, *map(len, split)])].tolist()
    blob = build_lexicon({w.encode(): ids[a:b].tolist() for w, a, b in zip(words, ends[:-1], ends[1:], strict=True)})
    file = write_file(new_path(spark, "lexicon"), blob, spark)
    spark.sparkContext.addFile(file)
    discard(counts)
    return os.path.basename(file)


@lru_cache(4)
def _encoder(path: str, lexicon: str | None) -> Encoder:
    return Encoder(merger(path), Lexicon(SparkFiles.get(lexicon)) if lexicon else None)


def encoding(path: str, lexicon: str | None = None):
    """A step over Arrow batches whose columns are an id and a text: it returns ``id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, lexicon)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in _chunks(texts):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(enc.encode(texts[lo:hi]), pa.binary())], ["id", "ids"])

    return run


def decoding(path: str, lexicon: str | None = None):
    """A step over Arrow batches with a column ``ids``: it adds ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, lexicon)
        for b in batches:
            ids = b.column("ids")
            texts = enc.decode([x or b"" for x in ids.to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string(), mask=np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool))], [*b.schema.names, "text"])

    return run


def _inputs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def encode(df: DataFrame, id_col: str, text_col: str, path: str, lexicon: str | None = None) -> DataFrame:
    """``id, ids``: the little-endian 32-bit ids of each text, special tokens as the library takes them.

    A null text is empty and has no ids; every input row gives one row, and columns
    other than the two named ones are dropped.
    """
    return _inputs(df, id_col, text_col).mapInArrow(encoding(path, lexicon), "id long, ids binary")


def decode(df: DataFrame, path: str) -> DataFrame:
    """Adds ``text`` to rows ``id, ids``: the decoded ids; null ids give a null text."""
    return df.select("id", "ids").mapInArrow(decoding(path), "id long, ids binary, text string")


def encode_and_decode(df: DataFrame, id_col: str, text_col: str, path: str, lexicon: str | None, then, schema: str) -> DataFrame:
    """Encode, decode and apply ``then`` to batches ``id, ids, text``, all in one Python worker."""
    first, second = encoding(path, lexicon), decoding(path, lexicon)
    return _inputs(df, id_col, text_col).mapInArrow(lambda batches: then(second(first(batches))), schema)
