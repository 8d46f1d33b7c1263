"""Token counts (operator 9) and the cached encoders that packing shares.

Method: a map-side two-tier lookup. The first tier is a compact hash table of frequent pre-tokens, broadcast
once; the second is a cache of the same layout in each Python worker, filled by the library with what a block
of text lacks. A text's tokens are those of its pre-tokens, so no pre-token is ever shuffled. A block of text
is cut into pre-tokens by array operations, equal ones are found by Arrow's dictionary encoding, and only the
different ones of a block are looked up.

What a pre-token is depends on the library, and the split is exact for the public files:
* sentencepiece, ``piece_bpe_32k.model``: no piece of the vocabulary has the space mark after another
  character and the normalizer is the identity, so no merge crosses from a word into the mark before the
  next. A pre-token is a run of spaces with the word after it. Texts that hold the mark itself go to the
  library whole.
* tokenizers, ``word_bpe_49k.json``: white space is removed before the merges and nothing is composed
  across it. Runs of printable ASCII without apostrophes and of Latin-1 letters are cut into letters, single digits
  and other signs as the vocabulary's pattern cuts them, in lower case; other runs between blanks are pre-tokens as
  they are. Texts that hold the string of an added token go to the library whole. Pre-tokens that aren't known are
  encoded JOINED at once, as every last token, and no other, has the vocabulary's mark of a word's end.
Both conditions on the vocabulary are tested when an encoder is built; where one doesn't hold, all
texts go to the library whole.

The table of frequent pre-tokens is read from at most SAMPLE_DOCS short documents and has at most TABLE
entries of at most KEEP bytes. It changes the speed only: what it lacks is encoded. A worker's cache holds at most
CACHE bytes; when it is full, what was not used again goes.

Cases: null and empty texts have 0 tokens. Any length is encoded whole, in blocks of BLOCK bytes. Repeated rows are
counted each; other columns are not read.
"""

from __future__ import annotations

import os
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.words import buffers, mix

SAMPLE_DOCS, SAMPLE_BYTES = 512, 1 << 15
TABLE = 1 << 15
#: Bytes of a worker's cache.
CACHE = 32 << 20
#: Bytes of text that are cut and looked up at once; a run without blanks may be longer.
BLOCK = 1 << 19
#: A pre-token of more bytes isn't kept.
KEEP = 64
#: Pre-tokens that go to the library as one text.
JOINED = 64
MARK = "▁"
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What a byte is to the word vocabulary: white space, a letter, a digit, another sign, or what only the library can judge.
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _OTHER
#: The second byte of the Latin-1 letters, whose first byte is 0xC3; those below 0x9F are capitals.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_ONE = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@[-`{-~]+")

_WORKER: dict[tuple, _Cached] = {}


def in_worker(make, path: str, table: Table | None = None) -> _Cached:
    """This Python worker's encoder; its cache, of at most CACHE bytes, outlives a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are what runs in parallel
    if (make, path) not in _WORKER:
        _WORKER[make, path] = make(path)
    _WORKER[make, path].table = table or Table()
    return _WORKER[make, path]


# --- compact tables ----------------------------------------------------------------------------------------


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number; ``data`` ends with eight bytes more than are used."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), 0, (1,))


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


class Keys:
    """Byte strings: ``data`` (padded), and where each starts and how long it is."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = data, start, size

    @classmethod
    def of(cls, strings: pa.Array) -> Keys:
        offsets, data = buffers(strings)
        return cls(_padded(data[offsets[0] : offsets[-1]]), offsets[:-1] - offsets[0], np.diff(offsets))

    def take(self, which: np.ndarray) -> Keys:
        return Keys(self.data, self.start[which], self.size[which])

    def strings(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[s : s + n].decode() for s, n in zip(self.start.tolist(), self.size.tolist(), strict=True)]

    def part(self, k: int, rows: np.ndarray) -> np.ndarray:
        """The k-th eight bytes of some keys that have them, zero beyond the key."""
        return _eights(self.data)[self.start[rows] + 8 * k] & _MASK[np.minimum(8, self.size[rows] - 8 * k)]

    def hashes(self) -> np.ndarray:
        out = mix(self.size.astype(np.uint64))
        rows, k = np.flatnonzero(self.size > 0), 0
        while len(rows):
            out[rows] = mix(out[rows] * np.uint64(0x9E3779B97F4A7C15) + self.part(k, rows))
            k += 1
            rows = rows[self.size[rows] > 8 * k]
        return out


class Table:
    """A compact map from byte strings to a count and that many 32-bit numbers.

    Sorted 64-bit hashes beside one buffer of keys and one of numbers, no object an entry. Keys are compared whole; of two
    keys of one hash the later is not taken.
    """

    def __init__(self):
        self.hash = np.zeros(0, np.uint64)
        self.keys = Keys(np.zeros(8, np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int32))
        self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.numbers = np.zeros(0, np.uint32)
        self.again = np.zeros(0, bool)

    @property
    def bytes(self) -> int:
        return 25 * len(self.hash) + len(self.keys.data) + 4 * len(self.numbers)

    def find(self, keys: Keys, hashes: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        if not len(self.hash) or not len(hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        same = (self.hash[at] == hashes) & (self.keys.size[at] == keys.size)
        rows, k = np.flatnonzero(same & (keys.size > 0)), 0
        while len(rows):
            same[rows] = self.keys.part(k, at[rows]) == keys.part(k, rows)
            k += 1
            rows = rows[same[rows] & (keys.size[rows] > 8 * k)]
        return np.where(same, at, -1)

    def add(self, keys: Keys, hashes: np.ndarray, count: np.ndarray, numbers: np.ndarray) -> None:
        """New keys; ``numbers`` are those of all of them, one after the other (or none at all)."""
        first = (np.cumsum(count) - count if len(numbers) else np.zeros(len(count), np.int64)) + len(self.numbers)
        hashes, rows = np.unique(hashes, return_index=True)
        new = self.find_hash(hashes)
        hashes, rows = hashes[new], rows[new]
        at = np.searchsorted(self.hash, hashes)
        size = keys.size[rows]
        data = gather(keys.data, keys.start[rows], size)
        start = np.cumsum(size) - size + len(self.keys.data) - 8
        self.hash = np.insert(self.hash, at, hashes)
        self.keys = Keys(_padded(np.concatenate([self.keys.data[:-8], data])), np.insert(self.keys.start, at, start), np.insert(self.keys.size, at, size))
        self.first, self.count = np.insert(self.first, at, first[rows]), np.insert(self.count, at, count[rows])
        self.numbers = np.concatenate([self.numbers, numbers.astype(np.uint32)])
        self.again = np.insert(self.again, at, False)

    def used_again(self) -> Table:
        """A table of the entries that were marked in ``again``, unless these are most of it."""
        out, rows = Table(), np.flatnonzero(self.again)
        if 2 * len(rows) < len(self.hash):
            count = self.count[rows].astype(np.int64)
            out.add(self.keys.take(rows), self.hash[rows], count, gather(self.numbers, self.first[rows].astype(np.int64), count) if len(self.numbers) else self.numbers)
        return out

    def find_hash(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are not in the table."""
        if not len(self.hash):
            return np.ones(len(hashes), bool)
        return self.hash[np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)] != hashes


def gather(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """data[first : first + count] of each pair, one after the other."""
    count = count.astype(np.int64)
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(first - (ends - count), count) + np.arange(total)]


# --- texts to pre-tokens -------------------------------------------------------------------------------------


def _blank(data: np.ndarray, at: int, end: int) -> int:
    """The first place from ``at`` on where a run of blanks begins, or ``end``."""
    step = 1 << 12
    while at < end:
        blank = data[at - 1 : min(end, at + step)] == 0x20
        found = np.flatnonzero(blank[1:] & ~blank[:-1])
        if len(found):
            return at + int(found[0])
        at, step = at + step, 2 * step
    return end


def blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, int, np.ndarray, bool]]:
    """(bytes, text, edge, fresh) of about BLOCK bytes: parts edge[i] : edge[i + 1] belong to the texts ``text`` + i.

    Only a longer text is cut, before a run of blanks; ``fresh``: the first part is the beginning of its text.
    """
    if not len(column):
        return
    offsets, data = buffers(column)
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(end, at + BLOCK)
        if stop < end:
            j = int(np.searchsorted(offsets, stop, side="right")) - 1
            stop = int(offsets[j]) if offsets[j] > at else _blank(data, stop, int(offsets[j + 1]))
        lo = int(np.searchsorted(offsets, at, side="right")) - 1
        hi = int(np.searchsorted(offsets, stop))
        yield data[at:stop], lo, np.clip(offsets[lo : hi + 1], at, stop) - at, bool(offsets[lo] == at)
        at = stop


class _Cached:
    """A library's encoder behind the two tiers."""

    def __init__(self, table: Table | None):
        self.table, self.cache = table or Table(), Table()

    def whole(self, column: pa.Array) -> np.ndarray:
        """Which texts go to the library as they are."""
        if not self.splits:
            return np.ones(len(column), bool)
        out = np.zeros(len(column), bool)
        for x in self.apart:
            out |= pc.fill_null(pc.match_substring(column, x), False).to_numpy(zero_copy_only=False)
        return out

    def units(self, buf: np.ndarray, edge: np.ndarray, fresh: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
        """A block's pre-tokens, and the bounds of each part's."""
        data, starts, bounds = self.cut(buf, edge, fresh)
        offsets = np.append(starts, len(data)).astype(np.int32)
        array = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        return array.dictionary_encode(), bounds

    def values(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, count, numbers) of different pre-tokens, from the tiers or the library."""
        keys = Keys.of(strings)
        hashes = keys.hashes()
        first, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        numbers, held = [], 0

        def take(rows: np.ndarray, n: np.ndarray, own: np.ndarray) -> None:
            nonlocal held
            count[rows] = n
            if len(own):
                first[rows] = np.cumsum(n) - n + held
            numbers.append(own)
            held += len(own)

        left = np.arange(len(hashes))
        for tier in (self.table, self.cache):
            at = tier.find(keys.take(left), hashes[left])
            hit = at >= 0
            if tier is self.cache:
                tier.again[at[hit]] = True
            own = tier.count[at[hit]].astype(np.int64)
            take(left[hit], own, gather(tier.numbers, tier.first[at[hit]].astype(np.int64), own) if len(tier.numbers) else tier.numbers)
            left = left[~hit]
        if len(left):
            n, own = self.encode(keys.take(left).strings())
            take(left, n, own)
            short = keys.size[left] <= KEEP
            if self.cache.bytes > CACHE:
                self.cache = self.cache.used_again()
            self.cache.add(keys.take(left[short]), hashes[left[short]], n[short], gather(own, (np.cumsum(n) - n)[short], n[short]) if len(own) else own)
        return first, count, np.concatenate(numbers)

    def frequent(self, column: pa.Array) -> Table:
        """A table of the most frequent pre-tokens of some texts."""
        seen: Counter = Counter()
        for buf, _, edge, fresh in blocks(column):
            for x in self.units(buf, edge, fresh)[0].value_counts().to_pylist():
                seen[x["values"]] += x["counts"]
        words = [w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if len(w) <= KEEP][:TABLE]
        table = Table()
        keys = Keys.of(pa.array(words, pa.binary()))
        table.add(keys, keys.hashes(), *self.encode(keys.strings()))
        return table


class PieceCounter(_Cached):
    """Token counts by sentencepiece, without begin and end tokens."""

    apart = (MARK,)

    def __init__(self, path: str, table: Table | None = None):
        import sentencepiece

        super().__init__(table)
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) and self._plain()

    def _plain(self) -> bool:
        """Whether white space and compatible forms are kept as they are, so that blanks alone part words."""
        return all(self.lib.decode(self.lib.encode(s)) == s for s in ("a  b", " a", "ﬁ", "　a", "é", "a\tb "))

    def cut(self, buf: np.ndarray, edge: np.ndarray, fresh: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of blanks with the word after them; the library puts a blank before what it gets, so each goes without its first one."""
        blank = buf == 0x20
        new = np.zeros(len(buf), bool)
        new[1:] = blank[1:] & ~blank[:-1]
        begin = edge[:-1][np.diff(edge) > 0]
        new[begin] = True
        starts = np.flatnonzero(new)
        drop = blank[starts]
        drop[np.searchsorted(starts, begin if fresh else begin[1:])] = False
        keep = np.ones(len(buf), bool)
        keep[starts[drop]] = False
        return buf[keep], starts - (np.cumsum(drop) - drop), np.searchsorted(starts, edge)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nothing left of a pre-token is a single blank at the end of a text: the mark alone."""
        return np.array([len(x) if w else 1 for w, x in zip(words, self.lib.encode(words, num_threads=1), strict=True)], np.int64), np.zeros(0, np.uint32)

    def count(self, column: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        out, whole = np.zeros(len(column), np.int64), self.whole(column)
        if whole.any():
            out[whole] = [len(self.lib.encode(x)) if x else 0 for x in column.filter(pa.array(whole)).to_pylist()]
            column = pc.if_else(pa.array(whole), pa.scalar("", column.type), column)
        for buf, text, edge, fresh in blocks(column):
            units, bounds = self.units(buf, edge, fresh)
            counts = self.values(units.dictionary)[1]
            total = np.append(0, np.cumsum(counts[units.indices.to_numpy()]))
            out[text : text + len(edge) - 1] += total[bounds[1:]] - total[bounds[:-1]]
        return out


class WordEncoder(_Cached):
    """Token ids by tokenizers, no special tokens added."""

    def __init__(self, path: str, table: Table | None = None):
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(table)
        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        spec = json.loads(self.lib.to_str())
        self.apart = tuple(t["content"] for t in spec["added_tokens"])
        steps = [(s["type"], s.get("behavior"), s.get("invert"), s.get("pattern", {}).get("Regex")) for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        # The same model for pre-tokens, which are normalized and cut already.
        self.plain = Tokenizer(self.lib.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.lib.get_vocab_size() + 1, bool)
        self.ends[[i for x, i in self.lib.get_vocab().items() if x.endswith(spec["model"]["end_of_word_suffix"] or "\n")]] = True
        self.splits = steps[:1] == [("Split", "Removed", True, pattern)] and [s[0] for s in steps[1:]] == ["ByteLevel"] and normal == ["NFC", "Replace", "Lowercase"]

    def cut(self, buf: np.ndarray, edge: np.ndarray, fresh: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs between white space; those of plain ASCII in lower case and cut where the kind of sign changes and at digits."""
        kind = _KIND[buf]
        lead = np.flatnonzero((buf[:-1] == 0xC3) & _LATIN[buf[1:]])
        kind[lead] = kind[lead + 1] = _LETTER
        at = np.flatnonzero(kind).astype(np.int32)
        if not len(at):
            return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(len(edge), np.int64)
        low = _LOWER[buf]
        low[lead + 1] |= (buf[lead + 1] < 0x9F).astype(np.uint8) << 5
        data, low, kind = buf[at], low[at], kind[at]
        new = np.empty(len(at), bool)
        new[0] = True
        np.not_equal(at[1:], at[:-1] + 1, out=new[1:])
        bounds = np.searchsorted(at, edge)
        new[bounds[bounds < len(at)]] = True
        run = np.flatnonzero(new)
        as_is = np.repeat(np.maximum.reduceat(kind, run) == _OTHER, np.diff(np.append(run, len(at))))
        data = np.where(as_is, data, low)
        new[1:] |= ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & ~as_is[1:]
        starts = np.flatnonzero(new)
        return data, starts, np.searchsorted(starts, bounds)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of ids and the ids of some pre-tokens or texts."""
        alone = np.array([_ONE.fullmatch(w) is not None for w in words], bool)
        one, rest = np.flatnonzero(alone), np.flatnonzero(~alone)
        texts = [" ".join(words[i] for i in one[at : at + JOINED].tolist()) for at in range(0, len(one), JOINED)]
        got = [np.array(e.ids, np.uint32) for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *got])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(one) or len(ids) and ends[-1] != len(ids):  # not with this vocabulary
            one, rest, ids, ends = rest[:0], np.arange(len(words)), ids[:0], ends[:0]
        count = np.zeros(len(words), np.int64)
        count[one] = np.diff(ends, prepend=0)
        if len(rest):
            more = [np.array(e.ids, np.uint32) for e in self.lib.encode_batch_fast([words[i] for i in rest.tolist()], add_special_tokens=False)]
            count[rest] = [len(x) for x in more]
            first = np.zeros(len(words), np.int64)
            first[one], first[rest] = np.cumsum(count[one]) - count[one], np.cumsum(count[rest]) - count[rest] + len(ids)
            ids = gather(np.concatenate([ids, *more]), first, count)
        return count, ids

    def ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, whole."""
        none = np.zeros(0, np.uint32)
        whole = self.whole(column)
        as_is = {i: column[i].as_py() for i in np.flatnonzero(whole).tolist()}
        if as_is:
            column = pc.if_else(pa.array(whole), pa.scalar("", column.type), column)
        done, held = 0, []  # texts that are yielded; the parts of the next one

        def upto(text: int) -> Iterator[np.ndarray]:
            nonlocal done, held
            while done < text:
                yield self.encode([as_is[done] or ""])[1] if done in as_is else np.concatenate(held) if held else none
                done, held = done + 1, []

        for buf, text, edge, fresh in blocks(column):
            yield from upto(text)
            units, bounds = self.units(buf, edge, fresh)
            first, count, numbers = self.values(units.dictionary)
            which = units.indices.to_numpy()
            flat, total = gather(numbers, first[which], count[which]), np.append(0, np.cumsum(count[which]))[bounds]
            for k in range(len(edge) - 1):
                yield from upto(text + k)
                held.append(flat[total[k] : total[k + 1]])
        yield from upto(len(column))


def frequent(documents: DataFrame, make, path: str) -> Table:
    """What the most frequent pre-tokens of a bounded sample encode to.

    The sample is the first SAMPLE_DOCS documents of at most SAMPLE_BYTES that the scan meets; ``take`` reads
    no more partitions than it needs. At most SAMPLE_DOCS * SAMPLE_BYTES bytes come to the driver. A task encodes
    them, as the driver's memory is no place for a vocabulary.
    """
    rows = documents.select(F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES).take(SAMPLE_DOCS)
    if not rows:
        return Table()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, texts = in_worker(make, path), [t for batch in batches for t in batch.column(0).to_pylist()]
        found = encoder.frequent(pa.array(texts, pa.string())) if encoder.splits else Table()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["found"])

    sample = documents.sparkSession.createDataFrame([(r["text"],) for r in rows], "text string").coalesce(1)
    return pickle.loads(sample.mapInArrow(encode, "found binary").collect()[0]["found"])


COUNTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def count_tokens(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every document by the sentencepiece model at ``path``.

    The vocabulary file must be at that path on every worker, as an installed package has it.
    """
    table = documents.sparkSession.sparkContext.broadcast(frequent(documents, PieceCounter, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = in_worker(PieceCounter, path, table.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counter.count(batch.column(2)), pa.int64())], names=COUNTS.names)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(count, COUNTS)
