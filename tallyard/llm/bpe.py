"""Byte-level BPE: encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. Each round looks all neighbouring pairs up by binary search in
the sorted keys of the merge table, takes in every word the pair of lowest rank, and merges its occurrences
there, until no pair is left. Words are split as the vocabulary's pre-tokenizer splits them.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rows, WordNumbers, ranges, text_slices, utf8

#: Distinct words remembered by a worker before it starts anew.
CACHE = 1_000_000
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    out = np.full(0x110000, _OTHER, np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER}
    for c in range(0x110000):
        k = kinds.get(unicodedata.category(chr(c))[0])
        if k is not None:
            out[c] = k
    out[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return out


def word_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of texts raw[offsets[k]:offsets[k + 1]] (UTF-8) begin, in bytes.

    The rule of byte-level BPE vocabularies: runs of letters, of numbers or of other characters, each with one
    space before it if there is one; the contractions 's 't 're 've 'm 'll 'd; and the rest of the white space,
    of which the last character stands alone if text follows.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    if raw.max() < 128:
        point, byte_at, doc_at = raw, None, offsets
    else:
        lead = (raw & 0xC0) != 0x80
        byte_at = np.flatnonzero(lead)
        point = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        doc_at = np.searchsorted(byte_at, offsets)
    n = len(point)
    kind = char_classes()[point]
    edge = np.zeros(n + 1, bool)
    edge[doc_at] = True
    begin = edge[:-1].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    heads = np.flatnonzero(begin)
    tails = np.append(heads[1:], n)
    inner = (kind[heads] == _SPACE) & ~edge[tails]
    last = tails[inner] - 1
    begin[last] = True
    joined = point[last] == 32
    begin[last[joined] + 1] = False
    quote = np.flatnonzero((point[heads] == 39) & (tails - heads == 1) & begin[heads] & ~edge[tails])
    if len(quote):
        quote = quote[kind[heads[quote + 1]] == _LETTER]
        at, end = heads[quote] + 1, tails[quote + 1]
        a = point[at]
        b = np.where(at + 1 < end, point[np.minimum(at + 1, n - 1)], 0)
        single = np.isin(a, [ord(c) for c in "stmd"])
        double = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        took = np.where(single, 1, np.where(double, 2, 0))
        at, end, took = at[took > 0], end[took > 0], took[took > 0]
        begin[at] = False
        begin[(at + took)[at + took < end]] = True
    starts = np.flatnonzero(begin)
    return starts if byte_at is None else byte_at[starts]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Bpe:
    """Encoder and decoder for one vocabulary file (JSON of a byte-level BPE model)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.byte_id = np.array([vocab[c] for c in alphabet], np.int64)
        size = 1 + max(max(vocab.values()), *self.special.values()) if self.special else 1 + max(vocab.values())
        self.size = size
        pairs = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.keys, self.ranks = pairs[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.byte_starts = np.concatenate([[0], np.cumsum(lengths)])
        self.byte_data = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._reset()

    def _reset(self) -> None:
        self.known, self.word_ids = WordNumbers(), Rows()  # known words, and the ids of each by its number

    def merge_words(self, raw: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words (their bytes one after another, and how many each has), and how many ids each has.

        Rounds of lowest-rank merges over one flat array of symbols.
        """
        sym = self.byte_id[raw]
        word = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(sym))
        out_sym, out_word, out_at = [], [], []
        none = len(self.merged)
        rank = np.full(len(sym), none, np.int64)  # of the pair that begins here
        stale = np.arange(len(sym))
        while len(sym):
            left = stale[stale < len(sym) - 1]
            left = left[word[left] == word[left + 1]]
            key = sym[left] * self.size + sym[left + 1]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank[stale] = none
            rank[left] = np.where(self.keys[found] == key, self.ranks[found], none)
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(sym))))
            live = best < none
            if not live.all():  # words with nothing to merge leave the array
                out_sym.append(sym[~live])
                out_word.append(word[~live])
                out_at.append(at[~live])
                sym, word, at, rank, best = sym[live], word[live], at[live], rank[live], best[live]
                if not len(sym):
                    break
            hit = rank == best
            twice = hit[1:] & hit[:-1]
            if twice.any():  # of overlapping occurrences (a run of hits) every second one is merged, from the left
                index = np.arange(len(hit))
                begin = hit & ~np.concatenate([[False], hit[:-1]])
                hit &= (index - np.maximum.accumulate(np.where(begin, index, 0))) % 2 == 0
            where = np.flatnonzero(hit)
            sym[where] = self.merged[rank[where]]
            keep = np.ones(len(sym), bool)
            keep[where + 1] = False
            sym, word, at, rank = sym[keep], word[keep], at[keep], rank[keep]
            now = where - np.arange(len(where))
            stale = np.concatenate([now, np.maximum(now - 1, 0)])
        if not out_sym:
            return np.zeros(0, np.int64), np.zeros(len(counts), np.int64)
        order = np.argsort(np.concatenate(out_at))
        return np.concatenate(out_sym)[order], np.bincount(np.concatenate(out_word), minlength=len(counts))

    def encode_flat(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts raw[offsets[k]:offsets[k + 1]] (UTF-8), special tokens' strings taken as text; n + 1 offsets."""
        if len(self.known) > CACHE:
            self._reset()
        starts = word_starts(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(raw))
        numbers, new = self.known.of(raw, starts, ends)
        if len(new):
            size = ends[new] - starts[new]
            self.word_ids.add(*self.merge_words(raw[ranges(starts[new], size)], size))
        ids, sizes = self.word_ids.take(numbers)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a string column (null: empty), and n + 1 offsets; strings of special tokens become those tokens."""
        hits = None
        for token in self.special:
            found = pc.fill_null(pc.match_substring(column, token), False)
            hits = found if hits is None else pc.or_(hits, found)
        if hits is None or not pc.any(hits).as_py():
            return self.encode_flat(*utf8(column))
        parts: list[str] = []
        slots: list[int] = []  # of each part, the special id, or -1
        owner: list[int] = []
        for k, text in enumerate(column.to_pylist()):
            for j, part in enumerate(self.special_split.split(text or "")):
                parts.append("" if j % 2 else part)
                slots.append(self.special[part] if j % 2 else -1)
                owner.append(k)
        ids, ends = self.encode_flat(*utf8(pa.array(parts, pa.string())))
        slot = np.array(slots, np.int64)
        places = np.repeat(ends[:-1][slot >= 0], 1)
        ids = np.insert(ids, places, slot[slot >= 0])
        sizes = np.diff(ends) + (slot >= 0)
        per_text = np.bincount(np.array(owner), weights=sizes, minlength=len(column)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_column(pa.array(texts, pa.string()))

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for, one after another."""
        starts = self.byte_starts[ids]
        return self.byte_data[ranges(starts, self.byte_starts[ids + 1] - starts)]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, np.int64)).tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Bpe:
    """One codec for each worker process and vocabulary file."""
    return Bpe(path)


def encode_column(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text (null: empty) as id, ids array<int>; repeated rows give repeated results."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in text_slices(batches):
            ids, offsets = bpe.encode_column(b.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("id"), lists], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_column(encoded: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of arrays of token ids (null: empty), special tokens included, as id, text."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for b in batches:
            texts = [bpe.decode(np.array(i or [], np.int64)) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Encodes and decodes every whole text; doc_id, n_tokens and the digests of ids and decoded text.

    A null text counts as empty (no tokens); ids and texts stay inside the task that made them.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        names = np.array([str(i) for i in range(bpe.size)], object)
        for b in text_slices(batches):
            ids, offsets = bpe.encode_column(b.column("text"))
            shown = names[ids].tolist()
            raw = bpe.decode_bytes(ids)
            lengths = bpe.byte_starts[ids + 1] - bpe.byte_starts[ids]
            byte_at = np.concatenate([[0], np.cumsum(lengths)])[offsets]
            of_ids, of_text = [], []
            for k in range(b.num_rows):
                of_ids.append(hashlib.sha256(",".join(shown[offsets[k] : offsets[k + 1]]).encode()).hexdigest())
                text = raw[byte_at[k] : byte_at[k + 1]].tobytes().decode("utf-8", "replace")
                of_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))

