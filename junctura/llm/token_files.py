"""Token-id files: one concatenated id array with Elias-Fano coded document boundaries.

A file holds consecutive documents in ascending id order: a header, the documents' ids and the boundaries (both sorted sequences, Elias-Fano
coded with selection samples), then all token ids as 16- or 32-bit little-endian integers.  A range partition by document id is written by
one task, as one or more files of bounded size; a small index table orders the files, and running sums over it give each file's
place in the whole array.
"""

from __future__ import annotations

import json
import os
import struct
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import chunks
from .elias_fano import EliasFano
from .files import fresh, read
from .slices import distinct_slices, take
from .store import Scratch

_MAGIC = b"TIDS0001"
_HEAD = "<8sQqQQQB"  # magic, documents, smallest id, documents without id, bytes of each coded sequence, bytes of an id
#: White space as the tokenizer splits at it, ASCII and beyond; fixed values.
_SPACE = np.zeros(256, bool)
_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_WIDE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Signs that never join the letters in front of them; no apostrophe, since contractions begin with one.
_MARKS = ".,;:!?*%&#$"
_MARKED = np.zeros(256, bool)
_MARKED[list(_MARKS.encode())] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_CACHE = 700_000
FILE_IDS = 4 << 20
INDEX = "file string, first long, step long, part int, docs long, ids long"


def _letters(word: str) -> bool:
    """Letters alone, in lower case too."""
    return word.isalpha() and (word.isascii() or word.lower().isalpha())


class _Encoder:
    """Ids of whole texts.  Normaliser and splitter never look past white space, so each distinct token between spaces is encoded once.

    Where a token is letters with some of ``_MARKS`` behind, the splitter parts them too.  A vocabulary whose last piece of every word is marked lets many words of
    letters be encoded as one text and told apart again.
    """

    def __init__(self, spec: str, end: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model, self.end, self.known = Tokenizer.from_str(spec), end, {}
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.model.get_vocab_size(), bool)
        if suffix:
            self.last[[i for t, i in self.model.get_vocab().items() if t.endswith(suffix)]] = True

    def _learn(self, words: list[str], others: set[str]) -> None:
        """Encode words of letters alone, and others."""
        for a in range(0, len(words) if self.last.any() else 0, 500):
            own = words[a : a + 500]
            ids = np.array(self.model.encode(" ".join(own), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(own) and ends[-1] == len(ids):
                raw, at = ids.tobytes(), 0
                for w, e in zip(own, (4 * ends).tolist(), strict=True):
                    self.known[w] = raw[at:e]
                    at = e
        rest = [p for p in (*words, *others) if p not in self.known]
        for a in range(0, len(rest), 2000):  # the library's result objects are large
            for w, e in zip(rest[a : a + 2000], self.model.encode_batch_fast(rest[a : a + 2000], add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, "<u4").tobytes()

    def _ids(self, tokens: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        new = set(tokens).difference(known)
        words = {w for w in new if w.isascii() and w.isalpha()}
        parts, rest = {}, set()
        for w in new.difference(words):
            stem = w.rstrip(_MARKS)
            if not _letters(stem):
                rest.add(w)
                continue
            words.add(stem)
            if stem != w:
                parts[w] = (stem, w[len(stem) :])
                rest.add(w[len(stem) :])
        self._learn(list(words.difference(known)), rest.difference(known))
        known.update({w: known[a] + known[b] for w, (a, b) in parts.items()})
        return [known[w] for w in tokens]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number for each text; the tokens' places are found for a whole array at once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        wide = pc.match_substring_regex(texts, _WIDE)
        if pc.any(wide).as_py():
            texts = pc.if_else(wide, pc.replace_substring_regex(texts, _WIDE, " "), texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(texts) and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        # ASCII letters with marks behind are parted here; elsewhere words are looked at one by one
        stop = np.maximum.accumulate(np.where(_MARKED[data], -1, np.arange(len(data))))[ends - 1] + 1 if len(ends) else ends
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        cut = stop[(stop > starts) & (stop < ends) & (letters[np.maximum(stop, starts)] - letters[starts] == stop - starts)]
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        if b"<|" not in data.tobytes():  # special tokens are told apart by case
            data = _LOWER[data]
        tokens, place = distinct_slices(data, starts, ends)
        coded = self._ids([t.decode() for t in tokens])
        size = np.array([len(c) // 4 for c in coded], np.int64)
        flat = np.frombuffer(b"".join(coded), "<u4")
        ids = take(flat, (np.cumsum(size) - size)[place], size[place])
        bounds = np.concatenate([[0], np.cumsum(size[place])])[np.searchsorted(starts, offsets)]
        counts = np.diff(bounds)
        if self.end is None:
            return ids, counts
        ends = np.cumsum(counts + 1)
        out = np.empty(len(ids) + len(counts), "<u4")
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[ends - 1] = self.end
        out[inner] = ids
        return out, counts + 1


_encoders: dict[tuple[bytes, int | None], _Encoder] = {}


def _encoder(spec: str, end: int | None) -> _Encoder:
    """One encoder for all tasks of a worker, so that what it knows stays."""
    key = (hashlib.sha256(spec.encode()).digest(), end)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = _Encoder(spec, end)
    return _encoders[key]


def pack(doc_ids: np.ndarray, nulls: int, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes; ``doc_ids`` are sorted and follow ``nulls`` documents without id."""
    least = int(doc_ids[0]) if len(doc_ids) else 0
    named = EliasFano.encode((doc_ids.astype(np.uint64) - np.uint64(least & (2**64 - 1)))).tobytes()
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(counts)])).tobytes()
    wide = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    head = struct.pack(_HEAD, _MAGIC, len(counts), least, nulls, len(named), len(bounds), wide)
    return head + named + bounds + ids.astype(f"<u{wide}").tobytes()


class TokenFile:
    """A file's documents: ids, boundaries by selection, token ids."""

    def __init__(self, blob: bytes):
        magic, self.docs, self.least, self.nulls, a, b, wide = struct.unpack_from(_HEAD, blob)
        if magic != _MAGIC:
            raise ValueError("not a token-id file")
        at = struct.calcsize(_HEAD)
        self.named, _ = EliasFano.frombytes(blob[at : at + a])
        self.bounds, _ = EliasFano.frombytes(blob[at + a : at + a + b])
        self.ids = np.frombuffer(blob, f"<u{wide}", offset=at + a + b)

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        n = max(0, min(stop, self.nulls) - start)
        named = self.named.select(max(0, start - self.nulls), max(0, stop - self.nulls))
        return [None] * n + (named + np.uint64(self.least & (2**64 - 1))).astype(np.int64).tolist()

    def tokens(self, i: int) -> np.ndarray:
        """Token ids of the i-th document."""
        a, b = self.bounds.select(i, i + 2).tolist()
        return self.ids[a:b]


#: What the encoder relies on: steps that work on the white space between words and on single words, never on several words at once.
_NORMALISERS = {"NFC", "Lowercase"}


def check_spec(spec: str) -> None:
    """Refuse a tokenizer of which words between white space can't be encoded one by one.

    It must be byte-pair encoding without dropout; normalise by NFC, lower case and white space runs to one blank alone; and split by one pattern that never matches
    white space, then into bytes without a prefix blank; and have no post-processor.
    """
    d = json.loads(spec)
    steps = lambda x, key: [] if x is None else x[key] if x["type"] == "Sequence" else [x]
    wrong = []
    if d["model"]["type"] != "BPE" or d["model"].get("dropout") or d["model"].get("continuing_subword_prefix"):
        wrong.append("model")
    normalisers = steps(d.get("normalizer"), "normalizers")
    plain = [n for n in normalisers if not (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ")]
    if {n["type"] for n in plain} - _NORMALISERS or "Lowercase" not in {n["type"] for n in plain}:
        wrong.append("normalizer")
    splits = steps(d.get("pre_tokenizer"), "pretokenizers")
    if not splits or splits[0]["type"] != "Split" or splits[0]["behavior"] != "Removed" or not splits[0]["invert"] or any(s["type"] != "ByteLevel" or s["add_prefix_space"] or s.get("use_regex", True) for s in splits[1:]):
        wrong.append("pre_tokenizer")
    elif any(regex.search(splits[0]["pattern"].get("Regex", r"\s"), x) for x in (" ", "\t", "\n", "\x85", "\xa0", "\u2003", " \n ")) or any(any(c.isspace() for c in m) for m in regex.findall(splits[0]["pattern"]["Regex"], " a  b, 9 's . é ", overlapped=True) if isinstance(m, str)):
        wrong.append("pre_tokenizer's pattern")
    if d.get("post_processor") is not None:
        wrong.append("post_processor")
    if wrong:
        raise ValueError(f"words can't be encoded one by one with this {', '.join(wrong)}")


def _write(uri: str, spec: str, end: int | None, ident: str, text: str, file_ids: int, rows_a_turn: int):
    def write(batches):
        from pyspark import TaskContext

        encoder, part, step = _encoder(spec, end), TaskContext.get().partitionId(), 0
        docs, counts, ids, size = [], [], [], 0

        def close():
            nonlocal docs, counts, ids, size, step
            named = [x for x in docs if x is not None]
            system, path, name = fresh(uri, ".ids")
            with system.open_output_stream(path, compression=None) as f:
                f.write(pack(np.array(named, np.int64), len(docs) - len(named), np.concatenate(counts), np.concatenate(ids)))
            row = pa.RecordBatch.from_pydict({"file": [name], "first": pa.array([docs[0]], pa.int64()), "step": [step], "part": pa.array([part], pa.int32()), "docs": [len(docs)], "ids": [size]})
            docs, counts, ids, size, step = [], [], [], 0, step + 1
            return row

        for batch in batches:
            for a in range(0, batch.num_rows, rows_a_turn):
                own = batch.slice(a, rows_a_turn)
                x, n = encoder.encode(own[text])
                docs += own[ident].cast(pa.int64()).to_pylist()
                counts.append(n)
                ids.append(x)
                size += len(x)
                if size >= file_ids:
                    yield close()
        if docs:
            yield close()

    return write


def write_token_files(docs: DataFrame, tokenizer: str, end: int | None, ident: str = "doc_id", text: str = "text", part_bytes: int = 16 << 20, file_ids: int = FILE_IDS, rows_a_turn: int = 2000) -> DataFrame:
    """Encode whole texts and write them in ascending id order; returns the index table, one row for each file.

    A null or empty text has the end id alone (nothing if ``end`` is None).  Documents without id come first; those with equal ids stand together
    in the order of a hash of their texts, so that one id, or none, for many rows fills as many parts as it needs.  ``tokenizer`` is a tokenizers file on the driver; one that does not suit is refused (:func:`check_spec`).  A part ends a file once it has
    ``file_ids`` ids.  An empty table writes no file.  ``ident`` must be an integer column; other columns are not read.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    check_spec(spec)
    scratch = Scratch(docs.sparkSession, "tokens")
    docs = docs.select(ident, text)
    n = chunks.count(chunks.total_bytes(docs, text), part_bytes)
    order = [F.col(ident).asc_nulls_first(), F.xxhash64(text)]  # the driver sees a sample of these
    dealt = docs.repartitionByRange(n, *order).sortWithinPartitions(*order, text)
    return scratch.write(dealt.mapInArrow(_write(scratch.at("files"), spec, end, ident, text, file_ids, rows_a_turn), INDEX), "index")


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            f = TokenFile(read(row["file"]))
            for a in range(0, f.docs, 1000):
                b = min(a + 1000, f.docs)
                bounds = f.bounds.select(a, b + 1).astype(np.int64)
                ids = f.ids[bounds[0] : bounds[-1]].astype("<u4")
                offsets = pa.py_buffer((4 * (bounds - bounds[0])).astype(np.int32))
                coded = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, offsets, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(f.doc_ids(a, b), pa.int64()), "start": pa.array(bounds[:-1] + row["before"], pa.int64()), "n_tokens": pa.array(np.diff(bounds)), "ids": coded})


def read_token_files(index: DataFrame) -> DataFrame:
    """Documents of an index's files: doc_id, start (ids of all documents before), n_tokens, ids (binary: unsigned 32-bit little-endian integers)."""
    # running sums in two steps: over stretches of parts, and within each
    stretch = F.floor(F.col("part") / 256)
    ahead = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = index.groupBy(stretch.alias("stretch")).agg(F.sum("ids").alias("ids")).select("stretch", ahead(Window.orderBy("stretch")).alias("base"))
    files = index.withColumn("stretch", stretch).withColumn("within", ahead(Window.partitionBy("stretch").orderBy("part", "step")))
    files = files.join(sums, "stretch").withColumn("before", F.col("base") + F.col("within")).drop("stretch", "base", "within")
    n = max(1, index.count())
    return files.repartition(n, "file").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary")
