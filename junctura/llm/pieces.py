"""SentencePiece encoding and decoding through a distinct-chunk table.

Where no piece of the model holds a whitespace marker after another character, the text falls apart at the markers, and the marked word
between two of them is segmented alike wherever it stands.  So every distinct marked word of the corpus is segmented once:

1. a task cuts its documents into blocks of some MB and sends each block's distinct marked words to buckets by hash;
2. a bucket segments each of its words once, with the library, and gives the ids back to the blocks that asked;
3. the blocks are cut once more, and send for each document the places of its words in the block's word list; there they meet the
   ids, are joined to them by position, and decoded.

Texts are never shuffled; what moves is packed.  A block is known by a digest of its texts.  A line feed is cut at too if, as usual, no piece but its byte holds one.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from . import chunks, packing
from .memory import give_back
from .slices import distinct_slices, take
from .store import Scratch

_WORD = re.compile(r" +[^ \n]*|\n[^ \n]*")
_END = b"\xff"  # in no UTF-8 text
_MARK = "▁"
#: Texts on which normalisers, markers and line feeds show whether a model takes words one by one.
_PROBES = ("a", " a ", "a  b", "\na", "a\n\nb", "a\n b", "x\ty\r\nz", "▁a▁b", "ﬁ Å ①", "\u3000a\xa0b\u200bc", "é e\u0301", "\x00 \x7f")
_models: dict[bytes, object] = {}


def _processor(proto: bytes):
    import sentencepiece

    key = hashlib.sha256(proto).digest()
    if key not in _models:
        _models[key] = sentencepiece.SentencePieceProcessor(model_proto=proto)
    return _models[key]


def check_model(proto: bytes) -> None:
    """Raise unless pieces keep within marked words."""
    sp = _processor(proto)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and (_MARK in piece.lstrip(_MARK) or "\n" in piece):
            raise ValueError(f"piece {piece!r} crosses a whitespace marker")
    if sp.encode("a  b") == sp.encode("a b") or not "".join(map(sp.id_to_piece, sp.encode("a"))).startswith(_MARK):
        raise ValueError("the model must add a marker in front and keep repeated spaces")
    for text in _PROBES:
        if segment(sp, marked_words(text))[0].tolist() != sp.encode(text):
            raise ValueError(f"the model does not take {text!r} word by word")


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each from its spaces or its line feed on; the front one has the marker that the model adds."""
    return _WORD.findall(" " + text.replace(_MARK, " ")) if text else []


def segment(sp, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of marked words, concatenated, and the number of each."""
    # the library puts a marker in front: it stands for the first space, and before a line feed it is a piece of its own
    ids = sp.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
    # a word of one space is encoded as nothing
    ids = [x[1:] if w[0] != " " else x if w != " " else [sp.piece_to_id(_MARK)] for w, x in zip(words, ids, strict=True)]
    return np.fromiter((i for x in ids for i in x), np.int64), np.array([len(x) for x in ids], np.int64)


def _cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts with the marker in front, the starts of the marked words in them, and each text's number of words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    full = pc.greater(pc.binary_length(texts), 0)
    marked = pc.if_else(full, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pc.replace_substring(texts, _MARK, " "), pa.scalar(" ", pa.large_string())), texts)
    marked = marked.combine_chunks() if isinstance(marked, pa.ChunkedArray) else marked
    offsets = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + len(marked) + 1]
    data = np.frombuffer(marked.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(marked) and offsets[-1] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    space = data == 0x20
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin |= data == 0x0A
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begin)
    return data, starts, np.diff(np.searchsorted(starts, offsets))


def _block(idents: pa.Array, texts: pa.Array, buckets: int):
    """A block's name, its words and their places by bucket, each document's number of words, and each word's place."""
    give_back()
    data, starts, counts = _cut(texts)
    words, places = distinct_slices(data, starts, np.append(starts[1:], len(data)))
    by: dict[int, list[tuple[bytes, int]]] = {}
    for i, w in enumerate(words):
        by.setdefault(zlib.crc32(w) % buckets, []).append((w, i))
    name = hashlib.blake2b(counts.tobytes() + data.tobytes(), digest_size=16).digest()
    return name, {b: sorted(by[b]) for b in sorted(by)}, counts, places


def _words(idents: pa.Array, texts: pa.Array, buckets: int) -> pa.RecordBatch:
    name, by, _, _ = _block(idents, texts, buckets)
    packed = [zstandard.compress(_END.join(w for w, _ in v), 6) for v in by.values()]
    return pa.RecordBatch.from_pydict({"block": chunks.binary([name] * len(by)), "bucket": pa.array(list(by), pa.int32()), "words": chunks.binary(packed)})


def _places(idents: pa.Array, texts: pa.Array, buckets: int) -> pa.RecordBatch:
    name, by, counts, places = _block(idents, texts, buckets)
    ids = pc.fill_null(idents.cast(pa.int64()), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = {
        "block": name,
        "idents": zstandard.compress(ids.tobytes(), 3),
        "unnamed": packing.pack_flags(pc.is_null(idents).to_numpy(zero_copy_only=False)),
        "counts": packing.pack_ints(counts),
        "order": packing.pack_ints(np.array([i for v in by.values() for _, i in v], np.int64)),
        "places": packing.pack_ints(places),
    }
    return pa.RecordBatch.from_pydict({k: chunks.binary([v]) for k, v in row.items()})


def _send(made, ident: str, text: str, buckets: int, block_bytes: int):
    """Cut documents into blocks, in their order and whatever the batches, and yield ``made`` of each."""

    def block(held):
        t = pa.Table.from_batches(held).combine_chunks()
        return made(t[ident].combine_chunks(), t[text].combine_chunks(), buckets)

    def send(batches):
        held, size = [], 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at, before = 0, 0
            while at < batch.num_rows:
                to = min(batch.num_rows, int(np.searchsorted(sizes, before + block_bytes - size)) + 1)
                held.append(batch.slice(at, to - at))
                size, at, before = size + int(sizes[to - 1]) - before, to, int(sizes[to - 1])
                if size >= block_bytes:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    return send


def _segment(proto: bytes):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        asked = [zstandard.decompress(x).split(_END) for x in table["words"].to_pylist()]
        place: dict[bytes, int] = {}
        for words in asked:
            for w in words:
                place.setdefault(w, len(place))
        distinct, flat, counts = list(place), [], []
        for a in range(0, len(distinct), 20_000):
            ids, count = segment(_processor(proto), [w.decode() for w in distinct[a : a + 20_000]])
            flat.append(ids.astype(np.int32))
            counts.append(count)
        ids, count = np.concatenate(flat), np.concatenate(counts)
        begin = np.cumsum(count) - count
        out_ids, out_counts = [], []
        for words in asked:
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            out_ids.append(packing.pack_ints(take(ids, begin[at], count[at])))
            out_counts.append(packing.pack_ints(count[at]))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "ids": chunks.binary(out_ids), "counts": chunks.binary(out_counts)})

    return run


def _piece_bytes(sp) -> tuple[np.ndarray, np.ndarray]:
    """What each id stands for in a decoded text: bytes, concatenated, and their number."""
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_unknown(i):
            out.append(sp.decode([i]).encode())  # the model's own sign for it
        else:
            out.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else piece.replace(_MARK, " ").encode())
    return np.frombuffer(b"".join(out), np.uint8), np.array([len(x) for x in out], np.int64)


def _join(ident: str, proto: bytes):
    def join(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        got = {b: (x, n) for b, x, n in zip(answers["bucket"].to_pylist(), answers["ids"].to_pylist(), answers["counts"].to_pylist(), strict=True)}
        return pa.concat_tables([_joined(_processor(proto), row, [got[b] for b in sorted(got)], ident) for row in docs.to_pylist()])

    return join


def _joined(sp, row: dict, got: list[tuple[bytes, bytes]], ident: str) -> pa.Table:
    """A block's documents: ids from its words' ids by place, and the texts that they decode to."""
    flat = np.concatenate([np.zeros(0, np.int64), *(packing.unpack_ints(x).astype(np.int64) for x, _ in got)])
    sizes = np.concatenate([np.zeros(0, np.int64), *(packing.unpack_ints(x).astype(np.int64) for _, x in got)])
    # back from the buckets' order to the block's
    order = packing.unpack_ints(row["order"]).astype(np.int64)
    if len(order) != len(sizes):
        raise RuntimeError("a block's words were not segmented: the input gave other rows when it was read again")
    begin, count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    begin[order], count[order] = np.cumsum(sizes) - sizes, sizes
    places = packing.unpack_ints(row["places"]).astype(np.int64)
    words = packing.unpack_ints(row["counts"]).astype(np.int64)
    ids = take(flat, begin[places], count[places])
    bounds = np.concatenate([[0], np.cumsum(count[places])])[np.concatenate([[0], np.cumsum(words)])]
    # the end id behind each document's ids
    n = np.diff(bounds)
    ends = np.concatenate([[0], np.cumsum(n + 1)])
    encoded = np.empty(ends[-1], np.int32)
    encoded[ends[1:] - 1] = sp.eos_id()
    inner = np.ones(len(encoded), bool)
    inner[ends[1:] - 1] = False
    encoded[inner] = ids
    stuff, width = _piece_bytes(sp)
    stuff_at = np.cumsum(width) - width
    text = np.concatenate([np.zeros(0, np.uint8), *(take(stuff, stuff_at[x], width[x]) for x in np.array_split(ids, 1 + len(ids) // 250_000))])
    at = np.concatenate([[0], np.cumsum(width[ids])])[bounds]
    # the library takes the marker in front away again
    front = at[:-1][np.diff(at) > 0]
    lengths = np.diff(at) - (np.diff(at) > 0)
    keep = np.ones(len(text), bool)
    keep[front] = False
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    decoded = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(text[keep]))
    idents = np.frombuffer(zstandard.decompress(row["idents"]), np.int64)
    named = pa.array(idents, pa.int64(), mask=packing.unpack_flags(row["unnamed"]))
    return pa.table({ident: named, "ids": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(encoded)), "decoded": decoded})


def encode_decode(docs: DataFrame, model: str, ident: str = "doc_id", text: str = "text", block_bytes: int = 8 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Encode whole texts with an end id, as the library does, and decode the ids.

    Returns one row for each row of ``docs``: ``ident`` (long), ``ids`` (array of int) and ``decoded`` (string); other columns are not read.  A null or
    empty text has the end id alone; a null id stays null; equal rows are encoded alike.  ``model`` is a model file's path on the driver; its bytes
    go to the tasks.  The input is read twice and must give the same rows, as a table does.
    """
    with open(model, "rb") as f:
        proto = f.read()
    check_model(proto)
    docs = docs.select(ident, text)
    buckets = chunks.count(chunks.total_bytes(docs, text), bucket_bytes)
    cut = lambda made: _send(made, ident, text, buckets, block_bytes)
    asked = docs.mapInArrow(cut(_words), "block binary, bucket int, words binary")
    table = Scratch(docs.sparkSession, "pieces").write(asked.groupBy("bucket").applyInArrow(_segment(proto), "block binary, bucket int, ids binary, counts binary"), "table")
    places = docs.mapInArrow(cut(_places), "block binary, idents binary, unnamed binary, counts binary, order binary, places binary")
    return places.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(_join(ident, proto), f"`{ident}` long, ids array<int>, decoded string")
