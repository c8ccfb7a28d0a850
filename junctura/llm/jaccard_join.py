"""Exact self-join of documents on the Jaccard similarity of word shingles, by T-occurrence search.

Two sets of sizes a and b are as similar as asked only if they share T of their shingles, T >= share * max(a, b).  DivideSkip puts
a query's longest inverted lists aside, merges the short ones, and probes the long lists by binary search for what the merge left
over.  The same idea cuts the work at every level here:

1. Equal sets are one node, whatever their number; lists hold nodes.
2. The length of every inverted list is counted first (packed keys, a bucket of shingles at a time).  Of each node's lists all but the
   T-1 longest must hold any partner, and among those the lists of length 1 hold none.  A node whose short lists all have
   length 1 has no partner, and goes no further.
3. The nodes left are gathered by shared short lists into candidate classes, and those into blocks of bounded size.  In a block
   each node is a query against the block's inverted lists: merge, then probe.
4. A class larger than a block is searched list by list: a query goes only where a node holds one of its short lists, and a long list is
   dealt over several blocks.

:func:`similar_links` returns every linked pair of different sets.  :func:`similar_components` needs only components: a query skips nodes known to
be of its own, and a class larger than a block is first dealt over blocks that also hold the class's pivot, which ties large groups of
near copies together in one step; what is then still outside the class's largest component is searched list by list.

Shingles are compared by 128-bit keys (:mod:`shingles`); the 40-bit keys that list lengths are counted by only ever add candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks, packing, shingles
from .components import components
from .store import Scratch

_SHORT = np.uint64(24)
_SLICE = 2 << 20
_SALTS = 16


def needed(n: int | np.ndarray, percent: int):
    """Shingles that a set of ``n`` shares with any partner, at least."""
    return -(-n * percent // 100)


def _signatures(ident: str, text: str, width: int):
    def sign(batches):
        for batch in batches:
            size = np.cumsum([len(x) if x is not None else 0 for x in batch[text].cast(pa.binary()).to_pylist()])
            cuts = [0, *np.searchsorted(size, np.arange(_SLICE, size[-1] if len(size) else 0, _SLICE)).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    part = pa.table(batch.slice(a, b - a).to_pydict(), schema=batch.schema)
                    yield from _sign(part, ident, text, width).to_batches()

    return sign


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    values = [(x or "").encode() for x in column.to_pylist()]
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum([len(x) for x in values], dtype=np.int64)


def _sign(part: pa.Table, ident: str, text: str, width: int) -> pa.Table:
    data, end = _flat(part[text])
    sets = list(shingles.shingle_sets(data, end, width))
    return pa.table({"id": part[ident].cast(pa.int64()), chunks.KEY: part[chunks.KEY], "n": pa.array([s.shape[1] for s in sets], pa.int64()), "sig": chunks.binary([shingles.signature(s) for s in sets])})


def _nodes(docs: pa.Table, chosen: set[bytes], ident: str, text: str, width: int):
    """The sets of this chunk that stand for their node."""
    chunk = chunks.load(docs, ident, text)
    for s in shingles.shingle_sets(chunk.data, chunk.end, width):
        sig = shingles.signature(s)
        if sig in chosen:
            chosen.discard(sig)
            yield sig, s


def _send_lists(ident: str, text: str, width: int, bits: int):
    def send(key: tuple, docs: pa.Table, side: pa.Table) -> pa.Table:
        sets = [s for _, s in _nodes(docs, set(side["sig"].to_pylist()), ident, text, width)]
        out: list[tuple] = []
        if sets:
            keys, times = np.unique(np.concatenate([s[0] for s in sets]) >> _SHORT, return_counts=True)
            cuts = np.concatenate([[0], np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(40 - bits)), [len(keys)]])
            out = [(b, key[0].as_py(), packing.pack_sorted(keys[cuts[b] : cuts[b + 1]]), packing.pack_ints(times[cuts[b] : cuts[b + 1]])) for b in np.flatnonzero(np.diff(cuts))]
        b, k, packed, times = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"bucket": pa.array(b, pa.int32()), chunks.KEY: pa.array(k, pa.int32()), "keys": chunks.binary(list(packed)), "times": chunks.binary(list(times))})

    return send


def _lengths(key: tuple, table: pa.Table) -> pa.Table:
    """The length of each inverted list of a bucket, for each chunk that has it; 255 stands for more."""
    parts = [packing.unpack_sorted(x) for x in table["keys"].to_pylist()]
    times = np.concatenate([packing.unpack_ints(x) for x in table["times"].to_pylist()]).astype(np.int64)
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    s = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    length = np.empty(len(keys), np.int64)
    length[order] = np.repeat(np.minimum(np.add.reduceat(times[order], begin), 255), np.diff(np.append(begin, len(s))))
    ends = np.cumsum([len(x) for x in parts])
    packed = [packing.pack_ints(length[e - len(x) : e]) for x, e in zip(parts, ends, strict=True)]
    return pa.table({chunks.KEY: table[chunks.KEY], "bucket": table["bucket"], "lengths": chunks.binary(packed)})


def _send_queries(ident: str, text: str, width: int, percent: int):
    def send(key: tuple, docs: pa.Table, side: pa.Table) -> pa.Table:
        chosen = {x for x in side["sig"].to_pylist() if x is not None}
        lengths = sorted((b, x) for b, x in zip(side["bucket"].to_pylist(), side["lengths"].to_pylist(), strict=True) if x is not None)
        nodes = list(_nodes(docs, chosen, ident, text, width))
        out: list[tuple] = []
        if nodes:
            _, inverse = np.unique(np.concatenate([s[0] for _, s in nodes]) >> _SHORT, return_inverse=True)
            length = np.concatenate([packing.unpack_ints(x) for _, x in lengths])[inverse].astype(np.int64)
            at = 0
            for sig, s in nodes:
                n = s.shape[1]
                own = length[at : at + n]
                at += n
                short, alone = n - needed(n, percent) + 1, int(np.count_nonzero(own == 1))
                if alone < short:
                    order = np.lexsort((s[0], own))
                    out.append((sig, n, s.tobytes(), s[0][order[alone:short]].view(np.int64)))
        sig, n, sets, lists = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"sig": chunks.binary(list(sig)), "n": pa.array(n, pa.int64()), "shingles": chunks.binary(list(sets)), "lists": pa.array(list(lists), pa.list_(pa.int64()))})

    return send


class _Forest:
    """Components of a block's nodes."""

    def __init__(self, start: np.ndarray):
        self.root = start.copy()

    def join(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[i]))
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]


def _tokens(sets: list[np.ndarray]) -> np.ndarray:
    """A number for each key of the sets, one set after another; equal keys have equal numbers."""
    keys = np.concatenate([np.atleast_2d(s) for s in sets], axis=1)
    _, first, token = np.unique(keys[0], return_index=True, return_inverse=True)
    if (keys[-1][first][token] != keys[-1]).any():  # two keys share their first half
        order = np.lexsort(keys)
        new = (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)
        token[order] = np.concatenate([[0], np.cumsum(new)])
    return token


def t_occurrence(sets: list[np.ndarray], queries: np.ndarray, known: np.ndarray, percent: int, every: bool = False, mu: float = 0.0085) -> list[tuple[int, int, int]]:
    """Links from queries to any: pairs of places in ``sets`` (keys in one or two rows) and the number of keys they share.

    ``known`` has the components known before, and only links that join two of them are returned, unless ``every`` link is asked for.
    """
    m = len(sets)
    n = np.array([np.atleast_2d(s).shape[1] for s in sets], np.int64)
    off = np.concatenate([[0], np.cumsum(n)])
    token = _tokens(sets)
    posting = np.argsort(token, kind="stable")
    owner = np.repeat(np.arange(m), n)[posting]
    bound = np.concatenate([[0], np.cumsum(np.bincount(token))])
    entry = token[posting].astype(np.int64) * m + owner  # sorted: lists, and nodes in each
    forest, links = _Forest(np.arange(m) if every else known), []
    for x in queries.tolist():
        if not every and (forest.root == forest.root[x]).all():
            continue
        lists = token[off[x] : off[x + 1]]
        size = bound[lists + 1] - bound[lists]
        need = int(needed(n[x], percent))
        skip = min(need - 1, int(need / (mu * np.log2(max(2, size.max())) + 1)))
        by = np.argsort(size, kind="stable")
        short, long = lists[by[: len(lists) - skip]], lists[by[len(lists) - skip :]]
        count = bound[short + 1] - bound[short]
        run = np.repeat(bound[short] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        merged = np.sort(owner[run], kind="stable")
        if not len(merged):
            continue
        begin = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        node, times = merged[begin], np.diff(np.append(begin, len(merged)))
        fit = (times >= need - skip) & (forest.root[node] != forest.root[x])
        fit &= (n[node] >= need) & (n[x] >= needed(n[node], percent))
        node, times = node[fit], times[fit]
        for part in np.array_split(np.arange(len(node)), max(1, len(node) * max(1, len(long)) // 2_000_000)):
            if len(long) and len(part):
                probe = long.astype(np.int64)[:, None] * m + node[part][None, :]
                at = np.searchsorted(entry, probe)
                times[part] += (entry[np.minimum(at, len(entry) - 1)] == probe).sum(axis=0)
        linked = 100 * times >= percent * (n[x] + n[node] - times)
        node, times = node[linked], times[linked]
        if not every:
            _, one = np.unique(forest.root[node], return_index=True)  # one link to each component
            if len(node):
                forest.join(x, node)
            node, times = node[one], times[one]
        links += [(x, int(y), int(t)) for y, t in zip(node, times, strict=True)]
    return links


_LINKS = "u binary, v binary, shared long"


def _search(percent: int, every: bool = False):
    def search(key: tuple, block: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in block["shingles"].to_pylist()]
        known = block["known"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        ask = np.flatnonzero(block["ask"].to_numpy(zero_copy_only=False))
        links = t_occurrence(sets, ask, known, percent, every)
        sig = block["sig"].to_pylist()
        if every:
            links = {(a, b, t) if sig[a] < sig[b] else (b, a, t) for a, b, t in links}
        return pa.table({"u": chunks.binary([sig[a] for a, _, _ in links]), "v": chunks.binary([sig[b] for _, b, _ in links]), "shared": pa.array([t for *_, t in links], pa.int64())})

    return search


def _blocks(alive: DataFrame, classes: DataFrame, block_shingles: int) -> DataFrame:
    """Nodes with their class's number of blocks; classes that fit into one share blocks of their own."""
    held = classes.join(alive.select("sig", "n"), "sig")
    sizes = held.groupBy("cls").agg(F.sum("n").alias("weight"), F.count("*").alias("nodes"), F.min("sig").alias("pivot"))
    small = sizes.where(F.col("weight") <= block_shingles).agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    buckets = max(1, -(-int(small) * 2 // block_shingles))
    fits = F.col("weight") <= block_shingles
    sizes = sizes.select(
        "cls",
        "pivot",
        F.when(fits, 1).otherwise(F.ceil(F.col("weight") / block_shingles)).cast("int").alias("parts"),
        F.when(fits, F.pmod(F.xxhash64("cls"), F.lit(buckets))).otherwise(F.lit(-1)).cast("int").alias("bucket"),
    )
    return _with_label(classes, sizes, "cls").withColumn("part", F.pmod(F.xxhash64("sig", F.lit(1)), F.col("parts")).cast("int"))


def _with_label(rows: DataFrame, labels: DataFrame, on: str, how: str = "inner", by: str = "sig") -> DataFrame:
    """``rows`` with the columns of ``labels``, whose keys ``on`` are distinct; a key of very many rows is dealt over salts."""
    salted = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(by, F.lit(3)), F.lit(_SALTS)).cast("int")).join(salted, [on, "salt"], how).drop("salt")


def _list_blocks(asks: DataFrame, told: DataFrame, alive: DataFrame, scratch: Scratch, block_shingles: int, asks_a_block: int = 1000) -> DataFrame:
    """Blocks for the nodes ``asks`` (sig, known) against ``told``, of which they are part: one for each short list that a node of ``asks`` holds.

    Lists that fit share blocks; a long list's nodes are dealt over parts and its queries over turns, each part with each turn.
    """
    lists = alive.select("sig", "n", F.explode("lists").alias("list"))
    asked = lists.join(asks, "sig").select("list", "sig", "known", "n", F.lit(True).alias("ask"))
    named = scratch.write(asked.groupBy("list").agg(F.count("*").alias("asks")), "asked")
    others = _with_label(lists.join(told, "sig").select("list", "sig", "known", "n", F.lit(False).alias("ask")), named, "list").drop("asks")
    entries = scratch.write(others.unionByName(asked).groupBy("list", "sig", "known", "n").agg(F.max("ask").alias("ask")), "entries")
    sizes = entries.groupBy("list").agg(F.sum("n").alias("weight"), F.count_if("ask").alias("asks"), F.count("*").alias("nodes")).where("nodes > 1")
    fits = (F.col("weight") <= block_shingles) & (F.col("asks") <= asks_a_block)
    small = sizes.where(fits).agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    buckets = max(1, -(-int(small) * 2 // block_shingles))
    sizes = sizes.select(
        "list",
        F.when(fits, 1).otherwise(F.ceil(F.col("weight") / block_shingles)).cast("int").alias("parts"),
        F.when(fits, 1).otherwise(F.ceil(F.col("asks") / asks_a_block)).cast("int").alias("turns"),
        F.when(fits, F.pmod(F.xxhash64("list"), F.lit(buckets))).otherwise(F.lit(-1)).cast("int").alias("bucket"),
    )
    d = _with_label(entries, scratch.write(sizes, "listed"), "list").withColumn("list", F.when(F.col("bucket") < 0, F.col("list")))
    own = lambda n, of: F.pmod(F.xxhash64("sig", F.lit(n)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    cols = ["sig", "known", "list", "bucket", "part", "turn", "ask"]
    told = d.withColumn("part", own(1, "parts")).withColumn("turn", every("turns")).withColumn("ask", F.lit(False)).select(*cols)
    asks = d.where("ask").withColumn("turn", own(2, "turns")).withColumn("part", every("parts")).select(*cols)
    once = told.where("bucket < 0").unionByName(asks.where("bucket < 0"))
    once = once.unionByName(d.where("bucket >= 0").withColumns({"part": F.lit(0), "turn": F.lit(0)}).select(*cols))
    return once.groupBy(*(c for c in cols if c != "ask")).agg(F.max("ask").alias("ask")).join(alive.select("sig", "shingles"), "sig")


@dataclass
class _Found:
    """What both operators start from: every row's set, the nodes, those with candidates, and their blocks."""

    scratch: Scratch
    signed: DataFrame
    nodes: DataFrame
    alive: DataFrame
    placed: DataFrame


def _gather(docs: DataFrame, ident: str, text: str, width: int, percent: int, chunk_bytes: int, bucket_keys: int, block_shingles: int) -> _Found:
    scratch = Scratch(docs.sparkSession, "jaccard")
    total = chunks.total_bytes(docs, text)
    keyed = chunks.with_key(docs.select(ident, text), ident, text, chunks.count(total, chunk_bytes))
    signed = scratch.write(keyed.mapInArrow(_signatures(ident, text, width), f"id long, {chunks.KEY} int, n long, sig binary"), "signed")
    nodes = scratch.write(signed.where("n > 0").groupBy("sig").agg(F.min(chunks.KEY).alias(chunks.KEY), F.min("id").alias("id"), F.count("*").alias("many")), "nodes")
    bits = max(0, int(np.ceil(np.log2(max(1, total / 6 / bucket_keys)))))
    sent = keyed.groupBy(chunks.KEY).cogroup(nodes.select(chunks.KEY, "sig").groupBy(chunks.KEY)).applyInArrow(_send_lists(ident, text, width, bits), f"bucket int, {chunks.KEY} int, keys binary, times binary")
    lengths = scratch.write(sent.groupBy("bucket").applyInArrow(_lengths, f"{chunks.KEY} int, bucket int, lengths binary"), "lengths")
    side = nodes.select(chunks.KEY, "sig").unionByName(lengths, allowMissingColumns=True)
    asked = keyed.groupBy(chunks.KEY).cogroup(side.groupBy(chunks.KEY)).applyInArrow(_send_queries(ident, text, width, percent), "sig binary, n long, shingles binary, lists array<long>")
    alive = scratch.write(asked, "alive")
    scratch.drop("lengths")

    entries = alive.select("sig", F.explode("lists").alias("list"))
    hubs = entries.groupBy("list").agg(F.min("sig").alias("hub"), F.count("*").alias("many")).where("many > 1").drop("many")
    edges = _with_label(entries, hubs, "list").select(F.col("sig").alias("u"), F.col("hub").alias("v"))
    classes = components(edges, scratch, "class").select(F.col("node").alias("sig"), F.col("component").alias("cls"))
    return _Found(scratch, signed, nodes, alive, scratch.write(_blocks(alive, classes, block_shingles), "placed"))


def _own_blocks(found: _Found, rows: DataFrame) -> DataFrame:
    """Nodes by class, bucket and part, with their shingles; each is a component of its own and asks."""
    block = F.when(F.col("bucket") < 0, F.col("cls"))
    return rows.distinct().join(found.alive.select("sig", "shingles"), "sig").select("sig", "shingles", F.col("sig").alias("known"), F.lit(True).alias("ask"), block.alias("block"), "bucket", "part")


def similar_components(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, chunk_bytes: int = 4 << 20, bucket_keys: int = 1_500_000, block_shingles: int = 1_000_000) -> DataFrame:
    """Link documents of which 100 * |intersection| >= percent * |union|, and return each row's component.

    Returns one row for each row of ``docs``: ``id``, ``n`` (distinct shingles) and ``component`` (smallest id reachable by links).
    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text shorter than ``width`` words is one shingle; a null, empty or wordless
    text has none and links with nothing.  Rows with equal sets are linked; a null id is never the smallest; an id that occurs twice
    stands for two documents.  Other columns are not read.  ``ident`` must be an integer column, and the input must give the same
    rows when a task is run again, as a table does.
    """
    found = _gather(docs, ident, text, width, percent, chunk_bytes, bucket_keys, block_shingles)
    scratch, placed = found.scratch, found.placed
    own = placed.select("sig", "cls", "bucket", "part")
    pivots = placed.where("parts > 1 and sig = pivot").select("sig", "cls", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    first = _own_blocks(found, own.unionByName(pivots))
    links = scratch.write(first.groupBy("block", "bucket", "part").applyInArrow(_search(percent), _LINKS), "links")
    tied = components(links, scratch, "found")

    # classes of several blocks: what is outside the largest component asks wherever it shares a short list
    large = placed.where("parts > 1")
    if not large.isEmpty():
        large = large.join(tied.withColumnRenamed("node", "sig"), "sig", "left").withColumn("known", F.coalesce("component", "sig")).select("sig", "cls", "known")
        large = scratch.write(large, "large")
        by = large.groupBy("cls", "known").agg(F.count("*").alias("nodes"))
        main = by.groupBy("cls").agg(F.max(F.struct("nodes", "known")).alias("top")).select("cls", F.col("top.known").alias("main"))
        rest = scratch.write(_with_label(large, main, "cls").where("known <> main").select("sig", "known"), "rest")
        if not rest.isEmpty():
            second = _list_blocks(rest, large.select("sig", "known"), found.alive, scratch, block_shingles)
            more = scratch.write(second.groupBy("list", "bucket", "part", "turn").applyInArrow(_search(percent), _LINKS), "more")
            tied = components(links.unionByName(more), scratch, "all")

    # the smallest id of each component and of each set that several rows have; the others are alone
    tied = tied.join(found.nodes.select(F.col("sig").alias("node"), "id"), "node")
    least = tied.groupBy("component").agg(F.min("id").alias("least"))
    label = _with_label(tied.select(F.col("node").alias("sig"), "component"), least, "component").select("sig", "least", F.lit(True).alias("labelled"))
    alone = found.nodes.where("many > 1").join(tied.select(F.col("node").alias("sig")), "sig", "left_anti").select("sig", F.col("id").alias("least"), F.lit(True).alias("labelled"))
    label = scratch.write(label.unionByName(alone), "label")  # its keys are distinct, and far fewer than the rows
    out = _with_label(found.signed.select("id", "n", "sig"), label, "sig", "left", "id")
    return out.select("id", "n", F.when((F.col("n") > 0) & F.col("labelled"), F.col("least")).otherwise(F.col("id")).alias("component"))


def similar_links(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, chunk_bytes: int = 4 << 20, bucket_keys: int = 1_500_000, block_shingles: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """The join itself: every linked pair of different sets, and every row's set.

    Returns ``pairs`` (u, v: sets, u < v; shared: common shingles; u_id, v_id: their smallest row ids) and ``members``, one row for each row of ``docs``:
    ``id``, ``n`` (distinct shingles), ``cls`` (its set, null without words) and ``links`` (other rows linked with it: those of its own set and of
    linked sets).  Copies are not expanded into pairs.  Rows and texts are read as by :func:`similar_components`; the work grows with the number of links.
    """
    found = _gather(docs, ident, text, width, percent, chunk_bytes, bucket_keys, block_shingles)
    small = _own_blocks(found, found.placed.where("parts = 1").select("sig", "cls", "bucket", "part"))
    links = small.groupBy("block", "bucket", "part").applyInArrow(_search(percent, True), _LINKS)
    nodes = found.scratch.write(found.placed.where("parts > 1").select("sig", F.col("sig").alias("known")), "large")
    second = _list_blocks(nodes, nodes, found.alive, found.scratch, block_shingles)
    links = links.unionByName(second.groupBy("list", "bucket", "part", "turn").applyInArrow(_search(percent, True), _LINKS))
    links = found.scratch.write(links.distinct(), "links")
    held = found.nodes.join(found.alive.select("sig"), "sig", "left_semi")
    side = lambda x: held.select(F.col("sig").alias(x), F.col("id").alias(f"{x}_id"), F.col("many").alias(f"{x}_many"))
    both = found.scratch.write(_with_label(_with_label(links, side("u"), "u", by="v"), side("v"), "v", by="u"), "both")
    ends = both.select(F.col("u").alias("sig"), F.col("v_many").alias("many")).unionByName(both.select(F.col("v").alias("sig"), F.col("u_many").alias("many")))
    counts = ends.groupBy("sig").agg(F.sum("many").alias("others"))
    total = found.nodes.join(counts, "sig", "left").select("sig", (F.col("many") - 1 + F.coalesce("others", F.lit(0))).alias("links")).where("links > 0")
    members = _with_label(found.signed.select("id", "n", "sig"), found.scratch.write(total, "totals"), "sig", "left", "id")
    members = members.select("id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("cls"), F.when(F.col("n") > 0, F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("links"))
    return both.select("u", "v", "shared", "u_id", "v_id"), members
