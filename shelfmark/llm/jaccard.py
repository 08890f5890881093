"""Exact Jaccard join of word-shingle sets by adaptive multi-match prefixes.

1. One pass over texts gives each document its set's size and key; equal sets are one node from here on.
2. A second pass gathers documents in batches and deals their shingles into buckets, packed as byte blocks. A shingle
   that several documents of a batch hold goes out once, with their number, so that no bucket gets more of one shingle
   than there are batches, however frequent it is. A bucket counts in how many documents each shingle occurs and tells
   the batches of those of two or more. A document whose shared shingles are fewer than the threshold times its size
   can link with nothing and leaves here; most do. Batches are numbered by task, so the input must come in the same
   order if a task runs again, as rows of files do.
3. Shingles are ordered by document frequency. A node's l-prefix is its first n - ceil(t n) + l shingles; two nodes
   that link share at least min(l) of them. Each node takes the l whose estimated cost, postings to read plus
   candidates to verify (at most the postings over l), is least: frequent prefixes grow longer and ask for more matches.
4. Two nodes that link also share a shingle of their 1-prefixes, the rarest ones. Nodes are tied by these alone, in
   stars around the shingle's least node, so a longer prefix ties nothing more. Components of the stars are verified
   as groups: candidates are pairs with min(l) shared l-prefix shingles and fitting sizes, their exact overlap is
   counted on whole sets. A group beyond a task's size is cut, whichever copies less, into blocks, one task a pair of
   blocks, or by the 1-prefix shingles that tie it, where a pair belongs to its least common one; a loose chain thus
   costs as much as its ties. A task gives back a spanning forest and each node's number of links, never pairs.
5. Components of the forests, with the least doc_id of each, come back to documents.

Results are exact but for collisions of hashes: 64 bits for equal sets, 40 bits and the bucket's number for shingles.
Shuffles have as many partitions as there are buckets, so tasks read some megabytes at any size of the corpus.

Defined cases: a null or empty text, or one without words, has an empty set, links with nothing and is its own
component; a text of fewer words than the width has one shingle, its whole sequence; equal texts are linked; rows
without an id count as documents and take part, but never name a component unless all its ids are null; repeated
rows are one node; an empty table gives an empty result; columns other than the two that are named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_group, arrow_task, small_batches, text_chunks, write_table
from .graph import connected_components
from .shingles import Shingler, set_key

#: Shingles a bucket should hold, and a task gathers before it packs blocks.
BUCKET_TOKENS = 1_000_000
BUFFER_TOKENS = 1_000_000
#: Buckets have numbers of 24 bits; beyond 16 million million shingles they grow.
MOST_BUCKETS = 1 << 24
#: Nodes and shingles of a block of a large group; cells of a dense matrix at a time.
BLOCK_NODES = 1000
BLOCK_TOKENS = 2_000_000
CELLS = 4_000_000
_LOW = np.uint64((1 << 40) - 1)
_32 = np.uint64(32)


def _bucket(tokens: np.ndarray, n: int) -> np.ndarray:
    return ((tokens >> _32) * np.uint64(n)) >> _32


def _identity(tokens: np.ndarray, n: int) -> np.ndarray:
    """What identifies a shingle from its bucket on: the bucket's number and 40 bits."""
    return (_bucket(tokens, n) << np.uint64(40)) | (tokens & _LOW)


def profile(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n and node (the set's key) of each document."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    @arrow_task("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                tokens, sizes = shingler.sets(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(sizes), pa.array(set_key(tokens, sizes).view(np.int64))], names=["doc_id", "n", "node"])

    return picked.mapInArrow(run, f"doc_id {kind}, n long, node long")


#: Kinds of byte blocks: shingles dealt to a bucket, a batch's documents, its lists of shingles that several of its
#: documents hold, counted shingles.
_DEALT, _DOCUMENTS, _LISTS, _COUNTED = range(4)
_Part = list[tuple[np.ndarray, str]]


def _pack(kind: int, label: int, one: _Part, two: _Part = ()) -> bytes:
    """A byte block: kind, label, rows of two tables, and their columns of fixed types, one after the other."""
    head = np.array([kind, label, len(one[0][0]), len(two[0][0]) if two else 0], "<i8").tobytes()
    return head + b"".join(np.ascontiguousarray(values, dtype).tobytes() for values, dtype in (*one, *two))


def _unpack(block: bytes, one: tuple[str, ...], two: tuple[str, ...] = ()) -> list[np.ndarray]:
    n, m = np.frombuffer(block, "<i8", 2, 16).tolist()
    out, at = [], 32
    for rows, types in ((n, one), (m, two)):
        for t in types:
            out.append(np.frombuffer(block, t, rows, at))
            at += rows * np.dtype(t).itemsize
    return out


def _head(block: bytes) -> tuple[int, int]:
    kind, label = np.frombuffer(block, "<i8", 2)
    return int(kind), int(label)


def _runs(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of runs of equal values."""
    start = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else np.zeros(0, np.int64)
    return start, np.diff(np.append(start, len(which)))


def _deal(docs: DataFrame, width: int, text_col: str, buckets: int) -> DataFrame:
    """Rows (key, block). Documents go in batches of about a million shingles with a number of their own; within a batch
    a document is two bytes. Keys below `buckets` are buckets of shingles; a batch's documents and lists go straight
    to the key of the batch, behind them."""

    @arrow_task("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        number = TaskContext.get().partitionId() << 24
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(number: int) -> pa.RecordBatch:
            tokens = np.concatenate([t for t, _ in held])
            sizes = np.concatenate([s for _, s in held])
            nodes = set_key(tokens, sizes)
            _, first = np.unique(nodes, return_index=True)
            fresh = np.zeros(len(nodes), bool)
            fresh[first] = True
            fresh &= sizes > 0
            own = np.repeat(fresh, sizes)
            tokens, nodes, sizes = tokens[own], nodes[fresh], sizes[fresh]
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
            order = np.argsort(tokens)
            tokens, doc = tokens[order], doc[order]
            start, count = _runs(tokens)
            one, several = start[count == 1], start[count > 1]
            often = count[count > 1]
            keys, blocks = [buckets + number], [_pack(_DOCUMENTS, number, [(nodes, "<u8"), (sizes, "<u4")])]
            if len(several):
                keys.append(buckets + number)
                listed = np.repeat(count > 1, count)
                blocks.append(_pack(_LISTS, number, [(_identity(tokens[several], buckets), "<u8"), (often, "<u4")], [(doc[listed], "<u2")]))
            low, high = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4"), ((tokens >> _32) & np.uint64(255)).astype(np.uint8)
            # A bucket's number grows with the shingle, so the sorted shingles lie bucket by bucket.
            bucket = _bucket(tokens, buckets).astype(np.int64)
            first, _ = _runs(bucket)
            cut_one, cut_several = (np.append(np.searchsorted(x, first), len(x)) for x in (one, several))
            for k, at in enumerate(first.tolist()):
                x, y = one[cut_one[k] : cut_one[k + 1]], several[cut_several[k] : cut_several[k + 1]]
                keys.append(int(bucket[at]))
                n = often[cut_several[k] : cut_several[k + 1]]
                blocks.append(_pack(_DEALT, number, [(low[x], "<u4"), (doc[x], "<u2"), (high[x], "u1")], [(low[y], "<u4"), (n, "<u2"), (high[y], "u1")]))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blocks, pa.binary())], names=["key", "block"])

        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                held.append(shingler.sets(data, offsets))
                if sum(len(t) for t, _ in held) > BUFFER_TOKENS or sum(len(s) for _, s in held) > 30_000:
                    yield flush(number)
                    held, number = [], number + 1
        if held:
            yield flush(number)

    # Chunks have 20,000 texts at most, so a batch stays below the 65,536 that two bytes tell apart.
    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "key long, block binary")


_BLOCKS = pa.schema([("key", pa.int64()), ("block", pa.binary())])


def _count_bucket(buckets: int):
    """Of one bucket: the shingles that two or more documents hold, in blocks by batch, with a frequency class."""

    @arrow_group("jaccard")
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= buckets:
            return table.select(["key", "block"]).cast(_BLOCKS)
        raw = [b.as_py() for b in table["block"]]
        got = [_unpack(b, ("<u4", "<u2", "u1"), ("<u4", "<u2", "u1")) for b in raw]
        parts = []  # of single documents, of several: low, documents or their number, high, rows of each block
        for k in (0, 3):
            parts.append([np.concatenate([g[k + i] for g in got]) for i in range(3)] + [np.array([len(g[k]) for g in got])])
        (low, doc, high, rows), (low2, often, high2, rows2) = parts
        tokens = np.concatenate([low, low2]).astype(np.uint64) | (np.concatenate([high, high2]).astype(np.uint64) << _32)
        weight = np.concatenate([np.ones(len(low), np.int64), often.astype(np.int64)])
        order = np.argsort(tokens)
        start, count = _runs(tokens[order])
        df = np.empty(len(tokens), np.int64)
        df[order] = np.repeat(np.add.reduceat(weight[order], start), count) if len(start) else 0
        grade = np.minimum(255, np.rint(8 * np.log2(np.maximum(df, 1)))).astype(np.uint8)
        common = np.flatnonzero(df[: len(low)] >= 2)
        cuts = np.searchsorted(common, np.append(0, np.cumsum(rows)))
        cuts2 = np.append(0, np.cumsum(rows2))
        grade2 = grade[len(low) :]
        keys, blocks = [], []
        for k, block in enumerate(raw):
            x, y = common[cuts[k] : cuts[k + 1]], slice(cuts2[k], cuts2[k + 1])
            if len(x) or cuts2[k + 1] > cuts2[k]:
                keys.append(buckets + _head(block)[1])
                blocks.append(_pack(_COUNTED, bucket, [(low[x], "<u4"), (doc[x], "<u2"), (high[x], "u1"), (grade[x], "u1")], [(low2[y], "<u4"), (high2[y], "u1"), (grade2[y], "u1")]))
        return pa.table([pa.array(keys, pa.int64()), pa.array(blocks, pa.binary())], schema=_BLOCKS)

    return run


def choose_matches(grades: np.ndarray, unique: int, n: int, need: int) -> int:
    """How many shared prefix shingles a node asks for: the least estimated cost of reading and verifying.

    grades: classes of its shared shingles in prefix order; unique: how many shingles it shares with nobody."""
    matches = np.arange(1, need + 1)
    length = n - need + matches - unique
    if length[0] <= 0:  # more shingles of its own than a link leaves room for
        return 1
    matches, length = matches[length <= len(grades)], length[length <= len(grades)]
    if not len(matches):
        return 1
    postings = np.cumsum(np.exp2(grades / 8) - 1)[length - 1]
    return int(matches[np.argmin(postings + postings / matches * n / 16)])


def _full(low: np.ndarray, high: np.ndarray, bucket: int) -> np.ndarray:
    return low.astype(np.uint64) | (high.astype(np.uint64) << _32) | np.uint64(bucket << 40)


def _gather_nodes(numerator: int, denominator: int):
    """Nodes that may link: node, n, matches, their shared shingles (sorted), their prefix and their 1-prefix."""

    @arrow_group("jaccard")
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, docs, classes, nodes, sizes = [], [], [], np.zeros(0, np.uint64), np.zeros(0, np.int64)
        told, told_grade = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
        listed, often, members = (np.zeros(0, t) for t in (np.uint64, np.int64, np.uint16))
        for block in table["block"]:
            block = block.as_py()
            kind, label = _head(block)
            if kind == _DOCUMENTS:
                nodes, sizes = _unpack(block, ("<u8", "<u4"))
            elif kind == _LISTS:
                listed, often, members = _unpack(block, ("<u8", "<u4"), ("<u2",))
            else:
                low, doc, high, grade, low2, high2, grade2 = _unpack(block, ("<u4", "<u2", "u1", "u1"), ("<u4", "u1", "u1"))
                ids.append(_full(low, high, label))
                docs.append(doc)
                classes.append(grade)
                told.append(_full(low2, high2, label))
                told_grade.append(grade2)
        if len(listed):
            known, grade = np.concatenate(told), np.concatenate(told_grade)
            order = np.argsort(known)
            ids.append(np.repeat(listed, often))
            docs.append(members)
            classes.append(np.repeat(grade[order][np.searchsorted(known[order], listed)], often))
        tokens, node, grades = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((ids, np.uint64), (docs, np.uint16), (classes, np.uint8)))
        # Only documents that share enough need an order.
        need_of = -(-numerator * sizes.astype(np.int64) // denominator)
        enough = np.bincount(node, minlength=len(sizes)) >= need_of if len(sizes) else np.zeros(0, bool)
        keep = enough[node] if len(node) else np.zeros(0, bool)
        tokens, node, grades = tokens[keep], node[keep], grades[keep]
        order = np.lexsort((tokens, grades, node))
        tokens, grades, node = tokens[order], grades[order], node[order]
        start, count = _runs(node)
        rows = []
        for a, c in zip(start, count):
            k = node[a]
            n, need = int(sizes[k]), int(need_of[k])
            own, grade = tokens[a : a + c], grades[a : a + c]
            unique = n - c
            m = choose_matches(grade.astype(np.float64), unique, n, need)
            least = n - need + 1 - unique
            rows.append((nodes[k], n, m, np.sort(own).tobytes(), own[: max(0, least + m - 1)].view(np.int64), np.sort(own[: max(0, least)].view(np.int64))))
        node_ids = np.array([r[0] for r in rows], np.uint64).view(np.int64)
        longs = pa.list_(pa.int64())
        columns = [pa.array(node_ids, pa.int64()), *[pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.binary()), (4, longs), (5, longs))]]
        return pa.table(columns, names=["node", "n", "matches", "tokens", "prefix", "lead"])

    return run


def _matrix(rows: list[np.ndarray], columns: list[np.ndarray] | None = None) -> np.ndarray:
    """Overlaps of sets with each other, or with the sets in columns, by products of dense slices."""
    both = rows + (columns or [])
    values, place = np.unique(np.concatenate(both), return_inverse=True)
    owner = np.repeat(np.arange(len(both)), [len(r) for r in both])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(rows), len(columns) if columns is not None else len(rows)), np.float32)
    step = max(1, CELLS // max(1, len(both)))
    for low in range(0, len(values), step):
        a, b = np.searchsorted(place, [low, low + step])
        dense = np.zeros((len(both), min(step, len(values) - low)), np.float32)
        dense[owner[a:b], place[a:b] - low] = 1
        out += dense[: len(rows)] @ (dense[len(rows) :].T if columns is not None else dense.T)
    return out


def verify(
    n: np.ndarray, matches: np.ndarray, prefixes: list[np.ndarray], sets: list[np.ndarray], side: np.ndarray, numerator: int, denominator: int, leads: list[np.ndarray] | None = None, token: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places) that link. side: 0 and 1 where only pairs across count, all 0 where all do. With leads, sorted
    1-prefixes that all hold token, only pairs of which it is the least common one."""
    two = bool(side.any())
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if two else left
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hits = _matrix([prefixes[i] for i in left], [prefixes[i] for i in right] if two else None)
    candidate = hits >= np.minimum(matches[left][:, None], matches[right][None, :])
    small, large = np.minimum(n[left][:, None], n[right][None, :]), np.maximum(n[left][:, None], n[right][None, :])
    candidate &= denominator * small >= numerator * large
    if not two:
        candidate = np.triu(candidate, 1)
    i, j = np.nonzero(candidate)
    if not len(i):
        return i, j
    a, b = left[i], right[j]
    if leads is not None:
        before = [x[: np.searchsorted(x, token)] for x in leads]
        mine = np.array([not len(before[x]) or not len(before[y]) or not _overlap(before[x], before[y]) for x, y in zip(a, b)])
        i, j, a, b = i[mine], j[mine], a[mine], b[mine]
    if len(i) <= 4 * (len(left) + len(right)):
        overlap = np.array([_overlap(sets[x], sets[y]) for x, y in zip(a, b)])
    else:
        overlap = np.rint(_matrix([sets[k] for k in left], [sets[k] for k in right] if two else None)[i, j]).astype(np.int64)
    linked = denominator * overlap >= numerator * (n[a] + n[b] - overlap)
    return a[linked], b[linked]


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[place] == x).sum())


def _forest(count: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each place the place of the least id it is connected with."""
    parent = np.arange(count)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            if ids[x] < ids[y]:
                parent[y] = x
            else:
                parent[x] = y
    return np.array([find(x) for x in range(count)])


def _verify_group(numerator: int, denominator: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"node": [], "root": [], "links": []}
        for (by_token, cluster), g in frame.groupby(["by_token", "cluster"], sort=False):
            ids = g["node"].to_numpy(np.int64)
            copies = g["copies"].to_numpy(np.int64)
            prefixes = [np.asarray(p, np.int64) for p in g["prefix"]]
            sets = [np.frombuffer(t, np.uint64) for t in g["tokens"]]
            leads = [np.asarray(p, np.int64) for p in g["lead"]] if by_token else None
            a, b = verify(g["n"].to_numpy(np.int64), g["matches"].to_numpy(np.int64), prefixes, sets, g["side"].to_numpy(), numerator, denominator, leads, cluster)
            if not len(a):
                continue
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = _forest(len(ids), a, b, ids)
            met = links > 0
            out["node"] += ids[met].tolist()
            out["root"] += ids[root[met]].tolist()
            out["links"] += links[met].tolist()
        return pd.DataFrame(out, dtype="int64")

    return run


def _parts(rows: str, tokens: str) -> Column:
    """Blocks that so many nodes and shingles make."""
    return F.greatest(F.ceil(F.col(rows) / BLOCK_NODES), F.ceil(F.col(tokens) / BLOCK_TOKENS)).cast("int")


def deal_groups(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """node, cluster, by_token, parts: the groups in which nodes meet, and into how many blocks each is cut.

    nodes: node, n, lead; components: node, component. A component of one block is a group. A larger one is cut into
    blocks that all meet, or by its leading shingles, if that copies fewer nodes."""
    about = components.join(nodes.select("node", "n"), "node")
    sizes = about.groupBy("component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")).withColumn("parts", _parts("rows", "tokens"))
    about = write_table(about.join(sizes.select("component", "parts", "rows"), "component"), "candidate-nodes")
    large = about.filter("parts > 1")
    whole = about.select("node", F.col("component").alias("cluster"), F.lit(False).alias("by_token"), "parts")
    if large.isEmpty():
        return whole
    led = write_table(nodes.select("node", "n", F.explode("lead").alias("token")).join(large.select("node", "component"), "node"), "candidate-leads")
    tokens = led.groupBy("token", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")).filter("rows > 1").withColumn("parts", _parts("rows", "tokens"))
    tokens = write_table(tokens, "candidate-tokens")
    cost = tokens.groupBy("component").agg(F.sum(F.col("rows") * F.col("parts")).alias("cost"))
    cut = write_table(cost.join(sizes, "component").filter(F.col("cost") < F.col("rows") * F.col("parts")).select("component"), "cut-components")
    cut_tokens = tokens.join(cut, "component", "left_semi").select("token", "parts")
    by_token = led.select("node", "token").join(cut_tokens, "token").select("node", F.col("token").alias("cluster"), F.lit(True).alias("by_token"), "parts")
    return whole.join(cut.withColumnRenamed("component", "cluster"), "cluster", "left_anti").select("node", "cluster", "by_token", "parts").unionByName(by_token)


def jaccard_join(docs: DataFrame, width: int = 5, numerator: int = 8, denominator: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, n_links (documents that it links with, copies included)."""
    small_batches(docs.sparkSession)
    known = write_table(profile(docs, width, id_col, text_col), "shingle-nodes")
    buckets = min(MOST_BUCKETS, max(1, -(-known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // BUCKET_TOKENS)))

    # Spark would deal all keys to as many tasks at any size of the corpus; a task a bucket keeps their input alike.
    blocks = _deal(docs, width, text_col, buckets).repartition(buckets, "key")
    shared = blocks.groupBy("key").applyInArrow(_count_bucket(buckets), "key long, block binary").repartition(buckets, "key")
    found_nodes = shared.groupBy("key").applyInArrow(_gather_nodes(numerator, denominator), "node long, n long, matches int, tokens binary, prefix array<long>, lead array<long>")
    # Copies in several batches are one node; its rows are equal.
    nodes = write_table(found_nodes.dropDuplicates(["node"]), "join-nodes")

    postings = nodes.select("node", F.explode("lead").alias("token"))
    centres = postings.groupBy("token").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre <> last")
    stars = postings.join(centres, "token").filter("node <> centre").select("node", "centre").distinct()
    components = write_table(connected_components(stars, "node", "centre"), "candidate-components")

    classes = known.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = write_table(classes, "set-classes")
    dealt = write_table(deal_groups(nodes, components), "candidate-groups")
    spread = (
        dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(nodes, "node")
        .join(classes.select("node", "copies"), "node")
    )
    rows, tokens = dealt.join(nodes.select("node", "n"), "node").agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n") * F.col("parts")), F.lit(0))).first()
    groups = max(1, rows // BLOCK_NODES, tokens // BLOCK_TOKENS)
    small = F.col("parts") == 1
    keyed = spread.select(
        "node", "n", "matches", "tokens", "prefix", "lead", "cluster", "by_token", "copies",
        F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(groups))).otherwise(F.col("cluster")).alias("k"),
        small.alias("many"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    meet = ["many", "k", "i", "j", "by_token"]
    keyed = keyed.repartition(groups, *meet)
    found = write_table(keyed.groupBy(*meet).applyInPandas(_verify_group(numerator, denominator), "node long, root long, links long"), "links")
    roots = connected_components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))

    named = classes.join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_node = named.join(least, "component").join(links, "node", "left").select("node", "copies", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    return known.join(per_node, (known["node"] == per_node["node"]) & (known["n"] > 0), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
    )
