"""N-gram Jaccard join: groups of documents linked by 75 % common five-word shingles.

Two documents link when 100 x |common shingles| >= 75 x |shingles of either|. The result
is exact: every link between different texts is found or lies inside a group already
connected. Shingles are compared as 64-bit and sets as 128-bit hashes under a seed that is
drawn anew for every run, so that no text can be made to collide.

1. Every document's set of shingle hashes; equal sets are one from here on.
2. A document can only link if enough of the smaller half of its hashes occur in another
   document, too (counted over all documents, in packed blocks): the others are done.
3. The rest fall into blocks that share a minimum hash with the block's first set; a
   signature tree per block finds its links, and connected sets get one label.
4. Again, a set can only link to another label if enough of its hashes occur there. Those
   that can fall into blocks by their rarest hashes, of which two sets that link share
   one; overlapping blocks are joined, and trees find the links across labels.

Blocks larger than ``CHUNK`` are split: in step 3 each part keeps the block's first set,
in step 4 every two parts meet. Defined results: a document of fewer than five words has
its whole word sequence as one shingle; without words, or NULL, it has none and is its
own component; a NULL doc_id has the least known doc_id of its component, else NULL;
repeated rows are copies of each other; a tie between rows of one doc_id goes to the least
text hash; very long texts are read whole, one at a time where need be; other columns do
not matter, and ``one_of_each`` carries them along.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from florin.llm.bitset import membership
from florin.llm.columns import free_name
from florin.llm.components import connected_components
from florin.llm.signature_tree import SignatureTree
from florin.llm.textbytes import Words, byte_set, flat, folded_ascii, mixed, slices
from florin.session import cut_lineage

SHINGLE = 5
PERCENT = 75
MIN_HASHES = 4
CHUNK = 1024
SALT = 16

IN_WORD = ~byte_set(b" \t\n\x0b\x0c\r")
FOLDED = folded_ascii()
SHARED_HERE = 65535  # in place of a document: the hash has several in its block
BLOCK_DOCS = 60_000  # of a block, whose documents are numbered in 16 bits
BLOCK_HASHES = 1 << 20  # of a block of several slices
RANGE_TEXT = 256 << 20  # bytes of text whose hashes make one range
HOT = 1024  # a token with more than this share of all is joined apart


def shingle_sets(data: np.ndarray, offsets: np.ndarray, seed: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = Words(data, offsets, IN_WORD, FOLDED, seed)
    grams = words.grams(SHINGLE)
    short = {n: words.grams(n) for n in range(1, SHINGLE)}
    found = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        n = last - first
        if n >= SHINGLE:
            found.append(np.unique(grams[first : last - SHINGLE + 1]))
        else:
            found.append(short[n][first : first + 1] if n else np.zeros(0, np.uint64))
    return found


def digests(sets: list[np.ndarray]) -> list[str]:
    """128 bits that tell sets apart, as text."""
    found = []
    for s in sets:
        one, two = mixed(s), mixed(s ^ np.uint64(0x5851F42D4C957F2D))
        found.append(f"{int(one.sum(dtype=np.uint64)):016x}{int(two.sum(dtype=np.uint64)):016x}")
    return found


def _by_part(part: np.ndarray, n_parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of every part that occurs."""
    order = np.argsort(part, kind="stable")
    borders = np.searchsorted(part[order], np.arange(n_parts + 1))
    for p in np.flatnonzero(np.diff(borders)):
        yield int(p), order[borders[p] : borders[p + 1]]


# (block, part, kind, payload): what a block of documents sends to a part of the hashes.
PACKED = "block long, part int, kind int, payload binary"
HASHES, DOCUMENTS = 0, 1


def _block_rows(held: list[tuple[pa.Table, np.ndarray, np.ndarray]], block: int, n_parts: int) -> pa.RecordBatch:
    """PACKED rows of one block of (documents, hashes, their owners)."""
    table = pa.concat_tables([t for t, _, _ in held])
    hashes = np.concatenate([h for _, h, _ in held])
    owner = np.concatenate([o for _, _, o in held])
    # Hashes of several documents of the block are counted here and sent once.
    order = np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    same = np.concatenate([[False], hashes[1:] == hashes[:-1], [False]]) if len(hashes) else np.zeros(1, bool)
    several = same[:-1] | same[1:]
    here = np.bincount(owner[several], minlength=table.num_rows)
    once = ~same[:-1]
    hashes = hashes[once]
    owner = np.where(several[once], SHARED_HERE, owner[once]).astype(np.uint16)
    low = ((hashes >> np.uint64(20)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    rows = [
        (block, p, HASHES, low[at].tobytes() + owner[at].tobytes())
        for p, at in _by_part((hashes % np.uint64(n_parts)).astype(np.int32), n_parts)
    ]
    table = table.append_column("here", pa.array(here))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    rows.append((block, block % n_parts, DOCUMENTS, sink.getvalue().to_pybytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
        names=["block", "part", "kind", "payload"],
    )


def _packed_blocks(n_parts: int, seed: int) -> Callable:
    """Blocks of a task's documents, as many as have BLOCK_HASHES hashes, so that a row has many hashes of its part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held, documents, kept = [], 0, 0
        for batch in batches:
            for start, stop in slices(batch.column("text"), rows=BLOCK_DOCS):
                sets = shingle_sets(*flat(batch.column("text")[start:stop]), seed)
                size = np.array([len(s) for s in sets], np.int64)
                half = (size + 1) // 2
                n = int(half.sum())
                if held and (documents + len(sets) > BLOCK_DOCS or kept + n > BLOCK_HASHES):
                    yield _block_rows(held, block, n_parts)
                    block += 1
                    held, documents, kept = [], 0, 0
                ids = batch.column("doc_id")[start:stop]
                table = pa.table({"doc_id": ids, "h": batch.column("h")[start:stop], "n": size, "digest": digests(sets)})
                owner = np.repeat(np.arange(documents, documents + len(sets)), half).astype(np.uint16)
                held.append((table, np.concatenate([s[:k] for s, k in zip(sets, half.tolist(), strict=True)]), owner))
                documents += len(sets)
                kept += n
        if held:
            yield _block_rows(held, block, n_parts)

    return pack


def _shared_in_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one part: for every block, the documents that have hashes of other documents, and how many."""
    blocks: list[int] = []
    low: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    for batch in batches:
        documents = batch.filter(pa.array(batch.column("kind").to_numpy() == DOCUMENTS))
        if documents.num_rows:
            yield documents.select(["block", "kind", "payload"])
        for block, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "payload")), strict=True):
            if kind == HASHES:
                n = len(payload) // 6
                blocks.append(block)
                low.append(np.frombuffer(payload, np.uint32, n))
                owner.append(np.frombuffer(payload, np.uint16, n, 4 * n))
    if not blocks:
        return
    number = np.repeat(np.arange(len(blocks), dtype=np.int32), [len(x) for x in low])
    hashes, owners = np.concatenate(low), np.concatenate(owner)
    del low, owner
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # One share of the hashes after the other, so that what sorting takes is small next to the hashes.
    share = hashes >> np.uint32(28)
    for own in range(16):
        at = np.flatnonzero(share == own)
        order = at[np.argsort(hashes[at])]
        in_order = hashes[order]
        same = np.concatenate([[False], in_order[1:] == in_order[:-1], [False]]) if len(order) else np.zeros(1, bool)
        shared = order[same[:-1] | same[1:]]
        shared = shared[owners[shared] != SHARED_HERE]
        key, n = np.unique(number[shared].astype(np.int64) * 65536 + owners[shared], return_counts=True)
        keys.append(key)
        counts.append(n)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)
    rows = [
        (blocks[b], HASHES, (key[at] & 0xFFFF).astype(np.uint16).tobytes() + n[at].astype(np.uint32).tobytes())
        for b, at in _by_part((key >> 16).astype(np.int64), len(blocks))
    ]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)],
            names=["block", "kind", "payload"],
        )


def _documents_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of the blocks, with whether it can link; a block's documents come before its counts."""

    def finished(table: pa.Table, count: np.ndarray) -> pa.RecordBatch:
        n = table.column("n").to_numpy()
        # The smaller half of a linked document has at least 3/16 of its size in common hashes.
        able = (n > 0) & (16 * count >= 3 * n)
        whole = table.drop_columns(["here"]).append_column("able", pa.array(able)).combine_chunks()
        return whole.to_batches()[0]

    table, count = None, np.zeros(0, np.int64)
    for batch in batches:
        for kind, payload in zip(batch.column("kind").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            if kind == DOCUMENTS:
                if table is not None:
                    yield finished(table, count)
                table = pa.ipc.open_stream(payload).read_all()
                count = table.column("here").to_numpy().astype(np.int64)
            else:
                n = len(payload) // 6
                count[np.frombuffer(payload, np.uint16, n)] += np.frombuffer(payload, np.uint32, n, 2 * n)
    if table is not None:
        yield finished(table, count)


def hash_ranges(docs: DataFrame) -> int:
    """How many ranges the hashes are parted into: one worker holds the hashes of RANGE_TEXT bytes of text at most on average."""
    configured = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(configured, math.ceil(size / RANGE_TEXT))


def documents_able_to_link(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, h, n, digest, able) of every row; ``h`` hashes its text, ``digest`` names its shingle set."""
    parts = hash_ranges(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(_packed_blocks(parts, seed), PACKED)
    counted = packed.repartitionById(parts, "part").mapInArrow(_shared_in_part, "block long, kind int, payload binary")
    by_block = counted.repartition(parts, "block").sortWithinPartitions("block", F.desc("kind"))
    return by_block.mapInArrow(_documents_of_blocks, f"doc_id {kind}, h long, n long, digest string, able boolean")


def node_table(rows: DataFrame) -> DataFrame:
    """(node, digest, id, h): a number for every distinct set of documents able to link.

    ``id`` and ``h`` are those of the row with the least doc_id, NULL after all others, and then the least text hash.
    """
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h")
    least = cut_lineage(rows.where("able").groupBy("digest").agg(F.min(place).alias("first")))
    # Numbers of rows already written: they stay the same however often a task runs.
    numbered = least.withColumn("node", F.monotonically_increasing_id())
    return cut_lineage(numbered.select("node", "digest", F.col("first.doc_id").alias("id"), F.col("first.h").alias("h")))


def sets_of(docs: DataFrame, nodes: DataFrame, seed: int) -> DataFrame:
    """(node, n, tokens) of ``nodes``: the sets are made again from the texts named.

    Texts of other documents are left out before the shuffle, by a bit set of fixed size;
    of rows with equal doc_id and text every task sends one.
    """
    may_be_wanted = membership(nodes.select(F.xxhash64("id", "h").alias("k")), "k")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                sets = shingle_sets(*flat(batch.column("text")[start:stop]), seed)
                own = digests(sets)
                named = batch.column("digest")[start:stop].to_pylist()
                right = [i for i in range(stop - start) if own[i] == named[i]]
                sizes = np.array([len(sets[i]) for i in right], np.int64)
                values = np.concatenate([sets[i] for i in right]) if right else np.zeros(0, np.uint64)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node")[start:stop].take(pa.array(right, pa.int64())),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64))),
                    ],
                    names=["node", "n", "tokens"],
                )

    texts = docs.select("doc_id", F.xxhash64("text").alias("own"), "text").where(may_be_wanted(F.xxhash64("doc_id", "own")))
    once = texts.groupBy("doc_id", "own").agg(F.first("text").alias("text"))
    joined = once.join(nodes, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("h")))
    return joined.select("node", "digest", "text").mapInArrow(tokens, "node long, n long, tokens array<long>")


def _token_arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    column = batch.column("tokens")
    values = column.values.to_numpy().view(np.uint64)
    borders = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]


def _min_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, which, key): the least hash of every set under several orders."""
    orders = [mixed(np.array([i + 1], np.uint64)) for i in range(MIN_HASHES)]
    for batch in batches:
        sets = _token_arrays(batch)
        for i, order in enumerate(orders):
            keys = np.array([mixed(s ^ order).min() for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(np.full(len(sets), i, np.int32)), pa.array(keys.view(np.int64))],
                names=["node", "which", "key"],
            )


def _tree_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) inside every block; the rows of a block follow each other."""

    def links(nodes: list[int], labels: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        found = SignatureTree(sets).links(PERCENT, np.array(labels))
        return pa.RecordBatch.from_arrays(
            [pa.array([nodes[i] for i, _ in found], pa.int64()), pa.array([nodes[j] for _, j in found], pa.int64())],
            names=["u", "v"],
        )

    block, nodes, labels, sets = None, [], [], []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "node", "label"))
        for own, node, label, tokens in zip(*columns, _token_arrays(batch), strict=True):
            if own != block:
                if len(set(labels)) > 1:
                    yield links(nodes, labels, sets)
                block, nodes, labels, sets = own, [], [], []
            nodes.append(node)
            labels.append(label)
            sets.append(tokens)
    if len(set(labels)) > 1:
        yield links(nodes, labels, sets)


def links_in_blocks(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Links among the sets of every block of ``members`` (node, label, block)."""
    joined = members.join(sets.select("node", "tokens"), "node")
    return joined.repartition("block").sortWithinPartitions("block").mapInArrow(_tree_links, "u long, v long")


def near_members(sets: DataFrame) -> DataFrame:
    """(node, label, block): every set with the first set of those that share a minimum hash with it."""
    keys = cut_lineage(sets.select("node", "tokens").mapInArrow(_min_hashes, "node long, which int, key long"))
    first = keys.groupBy("which", "key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("size"))
    pairs = keys.join(first.where("size > 1"), ["which", "key"]).select("node", "first").distinct()
    parts = pairs.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    dealt = pairs.join(parts, "first")
    # The first set goes to every part of its block, any other to one.
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    part = F.explode(F.when(F.col("node") == F.col("first"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own)))
    placed = dealt.select("node", "first", part.alias("part"))
    return placed.select("node", F.col("node").alias("label"), F.concat_ws("/", "first", "part").alias("block"))


def held_across(tokens: DataFrame) -> DataFrame:
    """The rows of ``tokens`` (label, token, ...) whose token several labels have, with its number of rows, ``holders``.

    Tokens are summed where they lie, and rows of others go before the join. A token that
    has more than one in HOT of all rows left is one of fewer than HOT: these are broadcast,
    so that a line that many documents hold comes into no task whole.
    """
    summed = tokens.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("holders"))
    spread = cut_lineage(summed.where("a < b").select("token", "holders"))
    may_be = membership(spread.select(F.xxhash64("token").alias("k")), "k")
    total = spread.agg(F.sum("holders")).first()[0] or 0
    hot = F.broadcast(spread.where(F.col("holders") * HOT > total))
    left = tokens.where(may_be(F.xxhash64("token")))
    others = left.join(hot, "token", "left_anti").join(spread.where(F.col("holders") * HOT <= total), "token")
    return left.join(hot, "token").unionByName(others)


def rare_members(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label, block) such that two sets of different labels that link share a block."""
    labelled = sets.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")

    half = F.explode(F.slice("tokens", F.lit(1), F.ceil(F.col("n") / 2).cast("int"))).alias("token")
    counted = held_across(labelled.select("node", "label", half)).groupBy("node").agg(F.count(F.lit(1)).alias("c"))
    # The smaller half of a linked set has at least 3/16 of its size in common tokens.
    able = labelled.join(counted, "node").where("16 * c >= 3 * n").drop("c")
    across = held_across(able.select("node", "n", "label", F.explode("tokens").alias("token")))
    # Of two linked sets' tokens in any common order, the first quarter and one more share one;
    # here those that sets of one label alone have come first, and need no place of their own.
    by_node = Window.partitionBy("node")
    ranked = across.withColumn("across", F.count(F.lit(1)).over(by_node)).withColumn(
        "place", F.col("n") - F.col("across") + F.row_number().over(by_node.orderBy("holders", "token"))
    )
    first = ranked.where(f"100 * across >= {PERCENT} * n AND place <= n div 4 + 1")
    # All that a linked set has in common with the other is common across labels.
    first = cut_lineage(first.select("node", "label", "token"))
    # Tokens with the same holders make one block.
    alike = first.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("names"),
        F.min("label").alias("a"),
        F.max("label").alias("b"),
        F.min("node").alias("least"),
    )
    blocks = alike.where("a < b").groupBy("size", "names").agg(F.min("token").alias("token"), F.min("least").alias("least"))
    placed = cut_lineage(first.join(blocks.select("token", "size", "least"), "token"))
    # Blocks that overlap become one, so that a set moves once; very large ones stay apart.
    stars = placed.select(F.col("node").alias("u"), F.col("least").alias("v"))
    joined = placed.drop("least").join(connected_components(stars, stored=True).withColumnRenamed("root", "whole"), "node")
    small = joined.groupBy("whole").agg(F.count_distinct("node").alias("sets")).where(f"sets <= {CHUNK}").select("whole")
    together = joined.join(small, "whole").select("node", "label", F.concat(F.lit("="), F.col("whole")).alias("block")).distinct()
    apart = joined.join(small, "whole", "left_anti").withColumn("parts", F.ceil(F.col("size") / CHUNK).cast("int"))
    apart = apart.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    pair = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.concat_ws("-", F.least(F.col("own"), j), F.greatest(F.col("own"), j))
    )
    met = apart.select("node", "label", "token", F.explode(pair).alias("pair"))
    return together.union(met.select("node", "label", F.concat_ws("/", "token", "pair").alias("block")))


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents_able_to_link() of ``docs``, and (digest, id, root) of every set able to link: ``root`` names its component."""
    seed = secrets.randbits(128)
    rows = cut_lineage(documents_able_to_link(docs, seed))
    nodes = node_table(rows)
    sets = cut_lineage(sets_of(docs, nodes, seed))
    near = cut_lineage(links_in_blocks(sets, near_members(sets)))
    labels = connected_components(near, stored=True)
    rare = links_in_blocks(sets, rare_members(sets, labels))
    # The labels link what the first links do, in fewer rows and files.
    roots = connected_components(labels.select(F.col("node").alias("u"), F.col("root").alias("v")).union(rare))
    return rows, nodes.join(roots, "node", "left").select("digest", "id", F.coalesce("root", "node").alias("root"))


def _with_sets(rows: DataFrame, by_set: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``by_set``, NULL for sets not in it."""
    # A third of all rows may be copies of one text: their set is salted, by row, as they may lack a doc_id.
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")
    return rows.withColumn("salt", salt).join(by_set.select("*", every_salt), ["digest", "salt"], "left")


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n, component_id) of every row of ``docs`` (doc_id, text); ``h`` hashes the text."""
    rows, named = _groups(docs)
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    joined = _with_sets(rows, named.join(least, "root").select("digest", "component_id"))
    own = F.when(F.col("able"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "h", "n", own.alias("component_id"))


def ngram_jaccard(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every component: of the least doc_id, NULL after all others, and then of the least text hash.

    A document without words is its own component; of its rows with equal, known doc_id
    and text one stays. Only texts that may go are shuffled: a bit set of fixed size lets
    the others pass.
    """
    rows, named = _groups(docs)
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h")
    by_set = named.join(rows.where("able").groupBy("digest").agg(F.min(place).alias("first")), "digest")
    first = by_set.groupBy("root").agg(F.min("first").alias("first"))
    found = _with_sets(rows, named.join(first, "root").select("digest", "first")).groupBy("doc_id", "h").agg(
        F.count(F.lit(1)).alias("rows"), F.min("first").alias("first")
    )
    linked = F.col("first").isNotNull()
    goes = linked & ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h")))
    named_id, named_h, gone, twice, key, asked_for = (free_name(docs, c) for c in ("_id", "_h", "_goes", "_twice", "_k", "_m"))
    # Of texts without words, rows without doc_id are not known to be the same document.
    repeated_rows = (F.col("rows") > 1) & (linked | F.col("doc_id").isNotNull())
    doubtful = found.select(
        F.col("doc_id").alias(named_id), F.col("h").alias(named_h), goes.alias(gone), repeated_rows.alias(twice)
    )
    doubtful = cut_lineage(doubtful.where(F.col(gone) | F.col(twice)))
    may_go = membership(doubtful.select(F.xxhash64(named_id, named_h).alias("k")), "k")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    asked = keyed.withColumn(asked_for, may_go(F.xxhash64("doc_id", key)))
    same = F.col("doc_id").eqNullSafe(F.col(named_id)) & (F.col(key) == F.col(named_h))
    checked = asked.where(F.col(asked_for)).join(doubtful, same, "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = checked.where(F.col(gone).isNull()).select(*own)
    repeated = checked.where(F.col(twice) & ~F.col(gone)).select(*own).dropDuplicates(["doc_id", "text"])
    return asked.where(~F.col(asked_for)).select(*own).union(once).union(repeated)
