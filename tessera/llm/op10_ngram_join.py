"""N-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct word n-grams; equal sets are one *node*.
For a similarity of t all but ``n - ceil(t n)`` = r tokens of a set are in a
partner's. Tokens are in one global order, rare ones before frequent ones (by a
bounded list of the commonest), each by hash. The frequent ones fall into
classes, of which a larger set has more. The prefix ends as soon as its rare
tokens and, for each class, all its tokens but one come to r + 1. If two
partners shared no rare token of the prefix and at most one token of each
class, r + 1 tokens would be missing; so they share a rare token or a pair of
one class, and both are in the shorter of the two prefixes. Rare tokens are
indexed alone and frequent ones as pairs of their class; the number of classes
keeps the pairs in proportion to the set.

The join runs in rounds. First every signature links its nodes to one of them,
its hub: the node of the smallest hash, so that the signatures of one crowd of
near copies have few hubs between them and each member is compared with those
few. Signatures whose nodes are still in several components then get a hub by
another hash, for the nodes of other components. At last nodes of different
components meet through each signature that they share. There a bitmap of each set (the parities of hashed tokens, which differ in at
most as many places as the sets do) refuses most pairs. All candidates that are
left are verified on their whole sets.

Tokens are 64-bit hashes, compared as such. Null and blank texts have the empty
set, belong to no group and stay alone; a text with fewer words than ``n`` has
its whole sequence as its one token. Repeated rows and null keys are ordinary
members; a group's id is its smallest non-null key. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, materialize

#: Tokens in more documents than this can be frequent; so many of the commonest at most are.
COMMON, COMMON_TOKENS = 64, 1 << 18
#: Signatures of more nodes than this are met pair by pair behind the bitmaps.
CROWD = 12
#: Rounds of hubs after the first, between the components left.
HUB_ROUNDS = 1
#: Sizes of a set's bitmap and of its folded form, as 64-bit words; tokens of the frequent kind that a class is meant to have.
WORDS, FOLDED, CLASS_TOKENS = 32, 8, 8

_K = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def shingle_sets(data: np.ndarray, at: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct token hashes of each text."""
    low = data.tobytes().lower()  # of bytes: A-Z only
    vocabulary, words, ends = _Numbers(), [], [0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        words += low[a:b].split()
        ends.append(len(words))
    ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    every = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))[ids]

    def grams(part: np.ndarray, size: int) -> np.ndarray:
        token = np.full(len(part) - size + 1, np.uint64(size))
        for k in range(size):
            token = token * _K + part[k : len(part) - size + 1 + k]
            token ^= token >> np.uint64(29)
        return _mix(token)

    tokens = grams(every, n) if len(every) >= n else None
    for a, b in zip(ends[:-1], ends[1:]):
        if a == b:
            yield every[:0]
        elif b - a < n:
            yield grams(every[a:b], b - a)  # the whole sequence is the one token
        else:
            yield np.unique(tokens[a : b - n + 1])


def common_tokens(docs: DataFrame, text: str, n: int, common: int = COMMON, most: int = COMMON_TOKENS) -> np.ndarray:
    """The commonest tokens, ``most`` at most, in ascending order.

    Tokens are counted within blocks of documents; those found twice in a block
    are summed over all blocks. Any set of tokens keeps the join exact; this one
    keeps what many documents have in common out of the prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[np.ndarray]) -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(held), return_counts=True)
            twice = times > 1
            return pa.RecordBatch.from_arrays([pa.array(token[twice].view(np.int64)), pa.array(times[twice])], names=["token", "times"])

        held, size = [], 0
        for _, data, at in chunks(batches, "text", 1 << 20):
            held += shingle_sets(data, at, n)
            size += len(data)
            if size >= 16 << 20:
                yield done(held)
                held, size = [], 0
        if held:
            yield done(held)

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    top = sums.where(F.col("times") > common).orderBy(F.desc("times"), "token").limit(most).select("token").toPandas()  # bounded by `most`
    return np.sort(top["token"].to_numpy(np.int64).view(np.uint64))


def signature(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The rare tokens and the pairs of frequent ones that a set is indexed by."""
    n = len(tokens)
    spare = n - (percent * n + 99) // 100
    rare = tokens[~frequent]
    if len(rare) > spare:
        return rare[: spare + 1]
    out, rest = [rare], tokens[frequent]
    # partners differ in size, at most by the similarity: both are indexed for the larger one's classes
    for band in range(n.bit_length(), (100 * n // percent).bit_length() + 1):
        classes = max(1, (1 << band) * (100 - percent) // (200 * CLASS_TOKENS))
        of = (_mix(rest) % np.uint64(classes)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        again = np.ones(len(rest), bool)  # all tokens of a class but its first count
        again[order[np.flatnonzero(np.diff(of[order], prepend=-1))]] = False
        end = np.searchsorted(np.cumsum(again), spare + 1 - len(rare)) + 1
        of, used = of[:end], rest[:end]
        for c in np.unique(of):
            mine = used[of == c]
            i, j = np.triu_indices(len(mine), 1)
            out.append(_mix((mine[i] * _K + mine[j]) * _K + np.uint64(band)))
    return np.unique(np.concatenate(out))


def bitmaps(tokens: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For n sets (``row`` says whose a token is) the parity of the tokens at each place, as 64-bit words."""
    wide = 64 * WORDS
    place = (_mix(tokens + _K) % np.uint64(wide)).astype(np.int64)
    odd = np.bincount(row * wide + place, minlength=n * wide).reshape(n, wide) % 2
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.int64)


def is_common(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(tokens), bool)
    return common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens


def signatures(docs: DataFrame, key: str, text: str, n: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc, text_hash, n_tokens, node, prefix, bits) of every row; node and prefix are null for the empty set."""
    if not 50 < percent <= 100:
        raise ValueError("the similarity must be above 50 and at most 100 percent")
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(common)  # at most COMMON_TOKENS hashes

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text", 1 << 20):
            sets = list(shingle_sets(data, at, n))
            size = np.array([len(x) for x in sets])
            every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            ends = np.cumsum(size)
            frequent, bits = is_common(every, shared.value), bitmaps(every, row, len(sets))
            total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(every ^ _K), dtype=np.uint64)])
            node = _mix(total[ends] - total[ends - size] + size.astype(np.uint64)).view(np.int64)
            prefix = [signature(x, frequent[b - len(x) : b], percent).view(np.int64) if len(x) else None for x, b in zip(sets, ends)]
            empty = size == 0
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("text_hash"), pa.array(size), pa.array(node, mask=empty), pa.array(prefix, longs), pa.array(list(bits), longs)],
                names=["doc", "text_hash", "n_tokens", "node", "prefix", "bits"],
            )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc {kind}, text_hash long, n_tokens long, node long, prefix array<long>, bits array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b): comp is one value for what is connected.

    Each round points every node at its smallest neighbour (twice over) and
    contracts the edges; what is written between rounds shrinks quickly.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node"))
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("p")), "parents")
        higher = up.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        jump = up.join(higher, "p").select("v", F.least("p", "pp").alias("to"))
        jump = materialize(jump, "jumps")
        labels = materialize(
            labels.join(jump, labels["comp"] == jump["v"], "left").select("node", F.coalesce("to", "comp").alias("comp")),
            "labels",
        )
        left, right = jump.select(F.col("v").alias("a"), F.col("to").alias("x")), jump.select(F.col("v").alias("b"), F.col("to").alias("y"))
        edges = materialize(
            edges.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
    return labels


def joined_components(known: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) as in ``known``, with what ``links`` (a, b) join between its components and other nodes."""
    x, y = known.select(F.col("node").alias("a"), F.col("comp").alias("x")), known.select(F.col("node").alias("b"), F.col("comp").alias("y"))
    between = links.join(x, "a", "left").join(y, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    over = components(between)
    old = known.join(over.select(F.col("node").alias("c"), F.col("comp").alias("to")), F.col("comp") == F.col("c"), "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return materialize(old.unionByName(over.join(known, "node", "left_anti")), "components")


def _candidate_texts(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, body): the compressed text of one document of each candidate node."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for part, data, at in chunks(batches, "text", 1 << 22):
            raw = data.tobytes()
            body = [pack(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(body, pa.binary())], names=["k", "body"])

    # the key of a row is one hash: what is distinct by it is already placed for the join
    rows = docs.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(key), F.xxhash64(text)).alias("k"), F.col(text).alias("text"))
    small = rows.mapInArrow(squeeze, "k long, body binary").dropDuplicates(["k"])
    wanted = nodes.select("node", F.xxhash64("rep.doc", "rep.text_hash").alias("of"))
    return small.join(wanted, F.col("k") == F.col("of")).select("node", "body")


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Both texts travel to the pair; a crowd around one node is a skewed join,
    which Spark splits, and tasks hold one batch of pairs at a time.
    """
    second = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("body_b")), "b")
    both = second.join(texts.select(F.col("node").alias("a"), F.col("body").alias("body_a")), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress

        def tokens(raw: bytes) -> np.ndarray:
            return next(shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), n))

        seen: dict[int, np.ndarray] = {}

        def of(node: int, packed: bytes) -> np.ndarray:
            if node not in seen:
                if sum(map(len, seen.values())) > 1 << 21:  # a crowd's nodes come again and again
                    seen.clear()
                seen[node] = tokens(unpack(packed))
            return seen[node]

        for batch in batches:
            keep = []
            for a, b, packed_a, packed_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "body_a", "body_b"))):
                mine, other = of(a, packed_a), of(b, packed_b)
                same = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(100 * same >= percent * (len(mine) + len(other) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "body_a", "body_b").mapInArrow(check, "a long, b long")


def _fits(n_a: str, n_b: str, percent: int):
    """Whether sizes allow the similarity at all."""
    return (F.col(n_a) * 100 >= F.col(n_b) * percent) & (F.col(n_b) * 100 >= F.col(n_a) * percent)


def _near(bits_a: str, bits_b: str, n_a: str, n_b: str, percent: int, words: int = WORDS):
    """Whether the bitmaps leave the similarity possible: sets that similar differ in few tokens."""
    differ = [F.bit_count(F.col(bits_a)[i].bitwiseXOR(F.col(bits_b)[i])) for i in range(words)]
    return sum(differ[1:], differ[0]) * (100 + percent) <= (F.col(n_a) + F.col(n_b)) * (100 - percent)


def _folded(bits: str):
    """The bitmap with its parts laid over each other: the parities of hashes modulo the smaller size."""
    parts = [[F.col(bits)[i + k] for k in range(0, WORDS, FOLDED)] for i in range(FOLDED)]
    return F.array(*[reduce(lambda x, y: x.bitwiseXOR(y), p) for p in parts])


def _meet(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes in different components that share a crowded signature.

    The join itself asks the bitmaps. ``heads`` are a node's smallest crowded
    signatures: where two nodes share any of them, only the smallest such brings
    the pair, else each shared signature does.
    """
    keep = ["node", "n_tokens", "comp", "bits", "heads"]
    x = members.select("token", *[F.col(c).alias(f"{c}_a") for c in keep])
    y = members.select(F.col("token").alias("t"), *[F.col(c).alias(f"{c}_b") for c in keep])
    on = (F.col("token") == F.col("t")) & (F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b")) & _fits("n_tokens_a", "n_tokens_b", percent)
    on = on & _near("bits_a", "bits_b", "n_tokens_a", "n_tokens_b", percent, FOLDED)
    on = on & F.coalesce(F.array_min(F.array_intersect("heads_a", "heads_b")) == F.col("token"), F.lit(True))
    return x.join(y, on).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def link(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85, common: int = COMMON, crowd: int = CROWD
) -> tuple[DataFrame, DataFrame]:
    """(signatures, components): rows with their node, and (node, comp) of linked nodes."""
    signed = materialize(signatures(docs, key, text, n, percent, common_tokens(docs, text, n, common)), "signatures")
    full = signed.where("node IS NOT NULL")
    nodes = full.groupBy("node").agg(F.min(F.struct("doc", "text_hash")).alias("rep"), F.first("n_tokens").alias("n_tokens"), F.first("bits").alias("bits"))
    nodes = materialize(nodes, "nodes")
    postings = full.select("node", F.explode("prefix").alias("token"))
    # partial aggregation meets exact copies and crowded signatures in the map tasks
    shared = postings.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1").select("token")
    # written first: beneath a join of two plain exchanges Spark can split a signature in very many rows
    shared = materialize(postings.join(materialize(shared, "shared"), "token"), "postings").distinct()
    shared = materialize(shared.join(nodes.select("node", "n_tokens"), "node"), "postings")
    hub = lambda seed, *more: F.min(F.struct(F.xxhash64("node", F.lit(seed)).alias("h"), "node", "n_tokens", *more)).alias("hub")
    tokens = shared.groupBy("token").agg(F.count("*").alias("df"), hub(0))
    tokens = materialize(tokens.where("df > 1"), "tokens")

    few = shared.join(tokens.where(F.col("df") <= crowd).select("token"), "token")
    x, y = few.select("token", F.col("node").alias("a"), F.col("n_tokens").alias("n_a")), few.select("token", F.col("node").alias("b"), F.col("n_tokens").alias("n_b"))
    small = x.join(y, "token").where((F.col("a") < F.col("b")) & _fits("n_a", "n_b", percent)).select("a", "b")
    crowded = materialize(shared.join(tokens.where(F.col("df") > crowd).select("token", "hub"), "token"), "crowds")

    def spokes(at: DataFrame) -> DataFrame:
        far = at.where((F.col("node") != F.col("hub.node")) & _fits("n_tokens", "hub.n_tokens", percent))
        return far.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))

    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n_tokens").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))

    def possible(pairs: DataFrame) -> DataFrame:
        both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
        return materialize(both.where(_near("bits_a", "bits_b", "n_a", "n_b", percent)).select("a", "b"), "pairs")

    first = possible(small.unionByName(spokes(crowded)))

    wanted = first.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowded.select("node")).distinct()
    texts = materialize(_candidate_texts(docs, nodes.join(wanted, "node", "left_semi"), key, text), "candidate-texts")
    links = materialize(verify(first, texts, n, percent), "links")
    known = components(links)

    tried = [first]

    def settle(pairs: DataFrame, known: DataFrame) -> DataFrame:
        for before in tried:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        more = materialize(verify(pairs, texts, n, percent), "links")
        return joined_components(known, more) if more.take(1) else known

    def still_open(known: DataFrame) -> DataFrame:
        placed = materialize(crowded.select("token", "node", "n_tokens").join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "placed")
        apart = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
        return materialize(placed.join(materialize(apart, "apart"), "token"), "open-postings")

    for seed in range(1, HUB_ROUNDS + 1):
        open_ = still_open(known)
        hubs = materialize(open_.groupBy("token").agg(hub(seed, "comp")), "hubs")
        pairs = possible(spokes(open_.join(hubs, "token").where("comp <> hub.comp")))
        known = settle(pairs, known)
        tried.append(pairs)

    open_ = still_open(known).drop("n_tokens")
    heads = open_.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, 16).alias("heads"))
    members = open_.join(heads.join(nodes.select("node", "n_tokens", _folded("bits").alias("bits")), "node"), "node")
    return signed, settle(possible(_meet(materialize(members, "members"), percent)), known)


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85, **limits) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``."""
    signed, known = link(docs, key, text, n, percent, **limits)
    placed = signed.join(known, "node", "left").select("doc", "n_tokens", F.coalesce("comp", "node").alias("comp"))
    least = placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc").alias("smallest"))
    return placed.join(least, "comp", "left").select(
        F.col("doc").alias(key), F.col("n_tokens").alias("n_shingles"), F.when(F.col("comp").isNull(), F.col("doc")).otherwise(F.col("smallest")).alias("component_id")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, **limits) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest key; rows with the empty set all stay."""
    signed, known = link(docs, key, text, n, percent, **limits)
    placed = signed.where("node IS NOT NULL").join(known, "node", "left").select("doc", "text_hash", F.coalesce("comp", "node").alias("comp"))
    counted = placed.groupBy("comp", "doc", "text_hash").agg(F.count("*").alias("copies"))
    chosen = counted.groupBy("comp").agg(F.min(F.struct("doc", "text_hash", "copies")).alias("c")).select("c.*")
    alone = signed.where("node IS NULL").select("doc", "text_hash").distinct().withColumn("copies", F.lit(1))
    chosen = chosen.unionByName(alone, allowMissingColumns=True).select(F.col("doc").alias("_d"), F.col("text_hash").alias("_h"), "copies")
    kept = docs.join(chosen, (F.xxhash64(text) == F.col("_h")) & F.col(key).eqNullSafe(F.col("_d")))
    again = kept.where("copies > 1").dropDuplicates(["_d", "_h"])
    return kept.where("copies = 1").unionByName(again).select(docs.columns)


