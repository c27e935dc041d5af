"""Documents linked by the Jaccard similarity of their word n-grams, by T-occurrence search.

A document's set is its distinct n-grams. Sets that are equal are one node. N-grams are
ordered from rare to frequent (the order decides the cost, never the result); two sets that
reach the similarity share one of the first grams of both, so only these are put in inverted
lists, with their place in the set, and lists of one node are left out. Where a list's nodes
meet, two of them are candidates if their sizes and places leave enough grams for the
overlap they need. Lists that are too long for one task are cut in blocks, and each pair of
blocks is a task.

Candidates are first compared by summaries: how many grams of a set fall in each of some
buckets, about four in each; the smaller counts of all buckets together bound the overlap
from above. What can still be similar is searched together, by node, on the whole sets: each of the node's
grams has the list of candidates that hold it, the longest lists are set aside, as many as
may be missed, the short ones are merged by a heap, what occurs often enough in them is
probed in the long ones by binary search (DivideSkip), and candidates that reach their
required overlap are links.

What is asked for are components. A first pass follows the two most promising others of each
node in each list; a second pass looks at every pair that is not yet connected, so no link
between different components is missed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift.llm.common import join_spread
from proxysift.llm.components import connected_components
from proxysift.session import durable

WORDS = 4
PERCENT = 85
# Frequent grams with a rank of their own; all others count as rare.
RANKED = 262_144
BLOCK = 2_000

_SLICE = 4_000_000
_FLUSH = 4_000_000
_HASH_BITS = 57
_HEAP = 256
# Cells of so many nodes are looked through by root first.
_LARGE = 64

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in order, and the number of words of each text.

    Words are runs of anything but ASCII white space, A-Z in lower case.
    """
    packed = [text.encode("utf-8", "surrogatepass") for text in texts]
    sizes = np.array([len(p) + 1 for p in packed], dtype=np.int64)
    codes = np.frombuffer((b" ".join(packed) + b" ").lower(), dtype=np.uint8)
    inside = ~_SPACE[codes]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    # Places within words, counted from the word's first byte.
    begin = np.zeros(len(codes), dtype=np.int32)
    begin[starts] = np.diff(np.concatenate([[0], starts]))
    place = np.arange(len(codes), dtype=np.int32) - np.cumsum(begin, dtype=np.int32)
    longest = int(place[inside].max()) + 1
    powers = np.cumprod(np.full(longest, _MULTIPLIER, dtype=np.uint64))
    parts = np.where(inside, _BYTE[codes] * powers[np.minimum(place, longest - 1)], np.uint64(0))
    of = np.searchsorted(np.cumsum(sizes), starts, "right")
    return _mix(np.add.reduceat(parts, starts)), np.bincount(of, minlength=len(texts))


def gram_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, end to end, and the size of each set.

    A text of fewer words, but not none, has its whole sequence as its only gram.
    """
    hashes, counts = word_hashes(texts)
    of = np.repeat(np.arange(len(texts)), counts)
    grams = np.zeros(len(hashes), dtype=np.uint64)
    room = np.repeat(np.cumsum(counts), counts) - np.arange(len(hashes))  # words left in the text
    for k in range(words):
        following = np.concatenate([hashes[k:], np.zeros(min(k, len(hashes)), np.uint64)])
        grams = np.where(room > k, _mix(grams * _MULTIPLIER + following + np.uint64(1)), grams)
    first = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
    kept = (room >= words) | first
    of, grams = of[kept], grams[kept]
    order = np.lexsort((grams, of))
    of, grams = of[order], grams[order]
    if len(of):
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (grams[1:] != grams[:-1])])
        of, grams = of[new], grams[new]
    return grams, np.bincount(of, minlength=len(texts))


def _signatures(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number per set, the same for equal sets; 0 for empty ones."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(starts):
        out[full] = _mix(np.add.reduceat(_mix(grams ^ np.uint64(0xA5A5A5A5)), starts) + sizes[full].astype(np.uint64))
    return out.view(np.int64)


def _summaries(grams: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Grams per bucket of each set, as bytes; the number of buckets is a power of two.

    Empty if a count does not fit in a byte, which says nothing about the set.
    """
    buckets = 2 ** np.ceil(np.log2(np.maximum(sizes / 4, 1))).astype(np.int64)
    ends = np.cumsum(buckets)
    at = np.repeat(ends - buckets, sizes) + (grams & np.repeat(buckets - 1, sizes).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(at, minlength=int(ends[-1]) if len(ends) else 0)
    packed = np.minimum(counts, 255).astype(np.uint8).tobytes()
    fits = np.maximum.reduceat(counts, ends - buckets) < 255 if len(ends) else []
    return [packed[end - n : end] if fit else b"" for end, n, fit in zip(ends, buckets, fits, strict=True)]


def overlap_bound(a: bytes, b: bytes) -> tuple[int, int, int] | None:
    """Upper bound of the overlap of two sets, and their sizes; None if a summary is empty."""
    if not a or not b:
        return None
    x, y = (np.frombuffer(v, dtype=np.uint8).astype(np.int64) for v in (a, b))
    few = min(len(x), len(y))
    x, y = x.reshape(-1, few).sum(axis=0), y.reshape(-1, few).sum(axis=0)
    return int(np.minimum(x, y).sum()), int(x.sum()), int(y.sum())


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    piece = batch["text"].str.len().cumsum().floordiv(_SLICE)
    for _, rows in batch.groupby(piece, sort=False):
        yield rows


def _profile(words: int):
    """Rows of documents (id, set, size) and of grams that a stretch of rows repeats."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size = [], 0

        def repeated() -> pd.DataFrame:
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pd.DataFrame({
                "row": np.int64(-1), "node": np.int64(0), "size": n[n > 2].astype(np.int32), "gram": found[n > 2].view(np.int64),
                "summary": b"",
            })

        for batch in batches:
            for rows in _slices(batch):
                grams, sizes = gram_sets(rows["text"].tolist(), words)
                yield pd.DataFrame({
                    "row": rows["row"].to_numpy(np.int64), "node": _signatures(grams, sizes),
                    "size": sizes.astype(np.int32), "gram": np.int64(0), "summary": _summaries(grams, sizes),
                })
                waiting.append(grams)
                size += len(grams)
                if size >= _FLUSH:
                    yield repeated()
                    waiting, size = [], 0
        if waiting:
            yield repeated()

    return run


def required(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Least overlap of sets of sizes n and m that reach the similarity."""
    return -((-percent * (n + m)) // (100 + percent))


def _prefix(n, percent: int):
    """Grams of a set of n of which a similar set must hold one."""
    return n + (-percent * n) // 100 + 1


def _post(ranked: np.ndarray, ranks: np.ndarray, words: int, percent: int):
    """Postings ``key, node, size, place`` of the first grams of each set in the common order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows in _slices(batch):
                grams, sizes = gram_sets(rows["text"].tolist(), words)
                nodes = _signatures(grams, sizes)
                _, once = np.unique(nodes, return_index=True)
                of = np.repeat(np.arange(len(sizes)), sizes)
                keys = (grams >> np.uint64(64 - _HASH_BITS)).view(np.int64)
                if len(ranked):
                    at = np.minimum(np.searchsorted(ranked, grams), len(ranked) - 1)
                    keys = keys | (np.where(ranked[at] == grams, ranks[at], 0) << _HASH_BITS)
                order = np.lexsort((keys, of))
                of, keys = of[order], keys[order]
                place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                kept = (place < _prefix(sizes, percent)[of]) & np.isin(of, once)
                yield pd.DataFrame({
                    "key": keys[kept], "node": nodes[of[kept]], "size": sizes[of[kept]].astype(np.int32),
                    "place": place[kept].astype(np.int32),
                })

    return run


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by key and node, the distinct ones whose key has several nodes."""
    held = None
    last_key, last_node, last_kept = None, None, False
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        key, node = batch["key"].to_numpy(), batch["node"].to_numpy()
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        if last_key is not None and len(key):
            new[0] = key[0] != last_key or node[0] != last_node
        batch, key = batch[new], key[new]
        if not len(key):
            held = None
            continue
        before = np.zeros(len(key), bool)
        before[1:] = key[1:] == key[:-1]
        before[0] = last_key is not None and key[0] == last_key
        after = np.zeros(len(key), bool)
        after[:-1] = key[1:] == key[:-1]
        out, held = (before | after)[:-1], batch.iloc[[-1]]
        if len(key) > 1:
            last_key, last_node = key[-2], batch["node"].iloc[-2]
        last_kept = before[-1]
        yield batch.iloc[:-1][out]
    if held is not None and last_kept:
        yield held


def t_occurrence(lists: list[np.ndarray], least: int) -> dict[int, int]:
    """Numbers that occur in at least ``least`` of some sorted lists, and how often.

    The longest ``least - 1`` lists are set aside. What the short ones hold often enough is
    completed by binary search in the long ones. Short lists are merged by a heap, and
    counted in one array if they hold many numbers.
    """
    lists = sorted(lists, key=len)
    aside = min(least - 1, len(lists) - 1)
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    if sum(map(len, short)) <= _HEAP:
        found: dict[int, int] = {}
        for number in heapq.merge(*(x.tolist() for x in short)):
            found[number] = found.get(number, 0) + 1
        numbers, counts = np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))
    else:
        tally = np.bincount(np.concatenate(short))
        numbers = np.flatnonzero(tally)
        counts = tally[numbers]
    kept = counts >= least - aside
    numbers, counts = numbers[kept], counts[kept]
    for values in long:
        if not len(numbers):
            break
        at = np.minimum(np.searchsorted(values, numbers), len(values) - 1)
        counts = counts + (values[at] == numbers)
    kept = counts >= least
    return dict(zip(numbers[kept].tolist(), counts[kept].tolist(), strict=True))


def _search(cell: np.ndarray, crossing: bool, percent: int, most: int | None) -> Iterator[tuple[int, int]]:
    """Pairs of nodes of one cell that may be similar.

    A pair needs an overlap of which this list gives one gram; if it is their first common
    gram, only what follows it in both sets can give more. A similar pair passes in the cell
    of its first common gram. With ``most`` each node names only the others whose place is
    the earliest. Where one root holds most of a large cell, its nodes look at those of other
    roots alone.
    """
    order = np.lexsort((cell["node"], cell["size"]))
    node, size, place, root, block = (cell[name][order].astype(np.int64) for name in ("node", "size", "place", "root", "block"))
    left = size - place
    low = np.searchsorted(size, -((-percent * size) // 100))
    top, apart = None, np.zeros(0, np.int64)
    if len(node) >= _LARGE:
        roots, counts = np.unique(root, return_counts=True)
        if len(roots) == 1:
            return
        if 2 * counts.max() > len(node):
            top = roots[counts.argmax()]
            apart = np.flatnonzero(root != top)
    for i in range(1, len(node)):
        if low[i] == i:
            continue
        j = slice(low[i], i)
        if top is not None and root[i] == top:
            j = apart[np.searchsorted(apart, low[i]) : np.searchsorted(apart, i)]
        need = required(size[i], size[j], percent)
        good = (left[i] >= need) & (left[j] >= need) & (root[j] != root[i])
        if crossing:
            good &= block[j] != block[i]
        others = np.flatnonzero(good) + low[i] if isinstance(j, slice) else j[good]
        if most is not None and len(others) > most:
            others = others[np.argsort(place[others], kind="stable")[:most]]
        for other in others.tolist():
            a, b = int(node[i]), int(node[other])
            yield (a, b) if a < b else (b, a)


def _cells(percent: int, most: int | None):
    """Search the cells of sorted rows one after the other."""
    names = ["key", "i", "j", "node", "size", "place", "root", "block"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {name: [] for name in names}
        last = None

        def pairs(cells: list[tuple[dict, bool]]) -> pd.DataFrame:
            found = {pair for cell, crossing in cells for pair in _search(cell, crossing, percent, most)}
            return pd.DataFrame(sorted(found), columns=["a", "b"], dtype=np.int64)

        def joined() -> dict[str, np.ndarray]:
            return {name: np.concatenate(held[name]) for name in names}

        for batch in batches:
            columns = {name: batch[name].to_numpy() for name in names}
            n = len(batch)
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = np.any([columns[c][1:] != columns[c][:-1] for c in names[:3]], axis=0)
            new[0] = tuple(columns[c][0] for c in names[:3]) != last
            ready = []
            starts = np.flatnonzero(new)
            bounds = np.concatenate([[0], starts[starts > 0], [n]])
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                if new[start] and held["key"]:
                    cell = joined()
                    if len(cell["key"]) > 1:
                        ready.append((cell, bool(cell["i"][0] != cell["j"][0])))
                    held = {name: [] for name in names}
                for name in names:
                    held[name].append(columns[name][start:stop])
            last = tuple(columns[c][-1] for c in names[:3])
            yield pairs(ready)
        if held["key"]:
            cell = joined()
            yield pairs([(cell, bool(cell["i"][0] != cell["j"][0]))])

    return run


def _candidates(postings: DataFrame, roots: DataFrame | None, percent: int, most: int | None) -> DataFrame:
    """Distinct pairs ``a, b`` of nodes with a common list that may be similar."""
    rows = postings if roots is None else postings.join(roots, "node", "left")
    rows = rows.withColumn("root", F.col("node") if roots is None else F.coalesce("root", "node"))
    long = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    long = long.where(F.col("n") > BLOCK)
    # In a long list whose nodes are one component already there is no pair to find.
    blocks = F.when(F.col("low") == F.col("high"), 0).otherwise(F.ceil(F.col("n") / BLOCK))
    rows = rows.join(long, "key", "left").withColumn("blocks", F.coalesce(blocks, F.lit(1)).cast("int")).where("blocks > 0")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = rows.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "size", "place", "root", "block",
    )
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(_cells(percent, most), "a bigint, b bigint").distinct()


def _to_sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows in _slices(batch):
                grams, sizes = gram_sets(rows["text"].tolist(), words)
                yield pd.DataFrame({
                    "node": rows["node"].to_numpy(np.int64), "grams": np.split(grams.view(np.int64), np.cumsum(sizes)[:-1])
                })

    return run


def similar_to(own: np.ndarray, others: list[np.ndarray], percent: int) -> list[int]:
    """Places in ``others`` of the sets that are similar to ``own``, which is sorted."""
    need = [int(required(len(own), len(other), percent)) for other in others]
    grams, holders = [], []
    for i, other in enumerate(others):
        at = np.searchsorted(own, other)
        held = at[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] == other)]
        grams.append(held)
        holders.append(np.full(len(held), i))
    gram, holder = np.concatenate(grams), np.concatenate(holders)
    order = np.lexsort((holder, gram))
    cuts = np.flatnonzero(np.diff(gram[order])) + 1
    lists = [x for x in np.split(holder[order], cuts) if len(x)]
    if len(lists) < min(need):
        return []
    return [i for i, count in t_occurrence(lists, min(need)).items() if count >= need[i]]


def _check(percent: int, together: int = 64):
    """Search the candidates of each node, which follow its own set, some at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, own, ids, sets = None, None, [], []

        def links() -> list[tuple[int, int]]:
            found = [(node, ids[i]) for i in similar_to(own, sets, percent)] if ids else []
            ids.clear()
            sets.clear()
            return found

        for batch in batches:
            out = []
            for a, kind, b, grams in zip(batch["a"], batch["kind"], batch["b"], batch["grams"], strict=True):
                if kind == 0:
                    out += links()
                    node, own = int(a), np.sort(grams)
                else:
                    ids.append(int(b))
                    sets.append(grams)
                    if len(ids) >= together:
                        out += links()
            yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
        yield pd.DataFrame(links(), columns=["a", "b"], dtype=np.int64)

    return run


def _possible(percent: int):
    """Pairs whose summaries leave room for the overlap they need."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                bound = overlap_bound(x, y)
                kept.append(bound is None or bound[0] >= required(bound[1], bound[2], percent))
            yield batch.loc[kept, ["a", "b"]]

    return run


def _links(
    pairs: DataFrame, texts: DataFrame, holders: DataFrame, summaries: DataFrame, words: int, percent: int
) -> DataFrame:
    """The pairs whose whole sets are similar; sets are made of the nodes in pairs alone."""
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    short = asked.join(holders, "node").join(summaries, "row").select("node", "summary")
    both = pairs.join(short.select(F.col("node").alias("a"), F.col("summary").alias("x")), "a").join(
        short.select(F.col("node").alias("b"), F.col("summary").alias("y")), "b"
    )
    pairs = durable(both.select("a", "b", "x", "y").mapInPandas(_possible(percent), "a bigint, b bigint"))
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = asked.join(holders, "node")
    rows = texts.join(wanted, "row").select("node", "text")
    sets = durable(rows.mapInPandas(_to_sets(words), "node bigint, grams array<bigint>"))
    own = sets.join(pairs.select(F.col("a").alias("node")).distinct(), "node").select(
        F.col("node").alias("a"), F.lit(0).alias("kind"), F.col("node").alias("b"), "grams"
    )
    others = pairs.join(sets.withColumnRenamed("node", "b"), "b").select("a", F.lit(1).alias("kind"), "b", "grams")
    # A node has few candidates in the first pass; in the second those of other components.
    rows = own.unionByName(others).repartition("a").sortWithinPartitions("a", "kind")
    return durable(rows.mapInPandas(_check(percent), "a bigint, b bigint"))


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id`` per row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest doc_id reachable by links, the document's own included.
    A null text or one without words has an empty set and no link. Repeated rows have equal
    sets and so one component; a null doc_id is larger than all others and is the component
    of its own only. ``mark`` is a hash of the text.
    """
    spark = docs.sparkSession
    # Equal rows share a number, so that it survives being computed again.
    row = F.xxhash64("doc_id", "text")
    texts = docs.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    profile = durable(texts.mapInPandas(_profile(words), "row bigint, node bigint, size int, gram bigint, summary binary"))
    documents = profile.where("row != -1 OR gram = 0")
    rows = documents.select("row", "node", "size")
    frequent = (
        profile.where("row = -1 AND gram != 0").groupBy("gram").agg(F.sum("size").alias("n"))
        .orderBy(F.col("n").desc(), "gram").limit(RANKED)
    )
    # At most RANKED grams come to the driver; they only set the order of the lists.
    ranked = frequent.toPandas()
    grams = ranked["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    ranks = np.minimum(np.log2(ranked["n"].to_numpy(float)).astype(np.int64), 2 ** (63 - _HASH_BITS) - 1)
    table = spark.sparkContext.broadcast((grams[order], ranks[order]))

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _post(*table.value, words, percent)(batches)

    posted = texts.mapInPandas(post, "key bigint, node bigint, size int, place int")
    postings = durable(posted.repartition("key").sortWithinPartitions("key", "node").mapInPandas(_shared, posted.schema))
    holders = rows.where("size > 0").groupBy("node").agg(F.min("row").alias("row"))
    summaries = documents.select("row", "summary").dropDuplicates(["row"])
    texts = texts.dropDuplicates(["row"]) if _has_repeats(rows) else texts

    first = _links(durable(_candidates(postings, None, percent, 2)), texts, holders, summaries, words, percent)
    roots = connected_components(first.select(F.col("a").alias("u"), F.col("b").alias("v")))
    second = _links(durable(_candidates(postings, roots, percent, None)), texts, holders, summaries, words, percent)
    links = first.union(second).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = connected_components(links)

    ids = docs.select("doc_id", row.alias("row"), F.xxhash64("text").alias("mark"))
    facts = rows.dropDuplicates(["row"]).join(roots, "node", "left").select(
        "row", F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("size") > 0, F.coalesce("root", "node")).alias("root"),
    )
    placed = durable(ids.join(facts, "row"))
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    return join_spread(placed, durable(least), "root", "left").select(
        "doc_id", "mark", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def _has_repeats(rows: DataFrame) -> bool:
    return bool(rows.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())
