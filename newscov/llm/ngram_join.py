"""Near-duplicate documents: Jaccard join over word n-grams by a MinHash LSH forest."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newscov.llm.common import components, freeing, give_back, numbered, pieces, stored, with_components, working_columns

#: Words of a shingle and the similarity from which documents are linked.
WORDS = 5
THRESHOLD = 0.8
#: Prefix trees, the hashes a tree's label may have at most, and the share of links to be found.
TREES = 24
LONGEST = 6
TARGET_RECALL = 0.9999
SEED = 7
#: Documents and shingles that a block of a large group holds on average.
BLOCK_DOCS = 1_024
BLOCK_SHINGLES = 2_000_000
#: Word hashes a task remembers, rows hashed at once, and shingles multiplied at once.
REMEMBERED = 300_000
HASHED_AT_ONCE = 2_048
COLUMNS_AT_ONCE = 4_096
#: Text that a task turns into shingles at once; a longer one comes alone.
BATCH_BYTES = 8 << 20
#: Bytes of a block pair from which its memory is handed back before the next.
LARGE_GROUP = 8 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a limit."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingles(text: str | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one shingle.

    Words are what white space separates. A text without words has no shingles.
    """
    found = text.split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    runs = max(1, len(ids) - words + 1)
    value = np.full(runs, min(words, len(ids)), np.uint64)
    for k in range(min(words, len(ids))):
        value = (value ^ ids[k : k + runs]) * MIX
        value ^= value >> np.uint64(32)
    return np.unique(value)


def missed_share(similarity, length: int, trees: int):
    """The chance that a pair shares no prefix of ``length`` hashes in any tree.

    A pair with similarity t shares one in one tree with probability t ** length.
    """
    return (1 - similarity**length) ** trees


def label_length(threshold: float, trees: int, longest: int, recall: float) -> int:
    """The longest label that finds a pair at the threshold with the target recall: where every class starts."""
    for k in range(longest, 0, -1):
        if 1 - missed_share(threshold, k, trees) >= recall:
            return k
    raise ValueError("too few trees for this recall")


def prefix_lengths(found: DataFrame, threshold: float, trees: int, start: int, recall: float) -> DataFrame:
    """``(node, length)``: how far the prefix of a class must be shortened, given its partners found so far.

    For a partner found with probability p, (1 - p) / p like it are expected to be missed, and one at the
    threshold is always reckoned with. The length is the longest at which no more than ``1 - recall``
    partners are expected to be missed. ``found`` holds ``missed``, an array by length from 1; classes
    without links keep the longest.
    """
    sums = [F.sum(F.element_at("missed", k)).alias(f"missed_{k}") for k in range(1, start + 1)]
    met = [
        F.when(F.col(f"missed_{k}") + missed_share(threshold, k, trees) <= 1 - recall, k) for k in range(start, 1, -1)
    ]
    return found.groupBy("node").agg(*sums).select("node", F.coalesce(*met, F.lit(1)).alias("length"))


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return (random.integers(0, 1 << 63, n, np.uint64) << np.uint64(1)) | np.uint64(1), random.integers(0, 1 << 63, n, np.uint64)


def min_hashes(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """16 bits of the minimum of each hash function over the shingles, in big-endian order."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), HASHED_AT_ONCE):
        values = found[at : at + HASHED_AT_ONCE, None] * factors
        values += offsets
        np.minimum(least, values.min(axis=0), out=least)
    least *= MIX  # which shingle it was, spread over the upper bits
    return (least >> np.uint64(48)).astype(">u2")


def _sign(words: int, trees: int, longest: int, seed: int):
    """Digest of the shingle set, its size and the labels of all trees."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        factors, offsets = _coefficients(trees * longest, seed)
        for batch in pieces(batches, "text", BATCH_BYTES):
            keys, counts, labels = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), hashes, words)
                keys.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                counts.append(len(found))
                labels.append(min_hashes(found, factors, offsets).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(counts, pa.int32()), pa.array(labels, pa.binary())],
                ["id", "key", "n", "labels"],
            )

    return sign


def _walk(width: int):
    """Of rows sorted by tree and label, links each to the first that shares its prefix of ``width`` bytes.

    Links do not reach over the ends of a partition: its first and last row come out as well,
    with their tree and prefix and without a partner.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray | None, tree: list | None = None, prefix: list | None = None) -> pa.RecordBatch:
            n = len(a)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(a, pa.int64()), pa.array(b, pa.int64()) if b is not None else pa.nulls(n, pa.int64()),
                    pa.array(tree, pa.int32()) if tree else pa.nulls(n, pa.int32()),
                    pa.array(prefix, pa.binary()) if prefix else pa.nulls(n, pa.binary()),
                ],
                ["a", "b", "tree", "prefix"],
            )

        head, last = None, None  # tree, prefix and id of the first row of the run; of the last row
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            trees, ids = batch.column("tree").to_numpy(), batch.column("node").to_numpy()
            size = len(batch.column("label")[0].as_py())
            labels = np.frombuffer(b"".join(batch.column("label").to_pylist()), np.uint8).reshape(n, size)[:, :width]
            same = np.zeros(n, bool)
            same[1:] = (trees[1:] == trees[:-1]) & (labels[1:] == labels[:-1]).all(axis=1)
            first = (int(trees[0]), labels[0].tobytes(), int(ids[0]))
            if head is None:
                yield out(ids[:1], None, [first[0]], [first[1]])
                head = first
            same[0] = first[:2] == head[:2]
            starts = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
            heads = np.where(starts < 0, head[2], ids[starts])
            linked = heads != ids
            if linked.any():
                yield out(ids[linked], heads[linked])
            head = (int(trees[-1]), labels[-1].tobytes(), int(heads[-1]))
            last = (int(trees[-1]), labels[-1].tobytes(), int(ids[-1]))
        if last is not None:
            yield out(np.array([last[2]]), None, [last[0]], [last[1]])

    return walk


def candidate_links(classes: DataFrame, width: int, trees: int, longest: int) -> DataFrame:
    """``(a, b)`` of classes that share a label prefix in some tree, a few per class and tree.

    All labels of all trees are sorted once over range partitions: the tries of the forest, in
    which a subtree is a run of rows. However many rows share a prefix, they spread over
    partitions, and each is linked to one other row only.
    """
    size = 2 * longest
    number = F.sequence(F.lit(0), F.lit(trees - 1))
    leaves = classes.select("node", "labels", F.explode(number).alias("tree")).select(
        "tree", F.substring("labels", F.col("tree") * size + 1, F.lit(size)).alias("label"), "node"
    )
    order = ["tree", "label", "node"]
    leaves = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    walked = leaves.mapInArrow(freeing(_walk(width)), "a LONG, b LONG, tree INT, prefix BINARY")
    walked = stored(walked, "forest-links")
    # two rows per partition are left: where a run goes on in the next one
    along = Window.orderBy("tree", "prefix", "a")
    ends = walked.where("b IS NULL").withColumns({
        "before": F.lag("a").over(along),
        "same": (F.lag("tree").over(along) == F.col("tree")) & (F.lag("prefix").over(along) == F.col("prefix")),
    })
    over_ends = ends.where("same AND a <> before").select("a", F.col("before").alias("b"))
    return walked.where("b IS NOT NULL").select("a", "b").unionByName(over_ends)


def _shingled(words: int):
    """Shingles of the documents that stand for their class."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches, "text", BATCH_BYTES):
            keep, data = [], []
            for i, (text, key) in enumerate(zip(batch.column("text"), batch.column("key").to_pylist())):
                found = shingles(text.as_py(), hashes, words)
                if hashlib.md5(found.tobytes()).digest() == key:  # not another text under the same id
                    keep.append(i)
                    data.append(found.tobytes())
            rest = batch.drop_columns(["text"]).take(pa.array(keep, pa.int64()))
            yield rest.append_column("shingles", pa.array(data, pa.binary()))

    return shingle


def common_shingles(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of ``a`` shares with each of ``b``; both hold sorted distinct hashes."""
    inside = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    counts = np.zeros((len(a), len(b)), np.float32)

    def places(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        at = np.searchsorted(inside, every)
        at[at == len(inside)] = 0
        known = inside[at] == every
        order = np.argsort(at[known], kind="stable")
        return row[known][order], at[known][order]

    if not len(inside):
        return counts
    (row_a, at_a), (row_b, at_b) = places(a), places(b)
    for first in range(0, len(inside), COLUMNS_AT_ONCE):
        width = min(COLUMNS_AT_ONCE, len(inside) - first)
        parts = []
        for row, at, n in ((row_a, at_a, len(a)), (row_b, at_b, len(b))):
            low, high = np.searchsorted(at, [first, first + width])
            part = np.zeros((n, width), np.float32)
            part[row[low:high], at[low:high] - first] = 1
            parts.append(part)
        counts += parts[0] @ parts[1].T
    return counts


def _similarities(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    counts = common_shingles(a, b).astype(np.float64)
    sizes = [np.array([len(r) for r in side], np.float64) for side in (a, b)]
    return counts / (sizes[0][:, None] + sizes[1][None, :] - counts)


def _verify(threshold: float, trees: int, start: int):
    """Exact links between two blocks of a group, or within one: a row per linked class.

    ``missed`` adds up over its partners what a search at each prefix length misses for one it finds.
    """

    def verify(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        seen, sides = set(), {i: [], j: []}
        for block, node, key, copies, data in zip(
            *[group[c].to_pylist() for c in ("block", "node", "key", "copies", "shingles")]
        ):
            if key not in seen:  # a row of the input may be there twice
                seen.add(key)
                sides[block].append((node, copies, np.frombuffer(data, np.uint64)))
        left, right = sides[i], sides[j]
        empty = np.zeros(0, np.int64)
        if not left or not right or (i == j and len(left) < 2):
            return pa.table({"node": empty, "links": empty, "root": empty, "missed": pa.array([], pa.list_(pa.float64()))})
        near = _similarities([r[2] for r in left], [r[2] for r in right])
        links = near >= threshold
        names = [np.array([r[0] for r in side], np.int64) for side in (left, right)]
        copies = [np.array([r[1] for r in side], np.int64) for side in (left, right)]
        if i == j:
            np.fill_diagonal(links, False)
        missed = []
        for k in range(1, start + 1):
            share = missed_share(near, k, trees)
            odds = np.divide(share, 1 - share, out=np.zeros_like(near), where=links)
            missed.append(odds.sum(axis=1) if i == j else np.concatenate([odds.sum(axis=1), odds.sum(axis=0)]))
        if i == j:
            linked, nodes = links @ copies[1], names[0]
            graph = links
        else:
            linked = np.concatenate([links @ copies[1], copies[0] @ links])
            nodes = np.concatenate(names)
            graph = np.zeros((len(nodes), len(nodes)), bool)
            graph[: len(left), len(left) :] = links
            graph |= graph.T
        order = np.argsort(nodes, kind="stable")
        graph, roots = graph[order][:, order], np.arange(len(nodes))
        np.fill_diagonal(graph, True)
        while True:  # the smallest place that each can reach
            low = np.array([roots[row].min() for row in graph])
            low = low[low]
            if (low == roots).all():
                break
            roots = low
        root = np.empty(len(nodes), np.int64)
        root[order] = nodes[order][roots]
        at = np.flatnonzero(linked)
        missed = pa.array(list(np.array(missed).T[at]), pa.list_(pa.float64()))
        return pa.table({"node": nodes[at], "links": linked[at], "root": root[at], "missed": missed})

    return verify


def _meet(threshold: float, width: int, size: int):
    """Links between two blocks of a prefix run, or within one: ``(a, b, similarity)``.

    Compared are pairs of which one side still looks for partners. Pairs of one group were compared
    before, and pairs that share a prefix in an earlier tree are that tree's.
    """

    def meet(group: pa.Table) -> pa.Table:
        i, j, tree = (group[c][0].as_py() for c in ("i", "j", "tree"))
        names = ("block", "node", "part", "looks", "labels", "shingles")
        seen, sides = set(), {i: [], j: []}
        for block, node, *more in zip(*[group[c].to_pylist() for c in names]):
            if node not in seen:  # a row of the input may be there twice
                seen.add(node)
                sides[block].append((node, *more))
        left, right = sides[i], sides[j]
        if not left or not right:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})
        node, part = ([np.array([r[c] for r in side], np.int64) for side in (left, right)] for c in (0, 1))
        looks = [np.array([r[2] for r in side], bool) for side in (left, right)]
        wanted = (part[0][:, None] != part[1][None, :]) & (looks[0][:, None] | looks[1][None, :])
        if i == j:
            wanted = np.triu(wanted, 1)
        for before in range(tree):
            at = slice(before * size, before * size + width)
            one, other = ([r[3][at] for r in side] for side in (left, right))
            places = {prefix: n for n, prefix in enumerate(dict.fromkeys(one + other))}
            wanted &= np.array([places[p] for p in one])[:, None] != np.array([places[p] for p in other])[None, :]
        rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        near = np.zeros((0, 0))
        if len(rows):
            data = ([np.frombuffer(side[n][4], np.uint64) for n in at] for side, at in ((left, rows), (right, columns)))
            near = _similarities(*data) * wanted[np.ix_(rows, columns)]
        a, b = np.nonzero(near >= threshold)
        return pa.table({"a": node[0][rows[a]], "b": node[1][columns[b]], "similarity": near[a, b]})

    return meet


def _freeing_groups(compare: Callable[[pa.Table], pa.Table]):
    """``compare`` for applyInArrow, with the memory of large groups handed back after each."""

    def run(group: pa.Table) -> pa.Table:
        found = compare(group)
        if group.nbytes >= LARGE_GROUP:
            give_back()
        return found

    return run


def shorter_links(
    rows: DataFrame, classes: DataFrame, groups: DataFrame, looking: DataFrame, length: int, size: int,
    trees: int, words: int, threshold: float,
) -> DataFrame:
    """Links ``(a, b, similarity)`` between groups that the nodes of ``looking`` find at a prefix of ``length`` hashes.

    Only runs of a tree that hold such a node and more than one group are compared, large ones in blocks.
    """
    width = 2 * length

    def leaves(nodes: DataFrame) -> DataFrame:
        number = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
        return nodes.select("*", number).withColumn("prefix", F.substring("labels", F.col("tree") * size + 1, F.lit(width)))

    looking = stored(looking.select("node", F.lit(True).alias("looks")), "forest-looking")
    known = classes.select("node", "n", "labels").join(groups, "node", "left").join(looking, "node", "left").select(
        "node", "n", "labels", F.coalesce("component", "node").alias("part"), F.coalesce("looks", F.lit(False)).alias("looks")
    )
    # runs that hold a looking class; written first, so that Spark knows their size and, where they are few,
    # filters the leaves before it shuffles any
    asked = stored(leaves(classes.join(looking, "node")).select("tree", "prefix").distinct(), "forest-asked")
    runs = stored(leaves(known).drop("labels").join(asked, ["tree", "prefix"]), "forest-runs")
    sizes = runs.groupBy("tree", "prefix").agg(
        F.min("part").alias("low"), F.max("part").alias("high"),
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
    ).where("low < high").drop("low", "high")
    members = runs.drop("n").join(sizes, ["tree", "prefix"])
    members = stored(members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "forest-mates")
    nodes = stored(members.select("node").distinct(), "forest-nodes")
    # narrow, so that few of them pick their texts without a shuffle of all texts
    wanted = stored(classes.select("node", "key", "rep").join(nodes, "node"), "forest-wanted")
    texts = rows.join(wanted, rows["id"] == wanted["rep"]).select("text", "key", "node")
    texts = texts.mapInArrow(freeing(_shingled(words)), "key BINARY, node LONG, shingles BINARY").drop("key")
    texts = texts.join(classes.select("node", "labels").join(nodes, "node"), "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = members.join(texts, "node").withColumn("other", other).withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other")
    })
    met = paired.drop("blocks", "other").groupBy("tree", "prefix", "i", "j").applyInArrow(
        _freeing_groups(_meet(threshold, width, size)), "a LONG, b LONG, similarity DOUBLE"
    )
    return stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").distinct(), "forest-met")


def _both_ways(met: DataFrame, classes: DataFrame, trees: int, start: int) -> DataFrame:
    """Pairs ``met`` as the rows ``_verify`` gives: node, links, root and missed."""
    share = lambda k: F.pow(1 - F.pow(F.col("similarity"), F.lit(k)), F.lit(trees))
    ends = met.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "similarity")
    ends = ends.select(F.col("p.a").alias("node"), F.col("p.b").alias("mate"), "similarity")
    copies = classes.select(F.col("node").alias("mate"), F.col("copies").alias("links"))
    return ends.join(copies, "mate").select(
        "node", "links", F.least("node", "mate").alias("root"),
        F.array(*[share(k) / (1 - share(k)) for k in range(1, start + 1)]).alias("missed"),
    )


def near_documents(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    trees: int = TREES,
    longest: int = LONGEST,
    target_recall: float = TARGET_RECALL,
    seed: int = SEED,
) -> DataFrame:
    """``(id, class_id, n_links, component_id, kept)`` of every row.

    Links join documents whose sets of ``words``-word shingles have a Jaccard similarity of at
    least ``threshold``. ``class_id`` is the smallest id with the same set, ``n_links`` counts the
    other documents linked directly, copies included, ``component_id`` is the smallest id links
    lead to, and ``kept`` marks it.

    Documents with equal sets are one class from the start. Labels are as long as a pair at the
    threshold allows to be found with ``target_recall``. Classes that share a label in some tree of
    the forest form groups; in a group, every pair is compared exactly, in blocks if it is large, and
    a block returns a row per linked class. Then every class whose partners found so far let it expect
    more than ``1 - target_recall`` missed ones (``prefix_lengths``) climbs its tries: its prefix is
    shortened by a hash at a time, and it is compared with the other groups in the runs it falls into
    (``shorter_links``), until its recall is met. Classes without links or with close ones stay.

    Null texts and texts without words have no shingles and link with nothing; a text with fewer
    words is one shingle. Rows with a null id link with nothing. Rows that share an id are separate
    documents. An empty table gives an empty result. Other columns are not read.
    """
    start = label_length(threshold, trees, longest, target_recall)
    rows = working_columns(docs, id=id_column, text=text_column).withColumn("id", F.col("id").cast("long"))
    signed = rows.mapInArrow(freeing(_sign(words, trees, start, seed)), "id LONG, key BINARY, n INT, labels BINARY")
    signed = stored(signed, "forest-labels")
    known = signed.where("key IS NOT NULL AND id IS NOT NULL")
    classes = numbered(
        known.groupBy("key").agg(
            F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("n").alias("n"),
            F.any_value("labels").alias("labels"),
        ),
        "forest-classes",
    )
    groups = components(candidate_links(classes, 2 * start, trees, start), "forest-groups")
    members = classes.select("node", "key", "rep", "copies", "n").join(groups, "node")
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    members = members.join(sizes, "component")
    members = stored(members.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")), "forest-members")

    # a merge join at every size, as members grow with the documents
    texts = rows.join(members.drop("n").hint("merge"), rows["id"] == members["rep"]).select(
        "text", "key", "node", "copies", "component", "blocks", "block"
    )
    texts = texts.mapInArrow(
        freeing(_shingled(words)), "key BINARY, node LONG, copies LONG, component LONG, blocks INT, block INT, shingles BINARY"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = texts.withColumn("other", other).withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other")
    })
    found = paired.drop("blocks", "other").groupBy("component", "i", "j").applyInArrow(
        _freeing_groups(_verify(threshold, trees, start)), "node LONG, links LONG, root LONG, missed ARRAY<DOUBLE>"
    )
    found = stored(found, "forest-verified")
    every, met = found, None
    for length in range(start - 1, 0, -1):
        lengths = prefix_lengths(every, threshold, trees, start, target_recall)
        looking = lengths.where(F.col("length") <= length)
        if looking.isEmpty():
            break
        more = shorter_links(rows, classes, groups, looking, length, 2 * start, trees, words, threshold)
        met = more if met is None else met.unionByName(more).distinct()
        every = found.unionByName(_both_ways(met, classes, trees, start))
    found = every.drop("missed")

    known = with_components(classes, found, "forest-components")
    key = F.when(F.col("id").isNotNull(), F.col("key"))
    result = signed.select("id", key.alias("key")).join(known, "key", "left")
    links = F.when(F.col("copies").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    return result.select(
        F.col("id").alias(id_column),
        F.coalesce("rep", "id").alias("class_id"),
        F.coalesce(links, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "id").alias("component_id"),
    ).withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
