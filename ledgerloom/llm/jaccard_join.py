"""Jaccard join of shingle sets by blocked sparse products, and its components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import forget, pieces, share, written
from ledgerloom.llm.components import components
from ledgerloom.llm.hashing import Shingler, mixed


def signature(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles in each bit; about a bit for each shingle.

    Two sets differ in at least as many shingles as their signatures do in bits. A
    longer signature is cut to a shorter one by adding its halves.
    """
    bits = 256
    while bits < len(shingles):
        bits *= 2
    return np.packbits(np.bincount((mixed(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def folded(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[1] > words:
        rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
    return rows


def alike(sizes: np.ndarray, signatures: list[bytes], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """For each set the first that it reaches over pairs whose sizes and signatures admit a link; with sides, only over pairs of two."""
    n = len(sizes)
    side = np.arange(n) if side is None else side
    length = np.array([len(s) // 8 for s in signatures])
    at = {w: np.flatnonzero(length == w) for w in np.unique(length).tolist()}
    rows = {w: np.frombuffer(b"".join(signatures[i] for i in x), np.uint64).reshape(-1, w) for w, x in at.items()}
    cut = {(w, v): folded(r, v) for w, r in rows.items() for v in at if v <= w}
    place = np.zeros(n, np.int64)
    for x in at.values():
        place[x] = np.arange(len(x))
    reached, root = np.zeros(n, bool), np.arange(n)
    for seed in range(n):
        if reached[seed]:
            continue
        reached[seed], todo = True, [seed]
        while todo:
            i = todo.pop()
            w = int(length[i])
            for v, x in at.items():
                x = x[~reached[x] & (side[x] != side[i])]
                x = x[(100 * sizes[x] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[x])]
                if len(x):
                    u = min(v, w)
                    far = np.bitwise_count(cut[v, u][place[x]] ^ cut[w, u][place[i]]).sum(1, dtype=np.int64)
                    x = x[far * (100 + percent) <= (sizes[x] + sizes[i]) * (100 - percent)]
                    reached[x], root[x] = True, seed
                    todo.extend(x.tolist())
    return root


def class_of(shingles: np.ndarray) -> int | None:
    """A number for all texts of one set."""
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), np.uint64).view(np.int64)) if len(shingles) else None


def prefix_length(n: np.ndarray, percent: int):
    """So many of a set's rarest shingles hold one that any partner has among its own, too."""
    return n - -(-percent * n // 100) + 1


class Order:
    """A total order of shingles: those known to be frequent come last, by their frequency."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray):
        at = np.argsort(frequent)
        self.frequent, self.counts = frequent[at], counts[at]

    def prefix(self, shingles: np.ndarray, n: int) -> np.ndarray:
        """The first n shingles in order."""
        count = np.zeros(len(shingles), np.int64)
        if len(self.frequent):
            slot = np.searchsorted(self.frequent, shingles).clip(max=len(self.frequent) - 1)
            count = np.where(self.frequent[slot] == shingles, self.counts[slot], 0)
        return shingles[np.argsort(count, kind="stable")[:n]]


class Common:
    """Counts of the shingles of a task's classes, in bounded space.

    Sets are gathered and counted; of more than 2 * `most` shingles the `most` most
    frequent are kept, so one that a larger share of the sets holds is not lost.
    Counts decide on the order of shingles alone.
    """

    def __init__(self, most: int):
        self.most, self.size, self.waiting = most, 0, []
        self.token, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, sets) -> None:
        for s in sets:
            self.waiting.append(s)
            self.size += len(s)
            if self.size > self.most:
                self.merge()

    def merge(self) -> None:
        token, count = np.unique(np.concatenate([*self.waiting, np.zeros(0, np.uint64)]), return_counts=True)
        self.waiting, self.size = [], 0
        if len(self.token):
            flat = np.concatenate([self.token, token])
            order = np.argsort(flat, kind="stable")
            flat, both = flat[order], np.concatenate([self.count, count])[order]
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            token, count = flat[first], np.add.reduceat(both, first)
        if len(token) > 2 * self.most:
            kept = np.sort(np.argpartition(-count, self.most)[: self.most])
            token, count = token[kept], count[kept]
        self.token, self.count = token, count

    def often(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(shingles, counts) of up to `most` that came twice at least, the most frequent ones."""
        self.merge()
        at = np.flatnonzero(self.count > 1)
        at = at[np.argsort(-self.count[at], kind="stable")[:most]]
        return self.token[at], self.count[at].astype(np.int64)


def link(sets: list[np.ndarray], percent: int, label: np.ndarray | None = None) -> np.ndarray:
    """For each set the first one that it reaches over links, of all that are here.

    The incidence of texts and shingles is a sparse matrix; a row's product with the
    rows not yet reached counts the shingles they share. Only rows that share one of
    the row's rarest shingles and whose size admits a link are multiplied, and pairs
    below the overlap that their sizes ask for are dropped at once. A row leaves the
    matrix when it is reached. label: rows of one label are known to be linked.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    order = np.lexsort((token, df[token], row))
    token = token[order]
    ptr = np.concatenate([[0], np.cumsum(size)])
    first = np.arange(len(token)) - ptr[row] < prefix_length(size, percent)[row]
    first &= df[token] > 1
    by = np.argsort(token[first], kind="stable")
    posting, posted = row[first][by], np.searchsorted(token[first][by], np.arange(len(df) + 1))
    reached, root = np.zeros(n, bool), np.arange(n)
    alike: dict[int, list[int]] = {}
    if label is not None:
        for i, k in enumerate(label.tolist()):
            alike.setdefault(k, []).append(i)
    mark = np.zeros(len(df), bool)
    for seed in range(n):
        if reached[seed]:
            continue
        reached[seed], todo = True, [seed]
        while todo:
            i = todo.pop()
            new = np.zeros(0, np.int64)
            own = token[ptr[i] : ptr[i + 1]]
            rare = own[: int(prefix_length(size[i], percent))]
            rare = rare[df[rare] > 1]
            if len(rare):
                near = np.unique(np.concatenate([posting[posted[t] : posted[t + 1]] for t in rare.tolist()]))
                near = near[~reached[near] & (100 * size[near] >= percent * size[i]) & (100 * size[i] >= percent * size[near])]
                if len(near):
                    mark[own] = True
                    held = np.concatenate([token[ptr[j] : ptr[j + 1]] for j in near.tolist()])
                    shared = np.add.reduceat(mark[held], np.concatenate([[0], np.cumsum(size[near])[:-1]]), dtype=np.int64)
                    mark[own] = False
                    new = near[100 * shared >= percent * (size[i] + size[near] - shared)]
            if label is not None:
                new = np.concatenate([new, [j for j in alike.pop(int(label[i]), []) if not reached[j]]]).astype(np.int64)
                new = np.unique(new)
            reached[new], root[new] = True, seed
            todo.extend(new.tolist())
    return root


def pairs(sets: list[np.ndarray], percent: int, side: list | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(set, later sets linked to it, which of these join sets not yet joined) for all links, each once.

    As in link(), but a row's product is with all later rows. side: rows of one side
    are not compared; rows without a side are.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    token = token[np.lexsort((token, df[token], row))]
    ptr = np.concatenate([[0], np.cumsum(size)])
    first = np.arange(len(token)) - ptr[row] < prefix_length(size, percent)[row]
    first &= df[token] > 1
    by = np.argsort(token[first], kind="stable")
    posting, posted = row[first][by], np.searchsorted(token[first][by], np.arange(len(df) + 1))
    number: dict = {}
    sides = None if side is None else np.array([-1 if x is None else number.setdefault(x, len(number)) for x in side], np.int64)
    label, together = np.arange(n), {i: [i] for i in range(n)}
    mark = np.zeros(len(df), bool)
    for i in range(n):
        own = token[ptr[i] : ptr[i + 1]]
        rare = own[: int(prefix_length(size[i], percent))]
        rare = rare[df[rare] > 1]
        if not len(rare):
            continue
        near = np.unique(np.concatenate([posting[posted[t] : posted[t + 1]] for t in rare.tolist()]))
        near = near[(near > i) & (100 * size[near] >= percent * size[i]) & (100 * size[i] >= percent * size[near])]
        if sides is not None and sides[i] >= 0:
            near = near[sides[near] != sides[i]]
        if not len(near):
            continue
        mark[own] = True
        found = []
        for x in np.split(near, np.arange(256, len(near), 256)):
            held = np.concatenate([token[ptr[j] : ptr[j + 1]] for j in x.tolist()])
            shared = np.add.reduceat(mark[held], np.concatenate([[0], np.cumsum(size[x])[:-1]]), dtype=np.int64)
            found.append(x[100 * shared >= percent * (size[i] + size[x] - shared)])
        mark[own] = False
        found = np.concatenate(found)
        if len(found):
            joins = np.zeros(len(found), bool)
            other, at = np.unique(label[found], return_index=True)
            mine = int(label[i])
            for k, where in zip(other.tolist(), at.tolist()):
                if k != mine:
                    joins[where] = True
                    if len(together[k]) > len(together[mine]):
                        k, mine = mine, k
                    label[together[k]] = mine
                    together[mine] += together.pop(k)
            yield i, found, joins


def linked_blocks(batches, shingler: Shingler, percent: int):
    """(a, b) for all links from rows (block, c, label, text), sorted by block; the rows of a block are together."""
    for rows in blocked(batches):
        classes, sets, labels = distinct_sets(rows, shingler)
        c, held, size = np.array(classes, np.int64), ([], []), 0
        for i, found, _ in pairs(sets, percent, labels if any(k is not None for k in labels) else None):
            held[0].append(np.full(len(found), c[i]))
            held[1].append(c[found])
            size += len(found)
            if size >= 1 << 18:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in held], names=["a", "b"])
                held, size = ([], []), 0
        if size:
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in held], names=["a", "b"])


def counted_blocks(batches, shingler: Shingler, percent: int):
    """As linked_blocks, but of all links only (a, b, null) for those that hold components together and (a, null, rows that a links to)."""
    for rows in blocked(batches):
        classes, sets, labels = distinct_sets(rows, shingler)
        weight = {r[0]: r[3] for r in rows}
        weight = np.array([weight[c] for c in classes], np.int64)
        near, joined, c = np.zeros(len(classes), np.int64), ([], []), np.array(classes, np.int64)
        for i, found, joins in pairs(sets, percent, labels if any(k is not None for k in labels) else None):
            near[i] += weight[found].sum()
            near[found] += weight[i]
            joined[0].extend([i] * int(joins.sum()))
            joined[1].extend(found[joins].tolist())
        at, none = np.flatnonzero(near), len(joined[0])
        a = pa.array(np.concatenate([c[np.array(joined[0], np.int64)], c[at]]), pa.int64())
        b = pa.concat_arrays([pa.array(c[np.array(joined[1], np.int64)], pa.int64()), pa.nulls(len(at), pa.int64())])
        yield pa.record_batch([a, b, pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(near[at], pa.int64())])], names=["a", "b", "near"])


def blocked(batches) -> Iterator[list[tuple]]:
    """The rows (c, label, text, rows of the class if given) of each block."""
    held, rows = None, []
    for b in batches:
        more = [b.column("rows").to_pylist()] if "rows" in b.schema.names else []
        for k, c, label, t, *x in zip(b.column("block").to_pylist(), b.column("c").to_pylist(), b.column("label").to_pylist(), b.column("text"), *more):
            if k != held and rows:
                yield rows
                rows = []
            held = k
            rows.append((c, label, t.as_py(), *x))
    if rows:
        yield rows


def distinct_sets(rows: list[tuple], shingler: Shingler) -> tuple[list[int], list[np.ndarray], list]:
    """Classes, their sets and labels, each class once."""
    seen, classes, sets, labels = set(), [], [], []
    for (c, k, *_), s in zip(rows, shingler.sets([r[2] for r in rows])):
        if c not in seen and class_of(s) == c:  # another text may have the same id
            seen.add(c)
            classes.append(c)
            sets.append(s)
            labels.append(k)
    return classes, sets, labels


def blocks(batches, shingler: Shingler, percent: int):
    """(c, root) links from rows (block, c, label, text), sorted by block; the rows of a block are together."""
    for rows in blocked(batches):
        classes, sets, labels = distinct_sets(rows, shingler)
        root = link(sets, percent, np.array(labels, np.int64) if labels and labels[0] is not None else None)
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield pa.record_batch([pa.array([classes[i] for i in moved], pa.int64()), pa.array([classes[root[i]] for i in moved], pa.int64())], names=["a", "b"])


def grouped(batches, columns: list[str]):
    """Runs of rows of one value of the first column, as lists; rows come sorted by it."""
    held, rows = None, []
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in columns)):
            if rows and r[0] != held:
                yield rows
                rows = []
            held = r[0]
            rows.append(r)
    if rows:
        yield rows


def limit_of(counts: DataFrame, most: int) -> int:
    """A count that at most `most` rows of (c, n) exceed, from how often each count comes."""
    seen = 0
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        seen += r["count"]
        if seen > most:
            return r["n"]
    return 0


def parted(rows: DataFrame, group: str, each: Column, cut: Column) -> DataFrame:
    """rows with block and side: each of `cut` parts of a group meets itself and each other part; sides are null within a part."""
    spread = rows.withColumn("part", F.pmod(F.xxhash64(each), cut)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)))
    block = F.xxhash64(group, F.least("part", "other"), F.greatest("part", "other"))
    return spread.withColumn("block", block).withColumn("side", F.when(F.col("part") != F.col("other"), F.col("part"))).drop("part", "other")


def prepared(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, frequent: int, most: int, block_shingles: int, block_classes: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Steps 1 to 3 of jaccard_components: rows, classes, classes in candidate components, the same with texts.

    id is a struct of whether the id is null, the id and a hash of the text, so that
    null ids are equal, come last and lead to their own text, as repeated ids do.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    texts = docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("own"), F.xxhash64(text).alias("h")).alias("id"), text.alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def survey(batches):
        """Each row's class, size and signature, and how often the shingles come that most of a task's classes hold."""
        shingler, common = Shingler(words), Common(max(1024, 4 * frequent))
        ids = None
        for b in batches:
            for ids, found in pieces(b, 2_000_000):
                sets = shingler.sets(found)
                classes = [class_of(s) for s in sets]
                common.add({c: s for c, s in zip(classes, sets) if c is not None}.values())
                yield pa.record_batch([ids, pa.array(classes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) if len(s) else None for s in sets], pa.binary()), pa.array([True] * len(ids))], names=["id", "c", "n", "bits", "is_row"])
        if ids is not None:
            token, count = common.often(max(frequent // 8, 64))
            yield pa.record_batch([pa.nulls(len(token), ids.type), pa.array(token.view(np.int64), pa.int64()), pa.array(count, pa.int64()), pa.nulls(len(token), pa.binary()), pa.array([False] * len(token), pa.bool_())], names=["id", "c", "n", "bits", "is_row"])

    surveyed = written(texts.mapInArrow(survey, f"id {kind}, c long, n long, bits binary, is_row boolean"), "survey")
    members = surveyed.where("is_row").drop("is_row")
    counts = written(surveyed.where("not is_row").groupBy("c").agg(F.sum("n").alias("n")), "counts")
    counted = counts.where(F.col("n") > limit_of(counts, frequent)).collect()
    forget(counts)
    order = share(spark, Order(np.array([r["c"] for r in counted], np.int64).view(np.uint64), np.array([r["n"] for r in counted], np.int64)))

    def rarest(batches):
        shingler, by = Shingler(words), order()
        seen: set = set()
        for b in batches:
            for _, found in pieces(b, 1_000_000):
                cols = ([], [])
                for s in shingler.sets(found):
                    c = class_of(s)
                    if c is None or c in seen:
                        continue
                    seen.add(c)
                    token = by.prefix(s, int(prefix_length(np.int64(len(s)), percent)))
                    for col, x in zip(cols, (token.view(np.int64), np.full(len(token), c))):
                        col.append(x)
                if len(seen) > 500_000:
                    seen.clear()
                yield pa.record_batch([pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64), pa.int64()) for x in cols], names=["token", "c"])

    # The least class of a shingle is found by partial sums and joined back, so that no shingle, however common, has to meet in one task.
    dealt = written(texts.mapInArrow(rarest, "token long, c long"), "dealt")
    hubs = dealt.groupBy("token").agg(F.min("c").alias("hub"), F.max("c").alias("top")).where("hub <> top").select("token", "hub")
    stars = written(dealt.join(hubs, "token").where("c <> hub").select("c", "hub").distinct(), "stars")
    forget(dealt)
    classes = members.where("c is not null").groupBy("c").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.first("bits").alias("bits"), F.count(F.lit(1)).alias("rows"))
    sizes = stars.groupBy("hub").agg(F.count(F.lit(1)).alias("k"))
    large = written(sizes.where(F.col("k") >= most).select("hub"), "large")
    small = stars.join(large, "hub", "left_anti")
    small = small.unionByName(small.select(F.col("hub").alias("c"), "hub").distinct()).join(classes.select("c", "n", "bits"), "c")

    # Each class meets the others of its group in blocks of about 2 * block_classes.
    cut = F.greatest(F.lit(1), F.ceil(F.col("k") / block_classes)).cast("long")
    small = small.join(sizes, "hub").withColumn("cut", F.when(F.col("k") <= 2 * block_classes, F.lit(1).cast("long")).otherwise(cut))

    def prune(batches):
        for rows in grouped(batches, ["block", "c", "n", "bits", "side"]):
            side = None if rows[0][4] is None else np.array([r[4] for r in rows], np.int64)
            root = alike(np.array([r[2] for r in rows], np.int64), [r[3] for r in rows], percent, side)
            moved = np.flatnonzero(root != np.arange(len(root)))
            yield pa.record_batch([pa.array([rows[i][1] for i in moved], pa.int64()), pa.array([rows[root[i]][1] for i in moved], pa.int64())], names=["a", "b"])

    met = parted(small.select("hub", "c", "n", "bits", "cut"), "hub", F.col("c"), F.col("cut")).select("block", "c", "n", "bits", "side")
    pruned = met.repartition(parts, "block").sortWithinPartitions("block", "c").mapInArrow(prune, "a long, b long")
    whole = stars.join(large, "hub").select(F.col("c").alias("a"), F.col("hub").alias("b"))
    candidates = written(components(pruned.unionByName(whole)), "candidates")

    placed = classes.drop("bits").join(candidates.withColumnRenamed("node", "c"), "c")
    share_of = F.greatest(F.col("n") / block_shingles, F.lit(1.0 / block_classes))
    weights = placed.groupBy("root").agg(F.sum(share_of).alias("weight"))
    placed = written(placed.join(weights, "root"), "placed")
    held = written(placed.join(texts.hint("merge"), "id").select("c", "root", "weight", "rows", "text"), "held")  # one plan at every size
    if held.count() > placed.count():  # rows that are equal in id and text
        first = held.groupBy("c", "root", "weight", "rows").agg(F.min("text").alias("text"))
        once = written(first, "held")
        forget(held)
        held = once
    forget(stars, large, candidates)
    return members, classes, placed, held


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, frequent: int = 1 << 17, most: int = 16_384, block_shingles: int = 1 << 20, block_classes: int = 256, rounds: int = 2) -> DataFrame:
    """Components of texts whose sets of word shingles have a Jaccard index of percent / 100 or more.

    1. Texts of one set are one class. Shingles are counted task by task; the
       `frequent` most frequent ones come last in a common order of shingles.
    2. Of the rarest shingles of each class, as many as make sure that linked classes
       share one, the least class is found; classes that share a shingle form a group
       around it.
    3. In a group, pairs that sizes or bit signatures rule out are dropped, parts of
       block_classes against each other, and what hangs together stays a block; groups of more than `most` classes stay whole,
       as pairs of each class and the least one.
    4. Each block is a sparse product that finds its links exactly. A block of more
       than 2 * block_shingles or 2 * block_classes is cut at random, in several rounds; classes that are
       then outside its largest linked part are compared with all parts of it, so that
       no link between two parts is missed.

    Shingles and sets are told apart by 64-bit hashes. The order of shingles and the
    bounds on groups affect speed alone.

    Null and empty texts: no shingles, linked with nothing. Very long texts are hashed
    in steps of 1 MB; their sets are held. Repeated rows and equal texts: one
    component. Null and repeated ids: each row is its own text, which links as any
    other; a null id is no one's component_id unless all of a component are null.
    Ties cannot matter. An empty table: no rows. Other columns are ignored.

    Returns id_col, n_shingles, component_id, the smallest id of the component.
    """
    members, classes, placed, held = prepared(docs, id_col, text_col, words, percent, frequent, most, block_shingles, block_classes)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def linked(places: DataFrame) -> DataFrame:
        """Links within the blocks of rows (block, c, label, text)."""
        return places.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(lambda b: blocks(b, Shingler(words), percent), "a long, b long")

    fits = F.col("weight") <= 2
    none = F.lit(None).cast("long")
    links = written(linked(held.where(fits).select(F.col("root").alias("block"), "c", none.alias("label"), "text")), "links")
    big = held.where(~fits)
    if not placed.where(~fits).isEmpty():
        cut = F.ceil("weight")
        for r in range(rounds):
            block = F.xxhash64("root", F.pmod(F.xxhash64("c", F.lit(r)), cut))
            links = links.unionByName(written(linked(big.select(block.alias("block"), "c", none.alias("label"), "text")), "links"))
        label = components(links).select(F.col("node").alias("c"), F.col("root").alias("label"))
        labelled = placed.where(~fits).join(label, "c", "left").withColumn("label", F.coalesce("label", "c"))
        sized = labelled.groupBy("root", "label").agg(F.count(F.lit(1)).alias("k"))
        main = sized.groupBy("root").agg(F.max_by("label", F.struct("k", "label")).alias("main"))
        labelled = written(labelled.join(main, "root").select("c", "label", "main"), "labelled")
        rows = big.join(labelled, "c")
        inside = rows.where("label = main").withColumn("at", F.pmod(F.xxhash64("c", F.lit(-1)), cut))
        outside = rows.where("label <> main").withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), cut.cast("long") - 1)))
        last = inside.unionByName(outside).select(F.xxhash64("root", "at").alias("block"), "c", "label", "text")
        links = links.unionByName(written(linked(last), "links"))
        links = components(links).select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = classes.join(links.select(F.col("a").alias("c"), F.col("b").alias("root")).distinct(), "c", "left").select("c", "id", F.coalesce("root", "c").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("id.own").alias("component_id"))
    named = written(roots.join(smallest, "root").select("c", "component_id"), "named")
    forget(placed, held)
    out = members.select("id", "c", "n").join(named, "c", "left")
    return out.select(F.col("id.own").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id.own").alias("component_id"))


def jaccard_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, frequent: int = 1 << 17, most: int = 16_384, block_shingles: int = 1 << 20, block_classes: int = 256) -> tuple[DataFrame, DataFrame]:
    """All links of texts whose sets of word shingles have a Jaccard index of percent / 100 or more.

    Candidates are those of jaccard_components. All pairs of classes in a block that
    may link are counted, each once; a block of more than 2 * block_shingles or
    2 * block_classes is cut into parts, and each part meets itself and each other part. Components follow
    from the links.

    Returns two tables: rows (id_col, n_shingles, component_id, n_links, class_id) as
    of jaccard_components, where n_links counts the other rows a row links to, those
    of its own class included and those with null ids too; and the linked classes
    (a, b), each pair once. The first is summed up block by block and does not hold
    the links; the second is only worked out where it is used.
    """
    members, classes, placed, held = prepared(docs, id_col, text_col, words, percent, frequent, most, block_shingles, block_classes)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = F.col("weight") <= 2
    none = F.lit(None).cast("long")
    places = held.where(fits).select(F.col("root").alias("block"), "c", none.alias("label"), "text", "rows")
    if not placed.where(~fits).isEmpty():
        met = parted(held.where(~fits), "root", F.col("c"), F.ceil("weight").cast("long"))
        places = places.unionByName(met.select("block", "c", F.col("side").alias("label"), "text", "rows"))
    dealt = places.repartition(parts, "block").sortWithinPartitions("block")
    links = dealt.drop("rows").mapInArrow(lambda b: linked_blocks(b, Shingler(words), percent), "a long, b long")
    counted = written(dealt.mapInArrow(lambda b: counted_blocks(b, Shingler(words), percent), "a long, b long, near long"), "counts")
    roots = components(counted.where("b is not null").select("a", "b"))
    near = counted.where("near is not null").groupBy(F.col("a").alias("c")).agg(F.sum("near").alias("near"))
    named = classes.join(roots.select(F.col("node").alias("c"), "root"), "c", "left").join(near, "c", "left")
    named = named.select("c", "id", F.coalesce("root", "c").alias("root"), (F.col("rows") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    named = written(named, "counted")
    named = named.join(named.groupBy("root").agg(F.min("id.own").alias("component_id")), "root").select("c", "component_id", "n_links")
    out = members.select("id", "c", "n").join(named, "c", "left")
    out = out.select(F.col("id.own").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id.own").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("c").alias("class_id"))
    return out, links


def op3(docs: DataFrame) -> DataFrame:
    return jaccard_links(docs)[0].drop("class_id")


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END) AS s
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM r JOIN l ON l.a = r.node WHERE r.root < l.b
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY 1) k ON k.a = d.doc_id
JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY 1) c ON c.node = d.doc_id
"""
