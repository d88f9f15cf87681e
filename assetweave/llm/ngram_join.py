"""Op 4: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, as classes.

1. Equal sets are one class from the start, by a 64-bit hash of the whole set.
2. A class's tokens are its shingles as 64-bit hashes. Sorted by hash, its first
   ``n - ceil(0.8 n) + n / 10`` tokens are its prefix; two linked classes share at
   least a tenth of the smaller one's size within their prefixes. Classes with
   fewer prefix tokens that any other class holds have no partner and drop out.
   Of the rest the whole sets are counted, and classes drop out of whose tokens
   less than 80 % occur in another one.
3. Token-group matrix: what is left is partitioned into groups of similar documents
   by min-hash, groups are searched exactly, and what is linked becomes one group.
   The matrix holds every group's tokens that may be the rarest common ones: of two
   linked sets these are within the ``n - ceil(0.8 n) + 1`` rarest of either. A
   document queries the groups that hold one of its own such tokens, other than its
   own group, if sizes fit and enough tokens follow that one on both sides. A group
   is opened only if the union of its tokens holds 80 % of the document's. The
   smaller of two groups asks the larger.
4. Links join classes to components.

Groups are cut at ``GROUP_TOKENS``, so copies and near copies of one text, however
many, spread over tasks; cut groups of one component need no search between them.
Every step but the hashing is exact: no token, group or partner is capped.

Null and empty texts, or without words, have no shingles, and link with nothing.
Rows with equal doc_id count as that document; a null doc_id is never a component's
name unless nothing else is. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.llm.graph import components
from assetweave.llm.tasks import Batches, fresh, map_batches
from assetweave.llm.text import NOT_SPACE, Words, chunks, mix, text_of, words
from assetweave.session import stored

SIZE = 5
#: similarity in hundredths
LEAST = 80
#: tokens of one group in one task
GROUP_TOKENS = 1 << 20
#: rows of a side that may be broadcast
BROADCAST_ROWS = 1_000_000
_K = np.uint64(0x9E3779B97F4A7C15)


def need(n: int, least: int = LEAST) -> int:
    """Tokens that a linked partner of a set of ``n`` shares at least."""
    return -(-n * least // 100)


def extra(n: int) -> int:
    return max(1, n // 10)


def prefix_size(n: int, least: int = LEAST) -> int:
    return min(n, n - need(n, least) + extra(n))


def shingles(w: Words, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    h, first = w.hashes(), w.first
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        rolled = rolled * _K + mix(h[k : k + len(rolled)] + np.uint64(k))
    rolled = mix(rolled ^ np.uint64(size))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = b"".join([x.tobytes() for x in h[a:b]])
            out.append(np.frombuffer(hashlib.blake2b(whole, digest_size=8).digest(), np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _classes(least: int):
    def run(batches: Batches) -> Batches:
        seen: set[int] = set()  # a class that this task has met needs no second prefix
        for batch in chunks(batches):
            n, keys, prefixes = [], [], []
            for tokens in shingles(words(text_of(batch), NOT_SPACE)):
                n.append(len(tokens))
                keys.append(_class_of(tokens) if len(tokens) else None)
                fresh = len(tokens) and keys[-1] not in seen
                seen.add(keys[-1])
                prefixes.append(tokens[: prefix_size(len(tokens), least)].view(np.int64) if fresh else None)
            columns = [text_of(batch, "doc_id"), text_of(batch, "text_hash"), pa.array(n, pa.int64()), pa.array(keys, pa.int64())]
            columns.append(pa.array(prefixes, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "class", "prefix"])

    return run


def _token_sets(batches: Batches) -> Batches:
    """Class, size, min-hash and tokens of every row."""
    for batch in chunks(batches):
        rows = [t for t in shingles(words(text_of(batch), NOT_SPACE)) if len(t)]
        columns = [
            pa.array([_class_of(t) for t in rows], pa.int64()),
            pa.array([len(t) for t in rows], pa.int64()),
            pa.array([int(t[0].view(np.int64)) for t in rows], pa.int64()),
            pa.array([t.tobytes() for t in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["class", "n", "g", "tokens"])


def _exploded(batches: Batches) -> Batches:
    for batch in batches:
        sizes = [len(t.as_py()) // 8 for t in batch.column(1)]
        tokens = np.frombuffer(b"".join(t.as_py() for t in batch.column(1)), np.int64)
        classes = np.repeat(batch.column(0).to_numpy(), sizes)
        yield pa.RecordBatch.from_arrays([pa.array(classes), pa.array(tokens)], ["class", "token"])


def _runs(batches: Batches, keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of a sorted partition by key, one run at a time."""
    from itertools import groupby

    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def _links(batch: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in batch], pa.int64()) for i in (0, 1)], ["a", "b"])


class Group:
    """Token sets, and the members that hold each token."""

    def __init__(self, sets: list[np.ndarray], least: int):
        self.least, self.size = least, np.array([len(s) for s in sets])
        self.union, self.codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.first = np.cumsum(self.size) - self.size
        self.mark = np.zeros(len(self.union), bool)
        self.holders = np.repeat(np.arange(len(sets)), self.size)[np.argsort(self.codes, kind="stable")]
        self.begin = np.append(0, np.cumsum(np.bincount(self.codes, minlength=len(self.union))))

    def known(self, query: np.ndarray) -> np.ndarray:
        """Places in the union of the query's tokens that the union holds."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        return at[self.union[at] == query]

    def places(self, member: int) -> np.ndarray:
        return self.codes[self.first[member] : self.first[member] + self.size[member]]

    def linked(self, places: np.ndarray, n: int, free: np.ndarray) -> np.ndarray:
        """Which of the ``free`` members are linked with a set of ``n`` tokens, those at ``places`` among them."""
        held = self.begin[places + 1] - self.begin[places]
        among = np.flatnonzero(free)
        among = among[(self.size[among] * 100 >= n * self.least) & (n * 100 >= self.size[among] * self.least)]
        if not len(among):
            return among
        size = self.size[among]
        if held.sum() < size.sum():  # the tokens' holders are fewer than the members' tokens
            at = np.arange(int(held.sum())) + np.repeat(self.begin[places] - (np.cumsum(held) - held), held)
            common = np.bincount(self.holders[at], minlength=len(self.size))[among]
        else:
            self.mark[places] = True
            begin = np.cumsum(size) - size
            at = np.arange(int(size.sum())) + np.repeat(self.first[among] - begin, size)
            common = np.add.reduceat(self.mark[self.codes[at]].astype(np.int64), begin)
            self.mark[places] = False
        return among[100 * common >= self.least * (n + size - common)]


def _search_groups(least: int):
    """Which members are connected within each group: every member with the smallest class connected to it."""

    def run(batches: Batches) -> Batches:
        for _, rows in _runs(batches, ["g", "sub"]):
            members = list(rows)
            classes = np.array([r["class"] for r in members], np.int64)
            root = np.arange(len(members))
            if len(members) > 1:
                group = Group([np.frombuffer(r["tokens"], np.uint64) for r in members], least)
                # a token of one member is no common one
                shared = np.bincount(group.codes) > 1
                common = np.add.reduceat(shared[group.codes].astype(np.int64), group.first)
                free = 100 * common >= least * group.size
                for seed in np.flatnonzero(free).tolist():
                    queue = [seed] if free[seed] else []
                    free[seed] = False
                    while queue and free.any():
                        at = queue.pop()
                        found = group.linked(group.places(at), int(group.size[at]), free)
                        root[found], free[found] = root[at], False
                        queue += found.tolist()
            smallest = np.full(len(members), np.iinfo(np.int64).max)
            np.minimum.at(smallest, root, classes)
            yield pa.RecordBatch.from_arrays([pa.array(classes), pa.array(smallest[root])], ["class", "group"])

    return run


def _open_groups(least: int):
    """A link between a query and a group where the group holds a partner; members come before queries."""

    def run(batches: Batches) -> Batches:
        for _, rows in _runs(batches, ["group", "sub"]):
            members, group, links = [], None, []
            for row in rows:
                tokens = np.frombuffer(row["tokens"], np.uint64)
                if not row["query"]:
                    members.append((row["class"], tokens))
                    continue
                if group is None:
                    group = Group([t for _, t in members], least)
                    everyone = np.ones(len(members), bool)
                places = group.known(tokens)
                if 100 * len(places) >= least * len(tokens):
                    found = group.linked(places, len(tokens), everyone)
                    if len(found):
                        links.append((row["class"], members[found[0]][0]))
            if links:
                yield _links(links)

    return run


def _bounded(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, and broadcast if it has few rows."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _cut_groups(sizes: DataFrame, key: str) -> DataFrame:
    """Number of parts of every group, from (key, n) rows."""
    groups = sizes.groupBy(key).agg(F.sum("n").alias("tokens"), F.count("*").alias("members"))
    return groups.select(key, "members", F.ceil(F.col("tokens") / GROUP_TOKENS).cast("int").alias("parts"))


def connected(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_shingles, class) of every row, and (class, group) of classes that may have partners."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, text_hash long, n_shingles long, class long, prefix array<long>"
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    found = stored(map_batches(hashed, _classes(least), schema), "classes")

    # prefix tokens that more than one class holds, on one partitioning by token
    tokens = found.where("prefix is not null").select("class", F.explode("prefix").alias("token"))
    tokens = tokens.repartition("token").groupBy("token", "class").agg(F.lit(1).alias("one")).drop("one")
    tokens = tokens.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    tokens = stored(tokens, "shared-tokens")

    n = F.col("n")
    partner = F.ceil(n * least / 100)
    required = F.greatest(F.lit(1), F.floor(partner / 10)).cast("int")
    sizes = found.where("class is not null").groupBy("class").agg(
        F.min("n_shingles").alias("n"), F.min("doc_id").alias("doc_id")
    )
    candidates = tokens.groupBy("class").agg(F.count("*").alias("common")).join(sizes, "class")
    candidates = _bounded(
        candidates.withColumn("required", required).where("common >= required").select("class", "n", "doc_id", "required"),
        "candidates",
    )

    # their whole sets, of which only those can have a partner that share enough; a class whose rows have no doc_id is found through its text alone
    one = candidates.select(F.col("doc_id").alias("_doc"))
    texts = rows.join(one, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    sets = map_batches(texts, _token_sets, "class long, n long, g long, tokens binary")
    sets = sets.join(candidates.select("class"), "class", "left_semi").dropDuplicates(["class"])
    sets = stored(sets, "token-sets")
    tokens = map_batches(sets.select("class", "tokens"), _exploded, "class long, token long").repartition("token")
    tokens = tokens.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    tokens = stored(tokens, "shared-tokens")
    candidates = tokens.groupBy("class").agg(F.count("*").alias("common")).join(sets.select("class", "n"), "class")
    candidates = candidates.withColumn("rarest", (F.col("common") - partner + 1).cast("int")).where("rarest > 0")
    candidates = _bounded(candidates.select("class", "n", "common", "rarest"), "candidates")
    sets = stored(sets.join(candidates.select("class"), "class", "left_semi"), "token-sets")

    # groups of similar sets, searched exactly; what is linked is one group
    cut = _bounded(_cut_groups(sets.select("g", "n"), "g").where("members > 1"), "groups")
    members = sets.join(cut, "g").select("g", F.pmod(F.xxhash64("class"), F.col("parts")).alias("sub"), "class", "tokens")
    members = members.repartition("g", "sub").sortWithinPartitions("g", "sub")
    searched = map_batches(members, _search_groups(least), "class long, group long")
    member = candidates.join(searched, "class", "left").withColumn("group", F.coalesce("group", "class"))
    member = stored(member, "members")

    # the matrix of groups and rarer tokens
    cut = _cut_groups(member.select("group", "n"), "group")
    member = stored(
        member.join(cut, "group").withColumn("sub", F.pmod(F.xxhash64("class"), F.col("parts"))).drop("parts"), "members"
    )
    # tokens that no other class holds are rarer still, and can't be common ones
    by_rarity = Window.partitionBy("class").orderBy("df", "token")
    rare = tokens.join(member, "class").withColumn("rank", F.row_number().over(by_rarity)).where("rank <= rarest")
    # if the token is the rarest common one, all common ones are among those from there on
    rare = rare.withColumn("left", F.col("common") - F.col("rank") + 1)
    rare = stored(rare.select("token", "class", "n", "left", "group", "sub", "members"), "rare-tokens")
    matrix = rare.groupBy("token", F.col("group").alias("other"), F.col("sub").alias("other_sub")).agg(
        F.max("left").alias("other_left"),
        F.min("n").alias("least_n"),
        F.max("n").alias("most_n"),
        F.any_value("members").alias("other_members"),
    )
    fits = (n * 100 >= F.col("least_n") * least) & (F.col("most_n") * 100 >= n * least)
    # similarity s of sizes n and m needs (n + m) s / (1 + s) common tokens
    enough = F.least("left", "other_left") * (100 + least) >= (n + F.col("least_n")) * least
    smaller = F.struct("members", "group") < F.struct(F.col("other_members"), F.col("other"))
    asks = rare.join(matrix, "token").where(smaller & fits & enough)
    asks = stored(asks.select("class", F.col("other").alias("group"), F.col("other_sub").alias("sub")).distinct(), "queries")

    wanted = asks.select("group", "sub").distinct()
    opened = member.join(wanted, ["group", "sub"], "left_semi").select("class", "group", "sub")
    both = opened.withColumn("query", F.lit(False)).unionByName(asks.withColumn("query", F.lit(True)))
    both = both.join(sets.select("class", "tokens"), "class").repartition("group", "sub")
    both = both.sortWithinPartitions("group", "sub", "query")
    linked = stored(map_batches(both, _open_groups(least), "a long, b long"), "links")

    # links join groups
    group_of = member.select("class", "group")
    for end in ("a", "b"):
        linked = linked.join(group_of, linked[end] == group_of["class"]).withColumn(end, F.col("group"))
        linked = linked.select("a", "b")
    joined = components(linked)
    joined = group_of.join(joined, group_of["group"] == joined["node"], "left")
    return found.drop("prefix"), joined.select("class", F.coalesce("component", "group").alias("group"))


def near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable over links) of every row."""
    found, group_of = connected(docs, least)
    named = found.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    named = named.join(group_of, "class", "left").withColumn("group", F.coalesce("group", "class"))
    least_doc = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least_doc, "group").select("class", "component_id")
    out = found.join(named, "class", "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def without_near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row of each component, all columns kept: that with the smallest doc_id, null last, then by its text's hash.

    Rows are decided by doc_id and a 64-bit hash of the text, so that rows without an
    id, or with the same one, stand for themselves. Rows without words all stay.
    """
    found, group_of = connected(docs, least)
    # the first row of every class, then of every group of classes
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = found.where("class is not null").groupBy("class").agg(F.min(order).alias("first"))
    classes = classes.join(group_of, "class", "left").withColumn("group", F.coalesce("group", "class"))
    firsts = classes.groupBy("group").agg(F.min("first").alias("first"), F.min_by("class", "first").alias("class"))
    firsts = firsts.select("class", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    # any two rows of one id and text have one class
    same = (
        (found["class"] == firsts["class"])
        & found["doc_id"].eqNullSafe(firsts["first_id"])
        & (found["text_hash"] == firsts["first_hash"])
    )
    kept = found.where("class is not null").join(firsts, same, "left_semi").groupBy("doc_id", "text_hash")
    kept = kept.agg(F.count("*").alias("count"))
    wordless = found.where("class is null").select("doc_id", "text_hash", F.lit(1).alias("count")).distinct()
    kept_id, kept_hash = fresh(docs, "kept_id", "kept_hash")
    kept = kept.unionByName(wordless).select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash), "count")
    kept = stored(kept, "kept")
    few = kept.count() <= BROADCAST_ROWS
    own_id, own_hash = F.col("doc_id").cast("long"), F.xxhash64("text")

    def rows_of(keys: DataFrame) -> DataFrame:
        keys = keys.select(kept_id, kept_hash)
        same = own_id.eqNullSafe(F.col(kept_id)) & (own_hash == F.col(kept_hash))
        return docs.join(F.broadcast(keys) if few else keys, same, "left_semi")

    # a repeated row stays once; without any, documents needn't be shuffled
    repeated = kept.where("count > 1")
    if repeated.isEmpty():
        return rows_of(kept)
    once = rows_of(repeated).withColumn(kept_id, own_id).withColumn(kept_hash, own_hash).dropDuplicates([kept_id, kept_hash])
    return rows_of(kept.where("count = 1")).unionByName(once.drop(kept_id, kept_hash))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
