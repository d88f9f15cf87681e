"""Op 11: the best documents for each query item, all items evaluated together.

Items ask for many of the same terms. The term sets that items share are mined first:
terms that the same items ask for become one node, then pairs of nodes that occur
together in the most items become a node of their own, again and again, until no pair
is in two items. The nodes form a directed acyclic graph over the terms; a node's
accumulator, the partial scores of a batch of documents, is the sum of its parts'
accumulators and is computed once, whatever number of items uses it. Scores are
64-bit integers, so the order of additions changes nothing.

The items come in blocks of about ``BLOCK_BYTES`` of text; a block's graph goes to all
tasks. Per block the texts are read once: each document's length and its counts of the
block's terms are stored, document counts of terms are summed with map-side
combination, and the stored counts are scored. A task keeps the best ``K`` documents
of each item; the best of groups of tasks and then of all remain, so no group of rows
grows with the documents.

Terms are known by 64-bit hashes. Null texts and texts without a term are no documents;
an item without terms has no results. Rows stand for themselves: a repeated doc_id is
a document once per row, a repeated item_id an item once per row; a null doc_id comes
last among equal scores. Without documents or items there are no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, map_batches
from assetweave.llm.text import ALNUM, chunks, distinct, text_of, words
from assetweave.session import stored

K = 20
BLOCK_BYTES = 1 << 20
#: nodes of one item that pairs are looked for among; more are only added up
PAIRED = 256
#: accumulators of a batch of documents, in values
CELLS = 4_000_000
#: groups of tasks whose best documents are compared first
GROUPS = 64


class SharedTerms:
    """The graph of a block: nodes 0 to ``terms`` are terms, the others sums of earlier nodes."""

    def __init__(self, items: list[list[int]], terms: int, paired: int = PAIRED):
        self.terms, self.parts = terms, []
        self.of_item: list[list[int]] = self._mine(items, paired)

    def _node(self, parts: list[int]) -> int:
        self.parts.append(np.array(parts))
        return self.terms + len(self.parts) - 1

    def _mine(self, items: list[list[int]], paired: int) -> list[list[int]]:
        # a term's second occurrence in an item is an element of its own
        asked = defaultdict(list)
        for i, item in enumerate(items):
            for term, n in sorted(Counter(item).items()):
                for k in range(n):
                    asked[term, k].append(i)
        together = defaultdict(list)
        for (term, _), by in asked.items():
            together[tuple(by)].append(term)
        holds: list[set[int]] = [set() for _ in items]
        alone: list[list[int]] = [[] for _ in items]  # what no other item asks for, or a second use of a node
        for by, members in sorted(together.items()):
            node = members[0] if len(members) == 1 else self._node(members)
            for i in by:
                if len(by) > 1 and node not in holds[i] and len(holds[i]) < paired:
                    holds[i].add(node)
                else:
                    alone[i].append(node)
        self._pair(holds)
        return [sorted(held) + rest for held, rest in zip(holds, alone)]

    def _pair(self, holds: list[set[int]]) -> None:
        """Give the commonest pair of nodes a node, until no pair is in two items."""
        pairs: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, held in enumerate(holds):
            ordered = sorted(held)
            for k, a in enumerate(ordered):
                for b in ordered[k + 1 :]:
                    pairs[a, b].add(i)
        queue = [(-len(by), pair) for pair, by in pairs.items() if len(by) > 1]
        heapq.heapify(queue)
        while queue:
            n, pair = heapq.heappop(queue)
            by = pairs.get(pair, set())
            if len(by) != -n:  # it has lost items since
                if len(by) > 1:
                    heapq.heappush(queue, (-len(by), pair))
                continue
            node, touched = self._node(list(pair)), set()
            for i in sorted(by):
                holds[i] -= {*pair}
                for other in holds[i]:
                    for gone in pair:
                        pairs[min(gone, other), max(gone, other)].discard(i)
                    pairs[other, node].add(i)
                    touched.add((other, node))
                holds[i].add(node)
            del pairs[pair]
            for new in touched:
                if len(pairs[new]) > 1:
                    heapq.heappush(queue, (-len(pairs[new]), new))

    def additions(self) -> int:
        """Accumulators added for a batch of documents."""
        return sum(len(p) - 1 for p in self.parts) + sum(max(len(nodes) - 1, 0) for nodes in self.of_item)

    def scores(self, of_terms: np.ndarray) -> np.ndarray:
        """Items x documents, from terms x documents."""
        held = np.zeros((self.terms + len(self.parts), of_terms.shape[1]), np.int64)
        held[: self.terms] = of_terms
        for k, parts in enumerate(self.parts):
            np.sum(held[parts], axis=0, out=held[self.terms + k])
        out = np.zeros((len(self.of_item), of_terms.shape[1]), np.int64)
        for i, nodes in enumerate(self.of_item):
            if nodes:
                np.sum(held[nodes], axis=0, out=out[i])
        return out


class Block:
    """Some items: their terms' hashes, sorted, and how the items share them."""

    def __init__(self, items: pd.DataFrame):
        self.rows = items["row"].to_numpy(np.int64)
        self.ids = [None if pd.isna(x) else int(x) for x in items["item_id"]]
        w = words(pa.array(items["text"], pa.string()), ALNUM)
        self.hashes, codes = np.unique(w.hashes(), return_inverse=True)
        self.graph = SharedTerms([codes[a:b].tolist() for a, b in zip(w.first, w.first[1:])], len(self.hashes))


def blocks(items: DataFrame, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in blocks of about ``size`` bytes of text; a longer item makes its block longer."""
    # ids as text: pandas turns numbers beside nulls into floats
    rows = items.select(F.col("item_id").cast("long").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "items")
    n = max(1, -(-rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // size))
    for i in range(n):
        block = Block(rows.where(F.pmod(F.xxhash64("row"), F.lit(n)) == i).toPandas())
        if len(block.hashes):
            yield block


def _counts(hashes):
    """(doc_id, n, terms, counts): a document's words, and its counts of the terms that it holds."""

    def run(batches: Batches) -> Batches:
        wanted = hashes.value
        for batch in chunks(batches):
            w = words(text_of(batch), ALNUM)
            unique, _, codes = distinct(w.hashes())
            place = np.minimum(np.searchsorted(wanted, unique), len(wanted) - 1)
            place = np.where(wanted[place] == unique, place, -1)[codes] if len(unique) else np.zeros(0, np.int64)
            row = w.row[place >= 0]
            key, count = np.unique(row * len(wanted) + place[place >= 0], return_counts=True)
            row, term = np.divmod(key, len(wanted))
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            columns = [text_of(batch, "doc_id"), pa.array(w.counts)]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (term, count)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return run


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


_RANKED = "item long, item_id long, part int, doc_id long, score long"


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    order = np.lexsort([found["doc_id"], found["none"], -found["score"], found["item"]])
    found = found.iloc[order]
    return found[found.groupby("item").cumcount().to_numpy() < k]


def _ranking(block, weights: np.ndarray, n_docs: int, length: int, k: int):
    """A task's best documents of every item of the block."""

    def run(batches: Batches) -> Batches:
        graph, rows, ids = block.value.graph, block.value.rows, block.value.ids
        step = max(16, CELLS // (graph.terms + len(graph.parts) + len(rows)))
        held = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("item", "none", "doc_id", "score")})
        least = np.ones(len(rows), np.int64)  # a score of at least that much is looked at
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                terms, counts = batch.column(2), batch.column(3)
                size = np.diff(terms.offsets.to_numpy())
                doc = np.repeat(np.arange(batch.num_rows), size)
                tf = counts.flatten().to_numpy().astype(np.int64)
                middle = 75 + 25 * batch.column(1).to_numpy() * n_docs // length
                part = np.zeros((graph.terms, batch.num_rows), np.int64)
                term = terms.flatten().to_numpy()
                part[term, doc] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * middle[doc]))
                scores = graph.scores(part)
                item, at = np.nonzero(scores >= least[:, None])
                if not len(item):
                    continue
                doc_id = batch.column(0)
                none = doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                new = {"item": item, "none": none[at], "doc_id": doc_id.fill_null(0).to_numpy()[at], "score": scores[item, at]}
                held = _best(pd.concat([held, pd.DataFrame(new)]), k)
                full = held.groupby("item")["score"].agg(["size", "min"])
                full = full[full["size"] == k]
                least[full.index] = full["min"]
        if len(held):
            item = held["item"].to_numpy()
            columns = [pa.array(rows[item]), pa.array([ids[i] for i in item], pa.int64())]
            columns += [pa.array(np.full(len(held), TaskContext.get().partitionId(), np.int32))]
            columns += [pa.array(held["doc_id"].to_numpy(), mask=held["none"].to_numpy() == 1), pa.array(held["score"].to_numpy())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "part", "doc_id", "score"])

    return run


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each item its ``k`` best documents with a score above 0: item_id, rank, doc_id, score."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "item_id long, rank int, doc_id long, score long"
    results = []
    for block in blocks(items, block_bytes):
        hashes, shared = context.broadcast(block.hashes), context.broadcast(block)
        counted = map_batches(texts, _counts(hashes), "doc_id long, n long, terms array<int>, counts array<int>")
        counted = stored(counted.where("n > 0"), "term-counts")
        n_docs, length = counted.agg(F.count("*"), F.sum("n")).first()
        if n_docs:
            holding = np.zeros(len(block.hashes), np.int64)
            # a row for every term of the block at most
            for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
                holding[r["term"]] = r["count"]
            weights = np.array([weight(n_docs, h) for h in holding.tolist()], np.int64)
            asked = counted.where(F.size("terms") > 0)
            found = map_batches(asked, _ranking(shared, weights, n_docs, length, k), _RANKED)
            found = _first(found.withColumn("part", F.col("part") % GROUPS), k, "item", "part").drop("rank")
            found = _first(found, k, "item").select("item_id", "rank", "doc_id", "score")
            results.append(stored(found, "ranked"))
        hashes.destroy()
        shared.destroy()
    if not results:
        return docs.sparkSession.createDataFrame([], schema)
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out


def op11_shared_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def oracle() -> str:
    """The same in SQL, item by item and term by term."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with docs as (
  select row_number() over () as doc, doc_id, regexp_extract_all({lowered}, '{term}') as terms
  from documents where text is not null),
sized as (select doc, doc_id, terms, len(terms)::bigint as n from docs where len(terms) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as length from sized),
asked as (
  select item, item_id, term, count(*)::bigint as times from (
    select row_number() over () as item, item_id, unnest(regexp_extract_all({lowered}, '{term}')) as term from benchmark)
  group by all),
held as (
  select doc, term, count(*)::bigint as tf from (select doc, unnest(terms) as term from sized)
  where term in (select term from asked) group by all),
weighted as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from held, totals group by term, docs),
scored as (
  select item, item_id, doc_id, doc,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::bigint as score
  from asked join held using (term) join weighted using (term) join sized using (doc), totals group by all)
select item_id, row_number() over (partition by item order by score desc, doc_id, doc)::integer as rank, doc_id, score
from scored where score > 0 qualify rank <= {K}
"""
