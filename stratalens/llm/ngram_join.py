"""Exact Jaccard join on word shingles: a size-aware heavy-light join.

A document is the set of its distinct 5-word shingles, hashed to 64 bits.  Documents with equal
sets form a class, and one member stands for it.  Two sets with Jaccard similarity of
at least ``percent`` share at least o(n) = ceil(percent * n / 100) elements, n being the
larger size.  In any fixed order of all shingles, then, their first n - o(n) + k elements
share at least k of them.  This gives two ways to meet:

* light sets (small ones) enumerate all 2-subsets of their first n - o(n) + 2 elements
  as keys,
* heavy sets (large ones) are found through the inverted lists of their first
  n - o(n) + 1 elements; light sets near enough in size enter these lists too.

The boundary between both is the size with the least cost, counted from set sizes and the
measured length of lists.

The order is by hash, except that shingles in more than ``LONG_LIST`` sets come last: a
passage in very many documents is then met only in texts that consist of little else.  These
shingles are counted over sketches, which are somewhat longer than the prefixes, and over the whole sets of
documents whose sketch holds too few others.

Keys held by two classes are a pair.  In a longer list every member meets the list's pivot
first; found links give components, and only members of different components are
then paired.  So near copies of one text meet as a star, not in all pairs, and no
link between different components is lost.  What remains are connecting links: enough for the
components, fewer than all.  ``class_links`` pairs all members of every list instead and
gives every link, or their number per class.

An entry also holds its place in the order.  Two sets that share no earlier key share at most the
elements from there on, min(n - place, m - place), so they are paired only if that
is enough; at its first common key every similar pair passes.  The smaller set of a pair must pass with a
set of its own size already, so most entries enter a list as the larger set only: form letters, whose common
part comes last, form no pairs.  Sizes are cut into bands, and a band joins itself and the next one only.

Pairs pass a bound from their prefixes and are then
compared exactly.

The driver holds counts only.  Lists of ids or keys go to all executors if they have at
most ``SENT_ROWS`` entries, which is counted before, and are joined otherwise.

Defined results: NULL and empty texts have no shingles and link with nothing.  Rows with
a NULL id get their size and no component.  Rows that share an id are one document, whose
set for linking is that of the row with the smallest digest.  Equal rows repeat in the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components
from .shared import BLANKS, batch_rows, few, lean, only
from .word_tokens import slices

LONG_LIST = 32
LIGHT_MOST = 100
LIST_BLOCK = 2000
CELL = ["key", "band", "i", "j"]
BATCH_ROWS = 2000
TOKEN = np.dtype("<u8")


def overlap(n, percent: int):
    """The least number of shared elements of a set of size n with any similar set."""
    return -(-percent * n // 100)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; a text of fewer words is one shingle."""
    clean = pc.ascii_lower(pc.ascii_trim(pc.fill_null(texts.cast(pa.large_string()), ""), BLANKS))
    split = pc.ascii_split_whitespace(clean)
    coded = split.flatten().dictionary_encode()
    distinct = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)], dtype=TOKEN)
    hashed = distinct[coded.indices.to_numpy(zero_copy_only=False)]
    runs = len(hashed) - width + 1
    if runs > 0:
        rolled = hashed[:runs]
        for k in range(1, width):
            rolled = _mixed(rolled) + hashed[k:k + runs]
        rolled = _mixed(rolled)
    edges = split.offsets.to_numpy()
    edges = edges - edges[0]
    for i, (first, last) in enumerate(zip(edges[:-1], edges[1:])):
        if last - first >= width:
            yield np.unique(rolled[first:last - width + 1])
        elif clean[i].as_py():
            yield np.array([xxhash.xxh64_intdigest(hashed[first:last].tobytes(), seed=1)], dtype=TOKEN)
        else:
            yield np.zeros(0, TOKEN)


def _map_sets(docs: DataFrame, width: int, schema: pa.Schema, ddl: str, row: Callable) -> DataFrame:
    """Rows made from (doc_id, set) of every document (doc_id, text)."""

    def work(batches):
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for texts in slices(batch.column(1)):
                rows = [row(i, s) for i, s in zip(ids[at:at + len(texts)], shingle_sets(texts, width))]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.mapInArrow(lean(work), ddl)


def _with_held(sets: DataFrame, keys: DataFrame, then: Callable[[pd.DataFrame], pd.DataFrame], ddl: str) -> DataFrame:
    """``then`` of ``sets`` (cid, n, tokens) with ``held``: those tokens that are among ``keys`` (key).

    ``then`` runs in the same pass over each batch, so a task needs one Python process.
    """
    if few(keys):
        chosen = np.sort(np.array([r.key for r in keys.collect()], dtype=np.int64).view(TOKEN))
        sent = sets.sparkSession.sparkContext.broadcast(chosen)

        def pick(batches):
            chosen = sent.value
            for pdf in batches:
                tokens = [np.frombuffer(t, TOKEN) for t in pdf["tokens"]]
                flat = np.concatenate(tokens) if tokens else np.zeros(0, TOKEN)
                found = np.searchsorted(chosen, flat)
                hit = chosen[np.minimum(found, len(chosen) - 1)] == flat if len(chosen) else np.zeros(len(flat), bool)
                ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
                yield then(pdf.assign(tokens=tokens, held=[t[hit[e - len(t):e]] for t, e in zip(tokens, ends)]))

        return sets.mapInPandas(lean(pick), ddl)
    found = _exploded(sets).join(keys, "key", "left_semi").groupBy("cid").agg(F.collect_list("key").alias("held"))
    joined = sets.join(found, "cid", "left").select("cid", "n", "tokens", "held")

    def unpack(batches):
        for pdf in batches:
            held = [np.sort(np.array([] if h is None else h, dtype=np.int64).view(TOKEN)) for h in pdf["held"]]
            yield then(pdf.assign(tokens=[np.frombuffer(t, TOKEN) for t in pdf["tokens"]], held=held))

    return joined.mapInPandas(lean(unpack), ddl)


def _exploded(sets: DataFrame) -> DataFrame:
    """(key, cid, n) for each shingle of ``sets`` (cid, n, tokens)."""
    kind = pa.schema([("key", pa.int64()), ("cid", pa.int64()), ("n", pa.int32())])

    def spread(batches):
        for batch in batches:
            for first in range(0, len(batch), 500):
                cids, sizes, tokens = (c.to_pylist() for c in batch.slice(first, 500).columns)
                length = np.array([len(t) // 8 for t in tokens], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b"".join(tokens), dtype="<i8")), pa.array(np.repeat(np.array(cids, dtype=np.int64), length)),
                     pa.array(np.repeat(np.array(sizes, dtype=np.int32), length))],
                    schema=kind,
                )

    return sets.select("cid", "n", "tokens").mapInArrow(lean(spread), "key long, cid long, n int")


def _set_keys(n: int, prefix: np.ndarray, light_up_to: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a set of size n from its first n - o(n) + 2 elements in order, and their places; 0 for subsets."""
    keys, places = [np.zeros(0, TOKEN)], [np.zeros(0, np.int32)]
    if n <= light_up_to:
        i, j = np.triu_indices(len(prefix), 1)
        low, high = np.minimum(prefix[i], prefix[j]), np.maximum(prefix[i], prefix[j])
        keys.append(_mixed(_mixed(low) + high))
        places.append(np.zeros(len(i), np.int32))
    if n > light_up_to or 100 * n >= percent * (light_up_to + 1):
        keys.append(prefix[:max(1, n - overlap(n, percent) + 1)])
        places.append(np.arange(len(keys[-1]), dtype=np.int32))
    return np.concatenate(keys), np.concatenate(places)


def _may_meet(percent: int) -> Column:
    """Whether entries a and b of one list, at their first common key, leave enough elements to share."""
    left = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    return (100 + percent) * left >= percent * (F.col("a_n") + F.col("b_n"))


def light_boundary(sizes: dict[int, int], row_cost: float, percent: int) -> int:
    """The largest size whose sets enumerate subsets: the least total cost over sizes up to ``LIGHT_MOST``.

    ``sizes``: number of sets by size.  A subset costs 1; an entry in an inverted list costs
    ``row_cost``, one and the other entries it meets there.
    """
    subsets = lambda n: (n - overlap(n, percent) + 2) * (n - overlap(n, percent) + 1) / 2
    lists = lambda n: (n - overlap(n, percent) + 1) * row_cost

    def cost(x: int) -> float:
        return sum(
            c * ((subsets(n) if n <= x else 0) + (lists(n) if n > x or 100 * n >= percent * (x + 1) else 0))
            for n, c in sizes.items()
        )

    return min(range(LIGHT_MOST + 1), key=cost)


def _first_pairs(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of each list's members with its pivot, and the rows (key, cid, n, pos) of lists of three and more.

    The pivot is the member that shares most of its keys with others, for its size: among copies with
    changes of their own, the text they were made from or the copy nearest to it.
    """
    lists = materialise(
        rows.groupBy("key").agg(F.min("cid").alias("a"), F.max("cid").alias("b"), F.count("*").alias("held")).where("held > 1")
    )
    members = materialise(only(rows, lists.where("held > 2").select("key"), "key"))
    shared = members.groupBy("cid").agg((F.count("*") / F.first("n")).alias("share"))
    top = F.max(F.struct("share", (-F.col("cid")).alias("low"), F.col("n").alias("a_n"), F.col("pos").alias("a_pos")))
    pivots = members.join(shared, "cid").groupBy("key").agg(top.alias("top")).select("key", (-F.col("top.low")).alias("pivot"), "top.a_n", "top.a_pos")
    others = members.select("key", "cid", F.col("n").alias("b_n"), F.col("pos").alias("b_pos"))
    star = others.join(pivots, "key").where(_may_meet(percent)).select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b"))
    return lists.where("held = 2").select("a", "b").union(star).where("a < b").distinct(), members


def _size_band(n: Column, percent: int) -> Column:
    """Bands of sizes, so wide that a set's band and the next one hold all larger sets similar to it."""
    return F.floor(F.log(n) / F.log(F.lit(100 / percent * (1 + 1e-9))))


def _list_sides(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The members of lists (key, cid, n, pos and others) as the smaller sets a and the larger sets b of pairs, by ``CELL``.

    The members of a list in one band that are more than ``LIST_BLOCK`` are cut into blocks, and each pair of blocks
    has a join key of its own.
    """
    band = _size_band(F.col("n"), percent)
    small = rows.where((100 + percent) * (F.col("n") - F.col("pos")) >= 2 * percent * F.col("n")).withColumn("band", band)
    large = rows.withColumn("band", F.explode(F.array(band, band - 1)))
    of_a, of_b = (x.groupBy("key", "band").agg(F.count("*").alias(f"{s}_held")) for s, x in (("a", small), ("b", large)))
    # A member of a is one of b in the same band too, and no pair if there are no others.
    cells = materialise(of_a.join(of_b.where("b_held > 1"), ["key", "band"]).select(
        "key", "band", *(F.ceil(F.col(f"{s}_held") / LIST_BLOCK).cast("int").alias(f"{s}_blocks") for s in "ab")
    ))
    cells = F.broadcast(cells) if few(cells) else cells

    def side(members: DataFrame, s: str, own: str, t: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("cid"), f"{s}_blocks").cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{t}_blocks") - 1)).alias(other)
        names = [F.col(c).alias(f"{s}_{c}") for c in rows.columns if c != "key"]
        return members.join(cells, ["key", "band"]).select("key", "band", *names, block, every)

    return side(small, "a", "i", "b", "j"), side(large, "b", "j", "a", "i")


def _list_pairs(rows: DataFrame, percent: int, apart: bool = False) -> DataFrame:
    """All pairs (a, b) of one list's members (key, cid, n, pos) that may be similar, each once.

    With ``apart`` only those of different ``component``.
    """
    a, b = _list_sides(rows, percent)
    met = a.join(b, CELL).where((F.struct("a_n", "a_cid") < F.struct("b_n", "b_cid")) & _may_meet(percent))
    if apart:
        met = met.where("a_component <> b_component")
    return met.select(F.least("a_cid", "b_cid").alias("a"), F.greatest("a_cid", "b_cid").alias("b")).distinct()


def _compare(pairs: DataFrame, sets: DataFrame, percent: int, whole: bool) -> DataFrame:
    """The pairs (a, b) whose sets (cid, n, tokens) are similar, or may be if tokens are the first of each by hash."""
    names = {c: [F.col(x).alias(f"{c}_{x}" if x != "cid" else c) for x in ("cid", "n", "tokens")] for c in ("a", "b")}
    joined = pairs.join(sets.select(*names["a"]), "a").where(F.lit(True)).join(sets.select(*names["b"]), "b")
    near = (100 * F.col("a_n") >= percent * F.col("b_n")) & (100 * F.col("b_n") >= percent * F.col("a_n"))

    @F.pandas_udf("boolean")
    def similar(an: pd.Series, bn: pd.Series, at: pd.Series, bt: pd.Series) -> pd.Series:
        out = []
        for n, m, s, t in zip(an, bn, at, bt):
            s, t = np.frombuffer(s, TOKEN), np.frombuffer(t, TOKEN)
            if whole:
                most = len(np.intersect1d(s, t, assume_unique=True))
            else:
                end = min(s[-1], t[-1])
                s, t = s[:np.searchsorted(s, end, "right")], t[:np.searchsorted(t, end, "right")]
                most = len(np.intersect1d(s, t, assume_unique=True)) + min(n - len(s), m - len(t))
            out.append(100 * most >= percent * (n + m - most))
        return pd.Series(out, dtype=bool)

    return joined.where(near).where(similar("a_n", "b_n", "a_tokens", "b_tokens")).select("a", "b")


def similar_documents(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Per row (doc_id, n_shingles, component_id), and connecting links between class representatives (a, b).

    ``component_id`` is the smallest id reachable by links.  The links connect every component; pairs inside one
    that are connected by others need not be among them: ``class_links`` has all.
    """
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return _similar_documents(docs, id_column, text_column, width, percent)


def class_links(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Per class of equal sets (class_id, n_documents, n_links), and every link between two classes (a, b).

    A class is named by its representative, the smallest id in it, and has a row without links too.  The number of
    links of k near copies that all differ is k(k - 1) / 2, and so is the work on them.
    """
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return _similar_documents(docs, id_column, text_column, width, percent, every=True)


def _similar_documents(
    docs: DataFrame, id_column: str, text_column: str, width: int, percent: int, every: bool = False
) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    prefix = lambda n: min(n, n - overlap(n, percent) + 2)
    sketch = lambda n: min(n, prefix(n) + n // 10 + 8)
    kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("digest", pa.string()), ("tokens", pa.binary())])
    stored = materialise(_map_sets(
        rows, width, kind, "doc_id long, n int, digest string, tokens binary",
        lambda i, s: (i, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest(), s[:sketch(len(s))].tobytes()),
    ))
    filled = stored.where("n > 0 AND doc_id IS NOT NULL")
    digests = materialise(filled.groupBy("doc_id").agg(F.min("digest").alias("digest")))
    # Written, so that the join behind it has an exchange of its own, whose large partitions Spark splits.
    classes = materialise(digests.groupBy("digest").agg(F.min("doc_id").alias("cid")))
    member = materialise(digests.join(classes, "digest").select("doc_id", "cid"))
    unique = digests.count() == filled.count()

    def representatives(sets: DataFrame) -> DataFrame:
        """One row (cid, n, tokens) per class from rows (doc_id, n, digest, tokens)."""
        if unique:
            return only(sets, member.where("doc_id <> cid").select("doc_id"), "doc_id", "left_anti").select(F.col("doc_id").alias("cid"), "n", "tokens")
        own = sets.join(classes.select("digest", F.col("cid").alias("doc_id")), ["doc_id", "digest"])
        return own.groupBy(F.col("doc_id").alias("cid")).agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))

    def whole_sets(ids: DataFrame) -> DataFrame:
        """(cid, n, tokens): all shingles of the named classes' representatives, from their texts."""
        sets = _map_sets(
            only(rows, ids.withColumnRenamed("cid", "doc_id"), "doc_id"), width, kind, "doc_id long, n int, digest string, tokens binary",
            lambda i, s: (i, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest(), s.tobytes()),
        )
        return materialise(representatives(sets))

    def in_order(n: int, tokens: np.ndarray, held: np.ndarray) -> np.ndarray | None:
        """The prefix with the shingles in ``held`` behind all others, None if the sketch is too short to tell."""
        if len(tokens) - len(held) < prefix(n) and len(tokens) < n:
            return None
        return (np.concatenate([np.setdiff1d(tokens, held, assume_unique=True), held]) if len(held) else tokens)[:prefix(n)]

    def unclear(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[[in_order(n, t, h) is None for n, t, h in zip(pdf["n"], pdf["tokens"], pdf["held"])]][["cid"]]

    def keyed(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [in_order(n, t, h) for n, t, h in zip(pdf["n"], pdf["tokens"], pdf["held"])]
        none = np.zeros(0, TOKEN), np.zeros(0, np.int32)
        keys, places = zip(none, *(none if p is None else _set_keys(n, p, light, percent) for n, p in zip(pdf["n"], found)))
        length = [len(k) for k in keys[1:]]
        return pd.DataFrame({
            "key": np.concatenate(keys).view(np.int64), "cid": np.repeat(pdf["cid"].to_numpy(), length),
            "n": np.repeat(pdf["n"].to_numpy(), length), "pos": np.concatenate(places),
        })

    first = representatives(filled)
    listed = materialise(_exploded(first).groupBy("key").agg(F.count("*").alias("held")).where("held > 1"))
    long = listed.where(F.col("held") > LONG_LIST).select("key")
    met = listed.where(F.col("held") <= LONG_LIST).agg(F.sum(F.col("held") * (F.col("held") - 1))).first()[0] or 0
    sizes = {r.n: r["count"] for r in first.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").count().collect()}
    entries = first.agg(F.sum(F.length("tokens") / 8)).first()[0] or 1
    light = light_boundary(sizes, 1 + met / entries, percent)

    short = materialise(_with_held(first, long, unclear, "cid long"))
    sets = whole_sets(short)
    counted = _exploded(sets).groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > LONG_LIST).select("key")
    last = materialise(counted.union(long).distinct())
    shorter = materialise(only(_with_held(first, last, unclear, "cid long"), short, "cid", "left_anti"))
    kind_of_key = "key long, cid long, n int, pos int"
    entered = [_with_held(x, last, keyed, kind_of_key) for x in (first, sets, whole_sets(shorter))]
    entered = entered[0].union(entered[1]).union(entered[2])

    def links_among(pairs: DataFrame) -> DataFrame:
        ends = lambda p: p.select(F.col("a").alias("cid")).union(p.select("b")).distinct()
        likely = materialise(_compare(pairs, only(first, ends(pairs), "cid"), percent, False))
        return materialise(_compare(likely, whole_sets(materialise(ends(likely))), percent, True))

    if every:
        links = materialise(links_among(materialise(_list_pairs(materialise(entered), percent))))
        ends = links.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("n_links"))
        counts = member.groupBy("cid").agg(F.count("*").alias("n_documents")).join(ends, "cid", "left")
        return counts.select(F.col("cid").alias("class_id"), "n_documents", F.coalesce("n_links", F.lit(0)).alias("n_links")), links

    pairs, members = _first_pairs(entered, percent)
    tried = materialise(pairs)
    links = links_among(tried)
    placed = members.join(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), F.col("cid") == F.col("node"), "left")
    placed = materialise(placed.select("key", "cid", "n", "pos", F.coalesce("component", "cid").alias("component")))
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    open_rows = placed.join(mixed, "key", "left_semi")
    rest = _list_pairs(materialise(open_rows), percent, apart=True).join(tried, ["a", "b"], "left_anti")
    links = materialise(links.union(links_among(materialise(rest))))
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    of_member = member.join(found, F.col("cid") == F.col("node"), "left").select(
        F.col("doc_id").alias("member"), F.coalesce("component", "cid").alias("component_id")
    )
    result = stored.select("doc_id", "n").join(of_member, F.col("doc_id") == F.col("member"), "left")
    return result.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    ), links
