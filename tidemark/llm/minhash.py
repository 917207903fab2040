"""Near-duplicates by bottom-k sketches of word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.words import run_hashes, utf8, word_hashes
from tidemark.operators.joins import fits_broadcast, reshuffled
from tidemark.session import settle

SHINGLE = 5
PERCENT = 85
SKETCH = 64
#: The chance that a sketch hides one link.
MISS = 1e-12
#: Lists of more documents than this are looked at again with whole sets.
SHORT_LIST = 64
_CACHED_BYTES = 32 << 20
# Rows of few values for each partition, and the least number of partitions.
_ROWS, _LEAST = 100_000, 16


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; a text with fewer words is one shingle, one without has none."""
    hashes = word_hashes(text.lower().split())
    return np.unique(run_hashes(hashes, min(shingle, len(hashes))).view(np.int64)) if len(hashes) else np.zeros(0, np.int64)


def least_common(size: int, percent: int, miss: float = MISS) -> int:
    """How many of the ``size`` smallest values of a union both sets hold, but for a chance of ``miss``.

    Each of these values is in both sets with a chance that is the similarity, so the binomial distribution at the least
    similarity bounds the chance of fewer (drawing without repeats scatters less).
    """
    share, below = percent / 100, 0.0
    for common in range(size + 1):
        below += comb(size, common) * share**common * (1 - share) ** (size - common)
        if below > miss:
            return common
    return size


def _least_overlap(n: Column, percent: int) -> Column:
    """How many values a set of ``n`` shares at least with any set that it is linked with."""
    return F.call_function("div", n * percent + 99, F.lit(100)).cast("int")


def sketches(docs: DataFrame, shingle: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, version (a hash of the text), n (size of the set), digest (128 bits of the set), sketch (rising)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle) for text in batch["_text"]]
            digests = [hashlib.blake2b(held.tobytes(), digest_size=16).digest() for held in sets]
            columns = [batch["doc_id"], batch["version"], pa.array([len(held) for held in sets], pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([held[:size] for held in sets], pa.list_(pa.int64()))], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), _version(text_col), utf8(text_col).alias("_text"))
    names = ["doc_id", "version", "n", "digest", "sketch"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, version long, n long, digest binary, sketch array<long>")


def _version(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version")


def _entries(sets: DataFrame) -> DataFrame:
    """value, node, n, rest, score: inverted lists of the rarest values of each set, those that several sets hold.

    ``sets`` has node, n, prefix, values. Two sets that share more than ``held - prefix`` of their values share one of the
    ``prefix`` rarest ones of each, whatever else they hold. So a value that very many hold is only listed where nearly all
    of a set is that frequent. ``rest`` counts the values of a set from this one on, ``score`` is the frequency of all.
    """
    each = sets.select("node", "n", "prefix", F.size("values").alias("held"), F.explode("values").alias("value"))
    counts = each.groupBy("value").agg(F.count("*").alias("count")).where(F.col("count") > 1)
    shared = each.join(reshuffled(counts), "value")
    sets = shared.groupBy("node", "n", "prefix", "held").agg(
        F.sort_array(F.collect_list(F.struct("count", "value"))).alias("shared"), F.sum("count").alias("score")
    )
    sets = sets.withColumn("own", F.col("held") - F.size("shared")).where("prefix > own")
    listed = F.posexplode(F.slice("shared", F.lit(1), F.col("prefix") - F.col("own"))).alias("place", "listed")
    sets = sets.select("node", "n", (F.col("held") - F.col("own")).alias("rest"), "score", listed)
    return settle(sets.select("listed.value", "node", "n", (F.col("rest") - F.col("place")).alias("rest"), "score"))


def _settled_few(rows: DataFrame) -> DataFrame:
    """Rows that are few beside the documents, settled and then kept in as many partitions as they fill."""
    rows = settle(rows)
    return rows.coalesce(_LEAST + rows.count() // _ROWS)


def _with_typical(entries: DataFrame) -> DataFrame:
    """Links of every document in a list with the one whose values are the most frequent: a, b. Linear in the entries."""
    typical = entries.groupBy("value").agg(F.max_by("node", "score").alias("typical"))
    pairs = entries.join(reshuffled(typical), "value").where("node != typical")
    return pairs.select(F.least("node", "typical").alias("a"), F.greatest("node", "typical").alias("b")).distinct()


def _between_groups(entries: DataFrame, lists: DataFrame, percent: int, size: int | None = None) -> DataFrame:
    """Pairs in the same of the ``lists`` that are in different groups so far, and whose places there allow a link: a, b.

    The rarest value that two sets share has all other shared ones after it, in either set. So a pair counts only where
    enough values are left from there on, by which long lists give few pairs. Sets of more than ``size`` are known by
    their sketches.
    """
    held = settle(entries.join(reshuffled(lists), "value").select("value", "node", "root", "n", "rest"))
    left, right = (held.select("value", *[F.col(c).alias(f"{side}_{c}") for c in held.columns[1:]]) for side in "ab")
    least = F.least("a_rest", "b_rest")
    enough = least * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    if size is not None:
        enough = F.when(F.greatest("a_n", "b_n") <= size, enough).otherwise(least >= least_common(size, percent))
    fits = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    pairs = left.join(reshuffled(right), "value").where((F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root")) & fits & enough)
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _plausible(pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that their sketches don't rule out: by the values that both hold of the smallest of their union."""
    left, right = (sets.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("sketch").alias(f"{side}_sketch")) for side in "ab")
    both = pairs.join(reshuffled(left), "a").join(reshuffled(right), "b")
    union = F.slice(F.array_sort(F.array_union("a_sketch", "b_sketch")), 1, size)
    common = F.array_intersect("a_sketch", "b_sketch")
    exact = F.size(common) * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    likely = F.size(F.array_intersect(common, union)) >= least_common(size, percent)
    fits = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    return both.where(fits & F.when(F.greatest("a_n", "b_n") <= size, exact).otherwise(likely)).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough: a, b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, np.ndarray] = {}
        weight = 0
        for batch in batches:
            ids = [batch[side].to_pylist() for side in "ab"]
            good = []
            for at, pair in enumerate(zip(*ids)):
                found = []
                for node, text in zip(pair, (batch["a_text"], batch["b_text"])):
                    if node not in cache:
                        if weight > _CACHED_BYTES:
                            cache, weight = {}, 0
                        cache[node] = shingle_set(text[at].as_py(), shingle)
                        weight += cache[node].nbytes + 100
                    found.append(cache[node])
                union = len(np.union1d(*found))
                if 100 * (len(found[0]) + len(found[1]) - union) >= percent * union:
                    good.append(at)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    left, right = (sets.select(F.col("node").alias(side), F.col("text").alias(f"{side}_text")) for side in "ab")
    both = pairs.join(reshuffled(left), "a").join(reshuffled(right), "b").select("a", "b", "a_text", "b_text")
    return settle(both.mapInArrow(run, "a long, b long"))


def _rooted(entries: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries with the group of their document (root), and the lists that hold several groups (value, length)."""
    roots = components(links)
    entries = entries.join(reshuffled(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    entries = settle(entries)
    lists = entries.groupBy("value").agg(F.count("*").alias("length"), F.min("root").alias("low"), F.max("root").alias("high"))
    return entries, settle(lists.where("low != high").select("value", "length"))


def near_duplicates_by_sets(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    size: int = SKETCH,
    short_list: int = SHORT_LIST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: the size of its set of word shingles, its group of near-duplicates, and whether it stays.

    Texts are linked if 100 times the size of the intersection of their sets is at least ``percent`` times that of the
    union; a group is everything that links connect. Equal sets are one class, and all else is about classes.

    A class keeps the ``size`` smallest values of one hash function. Values that several sketches hold make up inverted
    lists, a class being in those of its rarest values only; as many as a linked pair has to share one of. First all of a
    list are held against its most typical member, which settles lists whose members are in one group by now. Of the
    others, short ones give all pairs between groups; the members of long ones are listed anew by their whole sets, where
    values of their own take them out of most lists, and then give all pairs between groups as well. Pairs are filtered by
    their sketches and confirmed on whole sets, as 64-bit hashes of shingles. A link is missed with a chance of 10^-12 at
    most, and only by sets larger than the sketch.

    ASCII letters are lower-cased, words are parted by ASCII white space. A text with fewer words than ``shingle`` is one
    shingle; null texts and texts without words have none, and are groups of their own. Rows with a null id get the group
    of their text; a group of such rows alone has a null name. Repeated rows are in one group. Rows with the name of their
    group stay. Other columns of ``docs`` are not read.

    Columns: doc_id, n_shingles, component_id (the smallest id of the group), kept.
    """
    rows = settle(sketches(docs, shingle, size, id_col, text_col))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")).alias("best")
    classes = rows.where("n > 0").groupBy("digest").agg(best, F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    classes = classes.select("digest", "best.doc_id", "best.version", "n", "sketch", F.monotonically_increasing_id().alias("node"))
    classes = settle(classes)

    # Sets up to this size are only linked with sets that the sketch holds as a whole.
    known = size * percent // 100
    whole_prefix = F.col("n") - _least_overlap(F.col("n"), percent) + 1
    sketch_prefix = F.least("n", F.lit(size)) - least_common(size, percent) + 1
    prefix = F.when(F.col("n") <= known, whole_prefix).otherwise(sketch_prefix).cast("int").alias("prefix")
    entries = _entries(classes.select("node", "n", prefix, F.col("sketch").alias("values")))

    # Sketches and texts of the classes that are in a list at all.
    listed = entries.select("node").distinct()
    sets = settle(classes.join(reshuffled(listed), "node").select("node", "n", "sketch", "doc_id", "version"))
    texts = docs.select(F.col(id_col).alias("_id"), _version(text_col), utf8(text_col).alias("text"))
    asked = sets.select("node", "doc_id", "version")
    asked = F.broadcast(asked) if fits_broadcast(asked) else reshuffled(asked)
    same = texts["version"].eqNullSafe(asked["version"]) & texts["_id"].eqNullSafe(asked["doc_id"])
    texts = settle(texts.join(asked, same).select("node", "text").dropDuplicates(["node"]))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return _linked(_settled_few(_plausible(_settled_few(pairs), sets, size, percent)), texts, shingle, percent)

    links = confirmed(_with_typical(entries))
    entries, lists = _rooted(entries, links)
    short = lists.where(F.col("length") <= short_list).select("value")
    links = links.unionByName(confirmed(_between_groups(entries, short, percent, size)))
    long = lists.where(F.col("length") > short_list).select("value")
    if not long.isEmpty():
        hot = entries.join(reshuffled(long), "value").select("node").distinct()
        entries = _entries(_whole_sets(settle(texts.join(reshuffled(hot), "node")), shingle).withColumn("prefix", whole_prefix.cast("int")))
        links = links.unionByName(confirmed(_with_typical(entries)))
        entries, lists = _rooted(entries, links)
        links = links.unionByName(confirmed(_between_groups(entries, lists.select("value"), percent)))

    roots = components(links)
    named = settle(classes.join(reshuffled(roots), "node", "left").select("digest", "doc_id", F.coalesce("root", "node").alias("root")))
    groups = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = settle(named.join(reshuffled(groups), "root").select("digest", "component_id"))
    joined = rows.select("doc_id", "n", "digest").join(reshuffled(named), "digest", "left")
    group = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), group.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _whole_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """node, n, values: the whole sets of some texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle) for text in batch["text"]]
            columns = [batch["node"], pa.array([len(held) for held in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "values"])

    return settle(texts.mapInArrow(run, "node long, n long, values array<long>"))
