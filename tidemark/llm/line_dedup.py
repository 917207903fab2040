"""Line deduplication by aligning pairs of documents."""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import reshuffled
from tidemark.session import settle

MIN_WORDS = 5
_DOCS = 500
# Scripts without spaces: two letters of Chinese or Japanese, or four of Thai, Lao, Burmese or Khmer, count as a word.
_TWO = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}"
_FOUR = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}"
_MARKS = r"\x{3000}-\x{3004}\x{3008}-\x{3020}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}"
_WORD = rf"[{_TWO}]{{1,2}}|[{_FOUR}]{{1,4}}|[^\x20\x09-\x0D{_TWO}{_FOUR}{_MARKS}]+"
# Most lines hold none of these letters and are counted faster.
_SPACED, _LATER = r"[^\x20\x09-\x0D]+", r"[\x{0E00}-\x{10FFFF}]"
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)


def _rising(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly rising selection of ``values``."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for at, value in enumerate(values):
        rank = bisect.bisect_left(tops, value)
        back.append(ends[rank - 1] if rank else -1)
        tops[rank : rank + 1] = [value]
        ends[rank : rank + 1] = [at]
    chain, at = [], ends[-1] if ends else -1
    while at >= 0:
        chain.append(at)
        at = back[at]
    return chain[::-1]


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Places of equal lines that a patience diff aligns, in order.

    Equal heads and tails are aligned; between them, lines that occur once on either side are matched in their
    longest common order, and what lies between these anchors is aligned in the same way.
    """
    pairs = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {a[i]: i for i in range(a0, a1) if in_a[a[i]] == 1}
        anchors = [(once[b[j]], j) for j in range(b0, b1) if in_b[b[j]] == 1 and b[j] in once]
        anchors = [anchors[k] for k in _rising([i for i, _ in anchors])]
        if anchors:
            # A part begins with its anchor, so that the anchor is the head of it.
            edges = [(a0, b0), *anchors, (a1, b1)]
            todo += [(i, k, j, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


def common_blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int], min_words: int = MIN_WORDS) -> list[int]:
    """Places in ``b`` of aligned runs of neighbouring lines that hold ``min_words`` words or more."""
    result: list[int] = []
    block: list[int] = []
    weight, last = 0, None
    for i, j in [*patience(a, b), (-1, -1)]:
        if last != (i - 1, j - 1):
            if weight >= min_words:
                result += block
            block, weight = [], 0
        if j >= 0:
            block.append(j)
            weight += words[j]
        last = (i, j)
    return result


def shared_lines(a: Sequence[int], b: Sequence[int], words_a: Sequence[int], words_b: Sequence[int], asked: set[int], min_words: int = MIN_WORDS) -> list[int]:
    """Places in ``b`` of all runs of neighbouring lines that ``a`` holds as well and that have ``min_words`` words or more.

    A patience diff aligns most of them. Of the ``asked`` places that it leaves, for a run has moved or occurs repeatedly,
    each is aligned again: a run around it is looked up in ``a``, and grows in both directions while lines are equal. A 0
    is equal to nothing.
    """
    found = set(common_blocks([x or None for x in a], b, words_b, min_words))
    if asked <= found:
        return sorted(found)
    places = {key: start for _, start, _, key in windows(a, words_a, min_words)}
    for at, start, _, key in windows(b, words_b, min_words):
        if at in found or key not in places:
            continue
        i, j = places[key], start
        while i and j and b[j - 1] and a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
        while i < len(a) and j < len(b) and b[j] and a[i] == b[j]:
            found.add(j)
            i, j = i + 1, j + 1
    return sorted(found)


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines that a document repeats from documents with smaller ids: doc_id, version, dropped (numbers from 0).

    Runs of neighbouring lines that together hold ``min_words`` words or more are evidence of an overlap (see `windows`).
    All holders of such a run are paired with its first holder, and with no other one: whatever a document shares with any
    earlier one, the first holder of it has as well. Pairs are aligned (see `shared_lines`), and all lines of runs that the
    first holder has are dropped from the later document. So a line goes if and only if it is in such a run that some
    earlier document holds, and pairs grow with the evidence, whatever the size of a group.

    Documents are paired by their forms (see `_members`): those that differ only in lines of their own align in the same
    way and are one form, whose first document stands for all as a holder. All is judged on the documents as given. Only
    64-bit hashes of lines are shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    units = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("version"),
        F.transform(lines, lambda line: F.xxhash64(line)).alias("lines"),
        F.transform(lines, _words).alias("words"),
    ).where(F.col(id_col).isNotNull())
    members = settle(_members(settle(units.dropDuplicates(["doc_id", "version"]))))
    forms = members.groupBy("form").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.any_value("lines").alias("lines"), F.any_value("words").alias("words")
    )
    forms = settle(forms)
    evidence = settle(_evidence(forms, min_words))
    firsts = evidence.groupBy("key").agg(F.min(F.struct("first", "form")).alias("earlier"), F.max("last").alias("latest"))
    firsts = settle(firsts.where("earlier.first < latest").drop("latest"))
    asking = evidence.join(reshuffled(firsts), "key").where("earlier.first < last")
    reach = _align(asking.groupBy("form", "earlier").agg(F.collect_set("line").alias("asked")), forms, min_words)
    reach = reach.groupBy("form").agg(F.collect_list(F.struct("line", "reach")).alias("reached"))
    joined = members.select("doc_id", "version", "form", "places").join(reshuffled(reach), "form")
    here = F.filter("reached", lambda x: x["reach"] < F.col("doc_id"))
    dropped = F.transform(here, lambda x: F.get("places", x["line"]))
    return joined.select("doc_id", "version", dropped.alias("dropped")).where(F.size("dropped") > 0)


def _words(line: Column) -> Column:
    return F.when(line.rlike(_LATER), F.regexp_count(line, F.lit(_WORD))).otherwise(F.regexp_count(line, F.lit(_SPACED)))


def _members(units: DataFrame) -> DataFrame:
    """doc_id, version, form, places, lines, words: of documents that share lines with others, these lines.

    Runs of lines that no other document holds are one 0 in ``lines`` each, which no line is aligned with; ``places`` has
    the numbers of the lines in the document, ``form`` the hash of ``lines``.
    """
    held = F.posexplode(F.arrays_zip("lines", "words")).alias("place", "held")
    each = units.select("doc_id", "version", held).select("doc_id", "version", "place", "held.lines", "held.words")
    shared = units.select(F.explode(F.array_distinct("lines")).alias("lines")).groupBy("lines").count().where("count > 1").select("lines")
    kept = each.join(reshuffled(shared), "lines").groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("place", "lines", "words"))).alias("kept"))
    kept = kept.join(reshuffled(units.select("doc_id", "version", F.size("lines").alias("n"))), ["doc_id", "version"])

    def runs(name: str, gap: int) -> Column:
        def step(x: Column, i: Column) -> Column:
            before = F.coalesce(F.get("kept", i - 1)["place"], F.lit(-1))
            return F.when(x["place"] == before + 1, F.array(x[name])).otherwise(F.array(F.lit(gap).cast(kinds[name]), x[name]))

        end = F.when(F.element_at("kept", -1)["place"] < F.col("n") - 1, F.array(F.lit(gap).cast(kinds[name])))
        return F.concat(F.flatten(F.transform("kept", step)), F.coalesce(end, F.array().cast(f"array<{kinds[name]}>")))

    kinds = {"place": "int", "lines": "long", "words": "int"}
    rows = kept.select("doc_id", "version", runs("place", -1).alias("places"), runs("lines", 0).alias("lines"), runs("words", 0).alias("words"))
    return rows.withColumn("form", F.xxhash64("lines"))


def windows(lines: Sequence[int], words: Sequence[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """Places of lines, with start, stop and hash of the least runs of neighbouring lines around them with ``min_words`` words.

    Any run of neighbouring lines with that many words holds, for each of its lines, one of the runs around it: one
    that ends with the line, or one that begins at the line or at one of the ``min_words`` lines with words before it.
    No run reaches across a 0.
    """
    total, hashes, powers = [0], [0], [1]
    for line, count in zip(lines, words):
        total.append(total[-1] + count)
        hashes.append((hashes[-1] * _BASE + line) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    ends = [len(lines)] * len(lines)
    for at in range(len(lines) - 1, -1, -1):
        ends[at] = at if lines[at] == 0 else ends[at + 1] if at + 1 < len(lines) else len(lines)
    found = []
    before: int | None = None  # the last place before this one that has words
    earlier: list[int | None] = []
    for at, line in enumerate(lines):
        earlier.append(before)
        if line == 0:
            before = None
            continue
        start: int | None = at
        while start is not None:
            stop = max(at + 1, bisect.bisect_left(total, total[start] + min_words))
            if stop <= ends[at]:
                found.append((at, start, stop, (hashes[stop] - hashes[start] * powers[stop - start]) % _PRIME))
                if stop == at + 1:
                    break
            start = earlier[start]
        before = at if words[at] else before
    return found


def _slices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Some rows at a time, so that few windows are held at once."""
    for frame in frames:
        for low in range(0, len(frame), _DOCS):
            yield frame.iloc[low : low + _DOCS]


def _evidence(forms: DataFrame, min_words: int) -> DataFrame:
    """form, first, last, line, key: what a line shares with the documents that it may be aligned with."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(frames):
            rows = zip(frame["lines"], frame["words"])
            found = [sorted({(at, key) for at, _, _, key in windows(lines.tolist(), words.tolist(), min_words)}) for lines, words in rows]
            frame = frame[["form", "first", "last"]].assign(found=found).explode("found").dropna(subset=["found"])
            yield frame[["form", "first", "last"]].assign(line=frame["found"].str[0], key=frame["found"].str[1])

    kind = forms.schema["first"].dataType.simpleString()
    return forms.mapInPandas(find, f"form long, first {kind}, last {kind}, line int, key long")


def _align(pairs: DataFrame, forms: DataFrame, min_words: int) -> DataFrame:
    """form, line, reach: the lines that forms repeat from others, and the smallest id of the first documents of these."""
    first = forms.select(F.struct("first", "form").alias("earlier"), F.col("lines").alias("first_lines"), F.col("words").alias("first_words"))
    both = pairs.join(reshuffled(first), "earlier").join(reshuffled(forms.select("form", "lines", "words")), "form")

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(frames):
            rows = zip(*(frame[name] for name in ("first_lines", "lines", "first_words", "words", "asked")))
            found = [shared_lines(*(x.tolist() for x in row[:4]), set(row[4].tolist()), min_words) for row in rows]
            yield frame[["form", "reach"]].assign(line=found).explode("line").dropna(subset=["line"])[["form", "line", "reach"]]

    kind = forms.schema["first"].dataType.simpleString()
    both = both.select("form", F.col("earlier.first").alias("reach"), "first_lines", "lines", "first_words", "words", "asked")
    return both.mapInPandas(align, f"form long, line int, reach {kind}").groupBy("form", "line").agg(F.min("reach").alias("reach"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` with the lines that repeat earlier documents cut out of the text.

    A document that only repeats others is left with an empty text. A text of which nothing is cut stays as it is, null
    ones too. Rows with a null id are neither cut nor looked at. Rows that repeat an id and its text are treated alike;
    rows with the same id and other texts are not compared with each other. A column n_chars of integers follows the
    text. Lines are separated by line feeds.
    """
    return _cut(docs, min_words, id_col, text_col).select("row.*")


def line_dedup_report(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, as `dedup_lines` treats it: doc_id, n_lines, n_removed, kept_sha256 (of the text left)."""
    cut = _cut(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), min_words, "doc_id", "text")
    return cut.select(
        "row.doc_id",
        "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).alias("n_removed"),
        F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"),
    )


def _cut(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    dropped = settle(dropped_lines(docs, min_words, id_col, text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    joined = rows.join(reshuffled(dropped), ["doc_id", "version"], "left")
    lines = F.split(F.coalesce(F.col("row")[text_col], F.lit("")), "\n", -1)
    joined = joined.withColumn("lines", lines).withColumn("n_lines", F.size("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), "dropped")
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    joined = joined.withColumn("left", F.when(F.col("dropped").isNotNull(), left))
    row = F.col("row").withField(f"`{text_col}`", F.coalesce("left", F.col("row")[text_col]))
    counted = next((f for f in docs.schema.fields if f.name == "n_chars" and isinstance(f.dataType, T.IntegralType)), None)
    if counted is not None and text_col != "n_chars":
        length = F.char_length("left").cast(counted.dataType)
        row = row.withField("n_chars", F.when(F.col("left").isNotNull(), length).otherwise(F.col("row.n_chars")))
    return joined.select(row.alias("row"), "dropped", "n_lines")
