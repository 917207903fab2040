from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
from check import compare
from tidemark.llm.queries import ORACLES, QUERIES

from .test_decontamination import brute as leaks_of
from .test_line_dedup import brute as cut_lines
from .test_simhash import brute_groups, brute_print


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    assert name in entry.queries()
    line = compare(spark, sf, name, con)
    assert line.split()[0] == ("ok" if name in ORACLES else "rows")


def test_pipeline_is_registered():
    assert entry.queries()["pipeline"] is P.run
    assert [name for name, _ in P.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark, sf, tmp_path):
    stages = dict(P.STAGES)
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {"documents": rows_of(documents)}
    docs, at = documents, "documents"
    for name in list(stages)[:-1]:
        stages[name](spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.schema.names == documents.schema.names
        texts[name] = rows_of(docs)

    # Toxicity: rows go or stay as they are; rejected ones are few, and mostly those labelled.
    assert set(texts["toxicity"]) < set(texts["documents"])
    toxic = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
    gone = {i for i, _ in texts["documents"]} - {i for i, _ in texts["toxicity"]}
    assert len(gone & toxic) >= len(toxic) / 2 and len(gone) < 30

    assert Counter(texts["line_dedup"]) == Counter((i, t) for i, _, _, t in cut_lines(texts["toxicity"]))

    prints = {i: brute_print(t) for i, t in texts["line_dedup"]}
    groups = brute_groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    first = defaultdict(list)
    for i, p in prints.items():
        first[groups[p]].append(i)
    kept = {min(ids) for ids in first.values()}
    assert Counter(texts["near_duplicates"]) == Counter((i, t) for i, t in texts["line_dedup"] if i in kept)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, *_ in leaks_of(texts["near_duplicates"], items)}
    assert Counter(texts["decontamination"]) == Counter((i, t) for i, t in texts["near_duplicates"] if i not in bad)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stages["packing"](spark, docs, sf).collect()
    length = Counter()
    for r in pieces:
        length[r.doc_id] += r.length
    assert length == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts["decontamination"]}


def test_run(spark, sf):
    assert P.run(spark, sf).count() > 100


def test_stages_take_odd_tables(spark, sf, odd, empty):
    for _, stage in P.STAGES:
        for docs in (odd, empty):
            out = stage(spark, docs, sf)
            assert out.count() >= 0
            if stage is not P.packed:
                assert out.columns == docs.columns
